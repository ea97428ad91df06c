"""Benchmark decontamination and personal data."""

import random
import re

import numpy as np
import pytest
from conftest import DATA

from orderwake.llm import pii
from orderwake.llm.decontaminate import ERROR_RATE, ItemBlock, best_distance, contamination, decontaminate, edit_budget, normalised, pieces
from orderwake.llm.pii_model import FORBIDDEN, PADDING, SYMBOLS, TAGS, Tagger, fit_tagger, symbols
from orderwake.llm.pii_rules import KINDS, base_spans, luhn
from orderwake.llm.queries import QUERIES

ITEM = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix a box of jars under the old bridge"


def plain_distance(item, text):
    """Smallest edit distance to a substring, cell by cell."""
    above = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        row = [i]
        for j, b in enumerate(text, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (a != b)))
        above = row
    return min(above)


def masks(item):
    found = {}
    for i, c in enumerate(item):
        found[c] = found.get(c, 0) | 1 << i
    return found


def test_bit_parallel_distance():
    rng = random.Random(1)
    for _ in range(400):
        item = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 90)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randrange(0, 120)))
        if rng.random() < 0.5:
            text += item[: rng.randrange(len(item) + 1)] + text[:5]
        assert best_distance(item, masks(item), text) == plain_distance(item, text)


def test_pieces_cover_the_item():
    for budget in range(6):
        cut = pieces(ITEM, budget)
        assert len(cut) == budget + 1 and "".join(p for _, p in cut) == ITEM
        assert all(ITEM[a : a + len(p)] == p for a, p in cut)


def edited(text, n, rng):
    for _ in range(n):
        at = rng.randrange(len(text))
        text = rng.choice([text[:at] + text[at + 1 :], text[:at] + "q" + text[at:], text[:at] + "q" + text[at + 1 :]])
    return text


def brute_matches(docs, items, rate=ERROR_RATE):
    found = set()
    for doc, text in docs:
        for item, wanted in items:
            a, b = normalised(wanted), normalised(text)
            if a.strip() and text:
                d = plain_distance(a, b)
                if d <= edit_budget(a, rate):
                    found.add((doc, item, d))
    return found


def test_edited_items_are_found(spark):
    rng = random.Random(2)
    items = [(1, ITEM), (2, "short one"), (3, None), (4, ""), (5, "?!"), (2, "short one"), (6, ITEM[20:])]
    docs = [(i, f"lorem {i} " + edited(ITEM, i % 9, rng) + " ipsum") for i in range(30)]
    docs += [(40, None), (41, ""), (42, "a Short, one!"), (43, "ashort oneb"), (44, ITEM.upper().replace(" ", "\n--")), (44, "nothing"), (None, ITEM), (45, ITEM[:60])]
    frame = spark.createDataFrame([(i, t, 5, "z") for i, t in docs], "doc_id bigint, text string, item int, distance string")
    tests = spark.createDataFrame(items, "item_id bigint, text string")
    found = {tuple(r) for r in contamination(frame, tests).collect()}
    assert found == brute_matches(docs, items)
    assert {tuple(r) for r in contamination(frame, tests, block_chars=50).collect()} == found
    clean = decontaminate(frame, tests, block_chars=50)
    assert clean.schema == frame.schema
    dirty = {doc for doc, _, _ in found}
    texts_hit = {t for d, t in docs if t and any(brute_matches([(d, t)], items))}
    assert sorted(map(str, (r.text for r in clean.collect()))) == sorted(str(t) for _, t in docs if t not in texts_hit)
    assert 42 in dirty and 43 not in dirty and 45 not in dirty


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    tests = spark.createDataFrame([], "item_id bigint, text string")
    some = spark.createDataFrame([(1, ITEM)], "doc_id bigint, text string")
    assert contamination(some, tests).count() == 0 and decontaminate(some, tests).count() == 1
    assert contamination(docs, spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")).count() == 0


def test_decontamination_query_finds_every_whole_item(spark):
    docs = {r.doc_id: normalised(r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    items = {r.item_id: normalised(r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()}
    found = {(r.doc_id, r.item_id): r.distance for r in QUERIES["op10_decontamination"](spark, DATA).collect()}
    exact = {(d, i) for d, t in docs.items() for i, item in items.items() if item in t}
    assert exact <= set(found) and all(found[k] == 0 for k in exact)
    block = ItemBlock(list(items.items()), ERROR_RATE)
    assert {(d, *m) for d, t in docs.items() for m in block.matches(t)} == {(*k, v) for k, v in found.items()}


# Personal data


def plain_spans(text):
    spans = {k: [m.span() for m in re.finditer(p, text)] for k, p in zip(KINDS, (
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
    ))}
    digits = lambda s: re.sub("[^0-9]", "", text[s[0] : s[1]])
    spans["ip"] = [s for s in spans["ip"] if all(int(p) <= 255 for p in text[s[0] : s[1]].split("."))]
    spans["card"] = [s for s in spans["card"] if 13 <= len(digits(s)) <= 19 and luhn(digits(s))]
    spans["phone"] = [s for s in spans["phone"] if 9 <= len(digits(s)) <= 15]
    return spans


def test_base_rules_are_leftmost_matches():
    rng = random.Random(4)
    for _ in range(20_000):
        text = "".join(rng.choice(rng.choice(["a.@_-", "12.", "ab@.c ", "0123456789 -", "+1() 23-.", "é٣"])) for _ in range(rng.choice([5, 20, 60])))
        assert base_spans(text) == plain_spans(text)
    assert luhn("4539578763621486") and not luhn("4539578763621487")
    for hard in ("1" * 50_000, "a" * 50_000, "a@" * 20_000, "1." * 20_000, "+1 " * 20_000):
        base_spans(hard)


def test_tagger_slopes():
    rng = np.random.default_rng(0)
    model = Tagger(3, 1)
    x, tags = rng.integers(0, SYMBOLS, (3, 7)), np.array([[0, 1, 2, 2, 0, 5, 0], [0, 0, 0, 7, 8, 0, 0], [3, 4, 4, 0, 0, 0, 1]])

    def likelihood():
        scores = model.emissions(x)
        _, _, total = model.marginals(scores)
        moves = model.moves()
        own = scores[np.arange(3)[:, None], np.arange(7), tags].sum(1) + moves[tags[:, :-1], tags[:, 1:]].sum(1)
        return (own - total).mean()

    slopes = model.slopes(x, tags)
    for name, value in model.p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in value.shape)
            kept = value[at]
            value[at] = kept + 1e-5
            up = likelihood()
            value[at] = kept - 1e-5
            down = likelihood()
            value[at] = kept
            assert abs((up - down) / 2e-5 - slopes[name][at]) < 1e-4


def tagged(text):
    return pii.tag_spans(len(text), base_spans(text))


@pytest.fixture(scope="module")
def tagger():
    rng = random.Random(0)
    word = lambda: "".join(rng.choice("aeinrst") for _ in range(rng.randrange(2, 9)))
    x, tags = [], []
    for i in range(300):
        datum = [f"{word()}.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com", ".".join(str(rng.randrange(1, 255)) for _ in range(4)), "", f"version {rng.randrange(99)}"][i % 4]
        text = f"{word()} {word()} {datum} {word()}. {word()} {word()}"[:64]
        x.append(np.pad(symbols(text), (0, 64 - len(text)), constant_values=PADDING))
        tags.append(np.pad(tagged(text), (0, 64 - len(text))))
    return fit_tagger(np.stack(x), np.stack(tags), hidden=12, epochs=14)


def test_tagger_learns_from_labelled_spans(tagger):
    text = "serin tast neri.77@mail3.example.com sine. rest ane 12.201.7.99 and page 17"
    found = {(k, text[a:b].strip()) for k, a, b, p in pii.tagged_spans([text], tagger)[0] if p > 0.6}
    assert ("email", "neri.77@mail3.example.com") in found and ("ip", "12.201.7.99") in found and len(found) == 2


def test_windows_cover_every_core_character():
    rng = random.Random(6)
    for _ in range(300):
        text = "".join(rng.choice("a" * 200 + "1@") for _ in range(rng.randrange(0, 900)))
        starts = pii.window_starts(text)
        every = [i for i in range(0, max(1, len(text)), pii.STRIDE) if re.search("[0-9@]", text[i : i + pii.WINDOW])]
        assert starts == every


def test_one_path_over_a_long_stretch(tagger):
    text = "".join(f"ane {i % 250}.1.2.3 rest " for i in range(400))
    spans = pii.tagged_spans([text, ""], tagger)
    assert spans[1] == [] and all(a < b <= c for (_, a, b, _), (_, c, _, _) in zip(spans[0], spans[0][1:]))
    assert tagger.moves()[0, 2] <= FORBIDDEN / 2 and tagger.moves().shape == (TAGS, TAGS)


def test_personal_data_of_odd_rows(spark, tagger):
    texts = [None, "", "no data", "a@b.cc and 1.2.3.4", "x" * 50_000 + " a@b.cc", "call +1 (212) 555-0101 now", "4539 5787 6362 1486", "é 1.2.3.4 é"]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)] + [(3, texts[3], "s")], "doc_id bigint, text string, spans string")
    found = pii.find_pii(docs, tagger).collect()
    assert len(found) == 9
    for r in found:
        base = {x for x in pii.listed(base_spans(texts[r.doc_id] or "")).split(",") if x}
        assert base <= set(r.spans.split(",")) | set() or not base
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(base_spans(texts[r.doc_id] or "")[k]) for k in KINDS)
    only_rules = {r.doc_id: r.spans for r in pii.find_pii(docs, None).collect()}
    assert only_rules[3] == "email:0:6,ip:11:18" and only_rules[0] == only_rules[1] == only_rules[2] == "" and only_rules[7] == "ip:2:9"
    assert pii.find_pii(docs.limit(0), tagger).count() == 0
    assert pii.fit_pii(docs.where("doc_id < 3")) is None


def test_personal_data_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    found = QUERIES["op8_pii"](spark, DATA).collect()
    assert len(found) == len(texts)
    more = 0
    for r in found:
        base = pii.listed(plain_spans(texts[r.doc_id]))
        assert r.base_sha256 == __import__("hashlib").sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
        more += len(r.spans.split(",")) - len(base.split(",")) if r.spans else 0
        if not re.search("[0-9@]", texts[r.doc_id]):
            assert r.spans == ""
    assert more <= 0.1 * len(texts)
