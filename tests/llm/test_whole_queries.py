"""Whole queries of the fitted and matching operators on small tables, against plain versions of their methods."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import DATA
from test_matching import brute_matches, edited

from orderwake.llm.chars import letters
from orderwake.llm.common import SPACE
from orderwake.llm.language_id import BINS, SCRIPT_RANGES, SCRIPT_SHARE, SWITCH, UNDETERMINED
from orderwake.llm.quality_crf import fit_quality, training_fold
from orderwake.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int"


def write(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")


def fold(doc_id, folds):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds


# --- op2: features, marginals and aggregation, from the definition


def line_values(line, before):
    is_letter = letters()
    words = [w for w in line.split() if w]
    n_space = sum(c in SPACE for c in line)
    n_letters = sum(bool(is_letter[ord(c)]) for c in line)
    chars, n = max(len(line) - n_space, 1), max(len(words), 1)

    def share(marks):
        return sum(c in marks for c in line) / n

    upper = sum(bool(is_letter[ord(c)]) and c.isupper() for c in line)
    return [
        math.log1p(len(line)) / 5, len(line) < 30, n_letters / chars, upper / max(n_letters, 1), sum(c in "0123456789" for c in line) / chars,
        min(share("#*$%&<>"), 4), min(share("!?=\"'"), 4), min(share("|"), 2), min((len(line) - n_space) / n, 20) / 10,
        len(set(words)) / n, line in before and bool(words), not words,
    ]


def plain_quality(text, model):
    """Mean probability of good lines, over all labellings of the lines."""
    lines, before, values = (text or "").split("\n"), set(), []
    for line in lines:
        values.append([float(v) for v in line_values(line, before)])
        before.add(line)
    none = [0.0] * len(values[0])
    scores = []
    for i, own in enumerate(values):
        row = own + (values[i - 1] if i else none) + (values[i + 1] if i + 1 < len(values) else none) + [float(i == 0), float(i + 1 == len(values)), 1.0]
        scores.append(float(((np.array(row) - model.mean) / model.spread) @ model.weights))
    total, good = 0.0, [0.0] * len(lines)
    for labelling in itertools.product((0, 1), repeat=len(lines)):
        weight = sum(s for s, label in zip(scores, labelling) if label) + sum(model.transitions[a, b] for a, b in zip(labelling, labelling[1:]))
        weight = math.exp(weight)
        total += weight
        for i, label in enumerate(labelling):
            good[i] += weight * label
    sizes = [len(line) + 1 for line in lines]
    return sum(g / total * s for g, s in zip(good, sizes)) / sum(sizes)


PLAIN, NOISY = "the plain words of a quiet line about old bridges".split(), ["###", "$$", "|", "A1!", "=", "99"]


def plain_share(text):
    """Share of the characters of plain words; None without words."""
    words = (text or "").split()
    return sum(len(w) for w in words if w not in NOISY) / sum(map(len, words)) if words else None


def quality_tables(spark, folder):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(160):
        good = i % 3 != 0
        lines = [" ".join(rng.choices(PLAIN if rng.random() < (0.85 if good else 0.2) else NOISY, k=rng.randrange(9))) for _ in range(rng.randrange(1, 8))]
        rows.append((i, "\n".join(lines), "en", "s", 1))
        labels.append((i, int(good)))
    rows += [(900, None, None, None, None), (901, "", "en", "s", 0), (902, "\n\n", "en", "s", 2), (5, "same id", None, "s", 1), (None, "no id", None, "s", 1)]
    write(spark, folder, "documents", rows, SCHEMA)
    return rows, labels


def test_quality_query_against_all_labellings(spark, tmp_path):
    rows, labels = quality_tables(spark, tmp_path)
    write(spark, tmp_path, "labels", labels, "doc_id bigint, quality int")
    docs, taught = (spark.read.parquet(f"{tmp_path}/{name}.parquet") for name in ("documents", "labels"))
    model = fit_quality(docs, taught.where(training_fold("doc_id")))
    found = sorted(QUERIES["op2_quality_classifier"](spark, str(tmp_path)).collect(), key=lambda r: (str(r.doc_id), r.score))
    wanted = sorted(((i, plain_quality(t, model)) for i, t, *_ in rows), key=lambda r: (str(r[0]), r[1]))
    assert [r.doc_id for r in found] == [i for i, _ in wanted]
    assert [r.score for r in found] == pytest.approx([s for _, s in wanted], abs=1e-9)
    assert all(r.predicted == (r.score >= 0.3) for r in found)
    assert all(r.held_out == (None if r.doc_id is None else fold(r.doc_id, 5) == 0) for r in found)
    # A document's lines are drawn with noise and may contradict its label; those nearly all of one kind are clear.
    texts = {}
    for i, text, *_ in rows:
        texts.setdefault(i, text)
    clear = [(share, r.score >= 0.5) for r in found if r.held_out and (share := plain_share(texts[r.doc_id])) is not None and not 0.1 < share < 0.9]
    assert len(clear) > 10 and all((share > 0.5) == good for share, good in clear)


def test_held_out_labels_are_never_learned(spark, tmp_path):
    _, labels = quality_tables(spark, tmp_path)
    folders = []
    for name, changed in (("as_given", labels), ("turned", [(i, 1 - q if fold(i, 5) == 0 else q) for i, q in labels])):
        (tmp_path / name).mkdir()
        (tmp_path / name / "documents.parquet").symlink_to(tmp_path / "documents.parquet")
        write(spark, tmp_path / name, "labels", changed, "doc_id bigint, quality int")
        folders.append(str(tmp_path / name))
    scores = [sorted((str(r.doc_id), r.score) for r in QUERIES["op2_quality_classifier"](spark, f).collect()) for f in folders]
    assert scores[0] == scores[1]


# --- op9: counts, scripts and the search, word by word


def plain_words(text):
    """(script, lower-cased letters) of each run of letters of one script."""
    is_letter, words = letters(), []
    previous = None
    for c in text or "":
        if not is_letter[ord(c)]:
            previous = None
            continue
        low = c.lower() if len(c.lower()) == 1 else c
        script = [name for start, name in SCRIPT_RANGES if start <= ord(low)][-1]
        if script != previous:
            words.append((script, []))
        words[-1][1].append(ord(low))
        previous = script
    return words


def plain_bins(word):
    wide = 1 << 64
    for a, b, c in zip([0, *word], word, [*word[1:], 0]):
        mixed = (a * 0x9E3779B97F4A7C15 ^ b * 0xC2B2AE3D27D4EB4F ^ c * 0x165667B19E3779F9) % wide
        yield (mixed ^ mixed >> 29) * 0xBF58476D1CE4E5B9 % wide >> 48


def plain_languages(rows):
    grams, scripts = {}, {}
    for doc, text, lang in {(i, t, lang) for i, t, lang, *_ in rows if fold(i, 4) not in (2, None) and t is not None and lang is not None}:
        grams.setdefault(lang, Counter()), scripts.setdefault(lang, Counter())
        for script, word in plain_words(text):
            grams[lang].update(plain_bins(word))
            scripts[lang][script] += len(word)
    languages = sorted(grams)
    totals = {lang: sum(grams[lang].values()) for lang in languages}
    found = []
    for doc, text, *_ in rows:
        words = plain_words(text)
        best = {lang: (0.0, []) for lang in languages}
        for script, word in words:
            allowed = [lang for lang in languages if scripts[lang][script] / max(sum(scripts[lang].values()), 1) >= SCRIPT_SHARE]
            bins = list(plain_bins(word))
            top = max(best.values(), key=lambda b: b[0])
            step = {}
            for lang in languages:
                score = sum(math.log((grams[lang][b] + 0.5) / (totals[lang] + 0.5 * BINS)) for b in bins)
                score = 0.0 if not allowed else score if lang in allowed else -1e9
                came = best[lang] if best[lang][0] >= top[0] - SWITCH else (top[0] - SWITCH, top[1])
                step[lang] = (came[0] + score, [*came[1], lang])
            best = step
        share = Counter()
        if words:
            for lang, (_, word) in zip(max(best.values(), key=lambda b: b[0])[1], words):
                share[lang] += len(word)
        top = max(sorted(share), key=share.__getitem__, default=UNDETERMINED)
        found.append((str(doc), top, round(share[top] / max(sum(share.values()), 1), 9)))
    return sorted(found)


def test_language_query_against_plain_search(spark, tmp_path):
    rng = random.Random(4)
    pool = {
        "en": "the of and bridge river which would through water people".split(),
        "de": "der die und Brücke Fluß welche würde durch Wasser Leute".split(),
        "ru": "и в не мост река который через вода люди".split(),
    }
    rows = []
    for i in range(150):
        lang = rng.choice(list(pool))
        other = rng.choice(list(pool))
        text = " ".join(rng.choices(pool[lang], k=rng.randrange(1, 12)) + rng.choices(pool[other], k=rng.randrange(4) * (i % 3 == 0)))
        rows.append((i, text + ", 12!" * (i % 2), lang, "s", len(text)))
    rows += [(500, None, "en", "s", None), (501, "", None, None, 0), (502, "12 34 !", "de", "s", 7), (503, "漢字 の", None, "s", 4), (504, "ΑΒΓ the", "en", "s", 7), (7, rows[7][1], rows[7][2], "t", 1)]
    write(spark, tmp_path, "documents", rows, SCHEMA)
    found = QUERIES["op9_language_id"](spark, str(tmp_path)).collect()
    assert sorted((str(r.doc_id), r.lang_pred, round(r.score, 9)) for r in found) == plain_languages(rows)
    assert all(r.held_out == (fold(r.doc_id, 4) == 2) for r in found)


# --- op10: every document against every item, cell by cell


def test_decontamination_query_against_all_pairs(spark, tmp_path):
    rng = random.Random(6)
    words = [f"word{i}" for i in range(30)] + "a of in to".split()
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 16)))) for i in range(14)]
    items += [(50, items[0][1]), (51, None), (52, " ?! "), (53, "Zu"), (54, "ﬁne Ünicode TEXT of some length, 12.5%")]
    rows = []
    for i in range(60):
        _, item = items[rng.randrange(14)]
        core = edited(item, rng.randrange(1 + len(item) // 8), rng) if i % 3 else " ".join(rng.choices(words, k=6))
        text = f"{' '.join(rng.choices(words, k=rng.randrange(9)))}, {core.upper() if i % 4 == 0 else core}. {' '.join(rng.choices(words, k=rng.randrange(9)))}"
        rows.append((i, text, "en", "s", len(text)))
    rows += [(70, None, None, None, None), (71, "", "en", "s", 0), (72, items[-1][1] + " zu", "de", "s", 9), (72, "another text", "de", "s", 9), (73, "zug", "de", "s", 3)]
    write(spark, tmp_path, "documents", rows, SCHEMA)
    write(spark, tmp_path, "benchmark", items, "item_id bigint, text string")
    least = {}
    for doc, item, d in brute_matches([(i, t) for i, t, *_ in rows], items):
        least[doc, item] = min(d, least.get((doc, item), d))
    found = {(r.doc_id, r.item_id): r.distance for r in QUERIES["op10_decontamination"](spark, str(tmp_path)).collect()}
    assert found == least and len(found) > 40 and any(found.values())


def test_decontamination_query_on_the_given_tables(spark):
    """Items of the given benchmark against the given documents: whole occurrences are a lower bound that needs no search."""
    found = {(r.doc_id, r.item_id) for r in QUERIES["op10_decontamination"](spark, DATA).where("distance = 0").collect()}
    docs = [(r.doc_id, f" {' '.join(''.join(c if c.isalnum() else ' ' for c in (r.text or '').lower()).split())} ") for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    items = [(r.item_id, f" {' '.join(''.join(c if c.isalnum() else ' ' for c in (r.text or '').lower()).split())} ") for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert found == {(doc, item) for doc, text in docs for item, wanted in items if wanted.strip() and wanted in text}
