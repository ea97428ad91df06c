"""Line dedup and quality rules against SQL, SimHash and substring dedup against brute force."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
import xxhash
from conftest import DATA

from orderwake.llm.components import connected_components
from orderwake.llm.line_dedup import line_dedup
from orderwake.llm.quality_rules import bin_of, quality_rules
from orderwake.llm.queries import QUERIES
from orderwake.llm.simhash import fingerprint, linked, simhash_groups
from orderwake.llm.sql import ORACLE
from orderwake.llm.substring_dedup import dealt_out, substring_dedup
from pyspark.sql import functions as F

LINE = "a line of text that is shared by several documents"
ODD_TEXTS = [
    None, "", "\n", " \t\n", LINE, LINE.upper() + " ", f"{LINE}\nown line", f"x\n{LINE}\r\n{LINE}", f"{LINE}\n", "é" * 39, "É" * 40,
    "one", "one two", "one two three", "one two three", "# * | < >", "w " * 400, "\x0b\x0c a\x1cb  c", "a\nb\na\nb\n\nb", LINE,
]


def odd_documents(texts=ODD_TEXTS):
    langs, sources = ["en", "de", None], ["s1", None]
    return [(i, t, langs[i % 3], sources[i % 2], len(t) if t else None) for i, t in enumerate(texts)]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_documents(), SCHEMA)


def duck_rows(sql, documents):
    connection = duckdb.connect()
    if isinstance(documents, str):
        connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{documents}/documents.parquet'")
    else:
        connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
        if documents:
            connection.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", documents)
    cursor = connection.execute(sql)
    names = [c[0] for c in cursor.description]
    order = sorted(names)
    return order, sorted(tuple(r[names.index(c)] for c in order) for r in cursor.fetchall())


def spark_rows(frame):
    order = sorted(frame.columns)
    return order, sorted(tuple(r) for r in frame.select(order).collect())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, DATA)) == duck_rows(ORACLE[name], DATA)


def digest_lines(docs):
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@pytest.mark.parametrize("rows", [odd_documents(), []], ids=["odd", "empty"])
def test_rules_agree_with_sql_on_odd_texts(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    assert spark_rows(digest_lines(docs)) == duck_rows(ORACLE["op3_line_dedup"], rows)
    assert spark_rows(quality_rules(docs)) == duck_rows(ORACLE["op6_quality_rules"], rows)


def test_shared_lines_stay_in_the_largest_document_only(odd):
    found = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in line_dedup(odd).collect()}
    assert found[0] == found[1] == (1, 0, "")
    assert found[4][1:] == (1, "") and found[6] == (2, 1, "own line") and found[7] == (3, 2, "x")
    assert found[8] == (2, 1, "") and found[19] == (1, 0, LINE)


def test_line_dedup_keeps_other_columns_and_rows_without_id(spark):
    rows = [(None if i < 2 else i, LINE, "clash", i, i) for i in range(8)] + [(7, LINE, "again", 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, doc string, n_lines int, place int")
    found = line_dedup(docs)
    assert sorted(found.columns) == ["doc", "doc_id", "n_dropped", "n_lines", "place", "text"]
    got = sorted(((r.doc_id if r.doc_id is not None else -1), r.doc, r.text, r.n_dropped) for r in found.collect())
    assert got[:2] == [(-1, "clash", LINE, 0)] * 2
    assert [g[3] for g in got[2:]] == [1] * 5 + [0, 0]


def test_sketch_bins_are_ordered_and_close(spark):
    values = [0, 1, 63, 64, 65, 127, 128, 1000, 12345, 1 << 40]
    bins = [r.b for r in spark.createDataFrame([(v,) for v in values], "v bigint").select(bin_of(F.col("v")).alias("b")).collect()]
    assert all(b <= v <= b * (1 + 1 / 32) for b, v in zip(bins, values)) and bins == sorted(bins)


def brute_fingerprint(text, n=3):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints():
    for text in [*ODD_TEXTS, "Ä b C d E f"]:
        assert fingerprint(text) == brute_fingerprint(text)


def near(values, radius):
    return {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if int(values[i] ^ values[j]).bit_count() <= radius}


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 6])
def test_bit_sliced_comparison_finds_the_close_pairs(radius):
    rng = random.Random(radius)
    groups, want, base = [], set(), 0
    for size in (1, 2, 63, 64, 65, 200):
        seeds = [rng.getrandbits(64) for _ in range(4)]
        own = np.array([rng.choice(seeds) ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) & (2**64 - 1) for _ in range(size)], np.uint64)
        want |= {(i + base, j + base) for i, j in near(own, radius)}
        groups.append(own.view(np.int64))
        base += size
    found = {(int(a), int(b)) for x, y in linked(groups, radius) for a, b in zip(x, y)}
    assert found == want


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_connected_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1040)] + [(5000, i) for i in range(6000, 6050)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame([*links, (7, 7), (None, 3)], "a bigint, b bigint")).collect()}
    want = components({x for link in links for x in link}, links)
    assert found == {n: r for n, r in want.items() if any(n in link and link[0] != link[1] for link in links)}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def check_groups(rows, found):
    prints = [fingerprint(t) for _, t in rows]
    roots = components(range(len(rows)), near(prints, 2))
    least = {}
    for i, root in roots.items():
        least[root] = min(least.get(root, math.inf), rows[i][0])
    want = sorted((rows[i][0], f"{prints[i]:016x}", least[root]) for i, root in roots.items())
    assert sorted(tuple(r) for r in found.collect()) == want


def test_simhash_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    check_groups(rows, QUERIES["op5_simhash_near_dedup"](spark, DATA))


def test_simhash_odd_texts_large_groups_and_clashing_names(spark):
    base = [f"w{i}" for i in range(400)]
    texts = [*ODD_TEXTS, *[" ".join(base[:k] + ["changed"] + base[k + 1 :]) for k in range(0, 400, 5)], *[" ".join(base)] * 30]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id bigint, text string, fingerprint int, least string")
    check_groups(rows, simhash_groups(docs))
    assert simhash_groups(docs.limit(0)).count() == 0
    unnamed = simhash_groups(spark.createDataFrame([(None, "a b c d"), (3, "a b c d"), (None, "q")], "doc_id bigint, text string")).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in unnamed) == [(-1, -1), (-1, 3), (3, 3)]


def test_blocks_of_large_buckets_miss_nothing(spark, monkeypatch):
    from orderwake.llm import simhash

    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = random.Random(5)
    center = rng.getrandbits(63)
    values = sorted({center ^ (1 << rng.randrange(60)) ^ (1 << rng.randrange(60)) for _ in range(300)})
    found = simhash.near_links(spark.createDataFrame([(v,) for v in values], "fingerprint bigint"))
    links = [(values.index(r.a), values.index(r.b)) for r in found.collect()]
    assert components(range(len(values)), links) == components(range(len(values)), near(values, 2))


def brute_substrings(rows, size=13):
    words = [(t or "").encode().split() for _, t in rows]
    least = {}
    for (doc, _), own in zip(rows, words):
        for i in range(len(own) - size + 1):
            key = tuple(own[i : i + size])
            least[key] = min(least.get(key, math.inf), math.inf if doc is None else doc)
    out = []
    for (doc, _), own in zip(rows, words):
        gone = [False] * len(own)
        for i in range(len(own) - size + 1):
            if least[tuple(own[i : i + size])] < (math.inf if doc is None else doc):
                gone[i : i + size] = [True] * size
        kept = b" ".join(w for w, g in zip(own, gone) if not g)
        out.append((-1 if doc is None else doc, len(own), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found_substrings(frame):
    rows = frame.select("doc_id", "n_words", "n_removed", F.sha2("text", 256)).collect()
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in rows)


def test_substring_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert sorted(tuple(r) for r in QUERIES["op7_substring_dedup"](spark, DATA).collect()) == brute_substrings(rows)


@pytest.mark.parametrize("size", [1, 2, 3, 4, 13])
def test_substring_dedup_on_small_alphabets(spark, size):
    rng = random.Random(size)
    pool = ["a", "b", "é"] if size < 13 else ["a"]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randrange(30)))) for i in range(40)]
    passage = " ".join(f"p{i}" for i in range(25))
    rows += [(50 + i, f"x{i} " * (i % 9) + passage + f" y{i}\t\n{passage[: 10 * i]}") for i in range(30)]
    rows += [(None, passage), (None, passage), (70, None), (71, ""), (60, passage + " other text"), (60, "first " + passage), (-5, passage[30:])]
    docs = spark.createDataFrame([(i, t, 0, b"x") for i, t in rows], "doc_id bigint, text string, key int, place binary")
    assert found_substrings(substring_dedup(docs.repartition(5), window=size)) == brute_substrings(rows, size)
    assert substring_dedup(docs.limit(0)).count() == 0


def test_substring_dedup_in_many_groups(spark):
    rng = random.Random(11)
    passages = [" ".join(f"p{n}x{i}" for i in range(rng.randrange(10, 40))) for n in range(12)]
    texts = [" ".join([f"own{i}", *rng.choices(passages, k=rng.randrange(3)), f"end{i}"]) for i in range(200)]
    # A third without id, a third with one id, equal rows among both.
    rows = [((None, 7, i)[i % 3], t) for i, t in enumerate(texts)] + [(None, texts[0])] * 3 + [(7, texts[1])] * 3 + [(None, " "), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    brute = brute_substrings(rows)
    assert sum(r[2] for r in brute) > 1_000
    for group_bytes in (60, 1_000, 8_000_000):
        assert found_substrings(substring_dedup(docs, group_bytes=group_bytes)) == brute


def test_rows_without_id_or_words_are_spread(spark):
    texts = [(None, f"text {i}") for i in range(2_000)]
    spread = dealt_out(spark.createDataFrame(texts, "doc bigint, text string"), 20).groupBy("key").count().collect()
    assert len(spread) == 20 and max(r["count"] for r in spread) < 200
    empty = dealt_out(spark.createDataFrame([(None, " "), (None, None)] * 400, "doc bigint, text string").repartition(8), 1_000)
    assert empty.select("key").distinct().count() == 8
