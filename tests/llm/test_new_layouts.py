"""Sharding, the Merkle manifest and fill-in-the-middle texts: SQL, brute force, round trips and odd input."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from conftest import DATA
from test_text_rules import SCHEMA, duck_rows, odd_documents, spark_rows

from orderwake.llm import fill_in_middle as fim
from orderwake.llm import frames as frames_module
from orderwake.llm.frames import UNIT, Frames
from orderwake.llm.manifest import OpenTree, folded, joined_digest, manifest, siblings_digest
from orderwake.llm.numbering import numbered
from orderwake.llm.queries import LEAF, QUERIES
from orderwake.llm.sharding import jump, moved, shard_table, write_shards
from orderwake.llm.sql import ORACLE
from pyspark.sql import functions as F

NEW = ["op11_sharding", "op12_manifest", "op13_fill_in_middle"]
EXTRA = [
    ("a <P> b", 900), ("<S>", 901), ("mark <M", 902), ("word " * 5000, 903), ("x" * 70000 + " y", 904), (" \n\t", 905),
    ("\n\nlines\n\n", 906), ("é ü 漢字 🙂 " * 700, 907), ("same", 908), ("same", 909), ("trailing \n " * 1500 + "\n\n", 910),
]


def documents():
    rows = odd_documents() + [(i, t, None, "s2", len(t)) for t, i in EXTRA]
    return rows + [(1000 + i, f"text {i}\nand more", "en", "hot", 5) for i in range(200)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    made = str(tmp_path_factory.mktemp("layouts"))
    spark.createDataFrame(documents(), SCHEMA).repartition(5).write.parquet(f"{made}/documents.parquet")
    return made


@pytest.mark.parametrize("name", NEW)
def test_agrees_with_sql_on_odd_texts(spark, folder, name):
    assert spark_rows(QUERIES[name](spark, folder)) == duck_rows(ORACLE[name], documents())


@pytest.mark.parametrize("name", NEW)
def test_agrees_with_sql_on_the_given_table(spark, name):
    assert spark_rows(QUERIES[name](spark, DATA)) == duck_rows(ORACLE[name], DATA)


@pytest.mark.parametrize("name", NEW)
def test_empty_table(spark, tmp_path, name):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES[name](spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("name", NEW)
def test_repeated_rows_missing_ids_and_clashing_columns(spark, tmp_path, name):
    rows = [(i, t, lang, source, n, "mine", "own", 7, {"a": 1}) for i, t, lang, source, n in [*odd_documents(), *odd_documents()[:6]]]
    rows += [(None, "no id", None, None, None, "mine", "own", 7, {})] * 9
    extra = "size string, shard string, place int, grp map<string,int>"
    spark.createDataFrame(rows, f"{SCHEMA}, {extra}").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES[name](spark, str(tmp_path)).collect()
    assert len(found) == len(rows) and sum(r["doc_id"] is None for r in found) == 9


# --- numbering and sharding --------------------------------------------------------------------


def test_numbers_are_gapless_and_ordered_in_a_hot_group(spark):
    rows = [("hot", i % 50) for i in range(3000)] + [(None, i) for i in range(40)] + [(f"g{i}", 1) for i in range(60)]
    found = numbered(spark.createDataFrame(rows, "g string, v int").repartition(7), "g", ["v"]).collect()
    groups = {}
    for r in found:
        groups.setdefault(r["g"], []).append((r["place"], r["v"], r["size"]))
    assert len(found) == len(rows)
    for members in groups.values():
        members.sort()
        assert [m[0] for m in members] == list(range(len(members)))
        assert [m[1] for m in members] == sorted(m[1] for m in members)
        assert {m[2] for m in members} == {len(members)}


def plain_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jump_against_one_key_at_a_time():
    keys = [0, 1, 2**64 - 1, *(random.Random(3).randrange(2**64) for _ in range(3000))]
    for shards in (1, 2, 7, 16, 17, 1000):
        assert jump(np.array(keys, np.uint64), shards).tolist() == [plain_jump(k, shards) for k in keys]
    with pytest.raises(ValueError):
        jump(np.array([1], np.uint64), 0)


def test_only_the_needed_part_moves_and_only_into_new_shards(spark):
    ids = spark.range(40000).withColumnRenamed("id", "doc_id")
    changed = moved(ids, 16, 20).collect()
    assert all(r["to_shard"] >= 16 for r in changed)
    assert abs(len(changed) / 40000 - 4 / 20) < 0.01
    counts = shard_table(ids.withColumn("text", F.lit("t")), 20).groupBy("shard").count().collect()
    assert len(counts) == 20 and max(abs(r["count"] / 2000 - 1) for r in counts) < 0.15


def test_slots_of_a_hot_id(spark):
    docs = spark.createDataFrame([(5, "copy")] * 500 + [(i, f"t{i}") for i in range(300)], "doc_id bigint, text string").repartition(6)
    found = shard_table(docs).collect()
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
        text = "copy" if r["size"] == 5 and r["text_crc32"] == zlib.crc32(b"copy") else f"t{r['doc_id']}"
        assert (r["size"], r["text_crc32"]) == (len(text) + 1, zlib.crc32(text.encode()))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(found) == 800
    assert len({r["shard"] for r in found if r["doc_id"] == 5}) == 1


def test_written_shards_hold_all_rows_and_columns(spark, tmp_path):
    docs = spark.createDataFrame([(i % 50, f"t{i}", {"k": i}) for i in range(400)], "doc_id bigint, text string, more map<string,int>")
    write_shards(docs, f"{tmp_path}/out", 4, files=2)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(back.select("doc_id", "text", "more").collect(), key=repr) == sorted(docs.collect(), key=repr)
    expected = {r["doc_id"]: r["shard"] for r in shard_table(docs, 4).collect()}
    assert all(expected[r["doc_id"]] == r["shard"] for r in back.collect())
    with pytest.raises(ValueError):
        write_shards(docs.withColumn("shard", F.lit(1)), f"{tmp_path}/no", 4)


# --- manifest ----------------------------------------------------------------------------------


def plain_tree(leaves):
    """Root and witnesses, level by level."""
    witnesses, level, members = [[] for _ in leaves], leaves, [[i] for i in range(len(leaves))]
    while len(level) > 1:
        above, merged = [], []
        for at in range(0, len(level), 3):
            run = level[at : at + 3]
            for k in range(len(run)):
                for leaf in members[at + k]:
                    witnesses[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(joined_digest(run))
            merged.append(sum(members[at : at + 3], []))
        level, members = above, merged
    return level[0], witnesses


def fold(leaf, witness):
    for left, right in witness:
        leaf = hashlib.sha256((left + leaf + right).encode()).hexdigest()
    return leaf


@pytest.mark.parametrize("n", [*range(1, 30), 81, 82, 100, 243, 244])
def test_appended_nodes_give_the_tree(n):
    leaves = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(n)]
    tree = OpenTree()
    for leaf in leaves:
        tree.append(leaf)
    assert tree.close() == plain_tree(leaves)[0]
    assert tree.witnesses == plain_tree(leaves)[1]


def test_partial_witnesses_grow_with_their_siblings():
    tree = OpenTree()
    tree.append("a")
    assert tree.runs[0][0].right == []
    tree.append("b")
    assert tree.runs[0][0].right == ["b"] and tree.runs[0][1].left == ["a"]
    assert tree.witnesses == [[], []]
    tree.append("c")
    assert tree.witnesses == [[("", "bc")], [("a", "c")], [("ab", "")]]
    assert tree.runs[0] == [] and tree.runs[1][0].digest == joined_digest(["a", "b", "c"])


@pytest.mark.parametrize("height", [1, 2, 3, 8])
def test_blocks_of_any_height_give_one_manifest(spark, height):
    rng = random.Random(height)
    rows = [("big", i, f"t{i}") for i in range(200)] + [(None, i, "t") for i in range(10)] + [(f"s{i}", 1, "x") for i in range(13)]
    rows += [("pair", 1, "x"), ("pair", 1, "x"), ("pair", None, None)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "source string, doc_id int, text string").repartition(4)
    found = manifest(docs, ["doc_id", "source", "text"], height=height)
    found = found.select("*", siblings_digest(F.col("witness")).alias("proof"), folded(F.col("leaf"), F.col("witness")).alias("again")).collect()

    def leaf(row):
        source, doc, text = row
        framed = ["-" if v is None else f"{len(str(v))}:{v}" for v in (doc, source, text)]
        return hashlib.sha256("".join(framed).encode()).hexdigest()

    sources = {}
    for row in rows:
        sources.setdefault(row[0], []).append(row)
    expected, subroots = [], []
    ordered = sorted(sources, key=lambda s: (s is not None, s or ""))
    trees = {}
    for s in ordered:
        leaves = [leaf(r) for r in sorted(sources[s], key=lambda r: (r[1] is not None, r[1] or 0, leaf(r)))]
        trees[s] = (leaves, *plain_tree(leaves))
        subroots.append(trees[s][1])
    root, above = plain_tree(subroots)
    for at, s in enumerate(ordered):
        leaves, subroot, witnesses = trees[s]
        for digest, witness in zip(leaves, witnesses):
            whole = witness + above[at]
            assert fold(digest, whole) == root
            expected.append((digest, subroot, root, hashlib.sha256("".join(a + b for a, b in whole).encode()).hexdigest()))
    assert sorted((r["leaf"], r["subroot"], r["root"], r["proof"]) for r in found) == sorted(expected)
    assert {r["again"] for r in found} == {root}


def test_tampered_texts_are_told(spark, folder):
    found = {r["doc_id"]: r for r in QUERIES["op12_manifest"](spark, folder).collect()}
    for doc, text, *_ in documents():
        changed = zlib.crc32(str(doc).encode()) % 2 == 0 and "\n" in (text or "")
        assert found[doc]["verified"] is (not changed)
    assert LEAF[-1] == "text"


# --- fill in the middle ------------------------------------------------------------------------


def random_text(rng, words):
    return "".join(rng.choice(["a", "bb ", " \n", "\té", "漢", "<P", "> ", "xyz  "]) for _ in range(words))


@pytest.fixture
def short_frames(monkeypatch):
    """Frames of three units, so that short texts have many."""
    monkeypatch.setattr(frames_module, "FRAME_UNITS", 3)
    monkeypatch.setattr(frames_module, "_FULL", frames_module.re.compile(frames_module._FULL.pattern.replace("{1024}", "{3}")))


def test_frames_find_every_unit(short_frames):
    rng = random.Random(4)
    for words in (0, 1, 2, 5, 40, 80):
        text = random_text(rng, words)
        units, made = UNIT.findall(text), Frames.of(text)
        assert "".join(units) == text and made.n_units == len(units) and made.n_chars == len(text)
        assert "".join(made.stream()) == text
        assert not text or len(made.data) == -(-len(units) // 3)
        for a in range(len(units) + 1):
            assert made.offset(a) == len("".join(units[:a]))
            for b in range(a, len(units) + 1, 3):
                part = made.part(a, b)
                assert "".join(part.stream()) == "".join(units[a:b]) and part.n_units == b - a
        for _ in range(30):
            a, b = sorted(rng.randrange(len(text) + 1) for _ in range(2))
            assert "".join(made.stream(a, b)) == text[a:b]


def test_outputs_restore_the_text(short_frames):
    rng = random.Random(5)
    forms = set()
    for i in range(300):
        text = random_text(rng, rng.randrange(60))
        form, prefix, middle, output = fim.arranged(Frames.of(text), str(i))
        forms.add(form)
        assert "".join(fim.restored(output, form)) == text
        if form != "plain":
            parts = {"prefix": text[:prefix], "middle": text[prefix : prefix + middle], "suffix": text[prefix + middle :]}
            assert "".join(output.stream()) == "".join(mark + parts[name] for mark, name in fim.ORDERS[form])
        else:
            assert "".join(output.stream()) == text
    assert forms == {"plain", "psm", "spm"}


def test_marks_are_found_across_frames():
    assert fim._holds(["a <", "P", "> b"], fim.MARKS)
    assert not fim._holds(["a <", "P ", "> b"], fim.MARKS)
    assert not fim._holds([], fim.MARKS)


def test_texts_of_the_outputs(spark, folder):
    filled = fim.fill_in_middle(fim.frame_store(spark.read.parquet(f"{folder}/documents.parquet")))
    outputs = {r["id"]: r for r in fim.texts(filled).collect()}
    digests = {r["id"]: r["output_sha256"] for r in fim.digests(filled).collect()}
    assert {i: hashlib.sha256(r["output"].encode()).hexdigest() for i, r in outputs.items()} == digests
    assert {r["form"] for r in outputs.values()} == {"plain", "psm", "spm"}
