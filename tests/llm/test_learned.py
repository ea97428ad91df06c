"""Quality classifier, language identification, token counts, pieces, and the pipeline."""

import hashlib
import itertools
import random

import numpy as np
import pytest
import regex
from conftest import DATA

import corpus_pipeline
from orderwake.llm.decontaminate import ERROR_RATE, ItemBlock, normalised
from orderwake.llm.language_id import LanguageModel, SCRIPTS, Words, fit_languages, language_spans, split_words
from orderwake.llm.pieces import decode, decode_pieces, default_model, encode_batch, encode_pieces, marked_words, vocabulary
from orderwake.llm.quality_crf import FEATURES, fit_field, fit_quality, forward_backward, keep_good, line_features, quality_scores, with_neighbours
from orderwake.llm.queries import QUERIES
from orderwake.llm.simhash import fingerprint
from orderwake.llm.token_counts import EDITS, PretokenTree, cleaning_edits, counter, default_ranks, recount, token_trees

ODD = [None, "", "\n\n", "123 456", "The and of", "x" * 40_000, "a\x00b", "  two  spaces ", "héé 中文 🙂 \n\t q", "the the the"]


def odd_rows(spark):
    return spark.createDataFrame([(i, t, "1", 2) for i, t in enumerate(ODD)] + [(4, ODD[4], "1", 2), (None, "q", None, None)], "doc_id bigint, text string, label string, score int")


# Quality


def test_forward_backward_against_all_labellings():
    rng = np.random.default_rng(1)
    per_text = np.array([3, 1, 4, 2])
    emissions, transitions = rng.normal(size=(10, 2)), rng.normal(size=(2, 2))
    marginals, pairs, total = forward_backward(emissions, transitions, per_text)
    want, moves, logs, at = np.zeros((10, 2)), np.zeros((2, 2)), 0.0, 0
    for n in per_text:
        paths = list(itertools.product((0, 1), repeat=int(n)))
        weight = np.array([np.exp(sum(emissions[at + i, p] for i, p in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:]))) for path in paths])
        logs += np.log(weight.sum())
        weight /= weight.sum()
        for path, w in zip(paths, weight):
            for i, p in enumerate(path):
                want[at + i, p] += w
            for a, b in zip(path, path[1:]):
                moves[a, b] += w
        at += n
    assert np.allclose(marginals, want) and np.allclose(pairs, moves) and np.isclose(total, logs)


def test_neighbour_features_stop_at_the_text():
    features = np.arange(1, 2 * len(FEATURES) * 2 + 1, dtype=float).reshape(4, len(FEATURES))
    rows, width = with_neighbours(features, np.array([3, 1])), len(FEATURES)
    assert (rows[0, width : 2 * width] == 0).all() and (rows[1, width : 2 * width] == features[0]).all()
    assert (rows[2, 2 * width : 3 * width] == 0).all() and (rows[3, width : 3 * width] == 0).all()


def test_field_learns_lines_and_scores_odd_texts():
    good, bad = ["plain words in a line of text\nand one more line"] * 20, ["### $$$ | a | b\n%%% &&& !!"] * 20
    features, _, per_text = line_features(good + bad)
    model = fit_field(features, per_text, np.array([1] * 20 + [0] * 20))
    assert model.scores(good[:1])[0] > 0.8 > 0.2 > model.scores(bad[:1])[0]
    mixed = model.scores([good[0] + "\n" + bad[0] * 5])[0]
    assert model.scores(bad[:1])[0] < mixed < model.scores(good[:1])[0]
    odd = model.scores([t or "" for t in ODD])
    assert ((odd >= 0) & (odd <= 1)).all() and odd[0] == odd[1]
    together = model.scores(good + bad)
    assert np.allclose(together[:20], model.scores(good[:1])[0]) and np.allclose(together[20:], model.scores(bad[:1])[0])


def test_quality_query_on_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    rows = QUERIES["op2_quality_classifier"](spark, DATA).collect()
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(rows) == 200 and held and sum(a == b for a, b in held) / len(held) > 0.9
    assert all((r.score >= 0.3) == bool(r.predicted) and 0 <= r.score <= 1 for r in rows)


def test_quality_of_odd_rows_and_few_labels(spark):
    docs = odd_rows(spark)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    for labels in (none, spark.createDataFrame([(4, 1), (None, 0), (7, None)], "doc_id bigint, quality int")):
        model = fit_quality(docs, labels)
        assert quality_scores(docs, model).count() == 12 and keep_good(docs, model).schema == docs.schema
    assert quality_scores(docs.limit(0), model).count() == 0


# Languages


def brute_labels(scores, switch):
    best, path = -np.inf, None
    for labels in itertools.product(range(scores.shape[1]), repeat=len(scores)):
        total = sum(scores[i, x] for i, x in enumerate(labels)) - switch * sum(a != b for a, b in zip(labels, labels[1:]))
        if total > best + 1e-9:
            best, path = total, labels
    return best, path


def test_language_search_against_all_labellings():
    rng = np.random.default_rng(2)
    per_text = np.array([4, 0, 6, 1])
    model = LanguageModel(["a", "b", "c"], rng.normal(size=(1 << 16, 3)), np.ones((len(SCRIPTS), 3), bool))
    n = int(per_text.sum())
    words = Words(np.zeros(n, int), np.zeros(n, int), np.ones(n, int), per_text, np.arange(n), rng.integers(0, 1 << 16, n))
    labels, scores, at = model.label(words, 0.7), model.word_scores(words), 0
    for size in per_text:
        own = labels[at : at + size]
        total = sum(scores[at + i, x] for i, x in enumerate(own)) - 0.7 * (np.diff(own) != 0).sum()
        assert np.isclose(total, brute_labels(scores[at : at + size], 0.7)[0]) if size else True
        at += size


def test_words_split_by_script_and_text():
    words = split_words(["Über die", "", "abcДеж 中文x"])
    assert words.per_text.tolist() == [2, 0, 4] and words.size.tolist() == [4, 3, 3, 3, 2, 1] and words.start.tolist() == [0, 5, 0, 3, 7, 9]


def test_mixed_text_has_spans(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = fit_languages(docs)
    texts = {lang: docs.where(f"lang = '{lang}' and n_chars > 600").orderBy("doc_id").first().text[:300] for lang in ("en", "de")}
    mixed = spark.createDataFrame([(1, texts["en"] + "\n" + texts["de"])], "doc_id bigint, text string")
    spans = language_spans(mixed, model).first().spans
    assert [s.lang for s in spans] == ["en", "de"] and abs(spans[1].start - 301) < 20


def test_language_query_on_held_out_documents(spark):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = QUERIES["op9_language_id"](spark, DATA).collect()
    held = [langs[r.doc_id] == r.lang_pred for r in rows if r.held_out]
    assert len(rows) == 200 and sum(held) / len(held) > 0.95


def test_language_of_odd_rows(spark):
    docs = odd_rows(spark)
    model = fit_languages(spark.createDataFrame([(1, "the and of", "en"), (2, "und die der", "de"), (3, None, "fr"), (4, "x", None)], "doc_id bigint, text string, lang string"))
    assert model.languages == ["de", "en"]
    found = [(r.doc_id, r.lang_pred, r.score) for r in language_spans(docs, model).collect()]
    assert len(found) == 12 and {(i, p, s) for i, p, s in found if i in (0, 1, 2, 3)} == {(i, "und", 0.0) for i in range(4)}
    assert (4, "en", 1.0) in found and all(0 <= s <= 1 for _, _, s in found)
    empty = fit_languages(spark.createDataFrame([], "doc_id bigint, text string, lang string"))
    assert {r.lang_pred for r in language_spans(docs, empty).collect()} == {"und"}
    assert language_spans(docs.limit(0), model).count() == 0


# Token counts


def test_edited_trees_equal_a_full_encoding():
    counts, rng = counter(default_ranks()), random.Random(7)
    letters = "ab  \n\n'sretv.,!?1  2é中\t'l\x1c\x85"
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 40, 200])))
        chars, tokens = (np.array(x, "<i4") for x in counts.leaves(text))
        assert tokens.sum() == len(counts.encoding.encode_ordinary(text))
        tree = PretokenTree(text, chars, tokens, counts)
        for _ in range(rng.choice([1, 3, 8])):
            at, cut = rng.randint(-1, len(text) + 2), rng.choice([-1, 0, 1, 3, 20])
            put = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 10])))
            a = min(max(at, 0), len(text))
            text = text[:a] + put + text[a + max(0, cut) :]
            tree.edit(at, cut, put)
        assert tree.state(chars, tokens) == (text, *counts.leaves(text))
        assert tree.tokens[1] == len(counts.encoding.encode_ordinary(text)) and tree.chars[1] == len(text)


def test_an_edit_encodes_its_surroundings_only():
    counts = counter(default_ranks())
    text = "some words of a long text " * 2_000
    chars, tokens = (np.array(x, "<i4") for x in counts.leaves(text))
    tree = PretokenTree(text, chars, tokens, counts)
    tree.edit(25_000, 3, "xyz")
    assert tree.encoded < 10 and tree.tokens[1] == len(counts.encoding.encode_ordinary(text[:25_000] + "xyz" + text[25_003:]))


def test_token_count_query_against_a_full_encoding(spark):
    encode = counter(default_ranks()).encoding.encode_ordinary
    found = {r.doc_id: r for r in QUERIES["op1_token_counts"](spark, DATA).collect()}
    rows = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    assert len(found) == len(rows) and any(r.n_edits for r in found.values())
    for row in rows:
        seen, lines = set(), []
        for line in row.text.split("\n"):
            if line not in seen or not line:
                lines.append(regex.sub("[0-9]+", "0", line))
            seen.add(line)
        clean, r = "\n".join(lines), found[row.doc_id]
        assert (r.n_before, r.n_tokens) == (len(encode(row.text)), len(encode(clean)))
        assert r.edited_sha256 == hashlib.sha256(clean.encode()).hexdigest()


def test_token_counts_of_odd_rows(spark):
    edits = [[{"at": 1, "cut": 2, "put": "zz"}, None], None, [], [{"at": None, "cut": None, "put": None}], [{"at": 99, "cut": 9, "put": " end"}]]
    docs = spark.createDataFrame([(i, t, edits[i % 5], "clash") for i, t in enumerate(ODD)], f"doc_id bigint, text string, changes {EDITS}, n_tokens string")
    found = {r.doc: r for r in recount(token_trees(docs, edits_col="changes")).collect()}
    encode = counter(default_ranks()).encoding.encode_ordinary
    assert len(found) == len(ODD) and all(r.n_tokens == len(encode(r.text)) and r.n_before == len(encode(ODD[i] or "")) for i, r in found.items())
    assert found[0].text == "zz" and found[4].text == "The and of end" and found[9].text.endswith("the end")
    assert recount(token_trees(docs.limit(0))).count() == 0
    assert cleaning_edits(None) == [] and cleaning_edits("a1\na1\n22") == [{"at": 6, "cut": 2, "put": "0"}, {"at": 2, "cut": 3, "put": ""}, {"at": 1, "cut": 1, "put": "0"}]


# Pieces


def brute_score(word, scores, unknown):
    best = [0.0] + [-np.inf] * len(word)
    for end in range(1, len(word) + 1):
        best[end] = best[end - 1] + unknown
        for at in range(max(0, end - 16), end):
            if word[at:end] in scores:
                best[end] = max(best[end], best[at] + scores[word[at:end]])
    return best[-1]


@pytest.fixture(scope="module")
def texts(spark):
    return [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect()]


def test_segments_have_the_best_score(texts):
    import sentencepiece

    vocab, model = vocabulary(default_model()), sentencepiece.SentencePieceProcessor(model_file=default_model())
    scores = {model.id_to_piece(i).replace("▁", " "): model.get_score(i) for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    words = sorted(set(itertools.chain.from_iterable(marked_words(t) for t in texts[:20] + ["日本語 テキスト x", "   three spaces"])))
    for word, ids in zip(words, vocab.segment(words)):
        spelled = b"".join(vocab.raw[i] for i in ids).decode()
        assert spelled == word
        if not any(model.is_byte(i) for i in ids):
            assert sum(model.get_score(i) for i in ids) == brute_score(word, scores, vocab.unknown_score)


def test_agrees_with_the_library_under_the_unigram_rule(texts):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(default_model(), "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    vocab, checked = vocabulary(default_model()), 0
    for text in [t for t in texts if 0 < len(t) < 400]:
        words = [w for w in marked_words(text) if "  " not in w]
        if len(words) == len(marked_words(text)) and "\n" not in text:
            ids, _, _ = encode_batch([text], vocab)
            best = library.nbest_encode(text, nbest_size=2)[0]
            score = lambda own: sum(library.get_score(i) for i in own)
            assert score(ids.tolist()) >= score(best) and library.decode(ids.tolist()) == text
            checked += 1
    assert checked


def test_pieces_round_trip(spark, texts):
    vocab = vocabulary(default_model())
    some = [t for t in ODD if t] + texts[:60]
    ids, sizes, _ = encode_batch(some, vocab)
    ends = np.cumsum(sizes)
    assert [decode(ids[e - n : e].tolist(), vocab) for e, n in zip(ends, sizes)] == some
    docs = odd_rows(spark)
    back = decode_pieces(encode_pieces(docs), text_col="back").collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.back) for r in back) == sorted([(i, t or "") for i, t in enumerate(ODD)] + [(4, ODD[4]), (-1, "q")])
    assert encode_pieces(docs.limit(0)).count() == 0
    query = QUERIES["op4_sentencepiece"](spark, DATA).collect()
    digests = {hashlib.sha256(t.encode()).hexdigest() for t in texts}
    assert len(query) == 200 and {r.decoded_sha256 for r in query} == digests and all(r.n_pieces == len(r.pieces) for r in query)


# Pipeline


def brute_pipeline(spark):
    """The stages over plain Python rows; the classifier's model is fitted by the operator."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = fit_quality(docs, spark.read.parquet(f"{DATA}/labels.parquet").where("crc32(cast(doc_id as string)) % 5 != 0"))
    rows = [r.asDict() for r in docs.orderBy("doc_id").collect()]
    rows = [r for r in rows if model.scores([r["text"]])[0] >= 0.3]
    holders = {}
    key = lambda line: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\f\r"))
    for r in rows:
        for line in r["text"].split("\n"):
            holders.setdefault(key(line), set()).add(r["doc_id"])
    shared = {k: max(v) for k, v in holders.items() if len(k) >= 40 and len(v) >= 5}
    for r in rows:
        r["text"] = "\n".join(line for line in r["text"].split("\n") if shared.get(key(line), r["doc_id"]) == r["doc_id"])
    prints = [fingerprint(r["text"]) for r in rows]
    group = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 2:
            a, b = group[i], group[j]
            group = [min(a, b) if g in (a, b) else g for g in group]
    rows = [r for i, r in enumerate(rows) if group[i] == i]
    items = ItemBlock([(r.item_id, normalised(r.text)) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()], ERROR_RATE)
    return {r["doc_id"]: r["text"] for r in rows if not list(items.matches(normalised(r["text"])))}


def test_pipeline_against_brute_force(spark):
    want = brute_pipeline(spark)
    found = corpus_pipeline.run(spark, DATA).collect()
    assert {r.doc_id: r.decoded_sha256 for r in found} == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in want.items()}
    assert len(found) == len(want) < 200


def test_stages_keep_the_columns_and_survive_an_empty_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and docs.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).count() == 0
