"""Labels of single lines, and long labelled documents in the fit of the quality field."""

import numpy as np

from orderwake.llm.common import fair_share
from orderwake.llm.quality_crf import FIT_LINES, fit_field, fit_quality, line_features, line_labels, quality_scores

GOOD, BAD = "plain words in a line of text\nand one more line", "### $$$ | a | b\n%%% &&& !!"


def test_each_line_has_a_label(spark):
    features, _, per_text = line_features([GOOD] * 20 + [BAD] * 20)
    model = fit_field(features, per_text, np.array([1] * 20 + [0] * 20))
    texts = [None, "", GOOD, BAD, GOOD + "\n" + "\n".join([BAD] * 4)]
    docs = spark.createDataFrame([*enumerate(texts), (None, GOOD)], "doc_id bigint, text string")
    found = {r.doc_id: r for r in line_labels(docs, model).collect()}
    assert [len(found[i].line_labels) for i in range(5)] == [1, 1, 2, 2, 10] and found[None].line_labels == [1, 1]
    assert found[2].line_labels == [1, 1] and found[3].line_labels == [0, 0]
    assert found[4].line_labels[0] == 1 and found[4].line_labels[2:] == [0] * 8
    for r in quality_scores(docs.where("doc_id is not null"), model).collect():
        weight = [len(line) + 1 for line in (texts[r.doc_id] or "").split("\n")]
        assert np.isclose(r.score, np.average(found[r.doc_id].line_scores, weights=weight))
    assert line_labels(docs.limit(0), model).count() == 0


def test_long_labelled_documents_count_in_the_fit(spark):
    # Without the long document only one label is left, and every text scores the same.
    rows = [(i, GOOD) for i in range(20)] + [(20, "\n".join([BAD] * FIT_LINES))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 20)) for i, _ in rows], "doc_id bigint, quality int")
    for total in (400_000, 400):
        good, bad = fit_quality(docs, labels, fit_total=total).scores([GOOD, rows[-1][1]])
        assert good > 0.5 > bad


def test_cut_chains_use_every_line():
    features, _, per_text = line_features([GOOD * 30, "\n".join([BAD] * 25)])
    whole, cut = (fit_field(features, per_text, np.array([1, 0]), longest=n) for n in (1_000, 7))
    assert np.allclose(whole.mean, cut.mean) and np.allclose(whole.spread, cut.spread)
    assert cut.scores([GOOD])[0] > 0.5 > cut.scores([BAD])[0]


def test_fair_share():
    assert fair_share({3: 2, 10: 1}, 16) == 10 and fair_share({3: 2, 10: 1}, 15) == 9 and fair_share({3: 2, 10: 1}, 6) == 2
    assert fair_share({5: 4}, 2) == 1 and fair_share({}, 9) == 1
