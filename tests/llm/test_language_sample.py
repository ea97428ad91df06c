"""The sample that languages are learned from."""

from orderwake.llm import language_id

SCHEMA = "doc_id bigint, text string, lang string"


def sample(spark, monkeypatch, rows, fit_docs):
    """Languages learned, and rows used for each."""
    used, map_texts = [], language_id.map_texts

    def seen(frame, *args):
        used.append({r["lang"]: r["count"] for r in frame.groupBy("lang").count().collect()})
        return map_texts(frame, *args)

    monkeypatch.setattr(language_id, "map_texts", seen)
    model = language_id.fit_languages(spark.createDataFrame(rows, SCHEMA).repartition(4), fit_docs=fit_docs)
    return model.languages, used[0]


def test_rare_languages_are_learned(spark, monkeypatch):
    rows = [(i, f"the words of number {i}", "en") for i in range(300)] + [(900 + i, f"die Worte {i}", "de") for i in range(60)]
    rows += [(i, "rare ord", lang) for i, lang in enumerate(("da", "sv", "nb", "fi"), 2_000)]
    languages, used = sample(spark, monkeypatch, rows, 24)
    assert languages == ["da", "de", "en", "fi", "nb", "sv"]
    assert used == {"da": 1, "sv": 1, "nb": 1, "fi": 1, "de": 10, "en": 10}


def test_missing_and_repeated_ids_do_not_exceed_the_sample(spark, monkeypatch):
    rows = [(None, f"the words of number {i}", "en") for i in range(100)] + [(5, f"die Worte {i}", "de") for i in range(100)]
    assert sample(spark, monkeypatch, rows, 20)[1] == {"en": 10, "de": 10}
