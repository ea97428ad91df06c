"""Rule filter whose cut-offs follow each language and source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderwake.llm.common import SPACE_CLASS, durable

#: Per measure: the least spread between the quartiles, in thousandths, and whether small values are odd too.
LEAST_SPREAD = {"symbols": (50, False), "dup_lines": (100, False), "repeat_words": (100, False), "word_length": (400, True)}


def text_measures(docs: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    """Counts of words, characters, symbols, repeated lines and repeated three-word windows of each text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    word = f"[^{SPACE_CLASS}]+"
    split = docs.select(
        F.col(id_col).alias("doc"),
        *(F.col(c).alias(f"group{i}") for i, c in enumerate(keep)),
        F.length(text).alias("chars"),
        F.regexp_count(text, F.lit(f"[{SPACE_CLASS}]")).alias("spaces"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).alias("n_symbols"),
        F.transform(F.regexp_extract_all(text, F.lit(word), F.lit(0)), lambda w: F.xxhash64(w)).alias("words"),
        F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(" \t\n\x0b\f\r")) != "").alias("lines"),
    )
    starts = F.when(F.size("words") >= 3, F.sequence(F.lit(0), F.size("words") - 3)).otherwise(F.array().cast("array<int>"))
    windows = F.array_sort(
        F.transform(starts, lambda i: F.struct(F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)).alias("h"), i.alias("at")))
    )
    sorted_windows = split.select("*", windows.alias("windows"))
    window = lambda i: F.get("windows", i)
    repeated = F.filter(
        F.transform("windows", lambda w, i: F.when((window(i - 1)["h"] == w["h"]) | (window(i + 1)["h"] == w["h"]), w["at"])),
        lambda at: at.isNotNull(),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("repeated", lambda at: F.array(at, at + 1, at + 2)))))
    return sorted_windows.select("*", repeated.alias("repeated")).select(
        "doc",
        *(f"group{i}" for i in range(len(keep))),
        F.size("words").cast("long").alias("n_words"),
        (F.col("chars") - F.col("spaces")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
    )


def _per_thousand(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.expr(f"(1000 * {part}) div {whole}"))


def bin_of(value: Column) -> Column:
    """The sketch's bin of a whole number: exact below 64, then 32 bins for each power of two.

    A bin is named by its lowest value, so that bins are ordered and an estimate is at most 1/32 too low.
    """
    step = F.pow(F.lit(2.0), F.greatest(F.length(F.bin(value)) - 6, F.lit(0))).cast("long")
    return value - value % step


def sketch_quartiles(values: DataFrame, groups: list[str]) -> DataFrame:
    """First and third quartile of `value` per group, from counts per bin.

    The counts are a quantile sketch that merges by addition: partial sketches are summed before and after
    the shuffle, in any order, with the same result. A group has some 32 bins for each power of two.
    """
    bins = values.where(F.col("value").isNotNull()).groupBy(*groups, bin_of(F.col("value")).alias("bin")).count()
    upto = Window.partitionBy(*groups).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*groups)
    ranked = bins.select(*groups, "bin", F.sum("count").over(upto).alias("upto"), F.sum("count").over(whole).alias("n"))
    return ranked.groupBy(*groups).agg(
        F.min(F.when(4 * F.col("upto") >= F.col("n"), F.col("bin"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("n"), F.col("bin"))).alias("q3"),
    )


def quality_rules(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_cols: tuple[str, ...] = ("lang", "source"),
    fence: int = 3,
    min_words: int = 50,
    max_repeat_percent: int = 50,
) -> DataFrame:
    """One verdict per document from fixed base rules and cut-offs learned per group.

    Four measures in thousandths (symbols per word, repeated lines per line, words in repeated three-word
    windows per word, mean word length) are gathered per language and source in a quantile sketch. A document
    passes if each measure is at most q3 + fence * max(q3 - q1, least spread) of its group (mean word length:
    also at least q1 minus as much). The thresholds are joined to the measures, which are computed once.

    Returns the id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed, kept
    (boolean) and a boolean for each rule (high_symbols ...). Null and empty texts have no words and fail the
    base rules; null group values form a group of their own; repeated rows count each time; a group of one
    document sets its own cut-offs; an empty table gives no rows. Extra input columns are not read.
    """
    groups = [f"group{i}" for i in range(len(group_cols))]
    measured = durable(text_measures(docs, id_col, text_col, group_cols))
    rated = measured.select(
        "*",
        _per_thousand("n_symbols", "n_words").alias("symbols"),
        _per_thousand("n_dup_lines", "n_lines").alias("dup_lines"),
        _per_thousand("n_repeat_words", "n_words").alias("repeat_words"),
        _per_thousand("word_chars", "n_words").alias("word_length"),
    )
    long = rated.select(*groups, F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in LEAST_SPREAD))).alias("pair")).select(*groups, "pair.*")
    quartiles = sketch_quartiles(long, [*groups, "measure"])
    limits = []
    for measure, (least, both) in LEAST_SPREAD.items():
        own = lambda column, m=measure: F.max(F.when(F.col("measure") == m, F.col(column)))
        room = fence * F.greatest(own("q3") - own("q1"), F.lit(least))
        limits.append((own("q3") + room).alias(f"most_{measure}"))
        if both:
            limits.append((own("q1") - room).alias(f"least_{measure}"))
    cut_offs = quartiles.groupBy(*groups).agg(*limits)
    same_group = [rated[g].eqNullSafe(cut_offs[g]) for g in groups]
    broken = {f"high_{m}": F.coalesce(F.col(m) > F.col(f"most_{m}"), F.lit(False)) for m in LEAST_SPREAD}
    broken |= {f"low_{m}": F.coalesce(F.col(m) < F.col(f"least_{m}"), F.lit(False)) for m, (_, both) in LEAST_SPREAD.items() if both}
    base_failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    kept = ~base_failed
    for rule in broken.values():
        kept = kept & ~rule
    return rated.join(cut_offs, same_group, "left").select(
        F.col("doc").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        kept.alias("kept"),
        *(rule.alias(name) for name, rule in broken.items()),
    )
