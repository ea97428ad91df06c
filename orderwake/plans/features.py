"""Feature preparation for the backorder classifier, as column expressions and bounded lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import finite_or_zero, number
from ..operators import BROADCAST_BYTES, hot_keys, lookup_join, row_bytes, running_totals
from ..operators.running import string_buckets
from .masters import ORDER_GRAIN

# Feature names.
NUMERIC_FEATURES = [
    "outstanding_qty",
    "saleable_inventory",
    "cumulative_order_quantity",
    "total_quantity_delivered",
    "net_value",
    "backorder_aging_days",
]
CATEGORICAL_FEATURES = ["material_type", "item_category"]

# The label is computed from these two, so a model that sees them only learns the formula.
LEAKY_FEATURES = ["outstanding_qty", "saleable_inventory"]

LABEL = "target_backorder_risk"
TEST_SHARE = 0.2
SEED_TEXT = "42"
DIGEST_PREFIX = 4  # hexadecimal digits: 65,536 cells per label


def feature_names(exclude_leaky: bool = False) -> list[str]:
    numeric = [c for c in NUMERIC_FEATURES if not (exclude_leaky and c in LEAKY_FEATURES)]
    return [*numeric, *(f"{c}_enc" for c in CATEGORICAL_FEATURES)]


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a category in alphabetical order, numbered from zero."""
    values = df.select(F.col(column).alias("category")).na.drop().distinct().withColumn("_one", F.lit(1))
    numbered = running_totals(string_buckets(values, "category"), "category", {"_number": "_one"})
    return numbered.select("category", (F.col("_number") - 1).cast("bigint").alias("code"))


def encoded_features(
    targets: DataFrame,
    keys: Sequence[str] = ORDER_GRAIN,
    label: str = LABEL,
    exclude_leaky: bool = False,
    category_length: int | None = None,
) -> DataFrame:
    """Keys, features and label: numbers without gaps, categories as alphabetical codes.

    A column that the table lacks counts as missing in every row. With `category_length` (20 in the
    classic feature list) categories that agree in so many first characters become one.
    """
    absent = [c for c in (*NUMERIC_FEATURES, *CATEGORICAL_FEATURES) if c not in targets.columns]
    targets = targets.withColumns({c: F.lit(None).cast("string") for c in absent})
    category = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in CATEGORICAL_FEATURES}
    if category_length is not None:
        category = {c: F.substring(e, 1, category_length) for c, e in category.items()}
    numeric = {c: finite_or_zero(number(targets, c)) for c in NUMERIC_FEATURES}
    rows = targets.filter(F.col(label).isNotNull()).select(
        *keys,
        *(e.alias(c) for c, e in numeric.items()),
        *(e.alias(c) for c, e in category.items()),
        F.col(label).cast("int").alias(label),
    )
    listed = rows
    for c in CATEGORICAL_FEATURES:
        codes = category_codes(listed, c).select(F.col("category").alias(c), F.col("code").alias(f"{c}_enc"))
        # Spark cannot tell how few values there are before it runs, and would shuffle all rows by them.
        if row_bytes(listed.select(c, F.lit(0)).distinct()) <= BROADCAST_BYTES:
            rows = lookup_join(rows, F.broadcast(codes), [c])
        else:
            rows = lookup_join(rows, codes, [c], hot_keys(listed, category=[c])["category"], keys)
    return rows.select(*keys, *feature_names(exclude_leaky), label)


def stratified_split(
    df: DataFrame, keys: Sequence[str] = ORDER_GRAIN, label: str = LABEL, test_share: float = TEST_SHARE
) -> DataFrame:
    """Add `is_test`: an exact share of each class, picked by the digest of the (unique) key.

    The test set holds ceil(share * rows); classes get their share by largest remainder. A row is in
    the test set when its digest does not exceed its class's cut-off. Finding the cut-off takes one
    count per digest prefix and a ranking of the single prefix that contains it; the split itself is
    a filter and moves no rows.
    """
    digest = F.md5(F.concat_ws("|", F.lit(SEED_TEXT), *(F.col(k) for k in keys)))
    keyed = df.select(F.col(label).alias("_class"), digest.alias("_digest"))
    prefix = F.substring("_digest", 1, DIGEST_PREFIX)

    cells = keyed.groupBy("_class", prefix.alias("_prefix")).agg(F.count(F.lit(1)).alias("n"))
    up_to = Window.partitionBy("_class").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    placed = cells.withColumn("_up_to", F.sum("n").over(up_to)).withColumn("_before", F.col("_up_to") - F.col("n"))
    quotas = _class_quotas(cells.groupBy("_class").agg(F.sum("n").alias("n_class")), test_share)
    # One row per class on the broadcast side, here and below.
    boundary = (
        placed.join(F.broadcast(quotas), "_class")
        .filter("_before < quota and quota <= _up_to")
        .select("_class", "_prefix", (F.col("quota") - F.col("_before")).alias("_take"))
    )
    by_digest = Window.partitionBy("_class").orderBy("_digest")
    cut_offs = (
        keyed.withColumn("_prefix", prefix)
        .join(F.broadcast(boundary), ["_class", "_prefix"])
        .withColumn("_rank", F.row_number().over(by_digest))
        .filter("_rank <= _take")
        .groupBy("_class")
        .agg(F.max("_digest").alias("_cut_off"))
    )
    marked = df.join(F.broadcast(cut_offs), F.col(label) == F.col("_class"), "left")
    return marked.withColumn("is_test", F.coalesce(digest <= F.col("_cut_off"), F.lit(False))).drop("_class", "_cut_off")


def _class_quotas(classes: DataFrame, test_share: float) -> DataFrame:
    """Test rows per class by largest remainder; ties go to the smaller label. One row per class."""
    total = F.sum("n_class").over(Window.partitionBy())
    wanted = F.ceil(F.round(total * F.lit(test_share), 6))
    exact = F.col("wanted") * F.col("n_class") / F.col("n_all")
    shares = classes.withColumn("n_all", total).withColumn("wanted", wanted).withColumn("whole", F.floor(exact))
    shares = shares.withColumn("left_over", F.col("wanted") - F.sum("whole").over(Window.partitionBy()))
    by_remainder = Window.orderBy(F.desc(F.round(exact - F.col("whole"), 9)), "_class")
    extra = F.when(F.row_number().over(by_remainder) <= F.col("left_over"), 1).otherwise(0)
    return shares.select("_class", (F.col("whole") + extra).alias("quota"))


def in_stable_order(df: DataFrame, keys: Sequence[str] = ORDER_GRAIN) -> DataFrame:
    """The same rows in the same partitions and order on every run, so that seeded fits repeat.

    Trees draw their samples by partition number and row position; a written table keeps both.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *keys).sortWithinPartitions(*keys)


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weights n / (k * n_c); one row per class."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n_rows"))
    totals = counts.agg(F.struct(F.sum("n_rows").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    return counts.select("label", "n_rows", (totals["n"] / (totals["k"] * F.col("n_rows"))).alias("weight"))


def with_class_weights(df: DataFrame, fitted_on: DataFrame, label: str = LABEL) -> DataFrame:
    weights = class_weights(fitted_on, label).select(F.col("label").alias("_class"), "weight")
    return df.join(F.broadcast(weights), F.col(label) == F.col("_class"), "left").drop("_class")


def _moments(features: Sequence[str]) -> Column:
    means = (F.avg(c).alias(f"{c}_mean") for c in features)
    return F.struct(*means, *(F.stddev_pop(c).alias(f"{c}_std") for c in features))


def fitted_scaler(features: Sequence[str], fitted_on: DataFrame, suffix: str = "_scaled") -> SQLTransformer:
    """`standardize` as a pipeline stage that holds the fitted numbers and can be saved with a model."""
    found = fitted_on.agg(_moments(features).alias("m")).first()["m"]
    scaled = (
        f"(`{c}` - {found[f'{c}_mean'] or 0.0!r}D) / {found[f'{c}_std'] or 1.0!r}D AS `{c}{suffix}`" for c in features
    )
    return SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__")


def standardize(df: DataFrame, features: Sequence[str], fitted_on: DataFrame) -> DataFrame:
    """Features with the training rows' mean 0 and population standard deviation 1.

    A constant feature is only centred.
    """
    moments = fitted_on.agg(_moments(features)).scalar()
    spread = {c: F.when(moments[f"{c}_std"] > 0, moments[f"{c}_std"]).otherwise(1.0) for c in features}
    return df.withColumns({c: (F.col(c) - moments[f"{c}_mean"]) / spread[c] for c in features})
