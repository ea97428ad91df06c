"""Physical plans: no all-pairs joins, no Python workers, pruned scans."""

import pytest
from conftest import DATA

from orderwake import registry

# These fit models; their plans are read through the oracle-checked queries that share their steps.
FITTING = ("backorder_logistic", "backorder_forest", "forest_importance", "backorder_gbt", "magnitude_elasticnet", "magnitude_ridge", "magnitude_gbt", "model_comparison", "at_risk_report", "at_risk_coverage", "logistic_optimality", "ridge_optimality", "elasticnet_optimality", "saved_model_scores", "importance_by_nodes", "forest_leaves", "gbt_leaves", "magnitude_gbt_leaves")
PLANNED = [q for q in registry.QUERIES if q.__name__ not in FITTING]


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("query", PLANNED, ids=lambda q: q.__name__)
def test_no_all_pairs_join_and_no_python(spark, query):
    plan = physical(registry.runner(query)(spark, DATA))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert forbidden not in plan


def test_scans_read_the_needed_columns_only(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = physical(registry.runner(registry.delivery_agg)(spark, DATA))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    schema = plan[plan.index("ReadSchema") :].split("\n")[0]
    for column in ("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"):
        assert column in schema
    for column in ("l_extendedprice", "l_shipdate", "l_suppkey", "o_orderdate"):
        assert column not in schema
    assert "PushedFilters" in plan and "EqualTo(l_linestatus,F)" in plan


def test_order_items_are_shuffled_three_times_at_most(spark):
    """By line, by document, by material: no lookup in header, deliveries or billing shuffles the items again."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = registry.order_fulfillment(registry.dataset(spark, DATA))._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    def carrying(node):
        own = node.nodeName() == "Exchange" and any(c in node.output().mkString(",") for c in ("item_category", "l_returnflag"))
        children = node.children()
        return int(own) + sum(carrying(children.apply(i)) for i in range(children.length()))

    assert carrying(plan.initialPlan()) == 3


def shuffles_of(spark, build, *columns):
    """Exchanges that carry one of the columns when Spark broadcasts nothing by its own size check."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = build()._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    def carrying(node):
        own = node.nodeName() == "Exchange" and any(c in node.output().mkString(",") for c in columns)
        children = node.children()
        return int(own) + sum(carrying(children.apply(i)) for i in range(children.length()))

    return carrying(plan.initialPlan())


def test_metrics_need_no_shuffle_besides_those_of_the_orders(spark):
    """Orders that are not written come placed by material, where the stock meets them."""
    d = registry.Dataset(spark, DATA)
    assert shuffles_of(spark, d.build_metrics, "item_category", "l_returnflag") == 3
    assert not d.workspace.has("master_order_fulfillment")


def test_lines_are_shuffled_by_order_only(spark):
    """Once to deal out the small file, once by order; the regions of few suppliers go to the lines."""
    assert shuffles_of(spark, registry.Dataset(spark, DATA).clean._build_lines, "l_quantity") == 2


def exchanges(df):
    """The columns of each shuffle when Spark broadcasts nothing by its own size check."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = df._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

    def below(node):
        own = [node.output().mkString(",")] if node.nodeName() == "Exchange" else []
        children = node.children()
        return own + [c for i in range(children.length()) for c in below(children.apply(i))]

    return below(plan.initialPlan())


def test_no_shuffle_of_order_items_carries_what_the_header_tells(spark):
    """Nor does one carry the hash that it is made by; the stock for the metrics comes with the material."""
    d = registry.Dataset(spark, DATA)
    for build in (d.build_orders, d.build_metrics):
        columns = exchanges(build())
        assert not [c for c in columns if "item_category" in c and "order_header_net_value" in c]
        assert not [c for c in columns if "_at#" in c]
