"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderwake.llm.common import durable


def _with_least_neighbour(links: DataFrame) -> DataFrame:
    """Each link with the smallest neighbour of its first node (or that node, if smaller).

    The nodes meet as structs: other keys than the minima are grouped on, so both sides have an exchange directly
    below their sort, and Spark can split the links of a hub.
    """
    least = links.groupBy("a").agg(F.min("b").alias("least")).select(F.struct("a").alias("node"), F.least("least", "a").alias("least"))
    return links.join(least, F.struct(links.a) == least.node).select("a", "b", "least")


def connected_components(links: DataFrame) -> DataFrame:
    """`node`, `root` (smallest node of the component) for each node of the links `a`, `b`.

    Alternates the two star operations: every node hands its larger, then its smaller neighbours to the
    smallest one, until nothing changes. A round is two joins on pre-aggregated minima; links are written to
    the checkpoint folder after each round, so the lineage stays short. Nothing but a count and a checksum
    reaches the driver. Null nodes and links of a node to itself are left out.
    """
    links = durable(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            return links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        seen = state
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least_neighbour(both).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        starred = _with_least_neighbour(large)
        links = durable(
            starred.select(F.explode(F.array(F.struct("a", F.col("least").alias("b")), F.struct(F.col("b").alias("a"), F.col("least").alias("b")))).alias("link"))
            .select("link.*")
            .where(F.col("a") != F.col("b"))
            .distinct()
        )
