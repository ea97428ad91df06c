"""Exact, linearly interpolated quantiles of several columns without sorting the table.

1. A sketch gives, per column, a narrow bracket of values around each wanted rank. The bracket edges
   cut the column into pieces: below the first edge, equal to it, up to the next edge, and so on.
2. One pass counts the values below and up to each edge, in one wide row. The counts are exact, so the
   piece that holds a wanted rank is known for certain, however good the sketch was. If that piece is an
   edge, so is the value.
3. Only values strictly between two edges with a wanted rank between them are grouped (value, count),
   ordered and ranked.

Steps 1 and 2 bring a few numbers per column and probability to the driver. Nothing but step 3
moves rows, and it moves about 4/accuracy of them per quantile, equal values already merged.
The table is scanned twice, and a third time if a rank lies between edges, so it should be a written one.
"""

from __future__ import annotations

import math
from collections.abc import Collection, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import number

Edges = dict[str, list[float]]

#: A bracket holds 4 in so many rows.
ACCURACY = 20_000

#: Cells that a piece is cut into for ranking.
CELLS = 1_024

FOUND = "column_name string, probability double, upper_end boolean, fraction double, value double"
OPEN = "column_name string, piece int, place bigint, probability double, upper_end boolean, fraction double"


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    accuracy: int | None = None,
) -> DataFrame:
    """One row (column_name, probability, value) per probability and column that has values.

    `accuracy` (ACCURACY) sets the width of the brackets: they hold 4 / accuracy of the rows.
    """
    measured = df.select(*(number(df, c).alias(c) for c in columns))
    edges = _bracket_edges(measured, probabilities, accuracy or ACCURACY)
    known, still_open = _locate(_piece_counts(measured, edges), edges, probabilities)

    found = df.sparkSession.createDataFrame(known, FOUND)
    if still_open:
        found = found.unionByName(_ranked_values(measured, edges, still_open).select(*found.columns))
    ends = found.groupBy("column_name", "probability").agg(
        F.max(F.when(~F.col("upper_end"), F.col("value"))).alias("low"),
        F.max(F.when(F.col("upper_end"), F.col("value"))).alias("high"),
        F.max("fraction").alias("fraction"),
    )
    value = F.col("low") + (F.col("high") - F.col("low")) * F.col("fraction")
    return ends.select("column_name", "probability", value.alias("value"))


def _bracket_edges(measured: DataFrame, probabilities: Sequence[float], accuracy: int) -> Edges:
    around = sorted({min(max(p + side * 2.0 / accuracy, 0.0), 1.0) for p in probabilities for side in (-1, 1)})
    row = measured.agg(*(F.percentile_approx(c, around, accuracy).alias(c) for c in measured.columns)).first()
    return {c: sorted(set(row[c] or [])) for c in measured.columns}


def _piece_counts(measured: DataFrame, edges: Edges) -> dict[str, dict[int, int]]:
    """Rows per piece: piece 2k holds the values below edge k and above the one before, 2k + 1 those equal to edge k."""
    wanted = {c: F.array(F.count(c), *(F.count_if(F.col(c) < e) for e in edges[c]), *(F.count_if(F.col(c) <= e) for e in edges[c])) for c in edges}
    row = measured.agg(*(counts.alias(c) for c, counts in wanted.items())).first()
    counts: dict[str, dict[int, int]] = {}
    for c, own in edges.items():
        total, below, upto = row[c][0], row[c][1 : len(own) + 1], row[c][len(own) + 1 :]
        pieces = {0: below[0] if own else total}
        for k in range(len(own)):
            pieces[2 * k + 1] = upto[k] - below[k]
            pieces[2 * k + 2] = (below[k + 1] if k + 1 < len(own) else total) - upto[k]
        counts[c] = {piece: n for piece, n in pieces.items() if n}
    return counts


def _in_pieces(measured: DataFrame, edges: Edges, only: Collection[tuple[str, int]]) -> DataFrame:
    """(column_name, piece, value) of the values in the listed pieces between edges."""
    found = []
    for column, piece in only:
        low, high = (edges[column][k] if 0 <= k < len(edges[column]) else None for k in (piece // 2 - 1, piece // 2))
        inside = [F.col(column) > low] if low is not None else []
        inside += [F.col(column) < high] if high is not None else []
        found.append((reduce(and_, inside, F.col(column).isNotNull()), column, piece))
    rows = measured.filter(reduce(or_, (inside for inside, _, _ in found)))
    hits = (
        F.when(inside, F.struct(F.lit(column).alias("column_name"), F.lit(piece).alias("piece"), F.col(column).alias("value")))
        for inside, column, piece in found
    )
    return rows.select(F.explode(F.array_compact(F.array(*hits))).alias("hit")).select("hit.*")


def _locate(
    counts: dict[str, dict[int, int]], edges: Edges, probabilities: Sequence[float]
) -> tuple[list[tuple], list[tuple]]:
    """Both neighbours of each position p * (n - 1): those that are an edge, and those between edges."""
    known, still_open = [], []
    for column, pieces in counts.items():
        total = sum(pieces.values())
        for p in probabilities if total else ():
            position = p * (total - 1)
            fraction = position - math.floor(position)
            for upper_end, place in ((False, math.floor(position)), (True, math.ceil(position))):
                for piece in sorted(pieces):
                    if place < pieces[piece]:
                        break
                    place -= pieces[piece]
                if piece % 2:
                    known.append((column, float(p), upper_end, fraction, edges[column][piece // 2]))
                else:
                    still_open.append((column, piece, place, float(p), upper_end, fraction))
    return known, still_open


def _running_counts(counted: DataFrame, edges: Edges) -> DataFrame:
    """Add `up_to`, the running count within a piece, cell by cell.

    A piece between two edges is cut into CELLS ranges of equal width, so that no task ranks a whole
    piece; the totals of the cells are few. Pieces beyond the outer edges are one cell.
    """
    names = list(edges)
    place = F.floor(F.col("piece") / 2).cast("int")
    own = F.get(F.array(*(F.array(*map(F.lit, edges[c])).cast("array<double>") for c in names)), F.array_position(F.array(*map(F.lit, names)), F.col("column_name")).cast("int") - 1)
    low, high = F.get(own, place - 1), F.get(own, place)
    cell = F.least(F.floor((F.col("value") - low) / (high - low) * CELLS), F.lit(CELLS - 1))
    celled = counted.withColumn("cell", F.coalesce(cell, F.lit(0)).cast("int"))
    within = ["column_name", "piece"]
    before = Window.partitionBy(*within).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = celled.groupBy(*within, "cell").agg(F.sum("n").alias("in_cell"))
    offsets = offsets.select(*within, "cell", F.coalesce(F.sum("in_cell").over(before), F.lit(0)).alias("before"))
    so_far = Window.partitionBy(*within, "cell").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    placed = celled.join(offsets, [*within, "cell"])
    return placed.select("column_name", "piece", "value", "n", (F.sum("n").over(so_far) + F.col("before")).alias("up_to"))


def _ranked_values(measured: DataFrame, edges: Edges, still_open: list[tuple]) -> DataFrame:
    values = _in_pieces(measured, edges, sorted({(column, piece) for column, piece, *_ in still_open}))
    counted = values.groupBy("column_name", "piece", "value").agg(F.count(F.lit(1)).alias("n"))
    ranked = _running_counts(counted, edges)
    # Two rows per column and probability: the broadcast is bounded by the request.
    requests = F.broadcast(measured.sparkSession.createDataFrame(still_open, OPEN))
    hit = (F.col("place") < F.col("up_to")) & (F.col("place") >= F.col("up_to") - F.col("n"))
    return ranked.join(requests, ["column_name", "piece"]).filter(hit)
