"""Streaming text source of points, plus the range query and grid counts on it.

New files dropped into a directory become micro-batches
(``spark.readStream.text``); lines are parsed with the same rules as the batch
readers.  The range query is a stateless filter; the grid aggregate keeps one
count row per non-empty cell in the state store (``outputMode("update")`` or
``"complete"``).  Checkpoint locations must be on shared storage on a cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessel.operators.aggregate import grid_aggregate
from tessel.operators.range_query import range_query
from tessel.sources.text import POINT_FIELDS, parse_lines


def read_points_stream(
    spark: SparkSession, directory: str, with_id: bool = True, malformed: str = "drop", max_files: int | None = None
) -> DataFrame:
    """Streaming ``[id,] x, y`` rows from text files arriving in ``directory``."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return parse_lines(reader.load(directory), POINT_FIELDS, with_id, malformed)


def range_query_stream(points: DataFrame, window) -> DataFrame:
    """Ids of streamed points inside the window (unsorted: a stream has no global order)."""
    return range_query(points, window, sort=False)


def grid_counts_stream(points: DataFrame, cell_w: float, cell_h: float | None = None) -> DataFrame:
    """Running point count per grid cell of a stream (stateful aggregate)."""
    return grid_aggregate(points, cell_w, cell_h)


def point_join_stream(points: DataFrame, rects: DataFrame, predicate: str | None = None) -> DataFrame:
    """J1 on a stream: ``(bid, aid)`` for streamed points inside static rectangles.

    The grid plan comes from the static rectangles alone (one aggregate when the
    query is defined); each micro-batch is then a stateless stream-static
    equi-join on the cell key plus the exact predicate, so no state grows.
    Rectangles with a NaN corner never match; the stream's hot cells cannot be
    sampled ahead, so no salting is applied on this path.
    """
    from tessel.operators.join import _a_side, _norm_rect, _predicate
    from tessel.plans.grid import grid_join, plan_points_against

    side, box, is_points = _a_side(points, "id")
    if not is_points:
        raise ValueError("point_join_stream joins a stream of points (id, x, y)")
    b = _norm_rect(rects, "b", "id").filter("bok")
    b_box = ("bx1", "by1", "bx2", "by2")
    plan = plan_points_against(b, b_box)
    return grid_join(side, box, b, b_box, _predicate(predicate, True), plan=plan).select("bid", "aid")
