"""A3/A4 envelope (bounding-box corners) and A8 distinct points.

The envelope is one global aggregate (four partial min/max per task, merged in
one tiny final task) and its corners are produced by ``inline`` inside the plan:
nothing is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessel.functions.predicates import all_finite, not_nan, normalized_rect


def distinct_points(points: DataFrame, x="x", y="y") -> DataFrame:
    """Distinct ``(x, y)``; NaN rows dropped, -0.0 and 0.0 merged."""
    return (
        points.filter(not_nan(x, y))
        .select(F.col(x).alias("x"), F.col(y).alias("y"))
        .dropDuplicates(["x", "y"])
    )


def bounds(df: DataFrame) -> DataFrame:
    """One row ``minx, miny, maxx, maxy`` over points (x, y) or rectangles (x1..y2)."""
    cols = set(df.columns)
    if {"x1", "y1", "x2", "y2"} <= cols:
        ok = all_finite("x1", "y1", "x2", "y2")
        x1, y1, x2, y2 = normalized_rect(alias=False)
        src = df.filter(ok).select(x1.alias("lx"), y1.alias("ly"), x2.alias("hx"), y2.alias("hy"))
    else:
        ok = all_finite("x", "y")
        src = df.filter(ok).select(
            F.col("x").alias("lx"), F.col("y").alias("ly"), F.col("x").alias("hx"), F.col("y").alias("hy")
        )
    return src.agg(
        F.min("lx").alias("minx"), F.min("ly").alias("miny"), F.max("hx").alias("maxx"), F.max("hy").alias("maxy")
    )


def envelope(df: DataFrame) -> DataFrame:
    """The distinct corners of the bounding box as ``x, y`` rows (four, fewer when degenerate)."""
    b = bounds(df).filter(F.col("minx").isNotNull())
    corners = F.array(
        F.struct(F.col("minx").alias("x"), F.col("miny").alias("y")),
        F.struct(F.col("minx").alias("x"), F.col("maxy").alias("y")),
        F.struct(F.col("maxx").alias("x"), F.col("miny").alias("y")),
        F.struct(F.col("maxx").alias("x"), F.col("maxy").alias("y")),
    )
    return b.select(F.inline(F.array_distinct(corners)))
