import itertools

from pyspark.sql import functions as F

from tessel.functions import predicates as P


def test_endpoint_overlap_is_intersection_minus_plus_cross(spark):
    # every rectangle on a 5 x 5 integer grid (zero width allowed), all pairs
    coords = [(a, b) for a in range(5) for b in range(a, 5)]
    rects = [(x1, y1, x2, y2) for (x1, x2) in coords for (y1, y2) in coords]
    rows = [(a + b) for a, b in itertools.product(rects, rects)]
    df = spark.createDataFrame(rows, "ax1 int, ay1 int, ax2 int, ay2 int, bx1 int, by1 int, bx2 int, by2 int")
    a = ("ax1", "ay1", "ax2", "ay2")
    b = ("bx1", "by1", "bx2", "by2")
    plus = ((F.col("ax1") < F.col("bx1")) & (F.col("bx2") < F.col("ax2")) & (F.col("by1") < F.col("ay1")) & (F.col("ay2") < F.col("by2"))) | (
        (F.col("bx1") < F.col("ax1")) & (F.col("ax2") < F.col("bx2")) & (F.col("ay1") < F.col("by1")) & (F.col("by2") < F.col("ay2"))
    )
    bad = df.filter(P.rect_endpoint_overlap(*a, *b) != (P.rect_intersects(*a, *b) & ~plus)).count()
    assert bad == 0
    assert df.filter(P.rect_intersects(*a, *b) & plus).count() > 0


def test_point_predicates(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.5, 0.5), (1.0, 0.3), (2.0, 2.0)], "x double, y double")
    inside = df.filter(P.point_in_rect("x", "y", F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0))).count()
    border = df.filter(P.point_on_border("x", "y", F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0))).count()
    assert (inside, border) == (3, 2)
