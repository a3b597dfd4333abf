"""Spatial predicates and small geometric expressions as Spark ``Column``s.

Everything here is a plain Catalyst expression: it is code-generated inside
whole-stage codegen and, when one side is a literal, pushed to the scan.

Conventions
-----------
* Points are the columns ``x, y``; rectangles ``x1, y1, x2, y2`` with
  ``x1 <= x2`` and ``y1 <= y2`` (see :func:`normalized_rect`).
* Comparisons are inclusive: a point on an edge is inside.
* Spark treats NaN as a value that equals itself and sorts above +Infinity, so
  rows with NaN coordinates must be removed (:func:`finite_point`,
  :func:`valid_rect`) before any predicate is applied.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_nan(*cols) -> Column:
    """True when every column is non-null and not NaN (Infinity allowed)."""
    cond = F.lit(True)
    for c in cols:
        c = _c(c)
        cond = cond & c.isNotNull() & ~F.isnan(c)
    return cond


def all_finite(*cols) -> Column:
    """True when every column is non-null, not NaN and not +/-Infinity."""
    cond = F.lit(True)
    for c in cols:
        c = _c(c)
        cond = cond & c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return cond


def finite_point(x="x", y="y") -> Column:
    return not_nan(x, y)


def valid_rect(x1="x1", y1="y1", x2="x2", y2="y2") -> Column:
    return not_nan(x1, y1, x2, y2)


def normalized_rect(x1="x1", y1="y1", x2="x2", y2="y2", alias: bool = True) -> list[Column]:
    """Corners in any order -> (min x, min y, max x, max y). Apply after the NaN guard."""
    x1, y1, x2, y2 = _c(x1), _c(y1), _c(x2), _c(y2)
    cols = [F.least(x1, x2), F.least(y1, y2), F.greatest(x1, x2), F.greatest(y1, y2)]
    if alias:
        cols = [c.alias(n) for c, n in zip(cols, ("x1", "y1", "x2", "y2"))]
    return cols


def point_in_rect(px, py, x1, y1, x2, y2) -> Column:
    """P1: boundary-inclusive point-in-rectangle."""
    px, py = _c(px), _c(py)
    return (px >= _c(x1)) & (px <= _c(x2)) & (py >= _c(y1)) & (py <= _c(y2))


def point_on_border(px, py, x1, y1, x2, y2) -> Column:
    """P2: the point lies on one of the four edges (ends included)."""
    px, py = _c(px), _c(py)
    x1, y1, x2, y2 = _c(x1), _c(y1), _c(x2), _c(y2)
    return point_in_rect(px, py, x1, y1, x2, y2) & (
        (px == x1) | (px == x2) | (py == y1) | (py == y2)
    )


def rect_contains(ax1, ay1, ax2, ay2, bx1, by1, bx2, by2) -> Column:
    """P3: rectangle A contains rectangle B, boundaries inclusive."""
    return (
        (_c(ax1) <= _c(bx1)) & (_c(ax2) >= _c(bx2)) & (_c(ay1) <= _c(by1)) & (_c(ay2) >= _c(by2))
    )


def rect_intersects(ax1, ay1, ax2, ay2, bx1, by1, bx2, by2) -> Column:
    """Closed intersection: the two rectangles share at least one point."""
    return (
        (_c(ax1) <= _c(bx2)) & (_c(bx1) <= _c(ax2)) & (_c(ay1) <= _c(by2)) & (_c(by1) <= _c(ay2))
    )


def _between(v, lo, hi) -> Column:
    return (v >= lo) & (v <= hi)


def rect_endpoint_overlap(ax1, ay1, ax2, ay2, bx1, by1, bx2, by2) -> Column:
    """P4: overlap tested on edge end values only.

    True when (an x-end of A lies in B's x-range and a y-end of A lies in B's
    y-range) or the same with A and B swapped.  It equals closed intersection
    except for "plus-sign" crossings, which it misses; kept for parity.
    """
    ax1, ay1, ax2, ay2 = _c(ax1), _c(ay1), _c(ax2), _c(ay2)
    bx1, by1, bx2, by2 = _c(bx1), _c(by1), _c(bx2), _c(by2)
    a_in_b = (_between(ax1, bx1, bx2) | _between(ax2, bx1, bx2)) & (
        _between(ay1, by1, by2) | _between(ay2, by1, by2)
    )
    b_in_a = (_between(bx1, ax1, ax2) | _between(bx2, ax1, ax2)) & (
        _between(by1, ay1, ay2) | _between(by2, ay1, ay2)
    )
    return a_in_b | b_in_a


def squared_distance(ax, ay, bx, by) -> Column:
    dx = _c(ax) - _c(bx)
    dy = _c(ay) - _c(by)
    return dx * dx + dy * dy


def distance(ax, ay, bx, by) -> Column:
    """G8: planar Euclidean distance."""
    return F.sqrt(squared_distance(ax, ay, bx, by))


def lex_less(ax, ay, bx, by) -> Column:
    """(ax, ay) < (bx, by) in x-then-y order."""
    ax, ay, bx, by = _c(ax), _c(ay), _c(bx), _c(by)
    return (ax < bx) | ((ax == bx) & (ay < by))


def cross(ox, oy, ax, ay, bx, by) -> Column:
    """z-component of (a - o) x (b - o): > 0 when o, a, b turn counter-clockwise."""
    return (_c(ax) - _c(ox)) * (_c(by) - _c(oy)) - (_c(ay) - _c(oy)) * (_c(bx) - _c(ox))
