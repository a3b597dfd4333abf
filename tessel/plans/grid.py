"""Multi-level grid: turns a rectangle-overlap (theta) join into an equi-join.

Catalyst has no range-join strategy: without an equality key Spark plans a
CartesianProduct or BroadcastNestedLoopJoin, i.e. |A|*|B| tests.  This module
rewrites "box A overlaps box B" (points are boxes with zero extent) as a join
on a grid-cell key so Spark can use a sort-merge or broadcast-hash join and the
exact predicate only runs on nearby candidates.

Levels
    Cells at level ``l`` are squares of side ``2**l``.  A box lives at the
    smallest level whose side is at least its extent (``max(width, height)``)
    divided by ``2**shift``, but never below the floor level ``k`` of least
    estimated cost; there it covers at most (2**shift + 1)**2 cells (one more per axis
    under rounding).  Point-vs-box joins use shift 1 (cells half the typical
    box), box-vs-box joins shift 0.  So a box is copied into a handful of
    cells however large it is, and no box is "too large for the grid".
    Boxes with a non-finite corner go to ``TOP``, a level with one cell.

Matching
    A pair is matched only at level ``max(level_a, level_b)``: each side also
    emits its cells at the *other* side's higher levels.  Inside that level the
    pair is kept only in the cell holding ``(max(ax1, bx1), max(ay1, by1))``,
    a point of the closed intersection, so every overlapping pair is produced
    exactly once and real duplicate rows survive.  Every supported predicate
    implies closed intersection, so nothing is lost.

Skew
    A cell is hot when one side has more than ``hot_rows`` rows in it or it
    holds more than ``hot_work`` candidate pairs.  The larger side's rows of a
    hot cell get a deterministic salt ``pmod(xxhash64(row), n)`` and the other
    side's rows of that cell are copied to all ``n`` salts (both sides are
    split when both are large), so each task gets a bounded share.  Hot cells
    are estimated from seeded samples at a rate tied to the limits, so that a cell at
    a limit has many sampled rows at any input size.  The largest
    ``MAX_BROADCAST_HOT`` are broadcast and salted; AQE's skew join has the rest.  The pass is skipped when the input sizes alone
    prove that no cell can be hot.

Jobs run by :func:`grid_join` before the lazy result: one aggregate for the
level plan (a few dozen rows to the driver) and, unless skipped, one sampled
aggregate for hot cells.  Both read only the coordinate columns.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessel.plans.partitioning import spread
from tessel.session import materialize

# Fixed values of the plan (not tuning knobs of the data):
TOP = 4096  # level of the single catch-all cell for boxes with infinite corners
CLAMP = float(2**50)  # cell indexes are clamped to +/- this (keeps floor() in BIGINT)
MIN_LEVEL = -1074  # smallest power of two a double can hold
MAX_LEVEL = 1023  # largest
MAX_BROADCAST_HOT = 200_000  # hot-cell rows broadcast (under 10 MB); the rest is left to AQE
HOT_SAMPLE_ROWS = 200_000  # input rows sampled per side for hot-cell detection, at least
HOT_SAMPLES = 256  # sampled rows that a cell of `hot_rows` rows is to have, however large the input
HOT_HITS = 8  # sampled rows a side must have in a cell before its estimate counts
DEFAULT_HOT_ROWS = 1_000_000  # rows of one side in one cell before it is split
DEFAULT_HOT_WORK = 200_000_000  # candidate pairs in one cell before it is split
MAX_FLOORS = 48  # floor levels whose cost is estimated
COPY_COST = 20.0  # a copied (shuffled) row costs about as much as this many candidate tests
_ZERO_EXTENT = -100_000  # exponent recorded for boxes of zero extent
_INFINITE = 100_000  # exponent recorded for boxes with a non-finite corner


def _q(name: str) -> str:
    return f"`{name}`"


def sql_not_nan(*cols: str) -> str:
    return " AND ".join(f"({_q(c)} IS NOT NULL AND NOT isnan({_q(c)}))" for c in cols)


def sql_finite(*cols: str) -> str:
    return " AND ".join(
        f"({_q(c)} IS NOT NULL AND NOT isnan({_q(c)}) AND abs({_q(c)}) < double('inf'))" for c in cols
    )


def sql_extent(x1, y1, x2, y2) -> str:
    return f"greatest({_q(x2)} - {_q(x1)}, {_q(y2)} - {_q(y1)})"


def sql_exp(ext: str) -> str:
    """ceil(log2(extent)) for a positive extent, else null."""
    return f"CASE WHEN {ext} > 0 THEN CAST(ceil(log2({ext})) AS INT) END"


def sql_cell(v: str, level: str) -> str:
    """floor(v / 2**level), clamped so it always fits a BIGINT (``v``/``level`` are SQL).

    Division by a power of two is exact, floor and clamp are monotone, so a
    point inside [lo, hi] always maps inside [cell(lo), cell(hi)].
    """
    # coalesce only marks the (never null) result non-nullable, so the optimizer
    # does not add and evaluate an extra IS NOT NULL filter per join key
    return (
        f"coalesce(floor(least(greatest(({v}) / power(2.0D, CAST({level} AS DOUBLE)), "
        f"{-CLAMP!r}D), {CLAMP!r}D)), 0L)"
    )


def cell_index(v, level) -> Column:
    """Column form of :func:`sql_cell` for column names."""
    return F.expr(sql_cell(_q(v), _q(level)))


@dataclass(frozen=True)
class GridPlan:
    """Result of the planning job: floor level and the levels present per side."""

    floor: int
    a_levels: tuple[int, ...]
    b_levels: tuple[int, ...]
    n_a: int = 0
    n_b: int = 0
    shift: int = 0

    def own_level_sql(self, x1, y1, x2, y2) -> str:
        e = f"coalesce({sql_exp(sql_extent(x1, y1, x2, y2))} - {self.shift}, {self.floor})"
        lvl = f"greatest({e}, {self.floor})"
        return (
            f"CAST(CASE WHEN NOT ({sql_finite(x1, y1, x2, y2)}) OR {lvl} > {MAX_LEVEL} "
            f"THEN {TOP} ELSE {lvl} END AS INT)"
        )


def _cheapest_floor(rows, positive, shift: int) -> int:
    """Floor level with the least estimated work: row copies (shuffled) plus candidate pairs.

    Every (side, exponent) group of the histogram is taken as uniform over its own bounding
    box, so boxes that lie where the other side has nothing cost nothing: a low floor gives
    small boxes small cells, a high one spares the other side a copy per level.  A floor only
    changes the work, never the result.
    """
    median, half, run = positive[0][0], sum(n for _, n in positive) / 2.0, 0
    for e, n in positive:
        run += n
        if run >= half:
            median = e
            break
    exponents = sorted({e for e, _ in positive})
    step = -(-len(exponents) // MAX_FLOORS)
    floors = sorted({*exponents[::step], exponents[-1], median})

    def groups(tag):
        some = [r for r in rows if r["_side"] == tag and r["_e"] != _INFINITE and r["minx"] is not None]
        cols = [np.array([r[c] for r in some], float) for c in ("n", "minx", "miny", "maxx", "maxy")]
        return np.array([r["_e"] for r in some], np.int64), cols

    (ea, (na, ax1, ay1, ax2, ay2)), (eb, (nb, bx1, by1, bx2, by2)) = groups("a"), groups("b")
    costs = []
    with np.errstate(all="ignore"):
        size_a, size_b = np.ldexp(1.0, ea.clip(-1074, 1023)), np.ldexp(1.0, eb.clip(-1074, 1023))
        size_a[ea == _ZERO_EXTENT] = size_b[eb == _ZERO_EXTENT] = 0.0
        for f in floors:
            la, lb = np.maximum(f, ea) - shift, np.maximum(f, eb) - shift
            # a row is copied at its own level and at every higher level of the other side
            copies = 0.0
            for n, size, own, other in ((na, size_a, la, lb), (nb, size_b, lb, la)):
                for level in np.unique(other):
                    at = np.maximum(own, level)
                    cells = np.where(level > own, (size / np.ldexp(1.0, at.clip(-1074, 1023)) + 1) ** 2, 0.0)
                    copies += float((n * cells).sum())
                copies += float((n * (size / np.ldexp(1.0, own.clip(-1074, 1023)) + 1) ** 2).sum())
            cell = np.ldexp(1.0, np.maximum(la[:, None], lb[None, :]).clip(-1074, 1023))
            pairs = na[:, None] * nb[None, :]
            for a1, a2, b1, b2 in ((ax1, ax2, bx1, bx2), (ay1, ay2, by1, by2)):
                shared = np.minimum(a2[:, None], b2[None, :]) - np.maximum(a1[:, None], b1[None, :]) + cell
                reach = size_a[:, None] + size_b[None, :] + cell
                share_a = np.minimum(1.0, shared / ((a2 - a1)[:, None] + cell))
                share_b = np.minimum(1.0, shared / ((b2 - b1)[None, :] + cell))
                pairs = pairs * np.where(shared > 0, share_a * share_b * np.minimum(1.0, reach / shared), 0.0)
            cost = COPY_COST * copies + float(pairs.sum())
            costs.append(cost if math.isfinite(cost) else math.inf)
    best = min(costs)
    return (median if math.isinf(best) else floors[costs.index(best)]) - shift


def plan_grid(a: DataFrame, a_box, b: DataFrame, b_box, shift: int = 0) -> GridPlan:
    """One aggregate job over both inputs -> floor level and the exact level set per side.

    Groups by (side, ceil(log2(extent))): a code-generated hash aggregate whose
    output has one row per distinct exponent (a few dozen at most), so the
    driver receives a bounded summary.  The floor is the exponent (of boxes with
    positive extent, minus ``shift``) of least estimated cost, see :func:`_cheapest_floor`.

    ``shift`` makes cells ``2**shift`` times finer than the extent of the boxes
    living on them (a box then spans up to 2**shift + 1 cells per axis): fewer
    candidate pairs for the price of copying that side into more cells.
    """

    def side(df, box, tag):
        x1, y1, x2, y2 = box
        fin = sql_finite(*box)
        e = f"CASE WHEN {fin} THEN coalesce({sql_exp(sql_extent(*box))}, {_ZERO_EXTENT}) ELSE {_INFINITE} END"
        return df.selectExpr(
            f"'{tag}' AS _side",
            f"{e} AS _e",
            *[f"CASE WHEN {fin} THEN {_q(c)} END AS _{n}" for c, n in zip(box, ("x1", "y1", "x2", "y2"))],
        )

    both = side(a, a_box, "a").unionByName(side(b, b_box, "b"))
    rows = (
        both.groupBy("_side", "_e")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("_x1").alias("minx"),
            F.min("_y1").alias("miny"),
            F.max("_x2").alias("maxx"),
            F.max("_y2").alias("maxy"),
        )
        .collect()
    )
    positive = sorted((r["_e"], r["n"]) for r in rows if r["_e"] not in (_ZERO_EXTENT, _INFINITE))
    if positive:
        floor = _cheapest_floor(rows, positive, shift)
    else:
        # no box has a positive extent: size cells from the bounding box and count
        boxes = [r for r in rows if r["minx"] is not None]
        n = sum(r["n"] for r in rows) or 1
        if boxes:
            span = max(
                max(r["maxx"] for r in boxes) - min(r["minx"] for r in boxes),
                max(r["maxy"] for r in boxes) - min(r["miny"] for r in boxes),
            )
        else:
            span = 0.0
        floor = math.ceil(math.log2(span / math.sqrt(n))) if span > 0 else 0
    floor = max(MIN_LEVEL, min(MAX_LEVEL, floor))

    def levels(tag):
        out = set()
        for r in rows:
            if r["_side"] != tag:
                continue
            e = r["_e"]
            if e == _INFINITE:
                out.add(TOP)
            else:
                lv = max(floor, e - shift)  # zero extent (sentinel) sits at the floor
                out.add(lv if lv <= MAX_LEVEL else TOP)
        return tuple(sorted(out))

    def count(tag):
        return int(sum(r["n"] for r in rows if r["_side"] == tag))

    return GridPlan(
        floor=floor,
        a_levels=levels("a"),
        b_levels=levels("b"),
        n_a=count("a"),
        n_b=count("b"),
        shift=shift,
    )


def plan_points_against(b: DataFrame, b_box) -> GridPlan:
    """Plan for joining points (any number, e.g. a stream) against the boxes ``b`` only.

    Points have zero extent, so they sit at the floor level; a point with an
    infinite coordinate can only lie in a box with an infinite corner, which is
    on ``TOP`` itself.  Hence the plan needs only one aggregate over ``b``.
    """
    p = plan_grid(b, b_box, b, b_box, shift=1)
    return GridPlan(floor=p.floor, a_levels=(p.floor,), b_levels=p.b_levels, n_a=0, n_b=p.n_b, shift=1)


def emit_cells(df: DataFrame, box, plan: GridPlan, other_levels, p: str) -> DataFrame:
    """Copy every row into the cells it covers at its own level and the other side's higher levels.

    Adds ``{p}own`` (own level), ``{p}lvl``, ``{p}cx``, ``{p}cy``.  Written
    without higher-order functions so the projection stays in codegen; a
    zero-extent side (point) takes one cell per level without ``explode``.
    """
    x1, y1, x2, y2 = box
    own, lvl = f"{p}own", f"{p}lvl"
    df = df.selectExpr("*", f"{plan.own_level_sql(*box)} AS {own}")
    if not other_levels:
        return df.selectExpr("*", f"CAST(NULL AS INT) AS {lvl}", f"0L AS {p}cx", f"0L AS {p}cy").filter(F.lit(False))
    lo = min(other_levels)
    # own level when some partner sits at or below it, plus every higher partner level
    options = [f"CASE WHEN {own} >= {lo} THEN {own} END"] + [
        f"CASE WHEN {int(v)} > {own} THEN {int(v)} END" for v in sorted(set(other_levels))
    ]
    df = df.selectExpr("*", f"explode(array({', '.join(options)})) AS {lvl}").filter(F.col(lvl).isNotNull())
    top = f"{lvl} = {TOP}"
    if x1 == x2 and y1 == y2:
        return df.selectExpr(
            "*",
            f"CASE WHEN {top} THEN 0L ELSE {sql_cell(_q(x1), lvl)} END AS {p}cx",
            f"CASE WHEN {top} THEN 0L ELSE {sql_cell(_q(y1), lvl)} END AS {p}cy",
        )

    def rng(lo_c, hi_c):
        return f"CASE WHEN {top} THEN array(0L) ELSE sequence({sql_cell(_q(lo_c), lvl)}, {sql_cell(_q(hi_c), lvl)}) END"

    return df.selectExpr("*", f"explode({rng(x1, x2)}) AS {p}cx").selectExpr(
        "*", f"explode({rng(y1, y2)}) AS {p}cy"
    )


def _hot_cells(a_cells: DataFrame, b_cells: DataFrame, f_a: float, f_b: float, hot_rows: int, hot_work: int):
    """Cells too big for one task, with salt counts per side.

    ``a_cells``/``b_cells`` are cell rows of samples of the inputs taken at
    fractions ``f_a``/``f_b`` (before emission, so this pass shuffles a small
    share of the input); each sampled row counts ``1/f``.  A cell is hot when
    one side has more than ``hot_rows`` rows or it holds more than ``hot_work``
    candidate pairs.  The larger side is split so each task gets about
    ``hot_work`` pairs; a side above ``hot_rows`` is split regardless, so both
    sides are split when both are large.  Returns ``(lvl, cx, cy, sa, sb)`` or
    None when no cell is hot.
    """
    wa, wb = repr(1.0 / f_a), repr(1.0 / f_b)
    least_a, least_b = (0.0 if f >= 1.0 else HOT_HITS / f for f in (f_a, f_b))
    tagged = a_cells.selectExpr(
        "_alvl AS lvl", "_acx AS cx", "_acy AS cy", f"{wa}D AS na", "0.0D AS nb"
    ).unionByName(b_cells.selectExpr("_blvl AS lvl", "_bcx AS cx", "_bcy AS cy", "0.0D AS na", f"{wb}D AS nb"))
    hot = (
        tagged.groupBy("lvl", "cx", "cy")
        .agg(F.sum("na").alias("ea"), F.sum("nb").alias("eb"))
        # a sampled side counts from HOT_HITS sampled rows on: fewer say nothing about the cell
        .selectExpr(
            "lvl", "cx", "cy", f"CASE WHEN ea >= {least_a!r}D THEN ea ELSE 0D END AS ea",
            f"CASE WHEN eb >= {least_b!r}D THEN eb ELSE 0D END AS eb",
        )
        .filter(f"ea > {hot_rows} OR eb > {hot_rows} OR ea * eb > {hot_work}")
        .withColumn("_size", F.expr("greatest(ea, eb, ea * eb)"))
        .selectExpr(
            "lvl",
            "cx",
            "cy",
            f"CAST(greatest(1, ceil(ea / {hot_rows}), CASE WHEN ea >= eb THEN ceil(ea * eb / {hot_work}) END) AS BIGINT) AS sa",
            f"CAST(greatest(1, ceil(eb / {hot_rows}), CASE WHEN ea < eb THEN ceil(ea * eb / {hot_work}) END) AS BIGINT) AS sb",
            "_size",
        )
        # the largest cells are split by salting; should there be more, AQE's skew join has the others
        .orderBy(F.desc("_size"), "lvl", "cx", "cy")
        .limit(MAX_BROADCAST_HOT)
        .drop("_size")
    )
    # written down once: both sides must salt by the same table
    table, _ = materialize(hot, "hot-cells")
    # at most MAX_BROADCAST_HOT rows, so the inputs are never shuffled on the unsalted cell key
    return None if table.isEmpty() else F.broadcast(table)


def _salt(df: DataFrame, hot: DataFrame, p: str, mine: str, theirs: str, hash_cols) -> DataFrame:
    """Salt rows of hot cells: a hashed bucket for this side, a copy per bucket of the other side."""
    h = hot.selectExpr(f"lvl AS {p}hl", f"cx AS {p}hx", f"cy AS {p}hy", f"{mine} AS {p}nm", f"{theirs} AS {p}nt")
    df = df.join(h, F.expr(f"{p}lvl = {p}hl AND {p}cx = {p}hx AND {p}cy = {p}hy"), "left")
    cols = ", ".join(_q(c) for c in hash_cols)
    df = df.selectExpr(
        "*",
        f"pmod(xxhash64({cols}), coalesce({p}nm, 1L)) AS {p}s_{mine}",
        f"explode(sequence(0L, coalesce({p}nt, 1L) - 1)) AS {p}s_{theirs}",
    )
    return df.drop(f"{p}hl", f"{p}hx", f"{p}hy", f"{p}nm", f"{p}nt")


def grid_join(
    a: DataFrame,
    a_box,
    b: DataFrame,
    b_box,
    predicate: Column,
    *,
    hot_rows: int = DEFAULT_HOT_ROWS,
    hot_work: int = DEFAULT_HOT_WORK,
    plan: GridPlan | None = None,
) -> DataFrame:
    """All (a row, b row) pairs whose boxes overlap and ``predicate`` holds.

    ``a`` and ``b`` must have disjoint column names; ``a_box``/``b_box`` name the
    (x1, y1, x2, y2) columns of each side, normalised so that x1 <= x2 and
    y1 <= y2 (a point passes (x, y, x, y)).  Rows
    with a NaN or null coordinate never match; infinite ones do.  The result
    keeps the columns of ``a`` and ``b`` only, one row per matching pair of
    input rows (duplicates on either side are kept).
    """
    a_cols, b_cols = list(a.columns), list(b.columns)
    a = a.filter(sql_not_nan(*set(a_box)))
    b = b.filter(sql_not_nan(*set(b_box)))
    a_point = a_box[0] == a_box[2] and a_box[1] == a_box[3]
    streaming = a.isStreaming or b.isStreaming
    if plan is None:
        plan = plan_grid(a, a_box, b, b_box, shift=1 if a_point else 0)
    if not plan.a_levels or not plan.b_levels:  # one side has no usable rows
        schema = T.StructType([a.schema[c] for c in a_cols] + [b.schema[c] for c in b_cols])
        return a.sparkSession.createDataFrame([], schema)

    a_cells = emit_cells(a, a_box, plan, plan.b_levels, "_a")
    b_cells = emit_cells(b, b_box, plan, plan.a_levels, "_b")

    keys = ["lvl", "cx", "cy"]
    hot = None
    # skip the pass when no cell can be hot: every cell is within both limits
    # (a stream cannot be sampled ahead of time: its micro-batches are joined as they come)
    if not streaming and (plan.n_a > hot_rows or plan.n_b > hot_rows or plan.n_a * plan.n_b > hot_work):
        # each side sampled to about HOT_SAMPLE_ROWS rows (a small side is counted exactly)
        # and never so thin that a few sampled rows stand for a hot cell
        f_a = min(1.0, max(HOT_SAMPLE_ROWS / max(1, plan.n_a), HOT_SAMPLES / hot_rows))
        f_b = min(1.0, max(HOT_SAMPLE_ROWS / max(1, plan.n_b), HOT_SAMPLES / hot_rows))
        a_s = a if f_a >= 1.0 else a.sample(fraction=f_a, seed=7)
        b_s = b if f_b >= 1.0 else b.sample(fraction=f_b, seed=11)
        hot = _hot_cells(
            emit_cells(a_s, a_box, plan, plan.b_levels, "_a"),
            emit_cells(b_s, b_box, plan, plan.a_levels, "_b"),
            f_a,
            f_b,
            hot_rows,
            hot_work,
        )
    if hot is not None:
        a_cells = _salt(a_cells, hot, "_a", "sa", "sb", a_cols)
        b_cells = _salt(b_cells, hot, "_b", "sb", "sa", b_cols)
        keys = keys + ["s_sa", "s_sb"]

    # only the larger side is the probe side of a broadcast join; when both are
    # large the sort-merge join partitions them on the key itself
    if streaming:
        pass
    elif plan.n_a >= plan.n_b:
        a_cells = spread(a_cells, plan.n_a, *[f"_a{k}" for k in keys])
    else:
        b_cells = spread(b_cells, plan.n_b, *[f"_b{k}" for k in keys])
    joined = a_cells.join(b_cells, _match(a_box, b_box, keys) & predicate, "inner")
    return joined.select(*a_cols, *b_cols)


def _match(a_box, b_box, keys) -> Column:
    """Equal cells, and the one cell of the pair: at the higher own level, holding the corner
    ``(max x1, max y1)`` of the intersection."""
    cond = " AND ".join(f"_a{k} = _b{k}" for k in keys) + " AND _alvl = greatest(_aown, _bown)"
    if not (a_box[0] == a_box[2] and a_box[1] == a_box[3]):
        # a point sits in one cell per level; boxes need the reference-cell rule
        rx = sql_cell(f"greatest({_q(a_box[0])}, {_q(b_box[0])})", "_alvl")
        ry = sql_cell(f"greatest({_q(a_box[1])}, {_q(b_box[1])})", "_alvl")
        cond += f" AND (_alvl = {TOP} OR ({rx} = _acx AND {ry} = _acy))"
    return F.expr(cond)


def join_cells(
    a_cells: DataFrame, a_box, b_cells: DataFrame, b_box, predicate: Column, n_a: int, n_b: int,
    *, hot_rows: int = DEFAULT_HOT_ROWS, hot_work: int = DEFAULT_HOT_WORK,
) -> DataFrame:
    """:func:`grid_join` of ``n_a`` and ``n_b`` rows already in cells (of :func:`emit_cells`, with
    prefixes ``_a`` and ``_b``), which may leave rows out of some cells.  Hot cells are counted
    exactly, unless the numbers of rows allow none."""
    keys = ["lvl", "cx", "cy"]
    a_cols, b_cols = a_cells.columns, b_cells.columns
    hot = None
    if n_a > hot_rows or n_b > hot_rows or n_a * n_b > hot_work:
        hot = _hot_cells(a_cells, b_cells, 1.0, 1.0, hot_rows, hot_work)
    if hot is not None:
        a_cells = _salt(a_cells, hot, "_a", "sa", "sb", [c for c in a_cols if not c.startswith("_")])
        b_cells = _salt(b_cells, hot, "_b", "sb", "sa", [c for c in b_cols if not c.startswith("_")])
        keys = keys + ["s_sa", "s_sb"]
    joined = a_cells.join(b_cells, _match(a_box, b_box, keys) & predicate, "inner")
    return joined.select(*(c for c in a_cols + b_cols if not c.startswith("_")))
