"""G6 spatial join: points or rectangles (A) against rectangles (B).

Forms
    * :func:`spatial_join_pairs` -> ``(bid, aid)``, one row per matching pair of
      input rows.  This is the primary, fully distributed result.
    * :func:`spatial_join` -> ``(bid, aids)``: per B *row*, the A ids in
      ascending order (duplicates repeated), an empty array when none.  B rows
      with a NaN corner keep their row with an empty list.
    * :func:`spatial_join_text` -> ``(bid, aids)`` with ``aids`` as the text of
      an output line: ``"3,7,7"`` or ``"NULL"``.
    * :func:`spatial_join_ordered` -> the rows of :func:`spatial_join` in order of ``bid``.

Predicates (``predicate=``)
    ``within``            A inside B, inclusive (default for points)
    ``intersects``        closed intersection (default for rectangles)
    ``endpoint_overlap``  edge-end test, misses plus-sign crossings (parity)
    ``contains``          A contains B, inclusive
    ``on_border``         point A on an edge of B

Plan: both sides go through :func:`tessel.plans.grid.grid_join` (equi-join on
multi-level grid cells, salted hot cells), then the exact predicate.  The list
form groups pairs per distinct B row together with B's own rows, so duplicate B
rows each keep their list without row ids.  Where many boxes overlap, all forms
come from :func:`tessel.plans.homes.partner_lists` instead: the partners of a B row
are found in one task, and no pair is shuffled.  Lists are as long as the data makes
them; use the pairs form when one rectangle may match a large share of A.
"""

from __future__ import annotations


from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessel.functions import predicates as P
from tessel.plans.grid import grid_join, plan_grid
from tessel.plans.homes import partner_lists
from tessel.plans.indexing import row_index
from tessel.plans.partitioning import shuffle_partitions

RECT = ("x1", "y1", "x2", "y2")


def _is_points(df: DataFrame) -> bool:
    cols = set(df.columns)
    if {"x", "y"} <= cols:
        return True
    if set(RECT) <= cols:
        return False
    raise ValueError("expected columns x, y (points) or x1, y1, x2, y2 (rectangles)")


def _norm_rect(df: DataFrame, prefix: str, id_col: str) -> DataFrame:
    """id + corners sorted per axis + validity flag (no NaN/null corner).

    Rows with ``ok = false`` never enter a join; their sorted corners are
    meaningless but only ever compared with other invalid rows (``ok`` is part
    of every key they are grouped or joined on).
    """
    ok = P.valid_rect()
    cols = P.normalized_rect(alias=False)
    return df.select(
        F.col(id_col).alias(f"{prefix}id"),
        *[c.alias(f"{prefix}{n}") for c, n in zip(cols, RECT)],
        ok.alias(f"{prefix}ok"),
    )


def _a_side(a: DataFrame, id_col: str, carry: dict[str, Column] | None = None):
    """A projected to aid + coordinates (+ carried value columns), NaN rows removed."""
    carry = carry or {}
    extra = [c.alias(n) for n, c in carry.items()]
    if _is_points(a):
        side = a.select(
            F.col(id_col).alias("aid"), F.col("x").alias("ax"), F.col("y").alias("ay"), *extra
        ).filter(P.not_nan("ax", "ay"))
        return side, ("ax", "ay", "ax", "ay"), True
    ok = P.valid_rect()
    side = a.filter(ok).select(
        F.col(id_col).alias("aid"),
        *[c.alias(f"a{n}") for c, n in zip(P.normalized_rect(alias=False), RECT)],
        *extra,
    )
    return side, ("ax1", "ay1", "ax2", "ay2"), False


_B_BOX = ("bx1", "by1", "bx2", "by2")


def _name(predicate: str | None, points: bool) -> str:
    return predicate or ("within" if points else "intersects")


def _predicate(name: str | None, points: bool) -> Column:
    b = _B_BOX
    name = _name(name, points)
    if points:
        p = ("ax", "ay")
        if name in ("within", "intersects"):
            return P.point_in_rect(*p, *b)
        if name == "on_border":
            return P.point_on_border(*p, *b)
        if name == "contains":
            return P.rect_contains(*p, *p, *b)
        if name == "endpoint_overlap":
            return P.rect_endpoint_overlap(*p, *p, *b)
    else:
        a = ("ax1", "ay1", "ax2", "ay2")
        if name == "intersects":
            return P.rect_intersects(*a, *b)
        if name == "endpoint_overlap":
            return P.rect_endpoint_overlap(*a, *b)
        if name == "contains":
            return P.rect_contains(*a, *b)
        if name == "within":
            return P.rect_contains(*b, *a)
    raise ValueError(f"unknown predicate {name!r} for {'points' if points else 'rectangles'}")


def _pairs(a: DataFrame, b_norm: DataFrame, predicate, a_id: str, carry=None, plan=None) -> DataFrame:
    """grid join of A against normalised, valid B rows; keeps all B columns and A's."""
    side, box, points = _a_side(a, a_id, carry)
    pred = _predicate(predicate, points)
    b_valid = b_norm.filter("bok")
    return grid_join(side, box, b_valid, _B_BOX, pred, plan=plan)


def _lists_or_pairs(a: DataFrame, b_norm: DataFrame, predicate, a_id: str, size: int | None = None, null_ids=True):
    """``(lists, None)`` of the valid B rows where :func:`partner_lists` applies, else ``(None, plan)``."""
    side, box, points = _a_side(a, a_id)
    _predicate(predicate, points)  # raises for unknown names
    side = side if null_ids else side.filter("aid IS NOT NULL")
    b_valid = b_norm.filter("bok")
    if side.isStreaming or b_valid.isStreaming:
        return None, None
    plan = plan_grid(side, box, b_valid, _B_BOX, shift=1 if points else 0)
    lists = partner_lists(side, box, b_valid, _B_BOX, _name(predicate, points), plan, size)
    return (None, plan) if lists is None else (lists, None)


def spatial_join_pairs(
    a: DataFrame, b: DataFrame, predicate: str | None = None, *, a_id="id", b_id="id"
) -> DataFrame:
    """``(bid, aid)`` for every matching (B row, A row) pair."""
    bn = _norm_rect(b, "b", b_id)
    lists, plan = _lists_or_pairs(a, bn, predicate, a_id, size=CHUNK_IDS)
    if lists is not None:
        return lists.select("bid", F.explode("aids").alias("aid"))
    return _pairs(a, bn, predicate, a_id, plan=plan).select("bid", "aid")


_B_KEY = ["bid", "bx1", "by1", "bx2", "by2", "bok"]


def _row_key(bn: DataFrame) -> list[str]:
    """Narrowest key that names one distinct B row: ``bid`` alone when no id is shared by
    two different rectangles (one small job over B), else every B column."""
    key = F.struct(*[F.col(c) for c in _B_KEY[1:]])
    per_id = bn.groupBy("bid").agg((F.min(key) != F.max(key)).alias("shared"))
    shared = per_id.agg(F.max(F.col("shared").cast("int")).alias("s")).collect()[0]["s"]
    return list(_B_KEY) if shared else ["bid"]


def _per_b_row(b: DataFrame, b_id: str, pairs_of, aggs: list[Column]) -> DataFrame:
    """Aggregate pairs per B row; every B row (duplicates included) gets one output row.

    Pairs are computed against distinct B rows.  B's own rows are then added
    to the pairs with a null ``aid`` and weight 1, and one ``groupBy`` on the
    narrowest key naming a B row yields both the aggregates (which skip nulls,
    so a B row without partners gets an empty list / zero count) and the
    number of identical B rows, which ``explode`` turns back into that many
    output rows.  No join back to B, no row ids.
    """
    bn = _norm_rect(b, "b", b_id)
    distinct_b = bn.dropDuplicates(_B_KEY)
    # the row-key check (over B) is independent of the join's planning jobs:
    # submit it from a second thread so Spark runs both at once
    with ThreadPoolExecutor(max_workers=1) as pool:
        pending = pool.submit(inheritable_thread_target(bn.sparkSession)(_row_key), bn)
        pairs = pairs_of(distinct_b)
        key = pending.result()
    extra = [c for c in pairs.columns if c not in _B_KEY]
    tagged = pairs.select(*key, *extra, F.lit(0).alias("_w")).unionByName(
        bn.select(*key, *[F.lit(None).cast(pairs.schema[c].dataType).alias(c) for c in extra], F.lit(1).alias("_w"))
    )
    grouped = tagged.groupBy(*key).agg(*aggs, F.sum("_w").alias("_mult"))
    values = [c for c in grouped.columns if c not in key and c != "_mult"]
    return grouped.select("bid", *values, F.explode(F.sequence(F.lit(1), F.col("_mult").cast("int"))).alias("_k")).drop("_k")


def spatial_join(a: DataFrame, b: DataFrame, predicate: str | None = None, *, a_id="id", b_id="id") -> DataFrame:
    """``(bid, aids)`` per B row; ``aids`` ascending with duplicates, empty when none."""
    bn = _norm_rect(b, "b", b_id)
    lists, _ = _lists_or_pairs(a, bn, predicate, a_id, null_ids=False)
    if lists is not None:
        none = F.array().cast(lists.schema["aids"].dataType).alias("aids")
        return lists.select("bid", "aids").unionByName(bn.filter("NOT bok").select("bid", none))
    return _per_b_row(
        b,
        b_id,
        lambda bd: _pairs(a, bd, predicate, a_id),
        [F.sort_array(F.collect_list("aid")).alias("aids")],
    )


def spatial_join_text(a: DataFrame, b: DataFrame, predicate: str | None = None, *, a_id="id", b_id="id") -> DataFrame:
    """``(bid, aids)`` with ``aids`` as line text: ``"3,7,7"`` or ``"NULL"``."""
    lists = spatial_join(a, b, predicate, a_id=a_id, b_id=b_id)
    ids = F.array_join(F.col("aids").cast("array<string>"), ",")
    return lists.select("bid", F.when(F.size("aids") > 0, ids).otherwise(F.lit("NULL")).alias("aids"))


ORDERED_LISTS = 1000  # lists in one partition of an ordered join, about


def spatial_join_ordered(a: DataFrame, b: DataFrame, predicate: str | None = None, *, a_id="id", b_id="id") -> DataFrame:
    """``(bid, aids)`` as :func:`spatial_join`, ascending by ``bid`` (nulls first) from partition to partition.

    The B rows are numbered, not the lists: ``orderBy`` would make all lists twice, once to sample
    its ranges.  Known places deal them to their partitions in one shuffle.
    """
    placed = row_index(b.select(b_id, *RECT), [F.col(b_id).isNotNull(), b_id], "_place")
    n, parts = max(1, placed.count()), shuffle_partitions(b)
    parts = max(parts, min(n // ORDERED_LISTS, 16 * parts))
    placed = placed.select(F.struct(F.col(b_id).alias("id"), F.col("_place").alias("at")).alias("_b"), *RECT)
    lists = spatial_join(a, placed, predicate, a_id=a_id, b_id="_b")
    part = F.expr(f"CAST(bid.at * {parts} DIV {n} AS INT)")
    return lists.repartitionById(parts, part).sortWithinPartitions("bid.at").select(F.col("bid.id").alias("bid"), "aids")


CHUNK_IDS = 100_000  # ids in one chunk of a list


def spatial_join_chunks(
    a: DataFrame, b: DataFrame, predicate: str | None = None, *, a_id="id", b_id="id", size: int = CHUNK_IDS
) -> DataFrame:
    """``(bid, brow, chunk, aids)``: the lists of :func:`spatial_join` in numbered pieces of at most ``size`` ids.

    ``brow`` numbers the B rows by id, then corners, so rows that share an id keep lists of their own.
    Ids ascend inside a chunk and from chunk to chunk; a row without partners has one empty
    chunk.  Where boxes are dense a task cuts the lists of its rectangles; elsewhere pairs are sorted by range over
    all rows and numbered (:func:`row_index`), so a rectangle that matches every A row is spread over tasks.
    No row of the result is longer than a chunk.
    """
    bn = row_index(_norm_rect(b, "b", b_id), _B_KEY, "brow")
    found, plan = _lists_or_pairs(a, bn, predicate, a_id, size=size)
    if found is not None:
        out = found.select("bid", "brow", "chunk", F.array_compact("aids").alias("aids"))
        none = F.array().cast(out.schema["aids"].dataType).alias("aids")
        return out.unionByName(bn.filter("NOT bok").select("bid", "brow", F.lit(0).cast("long").alias("chunk"), none))
    pairs = _pairs(a, bn, predicate, a_id, plan=plan).select("brow", "bid", "aid")
    placed = row_index(pairs, ["brow", "aid"], "_at")
    first = placed.groupBy("brow").agg(F.min("_at").alias("_first"))
    chunk = F.floor((F.col("_at") - F.col("_first")) / F.lit(size)).alias("chunk")
    lists = placed.join(first, "brow").select("bid", "brow", chunk, "aid").groupBy("bid", "brow", "chunk")
    lists = lists.agg(F.sort_array(F.collect_list("aid")).alias("aids"))
    none = F.array().cast(lists.schema["aids"].dataType)
    alone = bn.join(first, "brow", "left_anti").select("bid", "brow", F.lit(0).cast("long").alias("chunk"), none.alias("aids"))
    return lists.unionByName(alone)
