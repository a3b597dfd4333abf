"""

Every query reads the driver's Parquet tables through the fixtures in
``tessel.sources.tables`` (whole tables, no row caps) and runs one library
operator.  Each oracle is brute-force SQL over the same fixtures, written
independently of the Spark plan (nested-loop joins, all-pairs scans).
"""

from __future__ import annotations

import importlib.util
import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tessel import jobs  # noqa: E402
from tessel import operators as ops  # noqa: E402
from tessel.plans.indexing import row_index  # noqa: E402
from tessel.session import ensure_checkpoint_dir  # noqa: E402
from tessel.sources import join_lines, parse_lines, point_lines, rejected_lines  # noqa: E402
from tessel.sources.sinks import write_lines  # noqa: E402
from tessel.sources.tables import FIXTURE_SQL, fixture  # noqa: E402
from tessel.sources.text import POINT_FIELDS, RECT_FIELDS  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"

# Fixed query parameters (the oracle SQL below uses the same literals).
EMB_WINDOW = (-0.1, -0.1, 0.1, 0.1)
BORDER_WINDOW = (10.0, 920.0, 20.0, 960.0)
GRID_W, GRID_H = 10.0, 100.0


def _with(*names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({FIXTURE_SQL[n]})" for n in names) + " "


# ---------------------------------------------------------------- Spark side


def q_range_query(spark, d):
    return ops.range_query(fixture(spark, d, "pts_emb"), EMB_WINDOW)


def q_points_on_border(spark, d):
    return ops.points_on_border(fixture(spark, d, "pts_line"), BORDER_WINDOW)


def q_join_point_pairs(spark, d):
    return ops.spatial_join_pairs(fixture(spark, d, "pts_line"), fixture(spark, d, "rect_part"), "within")


def q_join_point_list(spark, d):
    return ops.spatial_join_text(fixture(spark, d, "pts_line"), fixture(spark, d, "rect_part"), "within")


def q_join_point_border(spark, d):
    return ops.spatial_join_pairs(fixture(spark, d, "pts_line"), fixture(spark, d, "rect_part"), "on_border")


def q_join_rect_pairs(spark, d):
    return ops.spatial_join_pairs(fixture(spark, d, "rect_cust"), fixture(spark, d, "rect_part"), "intersects")


def q_join_rect_intersects(spark, d):
    return ops.spatial_join_text(fixture(spark, d, "rect_cust"), fixture(spark, d, "rect_part"), "intersects")


def q_join_rect_endpoint(spark, d):
    return ops.spatial_join_text(
        fixture(spark, d, "rect_cust"), fixture(spark, d, "rect_part"), "endpoint_overlap"
    )


def q_join_rect_contains(spark, d):
    return ops.spatial_join_text(
        fixture(spark, d, "rect_supp_one"), fixture(spark, d, "rect_supp_many"), "contains"
    )


def q_spatial_aggregate(spark, d):
    agg = ops.spatial_aggregate(fixture(spark, d, "pts_line"), fixture(spark, d, "rect_part"), value="x")
    return agg.select("bid", "n_points", "sum_value", "min_value", "max_value")


def q_grid_aggregate(spark, d):
    agg = ops.grid_aggregate(fixture(spark, d, "pts_ord"), GRID_W, GRID_H, value="x")
    return agg.select("cx", "cy", "n_points", "min_value", "max_value")


def q_distinct_points(spark, d):
    return ops.distinct_points(fixture(spark, d, "pts_cust"))


def q_envelope(spark, d):
    return ops.envelope(fixture(spark, d, "rect_supp_many"))


def q_closest_pair(spark, d):
    return ops.closest_pair(fixture(spark, d, "pts_ord"))


def q_closest_pair_cust(spark, d):
    return ops.closest_pair(fixture(spark, d, "pts_cust"))


def q_convex_hull(spark, d):
    return ops.convex_hull(fixture(spark, d, "pts_emb"))


def q_convex_hull_cust(spark, d):
    return ops.convex_hull(fixture(spark, d, "pts_cust"))


def q_farthest_pair(spark, d):
    return ops.farthest_pair(fixture(spark, d, "pts_ord"))


def q_farthest_pair_emb(spark, d):
    return ops.farthest_pair(fixture(spark, d, "pts_emb"))


def q_union_boundary(spark, d):
    return ops.rectangle_union(fixture(spark, d, "rect_supp_one"))


def q_union_envelope(spark, d):
    return ops.rectangle_union(fixture(spark, d, "rect_supp_many"))


def q_union_boundary_collinear(spark, d):
    return ops.rectangle_union(fixture(spark, d, "rect_supp_one"), keep_collinear=True)


def q_spatial_aggregate_avg(spark, d):
    agg = ops.spatial_aggregate(fixture(spark, d, "pts_line"), fixture(spark, d, "rect_part"), value="x")
    return agg.select("bid", "n_points", "avg_value")


def q_grid_aggregate_sum(spark, d):
    agg = ops.grid_aggregate(fixture(spark, d, "pts_ord"), GRID_W, GRID_H, value="y")
    return agg.select("cx", "cy", "sum_value", "avg_value")


def q_union_chain(spark, d):
    return ops.rectangle_union(fixture(spark, d, "rect_chain"))


def q_join_point_swapped(spark, d):
    r = fixture(spark, d, "rect_part")
    odd = F.col("id") % 2 == 1
    swapped = r.select(
        "id",
        F.when(odd, F.col("x2")).otherwise(F.col("x1")).alias("x1"),
        F.when(odd, F.col("y2")).otherwise(F.col("y1")).alias("y1"),
        F.when(odd, F.col("x1")).otherwise(F.col("x2")).alias("x2"),
        F.when(odd, F.col("y1")).otherwise(F.col("y2")).alias("y2"),
    )
    return ops.spatial_join_pairs(fixture(spark, d, "pts_line"), swapped, "within")


def _lines(df, *cols, tail):
    """Rows of a table as text lines; ``tail`` is an expression for what follows the last field."""
    return df.select(F.concat(F.concat_ws(",", *(F.col(c).cast("string") for c in cols)), tail).alias("value"))


def _point_lines(spark, d, with_id):
    p = fixture(spark, d, "pts_line")
    kind = F.col("id") % 4
    # trailing commas, a padded number, a line with a field too many
    tail = F.when(kind == 1, ",,").when(kind == 2, " ").when(kind == 3, ",77").otherwise("")
    return _lines(p, *(["id"] if with_id else []), "x", "y", tail=tail)


def q_text_points(spark, d):
    return parse_lines(_point_lines(spark, d, False), POINT_FIELDS, False)


def q_text_id_points(spark, d):
    return parse_lines(_point_lines(spark, d, True), POINT_FIELDS, True)


def q_text_rejected(spark, d):
    bad = rejected_lines(_point_lines(spark, d, False), POINT_FIELDS, False)
    return bad.agg(F.count("*").alias("n_rejected"))


def q_text_rectangles(spark, d):
    lines = _lines(fixture(spark, d, "rect_part"), "x1", "y1", "x2", "y2", tail=F.lit(","))
    return parse_lines(lines, RECT_FIELDS, False)


def q_text_id_rectangles(spark, d):
    tail = F.when(F.col("id") % 2 == 1, ",extra").otherwise("")
    return parse_lines(_lines(fixture(spark, d, "rect_part"), "id", "x1", "y1", "x2", "y2", tail=tail), RECT_FIELDS, True)


def q_lines_points(spark, d):
    return point_lines(fixture(spark, d, "pts_cust"))


def q_lines_join(spark, d):
    lists = ops.spatial_join_ordered(fixture(spark, d, "pts_line"), fixture(spark, d, "rect_part"), "within")
    return join_lines(lists, ordered=True)


def q_range_query_ordered(spark, d):
    """O2: the ascending ids with their place in the order."""
    found = ops.range_query(fixture(spark, d, "pts_line"), BORDER_WINDOW, sort=False)
    return row_index(found, ["id"], "pos")


def q_points_ordered(spark, d):
    """O1: points by x, then y, with their place in the order."""
    return row_index(fixture(spark, d, "pts_line").select("x", "y"), ["x", "y"], "pos")


def q_join_ordered(spark, d):
    """O3: join rows by ``bid`` with their place in the order (there is one for each rectangle, so the
    rectangles are numbered, not their lists)."""
    placed = row_index(fixture(spark, d, "rect_part"), ["id"], "pos")
    placed = placed.select(F.struct("id", "pos").alias("id"), "x1", "y1", "x2", "y2")
    joined = ops.spatial_join_text(fixture(spark, d, "rect_cust"), placed, "intersects")
    return joined.select("bid.id", "aids", "bid.pos").toDF("bid", "aids", "pos")


def _text_job(spark, command, inputs, *after):
    """Run a text job on ``inputs`` (tables of lines, written to the shared folder) and read its files back:
    the lines with their place in the files (files by name, then from the top)."""
    folder = f"{ensure_checkpoint_dir(spark)}/job-{uuid.uuid4().hex}"
    paths = [f"{folder}/in{i}" for i in range(len(inputs))]
    for lines, path in zip(inputs, paths):
        write_lines(lines, path)
    jobs.run(spark, [*command, *paths, f"{folder}/out", *after])
    return _read_back(spark, f"{folder}/out")


def _read_back(spark, path):
    """Lines with their place, counted for each split of a file; the lines themselves are not moved."""
    lines = spark.read.text(path).select("value", "_metadata.file_name", "_metadata.file_block_start")
    splits = lines.groupBy("file_name", "file_block_start").count().collect()  # one row a split
    begins, total = {}, 0
    for r in sorted(splits, key=lambda r: (r["file_name"], r["file_block_start"])):
        begins[r["file_name"], r["file_block_start"]] = total
        total += r["count"]

    def placed(batches):
        at = dict(begins)  # the next place of each split; a split not counted above is an error
        for batch in batches:
            name, start = batch.column("file_name").dictionary_encode(), batch.column("file_block_start").to_numpy()
            code = name.indices.to_numpy()
            cut = (np.flatnonzero((code[1:] != code[:-1]) | (start[1:] != start[:-1])) + 1).tolist()
            pos = np.empty(len(start), np.int64)
            for lo, hi in zip([0, *cut], [*cut, len(start)]):
                if lo < hi:
                    key = name.dictionary[int(code[lo])].as_py(), int(start[lo])
                    pos[lo:hi] = np.arange(at[key], at[key] + hi - lo)
                    at[key] += hi - lo
            yield pa.RecordBatch.from_arrays([pa.array(pos), batch.column("value")], names=["pos", "value"])

    return lines.mapInArrow(placed, "pos long, value string")


def _id_lines(df, *cols):
    return _lines(df, "id", *cols, tail=F.lit(""))


def _window_lines(spark, window):
    """A window file: only its first valid line counts."""
    lines = ["not a window", ",".join(map(str, window)), "0,0,1,1"]
    return spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)


def q_job_range(spark, d):
    """Text in, text out: points and a window file, ids in ordered part files."""
    return _text_job(spark, ["range"], [_id_lines(fixture(spark, d, "pts_line"), "x", "y"), _window_lines(spark, BORDER_WINDOW)])


def q_job_range_single_file(spark, d):
    points = _id_lines(fixture(spark, d, "pts_line"), "x", "y")
    return _text_job(spark, ["--single-file", "range"], [points, _window_lines(spark, BORDER_WINDOW)])


def q_job_join_point(spark, d):
    points = _id_lines(fixture(spark, d, "pts_line"), "x", "y")
    rects = _id_lines(fixture(spark, d, "rect_part"), "x1", "y1", "x2", "y2")
    return _text_job(spark, ["join"], [points, rects], "point")


def q_job_join_rectangle(spark, d):
    a, b = (_id_lines(fixture(spark, d, t), "x1", "y1", "x2", "y2") for t in ("rect_cust", "rect_part"))
    return _text_job(spark, ["join"], [a, b], "rectangle")


def q_join_point_chunks(spark, d):
    """The lists of a join in chunks, each as the text of its ids."""
    chunks = ops.spatial_join_chunks(fixture(spark, d, "pts_line"), fixture(spark, d, "rect_part"), "within", size=50)
    return chunks.select("bid", "chunk", F.array_join(F.col("aids").cast("array<string>"), ",").alias("aids"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "range_query": q_range_query,
    "points_on_border": q_points_on_border,
    "join_point_pairs": q_join_point_pairs,
    "join_point_list": q_join_point_list,
    "join_point_border": q_join_point_border,
    "join_rect_pairs": q_join_rect_pairs,
    "join_rect_intersects": q_join_rect_intersects,
    "join_rect_endpoint": q_join_rect_endpoint,
    "join_rect_contains": q_join_rect_contains,
    "spatial_aggregate": q_spatial_aggregate,
    "grid_aggregate": q_grid_aggregate,
    "distinct_points": q_distinct_points,
    "envelope": q_envelope,
    "closest_pair": q_closest_pair,
    "closest_pair_cust": q_closest_pair_cust,
    "convex_hull": q_convex_hull,
    "convex_hull_cust": q_convex_hull_cust,
    "farthest_pair": q_farthest_pair,
    "farthest_pair_emb": q_farthest_pair_emb,
    "union_boundary": q_union_boundary,
    "union_envelope": q_union_envelope,
    "union_boundary_collinear": q_union_boundary_collinear,
    "union_chain": q_union_chain,
    "spatial_aggregate_avg": q_spatial_aggregate_avg,
    "grid_aggregate_sum": q_grid_aggregate_sum,
    "join_point_swapped": q_join_point_swapped,
    "text_points": q_text_points,
    "text_id_points": q_text_id_points,
    "text_rejected": q_text_rejected,
    "text_rectangles": q_text_rectangles,
    "text_id_rectangles": q_text_id_rectangles,
    "lines_points": q_lines_points,
    "lines_join": q_lines_join,
    "range_query_ordered": q_range_query_ordered,
    "points_ordered": q_points_ordered,
    "join_ordered": q_join_ordered,
    "join_point_chunks": q_join_point_chunks,
    "job_range": q_job_range,
    "job_range_single_file": q_job_range_single_file,
    "job_join_point": q_job_join_point,
    "job_join_rectangle": q_job_join_rectangle,
}

# ---------------------------------------------------------------- DuckDB side

_D = "CAST({} AS DOUBLE)".format


def _win(w) -> str:
    x1, y1, x2, y2 = (_D(v) for v in w)
    return x1, y1, x2, y2


_ex1, _ey1, _ex2, _ey2 = _win(EMB_WINDOW)
_bx1, _by1, _bx2, _by2 = _win(BORDER_WINDOW)

_LIST = (
    "SELECT b.id AS bid, COALESCE(string_agg(CAST(a.id AS VARCHAR), ',' ORDER BY a.id), 'NULL') AS aids "
    "FROM {b} b LEFT JOIN {a} a ON {cond} GROUP BY b.id"
)
_PT_IN = "a.x >= b.x1 AND a.x <= b.x2 AND a.y >= b.y1 AND a.y <= b.y2"
_RECT_INTERSECTS = "a.x1 <= b.x2 AND b.x1 <= a.x2 AND a.y1 <= b.y2 AND b.y1 <= a.y2"
_RECT_ENDPOINT = (
    "(((a.x1 BETWEEN b.x1 AND b.x2) OR (a.x2 BETWEEN b.x1 AND b.x2)) "
    "AND ((a.y1 BETWEEN b.y1 AND b.y2) OR (a.y2 BETWEEN b.y1 AND b.y2))) OR "
    "(((b.x1 BETWEEN a.x1 AND a.x2) OR (b.x2 BETWEEN a.x1 AND a.x2)) "
    "AND ((b.y1 BETWEEN a.y1 AND a.y2) OR (b.y2 BETWEEN a.y1 AND a.y2)))"
)
_RECT_CONTAINS = "a.x1 <= b.x1 AND a.x2 >= b.x2 AND a.y1 <= b.y1 AND a.y2 >= b.y2"


def _distinct(fx: str) -> str:
    return _with(fx) + f", p AS (SELECT DISTINCT x, y FROM {fx} WHERE isfinite(x) AND isfinite(y)) "


_D2 = "(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)"


def _pair_sql(fx: str, desc: bool) -> str:
    order = f"{_D2} DESC" if desc else _D2
    return _distinct(fx) + (
        f'SELECT a.x AS ax, a.y AS ay, b.x AS bx, b.y AS "by", sqrt({_D2}) AS distance '
        "FROM p a JOIN p b ON a.x < b.x OR (a.x = b.x AND a.y < b.y) "
        f"ORDER BY {order}, a.x, a.y, b.x, b.y LIMIT 1"
    )


def _hull_sql(fx: str) -> str:
    # a point is a hull vertex when the other points leave an angular gap wider than pi around it
    return _distinct(fx) + (
        ", ang AS (SELECT a.x, a.y, atan2(b.y - a.y, b.x - a.x) AS t FROM p a JOIN p b ON a.x <> b.x OR a.y <> b.y)"
        ", o AS (SELECT x, y, t, lead(t) OVER (PARTITION BY x, y ORDER BY t) AS nt, "
        "min(t) OVER (PARTITION BY x, y) AS t0 FROM ang)"
        ", g AS (SELECT x, y, max(coalesce(nt - t, t0 + 2 * pi() - t)) AS gap FROM o GROUP BY x, y) "
        "SELECT x, y FROM g WHERE gap > pi() + 1e-9 "
        "UNION ALL SELECT x, y FROM p WHERE (SELECT count(*) FROM p) = 1"
    )


def _union_sql(fx: str, collinear: bool = False) -> str:
    """Union oracle: parts by recursive reachability over the rectangles, vertices from a
    compressed coordinate grid whose cells are covered or not."""
    ov_x, ov_y = "least(a.x2, b.x2) - greatest(a.x1, b.x1)", "least(a.y2, b.y2) - greatest(a.y1, b.y1)"
    return (
        f"WITH RECURSIVE {fx} AS ({FIXTURE_SQL[fx]}), "
        "r AS (SELECT DISTINCT least(x1, x2) AS x1, least(y1, y2) AS y1, greatest(x1, x2) AS x2, "
        f"greatest(y1, y2) AS y2 FROM {fx} WHERE isfinite(x1) AND isfinite(y1) AND isfinite(x2) AND isfinite(y2)), "
        "rr AS (SELECT * FROM r WHERE x1 < x2 AND y1 < y2), "
        "n AS (SELECT row_number() OVER (ORDER BY x1, y1, x2, y2) AS id, * FROM rr), "
        f"e AS (SELECT a.id AS s, b.id AS d FROM n a JOIN n b ON {ov_x} >= 0 AND {ov_y} >= 0 "
        f"AND ({ov_x} > 0 OR {ov_y} > 0)), "
        "reach(s, d) AS (SELECT s, d FROM e UNION SELECT reach.s, e.d FROM reach JOIN e ON reach.d = e.s), "
        "parts AS (SELECT count(DISTINCT m) AS c FROM (SELECT s, min(d) AS m FROM reach GROUP BY s)), "
        "xi AS (SELECT x, row_number() OVER (ORDER BY x) AS i FROM (SELECT x1 AS x FROM rr UNION SELECT x2 FROM rr)), "
        "yj AS (SELECT y, row_number() OVER (ORDER BY y) AS j FROM (SELECT y1 AS y FROM rr UNION SELECT y2 FROM rr)), "
        "cov AS (SELECT DISTINCT xi.i, yj.j FROM rr JOIN xi ON rr.x1 <= xi.x AND xi.x < rr.x2 "
        "JOIN yj ON rr.y1 <= yj.y AND yj.y < rr.y2), "
        "mk AS (SELECT xi.x, yj.y, "
        "max(CASE WHEN c.i = xi.i AND c.j = yj.j THEN 1 ELSE 0 END) AS ne, "
        "max(CASE WHEN c.i = xi.i - 1 AND c.j = yj.j THEN 1 ELSE 0 END) AS nw, "
        "max(CASE WHEN c.i = xi.i - 1 AND c.j = yj.j - 1 THEN 1 ELSE 0 END) AS sw, "
        "max(CASE WHEN c.i = xi.i AND c.j = yj.j - 1 THEN 1 ELSE 0 END) AS se "
        "FROM xi, yj, cov c WHERE c.i BETWEEN xi.i - 1 AND xi.i AND c.j BETWEEN yj.j - 1 AND yj.j "
        "GROUP BY xi.x, yj.y), "
        + (
            # nodes on straight edges too, but only at side corners and side crossings
            "cand AS (SELECT x1 AS x, y1 AS y FROM rr UNION SELECT x1, y2 FROM rr UNION SELECT x2, y1 FROM rr "
            "UNION SELECT x2, y2 FROM rr UNION SELECT v.vx, h.hy FROM "
            "(SELECT x1 AS vx, y1, y2 FROM rr UNION ALL SELECT x2, y1, y2 FROM rr) v JOIN "
            "(SELECT y1 AS hy, x1, x2 FROM rr UNION ALL SELECT y2, x1, x2 FROM rr) h "
            "ON h.x1 <= v.vx AND v.vx <= h.x2 AND v.y1 <= h.hy AND h.hy <= v.y2), "
            "bnd AS (SELECT mk.x, mk.y FROM mk JOIN cand ON mk.x = cand.x AND mk.y = cand.y "
            "WHERE ne + nw + sw + se BETWEEN 1 AND 3), "
            if collinear
            else "bnd AS (SELECT x, y FROM mk WHERE ne + nw + sw + se IN (1, 3) OR (ne + nw + sw + se = 2 AND ne = sw)), "
        )
        + "env AS (SELECT DISTINCT x, y FROM (SELECT min(x1) AS lx, min(y1) AS ly, max(x2) AS hx, max(y2) AS hy "
        "FROM rr) b, LATERAL (VALUES (lx, ly), (lx, hy), (hx, ly), (hx, hy)) AS t(x, y) WHERE lx IS NOT NULL) "
        "SELECT x, y FROM bnd WHERE (SELECT c FROM parts) = 1 "
        "UNION ALL SELECT x, y FROM env WHERE (SELECT c FROM parts) > 1"
    )


_IN_BORDER = f"x >= {_bx1} AND x <= {_bx2} AND y >= {_by1} AND y <= {_by2}"
_JOB_RANGE = (
    _with("pts_line")
    + f"SELECT row_number() OVER (ORDER BY id) - 1 AS pos, CAST(id AS VARCHAR) AS value FROM pts_line WHERE {_IN_BORDER}"
)


def _job_join(a: str, b: str, cond: str) -> str:
    joined = _with(a, b) + _LIST.format(b=b, a=a, cond=cond)
    return f"SELECT row_number() OVER (ORDER BY bid) - 1 AS pos, CAST(bid AS VARCHAR) || ',' || aids AS value FROM ({joined}) t"


ORACLE: dict[str, str] = {
    "range_query": _with("pts_emb")
    + f"SELECT id FROM pts_emb WHERE x >= {_ex1} AND x <= {_ex2} AND y >= {_ey1} AND y <= {_ey2}",
    "points_on_border": _with("pts_line")
    + f"SELECT id FROM pts_line WHERE x >= {_bx1} AND x <= {_bx2} AND y >= {_by1} AND y <= {_by2} "
    f"AND (x = {_bx1} OR x = {_bx2} OR y = {_by1} OR y = {_by2})",
    "join_point_pairs": _with("pts_line", "rect_part")
    + f"SELECT b.id AS bid, a.id AS aid FROM rect_part b JOIN pts_line a ON {_PT_IN}",
    "join_point_list": _with("pts_line", "rect_part") + _LIST.format(b="rect_part", a="pts_line", cond=_PT_IN),
    "join_point_border": _with("pts_line", "rect_part")
    + f"SELECT b.id AS bid, a.id AS aid FROM rect_part b JOIN pts_line a ON {_PT_IN} "
    "AND (a.x = b.x1 OR a.x = b.x2 OR a.y = b.y1 OR a.y = b.y2)",
    "join_rect_pairs": _with("rect_cust", "rect_part")
    + f"SELECT b.id AS bid, a.id AS aid FROM rect_part b JOIN rect_cust a ON {_RECT_INTERSECTS}",
    "join_rect_intersects": _with("rect_cust", "rect_part")
    + _LIST.format(b="rect_part", a="rect_cust", cond=_RECT_INTERSECTS),
    "join_rect_endpoint": _with("rect_cust", "rect_part")
    + _LIST.format(b="rect_part", a="rect_cust", cond=f"({_RECT_ENDPOINT})"),
    "join_rect_contains": _with("rect_supp_one", "rect_supp_many")
    + _LIST.format(b="rect_supp_many", a="rect_supp_one", cond=_RECT_CONTAINS),
    "spatial_aggregate": _with("pts_line", "rect_part")
    + "SELECT b.id AS bid, count(a.id) AS n_points, sum(a.x) AS sum_value, min(a.x) AS min_value, "
    f"max(a.x) AS max_value FROM rect_part b LEFT JOIN pts_line a ON {_PT_IN} GROUP BY b.id",
    "grid_aggregate": _with("pts_ord")
    + f"SELECT CAST(floor(x / {_D(GRID_W)}) AS BIGINT) AS cx, CAST(floor(y / {_D(GRID_H)}) AS BIGINT) AS cy, "
    "count(*) AS n_points, min(x) AS min_value, max(x) AS max_value FROM pts_ord "
    "WHERE NOT isnan(x) AND NOT isnan(y) GROUP BY 1, 2",
    "closest_pair": _pair_sql("pts_ord", desc=False),
    "closest_pair_cust": _pair_sql("pts_cust", desc=False),
    "convex_hull": _hull_sql("pts_emb"),
    "convex_hull_cust": _hull_sql("pts_cust"),
    "farthest_pair": _pair_sql("pts_ord", desc=True),
    "farthest_pair_emb": _pair_sql("pts_emb", desc=True),
    "union_boundary": _union_sql("rect_supp_one"),
    "union_envelope": _union_sql("rect_supp_many"),
    "union_boundary_collinear": _union_sql("rect_supp_one", collinear=True),
    # end-to-end rectangles: one region when no position is missing, so its four corners
    "union_chain": _with("rect_chain")
    + "SELECT DISTINCT x, y FROM (SELECT min(x1) AS lx, max(x2) AS hx, min(y1) AS ly, max(y2) AS hy FROM rect_chain) e, "
    "LATERAL (VALUES (lx, ly), (lx, hy), (hx, ly), (hx, hy)) AS c(x, y)",
    "spatial_aggregate_avg": _with("pts_line", "rect_part")
    + "SELECT b.id AS bid, count(a.id) AS n_points, avg(a.x) AS avg_value "
    f"FROM rect_part b LEFT JOIN pts_line a ON {_PT_IN} GROUP BY b.id",
    "grid_aggregate_sum": _with("pts_ord")
    + f"SELECT CAST(floor(x / {_D(GRID_W)}) AS BIGINT) AS cx, CAST(floor(y / {_D(GRID_H)}) AS BIGINT) AS cy, "
    "sum(y) AS sum_value, avg(y) AS avg_value FROM pts_ord WHERE NOT isnan(x) AND NOT isnan(y) GROUP BY 1, 2",
    "join_point_swapped": _with("pts_line", "rect_part")
    + f"SELECT b.id AS bid, a.id AS aid FROM rect_part b JOIN pts_line a ON {_PT_IN}",
    "text_points": _with("pts_line") + "SELECT x, y FROM pts_line WHERE id % 4 <> 3",
    "text_id_points": _with("pts_line") + "SELECT id, x, y FROM pts_line",
    "text_rejected": _with("pts_line") + "SELECT count(*) AS n_rejected FROM pts_line WHERE id % 4 = 3",
    "text_rectangles": _with("rect_part") + "SELECT x1, y1, x2, y2 FROM rect_part",
    "text_id_rectangles": _with("rect_part") + "SELECT id, x1, y1, x2, y2 FROM rect_part",
    "lines_points": _with("pts_cust")
    + "SELECT CAST(x AS VARCHAR) || ',' || CAST(y AS VARCHAR) AS value FROM pts_cust",
    "lines_join": "SELECT CAST(bid AS VARCHAR) || ',' || aids AS value FROM ("
    + _with("pts_line", "rect_part") + _LIST.format(b="rect_part", a="pts_line", cond=_PT_IN) + ") t",
    "range_query_ordered": _with("pts_line") + f"SELECT id, row_number() OVER (ORDER BY id) - 1 AS pos FROM pts_line WHERE {_IN_BORDER}",
    "points_ordered": _with("pts_line") + "SELECT x, y, row_number() OVER (ORDER BY x, y) - 1 AS pos FROM pts_line",
    "join_ordered": "SELECT bid, aids, row_number() OVER (ORDER BY bid) - 1 AS pos FROM ("
    + _with("rect_cust", "rect_part") + _LIST.format(b="rect_part", a="rect_cust", cond=_RECT_INTERSECTS) + ") t",
    "join_point_chunks": _with("pts_line", "rect_part")
    + "SELECT bid, chunk, coalesce(string_agg(CAST(aid AS VARCHAR), ',' ORDER BY aid), '') AS aids FROM ("
    "SELECT b.id AS bid, a.id AS aid, (row_number() OVER (PARTITION BY b.id ORDER BY a.id) - 1) // 50 AS chunk "
    f"FROM rect_part b LEFT JOIN pts_line a ON {_PT_IN}) GROUP BY bid, chunk",
    "job_range": _JOB_RANGE,
    "job_range_single_file": _JOB_RANGE,
    "job_join_point": _job_join("pts_line", "rect_part", _PT_IN),
    "job_join_rectangle": _job_join("rect_cust", "rect_part", _RECT_INTERSECTS),
    "distinct_points": _with("pts_cust") + "SELECT DISTINCT x, y FROM pts_cust WHERE NOT isnan(x) AND NOT isnan(y)",
    "envelope": _with("rect_supp_many")
    + "SELECT DISTINCT x, y FROM (SELECT min(least(x1, x2)) AS lx, min(least(y1, y2)) AS ly, "
    "max(greatest(x1, x2)) AS hx, max(greatest(y1, y2)) AS hy FROM rect_supp_many) e, "
    "LATERAL (VALUES (lx, ly), (lx, hy), (hx, ly), (hx, hy)) AS c(x, y)",
}


def _add_training_data_queries() -> None:
    """Add the queries of the ``llm`` subpackage and the pipeline where they are installed."""
    if importlib.util.find_spec("tessel.llm") is not None:
        from tessel.llm import queries as llm

        QUERIES.update(llm.QUERIES)
        ORACLE.update(llm.ORACLE)
        if importlib.util.find_spec("corpus_pipeline") is not None:
            import corpus_pipeline

            QUERIES["pipeline"] = corpus_pipeline.run
            if corpus_pipeline.ORACLE_SQL:
                ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL


_add_training_data_queries()


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: range query over the embedding points at sf0.001."""
    return q_range_query(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
