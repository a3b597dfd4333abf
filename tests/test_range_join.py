import math
import random

from conftest import points_df, rects_df

from tessel import operators as ops
from tessel.plans.grid import grid_join


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_range_border_swapped_nan(spark):
    pts = points_df(spark, [(0, 0), (1, 1), (2, 2), (float("nan"), 0.5), (0.5, float("inf"))])
    assert _ids(ops.range_query(pts, (0, 0, 1, 1))) == [0, 1]
    assert _ids(ops.range_query(pts, (1, 1, 0, 0))) == [0, 1]
    assert _ids(ops.range_query(pts, (float("nan"), 0, 1, 1))) == []
    assert _ids(ops.range_query(pts, (0, 0, 1, float("inf")))) == [0, 1, 4]
    assert _ids(ops.points_on_border(pts, (0, 0, 2, 2))) == [0, 2]


def test_range_pushdown(spark, tmp_path):
    path = str(tmp_path / "p.parquet")
    points_df(spark, [(i, i) for i in range(100)]).write.parquet(path)
    plan = ops.range_query(spark.read.parquet(path), (10, 10, 20, 20))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(x,10.0)" in plan


def _brute_points(pts, rects, pred="within"):
    out = []
    for bi, (x1, y1, x2, y2) in enumerate(rects):
        lx, hx, ly, hy = min(x1, x2), max(x1, x2), min(y1, y2), max(y1, y2)
        for ai, (x, y) in enumerate(pts):
            if any(math.isnan(v) for v in (x, y, x1, y1, x2, y2)):
                continue
            if lx <= x <= hx and ly <= y <= hy:
                if pred == "on_border" and not (x in (lx, hx) or y in (ly, hy)):
                    continue
                out.append((bi, ai))
    return sorted(out)


def _brute_rects(a, b, pred):
    out = []
    for bi, (bx1, by1, bx2, by2) in enumerate(b):
        bx1, bx2, by1, by2 = min(bx1, bx2), max(bx1, bx2), min(by1, by2), max(by1, by2)
        for ai, (ax1, ay1, ax2, ay2) in enumerate(a):
            ax1, ax2, ay1, ay2 = min(ax1, ax2), max(ax1, ax2), min(ay1, ay2), max(ay1, ay2)
            inter = ax1 <= bx2 and bx1 <= ax2 and ay1 <= by2 and by1 <= ay2
            if pred == "intersects":
                ok = inter
            elif pred == "contains":
                ok = ax1 <= bx1 and ax2 >= bx2 and ay1 <= by1 and ay2 >= by2
            elif pred == "within":
                ok = bx1 <= ax1 and bx2 >= ax2 and by1 <= ay1 and by2 >= ay2
            else:
                def inn(v, lo, hi):
                    return lo <= v <= hi
                ok = ((inn(ax1, bx1, bx2) or inn(ax2, bx1, bx2)) and (inn(ay1, by1, by2) or inn(ay2, by1, by2))) or (
                    (inn(bx1, ax1, ax2) or inn(bx2, ax1, ax2)) and (inn(by1, ay1, ay2) or inn(by2, ay1, ay2))
                )
            if ok:
                out.append((bi, ai))
    return sorted(out)


def _pairs(df):
    return sorted((r.bid, r.aid) for r in df.collect())


def _scene(rng, n, span, max_side):
    rects = []
    for _ in range(n):
        x, y = rng.randint(0, span), rng.randint(0, span)
        w, h = rng.randint(0, max_side), rng.randint(0, max_side)
        rects.append((x + w, y, x, y + h) if rng.random() < 0.3 else (x, y, x + w, y + h))
    return rects


def test_point_join_vs_brute_force(spark):
    rng = random.Random(1)
    pts = [(rng.randint(0, 40), rng.randint(0, 40)) for _ in range(300)] + [(5, 5)] * 3
    rects = _scene(rng, 60, 40, 12) + [(0, 0, 40, 40), (3, 3, 3, 3)]
    a, b = points_df(spark, pts), rects_df(spark, rects)
    assert _pairs(ops.spatial_join_pairs(a, b)) == _brute_points(pts, rects)
    assert _pairs(ops.spatial_join_pairs(a, b, "on_border")) == _brute_points(pts, rects, "on_border")


def test_rect_join_vs_brute_force(spark):
    rng = random.Random(2)
    a_r = _scene(rng, 120, 50, 15) + [(0, 0, 1000, 1000)]
    b_r = _scene(rng, 80, 50, 6) + [(-5, -5, 60, 60)]
    a, b = rects_df(spark, a_r), rects_df(spark, b_r)
    for pred in ("intersects", "endpoint_overlap", "contains", "within"):
        assert _pairs(ops.spatial_join_pairs(a, b, pred)) == _brute_rects(a_r, b_r, pred), pred


def test_hot_cell_salting_keeps_every_pair(spark):
    # one cell holds most points: force the salting path with tiny limits
    pts = [(1 + (i % 7) * 0.01, 1 + (i // 7) * 0.01) for i in range(700)] + [(30, 30), (31, 31)]
    rects = [(0, 0, 2, 2), (0.5, 0.5, 1.5, 1.5), (29, 29, 32, 32)]
    a = points_df(spark, pts).selectExpr("id AS aid", "x AS ax", "y AS ay")
    b = rects_df(spark, rects).selectExpr("id AS bid", "x1 AS bx1", "y1 AS by1", "x2 AS bx2", "y2 AS by2")
    from tessel.functions.predicates import point_in_rect

    got = grid_join(a, ("ax", "ay", "ax", "ay"), b, ("bx1", "by1", "bx2", "by2"),
                    point_in_rect("ax", "ay", "bx1", "by1", "bx2", "by2"), hot_rows=50, hot_work=500)
    assert _pairs(got.select("bid", "aid")) == _brute_points(pts, rects)


def test_list_form_duplicates_nan_and_no_hit(spark):
    pts = points_df(spark, [(1, 1), (1, 1), (2, 2)], with_id=False).selectExpr("CAST(3 AS LONG) AS id", "x", "y")
    rects = rects_df(
        spark, [(0, 0, 3, 3), (0, 0, 3, 3), (50, 50, 60, 60), (0, 0, float("nan"), 3)], ids=[1, 1, 2, 4]
    )
    got = sorted((r.bid, r.aids) for r in ops.spatial_join_text(pts, rects).collect())
    assert got == [(1, "3,3,3"), (1, "3,3,3"), (2, "NULL"), (4, "NULL")]


def test_infinite_coordinates(spark):
    pts = points_df(spark, [(float("inf"), 1), (5, 5), (-float("inf"), -float("inf"))])
    rects = rects_df(spark, [(0, 0, float("inf"), 10), (4, 4, 6, 6), (-float("inf"), -float("inf"), 0, 0)])
    got = _pairs(ops.spatial_join_pairs(pts, rects))
    assert got == [(0, 0), (0, 1), (1, 1), (2, 2)]


def test_partition_invariance(spark):
    rng = random.Random(3)
    pts = [(rng.random() * 10, rng.random() * 10) for _ in range(400)]
    rects = _scene(rng, 40, 9, 3)
    base = _pairs(ops.spatial_join_pairs(points_df(spark, pts), rects_df(spark, rects)))
    for n in (1, 4, 64):
        a = points_df(spark, pts).repartition(n)
        b = rects_df(spark, rects).repartition(n)
        assert _pairs(ops.spatial_join_pairs(a, b)) == base


def test_aggregates(spark):
    pts = points_df(spark, [(1, 1), (2, 2), (2, 2), (9, 9)])
    rects = rects_df(spark, [(0, 0, 3, 3), (8, 8, 10, 10), (20, 20, 21, 21)])
    got = sorted(tuple(r) for r in ops.spatial_aggregate(pts, rects, value="x").select("bid", "n_points", "sum_value", "max_value").collect())
    assert got == [(0, 3, 5.0, 2.0), (1, 1, 9.0, 9.0), (2, 0, None, None)]
    cells = sorted(tuple(r) for r in ops.grid_aggregate(pts, 5.0).select("cx", "cy", "n_points").collect())
    assert cells == [(0, 0, 3), (1, 1, 1)]


def test_grid_join_plan_is_equi_join(spark):
    pts = points_df(spark, [(i % 17, i % 13) for i in range(500)])
    rects = rects_df(spark, [(i, i, i + 2, i + 2) for i in range(20)])
    plan = ops.spatial_join_pairs(pts, rects)._jdf.queryExecution().executedPlan().toString()
    assert ("SortMergeJoin" in plan or "BroadcastHashJoin" in plan) and "NestedLoop" not in plan and "Cartesian" not in plan


def test_multilevel_extents_vs_brute_force(spark):
    # extents from 1e-6 to 1e6 and negative coordinates: many grid levels at once
    rng = random.Random(17)

    def box(scale):
        x, y = rng.uniform(-1e3, 1e3), rng.uniform(-1e3, 1e3)
        w, h = rng.random() * scale, rng.random() * scale
        return (x, y, x + w, y + h)

    scales = [0.0, 1e-6, 1e-3, 1.0, 30.0, 1e3, 1e6]
    a_r = [box(rng.choice(scales)) for _ in range(250)]
    b_r = [box(rng.choice(scales)) for _ in range(150)]
    a_r += b_r[:20]  # exact duplicates across sides
    a, b = rects_df(spark, a_r), rects_df(spark, b_r)
    assert _pairs(ops.spatial_join_pairs(a, b, "intersects")) == _brute_rects(a_r, b_r, "intersects")
    assert _pairs(ops.spatial_join_pairs(b, a, "intersects")) == _brute_rects(b_r, a_r, "intersects")
    pts = [(r[0], r[1]) for r in a_r] + [(rng.uniform(-1e3, 1e3), rng.uniform(-1e3, 1e3)) for _ in range(200)]
    assert _pairs(ops.spatial_join_pairs(points_df(spark, pts), b)) == _brute_points(pts, b_r)


def test_sampled_hot_detection_keeps_every_pair(spark, monkeypatch):
    import tessel.plans.grid as G
    from tessel.functions.predicates import point_in_rect

    monkeypatch.setattr(G, "HOT_SAMPLE_ROWS", 60)  # force sampling (fraction < 1) on small data
    monkeypatch.setattr(G, "HOT_SAMPLES", 6)
    monkeypatch.setattr(G, "HOT_HITS", 2)
    rng = random.Random(31)
    pts = [(1 + rng.random(), 1 + rng.random()) for _ in range(900)] + [(rng.uniform(0, 40), rng.uniform(0, 40)) for _ in range(300)]
    rects = _scene(rng, 120, 38, 4) + [(0, 0, 3, 3)] * 5
    a = points_df(spark, pts).selectExpr("id AS aid", "x AS ax", "y AS ay")
    # grid_join takes normalised boxes (the public operators normalise first)
    b = rects_df(spark, rects).selectExpr(
        "id AS bid", "least(x1, x2) AS bx1", "least(y1, y2) AS by1", "greatest(x1, x2) AS bx2", "greatest(y1, y2) AS by2"
    )
    got = grid_join(a, ("ax", "ay", "ax", "ay"), b, ("bx1", "by1", "bx2", "by2"),
                    point_in_rect("ax", "ay", "bx1", "by1", "bx2", "by2"), hot_rows=40, hot_work=400)
    assert _pairs(got.select("bid", "aid")) == _brute_points(pts, rects)


def test_uniform_cells_are_not_hot_when_a_sampled_row_weighs_more_than_the_limit(spark):
    from tessel.plans import grid as G

    a = spark.range(4000).selectExpr("1 AS _alvl", "id % 400 AS _acx", "0L AS _acy")
    b = spark.range(4000).selectExpr("1 AS _blvl", "id % 400 AS _bcx", "0L AS _bcy")
    # every sampled row stands for 1000: far above the limit of 100 rows
    assert G._hot_cells(a.sample(0.05, seed=1), b.sample(0.05, seed=2), 0.001, 0.001, 100, 10**5) is None
    crowded = a.unionByName(spark.range(400).selectExpr("1 AS _alvl", "7L AS _acx", "0L AS _acy"))
    hot = G._hot_cells(crowded, b.limit(0), 0.001, 0.001, 100, 10**12).collect()
    assert any(r.cx == 7 and r.sa > 1 for r in hot)


def test_floor_follows_the_cost_not_the_median_size(spark):
    from tessel.plans.grid import plan_grid

    rng = random.Random(41)
    pts = [(rng.uniform(0, 100), rng.uniform(0, 100)) for _ in range(4000)]
    tiny = [(x, y, x + 0.1, y + 0.1) for x, y in ((rng.uniform(0, 100), rng.uniform(0, 100)) for _ in range(400))]
    away = [(x, 5000, x + 90, 5090) for x in (rng.uniform(5000, 9000) for _ in range(440))]
    a = points_df(spark, pts)
    box, rect = ("x", "y", "x", "y"), ("x1", "y1", "x2", "y2")
    small = plan_grid(a, box, rects_df(spark, tiny), rect, shift=1).floor
    # larger rectangles elsewhere outnumber the tiny ones, which keep their small cells
    assert plan_grid(a, box, rects_df(spark, tiny + away), rect, shift=1).floor == small
    assert _pairs(ops.spatial_join_pairs(a, rects_df(spark, tiny + away))) == _brute_points(pts, tiny + away)
    # a few rectangles on each of many levels: no copy of every point for each of them
    tail = [(50, 50, 50 + 2.0**-k, 50 + 2.0**-k) for k in range(1, 30)]
    plan = plan_grid(a, box, rects_df(spark, tail), rect, shift=1)
    assert len(plan.b_levels) <= 4
    assert _pairs(ops.spatial_join_pairs(a, rects_df(spark, tail))) == _brute_points(pts, tail)


def test_join_of_cell_rows_splits_hot_cells_and_keeps_every_pair(spark):
    from tessel.functions.predicates import rect_intersects
    from tessel.plans import grid as G

    rng = random.Random(7)
    a_r, b_r = ([(x, y, x + 2, y + 2) for x, y in ((rng.uniform(0, 6), rng.uniform(0, 6)) for _ in range(n))] for n in (90, 40))
    a_box, b_box = (tuple(f"{p}{c}" for c in ("x1", "y1", "x2", "y2")) for p in "ab")
    a, b = (
        rects_df(spark, r).selectExpr(f"id AS {p}id", *[f"{c} AS {p}{c}" for c in ("x1", "y1", "x2", "y2")])
        for p, r in (("a", a_r), ("b", b_r))
    )
    plan = G.plan_grid(a, a_box, b, b_box)
    cells = G.emit_cells(a, a_box, plan, plan.b_levels, "_a"), G.emit_cells(b, b_box, plan, plan.a_levels, "_b")
    got = G.join_cells(cells[0], a_box, cells[1], b_box, rect_intersects(*a_box, *b_box), 90, 40, hot_rows=5, hot_work=50)
    assert got.columns == ["aid", *a_box, "bid", *b_box]
    assert _pairs(got.select("bid", "aid")) == _brute_rects(a_r, b_r, "intersects")
