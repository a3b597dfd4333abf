import math
import random

import pytest
from conftest import points_df, rects_df

from tessel import operators as ops
from tessel.plans import homes as H


@pytest.fixture
def always(monkeypatch):
    """Homes also for inputs too small or too thin for them, split and tested in small pieces."""
    used = []
    plain = H.partner_lists

    def noted(*args, **kwargs):
        out = plain(*args, **kwargs)
        used.append(out is not None)
        return out

    for name, value in (("MIN_PAIRS", 0), ("DENSE", 0), ("HOME_WORK", 3000), ("BLOCK", 300)):
        monkeypatch.setattr(H, name, value)
    monkeypatch.setattr("tessel.operators.join.partner_lists", noted)
    return used


def scene(rng, n, span, most, near=0.0):
    out = []
    for _ in range(n):
        x, y = near + rng.randint(0, span), near + rng.randint(0, span)
        w, h = rng.choice([0, 1, 2, most]), rng.uniform(0, most)
        out.append((x + w, y, x, y + h) if rng.random() < 0.3 else (x, y, x + w, y + h))
    return out


def forms(a, b, name):
    """The three forms by ids, each B row's list apart."""
    rows = lambda df, *names: sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)
    pairs = rows(ops.spatial_join_pairs(a, b, name), "bid", "aid")
    lists = rows(ops.spatial_join(a, b, name), "bid", "aids")
    return pairs, lists, rows(ops.spatial_join_chunks(a, b, name, size=3), "bid", "brow", "chunk", "aids")


def both(always, monkeypatch, a, b, name):
    got = forms(a, b, name)
    assert always == [True] * 3
    always.clear()
    monkeypatch.setattr(H, "MIN_PAIRS", math.inf)
    want = forms(a, b, name)
    assert always == [False] * 3
    return got, want


@pytest.mark.parametrize("name", ["within", "on_border"])
def test_points_in_every_form_as_by_pairs(spark, always, monkeypatch, name):
    rng = random.Random(name)
    pts = [(rng.randint(-20, 20), rng.randint(-20, 20) * 0.5) for _ in range(200)] + [(5, 5)] * 3 + [(math.nan, 1)]
    rects = scene(rng, 60, 30, 7, near=-15) + [(-9, -9, 9, 9), (3, 3, 3, 3), (3, 3, math.nan, 3)]
    rects += rects[:4] + [(0.0, -0.0, -math.inf, 4.0), (-math.inf, -math.inf, math.inf, math.inf)]
    a = points_df(spark, pts).unionByName(points_df(spark, pts[:9])).selectExpr("nullif(id, 7) AS id", "x", "y")
    b = rects_df(spark, rects, [i // 2 if i < 20 else i for i in range(len(rects) - 1)] + [None]).repartition(3)
    got, want = both(always, monkeypatch, a, b, name)
    assert got == want
    if name == "within":
        assert len(got[0]) > 400


@pytest.mark.parametrize("name", ["endpoint_overlap", "contains"])
def test_rectangles_in_every_form_as_by_pairs(spark, always, monkeypatch, name):
    rng = random.Random(name)
    a_r, b_r = scene(rng, 150, 40, 6), scene(rng, 100, 40, 8) + [(-1e6, -1e6, 1e6, 1e6), (1e15, 1e15, 1e15 + 2, 1e15 + 2)]
    a, b = rects_df(spark, a_r + b_r[:10] + b_r[-1:]), rects_df(spark, b_r)
    got, want = both(always, monkeypatch, a, b, name)
    assert got == want and len(got[1]) == len(b_r)


def test_homes_shuffle_no_pairs(spark, always):
    """900 points in each of 50 rectangles: the shuffles hold copies of rows, not the 45 000 pairs."""
    rng = random.Random(5)
    a = points_df(spark, [(rng.uniform(1, 2), rng.uniform(1, 2)) for _ in range(900)])
    b = rects_df(spark, [(0, 0, 3, 3)] * 50)
    plan = ops.spatial_join_text(a, b)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Aggregate" not in plan
    assert plan.index("MapInArrow") < plan.index("RepartitionByExpression")  # the shuffle comes before the pairs
    assert [len(r.aids) for r in ops.spatial_join(a, b).collect()] == [900] * 50


def test_thin_infinite_or_crowded_inputs_are_left_to_the_pair_join(spark, always, monkeypatch):
    small = [(i, i, i + 1, i + 1) for i in range(40)]
    far = points_df(spark, [(0, 0), (math.inf, 1)])
    assert sorted(r.aids for r in ops.spatial_join(far, rects_df(spark, [(0, 0, math.inf, 2)])).collect()) == [[0, 1]]
    monkeypatch.setattr(H, "DENSE", 32)
    assert ops.spatial_join_pairs(rects_df(spark, small), rects_df(spark, small)).count() == 118
    monkeypatch.setattr(H, "DENSE", 0)
    monkeypatch.setattr(H, "HOME_ROWS", 5)
    crowd = points_df(spark, [(0.5, 0.5)] * 6)
    assert [r.aids for r in ops.spatial_join(crowd, rects_df(spark, [(0, 0, 1, 1)])).collect()] == [list(range(6))]
    assert always == [False] * 3


def test_ordered_join_numbers_rectangles_not_lists(spark, always, monkeypatch, tmp_path):
    import __spark_entry__ as entry

    spark.range(40).selectExpr("id AS c_custkey", "CAST(id % 5 AS INT) AS c_nationkey", "1D * id AS c_acctbal").write.parquet(
        str(tmp_path / "customer.parquet")
    )
    part = spark.range(30).selectExpr("nullif(id DIV 2, 3) AS p_partkey", "CAST(id % 7 AS INT) AS p_size", "899D + id % 3 AS p_retailprice")
    part.write.parquet(str(tmp_path / "part.parquet"))
    numbered = []
    plain = entry.row_index
    monkeypatch.setattr(entry, "row_index", lambda df, *args: numbered.append(df.columns) or plain(df, *args))
    rows = entry.q_join_ordered(spark, str(tmp_path)).orderBy("pos").collect()
    assert numbered == [["id", "x1", "y1", "x2", "y2"]] and always == [True]
    assert [r.pos for r in rows] == list(range(30))
    assert [r.bid for r in rows] == sorted((r.bid for r in rows if r.bid is not None)) + [None] * 2
    a, b = (entry.fixture(spark, str(tmp_path), t) for t in ("rect_cust", "rect_part"))
    want = ops.spatial_join_text(a, b, "intersects").collect()
    assert sorted(((r.bid, r.aids) for r in rows), key=str) == sorted(((r.bid, r.aids) for r in want), key=str)
