import random

import pytest
from pyspark.sql import functions as F

from tessel import operators as ops
from tessel.operators.join import _a_side, _norm_rect
from tessel.plans import components, quadtree
from tessel.plans.indexing import row_index
from tests.conftest import points_df, rects_df


def totals(spark, pts, rects):
    return ops.spatial_aggregate(pts, rects, value="x").select("bid", "n_points", "sum_value", "min_value", "max_value", "avg_value")


def brute(pts, rects):
    out = []
    for i, (a, b, c, d) in rects:
        ok = all(v == v for v in (a, b, c, d))
        x1, x2, y1, y2 = min(a, c), max(a, c), min(b, d), max(b, d)
        v = [x for x, y in pts if ok and x == x and y == y and x1 <= x <= x2 and y1 <= y <= y2]
        out.append((i, len(v), sum(v) if v else None, min(v, default=None), max(v, default=None), sum(v) / len(v) if v else None))
    return sorted(out, key=str)


def close(a, b):
    return a == b or (a is not None and b is not None and abs(a - b) <= 1e-9 * max(1, abs(a), abs(b)))


def check(spark, pts, rects):
    got = totals(spark, points_df(spark, pts), rects_df(spark, [r for _, r in rects], [i for i, _ in rects]))
    got, want = sorted((tuple(r) for r in got.collect()), key=str), brute(pts, rects)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: (r[0], r[1])), sorted(want, key=lambda r: (r[0], r[1]))):
        assert g[:2] == w[:2] and all(close(a, b) for a, b in zip(g[2:], w[2:])), (g, w)


INF, NAN = float("inf"), float("nan")
SHAPES = {
    "uniform": lambda r: (r.uniform(0, 1000), r.uniform(-500, 500)),
    "grid": lambda r: (float(r.randrange(40)), float(r.randrange(40))),
    "clusters": lambda r: (r.choice([0, 1e6]) + r.gauss(0, 1e-3), r.choice([0, 1e6]) + r.gauss(0, 1e-3)),
    "line": lambda r: (5.0, r.uniform(0, 10)),
    "one place": lambda r: (3.0, 4.0),
    "far away": lambda r: (1e15 + r.randrange(64), -1e15 + r.randrange(64)),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_totals_match_brute_force(spark, monkeypatch, shape):
    monkeypatch.setattr(quadtree, "CROWDED", 40)  # several rounds on small data
    rng = random.Random(shape)
    pts = [SHAPES[shape](rng) for _ in range(700)]
    pts += pts[:5] + [(NAN, 1.0), (INF, 2.0), (pts[0][0], -INF)]
    xs, ys = zip(*pts[:700])
    rects = []
    for i in range(60):
        a, c = (rng.choice(xs) + rng.choice([0, 0, rng.gauss(0, (max(xs) - min(xs)) / 50 + 1e-9)]) for _ in range(2))
        b, d = (rng.choice(ys) + rng.choice([0, 0, rng.gauss(0, (max(ys) - min(ys)) / 50 + 1e-9)]) for _ in range(2))
        rects.append((i, (a, b, c, d)))
    rects += [(60, (-INF, -INF, INF, INF)), (61, (NAN, 0, 1, 1)), (62, (min(xs), min(ys), max(xs), max(ys)))]
    rects += [(63, (1e300, 1e300, 1e301, 1e301)), (3, rects[3][1]), (3, rects[4][1]), (64, (xs[0], -INF, xs[0], INF))]
    check(spark, pts, rects)


def test_no_points_and_no_rectangles(spark):
    rects = [(0, (0, 0, 1, 1)), (1, (NAN, 0, 1, 1))]
    check(spark, [(NAN, NAN)], rects)
    check(spark, [(INF, 0.5)], [*rects, (2, (0, 0, INF, 1))])
    assert totals(spark, points_df(spark, [(0, 0)]), rects_df(spark, [(0, 0, 1, 1)]).limit(0)).count() == 0


def test_rows_grow_with_the_border_not_with_the_pairs(spark):
    rng = random.Random(3)
    rects = rects_df(spark, [(x, y, x + 300, y + 300) for x, y in ((rng.uniform(0, 700), rng.uniform(0, 700)) for _ in range(40))])
    sizes, pairs = [], []
    for n in (4_000, 64_000):
        pts = points_df(spark, [(rng.uniform(0, 1000), rng.uniform(0, 1000)) for _ in range(n)])
        side, _, _ = _a_side(pts, "id")
        b = _norm_rect(rects, "b", "id").filter("bok")
        part = quadtree.partial_totals(side, b, False)
        sizes.append(part.count())
        pairs.append(part.agg(F.sum("_n")).first()[0])
    assert pairs[1] > 14 * pairs[0]
    assert sizes[1] < 6 * sizes[0]  # 16 times the points, 4 times the border
    assert sizes[1] < 0.06 * pairs[1]


@pytest.mark.parametrize("small", [0, 10**6])
def test_components_in_rounds_or_in_one_task(spark, monkeypatch, small):
    monkeypatch.setattr(components, "SMALL", small)
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(200)] + [(7, 7)]
    label = {}

    def root(x):
        label.setdefault(x, x)
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = root(a), root(b)
            label[max(a, b)] = min(a, b)
    got = {r.id: r.label for r in components.edge_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {x: root(x) for x in label}
    assert components.edge_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_row_index_is_the_global_order(spark):
    rng = random.Random(6)
    rows = [(rng.choice([None, rng.randrange(50)]), f"t{i}", i) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, row string, c0 int").repartition(7)
    out = row_index(df, ["a", "c0"], "ROWS", start=3)
    assert out.columns == ["a", "row", "c0", "ROWS"]
    got = sorted(out.collect(), key=lambda r: r.ROWS)
    assert [r.ROWS for r in got] == list(range(3, 503))
    assert [r.c0 for r in got] == [r[2] for r in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))]
    assert row_index(df.limit(0), ["a"]).count() == 0
