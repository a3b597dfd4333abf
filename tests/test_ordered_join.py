import random

import pytest
from conftest import points_df, rects_df

import __spark_entry__ as entry
from tessel import operators as ops
from tessel.operators import join as J
from tessel.sources.sinks import join_lines, write_lines


def scene(spark):
    rng = random.Random(4)
    a = points_df(spark, [(rng.uniform(0, 9), rng.uniform(0, 9)) for _ in range(150)])
    b = [(x, y, x + rng.uniform(0, 3), y + 2) for x, y in ((rng.uniform(0, 9), rng.uniform(0, 9)) for _ in range(90))]
    ids = [None, 7, 7, None, *rng.sample(range(-50, 500), 84), 7, 7]
    return a, rects_df(spark, [*b[:-2], b[1], (1, 1, float("nan"), 1)], ids)


@pytest.mark.parametrize("lists", [1000, 4])
def test_ordered_join_is_the_sorted_join(spark, monkeypatch, lists):
    monkeypatch.setattr(J, "ORDERED_LISTS", lists)
    a, b = scene(spark)
    got = ops.spatial_join_ordered(a, b)
    assert got.columns == ["bid", "aids"]
    rows = [(r.bid, r.aids) for r in got.collect()]
    assert [x for x, _ in rows] == [r.id for r in b.orderBy("id").collect()]
    assert sorted(rows, key=str) == sorted(((r.bid, r.aids) for r in ops.spatial_join(a, b).collect()), key=str)
    assert got.rdd.getNumPartitions() == (8 if lists == 1000 else 22)
    assert ops.spatial_join_ordered(a, b.limit(0)).count() == 0


def test_join_lines_of_an_ordered_join_sort_nothing_by_range(spark):
    """A sort by range makes every list twice: once for its sample of ids."""
    a, b = scene(spark)
    lines = join_lines(ops.spatial_join_ordered(a, b), ordered=True)
    assert "rangepartitioning" not in lines._jdf.queryExecution().toString()
    key = lambda x: x.split(",")[0]
    want = [r.value for r in join_lines(ops.spatial_join(a, b)).collect()]
    got = [r.value for r in lines.collect()]
    assert list(map(key, got)) == list(map(key, want)) and sorted(got) == sorted(want)


def test_lines_read_back_are_numbered_where_they_are(spark, tmp_path, monkeypatch):
    """Several files in several splits, read without a shuffle and without a copy."""
    monkeypatch.setattr(entry, "row_index", None)
    lines = [f"{i}," + "x" * (i * 7 % 90) for i in range(3000)]
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i long, value string")
    write_lines(frame.repartitionByRange(5, "i").sortWithinPartitions("i").select("value"), str(tmp_path / "out"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
        spark.conf.set("spark.sql.files.openCostInBytes", "2000")
        back = entry._read_back(spark, str(tmp_path / "out"))
        assert back.columns == ["pos", "value"]
        assert "Exchange" not in back._jdf.queryExecution().executedPlan().toString()
        rows = back.collect()
        assert back.rdd.getNumPartitions() > 8
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [r.value for r in sorted(rows)] == lines and sorted(r.pos for r in rows) == list(range(3000))
