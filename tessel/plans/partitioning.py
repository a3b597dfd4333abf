"""Partitioning helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame

SPREAD_ROWS = 4_000_000  # inputs of fewer rows may sit in one or two scan splits


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Hash-partition a ``df`` of ``rows`` input rows on ``keys`` when that is few.

    A small input file is often a single scan split; everything narrow after it
    (explode, the probe side of a broadcast join) would then run in one task.
    Partitioning on the join key costs one shuffle of an input that is small by
    definition and is reused by a sort-merge join on the same key.  Larger inputs
    have splits enough and are left alone.  Decided from a count the caller already
    has: asking the plan for its partitions would run shuffles under it.
    """
    if rows > SPREAD_ROWS:
        return df
    # no fixed count: AQE may coalesce the result when the input is tiny
    return df.repartition(*keys) if keys else df.repartition(shuffle_partitions(df))
