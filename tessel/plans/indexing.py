"""Consecutive row numbers in a global order (``orderBy`` made visible as a column).

``row_number() OVER (ORDER BY ...)`` would sort all rows in one task.  Here the rows are
range-partitioned and sorted, numbered inside their partition and written down; one count
for each partition comes back, and the running total of these counts is added.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessel.plans.partitioning import shuffle_partitions
from tessel.session import materialize


def unused(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``_name``, ``__name``, ... that no column of ``df`` has in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _numbered(batches):
    from pyspark import TaskContext

    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        more = pa.array(np.full(n, part), pa.int32()), pa.array(np.arange(at, at + n), pa.int64())
        at += n
        yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "p", "i"])


def row_index(df: DataFrame, order: list[Column | str], name: str = "row", start: int = 0) -> DataFrame:
    """``df`` with ``name long``: the place of each row in ``order``, from ``start``, without gaps.

    Rows equal in ``order`` are numbered in any order, each once; they may share tasks with no
    others, so add columns to ``order`` where many rows can be equal.  Numbers are written down
    before they are used: a lost executor cannot renumber rows.
    """
    if not df.columns:
        raise ValueError("row_index needs a column")
    columns = [f"c{i}" for i in range(len(df.columns))]  # any names, also repeated or clashing ones
    keyed = df.select("*", *[(c if isinstance(c, Column) else F.col(c)).alias(f"_order_{i}") for i, c in enumerate(order)])
    keys = [f"k{i}" for i in range(len(order))]
    plain = keyed.toDF(*columns, *keys)
    ordered = plain.repartitionByRange(shuffle_partitions(df), *map(_sorted, keys)).sortWithinPartitions(*map(_sorted, keys))
    ordered = ordered.select(*columns)
    kinds = T.StructType(list(ordered.schema.fields)).add("p", T.IntegerType()).add("i", T.LongType())
    numbered, _ = materialize(ordered.mapInArrow(_numbered, kinds), "rows")
    sizes = {r["p"]: r["n"] for r in numbered.groupBy("p").agg(F.count("*").alias("n")).collect()}  # one a partition
    begins, total = [], start
    for p in range(max(sizes, default=-1) + 1):
        begins.append(total)
        total += sizes.get(p, 0)
    begin = F.element_at(F.array(*map(_long, begins or [start])), F.col("p") + 1)
    out = numbered.select(*columns, (F.col("i") + begin).alias(name))
    return out.toDF(*df.columns, name)


def _sorted(key: str) -> Column:
    return F.col(key).asc_nulls_last()


def _long(n: int) -> Column:
    return F.lit(n).cast("long")
