"""Geometry fixtures derived from the driver's Parquet tables.

Each fixture is a Spark projection over one table and has a DuckDB twin so the
same rows can be rebuilt by the SQL oracle.  Both sides compute every value with
the same double operations in the same order, so results compare bit for bit.
Projections only: Catalyst prunes the scan to the referenced columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Columns the fixtures read, with their Parquet types: an explicit schema skips
# schema inference (one job per read) and prunes the scan to these columns.
_SCHEMAS = {
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>",
    "customer": "c_custkey BIGINT, c_nationkey INT, c_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE",
    "part": "p_partkey BIGINT, p_size INT, p_retailprice DOUBLE",
    "supplier": "s_suppkey BIGINT, s_nationkey INT, s_acctbal DOUBLE",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _d(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _epoch_days(c: str) -> Column:
    """epoch seconds / 86400 of a TIMESTAMP_NTZ, independent of the session time zone."""
    ts = F.col(c)
    secs = (
        F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("double") * 86400.0
        + F.hour(ts) * 3600.0
        + F.minute(ts) * 60.0
        + F.second(ts)
    )
    return secs / 86400.0


def pts_emb(spark, sf_dir):
    e = _table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("id"),
        _d(F.col("embedding")[0]).alias("x"),
        _d(F.col("embedding")[1]).alias("y"),
    )


def pts_cust(spark, sf_dir):
    c = _table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), _d("c_nationkey").alias("x"), _d("c_acctbal").alias("y"))


def pts_ord(spark, sf_dir):
    o = _table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        (_d("o_totalprice") / 1000.0).alias("x"),
        _epoch_days("o_orderdate").alias("y"),
    )


def pts_line(spark, sf_dir):
    li = _table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("id"),
        _d("l_quantity").alias("x"),
        (F.lit(900.0) + _d("l_extendedprice") / 1050.0).alias("y"),
    )


def rect_part(spark, sf_dir):
    p = _table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        _d("p_size").alias("x1"),
        _d("p_retailprice").alias("y1"),
        (_d("p_size") + 2.0).alias("x2"),
        (_d("p_retailprice") + 3.0).alias("y2"),
    )


def rect_cust(spark, sf_dir):
    c = _table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("id"),
        (_d("c_nationkey") * 2.0).alias("x1"),
        (F.lit(900.0) + _d("c_acctbal") / 100.0).alias("y1"),
        (_d("c_nationkey") * 2.0 + 5.0).alias("x2"),
        (F.lit(901.0) + _d("c_acctbal") / 100.0).alias("y2"),
    )


def _rect_supp(spark, sf_dir, dx: float, dy: float):
    s = _table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("id"),
        _d("s_nationkey").alias("x1"),
        (_d("s_acctbal") / 100.0).alias("y1"),
        (_d("s_nationkey") + dx).alias("x2"),
        (_d("s_acctbal") / 100.0 + dy).alias("y2"),
    )


def rect_supp_many(spark, sf_dir):
    return _rect_supp(spark, sf_dir, 3.0, 12.0)


def rect_supp_one(spark, sf_dir):
    return _rect_supp(spark, sf_dir, 6.0, 30.0)


def rect_chain(spark, sf_dir):
    """End-to-end unit rectangles, a region as long as the table, in no order of place."""
    p = _table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("id"),
        _d("p_partkey").alias("x1"),
        F.lit(0.0).alias("y1"),
        (_d("p_partkey") + 1.0).alias("x2"),
        F.lit(1.0).alias("y2"),
    ).orderBy(F.xxhash64("id"))


FIXTURES = {
    "rect_chain": rect_chain,
    "pts_emb": pts_emb,
    "pts_cust": pts_cust,
    "pts_ord": pts_ord,
    "pts_line": pts_line,
    "rect_part": rect_part,
    "rect_cust": rect_cust,
    "rect_supp_many": rect_supp_many,
    "rect_supp_one": rect_supp_one,
}

# DuckDB twins of the fixtures above (tables are pre-registered views).
FIXTURE_SQL = {
    "rect_chain": "SELECT p_partkey AS id, CAST(p_partkey AS DOUBLE) AS x1, CAST(0 AS DOUBLE) AS y1, "
    "CAST(p_partkey AS DOUBLE) + 1.0 AS x2, CAST(1 AS DOUBLE) AS y2 FROM part",
    "pts_emb": "SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS x, "
    "CAST(embedding[2] AS DOUBLE) AS y FROM embeddings",
    "pts_cust": "SELECT c_custkey AS id, CAST(c_nationkey AS DOUBLE) AS x, "
    "CAST(c_acctbal AS DOUBLE) AS y FROM customer",
    "pts_ord": "SELECT o_orderkey AS id, CAST(o_totalprice AS DOUBLE) / 1000.0 AS x, "
    "CAST(epoch(o_orderdate) AS DOUBLE) / 86400.0 AS y FROM orders",
    "pts_line": "SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS id, "
    "CAST(l_quantity AS DOUBLE) AS x, "
    "CAST(900.0 AS DOUBLE) + CAST(l_extendedprice AS DOUBLE) / 1050.0 AS y FROM lineitem",
    "rect_part": "SELECT p_partkey AS id, CAST(p_size AS DOUBLE) AS x1, "
    "CAST(p_retailprice AS DOUBLE) AS y1, CAST(p_size AS DOUBLE) + 2.0 AS x2, "
    "CAST(p_retailprice AS DOUBLE) + 3.0 AS y2 FROM part",
    "rect_cust": "SELECT c_custkey AS id, CAST(c_nationkey AS DOUBLE) * 2.0 AS x1, "
    "CAST(900.0 AS DOUBLE) + CAST(c_acctbal AS DOUBLE) / 100.0 AS y1, "
    "CAST(c_nationkey AS DOUBLE) * 2.0 + 5.0 AS x2, "
    "CAST(901.0 AS DOUBLE) + CAST(c_acctbal AS DOUBLE) / 100.0 AS y2 FROM customer",
    "rect_supp_many": "SELECT s_suppkey AS id, CAST(s_nationkey AS DOUBLE) AS x1, "
    "CAST(s_acctbal AS DOUBLE) / 100.0 AS y1, CAST(s_nationkey AS DOUBLE) + 3.0 AS x2, "
    "CAST(s_acctbal AS DOUBLE) / 100.0 + 12.0 AS y2 FROM supplier",
    "rect_supp_one": "SELECT s_suppkey AS id, CAST(s_nationkey AS DOUBLE) AS x1, "
    "CAST(s_acctbal AS DOUBLE) / 100.0 AS y1, CAST(s_nationkey AS DOUBLE) + 6.0 AS x2, "
    "CAST(s_acctbal AS DOUBLE) / 100.0 + 30.0 AS y2 FROM supplier",
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return FIXTURES[name](spark, sf_dir)
