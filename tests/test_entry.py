import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["id"]
    assert df.count() >= 0


def test_every_query_has_an_oracle():
    extra = set(entry.queries()) - set(entry.oracle_sql())
    assert all(k == "pipeline" or k.startswith("op") for k in extra)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_queries_match_duckdb_oracle(spark):
    import math

    import duckdb
    import pandas as pd

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")

    def norm(v):
        # pandas holds a null number as NaN, None or NA, and then whole numbers as floats
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return ("null",)
        return int(v) if isinstance(v, float) and v.is_integer() else v

    for key, fn in entry.queries().items():
        if key not in entry.oracle_sql():
            continue
        got = fn(spark, SF).toPandas()
        exp = con.execute(entry.oracle_sql()[key]).df()
        assert sorted(got.columns) == sorted(exp.columns), key
        cols = sorted(got.columns)
        a = sorted((tuple(norm(r[c]) for c in cols) for r in got.to_dict("records")), key=repr)
        b = sorted((tuple(norm(r[c]) for c in cols) for r in exp.to_dict("records")), key=repr)
        assert a == b, key
