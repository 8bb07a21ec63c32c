"""The driver contract of the training-data queries, and those that SQL can
express against it."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    import __spark_entry__ as E
    names = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", ["op1_warc_audit", "op6_lm_scoring", "op7_exact_dedup", "op11_vector_codes", "op13_secret_scan"])
def test_query_equals_sql(spark, name):
    import duckdb
    from oracle_check import TABLES, digest

    import __spark_entry__ as E
    df = E.queries()[name](spark, SF)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(E.oracle_sql()[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert digest([tuple(r) for r in df.collect()], df.columns)[0] == digest(res.fetchall(), columns)[0]
