"""The driver contract: entry() runs, and registered queries equal their
DuckDB oracle on the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["doc_id", "title", "score"] and 0 < len(rows) <= 20


def test_every_query_has_an_oracle():
    import __spark_entry__ as E
    from quire.plans.registry import QUERIES, SQL
    assert set(QUERIES) == set(SQL)  # the training-data queries that SQL can't express have tests of their own
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", ["title_query", "query_table_match_index", "upsert_latest", "similarity_rank",
                                  "collect_records", "page_links", "nested_text", "csv_records", "stream_ingest",
                                  "collect_runs", "encoded_vectors", "collect_runs_many", "bibtex_file",
                                  "stream_after_writeback", "stream_late_lookups", "reject_kinds"])
def test_query_equals_oracle(spark, name):
    import duckdb
    from oracle_check import TABLES, digest

    import __spark_entry__ as E
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert digest(rows, df.columns)[0] == digest(orows, ocols)[0]
