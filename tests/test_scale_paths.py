"""Paths taken only at scale: the index plan chosen automatically for a large
query table, unreadable pages, and input-based shuffle sizing."""

import random

from quire.operators import matching as M
from quire.operators import nested as N
from quire.session import size_shuffle_for_input


def rule(query, text):
    return all(all(p in text for p in t.strip('"').split("+")) for t in query.split(" AND "))


def test_auto_picks_index_for_large_query_tables(spark):
    rnd = random.Random(3)
    words = ["noisy", "labels", "weak", "partial", "annotation", "sound", "event", "c++", "the"]
    titles = [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    qs = []
    for i in range(M.INLINE_QUERY_LIMIT + 40):
        a, b = rnd.choice(words), rnd.choice(words)
        qs.append((f"q{i}", rnd.choice([f"{a}+{b}", f"{a} AND {b}", f'"{a}"', a[:2], ""])))
    texts = spark.createDataFrame(list(enumerate(titles)), "doc_id int, title string")
    queries = spark.createDataFrame(qs, "query_id string, query string")
    got = {(r["doc_id"], r["query_id"]) for r in M.match_queries(texts, queries, ["doc_id"]).collect()}
    want = {(i, qid) for i, t in enumerate(titles) for qid, q in qs if rule(q, t.lower())}
    assert got == want


def test_unreadable_page_gives_nulls(monkeypatch):
    def boom(html):
        raise RuntimeError("bad page")
    monkeypatch.setattr(N, "parse", boom)
    assert N.extract_fields("<html>", [dict(name="x", tag="p")]) == [None]


def test_shuffle_sizing(spark):
    keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        assert size_shuffle_for_input(spark, 10) == 200
        assert size_shuffle_for_input(spark, 1000 * 128 * 1024 * 1024) == 1000
        assert size_shuffle_for_input(spark, 100 * 2 ** 40) == 200_000
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_query_pushdown_with_stored_lowercase(spark, tmp_dir):
    import os
    from pyspark.sql import functions as F
    path = os.path.join(tmp_dir, "t")
    spark.createDataFrame([("Noisy Labels",), ("Clean",)], "title string") \
        .withColumn("title_lc", F.lower("title")).write.parquet(path)
    df = spark.read.parquet(path)
    q = M.filter_by_query(df, "noisy+labels", lowered_col="title_lc")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "StringContains(title_lc,noisy)" in plan
    assert [r["title"] for r in q.collect()] == ["Noisy Labels"]
    assert M.filter_by_query(df, "noisy+labels").count() == 1
