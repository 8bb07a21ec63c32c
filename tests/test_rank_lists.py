"""Vectors by text hash, all lists at once, and sorts on sorts."""

import hashlib
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.operators import browse as B
from quire.operators import similarity as S
from quire.operators.encode import VectorStore, hashed_encoder_factory, with_vectors
from quire.plans.rank import rank_encoded

PAPERS = "title string, abstract string, run_seq long, pos long"


def toy_factory():
    def encode(texts):
        return [[float(len(t)), float(t.count("a")), 1.0] for t in texts]
    return encode


def no_factory_of():
    def factory():
        raise AssertionError("nothing was to be encoded")
    return factory


def vec(text):
    return np.array(toy_factory()([text or ""])[0])


def papers(spark, n=40):
    rows = [(f"ta{'a' * (k % 7)}", None if k == 3 else f"abstract {k % 11}", k % 3, k) for k in range(n)]
    return rows, spark.createDataFrame(rows, PAPERS).repartition(3)


def test_second_run_encodes_nothing(spark, tmp_dir):
    rows, df = papers(spark)
    store = VectorStore(spark, os.path.join(tmp_dir, "vectors"), "double")
    assert store.read().count() == 0
    store.fill([(df.where("pos < 9"), "title")], toy_factory_of())
    store.fill([(df, "title"), (df, "abstract")], toy_factory_of())
    store.fill([(df, "title"), (df, "abstract")], no_factory_of())
    want = {hashlib.md5((t or "").encode()).hexdigest(): vec(t).tolist() for r in rows for t in r[:2]}
    assert {r["key"]: r["embedding"] for r in store.read().collect()} == want
    got = store.paper_vectors(df, ["pos"], 0.25, 0.75).collect()
    assert len(got) == len(rows) and store.read().count() == len(want)
    for r in got:
        title, abstract = rows[r["pos"]][:2]
        assert r["embedding"] == pytest.approx((0.25 * vec(title) + 0.75 * vec(abstract)).tolist())


def toy_factory_of():
    """A factory that travels with its code (tests are not on the workers' path)."""
    def factory():
        def encode(texts):
            return [[float(len(t)), float(t.count("a")), 1.0] for t in texts]
        return encode
    return factory


def test_papers_without_a_vector_are_encoded(spark):
    rows, df = papers(spark)
    stored = spark.createDataFrame([(str(k), [float(k), 0.0, 2.0]) for k in range(0, 40, 4)] + [("x", [9.0] * 3)],
                                   "key string, embedding array<float>")
    got = with_vectors(df.withColumn("key", F.col("pos").cast("string")), stored, "key", toy_factory_of()).collect()
    assert len(got) == 40
    for r in got:
        own = [float(r["pos"]), 0.0, 2.0] if r["pos"] % 4 == 0 else (0.5 * vec(r["title"]) + 0.5 * vec(r["abstract"])).tolist()
        assert r["embedding"] == own


@pytest.mark.parametrize("matrix_bytes", [1 << 20, 50])
def test_all_lists_at_once(spark, matrix_bytes):
    rng = np.random.default_rng(5)
    lists = {f"l{k}": rng.normal(size=3).tolist() for k in range(9)}
    vectors = [(k, k % 2, None if k == 7 else ([0.0] * 3 if k == 8 else rng.normal(size=3).tolist())) for k in range(30)]
    df = spark.createDataFrame(vectors, "pos long, run_seq long, embedding array<double>").repartition(4)
    prof = spark.createDataFrame([*lists.items(), ("gone", None)], "list_name string, profile array<double>")
    got = {(r["pos"], r["list_name"]): r["score"] for r in S.score_all(df, prof, ["pos", "run_seq"], matrix_bytes).collect()}
    assert len(got) == 29 * 9
    for (pos, name), score in got.items():
        x, y = np.array(vectors[pos][2]), np.array(lists[name])
        assert score == pytest.approx(x @ y / max(np.linalg.norm(x) * np.linalg.norm(y), 1e-8))
    ranked = S.rank_all_lists(df, prof, ["pos", "run_seq"], ["run_seq", "pos"])
    assert "embedding" not in ranked.columns
    for name in lists:
        own = sorted((r for r in ranked.where(F.col("list_name") == name).collect()), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 30))
        assert own == sorted(own, key=lambda r: (-r["score"], r["run_seq"], r["pos"]))


def test_rank_encoded_twice(spark, tmp_dir):
    rows, df = papers(spark)
    profiles = spark.createDataFrame([("a", 1.0, "some words"), ("a", 3.0, "abstract 4"), ("b", 1.0, "aaaa")],
                                     "list_name string, weight double, sentence string")
    store = VectorStore(spark, os.path.join(tmp_dir, "v"), "double")
    first = rank_encoded(df, profiles, store, hashed_encoder_factory(16)).collect()
    again = rank_encoded(df, profiles, store, no_factory_of()).collect()
    assert sorted(map(str, first)) == sorted(map(str, again)) and len(first) == 2 * len(rows)


def clicked(rows, clicks):
    """One click after another, as a table widget sorts: (value, item) pairs
    taken in the order shown."""
    shown = sorted(rows)
    for col, down in clicks:
        pairs = [(rows[k][col], k) for k in shown]
        try:
            pairs.sort(key=lambda t: float(t[0]), reverse=down)
        except ValueError:
            pairs.sort(reverse=down)
        shown = [k for _, k in pairs]
    return shown


@pytest.mark.parametrize("seed", range(6))
def test_sorts_on_sorts(spark, seed):
    rng = random.Random(seed)
    rows = {k: {"a": str(rng.randint(0, 3)), "b": str(rng.choice([0.5, 2, 10, "1e1"])), "c": rng.choice(["x", "10", "9", "y"])}
            for k in range(60)}
    df = spark.createDataFrame([(k, *r.values()) for k, r in rows.items()], "id long, a string, b string, c string").repartition(4)
    clicks = [(rng.choice("abbac"), rng.random() < 0.5) for _ in range(rng.randint(0, 5))]
    got = [r["id"] for r in B.sorted_by_clicks(df, clicks, "id").orderBy("rank").collect()]
    assert got == clicked(rows, clicks)
