"""Property tests: cosine is scale invariant, the upsert
is idempotent and insensitive to how new rows are batched."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire import schemas
from quire.functions import vectors as V
from quire.operators import upsert as U

vec = st.lists(st.floats(min_value=-100, max_value=100, allow_nan=False, allow_infinity=False), min_size=3, max_size=3)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(vec, vec, st.floats(min_value=0.01, max_value=1000)), min_size=1, max_size=6))
def test_cosine_scale_invariant(spark, rows):
    df = spark.createDataFrame([(a, b, k) for a, b, k in rows], "a array<double>, b array<double>, k double")
    scaled = F.transform("a", lambda x: x * F.col("k"))
    got = df.select(V.cosine(F.col("a"), F.col("b")).alias("c1"), V.cosine(scaled, F.col("b")).alias("c2")).collect()
    for r, (a, b, _) in zip(got, rows):
        na = sum(x * x for x in a) ** 0.5
        nb = sum(x * x for x in b) ** 0.5
        if na * nb > 1e-3:
            assert abs(r["c1"] - r["c2"]) < 1e-9


def _rec(title, run, pos):
    return (title, ["A"], "v", 2020, "@b", "u", "a", "q", True, [], run, pos)


def _titles(df):
    return sorted((r["title"], r["run_seq"], r["pos"]) for r in df.collect())


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcde"), st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=30),
       st.integers(1, 4))
def test_upsert_idempotent_and_batching_free(spark, rows, n_batches):
    recs = [_rec(t, r, p) for t, r, p in rows]
    df = spark.createDataFrame(recs, schemas.PAPERS)
    once = U.upsert(None, df)
    twice = U.upsert(once, df)
    assert _titles(once) == _titles(twice)
    state = None
    for i in range(n_batches):
        part = spark.createDataFrame(recs[i::n_batches] or [], schemas.PAPERS)
        state = U.upsert(state, part)
    assert _titles(state) == _titles(once)
