"""V1 (b) hashed vectors, A1 profiles, V4/V5 cosine, W2 ranks, O3 samples."""

import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from quire.functions import vectors as V
from quire.operators import similarity as S
from quire.operators.ranking import global_rank
from quire.plans.rank import rank_papers


def py_hashed(text, dim=64):
    toks = re.findall("[a-z0-9]+", (text or "").lower())
    out = {}
    for t in toks:
        b = int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % dim
        out[b] = out.get(b, 0.0) + 1.0 / len(toks)
    return out


def test_hashed_vector_matches_python(spark):
    texts = ["The cat, the hat.", "Été 42 and été", "", None, "x " * 50]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = {r["id"]: {e["bucket"]: e["value"] for e in r["v"]}
           for r in df.select("id", V.hashed_vector(F.col("t")).alias("v")).collect()}
    for i, t in enumerate(texts):
        want = py_hashed(t)
        assert got[i].keys() == want.keys()
        for k in want:
            assert abs(got[i][k] - want[k]) < 1e-12


def test_cosine_cases(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0]), ([1.0, 2.0], [1.0, 2.0]), ([1.0, 2.0], [-1.0, -2.0]),
                                ([3.0, 0.0], [0.0, 5.0])], "a array<double>, b array<double>")
    got = [round(r[0], 12) for r in df.select(V.cosine(F.col("a"), F.col("b"))).collect()]
    assert got == [0.0, 1.0, -1.0, 0.0]


def test_dense_profile_weights_and_errors(spark):
    prof = spark.createDataFrame([("l", 0, 1.0, "k1"), ("l", 1, 3.0, "k2"), ("z", 0, 0.0, "k1")],
                                 "list_name string, pos int, weight double, key string")
    vecs = spark.createDataFrame([("k1", [1.0, 0.0]), ("k2", [0.0, 1.0])], "key string, embedding array<float>")
    pv = S.profile_vectors_dense(prof, vecs)
    assert [round(x, 12) for x in S.profile_literal(pv, "l")] == [0.25, 0.75]
    with pytest.raises(S.UnknownProfile):
        S.profile_literal(pv, "")
    with pytest.raises(ValueError):
        S.profile_literal(pv, "z")


def test_hashed_profile_and_rank_against_python(spark):
    sentences = [("p", 0, 1.0, "noisy labels hurt"), ("p", 1, 2.0, "label noise study")]
    profiles = spark.createDataFrame(sentences, "list_name string, pos int, weight double, sentence string")
    vec = S.profile_literal(S.profile_vectors_hashed(profiles), "p")
    want = [0.0] * 64
    for _, _, w, s in sentences:
        for b, v in py_hashed(s).items():
            want[b] += w * v / 3.0
    assert max(abs(a - b) for a, b in zip(vec, want)) < 1e-12
    docs = [("Noisy labels", "we study label noise", 1, 1), ("Other", "unrelated words", 1, 2),
            ("Same", "unrelated words", 1, 3), ("Empty", "", 1, 4)]
    papers = spark.createDataFrame(docs, "title string, abstract string, run_seq long, pos long")
    ranked = {r["pos"]: (r["score"], r["rank"]) for r in rank_papers(papers, profiles, "p").collect()}

    def py_score(t, a):
        va, vt = py_hashed(a), py_hashed(t)
        v = {b: 0.5 * va.get(b, 0) + 0.5 * vt.get(b, 0) for b in set(va) | set(vt)}
        dot = sum(x * want[b] for b, x in v.items())
        n = math.sqrt(sum(x * x for x in v.values())) * math.sqrt(sum(x * x for x in want))
        return dot / max(n, 1e-8)
    for t, a, _, pos in docs:
        assert abs(ranked[pos][0] - py_score(t, a)) < 1e-9
    order = sorted(docs, key=lambda d: (-round(py_score(d[0], d[1]), 9), d[2], d[3]))
    assert [ranked[d[3]][1] for d in order] == [1, 2, 3, 4]


def test_global_rank_matches_row_number(spark):
    import random
    rnd = random.Random(7)
    rows = [(rnd.choice("abc"), rnd.randint(0, 20), i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, v int, id int").repartition(7)
    got = {r["id"]: r["rank"] for r in global_rank(df, [F.col("v").desc(), F.col("id")], "rank", "g").collect()}
    for g in "abc":
        sub = sorted([r for r in rows if r[0] == g], key=lambda r: (-r[1], r[2]))
        assert [got[r[2]] for r in sub] == list(range(1, len(sub) + 1))
    flat = {r["id"]: r["rank"] for r in global_rank(df, [F.col("id")], "rank").collect()}
    assert [flat[i] for i in range(500)] == list(range(1, 501))


def test_seeded_sample(spark):
    df = spark.range(50).withColumnRenamed("id", "k")
    assert S.seeded_sample(df, 0, "k").count() == 50
    a = [r["k"] for r in S.seeded_sample(df, 10, "k", seed="s").collect()]
    b = [r["k"] for r in S.seeded_sample(df.repartition(5), 10, "k", seed="s").collect()]
    assert sorted(a) == sorted(b) and len(set(a)) == 10
    assert S.seeded_sample(df, 50, "k").count() == 50
    with pytest.raises(ValueError):
        S.seeded_sample(df, 51, "k")
    big = {r["k"] for r in S.seeded_sample(df, 10, "k", seed="s", small_limit=1).collect()}
    assert big == set(a)


def test_the_token_cache_is_bounded(monkeypatch):
    from quire.functions import vectors as V
    monkeypatch.setattr(V, "CACHED_TOKENS", 50)
    small, texts = V.TokenBuckets(16), [" ".join(f"t{k}" for k in range(n, n + 40)) for n in range(0, 400, 20)]
    got = small.vectors(texts)
    assert len(small.cache) <= 50
    monkeypatch.setattr(V, "CACHED_TOKENS", 1 << 20)
    assert (got == V.TokenBuckets(16).vectors(texts)).all() and abs(got.sum(1) - 1).max() < 1e-12
