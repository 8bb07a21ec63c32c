"""Vector column expressions: dense arithmetic, cosine, and a hashed bag-of-words
encoder that stays JVM-side.

Dense vectors are ``array<float|double>``; arithmetic is done in double.
Sparse vectors are ``array<struct<bucket:int, value:double>>`` sorted by
bucket, one entry per bucket.

Hashed encoder (V1 b): tokens are the ``[a-z0-9]+`` runs of the lowercased
text (accented letters split words); a token's bucket is the first 32 bits
of its md5 modulo ``dim``; a text's vector is the mean of its tokens' one-hot
vectors (mean pooling, A2). A text without tokens is the zero vector.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .batches import byte_lengths, double_lists, give_back, run_ends

# Fixed values of the hashed encoder.
TOKEN_PATTERN = "[a-z0-9]+"
DEFAULT_DIM = 64
# Cosine denominator floor (a zero vector scores 0).
COSINE_EPS = 1e-8

SPARSE_TYPE = "array<struct<bucket:int,value:double>>"


# --- dense -----------------------------------------------------------------

def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column, eps: float = COSINE_EPS) -> Column:
    """V5: a.b / max(|a||b|, eps)."""
    return dot(a, b) / F.greatest(norm(a) * norm(b), F.lit(eps))


def weighted_sum(a: Column, b: Column, wa: float = 0.5, wb: float = 0.5) -> Column:
    """V4: wa*a + wb*b, element-wise."""
    return F.zip_with(a, b, lambda x, y: F.lit(wa) * x.cast("double") + F.lit(wb) * y.cast("double"))


def literal_vector(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


# --- hashed encoder ----------------------------------------------------------

def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), 0)


def bucket_of(token: Column, dim: int = DEFAULT_DIM) -> Column:
    h = F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(dim)).cast("int")


def weighted_tokens(text: Column, weight: float = 1.0, dim: int = DEFAULT_DIM) -> Column:
    """array<struct<bucket, value>>: one entry per token, value = weight / n_tokens."""
    toks = tokens(text)
    # The weight is computed once per text, outside the lambda: an outer
    # expression referenced inside a lambda is re-evaluated per element.
    w = F.lit(float(weight)) / F.greatest(F.size(toks), F.lit(1)).cast("double")
    return F.zip_with(toks, F.array_repeat(w, F.size(toks)),
                      lambda t, v: F.struct(bucket_of(t, dim).alias("bucket"), v.alias("value")))


def to_sparse(entries: Column) -> Column:
    """Sum entries per bucket: sort by bucket, then fold runs (O(n log n))."""
    srt = F.array_sort(entries)
    init = F.struct(F.lit(-1).alias("b"), F.lit(0.0).alias("v"),
                    F.array().cast(SPARSE_TYPE).alias("out"))

    def step(s, e):
        same = e["bucket"] == s["b"]
        flushed = F.when(s["b"] >= 0, F.concat(s["out"], F.array(F.struct(s["b"].alias("bucket"), s["v"].alias("value"))))) \
            .otherwise(s["out"])
        return F.struct(e["bucket"].alias("b"),
                        F.when(same, s["v"] + e["value"]).otherwise(e["value"]).alias("v"),
                        F.when(same, s["out"]).otherwise(flushed).alias("out"))

    def finish(s):
        return F.when(s["b"] >= 0, F.concat(s["out"], F.array(F.struct(s["b"].alias("bucket"), s["v"].alias("value"))))) \
            .otherwise(s["out"])

    return F.aggregate(srt, init, step, finish)


def sparse_norm(sparse: Column) -> Column:
    return F.sqrt(F.aggregate(sparse, F.lit(0.0), lambda acc, e: acc + e["value"] * e["value"]))


def sparse_dot_dense(sparse: Column, dense: Column) -> Column:
    return F.aggregate(sparse, F.lit(0.0),
                       lambda acc, e: acc + e["value"] * F.element_at(dense, e["bucket"] + 1).cast("double"))


def sparse_to_dense(sparse: Column, dim: int = DEFAULT_DIM) -> Column:
    """Dense array of ``dim`` doubles. Folds entries into a zero vector; the
    lambdas read only their own variables (nothing re-evaluated per element)."""
    return F.aggregate(sparse, F.array_repeat(F.lit(0.0), dim),
                       lambda acc, e: F.transform(acc, lambda x, i: F.when(i == e["bucket"], x + e["value"]).otherwise(x)))


def hashed_vector(text: Column, dim: int = DEFAULT_DIM) -> Column:
    """Sparse mean-pooled hashed vector of one text."""
    return to_sparse(weighted_tokens(text, 1.0, dim))


def hashed_paper_vector(title: Column, abstract: Column, w_title: float = 0.5, w_abstract: float = 0.5,
                        dim: int = DEFAULT_DIM) -> Column:
    """V4 on hashed vectors: w_abstract*vec(abstract) + w_title*vec(title), sparse."""
    return to_sparse(F.concat(weighted_tokens(abstract, w_abstract, dim), weighted_tokens(title, w_title, dim)))


# --- hashed encoder, vectorised -------------------------------------------------
# The same encoder as an Arrow UDF: Spark interprets higher-order-function
# lambdas per element, so per-token work is far cheaper in Arrow batches with
# a cache of token buckets and ``numpy.bincount``.

# Tokens that a worker remembers; a full cache starts anew.
CACHED_TOKENS = 1 << 17


class TokenBuckets:
    """The hashed encoder in numpy, with a bounded cache of token buckets."""

    def __init__(self, dim: int):
        self.dim, self.pattern, self.cache = dim, re.compile(TOKEN_PATTERN), {}

    def bucket(self, token: str) -> int:
        b = self.cache.get(token)
        if b is None:
            if len(self.cache) >= CACHED_TOKENS:
                self.cache.clear()
            b = self.cache[token] = int(hashlib.md5(token.encode("utf-8")).hexdigest()[:8], 16) % self.dim
        return b

    def vectors(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), dtype=np.float64)
        for i, t in enumerate(texts):
            found = self.pattern.findall(t.lower())
            if found:
                out[i] = np.bincount([self.bucket(x) for x in found], minlength=self.dim) / len(found)
        return out


_DENSE_UDFS: dict[int, object] = {}


def hashed_dense(text: Column, dim: int = DEFAULT_DIM) -> Column:
    """Dense mean-pooled hashed vector (array<double> of ``dim``) of a text."""
    from pyspark.sql import SparkSession

    from ..session import ship_package
    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)
    fn = _DENSE_UDFS.get(dim)
    if fn is None:
        @F.arrow_udf("array<double>")
        def _hashed(s: pa.Array) -> pa.Array:
            buckets = TokenBuckets(dim)
            out = [buckets.vectors([t or "" for t in s.slice(a, b - a).to_pylist()]) for a, b in run_ends(byte_lengths(s), 4 << 20)]
            give_back()
            return double_lists(np.concatenate(out) if out else np.zeros((0, dim)))

        fn = _DENSE_UDFS[dim] = _hashed
    return fn(text)


def hashed_paper_dense(title: Column, abstract: Column, w_title: float = 0.5, w_abstract: float = 0.5,
                       dim: int = DEFAULT_DIM) -> Column:
    """V4, dense: w_abstract*vec(abstract) + w_title*vec(title)."""
    return weighted_sum(hashed_dense(abstract, dim), hashed_dense(title, dim), w_abstract, w_title)
