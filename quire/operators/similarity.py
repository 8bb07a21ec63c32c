"""Profiles, paper vectors, cosine scores, ranks and samples
(A1, V1-V6, J7, W2, O1, O3).

A profile vector is one small dense vector per sentence list; it is computed
with Spark aggregates and then inlined as a literal, so scoring every paper is
a narrow projection with no join at all. Its size is checked before it is
brought to the driver.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..functions.batches import give_back
from .ranking import global_rank

class UnknownProfile(ValueError):
    pass


def profile_vectors_dense(profiles: DataFrame, vectors: DataFrame, key_col: str = "key") -> DataFrame:
    """A1 over stored vectors: per list, sum(w*v) / sum(w) element-wise.

    ``profiles``: list_name, pos, weight, and ``key_col`` naming the sentence's
    vector in ``vectors`` (``key_col``, embedding). A zero weight sum gives
    nulls (not an error).
    """
    wv = profiles.join(vectors, key_col).select(
        "list_name", "weight", F.posexplode("embedding").alias("i", "x"))
    per_dim = wv.groupBy("list_name", "i").agg(
        F.try_divide(F.sum(F.col("weight") * F.col("x").cast("double")), F.sum("weight")).alias("x"))
    return per_dim.groupBy("list_name").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e["x"]).alias("profile"))


def profile_vectors_hashed(profiles: DataFrame, dim: int = V.DEFAULT_DIM) -> DataFrame:
    """A1 over hashed sentence vectors: per list, sum(w*v)/sum(w), dense."""
    sent = profiles.select("list_name", "weight",
                           F.explode(V.hashed_vector(F.col("sentence"), dim)).alias("e"))
    per_bucket = sent.groupBy("list_name", F.col("e.bucket").alias("bucket")).agg(
        F.sum(F.col("weight") * F.col("e.value")).alias("wsum"))
    totals = profiles.groupBy("list_name").agg(F.sum("weight").alias("wtotal"))
    sparse = per_bucket.join(totals, "list_name").groupBy("list_name", "wtotal").agg(
        F.array_sort(F.collect_list(F.struct(F.col("bucket"), F.col("wsum").alias("value")))).alias("sp"))
    dense = V.sparse_to_dense(F.col("sp"), dim)
    return (totals.join(sparse.drop("wtotal"), "list_name", "left")
            .select("list_name",
                    F.when(F.col("wtotal") == 0, F.lit(None))
                    .otherwise(F.transform(F.coalesce(dense, F.array_repeat(F.lit(0.0), dim)),
                                           lambda x: x / F.col("wtotal"))).alias("profile")))


def profile_literal(profile_df: DataFrame, list_name: str) -> list[float]:
    """V2: the profile vector of one list: one row, as wide as the encoder. An
    unknown name raises, like the reference."""
    one = profile_df.where(F.col("list_name") == F.lit(list_name)).select(F.size("profile").alias("d"), "profile")
    rows = one.limit(2).collect()
    if not rows:
        raise UnknownProfile(f"Unknown sentence list: {list_name}")
    if len(rows) > 1:
        raise ValueError(f"sentence list {list_name!r} is not unique")
    if rows[0]["profile"] is None or any(x is None for x in rows[0]["profile"]):
        raise ValueError(f"sentence list {list_name!r} has a zero weight sum")
    return [float(x) for x in rows[0]["profile"]]


def score_dense(df: DataFrame, vector_col: str, profile: list[float], list_name: str) -> DataFrame:
    """V5 for dense paper vectors against one inlined profile."""
    return df.withColumn("list_name", F.lit(list_name)).withColumn(
        "score", V.cosine(F.col(vector_col), V.literal_vector(profile)))


def score_hashed(df: DataFrame, profile: list[float], list_name: str, title_col: str = "title",
                 abstract_col: str = "abstract", w_title: float = 0.5, w_abstract: float = 0.5) -> DataFrame:
    """V4 + V5 with the hashed encoder: no vectors are stored or shuffled."""
    dim = len(profile)
    vec = V.hashed_paper_dense(F.col(title_col), F.col(abstract_col), w_title, w_abstract, dim)
    # Materialise the vector once; the cosine reads it twice.
    return (df.withColumn("_vec", vec).withColumn("list_name", F.lit(list_name))
            .withColumn("score", V.cosine(F.col("_vec"), V.literal_vector(profile))).drop("_vec"))


# Bytes of the profile matrix that a pass over the papers holds.
MATRIX_BYTES = 32 << 20
# Pairs of a paper and a list that a worker holds at a time.
PAIRS = 1 << 18


def score_all(vectors: DataFrame, profiles: DataFrame, keys: list[str], matrix_bytes: int = MATRIX_BYTES) -> DataFrame:
    """J7 / V5 for all lists at once: ``keys``, ``list_name`` and ``score`` of
    every paper and list. ``vectors``: keys, embedding; ``profiles``:
    list_name, profile (one row each). A batch of papers is multiplied by the
    matrix of profiles; lists come in blocks of bounded size, one pass each."""
    from ..session import ship_package
    ship_package(vectors.sparkSession)
    rows = profiles.where("profile is not null").orderBy("list_name")
    widest = rows.agg(F.max(F.size("profile"))).first()[0] or 1
    per_block = max(1, matrix_bytes // (8 * widest))
    numbered = global_rank(rows, [F.col("list_name")], "_n")
    total = numbered.count()
    src = vectors.select(*keys, F.col("embedding").cast("array<double>").alias("embedding"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]) + ", list_name string, score double"
    parts = []
    for first in range(0, max(total, 1), per_block):
        block = numbered.where((F.col("_n") > first) & (F.col("_n") <= first + per_block)).collect()
        parts.append(src.mapInArrow(_products(block, keys), schema))
    return reduce(DataFrame.unionByName, parts)


def _products(block: list, keys: list[str]):
    names = np.array([r["list_name"] for r in block], object)
    matrix = np.array([r["profile"] for r in block], np.float64).reshape(len(block), -1)
    lengths = np.sqrt((matrix * matrix).sum(1))
    step = max(1, PAIRS // max(1, len(names)))  # papers multiplied at a time

    def run(batches):
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column(len(keys))))
            for start in range(0, batch.num_rows if len(names) else 0, step):
                part = batch.slice(start, step)
                x = np.array(part.column(len(keys)).to_pylist(), np.float64)
                scores = (x @ matrix.T) / np.maximum(np.sqrt((x * x).sum(1))[:, None] * lengths, V.COSINE_EPS)
                rows = pa.array(np.repeat(np.arange(len(x)), len(names)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(i).take(rows) for i in range(len(keys))] + [pa.array(np.tile(names, len(x)), pa.string()), pa.array(scores.ravel())],
                    [*keys, "list_name", "score"])
            give_back()

    return run


def rank_all_lists(vectors: DataFrame, profiles: DataFrame, keys: list[str], order: list[str], digits: int | None = None) -> DataFrame:
    """``score_all`` with a 1-based ``rank`` within each list, by
    falling score, then ``order``. Only keys, names and scores are sorted."""
    scored = score_all(vectors, profiles, keys)
    key = F.col("score") if digits is None else F.round("score", digits)
    return global_rank(scored.withColumn("_k", key), [F.col("_k").desc(), *(F.col(c).asc() for c in order)], "rank", "list_name").drop("_k")


def top_k(scored: DataFrame, k: int, tie_cols: list[str]) -> DataFrame:
    """O1 with a limit: top-k report (per-partition top-k, then merge)."""
    return scored.orderBy(F.col("score").desc_nulls_last(), *[F.col(c).asc() for c in tie_cols]).limit(k)


def sample_key(seed: str, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def seeded_sample(df: DataFrame, n: int, key_col: str, seed: str = "0", small_limit: int = 10_000) -> DataFrame:
    """O3: ``n`` rows without replacement, chosen by a seeded hash of the key.
    n = 0 means all rows; n above the row count raises, as in the reference.
    Up to ``small_limit`` rows: per-partition top-n merged on the driver
    (TakeOrderedAndProject); above it: a distributed rank and a filter."""
    if n == 0:
        return df
    if n < 0:
        raise ValueError("sample size must be >= 0")
    total = df.count()
    if n > total:
        raise ValueError("Sample larger than population")
    h = sample_key(seed, F.col(key_col))
    if n <= small_limit:
        return df.withColumn("_h", h).orderBy("_h", key_col).limit(n).drop("_h")
    ranked = global_rank(df.withColumn("_h", h), [F.col("_h"), F.col(key_col)], "_r", None)
    return ranked.where(F.col("_r") <= n).drop("_h", "_r")
