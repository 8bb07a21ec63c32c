"""User-supplied text encoders (V1 c, F2) run in Python workers.

``encoder_factory()`` is called once per Python task that has a text to encode
(the model is loaded once per task, not per row) and returns ``encode(list[str]) ->
array-like [n, dim]``; texts arrive in Arrow batches. Only distinct texts that
are not already in the vectors table are encoded: texts are keyed by
``md5(text)`` and anti-joined against the stored keys, so re-ranking with a
new profile never re-encodes.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.batches import byte_slices, double_lists
from ..functions.vectors import DEFAULT_DIM, TokenBuckets, weighted_sum
from ..session import path_of


def text_key(text) -> F.Column:
    return F.md5(F.coalesce(text, F.lit("")))


def encode_texts(texts: DataFrame, encoder_factory: Callable[[], Callable], text_col: str = "text",
                 key_col: str = "key", dtype: str = "float") -> DataFrame:
    """(key, embedding array<dtype>) for every row of ``texts``."""
    from ..session import ship_package
    ship_package(texts.sparkSession)
    src = texts.select(F.col(key_col), F.col(text_col).alias("_text"))
    np_type = np.float32 if dtype == "float" else np.float64

    def run(batches):
        encode = None
        for batch in batches:
            for part in byte_slices(batch, 1):
                encode = encode or encoder_factory()
                vecs = np.asarray(encode([t or "" for t in part.column(1).to_pylist()]), dtype=np_type)
                yield pa.RecordBatch.from_arrays([part.column(0), double_lists(vecs, np_type)], [key_col, "embedding"])

    return src.mapInArrow(run, f"`{key_col}` string, embedding array<{dtype}>")


def encode_missing(texts: DataFrame, vectors: DataFrame | None, encoder_factory: Callable[[], Callable],
                   text_col: str = "text", dtype: str = "float") -> DataFrame:
    """Vectors for the distinct texts of ``texts`` that ``vectors`` (key,
    embedding) lacks. Union the result into the vectors table."""
    distinct = texts.select(text_key(F.col(text_col)).alias("key"), F.col(text_col)).dropDuplicates(["key"])
    if vectors is not None:
        distinct = distinct.join(vectors.select("key"), "key", "left_anti")
    return encode_texts(distinct, encoder_factory, text_col, "key", dtype)


class VectorStore:
    """Vectors by the hash of their text, under ``path``: a text is encoded
    once, whatever paper, title or sentence it belongs to and however often it
    is ranked. New vectors are appended; one writer at a time."""

    def __init__(self, spark, path: str, dtype: str = "float"):
        self.spark, self.path, self.dtype = spark, path, dtype

    def read(self) -> DataFrame:
        schema = f"key string, embedding array<{self.dtype}>"
        fs, p = path_of(self.spark, self.path)
        return self.spark.read.schema(schema).parquet(self.path) if fs.exists(p) else self.spark.createDataFrame([], schema)

    def append(self, vectors: DataFrame) -> None:
        """(key, embedding) rows whose keys are not stored yet."""
        vectors.select("key", "embedding").write.mode("append").parquet(self.path)

    def fill(self, texts: list, encoder_factory: Callable[[], Callable]) -> None:
        """Encode what the store lacks of the text columns ``texts`` (pairs of
        a frame and a column name)."""
        every = [df.select(F.coalesce(F.col(c), F.lit("")).alias("text")) for df, c in texts]
        self.append(encode_missing(reduce(DataFrame.unionByName, every), self.read(), encoder_factory, "text", self.dtype))

    def paper_vectors(self, papers: DataFrame, keys: list[str], w_title: float = 0.5, w_abstract: float = 0.5) -> DataFrame:
        """V4: the ``keys`` of every paper and its ``embedding``, from the
        stored vectors of its title and abstract. Only keys and hashes meet
        the vectors, never texts."""
        narrow = papers.select(*keys, text_key(F.col("title")).alias("_t"), text_key(F.col("abstract")).alias("_a"))
        stored = self.read()
        x = narrow.join(stored.select(F.col("key").alias("_t"), F.col("embedding").alias("_vt")), "_t", "left") \
            .join(stored.select(F.col("key").alias("_a"), F.col("embedding").alias("_va")), "_a", "left")
        return x.select(*keys, weighted_sum(F.col("_va"), F.col("_vt"), w_abstract, w_title).alias("embedding"))


def with_vectors(papers: DataFrame, vectors: DataFrame, key: str, encoder_factory: Callable[[], Callable],
                 w_title: float = 0.5, w_abstract: float = 0.5) -> DataFrame:
    """V1: every paper with an ``embedding`` (doubles): the stored one of its
    ``key`` (``vectors``: key, embedding), or, where there is none, that of its
    title and abstract by the encoder."""
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(papers.sparkSession)
    stored = vectors.select(F.col("key").alias(key), F.col("embedding").cast("array<double>").alias("embedding"))
    joined = papers.join(stored, key, "left").checkpoint(eager=True)
    have, lack = joined.where(F.col("embedding").isNotNull()), joined.where(F.col("embedding").isNull()).drop("embedding")
    titled = encode_pairs(lack.withColumn("_id", F.monotonically_increasing_id()), encoder_factory, w_title, w_abstract)
    return have.unionByName(titled.select(*have.columns))


def encode_pairs(papers: DataFrame, encoder_factory: Callable[[], Callable], w_title: float, w_abstract: float) -> DataFrame:
    """``papers`` with the encoder's ``embedding`` of title and abstract, in
    one narrow pass over the rows."""
    from ..session import ship_package
    ship_package(papers.sparkSession)

    def run(batches):
        encode = None
        for batch in batches:
            for part in byte_slices(batch, 2):
                encode = encode or encoder_factory()
                title, abstract = (np.asarray(encode([t or "" for t in part.column(i).to_pylist()]), np.float64) for i in (1, 2))
                yield pa.RecordBatch.from_arrays([part.column(0), double_lists(w_title * title + w_abstract * abstract)],
                                                 ["_id", "embedding"])

    papers = papers.checkpoint(eager=True)  # row ids that both sides read
    vecs = papers.select("_id", "title", "abstract").mapInArrow(run, "_id long, embedding array<double>")
    return papers.join(vecs, "_id").drop("_id")


def hashed_encoder_factory(dim: int = DEFAULT_DIM) -> Callable[[], Callable]:
    """A numpy encoder equal to the JVM hashed encoder (mean-pooled md5
    buckets of ``[a-z0-9]+`` tokens); stands in for a neural model and lets
    the Python path be checked against SQL."""

    def factory():
        return TokenBuckets(dim).vectors

    return factory
