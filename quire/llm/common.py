"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.batches import byte_slices, give_back
from ..session import ensure_checkpoint_dir, shared_path, table_path

__all__ = ["byte_slices", "give_back", "held_out", "left_rows", "mix64", "quoted", "read_table", "shared_path", "small_batches",
           "split_by_id", "text_bytes", "texts", "window_hash", "written"]

U64 = np.uint64
_MASK = (1 << 64) - 1
#: Bits of the map by which rows without a key are told (1 MB, broadcast).
MAP_BITS = 1 << 23
#: Most bytes of an Arrow batch where ``small_batches`` holds.
BATCH_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(table_path(sf_dir, name))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under the shared folder and read back: cuts
    lineage so that a lost executor costs a re-read, not a recomputation."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside send Python batches of at most about ``BATCH_BYTES``,
    for passes over whole texts: a batch is in memory several times over, in
    Spark's buffers and in the worker. A session's own setting stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, "1b") != "1b":
        yield
        return
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(key)


def quoted(name: str) -> str:
    """A column's name as an expression, dots and back quotes included."""
    return "`" + name.replace("`", "``") + "`"


def held_out(id_col, folds: int = 5):
    """True where crc32 of the id as text, modulo ``folds``, is 0 (null ids
    are never held out)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == 0, F.lit(False))


def split_by_id(docs: DataFrame, id_col: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose id isn't in the one column of ``ids``, the rest). The rest
    has every row whose id is there (null: a null) and may have others: ids are
    told by a broadcast map of ``MAP_BITS`` bits, however many they are."""
    def place(c):
        return F.pmod(F.xxhash64(c.cast("long")), F.lit(MAP_BITS))

    bits = ids.select(place(F.col(ids.columns[0])).alias("at")) \
        .select(F.expr("at div 64").alias("word"), F.expr("shiftleft(1L, cast(at % 64 as int))").alias("bit")) \
        .groupBy("word").agg(F.bit_or("bit").alias("bits"))
    names = [f"c{k}" for k in range(len(docs.columns))]
    # At most MAP_BITS / 64 rows of two longs: a proven bound for the broadcast.
    rows = docs.select("*", place(F.col(id_col)).alias("at")).toDF(*names, "at") \
        .join(F.broadcast(bits), F.expr("at div 64") == F.col("word"), "left")
    met = F.expr("getbit(coalesce(bits, 0L), cast(at % 64 as int)) = 1")
    free, rest = (rows.filter(c).select(*names).toDF(*docs.columns) for c in (~met, met))
    return free, rest


def left_rows(docs: DataFrame, id_col: str, text_col: str, code, gone: DataFrame, tied: DataFrame) -> DataFrame:
    """The rows of ``docs`` but those of (id, code) in ``gone``, and of the
    rows that share an (id, code) in ``tied`` one: that of the longest text. Only
    rows whose id may be among them are shuffled."""
    def matched(keys: DataFrame, how: str) -> DataFrame:
        keys = keys.toDF("key_id", "key_code")
        # By <=> also for the code, never null: else its test for null runs on all rows, before the split.
        return rows.join(keys, F.col("id").eqNullSafe(F.col("key_id")) & F.col("code").eqNullSafe(F.col("key_code")), how)

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    free, docs = split_by_id(docs, id_col, gone.unionByName(tied).select(gone.columns[0]))
    rows = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), code.alias("code"),
                       F.struct(F.length(text), F.xxhash64(text)).alias("size"))
    if tied.isEmpty():
        return free.union(matched(gone, "left_anti").select("row.*"))
    ones = matched(tied, "left_semi").groupBy("id", "code").agg(F.max_by("row", "size").alias("row"))
    return free.union(matched(gone.unionByName(tied), "left_anti").select("row.*")).union(ones.select("row.*"))


def texts(column: pa.Array) -> list[str]:
    """Python strings of an Arrow string column, null as empty."""
    return [t or "" for t in column.to_pylist()]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of n + 1, bytes) of an Arrow string or binary column, null as
    empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], data[offsets[0]:offsets[-1]]


def mix64(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (bijective), so that ordering by it is random."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def window_hash(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hash (modulo 2^64, odd ``base``) of every run of ``width``
    values, by joining runs of doubled lengths. ``values`` are mixed 64-bit
    codes; the result has ``len(values) - width + 1`` entries."""
    if len(values) < width:
        return np.zeros(0, np.uint64)
    cur, length, out, done = values, 1, None, 0
    while True:
        power = U64(pow(base, length, 1 << 64))
        if width & length:
            if out is None:
                out = cur.copy()
            else:
                n = len(cur) - done
                out = out[:n] * power
                out += cur[done:]
            done += length
        if done == width:
            return out[:len(values) - width + 1]
        cur = cur[:len(cur) - length] * power + cur[length:]
        length *= 2
