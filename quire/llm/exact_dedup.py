"""Exact deduplication by composable polynomial fingerprints.

Texts are equal when identical after deleting the characters space, \\t, \\n,
\\v, \\f and \\r. Every normalised text gets a fingerprint: its length and
polynomial hashes under four (base, prime) pairs. A polynomial hash composes:
``hash(a + b) = hash(a) * base^len(b) + hash(b)``, so the chunks of a huge
document are hashed by different tasks and combined by length-shifted
arithmetic. Equal fingerprints are then compared byte by byte, chunk by
chunk, against the row that stays; a text that differs gets a class of its
own, until every class is proven equal.

Scale: a group of copies is never gathered. Groups are aggregates (partial
before the shuffle); the comparison deals the copies of one group over
``salt`` keys of about ``COPIES_PER_KEY`` rows, each with its own copy of the
staying text. Only texts whose fingerprint repeats are compared.

Defined cases: a null text counts as empty (all empty texts are one group);
repeated rows (same id, same text) are copies of one another and share one
decision (``without_duplicates`` lets one of them through, the longest); a
null id loses every tie and is kept only where nothing else can stay; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, left_rows, read_table, small_batches, split_by_id, written

BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"
#: (base, prime) pairs of the fingerprint.
FIELDS = ((911382323, 2147483647), (972663749, 2147483629), (564987111, 2147483587), (763421009, 2147483579))
#: Texts above this many bytes are hashed chunk by chunk in separate tasks.
CHUNK_BYTES = 1 << 16
#: Copies of one text that are compared under one key.
COPIES_PER_KEY = 64


def normalised(text: Column) -> Column:
    """The text without blanks, null as empty."""
    return F.translate(F.coalesce(text, F.lit("")), BLANKS.decode(), "")


@lru_cache(maxsize=8)
def _powers(fields: tuple, n: int) -> list[np.ndarray]:
    """For each field, base^(n-1), ..., base, 1 modulo its prime."""
    out = []
    for base, prime in fields:
        p = np.ones(n, np.uint64)
        done = 1
        while done < n:  # powers done..2 done - 1 are powers 0..done - 1, shifted
            step = min(done, n - done)
            p[done:done + step] = p[:step] * np.uint64(pow(base, done, prime)) % np.uint64(prime)
            done += step
        out.append(p[::-1].copy())
    return out


def chunk_hashes(data: bytes, fields: tuple = FIELDS, chunk: int = CHUNK_BYTES) -> list[int]:
    """The polynomial hashes of one chunk (at most ``chunk`` bytes)."""
    a = np.frombuffer(data, np.uint8).astype(np.uint64)
    return [int(np.dot(a, p[len(p) - len(a):]) % np.uint64(prime)) if len(a) else 0
            for p, (_, prime) in zip(_powers(fields, chunk), fields, strict=True)]


def combine(parts: list[tuple[int, list[int]]], fields: tuple = FIELDS) -> tuple[int, list[int]]:
    """(length, hashes) of the parts' concatenation, in order."""
    total, acc = 0, [0] * len(fields)
    for n, hashes in parts:
        acc = [(a * pow(base, n, prime) + h) % prime for a, h, (base, prime) in zip(acc, hashes, fields, strict=True)]
        total += n
    return total, acc


def fingerprint(data: bytes, fields: tuple = FIELDS, chunk: int = CHUNK_BYTES) -> bytes:
    """The fingerprint of a whole normalised text: length and hashes."""
    return _packed(*combine([(len(data[i:i + chunk]), chunk_hashes(data[i:i + chunk], fields, chunk))
                             for i in range(0, len(data), chunk)], fields))


def _packed(n: int, hashes: list[int]) -> bytes:
    return struct.pack(f"<Q{len(hashes)}I", n, *hashes)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fields: tuple = FIELDS,
                 chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, n_cp, sha, fp) of every row: code points of the original
    text, SHA-256 and fingerprint of the normalised one."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.length(text_col), F.lit(0)).cast("long").alias("n_cp"),
                       normalised(F.col(text_col)).cast("binary").alias("norm"))
    head, out = "doc_id long, n_cp long, sha binary", "doc_id long, n_cp long, sha binary, fp binary"

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, 2):
                norm = b.column(2).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array([hashlib.sha256(t).digest() for t in norm], pa.binary()),
                     pa.array([fingerprint(t, fields, chunk_bytes) for t in norm], pa.binary())],
                    ["doc_id", "n_cp", "sha", "fp"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            for doc, n_cp, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                sha, row = hashlib.sha256(t).digest(), row + 1
                for k in range(0, len(t), chunk_bytes):
                    yield pa.RecordBatch.from_pylist(
                        [{"doc_id": doc, "n_cp": n_cp, "sha": sha, "row": row, "k": k, "part": t[k:k + chunk_bytes]}],
                        schema=pa.schema([("doc_id", pa.int64()), ("n_cp", pa.int64()), ("sha", pa.binary()),
                                          ("row", pa.int64()), ("k", pa.int64()), ("part", pa.binary())]))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = b.column("part").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(n) for n in ("doc_id", "n_cp", "sha", "row", "k")]
                + [pa.array([len(p) for p in parts], pa.int64()),
                   pa.array([chunk_hashes(p, fields, chunk_bytes) for p in parts], pa.list_(pa.int64()))],
                ["doc_id", "n_cp", "sha", "row", "k", "n", "h"])

    def joined(chunks: pd.DataFrame) -> pd.DataFrame:
        chunks = chunks.sort_values("k")
        fp = _packed(*combine([(int(n), [int(x) for x in h]) for n, h in zip(chunks["n"], chunks["h"], strict=True)],
                              fields))
        return chunks.head(1)[["doc_id", "n_cp", "sha"]].assign(fp=[fp])

    huge = F.octet_length("norm") > chunk_bytes
    small = rows.filter(~huge).mapInArrow(whole, out)
    parts = rows.filter(huge).mapInArrow(cut, head + ", row long, k long, part binary")
    parts = parts.repartition("row", "k").mapInArrow(hashed, head + ", row long, k long, n long, h array<long>")
    return small.unionByName(parts.groupBy("row").applyInPandas(joined, out))


def _groups(rows: DataFrame) -> DataFrame:
    """(fp, cls, keep, group_size): the row that stays has the most code
    points, then the smallest id; a null id comes last."""
    best = F.max(F.struct("n_cp", (-F.col("doc_id")).alias("neg_id"), "sha"))
    return rows.groupBy("fp", "cls").agg(best.alias("best"), F.count("*").alias("group_size"))


def _differing(docs: DataFrame, rows: DataFrame, id_col: str, text_col: str, chunk_bytes: int) -> DataFrame:
    """(doc_id, sha) of rows whose text is not that of the row their class keeps."""
    groups = _groups(rows).filter("group_size > 1")
    members = written(rows.select("doc_id", "sha", "n_cp", "fp", "cls").distinct().join(groups, ["fp", "cls"]).select(
        "doc_id", "sha", "fp", "cls", F.ceil(F.col("group_size") / COPIES_PER_KEY).cast("int").alias("salts"),
        ((F.col("n_cp") == F.col("best.n_cp")) & F.col("doc_id").eqNullSafe(-F.col("best.neg_id"))
         & (F.col("sha") == F.col("best.sha"))).alias("keeps")), "members")
    # Texts without a copy aren't sent.
    _, docs = split_by_id(docs, id_col, members.select("doc_id"))
    cut = docs.select(F.col(id_col).cast("long").alias("d"), normalised(F.col(text_col)).cast("binary").alias("norm")) \
        .withColumn("s", F.unhex(F.sha2("norm", 256)))
    members = members.join(cut, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("sha").eqNullSafe(F.col("s"))) \
        .select("doc_id", "sha", "fp", "cls", "salts", "keeps", "norm")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, 6):
                norm = b.column("norm").to_pylist()
                pieces = [max(1, -(-len(t) // chunk_bytes)) for t in norm]
                take = [i for i, n in enumerate(pieces) for _ in range(n)]
                ks = [k for n in pieces for k in range(n)]
                cols = b.select(b.schema.names[:-1]).take(pa.array(take, pa.int64())).columns
                parts = [norm[i][k * chunk_bytes:(k + 1) * chunk_bytes] for i, k in zip(take, ks, strict=True)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(ks, pa.int32()), pa.array(parts, pa.binary())],
                                                 ["doc_id", "sha", "fp", "cls", "salts", "keeps", "k", "part"])

    with small_batches(docs.sparkSession):
        parts = written(members.mapInArrow(chunks, "doc_id long, sha binary, fp binary, cls int, salts int, "
                                                   "keeps boolean, k int, part binary"), "copies")
    kept = parts.filter("keeps").dropDuplicates(["fp", "cls", "k"]).select(
        "fp", "cls", "k", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("part").alias("held"))
    dealt = parts.filter(~F.col("keeps")).withColumn("salt", F.pmod(F.xxhash64("doc_id", "sha"), "salts").cast("int"))
    return dealt.join(kept, ["fp", "cls", "k", "salt"], "left").groupBy("doc_id", "sha") \
        .agg(F.bool_and(F.coalesce(F.col("part") == F.col("held"), F.lit(False))).alias("same")) \
        .filter(~F.col("same")).select("doc_id", "sha")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fields: tuple = FIELDS,
                     chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    with small_batches(docs.sparkSession):
        rows = written(fingerprints(docs, id_col, text_col, fields, chunk_bytes).withColumn("cls", F.lit(0)), "fingerprints")
    while True:  # one round, unless a fingerprint met two texts
        odd = written(_differing(docs, rows, id_col, text_col, chunk_bytes), "differing")
        if odd.isEmpty():
            break
        odd = odd.select(F.col("doc_id").alias("d"), F.col("sha").alias("s"))
        rows = written(rows.join(odd, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("sha") == F.col("s")), "left")
                       .withColumn("cls", F.col("cls") + F.col("s").isNotNull().cast("int")).drop("d", "s"),
                       "fingerprints")
    keep = F.when(F.col("group_size") > 1, -F.col("best.neg_id")).otherwise(F.col("doc_id"))
    return rows.join(_groups(rows), ["fp", "cls"]).select(
        "doc_id", keep.alias("keep_id"), "group_size", F.col("doc_id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, with all its columns."""
    found = written(exact_duplicates(docs, id_col, text_col).filter("group_size > 1")
                    .groupBy("doc_id", "text_sha256", "kept").agg(F.count("*").alias("n")), "decisions")
    keys = ("doc_id", "text_sha256")
    return left_rows(docs, id_col, text_col, F.sha2(normalised(F.col(text_col)).cast("binary"), 256),
                     found.filter(~F.col("kept")).select(*keys), found.filter("kept and n > 1").select(*keys))


def op7_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Exact deduplication of all documents, one row each."""
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(length(text), 0) AS n_cp,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_cp DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_cp DESC, doc_id) AS kept,
       text_sha256
FROM d"""
