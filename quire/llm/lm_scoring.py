"""Stupid-backoff scores against the counts of the whole corpus.

A word's score given the words before it is ``c(ngram) / c(context)`` at the
highest order whose n-gram is known, times ``BACKOFF`` for each order given
up. Counts come from all documents but the scored one (its own n-grams are
taken off), so a text can't vouch for itself. The relational plan:

1. Documents are written in blocks; a block explodes into its distinct
   n-grams with counts, per order, and sends them to partitions by hash.
2. A hash partition sums the counts of all blocks: its part of the count
   table. Joined back to the n-grams sent, it returns their counts.
3. Blocks and counts meet again by block; every position is scored and the
   logarithms are summed per document.

Scale: an n-gram is sent once a block, so one that fills a third of the corpus
is a row of each block and no hot key. Hash partitions grow in number with the
text (``PARTITION_BYTES``), blocks are of bounded size, and only hashes and
counts travel, packed by byte plane so that sorted hashes compress.

Defined cases: null, empty or blank text has no words, a sum of 0 and no mean;
repeated rows are documents of their own; an unknown word counts
``UNKNOWN_COUNT``; a null id stays null; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, mix64, read_table, text_bytes, window_hash, written
from .jaccard_join import _word_hashes as word_hashes

ORDER = 3
BACKOFF, UNKNOWN_COUNT = 0.4, 0.5
#: Text of a block, and of the corpus for each hash partition.
BLOCK_BYTES, PARTITION_BYTES = 8 << 20, 16 << 20
#: Text whose bytes are hashed at a time.
SLICE_BYTES = 1 << 20
_BASE = 0xE7037ED1A0B428DB


def _packed(values: np.ndarray) -> bytes:
    """Integers by byte plane, compressed."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T)
    return pa.Codec("zstd", compression_level=1).compress(planes.tobytes(), asbytes=True) if len(values) else b""


def _unpacked(data: bytes, n: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    planes = np.frombuffer(pa.Codec("zstd").decompress(data, n * width, asbytes=True), np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def ngrams(words: np.ndarray, row: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, last position) of the n-grams of ``order`` words that lie in one text."""
    if len(words) < order:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(row[:len(row) - order + 1] == row[order - 1:])
    return mix64(window_hash(words, order, _BASE)[first] + np.uint64(order)), first + order - 1


def _bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def blocks(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """(block, ids, sizes, bytes, texts): texts joined and compressed."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        held, size = [], 0

        def out() -> pa.RecordBatch:
            ids, sizes = ([x for h in held for x in h[k]] for k in (0, 1))
            data = b"".join(h[2] for h in held)
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([sizes], pa.list_(pa.int64())), pa.array([len(data)], pa.int64()),
                 pa.array([pa.Codec("zstd", compression_level=1).compress(data, asbytes=True)], pa.binary())],
                ["block", "ids", "sizes", "bytes", "texts"])

        for batch in batches:
            for b in byte_slices(batch, 1, block_bytes // 4):
                offsets, data = text_bytes(b.column(1))
                held.append((b.column(0).to_pylist(), np.diff(offsets).tolist(), data.tobytes()))
                size += len(data)
                if size >= block_bytes:
                    yield out()
                    held, size, block = [], 0, block + 1
        if held:
            yield out()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(pack, "block long, ids array<long>, sizes array<long>, bytes long, texts binary")


def _read(sizes: np.ndarray, texts: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of a block's words, hashed in slices of whole texts."""
    data = np.frombuffer(pa.Codec("zstd").decompress(texts, size, asbytes=True) if size else b"", np.uint8)
    ends = np.r_[0, np.cumsum(np.asarray(sizes, np.int64))]
    words, rows, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    while at < len(sizes):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] + SLICE_BYTES, "right")) - 1)
        h, row = word_hashes(ends[at:stop + 1] - ends[at], data[ends[at]:ends[stop]])
        words.append(h)
        rows.append(row + at)
        at = stop
    return np.concatenate(words), np.concatenate(rows)


def stupid_backoff(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER,
                   block_bytes: int = BLOCK_BYTES, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """doc_id, n_words, log_score (sum of natural logarithms) and mean_score."""
    table = written(blocks(docs, id_col, text_col, block_bytes), "blocks")
    size = table.agg(F.sum("bytes")).first()[0] or 0
    bits = max(6, int(np.ceil(np.log2(max(1, size / partition_bytes)))))

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "n", "block", "size", "hashes", "counts"]
        for b in batches:
            for r in b.to_pylist():
                words, row = _read(r["sizes"], r["texts"], r["bytes"])
                for n in range(1, order + 1):
                    h, times = np.unique(ngrams(words, row, n)[0], return_counts=True)
                    edges = np.searchsorted(_bucket(h, bits), np.arange((1 << bits) + 1))
                    some = np.flatnonzero(np.diff(edges))
                    cut = [(h[edges[k]:edges[k + 1]], times[edges[k]:edges[k + 1]].astype(np.uint32)) for k in some]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some, pa.int64()), pa.array(np.full(len(some), n), pa.int32()),
                         pa.array(np.full(len(some), r["block"]), pa.int64()),
                         pa.array([len(x) for x, _ in cut], pa.int64()),
                         pa.array([_packed(x) for x, _ in cut], pa.binary()),
                         pa.array([_packed(c) for _, c in cut], pa.binary())], names)

    def count(part: pd.DataFrame) -> pd.DataFrame:
        sizes = part["size"].tolist()
        h = np.concatenate([_unpacked(x, n, np.uint64) for x, n in zip(part["hashes"], sizes, strict=True)])
        c = np.concatenate([_unpacked(x, n, np.uint32) for x, n in zip(part["counts"], sizes, strict=True)])
        _, which = np.unique(h, return_inverse=True)
        total = np.bincount(which, c).astype(np.int64)[which]
        ends = np.cumsum(sizes)
        return part[["bucket", "n", "block", "size"]].assign(
            words=[int(c[e - n:e].sum()) for e, n in zip(ends, sizes, strict=True)],
            totals=[_packed(total[e - n:e]) for e, n in zip(ends, sizes, strict=True)])

    schema = "bucket long, n int, block long, size long, "
    counted = table.mapInArrow(explode, schema + "hashes binary, counts binary") \
        .groupBy("bucket", "n").applyInPandas(count, schema + "words long, totals binary")
    counted = written(counted, "counts")

    # All words: every block's unigrams, counted where they were exploded.
    n_words = counted.filter("n = 1").agg(F.sum("words")).first()[0] or 0

    def score(block: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
        r = block.iloc[0]
        words, row = _read(r["sizes"], r["texts"], int(r["bytes"]))
        n_docs = len(r["ids"])
        length = np.bincount(row, minlength=n_docs)
        rest = np.maximum(n_words - length, 1)[row] if len(row) else np.zeros(0)
        others = []  # by order: how often the n-gram that ends here occurs in other documents, -1: none ends here
        for n in range(1, order + 1):
            h, last = ngrams(words, row, n)
            mine = counts[counts["n"] == n].sort_values("bucket")
            total = np.concatenate([_unpacked(x, int(k), np.int64) for x, k in zip(mine["totals"], mine["size"], strict=True)]
                                   or [np.zeros(0, np.int64)])
            _, which = np.unique(h, return_inverse=True)
            _, cell, own = np.unique(row[last] << 32 | which, return_inverse=True, return_counts=True)
            left = np.full(len(words), -1, np.int64)
            left[last] = total[which] - own[cell]
            others.append(left)
        value = np.full(len(words), np.nan)
        depth = np.zeros(len(words))  # orders given up
        for n in range(order, 1, -1):
            here = others[n - 1]
            known = np.isnan(value) & (here > 0)
            at = np.flatnonzero(known)
            value[at] = np.log(here[at] / others[n - 2][at - 1]) + depth[at] * np.log(BACKOFF)
            depth += np.isnan(value) & (here >= 0)
        at = np.flatnonzero(np.isnan(value))
        value[at] = np.log(np.where(others[0][at] > 0, others[0][at], UNKNOWN_COUNT) / rest[at]) + depth[at] * np.log(BACKOFF)
        total = np.bincount(row, value, minlength=n_docs)
        return pd.DataFrame({"doc_id": pd.array(r["ids"], "Int64"), "n_words": length, "log_score": total,
                             "mean_score": pd.array([t / k if k else None for t, k in zip(total, length, strict=True)],
                                                    "Float64")})

    return table.groupBy("block").cogroup(counted.groupBy("block")).applyInPandas(
        score, "doc_id long, n_words long, log_score double, mean_score double")


def op6_lm_scoring(spark, sf_dir: str) -> DataFrame:
    """The trigram score of every document under the counts of all others."""
    return stupid_backoff(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("mean_score", 6).alias("mean_score"))


SQL = r"""
WITH l AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
p AS (
  SELECT doc_id, i, ws[i] AS w, CASE WHEN i > 1 THEN ws[i - 1] END AS v, CASE WHEN i > 2 THEN ws[i - 2] END AS u
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM l)),
c1 AS (SELECT w, count(*) AS n FROM p GROUP BY w),
d1 AS (SELECT doc_id, w, count(*) AS n FROM p GROUP BY doc_id, w),
o1 AS (SELECT doc_id, w, c1.n - d1.n AS n FROM d1 JOIN c1 USING (w)),
c2 AS (SELECT v, w, count(*) AS n FROM p WHERE v IS NOT NULL GROUP BY v, w),
d2 AS (SELECT doc_id, v, w, count(*) AS n FROM p WHERE v IS NOT NULL GROUP BY doc_id, v, w),
o2 AS (SELECT doc_id, v, w, c2.n - d2.n AS n FROM d2 JOIN c2 USING (v, w)),
c3 AS (SELECT u, v, w, count(*) AS n FROM p WHERE u IS NOT NULL GROUP BY u, v, w),
d3 AS (SELECT doc_id, u, v, w, count(*) AS n FROM p WHERE u IS NOT NULL GROUP BY doc_id, u, v, w),
o3 AS (SELECT doc_id, u, v, w, c3.n - d3.n AS n FROM d3 JOIN c3 USING (u, v, w)),
s AS (
  SELECT p.doc_id,
    CASE WHEN o3.n > 0 THEN ln(o3.n / oc.n)
         WHEN o2.n > 0 THEN ln(o2.n / ov.n) + CASE WHEN p.u IS NULL THEN 0 ELSE ln(0.4) END
         ELSE ln(CASE WHEN ow.n > 0 THEN ow.n ELSE 0.5 END / greatest((SELECT sum(len(ws)) FROM l) - len(l.ws), 1))
              + ln(0.4) * least(p.i - 1, 2) END AS x
  FROM p JOIN l USING (doc_id) JOIN o1 ow ON ow.doc_id = p.doc_id AND ow.w = p.w
  LEFT JOIN o1 ov ON ov.doc_id = p.doc_id AND ov.w = p.v
  LEFT JOIN o2 ON o2.doc_id = p.doc_id AND o2.v = p.v AND o2.w = p.w
  LEFT JOIN o2 oc ON oc.doc_id = p.doc_id AND oc.v = p.u AND oc.w = p.v
  LEFT JOIN o3 ON o3.doc_id = p.doc_id AND o3.u = p.u AND o3.v = p.v AND o3.w = p.w)
SELECT l.doc_id, len(l.ws) AS n_words, round(coalesce(t.x, 0), 4) AS log_score,
       round(t.x / nullif(len(l.ws), 0), 6) AS mean_score
FROM l LEFT JOIN (SELECT doc_id, sum(x) AS x FROM s GROUP BY doc_id) t USING (doc_id)"""
