"""Runs of repeated words: online dyadic square catching.

A run is a stretch of words that repeats with some smallest period q, at least
``min_words`` and 2q long, that no neighbouring word prolongs. Words are read
from left to right. Whenever a block of a power of two words is complete, a
catcher is set on it: it waits for the block to come back at the distances
that belong to its size, one appended word after the other. When it does, the
two suffixes are compared on: backwards from the block to where the repetition
began, forwards with each further word until one differs. A stretch of two
periods is a square; squares of one period that overlap are one run.

Why nothing is missed: in a run of period q the words that equal the one q
later form a stretch of at least ``m = max(min_words - q, q)``, and any stretch
of ``2s - 1`` words holds a whole aligned block of s. So period q belongs to
the largest power of two s with ``2s - 1 <= m``. A block that comes back inside
a known run, at a multiple of its period, tells nothing new and is passed over;
by the periodicity lemma what is left is a few returns for each block.

The catchers of one block size advance together over a batch of texts, as
arrays: a step compares the hashes of all waiting blocks with those of the
windows one word on. (Hashes only propose; words are compared.) Work grows
with n log n.

Scale: one narrow pass, no shuffle; a batch holds a few MB of text, or one
text that is longer.

Defined cases: null, empty and blank texts have no words and no runs; a null
id stays null; repeated rows give one row each; a text's words are joined by
one space in ``collapsed``; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, mix64, read_table

MIN_WORDS = 12
BATCH_BYTES = 2 << 20
_BASE = 0x9FB21C651E98DF25
RUNS = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def block_sizes(longest: int, min_words: int) -> list[tuple[int, np.ndarray]]:
    """(s, its periods) for texts of up to ``longest`` words, by size."""
    sizes = defaultdict(list)
    half = -(-min_words // 2)
    for q in range(1, min(half, longest // 2 + 1)):  # short periods: the least length counts
        sizes[1 << ((min_words - q + 1) // 2).bit_length() - 1].append(q)
    s = 1
    while 2 * s - 1 <= longest // 2:
        first = max(2 * s - 1, half)
        if first < 4 * s - 1:
            sizes[s].extend(range(first, min(4 * s - 2, longest // 2) + 1))
        s *= 2
    return [(s, np.array(sizes[s])) for s in sorted(sizes) if sizes[s]]


def _returns(codes: np.ndarray, blocks: np.ndarray, reach: np.ndarray, periods: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) wherever a block's code comes back. ``reach`` is the
    largest distance that stays in the text."""
    found = []
    own = codes[blocks]
    if len(periods) <= len(blocks):  # all catchers take one word after another
        for q in periods:
            k = np.flatnonzero(reach >= q)
            k = k[codes[blocks[k] + q] == own[k]]
            if len(k):
                found.append((blocks[k], np.full(len(k), q)))
    else:  # few catchers: each takes all its words at once
        for b, r, code in zip(blocks, reach, own):
            q = periods[:np.searchsorted(periods, r, "right")]
            q = q[codes[b + q] == code]
            if len(q):
                found.append((np.full(len(q), b), q))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _same_after(words: np.ndarray, i: int, j: int, stop: int) -> int:
    """How many words from i equal those from j on, before ``stop``."""
    done, step = 0, 32
    while j + done < stop:
        n = min(step, stop - j - done)
        differ = words[i + done:i + done + n] != words[j + done:j + done + n]
        if differ.any():
            return done + int(differ.argmax())
        done, step = done + n, step * 2
    return done


def _same_before(words: np.ndarray, i: int, j: int, first: int) -> int:
    """How many words up to i (not itself) equal those up to j, from ``first``."""
    done, step = 0, 32
    while i - done > first:
        n = min(step, i - done - first)
        differ = words[i - done - n:i - done] != words[j - done - n:j - done]
        if differ.any():
            return done + int(differ[::-1].argmax())
        done, step = done + n, step * 2
    return done


def find_runs(words: np.ndarray, ends: np.ndarray, min_words: int = MIN_WORDS) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, by start and period.
    ``words`` are integers for the words of texts that end at ``ends``."""
    sizes = np.diff(ends, prepend=0)
    found: list[list[tuple[int, int, int]]] = [[] for _ in ends]
    if not len(words) or sizes.max() < min_words:
        return found
    text = np.repeat(np.arange(len(ends)), sizes)
    codes, width = mix64(words.astype(np.uint64) + np.uint64(_BASE)), 1
    for s, periods in block_sizes(int(sizes.max()), min_words):
        while width < s:
            codes = codes[:-width] * np.uint64(pow(_BASE, width, 1 << 64)) + codes[width:]
            width *= 2
        blocks = np.arange(0, len(codes), s)
        reach = ends[text[blocks]] - s - blocks
        blocks, reach = blocks[reach >= periods[0]], reach[reach >= periods[0]]
        b, q = _returns(codes, blocks, reach, periods)
        order = np.lexsort((b, q, text[b]))
        b, q = b[order], q[order]
        # Adjoining blocks that come back at one distance are one stretch.
        new = np.ones(len(b), bool)
        new[1:] = (q[1:] != q[:-1]) | (b[1:] != b[:-1] + s)
        starts = np.flatnonzero(new)
        for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(b)]):
            period, known = int(q[lo]), found[text[b[lo]]]
            first = int(b[lo])
            if any(period % p == 0 and x <= first and first + period + s <= y for x, y, p in known):
                continue
            for at in b[lo:hi].tolist():
                if not (words[at:at + s] == words[at + period:at + period + s]).all():
                    continue  # the hashes agree, the words don't
                t = text[at]
                x = at - _same_before(words, at, at + period, int(ends[t] - sizes[t]))
                y = at + period + s + _same_after(words, at + s, at + s + period, int(ends[t]))
                if y - x >= max(min_words, 2 * period):
                    known.append((x, y, period))
                break
    out = []
    for runs, base in zip(found, (ends - sizes).tolist()):
        least: dict[tuple[int, int], int] = {}
        for x, y, p in runs:
            least[x, y] = min(p, least.get((x, y), p))
        out.append(sorted((x - base, y - x, p) for (x, y), p in least.items()))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but those that any run holds after its first period."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return b" ".join([words[k] for k in np.flatnonzero(keep).tolist()])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, ``runs`` (by start, then period; word numbers from 0) and the
    text ``collapsed`` to one period of each run."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, 1, BATCH_BYTES):
                split = [(t or b"").split() for t in part.column(1).cast(pa.large_binary()).to_pylist()]
                number: dict[bytes, int] = defaultdict(count().__next__)
                total = sum(map(len, split))
                words = np.fromiter((number[w] for ws in split for w in ws), np.int64, total)
                runs = find_runs(words, np.cumsum([len(ws) for ws in split]), min_words)
                texts = [collapsed(ws, rs).decode() for ws, rs in zip(split, runs)]
                kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
                flat = np.array([r for rs in runs for r in rs], np.int64).reshape(-1, 3)
                structs = pa.StructArray.from_arrays([pa.array(c) for c in flat.T.copy()], ["start", "length", "period"])
                offsets = pa.array(np.cumsum([0, *map(len, runs)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(offsets, structs).cast(kind), pa.array(texts, pa.string())],
                    ["doc_id", "runs", "collapsed"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(scan, RUNS)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``documents``; by the crc32 of the id every tenth
    text becomes periodic from some word on (fixed rule of the query)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    # The words are cut once: the generator keeps them from being cut again in each use.
    cut = F.regexp_extract_all(F.col("text"), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .select("doc_id", "text", F.inline(F.array(F.struct(F.when(chosen, cut).alias("w")))))
    w, g, n = F.col("w"), F.floor(h / 10), F.size("w")
    docs = docs.withColumn("a", F.when(n > 0, (g % n).cast("int"))) \
        .withColumn("p", F.when(n > 0, (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int")))
    a, p = F.col("a"), F.col("p")
    tail = _cycled(F.slice(w, a + 1, p), n - a, p)
    return docs.select("doc_id", F.when(n > 0, F.array_join(F.concat(F.slice(w, 1, a), tail), " "))
                       .otherwise(F.col("text")).alias("text"))


def _cycled(words: Column, n: Column, p: Column) -> Column:
    """``n`` words that repeat the ``p`` given ones."""
    times = F.ceil(n / p).cast("int")
    return F.slice(F.flatten(F.array_repeat(words, times)), 1, n)


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of every whole text of ``documents``, planted ones among them."""
    runs = periodic_runs(with_planted_runs(read_table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("n"), (-r["start"]).alias("s"),
                                                              (-r["period"]).alias("p"))))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    return runs.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-best["s"]).alias("start"), best["n"].alias("length"),
        (-best["p"]).alias("period"), F.floor(best["n"] * 1000 / -best["p"]).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
