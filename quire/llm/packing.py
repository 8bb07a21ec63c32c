"""Best-fit packing by a configuration linear program.

A configuration is a multiset of lengths that fit one sequence. The program
asks for the fewest configurations that cover the histogram of lengths. It is
solved by multiplicative weights: a length's price rises exponentially as its
cover lags and falls as it runs ahead; a knapsack dynamic program prices all
configurations, giving every length that is short the best one that holds it.
The prices also give a lower bound. Rounding keeps whole parts of the
solution, never above the demand, and places the remaining pieces largest
first, each sequence filled by an exact subset sum over the lengths that
remain; of several shares kept, the plan with the fewest sequences stays.

Scale: the driver sees only the histogram (at most ``capacity`` counts) and
makes a plan of rank ranges per length, whose size depends on the capacity
and not on the number of rows; it is broadcast. Ranks within a length are
counted over salts, so that a length that holds a third of all rows is dealt
over ``SALTS`` keys.

Defined cases: a null or empty text is one piece holding only the closing id;
repeated rows are packed as often as they occur; a null id stays null; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import math
import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe_words import SLICE, Codes, Memo, by_units, gathered
from .byte_bpe import pattern
from .common import byte_slices, read_table, written

CAPACITY = 2048
SALTS = 64
#: Rounds of multiplicative weights in one solution of the program.
ROUNDS = 32
#: How strongly a length's price answers to a lag of one round.
RATE = 0.3
#: Parts of the solution that rounding keeps, in turn; the fewest sequences win.
SHARES = (1.0, 0.5, 0.25, 0.125)


def tokenizer_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


#: A pre-tokenizer that does no more than cut by the pattern and spell bytes as characters.
_BYTES_ONLY = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


def byte_characters() -> np.ndarray:
    """The character that a byte-level vocabulary spells each byte by."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = np.zeros(256, "<u4")
    out[own] = own
    rest = np.setdiff1d(np.arange(256), own)
    out[rest] = 256 + np.arange(len(rest))
    return out


@lru_cache(maxsize=2)
def _encoder(spec: str, split: str):
    """(encoder of pre-tokens, cutter of units, memory). Only pre-tokens not
    met lately go to the tokenizer, each straight to its model: cutting by the
    pattern again and the library's offsets take longer than the merges."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import regex
    from tokenizers import Tokenizer
    tok, cut, spelt = Tokenizer.from_str(spec), regex.compile(split).findall, byte_characters()
    special = [regex.escape(t.content) for t in tok.get_added_tokens_decoder().values()]
    marked = regex.compile("|".join(special)).search if special else lambda text: None
    made, model = json.loads(spec), tok.model
    straight = not made.get("normalizer") and _BYTES_ONLY.items() <= (made.get("pre_tokenizer") or {}).items() \
        and split == pattern()

    def encode(new: list[str]) -> Codes:
        if not new:
            return Codes.of([])
        if straight and not marked("\n".join(new)):
            # The byte 255 is in no UTF-8 text and stands for itself among the characters.
            text = np.frombuffer(b"\xff".join(map(str.encode, new)), np.uint8)
            parts = ([x.id for x in t] for t in map(model.tokenize, spelt[text].tobytes().decode("utf-32-le").split("\xff")))
        else:
            parts = (e.ids for e in tok.encode_batch_fast(new, add_special_tokens=False))
        ids, sizes = [], []
        for p in parts:
            ids += p
            sizes.append(4 * len(p))
        sizes = np.array(sizes, np.int64)
        return Codes(np.array(ids, "<u4").view(np.uint8), np.cumsum(sizes) - sizes, sizes)

    return encode, lambda unit: [unit] if marked(unit) else cut(unit), Memo()


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
           capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Token ids of every text and ``end_id``, cut into pieces of ``capacity``
    ids where longer (the first piece takes the remainder): doc_id, piece,
    start, length, ids_crc32, salt."""
    spark = docs.sparkSession
    with open(tokenizer or tokenizer_file(), encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    split = pattern()
    end = np.asarray([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, cut_unit, memo = _encoder(spec.value, split)
        n_rows = 0
        for batch in batches:
            for b in byte_slices(batch, 1, SLICE):
                ids_col, piece, start, length, crc = [], [], [], [], []
                codes, which, texts = by_units(b.column(1), encode, memo, cut_unit)
                ids, ends = gathered(codes, which)
                raw, ends = memoryview(ids.tobytes()), ends[texts].tolist()
                for doc, first, stop in zip(b.column(0).to_pylist(), ends, ends[1:], strict=False):
                    n = stop - first + 1
                    at, k, size = 0, 0, n - capacity * ((n - 1) // capacity)
                    while at < n:
                        ids_col.append(doc)
                        piece.append(k)
                        start.append(at)
                        length.append(size)
                        part = zlib.crc32(raw[4 * (first + at):4 * min(first + at + size, stop)])
                        at, k, size = at + size, k + 1, capacity
                        crc.append(part if at < n else zlib.crc32(end, part))
                salt = (np.arange(n_rows, n_rows + len(piece)) % SALTS).astype(np.int32)
                n_rows += len(piece)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids_col, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(salt)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "salt"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, salt int")


# --- the program ---------------------------------------------------------------


def _knapsack(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """best[c]: the highest price of lengths that sum to at most c; last[c]:
    the index of one of them, -1 where it equals best[c - 1]."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        k = int(np.searchsorted(lengths, c, "right"))
        if k:
            values = prices[:k] + best[c - lengths[:k]]
            i = k - 1 - int(values[::-1].argmax())  # of equal ones the largest: small lengths fill any gap
            if values[i] > best[c] + 1e-12:
                best[c], last[c] = values[i], i
    return best, last


def _traced(last: np.ndarray, lengths: np.ndarray, c: int) -> list[int]:
    """The lengths (as indexes) behind best[c]."""
    out = []
    while c > 0:
        if last[c] < 0:
            c -= 1
        else:
            out.append(int(last[c]))
            c -= int(lengths[last[c]])
    return out


def solve(lengths: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = ROUNDS) \
        -> tuple[dict[tuple[int, ...], float], float]:
    """Fractional configurations (tuples of length indexes) that cover the
    demand, and a lower bound on the program's value.

    After round t every length is covered to the share t / rounds. A length's
    weight is exponential in how far its cover lags behind, so the dynamic
    program fills sequences with lengths that lag; each length still short
    takes the best configuration that holds it."""
    share = lengths / capacity
    covered, x, bound = np.zeros(len(lengths)), {}, float(demand @ share)
    for t in range(1, rounds + 1):
        lag = t / rounds - covered / demand
        prices = share * np.exp(np.clip(RATE * rounds * (lag - 1 / rounds), -8, 2))
        best, last = _knapsack(prices, lengths, capacity)
        bound = max(bound, float(demand @ prices) / best[capacity])
        fill: dict[int, list[int]] = {}
        for i in range(len(lengths) - 1, -1, -1):
            short = demand[i] * t / rounds - covered[i]
            if short <= 1e-9 * demand[i]:
                continue
            room = int(capacity - lengths[i])
            if room not in fill:
                fill[room] = _traced(last, lengths, room)
            c = tuple(sorted([i, *fill[room]]))
            amount = short / c.count(i)
            x[c] = x.get(c, 0.0) + amount
            for j in c:
                covered[j] += amount
    return x, bound


def _filled(lengths: list[int], left: dict[int, int], capacity: int) -> list[int]:
    """The largest length left and the subset of the others that fills its
    sequence best (exact subset sum; larger lengths first)."""
    top = next(n for n in lengths if left[n])
    room = capacity - top
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for n in lengths:
        if n > room:
            continue
        for _ in range(min(left[n] - (n == top), room // n)):
            grown = (reach | reach << n) & mask
            if grown == reach:
                break
            steps.append((n, reach))
            reach = grown
        if reach >> room:
            break
    at, out = reach.bit_length() - 1, [top]
    for n, before in reversed(steps):
        if not before >> at & 1:
            out.append(n)
            at -= n
    return out


def _rounded(x: dict[tuple[int, ...], float], lengths: np.ndarray, left: dict[int, int], share: float, capacity: int) \
        -> list[tuple[tuple[int, ...], int]]:
    """Whole parts of ``share`` times the solution, never above the demand;
    what is left is placed largest first."""
    out, left = [], dict(left)
    for c, amount in sorted(x.items(), key=lambda kv: (-sum(int(lengths[i]) for i in kv[0]), -kv[1], kv[0])):
        need: dict[int, int] = {}
        for i in c:
            need[int(lengths[i])] = need.get(int(lengths[i]), 0) + 1
        m = min(int(amount * share), *(left[n] // a for n, a in need.items()))
        if m > 0:
            out.append((tuple(sorted((n for n, a in need.items() for _ in range(a)), reverse=True)), m))
            for n, a in need.items():
                left[n] -= a * m
    order = sorted(left, reverse=True)
    while order := [n for n in order if left[n]]:
        c = _filled(order, left, capacity)
        m = min(left[n] // c.count(n) for n in set(c))
        out.append((tuple(sorted(c, reverse=True)), m))
        for n in c:
            left[n] -= m
    return out


def configurations(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in one sequence, number of such sequences), covering the
    histogram exactly."""
    left = {n: c for n, c in histogram.items() if c}
    out = [((capacity,), left.pop(capacity))] if left.get(capacity) else []
    if not left:
        return out
    lengths = np.array(sorted(left))
    x, bound = solve(lengths, np.array([left[n] for n in lengths], float), capacity)
    best = None
    for share in SHARES:
        plan = _rounded(x, lengths, left, share, capacity)
        if best is None or sum(m for _, m in plan) < sum(m for _, m in best):
            best = plan
        if sum(m for _, m in best) <= math.ceil(bound - 1e-6):
            break  # as few as the bound allows
    return out + best


def _plan(configs: list[tuple[tuple[int, ...], int]], capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (first key, sequence, copies, offset) sorted by first key, where a
    piece's key is length << 40 | rank within its length; and the keys."""
    used, rows, sequence = {}, [], 0
    for c, m in configs:
        offset = 0
        for n in dict.fromkeys(c):
            a, rank = c.count(n), used.get(n, 0)
            rows.append((n << 40 | rank, sequence, a, offset))
            used[n] = rank + a * m
            offset += a * n
        sequence += m
    plan = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return plan[:, 0].copy(), plan


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with length and salt) and their place: sequence_id, offset.
    Read several times, so it should be a written table."""
    spark = pieces.sparkSession
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    plan = spark.sparkContext.broadcast(_plan(configurations(histogram, capacity), capacity))
    counts = pieces.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("rank", F.row_number().over(within) - 1).join(counts, ["length", "salt"]) \
        .withColumn("rank", F.col("rank") + F.col("before")).drop("before", "salt")
    names = [c for c in ranked.columns if c != "rank"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, rows = plan.value
        for b in batches:
            length = b.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            key = length << 40 | b.column("rank").to_numpy(zero_copy_only=False).astype(np.int64)
            row = rows[np.searchsorted(keys, key, "right") - 1]
            at = key - row[:, 0]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(n) for n in names), pa.array(row[:, 1] + at // row[:, 2]),
                 pa.array(row[:, 3] + at % row[:, 2] * length)], [*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema + ", sequence_id long, offset long")


def op10_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All documents cut and packed into sequences of at most 2048 tokens."""
    return pack(written(pieces(read_table(spark, sf_dir, "documents")), "pieces")) \
        .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
