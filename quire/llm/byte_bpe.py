"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one is a minimal perfect hash over the vocabulary: a bucket's
displacement sends every token's 64-bit hash to a slot of its own among
exactly as many slots as there are tokens, and one comparison of bytes tells a
member from a stranger. A pre-token that is in the vocabulary is resolved by
it whole. Tier two merges the others: bytes in a linked list, adjacent pairs
in a heap by (rank, position), or in a plain list where they are few; ranks of
pairs come from the same hash.

Scale: one pass without a shuffle. The vocabulary (bounded: a file of ranks)
is broadcast once; codes of words are remembered per Python worker, up to a
bound (:class:`~quire.llm.bpe_words.Memo`). A merge of n bytes takes n log n
steps, so one very long pre-token costs no more than its share.

Defined cases: a null text counts as empty (no ids, the hash of the empty
string); repeated rows are encoded each; a null id stays null; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_words import SLICE, Codes, Memo, by_units, gathered, values
from .common import byte_slices, read_table

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_BITS = 20  # a pair of ids as one integer; vocabularies hold fewer than 2^20
_NONE = 1 << _BITS  # the rank of a pair that doesn't merge
#: Bytes up to which a pre-token's lowest pair is found by looking at them all.
SHORT = 48


def ranks_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def read_ranks(path: str) -> list[bytes]:
    """Tokens by id."""
    with open(path, "rb") as f:
        ranked = sorted((int(r), base64.b64decode(t)) for t, r in map(bytes.split, f))
    if [r for r, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks are not 0, 1, 2, ...")
    return [t for _, t in ranked]


def build_hash(tokens: list[bytes], per_bucket: int = 4) -> tuple[list[int], list[int]]:
    """(displacement of each bucket, id in each slot) of a minimal perfect hash."""
    n = len(tokens)
    hashes = [xxhash.xxh3_64_intdigest(t) for t in tokens]
    buckets: list[list[int]] = [[] for _ in range(max(1, n // per_bucket))]
    for i, h in enumerate(hashes):
        buckets[h % len(buckets)].append(i)
    displacement, ids = [0] * len(buckets), np.full(n, -1)
    trial = np.arange(4096, dtype=np.uint64) * np.uint64(_ODD)
    for b in sorted(range(len(buckets)), key=lambda b: -len(buckets[b])):
        if not buckets[b]:
            continue
        h = np.array([hashes[i] for i in buckets[b]], np.uint64)
        base = 0
        while True:
            moved = (trial + np.uint64(base * _ODD & _MASK))[:, None] ^ h[None, :]
            slots = ((moved * np.uint64(_ODD) >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)
            free = (ids[slots] < 0).all(axis=1)
            for d in np.flatnonzero(free):
                if len(set(slots[d].tolist())) == len(h):
                    displacement[b] = base + int(d)
                    ids[slots[d]] = buckets[b]
                    break
            else:
                base += len(trial)
                continue
            break
    return displacement, ids.tolist()


class Codec:
    """Encodes and decodes by a vocabulary and its minimal perfect hash."""

    def __init__(self, tokens: list[bytes], perfect: tuple[list[int], list[int]], pattern: str):
        self.tokens, (self.displacement, self.slots) = tokens, perfect
        self.split = regex.compile(pattern).findall
        self.bytes = [self.find(bytes([b])) for b in range(256)]
        self.short = SHORT if min(self.bytes) >= 0 else 0
        self.pairs = _Pairs(self)
        self.memo = Memo()
        self.spelt = Codes.of(tokens)
        self.decimal = Codes.of([b"%d " % i for i in range(len(tokens))])

    def find(self, token: bytes) -> int:
        """The id of a token, -1 where the vocabulary lacks it."""
        h = xxhash.xxh3_64_intdigest(token)
        moved = (self.displacement[h % len(self.displacement)] * _ODD & _MASK) ^ h
        i = self.slots[((moved * _ODD & _MASK) >> 32) * len(self.slots) >> 32]
        return i if self.tokens[i] == token else -1

    def merge(self, token: bytes) -> list[int]:
        """Ids of a pre-token by merges of the lowest rank, leftmost first."""
        ids = [self.bytes[b] for b in token]
        n, pairs = len(ids), self.pairs
        ranks = [pairs[a << _BITS | b] for a, b in zip(ids, ids[1:])]  # of the pair that starts here
        if n <= self.short:
            while ranks and (rank := min(ranks)) != _NONE:
                i = ranks.index(rank)
                ids[i] = rank
                del ids[i + 1], ranks[i]
                if i < len(ranks):
                    ranks[i] = pairs[rank << _BITS | ids[i + 1]]
                if i:
                    ranks[i - 1] = pairs[ids[i - 1] << _BITS | rank]
            return ids
        heap = [r << 32 | i for i, r in enumerate(ranks) if r != _NONE]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heapify(heap)
        while heap:
            top = heappop(heap)
            rank, i = top >> 32, top & 0xFFFFFFFF
            if ranks[i] != rank:
                continue  # one of the two has been merged since
            j = after[i]
            after[i] = k = after[j]
            ids[i], ids[j] = rank, -1
            if k < n:
                before[k] = i
                ranks[j] = _NONE
                ranks[i] = r = pairs[rank << _BITS | ids[k]]
                if r != _NONE:
                    heappush(heap, r << 32 | i)
            else:
                ranks[i] = _NONE
            p = before[i]
            if p >= 0:
                ranks[p] = r = pairs[ids[p] << _BITS | rank]
                if r != _NONE:
                    heappush(heap, r << 32 | p)
        return [i for i in ids if i >= 0]

    def word(self, token: str) -> list[int]:
        """Ids of one pre-token: whole by the hash, else merged."""
        b = token.encode()
        i = self.find(b)
        return [i] if i >= 0 else self.merge(b)

    def encode(self, text: str) -> list[int]:
        return [i for t in self.split(text) for i in self.word(t)]

    def encode_words(self, tokens: list[str]) -> list[bytes]:
        """Ids of each pre-token as little-endian 32-bit integers."""
        return [struct.pack(f"<{len(ids)}I", *ids) for ids in map(self.word, tokens)]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, gathered from the vocabulary in blocks."""
        return values(self.spelt, ids, np.uint8).tobytes()

    def told(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by blanks."""
        return values(self.decimal, ids, np.uint8)[:-1].tobytes()


class _Pairs(dict):
    """Rank of the token that two ids merge into, ``_NONE`` if none; found by
    the perfect hash when first asked for. Emptied at half a million entries."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, pair: int) -> int:
        tokens = self.codec.tokens
        rank = self.codec.find(tokens[pair >> _BITS] + tokens[pair & (1 << _BITS) - 1])
        if len(self) > 500_000:
            self.clear()
        self[pair] = rank = rank if rank >= 0 else _NONE
        return rank


@lru_cache(maxsize=4)
def _built(path: str) -> tuple[list[bytes], tuple[list[int], list[int]]]:
    tokens = read_ranks(path)
    return tokens, build_hash(tokens)


_CODECS: dict[str, Codec] = {}


def encode_and_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str | None = None,
                      split: str | None = None, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text and, with
    ``keep_ids``, the ids themselves."""
    spark = docs.sparkSession
    path, split = ranks or ranks_file(), split or pattern()
    model = spark.sparkContext.broadcast(_built(path))
    key = f"{path}|{split}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _CODECS.get(key)
        if codec is None:
            codec = _CODECS[key] = Codec(*model.value, split)
        for batch in batches:
            for b in byte_slices(batch, 1, SLICE):
                rows = []
                codes, which, units = by_units(b.column(1), codec.encode_words, codec.memo, codec.split)
                flat, ends = gathered(codes, which)
                ends = ends[units].tolist()
                for k, doc in enumerate(b.column(0).to_pylist()):
                    ids = flat[ends[k]:ends[k + 1]]
                    rows.append((doc, len(ids), hashlib.sha256(codec.told(ids)).hexdigest(),
                                 hashlib.sha256(codec.decode(ids)).hexdigest(), ids if keep_ids else None))
                cols = list(zip(*rows, strict=True))
                out = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                       pa.array(cols[3], pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    out.append(pa.array([x.astype(np.int32) for x in cols[4]], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, schema + (", ids array<int>" if keep_ids else ""))


def op3_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded, one row each."""
    return encode_and_decode(read_table(spark, sf_dir, "documents"))
