"""Removal of long repeated strings by distributed prefix doubling.

Every byte that lies in a string of ``length`` bytes which also starts
earlier (smaller id, or same text and earlier start) is removed; strings are
judged on the input. Positions are ranked by the bytes that start there, at
growing lengths, and leave as soon as their rank is unique:

1. *Seeds.* A position's first rank is that of the smallest ``seed``-byte
   gram in its string, the leftmost of equal ones. Equal strings have equal
   seeds at equal places, and neighbouring positions share one, so a run of positions is one row (about 36 bytes of
   text a row). Spark sorts the runs by seed; a seed that occurs once ends
   its positions. Runs with equal content are settled whole: the first stays,
   the others are removed.
2. *Doubling.* The positions left (runs that share a seed but differ
   somewhere, mostly at the edges of copies) bring their bytes. Spark sorts
   them by seed, and pairs (rank, rank ``offset`` later) are sorted and
   reranked at 8, 16, 32, 64 bytes and then at the full length; positions of
   unique rank take no further part. These ranks are exact, without hashing.

Scale: runs that repeat inside one block of rows are settled before the
shuffle, so a string in a third of all documents sends one row a block. A
seed shared by more than ``HOT_RUNS`` different runs is dealt on by the hash
of each position's whole string. Sorted rows are read in whole keys of
bounded size. Of equal rows one is searched; a list holds the different runs
or spans of one text. Texts are shuffled twice, by document.

Defined cases: null or empty text has no bytes, nothing removed; texts
shorter than ``length`` keep everything; equal rows (same id and text) don't
count as earlier than one another and share one decision; different texts
under one id are ordered by a hash of the text; a null id comes last; an
empty table gives an empty result; other columns, of any name, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from .bpe_words import forget
from .common import byte_slices, give_back, mix64, quoted, read_table, text_bytes, window_hash, written

LENGTH = 100
SEED = 32
#: Different runs of one seed above which its positions are dealt singly.
HOT_RUNS = 4096
#: Windows handled at a time; rows and bytes of a block of whole keys.
_BLOCK, _ROWS, _BYTES = 1 << 17, 1 << 16, 1 << 19
_PLACE = 21  # bits of a position in a block and the longest string after it
_LAST = (1 << 63) - 1  # stands for a null id
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_RUN, _GONE, _SINGLE = 0, 1, 2

# A text is named by its id and a 64-bit mark; a run's start and its positions (8 bits) are packed in one long.
_RUNS = "key long, ctx long, doc long, mark long, run long"


def _codes(salt: int) -> np.ndarray:
    return mix64(np.arange(256, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))


_TABLES = (_codes(0x1234567), _codes(0x7654321))


def _smallest(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by joining doubled widths."""
    done = 1
    while done * 2 <= width:
        h = np.minimum(h[:len(h) - done], h[done:])
        done *= 2
    rest = width - done
    return np.minimum(h[:len(h) - rest], h[rest:]) if rest else h


def _runs(offsets: np.ndarray, data: np.ndarray, length: int, seed: int) \
        -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (row, start, positions, seed, content) of the texts' runs."""
    width = min(length - seed + 1, 255)
    for low in range(0, max(0, len(data) - length + 1), _BLOCK):
        part = data[low:low + _BLOCK + length - 1]
        gram = mix64(window_hash(_TABLES[0][part], seed, _BASES[0]))
        # The leftmost smallest gram of each string: its position in the low bits breaks ties.
        least = _smallest(gram >> np.uint64(_PLACE) << np.uint64(_PLACE) | np.arange(len(gram), dtype=np.uint64),
                          length - seed + 1) & np.uint64((1 << _PLACE) - 1)
        whole = window_hash(_TABLES[1][part], length, _BASES[1])
        at = np.arange(low, low + len(whole))
        row = np.searchsorted(offsets, at, "right") - 1
        inside = at + length <= offsets[row + 1]
        at, row, least, whole = at[inside], row[inside], least[inside].astype(np.int64), whole[inside]
        if not len(at):
            continue
        new = np.r_[True, (least[1:] != least[:-1]) | (row[1:] != row[:-1])]
        first = np.flatnonzero(new)
        since = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
        first = np.flatnonzero(since % width == 0)
        n = np.diff(np.r_[first, len(at)])
        last = first + n - 1
        content = mix64(whole[first] * np.uint64(31) + mix64(whole[last]) + n.astype(np.uint64))
        yield row[first], at[first] - offsets[row[first]], n, gram[least[first]], content


def _earlier(rank: np.ndarray, doc: np.ndarray, mark: np.ndarray, place: np.ndarray) \
        -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, first of its rank, gone) after sorting by (rank, doc, mark,
    place); a row at the very place of the first is not gone."""
    by = np.lexsort((place, mark, doc, rank))
    r = rank[by]
    first = np.r_[True, r[1:] != r[:-1]] if len(r) else np.zeros(0, bool)
    lead = by[np.maximum.accumulate(np.where(first, np.arange(len(by)), 0))] if len(r) else by
    gone = (doc[by] != doc[lead]) | (mark[by] != mark[lead]) | (place[by] != place[lead])
    return by, first, gone


def _settled(key: np.ndarray, ctx: np.ndarray, doc: np.ndarray, mark: np.ndarray, run: np.ndarray) \
        -> tuple[np.ndarray, np.ndarray]:
    """(rows that stay, rows that are gone) among rows of equal key and content."""
    by, first, gone = _earlier(_pair(key, ctx), doc, mark, run)
    return by[first], by[gone]


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A dense rank for pairs."""
    by = np.lexsort((b, a))
    out = np.zeros(len(a), np.int64)
    if len(a):
        out[by] = np.cumsum(np.r_[False, (a[by][1:] != a[by][:-1]) | (b[by][1:] != b[by][:-1])])
    return out


def _whole_keys(batches: Iterator[pa.RecordBatch], rows: int, sized: int | None = None) -> Iterator[pa.Table]:
    """Sorted batches joined and cut between keys, at least ``rows`` rows (or
    ``_BYTES`` bytes in column ``sized``, by which batches are sliced) at a time."""
    held, n, size = [], 0, 0
    slices = batches if sized is None else (s for b in batches for s in byte_slices(b, sized, _BYTES))
    for b in slices:
        held.append(b)
        n += b.num_rows
        size += _size(b, sized)
        if n < rows and size < _BYTES:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        keys = t.column(0).to_numpy()
        cut = int(np.searchsorted(keys, keys[-1])) if n else 0
        if cut:
            yield t.slice(0, cut)
            t = t.slice(cut)
        held = t.to_batches()
        n, size = t.num_rows, _size(t, sized)
    if n:
        yield pa.Table.from_batches(held).combine_chunks()
    held = []
    give_back()


def _size(rows: pa.RecordBatch | pa.Table, column: int | None) -> int:
    return rows.column(column).nbytes if column is not None else 0


def _longs(names: list[str], *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int64))
                                       for c in columns], names)


def _ranked(data: np.ndarray, length: int) -> np.ndarray:
    """Exact rank of the ``length`` bytes at every position (fewer than
    ``length`` left: meaningless), by prefix doubling; unique ranks are kept
    apart and not sorted again."""
    n, step = len(data), min(8, length)
    padded = np.r_[data, np.zeros(length, np.uint8)]
    rank = np.zeros(n, np.uint64)
    for j in range(step):
        rank = rank << np.uint64(8) | padded[j:j + n]
    alive, done = np.arange(n), step
    out = np.zeros(n, np.uint64)
    while True:
        value, count = np.unique(rank[alive], return_inverse=True, return_counts=True)[1:]
        shared = count[value] > 1
        out[:] = len(count) + np.arange(n, dtype=np.uint64)  # a rank of its own
        out[alive[shared]] = value[shared].astype(np.uint64)
        alive = alive[shared]
        if done == length:
            return out
        step = min(done, length - done)
        alive = alive[alive + step < n]
        rank = out.copy()
        rank[alive] = out[alive] << np.uint64(32) | out[alive + step]
        done += step


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, seed: int = SEED,
             hot_runs: int = HOT_RUNS) -> DataFrame:
    """(doc, mark, start, stop): byte ranges to remove, overlapping, per text;
    ``doc`` and ``mark`` as :func:`_marked` gives them."""
    if not (0 < seed <= length and length < 1 << 20):
        raise ValueError("seed must lie in 1..length")

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "ctx", "doc", "mark", "run"]
        forget()
        for batch in batches:
            for b in byte_slices(batch, 2, 2 << 20):
                offsets, data = text_bytes(b.column(2))
                parts = list(_runs(offsets, data, length, seed))
                if not parts:
                    continue
                row, start, n, key, ctx = (np.concatenate(c) for c in zip(*parts, strict=True))
                doc, mark = (b.column(k).to_numpy()[row] for k in (0, 1))
                run = start << 8 | n
                stay, gone = _settled(key, ctx, doc, mark, run)
                yield _longs(names, key[stay], ctx[stay], doc[stay], mark[stay], run[stay])
                spread = _longs(names, mix64((doc[gone] ^ mark[gone]).astype(np.uint64)), ctx[gone], doc[gone], mark[gone],
                                run[gone])
                yield spread.set_column(1, "ctx", pa.nulls(len(gone), pa.int64()))

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["kind", "key", "doc", "mark", "run"]
        for t in _whole_keys(batches, _ROWS):
            told = t.filter(t.column("ctx").is_null())
            if told.num_rows:
                yield _longs(names, np.full(told.num_rows, _GONE), *(told.column(c).to_numpy() for c in names[1:]))
            t = t.filter(t.column("ctx").is_valid())
            key, ctx, doc, mark, run = (t.column(c).to_numpy() for c in ("key", "ctx", "doc", "mark", "run"))
            stay, gone = _settled(key, ctx, doc, mark, run)
            yield _longs(names, np.full(len(gone), _GONE), key[gone], doc[gone], mark[gone], run[gone])
            _, which, count = np.unique(key[stay], return_inverse=True, return_counts=True)
            count = count[which] if len(stay) else np.zeros(0, np.int64)
            stay, count = stay[count > 1], count[count > 1]
            yield _longs(names, np.where(count > hot_runs, _SINGLE, _RUN), key[stay], doc[stay], mark[stay],
                         run[stay])

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, 0, 2 << 20):
                yield from _strings(b, length)

    def doubled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc", "mark", "start", "stop"]
        for t in _whole_keys(batches, _ROWS, 4):
            told = t.filter(t.column("bytes").is_null())
            if told.num_rows:
                yield _longs(names, *(told.column(c).to_numpy() for c in ("doc", "mark")),
                             *_range(told.column("run").to_numpy(), length))
            t = t.filter(t.column("bytes").is_valid())
            if not t.num_rows:
                continue
            offsets, data = text_bytes(t.column("bytes").combine_chunks())
            doc, mark, run = (t.column(c).to_numpy() for c in ("doc", "mark", "run"))
            n = run & 255
            row = np.repeat(np.arange(len(n)), n)
            shift = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            rank = _ranked(data, length)[offsets[row] + shift]
            place = (run[row] >> 8) + shift
            by, _, gone = _earlier(rank, doc[row], mark[row], place)
            at = by[gone]
            at = at[np.lexsort((place[at], mark[row[at]], doc[row[at]]))]
            d, m, p = doc[row[at]], mark[row[at]], place[at]
            new = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (m[1:] != m[:-1]) | (p[1:] != p[:-1] + 1)]) if len(at) else at
            last = np.r_[new[1:] - 1, len(at) - 1] if len(at) else at
            yield _longs(names, d[new], m[new], p[new], p[last] + length)

    marked = _different(_marked(docs, id_col, text_col))
    runs = marked.mapInArrow(seeds, _RUNS).repartition("key").sortWithinPartitions("key")
    runs = written(runs.mapInArrow(shared, "kind long, key long, doc long, mark long, run long"), "runs")
    gone = runs.filter(F.col("kind") == _GONE).select("doc", "mark", *_range_columns(length))
    left = runs.filter(F.col("kind") != _GONE) \
        .groupBy("doc", "mark").agg(F.collect_set(F.struct("kind", "key", "run")).alias("runs"))
    marked = marked.withColumnsRenamed({"doc": "d", "mark": "m"})
    joined = marked.join(left, (F.col("d") == F.col("doc")) & (F.col("m") == F.col("mark"))) \
        .select("text", "doc", "mark", F.transform("runs", lambda r: r["kind"]).alias("kind"),
                F.transform("runs", lambda r: r["key"]).alias("key"), F.transform("runs", lambda r: r["run"]).alias("run"))
    cut = joined.mapInArrow(strings, "key long, doc long, mark long, run long, bytes binary")
    return gone.unionByName(cut.repartition("key").sortWithinPartitions("key")
                            .mapInArrow(doubled, "doc long, mark long, start long, stop long"))


def _range(run: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    start = run >> 8
    return start, start + (run & 255) - 1 + length


def _range_columns(length: int) -> list:
    start = F.shiftright("run", 8)
    return [start.alias("start"), (start + F.col("run").bitwiseAND(F.lit(255)) + F.lit(length - 1)).alias("stop")]


def _marked(docs: DataFrame, id_col: str, text_col: str, row=None) -> DataFrame:
    """(doc, mark, text): the id (a null id as the largest), a 64-bit hash of
    the text, the text (null as empty) and, where given, ``row``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"),
                       F.xxhash64(text).alias("mark"), text.alias("text"),
                       *([] if row is None else [row.alias("row")]))


def _different(marked: DataFrame) -> DataFrame:
    """One row for each (doc, mark). Only rows that share theirs move."""
    tied = written(marked.groupBy("doc", "mark").count().filter("count > 1").select("doc", "mark"), "tied")
    if tied.isEmpty():
        return marked
    ones = marked.join(tied, ["doc", "mark"], "left_semi").groupBy("doc", "mark").agg(F.first("text").alias("text"))
    return marked.join(tied, ["doc", "mark"], "left_anti").unionByName(ones)


def _strings(b: pa.RecordBatch, length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of each run; a hot one position by position, keyed by the
    whole string, equal strings of the block settled at once."""
    names = ["key", "doc", "mark", "run", "bytes"]
    offsets, data = text_bytes(b.column("text"))
    kinds = b.column("kind")
    row = np.repeat(np.arange(b.num_rows), np.diff(kinds.offsets.to_numpy()))
    kind, key, run = (b.column(c).flatten().to_numpy() for c in ("kind", "key", "run"))
    doc, mark = (b.column(c).to_numpy()[row] for c in ("doc", "mark"))
    start, n = offsets[row] + (run >> 8), run & 255
    ship = np.flatnonzero(kind == _RUN)
    hot = np.flatnonzero(kind == _SINGLE)
    raw = data.tobytes()
    if len(hot):
        which = np.repeat(hot, n[hot])
        shift = np.arange(len(which)) - np.repeat(np.cumsum(n[hot]) - n[hot], n[hot])
        at = start[which] + shift
        single = (run[which] & ~np.int64(255)) + (shift << 8) + 1
        text = [raw[i:i + length] for i in at]
        code = np.array([int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little", signed=True) for t in text])
        by, first, gone = _earlier(code, doc[which], mark[which], single)
        stay, out = by[first], by[gone]
        yield pa.RecordBatch.from_arrays([pa.array(code[stay]), pa.array(doc[which][stay]), pa.array(mark[which][stay]),
                                          pa.array(single[stay]), pa.array([text[i] for i in stay], pa.binary())], names)
        yield pa.RecordBatch.from_arrays([pa.array(code[out]), pa.array(doc[which][out]), pa.array(mark[which][out]),
                                          pa.array(single[out]), pa.nulls(len(out), pa.binary())], names)
    yield pa.RecordBatch.from_arrays(
        [pa.array(key[ship]), pa.array(doc[ship]), pa.array(mark[ship]), pa.array(run[ship]),
         pa.array([raw[s:s + k - 1 + length] for s, k in zip(start[ship], n[ship], strict=True)], pa.binary())], names)


def _cut(batches: Iterator[pa.RecordBatch], keep_text: bool) -> Iterator[pa.RecordBatch]:
    """The result rows of (doc_id, text, start, stop, row), a few MB of text at a time."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    for b in (s for batch in batches for s in byte_slices(batch, 1)):
        text = b.column(1).cast(pa.binary()).to_pylist()
        rows = []
        for t, start, stop in zip(text, b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            merged: list[list[int]] = []
            for s, e in sorted(zip(start or (), stop or (), strict=True)):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            edges = [0, *(x for m in merged for x in m), len(t)]
            kept = b"".join([t[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2)])
            rows.append((len(t), len(t) - len(kept), len(merged), hashlib.sha256(kept).hexdigest(), merged,
                         kept.decode("utf-8", "ignore") if keep_text else None))
        cols = list(zip(*rows, strict=True))
        out = [b.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())]
        if keep_text:
            out += [pa.array(cols[4], pa.list_(pa.list_(pa.int64()))), pa.array(cols[5], pa.string()), b.column(4)]
        yield pa.RecordBatch.from_arrays(out, names + (["spans", "kept_text", "row"] if keep_text else []))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   seed: int = SEED, hot_runs: int = HOT_RUNS, keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every text and, with
    ``keep_text``, the removed byte ranges (``spans``), the text that is left
    (``kept_text``; a character cut in two by a removal is dropped) and the
    whole input row (``row``)."""
    spans = written(repeated(docs, id_col, text_col, length, seed, hot_runs), "spans").groupBy("doc", "mark") \
        .agg(F.collect_list("start").alias("start"), F.collect_list("stop").alias("stop"))
    row = F.struct(*(F.col(quoted(c)) for c in docs.columns if c != text_col)) if keep_text else F.lit(None).cast("int")
    marked = _marked(docs, id_col, text_col, row).withColumnsRenamed({"doc": "d", "mark": "m"}) \
        .withColumn("doc_id", F.when(F.col("d") != _LAST, F.col("d")))
    joined = marked.join(spans, (F.col("d") == F.col("doc")) & (F.col("m") == F.col("mark")), "left") \
        .select("doc_id", "text", "start", "stop", *(["row"] if keep_text else []))

    schema = StructType().add("doc_id", "long").add("n_bytes", "long").add("n_removed", "long") \
        .add("n_spans", "long").add("kept_sha256", "string")
    if keep_text:
        schema = schema.add("spans", ArrayType(ArrayType(LongType()))).add("kept_text", "string") \
            .add("row", joined.schema["row"].dataType)
    return joined.mapInArrow(lambda batches: _cut(batches, keep_text), schema)


def op9_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Repeated strings of 100 bytes removed from all documents, one row each."""
    return remove_repeats(read_table(spark, sf_dir, "documents"))
