"""Jaccard similarity join on word shingles with adaptive multi-match prefixes.

A document's set holds its distinct five-word shingles (as 64-bit hashes).
Two sets link when their intersection is at least ``percent`` of their union.
All sets are ordered alike, rare shingles first. A set of n shingles whose
overlap must reach ``a = ceil(percent * n)`` has an l-prefix of ``n - a + l``
shingles, and two linked sets share at least l shingles of their l-prefixes.
Each document chooses its own l: a longer prefix costs rows but asks for more
shared shingles, which pays where frequent shingles promise many candidates.
A pair is compared when it shares as many prefix shingles, of levels up to the
smaller l, as the smaller l.

Groups of near copies are not paired off. Equal sets are one node. Each
shingle's posting list, cut into bands of sizes that may be linked, has a
pivot, its smallest node; a pivot's group holds the nodes of all its lists,
and any two nodes that share a prefix shingle and may be linked meet in a
group. A group is dealt into blocks, and a task compares two blocks by
products of incidence matrices: first of the prefix shingles that were written
already, against l, which leaves the nodes that have a candidate; only their
texts are sent, and whole sets compared. A task returns a spanning forest of
the links it found: rows grow with the nodes of a group, not with its pairs.
A candidate must also be able to reach the overlap that the two sizes ask
for: what the prefixes share, plus the longer of the rests outside them (all
shared shingles of one of the two prefixes lie in the other, too).

Scale: texts are read in two passes that send only prefixes; shingles found in
one document leave at once. Blocks are bounded in nodes and in shingles. Frequencies that order the sets are counted in
blocks of rows over all data; the ``ORDERED`` most frequent shingles are
broadcast (the order steers cost, never results).

Defined cases: null, empty or blank texts have no shingles and link with
nothing; with fewer than five words the whole sequence is the one shingle;
equal non-empty sets link; repeated rows are equal sets; a null id links but
names a component only where no other id is in it; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, left_rows, mix64, read_table, text_bytes, window_hash, written
from .components import components
from .embedding_dedup import _forest

WORDS = 5
PERCENT = 80
#: Most frequent shingles that come last in the order of every set.
ORDERED = 100_000
#: Times that a shingle occurs in a block of documents to be reported, and shingles of a block.
SEEN, BLOCK = 4, 2_000_000
#: Prefix lengths to choose from, and the cost of a candidate in prefix rows.
LEVELS, CANDIDATE = (1, 2, 3, 4, 6, 8), 4.0
#: Nodes and shingles of a block in a pivot's group; columns of an incidence matrix.
BLOCK_NODES, BLOCK_SHINGLES, _COLUMNS = 1024, 1_000_000, 1024
#: Bytes of text that a pass holds in arrays at once.
SLICE = 1 << 20
_BASE, _WORD_BASE = 0xD1342543DE82EF95, 0x9E3779B97F4A7C15
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_CODE = mix64(np.where((np.arange(256) >= 65) & (np.arange(256) < 91), np.arange(256) + 32, np.arange(256))
              .astype(np.uint64) * np.uint64(0xA24BAED4963EE407) + np.uint64(77))


def _word_hashes(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word, in order."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    solid = ~_BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets[:-1]] = True
    start = np.flatnonzero(solid & (edge[:-1] | ~np.r_[False, solid[:-1]]))
    stop = np.flatnonzero(solid & (edge[1:] | ~np.r_[solid[1:], False] | (np.arange(1, len(data) + 1) == len(data)))) + 1
    power = np.full(len(data), np.uint64(_WORD_BASE))
    power[0] = 1
    power = np.multiply.accumulate(power)
    total = np.r_[np.uint64(0), np.cumsum(_CODE[data] * power, dtype=np.uint64)]
    # The sum over a word, as if it began the data: times base^(last - start), a power instead of an inverse.
    h = (total[stop] - total[start]) * power[len(data) - 1 - start]
    shift = np.uint64(pow(pow(_WORD_BASE, -1, 1 << 64), len(data) - 1, 1 << 64))
    return mix64(h * shift + (stop - start).astype(np.uint64)), np.searchsorted(offsets, start, "right") - 1


def shingle_sets(offsets: np.ndarray, data: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(row, shingle) sorted by row and shingle, distinct."""
    h, row = _word_hashes(offsets, data)
    n = np.bincount(row, minlength=len(offsets) - 1)
    first = np.cumsum(n) - n
    grams = mix64(window_hash(h, words, _BASE)) if len(h) >= words else np.zeros(0, np.uint64)
    inside = np.flatnonzero(row[:len(grams)] == row[words - 1:]) if len(grams) else np.zeros(0, np.int64)
    short = np.flatnonzero((n > 0) & (n < words))
    whole = [int(mix64(window_hash(h[first[r]:first[r] + n[r]], int(n[r]), _BASE) + np.uint64(n[r]))[0]) for r in short]
    rows, sets = np.r_[row[inside], short], np.r_[grams[inside], np.array(whole, np.uint64)]
    by = np.lexsort((sets, rows))
    rows, sets = rows[by], sets[by]
    keep = np.r_[True, (rows[1:] != rows[:-1]) | (sets[1:] != sets[:-1])] if len(rows) else np.zeros(0, bool)
    return rows[keep], sets[keep]


def _sizes(rows: np.ndarray, sets: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of shingles, node) of every row; a node is a hash of the set."""
    n = np.bincount(rows, minlength=n_rows)
    ends = np.cumsum(n)
    total = np.r_[np.uint64(0), np.cumsum(mix64(sets ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)]
    return n, mix64((total[ends] - total[ends - n]) * np.uint64(3) + n.astype(np.uint64)).view(np.int64)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _needed(n: np.ndarray, percent: int) -> np.ndarray:
    return -(-n * percent // 100)


def _prefixes(rows: np.ndarray, sets: np.ndarray, n: np.ndarray, often: np.ndarray, count: np.ndarray, percent: int) \
        -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, level, l) of every set's prefix."""
    at = np.searchsorted(often, sets)
    at[at == len(often)] = 0
    known = often[at] == sets if len(often) else np.zeros(len(sets), bool)
    df = np.where(known, count[at] if len(often) else 0, 0)
    by = np.lexsort((sets, df, rows))
    rows, sets, df = rows[by], sets[by], df[by]
    start = np.cumsum(n) - n
    place = np.arange(len(rows)) - start[rows]
    total = np.r_[0.0, np.cumsum(df, dtype=np.float64)]
    needed = _needed(n, percent)
    base = np.where(n > 0, n - needed + 1, 0)
    best, chosen = np.full(len(n), np.inf), np.ones(len(n), np.int64)
    for level in LEVELS:
        size = np.minimum(base + level - 1, n)
        cost = size + CANDIDATE * (total[start + size] - total[start]) / level ** 2
        better = (level <= np.maximum(needed, 1)) & (cost < best - 1e-9)
        best[better], chosen[better] = cost[better], level
    keep = place < (base + chosen - 1)[rows]
    level = np.maximum(1, place - base[rows] + 2)
    return rows[keep], sets[keep], level[keep], chosen[rows[keep]]


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
           percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    measured, placed = _placed(_rows(docs, id_col, text_col), words, percent)
    low = measured.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("low"))
    named = low.join(placed, "node")
    names = named.groupBy("component").agg(F.min("low").alias("name"))
    named = named.join(names, "component").select("node", "name")
    rows = measured.filter("shingle is null").select("doc_id", F.col("n").alias("n_shingles"), "node")
    return rows.filter("n_shingles > 0").join(named, "node").select("doc_id", "n_shingles", F.col("name").alias("component_id")) \
        .unionByName(rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def _placed(source: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, mark, n, node, shingle) of every row, and of some shingles
    without a node; (node, component) of every set that isn't empty."""
    spark = source.sparkSession

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "mark", "n", "node", "shingle"]
        held, size = [], 0

        def frequent() -> pa.RecordBatch:
            value, times = np.unique(np.concatenate(held), return_counts=True)
            value, times = value[times >= SEEN], times[times >= SEEN]
            none = pa.nulls(len(value), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, pa.array(times.astype(np.int64)), none,
                                               pa.array(value.view(np.int64))], names)

        for batch in batches:
            for b in byte_slices(batch, 2, SLICE):
                rows, sets = shingle_sets(*text_bytes(b.column(2)), words)
                n, node = _sizes(rows, sets, b.num_rows)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n.astype(np.int64)), pa.array(node),
                                                  pa.nulls(b.num_rows, pa.int64())], names)
                once = np.zeros(b.num_rows, bool)
                once[np.unique(node, return_index=True)[1]] = True  # a set counts once a slice
                held.append(sets[once[rows]])
                size += len(held[-1])
                if size >= BLOCK:
                    yield frequent()
                    held, size = [], 0
        if held:
            yield frequent()

    measured = written(source.mapInArrow(measure, "doc_id long, mark long, n long, node long, shingle long"), "measured")
    often = measured.filter("shingle is not null").groupBy("shingle").agg(F.sum("n").alias("n")) \
        .orderBy(F.desc("n"), "shingle").limit(ORDERED).collect()
    value = np.array([r["shingle"] for r in often], np.int64).view(np.uint64)
    by = np.argsort(value)
    shared = spark.sparkContext.broadcast((value[by], np.array([r["n"] for r in often], np.int64)[by]))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, 2, SLICE):
                rows, sets = shingle_sets(*text_bytes(b.column(2)), words)
                n, node = _sizes(rows, sets, b.num_rows)
                once = np.zeros(b.num_rows, bool)
                once[np.unique(node, return_index=True)[1]] = True
                rows, sets = rows[once[rows]], sets[once[rows]]
                row, shingle, level, chosen = _prefixes(rows, sets, np.where(once, n, 0), *shared.value, percent)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shingle.view(np.int64)), pa.array(node[row]), pa.array(n[row] << 16 | level << 8 | chosen)],
                    ["shingle", "node", "info"])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (sorted by shingle and node) of shingles that several nodes
        hold, once a node. One row is carried from batch to batch: the last
        node's first, with whether it has met another node yet."""
        carried, met_already = None, False
        for b in batches:
            columns = [b.column(k).to_numpy() for k in range(3)]
            if not len(columns[0]):
                continue
            if carried is not None:
                columns = [np.r_[c, x] for c, x in zip(carried, columns, strict=True)]
            shingle, node, _ = columns
            first = np.flatnonzero(np.r_[True, (shingle[1:] != shingle[:-1]) | (node[1:] != node[:-1])])
            same = shingle[first][1:] == shingle[first][:-1]  # neighbours that share the shingle
            meets = np.r_[met_already, same] | np.r_[same, False]
            sent = first[:-1][meets[:-1]]
            yield pa.RecordBatch.from_arrays([pa.array(c[sent]) for c in columns], ["shingle", "node", "info"])
            carried, met_already = [c[first[-1]:first[-1] + 1] for c in columns], bool(meets[-1])
        if met_already:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in carried], ["shingle", "node", "info"])

    schema = "shingle long, node long, info long"
    live = written(source.mapInArrow(prefixes, schema).repartition("shingle").sortWithinPartitions("shingle", "node")
                   .mapInArrow(met, schema), "postings")

    # Linked sets differ in size by at most 100 / percent: with bands of that ratio,
    # each node at home in one and a guest of the next, they meet in a band. The
    # pivot of a list and band is its smallest node, and any two nodes that share a
    # shingle and may be linked meet in the group of a pivot.
    ratio = float(np.log(100 / percent)) * 1.0001 if percent < 100 else 1e-9
    band = F.floor(F.log(F.shiftright("info", 16)) / ratio)
    banded = live.select("shingle", "node", F.shiftright("info", 16).alias("n"), band.alias("home")) \
        .select("shingle", "node", "n", "home", F.explode(F.array(F.col("home"), F.col("home") + 1)).alias("band"))
    pivots = banded.groupBy("shingle", "band").agg(F.min("node").alias("pivot"), F.max("node").alias("last"),
                                                   F.max("home").alias("top")) \
        .filter("pivot < last and top = band").select("shingle", "band", "pivot")
    groups = written(banded.join(pivots, ["shingle", "band"])
                     .select(F.xxhash64("pivot", "band").alias("pivot"), "node", "n").distinct(), "groups")
    posts = live.groupBy("node").agg(F.collect_list(F.struct("shingle", "info")).alias("posts"))
    tasks = written(_with_candidates(groups, posts, percent), "tasks")
    # The text of each node that has a candidate: that of its first row.
    firsts = measured.filter("n > 0").groupBy("node").agg(F.min(F.struct("doc_id", "mark")).alias("row"))
    wanted = firsts.join(tasks.select("node").distinct(), "node") \
        .select("node", F.col("row.doc_id").alias("d"), F.col("row.mark").alias("m"))
    nodes = _packed_rows(source).join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m"))) \
        .select("node", "text")
    if not measured.filter("n > 0").groupBy("doc_id", "mark").count().filter("count > 1").isEmpty():
        nodes = nodes.dropDuplicates(["node"])  # only repeated rows give a node twice
    nodes = written(nodes, "nodes")
    tree = components(_linked_in_groups(tasks, nodes, words, percent), "a", "b")

    return measured, firsts.select("node").join(tree, "node", "left") \
        .select("node", F.coalesce("component", "node").alias("component"))


def _pack(text: str) -> bytes:
    data = (text or "").encode()
    return len(data).to_bytes(8, "little") + pa.Codec("zstd", compression_level=3).compress(data, asbytes=True)


def _unpacked(column: pa.Array) -> pa.Array:
    codec = pa.Codec("zstd")
    return pa.array([codec.decompress(b[8:], int.from_bytes(b[:8], "little"), asbytes=True) if b[:8].strip(b"\0") else b""
                     for b in column.to_pylist()], pa.large_binary())


def _packed_rows(source: DataFrame) -> DataFrame:
    """(doc_id, mark, text) with the text compressed: it is shuffled several times."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, 2):
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1),
                                                  pa.array([_pack(t) for t in b.column(2).to_pylist()], pa.binary())],
                                                 ["doc_id", "mark", "text"])

    return source.mapInArrow(run, "doc_id long, mark long, text binary")


def _with_candidates(groups: DataFrame, posts: DataFrame, percent: int) -> DataFrame:
    """(pivot, lo, hi, second, node): the nodes of each task (two blocks of a
    group, or one with itself) that share enough prefix shingles with another
    one there. Only prefixes travel, no text."""
    blocks = groups.groupBy("pivot").agg(F.greatest(F.ceil(F.count("*") / BLOCK_NODES), F.ceil(F.sum("n") / BLOCK_SHINGLES))
                                         .cast("int").alias("blocks"))
    code = F.pmod(F.xxhash64("node", "pivot"), "blocks").cast("int")
    dealt = groups.join(blocks, "pivot").withColumn("own", code).select(
        "pivot", "node", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("pivot", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                         (F.col("own") > F.col("other")).alias("second"), "node")
    rows = dealt.join(posts, "node").select("pivot", "lo", "hi", "second", "node", "posts")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_tasks(batches):
            kept = _candidates(part, part.column("lo")[0].as_py() == part.column("hi")[0].as_py(), percent)
            yield from part.select(["pivot", "lo", "hi", "second", "node"]).take(kept).to_batches()

    return rows.repartition("pivot", "lo", "hi").sortWithinPartitions("pivot", "lo", "hi", "node") \
        .mapInArrow(compare, "pivot long, lo int, hi int, second boolean, node long")


def _linked_in_groups(tasks: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): links that connect what the links of each pivot's group connect:
    a spanning forest of each task, at most a row for each node."""
    rows = tasks.join(nodes, "node").select("pivot", "lo", "hi", "second", "node", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_tasks(batches):
            lo, hi = part.column("lo")[0].as_py(), part.column("hi")[0].as_py()
            a, b = _links(part, lo == hi, words, percent)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return written(rows.repartition("pivot", "lo", "hi").sortWithinPartitions("pivot", "lo", "hi", "node")
                   .mapInArrow(compare, "a long, b long").distinct(), "links")


def _whole_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (pivot, lo, hi), from sorted batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        keys = np.stack([b.column(k).to_numpy().astype(np.int64) for k in range(3)], axis=1)
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        for s, e in zip(starts, [*starts[1:], b.num_rows], strict=True):
            key = tuple(keys[s])
            if held and key != last:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(b.slice(s, e - s))
            last = key
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _shared_counts(row: np.ndarray, value: np.ndarray, n: int, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """How many values each of ``rows`` has in common with each of ``cols``."""
    _, column, times = np.unique(value, return_inverse=True, return_counts=True)
    often = times[column] > 1
    row, column = row[often], np.unique(column[often], return_inverse=True)[1]
    out = np.zeros((len(rows), len(cols)), np.float32)
    by = np.argsort(column, kind="stable")
    row, column = row[by], column[by]
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        here = slice(*np.searchsorted(column, [start, start + _COLUMNS]))
        m = np.zeros((n, _COLUMNS), np.float32)
        m[row[here], column[here] - start] = 1
        out += m[rows] @ m[cols].T
    return out


def _sides(part: pa.Table, alone: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nodes, rows, columns) of a task."""
    node, second = part.column("node").to_numpy(), part.column("second").to_numpy().astype(bool)
    every = np.arange(len(node))
    return node, every if alone else np.flatnonzero(~second), every if alone else np.flatnonzero(second)


def _of_sizes(n: np.ndarray, node: np.ndarray, rows: np.ndarray, cols: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of two nodes whose sizes allow a link."""
    small, large = np.minimum(n[rows][:, None], n[cols][None, :]), np.maximum(n[rows][:, None], n[cols][None, :])
    return (100 * small >= percent * large) & (node[rows][:, None] != node[cols][None, :])


def _candidates(part: pa.Table, alone: bool, percent: int) -> np.ndarray:
    """Places of the nodes that share, with another one of the task, as many
    prefix shingles (of levels up to it) as the smaller l of the two, and
    enough in all prefixes to reach the overlap of a link."""
    node, rows, cols = _sides(part, alone)
    posts = part.column("posts").combine_chunks()
    posts = posts.chunk(0) if isinstance(posts, pa.ChunkedArray) else posts
    row = np.repeat(np.arange(len(node)), posts.value_lengths().to_numpy())
    value, info = (posts.flatten().field(k).to_numpy() for k in range(2))
    level, chosen = (info >> 8) & 255, info & 255
    n, least = np.ones(len(node), np.int64), np.ones(len(node), np.int64)
    n[row], least[row] = info >> 16, chosen
    need = np.minimum(least[rows][:, None], least[cols][None, :])
    open_ = np.zeros(need.shape, bool)
    for l in np.unique(need):
        use = level <= l
        open_ |= (need == l) & (_shared_counts(row[use], value[use], len(node), rows, cols) >= l)
    open_ &= _of_sizes(n, node, rows, cols, percent)
    if open_.any():
        rest = np.maximum(0, _needed(n, percent) - least)
        asked = -(-percent * (n[rows][:, None] + n[cols][None, :]) // (100 + percent))
        asked -= np.maximum(rest[rows][:, None], rest[cols][None, :])
        open_ &= _shared_counts(row, value, len(node), rows, cols) >= asked
    return np.unique(np.r_[rows[open_.any(axis=1)], cols[open_.any(axis=0)]])


def _links(part: pa.Table, alone: bool, words: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among the nodes of one task, by whole sets."""
    node, rows, cols = _sides(part, alone)
    slices = [b for whole in part.to_batches() for b in byte_slices(whole, 5, SLICE)]
    found = [shingle_sets(*text_bytes(_unpacked(b.column(5))), words) for b in slices]
    sizes = [b.num_rows for b in slices]
    row = np.concatenate([r + s for (r, _), s in zip(found, np.cumsum([0, *sizes]), strict=False)])
    sets = np.concatenate([x for _, x in found])
    n = np.bincount(row, minlength=len(node))
    open_ = _of_sizes(n, node, rows, cols, percent)
    both = _shared_counts(row, sets, len(node), rows, cols).astype(np.int64)
    open_ &= 100 * both >= percent * (n[rows][:, None] + n[cols][None, :] - both)
    a, b = np.nonzero(open_)
    if not len(a):
        return node[:0], node[:0]
    root = _forest(np.stack([rows[a], cols[b]], axis=1), len(node))
    moved = np.flatnonzero(root != np.arange(len(node)))
    return node[moved], node[root[moved]]


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id;
    of several texts under that id the one of the smallest mark, of repeated
    rows any. Rows are told apart by id and mark, so a row that goes takes no
    other text of its id (or null) along."""
    measured, placed = _placed(_rows(docs, id_col, text_col), WORDS, PERCENT)
    mine = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")
    lows = measured.filter("n > 0").groupBy("node").agg(F.min(mine).alias("low")).join(placed, "node")
    keeps = lows.groupBy("component").agg(F.min("low").alias("keep"))
    keeps = lows.join(keeps, "component").select("node", "keep")
    found = measured.filter("n > 0").groupBy("node", "doc_id", "mark").agg(F.count("*").alias("times")).join(keeps, "node") \
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("mark") == F.col("keep.mark")))
    found = written(found.filter("times > 1 or not kept").select("doc_id", "mark", "kept"), "decisions")
    return left_rows(docs, id_col, text_col, F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))),
                     found.filter(~F.col("kept")).select("doc_id", "mark"), found.filter("kept").select("doc_id", "mark"))


def op8_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """Components of all documents whose shingle sets are similar, one row each."""
    return linked(read_table(spark, sf_dir, "documents"))
