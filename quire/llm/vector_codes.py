"""Vector codes: product quantization by dual-tree Lloyd rounds, in integers.

Vectors become integers (``floor(4096 x)``) and are cut into equal parts; each
part position has a codebook of a few entries. A Lloyd round assigns every
part to its nearest entry and moves each entry to the floor of its parts' mean.

A block of vectors keeps one tree for each part position: parts sorted by
halves along the widest side, with the bounding box, the sum and the count of
every node. Each round builds a like tree over the entries. Both are descended
together: the bounds of the distances between two boxes rule out entry nodes
that can't be nearest to anything in a node of parts. A node with one entry
left is assigned whole by its cached sum; leaves with several left are decided
by exact integer distances (ties to the lower entry). All bounds are integers,
so pruning never changes a result.

Scale: vectors are read once into blocks, written as a table with their trees;
each round is one narrow pass over the blocks, whose partial sums Spark adds up
(entries x components rows a task). Codebooks are the only thing on the driver.
Labels are summed with partial aggregates and joined back under salts, so a
label may hold any share of the rows.

Defined cases: rows whose vector is null, empty or holds null or non-finite
components go; so do vectors of another width than that of the smallest kept
vec_id (a width that is no multiple of the parts raises ValueError). Null
vec_ids are coded but seed no entry; a repeated vec_id seeds once, by its
least vector; with fewer ids than entries the codebooks are shorter. Finite
values of any size are exact: beyond what 64 bits hold, Python's integers are
used; an error beyond a long comes out as null. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import read_table, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Rows and bytes of a block; parts of a leaf.
BLOCK_ROWS, BLOCK_BYTES, LEAF = 8192, 4 << 20, 32
#: Largest absolute component for 64-bit arithmetic, by the width of a part.
_SAFE = 1 << 60
_LIMB = 40
SALTS = 16
LONG = (1 << 63) - 1

Book = list[list[tuple[int, ...]]]  # part -> entry -> components


# --- integers ----------------------------------------------------------------------

def to_integer(x: float) -> int:
    """floor(SCALE * x), exact at any size."""
    return math.floor(x * SCALE) if abs(x) < 2.0 ** 60 else int(x) * SCALE


def _is_safe(largest: int, width: int) -> bool:
    return (2 * int(largest)) ** 2 * max(width, 1) < _SAFE


def _integers(values: np.ndarray, largest: int, width: int) -> np.ndarray:
    """As 64-bit integers where squared distances fit, else as Python's."""
    if values.dtype == object:
        return values
    return values.astype(np.int64) if _is_safe(largest, width) else values.astype(object)


# --- trees -------------------------------------------------------------------------

class Tree(NamedTuple):
    """``order`` sorts the points by leaf; level l has 2^l nodes, whose points
    are order[bounds[l][k]:bounds[l][k + 1]]."""
    order: np.ndarray
    bounds: list[np.ndarray]
    low: list[np.ndarray]
    high: list[np.ndarray]
    sums: list[np.ndarray]


def _levels(n: int, leaf: int) -> int:
    return max(0, math.ceil(math.log2(max(1, n / leaf))))


def _bounds(n: int, levels: int) -> list[np.ndarray]:
    return [(np.arange((1 << k) + 1) * n) >> k for k in range(levels + 1)]


def _sorted_by_halves(points: np.ndarray, levels: int) -> np.ndarray:
    order = np.arange(len(points))
    bounds = _bounds(len(points), levels)
    for k in range(levels):
        for a, mid, b in zip(bounds[k][:-1], bounds[k + 1][1::2], bounds[k][1:]):
            if a < mid < b:
                own = points[order[a:b]]
                side = int((own.max(0) - own.min(0)).argmax())
                order[a:b] = order[a:b][np.argsort(own[:, side], kind="stable")]
    return order


def build_tree(points: np.ndarray, leaf: int, order: np.ndarray | None = None) -> Tree:
    """Boxes and sums, of leaves first, then of the nodes above."""
    n, levels = len(points), _levels(len(points), leaf)
    if order is None:
        order = _sorted_by_halves(points, levels)
    bounds, own = _bounds(n, levels), points[order]
    starts = bounds[-1][:-1]  # n > 0 and a leaf holds a point at least, so none is empty
    low, high = np.minimum.reduceat(own, starts), np.maximum.reduceat(own, starts)
    sums = np.add.reduceat(own, starts)
    out = [(low, high, sums)]
    for _ in range(levels):
        low, high, sums = np.minimum(low[::2], low[1::2]), np.maximum(high[::2], high[1::2]), sums[::2] + sums[1::2]
        out.append((low, high, sums))
    out.reverse()
    return Tree(order, bounds, *([x[k] for x in out] for k in range(3)))


def _entry_tree(entries: np.ndarray) -> tuple[Tree, np.ndarray]:
    """A tree with one entry a leaf, and the entries' numbers by leaf. Of equal
    entries only the first can be chosen, so only it is in the tree."""
    seen: dict[tuple, int] = {}
    for k, e in enumerate(map(tuple, entries.tolist())):
        seen.setdefault(e, k)
    numbers = np.array(sorted(seen.values()))
    # A whole power of two: the last entry fills up (it is one more leaf of its own number).
    full = np.r_[numbers, np.full((1 << _levels(len(numbers), 1)) - len(numbers), numbers[-1])]
    tree = build_tree(entries[full], 1)
    return tree, full[tree.order]


def _gaps(low: np.ndarray, high: np.ndarray, elow: np.ndarray, ehigh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance between each two boxes."""
    a = elow[None] - high[:, None]
    b = low[:, None] - ehigh[None]
    near = np.maximum(np.maximum(a, b), 0)
    far = np.maximum(-a, -b)
    return (near * near).sum(2), (far * far).sum(2)


def nearest(tree: Tree, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry of each point in tree order, sums and counts of each entry).
    ``points`` are in tree order."""
    n, k, width = len(points), len(entries), points.shape[1]
    label = np.zeros(n, np.int64)
    sums = np.zeros((k, width), points.dtype)
    counts = np.zeros(k, np.int64)
    etree, numbers = _entry_tree(entries)
    deepest = len(etree.bounds) - 1
    nodes, open_ = np.zeros(1, np.int64), np.ones((1, 1), bool)
    level = elevel = 0
    while len(nodes):
        near, far = _gaps(tree.low[level][nodes], tree.high[level][nodes], etree.low[elevel], etree.high[elevel])
        top = far.max() + 1
        open_ &= near <= np.where(open_, far, top).min(1)[:, None]
        if elevel == deepest:
            # Doubles of the filling entry count as one.
            first = np.unique(numbers, return_index=True)[1]
            single = open_[:, first].sum(1) == 1
            if single.any():
                which = numbers[first][open_[single][:, first].argmax(1)]
                np.add.at(sums, which, tree.sums[level][nodes[single]])
                a, b = tree.bounds[level][nodes[single]], tree.bounds[level][nodes[single] + 1]
                np.add.at(counts, which, b - a)
                for x, y, e in zip(a.tolist(), b.tolist(), which.tolist()):
                    label[x:y] = e
            nodes, open_ = nodes[~single], open_[~single]
            if level == len(tree.bounds) - 1:
                break
        if elevel < deepest:
            elevel += 1
            open_ = np.repeat(open_, 2, axis=1)
        if level < len(tree.bounds) - 1:
            level += 1
            nodes, open_ = np.c_[2 * nodes, 2 * nodes + 1].reshape(-1), np.repeat(open_, 2, axis=0)
    for a, b in zip(tree.bounds[-1][nodes].tolist(), tree.bounds[-1][nodes + 1].tolist()):
        own = points[a:b]
        gap = own[:, None] - entries[None]
        which = (gap * gap).sum(2).argmin(1)
        label[a:b] = which
        np.add.at(sums, which, own)
        np.add.at(counts, which, 1)
    return label, sums, counts


# --- blocks -----------------------------------------------------------------------

BLOCK = ("rows int, ids array<long>, width int, kind string, largest string, "
         "parts array<struct<order: binary, points: binary>>")


def _kept(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    v = F.col(vector_col).cast("array<double>")
    inf = F.lit(float("inf"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"), F.col(label_col).alias("label"))
    return rows.filter((F.size("v") > 0) & (F.array_max("v") < inf) & (F.array_min("v") > -inf)
                       & (F.size(F.array_compact("v")) == F.size("v")))


def _block(batch: pa.RecordBatch, parts: int) -> dict:
    n = batch.num_rows
    values = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
    largest = float(np.abs(values).max())
    kind = "i4" if largest * SCALE < 2 ** 31 - 1 else "f8"
    stored = np.floor(values * SCALE).astype(np.int32) if kind == "i4" else values
    width = values.shape[1] // parts
    out = []
    for p in range(parts):
        points = stored[:, p * width:(p + 1) * width]
        order = _sorted_by_halves(points, _levels(n, LEAF))
        out.append({"order": order.astype(np.int32).tobytes(), "points": np.ascontiguousarray(points[order]).tobytes()})
    return {"rows": n, "ids": batch.column(0).to_pylist(), "width": width, "kind": kind,
            "largest": str(to_integer(largest) + 1), "parts": out}


def blocks(kept: DataFrame, parts: int, dim: int) -> DataFrame:
    """Blocks of vectors with their labels, parts in tree order."""
    label = kept.schema["label"].dataType
    schema = T.StructType([*T._parse_datatype_string(BLOCK).fields, T.StructField("labels", T.ArrayType(label))])
    rows = max(LEAF, min(BLOCK_ROWS, BLOCK_BYTES // (8 * dim)))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema, prefers_large_types=False)
        for batch in batches:
            for k in range(0, batch.num_rows, rows):
                part = batch.slice(k, rows)
                made = _block(part, parts)
                columns = [pa.array([made[f.name]], f.type) for f in arrow if f.name != "labels"]
                columns.append(pa.array([part.column(2).to_pylist()], arrow.field("labels").type))
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return written(kept.select("vec_id", "v", "label").mapInArrow(build, schema), "vector-blocks")


def _read_block(row: dict, book: Book) -> Iterator[tuple[Tree, np.ndarray, np.ndarray]]:
    """(tree, points in tree order, entries) of each part of a block."""
    n, width = row["rows"], row["width"]
    for stored, entries in zip(row["parts"], book):
        order = np.frombuffer(stored["order"], np.int32)
        points = np.frombuffer(stored["points"], np.int32 if row["kind"] == "i4" else np.float64).reshape(n, width)
        largest = max(int(row["largest"]), max(abs(x) for e in entries for x in e))
        if row["kind"] == "f8":
            points = np.array([to_integer(x) for x in points.ravel().tolist()], object).reshape(n, width)
        safe = _is_safe(largest, width)
        points = points.astype(np.int64) if safe else points.astype(object)
        yield (build_tree(points, LEAF, np.arange(n))._replace(order=order), points,
               np.array(entries, np.int64 if safe else object).reshape(-1, width))


def _limbs(x: int) -> Iterator[tuple[int, int]]:
    """(place, digit) in base 2^_LIMB, the last digit signed: Spark adds them up as longs."""
    place = 0
    while not -(1 << _LIMB) < x < 1 << _LIMB:
        x, digit = divmod(x, 1 << _LIMB)
        yield place, digit
        place += 1
    yield place, x


def moved(table: DataFrame, book: Book) -> Book:
    """The codebooks after one round over all blocks."""
    width = len(book[0][0])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                out = []
                for p, (tree, points, entries) in enumerate(_read_block(row, book)):
                    _, total, counts = nearest(tree, points, entries)
                    for e in np.flatnonzero(counts).tolist():
                        out.append((p, e, -1, 0, int(counts[e])))
                        out.extend((p, e, c, place, digit) for c in range(width) for place, digit in _limbs(int(total[e, c])))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)],
                                                 ["part", "entry", "component", "place", "x"])

    rows = table.select("rows", "width", "kind", "largest", "parts") \
        .mapInArrow(sums, "part long, entry long, component long, place long, x long") \
        .groupBy("part", "entry", "component", "place").agg(F.sum("x").alias("x")).collect()
    total: dict[tuple[int, int, int], int] = {}
    for r in rows:
        key = (r["part"], r["entry"], r["component"])
        total[key] = total.get(key, 0) + (r["x"] << (_LIMB * r["place"]))
    return [[tuple(total[p, e, c] // total[p, e, -1] for c in range(width)) if (p, e, -1) in total else entry
             for e, entry in enumerate(entries)] for p, entries in enumerate(book)]


def first_book(kept: DataFrame, parts: int, entries: int) -> tuple[Book, int]:
    """Codebooks of the smallest ids, and the vectors' dimension."""
    ids = kept.filter("vec_id is not null").select("vec_id").distinct().orderBy("vec_id").limit(entries)
    ids = [r[0] for r in ids.collect()]
    if ids:
        seeds = kept.filter(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("v").alias("v")).orderBy("vec_id").collect()
    else:
        seeds = kept.agg(F.min("v").alias("v")).filter("v is not null").collect()
    if not seeds:
        return [], 0
    dim = len(seeds[0]["v"])
    if dim % parts:
        raise ValueError(f"{dim} components can't be cut into {parts} equal parts")
    vectors = [[to_integer(x) for x in s["v"]] for s in seeds if len(s["v"]) == dim]
    width = dim // parts
    return [[tuple(v[p * width:(p + 1) * width]) for v in vectors] for p in range(parts)], dim


def codes(table: DataFrame, book: Book) -> DataFrame:
    """vec_id, label, code (bytes) and error of every vector."""
    label = table.schema["labels"].dataType.elementType
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", label),
                           T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, labels in zip(batch.to_pylist(), batch.column(batch.schema.get_field_index("labels"))):
                n = row["rows"]
                code, error = np.zeros((n, len(book)), np.uint8), np.zeros(n, object)
                for p, (tree, points, entries) in enumerate(_read_block(row, book)):
                    which, _, _ = nearest(tree, points, entries)
                    gap = points - entries[which]
                    code[tree.order, p] = which
                    error[tree.order] += (gap * gap).sum(1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), labels.values, pa.array([c.tobytes() for c in code], pa.binary()),
                     pa.array([int(e) if e <= LONG else None for e in error], pa.int64())],
                    ["vec_id", "label", "code", "error"])

    return table.mapInArrow(assign, schema)


def train(table: DataFrame, book: Book, rounds: int = ROUNDS) -> Book:
    for _ in range(rounds):
        book = moved(table, book)
    return book


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Book]:
    """(vec_id, label, code, error) of every kept vector, and the codebooks."""
    kept = _kept(vectors, id_col, vector_col, label_col)
    book, dim = first_book(kept, parts, entries)
    if not book:
        label = kept.schema["label"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"vec_id long, label {label}, code binary, error long"), book
    table = blocks(kept.filter(F.size("v") == dim), parts, dim)
    book = train(table, book, rounds)
    return codes(table, book), book


def book_sha256(book: Book) -> str:
    return hashlib.sha256(",".join(str(x) for entries in book for e in entries for x in e).encode()).hexdigest()


def op11_vector_codes(spark, sf_dir: str) -> DataFrame:
    """Codes of every vector of ``embeddings``."""
    coded, book = compress(read_table(spark, sf_dir, "embeddings"))
    coded = written(coded, "vector-codes")
    total = coded.groupBy("label").agg(F.sum("error").alias("label_error")) \
        .select(F.col("label").alias("of_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of_salt"))
    salted = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
    joined = salted.join(total, F.col("label").eqNullSafe(F.col("of_label")) & (F.col("salt") == F.col("of_salt")))
    return joined.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
                         F.lit(book_sha256(book)).alias("codebooks_sha256"))


def _sql(parts: int, entries: int, rounds: int) -> str:
    """The rounds as one CTE each."""
    def assigned(k: int) -> str:
        return f"""a{k} AS (SELECT part, rid, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
  SELECT x.part, x.rid, b.entry, sum((x.x - b.x) * (x.x - b.x)) AS d
  FROM x JOIN b{k} b ON b.part = x.part AND b.c = x.c GROUP BY x.part, x.rid, b.entry) GROUP BY part, rid)"""

    def moved_book(k: int) -> str:
        return f"""b{k + 1} AS (SELECT b.part, b.entry, b.c, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN (
  SELECT x.part, a.entry, x.c, CAST(floor(sum(x.x)::DOUBLE / count(*)) AS BIGINT) AS x
  FROM x JOIN a{k} a USING (part, rid) GROUP BY x.part, a.entry, x.c) m USING (part, entry, c))"""

    steps = ",\n".join(f"{assigned(k)},\n{moved_book(k)}" for k in range(rounds))
    return f"""WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS rid, vec_id, label, embedding, len(embedding) // {parts} AS w FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
x AS (SELECT rid, (i - 1) // w AS part, (i - 1) % w AS c, CAST(floor({SCALE} * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
      FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM kept)),
b0 AS (SELECT part, rid - 1 AS entry, c, x FROM x WHERE rid <= {entries}),
{steps},
{assigned(rounds)},
coded AS (SELECT rid, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
          FROM a{rounds} GROUP BY rid),
book AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, c)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (rid), book"""


SQL = _sql(PARTS, ENTRIES, ROUNDS)
