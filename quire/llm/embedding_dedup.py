"""Near-duplicate vectors: spherical k-means cells, blocked cosine products.

Equal vectors are grouped first. Centres come from spherical k-means on a
bounded sample; every vector then has a home cell, the centre of the highest
cosine, and is a guest of each other cell whose border it stands near: a
linked pair differs by at most ``sqrt(2 - 2 * threshold)``, so of a pair
across a border one end lies within half of that, and no link is missed,
whatever the dimension. Home rows are compared
with all rows of their cell by matrix products in double precision. A link
seen from one side only is credited to the other end, so counts are those of
the links found. One vector of each component is kept, the smallest id.

Scale: a cell is dealt into blocks of ``BLOCK`` home rows by ``BLOCK`` rows; a
hot cell is many tasks, and a task returns counts and a spanning forest of
its links, never all pairs. Components come from Spark joins.

Defined cases: null, empty, zero or non-finite vectors, and vectors with null
components, link with nothing; vectors of different dimensions don't link;
equal vectors link, and a repeated row counts as another vector; different
vectors under one id are one node whose links are counted together; null ids
link but name no component unless alone; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read_table, written
from .components import components

THRESHOLD = 0.9
#: Vectors that k-means is fitted on, at most (the lowest hashes).
FIT_ROWS = 16_384
#: Vectors of a cell, on average, and the most cells.
CELL_ROWS, MOST_CELLS = 1024, 4096
BLOCK = 2048
_STEP = 256  # home rows of one product


def centres(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Spherical k-means of unit rows; empty cells keep their centre."""
    rng = np.random.default_rng(seed)
    c = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)]
    for _ in range(rounds):
        home = (sample @ c.T).argmax(axis=1)
        total = np.zeros_like(c)
        np.add.at(total, home, sample)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(size > 0, total / np.where(size > 0, size, 1), c)
    return c


def _unit(vectors: list) -> np.ndarray:
    """Rows of length one. Where squares would leave the range of a double the
    row is first divided by its largest component."""
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    with np.errstate(over="ignore"):
        size = np.linalg.norm(x, axis=1)
    odd = np.flatnonzero((size < 1e-140) | (size > 1e140))
    if len(odd):
        x[odd] /= np.abs(x[odd]).max(axis=1, keepdims=True)
        size[odd] = np.linalg.norm(x[odd], axis=1)
    return x / size[:, None]


def guests(x: np.ndarray, c: np.ndarray, margin: float) -> tuple[np.ndarray, np.ndarray]:
    """(home cell, whether each row belongs to each cell as home or guest)."""
    near = x @ c.T
    home = near.argmax(axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * (c @ c.T), 0))
    return home, near[np.arange(len(x)), home][:, None] - near <= margin * apart[home]


def _forest(pairs: np.ndarray, n: int) -> np.ndarray:
    """Links (smallest, other) that connect what the pairs connect."""
    root = np.arange(n)
    while len(pairs):
        a, b = root[pairs[:, 0]], root[pairs[:, 1]]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (up := root[root] != root).any():
            root[up] = root[root[up]]
        pairs = pairs[root[pairs[:, 0]] != root[pairs[:, 1]]]
    return root


def near_duplicates(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS, cell_rows: int = CELL_ROWS,
                    block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    spark = rows.sparkSession
    v = F.col("v")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")) \
        .withColumn("valid", F.coalesce((F.size(v) > 0) & finite & F.exists("v", lambda x: x != 0), F.lit(False)))
    # One row for each different vector: its smallest id and its number of rows.
    groups = written(rows.filter("valid").groupBy("v").agg(F.min("vec_id").alias("low"), F.count("*").alias("n"))
                     .withColumn("id", F.coalesce("low", F.xxhash64("v").bitwiseOR(F.lit(-1 << 62))))
                     .withColumn("dim", F.size("v")), "vectors")
    out = []
    for dim, n in sorted((r["dim"], r["count"]) for r in groups.groupBy("dim").count().collect()):
        same = groups.filter(F.col("dim") == dim)
        sample = same.orderBy(F.xxhash64("v"), "id").limit(fit_rows).select("v").collect()
        c = centres(_unit([r[0] for r in sample]), max(1, min(MOST_CELLS, n // cell_rows, len(sample) // 8)))
        out.append(_linked(spark, same, c, threshold, float(np.sqrt(2 - 2 * threshold)) / 2 + 1e-9, block))
    if not out:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    found = written(found, "compared")
    counts = found.filter("other is null").groupBy("id").agg(F.sum("n").alias("links"))
    tree = components(found.filter("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    classed = groups.join(counts, "id", "left").join(tree.withColumnRenamed("node", "id"), "id", "left") \
        .withColumn("component", F.coalesce("component", "low"))
    # A component whose smallest node stands for null ids is named by its smallest id.
    named = classed.groupBy("component").agg(F.min("low").alias("name"))
    classed = classed.join(named, "component", "left") \
        .select("v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "name")
    good = rows.filter("valid").join(classed, "v").select("vec_id", "n_links", F.col("name").alias("component_id"))
    bad = rows.filter("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                          F.col("vec_id").alias("component_id"))
    return good.unionByName(bad).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _linked(spark, groups: DataFrame, c: np.ndarray, threshold: float, margin: float, block: int) -> DataFrame:
    """(id, n, other): counts of linked rows (other null) and links of a forest."""
    shared = spark.sparkContext.broadcast(c)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            home, member = guests(_unit(b.column(0).to_pylist()), shared.value, margin)
            k = len(shared.value)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(np.bincount(home, minlength=k)),
                                              pa.array(member.sum(axis=0))], ["cell", "homes", "members"])

    sizes = {r["cell"]: (-(-r["h"] // block), -(-r["m"] // block)) for r in groups.select("v").mapInArrow(
        tally, "cell int, homes long, members long").groupBy("cell").agg(F.sum("homes").alias("h"),
                                                                        F.sum("members").alias("m")).collect()}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["cell", "i", "j", "side", "id", "n", "v"]
        for big in batches:
            for at in range(0, big.num_rows, 1024):
                b = big.slice(at, 1024)
                ids = b.column(0).to_numpy()
                home, member = guests(_unit(b.column(2).to_pylist()), shared.value, margin)
                code = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
                cell, i, j, side, row = [], [], [], [], []
                for r, own in enumerate(home):
                    rows_, cols = sizes[own]
                    if rows_:
                        cell += [own] * cols
                        i += [code[r] % rows_] * cols
                        j += range(cols)
                        side += [0] * cols
                        row += [r] * cols
                for r, a in zip(*np.nonzero(member), strict=True):
                    rows_, cols = sizes[a]
                    cell += [a] * rows_
                    i += range(rows_)
                    j += [code[r] % cols] * rows_
                    side += [1 + int(home[r] == a)] * rows_
                    row += [r] * rows_
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell, pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                     pa.array(side, pa.int8()), *(x.take(take) for x in b.columns)], names)

    def compare(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        side = part["side"].to_numpy()
        ids, n = part["id"].to_numpy(), part["n"].to_numpy().astype(np.int64)
        x = _unit(part["v"].tolist())
        rows, cols = np.flatnonzero(side == 0), np.flatnonzero(side > 0)
        counts, pairs = np.zeros(len(ids), np.int64), []
        a = key[0]
        home, member = guests(x[cols], shared.value, margin)
        for at in range(0, len(rows), _STEP):
            some = rows[at:at + _STEP]
            near = x[some] @ x[cols].T >= threshold
            near &= ids[some][:, None] != ids[cols][None, :]
            r, k = np.nonzero(near)
            if not len(r):
                continue
            np.add.at(counts, some[r], n[cols[k]])
            # The other end lives in another cell that this row is no guest of: credit it here.
            away = np.flatnonzero(home[k] != a)
            if len(away):
                _, seen = guests(x[some], shared.value, margin)
                lost = away[~seen[r[away], home[k[away]]]]
                np.add.at(counts, cols[k[lost]], n[some[r[lost]]])
            pairs.append(np.stack([some[r], cols[k]], axis=1))
        out = [pd.DataFrame({"id": ids[counts > 0], "n": counts[counts > 0], "other": None})]
        if pairs:
            u, back = np.unique(ids, return_inverse=True)
            root = _forest(back[np.concatenate(pairs)], len(u))
            moved = np.flatnonzero(root != np.arange(len(u)))
            out.append(pd.DataFrame({"id": u[moved], "n": 0, "other": u[root[moved]]}))
        return pd.concat([o.astype({"other": "Int64"}) for o in out], ignore_index=True)

    return groups.select("id", "n", "v").mapInArrow(
        deal, "cell int, i int, j int, side byte, id long, n long, v array<double>") \
        .groupBy("cell", "i", "j").applyInPandas(compare, "id long, n long, other long")


def op5_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors among all embeddings, one row each."""
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))
