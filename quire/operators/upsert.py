"""Last write wins per title (W1), upsert (S8) and score write-back.

W1 is a ``row_number() = 1`` filter over ``partition by title order by run_seq
desc, pos desc``. Catalyst plans it with a ``WindowGroupLimit`` on both sides
of the shuffle, so each map task sends at most one row per title: a title that
holds a third of all rows costs one row per map task, not a third of the data
in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..session import ensure_checkpoint_dir
from .bounds import maybe_broadcast


def latest_by_key(df: DataFrame, key_cols: list[str], order_cols: list[str] | None = None) -> DataFrame:
    """Keep the row with the greatest (run_seq, pos) per key."""
    order_cols = order_cols or ["run_seq", "pos"]
    w = Window.partitionBy(*key_cols).orderBy(*[F.col(c).desc() for c in order_cols])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def latest_by_title(df: DataFrame) -> DataFrame:
    """Latest record per exact title."""
    return latest_by_key(df, ["title"])


def merge(stored: DataFrame, new_valid: DataFrame, place: list[Column]) -> DataFrame:
    """S8 over a stored table that has one row per title: W1 over both. The new
    rows are first cut to one per title (W1's limit on both sides of its
    shuffle); then stored and new rows meet in a single shuffle by ``place``,
    columns that follow from the title and by which the result is written.
    Of equal arrivals the new row wins: a record collected again loses its
    scores."""
    new = latest_by_title(new_valid.select(*schemas.PAPER_COLUMNS))
    both = stored.select(*schemas.PAPER_COLUMNS).withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    names = [f"_place{i}" for i in range(len(place))]
    placed = both.withColumns(dict(zip(names, place))).repartition(*names)
    return latest_by_key(placed, [*names, "title"], ["run_seq", "pos", "_new"]).drop("_new", *names)


def upsert(existing: DataFrame | None, new_valid: DataFrame) -> DataFrame:
    """Insert-or-replace by title. ``new_valid`` must already be filtered by
    validity (P2), so a later invalid record never replaces a valid one. A
    replaced row is replaced whole, with an empty score list.

    The stored table (one row per title) is never shuffled: only the new rows
    are deduplicated (W1); the stored rows are split into untouched and
    touched titles by an anti / semi join against the new titles (broadcast
    when their count proves them small, a shuffle join otherwise), and W1 runs
    again only over the touched titles. Same result as W1 over everything."""
    new = latest_by_title(new_valid.select(*schemas.PAPER_COLUMNS))
    if existing is None:
        return new
    # The new rows feed three consumers (size proof, split, W1): materialise
    # them once in the shared checkpoint folder. This also gives every
    # consumer one physical source (exchange reuse across re-derived copies
    # of the same subtree gave wrong rows in chained upserts).
    ensure_checkpoint_dir(new.sparkSession)
    new = new.checkpoint(eager=True)
    old = existing.select(*schemas.PAPER_COLUMNS)
    titles = maybe_broadcast(new.select("title"), ["title"])
    untouched = old.join(titles, "title", "left_anti")
    # Of equal arrivals the new row wins: a record collected again loses its scores.
    both = old.join(titles, "title", "left_semi").withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return untouched.unionByName(latest_by_key(both, ["title"], ["run_seq", "pos", "_new"]).drop("_new"))


def write_back_scores(papers: DataFrame, scores: DataFrame, mode: str = "replace") -> DataFrame:
    """Set the score list of every scored title, leave others alone.

    ``scores`` has ``title, list_name, score``, at most one row per title and
    list. ``replace`` overwrites the whole list with the new entries (the
    reference behaviour); ``merge`` keeps one entry per list name.
    """
    new = scores.groupBy("title").agg(
        F.sort_array(F.collect_list(F.struct("list_name", "score"))).alias("_new"))
    joined = papers.join(new, "title", "left")
    if mode == "replace":
        sims = F.coalesce(F.col("_new"), F.col("similarities"))
    elif mode == "merge":
        kept = F.filter(F.coalesce("similarities", F.array().cast(schemas.PAPERS["similarities"].dataType)),
                        lambda e: ~F.array_contains(F.transform(F.coalesce("_new", F.array().cast(
                            schemas.PAPERS["similarities"].dataType)), lambda n: n["list_name"]), e["list_name"]))
        sims = F.when(F.col("_new").isNull(), F.col("similarities")).otherwise(F.concat(kept, F.col("_new")))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return joined.withColumn("similarities", sims).select(*papers.columns)
