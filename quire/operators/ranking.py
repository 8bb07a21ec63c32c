"""Distributed 1-based row numbers over a total order (optionally restarting per
group) without a single-partition window.

The rows are range-sorted, tagged with ``monotonically_increasing_id`` (which
encodes the partition in its upper bits and the position inside it in the
lower bits) and checkpointed to the shared folder, so the two passes below see
the same partitioning. Per (partition, group) counts are small: one row per
partition and group; they are size checked, turned into offsets, broadcast
and added back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_LOW_BITS = 33
# Most (partition, group) offset rows broadcast back to the rows.
MAX_OFFSET_ROWS = 2_000_000


def global_rank(df: DataFrame, order: list[Column], rank_col: str = "rank", group_col: str | None = None) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    sort_cols = ([F.col(group_col).asc_nulls_first()] if group_col else []) + order
    tagged = df.orderBy(*sort_cols).withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.checkpoint(eager=True)
    pid = F.shiftright(F.col("_mid"), _LOW_BITS).alias("_pid")
    local = (F.col("_mid").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).alias("_local")
    g = [F.col(group_col).alias("_g")] if group_col else [F.lit(0).alias("_g")]
    stats = tagged.groupBy(pid, *g).agg(F.count("*").alias("_n"), F.min(local).alias("_first"))
    n_stats = stats.count()
    # Offsets: rows of the same group in earlier partitions (partitions are in
    # sort order, and a group's rows are contiguous). One row per (partition,
    # group); a group spans at most all partitions, so each window is small.
    from pyspark.sql import Window
    w = Window.partitionBy("_g").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0))) \
        .select("_pid", "_g", "_before", "_first")
    # Broadcast only when the count above proves it small; otherwise a
    # regular shuffle join (exact either way).
    if n_stats <= MAX_OFFSET_ROWS:
        offsets = F.broadcast(offsets)
    keyed = tagged.select("*", pid, *g)
    out = keyed.join(offsets, ["_pid", "_g"]).withColumn(
        rank_col, F.col("_before") + (local - F.col("_first")) + F.lit(1))
    return out.drop("_mid", "_pid", "_g", "_before", "_first")


def running_totals(df: DataFrame, order: list[Column], value: str, total_col: str) -> DataFrame:
    """``total_col``: the sum of ``value`` over all rows that come earlier in
    ``order``. Rows are range-sorted; each partition sums its own, and only the
    partitions' sums (one row each) are added up in one place."""
    from pyspark.sql import Window
    ensure_checkpoint_dir(df.sparkSession)
    tagged = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    keyed = tagged.withColumn("_pid", F.shiftright(F.col("_mid"), _LOW_BITS))
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = keyed.groupBy("_pid").agg(F.sum(value).alias("_sum")) \
        .select("_pid", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_of_parts"))
    within = Window.partitionBy("_pid").orderBy("_mid").rowsBetween(Window.unboundedPreceding, -1)
    own = keyed.withColumn("_of_rows", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return own.join(F.broadcast(parts), "_pid").withColumn(total_col, F.col("_of_parts") + F.col("_of_rows")) \
        .drop("_pid", "_mid", "_of_parts", "_of_rows")
