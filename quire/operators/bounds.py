"""Size proofs for explicit broadcasts.

A side is broadcast only when an exact aggregate over it bounds its size:
rows x (longest key + per-row overhead) under ``BROADCAST_BYTES``. Otherwise
the caller keeps a shuffle join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 48


def string_side_fits(df: DataFrame, cols: list[str], limit: int = BROADCAST_BYTES) -> bool:
    aggs = [F.count(F.lit(1)).alias("n")] + [F.coalesce(F.max(F.length(c)), F.lit(0)).alias(f"l{i}")
                                            for i, c in enumerate(cols)]
    r = df.agg(*aggs).first()
    width = sum(r[f"l{i}"] for i in range(len(cols))) * 4 + ROW_OVERHEAD  # up to 4 bytes per char
    return r["n"] * width <= limit


def maybe_broadcast(df: DataFrame, cols: list[str], limit: int = BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when :func:`string_side_fits`, else ``df`` unchanged."""
    return F.broadcast(df) if string_side_fits(df, cols, limit) else df
