"""Landed pages: scan (S1) and landing.

The fetch step is replaced by a landed table of pages. Raw page files are read
whole (one row per file) with their path as the url.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A landed pages table (parquet), columns pruned by the caller."""
    return spark.read.parquet(path)


def read_raw_pages(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """S1 over raw saved files: one row per file, url = file path."""
    reader = spark.read
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    # ``text`` has its own ``wholetext`` argument (default False) that would
    # override a reader option: pass it here.
    df = reader.text(path, wholetext=True)
    return df.select(F.xxhash64(F.input_file_name()).alias("page_id"),
                     F.input_file_name().alias("url"), F.col("value").alias("html"))


def land_pages(pages: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "append",
               max_records_per_file: int = 1000) -> None:
    """Write pages unchanged (raw html), partitioned for pruning, in files
    of bounded size so later scans (and Python extraction) get many tasks."""
    w = pages.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
