"""CSV whose quoted fields hold newlines, read by many tasks a file.

A newline ends a record where the quotes before it in the file are even in
number (doubled quotes change nothing). Every split counts its quotes, and how
many records start in it if the quotes before it are even, or odd; a running
sum over the splits (one row each) tells which of the two holds and the place
of its first record. Then all splits cut their lines into records at once.
A record of one line is complete where it lies; only lines of longer records
are grouped, so a record may span any number of splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.bounds import maybe_broadcast
from ..operators.ranking import running_totals

_SPLIT = ["_file", "_block"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all files with their split, their order in it, their number of
    quotes and (``_odd``) whether an odd number comes before them in the split."""
    order = Window.partitionBy(*_SPLIT).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.text(path, lineSep="\n") \
        .select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                F.monotonically_increasing_id().alias("_row"),
                (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("_quotes"),
                F.rtrim("value", F.lit("\r")).alias("_bare")) \
        .withColumn("_blank", F.col("_bare") == "").drop("_bare") \
        .withColumn("_odd", F.coalesce(F.sum("_quotes").over(order), F.lit(0)) % 2 == 1)


def _splits(lines: DataFrame) -> DataFrame:
    """A row for each split: ``_inside`` (it begins in a quoted field),
    ``_header`` (the file's header starts in it) and ``_before`` (records of
    all files, headers aside, that start before it)."""
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = lines.groupBy(*_SPLIT).agg(
        F.sum("_quotes").alias("_quotes"), F.count_if(~F.col("_odd") & ~F.col("_blank")).alias("_if_even"),
        F.count_if(F.col("_odd") & ~F.col("_blank")).alias("_if_odd"))
    counts = counts.withColumn("_inside", F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)) % 2 == 1) \
        .withColumn("_n", F.when(F.col("_inside"), F.col("_if_odd")).otherwise(F.col("_if_even"))) \
        .withColumn("_header", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) == 0) & (F.col("_n") > 0)) \
        .withColumn("_n", F.col("_n") - F.col("_header").cast("int"))
    return running_totals(counts.select(*_SPLIT, "_inside", "_header", "_n"), [F.col(c) for c in _SPLIT], "_n", "_before") \
        .drop("_n")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(_pos, record): the records of all CSV files at ``path`` but each file's
    header, numbered from 0 in order of file name and place. Lines end with LF
    or CRLF; blank lines between records are no records; a quote that is never
    closed takes the rest of its file along; an empty file has no records.
    Quotes may stand only around fields, or doubled inside of them."""
    lines = _lines(spark, path)
    splits = _splits(lines)
    starts = (F.col("_odd") == F.col("_inside")) & ~F.col("_blank")
    upto = Window.partitionBy(*_SPLIT).orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    placed = lines.join(maybe_broadcast(splits, ["_file"]), _SPLIT) \
        .withColumn("_starts", starts).withColumn("_nth", F.count_if("_starts").over(upto) - 1) \
        .where(F.col("_starts") | (F.col("_odd") != F.col("_inside"))) \
        .withColumn("_pos", F.col("_before") + F.col("_nth") - F.col("_header").cast("int")) \
        .withColumn("_first", F.col("_header") & (F.col("_nth") == 0))
    whole = F.col("_starts") & (F.col("_quotes") % 2 == 0)
    single = placed.where(whole & ~F.col("_first")).select("_pos", F.col("value").alias("record"))
    # A header that goes on in the next split leaves lines there without a start.
    several = placed.where(~whole).groupBy("_file", "_pos") \
        .agg(F.array_sort(F.collect_list(F.struct("_block", "_row", "value"))).alias("parts"),
             F.bool_or("_starts").alias("_begun"), F.bool_or("_first").alias("_first")) \
        .where(F.col("_begun") & ~F.col("_first")) \
        .select("_pos", F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("record"))
    return single.unionByName(several).select("_pos", F.regexp_replace("record", "\r+\\z", "").alias("record"))


def csv_rows(spark: SparkSession, path: str, columns: int) -> DataFrame:
    """``_pos`` and the first ``columns`` fields, c0, c1 and so on, of every
    record; null where a record has fewer."""
    schema = ", ".join(f"c{i} string" for i in range(columns))
    fields = F.from_csv("record", schema, {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"})
    return csv_records(spark, path).select("_pos", fields.alias("f")).select("_pos", "f.*")
