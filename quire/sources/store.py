"""The papers table: create (S7), scan (S4), CSV source (S5), routing (S6),
versioned upsert (S8) and score write-back (S9), BibTeX export (S10).

Papers lie in buckets by a hash of their title. A change reads and writes only
the buckets of the titles it touches: version ``<path>/of=<buckets>/v=<n>``
holds these, and a bucket's rows are those of the newest version that has it.
Files are never overwritten while they are read; a version counts once it has
a ``_SUCCESS`` marker, so a job that dies mid-write is ignored. A version is
always the next one; a stream's batch is named in its version's folder, and
only that pair (stream, batch) marks a replay, which is skipped.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators import records as R
from ..operators import upsert as U
from ..operators.bounds import maybe_broadcast
from ..operators.ranking import running_totals
from .csv_lines import csv_rows

# Fixed values of the CSV export source: positions of the columns read, and
# the venue it stands for.
CSV_POSITIONS = {"title": 0, "authors": 1, "year": 5, "abstract": 10, "url_pdf": 15}
CSV_VENUE = "ICASSP"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


# Buckets of a new table; a table keeps the number it was made with.
BUCKETS = 32


class PaperStore:
    """A versioned papers table at ``path``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark = spark
        self.path = path.rstrip("/")
        made = [m[1] for name in self._folders(self.path) if (m := re.fullmatch(r"of=(\d+)", name))]
        self.buckets = int(made[0]) if made else buckets
        self.root = f"{self.path}/of={self.buckets}"

    def _folders(self, path: str) -> list[str]:
        fs, p, _ = _fs(self.spark, path)
        return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()] if fs.exists(p) else []

    # -- versions ---------------------------------------------------------
    def _committed(self) -> dict[int, str]:
        """Folder name of every committed version, in order."""
        out = {}
        for name in self._folders(self.root):
            fs, p, _ = _fs(self.spark, f"{self.root}/{name}/_SUCCESS")
            if (m := re.fullmatch(r"v=(\d+)(?:@.*)?", name)) and fs.exists(p):
                out[int(m[1])] = name
        return dict(sorted(out.items()))

    def versions(self) -> list[int]:
        return list(self._committed())

    def current_version(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def version_of(self, batch: tuple[str, int]) -> int | None:
        """The version that committed a stream's batch; None before it did."""
        tag = _tag(batch)
        return next((v for v, name in self._committed().items() if name.endswith(tag)), None)

    def bucket_paths(self, version: int | None = None) -> dict[int, str]:
        """Folder of every bucket that has rows, as of a version."""
        out = {}
        for v, name in self._committed().items():
            if version is None or v <= version:
                out.update({int(f[7:]): f"{self.root}/{name}/{f}" for f in self._folders(f"{self.root}/{name}")
                            if f.startswith("bucket=")})
        return out

    def read(self, version: int | None = None, buckets: set[int] | None = None) -> DataFrame:
        """S4 (and S7: an empty table with the fixed schema when none exists),
        of all buckets or of some."""
        paths = [p for b, p in self.bucket_paths(version).items() if buckets is None or b in buckets]
        if not paths:
            return self.spark.createDataFrame([], schemas.PAPERS)
        return self.spark.read.schema(schemas.PAPERS).parquet(*paths)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64("title"), F.lit(self.buckets)).cast("int")

    def part(self) -> Column:
        """Parts of a bucket that are written beside each other, so that tasks
        are as many as shuffle partitions however few the buckets."""
        parts = max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")) // self.buckets)
        return F.pmod(F.hash("title"), F.lit(parts)).cast("int")

    def touched(self, rows: DataFrame) -> set[int]:
        """The buckets of the titles of ``rows``: at most as many as there are."""
        return {r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect()}

    def commit(self, df: DataFrame, batch: tuple[str, int] | None = None, placed: bool = False) -> int:
        """Write the next version: all rows of the buckets it holds. ``batch``
        (stream id, batch id) goes into the folder's name, so the version and
        its batch are committed as one. ``placed``: the rows of a bucket are in
        few tasks already."""
        if batch is not None and (done := self.version_of(batch)) is not None:
            return done
        cur = self.current_version()
        version = 0 if cur is None else cur + 1
        name = f"v={version}" + ("" if batch is None else _tag(batch))
        rows = df.select(*schemas.PAPER_COLUMNS, self.bucket().alias("bucket"))
        (rows if placed else rows.hint("rebalance", "bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/{name}")
        return version

    # -- changes ----------------------------------------------------------
    def upsert(self, records: DataFrame, batch: tuple[str, int] | None = None, landed: bool = False) -> tuple[int, DataFrame]:
        """Validate new records (P2), last write wins per title over the
        current rows of their buckets plus the new rows, commit as a new
        version. Returns the version and the rejects. A batch that a version
        has committed already is a replay: nothing is done again. ``landed``:
        the records are read from files as they are, so they are not copied."""
        if batch is not None and (done := self.version_of(batch)) is not None:
            return done, self.spark.createDataFrame([], schemas.REJECTS)
        # Classify once and write to the shared folder, so the valid rows and
        # the rejects do not each re-run the extraction, and each pass below
        # reads the columns it needs.
        from ..session import shared_path
        classified = R.classify(records)
        if not landed:
            path = shared_path(self.spark, "classified")
            kept = classified.select(*(c for c in (*schemas.PAPER_COLUMNS, "url", "reason", "missing") if c in classified.columns))
            kept.write.parquet(path)
            classified = self.spark.read.schema(kept.schema).parquet(path)
        valid, rejects = R.split_valid(classified)
        cur = self.current_version()
        if cur is None:
            merged = U.upsert(None, valid)
        else:
            merged = U.merge(self.read(cur, self.touched(valid)), valid, [self.bucket(), self.part()])
        version = 0 if cur is None else cur + 1
        if "url" in classified.columns:  # every judgement, before the version that it belongs to
            classified.select("url", "reason", "missing", "run_seq").write.mode("overwrite") \
                .parquet(f"{self.path}/judged/of_version={version}")
        return self.commit(merged, batch, placed=cur is not None), rejects

    def rejects(self) -> DataFrame:
        """(url, reason, missing, run_seq) of the pages whose latest
        judgement is a rejection; a page that a later batch accepted is gone.
        One scan of the log, whatever the number of versions."""
        cur = self.current_version()
        fs, p, _ = _fs(self.spark, f"{self.path}/judged")
        if cur is None or not fs.exists(p):
            return self.spark.createDataFrame([], schemas.REJECTS)
        schema = T.StructType([*schemas.REJECTS.fields, T.StructField("of_version", T.LongType())])
        log = self.spark.read.schema(schema).parquet(f"{self.path}/judged").where(F.col("of_version") <= cur)
        return U.latest_by_key(log, ["url"], ["of_version", "run_seq"]).where(F.col("reason").isNotNull()).drop("of_version")

    def write_back(self, scores: DataFrame, mode: str = "replace", batch: tuple[str, int] | None = None) -> int:
        """Set score lists of scored titles, leave other rows alone."""
        from ..session import ensure_checkpoint_dir
        ensure_checkpoint_dir(self.spark)
        scores = scores.select("title", "list_name", "score").checkpoint(eager=True)  # read twice
        return self.commit(U.write_back_scores(self.read(buckets=self.touched(scores)), scores, mode), batch)


def _tag(batch: tuple[str, int]) -> str:
    return f"@{batch[0]}@{batch[1]}"


def arrival(rows: DataFrame) -> DataFrame:
    """``_pos``: the place of each row of a file source: files in order of
    name, the splits of a file in order of their first byte, rows in order
    within a split. Spark reads a split in one task, so its row ids rise there;
    how splits are packed into tasks makes no difference. Splits are counted,
    their counts added up over the sorted splits, and the sums joined back."""
    rows = rows.withColumn("_file", F.col("_metadata.file_path")).withColumn("_block", F.col("_metadata.file_block_start")) \
        .withColumn("_row", F.monotonically_increasing_id())
    splits = rows.groupBy("_file", "_block").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    splits = running_totals(splits, [F.col("_file"), F.col("_block")], "_n", "_before").drop("_n")
    pos = F.col("_row") - F.col("_first") + F.col("_before")
    return rows.join(maybe_broadcast(splits, ["_file"]), ["_file", "_block"]).withColumn("_pos", pos.cast("bigint")) \
        .drop("_file", "_block", "_row", "_first", "_before")


def read_csv_papers(spark: SparkSession, path: str, venue: str = CSV_VENUE, stray_quotes: bool = False) -> DataFrame:
    """A CSV export with a header row; columns read by position. Quoted
    commas, doubled quotes and newlines inside quotes are read as data, and
    every split of a file is a task of its own. Year that does not parse
    becomes null (a reject), not an abort. ``stray_quotes``: fields without
    quotes around them may hold some; then a file is one task."""
    if stray_quotes:
        raw = arrival(spark.read.option("header", True).option("multiLine", True).option("escape", '"')
                      .option("mode", "PERMISSIVE").csv(path))
    else:
        raw = csv_rows(spark, path, max(CSV_POSITIONS.values()) + 1)
    cols = [c for c in raw.columns if c not in ("_pos",)]

    def pick(name):
        # A missing or empty field reads as '' (as a Python csv reader gives).
        i = CSV_POSITIONS[name]
        return F.coalesce(F.col(f"`{cols[i]}`"), F.lit("")) if i < len(cols) else F.lit("")

    url = pick("url_pdf")
    return R.assemble(
        raw, title=pick("title"), authors=F.when(pick("authors") != "", F.array(pick("authors"))),
        venue=venue, year=pick("year"), bibtex=F.lit(None).cast("string"), url_pdf=url,
        abstract=pick("abstract"), accepted=R.present(url), run_seq=F.lit(0).cast("bigint"),
        pos=F.col("_pos").cast("bigint"))


def load_papers(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Choose the reader by explicit format, or by the path suffix."""
    if fmt is None:
        name = path.rstrip("/").rsplit("/", 1)[-1]
        fmt = "csv" if name.endswith(".csv") else "papers" if "." not in name or name.endswith(".papers") else None
    if fmt == "csv":
        return read_csv_papers(spark, path).select(*schemas.PAPER_COLUMNS)
    if fmt == "papers":
        return PaperStore(spark, path).read()
    raise ValueError(f"Unknown database file: {path}")


def read_bibtex(spark: SparkSession, path: str) -> DataFrame:
    """(pos, entry) of an exported file set, in the order of the export."""
    return arrival(spark.read.text(path, lineSep="\n\n")).select(F.col("_pos").alias("pos"), F.col("value").alias("entry"))


def export_bibtex(selected: DataFrame, path: str, order_cols: list[str] | None = None, entries_per_file: int = 0) -> None:
    """Write the BibTeX entries of the selected rows as text, a blank line
    between entries, missing entries as empty strings. Distributed: each task
    writes its range of the order; files are named in order.
    ``entries_per_file`` cuts a task's range into several files (0: none; up to
    1,000 files a task keep the order of names)."""
    order_cols = order_cols or ["run_seq", "pos"]
    (selected.orderBy(*order_cols).select(F.coalesce(F.col("bibtex"), F.lit("")).alias("value"))
     .write.mode("overwrite").option("lineSep", "\n\n").option("maxRecordsPerFile", entries_per_file).text(path))
