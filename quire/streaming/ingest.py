"""Incremental ingest (T1): landed record files -> stream -> one upsert per
micro-batch into the versioned papers table.

Arrival order travels with the data (``run_seq``, ``pos``), so the table a
stream ends with equals the batch upsert of the same records, whatever the
batch boundaries. A micro-batch is committed under (stream, batch id): a replay
after a failure finds that pair and skips it, and other writers may commit in
between.
"""

from __future__ import annotations

import hashlib
import json
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_of, shared_path
from ..sources.store import PaperStore

# A backlog is one batch up to this size, and above it BATCHES (a file at the
# edge may add one): a batch rewrites the buckets of its titles, so the number
# of batches must not grow with the backlog. Larger files are a batch by
# themselves.
BATCH_BYTES = 4 << 30
BATCHES = 2


def stream_id(checkpoint: str) -> str:
    """A name for the stream that lives in ``checkpoint``, alike after restarts."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def upsert_stream(records: DataFrame, store: PaperStore, checkpoint: str, available_now: bool = True, landed: bool = False):
    """Start the stream ``records`` -> ``store`` (upsert per micro-batch)."""
    stream = stream_id(checkpoint)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        store.upsert(batch, batch=(stream, batch_id), landed=landed)

    w = records.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def read_landed(spark: SparkSession, landing: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """A stream of the landed files, in a bounded number of batches by bytes
    (or of a number of files each, as tests ask for)."""
    fs, p = path_of(spark, landing)
    batch = max(BATCH_BYTES, -(-fs.getContentSummary(p).getLength() // BATCHES))
    r = spark.readStream.schema(schema)
    r = r.option("maxBytesPerTrigger", batch) if files_per_batch is None else \
        r.option("maxFilesPerTrigger", files_per_batch)
    return r.parquet(landing)


def _drained(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


# Bytes of files read for one landed file.
PART_BYTES = 64 << 20


def _scanned_bytes(records: DataFrame) -> int:
    """Size of the files that ``records`` come from (0: from none)."""
    spark, total = records.sparkSession, 0
    for f in records.inputFiles():
        fs, p = path_of(spark, f)
        total += fs.getFileStatus(p).getLen()
    return total


def ingest_landed_records(spark: SparkSession, records: DataFrame, store_path: str | None = None,
                          files_per_batch: int | None = None, n_files: int | None = None) -> PaperStore:
    """Land ``records`` under the shared folder, then ingest them with a stream
    until all are processed. Returns the store."""
    landing = shared_path(spark, "landing")
    if n_files is None:
        records.write.parquet(landing)
    else:
        # ``n_files`` is what a small landing has; of a large one each is cut
        # into parts of bounded size, which arrive together.
        parts = max(1, -(-_scanned_bytes(records) // (n_files * PART_BYTES)))
        records.repartition(n_files * parts).write.parquet(landing)
        files_per_batch = None if files_per_batch is None else files_per_batch * parts
    store = PaperStore(spark, store_path or shared_path(spark, "papers"))
    _drained(upsert_stream(read_landed(spark, landing, records.schema, files_per_batch), store,
                           shared_path(spark, "stream-ckpt"), landed=True))
    return store


# --- pages: details wait for what they need ---------------------------------------

# An event: key, venue, url, run_seq, pos, detail (a struct of collect.DETAIL), bibtex, accepted.
# JOINED: venue, detail, found_bibtex, found_accepted.


def detail_events(pages: DataFrame, venues: list[str], query: str | None = None) -> DataFrame:
    """What the landed detail pages of ``venues`` hold, under the key that they
    share with a BibTeX page or notes reply; null where they need none."""
    from ..plans.collect import DETAIL, SITES

    def of(venue: str) -> DataFrame:
        d = SITES[venue].details(pages, query)
        return d.select(F.col("lookup_key").alias("key"), F.lit(venue).alias("venue"), "url", "run_seq", "pos",
                        F.struct(*DETAIL).alias("detail"), F.lit(None).cast("string").alias("bibtex"),
                        F.lit(None).cast("boolean").alias("accepted"))

    return reduce(DataFrame.unionByName, [of(venue) for venue in venues])


def lookup_events(pages: DataFrame, like: DataFrame) -> DataFrame:
    """What the landed BibTeX pages and notes replies hold, with the columns of
    ``like`` (detail events)."""
    from ..operators.records import is_accepting
    from ..schemas import NOTES_REPLY

    found = pages.where(F.col("kind").isin("bibtex", "notes"))
    notes = F.from_json("html", NOTES_REPLY)["notes"]
    accepts = F.exists(notes, lambda n: F.coalesce(is_accepting(n["content"]["decision"]), F.lit(False)))
    forum = F.nullif(F.regexp_extract(F.col("url"), r"[?&]forum=([^&#]+)", 1), F.lit(""))
    is_notes = F.col("kind") == "notes"
    return found.select(F.when(is_notes, forum).otherwise(F.col("url")).alias("key"), "venue", "url", "run_seq", "pos",
                        F.lit(None).cast(like.schema["detail"].dataType).alias("detail"),
                        F.when(~is_notes, F.col("html")).alias("bibtex"),
                        F.when(is_notes, F.coalesce(accepts, F.lit(False))).alias("accepted")) \
        .where(F.col("key").isNotNull())


def _meet(key, batches, state):
    """The rule of a key, in plain Python (tests hold :func:`meet` to it): its
    details, old and new, are put out with what has been found by now whenever
    either changes. A detail that can need nothing (no lookup) leaves no state."""
    details, bibtex, accepted = state.get if state.exists else (None, None, None)
    details = json.loads(details) if details else {}
    latest_bibtex = None
    for pdf in batches:
        for e in pdf.itertuples(index=False):
            if e.detail is not None:
                order = [_whole(e.run_seq), _whole(e.pos)]
                if e.url not in details or details[e.url][0] <= order:
                    details[e.url] = [order, e.venue, e.detail]
            if e.bibtex is not None:  # of several landed in a batch the greatest text, so that replays agree
                latest_bibtex = e.bibtex if latest_bibtex is None else max(latest_bibtex, e.bibtex)
            if e.accepted is not None:
                accepted = bool(e.accepted) or bool(accepted)
    bibtex = bibtex if latest_bibtex is None else latest_bibtex
    if not key[0].startswith("none:"):
        state.update((json.dumps(details), bibtex, accepted))
    rows = [(venue, detail, bibtex, accepted) for _, venue, detail in details.values()]
    yield pd.DataFrame(rows, columns=["venue", "detail", "found_bibtex", "found_accepted"], dtype=object)


def _whole(x) -> int:
    return -1 if x is None or x != x else int(x)


def meet(events: DataFrame) -> DataFrame:
    """Keys with the pages whose details wait under them and what was found:
    a streaming aggregate, so that in output mode ``update`` a batch puts out
    the keys that it touches. ``at`` is the time of the batch: of BibTeX pages
    those of the newest batch count, then the greatest text, so that replays
    agree."""
    def order(c: str):
        return F.coalesce(c, F.lit(-1)).cast("bigint").alias(c)

    page = F.struct("url", order("run_seq"), order("pos"), "at", "venue", "detail")
    return events.withColumn("at", F.current_timestamp()).groupBy("key").agg(
        F.collect_list(F.when(F.col("detail").isNotNull(), page)).alias("pages"),
        F.max(F.when(F.col("bibtex").isNotNull(), F.struct("at", "bibtex")))["bibtex"].alias("found_bibtex"),
        F.bool_or("accepted").alias("found_accepted"))


def joined_details(met: DataFrame) -> DataFrame:
    """The details of met keys with what was found for them (JOINED). Copies of
    a page follow each other in the sorted list: the last one counts."""
    pages = F.array_sort("pages")
    following = F.slice(pages, 2, F.greatest(F.size("pages"), F.lit(1)))
    marked = F.zip_with(pages, following, lambda a, b: F.struct(
        a["venue"].alias("venue"), a["detail"].alias("detail"), (b.isNull() | ~a["url"].eqNullSafe(b["url"])).alias("last")))
    x = met.select(F.explode(F.filter(marked, lambda m: m["last"])).alias("m"), "found_bibtex", "found_accepted")
    return x.select("m.venue", "m.detail", "found_bibtex", "found_accepted")


def joined_records(joined: DataFrame, query: str | None = None) -> DataFrame:
    """Records (as the batch plan makes them) of joined details, in one pass."""
    from ..plans.collect import finished
    return finished(joined.select("venue", "detail.*", "found_bibtex", "found_accepted"), None, query)


def page_stream(pages: DataFrame, query: str | None = None) -> DataFrame:
    """A stream of landed pages as joined details: those of venues without
    lookups as they land, the others by state on the key that they share."""
    from ..plans.collect import SITES

    alone = [v for v, site in SITES.items() if site.lookups is None]
    details = detail_events(pages, [v for v in SITES if v not in alone], query)
    key = F.coalesce("key", F.concat(F.lit("none:"), F.col("url")))
    met = joined_details(meet(details.withColumn("key", key).unionByName(lookup_events(pages, details))))
    direct = detail_events(pages, alone, query).select("venue", "detail", F.lit(None).cast("string").alias("found_bibtex"),
                                                       F.lit(None).cast("boolean").alias("found_accepted"))
    return met.unionByName(direct)


def ingest_landed_pages(spark: SparkSession, landing: str, store: PaperStore, files_per_batch: int | None = None,
                        query: str | None = None, checkpoint: str | None = None) -> PaperStore:
    """T1 over pages: stream the landed page files, read each once, and upsert
    the records. A detail page waits in keyed state for its BibTeX page or
    notes, and the other way round: whichever lands last completes the record
    (until then it is a reject, or not accepted). The landing is never scanned
    again. State grows with the keys that pages share and the copies of a page
    that land under them, one entry each; on a cluster it belongs in the
    RocksDB state store, which spills to disk. Runs until the landing is
    drained."""
    from ..operators.matching import filter_by_query

    schema = spark.read.parquet(landing).schema
    checkpoint = checkpoint or shared_path(spark, "stream-ckpt")
    stream = stream_id(checkpoint)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        if store.version_of((stream, batch_id)) is not None:  # a replay: only the state is still to be written
            batch.write.format("noop").mode("overwrite").save()
            return
        records = joined_records(batch, query)
        if query is not None:
            records = filter_by_query(records.withColumn("title", F.coalesce("title", F.lit(""))), query)
        store.upsert(records, batch=(stream, batch_id))

    joined = page_stream(read_landed(spark, landing, schema, files_per_batch), query)
    _drained(joined.writeStream.foreachBatch(per_batch).outputMode("update").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    return store
