"""Merkle fixity audit of WARC replicas.

A replica is a table of records (archive, offset, payload). Records are hashed
and an archive's records, in order of offset, are the leaves of a tree over
offset ranges: a leaf range spans ``LEAF_SPAN`` bytes, a node above it
``FANOUT`` ranges of the level below; a node's hash covers its children's
positions and hashes in order. Two replicas are compared at their roots, and
only under mismatching nodes are the next level's nodes compared, down to the
records.

Scale: everything is DataFrame expressions. A node gathers at most ``FANOUT``
children and a leaf range the records that start in its bytes, whatever the
size of an archive, so a hot archive is many nodes. Digests are written once
(not payloads, which never move), and descending joins only rows under mismatches.

Defined cases: a null payload is an empty one; a null archive is an archive of
its own, apart from one without a name; records with a null offset are dealt by
digest over ranges below all offsets; of the records at one place (or without
an offset) equal ones match first, copy by copy, and different records that are
left are paired in order of digest (``corrupt``); what stays unpaired, copies
included, is ``missing`` (the second replica lacks it) or ``extra``, one row
however many copies; an empty replica has no trees; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import read_table, written

LEAF_SPAN = 1 << 18
FANOUT = 16
#: Ranges that an archive's records without an offset are dealt over.
UNPLACED = 4096


def fixity(payload: Column) -> Column:
    """(length, digest) of a payload."""
    data = F.coalesce(payload.cast("binary"), F.lit(b""))
    return F.struct(F.octet_length(data).cast("long").alias("length"), F.unhex(F.sha2(data, 256)).alias("digest"))


def records(replica: DataFrame, archive: str = "archive", offset: str = "offset", payload: str = "payload") -> DataFrame:
    """(archive, offset, length, digest) of a replica's records."""
    return replica.select(F.col(archive).cast("string").alias("archive"), F.col(offset).cast("long").alias("offset"),
                          fixity(F.col(payload)).alias("seen")).select("archive", "offset", "seen.*")


def counted(recs: DataFrame) -> DataFrame:
    """(archive, offset, length, digest, copies); the archive's name after
    ``=``, that of a null archive empty."""
    return recs.withColumn("archive", F.coalesce(F.concat(F.lit("="), "archive"), F.lit(""))) \
        .groupBy("archive", "offset", "length", "digest").agg(F.count("*").alias("copies"))


def _hash_of(children: Column) -> Column:
    """SHA-256 over the children's (position, hash), in order."""
    return F.unhex(F.sha2(F.array_join(F.transform(F.array_sort(children), lambda c: F.concat(
        c["at"].cast("string"), F.lit(":"), F.hex(c["hash"]))), ";").cast("binary"), 256))


def _range(span: int) -> Column:
    """The leaf range of a record; below 0 where it has no offset."""
    return F.coalesce(F.floor(F.col("offset") / span), -1 - F.pmod(F.xxhash64("digest"), F.lit(UNPLACED)))


def leaves(recs: DataFrame, span: int = LEAF_SPAN) -> DataFrame:
    """(archive, node, hash) of the lowest ranges."""
    of_record = F.unhex(F.sha2(F.concat(F.col("digest"), F.concat_ws(
        ":", "length", "copies", F.when(F.col("offset").isNull(), "unplaced")).cast("binary")), 256))
    return recs.groupBy("archive", _range(span).alias("node")) \
        .agg(_hash_of(F.collect_list(F.struct(F.coalesce("offset", F.lit(-1)).alias("at"), of_record.alias("hash")))).alias("hash"))


def level_above(nodes: DataFrame, fanout: int = FANOUT) -> DataFrame:
    return nodes.groupBy("archive", F.floor(F.col("node") / fanout).alias("parent")) \
        .agg(_hash_of(F.collect_list(F.struct(F.col("node").alias("at"), "hash"))).alias("hash")) \
        .withColumnRenamed("parent", "node")


def trees(recs: DataFrame, levels: int, span: int = LEAF_SPAN, fanout: int = FANOUT) -> list[DataFrame]:
    """Written levels from the leaves up to the roots (node 0 of each archive)."""
    out = [written(leaves(recs, span), "leaves")]
    for _ in range(levels):
        out.append(written(level_above(out[-1], fanout), "nodes"))
    return out


def _levels(spans: list[int], span: int, fanout: int) -> int:
    """Levels above the leaves until one node spans the largest offset."""
    nodes, levels = max(spans, default=0) // span + 1, 0
    while nodes > 1:
        nodes, levels = -(-nodes // fanout), levels + 1
    return levels


def audit(first: DataFrame, second: DataFrame, span: int = LEAF_SPAN, fanout: int = FANOUT, **columns: str) -> DataFrame:
    """One row per damaged record: archive, offset, length, status (corrupt,
    missing, extra), expected and found digests (lowercase hex)."""
    return audit_records(records(first, **columns), records(second, **columns), span, fanout)


def audit_records(first: DataFrame, second: DataFrame, span: int = LEAF_SPAN, fanout: int = FANOUT) -> DataFrame:
    """``audit`` of replicas given as ``records``."""
    a, b = (written(counted(r), "records") for r in (first, second))
    tops = [x.agg(F.max("offset")).first()[0] or 0 for x in (a, b)]
    levels = _levels(tops, span, fanout)
    ours, theirs = trees(a, levels, span, fanout), trees(b, levels, span, fanout)
    suspects = None
    for x, y in zip(reversed(ours), reversed(theirs), strict=True):
        if suspects is not None:
            up = F.floor(F.col("node") / fanout)
            parents = suspects.select(F.col("archive"), F.col("node").alias("parent"))
            x, y = (t.withColumn("parent", up).join(parents, ["archive", "parent"], "left_semi").drop("parent")
                    for t in (x, y))
        suspects = written(x.withColumnRenamed("hash", "mine").join(y.withColumnRenamed("hash", "other"),
                                                                    ["archive", "node"], "full")
                           .filter(~F.col("mine").eqNullSafe(F.col("other"))).select("archive", "node"), "suspects")
    left = None
    for t, sign in ((a, 1), (b, -1)):
        t = t.withColumn("node", _range(span)).join(suspects, ["archive", "node"], "left_semi").select(
            "archive", F.coalesce("offset", F.lit(0)).alias("at"), F.col("offset").isNotNull().alias("placed"),
            "length", "digest", (F.col("copies") * sign).alias("copies"))
        left = t if left is None else left.unionByName(t)
    # Copies that both replicas hold match; those that one has more of are left.
    left = left.groupBy("archive", "at", "placed", "length", "digest").agg(F.sum("copies").alias("copies")) \
        .filter("copies <> 0").withColumn("mine", F.col("copies") > 0)
    order = Window.partitionBy("archive", "at", "placed", "mine").orderBy("digest", "length")
    left = left.withColumn("k", F.row_number().over(order)).withColumn("seen", F.struct("length", "digest"))
    pairs = left.groupBy("archive", "at", "placed", "k").agg(
        F.max(F.when(F.col("mine"), F.col("seen"))).alias("mine"), F.max(F.when(~F.col("mine"), F.col("seen"))).alias("other"))
    status = F.when(F.col("other").isNull(), "missing").when(F.col("mine").isNull(), "extra").otherwise("corrupt")
    return pairs.select(
        F.when(F.col("archive") != "", F.substring("archive", 2, 1 << 30)).alias("archive"),
        F.when(F.col("placed"), F.col("at")).alias("offset"), F.coalesce("mine.length", "other.length").alias("length"),
        status.alias("status"), F.lower(F.hex("mine.digest")).alias("expected"), F.lower(F.hex("other.digest")).alias("found"))


# --- two replicas of the driver's pages -------------------------------------------


def archived(pages: DataFrame, per_archive: int = 500) -> DataFrame:
    """(archive, offset, whole, held, page_id): every page as a WARC response
    record, dealt by a hash of the row over archives of about ``per_archive``
    records, in order of page. ``whole`` is the fixity of the payload, ``held``
    that of a replica's (see ``decayed``); payloads stay where they are read."""
    n = max(1, -(-pages.count() // per_archive))
    html = F.coalesce(F.col("html"), F.lit(""))
    url = F.coalesce(F.col("url"), F.lit(""))
    page = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), url,
                    F.lit("\r\nWARC-Record-ID: <urn:page:"), page, F.lit(">\r\nContent-Length: "),
                    F.octet_length(html).cast("string"), F.lit("\r\n\r\n"))
    code = F.md5(F.concat_ws("|", page, url, F.md5(html.cast("binary"))).cast("binary"))
    rows = pages.select("page_id", F.concat(head, html, F.lit("\r\n\r\n")).cast("binary").alias("payload"), code.alias("code")) \
        .select("page_id", "code", F.conv(F.substring("code", 1, 8), 16, 10).cast("long").alias("c"),
                fixity(F.col("payload")).alias("whole"), fixity(decayed(F.col("payload"), F.col("page_id"))).alias("held"))
    before = Window.partitionBy("archive").orderBy("page_id", "code").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("archive", F.format_string("pages-%06d.warc", F.col("c") % n)) \
        .withColumn("offset", F.coalesce(F.sum("whole.length").over(before), F.lit(0)).cast("long")) \
        .select("archive", "offset", "whole", "held", "page_id")


def decayed(payload: Column, page_id: Column) -> Column:
    """A payload as a failing store would return it: of the records whose page
    id divided by 50 leaves 7 the first byte is flipped, by 125 leaves 11 the
    last kilobyte is cut off (by 250 leaves 19 all is lost)."""
    flipped = F.concat(F.lit(b"w"), F.substring(payload, 2, 1 << 30))
    cut = F.substring(payload, F.lit(1), F.greatest(F.octet_length(payload) - 1024, F.lit(0)))
    page = F.coalesce(page_id, F.lit(0))
    return F.when(page % 50 == 7, flipped).when(page % 125 == 11, cut).otherwise(payload)


def op1_warc_audit(spark, sf_dir: str) -> DataFrame:
    """All pages as WARC records, a decayed replica audited against the whole."""
    pages = written(archived(read_table(spark, sf_dir, "pages")), "archived")
    lost = F.coalesce(F.col("page_id"), F.lit(0)) % 250 == 19
    return audit_records(pages.select("archive", "offset", "whole.*"),
                         pages.filter(~lost).select("archive", "offset", "held.*"))


SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS u, coalesce(html, '') AS h, coalesce(CAST(page_id AS VARCHAR), '') AS page,
         (SELECT greatest(1, (count(*) + 499) // 500) FROM pages) AS n
  FROM pages),
r AS (
  SELECT page_id, encode('WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
           || 'WARC-Target-URI: ' || u || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page || '>' || chr(13)
           || chr(10) || 'Content-Length: ' || octet_length(encode(h)) || chr(13) || chr(10) || chr(13) || chr(10) || h
           || chr(13) || chr(10) || chr(13) || chr(10)) AS payload,
         md5(page || '|' || u || '|' || md5(h)) AS code, n
  FROM p),
o AS (
  SELECT page_id, payload, octet_length(payload) AS length,
         'pages-' || lpad(CAST(CAST('0x' || substr(code, 1, 8) AS BIGINT) % n AS VARCHAR), 6, '0') || '.warc' AS archive,
         coalesce(sum(octet_length(payload)) OVER (
           PARTITION BY CAST('0x' || substr(code, 1, 8) AS BIGINT) % n ORDER BY page_id, code
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS "offset"
  FROM r),
d AS (
  SELECT *, CASE WHEN page_id % 250 = 19 THEN NULL
                 WHEN page_id % 50 = 7 THEN encode('w') || payload[2:]
                 WHEN page_id % 125 = 11 THEN payload[1:greatest(length - 1024, 0)] ELSE payload END AS held
  FROM o)
SELECT archive, CAST("offset" AS BIGINT) AS "offset", CAST(length AS BIGINT) AS length,
       CASE WHEN held IS NULL THEN 'missing' ELSE 'corrupt' END AS status,
       sha256(payload) AS expected, CASE WHEN held IS NOT NULL THEN sha256(held) END AS found
FROM d WHERE held IS NULL OR sha256(held) <> sha256(payload)"""
