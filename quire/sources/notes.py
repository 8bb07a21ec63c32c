"""JSON sources: notes replies (S2) and JSON embedded in a page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas


def parse_notes(replies: DataFrame, body_col: str = "body", keep: list[str] | None = None) -> DataFrame:
    """One row per note of every reply body: keep cols + ``has_notes``,
    note id, forum, title, decision. A reply without ``notes`` yields one row
    with ``has_notes`` false and null note fields (so it can be reported)."""
    keep = keep or []
    parsed = replies.select(*keep, F.from_json(F.col(body_col), schemas.NOTES_REPLY).alias("_r"))
    return parsed.select(
        *keep, F.col("_r.notes").isNotNull().alias("has_notes"),
        F.explode_outer("_r.notes").alias("_n")).select(
        *keep, "has_notes", F.col("_n.id").alias("note_id"), F.col("_n.forum").alias("forum"),
        F.col("_n.content.title").alias("title"), F.col("_n.content.decision").alias("decision"))


def script_json(html: Column, element_id: str) -> Column:
    """Body of the ``script`` element with the given id (raw JSON text)."""
    return F.regexp_extract(
        html, rf"""(?is)<script\b[^>]*\sid\s*=\s*["']{element_id}["'][^>]*>(.*?)</script\s*>""", 1)


def forum_record(html: Column, element_id: str = "__NEXT_DATA__") -> Column:
    """S3 + X14: the forum note struct at props.pageProps.forumNote."""
    data = F.from_json(F.nullif(script_json(html, element_id), F.lit("")), schemas.FORUM_PAGE_DATA)
    return data["props"]["pageProps"]["forumNote"]
