"""Paper records: assembly (X13), validity (P2), rejects (P4, A8), field quality
(P3), accept flags (P7, A3, P8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas

# Fields that must be truthy for a record to be kept, in the
# reference's order, and the substring that marks an accepting decision.
REQUIRED_FIELDS = ["title", "authors", "venue", "year", "url_pdf", "abstract", "bibtex"]
ACCEPT_WORD = "accept"


def _blank(c: Column) -> Column:
    return c.isNull() | (c == F.lit(""))


def to_int(text: Column) -> Column:
    """``try_cast(trim(text) as int)``: null instead of an error on bad input
    (Python ``int`` rules for the cases seen: surrounding spaces pass,
    ``2023x`` and ``2023.5`` fail)."""
    return F.trim(text).try_cast("int")


def assemble(df: DataFrame, *, title, authors, venue, year, bibtex, url_pdf, abstract,
             accepted, query_term=None, run_seq=None, pos=None, extra: list[str] | None = None) -> DataFrame:
    """Project extracted columns into the papers schema.

    ``year`` is the raw text (or int); ``year_text`` keeps it so a failed cast
    can be reported. New records carry an empty score list (re-collecting a
    title resets its scores).
    """
    lit_or = lambda v, t: v if isinstance(v, Column) else F.lit(v).cast(t)
    year_c = lit_or(year, "string")
    cols = [
        lit_or(title, "string").alias("title"),
        lit_or(authors, "array<string>").alias("authors"),
        lit_or(venue, "string").alias("venue"),
        to_int(year_c.cast("string")).alias("year"),
        lit_or(bibtex, "string").alias("bibtex"),
        lit_or(url_pdf, "string").alias("url_pdf"),
        lit_or(abstract, "string").alias("abstract"),
        lit_or(query_term, "string").alias("query_term"),
        lit_or(accepted, "boolean").alias("accepted"),
        F.array().cast(schemas.PAPERS["similarities"].dataType).alias("similarities"),
        lit_or(run_seq, "bigint").alias("run_seq"),
        lit_or(pos, "bigint").alias("pos"),
        year_c.cast("string").alias("year_text"),
    ]
    return df.select(*cols, *(extra or []))


def missing_fields(df: DataFrame) -> Column:
    """Array of required fields that are not truthy."""
    checks = {
        "title": _blank(F.col("title")),
        "authors": F.col("authors").isNull(),
        "venue": _blank(F.col("venue")),
        "year": F.col("year").isNull() | (F.col("year") == 0),
        "url_pdf": _blank(F.col("url_pdf")),
        "abstract": _blank(F.col("abstract")),
        "bibtex": _blank(F.col("bibtex")),
    }
    return F.array_compact(F.array(*[F.when(checks[f], F.lit(f)) for f in REQUIRED_FIELDS]))


def classify(records: DataFrame) -> DataFrame:
    """Add ``missing`` and ``reason``: null reason = valid; ``error`` = the year
    could not be read or the page not parsed (``parse_error``, where there is
    one; the record is lost in the reference); ``invalid`` = a required field
    is empty."""
    bad_year = F.col("year").isNull()
    if "parse_error" in records.columns:
        bad_year = bad_year | F.col("parse_error").isNotNull()
    missing = missing_fields(records)
    return (records.withColumn("missing", missing)
            .withColumn("reason", F.when(bad_year, F.lit("error"))
                        .when(F.size("missing") > 0, F.lit("invalid"))))


def split_valid(records: DataFrame, url_col: str = "url") -> tuple[DataFrame, DataFrame]:
    """(valid papers, rejects). Rejects keep the url, reason and missing fields.
    ``records`` may already be classified (``reason`` and ``missing`` present)."""
    c = records if {"reason", "missing"} <= set(records.columns) else classify(records)
    valid = c.where(F.col("reason").isNull()).select(*schemas.PAPER_COLUMNS)
    rejects = c.where(F.col("reason").isNotNull()).select(
        F.col(url_col).alias("url") if url_col in records.columns else F.lit(None).cast("string").alias("url"),
        "reason", "missing", "run_seq")
    return valid, rejects


def reject_counts(rejects: DataFrame) -> DataFrame:
    """Tally of rejects per reason."""
    return rejects.groupBy("reason").agg(F.count("*").alias("n"))


def field_quality(records: DataFrame) -> DataFrame:
    """Per-field counts of nulls, blank strings and failed casts, one row
    per field (one aggregate pass)."""
    aggs = [F.count("*").alias("n_rows")]
    for f in REQUIRED_FIELDS + ["accepted"]:
        c = F.col(f)
        aggs.append(F.count(F.when(c.isNull(), True)).alias(f"{f}__null"))
        if f in ("authors",):
            blank = F.size(c) == 0
        elif f in ("year", "accepted"):
            blank = F.lit(False)
        else:
            blank = c == ""
        aggs.append(F.count(F.when(blank, True)).alias(f"{f}__blank"))
    aggs.append(F.count(F.when(F.col("year").isNull() & F.col("year_text").isNotNull(), True)).alias("year__badcast"))
    row = records.agg(*aggs)
    fields = REQUIRED_FIELDS + ["accepted"]
    stack = ", ".join(f"'{f}', `{f}__null`, `{f}__blank`" for f in fields)
    return row.selectExpr(
        f"stack({len(fields)}, {stack}) AS (field, n_null, n_blank)", "n_rows", "year__badcast"
    ).select("field", "n_rows", "n_null", "n_blank",
             F.when(F.col("field") == "year", F.col("year__badcast")).otherwise(F.lit(0)).alias("n_badcast"))


def is_accepting(decision: Column, word: str = ACCEPT_WORD) -> Column:
    """Decision text contains ``accept`` after lowercasing (so ``Not
    accepted`` counts as accepting, as in the reference)."""
    return F.contains(F.lower(decision), F.lit(word))


def accept_by_forum(notes: DataFrame, forum_col: str = "forum", decision_col: str = "decision") -> DataFrame:
    """A3: one row per forum, ``accepted`` = any note's decision accepts.
    Null decisions are ignored; a forum whose decisions are all null is not
    accepted."""
    return notes.groupBy(forum_col).agg(
        F.coalesce(F.bool_or(is_accepting(F.col(decision_col))), F.lit(False)).alias("accepted"),
        F.count("*").alias("n_notes"))


def present(c: Column) -> Column:
    """Presence as boolean (non-empty string)."""
    return F.coalesce(F.length(c) > 0, F.lit(False))
