"""Browse: display projection (X16), one-line summary (X15), type-aware sort
(A5, O2), column widths (A7), lookups by title (J4) and BibTeX entries (A6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import global_rank

# Fixed values of the browse table: headings in display order, minimum column
# width, pixels per character, and the columns that keep the minimum width.
COLUMNS = ["Title", "Venue", "Accepted", "Year", "Similarity", "Authors", "URL"]
MIN_WIDTH = 10
PIXELS_PER_CHAR = 8
FIXED_WIDTH = {"URL", "Authors"}


def summary_line(venue: Column | None = None, year: Column | None = None, title: Column | None = None) -> Column:
    """Venue left-justified to 7 (never truncated), year, title."""
    return F.format_string("%-7s; %d; %s", venue if venue is not None else F.col("venue"),
                           year if year is not None else F.col("year"),
                           title if title is not None else F.col("title"))


def first_score(similarities: Column) -> Column:
    """Score of the first entry of the score list, 0 when there is none."""
    return F.coalesce(F.try_element_at(similarities, F.lit(1))["score"], F.lit(0.0))


def browse_view(papers: DataFrame) -> DataFrame:
    """The seven browse columns; similarity rounded to 3 decimals for
    display (sorting uses the full score, see :func:`type_aware_sort`)."""
    return papers.select(
        F.col("title").alias("Title"), F.col("venue").alias("Venue"), F.col("accepted").alias("Accepted"),
        F.col("year").alias("Year"), F.round(first_score(F.col("similarities")), 3).alias("Similarity"),
        F.array_join("authors", " | ").alias("Authors"), F.col("url_pdf").alias("URL"))


def display_text(view: DataFrame) -> dict[str, Column]:
    """Text shown per column (booleans as stored integers, score with 3 decimals)."""
    return {
        "Title": F.col("Title"), "Venue": F.col("Venue"),
        "Accepted": F.when(F.col("Accepted"), F.lit("1")).otherwise(F.lit("0")),
        "Year": F.col("Year").cast("string"),
        "Similarity": F.format_string("%.3f", F.col("Similarity")),
        "Authors": F.col("Authors"), "URL": F.col("URL"),
    }


def width_profile(view: DataFrame) -> DataFrame:
    """Width per column = 8 x max(len(heading), 10, longest text); URL and
    Authors keep max(len(heading), 10). One aggregate pass, one row per column."""
    text = display_text(view)
    aggs = []
    for c in COLUMNS:
        base = max(len(c), MIN_WIDTH)
        if c in FIXED_WIDTH:
            w = F.lit(base)
        else:
            w = F.greatest(F.lit(base), F.coalesce(F.max(F.length(text[c])), F.lit(0)))
        aggs.append((w * F.lit(PIXELS_PER_CHAR)).cast("bigint").alias(c))
    row = view.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}`" for c in COLUMNS)
    return row.selectExpr(f"stack({len(COLUMNS)}, {stack}) AS (`column`, width)")


def is_numeric_column(df: DataFrame, col: str) -> bool:
    """A5: does every value of ``col`` parse as a number? (one aggregate)"""
    row = df.agg((F.count(F.lit(1)) == F.count(F.col(col).try_cast("double"))).alias("ok")).first()
    return bool(row["ok"])


def type_aware_sort(df: DataFrame, col: str, descending: bool = False, tie_col: str = "pos",
                    rank_col: str = "rank") -> DataFrame:
    """O2: rank rows by ``col`` as numbers when every value is numeric,
    otherwise as text; ties by ``tie_col``. Distributed ranking."""
    key = F.col(col).try_cast("double") if is_numeric_column(df, col) else F.col(col)
    key = key.desc() if descending else key.asc()
    return global_rank(df, [key, F.col(tie_col).asc()], rank_col)


def numeric_columns(df: DataFrame, cols: list[str]) -> set[str]:
    """A5 for several columns, in one aggregate."""
    if not cols:
        return set()
    row = df.agg(*((F.count(F.lit(1)) == F.count(F.col(c).try_cast("double"))).alias(c) for c in cols)).first()
    return {c for c in cols if row[c]}


def sorted_by_clicks(df: DataFrame, clicks: list[tuple[str, bool]], id_col: str, rank_col: str = "rank") -> DataFrame:
    """O2 as it is used: one sort after another, each (column, descending), on
    the order that the one before left. A numeric column keeps that order among
    equal numbers; a text column orders equal texts by ``id_col``, downwards if
    the sort is. The first order is that of ``id_col``.

    The whole chain is one key: from the last click back, each numeric sort is
    followed by the one before it, a text sort ends the chain. So it takes one
    distributed sort, of the id and the keys alone. Result: id and rank."""
    numeric = numeric_columns(df, sorted({c for c, _ in clicks}))
    keys: list[Column] = []
    cols: list[Column] = []
    for k, (c, down) in enumerate(reversed(clicks)):
        cols.append((F.col(c).try_cast("double") if c in numeric else F.col(c)).alias(f"_{k}"))
        keys.append(F.col(f"_{k}").desc() if down else F.col(f"_{k}").asc())
        if c not in numeric:
            keys.append(F.col(id_col).desc() if down else F.col(id_col).asc())
            break
    else:
        keys.append(F.col(id_col).asc())
    return global_rank(df.select(id_col, *cols), keys, rank_col).select(id_col, rank_col)


def lookup_by_title(selection: DataFrame, papers: DataFrame, cols: list[str]) -> DataFrame:
    """For each selected title, the requested fields, '' when the title is
    unknown (left join; papers are unique per title)."""
    right = papers.select("title", *cols)
    out = selection.join(right, "title", "left")
    return out.select(*selection.columns, *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in cols])


def bibtex_entries(selected: DataFrame) -> DataFrame:
    """A6 as rows: the entry of each selected paper ('' when missing), with its
    arrival order; :func:`quire.sources.store.export_bibtex` writes them
    joined by blank lines."""
    return selected.select("run_seq", "pos", "title", F.coalesce(F.col("bibtex"), F.lit("")).alias("entry"))


def authors_json(authors: Column) -> Column:
    """The author list as JSON text for export (arrays stay arrays in the
    table; ``to_json`` writes ``["José","b"]``, not Python's escaped form)."""
    return F.to_json(authors)
