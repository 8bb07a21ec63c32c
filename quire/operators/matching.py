"""Title query filter (P1) and many-queries matching.

Two plans for a table of queries:

* ``inline``: the query table is small (size checked on the driver), so every
  query becomes one boolean expression and each text row yields the array of
  the query ids it satisfies, exploded. One narrow pass, no join, no shuffle.
* ``index``: for a query table of any size. Texts explode their character
  n-grams (n = 1..3, only the lengths in use) with the text window that
  follows; pieces are keyed by their first three characters; the two meet in
  an equi-join. A candidate is verified by ``startswith(window, piece)`` and
  a (row, query) pair is kept when every non-empty piece of the query was
  verified. Hot n-grams are split by AQE's skew-join handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.query import matches_query, pieces_column
from .bounds import string_side_fits

# Largest query table compiled into one expression.
INLINE_QUERY_LIMIT = 256
# Longest n-gram used as a join anchor.
ANCHOR_LEN = 3


def filter_by_query(df: DataFrame, query: str, text_col: str = "title", lowered_col: str | None = None) -> DataFrame:
    """Rows whose lowercased ``text_col`` matches ``query``.

    ``lowered_col`` names a stored, already-lowercased copy of the text: the
    filter then reads it directly, and Parquet gets the pieces as pushed
    ``StringContains`` filters (they cannot be pushed through ``lower``)."""
    text = F.col(lowered_col) if lowered_col else F.lower(F.col(text_col))
    return df.where(matches_query(text, query))


def query_pieces(queries: DataFrame) -> DataFrame:
    """(query_id, piece_idx, piece) for every piece of every query."""
    return queries.select("query_id", F.posexplode(pieces_column(F.col("query"))).alias("piece_idx", "piece"))


def match_queries(texts: DataFrame, queries: DataFrame, key_cols: list[str], text_col: str = "title",
                  strategy: str = "auto") -> DataFrame:
    """All (text row, query_id) pairs where the lowercased text matches the query.

    ``queries`` has columns ``query_id`` and ``query``; equal queries are
    matched once. ``key_cols`` must identify a row and come out alike each time
    ``texts`` is evaluated. Output: the columns of ``texts`` plus ``query_id``.
    """
    ids = queries.select(F.col("query_id").alias("_id"), "query")
    distinct = queries.select("query").distinct().withColumn("query_id", F.col("query"))
    hits = _match_distinct(texts, distinct, key_cols, text_col, strategy).withColumnRenamed("query_id", "_query")
    return hits.join(ids, F.col("_query") == ids["query"]).select(*texts.columns, F.col("_id").alias("query_id"))


def _match_distinct(texts: DataFrame, queries: DataFrame, key_cols: list[str], text_col: str,
                    strategy: str) -> DataFrame:
    if strategy == "auto":
        n = queries.count()
        strategy = "inline" if n <= INLINE_QUERY_LIMIT else "index"
    if strategy == "inline":
        return _match_inline(texts, queries, text_col)
    if strategy == "index":
        return _match_index(texts, queries, key_cols, text_col)
    raise ValueError(f"unknown strategy {strategy!r}")


def _match_inline(texts: DataFrame, queries: DataFrame, text_col: str) -> DataFrame:
    rows = queries.select("query_id", "query").collect()  # small, or the caller chose this plan
    if not rows:
        return texts.withColumn("query_id", F.lit(None).cast("string")).limit(0)
    low = F.lower(F.col(text_col))
    hits = F.array_compact(F.array(*[F.when(matches_query(low, r["query"]), F.lit(r["query_id"])) for r in rows]))
    return texts.withColumn("query_id", F.explode(hits))


def _text_grams(keyed: DataFrame, key_cols: list[str], lengths: list[int], window: int) -> DataFrame:
    """(keys, anchor, window) for every position of ``_t`` and every anchor
    length in use. ``window`` is the text from that position, as long as the
    longest piece: one native regex pass (a lookahead capture at every
    position) cuts all windows, so no row carries the whole text and no
    per-position lambda runs."""
    wins = F.regexp_extract_all(F.col("_t"), F.lit(f"(?s)(?=(.{{1,{window}}}))"), 1)
    pos = keyed.select(*key_cols, F.explode(wins).alias("window"))
    anchors = F.array(*[F.when(F.length("window") >= k, F.substring("window", 1, k)) for k in lengths])
    return pos.select(*key_cols, "window", F.explode(anchors).alias("anchor")).where(F.col("anchor").isNotNull())


def _match_index(texts: DataFrame, queries: DataFrame, key_cols: list[str], text_col: str) -> DataFrame:
    pieces = query_pieces(queries).withColumn("anchor", F.substring("piece", 1, ANCHOR_LEN))
    nonempty = pieces.where(F.length("piece") > 0)
    need = pieces.groupBy("query_id").agg(
        F.count(F.when(F.length("piece") > 0, True)).alias("n_need"))
    stats = nonempty.agg(F.collect_set(F.length("anchor")).alias("lens"), F.max(F.length("piece")).alias("w"),
                         F.count("*").alias("n")).first()
    lengths, window = sorted(stats["lens"] or []), int(stats["w"] or 0)
    # The pieces are the build side: broadcast when an aggregate proves them
    # small, otherwise a shuffled hash join built on them. Never let the
    # optimizer broadcast the exploded text side (its size estimate ignores
    # the explode).
    build = F.broadcast(nonempty) if string_side_fits(nonempty, ["piece", "anchor", "query_id"]) \
        else nonempty.hint("shuffle_hash")

    keyed = texts.select(*key_cols, F.lower(F.col(text_col)).alias("_t"))
    if lengths:
        # A piece occurs iff the text, at some position where its anchor
        # occurs, starts with the piece.
        cands = _text_grams(keyed, key_cols, lengths, window).join(build, "anchor") \
            .where(F.startswith(F.col("window"), F.col("piece")))
        verified = (cands.select(*key_cols, "query_id", "piece_idx").distinct()
                    .groupBy(*key_cols, "query_id").agg(F.count("*").alias("n_hit")))
        hit = verified.join(need, "query_id").where(F.col("n_hit") == F.col("n_need")).select(*key_cols, "query_id")
    else:
        hit = keyed.select(*key_cols).withColumn("query_id", F.lit(None).cast("string")).limit(0)

    # Queries made only of empty pieces match every row.
    # (Their distinct spellings are few; the rows they make are the result itself.)
    ids = [r[0] for r in need.where(F.col("n_need") == 0).select("query_id").collect()]
    out = texts.join(hit, key_cols)
    if ids:
        out = out.unionByName(texts.withColumn("query_id", F.explode(F.array(*[F.lit(i) for i in ids]))))
    return out
