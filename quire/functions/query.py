"""Title query (P1): ``a AND "b c"+d`` style boolean substring queries.

Rule: split the query on the literal `` AND ``; strip double quotes from both
ends of each term; split each term on ``+``; every piece must be a substring of
the text. Matching is case-sensitive on the query side: callers lowercase the
text, never the query, so a capital letter in a query matches nothing. An
empty piece (empty query, a lone or trailing ``+``) always matches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the query grammar.
TERM_SEPARATOR = " AND "
PIECE_SEPARATOR = "+"
QUOTE = '"'


def query_pieces(query: str) -> list[str]:
    """Pieces of one query, in order (driver side, for a literal query)."""
    return [p for term in query.split(TERM_SEPARATOR) for p in term.strip(QUOTE).split(PIECE_SEPARATOR)]


def matches_query(text: Column, query: str) -> Column:
    """Boolean column: every piece of the literal ``query`` occurs in ``text``."""
    conds = [F.contains(text, F.lit(p)) for p in query_pieces(query)]
    return reduce(lambda a, b: a & b, conds)


def pieces_column(query: Column) -> Column:
    """Array of pieces of a query held in a column (same rule, JVM side)."""
    terms = F.split(query, TERM_SEPARATOR, -1)
    return F.flatten(F.transform(terms, lambda t: F.split(F.btrim(t, F.lit(QUOTE)), r"\+", -1)))
