"""P1 title query and J5 many-queries matching against the written rule."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quire.functions.query import matches_query, pieces_column, query_pieces
from quire.operators.matching import filter_by_query, match_queries


def rule(query: str, text: str) -> bool:
    """The reference rule, restated from its description."""
    for term in query.split(" AND "):
        term = term.strip('"')
        if not all(p in text for p in term.split("+")):
            return False
    return True


EDGE_QUERIES = ['"noisy labels"', "a+b", "a AND b", "a and b", "Noisy", "", "+", "c++", '"a"+"b"',
                "noisy  labels", "la+", 'x" AND "y']
EDGE_TITLES = ["Learning with Noisy Labels", "a b", "A and B", "c++ in practice", 'say "a"+"b" twice',
               "noisy  labels here", "line one\nline two", "", "x y", "labels"]


def test_pieces_literal_and_column_agree(spark):
    df = spark.createDataFrame([(q,) for q in EDGE_QUERIES], "q string")
    got = {r["q"]: list(r["p"]) for r in df.select("q", pieces_column(F.col("q")).alias("p")).collect()}
    for q in EDGE_QUERIES:
        assert got[q] == query_pieces(q), q


def test_edge_rows_match_rule(spark):
    rows = [(i, t) for i, t in enumerate(EDGE_TITLES)]
    df = spark.createDataFrame(rows, "id int, title string")
    for q in EDGE_QUERIES:
        got = {r["id"] for r in filter_by_query(df, q).collect()}
        want = {i for i, t in rows if rule(q, t.lower())}
        assert got == want, q


def test_capital_letter_never_matches(spark):
    df = spark.createDataFrame([("Noisy Labels",)], "title string")
    assert filter_by_query(df, "Noisy").count() == 0
    assert filter_by_query(df, "noisy").count() == 1


alphabet = st.sampled_from(list('ab +"ANDc'))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet, max_size=12), st.text(alphabet, max_size=12)), min_size=1, max_size=8))
def test_property_matches_rule(spark, pairs):
    df = spark.createDataFrame([(i, q, t) for i, (q, t) in enumerate(pairs)], "id int, q string, t string")
    pieces = df.select("id", "t", pieces_column(F.col("q")).alias("p"))
    got = {r["id"]: r["ok"] for r in pieces.select(
        "id", F.forall("p", lambda x: F.contains(F.col("t"), x)).alias("ok")).collect()}
    lits = spark.range(1).select(*[matches_query(F.lit(t), q).alias(f"c{i}") for i, (q, t) in enumerate(pairs)]).first()
    for i, (q, t) in enumerate(pairs):
        assert got[i] == rule(q, t), (q, t)
        assert lits[f"c{i}"] == rule(q, t), (q, t)


def test_match_queries_inline_index_and_brute_force(spark):
    titles = EDGE_TITLES + ["The Noisy Label Problem", "weak annotations for c", "partial labels and more"]
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "doc_id int, title string")
    qs = [(f"q{i}", q) for i, q in enumerate(EDGE_QUERIES + ["labels", "weak+annotations", "partial AND labels"])]
    queries = spark.createDataFrame(qs, "query_id string, query string")
    want = {(i, qid) for i, t in enumerate(titles) for qid, q in qs if rule(q, t.lower())}
    for strategy in ("inline", "index", "auto"):
        got = {(r["doc_id"], r["query_id"]) for r in
               match_queries(texts, queries, ["doc_id"], "title", strategy).select("doc_id", "query_id").collect()}
        assert got == want, strategy
