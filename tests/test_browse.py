"""X15 summary, X16 browse view, A5/O2 type-aware sort, A7 widths, J4 lookups."""

from pyspark.sql import functions as F

from quire import schemas
from quire.operators import browse as B


def test_summary_line_does_not_truncate(spark):
    df = spark.createDataFrame([("conf", 2021, "T"), ("proceedings", 1999, "U")], "venue string, year int, title string")
    assert [r[0] for r in df.select(B.summary_line()).collect()] == ["conf   ; 2021; T", "proceedings; 1999; U"]


def test_browse_view_and_widths(spark):
    rows = [("A long enough title", ["x", "y"], "v", 2020, None, "u", "a", None, True, [("l", 0.12345)], 1, 1),
            ("B", None, "venue", 2021, None, "u2", "a", None, False, [], 1, 2)]
    view = B.browse_view(spark.createDataFrame(rows, schemas.PAPERS))
    got = {r["Title"]: r for r in view.collect()}
    assert got["A long enough title"]["Similarity"] == 0.123 and got["B"]["Similarity"] == 0.0
    assert got["A long enough title"]["Authors"] == "x | y"
    w = {r["column"]: r["width"] for r in B.width_profile(view).collect()}
    assert w == {"Title": 8 * 19, "Venue": 80, "Accepted": 80, "Year": 80, "Similarity": 80, "Authors": 80, "URL": 80}


def test_type_aware_sort(spark):
    df = spark.createDataFrame([(1, "10"), (2, "9"), (3, "10"), (4, "100")], "id int, c string")
    num = {r["id"]: r["rank"] for r in B.type_aware_sort(df, "c", tie_col="id").collect()}
    assert num == {2: 1, 1: 2, 3: 3, 4: 4}
    txt = df.union(spark.createDataFrame([(5, "x")], "id int, c string"))
    t = {r["id"]: r["rank"] for r in B.type_aware_sort(txt, "c", tie_col="id").collect()}
    assert t == {1: 1, 3: 2, 4: 3, 2: 4, 5: 5}
    d = {r["id"]: r["rank"] for r in B.type_aware_sort(df, "c", descending=True, tie_col="id").collect()}
    assert d == {4: 1, 1: 2, 3: 3, 2: 4}


def test_lookup_missing_titles(spark):
    papers = spark.createDataFrame([("t", "abs", "@b")], "title string, abstract string, bibtex string")
    sel = spark.createDataFrame([("t",), ("missing",)], "title string")
    got = {r["title"]: (r["abstract"], r["bibtex"]) for r in B.lookup_by_title(sel, papers, ["abstract", "bibtex"]).collect()}
    assert got == {"t": ("abs", "@b"), "missing": ("", "")}
    assert B.bibtex_entries(papers.withColumn("run_seq", F.lit(1)).withColumn("pos", F.lit(1)).limit(0)).count() == 0


def test_authors_json(spark):
    df = spark.createDataFrame([(["José", "b"],), (None,), ([],)], "a array<string>")
    assert [r[0] for r in df.select(B.authors_json(F.col("a"))).collect()] == ['["José","b"]', None, "[]"]
