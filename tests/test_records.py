"""P2 validity, P4 rejects, P3 field quality, P7/A3 accept flags, X11 ids."""

from pyspark.sql import functions as F

from quire import schemas
from quire.functions.ids import preprint_url_and_year
from quire.operators import records as R


def _rec(spark, **kw):
    base = dict(title="T", authors=["A"], venue="v", year_text="2023", bibtex="@b", url_pdf="u",
                abstract="x", accepted=True, url="page")
    base.update(kw)
    row = [base[k] for k in ["title", "authors", "venue", "year_text", "bibtex", "url_pdf", "abstract", "accepted", "url"]]
    df = spark.createDataFrame([row], "title string, authors array<string>, venue string, year_text string, "
                                      "bibtex string, url_pdf string, abstract string, accepted boolean, url string")
    return R.assemble(df, title=F.col("title"), authors=F.col("authors"), venue=F.col("venue"),
                      year=F.col("year_text"), bibtex=F.col("bibtex"), url_pdf=F.col("url_pdf"),
                      abstract=F.col("abstract"), accepted=F.col("accepted"), run_seq=1, pos=1, extra=["url"])


def _reason(spark, **kw):
    r = R.classify(_rec(spark, **kw)).first()
    return r["reason"], list(r["missing"])


def test_valid_record(spark):
    assert _reason(spark) == (None, [])


def test_each_field_null_or_empty(spark):
    for f in ["title", "venue", "bibtex", "url_pdf", "abstract"]:
        assert _reason(spark, **{f: None}) == ("invalid", [f]), f
        assert _reason(spark, **{f: ""}) == ("invalid", [f]), f
    assert _reason(spark, authors=None) == ("invalid", ["authors"])


def test_whitespace_passes_and_accepted_not_required(spark):
    assert _reason(spark, title="   ", abstract=" ") == (None, [])
    assert _reason(spark, accepted=None) == (None, [])


def test_empty_author_list_is_valid(spark):
    # Only the JSON-notes layout produces empty lists; the reference keeps them.
    assert _reason(spark, authors=[]) == (None, [])


def test_year_rules(spark):
    assert _reason(spark, year_text="0") == ("invalid", ["year"])
    assert _reason(spark, year_text=" 2023 ")[0] is None
    for bad in ["2023x", "2023.5", None, ""]:
        assert _reason(spark, year_text=bad)[0] == "error", bad


def test_split_valid_and_counts(spark):
    recs = _rec(spark).unionByName(_rec(spark, abstract="")).unionByName(_rec(spark, year_text="n.d."))
    valid, rejects = R.split_valid(recs)
    assert valid.count() == 1 and valid.columns == schemas.PAPER_COLUMNS
    got = {r["reason"]: r["n"] for r in R.reject_counts(rejects).collect()}
    assert got == {"invalid": 1, "error": 1}


def test_field_quality(spark):
    recs = _rec(spark).unionByName(_rec(spark, abstract="", authors=None, year_text="x"))
    q = {r["field"]: r for r in R.field_quality(recs).collect()}
    assert q["abstract"]["n_blank"] == 1 and q["authors"]["n_null"] == 1
    assert q["year"]["n_null"] == 1 and q["year"]["n_badcast"] == 1 and q["title"]["n_rows"] == 2


def test_accept_flags(spark):
    notes = spark.createDataFrame(
        [("f1", "Accept (Poster)"), ("f1", "Reject"), ("f2", "Reject"), ("f3", "Not accepted"), ("f4", None),
         ("f5", None), ("f5", "ACCEPT")], "forum string, decision string")
    got = {r["forum"]: r["accepted"] for r in R.accept_by_forum(notes).collect()}
    assert got == {"f1": True, "f2": False, "f3": True, "f4": False, "f5": True}


def test_presence_flag(spark):
    df = spark.createDataFrame([("x",), ("",), (None,)], "u string")
    assert [r[0] for r in df.select(R.present(F.col("u"))).collect()] == [True, False, False]


def test_preprint_ids(spark):
    cases = {"2301.00001v2": ("2023", "abs/2301.00001v2"), "0704.0001": ("2007", "abs/0704.0001"),
             "9901001": ("1999", "abs/cs/9901001"), "0601001": ("2006", "abs/cs/0601001"),
             "0801001": ("1908", "abs/cs/0801001"), "ab01001": (None, "abs/cs/ab01001")}
    df = spark.createDataFrame([(k,) for k in cases], "pid string")
    for r in df.select("pid", preprint_url_and_year(F.col("pid")).alias("u")).collect():
        year, tail = cases[r["pid"]]
        assert r["u"]["year"] == year, r["pid"]
        assert r["u"]["url"].endswith(tail), r["pid"]
