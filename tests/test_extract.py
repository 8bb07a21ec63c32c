"""X1-X10 on hand-written pages: JVM regex fields and the Python tree extractor."""

from pyspark.sql import functions as F

from quire.functions import html as H
from quire.operators import links as L
from quire.operators import nested as N

from pages import (LAYOUT_A, LAYOUT_A_EXPECTED, LAYOUT_B, LAYOUT_B_EXPECTED, LAYOUT_C,
                    LAYOUT_C_EXPECTED)


def _pages(spark, *htmls):
    return spark.createDataFrame([(i, f"https://site.example/p/{i}", h) for i, h in enumerate(htmls)],
                                 "page_id long, url string, html string")


def test_meta_fields_jvm(spark):
    df = _pages(spark, LAYOUT_A, LAYOUT_B, "<html><body>no metas</body></html>", None)
    m = F.col("html")
    rows = df.select("page_id", H.meta_content(m, "citation_title").alias("t"),
                     H.meta_contents(m, "citation_author").alias("a"),
                     F.substring(H.meta_content(m, "citation_publication_date"), 1, 4).alias("y"),
                     H.meta_content(m, "citation_pdf_url").alias("u")).orderBy("page_id").collect()
    a, b, none, null = rows
    assert a["t"] == LAYOUT_A_EXPECTED["title"] and a["a"] == LAYOUT_A_EXPECTED["authors"]
    assert a["y"] == "2021" and a["u"] == LAYOUT_A_EXPECTED["url_pdf"]
    assert b["t"] == "Quiet Gradients" and b["a"] == LAYOUT_B_EXPECTED["authors"] and b["y"] == "2019"
    assert none["t"] is None and none["a"] is None
    assert null["t"] is None


def test_nested_text_layout_a(spark):
    specs = [dict(name="abstract", tag="div", cls="abstract"),
             dict(name="bibtex", tag="code", cls="citecode", id="bibtex")]
    r = N.extract(_pages(spark, LAYOUT_A), specs, ["page_id"]).first()
    assert r["abstract"] == LAYOUT_A_EXPECTED["abstract"]
    assert r["bibtex"] == LAYOUT_A_EXPECTED["bibtex"]


def test_nested_text_layout_b_sibling_and_nested_p(spark):
    specs = [dict(name="abstract", tag="p", after=dict(tag="h4", text="Abstract")),
             dict(name="missing", tag="p", after=dict(tag="h4", text="Nope"))]
    r = N.extract(_pages(spark, LAYOUT_B), specs, ["page_id"]).first()
    assert r["abstract"] == LAYOUT_B_EXPECTED["abstract"]
    assert r["missing"] is None
    link = L.link_by_text(_pages(spark, LAYOUT_B), "Bibtex").first()["link"]
    assert link == "https://site.example" + LAYOUT_B_EXPECTED["bibtex_href"]


def test_layout_c_exact_class_and_accesskey(spark):
    specs = [dict(name="t", tag="h1", cls="title mathjax", take="rawtext"),
             dict(name="a", tag="div", cls="authors", take="rawtext"),
             dict(name="ab", tag="blockquote", cls="abstract mathjax", take="rawtext"),
             dict(name="pdf", tag="a", attrs={"accesskey": "f"}, take="attr:href")]
    df = N.extract(_pages(spark, LAYOUT_C), specs, ["page_id"])
    clean = lambda c, label: H.strip_ws(F.replace(F.replace(F.col(c), F.lit("\n"), F.lit(" ")), F.lit(label), F.lit("")))
    r = df.select(F.replace("t", F.lit("Title: "), F.lit("")).alias("t"), clean("a", "Authors:").alias("a"),
                  clean("ab", "Abstract: ").alias("ab"), "pdf").first()
    assert r["t"] == "Title:Tiny Transformers".replace("Title: ", "")
    assert r["a"] == LAYOUT_C_EXPECTED["authors"]
    assert r["ab"] == LAYOUT_C_EXPECTED["abstract"]
    assert r["pdf"] == LAYOUT_C_EXPECTED["pdf"]
    jvm = _pages(spark, LAYOUT_C).select(H.attr_of_first(F.col("html"), "a", "accesskey", "f", "href")).first()[0]
    assert jvm == LAYOUT_C_EXPECTED["pdf"]


def test_tree_rules_python():
    root = N.parse("<div class='x'><p>a<p>b</p>c</p><br>d</span>e</div><script>var x='<p>';</script>")
    div = N.find(root, dict(tag="div", cls="x"))
    assert N.text_of(div) == "abcde"
    assert N.find(root, dict(tag="p", text="abc")) is not None
    assert N.extract_fields(None, [dict(name="x", tag="p")]) == [None]


def test_links_and_frontier(spark):
    html = ('<a href="/rel/1">One &amp; two</a><a href="https://other.example/x">abs</a>'
            '<a name="anchor">no href</a><script>"<a href=/s>"</script><a class="x pagination-next" href="/p?page=2">Next</a>')
    pages = spark.createDataFrame([(1, "https://site.example/list?q=a", html)], "page_id long, url string, html string")
    links = L.page_links(pages).orderBy("pos").collect()
    assert [(r["href"], r["text"]) for r in links] == [
        ("/rel/1", "One & two"), ("https://other.example/x", "abs"), (None, "no href"), ("/p?page=2", "Next")]
    absl = [r["link"] for r in L.absolute_links(pages).orderBy("pos").collect()]
    assert absl == ["https://site.example/rel/1", "https://other.example/x", "https://site.example/p?page=2"]
    assert L.next_page(pages).first()["next_url"] == "https://site.example/p?page=2"
    known = spark.createDataFrame([("https://other.example/x",)], "url string")
    fr = {r["url"] for r in L.frontier(L.absolute_links(pages), known).collect()}
    assert fr == {"https://site.example/rel/1", "https://site.example/p?page=2"}
    ids = [r["link_id"] for r in L.prefixed_links(pages, "https://other.example/").collect()]
    assert ids == ["x"]


def test_listing_operators(spark):
    listing = ("<ul><li><a href='vol1/'>CONF 2020</a> Proceedings</li><li><a href='vol2/'>CONF Workshop</a></li>"
               "<li>CONF without link</li><li><a href='/paper_files/p1'>p1</a></li></ul>")
    vol = ('<div class="paper"><p class="title">Noisy Labels at Scale</p><a href="/v/a.html">abs</a></div>'
           '<div class="paper"><p class="title">Clean Data</p><a href="/v/b.html">abs</a></div>'
           '<div class="paper"><a href="/v/c.html">abs</a></div>')
    pages = spark.createDataFrame([(1, "https://site.example/", listing), (2, "https://site.example/v", vol)],
                                  "page_id long, url string, html string")
    l1 = [r["link"] for r in L.listing_items(pages.where("page_id = 1"), "CONF", "Workshop", "https://base.example/").collect()]
    assert l1 == ["https://base.example/vol1/"]
    l3 = [r["link"] for r in L.search_result_links(pages.where("page_id = 1"), "paper_files").collect()]
    assert l3 == ["https://site.example/paper_files/p1"]
    l2 = [(r["title"], r["link"]) for r in L.volume_links(pages.where("page_id = 2"), "noisy+labels").collect()]
    assert l2 == [("Noisy Labels at Scale", "/v/a.html")]
    # '' title (no p.title) matches only the empty query.
    assert L.volume_links(pages.where("page_id = 2"), "").count() == 3


def test_meta_reading_hazards(spark):
    """``>`` and name-like text in values, references, first of repeated attributes."""
    from quire.functions import html as H
    page = ('<meta content="O(n) -> O(1) sorting" name="t"><meta content="a name=z here" name="u">'
            "<META NAME=v CONTENT='Caf&eacute; &#233; &ndash; &#8217;x &amp;lt; &unknown; &#x1F600; AT&T'>"
            '<meta name="w" name="t" content="first">')
    row = spark.createDataFrame([(page,)], "html string").select(
        *[H.first_meta(H.meta_pairs(H.markup(F.col("html"))), n).alias(n) for n in "tuvw"]).first()
    assert row["t"] == "O(n) -> O(1) sorting" and row["u"] == "a name=z here" and row["w"] == "first"
    assert row["v"] == "Café é – ’x &lt; &unknown; 😀 AT&T"


def test_broken_markup_is_an_error(spark):
    fields, error = N.parsed_fields("<p>a</p><![broken]>", [dict(name="x", tag="p")])
    assert fields == [None] and error.startswith("AssertionError")
    assert N.parsed_fields("<p>a</p>", [dict(name="x", tag="p")]) == (["a"], None)
    got = N.extract(_pages(spark, "<p>a</p>", "<p>b</p><![broken]>", None), [dict(name="x", tag="p")], ["page_id"], error_col="why")
    rows = {r["page_id"]: (r["x"], r["why"] is None) for r in got.collect()}
    assert rows == {0: ("a", True), 1: (None, False), 2: (None, True)}


def test_extraction_takes_a_batch_in_slices_of_bounded_bytes(spark, monkeypatch):
    """Peak memory of a worker: whatever a batch holds, a few MB are parsed at
    a time, and every page comes out."""
    import pyarrow as pa

    from quire.functions.batches import byte_slices
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array(["x" * (1 << 20), None] * 20)], ["id", "html"])
    parts = list(byte_slices(batch, 1))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(40)) and len(parts) >= 5
    from quire.operators import nested as N
    df = spark.range(300).selectExpr("id", "if(id = 7, null, concat('<p>', repeat('y', 30000), id, '</p>')) as html")
    out = N.extract(df, [dict(name="p", tag="p")], ["id"], error_col="e")
    assert {(r["id"], None if r["p"] is None else r["p"].lstrip("y")) for r in out.collect()} == \
        {(k, None if k == 7 else str(k)) for k in range(300)}
