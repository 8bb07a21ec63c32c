"""The crawl over listings, and title queries below the Python pass."""

import random

import pytest
from pyspark.sql import functions as F

from quire.operators import crawl as W
from quire.operators import links as L
from quire.plans import collect as C
from quire.plans import standins as D

PAGE = "page_id long, url string, html string, venue string, kind string, year int, run_seq long, pos long, doc_id long"


def reach(edges, seeds):
    seen, todo = set(seeds), list(seeds)
    while todo:
        for a, b in edges.get(todo.pop(), ()):
            if b not in seen:
                seen.add(b)
                todo.append(b)
    return seen


@pytest.mark.parametrize("seed", range(3))
def test_reachable_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    steps = [(f"u{rng.randrange(60)}", f"u{rng.randrange(60)}") for _ in range(45)] + [(None, "u1"), ("u1", None)]
    chains = [(f"u{k}", f"u{k + 1}") for k in range(0, 30)] + [("u30", "u12"), ("u5", "u40"), ("u7", "u7")]
    seeds = [f"u{rng.randrange(60)}" for _ in range(2)] + ["nowhere"]
    edges = {}
    for a, b in steps + chains:
        if a is not None and b is not None:
            edges.setdefault(a, []).append((a, b))
    got = W.reachable(spark.createDataFrame(steps, "url string, link string"),
                      spark.createDataFrame([(s,) for s in [*seeds, None, seeds[0]]], "url string"),
                      spark.createDataFrame(chains, "url string, link string")).collect()
    assert sorted(r[0] for r in got) == sorted(reach(edges, seeds))
    none = spark.createDataFrame([], "url string, link string")
    assert [r[0] for r in W.reachable(none, spark.createDataFrame([("a",)], "url string"), none).collect()] == ["a"]


def test_long_listing_takes_few_rounds(spark, monkeypatch):
    chains = spark.range(600).select(F.concat(F.lit("p"), "id").alias("url"), F.concat(F.lit("p"), F.col("id") + 1).alias("link"))
    rounds = []
    empty = spark.createDataFrame([], "url string, link string")
    seeds = spark.createDataFrame([("p0",)], "url string")
    cls = type(seeds)
    real = cls.isEmpty
    monkeypatch.setattr(cls, "isEmpty", lambda df: rounds.append(df.columns) or real(df))
    assert W.reachable(empty, seeds, chains).count() == 601
    assert len([c for c in rounds if c == ["url"]]) <= 13


def docs(spark, n=260):
    rows = []
    for k in range(n):
        lang = ["en", "fr", "de", "es", "it", None][k % 6]
        words = ["Rare" if k % 97 == 5 else "Common", "Title", f"N{k}", 'a "b" & <c>']
        rows.append((k, " ".join(words) + f"\nabstract of {k}", lang, f"src{k % 4}", 40 + k % 35))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def site(spark):
    papers = D.documents_as_papers(docs(spark))
    labels = spark.range(260).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    pages = D.render_pages(papers, labels)
    listings = D.listing_pages(papers)
    pages = pages.unionByName(listings.select(*pages.columns)).checkpoint()
    return pages, spark.createDataFrame([(u,) for u in D.LISTING_SEEDS], "url string")


def test_every_language_has_pages(site):
    pages, _ = site
    assert pages.where("kind = 'detail'").select("doc_id").distinct().count() == 260
    assert pages.where("venue is null").count() == 0


def test_listings_lead_to_all_records(site):
    pages, seeds = site
    columns = ["doc_id", "venue", "title", "authors", "year", "url_pdf", "abstract", "bibtex", "accepted"]
    got = C.collect_from_listings(pages, seeds).select(*columns).collect()
    want = C.collect_records(pages).select(*columns).collect()
    assert len(got) == 260 and sorted(map(str, got)) == sorted(map(str, want))


def test_a_listing_without_its_first_page_leads_nowhere(spark, site):
    pages, _ = site
    some = spark.createDataFrame([(D.LISTING_SEEDS[1],), ("https://unknown.example.org/",)], "url string")
    got = C.collect_from_listings(pages, some)
    assert {r[0] for r in got.select("venue").distinct().collect()} == {"conference"}
    cut = pages.where(F.col("url") != "https://conference.example.org/papers/search?page=1")
    got = C.collect_from_listings(cut, some)
    assert got.agg(F.max("doc_id")).first()[0] < 100  # the second page is not there to lead on


def test_title_query_stays_below_the_python_pass(site):
    pages, seeds = site
    records = C.collect_from_listings(pages, seeds, "rare+title")
    assert sorted(r[0] for r in records.select("doc_id").collect()) == [5, 102, 199]
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    below = plan.split("MapInPandas")[1:]
    assert len(below) == 3
    for part in below:  # what feeds each extractor: title filter and join with the found urls
        assert "rare" in part and "LeftSemi" in part


def test_headings_that_the_jvm_cannot_cut(spark):
    """A nested or unclosed heading goes to the parser; the result is the same."""
    heads = ['<h1 class="title mathjax">Title: Rare one</h1>', '<h1 class="title mathjax">Title: <h1>x</h1> Rare two</h1>',
             '<h1 class="title mathjax">Title: Rare three', '<h1 class="title">Rare</h1>', '', '<h1 class="title mathjax">&#82;are four</h1>',
             "<H1 CLASS='title mathjax' id=x><b>Ra</b>re five</H1>", '<h1 class="title mathjax"></h1>Rare']
    rows = [(k, f"https://preprints.example.org/abs/2101.{k:05d}", f"<html>{h}<div class=authors>A</div></html>", "preprints", "detail",
             None, 1, k, k) for k, h in enumerate(heads)]
    pages = spark.createDataFrame(rows, PAGE)
    got = {r["doc_id"] for r in C.collect_records(pages, "rare", ["preprints"]).collect()}
    every = {r["doc_id"] for r in C.collect_records(pages, None, ["preprints"]).collect() if "rare" in (r["title"] or "").lower()}
    assert got == every == {0, 1, 2, 5, 6}


def test_next_notes(spark):
    url = "https://forum.example.org/notes?invitation=all&offset="
    rows = [(url + "0", '{"notes": [{"id": "a"}]}'), (url + "1000", '{"notes": []}'), (url + "x", '{"notes": [{"id": "b"}]}'),
            ("https://forum.example.org/notes?offset=5&z=1", '{"notes": [{"id": "a"}]}'), (url + "9", "no json")]
    got = L.next_notes(spark.createDataFrame(rows, "url string, html string"), 1000).collect()
    assert sorted(map(tuple, got)) == [("https://forum.example.org/notes?invitation=all&offset=0", url + "1000"),
                                       ("https://forum.example.org/notes?offset=5&z=1", "https://forum.example.org/notes?offset=1005")]


def test_found_pages_keep_their_partitions(spark, monkeypatch):
    """The semi-join with the found urls: few go to the pages without moving
    them; many meet them in partitions that aren't coalesced to a join's size."""
    from quire.plans import collect as C
    pages = spark.range(400).selectExpr("concat('u', id % 350) as url", "cast(id as string) as html")
    urls = spark.range(0, 300, 3).selectExpr("concat('u', id) as url").union(spark.sql("select cast(null as string)"))
    want = sorted((f"u{k % 350}", str(k)) for k in range(400) if k % 350 < 300 and k % 350 % 3 == 0)
    small = C._landed_at(pages, urls)
    assert sorted(map(tuple, small.collect())) == want
    assert "Exchange hashpartitioning" not in small._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(C, "string_side_fits", lambda *a: False)
    large = C._landed_at(pages, urls)
    assert sorted(map(tuple, large.collect())) == want
    assert large.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_each_tag_and_reference_is_cut_once(spark):
    from quire.functions import html as H
    page = """<meta name="a" content="x &amp; y &eacute;&#233;&#xE9; &bogus; &"><META content='1 > "2"' NAME=b><meta=q name=a content=second><meta name=c>"""
    df = spark.createDataFrame([(page,)], "html string").select(H.meta_pairs(H.markup(F.col("html"))).alias("m"))
    assert [tuple(x) for x in df.first()["m"]] == [("a", "x & y ééé &bogus; &"), ("b", '1 > "2"'), ("a", "second"), ("c", "")]
    one = H.meta_pairs(F.col("html"))._jc.toString()
    assert one.count("regexp_extract_all") <= 3, one  # the tags, then names and values once a tag
