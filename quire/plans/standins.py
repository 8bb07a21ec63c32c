"""Stand-ins: records, profiles and landed pages derived from the driver tables.

The reference reads live sites; here everything is derived by Spark from the
given tables, so every job grows with them.

A paper from ``documents``: title = first line of ``text``; abstract = the
rest ('' for one-line documents, which makes them invalid); authors = the
title's words that start with an upper-case letter (null when none); venue =
``source``; year = 1990 + n_chars mod 35; pdf url and bibtex built from the
id, title and year; run = the number in ``source``; arrival position =
``doc_id``.

Landed pages rendered from those papers, by ``lang``:
  en  proceedings layout: named ``meta`` tags (attribute order varies),
      ``div.abstract`` with padded text, ``code.citecode#bibtex`` after a decoy
  fr  conference layout: ``meta`` tags, ``h4`` Abstract + nested ``p``, a
      padded ``Bibtex`` link to a plain-text bibtex page, landed only for
      documents that have a ``labels`` row
  de  preprint layout: ``h1.title.mathjax``, ``div.authors``,
      ``blockquote.abstract.mathjax``, ``a[accesskey=f]``; the page id encodes
      the year (old ``yymmnnn`` ids before 2007)
  es  forum layout: the record as JSON in a ``script`` element plus a JSON
      notes reply whose decisions come from ``labels`` (no ``notes`` key when
      the document has no label)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import html as H
from ..functions.ids import preprint_url_and_year
from ..session import table_path

SCORES = schemas.PAPERS["similarities"].dataType

# Fixed values of the stand-in sites.
HOSTS = {
    "en": "https://proceedings.example.org",
    "fr": "https://conference.example.org",
    "de": "https://preprints.example.org",
    "es": "https://forum.example.org",
}
VENUES = {"en": "proceedings", "fr": "conference", "de": "preprints", "es": "forum"}
PREPRINT_ABS = HOSTS["de"] + "/abs/"
# Notes per JSON reply page (the listing API's offset step).
REPLY_PAGE = 1000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def first_line(text: Column) -> Column:
    return F.substring_index(text, "\n", 1)


def rest_after_first_line(text: Column) -> Column:
    i = F.instr(text, "\n")
    return F.when(i > 0, F.substr(text, i + 1)).otherwise(F.lit(""))


def capitalised_words(title: Column) -> Column:
    words = F.filter(F.split(title, " ", -1), lambda w: (w != "") & (F.substring(w, 1, 1) != F.lower(F.substring(w, 1, 1))))
    return F.when(F.size(words) > 0, words)


def documents_as_papers(docs: DataFrame) -> DataFrame:
    """doc_id, lang + paper fields (authors as array, year as text and int)."""
    title = first_line(F.col("text"))
    year = (F.lit(1990) + F.pmod(F.col("n_chars"), F.lit(35))).cast("int")
    d = docs.select("doc_id", "lang", "source", "text", "n_chars",
                    title.alias("title"), year.alias("year"))
    return d.select(
        "doc_id", "lang",
        F.col("title"),
        rest_after_first_line(F.col("text")).alias("abstract"),
        capitalised_words(F.col("title")).alias("authors"),
        F.col("source").alias("venue"),
        F.col("year"),
        F.col("year").cast("string").alias("year_text"),
        F.concat(F.lit("https://papers.example.org/"), F.col("source"), F.lit("/"),
                 F.col("doc_id").cast("string"), F.lit(".pdf")).alias("url_pdf"),
        F.concat(F.lit("@inproceedings{doc"), F.col("doc_id").cast("string"), F.lit(",\n  title = {"),
                 F.col("title"), F.lit("},\n  year = {"), F.col("year").cast("string"), F.lit("}\n}")).alias("bibtex"),
        F.lit(True).alias("accepted"),
        F.lit(None).cast("string").alias("query_term"),
        F.array().cast(SCORES).alias("similarities"),
        F.regexp_extract(F.col("source"), r"(\d+)$", 1).cast("bigint").alias("run_seq"),
        F.col("doc_id").alias("pos"),
    )


def benchmark_as_papers(bench: DataFrame) -> DataFrame:
    """A second, earlier run: benchmark passages as papers (run 0, venue
    'benchmark'). Their first lines can collide with document titles."""
    title = first_line(F.col("text"))
    return bench.select(
        F.col("item_id").alias("doc_id"), F.lit("bench").alias("lang"),
        title.alias("title"), rest_after_first_line(F.col("text")).alias("abstract"),
        capitalised_words(title).alias("authors"), F.lit("benchmark").alias("venue"),
        F.lit(2000).alias("year"), F.lit("2000").alias("year_text"),
        F.concat(F.lit("https://papers.example.org/benchmark/"), F.col("item_id").cast("string"),
                 F.lit(".pdf")).alias("url_pdf"),
        F.concat(F.lit("@misc{bench"), F.col("item_id").cast("string"), F.lit("}")).alias("bibtex"),
        F.lit(True).alias("accepted"), F.lit(None).cast("string").alias("query_term"),
        F.array().cast(SCORES).alias("similarities"), F.lit(-1).cast("bigint").alias("run_seq"), F.col("item_id").alias("pos"))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence lists: 'benchmark' = benchmark passages weighted by length/100;
    'system' = system turns of conversations, weight 1."""
    bench = read(spark, sf_dir, "benchmark").select(
        F.lit("benchmark").alias("list_name"), F.col("item_id").cast("int").alias("pos"),
        (F.length("text") / F.lit(100.0)).alias("weight"), F.col("text").alias("sentence"))
    conv = read(spark, sf_dir, "conversations").where(F.col("role") == "system").select(
        F.lit("system").alias("list_name"), F.col("conv_id").cast("int").alias("pos"),
        F.lit(1.0).alias("weight"), F.col("text").alias("sentence"))
    return bench.unionByName(conv)


def stored_vector_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists over stored vectors: one list per embedding label; the sentence key
    is the vector id; weight = 1 + vec_id mod 4 (unequal weights)."""
    emb = read(spark, sf_dir, "embeddings")
    return emb.select(F.concat(F.lit("label_"), F.col("label").cast("string")).alias("list_name"),
                      F.col("vec_id").cast("int").alias("pos"),
                      (F.lit(1.0) + F.pmod(F.col("vec_id"), F.lit(4))).alias("weight"),
                      F.col("vec_id").cast("string").alias("key"))


def stored_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("key"), "embedding")


# --- rendered pages ----------------------------------------------------------

def padded(n: Column, width: int) -> Column:
    text = n.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def preprint_id(year: Column, doc_id: Column) -> Column:
    """An id that encodes the year: ``yymm.nnnnn`` from 2007, ``yymmnnn``
    before; longer numbers stay whole."""
    yy = F.lpad(F.pmod(year, F.lit(100)).cast("string"), 2, "0")
    new = F.concat(yy, F.lit("01."), padded(doc_id, 5))
    old = F.concat(yy, F.lit("01"), padded(doc_id, 3))
    return F.when(year >= 2007, new).otherwise(old)


def site_lang(lang: Column) -> Column:
    """The layout of a language: those without one of their own take the forum's."""
    return F.when(lang.isin("en", "fr", "de"), lang).otherwise(F.lit("es"))


def damage_pages(pages: DataFrame) -> DataFrame:
    """Landed pages with the damage that sites show, by id: raw years that are
    no numbers, markup that breaks the parser, embedded JSON that is cut off
    or of another type."""
    k, html, venue = F.col("doc_id"), F.col("html"), F.col("venue")
    detail, forum = F.col("kind") == "detail", venue == "forum"
    year = F.regexp_replace(html, r"[0-9]{3}([0-9])(/01/15|-06-01)", "20x$1$2")
    return pages.withColumn(
        "html", F.when(detail & forum & (k % 5 == 1), F.regexp_replace(html, r"(?s)\}[^}]*</script>.*$", "</script>"))
        .when(detail & forum & (k % 5 == 2), F.regexp_replace(html, r'(?s)"authors":\[[^\]]*\]', '"authors":{"first":1}'))
        .when(detail & ~forum & (k % 7 == 3), F.concat(html, F.lit("<![broken]>")))
        .when(detail & ~forum & (k % 7 == 4), year).otherwise(html))


def _meta(name: str, value: Column, content_first: Column) -> Column:
    # As page writers do: ``>`` stays in attributes, accents as named and
    # numeric references, text that looks like another attribute before it.
    v = F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit('"'), F.lit("&quot;"))
    for char, ref in (("é", "&eacute;"), ("è", "&#232;"), ("ñ", "&#xF1;"), ("ü", "&uuml;")):
        v = F.replace(v, F.lit(char), F.lit(ref))
    a = F.concat(F.lit(f'<meta data-note="a > b name=x content=y" name="{name}" content="'), v, F.lit('">'))
    b = F.concat(F.lit("<meta content='"), F.replace(v, F.lit("'"), F.lit("&#39;")), F.lit(f"' NAME={name}>"))
    return F.when(content_first, b).otherwise(a)


def _metas(name: str, values: Column, content_first: Column) -> Column:
    return F.array_join(F.transform(F.coalesce(values, F.array().cast("array<string>")),
                                    lambda v: _meta(name, v, content_first)), "\n")


def render_pages(papers: DataFrame, labels: DataFrame) -> DataFrame:
    """Landed pages (page_id, url, html, venue, kind, year, run_seq, pos,
    doc_id) for the
    stand-in papers: detail pages of the four layouts, bibtex pages and notes
    replies."""
    p = papers.join(labels.select("doc_id", "quality", "toxic", F.lit(True).alias("_lab")), "doc_id", "left")
    odd = F.pmod(F.col("doc_id"), F.lit(2)) == 1
    esc = H.escape
    year_s = F.col("year").cast("string")

    # en: proceedings layout
    en_url = F.concat(F.lit(HOSTS["en"] + "/v"), F.col("run_seq").cast("string"), F.lit("/doc"),
                      F.col("doc_id").cast("string"), F.lit(".html"))
    en_html = F.concat(
        F.lit("<!DOCTYPE html>\n<html><head><meta charset=\"utf-8\">\n"),
        F.lit("<script>var note = \"<meta name='citation_title' content='decoy'>\";</script>\n"),
        _meta("citation_title", F.col("title"), odd), F.lit("\n"),
        _metas("citation_author", F.col("authors"), odd), F.lit("\n"),
        _meta("citation_publication_date", F.concat(year_s, F.lit("/01/15")), ~odd), F.lit("\n"),
        _meta("citation_pdf_url", F.col("url_pdf"), odd), F.lit("\n"),
        F.lit("<title>"), esc(F.col("title")), F.lit("</title></head>\n<body><div id=\"content\">\n"),
        F.lit("<div class=\"abstract\">\n        "), esc(F.col("abstract")), F.lit("\n      </div>\n"),
        F.lit("<code class=\"citecode\" id=\"endnote\">%0 Conference Paper</code>\n"),
        F.lit("<code class=\"citecode\" id=\"bibtex\">\n"), esc(F.col("bibtex")), F.lit("\n</code>\n"),
        F.lit("<code class=\"citecode\" id=\"apa\">APA entry</code>\n</div></body></html>\n"))

    # fr: conference layout; bibtex on a separate page
    fr_url = F.concat(F.lit(HOSTS["fr"] + "/paper/doc"), F.col("doc_id").cast("string"), F.lit("-Abstract.html"))
    fr_bib_href = F.concat(F.lit("/bibtex/doc"), F.col("doc_id").cast("string"), F.lit(".bib"))
    fr_html = F.concat(
        F.lit("<html><head>\n"),
        _meta("citation_title", F.col("title"), ~odd), F.lit("\n"),
        _metas("citation_author", F.col("authors"), ~odd), F.lit("\n"),
        _meta("citation_pdf_url", F.col("url_pdf"), odd), F.lit("\n"),
        _meta("citation_publication_date", F.concat(year_s, F.lit("-06-01")), odd), F.lit("\n"),
        F.lit("</head><body><div class=\"container\">\n<h4>\n  Title\n</h4>\n<h4>Authors</h4>\n"),
        F.lit("<div><a href=\"/paper/x.pdf\">Paper</a>\n<a class=\"btn\" href=\""), fr_bib_href,
        F.lit("\">\n    Bibtex\n   </a>\n<a href=\"/supp/x.zip\">Supplemental</a></div>\n"),
        F.lit("<h4>\n    Abstract\n   </h4>\n<p>\n<p>"), esc(F.col("abstract")), F.lit("</p>\n</p>\n"),
        F.lit("</div></body></html>\n"))

    # de: preprint layout
    pid = preprint_id(F.col("year"), F.col("doc_id"))
    de_url = preprint_url_and_year(pid, PREPRINT_ABS)["url"]
    de_html = F.concat(
        F.lit("<html><head><title>"), esc(F.col("title")), F.lit("</title></head><body>\n"),
        F.lit("<h1 class=\"title\">decoy</h1>\n"),
        F.lit("<h1 class=\"title mathjax\"><span class=\"descriptor\">Title:</span> "), esc(F.col("title")), F.lit("</h1>\n"),
        F.lit("<div class=\"authors\"><span class=\"descriptor\">Authors:</span>"),
        F.array_join(F.transform(F.coalesce(F.col("authors"), F.array().cast("array<string>")),
                                 lambda a: F.concat(F.lit("<a href=\"/a/x\">"), esc(a), F.lit("</a>"))), ", "),
        F.lit("</div>\n<blockquote class=\"abstract mathjax\">\n<span class=\"descriptor\">Abstract:</span> "),
        esc(F.col("abstract")), F.lit("\n</blockquote>\n"),
        F.lit("<ul><li><a href=\"/pdf/"), pid, F.lit("\" accesskey=\"f\">PDF</a></li></ul>\n</body></html>\n"))

    # es: forum page with embedded JSON
    fid = F.concat(F.lit("f"), F.col("doc_id").cast("string"))
    note = F.struct(fid.alias("id"), F.struct(
        F.col("title").alias("title"), F.coalesce(F.col("authors"), F.array().cast("array<string>")).alias("authors"),
        F.col("bibtex").alias("_bibtex"), F.concat(F.lit("/pdf?id="), fid).alias("pdf"),
        F.col("abstract").alias("abstract")).alias("content"))
    data = F.to_json(F.struct(F.struct(F.struct(note.alias("forumNote")).alias("pageProps")).alias("props")))
    es_url = F.concat(F.lit(HOSTS["es"] + "/forum?id="), fid)
    es_html = F.concat(F.lit("<html><head><title>forum</title></head><body><div id=\"root\"></div>\n"),
                       F.lit("<script id=\"__NEXT_DATA__\" type=\"application/json\">"), data,
                       F.lit("</script>\n</body></html>\n"))

    decision = F.when(F.col("quality") == 1, F.lit("Accept (Poster)")) \
        .when(F.col("toxic") == 1, F.lit("Not accepted")).otherwise(F.lit("Reject"))
    notes = F.array(
        F.struct(F.concat(fid, F.lit("-c")).alias("id"), fid.alias("forum"),
                 F.struct(F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("decision")).alias("content")),
        F.struct(F.concat(fid, F.lit("-d")).alias("id"), fid.alias("forum"),
                 F.struct(F.lit(None).cast("string").alias("title"), decision.alias("decision")).alias("content")))
    labeled = F.col("_lab").isNotNull()
    reply = F.when(labeled, F.to_json(F.struct(notes.alias("notes")))).otherwise(F.lit('{"status": "no notes"}'))

    # One pass: every document yields its pages as an array, exploded once.
    lang = site_lang(F.col("lang"))
    no_year = F.lit(None).cast("int")

    def pg(url, html, kind, year=no_year):
        return F.struct(url.alias("url"), html.alias("html"), F.lit(kind).alias("kind"), year.alias("year"))

    detail = (F.when(lang == "en", pg(en_url, en_html, "detail"))
              .when(lang == "fr", pg(fr_url, fr_html, "detail"))
              .when(lang == "de", pg(de_url, de_html, "detail"))
              .when(lang == "es", pg(es_url, es_html, "detail", F.col("year"))))
    bib = (F.when((lang == "fr") & labeled, pg(F.concat(F.lit(HOSTS["fr"]), fr_bib_href), F.col("bibtex"), "bibtex"))
           .when(lang == "de", pg(F.concat(F.lit(HOSTS["de"] + "/bibtex/"), pid), F.col("bibtex"), "bibtex")))
    reply_pg = F.when(lang == "es", pg(F.concat(F.lit(HOSTS["es"] + "/notes?forum="), fid), reply, "notes"))
    venue = F.lit(None).cast("string")
    for lg in ("es", "de", "fr", "en"):
        venue = F.when(lang == lg, F.lit(VENUES[lg])).otherwise(venue)
    out = p.select("doc_id", "run_seq", venue.alias("venue"),
                   F.explode(F.array_compact(F.array(detail, bib, reply_pg))).alias("pg"))
    return out.select(F.xxhash64("pg.url").alias("page_id"), "pg.url", "pg.html", "venue", "pg.kind", "pg.year",
                      "run_seq", F.col("doc_id").alias("pos"), "doc_id")


# Entries of a listing page: volumes on a front page, papers of a volume,
# search results. (A front page spans VOLUMES * VOLUME ids.)
VOLUMES, VOLUME, RESULTS = 8, 50, 100
#: First pages of the four listings.
LISTING_SEEDS = [HOSTS["en"] + "/?page=0", HOSTS["fr"] + "/papers/search?page=0", HOSTS["de"] + "/search?page=0",
                 HOSTS["es"] + "/notes?invitation=all&offset=0"]


def listing_pages(papers: DataFrame) -> DataFrame:
    """The listings of the four sites, as landed pages of kind ``listing``.
    Each page names the next one; the last has none (a notes reply without
    notes ends the forum's). Each also links to one page that has not landed;
    front pages name a workshop volume as well, which no crawl should enter."""
    spark = papers.sparkSession
    papers = papers.where(F.col("doc_id") >= 0)
    last = papers.agg(F.max("doc_id")).first()[0]
    last = -1 if last is None else last
    key = F.col("doc_id")

    def entries(lang: str, size: int, entry: Column) -> DataFrame:
        """(blk, body): one row for every block of ids, also for an empty one."""
        own = papers.where(site_lang(F.col("lang")) == lang).select(F.floor(key / size).alias("blk"), "doc_id", entry.alias("e"))
        own = own.groupBy("blk").agg(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "e"))), lambda x: x["e"]).alias("es"))
        blocks = spark.range(last // size + 1).select(F.col("id").alias("blk"))
        return blocks.join(own, "blk", "left").withColumn("es", F.coalesce("es", F.array().cast("array<string>")))

    def numbered(lang: str, path: str, blk: Column) -> Column:
        return F.concat(F.lit(HOSTS[lang] + path), blk.cast("string"))

    def later(path: str, blk: Column, size: int) -> Column:
        link = F.concat(F.lit(f'<p><a class="pagination-next x" href="{path}'), (blk + 1).cast("string"), F.lit('">Next</a></p>'))
        return F.when(blk < last // size, link).otherwise(F.lit(""))

    def page(rows: DataFrame, lang: str, url: Column, html: Column) -> DataFrame:
        null = F.lit(None)
        return rows.select(F.xxhash64(url).alias("page_id"), url.alias("url"), html.alias("html"), F.lit(VENUES[lang]).alias("venue"),
                           F.lit("listing").alias("kind"), null.cast("int").alias("year"), null.cast("bigint").alias("run_seq"),
                           null.cast("bigint").alias("pos"), null.cast("bigint").alias("doc_id"))

    blk = F.col("blk")
    n, doc, title = blk.cast("string"), key.cast("string"), F.col("title")
    joined = F.array_join("es", "\n")

    # en: front pages name volumes, volumes name papers
    volume = spark.range(last // VOLUME + 1).select(F.floor(F.col("id") / VOLUMES).alias("blk"), "id")
    item = F.concat(F.lit('<li><a href="/volume/'), F.col("id").cast("string"), F.lit('"><b>Volume</b></a> Proceedings of the meeting</li>'))
    fronts = volume.groupBy("blk").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("id", item.alias("e")))), lambda x: x["e"]), "\n").alias("items"))
    workshop = F.concat(F.lit('<li><a href="/volume/w'), n, F.lit('">Volume</a> Proceedings of a Workshop</li><li>About <a href="/about">us</a></li>'))
    front = page(fronts, "en", numbered("en", "/?page=", blk), F.concat(
        F.lit("<html><body><ul>"), F.col("items"), workshop, F.lit("</ul>"), later("/?page=", blk, VOLUME * VOLUMES), F.lit("</body></html>")))

    def paper(title: Column, href: Column) -> Column:
        return F.concat(F.lit('<div class="paper">'),
                        F.when(title != "", F.concat(F.lit('<p class="title">'), H.escape(title), F.lit("</p>"))).otherwise(F.lit("")),
                        F.lit('<p>[<a href="'), href, F.lit('">abs</a>] [<a href="/x.pdf">pdf</a>]</p></div>'))

    own = paper(title, F.concat(F.lit("/v"), F.col("run_seq").cast("string"), F.lit("/doc"), doc, F.lit(".html")))
    gone = paper(F.lit("missing"), F.concat(F.lit("/v0/missing"), n, F.lit(".html")))
    volumes = page(entries("en", VOLUME, own), "en", numbered("en", "/volume/", blk),
                   F.concat(F.lit("<html><body>"), joined, gone, F.lit("</body></html>")))

    # fr: search results
    own = F.concat(F.lit('<li><a title="paper" href="/paper/doc'), doc, F.lit('-Abstract.html">'), H.escape(title), F.lit("</a> <i>names</i></li>"))
    gone = F.concat(F.lit('<li><a href="/about">About</a></li><li><a href="/paper/missing'), n, F.lit('-Abstract.html">missing</a></li>'))
    results = page(entries("fr", RESULTS, own), "fr", numbered("fr", "/papers/search?page=", blk),
                   F.concat(F.lit("<html><body><ul>"), joined, gone, F.lit("</ul>"), later("/papers/search?page=", blk, RESULTS), F.lit("</body></html>")))

    # de: search results with ids
    abs_url = PREPRINT_ABS
    own = F.concat(F.lit(f'<li><p class="list-title"><a href="{abs_url}'), preprint_id(F.col("year"), key), F.lit('">id</a> <a href="/pdf/x">pdf</a></p></li>'))
    gone = F.concat(F.lit(f'<li><a href="{abs_url}0001.m'), n, F.lit('">missing</a></li>'))
    preprints = page(entries("de", RESULTS, own), "de", numbered("de", "/search?page=", blk),
                     F.concat(F.lit("<html><body><ol>"), joined, gone, F.lit("</ol>"), later("/search?page=", blk, RESULTS), F.lit("</body></html>")))

    # es: notes replies, by offset
    def note(i: Column, title: Column) -> Column:
        return F.to_json(F.struct(i.alias("id"), i.alias("forum"), F.struct(title.alias("title")).alias("content")))

    own = note(F.concat(F.lit("f"), doc), title)
    reply = entries("es", REPLY_PAGE, own)
    empty = spark.range(1).select(F.lit(last // REPLY_PAGE + 1).cast("bigint").alias("blk"), F.array().cast("array<string>").alias("es"))
    notes = F.when(blk <= last // REPLY_PAGE, F.array_join(F.concat(F.col("es"), F.array(note(F.concat(F.lit("missing"), n), F.lit("missing")))), ",")) \
        .otherwise(F.lit(""))
    forum = page(reply.unionByName(empty), "es", F.concat(F.lit(HOSTS["es"] + "/notes?invitation=all&offset="), (blk * REPLY_PAGE).cast("string")),
                 F.concat(F.lit('{"notes": ['), notes, F.lit("]}")))
    return reduce(DataFrame.unionByName, [front, volumes, results, preprints, forum])


def conversation_listing(conv: DataFrame) -> DataFrame:
    """A JSON notes listing per conversation (one reply body per forum, at most
    the conversation's turns): note id = conv-turn, title = first line of the
    turn text, decision = the role."""
    note = F.struct(
        F.concat(F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("id"),
        F.col("conv_id").cast("string").alias("forum"),
        F.struct(first_line(F.col("text")).alias("title"), F.col("role").alias("decision")).alias("content"))
    # One reply per forum and block of REPLY_PAGE notes (the listing's offset
    # step), so no reply grows with the largest forum.
    return conv.groupBy("conv_id", F.floor(F.col("turn") / REPLY_PAGE).alias("page")).agg(
        F.to_json(F.struct(F.transform(F.array_sort(F.collect_list(F.struct("turn", note.alias("n")))),
                                       lambda e: e["n"]).alias("notes"))).alias("body"))


def volume_pages(papers: DataFrame) -> DataFrame:
    """Volume listing pages: one page per (venue, block of 50 ids), each paper a
    ``div.paper`` with ``p.title`` and an ``abs`` link. Papers with an empty
    title get no ``p.title``. Bounded groups: at most 50 papers per page."""
    block = F.concat(
        F.lit("<div class=\"paper\">"),
        F.when(F.col("title") != "", F.concat(F.lit("<p class=\"title\">"), H.escape(F.col("title")), F.lit("</p>")))
        .otherwise(F.lit("")),
        F.lit("<p class=\"links\">[<a href=\""), F.col("url_pdf"), F.lit("\">pdf</a>] [<a href=\"/abs/"),
        F.col("doc_id").cast("string"), F.lit(".html\">abs</a>]</p></div>"))
    pages = papers.select("venue", F.floor(F.col("doc_id") / 50).alias("blk"), "doc_id", block.alias("b")) \
        .groupBy("venue", "blk").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "b"))),
                                                              lambda e: e["b"]), "\n").alias("body"))
    return pages.select(
        F.xxhash64("venue", "blk").alias("page_id"),
        F.concat(F.lit("https://volumes.example.org/"), F.col("venue"), F.lit("/"), F.col("blk").cast("string")).alias("url"),
        F.concat(F.lit("<html><body>\n"), F.col("body"), F.lit("\n</body></html>")).alias("html"))
