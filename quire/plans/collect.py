"""Collect: landed pages -> paper records -> validity -> upsert (F1 registry).

Each venue is a :class:`Site`: the links of its listings, and the records of
its detail pages. :func:`crawl` follows the listings from their first pages;
:func:`collect_from_listings` reads the detail pages they lead to.

A title query is applied before the Python pass, by a title that the JVM cuts
from the page, and so is the semi-join with the urls that a crawl found: pages
that can't match are never parsed. Flat fields are JVM columns; nested text goes through one Python pass per
page (the JVM fields ride along, so no join is needed to put them back);
the bibtex page (J1) and the notes replies (J2, A3) are joined on derived
URLs / forum ids. A stream takes the same details and lookups apart
(:mod:`quire.streaming.ingest`) and holds what still misses the other.

Records carry the papers columns plus ``url``, ``doc_id``, ``year_text`` and
``parse_error``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.ids import preprint_url_and_year
from ..functions.query import matches_query
from ..operators import crawl as W
from ..operators import links as L
from ..operators import nested as N
from ..operators import records as R
from ..operators.bounds import string_side_fits
from ..operators.matching import filter_by_query
from ..session import ensure_checkpoint_dir
from ..sources.notes import forum_record, parse_notes

# Accepted flag per venue layout (the forum layout is computed).
ACCEPTED = {"proceedings": True, "conference": True, "preprints": False}
# The heading of a preprint page, up to its first end tag.
PREPRINT_HEADING = r"""(?is)<h1\b[^>]*\sclass\s*=\s*["']title mathjax["'][^>]*>(.*?)</h1"""


def _citation_meta() -> list[Column]:
    """X1-X3 from the page's meta pairs (column ``_mt``, computed once)."""
    mt = F.col("_mt")
    return [H.first_meta(mt, "citation_title").alias("title"),
            H.all_metas(mt, "citation_author").alias("authors"),
            F.substring(H.first_meta(mt, "citation_publication_date"), 1, 4).alias("year_text"),
            H.first_meta(mt, "citation_pdf_url").alias("url_pdf")]


def _named(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are computed once a row: filters and later
    projections stay above the generator."""
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def _titled(df: DataFrame, query: str | None, title: Column) -> DataFrame:
    """P1 below the Python pass: rows whose title can match ``query``."""
    return df if query is None else df.where(matches_query(F.lower(F.coalesce(title, F.lit(""))), query))


def _detail(pages: DataFrame, venue: str) -> DataFrame:
    return pages.where((F.col("kind") == "detail") & (F.col("venue") == venue))


# What is read off a detail page alone, the same columns for every venue.
# ``lookup_key`` names what the record still needs: a BibTeX page by its url, or
# the notes of a forum by its id; a venue that needs neither has null.
DETAIL = ["url", "doc_id", "run_seq", "pos", "title", "authors", "year_text", "url_pdf", "abstract", "bibtex",
          "lookup_key", "parse_error"]


def _extracted(flat: DataFrame, specs: list[dict]) -> DataFrame:
    return N.extract(flat, specs, [c for c in flat.columns if c != "html"], error_col="parse_error")


def _details(x: DataFrame, **columns: Column) -> DataFrame:
    """The columns of ``DETAIL``: those of ``x``, or given, or null."""
    types = {"authors": "array<string>"}
    cols = {c: columns.get(c, F.col(c) if c in x.columns else F.lit(None)) for c in DETAIL}
    return x.select(*(v.cast(types.get(c, "string" if c not in ("doc_id", "run_seq", "pos") else "bigint")).alias(c)
                      for c, v in cols.items()))


def proceedings_details(pages: DataFrame, query: str | None = None) -> DataFrame:
    d = _named(_detail(pages, "proceedings"), _mt=H.meta_pairs(H.markup(F.col("html"))))
    d = _titled(d, query, H.first_meta(F.col("_mt"), "citation_title"))
    flat = d.select("url", "doc_id", "run_seq", "pos", "html", *_citation_meta())
    return _details(_extracted(flat, [dict(name="abstract", tag="div", cls="abstract"),
                                      dict(name="bibtex", tag="code", cls="citecode", id="bibtex")]))


def conference_details(pages: DataFrame, query: str | None = None) -> DataFrame:
    d = _named(_detail(pages, "conference"), _m=H.markup(F.col("html")))
    d = _named(d, _mt=H.meta_pairs(F.col("_m")))
    d = _named(_titled(d, query, H.first_meta(F.col("_mt"), "citation_title")), _links=H.links(F.col("_m"), clean=True))
    bib_link = F.try_element_at(F.filter(F.col("_links"), lambda a: H.strip_ws(a["text"]) == F.lit("Bibtex")), F.lit(1))
    flat = d.select("url", "doc_id", "run_seq", "pos", "html", *_citation_meta(),
                    F.when(bib_link["href"].isNotNull(),
                           H.absolutize(bib_link["href"], H.origin(F.col("url")))).alias("lookup_key"))
    return _details(_extracted(flat, [dict(name="abstract", tag="p", after=dict(tag="h4", text="Abstract"))]))


def preprint_details(pages: DataFrame, query: str | None = None) -> DataFrame:
    # The exact title is nested text. The JVM cuts it where the heading holds
    # no other one; otherwise the page goes on to the parser.
    heading = F.regexp_extract(F.col("html"), PREPRINT_HEADING, 1)
    d = _named(_detail(pages, "preprints"), _h=F.when((heading != "") & ~F.contains(F.lower(heading), F.lit("<h1")), heading))
    if query is not None:
        title = F.replace(H.unescape(H.strip_tags(F.col("_h"))), F.lit("Title: "), F.lit(""))
        d = _named(d, _t=title).where(F.col("_t").isNull() | matches_query(F.lower(F.col("_t")), query))
    pid = F.element_at(F.split(F.col("url"), "/"), -1)
    url_year = preprint_url_and_year(pid)
    d = _named(d, _pdf=H.attr_of_first(F.col("html"), "a", "accesskey", "f", "href"))
    pdf = F.col("_pdf")
    flat = d.select("url", "doc_id", "run_seq", "pos", "html", url_year["year"].alias("year_text"),
                    F.when(pdf.isNotNull(), H.absolutize(pdf, H.origin(F.col("url")))).alias("url_pdf"),
                    F.concat(H.origin(F.col("url")), F.lit("/bibtex/"), pid).alias("lookup_key"))
    x = _extracted(flat, [dict(name="t", tag="h1", cls="title mathjax", take="rawtext"),
                          dict(name="a", tag="div", cls="authors", take="rawtext"),
                          dict(name="ab", tag="blockquote", cls="abstract mathjax", take="rawtext")])
    # Label removed, newline -> space, stripped; authors stay one string.
    authors = H.strip_ws(F.replace(F.replace(F.col("a"), F.lit("\n"), F.lit(" ")), F.lit("Authors:"), F.lit("")))
    abstract = H.strip_ws(F.replace(F.replace(F.col("ab"), F.lit("\n"), F.lit(" ")), F.lit("Abstract: "), F.lit("")))
    return _details(x, title=F.replace(F.col("t"), F.lit("Title: "), F.lit("")),
                    authors=F.when(F.col("a").isNotNull() & (authors != ""), F.array(authors)),
                    abstract=F.when(F.col("ab").isNotNull(), abstract))


def forum_details(pages: DataFrame, query: str | None = None) -> DataFrame:
    # The JSON is parsed once: filters and projections stay above the inline.
    d = _named(_detail(pages, "forum"), _rec=forum_record(F.col("html")))
    c = F.col("_rec")["content"]
    d = _titled(d, query, c["title"])
    fid = F.nullif(F.regexp_extract(F.col("url"), r"[?&]id=([^&#]+)", 1), F.lit(""))
    return _details(d, title=c["title"], authors=c["authors"], bibtex=c["_bibtex"],
                    url_pdf=F.when(c["pdf"].isNotNull(), H.absolutize(c["pdf"], H.origin(F.col("url")))),
                    abstract=c["abstract"], year_text=F.col("year"), lookup_key=fid,
                    parse_error=F.when(F.col("_rec").isNull(), F.lit("no record in the page")))


def forum_accept(pages: DataFrame) -> DataFrame:
    """J2 input: per forum id, accepted (A3 over P7) and whether notes existed."""
    replies = pages.where((F.col("kind") == "notes") & (F.col("venue") == "forum")).select(
        F.nullif(F.regexp_extract(F.col("url"), r"[?&]forum=([^&#]+)", 1), F.lit("")).alias("fid"), F.col("html").alias("body"))
    notes = parse_notes(replies.where(F.col("fid").isNotNull()), "body", keep=["fid"])
    return notes.groupBy("fid").agg(
        F.coalesce(F.bool_or(R.is_accepting(F.col("decision"))), F.lit(False)).alias("accepted"),
        F.bool_or("has_notes").alias("has_notes"))


def bibtex_lookups(pages: DataFrame, venue: str) -> DataFrame:
    """The landed BibTeX pages of a venue, by url."""
    found = pages.where((F.col("kind") == "bibtex") & (F.col("venue") == venue))
    return found.select(F.col("url").alias("lookup_key"), F.col("html").alias("found_bibtex"),
                        F.lit(None).cast("boolean").alias("found_accepted"))


def forum_lookups(pages: DataFrame, venue: str = "forum") -> DataFrame:
    """Whether the notes of a forum accept it."""
    return forum_accept(pages).select(F.col("fid").alias("lookup_key"), F.lit(None).cast("string").alias("found_bibtex"),
                                      F.col("accepted").alias("found_accepted"))


def finished(x: DataFrame, venue: str | None, query_term: str | None = None) -> DataFrame:
    """Records (X13) of details and what was found for them; without it the
    BibTeX is null (a reject) and a forum is not accepted. ``venue`` None: that
    of each row."""
    accepted = F.coalesce(F.col("found_accepted"), F.lit(False))
    if venue is None:
        venue = F.col("venue")
        for v, flag in ACCEPTED.items():
            accepted = F.when(venue == v, F.lit(flag)).otherwise(accepted)
    elif venue in ACCEPTED:
        accepted = F.lit(ACCEPTED[venue])
    return R.assemble(x, title=F.col("title"), authors=F.col("authors"), venue=venue, year=F.col("year_text"),
                      bibtex=F.coalesce("bibtex", "found_bibtex"), url_pdf=F.col("url_pdf"), abstract=F.col("abstract"),
                      accepted=accepted, query_term=query_term, run_seq=F.col("run_seq"), pos=F.col("pos"),
                      extra=["url", "doc_id", "parse_error"])


def site_records(venue: str, pages: DataFrame, query: str | None = None, lookup: DataFrame | None = None) -> DataFrame:
    """Details of a venue joined with what they need. A row without a key joins
    under one of its own, not all under null."""
    site = SITES[venue]
    details = site.details(pages, query)
    if site.lookups is None:
        found = details.withColumns({"found_bibtex": F.lit(None).cast("string"), "found_accepted": F.lit(None).cast("boolean")})
    else:
        key = F.coalesce("lookup_key", F.concat(F.lit("none:"), F.col("url")))
        found = details.withColumn("lookup_key", key).join(site.lookups(pages if lookup is None else lookup, venue), "lookup_key", "left")
    return finished(found, venue, query)


# --- F1: the sites -------------------------------------------------------------

def _hops(found: DataFrame, hop: str, link: Column | None = None) -> DataFrame:
    return found.select("url", (F.col("link") if link is None else link).alias("link"), F.lit(hop).alias("hop"))


def _next(listing: DataFrame) -> DataFrame:
    found = L.next_page(listing, keep=["url"])
    return _hops(found.where(F.col("next_url").isNotNull()), "next", F.col("next_url"))


def proceedings_links(listing: DataFrame, query: str | None = None) -> DataFrame:
    """L1 and L2: volumes that are no workshops, then the papers of a volume."""
    volumes = L.listing_items(listing, VOLUME_WORD, WORKSHOP_WORD, keep=["url"])
    papers = L.volume_links(listing, query or "", keep=["url"])
    return _next(listing).unionByName(_hops(volumes, "listing")) \
        .unionByName(_hops(papers, "detail", H.absolutize(F.col("link"), H.origin(F.col("url")))))


def conference_links(listing: DataFrame, query: str | None = None) -> DataFrame:
    """L3: search results."""
    return _next(listing).unionByName(_hops(L.search_result_links(listing, PAPER_MARKER, keep=["url"]), "detail"))


def preprint_links(listing: DataFrame, query: str | None = None) -> DataFrame:
    """L4 and X11: links with the prefix, whose ids give the urls."""
    found = L.prefixed_links(listing, PREPRINT_PREFIX, keep=["url"])
    return _next(listing).unionByName(_hops(found, "detail", preprint_url_and_year(F.col("link_id"))["url"]))


def forum_links(listing: DataFrame, query: str | None = None) -> DataFrame:
    """Notes whose title matches; the listing goes on by offset."""
    notes = parse_notes(listing, "html", keep=["url"]).where(F.col("note_id").isNotNull())
    notes = filter_by_query(notes.withColumn("title", F.coalesce("title", F.lit(""))), query or "")
    later = L.next_notes(listing, NOTES_STEP)
    return _hops(later, "next", F.col("next_url")).unionByName(
        _hops(notes, "detail", F.concat(H.origin(F.col("url")), F.lit("/forum?id="), F.col("note_id"))))


class Site(NamedTuple):
    """``links(listing_pages, query)`` gives (url, link, hop): the next page of
    a listing, another listing, or a detail page; ``details(pages, query)``
    what is read off the detail pages; ``lookups(pages, venue)`` what other
    pages hold for them, by ``lookup_key``."""
    links: Callable[[DataFrame, str | None], DataFrame]
    details: Callable[[DataFrame, str | None], DataFrame]
    lookups: Callable[[DataFrame, str], DataFrame] | None


# Words and link marks of the listings, notes of a reply.
VOLUME_WORD, WORKSHOP_WORD = "Proceedings", "Workshop"
PAPER_MARKER = "/paper/"
PREPRINT_PREFIX = "https://preprints.example.org/abs"
NOTES_STEP = 1000

SITES = {
    "proceedings": Site(proceedings_links, proceedings_details, None),
    "conference": Site(conference_links, conference_details, bibtex_lookups),
    "preprints": Site(preprint_links, preprint_details, bibtex_lookups),
    "forum": Site(forum_links, forum_details, forum_lookups),
}


def _landed_at(pages: DataFrame, urls: DataFrame) -> DataFrame:
    """The pages with one of the ``urls``. Few urls go to the pages. Many meet
    them in a number of partitions that stays: what follows costs far more a
    byte than a join, so these must not be coalesced to a join's size."""
    ensure_checkpoint_dir(pages.sparkSession)
    urls = urls.checkpoint()  # counted, then read once for each site
    if string_side_fits(urls, ["url"]):
        return pages.join(F.broadcast(urls), "url", "left_semi")
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pages.repartition(parts, "url").join(urls.hint("merge"), "url", "left_semi")


def collect_records(pages: DataFrame, query: str | None = None, venues: list[str] | None = None,
                    lookup: DataFrame | None = None, urls: DataFrame | None = None) -> DataFrame:
    """All records of the detail pages in ``pages`` (valid or not), optionally
    only those whose lowercased title matches ``query`` (P1, applied to every
    venue) and those of the given ``urls``. BibTeX pages and notes replies are
    looked up in ``lookup`` (default: ``pages``)."""
    lookup = pages if lookup is None else lookup
    if urls is not None:
        pages = _landed_at(pages, urls.select("url"))
    parts = [site_records(v, pages, query, lookup) for v in venues or list(SITES)]
    out = reduce(lambda a, b: a.unionByName(b), parts)
    if query is not None:
        out = filter_by_query(out.withColumn("title", F.coalesce("title", F.lit(""))), query)
    return out


def crawl(pages: DataFrame, seeds: DataFrame, query: str | None = None,
          venues: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(links (url, link, hop) of all landed listings, urls of the listings
    reached from ``seeds`` (url))."""
    listings = pages.where(F.col("kind") == "listing")
    parts = [SITES[v].links(listings.where(F.col("venue") == v), query).checkpoint() for v in venues or list(SITES)]
    links = reduce(lambda a, b: a.unionByName(b), parts)
    hop = F.col("hop")
    return links, W.reachable(links.where(hop == "listing"), seeds, links.where(hop == "next"))


def collect_from_listings(pages: DataFrame, seeds: DataFrame, query: str | None = None,
                          venues: list[str] | None = None) -> DataFrame:
    """The records of the detail pages that the listings lead to: links, crawl
    to a fixpoint, semi-join of the landed detail pages, extraction."""
    links, reached = crawl(pages, seeds, query, venues)
    found = links.where(F.col("hop") == "detail").join(reached, "url", "left_semi")
    urls = found.select(F.col("link").alias("url")).distinct()
    return collect_records(pages, query, venues, urls=urls)


def collect(pages: DataFrame, query: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid records, rejects) ready for the upsert."""
    recs = collect_records(pages, query)
    return R.split_valid(recs)


def collect_runs(records: DataFrame, runs: DataFrame) -> DataFrame:
    """U2 + J5 + D11: many collect runs at once. ``runs`` holds (run_seq,
    query, venue), one row per run in the order the runs happen (terms x
    venues in the reference's example workload). A record belongs to every run
    of its venue whose query its title matches; it takes that run's
    ``run_seq`` and ``query_term``. Valid records are then upserted, so the
    last run to touch a title wins, with its query term."""
    from ..operators.matching import match_queries
    from ..operators.records import split_valid
    from ..operators.upsert import upsert
    from ..session import shared_path

    # The matching reads the records more than once: their row id must be a
    # stored value, not one made anew by each plan.
    spark = records.sparkSession
    path = shared_path(spark, "run-records")
    records.withColumn("_rid", F.monotonically_increasing_id()).write.parquet(path)
    keyed = spark.read.parquet(path)
    # Distinct queries are matched once; a hit then meets the runs of its venue.
    q = runs.select(F.col("query").alias("query_id"), "query").distinct()
    hits = match_queries(keyed, q, ["_rid"], "title")
    on_run = runs.select(F.col("run_seq").alias("_run"), F.col("query").alias("query_id"),
                         F.col("venue").alias("_v"))
    per_run = (hits.join(on_run, (hits["query_id"] == on_run["query_id"]) & (F.col("venue") == F.col("_v")))
               .withColumn("run_seq", F.col("_run").cast("bigint")).withColumn("query_term", on_run["query_id"])
               .drop(hits["query_id"]).drop(on_run["query_id"]).drop("_rid", "_run", "_v"))
    valid, _ = split_valid(per_run)
    return upsert(None, valid)
