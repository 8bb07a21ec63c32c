"""Listing pages to links (L1-L6). All JVM-side: regex columns + posexplode.

Duplicates are kept (union-all semantics); uniqueness comes only from the
upsert by title.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions.query import matches_query


def page_links(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Every ``<a>`` of every page: (page cols, pos, href, text)."""
    keep = keep or ["page_id", "url"]
    return pages.select(*keep, F.posexplode(H.links(F.col("html"))).alias("pos", "a")) \
        .select(*keep, F.col("pos").cast("bigint").alias("pos"), F.col("a.href").alias("href"),
                F.col("a.text").alias("text"))


def absolute_links(pages: DataFrame) -> DataFrame:
    """Hrefs made absolute against the page's origin (only for
    site-relative hrefs)."""
    return page_links(pages).where(F.col("href").isNotNull()).withColumn(
        "link", H.absolutize(F.col("href"), H.origin(F.col("url"))))


def prefixed_links(pages: DataFrame, prefix: str, keep: list[str] | None = None) -> DataFrame:
    """L4: hrefs starting with ``prefix`` -> last path segment as id."""
    return page_links(pages, keep).where(F.startswith(F.col("href"), F.lit(prefix))).withColumn(
        "link_id", F.element_at(F.split(F.col("href"), "/"), -1))


def link_by_text(pages: DataFrame, text: str, keep: list[str] | None = None) -> DataFrame:
    """Href of the first link whose trimmed text equals ``text``,
    absolute against the page origin; null when absent."""
    keep = keep or ["page_id", "url"]
    hit = F.try_element_at(F.filter(H.links(F.col("html")), lambda a: H.strip_ws(a["text"]) == F.lit(text)), F.lit(1))
    return pages.select(*keep, F.when(hit["href"].isNotNull(),
                                      H.absolutize(hit["href"], H.origin(F.col("url")))).alias("link"))


def next_page(pages: DataFrame, css_class: str = "pagination-next", keep: list[str] | None = None) -> DataFrame:
    """The next-page link of a listing (``a`` with the class), absolute; null when absent."""
    keep = keep or ["page_id", "url"]
    tags = F.filter(H.start_tags(F.col("html"), "a"),
                    lambda t: F.array_contains(F.split(H.attr(t, "class"), r"\s+"), F.lit(css_class)))
    href = F.try_element_at(F.transform(tags, lambda t: H.attr(t, "href")), F.lit(1))
    return pages.select(*keep, F.when(href.isNotNull() & (href != ""),
                                      H.absolutize(href, H.origin(F.col("url")))).alias("next_url"))


def listing_items(pages: DataFrame, include: str, exclude: str | None, base: str | None = None,
                  keep: list[str] | None = None) -> DataFrame:
    """L1: ``li`` items whose text contains ``include`` and not ``exclude`` ->
    first link of the item, prefixed with ``base`` (default: page origin)."""
    keep = keep or ["page_id"]
    items = pages.select(*dict.fromkeys([*keep, "url"]), F.posexplode(H.list_items(F.col("html"))).alias("pos", "li"))
    text = H.unescape(H.strip_tags(F.col("li")))
    cond = F.contains(text, F.lit(include))
    if exclude:
        cond = cond & ~F.contains(text, F.lit(exclude))
    first = F.try_element_at(H.links(F.col("li")), F.lit(1))
    prefix = F.lit(base) if base is not None else H.origin(F.col("url"))
    return items.where(cond).where(first["href"].isNotNull()).select(
        *keep, F.col("pos").cast("bigint").alias("pos"), F.concat(prefix, first["href"]).alias("link"))


def search_result_links(pages: DataFrame, marker: str, host: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """L3: first link of each ``li``; keep hrefs containing ``marker``; host prefixed."""
    keep = keep or ["page_id"]
    items = pages.select(*dict.fromkeys([*keep, "url"]), F.posexplode(H.list_items(F.col("html"))).alias("pos", "li"))
    first = F.try_element_at(H.links(F.col("li")), F.lit(1))
    prefix = F.lit(host) if host is not None else H.origin(F.col("url"))
    return items.where(F.contains(first["href"], F.lit(marker))).select(
        *keep, F.col("pos").cast("bigint").alias("pos"), F.concat(prefix, first["href"]).alias("link"))


def volume_links(pages: DataFrame, query: str, link_text: str = "abs", keep: list[str] | None = None) -> DataFrame:
    """L2: each ``div.paper`` block -> ``p.title`` text ('' when absent) -> P1
    on the lowercased title -> href of the link reading ``link_text``."""
    keep = keep or ["page_id"]
    blocks = F.regexp_extract_all(
        F.col("html"), F.lit(r"""(?is)<div\b[^>]*\sclass\s*=\s*["'](?:[^"']*\s)?paper(?:\s[^"']*)?["'][^>]*>(.*?)</div>"""), 1)
    b = pages.select(*keep, F.posexplode(blocks).alias("pos", "block"))
    title = H.unescape(H.strip_tags(F.regexp_extract(
        F.col("block"), r"""(?is)<p\b[^>]*\sclass\s*=\s*["'](?:[^"']*\s)?title(?:\s[^"']*)?["'][^>]*>(.*?)</p>""", 1)))
    link = F.try_element_at(F.filter(H.links(F.col("block")), lambda a: H.strip_ws(a["text"]) == F.lit(link_text)), F.lit(1))
    return (b.withColumn("title", title)
            .where(matches_query(F.lower(F.col("title")), query))
            .where(link["href"].isNotNull())
            .select(*keep, F.col("pos").cast("bigint").alias("pos"), "title", link["href"].alias("link")))


def next_notes(replies: DataFrame, step: int, body_col: str = "html") -> DataFrame:
    """L6 for a notes listing: the reply ``step`` notes on; null after an empty one."""
    from ..sources.notes import parse_notes
    offset = F.regexp_extract(F.col("url"), r"[?&]offset=(\d+)", 1).try_cast("bigint")
    later = F.concat(F.regexp_replace(F.col("url"), r"([?&]offset=)\d+.*$", "$1"), (offset + step).cast("string"))
    full = parse_notes(replies, body_col, keep=["url"]).where(F.col("note_id").isNotNull()).select("url").distinct()
    return full.where(offset.isNotNull()).select("url", later.alias("next_url"))


def frontier(links: DataFrame, known_urls: DataFrame, link_col: str = "link") -> DataFrame:
    """Discovered URLs not yet landed (distinct), via a left-anti join."""
    found = links.select(F.col(link_col).alias("url")).where(F.col("url").isNotNull()).distinct()
    return found.join(known_urls.select("url"), "url", "left_anti")


def linked_pages(links: DataFrame, pages: DataFrame, link_col: str = "link") -> DataFrame:
    """Discovered links -> landed pages (inner equi-join on the URL).
    Unmatched links are the :func:`frontier`."""
    target = pages.select(F.col("url").alias(link_col), F.col("page_id").alias("target_page_id"))
    return links.join(target, link_col)
