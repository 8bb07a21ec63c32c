"""JVM-side HTML field extraction with regular expressions.

Flat fields (tag attributes, link hrefs and texts, list items) are column
expressions, so they run inside whole-stage codegen with no Python worker.
Nested element text is the job of :mod:`quire.operators.nested`.

Tags are matched one at a time, attributes in any order, names in any case,
values in double, single or no quotes.
"""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# A start tag to its closing ``>``: a quoted value may hold ``>``.
_REST = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
# One attribute: name and value with its quotes. Matches follow one another
# through the tag, so what stands inside a value is never taken for a name.
_ATTRIBUTE = r"""([^\s"'>/=]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
# What a start tag begins with.
_TAG_NAME = r"^<[^\s>/]+"
# A character reference after its ``&``.
_REFERENCE = r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});"


def _named() -> Column:
    """Named references and their characters (one folded literal)."""
    return F.from_json(F.lit(json.dumps({k: chr(v) for k, v in name2codepoint.items()} | {"apos": "'"})),
                       "map<string,string>")


def unescape(c: Column) -> Column:
    """Character references decoded, once: numeric and named ones; an unknown
    one stays as it is."""
    def one(cut: Column) -> Column:
        part, ref = cut["part"], cut["ref"]
        rest = F.substring(part, F.length(ref) + 2, F.length(part))
        code = F.when(F.startswith(F.lower(ref), F.lit("#x")), F.conv(F.substring(ref, F.lit(3), F.lit(8)), 16, 10)) \
            .otherwise(F.substring(ref, F.lit(2), F.lit(8))).try_cast("bigint")
        code = F.when(code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF), code).otherwise(F.lit(0xFFFD))
        char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        known = F.when(F.startswith(ref, F.lit("#")), char).otherwise(F.try_element_at(_named(), ref))
        return F.coalesce(F.when(ref != "", F.concat(known, rest)), F.concat(F.lit("&"), part))

    # The reference is cut in a pass of its own: lambdas evaluate what they
    # name as often as they name it.
    parts = F.split(c, "&")
    cut = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
                      lambda part: F.struct(part.alias("part"), F.regexp_extract(part, _REFERENCE, 1).alias("ref")))
    return F.when(~F.contains(c, F.lit("&")), c).otherwise(F.concat(
        F.element_at(parts, 1), F.array_join(F.transform(cut, one), "")))


def escape(c: Column) -> Column:
    """Escape text for an HTML text node or a double-quoted attribute."""
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    for ch, ent in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(ch), F.lit(ent))
    return c


def markup(html: Column) -> Column:
    """The page without script/style bodies and comments, whose text is not
    markup (a ``<meta ...>`` inside a script string is not a tag)."""
    return F.regexp_replace(html, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->", "")


def start_tags(html: Column, tag: str) -> Column:
    """All start tags ``<tag ...>`` in page order (array of tag strings)."""
    return F.regexp_extract_all(markup(html), F.lit(rf"(?is)<{tag}\b{_REST}"), 0)


def attr(tag_text: Column, name: str) -> Column:
    """Value of attribute ``name`` in one start tag, '' when absent, entities
    decoded; of a repeated attribute the first counts."""
    return _value(_attributes(F.regexp_replace(tag_text, _TAG_NAME, "")), name)


def _attributes(body: Column) -> Column:
    """Names (lower case) and values (with quotes) of a start tag without its
    own name."""
    return F.struct(F.transform(F.regexp_extract_all(body, F.lit(_ATTRIBUTE), 1), F.lower).alias("names"),
                    F.regexp_extract_all(body, F.lit(_ATTRIBUTE), 2).alias("values"))


def _value(attributes: Column, name: str) -> Column:
    value = F.coalesce(F.try_element_at(attributes["values"],
                                        F.nullif(F.array_position(attributes["names"], name), F.lit(0)).cast("int")), F.lit(""))
    return unescape(F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2"))


def tags_with_attr(html: Column, tag: str, name: str, value: str) -> Column:
    """Start tags of ``tag`` whose attribute ``name`` equals ``value``."""
    return F.filter(start_tags(html, tag), lambda t: attr(t, name) == F.lit(value))


def meta_pairs(clean_html: Column) -> Column:
    """All ``meta`` tags of a page (already passed through :func:`markup`) as
    array<struct<name, content>>, page order. Compute once per page and read
    every field from it with :func:`first_meta` / :func:`all_metas`."""
    tags = F.regexp_extract_all(clean_html, F.lit(rf"(?is)<meta\b{_REST}"), 0)
    # One step each, so that a tag is cut once, not once for each attribute.
    cut = F.transform(F.transform(tags, lambda t: F.regexp_replace(t, _TAG_NAME, "")), _attributes)
    return F.transform(cut, lambda a: F.struct(_value(a, "name").alias("name"), _value(a, "content").alias("content")))


def first_meta(pairs: Column, name: str) -> Column:
    """X1 over :func:`meta_pairs`: content of the first meta named ``name``."""
    return F.try_element_at(F.transform(F.filter(pairs, lambda m: m["name"] == F.lit(name)),
                                        lambda m: m["content"]), F.lit(1))


def all_metas(pairs: Column, name: str) -> Column:
    """X2 over :func:`meta_pairs`: all contents named ``name``, page order;
    null (not empty) when none."""
    arr = F.transform(F.filter(pairs, lambda m: m["name"] == F.lit(name)), lambda m: m["content"])
    return F.when(F.size(arr) > 0, arr)


def meta_content(html: Column, name: str) -> Column:
    """Content of the first ``meta`` named ``name``; null when none."""
    return first_meta(meta_pairs(markup(html)), name)


def meta_contents(html: Column, name: str) -> Column:
    """Contents of all ``meta`` named ``name`` in page order; null (not
    empty) when none."""
    return all_metas(meta_pairs(markup(html)), name)


def attr_of_first(html: Column, tag: str, name: str, value: str, want: str) -> Column:
    """Attribute ``want`` of the first ``tag`` whose ``name`` equals ``value``."""
    return F.try_element_at(F.transform(tags_with_attr(html, tag, name, value), lambda t: attr(t, want)), F.lit(1))


def strip_ws(c: Column) -> Column:
    """Strip leading/trailing whitespace of any kind (like Python ``str.strip``)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)<[^>]*>", "")


def links(html: Column, clean: bool = False) -> Column:
    """All ``<a>`` elements as array<struct<href, text>>, page order. ``href``
    is null when the link has none; ``text`` is the decoded, tag-free text.
    ``clean``: the html already went through :func:`markup`."""
    elems = F.regexp_extract_all(html if clean else markup(html), F.lit(rf"(?is)<a\b{_REST}.*?</a>"), 0)

    def one(e):
        start = F.regexp_extract(e, rf"(?is)^<a\b{_REST}", 0)
        has = F.array_contains(F.transform(F.regexp_extract_all(start, F.lit(_ATTRIBUTE), 1), F.lower), "href")
        inner = F.regexp_replace(F.regexp_replace(e, rf"(?is)^<a\b{_REST}", ""), r"(?is)</a>$", "")
        return F.struct(F.when(has, attr(start, "href")).alias("href"),
                        unescape(strip_tags(inner)).alias("text"))

    return F.transform(elems, one)


def list_items(html: Column) -> Column:
    """Inner html of every ``<li>`` element, page order."""
    return F.regexp_extract_all(markup(html), F.lit(r"(?is)<li\b[^>]*>(.*?)</li>"), 1)


def origin(url: Column) -> Column:
    """Scheme and host of an absolute URL, e.g. ``https://a.example.org``."""
    return F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)


def absolutize(href: Column, base: Column) -> Column:
    """Prefix ``base`` only when the href is site-relative (starts with ``/``)."""
    return F.when(F.startswith(href, F.lit("/")) & ~F.startswith(href, F.lit("//")), F.concat(base, href)) \
        .otherwise(href)
