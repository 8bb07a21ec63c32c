"""Nested HTML text extraction (X4, X5, X6, X8) in Python workers.

"All text under the first ``div.abstract``" or "the ``p`` after the ``h4``
reading Abstract" needs the element tree, which one regular expression can't
give. Pages go to Python workers in Arrow batches (``mapInPandas``); each page
is parsed once with the standard library's event parser and every requested
field is taken in that one pass. Only the key columns and the extracted fields
come back: the html never leaves the worker.

Arrow batches are bounded by ``spark.sql.execution.arrow.maxBytesPerBatch``
(64 MB by default) as well as by record count, and a worker takes a few MB of
a batch at a time and gives freed memory back, so neither large pages nor many
of them blow its memory.

Tree rules: void elements have no children; an end tag closes up to its most
recent open match and a stray end tag is ignored; nesting is kept as written
(a ``p`` inside a ``p`` stays inside). Text inside ``script``, ``style`` and
``template`` is not element text. Entities are decoded.

A field spec is a dict:
  ``name``   output column
  ``tag``    element name
  ``cls``    class: one word = one of the element's classes; with spaces = the
             whole class attribute
  ``id``     id attribute; ``attrs``: other exact attribute values
  ``text``   the element's trimmed text must equal this
  ``after``  a spec: take the first later sibling (``tag``...) of the first
             element matching ``after``
  ``take``   ``text`` (default, trimmed), ``rawtext`` or ``attr:<name>``
"""

from __future__ import annotations

from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..functions.batches import give_back, run_ends

# Characters of pages that a worker parses at a time.
SLICE_CHARS = 4 << 20

# HTML void elements and elements whose content is not text.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
        "track", "wbr", "keygen", "command", "basefont", "frame", "isindex", "nextid", "spacer", "menuitem"}
NON_TEXT = {"script", "style", "template"}


class _Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag = tag
        self.attrs = attrs
        self.children = []
        self.parent = parent


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("#root", {}, None)
        self.stack = [self.root]

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.stack[-1])
        self.stack[-1].children.append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        node = _Node(tag, {k: (v if v is not None else "") for k, v in attrs}, self.stack[-1])
        self.stack[-1].children.append(node)

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        self.stack[-1].children.append(data)


def parse(html: str) -> _Node:
    b = _TreeBuilder()
    b.feed(html)
    b.close()
    return b.root


def _iter(node):
    """Elements in document order."""
    todo = [node]
    while todo:
        n = todo.pop()
        if isinstance(n, _Node):
            if n.tag != "#root":
                yield n
            todo.extend(reversed([c for c in n.children if isinstance(c, _Node)]))


def text_of(node: _Node) -> str:
    out = []
    todo = [node]
    while todo:
        n = todo.pop()
        if isinstance(n, str):
            out.append(n)
        elif n.tag not in NON_TEXT or n is node:
            todo.extend(reversed(n.children))
    return "".join(out)


def _class_ok(node, cls):
    have = node.attrs.get("class")
    if have is None:
        return False
    if " " in cls.strip():
        return have == cls
    return cls in have.split()


def _matches(node, spec) -> bool:
    if spec.get("tag") and node.tag != spec["tag"]:
        return False
    if spec.get("cls") is not None and not _class_ok(node, spec["cls"]):
        return False
    if spec.get("id") is not None and node.attrs.get("id") != spec["id"]:
        return False
    for k, v in (spec.get("attrs") or {}).items():
        if node.attrs.get(k) != v:
            return False
    if spec.get("text") is not None and text_of(node).strip() != spec["text"]:
        return False
    return True


def _first(root, spec):
    for n in _iter(root):
        if _matches(n, spec):
            return n
    return None


def find(root: _Node, spec: dict):
    if spec.get("after"):
        anchor = _first(root, spec["after"])
        if anchor is None:
            return None
        sibs = anchor.parent.children
        idx = next(i for i, c in enumerate(sibs) if c is anchor)
        own = {k: v for k, v in spec.items() if k != "after"}
        for c in sibs[idx + 1:]:
            if isinstance(c, _Node) and _matches(c, own):
                return c
        return None
    return _first(root, spec)


def take(node, spec):
    if node is None:
        return None
    how = spec.get("take", "text")
    if how == "text":
        return text_of(node).strip()
    if how == "rawtext":
        return text_of(node)
    if how.startswith("attr:"):
        return node.attrs.get(how[5:])
    raise ValueError(how)


def extract_fields(html: str | None, specs: list[dict]) -> list:
    """Fields of one page; all null where the parser refuses it."""
    return parsed_fields(html, specs)[0]


def parsed_fields(html: str | None, specs: list[dict]) -> tuple[list, str | None]:
    """(fields of one page, error). A page that the parser refuses yields nulls
    and the parser's message (P4: the record is then an ``error`` reject)."""
    if html is None:
        return [None] * len(specs), None
    try:
        root = parse(html)
        return [take(find(root, s), s) for s in specs], None
    except Exception as e:  # noqa: BLE001 - one bad page must not fail the task; its error is reported
        return [None] * len(specs), f"{type(e).__name__}: {e}"


def extract(df: DataFrame, specs: list[dict], key_cols: list[str], html_col: str = "html",
            error_col: str | None = None) -> DataFrame:
    """Run the extractor over ``df``: output = key columns + one string column
    per spec (+ ``error_col``: why a page could not be parsed, else null). Only
    ``key_cols`` and ``html_col`` are sent to Python."""
    from ..session import ship_package
    ship_package(df.sparkSession)
    specs = [dict(s) for s in specs]
    names = [s["name"] for s in specs] + ([error_col] if error_col else [])
    src = df.select(*key_cols, html_col)
    key_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields if f.name in key_cols)
    out_schema = key_schema + "".join(f", `{n}` string" for n in names)

    def run(batches):
        for pdf in batches:
            sizes = np.array([0 if h is None else len(h) for h in pdf[html_col]])
            for start, stop in run_ends(sizes, SLICE_CHARS):
                part = pdf.iloc[start:stop]
                cols = list(zip(*((*fields, error) for fields, error in (parsed_fields(h, specs) for h in part[html_col]))))
                out = part[key_cols].copy()
                for n, vals in zip(names, cols):
                    out[n] = pd.Series(list(vals), index=out.index, dtype=object)
                yield out
            pdf = part = out = cols = None  # before the next batch is read
            give_back()

    return src.mapInPandas(run, out_schema)
