"""Secret scan over a trigram inverted index.

1. Index: texts are dealt into segments. For each segment and each trigram of
   bytes (A-Z as a-z) that occurs in it, one row lists the texts that hold it;
   one more row lists the segment's members.
2. Query: each rule's regular expression gives a Boolean trigram query, an OR
   of ANDs of trigrams that any match must contain. Postings are intersected
   and united segment by segment, which yields each rule's candidate texts.
3. Verification: only candidates of a rule are searched for it. A rule without
   mandatory trigrams (a hexadecimal run) has none to ask for and is searched
   in every text.

Scale: a segment is bounded in texts and bytes, so a trigram in every text is
a short row of each segment and no group grows with the table. Texts are never
shuffled while the candidates (id, mark, rules) are few enough to broadcast,
which is checked; beyond that they meet the texts in a join that is salted, so
a row repeated very often is spread over tasks.

Defined cases: null counts as empty and has no span; a span covers a whole
match in code points; only ASCII letters are compared in either case; repeated
rows give one row each; a null id stays null; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from re import _constants as sre
from re import _parser as sre_parser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, read_table, text_bytes, written


class Rule(NamedTuple):
    """Matches of ``pattern``, leftmost and not overlapping, whose ``group``
    has at least ``min_chars`` characters."""
    kind: str
    pattern: str
    group: int = 0
    min_chars: int = 0
    any_case: bool = False


# The three base kinds, then the kinds that the scan adds.
BASE = [
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),
]
ADDED = [
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]*://[^\s/:@]+:[^\s/:@]+@"),
]
RULES = BASE + ADDED

#: Texts and bytes of a segment; postings number its texts with one byte.
SEGMENT_ROWS, SEGMENT_BYTES = 256, 2 << 20
#: Strings and clauses kept while a query is derived; beyond it asks for less.
MAX_STRINGS, MAX_CLAUSES, MAX_CLASS = 64, 64, 4
#: Candidates are broadcast up to this size.
BROADCAST_BYTES, CANDIDATE_BYTES, SALTS = 32 << 20, 64, 16
MEMBERS = -1
INDEX = "segment long, gram int, docs binary, members array<struct<id: long, mark: long>>"
SPANS = "doc_id long, spans array<struct<kind: string, start: long, end: long>>"

# --- Boolean trigram queries ---------------------------------------------------
# A query is a set of clauses (OR), a clause a set of trigrams (AND). The empty
# clause asks for nothing.

Query = frozenset
ANYTHING: Query = frozenset([frozenset()])


def _least(clauses: set) -> Query:
    """Without clauses that ask for more than another one."""
    return frozenset(c for c in clauses if not any(d < c for d in clauses))


def _all_of(a: Query, b: Query) -> Query:
    both = _least({c | d for c in a for d in b})
    return both if len(both) <= MAX_CLAUSES else min(a, b, key=len)


def _trigrams_of(strings: frozenset) -> Query:
    """Any of ``strings``: each asks for all its trigrams."""
    out = {frozenset(int.from_bytes(s[k:k + 3], "big") for k in range(len(s) - 2)) for s in strings}
    out = _least(out)
    return out if out and len(out) <= MAX_CLAUSES else ANYTHING


class _Part(NamedTuple):
    """What is known of the strings an expression matches: all of them
    (``exact``), or how they begin and end, and what they must contain."""
    exact: frozenset | None
    begins: frozenset
    ends: frozenset
    must: Query


_NOTHING = _Part(frozenset([b""]), frozenset([b""]), frozenset([b""]), ANYTHING)
_UNKNOWN = _Part(None, frozenset([b""]), frozenset([b""]), ANYTHING)


def _loose(p: _Part) -> _Part:
    """The same without ``exact``."""
    if p.exact is None:
        return p
    return _Part(None, p.exact, p.exact, _trigrams_of(p.exact))


def _either(a: _Part, b: _Part) -> _Part:
    if a.exact is not None and b.exact is not None and len(a.exact | b.exact) <= MAX_STRINGS:
        both = a.exact | b.exact
        return _Part(both, both, both, ANYTHING)
    a, b = _loose(a), _loose(b)
    return _short(_Part(None, a.begins | b.begins, a.ends | b.ends, _least(set(a.must | b.must))))


def _then(a: _Part, b: _Part) -> _Part:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= MAX_STRINGS:
        both = frozenset(x + y for x in a.exact for y in b.exact)
        return _Part(both, both, both, ANYTHING)
    begins = frozenset(x + y for x in a.exact for y in b.begins) if a.exact is not None else a.begins
    ends = frozenset(x + y for x in a.ends for y in b.exact) if b.exact is not None else b.ends
    across = _trigrams_of(frozenset(x + y for x in a.ends for y in b.begins))
    must = _all_of(_all_of(_loose(a).must, _loose(b).must), across)
    return _short(_Part(None, begins, ends, must))


def _short(p: _Part) -> _Part:
    """Ends as short as the trigrams across a border need them."""
    if len(p.begins) > MAX_STRINGS or any(len(x) > 2 for x in p.begins):
        p = p._replace(must=_all_of(p.must, _trigrams_of(p.begins)), begins=frozenset(x[:2] for x in p.begins))
    if len(p.ends) > MAX_STRINGS or any(len(x) > 2 for x in p.ends):
        p = p._replace(must=_all_of(p.must, _trigrams_of(p.ends)), ends=frozenset(x[-2:] for x in p.ends))
    if len(p.begins) > MAX_STRINGS:
        p = p._replace(begins=frozenset([b""]))
    return p._replace(ends=frozenset([b""])) if len(p.ends) > MAX_STRINGS else p


def _folded(code: int) -> bytes:
    return (chr(code).lower() if code < 128 else chr(code)).encode()


def _characters(members: list) -> frozenset | None:
    """The strings of a small character class."""
    out = set()
    for op, arg in members:
        if op is sre.LITERAL:
            out.add(_folded(arg))
        elif op is sre.RANGE and arg[1] - arg[0] < 2 * MAX_CLASS:
            out.update(_folded(c) for c in range(arg[0], arg[1] + 1))
        else:
            return None
    return frozenset(out) if len(out) <= MAX_CLASS + 1 else None


def _part(nodes) -> _Part:
    out = _NOTHING
    for op, arg in nodes:
        if op is sre.LITERAL:
            one = frozenset([_folded(arg)])
            p = _Part(one, one, one, ANYTHING)
        elif op is sre.IN:
            one = _characters(arg)
            p = _UNKNOWN if one is None else _Part(one, one, one, ANYTHING)
        elif op is sre.SUBPATTERN:
            p = _part(arg[3])
        elif op is sre.BRANCH:
            branches = [_part(b) for b in arg[1]]
            p = branches[0]
            for b in branches[1:]:
                p = _either(p, b)
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, inner = arg
            once = _part(inner)
            p = _UNKNOWN if low == 0 else _loose(once)
            if (low, high) == (0, 1):
                p = _either(_NOTHING, once)
            elif low == high == 1:
                p = once
        elif op is sre.AT:
            p = _NOTHING
        else:
            p = _UNKNOWN
        out = _then(out, p)
    return out


def trigram_query(pattern: str) -> Query:
    """The Boolean trigram query of a regular expression, letters folded."""
    return _loose(_part(sre_parser.parse(pattern))).must


# --- index and candidates ------------------------------------------------------

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32


def _postings(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigrams ascending, ends of their lists, texts) of a segment."""
    low = _FOLD[data]
    if len(low) < 3:
        return np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.uint8)
    codes = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = row[:-2] == row[2:]
    pairs = (codes[inside].astype(np.uint32).astype(np.uint64) << np.uint64(8)) | row[:-2][inside].astype(np.uint64)
    pairs.sort()
    pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]] if len(pairs) else pairs
    grams = (pairs >> np.uint64(8)).astype(np.int32)
    ends = np.flatnonzero(np.r_[grams[1:] != grams[:-1], True]) + 1 if len(grams) else np.zeros(0, np.int64)
    return grams[ends - 1], ends.astype(np.int32), (pairs & np.uint64(255)).astype(np.uint8)


def _segments(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for part in byte_slices(batch, 1, SEGMENT_BYTES):
        for k in range(0, part.num_rows, SEGMENT_ROWS):
            yield part.slice(k, SEGMENT_ROWS)


def trigram_index(docs: DataFrame) -> DataFrame:
    """The index of ``docs`` (doc_id, text, mark), as a written table."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        segment = TaskContext.get().partitionId() << 32
        members = pa.list_(pa.struct([("id", pa.int64()), ("mark", pa.int64())]))
        names = ["segment", "gram", "docs", "members"]
        for batch in batches:
            for part in _segments(batch):
                grams, ends, texts = _postings(*text_bytes(part.column(1)))
                n = len(grams)
                lists = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.r_[0, ends].astype(np.int32)),
                                                               pa.py_buffer(texts)])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, segment)), pa.array(grams), lists,
                                                  pa.nulls(n, members)], names)
                rows = pa.StructArray.from_arrays([part.column(0), part.column(2)], ["id", "mark"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([segment], pa.int64()), pa.array([MEMBERS], pa.int32()), pa.array([b""], pa.binary()),
                     pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows).cast(members)], names)
                segment += 1

    return written(docs.select("doc_id", "text", "mark").mapInArrow(build, INDEX), "trigram-index")


def candidates(index: DataFrame, queries: dict[int, Query]) -> DataFrame:
    """(id, mark, rules): the texts that satisfy the trigram query of at least
    one rule, with the numbers of those rules; repeated rows once."""
    asked = sorted({g for q in queries.values() for c in q for g in c})

    def intersect(table: pa.Table) -> pa.Table:
        lists = dict(zip(table.column("gram").to_pylist(), table.column("docs").to_pylist()))
        rows = next(m for m in table.column("members").to_pylist() if m is not None)
        rules: list[list[int]] = [[] for _ in rows]
        for rule, query in queries.items():
            hit = np.zeros(len(rows), bool)
            for clause in query:
                if all(g in lists for g in clause):
                    common = np.ones(len(rows), bool)
                    for g in clause:
                        has = np.zeros(len(rows), bool)
                        has[np.frombuffer(lists[g], np.uint8)] = True
                        common &= has
                    hit |= common
            for k in np.flatnonzero(hit).tolist():
                rules[k].append(rule)
        found = [(r["id"], r["mark"], x) for r, x in zip(rows, rules) if x]
        return pa.table({"id": pa.array([f[0] for f in found], pa.int64()), "mark": pa.array([f[1] for f in found], pa.int64()),
                         "rules": pa.array([f[2] for f in found], pa.list_(pa.int32()))})

    wanted = index.filter(F.col("gram").isin([MEMBERS, *asked]))
    found = wanted.groupBy("segment").applyInArrow(intersect, "id long, mark long, rules array<int>")
    return written(found.dropDuplicates(["id", "mark"]), "candidates")


# --- verification ----------------------------------------------------------------

def _search(rules: list[Rule]):
    compiled = [re.compile(r.pattern, re.ASCII | (re.IGNORECASE if r.any_case else 0)) for r in rules]

    def spans(text: str, numbers: list[int]) -> list[tuple[int, int, int]]:
        out = []
        for k in numbers:
            rule = rules[k]
            for m in compiled[k].finditer(text):
                a, b = m.span(rule.group)
                if b - a >= rule.min_chars:
                    out.append((m.start(), k, m.end()))
        return sorted(out)

    return spans


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] = RULES,
                 broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id and ``spans`` (kind, start, end in code points), by start and
    then by the order of ``rules``; one row for each row."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("mark", F.xxhash64("text"))
    queries = {k: trigram_query(r.pattern) for k, r in enumerate(rules)}
    scanned = [k for k, q in queries.items() if q == ANYTHING]
    queries = {k: q for k, q in queries.items() if q != ANYTHING}
    found = candidates(trigram_index(docs), queries) if queries else None

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _search(rules)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts, asked = batch.column(1), batch.column(2).to_pylist()
            spans = [[{"kind": rules[k].kind, "start": a, "end": b}
                      for a, k, b in search(texts[i].as_py(), sorted([*scanned, *(asked[i] or [])]))]
                     for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, kind)], ["doc_id", "spans"])

    if found is None:
        joined = docs.withColumn("rules", F.lit(None).cast("array<int>"))
    elif found.count() * CANDIDATE_BYTES <= broadcast_bytes:
        joined = docs.join(F.broadcast(found), F.col("doc_id").eqNullSafe(F.col("id")) & (docs["mark"] == found["mark"]), "left")
    else:
        found = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        docs = docs.withColumn("own_salt", (F.monotonically_increasing_id() % SALTS).cast("int"))
        joined = docs.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (docs["mark"] == found["mark"])
                           & (F.col("own_salt") == F.col("salt")), "left")
    return joined.select("doc_id", "text", "rules").mapInArrow(verify, SPANS)


def op13_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Secrets in every whole text of ``documents``."""
    found = secret_spans(read_table(spark, sf_dir, "documents"))

    def number(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE]))
    return found.select("doc_id", *(number(r.kind) for r in BASE), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def _sql_kind(number: int, rule: Rule) -> str:
    pattern = ("(?i)" if rule.any_case else "") + rule.pattern
    quoted = "'" + pattern.replace("'", "''") + "'"
    return f"""SELECT n, {number} AS k, '{rule.kind}' AS kind, list_sum(list_transform(parts[1:i], lambda x: length(x)))
         + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS a, length(hits[i]) AS len
  FROM (SELECT n, unnest(range(1, len(hits) + 1)) AS i, parts, hits, chosen
        FROM (SELECT n, string_split_regex(t, {quoted}) AS parts, regexp_extract_all(t, {quoted}) AS hits,
                     regexp_extract_all(t, {quoted}, {rule.group}) AS chosen FROM d))
  WHERE length(chosen[i]) >= {rule.min_chars}"""


_KINDS = "\n  UNION ALL ".join(_sql_kind(k, r) for k, r in enumerate(RULES))
_BASE_KINDS = ", ".join(f"'{r.kind}'" for r in BASE)
SQL = f"""WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({_KINDS}),
j AS (SELECT n, {", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in BASE)},
             string_agg(concat_ws(':', kind, a, a + len), ',' ORDER BY a, k) FILTER (WHERE kind IN ({_BASE_KINDS})) AS base,
             string_agg(concat_ws(':', kind, a, a + len), ',' ORDER BY a, k) AS spans
      FROM s GROUP BY n)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN j USING (n)"""
