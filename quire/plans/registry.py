"""Registered queries: one Spark job per operator of the blueprint, each with an
independent DuckDB SQL oracle over the same parquet tables.

Every query reads whole driver tables (or data Spark derives from them); none
subsets rows to keep the check cheap. Column names match between the Spark
result and the SQL. Doubles are rounded in both.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import browse as B
from ..operators import links as L
from ..operators import matching as M
from ..operators import nested as N
from ..operators import records as R
from ..operators import similarity as S
from ..operators import upsert as U
from . import collect as C
from . import standins as D
from ..operators.ranking import global_rank
from .rank import rank_papers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            from ..session import ensure_checkpoint_dir
            ensure_checkpoint_dir(spark)  # also ships the package to Python workers
            return fn(spark, sf)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _docs(spark, sf):
    return D.documents_as_papers(D.read(spark, sf, "documents"))


def _valid_latest(spark, sf):
    valid, _ = R.split_valid(_docs(spark, sf).withColumn("url", F.col("url_pdf")))
    return U.latest_by_title(valid)


# --- SQL building blocks -----------------------------------------------------

DOCS_P = r"""docs_p AS (
  SELECT doc_id, lang, source,
         split_part(text, chr(10), 1) AS title,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS abstract,
         CASE WHEN len(list_filter(string_split(split_part(text, chr(10), 1), ' '),
                       lambda w: w <> '' AND substr(w, 1, 1) <> lower(substr(w, 1, 1)))) > 0
              THEN list_filter(string_split(split_part(text, chr(10), 1), ' '),
                       lambda w: w <> '' AND substr(w, 1, 1) <> lower(substr(w, 1, 1))) END AS authors,
         source AS venue,
         CAST(1990 + n_chars % 35 AS INTEGER) AS year,
         'https://papers.example.org/' || source || '/' || CAST(doc_id AS VARCHAR) || '.pdf' AS url_pdf,
         '@inproceedings{doc' || CAST(doc_id AS VARCHAR) || ',' || chr(10) || '  title = {'
           || split_part(text, chr(10), 1) || '},' || chr(10) || '  year = {'
           || CAST(1990 + n_chars % 35 AS VARCHAR) || '}' || chr(10) || '}' AS bibtex,
         TRUE AS accepted,
         CAST(regexp_extract(source, '(\d+)$', 1) AS BIGINT) AS run_seq,
         doc_id AS pos
  FROM documents)"""

VALID_COND = """(coalesce(title, '') <> '' AND authors IS NOT NULL AND coalesce(venue, '') <> ''
  AND coalesce(year, 0) <> 0 AND coalesce(url_pdf, '') <> '' AND coalesce(abstract, '') <> ''
  AND coalesce(bibtex, '') <> '')"""

LATEST = f"""{DOCS_P},
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY run_seq DESC, pos DESC) AS rn
                 FROM docs_p WHERE {VALID_COND}) WHERE rn = 1)"""

MISSING_EXPR = """concat_ws(',',
    CASE WHEN title IS NULL OR title = '' THEN 'title' END,
    CASE WHEN authors IS NULL THEN 'authors' END,
    CASE WHEN venue IS NULL OR venue = '' THEN 'venue' END,
    CASE WHEN year IS NULL OR year = 0 THEN 'year' END,
    CASE WHEN url_pdf IS NULL OR url_pdf = '' THEN 'url_pdf' END,
    CASE WHEN abstract IS NULL OR abstract = '' THEN 'abstract' END,
    CASE WHEN bibtex IS NULL OR bibtex = '' THEN 'bibtex' END)"""


def _hashed_sql(text_expr: str, weight: str) -> str:
    # The tokens are cut once, and their share computed once, for each text.
    return (f"list_transform([regexp_extract_all(lower(coalesce({text_expr}, '')), '[a-z0-9]+')], "
            f"lambda ts: list_transform(list_zip(ts, list_resize(CAST([] AS DOUBLE[]), len(ts), {weight} / greatest(len(ts), 1))), "
            f"lambda z: {{'bucket': CAST(CAST(('0x' || substr(md5(z[1]), 1, 8)) AS BIGINT) % 64 AS INTEGER), 'value': z[2]}}))[1]")


PROFILES = r"""profiles AS (
  SELECT 'benchmark' AS list_name, item_id AS pos, length(text) / 100.0 AS weight, text AS sentence FROM benchmark
  UNION ALL
  SELECT 'system', conv_id, 1.0, text FROM conversations WHERE role = 'system'),
sent AS (
  SELECT list_name, weight, unnest(""" + _hashed_sql("sentence", "1.0") + r""") AS e FROM profiles),
totals AS (SELECT list_name, sum(weight) AS wtotal FROM profiles GROUP BY list_name),
prof AS (
  SELECT t.list_name, b.i AS bucket,
         coalesce((SELECT sum(s.weight * s.e.value) FROM sent s
                   WHERE s.list_name = t.list_name AND s.e.bucket = b.i), 0) / t.wtotal AS x
  FROM totals t, (SELECT range AS i FROM range(64)) b)"""

PAPER_VEC = """pv AS (
  SELECT doc_id, e.bucket AS bucket, sum(e.value) AS v FROM (
    SELECT doc_id, unnest(""" + _hashed_sql("abstract", "0.5") + """) AS e FROM latest
    UNION ALL
    SELECT doc_id, unnest(""" + _hashed_sql("title", "0.5") + """) AS e FROM latest)
  GROUP BY doc_id, e.bucket)"""


def _score_sql(list_name: str) -> str:
    return f"""scored AS (
  SELECT l.doc_id, l.title, l.run_seq, l.pos,
         coalesce((SELECT sum(pv.v * p.x) FROM pv JOIN prof p ON p.bucket = pv.bucket AND p.list_name = '{list_name}'
                   WHERE pv.doc_id = l.doc_id), 0)
         / greatest(coalesce((SELECT sqrt(sum(pv.v * pv.v)) FROM pv WHERE pv.doc_id = l.doc_id), 0)
                    * (SELECT sqrt(sum(x * x)) FROM prof WHERE list_name = '{list_name}'), 1e-8) AS score
  FROM latest l)"""


# --- P1, J5 ------------------------------------------------------------------

TITLE_QUERY = '"the" AND ing+an'


@register("title_query", f"""WITH {DOCS_P}
SELECT doc_id, title FROM docs_p
WHERE contains(lower(title), 'the') AND contains(lower(title), 'ing') AND contains(lower(title), 'an')""")
def title_query(spark, sf):
    return M.filter_by_query(_docs(spark, sf), TITLE_QUERY).select("doc_id", "title")


# Fixed inline query set: plain, '+', AND with quotes, a capital (matches
# nothing), empty (matches all), 'c++' (trailing empty pieces), a quoted space.
QUERY_SET = [("q1", "the"), ("q2", "ing+an"), ("q3", '"or" AND th'), ("q4", "The"), ("q5", ""),
             ("q6", "c++"), ("q7", '"en de"'), ("q8", "ou AND the+and")]

_QUERY_VALUES = ", ".join("('{}', '{}')".format(i, q.replace("'", "''")) for i, q in QUERY_SET)
QUERY_MATCH_SQL = f"""WITH {DOCS_P},
q(query_id, query) AS (VALUES {_QUERY_VALUES}),
qp AS (SELECT query_id, flatten(list_transform(string_split(query, ' AND '),
                                  lambda t: string_split(trim(t, '"'), '+'))) AS pieces FROM q)
SELECT d.doc_id, qp.query_id FROM docs_p d, qp
WHERE list_bool_and(list_transform(qp.pieces, lambda p: contains(lower(d.title), p)))"""


def _query_table(spark):
    return spark.createDataFrame(QUERY_SET, "query_id string, query string")


@register("query_table_match", QUERY_MATCH_SQL)
def query_table_match(spark, sf):
    return M.match_queries(_docs(spark, sf), _query_table(spark), ["doc_id"], "title", "inline") \
        .select("doc_id", "query_id")


@register("query_table_match_index", QUERY_MATCH_SQL)
def query_table_match_index(spark, sf):
    return M.match_queries(_docs(spark, sf), _query_table(spark), ["doc_id"], "title", "index") \
        .select("doc_id", "query_id")


# --- P2, P3, P4, A8 ----------------------------------------------------------

@register("valid_records", f"""WITH {DOCS_P}
SELECT doc_id, title, venue, year, len(authors) AS n_authors FROM docs_p WHERE {VALID_COND}""")
def valid_records(spark, sf):
    valid, _ = R.split_valid(_docs(spark, sf).withColumn("url", F.col("url_pdf")))
    return valid.select(F.col("pos").alias("doc_id"), "title", "venue", "year",
                        F.size("authors").cast("bigint").alias("n_authors"))


@register("reject_reasons", f"""WITH {DOCS_P}
SELECT 'invalid' AS reason, {MISSING_EXPR} AS missing, count(*) AS n FROM docs_p WHERE NOT {VALID_COND}
GROUP BY ALL""")
def reject_reasons(spark, sf):
    _, rej = R.split_valid(_docs(spark, sf).withColumn("url", F.col("url_pdf")))
    return rej.groupBy("reason", F.array_join("missing", ",").alias("missing")).agg(F.count("*").alias("n"))


# Fields emptied by id, so that every required field and reason occurs.
DAMAGED_SQL = f"""{DOCS_P},
damaged AS (SELECT * REPLACE (
  CASE WHEN doc_id % 7 = 1 THEN '' ELSE title END AS title, CASE WHEN doc_id % 11 = 2 THEN NULL ELSE authors END AS authors,
  CASE WHEN doc_id % 13 = 3 THEN NULL ELSE venue END AS venue, CASE WHEN doc_id % 17 = 4 THEN NULL ELSE year END AS year,
  CASE WHEN doc_id % 19 = 5 THEN '' ELSE url_pdf END AS url_pdf, CASE WHEN doc_id % 23 = 6 THEN NULL ELSE bibtex END AS bibtex)
  FROM docs_p)"""


def _damaged(spark, sf):
    k = F.col("doc_id")

    def lost(name, n, left, value):
        return F.when(k % n == left, F.lit(value)).otherwise(F.col(name)).alias(name)

    docs = _docs(spark, sf)
    new = {"title": lost("title", 7, 1, ""), "authors": lost("authors", 11, 2, None), "venue": lost("venue", 13, 3, None),
           "year": lost("year", 17, 4, None), "year_text": F.when(k % 17 == 4, "2023x").otherwise(F.col("year_text")),
           "url_pdf": lost("url_pdf", 19, 5, ""), "bibtex": lost("bibtex", 23, 6, None)}
    return docs.withColumns({c: v for c, v in new.items() if c in docs.columns or c == "year_text" and "year_text" in docs.columns})


@register("reject_kinds", f"""WITH {DAMAGED_SQL}
SELECT CASE WHEN year IS NULL THEN 'error' ELSE 'invalid' END AS reason, {MISSING_EXPR} AS missing, count(*) AS n
FROM damaged WHERE year IS NULL OR NOT {VALID_COND} GROUP BY ALL""")
def reject_kinds(spark, sf):
    """Both reasons, over fields emptied by id."""
    _, rej = R.split_valid(_damaged(spark, sf).withColumn("url", F.col("url_pdf")))
    return rej.groupBy("reason", F.array_join("missing", ",").alias("missing")).agg(F.count("*").alias("n"))


# --- W1, S8, U1, U2 -----------------------------------------------------------

@register("upsert_latest", f"""WITH {LATEST}
SELECT title, doc_id, run_seq FROM latest""")
def upsert_latest(spark, sf):
    return _valid_latest(spark, sf).select("title", F.col("pos").alias("doc_id"), "run_seq")


@register("union_runs", f"""WITH {DOCS_P},
bench_p AS (
  SELECT item_id AS doc_id, split_part(text, chr(10), 1) AS title,
         CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS abstract,
         CASE WHEN len(list_filter(string_split(split_part(text, chr(10), 1), ' '),
                       lambda w: w <> '' AND substr(w, 1, 1) <> lower(substr(w, 1, 1)))) > 0 THEN [''] END AS authors,
         'benchmark' AS venue, 2000 AS year, 'x' AS url_pdf, 'x' AS bibtex, CAST(-1 AS BIGINT) AS run_seq,
         item_id AS pos FROM benchmark),
runs AS (
  SELECT title, authors, venue, year, url_pdf, abstract, bibtex, run_seq, pos FROM bench_p
  UNION ALL
  SELECT title, authors, venue, year, url_pdf, abstract, bibtex, run_seq, pos FROM docs_p)
SELECT title, venue, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY title ORDER BY run_seq DESC, pos DESC) AS rn
  FROM runs WHERE {VALID_COND}) WHERE rn = 1""")
def union_runs(spark, sf):
    runs = D.benchmark_as_papers(D.read(spark, sf, "benchmark")).unionByName(_docs(spark, sf))
    valid, _ = R.split_valid(runs)
    return U.upsert(None, valid).select("title", "venue", "pos")


# --- O3 -----------------------------------------------------------------------

@register("seeded_sample", f"""WITH {DOCS_P}
SELECT doc_id, title FROM docs_p ORDER BY md5('quire:' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 100""")
def seeded_sample(spark, sf):
    return S.seeded_sample(_docs(spark, sf), 100, "doc_id", seed="quire").select("doc_id", "title")


# --- X15 ------------------------------------------------------------------------

@register("summary_line", f"""WITH {DOCS_P}
SELECT doc_id, printf('%-7s; %d; %s', venue, year, title) AS line FROM docs_p""")
def summary_line(spark, sf):
    return _docs(spark, sf).select("doc_id", B.summary_line().alias("line"))


# --- V1 (b), V4, A1, V5, W2, J7 -------------------------------------------------

@register("hashed_vectors", f"""WITH {LATEST}, {PAPER_VEC}
SELECT doc_id, bucket, round(v, 9) AS value FROM pv""")
def hashed_vectors(spark, sf):
    p = _valid_latest(spark, sf)
    vec = V.hashed_paper_vector(F.col("title"), F.col("abstract"))
    return p.select(F.col("pos").alias("doc_id"), F.explode(vec).alias("e")).select(
        "doc_id", F.col("e.bucket").alias("bucket"), F.round("e.value", 9).alias("value"))


@register("profile_vector", f"""WITH {PROFILES}
SELECT list_name, CAST(bucket AS INTEGER) AS bucket, round(x, 9) AS x FROM prof""")
def profile_vector(spark, sf):
    prof = S.profile_vectors_hashed(D.profiles(spark, sf))
    return prof.select("list_name", F.posexplode("profile").alias("bucket", "x")).select(
        "list_name", F.col("bucket").cast("int").alias("bucket"), F.round("x", 9).alias("x"))


STORED_PROFILE_SQL = """sp AS (
  SELECT 'label_' || CAST(label AS VARCHAR) AS list_name, vec_id, 1.0 + vec_id % 4 AS weight, embedding
  FROM embeddings),
spx AS (SELECT list_name, weight, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS i FROM sp),
sprof AS (SELECT list_name, i, sum(weight * CAST(x AS DOUBLE)) / sum(weight) AS x FROM spx GROUP BY list_name, i)"""


@register("profile_vector_stored", f"""WITH {STORED_PROFILE_SQL}
SELECT list_name, CAST(i AS INTEGER) AS i, round(x, 9) AS x FROM sprof""")
def profile_vector_stored(spark, sf):
    prof = S.profile_vectors_dense(D.stored_vector_profiles(spark, sf), D.stored_vectors(spark, sf))
    return prof.select("list_name", F.posexplode("profile").alias("i", "x")).select(
        "list_name", F.col("i").cast("int").alias("i"), F.round("x", 9).alias("x"))


@register("similarity_rank", f"""WITH {LATEST}, {PROFILES}, {PAPER_VEC}, {_score_sql('benchmark')}
SELECT doc_id, title, round(score, 6) AS score,
       row_number() OVER (ORDER BY round(score, 9) DESC, run_seq, pos) AS rank FROM scored""")
def similarity_rank(spark, sf):
    ranked = rank_papers(_valid_latest(spark, sf), D.profiles(spark, sf), "benchmark", digits=9)
    return ranked.select(F.col("pos").alias("doc_id"), "title", F.round("score", 6).alias("score"), "rank")


FLAGSHIP_SQL = f"""WITH {LATEST}, {PAPER_VEC}, {STORED_PROFILE_SQL},
hit AS (SELECT l.doc_id, l.title, l.run_seq, l.pos, e.embedding FROM latest l LEFT JOIN embeddings e ON e.vec_id = l.doc_id
        WHERE contains(lower(l.title), 'the')),
own AS (SELECT h.doc_id, CAST(unnest(h.embedding) AS DOUBLE) AS x, generate_subscripts(h.embedding, 1) - 1 AS i FROM hit h
        WHERE h.embedding IS NOT NULL
        UNION ALL
        SELECT h.doc_id, pv.v, pv.bucket FROM hit h JOIN pv ON pv.doc_id = h.doc_id WHERE h.embedding IS NULL),
dots AS (SELECT own.doc_id, sum(own.x * p.x) AS dot, sqrt(sum(own.x * own.x)) AS n
         FROM own JOIN sprof p ON p.i = own.i AND p.list_name = 'label_0' GROUP BY own.doc_id),
pn AS (SELECT sqrt(sum(x * x)) AS n FROM sprof WHERE list_name = 'label_0'),
s AS (SELECT h.doc_id, h.title, h.run_seq, h.pos, coalesce(d.dot, 0) / greatest(coalesce(d.n, 0) * pn.n, 1e-8) AS score
      FROM hit h LEFT JOIN dots d ON d.doc_id = h.doc_id, pn)
SELECT doc_id, title, round(score, 6) AS score FROM s ORDER BY round(score, 9) DESC, run_seq, pos LIMIT 20"""


@register("flagship", FLAGSHIP_SQL)
def flagship(spark, sf):
    """Which papers matching a query are closest to a profile? P1 -> P2 -> W1 ->
    stored vectors, or the encoder's where a paper has none -> A1 profile ->
    cosine -> top 20."""
    from ..operators.encode import hashed_encoder_factory, with_vectors
    papers = M.filter_by_query(_valid_latest(spark, sf), "the").withColumn("key", F.col("pos").cast("string"))
    vectors = D.stored_vectors(spark, sf)
    prof = S.profile_vectors_dense(D.stored_vector_profiles(spark, sf), vectors)
    vec = S.profile_literal(prof, "label_0")
    whole = with_vectors(papers, vectors, "key", hashed_encoder_factory(len(vec)))
    scored = S.score_dense(whole, "embedding", vec, "label_0")
    top = S.top_k(scored.withColumn("score", F.round("score", 9)), 20, ["run_seq", "pos"])
    return top.select(F.col("pos").alias("doc_id"), "title", F.round("score", 6).alias("score"))


# Lists by the role of a turn, and the benchmark's: all ranked at once.
ROLE_LISTS = r"""lists AS (
  SELECT 'benchmark' AS list_name, length(text) / 100.0 AS weight, text AS sentence FROM benchmark
  UNION ALL SELECT 'role_' || role, 1.0, text FROM conversations),
lsent AS (SELECT list_name, weight, unnest(""" + _hashed_sql("sentence", "1.0") + r""") AS e FROM lists),
lprof AS (SELECT s.list_name, s.e.bucket AS bucket, sum(s.weight * s.e.value) / any_value(t.w) AS x
          FROM lsent s JOIN (SELECT list_name, sum(weight) AS w FROM lists GROUP BY list_name) t ON t.list_name = s.list_name
          GROUP BY s.list_name, s.e.bucket),
lnorm AS (SELECT list_name, sqrt(sum(x * x)) AS n FROM lprof GROUP BY list_name),
pnorm AS (SELECT doc_id, sqrt(sum(v * v)) AS n FROM pv GROUP BY doc_id),
ldot AS (SELECT pv.doc_id, p.list_name, sum(pv.v * p.x) AS dot FROM pv JOIN lprof p ON p.bucket = pv.bucket GROUP BY ALL),
lscore AS (SELECT l.doc_id, l.run_seq, l.pos, ln.list_name,
                  coalesce(d.dot, 0) / greatest(coalesce(pn.n, 0) * ln.n, 1e-8) AS score
           FROM latest l CROSS JOIN lnorm ln LEFT JOIN pnorm pn ON pn.doc_id = l.doc_id
           LEFT JOIN ldot d ON d.doc_id = l.doc_id AND d.list_name = ln.list_name)"""
RANK_ALL_SQL = f"""WITH {LATEST}, {PAPER_VEC}, {ROLE_LISTS}
SELECT doc_id, list_name, round(score, 6) AS score,
       row_number() OVER (PARTITION BY list_name ORDER BY round(score, 9) DESC, run_seq, pos) AS rank FROM lscore"""


def _role_lists(spark, sf):
    bench = D.profiles(spark, sf).where(F.col("list_name") == "benchmark").select("list_name", "weight", "sentence")
    turns = D.read(spark, sf, "conversations").select(F.concat(F.lit("role_"), "role").alias("list_name"),
                                                      F.lit(1.0).alias("weight"), F.col("text").alias("sentence"))
    return bench.unionByName(turns)


@register("rank_all_lists", RANK_ALL_SQL)
def rank_all_lists(spark, sf):
    """Every paper against every list by one matrix product, and
    its rank within each list."""
    vec = V.hashed_paper_dense(F.col("title"), F.col("abstract"))
    vectors = _valid_latest(spark, sf).select("run_seq", "pos", vec.alias("embedding"))
    ranked = S.rank_all_lists(vectors, S.profile_vectors_hashed(_role_lists(spark, sf)), ["run_seq", "pos"], ["run_seq", "pos"], 9)
    return ranked.select(F.col("pos").alias("doc_id"), "list_name", F.round("score", 6).alias("score"), "rank")


@register("rank_encoded", RANK_ALL_SQL)
def rank_encoded(spark, sf):
    """the same ranks by an encoder in Python workers, over a table of
    vectors by text hash that is half filled beforehand."""
    from ..operators.encode import VectorStore, hashed_encoder_factory
    from ..session import shared_path
    from .rank import rank_encoded
    papers = _valid_latest(spark, sf)
    store = VectorStore(spark, shared_path(spark, "vectors"), "double")
    store.fill([(papers.where(F.col("pos") % 2 == 0), "title")], hashed_encoder_factory())
    ranked = rank_encoded(papers, _role_lists(spark, sf), store, hashed_encoder_factory(), 9)
    return ranked.select(F.col("pos").alias("doc_id"), "list_name", F.round("score", 6).alias("score"), "rank")


# --- S9 / J3, X16, J4, A7 ---------------------------------------------------------

def _written_back(spark, sf):
    """Latest papers with scores written back for the titles that match 'the'
    (the others keep their empty score list)."""
    papers = _valid_latest(spark, sf)
    scored = rank_papers(M.filter_by_query(papers, "the"), D.profiles(spark, sf), "system", with_rank=False)
    return U.write_back_scores(papers, scored.select("title", "list_name", "score"))


WRITTEN_SQL = f"""{LATEST}, {PROFILES}, {PAPER_VEC}, {_score_sql('system')},
wb AS (SELECT l.*, CASE WHEN contains(lower(l.title), 'the') THEN s.score END AS sim
       FROM latest l LEFT JOIN scored s ON s.doc_id = l.doc_id)"""


@register("score_writeback", f"""WITH {WRITTEN_SQL}
SELECT title, CASE WHEN sim IS NULL THEN 0 ELSE 1 END AS n_scores,
       CASE WHEN sim IS NULL THEN NULL ELSE 'system' END AS list_name, round(sim, 6) AS score FROM wb""")
def score_writeback(spark, sf):
    wb = _written_back(spark, sf)
    first = F.try_element_at("similarities", F.lit(1))
    return wb.select("title", F.size("similarities").alias("n_scores"), first["list_name"].alias("list_name"),
                     F.round(first["score"], 6).alias("score"))


@register("browse_view", f"""WITH {WRITTEN_SQL}
SELECT title AS "Title", venue AS "Venue", accepted AS "Accepted", year AS "Year",
       round(coalesce(sim, 0), 3) AS "Similarity", array_to_string(authors, ' | ') AS "Authors", url_pdf AS "URL"
FROM wb""")
def browse_view(spark, sf):
    return B.browse_view(_written_back(spark, sf))


@register("width_profile", f"""WITH {WRITTEN_SQL},
v AS (SELECT title, venue, CASE WHEN accepted THEN '1' ELSE '0' END AS acc, CAST(year AS VARCHAR) AS yr,
             printf('%.3f', coalesce(sim, 0)) AS simtxt FROM wb)
SELECT 'Title' AS "column", 8 * greatest(10, 5, max(length(title))) AS width FROM v
UNION ALL SELECT 'Venue', 8 * greatest(10, 5, max(length(venue))) FROM v
UNION ALL SELECT 'Accepted', 8 * greatest(10, 8, max(length(acc))) FROM v
UNION ALL SELECT 'Year', 8 * greatest(10, 4, max(length(yr))) FROM v
UNION ALL SELECT 'Similarity', 8 * greatest(10, 10, max(length(simtxt))) FROM v
UNION ALL SELECT 'Authors', 80
UNION ALL SELECT 'URL', 80""")
def width_profile(spark, sf):
    return B.width_profile(B.browse_view(_written_back(spark, sf)))


@register("title_lookup", f"""WITH {LATEST}
SELECT b.item_id, split_part(b.text, chr(10), 1) AS title, coalesce(l.abstract, '') AS abstract,
       coalesce(l.bibtex, '') AS bibtex
FROM benchmark b LEFT JOIN latest l ON l.title = split_part(b.text, chr(10), 1)""")
def title_lookup(spark, sf):
    sel = D.read(spark, sf, "benchmark").select("item_id", D.first_line(F.col("text")).alias("title"))
    return B.lookup_by_title(sel, _valid_latest(spark, sf), ["abstract", "bibtex"])


@register("bibtex_export", f"""WITH {LATEST}
SELECT pos, coalesce(bibtex, '') AS entry FROM latest WHERE contains(lower(title), 'the')""")
def bibtex_export(spark, sf):
    sel = M.filter_by_query(_valid_latest(spark, sf), "the")
    return B.bibtex_entries(sel).select("pos", "entry")


@register("bibtex_file", f"""WITH {LATEST}
SELECT row_number() OVER (ORDER BY run_seq, pos) - 1 AS pos, coalesce(bibtex, '') AS entry FROM latest
WHERE contains(lower(title), 'the')""")
def bibtex_file(spark, sf):
    """The export written as several text files and read back, text and order."""
    from ..session import shared_path
    from ..sources.store import export_bibtex, read_bibtex
    path = shared_path(spark, "bibtex")
    export_bibtex(M.filter_by_query(_valid_latest(spark, sf), "the"), path, entries_per_file=100)
    return read_bibtex(spark, path)


# --- A5, O2 ------------------------------------------------------------------------

@register("type_aware_sort", """SELECT p_partkey, 'p_size' AS col,
       row_number() OVER (ORDER BY CAST(p_size AS DOUBLE), p_partkey) AS rank FROM part
UNION ALL
SELECT p_partkey, 'p_type', row_number() OVER (ORDER BY p_type, p_partkey) FROM part
UNION ALL
SELECT p_partkey, 'p_retailprice', row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) FROM part""")
def type_aware_sort(spark, sf):
    part = D.read(spark, sf, "part").select(
        "p_partkey", F.col("p_size").cast("string").alias("p_size"), "p_type",
        F.col("p_retailprice").cast("string").alias("p_retailprice"))
    outs = []
    for col, desc in (("p_size", False), ("p_type", False), ("p_retailprice", True)):
        r = B.type_aware_sort(part, col, descending=desc, tie_col="p_partkey", rank_col="rank")
        outs.append(r.select("p_partkey", F.lit(col).alias("col"), "rank"))
    return outs[0].unionByName(outs[1]).unionByName(outs[2])


# Clicks on column heads, one chain a row of sorts: (column, descending).
CHAINS = [("numbers", [("p_size", False), ("p_retailprice", True), ("p_size", True)]),
          ("text_last", [("p_size", True), ("p_type", True)]),
          ("text_first", [("p_brand", False), ("p_size", False)])]


@register("resort_chain", """SELECT p_partkey, 'numbers' AS chain, row_number() OVER (ORDER BY CAST(p_size AS DOUBLE) DESC, r2) AS rank FROM (
  SELECT *, row_number() OVER (ORDER BY CAST(p_retailprice AS DOUBLE) DESC, r1) AS r2 FROM (
    SELECT *, row_number() OVER (ORDER BY CAST(p_size AS DOUBLE), p_partkey) AS r1 FROM part))
UNION ALL
SELECT p_partkey, 'text_last', row_number() OVER (ORDER BY p_type DESC, p_partkey DESC) FROM part
UNION ALL
SELECT p_partkey, 'text_first', row_number() OVER (ORDER BY CAST(p_size AS DOUBLE), r1) FROM (
  SELECT *, row_number() OVER (ORDER BY p_brand, p_partkey) AS r1 FROM part)""")
def resort_chain(spark, sf):
    """O2 in use: each sort on the order that the last one left."""
    part = D.read(spark, sf, "part").select("p_partkey", F.col("p_size").cast("string").alias("p_size"), "p_type", "p_brand",
                                            F.col("p_retailprice").cast("string").alias("p_retailprice"))
    outs = [B.sorted_by_clicks(part, clicks, "p_partkey").withColumn("chain", F.lit(name)) for name, clicks in CHAINS]
    return reduce(DataFrame.unionByName, outs).select("p_partkey", "chain", "rank")


# --- page SQL helpers ----------------------------------------------------------

def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# The references that occur in the driver's pages, and those of a page writer
# (fixed values, listed apart from the engine's; ``&amp;`` last).
SQL_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&middot;", "·"), ("&copy;", "©"),
                ("&amp;", "&")]


def sql_unescape(expr: str) -> str:
    for ent, ch in SQL_ENTITIES:
        expr = f"replace({expr}, {_sql_str(ent)}, {_sql_str(ch)})"
    return expr


SQL_MARKUP = r"""regexp_replace(html, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->', '', 'g')"""
SQL_ORIGIN = r"""regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1)"""


def sql_attr(tag_expr: str, name: str) -> str:
    p = _sql_str(rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
    return sql_unescape(f"(regexp_extract({tag_expr}, {p}, 1) || regexp_extract({tag_expr}, {p}, 2) || "
                        f"regexp_extract({tag_expr}, {p}, 3))")


def sql_link_href(elem: str) -> str:
    start = f"regexp_extract({elem}, '(?is)^<a\\b[^>]*>', 0)"
    return f"CASE WHEN regexp_matches({start}, '(?is)\\shref\\s*=') THEN {sql_attr(start, 'href')} END"


def sql_link_text(elem: str) -> str:
    inner = f"regexp_replace(regexp_replace({elem}, '(?is)^<a\\b[^>]*>', ''), '(?is)</a>$', '')"
    return sql_unescape(f"regexp_replace({inner}, '(?s)<[^>]*>', '', 'g')")


def sql_absolutize(href: str, base: str) -> str:
    return (f"CASE WHEN starts_with({href}, '/') AND NOT starts_with({href}, '//') "
            f"THEN {base} || {href} ELSE {href} END")


def sql_strip_ws(expr: str) -> str:
    return f"regexp_replace({expr}, '^\\s+|\\s+$', '', 'g')"


PAGE_LINKS = f"""m AS (SELECT page_id, url, {SQL_MARKUP} AS m FROM pages),
ea AS (SELECT page_id, url, regexp_extract_all(m, '(?is)<a\\b[^>]*>.*?</a>', 0) AS es FROM m),
pl AS (SELECT page_id, url, unnest(es) AS e, generate_subscripts(es, 1) - 1 AS pos FROM ea),
links AS (SELECT page_id, url, pos, {sql_link_href('e')} AS href, {sql_link_text('e')} AS text FROM pl)"""


# --- L4, P5, X7, L6 -------------------------------------------------------------

@register("page_links", f"""WITH {PAGE_LINKS}
SELECT page_id, url, pos, href, text FROM links""")
def page_links(spark, sf):
    return L.page_links(D.read(spark, sf, "pages"))


@register("absolute_links", f"""WITH {PAGE_LINKS}
SELECT page_id, pos, {sql_absolutize('href', SQL_ORIGIN)} AS link FROM links WHERE href IS NOT NULL""")
def absolute_links(spark, sf):
    return L.absolute_links(D.read(spark, sf, "pages")).select("page_id", "pos", "link")


@register("prefixed_ids", f"""WITH {PAGE_LINKS}
SELECT page_id, pos, href, string_split(href, '/')[-1] AS link_id FROM links WHERE starts_with(href, '/a')""")
def prefixed_ids(spark, sf):
    """L4: links with a known prefix and the id in their last segment."""
    return L.prefixed_links(D.read(spark, sf, "pages"), "/a").select("page_id", "pos", "href", "link_id")


@register("frontier", f"""WITH {PAGE_LINKS}
SELECT DISTINCT {sql_absolutize('href', SQL_ORIGIN)} AS url FROM links
WHERE href IS NOT NULL AND {sql_absolutize('href', SQL_ORIGIN)} NOT IN (SELECT url FROM pages)""")
def frontier(spark, sf):
    pages = D.read(spark, sf, "pages")
    return L.frontier(L.absolute_links(pages), pages)


LI_SQL = f"""m AS (SELECT page_id, url, {SQL_MARKUP} AS m FROM pages),
la AS (SELECT page_id, url, regexp_extract_all(m, '(?is)<li\\b[^>]*>(.*?)</li>', 1) AS lis FROM m),
li AS (SELECT page_id, url, unnest(lis) AS li, generate_subscripts(lis, 1) - 1 AS pos FROM la),
lif AS (SELECT page_id, url, pos, {sql_unescape("regexp_replace(li, '(?s)<[^>]*>', '', 'g')")} AS text,
               {sql_link_href("regexp_extract(li, '(?is)<a\\b[^>]*>.*?</a>', 0)")} AS href FROM li)"""


@register("listing_items", f"""WITH {LI_SQL}
SELECT page_id, pos, {SQL_ORIGIN} || href AS link FROM lif
WHERE contains(text, 'e') AND NOT contains(text, 'th') AND href IS NOT NULL""")
def listing_items(spark, sf):
    """L1 on the real pages' navigation lists (include 'e', exclude 'th')."""
    return L.listing_items(D.read(spark, sf, "pages"), "e", "th")


@register("search_links", f"""WITH {LI_SQL}
SELECT page_id, pos, {SQL_ORIGIN} || href AS link FROM lif WHERE contains(href, '/a')""")
def search_links(spark, sf):
    """L3: first link of each list item whose href contains '/a', host prefixed."""
    return L.search_result_links(D.read(spark, sf, "pages"), "/a")


@register("volume_links", f"""WITH {DOCS_P}
SELECT 'https://volumes.example.org/' || venue || '/' || CAST(doc_id // 50 AS VARCHAR) AS url,
       row_number() OVER (PARTITION BY venue, doc_id // 50 ORDER BY doc_id) - 1 AS pos, title,
       '/abs/' || CAST(doc_id AS VARCHAR) || '.html' AS link
FROM docs_p QUALIFY contains(lower(title), 'the')""")
def volume_links(spark, sf):
    """L2 over volume listing pages rendered from the documents."""
    pages = D.volume_pages(_docs(spark, sf))
    return L.volume_links(pages, "the").join(pages.select("page_id", "url"), "page_id") \
        .select("url", "pos", "title", "link")


# --- X4 / X8 nested text on the real pages --------------------------------------------

@register("nested_text", f"""WITH m AS (SELECT page_id, {SQL_MARKUP} AS m FROM pages)
SELECT page_id,
  {sql_strip_ws(sql_unescape("regexp_replace(regexp_extract(m, '(?is)<article\\b[^>]*>(.*?)</article>', 1), '(?s)<[^>]*>', '', 'g')"))} AS article,
  {sql_strip_ws(sql_unescape("regexp_replace(regexp_extract(m, '(?is)<h1\\b[^>]*>(.*?)</h1>', 1), '(?s)<[^>]*>', '', 'g')"))} AS h1,
  {sql_strip_ws(sql_unescape("regexp_replace(regexp_extract(m, '(?is)<div class=\"ad\">(.*?)</div>', 1), '(?s)<[^>]*>', '', 'g')"))} AS ad
FROM m""")
def nested_text(spark, sf):
    specs = [dict(name="article", tag="article"), dict(name="h1", tag="h1"), dict(name="ad", tag="div", cls="ad")]
    return N.extract(D.read(spark, sf, "pages"), specs, ["page_id"])


# --- collect: X1-X14, J1, J2, A3, P2, W1 over rendered pages ----------------------------

_LANDED: dict[tuple, str] = {}


def _landed(spark, sf, what: str, pages: Callable[[], DataFrame]) -> DataFrame:
    """Stand-in pages landed (S11) under the shared folder, partitioned by
    venue and kind; plans then scan (S1) only the partitions they need. Like a
    real landing, it happens once per session and input: later queries read
    the landed table."""
    from ..session import shared_path
    from ..sources.pages import land_pages, read_pages
    from ..sources.store import _fs
    files = sorted(D.read(spark, sf, "documents").inputFiles() + D.read(spark, sf, "labels").inputFiles())
    stamps = []
    for f in files:
        fs, p, _ = _fs(spark, f)
        st = fs.getFileStatus(p)
        stamps.append((f, st.getLen(), st.getModificationTime()))
    key = (spark.sparkContext.applicationId, what, *stamps)
    path = _LANDED.get(key)
    if path is not None:
        fs, p, jvm = _fs(spark, path)
        if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")):
            return read_pages(spark, path)
    path = shared_path(spark, what)
    land_pages(pages(), path, ["venue", "kind"], "overwrite")
    _LANDED[key] = path
    return read_pages(spark, path)


def _rendered(spark, sf):
    return _landed(spark, sf, "landed-pages", lambda: D.render_pages(_docs(spark, sf), D.read(spark, sf, "labels")))


PREPRINT_ID_SQL = """CASE WHEN d.year >= 2007
  THEN lpad(CAST(d.year % 100 AS VARCHAR), 2, '0') || '01.' || lpad(CAST(d.doc_id AS VARCHAR), CAST(greatest(5, length(CAST(d.doc_id AS VARCHAR))) AS INTEGER), '0')
  ELSE lpad(CAST(d.year % 100 AS VARCHAR), 2, '0') || '01' || lpad(CAST(d.doc_id AS VARCHAR), CAST(greatest(3, length(CAST(d.doc_id AS VARCHAR))) AS INTEGER), '0') END"""

EXPECTED = f"""{DOCS_P},
exp AS (
  SELECT d.doc_id,
    CASE d.lang WHEN 'en' THEN 'proceedings' WHEN 'fr' THEN 'conference' WHEN 'de' THEN 'preprints' ELSE 'forum' END AS venue,
    d.title,
    CASE WHEN d.lang = 'de' THEN (CASE WHEN d.authors IS NOT NULL THEN [array_to_string(d.authors, ', ')] END)
         WHEN d.lang = 'es' THEN coalesce(d.authors, [])
         ELSE d.authors END AS authors,
    d.year,
    CASE d.lang WHEN 'de' THEN 'https://preprints.example.org/pdf/' || {PREPRINT_ID_SQL}
                WHEN 'es' THEN 'https://forum.example.org/pdf?id=f' || CAST(d.doc_id AS VARCHAR)
                ELSE d.url_pdf END AS url_pdf,
    CASE d.lang WHEN 'de' THEN {sql_strip_ws("replace(d.abstract, chr(10), ' ')")}
                WHEN 'es' THEN d.abstract
                ELSE {sql_strip_ws('d.abstract')} END AS abstract,
    CASE WHEN d.lang = 'fr' AND l.doc_id IS NULL THEN NULL
         WHEN d.lang = 'en' THEN {sql_strip_ws('d.bibtex')}
         ELSE d.bibtex END AS bibtex,
    CASE d.lang WHEN 'de' THEN false WHEN 'es' THEN coalesce(l.quality = 1 OR l.toxic = 1, false) ELSE true END AS accepted,
    d.run_seq, d.pos
  FROM (SELECT * REPLACE (CASE WHEN lang IN ('en', 'fr', 'de') THEN lang ELSE 'es' END AS lang) FROM docs_p) d
  LEFT JOIN labels l ON l.doc_id = d.doc_id),
expc AS (
  SELECT *, CASE WHEN year IS NULL THEN 'error' WHEN NOT {VALID_COND} THEN 'invalid' END AS reason,
         {MISSING_EXPR} AS missing FROM exp)"""


def _records(spark, sf):
    return R.classify(C.collect_records(_rendered(spark, sf)))


@register("collect_records", f"""WITH {EXPECTED}
SELECT doc_id, venue, title, array_to_string(authors, ' | ') AS authors, year, url_pdf, abstract, bibtex,
       accepted, reason, missing FROM expc""")
def collect_records(spark, sf):
    return _records(spark, sf).select(
        "doc_id", "venue", "title", F.array_join("authors", " | ").alias("authors"), "year", "url_pdf",
        "abstract", "bibtex", "accepted", "reason", F.array_join("missing", ",").alias("missing"))


@register("collect_rejects", f"""WITH {EXPECTED}
SELECT venue, reason, missing, count(*) AS n FROM expc WHERE reason IS NOT NULL GROUP BY ALL""")
def collect_rejects(spark, sf):
    recs = _records(spark, sf)
    return recs.where(F.col("reason").isNotNull()).groupBy(
        "venue", "reason", F.array_join("missing", ",").alias("missing")).agg(F.count("*").alias("n"))


@register("collect_papers", f"""WITH {EXPECTED}
SELECT title, doc_id, venue FROM (
  SELECT *, row_number() OVER (PARTITION BY title ORDER BY run_seq DESC, pos DESC) AS rn
  FROM expc WHERE reason IS NULL) WHERE rn = 1""")
def collect_papers(spark, sf):
    valid, _ = C.collect(_rendered(spark, sf))
    return U.upsert(None, valid).select("title", F.col("pos").alias("doc_id"), "venue")


# The listings a crawl walks, as (venue, kind, number), without their html:
# fronts and results name the next page, fronts the volumes of their ids.
CRAWL = f"""lastid AS (SELECT max(doc_id) AS n FROM documents),
walk AS (
  SELECT venue, kind, CAST(0 AS BIGINT) AS k FROM (VALUES ('proceedings', 'front'), ('conference', 'results'),
    ('preprints', 'results'), ('forum', 'results')) v(venue, kind)
  UNION
  SELECT w.venue, s.kind, s.k FROM walk w, lastid, LATERAL (
    SELECT w.kind AS kind, w.k + 1 AS k WHERE w.kind <> 'volume' AND w.k < n //
      CASE w.venue WHEN 'proceedings' THEN {D.VOLUME * D.VOLUMES} WHEN 'forum' THEN {D.REPLY_PAGE} ELSE {D.RESULTS} END
    UNION ALL
    SELECT 'volume', j FROM (SELECT unnest(range(w.k * {D.VOLUMES}, (w.k + 1) * {D.VOLUMES})) AS j)
    WHERE w.kind = 'front' AND j <= n // {D.VOLUME}) s),
found AS (
  SELECT e.* FROM expc e JOIN walk w ON w.venue = e.venue AND w.kind <> 'front' AND w.k = e.doc_id //
    CASE e.venue WHEN 'proceedings' THEN {D.VOLUME} WHEN 'forum' THEN {D.REPLY_PAGE} ELSE {D.RESULTS} END)"""
_RECORD_SQL = """doc_id, venue, title, array_to_string(authors, ' | ') AS authors, year, url_pdf, abstract, bibtex,
       accepted, reason, missing"""


def _site(spark, sf):
    """Landed pages, the listings that lead to them, and the listings' first pages."""
    pages = _rendered(spark, sf)
    seeds = spark.createDataFrame([(u,) for u in D.LISTING_SEEDS], "url string")
    listings = _landed(spark, sf, "landed-listings", lambda: D.listing_pages(_docs(spark, sf)))
    return pages.unionByName(listings), seeds


def _found(records):
    return R.classify(records).select(
        "doc_id", "venue", "title", F.array_join("authors", " | ").alias("authors"), "year", "url_pdf",
        "abstract", "bibtex", "accepted", "reason", F.array_join("missing", ",").alias("missing"))


@register("collect_from_listings", f"""WITH RECURSIVE {EXPECTED},
{CRAWL}
SELECT {_RECORD_SQL} FROM found""")
def collect_from_listings(spark, sf):
    """The listings walked to a fixpoint, then the records of
    the detail pages they lead to."""
    pages, seeds = _site(spark, sf)
    return _found(C.collect_from_listings(pages, seeds))


@register("collect_query_from_listings", f"""WITH RECURSIVE {EXPECTED},
{CRAWL}
SELECT {_RECORD_SQL.replace(" title,", " coalesce(title, '') AS title,")} FROM found
WHERE contains(lower(coalesce(title, '')), 'the') AND contains(lower(coalesce(title, '')), 'ing')
  AND contains(lower(coalesce(title, '')), 'an')""")
def collect_query_from_listings(spark, sf):
    """P1 at the listings and below the Python pass: only pages whose title
    matches are parsed."""
    pages, seeds = _site(spark, sf)
    return _found(C.collect_from_listings(pages, seeds, TITLE_QUERY))


@register("crawl_frontier", f"""WITH RECURSIVE {EXPECTED},
{CRAWL}
SELECT CASE venue WHEN 'proceedings' THEN 'https://proceedings.example.org/v0/missing' || k || '.html'
                  WHEN 'conference' THEN 'https://conference.example.org/paper/missing' || k || '-Abstract.html'
                  WHEN 'preprints' THEN 'https://preprints.example.org/abs/0001.m' || k
                  ELSE 'https://forum.example.org/forum?id=missing' || k END AS url
FROM walk WHERE kind <> 'front'""")
def crawl_frontier(spark, sf):
    """What the reached listings link to and nobody has landed."""
    from ..operators.crawl import to_fetch
    pages, seeds = _site(spark, sf)
    links, reached = C.crawl(pages, seeds)
    return to_fetch(links, reached, pages)


_FQ_FIELDS = ["title", "authors", "venue", "year", "url_pdf", "abstract", "bibtex", "accepted"]


def _fq_sql(ctes: str = EXPECTED, table: str = "exp", badcast: str = "false") -> str:
    parts = []
    for f in _FQ_FIELDS:
        blank = {"authors": "len(authors) = 0", "year": "false", "accepted": "false"}.get(f, f"{f} = ''")
        parts.append(f"SELECT '{f}' AS field, count(*) AS n_rows, count(*) - count({f}) AS n_null, "
                     f"count(*) FILTER (WHERE {blank}) AS n_blank, "
                     f"count(*) FILTER (WHERE {badcast if f == 'year' else 'false'}) AS n_badcast FROM {table}")
    return f"WITH {ctes}\n" + "\nUNION ALL\n".join(parts)


@register("field_quality", _fq_sql())
def field_quality(spark, sf):
    return R.field_quality(C.collect_records(_rendered(spark, sf)))


# The damage of D.damage_pages: what is left of the records' fields.
DAMAGED_PAGES = f"""{EXPECTED},
hurt AS (SELECT *, venue = 'forum' AND doc_id % 5 = 1 AS cut, venue = 'forum' AND doc_id % 5 = 2 AS odd,
                venue <> 'forum' AND doc_id % 7 = 3 AS broken,
                venue IN ('proceedings', 'conference') AND doc_id % 7 = 4 AS undated FROM exp),
left_over AS (SELECT * REPLACE (
    CASE WHEN cut OR (broken AND venue = 'preprints') THEN NULL ELSE title END AS title,
    CASE WHEN cut OR odd OR (broken AND venue = 'preprints') THEN NULL ELSE authors END AS authors,
    CASE WHEN undated THEN NULL ELSE year END AS year,
    CASE WHEN cut THEN NULL ELSE url_pdf END AS url_pdf,
    CASE WHEN cut OR broken THEN NULL ELSE abstract END AS abstract,
    CASE WHEN cut OR (broken AND venue = 'proceedings') THEN NULL ELSE bibtex END AS bibtex) FROM hurt)"""


def _damaged_pages(spark, sf):
    return C.collect_records(D.damage_pages(_rendered(spark, sf)))


@register("damaged_pages", f"""WITH {DAMAGED_PAGES}
SELECT doc_id, venue, CASE WHEN cut OR broken OR year IS NULL THEN 'error' WHEN NOT {VALID_COND} THEN 'invalid' END AS reason,
       {MISSING_EXPR} AS missing FROM left_over""")
def damaged_pages(spark, sf):
    """Pages that the parser refuses, embedded JSON that is cut off, years
    that are no numbers: ``error``; a mistyped field: ``invalid``."""
    return R.classify(_damaged_pages(spark, sf)).select("doc_id", "venue", "reason", F.array_join("missing", ",").alias("missing"))


@register("field_quality_damaged", _fq_sql(DAMAGED_PAGES, "left_over", "undated"))
def field_quality_damaged(spark, sf):
    """P3 over damaged pages: failed casts of the year, nulls of lost fields."""
    return R.field_quality(_damaged_pages(spark, sf))


@register("meta_fields", f"""WITH {DOCS_P}
SELECT doc_id, title, array_to_string(authors, ' | ') AS authors, CAST(year AS VARCHAR) AS year_text, url_pdf
FROM docs_p WHERE lang IN ('en', 'fr')""")
def meta_fields(spark, sf):
    """X1-X3 alone (JVM only) on the rendered proceedings and conference pages."""
    from ..functions import html as H
    pages = _rendered(spark, sf).where(F.col("kind") == "detail").where(F.col("venue").isin("proceedings", "conference"))
    mt = pages.select("doc_id", H.meta_pairs(H.markup(F.col("html"))).alias("_mt"))
    mp = F.col("_mt")
    return mt.select("doc_id", H.first_meta(mp, "citation_title").alias("title"),
                     F.array_join(H.all_metas(mp, "citation_author"), " | ").alias("authors"),
                     F.substring(H.first_meta(mp, "citation_publication_date"), 1, 4).alias("year_text"),
                     H.first_meta(mp, "citation_pdf_url").alias("url_pdf"))


@register("bibtex_join", f"""WITH {DOCS_P}
SELECT d.doc_id, 'https://conference.example.org/bibtex/doc' || CAST(d.doc_id AS VARCHAR) || '.bib' AS bibtex_url,
       CASE WHEN l.doc_id IS NOT NULL THEN d.bibtex END AS bibtex
FROM docs_p d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE d.lang = 'fr'""")
def bibtex_join(spark, sf):
    """Detail page -> link reading 'Bibtex' -> left join to the landed
    bibtex pages (absent -> null)."""
    pages = _rendered(spark, sf)
    det = L.link_by_text(pages.where((F.col("kind") == "detail") & (F.col("venue") == "conference")),
                         "Bibtex", keep=["doc_id", "url"]).withColumnRenamed("link", "bibtex_url")
    bib = pages.where(F.col("kind") == "bibtex").select(F.col("url").alias("bibtex_url"), F.col("html").alias("bibtex"))
    return det.join(bib, "bibtex_url", "left").select("doc_id", "bibtex_url", "bibtex")


@register("accept_flag", f"""WITH {DOCS_P}
SELECT 'f' || CAST(d.doc_id AS VARCHAR) AS fid, coalesce(l.quality = 1 OR l.toxic = 1, false) AS accepted,
       l.doc_id IS NOT NULL AS has_notes
FROM docs_p d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE coalesce(d.lang NOT IN ('en', 'fr', 'de'), true)""")
def accept_flag(spark, sf):
    return C.forum_accept(_rendered(spark, sf))


@register("notes_json", """SELECT CAST(conv_id AS VARCHAR) AS forum, CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS note_id,
       split_part(text, chr(10), 1) AS title, role AS decision
FROM conversations WHERE contains(lower(split_part(text, chr(10), 1)), 'the')""")
def notes_json(spark, sf):
    """S2 + L5: notes replies (JSON) parsed, title query on the note title."""
    from ..sources.notes import parse_notes
    replies = D.conversation_listing(D.read(spark, sf, "conversations"))
    notes = parse_notes(replies, "body")
    return M.filter_by_query(notes, "the").select("forum", "note_id", "title", "decision")


@register("id_to_year", """SELECT o_orderkey,
  CASE o_orderstatus WHEN 'O' THEN strftime(o_orderdate, '%y%m') || '.' || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(7, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0')
                     WHEN 'F' THEN strftime(o_orderdate, '%y%m') || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')
                     ELSE 'x' || CAST(o_orderkey AS VARCHAR) END AS pid,
  CASE WHEN o_orderstatus = 'O' THEN 'https://preprints.example.org/abs/' ELSE 'https://preprints.example.org/abs/cs/' END
  || CASE o_orderstatus WHEN 'O' THEN strftime(o_orderdate, '%y%m') || '.' || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(7, length(CAST(o_orderkey AS VARCHAR))) AS INTEGER), '0')
                     WHEN 'F' THEN strftime(o_orderdate, '%y%m') || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')
                     ELSE 'x' || CAST(o_orderkey AS VARCHAR) END AS url,
  CASE o_orderstatus WHEN 'O' THEN '20' || strftime(o_orderdate, '%y')
                     WHEN 'F' THEN CASE WHEN CAST(strftime(o_orderdate, '%y') AS INTEGER) > 7
                                        THEN '19' ELSE '20' END || strftime(o_orderdate, '%y') END AS year
FROM orders""")
def id_to_year(spark, sf):
    from ..functions.ids import preprint_url_and_year
    o = D.read(spark, sf, "orders")
    yymm = F.date_format("o_orderdate", "yyMM")
    pid = (F.when(F.col("o_orderstatus") == "O",
                  F.concat(yymm, F.lit("."), D.padded(F.col("o_orderkey"), 7)))
           .when(F.col("o_orderstatus") == "F",
                 F.concat(yymm, F.lpad(F.pmod("o_orderkey", F.lit(1000)).cast("string"), 3, "0")))
           .otherwise(F.concat(F.lit("x"), F.col("o_orderkey").cast("string"))))
    uy = preprint_url_and_year(pid)
    return o.select("o_orderkey", pid.alias("pid"), uy["url"].alias("url"), uy["year"].alias("year"))


# --- S5, P8 ----------------------------------------------------------------------------

@register("csv_records", f"""WITH {DOCS_P}
SELECT title, CASE WHEN authors IS NOT NULL THEN array_to_string(authors, '; ') END AS authors,
       CASE WHEN lang = 'de' THEN NULL ELSE year END AS year, abstract,
       CASE WHEN lang = 'es' THEN '' ELSE url_pdf END AS url_pdf, lang <> 'es' AS accepted
FROM docs_p""")
def csv_records(spark, sf):
    """S5 round trip: a 16-column CSV export written from the documents (quoted
    commas, quotes and newlines; 'n.d.' years; empty pdf urls), read back by
    position."""
    from ..session import shared_path
    from ..sources.store import read_csv_papers
    d = _docs(spark, sf)
    cols = [F.lit("").alias(f"c{i}") for i in range(16)]
    cols[0] = F.col("title").alias("c0")
    cols[1] = F.array_join("authors", "; ").alias("c1")
    cols[5] = F.when(F.col("lang") == "de", F.lit("n.d.")).otherwise(F.col("year").cast("string")).alias("c5")
    cols[10] = F.col("abstract").alias("c10")
    cols[15] = F.when(F.col("lang") == "es", F.lit("")).otherwise(F.col("url_pdf")).alias("c15")
    path = shared_path(spark, "csv-export") + "/ieee.csv"
    d.select(*cols).write.option("header", True).option("escape", '"').csv(path)
    recs = read_csv_papers(spark, path)
    return recs.select("title", F.array_join("authors", "; ").alias("authors"), "year", "abstract", "url_pdf",
                       "accepted")


# --- T1 ----------------------------------------------------------------------------------

@register("stream_ingest", f"""WITH {LATEST}
SELECT title, doc_id, run_seq FROM latest""")
def stream_ingest(spark, sf):
    """The documents' records landed as several files and ingested by a
    stream (one upsert per micro-batch); ends equal to the batch upsert."""
    from ..streaming.ingest import ingest_landed_records
    store = ingest_landed_records(spark, _docs(spark, sf).withColumn("url", F.col("url_pdf")), n_files=4,
                                  files_per_batch=1)
    return store.read().select("title", F.col("pos").alias("doc_id"), "run_seq")


# --- J6, V1 (c), A4 ------------------------------------------------------------------------

@register("linked_pages", f"""WITH {PAGE_LINKS},
abs AS (SELECT page_id, pos, {sql_absolutize('href', SQL_ORIGIN)} AS link FROM links WHERE href IS NOT NULL)
SELECT a.page_id, a.pos, a.link, p.page_id AS target_page_id FROM abs a JOIN pages p ON p.url = a.link""")
def linked_pages(spark, sf):
    """Links of the landed pages that point at landed pages."""
    pages = D.read(spark, sf, "pages")
    return L.linked_pages(L.absolute_links(pages).select("page_id", "pos", "link"), pages)


@register("encoded_vectors", f"""WITH {LATEST},
t AS (SELECT DISTINCT md5(coalesce(x, '')) AS key, x FROM (SELECT title AS x FROM latest UNION ALL SELECT abstract FROM latest)),
e AS (SELECT key, unnest({_hashed_sql('x', '1.0')}) AS e FROM t)
SELECT key, e.bucket AS bucket, round(sum(e.value), 9) AS value FROM e GROUP BY key, e.bucket""")
def encoded_vectors(spark, sf):
    """V1 (c): a user encoder in Python workers over the distinct titles and
    abstracts that the table of vectors lacks (by md5 key): it holds the
    titles of every third paper, then is filled twice. The encoder is the numpy
    twin of the hashed encoder, so SQL can check it."""
    from ..operators.encode import VectorStore, hashed_encoder_factory
    from ..session import shared_path
    papers = _valid_latest(spark, sf)
    store = VectorStore(spark, shared_path(spark, "vectors"), "double")
    store.fill([(papers.where(F.col("pos") % 3 == 0), "title")], hashed_encoder_factory())
    for _ in range(2):
        store.fill([(papers, "title"), (papers, "abstract")], hashed_encoder_factory())
    return store.read().select("key", F.posexplode("embedding").alias("bucket", "value")).where(F.col("value") > 0) \
        .select("key", F.col("bucket").cast("int").alias("bucket"), F.round("value", 9).alias("value"))


@register("collect_counts", f"""WITH {EXPECTED}
SELECT venue, count(*) AS n_records, count(*) FILTER (WHERE reason IS NULL) AS n_valid,
       count(*) FILTER (WHERE reason IS NOT NULL) AS n_rejected FROM expc GROUP BY venue""")
def collect_counts(spark, sf):
    """A4: records read, kept and rejected per venue (one aggregate)."""
    recs = _records(spark, sf)
    return recs.groupBy("venue").agg(F.count("*").alias("n_records"),
                                     F.count(F.when(F.col("reason").isNull(), True)).alias("n_valid"),
                                     F.count(F.when(F.col("reason").isNotNull(), True)).alias("n_rejected"))


@register("linked_site_pages", f"""WITH {DOCS_P}
SELECT 'https://conference.example.org/paper/doc' || CAST(d.doc_id AS VARCHAR) || '-Abstract.html' AS url,
       CAST(1 AS BIGINT) AS pos, 'https://conference.example.org/bibtex/doc' || CAST(d.doc_id AS VARCHAR) || '.bib' AS link,
       'bibtex' AS target_kind
FROM docs_p d JOIN labels l ON l.doc_id = d.doc_id WHERE d.lang = 'fr'""")
def linked_site_pages(spark, sf):
    """J6 on the rendered site: every link of every landed detail page, joined
    to the landed pages it points at."""
    pages = _rendered(spark, sf)
    detail = pages.where(F.col("kind") == "detail").select("page_id", "url", "html")
    hits = L.linked_pages(L.absolute_links(detail).select("url", "pos", "link"), pages)
    kinds = pages.select(F.col("page_id").alias("target_page_id"), F.col("kind").alias("target_kind"))
    return hits.join(kinds, "target_page_id").select("url", "pos", "link", "target_kind")


@register("stream_collect", f"""WITH {EXPECTED}
SELECT title, doc_id, venue FROM (
  SELECT *, row_number() OVER (PARTITION BY title ORDER BY run_seq DESC, pos DESC) AS rn
  FROM expc WHERE reason IS NULL) WHERE rn = 1""")
def stream_collect(spark, sf):
    """T1 over pages: the landed pages are copied into a landing directory as
    several files; a stream runs the collect plan per micro-batch and upserts
    into the versioned store. Ends equal to the batch collect (W1 winners)."""
    from ..session import shared_path
    from ..sources.pages import land_pages
    from ..sources.store import PaperStore
    from ..streaming.ingest import ingest_landed_pages
    landing = shared_path(spark, "page-landing")
    land_pages(_rendered(spark, sf), landing, ["venue", "kind"])
    store = PaperStore(spark, shared_path(spark, "papers"))
    ingest_landed_pages(spark, landing, store)
    return store.read().select("title", F.col("pos").alias("doc_id"), "venue")


@register("stream_late_lookups", f"""WITH {EXPECTED}
SELECT title, doc_id, venue FROM (
  SELECT *, row_number() OVER (PARTITION BY title ORDER BY run_seq DESC, pos DESC) AS rn
  FROM expc WHERE reason IS NULL AND venue <> 'forum') WHERE rn = 1""")
def stream_late_lookups(spark, sf):
    """Pages whose BibTeX page lands after them are rejected first and
    wait in state for the later batch. (Forum pages are valid without their notes.)"""
    from ..session import shared_path
    from ..sources.pages import land_pages
    from ..sources.store import PaperStore
    from ..streaming.ingest import ingest_landed_pages
    pages = _rendered(spark, sf).where(F.col("venue") != "forum")
    landing, checkpoint = shared_path(spark, "page-landing"), shared_path(spark, "stream-ckpt")
    store = PaperStore(spark, shared_path(spark, "papers"))
    for kinds in (F.col("kind") == "detail", F.col("kind") != "detail"):
        land_pages(pages.where(kinds), landing, ["venue", "kind"])
        ingest_landed_pages(spark, landing, store, checkpoint=checkpoint)
    return store.read().select("title", F.col("pos").alias("doc_id"), "venue")


@register("stream_after_writeback", f"""WITH {LATEST}
SELECT title, doc_id, run_seq, false AS scored FROM latest""")
def stream_after_writeback(spark, sf):
    """Two streams into one table with a score write-back between
    them; no batch is taken for a replay, and re-collected titles lose scores."""
    from ..session import shared_path
    from ..streaming.ingest import ingest_landed_records
    docs = _docs(spark, sf).withColumn("url", F.col("url_pdf"))
    path = shared_path(spark, "papers")
    store = ingest_landed_records(spark, docs.where(F.col("pos") % 2 == 0), path)
    store.write_back(store.read().select("title", F.lit("list").alias("list_name"), F.lit(0.5).alias("score")))
    store = ingest_landed_records(spark, docs, path)
    return store.read().select("title", F.col("pos").alias("doc_id"), "run_seq",
                               (F.size("similarities") > 0).alias("scored"))


# Fixed run table for collect_runs: query terms x venues, in run order.
RUN_TERMS = ["the", "ing+an", '"or" AND th']
RUN_VENUES = ["proceedings", "conference", "forum"]
RUNS = [(t * len(RUN_VENUES) + v, term, venue) for t, term in enumerate(RUN_TERMS) for v, venue in enumerate(RUN_VENUES)]
_RUN_VALUES = ", ".join("({}, '{}', '{}')".format(s, q.replace("'", "''"), v) for s, q, v in RUNS)


@register("collect_runs", f"""WITH {EXPECTED},
runs(run_seq, query, venue) AS (VALUES {_RUN_VALUES}),
rp AS (SELECT run_seq, query, venue, flatten(list_transform(string_split(query, ' AND '),
               lambda t: string_split(trim(t, '"'), '+'))) AS pieces FROM runs),
hits AS (SELECT e.title, e.doc_id, e.venue, e.pos, CAST(r.run_seq AS BIGINT) AS run_seq, r.query AS query_term
         FROM expc e JOIN rp r ON r.venue = e.venue
         WHERE e.reason IS NULL AND list_bool_and(list_transform(r.pieces, lambda p: contains(lower(e.title), p))))
SELECT title, doc_id, venue, query_term, run_seq FROM (
  SELECT *, row_number() OVER (PARTITION BY title ORDER BY run_seq DESC, pos DESC) AS rn FROM hits) WHERE rn = 1""")
def collect_runs(spark, sf):
    """Nine collect runs (three query terms x three venues) over the
    landed pages; the last run to touch a title wins, with its query term."""
    runs = spark.createDataFrame(RUNS, "run_seq long, query string, venue string")
    recs = C.collect_records(_rendered(spark, sf))
    return C.collect_runs(recs, runs).select("title", F.col("pos").alias("doc_id"), "venue", "query_term", "run_seq")


# More runs than the inline plan takes: each distinct word of the benchmark
# passages, against two venues.
MANY_RUNS = """words AS (SELECT DISTINCT lower(unnest(regexp_extract_all(text, '[A-Za-z]{3,}'))) AS w FROM benchmark),
runs AS (SELECT CAST(row_number() OVER (ORDER BY w, v.venue) AS BIGINT) AS run_seq, w AS query, v.venue AS venue
         FROM words, (VALUES ('proceedings'), ('conference')) v(venue))"""


def many_runs(spark, sf):
    words = D.read(spark, sf, "benchmark").select(F.explode(F.regexp_extract_all(
        "text", F.lit("[A-Za-z]{3,}"), 0)).alias("w")).select(F.lower("w").alias("query")).distinct()
    both = words.withColumn("venue", F.explode(F.array(F.lit("proceedings"), F.lit("conference"))))
    return global_rank(both, [F.col("query"), F.col("venue")], "run_seq")


@register("collect_runs_many", f"""WITH {EXPECTED},
{MANY_RUNS},
hits AS (SELECT e.title, e.doc_id, e.venue, e.pos, r.run_seq, r.query AS query_term
         FROM expc e JOIN runs r ON r.venue = e.venue AND contains(lower(e.title), r.query)
         WHERE e.reason IS NULL)
SELECT title, doc_id, venue, query_term, run_seq FROM (
  SELECT *, row_number() OVER (PARTITION BY title ORDER BY run_seq DESC, pos DESC) AS rn FROM hits) WHERE rn = 1""")
def collect_runs_many(spark, sf):
    """U2 / J5 over hundreds of runs, above the inline plan's limit."""
    recs = C.collect_records(_rendered(spark, sf), venues=["proceedings", "conference"])
    return C.collect_runs(recs, many_runs(spark, sf)) \
        .select("title", F.col("pos").alias("doc_id"), "venue", "query_term", "run_seq")
