"""Explicit schemas of the engine's tables (no inference anywhere)."""

from pyspark.sql import types as T

SCORE = T.StructType([
    T.StructField("list_name", T.StringType()),
    T.StructField("score", T.DoubleType()),
])

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

# The papers table. run_seq and pos carry arrival order, which decides which
# record of a title wins an upsert.
PAPERS = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("authors", T.ArrayType(T.StringType())),
    T.StructField("venue", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("bibtex", T.StringType()),
    T.StructField("url_pdf", T.StringType()),
    T.StructField("abstract", T.StringType()),
    T.StructField("query_term", T.StringType()),
    T.StructField("accepted", T.BooleanType()),
    T.StructField("similarities", T.ArrayType(SCORE)),
    T.StructField("run_seq", T.LongType()),
    T.StructField("pos", T.LongType()),
])

PAPER_COLUMNS = [f.name for f in PAPERS.fields]

PROFILES = T.StructType([
    T.StructField("list_name", T.StringType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("weight", T.DoubleType()),
    T.StructField("sentence", T.StringType()),
])

VECTORS = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])

QUERIES = T.StructType([
    T.StructField("query_id", T.StringType()),
    T.StructField("venue", T.StringType()),
    T.StructField("query", T.StringType()),
])

REJECTS = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("missing", T.ArrayType(T.StringType())),
    T.StructField("run_seq", T.LongType()),
])

# JSON reply listing notes of a forum or a venue; ``notes`` may be absent.
NOTES_REPLY = T.StructType([
    T.StructField("notes", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("forum", T.StringType()),
        T.StructField("content", T.StructType([
            T.StructField("title", T.StringType()),
            T.StructField("decision", T.StringType()),
        ])),
    ]))),
])

# JSON document embedded in a forum page's script element.
FORUM_PAGE_DATA = T.StructType([
    T.StructField("props", T.StructType([
        T.StructField("pageProps", T.StructType([
            T.StructField("forumNote", T.StructType([
                T.StructField("id", T.StringType()),
                T.StructField("content", T.StructType([
                    T.StructField("title", T.StringType()),
                    T.StructField("authors", T.ArrayType(T.StringType())),
                    T.StructField("_bibtex", T.StringType()),
                    T.StructField("pdf", T.StringType()),
                    T.StructField("abstract", T.StringType()),
                ])),
            ])),
        ])),
    ])),
])
