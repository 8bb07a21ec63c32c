"""The training-corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
it kept. All but the last return the columns of ``documents``:

1. toxicity: documents predicted toxic go;
2. exact dedup: of equal texts (white space aside) the longest row stays;
3. n-gram Jaccard join: the smallest id of each group of near copies stays;
4. suffix-array dedup: repeated strings of 100 bytes are cut out (``text`` and
   ``n_chars`` change); a document of which nothing is left goes;
5. best-fit packing: every piece with its sequence and offset.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm import exact_dedup, jaccard_join, packing, suffix_dedup, toxicity
from quire.llm.common import read_table, written


def drop_toxic(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.classifier(spark, docs, sf_dir).clean(docs)


def drop_copies(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_duplicates(docs)


def drop_near_copies(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.representatives(docs)


def cut_repeats(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.remove_repeats(docs, keep_text=True)
    left = rows.filter("n_removed = 0 or n_removed < n_bytes")
    changed = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return left.select(*(changed[c].alias(c) if c in changed else F.col("row").getField(c).alias(c) for c in docs.columns))


def pack(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(written(packing.pieces(docs), "pieces")) \
        .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("n-gram Jaccard join", drop_near_copies),
          ("suffix-array dedup", cut_repeats), ("best-fit packing", pack)]
#: Classifier and packing have no SQL; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
