"""Toxicity scores: gradient-boosted trees over dense features, calibrated by
isotonic regression.

Features of a whole text: densities and strengths of a lexicon of words and
of word beginnings, nearness of its hits to second-person words, capitals,
punctuation and obfuscation (masked or substituted characters). The lexicon
is learnt from a part of the labelled rows (smoothed log-odds of documents
that hold a term), the trees from a second part, the calibration from a
third, so that no part judges terms or trees by rows they were made from.

Scale: the classifier is fitted on about ``LEARN_ROWS`` labelled rows drawn by
a hash of the id (the only bound; every text is read whole); their ids are
broadcast, so texts aren't shuffled. Scoring is one pass without a shuffle;
the lexicon holds at most ``LEXICON`` terms.

Defined cases: null or empty text has the features of an empty one and gets a
score; rows without a label teach nothing; a document labelled twice counts
as toxic if one label says so; repeated rows are scored each; a null id is
never held out; without both labels the score is the share of toxic rows,
and with fewer than ``CALIBRATED`` toxic rows to calibrate by it is the trees'
probability; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_words import forget
from .common import byte_slices, held_out, read_table, text_bytes, texts, written

#: Labelled rows that the classifier is fitted on, on average.
LEARN_ROWS = 24_000
#: Terms of the lexicon, and the toxic rows that a term must occur in.
LEXICON, SUPPORT = 4000, 3
#: Toxic rows below which scores stay as the trees give them.
CALIBRATED = 40
#: Lengths of word beginnings that are terms.
STEMS = (4, 5, 6)
#: Log-odds from which a term counts as strong.
STRONG = 3.0
_MEMO = 400_000
#: Bytes of text that a pass holds in arrays at once.
SLICE = 1 << 20
FEATURES = ("words", "word_density", "word_strength", "word_hits", "stem_density", "stem_strength", "stem_hits",
            "near_you", "you_density", "capitals", "shouted", "exclamations", "questions", "marks", "masked",
            "substituted")
#: Second-person words (fixed values; English, French, German, Spanish).
SECOND_PERSON = frozenset("""you your yours yourself yourselves u ur tu te toi vous votre vos ton tes du dich dir dein
deine deiner deinem euch euer eure ihr tú ti usted ustedes vosotros vuestro vuestra""".split())
#: Characters that stand for letters (fixed values).
SUBSTITUTES = str.maketrans("013457@$!", "oieastasi")
_EDGES = re.compile(r"^[^\w@$*#]+|[^\w@$*#]+$")
_INSIDE = re.compile(r"[^\W\d_][\d@$*#.\-_!]+[^\W\d_]|[^\W\d_]*[013457@$!]+[^\W\d_]+")
_MASK = re.compile(r"\w[*#$%@]+\w|[*#$%&@]{2,}")


def forms(token: str) -> list[str]:
    """The word in a token: lower case without its edges and, where it is
    obfuscated, with substitutes and separators undone."""
    word = _EDGES.sub("", token).lower()
    if word.isalpha() or not word:
        return [word] if word else []
    plain = re.sub(r"[^\w]|_", "", word.translate(SUBSTITUTES))
    return [w for w in dict.fromkeys((re.sub(r"[\W\d_]+", "", word), plain)) if w]


def terms(token: str) -> set[str]:
    """Words, and beginnings marked by a closing hyphen."""
    out = set()
    for w in forms(token):
        out.add(w)
        out.update(w[:n] + "-" for n in STEMS if len(w) > n)
    return out


class Reader:
    """Features of texts under a lexicon (term: log-odds)."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.memo = lexicon, {}

    def look(self, token: str) -> tuple | None:
        """(word strength, stem strength, second person, shouted, masked,
        substituted); None for an ordinary token."""
        found = forms(token)
        word = max((self.lexicon.get(w, 0.0) for w in found), default=0.0)
        stem = max((self.lexicon.get(w[:n] + "-", 0.0) for w in found for n in STEMS if len(w) > n), default=0.0)
        out = (word, stem, any(w in SECOND_PERSON for w in found), len(token) > 2 and token.isupper(),
               bool(_MASK.search(token)), not token.isalpha() and bool(_INSIDE.search(token)))
        return out if any(out) else None

    def features(self, batch: list[str], offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
        out = np.zeros((len(batch), len(FEATURES)))
        for k, text in enumerate(batch):
            tokens = text.split()
            new = set(tokens).difference(self.memo)
            if len(self.memo) + len(new) > _MEMO:
                self.memo.clear()
                new = set(tokens)
            for t in new:
                self.memo[t] = self.look(t)
            get = self.memo.__getitem__
            hits = [(i, m) for i, m in enumerate(map(get, tokens)) if m is not None]
            n = max(1, len(tokens))
            words = [(i, m[0]) for i, m in hits if m[0] > 0]
            stems = [(i, m[1]) for i, m in hits if m[1] > 0]
            you = np.array([i for i, m in hits if m[2]])
            near = 0.0
            if len(you):
                for i, w in words + stems:
                    if w >= STRONG:
                        near = max(near, 1.0 / (1.0 + float(np.abs(you - i).min())))
            chars = np.bincount(data[offsets[k]:offsets[k + 1]], minlength=256)
            size = max(1, int(chars.sum()))
            capitals = int(chars[65:91].sum())
            letters = max(1, capitals + int(chars[97:123].sum()))
            out[k] = (math.log1p(len(tokens)), sum(w for _, w in words) / n, max((w for _, w in words), default=0.0),
                      math.log1p(sum(w >= STRONG for _, w in words)), sum(w for _, w in stems) / n,
                      max((w for _, w in stems), default=0.0), math.log1p(sum(w >= STRONG for _, w in stems)), near,
                      len(you) / n, capitals / letters, sum(m[3] for _, m in hits) / n, chars[33] / size,
                      chars[63] / size, int(chars[[34, 35, 36, 37, 38, 42, 44, 46, 58, 59, 64]].sum()) / size,
                      sum(m[4] for _, m in hits) / n, sum(m[5] for _, m in hits) / n)
        return out


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Terms and log-odds (less one standard error) from (text, toxic) rows;
    equal texts count once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, 0, 8 << 20):
                tally = (Counter(), Counter())
                for text, toxic in zip(texts(b.column(0)), b.column(1).to_pylist(), strict=True):
                    tally[toxic].update(set().union(*map(terms, set(text.split()))))
                names = list(tally[0].keys() | tally[1].keys())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), *(pa.array([t[x] for x in names], pa.int64()) for t in tally)],
                    ["term", "clean", "toxic"])

    rows = rows.dropDuplicates(["text"])
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return {}
    odds = F.log((F.col("toxic") + 0.5) / (sizes[1] + 1.0)) - F.log((F.col("clean") + 0.5) / (sizes[0] + 1.0))
    spread = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    best = rows.mapInArrow(count, "term string, clean long, toxic long").groupBy("term") \
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).filter(F.col("toxic") >= SUPPORT) \
        .select("term", (odds - spread).alias("odds"), (odds / spread).alias("z")).filter("odds > 1 and z > 2.5") \
        .orderBy(F.desc("z"), "term").limit(LEXICON)
    return {r["term"]: r["odds"] for r in best.collect()}


def with_features(rows: DataFrame, lexicon: dict[str, float], keep: list[str]) -> DataFrame:
    """The kept columns and ``features`` of column ``text``, which may be one
    of those kept (it then goes to the worker once)."""
    shared = rows.sparkSession.sparkContext.broadcast(lexicon)
    sent = [c for c in keep if c != "text"]
    place = len(sent)
    rows = rows.select(*sent, F.col("text").cast("string").alias("text"))
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    order = [rows.columns.index(c) for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        reader = Reader(shared.value)
        for batch in batches:
            for b in byte_slices(batch, place, SLICE):
                x = reader.features(texts(b.column(place)), *text_bytes(b.column(place)))
                values = pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), x.ravel())
                yield pa.RecordBatch.from_arrays([*(b.column(k) for k in order), values], [*keep, "features"])

    return rows.mapInArrow(run, schema + ", features array<double>")


class Classifier:
    def __init__(self, lexicon: dict[str, float], trees, steps, prior: float):
        self.lexicon, self.trees, self.steps, self.prior = lexicon, trees, steps, prior

    def judged(self, rows: DataFrame, keep: list[str]) -> DataFrame:
        """The kept columns, score, predicted and features of column ``text``."""
        rows = with_features(rows, self.lexicon, keep)
        if self.trees is None:
            score = F.lit(self.prior)
        else:
            rows = _raw(rows, self.trees)
            score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("calibrated")))
            rows = self.steps.transform(rows) if self.steps is not None else rows.withColumn("calibrated", F.col("raw"))
        return rows.withColumn("score", score).select(*keep, "score", (F.col("score") >= 0.5).cast("int")
                                                      .alias("predicted"), "features")

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """doc_id, score, predicted and features of every text."""
        return self.judged(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                           ["doc_id"])

    def clean(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """The rows that aren't predicted toxic, with all their columns."""
        others = [c for c in docs.columns if c != text_col]
        # Numbered fields: names with dots or twice over make no difference.
        row = F.struct(F.lit(0).alias("_"), *(docs[_quoted(c)].alias(f"c{k}") for k, c in enumerate(others)))
        rows = docs.select(row.alias("row"), docs[_quoted(text_col)].alias("text"))
        kept = self.judged(rows, ["row", "text"]).filter("predicted = 0")
        place = {c: F.col(f"row.c{k}") for k, c in enumerate(others)} | {text_col: F.col("text")}
        return kept.select(*(place[c].alias(c) for c in docs.columns))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _raw(rows: DataFrame, trees) -> DataFrame:
    from pyspark.ml.functions import array_to_vector, vector_to_array
    return trees.transform(rows.withColumn("vector", array_to_vector("features"))) \
        .withColumn("raw", vector_to_array("probability")[1]).drop("vector", "rawPrediction", "probability", "prediction")


def fit(docs: DataFrame, labels: DataFrame, learn_rows: int = LEARN_ROWS, seed: int = 7) -> Classifier:
    """A classifier from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import IsotonicRegression

    labels = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id") \
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    total = labels.count()
    share = min(1.0, learn_rows / max(1, total))
    drawn = labels.filter(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30)) < int(share * (1 << 30))) \
        .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(5)).cast("int"))
    # About ``learn_rows`` rows of twenty bytes: a proven bound for the broadcast.
    rows = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                   .join(F.broadcast(drawn), "doc_id").select("text", "toxic", "part"), "labelled")
    sizes = {(r["part"], r["toxic"]): r["count"] for r in rows.groupBy("part", "toxic").count().collect()}
    n, toxic = sum(sizes.values()), sum(v for k, v in sizes.items() if k[1] == 1)
    prior = toxic / n if n else 0.0
    lexicon = learn_lexicon(rows.filter("part < 2").select("text", "toxic"))
    trained = [k for k in sizes if k[0] in (2, 3)]
    if len({k[1] for k in trained}) < 2:
        return Classifier(lexicon, None, None, prior)
    table = written(with_features(rows, lexicon, ["toxic", "part"]), "features")
    learn = table.filter("part in (2, 3)").select(F.col("toxic").cast("double").alias("label"),
                                                  array_to_vector("features").alias("vector"))
    trees = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=20, maxDepth=4, stepSize=0.2,
                          minInstancesPerNode=5, seed=seed).fit(learn)
    steps = None
    if sizes.get((4, 1), 0) >= CALIBRATED and (4, 0) in sizes:
        held = _raw(table.filter("part = 4"), trees).select(F.col("toxic").cast("double").alias("label"), "raw")
        steps = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated").fit(held)
    return Classifier(lexicon, trees, steps, prior)


def classifier(spark, docs: DataFrame, sf_dir: str) -> Classifier:
    """A classifier that learns from the labels of documents that are not held out."""
    return fit(docs, read_table(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id"))))


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    docs = read_table(spark, sf_dir, "documents")
    return classifier(spark, docs, sf_dir).score(docs) \
        .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
