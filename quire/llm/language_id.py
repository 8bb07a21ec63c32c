"""Language identification by interpolated Kneser-Ney character models.

One model per language: raw counts at the highest order, continuation counts
below, one absolute discount per order, interpolated down to a uniform
distribution over the known characters. All models share, per order, one
sorted array of n-gram hashes with a column of log-probabilities per language
(and one of context weights for n-grams that no model knows), so a position
costs one binary search where its n-gram is known. A text goes to the
language of the lowest cross-entropy per character. Confidence and rejection
are calibrated on a part of the learning rows that the models don't count.

Scale: models are fitted on about ``PER_LANGUAGE`` documents of each language,
drawn by a hash of the row (the only bound; texts are whole); counts are
aggregated per task and summed by Spark. The model is then broadcast (its size
follows the sample, not the table) and all documents are scored in one pass
without a shuffle. Long texts are scored in blocks.

Defined cases: null or letterless text is ``und`` with score 0; ties go to the
first language in order of name; repeated rows are scored each; a null id is
never held out; without learning rows every text is ``und``; other columns are
ignored.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, held_out, mix64, read_table, texts

ORDER = 5
#: Documents of each language that the models are fitted on, on average.
PER_LANGUAGE = 1500
#: Every so many-th of them calibrates and is not counted.
CALIBRATION = 5
#: The share of calibration texts that the threshold may reject.
REJECTED = 0.001
_BASE = 0x9E3779B97F4A7C15
_EDGE, _BLANK = 1, 32
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter or a mark."""
    return np.array([unicodedata.category(chr(c))[0] in "LM" for c in range(sys.maxunicode + 1)])


@lru_cache(maxsize=8)
def _powers(order: int) -> list[np.uint64]:
    return [np.uint64(pow(_BASE, k, 1 << 64)) for k in range(order + 1)]


def characters(batch: list[str], order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scored positions, document of each scored position): lower-case
    letters, one blank for anything between them, and before each text
    ``order - 1`` marks for its beginning."""
    edge = chr(_EDGE) * (order - 1)
    blocks, docs = [], []
    for k, t in enumerate(batch):
        c = np.frombuffer((edge + t.lower()).encode("utf-32-le", "replace"), np.uint32).copy()
        letter = _letters()[c]
        letter[:order - 1] = True  # the marks stay as they are
        c[~letter] = _BLANK
        keep = np.ones(len(c), bool)
        keep[1:] = letter[1:] | letter[:-1]
        blocks.append(c[keep])
        docs.append(np.full(len(blocks[-1]), k, np.int32))
        docs[-1][:order - 1] = -1
    if not blocks:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int32)
    docs = np.concatenate(docs)
    at = np.flatnonzero(docs >= 0)
    return np.concatenate(blocks), at, docs[at]


def gram_hashes(codes: np.ndarray, order: int) -> list[np.ndarray]:
    """For k = 0..order the hash of the k characters that end at each
    position; ``h[k] = h[k - 1] + mixed[i - k + 1] * base^(k - 1)``."""
    mixed = mix64(codes.astype(np.uint64) + np.uint64(0x51ED27))
    out = [np.zeros(len(codes), np.uint64)]
    for k in range(1, order + 1):
        h = out[-1].copy()
        h[k - 1:] += mixed[:len(codes) - k + 1] * _powers(order)[k - 1]
        out.append(h)
    return out


def _counts(batch: list[str], order: int) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(k, hash, hash without its first, hash without its last, count) of the n-grams."""
    codes, at, _ = characters(batch, order)
    hashes = gram_hashes(codes, order)
    out = []
    for k in range(1, order + 1):
        h, first, n = np.unique(hashes[k][at], return_index=True, return_counts=True)
        where = at[first]
        context = hashes[k - 1][where - 1] if k > 1 else np.zeros(len(h), np.uint64)
        out.append((k, h, hashes[k - 1][where], context, n))
    return out


@dataclass
class Models:
    languages: list[str]
    order: int
    grams: list[np.ndarray]  # by order: sorted hashes of known n-grams
    logp: list[np.ndarray]  # and their log-probability in each language
    contexts: list[np.ndarray]  # by order: sorted hashes of known contexts
    weight: list[np.ndarray]  # and the log-weight of the order below in each language
    floor: np.ndarray  # log-probability of a character that no model knows
    scale: float = 1.0
    norm: np.ndarray | None = None  # mean and deviation of the own texts' cross-entropy, by language
    limit: float = np.inf

    def entropies(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy of each text under each language, scored characters)."""
        codes, at, doc = characters(batch, self.order)
        total = np.zeros((len(batch), len(self.languages)))
        n = np.bincount(doc, minlength=len(batch))
        for start in range(0, len(at), 1 << 19):
            self._add(codes, at[start:start + (1 << 19)], doc[start:start + (1 << 19)], total)
        return -total / np.maximum(n, 1)[:, None], n

    def _add(self, codes: np.ndarray, at: np.ndarray, doc: np.ndarray, total: np.ndarray) -> None:
        low, high = int(at[0]) - self.order, int(at[-1]) + 1
        low = max(0, low)
        hashes = gram_hashes(codes[low:high], self.order)
        at = at - low
        value = np.zeros((len(at), len(self.languages)), np.float32)
        left = np.arange(len(at))
        for k in range(self.order, 0, -1):
            row, known = _find(self.grams[k], hashes[k][at[left]])
            value[left[known]] += self.logp[k][row[known]]
            left = left[~known]
            if not len(left):
                break
            before = hashes[k - 1][at[left] - 1] if k > 1 else np.zeros(len(left), np.uint64)
            row, known = _find(self.contexts[k], before)
            value[left[known]] += self.weight[k][row[known]]
        value[left] += self.floor
        starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        total[doc[starts]] += np.add.reduceat(value, starts, axis=0, dtype=np.float64)

    def judge(self, batch: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(language, confidence, cross-entropy, accepted) of each text."""
        if not self.languages:
            return [UNKNOWN] * len(batch), np.zeros(len(batch)), np.full(len(batch), np.nan), np.zeros(len(batch), bool)
        h, n = self.entropies(batch)
        best = h.argmin(axis=1)
        own = h[np.arange(len(batch)), best]
        margin = self.scale * np.sqrt(n)[:, None] * (own[:, None] - h)
        score = 1 / np.exp(np.maximum(margin, -700)).sum(axis=1)
        letter = np.array([any(c.isalpha() for c in t) for t in batch], bool)
        far = (own - self.norm[best, 0]) * np.sqrt(n) / self.norm[best, 1] if self.norm is not None else np.zeros(len(n))
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, letter, strict=True)]
        return names, np.where(letter, score, 0.0), np.where(letter, own, np.nan), letter & (far <= self.limit)


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    row = np.searchsorted(table, keys)
    row[row == len(table)] = 0
    return row, table[row] == keys if len(table) else np.zeros(len(keys), bool)


def estimate(languages: list[str], order: int, counts: dict[tuple[int, int], tuple[np.ndarray, ...]]) -> Models:
    """``counts[(language, k)]``: sorted hash, suffix, context and count of its k-grams."""
    size = len(languages)
    seen = np.unique(np.concatenate([counts[(i, 1)][0] for i in range(size)]))
    grams, logp = [np.zeros(0, np.uint64)], [np.zeros((0, size), np.float32)]
    contexts, weight = [np.zeros(0, np.uint64)], [np.zeros((0, size), np.float32)]
    uniform = -np.log(len(seen) + 1.0)
    floor = np.full(size, uniform)
    for k in range(1, order + 1):
        tables = []
        for i in range(size):
            h, suffix, context, n = counts[(i, k)]
            n = n.astype(np.float64)
            if k < order:  # in how many ways a character precedes it
                above, ways = np.unique(counts[(i, k + 1)][1], return_counts=True)
                row, known = _find(above, h)
                n = np.where(known, ways[row], 1.0)
            ones, twos = (n == 1).sum(), (n == 2).sum()
            discount = ones / (ones + 2 * twos) if ones else 0.5
            before, group = np.unique(context, return_inverse=True)
            mass = np.bincount(group, n)
            left = discount * np.bincount(group) / mass
            tables.append((h, suffix, context, np.maximum(n - discount, 0) / mass[group], before, np.log(left)))
        known = np.unique(np.concatenate([t[0] for t in tables]))
        places = np.unique(np.concatenate([t[4] for t in tables]))
        gamma = np.zeros((len(places), size))
        for i, t in enumerate(tables):
            gamma[np.searchsorted(places, t[4]), i] = t[5]
        suffix, context = np.zeros(len(known), np.uint64), np.zeros(len(known), np.uint64)
        direct = np.zeros((len(known), size))
        for i, t in enumerate(tables):
            row = np.searchsorted(known, t[0])
            suffix[row], context[row] = t[1], t[2]
            direct[row, i] = t[3]
        below = np.full((len(known), size), uniform) if k == 1 else logp[k - 1][np.searchsorted(grams[k - 1], suffix)]
        lower = np.exp(gamma[np.searchsorted(places, context)] + below)
        grams.append(known)
        logp.append(np.log(direct + lower).astype(np.float32))
        contexts.append(places)
        weight.append(gamma.astype(np.float32))
    return Models(languages, order, grams, logp, contexts, weight, floor)


def _calibrated(models: Models, language: np.ndarray, h: np.ndarray, n: np.ndarray) -> Models:
    """Fit the confidence's scale and the rejection limit on texts with known
    languages (index of each, cross-entropies and lengths)."""
    root = np.sqrt(np.maximum(n, 1))
    loss = {}
    for scale in np.geomspace(0.05, 20, 40):
        z = -scale * root[:, None] * h
        z -= z.max(axis=1, keepdims=True)
        loss[scale] = float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), language]))
    models.scale = min(loss, key=loss.get)
    own = h[np.arange(len(h)), language]
    norm = np.zeros((len(models.languages), 2))
    norm[:, 1] = 1.0
    for i in range(len(models.languages)):
        if (mine := language == i).any():
            norm[i, 0] = np.average(own[mine], weights=n[mine])
            norm[i, 1] = max(1e-3, float(np.std((own[mine] - norm[i, 0]) * root[mine])))
    models.norm = norm
    far = (own - norm[language, 0]) * root / norm[language, 1]
    models.limit = float(np.quantile(far, 1 - REJECTED)) if len(far) else np.inf
    return models


def fit(labelled: DataFrame, order: int = ORDER, per_language: int = PER_LANGUAGE) -> Models:
    """Models from (text, lang) rows; null texts or languages are left out."""
    rows = labelled.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")) \
        .filter("text is not null and lang is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Models([], order, [], [], [], [], np.zeros(0))
    draw = (F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / float(1 << 30)).alias("draw")
    share = F.create_map(*(F.lit(x) for k in languages for x in (k, min(1.0, per_language / sizes[k]))))
    index = F.create_map(*(F.lit(x) for i, k in enumerate(languages) for x in (k, i)))
    sample = rows.withColumn("draw", draw).withColumn("share", share[F.col("lang")]).filter("draw < share") \
        .select("text", index[F.col("lang")].cast("int").alias("lang"),
                (F.pmod(F.xxhash64("text", F.lit(1)), F.lit(CALIBRATION)) == 0).alias("calibrates"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, 0):
                lang = b.column(1).to_numpy(zero_copy_only=False)
                every = texts(b.column(0))
                for i in np.unique(lang):
                    for k, h, suffix, context, n in _counts([t for t, x in zip(every, lang, strict=True) if x == i], order):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(h), i, np.int32)), pa.array(np.full(len(h), k, np.int32)),
                             *(pa.array(x.view(np.int64)) for x in (h, suffix, context)), pa.array(n.astype(np.int64))],
                            ["lang", "k", "h", "suffix", "context", "n"])

    schema = "lang int, k int, h long, suffix long, context long, n long"
    table = sample.filter("not calibrates").mapInArrow(count, schema).groupBy("lang", "k", "h") \
        .agg(F.first("suffix").alias("suffix"), F.first("context").alias("context"), F.sum("n").alias("n")).toArrow()
    lang, k, *rest = (table.column(c).to_numpy() for c in ("lang", "k", "h", "suffix", "context", "n"))
    counts = {}
    for i in range(len(languages)):
        for j in range(1, order + 1):
            mine = (lang == i) & (k == j)
            h, suffix, context, n = (x[mine] for x in rest)
            by = np.argsort(h.view(np.uint64))
            counts[(i, j)] = (h.view(np.uint64)[by], suffix.view(np.uint64)[by], context.view(np.uint64)[by], n[by])
    if not all(len(counts[(i, 1)][0]) for i in range(len(languages))):  # a language with calibrating rows only
        return fit(labelled.filter(F.col("lang").isin([languages[i] for i in range(len(languages))
                                                       if len(counts[(i, 1)][0])])), order, per_language)
    models = estimate(languages, order, counts)
    shared = sample.sparkSession.sparkContext.broadcast(models)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, 0):
                h, n = shared.value.entropies(texts(b.column(0)))
                yield pa.RecordBatch.from_arrays([b.column(1), pa.array(list(h), pa.list_(pa.float64())), pa.array(n)],
                                                 ["lang", "h", "n"])

    held = sample.filter("calibrates").mapInArrow(measure, "lang int, h array<double>, n long").collect()
    if not held:
        return models
    return _calibrated(models, np.array([r[0] for r in held]), np.array([r[1] for r in held]),
                       np.array([r[2] for r in held]))


def identify(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy, accepted of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in byte_slices(batch, 1, 1 << 20):
                names, score, own, accepted = shared.value.judge(texts(b.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(names, pa.string()), pa.array(score), pa.array(own, from_pandas=True),
                     pa.array(accepted)], ["doc_id", "lang_pred", "score", "cross_entropy", "accepted"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, lang_pred string, score double, cross_entropy double, accepted boolean")


def op4_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those not held out."""
    docs = read_table(spark, sf_dir, "documents")
    models = fit(docs.filter(~held_out(F.col("doc_id"))))
    return identify(docs, models).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score",
                                         "cross_entropy", "accepted")
