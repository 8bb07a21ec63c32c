"""Rank: papers -> (optional sample) -> paper vectors -> cosine against one
weighted sentence profile -> descending rank (V1-V6).

The profile is aggregated by Spark and inlined as a literal (one small vector,
size checked); scoring is a narrow projection; ranking is a distributed sort.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import similarity as S
from ..operators.encode import VectorStore, text_key
from ..operators.ranking import global_rank


def profile_for(profiles: DataFrame, list_name: str, vectors: DataFrame | None = None) -> list[float]:
    """V2 + A1: the named list's profile vector (hashed encoder, or stored
    vectors keyed by ``key`` when ``vectors`` is given)."""
    one = profiles.where(F.col("list_name") == F.lit(list_name))
    prof = S.profile_vectors_dense(one, vectors) if vectors is not None else S.profile_vectors_hashed(one)
    return S.profile_literal(prof, list_name)


def rank_papers(papers: DataFrame, profiles: DataFrame, list_name: str, sample: int = 0, seed: str = "0",
                with_rank: bool = True, w_title: float = 0.5, w_abstract: float = 0.5,
                digits: int | None = None) -> DataFrame:
    """Scores (and 1-based ranks) of ``papers`` against the named profile.

    Ranks order by the score, then by arrival (run_seq, pos). ``digits`` rounds
    the score in that order, for comparisons between engines that sum in
    different orders. Long texts and lists stay out of the ranked rows, which
    are sorted and checkpointed."""
    if sample:
        papers = S.seeded_sample(papers, sample, "pos", seed)
    vec = profile_for(profiles, list_name)
    scored = S.score_hashed(papers, vec, list_name, w_title=w_title, w_abstract=w_abstract)
    if not with_rank:
        return scored
    keyed = scored.drop("abstract", "bibtex", "authors", "similarities").withColumn("_k", F.col("score") if digits is None else F.round("score", digits))
    return global_rank(keyed, [F.col("_k").desc_nulls_last(), F.col("run_seq").asc(), F.col("pos").asc()],
                       "rank").drop("_k")


def rank_encoded(papers: DataFrame, profiles: DataFrame, store: VectorStore, encoder_factory: Callable[[], Callable],
                 digits: int | None = None) -> DataFrame:
    """F2 / V1 (c): ranks of all papers in all lists by a supplied encoder.
    Sentences, titles and abstracts that ``store`` lacks are encoded and kept;
    a run with nothing new encodes nothing. Result: run_seq, pos, list_name,
    score, rank."""
    store.fill([(papers, "title"), (papers, "abstract"), (profiles, "sentence")], encoder_factory)
    keyed = profiles.withColumn("key", text_key(F.col("sentence")))
    lists = S.profile_vectors_dense(keyed, store.read())
    vectors = store.paper_vectors(papers, ["run_seq", "pos"])
    return S.rank_all_lists(vectors, lists, ["run_seq", "pos"], ["run_seq", "pos"], digits)
