"""Crawl of landed pages to a fixpoint.

The link table of all landed listing pages is cut once; the crawl itself is an
iteration over that narrow table. A round joins the frontier (urls first seen
in the round before) with the steps that lead from one listing to another, and
takes off what has been visited by an anti-join on the url; it ends with an
empty frontier.

Listings are chains: a page names the next one, so plain rounds would be as
many as a listing has pages. Each round therefore also composes the chain
steps with themselves (steps of 2, 4, 8 ... pages) and adds them, which leaves
what can be reached as it is and makes the rounds grow with the logarithm of
the longest chain. Rounds are checkpointed; no url travels through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def _steps(links: DataFrame) -> DataFrame:
    steps = links.select(F.col("url").alias("src"), F.col("link").alias("dst"))
    return steps.where("src is not null and dst is not null and src <> dst").distinct()


def reachable(steps: DataFrame, seeds: DataFrame, chains: DataFrame | None = None) -> DataFrame:
    """(url): the ``seeds`` (url) and every url reached from them over ``steps``
    and ``chains`` (url, link). ``chains`` are the steps from a page to the
    next of its listing. Null urls lead nowhere; cycles are fine."""
    ensure_checkpoint_dir(steps.sparkSession)
    every = _steps(steps if chains is None else steps.select("url", "link").unionByName(chains.select("url", "link"))) \
        .checkpoint()
    # One step on for each page (a page landed twice may name two): these are
    # only shortcuts, all steps are in the table above.
    jump = None if chains is None else _steps(chains).groupBy("src").agg(F.min("dst").alias("dst")).checkpoint()
    visited = seeds.select("url").where("url is not null").distinct().checkpoint()
    frontier = visited
    while not frontier.isEmpty():
        found = frontier.join(every, F.col("url") == F.col("src")).select(F.col("dst").alias("url")).distinct()
        frontier = found.join(visited, "url", "left_anti").checkpoint()
        visited = visited.unionByName(frontier)
        if jump is not None:
            later = jump.select(F.col("src").alias("dst"), F.col("dst").alias("far"))
            jump = jump.join(later, "dst").select("src", F.col("far").alias("dst")).where("src <> dst").checkpoint()
            every = every.unionByName(jump)
            jump = None if jump.isEmpty() else jump
    return visited


def to_fetch(links: DataFrame, reached: DataFrame, pages: DataFrame) -> DataFrame:
    """(url): what the reached listings link to and nobody has landed yet."""
    found = links.join(reached, "url", "left_semi").select(F.col("link").alias("url")).where("url is not null").distinct()
    return found.join(pages.select("url"), "url", "left_anti")
