"""S1 raw page files, S11 landing with partition pruning, S6 routing, S7 empty store."""

import os

from pyspark.sql import functions as F

from quire.sources.pages import land_pages, read_pages, read_raw_pages
from quire.sources.store import PaperStore, load_papers

from pages import LAYOUT_A, LAYOUT_B


def test_raw_files_and_landing(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    for name, html in (("a.html", LAYOUT_A), ("b.html", LAYOUT_B), ("skip.txt", "x")):
        with open(os.path.join(raw, name), "w") as f:
            f.write(html)
    pages = read_raw_pages(spark, raw, "*.html")
    got = {os.path.basename(r["url"]): r["html"] for r in pages.collect()}
    assert got == {"a.html": LAYOUT_A, "b.html": LAYOUT_B}
    landed = os.path.join(tmp_dir, "landed")
    land_pages(pages.withColumn("venue", F.when(F.col("url").endswith("a.html"), "A").otherwise("B")),
               landed, ["venue"], "overwrite", max_records_per_file=1)
    one = read_pages(spark, landed).where(F.col("venue") == "A")
    assert "PartitionFilters: [isnotnull(venue" in one._jdf.queryExecution().executedPlan().toString()
    assert [r["html"] for r in one.collect()] == [LAYOUT_A]


def test_store_routing_and_empty_table(spark, tmp_dir):
    path = os.path.join(tmp_dir, "papers")
    empty = load_papers(spark, path)
    assert empty.count() == 0 and "similarities" in empty.columns
    assert PaperStore(spark, path).versions() == []
    try:
        load_papers(spark, path, fmt="sqlite")
        raise AssertionError("unknown format accepted")
    except ValueError:
        pass
