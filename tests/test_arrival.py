"""Places of rows in file sources: files of any size that Spark splits, many
files, and running totals."""

import os
import random

import pytest
from pyspark.sql import functions as F

from quire.operators.ranking import running_totals
from quire.sources.store import arrival, export_bibtex, read_bibtex


@pytest.fixture()
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "100"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_order_over_split_files(spark, tmp_dir, small_splits):
    """Files of one to 3,000 entries, larger ones split: places are those of a
    reader that takes file after file."""
    rng = random.Random(8)
    want, counter = [], 0
    for k, n in enumerate([3000, 1, 700, 0, 1500, 900]):
        entries = [f"@article{{k{counter + i},\n  title = {{{'x' * rng.randint(1, 60)}}}\n}}" for i in range(n)]
        counter += n
        want += entries
        with open(os.path.join(tmp_dir, f"part-{k:05d}.txt"), "w") as f:
            f.write("".join(e + "\n\n" for e in entries))
    read = read_bibtex(spark, tmp_dir)
    assert spark.read.text(tmp_dir, lineSep="\n\n").rdd.getNumPartitions() > 10
    got = read.orderBy("pos").collect()
    assert [r["pos"] for r in got] == list(range(len(want)))
    assert [r["entry"] for r in got] == want


def test_export_in_several_files(spark, tmp_dir, small_splits):
    rows = spark.range(5000).select(F.lit(0).alias("run_seq"), F.col("id").alias("pos"), F.concat(F.lit("@x{"), "id", F.lit("}")).alias("bibtex"))
    path = os.path.join(tmp_dir, "out")
    export_bibtex(rows.repartition(7), path, entries_per_file=300)
    assert sum(f.startswith("part-") for f in os.listdir(path)) >= 5000 // 300
    got = read_bibtex(spark, path).orderBy("pos").collect()
    assert [(r[0], r[1]) for r in got] == [(k, f"@x{{{k}}}") for k in range(5000)]


def test_many_files(spark, tmp_dir):
    for k in range(1200):
        with open(os.path.join(tmp_dir, f"f{k:06d}.txt"), "w") as f:
            f.write(f"{k}a\n{k}b\n")
    got = arrival(spark.read.text(tmp_dir)).orderBy("_pos").collect()
    assert [(r["_pos"], r["value"]) for r in got] == [(2 * k + j, f"{k}{x}") for k in range(1200) for j, x in enumerate("ab")]


def test_no_rows(spark, tmp_dir):
    open(os.path.join(tmp_dir, "a.txt"), "w").close()
    assert arrival(spark.read.text(tmp_dir)).collect() == []


def test_running_totals(spark):
    rng = random.Random(3)
    rows = [(k, rng.randint(0, 9)) for k in range(500)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    got = running_totals(spark.createDataFrame(shuffled, "k int, n int").repartition(5), [F.col("k")], "n", "t").orderBy("k").collect()
    total, want = 0, []
    for k, n in rows:
        want.append((k, n, total))
        total += n
    assert [tuple(r) for r in got] == want
