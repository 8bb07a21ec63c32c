"""CSV with quoted newlines over many splits, against Python's csv reader."""

import csv
import os
import random

import pytest

from quire.sources.csv_lines import csv_rows
from quire.sources.store import read_csv_papers


@pytest.fixture()
def tiny_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "10"}
    before = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _field(rng):
    return "".join(rng.choice(["a", "b", " c", "é", ",", '"', "\n", "\n\n", '""', "x" * 9]) for _ in range(rng.randint(1, 6)))


def _write(path, rows, end="\n", header=("h0", "h1", "h2")):
    with open(path, "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=end, quoting=csv.QUOTE_ALL)
        out.writerows([header, *rows])


def test_records_over_splits(spark, tmp_dir, tiny_splits):
    """Random fields; a record over many splits; a header of several lines over
    splits; CRLF; blank lines; an empty file and one with a header only."""
    rng = random.Random(3)
    want = []
    for k, n in enumerate([60, 0, 1, 40]):
        rows = [[_field(rng) for _ in range(3)] for _ in range(n)]
        if k == 0:
            rows[20][1] = 'long "one",\n' * 150
        _write(os.path.join(tmp_dir, f"p{k}.csv"), rows, "\r\n" if k == 3 else "\n",
               ("h0", "head\n" * 200, "h2") if k == 2 else ("h0", "h1", "h2"))
        want += rows
    open(os.path.join(tmp_dir, "p8.csv"), "w").close()
    with open(os.path.join(tmp_dir, "p9.csv"), "w") as f:
        f.write('a,b,c\n\n1,2,3\n\n4,"5\n\n6",7\n8,9')
    want += [["1", "2", "3"], ["4", "5\n\n6", "7"], ["8", "9", None]]
    got = csv_rows(spark, tmp_dir, 3).orderBy("_pos").collect()
    assert [r["_pos"] for r in got] == list(range(len(want)))
    assert [list(r)[1:] for r in got] == want
    assert spark.read.text(tmp_dir).rdd.getNumPartitions() > 20


def test_same_as_one_task_a_file(spark, tmp_dir, tiny_splits):
    rng = random.Random(5)
    rows = [[_field(rng) for _ in range(16)] for _ in range(40)]
    for r in rows:
        r[5] = rng.choice(["2019", "n.d.", ""])
    _write(os.path.join(tmp_dir, "x.csv"), rows, header=[f"h{i}" for i in range(16)])
    many, one = (read_csv_papers(spark, tmp_dir, stray_quotes=s).orderBy("pos").collect() for s in (False, True))
    assert many == one and len(many) == 40
    odd = os.path.join(tmp_dir, "odd")
    os.makedirs(odd)
    with open(os.path.join(odd, "y.csv"), "w") as f:
        f.write('t,a\n5" disk,x\nplain,y\n')
    assert [r["title"] for r in read_csv_papers(spark, odd, stray_quotes=True).orderBy("pos").collect()] == ['5" disk', "plain"]
