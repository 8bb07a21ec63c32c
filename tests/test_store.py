"""W1 / S8 upsert semantics, S9 write-back, versioned store, S5 CSV, T1 stream."""

import csv
import os

from pyspark.sql import functions as F

from quire import schemas
from quire.operators import upsert as U
from quire.sources.store import PaperStore, export_bibtex, load_papers, read_csv_papers
from quire.streaming.ingest import ingest_landed_records


def rec(title, run, pos, abstract="a", venue="v", sims=None):
    return (title, ["A"], venue, 2020, "@b", "u", abstract, "q", True, sims or [], run, pos)


def papers(spark, rows):
    return spark.createDataFrame(rows, schemas.PAPERS)


def titles(df):
    return {r["title"]: (r["run_seq"], r["pos"]) for r in df.collect()}


def test_last_write_wins(spark):
    rows = [rec("t", 1, 5), rec("t", 2, 1), rec("t", 2, 3), rec("T", 1, 9), rec("t ", 1, 9)]
    got = titles(U.latest_by_title(papers(spark, rows)))
    assert got == {"t": (2, 3), "T": (1, 9), "t ": (1, 9)}


def test_w1_independent_of_order_and_partitions(spark):
    rows = [rec(f"t{i % 7}", i % 3, i) for i in range(200)]
    a = titles(U.latest_by_title(papers(spark, rows).repartition(1)))
    b = titles(U.latest_by_title(papers(spark, list(reversed(rows))).repartition(13)))
    assert a == b and len(a) == 7


def test_w1_plan_limits_before_shuffle(spark):
    df = U.latest_by_title(papers(spark, [rec("t", 1, 1)]))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_upsert_resets_scores_and_later_invalid_never_replaces(spark, tmp_dir):
    from quire.operators import records as R
    store = PaperStore(spark, os.path.join(tmp_dir, "papers"))
    assert store.read().count() == 0 and store.current_version() is None
    first = papers(spark, [rec("t", 1, 1), rec("u", 1, 2)]).withColumn("url", F.lit("p")).withColumn("year_text", F.lit("2020"))
    v0, _ = store.upsert(first)
    scores = spark.createDataFrame([("t", "lst", 0.5)], "title string, list_name string, score double")
    v1 = store.write_back(scores)
    assert {r["title"]: len(r["similarities"]) for r in store.read().collect()} == {"t": 1, "u": 0}
    later = papers(spark, [rec("t", 2, 1), rec("u", 2, 1, abstract="")]).withColumn("url", F.lit("p")) \
        .withColumn("year_text", F.lit("2020"))
    v2, rejects = store.upsert(later)
    got = {r["title"]: (r["run_seq"], len(r["similarities"])) for r in store.read().collect()}
    assert got == {"t": (2, 0), "u": (1, 0)}
    assert [r["reason"] for r in rejects.collect()] == ["invalid"]
    assert (v0, v1, v2) == (0, 1, 2)
    # replaying a committed batch is a no-op; the same batch number of another stream isn't
    assert store.upsert(later, batch=("s", 2))[0] == 3
    assert store.upsert(later, batch=("s", 2))[0] == 3 and store.versions() == [0, 1, 2, 3]
    assert store.upsert(later, batch=("other", 2))[0] == 4
    assert R is not None


def test_write_back_merge_keeps_one_entry_per_list(spark):
    p = papers(spark, [rec("t", 1, 1, sims=[("a", 0.1), ("b", 0.2)]), rec("u", 1, 2, sims=[("a", 0.3)])])
    s = spark.createDataFrame([("t", "a", 0.9)], "title string, list_name string, score double")
    rep = {r["title"]: [(e["list_name"], e["score"]) for e in r["similarities"]] for r in U.write_back_scores(p, s).collect()}
    assert rep == {"t": [("a", 0.9)], "u": [("a", 0.3)]}
    mer = {r["title"]: sorted((e["list_name"], e["score"]) for e in r["similarities"])
           for r in U.write_back_scores(p, s, mode="merge").collect()}
    assert mer == {"t": [("a", 0.9), ("b", 0.2)], "u": [("a", 0.3)]}


def test_csv_source(spark, tmp_dir):
    path = os.path.join(tmp_dir, "export-ieee.csv")
    header = [f"h{i}" for i in range(16)]
    rows = [
        ["Title, with comma", "A; B", "", "", "", "2021", "", "", "", "", 'He said "hi"\nnext line', "", "", "", "", "http://x/1.pdf"],
        ["No pdf", "C", "", "", "", "2020x", "", "", "", "", "abs", "", "", "", "", ""],
    ]
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        w.writerows(rows)
    got = {r["title"]: r for r in read_csv_papers(spark, path).collect()}
    a, b = got["Title, with comma"], got["No pdf"]
    assert a["abstract"] == 'He said "hi"\nnext line' and a["year"] == 2021 and a["accepted"] is True
    assert a["authors"] == ["A; B"] and a["venue"] == "ICASSP" and a["bibtex"] is None
    assert b["year"] is None and b["accepted"] is False and b["url_pdf"] == ""
    assert load_papers(spark, path).count() == 2


def test_bibtex_export_file(spark, tmp_dir):
    p = papers(spark, [rec("t", 1, 2), rec("u", 1, 1)]).withColumn(
        "bibtex", F.when(F.col("title") == "u", F.lit(None)).otherwise(F.lit("@x{t}")))
    out = os.path.join(tmp_dir, "bib")
    export_bibtex(p, out)
    text = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out)) if f.startswith("part-"))
    assert text == "\n\n@x{t}\n\n"
    empty = os.path.join(tmp_dir, "bib0")
    export_bibtex(p.limit(0), empty)
    assert "".join(open(os.path.join(empty, f)).read() for f in os.listdir(empty) if f.startswith("part-")) == ""


def test_stream_equals_batch(spark, tmp_dir):
    rows = [rec(f"t{i % 5}", i % 4, i) for i in range(40)]
    recs = papers(spark, rows).withColumn("url", F.lit("p")).withColumn("year_text", F.lit("2020"))
    store = ingest_landed_records(spark, recs, n_files=4, store_path=os.path.join(tmp_dir, "s"))
    assert titles(store.read()) == titles(U.latest_by_title(papers(spark, rows)))
    assert len(store.versions()) >= 1


def test_chained_upserts_over_parquet_batches(spark, tmp_dir):
    # Regression: three lazily chained upserts over Parquet batches used to
    # return one row per batch for a title while exchange reuse was on.
    state = None
    for i in range(4):
        path = os.path.join(tmp_dir, f"batch{i}")
        papers(spark, [rec("a", i, i), rec(f"only{i}", i, 0)]).write.parquet(path)
        state = U.upsert(state, spark.read.parquet(path))
    got = titles(state)
    assert got == {"a": (3, 3), "only0": (0, 0), "only1": (1, 0), "only2": (2, 0), "only3": (3, 0)}
    assert state.count() == len(state.collect()) == 5


def test_collect_runs_last_run_wins_with_its_query_term(spark):
    from quire.plans.collect import collect_runs
    recs = papers(spark, [rec("noisy labels study", 0, 1), rec("weak labels", 0, 2),
                          rec("noisy labels study", 0, 3, abstract="")]) \
        .withColumn("url", F.lit("p")).withColumn("year_text", F.lit("2020"))
    runs = spark.createDataFrame([(0, "noisy", "v"), (1, "labels", "v"), (2, "weak", "other")],
                                 "run_seq long, query string, venue string")
    got = {r["title"]: (r["query_term"], r["run_seq"], r["pos"]) for r in collect_runs(recs, runs).collect()}
    # run 1 ('labels') is the last run of venue v touching both titles; the
    # invalid copy (empty abstract) never wins; venue 'other' matches nothing.
    assert got == {"noisy labels study": ("labels", 1, 1), "weak labels": ("labels", 1, 2)}


def test_csv_order_over_files(spark, tmp_dir):
    """The last of equal titles is that of the last file by name."""
    header = [f"h{i}" for i in range(16)]
    for k in range(3):
        with open(os.path.join(tmp_dir, f"part-{k}.csv"), "w", newline="") as f:
            w = csv.writer(f)
            w.writerow(header)
            for n in range(50 * (3 - k)):  # the first file is the largest
                w.writerow([f"t{n}", "A"] + [""] * 3 + ["2020"] + [""] * 4 + [f"file {k}"] + [""] * 4 + ["http://x"])
    rows = read_csv_papers(spark, tmp_dir).orderBy("pos").collect()
    assert [r["pos"] for r in rows] == list(range(300))
    assert [r["abstract"] for r in rows] == ["file 0"] * 150 + ["file 1"] * 100 + ["file 2"] * 50


def test_unknown_source_raises(spark, tmp_dir):
    import pytest
    with pytest.raises(ValueError):
        load_papers(spark, os.path.join(tmp_dir, "papers.xlsx"))


def _files(path):
    return {os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")}


def test_a_batch_rewrites_only_its_buckets(spark, tmp_dir):
    path = os.path.join(tmp_dir, "papers")
    store = PaperStore(spark, path, buckets=8)
    extra = {"url": F.col("title"), "year_text": F.lit("2020")}
    store.upsert(papers(spark, [rec(f"t{k}", 1, k) for k in range(200)]).withColumns(extra))
    before = store.bucket_paths()
    assert sorted(before) == list(range(8))
    store = PaperStore(spark, path, buckets=99)  # an existing table keeps its buckets
    assert store.buckets == 8
    batch = papers(spark, [rec("t3", 2, 1), rec("t3", 2, 2), rec("bad", 2, 3, abstract="")]).withColumns(extra)
    touched = store.touched(batch.where("title = 't3'"))
    store.upsert(batch, batch=("s", 0))
    after = store.bucket_paths()
    assert {b for b in after if after[b] != before[b]} == touched and len(touched) == 1
    written = [f for f in _files(path) if "/v=1@" in f]
    assert written and all(f"/bucket={next(iter(touched))}/" in f for f in written)
    want = {f"t{k}": (1, k) for k in range(200)} | {"t3": (2, 2)}
    assert titles(store.read()) == want and titles(store.read(0))["t3"] == (1, 3)
    store.write_back(spark.createDataFrame([("t5", "a", 0.5), ("unknown", "a", 0.1)], "title string, list_name string, score double"))
    assert titles(store.read()) == want
    assert [r["title"] for r in store.read().where("size(similarities) > 0").collect()] == ["t5"]
    assert [r["url"] for r in store.rejects().collect()] == ["bad"]
    # an unfinished version is not read, and its number is used again
    os.remove(os.path.join(path, "of=8", "v=2", "_SUCCESS"))
    assert store.current_version() == 1 and store.read().where("size(similarities) > 0").count() == 0
    assert store.upsert(batch.where("title = 'bad'"))[0] == 2 and titles(store.read()) == want


def test_landed_files_grow_in_number_with_the_records(spark, tmp_dir, monkeypatch):
    """``n_files`` of a large input are cut into parts, in as many batches."""
    from quire.streaming import ingest
    src = os.path.join(tmp_dir, "src")
    papers(spark, [rec(f"t{k % 150}", 1, k) for k in range(600)]).withColumn("url", F.lit("u")).repartition(3).write.parquet(src)
    monkeypatch.setattr(ingest, "PART_BYTES", 1 << 10)
    landed = []
    write = ingest.read_landed
    monkeypatch.setattr(ingest, "read_landed", lambda s, landing, *a: landed.append(landing) or write(s, landing, *a))
    store = ingest_landed_records(spark, spark.read.parquet(src), os.path.join(tmp_dir, "s"), files_per_batch=1, n_files=2)
    assert len([f for f in os.listdir(landed[0].removeprefix("file:")) if f.endswith(".parquet")]) > 2
    assert 2 <= len(store.versions()) <= 3
    assert {(r["title"], r["pos"]) for r in store.read().collect()} == {(f"t{k}", 450 + k) for k in range(150)}


def test_merge_is_the_upsert_of_a_table_with_one_row_a_title(spark, tmp_dir):
    stored = papers(spark, [rec(f"t{k}", 2, k) for k in range(40)]).cache()
    new = papers(spark, [rec(f"t{k % 60}", k % 4, k) for k in range(200)])
    place = [F.pmod(F.hash("title"), F.lit(3))]
    def rows(df):
        return sorted((r["title"], r["run_seq"], r["pos"]) for r in df.collect())
    assert rows(U.merge(stored, new, place)) == rows(U.upsert(stored, new))
    plan = U.merge(stored, new, place)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2, plan  # W1 of the new rows, then one for all
