"""Embeddings, pages and the pipeline against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quire.llm import embedding_dedup, warc_audit
from quire.llm.components import components

VECTORS = "vec_id long, embedding array<float>, label int, v string, id string, n string"


def linked(rows, threshold=0.9):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v, *_ in rows
            if v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = defaultdict(set)
    for k, (i, x) in enumerate(good):
        for m, (j, y) in enumerate(good):
            if k != m and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                out[k].add(m)
    return good, out


@pytest.mark.parametrize("cell_rows,block", [(1024, 2048), (16, 7)])
def test_embedding_dedup(spark, cell_rows, block):
    """Also with many cells, and cells dealt over many blocks."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(60, 16))
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    for k in range(60):  # a large group of near copies, and small ones
        v = base[0 if k < 40 else k] + rng.normal(size=16) * 0.05
        rows.append((100 + k, v.tolist()))
    rows += [(300, base[5].tolist()), (301, (2 * base[5]).tolist()), (302, None), (303, []), (304, [0.0] * 16),
             (305, [float("nan")] * 16), (306, [float("inf")] * 16), (307, [None] * 16), (308, [1.0, 0.0]),
             (309, [1.0, 0.001])]
    rows = [(*r, 1, "a", "b", "c") for r in rows]
    good, links = linked(rows)
    root = {i: i for i, *_ in rows}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for k, more in links.items():
        for m in more:
            a, b = find(good[k][0]), find(good[m][0])
            root[max(a, b)] = min(a, b)
    n = {good[k][0]: len(v) for k, v in links.items()}
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    got = embedding_dedup.near_duplicates(df, cell_rows=cell_rows, block=block).collect()
    assert sorted(map(tuple, got)) == sorted((i, n.get(i, 0), find(i), find(i) == i) for i, *_ in rows)


def test_embedding_edges(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], VECTORS)).collect() == []
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.01]), (None, None)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False),
                                                                 (None, 0, None, True)]))


def test_components(spark):
    rng = random.Random(2)
    pairs = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + \
        [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7), (3, 2)]
    root = {n: n for p in pairs for n in p}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    alone = {a for a, b in pairs if a == b and all(a not in p for p in pairs if p != (a, b))}
    assert got == {n: find(n) for n in root if n not in alone}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_wide_embeddings_across_a_border(spark):
    """Pairs whose whole difference lies across the border of two cells."""
    rng = np.random.default_rng(3)
    rows = []
    for k in range(80):
        v = rng.normal(size=256) * 0.001
        v[0], v[1] = np.sqrt(1 - 0.22 ** 2), 0.22 if k % 2 else -0.22
        rows.append((k, v.tolist(), 1, "a", "b", "c"))
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS), cell_rows=40).collect()
    _, links = linked(rows)
    assert {r["vec_id"]: r["n_links"] for r in got} == {k: len(links[k]) for k in range(80)}
    assert {r["component_id"] for r in got} == {0}


def test_warc_audit(spark):
    schema = "archive string, offset long, payload binary, node string, digest string"
    rng = random.Random(4)
    whole = [(f"a{k % 3}", 100 * (k // 3), rng.randbytes(rng.randint(0, 90)), "x", "y") for k in range(300)]
    whole += [("long", 50_000_000, b"far", "x", "y"), (None, 0, None, "x", "y"), ("a0", 0, b"tie", "x", "y")]
    other = list(whole)
    other[5] = (*other[5][:2], b"changed", "x", "y")
    del other[100]
    other += [("a1", 77, b"new", "x", "y"), ("only here", 0, b"z", "x", "y"), whole[9]]
    a, b = (spark.createDataFrame(r, schema) for r in (whole, other))
    got = {(r["archive"], r["offset"], r["status"]) for r in warc_audit.audit(a, b, span=512, fanout=4).collect()}
    assert got == {(*whole[5][:2], "corrupt"), (*whole[100][:2], "missing"), ("a1", 77, "extra"), ("only here", 0, "extra"),
                   (*whole[9][:2], "extra")}
    none = spark.createDataFrame([], schema)
    assert warc_audit.audit(a, a).count() == 0 and warc_audit.audit(none, none).count() == 0
    assert warc_audit.audit(none, b).count() == len({r[:3] for r in other})


def test_warc_audit_without_offsets(spark):
    """Records without an offset: changed, lost, new, repeated and whole ones."""
    whole = [("a", None, b"one"), *(("b", None, b"rec%d" % k) for k in range(50)), ("c", 0, b"x"), ("c", None, b"twice"),
             (None, None, b"no archive"), ("d", None, b"same"), ("d", 4, b"same")]
    other = [r for r in whole if r[2] not in (b"one", b"rec7", b"no archive")]
    other += [("a", None, b"changed"), ("c", None, b"twice"), ("e", None, b"new")]
    a, b = (spark.createDataFrame(r, "archive string, offset long, payload binary") for r in (whole, other))
    rows = warc_audit.audit(a, b, span=512, fanout=4).collect()
    assert {(r["archive"], r["offset"], r["length"], r["status"]) for r in rows} == {
        ("a", None, 3, "corrupt"), ("b", None, 4, "missing"), ("c", None, 5, "extra"), (None, None, 10, "missing"),
        ("e", None, 3, "extra")} and len(rows) == 5
    assert warc_audit.audit(a, a).count() == 0


def test_warc_audit_of_copies_and_unnamed_archives(spark):
    """Swaps between a null and an unnamed archive; copies of one record."""
    whole = [(None, 0, b"one"), ("", 0, b"two"), ("a", 5, b"x"), ("a", 5, b"x"), ("a", 5, b"y"), ("a", 9, b"z")]
    other = [(None, 0, b"two"), ("", 0, b"one"), ("a", 5, b"x"), ("a", 5, b"y"), ("a", 9, b"z"), ("a", 9, b"z")]
    a, b = (spark.createDataFrame(r, "archive string, offset long, payload binary") for r in (whole, other))
    rows = warc_audit.audit(a, b, span=512, fanout=4).collect()
    assert {(r["archive"], r["offset"], r["status"]) for r in rows} == {
        (None, 0, "corrupt"), ("", 0, "corrupt"), ("a", 5, "missing"), ("a", 9, "extra")} and len(rows) == 4
    assert all((r["expected"] is None) == (r["status"] == "extra") and (r["found"] is None) == (r["status"] == "missing")
               and r["expected"] != r["found"] for r in rows)


def test_equal_trees_are_not_descended(spark):
    """Only nodes under mismatches are compared: equal roots end the audit."""
    rows = [("a", 100 * k, bytes([k % 250])) for k in range(200)]
    recs = warc_audit.counted(warc_audit.records(spark.createDataFrame(rows, "archive string, offset long, payload binary")))
    levels = warc_audit._levels([19900], 256, 4)
    assert levels == 4
    roots = warc_audit.trees(recs, levels, 256, 4)[-1].collect()
    assert len(roots) == 1 and roots[0]["node"] == 0


def test_pipeline(spark, tmp_dir):
    """Every stage's decision against a brute-force version of its rule."""
    rng = random.Random(11)

    def prose(n):
        return " ".join("".join(rng.choices("abcdefghijklm", k=rng.randint(2, 6))) for _ in range(n))

    passage = prose(40)
    rows, toxic = [], set()
    for k in range(400):
        t = prose(rng.randint(5, 50))
        if k % 5 == 0:
            toxic.add(k)
            t += " grobian schuft " + prose(2)
        rows.append((k, t))
    long = prose(200)
    rows += [(400, long), (401, long.replace(" ", "  ", 1)), (402, "edited " + long), (403, prose(20) + " " + passage),
             (404, passage + " " + prose(20)), (405, None), (406, ""), (407, passage)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k in toxic)) for k in range(400)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{tmp_dir}/labels.parquet")
    current = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        current = stage(spark, current, tmp_dir)
        current.write.parquet(f"{tmp_dir}/{name.replace(' ', '-')}")
        current = spark.read.parquet(f"{tmp_dir}/{name.replace(' ', '-')}")
        seen[name] = {r["doc_id"]: r for r in current.collect()}
        if name != "best-fit packing":
            assert current.columns == docs.columns
    texts = dict(rows)
    assert set(seen["toxicity"]) == set(texts) - toxic
    # 401 has one character more than 400; 406 equals 405.
    assert set(seen["exact dedup"]) == set(texts) - toxic - {400, 406}
    assert set(seen["n-gram Jaccard join"]) == set(texts) - toxic - {400, 406, 402}
    cut = seen["suffix-array dedup"]
    assert 407 not in cut and cut[404]["text"] in (texts[404].replace(passage, ""), texts[404].replace(passage, "")[1:])
    assert cut[403]["text"] == texts[403] and cut[404]["n_chars"] == len(cut[404]["text"])
    assert set(seen["best-fit packing"]) == set(cut)
    run = corpus_pipeline.run(spark, tmp_dir)
    assert {r["doc_id"] for r in run.collect()} == set(cut)
    assert run.agg(F.max("length")).first()[0] <= 2048


def test_embeddings_of_any_length(spark):
    """Vectors whose squares leave the range of a double link like others and
    disturb none."""
    rows = [(1, [1.0, 1.0]), (2, [1e200, 1e200]), (3, [1e-200, 1e-200]), (4, [1.0, 1.001]), (5, [-1.0, 1.0]), (6, [-1e-300, 1.1e-300]),
            (7, [5e-324, 0.0]), (8, [1.7e308, 0.0])]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == \
        [(1, 3, 1), (2, 3, 1), (3, 3, 1), (4, 3, 1), (5, 1, 5), (6, 1, 5), (7, 1, 7), (8, 1, 7)]
