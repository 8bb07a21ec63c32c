"""T1 over pages: details and lookups meet in keyed state, whichever lands first."""

import json
import os
import random

import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from quire.plans import collect as C
from quire.plans import standins as D
from quire.sources.pages import land_pages
from quire.sources.store import PaperStore
from quire.streaming.ingest import _meet, ingest_landed_pages


class State:
    def __init__(self):
        self.value = None

    @property
    def exists(self):
        return self.value is not None

    @property
    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def event(url="u", run=1, pos=1, detail=None, bibtex=None, accepted=None, venue="conference"):
    return ("k", venue, url, run, pos, detail, bibtex, accepted)


def feed(state, *events, key="k"):
    pdf = pd.DataFrame(list(events), columns=["key", "venue", "url", "run_seq", "pos", "detail", "bibtex", "accepted"], dtype=object)
    return [tuple(r) for out in _meet((key,), iter([pdf.iloc[:1], pdf.iloc[1:]]), state) for r in out.itertuples(index=False)]


def test_whichever_lands_first():
    a = State()
    assert feed(a, event(detail="D")) == [("conference", "D", None, None)]
    assert feed(a, event(bibtex="@b")) == [("conference", "D", "@b", None)]
    assert feed(a, event(bibtex="@c")) == [("conference", "D", "@c", None)]  # landed again
    b = State()
    assert feed(b, event(bibtex="@b")) == []
    assert feed(b, event(detail="D")) == [("conference", "D", "@b", None)]
    assert feed(State(), event(bibtex="@b"), event(detail="D")) == [("conference", "D", "@b", None)]


def test_details_that_share_a_key_and_later_copies():
    s = State()
    assert feed(s, event("u", 1, 1, "old"), event("u", 2, 1, "new"), event("v", 1, 5, "other")) == \
        [("conference", "new", None, None), ("conference", "other", None, None)]
    assert feed(s, event("u", 1, 9, "late but older")) == [("conference", "new", None, None), ("conference", "other", None, None)]
    assert feed(s, event(accepted=False)) == [("conference", "new", None, False), ("conference", "other", None, False)]
    assert [r[3] for r in feed(s, event(accepted=True))] == [True, True]
    assert [r[3] for r in feed(s, event(accepted=False))] == [True, True]  # any reply that accepts counts
    alone = State()
    assert feed(alone, event(detail="D"), key="none:u") == [("conference", "D", None, None)] and alone.value is None
    assert feed(State(), event("u", None, float("nan"), "D")) == [("conference", "D", None, None)]
    assert json.loads(s.value[0])["u"][2] == "new"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, f"Title {k % 37} word\nabstract {k}", ["en", "fr", "de", "es"][k % 4], f"src{k % 3}", 50 + k % 30) for k in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.range(80).where("id % 3 <> 0").select(F.col("id").alias("doc_id"), (F.floor(F.col("id") / 4) % 2).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    return D.render_pages(D.documents_as_papers(docs), labels).checkpoint()


def rows_of(df):
    return sorted(map(str, df.select("title", "venue", "accepted", "bibtex", "run_seq", "pos").collect()))


def test_late_lookups_without_the_landed_details(spark, pages, tmp_dir):
    """The second run sees only the lookups: the details come from state. A
    third, over both, has nothing left to do for them."""
    valid, rejects = C.collect(pages)
    from quire.operators.upsert import upsert
    store = PaperStore(spark, os.path.join(tmp_dir, "papers"), buckets=4)
    first, second, ckpt = (os.path.join(tmp_dir, x) for x in ("details", "lookups", "ckpt"))
    land_pages(pages.where("kind = 'detail'"), first, ["venue", "kind"])
    land_pages(pages.where("kind <> 'detail'"), second, ["venue", "kind"])
    ingest_landed_pages(spark, first, store, checkpoint=ckpt)
    assert {r[0] for r in store.read().select("venue").distinct().collect()} == {"proceedings", "forum"}
    assert store.read().where("venue = 'forum' and accepted").count() == 0
    waiting = store.rejects().count()
    assert waiting == pages.where("kind = 'detail' and venue in ('conference', 'preprints')").count()
    ingest_landed_pages(spark, second, store, checkpoint=ckpt)
    assert rows_of(store.read()) == rows_of(upsert(None, valid))
    assert store.rejects().count() == rejects.count() < waiting
    assert store.read().where("venue = 'forum' and accepted").count() > 0


def test_any_order_of_small_batches_gives_the_batch_result(spark, pages, tmp_dir):
    from quire.operators.upsert import upsert
    landing = os.path.join(tmp_dir, "landing")
    kinds = [("detail", 0), ("bibtex", 1), ("detail", 1), ("notes", 0), ("bibtex", 0), ("notes", 1)]
    random.Random(1).shuffle(kinds)
    store = PaperStore(spark, os.path.join(tmp_dir, "papers"), buckets=2)
    for kind, half in kinds:
        land_pages(pages.where((F.col("kind") == kind) & (F.col("doc_id") % 2 == half)), landing, ["venue", "kind"])
    ingest_landed_pages(spark, landing, store, files_per_batch=4)
    assert len(store.versions()) > 1
    assert rows_of(store.read()) == rows_of(upsert(None, C.collect(pages)[0]))


def test_joined_details_follow_the_rule_of_a_key(spark, tmp_dir):
    """The aggregate puts out what ``_meet`` does, batch for batch: copies of a
    page, pages that share a key, lookups that land again."""
    from quire.streaming.ingest import joined_details, meet
    schema = "key string, venue string, url string, run_seq long, pos long, detail string, bibtex string, accepted boolean"
    k = ("k", "conference")
    batches = [[(*k, "u", 1, 1, "old", None, None), (*k, "u", 2, 1, "new", None, None), (*k, "v", 1, 5, "other", None, None),
                ("x", "forum", "w", None, None, "D", None, None), ("x", "forum", "n", 1, 1, None, None, False)],
               [(*k, "u", 1, 9, "late but older", None, None), (*k, "b", 1, 1, None, "@b", None), (*k, "b", 1, 1, None, "@a", None),
                ("x", "forum", "n", 1, 1, None, None, True)],
               [(*k, "b", 1, 1, None, "@A", None), ("x", "forum", "n", 1, 1, None, None, False), ("y", "forum", "n", 1, 1, None, None, True)]]
    found, landing = {}, os.path.join(tmp_dir, "events")
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)

    def keep(batch, batch_id):
        found[batch_id] = sorted(map(str, batch.collect()))

    events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(landing)
    q = joined_details(meet(events)).writeStream.foreachBatch(keep).outputMode("update").trigger(availableNow=True) \
        .option("checkpointLocation", os.path.join(tmp_dir, "ckpt")).start()
    q.awaitTermination()
    states = {key: State() for key in "kxy"}
    for i, rows in enumerate(batches):
        want = []
        for key in sorted({r[0] for r in rows}):
            pdf = pd.DataFrame([r for r in rows if r[0] == key], columns=[c.split()[0] for c in schema.split(", ")], dtype=object)
            want += [r for out in _meet((key,), iter([pdf]), states[key]) for r in out.itertuples(index=False)]
        assert found[i] == sorted(str(Row(venue=v, detail=d, found_bibtex=b, found_accepted=a)) for v, d, b, a in want), i


def test_a_backlog_is_few_batches(spark, tmp_dir, monkeypatch):
    from quire.streaming import ingest
    landing = os.path.join(tmp_dir, "landing")
    spark.range(64000).repartition(16).write.parquet(landing)
    monkeypatch.setattr(ingest, "BATCH_BYTES", 1 << 10)  # 16 files of some 20 KB: a batch each by this size
    done = []
    q = ingest.read_landed(spark, landing, "id long").writeStream.foreachBatch(lambda b, i: done.append(b.count())) \
        .option("checkpointLocation", os.path.join(tmp_dir, "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sum(done) == 64000 and len(done) <= ingest.BATCHES + 1
