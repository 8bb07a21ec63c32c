"""The document operators against brute force on small tables that hold nulls,
empty and long texts, ties, repeated rows and columns of clashing names."""

import base64
import hashlib
import random
import re
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.llm import bpe_words, byte_bpe, exact_dedup, jaccard_join, language_id, lm_scoring, packing, suffix_dedup, toxicity
from quire.llm.common import small_batches, split_by_id

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "norm string, shingle string, features string, doc string, score string")


def words(rng, n, kind="abcdefgh"):
    return " ".join("".join(rng.choices(kind, k=rng.randint(1, 5))) for _ in range(n))


def edge_texts():
    rng = random.Random(5)
    base = [words(rng, rng.randint(1, 120)) for _ in range(40)]
    passage = words(rng, 60)
    near = []
    for k in range(12):  # near copies of one text
        w = base[0].split()
        w[k % len(w)] = f"edit{k}"
        near.append(" ".join(w))
    return [*base, *near, base[1], base[1], base[1] + "  ", "\t" + base[1], base[2].upper(), passage, passage + " x",
            words(rng, 5) + " " + passage + " " + words(rng, 5), None, None, "", "", "   ", "\n \t", "a", "ab c",
            "one two three", "one two three", "Ünï çødé 😀 日本語 ² ½ x's it''ll", "ab " * 400, "z" * 3000,
            "x   y   \n\n  z  ", "tail \n ", words(rng, 9000, "abcdefghijklmnopqrstuvwxyz")]


@pytest.fixture(scope="module")
def rows():
    texts = edge_texts()
    out = [(k, t, "en" if k % 2 else "fr", "src", len(t or ""), "n", "s", "f", "d", "x") for k, t in enumerate(texts)]
    return out + [out[3], out[3], (None, texts[4], None, None, None, "n", "s", "f", "d", "x"),
                  (None, None, None, None, None, "n", "s", "f", "d", "x")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect() if r["doc_id"] is not None}


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


@pytest.mark.parametrize("fields,chunk", [(exact_dedup.FIELDS, 1 << 16), (exact_dedup.FIELDS, 64), (((7, 11),), 1 << 16)])
def test_exact_dedup(docs, rows, none, fields, chunk):
    """Also with chunks that cut most texts, and with a hash that collides."""
    df = exact_dedup.exact_duplicates(docs, fields=fields, chunk_bytes=chunk)
    got = df.collect()
    groups = defaultdict(list)
    for r in rows:
        groups[normal(r[1])].append(r)
    best = {k: min(v, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0)) for k, v in groups.items()}
    want = sorted((str(r[0]), str(best[normal(r[1])][0]), len(groups[normal(r[1])]), r[0] == best[normal(r[1])][0],
                   hashlib.sha256(normal(r[1]).encode()).hexdigest()) for r in rows)
    assert sorted((str(a), str(b), *c) for a, b, *c in map(tuple, got)) == want
    if chunk == 1 << 16 and fields is exact_dedup.FIELDS:
        assert exact_dedup.exact_duplicates(none).collect() == []
        kept = exact_dedup.without_duplicates(docs)
        assert kept.columns == docs.columns
        assert {normal(r["text"]) for r in kept.collect()} == set(groups)


def test_texts_without_a_copy_stay_in_place(spark, monkeypatch):
    """Only texts whose id may be a copy's are normalised again for the comparison and for the rows that go."""
    rng = random.Random(31)
    table = [(k, words(rng, 30)) for k in range(400)]
    table += [(1000, table[7][1]), (None, table[9][1] + " "), (None, "by itself")]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    seen = spark.sparkContext.accumulator(0)

    def count(text):
        seen.add(1)
        return "".join((text or "").split(" "))

    monkeypatch.setattr(exact_dedup, "normalised", F.udf(count, "string"))
    exact_dedup.written(exact_dedup.fingerprints(docs), "fingerprints")
    once = seen.value
    kept = exact_dedup.without_duplicates(docs).collect()
    assert sorted(r["text"] for r in kept) == sorted(t for k, t in table if k not in (1000, 9))
    assert seen.value - 2 * once < 50


def test_ids_are_told_by_bits(spark):
    ids = spark.createDataFrame([(k * 977,) for k in range(300)] + [(None,)], "key long")
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("x").alias("bits"), F.lit(1).alias("row")) \
        .unionByName(spark.createDataFrame([(None, "null", 2)], "doc_id long, bits string, row int"))
    free, rest = split_by_id(docs, "doc_id", ids)
    assert free.columns == rest.columns == docs.columns
    out, met = [r["doc_id"] for r in free.collect()], [r["doc_id"] for r in rest.collect()]
    assert {None, *range(0, 20000, 977)} <= set(met) and len(met) < 40
    assert sorted(out + met, key=str) == sorted([None, *range(20000)], key=str)
    free, rest = split_by_id(docs, "doc_id", ids.limit(0))
    assert free.count() == 20001 and rest.isEmpty()


def test_small_batches_are_bounded_by_bytes(spark):
    docs = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 10000).alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], ["n"])

    with small_batches(spark):
        held = [r["n"] for r in docs.mapInArrow(sizes, "n long").collect()]
    assert len(held) > 5 and max(held) < 6 << 20 and sum(held) >= 3000 * 10000
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", "1b") == "1b"


def test_fingerprints_compose():
    rng = random.Random(3)
    data = bytes(rng.randrange(256) for _ in range(5000))
    whole = exact_dedup.fingerprint(data, chunk=1 << 13)
    assert all(exact_dedup.fingerprint(data, chunk=c) == whole for c in (1, 7, 64, 4999))


def test_byte_bpe_as_tiktoken(docs, rows, none):
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(byte_bpe.ranks_file(), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=byte_bpe.pattern(), mergeable_ranks=ranks, special_tokens={})
    got = by_id(byte_bpe.encode_and_decode(docs, keep_ids=True))
    for r in rows:
        if r[0] is not None:
            ids = enc.encode_ordinary(r[1] or "")
            assert list(got[r[0]]["ids"]) == ids and got[r[0]]["n_tokens"] == len(ids)
            assert got[r[0]]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
            assert got[r[0]]["decoded_sha256"] == hashlib.sha256((r[1] or "").encode()).hexdigest()
    assert byte_bpe.encode_and_decode(none).collect() == []


def test_units_are_told_apart_once():
    column = pa.array(["a  b a", None, "", " a a", "x\t \ny", "tail ", "a\0 b"])
    different, which, ends = bpe_words.units(column)
    assert sorted(set(different)) == sorted(different)
    cut = [[different[k] for k in which[a:b]] for a, b in zip(ends, ends[1:])]
    assert cut == [["a", " ", " b", " a"], [""], [""], ["", " a", " a"], ["x\t \ny"], ["tail", " "], ["a\0", " b"]]
    assert ends[-1] == len(which) == sum(map(len, cut))


def test_units_met_again_stay_remembered():
    memo, encoded = bpe_words.Memo(50), []

    def encode(units):
        encoded.extend(units)
        return [u.encode() for u in units]

    for k in range(100):
        codes, which, _ = bpe_words.by_units(pa.array([f"often met{k} " + " ".join(f"once{k}-{i}" for i in range(9))]), encode, memo)
        assert bpe_words.gathered(codes, which, "u1")[0].tobytes().startswith(f"often met{k} once{k}-0".encode())
        assert len(memo) + len(memo.older) < 150
    assert encoded.count("often") == 1 and len(encoded) == len(set(encoded))
    bpe_words.forget()
    assert not memo and not memo.older


def test_remembered_units_hold_no_objects():
    tracemalloc.start()
    try:
        memo, before = bpe_words.Memo(1 << 20), tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes()
        words = " ".join(f"once{i}" for i in range(50_000))
        bpe_words.by_units(pa.array([words]), lambda units: [u.encode() for u in units], memo)
        grown = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before - len(words)
    finally:
        tracemalloc.stop()
    assert len(memo) == 50_000 and grown < 100 * len(memo)


def test_units_are_cut_into_pre_tokens_met_once():
    memo, encoded = bpe_words.Memo(), []

    def encode(tokens):
        encoded.extend(tokens)
        return [t.encode() for t in tokens]

    cut = re.compile(r"\s?\w+|\W").findall
    for text in ("a, b. a, c", "c b, a. b.\nc", None, "a, b."):
        codes, which, ends = bpe_words.by_units(pa.array([text, "a"]), encode, memo, cut)
        assert bpe_words.gathered(codes, which, "u1")[0].tobytes().decode() == (text or "") + "a"
    assert sorted(encoded) == sorted(set(encoded)) and {"a", " b", ",", "c", "\nc"} <= set(encoded)


def test_pre_tokens_go_straight_to_the_model(monkeypatch):
    import tokenizers
    real, whole = tokenizers.Tokenizer.from_file(packing.tokenizer_file()), []

    class Watched:
        model = real.model
        get_added_tokens_decoder = real.get_added_tokens_decoder

        @staticmethod
        def from_str(spec):
            return Watched()

        def encode_batch_fast(self, texts, **options):
            whole.extend(texts)
            return real.encode_batch_fast(texts, **options)

    monkeypatch.setattr(tokenizers, "Tokenizer", Watched)
    encode, cut, memo = packing._encoder.__wrapped__(open(packing.tokenizer_file(), encoding="utf-8").read(), byte_bpe.pattern())
    texts = ["don't  stop 'S\r\n\t", "\0 \xff\u00ff \u65e5\u672c 12345 \U0001f642!", " ", "", "\n \n x", "a" * 3000, "\x1c a\x85 b\x1f "]
    marked = ["a<|endoftext|>b c", "<|endoftext|>"]
    for some in (texts, texts + marked):
        codes, which, ends = bpe_words.by_units(pa.array(some), encode, memo, cut)
        ids, ends = bpe_words.gathered(codes, which)[0].tolist(), bpe_words.gathered(codes, which)[1][ends].tolist()
        assert [ids[a:b] for a, b in zip(ends, ends[1:])] == [real.encode(t, add_special_tokens=False).ids for t in some]
        assert some is not texts or [t for t in whole if t] == []


@pytest.mark.parametrize("short", [0, byte_bpe.SHORT])
def test_short_and_long_merges_agree(short):
    codec = byte_bpe.Codec(*byte_bpe._built(byte_bpe.ranks_file()), byte_bpe.pattern())
    other = byte_bpe.Codec(*byte_bpe._built(byte_bpe.ranks_file()), byte_bpe.pattern())
    codec.short, other.short = short, byte_bpe.SHORT - short
    rng = random.Random(8)
    for _ in range(500):
        token = "".join(rng.choices("aaabeinrst", k=rng.randint(1, byte_bpe.SHORT))).encode()
        assert codec.merge(token) == other.merge(token)


def test_perfect_hash_is_minimal():
    tokens, (displacement, slots) = byte_bpe._built(byte_bpe.ranks_file())
    assert sorted(slots) == list(range(len(tokens)))
    codec = byte_bpe.Codec(tokens, (displacement, slots), byte_bpe.pattern())
    assert all(codec.find(t) == i for i, t in enumerate(tokens)) and codec.find(b"\xff\xfe no token") == -1


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


@pytest.mark.parametrize("block", [jaccard_join.BLOCK_NODES, 2])
def test_jaccard_components(docs, rows, none, monkeypatch, block):
    """Also with groups dealt over many blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK_NODES", block)
    ids = sorted({r[0] for r in rows if r[0] is not None})
    sets = {r[0]: shingles(r[1]) for r in rows if r[0] is not None}
    root = {i: i for i in ids}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    got = by_id(jaccard_join.linked(docs))
    assert {i: (got[i]["n_shingles"], got[i]["component_id"]) for i in ids} == {i: (len(sets[i]), find(i)) for i in ids}
    assert jaccard_join.linked(none).collect() == []


def test_prefixes_keep_every_link():
    """Any two linked sets share as many prefix shingles, of levels up to the
    smaller l, as the smaller l, whatever the frequencies."""
    rng = np.random.default_rng(2)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        a = np.unique(rng.integers(0, 1 << 60, n).astype(np.uint64))
        b = a.copy()
        b[rng.integers(0, len(b), int(rng.integers(0, 1 + len(b) // 6)))] = rng.integers(0, 1 << 60)
        b = np.unique(b)
        both = len(np.intersect1d(a, b))
        if 100 * both < 80 * (len(a) + len(b) - both):
            continue
        often = np.sort(rng.choice(a, len(a) // 2, replace=False))
        count = rng.integers(4, 1000, len(often))
        out = [jaccard_join._prefixes(np.zeros(len(x), np.int64), x, np.array([len(x)]), often, count, 80) for x in (a, b)]
        l = min(int(o[3][0]) for o in out)
        kept = [set(o[1][o[2] <= l].tolist()) for o in out]
        assert len(kept[0] & kept[1]) >= l


def brute_cut(rows, length):
    seen, cover = {}, {}
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    for r in dict.fromkeys(order):
        b = (r[1] or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if b[i:i + length] in seen:
                gone[i:i + length] = True
            else:
                seen[b[i:i + length]] = True
        cover[r[0]] = (b, gone[:len(b)])
    return cover


@pytest.mark.parametrize("length,seed,hot", [(100, 32, 4096), (20, 8, 4096), (100, 32, 1), (12, 12, 2)])
def test_suffix_dedup(spark, rows, none, length, seed, hot):
    """Also where every shared seed is dealt position by position."""
    real = [r for r in rows if r[0] is not None]
    docs = spark.createDataFrame(real, SCHEMA).repartition(3)
    got = by_id(suffix_dedup.remove_repeats(docs, length=length, seed=seed, hot_runs=hot, keep_text=True))
    for i, (b, gone) in brute_cut(real, length).items():
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(np.r_[False, gone, False].astype(int)) == 1).sum())
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"]) == (len(b), int(gone.sum()), spans), i
        assert got[i]["kept_sha256"] == hashlib.sha256(kept).hexdigest()
        assert got[i]["kept_text"] == kept.decode("utf-8", "ignore")
    if hot == 4096 and length == 100:
        assert suffix_dedup.remove_repeats(none).collect() == []


def test_suffix_passes_work_on_slices_of_a_batch():
    sized = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array([b"x" * 50_000] * 60)], ["key", "bytes"])
    parts = [t.column("key").to_pylist() for t in suffix_dedup._whole_keys(iter([sized]), 1 << 16, 1)]
    assert sum(parts, []) == list(range(60)) and max(map(len, parts)) < 30
    texts = pa.RecordBatch.from_arrays(
        [pa.array([1, 2, 3]), pa.array(["a" * 3_000_000] * 3), *(pa.array([None, [5, 2], [0]], pa.list_(pa.int64())) for _ in "ab")],
        ["doc_id", "text", "start", "stop"])
    cut = list(suffix_dedup._cut(iter([texts]), False))
    assert [c.column("doc_id").to_pylist() for c in cut] == [[1], [2], [3]]


def test_ranks_are_exact():
    rng = np.random.default_rng(4)
    data = rng.integers(0, 2, 400).astype(np.uint8)
    for length in (1, 5, 8, 13, 20):
        rank = suffix_dedup._ranked(data, length)
        whole = [data[i:i + length].tobytes() for i in range(len(data) - length + 1)]
        assert len({(r, w) for r, w in zip(rank.tolist(), whole)}) == len(set(whole)) == len(set(rank[:len(whole)].tolist()))


def test_packing(docs, rows, none):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.tokenizer_file())
    table = packing.written(packing.pieces(docs), "pieces")
    got = packing.pack(table).collect()
    want = []
    for r in rows:
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids + [0]
        n, at, k = len(ids), 0, 0
        size = n - 2048 * ((n - 1) // 2048)
        while at < n:
            want.append((r[0], k, at, size, zlib.crc32(np.asarray(ids[at:at + size], "<u4").tobytes())))
            at, k, size = at + size, k + 1, 2048
    assert sorted(map(str, [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got])) == \
        sorted(map(str, want))
    held = defaultdict(list)
    for r in got:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(packing.written(packing.pieces(none), "pieces")).collect() == []


def test_configurations_near_the_bound():
    rng = random.Random(9)
    for lengths, slack in (([rng.randint(1, 2048) for _ in range(20000)], 1.01), ([1100] * 50 + [900] * 49 + [40] * 7, 1.05),
                           ([2048] * 5, 1.0), ([1], 1.0)):
        histogram = {n: lengths.count(n) for n in set(lengths)}
        configs = packing.configurations(histogram)
        held = defaultdict(int)
        for c, m in configs:
            assert sum(c) <= 2048
            for n in c:
                held[n] += m
        assert dict(held) == histogram
        least = max(-(-sum(lengths) // 2048), sum(n > 1024 for n in lengths))
        assert sum(m for _, m in configs) <= max(least + 1, slack * least)


def test_repeated_rows_cost_one(spark):
    """Copies of a row add no spans; columns of any name ride along."""
    rng = random.Random(12)
    long = words(rng, 150)
    early = long.replace(" ", "  ", 1)
    schema = "doc_id long, text string, `a.b` string, doc string, mark string, row string"
    few, many = (spark.createDataFrame([(1, early, "p", "q", "r", "s")] + [(5, long, "p", "q", "r", "s")] * k, schema)
                 for k in (1, 60))
    assert suffix_dedup.repeated(many).count() == suffix_dedup.repeated(few).count() > 0
    one = {r["kept_sha256"] for r in suffix_dedup.remove_repeats(few).filter("doc_id = 5").collect()}
    rows = suffix_dedup.remove_repeats(many, keep_text=True).filter("doc_id = 5").collect()
    assert len(rows) == 60 and {r["kept_sha256"] for r in rows} == one and all(r["row"]["a.b"] == "p" for r in rows)


def test_lm_scores(spark, none):
    docs = spark.createDataFrame([(1, "a b c"), (2, "A b d"), (3, ""), (4, None), (5, "q")], "doc_id long, text string")
    got = by_id(lm_scoring.stupid_backoff(docs, order=2))
    # 1: a is 1 of the 4 words elsewhere; a b follows a once of once; b c is unknown, c as well (0.5 of 4).
    assert got[1]["log_score"] == pytest.approx(np.log(1 / 4) + np.log(1 / 1) + np.log(0.4) + np.log(0.5 / 4))
    assert got[5]["log_score"] == pytest.approx(np.log(0.5 / 6)) and got[5]["n_words"] == 1
    assert got[3]["n_words"] == got[4]["n_words"] == 0 and got[3]["mean_score"] is None
    # Three words: a b c and b c are unknown, so c gives up two orders.
    got = by_id(lm_scoring.stupid_backoff(docs))
    assert got[1]["log_score"] == pytest.approx(np.log(1 / 4) + np.log(1 / 1) + 2 * np.log(0.4) + np.log(0.5 / 4))
    more = spark.createDataFrame([(1, "a b c d"), (2, "a b c e"), (3, "x b c"), (4, "a b")], "doc_id long, text string")
    # 1: b follows a in two of two, c follows a b in one of two, d is unknown.
    assert by_id(lm_scoring.stupid_backoff(more))[1]["log_score"] == pytest.approx(
        np.log(2 / 9) + np.log(2 / 2) + np.log(1 / 2) + 2 * np.log(0.4) + np.log(0.5 / 9))
    assert lm_scoring.stupid_backoff(none).collect() == []


def test_lm_words_in_any_slices(rows, monkeypatch):
    texts = [(r[1] or "").encode() for r in rows]
    data = b"".join(texts)
    packed = pa.Codec("zstd").compress(data, asbytes=True)
    whole = lm_scoring._read([len(t) for t in texts], packed, len(data))
    for size in (1, 50, 1000):
        monkeypatch.setattr(lm_scoring, "SLICE_BYTES", size)
        cut = lm_scoring._read([len(t) for t in texts], packed, len(data))
        assert all(np.array_equal(a, b) for a, b in zip(whole, cut, strict=True))


def test_lm_scores_in_any_blocks(docs):
    one = by_id(lm_scoring.stupid_backoff(docs, order=3).filter("doc_id != 3"))
    many = by_id(lm_scoring.stupid_backoff(docs, order=3, block_bytes=200, partition_bytes=100).filter("doc_id != 3"))
    assert one.keys() == many.keys()
    assert all(one[i]["log_score"] == pytest.approx(many[i]["log_score"]) for i in one)


def test_language_id(spark, none):
    rng = random.Random(1)
    kinds = {"xx": "abcde", "yy": "abxyz"}
    rows = [(k, words(rng, 40, kinds[lang]), lang) for k, lang in enumerate(["xx", "yy"] * 150)]
    models = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    new = [(k, words(rng, 12, kinds[lang]), lang) for k, lang in enumerate(["xx", "yy"] * 20)]
    new += [(100, None, None), (101, "123 ... \n", None), (102, "", None), (103, "日本語のテキスト" * 9, None)]
    got = by_id(language_id.identify(spark.createDataFrame(new, "doc_id long, text string, lang string"), models))
    assert all(got[k]["lang_pred"] == lang and 0.5 < got[k]["score"] <= 1 for k, _, lang in new[:40])
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 for k in (100, 101, 102))
    assert not got[103]["accepted"]
    nothing = language_id.fit(none)
    assert all(r["lang_pred"] == "und" for r in language_id.identify(
        spark.createDataFrame(new, "doc_id long, text string, lang string"), nothing).collect())
    assert language_id.identify(none, models).collect() == []


def test_kneser_ney_sums_to_one():
    batch = ["abab baab", "abba", "bab aab"]
    counts = {(0, k): (h, s, c, n) for k, h, s, c, n in language_id._counts(batch, 3)}
    models = language_id.estimate(["xx"], 3, counts)
    codes, at, _ = language_id.characters(batch, 3)
    known = np.unique(codes[at])
    for i in at[:12]:
        total = 0.0
        for c in [*known, 0x4E00]:  # the last stands for all unknown characters
            one = codes[:i + 1].copy()
            one[i] = c
            value = np.zeros((1, 1))
            models._add(one, np.array([i]), np.array([0]), value)
            total += np.exp(value[0, 0])
        assert total == pytest.approx(1.0, abs=1e-5)


def test_toxicity(spark, none, rows):
    rng = random.Random(8)
    table, labels = [], []
    for k in range(1200):
        w = words(rng, rng.randint(3, 60)).split()
        if k % 4 == 0:
            w.insert(rng.randrange(len(w)), rng.choice(["grobian", "Grobian!", "du", "schuftig"]) + " grobian")
        table.append((k, " ".join(w)))
        labels.append((k, int(k % 4 == 0)))
    docs = spark.createDataFrame(table, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    new = [(0, "some abc words here grobian too"), (1, "abc def fed"), (2, None), (3, ""), (4, "gr0bian abc")]
    got = by_id(model.score(spark.createDataFrame(new, "doc_id long, text string")))
    assert [got[k]["predicted"] for k in range(5)] == [1, 0, 0, 0, 1]
    assert all(0 <= got[k]["score"] <= 1 for k in got)
    edge = spark.createDataFrame(rows, SCHEMA)
    assert model.score(edge).count() == len(rows)
    clean = model.clean(edge)
    assert clean.columns == edge.columns and clean.count() == len(rows)
    assert model.score(none).collect() == []
    blank = toxicity.fit(none, spark.createDataFrame([], "doc_id long, toxic int"))
    assert blank.score(edge).agg(F.max("score")).first()[0] == 0.0


def test_representatives_of_null_and_repeated_ids(spark):
    """A row that goes takes no other text of its id along."""
    rng = random.Random(21)
    a, b, c, d, e = (words(rng, 60) for _ in range(5))
    table = [(1, a), (None, a + " more"), (None, b), (None, c),  # b and c are clean
             (2, d), (5, d + " more"), (5, e), (7, e + " more"),  # e is its group's own representative
             (None, None), (9, "")]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    kept = [tuple(r) for r in jaccard_join.representatives(docs).collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (None, b), (None, c), (2, d), (5, e), (None, None), (9, "")], key=str)


@pytest.mark.parametrize("stage", [exact_dedup.without_duplicates, jaccard_join.representatives])
def test_one_of_equal_rows_stays(spark, stage):
    """Repeated rows, with and without an id, and blanks that tie on the id."""
    rng = random.Random(22)
    a, b, c = (words(rng, 40) for _ in range(3))
    table = [(1, a, "x"), *[(1, a, "x")] * 20, (None, b, "x"), *[(None, b, "x")] * 20, (3, c, "x"), (3, c + "  ", "y"),
             (4, c, "x"), (8, "alone by itself", "z")]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string").repartition(3)
    kept = stage(docs)
    assert kept.columns == docs.columns
    kept = [tuple(r) for r in kept.collect()]
    assert len(kept) == 4 and {r[0] for r in kept} == {1, None, 3, 8}
    if stage is exact_dedup.without_duplicates:
        assert (3, c + "  ", "y") in kept  # the longest


def test_suffix_dedup_of_texts_without_an_id(spark):
    """Two texts without an id whose hashes agree in 23 bits: neither gets the other's cuts."""
    rng = random.Random(23)
    passage, plain = words(rng, 60), words(rng, 90)
    pairs = spark.createDataFrame([(f"{plain} p{k}", f"{passage} f{k}") for k in range(20000)], "plain string, found string")
    code = [F.pmod(F.xxhash64(c), F.lit(1 << 23)).alias("code") for c in ("plain", "found")]
    one, two = pairs.select("plain", code[0]).join(pairs.select("found", code[1]), "code") \
        .orderBy("plain").select("plain", "found").first()
    docs = spark.createDataFrame([(1, passage), (None, one), (None, two)], "doc_id long, text string")
    got = {r["kept_text"]: r["n_removed"] for r in suffix_dedup.remove_repeats(docs, keep_text=True).collect()}
    assert got == {passage: 0, one: 0, two[len(passage):]: len(passage)}


def test_candidates_keep_every_link():
    """Sets whose overlap is at and about the threshold: a pair of nodes that
    is linked is never taken for none, and pairs far below are dropped."""
    import pyarrow as pa
    rng = np.random.default_rng(9)
    dropped = 0
    for _ in range(400):
        n = int(rng.integers(1, 90))
        base = rng.choice(10 ** 6, n, replace=False).astype(np.uint64)
        lost, new = int(rng.integers(0, max(1, n // 3) + 1)), int(rng.integers(0, 12))
        other = np.unique(np.r_[base[lost:], rng.choice(10 ** 6, new).astype(np.uint64) + np.uint64(10 ** 6)])
        base = np.unique(base)
        if not len(other):
            continue
        both = len(np.intersect1d(base, other))
        linked = 100 * both >= 80 * (len(base) + len(other) - both)
        often = np.unique(rng.choice(np.r_[base, other], max(1, n // 4)))
        count = rng.integers(4, 4000, len(often))
        posts = []
        for x in (base, other):
            _, value, level, chosen = jaccard_join._prefixes(np.zeros(len(x), np.int64), x, np.array([len(x)]), often, count, 80)
            posts.append([{"shingle": int(v), "info": len(x) << 16 | int(l) << 8 | int(c)} for v, l, c in zip(value, level, chosen)])
        part = pa.table({"pivot": [1, 1], "lo": [0, 0], "hi": [0, 0], "second": [False, False], "node": [5, 9],
                         "posts": pa.array(posts, pa.list_(pa.struct([("shingle", pa.int64()), ("info", pa.int64())])))})
        kept = jaccard_join._candidates(part, True, 80)
        assert len(kept) == 2 or not linked
        dropped += len(kept) == 0
    assert dropped > 20
