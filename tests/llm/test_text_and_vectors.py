"""Vector codes, suffix-array dedup and collocations against brute force and their SQL, and on awkward rows."""

import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from entryclime.llm import blocks, collocations, common, decontaminate, exact_dedup, suffix_dedup, vector_codes
from entryclime.llm.oracle import ORACLE_SQL
from entryclime.llm.queries import QUERIES
from scripts.check_oracle import digest, norm
from tests.llm.conftest import AWKWARD

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def small_blocks(monkeypatch):
    """Many blocks and buckets, and anchors that are crowded soon."""
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 50_000)
    monkeypatch.setattr(blocks, "BUCKET_BYTES", 20_000)
    monkeypatch.setattr(suffix_dedup, "CROWDED", 8)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", ["op11_vector_codes", "op13_collocations"])
def test_query_matches_its_sql(spark, con, name, small_blocks):
    got, want = norm(QUERIES[name](spark, SF_DIR).toPandas()), norm(con.sql(ORACLE_SQL[name]).df())
    assert list(got.columns) == list(want.columns) and len(got) == len(want) > 0
    assert digest(got) == digest(want)


# ------------------------------------------------------------------ suffix-array dedup
def without_repeats(rows):
    """Brute force: (id, spans, kept) of (id, text) rows; null ids are smallest."""
    order = {None: -(1 << 63)}
    first: dict[bytes, int] = {}
    for i, t in rows:
        b, i = (t or "").encode(), order.get(i, i)
        for p in range(len(b) - 49):
            w = b[p:p + 50]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in rows:
        b, key = (t or "").encode(), order.get(i, i)
        gone = np.zeros(len(b) + 2, bool)
        for p in range(len(b) - 49):
            if first[b[p:p + 50]] < key:
                gone[p + 1:p + 51] = True
        edges = np.flatnonzero(gone[1:] != gone[:-1])
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[1:-1]])
        out.append((i, tuple(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)), kept))
    return sorted(out, key=repr)


def spans_of(df):
    return sorted(((r["doc_id"], tuple((s["start"], s["stop"]) for s in r["spans"]), bytes(r["kept"]))
                   for r in df.collect()), key=repr)


def test_removed_bytes_match_brute_force(spark, small_blocks):
    got = QUERIES["op12_suffix_dedup"](spark, SF_DIR).collect()
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    want = {i: (len((dict(rows)[i] or "").encode()), sum(b - a for a, b in spans), len(spans),
                hashlib.sha256(kept).hexdigest()) for i, spans, kept in without_repeats(rows)}
    assert len(got) == len(want)
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in got} == want


def test_awkward_texts(awkward, nothing, small_blocks):
    assert spans_of(suffix_dedup.remove_repeats(awkward)) == without_repeats([(r[0], r[1]) for r in AWKWARD])
    assert suffix_dedup.remove_repeats(nothing).count() == 0


def test_passages_shared_at_every_offset(spark, small_blocks):
    rng = random.Random(5)
    pool = ["".join(rng.choice("ab é\x00") for _ in range(90)) for _ in range(4)]
    rows = []
    for i in range(60):
        passage = rng.choice(pool)
        cut = rng.randrange(0, 45)
        filler = "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(0, 60)))
        rows.append((rng.randrange(40), filler + passage[cut:] + filler * rng.randrange(0, 3)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert spans_of(suffix_dedup.remove_repeats(docs)) == without_repeats(rows)


@pytest.mark.parametrize("small", [4, 1 << 12])
def test_suffixes_are_ordered(monkeypatch, small):
    monkeypatch.setattr(suffix_dedup, "SMALL", small)
    rng = np.random.default_rng(3)
    codes = np.concatenate([rng.integers(97, 99, 4000), np.tile(rng.integers(97, 100, 37), 40)]).astype(np.uint8)
    starts = np.arange(len(codes) - 50)
    order, begins = suffix_dedup.suffix_order(suffix_dedup.Text(codes, 50), starts)
    data = codes.tobytes()
    suffixes = [data[i:i + 50] for i in order.tolist()]
    assert suffixes == sorted(data[i:i + 50] for i in starts.tolist())
    assert begins.tolist() == [k for k in range(len(suffixes)) if k == 0 or suffixes[k] != suffixes[k - 1]]


# ------------------------------------------------------------------ collocations
def test_long_texts_are_cut_between_words(spark, nothing, monkeypatch, small_blocks):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["An", "ox", "is", "a\tbig", "beast,", "the", "sky.", "über"]) for _ in range(800)),
             rng.choice(["en", None])) for i in range(12)]
    docs = spark.createDataFrame([*rows, (99, None, "fr"), (98, "", "fr")], "doc_id long, text string, lang string")
    whole = sorted(map(tuple, collocations.phrase_counts(docs).collect()))
    monkeypatch.setattr(collocations, "SEGMENT_BYTES", 37)
    assert sorted(map(tuple, collocations.phrase_counts(docs).collect())) == whole
    words = {r[0]: r[3] for r in whole if r[1] == 0}
    assert words["fr"] == 0 and words["en"] + words["und"] == sum(len(t.split()) for _, t, _ in rows)
    assert ("und", 1, "an", sum(t.split().count("An") for _, t, lang in rows if lang is None)) in whole
    assert collocations.collocations(nothing).count() == 0


def test_a_phrase_spread_over_all_shards_is_found(spark, small_blocks):
    rows = [(i, f"w{i} rare pair v{i}" + " filler" * 2000, "en") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    found = {r["phrase"]: r["a"] for r in collocations.collocations(docs).collect()}
    assert found["rare pair"] == 10


# ------------------------------------------------------------------ vector codes
@pytest.mark.parametrize("n, dims", [(1, 4), (64, 4), (64, 1), (40, 48)])
def test_nearest_entries_match_brute_force(n, dims):
    rng = np.random.default_rng(n + dims)
    entries = rng.integers(-20, 20, (n, dims))
    entries[n // 2:] = entries[:n - n // 2]  # equal entries: the lowest index counts
    points = np.concatenate([rng.integers(-25, 25, (300, dims)), rng.integers(-9000, 9000, (20, dims)), entries])
    index, distance = vector_codes.Nearest(entries)(points)
    squared = ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert index.tolist() == squared.argmin(axis=1).tolist() and distance.tolist() == squared.min(axis=1).tolist()


def test_awkward_vectors(spark):
    schema = "vec_id long, embedding array<float>, label int, v string, code string, error string"
    rows = [(1, [0.5] * 16, 1), (2, None, 1), (3, [0.5] * 15 + [None], 1), (4, [float("nan")] * 16, None),
            (5, [float("inf")] * 16, None), (6, [-0.001] * 16, None), (7, [-0.001] * 16, None), (None, [0.25] * 16, None),
            (8, [], 1), (9, [0.1] * 40, 1), (1, [0.5] * 16, 1)]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], schema)
    got = {(r["vec_id"], r["code"], r["error"], r["label_error"]) for r in vector_codes.vector_codes(df).collect()}
    assert got == {(1, "00" * 16, 0, 0), (6, "02" * 16, 0, 0), (7, "02" * 16, 0, 0), (None, "04" * 16, 0, 0)}
    assert vector_codes.vector_codes(df.limit(0)).count() == 0
    padded = spark.createDataFrame([(1, [1.0] * 20, 1, "", "", "")], schema)
    assert vector_codes.vector_codes(padded).first()["error"] == 0


# ------------------------------------------------------------------ decontamination of long documents
def test_long_documents_are_searched_in_blocks(spark, monkeypatch):
    rng = random.Random(4)
    item = " ".join(f"item{i}" for i in range(14))
    short = "two words"
    long_text = " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit"]) for _ in range(60_000))
    words = (long_text + " end").split()
    for at in (0, 250, 255, 256, 257, 511, 30_000):
        words[at:at + 1] = [*item.split()]
    text = " ".join(words) + " " + short
    docs = spark.createDataFrame([(1, text), (2, long_text), (3, item)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, short), (3, "")], "item_id long, text string")

    def found():
        return sorted((r["doc_id"], r["item_id"], r["matched_tokens"], r["first_token"], r["hits"])
                      for r in decontaminate.contaminated(docs, bench).collect())

    got = found()
    assert [(d, i, m) for d, i, m, _, _ in got] == [(1, 1, 13), (1, 2, 2), (3, 1, 13)]
    monkeypatch.setattr(decontaminate, "BLOCK_TOKENS", 1 << 20)
    assert found() == got
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert found() == got
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(r["_id"] for r in decontaminate.leaking(docs, bench).collect()) == [1, 3]


def test_leaking_documents_are_those_of_the_pairs(spark):
    """Random items of 1 to 30 words and documents with altered parts of them, short documents and cut items among them."""
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 5, 7, 8, 9, 10, 11, 12, 13, 14, 20, 30]))]
             for _ in range(80)]
    items = [w for w in items if len(w) > 2] + [["rare"], ["two", "words"]]
    docs = []
    for i in range(600):
        part = list(rng.choice(items))
        for _ in range(rng.randrange(5)):
            part[rng.randrange(len(part))] = rng.choice(vocabulary)
        cut = part[rng.randrange(3):len(part) - rng.randrange(3)]
        around = [[rng.choice(vocabulary) for _ in range(rng.choice([0, 0, 1, 40]))] for _ in range(2)]
        docs.append((i, " ".join([*around[0], *cut, *around[1]])))
    docs += [(None, None), (700, ""), (701, "W1!")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    want = {r["doc_id"] for r in decontaminate.contaminated(df, bench).select("doc_id").distinct().collect()}
    got = [r["_id"] for r in decontaminate.leaking(df, bench).collect()]
    assert 100 < len(want) < 600 and len(got) == len(set(got)) and set(got) == want
    assert decontaminate.leaking(df, bench.limit(0)).count() == 0


def test_many_items_with_one_prompt(spark):
    """10,000 items that share a prompt against 1,000 documents with it: no document meets the items one by one."""
    prompt = " ".join(f"p{i}" for i in range(14))
    bench = spark.range(10_000).selectExpr("id AS item_id", f"concat('{prompt} ', id, 'a ', id, 'b ', id, 'c') AS text")
    altered = prompt.replace("p6", "other")
    docs = spark.range(1500).selectExpr("id AS doc_id", "CASE WHEN id < 500 THEN concat('before ', id, ' "
                                        f"{prompt}') WHEN id < 1000 THEN concat('{altered} after ', id) "
                                        f"ELSE concat('p1 p2 p3 p4 p5 p6 ', id) END AS text")
    got = [r["_id"] for r in decontaminate.leaking(docs, bench).collect()]
    assert sorted(got) == list(range(1000))


@pytest.mark.parametrize("words", [1, 1 << 10, 1 << 17])
def test_rows_drop_alike_with_any_filter(spark, monkeypatch, words):
    """A filter that takes all rows for members, one that takes some and one that takes almost none give equal rows."""
    monkeypatch.setattr(common, "LEAST_FILTER_WORDS", 1)
    monkeypatch.setattr(common, "words_for", lambda keys: words)
    docs = spark.range(20_000).selectExpr("IF(id % 1000 = 3, NULL, id) AS doc_id", "concat('t', id % 7000) AS text",
                                          "id AS _key", "id AS _maybe")
    out = docs.where("_key % 3 = 0").select(*common.row_key("doc_id", "text"))
    kept = common.drop_rows(docs, out, "doc_id", "text")
    assert kept.columns == docs.columns

    def key(i):  # rows with a null id are told apart by their texts
        return (None if i % 1000 == 3 else i, i % 7000)

    gone = {key(i) for i in range(0, 20_000, 3)}
    assert sorted(r["_key"] for r in kept.select("_key").collect()) == [i for i in range(20_000) if key(i) not in gone]
    copies = exact_dedup.exact_duplicates(docs)
    assert copies.where("kept").count() == 7000 and copies.count() == 20_000


@pytest.mark.parametrize("packing", [blocks.KeyPacking(5, 36, 4), blocks.GapPacking(5, 36, 4), blocks.GapPacking(4, 40, 8)])
def test_packed_keys_come_back(packing):
    rng = np.random.default_rng(1)
    keys = np.concatenate([rng.integers(0, 1 << 64, 5000, np.uint64), np.array([0, (1 << 64) - 1], np.uint64)])
    short = np.unique(packing.short(keys))
    beside = rng.integers(0, 1 << packing.extra, len(short)).astype(np.uint64)
    buckets, payloads = packing.pack(short, beside)
    got, also, counts = packing.unpack(buckets, pa.chunked_array([payloads]))
    assert np.array_equal(got, short) and np.array_equal(also, beside) and counts.sum() == len(short)
    assert len(packing.unpack(np.empty(0, np.int64), pa.chunked_array([], pa.binary()))[0]) == 0
