"""Every operator on nulls, empty and long texts, repeated rows, clashing columns, and empty tables."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from tests.llm.conftest import AWKWARD, SENTENCE

from entryclime.llm import (bpe, chat, decontaminate, exact_dedup, langid, quality, sharding, simhash, token_counts,
                            warc)

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
IDS = sorted(Counter(r[0] for r in AWKWARD).items(), key=str)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (5, 1, 1), (6, 0, 0), (None, 1, None), (99, None, None), (11, 0, 0)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, SENTENCE), (2, None), (3, ""), (4, "too short"), (None, SENTENCE)],
                                 "item_id long, text string")


def per_document(spark, awkward, labels):
    return {
        "quality": quality.score_by_folds(awkward, labels),
        "token_counts": token_counts.token_counts(awkward, PIECES),
        "exact_dedup": exact_dedup.exact_duplicates(awkward),
        "simhash": simhash.near_duplicates(awkward),
        "sharding": sharding.assign_shards(awkward, 4),
        "bpe": bpe.digests(bpe.encode_decode(awkward, BPE)),
        "langid": langid.identify_by_folds(awkward),
    }


def test_one_row_per_document(spark, awkward, labels):
    for name, df in per_document(spark, awkward, labels).items():
        assert sorted(Counter(r["doc_id"] for r in df.collect()).items(), key=str) == IDS, name


def test_empty_tables_give_no_rows(spark, nothing, labels, benchmark):
    for name, df in per_document(spark, nothing, labels.limit(0)).items():
        assert df.count() == 0, name
    assert decontaminate.contaminated(nothing, benchmark).count() == 0
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert chat.round_trip(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_filters_keep_columns_and_choose_rows(awkward, benchmark, nothing):
    kept = exact_dedup.drop_exact_duplicates(awkward)
    assert kept.columns == awkward.columns
    # null and empty texts are one group; A-Z folds but umlauts do not; repeated rows leave one
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect() if r["doc_id"] in (1, 2, 5, 6, 7, 8, 9, 14, 15)) == [
        (2, ""), (7, SENTENCE), (9, AWKWARD[9][1]), (15, "x"), (15, "y")]
    assert sum(r["doc_id"] is None for r in kept.collect()) == 1
    near = simhash.drop_near_duplicates(awkward)
    assert near.columns == awkward.columns
    assert Counter(r["doc_id"] for r in near.collect())[7] == 0  # 5 stays for 6 and 7
    clean = decontaminate.decontaminate(awkward, benchmark)
    assert clean.columns == awkward.columns
    assert {r["doc_id"] for r in awkward.collect()} - {r["doc_id"] for r in clean.collect()} == {5, 6, 7}
    assert clean.where("doc_id IS NULL").count() == 1  # the null row without the passage
    known = langid.keep_identified(awkward)
    assert known.columns == awkward.columns
    left = {r["doc_id"] for r in known.collect()}
    assert not left & {1, 2, 3, 4} and {5, 6, 7, 8, 9, 11, 12, 13} <= left
    for f in (exact_dedup.drop_exact_duplicates, simhash.drop_near_duplicates, langid.keep_identified):
        assert f(nothing).count() == 0


def test_no_benchmark_finds_nothing(awkward, benchmark):
    assert decontaminate.contaminated(awkward, benchmark.limit(0)).count() == 0
    assert decontaminate.contaminated(awkward, benchmark.where("item_id > 1")).count() == 0


def test_texts_without_letters_are_unknown(awkward):
    found = {r["doc_id"]: r for r in langid.identify_by_folds(awkward.where("doc_id IS NOT NULL")).collect()}
    for d in (1, 2, 3, 4):
        assert found[d]["lang_pred"] == "und" and found[d]["score"] == 0 and found[d]["rejected"]
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_without_training_rows(awkward, labels):
    assert {r["lang_pred"] for r in langid.identify_by_folds(awkward.where("doc_id = 10")).collect()} == {"und"}
    scores = quality.score_by_folds(awkward, labels.limit(0)).collect()
    assert {r["score"] for r in scores} == {0.5} and {r["predicted"] for r in scores} == {1}


def test_copies_neither_hide_a_language_nor_fill_the_sample(spark):
    """Language b: 30 texts and one page many times; texts without a letter are no texts of it. Clustering sees each once."""
    def text(letters, k):
        rng = random.Random(f"{letters}{k}")
        return " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(40))
    rows = [(text("abcdefghij", k), "a") for k in range(400)]
    rows += [(text("qrstuvwxyz", k), "b") for k in range(30)] + [(text("qrstuvwxyz", 99), "b")] * 20_000
    rows += [(f"{k} !", "b") for k in range(20_000)]
    train = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    for fit_rows in (20, 60):
        model = langid.fit(train, fit_rows=fit_rows)
        assert set(model.langs) == {"a", "b"}
    wrong = [t for t, lang in rows[:430] if model.predict([t])[0] != [lang]]
    assert not wrong
    # one row per text: a model of the texts without copies has the same centroids under the same frequencies
    once = [t for t, lang in dict.fromkeys(rows) if lang == "b" and any(c.isalpha() for c in t)]
    v, _ = langid.vectors_of(sorted(once), model.idf)
    v = v[sorted(range(len(v)), key=lambda i: v[i].tobytes())]
    want = sorted(c.astype("f4").tobytes() for c in langid._cluster(v, langid.CENTROIDS))
    assert sorted(c.tobytes() for c, lang in zip(model.centroids, model.langs, strict=True) if lang == "b") == want


def test_scores_are_in_range(awkward, labels):
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
               for r in quality.score_by_folds(awkward, labels).collect())


def test_empty_text_results(awkward):
    empty = hashlib.sha256(b"").hexdigest()
    coded = {r["doc_id"]: r for r in bpe.digests(bpe.encode_decode(awkward, BPE)).collect()}
    assert (coded[1]["n_tokens"], coded[1]["ids_sha256"], coded[2]["decoded_sha256"]) == (0, empty, empty)
    assert {r["doc_id"]: r["fingerprint"] for r in simhash.near_duplicates(awkward).collect()}[3] == "0" * 16
    counts = {r["doc_id"]: r for r in token_counts.token_counts(awkward, PIECES).collect()}
    assert (counts[1]["n_words"], counts[3]["n_tokens"], counts[11]["n_words"]) == (0, 0, 30_000)
    groups = {r["doc_id"]: r for r in exact_dedup.exact_duplicates(awkward, digest_all=True).collect() if r["doc_id"]}
    assert groups[1]["keep_id"] == 2 and groups[1]["group_size"] == 3 and groups[1]["text_sha256"] == empty


def test_repeated_rows_keep_exactly_one(awkward):
    kept = [r for r in exact_dedup.exact_duplicates(awkward).collect() if r["kept"] and r["keep_id"] == 7]
    assert len(kept) == 1


def test_unrelated_texts_under_a_null_or_repeated_id_all_stay(spark):
    """Smallest ids that are null or equal do not make a group; a linked copy still goes."""
    words = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(12)]
    rows = [(None, words[k]) for k in range(5)] + [(7, words[k]) for k in range(5, 10)]
    rows += [(8, words[10]), (9, words[10].upper()), (None, words[0].upper())]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert Counter(r["doc_id"] for r in kept) == {None: 5, 7: 5, 8: 1}
    assert {r["text"].lower() for r in kept} == set(words[:11])


def test_warc_awkward_pages(spark):
    rows = [(1, None, None), (2, "http://a/\r\nb", "x" * 99), (3, "u", "x" * 99), (4, "u", "y" * 100), (5, None, "y" * 100),
            (4, "v", "y" * 100), (6, "u", ""), (None, "u", "z" * 200), (7, "u", "z" * 200), (8, "u", "é" * 3_000_000),
            (9, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 20), (None, None, None)]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, digest string")
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                  for r in warc.round_trip(pages).collect()), key=str)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = [(p, len((t or "").encode()), sha(t), "response", None) for p, _, t in rows]
    want[4] = (*want[4][:3], "revisit", 4)
    want[5] = (*want[5][:3], "revisit", 4)
    want[7] = (*want[7][:3], "revisit", 7)
    assert got == sorted(want, key=str)


def test_chat_awkward_turns(spark):
    rows = [(1, 0, None, None), (1, 1, "assistant", "<|im_end|>\n<|im_start|>"), (1, 1, "assistant", "<\\| <\\\\|x"),
            (2, None, "user\n<|im_end|>\\n", "a"), (None, 0, "assistant", ""), (3, 5, "assistant", "z" * 200_000),
            (3, 6, "assistant", "<|"), (4, 0, "user", "a"), (4, 0, "user", "a")]
    turns = spark.createDataFrame([(*r, "k") for r in rows],
                                  "conv_id long, turn long, role string, text string, part string")
    got = {r["conv_id"]: r for r in chat.round_trip(turns).collect()}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in (1, 2, 3, 4, None):
        own = sorted((r for r in rows if r[0] == conv), key=key)
        text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] for r in own if r[2] == "assistant")
        assert got[conv]["n_turns"] == len(own)
        assert got[conv]["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_sharding_splits_a_hot_id(spark):
    rows = [(None, "x" * (i % 50)) for i in range(3000)] + [(7, "same")] * 3000 + [(i, None) for i in range(3000)]
    found = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), 10).collect()
    sizes = Counter()
    for r in found:
        sizes[r["shard"]] += r["size"]
    assert len(found) == 9000 and set(sizes) == set(range(10))
    assert max(sizes.values()) - min(sizes.values()) <= 2 * (50 + 16)
    for shard in range(10):
        assert sorted(r["slot"] for r in found if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in found)))
