"""The pipeline's stages on a table with planted cases, and its result against a plain computation."""

import hashlib

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
from tests.llm.test_methods import _components, _fingerprint, _leaks
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    item = duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet' WHERE item_id = 0").fetchall()[0][0]
    first = docs.orderBy("doc_id").first()
    planted = [(9001, first["text"].upper().replace("É", "é"), "fr", "s", 1), (9002, "start " + item + " end", "en", "s", 1),
               (9003, None, "en", "s", 1), (9004, "123 !!", "en", "s", 1), (9005, first["text"], "fr", "s", 1)]
    docs = docs.unionByName(spark.createDataFrame(planted, docs.schema))
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, SF)
        assert out.columns == docs.columns, name
        before = {r["doc_id"]: r for r in kept.collect()}
        kept = spark.createDataFrame(out.collect(), docs.schema)
        after = {r["doc_id"]: r for r in kept.collect()}
        assert all(before[i] == r for i, r in after.items()), name
        gone = set(before) - set(after)
        if name == "language_id":
            assert gone == {9003, 9004}
        elif name == "exact_dedup":
            lower = lambda t: t.encode().lower()
            assert set(after) == {max(j for j in before if lower(before[j]["text"]) == lower(before[i]["text"]))
                                  for i in before}
        elif name == "simhash_near_dedup":
            ids = sorted(before)
            label = _components([_fingerprint(before[i]["text"]) for i in ids], lambda a, b: (a ^ b).bit_count() <= 2)
            least = {}
            for i, x in zip(ids, label, strict=True):
                least.setdefault(x, i)
            assert set(after) == set(least.values())
        else:
            items = dict(duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall())
            assert gone == {d for d, _ in _leaks({i: r["text"] for i, r in before.items()}, items)} and 9002 in gone
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    coded = corpus_pipeline.STAGES[-1][1](spark, kept, SF).collect()
    assert {r["doc_id"] for r in coded} == set(texts)
    for r in coded:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())


def test_run_applies_all_stages(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and len({r["doc_id"] for r in rows}) == len(rows)
