"""Small awkward tables for the training-data operators."""

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _id string, _h string, _text string, "
          "fp string, score string, rejected string, _len string, _row string, _key string, shard string, size string")


def doc(doc_id, text, lang="en"):
    return (doc_id, text, lang, None, None, *[f"clash{i}" for i in range(11)])


SENTENCE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from the old barn roof tonight"

AWKWARD = [
    doc(1, None), doc(2, ""), doc(3, "   \n\t "), doc(4, "12 34 !!"), doc(5, SENTENCE), doc(6, SENTENCE.upper()),
    doc(7, SENTENCE), doc(7, SENTENCE), doc(8, "Straße über größere Häuser und kleine Gärten", "de"),
    doc(9, "straße über größere häuser und kleine gärten", "de"), doc(10, "ÜBER ALLES", None), doc(None, SENTENCE + " x"),
    doc(None, SENTENCE + " x"), doc(None, None, None), doc(11, "word " * 30_000), doc(12, "a" * 60_000),
    doc(13, "日本語のテキスト" * 3000, "ja"), doc(14, "x"), doc(15, "x"), doc(15, "y"), doc(16, "😀 <|endoftext|> 'll"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
