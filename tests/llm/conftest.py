import pytest

from pyspark.sql import functions as F

LONG = " ".join(f"w{i * 7919 % 10007}" for i in range(6000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today. " * 3),
    (2, "One clean document about the weather in spring, with words enough to pass every base rule of the set here now."),
    (2, "A second text under the same id, also about the weather, with words enough to pass every base rule of the set."),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, LONG),
    (7, "short text"),
    (7, "short text"),
    (None, "A document without any id that still holds a sentence about the weather in spring and some more words in it."),
    (8, "ünïcödé wörds ärë cöünted äs lëtters, thät is whät the rüles säy, ünd so it göes on änd on until the end of it."),
]
#: Names that the operators use inside.
CLASHING = ["_id", "_key", "_row", "row", "key", "id", "w", "n", "cid", "spans", "_text", "_bad", "_best", "pieces"]


@pytest.fixture(scope="session")
def edge_docs(spark):
    df = spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t)) for i, t in TEXTS],
                               "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(c) for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.filter("false")
