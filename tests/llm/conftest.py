import pytest

from spindle.llm.common import table

SMALL = "/root/testdata/sf0.001"

# Names that the operators use inside; as columns of the input they must not matter.
CLASHES = ("fp", "key", "row", "word", "part", "th", "node", "path", "did", "hits", "score", "rejected", "rate",
           "shard", "slot", "id", "text_hash", "__id", "__th", "__text", "__hash", "h", "doc", "h1", "listed", "c0", "n", "p", "license", "train", "kind")


def with_clashes(df):
    from pyspark.sql import functions as F
    return df.select("*", *(F.lit(f"clash {c}").alias(c) for c in CLASHES))


@pytest.fixture(scope="session")
def small_docs(spark):
    return table(spark, SMALL, "documents")


EDGE_ROWS = [
    (1, "The quick brown fox jumps over the lazy dog. It runs away.", "en", "a", 10),
    (1, "The quick brown fox jumps over the lazy dog. It runs away.", "en", "a", 10),      # repeated row
    (1, "Another text under the same id, with words of its own here.", "en", "a", 10),     # repeated id
    (2, None, "en", None, None),
    (3, "", None, "b", 0),
    (None, "A text without an id, in plain words that go on for a while.", "en", None, 5),
    (None, None, None, None, None),
    (4, " \t\n\r\x0b\x0c ", "fr", "b", 3),
    (5, "12345 67890 !!! ??? ...", None, "b", 3),
    (6, "Le renard brun saute par-dessus le chien paresseux. Élève, où êtes-vous ?", "fr", "c", 4),
    (7, "x" * 30_000, "en", "c", 30_000),
    (8, "word " * 40_000, "en", "c", 200_000),
    (9, "\U0001F600 \U0001F600 ça va 日本語 テスト", None, "c", 12),
    (-5, "The quick brown fox jumps over the lazy dog. It runs away.", "en", "a", 10),     # copy, negative id
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def edge_docs(spark):
    return with_clashes(spark.createDataFrame(EDGE_ROWS, SCHEMA))


@pytest.fixture()
def no_docs(spark):
    return with_clashes(spark.createDataFrame([], SCHEMA))
