"""Tokenizer table: each input is one whitespace-free piece."""

import pytest
from pyspark.sql import functions as F

from spindle.functions.text import is_term, sanitize, tokens

CASES = [
    ("it's", "it", True),
    ("IT'S", "it s", True),
    ("'salt", "alt", True),
    ("O'sullivan", "o ullivan", True),
    ("foo,bar", "foo bar", True),
    ("don't", "don t", True),
    ("a_b", "a b", True),
    ("a.b.c", "a b c", True),
    ("well-known", "well-known", True),
    ("--", "--", True),
    ("-x", "-x", True),
    ("--'s", "--", True),
    ("-", "-", False),
    ("a", "a", False),
    ("(A)", "a", False),
    ("$5", "5", False),
    ("...", "", False),
    ("Álvares", "álvares", True),
    ("“quoted”", "“quoted”", True),
    ("¿que?", "¿que", True),
    ("x y", "x y", True),
    ("\u001fab\u001f", "ab", True),
    # One supplementary character is two UTF-16 units: kept, as in Java.
    ("\U0001F600", "\U0001F600", True),
    ("ΣΣ", "σς", True),
]


def test_sanitize_table(spark):
    df = spark.createDataFrame([(c,) for c, _, _ in CASES], "piece string")
    got = df.select("piece", sanitize(F.col("piece")).alias("s")).collect()
    out = {r.piece: r.s for r in got}
    for piece, expected, _ in CASES:
        assert out[piece] == expected, piece


def test_keep_table(spark):
    df = spark.createDataFrame([(c,) for c, _, _ in CASES], "piece string")
    got = df.select("piece", is_term(sanitize(F.col("piece"))).alias("k")).collect()
    out = {r.piece: r.k for r in got}
    for piece, _, keep in CASES:
        assert out[piece] == keep, piece


def test_split_then_sanitize(spark):
    row = spark.range(1).select(tokens(F.lit("Hello,World  it's\tthe CAT'S a-b (x)")).alias("t")).first()
    assert row.t == ["hello world", "it", "the", "cat s", "a-b"]


@pytest.mark.parametrize("text", [None, "", "   ", "! ? ."])
def test_no_terms(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(tokens(F.col("t")).alias("x")).first()
    assert (row.x or []) == []
