"""Texts are sanitized as a whole; the terms are those of their single pieces."""
import random

from pyspark.sql import functions as F

from spindle.functions.text import PUNCTUATION, explode_terms, is_term, sanitize, split_pieces

ODD = ["", " ", "'s", "''s's", "a's'sb", "it's\tIT'S", "x\u00a0y", "\x1fab\x1f \x01c d\x02e", "\x00\x00ab\x0b\x0cAB\r\nCd\x1d",
       "ΑΣ ΑΣ. ΑΣ'Α ΣΣ\nΣ", "İX Iı ẞß", "\U0001f600 \U0001f600\U0001f600 a", "!a! .b.c. well-known -- -", "\u2028ab\u0085cd", None]
ALPHABET = list(" \t\n\x0b\f\r\x00\x01\x1c\x1f'sSaAΣσß\u0307\u00ad\u00a0é-\U00010400") + list(PUNCTUATION)


def test_whole_texts_give_the_terms_of_their_pieces(spark):
    rng = random.Random(7)
    texts = ODD + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 40))) for _ in range(3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "title int, text string").repartition(4)
    piece = docs.select("title", F.explode(F.transform(split_pieces(F.col("text")), sanitize)).alias("term")).where(is_term(F.col("term")))
    made = explode_terms(docs)
    assert made.columns == ["title", "term"] and made.count() > 3000
    assert made.exceptAll(piece).count() == 0 and piece.exceptAll(made).count() == 0


def test_pieces_are_not_sanitized_one_by_one(spark):
    plan = explode_terms(spark.createDataFrame([("1", "a b")], "title string, text string"))._jdf.queryExecution().optimizedPlan().toString()
    assert "split(lower(translate(replace(text" in plan and "replace(lambda" not in plan and "replace(namedlambda" not in plan
