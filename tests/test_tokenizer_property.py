"""Property: the Spark tokenizer equals a plain-Python one written from the
rules (split on each of the six \\s characters; possessive and ASCII
punctuation except '-' to a space; trim U+0000..U+0020; lowercase; keep
when longer than one UTF-16 unit)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spindle.functions.text import tokens

SPLIT = re.compile(r"[ \t\n\x0b\x0c\r]")
PUNCT = re.compile(r"('s)|([!-,./:-@\[-`{-~])")
TRIM = "".join(chr(c) for c in range(0x21))


def py_tokens(text):
    out = []
    for piece in SPLIT.split(text):
        t = PUNCT.sub(" ", piece).strip(TRIM).lower()
        if len(t.encode("utf-16-le")) // 2 > 1:
            out.append(t)
    return out


# Letters whose lowercase is the same in Java and Python, plus the
# characters the rules treat specially.
ALPHABET = (list("abcXYZsS019-'") + list("!\"#$%&()*+,./:;<=>?@[\\]^_`{|}~")
            + [" ", "\t", "\n", "\x0b", "\x0c", "\r", "\x00", "\x1f", "\xa0"]
            + list("éÉßçøΣσ“”¿") + ["\U0001F600"])

texts = st.lists(st.text(alphabet=ALPHABET, max_size=30), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batch=texts)
def test_tokens_match_python_rules(spark, batch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "i int, t string")
    got = {r.i: list(r.x) for r in df.select("i", tokens(F.col("t")).alias("x")).collect()}
    for i, t in enumerate(batch):
        assert got[i] == py_tokens(t), repr(t)
