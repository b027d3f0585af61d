import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from spindle.llm import quality as Q
from spindle.llm.common import crc_of_id, table
from spindle.llm.queries import queries
from tests.llm.conftest import SMALL, with_clashes

ORACLE = "/root/testdata/sf0.01"


def test_shapes():
    words = ["the", "The", "THE", "tHe", "42", "A", "é", "É", "日本", "!!", "***"]
    assert [Q.shape(w) for w in words][:9] == [Q.LOWER, Q.CAPITAL, Q.UPPER, Q.MIXED, Q.DIGITS, Q.CAPITAL, Q.LOWER, Q.CAPITAL, Q.LOWER]
    assert Q.shape("!!") != Q.shape("***") and 5 <= Q.shape("!!") < 256


def plain_places(text, dims):
    """The same n-grams with Python's whole numbers."""
    words = re.findall(r"[^\W\d_]+|\d+|[^\w\s]+|_+", text)
    h, s = [zlib.crc32(w.encode()) for w in words], [Q.shape(w) for w in words]
    grams = list(h) + [((a * 0x9E3779B1 + b) % 2 ** 64) ^ (1 << 40) for a, b in zip(h, h[1:])]
    grams += [(a * 256 + b) + (2 << 40) for a, b in zip(s, s[1:])] + [a * 65536 + b * 256 + c + (3 << 40) for a, b, c in zip(s, s[1:], s[2:])]
    grams += [4 << 40 for a, b in zip(h, h[1:]) if a == b]
    return [(g * 0x9E3779B97F4A7C15) % 2 ** 64 * dims >> 64 for g in grams]


def test_places_against_plain_numbers():
    for text in ["The the THE  the 12 12, and!! été", "one", "", " \n", "x y z " * 50]:
        assert Q.places(text, Q.Codes(), 1 << 14).tolist() == plain_places(text, 1 << 14)
    long = "some words, here and there. " * 80_000                     # beyond one piece
    assert len(long) > 2 * Q.PIECE
    assert Q.places(long, Q.Codes(), 1 << 14).tolist() == plain_places(long, 1 << 14)


def test_updates_against_the_formula():
    """One coordinate at a time, as FTRL-proximal is written."""
    rng, dims = np.random.default_rng(2), 20
    state = Q.Ftrl(np.zeros(dims + 1), np.zeros(dims + 1), 0.3, 1.0, 0.05, 0.05)
    z, n = [0.0] * (dims + 1), [0.0] * (dims + 1)
    weight = lambda i: 0.0 if abs(z[i]) <= 0.05 else -(z[i] - math.copysign(0.05, z[i])) / ((1 + math.sqrt(n[i])) / 0.3 + 0.05)
    for _ in range(200):
        at = np.sort(rng.choice(dims, 5, replace=False))
        x, label = rng.random(5) * 3, int(rng.random() < 0.7)
        at, x = np.append(at, dims), np.append(x, 1.0)
        w = {int(i): weight(i) for i in at}
        p = 1 / (1 + math.exp(-sum(w[int(i)] * v for i, v in zip(at, x, strict=True))))
        for i, v in zip(at.tolist(), x, strict=True):
            g = (p - label) * v
            sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 0.3
            z[i] += g - sigma * w[i]
            n[i] += g * g
        state.learn(at, x, label)
    assert np.allclose(state.z, z) and np.allclose(state.n, n)
    assert np.allclose(state.weights(), [weight(i) for i in range(dims + 1)])


def test_held_out_quality(spark):
    rows = queries()["op12_quality_classifier"](spark, ORACLE).collect()
    known = {r.doc_id: r.quality for r in table(spark, ORACLE, "labels").collect()}
    assert len(rows) == table(spark, ORACLE, "documents").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [(r.predicted, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    for label in (0, 1):
        own = [p == y for p, y in held if y == label]
        assert len(own) > 10 and np.mean(own) >= 0.95


def test_scores_depend_on_the_text_alone(spark, small_docs):
    """The model's score of each text, computed without Spark; labels of held
    out rows, language, source and id change nothing."""
    held = crc_of_id() % 3 == 1
    labels = table(spark, SMALL, "labels")
    model = Q.fit(small_docs.where(~held), labels, F.col("quality"))
    want = {r.doc_id: model.score(r.text, Q.Codes()) for r in small_docs.collect()}
    got = {r.doc_id: r.score for r in Q.score(small_docs, model, "text", F.col("doc_id")).collect()}
    assert got == want
    other = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality"))).withColumn("toxic", F.lit(0))
    again = Q.fit(small_docs.where(~held).withColumns({"lang": F.lit("xx"), "source": F.lit("s")}), other, F.col("quality"))
    assert np.array_equal(model.weights, again.weights)


def test_edges(spark, edge_docs, no_docs):
    labels = with_clashes(spark.createDataFrame([(1, 1), (1, 1), (4, 0), (5, 0), (6, 1), (7, 2), (8, None), (None, 0), (6, 0), (77, 1)], "doc_id long, quality int"))
    known = {r.id: r.label for r in Q.labelled(labels, F.col("quality"), "doc_id").collect()}
    assert known == {1: 1, 4: 0, 5: 0, 6: 1, 77: 1}
    for found in (labels, labels.limit(0)):
        model = Q.fit(edge_docs, found, F.col("quality"), dims=1 << 10)
        rows = Q.score(edge_docs, model, "text", F.col("doc_id"), F.col("score").alias("own")).collect()
        assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
        if found is not labels:
            assert {r.score for r in rows} == {0.5} and {r.predicted for r in rows} == {1}
    assert Q.score(no_docs, Q.fit(no_docs, labels, F.col("quality"), dims=1 << 10), "text", F.col("doc_id")).collect() == []
    # A hot id: its rows are counted, not its id alone.
    hot = spark.createDataFrame([(1, f"word{i} again") for i in range(300)] + [(4, "!! !! !!")] * 300, "doc_id long, text string")
    assert Q.fit(hot, labels, F.col("quality"), dims=1 << 10, max_train=50).weights.any()
