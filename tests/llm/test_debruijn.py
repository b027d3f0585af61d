import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from spindle.llm import debruijn as D


def plain(rows, width):
    """Windows as tuples, least id of each."""
    words = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, w in words:
        if i is not None:
            for j in range(len(w) - width + 1):
                k = tuple(w[j:j + width])
                least[k] = min(least.get(k, i), i)
    out = []
    for i, w in words:
        gone = set()
        if i is not None:
            for j in range(len(w) - width + 1):
                if least[tuple(w[j:j + width])] < i:
                    gone.update(range(j, j + width))
        kept = [x for j, x in enumerate(w) if j not in gone]
        out.append((i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


def run(df, **how):
    return sorted((tuple(r)[:4] for r in D.remove_repeats(df, **how).collect()), key=str)


def test_shared_passages_with_every_overlap(spark):
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(400)}"
    passages = [[word() for _ in range(n)] for n in (9, 10, 11, 14, 25, 40)]
    rows = []
    for i in range(120):
        text = [word() for _ in range(rng.randrange(0, 30))]
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            a = rng.randrange(0, 3)
            text += p[a:len(p) - rng.randrange(0, 3)] + [word() for _ in range(rng.randrange(0, 6))]
        rows.append((rng.randrange(100), " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for width, k in ((10, 3), (10, 9), (12, 4)):
        assert run(df, width=width, k=k) == plain(rows, width)


def test_whole_table_against_a_plain_version(small_docs):
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    assert run(small_docs) == plain(rows, 50)
    assert run(small_docs, width=20, k=6) == plain(rows, 20)


def test_edges(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert run(edge_docs) == plain(rows, 50)
    assert run(edge_docs, width=5, k=2) == plain(rows, 5)
    assert run(no_docs) == []


def test_spans_are_the_removed_words(spark):
    text = " ".join(f"w{i}" for i in range(80))
    df = spark.createDataFrame([(1, text), (2, f"a b c {text} d e")], "doc_id long, text string")
    got = {r.doc_id: r for r in D.remove_repeats(df).collect()}
    assert got[1].spans == [] and [(s.start, s.end) for s in got[2].spans] == [(3, 83)]


def test_rolling_digests_depend_on_content_alone():
    words = [f"w{i % 7}".encode() for i in range(100)]
    a, _ = D.rollings(words, D.Powers())
    b, _ = D.rollings([b"x"] * 13 + words, D.Powers())
    at = np.arange(60)
    assert (a.spans(at, at + 30) == b.spans(at + 13, at + 43)).all()
    assert len(set(a.spans(at, at + 30).tolist())) == 7


def test_a_text_of_many_chunks(spark):
    long = " ".join(f"w{i % 9973}" for i in range(150_000))
    df = spark.createDataFrame([(1, long), (2, long + " end"), (3, "start " + long)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.n_removed for r in D.remove_repeats(df).collect()}
    assert got == {1: 0, 2: 150_000, 3: 150_000}
    assert df.where(F.length("text") > 0).count() == 3


def test_a_hot_path_is_dealt_out(spark):
    """4,000 near copies of one text: more occurrences of each path than a partition's share."""
    text = " ".join(f"w{i}" for i in range(70))
    rows = [(i, f"{text} tail{i % 3}") for i in range(4_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert run(df) == plain(rows, 50)
