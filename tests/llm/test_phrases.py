import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from spindle.llm import phrases as P
from tests.llm.conftest import with_clashes

LOWER = {ord(a): a.lower() for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain(rows, least, most=5, top=2000):
    """The contract, phrase by phrase."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, most + 1):
                counts.setdefault(lang, Counter()).update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        good = {p: a for p, a in f.items() if len(p) >= 2 and a >= least}
        inside = lambda p, q: any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
        longer = {}
        for q, a in good.items():
            for i, j in itertools.combinations(range(len(q) + 1), 2):
                if j - i < len(q):
                    longer[q[i:j]] = max(longer.get(q[i:j], 0), a)
        found = []
        for p, a in good.items():
            if 100 * longer.get(p, 0) >= 100 * a:
                continue
            score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, totals[lang], -score))
        assert not found or inside(("a",), ("b", "a"))
    return sorted(out)


def mined(df, **how):
    return sorted(tuple(r)[:8] for r in P.collocations(df, **how).collect())


def test_transform_and_extension():
    """Every interval of every phrase, against counting, in both indexes."""
    rng = np.random.default_rng(4)
    text = rng.integers(0, 4, 400).astype(np.uint16)
    text[0] = text[-1] = 0
    depth = 5
    index = P.Index(P.transform(text, depth), P.transform(text[::-1], depth))
    runs = bytes(text.astype(np.uint8))
    n = np.bincount(text, minlength=4)
    low = np.cumsum(n) - n
    known = {int(i): bytes([i]) for i in range(1, 4)}
    now = (low[1:], low[1:], n[1:], np.arange(1, 4))
    for k in range(2, depth + 1):
        prefix, suffix, lo, rlo, size = index.extended(*now)
        made = [known[int(a)] + known[int(b)][-1:] for a, b in zip(prefix, suffix, strict=True)]
        want = Counter(runs[i:i + k] for i in range(len(runs) - k + 1) if 0 not in runs[i:i + k])
        assert dict(zip(made, size.tolist(), strict=True)) == want and len(made) == len(want)
        order = np.argsort(lo)
        known = {i + 1: made[j] for i, j in enumerate(order)}
        now = (lo[order], rlo[order], size[order], np.arange(1, len(made) + 1))


def test_thinned():
    cut = P.cut_at(np.array([0, 1, 2, 3, 4, 0, 5, 6, 7], np.uint16), np.array([0, 1, 0, 1, 0, 0, 0, 1, 0], bool))
    assert cut.tolist() == [0, 1, 2, 0, 3, 4, 0, 6, 7, 0]
    assert P.cut_at(np.array([0, 1, 2, 0], np.uint16), np.zeros(4, bool)).tolist() == [0]
    assert P.thinned(np.array([0, 1, 0, 0, 2, 3, 0, 4, 0, 5, 6, 7, 0, 0], np.uint16)).tolist() == [0, 2, 3, 0, 5, 6, 7, 0]
    assert P.thinned(np.array([0, 1, 0, 2, 0], np.uint16)).tolist() == []


@pytest.mark.parametrize("shard_words", [60, 100_000])
def test_against_a_plain_version(spark, shard_words):
    rng = random.Random(8)
    vocabulary = ["the", "of", "Über", "a", "xx", "Yy", "été", "日本", "q r"] + [f"w{i}" for i in range(30)]
    phrases = [["new", "york", "city"], ["in", "the", "same", "way", "as"], ["the", "of"]]
    rows = []
    for i in range(240):
        words = []
        while len(words) < 40:
            words += rng.choice(phrases) if rng.random() < 0.3 else [rng.choice(vocabulary[:6] if rng.random() < 0.5 else vocabulary)]
        text = "".join(w + rng.choice([" ", " ", " ", " ", "\t ", ". ", ",", "\n", " ;"]) for w in words)
        rows.append((rng.choice(["en", "en", "de", None, "und"]), text))
    rows += rows[:20] + [("fr", None), ("fr", ""), (None, " \t.;"), ("xx", "one two"), ("de", "loop " * 300)]
    df = with_clashes(spark.createDataFrame(rows, "lang string, text string").repartition(5))
    for least in (3, 20):
        want = plain(rows, least)
        assert want and mined(df, least=least, shard_words=shard_words) == want
    assert mined(df, least=20, top=3, shard_words=shard_words) == plain(rows, 20, top=3)


def test_least_of_one_and_two_words(spark):
    rows = [("en", "a b c. b c"), ("en", "c a B C")]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert mined(df, least=1, most_words=2) == plain(rows, 1, 2)
    assert mined(df, least=1) == plain(rows, 1)


def test_large_counts_are_exact(spark):
    """Products that pass 64 bits, against Python's whole numbers."""
    rng = random.Random(1)
    rows = []
    for i in range(300):
        k, a, n = rng.randint(2, 5), rng.randint(100, 10 ** rng.randint(3, 12)), 10 ** rng.randint(12, 15) + rng.randint(0, 999)
        heads, tails = ([a + rng.randint(0, 10 ** rng.randint(0, 14)) for _ in range(k - 1)] + [a] for _ in range(2))
        rows.append((i, heads, tails, a, n))
    df = spark.createDataFrame(rows, "i long, heads array<long>, tails array<long>, f long, total long")
    got = {r.i: (r.score, r.cut, r.l, r.r) for r in df.select("i", P.best_cut(df["total"]).alias("b")).select("i", "b.*").collect()}
    for i, heads, tails, a, n in rows:
        want = min((1000 * a * n // (heads[c - 1] * tails[len(heads) - c - 1]), c, heads[c - 1], tails[len(heads) - c - 1]) for c in range(1, len(heads)))
        assert got[i] == want


def test_edges(spark, edge_docs, no_docs):
    rows = [(r.lang, r.text) for r in edge_docs.select("lang", "text").collect()]
    assert mined(edge_docs, least=2, shard_words=50) == plain(rows, 2)
    assert mined(no_docs) == []
    assert mined(edge_docs, least=10 ** 6) == []
    with pytest.raises(ValueError):
        P.collocations(edge_docs, most_words=1)


def test_frequent_pairs_are_one_packed_row_a_shard():
    """Rows grow with the shards of a bucket, not with the pairs that are frequent."""
    own = [np.array(x, np.int64) for x in ([-2 ** 62, -5, 7, 2 ** 62], [-5, 7, 9], [9])]
    table = pa.Table.from_batches([P.batch_of(P.PAIRS_ARROW, ([0] * 3, [4, 5, 6], [P.packed(np.diff(x, prepend=0)) for x in own],
                                                              [P.packed(np.array(n, np.int32)) for n in ([3, 2, 1, 9], [1, 1, 1], [1])]))])
    for least, want in ((3, {4: [-2 ** 62, -5, 2 ** 62], 5: [-5]}), (1, {s: x.tolist() for s, x in zip((4, 5, 6), own, strict=True)}), (10, {})):
        rows = P.frequent_pairs(least)(table).to_pylist()
        assert {r["shard"]: np.cumsum(P.unpacked(r["pairs"], np.int64)).tolist() for r in rows} == want and len(rows) == len(want)


def test_tables_between_levels_are_dropped(spark, monkeypatch):
    made, gone = [], []
    whole, dropping = P.solid, P.drop_scratch
    monkeypatch.setattr(P, "solid", lambda df, name, *a: made.append(name) or whole(df, name, *a))
    monkeypatch.setattr(P, "drop_scratch", lambda s, *paths: gone.extend(x.rpartition("/")[2].rpartition("-")[0] for x in paths) or dropping(s, *paths))
    rows = [("en", "a b c a b c a b. c a b")] * 5
    assert mined(spark.createDataFrame(rows, "lang string, text string"), least=3) == plain(rows, 3)
    assert sorted(set(made) - set(gone)) == ["phrases-1", "phrases-2", "phrases-3", "phrases-4", "phrases-5", "phrases-totals"]


def test_shuffle_files_go_with_each_table(spark):
    from spindle.session import CLEANUP_CONF, scratch_path, shuffles_dropped
    tracker, before = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker(), spark.conf.get(CLEANUP_CONF, None)
    numbers = spark.range(100).repartition(4, "id")
    with shuffles_dropped(spark):
        known = set(str(tracker.shuffleStatuses().keySet().mkString(" ")).split())
        numbers.write.parquet(scratch_path(spark, "numbers"))
        assert set(str(tracker.shuffleStatuses().keySet().mkString(" ")).split()) <= known
    assert spark.conf.get(CLEANUP_CONF, None) == before
