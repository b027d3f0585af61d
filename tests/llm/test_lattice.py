import math
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from spindle.llm import lattice as L
from spindle.llm.common import crc_of_id
from tests.llm.conftest import EDGE_ROWS

UNITS = [b"\xe2\x96\x81", b"\xe2\x96\x81a", b"a", b"b", b"ab", b"abc", b"c", b"\xe2", b"\x96", b"\x81", b"bc"]


def every_segmentation(text, weight):
    """Sum over all segmentations, by plain recursion."""
    @lru_cache(None)
    def of(at):
        if at == len(text):
            return 1.0
        return sum(w * of(at + len(u)) for u, w in weight.items() if text.startswith(u, at))
    return of(0)


@pytest.fixture(scope="module")
def weights():
    rng = np.random.default_rng(4)
    w = rng.dirichlet(np.ones(len(UNITS)))
    return dict(zip(UNITS, w.tolist(), strict=True)), np.append(np.log(w), -np.inf)[None, :]


WORDS = [b"", b"a", b"ab", b"abc", b"cab", b"abcabcab", b"bb", b"aaaa", b"cba" * 9]


def test_forward_sums_all_segmentations(weights):
    weight, logp = weights
    got = L.word_scores(L.Units(UNITS), logp, WORDS)[:, 0]
    for w, s in zip(WORDS, got, strict=True):
        assert s == pytest.approx(math.log(every_segmentation(L.MARK + w, weight)), rel=1e-9)


def test_long_words_are_scored_in_chunks(weights, monkeypatch):
    weight, logp = weights
    word = b"abcab" * 60
    want = L.word_scores(L.Units(UNITS), logp, [word])[0, 0]
    finder = L.Units(UNITS)
    monkeypatch.setattr(L, "CELLS", 4 * len(finder.lengths) * 11)
    assert L.long_word(finder, logp[0], L.MARK + word) == pytest.approx(want, rel=1e-12)
    assert L.word_scores(finder, logp, [word])[0, 0] == pytest.approx(want, rel=1e-12)


def test_expected_units_are_the_gradient(weights):
    weight, logp = weights
    total = np.zeros((1, len(UNITS)))
    L.expected_units(L.Units(UNITS), logp, [b"abcab"], np.ones((1, 1), bool), total)
    text, eps = L.MARK + b"abcab", 1e-6
    for k, u in enumerate(UNITS):
        up = dict(weight, **{}) | {u: weight[u] * (1 + eps)}
        slope = (math.log(every_segmentation(text, up)) - math.log(every_segmentation(text, weight))) / eps
        assert total[0, k] == pytest.approx(slope, abs=1e-4)


def test_vocabulary_is_found():
    units, start = L.read_units(L.VOCABULARY)
    finder = L.Units(units)
    assert abs(start.sum() - 1) < 1e-9 and len(units) > 20_000
    for u in units[::997] + [b"\x00", b"\xff"]:
        assert finder.find(finder.sums(np.frombuffer(b"zz" + u, np.uint8)), np.array([2]), len(u))[0] == units.index(u)


def test_whole_table(spark, small_docs):
    held_out = crc_of_id() % 5 == 1
    rows = {r.doc_id: r for r in L.score(small_docs, held_out=held_out, class_col="lang").collect()}
    texts = {r.doc_id: (r.text or "").encode().lower().split() + [b""] for r in small_docs.collect()}
    out = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    c = Counter(w for i, ws in texts.items() if not out[i] for w in ws)
    n, v = sum(c.values()), len(c)
    assert set(rows) == set(texts)
    for i, ws in texts.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[i], len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), rel=1e-9)
        assert r.score < 0
    # Without a head, all words go through the join; the scores stay.
    tail = {r.doc_id: r for r in L.score(small_docs, held_out=held_out, class_col="lang", max_head=0).collect()}
    assert all(tail[i].score == pytest.approx(rows[i].score, rel=1e-9) and tail[i].n_known == rows[i].n_known for i in rows)


def test_probabilities_sum_to_one_at_most(spark):
    """All one-word texts over a tiny alphabet, under a model trained on some."""
    docs = spark.createDataFrame([(1, "a"), (2, "b a"), (3, "ab")], "doc_id long, text string")
    model = L.fit(L.count_words(docs, "text", F.lit(True), F.lit(0), 1), 1)
    finder = L.Units(model.units)
    words = [b"a", b"b", b"ab", b"ba", b"aa", b"bb"]
    counts = np.array([[2], [1], [1], [0], [0], [0]])
    s = model.whole(counts, (L.word_scores(finder, model.logp, words) + model.stop) / math.log(10), 0.5)
    assert (10 ** s).sum() + model.ends()[0] < 1 + 1e-9
    assert (10 ** s[:3]).sum() > 0.3


def test_edges(spark, edge_docs, no_docs):
    held_out = crc_of_id() % 5 == 1
    got = L.score(edge_docs, held_out=held_out, class_col="lang").collect()
    assert len(got) == len(EDGE_ROWS)
    assert sorted(r.n_tokens for r in got) == sorted(len((t or "").encode().split()) + 1 for _, t, *_ in EDGE_ROWS)
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) and r.score < 0 for r in got)
    assert L.score(no_docs, held_out=held_out, class_col="lang").collect() == []
    unlearnt = L.score(edge_docs, held_out=F.lit(True)).collect()
    assert len(unlearnt) == len(EDGE_ROWS) and all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in unlearnt)
    many = L.score(edge_docs, held_out=F.lit(False), class_col="doc_id", max_classes=2).collect()
    assert len(many) == len(EDGE_ROWS) and all(math.isfinite(r.score) for r in many)
