import math

import numpy as np
import pytest

from spindle.llm import whitening as W
from spindle.llm.common import table
from spindle.llm.queries import queries
from tests.llm.conftest import SMALL, with_clashes


@pytest.mark.parametrize("case", ["plain", "repeated", "zero weights", "from nothing", "one", "tiny gaps"])
def test_rank_one_update(case):
    rng = np.random.default_rng(3)
    d = 1 if case == "one" else 12
    q, _ = np.linalg.qr(rng.normal(size=(d, d)))
    values = np.sort(rng.random(d) * 10)
    v = rng.normal(size=d)
    if case == "repeated":
        values[3:8] = values[3]
    if case == "zero weights":
        v = q[:, 4] * 3 + q[:, 7]
    if case == "from nothing":
        values[:] = 0
    if case == "tiny gaps":
        values[4:7] = values[4] * (1 + np.array([0, 1e-15, 1e-9]))
    want = q @ np.diag(values) @ q.T + 2.5 * np.outer(v, v)
    got, vectors = W.updated(values, q, v, 2.5)
    assert np.allclose(vectors.T @ vectors, np.eye(d), atol=1e-13)
    assert np.allclose(vectors @ np.diag(got) @ vectors.T, want, atol=1e-12)
    assert np.allclose(got, np.linalg.eigvalsh(want), atol=1e-12) and (np.diff(got) >= 0).all()


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_spectra_of_blocks_and_their_sum(block):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 6)) @ np.diag([9, 5, 3, 1, 1, 0]) + 1000
    x[100:200] = x[0]                                     # copies
    parts = [W.Spectrum.empty(6) for _ in range(3)]
    for s, rows in zip(parts, np.split(x, 3), strict=True):
        for at in range(0, 100, block):
            s.add_block(rows[at:at + block])
    parts[0].add_spectrum(parts[1])
    parts[0].add_spectrum(parts[2])
    scatter = np.cov(x.T, bias=True) * 300
    assert parts[0].n == 300 and np.allclose(parts[0].mean, x.mean(0))
    assert np.allclose(parts[0].vectors @ np.diag(parts[0].values) @ parts[0].vectors.T, scatter, atol=1e-8)


def check(rows, source, components=8):
    """Held against numpy's covariance and eigenvectors, and Python's numbers."""
    kept = [(i, v) for i, v in source if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in kept], dtype=np.int64)
    n, s = len(x), x.sum(0)
    by = {}
    for r in rows:
        by.setdefault((r.vec_id, r.component), []).append(r)
    k = min(components, x.shape[1])
    assert sum(map(len, by.values())) == n * k
    centred = (x * n - s) / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    for c in range(k):
        own = centred @ vectors[:, c] / np.sqrt(values[c])
        signs = set()
        for row, (vec_id, _) in enumerate(kept):
            r = by[vec_id, c + 1][0]
            assert r.n == n and r.deviation == sum(int(n * int(a) - int(b)) ** 2 for a, b in zip(x[row], s, strict=True))
            assert str(r.deviation) == r.deviation_text
            assert abs(r.explained - values[c] / values.sum()) < 1e-9 and r.identity_error < 1e-9
            if abs(own[row]) > 1e-6:
                signs.add(round(r.whitened / own[row], 6))
        assert signs in ({1.0}, {-1.0})


def test_query_against_numpy(spark):
    source = [(r.vec_id, r.embedding) for r in table(spark, SMALL, "embeddings").collect()]
    check(queries()["op11_embedding_whitening"](spark, SMALL).collect(), source)


def test_edges(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=4) * [4, 3, 2, 1]]) for i in range(40)]
    rows += [(3, rows[3][1]), (None, rows[5][1])]                       # repeated row, null id
    bad = [(90, None), (91, [1.0, None, 2.0, 3.0]), (92, [1.0, math.nan, 2.0, 3.0]), (93, [math.inf, 0.0, 0.0, 0.0]), (94, []), (95, [1.0, 2.0])]
    schema = "vec_id long, embedding array<float>"
    df = with_clashes(spark.createDataFrame(rows + bad, schema)).repartition(5)
    check(W.whiten(df, block=3).collect(), rows)
    assert W.whiten(df.limit(0)).collect() == []
    assert W.whiten(spark.createDataFrame(bad[:5], schema)).collect() == []
    flat = W.whiten(spark.createDataFrame([(1, [2.0, 1.0]), (2, [2.0, 3.0])], schema)).collect()
    assert sorted((r.vec_id, r.component, r.whitened is None, r.explained) for r in flat) == [
        (1, 1, False, 1.0), (1, 2, True, 0.0), (2, 1, False, 1.0), (2, 2, True, 0.0)]
    one = W.whiten(spark.createDataFrame([(1, [2.0, 1.0])], schema)).collect()
    assert [(r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(0, None, 0.0, 0.0)] * 2


def test_deviations_beyond_64_bits(spark):
    rows = [(i, [(-1.0) ** i * 3e9 + i, 1.0 * i]) for i in range(50)]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).where("component = 1").collect()
    x = [[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows]
    s = [sum(c) for c in zip(*x, strict=True)]
    want = {i: sum((50 * a - b) ** 2 for a, b in zip(v, s, strict=True)) for i, v in enumerate(x)}
    assert {r.vec_id: int(r.deviation_text) for r in got} == want
    assert all(r.deviation == (want[r.vec_id] if want[r.vec_id] < 1 << 63 else None) for r in got)
    assert W.whiten(spark.createDataFrame([(1, [3e38, 1.0]), (2, [-3e38, 2.0])], "vec_id long, embedding array<float>")).count() == 4
