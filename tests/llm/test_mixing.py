import numpy as np
from pyspark.sql import functions as F

from spindle.llm import mixing as M
from spindle.llm.common import table
from spindle.llm.queries import DOMAIN, SHARES
from tests.llm.conftest import SMALL


def plain_rates(n, p, targets, rounds=3000):
    """The same least squares by plain projected gradient, many small steps."""
    metric = np.linalg.pinv((p * n[:, None]).T @ p)
    w = np.ones(len(n))
    for _ in range(rounds):
        w = np.maximum(0, w - p @ (metric @ (p.T @ (n * w) - targets)))
    return w


def test_rates_reach_reachable_targets(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.3, 0.3, 0.3], 500)
    n = rng.integers(1, 2000, 500)
    df = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p, strict=True)], "n long, p array<double>").repartition(5)
    totals = p.T @ n
    for share in ([0.5, 0.3, 0.2], [0.9, 0.08, 0.02], [0.2, 0.2, 0.6]):
        targets = np.array(share) * totals.sum()
        steps, reached = M.fit_rates(df, targets)
        w = M.fold(p, steps)
        assert (w >= 0).all() and np.abs(reached - targets).sum() < 1e-5 * targets.sum()
        assert np.allclose(p.T @ (n * w), reached)
        got = {(r.n, tuple(r.p)): r.w for r in df.select("n", "p", M.rate_column(steps, F.col("p")).alias("w")).collect()}
        assert all(abs(got[int(a), tuple(b)] - x) < 1e-9 for a, b, x in zip(n, p, w, strict=True))


def test_rates_of_unreachable_targets_are_least_squares(spark):
    p = np.array([[0.6, 0.4], [0.5, 0.5], [0.7, 0.3]] * 20)
    n = np.arange(1, 61)
    df = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p, strict=True)], "n long, p array<double>")
    targets = np.array([0.95, 0.05]) * n.sum()
    steps, reached = M.fit_rates(df, targets, max_rounds=300)
    w = M.fold(p, steps)
    want = plain_rates(n, p, targets)
    metric = np.linalg.pinv((p * n[:, None]).T @ p)
    cost = lambda x: (p.T @ (n * x) - targets) @ metric @ (p.T @ (n * x) - targets)
    assert (w >= 0).all() and cost(w) <= cost(want) * 1.01 + 1e-9 and cost(w) < cost(np.ones(60))


def test_whole_table(spark, small_docs):
    labels = table(spark, SMALL, "labels")
    domains, steps, features, targets, totals = M.plan(small_docs, labels, F.expr(DOMAIN), SHARES)
    rows = features.select("doc_id", "n", "p", M.rate_column(steps, F.col("p")).alias("w")).collect()
    assert len(rows) == small_docs.count()
    n, p, w = (np.array([r[c] for r in rows]) for c in ("n", "p", "w"))
    assert np.allclose(p.sum(1), 1) and (w >= 0).all()
    assert np.allclose(p.T @ (n * w), totals)
    if np.abs(totals - targets).sum() > 1e-5 * targets.sum():
        assert np.abs(totals - targets).sum() < np.abs(p.T @ n - targets).sum()
    kept = M.apply_rates(small_docs, domains, steps)
    assert kept.columns == small_docs.columns
    times = {r.doc_id: r["count"] for r in kept.groupBy("doc_id").count().collect()}
    assert all(times.get(r.doc_id, 0) in (int(r.w), int(r.w) + 1) for r in rows)


def test_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (6, 0, 0), (7, 0, 1), (None, 1, 0), (8, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int")
    domains, steps, features, *_ = M.plan(edge_docs, labels, F.expr(DOMAIN), SHARES)
    assert features.count() == edge_docs.count()
    assert M.apply_rates(edge_docs, domains, steps).columns == edge_docs.columns
    for some in (labels.limit(0), labels.where("doc_id = 1")):
        domains, steps, features, *_ = M.plan(edge_docs, some, F.expr(DOMAIN), SHARES)
        assert domains.model is None and features.count() == edge_docs.count()
        assert M.apply_rates(edge_docs, domains, steps).count() > 0
    domains, steps, features, *_ = M.plan(no_docs, labels, F.expr(DOMAIN), SHARES)
    assert features.count() == 0 and M.apply_rates(no_docs, domains, steps).count() == 0
