"""Mixing sources to target weights by soft membership.

1. A classifier (logistic regression on hashed TF-IDF words), fitted on at most
   ``max_labelled`` labelled rows, gives each document domain posteriors p.
2. Document rates w >= 0 minimise the squared distance between the expected
   domain token totals, sum of w * tokens * p over all documents, and their
   targets, by projected gradient from w = 1. The distance is measured in the
   metric of the posteriors' token-weighted second moments, for which the step
   length is known, and rounds carry momentum. A round is one pass over
   the small table of tokens and posteriors, which returns one total a domain;
   no vector of all documents ever exists in one place: a document's rate
   follows from its posteriors and the rounds' gradients.

Nulls and edges: null or empty texts have no tokens; they have rates (from
the posterior of an empty text) but add to no total; without labelled rows all
posteriors are equal, with one labelled domain it has posterior 1; domains
without a target have the target 0; duplicate labels of an id count once; an
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import THIN_ROWS, Batches, batch_of, batch_rows, solid

WORDS = "__words"
TRAIN_PARTS = 8            # partitions of the bounded training sample, read once in every round of the fit


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), "[ \\t\\n\\x0B\\f\\r]+"), "")


@dataclass
class Domains:
    names: list[str]
    model: PipelineModel | None

    def posteriors(self) -> tuple[list, Column]:
        """Transformers to apply, and the posterior array they lead to."""
        if self.model is None:
            return [], F.array(*(F.lit(1.0 / len(self.names)) for _ in self.names))
        return self.model.stages, vector_to_array("__posterior")


def fit_domains(docs: DataFrame, labels: DataFrame, domain: Column, names: list[str], id_col: str = "doc_id",
                text_col: str = "text", dims: int = 1 << 14, max_labelled: int = 3000, reg: float = 1e-4) -> Domains:
    """Fit on the labelled rows of least id hash. ``domain`` is an expression
    over ``labels`` that gives one of ``names`` (others and nulls are left out)."""
    number = F.expr("CASE __domain " + " ".join(f"WHEN '{n}' THEN {i}D" for i, n in enumerate(names)) + " END")
    chosen = (labels.select(F.col(id_col).cast("long").alias("__id"), domain.alias("__domain"))
              .select("__id", number.alias("__label")).where("__id IS NOT NULL AND __label IS NOT NULL")
              .groupBy("__id").agg(F.min("__label").alias("__label"))
              .orderBy(F.xxhash64("__id"), "__id").limit(max_labelled))
    # At most max_labelled pairs of numbers: a proven bound for the broadcast.
    train = solid(docs.select(F.col(id_col).cast("long").alias("__id"), words(F.col(text_col)).alias(WORDS))
                  .join(F.broadcast(chosen), "__id").select("__id", WORDS, "__label").repartition(TRAIN_PARTS), "mixing-train")
    seen = sorted(r[0] for r in train.select("__label").distinct().collect())
    if len(seen) < 2:
        return Domains(names if not seen else [names[int(seen[0])]], None)
    kept = [names[int(x)] for x in seen]
    train = train.withColumn("__label", F.array_position(F.array(*map(F.lit, seen)), F.col("__label")).cast("double") - 1)
    stages = [HashingTF(inputCol=WORDS, outputCol="__tf", numFeatures=dims)]
    stages.append(IDF(inputCol="__tf", outputCol="__idf").fit(stages[0].transform(train)))
    stages.append(Normalizer(inputCol="__idf", outputCol="__x"))
    ready = train
    for s in stages:
        ready = s.transform(ready)
    stages.append(LogisticRegression(featuresCol="__x", labelCol="__label", probabilityCol="__posterior", rawPredictionCol="__raw",
                                     predictionCol="__predicted", family="multinomial", regParam=reg, maxIter=40).fit(ready))
    return Domains(kept, PipelineModel(stages))


def with_posteriors(docs: DataFrame, domains: Domains, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__words``, ``__n`` (tokens) and ``__p`` (posteriors)."""
    made = docs.withColumn(WORDS, words(F.col(text_col)))
    stages, posterior = domains.posteriors()
    for s in stages:
        made = s.transform(made)
    return made.withColumn("__n", F.size(WORDS).cast("long")).withColumn("__p", posterior)


def fold(p: np.ndarray, steps: list[tuple[float, np.ndarray]]) -> np.ndarray:
    """Rates after ``steps``, each a momentum and a gradient."""
    w = before = np.ones(len(p))
    for momentum, g in steps:
        w, before = np.maximum(0.0, w + momentum * (w - before) - p @ g), w
    return w


def fit_rates(features: DataFrame, targets: np.ndarray, tol: float = 1e-6,
              max_rounds: int = 200) -> tuple[list[tuple[float, np.ndarray]], np.ndarray]:
    """Momentum and gradient of each round, and the totals reached. ``features``
    (written table): ``n``, ``p``. ``targets`` are token totals. Totals are
    linear in the rates, so those of a point ahead need no pass of their own;
    the momentum starts anew when the distance grows."""
    k = len(targets)
    schema = pa.schema([("at", pa.int32()), ("x", pa.float64())])

    def summed(of, size):
        def run(batches: Batches) -> Batches:
            total = np.zeros(size)
            for b in batches:
                if b.num_rows:
                    n = b.column("n").to_numpy().astype(float)
                    p = b.column("p").flatten().to_numpy().reshape(-1, k)
                    total += of(n, p)
            yield batch_of(schema, (np.arange(size, dtype=np.int32), total))
        out = np.zeros(size)
        with batch_rows(features.sparkSession, THIN_ROWS):
            got = features.select("n", "p").mapInArrow(run, "at int, x double").groupBy("at").agg(F.sum("x")).collect()
        for at, x in got:
            out[at] = x
        return out

    moments = summed(lambda n, p: ((p * n[:, None]).T @ p).ravel(), k * k).reshape(k, k)
    steps: list[tuple[float, np.ndarray]] = []
    inverse = np.linalg.pinv(moments, rcond=1e-12, hermitian=True)
    before, since, distance = None, 0, np.inf
    while True:
        totals = summed(lambda n, p, s=tuple(steps): p.T @ (n * fold(p, s)), k)
        miss = totals - targets
        if len(steps) >= max_rounds or np.abs(miss).sum() <= tol * max(1.0, targets.sum()):
            return steps, totals
        now = miss @ inverse @ miss
        since, distance = (0 if now > distance else since), now
        momentum = since / (since + 3)
        gradient = inverse @ (miss + momentum * (totals - (totals if before is None else before)))
        if steps and np.abs(gradient).max() < 1e-9:
            return steps, totals
        steps.append((momentum, gradient))
        before, since = totals, since + 1


def rate_column(steps: list[tuple[float, np.ndarray]], p: Column) -> Column:
    """The rate that ``fold`` gives, as an expression."""
    if not steps:
        return F.lit(1.0)
    row = lambda m, g: F.struct(F.lit(float(m)).alias("m"), F.array(*(F.lit(float(x)) for x in g)).alias("g"))
    dot = lambda g: F.aggregate(F.zip_with(p, g, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    state = lambda w, before: F.struct(w.alias("w"), before.alias("before"))
    return F.aggregate(
        F.array(*(row(m, g) for m, g in steps)), state(F.lit(1.0), F.lit(1.0)),
        lambda a, s: state(F.greatest(F.lit(0.0), a["w"] + s["m"] * (a["w"] - a["before"]) - dot(s["g"])), a["w"]),
        lambda a: a["w"])


def plan(docs: DataFrame, labels: DataFrame, domain: Column, shares: dict[str, float], id_col: str = "doc_id",
         text_col: str = "text", budget: float | None = None) -> tuple[Domains, list, DataFrame, np.ndarray, np.ndarray]:
    """Classifier, rounds, features (``doc_id``, ``n``, ``p``), targets and
    reached totals for token ``shares`` by domain; ``budget`` is the number of
    tokens wanted in all (default: as many as there are)."""
    domains = fit_domains(docs, labels, domain, sorted(shares), id_col, text_col)
    features = solid(with_posteriors(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("__text")),
                                     domains, "__text").select("doc_id", F.col("__n").alias("n"), F.col("__p").alias("p")), "mixing-features")
    wanted = np.array([shares[n] for n in domains.names], float)
    total = budget if budget is not None else float(features.agg(F.sum("n")).first()[0] or 0)
    targets = wanted / max(wanted.sum(), 1e-300) * total
    steps, totals = fit_rates(features, targets)
    return domains, steps, features, targets, totals


def apply_rates(docs: DataFrame, domains: Domains, steps: list[tuple[float, np.ndarray]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` as often as their rates say: the whole part of the
    rate, and once more where a hash of id and text falls under the rest."""
    names = docs.columns
    boxed = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("__text"),
                        F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string")).alias("__hash"))
    rated = with_posteriors(boxed, domains, "__text").select("row", "__hash", rate_column(steps, F.col("__p")).alias("__rate"))
    chance = F.pmod("__hash", F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = (F.floor("__rate") + (chance < F.col("__rate") - F.floor("__rate")).cast("int")).cast("int")
    return (rated.select("row", F.array_repeat(F.lit(0), copies).alias("__times"))
            .select("row", F.explode_outer("__times").alias("__once")).where("__once IS NOT NULL")
            .select(*(F.col(f"row.`{c}`") for c in names)))
