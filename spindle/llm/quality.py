"""Quality classifier: logistic regression on hashed word n-grams, trained by
follow-the-regularised-leader.

Features. A text is cut into words (runs of letters, of digits, and of anything
else that is not white space). Its n-grams are hashed into ``dims`` places:
words, pairs of neighbours, and pairs and triples of neighbours' shapes (lower,
Capitalised, UPPER, mixed, digits, the mark itself), and one place counts words
that repeat the one before. A place's value is its count by all n-grams of the
text, so a text of any length has values that sum to 1, times SCALE.

Training. FTRL-proximal: each coordinate keeps z and n, and its weight is 0
where |z| <= l1, else -(z - sign(z) l1) / ((beta + sqrt n) / alpha + l2). The
classifier is fitted on a bounded sample: the ``max_train`` different labelled
(id, text) of least hash. Their n-gram counts are written in ``shards`` parts; in
each of ``epochs`` rounds every task that reads a part runs through it, update by
update, from the common z and n, and the tasks' changes are averaged. What
reaches the driver is bounded by ``shards`` and ``dims``.

Scores are sparse dot products with the weights, over every whole text, in the
task that reads it, without a shuffle; the weights (``dims`` floats) are
broadcast.

Nulls and edges: null and empty texts have no n-grams and get the score of the
bias; labels other than 0 and 1 and null ids teach nothing; an id with several
labels takes the more frequent one (1 where equal); without any label all scores
are 0.5; repeated rows repeat (and teach once); an empty table gives an empty
result. Rows whose score is 0.5 or more are predicted 1.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm.common import TEXT_ROWS, Batches, batch_of, batch_rows, small_batches, solid

WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
SCALE = 30.0
MEMORY = 1 << 17             # words whose hashes a task remembers at once
PIECE = 1 << 20              # characters of a text that are cut into words at a time
LOWER, CAPITAL, UPPER, MIXED, DIGITS = range(5)


def shape(word: str) -> int:
    """5 for a mark on its own and more for others; words share the first five."""
    if word[0].isalpha():
        if word.islower() or word.lower() == word:
            return LOWER
        if word.isupper() and len(word) > 1:
            return UPPER
        return CAPITAL if word[0].isupper() and (word[1:].lower() == word[1:]) else MIXED
    if word[0].isdigit():
        return DIGITS
    return 5 + zlib.crc32(word.encode("utf-8", "surrogatepass")) % 200


class Codes(dict):
    """Hash and shape of a word in one number, computed once a word."""

    def __missing__(self, word: str) -> int:
        code = (zlib.crc32(word.encode("utf-8", "surrogatepass")) << 8) | shape(word)
        self[word] = code
        return code


def word_codes(text: str, codes: Codes) -> np.ndarray:
    if len(codes) > MEMORY:
        codes.clear()
    if len(text) <= PIECE:
        return np.fromiter(map(codes.__getitem__, WORD.findall(text)), np.int64)
    made, at = [], 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and not text[end].isspace():       # words stay whole
            end += 1
        made.append(word_codes(text[at:end], codes) if end - at <= PIECE else
                    np.fromiter((codes[m.group()] for m in WORD.finditer(text, at, end)), np.int64))
        at = end
    return np.concatenate(made)


def places(text: str | None, codes: Codes, dims: int) -> np.ndarray:
    """The place of every n-gram, with repeats."""
    c = word_codes(text, codes) if text else np.empty(0, np.int64)
    if not len(c):
        return np.empty(0, np.int64)
    h, s = (c >> 8).astype(np.uint64), (c & 255).astype(np.uint64)
    grams = [h, (h[:-1] * np.uint64(0x9E3779B1) + h[1:]) ^ np.uint64(1 << 40), (s[:-1] << np.uint64(8) | s[1:]) + np.uint64(2 << 40),
             (s[:-2] << np.uint64(16) | s[1:-1] << np.uint64(8) | s[2:]) + np.uint64(3 << 40),
             np.full(int((h[1:] == h[:-1]).sum()), 4 << 40, np.uint64)]
    mixed = np.concatenate(grams) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - (int(dims).bit_length() - 1))).astype(np.int64)


@dataclass
class Ftrl:
    """State of the learner; place ``dims`` is the bias."""
    z: np.ndarray
    n: np.ndarray
    alpha: float
    beta: float
    l1: float
    l2: float

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        """One update, by one text."""
        w = self.weights(at)
        g = (sigmoid(float(w @ x)) - label) * x
        more = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] = more


def sigmoid(v):
    return 0.5 * (1 + np.tanh(0.5 * v))


def labelled(labels: DataFrame, label: Column, id_col: str) -> DataFrame:
    """``id``, ``label`` (0 or 1), one row an id."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), label.cast("int").alias("label"))
    return (known.where("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.avg("label").alias("share"))
            .select("id", (F.col("share") >= 0.5).cast("int").alias("label")))


EXAMPLES = pa.schema([("label", pa.int32()), ("at", pa.list_(pa.int32())), ("n", pa.list_(pa.int32()))])
CHANGES = pa.schema([("z", pa.list_(pa.float64())), ("n", pa.list_(pa.float64()))])


@dataclass
class Quality:
    dims: int
    weights: np.ndarray          # the bias is last

    def score(self, text: str | None, codes: Codes) -> float:
        at = places(text, codes, self.dims)
        total = float(self.weights[at].sum(dtype=np.float64)) * (SCALE / max(1, len(at)))
        return float(sigmoid(total + float(self.weights[-1])))


def epoch(start: Ftrl, spark: SparkSession):
    """The pass of one task through its examples, from a common state: the
    changes that it makes, in one row (none without examples)."""
    shared = spark.sparkContext.broadcast((start.z.copy(), start.n.copy(), start.alpha, start.beta, start.l1, start.l2))

    def run(batches: Batches) -> Batches:
        z, n, *how = shared.value
        state, seen = Ftrl(z.copy(), n.copy(), *how), False
        for b in batches:
            label, at, count = b.column("label").to_numpy(), b.column("at"), b.column("n")
            for i in range(b.num_rows):
                c = count[i].values.to_numpy().astype(np.float64)
                state.learn(np.append(at[i].values.to_numpy(), len(z) - 1), np.append(c * (SCALE / max(1.0, c.sum())), 1.0), int(label[i]))
                seen = True
        if seen:
            yield batch_of(CHANGES, ([state.z - z], [state.n - n]))
    return run


def fit(docs: DataFrame, labels: DataFrame, label: Column, id_col: str = "doc_id", text_col: str = "text", dims: int = 1 << 18,
        max_train: int = 20_000, shards: int = 6, epochs: int = 6, alpha: float = 0.3, beta: float = 1.0,
        l1: float = 0.05, l2: float = 0.05) -> Quality:
    """Fit on the rows of ``docs`` that have a ``label`` (an expression over
    ``labels``), at most ``max_train`` of them."""
    if dims < 2 or dims & (dims - 1):
        raise ValueError(f"dims must be a power of two, got {dims}")
    known = labelled(labels, label, id_col)
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    # max_train rows of a few numbers: a proven bound for the broadcasts. An id
    # may stand in any number of rows, so rows are picked in a second step.
    chosen = solid(known.join(ids, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(max_train), "quality-ids")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("pick", F.xxhash64("text"))
    picked = solid(rows.join(F.broadcast(chosen), "id").select("id", "pick", "label").distinct()
                   .orderBy(F.xxhash64("id"), "pick", "id").limit(max_train), "quality-picked")
    rows = rows.join(F.broadcast(picked), ["id", "pick"]).dropDuplicates(["id", "pick"])

    def examples(batches: Batches) -> Batches:
        codes = Codes()
        for b in batches:
            made = [np.unique(places(t, codes, dims), return_counts=True) for t in b.column("text").to_pylist()]
            yield batch_of(EXAMPLES, (b.column("label"), [a.astype(np.int32) for a, _ in made], [c.astype(np.int32) for _, c in made]))

    with batch_rows(docs.sparkSession, TEXT_ROWS):
        made = rows.repartition(shards, "id", "pick").sortWithinPartitions(F.xxhash64("id", "pick"), "id").select("label", "text")
        train = solid(made.mapInArrow(examples, "label int, at array<int>, n array<int>"), "quality-train")
    z, n = np.zeros(dims + 1), np.zeros(dims + 1)
    for _ in range(epochs):
        # At most ``shards`` tasks, each with its part, return a row of 2 * dims numbers.
        with batch_rows(docs.sparkSession, TEXT_ROWS):
            changes = (train.coalesce(shards).mapInArrow(epoch(Ftrl(z, n, alpha, beta, l1, l2), docs.sparkSession),
                                                         "z array<double>, n array<double>").toArrow())
        for at in range(changes.num_rows):
            z += np.asarray(changes["z"][at].values) / changes.num_rows
            n += np.asarray(changes["n"][at].values) / changes.num_rows
    state = Ftrl(z, n, alpha, beta, l1, l2)
    return Quality(dims, state.weights().astype(np.float32))


def score(docs: DataFrame, model: Quality, text_col: str = "text", *keep: Column) -> DataFrame:
    """``keep`` columns, then ``score`` (0 to 1) and ``predicted`` of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast((model.dims, model.weights))
    source = docs.select(*keep, F.col(text_col).cast("string").alias("__text"))
    kept = source.columns[:-1]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]] + ["score double", "predicted int"])

    def run(batches: Batches) -> Batches:
        m, codes = Quality(*shared.value), Codes()
        for b in batches:
            scores = np.array([m.score(t, codes) for t in b.column(len(kept)).to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                                             names=[*kept, "score", "predicted"])
    return source.mapInArrow(run, schema)
