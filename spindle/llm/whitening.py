"""Embedding whitening by incremental eigendecomposition.

Entries c become whole numbers x = floor(1024 c) + 100000, of which n, the sums
S and all differences n x - S are exact.

1. Every partition keeps the eigendecomposition of the scatter of the rows seen
   so far and moves it by centred rank-one updates (:func:`updated`): with
   z = Q'v the new eigenvalues are the roots of the secular equation
   1 + rho sum z_i^2 / (d_i - t) = 0, solved for all roots at once around their
   nearer pole; small z_i and close d_i are deflated first, and z is recomputed
   from the roots before the vectors are formed, which keeps these orthogonal.
   A block of rows enters centred at its own mean, turned by an orthogonal
   transformation (QR, which leaves its scatter as it is) onto at most as many
   rows as there are dimensions, each of them one update; one more update moves
   the mean. ``block=1`` updates by each row as it comes.
2. Spectra of partitions are combined in a tree, each by successive rank-one
   updates with the other's eigenpairs and the difference of the means.
3. Rayleigh-Ritz: one distributed pass sums the covariance in the basis found,
   about the exact mean; the eigenvectors of that (nearly diagonal) matrix turn
   the basis. Repeated while it is not diagonal to ``tolerance``.

What reaches the driver or a group of the tree is bounded by the square of the
number of dimensions, whatever the number of rows.

Nulls and edges: rows whose vector is null, empty, or has null or non-finite
entries are dropped, and so are rows of another length than the most frequent
one (of equally frequent ones the longest). Null ids are kept, repeated rows
count and are returned as often as they stand there. Entries beyond 2^35 in
magnitude count as 2^35. ``deviation`` is null where it does not fit 64 bits
(``deviation_text`` always has it). Components without variance (eigenvalue not
above 1e-12 of the largest) have null ``whitened``, ``explained`` 0, and no part
in ``identity_error``; fewer dimensions than ``components`` give as many as
there are. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import THIN_ROWS, Batches, batch_of, solid

SCALE, OFFSET, MOST = 1024.0, 100_000, 2.0 ** 45
LOW = 20                     # sums are kept as those of the low bits and of the rest
EPS = float(np.finfo(np.float64).eps)
FAN = 16                     # spectra that one group of the tree combines
FLAT = 1e-12


# ---------------------------------------------------------------------------
# Rank-one updates
# ---------------------------------------------------------------------------

def secular_roots(d: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots t of 1 + sum w_i / (d_i - t) = 0 for ascending d and w > 0, as
    the matrix d_i - t_j and the roots. Each root is sought as its distance
    from the nearer of its two poles, by a model that keeps this pole and takes
    the rest as linear, inside a bracket that halves when the model leaves it."""
    k = len(d)
    j = np.arange(k)
    gap = np.append(np.diff(d), w.sum())
    middle = 1 + (w[:, None] / (d[:, None] - (d + gap / 2)[None, :])).sum(0)
    right = (middle < 0) & (j < k - 1)            # nearer to the pole above
    pole = np.where(right, j + 1, j)
    delta = d[:, None] - d[pole][None, :]
    own = np.zeros((k, k), bool)
    own[pole, j] = True
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, np.where(j < k - 1, gap / 2, gap))
    high = np.where((j == k - 1), gap, high)
    t, weight = (low + high) / 2, w[pole]
    for _ in range(80):
        rest = np.where(own, 1.0, delta - t)
        part = np.where(own, 0.0, w[:, None] / rest)
        h, slope = 1 + part.sum(0), (part / rest).sum(0)
        f = h - weight / t
        high, low = np.where(f > 0, t, high), np.where(f > 0, low, t)
        b = h - slope * t
        root = np.sqrt(b * b + 4 * slope * weight)
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(b > 0, 2 * weight / (b + root), (root - b) / (2 * slope))
            down = np.where(b < 0, 2 * weight / (b - root), -(root + b) / (2 * slope))
        new = np.where(right, down, up)
        new = np.where((new > low) & (new < high), new, (low + high) / 2)
        done = np.abs(new - t) <= 2 * EPS * np.abs(new)
        t = new
        if done.all():
            break
    return np.where(own, -t, delta - t), d[pole] + t


def updated(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and vectors of Q diag(values) Q' + rho v v'."""
    z = vectors.T @ v
    norm = float(np.sqrt(z @ z))
    weight = rho * norm * norm
    if not weight > 0:
        return values, vectors
    z = z / norm
    limit = 8 * EPS * max(float(np.abs(values).max()), weight)
    live = np.flatnonzero(weight * np.abs(z) > limit)
    # Of two close eigenvalues one is turned out of the update.
    gaps, a, b = np.diff(values[live]), z[live[:-1]], z[live[1:]]
    if len(live) > 1 and (gaps * np.abs(a * b) <= limit * (a * a + b * b)).any():
        vectors, z, values, kept = vectors.copy(), z.copy(), values.copy(), []
        last = live[0]
        for i in live[1:]:
            tau = np.hypot(z[last], z[i])
            c, s = z[i] / tau, z[last] / tau
            if abs((values[i] - values[last]) * c * s) <= limit:
                x, y = vectors[:, last].copy(), vectors[:, i].copy()
                vectors[:, last], vectors[:, i] = c * x - s * y, s * x + c * y
                low, high = values[last], values[i]
                values[last], values[i] = c * c * low + s * s * high, s * s * low + c * c * high
                z[last], z[i] = 0.0, tau
            else:
                kept.append(last)
            last = i
        live = np.array([*kept, last])
        live = live[np.argsort(values[live], kind="stable")]
    if not len(live):
        return values, vectors
    d = values[live]
    apart, roots = secular_roots(d, weight * z[live] ** 2)
    between = d[None, :] - d[:, None]
    np.fill_diagonal(between, 1.0)
    with np.errstate(divide="ignore"):
        size = np.exp(0.5 * (np.log(np.abs(apart)).sum(1) - np.log(np.abs(between)).sum(1)))
    turn = np.copysign(size, z[live])[:, None] / apart
    turn /= np.sqrt((turn * turn).sum(0))
    values, out = values.copy(), vectors.copy()
    values[live], out[:, live] = roots, vectors[:, live] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], out[:, order]


@dataclass
class Spectrum:
    """Rows seen, their mean, and the eigendecomposition of their scatter."""
    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dims: int) -> "Spectrum":
        return cls(0, np.zeros(dims), np.zeros(dims), np.eye(dims))

    def move(self, v: np.ndarray, rho: float) -> None:
        self.values, self.vectors = updated(self.values, self.vectors, v, rho)

    def shift(self, mean: np.ndarray, n: int) -> None:
        if self.n:
            self.move(mean - self.mean, self.n * n / (self.n + n))
        self.mean = self.mean + (mean - self.mean) * (n / (self.n + n))
        self.n += n

    def add_block(self, x: np.ndarray) -> None:
        mean = x.mean(0)
        if len(x) > 1:
            for row in np.linalg.qr(x - mean, mode="r"):
                self.move(row, 1.0)
        self.shift(mean, len(x))

    def add_spectrum(self, other: "Spectrum") -> None:
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.move(vector, float(value))
        self.shift(other.mean, other.n)


# ---------------------------------------------------------------------------
# Passes over the table
# ---------------------------------------------------------------------------

def whole_numbers(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers that remain, and their x as int64 rows."""
    column = batch.column("vector")
    length = np.asarray(column.value_lengths().fill_null(-1))
    rows = np.flatnonzero(length == dims)
    flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    fine = np.isfinite(flat).all(1)                # null entries are read as NaN
    x = np.clip(np.floor(flat[fine] * SCALE), -MOST, MOST).astype(np.int64) + OFFSET
    return rows[fine], x


def part() -> int:
    context = TaskContext.get()
    return context.partitionId() if context else 0


def folded(rows: DataFrame, combine: Callable[[pa.Table], pa.RecordBatch], name: str) -> pa.Table:
    """``rows``, one a partition and numbered by ``part``, combined FAN at a
    time until one is left (or none)."""
    rows = solid(rows, name, THIN_ROWS)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def group(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([combine(table.sort_by("part"))])

    while (top := rows.agg(F.max("part"), F.count("*")).first())[1] > 1:
        slot = F.floor(F.col("part") / FAN)
        if top[0] >= FAN * top[1]:                 # numbers with wide gaps
            slot = F.pmod(F.xxhash64("part"), F.lit(max(1, top[1] // FAN)))
        rows = solid(rows.withColumn("part", slot.cast("long")).groupBy("part").applyInArrow(group, schema), name, THIN_ROWS)
    return rows.toArrow()


def grid(column, *shape: int) -> np.ndarray:
    return np.asarray(column.values if hasattr(column, "values") else column).reshape(shape)


SPECTRA = "part long, n long, low array<long>, high array<long>, mean array<double>, values array<double>, vectors array<double>"
SPECTRA_ARROW = pa.schema([("part", pa.int64()), ("n", pa.int64()), ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64())),
                           ("mean", pa.list_(pa.float64())), ("values", pa.list_(pa.float64())), ("vectors", pa.list_(pa.float64()))])


def spectrum_row(number: int, s: Spectrum, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    return batch_of(SPECTRA_ARROW, ([number], [s.n], [low], [high], [s.mean], [s.values], [s.vectors.ravel()]))


def spectra(vectors: DataFrame, dims: int, block: int) -> DataFrame:
    """A row for each partition that has any row: its count, sums and spectrum."""
    def run(batches: Batches) -> Batches:
        s, low, high = Spectrum.empty(dims), np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for b in batches:
            _, x = whole_numbers(b, dims)
            low += (x & ((1 << LOW) - 1)).sum(0)
            high += (x >> LOW).sum(0)
            for at in range(0, len(x), block):
                s.add_block(x[at:at + block].astype(np.float64))
        if s.n:
            yield spectrum_row(part(), s, low, high)
    return vectors.mapInArrow(run, SPECTRA)


def combine_spectra(dims: int) -> Callable[[pa.Table], pa.RecordBatch]:
    def combine(table: pa.Table) -> pa.RecordBatch:
        s, low, high = Spectrum.empty(dims), np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for r in range(table.num_rows):
            get = lambda name: np.asarray(table[name][r].values)  # noqa: B023, E731
            other = Spectrum(table["n"][r].as_py(), get("mean"), get("values"), get("vectors").reshape(dims, dims))
            if s.n:
                s.add_spectrum(other)
            else:
                s = other
            low, high = low + get("low"), high + get("high")
        return spectrum_row(table["part"][0].as_py(), s, low, high)
    return combine


MOMENTS = pa.schema([("part", pa.int64()), ("t", pa.list_(pa.float64()))])


def add_moments(table: pa.Table) -> pa.RecordBatch:
    total = sum(np.asarray(table["t"][r].values) for r in range(table.num_rows))
    return batch_of(MOMENTS, ([table["part"][0].as_py()], [total]))


@dataclass
class Whitening:
    """``components`` holds unit eigenvectors as columns, by falling ``values``."""
    dims: int
    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    rounds: int = 0

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: 64-bit, or Python's numbers where these could be too small."""
        widest = max((abs(s) for s in self.sums), default=0) + self.n * int(np.abs(x).max(initial=0))
        if widest < 1 << 62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    @property
    def live(self) -> np.ndarray:
        return self.values > FLAT * max(float(self.values.max(initial=0.0)), 0.0)


def arrays(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))


def batch_size(dims: int) -> int:
    return max(16, min(THIN_ROWS, (1 << 20) // max(1, dims)))


def common_length(vectors: DataFrame) -> int:
    fine = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    row = (vectors.where("vector IS NOT NULL AND size(vector) > 0").where(fine).groupBy(F.size("vector").alias("dims")).count()
           .orderBy(F.desc("count"), F.desc("dims")).first())
    return row.dims if row else 0


def fit(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", block: int = 4096,
        tolerance: float = 1e-11, max_rounds: int = 4) -> Whitening | None:
    """The components of all vectors of ``df`` (None without any)."""
    vectors = arrays(df, id_col, vector_col)
    dims = common_length(vectors)
    if not dims:
        return None
    rows = batch_size(dims)
    found = folded(solid(spectra(vectors, dims, block), "whitening-spectra", rows), combine_spectra(dims), "whitening-spectra")
    get = lambda name: np.asarray(found[name][0].values)
    sums = [int(a) + (int(b) << LOW) for a, b in zip(get("low"), get("high"), strict=True)]
    model = Whitening(dims, found["n"][0].as_py(), sums, get("values")[::-1] / found["n"][0].as_py(),
                      get("vectors").reshape(dims, dims)[:, ::-1].copy())
    for model.rounds in range(1, max_rounds + 1):
        t = ritz_matrix(vectors, model, rows)
        turn = np.linalg.eigh(t)
        off = np.abs(t - np.diag(np.diag(t))).max()
        model.values = np.maximum(turn.eigenvalues[::-1], 0.0)
        # Orthogonal to the last bits again before the next pass.
        q, r = np.linalg.qr(model.components @ turn.eigenvectors[:, ::-1])
        model.components = q * np.where(np.diag(r) < 0, -1.0, 1.0)
        if off <= tolerance * np.abs(t).max():
            break
    return model


def ritz_matrix(vectors: DataFrame, model: Whitening, rows: int) -> np.ndarray:
    """The covariance of all rows in the basis of ``model``."""
    dims = model.dims
    shared = vectors.sparkSession.sparkContext.broadcast((dims, model.n, model.sums, model.values, model.components))

    def run(batches: Batches) -> Batches:
        m, t, seen = Whitening(*shared.value), np.zeros((dims, dims)), False
        for b in batches:
            _, x = whole_numbers(b, dims)
            if len(x):
                y = (m.deviations(x) / m.n).astype(np.float64) @ m.components
                t += y.T @ y
                seen = True
        if seen:
            yield batch_of(MOMENTS, ([part()], [t.ravel()]))
    made = solid(vectors.mapInArrow(run, "part long, t array<double>"), "whitening-ritz", rows)
    total = folded(made, add_moments, "whitening-ritz")
    t = np.asarray(total["t"][0].values).reshape(dims, dims) / model.n
    return (t + t.T) / 2


WHITENED = "deviation long, deviation_text string, w array<double>"


def transform(df: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding",
              components: int = 8) -> DataFrame:
    """``vec_id``, ``deviation``, ``deviation_text`` and the whitened
    coordinates ``w`` of every remaining row."""
    vectors = arrays(df, id_col, vector_col)
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    if model is None:
        return vectors.sparkSession.createDataFrame([], f"vec_id {id_type}, {WHITENED}")
    dims, k = model.dims, min(components, model.dims)
    shared = vectors.sparkSession.sparkContext.broadcast((dims, model.n, model.sums, model.values, model.components))

    def run(batches: Batches) -> Batches:
        m = Whitening(*shared.value)
        live, names = m.live[:k], ["vec_id", "deviation", "deviation_text", "w"]
        with np.errstate(divide="ignore"):
            scale = m.components[:, :k] / np.where(live, np.sqrt(m.values[:k]), 1.0)
        for b in batches:
            rows, x = whole_numbers(b, dims)
            d = m.deviations(x)
            exact = d.astype(object) if float(np.abs(d).max(initial=0)) ** 2 * dims >= 2.0 ** 62 else d
            totals = [int(v) for v in (exact * exact).sum(1)] if len(x) else []
            w = (d / m.n).astype(np.float64) @ scale
            made = pa.array(w.ravel(), mask=np.broadcast_to(~live, w.shape).ravel())
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(pa.array(rows)), pa.array([v if v < 1 << 63 else None for v in totals], pa.int64()),
                 pa.array([str(v) for v in totals], pa.string()),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) * k + 1, k), pa.int32()), made)], names=names)
    return vectors.mapInArrow(run, f"vec_id {id_type}, {WHITENED}")


def identity_error(rows: DataFrame, live: list[bool]) -> float:
    """Largest absolute entry of the covariance of ``w`` less the identity."""
    on = [i for i, x in enumerate(live) if x]
    if not on:
        return 0.0
    means = rows.agg(*(F.avg(F.col("w")[i]) for i in on)).first()
    centred = {i: F.col("w")[i] - F.lit(m) for i, m in zip(on, means, strict=True)}
    pairs = [(i, j) for i in on for j in on if i <= j]
    found = rows.agg(*(F.avg(centred[i] * centred[j]) for i, j in pairs)).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs, strict=True))


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8, **how) -> DataFrame:
    """A row for every remaining row of ``df`` and component: ``vec_id``,
    ``component``, ``n``, ``deviation``, ``whitened``, ``explained``,
    ``identity_error``, ``deviation_text``."""
    model = fit(df, id_col, vector_col, **how)
    rows = solid(transform(df, model, id_col, vector_col, components), "whitening-rows", batch_size(model.dims if model else 1))
    share, live, error = [0.0], [False], 0.0
    if model is not None:
        live = [bool(x) for x in model.live[:components]]
        trace = float(model.values.sum())
        share = [float(v) / trace if on else 0.0 for v, on in zip(model.values[:components], live)]
        error = identity_error(rows, live)
    explained = F.array(*(F.lit(x) for x in share))
    return (rows.select("vec_id", "deviation", "deviation_text", F.posexplode("w").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"),
                    "deviation", "whitened", F.get(explained, F.col("at")).alias("explained"),
                    F.lit(float(error)).alias("identity_error"), "deviation_text"))
