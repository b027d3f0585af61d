"""Language identification by nearest centroid.

Texts become normalised TF-IDF vectors of hashed byte n-grams; each language
has several centroids from spherical k-means; a text takes the language of the
centroid of largest cosine. A text whose cosine is below the limit of its
language and length class is rejected. The limit is a low quantile
(``reject_share``) of the cosines of training texts, and of their beginnings, of
that class with centroids that were fitted without them; languages of fewer than
``LEAST`` rows share the quantile of all, and fewer rows in all give no limit.

The classifier is fitted on a bounded sample of labelled rows: at most
``per_lang`` rows of each language and ``max_sample`` rows in all, taken in the
order of a hash of id and text. Prediction reads every whole text once, in
tasks, without a shuffle; the model (``dims`` x centroids) is broadcast.

Nulls and edges: null texts and texts without a letter are ``und``, score 0,
rejected; rows with null text, null language or no letter teach nothing; with
no labelled row at all everything is ``und``; equal cosines go to the
language that sorts first; null ids are predicted like others; repeated rows
repeat; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindle.llm.common import Batches, batch_of, give_back, small_batches

UND = "und"
ROWS = 128
PARTS = 40
CHUNK = 1 << 20
SIZES = (16, 32, 64, 128, 256)       # bytes from which the length classes after the first begin
FOLDS = 4
LEAST = 20
NOT_LETTERS = bytes(b if chr(b).isalpha() or b >= 128 else 32 for b in range(256))
LATIN = re.compile("[A-Za-z]")


def has_letter(text: str | None) -> bool:
    return bool(text) and (LATIN.search(text) is not None or any(map(str.isalpha, text)))


def gram_counts(text: str, dims: int) -> np.ndarray:
    """Counts of hashed 1-, 2- and 3-byte grams of the lower-cased text whose
    ASCII non-letters are single spaces."""
    raw = b" ".join(text.lower().encode("utf-8", "replace").translate(NOT_LETTERS).split())
    codes = np.frombuffer(b" " + raw + b" ", np.uint8)
    shift = np.uint32(32 - int(dims).bit_length() + 1)
    counts = np.zeros(dims, np.float32)
    for at in range(0, max(1, len(codes) - 2), CHUNK):
        c = codes[at:at + CHUNK + 2].astype(np.uint32)
        grams = (c[:-2] + np.uint32(1 << 24), (c[:-2] << np.uint32(8)) + c[1:-1] + np.uint32(2 << 24),
                 (c[:-2] << np.uint32(16)) + (c[1:-1] << np.uint32(8)) + c[2:] + np.uint32(3 << 24))
        for g in grams:
            counts += np.bincount((g * np.uint32(2654435761)) >> shift, minlength=dims)
    return counts


def size_class(counts: np.ndarray) -> np.ndarray:
    """Length class of each row of counts, which hold three grams a byte."""
    return np.searchsorted(SIZES, counts.sum(-1) / 3, side="right")


@dataclass
class Centroids:
    langs: list[str]                     # of each centroid
    matrix: np.ndarray                   # dims x centroids, unit columns
    idf: np.ndarray
    limits: dict[str, list[float]] = field(default_factory=dict)      # of each length class

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        """Unit vectors, made in the place of ``counts``."""
        np.log1p(counts, out=counts)
        counts *= self.idf
        counts /= np.maximum(np.sqrt(np.einsum("ij,ij->i", counts, counts)), 1e-12)[:, None]
        return counts


def kmeans(x: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Spherical k-means from a farthest-first start."""
    chosen = [x.mean(0)]
    while len(chosen) < min(k, len(x)) + 1:
        chosen.append(x[np.argmin((x @ np.stack(chosen).T).max(1))])
    c = np.stack(chosen[1:])
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        c = np.stack([x[near == j].mean(0) if (near == j).any() else c[j] for j in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return c


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        dims: int = 4096, clusters: int = 3, per_lang: int = 400, max_sample: int = 4000,
        reject_share: float = 0.005) -> Centroids:
    """Fit on a bounded sample of ``labelled`` rows."""
    known = labelled.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("text"),
                            F.col(lang_col).cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    known = known.where(F.col("text").rlike("\\p{L}")).select("lang", "text", F.xxhash64("i", "text").alias("pick"))
    # Only the picks are ranked, in 40 parts a language, with row limits before
    # the shuffle; a semi-join of at most max_sample keys then finds the texts.
    part = F.pmod(F.shiftright("pick", 7), F.lit(PARTS)).alias("part")
    order = Window.partitionBy("lang", "part").orderBy("pick")
    picked = (known.select("lang", "pick", part).withColumn("rank", F.row_number().over(order))
              .where(F.col("rank") <= max(1, per_lang // PARTS)).orderBy("rank", "part", "lang").limit(max_sample)
              .select("lang", "pick").distinct())
    sample = known.join(F.broadcast(picked), ["lang", "pick"], "left_semi").dropDuplicates(["lang", "pick"])

    def run(batches: Batches) -> Batches:
        schema = pa.schema([("lang", pa.string()), ("pick", pa.int64()), ("cut", pa.int32()), ("at", pa.list_(pa.int32())), ("n", pa.list_(pa.float32()))])
        for b in batches:
            texts = b.column("text").to_pylist()
            whole = [(i, 0, t) for i, t in enumerate(texts)]
            starts = [(i, c, t.lstrip()[:c * 5 // 4]) for i, t in enumerate(texts) for c in (4, *SIZES) if len(t.lstrip()) > c * 5 // 4]
            kept = [(i, c, t) for i, c, t in whole + starts if has_letter(t)]
            counts = [gram_counts(t, dims) for *_, t in kept]
            held = [np.flatnonzero(c) for c in counts]
            rows = pa.array([i for i, *_ in kept], pa.int32())
            yield batch_of(schema, (b.column("lang").take(rows), b.column("pick").take(rows), [c for _, c, _ in kept],
                                    [h.astype(np.int32) for h in held], [c[h] for c, h in zip(counts, held, strict=True)]))

    small_batches(labelled.sparkSession)
    rows = sample.mapInArrow(run, "lang string, pick long, cut int, at array<int>, n array<float>").toArrow()
    rows = rows.sort_by([("cut", "ascending"), ("lang", "ascending"), ("pick", "ascending")])
    cuts, all_langs, picks = rows["cut"].to_numpy(), np.array(rows["lang"].to_pylist(), dtype=object), rows["pick"].to_numpy()

    def dense(chosen: np.ndarray) -> np.ndarray:
        counts = np.zeros((len(chosen), dims), np.float32)
        for k, i in enumerate(chosen):
            counts[k, rows["at"][int(i)].values.to_numpy()] = rows["n"][int(i)].values.to_numpy()
        return counts
    counts = dense(np.flatnonzero(cuts == 0))
    model = Centroids([], np.zeros((dims, 0), np.float32),
                      (np.log((1 + len(counts)) / (1 + np.count_nonzero(counts, axis=0))) + 1).astype(np.float32))
    langs, folds = all_langs[cuts == 0], (picks >> 16) % FOLDS
    x = model.vectors(counts)
    parts, seen = [], {}
    for lang in sorted(set(langs)):
        own, fold = x[langs == lang], folds[cuts == 0][langs == lang]
        parts.append(kmeans(own, clusters))
        model.langs += [lang] * len(parts[-1])
        seen[lang] = [np.zeros((0, 2))]
        for k in range(FOLDS):
            if 0 < (fold == k).sum() < len(fold):
                c = kmeans(own[fold != k], clusters)
                out = dense(np.flatnonzero((all_langs == lang) & (folds == k)))
                sizes = size_class(out)
                seen[lang].append(np.stack([sizes, (model.vectors(out) @ c.T).max(1)], 1))
        seen[lang] = np.concatenate(seen[lang])
    for lang, own in seen.items():
        own = own if (langs == lang).sum() >= LEAST else np.concatenate(list(seen.values()))
        scores = [own[own[:, 0] == k, 1] for k in range(len(SIZES) + 1)]
        model.limits[lang] = [float(np.quantile(v, reject_share)) if len(v) >= LEAST else 0.0 for v in scores]
    if parts:
        model.matrix = np.ascontiguousarray(np.concatenate(parts).T.astype(np.float32))
    del rows, counts, x
    give_back()
    return model


def predict(docs: DataFrame, model: Centroids, text_col: str = "text", *keep: Column) -> DataFrame:
    """``keep`` columns, then ``lang_pred``, ``score`` (cosine, 0 to 1) and
    ``rejected`` of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast((model.langs, model.matrix, model.idf, model.limits))
    source = docs.select(*keep, F.col(text_col).cast("string").alias("__text"))
    kept = source.columns[:-1]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1]]
                       + ["lang_pred string", "score double", "rejected boolean"])

    def run(batches: Batches) -> Batches:
        m = Centroids(*shared.value)
        dims = len(m.idf)
        for b in batches:
            texts = b.column(len(kept)).to_pylist()
            langs, scores, limits = [UND] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
            for at in range(0, len(texts), ROWS):
                rows = [i for i in range(at, min(at + ROWS, len(texts))) if has_letter(texts[i])] if m.langs else []
                if rows:
                    counts = np.stack([gram_counts(texts[i], dims) for i in rows])
                    sizes = size_class(counts)
                    cosines = m.vectors(counts) @ m.matrix
                    for i, j, c, k in zip(rows, cosines.argmax(1), cosines.max(1), sizes, strict=True):
                        langs[i], scores[i], limits[i] = m.langs[j], min(1.0, max(0.0, float(c))), m.limits[m.langs[j]][k]
            rejected = [x == UND or s < limit for x, s, limit in zip(langs, scores, limits, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[*kept, "lang_pred", "score", "rejected"])
    return source.mapInArrow(run, schema)
