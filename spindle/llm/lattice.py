"""Language-model scores by subword lattices.

The units are the strings of an existing tokenizer's vocabulary, the 256 single
bytes, and whole words. A word (behind the vocabulary's word mark) has the sum
of the probabilities of all its segmentations into units, found by a forward
recursion in log space; a text is the product of its words and an end. Unit
scores are kept by class of training text (its language): the vocabulary's own
scores start them, and rounds of expected counts over the class's words
re-estimate them. A text's score marginalises the class as well.

In a class with T word tokens of V kinds, a word of count c is the unit "whole
word" with probability (c - d) / T, and with the discounted d V / T it is
spelled by units and a stop. All this sums to one at most over all texts.

Words do not share units, so lattices are built once for each distinct word:
tasks count words, words and counts are aggregated, and texts then look up
their words. Words above a count that leaves at most ``max_head`` of them are
broadcast (a proven bound); the others, whose counts are all below it, join by
a shuffle. Either way each word of each text is scored.

Nulls and edges: null and empty texts are the end alone; a null id counts as
the text '' in the split; null classes are a class; classes beyond the
``max_classes`` largest are one class; repeated rows are scored (and learnt
from) each; long words are scored in pieces of bounded memory; an empty table
gives an empty result, and with no training text every word is unknown.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from dataclasses import fields as dataclass_fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import THIN_ROWS, Batches, batch_of, batch_rows, solid

MARK = "▁".encode()         # the vocabulary's sign for the start of a word
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
GATHER = 8 << 20
CELLS = 1 << 20
PLAIN = 24
BASE = 0x9E3779B97F4A7C15
LOG2_10 = math.log2(10)
U = np.uint64


def read_units(path: str) -> tuple[list[bytes], np.ndarray]:
    """Unit strings and starting weights from a sentencepiece vocabulary,
    whose BPE scores are minus the rank: weight 1 / (rank + 1)."""
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=path)
    weight = {bytes([b]): 1e-6 for b in range(256)}
    for i in range(sp.get_piece_size()):
        if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)):
            text = sp.id_to_piece(i).encode()
            weight[text] = weight.get(text, 0.0) + 1.0 / (2.0 - min(0.0, sp.get_score(i)))
    units = sorted(weight)
    w = np.array([weight[u] for u in units])
    return units, w / w.sum()


def powers(base: int) -> np.ndarray:
    steps = np.full(CELLS + 1, base, U)
    steps[0] = 1
    return np.multiply.accumulate(steps)


class Units:
    """Finds units in text: a hash table over rolling hashes, one probe of a
    primary and one of a secondary slot, checked against the whole hash."""

    def __init__(self, units: list[bytes]):
        self.units = units
        self.lengths = sorted({len(u) for u in units})
        self.longest = self.lengths[-1]
        self.up, self.down = powers(BASE), powers(pow(BASE, -1, 1 << 64))
        hashes = np.array([self.spans(self.sums(np.frombuffer(u, np.uint8)), np.array([0]), len(u))[0] for u in units], U)
        if len(np.unique(hashes)) != len(units):
            raise ValueError("two units share a hash")
        self.hashes = hashes
        self.first = np.full(1 << 22, -1, np.int32)
        self.second = np.full(1 << 16, -1, np.int32)
        slot = (hashes >> U(42)).astype(np.int64)
        _, lead = np.unique(slot, return_index=True)
        self.first[slot[lead]] = lead
        rest = np.setdiff1d(np.arange(len(units)), lead)
        self.turn = next(t for t in range(1, 4096) if len(np.unique(self.other(hashes[rest], t))) == len(rest))
        self.second[self.other(hashes[rest], self.turn)] = rest

    @staticmethod
    def other(h: np.ndarray, turn: int) -> np.ndarray:
        return ((h * U(2 * turn + 1)) >> U(16) & U(0xFFFF)).astype(np.int64)

    def sums(self, data: np.ndarray) -> np.ndarray:
        x = (data.astype(U) + U(1)) * U(0xBF58476D1CE4E5B9)
        x ^= x >> U(29)
        return np.concatenate((np.zeros(1, U), np.cumsum(x * self.up[:len(x)], dtype=U)))

    def spans(self, sums: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        h = (sums[at + size] - sums[at]) * self.down[at]
        return (h ^ (h >> U(31))) * U(0x94D049BB133111EB)

    def find(self, sums: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        """Index of the unit at each place, or -1."""
        h = self.spans(sums, at, size)
        i = self.first[(h >> U(42)).astype(np.int64)]
        i = np.where((i >= 0) & (self.hashes[i] == h), i, -1)
        j = self.second[self.other(h, self.turn)]
        return np.where((j >= 0) & (self.hashes[j] == h), j, i)


def logsum(x: np.ndarray) -> np.ndarray:
    """log of the sum of exp over the last axis."""
    top = x.max(-1)
    safe = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - safe[..., None]).sum(-1)) + safe


def arcs(finder: Units, words: list[bytes], n: int) -> np.ndarray:
    """Unit index (or -1) for each word (all of ``n`` bytes), start and length
    number; words have equal lengths, so starts are a plain grid."""
    sums = finder.sums(np.frombuffer(b"".join(words), np.uint8))
    lengths = [x for x in finder.lengths if x <= n]
    found = np.full((len(words), n, len(lengths)), -1, np.int32)
    for k, size in enumerate(lengths):
        at = (np.arange(len(words))[:, None] * n + np.arange(n - size + 1)).ravel()
        found[:, :n - size + 1, k] = finder.find(sums, at, size).reshape(len(words), -1)
    return found


def forward(logp: np.ndarray, found: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """log probability of each prefix of each word; unit -1 reads the last
    entry of ``logp``, which is minus infinity."""
    words, n, _ = found.shape
    alpha = np.full((words, n + 1), -np.inf)
    alpha[:, 0] = 0.0
    for j in range(1, n + 1):
        fits = np.flatnonzero(lengths <= j)
        start = j - lengths[fits]
        alpha[:, j] = logsum(alpha[:, start] + logp[found[:, start, fits]])
    return alpha


def backward(logp: np.ndarray, found: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    words, n, _ = found.shape
    beta = np.full((words, n + 1), -np.inf)
    beta[:, n] = 0.0
    for i in range(n - 1, -1, -1):
        fits = np.flatnonzero(lengths <= n - i)
        beta[:, i] = logsum(beta[:, i + lengths[fits]] + logp[found[:, i, fits]])
    return beta


def by_end(arc: np.ndarray, lengths: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each end: the starts of the arcs into it and their probabilities.
    Arcs that no word of the group has are left out."""
    n = arc.shape[1]
    used = (arc > 0).any(0)
    out = []
    for j in range(1, n + 1):
        fits = np.flatnonzero(lengths <= j)
        fits = fits[used[j - lengths[fits], fits]]
        out.append((j - lengths[fits], arc[:, j - lengths[fits], fits]))
    return out


def prefix_sums(ends: list[tuple[np.ndarray, np.ndarray]], words: int) -> np.ndarray:
    """``forward`` for words of PLAIN bytes at most, whose probabilities are
    too large to leave the range of doubles: sums instead of logs of sums."""
    alpha = np.zeros((words, len(ends) + 1))
    alpha[:, 0] = 1.0
    for j, (start, p) in enumerate(ends, 1):
        alpha[:, j] = np.einsum("ij,ij->i", alpha[:, start], p)
    return alpha


def suffix_sums(ends: list[tuple[np.ndarray, np.ndarray]], words: int) -> np.ndarray:
    beta = np.zeros((words, len(ends) + 1))
    beta[:, len(ends)] = 1.0
    for j in range(len(ends), 0, -1):
        start, p = ends[j - 1]
        beta[:, start] += beta[:, j, None] * p
    return beta


def groups(finder: Units, words: list[bytes]):
    """Indices of words of equal length, few enough for CELLS cells."""
    by: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by.setdefault(len(w), []).append(i)
    for n, members in by.items():
        size = max(1, CELLS // (max(1, n) * len(finder.lengths)))
        for at in range(0, len(members), size):
            yield n, members[at:at + size]


def long_word(finder: Units, logp: np.ndarray, word: bytes) -> float:
    """Forward recursion for one long word, chunk by chunk: only the last
    prefixes, as many as the longest unit has bytes, are held."""
    step = max(1, CELLS // (4 * len(finder.lengths)))
    carry, done = np.zeros(1), 0          # log probabilities of the prefixes that end at ``done`` and before
    while done < len(word):
        end, base = min(done + step, len(word)), done - len(carry) + 1
        part = word[base:end]
        found = arcs(finder, [part], len(part))[0]
        lengths = np.array([x for x in finder.lengths if x <= len(part)])
        alpha = np.concatenate((carry, np.full(end - done, -np.inf)))
        for j in range(len(carry), len(alpha)):
            fits = np.flatnonzero(lengths <= j)
            start = j - lengths[fits]
            alpha[j] = logsum(alpha[start] + logp[found[start, fits]])
        carry, done = alpha[-min(len(alpha), finder.longest):], end
    return float(carry[-1])


def word_scores(finder: Units, logp: np.ndarray, words: list[bytes]) -> np.ndarray:
    """Natural log of each word's probability over all segmentations, words x
    classes; ``logp`` is classes x units."""
    marked, out = [MARK + w for w in words], np.zeros((len(words), len(logp)))
    reach = CELLS // (4 * len(finder.lengths))
    for n, members in groups(finder, marked):
        if n > reach:
            for i in members:
                out[i] = [long_word(finder, p, marked[i]) for p in logp]
        else:
            lengths = np.array([x for x in finder.lengths if x <= n])
            found = arcs(finder, [marked[i] for i in members], n)
            for z, p in enumerate(logp):
                out[members, z] = (
                    np.log(prefix_sums(by_end(np.exp(p)[found], lengths), len(found))[:, -1]) if n <= PLAIN
                    else forward(p, found, lengths)[:, -1])
    return out


def expected_units(finder: Units, logp: np.ndarray, words: list[bytes], has: np.ndarray, total: np.ndarray) -> None:
    """Add each unit's expected number in the words that each class ``has``
    (words x classes) to ``total`` (classes x units). Words too long for one
    lattice are expected in runs of a lattice's length."""
    reach = CELLS // (4 * len(finder.lengths))
    marked, of = [], []
    for r, w in enumerate(words):
        text = MARK + w
        for at in range(0, len(text), reach):
            marked.append(text[at:at + reach])
            of.append(r)
    has = has[of]
    for n, members in groups(finder, marked):
        lengths = np.array([x for x in finder.lengths if x <= n])
        every = arcs(finder, [marked[i] for i in members], n)
        for z, p in enumerate(logp):
            found = every[has[members, z]]
            if not len(found):
                continue
            if n <= PLAIN:
                arc = np.exp(p)[found]
                ends = by_end(arc, lengths)
                alpha, beta = prefix_sums(ends, len(arc)), suffix_sums(ends, len(arc))
                share = arc * (alpha[:, :-1] / alpha[:, -1:])[:, :, None]
                for k, size in enumerate(lengths):
                    share[:, :n - size + 1, k] *= beta[:, size:]
            else:
                alpha, beta = forward(p, found, lengths), backward(p, found, lengths)
                share = p[found] + (alpha[:, :-1] - alpha[:, -1:])[:, :, None]
                for k, size in enumerate(lengths):
                    share[:, :n - size + 1, k] += beta[:, size:]
                share = np.exp(share)
            total[z] += np.bincount(found.ravel() + 1, share.ravel(), minlength=total.shape[1] + 1)[1:]


@dataclass
class Model:
    units: list[bytes]
    logp: np.ndarray                 # classes x (units, then minus infinity): natural logs
    stop: np.ndarray                 # log of a spelled word's stop, by class
    words: np.ndarray                # word tokens by class
    kinds: np.ndarray                # distinct words by class
    texts: np.ndarray                # training texts by class
    all_kinds: int                   # distinct words over all classes

    @property
    def tokens(self) -> int:
        return int(self.words.sum() + self.texts.sum())

    @property
    def base_floor(self) -> float:
        return self.tokens + 0.5 * (self.all_kinds + bool(self.texts.sum()) + 1)

    def ends(self) -> np.ndarray:
        return (self.texts + 1) / (self.words + self.texts + 2)

    def whole(self, counts: np.ndarray, spelled: np.ndarray, discount: float) -> np.ndarray:
        """log10 of words' probabilities from counts and log10 spellings (both words x classes)."""
        seen = np.maximum(self.words, 1)
        rest = np.where(self.words > 0, discount * self.kinds / seen, 1.0)
        with np.errstate(divide="ignore"):
            known = np.log10(np.maximum(counts - discount, 0) / seen)
        return np.logaddexp2((np.log10(rest) + spelled) * LOG2_10, known * LOG2_10) / LOG2_10 + np.log10(1 - self.ends())


def words_of(texts: pa.Array) -> pa.ListArray:
    """The lower-cased words of each text (null: none), as bytes."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    flat = split.flatten()
    held = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    kept = np.concatenate(([0], np.cumsum(held)))[split.offsets.to_numpy() - split.offsets[0].as_py()]
    return pa.ListArray.from_arrays(pa.array(kept.astype(np.int32)), flat.filter(pa.array(held)).cast(pa.binary()))


def gathered(batches: Batches, most: int) -> Batches:
    """Batches put together to about ``most`` bytes: counting pays over many texts."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= most:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def count_words(docs: DataFrame, text_col: str, train: Column, kind: Column, classes: int) -> DataFrame:
    """``word``, ``every`` (all tokens), ``c0``, ``c1``, ... (training tokens
    by class number ``kind``). The end of a text is the word of no bytes."""
    schema = pa.schema([("word", pa.binary()), ("kind", pa.int32()), ("n", pa.int64())])

    def run(batches: Batches) -> Batches:
        for b in gathered(batches, GATHER):
            kinds = b.column("kind")
            for z in pc.unique(kinds):
                texts = b.column("text").filter(pc.equal(kinds, z))
                counts = words_of(texts).flatten().value_counts()
                yield batch_of(schema, (pa.concat_arrays([counts.field(0), pa.array([b""], pa.binary())]),
                                        np.full(len(counts) + 1, z.as_py(), np.int32),
                                        pa.concat_arrays([counts.field(1), pa.array([len(texts)], pa.int64())])))

    own = lambda z: F.sum(F.when(F.col("kind") == z, F.col("n")).otherwise(0)).alias(f"c{z}")
    return (docs.select(F.col(text_col).cast("string").alias("text"), F.when(train, kind).otherwise(-1).cast("int").alias("kind"))
            .mapInArrow(run, "word binary, kind int, n long")
            .groupBy("word").agg(F.sum("n").alias("every"), *(own(z) for z in range(classes))))


def counts_of(batch: pa.RecordBatch, classes: int) -> np.ndarray:
    return np.stack([batch.column(f"c{z}").to_numpy() for z in range(classes)], axis=1)


def fit(words: DataFrame, classes: int, path: str = VOCABULARY, rounds: int = 3, smooth: float = 0.01) -> Model:
    """Estimate the unit probabilities of each class on counted ``words``,
    where each distinct word of the class counts once."""
    units, start = read_units(path)
    size = len(units)
    c = [f"c{z}" for z in range(classes)]
    is_end = F.col("word") == F.expr("X''")
    got = words.agg(*(F.sum(F.when(is_end, 0).otherwise(F.col(x))) for x in c),
                    *(F.count(F.when(~is_end & (F.col(x) > 0), 1)) for x in c),
                    *(F.sum(F.when(is_end, F.col(x))) for x in c),
                    F.count(F.when(~is_end & (F.greatest(*c, F.lit(0)) > 0), 1))).first()
    got = [x or 0 for x in got]
    tokens, kinds, texts = (np.array(got[i * classes:(i + 1) * classes], float) for i in range(3))
    logp = np.tile(np.append(np.log(start * 0.8), -np.inf), (classes, 1))
    stop = np.full(classes, math.log(0.2))
    shared = words.sparkSession.sparkContext.broadcast
    vocabulary = shared(units)
    schema = pa.schema([("unit", pa.int32()), ("x", pa.float64())])
    learnt = words.where(~is_end & (F.greatest(*c, F.lit(0)) > 0)).select("word", *c)
    for _ in range(rounds):
        now = shared(logp)

        def run(batches: Batches, now=now) -> Batches:
            finder, total = Units(vocabulary.value), np.zeros((classes, size))
            for b in batches:
                if b.num_rows:
                    expected_units(finder, now.value, b.column("word").to_pylist(), counts_of(b, classes) > 0, total)
            held = np.flatnonzero(total)
            yield batch_of(schema, (held.astype(np.int32), total.ravel()[held]))

        weights = np.full(classes * size, smooth)
        with batch_rows(words.sparkSession, THIN_ROWS):
            sums = learnt.mapInArrow(run, "unit int, x double").groupBy("unit").agg(F.sum("x").alias("x")).toArrow()
        weights[sums["unit"].to_numpy()] += sums["x"].to_numpy()
        weights = weights.reshape(classes, size)
        whole = weights.sum(1) + kinds + smooth
        logp = np.column_stack((np.log(weights / whole[:, None]), np.full(classes, -np.inf)))
        stop = np.log((kinds + smooth) / whole)
    return Model(units, logp, stop, tokens, kinds, texts, int(got[-1]))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None,
          class_col: str | None = None, path: str = VOCABULARY, rounds: int = 3, discount: float = 0.5,
          max_head: int = 200_000, max_classes: int = 8) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (add-half unigram), ``score`` (log10) of every row, learning
    from the rows that are not ``held_out``. The class column is read in
    training only."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast
    held_out = F.lit(False) if held_out is None else held_out
    name = F.coalesce(F.col(class_col).cast("string"), F.lit("")) if class_col else F.lit("")
    largest = (docs.where(~held_out).groupBy(name.alias("name")).count().orderBy(F.desc("count"), "name").limit(max_classes).collect())
    kind, classes = F.lit(max(0, len(largest) - 1)), max(1, len(largest))
    for z, r in enumerate(largest):
        kind = F.when(name == r["name"], F.lit(z)).otherwise(kind)
    words = solid(count_words(docs, text_col, ~held_out, kind, classes), "lattice-words")
    model = fit(words, classes, path, rounds)
    trained = shared(tuple(getattr(model, f.name) for f in dataclass_fields(model)))
    values = ["known", "base", *(f"m{z}" for z in range(classes))]
    fields = [("word", pa.binary()), ("every", pa.int64()), ("known", pa.int64()), ("base", pa.float64())]
    scheme = pa.schema(fields + [(f"m{z}", pa.float64()) for z in range(classes)])

    def lattice(batches: Batches) -> Batches:
        m = Model(*trained.value)
        finder = Units(m.units)
        for b in batches:
            w, c = b.column("word").to_pylist(), counts_of(b, classes)
            s = m.whole(c, (word_scores(finder, m.logp, w) + m.stop) / math.log(10), discount)
            s[[i for i, x in enumerate(w) if not x]] = np.log10(m.ends())
            all_c = c.sum(1)
            yield batch_of(scheme, (w, b.column("every"), (all_c > 0).astype(np.int64), np.log10((all_c + 0.5) / m.base_floor), *s.T))

    scored = solid(words.mapInArrow(lattice, "word binary, every long, known long, base double, "
                                    + ", ".join(f"m{z} double" for z in range(classes))), "lattice-scores", THIN_ROWS)
    # The head: counts by powers of two tell the least count that max_head words reach.
    tiers = scored.groupBy(F.floor(F.log2(F.col("every"))).alias("tier")).count().orderBy(F.desc("tier")).collect()
    least, held = None, 0
    for tier, n in tiers:
        held += n
        if held > max_head:
            break
        least = 2 ** tier
    at_head = F.lit(False) if least is None else F.col("every") >= least
    top = scored.where(at_head).select("word", *values).toArrow()
    head = shared((top["word"].to_pylist(), np.column_stack([top[c].to_numpy() for c in values]).astype(float)))
    end_row = scored.where("word = X''").select(*values).first()
    end_values = np.array(end_row if end_row else [0.0] * len(values), float)

    def texts(batches: Batches) -> Batches:
        words, known = head.value
        head_words = pa.array(words, pa.binary())
        row = TaskContext.get().partitionId() << 40
        for b in gathered(batches, GATHER):
            lists = words_of(b.column("text"))
            flat, starts = lists.flatten(), lists.offsets.to_numpy()
            at = pc.index_in(flat, value_set=head_words).fill_null(-1).to_numpy() if len(words) else np.full(len(flat), -1)
            sums = np.tile(end_values, (b.num_rows, 1))
            some = np.flatnonzero(np.diff(starts))
            if len(some):
                of_head = known[at] if len(words) else np.zeros((len(at), len(values)))
                of_head[at < 0] = 0.0
                sums[some] += np.add.reduceat(of_head, starts[some], axis=0)
            other = np.concatenate(([0], np.cumsum(at < 0)))[starts]
            ids = np.arange(row + 1, row + 1 + b.num_rows)
            row += b.num_rows
            made = pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(ids), pa.array((np.diff(starts) + 1).astype(np.int64)),
                 *(pa.array(x) for x in sums.T.copy()), pa.ListArray.from_arrays(pa.array(other.astype(np.int32)), flat.filter(pa.array(at < 0)))],
                names=["doc_id", "held_out", "row", "n_tokens", *values, "rest"])
            for i in range(0, made.num_rows, THIN_ROWS):
                yield made.slice(i, THIN_ROWS)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), F.col(text_col).cast("string").alias("text"))
    rows = solid(rows.mapInArrow(texts, "doc_id long, held_out boolean, row long, n_tokens long, "
                                 + "".join(f"{c} double, " for c in values) + "rest array<binary>"), "lattice-rows")
    rest = (rows.select("row", F.explode("rest").alias("word"))
            .join(scored.where(~at_head).select("word", *values), "word")
            .groupBy("row").agg(*(F.sum(c).alias(f"{c}_rest") for c in values)))
    plus = {c: F.col(c) + F.coalesce(F.col(f"{c}_rest"), F.lit(0)) for c in values}
    prior = np.log10((model.texts + 1) / (model.texts.sum() + classes))
    joint = rows.join(rest, "row", "left").select("doc_id", "held_out", "n_tokens", *(x.alias(c) for c, x in plus.items()))
    each = [F.col(f"m{z}") + F.lit(float(prior[z])) for z in range(classes)]
    best = F.greatest(*each, F.lit(float("-inf")))
    marginal = best + F.log10(sum((F.pow(F.lit(10.0), x - best) for x in each), F.lit(0.0)))
    return joint.select("doc_id", "held_out", "n_tokens", F.col("known").cast("long").alias("n_known"),
                        F.lit(model.tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), marginal.alias("score"))
