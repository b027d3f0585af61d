"""Phrase collocations mined from FM-indexes over word ids, one index a shard.

1. Tasks cut their documents into shards of about ``shard_words`` words, number
   the words of a shard (by language, so that languages never meet) and keep
   its text as numbers, with 0 between pieces. Word counts are summed over
   shards; in each shard rarer words become breaks too, since no phrase of
   ``least`` occurrences holds one.
2. A reverse index of each shard's text gives its pairs of words with local
   counts. Their hashes, packed by ranges, are summed over shards; each shard
   gets back the hashes of ``least`` occurrences, and puts breaks where no such
   pair stands. (Pairs that only share a hash stay until step 4.)
3. What is left of each shard gets two FM-indexes, forward and reverse:
   Burrows-Wheeler transforms from a suffix order of ``most_words`` words depth
   (phrases are no longer), ranks by a stable sort of their symbols. A phrase is
   an interval in both. It is extended on the right by the symbols that the
   reverse transform holds in its interval: one backward step there gives the
   new reverse interval, the count of smaller symbols the new forward interval,
   and a step in the forward index from that leads to the interval of the phrase
   without its first word.
4. Level by level (two words, three, ...) shards return the extensions of
   phrases that are frequent in the whole corpus and whose other part is too,
   with their local counts, packed by buckets of (first part, last part). They
   are summed bucket by bucket, those of at least ``least`` occurrences are kept
   and given back to their shards, packed. So every phrase of ``least``
   occurrences is found and its count is exact; a phrase is a row only once.
5. The counts of all first and last parts follow along the links of the levels;
   the greatest count of a phrase's one-word extensions to the left and to the
   right tells whether a longer candidate has the same count (a phrase within a
   longer one of equal count is also within one that is longer by one word).

Nothing is collected: an index (made anew from the text at each level) holds a shard, a shard's frequent phrases are
bounded by its words, and the levels are tables. A single document is never cut,
so the longest one bounds the size of a shard from below.

Nulls and edges: null texts have no words; a null language is ``und``; repeated
rows count as often as they stand there; ids do not matter; a language without
a frequent phrase has no rows; equal scores and counts go by the phrase's bytes;
an empty table gives an empty result. ``least`` may be 1 (no break is added).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindle.llm.common import THIN_ROWS, Batches, batch_of, blobs, solid
from spindle.session import drop_scratch, shuffles_dropped

UND = "und"
BREAKS = b".,;:!?\n\x0b\x0c\r"
TABLE = bytes(ord(".") if b in BREAKS else b + 32 if 65 <= b <= 90 else b for b in range(256))
OUT_ROWS = 1 << 16


# ---------------------------------------------------------------------------
# Shards
# ---------------------------------------------------------------------------

def packed(numbers: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(numbers.tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


class Numbers(dict):
    """Numbers of a language's words, counted on over all languages of a shard."""

    def __init__(self, words: list, lang: str):
        super().__init__({b".": 0})
        self.words, self.lang = words, lang

    def __missing__(self, word: bytes) -> int:
        self.words.append((self.lang, word))
        self[word] = len(self.words)
        return len(self.words)


class Shard:
    """A text in the making."""

    def __init__(self) -> None:
        self.words: list[tuple[str, bytes]] = []
        self.numbers: dict[str, Numbers] = {}
        self.parts: list[np.ndarray] = [np.zeros(1, np.int32)]
        self.size = 0

    def add(self, lang: str | None, text: bytes | None) -> None:
        if not text:
            return
        lang = UND if lang is None else lang
        if lang not in self.numbers:
            self.numbers[lang] = Numbers(self.words, lang)
        # Pieces become runs of words between full stops, which no word holds.
        words = text.translate(TABLE).replace(b".", b" . ").split()
        self.parts.append(np.fromiter(map(self.numbers[lang].__getitem__, words), np.int32, len(words)))
        self.parts.append(np.zeros(1, np.int32))
        self.size += len(words)

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        text = np.concatenate(self.parts)
        counts = np.bincount(text, minlength=len(self.words) + 1)
        yield batch_of(SHARDS, ([number], [None], [None], [None], [None], [packed(text)]))
        for at in range(0, len(self.words), OUT_ROWS):
            own = self.words[at:at + OUT_ROWS]
            k = len(own)
            yield batch_of(SHARDS, ([number] * k, np.arange(at + 1, at + k + 1, dtype=np.int32), [x for x, _ in own],
                                    pa.array([w for _, w in own], pa.binary()).cast(pa.string()), counts[at + 1:at + k + 1], [None] * k))


SHARDS = pa.schema([("shard", pa.int64()), ("at", pa.int32()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("text", pa.binary())])


def shards(docs: DataFrame, text_col: str, lang_col: str, shard_words: int) -> DataFrame:
    """Two kinds of rows: the ``text`` of a shard, and its words with number
    ``at`` and local count ``n``."""
    def run(batches: Batches) -> Batches:
        base, done, shard = TaskContext.get().partitionId() << 10, 0, Shard()
        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), blobs(b, "text"), strict=True):
                shard.add(lang, text)
                if shard.size >= shard_words:
                    yield from shard.rows(base + done)
                    done, shard = done + 1, Shard()
        if shard.size:
            yield from shard.rows(base + done)
    chosen = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, "shard long, at int, lang string, word string, n long, text binary")


# ---------------------------------------------------------------------------
# FM-indexes
# ---------------------------------------------------------------------------

def thinned(text: np.ndarray) -> np.ndarray:
    """Without words that stand alone between breaks, and one break in a row."""
    live = text != 0
    alone = live.copy()
    alone[1:] &= ~live[:-1]
    alone[:-1] &= ~live[1:]
    live &= ~alone
    keep = live.copy()
    keep[:-1] |= live[1:]              # the break before a run
    if len(keep):
        keep[-1] = True
    return np.where(live, text, 0)[keep] if live.any() else text[:0]


def transform(text: np.ndarray, depth: int) -> np.ndarray:
    """Burrows-Wheeler transform of the rotations of ``text``, ordered by their
    first ``depth`` symbols at least."""
    rank, width = text.astype(np.int64), 1
    while True:
        key = rank * (int(rank.max()) + 1) + np.roll(rank, -width)
        order = np.argsort(key)
        width *= 2
        if width >= depth:
            return np.roll(text, 1)[order]
        key = key[order]
        rank = np.empty(len(text), np.int64)
        rank[order] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))


def forward_steps(bwt: np.ndarray) -> np.ndarray:
    """For every row the row whose backward step leads to it."""
    return np.argsort(bwt, kind="stable")


def ranges(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges, and the range that each comes from."""
    owner = np.repeat(np.arange(len(start)), size)
    return np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + start[owner], owner


def symbols_after(reverse: np.ndarray, rlow: np.ndarray, n: np.ndarray):
    """The symbols that follow each phrase, whose reverse interval starts at
    ``rlow`` and has ``n`` rows: the phrase, the symbol, how often, and the
    first row that holds it."""
    rows, owner = ranges(rlow, n)
    width = int(reverse.max(initial=0)) + 1
    key = owner * width + reverse[rows]
    del owner
    order = np.argsort(key)
    key, rows = key[order], rows[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
    size = np.diff(np.append(first, len(key)))
    return key[first] // width, key[first] % width, size, np.minimum.reduceat(rows, first) if len(first) else first


class Index:
    """Forward and reverse transform of one shard."""

    def __init__(self, forward: np.ndarray, reverse: np.ndarray):
        self.reverse = reverse
        self.next = forward_steps(forward).astype(np.int32)
        self.back = np.empty(len(reverse), np.int32)          # backward steps of the reverse index
        self.back[forward_steps(reverse)] = np.arange(len(reverse), dtype=np.int32)

    @classmethod
    def of(cls, text: np.ndarray, depth: int) -> "Index":
        return cls(transform(text, depth), transform(text[::-1], depth))

    def extended(self, low: np.ndarray, rlow: np.ndarray, n: np.ndarray, name: np.ndarray):
        """Right extensions of the phrases whose forward and reverse intervals
        start at ``low`` and ``rlow`` and have ``n`` rows: the phrase's
        ``name``, the name of the extension's last part (only extensions that
        have one), and the extension's intervals and size."""
        names = np.zeros(len(self.next) + 1, np.int64)
        rows, owner = ranges(low, n)
        names[rows] = name[owner]
        owner, symbol, size, row = symbols_after(self.reverse, rlow, n)
        before = np.cumsum(size) - size
        smaller = before - np.append(before, 0)[np.searchsorted(owner, np.arange(len(low)))][owner]
        new_low, new_rlow = low[owner] + smaller, self.back[row]
        last = names[self.next[new_low]]
        good = (symbol != 0) & (last != 0)
        return name[owner[good]], last[good], new_low[good], new_rlow[good], size[good]


LEVEL = "bucket int, shard long, rows binary, wide boolean, text binary"
LEVEL_ARROW = pa.schema([("bucket", pa.int32()), ("shard", pa.int64()), ("rows", pa.binary()), ("wide", pa.bool_()), ("text", pa.binary())])
FREQUENT = "shard long, rows binary, name long, prefix long, suffix long, f long"
FREQUENT_ARROW = pa.schema([("shard", pa.int64()), ("rows", pa.binary()), ("name", pa.int64()), ("prefix", pa.int64()), ("suffix", pa.int64()), ("f", pa.int64())])
PAIRS = "bucket int, shard long, pairs binary, counts binary"
PAIRS_ARROW = pa.schema([("bucket", pa.int32()), ("shard", pa.int64()), ("pairs", pa.binary()), ("counts", pa.binary())])
KEPT = "shard long, pairs binary"
KEPT_ARROW = pa.schema([("shard", pa.int64()), ("pairs", pa.binary())])
PAIRS_PER_BUCKET = 1 << 21


def packed_rows(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers, byte by byte: all lowest bytes, then the next."""
    numbers = np.concatenate([c.astype(np.int64) for c in columns])
    return packed(numbers.view(np.uint8).reshape(-1, 8).T)


def unpacked_rows(data: list[bytes], width: int) -> tuple[np.ndarray, list[int]]:
    """The columns of several packed tables one after another, and their lengths."""
    found = [np.ascontiguousarray(unpacked(x, np.uint8).reshape(8, -1).T).view(np.int64).reshape(width, -1) for x in data]
    return np.concatenate([np.empty((width, 0), np.int64), *found], axis=1), [x.shape[1] for x in found]


def bucket_runs(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of sorted hashes, and where each starts. Sorted as signed
    numbers, each bucket is still one run."""
    bucket = key.view(np.uint64) >> np.uint64(64 - bits) if bits else np.zeros(len(key), np.uint64)
    starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(key) else np.empty(0, np.int64)
    return bucket[starts].astype(np.int32), starts


def extensions(shard: int, found, bits: int) -> pa.RecordBatch:
    """Phrases of a shard, packed: a row for each of 2 ** ``bits`` buckets of
    their two parts that has any."""
    prefix, suffix, low, rlow, n = found
    key = hashed(prefix, suffix)
    order = np.argsort(key)
    bucket, starts = bucket_runs(key[order], bits)
    rows = [packed_rows(*(c[part] for c in (low, rlow, n, prefix, suffix))) for part in np.split(order, starts[1:])] if len(starts) else []
    k = len(rows)
    return batch_of(LEVEL_ARROW, (bucket, np.full(k, shard, np.int64), rows, pa.nulls(k, pa.bool_()), pa.nulls(k, pa.binary())))


def frequent_rows(least: int):
    """Two kinds of rows for the phrases of a bucket that occur ``least`` times in
    all. One a shard: its own, packed, with the ``name`` of each: the same number
    in all shards, that of its least shard and place there. And one a phrase, with
    its count ``f``."""
    def run(table: pa.Table) -> pa.Table:
        (low, rlow, n, prefix, suffix), sizes = unpacked_rows(table["rows"].to_pylist(), 5)
        place = np.repeat(column(table, "shard"), sizes) << 31 | low
        order = np.lexsort((suffix, prefix))
        a, b = prefix[order], suffix[order]
        first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        f, name = np.add.reduceat(n[order], first), np.minimum.reduceat(place[order], first)
        of = np.empty(len(order), np.int64)
        of[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        good = f >= least
        rows = []
        for shard, at, size in zip(table["shard"].to_pylist(), np.cumsum(sizes) - sizes, sizes, strict=True):
            own = at + np.flatnonzero(good[of[at:at + size]])
            if len(own):
                rows.append((shard, packed_rows(low[own], rlow[own], n[own], name[of[own]])))
        k, m = len(rows), int(good.sum())
        none = pa.nulls(k, pa.int64())
        return pa.Table.from_batches([batch_of(FREQUENT_ARROW, ([x for x, _ in rows], [x for _, x in rows], none, none, none, none)),
                                      batch_of(FREQUENT_ARROW, (pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary()), name[good], a[first][good], b[first][good], f[good]))])
    return run


def column(table: pa.Table, name: str) -> np.ndarray:
    return table[name].to_numpy()


def frequent_text(texts: pa.Table, at: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A shard's text with its frequent words numbered from 1, all else 0, and
    the names of these numbers (of 0 first)."""
    text = unpacked(texts["text"][0].as_py(), np.int32)
    order = np.argsort(at)
    dense = np.zeros(max(int(text.max()), int(at.max())) + 1, np.uint16 if len(at) < 1 << 16 else np.uint32)
    dense[at[order]] = np.arange(1, len(at) + 1)
    return dense[text], np.concatenate(([0], name[order]))


def hashed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two names."""
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))).view(np.int64)


def pairs(bits: int):
    """Hashes and local counts of a shard's pairs of frequent words: a row for
    each of 2 ** ``bits`` buckets that has any, its hashes sorted and packed as
    differences."""
    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        if not texts.num_rows or not words.num_rows:
            return PAIRS_ARROW.empty_table()
        text, names = frequent_text(texts, column(words, "at"), column(words, "name"))
        text = thinned(text)
        if not len(text):
            return PAIRS_ARROW.empty_table()
        n = np.bincount(text, minlength=len(names))
        word, symbol, size, _ = symbols_after(transform(text[::-1], 1), (np.cumsum(n) - n)[1:], n[1:])
        good = symbol != 0
        pair = hashed(names[1:][word[good]], names[symbol[good]])
        order = np.argsort(pair)
        pair, size = pair[order], size[good][order].astype(np.int32)
        bucket, starts = bucket_runs(pair, bits)
        cuts = list(zip(starts, np.append(starts[1:], len(pair)), strict=True))
        return pa.Table.from_batches([batch_of(PAIRS_ARROW, (bucket, np.full(len(cuts), texts["shard"][0].as_py()),
                                                             [packed(np.diff(pair[a:b], prepend=0)) for a, b in cuts], [packed(size[a:b]) for a, b in cuts]))])
    return run


def frequent_pairs(least: int):
    """For each shard of a bucket the hashes that occur ``least`` times in all,
    packed like those of :func:`pairs`: a row a shard at most."""
    def run(table: pa.Table) -> pa.Table:
        found = [np.cumsum(unpacked(x, np.int64)) for x in table["pairs"].to_pylist()]
        counts = np.concatenate([unpacked(x, np.int32) for x in table["counts"].to_pylist()])
        kinds, which = np.unique(np.concatenate(found), return_inverse=True)
        frequent = np.bincount(which, weights=counts)[which] >= least      # sums of whole numbers, exact up to 2^53
        kept = [x[good] for x, good in zip(found, np.split(frequent, np.cumsum([len(x) for x in found])[:-1]), strict=True)]
        rows = [(shard, packed(np.diff(x, prepend=0))) for shard, x in zip(table["shard"].to_pylist(), kept, strict=True) if len(x)]
        return pa.Table.from_batches([batch_of(KEPT_ARROW, ([x for x, _ in rows], [x for _, x in rows]))])
    return run


def cut_at(text: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """``text`` without the words that are joined to neither neighbour
    (``joined``: each word to the next), with breaks where words are not joined."""
    live = joined.copy()
    live[1:] |= joined[:-1]
    kept, after = text[live], joined[live]
    out = np.zeros(len(kept) + int((~after).sum()) + 1, text.dtype)
    out[1 + np.arange(len(kept)) + np.cumsum(~after) - ~after] = kept
    return out


def built(depth: int, bits: int):
    """Indexes of a shard, and its phrases of two frequent words."""
    def run(texts: pa.Table, given: pa.Table) -> pa.Table:
        if not texts.num_rows or not given.num_rows:
            return LEVEL_ARROW.empty_table()
        shard = texts["shard"][0].as_py()
        kept = given["pairs"].drop_null().to_pylist()
        if not kept:
            return LEVEL_ARROW.empty_table()
        pair = np.sort(np.concatenate([np.cumsum(unpacked(x, np.int64)) for x in kept]))
        text, names = frequent_text(texts, given["at"].drop_null().to_numpy(), given["name"].drop_null().to_numpy())
        joined = np.zeros(len(text), bool)
        both = np.flatnonzero((text[:-1] != 0) & (text[1:] != 0))
        found = hashed(names[text[both]], names[text[both + 1]])
        joined[both] = pair[np.minimum(np.searchsorted(pair, found), len(pair) - 1)] == found
        text = cut_at(text, joined)
        if len(text) < 2:
            return LEVEL_ARROW.empty_table()
        n = np.bincount(text, minlength=len(names))
        low = np.cumsum(n) - n
        found = Index.of(text, depth).extended(low[1:], low[1:], n[1:], names[1:])
        kept = batch_of(LEVEL_ARROW, ([None], [shard], [None], [text.dtype.itemsize > 2], [packed(text)]))
        return pa.Table.from_batches([kept, extensions(shard, found, bits)])
    return run


def grown(depth: int, bits: int):
    """Phrases of a shard that are one word longer than the frequent ones."""
    def run(texts: pa.Table, frequent: pa.Table) -> pa.Table:
        if not texts.num_rows or not frequent.num_rows:
            return LEVEL_ARROW.empty_table()
        text = unpacked(texts["text"][0].as_py(), np.uint32 if texts["wide"][0].as_py() else np.uint16)
        rows, _ = unpacked_rows(frequent["rows"].to_pylist(), 4)
        found = Index.of(text, depth).extended(*rows[:, np.argsort(rows[0])])
        return pa.Table.from_batches([extensions(texts["shard"][0].as_py(), found, bits)])
    return run


# ---------------------------------------------------------------------------
# Levels
# ---------------------------------------------------------------------------

def named(words: DataFrame, least: int) -> DataFrame:
    """Words of ``least`` occurrences. ``f``: the sum of ``n`` over all shards;
    ``name``: the same number for all rows of a word (that of its least shard and
    place there); ``first`` marks one row a word."""
    over = Window.partitionBy("lang", "word")
    # Only the place is shuffled: it holds the shard and the place there.
    place = F.shiftleft(F.col("shard"), 31).bitwiseOR(F.col("at").cast("long"))
    summed = (words.select(place.alias("place"), "lang", "word", "n").withColumn("f", F.sum("n").over(over)).withColumn("name", F.min("place").over(over))
              .where(F.col("f") >= least))
    return summed.select(F.shiftright("place", 31).alias("shard"), F.col("place").bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("at"),
                         "lang", "word", "n", "f", "name", (F.col("place") == F.col("name")).alias("first"))


def drop(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    drop_scratch(tables[0].sparkSession, *{f.rpartition("/")[0] for table in tables for f in table.inputFiles()})


def frequent_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100, most_words: int = 5,
                     shard_words: int = 3_000_000) -> tuple[DataFrame, list[DataFrame]]:
    """``lang``, ``total`` (word occurrences); and for each number of words a
    table of the frequent phrases: ``name``, ``lang``, ``words``, ``f``, and
    the counts ``heads`` and ``tails`` of their first and last 1, 2, ... words."""
    if most_words < 2 or least < 1:
        raise ValueError("most_words must be at least 2 and least at least 1")
    made = solid(shards(docs, text_col, lang_col, shard_words), "phrases-shards")
    words, texts = made.where("text IS NULL").drop("text"), made.where("text IS NOT NULL").select("shard", "text")
    totals = solid(words.groupBy("lang").agg(F.sum("n").alias("total")), "phrases-totals")
    now = solid(named(words, least), "phrases-words", THIN_ROWS)
    levels = [solid(now.where("first").select("name", "lang", F.array("word").alias("words"), "f", F.array("f").alias("heads"), F.array("f").alias("tails")),
                    "phrases-1", THIN_ROWS)]
    numbers = now.select("shard", "at", "name")
    by_shard = texts.groupBy("shard")
    # About PAIRS_PER_BUCKET pairs meet in a task; a shard has no more rows than pairs.
    words_left = now.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = min(30, max(0, (words_left // PAIRS_PER_BUCKET).bit_length()))
    counted = by_shard.cogroup(numbers.groupBy("shard")).applyInArrow(pairs(bits), PAIRS)
    kept = solid(counted.groupBy("bucket").applyInArrow(frequent_pairs(least), KEPT), "phrases-pairs", THIN_ROWS)
    rows = by_shard.cogroup(numbers.unionByName(kept, allowMissingColumns=True).groupBy("shard")).applyInArrow(built(most_words, bits), LEVEL)
    used = (made, now, kept)
    for size in range(2, most_words + 1):
        extended = solid(rows, "phrases-extended", THIN_ROWS)
        drop(*used)
        if size == 2:
            left = solid(extended.where("text IS NOT NULL").select("shard", "wide", "text"), "phrases-texts")
        buckets = extended.where("rows IS NOT NULL").select("bucket", "shard", "rows").groupBy("bucket")
        now = solid(buckets.applyInArrow(frequent_rows(least), FREQUENT), "phrases-frequent", THIN_ROWS)
        drop(extended)
        used = (now,)
        rows = left.groupBy("shard").cogroup(now.where("rows IS NOT NULL").select("shard", "rows").groupBy("shard")).applyInArrow(grown(most_words, bits), LEVEL)
        h, t = levels[-1].alias("h"), levels[-1].alias("t")
        own = now.where("rows IS NULL").select("name", "prefix", "suffix", "f").alias("p")
        linked = own.join(h, F.col("p.prefix") == F.col("h.name")).join(t, F.col("p.suffix") == F.col("t.name"))
        levels.append(solid(linked.select("p.name", "p.prefix", "p.suffix", F.col("h.lang").alias("lang"),
                                          F.concat("h.words", F.slice("t.words", -1, 1)).alias("words"), "p.f",
                                          F.concat("h.heads", F.array("p.f")).alias("heads"),
                                          F.concat("t.tails", F.array("p.f")).alias("tails")), f"phrases-{size}", THIN_ROWS))
    drop(now, left)
    return totals, levels


def with_extensions(level: DataFrame, longer: DataFrame | None) -> DataFrame:
    """``level`` with ``left`` and ``right``: the greatest count among its
    frequent extensions by one word (null without any)."""
    if longer is None:
        none = F.lit(None).cast("long")
        return level.select("*", none.alias("left"), none.alias("right"))
    ends = (longer.select(F.col("suffix").alias("of"), F.col("f").alias("left"), F.lit(None).cast("long").alias("right"))
            .unionByName(longer.select(F.col("prefix").alias("of"), F.lit(None).cast("long").alias("left"), F.col("f").alias("right")))
            .groupBy("of").agg(F.max("left").alias("left"), F.max("right").alias("right")))
    return level.join(ends, level["name"] == ends["of"], "left").drop("of")


def best_cut(total: Column) -> Column:
    """The cut of lowest score, at the fewest first words: ``score``, ``cut``, ``l``, ``r``."""
    def exact(c: Column) -> Column:
        return c.cast("decimal(38,0)")

    def cut(i: Column) -> Column:
        l, r = F.get("heads", i - 1), F.get("tails", F.size("heads") - i - 1)
        score = F.call_function("div", exact(F.lit(1000).cast("decimal(4,0)") * F.col("f").cast("decimal(17,0)") * total.cast("decimal(17,0)")),
                                exact(l.cast("decimal(18,0)") * r.cast("decimal(18,0)")))
        return F.struct(score.cast("long").alias("score"), i.cast("int").alias("cut"), l.alias("l"), r.alias("r"))
    return F.array_min(F.transform(F.sequence(F.lit(1), F.size("heads") - 1), cut))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100, most_words: int = 5,
                 top: int = 2000, shard_words: int = 3_000_000) -> DataFrame:
    """The ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``,
    ``a``, ``l``, ``r``, ``n``, ``score``, ``cut`` (words before the cut)."""
    with shuffles_dropped(docs.sparkSession):
        totals, levels = frequent_phrases(docs, text_col, lang_col, least, most_words, shard_words)
    found = None
    for level, longer in zip(levels[1:], [*levels[2:], None], strict=True):
        # An extension of the same count makes the shorter phrase part of a longer candidate.
        part = with_extensions(level, longer).where(F.greatest(F.coalesce("left", F.lit(0)), F.coalesce("right", F.lit(0))) < F.col("f")).select("lang", "words", "f", "heads", "tails")
        found = part if found is None else found.unionByName(part)
    scored = found.join(totals, "lang").withColumn("best", best_cut(F.col("total")))
    scored = scored.select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "best.l", "best.r",
                           F.col("total").alias("n"), "best.score", "best.cut")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut")
