"""URL filters by a Bloom filter cascade.

The first level is a Bloom filter of the listed keys. The second holds the
keys of the corpus's universe that the first lets through wrongly, the third
the listed keys that the second lets through, and so on, until nothing passes
wrongly. A key's first level that refuses it tells whether it is listed:
membership is exact for every key of the universe, without a join.

The universe is every distinct key of the corpus that could be listed: host
suffixes, and host suffixes with path prefixes, in the shapes the lists have.
Levels are built by aggregates over key hashes (bit words joined by bit_or),
and broadcast; the first is given fewer bits per key where ``max_bytes`` would
be passed, at the price of more to do for the later ones.

Nulls and edges: a null url or one without ``://`` has an empty host and path,
no key, and the default verdict; a null id is carried; repeated rows repeat; an
empty list refuses all keys; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm.common import THIN_ROWS, Batches, batch_rows, solid

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def positions(h1: np.ndarray, h2: np.ndarray, number: int, size: int, probes: int) -> Iterator[np.ndarray]:
    """Bit positions of keys at a level. Each level has hashes of its own: keys
    that meet in one would else meet in all."""
    step = np.uint64(0x9E3779B97F4A7C15 * (2 * number + 1) % (1 << 64))
    a, b = scramble(h1.view(np.uint64) + step), scramble(h2.view(np.uint64) ^ step) | np.uint64(1)
    for i in range(probes):
        yield (a + np.uint64(i) * b) % np.uint64(size)


@dataclass
class Level:
    bits: np.ndarray      # unsigned 64-bit words
    size: int
    probes: int
    number: int

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Whether all bits of the hash pairs are set."""
        ok = np.ones(len(h1), bool)
        for at in positions(h1, h2, self.number, self.size, self.probes):
            ok &= (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
        return ok


@dataclass
class Cascade:
    levels: list[Level] = field(default_factory=list)

    def member(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        listed = np.zeros(len(h1), bool)
        passing = np.arange(len(h1))
        for number, level in enumerate(self.levels):
            passing = passing[level.has(h1[passing], h2[passing])]
            listed[passing] = number % 2 == 0        # passed an odd number of levels
        return listed


def hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit(7)).alias("h2")]


def make_level(keys: DataFrame, n: int, rate: float, max_bytes: int, number: int) -> Level:
    """A Bloom filter of ``n`` keys (columns h1, h2)."""
    size = max(64, math.ceil(n * math.log(1 / rate) / math.log(2) ** 2))
    size = min(size, max_bytes * 8)
    probes = max(1, round(size / max(1, n) * math.log(2)))
    probes = min(probes, 16)

    def run(batches: Batches) -> Batches:
        for b in batches:
            h1, h2 = (b.column(c).to_numpy() for c in ("h1", "h2"))
            at = np.unique(np.concatenate(list(positions(h1, h2, number, size, probes))))
            word, first = np.unique(at >> np.uint64(6), return_index=True)
            if len(word):
                held = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(held.view(np.int64))], names=["word", "bits"])
    with batch_rows(keys.sparkSession, THIN_ROWS):
        got = (keys.select("h1", "h2").mapInArrow(run, "word long, bits long")
               .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    bits = np.zeros((size + 63) // 64, np.uint64)
    bits[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return Level(bits, size, probes, number)


def build(universe: DataFrame, listed: DataFrame, rate: float = 0.01, max_bytes: int = 64 << 20, max_levels: int = 60) -> Cascade:
    """A cascade that is exact for ``universe`` and ``listed`` (column ``key``)."""
    pair = hashes(F.col("key"))
    yes = solid(listed.select(*pair).distinct(), "cascade-listed")
    no = solid(universe.select(*pair).distinct().join(yes, ["h1", "h2"], "left_anti"), "cascade-universe")
    cascade, encode, refuse = Cascade(), yes, no
    for number in range(max_levels):
        n = encode.count()
        if not n:
            return cascade
        level = make_level(encode, n, rate if number == 0 else 0.5, max_bytes, number)
        cascade.levels.append(level)
        encode, refuse = solid(passing(refuse, level), f"cascade-{number}", THIN_ROWS), encode
    raise RuntimeError(f"the cascade did not end in {max_levels} levels: raise max_bytes")


def passing(keys: DataFrame, level: Level) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast((level.bits, level.size, level.probes, level.number))

    def run(batches: Batches) -> Batches:
        own = Level(*shared.value)
        for b in batches:
            ok = own.has(*(b.column(c).to_numpy() for c in ("h1", "h2")))
            yield b.filter(pa.array(ok))
    return keys.select("h1", "h2").mapInArrow(run, "h1 long, h2 long")


def members(rows: DataFrame, keys: str, cascade: Cascade) -> DataFrame:
    """``rows`` with ``listed``: those of the array column ``keys`` that are members."""
    shared = rows.sparkSession.sparkContext.broadcast([(x.bits, x.size, x.probes, x.number) for x in cascade.levels])
    names = rows.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    each = lambda seed: F.transform(F.col(keys), lambda k: F.xxhash64(k, *seed))
    ready = rows.select("*", each([]).alias("__h1"), each([F.lit(7)]).alias("__h2"))

    def run(batches: Batches) -> Batches:
        own = Cascade([Level(*x) for x in shared.value])
        for b in batches:
            lists = [b.column(c) for c in ("__h1", "__h2")]
            flat = [x.flatten().to_numpy() for x in lists]
            flags = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(x) for x in lists[0]]))).astype(np.int32)),
                                             pa.array(own.member(*flat) if len(flat[0]) else [], pa.bool_()))
            yield pa.RecordBatch.from_arrays([*b.columns[:len(names)], flags], names=[*names, "__is"])
    flagged = ready.mapInArrow(run, schema + ", __is array<boolean>")
    hit = F.filter(F.arrays_zip(F.col(keys).alias("k"), F.col("__is").alias("is")), lambda z: z["is"])
    return flagged.select(*(F.col(f"`{c}`") for c in names), F.transform(hit, lambda z: z["k"]).alias("listed"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """Then up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidate_keys(host: Column, path: Column, shapes: Iterable[tuple[str, int, int | None]]) -> Column:
    """Keys of the given shapes: (tag, last labels of the host, first
    characters of the path, or None for a key without path)."""
    labels = F.split(host, "\\.")
    keys = []
    for tag, n, m in shapes:
        suffix = F.array_join(F.slice(labels, -n, n), ".")
        fits = (host != "") & (F.size(labels) >= n)
        if m is None:
            keys.append(F.when(fits, F.concat(F.lit(f"{tag} "), suffix)))
        else:
            keys.append(F.when(fits & (F.length(path) >= m), F.concat(F.lit(f"{tag} "), suffix, F.left(path, F.lit(m)))))
    return F.array_compact(F.array(*keys)) if keys else F.array().cast("array<string>")


def judge(pages: DataFrame, rules: dict[str, str], listed_hosts: DataFrame, id_col: str = "page_id", url_col: str = "url",
          **limits) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` of every row.

    ``rules`` map ``host/path`` to block or allow; the longest rule that fits
    wins. Without a rule, urls whose host or a parent of it is in
    ``listed_hosts`` (column ``host``, of any number of labels) are blocked."""
    spark: SparkSession = pages.sparkSession
    parts = {r: (r.partition("/")[0], "/" + r.partition("/")[2]) for r in rules}
    shapes = sorted({(len(h.split(".")), len(p)) for h, p in parts.values()})
    lengths = [r["n"] for r in listed_hosts.select(F.size(F.split("host", "\\.")).alias("n")).where("n >= 1").distinct().collect()]
    kinds = [(tag, n, m) for tag in ("rule", "block") for n, m in shapes] + [("host", n, None) for n in sorted(lengths)]
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col).cast("string")).alias("host"),
                        path_of(F.col(url_col).cast("string")).alias("path"))
    keyed = rows.select("*", candidate_keys(F.col("host"), F.col("path"), kinds).alias("keys"))
    stated = [f"rule {r}" for r in rules] + [f"block {r}" for r, v in rules.items() if v == "block"]
    listed = listed_hosts.select(F.concat(F.lit("host "), F.translate("host", UPPER, LOWER)).alias("key"))
    if stated:
        listed = listed.unionByName(spark.createDataFrame([(k,) for k in stated], "key string"))
    cascade = build(keyed.select(F.explode("keys").alias("key")), listed, **limits)
    found = members(keyed, "keys", cascade)
    tagged = lambda tag: F.transform(F.filter("listed", lambda k: k.startswith(f"{tag} ")), lambda k: F.substr(k, F.lit(len(tag) + 2)))
    longest = F.element_at(F.reverse(F.array_sort(F.transform(tagged("rule"), lambda k: F.struct(F.length(k).alias("n"), k.alias("rule"))))), 1)
    chosen = found.select("page_id", "host", "path", "listed", F.when(F.size(tagged("rule")) > 0, longest["rule"]).alias("rule"))
    blocked = F.when(F.col("rule").isNotNull(), F.array_contains(tagged("block"), F.col("rule"))).otherwise(F.size(tagged("host")) > 0)
    return chosen.select("page_id", "host", "path", "rule", F.when(blocked, F.lit("block")).otherwise(F.lit("allow")).alias("verdict"))
