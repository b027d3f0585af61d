"""Substring dedup by a sparse De Bruijn graph of token k-mers.

Each window of ``width`` words elects one of its ``k``-mers, the one of least
hash (leftmost of equals), so equal windows elect equal k-mers wherever they
stand. A run of windows with one elected occurrence is an edge: its *node* is
the k-mer's hash and its *path* the digest of the whole token span under these
windows. Only elected k-mers are shuffled, about 2 / (width - k + 2) of the
words.

Compaction, all by Spark joins: occurrences of one (node, path) are one
nonbranching path, all of whose windows stand in its least document, so each
later document loses the span without looking at its windows. Only where a
node branches (several paths) one occurrence of each path, found by its source
coordinates, is opened into windows, and these are verified by their own
digests. Spans that meet in a document merge into long ones when its words are
cut.

Two windows count as equal if node (64 bits) and path or window digest (64
independent bits) agree.

Skew: a path that many documents share is reduced by combinable minima, and
salted in the joins on (node, path). What meets per
document is bounded by its own length.

Nulls and edges: null, empty and short texts (under ``width`` words) keep all
words; a null id has no order, so such a row neither loses words nor makes
others lose any; rows that repeat an id are documents of equal id and do not
shorten each other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import Batches, batch_of, blobs, small_batches, solid

BASE = 0x9E3779B97F4A7C15
CHUNK = 1 << 16
U = np.uint64
#: What is shuffled most is packed into four longs: the last bits of a path
#: are its length less the width, a place is the text's hash and the first word.
LENGTH_BITS, START_BITS = 6, 31
EDGES = pa.schema([(c, pa.int64()) for c in ("node", "path", "did", "place")])
WINDOWS = pa.schema([("node", pa.int64()), ("seen", pa.int64()), ("did", pa.int64()), ("path", pa.int64()),
                     ("off", pa.int32())])
KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                  ("kept_sha256", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit integers."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Rolling:
    """Digests of any spans of a text's words, from running sums of
    ``word * BASE^i`` modulo 2^64."""

    def __init__(self, words: np.ndarray, powers: np.ndarray, inverse: np.ndarray):
        self.sums = np.concatenate((np.zeros(1, U), np.cumsum(words * powers[:len(words)], dtype=U)))
        self.inverse = inverse

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])


class Powers:
    """BASE^i and BASE^-i, grown as longer texts come."""

    def __init__(self):
        self.up, self.down = np.ones(1, U), np.ones(1, U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 4096)
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                steps = np.full(size, base, U)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


def rollings(words: list[bytes], powers: Powers) -> tuple[Rolling, Rolling]:
    """Two independent digests: one for nodes, one for paths and windows."""
    digest = xxhash.xxh3_64_intdigest
    one = np.fromiter(map(digest, words), U, len(words))
    up, down = powers.upto(len(words) + 1)
    return Rolling(one, up, down), Rolling(mix(one ^ U(0xD6E8FEB86659FD93)), up, down)


def edges_of(words: list[bytes], width: int, k: int, powers: Powers):
    """(node, path, start) of each run of windows."""
    if len(words) < width:
        return None
    nodes, paths = rollings(words, powers)
    at = np.arange(len(words) - k + 1)
    grams = nodes.spans(at, at + k)
    per = width - k + 1
    n = len(grams) - per + 1
    picked = np.concatenate([
        np.arange(i, min(i + CHUNK, n)) + sliding_window_view(grams[i:min(i + CHUNK, n) + per - 1], per).argmin(1)
        for i in range(0, n, CHUNK)])
    first = np.flatnonzero(np.concatenate(([True], picked[1:] != picked[:-1])))
    last = np.concatenate((first[1:], [len(picked)])) - 1
    end = last + width
    label = mix(paths.spans(first, end) + (picked[first] - first).astype(U) * U(BASE))
    label = (label << U(LENGTH_BITS)) | (end - first - width).astype(U)
    return grams[picked[first]].view(np.int64), label.view(np.int64), first.astype(np.int64)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows by non-null keys: ``did`` and the text's hash ``th`` (it parts rows
    that repeat an id)."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("did"),
                       F.shiftrightunsigned(F.xxhash64(F.col(text_col).cast("string")), 32).alias("th"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def edges(rows: DataFrame, width: int, k: int) -> DataFrame:
    def run(batches: Batches) -> Batches:
        powers = Powers()
        for b in batches:
            out = [[], [], [], []]
            for did, th, text in zip(b.column("did").to_pylist(), b.column("th").to_pylist(), blobs(b, "text"), strict=True):
                found = edges_of(text.split(), width, k, powers)
                if found:
                    n = len(found[0])
                    for column, x in zip(out, (*found[:2], np.full(n, did), (th << START_BITS) + found[2]), strict=True):
                        column.append(x)
            if out[0]:
                yield batch_of(EDGES, (pa.array(np.concatenate(c)) for c in out))
    return (rows.where("doc_id IS NOT NULL").select("did", "th", "text")
            .mapInArrow(run, "node long, path long, did long, place long"))


def unpacked(seen: DataFrame, width: int, *keep: str) -> DataFrame:
    """``did``, ``th``, ``start`` and ``len`` of packed occurrences."""
    return seen.select("did", F.shiftrightunsigned("place", START_BITS).alias("th"),
                       F.col("place").bitwiseAND(F.lit((1 << START_BITS) - 1)).cast("int").alias("start"),
                       (F.col("path").bitwiseAND(F.lit((1 << LENGTH_BITS) - 1)) + width).cast("int").alias("len"), *keep)


def open_windows(rows: DataFrame, width: int) -> DataFrame:
    """Digest of every window in the ``spans`` of each row."""
    def run(batches: Batches) -> Batches:
        powers = Powers()
        for b in batches:
            for did, text, spans in zip(b.column("did").to_pylist(), blobs(b, "text"), b.column("spans").to_pylist(), strict=True):
                _, paths = rollings(text.split(), powers)
                start = np.array([s["start"] for s in spans])
                count = np.array([s["len"] for s in spans]) - width + 1
                off = np.concatenate([np.arange(c) for c in count])
                at = np.repeat(start, count) + off
                repeat = lambda name: np.repeat(np.array([s[name] for s in spans], np.int64), count)
                yield batch_of(WINDOWS, (pa.array(repeat("node")), pa.array(paths.spans(at, at + width).view(np.int64)),
                                         pa.array(np.full(len(at), did)), pa.array(repeat("path")), pa.array(off.astype(np.int32))))
    return rows.mapInArrow(run, "node long, seen long, did long, path long, off int")


def cut(rows: DataFrame, width: int) -> DataFrame:
    """Remove each row's ``hits`` from its words."""
    def run(batches: Batches) -> Batches:
        for b in batches:
            out = []
            for doc_id, text, hits in zip(b.column("doc_id").to_pylist(), blobs(b, "text"), b.column("hits").to_pylist(), strict=True):
                words = text.split()
                n, spans = len(words), []
                if hits:
                    edge = np.zeros(n + 1, np.int64)
                    for h in hits:
                        offs = [0] if h["flags"] < 0 else [j for j in range(64) if h["flags"] >> j & 1]
                        size = h["len"] if h["flags"] < 0 else width
                        for j in offs:
                            edge[h["start"] + j] += 1
                            edge[h["start"] + j + size] -= 1
                    gone = np.cumsum(edge[:-1]) > 0
                    turns = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0])))).tolist()
                    spans = [{"start": s, "end": e} for s, e in zip(turns[::2], turns[1::2], strict=True)]
                    words = list(compress(words, ~gone))
                out.append((doc_id, n, n - len(words), hashlib.sha256(b" ".join(words)).hexdigest(), spans))
            yield batch_of(KEPT, zip(*out, strict=True) if out else [[]] * len(KEPT))
    return rows.mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:int,end:int>>")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 50,
                   k: int = 12) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and the removed
    word ``spans`` of every row: each word goes that lies in a window whose
    words also start in a document of smaller id."""
    if not 0 < width - k < 63:
        raise ValueError("width must exceed k by 1 to 62")
    small_batches(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    seen = solid(edges(rows, width, k), "debruijn-edges")
    paths = seen.groupBy("node", "path").agg(F.min("did").alias("first"), F.max("did").alias("last"), F.count("*").alias("n"))
    branching = (paths.groupBy("node").agg(F.count("*").alias("paths"), F.min("first").alias("lo"), F.max("first").alias("hi"))
                 .where("paths > 1 AND lo < hi").select("node", F.lit(True).alias("branches")))
    shared = solid(paths.join(branching, "node", "left").where("branches OR first < last")
                   .select("node", "path", "first", "n", F.col("branches").isNotNull().alias("branches")), "debruijn-shared")
    # Paths with more than a partition's share of the occurrences are fewer than
    # there are partitions: a bounded list. Each is dealt out by a salt.
    share = max(1000, seen.count() // int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot = {r["path"]: r["n"] for r in shared.where(F.col("n") > share).select("path", "n").collect()}
    is_hot = F.col("path").isin(list(hot)) if hot else F.lit(False)
    ways = -(-max(hot.values(), default=1) // share)
    seen = seen.withColumn("salt", F.when(is_hot, F.pmod(F.xxhash64("did", "place"), F.lit(ways))).otherwise(0).cast("int"))
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(ways - 1))).otherwise(F.array(F.lit(0)))
    salted = lambda table: table.withColumn("salt", F.explode(every))
    key = ["node", "path", "salt"]
    # Where a node branches: open one occurrence of each of its paths.
    # (``did <= first`` says ``did = first``, but leaves the join the keys of the
    # one below, so that both read one shuffle of the occurrences.)
    sources = (unpacked(seen.join(salted(shared.where("branches")), key).where("did <= first"), width, "node", "path")
               .groupBy("did", "th").agg(F.collect_list(F.struct("node", "path", "start", "len")).alias("spans")))
    windows = open_windows(rows.join(sources, ["did", "th"]), width)
    least = windows.groupBy("node", "seen").agg(F.min("did").alias("least"))
    again = (windows.join(least, ["node", "seen"]).where("least < did")
             .groupBy("node", "path").agg(F.bit_or(F.expr("shiftleft(1L, off)")).alias("flags")))
    judged = shared.join(again, ["node", "path"], "left").select("node", "path", "first", "flags")
    hits = unpacked(seen.join(salted(judged), key).where("did > first OR flags IS NOT NULL"), width, "first", "flags")
    hits = (hits.select("did", "th", F.struct("start", "len", F.when(F.col("did") > F.col("first"), F.lit(-1).cast("long"))
                                              .otherwise(F.col("flags")).alias("flags")).alias("hit"))
            .groupBy("did", "th").agg(F.collect_list("hit").alias("hits")))
    return cut(rows.join(hits, ["did", "th"], "left"), width)
