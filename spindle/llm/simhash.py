"""SimHash near-duplicates through a byte-position inverted index.

A fingerprint has 8 positional bytes. Two fingerprints that differ in at most
``max_bits`` = 4 bits agree in at least 8 - 4 = 4 positional bytes, the
guaranteed minimum of the count filter. The index lists fingerprints under their
positional bytes. Within a list, the shared positional bytes of each pair are
tallied; pairs that reach the minimum are retained and verified by their
differing bits.

A list of a single (position, byte) holds about 1/256 of all fingerprints, and
its pairs grow with the square of that. So a list stands for ``width``
(position, byte) entries at once: the smallest width that keeps an average list
within ``block``, 1 for up to 256 blocks of distinct fingerprints, 2 for up to
65,536 and so on. A pair that reaches the minimum m meets in every set of
``width`` of its shared bytes, for any width up to m, so the width changes the
work and not the result.

Skew: equal fingerprints are one entry; a list longer than ``block`` is cut
into blocks, and the pairs of blocks go to different tasks. No task emits
pairs: it gives each list's spanning stars, at most one row per member.
Components come from alternating large-star and small-star joins; their ids
reach the members by a salted join.

Nulls and edges: null or empty text has the fingerprint zero and is linked
like any other; a null id takes part, is never a component's smallest id, and
a component without any id has a null component id; repeated rows share a
fingerprint; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import THIN_ROWS, Batches, batch_of, blobs, solid

BYTES = 8
CHUNK = 65_536
SALTS = 16
EDGE_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def simhash64(text: bytes | None, shingle: int = 4, seed: int = 42) -> int:
    """The fingerprint as an unsigned integer. Shingles are hashed in runs of
    CHUNK, so the working memory does not follow the text's length."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter((len(w) + 1 for w in words), np.int64, len(words))) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    del words
    last = ends[min(shingle, len(ends)) - 1:]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        s, e = starts[at:min(at + CHUNK, n)].tolist(), last[at:at + CHUNK].tolist()
        hs = np.fromiter((digest(joined[i:j], seed) for i, j in zip(s, e, strict=True)), np.uint64, len(s))
        counts += np.unpackbits(hs.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 4, *keep: Column) -> DataFrame:
    """``keep`` columns (longs or booleans) and ``fp`` (the 64 bits as a
    signed long) of every row."""
    source = docs.select(*keep, F.col(text_col).cast("string").alias("__text"))
    kept = source.schema.fields[:-1]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["fp long"])

    def run(batches: Batches) -> Batches:
        for b in batches:
            fps = np.array([simhash64(t, shingle) for t in blobs(b, "__text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fps)], names=[*(f.name for f in kept), "fp"])
    return source.mapInArrow(run, schema)


def list_width(n: int, block: int, most: int) -> int:
    """Positional bytes that a list stands for, so that an average list of ``n``
    fingerprints is within ``block``; at most ``most``."""
    width = 1
    while width < most and n > block * 256 ** width:
        width += 1
    return width


def posting_keys(fp: Column, width: int) -> Column:
    """Every list the fingerprint stands in: one per set of ``width`` byte
    positions (the set's number, and a hash of these bytes when they are more
    than fit beside it)."""
    byte = [F.shiftrightunsigned(fp, 8 * i).bitwiseAND(F.lit(255)) for i in range(BYTES)]
    keys = []
    for number, chosen in enumerate(itertools.combinations(range(BYTES), width)):
        if width <= 6:
            key = F.lit(number)
            for i in chosen:
                key = F.shiftleft(key.cast("long"), 8).bitwiseOR(byte[i])
        else:
            key = F.xxhash64(F.lit(number), *(byte[i] for i in chosen))
        keys.append(key.cast("long"))
    return F.array(*keys)


LOW7, HIGH1 = np.uint64(0x7F7F7F7F7F7F7F7F), np.uint64(0x8080808080808080)


def shared_bytes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Tally of equal positional bytes of each pair: the zero bytes of a ^ b."""
    x = a ^ b
    x = ((x & LOW7) + LOW7) | x          # the high bit of every byte that is not zero
    return BYTES - np.bitwise_count(x & HIGH1)


def components_of_pairs(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member index reachable, per member."""
    lab = np.arange(n)
    while True:
        new, low = lab.copy(), np.minimum(lab[a], lab[b])
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if np.array_equal(new, lab):
            return lab
        lab = new


def star_links(keys: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Stars over the verified pairs of each run of equal ``keys`` (sorted).
    Offset by offset: all members are held against the d-th next of their
    run, and runs that have no member so far apart have ended. A pair is
    retained by its tally of shared positional bytes, then verified."""
    left, right = [], []
    alive = np.arange(len(keys) - 1) if len(keys) else np.empty(0, np.int64)
    d = 1
    while len(alive):
        alive = alive[alive + d < len(keys)]
        alive = alive[keys[alive] == keys[alive + d]]
        held = alive[shared_bytes(fps[alive], fps[alive + d]) >= BYTES - max_bits]
        near = held[np.bitwise_count(fps[held] ^ fps[held + d]) <= max_bits]
        left.append(near)
        right.append(near + d)
        d += 1
    if not left:
        return fps[:0], fps[:0]
    a, b = np.concatenate(left), np.concatenate(right)
    if not len(a):
        return fps[:0], fps[:0]
    lab = components_of_pairs(len(keys), a, b)
    held = np.flatnonzero(lab != np.arange(len(keys)))
    return fps[held], fps[lab[held]]


def links(fps: DataFrame, max_bits: int = 4, block: int = 2048) -> DataFrame:
    """Connecting links (``a``, ``b``) between distinct fingerprints (column
    ``fp``): everything within ``max_bits`` (0 to 7) is connected, and nothing
    else is."""
    if not 0 <= max_bits < BYTES:
        raise ValueError("max_bits must be 0 to 7: each may spoil one of 8 bytes")
    width = list_width(fps.count(), block, BYTES - max_bits)
    # Distinct fingerprints are few bytes, which AQE would put into few tasks;
    # each becomes C(8, width) rows here, so they are dealt out again.
    spread = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    post = fps.repartition(spread).select("fp", F.explode(posting_keys(F.col("fp"), width)).alias("key"))
    hot = solid(post.groupBy("key").count().where(F.col("count") > block)
                .select("key", F.ceil(F.col("count") / block).cast("int").alias("blocks")), "simhash-hot")
    # A member of a long list goes to every pair of blocks that has its own.
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    post = (post.join(hot, "key", "left")
            .select("key", "fp", F.when(F.col("blocks").isNull(), F.array(F.lit(0)))
                    .otherwise(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                                           lambda j: F.least(j, own) * F.col("blocks") + F.greatest(j, own)))
                    .alias("cells"))
            .select("key", "fp", F.explode("cells").alias("cell"))
            .repartition("key", "cell").sortWithinPartitions("key", "cell"))

    def run(batches: Batches) -> Batches:
        def out(group, fp):
            if len(group):
                a, b = star_links(group, fp, max_bits)
                if len(a):
                    yield batch_of(EDGE_SCHEMA, (pa.array(a.view(np.int64)), pa.array(b.view(np.int64))))

        rest: list[np.ndarray] = [np.empty(0, np.int64)] * 2 + [np.empty(0, np.uint64)]
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(0).to_numpy(), batch.column(1).to_numpy(),
                    batch.column(2).to_numpy().view(np.uint64)]
            cols = [np.concatenate(x) for x in zip(rest, cols, strict=True)]
            runs = np.cumsum(np.concatenate(([0], (np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0))))
            cut = int(np.searchsorted(runs, runs[-1]))  # the last run may go on in the next batch
            yield from out(runs[:cut], cols[2][:cut])
            rest = [c[cut:] for c in cols]
        yield from out(np.zeros(len(rest[2]), np.int64), rest[2])

    return (post.select("key", F.col("cell").cast("long").alias("cell"), "fp")
            .mapInArrow(run, "a long, b long").distinct())


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """``node``, ``root`` (the component's smallest node) of every node in
    ``edges`` (``a``, ``b``). Large-star and small-star rounds; each round is
    written to the shared checkpoint folder."""
    def oriented(e: DataFrame) -> DataFrame:
        return (e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                .where("a <> b").distinct())

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else e
        low = both.groupBy("a").agg(F.min("b").alias("low"))
        low = low.select("a", F.least("a", "low").alias("low")) if large else low
        met = both.join(low, "a")
        if large:
            return oriented(met.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")))
        return oriented(met.select(F.col("b").alias("a"), F.col("low").alias("b"))
                        .unionByName(low.select("a", F.col("low").alias("b"))))

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = solid(oriented(edges), "components", THIN_ROWS)
    was = state(now)
    for _ in range(max_rounds):
        if not was[0]:
            break
        now = solid(star(star(now, True), False), "components")
        new = state(now)
        if new == was:
            break
        was = new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return (now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, max_bits: int = 4, block: int = 2048) -> DataFrame:
    """``doc_id``, ``fp``, ``component_id``: the smallest id reachable by
    links of at most ``max_bits`` differing bits."""
    prints = solid(fingerprints(docs, text_col, shingle, F.col(id_col).cast("long").alias("doc_id")), "simhash-prints")
    kinds = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    roots = solid(components(links(kinds.select("fp"), max_bits, block)), "simhash-roots")
    of_kind = kinds.join(roots, kinds["fp"] == roots["node"], "left").select("fp", "least_id", "root")
    linked = of_kind.where("root IS NOT NULL")
    # A component may hold any number of fingerprints: its id goes to SALTS parts of it.
    least = linked.groupBy("root").agg(F.min("least_id").alias("component_id")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = (linked.withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int")).join(least, ["root", "salt"])
             .select(F.col("fp").alias("kind"), "component_id")
             .unionByName(of_kind.where("root IS NULL").select(F.col("fp").alias("kind"), F.col("least_id").alias("component_id"))))
    return (prints.join(named, prints["fp"] == named["kind"])
            .select("doc_id", "fp", "component_id"))


def fp_hex(fp: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
             max_bits: int = 4, block: int = 2048) -> DataFrame:
    """The rows of ``docs``, one of each component: the one of smallest
    (id, text hash), nulls last; of repeated such rows any one. The choice is
    a combinable minimum, so a large component never meets in one task."""
    none, number = F.col(id_col).isNull(), F.coalesce(F.col(id_col).cast("long"), F.lit(0))
    key = {"none": none, "number": number, "text_hash": F.xxhash64(F.col(text_col).cast("string"))}
    prints = solid(fingerprints(docs, text_col, shingle, *(c.alias(k) for k, c in key.items())), "simhash-rows")
    kinds = solid(prints.select("fp").distinct(), "simhash-kinds")
    roots = solid(components(links(kinds, max_bits, block)), "simhash-roots")
    first = (prints.join(roots, prints["fp"] == roots["node"], "left")
             .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min(F.struct(*key)).alias("least"))
             .select("least.*"))
    keyed = docs.select(F.struct("*").alias("row"), *(c.alias(k) for k, c in key.items()))
    return keyed.join(first, [*key], "left_semi").dropDuplicates([*key]).select("row.*")
