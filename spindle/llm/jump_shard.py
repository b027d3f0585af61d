"""Sharding by jump consistent hashing.

A key jumps from bucket to bucket, each jump drawn from a generator that the
key seeds; its shard is the last bucket below the number of shards. No ring
table exists, the law is a function of key and shard count alone, and with one
more shard a key either stays or moves into the new shard. DataFrame
expressions only: the generator's 64-bit products are exact decimals.

Slots number the rows of a shard without gaps. Equal rows (same key, size and
checksum) are counted before they meet, ranked as one, and dealt out again in
runs of bounded length, so neither a hot key nor a large shard falls to one
task: a shard is ranked in ``parts`` hash parts, and each part starts where the
counts of those before it end.

Nulls and edges: a null key is the key -1; a null text has no bytes and the
checksum 0; repeated rows share the shard and get slots of their own; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindle.llm.common import solid

# The generator of the published jump consistent hash.
MULTIPLIER = 2862933555777941757
INCREMENT = 1
RUN = 100_000


def jump(key: Column, shards: int) -> Column:
    """Struct ``shard`` (below ``shards``), ``grown`` (with one shard more)."""
    if shards < 1:
        raise ValueError("shards must be at least 1")

    def advance(k: Column) -> Column:
        product = k * F.lit(MULTIPLIER).cast("decimal(19,0)") + F.lit(INCREMENT).cast("decimal(1,0)")
        return (product % F.expr("18446744073709551616BD")).cast("decimal(20,0)")

    def target(b: Column, k: Column) -> Column:
        draw = F.floor(k / F.expr("8589934592BD")).cast("double")          # the upper 31 bits
        return F.floor((b + 1) * (F.lit(2147483648.0) / (draw + 1))).cast("long")

    def state(before: Column, b: Column, k: Column) -> Column:
        return F.struct(before.cast("long").alias("before"), b.cast("long").alias("b"), k.alias("k"))

    def step(a: Column, _: Column) -> Column:
        to = target(a["b"], a["k"])
        return F.when(to <= shards, state(a["b"], to, advance(a["k"]))).otherwise(a)

    number = F.coalesce(key.cast("long"), F.lit(-1)).cast("decimal(20,0)")
    unsigned = F.when(number < 0, number + F.expr("18446744073709551616BD")).otherwise(number).cast("decimal(20,0)")
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(shards)), state(F.lit(-1), F.lit(0), advance(unsigned)), step,
        lambda a: F.struct(F.when(a["b"] == shards, a["before"]).otherwise(a["b"]).cast("int").alias("shard"),
                           a["b"].cast("int").alias("grown")))


def assign(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
           overhead: int = 16, parts: int | None = None) -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes and ``overhead``), ``text_crc32``,
    ``shard``, ``slot``, ``grown_shard`` of every row."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    row = ["doc_id", "size", "text_crc32"]
    kinds = (docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         (F.octet_length(text).cast("long") + overhead).alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"))
             .groupBy(*row).agg(F.count("*").alias("n")))
    kinds = solid(kinds.select(*row, "n", jump(F.col("doc_id"), shards).alias("to"))
                  .select(*row, "n", "to.*", F.pmod(F.xxhash64(*row), F.lit(parts)).cast("int").alias("part")), "shard-kinds")
    cell = ["shard", "part"]
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (kinds.groupBy(*cell).agg(F.sum("n").alias("rows"))
              .select(*cell, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start")))
    own = Window.partitionBy(*cell).orderBy(F.col("doc_id").asc_nulls_first(), "size", "text_crc32")
    placed = (kinds.withColumn("own", F.sum("n").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
              .join(starts, cell)
              .select(*row, "shard", "grown", (F.col("start") + F.col("own")).alias("slot"), "n"))
    runs = placed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN).cast("long"))).alias("run"))
    runs = runs.repartition(parts, "shard", "slot", "run")
    each = F.explode(F.sequence(F.col("run"), F.least(F.col("run") + RUN, F.col("n")) - 1)).alias("copy")
    return runs.select("*", each).select(*row, "shard", (F.col("slot") + F.col("copy")).alias("slot"),
                                         F.col("grown").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int, id_col: str = "doc_id", files_per_shard: int = 1) -> None:
    """Whole rows as Parquet under ``path``/shard=N, each shard written by
    ``files_per_shard`` tasks. The folders are read back as a column ``shard``,
    so ``docs`` must not have one (ValueError)."""
    if "shard" in (c.lower() for c in docs.columns):
        raise ValueError("docs has a column shard, which the folders' names would replace: rename it")
    salt = F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns if docs.schema[c].dataType.typeName() != "map")),
                  F.lit(files_per_shard))
    (docs.withColumn("shard", jump(F.col(id_col), shards)["shard"])
     .repartition(shards * files_per_shard, "shard", salt).write.partitionBy("shard").parquet(path))
