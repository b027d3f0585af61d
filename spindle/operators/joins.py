"""Join helpers: null-safe keys, and broadcasts only behind a size check.

Titles may be null (a document without a title is a document), so joins on
titles compare null-safely; :func:`join_null_safe` is the one place for that.

``F.broadcast`` is used directly only for inputs with a proven bound (the
terms of one query string). Anything whose size grows with the data goes
through :func:`broadcast_if_small`: it is first written as a Parquet table in
the shared checkpoint folder (which also cuts lineage, so a lost executor does
not recompute the whole upstream plan), then its rows and bytes are measured,
and only a side under both limits is broadcast. Above them the caller's plain
join runs as a shuffle join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindle.session import scratch_path

BROADCAST_ROWS_CONF = "spindle.broadcast.maxRows"
BROADCAST_BYTES_CONF = "spindle.broadcast.maxBytes"
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 128 << 20


def broadcast_limits(df: DataFrame) -> tuple[int, int]:
    """Most rows and bytes of a broadcast side."""
    conf = df.sparkSession.conf
    return (int(conf.get(BROADCAST_ROWS_CONF, None) or DEFAULT_BROADCAST_ROWS),
            int(conf.get(BROADCAST_BYTES_CONF, None) or DEFAULT_BROADCAST_BYTES))


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as a Parquet table under ``spark.checkpoint.dir`` (the
    cluster's shared folder, never a machine-local one) and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes in memory: strings by their length, and 16
    for each column. Terms and titles have no bound of their own."""
    size = F.lit(16 * len(df.columns)).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            size = size + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
    rows, total = df.agg(F.count(F.lit(1)), F.sum(size)).first()
    return rows, total or 0


def fits_broadcast(df: DataFrame) -> bool:
    rows, size = measure(df)
    most_rows, most_bytes = broadcast_limits(df)
    return rows <= most_rows and size <= most_bytes


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Materialise ``df``; return it with a broadcast hint if its measured size
    is within the limits, else unhinted."""
    solid = materialize(df, "sized")
    return F.broadcast(solid) if fits_broadcast(solid) else solid


def join_null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join on ``on`` where null equals null. The result has the columns of
    ``left`` and, unless ``how`` is a semi or anti join, the other columns of
    ``right``."""
    keys = [f"__right_{c}" for c in on]
    renamed = right.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(on, keys, strict=True)),
                           *(F.col(f"`{c}`") for c in right.columns if c not in on))
    same = reduce(lambda a, b: a & b, (left[c].eqNullSafe(renamed[k]) for c, k in zip(on, keys, strict=True)))
    return left.join(renamed, same, how).drop(*keys)
