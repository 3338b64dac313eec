"""Measured sizes that choose between plans.

Every broadcast in this package goes through one of these checks; past the limit
the caller takes the shuffling plan instead, so results never depend on the limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

MAX_BROADCAST_ROWS = 100_000           # narrow rows: ids, tokens
MAX_BROADCAST_BYTES = 64 * 1024 * 1024  # wide rows, and the query matrix in each task
BLOCK_BYTES = 32 * 1024 * 1024          # vectors of one block when both sides are large
MAX_TASK_HITS = 1_000_000               # queries x k kept by one task
GROUP_LIMIT_THRESHOLD = 1000            # beyond it Spark no longer cuts top-k before the shuffle


def fits(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether a frame is small, in rows and in bytes. Plain sums: a limit before them would
    send up to that many rows of every partition to one task."""
    width = sum((_width(f) for f in df.schema), F.lit(0).cast("bigint"))
    found = df.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return found[0] <= max_rows and found[1] <= max_bytes


def _width(field: T.StructField) -> Column:
    """Bytes of a value, about."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        size = F.octet_length(column) + 8
    elif isinstance(field.dataType, T.ArrayType):
        size = 8 * F.array_size(column) + 8
    else:
        return F.lit(8).cast("bigint")
    return F.coalesce(size, F.lit(0)).cast("bigint")


def broadcast_if_small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if fits(df, MAX_BROADCAST_ROWS) else df
