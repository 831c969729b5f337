"""Size checks for broadcasts, and joins that stay balanced when a key is hot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType, StringType

from termlight.session import cut_lineage

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 1000
ROWS_OF_A_TASK = 2_000_000
HASHED_ROWS_OF_A_TASK = 250_000
MAX_NAMED_KEYS = 500


def _row_bytes(df: DataFrame) -> Column:
    sizes = []
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, StringType):
            sizes.append(F.octet_length(column))
        elif isinstance(kind, ArrayType) and isinstance(kind.elementType, NumericType):
            sizes.append(F.size(column) * 8)
        elif isinstance(kind, ArrayType):
            sizes.append(F.octet_length(F.to_json(column)))
        else:
            sizes.append(F.lit(8))
    return reduce(lambda a, b: a + b, [F.coalesce(s, F.lit(0)) + 8 for s in sizes])


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows and approximate bytes, by one distributed aggregate."""
    return tuple(df.agg(F.count("*"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0))).first())


def fits_broadcast(
    df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> bool:
    """Measure ``df`` and say whether it may be broadcast."""
    rows, size = measure(df)
    return rows <= max_rows and size <= max_bytes


def restrict(table: DataFrame, column: str, wanted: DataFrame, rows: int) -> DataFrame:
    """Name the wanted keys in the scan of ``table`` where they are few (``rows``, as measured).

    The list reaches the Parquet reader, which skips the row groups that hold none of them. With
    more keys the table is left as it is; the join that follows decides alone.
    """
    if rows > MAX_NAMED_KEYS:
        return table
    keys = [r[0] for r in wanted.select(column).distinct().collect()]
    return table.where(F.col(column).isin([k for k in keys if k is not None]))


def wanted_rows(table: DataFrame, wanted: DataFrame, on: list[str]) -> DataFrame:
    """The rows of a large ``table`` whose key is in ``wanted``, which holds each key once.

    ``on`` ends with the key that is worth naming in the scan.
    """
    rows, size = measure(wanted)
    if rows > MAX_BROADCAST_ROWS or size > MAX_BROADCAST_BYTES:
        return table.join(wanted, on, "left_semi")
    table = restrict(table, on[-1], wanted, rows)
    return table.join(F.broadcast(wanted), on, "left_semi")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str = "inner",
    max_rows: int = MAX_BROADCAST_ROWS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join rows to a table with at most a few rows per key (``how``: inner or left).

    A right side of a checked size is broadcast. A larger one is joined in two parts: the keys that
    hold more than a thousandth of the left rows are fewer than a thousand, so their part of the
    right side is broadcast; the rest has no hot key left and is shuffled, to more tasks for more rows,
    each of which holds its share of the right side, so that no row is sorted. ``counts`` (``on``,
    ``__n``) has the left rows of each key, where they are known; else they are counted.
    """
    rows, size = measure(right)
    if rows <= max_rows and size <= MAX_BROADCAST_BYTES:
        return left.join(F.broadcast(right), on, how)
    counts = left.groupBy(on).agg(F.count("*").alias("__n")) if counts is None else counts
    total = left.count()
    hot = cut_lineage(counts.where(F.col("__n") * HOT_SHARE > total).select(on), "hot")
    hot_right = right.join(F.broadcast(hot), on, "left_semi")
    hot_left = left.join(F.broadcast(hot), on, "left_semi")
    cold_left = left.join(F.broadcast(hot), on, "left_anti")
    hot_part = (
        hot_left.join(F.broadcast(hot_right), on, how)
        if fits_broadcast(hot_right, max_rows)
        else hot_left.join(hot_right, on, how)
    )
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(parts, total // ROWS_OF_A_TASK, rows // HASHED_ROWS_OF_A_TASK)
    held = right.repartition(parts, *on).hint("shuffle_hash")
    return hot_part.unionByName(cold_left.repartition(parts, *on).join(held, on, how))
