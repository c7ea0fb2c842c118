"""Z-order clustering: rows that are close in several columns share files.

Every column is cut into ``2 ** bits`` buckets of about equal row count, the
bucket numbers' bits are interleaved into one number, and the rows are range
partitioned and sorted by it, and among equal numbers by the columns themselves.
Bucket bounds only steer placement, so they never change the result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.names import col, resolve

ZVALUE = "__zvalue"
_SPLIT = "__split"


def _rank_value(name: str, dtype: T.DataType) -> Column:
    """What bounds are compared with: text as it is, else a number that orders like the column."""
    value = col(name)
    if isinstance(dtype, T.StringType):
        return value
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return value.cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(dtype, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, value).cast("double")
    raise ValueError(f"cannot cluster by {name!r} of type {dtype.simpleString()}")


def _count_bounds(df: DataFrame, values: dict[str, str], bounds: dict[str, Column], bits: int) -> DataFrame:
    """Add per column how many of its ``2 ** bits - 1`` bounds are at most its value.

    A binary search, one projection per step: each step reads the position the
    step before it reached, so all of it stays in generated code. What lies
    beyond the last bound is null, which no value is at least as large as.
    """
    df = df.withColumns({pos: F.lit(0) for pos in values})
    for i in reversed(range(bits)):
        step = 2**i
        df = df.withColumns(
            {
                pos: F.when(
                    F.col(value) >= F.get(bounds[pos], F.col(pos) + (step - 1)), F.col(pos) + step
                ).otherwise(F.col(pos))
                for pos, value in values.items()
            }
        )
    return df


def _interleave(buckets: Sequence[Column], bits: int) -> Column:
    """Bit ``i`` of bucket ``j`` goes to position ``i * len(buckets) + j``."""
    total = F.lit(0).cast("long")
    for i in range(bits):
        for j, bucket in enumerate(buckets):
            bit = F.shiftright(bucket.cast("long"), i).bitwiseAND(F.lit(1))
            total = total.bitwiseOR(F.shiftleft(bit, i * len(buckets) + j))
    return total


def _text_bounds(df: DataFrame, name: str, bits: int) -> list[str]:
    """Quantiles of a text column, by whole values.

    Values are counted first, so a frequent one is a single row. Their order is
    cut into more slices than buckets; those slices whose starts lie next to the
    quantiles give the bounds. The driver sees a row for each slice.
    """
    counted = df.select(col(name).alias("value")).dropna().groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    placed = counted.repartitionByRange(4 * 2**bits, "value")
    slices = placed.select(F.spark_partition_id().alias("slice"), "value", "n").groupBy("slice")
    found = slices.agg(F.min("value").alias("low"), F.sum("n").alias("n")).orderBy("low").collect()
    total, passed, bounds = sum(s["n"] for s in found), 0, []
    for s in found:
        if passed * 2**bits >= (len(bounds) + 1) * total:
            bounds.append(s["low"])
        passed += s["n"]
    return bounds


def _bounds(df: DataFrame, names: Sequence[str], bits: int) -> list[Column]:
    """Literal arrays of the columns' quantiles, shorter for columns with few or no values."""
    cuts = [i / 2**bits for i in range(1, 2**bits)]
    texts = [n for n in names if isinstance(df.schema[n].dataType, T.StringType)]
    found: dict[str, Sequence] = {n: _text_bounds(df, n, bits) for n in texts}
    numbers = [n for n in dict.fromkeys(names) if n not in found]
    if numbers:
        ranks = [_rank_value(n, df.schema[n].dataType) for n in numbers]
        row = df.agg(*[F.percentile_approx(r, cuts, 2 ** (bits + 2)) for r in ranks]).first()
        found |= {n: [float(x) for x in q or ()] for n, q in zip(numbers, row)}
    return [
        F.array(*map(F.lit, found[n])).cast(f"array<{'string' if n in texts else 'double'}>") for n in names
    ]


def bits_for(files: int, columns: int) -> int:
    """Buckets (as a power of two) of each column, so that there are more cells than files.

    A single column needs no more than a few: within a bucket rows are ordered by its value.
    """
    return 6 if columns == 1 else max(6, math.ceil(math.log2(max(files, 1)) / columns) + 1)


def with_zvalue(
    df: DataFrame, columns: Sequence[str], bits: int = 6, like: DataFrame | None = None
) -> DataFrame:
    """``df`` plus the interleaved bucket number of each row; null values rank lowest.

    Bounds come from ``like`` if given: a frame of about the same values that
    is cheaper to read than ``df``.
    """
    names = [resolve(df, c) for c in columns]
    bits = max(1, min(bits, 62 // len(names)))
    like = df if like is None else like
    ranks = [_rank_value(n, df.schema[n].dataType) for n in names]
    values = {f"__bucket{i}": f"__rank{i}" for i in range(len(ranks))}
    bounds = dict(zip(values, _bounds(like, [resolve(like, n) for n in names], bits)))
    ranked = df.withColumns(dict(zip(values.values(), ranks)))
    placed = _count_bounds(ranked, values, bounds, bits)
    buckets = [F.col(pos) for pos in values]
    return placed.withColumn(ZVALUE, _interleave(buckets, bits)).drop(*values, *values.values())


def zorder(
    df: DataFrame,
    columns: Sequence[str],
    partition_cols: Sequence[str] = (),
    files: int | None = None,
    bits: int | None = None,
    like: DataFrame | None = None,
) -> DataFrame:
    """The same rows, range partitioned and sorted by partition, z-value and columns.

    The columns keep an order among rows of one z-value, so files stay narrow
    however many of them a bucket fills. The input split number is the last
    range key: it is stable on retry and spreads a hot value over many tasks.
    Without ``files`` the number of output partitions follows the session's
    shuffle setting and AQE; without ``bits`` it gives the number of buckets.
    """
    names = [resolve(df, c) for c in columns]
    if bits is None:
        bits = bits_for(files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), len(names))
    place = [*[col(resolve(df, p)) for p in partition_cols], F.col(ZVALUE), *map(col, names)]
    placed = with_zvalue(df, names, bits, like).withColumn(_SPLIT, F.spark_partition_id())
    ranges = [*place, F.col(_SPLIT)]
    ranged = (
        placed.repartitionByRange(files, *ranges) if files else placed.repartitionByRange(*ranges)
    )
    return ranged.sortWithinPartitions(*place).drop(ZVALUE, _SPLIT)
