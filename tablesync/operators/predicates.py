"""Row predicates as Columns, and the partition scope of a load."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.names import col, resolve
from tablesync.functions.times import day_start

COPIES = "__copies"
_KEY_HASH = "__key_hash"


def conjunction(*predicates: Column | None) -> Column:
    """All predicates together; no predicate at all is true."""
    return reduce(lambda a, b: a & b, [p for p in predicates if p is not None], F.lit(True))


def day_window(day: date) -> tuple[date, date]:
    return day, day + timedelta(days=1)


def time_window(
    df: DataFrame, column: str, start: date, end: date, zone: str | None = None
) -> Column:
    """``start <= column < end`` at midnight, typed to the column for pushdown.

    Pass ``zone`` when the column already holds UTC timestamps.
    """
    name = resolve(df, column)
    dtype = df.schema[name].dataType
    return (col(name) >= day_start(start, dtype, zone)) & (col(name) < day_start(end, dtype, zone))


def user_predicate(text: str) -> Column | None:
    return F.expr(text) if text.strip() else None


def is_true(predicate: Column) -> Column:
    """Three-valued logic down to two: unknown counts as false."""
    return F.coalesce(predicate, F.lit(False))


def partition_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values; partial aggregation collapses hot values before the shuffle."""
    return distinct_keys(df, [column]).dropna()


def grouped_by_key(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """One row per key, ready to be the small-per-key side of a skewed join.

    AQE splits a hot key's partition only where both join inputs are plain
    shuffles. Grouping by the key's hash as well keeps this aggregation from
    sharing the join's partitioning, so the join gets shuffles of its own.
    """
    names = [col(k) for k in keys]
    grouped = df.groupBy(*names, F.xxhash64(*names).alias(_KEY_HASH))
    return grouped.agg(F.count(F.lit(1)).alias(COPIES), *aggregates).drop(_KEY_HASH)


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct key rows, as the right side of a semi, anti or marking join."""
    return grouped_by_key(df, keys).drop(COPIES)


@dataclass(frozen=True)
class PartitionScope:
    """The partitions a load touches, by the distinct values of its partition column.

    The values stay a DataFrame, however many there are. A table's sink finds the
    folders of these values; any other frame is joined with them.
    """

    column: str
    all_values: DataFrame  # with null, if it occurs

    @property
    def values(self) -> DataFrame:
        """Distinct non-null values."""
        return self.all_values.dropna()

    @property
    def has_null(self) -> bool:
        return not self.all_values.where(col(self.column).isNull()).isEmpty()

    @property
    def is_empty(self) -> bool:
        return self.values.isEmpty()

    def inside(self, df: DataFrame) -> DataFrame:
        """Rows in the touched partitions."""
        return df.join(self.values, self.column, "left_semi").select(df.columns)

    def tag(self, df: DataFrame, flag: str) -> DataFrame:
        """``df`` plus a boolean column telling whether the row is inside."""
        marked = self.values.withColumn(flag, F.lit(True))
        joined = df.join(marked, self.column, "left")
        return joined.select(*[col(c) for c in df.columns], is_true(col(flag)).alias(flag))


def partition_scope(df: DataFrame, column: str) -> PartitionScope:
    """The distinct values of a partition column; nothing runs yet."""
    name = resolve(df, column)
    return PartitionScope(name, distinct_keys(df, [name]))


def key_equality(
    keys: Sequence[str],
    source: str = "source",
    target: str = "target",
    source_prefix: str = "",
    target_prefix: str = "",
) -> Column:
    """``source.k = target.k`` for every key; null keys never match."""
    return conjunction(
        *[
            F.col(f"{source}.`{source_prefix}{k}`") == F.col(f"{target}.`{target_prefix}{k}`")
            for k in keys
        ]
    )


def merge_condition(
    keys: Sequence[str],
    in_scope: Column | None = None,
    source_prefix: str = "",
    target_prefix: str = "",
) -> Column:
    """Key equality, of target rows in scope only where a scope is given."""
    equal = key_equality(keys, source_prefix=source_prefix, target_prefix=target_prefix)
    return equal if in_scope is None else in_scope & equal


def checked(df: DataFrame, predicate: Column, column: str, message: str) -> DataFrame:
    """``df`` unchanged, except that a row failing ``predicate`` fails the job.

    The check rides on ``column`` in the same pass, so a bad row stops the
    write before anything is committed.
    """
    guarded = F.when(is_true(predicate), col(column)).otherwise(F.raise_error(message))
    return df.withColumn(column, guarded)
