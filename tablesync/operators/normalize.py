"""Projections that turn a scanned frame into its target form.

Each operator is one projection over built-in expressions; Catalyst collapses
the chain into a single ``Project`` on top of the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.names import clean_columns, col, resolve
from tablesync.functions.times import local_date, wall_to_utc

INGESTED_AT = "_platform_ingested_at"

_NUMBER = r"^\s*([+-]?[0-9]*)(?:(?<=[0-9])\.?[0-9]*|\.[0-9]+)\s*$"


@dataclass(frozen=True)
class GeneratedColumn:
    name: str
    expression: str
    type_name: str


def add_generated_column(df: DataFrame, generated: GeneratedColumn) -> DataFrame:
    """Add (or overwrite in place) a column from a Spark SQL expression.

    The expression sees the source names. A value that does not fit the type
    becomes null; text with a fraction loses it when cast to a whole number.
    """
    value = F.expr(generated.expression)
    typed = value.try_cast(generated.type_name)
    have, want = (f.dataType for f in df.select(value.alias("have"), typed.alias("want")).schema)
    if isinstance(have, T.StringType) and isinstance(want, T.IntegralType):
        # A failing cast of text to a whole number costs an exception per row.
        whole = F.regexp_extract(value, _NUMBER, 1)
        whole = F.when(whole.isin("", "+", "-"), "0").otherwise(whole).try_cast(want)  # as in '.5'
        typed = F.when(value.rlike(_NUMBER), whole)
    return df.withColumn(generated.name, typed)


def rename_columns(df: DataFrame) -> DataFrame:
    """Clean all column names at once; clashing names raise."""
    case_sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    return df.toDF(*clean_columns(df.columns, case_sensitive))


def times_to_utc(df: DataFrame, timezone: str) -> DataFrame:
    """Every top-level DATE and TIMESTAMP column as a UTC timestamp."""
    return df.select(
        [wall_to_utc(col(f.name), f.dataType, timezone).alias(f.name) for f in df.schema]
    )


def partition_dates(df: DataFrame, columns: Sequence[str], timezone: str) -> DataFrame:
    """UTC timestamp partition columns as source-local dates."""
    wanted = {resolve(df, c) for c in columns}
    return df.select(
        [
            (local_date(col(f.name), f.dataType, timezone) if f.name in wanted else col(f.name)).alias(f.name)
            for f in df.schema
        ]
    )


def add_ingested_at(df: DataFrame, at: datetime | Column | None = None) -> DataFrame:
    """Ingestion time as the first column, replacing one of the same name."""
    stamp = F.current_timestamp() if at is None else at if isinstance(at, Column) else F.lit(at)
    rest = [col(c) for c in df.columns if c.lower() != INGESTED_AT]
    return df.select(stamp.alias(INGESTED_AT), *rest)


def normalize(
    df: DataFrame,
    timezone: str,
    partition_cols: Sequence[str] = (),
    generated: GeneratedColumn | None = None,
    ingested_at: datetime | Column | None = None,
    stamp: bool = True,
) -> DataFrame:
    """Generated column, clean names, UTC times, partition dates, ingestion time."""
    if generated is not None:
        df = add_generated_column(df, generated)
    df = times_to_utc(rename_columns(df), timezone)
    if partition_cols:
        df = partition_dates(df, partition_cols, timezone)
    return add_ingested_at(df, ingested_at) if stamp else df


def string_frame(df: DataFrame) -> DataFrame:
    """Every column rendered as a string."""
    return df.select([col(f.name).cast(T.StringType()).alias(f.name) for f in df.schema])
