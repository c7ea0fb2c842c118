"""Table and query scans over DataFrames (Parquet files, catalog tables, ...)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession

from tablesync.functions.names import col, resolve


def filtered(df: DataFrame, predicate: Column | None) -> DataFrame:
    """Rows matching the predicate; Catalyst pushes it into the scan."""
    return df if predicate is None else df.where(predicate)


def query_scan(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """A custom query over named frames, written ``{name}`` in the text."""
    return spark.sql(query, **tables)


def redistribute(df: DataFrame, partitions: int | None) -> DataFrame:
    """Round-robin into ``partitions``; None keeps the scan's own splits and avoids a shuffle."""
    return df.repartition(partitions) if partitions else df


def apply_schema_override(df: DataFrame, overrides: Mapping[str, str]) -> DataFrame:
    """Give columns of a frame the override types a JDBC scan would take as ``customSchema``."""
    wanted = {resolve(df, name): type_name for name, type_name in overrides.items()}
    return df.select(
        [(col(c).cast(wanted[c]) if c in wanted else col(c)).alias(c) for c in df.columns]
    )
