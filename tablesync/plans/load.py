"""One load: scan, filter, normalise, write, cluster, sweep, register."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from tablesync.functions.names import clean_column, resolve
from tablesync.operators.normalize import normalize
from tablesync.operators.predicates import (
    conjunction,
    partition_scope,
    time_window,
    user_predicate,
)
from tablesync.sinks import catalog, files
from tablesync.sinks.sweep import sweep
from tablesync.sinks.table import cluster_table, land, upsert_table, write
from tablesync.sources.frames import filtered, redistribute
from tablesync.sources.jdbc import (
    JdbcSource,
    Split,
    custom_schema,
    filtered_table,
    query_as_table,
    table_name,
)
from tablesync.spec import LoadSpec

log = logging.getLogger("tablesync")

_SPLITTABLE = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class LoadResult:
    load_id: str
    path: str
    n_rows: int


def source_predicate(spec: LoadSpec, df: DataFrame) -> Column | None:
    """Window and user predicate over source columns; None when neither is set."""
    parts = [time_window(df, spec.dtflt, *spec.window) if spec.window else None]
    parts.append(user_predicate(spec.where))
    return conjunction(*parts) if any(p is not None for p in parts) else None


def target_predicate(spec: LoadSpec, df: DataFrame) -> Column | None:
    """The same predicate over normalised columns, whose timestamps are UTC."""
    parts = [
        time_window(df, clean_column(spec.dtflt), *spec.window, zone=spec.timezone)
        if spec.window
        else None
    ]
    parts.append(user_predicate(spec.where))
    return conjunction(*parts) if any(p is not None for p in parts) else None


def scan(spark: SparkSession, spec: LoadSpec, source: DataFrame | None = None) -> DataFrame:
    """Rows to load: from ``source`` if given, else from the JDBC table or query.

    A JDBC source gets the user's predicate as text, too, since Spark hands on
    only what it can translate.
    """
    if source is not None:
        rows = filtered(source, source_predicate(spec, source))
        return redistribute(rows, spec.partitions_number)
    if not spec.jdbcUrl:
        raise ValueError("jdbcUrl is required")
    jdbc = JdbcSource(
        spec.jdbcUrl, spec.jdbc_driver, spec.fetch_size, spec.partitions_number, spec.jdbc_options
    )
    dbtable = query_as_table(spec.query) if spec.query else table_name(spec.schema, spec.tab)
    if spec.where_at_source and spec.where.strip():
        dbtable = filtered_table(dbtable, spec.where)
    types = custom_schema(spark, jdbc, spec.schema, spec.tab) if spec.override_types else ""
    options = jdbc.reader_options(dbtable, custom_schema=types)
    columns = spark.read.format("jdbc").options(**options).load()  # schema only
    split = None
    if spec.split_column:
        split = Split(resolve(columns, spec.split_column))
    elif spec.window:
        name = resolve(columns, spec.dtflt)
        if isinstance(columns.schema[name].dataType, _SPLITTABLE):
            split = Split(name, *spec.window)
    return jdbc.load(spark, dbtable, source_predicate(spec, columns), split, types)


def prepare(spec: LoadSpec, rows: DataFrame) -> DataFrame:
    """Rows in their target form."""
    return normalize(
        rows,
        spec.timezone,
        spec.partition_col,
        spec.generated,
        spec.ingested_at,
        not spec.disable_platform_ingested_at,
    )


def run(spark: SparkSession, spec: LoadSpec, source: DataFrame | None = None) -> LoadResult:
    """Execute one load."""
    if spec.change_tracking:
        raise NotImplementedError("change tracking is not supported")
    if spec.log_lvl:
        log.setLevel(spec.log_lvl.upper())
    if spec.log_spark_lvl:
        spark.sparkContext.setLogLevel(spec.log_spark_lvl.upper())
    load_id = files.new_load_id()
    data = prepare(spec, scan(spark, spec, source))
    partitions = [resolve(data, c) for c in spec.partition_columns]
    folder = f"{files.staging_root(spark, spec.path)}/{load_id}"
    zorder_cols = [clean_column(c) for c in spec.zorderby_col]
    scope = None
    log.info("loading %s into %s", spec.table_name, spec.path)

    if zorder_cols and partitions and not spec.use_merge and spec.mode == "append":
        # Clustering needs the touched partitions of exactly the rows written.
        data, _ = land(spark, data, f"{folder}/landed")
        scope = partition_scope(data, partitions[-1])
    if spec.use_merge:
        keys = [clean_column(k) for k in spec.merge_keys]
        done = upsert_table(
            spark, data, spec.path, keys, partitions, spec.mode, spec.load_tag, load_id, zorder_cols
        )
    else:
        where = target_predicate(spec, data) if spec.mode == "overwrite" else None
        done = write(
            spark, data, spec.path, spec.mode, partitions, spec.load_tag, where, load_id, zorder_cols
        )
    if zorder_cols and done.n_rows and not done.clustered:
        cluster_table(spark, spec.path, zorder_cols, partitions, scope, load_id=load_id)
    files.remove(spark, folder)
    sweep(spark, spec.path, spec.retention_hours)
    if spec.hive_db:
        catalog.create_database(spark, spec.hive_db, spec.hive_db_location)
        catalog.register_table(spark, spec.hive_db, spec.table_name, spec.path, partitions)
    log.info("loaded %d rows into %s", done.n_rows, spec.path)
    return LoadResult(load_id, spec.path, done.n_rows)
