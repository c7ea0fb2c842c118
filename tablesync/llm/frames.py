"""Helpers around DataFrames: reading tables, written interim tables, Arrow maps."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a batch of texts between Spark and Python, unless the session says otherwise.
BATCH_ROWS = 1000
_BATCH_ROWS_KEY, _BATCH_ROWS_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"

_ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def interim_root(spark: SparkSession) -> str:
    """The shared folder for interim tables: ``spark.checkpoint.dir``, else the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/llm-interim"


def written(df: DataFrame, *by: str) -> DataFrame:
    """``df`` as a table written to the shared folder: lineage ends there, and joins see a plain scan.

    ``by``: columns that get folders, for tables of which parts are read.
    """
    spark = df.sparkSession
    path = f"{interim_root(spark)}/{uuid.uuid4().hex}"
    if by:
        df = df.hint("rebalance", *by)
    df.write.partitionBy(*by).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.interim_path = path
    return out


def discard(table: DataFrame) -> None:
    """Remove an interim table that nothing will read again."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.interim_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def packed(docs: DataFrame, **columns: str) -> DataFrame:
    """``row`` with the whole input row, and the named columns under names of our own."""
    return docs.select(
        F.struct("*").alias("row"), *(docs[c].alias(name) for name, c in columns.items())
    )


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema
) -> DataFrame:
    """``mapInArrow`` whose workers find this package also when it isn't installed.

    A session that leaves the size of batches at Spark's default gets smaller
    ones from here on: long texts would fill the memory of the executors.
    """
    if df.sparkSession.conf.get(_BATCH_ROWS_KEY) == _BATCH_ROWS_DEFAULT:
        df.sparkSession.conf.set(_BATCH_ROWS_KEY, BATCH_ROWS)
    environment = df.sparkSession.sparkContext.environment
    if _ROOT not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(filter(None, [environment.get("PYTHONPATH"), _ROOT]))
    return df.mapInArrow(_released(function), schema)


def _released(function):
    """Workers are used again: they give back what a task no longer needs."""

    def run(batches):
        yield from function(batches)
        pa.default_memory_pool().release_unused()

    return run


def bytes_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The UTF-8 bytes of a string column."""
    return batch.column(name).cast(pa.large_binary()).to_pylist()
