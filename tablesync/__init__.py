"""Load relational tables into partitioned Parquet tables with Spark."""

from tablesync.plans.load import LoadResult, prepare, run, scan
from tablesync.spec import LoadSpec

__all__ = ["LoadResult", "LoadSpec", "prepare", "run", "scan"]
