"""Removal of what no reader needs any more.

* Staging folders: a finished load removes its own, so whatever is found there past
  the retention belongs to a load that did not finish.
* In the table's own folder: versions that no load has made part of the table, and
  partition folders that have been replaced for longer than the retention.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.sinks import files
from tablesync.sinks.loadlog import VERSIONS, History
from tablesync.sinks.table import live_units

RETENTION_HOURS = 168
_WRITER_LEFTOVERS = (".spark-staging-*", "_temporary")


def _cutoff(retention_hours: float) -> datetime:
    return datetime.now(timezone.utc) - timedelta(hours=retention_hours)


def replaced_folders(spark: SparkSession, path: str, retention_hours: float = RETENTION_HOURS) -> list[str]:
    """Folders and files in the table's folder that have not been part of the table for so long.

    A place stops to count when a record puts its partition somewhere else; a
    version that no record names, when it was last written to.
    """
    history, root, cutoff = History.of(spark, path), path.rstrip("/"), _cutoff(retention_hours)
    places = history.versions()
    live = set(live_units(history).values())
    since = {unit: datetime.fromisoformat(r["logged_at"]) for unit, (_, r) in places.items()}
    named = {r["version"] for r in history.done if r["version"]}
    found = []
    if history.depth:
        base = files.folders_named(spark, root, history.depth, None)
        found += [f"{root}/{u}" for u in base if u in since and since[u] <= cutoff]
    elif "" in since and since[""] <= cutoff:
        found += [f"{root}/{name}" for name in files.names(spark, root)]
    for folder, modified_ms in files.matching(spark, f"{root}/{VERSIONS}/*"):
        version = folder.rstrip("/").rsplit("/", 1)[-1]
        if version not in named:
            found += [f"{root}/{VERSIONS}/{version}"] if modified_ms <= cutoff.timestamp() * 1000 else []
            continue
        units = files.folders_named(spark, folder, history.depth, None) if history.depth else [""]
        gone = [u for u in units if f"{VERSIONS}/{version}/{u}".rstrip("/") not in live and since.get(u, cutoff) <= cutoff]
        whole = len(gone) == len(units)
        found += [f"{root}/{VERSIONS}/{version}"] if whole else [f"{root}/{VERSIONS}/{version}/{u}" for u in gone]
    return found


def expired_staging(spark: SparkSession, path: str, retention_hours: float = RETENTION_HOURS) -> DataFrame:
    """Files of loads into ``path`` none of whose staged files is within the retention."""
    root = files.qualified(spark, files.staging_root(spark, path))
    below_root = F.substring("path", len(root) + 2, 2**31 - 1)
    load = F.concat(F.lit(root + "/"), F.substring_index(below_root, "/", 1))
    listed = files.listing(spark, root).withColumn("load", load)
    expired = (
        listed.groupBy("load")
        .agg(F.max("modificationTime").alias("newest"))
        .where(F.col("newest") < F.lit(_cutoff(retention_hours)))
    )
    return listed.join(expired, "load", "left_semi")


def expired_files(spark: SparkSession, path: str, retention_hours: float = RETENTION_HOURS) -> DataFrame:
    """Files that a sweep would remove.

    Columns: ``load`` (the load's staging folder, or the replaced folder), ``path``,
    ``modificationTime``, ``length``.
    """
    out = expired_staging(spark, path, retention_hours)
    for folder in replaced_folders(spark, path, retention_hours):
        out = out.unionByName(files.listing(spark, folder).withColumn("load", F.lit(folder)))
    return out


def sweep(
    spark: SparkSession, path: str, retention_hours: float = RETENTION_HOURS
) -> list[str]:
    """Remove expired staging folders, replaced folders and writer leftovers; returns what was removed.

    The driver sees one row per unfinished load and replaced folder, not one per file.
    """
    removed = replaced_folders(spark, path, retention_hours)
    cutoff_ms = _cutoff(retention_hours).timestamp() * 1000
    staging = files.staging_root(spark, path)
    if files.exists(spark, staging) and any(ms < cutoff_ms for _, ms in files.matching(spark, f"{staging}/*")):
        listed = expired_staging(spark, path, retention_hours).select("load").distinct()
        removed += [row["load"] for row in listed.collect()]
    for pattern in _WRITER_LEFTOVERS:
        found = files.matching(spark, f"{path}/{pattern}")
        removed += [child for child, modified_ms in found if modified_ms < cutoff_ms]
    for folder in removed:
        files.remove(spark, folder)
    return removed
