"""Catalog registration of a table's folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tablesync.sinks import files
from tablesync.sinks.loadlog import VERSIONS, History
from tablesync.sinks.table import live_units, table_exists, table_schema, unit_at

_SEQ = "tablesync.registered"  # the newest load record that a catalog table has caught up with
_BATCH = 100  # partitions a statement adds or drops


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns(fields: Sequence[T.StructField]) -> str:
    return ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in fields)


def create_database(spark: SparkSession, database: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)} LOCATION {_text(location)}")


def _check_same(spark: SparkSession, name: str, path: str, partitions: Sequence[str]) -> None:
    """Refuse a catalog table of that name over another folder or of another layout."""
    rows = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()]
    details = dict(rows[[c for c, _ in rows].index("# Detailed Table Information") :])
    present = files.qualified(spark, details["Location"]).rstrip("/").split(f"/{VERSIONS}/")[0]
    wanted = files.qualified(spark, path).rstrip("/")
    if present != wanted:
        raise ValueError(f"{name} is registered at {present}, not at {wanted}")
    layout = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    if [c.lower() for c in layout] != [c.lower() for c in partitions]:
        raise ValueError(f"{name} is registered with partitions {layout}, not {list(partitions)}")


def _spec(unit: str, layout: Sequence[str]) -> str:
    """A partition as SQL names it, from its folder."""
    values = [files.folder_value(part)[1] for part in unit.split("/")]
    return "(" + ", ".join(f"{_quoted(c)} = {'NULL' if v is None else _text(v)}" for c, v in zip(layout, values)) + ")"


def _follow(spark: SparkSession, name: str, history: History, layout: Sequence[str], seen: int | None) -> None:
    """Bring the partitions of a catalog table to where the table's are.

    Only those that loads after record ``seen`` have touched are named, all if it
    is None. A partition that moved is switched by one statement, so a reader
    finds its old or its new rows.
    """
    root = history.path.rstrip("/")
    if seen is None:
        live, moved, gone = live_units(history), [], []
    else:
        new = [r for r in history.done if r["seq"] > seen]
        touched = {u for r in new for u in [*r["units"], *r["emptied"], *map(unit_at, r["places"])]}
        last = {u.rsplit("/", 1)[-1] for u in touched}
        now = live_units(history, sorted(last)) if touched else {}
        live = {u: place for u, place in now.items() if u in touched}
        moved = [u for u, place in live.items() if place.startswith(f"{VERSIONS}/")]
        gone = sorted(touched - set(live))
    def location(u: str) -> str:
        return f"LOCATION {_text(f'{root}/{live[u]}')}"

    units = sorted(live)
    for i in range(0, len(units), _BATCH):
        added = " ".join(f"PARTITION {_spec(u, layout)} {location(u)}" for u in units[i : i + _BATCH])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
    for u in moved:
        spark.sql(f"ALTER TABLE {name} PARTITION {_spec(u, layout)} SET {location(u)}")
    for i in range(0, len(gone), _BATCH):
        specs = ", ".join(f"PARTITION {_spec(u, layout)}" for u in gone[i : i + _BATCH])
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {specs}")


def register_table(
    spark: SparkSession,
    database: str,
    table: str,
    path: str,
    partition_cols: Sequence[str] = (),
) -> bool:
    """External table over an existing folder; new columns and partitions are picked up.

    The catalog table remembers up to which load it has followed the table; a
    later registration names only the partitions that loads since then touched.
    A table of that name at another place or with other partition columns raises.
    Struct fields can't be added in place, so a table whose columns have grown
    inside is registered anew; its files stay.

    Returns whether there was a folder to register.
    """
    if not table_exists(spark, path):
        return False
    schema = table_schema(spark, path)
    by_name = {f.name.lower(): f.name for f in schema}
    partitions = [by_name.get(c.lower(), c) for c in partition_cols]
    history = History.of(spark, path)
    history.assumed = partitions
    name = f"{_quoted(database)}.{_quoted(table)}"
    by = f"PARTITIONED BY ({', '.join(map(_quoted, partitions))})" if partitions else ""
    root = path.rstrip("/") if partitions else f"{path.rstrip('/')}/{live_units(history).get('', '')}".rstrip("/")
    create = (
        f"CREATE EXTERNAL TABLE IF NOT EXISTS {name} ({_columns(schema.fields)}) "
        f"USING parquet {by} LOCATION {_text(root)}"
    )
    spark.sql(create)
    _check_same(spark, name, path, partitions)
    known = {f.name.lower(): f.dataType.simpleString() for f in spark.table(name).schema}
    if any(known.get(f.name.lower(), kind) != kind for f in schema for kind in [f.dataType.simpleString()]):
        drop_table(spark, database, table)
        spark.sql(create)
        known = {f.name.lower(): "" for f in schema}
    added = [f for f in schema if f.name.lower() not in known]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_columns(added)})")
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    seen = int(properties[_SEQ]) if _SEQ in properties else None
    if partitions:
        _follow(spark, name, history, partitions, seen)
    else:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_text(root)}")
    if history.done:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({_text(_SEQ)} = {_text(str(history.done[-1]['seq']))})")
    spark.sql(f"REFRESH TABLE {name}")
    return True


def drop_table(spark: SparkSession, database: str, table: str) -> None:
    """Forget the table; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(database)}.{_quoted(table)}")
