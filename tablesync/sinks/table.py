"""Parquet tables: write modes, conditional overwrite, upsert and clustering.

Nothing is ever written over. A replacement writes the final, clustered content of
the partitions that receive rows into a new folder, once; its record in the load
log makes that folder the place of those partitions, in one step. Appended rows are
staged beside it and then moved into the partitions' present folders under names
that tell the load; its record makes them part of the table. So a reader sees a load
whole or not at all, reading writes nothing, and a load that failed, wherever, is
repeated by running it again. What was replaced stays until the sweep's retention
is over, for those who read it still.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.names import col, resolve
from tablesync.operators.layout import zorder
from tablesync.operators.merge import (
    append_rows,
    check_incoming,
    conform,
    evolved_schema,
    replace_touched,
    source_keys,
    upsert,
)
from tablesync.operators.predicates import PartitionScope, partition_scope
from tablesync.sinks import files
from tablesync.sinks.loadlog import CREATING, DONE, STARTED, UNDONE, VERSIONS, History

_MOVERS = 16  # files renamed, or folders measured, at once
FILE_BYTES = 128 << 20  # size that clustered files are planned for


@dataclass(frozen=True)
class Written:
    """Outcome of one write: incoming rows, and whether what they touched is clustered."""

    n_rows: int
    clustered: bool = False


def _opened(spark: SparkSession, path: str, partition_cols: Sequence[str]) -> History:
    history = History.of(spark, path)
    history.assumed = partition_cols
    return history


def _present(history: History) -> bool:
    spark, path = history.spark, history.path
    if history.done:
        return files.exists(spark, path)
    return not history.creating and files.has_visible_child(spark, path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds data, or was loaded with no rows. A failed first load leaves no table."""
    return _present(History.of(spark, path))


def _schema(history: History, partition_cols: Sequence[str] | None = None) -> T.StructType:
    logged = history.layout()
    if logged is None:
        return history.spark.read.option("mergeSchema", "true").parquet(history.path).schema
    schema, layout = logged
    if partition_cols is not None and [c.lower() for c in partition_cols] != [c.lower() for c in layout]:
        raise ValueError(f"{history.path} is partitioned by {layout}, not by {list(partition_cols)}")
    return schema


def table_schema(
    spark: SparkSession, path: str, partition_cols: Sequence[str] | None = None
) -> T.StructType:
    """Logged schema of the table, or the merged schema of its files.

    Given partition columns must be those the table was written with.
    """
    return _schema(History.of(spark, path), partition_cols)


def live_units(history: History, names: Sequence[str] | None = None) -> dict[str, str]:
    """Partition folders (relative) of the table and where each is now, relative to the table's folder.

    ``names`` restricts the last level to folders of these names; no others are
    listed. An unpartitioned table is one unit, the empty path.
    """
    places = history.versions()
    if not history.depth:
        version = places.get("", (None,))[0]
        return {"": f"{VERSIONS}/{version}" if version else ""}
    found = {unit: unit for unit in files.folders_named(history.spark, history.path, history.depth, names)}
    wanted = None if names is None else set(names)
    for unit, (version, _) in places.items():
        if wanted is None or unit.rsplit("/", 1)[-1] in wanted:
            found.pop(unit, None)
            if version:
                found[unit] = f"{VERSIONS}/{version}/{unit}"
    return found


def _root_of(unit: str, place: str) -> str:
    """The folder below which ``place`` lies by the path of its unit."""
    return place[: len(place) - len(unit)].rstrip("/")


def _read(history: History, schema: T.StructType, names: Sequence[str] | None = None) -> DataFrame:
    spark, path = history.spark, history.path.rstrip("/")
    reader = spark.read.schema(schema)
    parts = []
    if names is None and not history.versions():
        parts.append(reader.parquet(path))
    else:
        by_root: dict[str, list[str]] = {}
        for unit, place in live_units(history, names).items():
            by_root.setdefault(_root_of(unit, place), []).append(place)
        for root, places in sorted(by_root.items()):
            base = f"{path}/{root}".rstrip("/")
            parts.append(reader.option("basePath", base).parquet(*[f"{path}/{p}".rstrip("/") for p in sorted(places)]))
    hidden = history.hidden()
    rows = None
    for part in parts:
        if hidden:
            part = part.where(~F.regexp_extract("_metadata.file_name", files.JOB_IN_NAME, 1).isin(hidden))
        part = part.select([col(f.name) for f in schema])
        rows = part if rows is None else rows.union(part)
    return spark.createDataFrame([], schema) if rows is None else rows


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, scope: PartitionScope | None = None
) -> DataFrame:
    """The table with its columns in order and partition values in their declared types.

    It reads what the last finished load left, and changes nothing. With the
    ``scope`` of a partitioned table, only the folders of its values (and of null,
    if it has one) are listed and read.
    """
    history = History.of(spark, path)
    return _read(history, schema or _schema(history), None if scope is None else _folder_names(scope))


def _folder_names(scope: PartitionScope) -> list[str]:
    """Folders of the touched values, each of which the load is going to write."""
    shown = scope.all_values.select(col(scope.column).cast("string").alias("value")).collect()
    return sorted({files.folder_name(scope.column, row["value"]) for row in shown})


def blank_partitions_to_null(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Storage keeps '' and null in one directory, so '' becomes null before any comparison."""
    for name in partition_cols:
        if isinstance(df.schema[name].dataType, T.StringType):
            df = df.withColumn(name, F.nullif(col(name), F.lit("")))
    return df


def _rows(counted: Observation) -> int | None:
    """Rows of a finished write, or None: AQE drops the metric with a plan it finds empty."""
    try:
        return counted.get["n"]
    except Py4JJavaError:
        return None


def land(spark: SparkSession, df: DataFrame, folder: str) -> tuple[DataFrame, int]:
    """Write ``df`` once and return the written rows with their count.

    Rewrites look at the incoming data several times: a fixed copy keeps a
    changing source consistent and survives lost executors, unlike a cache.
    """
    n_rows = _put(df, folder, ())
    landed = spark.read.schema(df.schema).parquet(folder)
    return landed, landed.count() if n_rows is None else n_rows


def _put(df: DataFrame, folder: str, partition_cols: Sequence[str], arranged: bool = False) -> int | None:
    """Write into a folder of its own; returns the number of rows, if known.

    Rows are counted in the stage that writes them, where a retried task does
    not count twice.
    """
    counted = Observation()
    if partition_cols and not arranged:
        df = _rebalanced(df, partition_cols)
    df = df.observe(counted, F.count(F.lit(1)).alias("n"))
    df.write.mode("overwrite").partitionBy(*partition_cols).parquet(folder)
    return _rows(counted)


def _new_version(path: str) -> tuple[str, str]:
    """Name and folder of content to be written. No two loads share one, whatever their ids."""
    version = uuid.uuid4().hex
    return version, f"{path.rstrip('/')}/{VERSIONS}/{version}"


def _commit(
    history: History, load_id: str, tag: str, mode: str, n_rows: int, schema: T.StructType,
    partition_cols: Sequence[str], **places,
) -> None:
    """The record by which a load becomes part of the table."""
    files.make_folder(history.spark, history.path)
    history.record(load_id, tag, mode, DONE, n_rows, schema, partition_cols, **places)


def _planned_files(spark: SparkSession, folders: Sequence[str], file_bytes: int) -> int:
    """Number of files for the rows of some folders, by the bytes they take now.

    Rows that a load replaces count beside those that replace them, so files are
    smaller than planned, by half at most.
    """
    with ThreadPoolExecutor(_MOVERS) as pool:
        total = sum(pool.map(lambda folder: files.data_size(spark, folder), folders))
    return max(1, math.ceil(total / file_bytes))


def _places(history: History, names: Sequence[str] | None) -> list[str]:
    """Folders that hold the partitions of some names (None: all)."""
    root = history.path.rstrip("/")
    return [f"{root}/{place}".rstrip("/") for place in live_units(history, names).values()]


def _staged_units(spark: SparkSession, folder: str, depth: int) -> list[str]:
    return files.folders_named(spark, folder, depth, None) if depth else [""]


def _replace(
    history: History, content: DataFrame, partition_cols: Sequence[str], names: Sequence[str] | None,
    load_id: str, tag: str, mode: str, n_rows: int | None, arranged: bool = False,
) -> int | None:
    """Write ``content`` once and make it the place of all partitions of ``names`` (None: of the table).

    Rows can leave one folder for another of the same name; a folder that is left
    without rows is no longer part of the table.
    """
    spark = history.spark
    version, folder = _new_version(history.path)
    counted = _put(content, folder, partition_cols, arranged)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in content.schema])
    units = _staged_units(spark, folder, len(partition_cols))
    emptied = sorted(set(live_units(history, names)) - set(units)) if partition_cols else []
    if n_rows is None:
        n_rows = spark.read.schema(schema).parquet(folder).count() if counted is None else counted
    _commit(history, load_id, tag, mode, n_rows, schema, partition_cols, version=version, units=units, emptied=emptied)
    return n_rows


def _undo(history: History, record: dict) -> None:
    """Remove the files that an append has moved into the table."""
    for place in record["places"] if record["mark"] else ():
        folder = f"{history.path.rstrip('/')}/{place}".rstrip("/")
        left = files.names(history.spark, folder)
        own = [file for file in left if files.job_of(file) == record["mark"]]
        for file in own:
            files.remove(history.spark, f"{folder}/{file}")
        if place and own == left and place in record["creates"]:
            files.remove(history.spark, folder)


def recover(history: History) -> None:
    """Take back the appends that were cut off. Only loads do this, before anything else."""
    for r in history.unfinished():
        _undo(history, r)
        schema = T.StructType.fromJson(json.loads(r["table_schema"]))
        history.record(r["load_id"], r["load_tag"], r["mode"], UNDONE, None, schema, r["partition_cols"])


def _append(
    history: History, df: DataFrame, schema: T.StructType, partition_cols: Sequence[str],
    load_id: str, tag: str, mode: str, present: bool, arranged: bool,
) -> int:
    """Stage rows, log where they go, move their files there, log the end.

    An append of the same id that ended before is replaced by this one, so that
    repeating a load doesn't repeat its rows.
    """
    spark, path = history.spark, history.path.rstrip("/")
    version, folder = _new_version(path)
    n_rows = _put(df, folder, partition_cols, arranged)
    if n_rows is None:
        n_rows = spark.read.schema(schema).parquet(folder).count()
    staged = _staged_units(spark, folder, len(partition_cols))
    replaced = history.versions()
    last = sorted({u.rsplit("/", 1)[-1] for u in staged})
    there = live_units(history, last if partition_cols else None) if present else {}
    # A partition that has been emptied starts anew in the staged folder.
    own = [u for u in staged if u in replaced and replaced[u][0] is None]
    place = {u: f"{VERSIONS}/{version}/{u}" if u in own else there.get(u, u) for u in staged}
    earlier = [r for r in history.done if mode == "append" == r["mode"] and r["load_id"] == load_id and r["mark"]]
    for r in earlier:
        if any(replaced[u][1]["seq"] > r["seq"] for u in map(unit_at, r["places"]) if u in replaced):
            raise ValueError(f"the rows of load {load_id} have been rewritten since; they can't be appended again")
    new = [u for u in staged if u not in there and u not in own]
    first = next((f for u in staged for f in files.names(spark, f"{folder}/{u}".rstrip("/"), ".parquet")), "")
    job, places = files.job_of(first), sorted(place.values())
    history.record(load_id, tag, mode, STARTED if present else CREATING, None, schema, partition_cols, places=places, creates=new, mark=job)
    moves = []
    for unit, target in place.items():
        source, to = f"{folder}/{unit}".rstrip("/"), f"{path}/{target}".rstrip("/")
        if unit in own:
            continue
        if unit and unit in new:  # the whole folder
            moves.append((source, to))
        else:
            moves += [(f"{source}/{f}", f"{to}/{f}") for f in files.names(spark, source, ".parquet")]
    for parent in {to.rsplit("/", 1)[0] for _, to in moves} or {path}:
        files.make_folder(spark, parent)
    with ThreadPoolExecutor(_MOVERS) as pool:
        list(pool.map(lambda m: files.move(spark, *m), moves))
    undone = [r["mark"] for r in earlier]
    _commit(history, load_id, tag, mode, n_rows, schema, partition_cols,
            version=version if own else None, units=own, places=places, creates=new, mark=job, undone=undone)
    for r in earlier:
        _undo(history, r)
    if not own:
        files.remove(spark, folder)
    return n_rows


def unit_at(place: str) -> str:
    """The unit that lies at a place."""
    return "/".join(place.split("/")[2:]) if place.startswith(f"{VERSIONS}/") else place


def _rebalanced(df: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Few, even files per directory; AQE splits a partition value that holds much of the data."""
    return df.hint("rebalance", *[col(c) for c in partition_cols])


def write(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    partition_cols: Sequence[str] = (),
    tag: str = "",
    where: Column | None = None,
    load_id: str | None = None,
    zorder_cols: Sequence[str] = (),
    file_bytes: int = FILE_BYTES,
) -> Written:
    """Write ``df`` in one of Spark's save modes.

    ``overwrite`` with a partition column replaces only rows matching ``where``
    in the incoming partitions; without one it replaces the table. Both cluster
    by ``zorder_cols`` on the way, and so do first loads and unpartitioned
    appends, of the rows they bring, into files of about ``file_bytes``. An append
    to partitions is one pass over ``df`` and leaves clustering to ``cluster_table``.
    """
    mode = mode.lower()
    load_id = load_id or files.new_load_id()
    partition_cols = [resolve(df, c) for c in partition_cols]
    history = _opened(spark, path, partition_cols)
    present = _present(history)
    if mode == "overwrite" and partition_cols and present:
        return overwrite_where(spark, df, path, partition_cols, where, tag, load_id, zorder_cols, file_bytes)
    if present and mode == "ignore":
        return Written(0)
    if present and mode in ("error", "errorifexists", "default"):
        raise FileExistsError(f"{path} already exists")
    recover(history)
    df = blank_partitions_to_null(df, partition_cols)
    present_schema = _schema(history, partition_cols) if present else T.StructType()
    schema = evolved_schema(present_schema, df.schema)
    df = conform(df, schema)
    if mode == "overwrite" and partition_cols:
        df = check_incoming(df, where, partition_cols[-1])
    arranged = bool(zorder_cols) and not (present and partition_cols)
    folder = f"{files.staging_root(spark, path)}/{load_id}"
    if arranged:
        # Clustering looks at the rows several times; the source is read once.
        landed, _ = land(spark, df, f"{folder}/incoming")
        df = zorder(landed, zorder_cols, partition_cols, _planned_files(spark, [f"{folder}/incoming"], file_bytes))
    if present and mode == "overwrite":
        n_rows = _replace(history, df, (), None, load_id, tag, mode, None, arranged)
    else:
        # What the other modes allow has been settled above.
        n_rows = _append(history, df, schema, partition_cols, load_id, tag, mode, present, arranged)
    if arranged:
        files.remove(spark, folder)
    return Written(n_rows, clustered=arranged)


def overwrite_where(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str],
    where: Column | None = None,
    tag: str = "",
    load_id: str | None = None,
    zorder_cols: Sequence[str] = (),
    file_bytes: int = FILE_BYTES,
) -> Written:
    """Replace target rows for which ``where`` holds and whose last partition
    column has an incoming value. Incoming rows must satisfy the same predicate.
    Empty incoming data changes nothing.
    """
    load_id = load_id or files.new_load_id()
    partition_cols = [resolve(df, c) for c in partition_cols]
    history = _opened(spark, path, partition_cols)
    if not _present(history):
        return write(spark, df, path, "overwrite", partition_cols, tag, where, load_id, zorder_cols, file_bytes)
    recover(history)
    folder = f"{files.staging_root(spark, path)}/{load_id}"
    present = _schema(history, partition_cols)
    incoming = blank_partitions_to_null(df, partition_cols)
    incoming, n_rows = land(spark, incoming, f"{folder}/incoming")
    if n_rows:
        scope = partition_scope(incoming, partition_cols[-1])
        names = _folder_names(scope)
        target = _read(history, present, names)
        content = replace_touched(target, incoming, where, scope.column)
        n_files = None
        if zorder_cols:
            # Without a predicate no old row stays.
            kept = [] if where is None else _places(history, names)
            n_files = _planned_files(spark, [*kept, f"{folder}/incoming"], file_bytes)
        arrange = _clustering(zorder_cols, partition_cols, target, incoming, n_files)
        _replace_partitions(history, content, partition_cols, names, arrange, load_id, tag, "overwrite", n_rows)
    files.remove(spark, folder)
    return Written(n_rows, clustered=bool(zorder_cols))


def upsert_table(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_cols: Sequence[str] = (),
    mode: str = "errorifexists",
    tag: str = "",
    load_id: str | None = None,
    zorder_cols: Sequence[str] = (),
    file_bytes: int = FILE_BYTES,
) -> Written:
    """Update matching rows and insert the others; a missing table is written plainly.

    With a partition column only target rows in incoming partitions can match.
    Target rows whose keys aren't among the incoming ones are told apart by a bitmap
    of key hashes, written once, and take no part in the joins.
    """
    load_id = load_id or files.new_load_id()
    partition_cols = [resolve(df, c) for c in partition_cols]
    history = _opened(spark, path, partition_cols)
    if not _present(history):
        return write(spark, df, path, mode, partition_cols, tag, None, load_id, zorder_cols, file_bytes)
    recover(history)
    folder = f"{files.staging_root(spark, path)}/{load_id}"
    schema = _schema(history, partition_cols)
    incoming = blank_partitions_to_null(df, partition_cols)
    incoming, n_rows = land(spark, incoming, f"{folder}/incoming")
    if n_rows:
        names = _folder_names(partition_scope(incoming, partition_cols[-1])) if partition_cols else None
        target = _read(history, schema, names)
        known = source_keys(target, incoming, keys, n_rows)
        known = replace(known, words=land(spark, known.words, f"{folder}/keys")[0])
        n_files = _planned_files(spark, [*_places(history, names), f"{folder}/incoming"], file_bytes) if zorder_cols else None
    if n_rows and partition_cols:
        # Rows of the null partition match nothing; they are carried, as inserts may land beside them.
        nowhere = col(partition_cols[-1]).isNull()
        content = upsert(target.where(~nowhere), incoming, keys, key_filter=known).unionByName(target.where(nowhere))
        arrange = _clustering(zorder_cols, partition_cols, target, incoming, n_files)
        _replace_partitions(history, content, partition_cols, names, arrange, load_id, tag, "merge", n_rows)
    elif n_rows:
        content = upsert(target, incoming, keys, key_filter=known)
        content = zorder(content, zorder_cols, files=n_files) if zorder_cols else content
        _replace(history, content, (), None, load_id, tag, "merge", n_rows, bool(zorder_cols))
    else:
        _commit(history, load_id, tag, "merge", 0, schema, partition_cols)
    files.remove(spark, folder)
    return Written(n_rows, clustered=bool(zorder_cols))


Arrange = Callable[[DataFrame], DataFrame]


def _clustering(
    zorder_cols: Sequence[str],
    partition_cols: Sequence[str],
    target: DataFrame,
    incoming: DataFrame,
    n_files: int | None,
) -> Arrange | None:
    """Z-ordering of rewritten partitions, with bounds from plain scans of the
    old and incoming rows. Range partitioning still samples the rewrite, above
    its last shuffle."""
    if not zorder_cols:
        return None
    wanted = {c.lower() for c in zorder_cols}

    def narrow(df: DataFrame) -> DataFrame:
        return df.select([col(c) for c in df.columns if c.lower() in wanted])

    like = append_rows(narrow(target), narrow(incoming))
    return lambda df: zorder(df, zorder_cols, partition_cols, n_files, like=like)


def _replace_partitions(
    history: History, content: DataFrame, partition_cols: Sequence[str], names: Sequence[str],
    arrange: Arrange | None, load_id: str, tag: str, mode: str, n_rows: int,
) -> None:
    """Put ``content`` in place of the folders it touches.

    A single folder takes the splits its content was computed in, several are
    rebalanced. The driver sees the touched folders, never the files of the table.
    """
    one_folder = len(partition_cols) == 1 and len(names) == 1
    content = arrange(content) if arrange else content
    _replace(history, content, partition_cols, names, load_id, tag, mode, n_rows, bool(arrange) or one_folder)


def cluster_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    partition_cols: Sequence[str] = (),
    scope: PartitionScope | None = None,
    files_per_write: int | None = None,
    load_id: str | None = None,
    file_bytes: int = FILE_BYTES,
) -> None:
    """Z-order the touched partitions (or the whole table) by ``columns``.

    Writes ``files_per_write`` ranges of rows, or as many as make files of about
    ``file_bytes``; a partition that ends within a range has a smaller last file.
    """
    history = _opened(spark, path, partition_cols)
    recover(history)
    schema = _schema(history, partition_cols)
    names = _folder_names(scope) if scope is not None and partition_cols else None
    n_files = files_per_write or _planned_files(spark, _places(history, names), file_bytes)
    content = zorder(_read(history, schema, names), columns, partition_cols, n_files)
    _replace(history, content, partition_cols, names, load_id or files.new_load_id(), "", "cluster", None, True)
