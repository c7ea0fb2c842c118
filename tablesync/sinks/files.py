"""Folders: existence, removal, file listings and where a load may stage data."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where a data file's name has the mark of the write that made it.
JOB_IN_NAME = r"^part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})"
_NAMES_PER_GLOB = 200
LISTING = "struct<path: string, modificationTime: timestamp, length: bigint>"


def new_load_id() -> str:
    return uuid.uuid4().hex


_systems: dict[tuple, object] = {}


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, asked for once, and the path."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    key = id(spark._jvm), re.match(r"(?:[^:/]+:(?://[^/]*)?)?", path)[0]
    if key not in _systems:
        _systems[key] = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return _systems[key], hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def has_visible_child(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds anything but hidden entries; stops at the first find."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return False
    found = fs.listStatusIterator(p)
    while found.hasNext():
        name = found.next().getPath().getName()
        if "=" in name or not name.startswith(("_", ".")):
            return True
    return False


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.mkdirs(p)


def names(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """Names of the visible entries of a folder."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return []
    found = (s.getPath().getName() for s in fs.listStatus(p))
    return sorted(n for n in found if n.endswith(suffix) and ("=" in n or not n.startswith(("_", "."))))


def create(spark: SparkSession, path: str, content: str) -> None:
    """A new small file, seen whole or not at all; one of that name is never overwritten."""
    fs, p = _hadoop(spark, path)
    if fs.exists(p):
        raise FileExistsError(f"{path} is there already: another load is running")
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    out = fs.create(_hadoop(spark, draft)[1], False)
    try:
        out.write(bytearray(content.encode()))
    finally:
        out.close()
    move(spark, draft, path)


def text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    fs, p = _hadoop(spark, path)
    source = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a file or folder within its file system; a target that is there already is an error."""
    fs, source = _hadoop(spark, path)
    if not fs.rename(source, _hadoop(spark, target)[1]):
        raise OSError(f"{path} could not be moved to {target}")


def job_of(file: str) -> str | None:
    """The mark that all data files of one Spark write carry in their names."""
    found = re.match(JOB_IN_NAME, file)
    return found and found[1]


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    fs, p = _hadoop(spark, path)
    return fs.getContentSummary(p).getLength()


def data_size(spark: SparkSession, path: str) -> int:
    """Bytes of the visible files that lie in a folder itself."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return 0
    found = (s for s in fs.listStatus(p) if s.isFile())
    return sum(s.getLen() for s in found if not s.getPath().getName().startswith(("_", ".")))


def matching(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """What a glob pattern matches, as (path, modification time in ms)."""
    fs, p = _hadoop(spark, pattern)
    return [(s.getPath().toString(), s.getModificationTime()) for s in fs.globStatus(p) or ()]


def qualified(spark: SparkSession, path: str) -> str:
    """The path as file listings show it."""
    fs, p = _hadoop(spark, path)
    return fs.makeQualified(p).toString()


def listing(spark: SparkSession, path: str) -> DataFrame:
    """One row per visible file below ``path``; file contents are not read."""
    if not exists(spark, path):
        return spark.range(0).select(F.lit(None).cast(LISTING).alias("file")).select("file.*")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "modificationTime", "length")
    )


def staging_root(spark: SparkSession, path: str) -> str:
    """Folder for the interim data of loads into ``path``.

    It lies in the shared folder the session names in ``spark.checkpoint.dir``,
    or else beside the table, on the table's own storage.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        return f"{path.rstrip('/')}__staging"
    name = path.rstrip("/").rsplit("/", 1)[-1]
    digest = hashlib.sha256(path.rstrip("/").encode()).hexdigest()[:16]
    return f"{shared.rstrip('/')}/tablesync/{name}-{digest}"


#: What a partition folder's name writes as % and two digits.
_ESCAPED = {*map(chr, range(1, 32)), *"\"#%'*/:=?\\\x7f{[]^"}
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def folder_name(column: str, value: str | None) -> str:
    """Name of a partition's folder; ``value`` as Spark casts it to text."""
    escaped = ("".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in part) for part in (column, value or NULL_PARTITION))
    return "=".join(escaped)


def folder_value(name: str) -> tuple[str, str | None]:
    """Column and value of a partition folder's name."""
    column, value = (re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), part) for part in name.split("=", 1))
    return column, None if value == NULL_PARTITION else value


def _as_glob(name: str) -> str:
    return re.sub(r"([\\*?{}\[\],])", r"\\\1", name)


def folders_named(spark: SparkSession, root: str, level: int, names: Sequence[str] | None) -> list[str]:
    """Folders with one of the names (None: any), ``level`` steps below ``root``, by their paths from there.

    Lists the folders above that level, but no files.
    """
    start, found = len(qualified(spark, root)) + 1, []
    if names is None:
        return [path[start:] for path, _ in matching(spark, f"{root.rstrip('/')}/{'/'.join(['*=*'] * level)}")]
    for i in range(0, len(names), _NAMES_PER_GLOB):
        own = ",".join(map(_as_glob, names[i : i + _NAMES_PER_GLOB]))
        for path, _ in matching(spark, f"{root.rstrip('/')}/{'*/' * (level - 1)}{{{own}}}"):
            found.append(path[start:])
    return found


def folders(spark: SparkSession, root: str) -> DataFrame:
    """Distinct folders holding files below ``root``, by their paths from there (``relative``)."""
    folder = F.regexp_replace("path", "/[^/]+$", "")
    relative = F.substring(folder, len(qualified(spark, root)) + 2, 2**31 - 1)
    return listing(spark, root).select(relative.alias("relative")).distinct()
