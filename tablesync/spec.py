"""What to load, from where, and how to write it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from datetime import date, datetime

from pyspark.sql import Column

from tablesync.functions.names import clean_column, name_list, target_table_name
from tablesync.operators.normalize import GeneratedColumn
from tablesync.operators.predicates import day_window

MODES = ("errorifexists", "error", "default", "ignore", "append", "overwrite")


def _flag(value: bool | str) -> bool:
    if isinstance(value, bool):
        return value
    text = value.strip().lower()
    if text not in ("true", "false"):
        raise ValueError(f"expected true or false, got {value!r}")
    return text == "true"


def _day(value: str | date) -> date | None:
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date) or not value:
        return value or None
    return datetime.strptime(value, "%Y-%m-%d").date()


@dataclass(frozen=True)
class LoadSpec:
    """Parameters of one load.

    List parameters take a list or text like ``"['a', b]"``; flags and numbers
    take text too, so a mapping of strings works through ``from_params``.
    """

    path_to_save: str = ""
    tab: str = ""
    schema: str = "dbo"
    where: str = ""
    query: str = ""
    jdbcUrl: str = field(default="", repr=False)  # may hold credentials
    fetch_size: int = 50_000
    partitions_number: int | None = None
    mode: str = "errorifexists"
    calc_min_dt: str | date = ""
    calc_max_dt: str | date = ""
    dtflt: str = ""
    exec_date: str | date = ""
    write_partitioned: bool = False
    partition_col: tuple[str, ...] = ()
    use_merge: bool = False
    merge_keys: tuple[str, ...] = ()
    hive_db: str = ""
    hive_db_location: str = ""
    generate_column: bool = False
    generated_column_name: str = ""
    generated_column_exp: str = ""
    generated_column_type: str = ""
    timezone: str = "Europe/Kiev"
    force_partition: bool = False
    change_tracking: bool = False
    primary_key: tuple[str, ...] = ()
    zorderby_col: tuple[str, ...] = ()
    log_lvl: str = ""
    log_spark_lvl: str = ""
    disable_platform_ingested_at: bool = False
    # Below: settings of this library only.
    full_overwrite: bool = False  # allow a filtered overwrite to replace an unpartitioned table
    jdbc_driver: str | None = None
    jdbc_options: Mapping[str, str] = field(default_factory=dict, repr=False)
    split_column: str = ""  # parallel JDBC read; a date window splits on dtflt by default
    where_at_source: bool = True  # put ``where`` into the JDBC query as well; its text must suit both
    override_types: bool = False  # look source types up in the source catalog first
    load_tag: str = ""
    ingested_at: datetime | Column | None = None
    retention_hours: float = 168

    def __post_init__(self) -> None:
        put = lambda name, value: object.__setattr__(self, name, value)
        for name in ("partition_col", "merge_keys", "primary_key", "zorderby_col"):
            put(name, name_list(getattr(self, name)))
        for name in (
            "write_partitioned", "use_merge", "generate_column", "force_partition",
            "change_tracking", "disable_platform_ingested_at", "full_overwrite", "override_types",
            "where_at_source",
        ):
            put(name, _flag(getattr(self, name)))
        for name in ("calc_min_dt", "calc_max_dt", "exec_date"):
            put(name, _day(getattr(self, name)))
        put("fetch_size", int(self.fetch_size))
        put("partitions_number", int(self.partitions_number) if self.partitions_number else None)
        put("mode", self.mode.lower())
        self._validate()

    @classmethod
    def from_params(cls, params: Mapping[str, object]) -> LoadSpec:
        """Build from name-value pairs; the text ``None`` keeps a default."""
        known = {f.name for f in fields(cls)}
        unknown = sorted(set(params) - known)
        if unknown:
            raise ValueError(f"unknown parameters {unknown}")
        given = {k: v for k, v in params.items() if v is not None}
        return cls(**{k: v for k, v in given.items() if not (isinstance(v, str) and v == "None")})

    def _validate(self) -> None:
        def require(ok: bool, message: str) -> None:
            if not ok:
                raise ValueError(message)

        require(bool(self.path_to_save), "path_to_save is required")
        require(bool(self.tab), "tab is required")
        require(self.mode in MODES, f"mode must be one of {MODES}")
        require(
            bool(self.dtflt) == (self.window is not None),
            "dtflt goes together with exec_date or with calc_min_dt and calc_max_dt",
        )
        require(self.use_merge == bool(self.merge_keys), "use_merge and merge_keys go together")
        require(
            self.write_partitioned == bool(self.partition_col),
            "write_partitioned and partition_col go together",
        )
        filtered_by_partition = (
            not (self.dtflt and self.write_partitioned)
            or clean_column(self.dtflt) in self.partition_columns
        )
        require(
            filtered_by_partition or self.use_merge or self.force_partition,
            "dtflt must be a partition column unless use_merge or force_partition is set",
        )
        generated = (
            self.generate_column,
            bool(self.generated_column_name),
            bool(self.generated_column_exp),
            bool(self.generated_column_type),
        )
        require(len(set(generated)) == 1, "the four generate(d)_column settings go together")
        require(bool(self.hive_db_location) or not self.hive_db, "hive_db needs hive_db_location")
        require(
            self.change_tracking == bool(self.primary_key),
            "change_tracking and primary_key go together",
        )
        require(
            self.full_overwrite or not self.replaces_whole_table or not (self.dtflt or self.where),
            "a filtered overwrite of an unpartitioned table drops every other row; "
            "set full_overwrite to allow it",
        )

    @property
    def window(self) -> tuple[date, date] | None:
        """Half-open day range; an explicit pair wins over exec_date."""
        if self.calc_min_dt and self.calc_max_dt:
            return self.calc_min_dt, self.calc_max_dt
        return day_window(self.exec_date) if self.exec_date else None

    @property
    def replaces_whole_table(self) -> bool:
        return self.mode == "overwrite" and not self.partition_col and not self.use_merge

    @property
    def table_name(self) -> str:
        return target_table_name(self.schema, self.tab)

    @property
    def path(self) -> str:
        return f"{self.path_to_save.rstrip('/')}/{self.table_name}"

    @property
    def partition_columns(self) -> tuple[str, ...]:
        return tuple(clean_column(c) for c in self.partition_col)

    @property
    def generated(self) -> GeneratedColumn | None:
        if not self.generate_column:
            return None
        return GeneratedColumn(
            self.generated_column_name, self.generated_column_exp, self.generated_column_type
        )
