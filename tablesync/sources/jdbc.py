"""JDBC scans with parallel reads and source-side filtering."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.sources.frames import filtered, redistribute

# Source type (lower case, trimmed) -> Spark type read instead.
TYPE_OVERRIDES = {
    "date": "DATE",
}


@dataclass(frozen=True)
class Split:
    """A column whose range ``[lower, upper)`` is cut into stripes read in parallel.

    The bounds only place the stripes: rows outside them fall into the first or
    last stripe and are still read.
    """

    column: str
    lower: str | int | date | None = None
    upper: str | int | date | None = None


@dataclass(frozen=True)
class JdbcSource:
    url: str
    driver: str | None = None
    fetch_size: int = 50_000
    partitions: int | None = None
    options: Mapping[str, str] = field(default_factory=dict, repr=False)  # may hold credentials

    def reader_options(
        self, dbtable: str, split: Split | None = None, custom_schema: str = ""
    ) -> dict[str, str]:
        """All options of one scan.

        ``preferTimestampNTZ`` keeps source wall clocks free of the session zone.
        """
        options = {
            "url": self.url,
            "dbtable": dbtable,
            "fetchsize": str(self.fetch_size),
            "preferTimestampNTZ": "true",
        }
        if self.driver:
            options["driver"] = self.driver
        if custom_schema:
            options["customSchema"] = custom_schema
        if split and self.partitions and self.partitions > 1:
            options |= {
                "partitionColumn": split.column,
                "lowerBound": str(split.lower),
                "upperBound": str(split.upper),
                "numPartitions": str(self.partitions),
            }
        return options | dict(self.options)

    def load(
        self,
        spark: SparkSession,
        dbtable: str,
        predicate: Column | None = None,
        split: Split | None = None,
        custom_schema: str = "",
    ) -> DataFrame:
        """Scan a table or parenthesised query; the typed predicate is pushed to the source.

        With a split the read itself is parallel. Without one, a requested
        partition count redistributes the rows of the single connection.
        """
        if split and split.lower is None and self.partitions and self.partitions > 1:
            split = self._with_bounds(spark, dbtable, split)
        options = self.reader_options(dbtable, split, custom_schema)
        df = filtered(spark.read.format("jdbc").options(**options).load(), predicate)
        return df if "partitionColumn" in options else redistribute(df, self.partitions)

    def _with_bounds(self, spark: SparkSession, dbtable: str, split: Split) -> Split | None:
        """Smallest and largest value of the split column, aggregated inside the source."""
        name = split.column
        if not re.fullmatch(r"[A-Za-z_]\w*", name):  # in the quotes of the source's dialect
            name = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url).quoteIdentifier(name)
        query = f"(SELECT MIN({name}) AS low, MAX({name}) AS high FROM {dbtable}) ends"
        ends = spark.read.format("jdbc").options(**self.reader_options(query)).load().first()
        if ends[0] is None:
            return None
        low, high = (int(e) if isinstance(e, (Decimal, float)) else e for e in ends)
        return Split(split.column, low, high)


def table_name(schema: str, table: str) -> str:
    return f"{schema}.{table}" if schema else table


def query_as_table(query: str) -> str:
    return f"({query}) subq"


def filtered_table(dbtable: str, where: str) -> str:
    """A table or query whose rows the source itself filters, by its own reading of ``where``."""
    return f"(SELECT * FROM {dbtable} WHERE {where}) filtered"


def quoted_name(name: Column) -> Column:
    """Names that aren't plain words in backquotes."""
    quoted = F.concat(F.lit("`"), F.replace(name, F.lit("`"), F.lit("``")), F.lit("`"))
    return F.when(name.rlike("^[A-Za-z_][A-Za-z_0-9]*$"), name).otherwise(quoted)


def schema_override(metadata: DataFrame, order_by: str | None = None) -> DataFrame:
    """One row ``ddl``: ``"col TYPE, col TYPE"`` for columns whose source type is overridden.

    ``metadata`` lists one table's columns as ``column_name, data_type``. The
    text is empty when no column needs an override.
    """
    kind = F.lower(F.trim(F.col("data_type")))
    override = F.create_map(*[F.lit(x) for pair in TYPE_OVERRIDES.items() for x in pair])
    entries = metadata.where(kind.isin(*TYPE_OVERRIDES)).select(
        F.concat_ws(" ", quoted_name(F.col("column_name")), override[kind]).alias("entry"),
        F.col(order_by or "column_name").alias("position"),
    )
    listed = F.expr("listagg(entry, ', ') WITHIN GROUP (ORDER BY position)")
    return entries.agg(F.coalesce(listed, F.lit("")).alias("ddl"))


def custom_schema(
    spark: SparkSession, source: JdbcSource, schema: str, table: str
) -> str:
    """The override text of one source table, from its catalog view."""
    catalog = source.load(
        spark,
        "INFORMATION_SCHEMA.COLUMNS",
        (F.col("TABLE_NAME") == table) & (F.col("TABLE_SCHEMA") == schema),
    )
    named = catalog.select(
        F.col("COLUMN_NAME").alias("column_name"), F.col("DATA_TYPE").alias("data_type")
    )
    return schema_override(named).first()["ddl"]
