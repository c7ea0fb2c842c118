from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablesync import LoadSpec, scan
from tablesync.sources import frames
from tablesync.sources.jdbc import JdbcSource, Split, query_as_table, schema_override, table_name

# No database runs here: these tests cover what a JDBC reader is asked for.
SOURCE = JdbcSource("jdbc:db://host", "org.db.Driver", 1000, 8, {"user": "u", "password": "p"})


def test_reader_options():
    options = SOURCE.reader_options(table_name("dbo", "t"))
    assert options == {
        "url": "jdbc:db://host",
        "dbtable": "dbo.t",
        "fetchsize": "1000",
        "preferTimestampNTZ": "true",
        "driver": "org.db.Driver",
        "user": "u",
        "password": "p",
    }


def test_parallel_read_options():
    options = SOURCE.reader_options("t", Split("d", date(2021, 1, 1), date(2021, 2, 1)), "d DATE")
    assert options["customSchema"] == "d DATE"
    assert [options[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")] == [
        "d", "2021-01-01", "2021-02-01", "8",
    ]
    single = JdbcSource("jdbc:db://host").reader_options("t", Split("d", 1, 2))
    assert "partitionColumn" not in single and single["fetchsize"] == "50000"


def test_names_and_queries():
    assert table_name("", "t") == "t"
    assert query_as_table("select 1") == "(select 1) subq"
    assert "password" not in repr(SOURCE)


def test_jdbc_needs_a_url(spark):
    with pytest.raises(ValueError, match="jdbcUrl"):
        scan(spark, LoadSpec(path_to_save="/x", tab="t"))


@pytest.mark.parametrize(
    "rows,ddl",
    [
        ([("b", "date", 2), ("a", " DATE ", 1), ("c", "int", 3)], "a DATE, b DATE"),
        ([("order date", "date", 1), ("a`b", "date", 2)], "`order date` DATE, `a``b` DATE"),
        ([("c", "int", 1), ("d", "datetime", 2)], ""),
        ([], ""),
    ],
)
def test_schema_override(spark, rows, ddl):
    metadata = spark.createDataFrame(rows, "column_name string, data_type string, position int")
    assert schema_override(metadata, "position").first()["ddl"] == ddl


class Reader:
    """Stands in for ``spark.read``: remembers each scan's options, answers with given frames."""

    def __init__(self, answers):
        self.answers = answers
        self.asked = []
        self.read = self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.asked.append(options)
        return self

    def load(self):
        table = self.asked[-1]["dbtable"]
        return next(frame for part, frame in self.answers.items() if part in table)


SPEC = {"path_to_save": "/x", "tab": "orders", "jdbcUrl": "jdbc:db://host", "partitions_number": "4"}


def orders(spark):
    return spark.read.parquet("/root/testdata/sf0.001/orders.parquet")


def test_window_splits_the_read(spark):
    reader = Reader({"dbo.orders": orders(spark)})
    spec = LoadSpec.from_params(
        SPEC | {"dtflt": "O_ORDERDATE", "exec_date": "1996-01-02", "where": "o_custkey > 5"}
    )
    rows = scan(reader, spec)
    last = reader.asked[-1]
    assert (last["partitionColumn"], last["numPartitions"]) == ("o_orderdate", "4")
    assert (last["lowerBound"], last["upperBound"]) == ("1996-01-02", "1996-01-03")
    wanted = "o_orderdate >= '1996-01-02' and o_orderdate < '1996-01-03' and o_custkey > 5"
    assert rows.count() == orders(spark).where(wanted).count()
    assert rows.rdd.getNumPartitions() != 4


def test_the_source_gets_the_predicate_as_text(spark):
    spec = SPEC | {"where": "o_custkey > 5"}
    reader = Reader({"dbo.orders": orders(spark)})
    wanted = orders(spark).where("o_custkey > 5").count()
    assert scan(reader, LoadSpec.from_params(spec)).count() == wanted
    assert reader.asked[-1]["dbtable"] == "(SELECT * FROM dbo.orders WHERE o_custkey > 5) filtered"
    assert scan(reader, LoadSpec.from_params(spec | {"where_at_source": "false"})).count() == wanted
    assert reader.asked[-1]["dbtable"] == "dbo.orders"
    reader = Reader({"(select * from t) subq": orders(spark)})
    scan(reader, LoadSpec.from_params(spec | {"query": "select * from t"}))
    assert "FROM (select * from t) subq WHERE" in reader.asked[-1]["dbtable"]


def test_text_windows_do_not_split(spark):
    reader = Reader({"dbo.orders": orders(spark)})
    spec = LoadSpec.from_params(SPEC | {"dtflt": "o_orderstatus", "exec_date": "1996-01-02"})
    scan(reader, spec)
    assert "partitionColumn" not in reader.asked[-1]


def test_split_column_bounds_come_from_the_source(spark):
    ends = spark.createDataFrame([(Decimal("1.0000000000"), Decimal("99.5"))], "a decimal(20,10), b decimal(20,10)")
    reader = Reader({"MIN(o_orderkey)": ends, "(select * from t) subq": orders(spark)})
    spec = LoadSpec.from_params(SPEC | {"query": "select * from t", "split_column": "o_orderkey"})
    scan(reader, spec)
    assert "FROM (select * from t) subq" in reader.asked[-2]["dbtable"]
    assert (reader.asked[-1]["lowerBound"], reader.asked[-1]["upperBound"]) == ("1", "99")


def test_empty_sources_are_not_split(spark):
    ends = spark.sql("SELECT CAST(NULL AS INT), CAST(NULL AS INT)")
    reader = Reader({"MIN(": ends, "dbo.orders": orders(spark)})
    scan(reader, LoadSpec.from_params(SPEC | {"split_column": "o_orderkey"}))
    assert "partitionColumn" not in reader.asked[-1]


def test_override_types_reads_the_source_catalog(spark):
    listed = spark.sql("""SELECT * FROM VALUES ('dbo', 'orders', 'o_orderdate', 'Date'),
        ('dbo', 'orders', 'o_orderkey', 'int'), ('dbo', 'other', 'x', 'date')
        AS t(TABLE_SCHEMA, TABLE_NAME, COLUMN_NAME, DATA_TYPE)""")
    reader = Reader({"INFORMATION_SCHEMA.COLUMNS": listed, "dbo.orders": orders(spark)})
    scan(reader, LoadSpec.from_params(SPEC | {"override_types": "true"}))
    assert reader.asked[-1]["customSchema"] == "o_orderdate DATE"


def test_frame_scans(spark):
    df = spark.range(10).toDF("a b")
    assert frames.filtered(df, None) is df
    assert frames.redistribute(df, None) is df
    spread = frames.redistribute(df, 3).select(F.spark_partition_id().alias("p")).distinct()
    assert spread.count() <= 3
    assert frames.query_scan(spark, "SELECT count(*) n FROM {t}", t=df).first()["n"] == 10
    typed = frames.apply_schema_override(spark.sql("SELECT '2021-01-02' d, 1 i"), {"D": "DATE"})
    assert typed.first()["d"] == date(2021, 1, 2)


def test_scan_filters_before_reading(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    spec = LoadSpec(
        path_to_save="/x", tab="t", dtflt="o_orderdate", exec_date="1996-01-02", where="o_custkey > 5"
    )
    plan = scan(spark, spec, orders)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_custkey,5)" in plan and "LessThan(o_orderdate" in plan
    assert "Exchange" not in plan
