from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablesync.operators import predicates as pred


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_conjunction(spark):
    df = spark.range(4)
    assert df.where(pred.conjunction()).count() == 4
    assert df.where(pred.conjunction(F.col("id") > 0, None, F.col("id") < 3)).count() == 2
    assert pred.user_predicate("  ") is None


WINDOW = (date(2021, 6, 1), date(2021, 6, 2))


@pytest.mark.parametrize(
    "cast", ["timestamp_ntz", "string"]
)
def test_half_open_window(spark, cast):
    values = ["2021-05-31T23:59:59.999", "2021-06-01T00:00:00.000", "2021-06-01T23:59:59.999",
              "2021-06-02T00:00:00.000"]
    df = spark.createDataFrame([(v,) for v in values], "t string").select(F.col("t").cast(cast))
    assert df.where(pred.time_window(df, "T", *WINDOW)).count() == 2


def test_window_on_dates_and_utc_columns(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2021-05-30', DATE'2021-06-03')) d")
    assert [r[0] for r in days.where(pred.time_window(days, "d", *WINDOW)).collect()] == [WINDOW[0]]
    # A date column holds source-local days, so a zone does not move it.
    assert days.where(pred.time_window(days, "d", *WINDOW, zone="Europe/Kiev")).count() == 1
    stored = spark.sql("""SELECT explode(array(TIMESTAMP_NTZ'2021-05-31 20:59:59',
        TIMESTAMP_NTZ'2021-05-31 21:00:00', TIMESTAMP_NTZ'2021-06-01 20:59:59',
        TIMESTAMP_NTZ'2021-06-01 21:00:00')) t""")
    assert stored.where(pred.time_window(stored, "t", *WINDOW, zone="Europe/Kiev")).count() == 2
    zoned = spark.sql("""SELECT explode(array(TIMESTAMP'2021-05-31 20:59:59Z',
        TIMESTAMP'2021-05-31 21:00:00Z', TIMESTAMP'2021-06-01 20:59:59Z',
        TIMESTAMP'2021-06-01 21:00:00Z')) t""")
    assert zoned.where(pred.time_window(zoned, "t", *WINDOW, zone="Europe/Kiev")).count() == 2


def test_window_is_pushed_to_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    text = plan(orders.where(pred.time_window(orders, "o_orderdate", *WINDOW)).select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate" in text and "LessThan(o_orderdate" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in text


@pytest.mark.parametrize(
    "type_name,values",
    [
        ("string", ["007", "it's", "true", None]),
        ("int", [-5, 0, None]),
        ("boolean", [True, None]),
        ("date", [date(2021, 6, 1), None]),
        ("decimal(5,2)", [Decimal("1.50"), None]),
    ],
)
def test_scope_by_type(spark, type_name, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, p {type_name}")
    doubled = df.union(df)
    scope = pred.partition_scope(doubled, "P")
    assert scope.has_null and not scope.is_empty
    assert scope.values.count() == len(values) - 1
    assert scope.inside(doubled).count() == 2 * (len(values) - 1)
    flags = {(r["p"], r["in"]) for r in scope.tag(doubled, "in").collect()}
    assert flags == {(v, v is not None) for v in values}


def test_scope_of_nothing(spark):
    df = spark.createDataFrame([], "id int, p string")
    scope = pred.partition_scope(df, "p")
    assert scope.is_empty and not scope.has_null
    assert scope.inside(spark.sql("SELECT 1 id, 'a' p")).isEmpty()


def test_scope_of_wall_clocks(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2021-06-01 01:30:00.5' p")
    assert pred.partition_scope(df, "p").inside(df).count() == 1


def test_merge_condition_text(spark):
    text = str(pred.merge_condition(["k", "l"], F.col("target.inside"), "s_", "t_"))
    for part in ("target.inside", "source.`s_k`", "target.`t_k`", "source.`s_l`"):
        assert part.replace("`", "") in text.replace("`", "")


def test_checked(spark):
    df = spark.range(3).withColumn("p", F.when(F.col("id") < 2, F.col("id")))
    assert pred.checked(df.where("id < 2"), F.col("p").isNotNull(), "p", "bad").count() == 2
    with pytest.raises(Exception, match="bad row"):
        pred.checked(df, F.col("p") >= 0, "p", "bad row").collect()
