from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tablesync.operators import normalize as norm
from tablesync.operators.normalize import GeneratedColumn

KIEV = "Europe/Kiev"


@pytest.fixture
def mixed(spark):
    return spark.sql("""
        SELECT * FROM VALUES
          (1, DATE'2021-06-01', TIMESTAMP'2021-06-01 01:00:00Z', TIMESTAMP_NTZ'2021-06-01 01:00:00'),
          (2, DATE'2021-12-01', TIMESTAMP'2021-12-01 01:00:00Z', TIMESTAMP_NTZ'2021-12-01 01:00:00'),
          (3, DATE'2021-03-28', TIMESTAMP'2021-03-28 03:30:00Z', TIMESTAMP_NTZ'2021-03-28 03:30:00'),
          (4, NULL, NULL, NULL) AS t(id, d, ts, tn)
    """).select(
        "*",
        F.struct(F.col("id").alias("update_id")).alias("s"),
        F.array("ts").alias("arr"),
        F.lit("x").alias("date"),
    )


@pytest.mark.parametrize("zone", ["UTC", KIEV, "America/New_York"])
def test_times_to_utc_in_any_session_zone(spark, mixed, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        out = norm.times_to_utc(mixed, KIEV)
        rows = out.select("id", "d", F.unix_seconds("ts").alias("ts"), "tn").orderBy("id").collect()
        dates = norm.partition_dates(out, ["D", "ts", "tn"], KIEV).orderBy("id").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert out.schema["s"] == mixed.schema["s"] and out.schema["arr"] == mixed.schema["arr"]

    def utc(*parts):
        return datetime(*parts, tzinfo=timezone.utc).timestamp()

    assert [r["d"] for r in rows] == [
        datetime(2021, 5, 31, 21), datetime(2021, 11, 30, 22), datetime(2021, 3, 27, 22), None,
    ]
    assert [r["tn"] for r in rows] == [
        datetime(2021, 5, 31, 22), datetime(2021, 11, 30, 23), datetime(2021, 3, 28, 1, 30), None,
    ]
    assert [r["ts"] for r in rows] == [
        utc(2021, 5, 31, 22), utc(2021, 11, 30, 23), utc(2021, 3, 28, 1, 30), None,
    ]
    local = [date(2021, 6, 1), date(2021, 12, 1), date(2021, 3, 28), None]
    for name in ("d", "ts", "tn"):
        assert [r[name] for r in dates] == local


def test_generated_column(spark):
    df = spark.sql("SELECT 1 id, DATE'2021-06-01' made, 'n7' name")
    key = norm.add_generated_column(df, GeneratedColumn("k", "year(made) * 100 + month(made)", "int"))
    assert key.first()["k"] == 202106
    over = norm.add_generated_column(df, GeneratedColumn("name", "substring(name, 2)", "int"))
    assert over.columns == df.columns and over.first()["name"] == 7
    texts = spark.sql("SELECT explode(array('12.7', ' +7 ', '-3.', '.5', '-.5', 'x', '', '99999999999', NULL)) t")
    whole = norm.add_generated_column(texts, GeneratedColumn("k", "t", "int"))
    assert [r["k"] for r in whole.collect()] == [12, 7, -3, 0, 0, None, None, None, None]
    bad = norm.add_generated_column(df, GeneratedColumn("k", "name", "int"))
    assert bad.first()["k"] is None


def test_ingested_at_appears_once_and_first(spark):
    df = spark.sql("SELECT 1 id, TIMESTAMP'2000-01-01' `_PLATFORM_ingested_at`")
    out = norm.add_ingested_at(df)
    assert out.columns == ["_platform_ingested_at", "id"]
    assert out.first()[0].year > 2000


def test_normalize_order(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2021-06-01 01:00:00' `made at`, 5 `x.y`")
    out = norm.normalize(df, KIEV, ["made at"], GeneratedColumn("z", "`x.y` + 1", "int"))
    assert out.columns == ["_platform_ingested_at", "made__at", "x__y", "z"]
    assert out.first()[1:] == (date(2021, 6, 1), 5, 6)
    assert norm.normalize(df, KIEV, stamp=False).columns == ["made__at", "x__y"]


def test_string_frame(spark):
    out = norm.string_frame(spark.sql("SELECT 1 a, true b, CAST(NULL AS INT) c, 1.50 d"))
    assert {f.dataType.simpleString() for f in out.schema} == {"string"}
    assert tuple(out.first()) == ("1", "true", None, "1.50")


def test_normalisation_is_one_projection(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = norm.normalize(df, KIEV, ["ts"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Project") == 1 and "Exchange" not in plan


def test_text_without_digits_before_the_point(spark):
    texts = [".5", "-.5", "+.9", "7.", "-12.9", "3", ".", "", "-", "1.2.3", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = norm.add_generated_column(df, norm.GeneratedColumn("n", "t", "int")).collect()
    assert [r["n"] for r in rows] == [0, 0, 0, 7, -12, 3, None, None, None, None, None]
