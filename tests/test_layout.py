from decimal import Decimal

import brute
import pytest
from pyspark.sql import functions as F

from tablesync.operators.layout import ZVALUE, bits_for, with_zvalue, zorder


def files_with(spark, path, condition):
    return spark.read.parquet(path).where(condition).select("_metadata.file_path").distinct().count()


def grid(spark):
    """64 x 64 points in row-major order, 4 rows each."""
    return spark.range(4 * 64 * 64).select(
        (F.col("id") % 64).alias("x"), (F.floor(F.col("id") / 64) % 64).alias("y"), "id"
    )


def test_point_lookups_touch_few_files(spark, folder):
    df = grid(spark)
    zorder(df, ["x", "y"], files=64).write.parquet(f"{folder}/z")
    df.repartition(64).write.parquet(f"{folder}/plain")
    assert brute.bag(spark.read.parquet(f"{folder}/z")) == brute.bag(df)
    for condition in ("x = 17", "y = 17"):
        assert files_with(spark, f"{folder}/plain", condition) > 50
        assert files_with(spark, f"{folder}/z", condition) <= 20


def test_partitioned_layout(spark, folder):
    df = grid(spark).withColumn("p", F.col("id") % 3)
    out = zorder(df, ["x", "y"], ["p"], files=12)
    out.write.partitionBy("p").parquet(f"{folder}/z")
    assert brute.bag(spark.read.parquet(f"{folder}/z").select(df.columns)) == brute.bag(df)


def test_hot_value_spreads_over_tasks(spark):
    df = spark.range(0, 60_000, 1, 16).select(F.lit(7).alias("x"), F.lit("same").alias("y"))
    sizes = zorder(df, ["x", "y"], files=8).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 60_000
    assert max(r["count"] for r in sizes) < 20_000


def test_ranks_follow_the_order_of_every_type(spark):
    df = spark.range(1000).select(
        F.col("id").cast("int").alias("i"),
        (F.col("id") / 7).alias("d"),
        (F.col("id") / 7).cast("decimal(20,6)").alias("dec"),
        F.date_add(F.lit("1960-01-01"), F.col("id").cast("int")).alias("day"),
        F.timestamp_seconds(F.col("id") * 1000 - 500_000).alias("ts"),
        F.timestamp_seconds(F.col("id") * 1000).cast("timestamp_ntz").alias("ntz"),
        F.format_string("Customer#%09d", "id").alias("s"),
        (F.col("id") >= 500).alias("b"),
    )
    for name in df.columns:
        rows = with_zvalue(df, [name], bits=4).select("i", ZVALUE).orderBy("i").collect()
        values = [r[ZVALUE] for r in rows]
        assert values == sorted(values), name
        assert len(set(values)) == (2 if name == "b" else 16), name


def test_nulls_rank_lowest_and_all_null_columns_work(spark):
    df = spark.createDataFrame([(None, None), (1, None), (2, None)], "a int, n string")
    rows = dict(with_zvalue(df, ["a"]).select("a", ZVALUE).collect())
    assert rows[None] == 0 and rows[1] > 0
    assert zorder(df, ["a", "n"]).count() == 3
    assert zorder(df.where("a > 5"), ["a", "n"]).count() == 0


def test_unsupported_type(spark):
    with pytest.raises(ValueError, match="cannot cluster"):
        zorder(spark.sql("SELECT array(1) a"), ["a"])


def test_bounds_from_another_frame_keep_the_rows(spark):
    df = grid(spark)
    assert brute.bag(zorder(df, ["x"], like=df.where("x < 3").select("x"))) == brute.bag(df)


def test_decimals(spark):
    df = spark.createDataFrame([(Decimal("1.5"),), (Decimal("-1.5"),)], "d decimal(10,2)")
    low, high = with_zvalue(df, ["d"]).orderBy("d").collect()
    assert low[ZVALUE] < high[ZVALUE]


def test_urls_keep_their_ranks_beside_an_outlier(spark):
    urls = spark.range(2000).select(F.format_string("https://example.org/page/%06d", "id").alias("url"))
    df = urls.union(spark.sql("SELECT '-'")).union(spark.sql("SELECT CAST(NULL AS STRING)"))
    rows = with_zvalue(df, ["url"]).orderBy("url").select("url", ZVALUE).collect()
    values = [r[ZVALUE] for r in rows]
    assert values == sorted(values) and len(set(values)) >= 50


def test_frequent_texts_get_a_bucket_of_their_own(spark):
    df = spark.range(3000).select(F.expr("IF(id % 3 = 0, 'm', concat('m', id))").alias("s"))
    ranks = dict(with_zvalue(df, ["s"], bits=4).groupBy("s").agg(F.min(ZVALUE)).collect())
    assert len(set(ranks.values())) >= 8


def test_lookups_by_one_column_open_few_of_many_files(spark, folder):
    df = spark.range(20_000).select(F.hash("id").alias("x"), F.format_string("https://a.b/%08d", "id").alias("url"))
    for name, value in (("x", "hash(7777L)"), ("url", "'https://a.b/00007777'")):
        zorder(df, [name], files=512).write.parquet(f"{folder}/{name}")
        # Statistics of the files decide which ones a lookup has to open.
        ends = spark.read.parquet(f"{folder}/{name}").groupBy("_metadata.file_path").agg(F.min(name).alias("low"), F.max(name).alias("high"))
        assert ends.count() > 256
        assert ends.where(f"{value} BETWEEN low AND high").count() <= 4


def test_more_files_get_more_buckets():
    assert bits_for(800_000, 1) == 6
    assert 2 ** (2 * bits_for(800_000, 2)) > 800_000
    assert bits_for(8, 2) == 6
