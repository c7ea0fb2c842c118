from datetime import datetime

import brute
import pytest
from pyspark.sql import functions as F

from tablesync import LoadSpec, run
from tablesync.sinks import catalog, files, table

ZONE = "Europe/Kiev"


def source(spark, values):
    """Rows (id, source-local time text, value)."""
    return spark.createDataFrame(values, "id int, t string, v int").select(
        "id", F.col("t").cast("timestamp_ntz").alias("made at"), "v"
    )


DAYS = [
    (1, "2021-06-01 00:30:00", 10),
    (2, "2021-06-01 23:30:00", 20),
    (3, "2021-06-02 00:30:00", 30),
    (4, "2021-06-03 12:00:00", 40),
]


def load(spark, folder, values, **params):
    base = {"path_to_save": folder, "tab": "T", "disable_platform_ingested_at": "true"}
    return run(spark, LoadSpec.from_params(base | params), source(spark, values))


def rows(spark, result):
    return sorted(tuple(r) for r in table.read_table(spark, result.path).collect())


PARTITIONED = {"write_partitioned": "true", "partition_col": "made at"}


def test_daily_overwrite_by_local_day(spark, folder):
    load(spark, folder, DAYS, **PARTITIONED)
    fixed = [(1, "2021-06-01 00:30:00", 11), (5, "2021-06-01 10:00:00", 50), *DAYS[2:]]
    done = load(
        spark, folder, fixed, mode="overwrite", dtflt="made at", exec_date="2021-06-01", **PARTITIONED
    )
    assert done.n_rows == 2
    days = [(r[0], str(r[1]), r[2]) for r in rows(spark, done)]
    assert days == [(1, "2021-06-01", 11), (3, "2021-06-02", 30), (4, "2021-06-03", 40), (5, "2021-06-01", 50)]


def test_window_compares_utc_columns_in_the_source_zone(spark, folder):
    by_value = {"write_partitioned": "true", "partition_col": "v", "force_partition": "true"}
    load(spark, folder, [(i, t, 1) for i, t, _ in DAYS], **by_value)
    window = {"dtflt": "made at", "calc_min_dt": "2021-06-01", "calc_max_dt": "2021-06-02"}
    done = load(spark, folder, [(9, "2021-06-01 00:00:00", 1)], mode="overwrite", **window, **by_value)
    assert rows(spark, done) == [
        (3, datetime(2021, 6, 1, 21, 30), 1),
        (4, datetime(2021, 6, 3, 9), 1),
        (9, datetime(2021, 5, 31, 21), 1),
    ]


def test_unpartitioned_overwrite_needs_consent(spark, folder):
    load(spark, folder, DAYS)
    with pytest.raises(ValueError, match="full_overwrite"):
        load(spark, folder, DAYS, mode="overwrite", where="v > 20")
    done = load(spark, folder, DAYS, mode="overwrite", where="v > 20", full_overwrite="true")
    assert [r[0] for r in rows(spark, done)] == [3, 4]


@pytest.mark.parametrize("mode", ["append", "overwrite", "merge"])
@pytest.mark.parametrize("parts", [{}, PARTITIONED])
def test_clustered_loads(spark, folder, mode, parts):
    extra = {"use_merge": "true", "merge_keys": "id"} if mode == "merge" else {"mode": mode}
    load(spark, folder, DAYS[:2], zorderby_col="id,v", **extra, **parts)
    done = load(spark, folder, DAYS[1:], zorderby_col="id,v", **extra, **parts)
    ids = [r[0] for r in rows(spark, done)]
    if mode == "append":
        assert ids == [1, 2, 2, 3, 4]
    elif mode == "merge":
        assert ids == [1, 2, 3, 4]
    else:
        assert ids == [2, 3, 4]
    assert files.listing(spark, files.staging_root(spark, done.path)).count() == 0


def test_merge(spark, folder):
    merge = {"use_merge": "true", "merge_keys": "['id']"}
    load(spark, folder, DAYS[:3], **merge)
    done = load(spark, folder, [(2, "2021-06-05 00:00:00", 21), DAYS[3]], **merge)
    assert [(r[0], r[2]) for r in rows(spark, done)] == [(1, 10), (2, 21), (3, 30), (4, 40)]


def test_registration_follows_the_table(spark, folder):
    params = {"hive_db": "reg_db", "hive_db_location": f"{folder}/db", "mode": "append", **PARTITIONED}
    load(spark, folder, DAYS[:2], **params)
    done = load(
        spark, folder, DAYS[2:], generate_column="true", generated_column_name="w",
        generated_column_exp="v * 2", generated_column_type="int", **params,
    )
    view = spark.table("reg_db.dbo__t")
    assert brute.bag(view.select("id", "v", "w")) == {
        (1, 10, None): 1, (2, 20, None): 1, (3, 30, 60): 1, (4, 40, 80): 1,
    }
    assert view.where("made__at = DATE'2021-06-02'").count() == 1
    catalog.drop_table(spark, "reg_db", "dbo__t")
    assert not spark.catalog.tableExists("reg_db.dbo__t")
    assert len(rows(spark, done)) == 4
    assert not catalog.register_table(spark, "reg_db", "nothing", f"{folder}/nothing")


def test_registration_names_what_loads_touched(spark, folder, monkeypatch):
    """No repair of all partitions; moved, new and emptied partitions follow, also after a registration that failed."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS follow_db LOCATION '{folder}/db'")
    path, names = f"{folder}/t", "id int, q string, p string"
    frame = lambda rows: spark.createDataFrame(rows, names)
    table.write(spark, frame([(i, "x", f"p{i}") for i in range(20)] + [(50, "x", None)]), path, partition_cols=["q", "p"])
    said = []
    real = type(spark).sql

    def sql(self, query, *args, **named):
        said.append(query)
        return real(self, query, *args, **named)

    monkeypatch.setattr(type(spark), "sql", sql)

    def followed():
        said.clear()
        catalog.register_table(spark, "follow_db", "t", path, ["q", "p"])
        view = brute.bag(spark.table("follow_db.t").select("id", "q", "p"))
        assert view == brute.bag(table.read_table(spark, path))
        assert not any("MSCK" in s for s in said)
        return " ".join(s for s in said if "PARTITION " in s)

    assert "'p7'" in followed()
    assert followed() == ""
    table.write(spark, frame([(100, "x", "p3"), (101, "y", "p4")]), path, "overwrite", ["q", "p"])
    statements = followed()
    assert "'p3'" in statements and "DROP IF EXISTS" in statements and "'p7'" not in statements
    table.write(spark, frame([(102, "x", "p4"), (103, "z", "new")]), path, "append", ["q", "p"])
    table.upsert_table(spark, frame([(50, "x", None), (7, "x", "p7")]), path, ["id"], ["q", "p"])
    statements = followed()
    assert "'new'" in statements and "NULL" in statements and "'p9'" not in statements
    table.write(spark, spark.sql("SELECT 1 id"), f"{folder}/u")
    for n in (2, 3):
        catalog.register_table(spark, "follow_db", "u", f"{folder}/u")
        assert spark.table("follow_db.u").count() == table.read_table(spark, f"{folder}/u").count()
        table.write(spark, spark.range(n).selectExpr("int(id) id"), f"{folder}/u", "overwrite")


def test_change_tracking_is_refused(spark, folder):
    with pytest.raises(NotImplementedError):
        load(spark, folder, DAYS, change_tracking="true", primary_key="id")


def test_ingestion_time_comes_first(spark, folder):
    done = load(spark, folder, DAYS, disable_platform_ingested_at="false")
    assert table.read_table(spark, done.path).columns[0] == "_platform_ingested_at"


def test_session_zone_is_left_alone(spark, folder):
    before = spark.conf.get("spark.sql.session.timeZone")
    load(spark, folder, DAYS, timezone="America/New_York")
    assert spark.conf.get("spark.sql.session.timeZone") == before


def test_nested_columns_survive_a_load(spark, folder):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    spec = LoadSpec(
        path_to_save=folder, tab="V", use_merge=True, merge_keys="vec_id",
        disable_platform_ingested_at=True, zorderby_col="label",
    )
    run(spark, spec, vectors)
    done = run(spark, spec, vectors)
    stored = table.read_table(spark, done.path)
    assert stored.schema.simpleString() == vectors.schema.simpleString()
    assert stored.exceptAll(vectors).isEmpty() and stored.count() == vectors.count()


def test_registration_refuses_another_place_or_layout(spark, folder):
    params = {"hive_db": "odd_db", "hive_db_location": f"{folder}/db", "mode": "append"}
    done = load(spark, folder, DAYS, **params)
    catalog.register_table(spark, "odd_db", "dbo__t", done.path + "/")
    table.write(spark, spark.sql("SELECT 1 id, 2 p"), f"{folder}/other", partition_cols=["p"])
    with pytest.raises(ValueError, match="is registered at"):
        catalog.register_table(spark, "odd_db", "dbo__t", f"{folder}/other", ["p"])
    catalog.register_table(spark, "odd_db", "other", f"{folder}/other", ["p"])
    with pytest.raises(ValueError, match="is registered with partitions"):
        catalog.register_table(spark, "odd_db", "other", f"{folder}/other")


@pytest.mark.parametrize("parts", [(), ("p",)])
def test_registration_follows_struct_fields(spark, folder, parts):
    path = f"{folder}/t"
    catalog.create_database(spark, "grown_db", f"{folder}/grown_db")
    table.write(spark, spark.sql("SELECT 'a' p, named_struct('x', 1) s"), path, "append", parts)
    catalog.register_table(spark, "grown_db", "t", path, parts)
    table.write(spark, spark.sql("SELECT 'b' p, named_struct('y', 2, 'x', 3) s"), path, "append", parts)
    catalog.register_table(spark, "grown_db", "t", path, parts)
    rows = spark.table("grown_db.t").select("p", "s.x", "s.y").orderBy("p").collect()
    assert [tuple(r) for r in rows] == [("a", 1, None), ("b", 3, 2)]
    table.write(spark, spark.sql("SELECT 'c' p, named_struct('x', 4) s"), path, "append", parts)
    catalog.register_table(spark, "grown_db", "t", path, parts)
    assert spark.table("grown_db.t").where("s.x = 4").count() == 1
    catalog.drop_table(spark, "grown_db", "t")
