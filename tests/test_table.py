import os
from datetime import date
from types import SimpleNamespace

import brute
import pytest
from pyspark.sql import functions as F

from test_merge import NAMES, SCHEMA, SOURCE, TARGET, dicts
from tablesync.operators.predicates import partition_scope
from tablesync.sinks import files, loadlog, table
from tablesync.sinks.loadlog import DONE, History, load_log
from tablesync.sinks.sweep import expired_files, sweep


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def stored(spark, path):
    return brute.bag(table.read_table(spark, path))


def data_files(path):
    return sorted(
        os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    )


def staged_files(spark, path):
    return files.listing(spark, files.staging_root(spark, path)).count()


@pytest.fixture
def path(folder):
    return f"{folder}/t"


def test_save_modes(spark, path):
    df = frame(spark, TARGET)
    assert table.write(spark, df, path).n_rows == len(TARGET)
    with pytest.raises(FileExistsError):
        table.write(spark, df, path)
    assert table.write(spark, df, path, "ignore").n_rows == 0
    assert stored(spark, path) == brute.bag(df)
    table.write(spark, df, path, "Append")
    assert stored(spark, path) == brute.bag(df.union(df))
    table.write(spark, df.where("id = 1"), path, "OVERWRITE")
    assert stored(spark, path) == brute.bag(df.where("id = 1"))


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_schema_evolution(spark, path, mode):
    table.write(spark, spark.sql("SELECT 1 id, 'x' a"), path)
    table.write(spark, spark.sql("SELECT 2.5D b, 2 id"), path, mode)
    old = [(1, "x", None)] if mode == "append" else []
    assert table.read_table(spark, path).columns == ["id", "a", "b"]
    assert sorted(stored(spark, path)) == [*old, (2, None, 2.5)]
    with pytest.raises(ValueError, match="do not fit"):
        table.write(spark, spark.sql("SELECT 'text' id"), path, mode)


def test_schema_without_a_log(spark, path):
    spark.sql("SELECT 1 id").write.parquet(path)
    spark.sql("SELECT 2 id, 'x' a").write.mode("append").parquet(path)
    assert table.read_table(spark, path).columns == ["id", "a"]


def test_partition_values_keep_type_and_position(spark, path):
    rows = [(1, "007", "x", 1), (2, "it's", "y", 2), (3, "a/b=c", "z", 3), (4, "1e3", "z", 3)]
    table.write(spark, frame(spark, rows), path, partition_cols=["P"])
    assert table.read_table(spark, path).columns == NAMES
    assert sorted(stored(spark, path)) == rows
    table.write(spark, frame(spark, [(9, "007", "n", 1)]), path, "overwrite", ["p"])
    assert sorted(stored(spark, path)) == [*rows[1:], (9, "007", "n", 1)]


def test_overwrite_touches_only_incoming_partitions(spark, path):
    rows = [(i, p, "v", i) for i, p in enumerate("aabbccdd")]
    table.write(spark, frame(spark, rows), path, partition_cols=["p"])
    before = [f for f in data_files(path) if "/p=a/" in f or "/p=d/" in f]
    new = [(10, "b", "n", 2), (11, "c", "n", 4)]
    table.write(spark, frame(spark, new), path, "overwrite", ["p"], where=F.expr("w in (2, 4)"))
    expected = brute.replace(dicts(rows), dicts(new), "p", lambda t: t["w"] in (2, 4))
    assert stored(spark, path) == expected
    assert [f for f in data_files(path) if "/p=a/" in f or "/p=d/" in f] == before
    assert staged_files(spark, path) == 0


@pytest.mark.parametrize("first", [True, False])
@pytest.mark.parametrize("bad", [(9, None, "x", 1), (9, "", "x", 1), (9, "a", "x", 50)])
def test_overwrite_rejects_rows_outside_and_leaves_the_table(spark, path, bad, first):
    good = frame(spark, [(1, "a", "v", 1)])
    if not first:
        table.write(spark, good, path, partition_cols=["p"])
    with pytest.raises(Exception, match="outside the overwrite predicate"):
        new = frame(spark, [(2, "a", "v", 1), bad])
        table.write(spark, new, path, "overwrite", ["p"], where=F.expr("w < 10"))
    if not first:
        assert stored(spark, path) == brute.bag(good)


@pytest.mark.parametrize("mode", ["overwrite", "merge"])
@pytest.mark.parametrize("parts", [["p"], ["v", "p"]])
def test_empty_load_changes_nothing(spark, path, mode, parts):
    table.write(spark, frame(spark, TARGET), path, partition_cols=parts)
    none = frame(spark, [])
    if mode == "merge":
        table.upsert_table(spark, none, path, ["id"], parts)
    else:
        table.write(spark, none, path, "overwrite", parts)
    assert stored(spark, path) == brute.bag(frame(spark, TARGET))


def test_overwrite_with_new_column(spark, path):
    table.write(spark, frame(spark, [(1, "a", "v", 1), (2, "b", "v", 2)]), path, partition_cols=["p"])
    new = frame(spark, [(3, "b", "v", 3)]).withColumn("extra", F.lit("e"))
    table.write(spark, new, path, "overwrite", ["p"])
    assert sorted(stored(spark, path)) == [(1, "a", "v", 1, None), (3, "b", "v", 3, "e")]


def test_nested_partitions_leave_no_emptied_directory(spark, path):
    rows = [(1, "a", "x", 1), (2, "a", "y", 2), (3, "b", "y", 3)]
    table.write(spark, frame(spark, rows), path, partition_cols=["v", "p"])
    table.write(spark, frame(spark, [(4, "a", "x", 4)]), path, "overwrite", ["v", "p"])
    assert sorted(stored(spark, path)) == [(3, "b", "y", 3), (4, "a", "x", 4)]
    assert not [f for f in table.read_table(spark, path).inputFiles() if "/v=y/p=a/" in f]
    sweep(spark, path, 0)
    assert not [f for f in data_files(path) if "/v=y/p=a/" in f]
    assert sorted(stored(spark, path)) == [(3, "b", "y", 3), (4, "a", "x", 4)]
    assert staged_files(spark, path) == 0


@pytest.mark.parametrize("parts", [[], ["p"], ["w", "p"], ["v", "p"]])
@pytest.mark.parametrize("zorder_cols", [(), ("id", "w")])
def test_upsert_table(spark, path, parts, zorder_cols):
    table.write(spark, frame(spark, TARGET), path, partition_cols=parts)
    done = table.upsert_table(spark, frame(spark, SOURCE), path, ["id"], parts, zorder_cols=zorder_cols)
    part = parts[-1] if parts else None
    assert done.n_rows == len(SOURCE)
    assert stored(spark, path) == brute.upsert(dicts(TARGET), dicts(SOURCE), "id", part)
    assert staged_files(spark, path) == 0


def test_upsert_into_the_null_partition_keeps_its_rows(spark, path):
    rows = [(1, None, "old", 1), (2, "", "old", 2), (3, "a", "old", 3)]
    table.write(spark, frame(spark, rows), path, partition_cols=["p"])
    new = [(4, None, "new", 4), (5, "", "new", 5), (3, "a", "new", 30), (1, None, "reload", 9)]
    table.upsert_table(spark, frame(spark, new), path, ["id"], ["p"])
    null_rows = [(1, None, "old", 1), (2, None, "old", 2), (4, None, "new", 4), (5, None, "new", 5),
                 (1, None, "reload", 9)]
    assert set(stored(spark, path)) == {*null_rows, (3, "a", "new", 30)}


@pytest.mark.parametrize("parts", [[], ["p"]])
def test_failed_upsert_leaves_the_table(spark, path, parts):
    table.write(spark, frame(spark, TARGET), path, partition_cols=parts)
    with pytest.raises(Exception, match="more than one source row"):
        twice = frame(spark, [(1, "a", "x", 1), (1, "a", "y", 2)])
        table.upsert_table(spark, twice, path, ["id"], parts)
    assert stored(spark, path) == brute.bag(frame(spark, TARGET))
    # What the failed load landed waits for the sweep.
    assert staged_files(spark, path) > 0
    sweep(spark, path, 1)
    assert staged_files(spark, path) > 0
    assert expired_files(spark, path, 0).count() >= staged_files(spark, path)
    sweep(spark, path, 0)
    assert staged_files(spark, path) == 0


def test_sweep_removes_old_writer_leftovers(spark, path):
    table.write(spark, frame(spark, TARGET), path)
    leftover = f"{path}/.spark-staging-123"
    os.makedirs(leftover)
    assert sweep(spark, path) == []
    os.utime(leftover, (0, 0))
    assert len(sweep(spark, path)) == 1 and not os.path.exists(leftover)
    assert stored(spark, path) == brute.bag(frame(spark, TARGET))


@pytest.mark.parametrize("parts", [[], ["p"], ["v", "p"]])
def test_cluster_table(spark, path, parts):
    table.write(spark, frame(spark, TARGET), path, partition_cols=parts)
    table.cluster_table(spark, path, ["id", "w"], parts)
    assert stored(spark, path) == brute.bag(frame(spark, TARGET))


def test_overwrite_clusters_in_the_same_write(spark, path):
    days = [date(2024, 1, d) for d in (1, 2)]
    df = spark.range(2000).select(
        "id", (F.col("id") * 7919 % 2000).alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit(days[0])).otherwise(F.lit(days[1])).alias("d"),
    )
    table.write(spark, df, path, "overwrite", ["d"])
    done = table.write(spark, df, path, "overwrite", ["d"], zorder_cols=["k", "id"])
    assert done.clustered and stored(spark, path) == brute.bag(df)


def test_load_log(spark, path):
    table.write(spark, frame(spark, TARGET), path, tag="v1")
    table.write(spark, frame(spark, SOURCE), path, "append", tag="v2")
    table.upsert_table(spark, frame(spark, SOURCE[:1]), path, ["w"], tag="v3")
    done = load_log(spark, path).where(F.col("status") == DONE)
    rows = done.orderBy("logged_at").select("load_tag", "mode", "n_rows").collect()
    assert [tuple(r) for r in rows] == [
        ("v1", "errorifexists", len(TARGET)), ("v2", "append", len(SOURCE)), ("v3", "merge", 1),
    ]


@pytest.mark.parametrize("n_values", [3, 12_000])
def test_only_touched_folders_are_listed(spark, path, n_values):
    """However many values a load brings."""
    table.write(spark, spark.range(0, 400, 1, 4).select("id", F.col("id").alias("p")), path, partition_cols=["p"])
    values = spark.range(5, 5 + n_values * 200, 200).select(F.col("id").alias("p"))
    rows = table.read_table(spark, path, scope=partition_scope(values, "p"))
    assert sorted(r["id"] for r in rows.collect()) == [5, 205]
    assert len(rows.inputFiles()) == 2 and "InMemoryFileIndex(2 paths)" in rows._jdf.queryExecution().toString()


def test_partitioned_write_makes_few_files(spark, path):
    df = spark.range(0, 8000, 1, 8).withColumn("p", F.col("id") % 4)
    table.write(spark, df, path, partition_cols=["p"])
    assert len(data_files(path)) <= 8


def test_empty_folders_and_empty_tables(spark, path):
    os.makedirs(path)
    assert not table.table_exists(spark, path)
    table.write(spark, frame(spark, []), path, partition_cols=["p"])
    assert table.table_exists(spark, path)
    assert table.read_table(spark, path).isEmpty()
    table.upsert_table(spark, frame(spark, SOURCE), path, ["id"], ["p"])
    assert stored(spark, path) == brute.bag(frame(spark, SOURCE))


def test_failing_full_overwrite_leaves_the_table(spark, path):
    table.write(spark, frame(spark, TARGET), path)
    broken = frame(spark, SOURCE).withColumn("w", F.raise_error("source gone").cast("int"))
    with pytest.raises(Exception, match="source gone"):
        table.write(spark, broken, path, "overwrite")
    assert stored(spark, path) == brute.bag(frame(spark, TARGET))
    done = table.write(spark, frame(spark, SOURCE), path, "overwrite", zorder_cols=["id"])
    assert done.clustered and stored(spark, path) == brute.bag(frame(spark, SOURCE))


def test_missing_merge_key(spark, path):
    table.write(spark, frame(spark, TARGET), path)
    with pytest.raises(ValueError, match="no column"):
        table.upsert_table(spark, frame(spark, SOURCE), path, ["nope"])


@pytest.mark.parametrize("mode", ["append", "overwrite", "merge"])
def test_layout_must_stay_the_same(spark, path, mode):
    df = frame(spark, [(1, "a", "x", 1)])
    table.write(spark, df, path, partition_cols=["p"])
    with pytest.raises(ValueError, match="partitioned by"):
        if mode == "merge":
            table.upsert_table(spark, df, path, ["id"])
        else:
            table.write(spark, df, path, mode, ["v"])
    with pytest.raises(ValueError, match="partitioned by"):
        table.cluster_table(spark, path, ["id"])
    assert stored(spark, path) == brute.bag(df)


def test_staging_root():
    def session(**settings):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: settings.get("dir", default)))

    shared = files.staging_root(session(dir="hdfs://shared/"), "s3a://lake/t/")
    assert shared.startswith("hdfs://shared/tablesync/t-")
    assert shared != files.staging_root(session(dir="hdfs://shared/"), "s3a://other/t")
    assert files.staging_root(session(), "s3a://lake/t/") == "s3a://lake/t__staging"


def test_hot_partition_is_split_over_files(spark, path):
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "20KB")
    try:
        df = spark.range(0, 30_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 10).alias("p"),
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
        )
        assert table.write(spark, df, path, partition_cols=["p"]).n_rows == 30_000
    finally:
        spark.conf.set(setting, before)
    assert len([f for f in data_files(path) if "/p=0/" in f]) > 1
    assert stored(spark, path) == brute.bag(df)


def test_odd_names_of_emptied_folders(spark, path):
    """Rows that leave a folder for another of the same last value, whose name is no plain word."""
    names = ["a,b", "c{d}", "e*f?", "g[h]", "i\\j", "k:l"]
    old = spark.createDataFrame([(i, "x", n) for i, n in enumerate(names)], "id int, q string, r string")
    table.write(spark, old, path, partition_cols=["q", "r"])
    new = old.withColumn("q", F.lit("y")).where("id <> 0")
    table.write(spark, new, path, "overwrite", ["q", "r"])
    kept = {(r["id"], r["q"], r["r"]) for r in table.read_table(spark, path).collect()}
    assert kept == {(0, "x", "a,b")} | {(i, "y", n) for i, n in enumerate(names) if i}
    assert len(table.live_units(loadlog.History.of(spark, path))) == len(names)


def test_log_is_compacted_and_keeps_its_records(spark, path, monkeypatch):
    monkeypatch.setattr(loadlog, "MAX_FILES", 3)
    for i in range(4):
        table.write(spark, frame(spark, SOURCE), path, "append", tag=f"v{i}")
    listed = files.names(spark, loadlog.log_path(path))
    assert len(listed) <= 4
    assert stored(spark, path) == brute.bag(frame(spark, SOURCE * 4))
    done = load_log(spark, path).where(F.col("status") == DONE)
    assert sorted(r["load_tag"] for r in done.collect()) == ["v0", "v1", "v2", "v3"]
    assert load_log(spark, path).groupBy("seq").count().where("count > 1").isEmpty()


def test_superseded_folders_stay_for_the_retention(spark, path):
    """A reader that has begun goes on reading what has been replaced since."""
    table.write(spark, frame(spark, TARGET), path, partition_cols=["p"])
    before = table.read_table(spark, path)
    table.write(spark, frame(spark, [(50, "a", "n", 1)]), path, "overwrite", ["p"])
    table.upsert_table(spark, frame(spark, [(51, "a", "n", 1)]), path, ["id"], ["p"])
    sweep(spark, path)
    assert brute.bag(before) == brute.bag(frame(spark, TARGET))
    now = stored(spark, path)
    removed = sweep(spark, path, 0)
    assert len(removed) == 2 and stored(spark, path) == now
    assert sweep(spark, path, 0) == []


def test_appends_follow_their_partitions(spark, path):
    """Into the folder that an overwrite has switched to, and anew where a partition was emptied."""
    rows = [(1, "a", "x", 1), (2, "a", "y", 2), (3, "b", "y", 3)]
    table.write(spark, frame(spark, rows), path, partition_cols=["v", "p"])
    table.write(spark, frame(spark, [(4, "a", "x", 4)]), path, "overwrite", ["v", "p"])
    more = [(5, "a", "x", 5), (6, "a", "y", 6), (7, "b", "y", 7), (8, "c", "z", 8)]
    table.write(spark, frame(spark, more), path, "append", ["v", "p"])
    expected = [(3, "b", "y", 3), (4, "a", "x", 4), *more]
    assert sorted(stored(spark, path)) == sorted(expected)
    sweep(spark, path, 0)
    assert sorted(stored(spark, path)) == sorted(expected)


def test_unpartitioned_versions(spark, path):
    table.write(spark, frame(spark, TARGET), path)
    for n in (1, 2):
        table.write(spark, frame(spark, [(n, "a", "n", 1)]), path, "overwrite")
    table.write(spark, frame(spark, [(9, "b", "n", 1)]), path, "append")
    sweep(spark, path, 0)
    assert sorted(stored(spark, path)) == [(2, "a", "n", 1), (9, "b", "n", 1)]
    assert len({os.path.dirname(f) for f in data_files(path)}) == 1


def test_a_table_without_a_log_can_be_loaded(spark, path):
    """Written by something else, with partitions."""
    frame(spark, TARGET).where("p IS NOT NULL").write.partitionBy("p").parquet(path)
    own = [r for r in TARGET if r[1] is not None]
    new = [(90, "a", "n", 1)]
    table.write(spark, frame(spark, new).select("id", "v", "w", "p"), path, "overwrite", ["p"])
    expected = brute.replace(dicts(own), dicts(new), "p", lambda t: True)
    assert brute.bag(table.read_table(spark, path).select(NAMES)) == expected


def test_folder_names(spark, path):
    odd = ["a b", "x=y", "50%", 'q"', "{z}", "[n]", "tab\t", "ü", "^", "a\\b", "__HIVE_DEFAULT_PARTITION__x"]
    rows = [(i, v, "v", i) for i, v in enumerate(odd)]
    table.write(spark, frame(spark, rows), path, partition_cols=["p"])
    names = {d for d in os.listdir(path) if d.startswith("p=")}
    assert names == {files.folder_name("p", v) for v in odd}
    assert {files.folder_value(n)[1] for n in names} == set(odd)
    assert files.folder_value(files.folder_name("p", None)) == ("p", None)
    for scoped in odd:
        scope = partition_scope(frame(spark, [(0, scoped, "v", 0)]), "p")
        assert table.read_table(spark, path, scope=scope).count() == 1


def test_repeated_append_into_an_emptied_partition(spark, path):
    rows = [(1, "a", "x", 1), (2, "a", "y", 2)]
    table.write(spark, frame(spark, rows), path, partition_cols=["v", "p"])
    table.write(spark, frame(spark, rows[:1]), path, "overwrite", ["v", "p"])
    for _ in range(2):
        table.write(spark, frame(spark, rows[1:]), path, "append", ["v", "p"], load_id="again")
        assert sorted(stored(spark, path)) == rows
    sweep(spark, path, 0)
    assert sorted(stored(spark, path)) == rows


def sizes(path, part):
    return sorted(
        os.path.getsize(os.path.join(at, f))
        for at, _, found in os.walk(path) if f"{part}" in at.split("/") for f in found if f.endswith(".parquet")
    )


@pytest.mark.parametrize("how", ["cluster", "overwrite", "upsert"])
def test_clustered_files_are_planned_by_bytes(spark, path, how):
    """One large partition among many small ones: files of about the size asked for, few for the small ones."""
    spread = F.sha2(F.col("id").cast("string"), 512)
    rows = spark.range(0, 60_000, 1, 8).select(
        "id", spread.alias("v"), F.when(F.col("id") < 55_000, 0).otherwise(F.col("id") % 20 + 1).alias("p")
    )
    table.write(spark, rows, path, partition_cols=["p"])
    target = 1_000_000
    if how == "cluster":
        table.cluster_table(spark, path, ["id"], ["p"], file_bytes=target)
    elif how == "overwrite":
        table.write(spark, rows, path, "overwrite", ["p"], zorder_cols=["id"], file_bytes=target)
    else:
        # The bytes before count for what they are and the incoming rows on top, so the plan may halve a file.
        few = rows.where("id % 1000 = 0 OR id > 59970")
        table.upsert_table(spark, few, path, ["id"], ["p"], zorder_cols=["id"], file_bytes=target)
    assert stored(spark, path) == brute.bag(rows)
    unit = table.live_units(History.of(spark, path), None)["p=0"]
    large = sizes(f"{path}/{unit}", "p=0")
    total = sum(large)
    assert total / (2 * target) <= len(large) <= 2 * total / target + 2
    assert all(size <= 2 * target for size in large)
    # Only the two ends of a partition may be smaller than half of what was asked for.
    assert sum(size < target / 2 for size in large) <= 2
    for p in range(1, 21):
        small = table.live_units(History.of(spark, path), None)[f"p={p}"]
        assert len(sizes(f"{path}/{small}", f"p={p}")) <= 2
