"""Loads that fail half-way, are read past, and are repeated."""

from __future__ import annotations

import brute
import pytest
from pyspark.sql import functions as F

from tablesync.operators.predicates import partition_scope
from tablesync.sinks import files, table
from tablesync.sinks.loadlog import History
from tablesync.sinks.sweep import sweep

NAMES = "id int, p string, v string, w int"
LAYOUTS = [[], ["v", "p"]]
OLD = [(i, "ab"[i % 2], "xy"[i // 50], i) for i in range(100)]
NEW = [(i, "ab"[i % 2], "y", -i) for i in range(95, 105)]


def frame(spark, rows):
    return spark.createDataFrame(rows, NAMES)


def rows_of(spark, path):
    return sorted(tuple(r) for r in table.read_table(spark, path).select("id", "p", "v", "w").collect())


def expected_of(mode, parts):
    if mode == "merge":
        dicts = lambda rows: [dict(zip(["id", "p", "v", "w"], r)) for r in rows]
        return sorted(brute.upsert(dicts(OLD), dicts(NEW), "id", parts[-1] if parts else None))
    return sorted({"append": OLD + NEW, "overwrite": NEW, "cluster": OLD}[mode])


def load(spark, path, mode, parts, load_id=None):
    if mode == "merge":
        table.upsert_table(spark, frame(spark, NEW), path, ["id"], parts, load_id=load_id)
    elif mode == "cluster":
        table.cluster_table(spark, path, ["id", "w"], parts, load_id=load_id)
    else:
        table.write(spark, frame(spark, NEW), path, mode, parts, load_id=load_id)


@pytest.fixture
def failing(monkeypatch):
    """Makes a step of the sink fail; the call it returns mends it."""

    def fail(name, after=0):
        real, calls = getattr(table, name), []

        def lost(*args, **named):
            calls.append(name)
            if len(calls) > after:
                raise RuntimeError("driver lost")
            return real(*args, **named)

        monkeypatch.setattr(table, name, lost)
        return lambda: monkeypatch.setattr(table, name, real)

    return fail


@pytest.mark.parametrize("parts", LAYOUTS)
@pytest.mark.parametrize("mode", ["merge", "overwrite", "cluster", "append"])
def test_failed_loads_change_nothing_and_can_be_repeated(spark, folder, failing, parts, mode):
    """Under an id that has been used by a load that ended."""
    load_id = "job1"
    path = f"{folder}/t"
    table.write(spark, frame(spark, OLD), path, partition_cols=parts, load_id=load_id)
    mend = failing("_commit")
    with pytest.raises(RuntimeError, match="driver lost"):
        load(spark, path, mode, parts, load_id)
    assert rows_of(spark, path) == sorted(OLD)
    sweep(spark, path, 0)
    assert rows_of(spark, path) == sorted(OLD)
    mend()
    load(spark, path, mode, parts, load_id)
    assert rows_of(spark, path) == expected_of(mode, parts)
    sweep(spark, path, 0)
    assert rows_of(spark, path) == expected_of(mode, parts)


@pytest.mark.parametrize("parts", LAYOUTS)
@pytest.mark.parametrize("mode", ["merge", "overwrite", "append"])
def test_a_second_load_of_one_id(spark, folder, failing, parts, mode):
    path = f"{folder}/t"
    table.write(spark, frame(spark, OLD[:1]), path, partition_cols=parts)
    table.upsert_table(spark, frame(spark, OLD), path, ["id"], parts, load_id="job1")
    mend = failing("_commit")
    with pytest.raises(RuntimeError):
        load(spark, path, mode, parts, "job1")
    mend()
    before = rows_of(spark, path)
    assert set(OLD) <= {*before, *OLD[:1]} and len(before) >= 100
    load(spark, path, mode, parts, "job1")
    assert len(rows_of(spark, path)) == {"merge": len(expected_of("merge", parts)), "overwrite": 10, "append": 110}[mode]


@pytest.mark.parametrize("parts", LAYOUTS)
def test_readers_see_old_or_new_rows(spark, folder, monkeypatch, parts):
    """Read between any two steps of loads of every kind; reading changes nothing."""
    path = f"{folder}/t"
    table.write(spark, frame(spark, OLD), path, partition_cols=parts)
    seen = []
    for name in ("_put", "_commit", "_staged_units", "_undo"):
        real = getattr(table, name)

        def watched(*args, real=real, **named):
            seen.append(rows_of(spark, path))
            out = real(*args, **named)
            seen.append(rows_of(spark, path))
            return out

        monkeypatch.setattr(table, name, watched)
    move = files.move

    def slow_move(spark_, source, target):
        move(spark_, source, target)
        if "__loads" not in target:
            seen.append(rows_of(spark, path))

    monkeypatch.setattr(files, "move", slow_move)
    monkeypatch.setattr(table, "_MOVERS", 1)
    for mode in ("append", "merge", "overwrite"):
        before = rows_of(spark, path)
        seen.clear()
        if mode == "merge":
            table.upsert_table(spark, frame(spark, [(500, "a", "x", 1)]), path, ["id"], parts)
        else:
            load(spark, path, mode, parts)
        after = rows_of(spark, path)
        assert len(seen) > 3 and all(s in (before, after) for s in seen)


def test_an_append_cut_off_between_its_files(spark, folder, failing, monkeypatch):
    path = f"{folder}/t"
    table.write(spark, frame(spark, OLD), path, partition_cols=["p"])
    move, moved = files.move, []

    def lost(spark_, source, target):
        if "__loads" not in target:
            if moved:
                raise OSError("lost")
            moved.append(target)
        move(spark_, source, target)

    monkeypatch.setattr(files, "move", lost)
    monkeypatch.setattr(table, "_MOVERS", 1)
    with pytest.raises(OSError, match="lost"):
        load(spark, path, "append", ["p"], "one")
    monkeypatch.setattr(files, "move", move)
    assert len(moved) == 1 and files.exists(spark, moved[0])
    assert rows_of(spark, path) == sorted(OLD)
    # Another load takes the files back before anything else.
    table.upsert_table(spark, frame(spark, [(700, "a", "x", 1)]), path, ["id"], ["p"])
    assert not files.exists(spark, moved[0]) and not History.of(spark, path).unfinished()
    load(spark, path, "append", ["p"], "one")
    assert rows_of(spark, path) == sorted([*OLD, *NEW, (700, "a", "x", 1)])


@pytest.mark.parametrize("parts", LAYOUTS)
def test_an_append_can_be_repeated(spark, folder, parts):
    path = f"{folder}/t"
    table.write(spark, frame(spark, OLD), path, partition_cols=parts)
    for _ in range(3):
        load(spark, path, "append", parts, "nightly")
    assert rows_of(spark, path) == sorted(OLD + NEW)
    table.cluster_table(spark, path, ["id"], parts)
    with pytest.raises(ValueError, match="rewritten since"):
        load(spark, path, "append", parts, "nightly")
    assert rows_of(spark, path) == sorted(OLD + NEW)


@pytest.mark.parametrize("mode", ["append", "ignore", "overwrite"])
@pytest.mark.parametrize("parts", [[], ["p"]])
@pytest.mark.parametrize("step", ["source", "_commit"])
def test_failed_first_load_leaves_no_table(spark, folder, failing, mode, parts, step):
    """Also one that has moved its files into place."""
    path = f"{folder}/t"
    bad = frame(spark, OLD).withColumn("extra", F.lit(1))
    if step == "source":
        bad = bad.withColumn("v", F.raise_error(F.lit("driver lost")).cast("string"))
    mend = failing("_commit")
    with pytest.raises(Exception, match="driver lost"):
        table.write(spark, bad, path, mode, parts)
    mend()
    assert not table.table_exists(spark, path)
    table.write(spark, frame(spark, OLD), path, mode, parts)
    assert rows_of(spark, path) == sorted(OLD)
    assert "extra" not in table.read_table(spark, path).columns


def test_scope_keeps_both_sides_of_an_overlap(spark):
    """Two instants with one wall-clock time in the autumn overlap."""
    micros = spark.createDataFrame([(1730000000000000,), (1730003600000000,), (None,)], "m long")
    rows = micros.select(F.timestamp_micros("m").alias("t"))
    scope = partition_scope(rows, "t")
    assert scope.has_null and scope.inside(rows).count() == 2
