import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import brute
from tablesync.operators.keyfilter import MAX_BITS, MIN_BITS, KeyFilter, bits_for, key_words
from tablesync.operators.merge import (
    append_rows,
    conform,
    evolved_schema,
    replace_touched,
    replace_where,
    source_keys,
    upsert,
)
from tablesync.operators.predicates import partition_scope
from tablesync.sinks import table

SCHEMA = "id int, p string, v string, w int"
NAMES = ["id", "p", "v", "w"]

TARGET = [
    (1, "a", "one", 1),
    (2, "a", "two", 2),
    (2, "a", "two again", 2),  # repeated target key: both are updated
    (3, "b", "three", 3),
    (4, "c", "four", 4),  # partition that receives nothing
    (None, "a", "no key", 5),
    (6, None, "no partition", 6),
]
SOURCE = [
    (2, "a", None, 20),  # update to null
    (3, "a", "moved", 30),  # key moves from b to a
    (4, "b", "moved", 40),  # old partition c is out of scope
    (None, "a", "no key", 50),
    (6, "a", "no partition", 60),
    (7, "b", "new", 70),
    (8, "b", "new twice", 80),
    (8, "b", "new twice", 81),
]


def dicts(rows):
    return [dict(zip(NAMES, r)) for r in rows]


def frames(spark, target=TARGET, source=SOURCE):
    return spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA)


@pytest.mark.parametrize("part", [None, "p"])
def test_upsert_cases(spark, part):
    target, source = frames(spark)
    scope = None if part is None else partition_scope(source, "p")
    expected = brute.upsert(dicts(TARGET), dicts(SOURCE), "id", part)
    assert brute.bag(upsert(target, source, ["id"], scope)) == expected


@pytest.mark.parametrize("seed", [7, 8])
def test_upsert_random(spark, seed):
    rng = random.Random(seed)

    def rows(n, keys):
        return [
            (rng.choice(keys), rng.choice(["a", "b", "c", None]), str(rng.random()), rng.randint(0, 9))
            for _ in range(n)
        ]

    checked = 0
    for _ in range(6):
        target = rows(30, [None, *range(40)])
        source = [(k, *r[1:]) for k, r in zip([None, None, *rng.sample(range(60), 20)], rows(22, [0]))]
        t, s = frames(spark, target, source)
        for part in (None, "p"):
            expected = brute.upsert(dicts(target), dicts(source), "id", part)
            scope = partition_scope(s, "p") if part else None
            assert brute.bag(upsert(t, s, ["id"], scope)) == expected
            checked += 1
    assert checked == 12


def test_upsert_rejects_two_matches(spark):
    target, source = frames(spark, source=[(1, "a", "x", 1), (1, "a", "y", 2)])
    with pytest.raises(Exception, match="more than one source row"):
        upsert(target, source, ["id"]).collect()


def test_upsert_columns_by_name(spark):
    target, source = frames(spark)
    shuffled = source.select("w", "v", F.lit(1).alias("extra"), F.col("p").alias("P"), "id")
    assert brute.bag(upsert(target, shuffled, ["ID"])) == brute.bag(upsert(target, source, ["id"]))
    with pytest.raises(ValueError, match="lacks"):
        upsert(target, source.drop("w"), ["id"])


def test_upsert_twice_changes_nothing(spark):
    target = spark.createDataFrame(TARGET[:2] + TARGET[3:5], SCHEMA)
    source = spark.createDataFrame(SOURCE[:3] + SOURCE[5:6], SCHEMA)
    scope = partition_scope(source, "p")
    once = upsert(target, source, ["id"], scope)
    # Keys moved from an out-of-scope partition aside, a second run is a no-op.
    assert brute.bag(upsert(once, source, ["id"], scope)) == brute.bag(once)


def test_hot_keys(spark):
    """A third of the target and of the unmatched source rows share one key; nothing is lost."""
    target = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"), F.lit("t").alias("v")
    )
    source = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, -1)
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.col("id"))
        .alias("id"),
        F.lit("s").alias("v"),
    ).union(spark.sql("SELECT 0L, 's'"))
    out = upsert(target, source, ["id"]).groupBy("v").count()
    # Updated: the hot key 0 and each target id of the form 3k + 2.
    assert dict(out.collect()) == {"t": 10_000, "s": 20_000 + 20_000}


def test_replace_where(spark):
    target, source = frames(spark)
    low = source.where("p IS NOT NULL").withColumn("w", F.lit(3))
    rows = [tuple(r) for r in low.collect()]
    scope = partition_scope(low, "p")
    out = replace_where(target, low, F.expr("w <= 3"), scope)
    assert brute.bag(out) == brute.replace(dicts(TARGET), dicts(rows), "p", lambda t: t["w"] <= 3)


def test_replace_keeps_rows_where_the_predicate_is_unknown(spark):
    target = spark.createDataFrame([(1, "a", None, None), (2, "a", None, 1)], SCHEMA)
    source = spark.createDataFrame([(3, "a", None, 1)], SCHEMA)
    out = replace_where(target, source, F.expr("w = 1"), partition_scope(source, "p"))
    assert {r["id"] for r in out.collect()} == {1, 3}


@pytest.mark.parametrize("row", [(9, "a", "x", 99), (9, None, "x", 1), (9, "a", "x", None)])
def test_replace_rejects_rows_outside(spark, row):
    target, source = frames(spark, source=[(8, "a", "x", 1), row])
    with pytest.raises(Exception, match="outside the overwrite predicate"):
        replace_where(target, source, F.expr("w < 10"), partition_scope(source, "p")).collect()


def test_append_rows_evolves(spark):
    v1 = spark.createDataFrame([(1, "x")], "id int, a string")
    v2 = spark.createDataFrame([(2, 2.5, "y")], "ID int, b double, A string")
    out = append_rows(v1, v2)
    assert out.columns == ["id", "a", "b"]
    assert brute.bag(out) == {(1, "x", None): 1, (2, "y", 2.5): 1}


def test_conform_widens_but_never_narrows(spark):
    wide = T.StructType().add("n", "long")
    assert conform(spark.sql("SELECT 1 n"), wide).schema["n"].dataType == T.LongType()
    money = T.StructType().add("n", T.DecimalType(12, 4))
    assert conform(spark.sql("SELECT 1.25 n"), money).first()[0] == Decimal("1.2500")
    with pytest.raises(ValueError, match="do not fit"):
        conform(spark.sql("SELECT 1.12345 n"), money)
    for have in ("'1'", "1.5D", "1L"):
        with pytest.raises(ValueError, match="do not fit"):
            conform(spark.sql(f"SELECT {have} n"), T.StructType().add("n", "integer"))
    assert evolved_schema(wide, T.StructType().add("N", "integer").add("m", "integer")).names == ["n", "m"]


def test_struct_fields_evolve_at_every_level(spark):
    old = spark.sql("""
        SELECT * FROM VALUES
            (1, named_struct('x', 1, 'Y', 'a'), array(named_struct('n', 1), NULL), map('k', named_struct('v', 1))),
            (2, NULL, NULL, NULL) AS t(id, s, a, m)""")
    new = spark.sql("""
        SELECT 3 id, named_struct('y', 'b', 'in', named_struct('deep', 5)) s,
               array(named_struct('o', 9L, 'n', 2)) a, map('k', named_struct('v', 3, 'w', array(4))) m""")
    out = append_rows(old, new)
    assert out.schema.simpleString() == (
        "struct<id:int,s:struct<x:int,Y:string,in:struct<deep:int>>,a:array<struct<n:int,o:bigint>>,"
        "m:map<string,struct<v:int,w:array<int>>>>"
    )
    one, two, three = (r.asDict(recursive=True) for r in out.orderBy("id").collect())
    assert one["s"] == {"x": 1, "Y": "a", "in": None} and one["a"] == [{"n": 1, "o": None}, None]
    assert one["m"] == {"k": {"v": 1, "w": None}}
    assert two["s"] is two["a"] is two["m"] is None
    assert three["s"] == {"x": None, "Y": "b", "in": {"deep": 5}}
    assert three["a"] == [{"n": 2, "o": 9}] and three["m"] == {"k": {"v": 3, "w": [4]}}
    # The other way round the new fields come from the old frame; types never narrow inside, either.
    assert append_rows(new, old).count() == 3
    with pytest.raises(ValueError, match="do not fit"):
        append_rows(old, spark.sql("SELECT 4 id, named_struct('x', 'text') s"))
    with pytest.raises(ValueError, match="clash"):
        evolved_schema(old.schema, T.StructType().add("s", T.StructType().add("q", "integer").add("Q", "integer")))


def test_upsert_needs_all_struct_fields(spark):
    target = spark.sql("SELECT 1 id, named_struct('x', 1, 'y', 2) s")
    with pytest.raises(ValueError, match="s.y"):
        upsert(target, spark.sql("SELECT 1 id, named_struct('x', 5) s"), ["id"])
    more = spark.sql("SELECT 1 id, named_struct('z', 7, 'y', 6, 'x', 5) s")
    assert [tuple(r["s"]) for r in upsert(target, more, ["id"]).collect()] == [(5, 6)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_upsert_plan_has_no_cross_join_and_prunes(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    text = plan(upsert(orders, orders, ["o_orderkey"]))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # The key lookup reads the key column only.
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_hot_keys_are_split_by_aqe(spark):
    """Both joins of an upsert split a hot partition instead of giving it to one task."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        text = F.sha2(F.col("id").cast("string"), 256).alias("v")
        rows = spark.range(0, 20_000, 1, 8)
        target = rows.select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"), text)
        source = rows.select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("id"), text)
        out = upsert(target, source, ["id"])
        assert out.count() == 20_000 + 6_667
        out.collect()
        final = plan(out)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    final = final[: final.index("Initial Plan")]
    assert final.count("SortMergeJoin(skew=true)") == 2


def stored_by_partition(spark, folder, rows=1000):
    df = spark.range(rows).select("id", (F.col("id") % 5).cast("string").alias("p"), F.lit(1).alias("v"))
    df.write.partitionBy("p").parquet(f"{folder}/t")
    return spark.read.schema(df.schema).parquet(f"{folder}/t")


def test_overwriting_one_partition_needs_no_shuffle(spark, folder):
    path = f"{folder}/t"
    df = spark.range(1000).select("id", (F.col("id") % 5).cast("string").alias("p"), F.lit(1).alias("v"))
    table.write(spark, df, path, partition_cols=["p"])
    incoming = df.where("p = '1'")
    touched = table.read_table(spark, path, scope=partition_scope(incoming, "p"))
    assert len(touched.inputFiles()) == 1
    assert "Exchange" not in plan(replace_touched(touched, incoming, F.expr("v = 1"), "p"))


def test_small_upsert_shuffles_keys_of_the_target_only(spark, folder):
    target = stored_by_partition(spark, folder)
    source = target.where("p = '1'").limit(10)
    text = plan(upsert(target, source, ["id"]))
    joined = text[: text.index("HashAggregate")]
    assert "BroadcastHashJoin" in joined and "SortMergeJoin" not in joined
    assert "Exchange hashpartitioning" not in joined


def test_upsert_without_broadcast_shuffles_six_times_at_most(spark, folder):
    target = stored_by_partition(spark, folder)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(upsert(target, target.where("p = '1'"), ["id"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert text.count("Exchange hashpartitioning") <= 6


@pytest.mark.parametrize("part", [None, "p"])
@pytest.mark.parametrize("bits", [1, 6, 20])
def test_upsert_with_a_key_filter(spark, part, bits):
    """The same rows, also where a bitmap is so small that it tells few or none apart."""
    target, source = frames(spark)
    scope = None if part is None else partition_scope(source, "p")
    known = KeyFilter(key_words(source, ["id"], bits), ["id"], bits)
    expected = brute.upsert(dicts(TARGET), dicts(SOURCE), "id", part)
    assert brute.bag(upsert(target, source, ["id"], scope, known)) == expected


def test_key_filter_tells_rows_apart(spark):
    target = spark.range(200_000).select("id", (F.col("id") % 3).alias("k"), F.lit("v").alias("v"))
    source = target.where("id % 1000 = 0").selectExpr("int(id) ID", "int(k) k", "'w' v")
    known = source_keys(target, source, ["id", "k"], 200)  # in the target's types
    likely = known.possible(target)
    assert likely.where("id % 1000 = 0").count() == 200
    assert likely.count() < 20_000
    assert known.impossible(target).count() == 200_000 - likely.count()
    nothing = KeyFilter(key_words(target.where("id < 0"), ["id"], 16), ["id"], 16)
    assert nothing.possible(target).isEmpty() and nothing.impossible(target).count() == 200_000


def test_key_filter_grows_with_the_keys_to_a_bound():
    assert bits_for(0) == bits_for(10) == MIN_BITS
    assert 2 ** bits_for(1_000_000) >= 16 * 1_000_000
    assert bits_for(10**12) == MAX_BITS


def shuffled_rows(spark, df):
    """Rows that the shuffles of a query wrote, from its final plan."""
    df.collect()
    found, nodes = [], [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            nodes.append(node.plan())
        else:
            if name == "Exchange":
                found.append(node.metrics().apply("shuffleRecordsWritten").value())
            children = node.children()
            nodes += [children.apply(i) for i in range(children.size())]
    return sum(found)


def test_only_possible_matches_are_shuffled(spark, folder):
    rows = spark.range(0, 100_000, 1, 4).selectExpr("id", "string(id) v")
    rows.write.parquet(f"{folder}/target")
    rows.where("id % 500 = 0").selectExpr("id", "'new' v").write.parquet(f"{folder}/source")
    target, source = (spark.read.schema(rows.schema).parquet(f"{folder}/{n}") for n in ("target", "source"))
    known = source_keys(target, source, ["id"], 200)
    known.words.write.parquet(f"{folder}/keys")
    known = KeyFilter(spark.read.schema(known.words.schema).parquet(f"{folder}/keys"), known.keys, known.bits)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert shuffled_rows(spark, upsert(target, source, ["id"])) > 200_000
        assert shuffled_rows(spark, upsert(target, source, ["id"], key_filter=known)) < 10_000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
