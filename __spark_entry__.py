"""

Every query reads all rows of its tables. Queries that write do so below the
shared folder named in ``spark.checkpoint.dir``, or else the warehouse, in a
new folder per call.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.names import target_table_name
from tablesync.operators import normalize as norm
from tablesync.operators import predicates as pred
from tablesync.operators.layout import zorder
from tablesync.operators.merge import append_rows, replace_where, upsert
from tablesync.plans.load import run
from tablesync.sinks import catalog, files, table
from tablesync.sinks.loadlog import DONE, load_log
from tablesync.sinks.sweep import expired_files, sweep
from tablesync.sources import frames
from tablesync.sources.jdbc import schema_override
from tablesync.spec import LoadSpec

try:
    import corpus_pipeline
    from tablesync.llm import queries as llm
except ImportError:  # both are optional
    llm = None

KIEV = "Europe/Kiev"
INGESTED = "2024-02-01 00:00:00"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _scratch(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/tablesync-queries/{uuid.uuid4().hex}"


# --- scans and filters ---------------------------------------------------------


def scan_window(spark, sf):
    orders = _t(spark, sf, "orders")
    where = pred.conjunction(_window_1996(orders), pred.user_predicate("o_orderstatus = 'F'"))
    return frames.filtered(orders, where)


def scan_exec_date(spark, sf):
    events = _t(spark, sf, "events")
    return frames.filtered(
        events, pred.time_window(events, "ts", *pred.day_window(date(2024, 1, 15)))
    )


def scan_custom_query(spark, sf):
    query = (
        "SELECT c_custkey, c_acctbal, n_name FROM {customer} c JOIN {nation} n "
        "ON c.c_nationkey = n.n_nationkey"
    )
    tables = {n: _t(spark, sf, n) for n in ("customer", "nation")}
    rows = frames.query_scan(spark, query, **tables)
    return frames.filtered(rows, pred.user_predicate("c_acctbal > 0"))


def scan_redistributed(spark, sf):
    return frames.redistribute(_t(spark, sf, "customer"), 16)


def scan_schema_override(spark, sf):
    """Dates that arrive as text, read as DATE because the catalog says so."""
    orders = _t(spark, sf, "orders")
    arrived = orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))
    listed = [
        F.struct(
            F.lit(i).alias("ordinal"),
            F.lit(c).alias("column_name"),
            F.lit(" Date " if c == "o_orderdate" else "varchar").alias("data_type"),
        )
        for i, c in enumerate(orders.columns)
    ]
    metadata = spark.range(1).select(F.inline(F.array(*listed)))
    ddl = schema_override(metadata, "ordinal").first()["ddl"]
    return frames.apply_schema_override(arrived, dict(p.split(" ") for p in ddl.split(", ")))


def string_frame(spark, sf):
    return norm.string_frame(_t(spark, sf, "orders"))


# --- projections ---------------------------------------------------------------


def rename_columns(spark, sf):
    dirty = ["order key", "cust.key", "status:code", "total(price)", "order\tdate", "order.prio (5)"]
    return norm.rename_columns(_t(spark, sf, "orders").toDF(*dirty))


def date_to_utc(spark, sf):
    days = _t(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    return norm.times_to_utc(days, KIEV)


def timestamp_to_utc(spark, sf):
    return norm.times_to_utc(_t(spark, sf, "events"), KIEV)


def generated_column(spark, sf):
    day = norm.GeneratedColumn("day_key", "date_format(ts, 'yyyyMMdd')", "int")
    return norm.add_generated_column(_t(spark, sf, "events"), day)


def generated_overwrite(spark, sf):
    """An existing name is overwritten; text that is no number becomes null."""
    prio = norm.GeneratedColumn("o_orderpriority", "substring(o_orderpriority, 1, 2)", "int")
    return norm.add_generated_column(_t(spark, sf, "orders"), prio)


def partition_date(spark, sf):
    return norm.partition_dates(norm.times_to_utc(_t(spark, sf, "events"), KIEV), ["ts"], KIEV)


def ingested_at(spark, sf):
    return norm.add_ingested_at(_t(spark, sf, "part"), F.lit(INGESTED).cast("timestamp_ntz"))


def nested_passthrough(spark, sf):
    """Arrays pass the normalisation untouched: every component, by position."""
    vectors = norm.normalize(_t(spark, sf, "embeddings"), KIEV, stamp=False)
    parts = vectors.select("vec_id", "label", F.posexplode_outer("embedding").alias("pos", "value"))
    return parts.withColumn("value", F.col("value").cast("double"))


# --- predicates, overwrite and merge as formulas --------------------------------


def partition_values(spark, sf):
    docs = _t(spark, sf, "documents").withColumn("lang", F.nullif("lang", F.lit("en")))
    return pred.partition_values(docs, "lang")


def partition_scoped(spark, sf):
    """Documents in the languages of the labelled ones."""
    docs = _t(spark, sf, "documents")
    labelled = docs.join(_t(spark, sf, "labels").where("toxic = 1"), "doc_id", "left_semi")
    return pred.partition_scope(labelled, "source").inside(docs)


def _window_1996(orders: DataFrame):
    return pred.time_window(orders, "o_orderdate", date(1996, 1, 1), date(1997, 1, 1))


def _restated(orders: DataFrame) -> DataFrame:
    closed = orders.where(_window_1996(orders) & (F.col("o_orderstatus") == "F"))
    return closed.withColumn("o_totalprice", F.col("o_totalprice") + 1)


def replace_window(spark, sf):
    orders = _t(spark, sf, "orders")
    incoming = _restated(orders)
    scope = pred.partition_scope(incoming, "o_orderstatus")
    return replace_where(orders, incoming, _window_1996(orders), scope)


def replace_window_written(spark, sf):
    orders, path = _t(spark, sf, "orders"), f"{_scratch(spark)}/orders"
    table.write(spark, orders, path, "overwrite", ["o_orderstatus"])
    table.overwrite_where(spark, _restated(orders), path, ["o_orderstatus"], _window_1996(orders))
    return table.read_table(spark, path)


def replace_nested_partitions(spark, sf):
    """Two partition columns; a restated priority moves rows to other directories."""
    orders, path = _t(spark, sf, "orders"), f"{_scratch(spark)}/orders"
    layout = ["o_orderpriority", "o_orderstatus"]
    table.write(spark, orders, path, "overwrite", layout)
    urgent = orders.where("o_orderstatus = 'F'").withColumn("o_orderpriority", F.lit("1-URGENT"))
    table.overwrite_where(spark, urgent, path, layout)
    return table.read_table(spark, path)


def _history(orders: DataFrame) -> DataFrame:
    return orders.where("o_orderdate < timestamp_ntz'1999-01-01'")


def _increment(orders: DataFrame) -> DataFrame:
    """Orders since 1998: urgent ones become 'F', open 'P' ones are held back."""
    return (
        orders.where("o_orderdate >= timestamp_ntz'1998-01-01'")
        .where("o_orderstatus <> 'P' or o_orderpriority = '1-URGENT'")
        .withColumn(
            "o_orderstatus",
            F.when(F.col("o_orderpriority") == "1-URGENT", "F").otherwise(F.col("o_orderstatus")),
        )
        .withColumn("o_totalprice", F.col("o_totalprice") + 1000)
    )


def upsert_keys(spark, sf):
    orders = _t(spark, sf, "orders")
    return upsert(_history(orders), _increment(orders), ["o_orderkey"])


def upsert_scoped(spark, sf):
    orders = _t(spark, sf, "orders")
    incoming = _increment(orders)
    scope = pred.partition_scope(incoming, "o_orderstatus")
    return upsert(_history(orders), incoming, ["o_orderkey"], scope)


def upsert_to_null(spark, sf):
    """Labels against all documents: matched labels turn null, the others are inserted."""
    labels = _t(spark, sf, "labels").withColumn("text", F.lit(None).cast("string"))
    fresh = _t(spark, sf, "documents").select(
        "doc_id", (F.col("n_chars") > 1000).cast("int").alias("quality"),
        F.lit(None).cast("int").alias("toxic"), "text",
    )
    return upsert(labels, fresh, ["doc_id"])


def upsert_composite(spark, sf):
    """Each turn replaces the next one of its conversation; the last turns are new."""
    talks = _t(spark, sf, "conversations")
    shifted = talks.withColumn("turn", F.col("turn") + 1).withColumn("text", F.upper("role"))
    return upsert(talks, shifted, ["conv_id", "turn"])


def upsert_many_targets(spark, sf):
    """Every line of an order takes the order's status; orders without lines are inserted."""
    lines = _t(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus")
    )
    orders = _t(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return upsert(lines, orders, ["o_orderkey"])


def upsert_written(spark, sf):
    """``upsert_scoped`` through a table partitioned by status."""
    orders, path = _t(spark, sf, "orders"), f"{_scratch(spark)}/orders"
    table.write(spark, _history(orders), path, "append", ["o_orderstatus"])
    table.upsert_table(spark, _increment(orders), path, ["o_orderkey"], ["o_orderstatus"])
    return table.read_table(spark, path)


def upsert_unpartitioned(spark, sf):
    orders, path = _t(spark, sf, "orders"), f"{_scratch(spark)}/orders"
    table.write(spark, _history(orders), path)
    table.upsert_table(spark, _increment(orders), path, ["o_orderkey"])
    return table.read_table(spark, path)


def upsert_first_load(spark, sf):
    path = f"{_scratch(spark)}/orders"
    table.upsert_table(spark, _increment(_t(spark, sf, "orders")), path, ["o_orderkey"])
    return table.read_table(spark, path)


# --- sinks ---------------------------------------------------------------------


def full_overwrite(spark, sf):
    path = f"{_scratch(spark)}/part"
    part = _t(spark, sf, "part")
    table.write(spark, part, path)
    table.write(spark, part.withColumn("p_retailprice", F.col("p_retailprice") * 2), path, "overwrite")
    return table.read_table(spark, path)


def append_evolve(spark, sf):
    part = _t(spark, sf, "part")
    return append_rows(part.drop("p_brand", "p_size"), part.drop("p_name"))


def append_evolve_written(spark, sf):
    part, path = _t(spark, sf, "part"), f"{_scratch(spark)}/part"
    table.write(spark, part.drop("p_brand", "p_size"), path, "append")
    table.write(spark, part.drop("p_name"), path, "append")
    return table.read_table(spark, path)


def append_evolve_nested(spark, sf):
    """Struct fields that arrive later: in a struct, in elements of an array and in values of a map."""
    lines, path = _t(spark, sf, "lineitem"), f"{_scratch(spark)}/lineitem"
    first = lines.selectExpr(
        "l_orderkey", "l_linenumber", "named_struct('quantity', l_quantity, 'tax', l_tax) AS amount",
        "array(named_struct('day', l_shipdate)) AS events", "map('flag', named_struct('code', l_returnflag)) AS marks",
    )
    later = lines.selectExpr(
        "l_orderkey", "l_linenumber",
        "named_struct('discount', l_discount, 'quantity', l_quantity, 'parties', named_struct('part', l_partkey)) AS amount",
        "array(named_struct('day', l_shipdate), named_struct('day', CAST(NULL AS timestamp))) AS held",
        "array(named_struct('by', l_suppkey, 'day', l_shipdate)) AS events",
        "map('flag', named_struct('status', l_linestatus)) AS marks",
    )
    table.write(spark, first, path, "append")
    table.write(spark, later, path, "append")
    return table.read_table(spark, path).selectExpr(
        "l_orderkey", "l_linenumber", "amount.quantity", "amount.tax", "amount.discount", "amount.parties.part",
        "events[0].day AS event_day", "events[0].by AS event_by", "CAST(size(held) AS int) AS n_held",
        "marks['flag'].code AS mark_code", "marks['flag'].status AS mark_status",
    )


def partitioned_roundtrip(spark, sf):
    path = f"{_scratch(spark)}/documents"
    table.write(spark, _t(spark, sf, "documents"), path, "errorifexists", ["lang", "source"])
    return table.read_table(spark, path)


def zorder_rows(spark, sf):
    return zorder(_t(spark, sf, "lineitem"), ["l_partkey", "l_shipdate"])


def zorder_layout(spark, sf):
    """Clustered in place, partition by partition."""
    path = f"{_scratch(spark)}/lineitem"
    table.write(spark, _t(spark, sf, "lineitem"), path, "append", ["l_returnflag"])
    table.cluster_table(spark, path, ["l_partkey", "l_suppkey"], ["l_returnflag"])
    return table.read_table(spark, path)


def register_table(spark, sf):
    scratch = _scratch(spark)
    database = f"tablesync_{scratch[-12:]}"
    path = f"{scratch}/customer"
    table.write(spark, _t(spark, sf, "customer"), path, "append", ["c_mktsegment"])
    catalog.create_database(spark, database, f"{scratch}/db")
    catalog.register_table(spark, database, "customer", path, ["c_mktsegment"])
    catalog.drop_table(spark, database, "customer")
    catalog.register_table(spark, database, "customer", path, ["c_mktsegment"])
    return spark.table(f"{database}.customer")


def load_log_rows(spark, sf):
    """One finished record per load, with its tag and row count."""
    events, path = _t(spark, sf, "events"), f"{_scratch(spark)}/events"
    table.write(spark, events.where("event_type = 'click'"), path, "append", tag="clicks")
    table.write(spark, events.where("event_type <> 'click'"), path, "append", tag="others")
    done = load_log(spark, path).where(F.col("status") == DONE)
    return done.select("load_tag", "mode", "n_rows")


def _with_unfinished_load(spark, sf) -> str:
    """A table of orders whose second load stopped after landing its rows."""
    orders, path = _t(spark, sf, "orders"), f"{_scratch(spark)}/orders"
    table.write(spark, orders, path, "append", ["o_orderstatus"])
    table.land(spark, orders, f"{files.staging_root(spark, path)}/{files.new_load_id()}/incoming")
    return path


def orphan_files(spark, sf):
    """Contents of the files that a sweep would remove: what the unfinished load had landed."""
    path = _with_unfinished_load(spark, sf)
    expired = expired_files(spark, path, 0).select(F.regexp_replace("path", "^file:/+", "/").alias("file"))
    rows = spark.read.schema(_t(spark, sf, "orders").schema).option("recursiveFileLookup", "true")
    rows = rows.parquet(files.staging_root(spark, path))
    at = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/").alias("file")
    return rows.select("*", at).join(expired, "file", "left_semi").drop("file")


def sweep_keeps_table(spark, sf):
    path = _with_unfinished_load(spark, sf)
    sweep(spark, path, 0)
    left = files.listing(spark, files.staging_root(spark, path)).count()
    return table.read_table(spark, path).withColumn("files_left", F.lit(left).cast("long"))


# --- failures ------------------------------------------------------------------


@contextmanager
def _failing(name: str):
    """A step of the sink that is never reached, after all that comes before it."""
    real = getattr(table, name)

    def fail(*_args, **_named):
        raise RuntimeError("lost")

    setattr(table, name, fail)
    try:
        yield
    except RuntimeError:
        pass
    finally:
        setattr(table, name, real)


def upsert_after_failure(spark, sf):
    """The load is repeated after it failed with its content written, but not switched to."""
    orders, path = _t(spark, sf, "orders"), f"{_scratch(spark)}/orders"
    target, source = _history(orders), _increment(orders)
    table.write(spark, target, path, "append")
    with _failing("_commit"):
        table.upsert_table(spark, source, path, ["o_orderkey"])
    table.upsert_table(spark, source, path, ["o_orderkey"])
    return table.read_table(spark, path)


def upsert_same_load_id(spark, sf):
    """Two loads of one id, the second of which fails and is repeated."""
    orders, path = _t(spark, sf, "orders"), f"{_scratch(spark)}/orders"
    table.write(spark, _history(orders), path, "append", ["o_orderstatus"])
    first = _history(orders).withColumn("o_totalprice", F.lit(0.0))
    table.upsert_table(spark, first, path, ["o_orderkey"], ["o_orderstatus"], load_id="nightly")
    with _failing("_commit"):
        table.upsert_table(spark, _history(orders), path, ["o_orderkey"], ["o_orderstatus"], load_id="nightly")
    table.upsert_table(spark, _history(orders), path, ["o_orderkey"], ["o_orderstatus"], load_id="nightly")
    table.upsert_table(spark, _increment(orders), path, ["o_orderkey"], ["o_orderstatus"], load_id="nightly")
    return table.read_table(spark, path)


def replace_after_failure(spark, sf):
    orders, path = _t(spark, sf, "orders"), f"{_scratch(spark)}/orders"
    table.write(spark, orders, path, "append", ["o_orderstatus"])
    new = orders.where(_window_1996(orders) & (F.col("o_orderstatus") == "F"))
    new = new.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    with _failing("_commit"):
        table.write(spark, new, path, "overwrite", ["o_orderstatus"], where=_window_1996(orders))
    table.write(spark, new, path, "overwrite", ["o_orderstatus"], where=_window_1996(orders))
    return table.read_table(spark, path)


def append_after_failure(spark, sf):
    """An append is cut off with its files moved in, read past, and repeated; so is one of the same id that ended."""
    events, path = _t(spark, sf, "events"), f"{_scratch(spark)}/events"
    clicks = F.col("event_type") == "click"
    table.write(spark, events.where(clicks), path, "append", ["event_type"])
    with _failing("_commit"):
        table.write(spark, events.where(~clicks), path, "append", ["event_type"], load_id="others")
    if table.read_table(spark, path).where(~clicks).isEmpty():
        table.write(spark, events.where(~clicks), path, "append", ["event_type"], load_id="others")
        table.write(spark, events.where(~clicks), path, "append", ["event_type"], load_id="others")
    return table.read_table(spark, path)


def first_load_repeated(spark, sf):
    """A first load that failed leaves no table, so ``ignore`` loads when it is repeated."""
    customer, path = _t(spark, sf, "customer"), f"{_scratch(spark)}/customer"
    bad = customer.withColumn("c_name", F.raise_error(F.lit("lost")).cast("string"))
    try:
        table.write(spark, bad, path, "ignore")
    except Exception as error:
        if "lost" not in str(error):
            raise
    table.write(spark, customer, path, "ignore")
    return table.read_table(spark, path)


# --- whole loads ---------------------------------------------------------------


def full_load(spark, sf):
    """History, a restated window that is clustered, then a merge; read through the catalog."""
    orders = _t(spark, sf, "orders").withColumnRenamed("o_orderpriority", "order (priority)")
    scratch = _scratch(spark)
    database = f"tablesync_{scratch[-12:]}"
    common = {
        "path_to_save": scratch,
        "schema": "Sales",
        "tab": "Orders",
        "write_partitioned": "true",
        "partition_col": "[order_year]",
        "generate_column": "true",
        "generated_column_name": "order_year",
        "generated_column_exp": "year(o_orderdate)",
        "generated_column_type": "int",
        "force_partition": "true",
        "hive_db": database,
        "hive_db_location": f"{scratch}/db",
        "ingested_at": F.lit(INGESTED).cast("timestamp_ntz"),
    }
    window = {"dtflt": "o_orderdate", "mode": "overwrite"}
    history = window | {"calc_min_dt": "1995-01-01", "calc_max_dt": "1999-01-01"}
    restated = window | {
        "calc_min_dt": "1998-01-01",
        "calc_max_dt": "2002-01-01",
        "zorderby_col": "o_custkey,o_orderkey",
    }
    run(spark, LoadSpec.from_params(common | history), orders)
    raised = orders.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    run(spark, LoadSpec.from_params(common | restated), raised)
    merge = {"use_merge": "true", "merge_keys": "o_orderkey", "where": "o_orderstatus = 'P'"}
    closed = orders.withColumn("o_totalprice", F.lit(0.0))
    run(spark, LoadSpec.from_params(common | merge), closed)
    return spark.table(f"{database}.{target_table_name('Sales', 'Orders')}")


def entry(spark: SparkSession) -> DataFrame:
    return full_load(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator; each takes (spark, sf_dir)."""
    return {
        "scan_window": scan_window,
        "scan_exec_date": scan_exec_date,
        "scan_custom_query": scan_custom_query,
        "scan_redistributed": scan_redistributed,
        "scan_schema_override": scan_schema_override,
        "string_frame": string_frame,
        "rename_columns": rename_columns,
        "date_to_utc": date_to_utc,
        "timestamp_to_utc": timestamp_to_utc,
        "generated_column": generated_column,
        "generated_overwrite": generated_overwrite,
        "partition_date": partition_date,
        "ingested_at": ingested_at,
        "nested_passthrough": nested_passthrough,
        "partition_values": partition_values,
        "partition_scoped": partition_scoped,
        "replace_window": replace_window,
        "replace_window_written": replace_window_written,
        "replace_nested_partitions": replace_nested_partitions,
        "upsert": upsert_keys,
        "upsert_scoped": upsert_scoped,
        "upsert_to_null": upsert_to_null,
        "upsert_composite": upsert_composite,
        "upsert_many_targets": upsert_many_targets,
        "upsert_written": upsert_written,
        "upsert_unpartitioned": upsert_unpartitioned,
        "upsert_first_load": upsert_first_load,
        "full_overwrite": full_overwrite,
        "append_evolve": append_evolve,
        "append_evolve_written": append_evolve_written,
        "append_evolve_nested": append_evolve_nested,
        "partitioned_roundtrip": partitioned_roundtrip,
        "zorder_rows": zorder_rows,
        "zorder_layout": zorder_layout,
        "register_table": register_table,
        "load_log": load_log_rows,
        "orphan_files": orphan_files,
        "sweep_keeps_table": sweep_keeps_table,
        "upsert_after_failure": upsert_after_failure,
        "upsert_same_load_id": upsert_same_load_id,
        "replace_after_failure": replace_after_failure,
        "append_after_failure": append_after_failure,
        "first_load_repeated": first_load_repeated,
        "full_load": full_load,
    } | (llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {})


_UTC = "({} AT TIME ZONE 'Europe/Kiev') AT TIME ZONE 'UTC'"
_IS_1996 = "o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'"

_REPLACED = f"""
    WITH n AS (
        SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders
        WHERE {_IS_1996} AND o_orderstatus = 'F')
    SELECT * FROM orders
    WHERE ({_IS_1996} AND o_orderstatus IN (SELECT o_orderstatus FROM n)) IS NOT TRUE
    UNION ALL SELECT * FROM n
"""

_HISTORY_AND_INCREMENT = """
    WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
    s AS (
        SELECT * REPLACE (
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
               o_totalprice + 1000 AS o_totalprice)
        FROM orders
        WHERE o_orderdate >= TIMESTAMP '1998-01-01'
          AND (o_orderstatus <> 'P' OR o_orderpriority = '1-URGENT'))
"""


def _upsert_sql(scoped: bool) -> str:
    scope = "AND t.o_orderstatus IN (SELECT o_orderstatus FROM s)" if scoped else ""
    return f"""{_HISTORY_AND_INCREMENT}, m AS (
            SELECT t.o_orderkey FROM t JOIN s ON s.o_orderkey = t.o_orderkey {scope})
        SELECT * FROM s
        UNION ALL
        SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM m)
    """


_EVOLVED = "SELECT * EXCLUDE (p_brand, p_size) FROM part UNION ALL BY NAME SELECT * EXCLUDE (p_name) FROM part"


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query."""
    return {
        "scan_window": f"SELECT * FROM orders WHERE {_IS_1996} AND o_orderstatus = 'F'",
        "scan_exec_date": "SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'",
        "scan_custom_query": """
            SELECT c_custkey, c_acctbal, n_name FROM customer
            JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0""",
        "scan_redistributed": "SELECT * FROM customer",
        "scan_schema_override":
            "SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders",
        "string_frame": "SELECT CAST(COLUMNS(*) AS VARCHAR) FROM orders",
        "rename_columns": """
            SELECT o_orderkey AS order__key, o_custkey AS cust__key, o_orderstatus AS status__code,
                   o_totalprice AS totalprice, o_orderdate AS order__date,
                   o_orderpriority AS order__prio__5 FROM orders""",
        "date_to_utc": f"""
            SELECT * REPLACE ({_UTC.format('CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)')}
                              AS o_orderdate) FROM orders""",
        "timestamp_to_utc": f"SELECT * REPLACE ({_UTC.format('ts')} AS ts) FROM events",
        "generated_column":
            "SELECT *, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS day_key FROM events",
        "generated_overwrite": """
            SELECT * REPLACE (TRY_CAST(replace(substring(o_orderpriority, 1, 2), '-', 'x') AS INTEGER)
                              AS o_orderpriority) FROM orders""",
        "partition_date": "SELECT * REPLACE (CAST(ts AS DATE) AS ts) FROM events",
        "ingested_at": f"SELECT TIMESTAMP '{INGESTED}' AS _platform_ingested_at, * FROM part",
        "nested_passthrough": """
            SELECT vec_id, label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
                   CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings
            UNION ALL
            SELECT vec_id, label, NULL, NULL FROM embeddings WHERE coalesce(len(embedding), 0) = 0""",
        "partition_values": "SELECT DISTINCT lang FROM documents WHERE lang <> 'en'",
        "partition_scoped": """
            SELECT * FROM documents WHERE source IN (
                SELECT source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1)""",
        "replace_window": _REPLACED,
        "replace_window_written": _REPLACED,
        "replace_nested_partitions": """
            SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN '1-URGENT' ELSE o_orderpriority END
                              AS o_orderpriority) FROM orders""",
        "upsert": _upsert_sql(False),
        "upsert_scoped": _upsert_sql(True),
        "upsert_to_null": """
            SELECT doc_id, CAST(n_chars > 1000 AS INTEGER) AS quality, CAST(NULL AS INTEGER) AS toxic, text
            FROM documents
            UNION ALL SELECT *, NULL FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""",
        "upsert_composite": """
            WITH s AS (SELECT conv_id, turn + 1 AS turn, role, upper(role) AS text FROM conversations)
            SELECT * FROM s
            UNION ALL
            SELECT * FROM conversations t WHERE NOT EXISTS (
                SELECT 1 FROM s WHERE s.conv_id = t.conv_id AND s.turn = t.turn)""",
        "upsert_many_targets": """
            SELECT l_orderkey AS o_orderkey, coalesce(o_orderstatus, l_linestatus) AS o_orderstatus
            FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
            UNION ALL
            SELECT o_orderkey, o_orderstatus FROM orders
            WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
        "upsert_written": _upsert_sql(True),
        "upsert_unpartitioned": _upsert_sql(False),
        "upsert_first_load": f"{_HISTORY_AND_INCREMENT} SELECT * FROM s",
        "full_overwrite": "SELECT * REPLACE (p_retailprice * 2 AS p_retailprice) FROM part",
        "append_evolve": _EVOLVED,
        "append_evolve_written": _EVOLVED,
        "append_evolve_nested": """
            SELECT l_orderkey, l_linenumber, l_quantity AS quantity, l_tax AS tax, NULL::DOUBLE AS discount,
                   NULL::BIGINT AS part, l_shipdate AS event_day, NULL::BIGINT AS event_by, NULL::INTEGER AS n_held,
                   l_returnflag AS mark_code, NULL::VARCHAR AS mark_status FROM lineitem
            UNION ALL
            SELECT l_orderkey, l_linenumber, l_quantity, NULL, l_discount, l_partkey, l_shipdate, l_suppkey, 2,
                   NULL, l_linestatus FROM lineitem""",
        "partitioned_roundtrip": "SELECT * FROM documents",
        "zorder_rows": "SELECT * FROM lineitem",
        "zorder_layout": "SELECT * FROM lineitem",
        "register_table": "SELECT * FROM customer",
        "load_log": """
            SELECT CASE WHEN event_type = 'click' THEN 'clicks' ELSE 'others' END AS load_tag,
                   'append' AS mode, count(*) AS n_rows FROM events GROUP BY 1""",
        "orphan_files": "SELECT * FROM orders",
        "upsert_after_failure": _upsert_sql(False),
        "upsert_same_load_id": _upsert_sql(True),
        "replace_after_failure": _REPLACED,
        "append_after_failure": "SELECT * FROM events",
        "first_load_repeated": "SELECT * FROM customer",
        "sweep_keeps_table": "SELECT *, CAST(0 AS BIGINT) AS files_left FROM orders",
        "full_load": f"""
            SELECT TIMESTAMP '{INGESTED}' AS _platform_ingested_at, o_orderkey, o_custkey, o_orderstatus,
                   CASE WHEN o_orderstatus = 'P' THEN 0.0
                        WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_totalprice + 1
                        ELSE o_totalprice END::DOUBLE AS o_totalprice,
                   {_UTC.format('o_orderdate')} AS o_orderdate,
                   o_orderpriority AS order__priority,
                   CAST(year(o_orderdate) AS INTEGER) AS order_year
            FROM orders""",
    } | (llm.oracle_sql() if llm else {})
