"""Sources, sinks and table maintenance on the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialspark.plans.registry import Tables, plan
from trialspark.session import checkpoint_dir
from trialspark.sources import tables as io


def _work_folder(t: Tables, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for a written table."""
    return f"{checkpoint_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


@plan("IO1 IO7 PF1 PF2", """
SELECT l_orderkey AS order_id, l_partkey AS part_id, l_quantity AS quantity, 'lineitem' AS source_table
FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' AND l_quantity > 45""")
def scan_with_pushed_filter(t: Tables) -> DataFrame:
    rows = t.lineitem.filter((F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp")) & (F.col("l_quantity") > 45))
    return rows.select("l_orderkey", "l_partkey", "l_quantity").withColumnsRenamed(
        {"l_orderkey": "order_id", "l_partkey": "part_id", "l_quantity": "quantity"}
    ).withColumn("source_table", F.lit("lineitem"))


@plan("IO2 IO23", """
SELECT c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY c_mktsegment""")
def csv_export_and_scan(t: Tables) -> DataFrame:
    path = _work_folder(t, "customer-csv")
    io.export_csv(t.customer, path)
    back = io.read_table(t.spark, path, t.customer.schema)
    return back.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))


@plan("IO3", """
SELECT n_regionkey AS region, count(*) AS n, max(n_name) AS last_name FROM nation GROUP BY n_regionkey""")
def tab_delimited_scan(t: Tables) -> DataFrame:
    path = _work_folder(t, "nation-tab")
    raw = t.nation.select(F.col("n_regionkey").alias("region_mean"), F.col("n_name").alias("name_mean"))
    raw.write.option("header", True).option("sep", "\t").csv(path)
    back = io.read_tab_delimited(t.spark, path, "region_mean int, name_mean string", drop_suffix="_mean")
    return back.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.max("name").alias("last_name"))


@plan("IO4 IO5", """
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
WHERE o_orderpriority = '2-HIGH' AND o_totalprice >= 100000 GROUP BY o_orderstatus""")
def parameterised_template(t: Tables) -> DataFrame:
    io.register_view(t.spark, f"{t.folder}/orders.parquet", "orders_view")
    return io.run_template(
        t.spark,
        """SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders_view
           WHERE o_orderpriority = :priority AND o_totalprice >= :floor GROUP BY o_orderstatus""",
        {"priority": "2-HIGH", "floor": 100000.0},
    )


@plan("IO6 IO11 E16", """
SELECT event_type, count(*) AS n, round(sum(coalesce(value, 0)), 4) AS total FROM events GROUP BY event_type""")
def folder_of_files(t: Tables) -> DataFrame:
    path = _work_folder(t, "events")
    kinds = F.col("event_type").isin("click", "view")
    io.write_parquet(t.events.filter(kinds), f"{path}/first")
    io.write_parquet(t.events.filter(~kinds | F.col("event_type").isNull()).drop("props"), f"{path}/second")
    rows = io.read_folder(t.spark, path).fillna(0.0, subset=["value"])
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@plan("IO8 M22", """
SELECT l_suppkey, count(*) AS n FROM lineitem
WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000) GROUP BY l_suppkey""")
def key_list_lookup(t: Tables) -> DataFrame:
    keys = t.supplier.filter("s_acctbal > 5000").select(F.col("s_suppkey").alias("l_suppkey"))
    return io.only_keys(t.lineitem, keys, "l_suppkey").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


@plan("IO12 IO14", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n,
       round(sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END), 2) AS total
FROM orders GROUP BY ALL""")
def partition_replacement(t: Tables) -> DataFrame:
    path = _work_folder(t, "orders")
    io.write_parquet(t.orders, path, ["o_orderstatus"])
    changed = t.orders.filter("o_orderstatus = 'P'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    io.replace_partitions(changed, path, ["o_orderstatus"])
    return t.spark.read.parquet(path).groupBy("o_orderstatus", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@plan("IO13 J15", """
SELECT n_nationkey, n_name, n_regionkey FROM nation
WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region WHERE r_regionkey < 2)
UNION ALL SELECT n_nationkey, 'NEW ' || n_name, n_regionkey FROM nation WHERE n_regionkey < 2 AND n_nationkey > 3""")
def replace_by_group(t: Tables) -> DataFrame:
    new = t.nation.filter("n_regionkey < 2 AND n_nationkey > 3").withColumn("n_name", F.concat(F.lit("NEW "), "n_name"))
    return io.replace_groups(t.nation, new, ["n_regionkey"])


@plan("IO14", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE NOT (o_orderstatus = 'F' AND year(o_orderdate) = 1996)
UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice + 1 FROM orders
WHERE o_orderstatus = 'F' AND year(o_orderdate) = 1996 AND o_orderpriority = '1-URGENT'""")
def delete_and_insert_slice(t: Tables) -> DataFrame:
    inside = (F.col("o_orderstatus") == "F") & (F.year("o_orderdate") == 1996)
    new = t.orders.filter(inside & (F.col("o_orderpriority") == "1-URGENT")).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return io.replace_slice(t.orders, new, inside).select("o_orderkey", "o_orderstatus", "o_totalprice")


@plan("IO15", """
SELECT coalesce(n.s_suppkey, s.s_suppkey) AS s_suppkey, coalesce(n.s_acctbal, s.s_acctbal) AS s_acctbal
FROM supplier s FULL JOIN (SELECT s_suppkey + 20 AS s_suppkey, s_acctbal * 10 AS s_acctbal FROM supplier) n
ON s.s_suppkey = n.s_suppkey""")
def keyed_upsert(t: Tables) -> DataFrame:
    old = t.supplier.select("s_suppkey", "s_acctbal")
    new = old.select((F.col("s_suppkey") + 20).alias("s_suppkey"), (F.col("s_acctbal") * 10).alias("s_acctbal"))
    return io.upsert(old, new, ["s_suppkey"])


@plan("IO15", """
WITH a AS (SELECT o_orderkey % 5000 AS k, o_totalprice AS price, o_orderkey AS id FROM orders),
b AS (SELECT k + 2500 AS k, price * 2 AS price, id FROM a),
all_ AS (SELECT *, 0 AS step FROM (SELECT k, price, id FROM a QUALIFY row_number() OVER (PARTITION BY k ORDER BY id) = 1)
  UNION ALL SELECT *, 1 FROM (SELECT k, price, id FROM b QUALIFY row_number() OVER (PARTITION BY k ORDER BY id DESC) = 1)
  UNION ALL SELECT *, 2 FROM (SELECT k, -price, id FROM a WHERE id % 2 = 0 QUALIFY row_number() OVER (PARTITION BY k ORDER BY id DESC) = 1))
SELECT k, price, id FROM all_ QUALIFY row_number() OVER (PARTITION BY k ORDER BY step DESC) = 1""")
def upserts_over_own_table(t: Tables) -> DataFrame:
    path = _work_folder(t, "upserted")
    rows = t.orders.select((F.col("o_orderkey") % 5000).alias("k"), F.col("o_totalprice").alias("price"), F.col("o_orderkey").alias("id"))
    io.publish(rows.transform(lambda df: io.upsert(df.limit(0), df, ["k"], ["id"])), path)
    io.upsert_table(rows.select((F.col("k") + 2500).alias("k"), (F.col("price") * 2).alias("price"), "id"), path, ["k"], [F.col("id").desc()])
    io.upsert_table(rows.filter("id % 2 = 0").withColumn("price", -F.col("price")), path, ["k"], [F.col("id").desc()])
    return t.spark.read.parquet(path)


@plan("IO13", """
SELECT l_suppkey, l_orderkey, l_linenumber, CASE WHEN l_suppkey % 3 = 0 THEN 2 * l_quantity WHEN l_suppkey % 2 = 0 THEN -l_quantity ELSE l_quantity END AS quantity
FROM lineitem WHERE l_suppkey % 3 <> 0 AND l_suppkey % 2 <> 0 OR l_suppkey % 3 <> 0 AND l_linenumber = 1 OR l_suppkey % 3 = 0 AND l_linenumber < 3""")
def groups_replaced_in_own_table(t: Tables) -> DataFrame:
    path = _work_folder(t, "replaced")
    rows = t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"))
    io.publish(rows, path)
    io.replace_groups_in_table(rows.filter("l_suppkey % 2 = 0 AND l_linenumber = 1").withColumn("quantity", -F.col("quantity")), path, ["l_suppkey"])
    io.replace_groups_in_table(rows.filter("l_suppkey % 3 = 0 AND l_linenumber < 3").withColumn("quantity", 2 * F.col("quantity")), path, ["l_suppkey"])
    return t.spark.read.parquet(path)


@plan("IO17 S5", """
WITH log AS (SELECT user_id, event_type, CAST(day(ts) AS INTEGER) AS run, event_id FROM events)
SELECT user_id, event_type, run, event_id FROM log
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY CAST(run AS BIGINT) * 1000000000 + event_id) = 1""")
def result_log_keep_first(t: Tables) -> DataFrame:
    log = t.events.select("user_id", "event_type", F.day("ts").alias("run"), "event_id")
    order = log.withColumn("_run", F.col("run") * F.lit(1_000_000_000).cast("bigint") + F.col("event_id"))
    return io.append_log(
        order.filter("run <= 15"), order.filter("run > 15"), ["user_id", "event_type"], "_run", "first"
    ).drop("_run")


@plan("IO18", "SELECT n_nationkey, n_name FROM nation")
def empty_result_union(t: Tables) -> DataFrame:
    empty = io.empty_table(t.spark, "n_nationkey int, n_name string")
    return empty.unionByName(t.nation.select("n_nationkey", "n_name"))


@plan("IO19 IO22", """
WITH src AS (
  SELECT o_custkey, max(run) AS source_run FROM (
    SELECT o_custkey, max(strftime(o_orderdate, '%Y%m%d')) AS run FROM orders GROUP BY 1
    UNION ALL SELECT o_custkey, max(strftime(l_shipdate, '%Y%m%d')) FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
  GROUP BY 1),
done AS (SELECT o_custkey, max(strftime(o_orderdate, '%Y%m%d')) AS output_run FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT s.o_custkey, s.source_run, d.output_run FROM src s LEFT JOIN done d USING (o_custkey)
WHERE d.output_run IS NULL OR s.source_run > d.output_run""")
def changed_group_detection(t: Tables) -> DataFrame:
    orders = t.orders.withColumn("run", F.date_format("o_orderdate", "yyyyMMdd"))
    shipped = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_custkey", F.date_format("l_shipdate", "yyyyMMdd").alias("run")
    )
    return io.changed_groups(
        [(orders, "run"), (shipped, "run")], orders.filter("o_orderstatus = 'F'"), "run", ["o_custkey"]
    )


@plan("IO22", """
SELECT event_type, count(*) AS n_changed FROM events
WHERE value > 10 AND ts > TIMESTAMP '2024-01-20' GROUP BY event_type""")
def new_data_count(t: Tables) -> DataFrame:
    return io.count_changes(t.events, F.col("value") > 10, "ts", F.lit("2024-01-20").cast("timestamp"), ["event_type"])


@plan("IO20 W1", """
SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def latest_run_row(t: Tables) -> DataFrame:
    return io.latest_run(t.events, ["user_id", "event_type"], "ts", ["event_id"]).select(
        "user_id", "event_type", "event_id", "value"
    )


@plan("IO21", "SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = 2001")
def newest_run_folder(t: Tables) -> DataFrame:
    path = _work_folder(t, "runs")
    for year in (2000, 2001):
        rows = t.orders.filter(F.year("o_orderdate") == year).select("o_orderkey", "o_totalprice")
        io.write_run(rows, path, f"{year}0101")
    return io.newest_run(t.spark.read.parquet(path)).drop("run_id")


@plan("IO9", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def lower_case_columns(t: Tables) -> DataFrame:
    return io.lower_columns(t.nation.withColumnsRenamed({c: c.upper() for c in t.nation.columns}))
