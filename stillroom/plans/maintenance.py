"""Row maintenance over stored tables."""

from pyspark.sql import Observation
from pyspark.sql import functions as F

from stillroom.operators import changes
from stillroom.operators.catalog import table_counts
from stillroom.operators.tables import append_once, refresh_window, rewrite_partitions, write_table
from stillroom.plans import plan, table
from stillroom.session import scratch_path

WINDOW_START = "2024-01-24"
WINDOW_ACTIONS = [
    {
        "action": "delete",
        "target-table": "events",
        "condition": {"op": "gte", "target-col": "ts", "const": {"type": "datetime", "v": f"{WINDOW_START}T00:00:00Z"}},
    },
    {"action": "insert", "source-table": "window", "target-table": "events"},
]


@plan("SELECT * FROM customer WHERE NOT (c_mktsegment = 'BUILDING')")
def delete_predicate(spark, sf_dir):
    return changes.delete_where(table(spark, sf_dir, "customer"), F.col("c_mktsegment") == "BUILDING")


@plan("SELECT * FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment = 'BUILDING')")
def delete_semi_join(spark, sf_dir):
    doomed = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return changes.delete_matching(table(spark, sf_dir, "orders"), doomed, [["c_custkey", "o_custkey"]])


@plan("SELECT COUNT(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM customer")
def delete_all(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "cleared")
    write_table(changes.delete_all(customers), path, "create")
    counts = table_counts({"before": customers, "after": spark.read.parquet(path)})
    return counts.agg(
        F.sum(F.when(F.col("table_name") == "before", F.col("n")).otherwise(0)).alias("rows_before"),
        F.sum(F.when(F.col("table_name") == "after", F.col("n")).otherwise(0)).alias("rows_after"),
    )


@plan("""
SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 50 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer
""")
def update_expression(spark, sf_dir):
    return changes.update_where(
        table(spark, sf_dir, "customer"), {"c_acctbal": F.col("c_acctbal") + 50}, F.col("c_mktsegment") == "BUILDING"
    )


@plan("""
SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal, CASE WHEN c_acctbal < 0 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment FROM customer
""")
def update_changeset(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    changed = customers.filter(F.col("c_acctbal") < 0).select(
        "c_custkey", F.lit(0.0).alias("c_acctbal"), F.lit("CHANGED").alias("c_mktsegment")
    )
    return changes.apply_change(customers, "update", changed, match_columns=[["c_custkey", "c_custkey"]])


@plan("SELECT * FROM orders WHERE o_orderstatus <> 'F'")
def delete_changeset(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    gone = orders.filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("gone_key"))
    return changes.apply_change(orders, "delete", gone, match_columns=[["gone_key", "o_orderkey"]])


@plan("SELECT * FROM orders WHERE NOT (o_orderdate < TIMESTAMP '1998-02-01 00:00:00')")
def delete_condition(spark, sf_dir):
    condition = {"op": "lt", "target-col": "o_orderdate", "const": {"type": "datetime", "v": "1998-02-01T00:00:00Z"}}
    return changes.apply_change(table(spark, sf_dir, "orders"), "delete", match_condition=condition)


@plan("""
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
UNION ALL SELECT s_suppkey + 100000, s_name, s_nationkey, CAST(NULL AS DOUBLE) FROM supplier
""")
def append_changeset(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier")
    added = suppliers.select("s_nationkey", "s_name", (F.col("s_suppkey") + 100000).alias("s_suppkey"))
    return changes.apply_change(suppliers, "insert", added)


@plan("""
WITH ch AS (SELECT o_orderkey + 500 AS o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders)
SELECT * FROM ch UNION ALL SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM ch WHERE ch.o_orderkey = o.o_orderkey)
""")
def upsert_single_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    changed = orders.withColumn("o_orderkey", F.col("o_orderkey") + 500).withColumn("o_orderstatus", F.lit("U"))
    return changes.upsert(orders, changed, [["o_orderkey", "o_orderkey"]], unique_target=True)


@plan("""
WITH t AS (SELECT user_id, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2),
     c AS (SELECT user_id + 25 AS user_id, event_type, CAST(-1 AS BIGINT) AS n FROM t)
SELECT user_id, event_type, n FROM c
UNION ALL SELECT t.user_id, t.event_type, t.n FROM t WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.user_id = t.user_id AND c.event_type = t.event_type)
""")
def upsert_composite_key(spark, sf_dir):
    counted = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "user-counts")
    write_table(counted, path, "create")
    target = spark.read.parquet(path)
    changed = target.select((F.col("user_id") + 25).alias("user_id"), "event_type", F.lit(-1).cast("bigint").alias("n"))
    return changes.upsert(target, changed, [["user_id", "user_id"], ["event_type", "event_type"]])


@plan("""
SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_custkey >= 700 THEN 'NEW' ELSE c_mktsegment END AS c_mktsegment FROM customer
UNION ALL SELECT c.c_custkey + 700, NULL, NULL, NULL, 'NEW' FROM customer c
WHERE NOT EXISTS (SELECT 1 FROM customer k WHERE k.c_custkey = c.c_custkey + 700)
""")
def upsert_partial_columns(spark, sf_dir):
    """Changes that carry one column: matched rows keep the others, inserted rows get NULL there."""
    customers = table(spark, sf_dir, "customer")
    changed = customers.select((F.col("c_custkey") + 700).alias("key"), F.lit("NEW").alias("c_mktsegment"))
    return changes.upsert(customers, changed, [["key", "c_custkey"]])


@plan("""
SELECT event_id, ts, user_id, event_type, value FROM events WHERE ts < TIMESTAMP '2024-01-24 00:00:00'
UNION ALL SELECT event_id, ts, user_id, event_type, value * 2 FROM events WHERE ts >= TIMESTAMP '2024-01-24 00:00:00'
""")
def action_batch_rolling_window(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    start = F.lit(f"{WINDOW_START} 00:00:00").cast("timestamp_ntz")
    window = events.filter(F.col("ts") >= start).withColumn("value", F.col("value") * 2)
    return changes.apply_actions(events, WINDOW_ACTIONS, {"window": window})


@plan("""
SELECT event_id, user_id, value, CAST(ts AS DATE) AS day FROM events WHERE ts < TIMESTAMP '2024-01-24 00:00:00'
UNION ALL SELECT event_id, user_id, value * 2, CAST(ts AS DATE) FROM events
WHERE ts >= TIMESTAMP '2024-01-24 00:00:00' AND CAST(ts AS DATE) <> DATE '2024-01-26'
""")
def partitioned_window_refresh(spark, sf_dir):
    """The same refresh on a table partitioned by day: only the window's folders change, a day without rows goes."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value", F.to_date("ts").alias("day"))
    path = scratch_path(spark, "events-by-day")
    write_table(events, path, "create", partition_by=["day"])
    fresh = events.filter((F.col("day") >= F.lit(WINDOW_START).cast("date")) & (F.col("day") != F.lit("2024-01-26").cast("date")))
    refresh_window(fresh.withColumn("value", F.col("value") * 2), path, "day", WINDOW_START)
    return spark.read.parquet(path)


@plan("""
SELECT 'update' AS action, COUNT(*) AS n FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT 'delete', COUNT(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'MACHINERY'
UNION ALL SELECT 'insert', COUNT(*) FROM supplier
UNION ALL SELECT 'upsert, updated', COUNT(*) FROM customer WHERE c_custkey IN (SELECT s_suppkey FROM supplier)
UNION ALL SELECT 'upsert, inserted', 1 + COUNT(*) FROM supplier WHERE -s_suppkey NOT IN (SELECT c_custkey FROM customer) AND s_suppkey <> 0
""")
def impacted_counts(spark, sf_dir):
    """Rows hit by each command, counted by the writes themselves."""
    customers, orders, suppliers = (table(spark, sf_dir, name) for name in ("customer", "orders", "supplier"))
    root = scratch_path(spark, "impacted")
    updated, deleted, replaced, added = (Observation() for _ in range(4))
    write_table(changes.update_where(customers, {"c_acctbal": F.lit(0.0)}, F.col("c_mktsegment") == "BUILDING", updated), f"{root}/update")
    gone = customers.filter(F.col("c_mktsegment") == "MACHINERY").select("c_custkey")
    write_table(changes.delete_matching(orders, gone, [["c_custkey", "o_custkey"]], deleted), f"{root}/delete")
    write_table(suppliers.filter("false"), f"{root}/insert")
    inserted = write_table(suppliers, f"{root}/insert", "append")
    keys = suppliers.select(F.col("s_suppkey").alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"))
    others = keys.filter("c_custkey <> 0").withColumn("c_custkey", -F.col("c_custkey"))
    nobody = keys.limit(1).withColumn("c_custkey", F.lit(None).cast("bigint"))
    changed = keys.unionByName(others).unionByName(nobody)
    write_table(changes.upsert(customers, changed, [["c_custkey", "c_custkey"]], updated=replaced, inserted=added), f"{root}/upsert")
    counts = [("update", updated.get["rows"]), ("delete", deleted.get["rows"]), ("insert", inserted)]
    counts += [("upsert, updated", replaced.get["rows"]), ("upsert, inserted", added.get["rows"])]
    return spark.createDataFrame(counts, "action string, n bigint")


@plan("""
SELECT 'delete' AS action, (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'F') AS n, (SELECT COUNT(*) FROM orders WHERE o_orderstatus <> 'F') AS rows_after
UNION ALL SELECT 'update', (SELECT COUNT(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal < 0), (SELECT COUNT(*) FROM orders)
""")
def observed_counts(spark, sf_dir):
    """Rows hit, counted while the new state is written, without a second scan."""
    orders = table(spark, sf_dir, "orders")
    root = scratch_path(spark, "observed")
    deleted, updated = Observation(), Observation()
    write_table(changes.delete_where(orders, F.col("o_orderstatus") == "F", deleted), f"{root}/delete", "create")
    changed = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0).select("c_custkey", F.lit("X").alias("o_orderstatus"))
    write_table(changes.update_from(orders, changed, [["c_custkey", "o_custkey"]], updated), f"{root}/update", "create")
    hits = spark.createDataFrame([("delete", deleted.get["rows"]), ("update", updated.get["rows"])], "action string, n bigint")
    states = table_counts({action: spark.read.parquet(f"{root}/{action}") for action in ("delete", "update")})
    return hits.join(states.select(F.col("table_name").alias("action"), F.col("n").alias("rows_after")), "action")


@plan("SELECT 'r-1' AS request_id, COUNT(*) AS n FROM supplier UNION ALL SELECT 'r-2', COUNT(*) FROM supplier WHERE s_acctbal > 0")
def append_by_request(spark, sf_dir):
    """A request that is sent twice is applied once."""
    suppliers = table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "requests")
    for request, df in (("r-1", suppliers), ("r-2", suppliers.filter(F.col("s_acctbal") > 0)), ("r-1", suppliers)):
        append_once(df, path, request)
    return spark.read.parquet(path).groupBy("request_id").agg(F.count(F.lit(1)).alias("n"))


@plan("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-25 00:00:00'")
def window_extract(spark, sf_dir):
    """The rolling window as it is read from a source; the range reaches the scan."""
    start = F.lit("2001-07-25 00:00:00").cast("timestamp_ntz")
    return table(spark, sf_dir, "orders").filter(F.col("o_orderdate") >= start).select("o_orderkey", "o_custkey", "o_totalprice")


@plan("""
SELECT event_id, user_id, CASE WHEN event_type = 'error' AND CAST(ts AS DATE) IN (DATE '2024-01-05', DATE '2024-01-06') THEN 0.0 ELSE value END AS value,
       event_type, CAST(ts AS DATE) AS day FROM events
""")
def partitioned_update(spark, sf_dir):
    """An update by changeset that is known to fall into two days: the files of all other days stay."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "event_type", F.to_date("ts").alias("day"))
    path = scratch_path(spark, "events-by-day")
    write_table(events, path, "create", partition_by=["day"])
    days = ["2024-01-05", "2024-01-06"]
    errors = events.filter((F.col("event_type") == "error") & F.col("day").isin([F.lit(d).cast("date") for d in days]))
    fixes = errors.select("event_id", F.lit(0.0).alias("value"))
    rewrite_partitions(spark, path, "day", days, lambda df: changes.update_from(df, fixes, [["event_id", "event_id"]]))
    return spark.read.parquet(path)
