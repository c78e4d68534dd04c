"""Versioned tables: changes by key and by condition, each checked by its rows and by the counts it reports."""

from pyspark.sql import functions as F

from stillroom.operators.versions import VersionedTable
from stillroom.plans import plan, table
from stillroom.schema import struct_from_types
from stillroom.session import scratch_path

ORDERS = struct_from_types([("o_orderkey", "big_int"), ("o_custkey", "big_int"), ("o_orderstatus", "text"), ("o_totalprice", "double")])
KEY = [["o_orderkey", "o_orderkey"]]
LOADS = 4


def orders_table(spark, sf_dir, label):
    """The orders, loaded in several commits of a range of keys each, as a table that grows has them."""
    orders = table(spark, sf_dir, "orders").select(ORDERS.fieldNames())
    kept = VersionedTable.create(spark, f"{scratch_path(spark, label)}/table", ORDERS, keys=["o_orderkey"])
    low, high = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    step = (high - low) // LOADS + 1
    for k in range(LOADS):
        kept.append(orders.filter(F.col("o_orderkey").between(low + k * step, low + (k + 1) * step - 1)), f"load-{k}")
    return kept, orders


@plan("""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 1000 < 10 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 1000 < 10 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders
UNION ALL SELECT -o_orderkey, o_custkey, 'X', o_totalprice + 1 FROM orders WHERE o_orderkey % 1000 = 5
""")
def versioned_upsert(spark, sf_dir):
    """Changed and new orders merged in; only files that may hold one of their keys are read and written."""
    kept, orders = orders_table(spark, sf_dir, "upserted")
    changed = orders.withColumns({"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1})
    fresh = changed.filter("o_orderkey % 1000 = 5").withColumn("o_orderkey", -F.col("o_orderkey"))
    for _ in range(2):  # the second call finds the token applied
        kept.upsert(changed.filter("o_orderkey % 1000 < 10").unionByName(fresh), KEY, "changes-1")
    return kept.read()


@plan("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
WHERE NOT (o_orderstatus = 'F' AND o_totalprice < 100000) AND o_orderkey % 500 <> 7 AND o_orderkey <= (SELECT MAX(o_orderkey) - 100 FROM orders)
""")
def versioned_delete(spark, sf_dir):
    """Deletes by condition, by keys and of the newest rows: positions written down beside files that stay as they are."""
    kept, orders = orders_table(spark, sf_dir, "deleted")
    kept.delete_where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") < 100000))
    kept.delete_matching(orders.filter("o_orderkey % 500 = 7").select("o_orderkey"), KEY)
    kept.delete_where(F.col("o_orderkey") > orders.agg(F.max("o_orderkey")).first()[0] - 100)
    return kept.read()


@plan("""
SELECT 'appended' AS step, COUNT(*) AS n FROM orders
UNION ALL SELECT 'deleted', COUNT(*) FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'deleted again', CAST(0 AS BIGINT)
UNION ALL SELECT 'updated by condition', COUNT(*) FROM orders WHERE o_orderstatus <> 'P' AND o_custkey % 10 = 0
UNION ALL SELECT 'updated by key', COUNT(*) FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 100 = 1
UNION ALL SELECT 'upsert updated', COUNT(*) FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 100 = 2
UNION ALL SELECT 'upsert inserted', COUNT(*) FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 100 = 2
UNION ALL SELECT 'left', COUNT(*) FROM orders WHERE o_orderstatus <> 'P' OR o_orderkey % 100 = 2
""")
def versioned_counts(spark, sf_dir):
    """What each change reports, from the footers and bitmaps of committed files."""
    kept, orders = orders_table(spark, sf_dir, "counted")
    steps = [("appended", kept.count())]
    for name in ("deleted", "deleted again"):
        steps.append((name, kept.delete_where(F.col("o_orderstatus") == "P")))
    steps.append(("updated by condition", kept.update_where({"o_totalprice": F.col("o_totalprice") * 2}, F.col("o_custkey") % 10 == 0)))
    steps.append(("updated by key", kept.update_from(orders.filter("o_orderkey % 100 = 1").select("o_orderkey", "o_custkey"), KEY)))
    updated, inserted = kept.upsert(orders.filter("o_orderkey % 100 = 2"), KEY)
    steps += [("upsert updated", updated), ("upsert inserted", inserted), ("left", kept.read().count())]
    return spark.createDataFrame(steps, "step string, n long")


@plan("""
SELECT event_id, value, CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-10'
UNION ALL SELECT event_id, value + 1, CAST(ts AS DATE) FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-10'
UNION ALL SELECT -event_id, value, CAST(ts AS DATE) FROM events
""")
def versioned_reader_during_refresh(spark, sf_dir):
    """Rows that a reader gets who began before a window was replaced (as negative ids), and those of one after it."""
    events = table(spark, sf_dir, "events").select("event_id", "value", F.to_date("ts").alias("day"))
    kept = VersionedTable.create(spark, f"{scratch_path(spark, 'refreshed')}/table", events.schema, partition="day")
    kept.append(events)
    before = kept.read()
    kept.replace_window(events.withColumn("value", F.col("value") + 1), "2024-01-10")
    return kept.read().unionByName(before.withColumn("event_id", -F.col("event_id")))
