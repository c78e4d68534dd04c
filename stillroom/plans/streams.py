"""Incremental loads run as streams over the given event table until nothing new is left."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stillroom.operators.versions import VersionedTable
from stillroom.plans import plan, table
from stillroom.session import scratch_path
from stillroom.streaming.apply import KeyedTable, append_stream, apply_stream, read_stream, window_stream

COLUMNS = ["event_id", "ts", "user_id", "event_type", "value"]
PIECES = 8


def event_files(spark, sf_dir):
    """The event table dealt to several files, in no order, so that a stream of one file a batch has as many batches."""
    path = scratch_path(spark, "event-files")
    table(spark, sf_dir, "events").select(COLUMNS).repartition(PIECES, F.xxhash64("event_id")).write.parquet(path)
    return path


def event_stream(spark, path, sf_dir):
    schema = T.StructType([table(spark, sf_dir, "events").schema[c] for c in COLUMNS])
    return read_stream(spark, path, schema, files_per_batch=1)


@plan("SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_append(spark, sf_dir):
    root, source = scratch_path(spark, "appended"), event_files(spark, sf_dir)
    events = event_stream(spark, source, sf_dir)
    kept = VersionedTable.create(spark, f"{root}/table", events.schema)
    for _ in range(2):  # the second run finds nothing new and adds nothing
        append_stream(events, kept, f"{root}/checkpoint")
    return kept.read()


@plan("""
SELECT event_id, user_id, value, CAST(ts AS DATE) AS day FROM events
UNION ALL SELECT -event_id, user_id, value, CAST(ts AS DATE) FROM events WHERE event_type = 'purchase'
UNION ALL SELECT event_id, user_id, 0.0, CAST(ts AS DATE) FROM events WHERE event_type = 'error'
""")
def mixed_append(spark, sf_dir):
    """A table partitioned by day: a first load, then a stream, then a batch, each batch one commit."""
    root, source = scratch_path(spark, "mixed"), event_files(spark, sf_dir)
    by_day = ["event_id", "user_id", "value", F.to_date("ts").alias("day")]
    events = table(spark, sf_dir, "events")
    first = events.filter("event_type = 'purchase'").withColumn("event_id", -F.col("event_id")).select(by_day)
    kept = VersionedTable.create(spark, f"{root}/table", first.schema, partition="day")
    kept.append(first, "first-load")
    append_stream(event_stream(spark, source, sf_dir).select(by_day), kept, f"{root}/checkpoint")
    kept.append(events.filter("event_type = 'error'").withColumn("value", F.lit(0.0)).select(by_day), "errors")
    return kept.read()


@plan("""
SELECT event_id, value, CAST(ts AS DATE) AS day FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-10'
UNION ALL SELECT event_id, value + 1000, CAST(ts AS DATE) FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-10' AND CAST(ts AS DATE) < DATE '2024-01-20'
UNION ALL SELECT event_id, value + 2000, CAST(ts AS DATE) FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-20'
""")
def window_stream_refresh(spark, sf_dir):
    """Three snapshots of several files, read one file at a time; each replaces its window of days."""
    root = scratch_path(spark, "snapshots")
    events = table(spark, sf_dir, "events").select("event_id", "value", F.to_date("ts").alias("day"))
    for number, start in enumerate(("2000-01-01", "2024-01-10", "2024-01-20")):
        window = events.filter(F.col("day") >= F.lit(start).cast("date")).withColumn("value", F.col("value") + 1000 * number)
        window.repartition(3).write.parquet(f"{root}/in/snapshot={number:04d}/from={start}")
    kept = VersionedTable.create(spark, f"{root}/table", events.schema, partition="day")
    window_stream(spark, f"{root}/in", events.schema, kept, "day", f"{root}/checkpoint", files_per_batch=1)
    return kept.read()


@plan("""
SELECT user_id, event_id, ts, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) t WHERE rn = 1
""")
def stream_upsert(spark, sf_dir):
    """The last event of each user, kept in a keyed table that each batch updates."""
    events = table(spark, sf_dir, "events")
    schema = T.StructType([events.schema[c] for c in ("user_id", "event_id", "ts", "value")])
    root, source = scratch_path(spark, "last-events"), event_files(spark, sf_dir)
    kept = KeyedTable(spark, f"{root}/table", schema, ["user_id"], ["ts", "event_id"])
    apply_stream(event_stream(spark, source, sf_dir).select(schema.fieldNames()), kept, "upsert", f"{root}/checkpoint")
    return kept.read()


@plan("""
WITH ups AS (SELECT user_id, MAX(ts) AS up FROM events GROUP BY 1),
     downs AS (SELECT user_id, MAX(ts) AS down FROM events WHERE event_type = 'purchase' GROUP BY 1)
SELECT ups.user_id, up AS ts FROM ups LEFT JOIN downs ON ups.user_id = downs.user_id WHERE down IS NULL OR down < up
""")
def stream_delete(spark, sf_dir):
    """A user is there from any event on and gone from a purchase on, whatever order the changes arrive in."""
    schema = T.StructType([table(spark, sf_dir, "events").schema[c] for c in ("user_id", "ts")])
    root, source = scratch_path(spark, "users"), event_files(spark, sf_dir)
    users = KeyedTable(spark, f"{root}/table", schema, ["user_id"], ["ts"])
    events = event_stream(spark, source, sf_dir)
    apply_stream(events.select("user_id", "ts"), users, "upsert", f"{root}/upserts")
    apply_stream(events.filter("event_type = 'purchase'").select("user_id", "ts"), users, "delete", f"{root}/deletes")
    return users.read()
