"""Loads, copies, lookups and checks that tell their whole rows."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stillroom.functions import geo
from stillroom.functions.expressions import quote_column
from stillroom.operators import changes, commits, tables
from stillroom.operators.versions import VersionedTable, read_table
from stillroom.plans import plan, table, table_path
from stillroom.plans.streams import event_files, event_stream
from stillroom.schema import describe, struct_from_types
from stillroom.session import scratch_path
from stillroom.sources.files import attach, detach
from stillroom.sources.rows import fetch_rows, write_rows
from stillroom.streaming.apply import append_stream, read_stream


@plan("""
SELECT 'events' AS table_name, event_id AS id, event_type AS name FROM events
UNION ALL SELECT 'sub.customer', c_custkey, c_name FROM customer UNION ALL SELECT 'sub.supplier', s_suppkey, s_name FROM supplier
""")
def copy_stream_made_tables(spark, sf_dir):
    """A root with a table that a stream has appended to, a versioned one and a plain one, copied and attached."""
    root, source = scratch_path(spark, "made"), event_files(spark, sf_dir)
    append_stream(event_stream(spark, source, sf_dir), f"{root}/old/events", f"{root}/checkpoint")
    customers = table(spark, sf_dir, "customer")
    kept = VersionedTable.create(spark, f"{root}/old/sub/customer", customers.schema, keys=["c_custkey"])
    kept.append(customers.unionByName(customers.limit(3).withColumn("c_custkey", F.col("c_custkey") - 1_000_000)))
    kept.delete_where(F.col("c_custkey") < 0)
    tables.write_table(table(spark, sf_dir, "supplier"), f"{root}/old/sub/supplier")
    tables.copy_tables(spark, f"{root}/old", f"{root}/new")
    views = attach(spark, f"{root}/new", f"copied_{root[-32:]}")
    rows = {v.partition(root[-32:] + "_")[2].replace("sub_", "sub."): spark.table(v) for v in views}
    detach(spark, views)
    columns = {"events": ("event_id", "event_type"), "sub.customer": ("c_custkey", "c_name"), "sub.supplier": ("s_suppkey", "s_name")}
    parts = [rows[n].select(F.lit(n).alias("table_name"), F.col(i).cast("bigint").alias("id"), F.col(c).alias("name")) for n, (i, c) in columns.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@plan("""
SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS request_id FROM supplier UNION ALL SELECT -s_suppkey, s_name, 'r-1' FROM supplier WHERE s_acctbal > 0
UNION ALL SELECT s_suppkey + 1000000, s_name, 'r-2' FROM supplier
""")
def request_on_existing_table(spark, sf_dir):
    """Requests appended to a table that was there before them; one is sent twice."""
    suppliers, path = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal"), scratch_path(spark, "existing")
    tables.write_table(suppliers.drop("s_acctbal"), path)
    positive = suppliers.filter("s_acctbal > 0").select((-F.col("s_suppkey")).alias("s_suppkey"), "s_name")
    shifted = suppliers.select((F.col("s_suppkey") + 1_000_000).cast("bigint").alias("s_suppkey"), "s_name")
    for request, df in (("r-1", positive), ("r-2", shifted), ("r-1", positive)):
        tables.append_once(df.select(F.col("s_suppkey").cast(suppliers.schema["s_suppkey"].dataType), "s_name"), path, request)
    return spark.read.parquet(path).select("s_suppkey", "s_name", "request_id")


@plan("SELECT p_name AS value FROM part")
def saved_text(spark, sf_dir):
    """One column stored as text lines; the query's time is taken as well, and its result dropped."""
    path, names = scratch_path(spark, "lines"), table(spark, sf_dir, "part").select("p_name")
    tables.save_text(names, path)
    if tables.discard(names) < 0:
        raise AssertionError("no time was taken")
    return spark.read.text(path)


@plan("""
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'x`y' ELSE c_name END AS name FROM customer WHERE c_mktsegment <> 'MACHINERY'
""")
def exclusive_match(spark, sf_dir):
    """Changes matched by keys or by a condition, on columns of odd names; giving both, or neither, is refused each time."""
    odd = {"c_custkey": "key, of `all`", "c_name": "the \"name\".x", "c_mktsegment": "seg ment"}
    customers = table(spark, sf_dir, "customer").select([F.col(c).alias(n) for c, n in odd.items()])
    key, name, segment = (quote_column(n) for n in odd.values())
    match = {"op": "eq", "target-col": odd["c_custkey"], "source-col": odd["c_custkey"]}
    gone = customers.filter(F.col(segment) == "MACHINERY").select(key)
    for wrong in ({}, {"match_columns": [[odd["c_custkey"]] * 2], "match_condition": match}):
        try:
            changes.apply_change(customers, "delete", gone, **wrong)
        except ValueError:
            continue
        raise AssertionError(f"a delete with {sorted(wrong)} was taken")
    left = changes.apply_change(customers, "delete", gone, match_columns=[[odd["c_custkey"]] * 2])
    renamed = customers.filter(F.col(segment) == "BUILDING").select(key, F.lit("x`y").alias(odd["c_name"]))
    left = changes.apply_change(left, "update", renamed, match_condition=match)
    return left.select(F.col(key).alias("c_custkey"), F.col(name).alias("name"))


@plan("""
SELECT table_name, column_name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' ELSE data_type END AS data_type, is_nullable = 'YES' AS nullable
FROM information_schema.columns
""")
def table_definitions(spark, sf_dir):
    """The definition of every table, as written down for a new one."""
    rows = [(name, *column) for name, path in tables.tables_below(spark, sf_dir).items() for column in describe(read_table(spark, path).schema)]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, nullable boolean")


class _Dying(VersionedTable):
    """Dies after each commit, before its caller learns of it, the first time that a batch comes."""

    def append(self, df, token=None):
        rows = super().append(df, token)
        if rows:
            raise ConnectionError("died after the commit")
        return rows


@plan("SELECT event_id, ts, user_id, event_type, value FROM events")
def broken_stream_retry(spark, sf_dir):
    """A stream whose every batch dies between its commit and its answer, started again until it is through."""
    root, source = scratch_path(spark, "dying"), event_files(spark, sf_dir)
    schema = T.StructType([table(spark, sf_dir, "events").schema[c] for c in ("event_id", "ts", "user_id", "event_type", "value")])
    kept = _Dying(spark, VersionedTable.create(spark, f"{root}/table", schema).path)
    for _ in range(10):
        try:
            append_stream(read_stream(spark, source, schema, files_per_batch=4), kept, f"{root}/checkpoint")
            return kept.read()
        except Exception as error:
            if "died after the commit" not in str(error):
                raise
    raise AssertionError("the stream did not get through")


@plan("""
SELECT n_nationkey AS k, n_name AS name FROM nation UNION ALL SELECT user_id, event_type FROM events
""")
def iterated_and_fetched_rows(spark, sf_dir):
    """Rows from an iterator in the driver, in batches, and rows that tasks fetch by themselves, a slot each."""
    schema = struct_from_types([("k", "big_int"), ("name", "text")])
    path = scratch_path(spark, "iterated")
    names = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint"), "n_name")
    write_rows(spark, map(tuple, names.toLocalIterator()), schema, path, batch_rows=7)
    address, slots = table_path(sf_dir, "events"), 4

    def fetch(slot):
        import pyarrow.dataset as ds

        found = ds.dataset(address).to_table(columns=["user_id", "event_type", "event_id"])
        mine = found.filter((ds.field("event_id") >= 0)).slice(slot * (-(-len(found) // slots)), -(-len(found) // slots))
        for batch in mine.select(["user_id", "event_type"]).rename_columns(["k", "name"]).cast(schema_of).to_batches():
            yield batch

    import pyarrow as pa

    schema_of = pa.schema([("k", pa.int64()), ("name", pa.string())])
    return spark.read.schema(schema).parquet(path).unionByName(fetch_rows(spark, range(slots), fetch, schema))


@plan("""
WITH small AS (SELECT doc_id, sha256(text) AS h FROM documents WHERE strlen(text) < 10240),
     firsts AS (SELECT h, MIN(doc_id) AS file_id, MIN(doc_id % 3) AS run FROM small GROUP BY 1),
     runs AS (SELECT h, doc_id % 3 AS run, MIN(doc_id) AS file_id FROM small GROUP BY 1, 2)
SELECT runs.h AS file_hash, runs.file_id, runs.run FROM runs JOIN firsts ON runs.h = firsts.h AND runs.run = firsts.run
""")
def incremental_contents(spark, sf_dir):
    """Three runs over a third of the documents each, against one index of all hashes; the last run is repeated."""
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("file_id"), F.col("text").alias("content"))
    index = commits.hash_index(spark, f"{scratch_path(spark, 'hashes')}/index")
    runs = [commits.take_new_contents(documents.filter(F.col("file_id") % 3 == k), index, f"run-{k}", 10240).withColumn("run", F.lit(k).cast("bigint")) for k in (0, 1, 2)]
    again = commits.take_new_contents(documents.filter(F.col("file_id") % 3 == 2), index, "run-2", 10240)
    return runs[0].unionByName(runs[1]).unionByName(again.withColumn("run", F.lit(2).cast("bigint")))


@plan("""
WITH placed AS (SELECT event_id, event_id % 3600 / 10.0 - 180 AS lon, event_id // 7 % 1800 / 10.0 - 90 AS lat FROM events)
SELECT 'alps' AS box, event_id FROM placed WHERE lon BETWEEN 5.9962 AND 30.5226 AND lat BETWEEN 35.8389 AND 47.8229
UNION ALL SELECT 'date line', event_id FROM placed WHERE (lon >= 170 OR lon <= -165) AND lat BETWEEN -45 AND 10
""")
def box_on_layout(spark, sf_dir):
    """Boxes searched in a table that lies along a space-filling curve; one reaches over the date line."""
    key = F.col("event_id")
    placed = table(spark, sf_dir, "events").select("event_id", (key % 3600 / 10.0 - 180).alias("lon"), (F.floor(key / 7) % 1800 / 10.0 - 90).alias("lat"))
    placed = placed.withColumn("cell", geo.cell("lon", "lat"))
    kept = VersionedTable.create(spark, f"{scratch_path(spark, 'placed')}/table", placed.schema, keys=["cell"])
    kept.append(placed)
    boxes = {"alps": (5.9962, 30.5226, 35.8389, 47.8229), "date line": (170.0, -165.0, -45.0, 10.0)}
    found = [kept.in_box("lon", "lat", box).select(F.lit(name).alias("box"), "event_id") for name, box in boxes.items()]
    return found[0].unionByName(found[1])


@plan("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def dense_rewrite(spark, sf_dir):
    """A table of very uneven files written anew in files of like size."""
    orders, root = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), scratch_path(spark, "uneven")
    size = F.floor(F.log2((F.col("o_orderkey") % 1000 + 1).cast("double"))).alias("size")  # each about twice the one before
    orders.repartition(10, size).write.parquet(f"{root}/old")
    tables.rewrite_dense(spark, f"{root}/old", f"{root}/new", file_bytes=200_000)
    return spark.read.parquet(f"{root}/new")
