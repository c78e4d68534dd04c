"""Loads: CSV in several dialects, declared Parquet, header files, rows in memory, staged parts."""

from pyspark.sql import functions as F

from stillroom import files
from stillroom.functions.expressions import case_value, parse_timestamp
from stillroom.operators.changes import insert_from
from stillroom.operators.tables import batched_parts, export_csv, write_table
from stillroom.plans import plan, table, table_path
from stillroom.plans.external import staged_csv
from stillroom.schema import struct_from_types
from stillroom.session import scratch_path
from stillroom.sources.files import load_csv, load_csv_with_header_file, load_parquet
from stillroom.sources.jdbc import SourceColumn, source_schema, staged_parts
from stillroom.sources.limits import QueryTooLargeError, guard_size, sample
from stillroom.sources.rows import map_columns, pandas_to_df, rows_to_df

CUSTOMER = struct_from_types(
    [
        ("c_custkey", "big_int", False),
        ("c_name", "text", False),
        ("c_nationkey", "int", False),
        ("c_acctbal", "double"),
        ("c_mktsegment", "text"),
    ]
)
SUPPLIER = struct_from_types([("s_suppkey", "big_int"), ("s_name", "text"), ("s_nationkey", "int"), ("s_acctbal", "double")])


@plan("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_copy_load(spark, sf_dir):
    source = staged_csv(spark, table(spark, sf_dir, "customer"), "customer-csv")
    target = scratch_path(spark, "customer")
    write_table(load_csv(spark, source, CUSTOMER), target, "create", schema=CUSTOMER)
    return load_parquet(spark, target)


@plan("""
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN '' ELSE c_mktsegment END AS c_mktsegment FROM customer
""")
def csv_null_token(spark, sf_dir):
    segment = F.when(F.col("c_mktsegment") == "MACHINERY", "").when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    df = table(spark, sf_dir, "customer").select("c_custkey", segment.alias("c_mktsegment"))
    return load_csv(spark, staged_csv(spark, df, "segments"), struct_from_types([("c_custkey", "big_int"), ("c_mktsegment", "text")]))


@plan("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def csv_date_style(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("o_orderdate"))
    schema = struct_from_types([("o_orderkey", "big_int"), ("o_orderdate", "date")])
    return load_csv(spark, staged_csv(spark, df, "dates"), schema, date_style="DMY")


@plan("""
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders
""")
def parquet_copy_load(spark, sf_dir):
    schema = struct_from_types(
        [
            ("o_orderkey", "big_int", False),
            ("o_custkey", "big_int", False),
            ("o_orderstatus", "text"),
            ("o_totalprice", "numeric(12,2)"),
            ("o_orderdate", "date"),
            ("o_orderpriority", "text"),
        ]
    )
    target = scratch_path(spark, "orders")
    write_table(load_parquet(spark, table_path(sf_dir, "orders"), schema), target, "create")
    return load_parquet(spark, target)


@plan("SELECT s_suppkey, s_name, s_nationkey, s_acctbal, concat('src_', CAST(s_nationkey AS VARCHAR(10))) AS source_dir FROM supplier")
def wildcard_union_file_path(spark, sf_dir):
    """One read over many folders; every row says which file it came from."""
    root = scratch_path(spark, "wildcard")
    df = table(spark, sf_dir, "supplier")
    folder = F.concat(F.lit("src_"), F.col("s_nationkey").cast("string"))
    df.withColumn("dir", folder).hint("rebalance", "dir").write.partitionBy("dir").option("header", False).csv(root)
    loaded = load_csv(spark, f"{root}/dir=src_*/*.csv", SUPPLIER, header=False, path_column="File Path", name_filter="part-*")
    return loaded.withColumn("source_dir", F.regexp_extract("File Path", r"dir=(src_\d+)/", 1)).drop("File Path")


@plan("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def header_file_schema_load(spark, sf_dir):
    root = scratch_path(spark, "headed")
    export_csv(table(spark, sf_dir, "supplier"), f"{root}/data", header=False)
    files.write_text(spark, f"{root}/header.csv", "s_suppkey,s_name,s_nationkey,s_acctbal\nbig_int,varchar,integer,double\n")
    return load_csv_with_header_file(spark, f"{root}/data/*.csv", f"{root}/header.csv").drop("File Path")


@plan("SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, o_orderpriority FROM orders")
def source_typed_load(spark, sf_dir):
    """A table typed by what a database says about its columns, one type overridden."""
    described = [
        SourceColumn("o_orderkey", "long", False),
        SourceColumn("o_custkey", "long", False),
        SourceColumn("o_totalprice", "Decimal", True, 38, 20),
        SourceColumn("o_orderpriority", "str"),
    ]
    schema = source_schema("azuresql", described, {"o_totalprice": {"sqltype": "numeric", "precision": 12, "scale": 2}})
    return load_parquet(spark, table_path(sf_dir, "orders"), schema)


@plan("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def staged_parts_load(spark, sf_dir):
    """Compressed headerless parts, as a database exports them, packed five to an output file."""
    root = scratch_path(spark, "parts")
    export_csv(table(spark, sf_dir, "part"), f"{root}/export", header=False, compression="gzip")
    schema = struct_from_types(
        [("p_partkey", "big_int"), ("p_name", "text"), ("p_brand", "text"), ("p_type", "text"), ("p_size", "int"), ("p_retailprice", "double")]
    )
    loaded = staged_parts(spark, f"{root}/export/part-*.csv.gz", schema)
    parts = len(files.glob(spark, f"{root}/export/part-*.csv.gz"))
    write_table(batched_parts(loaded, parts), f"{root}/table", "create")
    return load_parquet(spark, f"{root}/table")


@plan("SELECT event_id, ts, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def json_column_load(spark, sf_dir):
    """A JSON column and a timestamp column through CSV text."""
    df = table(spark, sf_dir, "events").select("event_id", "ts", "props")
    schema = struct_from_types([("event_id", "big_int", False), ("ts", "timestamp"), ("props", "json")])
    loaded = load_csv(spark, staged_csv(spark, df, "events-csv"), schema)
    return loaded.select("event_id", "ts", F.variant_get("props", "$.k", "int").alias("k"))


@plan("SELECT COUNT(*) AS n FROM (SELECT * FROM orders LIMIT 1000) t")
def load_sample(spark, sf_dir):
    return sample(load_parquet(spark, table_path(sf_dir, "orders"))).agg(F.count(F.lit(1)).alias("n"))


@plan("SELECT l_returnflag, COUNT(*) AS n, TRUE AS refused FROM lineitem GROUP BY l_returnflag")
def size_guard(spark, sf_dir):
    """Runs within the table's own size, and is refused one byte below it."""
    size = files.total_bytes(spark, table_path(sf_dir, "lineitem"))
    counts = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    try:
        guard_size(counts, size - 1)
        refused = False
    except QueryTooLargeError:
        refused = True
    return guard_size(counts, size).withColumn("refused", F.lit(refused))


@plan("""
SELECT 'one column' AS query, FALSE AS refused, COUNT(*) AS n FROM documents WHERE lang IS NOT NULL
UNION ALL SELECT 'whole table', TRUE, NULL
UNION ALL SELECT 'no row group', FALSE, 0
""")
def size_guard_by_columns(spark, sf_dir):
    """One limit admits a column of a table, and rows that statistics rule out, and refuses the table as a whole."""
    documents = table(spark, sf_dir, "documents")
    limit = files.total_bytes(spark, table_path(sf_dir, "documents")) // 2

    def asked(name, df):
        try:
            return guard_size(df, limit, by_columns=True).select(F.lit(name).alias("query"), F.lit(False).alias("refused"), "n")
        except QueryTooLargeError:
            return spark.range(1).select(F.lit(name).alias("query"), F.lit(True).alias("refused"), F.lit(None).cast("bigint").alias("n"))

    count = F.count(F.lit(1)).alias("n")
    whole = documents.filter(F.concat("text", "source", "lang", F.col("doc_id").cast("string")) != "").agg(count)
    found = asked("one column", documents.filter("lang IS NOT NULL").agg(count)).unionByName(asked("whole table", whole))
    return found.unionByName(asked("no row group", documents.filter("doc_id < -1 AND text IS NOT NULL").agg(count)))


@plan("""
SELECT c_custkey AS customer_key, c_name AS customer_name, c_mktsegment AS segment FROM customer
UNION ALL SELECT -1, 'Mira Lund', 'Consumer' UNION ALL SELECT -2, 'Tomas Quist', 'Corporate'
UNION ALL SELECT -3, 'Frame Row', 'Corporate' UNION ALL SELECT -4, 'Value''s Row', 'Consumer'
""")
def rows_insert(spark, sf_dir):
    """Rows from a list, a pandas frame and a VALUES text added to a stored table."""
    import pandas as pd

    schema = struct_from_types([("customer_key", "big_int", False), ("customer_name", "text", False), ("segment", "text", False)])
    stored = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_key"), F.col("c_name").alias("customer_name"), F.col("c_mktsegment").alias("segment")
    )
    listed = rows_to_df(spark, [(-1, "Mira Lund", "Consumer"), (-2, "Tomas Quist", "Corporate")], schema)
    framed = pandas_to_df(spark, pd.DataFrame({"customer_key": [-3], "customer_name": ["Frame Row"], "segment": ["Corporate"]}), schema)
    valued = spark.sql("SELECT * FROM VALUES (-4L, :name, 'Consumer') AS t(customer_key, customer_name, segment)", args={"name": "Value's Row"})
    for added in (listed, framed, valued):
        stored = insert_from(stored, added, schema)
    return stored


@plan("""
SELECT o_orderkey AS order_id, o_orderdate AS ship_timestamp,
       CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '5-LOW' THEN 3 END AS ship_priority FROM orders
""")
def insert_with_expressions(spark, sf_dir):
    """Target columns computed while loading: time text parsed, priority text mapped to a number."""
    incoming = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("ship text"),
        F.col("o_orderpriority").alias("priority text"),
    )
    target = struct_from_types([("order_id", "big_int", False), ("ship_timestamp", "timestamp"), ("ship_priority", "int")])
    return map_columns(
        incoming.withColumn("ship_priority", case_value("priority text", {"1-URGENT": 1, "3-MEDIUM": 2, "5-LOW": 3})).withColumn(
            "ship_timestamp", parse_timestamp("ship text", "YYYY-MM-DD HH24:MI:SS")
        ),
        ["order_id", "ship_timestamp", ("ship_priority", "ship_priority")],
        target,
    )
