"""Save modes, copies of whole sets of tables, export, keys."""

from pyspark.sql import functions as F

from stillroom.operators import tables
from stillroom.operators.catalog import table_counts
from stillroom.operators.model import Model, check_keys, denormalise, model_of, tag_keys
from stillroom.plans import plan, table
from stillroom.plans.external import money
from stillroom.schema import struct_from_types
from stillroom.session import scratch_path
from stillroom.sources.files import attach, detach, load_csv


@plan("""
SELECT 'create' AS step, COUNT(*) AS n FROM supplier
UNION ALL SELECT 'append', 2 * COUNT(*) FROM supplier
UNION ALL SELECT 'overwrite', COUNT(*) FROM supplier
""")
def publish_modes(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier")
    root = scratch_path(spark, "published")
    tables.publish(suppliers, f"{root}/create", "create-new")
    for _ in range(2):
        tables.refresh(suppliers, f"{root}/append")
    tables.publish(suppliers.unionByName(suppliers), f"{root}/overwrite", "create-new")
    # The new content is read from the table it replaces.
    tables.publish(spark.read.parquet(f"{root}/overwrite").dropDuplicates(["s_suppkey"]), f"{root}/overwrite", "overwrite")
    steps = {step: spark.read.parquet(f"{root}/{step}") for step in ("create", "append", "overwrite")}
    return table_counts(steps).withColumnRenamed("table_name", "step")


COPIED = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@plan(" UNION ALL ".join(f"SELECT '{name}' AS table_name, COUNT(*) AS n FROM {name}" for name in COPIED))
def copy_all_tables(spark, sf_dir):
    """Every table of the folder, as it stands there, copied and attached; the copies must hold the same rows."""
    root = scratch_path(spark, "copies")
    tables.copy_tables(spark, sf_dir, root)
    views = attach(spark, root, "copied")
    frames = {view.removeprefix("copied_"): spark.table(view) for view in views}
    different = [name for name, df in frames.items() if content_sum(df) != content_sum(table(spark, sf_dir, name))]
    if different:
        raise AssertionError(f"copies that differ: {different}")
    counts = table_counts(frames)
    detach(spark, views)
    return counts


def content_sum(df):
    """A number that the rows of a table give in any order."""
    return df.agg(F.count(F.lit(1)), F.sum((F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)) % 1_000_000_007).cast("decimal(38,0)"))).first()


@plan("SELECT doc_id, text, lang, source, n_chars FROM documents UNION ALL SELECT -1, 'NULL', NULL, '', 0 UNION ALL SELECT -2, concat('\\NULL', chr(10), '\"'), '\\NULL', 'a,b', NULL")
def csv_export_roundtrip(spark, sf_dir):
    """Texts with line breaks and quotes, the null token as a text, empty texts and NULL, there and back."""
    schema = struct_from_types([("doc_id", "big_int"), ("text", "text"), ("lang", "text"), ("source", "text"), ("n_chars", "big_int")])
    odd = spark.createDataFrame([(-1, "NULL", None, "", 0), (-2, '\\NULL\n"', "\\NULL", "a,b", None)], schema)
    path = scratch_path(spark, "exported")
    tables.export_csv(table(spark, sf_dir, "documents").select(odd.columns).unionByName(odd), path)
    return load_csv(spark, path, schema, multi_line=True)


def order_model():
    return (
        Model()
        .primary_key("orders", "o_orderkey")
        .foreign_key("orders", "o_custkey", "customer", "c_custkey")
        .foreign_key("lineitem", "l_orderkey", "orders", "o_orderkey")
    )


@plan("""
SELECT 'orders_pk' AS check_name, COUNT(*) - COUNT(DISTINCT o_orderkey) AS violations FROM orders
UNION ALL SELECT 'orders_customer_fk', COUNT(*) FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
UNION ALL SELECT 'lineitem_orders_fk', COUNT(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
""")
def key_validation(spark, sf_dir):
    """Keys are declared on the tables' columns, read back and then tested."""
    names = ("customer", "orders", "lineitem")
    tagged = {name: tag_keys(table(spark, sf_dir, name), name, order_model()) for name in names}
    return check_keys(tagged, model_of(tagged))


@plan("""
SELECT r_name, COUNT(*) AS n_orders, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY r_name
""")
def relationship_tree_sum(spark, sf_dir):
    """Tables joined along their declared keys, then summed."""
    model = (
        Model()
        .foreign_key("orders", "o_custkey", "customer", "c_custkey")
        .foreign_key("customer", "c_nationkey", "nation", "n_nationkey")
        .foreign_key("nation", "n_regionkey", "region", "r_regionkey")
    )
    frames = {name: table(spark, sf_dir, name) for name in ("orders", "customer", "nation", "region")}
    return (
        denormalise(frames, model)
        .groupBy("r_name")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.sum(money("o_totalprice")).cast("double").alias("total"))
    )


@plan("SELECT c_nationkey AS nation, COUNT(*) AS n FROM customer WHERE c_acctbal >= 0 GROUP BY c_nationkey")
def insert_select(spark, sf_dir):
    """A catalog table created from a definition, filled by INSERT … SELECT in two steps."""
    path = scratch_path(spark, "inserted")
    name = "kept_customers_" + path[-32:]
    tables.create_catalog_table(spark, name, struct_from_types([("key", "big_int"), ("nation", "int"), ("balance", "double")]), path)
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_acctbal").alias("balance"), F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("key")
    )
    for part in (F.col("balance") >= 100, (F.col("balance") >= 0) & (F.col("balance") < 100)):
        tables.insert_into(customers.filter(part), name)
    return spark.table(name).groupBy("nation").agg(F.count(F.lit(1)).alias("n"))
