"""Catalog queries: listings, joins of metadata, catalog-driven copies."""

import uuid

from pyspark.sql import functions as F

from stillroom.operators.catalog import list_catalog, list_root, table_counts
from stillroom.operators.tables import convert_tables, copy_tables, table_names, tables_below, write_table
from stillroom.plans import plan, table
from stillroom.session import scratch_path

NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _views(spark, sf_dir, names):
    """Temporary views of the given tables under a prefix of their own."""
    prefix = f"v{uuid.uuid4().hex[:12]}_"
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(prefix + name)
    return prefix


@plan(f"""
SELECT c.table_name, ordinal_position AS position, column_name,
       CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'
         WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' ELSE data_type END AS data_type,
       is_nullable = 'YES' AS nullable, CAST(NULL AS VARCHAR) AS collation, t.n
FROM information_schema.columns c JOIN ({" UNION ALL ".join(f"SELECT '{name}' AS table_name, COUNT(*) AS n FROM {name}" for name in NAMES)}) t ON c.table_name = t.table_name
""")
def catalog_columns(spark, sf_dir):
    """Every column of every table of the folder, through the session catalog, with the tables' row counts."""
    names = table_names(spark, sf_dir)
    prefix = _views(spark, sf_dir, names)
    listed = list_catalog(spark, pattern=f"{prefix}*").select(
        F.substring("table_name", len(prefix) + 1, 64).alias("table_name"), "position", "column_name", "data_type", "nullable", "collation"
    )
    counts = table_counts({name: spark.table(prefix + name) for name in names})
    return listed.join(counts, "table_name")


@plan("""
SELECT 'star' AS schema_name, 'orders' AS table_name, 'o_orderkey' AS column_name, 'bigint' AS data_type, COUNT(*) AS n FROM orders
UNION ALL SELECT 'star', 'nation', 'n_nationkey', 'int', COUNT(*) FROM nation
""")
def catalog_join_filter(spark, sf_dir):
    """A query over metadata: the first columns of the tables of one schema, of two roots joined, with row counts."""
    root = scratch_path(spark, "schemas")
    for name in ("star/orders", "star/nation", "other/region"):
        write_table(table(spark, sf_dir, name.rpartition("/")[2]), f"{root}/{name}", "create")
    copied = scratch_path(spark, "schemas-copy")
    copy_tables(spark, root, copied)
    left, right = list_root(spark, root), list_root(spark, copied)
    same = ["schema_name", "table_name", "column_name", "data_type"]
    chosen = left.filter((F.col("position") == 1) & (F.col("schema_name") != "other")).join(right.select(same), same)
    counts = table_counts({name: spark.read.parquet(path) for name, path in tables_below(spark, copied).items()})
    counts = counts.select(F.substring_index("table_name", ".", -1).alias("table_name"), "n")
    return chosen.join(counts, "table_name").select(*same, "n")


@plan(" UNION ALL ".join(f"SELECT '{name}' AS table_name, COUNT(*) AS n FROM {name}" for name in NAMES if name not in ("region", "benchmark")))
def catalog_driven_copy(spark, sf_dir):
    """Tables are chosen by a query over the catalog, those of three columns or more, then each is copied by a job of its own."""
    prefix = _views(spark, sf_dir, table_names(spark, sf_dir))
    wanted = (
        list_catalog(spark, pattern=f"{prefix}*")
        .groupBy("table_name")
        .agg(F.count(F.lit(1)).alias("columns"))
        .filter(F.col("columns") >= 3)
    )
    root = scratch_path(spark, "converted")
    convert_tables(spark, wanted, root)
    return table_counts({name.removeprefix(prefix): spark.read.parquet(path) for name, path in tables_below(spark, root).items()})
