"""Queries over files in place: joins, groupings, unions of Parquet and CSV."""

from pyspark.sql import functions as F

from stillroom.functions.expressions import sql_substring
from stillroom.operators.tables import create_table_as, export_csv
from stillroom.plans import plan, table, table_path
from stillroom.schema import struct_from_types
from stillroom.session import scratch_path
from stillroom.sources.files import external_table, load_csv, load_parquet

MONEY = "decimal(18,2)"


def staged_csv(spark, df, name, **options):
    path = scratch_path(spark, name)
    export_csv(df, path, **options)
    return path


def money(column):
    return F.col(column).cast(MONEY)


@plan("""
SELECT n_name AS country, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name
""")
def external_join_group_sum(spark, sf_dir):
    """Parquet joined with CSV, summed by country. Sums are taken per join key before each join, so the join
    sides hold one row per key and no hot key crosses the shuffle row by row."""
    customers = load_csv(
        spark,
        staged_csv(spark, table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "customers"),
        struct_from_types([("c_custkey", "big_int", False), ("c_nationkey", "int")]),
    )
    nations = load_csv(
        spark,
        staged_csv(spark, table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), "nations"),
        struct_from_types([("n_nationkey", "int", False), ("n_name", "text")]),
    )
    lines, orders = (load_parquet(spark, table_path(sf_dir, t)) for t in ("lineitem", "orders"))
    per_order = lines.groupBy("l_orderkey").agg(F.sum(money("l_quantity") * money("l_extendedprice")).alias("amount"))
    per_customer = (
        per_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(F.sum("amount").alias("amount"))
    )
    per_nation = (
        per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey")
        .agg(F.sum("amount").alias("amount"))
    )
    return (
        per_nation.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("country"))
        .agg(F.sum("amount").cast("double").alias("total"))
        .orderBy("country")
    )


@plan("SELECT COUNT(*) AS n FROM orders")
def external_parquet_count(spark, sf_dir):
    return load_parquet(spark, table_path(sf_dir, "orders")).agg(F.count(F.lit(1)).alias("n"))


@plan("SELECT p_type AS category, CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS sales FROM part GROUP BY p_type")
def external_csv_group_sum(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    schema = struct_from_types([("p_partkey", "big_int"), ("p_type", "text"), ("p_retailprice", "double")])
    sales = external_table(spark, "stillroom_sales", staged_csv(spark, parts, "sales"), format="csv", schema=schema)
    return sales.groupBy(F.col("p_type").alias("category")).agg(F.sum(money("p_retailprice")).cast("double").alias("sales"))


@plan("""
SELECT o_orderkey AS order_key, o_custkey AS customer_key, o_totalprice AS price, CAST(substring(o_orderpriority, 1, 1) AS INT) AS priority_nr
FROM orders WHERE o_orderpriority = '5-LOW'
""")
def external_ctas_filter_calc(spark, sf_dir):
    path = scratch_path(spark, "low-orders")
    chosen = (
        load_parquet(spark, table_path(sf_dir, "orders"))
        .filter(F.col("o_orderpriority") == "5-LOW")
        .select(
            F.col("o_orderkey").alias("order_key"),
            F.col("o_custkey").alias("customer_key"),
            F.col("o_totalprice").alias("price"),
            sql_substring("o_orderpriority", 0, 2).cast("int").alias("priority_nr"),
        )
    )
    return create_table_as(chosen, "low_orders_" + path[-32:], path)


@plan("SELECT * FROM supplier UNION ALL SELECT * FROM supplier")
def external_multi_file_union(spark, sf_dir):
    """A file listed twice gives its rows twice."""
    schema = struct_from_types([("s_suppkey", "big_int"), ("s_name", "text"), ("s_nationkey", "int"), ("s_acctbal", "double")])
    path = staged_csv(spark, table(spark, sf_dir, "supplier"), "suppliers", header=False)
    return load_csv(spark, [path, path], schema, header=False).orderBy("s_suppkey")


@plan("""
SELECT p_type AS category, CASE WHEN r.returned IS NULL THEN 'Not Returned' ELSE 'Returned' END AS return_info,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sales
FROM lineitem JOIN part ON l_partkey = p_partkey
LEFT JOIN (SELECT DISTINCT l_orderkey AS order_id, 'Yes' AS returned FROM lineitem WHERE l_returnflag = 'R') r ON lineitem.l_orderkey = r.order_id
GROUP BY 1, 2
""")
def external_left_join_return_info(spark, sf_dir):
    """The fact table stays on the left of both joins and is summed per part between them."""
    lines = load_parquet(spark, table_path(sf_dir, "lineitem"))
    returned = lines.filter(F.col("l_returnflag") == "R").select(F.lit("Yes").alias("returned"), F.col("l_orderkey").alias("order_id")).distinct()
    returns = external_table(
        spark,
        "stillroom_returns",
        staged_csv(spark, returned, "returns", sep=";"),
        format="csv",
        schema=struct_from_types([("returned", "text"), ("order_id", "big_int")]),
        sep=";",
    )
    info = F.when(F.col("returned").isNull(), "Not Returned").otherwise("Returned")
    per_part = (
        lines.join(returns, F.col("l_orderkey") == F.col("order_id"), "left")
        .groupBy("l_partkey", info.alias("return_info"))
        .agg(F.sum(money("l_extendedprice")).alias("amount"))
    )
    parts = load_parquet(spark, table_path(sf_dir, "part"))
    return (
        per_part.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("p_type").alias("category"), "return_info")
        .agg(F.sum("amount").cast("double").alias("sales"))
        .orderBy("category", "return_info")
    )


@plan("SELECT c_acctbal, c_mktsegment FROM customer")
def project_columns(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_acctbal", "c_mktsegment")


@plan("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10")
def sorted_limit(spark, sf_dir):
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_acctbal")
        .orderBy(F.col("c_acctbal").desc_nulls_last(), F.col("c_custkey").asc())
        .limit(10)
    )


@plan("SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) // 3 AS thirds, CAST(l_quantity AS BIGINT) * 2 + 1 AS odd FROM lineitem")
def integer_arithmetic(spark, sf_dir):
    """Division of integers cuts off; other arithmetic is plain."""
    from stillroom.functions.expressions import integer_divide

    whole = F.col("l_quantity").cast("bigint")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", integer_divide(whole, F.lit(3)).alias("thirds"), (whole * 2 + 1).alias("odd")
    )


@plan("""
SELECT p_name, substring(p_brand, 1, 5) AS brand_head, substring(p_type, 2, 3) AS type_middle,
       CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'STANDARD' THEN 2 END AS type_nr, p_partkey
FROM part
""")
def substring_and_case(spark, sf_dir):
    from stillroom.functions.expressions import case_value

    return table(spark, sf_dir, "part").select(
        "p_partkey",
        "p_name",
        sql_substring("p_brand", 0, 6).alias("brand_head"),
        sql_substring("p_type", 2, 3).alias("type_middle"),
        case_value("p_type", {"ECONOMY": 1, "STANDARD": 2}).alias("type_nr"),
    )
