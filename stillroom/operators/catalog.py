"""Listings of databases, tables and columns as frames."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stillroom.functions.expressions import quote_column
from stillroom.functions.geo import is_geography
from stillroom.operators.tables import tables_below
from stillroom.operators.versions import read_table

LISTING = T.StructType(
    [
        T.StructField("schema_name", T.StringType()),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("position", T.IntegerType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("data_type", T.StringType(), False),
        T.StructField("nullable", T.BooleanType(), False),
        T.StructField("collation", T.StringType()),
    ]
)


def _rows(database: str | None, table: str, schema: T.StructType) -> list[tuple]:
    rows = []
    for position, field in enumerate(schema.fields, start=1):
        collation = getattr(field.dataType, "collation", None)
        collation = None if collation == "UTF8_BINARY" else collation
        rows.append((database, table, position, field.name, field.dataType.simpleString(), field.nullable, collation))
    return rows


def list_catalog(spark: SparkSession, database: str | None = None, pattern: str | None = None) -> DataFrame:
    """Every column of every table and view the session catalog knows, or of one database or name pattern."""
    databases = [database] if database else [d.name for d in spark.catalog.listDatabases()]
    rows, views = [], set()
    for name in databases:
        for table in spark.catalog.listTables(name, pattern):
            if table.isTemporary and table.name in views:
                continue  # every database lists the session's views again
            if table.isTemporary:
                views.add(table.name)
            qualified = quote_column(table.name) if table.isTemporary else f"{quote_column(name)}.{quote_column(table.name)}"
            rows += _rows(None if table.isTemporary else name, table.name, spark.table(qualified).schema)
    return spark.createDataFrame(rows, LISTING)


def list_root(spark: SparkSession, root: str) -> DataFrame:
    """Every column of every table below a directory root; only file footers are read."""
    rows = []
    for name, path in sorted(tables_below(spark, root).items()):
        database, _, table = name.rpartition(".")
        rows += _rows(database or None, table, read_table(spark, path).schema)
    return spark.createDataFrame(rows, LISTING)


def list_schemas(spark: SparkSession) -> DataFrame:
    """Databases with the number of tables in each."""
    rows = [(d.name, sum(not t.isTemporary for t in spark.catalog.listTables(d.name))) for d in spark.catalog.listDatabases()]
    return spark.createDataFrame(rows, "schema_name string, tables int")


def table_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, n)``; over Parquet only the footers are read."""
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in frames.items()]
    return reduce(DataFrame.unionByName, counts)


def spatial_columns(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, column_name, n)`` for each geography column, with its table's row count."""
    found = []
    for name, df in frames.items():
        spatial = [f.name for f in df.schema.fields if is_geography(f.dataType)]
        if spatial:
            counted = df.agg(F.count(F.lit(1)).alias("n"))
            columns = F.explode(F.array([F.lit(c) for c in spatial])).alias("column_name")
            found.append(counted.select(F.lit(name).alias("table_name"), columns, "n"))
    if not found:
        session = next(iter(frames.values())).sparkSession
        return session.createDataFrame([], "table_name string, column_name string, n bigint")
    return reduce(DataFrame.unionByName, found)


def print_listing(listing: DataFrame) -> str:
    """The listing as indented text, tables with their column counts."""
    lines, current = [], None
    rows = sorted(listing.collect(), key=lambda r: (r.schema_name or "", r.table_name, r.position))  # names only
    for row in rows:
        table = (row.schema_name, row.table_name)
        if table != current:
            current = table
            total = sum((r.schema_name, r.table_name) == table for r in rows)
            lines.append(f"{'.'.join(p for p in table if p)}: {total} columns")
        kind = f"{row.data_type} {row.collation}" if row.collation and row.collation not in row.data_type else row.data_type
        lines.append(f"  {row.column_name} {kind}" + ("" if row.nullable else " NOT NULL"))
    return "\n".join(lines)
