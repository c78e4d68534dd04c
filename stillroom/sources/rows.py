"""Rows that start in Python: lists, pandas frames, fetch functions."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from stillroom import files
from stillroom.functions.expressions import quote_column
from stillroom.operators.tables import packed
from stillroom.schema import align, enforce_not_null
from stillroom.session import scratch_path

BATCH_ROWS = 100_000


def rows_to_df(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType) -> DataFrame:
    """Rows in memory as a frame of a declared schema; a NULL in a NOT NULL column raises here already."""
    return spark.createDataFrame(list(rows), schema, verifySchema=True)


def write_rows(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType, path: str, batch_rows: int = BATCH_ROWS) -> int:
    """Store an iterator of any length as a table and return the number of rows.

    Only one batch is in memory at a time, and the table appears when all batches are stored. For feeds that
    can be fetched in pieces use ``fetch_rows``, which runs on executors.
    """
    staged, total, source = scratch_path(spark, "rows"), 0, iter(rows)
    while True:
        batch = list(itertools.islice(source, batch_rows))
        if batch or not total:
            rows_to_df(spark, batch, schema).write.mode("append").parquet(staged)
            total += len(batch)
        if len(batch) < batch_rows:
            break
    packed(spark.read.schema(schema).parquet(staged), files.total_bytes(spark, staged)).write.parquet(path)
    return total


def pandas_to_df(spark: SparkSession, frame, schema: T.StructType | None = None) -> DataFrame:
    """A pandas frame as a Spark frame, moved as Arrow batches."""
    df = spark.createDataFrame(frame)
    return df if schema is None else enforce_not_null(align(df, schema, allow_missing=False), schema)


def insert_rows(spark: SparkSession, rows: Iterable[Sequence], input_schema: T.StructType, mappings: Sequence[str | tuple[str, str]], target_schema: T.StructType) -> DataFrame:
    """Rows whose target columns are computed by SQL expressions over the input columns."""
    return map_columns(rows_to_df(spark, rows, input_schema), mappings, target_schema)


def map_columns(df: DataFrame, mappings: Sequence[str | tuple[str, str]], target_schema: T.StructType) -> DataFrame:
    """Target columns from ``name`` (taken as is) or ``(name, SQL expression)``, in target order, NOT NULL checked."""
    named = {}
    for item in mappings:
        name, expression = (item, quote_column(item)) if isinstance(item, str) else item
        if name in named:
            raise ValueError(f"column {name} is mapped twice")
        named[name] = F.expr(expression).alias(name)
    mapped = df.select(list(named.values()))
    return enforce_not_null(align(mapped, target_schema), target_schema)


class _Slot(InputPartition):
    def __init__(self, value):
        self.value = value


def fetch_rows(spark: SparkSession, slots: Sequence, fetch: Callable[[object], Iterator[Sequence | pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """Rows of a feed that has no Spark reader. Each slot (a page, a day, a shard) is fetched by its own task.

    ``fetch`` runs on executors and must give the same rows when a lost task runs again. It yields rows, or Arrow
    record batches of the schema, which reach Spark without a Python object for each row.
    """

    feed_name = f"stillroom_feed_{uuid.uuid4().hex}"

    class Reader(DataSourceReader):
        def partitions(self):
            return [_Slot(slot) for slot in slots]

        def read(self, partition):
            for item in fetch(partition.value):
                yield item if isinstance(item, pa.RecordBatch) else tuple(item)

    class Feed(DataSource):
        @classmethod
        def name(cls):
            return feed_name

        def schema(self):
            return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])

        def reader(self, schema):
            return Reader()

    spark.dataSource.register(Feed)
    return enforce_not_null(spark.read.format(feed_name).load(), schema)


def load_result(spark: SparkSession, *, rows: Iterable[Sequence] | None = None, source: Mapping | None = None, schema: T.StructType | None = None) -> DataFrame:
    """A query result from exactly one of: rows in memory (which need a schema) or a JDBC request."""
    from stillroom.sources.jdbc import read_jdbc

    if (rows is None) == (source is None):
        raise ValueError("give either rows or a source")
    if rows is not None:
        if schema is None:
            raise ValueError("rows in memory need a schema")
        return rows_to_df(spark, rows, schema)
    df = read_jdbc(spark, **source)
    return df if schema is None else enforce_not_null(align(df, schema), schema)
