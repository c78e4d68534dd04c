"""Relational sources over Spark's JDBC reader."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stillroom.functions.expressions import checked_identifier, quote_name
from stillroom.schema import DEFAULT_NUMERIC, TypeMappingError, ddl_name, with_overrides

FETCH_SIZE = 10_000


@dataclass(frozen=True)
class Dialect:
    """What differs between databases: address, driver class, identifier quotes."""

    url: str
    driver: str
    default_port: int | None
    quote: str
    end_quote: str | None = None
    modulo: str = "MOD({column}, {n})"


# Address forms and driver classes of the public JDBC drivers.
DIALECTS = {
    "postgres": Dialect("jdbc:postgresql://{host}:{port}/{database}", "org.postgresql.Driver", 5432, '"'),
    "redshift": Dialect("jdbc:redshift://{host}:{port}/{database}", "com.amazon.redshift.jdbc42.Driver", 5439, '"'),
    "mysql": Dialect("jdbc:mysql://{host}:{port}/{database}", "com.mysql.cj.jdbc.Driver", 3306, "`"),
    "azuresql": Dialect(
        "jdbc:sqlserver://{host}:{port};databaseName={database}",
        "com.microsoft.sqlserver.jdbc.SQLServerDriver",
        1433,
        "[",
        "]",
        "({column} % {n})",
    ),
    "bigquery": Dialect(
        "jdbc:bigquery://https://www.googleapis.com/bigquery/v2:443;ProjectId={database}",
        "com.google.cloud.bigquery.jdbc.BigQueryDriver",
        None,
        "`",
    ),
}

# Type names each source reports and the declared type they load as. Where the reporting
# library names types by code, the code is used.
SOURCE_TYPES = {
    "bigquery": {
        "BOOL": T.BooleanType(),
        "BOOLEAN": T.BooleanType(),
        "BYTES": T.BinaryType(),
        "DATE": T.DateType(),
        "DATETIME": T.TimestampNTZType(),
        "INT64": T.LongType(),
        "INTEGER": T.LongType(),
        "NUMERIC": T.DecimalType(*DEFAULT_NUMERIC),
        "FLOAT64": T.DoubleType(),
        "FLOAT": T.DoubleType(),
        "STRING": T.StringType(),
        "TIME": T.TimeType(),
        "TIMESTAMP": T.TimestampType(),
    },
    "mysql": {
        "TINY": T.BooleanType(),
        "SHORT": T.ShortType(),
        "INT24": T.LongType(),
        "INTEGER": T.IntegerType(),
        "LONG": T.IntegerType(),
        "LONGLONG": T.LongType(),
        "DECIMAL": T.DecimalType(*DEFAULT_NUMERIC),
        "NEWDECIMAL": T.DecimalType(*DEFAULT_NUMERIC),
        "FLOAT": T.DoubleType(),
        "DOUBLE": T.DoubleType(),
        "VAR_STRING": T.StringType(),
        "STRING": T.StringType(),
        "BLOB": T.BinaryType(),
        "DATE": T.DateType(),
        "TIME": T.TimeType(),
        "DATETIME": T.TimestampNTZType(),
        "TIMESTAMP": T.TimestampType(),
    },
    "postgres": {
        16: T.BooleanType(),
        17: T.BinaryType(),
        20: T.LongType(),
        21: T.IntegerType(),
        23: T.IntegerType(),
        25: T.StringType(),
        701: T.DoubleType(),
        1043: T.StringType(),
        1082: T.DateType(),
        1083: T.TimeType(),
        1114: T.TimestampNTZType(),
        1184: T.TimestampType(),
        1700: T.DecimalType(*DEFAULT_NUMERIC),
    },
    "azuresql": {
        "str": T.StringType(),
        "unicode": T.StringType(),
        "bytearray": T.BinaryType(),
        "bool": T.BooleanType(),
        "int": T.IntegerType(),
        "long": T.LongType(),
        "float": T.DoubleType(),
        "date": T.DateType(),
        "time": T.TimeType(),
        "datetime": T.TimestampType(),
    },
}
SOURCE_TYPES["redshift"] = SOURCE_TYPES["postgres"]


@dataclass(frozen=True)
class SourceColumn:
    """One column as a source describes it."""

    name: str
    type_code: object
    nullable: bool = True
    precision: int | None = None
    scale: int | None = None
    repeated: bool = False


def source_schema(dialect: str, columns: Iterable[SourceColumn], overrides: Mapping[str, Mapping] | None = None) -> T.StructType:
    """Declared schema for a described source; an unknown type raises unless the column is overridden."""
    known = SOURCE_TYPES[_dialect_name(dialect)]
    overrides = overrides or {}
    fields = []
    for column in columns:
        if column.repeated:
            raise TypeMappingError(f"repeated column {column.name} has no declared type")
        code = column.type_code.__name__ if isinstance(column.type_code, type) else column.type_code
        if code == "Decimal":
            found = T.DecimalType(column.precision or DEFAULT_NUMERIC[0], DEFAULT_NUMERIC[1] if column.scale is None else column.scale)
        else:
            found = known.get(code)
        if found is None and column.name not in overrides:
            raise TypeMappingError(f"no type for {dialect} source type {code!r} of column {column.name}")
        fields.append(T.StructField(column.name, found or T.StringType(), column.nullable))
    return with_overrides(T.StructType(fields), overrides)


def _dialect_name(dialect: str) -> str:
    if dialect not in DIALECTS:
        raise ValueError(f"dialect must be one of {sorted(DIALECTS)}, not {dialect!r}")
    return dialect


def connection_options(dialect: str, connection: Mapping[str, str], fetch_size: int = FETCH_SIZE) -> dict[str, str]:
    """Reader options for a connection; the caller supplies secrets, nothing is looked up here.

    ``connection`` holds host, port, database, user and password, or a complete ``url``; further entries go
    to the driver as they are.
    """
    spec = DIALECTS[_dialect_name(dialect)]
    given = dict(connection)
    url = given.pop("url", None)
    host, port, database = given.pop("host", ""), given.pop("port", spec.default_port), given.pop("database", "")
    if url is None:
        if not database or ("{host}" in spec.url and not host):
            raise ValueError("a connection needs a host and a database, or a url")
        url = spec.url.format(host=host, port=port, database=database)
    options = {"url": url, "driver": given.pop("driver", spec.driver), "fetchsize": str(fetch_size)}
    if dialect == "mysql":
        # This driver only fetches in batches when asked to use a cursor.
        options["useCursorFetch"] = "true"
    options.update({key: str(value) for key, value in given.items()})
    return options


@dataclass(frozen=True)
class RangePartitions:
    """Parallel read by value ranges of a numeric, date or timestamp column."""

    column: str
    lower: object
    upper: object
    count: int


@dataclass(frozen=True)
class HashPartitions:
    """Parallel read by remainder of an integer column: even when its values crowd in one range."""

    column: str
    count: int


def hash_predicates(dialect: str, partitions: HashPartitions) -> list[str]:
    """One predicate per task; together they cover every row once, NULLs with the first task."""
    spec = DIALECTS[_dialect_name(dialect)]
    column = quote_name(partitions.column, spec.quote, spec.end_quote)
    rest = f"ABS({spec.modulo.format(column=column, n=partitions.count)})"
    return [f"{rest} = {i}" + (f" OR {column} IS NULL" if i == 0 else "") for i in range(partitions.count)]


def custom_schema(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {ddl_name(f.dataType)}" for f in schema.fields)


def jdbc_options(
    dialect: str,
    connection: Mapping[str, str],
    *,
    table: str | None = None,
    query: str | None = None,
    partition: RangePartitions | HashPartitions | None = None,
    overrides: Mapping[str, Mapping] | None = None,
    fetch_size: int = FETCH_SIZE,
) -> dict[str, str]:
    """All reader options of ``read_jdbc``."""
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    spec = DIALECTS[_dialect_name(dialect)]
    options = connection_options(dialect, connection, fetch_size)
    if table is not None:
        options["dbtable"] = quote_name(table, spec.quote, spec.end_quote)
    elif partition is None:
        options["query"] = query
    else:
        # A partitioned read takes its source through dbtable only.
        options["dbtable"] = f"({query}) q"
    if isinstance(partition, RangePartitions):
        options.update(
            partitionColumn=checked_identifier(partition.column),
            lowerBound=str(partition.lower),
            upperBound=str(partition.upper),
            numPartitions=str(partition.count),
        )
    if overrides:
        named = T.StructType([T.StructField(name, T.StringType()) for name in overrides])
        options["customSchema"] = custom_schema(with_overrides(named, overrides))
    return options


def read_jdbc(spark: SparkSession, dialect: str, connection: Mapping[str, str], **request) -> DataFrame:
    """A table or query of a database as a frame; see ``jdbc_options`` for the arguments.

    Filters and column choices push down to the database. Give ``partition`` for anything large: without it
    one task reads everything.
    """
    options = jdbc_options(dialect, connection, **request)
    partition = request.get("partition")
    if isinstance(partition, HashPartitions):
        url, source = options.pop("url"), options.pop("dbtable")
        return spark.read.jdbc(url, source, predicates=hash_predicates(dialect, partition), properties=options)
    return spark.read.format("jdbc").options(**options).load()


def bounds(spark: SparkSession, dialect: str, connection: Mapping[str, str], table: str, column: str, count: int) -> RangePartitions:
    """Range partitions from the column's own extremes; the database computes both, one row comes back."""
    spec = DIALECTS[_dialect_name(dialect)]
    name = quote_name(column, spec.quote, spec.end_quote)
    query = f"SELECT MIN({name}) AS low, MAX({name}) AS high FROM {quote_name(table, spec.quote, spec.end_quote)}"
    low, high = read_jdbc(spark, dialect, connection, query=query).first()
    if low is None:
        raise ValueError(f"{table} holds no value of {column} to partition by")
    return RangePartitions(column, low, high, count)


def window_predicate(column: str, cutoff: str, dialect: str) -> str:
    """Predicate that re-reads a rolling window: everything on or after a date."""
    spec = DIALECTS[_dialect_name(dialect)]
    if not all(part.isdigit() for part in cutoff.split("-")) or len(cutoff.split("-")) != 3:
        raise ValueError(f"cutoff must be a date like 2024-01-31, not {cutoff!r}")
    return f"{quote_name(column, spec.quote, spec.end_quote)} >= '{cutoff}'"


def staged_parts(spark: SparkSession, parts_glob: str, schema: T.StructType, **options) -> DataFrame:
    """Headerless, usually compressed, CSV parts that a database exported to a staging folder, read in parallel."""
    from stillroom.sources.files import load_csv

    return load_csv(spark, parts_glob, schema, header=False, **options)


def columns_from_description(description: Sequence[Sequence]) -> list[SourceColumn]:
    """Columns of a DB-API cursor description: name, type code, …, precision, scale, null-ok."""
    return [SourceColumn(d[0], d[1], d[6] is None or bool(d[6]), d[4], d[5]) for d in description]
