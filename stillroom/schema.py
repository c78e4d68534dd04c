"""Declared schemas: type names, header files, NOT NULL checks and column alignment."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stillroom import files
from stillroom.functions.expressions import quote_column
from stillroom.functions.geo import GEOGRAPHY, is_geography, wkt_to_geo

# A calendar interval cannot be stored in Parquet, so its two independent parts are kept side by side.
INTERVAL = T.StructType(
    [
        T.StructField("months", T.YearMonthIntervalType()),
        T.StructField("time", T.DayTimeIntervalType()),
    ]
)

# Type names a declared table or header file may use.
TYPES = {
    "text": T.StringType(),
    "string": T.StringType(),
    "varchar": T.StringType(),
    "small_int": T.ShortType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "big_int": T.LongType(),
    "bigint": T.LongType(),
    "int64": T.LongType(),
    "oid": T.LongType(),
    "double": T.DoubleType(),
    "double precision": T.DoubleType(),
    "bool": T.BooleanType(),
    "boolean": T.BooleanType(),
    "bytes": T.BinaryType(),
    "date": T.DateType(),
    "time": T.TimeType(),
    "timestamp": T.TimestampNTZType(),
    "timestamp_tz": T.TimestampType(),
    "interval": INTERVAL,
    "json": T.VariantType(),
    "geography": GEOGRAPHY,
}

DEFAULT_NUMERIC = (18, 9)


class TypeMappingError(ValueError):
    """A source type has no counterpart among the declared types."""


def data_type(text: str) -> T.DataType:
    """Spark type of a declared type name; ``numeric(p,s)`` and a trailing collation are understood."""
    name = text.strip()
    numeric = re.fullmatch(r"(?i)(?:numeric|decimal)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?", name)
    if numeric:
        precision, scale = numeric.groups()
        if precision is None:
            return T.DecimalType(*DEFAULT_NUMERIC)
        return T.DecimalType(int(precision), int(scale or 0))
    collated = re.fullmatch(r"(?i)(text|varchar|string)\s+(?:collate\s+)?([A-Za-z_]+)", name)
    if collated:
        return T.StringType(spark_collation(collated.group(2)))
    found = TYPES.get(name.lower())
    if found is None:
        raise TypeMappingError(f"unknown type {text!r}")
    return found


def spark_collation(name: str) -> str:
    """Collation names carry a three-letter country in Spark: ``en_US`` is ``en_USA``."""
    if name.upper() == "BINARY":
        return "UTF8_BINARY"
    # Two- and three-letter country codes of the common collations.
    countries = {"US": "USA", "GB": "GBR", "DE": "DEU", "FR": "FRA", "ES": "ESP", "IT": "ITA", "JP": "JPN", "CN": "CHN", "KR": "KOR", "BR": "BRA"}
    language, _, country = name.partition("_")
    return f"{language}_{countries.get(country.upper(), country)}" if country else name


def struct_from_types(columns: Iterable[tuple]) -> T.StructType:
    """Schema from ``(name, type text)`` or ``(name, type text, nullable)`` items."""
    fields = []
    for item in columns:
        name, type_text, *rest = item
        fields.append(T.StructField(name, data_type(type_text), rest[0] if rest else True))
    return T.StructType(fields)


def with_overrides(schema: T.StructType, overrides: Mapping[str, Mapping] | None) -> T.StructType:
    """Replace single column types by ``{column: {sqltype, precision, scale}}``; the argument is left as it is."""
    overrides = overrides or {}
    unknown = set(overrides) - set(schema.fieldNames())
    if unknown:
        raise TypeMappingError(f"override for columns that do not exist: {sorted(unknown)}")
    fields = []
    for field in schema.fields:
        wanted = overrides.get(field.name)
        fields.append(field if wanted is None else T.StructField(field.name, _override_type(field.name, wanted), field.nullable))
    return T.StructType(fields)


def _override_type(column: str, wanted: Mapping) -> T.DataType:
    extra = set(wanted) - {"sqltype", "precision", "scale"}
    if "sqltype" not in wanted or extra:
        raise TypeMappingError(f"invalid type override for column {column}: {dict(wanted)}")
    name = str(wanted["sqltype"])
    if name.lower() in ("numeric", "decimal"):
        precision, scale = wanted.get("precision"), wanted.get("scale", 0)
        return data_type("numeric" if precision is None else f"numeric({precision},{scale})")
    if "precision" in wanted or "scale" in wanted:
        raise TypeMappingError(f"type {name} of column {column} takes no precision")
    return data_type(name)


def schema_from_header(spark: SparkSession, path: str) -> T.StructType:
    """Schema from a two-line file: column names, then type names."""
    lines = list(csv.reader(io.StringIO(files.read_text(spark, path).lstrip("\ufeff"))))
    if len(lines) < 2 or len(lines[0]) != len(lines[1]):
        raise ValueError(f"{path} must hold one line of names and one line of as many types")
    return struct_from_types(zip(lines[0], lines[1]))


def enforce_not_null(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Raise when a column the schema declares NOT NULL holds a NULL; file tables do not check it themselves."""
    checked = []
    for field in schema.fields:
        column = F.col(quote_column(field.name))
        if not field.nullable:
            message = F.raise_error(F.lit(f"NULL in column {field.name}, which is declared NOT NULL"))
            column = F.when(column.isNotNull(), column).otherwise(message.cast(field.dataType))
        checked.append(column.alias(field.name, metadata=field.metadata) if field.metadata else column.alias(field.name))
    return df.select(checked)


def align(df: DataFrame, schema: T.StructType, allow_missing: bool = True) -> DataFrame:
    """Bring a frame to a schema by column name: cast, order, fill absent columns with NULL; surplus columns raise."""
    source = {field.name: field.dataType for field in df.schema.fields}
    surplus = sorted(set(source) - set(schema.fieldNames()))
    if surplus:
        raise ValueError(f"columns that the target does not have: {surplus}")
    columns = []
    for field in schema.fields:
        if field.name in source:
            columns.append(convert(F.col(quote_column(field.name)), source[field.name], field.dataType).alias(field.name))
        elif allow_missing:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            raise ValueError(f"column {field.name} is missing")
    return df.select(columns)


def convert(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast, with the text forms of geography, json, interval and bytes understood."""
    if source == target:
        return column
    if isinstance(source, T.StringType):
        if is_geography(target):
            return wkt_to_geo(column)
        if isinstance(target, T.VariantType):
            return F.parse_json(column)
        if target == INTERVAL:
            return parse_interval(column)
        if isinstance(target, T.BinaryType):
            hexed = column.startswith("\\x")
            return F.when(hexed, F.unhex(F.substring(column, 3, 2**31 - 1))).otherwise(column.cast("binary"))
        if not isinstance(target, T.StringType):
            return F.trim(column).cast(target)
    return column.cast(target)


def parse_interval(text: Column) -> Column:
    """Interval text such as ``1 year 2 days`` as its month part and its time part."""
    value = text.cast("interval")
    months = F.make_ym_interval(F.date_part(F.lit("YEARS"), value), F.date_part(F.lit("MONTHS"), value))
    time = F.make_dt_interval(
        F.date_part(F.lit("DAYS"), value),
        F.date_part(F.lit("HOURS"), value),
        F.date_part(F.lit("MINUTES"), value),
        F.date_part(F.lit("SECONDS"), value),
    )
    return F.when(text.isNotNull(), F.struct(months.alias("months"), time.alias("time")))


def ddl_name(target: T.DataType) -> str:
    """Type name that means the same under every session setting: plain ``timestamp`` does not."""
    return "timestamp_ltz" if isinstance(target, T.TimestampType) else target.simpleString()


def describe(schema: T.StructType) -> list[tuple[str, str, bool]]:
    """``(name, type, nullable)`` for each column, in order."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in schema.fields]


def escaped_token(null_token: str) -> str:
    """Pattern of the texts that a CSV export marks by a backslash: the null token, with backslashes before it or not."""
    return r"^\\*\Q" + null_token + r"\E$"
