"""CSV and Parquet files as tables, in place."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stillroom.functions.expressions import epoch_to_utc, quote_column
from stillroom.schema import align, convert, ddl_name, enforce_not_null, escaped_token, schema_from_header

# Orders of the fields in a date.
DATE_STYLES = ("MDY", "DMY", "YMD", "YDM")

# A text no field holds, so that the reader itself never turns a field into NULL.
UNUSED_NULL = "\u0001<no such value>\u0001"


def load_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    *,
    sep: str = ",",
    header: bool = True,
    null_token: str = "NULL",
    date_style: str | None = None,
    date_format: str | None = None,
    timestamp_format: str | None = None,
    locale: str | None = None,
    path_column: str | None = None,
    name_filter: str | None = None,
    multi_line: bool = False,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read CSV files into a declared schema.

    Fields are read as text and converted by built-in expressions, because the reader's own null handling
    cannot tell an empty text from the null token. A field equal to ``null_token`` is NULL; an empty field
    is an empty text in a text column and NULL in any other. A text of the token behind backslashes loses one
    of them, as ``export_csv`` adds it. Malformed lines and values raise. ``multi_line`` admits quoted line breaks; large
    files are split all the same (``quoted_records``), but for quotes, escapes or encodings of other kinds in
    ``options``, with which a file is one task's work.

    ``paths`` may hold globs and may name a file twice, which yields its rows twice. ``path_column`` adds the
    path of the file each row came from.
    """
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    reader = (
        spark.read.schema(texts)
        .option("header", header)
        .option("sep", sep)
        .option("mode", "FAILFAST")
        .option("nullValue", UNUSED_NULL)
        .option("escape", '"')
        .option("multiLine", multi_line)
    )
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    for key, value in (options or {}).items():
        reader = reader.option(key, value)
    paths = [paths] if isinstance(paths, str) else list(paths)
    if multi_line and not {o.lower() for o in options or {}} - {"recursivefilelookup", "modifiedbefore", "modifiedafter"}:
        records = quoted_records(spark, paths, header=header, name_filter=name_filter, options=options)
        parsed = F.from_csv("record", ", ".join(f"{quote_column(f.name)} STRING" for f in schema.fields), {"sep": sep, "mode": "FAILFAST", "nullValue": UNUSED_NULL, "escape": '"'})
        raw, file_path = records.select(parsed.alias("__record"), "file"), F.col("file")
    else:
        raw, file_path = reader.csv(paths), F.col("_metadata.file_path")

    columns = []
    for field in schema.fields:
        text = F.col("__record")[field.name] if "__record" in raw.columns else F.col(quote_column(field.name))
        if isinstance(field.dataType, T.StringType):
            value = F.nullif(F.coalesce(text, F.lit("")), F.lit(null_token))
            value = F.when(F.rlike(value, F.lit(escaped_token(null_token))), F.substring(value, 2, 2**31 - 1)).otherwise(value)
            value = value if field.dataType == T.StringType() else value.cast(field.dataType)
        else:
            value = F.nullif(F.nullif(text, F.lit(null_token)), F.lit(""))
            value = _typed(value, field.dataType, date_style, date_format, timestamp_format, locale)
        columns.append(value.alias(field.name))
    if path_column:
        columns.append(file_path.alias(path_column))
    loaded = raw.select(columns)
    if all(field.nullable for field in schema.fields):
        return loaded
    extra = [T.StructField(path_column, T.StringType())] if path_column else []
    return enforce_not_null(loaded, T.StructType(schema.fields + extra))


def quoted_records(spark: SparkSession, paths: Sequence[str], *, header: bool = True, name_filter: str | None = None, options: Mapping[str, str] | None = None) -> DataFrame:
    """(file, record) of CSV files whose quoted fields may hold line breaks, read in splits of any size.

    A quote that is escaped is doubled, so a line begins inside a field if an odd number of quotes stands before it in the
    file. Each split counts the quotes of its lines, which tells its exit state for either state of entry; the states of
    the splits of a file are then combined in their order, and lines are counted on from the state of their split. A line
    that begins outside a field begins a record. Lines at the front of a split that belong to a record of an earlier one
    are sent to it; nothing else leaves its split. The first record of each file goes with ``header``; empty ones go
    always. Files whose first line ends with a carriage return have them at each line's end, and lose them.
    """
    reader = spark.read.option("lineSep", "\n")
    for key, value in {**(options or {}), **({"pathGlobFilter": name_filter} if name_filter else {})}.items():
        reader = reader.option(key, value)
    found = reader.schema("line string")
    lines = found.text([*dict.fromkeys(paths)]).select("line", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    lines = lines.withColumns({"at": F.monotonically_increasing_id(), "quotes": F.char_length("line") - F.char_length(F.replace("line", F.lit('"'), F.lit("")))})

    in_split, upto = Window.partitionBy("file", "block").orderBy("at"), (Window.unboundedPreceding, -1)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(*upto)
    splits = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"), F.min_by("line", "at").alias("first"))
    returns = F.first("first").over(Window.partitionBy("file").orderBy("block")).endswith("\r")
    splits = splits.select("file", "block", F.coalesce(F.sum("quotes").over(before) % 2, F.lit(0)).alias("entry"), returns.alias("returns"))

    inside = (F.coalesce(F.sum("quotes").over(in_split.rowsBetween(*upto)), F.lit(0)) + F.col("entry")) % 2 == 1
    told = lines.join(splits, ["file", "block"]).withColumn("inside", inside)
    told = told.withColumn("record", F.sum(F.when(F.col("inside"), 0).otherwise(1)).over(in_split.rowsBetween(Window.unboundedPreceding, 0)))
    line = F.struct("block", "at", "line").alias("line")
    own = told.filter("record > 0").groupBy("file", "block", "record").agg(F.sort_array(F.collect_list(line)).alias("lines"), F.first("returns").alias("returns"))
    # The front of a split carries on the last record that any split before it has begun.
    fronts = told.filter("record = 0").groupBy("file", "block").agg(F.sort_array(F.collect_list(line)).alias("front"))
    last = told.groupBy("file", "block").agg(F.max("record").alias("record"))
    begun = F.last(F.when(F.col("record") > 0, F.struct("block", "record")), ignorenulls=True).over(before)
    carried = last.select("file", "block", begun.alias("of")).join(fronts, ["file", "block"])
    carried = carried.groupBy("file", F.col("of.block").alias("block"), F.col("of.record").alias("record")).agg(F.flatten(F.sort_array(F.collect_list("front"))).alias("front"))
    whole = own.join(carried, ["file", "block", "record"], "left")
    texts = F.transform(F.concat("lines", F.coalesce("front", F.array().cast("array<struct<block:bigint,at:bigint,line:string>>"))), lambda x: F.when(F.col("returns"), F.regexp_replace(x["line"], "\r$", "")).otherwise(x["line"]))
    records = whole.select("file", "block", "record", F.array_join(texts, "\n").alias("text"))
    if header:
        first = (F.col("block") == 0) & (F.col("record") == 1)
        records = records.filter(~first)
    records = records.filter("text <> ''")
    times = {p: list(paths).count(p) for p in paths}
    if max(times.values()) > 1:  # a path that is listed again is read again
        records = reduce(DataFrame.unionByName, [records, *(quoted_records(spark, [p], header=header, name_filter=name_filter, options=options).withColumnRenamed("record", "text").select("file", F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("record"), "text") for p, n in times.items() for _ in range(n - 1))])
    return records.select("file", F.col("text").alias("record"))


def _typed(text, target, date_style, date_format, timestamp_format, locale) -> Column:
    if isinstance(target, T.DateType) and (date_style or date_format):
        return _date(text, date_style, date_format, locale)
    if isinstance(target, (T.TimestampNTZType, T.TimestampType)) and timestamp_format:
        if locale:
            # Only the zoned parser takes a locale: read the text as UTC, then drop the zone where none is declared.
            zoned = _localised(text, T.TimestampType(), "timestampFormat", timestamp_format, locale)
            return zoned if isinstance(target, T.TimestampType) else epoch_to_utc(F.unix_micros(zoned).cast("decimal(20,0)") / 1_000_000)
        name = "to_timestamp_ntz" if isinstance(target, T.TimestampNTZType) else "to_timestamp_ltz"
        return F.call_function(name, text, F.lit(timestamp_format))
    return convert(text, T.StringType(), target)


def _date(text: Column, style: str | None, pattern: str | None, locale: str | None) -> Column:
    if pattern:
        if locale:
            return _localised(text, T.DateType(), "dateFormat", pattern, locale)
        return F.to_date(text, pattern)
    if style.upper() not in DATE_STYLES:
        raise ValueError(f"date style must be one of {sorted(DATE_STYLES)}, not {style!r}")
    # Any of the usual separators; a leading four-digit year reads as ISO unless the style says year-day-month.
    parts = F.split(F.trim(text), r"[-./ ]+")
    place = {letter.lower(): k for k, letter in enumerate(style.upper())}

    def number(letter: str) -> Column:
        own = parts[place[letter]]
        iso = "ymd".index(letter)
        chosen = own if style.upper() in ("YMD", "YDM") else F.when(F.length(parts[0]) == 4, parts[iso]).otherwise(own)
        return chosen.cast("int")

    whole = F.when(F.size(parts) == 3, F.make_date(number("y"), number("m"), number("d"))).otherwise(F.raise_error(F.concat(F.lit("not a date: "), text)).cast("date"))
    return F.when(text.isNotNull(), whole)


def _localised(text: Column, target: T.DataType, option: str, pattern: str, locale: str) -> Column:
    """Dates with month or day names of a language: the one built-in parser that takes a locale is the CSV one."""
    parsed = F.from_csv(
        text,
        f"v {ddl_name(target)}",
        {option: pattern, "locale": locale.replace("_", "-"), "timeZone": "UTC", "sep": "\u0001", "mode": "FAILFAST"},
    )
    return F.when(text.isNotNull(), parsed["v"])


def load_csv_with_header_file(spark: SparkSession, data_glob: str, header_path: str, *, header: bool = False, path_column: str = "File Path", **options) -> DataFrame:
    """All files that match a pattern, typed by a two-line header file, each row tagged with its file."""
    return load_csv(spark, data_glob, schema_from_header(spark, header_path), header=header, path_column=path_column, **options)


def load_parquet(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None, *, name_filter: str | None = None) -> DataFrame:
    """Read Parquet files; with a schema, columns are taken by name, cast and checked, else the files' own is used.

    Files may have different columns: the result has all of them, NULL where a file has none.
    """
    reader = spark.read.option("mergeSchema", True)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    df = reader.parquet(*([paths] if isinstance(paths, str) else list(paths)))
    if schema is None:
        return df
    missing = [name for name in schema.fieldNames() if name not in df.columns]
    if missing:
        raise ValueError(f"columns that the files do not have: {missing}")
    typed = align(df.select([F.col(quote_column(n)) for n in schema.fieldNames()]), schema)
    return typed if all(f.nullable for f in schema.fields) else enforce_not_null(typed, schema)


def union_by_position(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet files one below the other by the position of their columns, named as in the first; a file that is listed
    twice is read twice."""
    return reduce(DataFrame.union, (spark.read.parquet(p) for p in paths))


def external_table(spark: SparkSession, name: str, paths: str | Sequence[str], *, format: str = "parquet", schema: T.StructType | None = None, **options) -> DataFrame:
    """Name files as a temporary table of this session."""
    if format == "csv":
        if schema is None:
            raise ValueError("a CSV table needs its columns declared")
        df = load_csv(spark, paths, schema, **options)
    elif format == "parquet":
        df = load_parquet(spark, paths, schema, **options)
    else:
        raise ValueError(f"unsupported format {format!r}")
    df.createOrReplaceTempView(name)
    return df


def attach(spark: SparkSession, root: str, alias: str) -> list[str]:
    """Make every table below a directory readable as ``<alias>_<table>``; returns the view names."""
    from stillroom.operators.tables import tables_below
    from stillroom.operators.versions import read_table

    names = []
    for table, path in sorted(tables_below(spark, root).items()):
        view = f"{alias}_{table.replace('.', '_')}"
        read_table(spark, path).createOrReplaceTempView(view)
        names.append(view)
    return names


def detach(spark: SparkSession, views: Sequence[str]) -> None:
    for view in views:
        spark.catalog.dropTempView(view)


def object_store_options(
    uri: str,
    *,
    access_key: str | None = None,
    secret_key: str | None = None,
    region: str | None = None,
    endpoint: str | None = None,
) -> tuple[str, dict[str, str]]:
    """Path and per-bucket Hadoop options for an S3-style location; without keys access is anonymous."""
    scheme, _, rest = uri.partition("://")
    if scheme not in ("s3", "s3a") or not rest:
        raise ValueError(f"not an object-store location: {uri!r}")
    if bool(access_key) != bool(secret_key):
        raise ValueError("give both keys or neither")
    bucket = rest.split("/", 1)[0]
    prefix = f"fs.s3a.bucket.{bucket}"
    options = {}
    if access_key:
        options[f"{prefix}.access.key"] = access_key
        options[f"{prefix}.secret.key"] = secret_key
    else:
        options[f"{prefix}.aws.credentials.provider"] = "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider"
    if region:
        options[f"{prefix}.endpoint.region"] = region
    if endpoint:
        options[f"{prefix}.endpoint"] = endpoint
        options[f"{prefix}.path.style.access"] = "true"
    return f"s3a://{rest}", options


def use_object_store(spark: SparkSession, uri: str, **credentials) -> str:
    """Set the options of ``object_store_options`` on this session's file system layer and return the path to read."""
    path, options = object_store_options(uri, **credentials)
    for key, value in options.items():
        spark._jsc.hadoopConfiguration().set(key, value)
    return path
