"""Writing and copying tables: save modes, staged replacement, compaction, export."""

from __future__ import annotations

import json
import math
import re
import time
import uuid
from bisect import bisect_left, insort
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stillroom import files
from stillroom.functions.expressions import quote_column, quote_name
from stillroom.functions.geo import geo_to_wkt, is_geography
from stillroom.schema import align, enforce_not_null, escaped_token

FILE_BYTES = 128 * 1024**2
PARTS_PER_OUTPUT = 5
TABLES_AT_A_TIME = 4
#: Output files of one job of a dense rewrite.
BINS_A_JOB = 64
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

MODES = ("create", "create_if_missing", "replace", "append")


def write_table(df: DataFrame, path: str, mode: str = "create", *, schema: T.StructType | None = None, partition_by: Sequence[str] | None = None) -> int:
    """Write a frame as the table at ``path`` and return the number of rows written.

    create: error when it exists. create_if_missing: leave an existing one alone. replace: stage beside it,
    then swap, so the frame may read the very table it replaces. append: align by name to what is there.
    An existing table keeps its partition columns; other ones given for it are an error.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    spark = df.sparkSession
    recover(spark, path)
    if schema is not None:
        df = enforce_not_null(align(df, schema), schema)
    if mode in ("replace", "append"):
        partition_by = _layout(spark, path, partition_by)
    if mode == "replace":
        staged = _beside(path, "staged")
        rows = _write(df, staged, partition_by)
        swap_in(spark, staged, path)
        return rows
    if mode == "append":
        return _write(align(df, spark.read.parquet(path).schema), path, partition_by, "append")
    if mode == "create_if_missing" and files.exists(spark, path):
        return 0
    return _write(df, path, partition_by)


def _write(df: DataFrame, path: str, partition_by: Sequence[str] | None, mode: str = "errorifexists") -> int:
    """The rows are counted in the stage that writes them."""
    counted = Observation()
    if partition_by:
        # Few files per partition value, and a value that holds much data still spreads over several tasks.
        df = df.hint("rebalance", *[F.col(quote_column(c)) for c in partition_by])
    writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return counted.get["rows"]


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns whose values name the folders of a table, outermost first."""
    columns, folder = [], path
    while inner := [e for e in files.entries(spark, folder) if e.is_dir and "=" in e.name and not e.name.startswith((".", "_"))]:
        columns.append(unquote(inner[0].name.partition("=")[0]))
        folder = inner[0].path
    return columns


def _layout(spark: SparkSession, path: str, partition_by: Sequence[str] | None) -> Sequence[str] | None:
    """Partition columns for a write to ``path``: those the table has, else the given ones."""
    if not any(not e.name.startswith(("_", ".")) for e in files.entries(spark, path)):
        return partition_by
    present = partition_columns(spark, path)
    if partition_by is not None and list(partition_by) != present:
        raise ValueError(f"{path} is partitioned by {present}, not by {list(partition_by)}")
    return present


def _parts(path: str) -> tuple[str, str]:
    parent, _, name = path.rstrip("/").rpartition("/")
    return parent, name


def _beside(path: str, label: str) -> str:
    parent, name = _parts(path)
    return f"{parent}/.{name}.{label}-{uuid.uuid4().hex}"


def _journal(path: str) -> str:
    parent, name = _parts(path)
    return f"{parent}/.{name}.journal"


def _replace(spark: SparkSession, path: str, moves: Sequence[Mapping[str, str | None]], leftovers: Sequence[str]) -> None:
    """Let staged folders take the place of live ones. The journal is the point of no return: it is written under its
    name by one rename, and whatever breaks off afterwards is finished by the next call of ``recover``."""
    draft = f"{_journal(path)}-{uuid.uuid4().hex}"
    files.write_text(spark, draft, json.dumps({"moves": list(moves), "leftovers": list(leftovers)}))
    files.rename(spark, draft, _journal(path))
    recover(spark, path)


def recover(spark: SparkSession, path: str) -> bool:
    """Finish a replacement of the table or of its partitions that broke off; True when there was one.

    Every function here that changes a table calls it first. A move: ``staged`` (None to remove only) becomes ``live``,
    what was there becomes ``old``. One that was made already has no staged folder left.
    """
    journal = _journal(path)
    if not files.exists(spark, journal):
        return False
    plan = json.loads(files.read_text(spark, journal))
    for move in plan["moves"]:
        staged, live, old = move["staged"], move["live"], move["old"]
        if staged is not None and not files.exists(spark, staged):
            continue
        if files.exists(spark, live):
            files.rename(spark, live, old)
        if staged is not None:
            files.rename(spark, staged, live)
    for leftover in plan["leftovers"]:
        files.remove(spark, leftover)
    files.remove(spark, journal)
    spark.catalog.refreshByPath(path)
    return True


def swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """Put a finished staging folder in the place of a table."""
    old = _beside(path, "old")
    _replace(spark, path, [{"staged": staged, "live": path, "old": old}], [old])


def _ledger(path: str, token: str) -> str:
    """The mark of an applied request or batch; beside the table, so that replacing the table forgets none."""
    if not re.fullmatch(r"[\w-]+", token):
        raise ValueError(f"request id with characters that are not allowed: {token!r}")
    parent, name = _parts(path)
    return f"{parent}/.{name}.applied/{token}"


def append_batch(df: DataFrame, path: str, token: str) -> bool:
    """Append rows under a token that names them; False when they were applied before.

    The table may be new, and may have been written and appended to by any other function here. The rows are staged
    beside the table; then their files move in under names that begin with the token, and a mark is left. A call that
    broke off is repeated from the start: files it left under the token are removed before the new ones move in.
    """
    spark, mark = df.sparkSession, _ledger(path, token)
    recover(spark, path)
    if files.exists(spark, mark):
        return False
    there = any(not e.name.startswith(("_", ".")) for e in files.entries(spark, path))
    partition_by = partition_columns(spark, path) if there else None
    rows = align(df, spark.read.parquet(path).schema) if there else df
    staged = _beside(path, "batch")
    _write(rows, staged, partition_by)
    found = {e.path: e.path[e.path.index(_parts(staged)[1]) + len(_parts(staged)[1]) :].strip("/") for e in files.walk(spark, staged) if not e.name.startswith(("_", "."))}
    for folder in sorted({name.rpartition("/")[0] for name in found.values()}):
        for e in files.entries(spark, f"{path}/{folder}".rstrip("/")):
            if e.name.startswith(f"{token}."):
                files.remove(spark, e.path)
    for k, (source, name) in enumerate(sorted(found.items())):
        folder = name.rpartition("/")[0]
        files.rename(spark, source, f"{path}/{folder}/{token}.{k:06d}.parquet" if folder else f"{path}/{token}.{k:06d}.parquet")
    files.write_text(spark, mark, "")
    files.remove(spark, staged)
    spark.catalog.refreshByPath(path)
    return True


def create_table(spark: SparkSession, path: str, schema: T.StructType, mode: str = "create") -> None:
    """An empty table of a definition."""
    write_table(spark.createDataFrame([], schema), path, mode)


def drop_table(spark: SparkSession, path: str, if_exists: bool = False) -> None:
    recover(spark, path)
    if not files.exists(spark, path):
        if if_exists:
            return
        raise FileNotFoundError(path)
    files.remove(spark, path)
    parent, name = _parts(path)
    files.remove(spark, f"{parent}/.{name}.applied")


def create_catalog_table(spark: SparkSession, name: str, schema: T.StructType, path: str) -> None:
    """A table of the session catalog over a given folder; its database is created when missing."""
    database = name.rpartition(".")[0]
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote_name(database, max_length=None)}")
    spark.catalog.createTable(quote_name(name, max_length=None), source="parquet", schema=schema, path=path)


def create_table_as(df: DataFrame, name: str, path: str, mode: str = "errorifexists") -> DataFrame:
    """``CREATE TABLE … AS SELECT`` over a given folder; returns the table."""
    df.write.format("parquet").mode(mode).option("path", path).saveAsTable(quote_name(name, max_length=None))
    return df.sparkSession.table(quote_name(name, max_length=None))


def insert_into(df: DataFrame, name: str) -> int:
    """``INSERT INTO name SELECT …`` by column name; returns the number of rows, counted in the stage that writes them."""
    target, counted = df.sparkSession.table(quote_name(name, max_length=None)), Observation()
    rows = align(df, target.schema).observe(counted, F.count(F.lit(1)).alias("rows"))
    rows.write.insertInto(quote_name(name, max_length=None))
    return counted.get["rows"]


def publish(df: DataFrame, path: str, mode: str) -> None:
    """Publish modes: create-new raises when the table exists, overwrite and append do as they say."""
    modes = {"create-new": "create", "overwrite": "replace", "append": "append"}
    if mode not in modes:
        raise ValueError(f"publish mode must be one of {sorted(modes)}, not {mode!r}")
    write_table(df, path, modes[mode])


def append_once(df: DataFrame, path: str, request_id: str) -> bool:
    """Append under a request id, kept as the column ``request_id``; False when that request was applied before.

    The table may be new, or have rows from before the first request, partitioned or not: a table without the column
    gets it, NULL in these rows. Rows are aligned by name to those that are there.
    """
    spark = df.sparkSession
    recover(spark, path)
    if files.exists(spark, _ledger(path, request_id)):
        return False
    named = df.withColumn("request_id", F.lit(request_id))
    if any(not e.name.startswith(("_", ".")) for e in files.entries(spark, path)):
        present = spark.read.option("mergeSchema", True).parquet(path)
        if "request_id" not in present.columns:
            write_table(present.withColumn("request_id", F.lit(None).cast("string")), path, "replace")
    return append_batch(named, path, request_id)


def refresh(df: DataFrame, path: str) -> bool:
    """Create the table on the first run, append afterwards; True when it was created."""
    recover(df.sparkSession, path)
    first = not files.exists(df.sparkSession, path)
    write_table(df, path, "create" if first else "append")
    return first


def refresh_window(df: DataFrame, path: str, date_column: str, cutoff: str, until: str | None = None) -> None:
    """Rolling-window refresh of a table partitioned by date: only partitions of the window are touched.

    The window's partitions, from ``cutoff`` up to but without ``until``, are replaced by the frame's rows of these
    days; those that receive no rows are dropped.
    """
    day = F.col(quote_column(date_column))
    window = df.filter(day >= F.lit(cutoff).cast("date"))
    if until is not None:
        window = window.filter(day < F.lit(until).cast("date"))
    _replace_partitions(window, path, date_column, lambda value: value is not None and value >= cutoff and (until is None or value < until))


def rewrite_partitions(spark: SparkSession, path: str, column: str, values: Sequence[str | None], change: Callable[[DataFrame], DataFrame]) -> None:
    """Apply a change to some partitions of a table and leave the files of all others alone.

    ``change`` gets the rows of those partitions, for instance to upsert into them. A row it returns for any
    other partition is an error, and nothing is replaced. None names the partition of NULL.
    """
    recover(spark, path)
    wanted = {None if v is None else str(v) for v in values}
    folders = [e.path for e in files.entries(spark, path) if e.is_dir and _value_of(e.name, column) in wanted and e.name.startswith(f"{column}=")]
    schema = spark.read.parquet(path).schema
    current = spark.read.schema(schema).option("basePath", path).parquet(*folders) if folders else spark.createDataFrame([], schema)
    _replace_partitions(change(current), path, column, lambda value: value in wanted)


def _value_of(folder: str, column: str) -> str | None:
    """The partition value that a folder's name stands for."""
    value = folder[len(column) + 1 :]
    return None if value == NULL_PARTITION else unquote(value)


def _replace_partitions(df: DataFrame, path: str, column: str, covered: Callable[[str | None], bool]) -> None:
    """Write a frame beside a partitioned table, then let its partitions take the place of all covered ones."""
    spark, prefix, staged = df.sparkSession, f"{column}=", _beside(path, "partitions")
    recover(spark, path)
    _write(df, staged, [column])

    def partitions(root: str) -> set[str]:
        return {e.name for e in files.entries(spark, root) if e.is_dir and e.name.startswith(prefix)}

    fresh = partitions(staged)
    outside = sorted(name for name in fresh if not covered(_value_of(name, column)))
    if outside:
        files.remove(spark, staged)
        raise ValueError(f"rows for partitions that are not to change: {outside[:5]}")
    old = _beside(path, "old")
    moves = [
        {"staged": f"{staged}/{name}" if name in fresh else None, "live": f"{path}/{name}", "old": f"{old}/{name}"}
        for name in sorted(partitions(path) | fresh)
        if covered(_value_of(name, column))
    ]
    _replace(spark, path, moves, [old, staged])


def write_tables(frames: Mapping[str, DataFrame], root: str, mode: str = "create", schemas: Mapping[str, T.StructType] | None = None) -> None:
    """One write per table, for instance of a star schema."""
    schemas = schemas or {}
    unknown = sorted(set(schemas) - set(frames))
    if unknown:
        raise ValueError(f"definitions without data: {unknown}")
    for name, df in frames.items():
        write_table(df, f"{root.rstrip('/')}/{name}", mode, schema=schemas.get(name))


def tables_below(spark: SparkSession, root: str) -> dict[str, str]:
    """Tables below a directory root, by name, with their paths.

    A Parquet file is a table, and so is a folder that is named like one, holds files or has partitions. Any other
    folder is a schema: its own tables are named after it. ``.parquet`` is no part of a name.
    """

    def is_table(entry: files.Entry) -> bool:
        if entry.name.endswith(".parquet") or not entry.is_dir:
            return entry.name.endswith(".parquet")
        if files.exists(spark, f"{entry.path}/_versions"):
            return True
        inside = _visible(spark, entry.path)
        # Files of their own make a table, whatever wrote them; a schema's files are named as its tables are.
        return any("=" in e.name if e.is_dir else _WRITTEN.match(e.name) for e in inside)

    def name_of(entry: files.Entry) -> str:
        return entry.name.removesuffix(".parquet")

    found = {}
    for entry in _visible(spark, root):
        if is_table(entry):
            found[name_of(entry)] = entry.path
        elif entry.is_dir:
            found |= {f"{entry.name}.{name_of(e)}": e.path for e in _visible(spark, entry.path) if is_table(e)}
    if not found:
        raise FileNotFoundError(f"no tables below {root}")
    return found


#: Names of files that writes and appended batches leave; a single-file table of a schema is named otherwise.
_WRITTEN = re.compile(r"part-|[\w-]+\.\d{6}\.parquet$")


def _visible(spark: SparkSession, path: str) -> list[files.Entry]:
    return [e for e in files.entries(spark, path) if not e.name.startswith((".", "_"))]


def table_names(spark: SparkSession, root: str) -> list[str]:
    """Names of the tables below a directory root."""
    return sorted(tables_below(spark, root))


def copy_tables(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    tables: Sequence[str] | None = None,
    transform_by_type: tuple[Callable[[T.DataType], bool], Callable[[Column], Column]] | None = None,
    file_bytes: int = FILE_BYTES,
    mode: str = "create",
) -> list[str]:
    """Copy the tables of one root to another, densely written; schemas and partition columns are kept.

    ``transform_by_type`` is a test on column types and a function for the columns that pass it; all others
    go through unchanged. The number of files follows from the input's bytes. Files are packed without a
    shuffle, except where they are dealt to partitions. Some tables are copied at a time. Of a versioned table the last
    version is copied, as a plain folder of files.
    """
    from stillroom.operators.versions import is_versioned, read_table

    below = tables_below(spark, source)

    def copy(name: str) -> str:
        path = below[name]
        df = read_table(spark, path)
        if transform_by_type is not None:
            df = map_columns_by_type(df, *transform_by_type)
        partition_by = [] if is_versioned(spark, path) else partition_columns(spark, path)
        rows = df if partition_by else packed(df, files.total_bytes(spark, path), file_bytes)
        write_table(rows, f"{target.rstrip('/')}/{name.replace('.', '/')}", mode, partition_by=partition_by or None)
        return name

    with ThreadPoolExecutor(TABLES_AT_A_TIME) as pool:
        return list(pool.map(copy, tables if tables is not None else sorted(below)))


def packed(df: DataFrame, input_bytes: int, file_bytes: int = FILE_BYTES) -> DataFrame:
    """At most one output file per ``file_bytes`` of input; larger inputs are split by the scan already."""
    return df.coalesce(max(1, math.ceil(input_bytes / file_bytes)))


def best_bins(sizes: Sequence[int], room: int) -> list[list[int]]:
    """Places of ``sizes`` in bins of ``room``: the largest first, each to the fullest bin that still holds it. A size
    beyond the room has a bin for itself."""
    bins: list[list[int]] = []
    left: list[tuple[int, int]] = []  # (room left, bin), in order
    for at in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        found = bisect_left(left, (sizes[at], -1))
        rest, number = left.pop(found) if found < len(left) else (room, len(bins))
        if number == len(bins):
            bins.append([])
        bins[number].append(at)
        if rest > sizes[at]:
            insort(left, (rest - sizes[at], number))
    return bins


def rewrite_dense(spark: SparkSession, source: str, target: str, file_bytes: int = FILE_BYTES) -> int:
    """Copy a plain table so that its files come near ``file_bytes``, whatever sizes it has, and return their number.

    Files of a partition are packed into bins by their sizes, and each bin is one task that reads its files and writes
    one; larger files are cut at their row groups into equal parts. Nothing is shuffled. Only names and sizes pass the
    driver, and the table appears when it is whole. A file of one row group cannot be cut.
    """
    if files.exists(spark, target):
        raise FileExistsError(target)
    recover(spark, source)
    whole = spark.read.option("mergeSchema", True).parquet(source).schema
    inner = T.StructType([f for f in whole.fields if f.name not in partition_columns(spark, source)])
    root, staged = _parts(source)[1], _beside(target, "dense")
    folders: dict[str, list[files.Entry]] = {}
    for entry in files.walk(spark, source):
        inside = entry.path[entry.path.rindex(f"/{root}/") + len(root) + 2 :]
        if entry.length and not any(part.startswith(("_", ".")) for part in inside.split("/")):
            folders.setdefault(inside.rpartition("/")[0], []).append(entry)

    def read(session: SparkSession, paths: Sequence[str]) -> DataFrame:
        return session.read.schema(inner).option("recursiveFileLookup", True).parquet(*paths)

    apart = spark.newSession()  # in which a union of single partitions does not put these together
    apart.conf.set("spark.sql.unionOutputPartitioning", "false")
    for folder, entries in folders.items():
        bins = best_bins([e.length for e in entries], file_bytes)
        large = [entries[b[0]] for b in bins if entries[b[0]].length > file_bytes]
        packed_bins = [[entries[k].path for k in b] for b in bins if entries[b[0]].length <= file_bytes]
        place = f"{staged}/{folder}".rstrip("/")
        for at in range(0, len(packed_bins), BINS_A_JOB):
            parts = [read(apart, paths).coalesce(1) for paths in packed_bins[at : at + BINS_A_JOB]]
            reduce(DataFrame.union, parts).write.mode("append").parquet(place)
        for entry in large:
            session = spark.newSession()  # the size of its splits is a setting of the session that reads
            session.conf.set("spark.sql.files.maxPartitionBytes", str(-(-entry.length // max(1, round(entry.length / file_bytes)))))
            session.conf.set("spark.sql.files.minPartitionNum", "1")
            session.conf.set("spark.sql.files.openCostInBytes", "0")
            read(session, [entry.path]).write.mode("append").parquet(place)
    if not folders:
        spark.createDataFrame([], whole).write.parquet(staged)
    files.rename(spark, staged, target)
    return sum(1 for e in files.walk(spark, target) if e.name.endswith(".parquet"))


def batched_parts(df: DataFrame, parts: int, per_output: int = PARTS_PER_OUTPUT) -> DataFrame:
    """Join small exported parts, ``per_output`` to one output file."""
    return df.coalesce(max(1, math.ceil(parts / per_output)))


def map_columns_by_type(df: DataFrame, test: Callable[[T.DataType], bool], change: Callable[[Column], Column]) -> DataFrame:
    """Apply a function to the columns of one type, pass the rest through."""
    columns = []
    for field in df.schema.fields:
        column = F.col(quote_column(field.name))
        columns.append((change(column) if test(field.dataType) else column).alias(field.name, metadata=field.metadata))
    return df.select(columns)


def convert_tables(spark: SparkSession, listing: DataFrame, target: str) -> list[str]:
    """Copy every table a metadata query selects (one column ``table_name``) to a root, its database as a folder
    of its own. Names only pass the driver."""
    names = [row["table_name"] for row in listing.select("table_name").toLocalIterator()]

    def convert(name: str) -> str:
        write_table(spark.table(quote_name(name, max_length=None)), f"{target.rstrip('/')}/{name.replace('.', '/')}", "create")
        return name

    with ThreadPoolExecutor(TABLES_AT_A_TIME) as pool:
        return list(pool.map(convert, names))


def as_text(column: Column, data_type: T.DataType) -> Column:
    """A value in the text form that a CSV load understands."""
    if isinstance(data_type, T.StringType):
        return column
    if isinstance(data_type, T.BinaryType):
        return F.concat(F.lit("\\x"), F.lower(F.hex(column)))
    if isinstance(data_type, T.VariantType):
        return F.to_json(column)
    if is_geography(data_type):
        return geo_to_wkt(column)
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType)):
        raise ValueError(f"a column of type {data_type.simpleString()} has no text form")
    return column.cast("string")


def export_csv(df: DataFrame, path: str, *, sep: str = ",", header: bool = True, null_token: str = "NULL", compression: str | None = None) -> int:
    """Export as CSV text, so that ``load_csv`` reads the same table back; returns the number of rows.

    A text that is the null token itself gets a backslash before it, and one more where it begins with such. Texts with
    line breaks are quoted; ``load_csv`` reads them with ``multi_line``.
    """
    columns = []
    for field in df.schema.fields:
        text = as_text(F.col(quote_column(field.name)), field.dataType)
        if isinstance(field.dataType, T.StringType):
            text = F.when(F.rlike(text, F.lit(escaped_token(null_token))), F.concat(F.lit("\\"), text)).otherwise(text)
        columns.append(F.coalesce(text, F.lit(null_token)).alias(field.name))
    counted = Observation()
    rows = df.select(columns).observe(counted, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.option("header", header).option("sep", sep).option("escape", '"').option("emptyValue", "")
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if compression:
        writer = writer.option("compression", compression)
    writer.csv(path)
    return counted.get["rows"]


def save_text(df: DataFrame, path: str) -> None:
    """A one-column result as text lines."""
    df.select(F.col(quote_column(df.columns[0])).cast("string")).write.text(path)


def discard(df: DataFrame) -> float:
    """Run a query in full, drop its result, and return the seconds it took."""
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)
