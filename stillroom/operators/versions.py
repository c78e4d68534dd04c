"""Versioned tables: exact lists of files, one pointer per version, and changes that touch only the files they must.

A table is a folder of data files that are never changed, logs that name the files, and numbered version files. A log
has a row for each file that a change added or took away: its rows and bytes, the range of its keys, the partition it
holds, the deletes that apply to it. A version file names the logs that make up the table, and appears whole, under a
number that nothing has yet: that is the commit. A reader takes one version and opens only the files it lists, so it
sees the table before or after a change, never between. What breaks off before the commit is never seen, and what a
change costs follows from its own files, not from the table's.

- **Deletes** are bitmaps of row positions per file. No data file is written for a delete; files of which more than
  ``MERGE_RATIO`` is deleted are written anew by the same commit.
- **Changes by key** read and write only files that may hold a changed key. The range of the first key in each file is
  looked up first, then a Bloom filter of all keys; both err on the side of reading. All other files stay as they are.
- **Counts** come from the footers of committed files and from committed bitmaps, so that a task that runs twice counts
  once.
- **Names.** A change that carries a token is applied once. A version file holds its token until a mark beside it does,
  and every writer leaves the mark of the version before its own, so that no crash forgets one.

Two writers of one version: the second gets ``ConflictError``; an append tries again on top of the other's version.
"""

from __future__ import annotations

import json
import math
import re
import uuid
from bisect import bisect_right
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from itertools import accumulate
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stillroom import files
from stillroom.functions.expressions import quote_column
from stillroom.functions.geo import box_cells, in_box
from stillroom.operators import changes as C
from stillroom.operators.conditions import Match
from stillroom.schema import align, enforce_not_null

MERGE_RATIO = 0.3
#: Logs of a version before they are merged into one.
MAX_LOGS = 24
FILE_BYTES = 128 * 1024**2
#: Bits of a Bloom filter's block, blocks' keys, and bits set for a key.
BLOOM_BITS, BLOOM_KEYS, BLOOM_SETS = 32_768, 3_000, 4
#: (file, key) pairs up to which the Bloom filters are asked; beyond that nearly every file in range holds a key anyway.
BLOOM_PAIRS = 50_000_000
#: Ranges that tasks get; neighbouring files share one where there are more.
MAX_RANGES = 100_000

FILE, ROW, PART = "__file", "__row", "__part"


class ConflictError(RuntimeError):
    """Another writer committed the version that this one was about to."""


@dataclass(frozen=True)
class Version:
    """What a version file says."""

    number: int
    token: str | None
    logs: tuple[str, ...]
    schema: T.StructType
    keys: tuple[str, ...]
    partition: str | None

    def text(self) -> str:
        return json.dumps({**self.__dict__, "schema": self.schema.jsonValue()})

    @staticmethod
    def of(text: str) -> Version:
        read = json.loads(text)
        return Version(read["number"], read["token"], tuple(read["logs"]), T.StructType.fromJson(read["schema"]), tuple(read["keys"]), read["partition"])


def _c(name: str) -> Column:
    return F.col(quote_column(name))


def is_versioned(spark: SparkSession, path: str) -> bool:
    return files.exists(spark, f"{path.rstrip('/')}/_versions")


def _in_order(column: Column, kind: T.DataType) -> tuple[Column, str] | None:
    """A form of the values that Python orders as Spark does; None for types without one."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return column.cast("long"), "long"
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long"), "long"
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(column.cast("timestamp_ltz")), "long"
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column), "long"
    return (column, "string") if kind == T.StringType() else None


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table, versioned or a plain folder of Parquet files."""
    return VersionedTable(spark, path).read() if is_versioned(spark, path) else spark.read.parquet(path)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @staticmethod
    def create(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str] = (), partition: str | None = None) -> VersionedTable:
        """An empty table. ``keys`` are those that changes will match by; rows are clustered by them when they are
        written. Files of a table with a ``partition`` column hold one value of it each."""
        missing = [c for c in [*keys, *([partition] if partition else [])] if c not in schema.fieldNames()]
        if missing:
            raise ValueError(f"columns that the table does not have: {missing}")
        table = VersionedTable(spark, path)
        if not files.create_whole(spark, table._pointer(1), Version(1, None, (), schema, tuple(keys), partition).text()):
            raise FileExistsError(path)
        return table

    # Versions

    def _pointer(self, number: int) -> str:
        return f"{self.path}/_versions/{number:012d}"

    def version(self, number: int | None = None) -> Version:
        """A version, the last one by default. A hint says where to begin, so that no listing grows with the versions."""
        if number is None:
            hint = f"{self.path}/_versions/_last"
            if files.exists(self.spark, hint) and files.exists(self.spark, self._pointer(int(files.read_text(self.spark, hint)))):
                number = int(files.read_text(self.spark, hint))
            else:
                numbers = [int(e.name) for e in files.entries(self.spark, f"{self.path}/_versions") if e.name.isdigit()]
                if not numbers:
                    raise FileNotFoundError(self.path)
                number = max(numbers)
            while files.exists(self.spark, self._pointer(number + 1)):
                number += 1
        return Version.of(files.read_text(self.spark, self._pointer(number)))

    def _mark(self, token: str) -> str:
        if not re.fullmatch(r"[\w-]+", token):
            raise ValueError(f"token with characters that are not allowed: {token!r}")
        return f"{self.path}/_applied/{token}"

    def _applied(self, now: Version, token: str | None) -> bool:
        if token is None:
            return False
        if now.token == token:
            files.write_text(self.spark, self._mark(token), "")
            return True
        return files.exists(self.spark, self._mark(token))

    def _commit(self, now: Version, logs: Sequence[str], token: str | None, merge: bool = True) -> None:
        """Make the next version; ``logs`` are added to those of ``now``."""
        if now.token is not None:
            files.write_text(self.spark, self._mark(now.token), "")
        kept = (*now.logs, *logs)
        if merge and len(kept) > MAX_LOGS:
            merged = self._name()
            self._live(replace(now, logs=kept)).write.parquet(f"{self.path}/logs/{merged}")
            kept = (merged,)
        after = replace(now, number=now.number + 1, token=token, logs=kept)
        if not files.create_whole(self.spark, self._pointer(after.number), after.text()):
            raise ConflictError(f"version {after.number} of {self.path} was written by another run")
        files.write_text(self.spark, f"{self.path}/_versions/_last", str(after.number))
        if token is not None:
            files.write_text(self.spark, self._mark(token), "")

    # Files

    def _name(self) -> str:
        return uuid.uuid4().hex

    def _log_schema(self, of: Version) -> T.StructType:
        ordered = _in_order(F.lit(None), of.schema[of.keys[0]].dataType) if of.keys else None
        kind = T.StringType() if ordered and ordered[1] == "string" else T.LongType()
        part = of.schema[of.partition].dataType if of.partition else T.StringType()
        return T.StructType([
            T.StructField("file", T.StringType()), T.StructField("live", T.BooleanType()), T.StructField("version", T.LongType()), T.StructField("rows", T.LongType()),
            T.StructField("bytes", T.LongType()), T.StructField("low", kind), T.StructField("high", kind), T.StructField("part", part), T.StructField("deleted", T.LongType()),
            T.StructField("deletes", T.StringType()), T.StructField("bloom", T.StringType()), T.StructField("blocks", T.IntegerType()),
        ])

    def _live(self, of: Version) -> DataFrame:
        """A row for each file of a version."""
        schema = self._log_schema(of)
        if not of.logs:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*(f"{self.path}/logs/{log}" for log in of.logs))
        rest = [f.name for f in schema.fields if f.name != "file"]
        last = rows.groupBy("file").agg(F.max_by(F.struct(*rest), F.struct("version", "live")).alias("last"))
        return last.select("file", "last.*").filter("live")

    def files(self, version: int | None = None) -> DataFrame:
        """The files of a version with their rows, bytes, key ranges and deletes."""
        return self._live(self.version(version))

    def count(self, version: int | None = None) -> int:
        """Rows, from the logs alone."""
        return self.files(version).agg(F.coalesce(F.sum(F.col("rows") - F.col("deleted")), F.lit(0))).first()[0]

    def _scan(self, of: Version, names: Sequence[str]) -> DataFrame:
        """Rows of some files with their file's name and their position, deleted ones included."""
        if not names:
            return self.spark.createDataFrame([], T.StructType([*of.schema.fields, T.StructField(FILE, T.StringType()), T.StructField(ROW, T.LongType())]))
        rows = self.spark.read.schema(T.StructType([T.StructField(f.name, f.dataType) for f in of.schema.fields])).parquet(*(f"{self.path}/data/{n}" for n in names))
        return rows.select("*", F.regexp_extract("_metadata.file_path", r"^.*/data/(.+)$", 1).alias(FILE), F.col("_metadata.row_index").alias(ROW))

    def _bitmaps(self, folders: Sequence[str]) -> DataFrame:
        schema = "file string, bucket long, bits binary"
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/deletes/{d}" for d in folders))

    def _rows(self, of: Version, entries: Sequence) -> DataFrame:
        """Rows of the files of some log entries without the deleted ones, with file and position. Files that have no
        deletes are read as they are."""
        clean, dirty = [e["file"] for e in entries if not e["deletes"]], [e for e in entries if e["deletes"]]
        rows = self._scan(of, clean)
        if not dirty:
            return rows
        wanted = self.spark.createDataFrame([(e["file"], e["deletes"]) for e in dirty], "file string, folder string")
        bitmaps = self._bitmaps(sorted({e["deletes"] for e in dirty})).withColumn("folder", F.regexp_extract("_metadata.file_path", r"/deletes/([^/]+)/[^/]+$", 1))
        bitmaps = bitmaps.join(wanted, ["file", "folder"], "left_semi").select(F.col("file").alias("__of"), F.col("bucket").alias("__bucket"), F.col("bits").alias("__bits"))
        at = (F.col(ROW) % BLOOM_BITS).cast("int")
        bucket = F.call_function("bitmap_bucket_number", F.col(ROW) + 1)
        held = self._scan(of, [e["file"] for e in dirty]).withColumn("__at", at)
        held = held.join(bitmaps, (F.col(FILE) == F.col("__of")) & (bucket == F.col("__bucket")), "left")
        return rows.unionByName(held.filter(~F.coalesce(_bit("__bits", F.col("__at")), F.lit(False))).select(rows.columns))

    def read(self, version: int | None = None, where: Column | None = None) -> DataFrame:
        """The rows of a version. ``where``: a condition on the log's columns (part, low, high); files that it rejects
        are not opened."""
        of = self.version(version)
        live = self._live(of)
        entries = (live if where is None else live.filter(where)).select("file", "deletes").collect()  # names, as Spark's own file index holds
        return self._rows(of, entries).select([_c(f.name) for f in of.schema.fields])

    def matching(self, keys: DataFrame, match: Match | C.Pairs) -> DataFrame:
        """The rows that have a partner among ``keys``; only files that may hold one are read."""
        now, match = self.version(), C._as_match(match)
        source = C.settled(C.prefixed(keys, sorted(match.source_columns), match).distinct(), "wanted-keys")
        rows = self._rows(now, self._touched(now, source, match))
        return rows.join(source, C._on(match), "left_semi").select([_c(f.name) for f in now.schema.fields])

    def in_box(self, lon: str, lat: str, box: tuple[float, float, float, float]) -> DataFrame:
        """The points in a box (min_lon, max_lon, min_lat, max_lat) of a table whose first key is their ``geo.cell``; only
        files with places on the curve that the box covers are opened."""
        ranges = box_cells(*box)
        meets = reduce(or_, [(F.col("low") <= high) & (F.col("high") >= low) for low, high in ranges], F.lit(False))
        return self.read(where=meets).filter(in_box(quote_column(lon), quote_column(lat), *box))

    def _write(self, of: Version, df: DataFrame, n_files: int | None = None) -> str:
        """Store rows as new files and return their folder; rows are checked against the table's definition."""
        folder = self._name()
        rows = enforce_not_null(align(df, of.schema), of.schema) if not all(f.nullable for f in of.schema.fields) else align(df, of.schema)
        if of.partition:
            part = F.abs(F.xxhash64(_c(of.partition)) % 1_000_000_007)  # a folder name that needs no escapes
            rows = rows.withColumn(PART, part).hint("rebalance", F.col(PART))
            rows = rows.sortWithinPartitions(PART, *(_c(k) for k in of.keys)) if of.keys else rows
        elif of.keys:
            by = [_c(k) for k in of.keys]
            rows = (rows.repartitionByRange(n_files, *by) if n_files else rows.repartitionByRange(*by)).sortWithinPartitions(*by)
        elif n_files:
            rows = rows.coalesce(n_files)
        writer = rows.write
        (writer.partitionBy(PART) if of.partition else writer).parquet(f"{self.path}/data/{folder}")
        return folder

    def _described(self, of: Version, folder: str) -> DataFrame:
        """Log rows of a folder's files, from the files as they were committed: footers, and the key columns."""
        read = self.spark.read.schema(T.StructType([T.StructField(f.name, f.dataType) for f in of.schema.fields]))
        rows = read.option("recursiveFileLookup", True).parquet(f"{self.path}/data/{folder}")
        low = high = F.lit(None)
        if of.keys and (key := _in_order(_c(of.keys[0]), of.schema[of.keys[0]].dataType)):
            low, high = F.min(key[0]), F.max(key[0])
        part = F.first(_c(of.partition)) if of.partition else F.lit(None)
        found = rows.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(F.count(F.lit(1)).alias("rows"), low.alias("low"), high.alias("high"), part.alias("part"))
        name = F.regexp_extract("path", r"^.*/data/(.+)$", 1)
        values = {
            "file": name, "live": F.lit(True), "version": F.lit(of.number + 1), "rows": F.col("rows"), "bytes": F.col("bytes"), "low": F.col("low"), "high": F.col("high"), "part": F.col("part"),
            "deleted": F.lit(0), "deletes": F.lit(None), "bloom": F.lit(folder if of.keys else None), "blocks": F.ceil(F.col("rows") / BLOOM_KEYS),
        }
        found = found.filter("rows > 0").select([values[f.name].cast(f.dataType).alias(f.name) for f in self._log_schema(of).fields])
        if of.keys:
            self._write_bloom(of, rows, folder, found.select("file", "blocks"))
        return found

    def _write_bloom(self, of: Version, rows: DataFrame, folder: str, blocks: DataFrame) -> None:
        """A Bloom filter for each file, in blocks of bits; a key sets its bits within one block."""
        keyed = rows.select(F.regexp_extract("_metadata.file_path", r"^.*/data/(.+)$", 1).alias("file"), *(_c(k) for k in of.keys)).dropna(subset=[*of.keys])
        hashed = keyed.select("file", _key_hash(of, [_c(k) for k in of.keys]).alias("hash")).join(blocks, "file")
        bits = hashed.select("file", _block(F.col("hash"), F.col("blocks")).alias("block"), F.explode(_bits(F.col("hash"))).alias("bit"))
        made = bits.groupBy("file", "block").agg(F.bitmap_construct_agg(F.col("bit")).alias("bits"))
        made.write.parquet(f"{self.path}/blooms/{folder}")

    def _log(self, rows: DataFrame) -> str:
        name = self._name()
        rows.write.parquet(f"{self.path}/logs/{name}")
        return name

    def _gone(self, of: Version, entries: DataFrame) -> DataFrame:
        """Log rows that take files away."""
        return entries.withColumns({"live": F.lit(False), "version": F.lit(of.number + 1).cast("long")})

    # Changes

    def append(self, df: DataFrame, token: str | None = None) -> int:
        """Add rows; returns their number, 0 where the token was applied before."""
        now = self.version()
        if self._applied(now, token):
            return 0
        log = self._log(self._described(now, self._write(now, df)))
        rows = self._added(now, log)
        while True:
            try:
                self._commit(now, [log], token)
                return rows
            except ConflictError:  # files of their own: what the other did does not matter
                now = self.version()
                if self._applied(now, token):
                    return 0

    def _added(self, of: Version, log: str) -> int:
        return self.spark.read.schema(self._log_schema(of)).parquet(f"{self.path}/logs/{log}").filter("live").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

    def replace(self, df: DataFrame, token: str | None = None) -> int:
        """All rows by others; the frame may read this table."""
        now = self.version()
        if self._applied(now, token):
            return 0
        folder = self._write(now, df)
        log = self._log(self._described(now, folder))
        self._commit(replace(now, logs=()), [log], token, merge=False)
        return self._added(now, log)

    def replace_window(self, df: DataFrame, start: object, until: object | None = None, token: str | None = None) -> int:
        """The rows of the partitions from ``start`` up to but without ``until`` by the frame's rows of these; partitions
        outside are not touched. Returns the number of rows written."""
        now = self.version()
        if now.partition is None:
            raise ValueError(f"{self.path} has no partition column")
        if self._applied(now, token):
            return 0
        kind = now.schema[now.partition].dataType

        def inside(column: Column) -> Column:
            found = column >= F.lit(start).cast(kind)
            return found if until is None else found & (column < F.lit(until).cast(kind))

        folder = self._write(now, df.filter(inside(_c(now.partition))))
        log = self._log(self._described(now, folder).unionByName(self._gone(now, self._live(now).filter(inside(F.col("part"))))))
        self._commit(now, [log], token)
        return self._added(now, log)

    def delete_where(self, condition: Column, token: str | None = None) -> int:
        """Delete the rows for which the condition is true; returns their number."""
        now = self.version()
        if self._applied(now, token):
            return 0
        entries = self._live(now).collect()
        return self._delete(now, entries, self._rows(now, entries).filter(condition).select(FILE, ROW), token)

    def delete_matching(self, keys: DataFrame, match: Match | C.Pairs, token: str | None = None) -> int:
        """Delete the rows that have a partner among ``keys``; only files that may hold one are read."""
        now = self.version()
        if self._applied(now, token):
            return 0
        match = C._as_match(match)
        source = C.settled(C.prefixed(keys, sorted(match.source_columns), match).distinct(), "delete-keys")
        entries = self._touched(now, source, match)
        hits = self._rows(now, entries).join(source, C._on(match), "left_semi").select(FILE, ROW)
        return self._delete(now, entries, hits, token)

    def _delete(self, now: Version, entries: Sequence, hits: DataFrame, token: str | None) -> int:
        """Write the positions down and commit; files with many deleted rows are written anew without them."""
        old = self._bitmaps(sorted({e["deletes"] for e in entries if e["deletes"]})).withColumn("folder", F.regexp_extract("_metadata.file_path", r"/deletes/([^/]+)/[^/]+$", 1)) if any(e["deletes"] for e in entries) else None
        position = F.col(ROW) + 1
        fresh = hits.groupBy(F.col(FILE).alias("file"), F.call_function("bitmap_bucket_number", position).alias("bucket")).agg(F.bitmap_construct_agg(F.call_function("bitmap_bit_position", position)).alias("bits"))
        fresh = C.settled(fresh, "deleted-positions")
        hit = {r["file"]: r["n"] for r in fresh.groupBy("file").agg(F.sum(F.bitmap_count("bits")).alias("n")).collect()}  # a row for each file with hits
        if not hit:
            return 0
        by_name = {e["file"]: e for e in entries}
        heavy = {f for f, n in hit.items() if n + by_name[f]["deleted"] > MERGE_RATIO * by_name[f]["rows"]}
        logs, folder = [], self._name()
        light = sorted(set(hit) - heavy)
        if light:
            named = self.spark.createDataFrame([(f, by_name[f]["deletes"]) for f in light], "file string, folder string")
            bitmaps = fresh.join(named.select("file"), "file", "left_semi")
            if old is not None:
                bitmaps = bitmaps.unionByName(old.join(named, ["file", "folder"], "left_semi").select("file", "bucket", "bits"))
            bitmaps.groupBy("file", "bucket").agg(F.call_function("bitmap_or_agg", F.col("bits")).alias("bits")).write.parquet(f"{self.path}/deletes/{folder}")
            schema = self._log_schema(now)
            rows = [{**by_name[f].asDict(), "version": now.number + 1, "deleted": by_name[f]["deleted"] + hit[f], "deletes": folder} for f in light]
            logs.append(self._log(self.spark.createDataFrame([tuple(r[c] for c in schema.fieldNames()) for r in rows], schema)))
        if heavy:
            left = self._rows(now, [by_name[f] for f in sorted(heavy)]).join(hits.select(FILE, ROW).distinct(), [FILE, ROW], "left_anti")
            logs.append(self._rewritten(now, [by_name[f] for f in sorted(heavy)], left))
        self._commit(now, logs, token)
        return sum(hit.values())

    def _rewritten(self, now: Version, entries: Sequence, rows: DataFrame) -> str:
        """A log that puts rows in the place of some files."""
        schema = self._log_schema(now)
        gone = self._gone(now, self.spark.createDataFrame([tuple(e[c] for c in schema.fieldNames()) for e in entries], schema))
        n_files = max(1, math.ceil(sum(e["bytes"] for e in entries) / FILE_BYTES))
        folder = self._write(now, rows.select([_c(f.name) for f in now.schema.fields]), n_files)
        return self._log(self._described(now, folder).unionByName(gone))

    def update_where(self, assignments: Mapping[str, Column], condition: Column, token: str | None = None) -> int:
        """Set columns of the rows for which the condition is true; only files that have such rows are written."""
        now = self.version()
        if self._applied(now, token):
            return 0
        entries = self._live(now).collect()
        hit = {r[FILE]: r["count"] for r in self._rows(now, entries).filter(condition).groupBy(FILE).count().collect()}
        if not hit:
            return 0
        touched = [e for e in entries if e["file"] in hit]
        rows = C.update_where(self._rows(now, touched).drop(FILE, ROW), assignments, condition)
        self._commit(now, [self._rewritten(now, touched, rows)], token)
        return sum(hit.values())

    def update_from(self, changes: DataFrame, match: Match | C.Pairs, token: str | None = None) -> int:
        """Overwrite the shared columns of matching rows; returns the number of rows hit."""
        now, match = self.version(), C._as_match(match)
        if self._applied(now, token):
            return 0
        changes = C.settled(changes, "changes")
        source = C.prefixed(changes, sorted(match.source_columns), match)
        hit_rows = self._rows(now, entries := self._touched(now, source, match)).join(source.distinct(), C._on(match), "left_semi")
        hit = {r[FILE]: r["count"] for r in hit_rows.groupBy(FILE).count().collect()}
        if not hit:
            return 0
        touched = [e for e in entries if e["file"] in hit]
        rows = C.update_from(self._rows(now, touched).drop(FILE, ROW), changes, match)
        self._commit(now, [self._rewritten(now, touched, rows)], token)
        return sum(hit.values())

    def upsert(self, changes: DataFrame, match: Match | C.Pairs, token: str | None = None) -> tuple[int, int]:
        """Update the rows that match, insert the changes that match none; returns (updated, inserted)."""
        now, match = self.version(), C._as_match(match)
        if self._applied(now, token):
            return 0, 0
        changes = C.settled(changes, "changes")
        source = C.prefixed(changes, sorted(match.source_columns), match)
        hit_rows = self._rows(now, entries := self._touched(now, source, match)).join(source.distinct(), C._on(match), "left_semi")
        hit = {r[FILE]: r["count"] for r in hit_rows.groupBy(FILE).count().collect()}
        touched = [e for e in entries if e["file"] in hit]
        before = sum(e["rows"] - e["deleted"] for e in touched)
        rows = C.upsert(self._rows(now, touched).drop(FILE, ROW), changes, match)
        log = self._rewritten(now, touched, rows)
        self._commit(now, [log], token)
        return sum(hit.values()), self._added(now, log) - before

    # Lookup

    def _touched(self, of: Version, source: DataFrame, match: Match) -> list:
        """Log entries of the files that may hold a row that matches ``source`` (prefixed rows of a changeset)."""
        live = self._live(of).collect()  # as many rows as files
        pairs = {target: C.SOURCE_PREFIX + column for column, target in match.pairs}
        first = of.keys[0] if of.keys else None
        key = _in_order(_c(pairs[first]), of.schema[first].dataType) if first in pairs else None
        kinds = dict(source.dtypes)
        if key is None or kinds[pairs[first]] != of.schema[first].dataType.simpleString():
            return live
        ranged = sorted((e for e in live if e["low"] is not None), key=lambda e: (e["low"], e["file"]))
        if not ranged:
            return []
        each = math.ceil(len(ranged) / MAX_RANGES)
        groups = [ranged[k : k + each] for k in range(0, len(ranged), each)]
        bounds = [(g[0]["low"], max(e["high"] for e in g)) for g in groups]
        whole = all(k in pairs and kinds[pairs[k]] == of.schema[k].dataType.simpleString() for k in of.keys)
        asked = source.select(key[0].alias("key"), _key_hash(of, [_c(pairs[k]) for k in of.keys]).alias("hash") if whole else F.lit(0).cast("long").alias("hash")).dropna(subset=["key"]).distinct()
        in_range = {r["k"]: r["n"] for r in asked.mapInPandas(_lookup(bounds, False), "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()}
        found = [e for k in sorted(in_range) for e in groups[k]]
        if not whole or each > 1 or sum(in_range.values()) > BLOOM_PAIRS or not all(e["bloom"] for e in found):
            return found
        named = self.spark.createDataFrame([(k, groups[k][0]["file"], groups[k][0]["blocks"], groups[k][0]["bloom"]) for k in sorted(in_range)], "k int, file string, blocks int, bloom string")
        meets = asked.mapInPandas(_lookup(bounds, True), "k int, hash long").distinct().join(named, "k")
        meets = meets.select("file", "bloom", _block(F.col("hash"), F.col("blocks")).alias("block"), _bits(F.col("hash")).alias("at"))
        blooms = self.spark.read.schema("file string, block int, bits binary").parquet(*(f"{self.path}/blooms/{b}" for b in sorted({e["bloom"] for e in found})))
        held = meets.join(blooms, ["file", "block"]).filter(F.forall("at", lambda b: _bit("bits", b.cast("int"))))
        may = {r["file"] for r in held.select("file").distinct().collect()}
        return [e for e in found if e["file"] in may]

    # Upkeep

    def compact(self, small: int = FILE_BYTES // 2, ratio: float = 0.1, token: str | None = None) -> int:
        """Write small files, and those with more than ``ratio`` of their rows deleted, anew; returns how many there were."""
        now = self.version()
        if self._applied(now, token):
            return 0
        poor = F.col("deleted") > ratio * F.col("rows")
        live = self._live(now).withColumn("among", F.count_if(F.col("bytes") < small).over(Window.partitionBy("part")))
        entries = live.filter(poor | ((F.col("bytes") < small) & (F.col("among") > 1))).drop("among").collect()  # a row for each such file
        if entries:
            self._commit(now, [self._rewritten(now, entries, self._rows(now, entries))], token)
        return len(entries)

    def vacuum(self) -> int:
        """Remove what the last version does not need; run it while nothing reads older versions or writes. Applied
        tokens stay known. Returns the number of files and folders removed."""
        now, removed = self.version(), 0
        live = self._live(now).select("file", "deletes", "bloom").collect()
        data = {e["file"] for e in live}
        keep = {"logs": set(now.logs), "deletes": {e["deletes"] for e in live}, "blooms": {e["bloom"] for e in live}}
        for kind, names in keep.items():
            for entry in files.entries(self.spark, f"{self.path}/{kind}"):
                if entry.name not in names:
                    removed += files.remove(self.spark, entry.path)
        for folder in files.entries(self.spark, f"{self.path}/data"):
            inside = files.walk(self.spark, folder.path)
            wanted = [e for e in inside if e.path.rpartition("/data/")[2] in data]
            for entry in [folder] if not wanted else [e for e in inside if e not in wanted and not e.name.startswith(("_", "."))]:
                removed += files.remove(self.spark, entry.path)
        for entry in files.entries(self.spark, f"{self.path}/_versions"):
            if entry.name.isdigit() and int(entry.name) < now.number:
                removed += files.remove(self.spark, entry.path)
        return removed


def _bit(bits: str, at: Column) -> Column:
    """Whether a bit of a bitmap is set."""
    byte = F.conv(F.hex(F.substring(F.col(bits), (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, at % 8).bitwiseAND(F.lit(1)) == 1


def _key_hash(of: Version, keys: Sequence[Column]) -> Column:
    return F.xxhash64(*(k.cast(of.schema[name].dataType) for k, name in zip(keys, of.keys, strict=True)))


def _block(hashed: Column, blocks: Column) -> Column:
    return F.pmod(F.shiftright(hashed, 20), blocks).cast("int")


def _bits(hashed: Column) -> Column:
    """Positions within a block."""
    return F.transform(F.array(*(F.lit(k) for k in range(BLOOM_SETS))), lambda k: F.pmod(F.xxhash64(hashed, k), F.lit(BLOOM_BITS)))


def _lookup(bounds: Sequence[tuple], paired: bool):
    """For each range of ``bounds``, ordered by low ends, the number of keys in it; ``paired``: each such key's hash.

    One closure over plain values and installed modules, so that tasks need nothing of this package."""
    lows = [low for low, _ in bounds]
    reach = list(accumulate((high for _, high in bounds), max))  # the highest end so far: below the key, none before holds it

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[int, int] = {}
        for batch in batches:
            found = []
            for key, hashed in zip(batch["key"].tolist(), batch["hash"].tolist(), strict=True):
                k = bisect_right(lows, key) - 1
                while k >= 0 and reach[k] >= key:
                    if bounds[k][1] >= key:
                        counts[k] = counts.get(k, 0) + 1
                        found.append((k, hashed))
                    k -= 1
            if paired:
                yield pd.DataFrame({"k": [k for k, _ in found], "hash": pd.Series([h for _, h in found], dtype="int64")})
        if not paired:
            yield pd.DataFrame({"k": list(counts), "n": list(counts.values())}, dtype="int64")

    return run
