"""Incremental loads as streams: repeated appends, snapshots of a window, and repeated changesets.

Every micro-batch is named after its run (the checkpoint) and number. What it does is repeatable until its mark is
left, and is not done again afterwards, so a batch that is delivered twice is applied once.
"""

from __future__ import annotations

import hashlib
import json
import operator
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stillroom import files
from stillroom.functions.expressions import quote_column
from stillroom.operators.tables import append_batch, refresh_window, write_table
from stillroom.operators.versions import VersionedTable

ACTIONS = ("upsert", "update", "delete")
LIFE, SET, VERSION = "__life", "__set", "__version"


def _c(name: str) -> Column:
    return F.col(quote_column(name))


def read_stream(spark: SparkSession, path: str, schema: T.StructType, *, files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files below a path as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def _run(stream: DataFrame, checkpoint: str, batch) -> None:
    """Hand every new batch to a function, with its name, then stop."""
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    writer = stream.writeStream.foreachBatch(lambda df, number: batch(df, f"{run}-{number}"))
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def append_stream(stream: DataFrame, target: str | VersionedTable, checkpoint: str) -> None:
    """Append everything that is new since the last run, then stop.

    The table may be new, or written and appended to by other means before and after. A batch into a versioned table is
    one commit of its own files: readers see it whole or not at all, and its cost does not follow from the table's size.
    """

    def batch(df: DataFrame, token: str) -> None:
        if isinstance(target, VersionedTable):
            target.append(df, token)
        else:
            append_batch(df, target, token)

    _run(stream, checkpoint, batch)


def window_stream(
    spark: SparkSession, source: str, schema: T.StructType, target: str | VersionedTable, date_column: str, checkpoint: str, *, files_per_batch: int = 1000
) -> None:
    """Rolling-window refresh from a stream of snapshots, each the full re-read of a window of days.

    A snapshot is the folder ``<source>/snapshot=<id>/from=<first day>`` of files, finished by ``_SUCCESS``; ids grow.
    The stream only tells which snapshots have new files: each of them is then read whole, however its files fell into
    batches, and takes the place of the window's days up to the first day of any newer snapshot. A snapshot that is not
    finished is an error, and its batch comes again. A versioned table, partitioned by the days, changes by one commit
    for each snapshot.
    """
    listed = T.StructType([*schema.fields, T.StructField("snapshot", T.StringType()), T.StructField("from", T.StringType())])
    stream = read_stream(spark, source, listed, files_per_batch=files_per_batch).select("snapshot", "from")
    applied = f"{target.path}/_snapshots" if isinstance(target, VersionedTable) else f"{target.rstrip('/')}.snapshots"

    def batch(df: DataFrame, token: str) -> None:
        for row in sorted(df.distinct().collect()):  # a row for each snapshot
            folder = f"{source.rstrip('/')}/snapshot={row['snapshot']}/from={row['from']}"
            mark = f"{applied}/{row['snapshot']}@{row['from']}"
            if not files.exists(spark, f"{folder}/_SUCCESS"):
                raise ValueError(f"the snapshot {folder} is not finished")
            if files.exists(spark, mark):  # read whole by an earlier batch
                continue
            known = [e.name.partition("@") for e in files.entries(spark, applied)]
            newer = [start for number, _, start in known if number > row["snapshot"]]
            if not newer or min(newer) > row["from"]:
                refresh_or_create(spark.read.schema(schema).parquet(folder), row["from"], min(newer, default=None))
            files.write_text(spark, mark, "")

    def refresh_or_create(rows: DataFrame, start: str, until: str | None) -> None:
        if isinstance(target, VersionedTable):
            target.replace_window(rows, start, until)
            return
        if not files.exists(spark, target):
            write_table(rows.filter("false"), target, "create_if_missing", partition_by=[date_column])
        refresh_window(rows, target, date_column, start, until)

    _run(stream, checkpoint, batch)


def _ordered(fields: Sequence[T.StructField]) -> list[str]:
    """Columns of types that have an order."""
    return [f.name for f in fields if not isinstance(f.dataType, (T.VariantType, T.MapType, T.StructType, T.ArrayType))]


def latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order_by``, the other columns deciding where that is equal. An aggregate, not a
    window: a hot key collapses before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ties = [c for c in _ordered(df.schema.fields) if c in rest and c not in order_by]
    last = F.max_by(F.struct([F.col(quote_column(c)) for c in rest]), F.struct([F.col(quote_column(c)) for c in [*order_by, *ties]]))
    grouped = df.groupBy([F.col(quote_column(k)) for k in keys]).agg(last.alias("__last"))
    return grouped.select([F.col(quote_column(c)) if c in keys else F.col("__last")[c].alias(c) for c in df.columns])


class KeyedTable:
    """A table of keys that takes changesets, merged when it is read.

    A batch only adds its rows. An upsert brings a whole row, an update some columns, a delete none, each at the place
    that its ``order_by`` columns and then the batch's number give it. Reading takes for every key the last upsert or
    delete, which decides whether the key is there, and for every column the last change that set it. So the result does
    not depend on how changes fell into batches nor on the order of these: a late change neither displaces nor revives
    anything newer, updates of different columns stand side by side, and one that comes before the upsert of its key
    waits for it. Updates and deletes without all ``order_by`` columns stand where the row that they hit stands, and
    need it to be there. Rows with a NULL in their key match nothing and are kept each.

    When the additions are large against the rest, or many, they are merged into it; that keeps, beside each key, the
    places of its columns as far as they differ.

    ``data/<number>-<token>`` holds a batch, ``versions/<number>`` the folders that make up the table after it. The
    version file is the point of commit; ``applied/<token>`` remembers every batch.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: Sequence[str], order_by: Sequence[str], *, merge_ratio: float = 0.5, max_additions: int = 32):
        missing = [c for c in [*keys, *order_by] if c not in schema.fieldNames()]
        if missing:
            raise ValueError(f"columns that the table does not have: {missing}")
        if not order_by and set(schema.fieldNames()) != set(keys):
            raise ValueError("a table of more than keys needs columns that order its changes")
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.keys, self.order_by = list(keys), list(order_by)
        self.merge_ratio, self.max_additions = merge_ratio, max_additions
        self.rest = [f.name for f in schema.fields if f.name not in self.keys]
        place = T.StructType([*(T.StructField(f"o{i}", schema[c].dataType) for i, c in enumerate(self.order_by)), T.StructField(VERSION, T.LongType())])
        life = T.StructType([T.StructField("at", place), T.StructField("there", T.BooleanType())])
        # LIFE: the last upsert or delete. SET: the place of the change that set each column, NULL where that is LIFE's.
        places = T.StructType([T.StructField(f"c{i}", place) for i, _ in enumerate(self.rest)] or [T.StructField("none", T.BooleanType())])
        self.stored = T.StructType([*(T.StructField(f.name, f.dataType) for f in schema.fields), T.StructField(LIFE, life), T.StructField(SET, places)])
        self.place, self.places = place, places
        layout, own = f"{self.root}/layout", {"keys": self.keys, "order_by": self.order_by}
        if not files.exists(spark, layout):
            files.write_text(spark, layout, json.dumps(own))
        elif (found := json.loads(files.read_text(spark, layout))) != own:
            raise ValueError(f"{root} is laid out for {found}")

    def _state(self) -> dict:
        """The last version: number, token, base folder and folders of additions, with their bytes."""
        names = sorted(e.name for e in files.entries(self.spark, f"{self.root}/versions") if e.name.isdigit())
        return json.loads(files.read_text(self.spark, f"{self.root}/versions/{names[-1]}")) if names else {"number": 0, "token": None, "base": None, "added": []}

    def _rows(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.stored)
        return self.spark.read.schema(self.stored).parquet(*(f"{self.root}/data/{f}" for f in folders))

    def _whole(self) -> str:
        return " AND ".join(f"{quote_column(k)} IS NOT NULL" for k in self.keys)

    def _merged(self, rows: DataFrame) -> DataFrame:
        """One row for each key, deleted ones and waiting updates included, and all rows without a whole key."""
        life = F.col(LIFE)
        born = F.when(life["there"], life["at"])

        def place(i: int) -> Column:
            return F.coalesce(F.col(SET)[f"c{i}"], F.when(F.col(SET).isNull(), born))

        last = [F.max_by(_c(c), place(i)).alias(f"__v{i}") for i, c in enumerate(self.rest)]
        places = [F.max(place(i)).alias(f"__p{i}") for i, _ in enumerate(self.rest)]
        # A struct that is the greatest by its place: places differ between batches, and a batch has a key once.
        grouped = rows.filter(self._whole()).groupBy([_c(k) for k in self.keys]).agg(F.max(life).alias(LIFE), *last, *places)
        alike = reduce(operator.and_, [F.col(f"__p{i}").eqNullSafe(F.when(F.col(LIFE)["there"], F.col(LIFE)["at"])) for i, _ in enumerate(self.rest)], F.lit(True))
        kept = F.struct([F.col(f"__p{i}").alias(f"c{i}") for i, _ in enumerate(self.rest)] or [F.lit(None).cast("boolean").alias("none")])
        values = {c: F.col(f"__v{i}") for i, c in enumerate(self.rest)}
        columns = [values.get(c, _c(c)).alias(c) for c in self.schema.fieldNames()]
        merged = grouped.select(*columns, LIFE, F.when(~alike, kept).cast(self.places).alias(SET))
        return merged.unionByName(rows.filter(f"NOT ({self._whole()})"))

    def read(self) -> DataFrame:
        """The current rows."""
        state = self._state()
        folders = [f["name"] for f in [state["base"], *state["added"]] if f]
        return self._merged(self._rows(folders)).filter(F.col(LIFE)["there"]).select(self.schema.fieldNames())

    def load(self, df: DataFrame) -> None:
        """First content of an empty table."""
        if self._state()["number"]:
            raise ValueError(f"{self.root} already holds rows")
        self.apply(df, "upsert", "load-0")

    def apply(self, batch: DataFrame, action: str, token: str) -> bool:
        """Apply one changeset under a name that identifies it; False when it was applied before."""
        if action not in ACTIONS:
            raise ValueError(f"action must be one of {ACTIONS}, not {action!r}")
        if not re.fullmatch(r"[\w-]+", token):
            raise ValueError(f"token with characters that are not allowed: {token!r}")
        state, mark = self._state(), f"{self.root}/applied/{token}"
        if files.exists(self.spark, mark) or state["token"] == token:
            files.write_text(self.spark, mark, "")
            return False
        if state["token"]:  # known for good before its version is followed by another
            files.write_text(self.spark, f"{self.root}/applied/{state['token']}", "")
        number = state["number"] + 1
        columns = [c for c in self.schema.fieldNames() if c in batch.columns]
        rows = batch.select([F.col(quote_column(c)) for c in columns])
        rows = rows if action == "upsert" else rows.dropna(subset=self.keys)
        changed = {"upsert": self._upserted, "update": self._updated, "delete": self._deleted}[action](rows, F.lit(number).cast("long"))
        added = self._store(changed, f"{number:012d}-{token}")
        base, additions = state["base"], [*state["added"], added]
        if base is None or sum(f["bytes"] for f in additions) > self.merge_ratio * base["bytes"]:
            base, additions = self._store(self._merged(self._rows([f["name"] for f in [base, *additions] if f])), f"{number:012d}-{token}-base"), []
        elif len(additions) > self.max_additions:
            additions = [self._store(self._merged(self._rows([f["name"] for f in additions])), f"{number:012d}-{token}-added")]
        self._commit({"number": number, "token": token, "base": base, "added": additions})
        files.write_text(self.spark, mark, "")
        return True

    def _at(self, number: Column) -> Column:
        return F.struct([*(_c(c).alias(f"o{i}") for i, c in enumerate(self.order_by)), number.alias(VERSION)]).cast(self.place)

    def _change(self, rows: DataFrame, life: Column | None, sets: Column | None) -> DataFrame:
        """Rows as they are stored; columns that they do not bring are NULL."""
        columns = [_c(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        life_type, set_type = self.stored[LIFE].dataType, self.stored[SET].dataType
        life = (life if life is not None else F.lit(None)).cast(life_type).alias(LIFE)
        return rows.select(*columns, life, (sets if sets is not None else F.lit(None)).cast(set_type).alias(SET))

    def _last(self, rows: DataFrame) -> DataFrame:
        """One row for each key of a batch; rows without a whole key each."""
        whole = latest(rows.filter(self._whole()), self.keys, [c for c in self.order_by if c in rows.columns])
        return whole.unionByName(rows.filter(f"NOT ({self._whole()})"))

    def _upserted(self, rows: DataFrame, number: Column) -> DataFrame:
        if set(rows.columns) != set(self.schema.fieldNames()):
            raise ValueError("an upsert stream needs complete rows")
        return self._change(self._last(rows), F.struct(self._at(number).alias("at"), F.lit(True).alias("there")), None)

    def _updated(self, rows: DataFrame, number: Column) -> DataFrame:
        """The columns that a batch sets, at its places."""
        changes = self._last(rows)
        given = [c for c in self.rest if c in changes.columns]
        if not all(c in changes.columns for c in self.order_by):
            standing = self.read().select([_c(c) for c in dict.fromkeys([*self.keys, *(c for c in self.order_by if c not in changes.columns)])])
            changes = changes.join(standing, self.keys)
        at = self._at(number)
        sets = [(at if c in given else F.lit(None).cast(self.place)).alias(f"c{i}") for i, c in enumerate(self.rest)]
        return self._change(changes, None, F.struct(sets or [F.lit(None).cast("boolean").alias("none")]))

    def _deleted(self, rows: DataFrame, number: Column) -> DataFrame:
        """Deletes stand at the order they bring; without one, at that of the row they remove."""
        if all(c in rows.columns for c in self.order_by):
            gone = latest(rows.select(list(dict.fromkeys([*self.keys, *self.order_by]))), self.keys, self.order_by)
        else:
            gone = self.read().join(rows.select(self.keys).distinct(), self.keys, "left_semi")
        life = F.struct(self._at(number).alias("at"), F.lit(False).alias("there"))
        return self._change(gone, life, F.struct([F.lit(None).cast(f.dataType).alias(f.name) for f in self.places.fields]))

    def _store(self, rows: DataFrame, name: str) -> dict:
        path = f"{self.root}/data/{name}"
        rows.select(self.stored.fieldNames()).write.mode("overwrite").parquet(path)
        return {"name": name, "bytes": files.total_bytes(self.spark, path)}

    def _commit(self, state: dict) -> None:
        """Writes the version. The version file is itself the claim: only one writer can create it, and one that dies
        before that leaves nothing that stands in another's way."""
        if not files.create_whole(self.spark, f"{self.root}/versions/{state['number']:012d}", json.dumps(state)):
            raise RuntimeError(f"version {state['number']} of {self.root} was written by another run")

    def vacuum(self) -> int:
        """Remove folders that the table no longer needs, and older versions. Run it while nothing reads or writes. The
        batches that were applied stay known."""
        state, removed = self._state(), 0
        needed = {f["name"] for f in [state["base"], *state["added"]] if f}
        for entry in files.entries(self.spark, f"{self.root}/data"):
            if entry.name not in needed:
                files.remove(self.spark, entry.path)
                removed += 1
        for entry in files.entries(self.spark, f"{self.root}/versions"):
            if entry.name != f"{state['number']:012d}":
                files.remove(self.spark, entry.path)
        return removed


def apply_stream(stream: DataFrame, table: KeyedTable, action: str, checkpoint: str) -> None:
    """Apply every new batch of a stream of changes, then stop."""
    _run(stream, checkpoint, lambda df, token: table.apply(df, action, token))
