"""Assumed keys of a set of tables: declaring, checking, and joining along them."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stillroom.functions.expressions import quote_column

PRIMARY_META = "primary_key"
FOREIGN_META = "foreign_keys"


class ModelError(ValueError):
    """The keys do not form the tree that a joined data set needs."""


@dataclass(frozen=True)
class PrimaryKey:
    table: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class ForeignKey:
    table: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass
class Model:
    """Keys that are declared, never enforced; ``check_keys`` tests them."""

    primary: list[PrimaryKey] = field(default_factory=list)
    foreign: list[ForeignKey] = field(default_factory=list)

    def primary_key(self, table: str, *columns: str) -> Model:
        self.primary.append(PrimaryKey(table, columns))
        return self

    def foreign_key(self, table: str, columns: Sequence[str] | str, parent: str, parent_columns: Sequence[str] | str) -> Model:
        own = (columns,) if isinstance(columns, str) else tuple(columns)
        theirs = (parent_columns,) if isinstance(parent_columns, str) else tuple(parent_columns)
        if len(own) != len(theirs):
            raise ModelError("both sides of a foreign key need as many columns")
        self.foreign.append(ForeignKey(table, own, parent, theirs))
        return self


def tag_keys(df: DataFrame, table: str, model: Model) -> DataFrame:
    """Record a table's keys in its column metadata, which Parquet keeps."""
    notes: dict[str, dict] = {}
    for key in model.primary:
        if key.table == table:
            for name in key.columns:
                notes.setdefault(name, {})[PRIMARY_META] = list(key.columns)
    for key in model.foreign:
        if key.table == table:
            first = notes.setdefault(key.columns[0], {})
            first.setdefault(FOREIGN_META, []).append(json.dumps([list(key.columns), key.parent, list(key.parent_columns)]))
    columns = []
    for f in df.schema.fields:
        metadata = {**(f.metadata or {}), **notes.get(f.name, {})}
        columns.append(F.col(quote_column(f.name)).alias(f.name, metadata=metadata))
    return df.select(columns)


def model_of(frames: Mapping[str, DataFrame]) -> Model:
    """Read the keys back from tagged tables."""
    model = Model()
    for table, df in frames.items():
        primary = None
        for f in df.schema.fields:
            primary = primary or f.metadata.get(PRIMARY_META)
            for text in f.metadata.get(FOREIGN_META, []):
                own, parent, theirs = json.loads(text)
                model.foreign_key(table, own, parent, theirs)
        if primary:
            model.primary_key(table, *primary)
    return model


def check_keys(frames: Mapping[str, DataFrame], model: Model) -> DataFrame:
    """``(check_name, violations)``: surplus rows per primary key, rows without parent per foreign key.

    Rows are counted per key value first, on the map side, so a value that holds much of a table costs no
    more than any other.
    """
    checks = []
    for key in model.primary:
        counted = frames[key.table].groupBy([F.col(quote_column(c)) for c in key.columns]).agg(F.count(F.lit(1)).alias("__n"))
        surplus = counted.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("violations"))
        checks.append(surplus.select(F.lit(f"{key.table}_pk").alias("check_name"), "violations"))
    for key in model.foreign:
        child = frames[key.table].select([F.col(quote_column(c)).alias(f"__k{i}") for i, c in enumerate(key.columns)])
        child = child.dropna().groupBy(child.columns).agg(F.count(F.lit(1)).alias("__n"))
        parent = frames[key.parent].select([F.col(quote_column(c)).alias(f"__k{i}") for i, c in enumerate(key.parent_columns)]).distinct()
        orphans = child.join(parent, [f"__k{i}" for i in range(len(key.columns))], "left_anti")
        total = orphans.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("violations"))
        checks.append(total.select(F.lit(f"{key.table}_{key.parent}_fk").alias("check_name"), "violations"))
    if not checks:
        raise ModelError("the model declares no keys")
    return reduce(DataFrame.unionByName, checks)


def join_tree(model: Model, tables: Sequence[str]) -> list[ForeignKey]:
    """Foreign keys in joining order from the one table nothing refers to, or an error.

    The keys must form one tree over all tables: one root, every other table referred to exactly once.
    """
    tables = list(tables)
    unknown = {t for k in model.foreign for t in (k.table, k.parent)} - set(tables)
    if unknown:
        raise ModelError(f"keys on tables that do not exist: {sorted(unknown)}")
    incoming: dict[str, list[ForeignKey]] = {t: [] for t in tables}
    for key in model.foreign:
        incoming[key.parent].append(key)
    roots = [t for t in tables if not incoming[t]]
    if len(roots) != 1:
        raise ModelError(f"exactly one table must have no incoming key, found {roots}")
    shared = [t for t in tables if len(incoming[t]) > 1]
    if shared:
        raise ModelError(f"tables that several keys refer to: {shared}")
    order, reached = [], [roots[0]]
    for table in reached:
        for key in (k for k in model.foreign if k.table == table):
            order.append(key)
            reached.append(key.parent)
    if set(reached) != set(tables):
        raise ModelError(f"tables the keys do not reach: {sorted(set(tables) - set(reached))}")
    return order


def denormalise(frames: Mapping[str, DataFrame], model: Model) -> DataFrame:
    """All tables of the tree joined from its root outwards; a repeated column name gets its table's name in front.

    Rows of the root are kept whether or not they have parents. The root stays on the left, so skew in its
    keys splits over tasks.
    """
    order = join_tree(model, list(frames))
    root = order[0].table if order else next(iter(frames))
    names = [c for df in frames.values() for c in df.columns]
    final = {
        (table, c): c if names.count(c) == 1 else f"{table}_{c}" for table, df in frames.items() for c in df.columns
    }

    def renamed(table: str) -> DataFrame:
        return frames[table].select([F.col(quote_column(c)).alias(final[table, c]) for c in frames[table].columns])

    joined = renamed(root)
    for key in order:
        on = [
            F.col(quote_column(final[key.table, own])) == F.col(quote_column(final[key.parent, theirs]))
            for own, theirs in zip(key.columns, key.parent_columns)
        ]
        joined = joined.join(renamed(key.parent), on, "left")
    return joined
