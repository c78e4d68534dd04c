"""Row maintenance: delete, update, insert, upsert and ordered batches of them.

Each function takes the current state of a table and returns the new one; a write follows once, at the end.
Keys match by SQL equality, so NULL keys match nothing.

A changeset is stored in the shared folder when the function is called, and its keys are tested there. That
gives the planner its exact size (it broadcasts only what is small), computes it once, and lets adaptive
execution split a hot key: the target is always the left side of the join, and the rule that splits it needs
both sides to come straight from a shuffle, without an aggregate in between. No join fans out.

Where an ``impact`` observation is given, its ``rows`` metric is the number of rows hit. In a plain write it
is taken in the last stage, whose tasks count once each. A write that shuffles afterwards (by partition) may
repeat an earlier stage after a lost executor and count twice: use ``count_where`` or ``count_matching`` there.
"""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stillroom.functions.expressions import quote_column
from stillroom.operators.conditions import SOURCE_PREFIX, Match, match_on, parse_condition
from stillroom.schema import align, convert, enforce_not_null
from stillroom.session import scratch_path

FLAG = "__hit"

Pairs = Sequence[Sequence[str]]


class DuplicateKeyError(ValueError):
    """A changeset holds a key more than once."""


def _c(name: str) -> Column:
    return F.col(quote_column(name))


def _as_match(match: Match | Pairs) -> Match:
    return match if isinstance(match, Match) else match_on(match)


def _not_true(condition: Column) -> Column:
    return ~condition | condition.isNull()


def delete_where(df: DataFrame, condition: Column, impact: Observation | None = None) -> DataFrame:
    """``DELETE … WHERE``: a row whose condition is NULL stays."""
    if impact is not None:
        df = df.observe(impact, F.count_if(condition).alias("rows"))
    return df.filter(_not_true(condition))


def delete_all(df: DataFrame) -> DataFrame:
    return df.filter(F.lit(False))


def delete_matching(df: DataFrame, keys: DataFrame, match: Match | Pairs, impact: Observation | None = None, strict: bool = True) -> DataFrame:
    """Delete every row that has a partner among ``keys``.

    With ``strict`` the changeset may hold only columns the match refers to.
    """
    match = _as_match(match)
    if strict:
        surplus = sorted(set(keys.columns) - match.source_columns)
        if surplus:
            raise ValueError(f"changeset columns the condition does not use: {surplus}")
    source = settled(prefixed(keys, sorted(match.source_columns), match).distinct(), "delete-keys")
    if match.predicate is None and impact is not None:
        marked = df.join(source.withColumn(FLAG, F.lit(True)), _on(match), "left")
        marked = marked.observe(impact, F.count_if(_c(FLAG)).alias("rows"))
        return marked.filter(_c(FLAG).isNull()).select([_c(c) for c in df.columns])
    kept = df.join(source, _on(match), "left_anti")
    if impact is None:
        return kept
    raise ValueError("impact counts need a match by key pairs only")


def update_where(df: DataFrame, assignments: Mapping[str, Column], condition: Column, impact: Observation | None = None) -> DataFrame:
    """``UPDATE … SET … WHERE``: all right sides see the row as it was."""
    unknown = sorted(set(assignments) - set(df.columns))
    if unknown:
        raise ValueError(f"assignment to columns that do not exist: {unknown}")
    if impact is not None:
        df = df.observe(impact, F.count_if(condition).alias("rows"))
    columns = []
    for field in df.schema.fields:
        old = _c(field.name)
        if field.name in assignments:
            old = F.when(condition, assignments[field.name].cast(field.dataType)).otherwise(old)
        columns.append(old.alias(field.name))
    return df.select(columns)


def update_from(df: DataFrame, changes: DataFrame, match: Match | Pairs, impact: Observation | None = None) -> DataFrame:
    """Overwrite the shared non-key columns of every matching row with the changeset's values."""
    match = _as_match(match)
    wanted = sorted(set(_assigned_columns(df, changes, match)) | match.source_columns)
    source = _stored_once(changes, wanted, match)
    return updated_by(df, source, changes.schema, match, impact)


def updated_by(df: DataFrame, source: DataFrame, changes_schema: T.StructType, match: Match, impact: Observation | None = None) -> DataFrame:
    """The target with the values of ``source``, prefixed rows that hold each key once."""
    target_keys = {t for _, t in match.pairs}
    assigned = [c for c in df.columns if SOURCE_PREFIX + c in source.columns and c not in target_keys and c not in match.source_columns]
    joined = df.join(source.withColumn(FLAG, F.lit(True)), _on(match), "left")
    if impact is not None:
        joined = joined.observe(impact, F.count_if(_c(FLAG)).alias("rows"))
    source_types = {f.name: f.dataType for f in changes_schema.fields}
    columns = []
    for field in df.schema.fields:
        value = _c(field.name)
        if field.name in assigned:
            new = convert(_c(SOURCE_PREFIX + field.name), source_types[field.name], field.dataType)
            value = F.when(_c(FLAG), new).otherwise(value)
        columns.append(value.alias(field.name))
    return joined.select(columns)


def insert_from(df: DataFrame, changes: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Append the changeset by column name; absent columns become NULL, which raises where declared NOT NULL."""
    added = align(changes, df.schema)
    return df.unionByName(enforce_not_null(added, schema) if schema is not None else added)


def upsert(
    df: DataFrame, changes: DataFrame, match: Match | Pairs, unique_target: bool = False, updated: Observation | None = None, inserted: Observation | None = None
) -> DataFrame:
    """Update the rows that match, insert the changes that match none.

    With ``unique_target`` (the target's key is known to be unique) and a changeset of complete rows, matched
    rows are simply replaced, which reads the target once. The observations count rows updated and inserted.
    """
    match = _as_match(match)
    if match.predicate is not None:
        raise ValueError("upsert matches by key equality only")
    renames = {source: target for source, target in match.pairs}
    complete = {renames.get(c, c) for c in changes.columns} == set(df.columns)
    _assigned_columns(df, changes, match)
    source = _stored_once(changes, changes.columns, match)
    keyless = changes.filter(reduce(operator.or_, [_c(s).isNull() for s, _ in match.pairs]))

    def as_target(rows: DataFrame, prefix: str) -> DataFrame:
        return align(rows.select([_c(prefix + c).alias(renames.get(c, c)) for c in changes.columns]), df.schema)

    inserted_anyway = as_target(keyless, "")
    if unique_target and complete and updated is None and inserted is None:
        keys = source.select([_c(SOURCE_PREFIX + s) for s, _ in match.pairs])
        kept = df.join(keys, _on(match), "left_anti")
        return kept.unionByName(as_target(source, SOURCE_PREFIX)).unionByName(inserted_anyway)

    # Keys both sides have: only the target's key columns are read, copies of a key collapse on the map side, and
    # the result is no larger than the changeset. A changeset small enough to broadcast filters before that.
    target_keys = df.select([_c(t) for _, t in match.pairs]).distinct()
    known = target_keys.join(source, _on(match), "left_semi")
    known = known.select([_c(t).alias("__known_" + s) for s, t in match.pairs])
    absent = source.join(known, [_c(SOURCE_PREFIX + s) == _c("__known_" + s) for s, _ in match.pairs], "left_anti")
    added = as_target(absent, SOURCE_PREFIX).unionByName(inserted_anyway)
    if inserted is not None:
        added = added.observe(inserted, F.count(F.lit(1)).alias("rows"))
    return updated_by(df, source, changes.schema, match, updated).unionByName(added)


def rolling_window(df: DataFrame, window_rows: DataFrame, date_column: str, cutoff: Column, impact: Observation | None = None) -> DataFrame:
    """Replace everything on or after ``cutoff`` by freshly read rows."""
    return insert_from(delete_where(df, _c(date_column) >= cutoff, impact), window_rows)


def apply_change(
    df: DataFrame,
    action: str,
    changes: DataFrame | None = None,
    *,
    match_columns: Pairs | None = None,
    match_condition: Mapping | None = None,
    unique_target: bool = False,
) -> DataFrame:
    """One update, delete, insert or upsert, matched by key pairs or by a condition, never both."""
    action = action.lower()
    if action == "insert":
        if changes is None:
            raise ValueError("insert needs a changeset")
        if match_columns is not None or match_condition is not None:
            raise ValueError("insert takes no match")
        return insert_from(df, changes)
    if (match_columns is None) == (match_condition is None):
        raise ValueError("give either match columns or a match condition")
    match = match_on(match_columns) if match_columns is not None else parse_condition(match_condition, df.schema)
    if action == "delete":
        if changes is None:
            if match.pairs:
                raise ValueError("a delete by key needs a changeset")
            return delete_where(df, match.predicate)
        if not match.pairs:
            raise ValueError("a delete with a changeset needs a key equality")
        return delete_matching(df, changes, match)
    if changes is None:
        raise ValueError(f"{action} needs a changeset")
    if not match.pairs:
        raise ValueError(f"{action} needs a key equality")
    if action == "update":
        return update_from(df, changes, match)
    if action == "upsert":
        return upsert(df, changes, match, unique_target)
    raise ValueError(f"unknown action {action!r}")


def apply_actions(df: DataFrame, actions: Sequence[Mapping], changes: Mapping[str, DataFrame] | DataFrame | None = None, unique_target: bool = False) -> DataFrame:
    """Apply an ordered list of actions; each names its changeset by ``source-table``. The target is written once, by the caller."""
    if isinstance(changes, DataFrame):
        named = None
    else:
        named = dict(changes or {})
    for request in actions:
        table = request.get("source-table")
        if table is None:
            source = None
        elif named is None:
            source = changes
        elif table in named:
            source = named[table]
        else:
            raise ValueError(f"no changeset named {table!r}")
        df = apply_change(df, request["action"], source, match_condition=request.get("condition"), unique_target=unique_target)
    return df


def settled(df: DataFrame, label: str) -> DataFrame:
    """Store a small intermediate table in the shared folder and read it from there."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def count_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows a condition would hit, as a one-row frame."""
    return df.agg(F.count_if(condition).alias("n"))


def count_matching(df: DataFrame, keys: DataFrame, match: Match | Pairs) -> DataFrame:
    """Rows a changeset would hit, as a one-row frame.

    Target rows are counted per key before they meet the changeset, so a hot key moves as a few partial counts.
    """
    match = _as_match(match)
    if match.predicate is not None:
        raise ValueError("counts need a match by key pairs only")
    counted = df.groupBy([_c(t) for _, t in match.pairs]).agg(F.count(F.lit(1)).alias("__n"))
    source = prefixed(keys, sorted(match.source_columns), match).distinct()
    return counted.join(source, _on(match), "left_semi").agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("n"))


def prefixed(changes: DataFrame, columns: Sequence[str], match: Match) -> DataFrame:
    """Changeset rows that can match at all, columns renamed so that they never clash with the target's."""
    missing = sorted(set(columns) - set(changes.columns))
    if missing:
        raise ValueError(f"changeset lacks columns: {missing}")
    matchable = reduce(operator.and_, [_c(s).isNotNull() for s, _ in match.pairs])
    return changes.filter(matchable).select([_c(c).alias(SOURCE_PREFIX + c) for c in columns])


def _on(match: Match) -> Column:
    keys = [_c(target) == _c(SOURCE_PREFIX + source) for source, target in match.pairs]
    return reduce(operator.and_, keys if match.predicate is None else keys + [match.predicate])


def _stored_once(changes: DataFrame, columns: Sequence[str], match: Match) -> DataFrame:
    """The changeset's matchable rows, stored; raises when a key occurs twice. The test reads key columns only."""
    stored = settled(prefixed(changes, columns, match), "changes")
    keys = [_c(SOURCE_PREFIX + s) for s, _ in match.pairs]
    repeated = stored.groupBy(keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > 1)
    if not repeated.isEmpty():
        raise DuplicateKeyError("the changeset holds a key more than once")
    return stored


def _assigned_columns(df: DataFrame, changes: DataFrame, match: Match) -> list[str]:
    target = set(df.columns)
    source_keys = {s for s, _ in match.pairs}
    target_keys = {t for _, t in match.pairs}
    unknown = sorted(set(changes.columns) - target - match.source_columns)
    if unknown:
        raise ValueError(f"changeset columns that the target does not have: {unknown}")
    return [c for c in changes.columns if c in target and c not in target_keys and c not in source_keys]
