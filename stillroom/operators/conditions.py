"""Match conditions of change requests, given as JSON-like dictionaries, turned into column expressions.

A comparison names a target column and either a source column or a typed constant::

    {"op": "lt", "target-col": "day", "const": {"type": "datetime", "v": "2018-02-01T00:00:00Z"}}
    {"op": "and", "args": [{"op": "eq", "source-col": "id", "target-col": "id"}, ...]}
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stillroom.functions.expressions import quote_column

# Comparison names and their symbols.
COMPARISONS: dict[str, Callable] = {
    "eq": operator.eq,
    "=": operator.eq,
    "neq": operator.ne,
    "<>": operator.ne,
    "lt": operator.lt,
    "<": operator.lt,
    "lte": operator.le,
    "<=": operator.le,
    "gt": operator.gt,
    ">": operator.gt,
    "gte": operator.ge,
    ">=": operator.ge,
}

SOURCE_PREFIX = "__source_"


@dataclass(frozen=True)
class Match:
    """How rows of a changeset and of a target belong together.

    ``pairs`` are equality keys as (source column, target column); ``predicate`` is what else must hold. In it
    source columns carry ``SOURCE_PREFIX``.
    """

    pairs: list[tuple[str, str]] = field(default_factory=list)
    predicate: Column | None = None
    source_columns: frozenset[str] = frozenset()
    target_columns: frozenset[str] = frozenset()


def match_on(columns: Sequence[Sequence[str]]) -> Match:
    """Match by key pairs ``[[source, target], …]``."""
    pairs = [(source, target) for source, target in columns]
    if not pairs:
        raise ValueError("at least one key pair is needed")
    return Match(pairs, None, frozenset(s for s, _ in pairs), frozenset(t for _, t in pairs))


def parse_condition(condition: Mapping, target_schema: T.StructType) -> Match:
    """Split a condition into equality keys and a remaining predicate.

    A condition on source columns must hold at least one key equality in its top-level conjunction, so that
    it always runs as an equi-join.
    """
    conjuncts = condition["args"] if condition.get("op") == "and" else [condition]
    pairs, others = [], []
    source_columns, target_columns = set(), set()
    for part in conjuncts:
        _collect(part, source_columns, target_columns)
        if part.get("op") in ("eq", "=") and "source-col" in part:
            pairs.append((part["source-col"], part["target-col"]))
        else:
            others.append(_predicate(part, target_schema))
    unknown = target_columns - set(target_schema.fieldNames())
    if unknown:
        raise ValueError(f"condition on columns that the target does not have: {sorted(unknown)}")
    if source_columns and not pairs:
        raise ValueError("a condition on source columns needs an equality between a source and a target column")
    predicate = reduce(operator.and_, others) if others else None
    return Match(pairs, predicate, frozenset(source_columns), frozenset(target_columns))


def _collect(part: Mapping, source: set, target: set) -> None:
    for child in part.get("args", []):
        _collect(child, source, target)
    if "source-col" in part:
        source.add(part["source-col"])
    if "target-col" in part:
        target.add(part["target-col"])


def _predicate(part: Mapping, schema: T.StructType) -> Column:
    op = part.get("op")
    if op in ("and", "or"):
        if not part.get("args"):
            raise ValueError(f"{op} needs arguments")
        return reduce(operator.and_ if op == "and" else operator.or_, [_predicate(p, schema) for p in part["args"]])
    if op == "not":
        (only,) = part["args"]
        return ~_predicate(only, schema)
    if op not in COMPARISONS:
        raise ValueError(f"unknown operation {op!r}")
    if "target-col" not in part or ("source-col" in part) == ("const" in part):
        raise ValueError("a comparison needs a target column and either a source column or a constant")
    name = part["target-col"]
    if name not in schema.fieldNames():
        raise ValueError(f"condition on a column that the target does not have: {name}")
    if "const" in part and part["const"]["type"] == "datetime" and part["const"]["v"] is not None and isinstance(schema[name].dataType, T.DateType):
        return _day_compared(F.col(quote_column(name)), COMPARISONS[op], _moment(part["const"]["v"]))
    if "const" in part:
        other = constant(part["const"], schema[name].dataType)
    else:
        other = F.col(quote_column(SOURCE_PREFIX + part["source-col"]))
    return COMPARISONS[op](F.col(quote_column(name)), other)


def _moment(text: str) -> datetime:
    moment = datetime.fromisoformat(text)
    return moment if moment.tzinfo is None else moment.astimezone(timezone.utc).replace(tzinfo=None)


def _day_compared(day: Column, compare: Callable, moment: datetime) -> Column:
    """A date column against a moment, as a comparison of dates that reaches the scan. A day is its first instant: it
    lies before a later moment of itself, and equals none."""
    if moment.time() == datetime.min.time():
        return compare(day, F.lit(moment.date()))
    if compare in (operator.lt, operator.le):
        return day <= F.lit(moment.date())
    if compare in (operator.gt, operator.ge):
        return day > F.lit(moment.date())
    return day.isNull() & day.isNotNull() if compare is operator.eq else day.isNotNull()


def constant(const: Mapping, target_type: T.DataType) -> Column:
    """A typed constant as a literal of the target column's type, so that the comparison can push down."""
    kind, value = const["type"], const["v"]
    if value is None:
        return F.lit(None).cast(target_type)
    if kind == "datetime":
        text = _moment(value).isoformat(sep=" ")
        if isinstance(target_type, T.TimestampType):
            return F.lit(text + "Z").cast("timestamp_ltz")
        return F.lit(text).cast("timestamp_ntz")
    if kind == "date":
        return F.lit(date.fromisoformat(value))
    if kind in ("int", "integer", "bigint"):
        return F.lit(int(value))
    if kind in ("double", "numeric", "decimal"):
        return F.lit(float(value)) if kind == "double" else F.lit(str(value)).cast(target_type)
    if kind in ("string", "text"):
        return F.lit(str(value))
    if kind in ("bool", "boolean"):
        return F.lit(value if isinstance(value, bool) else {"true": True, "false": False}[str(value).lower()])
    raise ValueError(f"unknown constant type {kind!r}")
