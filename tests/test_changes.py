import datetime as dt
import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from stillroom.operators import changes as ch
from stillroom.operators.conditions import match_on, parse_condition
from stillroom.operators.tables import discard
from stillroom.schema import struct_from_types

TARGET = "k int, name string, points double"
ROWS = [(1, "a", 1.0), (2, "b", 2.0), (None, "n", 3.0), (4, None, 4.0), (4, "d", 5.0)]


@pytest.fixture()
def target(spark):
    return spark.createDataFrame(ROWS, TARGET)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same(df, expected):
    assert rows(df) == sorted(expected, key=repr)


# --- delete ---------------------------------------------------------------------------------------------


def test_delete_keeps_rows_whose_condition_is_null(target):
    same(ch.delete_where(target, F.col("name") != "b"), [(2, "b", 2.0), (4, None, 4.0)])


def test_delete_counts(target):
    hit = Observation()
    discard(ch.delete_where(target, F.col("k") == 4, hit))
    assert hit.get["rows"] == 2


def test_delete_range_condition_reaches_the_scan(spark, target, path):
    target.write.parquet(path("t"))
    df = ch.delete_where(spark.read.parquet(path("t")), F.col("k") < 3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(GreaterThanOrEqual(k,3),IsNull(k))]" in plan


def test_delete_matching(spark, target):
    keys = spark.createDataFrame([(4,), (4,), (None,), (9,)], "id int")
    same(ch.delete_matching(target, keys, [["id", "k"]]), [ROWS[0], ROWS[1], ROWS[2]])
    hit = Observation()
    df = ch.delete_matching(target, keys, [["id", "k"]], hit)
    same(df, [ROWS[0], ROWS[1], ROWS[2]])
    assert hit.get["rows"] == 2
    assert ch.count_matching(target, keys, [["id", "k"]]).first()["n"] == 2
    same(ch.delete_matching(target, keys.limit(0), [["id", "k"]]), ROWS)


def test_delete_changeset_may_not_hold_other_columns(spark, target):
    keys = spark.createDataFrame([(4, "x")], "id int, extra string")
    with pytest.raises(ValueError, match="does not use"):
        ch.delete_matching(target, keys, [["id", "k"]])
    with pytest.raises(ValueError, match="lacks"):
        ch.delete_matching(target, keys, [["nothing", "k"]], strict=False)


def test_delete_all(target):
    assert ch.delete_all(target).count() == 0
    assert ch.delete_all(target).columns == target.columns


def test_delete_by_key_and_residual(spark, target):
    condition = {"op": "and", "args": [{"op": "eq", "source-col": "id", "target-col": "k"}, {"op": "lt", "target-col": "points", "source-col": "upto"}]}
    keys = spark.createDataFrame([(4, 4.5), (1, 0.5)], "id int, upto double")
    same(ch.apply_change(target, "delete", keys, match_condition=condition), [r for r in ROWS if r[2] != 4.0])


# --- update ---------------------------------------------------------------------------------------------


def test_update_where_sees_old_values(target):
    df = ch.update_where(target, {"points": F.col("points") + 50, "name": F.col("points").cast("string")}, F.col("k") == 1)
    same(df, [(1, "1.0", 51.0)] + ROWS[1:])
    with pytest.raises(ValueError):
        ch.update_where(target, {"zz": F.lit(1)}, F.lit(True))


def test_update_counts(target):
    hit = Observation()
    discard(ch.update_where(target, {"points": F.lit(0.0)}, F.col("name") == "a", hit))
    assert hit.get["rows"] == 1


def test_update_from(spark, target):
    changed = spark.createDataFrame([(4, None), (9, 9), (None, 7)], "k int, points int")
    hit = Observation()
    df = ch.update_from(target, changed, [["k", "k"]], hit)
    same(df, ROWS[:3] + [(4, None, None), (4, "d", None)])
    assert hit.get["rows"] == 2


def test_update_key_names_may_differ(spark, target):
    changed = spark.createDataFrame([(2, "B")], "id int, name string")
    same(ch.update_from(target, changed, [["id", "k"]]), [ROWS[0], (2, "B", 2.0)] + ROWS[2:])


def test_duplicate_changeset_key_raises(spark, target):
    changed = spark.createDataFrame([(2, "x"), (2, "y")], "k int, name string")
    with pytest.raises(ch.DuplicateKeyError):
        ch.update_from(target, changed, [["k", "k"]])
    unmatched = spark.createDataFrame([(77, "x", 1.0), (77, "y", 1.0)], TARGET)
    for unique in (False, True):
        with pytest.raises(ch.DuplicateKeyError):
            ch.upsert(target, unmatched, [["k", "k"]], unique)


def test_update_with_unknown_column_raises(spark, target):
    with pytest.raises(ValueError, match="does not have"):
        ch.update_from(target, spark.createDataFrame([(2, 1)], "k int, zz int"), [["k", "k"]])


# --- insert and upsert -------------------------------------------------------------------------------------


def test_insert_by_name(spark, target):
    same(ch.insert_from(target, spark.createDataFrame([("z", 7)], "name string, k int")), ROWS + [(7, "z", None)])
    schema = struct_from_types([("k", "int"), ("name", "text"), ("points", "double", False)])
    with pytest.raises(Exception, match="NULL in column points"):
        ch.insert_from(target, spark.createDataFrame([("z", 7)], "name string, k int"), schema).collect()


def test_upsert_complete_rows(spark, target):
    changed = spark.createDataFrame([(2, "B", 20.0), (9, "i", 9.0), (None, "m", 0.0), (None, "m", 0.0)], TARGET)
    expected = [ROWS[0], (2, "B", 20.0)] + ROWS[2:] + [(9, "i", 9.0), (None, "m", 0.0), (None, "m", 0.0)]
    same(ch.upsert(target, changed, [["k", "k"]]), expected)
    unique = target.filter("k is null or k <> 4")
    same(ch.upsert(unique, changed, [["k", "k"]], unique_target=True), [r for r in expected if r[0] != 4])


def test_upsert_updates_every_matching_row(spark, target):
    same(ch.upsert(target, spark.createDataFrame([(4, "D", 0.0)], TARGET), [["k", "k"]]), ROWS[:3] + [(4, "D", 0.0), (4, "D", 0.0)])


def test_upsert_into_empty_and_from_empty(spark, target):
    same(ch.upsert(target.limit(0), target.filter("k < 3"), [["k", "k"]]), ROWS[:2])
    same(ch.upsert(target, target.limit(0), [["k", "k"]]), ROWS)


def brute_upsert(target, changes):
    keyed = {c[0]: c for c in changes if c[0] is not None}
    present = {t[0] for t in target}
    result = [keyed.get(t[0], t) if t[0] is not None else t for t in target]
    return result + [c for c in changes if c[0] is None or c[0] not in present]


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_changes_against_brute_force_with_a_hot_key(spark, threshold):
    """A third of the target under one key, joined both by broadcast and by sort-merge with skew splitting."""
    rng = random.Random(7)
    target = [(0 if rng.random() < 0.34 else rng.randrange(1, 60), f"t{i}", float(i)) for i in range(900)]
    keys = rng.sample(range(0, 90), 40) + [0]
    changed = [(k, f"c{k}", -1.0) for k in sorted(set(keys))] + [(None, "n", 0.0)]
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        t, c = spark.createDataFrame(target, TARGET), spark.createDataFrame(changed, TARGET)
        same(ch.upsert(t, c, [["k", "k"]]), brute_upsert(target, changed))
        hit = {x[0] for x in changed}
        same(ch.delete_matching(t, c.select("k"), [["k", "k"]]), [x for x in target if x[0] not in hit])
        by_key = {x[0]: x for x in changed}
        same(ch.update_from(t, c, [["k", "k"]]), [by_key.get(x[0], x) for x in target])
        assert ch.count_matching(t, c.select("k"), [["k", "k"]]).first()["n"] == sum(x[0] in hit for x in target)
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_composite_key(spark):
    t = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, None, 3)], "a int, b string, n int")
    c = spark.createDataFrame([(1, "y", 20), (2, None, 30), (3, "z", 40)], "sa int, sb string, n int")
    same(ch.upsert(t, c, [["sa", "a"], ["sb", "b"]]), [(1, "x", 1), (1, "y", 20), (2, None, 3), (2, None, 30), (3, "z", 40)])


# --- conditions and action batches --------------------------------------------------------------------------


EVENTS = "id int, day timestamp_ntz, n int"


@pytest.fixture()
def events(spark):
    return spark.createDataFrame([(i, dt.datetime(2024, 1, i), i) for i in range(1, 11)] + [(99, None, 0)], EVENTS)


def test_constants(events):
    def kept(op, text):
        condition = {"op": op, "target-col": "day", "const": {"type": "datetime", "v": text}}
        return sorted(r["id"] for r in ch.apply_change(events, "delete", match_condition=condition).collect())

    assert kept("lt", "2024-01-09T00:00:00Z") == [9, 10, 99]
    assert kept("<", "2024-01-09T00:00:00Z") == [9, 10, 99]
    assert kept("gte", "2024-01-03T00:00:00Z") == [1, 2, 99]
    assert kept("gt", "2024-01-03T01:00:00+01:00") == [1, 2, 3, 99]
    assert kept("gt", "2024-01-03T01:00:00+0100") == [1, 2, 3, 99]


def test_nested_conditions(events):
    condition = {
        "op": "or",
        "args": [
            {"op": "and", "args": [{"op": "gt", "target-col": "n", "const": {"type": "int", "v": 2}}, {"op": "lte", "target-col": "n", "const": {"type": "int", "v": 5}}]},
            {"op": "not", "args": [{"op": "neq", "target-col": "id", "const": {"type": "int", "v": 9}}]},
        ],
    }
    left = ch.apply_change(events, "delete", match_condition=condition)
    assert sorted(r["id"] for r in left.collect()) == [1, 2, 6, 7, 8, 10, 99]


def test_condition_errors(events):
    for wrong in (
        {"op": "like", "target-col": "n", "const": {"type": "int", "v": 1}},
        {"op": "lt", "target-col": "zz", "const": {"type": "int", "v": 1}},
        {"op": "lt", "target-col": "n"},
        {"op": "lt", "target-col": "n", "const": {"type": "blob", "v": 1}},
        {"op": "lt", "target-col": "n", "source-col": "m"},
    ):
        with pytest.raises(ValueError):
            parse_condition(wrong, events.schema)


def test_exactly_one_kind_of_match(spark, events):
    changed = spark.createDataFrame([(1,)], "id int")
    condition = {"op": "eq", "source-col": "id", "target-col": "id"}
    for arguments in ({}, {"match_columns": [["id", "id"]], "match_condition": condition}):
        for action in ("update", "delete", "upsert"):
            with pytest.raises(ValueError, match="either"):
                ch.apply_change(events, action, changed, **arguments)
    with pytest.raises(ValueError):
        ch.apply_change(events, "delete", match_columns=[["id", "id"]])
    with pytest.raises(ValueError):
        ch.apply_change(events, "update", match_columns=[["id", "id"]])
    with pytest.raises(ValueError):
        ch.apply_change(events, "insert")
    with pytest.raises(ValueError):
        ch.apply_change(events, "merge", changed, match_columns=[["id", "id"]])
    with pytest.raises(ValueError):
        match_on([])


def test_action_batch(spark, events):
    actions = [
        {"action": "delete", "condition": {"op": "gte", "target-col": "day", "const": {"type": "datetime", "v": "2024-01-04T00:00:00Z"}}},
        {"action": "insert", "source-table": "window"},
        {"action": "update", "source-table": "fixes", "condition": {"op": "eq", "source-col": "key", "target-col": "id"}},
        {"action": "delete", "source-table": "gone", "condition": {"op": "eq", "source-col": "id", "target-col": "id"}},
        {"action": "upsert", "source-table": "fixes", "condition": {"op": "eq", "source-col": "key", "target-col": "id"}},
    ]
    frames = {
        "window": spark.createDataFrame([(4, dt.datetime(2024, 1, 4), 400), (5, dt.datetime(2024, 1, 5), 500)], EVENTS),
        "fixes": spark.createDataFrame([(1, -1), (50, -50)], "key int, n int"),
        "gone": spark.createDataFrame([(2,), (5,)], "id int"),
    }
    result = ch.apply_actions(events, actions, frames)
    assert sorted((r["id"], r["n"]) for r in result.collect()) == [(1, -1), (3, 3), (4, 400), (50, -50), (99, 0)]
    with pytest.raises(ValueError, match="no changeset"):
        ch.apply_actions(events, actions, {})


def test_rolling_window(spark, events):
    fresh = spark.createDataFrame([(9, dt.datetime(2024, 1, 9), 90)], EVENTS)
    cutoff = F.lit("2024-01-08 00:00:00").cast("timestamp_ntz")
    result = ch.rolling_window(events, fresh, "day", cutoff)
    assert sorted((r["id"], r["n"]) for r in result.collect())[-3:] == [(7, 7), (9, 90), (99, 0)]
