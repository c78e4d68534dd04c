import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stillroom.operators.tables import write_table
from stillroom.streaming.apply import KeyedTable, append_stream, apply_stream, latest, read_stream, window_stream

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("at", T.LongType()), T.StructField("v", T.StringType())])


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def some_rows(n, seed=5):
    rng = random.Random(seed)
    return [(0 if rng.random() < 0.34 else rng.randrange(1, 40), i, f"v{i}") for i in range(n)]


def put(spark, data, folder, pieces=1):
    size = -(-len(data) // pieces)
    for i in range(0, len(data), size):
        spark.createDataFrame(data[i : i + size], SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def last_per_key(data):
    best = {}
    for row in data:
        if row[0] is not None and (row[0] not in best or row[1] > best[row[0]][1]):
            best[row[0]] = row
    return sorted(best.values())


def test_latest(spark):
    data = some_rows(200)
    assert rows(latest(spark.createDataFrame(data, SCHEMA), ["k"], ["at"])) == last_per_key(data)


def test_append_runs_take_each_file_once(spark, path):
    first, second = some_rows(20), some_rows(10, seed=6)
    put(spark, first, path("in"), 3)
    for _ in range(2):
        append_stream(read_stream(spark, path("in"), SCHEMA, files_per_batch=1), path("out"), path("cp"))
    assert rows(spark.read.parquet(path("out"))) == sorted(first)
    put(spark, second, path("in"))
    append_stream(read_stream(spark, path("in"), SCHEMA), path("out"), path("cp"))
    assert rows(spark.read.parquet(path("out"))) == sorted(first + second)


def test_appends_of_all_kinds_are_seen(spark, path):
    """First load, stream, batch and stream again, on a table partitioned by a column."""
    first, second, third, fourth = (some_rows(12, seed=s) for s in (1, 2, 3, 4))
    write_table(spark.createDataFrame(first, SCHEMA), path("t"), "create", partition_by=["k"])
    put(spark, second, path("in"), 3)
    append_stream(read_stream(spark, path("in"), SCHEMA, files_per_batch=1), path("t"), path("cp"))
    assert write_table(spark.createDataFrame(third, SCHEMA), path("t"), "append") == 12
    put(spark, fourth, path("in"))
    append_stream(read_stream(spark, path("in"), SCHEMA), path("t"), path("cp"))
    assert rows(spark.read.parquet(path("t")).select("k", "at", "v")) == sorted(first + second + third + fourth)
    assert write_table(spark.read.parquet(path("t")).filter("k = 0"), path("t"), "replace") == sum(r[0] == 0 for r in first + second + third + fourth)
    from stillroom.operators.tables import partition_columns

    assert partition_columns(spark, path("t")) == ["k"]
    with pytest.raises(ValueError, match="partitioned by"):
        write_table(spark.createDataFrame(first, SCHEMA), path("t"), "append", partition_by=["v"])


@pytest.mark.parametrize("fails_at", range(4))
def test_a_batch_that_breaks_off_is_repeated(spark, path, monkeypatch, fails_at):
    from stillroom import files
    from stillroom.operators import tables

    data, calls, rename = some_rows(30), [], files.rename
    tables.append_batch(spark.createDataFrame(data[:10], SCHEMA).repartition(3), path("t"), "a-0")

    def breaking(*args):
        calls.append(args)
        if len(calls) == fails_at + 1:
            raise OSError("lost")
        rename(*args)

    monkeypatch.setattr(files, "rename", breaking)
    batch = spark.createDataFrame(data[10:], SCHEMA).repartition(3)
    try:
        tables.append_batch(batch, path("t"), "a-1")
    except OSError:
        assert tables.append_batch(batch, path("t"), "a-1") is True
    assert rows(spark.read.parquet(path("t"))) == sorted(data)
    assert tables.append_batch(batch, path("t"), "a-1") is False


def test_upsert_stream_in_any_file_order(spark, path):
    data = some_rows(120)
    shuffled = data[:]
    random.Random(1).shuffle(shuffled)
    put(spark, shuffled, path("in"), 5)
    table = KeyedTable(spark, path("t"), SCHEMA, ["k"], ["at"])
    apply_stream(read_stream(spark, path("in"), SCHEMA, files_per_batch=1), table, "upsert", path("cp"))
    assert table._state()["number"] == 5
    assert rows(table.read()) == last_per_key(data)


@pytest.mark.parametrize(("ratio", "most"), [(0.01, 32), (1000, 32), (1000, 1)])
def test_upserts_and_deletes_in_any_order(spark, path, ratio, most):
    """A key is there unless its newest change is a delete, for every order in which the batches arrive."""
    changes = [("upsert", 1, 1), ("delete", 1, 5), ("upsert", 1, 3), ("upsert", 2, 2), ("delete", 2, 1), ("upsert", 3, 7), ("delete", 3, 8), ("upsert", 3, 9)]
    expected = [(2, 2, "v2"), (3, 9, "v9")]
    for turn in range(3):
        random.Random(turn).shuffle(changes)
        table = KeyedTable(spark, path(f"t{turn}"), SCHEMA, ["k"], ["at"], merge_ratio=ratio, max_additions=most)
        for i, (action, k, at) in enumerate(changes):
            table.apply(spark.createDataFrame([(k, at, f"v{at}")], SCHEMA), action, f"b-{i}")
        assert rows(table.read()) == expected


WIDE = T.StructType([T.StructField("k", T.LongType()), T.StructField("at", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType()), T.StructField("c", T.VariantType())])


@pytest.mark.parametrize(("ratio", "most"), [(0.01, 32), (1000, 2)])
def test_changes_of_columns_in_any_order(spark, path, ratio, most):
    """Updates of one key and different columns, before and after its upserts and deletes, in any order of batches."""
    changes = [
        ("upsert", (1, 1, "a1", "b1")), ("update", (1, 5, "a5", None)), ("update", (1, 3, None, "b3")), ("update", (1, 2, "a2", None)),
        ("update", (2, 4, None, "b4")), ("upsert", (2, 2, "a2", "b2")),
        ("upsert", (3, 1, "a1", "b1")), ("update", (3, 9, "a9", None)), ("delete", (3, 5)), ("upsert", (3, 7, "a7", "b7")),
        ("upsert", (4, 1, "a1", "b1")), ("update", (4, 9, "a9", None)), ("delete", (4, 5)),
        ("update", (5, 9, "a9", None)),
        ("update", (6, 2, "a2", None)), ("upsert", (6, 4, "a4", "b4")),
    ]
    expected = [(1, 5, "a5", "b3"), (2, 4, "a2", "b4"), (3, 9, "a9", "b7"), (6, 4, "a4", "b4")]
    for turn in range(2):
        random.Random(turn).shuffle(changes)
        table = KeyedTable(spark, path(f"w{turn}"), WIDE, ["k"], ["at"], merge_ratio=ratio, max_additions=most)
        for i, (action, values) in enumerate(changes):
            names = [n for n, v in zip(("k", "at", "a", "b"), values) if v is not None]
            df = spark.createDataFrame([tuple(v for v in values if v is not None)], ", ".join(f"{n} {'long' if n in ('k', 'at') else 'string'}" for n in names))
            table.apply(df.withColumn("c", F.expr("parse_json('1')")) if action == "upsert" else df, action, f"b-{i}")
        assert rows(table.read().select("k", "at", "a", "b")) == expected


def test_updates_and_deletes_without_an_order_stand_where_their_row_stands(spark, path):
    table = KeyedTable(spark, path("t"), SCHEMA, ["k"], ["at"])
    table.apply(spark.createDataFrame([(1, 5, "a"), (2, 5, "b")], SCHEMA), "upsert", "u-0")
    table.apply(spark.createDataFrame([(1, "new"), (7, "nobody")], "k long, v string"), "update", "u-1")
    table.apply(spark.createDataFrame([(1, 4, "late"), (2, 6, "later")], SCHEMA), "upsert", "u-2")
    assert rows(table.read()) == [(1, 5, "new"), (2, 6, "later")]


def test_a_writer_that_dies_blocks_nobody(spark, path, monkeypatch):
    from stillroom import files

    table = KeyedTable(spark, path("t"), SCHEMA, ["k"], ["at"])
    with monkeypatch.context() as m:
        m.setattr(files, "create_whole", lambda *args: (_ for _ in ()).throw(OSError("dead")))
        with pytest.raises(OSError):
            table.apply(spark.createDataFrame([(1, 1, "dead")], SCHEMA), "upsert", "dead-0")
    assert table.apply(spark.createDataFrame([(2, 1, "alive")], SCHEMA), "upsert", "alive-0") is True
    assert rows(table.read()) == [(2, 1, "alive")]


def test_batch_delivered_twice_is_applied_once_even_after_vacuum(spark, path):
    table = KeyedTable(spark, path("t"), SCHEMA, ["k"], ["at"])
    batch = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], SCHEMA)
    assert table.apply(batch, "upsert", "run-0") is True
    assert table.apply(spark.createDataFrame([(1,)], "k long"), "delete", "other-0") is True
    assert table.vacuum() > 0
    assert table.apply(batch, "upsert", "run-0") is False
    assert rows(table.read()) == [(2, 1, "b")]


@pytest.mark.parametrize("step", ["_store", "_commit"])
def test_broken_off_batch_is_written_anew(spark, path, monkeypatch, step):
    table = KeyedTable(spark, path("t"), SCHEMA, ["k"], ["at"])
    table.apply(spark.createDataFrame([(1, 1, "a")], SCHEMA), "upsert", "run-0")
    whole = getattr(KeyedTable, step)

    def breaking(self, *args):
        whole(self, *args)
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(KeyedTable, step, breaking)
        with pytest.raises(OSError):
            table.apply(spark.createDataFrame([(2, 2, "b")], SCHEMA), "upsert", "run-1")
    assert table.apply(spark.createDataFrame([(2, 2, "b")], SCHEMA), "upsert", "run-1") is (step == "_store")
    assert rows(table.read()) == [(1, 1, "a"), (2, 2, "b")]


def test_two_writers_of_one_version(spark, path):
    table = KeyedTable(spark, path("t"), SCHEMA, ["k"], ["at"])
    state = table._state()
    table.apply(spark.createDataFrame([(1, 1, "a")], SCHEMA), "upsert", "one-0")
    with pytest.raises(RuntimeError, match="another run"):
        table._commit(state | {"number": 1, "token": "two-0"})


def test_update_and_delete(spark, path):
    table = KeyedTable(spark, path("t"), SCHEMA, ["k"], ["at"])
    table.load(spark.createDataFrame([(i, 1, f"v{i}") for i in range(8)], SCHEMA))
    with pytest.raises(ValueError):
        table.load(spark.createDataFrame([], SCHEMA))
    table.apply(spark.createDataFrame([(3, 2, "new"), (4, 0, "late"), (77, 2, "nobody"), (None, 2, "null")], SCHEMA), "update", "u-0")
    assert rows(table.read())[3:5] == [(3, 2, "new"), (4, 1, "v4")]
    assert len(rows(table.read())) == 8
    table.apply(spark.createDataFrame([(i,) for i in range(8)], "k long"), "delete", "d-0")
    assert rows(table.read()) == []
    table.apply(spark.createDataFrame([(5, 9, "back"), (3, 0, "too old")], SCHEMA), "upsert", "u-1")
    assert rows(table.read()) == [(5, 9, "back")]
    with pytest.raises(ValueError):
        table.apply(spark.createDataFrame([], SCHEMA), "merge", "x")


def test_rows_without_a_key_are_kept_each(spark, path):
    table = KeyedTable(spark, path("t"), SCHEMA, ["k"], ["at"])
    for i in range(2):
        table.apply(spark.createDataFrame([(None, 1, "x"), (1, i, "y")], SCHEMA), "upsert", f"r-{i}")
    assert sorted(map(str, table.read().collect())) == sorted(map(str, spark.createDataFrame([(None, 1, "x"), (None, 1, "x"), (1, 1, "y")], SCHEMA).collect()))


def test_later_batches_win_where_the_order_is_equal(spark, path):
    table = KeyedTable(spark, path("t"), SCHEMA, ["k"], ["at"])
    for i, v in enumerate(("z", "a")):
        table.apply(spark.createDataFrame([(1, 1, v)], SCHEMA), "upsert", f"r-{i}")
    assert rows(table.read()) == [(1, 1, "a")]
    with pytest.raises(ValueError, match="order"):
        KeyedTable(spark, path("u"), SCHEMA, ["k"], [])


def test_keys_alone_need_no_order(spark, path):
    keys = T.StructType([SCHEMA["k"]])
    table = KeyedTable(spark, path("t"), keys, ["k"], [])
    for i, (action, k) in enumerate([("upsert", 1), ("upsert", 2), ("delete", 1), ("delete", 2), ("upsert", 2)]):
        table.apply(spark.createDataFrame([(k,)], keys), action, f"r-{i}")
    assert rows(table.read()) == [(2,)]


def test_columns_without_an_order(spark, path):
    schema = T.StructType([SCHEMA["k"], SCHEMA["at"], T.StructField("j", T.VariantType())])
    table = KeyedTable(spark, path("t"), schema, ["k"], ["at"])
    for i in range(3):
        table.apply(spark.sql(f"SELECT 1L AS k, {i}L AS at, parse_json('[{i}]') AS j"), "upsert", f"r-{i}")
    assert rows(table.read().selectExpr("k", "at", "to_json(j)")) == [(1, 2, "[2]")]


def test_empty_batch(spark, path):
    table = KeyedTable(spark, path("t"), SCHEMA, ["k"], ["at"])
    table.apply(spark.createDataFrame([], SCHEMA), "upsert", "r-0")
    assert rows(table.read()) == []
    table.apply(spark.createDataFrame([(1, 1, "a")], SCHEMA), "upsert", "r-1")
    assert rows(table.read()) == [(1, 1, "a")]


def test_bounding_box_feed(spark, path):
    """A periodic snapshot feed: only rows inside a box are appended."""
    from stillroom.functions.geo import in_box

    schema = T.StructType([T.StructField("callsign", T.StringType()), T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType())])
    spark.createDataFrame([("in", 8.0, 46.0), ("out", 20.0, 46.0), ("none", None, 46.0)], schema).write.parquet(path("in"))
    stream = read_stream(spark, path("in"), schema).filter(in_box("lon", "lat", 5.9962, 10.5226, 45.8389, 47.8229))
    append_stream(stream, path("out"), path("cp"))
    assert [r.callsign for r in spark.read.parquet(path("out")).collect()] == ["in"]


def test_layout_is_fixed(spark, path):
    KeyedTable(spark, path("t"), SCHEMA, ["k"], ["at"])
    for keys, order in ((["v"], ["at"]), (["k"], ["v"])):
        with pytest.raises(ValueError, match="laid out"):
            KeyedTable(spark, path("t"), SCHEMA, keys, order)


DAYS = T.StructType([T.StructField("n", T.LongType()), T.StructField("day", T.DateType())])


def snapshot(spark, path, number, start, days, factor, pieces=2):
    data = [(d * factor, dt.date(2024, 1, d)) for d in days]
    spark.createDataFrame(data, DAYS).repartition(pieces).write.parquet(path(f"in/snapshot={number}/from=2024-01-{start:02d}"))


def kept_days(spark, path):
    return {r.day.day: r.n for r in spark.read.parquet(path("t")).collect()}


def test_snapshots_refresh_a_window(spark, path):
    for number, start, days, factor in ((1, 1, range(1, 8), 1), (2, 5, (5, 6, 8), 10)):
        snapshot(spark, path, number, start, days, factor)
        window_stream(spark, path("in"), DAYS, path("t"), "day", path("cp"), files_per_batch=1)
    assert kept_days(spark, path) == {1: 1, 2: 2, 3: 3, 4: 4, 5: 50, 6: 60, 8: 80}


def test_an_older_snapshot_leaves_the_days_of_a_newer_one(spark, path):
    for number, start, days, factor in ((2, 5, (5, 6), 10), (1, 1, range(1, 8), 1), (3, 6, (), 100)):
        snapshot(spark, path, number, start, days, factor)
        window_stream(spark, path("in"), DAYS, path("t"), "day", path("cp"), files_per_batch=1)
        if number == 1:
            assert kept_days(spark, path) == {1: 1, 2: 2, 3: 3, 4: 4, 5: 50, 6: 60}


def test_an_unfinished_snapshot_is_refused(spark, path):
    import os

    snapshot(spark, path, 1, 1, (1, 2), 1)
    os.remove(path("in/snapshot=1/from=2024-01-01/_SUCCESS"))
    with pytest.raises(Exception, match="not finished"):
        window_stream(spark, path("in"), DAYS, path("t"), "day", path("cp"))
