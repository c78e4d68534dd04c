"""Versioned tables: changes against plain ones, readers, break-offs, and what is read and written."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from stillroom import files
from stillroom.operators import changes as C
from stillroom.operators import versions
from stillroom.operators.changes import DuplicateKeyError
from stillroom.operators.versions import ConflictError, VersionedTable
from stillroom.schema import struct_from_types

ITEMS = struct_from_types([("id", "big_int"), ("name", "text"), ("day", "date"), ("value", "double")])
KEY = [["id", "id"]]


def items(spark, start, stop, name="n"):
    ids = spark.range(start, stop)
    return ids.select("id", F.concat(F.lit(name), F.col("id").cast("string")).alias("name"), F.expr("date_add(DATE'2024-03-01', cast(id % 10 as int))").alias("day"), (F.col("id") / 4).alias("value"))


def bag(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    made = VersionedTable.create(spark, str(tmp_path_factory.mktemp("loaded") / "t"), ITEMS, keys=["id"])
    for k in range(8):  # eight files or more, each a range of keys
        assert made.append(items(spark, 1000 * k, 1000 * (k + 1)), f"load-{k}") == 1000
    return made


@pytest.fixture()
def table(spark, path, loaded):
    """A copy: files name each other by their places in the table alone."""
    shutil.copytree(loaded.path, path("t"))
    return VersionedTable(spark, path("t"))


def test_rows_are_those_that_were_added(spark, table):
    assert bag(table.read()) == bag(items(spark, 0, 8000)) and table.count() == 8000
    assert table.append(items(spark, 0, 10), "load-3") == 0 and table.count() == 8000
    with pytest.raises(FileExistsError):
        VersionedTable.create(spark, table.path, ITEMS)
    with pytest.raises(ValueError):
        VersionedTable.create(spark, table.path + "x", ITEMS, keys=["none"])


def test_a_delete_writes_no_row_and_counts_hits(spark, table):
    before, data = bag(table.read()), {e.path for e in files.walk(spark, f"{table.path}/data")}
    condition = (F.col("id") % 7 == 3) & (F.col("id") < 2500)
    hit = [r for r in before if r[0] % 7 == 3 and r[0] < 2500]
    assert table.delete_where(condition) == len(hit)
    assert {e.path for e in files.walk(spark, f"{table.path}/data")} == data
    assert bag(table.read()) == [r for r in before if r not in hit] and table.count() == 8000 - len(hit)
    more = spark.createDataFrame([(3,), (4,), (4,), (2999,), (9999,), (None,)], "id long")
    assert table.delete_matching(more, KEY) == 2  # 3 is gone already
    assert table.delete_where(condition) == 0
    assert bag(table.read()) == [r for r in before if r not in hit and r[0] not in (4, 2999)]


def test_files_that_are_mostly_deleted_are_written_anew(spark, table):
    before = bag(table.read())
    assert table.delete_where(F.col("id").between(1000, 1600)) == 601
    assert bag(table.read()) == [r for r in before if not 1000 <= r[0] <= 1600]
    assert table.files().filter("deleted > 0").isEmpty()
    assert table.delete_where(F.lit(True)) == 7399 and table.read().isEmpty() and table.count() == 0


def test_positions_beyond_one_bitmap(spark, path):
    made = VersionedTable.create(spark, path("long"), ITEMS)
    made.append(items(spark, 0, 100_000).coalesce(1))
    assert made.delete_where(F.col("id").isin(0, 32767, 32768, 65535, 65536, 99999)) == 6
    assert made.files().count() == 1
    assert made.read().count() == 99_994 and made.read().filter(F.col("id").isin(0, 32767, 32768, 65535, 65536, 99999)).isEmpty()


@pytest.mark.parametrize("columns", [["id", "name", "day", "value"], ["id", "name"]])
def test_upserts_are_those_of_plain_tables(spark, table, columns):
    changes = items(spark, 1990, 2020, "new").unionByName(items(spark, 9000, 9005, "new")).select(columns)
    keyless = spark.createDataFrame([(None, "nobody")], "id long, name string").select([F.col(c) if c in ("id", "name") else F.lit(None).cast(dict(changes.dtypes)[c]).alias(c) for c in columns])
    changes = changes.unionByName(keyless)
    expected = bag(C.upsert(table.read(), changes, KEY))
    assert table.upsert(changes, KEY, "u-1") == (30, 6)
    assert bag(table.read()) == expected
    assert table.upsert(changes, KEY, "u-1") == (0, 0) and bag(table.read()) == expected
    with pytest.raises(DuplicateKeyError):
        table.upsert(changes.limit(1).unionByName(changes.limit(1)), KEY)
    assert bag(table.read()) == expected


def test_updates_are_those_of_plain_tables(spark, table):
    changes = items(spark, 10, 20, "new").select("id", "name").unionByName(items(spark, 9000, 9001).select("id", "name"))
    expected = bag(C.update_from(table.read(), changes, KEY))
    assert table.update_from(changes, KEY) == 10 and bag(table.read()) == expected
    expected = bag(C.update_where(table.read(), {"value": F.col("value") + 1}, F.col("id") > 7990))
    live = {r["file"] for r in table.files().collect()}
    assert table.update_where({"value": F.col("value") + 1}, F.col("id") > 7990) == 9 and bag(table.read()) == expected
    assert len(live - {r["file"] for r in table.files().collect()}) == 1
    assert table.update_where({"value": F.lit(0.0)}, F.col("id") < 0) == 0
    assert table.update_from(changes.filter("id > 8500"), KEY) == 0


def test_a_small_changeset_reads_and_writes_few_files(spark, path):
    """1 % of clustered keys: under 5 % of the bytes."""
    made = VersionedTable.create(spark, path("c"), ITEMS, keys=["id"])
    made._commit(made.version(), [made._log(made._described(made.version(), made._write(made.version(), items(spark, 0, 20_000), 40)))], None)
    total = made.files().agg(F.sum("bytes")).first()[0]
    now, match = made.version(), C._as_match(KEY)
    changes = items(spark, 7100, 7300, "new")
    touched = made._touched(now, C.prefixed(changes, ["id"], match), match)
    assert sum(e["bytes"] for e in touched) < 0.05 * total
    live = {r["file"]: r["bytes"] for r in made.files().collect()}
    expected = bag(C.upsert(made.read(), changes, KEY))
    assert made.upsert(changes, KEY) == (200, 0) and bag(made.read()) == expected
    after = {r["file"]: r["bytes"] for r in made.files().collect()}
    assert sum(b for f, b in after.items() if f not in live) < 0.05 * total and len(set(live) - set(after)) <= 2


def test_bloom_filters_spare_files_whose_range_says_nothing(spark, path):
    made = VersionedTable.create(spark, path("b"), ITEMS, keys=["id"])
    for k in range(6):  # every file reaches over the whole range of keys
        made.append(items(spark, 0, 24_000).filter(F.col("id") % 6 == k).coalesce(1).union(items(spark, -1 - k, -k)).union(items(spark, 30_000 + k, 30_001 + k)))
    now, match = made.version(), C._as_match(KEY)
    everything = made.files().count()
    asked = spark.createDataFrame([(12,), (36,)], "id long")
    touched = made._touched(now, C.prefixed(asked, ["id"], match), match)
    assert 1 <= len(touched) <= 0.5 * everything
    assert made.delete_matching(asked, KEY) == 2
    absent = spark.createDataFrame([(25_000 + k,) for k in range(20)], "id long")
    assert len(made._touched(made.version(), C.prefixed(absent, ["id"], match), match)) <= 4 and made.delete_matching(absent, KEY) == 0


@pytest.mark.parametrize(("kind", "value"), [("string", "cast(id as string)"), ("date", "date_add(DATE'2024-01-01', cast(id as int))"), ("timestamp_ntz", "cast(timestamp_seconds(id * 3600) as timestamp_ntz)"), ("double", "cast(id as double)"), ("decimal(12,2)", "cast(id as decimal(12,2))")])
def test_keys_of_other_types(spark, path, kind, value):
    rows = spark.range(300).select(F.expr(value).alias("k"), F.col("id").cast("int").alias("part"), F.lit("old").alias("v"))
    made = VersionedTable.create(spark, path("k"), rows.schema, keys=["k", "part"])
    made.append(rows.filter("part < 150"))
    made.append(rows.filter("part >= 150"))
    match = [["k", "k"], ["part", "part"]]
    changes = rows.filter("part % 50 = 0").withColumn("v", F.lit("new")).unionByName(rows.limit(1).withColumns({"part": F.lit(-1), "v": F.lit("added")}))
    expected = bag(C.upsert(made.read(), changes, match))
    assert made.upsert(changes, match) == (6, 1) and bag(made.read()) == expected
    assert made.delete_matching(changes.select("k", "part"), match) == 7 and made.count() == 294
    assert made.delete_matching(rows.select("part").limit(1), [["part", "part"]]) in (0, 1)  # not the first key: all files


def test_a_reader_sees_the_table_before_or_after(spark, path):
    made = VersionedTable.create(spark, path("w"), ITEMS, partition="day")
    made.append(items(spark, 0, 100))
    old = made.read()
    first, live = bag(old), {r["part"]: r["file"] for r in made.files().collect()}
    assert len(live) == 10
    assert made.replace_window(items(spark, 0, 100, "new"), dt.date(2024, 3, 5), dt.date(2024, 3, 8)) == 30
    assert bag(old) == first  # begun before the refresh
    days = {dt.date(2024, 3, d) for d in (5, 6, 7)}
    assert bag(made.read()) == sorted([r for r in first if r[2] not in days] + [tuple(r) for r in items(spark, 0, 100, "new").collect() if r["day"] in days], key=str)
    assert {p: f for p, f in live.items() if p not in days}.items() <= {r["part"]: r["file"] for r in made.files().collect()}.items()
    assert bag(made.read(version=2)) == first
    assert made.replace_window(items(spark, 0, 0), "2024-03-09") == 0 and made.read().filter("day >= '2024-03-09'").isEmpty()
    assert made.read(where=F.col("part") == F.lit("2024-03-01").cast("date")).count() == 10


STEPS = {
    "append": lambda spark, t: t.append(items(spark, 200, 210), "step"),
    "upsert": lambda spark, t: t.upsert(items(spark, 190, 210, "new"), KEY, "step"),
    "delete": lambda spark, t: t.delete_where((F.col("id") % 50 == 0) | (F.col("id") < 90), "step"),
    "replace": lambda spark, t: t.replace(items(spark, 0, 5), "step"),
}


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    made = VersionedTable.create(spark, str(tmp_path_factory.mktemp("small") / "t"), ITEMS, keys=["id"])
    for k in range(2):
        made.append(items(spark, 100 * k, 100 * (k + 1)).coalesce(1))
    return made


@pytest.mark.parametrize("action", sorted(STEPS))
def test_whatever_breaks_off_leaves_the_old_rows_and_can_be_repeated(spark, small, path, action):
    shutil.copytree(small.path, path("t"))
    table = VersionedTable(spark, path("t"))
    step, before = STEPS[action], bag(table.read())

    class Broken(Exception):
        pass

    def break_at(number):
        """The numberth write of the driver, data or text, fails."""
        count = iter(range(1000))

        def failing(call):
            def run(*args, **kwargs):
                if next(count) == number:
                    raise Broken
                return call(*args, **kwargs)

            return run

        patch = pytest.MonkeyPatch()
        for owner, name in ((VersionedTable, "_write"), (VersionedTable, "_log"), (VersionedTable, "_write_bloom"), (files, "write_text"), (files, "create_whole")):
            patch.setattr(owner, name, failing(getattr(owner, name)))
        return patch

    broken, state = 0, before
    for number in range(30):
        patch = break_at(number)
        try:
            step(spark, VersionedTable(spark, table.path))
            patch.undo()
            break
        except Broken:
            broken += 1
            patch.undo()
            now = bag(VersionedTable(spark, table.path).read())
            assert now == before or state == before or now == state  # old rows, or the new ones once they are committed
            state = now
    after = bag(table.read())
    assert broken >= 4 and after != before
    step(spark, table)
    assert bag(table.read()) == after


def test_two_writers(spark, table, monkeypatch):
    stale = table.version()
    table.append(items(spark, 8000, 8001), "other")
    mine = VersionedTable(spark, table.path)
    monkeypatch.setattr(mine, "version", lambda number=None, seen=[]: stale if not seen and not seen.append(1) else VersionedTable(spark, table.path).version(number))
    assert mine.append(items(spark, 8001, 8003), "mine") == 2 and table.count() == 8003
    behind = VersionedTable(spark, table.path)
    monkeypatch.setattr(behind, "version", lambda number=None: stale)
    with pytest.raises(ConflictError):
        behind.delete_where(F.col("id") < 5)
    assert table.count() == 8003


def test_tokens_outlive_a_crash_before_their_mark(spark, table):
    table.append(items(spark, 8000, 8010), "lost")
    os.remove(f"{table.path}/_applied/lost")
    table.append(items(spark, 8010, 8020), "next")
    assert table.append(items(spark, 8000, 8010), "lost") == 0 and table.count() == 8020
    with pytest.raises(ValueError):
        table.append(items(spark, 0, 1), "../x")


def test_logs_merge_compaction_and_vacuum(spark, path, monkeypatch):
    monkeypatch.setattr(versions, "MAX_LOGS", 4)
    made = VersionedTable.create(spark, path("m"), ITEMS, keys=["id"])
    for k in range(8):
        made.append(items(spark, 40 * k, 40 * (k + 1)).coalesce(1))
    assert len(made.version().logs) <= 5 and made.count() == 320
    os.remove(f"{made.path}/_versions/_last")
    assert made.version().number == 9
    made.delete_where(F.col("id") % 20 == 0)
    rows = bag(made.read())
    assert made.compact() >= 8 and made.files().count() == 1 and bag(made.read()) == rows
    assert made.compact() == 0
    assert made.vacuum() > 8 and bag(made.read()) == rows and made.vacuum() == 0
    assert len([e for e in files.walk(spark, f"{made.path}/data") if e.name.endswith(".parquet")]) == 1


def test_empty_tables_and_declared_columns(spark, path):
    schema = struct_from_types([("id", "big_int", False), ("Odd `name`", "text")])
    made = VersionedTable.create(spark, path("e"), schema, keys=["id"])
    assert made.read().isEmpty() and made.count() == 0
    assert made.delete_where(F.lit(True)) == 0 and made.compact() == 0
    assert made.upsert(spark.createDataFrame([(1, "x")], "id long, `Odd ``name``` string"), KEY) == (0, 1)
    with pytest.raises(Exception, match="NOT NULL"):
        made.append(spark.createDataFrame([(None, "x")], "id long, `Odd ``name``` string"))
    assert bag(made.read()) == [(1, "x")]


def test_boxes_open_few_files(spark, path):
    from stillroom.functions import geo

    rows = spark.range(40_000).select("id", (F.rand(3) * 360 - 180).alias("lon"), (F.rand(4) * 180 - 90).alias("lat")).withColumn("cell", geo.cell("lon", "lat"))
    made = VersionedTable.create(spark, path("geo"), rows.schema, keys=["cell"])
    made.spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.createDataFrame(rows.collect(), rows.schema)
        made._commit(made.version(), [made._log(made._described(made.version(), made._write(made.version(), rows, 64)))], None)
    finally:
        made.spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    everything = made.files().count()
    for box in ((10.0, 46.0, 20.0, 38.0), (-180.0, -150.0, -90.0, -70.0), (175.0, -170.0, -20.0, 20.0), (5.0, 5.0, 5.0, 5.0)):
        found = made.in_box("lon", "lat", box)
        assert bag(found) == bag(rows.filter(geo.in_box("lon", "lat", *box)))
        assert len(found.inputFiles()) < 0.1 * everything
    assert made.in_box("lon", "lat", (0.0, 1.0, 5.0, 4.0)).isEmpty()
    assert made.in_box("lon", "lat", (-180.0, 180.0, -90.0, 90.0)).count() == 40_000


def test_an_index_of_hashes_reads_what_new_contents_ask(spark, path):
    from stillroom.operators import commits

    index = commits.hash_index(spark, path("hashes"))
    old = spark.range(6000).select(F.col("id").alias("file_id"), F.col("id").cast("string").alias("content"))
    for k in range(3):
        assert commits.take_new_contents(old.filter(F.col("file_id") % 3 == k), index, f"old-{k}").count() == 2000
    new = spark.createDataFrame([(7000, "5"), (7001, "new"), (7002, "new")], "file_id long, content string")
    assert [tuple(r)[1:] for r in commits.take_new_contents(new, index, "new-0").collect()] == [(7001,)]
    assert [tuple(r)[1:] for r in commits.take_new_contents(new, index, "new-0").collect()] == [(7001,)]  # as when it broke off
    assert commits.take_new_contents(new, index, "new-1").count() == 0 and index.count() == 6001
    assert commits.take_new_contents(old, index, "all-again").count() == 0
