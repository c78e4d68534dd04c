import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from stillroom import files
from stillroom.functions import geo
from stillroom.operators import tables
from stillroom.operators.catalog import list_catalog, list_root, list_schemas, print_listing, spatial_columns, table_counts
from stillroom.operators.model import Model, ModelError, check_keys, denormalise, join_tree, model_of, tag_keys
from stillroom.schema import struct_from_types
from stillroom.sources.files import load_csv


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def data_files(folder):
    return [f for f in os.listdir(folder) if f.endswith(".parquet")]


# --- save modes -----------------------------------------------------------------------------------------


def test_modes(spark, path):
    t = path("t")
    tables.write_table(spark.range(3), t, "create")
    with pytest.raises(Exception, match="(?i)exist"):
        tables.write_table(spark.range(3), t, "create")
    tables.write_table(spark.range(9), t, "create_if_missing")
    assert spark.read.parquet(t).count() == 3
    tables.write_table(spark.range(2), t, "append")
    assert spark.read.parquet(t).count() == 5
    tables.write_table(spark.read.parquet(t).distinct(), t, "replace")
    assert rows(spark.read.parquet(t)) == [(0,), (1,), (2,)]
    assert [e for e in os.listdir(os.path.dirname(t)) if e.startswith(".t.")] == []
    with pytest.raises(ValueError):
        tables.write_table(spark.range(1), t, "merge")


def test_failed_replacement_keeps_the_table(spark, path):
    t = path("t")
    tables.write_table(spark.range(3), t)
    broken = spark.range(3).select(F.when(F.col("id") == 1, F.raise_error(F.lit("stop")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        tables.write_table(broken, t, "replace")
    assert spark.read.parquet(t).count() == 3


def test_append_aligns_by_name(spark, path):
    t = path("t")
    tables.write_table(spark.createDataFrame([(1, "a")], "k int, name string"), t)
    tables.write_table(spark.createDataFrame([("b", 2)], "name string, k int"), t, "append")
    tables.write_table(spark.createDataFrame([(3,)], "k int"), t, "append")
    assert rows(spark.read.parquet(t)) == [(1, "a"), (2, "b"), (3, None)]
    with pytest.raises(ValueError):
        tables.write_table(spark.createDataFrame([(3, 1)], "k int, zz int"), t, "append")


def test_publish_refresh_drop(spark, path):
    t = path("p")
    assert tables.refresh(spark.range(2), t) is True
    assert tables.refresh(spark.range(2), t) is False
    assert spark.read.parquet(t).count() == 4
    with pytest.raises(Exception, match="(?i)exist"):
        tables.publish(spark.range(1), t, "create-new")
    tables.publish(spark.range(1), t, "overwrite")
    tables.publish(spark.range(1), t, "append")
    assert spark.read.parquet(t).count() == 2
    tables.drop_table(spark, t)
    tables.drop_table(spark, t, if_exists=True)
    with pytest.raises(FileNotFoundError):
        tables.drop_table(spark, t)


def test_request_is_applied_once(spark, path):
    assert tables.append_once(spark.range(3), path("t"), "r-1") is True
    assert tables.append_once(spark.range(3), path("t"), "r-1") is False
    assert tables.append_once(spark.range(2), path("t"), "r-2") is True
    os.remove(path(".t.applied/r-2"))  # as if the write had broken off
    assert tables.append_once(spark.range(2), path("t"), "r-2") is True
    assert rows(spark.read.parquet(path("t")).groupBy("request_id").count()) == [("r-1", 3), ("r-2", 2)]
    with pytest.raises(ValueError):
        tables.append_once(spark.range(1), path("t"), "../x")
    assert tables.discard(spark.range(10)) >= 0


def test_declared_table_checks_rows(spark, path):
    schema = struct_from_types([("Line Item ID", "big_int", False), ("Discount", "double")])
    tables.create_table(spark, path("li"), schema)
    assert spark.read.parquet(path("li")).count() == 0
    tables.write_table(spark.createDataFrame([(1, None), (2, 0.1)], "`Line Item ID` int, Discount double"), path("li"), "replace", schema=schema)
    assert [f.dataType for f in spark.read.parquet(path("li")).schema] == [f.dataType for f in schema]
    with pytest.raises(Exception, match="NOT NULL"):
        tables.write_table(spark.createDataFrame([(None, 0.1)], "`Line Item ID` int, Discount double"), path("li"), "replace", schema=schema)


def test_catalog_tables(spark, path):
    schema = struct_from_types([("k", "int"), ("name", "text")])
    tables.create_catalog_table(spark, "shop.items", schema, path("items"))
    tables.insert_into(spark.createDataFrame([("a", 1)], "name string, k int"), "shop.items")
    copied = tables.create_table_as(spark.table("shop.items").filter("k = 1"), "shop.chosen", path("chosen"))
    assert rows(copied) == [(1, "a")]
    listed = list_catalog(spark, "shop")
    assert rows(listed.filter("schema_name = 'shop'").select("table_name", "position", "column_name", "data_type")) == [
        ("chosen", 1, "k", "int"),
        ("chosen", 2, "name", "string"),
        ("items", 1, "k", "int"),
        ("items", 2, "name", "string"),
    ]
    assert ("shop", 2) in rows(list_schemas(spark))
    assert "shop.items: 2 columns" in print_listing(listed)
    spark.sql("DROP DATABASE shop CASCADE")


def test_window_refresh(spark, path):
    t = path("days")
    data = [(i, dt.date(2024, 1, i)) for i in range(1, 7)]
    tables.write_table(spark.createDataFrame(data, "n int, day date"), t, partition_by=["day"])
    untouched = data_files(f"{t}/day=2024-01-02")
    fresh = spark.createDataFrame([(40, dt.date(2024, 1, 4)), (41, dt.date(2024, 1, 4)), (70, dt.date(2024, 1, 7)), (9, dt.date(2024, 1, 1))], "n int, day date")
    for _ in range(2):  # a second run changes nothing
        tables.refresh_window(fresh, t, "day", "2024-01-04")
        assert rows(spark.read.parquet(t)) == sorted(data[:3] + [(40, dt.date(2024, 1, 4)), (41, dt.date(2024, 1, 4)), (70, dt.date(2024, 1, 7))], key=repr)
    assert data_files(f"{t}/day=2024-01-02") == untouched


def test_rewriting_some_partitions(spark, path):
    from stillroom.operators.changes import upsert

    t = path("days")
    data = [(i, f"v{i}", dt.date(2024, 1, 1 + i % 4)) for i in range(12)]
    tables.write_table(spark.createDataFrame(data, "k int, v string, day date"), t, partition_by=["day"])
    untouched = data_files(f"{t}/day=2024-01-03")
    changes = spark.createDataFrame([(0, "new", dt.date(2024, 1, 1)), (50, "added", dt.date(2024, 1, 9))], "k int, v string, day date")
    tables.rewrite_partitions(spark, t, "day", ["2024-01-01", "2024-01-09"], lambda df: upsert(df, changes, [["k", "k"], ["day", "day"]]))
    expected = [(0, "new", dt.date(2024, 1, 1))] + data[1:] + [(50, "added", dt.date(2024, 1, 9))]
    assert rows(spark.read.parquet(t)) == sorted(expected, key=repr)
    assert data_files(f"{t}/day=2024-01-03") == untouched
    with pytest.raises(ValueError, match="not to change"):
        tables.rewrite_partitions(spark, t, "day", ["2024-01-01"], lambda df: df.withColumn("day", F.lit("2024-01-02").cast("date")))
    assert rows(spark.read.parquet(t)) == sorted(expected, key=repr)
    tables.rewrite_partitions(spark, t, "day", ["2024-01-09"], lambda df: df.limit(0))
    assert rows(spark.read.parquet(t)) == sorted(expected[:-1], key=repr)
    assert sorted(os.listdir(path("."))) == ["days"]


def test_partitions_of_escaped_values_and_null(spark, path):
    t = path("odd")
    data = [(1, "a:b"), (2, "x=y/z"), (3, None), (4, "plain")]
    tables.write_table(spark.createDataFrame(data, "n int, k string"), t, partition_by=["k"])
    tables.rewrite_partitions(spark, t, "k", ["a:b", "x=y/z", None], lambda df: df.withColumn("n", F.col("n") * 10))
    assert rows(spark.read.parquet(t)) == sorted([(10, "a:b"), (20, "x=y/z"), (30, None), (4, "plain")], key=repr)


@pytest.mark.parametrize("fails_at", range(7))
def test_a_replacement_that_breaks_off_is_finished(spark, path, monkeypatch, fails_at):
    """At whatever rename it broke off: the same call again gives the new state, and no row is lost."""
    t, calls, rename = path("days"), [], files.rename
    data = [(i, dt.date(2024, 1, i)) for i in range(1, 5)]
    tables.write_table(spark.createDataFrame(data, "n int, day date"), t, partition_by=["day"])

    def breaking(*args):
        calls.append(args)
        if len(calls) == fails_at + 1:
            raise OSError("lost")
        rename(*args)

    def change():
        tables.rewrite_partitions(spark, t, "day", ["2024-01-02", "2024-01-03"], lambda df: df.withColumn("n", F.lit(7)))

    with monkeypatch.context() as m:
        m.setattr(files, "rename", breaking)
        try:
            change()
        except OSError:
            pass
    change()
    assert rows(spark.read.parquet(t)) == sorted([data[0], (7, data[1][1]), (7, data[2][1]), data[3]], key=repr)
    assert not [n for n in os.listdir(path(".")) if "journal" in n and not n.count("-")]


@pytest.mark.parametrize("fails_at", range(3))
def test_a_swap_that_breaks_off_loses_nothing(spark, path, monkeypatch, fails_at):
    t, calls, rename = path("t"), [], files.rename
    tables.write_table(spark.range(3), t)

    def breaking(*args):
        calls.append(args)
        if len(calls) == fails_at + 1:
            raise OSError("lost")
        rename(*args)

    with monkeypatch.context() as m:
        m.setattr(files, "rename", breaking)
        with pytest.raises(OSError):
            tables.write_table(spark.range(5), t, "replace")
    tables.recover(spark, t)
    assert spark.read.parquet(t).count() == (3 if fails_at == 0 else 5)


def test_rows_are_counted_as_they_are_written(spark, path):
    assert tables.write_table(spark.range(7), path("a")) == 7
    assert tables.write_table(spark.range(5), path("a"), "append") == 5
    assert tables.write_table(spark.range(4), path("a"), "create_if_missing") == 0
    assert tables.write_table(spark.range(2), path("a"), "replace") == 2
    assert tables.write_table(spark.range(6).withColumn("p", F.col("id") % 2), path("b"), partition_by=["p"]) == 6
    assert tables.export_csv(spark.range(3), path("c")) == 3


# --- copies and exports -------------------------------------------------------------------------------------


def test_copy_packs_small_files(spark, path):
    spark.range(100).repartition(20).write.parquet(path("src/many"))
    spark.range(5).write.parquet(path("src/few"))
    assert tables.copy_tables(spark, path("src"), path("dst")) == ["few", "many"]
    assert len(data_files(path("dst/many"))) == 1
    assert rows(table_counts({n: spark.read.parquet(path(f"dst/{n}")) for n in ("few", "many")})) == [("few", 5), ("many", 100)]
    size = files.total_bytes(spark, path("src/many"))
    tables.copy_tables(spark, path("src"), path("dst2"), tables=["many"], file_bytes=size // 4)
    assert 3 <= len(data_files(path("dst2/many"))) <= 5


def test_copies_keep_schemas_partitions_and_files_as_tables(spark, path):
    spark.range(4).withColumn("day", F.col("id") % 2).write.partitionBy("day").parquet(path("src/daily"))
    spark.range(3).write.parquet(path("src/east/t"))
    spark.range(2).write.parquet(path("src/west/t"))
    spark.range(5).coalesce(1).write.parquet(path("one"))
    os.rename(data_files(path("one"))[0] if os.path.isabs(data_files(path("one"))[0]) else path("one/" + data_files(path("one"))[0]), path("src/single.parquet"))
    assert tables.copy_tables(spark, path("src"), path("dst")) == ["daily", "east.t", "single", "west.t"]
    assert tables.partition_columns(spark, path("dst/daily")) == ["day"]
    below = tables.tables_below(spark, path("dst"))
    assert {n: spark.read.parquet(p).count() for n, p in below.items()} == {"daily": 4, "east.t": 3, "single": 5, "west.t": 2}
    os.mkdir(path("nothing"))
    with pytest.raises(FileNotFoundError):
        tables.table_names(spark, path("nothing"))


def test_copy_changes_columns_of_one_type(spark, path):
    df = spark.createDataFrame([(1, "polygon((0 0,0 1,1 1,0 0))"), (2, None), (3, "point(1 2)")], "k int, w string")
    df.select("k", geo.wkt_to_geo("w").alias("g")).write.parquet(path("a/shapes"))
    tables.copy_tables(spark, path("a"), path("b"), transform_by_type=(geo.is_geography, geo.invert_vertex_order))
    back = spark.read.parquet(path("b/shapes"))
    assert rows(back.select("k", geo.geo_to_wkt("g"))) == [
        (1, "polygon ((0.0 0.0, 1.0 1.0, 0.0 1.0, 0.0 0.0))"),
        (2, None),
        (3, "point (1.0 2.0)"),
    ]
    assert rows(spatial_columns({"shapes": back, "n": spark.range(2)})) == [("shapes", "g", 3)]
    assert spatial_columns({"n": spark.range(2)}).count() == 0


def test_export_round_trip(spark, path):
    data = [(1, ' lead, "quoted"; ', 1.5, None, True, dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5, 678000)), (2, "", None, "x", None, None, None)]
    schema = struct_from_types([("k", "int"), ("a b", "text"), ("d", "double"), ("s", "text"), ("b", "bool"), ("day", "date"), ("at", "timestamp")])
    df = spark.createDataFrame(data, schema)
    tables.export_csv(df, path("csv"))
    assert rows(load_csv(spark, path("csv"), schema)) == sorted(data, key=repr)
    tables.save_text(df.select("k"), path("text"))
    assert rows(spark.read.text(path("text"))) == [("1",), ("2",)]


def test_texts_of_all_kinds_return(spark, path):
    texts = [None, "", "NULL", "\\NULL", "\\\\NULL", "null", " NULL", "a\nb", '"', '"NULL"', "a,b", "\\", "tab\t", "last\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    tables.export_csv(df, path("t"))
    assert rows(load_csv(spark, path("t"), df.schema, multi_line=True)) == sorted(enumerate(texts), key=repr)


def test_export_of_special_types(spark, path):
    schema = struct_from_types([("g", "geography"), ("j", "json"), ("b", "bytes")])
    df = spark.createDataFrame([("point(1 2)", '{"a": [1, 2]}'), (None, None)], "w string, j string")
    df = df.select(geo.wkt_to_geo("w").alias("g"), F.parse_json("j").alias("j"), F.when(F.col("w").isNotNull(), F.unhex(F.lit("00FF"))).alias("b"))
    tables.export_csv(df, path("x"), sep=";")
    back = load_csv(spark, path("x"), schema, sep=";")
    assert rows(back.select(geo.latitude("g"), F.variant_get("j", "$.a[1]", "int"), "b")) == [(2.0, 2, bytearray(b"\x00\xff")), (None, None, None)]
    with pytest.raises(ValueError):
        tables.export_csv(spark.range(1).select(F.array(F.lit(1)).alias("a")), path("y"))


def test_many_tables_and_batches(spark, path):
    frames = {"sales": spark.createDataFrame([(1, 5)], "pk int, n int"), "products": spark.createDataFrame([(1, "x")], "pk int, name string")}
    tables.write_tables(frames, path("star"), schemas={"sales": struct_from_types([("pk", "int", False), ("n", "int")])})
    assert tables.table_names(spark, path("star")) == ["products", "sales"]
    assert rows(list_root(spark, path("star")).select("table_name", "column_name")) == [("products", "name"), ("products", "pk"), ("sales", "n"), ("sales", "pk")]
    with pytest.raises(ValueError):
        tables.write_tables(frames, path("star2"), schemas={"zz": None})
    assert tables.batched_parts(spark.range(100, numPartitions=12), 12).rdd.getNumPartitions() == 3


# --- keys ---------------------------------------------------------------------------------------------------


def star():
    return Model().primary_key("products", "pk").primary_key("sales", "order_id", "pk").foreign_key("sales", "pk", "products", "pk")


def test_keys_survive_storage_and_are_checked(spark, path):
    frames = {
        "sales": spark.createDataFrame([("o1", 1, 2), ("o1", 1, 3), ("o2", 2, 4), ("o3", 8, 4), ("o4", None, 1)], "order_id string, pk int, n int"),
        "products": spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "pk int, name string"),
    }
    for name, df in frames.items():
        tag_keys(df, name, star()).write.parquet(path(name))
    stored = {name: spark.read.parquet(path(name)) for name in frames}
    model = model_of(stored)
    assert model.foreign == star().foreign
    assert rows(check_keys(stored, model)) == [("products_pk", 1), ("sales_pk", 1), ("sales_products_fk", 1)]


def test_join_tree(spark):
    frames = {
        "sales": spark.createDataFrame([("o1", 1), ("o2", 9)], "order_id string, pk int"),
        "products": spark.createDataFrame([(1, "a", 7)], "pk int, name string, cat int"),
        "categories": spark.createDataFrame([(7, "food")], "id int, name string"),
    }
    model = star().foreign_key("products", "cat", "categories", "id")
    assert [k.parent for k in join_tree(model, frames)] == ["products", "categories"]
    wide = denormalise(frames, model)
    assert wide.columns == ["order_id", "sales_pk", "products_pk", "products_name", "cat", "id", "categories_name"]
    assert rows(wide.select("order_id", "products_name", "categories_name")) == [("o1", "a", "food"), ("o2", None, None)]


def test_key_sets_that_form_no_tree():
    two_facts = Model().foreign_key("a", "x", "c", "x").foreign_key("b", "x", "c", "x")
    with pytest.raises(ModelError, match="exactly one"):
        join_tree(two_facts, ["a", "b", "c"])
    diamond = Model().foreign_key("a", "b", "b", "b").foreign_key("a", "c", "c", "c").foreign_key("b", "d", "d", "d").foreign_key("c", "d", "d", "d")
    with pytest.raises(ModelError, match="several"):
        join_tree(diamond, ["a", "b", "c", "d"])
    cycle = Model().foreign_key("b", "c", "c", "c").foreign_key("c", "b", "b", "b")
    with pytest.raises(ModelError, match="do not reach"):
        join_tree(cycle, ["a", "b", "c"])
    with pytest.raises(ModelError, match="do not exist"):
        join_tree(Model().foreign_key("a", "b", "zz", "b"), ["a"])
    with pytest.raises(ModelError):
        Model().foreign_key("a", ["x", "y"], "b", ["x"])


def test_bins_are_full_and_hold_everything_once():
    import random

    rnd = random.Random(2)
    sizes = [rnd.choice([rnd.randrange(1, 20), rnd.randrange(1, 100), 250]) for _ in range(300)]
    bins = tables.best_bins(sizes, 100)
    assert sorted(k for b in bins for k in b) == list(range(300))
    fill = [sum(sizes[k] for k in b) for b in bins if sizes[b[0]] <= 100]
    assert max(fill) <= 100 and all(len(b) == 1 for b in bins if sizes[b[0]] > 100) and sorted(fill)[2] >= 90
    assert tables.best_bins([], 10) == []


@pytest.mark.parametrize("by", [[], ["p"]])
def test_a_dense_rewrite_of_very_uneven_files(spark, path, by):
    rows = spark.range(12_000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"), (F.col("id") % 2).alias("p"))
    cuts = [0, 50, 130, 150, 400, 420, 1000, 1900, 2000, 2300, 7500, 7600, 8000, 9500, 9600, 11_000, 11_200, 11_900, 12_000]
    for low, high in zip(cuts, cuts[1:]):
        writer = rows.filter((F.col("id") >= low) & (F.col("id") < high)).coalesce(1).write.mode("append").option("parquet.enable.dictionary", False)
        writer = writer.option("parquet.block.size", 32_768) if high - low > 4000 else writer
        (writer.partitionBy(*by) if by else writer).parquet(path("uneven"))
    sizes = [e.length for e in files.walk(spark, path("uneven")) if e.name.endswith(".parquet")]
    target = 120_000 if by else 240_000
    n = tables.rewrite_dense(spark, path("uneven"), path("dense"), target)
    dense = [e.length for e in files.walk(spark, path("dense")) if e.name.endswith(".parquet")]
    assert len(dense) == n < len(sizes) and sorted(spark.read.parquet(path("dense")).columns) == ["id", "p", "text"]
    back = spark.read.parquet(path("dense")).select(rows.columns)
    assert back.count() == 12_000 and back.exceptAll(rows.withColumn("p", F.col("p").cast(back.schema["p"].dataType))).isEmpty()
    near = [x for x in dense if 0.8 * target <= x <= 1.2 * target]
    assert len(near) >= len(dense) - (2 if by else 1), (target, sorted(dense), sorted(sizes))
    with pytest.raises(FileExistsError):
        tables.rewrite_dense(spark, path("uneven"), path("dense"), target)
