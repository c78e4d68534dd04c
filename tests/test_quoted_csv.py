"""Quoted CSV read in splits, against the reader that takes a file as a whole."""

import random

import pytest
from pyspark.sql import functions as F

from stillroom import files
from stillroom.schema import struct_from_types
from stillroom.sources.files import load_csv, quoted_records

SCHEMA = struct_from_types([("k", "big_int"), ("a", "text"), ("b", "text")])


def content(rows, end="\n"):
    quote = lambda x: '"' + x.replace('"', '""') + '"' if any(c in x for c in '",\n\r') else x
    return end.join(["k,a,b", *(f"{k},{quote(a)},{quote(b)}" for k, a, b in rows)]) + end


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(6)
    pieces = ["x", "\n", "\n\n", '"', '""', ",", '",\n"', "word ", "ÄÖ", "\r", "  ", '"\n', '\n"']
    out = [(i, "".join(rnd.choices(pieces, k=rnd.choice([0, 1, 2, 5, 12]))), "".join(rnd.choices(pieces, k=3))) for i in range(60)]
    return [(k, a.rstrip("\r"), b) for k, a, b in out]


def loaded(spark, path, **options):
    return sorted(tuple(r) for r in load_csv(spark, path, SCHEMA, multi_line=True, **options).collect())


@pytest.mark.parametrize("size", [7, 23, 64, 301, 4000])
def test_any_split_gives_the_rows_of_the_whole_file(spark, path, rows, size):
    files.write_text(spark, path("in.csv"), content(rows))
    whole = sorted(tuple(r) for r in load_csv(spark, path("in.csv"), SCHEMA, multi_line=True, options={"quote": '"'}).collect())
    assert whole == sorted((k, a, b) for k, a, b in rows)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set(key, str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        blocks = spark.read.text(path("in.csv")).select("_metadata.file_block_start").distinct().count()
        assert size > 3000 or blocks > 1
        assert loaded(spark, path("in.csv")) == whole
    finally:
        spark.conf.set(key, before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_one_field_over_many_splits(spark, path):
    long = "\n".join(f'line {i}, "quoted"' for i in range(300))
    files.write_text(spark, path("long.csv"), content([(1, "x", "y"), (2, long, ""), (3, "", "z\n")]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
        assert loaded(spark, path("long.csv")) == [(1, "x", "y"), (2, long, ""), (3, "", "z\n")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_several_files_headers_paths_and_carriage_returns(spark, path):
    files.write_text(spark, path("d/a.csv"), content([(1, "a\nb", "c")]))
    files.write_text(spark, path("d/b.csv"), content([(2, "a\nb", "c"), (3, "", "")], end="\r\n"))
    files.write_text(spark, path("d/c.csv"), "k,a,b\n")
    files.write_text(spark, path("d/d.csv"), "")
    assert loaded(spark, path("d")) == [(1, "a\nb", "c"), (2, "a\nb", "c"), (3, "", "")]
    assert loaded(spark, [path("d/a.csv"), path("d/a.csv"), path("d/c.csv")]) == [(1, "a\nb", "c")] * 2
    named = load_csv(spark, path("d"), SCHEMA, multi_line=True, path_column="p", name_filter="b*")
    assert {r["p"].rpartition("/")[2] for r in named.collect()} == {"b.csv"}
    assert quoted_records(spark, [path("d/a.csv")], header=False).count() == 2
    with pytest.raises(Exception, match="(?i)malformed"):
        files.write_text(spark, path("bad.csv"), "k,a,b\nx,a,b\n1\n")
        load_csv(spark, path("bad.csv"), SCHEMA, multi_line=True).select("a", "b").collect()


def test_lines_are_dealt_to_as_many_tasks_as_there_are_splits(spark, path):
    spark.range(20_000).select(F.format_string('%d,"a\n%s",b', "id", "id").alias("x")).coalesce(1).write.text(path("big"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        df = load_csv(spark, path("big"), SCHEMA, multi_line=True, header=False)
        assert df.count() == 20_000 and df.filter("a <> concat('a\n', k)").isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
