import hashlib
import random

import pytest
from pyspark.sql import functions as F

from stillroom.operators import commits
from stillroom.operators.model import check_keys

CHANGES = "commit_id string, file_name string, insertions bigint, deletions bigint"


def some_changes():
    """A third of all rows belong to one commit."""
    rng = random.Random(3)
    rows = [("huge", f"dir/f{i}", rng.randrange(9), rng.randrange(9)) for i in range(150)]
    for c in range(60):
        rows += [(f"c{c}", f"dir/f{i}", rng.randrange(9), rng.randrange(9)) for i in rng.sample(range(300), rng.randrange(1, 9))]
    return rows


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_one_row_for_each_commit(spark, threshold):
    rows = some_changes()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    heads = [(c, 0, 1, "a@x", None, "it's") for c in sorted({r[0] for r in rows})] + [("no files", 5, 6, None, None, "")]
    columns = "commit_id string, authored_seconds bigint, committed_seconds bigint, author_mail string, committer_mail string, message string"
    try:
        facts = commits.commit_facts(spark.createDataFrame(heads, columns), spark.createDataFrame(rows, CHANGES)).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(f.commit_id for f in facts) == sorted(h[0] for h in heads)
    for fact in facts:
        mine = [r for r in rows if r[0] == fact.commit_id]
        ins, dels = sum(r[2] for r in mine), sum(r[3] for r in mine)
        assert (fact.insertions, fact.deletions, fact.number_of_changed_lines, fact.number_of_changed_files) == (ins, dels, ins + dels, len(mine))


def test_names_of_changed_files_are_kept(spark):
    rows = [("c", "a, b.txt", 1, 1), ("c", "", 1, 1), ("d", "x\ny", 1, 1)]
    assert sorted(map(tuple, commits.changed_files(spark.createDataFrame(rows, CHANGES)).collect())) == sorted(r[:2] for r in rows)


def test_commit_heads(spark):
    import datetime as dt

    df = spark.createDataFrame([("sha", 0, 86400, "a@x", "b@x", "it's\nfine")], "commit_id string, authored_seconds bigint, committed_seconds bigint, author_mail string, committer_mail string, message string")
    assert tuple(commits.commit_heads(df).first()) == ("sha", dt.datetime(1970, 1, 1), dt.datetime(1970, 1, 2), "a@x", "b@x", "it's\nfine")


def test_lines(spark):
    lines = spark.createDataFrame([("h", "a"), ("h", "a"), ("h", "b"), ("g", "author-mail a")], "file_hash string, author string")
    assert sorted(map(tuple, commits.lines_per_author(lines).collect())) == [("g", "author-mail a", 1), ("h", "a", 2), ("h", "b", 1)]
    texts = spark.createDataFrame([("h", "a", "x\ny\n"), ("h", "a", ""), ("h", "b", "one")], "file_hash string, author string, text string")
    assert sorted(map(tuple, commits.lines_by_author(texts).collect())) == [("h", "a", 2), ("h", "b", 1)]


def test_new_contents(spark):
    files = spark.createDataFrame([(1, "aa"), (2, "bb"), (3, "aa"), (4, "éé"), (5, "long text"), (6, None)], "file_id int, content string").filter("content is not null")
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    known = spark.createDataFrame([(digest("bb"),)], "file_hash string")
    assert sorted(map(tuple, commits.new_contents(files, known, 4).collect())) == [(digest("aa"), 1)]
    assert {r.file_id for r in commits.new_contents(files, None, None).collect()} == {1, 2, 4, 5}
    mapping = commits.hash_mapping(files.select(F.lit("c").alias("commit_id"), "content", F.lit("f").alias("file_name")))
    assert mapping.filter(F.col("file_hash") == digest("aa")).count() == 2


def test_history_keys(spark):
    frames = {
        "commits": spark.createDataFrame([("c1",)], "commit_id string"),
        "changed_files": spark.createDataFrame([("c1", "f"), ("c2", "f")], "commit_id string, file_name string"),
        "file_commit_mapping": spark.createDataFrame([("c1", "h", "f")], "commit_id string, file_hash string, file_name string"),
        "blame": spark.createDataFrame([("h", "a", 1), ("h", "b", 2)], "file_hash string, author string, number_of_lines int"),
    }
    assert {r.check_name: r.violations for r in check_keys(frames, commits.history_model()).collect()} == {
        "commits_pk": 0,
        "blame_pk": 0,
        "changed_files_commits_fk": 1,
        "file_commit_mapping_commits_fk": 0,
        "file_commit_mapping_blame_fk": 0,
    }


def test_joined_lists_in_parts(spark):
    from collections import Counter

    names = ["a", "b, c", 'd "e"', "", " f", "g ", "ä,", '"', "h\ni", "z" * 50, "a"]
    rows = [(1, n) for n in names] + [(2, "only"), (3, None), (None, "x, y"), (None, "w")]
    changes = spark.createDataFrame(rows, "commit_id long, file_name string")
    for size in (1, 10, 10_000):
        parts = commits.joined_files(changes, size).collect()
        assert size < 10_000 or {(r["commit_id"], r["part"]) for r in parts} == {(1, 0), (2, 0), (None, 0)}
        assert all(len(r["text"].encode()) <= size + 54 for r in parts)
        numbers = {c: sorted(r["part"] for r in parts if r["commit_id"] == c) for c in (1, 2, None)}
        assert all(v == list(range(len(v))) for v in numbers.values())
        back = commits.listed_files(spark.createDataFrame(parts)).collect()
        assert Counter(map(tuple, back)) == Counter((c, n) for c, n in rows if n is not None)
    assert commits.joined_files(changes.filter("false")).count() == 0


def test_a_commit_of_very_many_files(spark):
    many = spark.range(100_000).select(F.lit(1).alias("commit_id"), F.format_string("dir %d/file, %d.txt", F.col("id") % 100, "id").alias("file_name"))
    joined = commits.joined_files(many, 4096).cache()
    sizes = [r["n"] for r in joined.select(F.octet_length("text").alias("n")).collect()]
    assert max(sizes) <= 4096 + 40 and sum(sizes) > 2_000_000 and len(sizes) > 500
    assert commits.listed_files(joined).exceptAll(many).isEmpty() and commits.listed_files(joined).count() == 100_000
    order = [r["text"] for r in joined.orderBy("part").collect()]
    names = [n for r in order for n in r[1:-1].split('", "')]
    assert names == sorted(names)
