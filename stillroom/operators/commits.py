"""The commit-history data set: commits, changed files, content hashes, lines per author.

Works on tables of per-file changes and file contents; reading a repository itself is not part of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stillroom.functions.expressions import content_hash, epoch_to_utc
from stillroom.operators.changes import settled
from stillroom.operators.model import Model
from stillroom.operators.versions import VersionedTable

FILE_SIZE_LIMIT = 10 * 1024**2
PART_BYTES, SEPARATOR = 64 * 1024, ", "


def history_model() -> Model:
    """Keys of the four tables."""
    return (
        Model()
        .primary_key("commits", "commit_id")
        .primary_key("blame", "file_hash", "author")
        .foreign_key("changed_files", "commit_id", "commits", "commit_id")
        .foreign_key("file_commit_mapping", "commit_id", "commits", "commit_id")
        .foreign_key("file_commit_mapping", "file_hash", "blame", "file_hash")
    )


def commit_heads(commits: DataFrame) -> DataFrame:
    """Author and committer facts; epoch seconds become UTC timestamps, the message stays as it is."""
    return commits.select(
        "commit_id",
        epoch_to_utc("authored_seconds").alias("authored_date"),
        epoch_to_utc("committed_seconds").alias("committed_date"),
        "author_mail",
        "committer_mail",
        "message",
    )


def commit_totals(changes: DataFrame) -> DataFrame:
    """Insertions, deletions, changed lines and changed files per commit, from one row per changed file."""
    return changes.groupBy("commit_id").agg(
        F.sum("insertions").alias("insertions"),
        F.sum("deletions").alias("deletions"),
        F.sum(F.col("insertions") + F.col("deletions")).alias("number_of_changed_lines"),
        F.count(F.lit(1)).alias("number_of_changed_files"),
    )


def commit_facts(commits: DataFrame, changes: DataFrame) -> DataFrame:
    """The commits table: one row for every commit of ``commits``, with the totals of its changed files.

    A commit without changed files has totals of 0. Names of changed files are rows of ``changed_files``.
    """
    numbers = ["insertions", "deletions", "number_of_changed_lines", "number_of_changed_files"]
    joined = commit_heads(commits).join(commit_totals(changes), "commit_id", "left")
    return joined.select(
        "commit_id", "authored_date", "committed_date", "author_mail", "committer_mail", *(F.coalesce(n, F.lit(0).cast("bigint")).alias(n) for n in numbers), "message"
    )


def changed_files(changes: DataFrame) -> DataFrame:
    """``(commit_id, file_name)``: one row per changed file, from the change table itself, so that any name is kept."""
    return changes.select("commit_id", "file_name")


def joined_files(changes: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``(commit_id, part, text)``: the changed files of a commit as one list, joined by ``, `` in the order of their names
    and cut into parts of about ``part_bytes`` bytes; a commit of few files has one part, 0.

    A name belongs to the part in which its first byte falls, so a part is longer than the bound by one name at most. Names
    with a comma, a quote, or a space at an end are quoted (``listed_files`` undoes it); NULL names are left out. Rows are
    dealt by ranges of commit and name, and the bytes before each range are added up per commit, so that a commit with
    very many files is split over tasks; no row holds more than a part.
    """
    named = changes.filter("file_name IS NOT NULL").select("commit_id", "file_name", _quoted(F.col("file_name")).alias("name"))
    size = (F.octet_length("name") + len(SEPARATOR)).cast("long")
    dealt = named.withColumn("bytes", size).repartitionByRange("commit_id", "file_name").withColumn("range", F.spark_partition_id())
    dealt = settled(dealt, "ranges-of-names")  # written once: every later step sees the same ranges
    sums = dealt.groupBy("commit_id", "range").agg(F.sum("bytes").alias("in_range"))
    before = Window.partitionBy("commit_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("commit_id").alias("of"), F.col("range").alias("in"), F.coalesce(F.sum("in_range").over(before), F.lit(0)).alias("start"))
    rows = dealt.join(sums, dealt["commit_id"].eqNullSafe(sums["of"]) & (dealt["range"] == sums["in"]))
    within = Window.partitionBy("commit_id", "range").orderBy("file_name").rowsBetween(Window.unboundedPreceding, -1)
    place = F.col("start") + F.coalesce(F.sum("bytes").over(within), F.lit(0))
    parts = rows.select("commit_id", "file_name", "name", F.floor(place / part_bytes).alias("at")).groupBy("commit_id", "at")
    texts = parts.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("file_name", "name"))), lambda x: x["name"]), SEPARATOR).alias("text"))
    # A name longer than a part leaves parts without a first byte; parts are numbered as they come.
    number = F.row_number().over(Window.partitionBy("commit_id").orderBy("at")) - 1
    return texts.select("commit_id", number.cast("long").alias("part"), "text")


def listed_files(joined: DataFrame) -> DataFrame:
    """``(commit_id, file_name)``: the names in the parts of ``joined_files``."""
    names = F.regexp_extract_all("text", F.lit(r'"[^"]*+(?:""[^"]*+)*+"|[^", ][^",]*+'), F.lit(0))
    name = F.col("name")
    plain = F.when(name.startswith('"'), F.replace(F.substring(name, F.lit(2), F.char_length(name) - 2), F.lit('""'), F.lit('"'))).otherwise(name)
    return joined.select("commit_id", F.explode(names).alias("name")).select("commit_id", plain.alias("file_name"))


def _quoted(name: Column) -> Column:
    odd = (name == "") | F.rlike(name, F.lit(r'[",]|^ | $'))
    return F.when(odd, F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(name)


def hash_mapping(files: DataFrame) -> DataFrame:
    """``(commit_id, file_hash, file_name)`` from file contents; contents are hashed where they are read."""
    return files.select("commit_id", content_hash("content").alias("file_hash"), "file_name")


def lines_per_author(lines: DataFrame) -> DataFrame:
    """``(file_hash, author, number_of_lines)`` from one row per line."""
    return lines.groupBy("file_hash", "author").agg(F.count(F.lit(1)).alias("number_of_lines"))


def line_count(text: Column) -> Column:
    """Lines of a text: its line breaks, and one more where text follows the last. No row per line is made."""
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))
    return (breaks + F.when((text != "") & ~F.endswith(text, F.lit("\n")), 1).otherwise(0)).cast("bigint")


def lines_by_author(contributions: DataFrame) -> DataFrame:
    """As ``lines_per_author`` for whole contributed texts; each is counted in place, then summed."""
    return contributions.groupBy("file_hash", "author").agg(F.sum(line_count(F.col("text"))).alias("number_of_lines"))


def new_contents(files: DataFrame, known_hashes: DataFrame | None = None, size_limit: int | None = FILE_SIZE_LIMIT) -> DataFrame:
    """``(file_hash, file_id)``: contents to analyse, each once, under the first file id that holds it.

    Skips contents of ``size_limit`` bytes or more and hashes that are already known; None lifts the limit.
    Only hash and id are shuffled, and copies collapse before that.
    """
    if size_limit is not None:
        files = files.filter(F.octet_length("content") < size_limit)
    first = files.groupBy(content_hash("content").alias("file_hash")).agg(F.min("file_id").alias("file_id"))
    if known_hashes is None:
        return first
    return first.join(known_hashes.select("file_hash").distinct(), "file_hash", "left_anti")


def hash_index(spark: SparkSession, path: str) -> VersionedTable:
    """A table of the hashes that were analysed, dealt by their prefixes to sorted files."""
    schema = T.StructType([T.StructField("file_hash", T.StringType(), False), T.StructField("file_id", T.LongType()), T.StructField("run", T.StringType())])
    return VersionedTable.create(spark, path, schema, keys=["file_hash"])


def take_new_contents(files: DataFrame, index: VersionedTable, token: str, size_limit: int | None = FILE_SIZE_LIMIT) -> DataFrame:
    """``new_contents`` against an index of all earlier runs, to which the new hashes are added under ``token``.

    What is read of the index follows from the new contents: files whose range or Bloom filter holds none of their hashes
    are not opened. A run that is repeated under its token gives the same rows.
    """
    first = settled(new_contents(files, None, size_limit), "contents")
    match = [["file_hash", "file_hash"]]
    known = settled(index.matching(first.select("file_hash"), match), "known-contents")
    # Hashes that this very run added before it broke off are new all the same.
    own = first.join(known.select("file_hash", "run"), "file_hash", "left")
    fresh = settled(own.filter((F.col("run").isNull()) | (F.col("run") == token)).select("file_hash", "file_id"), "new-contents")
    index.append(fresh.withColumn("run", F.lit(token)), token)
    return fresh
