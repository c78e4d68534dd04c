"""The commit-history data set over the given tables: an order stands for a commit, a part for a file."""

from pyspark.sql import functions as F

from stillroom.functions.expressions import content_hash, epoch_to_utc
from stillroom.operators import commits
from stillroom.operators.model import check_keys
from stillroom.plans import plan, table


def file_changes(spark, sf_dir):
    """One row per commit and changed file."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("commit_id"), F.col("l_partkey").alias("file"))
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("insertions"), F.sum(F.col("l_linenumber").cast("bigint")).alias("deletions"))
        .select("commit_id", F.col("file").cast("string").alias("file_name"), "insertions", "deletions")
    )


@plan("""
WITH ch AS (SELECT l_orderkey AS commit_id, l_partkey, SUM(CAST(l_quantity AS BIGINT)) AS ins, SUM(l_linenumber) AS del FROM lineitem GROUP BY 1, 2),
     tot AS (SELECT commit_id, CAST(SUM(ins) AS BIGINT) AS ins, CAST(SUM(del) AS BIGINT) AS del, COUNT(*) AS files FROM ch GROUP BY 1)
SELECT o_orderkey AS commit_id, o_orderdate AS authored_date, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 DAY AS committed_date,
       concat('c', o_custkey, '@mail') AS author_mail, CASE o_orderstatus WHEN 'O' THEN NULL ELSE concat(o_orderstatus, '@mail') END AS committer_mail,
       coalesce(ins, 0) AS insertions, coalesce(del, 0) AS deletions, coalesce(ins + del, 0) AS number_of_changed_lines,
       coalesce(files, 0) AS number_of_changed_files, concat(o_orderpriority, chr(10), 'order ', o_orderkey) AS message
FROM orders LEFT JOIN tot ON commit_id = o_orderkey
""")
def commit_facts(spark, sf_dir):
    """Orders as commits, with their dates, people and message; orders without lines are commits without files."""
    since = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint") * 86400
    key = F.col("o_orderkey").cast("string")
    heads = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("commit_id"),
        since.alias("authored_seconds"),
        (since + 86400).alias("committed_seconds"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string"), F.lit("@mail")).alias("author_mail"),
        F.when(F.col("o_orderstatus") != "O", F.concat("o_orderstatus", F.lit("@mail"))).alias("committer_mail"),
        F.concat("o_orderpriority", F.lit("\norder "), key).alias("message"),
    )
    return commits.commit_facts(heads, file_changes(spark, sf_dir))


@plan("SELECT DISTINCT l_orderkey AS commit_id, concat('dir, ', CAST(l_partkey AS VARCHAR), ', v.txt') AS file_name FROM lineitem")
def changed_files_explode(spark, sf_dir):
    """One row per commit and file, with names that hold the usual separators of lists."""
    named = F.concat(F.lit("dir, "), "file_name", F.lit(", v.txt"))
    return commits.changed_files(file_changes(spark, sf_dir).withColumn("file_name", named))


@plan("""
WITH named AS (SELECT DISTINCT l_orderkey AS commit_id, CASE l_partkey % 3 WHEN 0 THEN concat('dir, ', CAST(l_partkey AS VARCHAR), ', "v".txt') ELSE concat('src/', CAST(l_partkey AS VARCHAR), '.txt') END AS file_name FROM lineitem),
     all_named AS (SELECT commit_id, file_name FROM named UNION ALL SELECT DISTINCT -1, file_name FROM named),
     quoted AS (SELECT commit_id, file_name, CASE WHEN file_name LIKE 'dir%' THEN concat('"', replace(file_name, '"', '""'), '"') ELSE file_name END AS name FROM all_named),
     placed AS (SELECT *, CAST(COALESCE(SUM(strlen(name) + 2) OVER (PARTITION BY commit_id ORDER BY file_name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) // 60 AS place FROM quoted)
SELECT commit_id, ROW_NUMBER() OVER (PARTITION BY commit_id ORDER BY place) - 1 AS part, text
FROM (SELECT commit_id, place, string_agg(name, ', ' ORDER BY file_name) AS text FROM placed GROUP BY 1, 2) t
""")
def commit_file_lists(spark, sf_dir):
    """The files of each commit as a joined list in parts, and one commit, -1, that changes every file."""
    part = F.col("file_name").cast("bigint")
    name = F.when(part % 3 == 0, F.concat(F.lit("dir, "), "file_name", F.lit(', "v".txt'))).otherwise(F.concat(F.lit("src/"), "file_name", F.lit(".txt")))
    named = file_changes(spark, sf_dir).select("commit_id", name.alias("file_name"))
    everything = named.select(F.lit(-1).cast("bigint").alias("commit_id"), "file_name").distinct()
    return commits.joined_files(named.unionByName(everything), part_bytes=60)


@plan("SELECT event_id, date_trunc('second', ts) AS authored_date FROM events")
def epoch_to_utc_time(spark, sf_dir):
    since = F.col("ts") - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = F.floor(since.cast("interval second").cast("decimal(18,6)")).cast("bigint")
    return table(spark, sf_dir, "events").select("event_id", seconds.alias("seconds")).select("event_id", epoch_to_utc("seconds").alias("authored_date"))


@plan("SELECT doc_id AS commit_id, sha256(text) AS file_hash, source AS file_name FROM documents")
def content_hash_mapping(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return commits.hash_mapping(documents.select(F.col("doc_id").alias("commit_id"), F.col("text").alias("content"), F.col("source").alias("file_name")))


@plan("""
SELECT conv_id AS file_hash, role AS author, CAST(SUM(length(text) - length(replace(text, chr(10), '')) + CASE WHEN text = '' OR text LIKE concat('%', chr(10)) THEN 0 ELSE 1 END) AS BIGINT) AS number_of_lines
FROM (SELECT conv_id, role, text FROM conversations UNION ALL SELECT conv_id, role, concat(text, chr(10)) FROM conversations WHERE turn = 1 UNION ALL SELECT conv_id, role, '' FROM conversations WHERE turn = 2) t GROUP BY 1, 2
""")
def lines_per_author(spark, sf_dir):
    """Turns as texts, some with a final line break and some empty."""
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("file_hash"), F.col("role").alias("author"), "turn", "text")
    ended = turns.filter("turn = 1").withColumn("text", F.concat("text", F.lit("\n")))
    empty = turns.filter("turn = 2").withColumn("text", F.lit(""))
    return commits.lines_by_author(turns.unionByName(ended).unionByName(empty))


@plan("""
SELECT sha256(text) AS file_hash, MIN(doc_id) AS file_id FROM documents
WHERE strlen(text) < 10240 AND sha256(text) NOT IN (SELECT sha256(text) FROM documents JOIN labels ON documents.doc_id = labels.doc_id)
GROUP BY 1
""")
def skip_unchanged_and_size_limit(spark, sf_dir):
    """Documents that have labels count as analysed; of the rest each small content is taken once."""
    documents = table(spark, sf_dir, "documents")
    known = documents.join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi").select(content_hash("text").alias("file_hash"))
    return commits.new_contents(documents.select(F.col("doc_id").alias("file_id"), F.col("text").alias("content")), known, 10240)


@plan("""
WITH mapping AS (SELECT doc_id AS commit_id, sha256(text) AS file_hash FROM documents),
     blame AS (SELECT sha256(text) AS file_hash, lang AS author, COUNT(*) AS n FROM documents WHERE strlen(text) < 10240 GROUP BY 1, 2)
SELECT 'commits_pk' AS check_name, COUNT(*) - COUNT(DISTINCT o_orderkey) AS violations FROM orders
UNION ALL SELECT 'blame_pk', CAST(0 AS BIGINT)
UNION ALL SELECT 'changed_files_commits_fk', COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) l WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
UNION ALL SELECT 'file_commit_mapping_commits_fk', COUNT(*) FROM mapping WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = commit_id)
UNION ALL SELECT 'file_commit_mapping_blame_fk', COUNT(*) FROM mapping WHERE NOT EXISTS (SELECT 1 FROM blame WHERE blame.file_hash = mapping.file_hash)
""")
def history_key_checks(spark, sf_dir):
    """The four tables of the history and their keys: contents over the size limit have no lines per author."""
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("commit_id"), F.col("text").alias("content"), F.col("source").alias("file_name"), F.col("lang").alias("author")
    )
    small = documents.filter(F.octet_length("content") < 10240)
    frames = {
        "commits": table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("commit_id")),
        "changed_files": file_changes(spark, sf_dir).select("commit_id", "file_name"),
        "file_commit_mapping": commits.hash_mapping(documents),
        "blame": commits.lines_by_author(small.select(content_hash("content").alias("file_hash"), "author", F.col("content").alias("text"))),
    }
    return check_keys(frames, commits.history_model())
