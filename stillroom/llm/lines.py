"""Quality by the frequency of lines across documents.

Lines are normalised (small letters; runs of digits as one sign, marks and white space as one space) and hashed. For
every host the different documents that hold a line are counted; a line that more of them hold than the limits allow is
boilerplate of the host and is removed, and a document of which too few words are left is rejected. A line without a
letter is no boilerplate, however many documents have such: numbers and rules differ in what normalising takes away.

Before that, base rules look at each text by itself: its words, symbols, repeated lines and the words in repeated
windows of five. Windows are compared by 64-bit hashes of their words.

Defined results: a null or empty text has no word and fails the base rules; a null host is a host of its own; rows that
repeat a document, in id and text, are one document in the counts and are judged each; without a doc_id the text tells
documents apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stillroom.llm.common import stored

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
SPAN = 5


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(line), r"\p{Nd}+", "0"), r"[\s\p{Punct}]+", " "))


def _repeated_words(n: Column) -> Column:
    """Words in windows of five that are found twice or more. Reads ``grams``, the windows' hashes."""
    grams = F.col("grams")
    placed = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    pairs = F.zip_with(placed, F.slice(placed, 2, F.size(grams)), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    places = F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, i: F.struct((i + SPAN).alias("end"), (a["n"] + i + SPAN - F.greatest(a["end"], i)).alias("n")),
        lambda a: a["n"],
    )
    return F.when((n < SPAN) | (F.size(F.array_distinct(grams)) == F.size(grams)), F.lit(0)).otherwise(covered)


def measure(docs: DataFrame, host: str = "source") -> DataFrame:
    """A row for each document: doc_id, host, text_hash, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and
    lines, the hash and number of words of each line; the hash is null where a line has no letter."""
    text = F.coalesce(docs["text"], F.lit(""))
    rows = docs.select(docs["doc_id"], F.coalesce(docs[host].cast("string"), F.lit("")).alias("host"), F.xxhash64(docs["text"]).alias("text_hash"), text.alias("text"))
    rows = rows.select("*", F.array_remove(F.split("text", SPACE), "").alias("words"), F.split("text", "\n", -1).alias("all_lines"))
    rows = rows.select("*", F.size("words").alias("n"), F.filter("all_lines", lambda x: F.rlike(x, F.lit(WORD))).alias("own_lines"))
    starts = F.sequence(F.lit(0), F.col("n") - SPAN)
    grams = F.when(F.col("n") >= SPAN, F.transform(starts, lambda i: F.xxhash64(*(F.col("words")[i + k] for k in range(SPAN)))))
    rows = rows.select("*", F.coalesce(grams, F.array().cast("array<bigint>")).alias("grams"))
    hashed = lambda x: F.when(F.rlike(x, F.lit(r"\p{L}")), F.xxhash64(normalised(x)))
    lines = F.transform("all_lines", lambda x: F.struct(hashed(x).alias("line"), F.regexp_count(x, F.lit(WORD)).alias("n")))
    return rows.select(
        "doc_id",
        "host",
        "text_hash",
        F.col("n").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("own_lines") - F.size(F.array_distinct("own_lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("n")).cast("long").alias("n_repeat_words"),
        lines.alias("lines"),
    )


def frequent_lines(measured: DataFrame, min_docs: int, share: float) -> DataFrame:
    """(host, line) of the lines that more than ``min_docs`` different documents of the host hold, and more than
    ``share`` of its documents."""
    doc = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit("text"), "text_hash")).otherwise(F.xxhash64(F.lit("id"), "doc_id", "text_hash")).alias("doc")
    once = measured.select("host", doc, "lines").dropDuplicates(["host", "doc"])
    held = once.select("host", F.explode(F.array_distinct(F.transform(F.filter("lines", lambda x: x["line"].isNotNull()), lambda x: x["line"]))).alias("line"))
    counts = held.groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs")).filter(F.col("docs") > min_docs)
    hosts = measured.select("host", doc).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("all_docs"))
    return counts.join(hosts, "host").filter(F.col("docs") > share * F.col("all_docs")).select("host", "line")


def judge(docs: DataFrame, host: str = "source", min_docs: int = 2, share: float = 0.02, min_left: float = 0.5, min_words: int = 10, max_repeated: float = 0.2) -> DataFrame:
    """A row for each document: doc_id, text_hash, the base figures, base_failed, removed_lines (their positions),
    left_words, depleted (too few words are left) and kept."""
    measured = stored(measure(docs, host), "measured")
    frequent = stored(frequent_lines(measured, min_docs, share), "frequent-lines")
    lines = measured.select("doc_id", "text_hash", "host", F.posexplode("lines").alias("at", "x")).select("doc_id", "text_hash", "host", "at", F.col("x.line").alias("line"), F.col("x.n").alias("n"))
    gone = lines.filter("line IS NOT NULL").join(frequent, ["host", "line"]).groupBy("doc_id", "text_hash", "host").agg(F.sort_array(F.collect_set(F.struct("at", "n"))).alias("gone"))
    gone = stored(gone.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), F.col("host").alias("of"), "gone"), "removed-lines")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")) & (F.col("host") == F.col("of"))
    left = F.col("n_words") - F.coalesce(F.aggregate("gone", F.lit(0).cast("long"), lambda a, x: a + x["n"]), F.lit(0))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > round(100 * max_repeated) * F.col("n_words"))
    out = measured.drop("lines").join(gone, same, "left").select(
        *(c for c in measured.columns if c not in ("lines", "host")),
        failed.alias("base_failed"),
        F.coalesce(F.col("gone.at"), F.array().cast("array<int>")).alias("removed_lines"),
        left.alias("left_words"),
    )
    out = out.select("*", (F.col("left_words") < min_left * F.col("n_words")).alias("depleted"))
    return out.select("*", (~F.col("base_failed") & ~F.col("depleted")).alias("kept"))


def cleaned(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """The kept rows of ``docs``, all columns, their texts without the removed lines."""
    verdict = judged.filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("removed_lines").alias("_gone")).distinct()
    verdict = stored(verdict, "kept-texts")
    rows = docs.join(verdict, docs["doc_id"].eqNullSafe(verdict["_id"]) & (F.xxhash64(docs["text"]) == verdict["_hash"]))
    lines = F.split(docs["text"], "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), verdict["_gone"])
    text = F.when(F.size(verdict["_gone"]) == 0, docs["text"]).otherwise(F.array_join(F.transform(left, lambda i: lines[i]), "\n"))
    return rows.select(*(text.alias(c) if c == "text" else docs[c] for c in docs.columns))
