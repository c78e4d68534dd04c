"""Spelling variants: words one edit apart, grouped under their far more frequent forms.

Every letter is mapped to one of a few symbols, which makes the one-edit neighbourhood of a word small: a word of eight
letters has some 130 neighbours over eight symbols, against 600 over a whole alphabet. The neighbourhoods of all
different reduced words are generated in full and joined with the reduced vocabulary; two words that differ by one edit
have reduced words that differ by one edit at most, so no pair escapes. The words below two neighbouring reduced words
are then compared as they are spelt.

Letters are dealt to the symbols by their frequency in the vocabulary, the most frequent first, each to the symbol that
has least so far, so that the reduced words spread well. That table has a row for each different letter.

Defined results: null texts have no words; a row without a doc_id forms its hash with an empty id; words count wherever
they occur, repeated rows included; a word without a near word is its own root. Forms lead from a word to one of at
least ``FORM_RATIO`` times its count, so that they never run in a circle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stillroom.llm.common import ascii_lower, stored

MIN_LETTERS, MIN_COUNT, FORM_RATIO = 6, 5, 5
SYMBOLS = "abcdefgh"
#: One in so many runs of a document loses a letter, drawn by its hash.
DROP = 199


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) for the words of at least ``MIN_LETTERS`` letters and ``MIN_COUNT`` occurrences."""
    runs = F.split(ascii_lower(docs["text"]), "[^A-Za-zÀ-ÿ]+")
    long_runs = F.filter(runs, lambda run: F.char_length(run) >= MIN_LETTERS)
    rows = docs.select(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("id"), F.explode(long_runs).alias("run"))
    at = F.pmod(F.col("hash"), F.char_length("run")).cast("int")
    less = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    words = rows.withColumn("hash", F.crc32(F.concat_ws(":", "id", "run"))).select(F.when(F.col("hash") % DROP == 0, less).otherwise(F.col("run")).alias("word"))
    return words.filter(F.char_length("word") >= MIN_LETTERS).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_COUNT)


def symbol_table(words: DataFrame, symbols: str = SYMBOLS) -> dict[str, str]:
    """The symbol of each letter of the vocabulary."""
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()
    load, table = dict.fromkeys(symbols, 0), {}
    for row in sorted(letters.collect(), key=lambda r: (-r["count"], r["letter"])):  # a row for each different letter
        table[row["letter"]] = symbol = min(symbols, key=lambda s: (load[s], s))
        load[symbol] += row["count"]
    return table


def neighbourhood(word: Column, symbols: str = SYMBOLS) -> Column:
    """The different words that one insertion, deletion or replacement makes of ``word`` over the symbols, and itself."""
    letters = F.array(*(F.lit(s) for s in symbols))
    places = F.sequence(F.lit(0), F.char_length(word))

    def around(at: Column, skipped: int) -> tuple[Column, Column]:
        return F.substring(word, F.lit(1), at), F.substring(word, at + 1 + skipped, F.char_length(word))

    def made(at: Column) -> Column:
        before, after = around(at, 0)
        _, rest = around(at, 1)
        inserted = F.transform(letters, lambda s: F.concat(before, s, after))
        replaced = F.transform(letters, lambda s: F.concat(before, s, rest))
        # At the end there is nothing to replace or delete.
        return F.when(at < F.char_length(word), F.concat(inserted, replaced, F.array(F.concat(before, rest)))).otherwise(inserted)

    return F.array_distinct(F.concat(F.array(word), F.flatten(F.transform(places, made))))


def near_words(words: DataFrame, symbols: str = SYMBOLS) -> DataFrame:
    """(word, n, near, near_n) both ways for all pairs of ``words`` (word, n; each once) that are one edit apart."""
    table = symbol_table(words, symbols)
    if not table:
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n"))
    reduced = F.translate("word", "".join(table), "".join(table.values()))
    words = stored(words.select("word", "n", reduced.alias("reduced")), "reduced-words")
    classes = stored(words.select("reduced").distinct(), "reduced-vocabulary")
    around = classes.select(F.col("reduced").alias("low"), F.explode(neighbourhood(F.col("reduced"), symbols)).alias("reduced")).filter("reduced >= low")
    meeting = stored(around.join(classes, "reduced", "left_semi").select("low", F.col("reduced").alias("high")), "reduced-pairs")
    a = words.select(F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("reduced").alias("low"))
    b = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("reduced").alias("high"))
    pairs = meeting.join(a, "low").join(b, "high").filter((F.col("low") != F.col("high")) | (F.col("a") < F.col("b")))
    pairs = stored(pairs.filter(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n"), "near-words")
    ways = [pairs.select(F.col(x).alias("word"), F.col(f"{x}_n").alias("n"), F.col(y).alias("near"), F.col(f"{y}_n").alias("near_n")) for x, y in ("ab", "ba")]
    return ways[0].unionByName(ways[1])


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for each word of ``forms`` (word, form): the end of its chain of forms, found by doubling steps.

    A form has at least ``FORM_RATIO`` times the count of its word, so a chain has no more than some twenty steps."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        after = stored(now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if after.filter("moved").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for each word of ``docs`` (doc_id, text)."""
    words = stored(word_counts(docs), "words")
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))).alias("top"))
    near = near.select("word", "n_near", F.col("top.near").alias("near"), (-F.col("top.less")).alias("near_n"))
    strong = F.col("near_n") >= FORM_RATIO * F.col("n")
    judged = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(strong, F.col("near")).alias("form"), F.when(strong, F.col("near_n")).alias("form_n"))
    judged = stored(judged, "judged-words")
    chains = roots(judged.filter("form IS NOT NULL").select("word", "form"))
    return judged.join(chains, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
