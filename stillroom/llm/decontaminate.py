"""Benchmark passages in training documents, found by winnowing.

Every text is cut into words. Of the hashes of its word k-grams, winnowing keeps the least of each window of w
consecutive ones; two texts that share w + k - 1 words in a row share a kept hash. Documents and benchmark items are
joined on kept hashes, and each meeting is extended to the full passages of ``length`` words around it, which are
compared word by word. An item of fewer words is one passage; as no window of ``length`` words need cover it, each such
item length has its own k and w, so that no passage is missed.

Defined results: null and empty texts have no words and no hit; an item without words matches nothing; items that repeat
an id count once; a null item id counts as one item, written as an empty text; rows that repeat a document are each
returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stillroom.llm.common import ascii_lower, stored

LENGTH = 10
GRAM = 5
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Runs of digits, letters a-z (A-Z lower-cased) and characters beyond ASCII."""
    return F.coalesce(F.array_remove(F.split(ascii_lower(text), BREAKS), ""), F.array().cast("array<string>"))


def _gram_size(length: int, gram: int) -> int:
    return min(gram, length)


def _with_minima(rows: DataFrame, lengths: list[int], gram: int) -> DataFrame:
    """Adds for each passage length m the column ``minima_m``: for each start of a passage of m words, the least of the
    k-gram hashes in it. rows: with ``words`` and ``n_words``."""
    sizes = sorted({_gram_size(m, gram) for m in lengths})

    def hashes(k: int) -> Column:
        starts = F.sequence(F.lit(0), F.col("n_words") - k)
        return F.when(F.col("n_words") >= k, F.transform(starts, lambda i: F.xxhash64(F.lit(k), *(F.col("words")[i + j] for j in range(k)))))

    rows = rows.select("*", *(hashes(k).alias(f"grams_{k}") for k in sizes))

    def minima(m: int) -> Column:
        k = _gram_size(m, gram)
        grams, w = F.col(f"grams_{k}"), m - k + 1
        if w == 1:
            return grams
        starts = F.sequence(F.lit(0), F.col("n_words") - m)
        return F.when(F.col("n_words") >= m, F.transform(starts, lambda i: F.least(*(grams[i + j] for j in range(w)))))

    return rows.select(*(c for c in rows.columns if not c.startswith("grams_")), *(minima(m).alias(f"minima_{m}") for m in lengths))


def _runs(m: int) -> Column:
    """The kept hashes: each with the range [from, to) of passage starts whose least hash it is."""
    minima = F.col(f"minima_{m}")
    starts = F.filter(F.sequence(F.lit(0), F.size(minima) - 1), lambda i: (i == 0) | (minima[i] != minima[F.greatest(i - 1, F.lit(0))]))
    return F.when(F.size(minima) > 0, starts)


def _kept(m: int) -> Column:
    minima, starts = F.col(f"minima_{m}"), F.col(f"starts_{m}")
    one = F.transform(
        starts,
        lambda s, i: F.struct(
            F.lit(m).alias("m"), s.alias("from"), F.coalesce(F.get(starts, i + 1), F.size(minima)).alias("to"), minima[s].alias("kept")
        ),
    )
    return F.coalesce(one, F.array().cast("array<struct<m:int,from:int,to:int,kept:bigint>>"))


def _worded(rows: DataFrame) -> DataFrame:
    """rows: with ``text``. Replaces it by ``words`` and ``n_words``."""
    rows = rows.select(*(c for c in rows.columns if c != "text"), words_of(F.col("text")).alias("words"))
    return rows.select("*", F.size("words").alias("n_words"))


def _passages(items: DataFrame, length: int) -> DataFrame:
    """(item, m, words) for every passage of every item."""
    m = F.least(F.col("n_words"), F.lit(length))
    worded = items.filter("n_words > 0").select("item", "words", m.alias("m"), F.explode(F.sequence(F.lit(0), F.col("n_words") - m)).alias("at"))
    return worded.select("item", "m", F.slice("words", F.col("at") + 1, F.col("m")).alias("words"))


def find_passages(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """A row for each document: doc_id, text_hash, n_words, n_hit (words inside passages of items), spans (the
    passages, as ranges of word positions) and items (their ids as sorted texts)."""
    items = _worded(benchmark.select(F.coalesce(benchmark["item_id"].cast("string"), F.lit("")).alias("item"), benchmark["text"]))
    passages = stored(_passages(items, length), "passages")
    lengths = sorted(r["m"] for r in passages.select("m").distinct().collect())  # at most ``length`` values
    ids = docs.select(docs["doc_id"], F.xxhash64(docs["text"]).alias("text_hash"), docs["text"])
    if not lengths:
        none = _worded(ids).select("doc_id", "text_hash", F.col("n_words").cast("long").alias("n_words"))
        return none.select("*", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<struct<from:int,to:int>>").alias("spans"), F.array().cast("array<string>").alias("items"))

    own = _with_minima(passages.select("m", "words", F.size("words").alias("n_words")), lengths, gram)
    kept = F.coalesce(*(F.when(F.col("m") == m, F.col(f"minima_{m}")[0]) for m in lengths))
    prints = stored(own.select("m", kept.alias("kept")).distinct(), "benchmark-prints").withColumn("known", F.lit(True))

    # Of each document: one row with m = 0, and one for each kept hash that some item has as well.
    cut = _with_minima(_worded(ids), lengths, gram)
    cut = cut.select("doc_id", "text_hash", "n_words", *(f"minima_{m}" for m in lengths), *(_runs(m).alias(f"starts_{m}") for m in lengths))
    itself = F.array(F.struct(F.lit(0).alias("m"), F.lit(0).alias("from"), F.lit(0).alias("to"), F.col("text_hash").alias("kept")))
    dealt = cut.select("doc_id", "text_hash", "n_words", F.inline(F.concat(itself, *(_kept(m) for m in lengths))))
    met = dealt.join(prints, ["m", "kept"], "left").filter("m = 0 OR known")
    near = F.collect_list(F.when(F.col("m") > 0, F.struct("m", "from", "to")))
    seen = met.groupBy("doc_id", "text_hash", "n_words").agg(F.sum(F.when(F.col("m") == 0, 1)).cast("int").alias("rows"), near.alias("near"))
    seen = stored(seen, "winnowed")

    # The passages around each meeting, compared as texts.
    some = seen.filter(F.size("near") > 0).select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"), "near")
    again = ids.join(some, ids["doc_id"].eqNullSafe(some["id"]) & (ids["text_hash"] == some["hash"]))
    again = _worded(again.select("id", "hash", "near", "text")).dropDuplicates(["id", "hash"])
    ranges = again.select("id", "hash", "words", F.explode("near").alias("x"))
    starts = ranges.select("id", "hash", F.col("x.m").alias("m"), F.slice("words", F.col("x.from") + 1, F.col("x.to") - F.col("x.from") + F.col("x.m") - 1).alias("words"), F.col("x.from").alias("base"))
    tried = starts.select("id", "hash", "m", "words", "base", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("m"))).alias("k"))
    tried = tried.select("id", "hash", "m", (F.col("base") + F.col("k")).alias("from"), F.array_join(F.slice("words", F.col("k") + 1, F.col("m")), " ").alias("passage"))

    # Passages that the same items have count as one set of items, so that a shared text is not multiplied by its length.
    sets = passages.select(F.array_join("words", " ").alias("passage"), "item").groupBy("passage").agg(F.sort_array(F.collect_set("item")).alias("items"))
    sets = stored(sets.withColumn("set_id", F.sha2(F.array_join("items", ","), 256)), "item-sets")
    hit = tried.join(sets.select("passage", "set_id"), "passage").groupBy("id", "hash")
    hit = stored(hit.agg(F.sort_array(F.collect_set(F.struct("from", (F.col("from") + F.col("m")).alias("to")))).alias("hits"), F.collect_set("set_id").alias("set_ids")), "passage-hits")
    members = sets.dropDuplicates(["set_id"]).select("set_id", F.explode("items").alias("item"))
    named = hit.select("id", "hash", F.explode("set_ids").alias("set_id")).join(members, "set_id").groupBy("id", "hash").agg(F.sort_array(F.collect_set("item")).alias("items"))

    # Words under overlapping passages count once.
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, x: F.struct(F.greatest(a["end"], x["to"]).alias("end"), (a["n"] + F.greatest(F.lit(0), x["to"] - F.greatest(a["end"], x["from"]))).alias("n")),
        lambda a: a["n"],
    )
    marked = hit.select("id", "hash", "hits", covered.alias("n_hit"))
    found = marked.join(named.select(F.col("id").alias("id2"), F.col("hash").alias("hash2"), "items"), F.col("id").eqNullSafe(F.col("id2")) & (F.col("hash") == F.col("hash2")))
    out = seen.select("doc_id", "text_hash", "n_words", F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("row"))
    out = out.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left")
    return out.select(
        "doc_id",
        "text_hash",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("hits", F.array().cast("array<struct<from:int,to:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Rows of ``docs``, all columns, without any passage of the benchmark."""
    found = find_passages(docs, benchmark, length, gram).filter("n_hit > 0")
    hit = stored(found.select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).distinct(), "contaminated")
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["hit_id"]) & (F.xxhash64(docs["text"]) == hit["hit_hash"]), "left_anti")
