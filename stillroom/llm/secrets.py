"""Secrets in texts: candidates by pattern, false positives removed by a random forest.

A candidate is a run of 12 or more characters of the alphabets that keys are written in, with a digit among them. The
forest sees its length and make-up, its transitions between classes of characters and between letters (against a table
of letter pairs counted over all documents), the share of it that words of all documents cover, marks of the path, and
the words around it. It is trained from labelled findings (``findings``: values of known kinds planted in passages, or
the caller's own); at most ``train_rows`` different values of them, chosen by hash, are used. Word and letter-pair counts cover all documents.

Defined results: null and empty texts have no candidates. Labels of one kind only, or none, train no forest; no
candidate then counts as a secret, and scores are null. Rows that repeat a document have their findings each. Findings carry a
hash of the value and never the value.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stillroom.llm.common import ascii_lower, stored
from stillroom.llm.findings import KINDS, Kind, planted
from stillroom.session import scratch_path

CANDIDATE = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{12,}={0,2}"
BEFORE, AFTER = 48, 24
REDACTED = "<SECRET>"
KEYWORDS = r"(?i)(token|secret|passw(or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|auth|credential|bearer)[^A-Za-z0-9]*$"
HARMLESS = r"(?i)(example|sample|dummy|placeholder|checksum|sha1|sha256|md5|commit|uuid|invoice|order|card|phone|isbn|serial)[^A-Za-z0-9]*$"
TEST_PATH = r"(?i)(^|[/_.-])(tests?|examples?|samples?|fixtures?|mocks?|docs?)([/_.-]|$)"
CONFIG_PATH = r"(?i)\.(env|ya?ml|json|ini|cfg|conf|properties|pem|tf)$"
FEATURES = [
    "f_length", "f_digits", "f_upper", "f_lower", "f_marks", "f_distinct", "f_changes", "f_pairs", "f_dictionary",
    "f_keyword", "f_harmless", "f_assigned", "f_quoted", "f_word_after", "f_test_path", "f_config_path", "f_path_depth",
]
#: The log-probability of a pair with a character that is no letter.
OTHER_PAIR = math.log(1 / 1000)


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """A row for each candidate: doc_id, text_hash, path, k (its number in the text), start (code points before it),
    value, before and after (the text around it)."""
    rows = docs.select(docs["doc_id"], F.xxhash64(docs["text"]).alias("text_hash"), docs[path].cast("string").alias("path"), docs["text"]).filter(F.rlike("text", F.lit(CANDIDATE)))
    rows = rows.select("doc_id", "text_hash", "path", F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"), F.split("text", CANDIDATE, -1).alias("gaps"))
    starts = F.aggregate(
        F.sequence(F.lit(0), F.size("found") - 1),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda a, i: F.struct(
            (a["at"] + F.length(F.col("gaps")[i]) + F.length(F.col("found")[i])).alias("at"), F.concat(a["starts"], F.array(a["at"] + F.length(F.col("gaps")[i]))).alias("starts")
        ),
        lambda a: a["starts"],
    )
    rows = rows.select("doc_id", "text_hash", "path", "found", starts.alias("starts"), F.transform("gaps", lambda g: F.struct(F.right(g, F.lit(BEFORE)).alias("end"), F.left(g, F.lit(AFTER)).alias("begin"))).alias("gaps"))
    one = F.transform("found", lambda v, i: F.struct(i.alias("k"), F.col("starts")[i].alias("start"), v.alias("value"), F.col("gaps")[i]["end"].alias("before"), F.col("gaps")[i + 1]["begin"].alias("after")))
    return rows.select("doc_id", "text_hash", "path", F.inline(one))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of the runs of three or more letters a-z in all documents."""
    words = docs.select(F.explode(F.split(ascii_lower(docs["text"]), "[^a-z]+")).alias("word"))
    return words.filter(F.length("word") >= 3).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def letter_pairs(words: DataFrame) -> list[float]:
    """Log-probabilities of the second letter after the first, smoothed; 676 numbers, whatever the corpus."""
    letters = F.split("word", "")
    at = F.explode(F.sequence(F.lit(0), F.length("word") - 2)).alias("i")
    pairs = words.select("n", letters.alias("letters"), at).select("n", F.col("letters")[F.col("i")].alias("a"), F.col("letters")[F.col("i") + 1].alias("b"))
    counts = {(r["a"], r["b"]): r["n"] for r in pairs.groupBy("a", "b").agg(F.sum("n").alias("n")).collect()}
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    totals = {a: sum(counts.get((a, b), 0) for b in alphabet) for a in alphabet}
    return [math.log((counts.get((a, b), 0) + 1) / (totals[a] + 26)) for a in alphabet for b in alphabet]


def _share(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.length(value)


def featured(found: DataFrame, words: DataFrame, pairs: list[float], min_count: int = 5) -> DataFrame:
    """``candidates`` with the columns FEATURES. words: ``word_counts``, stored; a word of the dictionary occurs
    ``min_count`` times or more."""
    value = F.col("value")
    runs = found.select("value").distinct().select("value", F.explode(F.regexp_extract_all(F.lower(value), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    known = words.filter(F.col("n") >= min_count).select("word")
    covered = stored(runs.join(known, "word").groupBy("value").agg(F.sum(F.length("word")).alias("covered")), "covered")
    table = F.array(*(F.lit(p) for p in pairs))
    letters = F.transform(F.split(F.lower(value), ""), lambda c: F.ascii(c) - 97)
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0"), "[+/_=-]+", "-")

    def pair(i: Column) -> Column:
        a, b = F.col("letters")[i], F.col("letters")[i + 1]
        return F.when(a.between(0, 25) & b.between(0, 25), F.col("pairs")[a * 26 + b]).otherwise(F.lit(OTHER_PAIR))

    rows = found.join(covered, "value", "left").select(*found.columns, "covered", letters.alias("letters"), table.alias("pairs"))
    mean = F.aggregate(F.sequence(F.lit(0), F.size("letters") - 2), F.lit(0.0), lambda a, i: a + pair(i)) / (F.size("letters") - 1)
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    return rows.select(
        *found.columns,
        F.length(value).cast("double").alias("f_length"),
        _share(value, "[0-9]").alias("f_digits"),
        _share(value, "[A-Z]").alias("f_upper"),
        _share(value, "[a-z]").alias("f_lower"),
        _share(value, "[+/_=-]").alias("f_marks"),
        (F.size(F.array_distinct("letters")) / F.length(value)).alias("f_distinct"),
        ((F.length(classes) - 1) / F.length(value)).alias("f_changes"),
        mean.alias("f_pairs"),
        (F.coalesce("covered", F.lit(0)) / F.length(value)).alias("f_dictionary"),
        flag(F.rlike("before", F.lit(KEYWORDS))).alias("f_keyword"),
        flag(F.rlike("before", F.lit(HARMLESS))).alias("f_harmless"),
        flag(F.rlike("before", F.lit(r"[:=][\s\"']*$"))).alias("f_assigned"),
        flag(F.rlike("before", F.lit("[\"']$"))).alias("f_quoted"),
        flag(F.rlike("after", F.lit(r"^[\s\"',.;]*[A-Za-z]{2}"))).alias("f_word_after"),
        flag(F.rlike("path", F.lit(TEST_PATH))).alias("f_test_path"),
        flag(F.rlike("path", F.lit(CONFIG_PATH))).alias("f_config_path"),
        F.coalesce(F.regexp_count("path", F.lit("/")), F.lit(0)).cast("double").alias("f_path_depth"),
    )


def train(labelled: DataFrame, train_rows: int = 20_000, trees: int = 24, depth: int = 8, seed: int = 7) -> RandomForestClassificationModel | None:
    """labelled: ``featured`` with ``label`` (1 secret, 0 false positive, null not known). One row stands for each value,
    so that a value found everywhere counts once."""
    rows = labelled.filter("label IN (0, 1)").groupBy("value").agg(F.min(F.struct(F.col("label").cast("double").alias("label"), *FEATURES)).alias("x"))
    chosen = stored(rows.orderBy(F.xxhash64("value"), "value").limit(train_rows).select("x.*"), "labelled-findings")
    if chosen.select("label").distinct().count() < 2:
        return None
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(chosen).select("label", "features")
    fitted = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(vectors.coalesce(1))
    # A fitted forest holds its training summary and with it the session, which no task may be sent; a loaded one does not.
    path = scratch_path(labelled.sparkSession, "forest")
    fitted.write().save(path)
    return RandomForestClassificationModel.load(path)


def judged(featured_rows: DataFrame, model: RandomForestClassificationModel | None, threshold: float = 0.5) -> DataFrame:
    """Adds ``score``, the forest's share of votes for a secret, and ``is_secret``. Without a forest nothing is judged a
    secret, and the score is null."""
    if model is None:
        return featured_rows.select("*", F.lit(None).cast("double").alias("score"), F.lit(False).alias("is_secret"))
    kept = [c for c in featured_rows.columns if c not in FEATURES]
    scored = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(featured_rows))
    score = vector_to_array("probability")[1]
    return scored.select(*kept, *FEATURES, score.alias("score")).select("*", (F.col("score") >= threshold).alias("is_secret"))


def labelled_findings(docs: DataFrame, words: DataFrame, pairs: list[float], kinds: Sequence[Kind] = KINDS, passages: int = 200, path: str = "source") -> DataFrame:
    """``featured`` findings with ``label`` and ``kind``: those of values planted in passages of ``docs``."""
    known = stored(planted(docs, kinds, passages, path), "planted")
    value = known.select(F.col("doc_id").alias("_id"), "planted_value", "kind", "label")
    found = candidates(known, "path").join(value, (F.col("doc_id") == F.col("_id")) & (F.col("value") == F.col("planted_value")))
    return featured(stored(found.drop("_id", "planted_value"), "planted-candidates"), words, pairs)


def find_secrets(docs: DataFrame, labelled: DataFrame | None = None, path: str = "source", **settings) -> DataFrame:
    """A row for each candidate: doc_id, text_hash, k, start, length, value_sha256, score, is_secret.

    labelled: findings with ``label`` as ``train`` takes them; by default ``labelled_findings`` of ``docs``.
    """
    found = stored(candidates(docs, path), "candidates")
    words = stored(word_counts(docs), "word-counts")
    pairs = letter_pairs(words)
    rows = stored(featured(found, words, pairs), "featured")
    model = train(labelled if labelled is not None else labelled_findings(docs, words, pairs, path=path), **settings)
    return judged(rows, model).select("doc_id", "text_hash", "k", "start", F.length("value").alias("length"), F.sha2("value", 256).alias("value_sha256"), "score", "is_secret")


def redact(docs: DataFrame, secrets: DataFrame) -> DataFrame:
    """``docs``, all columns, with every secret replaced in ``text`` (and ``n_chars``, if there, counted anew)."""
    gone = secrets.filter("is_secret").groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(F.collect_set("k").alias("_gone"))
    gone = stored(gone, "redactions")
    rows = docs.join(gone, docs["doc_id"].eqNullSafe(gone["_id"]) & (F.xxhash64(docs["text"]) == gone["_hash"]), "left")
    gaps, found = F.split(docs["text"], CANDIDATE, -1), F.regexp_extract_all(docs["text"], F.lit(CANDIDATE), F.lit(0))
    parts = F.zip_with(F.transform(gaps, lambda g, i: F.struct(g.alias("gap"), i.alias("k"))), found, lambda g, v: F.concat(g["gap"], F.when(F.array_contains(gone["_gone"], g["k"]), REDACTED).otherwise(F.coalesce(v, F.lit("")))))
    text = F.when(gone["_gone"].isNull(), docs["text"]).otherwise(F.array_join(parts, ""))
    kinds = dict(docs.dtypes)
    counted = F.when(gone["_gone"].isNull(), docs["n_chars"]).otherwise(F.length(text)).cast(kinds["n_chars"]) if "n_chars" in kinds else None
    return rows.select(*(text.alias(c) if c == "text" else counted.alias(c) if c == "n_chars" else docs[c] for c in docs.columns))
