"""Language identification by a sparse linear model.

Character 1- to 3-grams are hashed into a fixed number of buckets and weighted by TF-IDF. A multinomial logistic
regression over them is trained with follow-the-regularised-leader, whose elastic-net penalty leaves most weights at
zero; a temperature fitted on rows kept out of training turns its margins into probabilities.

The inverse document frequencies come from every training row. The classifier is fitted on at most ``train_rows`` rows,
an equal number of different texts for each language, chosen by the hash of the text, so that the choice depends on the
texts alone. Prediction reads whole texts and nothing else.

Defined results: a text that is null, empty or without a letter is ``und`` with score 0; without any labelled row every
text is ``und``; with one language only, every text with a letter has it; a null ``doc_id`` counts as held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from stillroom.llm.common import stored


UNKNOWN = "und"
BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
#: Code points hashed at a time, which bounds the memory a long text takes.
BLOCK = 1 << 20
#: Odd multipliers, one for each place in an n-gram, and one for the final mix.
PLACES = np.array([2654435761, 2246822519, 3266489917], dtype=np.uint32)
MIX = np.uint32(668265263)
SPACE = 32


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # a row for each language, inverse document frequencies included
    bias: np.ndarray
    idf: np.ndarray
    temperature: float


@cache
def letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def codes_of(text: str | None) -> np.ndarray | None:
    """Code points of the small letters, each run of other characters as one space, a space at both ends; None
    without letters."""
    if not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le"), dtype="<u4")
    is_letter = letters()[codes]
    if not is_letter.any():
        return None
    codes = np.where(is_letter, codes, np.uint32(SPACE))
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    codes = codes[keep]
    ends = [np.array([SPACE], dtype=np.uint32)] * 2
    return np.concatenate([ends[0], codes, ends[1]])


def grams_of(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Buckets of all 1- to 3-grams, block by block."""
    for at in range(0, len(codes), BLOCK):
        part, blocks = codes[at : at + BLOCK + 2], []
        for n in (1, 2, 3):
            size = min(BLOCK, len(part) - n + 1)
            if size <= 0:
                continue
            mixed = part[:size] * PLACES[0]
            for k in range(1, n):
                mixed = (mixed ^ (mixed >> np.uint32(15))) * MIX + part[k : k + size] * PLACES[k]
            mixed = (mixed ^ (mixed >> np.uint32(13))) * MIX
            blocks.append(mixed >> np.uint32(32 - BUCKET_BITS))
        yield np.concatenate(blocks)


def counts_of(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Buckets with their counts over the whole text."""
    codes = codes_of(text)
    if codes is None:
        return None
    total = np.zeros(BUCKETS, dtype=np.int64)
    for grams in grams_of(codes):
        total += np.bincount(grams, minlength=BUCKETS)
    found = np.flatnonzero(total)
    return found, total[found]


def weighted(found: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF with logarithmic term frequency, of length one."""
    values = (1.0 + np.log(counts)) * idf[found]
    norm = np.sqrt((values * values).sum())
    return values / norm if norm > 0 else values


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def document_frequencies(training: DataFrame) -> tuple[np.ndarray, int]:
    """Of every bucket, over all training rows. What reaches the driver is one number for each bucket."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, seen, n = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.uint8), 0
        for batch in batches:
            for text in batch["text"]:
                codes = codes_of(text)
                if codes is None:
                    continue
                parts = list(grams_of(codes))
                for part in parts:
                    seen[part] = 1
                df += seen
                for part in parts:
                    seen[part] = 0
                n += 1
        found = np.flatnonzero(df)
        yield pd.DataFrame({"bucket": np.append(found, -1), "n": np.append(df[found], n)})

    rows = training.select("text").mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df, total = np.zeros(BUCKETS, dtype=np.int64), 0
    for row in rows:
        if row["bucket"] < 0:
            total = row["n"]
        else:
            df[row["bucket"]] = row["n"]
    return df, total


def choose(training: DataFrame, train_rows: int) -> DataFrame:
    """At most ``train_rows`` rows (lang, text, order), equally many different texts for each language."""
    distinct = stored(training.select("lang", F.xxhash64("text").alias("h")).distinct(), "labelled-texts")
    counts = distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each language
    each = max(1, train_rows // max(1, len(counts)))

    def below(bounds: list[tuple[str, int]]) -> Column:
        return reduce(Column.__or__, ((F.col("lang") == x) & (F.col("h") <= b) for x, b in bounds), F.lit(False))

    # Hashes are spread evenly: the least of a language's lie below twice their share of the range, which leaves the
    # ranking few rows however many there are.
    wide = [(r["lang"], -(1 << 63) + min((1 << 64) - 1, (2 * each + 100) * (1 << 64) // r["n"])) for r in counts]
    ranked = distinct.filter(below(wide)).withColumn("k", F.row_number().over(W.partitionBy("lang").orderBy("h"))).filter(F.col("k") <= each)
    bounds = [(r["lang"], r["bound"]) for r in ranked.groupBy("lang").agg(F.max("h").alias("bound")).collect()]
    chosen = training.select("lang", "text", F.xxhash64("text").alias("h")).filter(below(bounds))
    return chosen.groupBy("lang", "h").agg(F.min("text").alias("text"))


def fit_rows(rows: list[tuple[np.ndarray, np.ndarray, int]], n_languages: int, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases by follow-the-regularised-leader with per-coordinate rates. rows: buckets, values, language."""
    z = np.zeros((n_languages, BUCKETS + 1))
    n = np.zeros((n_languages, BUCKETS + 1))

    def weights(at: np.ndarray) -> np.ndarray:
        zs, ns = z[:, at], n[:, at]
        w = -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2)
        w[np.abs(zs) <= l1] = 0.0
        return w

    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            found, values, language = rows[k]
            at, x = np.append(found, BUCKETS), np.append(values, 1.0)
            w = weights(at)
            p = softmax(w @ x)
            p[language] -= 1.0
            gradient = np.outer(p, x)
            ns = n[:, at]
            grown = ns + gradient * gradient
            z[:, at] += gradient - (np.sqrt(grown) - np.sqrt(ns)) / alpha * w
            n[:, at] = grown
    w = weights(np.arange(BUCKETS + 1))
    return w[:, :-1], w[:, -1]


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=0))
    return e / e.sum(axis=0)


def fit_temperature(margins: np.ndarray, truth: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search over its logarithm. margins: languages by rows."""
    if margins.shape[1] == 0:
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(margins / np.exp(log_t))
        return -np.log(np.maximum(p[truth, np.arange(len(truth))], 1e-12)).mean()

    low, high, ratio = -4.0, 4.0, (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(docs: DataFrame, train_rows: int = 4000, epochs: int = 3, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.005, l2: float = 0.01) -> Model | None:
    """Fit on the rows of ``docs`` (doc_id, text, lang) that are not held out. None without a labelled row."""
    training = docs.select("doc_id", "text", "lang").filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    df, total = document_frequencies(training)
    if not total:
        return None
    idf = np.log((1.0 + total) / (1.0 + df)) + 1.0

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [counts_of(t) for t in batch["text"]]
            kept = [k for k, x in enumerate(found) if x is not None]
            yield pd.DataFrame({
                "lang": batch["lang"].iloc[kept].to_numpy(),
                "h": batch["h"].iloc[kept].to_numpy(),
                "found": [found[k][0].astype(np.int32).tobytes() for k in kept],
                "values": [weighted(*found[k], idf).astype(np.float32).tobytes() for k in kept],
            })

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["h", "lang"], kind="stable")
        languages = sorted(set(rows["lang"]))
        number = {x: k for k, x in enumerate(languages)}
        data = [(np.frombuffer(f, dtype=np.int32), np.frombuffer(v, dtype=np.float32).astype(float), number[x]) for f, v, x in zip(rows["found"], rows["values"], rows["lang"], strict=True)]
        calibration = data[::5] if len(data) >= 10 * len(languages) else []
        learned = [x for k, x in enumerate(data) if k % 5] if calibration else data
        weights, bias = fit_rows(learned, len(languages), epochs, alpha, beta, l1, l2)
        margins = np.array([weights[:, f] @ v + bias for f, v, _ in calibration]).T.reshape(len(languages), len(calibration))
        t = fit_temperature(margins, np.array([x[2] for x in calibration], dtype=np.int64))
        return pd.DataFrame({"lang": languages, "weights": [w.astype(np.float32).tobytes() for w in weights], "bias": bias, "temperature": t})

    chosen = choose(training, train_rows).mapInPandas(features, "lang string, h long, found binary, values binary")
    rows = chosen.groupBy(F.lit(1).alias("all")).applyInPandas(fit, "lang string, weights binary, bias double, temperature double").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: r["lang"])
    weights = np.array([np.frombuffer(bytes(r["weights"]), dtype=np.float32) for r in rows])
    return Model(tuple(r["lang"] for r in rows), weights, np.array([r["bias"] for r in rows]), idf, rows[0]["temperature"])


def predictor(model: Model | None):
    """A column function from text to (lang_pred, score)."""

    @F.pandas_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    def predict(texts: pd.Series) -> pd.DataFrame:
        names, scores = [], []
        for text in texts:
            counts = counts_of(text) if model is not None else None
            if counts is None:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            values = weighted(*counts, model.idf)
            p = softmax((model.weights[:, counts[0]] @ values + model.bias) / model.temperature)
            best = int(p.argmax())
            names.append(model.languages[best])
            scores.append(float(min(1.0, p[best])))
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return predict


def identify(docs: DataFrame, model: Model | None = None, **settings) -> DataFrame:
    """A row for each document: doc_id, held_out, lang_pred, score. Trains on ``docs`` unless a model is given."""
    model = model or train(docs, **settings)
    predicted = docs.select(docs["doc_id"], held_out(docs["doc_id"]).alias("held_out"), predictor(model)(docs["text"]).alias("p"))
    return predicted.select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame, model: Model | None = None, min_score: float = 0.5, **settings) -> DataFrame:
    """Rows of ``docs``, all columns, whose language is told with at least ``min_score``."""
    model = model or train(docs, **settings)
    p = predictor(model)(docs["text"])
    return docs.filter((p["lang_pred"] != UNKNOWN) & (p["score"] >= min_score))
