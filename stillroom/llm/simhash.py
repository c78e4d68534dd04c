"""Near-duplicate documents by SimHash fingerprints and a binary trie self-join.

A fingerprint bit is set if it is set in more than half of the hashes of a text's word 3-grams, repeats included.
Fingerprints link at three or fewer differing bits (``hamming.links_within``); a document's component is the smallest
doc_id that links lead to.

Defined results: texts that are null or without a word have fingerprint 0, which links like any other; one or two words
are one shingle; a component whose doc_ids are all null has a null id, and is represented by one of its rows all the same. Copies share a fingerprint and meet as one value.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stillroom.llm.common import stored
from stillroom.llm.components import components
from stillroom.llm.hamming import links_within

SHINGLE = 3
SEED = 42
#: Hashes whose bits are added up at once.
BLOCK = 1 << 15


def fingerprint(text: str | None) -> int:
    """As a signed 64-bit number."""
    words = text.encode().lower().split() if text else []  # bytes: only A-Z change, only ASCII white space parts
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    ends = list(accumulate(map(len, words), lambda end, size: end + 1 + size))
    starts = [0, *(end + 1 for end in ends[:-1])]
    spans = zip(starts, ends[SHINGLE - 1 :]) if len(words) >= SHINGLE else [(0, len(joined))]
    hashes = np.frombuffer(b"".join([digest(joined[s:e], SEED) for s, e in spans]), dtype=np.uint8).reshape(-1, 8)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        counts += np.unpackbits(hashes[at : at + BLOCK], axis=1).sum(axis=0, dtype=np.uint16)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big", signed=True)


@F.pandas_udf(T.LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def _marked(docs: DataFrame) -> DataFrame:
    return stored(docs.select(docs["doc_id"], fingerprints(docs["text"]).alias("fp"), F.xxhash64(docs["text"]).alias("text_hash")), "fingerprints")


def _component_ids(marked: DataFrame, bucket_limit: int, named: bool = False) -> DataFrame:
    """(fp, component_id) for every fingerprint; with ``named`` (fp, root), the fingerprint that names its component."""
    values = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprint-values")
    roots = stored(components(links_within(values.select("fp"), bucket_limit)), "fingerprint-roots")
    if named:
        linked = roots.select(F.col("node").alias("fp"), "root")
        return stored(values.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root")), "components")
    ids = roots.join(values, roots["node"] == values["fp"]).groupBy("root").agg(F.min("least").alias("component_id"))
    linked = roots.join(stored(ids, "component-ids"), "root").select(F.col("node").alias("fp"), F.col("component_id"), F.lit(True).alias("linked"))
    own = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("least"))
    return stored(values.join(stored(linked, "linked"), "fp", "left").select("fp", own.alias("component_id")), "components")


def near_duplicates(docs: DataFrame, bucket_limit: int = 1 << 17) -> DataFrame:
    """A row for each row of ``docs``: doc_id, fingerprint (16 hexadecimal digits), component_id."""
    marked = _marked(docs)
    named = marked.join(_component_ids(marked, bucket_limit), "fp")
    return named.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_representatives(docs: DataFrame, bucket_limit: int = 1 << 17) -> DataFrame:
    """Rows of ``docs``, all columns: one of each component, the one with the least doc_id (rows without one come last).

    Should that doc_id be repeated, the row with the smallest hash of its text stays, once.
    """
    marked = _marked(docs)
    parts = _component_ids(marked, bucket_limit, named=True)
    # A component is named by its least fingerprint, which is there whether or not any of its rows has a doc_id.
    naming = marked.join(parts, "fp").select("root", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash").alias("row"))
    least = naming.groupBy("root").agg(F.min("row").alias("row"))
    kept = stored(least.select(F.col("row.doc_id").alias("kept_id"), F.col("row.text_hash").alias("kept_hash")), "representatives")

    def chosen(rows: DataFrame, text_hash: Column) -> DataFrame:
        return rows.join(kept, rows["doc_id"].eqNullSafe(kept["kept_id"]) & (text_hash == kept["kept_hash"]), "left_semi")

    rows, text_hash = chosen(docs, F.xxhash64(docs["text"])), "__kept_text_hash"
    repeats = chosen(marked, marked["text_hash"]).groupBy("doc_id", "text_hash").count().filter("count > 1")
    return rows if repeats.isEmpty() else rows.withColumn(text_hash, F.xxhash64("text")).dropDuplicates(["doc_id", text_hash]).drop(text_hash)
