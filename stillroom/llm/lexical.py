"""Ranked lexical search: the best documents for each item of a query set, by MaxScore with bounds of term pairs.

Documents are indexed in shards. For each term of the items a shard holds its list of documents and impacts, and for
pairs of terms that stand next to each other in an item, ordered by weight, the list of the documents that hold both,
with the greatest impact the two reach together. Both are computed once, before any item is looked at.

An item's terms are taken in the order of their weights. The most that a document can get from the first terms is found
by joining the bounds of single terms and of disjoint neighbouring pairs in the best way (a minimum over a path), which
is closer than the sum of the single bounds, as a document is rarely best for two terms at once. Terms whose joint bound
stays below the score to beat need not propose documents; and where one more term passes it only together with its
neighbour, their pair list proposes in place of the term's whole list. What is proposed is completed term by term,
downwards, as long as its score and the bound of the rest can still win.

The score to beat is known before the shards are searched: of every term and pair list, each shard names its greatest
impacts, and the ``k``-th of them over all shards is reached by ``k`` documents. Items come in blocks of bounded size;
each block is one pass over the documents.

Defined results: null texts have no terms and are no documents of the collection; an item without a known term has no
rows; every row of the items is searched for itself, also when its item_id is null or repeated; rows without a doc_id
come after all others of their score and keep a null doc_id.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stillroom.llm.common import partitions_of, stored

BEST = 20
#: Bytes of item texts searched in one pass.
ITEM_BYTES = 4 << 20
#: Documents of a shard; greatest impacts that a shard names of a list.
SHARD, NAMED = 8192, 4
NO_ID = 2**63 - 1

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text: str | None) -> Counter[bytes]:
    """Terms as UTF-8 bytes: bytes of other letters than ASCII are all above 7F, and lower() changes A-Z alone."""
    return Counter(TERM.findall(text.encode().lower())) if text else Counter()


@dataclass(frozen=True)
class Query:
    """terms and counts are in the order of ascending weight once the weights are known."""

    item: int
    terms: list[int]
    counts: list[int]


def _blocks(items: DataFrame) -> Iterator[tuple[list, dict[bytes, int]]]:
    """Blocks of items: (item, terms) rows and the number of each of their terms."""
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, math.ceil(total / ITEM_BYTES))
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item"), F.lit(n)) == k).select("item", "text").collect()  # of ITEM_BYTES or so
        counted = [(r["item"], terms_of(r["text"])) for r in rows]
        yield counted, {t: i for i, t in enumerate(sorted({t for _, c in counted for t in c}))}


def _postings(vocabulary: dict[bytes, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n, terms, counts = [], [], []
            for text in batch["text"]:
                found = terms_of(text)
                n.append(sum(found.values()))
                own = [(i, tf) for t, tf in found.items() if (i := vocabulary.get(t)) is not None]
                terms.append(np.array([i for i, _ in own], dtype=np.int32))
                counts.append(np.array([tf for _, tf in own], dtype=np.int32))
            out = pd.DataFrame({"id": batch["id"], "no_id": batch["no_id"], "n": n, "terms": terms, "counts": counts})
            yield out[out["n"] > 0]

    return run


def _shards(weights: np.ndarray, pairs: list[tuple[int, int]], n_docs: int, n_terms: int):
    """Index rows of each shard. a = -1: the documents; b = -1: the list of term a; else the list of the pair."""
    partners: dict[int, list[int]] = {}
    for a, b in pairs:
        partners.setdefault(a, []).append(b)

    def greatest(values: np.ndarray) -> np.ndarray:
        return np.sort(np.partition(values, len(values) - NAMED)[-NAMED:]) if len(values) > NAMED else np.sort(values)

    def index(shard: int, rows: pd.DataFrame) -> pd.DataFrame:
        sizes = np.array([len(t) for t in rows["terms"]])
        doc = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
        term, tf = (np.concatenate(list(rows[c])).astype(np.int64) if sizes.sum() else np.zeros(0, dtype=np.int64) for c in ("terms", "counts"))
        m = 100 - 25 + (25 * rows["n"].to_numpy() * n_docs) // n_terms
        impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[doc])
        order = np.argsort(term, kind="stable")
        term, doc, impact = term[order], doc[order], impact[order]
        present, starts = np.unique(term, return_index=True)
        lists = {int(t): (doc[s:e], impact[s:e]) for t, s, e in zip(present, starts, np.append(starts, len(term))[1:], strict=True)}
        out = [(-1, -1, np.stack([rows["id"].to_numpy(), rows["no_id"].to_numpy().astype(np.int64)]).tobytes(), b"", [], 0)]
        dense = np.zeros(len(rows), dtype=np.int64)
        for a, (docs, values) in lists.items():
            out.append((a, -1, docs.tobytes(), values.astype(np.int32).tobytes(), greatest(values * weights[a]), int(values.max())))
            dense[docs] = values
            for b in partners.get(a, ()):
                if b in lists:
                    docs_b, values_b = lists[b]
                    both = dense[docs_b] > 0
                    joint = dense[docs_b][both] * weights[a] + values_b[both] * weights[b]
                    if len(joint):
                        out.append((a, b, docs_b[both].tobytes(), b"", greatest(joint), int(joint.max())))
            dense[docs] = 0
        made = pd.DataFrame(out, columns=["a", "b", "docs", "impacts", "named", "most"])
        made.insert(0, "shard", shard)
        return made

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), SHARD):
                rows = batch.iloc[at : at + SHARD]
                yield index(int(rows["at"].iloc[0]), rows)

    return run


class _Shard:
    """The lists of one shard, as the index holds them."""

    def __init__(self, rows: pd.DataFrame, weights: np.ndarray):
        self.lists, self.pairs, self.most, self.joint = {}, {}, {}, {}
        for a, b, docs, impacts, most in zip(rows["a"], rows["b"], rows["docs"], rows["impacts"], rows["most"], strict=True):
            if a < 0:
                self.ids, self.no_ids = np.frombuffer(docs, dtype=np.int64).reshape(2, -1)
            elif b < 0:
                self.lists[a] = np.frombuffer(docs, dtype=np.int32), np.frombuffer(impacts, dtype=np.int32) * weights[a]
                self.most[a] = most * weights[a]
            else:
                self.pairs[a, b], self.joint[a, b] = np.frombuffer(docs, dtype=np.int32), most

    def bounds(self, terms: list[int], counts: list[int]) -> np.ndarray:
        """bounds[k]: the most that the first k terms give a document."""
        out = np.zeros(len(terms) + 1, dtype=np.int64)
        for k, (t, c) in enumerate(zip(terms, counts, strict=True), 1):
            out[k] = out[k - 1] + c * self.most[t]
            if k > 1:
                u, d = terms[k - 2], counts[k - 2]
                pair = max(c * self.most[t], d * self.most[u], max(c, d) * self.joint.get((u, t), 0))
                out[k] = min(out[k], out[k - 2] + pair)
        return out

    def search(self, query: Query, beat: int, k: int) -> list[tuple[int, int]]:
        """(place, score) of the documents among the shard's best ``k`` with a score of ``beat`` at least."""
        own = [(t, c) for t, c in zip(query.terms, query.counts, strict=True) if t in self.lists]
        terms, counts = [t for t, _ in own], [c for _, c in own]
        if not terms:
            return []
        bounds = self.bounds(terms, counts)
        quiet = int(np.searchsorted(bounds, beat, side="left")) - 1  # the first terms that cannot reach it alone
        score, proposed = np.zeros(len(self.ids), dtype=np.int64), np.zeros(len(self.ids), dtype=bool)
        if 0 < quiet < len(terms) and (pair := (terms[quiet - 1], terms[quiet])) in self.pairs:
            one = max(counts[quiet - 1] * self.most[pair[0]], counts[quiet] * self.most[pair[1]])
            if bounds[quiet - 1] + one < beat:  # neither of the two can without the other
                proposed[self.pairs[pair]] = True
                quiet += 1
        for t, c in zip(terms[quiet:], counts[quiet:], strict=True):
            docs, values = self.lists[t]
            score[docs] += c * values
            proposed[docs] = True
        going = np.flatnonzero(proposed)
        for place in range(quiet, 0, -1):
            if len(going) > k:
                beat = max(beat, int(np.partition(score[going], len(going) - k)[-k]))
            going = going[score[going] + bounds[place] >= beat]
            docs, values = self.lists[terms[place - 1]]
            at = np.minimum(np.searchsorted(docs, going), len(docs) - 1)
            score[going] += np.where(docs[at] == going, counts[place - 1] * values[at], 0)
        going = going[score[going] >= max(beat, 1)]
        best = going[np.lexsort((self.ids[going], self.no_ids[going], -score[going]))][:k]
        return [(int(d), int(score[d])) for d in best]


def _searched(queries: list[Query], beats: dict[int, int], weights: np.ndarray, k: int):
    """The best documents of each shard, over index rows ordered by shard."""

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        shard = _Shard(rows, weights)
        found = [(q.item, shard.ids[d], bool(shard.no_ids[d]), score) for q in queries for d, score in shard.search(q, beats[q.item], k)]
        return pd.DataFrame(found, columns=["item", "id", "no_id", "score"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: list[pd.DataFrame] = []
        for batch in batches:
            for name, rows in batch.groupby("shard"):
                if parts and parts[0]["shard"].iloc[0] != name:
                    yield search(pd.concat(parts))
                    parts = []
                parts.append(rows)
        if parts:
            yield search(pd.concat(parts))

    return run


def search(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: for each row of ``items`` (item_id, text) the ``k`` documents of ``docs`` (doc_id,
    text) with the highest score above 0, equal scores by ascending doc_id."""
    items = stored(items.select("item_id", "text", F.monotonically_increasing_id().alias("item")), "items")
    rows = docs.select(F.coalesce(docs["doc_id"].cast("long"), F.lit(NO_ID)).alias("id"), docs["doc_id"].isNull().alias("no_id"), docs["text"])
    parts = [_block(rows, counted, vocabulary, k) for counted, vocabulary in _blocks(items)]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), "no_id", "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    doc = F.when(~F.col("no_id"), F.col("id")).alias("doc_id")
    return stored(ranked, "ranked").join(items.select("item", "item_id"), "item").select("item_id", "rank", doc, "score")


def _block(rows: DataFrame, counted: list, vocabulary: dict[bytes, int], k: int) -> DataFrame:
    """(item, id, no_id, score): the best of each shard for each item of a block."""
    spark = rows.sparkSession
    postings = rows.mapInPandas(_postings(vocabulary), "id long, no_id boolean, n long, terms array<int>, counts array<int>")
    postings = stored(postings.withColumn("at", F.monotonically_increasing_id()), "postings")
    n_docs, n_terms = postings.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs:
        return spark.createDataFrame([], "item long, id long, no_id boolean, score long")
    held = {r["term"]: r["count"] for r in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect()}  # of the block's terms
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(i, 0) + 1))) for i in range(len(vocabulary))], dtype=np.int64)
    queries = []
    for item, found in counted:
        known = sorted((int(weights[i]), i, c) for t, c in found.items() if held.get(i := vocabulary[t]))
        queries.append(Query(item, [i for _, i, _ in known], [c for _, _, c in known]))
    pairs = sorted({pair for q in queries for pair in zip(q.terms, q.terms[1:])})
    index = postings.mapInPandas(_shards(weights, pairs, n_docs, n_terms), "shard long, a int, b int, docs binary, impacts binary, named array<long>, most long")
    index = stored(index, "term-index")
    named = index.select("a", "b", F.explode("named").alias("impact"))
    place = F.row_number().over(Window.partitionBy("a", "b").orderBy(F.desc("impact")))
    reached = {(r["a"], r["b"]): r["impact"] for r in named.withColumn("place", place).filter(F.col("place") <= k).filter(F.col("place") == k).select("a", "b", "impact").collect()}
    beats = {}
    for q in queries:
        singles = [c * reached.get((t, -1), 0) for t, c in zip(q.terms, q.counts, strict=True)]
        doubles = [min(c, d) * reached.get((t, u), 0) for t, u, c, d in zip(q.terms, q.terms[1:], q.counts, q.counts[1:])]
        beats[q.item] = max([1, *singles, *doubles])
    dealt = index.drop("named").repartition(partitions_of(spark), "shard").sortWithinPartitions("shard")
    return stored(dealt.mapInPandas(_searched(queries, beats, weights, k), "item long, id long, no_id boolean, score long"), "shard-best")
