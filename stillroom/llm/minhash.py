"""Near-duplicate documents by MinHash bands and sequential Bayesian verification.

A document's set holds its distinct shingles of ``SHINGLE`` words. Equal sets are one class from the start; only classes
meet further on. ``BANDS`` bands of ``ROWS`` least hashes propose candidates; at the similarity asked for a pair escapes
all of them with a chance below 1e-7. The signatures of a candidate pair are compared batch by batch: as soon as the
posterior chance that the pair is similar enough falls below ``MISS``, the pair is dropped. What survives is verified on
the full sets.

No bucket gives all its pairs. First every class meets the least and the greatest class of each of its buckets, and what
survives is verified and joined to components. A bucket whose classes then lie in one component is done, however large
it is. In the others, classes of different components meet, a bounded block against a bounded block in one task that has
their full sets: it leaves two components alone once a link has joined them, gives back only such links, and takes a
pair up in the first band it shares, not in each.

Defined results: a text that is null or without a word has an empty set, is linked with nothing and keeps its own id; a
text of fewer words than a shingle is one shingle. Rows of a null doc_id take part; a component without any doc_id has a
null id, and its rows count as kept. Repeated rows share their set.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate
from math import lgamma

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stillroom.llm.common import partitions_of, stored
from stillroom.llm.components import components

SHINGLE = 4
#: Similarity in percent from which two sets are linked.
PERCENT = 80
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: Hashes compared before the posterior is looked at again.
BATCH = 16
#: Chance of dropping a pair that is similar enough, at each look.
MISS = 1e-6
#: Classes and shingles of one side of a block; pairs compared at once.
BLOCK, BLOCK_SHINGLES, CHUNK = 2048, 1 << 20, 1 << 17
#: Shingles whose hashes are drawn at once.
DRAWN = 4096

_random = np.random.default_rng(20)
FACTORS = _random.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingle_hashes(text: str | None, words_each: int = SHINGLE) -> np.ndarray:
    """The different 64-bit hashes of a text's shingles, in order."""
    words = text.encode().lower().split() if text else []  # bytes: only A-Z change, only ASCII white space parts
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    ends = list(accumulate(map(len, words), lambda end, size: end + 1 + size))
    starts = [0, *(end + 1 for end in ends[:-1])]
    spans = zip(starts, ends[words_each - 1 :]) if len(words) >= words_each else [(0, len(joined))]
    return np.unique(np.frombuffer(b"".join([digest(joined[s:e]) for s, e in spans]), dtype=">u8").astype(np.uint64))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least of each of ``HASHES`` random orders, as 32 bits."""
    least = np.full(HASHES, np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(hashes), DRAWN):
        drawn = hashes[at : at + DRAWN, None] * FACTORS + SHIFTS
        least = np.minimum(least, (drawn >> np.uint64(32)).min(axis=0).astype(np.uint32))
    return least


def least_matches(percent: int = PERCENT, miss: float = MISS) -> np.ndarray:
    """For each batch, the least number of equal hash bytes so far with which a pair is followed further.

    The similarity is uniform beforehand. Two bytes are equal where the hashes are, and else once in 256 times.
    """
    similarity = (np.arange(20_000) + 0.5) / 20_000
    equal = similarity + (1 - similarity) / 256
    enough = similarity >= percent / 100
    least = []
    for n in range(BATCH, HASHES + 1, BATCH):
        for m in range(n + 1):
            weight = lgamma(n + 1) - lgamma(m + 1) - lgamma(n - m + 1) + m * np.log(equal) + (n - m) * np.log1p(-equal + 1e-15)
            weight = np.exp(weight - weight.max())
            if weight[enough].sum() >= miss * weight.sum():
                least.append(m)
                break
    return np.array(least)


def survivors(left: np.ndarray, right: np.ndarray, i: np.ndarray, j: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs (i, j) of signature rows that pass every look, and the number of their equal bytes."""
    at, equal = np.arange(len(i)), np.zeros(len(i), dtype=np.int64)
    for k, needed in enumerate(least):
        part = slice(k * BATCH, (k + 1) * BATCH)
        equal = equal + (left[i[at], part] == right[j[at], part]).sum(axis=1)
        going = equal >= needed
        at, equal = at[going], equal[going]
    return at, equal


def _marks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """doc_id and loc with the number of shingles, the set's 128-bit name, the low bytes of the signature, its bands."""
    for batch in batches:
        rows = []
        for text in batch["text"]:
            hashes = shingle_hashes(text)
            if not len(hashes):
                rows.append((0, None, None, None))
                continue
            least = signature(hashes)
            bands = [xxhash.xxh64_intdigest(least[b * ROWS : (b + 1) * ROWS].tobytes(), b) for b in range(BANDS)]
            rows.append((len(hashes), xxhash.xxh3_128_digest(hashes.tobytes()), (least & 255).astype(np.uint8).tobytes(), np.array(bands, dtype=np.uint64).view(np.int64)))
        made = pd.DataFrame(rows, columns=["n", "set", "sig", "bands"], index=batch.index)
        yield pd.concat([batch.drop(columns="text"), made], axis=1)


def _set_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [shingle_hashes(text) for text in batch["text"]]
        yield pd.DataFrame({"set": [xxhash.xxh3_128_digest(h.tobytes()) for h in found], "hashes": [h.tobytes() for h in found]})


def _rows(values: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype=np.uint8).reshape(len(values), HASHES)


def _close(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Sizes of two sets that can be similar enough."""
    return 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)


def _look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs (a, b) that pass every look."""
    least = least_matches()
    for batch in batches:
        batch = batch[_close(batch["n_a"].to_numpy(), batch["n_b"].to_numpy())]
        if len(batch):
            own = np.arange(len(batch))
            at, _ = survivors(_rows(batch["sig_a"]), _rows(batch["sig_b"]), own, own, least)
            yield batch[["a", "b"]].iloc[at]


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs whose full sets are similar enough."""
    for batch in batches:
        linked = []
        for x, y in zip(batch["hashes_a"], batch["hashes_b"], strict=True):
            linked.append(_similar(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)))
        yield batch.loc[linked, ["a", "b"]]


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= PERCENT * (len(x) + len(y) - shared)


def _joined(rows: pd.DataFrame, least: np.ndarray) -> list[tuple[bytes, bytes]]:
    """Links that join the components of one pair of blocks. side 0 is the left block, side 1 the right one, side 2 a
    block against itself. A pair of components is left as soon as a link has joined it."""
    left, right = rows[rows["side"] != 1], rows[rows["side"] != 0]
    if not len(left) or not len(right):
        return []
    itself = bool((rows["side"] == 2).any())
    codes, _ = pd.factorize(pd.concat([left["root"], right["root"]]))
    parent = list(range(int(codes.max()) + 1))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    (root_l, n_l, sig_l, bands_l, sets_l), (root_r, n_r, sig_r, bands_r, sets_r) = (
        (code, of["n"].to_numpy(), _rows(of["sig"]), np.stack(of["bands"].to_numpy()), [np.frombuffer(h, dtype=np.uint64) for h in of["hashes"]])
        for code, of in ((codes[: len(left)], left), (codes[len(left) :], right))
    )
    bucket, links = rows["bucket"].iloc[0], []
    step = max(1, CHUNK // len(right))
    for at in range(0, len(left), step):
        i, j = (x.ravel() for x in np.meshgrid(np.arange(at, min(at + step, len(left))), np.arange(len(right)), indexing="ij"))
        apart = (root_l[i] != root_r[j]) & _close(n_l[i], n_r[j])
        if itself:
            apart &= i < j
        i, j = i[apart], j[apart]
        k, equal = survivors(sig_l, sig_r, i, j, least)
        k = k[np.argsort(-equal, kind="stable")]
        i, j = i[k], j[k]
        for low in range(0, len(i), CHUNK // BANDS):
            x, y = i[low : low + CHUNK // BANDS], j[low : low + CHUNK // BANDS]
            common = bands_l[x] == bands_r[y]
            here = bands_l[x, common.argmax(axis=1)] == bucket  # else it is the work of a bucket of an earlier band
            for u, v in zip(x[here].tolist(), y[here].tolist(), strict=True):
                ends = find(int(root_l[u])), find(int(root_r[v]))
                if ends[0] != ends[1] and _similar(sets_l[u], sets_r[v]):
                    parent[max(ends)] = min(ends)
                    links.append((left["set"].iloc[u], right["set"].iloc[v]))
    return links


def _join_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of partitions ordered by (bucket, i, j)."""
    least, parts, name = least_matches(), [], None

    def links() -> Iterator[pd.DataFrame]:
        if parts and (found := _joined(pd.concat(parts, ignore_index=True), least)):
            yield pd.DataFrame(found, columns=["a", "b"])

    for batch in batches:
        names = list(zip(batch["bucket"], batch["i"], batch["j"], strict=True))
        starts = [k for k in range(len(names)) if k == 0 or names[k] != names[k - 1]]
        for s, e in zip(starts, [*starts[1:], len(names)], strict=True):
            if names[s] != name:
                yield from links()
                parts, name = [], names[s]
            parts.append(batch.iloc[s:e])
    yield from links()


class _Sets:
    """The classes of ``docs``: rows of documents, and one row for each different set."""

    def __init__(self, docs: DataFrame):
        # Ids go through the tasks as text: beside a null, pandas would make them floating-point numbers.
        self.texts = docs.select(docs["doc_id"].cast("string"), F.xxhash64(docs["doc_id"], docs["text"]).alias("loc"), docs["text"])
        of_id = docs.schema["doc_id"].dataType.simpleString()
        marked = self.texts.mapInPandas(_marks, "doc_id string, loc long, n long, set binary, sig binary, bands array<long>")
        self.marked = stored(marked.withColumn("doc_id", F.col("doc_id").cast(of_id)), "marked")
        known = self.marked.filter("set IS NOT NULL").groupBy("set", "n", "sig", "bands")
        self.sets = stored(known.agg(F.min("doc_id").alias("least"), F.min("loc").alias("loc")), "sets")

    def full(self, needed: DataFrame) -> DataFrame:
        """The full sets (set, hashes) of the classes ``needed`` (set), drawn again from one text each."""
        own = stored(self.sets.join(needed, "set", "left_semi").select("loc"), "needed-texts")
        drawn = self.texts.join(own, "loc", "left_semi").select("text").mapInPandas(_set_hashes, "set binary, hashes binary")
        return stored(drawn.dropDuplicates(["set"]), "full-sets")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of classes whose full sets are similar enough."""
        full = self.full(stored(pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct(), "needed"))
        a, b = (full.select(F.col("set").alias(x), F.col("hashes").alias(f"hashes_{x}")) for x in "ab")
        return stored(pairs.join(a, "a").join(b, "b").select("a", "b", "hashes_a", "hashes_b").mapInPandas(_verify, "a binary, b binary"), "verified")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _links(of: _Sets) -> DataFrame:
    """(node, root) for the classes that have a link."""
    spark = of.sets.sparkSession
    # Buckets hold their classes by 64 bits of their names; should two classes share these, both are compared. One shuffle
    # of narrow rows serves the counts and what is joined with them.
    members = of.sets.select(F.xxhash64("set").alias("short"), F.explode("bands").alias("bucket")).repartition(partitions_of(spark), "bucket")
    buckets = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("short").alias("first"), F.max("short").alias("last")).filter("size > 1")
    shared = stored(members.join(buckets, "bucket"), "shared-buckets")
    ends = shared.select("short", F.explode(F.array("first", "last")).alias("end")).distinct()
    a, b = (of.sets.select(F.xxhash64("set").alias(by), F.col("set").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}")) for by, x in (("short", "a"), ("end", "b")))
    star = ends.join(a, "short").join(b, "end").filter("a <> b").select("a", "b", "n_a", "n_b", "sig_a", "sig_b")
    looked = stored(_ordered(star.mapInPandas(_look, "a binary, b binary")).distinct(), "star-survivors")
    links = of.verified(looked)
    roots = stored(components(links), "roots")
    wide = shared.filter("size > 3").select("bucket", "short")  # up to three, the star has tested all pairs
    rooted = wide.join(of.sets.select(F.xxhash64("set").alias("short"), "set", "n"), "short").join(roots.withColumnRenamed("node", "set"), "set", "left")
    rooted = stored(rooted.select("bucket", "set", F.coalesce("root", "set").alias("root"), "n"), "rooted")
    counts = rooted.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles"))
    top = F.max_by(F.struct("root", "rows", "shingles"), F.struct("rows", "root")).alias("top")
    mixed = counts.groupBy("bucket").agg(top, F.sum("rows").alias("rows"), F.sum("shingles").alias("shingles"), F.count(F.lit(1)).alias("roots")).filter("roots > 1")
    rest_rows, rest_shingles = F.col("rows") - F.col("top.rows"), F.col("shingles") - F.col("top.shingles")
    mixed = stored(mixed.select("bucket", F.col("top.root").alias("major"), _blocks_for(F.col("top.rows"), F.col("top.shingles")).alias("p"), _blocks_for(rest_rows, rest_shingles).alias("q")), "mixed")
    members = stored(rooted.join(mixed, "bucket"), "mixed-members")
    full = of.full(stored(members.select("set").distinct(), "needed"))
    whole = of.sets.select("set", "n", "sig", "bands").join(full, "set")
    dealt = _blocks(members).join(whole, "set").select("bucket", "i", "j", "side", "set", "root", "n", "sig", "bands", "hashes")
    dealt = dealt.repartition(partitions_of(spark), "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    more = stored(dealt.mapInPandas(_join_blocks, "a binary, b binary"), "block-links")
    return roots if more.isEmpty() else stored(components(links.unionByName(more)), "roots")


def _blocks_for(rows: Column, shingles: Column) -> Column:
    return F.greatest(F.ceil(rows / BLOCK), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def _blocks(rows: DataFrame) -> DataFrame:
    """Members of mixed buckets, dealt to pairs of blocks. Members of a bucket's largest component, which need not meet
    each other, go with each block of the other members, once in the usual case of one such block."""
    rows = rows.withColumn("mine", F.xxhash64("set"))
    majors = rows.filter("root = major").select("bucket", "set", "root", F.explode(F.sequence(F.lit(0), F.col("q") - 1)).alias("i"), (F.col("q") + F.pmod("mine", "p")).cast("int").alias("j"), F.lit(1).alias("side"))
    minors = rows.filter("root <> major").withColumn("own", F.pmod("mine", "q").cast("int"))
    against = minors.select("bucket", "set", "root", F.explode(F.sequence(F.lit(0), F.col("p") + F.col("q") - 1)).alias("other"), "own")
    low, high = F.least("own", "other"), F.greatest("own", "other")
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return majors.unionByName(against.select("bucket", "set", "root", low.alias("i"), high.alias("j"), side.alias("side")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_shingles, component_id (the least doc_id that links lead to) and kept
    (it is the document that names its component)."""
    of = _Sets(docs)
    roots = _links(of)
    ids = stored(roots.join(of.sets.select(F.col("set").alias("node"), "least"), "node").groupBy("root").agg(F.min("least").alias("component_id")), "component-ids")
    linked = roots.join(ids, "root").select(F.col("node").alias("set"), "component_id", F.lit(True).alias("linked"))
    named = of.sets.select("set", "least").join(stored(linked, "linked"), "set", "left")
    named = stored(named.select("set", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("least")).alias("component_id"), F.lit(True).alias("named")), "named-sets")
    rows = of.marked.select("doc_id", "n", "set").join(named, "set", "left")
    component = F.when(F.col("named"), F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
