"""All links between 64-bit fingerprints within a Hamming distance, by a self-join of their binary trie.

Two fingerprints that differ in at most three bits agree in one of four blocks of 16 bits. Each fingerprint is therefore
dealt out four times, once for each block moved to the front, and only fingerprints that agree in the front block meet.
There the trie is joined with itself: pairs of its nodes are followed downwards together, the bits in which they differ
are added up, and a pair over the budget is dropped with all below it. A trie node is a range of the sorted
fingerprints, so that a whole level of node pairs is taken in one vector operation.

A front block that more than ``bucket_limit`` fingerprints share is split: of the six bytes behind it, at most three can
differ, so some three agree, and each of the twenty choices of three makes a longer front. At most 2^24 different
fingerprints can agree in such a front of 40 bits; that bounds every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stillroom.llm.common import partitions_of, stored

BUDGET = 3
#: Node pairs followed at once.
FRONTIER = 1 << 19
#: Node pairs of up to so many fingerprint pairs are compared one by one.
LEAF = 32


def find(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = parent[x]
        if (up == x).all():
            return x
        x = up


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[k] and b[k] for each k; a set is named by its least member."""
    while len(a):
        a, b = find(parent, a), find(parent, b)
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def trie_join(keys: np.ndarray, start: int, lows: np.ndarray, highs: np.ndarray, budget: int = BUDGET) -> np.ndarray:
    """For each key, the least position that links lead to. keys: uint64, in order and different within each of the
    ranges [low, high), whose keys agree in the first ``start`` bits."""
    parent = np.arange(len(keys))

    def middle(depth: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The first place in each range whose key has the bit at ``depth``, by halving all ranges at once."""
        low, high, shift = low.copy(), high.copy(), np.uint64(63 - depth)
        while (going := np.flatnonzero(low < high)).size:
            half = (low[going] + high[going]) >> 1
            one = (keys[half] >> shift) & np.uint64(1) == 1
            high[going[one]], low[going[~one]] = half[one], half[~one] + 1
        return low

    def compare(alo, ahi, blo, bhi) -> None:
        """Link by link, for pairs of small nodes."""
        widths = bhi - blo
        sizes = (ahi - alo) * widths
        for at in range(0, len(sizes), FRONTIER // LEAF):
            part = slice(at, at + FRONTIER // LEAF)
            size = sizes[part]
            of = np.repeat(np.arange(len(size)), size)
            k = np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
            i, j = alo[part][of] + k // widths[part][of], blo[part][of] + k % widths[part][of]
            near = (i < j) & (np.bitwise_count(keys[i] ^ keys[j]) <= budget)
            unite(parent, i[near], j[near])

    stack = [(start, lows, highs, lows, highs, np.zeros(len(lows), dtype=np.int8))]
    while stack:
        depth, alo, ahi, blo, bhi, used = stack.pop()
        small = (ahi - alo) * (bhi - blo) <= LEAF
        compare(alo[small], ahi[small], blo[small], bhi[small])
        large = ~small
        alo, ahi, blo, bhi, used = alo[large], ahi[large], blo[large], bhi[large], used[large]
        if not len(alo):
            continue
        amid, bmid = middle(depth, alo, ahi), middle(depth, blo, bhi)
        same = (alo == blo) & (ahi == bhi)
        other = ~same
        children = [
            (alo, amid, blo, bmid, used),
            (amid, ahi, bmid, bhi, used),
            (alo, amid, bmid, bhi, used + 1),
            (amid[other], ahi[other], blo[other], bmid[other], used[other] + 1),
        ]
        joined = [np.concatenate(x) for x in zip(*children, strict=True)]
        ok = (joined[4] <= budget) & (joined[0] < joined[1]) & (joined[2] < joined[3])
        ok &= (joined[0] != joined[2]) | (joined[1] - joined[0] > 1)
        alo, ahi, blo, bhi, used = (x[ok] for x in joined)
        stack += [(depth + 1, *(x[at : at + FRONTIER] for x in (alo, ahi, blo, bhi, used))) for at in range(0, len(alo), FRONTIER)]
    return find(parent, np.arange(len(keys)))


def fronted(fp: Column, block: int) -> Column:
    """The fingerprint turned so that the 16 bits of ``block`` come first."""
    by = 16 * block
    return fp if not by else F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by))


def refronted(turned: Column, three: tuple[int, ...]) -> Column:
    """The six bytes after the front reordered so that the three chosen ones come first."""
    out = turned.bitwiseAND(F.lit(-1 << 48))
    for place, byte in enumerate([*three, *(b for b in range(6) if b not in three)]):
        value = F.shiftrightunsigned(turned, 40 - 8 * byte).bitwiseAND(F.lit(255))
        out = out.bitwiseOR(F.shiftleft(value, 40 - 8 * place))
    return out


def join_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of a partition ordered by (shape, turned): from each fingerprint to the least one it reaches in its bucket.
    Only the last bucket of a batch waits for the next batch, in parts that are put together once."""
    parts: list[pd.DataFrame] = []

    def bucket_of(rows: pd.DataFrame) -> np.ndarray:
        """Positions at which a bucket begins."""
        shape = rows["shape"].to_numpy()
        front = rows["turned"].to_numpy().view(np.uint64) >> np.where(shape < 4, 48, 24).astype(np.uint64)
        return np.flatnonzero(np.concatenate([[True], (shape[1:] != shape[:-1]) | (front[1:] != front[:-1])]))

    def links(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if not len(rows):
            return
        lows = bucket_of(rows)
        highs = np.append(lows[1:], len(rows))
        keys, fps, shape = rows["turned"].to_numpy().view(np.uint64), rows["fp"].to_numpy(), rows["shape"].to_numpy()[lows]
        for start, among in ((16, shape < 4), (40, shape >= 4)):
            several = among & (highs - lows > 1)
            if several.any():
                least = trie_join(keys, start, lows[several], highs[several])
                moved = np.flatnonzero(least != np.arange(len(keys)))
                yield pd.DataFrame({"a": fps[moved], "b": fps[least[moved]]})

    for batch in batches:
        if not len(batch):
            continue
        if parts:  # the front of the batch may belong to the open bucket
            joint = bucket_of(pd.concat([parts[-1].iloc[-1:], batch], ignore_index=True)) - 1
            cut = int(joint[1]) if len(joint) > 1 else len(batch)
            parts.append(batch.iloc[:cut])
            batch = batch.iloc[cut:]
            if not len(batch):
                continue
            yield from links(pd.concat(parts, ignore_index=True))
        last = bucket_of(batch)[-1]
        yield from links(batch.iloc[:last])
        parts = [batch.iloc[last:]]
    if parts:
        yield from links(pd.concat(parts, ignore_index=True))


def links_within(fingerprints: DataFrame, bucket_limit: int = 1 << 17) -> DataFrame:
    """Links (a, b) that connect the different values of ``fingerprints`` (fp long) just as all pairs within three
    differing bits do. Within a bucket there are fewer links than fingerprints."""
    turned = fingerprints.select("fp", F.posexplode(F.array(*(fronted(F.col("fp"), k) for k in range(4)))).alias("shape", "turned"))
    turned = turned.withColumn("front", F.shiftrightunsigned("turned", 48))
    hot = stored(turned.groupBy("shape", "front").count().filter(F.col("count") > bucket_limit).select("shape", "front"), "hot-fronts")
    if hot.isEmpty():
        dealt = turned
    else:
        hot = hot.withColumn("hot", F.lit(True))
        marked = turned.join(hot, ["shape", "front"], "left")
        choices = list(combinations(range(6), 3))
        longer = marked.filter("hot").select("fp", "shape", F.posexplode(F.array(*(refronted(F.col("turned"), c) for c in choices))).alias("choice", "turned"))
        dealt = marked.filter("hot IS NULL").select("fp", "shape", "turned", "front").unionByName(
            longer.select("fp", (4 + F.col("shape") * len(choices) + F.col("choice")).alias("shape"), "turned", F.shiftrightunsigned("turned", 24).alias("front"))
        )
    placed = dealt.repartition(partitions_of(fingerprints.sparkSession), "shape", "front").sortWithinPartitions("shape", "turned")
    return placed.select("shape", "turned", "fp").mapInPandas(join_buckets, "a long, b long")
