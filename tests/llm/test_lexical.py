"""Ranked search against scoring every document, at the limits where bounds decide."""

import math
import random
import re
from collections import Counter

import pytest

from brute import LOWER
from stillroom.llm import lexical as L

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return Counter(TERM.findall((text or "").translate(LOWER)))


def brute(docs, items, k=20):
    counted = [(d, c) for d, t in docs if (c := terms(t))]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    held = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        asked, scored = terms(text), []
        for d, c in counted:
            m = 100 - 25 + 25 * sum(c.values()) * n_docs // n_terms
            score = sum(n * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t, n in asked.items() if t in c)
            scored += [(-score, d is None, d or 0, d)] if score > 0 else []
        out += [(item, rank, d, -score) for rank, (score, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    """Terms from very common to single, texts from one term to many, ties and copies."""
    rnd = random.Random(3)
    words = [f"t{i}" for i in range(200)]
    weights = [1 / (i + 1) for i in range(200)]
    docs = [(i, " ".join(rnd.choices(words, weights, k=rnd.choice([1, 3, 10, 40, 150])))) for i in range(600)]
    docs += [(1000 - i, docs[7][1]) for i in range(40)]
    items = [(i, " ".join(rnd.choices(words, weights, k=rnd.choice([1, 2, 8, 30])))) for i in range(30)]
    items += [(100, docs[7][1]), (101, docs[3][1] + " " + docs[3][1]), (102, "t0 t0 t0 t199"), (103, "unknown"), (104, None), (105, "t1 t2")]
    return docs, items


@pytest.mark.parametrize(("shard", "k", "named"), [(8192, 20, 4), (50, 20, 4), (7, 3, 1), (100, 1, 4)])
def test_against_scoring_every_document(spark, corpus, monkeypatch, shard, k, named):
    docs, items = corpus
    monkeypatch.setattr(L, "SHARD", shard)
    monkeypatch.setattr(L, "NAMED", named)
    out = L.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), k)
    assert found(out) == brute(docs, items, k)


def test_items_in_several_blocks(spark, corpus, monkeypatch):
    docs, items = corpus
    monkeypatch.setattr(L, "ITEM_BYTES", 500)
    out = L.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert found(out) == brute(docs, items)


def test_hard_rows_and_empty_tables(spark, hard, hard_rows, empty):
    items = [(1, "The quick brown fox, and Émile"), (1, "geese 42"), (None, "ein Text über Füchse und die Gänse am Fluss"), (2, ""), (3, "repeat these words"), (3, "repeat these words")]
    table = spark.createDataFrame([(*i, 1, 2) for i in items], "item_id long, text string, rank int, item long")
    assert found(L.search(hard, table)) == brute([(d, t) for d, t, *_ in hard_rows], items)
    assert L.search(empty, table).count() == 0 and L.search(hard, table.filter("false")).count() == 0


def test_pair_bounds_are_closer_than_single_ones_and_hold(spark, corpus):
    """The bound of all of an item's terms lies between the best score and the sum of the single bounds."""
    import numpy as np
    import pandas as pd

    docs, _ = corpus
    names = sorted({t for _, x in docs for t in terms(x)})
    number = {t: i for i, t in enumerate(names)}
    weights = np.arange(1, len(names) + 1, dtype=np.int64)
    rows = pd.DataFrame({"id": [d for d, _ in docs], "no_id": False, "n": [sum(terms(t).values()) for _, t in docs], "at": range(len(docs)),
        "terms": [np.array([number[t] for t in terms(x)], dtype=np.int32) for _, x in docs], "counts": [np.array(list(terms(x).values()), dtype=np.int32) for _, x in docs]})
    asked = [number[f"t{i}"] for i in (0, 1, 2, 3, 4, 5)]
    index = pd.concat(L._shards(weights, list(zip(asked, asked[1:])), len(docs), int(rows["n"].sum()))(iter([rows])))
    shard = L._Shard(index, weights)
    bounds, singles = shard.bounds(asked, [1] * 6), np.cumsum([0, *(shard.most[t] for t in asked)])
    score = np.zeros(len(docs), dtype=np.int64)
    for t in asked:
        at, values = shard.lists[t]
        score[at] += values
    assert (bounds <= singles).all() and bounds[-1] < singles[-1] and score.max() <= bounds[-1]
