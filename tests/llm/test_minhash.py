"""Near-duplicates by MinHash against all pairs of sets, and the parts of the method by themselves."""

import random

import numpy as np
import pytest

from brute import LOWER, WORD
from stillroom.llm import minhash as M


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 4]) for i in range(len(words) - 3)} or ({tuple(words)} if words else set())


def brute(rows):
    """(doc_id, n_shingles, component_id) of each row."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    return [(d, len(sets[i]), min((x for x in groups[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows)]


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id").collect()), key=str)


@pytest.fixture(scope="module")
def near_copies():
    """Texts at all distances of a few originals, so that pairs lie close to the limit on both sides, and chains of
    them lead further than any link."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for size in (5, 8, 30, 120, 400):
        text = rnd.choices(words, k=size)
        for _ in range(25):
            rows.append(" ".join(text))
            text = list(text)
            for _ in range(rnd.choice([0, 1, 1, 2, max(1, size // 40)])):
                text[rnd.randrange(len(text))] = rnd.choice(words)
    rnd.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


def test_near_copies_against_all_pairs(spark, near_copies):
    out = M.near_duplicates(spark.createDataFrame(near_copies, "doc_id long, text string"))
    assert found(out) == sorted(brute(near_copies), key=str)
    assert out.filter("kept <> (doc_id = component_id)").isEmpty()


def test_one_large_mixed_bucket_is_dealt_to_blocks(spark, monkeypatch):
    """Many texts that share their first half and whose second halves differ a little, much or wholly."""
    rnd = random.Random(9)
    words = [f"v{i}" for i in range(300)]
    base = rnd.choices(words, k=60)
    rows = []
    for i in range(150):
        text = list(base)
        for _ in range(rnd.choice([1, 2, 3, 4, 5])):
            text[rnd.randrange(60)] = rnd.choice(words)
        rows.append((1000 - i, " ".join(text)))
    monkeypatch.setattr(M, "BLOCK", 8)
    assert found(M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == sorted(brute(rows), key=str)


def test_hard_rows_and_empty_tables(hard, hard_rows, empty):
    out = M.near_duplicates(hard)
    assert found(out) == sorted(brute([(d, t) for d, t, *_ in hard_rows]), key=str)
    assert {r["doc_id"]: r["kept"] for r in out.collect()}[None] is True
    assert M.near_duplicates(empty).count() == 0


def test_classes_of_null_ids(spark):
    rows = [(None, "one text of five words here"), (None, "one text of five words here "), (None, None), (3, ""), (None, "")]
    assert found(M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == sorted([(None, 3, None)] * 2 + [(None, 0, None)] * 2 + [(3, 0, 3)], key=str)


def test_large_ids_beside_nulls_are_kept(spark):
    big = 2**62 + 1
    rows = [(None, "a b c d e"), (big, "one two three four five"), (big + 1, "one two three four five"), (big + 2, "other words in this text")]
    assert found(M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))) == sorted(brute(rows), key=str)


def test_signatures_estimate_similarity():
    rnd = np.random.default_rng(1)
    pool = np.unique(rnd.integers(0, 1 << 63, 10_000, dtype=np.uint64))
    for share in (0.2, 0.5, 0.9):
        cut = int(4000 * share)
        a, b = pool[:4000], np.concatenate([pool[:cut], pool[4000 : 8000 - cut]])
        similarity = cut / (8000 - cut)
        assert abs((M.signature(a) == M.signature(b)).mean() - similarity) < 0.15


def test_the_posterior_drops_little_at_the_limit_and_much_below():
    least, rnd = M.least_matches(), np.random.default_rng(2)

    def passing(similarity, n=20_000):
        equal = rnd.random((n, M.HASHES)) < similarity + (1 - similarity) / 256
        left, right = np.zeros((n, M.HASHES), dtype=np.uint8), (~equal).astype(np.uint8)
        return len(M.survivors(left, right, np.arange(n), np.arange(n), least)[0]) / n

    assert passing(0.8) > 0.9995 and passing(0.5) < 0.02 and passing(0.3) == 0
    assert 1 - (1 - 0.8**M.ROWS) ** M.BANDS > 1 - 1e-7


def test_no_signatures_of_empty_sets():
    assert len(M.shingle_hashes(None)) == len(M.shingle_hashes(" \n")) == 0
    assert len(M.shingle_hashes("a b")) == len(M.shingle_hashes("a b c d")) == 1 and len(M.shingle_hashes("a a a a a a")) == 1
