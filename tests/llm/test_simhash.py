import random
from itertools import combinations

import numpy as np
import pytest

import brute
from stillroom.llm.components import components
from stillroom.llm.hamming import links_within, trie_join
from stillroom.llm.simhash import fingerprint, keep_representatives, near_duplicates

MASK = 2**64 - 1


def test_fingerprints(hard_rows):
    texts = [t for _, t, *_ in hard_rows] + ["a b", "A B c", "É é É", "a\x0bb\x0cc d\x85e"]
    assert [fingerprint(t) & MASK for t in texts] == [brute.fingerprint(t) for t in texts]


def family(seed, n, centres):
    rnd = random.Random(seed)
    middles = [rnd.getrandbits(64) for _ in range(centres)]
    return sorted({rnd.choice(middles) ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(5))) for _ in range(n)} | {0, MASK})


def test_trie_join_finds_all_links():
    keys = family(1, 1500, 60)
    least = trie_join(np.array(keys, dtype=np.uint64), 0, np.array([0]), np.array([len(keys)]))
    assert least.tolist() == brute.groups(keys)


@pytest.mark.parametrize("limit", [1 << 17, 20])
def test_links_connect_what_all_pairs_connect(spark, limit):
    """With a small limit, hot fronts are split."""
    keys = family(2, 800, 8)
    signed = [k - 2**64 if k >> 63 else k for k in keys]
    links = links_within(spark.createDataFrame([(k,) for k in signed], "fp long"), limit)
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    expected = brute.groups(keys)
    mine = [roots.get(k, k) for k in signed]
    assert all((mine[i] == mine[j]) == (expected[i] == expected[j]) for i, j in combinations(range(len(keys)), 2))


def test_components_of_paths_stars_and_repeated_links(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)] + [(i, 500) for i in range(501, 520)]
    odd = [(7, 7), (None, 3), (4, None), (900, 901), (901, 900), (900, 901)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(path + star + odd, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 560)}, 900: 900, 901: 900}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def expected_groups(rows):
    prints = [brute.fingerprint(t) for _, t, *_ in rows]
    roots = brute.groups(prints)
    least = {}
    for (d, *_), r in zip(rows, roots, strict=True):
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(((d, f"{p:016x}", least.get(r)) for (d, *_), p, r in zip(rows, prints, roots, strict=True)), key=str)


def test_near_duplicates_against_brute_force(spark, hard, hard_rows):
    assert sorted((tuple(r) for r in near_duplicates(hard).collect()), key=str) == expected_groups(hard_rows)
    rnd = random.Random(9)
    texts = [" ".join(rnd.choices("alpha beta gamma delta epsilon zeta eta theta".split(), k=40)) for _ in range(20)]
    rows = [(i, rnd.choice(texts) + (f" {rnd.randrange(3)}" if i % 2 else "")) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in near_duplicates(docs).collect()), key=str) == expected_groups(rows)


def test_one_document_of_each_group_stays(hard, hard_rows, empty):
    kept = keep_representatives(hard)
    ids = [r["doc_id"] for r in kept.collect()]
    # By component: texts that share an id are documents of their own, and one without an id stands for itself.
    roots, least = brute.groups([brute.fingerprint(t) for _, t, *_ in hard_rows]), {}
    for (d, *_), root in zip(hard_rows, roots, strict=True):
        least[root] = min(least.get(root, (True, None)), (d is None, d), key=lambda x: (x[0], x[1] or 0))
    assert kept.columns == hard.columns and sorted(ids, key=str) == sorted((d for _, d in least.values()), key=str)
    assert keep_representatives(empty).count() == 0 and near_duplicates(empty).count() == 0


def test_a_component_without_ids_keeps_one_row(spark):
    one, other = "the first text has these words and no id at all to name it by", "a second one with quite other words in it and no id either"
    rows = spark.createDataFrame([(None, one), (None, one + " "), (None, other), (7, "a text with an id that stands beside them")], "doc_id long, text string")
    kept = keep_representatives(rows).collect()
    assert sorted(r["text"].strip() for r in kept) == sorted([one, other, "a text with an id that stands beside them"])
