"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brute import LOWER
from stillroom.llm import spelling as S


def counts(docs):
    out = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            out[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs):
    n = counts(docs)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    best = {w: min(v, key=lambda x: (-n[x], x)) for w, v in near.items() if v}
    form = {w: b for w, b in best.items() if n[b] >= 5 * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted(((w, form.get(w), root(w), n[w], len(near[w]), n[form[w]] if w in form else None) for w in n), key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


@pytest.fixture(scope="module")
def docs():
    rnd = random.Random(8)
    stems = ["spelling", "variant", "straße", "éclairage", "zzzzzz", "abcdef", "reading", "winding"]
    out = []
    for i in range(400):
        words = []
        for _ in range(60):
            w = rnd.choice(stems)
            for _ in range(rnd.choice([0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 1, 1, 2])):
                at, c = rnd.randrange(len(w) + 1), rnd.choice("aeé")
                w = rnd.choice([w[:at] + c + w[at:], w[:at] + c + w[at + 1 :], w[:at] + w[at + 1 :]])
            words.append(rnd.choice([w, w, w.upper() if w.isascii() else w, w.capitalize() if w[0].isascii() else w]))
        out.append((i, rnd.choice([" ", ", ", "1", "\n"]).join(words)))
    return [*out, (999, "chainword " * 150 + "chainwords " * 25 + "chainwordsy " * 5)]


def test_against_all_pairs_of_words(spark, docs):
    out = found(S.variants(spark.createDataFrame(docs, "doc_id long, text string")))
    assert out == brute(docs) and sum(r[1] is not None for r in out) > 50
    assert any(r[1] and r[2] != r[1] for r in out)  # a chain of two steps


@pytest.mark.parametrize("symbols", ["ab", "abcdefgh"])
def test_any_number_of_symbols_gives_all_pairs(spark, symbols):
    rnd = random.Random(4)
    words = sorted({"".join(rnd.choices("abcdé", k=rnd.choice([6, 7]))) for _ in range(300)} | {"aaaaaa", "aaaaaaa", "ÿaaaaa"})
    table = spark.createDataFrame([(w, i + 5) for i, w in enumerate(words)], "word string, n long")
    out = {(r["word"], r["near"]) for r in S.near_words(table, symbols).collect()}
    assert out == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_neighbourhoods_are_full(spark):
    row = spark.range(1).select(S.neighbourhood(F.lit("ab"), "ab").alias("x")).first()["x"]
    assert sorted(row) == sorted({"ab", "a", "b", "bb", "aa", "aab", "bab", "abb", "aba"}) and len(row) == len(set(row))


def test_hard_rows_and_empty_tables(hard, hard_rows, empty):
    rows = [(d, t) for d, t, *_ in hard_rows]
    assert found(S.variants(hard)) == brute(rows)
    assert S.variants(empty).count() == 0


def test_long_chains_reach_their_end(spark):
    forms = spark.createDataFrame([(f"w{i:03d}", f"w{i + 1:03d}") for i in range(37)], "word string, form string")
    assert {r["root"] for r in S.roots(forms).collect()} == {"w037"} and S.roots(forms.filter("false")).count() == 0
