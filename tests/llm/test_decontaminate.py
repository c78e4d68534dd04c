import pytest

from brute import contamination
from stillroom.llm.decontaminate import find_passages, keep_uncontaminated

ITEM = "Which of the following rivers flows through the old town before it reaches the sea at last"


@pytest.fixture(scope="module")
def bench():
    return [(1, ITEM), (2, "geese near the river bank"), (3, None), (4, "..."), (None, "braune Fuchs"), (5, ITEM + " and more"), (5, "x y z"), (6, "lazy"), (7, "a a a a a a a a a a a a"), (8, "words now repeat these five words now repeat these five words")]


@pytest.fixture(scope="module")
def planted(hard_rows):
    words = ITEM.split()
    return [
        *hard_rows,
        (20, "before " + ITEM.upper().replace(" ", ",") + " after", "en", "a"),
        (21, "only " + " ".join(words[3:13]) + " is there", "en", "a"),
        (22, "nine words are not enough " + " ".join(words[:9]) + " here", "en", "a"),
        (23, "a " * 25, "en", "a"),
        (24, ("Die " + ITEM + " Ä ") * 3, "en", "a"),
        *[(30 + i, f"copy {i} " + " ".join(words[:12]), "en", "a") for i in range(40)],
    ]


def expected(rows, bench):
    return sorted(((d is not None, d or 0, *contamination(t, bench)) for d, t, *_ in rows), key=str)


@pytest.mark.parametrize("which", ["all", "long", "none"])
def test_against_brute_force(spark, planted, bench, which):
    bench = {"all": bench, "long": [bench[0], bench[5]], "none": [(3, None), (4, "...")]}[which]
    docs = spark.createDataFrame([(*r, 1, "x") for r in planted], "doc_id long, text string, lang string, source string, n_hit int, words string")
    items = spark.createDataFrame([(*b, 1) for b in bench], "item_id long, text string, m int")
    found = find_passages(docs, items).collect()
    assert sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["n_words"], r["n_hit"], r["items"]) for r in found), key=str) == expected(planted, bench)


def test_filter_keeps_clean_rows_whole(spark, hard, hard_rows, bench):
    items = spark.createDataFrame(bench, "item_id long, text string")
    kept = keep_uncontaminated(hard, items)
    clean = [d for d, t, *_ in hard_rows if not contamination(t, bench)[1]]
    assert kept.columns == hard.columns and sorted((r["doc_id"] or 0) for r in kept.collect()) == sorted(d or 0 for d in clean)


def test_empty_tables(spark, hard, empty, bench):
    items = spark.createDataFrame(bench, "item_id long, text string")
    assert find_passages(empty, items).count() == 0
    assert keep_uncontaminated(hard, items.filter("false")).count() == hard.count()


def test_every_shared_span_is_found(spark):
    """The guarantee of winnowing, for each place and length of a shared span."""
    import random

    rnd = random.Random(5)
    item = [f"w{rnd.randrange(9)}" for _ in range(40)]
    rows = []
    for length in (9, 10, 11, 17):
        for at in range(0, 40 - length, 2):
            rows.append((len(rows), " ".join([f"u{rnd.randrange(9)}" for _ in range(rnd.randrange(6))] + item[at : at + length] + ["v"] * rnd.randrange(6)), "en", "a"))
    bench = [(1, " ".join(item))]
    found = find_passages(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert sorted(((True, r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in found), key=str) == expected(rows, bench)
