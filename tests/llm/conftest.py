import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

CLASHING = "n_words long, text_hash long, fp long, host string, words string, score double, kept boolean, value string, k int, path string, start int, item string, id long, hash long, token string, lang_pred string"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    from stillroom.llm.common import ship

    ship(spark)


@pytest.fixture(scope="session")
def hard_rows():
    """(doc_id, text, lang, source): nulls anywhere, empty and very long texts, ties, repeated rows."""
    prose = "The quick brown fox jumps over the lazy dog while Émile counts 42 grey geese near the river bank today"
    other = "Der schnelle braune Fuchs springt über den faulen Hund und die Gänse am großen Fluss sehen ihm lange zu"
    long_text = "\n".join(f"line {i} of a very long text with word{i * 7919 % 1000} and number {i}" for i in range(4000))
    return [
        (1, prose, "en", "a"),
        (2, prose, "en", "a"),
        (3, prose + " again", "en", None),
        (4, other, "de", "b"),
        (4, other, "de", "b"),
        (4, "another text under the same id with quite different words in it for all to see", "en", "b"),
        (5, None, "en", "a"),
        (6, "", None, "a"),
        (7, " \t\n ", "de", None),
        (8, long_text, "en", "a"),
        (9, long_text + " end", "en", "a"),
        (None, "a text without an id that nobody can name but that is there all the same", None, None),
        (10, "one two", "en", "b"),
        (11, "0123 !!! ### $$$", None, "b"),
        (12, 'He wrote token = "3f9ad1c07be244d2a80c9b1d5e6f70812a3b4c5d" into the file and left the office early', "en", "src/app.env"),
        (13, "Call 4041894974608795 for the order or send nothing at all to the address that you know", "en", "docs/x"),
        (14, "repeat these five words now " * 6, "en", "b"),
        (15, "x" * 50_000, "en", "b"),
    ]


@pytest.fixture(scope="session")
def hard(spark, hard_rows):
    """The rows as documents, with further columns whose names the operators use inside."""
    columns = CLASHING.split(", ")
    rows = [(*r, len(r[1] or ""), *[None] * len(columns)) for r in hard_rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING)


@pytest.fixture(scope="session")
def empty(hard):
    return hard.filter("false")
