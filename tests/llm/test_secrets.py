import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from stillroom.llm import secrets as S
from stillroom.llm.common import stored
from stillroom.llm.findings import KINDS, planted

WORDS = "the garden was quiet and nobody wanted to leave before the rain stopped over there".split()


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(11)
    out = []
    for i in range(300):
        kind = i % 5
        value = "".join(rnd.choices("0123456789abcdef", k=40))
        planted = [f'token = "{value}"', f"password={value[:18]}", "AKIA" + "".join(rnd.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=15)) + "7", "".join(rnd.choices("123456789", k=16)), f"checksum {value}"][kind]
        words = rnd.choices(WORDS, k=20)
        words.insert(rnd.randrange(20), planted)
        out.append((i, " ".join(words), f"src/file{kind}.py", len(" ".join(words)), 1.0, "x"))
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, score double, value string")


def found_by(text):
    return [(m.start(), m[0]) for m in re.finditer(S.CANDIDATE, text or "")]


def test_candidates_against_regular_expressions(hard, hard_rows):
    found = sorted(((r["doc_id"], r["start"], r["value"]) for r in S.candidates(hard, "source").collect()), key=str)
    assert found == sorted(((d, *c) for d, t, *_ in hard_rows for c in found_by(t)), key=str)


def features_of(text, start, value, path, dictionary, pairs):
    """The features of one candidate, in plain Python and in the order of S.FEATURES."""
    before, after = text[:start][-S.BEFORE :], text[start + len(value) :][: S.AFTER]
    share = lambda pattern: len(re.findall(pattern, value)) / len(value)
    kinds = ["a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "-" for c in value]
    small = value.lower()
    mean = sum(pairs[(ord(a) - 97) * 26 + ord(b) - 97] if a.isalpha() and b.isalpha() else S.OTHER_PAIR for a, b in zip(small, small[1:])) / (len(value) - 1)
    covered = sum(len(w) for w in re.findall("[a-z]{3,}", small) if w in dictionary)
    marks = [bool(re.search(p, before)) for p in (S.KEYWORDS, S.HARMLESS, r"[:=][\s\"']*$", "[\"']$")] + [bool(re.search(r"^[\s\"',.;]*[A-Za-z]{2}", after))]
    of_path = [bool(path and re.search(p, path)) for p in (S.TEST_PATH, S.CONFIG_PATH)]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    return [len(value), share("[0-9]"), share("[A-Z]"), share("[a-z]"), share("[+/_=-]"), len(set(small)) / len(value), changes / len(value), mean, covered / len(value), *marks, *of_path, (path or "").count("/")]


def test_features_against_plain_ones(docs, rows, hard, hard_rows):
    for table, texts in ((docs, [(i, t, p) for i, t, p, *_ in rows]), (hard, [(d, t, p) for d, t, _, p in hard_rows])):
        words = stored(S.word_counts(table), "w")
        pairs, dictionary = S.letter_pairs(words), {r["word"] for r in words.filter("n >= 5").collect()}
        found = S.featured(S.candidates(table), words, pairs).collect()
        expected = {(i, start): features_of(t, start, v, p, dictionary, pairs) for i, t, p in texts for start, v in found_by(t)}
        assert len(found) >= len(expected) > 0
        for r in found:
            assert [r[f] for f in S.FEATURES] == pytest.approx([float(x) for x in expected[r["doc_id"], r["start"]]])


@pytest.mark.parametrize("withheld", [("bearer", "upper_token", "uuid", "order"), ("base64_key", "short_token", "commit", "phone"), ("api_key", "password", "card", "etag")])
def test_kinds_withheld_from_training_are_told_apart(docs, withheld):
    words = stored(S.word_counts(docs), "w")
    labelled = stored(S.labelled_findings(docs, words, S.letter_pairs(words), passages=60), "labelled")
    assert {r["kind"] for r in labelled.select("kind").distinct().collect()} == {k.name for k in KINDS}
    model = S.train(labelled.filter(~F.col("kind").isin(*withheld)))
    judged = S.judged(labelled.filter(F.col("kind").isin(*withheld)), model).select("label", "is_secret").collect()
    hits = sum(r["is_secret"] and r["label"] for r in judged)
    assert hits / sum(r["label"] for r in judged) > 0.9 and hits / max(1, sum(r["is_secret"] for r in judged)) > 0.9


def test_planted_values_are_candidates(docs):
    """Recall of the candidates on the kinds, each occurrence at its place."""
    known = planted(docs, passages=60).collect()
    assert len(known) == 60 * len(KINDS) and len({r["doc_id"] for r in known}) == len(known)
    seen = sum(r["planted_value"] in [v for _, v in found_by(r["text"])] for r in known)
    assert seen / len(known) > 0.97


def test_findings_of_documents_are_told_apart(docs, rows):
    """Nothing of these documents is labelled: the forest has seen planted values only."""
    found = S.find_secrets(docs).select("doc_id", "is_secret").collect()
    right = [r["is_secret"] == (r["doc_id"] % 5 < 3) for r in found]
    assert len(right) == len(rows) and sum(right) / len(right) > 0.95


def test_a_session_that_has_counted_rows_can_still_scan(spark, docs, rows, path):
    from stillroom.operators.tables import write_table

    assert write_table(spark.range(5), path("counted")) == 5
    assert S.find_secrets(docs).count() == len(rows)


def test_redaction_leaves_the_rest_of_a_text(docs, rows):
    secrets = stored(S.find_secrets(docs), "s")
    values = {(r["doc_id"], r["start"]): r for r in secrets.collect()}
    out = {r["doc_id"]: r for r in S.redact(docs, secrets).collect()}
    assert S.redact(docs, secrets).columns == docs.columns
    for i, text, *_ in rows:
        for start, value in reversed(found_by(text)):
            row = values[i, start]
            assert row["length"] == len(value) and row["value_sha256"] == hashlib.sha256(value.encode()).hexdigest()
            if row["is_secret"]:
                text = text[:start] + S.REDACTED + text[start + len(value) :]
        assert out[i]["text"] == text and out[i]["n_chars"] == len(text)


def test_word_counts_and_letter_pairs(spark):
    words = S.word_counts(spark.createDataFrame([("Abc abc, ÄBC ab",), (None,), ("",)], "text string"))
    assert {r["word"]: r["n"] for r in words.collect()} == {"abc": 2}
    pairs = S.letter_pairs(words)
    assert len(pairs) == 676 and pairs[1] == max(pairs) and pairs[26 * 1 + 2] == max(pairs)


def test_hard_rows_without_labels_and_empty_tables(hard, hard_rows, empty):
    words = S.word_counts(empty)
    rows = S.find_secrets(hard, labelled=S.labelled_findings(empty, words, S.letter_pairs(words)))
    found = rows.collect()
    assert all(not r["is_secret"] and r["score"] is None for r in found) and len(found) == sum(len(found_by(t)) for _, t, *_ in hard_rows)
    assert S.find_secrets(empty).count() == 0
    clean = S.redact(hard, rows.withColumn("is_secret", F.lit(False)))
    assert sorted(map(str, clean.collect())) == sorted(map(str, hard.collect()))
    assert S.redact(empty, rows).count() == 0
