import pytest
from pyspark.sql import functions as F

from brute import sha256
from stillroom.llm.chat import CONTROLS, digests, escape, format_windows, read_windows, unescape

SCHEMA = "conv_id long, turn long, role string, text string, window int, tokens long, upto long"


def conversation(i, n, size=30):
    rows = [(i, 0, "system", f"You answer number {i}.")] if i % 2 else []
    return rows + [(i, k + 1, "user" if k % 2 == 0 else "assistant", f"turn {k} of {i}: " + f"word{k} " * (size + k)) for k in range(n)]


@pytest.fixture(scope="module")
def rows():
    tricky = [(-1, k, "assistant", f"{c} a\\{c} {c[0]}\\{c[1:]} {c[0]}\\\\{c[1:]}{c}{c}") for k, c in enumerate(CONTROLS)]
    odd = [(50, 0, None, None), (50, None, "assistant", "first"), (50, 1, "assistant", ""), (50, 2, "<|text|>\n", "x"), (None, 0, "user", "no id"), (51, 0, "system", "alone"), (52, 0, "assistant", "same"), (52, 0, "assistant", "same"), (53, 0, "system", "a"), (53, 1, "system", "b")]
    long = [(54, 0, "system", "s"), (54, 1, "user", "u " * 60_000), (54, 2, "assistant", "a " * 60_000), (54, 3, "user", "ok"), (54, 4, "assistant", "fine")]
    return [*(x for i in range(8) for x in conversation(i, 3 + 5 * i)), *tricky, *odd, *long]


@pytest.fixture(scope="module")
def windows(spark, rows):
    table = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)
    return format_windows(table, budget=300, history_tokens=120, history_turns=3).cache()


def ordered(rows):
    talks = {}
    for c, t, role, text in rows:
        talks.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    return {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in talks.items()}


def test_digests_are_those_of_the_input(rows, windows):
    found = {r["conv_id"]: r for r in digests(windows).collect()}
    talks = ordered(rows)
    assert found.keys() == talks.keys()
    for c, turns in talks.items():
        loss = "".join(x for r, x in turns if r == "assistant")
        assert (found[c]["n_turns"], found[c]["turns_sha256"]) == (len(turns), sha256("".join(f"{r}\n{x}\n" for r, x in turns)))
        assert (found[c]["loss_chars"], found[c]["loss_sha256"]) == (len(loss), sha256(loss))


def test_windows_keep_the_budget_and_repeat_what_they_may(windows):
    for r in windows.collect():
        assert r["over_budget"] == (r["tokens"] > 300)
        turns = r["text"].split("<|end|>")[:-1]
        first_is_system = turns[0].startswith("<|role|>system<|text|>")
        assert not r["over_budget"] or len(turns) == 1 + first_is_system
        assert r["n_repeated"] <= 3 + first_is_system
        assert r["window"] > 0 or r["n_repeated"] == 0
    later = [r for r in windows.filter("window > 0 AND conv_id % 2 = 1 AND conv_id < 8").collect()]
    assert later and all(r["text"].startswith("<|role|>system<|text|>You answer") for r in later)
    assert any(r["n_repeated"] > 1 for r in later)


def test_the_registered_budget_cuts_conversations(spark):
    from stillroom.llm.queries import QUERIES

    found = QUERIES["op2_chat_windows"](spark, "/root/testdata/sf0.001")
    cut = found.filter("n_windows > 1")
    assert 2 * cut.count() > found.count() and not cut.filter("n_repeated > 0").isEmpty()


def test_each_turn_is_new_once(rows, windows):
    read = read_windows(windows).groupBy("conv_id").agg(F.sum(F.size("turns")).alias("n")).collect()
    assert {r["conv_id"]: r["n"] for r in read} == {c: len(v) for c, v in ordered(rows).items()}


def test_no_control_string_survives_inside_a_text(windows):
    import re

    for r in windows.filter("conv_id = -1").collect():
        bare = re.sub(r"<\|(role|text|end)\|>", "", r["text"])
        assert not any(c in bare for c in CONTROLS)


def test_escapes_are_undone(spark):
    texts = ["", "<", "[", "\\", "<\\", "<<s>", "[[INST]]", "<|\\end|>", "<\\|end|>", "<\\\\</s>", "<<SYS>><</SYS>>"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in rows.select(unescape(escape(F.col("t")))).collect()] == texts


def test_empty_table(spark):
    assert digests(format_windows(spark.createDataFrame([], SCHEMA))).count() == 0
