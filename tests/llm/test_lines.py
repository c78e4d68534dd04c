from brute import base_figures
from stillroom.llm.lines import cleaned, judge

FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_base_figures_of_hard_rows(hard, hard_rows):
    found = sorted(((r["doc_id"] or 0, *(r[c] for c in FIGURES)) for r in judge(hard).collect()))
    assert found == sorted((d or 0, *base_figures(t)) for d, t, *_ in hard_rows)


def test_empty_table(empty):
    assert judge(empty).count() == 0 and cleaned(empty, judge(empty)).columns == empty.columns


def test_boilerplate_is_removed_and_depleted_documents_go(spark):
    own = [f"Document {c} says the thing{c} that only it can say, in word{c} and in deed{c}, at length." for c in "abcdefghijkl"]
    banner = "We use cookies; click here to accept all of them and to go on reading this page."
    rows = [(i, f"{banner}\n{t}", "h", "x") for i, t in enumerate(own)]
    rows += [(100 + i, f"{banner}\n{banner}{'!' * i}\nEnd{'xyz'[i]}.", "h", "x") for i in range(3)]
    rows += [(200, f"{banner}\nElsewhere the banner is no boilerplate and stays with the text.", "other", "x")]
    rows += [(300 + i, "One text copied whole many times over is one text still, and it stays as it is.", "h", "x") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, kept string")
    judged = judge(docs, min_docs=5, share=0.2)
    kept = {r["doc_id"] for r in judged.filter("kept").collect()}
    assert kept == {*range(12), 200}  # documents count, so that a text copied many times over is boilerplate as well
    assert {r["doc_id"] for r in judged.filter("depleted").collect()} == {100, 101, 102, *range(300, 330)}
    out = {r["doc_id"]: r for r in cleaned(docs, judged).collect()}
    assert out.keys() == kept and all(out[i]["text"] == own[i] for i in range(12)) and banner in out[200]["text"]
    assert cleaned(docs, judged).columns == docs.columns


def test_repeated_rows_are_judged_each_and_alike(spark):
    rows = [(1, "a line that is shared by all of them\nown words here for one", "h")] * 3 + [(i, f"a line that is shared by all of them\nown words for {chr(97 + i)} and more {i}", "h") for i in range(2, 9)]
    found = judge(spark.createDataFrame(rows, "doc_id long, text string, source string"), min_docs=2, share=0.1).collect()
    assert len(found) == len(rows) and {(r["n_words"], r["left_words"], len(r["removed_lines"])) for r in found if r["doc_id"] == 1} == {(14, 5, 1)}


def test_lines_of_numbers_and_rules_are_no_boilerplate(spark):
    rows = [(i, f"Words of the document {'abcdefghij'[i % 10] * (i + 1)} that nobody else has, so that it stays where it is\n{1000 + i}\n-----\nPage {i} of 60", "h") for i in range(60)]
    judged = judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {tuple(r["removed_lines"]) for r in judged} == {(3,)} and all(r["kept"] for r in judged)


def test_documents_are_counted_and_not_rows(spark):
    line = "the same line in all of them, with a word or two besides that make it long enough"
    same = [(1, line, "h")] * 9 + [(i, f"a text by itself {chr(96 + i)} with words that are found nowhere else at all, {chr(96 + i)}", "h") for i in range(2, 9)]
    docs = spark.createDataFrame(same, "doc_id long, text string, source string")
    assert all(r["kept"] for r in judge(docs, share=0.1).collect())
    copies = docs.unionByName(spark.createDataFrame([(20 + i, line, "h") for i in range(3)], docs.schema))
    assert {r["doc_id"] for r in judge(copies, share=0.1).filter("depleted").collect()} == {1, 20, 21, 22}
