import os

import pytest

import brute
import corpus_pipeline
from stillroom.llm.queries import QUERIES, SQL
from stillroom.llm.tokens import default_tokenizer, encoder

SF_DIR = os.environ.get("STILLROOM_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


def test_stages_against_plain_versions(spark):
    """Each stage on what its predecessor kept; the trained stages against what their operators say."""
    from stillroom.llm.common import stored
    from stillroom.llm.language import identify
    from stillroom.llm.secrets import find_secrets

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    benchmark = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        out = stored(stage(spark, docs, SF_DIR), name)
        if name == "packing":
            total = {}
            for r in out.collect():
                total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["length"]
            own = encoder(default_tokenizer())
            assert total == {d: len(own.encode(r["text"])) // 4 + 1 for d, r in before.items()}
            continue
        after = {r["doc_id"]: r for r in out.collect()}
        assert out.columns == columns
        if name == "language_id":
            told = {r["doc_id"] for r in identify(docs).collect() if r["lang_pred"] != "und" and r["score"] >= 0.5}
            assert after == {d: before[d] for d in told} and len(after) > 0.9 * len(before)
        elif name == "simhash_near_dedup":
            ids = sorted(before)
            roots = brute.groups([brute.fingerprint(before[d]["text"]) for d in ids])
            assert after == {ids[r]: before[ids[r]] for r in set(roots)}
        elif name == "decontamination":
            assert after == {d: r for d, r in before.items() if not brute.contamination(r["text"], benchmark)[1]}
        else:
            gone = {}
            for r in find_secrets(docs).filter("is_secret").collect():
                gone.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
            assert after.keys() == before.keys()
            for d, r in before.items():
                text = r["text"]
                for start, length in sorted(gone.get(d, []), reverse=True):
                    text = text[:start] + "<SECRET>" + text[start + length :]
                assert after[d]["text"] == text
        docs = out


def test_stages_on_an_empty_table(spark, path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
        assert docs.count() == 0
        if "lang" not in docs.columns:
            break


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    from oracle import compare, connect

    assert compare(QUERIES[name](spark, SF_DIR), connect(SF_DIR), SQL[name]) == ""


def test_names():
    import re

    import __spark_entry__

    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and {"pipeline", *QUERIES} <= __spark_entry__.queries().keys()
