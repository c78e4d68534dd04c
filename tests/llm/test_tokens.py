import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
import zstandard

from stillroom.llm.idstore import Shard, read_store, write_store
from stillroom.llm.packing import best_fit, pack, sequences
from stillroom.llm.rawfiles import reading
from stillroom.llm.tokens import default_tokenizer, encoder

ODD = [
    "It's <|endoftext|> and <|startoftext|>x 'S 'll", "ÀÉÎ Straße ªº µ ÿ Ÿ İ ǅ ſ", "é ́e  x y\x1cz\x85w", "a.b,c.. d., ,e .f 12.5,3", "日本語 テスト 한국어", "\U0001f600\U0001f600 ok", "x" * 300,
    "tab\tnew\r\nline\x0bvt\x0cff", "...", ".", ",", "Σίσυφος ΟΔΥΣΣΕΎΣ", "O’Neill “quoted”", "Ångstrom ﬁn",
]


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    return lambda text: np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, dtype="<u4")


def test_encoder_gives_the_tokenizers_ids(whole, hard_rows):
    own = encoder(default_tokenizer())
    assert own.by_chunk
    for text in [*ODD, " ".join(ODD), *(t for _, t, *_ in hard_rows)] * 2:
        assert own.encode(text) == whole(text).tobytes(), text


def test_encoder_of_another_make():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, tokenizer = encoder(path), Tokenizer.from_file(path)
    assert not own.by_chunk and own.encode("a  b c") == np.array(tokenizer.encode("a  b c", add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_best_fit_takes_the_tightest_window():
    import random

    rnd = random.Random(4)
    lengths = sorted((rnd.randrange(1, 65) for _ in range(400)), reverse=True)
    rooms, expected = [], []
    for n in lengths:
        fitting = [(room, k) for k, room in enumerate(rooms) if room >= n]
        tightest = min(fitting)[0] if fitting else None
        expected.append(tightest if fitting else 64)
        k = min(fitting)[1] if fitting else len(rooms)
        rooms = [*rooms, 64] if not fitting else rooms
        rooms[k] -= n
    at, places = best_fit(lengths, 64)
    assert [64 - p for p in places] == expected and max(at) + 1 == len(rooms)
    assert best_fit([]) == ([], []) and best_fit([2048, 2048, 1]) == ([0, 1, 2], [0, 0, 0])


def check_packed(rows, ids_of, found, window):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    pieces = defaultdict(int)
    for d, text in rows:
        ids = np.append(ids_of(text), 1).astype("<u4")
        for at in range(0, len(ids), window):
            part = ids[at : at + window]
            pieces[d, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    seen = defaultdict(int)
    for r in found:
        seen[r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]] += 1
    assert seen == pieces
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= window and all(r["padded_to"] == (at if at & (at - 1) == 0 else window) for r in parts)


def test_packing_of_hard_rows(hard, hard_rows, empty, whole):
    packed = pack(hard, window=128, group_windows=4, with_ids=True).cache()
    found = packed.collect()
    check_packed([(d, t) for d, t, *_ in hard_rows], whole, found, 128)
    assert len({r["sequence_id"] >> 32 for r in found}) > 1
    parts = defaultdict(dict)
    for r in found:
        parts[r["sequence_id"]][r["offset"]] = bytes(r["ids"])
    made = {r["sequence_id"]: bytes(r["ids"]) for r in sequences(packed).collect()}
    assert made == {k: b"".join(v[o] for o in sorted(v)) for k, v in parts.items()}
    assert pack(empty).count() == 0


def test_store_round_trip(spark, hard, hard_rows, path, whole):
    folder = path("ids")
    write_store(hard, folder, end_id=2)
    key = lambda r: (r[0] is not None, r[0] or 0)
    found = sorted(read_store(spark, folder, with_ids=True).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in found] == [d for d, *_ in sorted(hard_rows, key=key)]
    start, texts = 0, defaultdict(list)
    for d, t, *_ in hard_rows:
        texts[d].append(np.append(whole(t), 2).astype("<u4").tobytes())
    for r in found:
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(r["ids"]) // 4, zlib.crc32(bytes(r["ids"])))
        start += r["n_tokens"]
        texts[r["doc_id"]].remove(bytes(r["ids"]))
    assert not any(texts.values())


def test_single_documents_and_a_wrong_dictionary(spark, hard, path):
    folder = path("one")
    write_store(hard, folder)
    shards = spark.read.parquet(f"{folder}/manifest").collect()
    with reading(f"{folder}/dictionary") as source:
        dictionary = source.read()
    found = {r["start"]: bytes(r["ids"]) for r in read_store(spark, folder, with_ids=True).collect()}
    for s in shards:
        with reading(f"{folder}/{s['name']}") as source:
            shard = Shard(source, dictionary)
            last = s["docs"] - 1
            assert shard.ids(last).tobytes() == found[s["start"] + int(shard.sizes[:last].sum())]
            with pytest.raises(ValueError, match="another dictionary"):
                Shard(source, dictionary + b"x")
    broken = path("broken")
    with open(broken, "wb") as out:
        out.write(b"IDSHARD1" + zstandard.compress(b"x") + struct.pack("<I", 3))
    with reading(broken) as source, pytest.raises((ValueError, OSError)):
        Shard(source, dictionary)


def test_store_of_nothing(spark, empty, path):
    write_store(empty, path("none"))
    assert read_store(spark, path("none")).count() == 0


def test_addresses_of_object_stores(monkeypatch):
    from pyarrow import fs

    from stillroom.llm.rawfiles import located

    monkeypatch.setattr(fs, "FileSystem", type("Named", (), {"from_uri": staticmethod(lambda uri: uri)}))
    assert [located(f"{s}://bucket/a b/c") for s in ("s3a", "s3n", "s3", "gs", "gcs", "hdfs")] == [f"{s}://bucket/a b/c" for s in ("s3", "s3", "s3", "gs", "gs", "hdfs")]
    assert located("file:///x/y")[1] == located("/x/y")[1] == "/x/y"


def test_a_group_of_tiny_texts_is_bounded_by_its_rows(spark, monkeypatch):
    from stillroom.llm import packing

    monkeypatch.setattr(packing, "GROUP_ROWS", 100)
    packed = packing.pack(spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text")))
    groups = packed.groupBy((F.col("sequence_id") / (1 << 32)).cast("long").alias("group")).count().collect()
    assert len(groups) == 10 and max(r["count"] for r in groups) < 200 and sum(r["count"] for r in groups) == 1000
