"""Token ids of documents in a binary store with a shared zstandard dictionary.

A store is a folder of shards, a dictionary and a manifest. Documents are written in ascending order of doc_id (null
first; equal ids by their text). The ids of a document are one array of unsigned 16-bit numbers (32-bit ones if the
vocabulary needs them), compressed on its own, so that a short document is read without its neighbours. The dictionary,
trained on arrays of that form, gives short documents what they lack in context.

A shard is: magic, one zstandard frame for each document, the index (for each document its id, whether it has one, the
offset of its frame and its number of ids, as compressed arrays), a footer in JSON, the footer's length and the magic.
The footer names the SHA-256 of the dictionary; a reader with another dictionary refuses.

The dictionary is trained on a bounded sample: about ``sample_rows`` documents chosen by hash, in slices of 4096 ids,
16 MB at most. It affects the size of the files only.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stillroom.llm.common import partitions_of, stored
from stillroom.llm.rawfiles import make_folder, reading, writing
from stillroom.llm.tokens import default_tokenizer, encoder, end_bytes

MAGIC = b"IDSHARD1"
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES, SLICE = 16 << 20, 4096
SHARD_BYTES = 64 << 20


def width_of(tokenizer: str, end_id: int) -> str:
    return "<u2" if max(encoder(tokenizer).whole.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, sample_rows: int = 2000) -> bytes:
    """Empty if there is nothing to learn from."""
    rows = docs.count()
    share = min(1.0, sample_rows / max(1, rows))
    chosen = docs.select(docs["text"]).filter(F.pmod(F.xxhash64(docs["text"], docs["doc_id"]), F.lit(1 << 40)) < int(share * (1 << 40))).limit(2 * sample_rows)

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        samples, size, kind = [], 0, width_of(tokenizer, end_id)
        for text in (t for batch in batches for t in batch["text"]):
            ids = np.frombuffer(encoder(tokenizer).encode(text) + end_bytes(end_id), dtype="<u4").astype(kind)
            for at in range(0, len(ids), SLICE):
                samples.append(ids[at : at + SLICE].tobytes())
                size += len(samples[-1])
                if size >= SAMPLE_BYTES:
                    break
            if size >= SAMPLE_BYTES:  # the rest of the sample is not even encoded
                break
        try:
            made = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
        except (zstandard.ZstdError, ValueError):  # too few samples: they are the dictionary themselves
            made = b"".join(samples)[:DICTIONARY_BYTES]
        yield pd.DataFrame({"made": [made]})

    made = chosen.repartition(1).mapInPandas(learn, "made binary").collect()
    return max((bytes(r["made"]) for r in made), key=len, default=b"")


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int, dictionary: bytes) -> DataFrame:
    """Writes the shards; a row for each, in no order: part, k, name, docs, ids. docs: partitioned and sorted."""
    digest = hashlib.sha256(dictionary).hexdigest()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, kind = TaskContext.get().partitionId(), width_of(tokenizer, end_id)
        encode, end = encoder(tokenizer).encode, end_bytes(end_id)
        press = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        rows = ((i, t) for b in batches for i, t in zip(b["doc_id"].astype("Int64"), b["text"], strict=True))
        k, waiting = 0, next(rows, None)
        while waiting is not None:
            name, place, ids, has, offsets, sizes = f"shard-{part:06d}-{k:04d}.ids", len(MAGIC), [], [], [], []
            with writing(f"{folder}/{name}") as out:
                out.write(MAGIC)
                while waiting is not None and place < SHARD_BYTES:
                    doc_id, text = waiting
                    array = np.frombuffer(encode(text) + end, dtype="<u4")
                    frame = press.compress(array.astype(kind).tobytes())
                    out.write(frame)
                    known = not pd.isna(doc_id)
                    ids.append(int(doc_id) if known else 0)
                    has.append(known)
                    offsets.append(place)
                    sizes.append(len(array))
                    place += len(frame)
                    waiting = next(rows, None)
                index = zstandard.compress(np.array(ids, "<i8").tobytes() + np.array(has, "u1").tobytes() + np.array([*offsets, place], "<u8").tobytes() + np.array(sizes, "<u8").tobytes())
                footer = json.dumps({"dictionary": digest, "kind": kind, "docs": len(ids), "ids": int(sum(sizes)), "index": [place, len(index)]}).encode()
                out.write(index + footer + struct.pack("<I", len(footer)) + MAGIC)
            yield pd.DataFrame({"part": [part], "k": [k], "name": [name], "docs": [len(ids)], "ids": [int(sum(sizes))]})
            k += 1

    return docs.mapInPandas(write, "part long, k long, name string, docs long, ids long")


def write_store(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 2) -> None:
    """All of ``docs`` (doc_id, text) as a store. The manifest, a Parquet table with a row for each shard, is written
    last; the ids before a shard are added up by part of the write, and then over the parts."""
    spark, tokenizer = docs.sparkSession, tokenizer or default_tokenizer()
    rows = docs.select(docs["doc_id"].cast("long"), docs["text"])
    dictionary = train_dictionary(rows, tokenizer, end_id)
    make_folder(folder)
    with writing(f"{folder}/dictionary") as out:
        out.write(dictionary)
    placed = rows.repartitionByRange(partitions_of(spark), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    shards = stored(write_shards(placed, folder, tokenizer, end_id, dictionary), "shards")
    within = W.partitionBy("part").orderBy("k").rowsBetween(W.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("ids").alias("in_part"))  # as many rows as tasks wrote
    parts = parts.select("part", F.coalesce(F.sum("in_part").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    start = F.col("before") + F.coalesce(F.sum("ids").over(within), F.lit(0))
    digest = F.lit(hashlib.sha256(dictionary).hexdigest()).alias("dictionary")
    shards.join(parts, "part").select("name", "docs", "ids", start.alias("start"), digest).write.mode("overwrite").parquet(f"{folder}/manifest")


@cache
def dictionary_of(folder: str) -> bytes:
    with reading(f"{folder}/dictionary") as source:
        return source.read()


class Shard:
    """An open shard: its index, and any document by its place."""

    def __init__(self, source, dictionary: bytes):
        self.source = source
        size = source.size()
        source.seek(size - len(MAGIC) - 4)
        (length,), magic = struct.unpack("<I", source.read(4)), source.read(len(MAGIC))
        source.seek(0)
        if magic != MAGIC or source.read(len(MAGIC)) != MAGIC:
            raise ValueError("not a whole shard of ids")
        source.seek(size - len(MAGIC) - 4 - length)
        self.footer = json.loads(source.read(length))
        if self.footer["dictionary"] != hashlib.sha256(dictionary).hexdigest():
            raise ValueError("the shard was written with another dictionary")
        at, length = self.footer["index"]
        source.seek(at)
        data, n = zstandard.decompress(source.read(length)), self.footer["docs"]
        self.doc_ids = np.frombuffer(data, "<i8", n)
        self.has_id = np.frombuffer(data, "u1", n, 8 * n).astype(bool)
        self.offsets = np.frombuffer(data, "<u8", n + 1, 9 * n).astype(np.int64)
        self.sizes = np.frombuffer(data, "<u8", n, 17 * n + 8).astype(np.int64)
        self.unpress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def ids(self, k: int) -> np.ndarray:
        """Of the k-th document, reading its frame alone."""
        self.source.seek(int(self.offsets[k]))
        frame = self.source.read(int(self.offsets[k + 1] - self.offsets[k]))
        return np.frombuffer(self.unpress.decompress(frame), self.footer["kind"]).astype("<u4")


def read_store(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """A row for each document: doc_id, start, n_tokens, ids_crc32 and, if wanted, ids as bytes (unsigned 32-bit)."""
    columns = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, start in zip(batch["name"], batch["start"], strict=True):
                with reading(f"{folder}/{name}") as source:
                    shard = Shard(source, dictionary_of(folder))
                    starts = start + np.cumsum(shard.sizes) - shard.sizes
                    for at in range(0, len(shard.sizes), 1000):
                        part = slice(at, at + 1000)
                        arrays = [shard.ids(k).tobytes() for k in range(at, min(at + 1000, len(shard.sizes)))]
                        yield pd.DataFrame({
                            "doc_id": pd.array(shard.doc_ids[part], dtype="Int64").to_numpy(dtype=object) if shard.has_id[part].all() else [int(i) if h else None for i, h in zip(shard.doc_ids[part], shard.has_id[part], strict=True)],
                            "start": starts[part], "n_tokens": [len(a) // 4 for a in arrays], "ids_crc32": [zlib.crc32(a) for a in arrays], **({"ids": arrays} if with_ids else {}),
                        })

    listed = spark.read.schema("name string, start long").parquet(f"{folder}/manifest")
    return listed.repartition(partitions_of(spark), "name").mapInPandas(read, columns)
