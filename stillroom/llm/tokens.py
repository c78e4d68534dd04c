"""Token ids of whole texts, inside tasks.

The word BPE drops white space and never joins what white space parts, so that a text's ids are those of its chunks in
order. Chunks repeat; their ids are kept, up to a bound, as bytes ready to be joined. A chunk of letters alone, with one
full stop or comma behind it at most, needs no more than the model's merges; any other goes through the whole tokenizer.
A tokenizer of another make encodes each text as one.
"""

from __future__ import annotations

import json
from functools import cache
from struct import pack

import numpy as np

#: Chunks of a generation kept per task process, and the longest that is kept.
KEPT, LONGEST = 450_000, 48
ID = np.dtype("<u4")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@cache
def byte_letters() -> dict[int, str]:
    """The character that byte-level BPE writes for each byte: visible ones stand for themselves, the others are
    numbered from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class Encoder(dict):
    """``encode(text)`` gives the ids as little-endian unsigned 32-bit numbers. The mapping itself holds chunks; when it
    is full it becomes the older generation, from which chunks that are met again move on."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.older: dict[str, bytes] = {}
        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        made = json.loads(self.whole.to_str())
        normal = [x["type"] for x in (made["normalizer"] or {}).get("normalizers", [])]
        parts = [x["type"] for x in (made["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.by_chunk = (normal, parts) == (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]) and made["model"]["end_of_word_suffix"] == "</w>" and not made["post_processor"]

    def full(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=ID).tobytes()

    def word(self, letters: str) -> bytes:
        if not letters.isascii():
            letters = "".join(map(byte_letters().__getitem__, letters.encode()))
        ids = [t.id for t in self.model.tokenize(letters)]
        return pack(f"<{len(ids)}I", *ids)

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            core = chunk.lower()
            end = core[-1:] if core[-1:] in (".", ",") else ""
            core = core.removesuffix(end)
            if core.isalpha() and (core.isascii() or max(core) < "Ā"):
                ids = self.word(core) if core == chunk else self[core] + (self[end] if end else b"")
            elif chunk == end:
                ids = self.word(end) if end else b""
            else:
                ids = self.full(chunk)
        if len(chunk) <= LONGEST:
            self[chunk] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_chunk:
            return self.full(text)
        if len(self) > KEPT:
            self.older = dict(self)
            self.clear()
        chunks = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        return b"".join(map(self.__getitem__, chunks))


@cache
def encoder(path: str) -> Encoder:
    """One for each task process."""
    return Encoder(path)


def end_bytes(end_id: int) -> bytes:
    return np.array([end_id], dtype=ID).tobytes()
