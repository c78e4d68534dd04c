"""Documents packed into sequences of one length with little padding, by best-fit decreasing.

Every document, ended by an id of its own, is cut into full windows and a rest. Full windows are sequences; the rests
are dealt into groups of equal expected size, and in each group the longest rest comes first and goes to the open window
with the least room that still holds it. A segment tree over the room left finds that window in a few steps. A group
holds ``group_windows`` windows or ``GROUP_ROWS`` pieces or so, whatever the size of the corpus and of its texts, which
bounds the memory of a task; groups are
large enough that each one's last, unfilled windows do not count.

Defined results: a null text is an empty one and has the end id alone; rows that repeat a document are packed each.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stillroom.llm.common import stored
from stillroom.llm.tokens import default_tokenizer, encoder, end_bytes

WINDOW = 2048
#: Pieces of a group, where they are so short that their tokens bound it less.
GROUP_ROWS = 1 << 18
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class Rooms:
    """Open windows by the room they have left: a segment tree whose leaves count the windows of each room."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, room: int, by: int) -> None:
        node = self.size + room
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        self._add(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The room and number of the window with the least room that is enough."""
        node = self.size + need
        if not self.count[node]:
            while node & 1 or not self.count[node + 1]:  # up, until a right neighbour has windows
                node >>= 1
                if node <= 1:
                    return None
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.size
        self._add(room, -1)
        return room, self.windows[room].pop()


def best_fit(lengths: list[int], window: int = WINDOW) -> tuple[list[int], list[int]]:
    """The window and the place in it of each length, for lengths from long to short."""
    rooms, at, places, opened = Rooms(window), [], [], 0
    for length in lengths:
        found = rooms.take(length)
        if found is None:
            found, opened = (window, opened), opened + 1
        room, number = found
        at.append(number)
        places.append(window - room)
        if room > length:
            rooms.put(room - length, number)
    return at, places


def pieces(docs: DataFrame, tokenizer: str, end_id: int, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """The pieces of every document: doc_id, start, length, ids_crc32, doc_tokens and, if wanted, ids as bytes."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(tokenizer).encode, end_bytes(end_id)
        for batch in batches:
            rows = []
            for k, text in enumerate(batch["text"]):
                ids = encode(text) + end
                for at in range(0, len(ids), 4 * window):
                    part = ids[at : at + 4 * window]
                    rows.append((k, at // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4, *([part] if with_ids else [])))
            out = pd.DataFrame(rows, columns=["k", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])])
            out.insert(0, "doc_id", batch["doc_id"].take(out.pop("k")).astype("Int64").to_numpy(dtype=object, na_value=None))
            yield out

    return docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInPandas(cut, PIECES + ", ids binary" * with_ids)


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, window: int = WINDOW, group_windows: int = 2048, with_ids: bool = False) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_to and, if
    wanted, ids. A sequence is padded to the window unless its length is a power of two."""
    cut = stored(pieces(docs, tokenizer or default_tokenizer(), end_id, window, with_ids), "pieces")
    total, rows = cut.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count(F.lit(1))).first()
    groups = max(1, -(-total // (window * group_windows)), -(-rows // GROUP_ROWS))
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("doc_id", "start", F.monotonically_increasing_id()), F.lit(groups)))

    def place(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable", ignore_index=True)
        at, places = best_fit(rows["length"].tolist(), window)
        rows["sequence_id"], rows["offset"] = at, places
        used = rows.groupby("sequence_id")["length"].transform("sum")
        rows["padded_to"] = used.where((used & (used - 1)) == 0, window)
        rows["sequence_id"] += key[0] << 32
        return rows.drop(columns="group")

    columns = PIECES + ", ids binary" * with_ids + ", sequence_id long, offset long, padded_to long"
    out = dealt.groupBy("group").applyInPandas(place, columns)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_to", *(["ids"] if with_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences of ``pack(..., with_ids=True)``: sequence_id, ids as bytes in their order, padded_to."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"), F.max("padded_to").alias("padded_to"))
