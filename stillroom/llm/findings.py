"""Labelled findings to train a secret scan from: values of known kinds, planted in passages of the documents.

No table says which strings of the documents are secrets. So passages are taken from them, and into each a value is put
that was made as one of ``KINDS``: keys, tokens and passwords on one side, and on the other what is mistaken for them.
The label is that of the kind the value was made as; nothing of it is read off the text. Kinds overlap on purpose: the
same hexadecimal string is a token in one place and a commit in another, and harmless values are quoted and assigned as
secrets are. ``kinds`` leaves some out, so that a forest can be judged by kinds it has never seen.

Passages are a sample of at most ``passages`` documents, those with the least hashes, one for each different text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a passage on each side of the planted value.
AROUND = 12


@dataclass(frozen=True)
class Kind:
    name: str
    secret: bool
    before: tuple[str, ...]
    value: Callable[[Column, Column], Column]
    after: str = ""


def _mixed(h: Column, size: int) -> Column:
    """Letters of both sizes and digits, at least one of these."""
    text = F.regexp_replace(F.base64(F.unhex(h)), "[+/=]", "")
    return F.concat(F.substring(text, 1, size - 1), F.substring(F.translate(h, "abcdef", "234567"), 1, 1))


def _digits(h: Column, size: int) -> Column:
    return F.substring(F.translate(h, "abcdef", "123456"), 1, size)


def _hex(size: int) -> Callable[[Column, Column], Column]:
    return lambda h, word: F.substring(h, 1, size)


def _uuid(h: Column, word: Column) -> Column:
    return F.concat_ws("-", *(F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))


KINDS = (
    Kind("hex_token", True, ('token = "', 'secret="', 'auth_token: "'), _hex(40), '"'),
    Kind("upper_token", True, ('TOKEN = "', 'API_KEY="', 'SECRET: "'), lambda h, w: F.upper(F.substring(h, 1, 40)), '"'),
    Kind("short_token", True, ("token=", "access_key = ", "pwd: "), _hex(32)),
    Kind("issued_key", True, ("", "key ", "use "), lambda h, w: F.concat(F.lit("AKIA"), F.upper(_mixed(h, 16)))),
    Kind("base64_key", True, ("secret_key: ", 'private_key = "', "credential="), lambda h, w: F.regexp_replace(F.base64(F.unhex(h)), r"\s", "")),
    Kind("password", True, ("password=", 'passwd: "', "password is "), lambda h, w: _mixed(h, 16)),
    Kind("bearer", True, ("Authorization: Bearer ", "bearer ", "auth: "), lambda h, w: _mixed(h, 40)),
    Kind("api_key", True, ('api_key="', "apikey: ", 'access_key="'), lambda h, w: F.concat(F.lit("sk_live_"), _mixed(h, 24)), '"'),
    Kind("commit", False, ("commit ", "see commit ", 'commit: "'), _hex(40)),
    Kind("checksum", False, ("sha256 ", "checksum: ", 'md5 = "'), _hex(64)),
    Kind("etag", False, ('etag = "', "revision: ", 'digest="'), _hex(32), '"'),
    Kind("uuid", False, ("id: ", 'uuid="', "session id "), _uuid),
    Kind("card", False, ("", "card ", "pay with "), lambda h, w: _digits(h, 16)),
    Kind("order", False, ("order ", "invoice no. ", "order number: "), lambda h, w: _digits(h, 14)),
    Kind("phone", False, ("call ", "phone ", "phone: "), lambda h, w: F.concat(F.lit("0049-"), _digits(h, 10))),
    Kind("path", False, ("see ", "in ", "under "), lambda h, w: F.concat(F.lit("docs/"), w, F.lit("/chapter"), _digits(h, 2), F.lit("/"), w)),
    Kind("release", False, ("release ", "version ", 'build = "'), lambda h, w: F.concat(F.lit("build-20"), _digits(h, 2), F.lit("-03-"), w)),
    Kind("identifier", False, ("call ", "function ", "class "), lambda h, w: F.concat(w, F.lit("Handler"), F.initcap(w), _digits(h, 1), F.initcap(w))),
)


def planted(docs: DataFrame, kinds: Sequence[Kind] = KINDS, passages: int = 200, path: str = "source") -> DataFrame:
    """(doc_id, text, path, planted_value, kind, label): each kind in each passage. Documents of fewer than eight words
    give no passage; without any there are no findings."""
    words = F.array_remove(F.split(docs["text"], r"[\x20\x09-\x0D]+"), "")
    base = docs.select(words.alias("words"), docs[path].cast("string").alias("path")).filter(F.size("words") >= 8)
    base = base.select(F.slice("words", 1, 2 * AROUND).alias("words"), "path").withColumn("hash", F.xxhash64("words"))
    # Hashes under a bound that leaves some times as many rows as are wanted, so that no task ever sorts more.
    bound = int(min(1.0, 8 * passages / max(1, docs.count())) * (1 << 40))
    base = base.filter(F.pmod("hash", F.lit(1 << 40)) < bound).groupBy("words", "hash").agg(F.min("path").alias("path"))
    base = base.orderBy("hash", "words").limit(passages)
    plain = F.coalesce(F.nullif(F.regexp_extract(F.array_join("words", " "), "([a-z]{4,12})", 1), F.lit("")), F.lit("word"))
    made = []
    for number, kind in enumerate(kinds):
        h = F.sha2(F.concat_ws(":", F.lit(kind.name), F.col("hash").cast("string")), 256)
        before = F.array(*(F.lit(b) for b in kind.before))[F.pmod(F.col("hash") + number, F.lit(len(kind.before))).cast("int")]
        made.append(F.struct(F.lit(kind.name).alias("kind"), F.lit(int(kind.secret)).alias("label"), before.alias("before"), kind.value(h, plain).alias("value"), F.lit(kind.after).alias("after")))
    rows = base.select("words", "path", "hash", F.inline(F.array(*made)))
    middle = F.concat("before", "value", "after")
    text = F.concat_ws(" ", F.array_join(F.slice("words", 1, AROUND), " "), middle, F.array_join(F.slice("words", AROUND + 1, AROUND), " "))
    return rows.select(F.xxhash64("kind", "hash").alias("doc_id"), text.alias("text"), "path", F.col("value").alias("planted_value"), "kind", "label")
