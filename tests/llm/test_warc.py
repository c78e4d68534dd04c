import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from stillroom.llm.common import stored
from stillroom.llm.rawfiles import reading
from stillroom.llm.warc import assemble, captures, members, parse, read_records, record, write_archives

ROWS = [
    (1, "http://a.org/x", "same"), (2, "http://a.org/y?q=1#f", "same"), (9, None, "same"), (3, "http://b.org", ""), (4, "http://b.org/\r\nX: injected", None), (5, "http://c.org/ü ö", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n\x00ÿ"),
    (None, "http://d.org/", "same"), (None, "http://d.org/", "nobody else"), (6, "u", "long " * 100_000), (7, "u", "twice"), (7, "u", "twice"), (7, "u", "third"), (8, "", "twice"),
]


def expected(rows, least):
    top, count = {}, {}
    for p, _, h in rows:
        count[h or ""] = count.get(h or "", 0) + 1
        if p is not None:
            top[h or ""] = max(top.get(h or "", p), p)
    out = []
    for p, _, h in rows:
        data = (h or "").encode()
        to = top.get(h or "") if len(data) >= least and count[h or ""] > 1 and top.get(h or "") != p else None
        out.append((p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "x", 1) for r in ROWS], "page_id long, url string, html string, record_id string, copy int")


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, pages, path, least):
    files = write_archives(pages, path("w"), revisit_from=least)
    records = stored(read_records(spark, path("w"), files, with_payload=True), "records")
    assert records.count() == 3 * len(ROWS) == records.select("record_id").distinct().count()
    whole = stored(assemble(records), "captures")
    assert sorted((tuple(r) for r in captures(whole).collect()), key=str) == expected(ROWS, least)
    for r in whole.collect():
        assert len(r["requests"]) == len(r["metadata"]) == 1 and r["requests"][0]["concurrent_to"] == [r["capture_id"]]
        assert (r["response"]["payload"] is None) == (r["response"]["warc_type"] == "revisit")
        assert "injected" not in [line.split(":")[0] for line in r["requests"][0]["fields"].split("\r\n")]
    payloads = {bytes(r["response"]["payload"]).decode() for r in whole.collect() if r["response"]["payload"] is not None}
    assert payloads == {h or "" for _, _, h in ROWS}


def test_identifiers_lead_either_way_and_over_one_record(spark):
    columns = "record_id string, warc_type string, concurrent_to array<string>, refers_to string, target_uri string, date string, fields string, payload_bytes long, payload_digest string"
    rows = [("r1", "response", ["q1"]), ("q1", "request", []), ("m1", "metadata", ["q1"]), ("r2", "response", []), ("q2", "request", ["r2"]), ("m2", "metadata", ["q2"]), ("m3", "metadata", ["r2"]), ("q9", "request", ["gone"]), ("m9", "metadata", ["gone"]), ("r5", "revisit", [])]
    records = spark.createDataFrame([(*r, None, None, None, None, None, None) for r in rows], columns)
    found = {r["capture_id"]: (r["response"] and r["response"]["record_id"], [x["record_id"] for x in r["requests"]], [x["record_id"] for x in r["metadata"]]) for r in assemble(records).collect()}
    assert found == {"r1": ("r1", ["q1"], ["m1"]), "r2": ("r2", ["q2"], ["m2", "m3"]), "gone": (None, ["q9"], ["m9"]), "r5": ("r5", [], [])}


def test_damage_is_noticed(pages, path):
    files = write_archives(pages.filter("page_id = 6"), path("d"))
    name = files.select(F.first("name")).first()[0]
    with open(f"{path('d')}/{name}", "rb") as f:
        data = f.read()
    with open(path("cut"), "wb") as f:
        f.write(data[:-20])
    with reading(path("cut")) as source, pytest.raises(ValueError, match="within a record"):
        list(members(source))
    bad = record([("WARC-Type", "response"), ("WARC-Record-ID", "<x>"), ("WARC-Payload-Digest", "sha1:AAAA")], b"HTTP/1.1 200 OK\r\nContent-Length: 1\r\n\r\nx")
    with pytest.raises(ValueError, match="not what was archived"):
        parse(bad)
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 3


def test_no_pages(spark, pages, path):
    files = write_archives(pages.filter("false"), path("n"))
    assert captures(assemble(read_records(spark, path("n"), files))).count() == 0
