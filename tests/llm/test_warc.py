import base64
import gzip
import hashlib
import io
import os
import random

import pytest

from sparkwatch.llm.warc import MAGIC, archived, member, members, parsed, read_warc, record, write_warc

SCHEMA = "page_id long, url string, html string, record_type string"


def sha(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_pages_come_back(spark):
    same, long = "<p>same</p>", "".join(f"<p>{i}é</p>\r\n\r\n" for i in range(40_000))
    rows = [
        (5, "http://a/ b\n", same, "x"), (3, None, same, None), (9, "http://c", same, "y"), (1, "u", None, "z"),
        (2, "u", "", "z"), (7, "ü", long, "z"), (None, "n", same, "z"), (8, "u", "WARC/1.1\r\n\r\n", "z"), (8, "u", "WARC/1.1\r\n\r\n", "z"),
    ]
    got = archived(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    by_id = {r.record_id: r for r in got}
    for page, _, html, _ in rows:
        r = by_id[f"urn:page:{page}"]
        size = len((html or "").encode())
        assert (r.payload_digest, r.payload_length) == (sha(html), size)
        if r.record_type == "response":
            assert bytes(r.payload) == (html or "").encode() and r.refers_to is None
        else:
            assert r.payload is None
    assert {i: r.refers_to for i, r in by_id.items() if r.refers_to} == {
        "urn:page:5": "urn:page:3", "urn:page:9": "urn:page:3", "urn:page:2": "urn:page:1",
    }
    assert by_id["urn:page:5"].target_uri == "http://a/%20b%0A" and by_id["urn:page:3"].target_uri is None
    assert archived(spark.createDataFrame([], SCHEMA)).collect() == []


def test_small_payloads_stay_responses(spark):
    df = spark.createDataFrame([(1, "u", "ab", ""), (2, "u", "ab", ""), (3, "u", "abc", ""), (4, "u", "abc", "")], SCHEMA)
    got = {r.record_id: r.record_type for r in archived(df, least_bytes=3).collect()}
    assert [got[f"urn:page:{i}"] for i in (1, 2, 3, 4)] == ["response", "response", "response", "revisit"]


@pytest.mark.parametrize("split", [100, 997, 1 << 20])
def test_every_record_is_read_once_at_any_split(spark, root, split):
    rng = random.Random(1)
    rows = [(i, "u", f"{i}" + rng.randbytes(rng.choice([0, 10, 3000])).hex(), "") for i in range(60)]
    path = f"{root}/split"
    write_warc(spark.createDataFrame(rows, SCHEMA).coalesce(1), path)
    got = read_warc(spark, path, split).select("record_id", "payload").collect()
    assert sorted((r.record_id, bytes(r.payload).decode()) for r in got) == sorted((f"urn:page:{i}", h) for i, _, h, _ in rows)


def test_files_are_plain_gzip(spark, root):
    write_warc(spark.createDataFrame([(1, "u", "one", ""), (2, "v", "two", "")], SCHEMA), f"{root}/plain")
    folder = f"{root}/plain".removeprefix("file:")
    data = b"".join(open(os.path.join(folder, f), "rb").read() for f in os.listdir(folder) if f.startswith("part"))
    assert gzip.decompress(data).count(b"WARC-Type: response") == 2


def test_false_magic_and_damage():
    inner = record("a", b"x" * 50 + MAGIC + gzip.compress(b"WARC/1.1\r\n\r\n"), 10, "D", "u")
    stored = gzip.compress(inner, 0)  # the magic is in the file as it is
    other = member(record("b", b"y", 1, "D", None))
    data = b"junk" + MAGIC + b"junk" + stored + other[:-9] + MAGIC + other
    found = list(members(io.BytesIO(data), 0, len(data), len(data)))
    assert [parsed(d)["record_id"] for _, d in found] == ["a", "b"]
    for cut in range(0, len(data), 7):
        both = [*members(io.BytesIO(data), 0, cut, len(data)), *members(io.BytesIO(data), cut, len(data), len(data))]
        assert [parsed(d)["record_id"] for _, d in both if d.count(b"WARC-Record-ID")] == ["a", "b"]


def test_members_end_with_zero():
    big = os.urandom(1 << 16) * 257
    for data in (b"", b"x", big):
        out = member(data)
        assert out[-1] == 0 and gzip.decompress(out) == data
