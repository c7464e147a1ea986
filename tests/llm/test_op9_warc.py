from __future__ import annotations

import base64
import glob
import gzip
import hashlib
import zlib
from collections import Counter

import pytest

from mercato.llm.op9_warc import member, parse, read_archives, write_archives

BIG = "<p>" + "x" * 1200 + "\r\n\r\nWARC/1.1\r\n\r\n</p>"

ROWS = [
    (1, "http://a/1", BIG),
    (2, "http://a/2", BIG),
    (7, None, BIG),
    (3, "http://a/3", "short"),
    (4, "http://a/4\r\nX-Injected: yes", "short"),
    (5, "http://a/5", None),
    (6, "http://a/6", ""),
    (8, "http://a/8", "é" * 500),
    (9, "http://a/9", "é" * 500),
    (9, "http://a/9", "é" * 500),
    (None, "http://a/none", "é" * 500),
    (10, "http://a/10", "é" * 499 + "z"),
]


@pytest.fixture(scope="module")
def archives(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc") / "out")
    pages = spark.createDataFrame(ROWS, "page_id bigint, url string, html string").repartition(3)
    write_archives(pages, path)
    return path


def test_round_trip(spark, archives):
    rows = read_archives(spark, archives).collect()
    got = Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in rows)

    def digest(t):
        return len((t or "").encode()), hashlib.sha1((t or "").encode()).hexdigest()

    want = Counter()
    for i, _, html in ROWS:
        original = {BIG: 7, "é" * 500: 9}.get(html)
        kind = "revisit" if original is not None and i != original else "response"
        want[i, kind, original if kind == "revisit" else None, *digest(html)] += 1
    assert got == want
    for r in rows:
        html = [h or "" for i, _, h in ROWS if i == r["page_id"]]
        assert r["payload"] in html if r["record_type"] == "response" else r["payload"] is None


def test_archives_are_well_formed(archives):
    records = [x for f in glob.glob(f"{archives}/part-*") for x in parse(gzip.open(f).read())]
    assert len(records) == len(ROWS)
    ids = {h["warc-record-id"] for h, _ in records}
    for headers, block in records:
        assert "x-injected" not in headers
        payload = block.partition(b"\r\n\r\n")[2]
        if headers["warc-type"] == "response":
            stated = base64.b32decode(headers["warc-payload-digest"].removeprefix("sha1:"))
            assert hashlib.sha1(payload).digest() == stated
        else:
            assert payload == b"" and headers["warc-refers-to"] in ids
            assert headers["warc-profile"].endswith("identical-payload-digest")


def test_damage_is_noticed():
    with pytest.raises(ValueError):
        list(parse(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabcd\r\n\r\n"))


def test_odd_rows(result, odd_dir, spark):
    pages = Counter(r["page_id"] for r in spark.read.parquet(f"{odd_dir}/pages.parquet").collect())
    rows = result("op9", odd_dir)
    assert Counter(r["page_id"] for r in rows) == pages
    assert {r["record_type"] for r in rows} == {"response"}


def test_a_member_per_record(archives):
    """Archives can be read at any record's offset, as WARC readers do."""
    uris, referred = [], []
    for f in glob.glob(f"{archives}/part-*"):
        with open(f, "rb") as file:
            rest = file.read()
        while rest:
            one = zlib.decompressobj(wbits=31)
            ((headers, _),) = parse(one.decompress(rest))
            assert one.eof
            rest = one.unused_data
            uris.append(headers["warc-target-uri"])
            if headers["warc-type"] == "revisit":
                referred.append((headers.get("warc-refers-to-target-uri"), headers["warc-refers-to-date"]))
    assert len(uris) == len(ROWS)
    # The original of the long payload has no URL.
    assert Counter(referred) == Counter({(None, "2024-01-01T00:00:00Z"): 2, ("http://a/9", "2024-01-01T00:00:00Z"): 2})


@pytest.mark.parametrize("size", [0, 1, 2**24 - 1, 2**24, 2**24 + 5])
def test_members_of_any_size(size):
    record = b"x" * size
    assert gzip.decompress(member(record) + b"\0" + member(b"next") + b"\0") == record + b"next"
