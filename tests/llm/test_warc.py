"""Archives: what is written, read back, damaged, and what the query returns."""

import base64
import gzip
import hashlib
import io
from collections import Counter

import pytest
from pyarrow import fs

from checks.compare import compare, connect
from sitegrain.llm import warc
from sitegrain.llm.oracle import ORACLE
from sitegrain.llm.queries import QUERIES
from sitegrain.session import work_dir

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, uid long, sha string, payload int, first int"
BIG = "<p>äö 😀 \x00\r\n\r\nWARC/1.1\r\n" * 40_000
ROWS = [
    (1, "http://a.example/ä b\r\nx", "<p>one</p>"), (2, "http://b.example/", "<p>one</p>"), (2, "http://b.example/", "<p>one</p>"),
    (9007199254740993, None, "<p>one</p>"), (None, "u", "<p>one</p>"), (None, None, None), (4, "u", ""), (5, "u", "two"),
    (6, "u", BIG), (7, "u", BIG), (None, "u", "alone"), (-8, "u", "two"), (10, "퟿", "\r\n\r\n"), *[(100 + i, "u", "hot") for i in range(300)], *[(500, "u", "hot")] * 50,
]


def table(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "s", 2, 3) for i, u, h in rows], PAGES).repartition(3)


def plain(rows, least=0):
    groups, out = {}, []
    for i, _, html in rows:
        groups.setdefault(html or "", []).append(i)
    for html, ids in groups.items():
        data = html.encode()
        ids = sorted(ids, key=lambda i: (i is not None, i or 0))
        for n, i in enumerate(ids):
            response = len(data) < least or n == len(ids) - 1
            digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
            out.append((i, len(data), digest, "response" if response else "revisit", None if response else ids[-1]))
    return Counter(out)


@pytest.mark.parametrize("least", [0, 5])
def test_records_of_pages(spark, monkeypatch, least):
    monkeypatch.setattr(warc, "COPIES", 7)
    got = warc.page_records(spark, table(spark, ROWS), least)
    assert got.columns == "page_id payload_bytes payload_digest record_type refers_to".split()
    assert Counter(map(tuple, got.collect())) == plain(ROWS, least)


def test_empty_table(spark):
    assert warc.page_records(spark, table(spark, ROWS).where("false")).count() == 0


def test_query_against_sql(spark):
    assert compare(spark, connect(SF), SF, "op13_warc", QUERIES["op13_warc"], ORACLE["op13_warc"]) == ""


def test_round_trip_and_layout(spark):
    """Payloads come back whole; the archives are what any gzip reader expects, a member to a record."""
    folder = work_dir(spark, "test-warc")
    listed = warc.write_archives(spark, table(spark, ROWS), folder, archive_bytes=5000)
    rows = warc.read_archives(listed, keep=True).collect()
    assert not [r["problem"] for r in rows if r["problem"]]
    kept = Counter(bytes(r["payload"]) for r in rows if r["record_type"] == "response")
    assert kept == Counter({(h or "").encode() for _, _, h in ROWS})
    names = {r["record_id"] for r in rows}
    assert len(names) == len(rows) and {r["refers_to"] for r in rows} - {None} <= names
    assert sum(r["records"] for r in listed.collect()) == len(ROWS)
    assert listed.count() > 3
    for r in listed.collect():
        data = fs.LocalFileSystem().open_input_stream(r["archive"], compression=None).read()
        assert len(data) == r["bytes"] and data.count(b"\x1f\x8b\x08") >= r["records"] + 1
        text = gzip.decompress(data)
        mine = [x for x in rows if x["archive"] == r["archive"]]
        assert len(mine) == r["records"] + 1 and mine[0]["record_type"] == "warcinfo"
        ends = [x["offset"] for x in mine[1:]] + [len(data)]
        joined = b"".join(gzip.decompress(data[x["offset"]:end]) for x, end in zip(mine, ends, strict=True))
        assert joined == text and text.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n") and text.endswith(warc.END)


def response(body, **changes):
    http = b"HTTP/1.1 200 OK\r\n\r\n" + body
    headers = [("WARC-Record-ID", "<urn:x>"), ("Content-Type", "application/http;msgtype=response")]
    headers += [(k.replace("_", "-"), v) for k, v in changes.items()]
    return warc.record("response", headers, http)


@pytest.mark.parametrize("step", [1, 7, 4096])
def test_damage_is_found(step):
    good, other = response(b"x" * 70_000), response(b"y")
    wrong = response(b"y", WARC_Payload_Digest="sha1:AAAA")
    text = gzip.decompress(other)
    short = gzip.compress(text.replace(b"Content-Length: 20", b"Content-Length: 19"))
    long = gzip.compress(text.replace(b"Content-Length: 20", b"Content-Length: 99"))
    changed = gzip.compress(text.replace(b"y" + warc.END, b"z" + warc.END))
    none = gzip.compress(text.replace(b"Content-Length", b"Content-Lengthy"))

    def problems(data):
        return [r["problem"] for r in warc.read_stream(io.BytesIO(data), step=step)]

    assert problems(good + other) == [None, None]
    assert problems(b"") == []
    assert problems(wrong + good) == ["payload digest", None]
    assert problems(changed + good) == ["block digest", None]
    assert problems(short + good)[0].startswith("no end of record") and problems(short + good)[1:] == [None]
    assert "bytes short" in problems(long + good)[0] and problems(long + good)[1:] == [None]
    assert problems(none + good) == ["no content length", None]
    assert problems(gzip.compress(b"other") + good) == ["no WARC header", None]
    assert problems(good + other[:-9]) == [None, "the archive ends within a member"]
    assert problems(good + b"junk" + other)[1].startswith("not a gzip member")


def test_damaged_archives_as_rows(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(response(b"a") + response(b"b")[:-3])
    listed = spark.createDataFrame([(str(tmp_path / "a.warc.gz"),)], "archive string")
    rows = warc.read_archives(listed).collect()
    assert [r["problem"] for r in rows] == [None, "the archive ends within a member"]
    with pytest.raises(Exception, match="ends within a member"):
        warc.read_archives(listed, strict=True).collect()
