"""Pages as WARC archives, written with revisit records and read back member by member.

Writing first decides on narrow rows which record carries a payload: of equal payloads (by SHA-256)
of at least ``least`` bytes the row with the largest ``page_id`` is a response and the others are
revisits that name it. A row's name is the digest of all that its record holds; bodies meet their
decision by this name, so a payload that a third of all pages share is no hot key. Rows that are
equal in everything travel once, with their number, and the writer makes a record for each.
Each task writes archives of its own below the shared folder, one gzip member to a record, under
names that no other attempt uses; the written list of archives says which ones count, so a file
that a lost executor left half-written is never read.

Reading is sequential: a member is inflated in small steps, its header is parsed, the block is
framed by Content-Length and must be followed by the two closing line ends and the member's end,
and the digests of block and payload are taken on the way and compared with those of the header.
Memory holds one step, and the payload only where it is asked for. A record that breaks a rule
carries a ``problem``; after a broken gzip stream the rest of that archive is left, which its last
row says. With ``strict`` the job fails instead.

Defined results: a null html is an empty payload, and empty payloads are equal to each other; a
null url leaves the target out; a null ``page_id`` is smaller than any other; rows of one payload
and ``page_id`` are told apart by their name, and of rows repeated whole one counts as the larger;
an empty table writes no archive; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from functools import partial
from urllib.parse import quote

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrain.llm.common import HOT, join_groups, stored, whole_text
from sitegrain.session import work_dir

STEP = 4096  # compressed bytes inflated at once; deflate makes about a thousand times as many of them at most
HEADER_LIMIT = 1 << 20
ARCHIVE_BYTES = 1 << 30
COPIES = 10_000  # records of equal rows that one task writes at most
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"
RECORD = (
    "archive string, offset long, record_type string, record_id string, target_uri string, payload_bytes long, "
    "payload_digest string, refers_to string, problem string, payload binary"
)


def digest32(sha1: hashlib._Hash) -> str:
    return base64.b32encode(sha1.digest()).decode()


# Writing


def named_pages(pages: DataFrame) -> DataFrame:
    """The columns a record is made of, the payload's SHA-256, and a name: the digest of them all."""
    html = whole_text("html")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("html"), F.sha2(html, 256).alias("sha")
    )
    whole = F.concat("sha", F.lit(" "), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.coalesce(F.concat(F.lit(" "), "url"), F.lit("")))
    return rows.withColumn("name", F.sha2(whole, 256))


def decide(spark: SparkSession, named: DataFrame, least: int = 0) -> DataFrame:
    """A narrow row for each name: its page_id, how many rows bear it, and the name and page_id of the response it refers to.

    Those of the response itself are null.
    """
    rows = stored(
        spark, named.groupBy("name", "page_id", "sha", F.octet_length("html").alias("bytes")).agg(F.count(F.lit(1)).alias("copies")), "warc-rows"
    )
    groups = rows.where(F.col("bytes") >= least).groupBy("sha").agg(
        F.max(F.struct("page_id", "name")).alias("first"), F.count(F.lit(1)).alias("rows")
    )
    joined = join_groups(rows, stored(spark, groups, "warc-groups"), "sha", "rows", rows.count())
    return stored(
        spark,
        joined.select(
            "name", "copies", record_id(F.col("page_id"), F.col("name")).alias("own"),
            F.when(F.col("first.name") != F.col("name"), record_id(F.col("first.page_id"), F.col("first.name"))).alias("refers_to"),
            (F.col("bytes") >= least).alias("revisits"),
        ),
        "warc-decisions",
    )


def record_id(page_id: Column, name: Column) -> Column:
    """The identifier of the first record of a name; further copies get a number behind it."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("null")), F.lit(":"), name, F.lit(">"))


def with_bodies(named: DataFrame, decisions: DataFrame) -> DataFrame:
    """Each name's decision and columns, once for every ``COPIES`` of its copies from ``start`` on."""
    repeated = decisions.where("copies > 1")
    if repeated.isEmpty():
        return named.join(decisions, "name").withColumn("start", F.lit(0).cast("long"))
    total = decisions.agg(F.sum("copies")).first()[0]
    hot = F.broadcast(repeated.where(f"copies > {total // HOT}").select("name"))
    once = named.join(hot, "name", "left_anti").join(decisions.where("copies = 1"), "name").withColumn("start", F.lit(0).cast("long"))
    again = join_groups(named, repeated, "name", "copies", total, "inner").dropDuplicates(["name"])
    again = again.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))))
    return once.unionByName(again.repartition("name", "start"))


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    lines = [("WARC-Type", kind), *headers, ("WARC-Block-Digest", f"sha1:{digest32(hashlib.sha1(block))}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    z = zlib.compressobj(wbits=31)
    return b"".join((z.compress(head.encode()), z.compress(block), z.compress(END), z.flush()))


def page_records_of(row, date: str) -> Iterator[bytes]:
    """A record for each copy of a row: a response, or a revisit, whose block ends with the HTTP header."""
    payload = bytes(row.payload)
    target = [("WARC-Target-URI", quote(row.url, safe="!#$%&'()*+,/:;=?@[]~"))] if isinstance(row.url, str) else []
    kind = [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest32(hashlib.sha1(payload))}")]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    for copy in range(row.start, min(row.copies, row.start + COPIES)):
        own = f"{row.own[:-1]}:{copy}>" if copy else row.own
        to = row.refers_to or (row.own if copy and row.revisits else None)
        headers = [("WARC-Record-ID", own), ("WARC-Date", date), *target, *kind]
        if to is None:
            yield record("response", headers, http + payload)
        else:
            yield record("revisit", [*headers, ("WARC-Profile", PROFILE), ("WARC-Refers-To", to)], http)


def _write(batches: Iterator[pd.DataFrame], folder: str, archive_bytes: int, date: str) -> Iterator[pd.DataFrame]:
    files, top = fs.FileSystem.from_uri(folder)
    out, path, count, size = None, "", 0, 0

    def close() -> pd.DataFrame:
        out.close()
        return pd.DataFrame({"archive": [f"{folder}/{path}"], "records": [count], "bytes": [size]})

    for batch in batches:
        for row in batch.itertuples(index=False):
            if out is None:
                files.create_dir(top, recursive=True)
                path, count = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                out = files.open_output_stream(f"{top}/{path}", compression=None)
                info = [("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("WARC-Filename", path), ("Content-Type", "application/warc-fields")]
                size = out.write(record("warcinfo", info, b"format: WARC File Format 1.1\r\n"))
            for data in page_records_of(row, date):
                size += out.write(data)
                count += 1
            if size >= archive_bytes:
                yield close()
                out = None
    if out is not None:
        yield close()


def write_archives(
    spark: SparkSession, pages: DataFrame, folder: str, least: int = 0, archive_bytes: int = ARCHIVE_BYTES,
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write every page to archives in ``folder`` (a URI that all executors reach) and return their list: archive, records, bytes."""
    named = named_pages(pages)
    rows = with_bodies(named, decide(spark, named, least)).select(
        "own", "refers_to", "revisits", "copies", "start", "url", F.col("html").cast("binary").alias("payload")
    )
    write = partial(_write, folder=folder, archive_bytes=archive_bytes, date=date)
    return stored(spark, rows.mapInPandas(write, "archive string, records long, bytes long"), "warc-list")


# Reading


class Damaged(Exception):
    """What follows in the archive cannot be read."""


class Member:
    """The inflated bytes of one gzip member, taken in steps from ``source``."""

    def __init__(self, source: Source):
        self.source, self.z, self.data = source, zlib.decompressobj(wbits=31), b""

    def more(self) -> bool:
        """Inflate another step into ``data``; False at the member's end."""
        while not self.z.eof:
            raw = self.source.take()
            if not raw:
                raise Damaged("the archive ends within a member")
            try:
                out = self.z.decompress(raw)
            except zlib.error as e:
                raise Damaged(f"not a gzip member: {e}") from e
            self.source.give_back(self.z.unused_data)
            if out:
                self.data += out
                return True
        return False

    def until(self, mark: bytes, limit: int) -> bytes | None:
        """The bytes before ``mark``, which is skipped; None where it does not come."""
        seen = 0
        while (at := self.data.find(mark, max(0, seen - len(mark) + 1))) < 0:
            seen = len(self.data)
            if seen > limit or not self.more():
                return None
        found, self.data = self.data[:at], self.data[at + len(mark):]
        return found

    def pieces(self, length: int) -> Iterator[bytes]:
        """The next ``length`` bytes in steps, or what there is of them."""
        while length and (self.data or self.more()):
            piece, self.data = self.data[:length], self.data[length:]
            length -= len(piece)
            yield piece


class Source:
    """The compressed bytes of an archive in steps, with the place of the next one."""

    def __init__(self, stream, step: int = STEP):
        self.stream, self.step, self.held, self.offset = stream, step, b"", 0

    def take(self) -> bytes:
        data, self.held = self.held or self.stream.read(self.step), b""
        self.offset += len(data)
        return data

    def give_back(self, data: bytes) -> None:
        self.held = data
        self.offset -= len(data)


def fields(head: bytes) -> dict[str, str]:
    """Named fields by lower-case name; the first line is left out."""
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def read_record(member: Member, keep: bool) -> dict:
    """Parse and verify the member's record."""
    head = member.until(END, HEADER_LIMIT)
    if head is None or not head.startswith(b"WARC/"):
        return {"problem": "no WARC header"}
    named = fields(head)
    out = {
        "record_type": named.get("warc-type"), "record_id": named.get("warc-record-id"), "target_uri": named.get("warc-target-uri"),
        "refers_to": named.get("warc-refers-to"),
    }
    if not named.get("content-length", "").isdecimal():
        return out | {"problem": "no content length"}
    length = left = int(named["content-length"])
    block, payload, kept, size, http = hashlib.sha1(), hashlib.sha1(), [], 0, b""
    inside = not named.get("content-type", "").startswith("application/http")
    for piece in member.pieces(length):
        block.update(piece)
        left -= len(piece)
        if not inside:
            # The HTTP header goes before the payload.
            http += piece
            at = http.find(END)
            if at < 0 and len(http) <= HEADER_LIMIT:
                continue
            inside, piece, http = True, http[at + 4:] if at >= 0 else b"", http[:max(at, 0)]
        payload.update(piece)
        size += len(piece)
        if keep:
            kept.append(piece)
    tail = b"".join(member.pieces(5))
    problems = []
    if left:
        problems.append(f"{left} bytes short of its content length")
    elif tail != END:
        problems.append("no end of record after its content length")
    digest, whole = named.get("warc-payload-digest", "").removeprefix("sha1:"), digest32(payload)
    if named.get("warc-block-digest", digest32(block)).removeprefix("sha1:") != digest32(block):
        problems.append("block digest")
    if out["record_type"] == "revisit":
        told = fields(http).get("content-length", "")
        size = int(told) if told.isdecimal() else None
    elif digest and digest != whole:
        problems.append("payload digest")
    return out | {
        "payload_bytes": size, "payload_digest": digest or whole, "problem": ", ".join(problems) or None,
        "payload": b"".join(kept) if keep and out["record_type"] != "revisit" else None,
    }


def read_stream(stream, keep: bool = False, step: int = STEP) -> Iterator[dict]:
    """The records of an archive in their order, each with the offset of its member."""
    source = Source(stream, step)
    while True:
        first = source.take()
        if not first:
            return
        source.give_back(first)
        at, member = source.offset, Member(source)
        try:
            found = read_record(member, keep)
            # What a record with a wrong length leaves is skipped up to the member's end.
            while member.more():
                member.data = b""
        except Damaged as e:
            yield {"offset": at, "problem": str(e)}
            return
        yield {"offset": at, **found}


def _read(batches: Iterator[pd.DataFrame], keep: bool, strict: bool) -> Iterator[pd.DataFrame]:
    columns = [c.split()[0] for c in RECORD.split(", ")]
    for batch in batches:
        for archive in batch["archive"]:
            files, path = fs.FileSystem.from_uri(archive)
            with files.open_input_stream(path, compression=None) as stream:
                rows, held = [], 0
                for found in read_stream(stream, keep):
                    if strict and found.get("problem"):
                        raise ValueError(f"{archive} at {found['offset']}: {found['problem']}")
                    rows.append({"archive": archive} | found)
                    held += len(found.get("payload") or b"")
                    if len(rows) >= 4096 or held > 1 << 24:
                        yield pd.DataFrame(rows, columns=columns, dtype=object)
                        rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=columns, dtype=object)


def read_archives(archives: DataFrame, keep: bool = False, strict: bool = False) -> DataFrame:
    """The records of the archives listed in ``archive``, a task for each; ``keep`` adds payloads."""
    each = archives.select("archive").repartition(max(1, archives.count()))
    return each.mapInPandas(partial(_read, keep=keep, strict=strict), RECORD)


def page_records(spark: SparkSession, pages: DataFrame, least: int = 0) -> DataFrame:
    """One row per page from its record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Of equal payloads of at least ``least`` bytes, the row with the largest ``page_id`` is the response.
    """
    found = read_archives(write_archives(spark, pages, work_dir(spark, "warc"), least), strict=True)

    def page(name: str):
        return F.regexp_extract(name, r"^<urn:page:(-?\d+):", 1).try_cast("long")

    return found.where(F.col("record_type").isin("response", "revisit")).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to").alias("refers_to"),
    )
