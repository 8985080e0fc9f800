"""Operator 5: WARC archives, written and read back.

Written: one gzip member per record. Of records with equal payloads the one
with the largest id is a response; the others are revisits, which name it and
hold no payload. Read: sequentially, member by member, with incremental zlib
decompression, framing by content length, and all digests verified; memory is
one chunk and one header, whatever a record's size.

Archives live in the shared folder that the cluster names, reached from the
tasks through pyarrow's file systems. A task writes under names of its own
(with a random part) and returns them; the table of returned names is what is
read. So a task that is repeated, or that runs twice, leaves at worst an
archive that nobody reads.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinistar.llm.common import scratch, staged, table

#: Payloads below this many bytes are always responses.
LEAST_REVISIT = 0
#: An archive ends after this many compressed bytes.
ARCHIVE_BYTES = 64 << 20
#: Bytes read or decompressed at once.
CHUNK = 1 << 16
#: Parts that a group of equal payloads is split into.
PARTS = 32
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def file_system(uri: str):
    """pyarrow's file system for a URI, and the path in it."""
    from pyarrow import fs

    if uri.startswith("file:/"):
        uri = "file:///" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def header_value(text: str) -> str:
    """A header stays on one line: control characters and % are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c < " " or c in "\x7f%" else c for c in text)


def member(record_id: str, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record as one gzip member."""
    block = HTTP if refers_to is not None else HTTP + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{record_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Block-Digest: sha1:{sha1(block)}",
        f"WARC-Payload-Digest: sha1:{sha1(payload)}",
        f"X-Payload-Length: {len(payload)}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {header_value(url)}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


class Members:
    """The bytes of a stream of gzip members; ``read`` stops at a member's end."""

    def __init__(self, stream):
        self.stream, self.raw, self.z = stream, b"", None
        self.held = b""

    def next_member(self) -> bool:
        """Go to the next member; the one before must have been read whole."""
        if self.z is not None and (self.held or not self.z.eof):
            raise ValueError("a record ends before its gzip member does")
        self.z = zlib.decompressobj(31)
        self.raw = self.raw or self.stream.read(CHUNK)
        return bool(self.raw)

    def _more(self) -> bool:
        while not self.z.eof:
            if not self.raw:
                self.raw = self.stream.read(CHUNK)
                if not self.raw:
                    raise ValueError("an archive ends inside a record")
            self.held += self.z.decompress(self.raw, CHUNK)
            self.raw = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
            if self.held:
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        """Up to a mark, which is dropped."""
        while (at := self.held.find(mark)) < 0:
            before = len(self.held)
            if self.z.eof or (not self._more() and len(self.held) == before):
                raise ValueError("a record without a header's end")
        found, self.held = self.held[:at], self.held[at + len(mark) :]
        return found

    def exactly(self, n: int) -> Iterator[bytes]:
        """``n`` bytes, in pieces."""
        while n:
            if not self.held and not self._more():
                raise ValueError("a record shorter than its content length")
            piece, self.held = self.held[:n], self.held[n:]
            n -= len(piece)
            yield piece

    def finish(self) -> None:
        """The two line ends after a block, then the member's end."""
        if b"".join(self.exactly(4)) != b"\r\n\r\n":
            raise ValueError("a record longer than its content length")
        if self.held or self._more():
            raise ValueError("more than one record in a gzip member")


@dataclass
class Record:
    type: str
    page_id: str
    url: str | None
    payload_bytes: int
    payload_digest: str
    refers_to: str | None
    payload: bytes | None


def records(stream, keep_payload: bool = False) -> Iterator[Record]:
    """The records of an archive, verified. Payloads are only hashed unless kept."""
    members = Members(stream)
    while members.next_member():
        lines = members.until(b"\r\n\r\n").decode("utf-8").split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"not a record: {lines[0]!r}")
        head = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines[1:])}
        whole, payload, size, http, kept = hashlib.sha1(), hashlib.sha1(), 0, b"", []
        in_http = True
        for piece in members.exactly(int(head["content-length"])):
            whole.update(piece)
            if in_http:
                http += piece
                at = http.find(b"\r\n\r\n")
                if at < 0:
                    continue
                piece, in_http = http[at + 4 :], False
            payload.update(piece)
            size += len(piece)
            if keep_payload:
                kept.append(piece)
        members.finish()
        digest = head["warc-payload-digest"].removeprefix("sha1:")
        if base64.b32encode(whole.digest()).decode() != head["warc-block-digest"].removeprefix("sha1:"):
            raise ValueError(f"block digest of {head['warc-record-id']}")
        revisit = head["warc-type"] == "revisit"
        if not revisit and (base64.b32encode(payload.digest()).decode(), size) != (digest, int(head["x-payload-length"])):
            raise ValueError(f"payload digest of {head['warc-record-id']}")
        refers = head.get("warc-refers-to")
        name = lambda x: x.removeprefix("<urn:page:").removesuffix(">")
        yield Record(
            head["warc-type"], name(head["warc-record-id"]), head.get("warc-target-uri"),
            int(head["x-payload-length"]), digest, name(refers) if refers else None,
            None if revisit or not keep_payload else b"".join(kept),
        )


def with_types(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``page_id, url, payload, revisit_of``: which records refer to which.

    A group of equal payloads may hold a third of all pages: its largest id is
    found by a partial aggregation of ids, and goes back to at most ``PARTS``
    parts of the group, those that have pages.
    """
    rows = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("payload"),
    ).withColumn("same", F.sha2("payload", 256)).withColumn("part", F.pmod(F.xxhash64("page_id", "url"), F.lit(PARTS)))
    top = rows.groupBy("same").agg(F.max("page_id").alias("top_id"), F.collect_set("part").alias("parts"))
    top = top.select("same", "top_id", F.explode("parts").alias("part"))
    is_top = F.col("page_id").eqNullSafe(F.col("top_id")) | (F.octet_length("payload") < least)
    return rows.join(top, ["same", "part"]).select("page_id", "url", "payload", F.when(~is_top, F.col("top_id")).alias("revisit_of"))


def write_archives(pages: DataFrame, folder: str, least: int = LEAST_REVISIT) -> DataFrame:
    """Write ``page_id, url, html`` as archives under ``folder``; the returned
    table, ``path, n_records, n_bytes``, is written and names them."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = file_system(folder)
        out, done = None, []
        for b in batches:
            for page_id, url, payload, of in zip(b["page_id"], b["url"], b["payload"], b["revisit_of"]):
                if out is None:
                    path = f"{root}/{uuid.uuid4().hex}.warc.gz"
                    out, n, size = fs.open_output_stream(path), 0, 0
                data = member(page_id or "", url, payload.encode("utf-8", "replace"), of)
                out.write(data)
                n, size = n + 1, size + len(data)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((path, n, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, n, size))
        yield pd.DataFrame(done, columns=["path", "n_records", "n_bytes"])

    fs, root = file_system(folder)
    fs.create_dir(root, recursive=True)
    rows = with_types(pages, least)
    rows = rows.withColumns({c: F.col(c).cast("string") for c in ("page_id", "revisit_of")})
    return staged(rows.mapInPandas(write, "path string, n_records long, n_bytes long"), "warc-names")


def read_archives(names: DataFrame, folder: str) -> DataFrame:
    """Every record of the archives that ``names`` lists, verified."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = file_system(folder)
        columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        for b in batches:
            for path, expected in zip(b["path"], b["n_records"]):
                rows, n = [], 0
                with fs.open_input_stream(path) as stream:
                    for r in records(stream):
                        rows.append((r.page_id or None, r.url, r.payload_bytes, r.payload_digest, r.type, r.refers_to))
                        n += 1
                        if len(rows) == 4096:
                            yield pd.DataFrame(rows, columns=columns)
                            rows = []
                if n != expected:
                    raise ValueError(f"{path} has {n} of {expected} records")
                yield pd.DataFrame(rows, columns=columns)

    parts = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = names.repartition(parts, "path").mapInPandas(
        read, "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    )
    return found.withColumns({c: F.col(c).cast("long") for c in ("page_id", "refers_to")})


def round_trip(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """Write ``pages`` as archives and read them back: ``page_id,
    payload_bytes, payload_digest, record_type, refers_to, url``, one row per
    row of ``pages``.

    ``pages`` needs ``page_id, url, html``; other columns are ignored. A null
    html is an empty payload, and empty payloads are equal; a null url gives
    no address; a null id counts as smaller than any other. Repeated rows that
    share the largest id of their payload are responses, all of them. No rows
    give no rows.
    """
    spark = pages.sparkSession
    folder = scratch(spark, "warc")
    return read_archives(write_archives(pages, folder, least), folder)


def op5_warc(spark, sf_dir) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
