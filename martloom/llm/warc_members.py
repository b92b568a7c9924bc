"""WARC archives: writing, turning whole-file gzip into one member per record, and reading by offset.

Archives are rows of a table (name, data), so they go through Spark's writers to the shared folder and
are never larger than ``ARCHIVE_BYTES`` of records plus one record. ``normalise_stream`` works on any
whole-file stream: it inflates once, forward, and holds one record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import map_batches
from martloom.session import write_once

ARCHIVE_BYTES = 8 << 20
CHUNK = 1 << 16
REVISIT_LEAST = 0  # payloads of fewer bytes are always written whole
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    def bytes(self) -> bytes:
        lines = "".join(f"{k}: {v}\r\n" for k, v in self.headers.items())
        return f"WARC/1.1\r\n{lines}\r\n".encode() + self.block + b"\r\n\r\n"

    def payload(self) -> bytes:
        return self.block.partition(b"\r\n\r\n")[2]

    def payload_length(self) -> int:
        """As the stored HTTP head states it; a revisit has the head of the full answer."""
        return int(re.search(rb"(?i)content-length: *(\d+)", self.block.partition(b"\r\n\r\n")[0])[1])


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header_safe(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", value)


def page_record(page_id: object, url: str | None, html: str | None, kind: str, refers_to: object) -> Record:
    payload = (html or "").encode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>", "WARC-Date": DATE}
    if url is not None:
        headers["WARC-Target-URI"] = _header_safe(url)
    headers["WARC-Payload-Digest"] = f"sha1:{digest_of(payload)}"
    if kind == "revisit":
        headers |= {"WARC-Refers-To": f"<urn:page:{refers_to}>", "WARC-Profile": PROFILE}
    block = head + payload if kind == "response" else head
    return Record(headers | {"Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block))}, block)


def records_of(pieces: Iterable[bytes]) -> Iterator[Record]:
    """Records of an inflated stream that arrives in pieces."""
    source, held = iter(pieces), bytearray()

    def fill() -> bool:
        piece = next(source, None)
        if piece is not None:
            held.extend(piece)
        return piece is not None

    while True:
        while not held.strip(b"\r\n") and fill():
            pass
        if not held.strip(b"\r\n"):
            return
        seen = 0
        while (end := held.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(held)
            if not fill():
                raise ValueError("the archive ends inside a record's head")
        lines = held[:end].decode().lstrip("\r\n").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        size = end + 4 + int(headers["Content-Length"])
        while len(held) < size + 4 and fill():
            pass
        if len(held) < size:
            raise ValueError("the archive ends inside a record's block")
        block = bytes(held[end + 4:size])
        del held[:size + 4]
        yield Record(headers, block)


def inflate(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """Inflated pieces of a gzip stream of one or several members, each piece bounded."""
    worker = zlib.decompressobj(31)
    for piece in pieces:
        while piece:
            out = worker.decompress(piece, CHUNK * 4)
            if out:
                yield out
            piece = worker.unconsumed_tail
            if worker.eof:
                piece, worker = worker.unused_data, zlib.decompressobj(31)


def chunks(data: bytes) -> Iterator[bytes]:
    return (data[i:i + CHUNK] for i in range(0, len(data), CHUNK))


def member(data: bytes, level: int = LEVEL) -> bytes:
    worker = zlib.compressobj(level, zlib.DEFLATED, 31)
    return worker.compress(data) + worker.flush()


def normalise_stream(pieces: Iterable[bytes], write, level: int = LEVEL) -> list[tuple[str, str, int, int]]:
    """Rewrite a whole-file stream through ``write(bytes)``; returns (record id, type, offset, length) of each member."""
    index, offset = [], 0
    for record in records_of(inflate(pieces)):
        data = member(record.bytes(), level)
        write(data)
        index.append((record.headers["WARC-Record-ID"], record.headers["WARC-Type"], offset, len(data)))
        offset += len(data)
    return index


def read_member(data: bytes, offset: int, length: int) -> Record:
    return next(records_of(inflate([bytes(data[offset:offset + length])])))


def with_record_types(pages: DataFrame, least: int = REVISIT_LEAST) -> DataFrame:
    """``page_id, url, html, record_type, refers_to``.

    Equal payloads are told by SHA-1 and length; the smallest id of each is counted before anything is moved. The join's
    page side is split by AQE where one payload is very frequent. Rows that repeat the smallest id are responses too; a
    payload without any id is a response each time, and a null id beside others is a revisit.
    """
    body = F.coalesce("html", F.lit("")).cast("binary")
    keyed = pages.select("page_id", "url", "html", F.sha1(body).alias("sha"), F.octet_length(body).cast("bigint").alias("size"))
    first = keyed.select("page_id", "sha", "size").where(F.col("size") >= least).groupBy("sha", "size").agg(F.min("page_id").alias("first_id"))
    first = first.select(F.col("sha").alias("first_sha"), F.col("size").alias("first_size"), "first_id")
    joined = keyed.join(first, (F.col("sha") == F.col("first_sha")) & (F.col("size") == F.col("first_size")), "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("first_id").eqNullSafe(F.col("page_id"))
    return joined.select("page_id", "url", "html", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                         F.when(revisit, F.col("first_id")).alias("refers_to"))


def write_archives(typed: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """``name, data``: archives that are one gzip stream each, as a crawler that compresses whole files leaves them."""
    def make():
        part = TaskContext.get().partitionId()
        state = {"n": 0, "raw": 0, "worker": None, "out": []}

        def close(done):
            if state["worker"] is not None:
                state["out"].append(state["worker"].flush())
                done["name"].append(f"part-{part:05d}-{state['n']:05d}.warc.gz")
                done["data"].append(b"".join(state["out"]))
                state.update(n=state["n"] + 1, raw=0, worker=None, out=[])
            return done

        def step(*lists):
            done = {"name": [], "data": []}
            for row in zip(*lists):
                data = page_record(*row).bytes()
                if state["worker"] is None:
                    state["worker"] = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                state["out"].append(state["worker"].compress(data))
                state["raw"] += len(data)
                if state["raw"] >= archive_bytes:
                    close(done)
            return done

        step.finish = lambda: close({"name": [], "data": []})
        return step

    return map_batches(typed, ["page_id", "url", "html", "record_type", "refers_to"], "name string, data binary", make)


INDEX = "array<struct<record_id: string, record_type: string, offset: bigint, length: bigint>>"


def normalise_archives(archives: DataFrame) -> DataFrame:
    """``name, data, index``: one member per record, and where each member lies."""
    def make():
        def step(names, bodies):
            out = {"name": names, "data": [], "index": []}
            for body in bodies:
                parts: list[bytes] = []
                index = normalise_stream(chunks(body), parts.append)
                out["data"].append(b"".join(parts))
                out["index"].append([dict(zip(("record_id", "record_type", "offset", "length"), x)) for x in index])
            return out
        return step

    return map_batches(archives, ["name", "data"], f"name string, data binary, index {INDEX}", make)


def sidecar(normalised: DataFrame) -> DataFrame:
    """The offset index as a table of its own."""
    return normalised.select("name", F.explode("index").alias("x")).select("name", "x.*")


def read_archives(normalised: DataFrame, id_type: str = "bigint") -> DataFrame:
    """What the archives hold, each record read through its index entry; a response's digest is computed again and must agree."""
    def make():
        def step(names, bodies, indexes):
            out = {"page_id": [], "payload_bytes": [], "payload_digest": [], "record_type": [], "refers_to": []}
            for name, body, index in zip(names, bodies, indexes):
                for entry in index:
                    record = read_member(body, entry["offset"], entry["length"])
                    stated = record.headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind, whole = record.headers["WARC-Type"], record.payload_length()
                    if kind == "response" and (digest_of(record.payload()), len(record.payload())) != (stated, whole):
                        raise ValueError(f"{name}: a payload differs from its digest")
                    refers = record.headers.get("WARC-Refers-To")
                    for key, value in (("page_id", record.headers["WARC-Record-ID"]), ("refers_to", refers)):
                        out[key].append(value[len("<urn:page:"):-1] or None if value else None)
                    out["payload_bytes"].append(whole)
                    out["payload_digest"].append(stated)
                    out["record_type"].append(kind)
            return out
        return step

    read = map_batches(normalised, ["name", "data", "index"], "page_id string, payload_bytes bigint, payload_digest string, "
                       "record_type string, refers_to string", make)
    return read.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def round_trip(pages: DataFrame) -> DataFrame:
    """Write, normalise and read back all pages: ``page_id, payload_bytes, payload_digest, record_type, refers_to``.

    Null html is an empty payload, null urls leave the header out. Only page_id, url and html are read.
    """
    archives = write_once(write_archives(with_record_types(pages)), "warc")
    normalised = write_once(normalise_archives(archives), "warc-members")
    return read_archives(normalised, pages.schema["page_id"].dataType.simpleString())


# Eight groups of five hexadecimal digits make four base32 digits each.
SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
digits AS (
  SELECT *, ('0x' || substr(h, 5 * i + 1, 5))::INTEGER AS v FROM p, range(8) AS r(i)),
d AS (
  SELECT page_id, payload_bytes, h, string_agg(
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (v >> 15 & 31), 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (v >> 10 & 31), 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (v >> 5 & 31), 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (v & 31), 1), ''
    ORDER BY i) AS payload_digest
  FROM digits GROUP BY page_id, payload_bytes, h),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h, payload_bytes) AS first_id FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM f
"""
