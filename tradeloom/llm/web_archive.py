"""WARC records in seekable Zstandard bundles.

A bundle is a run of independent Zstandard frames, each with a few records, followed by the seek table of the public
seekable format: a skippable frame that lists the compressed and raw size of every frame. A reader finds any frame from the
end of the bundle. Next to each bundle stands its index: record identifier, frame, offset and length inside the raw frame.
Bundle and index are one row, so a retried task can never leave one without the other; Spark writes them to any store.

Of records with equal payloads (SHA-1, as in the digest header) of at least ``min_bytes`` the one with the largest page_id is
a response and the others revisit it; smaller payloads and payloads of their own are responses. Rows that repeat that largest
page_id are all responses. Null html is an empty payload. A null page_id ranks below all others; if a group has no other, all
its rows are responses. Null urls leave out the header. An empty table gives no bundles. Only the named columns are read.

Payloads are shuffled once, by digest, in a join that Spark splits where one digest has very many pages; the groups
themselves are combined before the shuffle and hold no payload. A revisit record carries no payload.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, functions as F

# Fixed values of the seekable format and of the records.
SEEK_MAGIC, SKIPPABLE_MAGIC = 0x8F92EAB1, 0x184D2A5E
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FRAME_BYTES = 256 * 1024  # raw; a larger record has a frame of its own
BUNDLE_BYTES = 8 * 1024 * 1024  # raw; bounds what a task holds
LEVEL = 3
BUNDLE_SCHEMA = "bundle string, data binary, records array<struct<id:string,frame:int,offset:int,length:int>>"
RECORD_SCHEMA = ("page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, "
                 "refers_to bigint, digest_ok boolean")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    number = identifier.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id, url, payload: bytes, digest: str, refers_to, is_revisit: bool, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if is_revisit:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return headers, rest[:int(headers["Content-Length"])]


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", *pair) for pair in sizes)
    footer = struct.pack("<IBI", len(sizes), 0, SEEK_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer


def frame_places(data: bytes) -> list[tuple[int, int, int]]:
    """(start, compressed size, raw size) of every frame, read from the end of a bundle."""
    count, _, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEK_MAGIC:
        raise ValueError("no seek table")
    sizes = struct.iter_unpack("<II", data[-9 - 8 * count:-9])
    places, at = [], 0
    for compressed, raw in sizes:
        places.append((at, compressed, raw))
        at += compressed
    return places


def read_frame(data: bytes, place: tuple[int, int, int]) -> bytes:
    start, compressed, raw = place
    return zstandard.ZstdDecompressor().decompress(data[start:start + compressed], max_output_size=raw)


class _Bundle:
    def __init__(self) -> None:
        self.frames, self.sizes, self.records, self.waiting, self.raw = [], [], [], [], 0
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)

    def add(self, identifier: str, data: bytes) -> None:
        self.records.append({"id": identifier, "frame": len(self.frames), "offset": sum(map(len, self.waiting)), "length": len(data)})
        self.waiting.append(data)
        self.raw += len(data)
        if sum(map(len, self.waiting)) >= FRAME_BYTES:
            self.close_frame()

    def close_frame(self) -> None:
        if self.waiting:
            raw = b"".join(self.waiting)
            self.frames.append(self.compressor.compress(raw))
            self.sizes.append((len(self.frames[-1]), len(raw)))
            self.waiting = []

    def row(self) -> pd.DataFrame:
        self.close_frame()
        data = b"".join(self.frames) + seek_table(self.sizes)
        return pd.DataFrame({"bundle": [hashlib.sha1(data).hexdigest()], "data": [data], "records": [self.records]})


def deduplicated(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages with ``digest`` (hexadecimal SHA-1) and ``refers_to``, the response they revisit or null."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    hashed = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha1("payload"))
    groups = (hashed.where(F.length("payload") >= min_bytes).groupBy("digest")
              .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))
    return hashed.join(groups, "digest", "left").select("page_id", "url", "payload", refers_to.alias("refers_to"))


def bundles(pages: DataFrame, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One row per bundle: its name, its bytes and its index."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bundle = _Bundle()
        for batch in batches:
            for page_id, url, payload, refers_to in zip(batch.page_id, batch.url, batch.payload, batch.refers_to):
                page_id = None if pd.isna(page_id) else int(page_id)
                revisit = not pd.isna(refers_to)
                payload = bytes(payload)
                bundle.add(record_id(page_id), record(page_id, url, payload, base32_sha1(payload),
                                                      int(refers_to) if revisit else None, revisit, date))
                if bundle.raw >= BUNDLE_BYTES:
                    yield bundle.row()
                    bundle = _Bundle()
        if bundle.records:
            yield bundle.row()

    # identifiers as text: a column of numbers with nulls would reach pandas as floating point
    rows = deduplicated(pages, min_bytes).select(
        F.col("page_id").cast("string"), "url", "payload", F.col("refers_to").cast("string"))
    return rows.mapInPandas(pack, BUNDLE_SCHEMA)


def _row(raw: bytes) -> tuple:
    headers, block = parsed(raw)
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(next(line for line in http.decode().split("\r\n") if line.startswith("Content-Length: "))[16:])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    revisit = headers["WARC-Type"] == "revisit"
    return (page_of(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), length, digest, headers["WARC-Type"],
            page_of(headers["WARC-Refers-To"]) if revisit else None, revisit or (base32_sha1(payload) == digest and len(payload) == length))


def _frames(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in RECORD_SCHEMA.split(", ")])
    return frame.astype({"page_id": "Int64", "refers_to": "Int64"})


def read_records(archives: DataFrame) -> DataFrame:
    """Every record of the bundles, one row each; frames are decompressed one at a time."""
    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data, records in zip(batch.data, batch.records):
                data, at, raw = bytes(data), -1, b""
                places, rows = frame_places(data), []
                for entry in records:
                    if entry["frame"] != at:
                        at = entry["frame"]
                        raw = read_frame(data, places[at])
                    rows.append(_row(raw[entry["offset"]:entry["offset"] + entry["length"]]))
                yield _frames(rows)

    return archives.mapInPandas(unpack, RECORD_SCHEMA)


def look_up(archives: DataFrame, identifiers: DataFrame) -> DataFrame:
    """Records with the given ``id``s; only the frames that hold them are decompressed."""
    wanted = (archives.select("bundle", F.explode("records").alias("r")).select("bundle", "r.*")
              .join(identifiers.select("id").distinct(), "id", "left_semi"))
    places = wanted.groupBy("bundle").agg(F.sort_array(F.collect_list(F.struct("frame", "offset", "length"))).alias("records"))
    return read_records(archives.select("bundle", "data").join(places, "bundle"))
