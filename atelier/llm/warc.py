"""WARC archives as seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each holding some dozens of
WARC records. A skippable frame at the end is the seek table: the packed and
plain size of every frame, and a footer to find the table from the end of the
file. Any Zstandard reader can decompress a bundle as it is. The index maps
each record id to its bundle, its frame and its offset within that frame, so
one record is read by decompressing one frame.

Of records with equal payloads the one with the smallest id is the response;
the others are revisit records that name it and carry no payload. Payloads
are compared by SHA-256 and length; only digests and ids take part, and the
payloads move once, to meet the decisions.

A record's id is made of its page's id and payload digest, so a revisit knows that of its response, and
rows of one page id with different payloads have different ids. All records have one ``WARC-Date``, a
parameter, so that reruns write the same.

Defined results: a null payload is empty. Rows that repeat the response's id
and payload are responses too, one record written again under its id. A row without an id is a response that nothing
refers to; its record's id is made of its bundle and place. Null target URIs are written as an empty header.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atelier.llm.files import new_name, open_file, open_new
from atelier.llm.staging import shared_folder, staged, with_types

#: Plain bytes after which a frame ends, and packed bytes after which a bundle ends.
FRAME_BYTES = 1 << 18
BUNDLE_BYTES = 1 << 26
LEVEL = 3
#: Date of the records where the caller names none.
DATE = "2000-01-01T00:00:00Z"
#: Tasks that read bundles back.
MAX_READERS = 100_000
#: Fixed values of the seekable Zstandard format: skippable frame, footer.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER = 9

INDEX = "page_id long, bundle string, frame int, at long, length long"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = DATE, place: str = "") -> bytes:
    """One WARC record; a revisit has the digest and size of the payload it leaves out. ``place`` names a record without a page id."""
    body = b"" if revisit else payload
    digest = payload_digest(payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{f'-:{place}' if page_id is None else f'{page_id}:{digest}'}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Payload-Length: {len(payload)}",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}:{digest}>"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}", "", ""]
    return "\r\n".join(lines).encode() + body + b"\r\n\r\n"


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, body and the place after the record that begins at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:end].decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines)
    begin = end + 4
    stop = begin + int(headers["Content-Length"])
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise ValueError("a WARC record doesn't end where its length says")
    return headers, data[begin:stop], stop + 4


class BundleWriter:
    """Records go into the open frame; full frames go into the file; the seek table comes last."""

    def __init__(self, uri: str):
        self.uri, self.out = uri, open_new(uri)
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.frames: list[tuple[int, int]] = []
        self.buffer, self.written = bytearray(), 0

    def add(self, item: bytes) -> tuple[int, int]:
        """Frame and offset of the record."""
        if self.buffer and len(self.buffer) + len(item) > FRAME_BYTES:
            self.end_frame()
        place = len(self.frames), len(self.buffer)
        self.buffer += item
        return place

    def end_frame(self) -> None:
        packed = self.packer.compress(bytes(self.buffer))
        self.out.write(packed)
        self.frames.append((len(packed), len(self.buffer)))
        self.written += len(packed)
        self.buffer.clear()

    def close(self) -> None:
        if self.buffer:
            self.end_frame()
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + FOOTER))
        self.out.write(table + struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC))
        self.out.close()


class BundleReader:
    """Frames of a bundle by number, found through its seek table."""

    def __init__(self, uri: str):
        self.file = open_file(uri)
        size = self.file.size()
        self.file.seek(size - FOOTER)
        count, _, magic = struct.unpack("<IBI", self.file.read(FOOTER))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"no seek table in {uri}")
        self.file.seek(size - FOOTER - 8 * count)
        self.sizes = list(struct.iter_unpack("<II", self.file.read(8 * count)))
        self.begins = [0]
        for packed, _ in self.sizes:
            self.begins.append(self.begins[-1] + packed)

    def frame(self, k: int) -> bytes:
        self.file.seek(self.begins[k])
        packed, plain = self.sizes[k]
        return zstandard.ZstdDecompressor().decompress(self.file.read(packed), max_output_size=plain)

    def records(self):
        for k in range(len(self.sizes)):
            data, at = self.frame(k), 0
            while at < len(data):
                headers, body, after = parse_record(data, at)
                yield k, at, headers, body
                at = after

    def close(self) -> None:
        self.file.close()


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["page_id", "bundle", "frame", "at", "length"]
    )


def _bundled(folder: str, date: str):
    def run(batches):
        writer, rows = None, []
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "refers_to", "revisit")]
            for k in range(batch.num_rows):
                page_id, url, payload, refers_to, revisit = (c[k].as_py() for c in columns)
                writer = writer or BundleWriter(new_name(folder, ".warc.zst"))
                place = f"{writer.uri.rsplit('/', 1)[-1].split('.')[0]}:{len(rows)}"
                item = record(page_id, url, payload, refers_to, revisit, date, place)
                rows.append((page_id, writer.uri, *writer.add(item), len(item)))
                if writer.written >= BUNDLE_BYTES:
                    writer.close()
                    yield _index_batch(rows)
                    writer, rows = None, []
        if writer:
            writer.close()
            yield _index_batch(rows)

    return run


def decided(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, refers_to and revisit for each row."""
    rows = with_types(pages, page_id="long", url="string", html="string")
    rows = rows.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    size = F.octet_length("payload")
    digests = staged(rows.select("page_id", F.sha2("payload", 256).alias("sha"), size.alias("size")).where(size >= min_bytes), "digests")
    digests = digests.where("page_id is not null")
    firsts = digests.groupBy("sha", "size").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
    # Written first: a join of two plain exchanges, so that Spark can split the partition of a hot payload.
    firsts = staged(firsts.where("n > 1").drop("n"), "firsts")
    revisits = digests.join(firsts, ["sha", "size"]).where("page_id > refers_to").select("page_id", "sha", "refers_to").distinct()
    out = rows.withColumn("sha", F.sha2("payload", 256)).join(revisits, ["page_id", "sha"], "left")
    return out.select("page_id", "url", "payload", "refers_to", F.col("refers_to").isNotNull().alias("revisit"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = DATE) -> DataFrame:
    """Writes bundles below ``folder``; one index row per record: page_id, bundle, frame, at, length."""
    return staged(decided(pages, min_bytes).mapInArrow(_bundled(folder, date), INDEX), "warc-index")


def _id_of(header: str | None) -> int | None:
    value = (header or "<urn:page:-:>").removeprefix("<urn:page:").split(":")[0]
    return None if value == "-" else int(value)


def _described(headers: dict[str, str], body: bytes) -> tuple:
    """A response is measured by its payload, a revisit by what its headers say."""
    digest, size = headers["WARC-Payload-Digest"].removeprefix("sha1:"), int(headers["WARC-Payload-Length"])
    kind = headers["WARC-Type"]
    if kind == "response" and (digest, size) != (payload_digest(body), len(body)):
        raise ValueError(f"damaged payload of {headers['WARC-Record-ID']}")
    return _id_of(headers["WARC-Record-ID"]), size, digest, kind, _id_of(headers.get("WARC-Refers-To"))


_DESCRIBED = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _read_bundles(batches):
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    for batch in batches:
        for uri in batch.column("bundle").to_pylist():
            reader = BundleReader(uri)
            rows = [_described(headers, body) for _, _, headers, body in reader.records()]
            reader.close()
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def read_archives(index: DataFrame) -> DataFrame:
    """One row per record of the bundles that the index names."""
    bundles = index.select("bundle").distinct()
    # A task for each bundle: the names alone are so short that Spark would give them all to one.
    bundles = bundles.repartition(max(1, min(bundles.count(), MAX_READERS)))
    return bundles.mapInArrow(_read_bundles, _DESCRIBED)


def _fetched(batches):
    for batch in batches:
        for page_id, uri, frame, at, _ in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
            reader = BundleReader(uri)
            headers, body, _ = parse_record(reader.frame(frame), at)
            reader.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([page_id], pa.int64()), pa.array([headers["WARC-Type"]]), pa.array([body], pa.binary())],
                ["page_id", "record_type", "payload"],
            )


def fetch(index: DataFrame, ids: DataFrame) -> DataFrame:
    """The records with these page ids, each by its own frame: page_id, record_type, payload."""
    wanted = index.join(ids.select("page_id").distinct(), "page_id", "left_semi").select(*[c.split()[0] for c in INDEX.split(", ")])
    return wanted.mapInArrow(_fetched, "page_id long, record_type string, payload binary")


def archive_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes archives below the shared folder and describes every record read back from them."""
    folder = shared_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, min_bytes))
