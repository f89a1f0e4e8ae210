"""Dictionary-compressed WARC archives.

Pages are written as WARC records. The records of an archive are gathered up to a bounded size, a Zstandard
dictionary is built from them, the dictionary is embedded in a skippable frame at the head of the archive, and each
record is compressed with it in a frame of its own, so that any record can be read alone by its offset.

Of records with equal payloads (by SHA-1) one is the response, the one with the largest id, and the others
revisit it without the payload. The digests are grouped by partial aggregation, and only groups of several records
are joined back, salted, so that one payload may be a third of all.

Archives are written by the tasks under names of their attempt; the index that Spark commits lists those that count, so
that a lost executor or a repeated task leaves no record out and none twice.

Defined cases: null html is an empty payload; a null id is always a response and revisited by none; rows that
repeat the largest id of a payload are all responses; a null url gives a record without a target.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reeltide.llm.scratch import Scratch, salted_lookup

#: Fixed value: the magic number of the skippable frame that holds a dictionary (WARC Zstandard specification).
DICTIONARY_FRAME = 0x184D2A5D
#: Uncompressed bytes of one archive, and of the records that its dictionary is built from.
ARCHIVE_BYTES, SAMPLE_BYTES, DICTIONARY_BYTES = 24 << 20, 2 << 20, 48 << 10
_RECORD = "<urn:x-page:{}>"


def _header(fields: list[tuple[str, str]]) -> bytes:
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"


def _plain(value: str) -> str:
    """A value that can't break its header line."""
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC record, with its closing blank lines."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = http + b"\r\n" if revisit else http + b"Content-Length: %d\r\n\r\n" % len(payload) + payload
    name = "" if page_id is None else page_id
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _RECORD.format(name)), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", _plain(url)))
    if revisit:
        fields += [("WARC-Refers-To", _RECORD.format(refers_to)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload))), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return _header(fields) + block + b"\r\n\r\n"


def train(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary from evenly spaced records of SAMPLE_BYTES or so; from their bytes themselves where they are too few to train on."""
    total = sum(map(len, records))
    step = max(1, total // SAMPLE_BYTES)
    sample = records[::step]
    try:
        if len(sample) >= 32:
            return zstandard.train_dictionary(DICTIONARY_BYTES, sample, k=512, d=8, steps=1, level=3)
    except zstandard.ZstdError:
        pass
    return zstandard.ZstdCompressionDict(b"".join(sample)[:DICTIONARY_BYTES].ljust(8, b"\n"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def _write(folder: str, date: str):
    """Writes archives below ``folder``; yields the index of their records."""

    def archive(rows: list[tuple], seq: int):
        from pyarrow.fs import FileSystem

        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{seq:04d}-{uuid.uuid4().hex}.warc.zst"
        info = b"software: reeltide\r\nformat: WARC File Format 1.1\r\n"
        first = _header([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields"), ("Content-Length", str(len(info)))]) + info + b"\r\n\r\n"
        words = train([r[1] for r in rows])
        data = words.as_bytes()
        packed = zstandard.ZstdCompressor().compress(data)
        packer = zstandard.ZstdCompressor(level=3, dict_data=words, write_checksum=True)
        frames = [struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed]
        at = len(frames[0])
        offsets, lengths = [], []
        for _, raw in [(None, first), *rows]:
            frames.append(packer.compress(raw))
            offsets.append(at)
            lengths.append(len(frames[-1]))
            at += lengths[-1]
        store, path = FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        with store.open_output_stream(f"{path}/{name}.part") as f:
            for frame in frames:
                f.write(frame)
        store.move(f"{path}/{name}.part", f"{path}/{name}")
        n = len(rows)
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([name] * n), pa.array(offsets[1:], pa.int64()), pa.array(lengths[1:], pa.int64())], ["page_id", "archive", "offset", "length"])

    def run(batches):
        held, size, seq = [], 0, 0
        for batch in batches:
            ids, urls, html, digests, refers = (batch.column(i) for i in range(5))
            for i in range(len(batch)):
                payload = html[i].as_buffer().to_pybytes() if html[i].is_valid else b""
                page, to = ids[i].as_py(), refers[i].as_py()
                raw = record(page, urls[i].as_py(), payload, base64.b32encode(bytes.fromhex(digests[i].as_py())).decode(), to, to is not None, date)
                held.append((page, raw))
                size += len(raw)
                if size >= ARCHIVE_BYTES:
                    yield archive(held, seq)
                    held, size, seq = [], 0, seq + 1
        if held:
            yield archive(held, seq)

    return run


def write_archives(pages: DataFrame, folder: str, scratch: Scratch, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_payload: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write ``pages`` as archives below ``folder``; returns their index (page_id, archive, offset, length)."""
    html = F.col(html_col).cast("string")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), html.alias("html"), F.sha1(F.coalesce(html, F.lit("")).cast("binary")).alias("digest"))
    long = rows.where(F.coalesce(F.octet_length("html"), F.lit(0)) >= least_payload)
    several = scratch.table(long.groupBy("digest").agg(F.count("*").alias("n"), F.max("id").alias("last")).where("n > 1 and last is not null").select("digest", "last"), "copies")
    marked = salted_lookup(rows, several, "digest", ["id"]).select("id", "url", "html", "digest", F.when(F.col("id") < F.col("last"), F.col("last")).alias("refers_to"))
    return scratch.table(marked.mapInArrow(_write(folder, date), "page_id long, archive string, offset long, length long"), "index")


def dictionary_of(data: memoryview) -> tuple[zstandard.ZstdCompressionDict, int]:
    """The dictionary at the head of an archive, and where the records begin."""
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_FRAME:
        raise ValueError("no dictionary frame at the head of the archive")
    words = bytes(data[8 : 8 + size])
    if words[:4] == b"\x28\xb5\x2f\xfd":
        words = zstandard.ZstdDecompressor().decompress(words)
    kind = zstandard.DICT_TYPE_FULLDICT if words[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(words, dict_type=kind), 8 + size


def parse_record(raw: bytes) -> dict:
    """A record's fields and payload; a response's digest is made from the payload and must match its header."""
    head, _, body = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    number = lambda name: int(fields[name][12:-1]) if name in fields and fields[name][12:-1] else None
    out = {"page_id": number("WARC-Record-ID") if fields["WARC-Type"] != "warcinfo" else None, "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"], "refers_to": number("WARC-Refers-To"), "payload": None, "payload_bytes": int(fields.get("X-Payload-Length", 0)), "payload_digest": fields.get("WARC-Payload-Digest", "")[5:]}
    if out["record_type"] == "response":
        payload = body[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if digest != out["payload_digest"]:
            raise ValueError(f"record {out['page_id']}: its payload doesn't match its digest")
        out |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": digest}
    return out


_READ = {"page_id": pa.int64(), "url": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "payload": pa.binary(), "payload_bytes": pa.int64(), "payload_digest": pa.string()}


def records_of(data: memoryview) -> Iterator[dict]:
    """All records of an archive but its warcinfo."""
    words, at = dictionary_of(data)
    with zstandard.ZstdDecompressor(dict_data=words).stream_reader(data[at:], read_across_frames=True) as stream:
        plain = b"".join(iter(lambda: stream.read(1 << 20), b""))
    at = 0
    while at < len(plain):
        body = plain.index(b"\r\n\r\n", at) + 4
        mark = plain.index(b"\r\nContent-Length: ", at, body) + 18
        end = body + int(plain[mark : plain.index(b"\r\n", mark)])
        found = parse_record(plain[at:end])
        if found["record_type"] != "warcinfo":
            yield found
        at = end + 4


def _read(with_payload: bool):
    def run(batches):
        for batch in batches:
            for content, archive in zip(batch.column(0), batch.column(1), strict=True):
                records = records_of(memoryview(content.as_buffer()))
                while some := list(islice(records, 500)):
                    if not with_payload:
                        some = [r | {"payload": None} for r in some]
                    yield pa.RecordBatch.from_arrays([*(pa.array([r[k] for r in some], t) for k, t in _READ.items()), pa.array([archive.as_py()] * len(some))], [*_READ, "archive"])

    return run


def read_archives(spark: SparkSession, folder: str, index: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the archives that ``index`` lists: page_id, url, record_type, refers_to, payload, payload_bytes, payload_digest."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content", F.element_at(F.split("path", "/"), -1).alias("archive"))
    schema = "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string, archive string"
    # files that a lost or repeated task has left aren't in the index
    return files.mapInArrow(_read(with_payload), schema).join(index.select("archive").distinct(), "archive", "left_semi").drop("archive")


def round_trip(pages: DataFrame, **how) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and read them back."""
    scratch = Scratch(pages.sparkSession, "warc")
    folder = scratch.folder("archives")
    index = write_archives(pages, folder, scratch, **how)
    if index.isEmpty():
        return scratch.spark.createDataFrame([], "page_id long, url string, record_type string, refers_to long, payload binary, payload_bytes long, payload_digest string")
    return read_archives(pages.sparkSession, folder, index, with_payload=False)
