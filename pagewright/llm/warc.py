"""WARC archives whose records are compressed one by one with a Zstandard dictionary of their own archive.

Each archive starts with a skippable frame that holds a dictionary built from its records; every record is a
frame of its own, so that it can be read alone.  Of records with equal payloads, that with the largest page_id
is a response and the others are revisits that refer to it.

A null html is an empty payload.  Rows repeated with the same page_id and payload are all what that page_id is.
A null page_id counts as smaller than any other and comes back as null.  An empty table writes no archive and
gives an empty result.  Other columns aren't read.  A task that is run again writes files of new names: only
those in the manifest of tasks that ended well are read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import stored, work_folder

#: Fixed values of the formats.
SKIPPABLE = (0x184D2A5D).to_bytes(4, "little")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The crawl's time, written in every record.
DATE = "2024-01-01T00:00:00Z"

SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record(page_id, url, payload: bytes, refers_to, first: bool) -> bytes:
    """A record in full; first: it is a response."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + payload if first else http
    target = "".join(c for c in url or "" if c > " ")
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if first else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}", f"X-Payload-Length: {len(payload)}", f"X-Page-Id: {'' if page_id is None else page_id}",
    ]
    if not first:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + body + b"\r\n\r\n"


def dictionary(records: list[bytes], size: int, most_sample: int) -> zstandard.ZstdCompressionDict:
    """Trained on records evenly spread over the archive; the samples' own end where they are too few to train on."""
    every = max(1, sum(map(len, records)) // most_sample)
    samples = [r[:131_072] for r in records[::every]]
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, samples)) // 8)), samples, k=512, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-size:] or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def archive(records: list[bytes], level: int, dictionary_bytes: int, most_sample: int):
    """The archive's bytes, frame by frame."""
    trained = dictionary(records, dictionary_bytes, most_sample)
    yield SKIPPABLE + len(trained.as_bytes()).to_bytes(4, "little") + trained.as_bytes()
    trained.precompute_compress(level=level)
    packer = zstandard.ZstdCompressor(level=level, dict_data=trained, write_checksum=True, write_content_size=True)
    for r in records:
        yield packer.compress(r)


def frames(file, portion: int = 1 << 16):
    """The records of an archive, one at a time."""
    head = file.read(8)
    if head[:4] != SKIPPABLE:
        raise ValueError("an archive must start with the frame that holds its dictionary")
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(file.read(int.from_bytes(head[4:], "little"))))
    rest, out, frame = b"", [], unpacker.decompressobj()
    while data := rest or file.read(portion):
        out.append(frame.decompress(data))
        rest = frame.unused_data
        if frame.eof:
            yield b"".join(out)
            out, frame = [], unpacker.decompressobj()
    if any(out):
        raise ValueError("the archive's last record is cut off")


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a record, checked against its length."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    body = rest[: int(headers["Content-Length"])]
    if lines[0] != "WARC/1.1" or rest[len(body) :] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    return headers, body.partition(b"\r\n\r\n")[2]


def planned(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, first and refers_to: which records are responses, which revisit what.

    Only payloads found more than once are kept apart; that table is small beside the pages, or joined by key.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("key", F.when(F.length("payload") >= least_bytes, F.concat(F.sha2("payload", 256), F.length("payload").cast("string"))))
    often = rows.where(F.col("key").isNotNull()).groupBy(F.col("key").alias("often")).agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1").select("often", "last")
    joined = rows.join(stored(often, "repeated-payloads"), F.col("key") == F.col("often"), "left")
    first = F.col("often").isNull() | F.col("page_id").eqNullSafe(F.col("last"))
    return joined.select("page_id", "url", "payload", first.alias("first"), F.when(~first, F.col("last")).alias("refers_to"))


def written(rows: DataFrame, folder: str, archive_bytes: int = 12_000_000, level: int = 3, dictionary_bytes: int = 65_536, most_sample: int = 1_500_000) -> DataFrame:
    """Write archives of about archive_bytes before compression; a manifest row (path, n_records, n_bytes) for each."""

    def write(batches):
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)

        def close(records):
            path, size = f"{base}/{uuid.uuid4().hex}.warc.zst", 0
            with store.open_output_stream(path) as file:
                for part in archive(records, level, dictionary_bytes, most_sample):
                    file.write(part)
                    size += len(part)
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(records)]), pa.array([size])], ["path", "n_records", "n_bytes"])

        records, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to", "first"))):
                page_id, url, payload, refers_to, first = (x.as_py() for x in row)
                records.append(record(page_id, url, payload, refers_to, first))
                size += len(records[-1])
                if size >= archive_bytes:
                    yield close(records)
                    records, size = [], 0
        if records:
            yield close(records)

    return stored(rows.mapInArrow(write, "path string, n_records long, n_bytes long"), "warc-manifest")


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of all archives of a manifest; payloads of responses are checked against their digests."""

    def load(batches):
        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                with store.open_input_stream(path) as file:
                    for data in frames(file):
                        h, payload = parsed(data)
                        size, kind = int(h["X-Payload-Length"]), h["WARC-Type"]
                        name = h["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response" and (len(payload) != size or digest(payload) != name):
                            raise ValueError(f"payload of {h['WARC-Record-ID']} differs from its digest")
                        refers = h.get("X-Refers-To-Page-Id")
                        rows.append((int(h["X-Page-Id"]) if h["X-Page-Id"] else None, size, name, kind, int(refers) if refers else None))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    # a number of its own keeps small manifests in as many tasks as there are archives
    tasks = min(max(1, manifest.count()), 20_000)
    return manifest.select("path").repartition(tasks, "path").mapInArrow(load, SCHEMA)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as archives in the shared folder and read them back."""
    folder = work_folder(pages.sparkSession, "warc")
    return read(written(planned(pages), folder), folder)
