"""Dictionary-compressed WARC archives (operator 10).

Each partition becomes one ``.warc.zst`` file: a Zstandard dictionary made from
the archive's first records lies (compressed where that is shorter) in a leading
skippable frame, and every record is a frame of its own, so any record can be read
alone.  The dictionary is trained; where there are too few records to learn from, their
own bytes are the dictionary, so every archive has one.  Records with equal
payloads of some size are written once; the others revisit it.

The revisit plan (digest to page) is made by an aggregation before anything is
written, and pages meet it by a join on the digest.  Files are written under
names that depend on the partition alone, by way of a temporary name, so a task
that runs again replaces the same file with the same records.

Defined results: a null html is an empty payload; small payloads are always
responses; of equal ones the largest page_id responds; line breaks in a URL are
percent-encoded; pages with a null page_id take no part in revisiting; an empty table
makes an empty folder, which reads back as no rows; an archive that ends within a
frame is an error, never a shorter result.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raillark.llm.workspace import fresh_path, pick

LEAST_REVISIT = 1000
#: Bytes of records that the dictionary is trained on, and the dictionary's size.
SAMPLE_BYTES, DICTIONARY_BYTES = 4 << 20, 64 << 10
#: The skippable frame's magic number that the WARC-with-dictionary format uses.
MAGIC = 0x184D2A5D
LEVEL = 3


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, size: int, kind: str, refers: int | None) -> bytes:
    """One WARC/1.1 record; a revisit carries no payload but its digest and size."""
    body = payload if kind == "response" else b""
    name = f"urn:page:{'' if page_id is None else page_id}"
    target = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}", "Content-Type: text/html"]
    if target:
        head.append(f"WARC-Target-URI: {target}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and the block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record's length does not match its block")
    return fields, rest[:size]


def dictionary_of(samples: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict:
    """A dictionary trained on records, or their own bytes where there is too little to learn from."""
    try:
        return zstandard.train_dictionary(min(size, max(256, sum(map(len, samples)) // 8)), samples)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:size], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_file(store: fs.FileSystem, path: str, records: Iterator[bytes]) -> int:
    """Writes one archive; only the sample and one record are held."""
    samples, held = [], 0
    for raw in records:
        samples.append(raw)
        held += len(raw)
        if held >= SAMPLE_BYTES:
            break
    if not samples:
        raise ValueError("an archive needs a record")
    dictionary = dictionary_of(samples)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
    count = 0
    temporary = f"{path}.{uuid.uuid4().hex}.part"
    with store.open_output_stream(temporary) as out:
        body = min(dictionary.as_bytes(), zstandard.ZstdCompressor(level=LEVEL).compress(dictionary.as_bytes()), key=len)
        out.write(struct.pack("<II", MAGIC, len(body)) + body)
        for some in (samples, records):
            for raw in some:
                out.write(packer.compress(raw))
                count += 1
    store.move(temporary, path)
    return count


def read_file(source: io.RawIOBase) -> Iterator[bytes]:
    """The records of one archive, one frame after another, in bounded memory."""
    head = source.read(8)
    if len(head) < 8 or struct.unpack("<I", head[:4])[0] != MAGIC:
        raise ValueError("an archive begins with the frame of its dictionary")
    size = struct.unpack("<I", head[4:])[0]
    body = source.read(size)
    if len(body) < size:
        raise ValueError("an archive ends within its dictionary")
    if body[:4] == zstandard.FRAME_HEADER:
        body = zstandard.ZstdDecompressor().decompress(body)
    opener = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(body))
    waiting, frame, parts, begun = b"", opener.decompressobj(), [], False
    while True:
        if not waiting:
            waiting = source.read(1 << 18)
            if not waiting:
                if begun:
                    raise ValueError("an archive ends within a record")
                return
        parts.append(frame.decompress(waiting))
        waiting, begun = b"", True
        if frame.eof:
            waiting = frame.unused_data
            yield b"".join(parts)
            frame, parts, begun = opener.decompressobj(), [], False


def planned(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, refers_to of every page."""
    base = pick(pages, page_id="bigint", url="string", html="string").withColumn("payload", F.encode(F.coalesce("html", F.lit("")), "UTF-8")).drop("html")
    base = base.withColumn("payload_bytes", F.octet_length("payload").cast("bigint")).withColumn("payload_digest", F.sha1("payload"))
    large = base.where((F.col("payload_bytes") >= least) & F.col("page_id").isNotNull())
    firsts = large.groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    out = base.join(firsts, ["payload_digest", "payload_bytes"], "left")
    return out.withColumn("refers_to", F.when(F.col("first") != F.col("page_id"), F.col("first"))).drop("first")


def write_archives(pages: DataFrame, folder: str, least: int = LEAST_REVISIT) -> DataFrame:
    """Writes the archives to ``folder`` (a URI every executor reaches); returns path and n_records."""
    plan = planned(pages, least).withColumn("part", F.spark_partition_id())
    where = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    shared, at = fs.FileSystem.from_uri(where)
    shared.create_dir(at, recursive=True)  # there even if no task has a row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(where)
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        path = f"{root}/pages-{first.column(0)[0].as_py():06d}.warc.zst"

        def records() -> Iterator[bytes]:
            batch = first
            while batch is not None:
                for k in range(batch.num_rows):
                    page, url, payload, size, digest, refers = (batch.column(c)[k].as_py() for c in range(1, 7))
                    yield record(page, url, payload, digest, size, "response" if refers is None else "revisit", refers)
                batch = next(batches, None)

        count = write_file(store, path, records())
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([count], pa.int64())], ["path", "n_records"])

    return plan.select("part", "page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to").mapInArrow(run, "path string, n_records long")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row a record of the archives in ``folder``, with the payload of responses."""
    where = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(where).select("path")

    def number(name: str | None) -> int | None:
        return int(name.strip("<>").removeprefix("urn:page:")) if name and name != "<urn:page:>" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        store, _ = fs.FileSystem.from_uri(where)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                _, own = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with store.open_input_stream(own, compression=None) as source:
                    for raw in read_file(source):
                        fields, block = parsed(raw)
                        kind = fields["WARC-Type"]
                        digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
                        if kind == "response":
                            size, real = len(block), hashlib.sha1(block).hexdigest()
                            if real != digest:
                                raise ValueError(f"a payload in {path} does not match its digest")
                        rows.append((number(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), size, digest, kind, number(fields.get("WARC-Refers-To")), block if kind == "response" else None))
                        held += len(block)
                        if held > 1 << 22:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return files.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def op10_warc_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives the whole of ``pages`` and reads the archives back."""
    folder = fresh_path(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder).agg(F.sum("n_records")).collect()
    return read_archives(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
