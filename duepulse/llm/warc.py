"""Web archives: written from pages, normalised to one gzip member a record, read by offset.

Spark's text writer writes an archive as one gzip stream from end to end, in which no record can
be found without inflating all before it. The normaliser inflates such a stream once, some bytes
at a time, writes every record as a gzip member of its own, and beside the archive a sidecar with
the offset and length of each member. Readers then take any range of members by itself.

Archives are files, so tasks open them by pyarrow's file systems, from the URI of the folder (a
local or mounted path, hdfs, s3, gs). A task writes under a name of its own and moves the files
once they are whole, the sidecar last; the same archive gives the same bytes. So a task that is
lost or runs twice leaves nothing half-written under a final name.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables

#: Records of an archive, at most: Spark's reader holds a whole compressed archive in a task.
RECORDS = 10_000
#: Compressed bytes that are inflated at once, and bytes of members that one reader takes.
CHUNK = 1 << 16
RANGE = 4 << 20
#: Bytes of members that a task is meant to read, where the session's shuffles have fewer tasks.
TASK_BYTES = 64 << 20
#: Responses of repeated payloads are broadcast up to this many; with more, the join shuffles.
MOST_BROADCAST = 500_000
#: End of a header, and what follows a record's block.
_BREAK = b"\r\n\r\n"
_GZIP = 31
_SIDECAR = ".offsets"
#: Record ids are this, then the page's id.
_PAGE = "urn:page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a text's UTF-8 bytes in upper-case base32: five bytes are eight digits."""
    digest = F.sha1(payload)
    digits = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _BASE32)


def decided(pages: DataFrame, least_bytes: int = 0, scratch: tables.Scratch | None = None) -> DataFrame:
    """page_id, url, payload, digest, size, record_type and refers_to for every page.

    Of pages with equal payloads of ``least_bytes`` or more, the one with the largest page_id is
    the response, and the others revisit it. A page never revisits its own id: rows that repeat the
    response's id and payload are responses, too. Null ids are the smallest; among themselves
    they are all responses. Null html: an empty payload. The result reads a table in the scratch
    folder, or one of its own.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("size"), F.sha2("payload", 256).alias("same"))
    groups = rows.where(F.col("size") >= least_bytes).groupBy(F.col("same").alias("of")).agg(
        F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("n")
    )
    repeated = groups.where("n > 1 and largest is not null").select("of", "largest")
    repeated = scratch.stored(repeated) if scratch else tables.stored(repeated)
    few = repeated.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
    joined = rows.join(F.broadcast(repeated) if few else repeated, F.col("same") == F.col("of"), "left")
    revisit = F.col("largest").isNotNull() & ~F.col("largest").eqNullSafe(F.col("page_id"))
    return joined.select(
        "page_id", "url", "payload", base32_sha1(F.col("payload")).alias("digest"), "size",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("largest")).alias("refers_to"),
    )


def _record(date: str) -> Column:
    """The WARC record of a row of :func:`decided`, without its last line feed."""
    name = lambda c: F.concat(F.lit(f"<{_PAGE}"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    line = lambda key, value: F.concat(F.lit(f"{key}: "), value, F.lit("\r\n"))
    revisit = F.col("record_type") == "revisit"
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    block = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"),
        F.lit("\r\n\r\n"), F.when(revisit, "").otherwise(F.col("payload")),
    )
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", name("page_id")),
        line("WARC-Date", F.lit(date)),
        F.when(F.col("url").isNull(), "").otherwise(line("WARC-Target-URI", url)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", name("refers_to")), line("WARC-Profile", F.lit(_PROFILE)))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"), block, F.lit("\r\n\r"),
    )


def write_archives(pages: DataFrame, folder: str, *, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", records: int = RECORDS) -> None:
    """Writes a record for every page to archives in ``folder``, each one gzip stream."""
    scratch = tables.Scratch(pages.sparkSession)
    told = decided(pages, least_bytes, scratch).select(_record(date).alias("value"))
    told.write.option("compression", "gzip").option("lineSep", "\n").option("maxRecordsPerFile", records).text(folder)
    scratch.remove()


class _Members:
    """Writes records, given in pieces, as gzip members to a file; tells each one's place."""

    def __init__(self, out: BinaryIO) -> None:
        self.out, self.offset, self.start, self.packer = out, 0, 0, None

    def add(self, piece: bytes | memoryview) -> None:
        if self.packer is None:
            self.packer = zlib.compressobj(wbits=_GZIP)
        self._write(self.packer.compress(piece))

    def end(self) -> tuple[int, int]:
        """Offset and length of the member that ends here."""
        self._write(self.packer.flush())
        place = self.start, self.offset - self.start
        self.packer, self.start = None, self.offset
        return place

    def _write(self, packed: bytes) -> None:
        self.out.write(packed)
        self.offset += len(packed)


def _inflated(packed: bytes) -> Iterator[bytes]:
    """What a gzip file of one or more members holds, in pieces of bounded size."""
    left = memoryview(packed)
    while len(left):
        stream = zlib.decompressobj(_GZIP)
        while not stream.eof:
            if not len(left):
                raise ValueError("the archive ends within a gzip stream")
            fed, left = left[:CHUNK], left[CHUNK:]
            while True:
                piece = stream.decompress(fed, 16 * CHUNK)
                yield piece
                fed = stream.unconsumed_tail
                if not fed and len(piece) < 16 * CHUNK:
                    break
            if stream.eof:
                left = memoryview(packed)[len(packed) - len(left) - len(stream.unused_data) :]


def fields(head: bytes) -> dict[str, str]:
    """A record's header fields by lower-case name, and its version under an empty one."""
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    pairs = (line.split(":", 1) for line in lines if ":" in line)
    return {"": version, **{k.strip().lower(): v.strip() for k, v in pairs}}


def split_records(pieces: Iterator[bytes], members: _Members) -> Iterator[tuple[int, int, str, str]]:
    """Writes each record of an inflated archive as a member: offset, length, type and id of each."""
    held, left, told = bytearray(), 0, None
    for piece in pieces:
        held += piece
        while held:
            if told is None:
                end = held.find(_BREAK)
                if end < 0:
                    break
                told = fields(bytes(held[:end]))
                left = end + len(_BREAK) + int(told["content-length"]) + len(_BREAK)
            taken = min(left, len(held))
            members.add(bytes(held[:taken]))
            del held[:taken]
            left -= taken
            if not left:
                yield *members.end(), told.get("warc-type", ""), told.get("warc-record-id", "")
                told = None
    if told is not None or held.strip():
        raise ValueError("the archive ends within a record")


def normalise(spark: SparkSession, source: str, folder: str) -> DataFrame:
    """Rewrites every archive below ``source`` to ``folder``, one gzip member a record, with a sidecar.

    Returns a row for each: archive (its path), records, bytes. The sidecar, the archive's name with
    ``.offsets``, has a line for each record: offset, length, type and id, between tabs. Sources
    may hold one gzip stream or several; one that ends early or holds something else stops the
    job. No archives give no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                stem = path.rsplit("/", 1)[-1].split(".")[0]
                final = f"{base}/{stem}-{zlib.crc32(path.encode()):08x}.warc.gz"
                own = f"{base}/.{uuid.uuid4().hex}"
                with store.open_output_stream(own) as out, store.open_output_stream(f"{own}{_SIDECAR}") as sidecar:
                    members, count = _Members(out), 0
                    for place in split_records(_inflated(content.as_buffer()), members):
                        sidecar.write(("\t".join(map(str, place)) + "\n").encode())
                        count += 1
                store.move(own, final)
                store.move(f"{own}{_SIDECAR}", f"{final}{_SIDECAR}")
                yield pa.RecordBatch.from_pydict({"archive": [final], "records": [count], "bytes": [members.offset]})

    archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true").load(source)
    return archives.select("path", "content").mapInArrow(run, "archive string, records long, bytes long")


def sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """archive, offset, length, record_type and record_id of every record in normalised archives."""
    lines = spark.read.option("pathGlobFilter", f"*{_SIDECAR}").schema("value string").text(folder)
    part = lambda i: F.split_part("value", F.lit("\t"), F.lit(i))
    name = F.split_part(F.col("_metadata.file_name"), F.lit(_SIDECAR), F.lit(1))
    return lines.select(
        name.alias("archive"), part(1).cast("long").alias("offset"), part(2).cast("long").alias("length"),
        part(3).alias("record_type"), part(4).alias("record_id"),
    )


def parsed(record: bytes) -> tuple[str, str, str | None, int, str, bytes]:
    """Type, id, referred id, bytes and digest of the full payload, and the payload that is stored.

    A response's bytes and digest come from its payload, a revisit's from its headers.
    """
    head, _, rest = record.partition(_BREAK)
    told = fields(head)
    block = rest[: int(told["content-length"])]
    http, _, payload = block.partition(_BREAK)
    digest = told.get("warc-payload-digest", "").removeprefix("sha1:")
    if told["warc-type"] == "revisit":
        sizes = [line.split(b":")[1] for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:")]
        return "revisit", told["warc-record-id"], told.get("warc-refers-to"), int(sizes[0]), digest, payload
    found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if digest and digest != found:
        raise ValueError(f"the payload of {told['warc-record-id']} doesn't have its digest")
    return told["warc-type"], told["warc-record-id"], told.get("warc-refers-to"), len(payload), found, payload


def page_of(record_id: str | None) -> int | None:
    """The page's id in a record's id; none for a page without one."""
    digits = (record_id or "").strip("<>").removeprefix(_PAGE)
    return int(digits) if digits else None


def read_archives(spark: SparkSession, folder: str, *, with_payload: bool = False) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record in ``folder``.

    ``folder`` has normalised archives. The sidecars' offsets part each archive into ranges of
    members, which tasks read by themselves. With ``with_payload`` a column payload follows:
    the bytes stored in the record, empty for a revisit.
    """
    entries = sidecars(spark, folder)
    part = F.floor(F.col("offset") / RANGE)
    # At most RANGE bytes of members begin in a range.
    ranges = entries.groupBy("archive", part.alias("part")).agg(F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("members"))
    # By their own size the ranges' rows would all go to one task.
    total = entries.agg(F.sum("length")).first()[0] or 0
    ranges = ranges.repartition(max(tables.shuffle_width(entries), -(-total // TASK_BYTES)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for archive, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                with store.open_input_file(f"{base}/{archive}") as file:
                    for member in members:
                        file.seek(member["offset"])
                        kind, name, refers, size, digest, payload = parsed(zlib.decompress(file.read(member["length"]), _GZIP))
                        rows.append((page_of(name), size, digest, kind, page_of(refers), payload if with_payload else None))
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
    read = ranges.select("archive", "members").mapInArrow(run, schema)
    return read if with_payload else read.drop("payload")


def through_archives(pages: DataFrame, *, least_bytes: int = 0) -> DataFrame:
    """Writes the pages to archives, normalises them and returns what :func:`read_archives` reads.

    The archives are in a scratch folder that goes. Extra columns are ignored; no rows give no rows.
    """
    spark = pages.sparkSession
    scratch = tables.Scratch(spark)
    raw, folder = f"{scratch.folder}/raw", f"{scratch.folder}/archives"
    write_archives(pages, raw, least_bytes=least_bytes)
    written = scratch.stored(normalise(spark, raw, folder))
    if written.isEmpty():
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    return scratch.settled(read_archives(spark, folder))
