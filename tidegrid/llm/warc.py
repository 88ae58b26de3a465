"""WARC archives: an index first, then coalesced byte-range reads.

Tasks write records as separate gzip members and return one index row per
record: file, offset, length, URL, digest. A reader selects index rows, sorts
them by file and offset, and fetches neighbours with one read.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import stored
from tidegrid.llm.files import NewFile, open_file
from tidegrid.session import own_root, work_dir

REVISIT_BYTES = 1000  # smaller payloads are stored each time
#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long,"
    " file string, offset long, length long"
)


def deduplicated(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest, refers_to`` for each row of ``pages``.

    The payload is the html in UTF-8, NULL as empty. ``refers_to`` is the
    largest ``page_id`` with an equal payload of at least 1000 bytes, or NULL
    where this is the row's own. Repeated rows of that page are responses all; a
    NULL ``page_id`` among equal payloads revisits the largest known one, and
    without a known one all are responses. Digests are grouped before they are
    joined, and only digests that occur more than once are joined at all, so a
    payload that many pages share is one row of the small side.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("bigint")).withColumn(
        "payload_digest", F.sha1("payload")
    )
    shared = (
        rows.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest")
        .agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1 AND _first IS NOT NULL").drop("_n")
    )
    other = F.col("page_id").isNull() | (F.col("page_id") != F.col("_first"))
    joined = rows.join(stored(shared, "shared-payloads"), "payload_digest", "left")
    return joined.withColumn("refers_to", F.when(other, F.col("_first"))).drop("_first")


def record_id(page_id: int | None, digest: str) -> str:
    name = f"{page_id}:{digest}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _line(text: str) -> str:
    """A header value must not end its line."""
    return text.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record; a revisit has the headers of its payload, but no block."""
    revisit = refers_to is not None
    block = b"" if revisit else payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", date),
    ]
    if url is not None:
        head.append(("WARC-Target-URI", _line(url)))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page", str(refers_to))]
    head += [("Content-Type", "text/html"), ("Content-Length", str(len(block)))]
    text = "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8", "surrogatepass")
    return VERSION + b"\r\n" + text + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0].encode() != VERSION:
        raise ValueError(f"no record starts here: {lines[0][:40]!r}")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    return headers, rest[: int(headers["Content-Length"])]


def write(rows: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", roll_mb: int = 256, level: int = 4) -> DataFrame:
    """Writes the records of ``rows`` (see ``deduplicated``) and returns their index.

    The archives are written when the index is computed; store it before it is
    used. Each task writes files of its own, a new one after ``roll_mb``.
    """

    def work(parts):
        task = TaskContext.get()
        stem, out = f"part-{task.partitionId() if task else 0:05d}", None
        for b in parts:
            found = {c: b.column(i).to_pylist() for i, c in enumerate(b.schema.names) if c != "payload"}
            payloads = b.column(b.schema.names.index("payload"))
            files, offsets, lengths = [], [], []
            for i in range(b.num_rows):
                out = out or NewFile(folder, stem, ".warc.gz")
                raw = record(
                    found["page_id"][i], found["url"][i], payloads[i].as_py(), found["payload_digest"][i], found["refers_to"][i], date
                )
                member = gzip.compress(raw, level, mtime=0)
                files.append(out.uri)
                offsets.append(out.write(member))
                lengths.append(len(member))
                if out.size >= roll_mb << 20:
                    out.close()
                    out = None
            kinds = ["response" if r is None else "revisit" for r in found["refers_to"]]
            yield pa.record_batch(
                [
                    pa.array(found["page_id"], pa.int64()), pa.array(found["url"], pa.string()), pa.array(found["payload_bytes"], pa.int64()),
                    pa.array(found["payload_digest"], pa.string()), pa.array(kinds, pa.string()), pa.array(found["refers_to"], pa.int64()),
                    pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()),
                ],
                names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "file", "offset", "length"],
            )
        if out:
            out.close()

    return rows.select("page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to").mapInArrow(work, INDEX)


def archive(spark: SparkSession, pages: DataFrame, folder: str, **how) -> DataFrame:
    """Writes all pages as archives below ``folder`` and returns the stored index."""
    return stored(write(deduplicated(pages), folder, **how), "warc-index")


def coalesced(index: list[tuple[str, int, int]], gap: int, most: int) -> list[tuple[str, int, int, list[tuple[int, int]]]]:
    """Sorted ``(file, offset, length)`` as reads ``(file, start, end, members)`` that bridge gaps of up to ``gap`` bytes."""
    reads: list = []
    for file, offset, length in index:
        last = reads[-1] if reads else None
        if last and last[0] == file and offset - last[2] <= gap and offset + length - last[1] <= most:
            last[2] = max(last[2], offset + length)
            last[3].append((offset, length))
        else:
            reads.append([file, offset, offset + length, [(offset, length)]])
    return [tuple(r) for r in reads]


RECORD = (
    "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, block binary"
)


def read(index: DataFrame, gap: int = 1 << 16, most: int = 8 << 20, blocks: bool = True) -> DataFrame:
    """The records that ``index`` (file, offset, length) selects.

    Its rows are range-sorted by file and offset, so one task reads neighbours,
    and each batch of them becomes few reads of at most ``most`` bytes. The
    block of a response is checked against its digest and length. Without
    ``blocks`` the payloads are checked but not returned.
    """

    def work(parts):
        handles: dict[str, object] = {}
        for b in parts:
            wanted = list(zip(*(b.column(i).to_pylist() for i in range(3)), strict=True))
            rows = []
            for file, start, end, members in coalesced(wanted, gap, most):
                if file not in handles:
                    for h in handles.values():
                        h.close()
                    handles = {file: open_file(file)}
                data = handles[file].read_at(end - start, start)
                for offset, length in members:
                    raw = zlib.decompress(data[offset - start : offset - start + length], wbits=31)
                    h, block = parse(raw)
                    digest, size = h["WARC-Payload-Digest"].removeprefix("sha1:"), int(h["X-Payload-Length"])
                    kind = h["WARC-Type"]
                    if kind == "response":
                        digest_read = hashlib.sha1(block, usedforsecurity=False).hexdigest()
                        if (digest_read, len(block)) != (digest, size):
                            raise ValueError(f"{file} at {offset}: the block is not the payload that its header names")
                    page, first = h.get("X-Page-ID"), h.get("X-Refers-To-Page")
                    rows.append(
                        (page and int(page), h.get("WARC-Target-URI"), kind, size, digest, first and int(first), block if blocks else None)
                    )
            cols = list(zip(*rows, strict=True)) if rows else [()] * 7
            types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                names=["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "block"],
            )
        for h in handles.values():
            h.close()

    order = [F.col("file"), F.col("offset")]
    chosen = index.select("file", "offset", "length").repartitionByRange(*order).sortWithinPartitions(*order)
    return chosen.mapInArrow(work, RECORD)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """All pages written to a new folder of the shared root and read back by their index."""
    own_root(spark)
    index = archive(spark, pages, work_dir(spark, "warc"))
    return read(index, blocks=False).drop("block")
