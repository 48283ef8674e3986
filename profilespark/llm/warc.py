"""WARC archives with the index first.

Writing tasks append one compressed record per page to an archive of their own in the shared folder
and return the index: file, offset, length, URL and digest of every record. An archive's name holds
an id of the attempt that wrote it, so a task that runs again writes another file and only the one
that the index names is ever read. Reading selects rows of the index, sorts them by file and offset,
coalesces ranges that lie close into one read, and returns the records.

Of records with equal payloads of ``REVISIT_BYTES`` or more, that with the largest page_id is a
response and the others revisit it: they hold the digest and length but no payload. Payloads are
equal if SHA-1, length and a further hash are. Pages themselves are only shuffled if the table of
repeated payloads is too large for Spark to broadcast, and a payload that many pages share is then
split by Spark's skew handling.

Rows, nulls, ties: a null html is an empty payload and a response; a null url has no target URI; a
null page_id is less than any other; rows that share the largest page_id of a payload are all
responses; an empty table gives an empty result. Control characters in a URL are percent-encoded.
Only page_id, url and html are read, so other columns cannot clash.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from profilespark.llm.common import map_arrow, register, table
from profilespark.session import materialize, scratch_path

REVISIT_BYTES = 1000
#: An archive is closed and the next one begun beyond this size.
ARCHIVE_BYTES = 1 << 30
#: Ranges that lie no farther apart are read together, up to so many bytes at once.
GAP_BYTES = 64 * 1024
READ_BYTES = 8 << 20
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "file string, offset long, length long, page_id long, url string, digest string, record_type string"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _page(uri: str) -> int | None:
    number = uri.strip("<>").rpartition(":")[2]
    return None if number == "none" else int(number)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record as a compressed member of an archive."""
    block = b"" if revisit else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n%s" % (len(payload), payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _uri(page_id)), ("WARC-Date", DATE),
        ("WARC-Target-URI", None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("WARC-Profile", PROFILE if revisit else None), ("WARC-Refers-To", _uri(refers_to) if revisit else None),
        ("X-Payload-Length", str(len(payload)) if revisit else None),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None) + "\r\n"
    packer = zlib.compressobj(LEVEL, wbits=31)
    return packer.compress(head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> tuple:
    """The fields of ``RECORD`` of one compressed member."""
    head, _, rest = zlib.decompress(member, wbits=31).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    page_id, url, kind = _page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), fields["WARC-Type"]
    if kind == "revisit":
        return page_id, url, kind, _page(fields["WARC-Refers-To"]), int(fields["X-Payload-Length"]), digest, None
    payload = block.partition(b"\r\n\r\n")[2]
    found = hashlib.sha1(payload).hexdigest()
    if found != digest:
        raise ValueError(f"record of page {page_id} holds {found}, its header says {digest}")
    return page_id, url, kind, None, len(payload), found, payload


def _marked(pages: DataFrame) -> DataFrame:
    """Pages with their payload, its digest, and the page they refer to if they are revisits."""
    payload = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    key = ["digest", "n_bytes", "mix"]
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload")).select(
        "*", F.sha1("payload").alias("digest"), F.octet_length("payload").alias("n_bytes"), F.xxhash64("payload").alias("mix"))
    repeated = rows.where(F.col("n_bytes") >= REVISIT_BYTES).groupBy(*key).agg(F.max("page_id").alias("newest"), F.count("*").alias("n"))
    repeated = materialize(repeated.where("n > 1").drop("n"), "repeated-payloads")
    older = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    return rows.join(repeated, key, "left").select("page_id", "url", "payload", "digest", F.when(older, F.col("newest")).alias("refers_to"))


def write_archives(pages: DataFrame) -> DataFrame:
    """Archives of all pages in the shared folder; returns their index, a table there too."""
    folder = scratch_path(pages.sparkSession, "warc")

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        name, out = None, None
        try:
            for batch in batches:
                rows = []
                for page_id, url, payload, digest, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                    if out is None or out.tell() > ARCHIVE_BYTES:
                        if out is not None:
                            out.close()
                        name = f"{uuid.uuid4().hex}.warc.gz"
                        out = store.open_output_stream(f"{root}/{name}", compression=None)
                    revisit = refers_to is not None
                    member = record(page_id, url, payload, digest, refers_to, revisit)
                    rows.append((name, out.tell(), len(member), page_id, url, digest, "revisit" if revisit else "response"))
                    out.write(member)
                if rows:
                    columns = list(zip(*rows))
                    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_names(INDEX))
        finally:
            if out is not None:
                out.close()

    index = map_arrow(_marked(pages), written, INDEX)
    return materialize(index.withColumn("file", F.concat(F.lit(folder + "/"), F.col("file"))), "warc-index")


def _ranges(rows: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Close ranges of a file together; rows come in order of file and offset."""
    file, held = None, []
    for name, offset, length in rows:
        near = held and name == file and offset - sum(held[-1]) <= GAP_BYTES and offset + length - held[0][0] <= READ_BYTES
        if held and not near:
            yield file, held
            held = []
        file = name
        held.append((offset, length))
    if held:
        yield file, held


def read_records(index: DataFrame) -> DataFrame:
    """The records that rows of the index name."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))))
        opened: tuple[str | None, pa.NativeFile | None] = (None, None)
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        for file, members in _ranges(rows):
            if opened[0] != file:
                store, path = fs.FileSystem.from_uri(file)
                opened = (file, store.open_input_file(path))
            start = members[0][0]
            data = opened[1].read_at(sum(members[-1]) - start, start)
            found = [parse(data[offset - start:offset - start + length]) for offset, length in members]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=_names(RECORD))

    part = F.floor(F.col("offset") / READ_BYTES)
    dealt = index.select("file", "offset", "length").repartition("file", part).sortWithinPartitions("file", "offset")
    return map_arrow(dealt, read, RECORD)


@register("op8_warc", f"""
SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
       CASE WHEN strlen(html) >= {REVISIT_BYTES} AND (page_id < newest OR page_id IS NULL AND newest IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN strlen(html) >= {REVISIT_BYTES} AND (page_id < newest OR page_id IS NULL AND newest IS NOT NULL) THEN newest END AS refers_to
FROM (SELECT *, max(page_id) OVER (PARTITION BY html) AS newest FROM pages)
""")
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    return read_records(write_archives(table(spark, sf_dir, "pages"))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
