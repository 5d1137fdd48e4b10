"""WARC archives: an index first, then coalesced byte-range reads.

``write_archives`` streams rows into gzip-per-record WARC files in a folder
that all executors share (any ``pyarrow.fs`` URI) and returns the index: file,
offset, length, URL, digest and type of each record.  The index is written as
a table before anything reads it, so a retried task (whose file has another
name) can leave an orphan file but never a wrong index row.
``read_records`` sorts the selected index rows by file and offset, merges near
ranges into one read, and parses the records.

Defined cases: a null payload is empty; a null URL has an empty target; equal
payloads keep the record with the largest id as response, and rows that repeat
that id and payload are responses too; where all ids of a payload are null,
all are responses; an empty table gives an empty index and no file.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridflux.llm.common import shared_dir, stage

DATE = "2026-01-01T00:00:00Z"
#: Bits of the map of repeated digests.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "page_id long, url string, digest string, record_type string, refers_to long, file string, offset long, length long"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def map_bits(repeated: int) -> int:
    """Bits of the map: some thirty for each repeated digest, so that few others hit it; at
    most those of 50 MB of rows."""
    return min(MOST_BITS, max(LEAST_BITS, 1 << (32 * max(repeated, 1) - 1).bit_length()))


def mark_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, sha1, record_type, refers_to) of each page; other columns of
    ``pages`` are left out.

    Digests that occur more than once are found on narrow rows and written.  Their
    hashes set bits of a map of bounded size, which is broadcast; only payloads
    whose bit is set join the digests (Spark broadcasts these while they are few),
    so the others, which surely occur once, are never shuffled."""
    keyed = pages.select("page_id", "url", "html").withColumn("payload", F.encode(F.coalesce("html", F.lit("")), "UTF-8"))
    keyed = keyed.withColumn("sha1", F.sha1("payload"))
    repeated = (
        keyed.where(F.length("payload") >= min_bytes)
        .groupBy("sha1")
        .agg(F.max("page_id").alias("keep"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("sha1", "keep")
    )
    repeated = stage(repeated, "warc-repeats")
    bits = map_bits(repeated.count())
    slot = F.pmod(F.xxhash64("sha1"), F.lit(bits))
    word, bit = F.floor(slot / 64).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))
    words = repeated.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))  # MOST_BITS / 64 rows at most
    looked = keyed.withColumns({"word": word, "bit": bit}).join(F.broadcast(words), "word", "left")
    set_ = F.coalesce(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.lit(False))
    alone = looked.where(~set_).withColumn("keep", F.lit(None).cast("long"))
    marked = looked.where(set_).join(repeated, "sha1", "left").unionByName(alone)
    old = F.col("keep").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keep"))
    return marked.select(
        "page_id", "url", "payload", "sha1",
        F.when(old, "revisit").otherwise("response").alias("record_type"),
        F.when(old, F.col("keep")).alias("refers_to"),
    )


def _header(text: str | None) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in text or "")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {_header(url)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes, level: int) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def write_archives(marked: DataFrame, folder: str, level: int = 2) -> DataFrame:
    """Write the rows of ``mark_revisits`` and return their index (staged)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        name, out, at = f"{uuid.uuid4().hex}.warc.gz", None, 0
        schema = None
        for batch in batches:
            if out is None and batch.num_rows:
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
            offsets, lengths, digests = [], [], []
            columns = [batch.column(i) for i in range(5)]
            for row in zip(*columns, strict=True):
                page_id, url, payload, kind, refers_to = (x.as_py() for x in row)
                digests.append(base32_sha1(payload))
                member = _gzip(record_bytes(page_id, url, payload, kind, refers_to), level)
                out.write(member)
                offsets.append(at)
                lengths.append(len(member))
                at += len(member)
            schema = [
                columns[0], columns[1], pa.array(digests, pa.string()), columns[3], columns[4],
                pa.array([name] * batch.num_rows, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(schema, names=["page_id", "url", "digest", "record_type", "refers_to", "file", "offset", "length"])
        if out is not None:
            out.close()

    rows = marked.select("page_id", "url", "payload", "record_type", "refers_to")
    return stage(rows.mapInArrow(write, INDEX), "warc-index")


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and payload of one gzip member."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[: int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def ranges(offsets: list[int], lengths: list[int], gap: int, most: int) -> Iterator[tuple[int, int]]:
    """Slices [i, j) of sorted records that one read covers."""
    i = 0
    while i < len(offsets):
        j, end = i + 1, offsets[i] + lengths[i]
        while j < len(offsets) and offsets[j] - end <= gap and offsets[j] + lengths[j] - offsets[i] <= most:
            end = max(end, offsets[j] + lengths[j])
            j += 1
        yield i, j
        i = j


def read_records(index: DataFrame, folder: str, gap: int = 1 << 16, most: int = 8 << 20) -> DataFrame:
    """Records of the selected ``index`` rows, read back from the archives.

    Rows are dealt by file and 32 MB block and sorted by offset inside, so a
    task reads forward; ``gap`` bytes between records are read rather than
    skipped, and no read exceeds ``most`` bytes (but for one larger record).
    """

    def ident(text: str) -> int | None:
        n = text.removeprefix("<urn:page:").removesuffix(">")
        return int(n) if n else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        name, source = None, None
        for batch in batches:
            files, offs, lens = (batch.column(i).to_pylist() for i in range(3))
            rows, i = [], 0
            while i < len(files):
                j = i
                while j < len(files) and files[j] == files[i]:
                    j += 1
                if files[i] != name:
                    if source is not None:
                        source.close()
                    name, source = files[i], fs.open_input_file(f"{root}/{files[i]}")
                for a, b in ranges(offs[i:j], lens[i:j], gap, most):
                    a, b = a + i, b + i
                    first = offs[a]
                    data = source.read_at(max(offs[k] + lens[k] for k in range(a, b)) - first, first)
                    for k in range(a, b):
                        fields, payload = parse_record(data[offs[k] - first : offs[k] - first + lens[k]])
                        kind = fields["warc-type"]
                        full = kind == "response"
                        digest = base32_sha1(payload) if full else fields["warc-payload-digest"].partition(":")[2]
                        if full and f"sha1:{digest}" != fields["warc-payload-digest"]:
                            raise ValueError(f"record at {offs[k]} of {name} is damaged")
                        rows.append((
                            ident(fields["warc-record-id"]), fields["warc-target-uri"], kind,
                            None if full else ident(fields["warc-refers-to"]), digest, len(payload) if full else None,
                        ))
                i = j
            names = [x.split()[0] for x in RECORD.split(", ")]
            types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            cols = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)
        if source is not None:
            source.close()

    block = (F.col("offset") / (32 << 20)).cast("long")
    dealt = index.select("file", "offset", "length", block.alias("block"))
    dealt = dealt.repartition("file", "block").sortWithinPartitions("file", "offset").drop("block")
    return dealt.mapInArrow(read, RECORD)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Revisits take the payload size of the response that they refer to."""
    responses = records.where("record_type = 'response'")
    revisits = records.where("record_type = 'revisit'").drop("payload_bytes")
    target = responses.select(
        F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes"
    ).dropDuplicates(["refers_to", "payload_digest"])
    return responses.unionByName(revisits.join(target, ["refers_to", "payload_digest"], "left"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    folder = f"{shared_dir(spark)}/gridflux/warc-{uuid.uuid4().hex}"
    index = write_archives(mark_revisits(pages), folder)
    records = stage(read_records(index, folder), "warc-records")
    return resolve_revisits(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP10_SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
w AS (SELECT page_id, body, hex, max(page_id) OVER (PARTITION BY hex) AS keep FROM p)
SELECT page_id,
       CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                CAST(((CAST(('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS BIGINT), 5)) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1 AS BIGINT), 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keep THEN keep END AS refers_to
FROM w
"""
