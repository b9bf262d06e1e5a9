"""WARC archives of Zstandard frames with an embedded dictionary.

``write_warc`` gives every page a WARC/1.1 record, compressed alone into a frame with a dictionary
that was built from records of the archive. Every file begins with the dictionary in a
skippable frame (the public layout of ``.warc.zst`` files), so a file can be read without the others.
Of pages with equal payloads of at least ``least_bytes`` bytes, that with the smallest page_id is a
response record; the others are revisit records, without payload, that refer to it.

Tasks write through Spark's own text writer, which commits a task's file once and reaches every
file system that Spark does: a frame is a line, and the line end is an empty skippable frame, so
the file is a plain sequence of frames for any Zstandard reader. A frame never holds these bytes
itself. ``read_warc`` reads such lines, so a record is a row and large files are split. (The files
keep the writer's names; with the ending ``.zst`` Spark would decompress them itself.)

A payload's first page comes from an aggregate by digest, joined back. Digests with over a thousandth of
all copies are at most a thousand rows and are broadcast; payloads that are no copies, or whose
copies are so labelled, meet nothing and are spread evenly should that join shuffle. A page
known as a revisit by then leaves its payload behind.

Rows: a null payload is an empty one; a null url has no target header, control characters in one are
percent-encoded; a null page_id stays null, comes last among copies and is never referred to;
rows that repeat the smallest page_id of a payload are responses each; payloads of any length are whole; an
empty table gives an archive without records; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm.common import written
from tallyward.session import fresh_dir

#: About how many records the dictionary is built from, and the longest payload among them.
SAMPLE_RECORDS = 1024
SAMPLE_BYTES = 16 << 10
DICTIONARY_BYTES = 32 << 10
#: Dictionaries that a reader holds; archives of more writers are read in parts.
MOST_DICTIONARIES = 256
LEVEL = 3

#: Copies that make a payload hot, as a share of all copies.
HOT_SHARE = 1000

# Magic numbers of the Zstandard format and the dictionary's frame, record fields of WARC/1.1.
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
LINE_END = b"\x50\x2a\x4d\x18\x00\x00\x00\x00"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_DATE = "2024-01-01T00:00:00Z"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")
_READ = "page_id long, url string, record_type string, record_id string, refers_to_id string, refers_to long, payload_bytes long, payload_digest string"
_BATCH_BYTES = 8 << 20


def response_id(digest: str) -> str:
    """The record id of the response with a payload: what its revisits refer to."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, 'sha256:' + digest)}>"


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", len(block))] if v is not None]
    return b"".join([b"WARC/1.1\r\n", "".join(lines).encode(), b"\r\n", block, b"\r\n\r\n"])


def page_record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None, shared: bool, date: str = _DATE) -> bytes:
    """The record of a page: a response with its payload, or (with ``refers_to``) a revisit
    without. ``shared``: the payload is long enough to be referred to."""
    revisit = refers_to is not None
    own = response_id(digest) if shared and not revisit else f"<urn:uuid:{uuid.uuid4()}>"
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", own),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", response_id(digest) if revisit else None),
        ("Page-ID", page_id),
        ("Refers-To-Page-ID", refers_to),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    return _record(fields, http if revisit else http + payload)


def _info(date: str) -> bytes:
    fields = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")]
    return _record(fields, b"format: WARC File Format 1.1\r\n")


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    n = int(fields["Content-Length"])
    if not lines[0].startswith("WARC/1.") or rest[n:] != b"\r\n\r\n":
        raise ValueError("no whole WARC record")
    return fields, rest[:n]


def read_page(data: bytes) -> tuple | None:
    """The columns of ``read_warc`` and the payload of a record; None for other kinds."""
    fields, block = parse_record(data)
    kind = fields["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']}: the payload is not that of its digest")
    number = lambda name: int(fields[name]) if name in fields else None
    own = (number("Page-ID"), fields.get("WARC-Target-URI"), kind, fields["WARC-Record-ID"])
    return *own, fields.get("WARC-Refers-To"), number("Refers-To-Page-ID"), size, digest, payload if kind == "response" else None


# --- frames ---------------------------------------------------------------------


def build_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of sample records; empty where they are too few for one."""
    try:
        return zstandard.train_dictionary(size, records).as_bytes()
    except zstandard.ZstdError:
        return b""


def dictionary_frame(dictionary: bytes) -> bytes:
    body = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return DICTIONARY_MAGIC + struct.pack("<I", len(body)) + body


def dictionary_of(frame: bytes) -> bytes:
    body = frame[8 : 8 + struct.unpack("<I", frame[4:8])[0]]
    return zstandard.ZstdDecompressor().decompress(body) if body.startswith(FRAME_MAGIC) else body


class Frames:
    """Compresses records, each alone, into frames without the line end's bytes."""

    def __init__(self, dictionary: bytes, level: int = LEVEL):
        self.dictionary = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.level = level
        self._made: dict[int, zstandard.ZstdCompressor] = {}

    def _compressor(self, level: int) -> zstandard.ZstdCompressor:
        if level not in self._made:
            self._made[level] = zstandard.ZstdCompressor(level=level, dict_data=self.dictionary, write_checksum=True)
        return self._made[level]

    def frame(self, record: bytes) -> bytes:
        out = self._compressor(self.level).compress(record)
        level = 1
        while LINE_END in out and level <= 19:
            # bytes of a record that stand in the frame as they are: a new block in their middle
            parts = record.split(LINE_END)
            half = len(LINE_END) // 2
            cut = [(LINE_END[half:] if i else b"") + part + (LINE_END[:half] if i < len(parts) - 1 else b"") for i, part in enumerate(parts)]
            writer = self._compressor(level).compressobj(size=len(record))
            out = b"".join([writer.compress(x) + writer.flush(zstandard.COMPRESSOBJ_FLUSH_BLOCK) for x in cut]) + writer.flush()
            level += 1
        if LINE_END in out:
            raise ValueError("a record can't be compressed without the line end")
        return out


def records_of(frame: bytes, readers: dict[int, zstandard.ZstdDecompressor]) -> bytes:
    params = zstandard.get_frame_parameters(frame)
    if params.dict_id not in readers:
        raise ValueError(f"dictionary {params.dict_id} is not in the archive")
    return readers[params.dict_id].decompress(frame)


# --- archives ---------------------------------------------------------------------


def _pages(pages: DataFrame, id_column: str, url_column: str, payload_column: str) -> DataFrame:
    payload = F.coalesce(F.col(payload_column).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).cast("string").alias("url"), payload.alias("payload"))
    return rows.select("*", F.octet_length("payload").cast("long").alias("size"), F.sha2("payload", 256).alias("digest"))


def with_first(rows: DataFrame, least_bytes: int) -> DataFrame:
    """``rows`` with ``refers_to``: the smallest page_id of their payload where it is another
    page's, else null; revisits have no payload."""
    shared = F.col("size") >= least_bytes
    groups = rows.where(shared).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
    groups = written(groups.where("copies > 1 and first is not null"), "copies")
    copies = groups.agg(F.sum("copies")).first()[0] or 0
    is_hot = F.col("copies") * HOT_SHARE > copies  # at most HOT_SHARE payloads have so many
    hot = groups.where(is_hot).select("digest", F.col("first").alias("hot_first"))
    rows = rows.join(F.broadcast(hot), "digest", "left")
    revisit = F.col("hot_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("hot_first"))
    rows = rows.withColumn("payload", F.when(~revisit, F.col("payload")))
    meets = shared & F.col("hot_first").isNull()
    rows = rows.withColumn("meeting", F.when(meets, F.col("digest")).otherwise(F.concat(F.lit("-"), F.monotonically_increasing_id())))
    cold = groups.where(~is_hot).select(F.col("digest").alias("meeting"), F.col("first").alias("cold_first"))
    rows = rows.join(cold, "meeting", "left").withColumn("first", F.coalesce("hot_first", "cold_first"))
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    rows = rows.withColumn("refers_to", refers)
    return rows.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "size", "digest", "refers_to")


def sample_dictionary(rows: DataFrame, least_bytes: int, date: str) -> bytes:
    """A dictionary from about SAMPLE_RECORDS records, at most twice as many (32 MB), whose payloads have
    at most SAMPLE_BYTES bytes: the payloads whose digest is under a share of all digests that
    follows from the number of rows. A payload counts once, and where most are copies the share grows."""
    n = max(1, rows.count())
    share = SAMPLE_RECORDS / n
    while True:
        # the first 13 hexadecimal digits of a digest as a number under 1
        under = F.conv(F.substring("digest", 1, 13), 16, 10).cast("double") / float(16**13) < share
        short = rows.where((F.col("size") <= SAMPLE_BYTES) & under)
        one = short.groupBy("digest").agg(F.first(F.struct("page_id", "url", "payload", "size")).alias("page"))
        found = [r["page"] for r in one.limit(2 * SAMPLE_RECORDS).collect()]
        if len(found) >= SAMPLE_RECORDS // 8 or share >= 1:
            break
        share *= 8
    made = [(p["page_id"], p["url"], bytes(p["payload"]), p["size"]) for p in found]
    return build_dictionary([page_record(*page, hashlib.sha256(page[2]).hexdigest(), None, page[3] >= least_bytes, date) for page in sorted(made, key=str)])


def write_warc(pages: DataFrame, path: str, least_bytes: int = 100, date: str = _DATE, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html") -> None:
    """Write a record per page to the files of a new folder."""
    rows = _pages(pages, id_column, url_column, payload_column)
    dictionary = sample_dictionary(rows, least_bytes, date)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames = Frames(dictionary)
        out: list[bytes] = []
        for batch in batches:
            if not out and batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([dictionary_frame(dictionary), frames.frame(_info(date))], pa.binary())], names=["frame"])
            out, held = [b""], 0  # no longer the file's beginning
            for i in range(batch.num_rows):
                page_id, url, payload, size, digest, refers_to = (c[i].as_py() for c in batch.columns)
                out.append(frames.frame(page_record(page_id, url, payload or b"", size, digest, refers_to, size >= least_bytes, date)))
                held += len(out[-1])
                if held > _BATCH_BYTES or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([pa.array(out[1:], pa.binary())], names=["frame"])
                    out, held = [b""], 0

    lines = with_first(rows, least_bytes).mapInArrow(write, "frame binary").select(F.col("frame").cast("string").alias("value"))
    lines.write.option("lineSep", LINE_END.decode()).option("maxRecordsPerFile", 0).text(path)


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """(page_id, url, record_type, record_id, refers_to_id, refers_to, payload_bytes,
    payload_digest) of every page's record, and with ``payloads`` its payload (null for revisits). Size
    and digest are those of the full payload; a response's are checked against its bytes."""
    lines = spark.read.option("lineSep", LINE_END.decode()).text(path).select(F.col("value").cast("binary").alias("frame"))
    found = lines.where(F.substring("frame", 1, 4) == F.lit(DICTIONARY_MAGIC)).distinct().limit(MOST_DICTIONARIES + 1).collect()
    if len(found) > MOST_DICTIONARIES:
        raise ValueError(f"{path} has more than {MOST_DICTIONARIES} dictionaries: read its files in parts")
    dictionaries = [d for d in (dictionary_of(bytes(r["frame"])) for r in found) if d]
    schema = _READ + (", payload binary" if payloads else "")
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [pa.field(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = [zstandard.ZstdCompressionDict(d) for d in dictionaries]
        readers = {d.dict_id(): zstandard.ZstdDecompressor(dict_data=d) for d in made} | {0: zstandard.ZstdDecompressor()}
        for batch in batches:
            rows, held = [], 0
            for i in range(batch.num_rows):
                frame = batch.column(0)[i].as_py()
                row = read_page(records_of(frame, readers)) if frame.startswith(FRAME_MAGIC) else None
                if row:
                    rows.append(row[: len(fields)])
                    held += len(row[-1] or b"") if payloads else 0
                if rows and (held > _BATCH_BYTES or i == batch.num_rows - 1):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=pa.schema(fields))
                    rows, held = [], 0

    return lines.mapInArrow(read, schema)


def broken_revisits(records: DataFrame) -> DataFrame:
    """The (refers_to_id, payload_digest, payload_bytes) that revisits name and no response has."""
    named = records.where("record_type = 'revisit'").select(F.col("refers_to_id").alias("record_id"), "payload_digest", "payload_bytes").distinct()
    there = records.where("record_type = 'response'").select("record_id", "payload_digest", "payload_bytes")
    return named.join(there, ["record_id", "payload_digest", "payload_bytes"], "left_anti").withColumnRenamed("record_id", "refers_to_id")


def archive_pages(pages: DataFrame, least_bytes: int = 100) -> DataFrame:
    """Write the pages to a new archive and read its records back, without their payloads."""
    path = fresh_dir(pages.sparkSession, "warc")
    write_warc(pages, path, least_bytes)
    records = written(read_warc(pages.sparkSession, path, payloads=False), "warc-records")
    if not broken_revisits(records).isEmpty():
        raise ValueError(f"{path} has revisits without their response")
    return records


#: For the digest columns of ``archive_pages`` over pages.
ORACLE_SQL = """
WITH records AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM records
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM firsts
"""
