"""WARC archives with one Zstandard dictionary: written and read by Spark as files of self-contained frames.

A file is a skippable frame with the dictionary, then one compressed frame per record. Spark's text writer puts
the frames there, with an empty skippable frame as the separator between rows; so each file is a valid
Zstandard file, is committed like any Spark output, and can be split at the separators when it is read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.kernel import flat
from parcelflow.session import scratch_path

#: An empty skippable frame (number 0x184D2A50); all its bytes are ASCII.
SEPARATOR = "P*M\x18\x00\x00\x00\x00"
#: Start of a skippable frame that holds a dictionary (number 0x184D2A5D).
DICTIONARY_MAGIC = struct.pack("<I", 0x184D2A5D)
#: Bounds of the sample that the dictionary is built from, and of the dictionary itself.
SAMPLE_RECORDS = 2_000
SAMPLE_BYTES = 16_384
DICTIONARY_BYTES = 65_536
LEVEL = 3

_WRITTEN = "frame binary"
_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_bytes long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record(page_id, url, payload: bytes, sha1: str, refers_to) -> bytes:
    """A WARC/1.1 record. A revisit has no block of its own but names the record with the same payload."""
    revisit = refers_to is not None
    clean = "".join((url or "").split()) or f"urn:page:{page_id}"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Target-URI: {clean}",
        f"WARC-Payload-Digest: sha1:{sha1}",
        f"X-Payload-Bytes: {len(payload)}",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    block = b"" if revisit else payload
    lines += ["Content-Type: text/html", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8") + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    return fields, rest[: int(fields["content-length"])]


def build_dictionary(records: list[bytes]) -> bytes:
    """Dictionary from sample records; where the trainer finds too little, the records themselves as raw content."""
    records = [r[:SAMPLE_BYTES] for r in records]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, records).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[-DICTIONARY_BYTES:] or b"WARC/1.1\r\n"


def _load(raw: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(raw)


def _compress(engine: zstandard.ZstdCompressor, raw: bytes) -> bytes:
    """One frame; where it holds the separator by chance, blank lines after the record change it."""
    frame = engine.compress(raw)
    while SEPARATOR.encode() in frame:
        raw += b"\r\n"
        frame = engine.compress(raw)
    return frame


def skippable(payload: bytes) -> bytes:
    return DICTIONARY_MAGIC + struct.pack("<I", len(payload)) + payload


def with_references(pages: DataFrame) -> DataFrame:
    """Pages with digest and refers_to: of equal payloads the largest page_id is kept, others refer to it.

    Only ids and digests are grouped, after partial aggregation; the join that follows can be split where one
    digest is on very many pages. Repeated rows with one page_id are all responses. Null page_ids are never
    referred to while another page has the payload.
    """
    ids = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("_sha1", F.sha1(F.col("html").cast("binary")))
    best = ids.groupBy("_sha1").agg(F.max("page_id").alias("_largest"))
    return ids.join(best, "_sha1").withColumn(
        "_refers", F.when(~F.col("page_id").eqNullSafe(F.col("_largest")), F.col("_largest"))
    )


def _sample(pages: DataFrame, seed: int = 11) -> list[bytes]:
    """Records of at most SAMPLE_RECORDS pages, cut to SAMPLE_BYTES: what the dictionary is built from."""
    keep = -(-1_000_000 * SAMPLE_RECORDS // max(pages.count(), SAMPLE_RECORDS))
    rows = (
        pages.where(F.pmod(F.xxhash64("page_id", "url", F.lit(seed)), F.lit(1_000_000)) < keep)
        .select("page_id", "url", F.substring(F.col("html").cast("string"), 1, SAMPLE_BYTES).alias("html"))
        .limit(SAMPLE_RECORDS)
        .collect()
    )
    return [record(r.page_id, r.url, (r.html or "").encode(), digest(b""), None) for r in rows]


def write(pages: DataFrame, path: str) -> None:
    """Write one record per page to files under ``path``. Null html: empty payload; null url: the page's urn."""
    spark = pages.sparkSession
    raw_dictionary = build_dictionary(_sample(pages))
    # Its magic number tells a reader where the dictionary is; itself it must not hold the separator.
    packed = zstandard.ZstdCompressor(level=LEVEL).compress(raw_dictionary)
    shared = spark.sparkContext.broadcast(packed)  # at most DICTIONARY_BYTES and a little

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine, first = None, True
        for batch in batches:
            out: list[bytes] = []
            if engine is None:
                raw = zstandard.ZstdDecompressor().decompress(shared.value)
                engine = zstandard.ZstdCompressor(level=LEVEL, dict_data=_load(raw))
            if first:
                out.append(skippable(shared.value))
                first = False
            columns = [batch.column(k).to_pylist() for k in range(2)]
            data, offsets = flat(batch.column(2))
            refers = batch.column(3).to_pylist()
            size = 0
            for k, (page_id, url) in enumerate(zip(*columns, strict=True)):
                payload = data[offsets[k] : offsets[k + 1]].tobytes()
                out.append(_compress(engine, record(page_id, url, payload, digest(payload), refers[k])))
                size += len(out[-1])
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    chosen = with_references(pages).select("page_id", "url", "html", "_refers")
    chosen.mapInArrow(frames, _WRITTEN).select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives under ``path``, decoded and checked: one row per record.

    The digest and size of a response are computed from the block that was read; those of a revisit are
    what its header says. A block that doesn't match its header fails the read.
    """
    lines = spark.read.option("lineSep", SEPARATOR).text(path).select(F.col("value").cast("binary").alias("frame"))
    is_dictionary = F.substring("frame", 1, 4) == F.lit(DICTIONARY_MAGIC)
    found = lines.where(is_dictionary).limit(1).collect()  # every file leads with the same one
    if not found:
        return spark.createDataFrame([], _READ)
    shared = spark.sparkContext.broadcast(bytes(found[0].frame[8:]))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw = zstandard.ZstdDecompressor().decompress(shared.value)
        engine = zstandard.ZstdDecompressor(dict_data=_load(raw))
        for batch in batches:
            rows = []
            for frame in batch.column(0):
                fields, block = parse(engine.decompress(frame.as_py()))
                urn = fields["warc-record-id"][len("<urn:page:") : -1]
                sha1 = fields["warc-payload-digest"].removeprefix("sha1:")
                kind, refers, size = fields["warc-type"], None, int(fields["x-payload-bytes"])
                if kind == "revisit":
                    refers = int(fields["warc-refers-to"][len("<urn:page:") : -1])
                elif digest(block) != sha1 or len(block) != size:
                    raise ValueError(f"record {urn} does not match its digest")
                rows.append((None if urn == "None" else int(urn), size, sha1, kind, refers, len(frame.as_py())))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_bytes"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return lines.where(~is_dictionary & (F.octet_length("frame") > 0)).mapInArrow(decode, _READ)


def archive(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write all pages, then read the archives back. Empty table: no records, no rows."""
    spark = pages.sparkSession
    path = path or scratch_path(spark, "archive")
    write(pages, path)
    return read(spark, path)


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    rows = archive(spark.read.parquet(f"{folder}/pages.parquet"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _base32(digest_: str) -> str:
    """SQL for the base32 form of a hexadecimal SHA-1: five hexadecimal digits are four letters."""
    letters = []
    for k in range(8):
        number = f"CAST('0x' || substr({digest_}, {5 * k + 1}, 5) AS BIGINT)"
        letters += [f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (({number} >> {shift}) & 31), 1)" for shift in (15, 10, 5, 0)]
    return " || ".join(letters)


SQL = f"""
WITH page AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
hashed AS (SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS digest FROM page),
best AS (SELECT digest, max(page_id) AS largest FROM hashed GROUP BY digest)
SELECT page_id, payload_bytes, {_base32('digest')} AS payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM hashed JOIN best USING (digest)
"""
