"""WARC archives: write them as one gzip stream per file, normalise those to a member per record with
a sidecar offset index, read them back.

Files are written and read by Spark, so they may live in any store that Spark reaches. The
normaliser inflates each whole-file stream once, in pieces, and rewrites every record as a gzip
member of its own; after the last member of a file stands one empty member, which readers skip.

A null payload is empty; a null id gives a record without one, which no other record refers to; a
null url leaves the target out. Payloads are equal if their SHA-1 and length are. Rows that repeat
the largest id of a payload are all responses. An empty table gives no archives and no records.
Other columns of the pages are left out.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillgrain.llm.tables import query, table
from tillgrain.session import scratch_path

MIN_REVISIT_BYTES = 1000
#: Written after each file's bytes: a whole gzip member without content.
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
STEP = 1 << 16
ID = "urn:x-page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def plan_records(pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html",
                 min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Per page its payload, digest and whether it is a response or revisits the largest equal id.

    Only payloads that occur more than once meet the pages in the join, one row for each."""
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit("")).cast("binary")
    base = pages.select(
        F.col(f"`{id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"),
        body.alias("payload")).withColumns({
            "payload_bytes": F.octet_length("payload").cast("long"),
            "payload_digest": F.sha1("payload")})
    repeated = (base.where(F.col("payload_bytes") >= min_bytes)
                .groupBy("payload_digest", "payload_bytes")
                .agg(F.max("page_id").alias("kept"), F.count("*").alias("copies"))
                .where((F.col("copies") > 1) & F.col("kept").isNotNull()).drop("copies"))
    joined = base.join(repeated, ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("kept").isNotNull() & ~F.col("kept").eqNullSafe(F.col("page_id"))
    return joined.withColumns({
        "record_type": F.when(revisit, "revisit").otherwise("response"),
        "refers_to": F.when(revisit, F.col("kept"))}).drop("kept")


def _record(date: str) -> Column:
    """One record as bytes, without the line feed that ends it."""
    revisit = F.col("record_type") == "revisit"
    shown = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "), F.col("payload_bytes").cast("string"),
                    F.lit("\r\n\r\n"))
    target = F.regexp_replace(F.col("url").cast("string"), r"[\r\n]", "%0A")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"),
        F.lit(f"\r\nWARC-Record-ID: <{ID}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit(f">\r\nWARC-Date: {date}\r\n"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), target, F.lit("\r\n")), F.lit("")),
        F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest"), F.lit("\r\n"),
        F.coalesce(F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: <{ID}"),
                            F.col("refers_to").cast("string"), F.lit(">\r\n")), F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.octet_length(shown)).cast("string"), F.lit("\r\n\r\n"), http)
    return F.concat(head.cast("binary"), shown, F.lit(b"\r\n\r"))


def write_monolithic(records: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z",
                     per_file: int = 20_000) -> None:
    """Every file one gzip stream over all its records, as many crawlers' dumps come."""
    (records.select(_record(date).cast("string").alias("value")).write
     .option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path))


def _blocks(stream: bytes) -> Iterator[bytes]:
    """What a gzip file holds, in pieces; it may have several members."""
    view, at = memoryview(stream), 0
    while at < len(view):
        inflate = zlib.decompressobj(31)
        while not inflate.eof and at < len(view):
            piece = view[at:at + STEP]
            yield inflate.decompress(piece)
            at += len(piece) - len(inflate.unused_data)
        if not inflate.eof:
            raise ValueError("the gzip stream ends early")


def split_records(stream: bytes) -> Iterator[bytes]:
    """The whole records of an inflated stream, one after the other."""
    held = bytearray()
    need = None
    for block in _blocks(stream):
        held += block
        while True:
            if need is None:
                end = held.find(b"\r\n\r\n")
                if end < 0:
                    break
                need = end + 4 + int(_fields(bytes(held[:end]))["content-length"]) + 4
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = None
    if held:
        raise ValueError("the last record is cut short")


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def normalise(spark: SparkSession, monolithic: str, out: str, level: int = 6) -> None:
    """Rewrite every file below ``monolithic`` to ``out/kind=warc/archive=...`` with a member per
    record, and its offset index to ``out/kind=index/archive=...``, gzipped lines of offset, length,
    type and record id."""
    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                made, lines = bytearray(), []
                for record in split_records(content.as_py()):
                    head = _fields(record[:record.find(b"\r\n\r\n")])
                    member = gzip.compress(record, level, mtime=0)
                    lines.append(f"{len(made)}\t{len(member)}\t{head['warc-type']}\t"
                                 f"{head['warc-record-id']}\n")
                    made += member
                name = re.sub(r"\W+", "-", path.rsplit("/", 1)[-1].removesuffix(".txt.gz"))
                index = gzip.compress("".join(lines).encode(), mtime=0)
                yield pa.RecordBatch.from_pydict({
                    "kind": ["warc", "index"], "archive": [name, name],
                    "value": pa.array([bytes(made), index], pa.binary())})

    files = _files(spark, f"{monolithic}/*.gz")
    if files is None:
        return
    made = files.select("path", "content").mapInArrow(
        rewrite, "kind string, archive string, value binary")
    (made.withColumn("value", F.col("value").cast("string")).write.partitionBy("kind", "archive")
     .option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").text(out))


def _files(spark: SparkSession, path: str) -> DataFrame | None:
    """The files as rows; none if no file was written, as for an empty table."""
    try:
        return spark.read.format("binaryFile").load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def members(stream: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of each member that has content."""
    view, at = memoryview(stream), 0
    while at < len(view):
        inflate, start, made = zlib.decompressobj(31), at, []
        while not inflate.eof:
            piece = view[at:at + STEP]
            if not piece:
                raise ValueError("the archive ends inside a member")
            made.append(inflate.decompress(piece))
            at += len(piece) - len(inflate.unused_data)
        content = b"".join(made)
        if content:
            yield start, at - start, content


RECORD = pa.schema([
    ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("payload", pa.binary())])
RECORD_DDL = ("archive string, offset bigint, length bigint, page_id bigint, url string, "
              "record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, "
              "payload binary")


def parse_record(record: bytes) -> dict:
    """One record's fields; a response's payload is held against its digest."""
    end = record.find(b"\r\n\r\n")
    head = _fields(record[:end])
    block = record[end + 4:-4]
    body = block.find(b"\r\n\r\n")
    http, payload = _fields(block[:body]), block[body + 4:]
    digest = head["warc-payload-digest"].removeprefix("sha1:")
    size = int(http["content-length"])
    if head["warc-type"] == "response" and (
            len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {head['warc-record-id']} differs from its digest")
    number = lambda field: int(x) if (x := field[len(ID) + 1:-1]) else None
    return {"page_id": number(head["warc-record-id"]), "url": head.get("warc-target-uri"),
            "record_type": head["warc-type"], "refers_to": number(head.get("warc-refers-to", "")),
            "payload_bytes": size, "payload_digest": digest, "payload": payload}


def read_records(spark: SparkSession, out: str, payload: bool = True) -> DataFrame:
    """All records of the normalised archives below ``out``, in tasks of whole archives."""
    files = _files(spark, f"{out}/kind=warc/*/*")
    if files is None:
        return spark.createDataFrame([], RECORD_DDL)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                archive = path.rsplit("archive=", 1)[1].split("/")[0]
                rows, held = [], 0
                for offset, length, record in members(content.as_py()):
                    row = parse_record(record) | {"archive": archive, "offset": offset,
                                                  "length": length}
                    if not payload:
                        row["payload"] = None
                    rows.append(row)
                    held += len(record) if payload else 100
                    if held > 1 << 24:
                        yield pa.RecordBatch.from_pylist(rows, RECORD)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, RECORD)

    return files.select("path", "content").mapInArrow(parse, RECORD_DDL)


def read_index(spark: SparkSession, out: str) -> DataFrame:
    """The sidecar indexes: archive, offset, length, record_type and page_id of every record."""
    schema = "archive string, offset bigint, length bigint, record_type string, page_id bigint"
    files = _files(spark, f"{out}/kind=index/*/*")
    if files is None:
        return spark.createDataFrame([], schema)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                archive = path.rsplit("archive=", 1)[1].split("/")[0]
                lines = [x.split("\t") for x in
                         gzip.decompress(content.as_py()).decode().splitlines()]
                yield pa.RecordBatch.from_pydict({
                    "archive": pa.array([archive] * len(lines), pa.string()),
                    "offset": pa.array([int(x[0]) for x in lines], pa.int64()),
                    "length": pa.array([int(x[1]) for x in lines], pa.int64()),
                    "record_type": pa.array([x[2] for x in lines], pa.string()),
                    "page_id": pa.array([int(n) if (n := x[3][len(ID) + 1:-1]) else None
                                         for x in lines], pa.int64())})

    return files.select("path", "content").mapInArrow(parse, schema)


@query("op3_warc")
def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    dumps, archives = scratch_path(spark, "dumps"), scratch_path(spark, "archives")
    write_monolithic(plan_records(table(spark, folder, "pages")), dumps)
    normalise(spark, dumps, archives)
    return read_records(spark, archives, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
