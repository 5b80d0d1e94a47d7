"""WARC archives with an index: write pages as records, read selected records back by coalesced byte ranges.

Writing comes first with the index: every task writes its rows into archives of its own, each record a gzip member, and
returns offset, length, URL and digest of each. The index is a table that Spark commits as a whole, so archives of a
task that was lost or ran twice are in no index row and do no harm. Reading takes any selection of index rows, sorts them
by archive and offset, and merges neighbours into one ranged read.

Of records with equal payloads of at least REVISIT_BYTES, the one with the smallest page_id is a response and the others
are revisits without a payload, which name it.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.llm.common import bounded_batches, cut

REVISIT_BYTES = 100
ARCHIVE_BYTES = 256 << 20
#: Neighbouring records are read at once up to this many bytes, over gaps of up to this many.
RANGE_BYTES, GAP_BYTES = 4 << 20, 64 << 10
TASK_BYTES = 32 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("archive", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
    ]
)
_INDEX_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("archive", pa.string()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("payload_digest", pa.string()),
    ]
)
_RECORD = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("refers_to", T.LongType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)
_RECORD_ARROW = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _number(name: str | None) -> int | None:
    digits = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str
) -> bytes:
    """One record, uncompressed. A revisit has the HTTP head of the response and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _name(page_id)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.insert(2, ("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if revisit:
        fields += [("WARC-Refers-To", _name(refers_to)), ("WARC-Profile", _PROFILE)]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Fields and payload of one uncompressed record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"no WARC record: {version[:40]!r}")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    block = rest[: int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


class _Archives:
    """The archives of one task."""

    def __init__(self, folder: str) -> None:
        self.files, self.folder = pyarrow.fs.FileSystem.from_uri(folder)
        self.files.create_dir(self.folder, recursive=True)
        self.out, self.at, self.name = None, 0, ""

    def add(self, raw: bytes) -> tuple[str, int, int]:
        if self.out is None or self.at >= ARCHIVE_BYTES:
            self.close()
            self.name, self.at = f"{uuid.uuid4().hex}.warc.gz", 0
            self.out = self.files.open_output_stream(f"{self.folder}/{self.name}", compression=None)
        member = zlib.compressobj(4, zlib.DEFLATED, 31)
        packed = member.compress(raw) + member.flush()
        self.out.write(packed)
        self.at += len(packed)
        return self.name, self.at - len(packed), len(packed)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


def roles(pages: DataFrame) -> DataFrame:
    """`pages` with html for null replaced, digest, revisit and refers_to; only page_id, url and html are kept."""
    html = F.coalesce(F.col("html"), F.lit(""))
    pages = pages.select("page_id", "url", html.alias("html"), F.sha2(html.cast("binary"), 256).alias("digest"))
    large = pages.where(F.octet_length("html") >= REVISIT_BYTES)
    firsts = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = firsts.select(F.col("digest").alias("of"), "first")
    revisit = F.coalesce(F.col("page_id").isNull() | (F.col("page_id") != F.col("first")), F.lit(False))
    # Without any id in its group, nothing names a first record.
    revisit = revisit & F.col("first").isNotNull()
    return pages.join(firsts, F.col("digest") == F.col("of"), "left").select(
        "page_id", "url", "html", "digest", revisit.alias("revisit"), F.when(revisit, F.col("first")).alias("refers_to")
    )


def write_archives(pages: DataFrame, folder: str, date: str | None = None) -> DataFrame:
    """Write a record for every row of `pages` (page_id, url, html) into archives in `folder`; the index.

    `folder` is a URI that all executors share; the index is kept in its folder `index`.

    - A null html is an empty payload, a null url has no target field, a null page_id an empty name. Rows that repeat an
      id are records each; a payload of any size is one record.
    - Of equal payloads, all rows with the smallest page_id are responses; rows without an id refer to it too, or are
      responses where no row of the group has an id.
    - An empty table writes an empty index. Other columns, whatever their names, are not read.
    """
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    bounded_batches(pages.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = _Archives(folder)
        for batch in batches:
            rows = []
            for row in zip(*batch.columns, strict=True):
                page_id, url, html, digest, revisit, refers_to = (x.as_py() for x in row)
                raw = record(page_id, url, html.encode(), digest, refers_to, revisit, date)
                rows.append((page_id, url, *archives.add(raw), digest))
            yield _batch(rows, _INDEX_ARROW)
        archives.close()

    roles(pages).mapInArrow(write, _INDEX).write.parquet(f"{folder}/index")
    return read_index(pages.sparkSession, folder)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema.names]
    return pa.RecordBatch.from_pydict(dict(zip(schema.names, columns, strict=True)), schema)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_INDEX).parquet(f"{folder}/index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of the rows of `index`: page_id, url, record_type, refers_to, payload_digest, payload."""
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(1, -(-total // TASK_BYTES), index.sparkSession.sparkContext.defaultParallelism)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = pyarrow.fs.FileSystem.from_uri(folder)
        name, source = None, None
        for batch in batches:
            for archive, wanted in _ranges(batch):
                if archive != name:
                    name, source = archive, files.open_input_file(f"{root}/{archive}")
                first, end = wanted[0][0], wanted[-1][0] + wanted[-1][1]
                data = source.read_at(end - first, first)
                rows = [_record(zlib.decompress(data[at - first : at - first + n], 31)) for at, n in wanted]
                yield _batch(rows, _RECORD_ARROW)

    places = index.select("archive", "offset", "length").repartitionByRange(int(tasks), "archive", "offset")
    return places.sortWithinPartitions("archive", "offset").mapInArrow(read, _RECORD)


def _record(raw: bytes) -> tuple:
    fields, payload = parse(raw)
    revisit = fields["warc-type"] == "revisit"
    return (
        _number(fields["warc-record-id"]),
        fields.get("warc-target-uri"),
        fields["warc-type"],
        _number(fields["warc-refers-to"]) if revisit else None,
        fields["warc-payload-digest"].removeprefix("sha256:"),
        None if revisit else payload,
    )


def _ranges(batch: pa.RecordBatch) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    """Runs of neighbours of sorted index rows: the archive, and offset and length of each record."""
    held, of = [], None
    for archive, at, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length")), strict=True):
        if held:
            end = held[-1][0] + held[-1][1]
            if archive != of or at - end > GAP_BYTES or at + length - held[0][0] > RANGE_BYTES:
                yield of, held
                held = []
        of = archive
        held.append((at, length))
    if held:
        yield of, held


def round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """Write `pages` to archives, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Size and digest of a response come from the payload that was read; those of a revisit from the response that it names.
    """
    records = read_records(write_archives(pages, folder), folder)

    columns = ["page_id", "record_type", "refers_to", "payload_digest"]
    size = F.octet_length("payload").cast("long")
    rows = cut(records.select(*columns, size.alias("n"), F.sha2("payload", 256).alias("digest")))
    responses = rows.where("record_type = 'response'")
    # An id that repeats names several responses; the digest tells which is meant.
    full = responses.select(F.col("page_id").alias("of"), F.col("n").alias("full_n"), F.col("digest").alias("full_digest"))
    revisits = rows.where("record_type = 'revisit'").join(
        full.distinct(), (F.col("refers_to") == F.col("of")) & (F.col("payload_digest") == F.col("full_digest"))
    )

    def result(found: DataFrame, n: str, digest: str) -> DataFrame:
        return found.select(
            "page_id", F.col(n).alias("payload_bytes"), F.col(digest).alias("payload_digest"), "record_type", "refers_to"
        )

    return result(responses, "n", "digest").unionAll(result(revisits, "full_n", "full_digest"))
