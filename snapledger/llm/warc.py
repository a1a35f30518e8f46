"""WARC archives: written by Spark's own writer, read by a Python data source.

Writing: every record is one string that ends with two line ends, which is the line separator given to
the text writer; so archives land in any store Spark writes to, with its commit protocol.

Reading (format ``warc``): the driver only lists files and plans one partition per file.  Filters on
``record_type``, ``record_id``, ``target_uri``, ``date`` and ``payload_digest`` are pushed down: headers
are parsed first, and the block of a record that fails a filter, or whose payload isn't asked for
(option ``payload`` = ``false``), is passed over without being decoded.

Options: ``payload`` (``true``; ``digest`` reads payloads but returns only their length and digest, both told from
the bytes that were read), ``headers`` (comma list of further headers to return).
Plain and gzip archives (``.gz``, one member per record or one for all) are read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith

from snapledger.llm.common import join_groups, materialise
from snapledger.session import scratch_path

SCHEMA = ("record_id string, record_type string, target_uri string, date string, payload_digest string, "
          "content_length long, headers map<string,string>, payload binary, read_bytes long, read_digest string")
FIELDS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date",
          "payload_digest": "warc-payload-digest"}
BATCH_BYTES = 8 << 20
# fixed values of the format
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"


# ------------------------------------------------------------------------------------ reading
@dataclass
class OneFile(InputPartition):
    uri: str


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower()
        self.wanted = [x.strip().lower() for x in options.get("headers", "").split(",") if x.strip()]
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in FIELDS and isinstance(f, EqualTo):
                self.tests.append((FIELDS[name], "in", frozenset([f.value])))
            elif name in FIELDS and isinstance(f, In):
                self.tests.append((FIELDS[name], "in", frozenset(f.value)))
            elif name in FIELDS and isinstance(f, StringStartsWith):
                self.tests.append((FIELDS[name], "starts", f.value))
            elif name in FIELDS and isinstance(f, IsNotNull):
                self.tests.append((FIELDS[name], "there", None))
            else:
                yield f

    def partitions(self):
        from pyarrow.fs import FileSelector

        fs, path = _store(self.path)
        info = fs.get_file_info(path)
        found = fs.get_file_info(FileSelector(path, recursive=True)) if info.type.name == "Directory" else [info]
        names = sorted(f.path for f in found if f.is_file and f.size and not f.base_name.startswith(("_", ".")))
        return [OneFile(n) for n in names]

    def read(self, partition: OneFile | None):
        if partition is None:                                 # no files: Spark asks once all the same
            return
        fs, _ = _store(self.path)
        rows: list[tuple] = []
        size = 0
        with fs.open_input_stream(partition.uri, compression=None, buffer_size=1 << 20) as raw:
            stream = gzip.GzipFile(fileobj=raw) if partition.uri.endswith(".gz") else raw
            for headers, length, take in records(stream):
                if not all(_holds(headers.get(h), how, value) for h, how, value in self.tests):
                    continue
                payload = http_body(take(), headers) if self.payload != "false" else None
                told = (None, None) if payload is None else (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
                if self.payload == "digest":
                    payload = None
                kept = headers if not self.wanted else {h: headers[h] for h in self.wanted if h in headers}
                rows.append((headers.get("warc-record-id"), headers.get("warc-type"), headers.get("warc-target-uri"),
                             headers.get("warc-date"), headers.get("warc-payload-digest"), length, list(kept.items()), payload, *told))
                size += 1000 + len(payload or b"")
                if size > BATCH_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 5 + [pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary(), pa.int64(), pa.string()]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def _store(path: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)


def _holds(value, how, wanted) -> bool:
    if value is None:
        return False
    return value in wanted if how == "in" else value.startswith(wanted) if how == "starts" else True


def records(stream) -> Iterator[tuple[dict, int, object]]:
    """(headers, block length, function that reads the block) per record; a block not read is passed over."""
    left = b""

    def fill(n: int) -> bool:
        nonlocal left
        got = stream.read(max(n, 1 << 16))
        left += got
        return bool(got)

    while True:
        while True:
            left = left.lstrip(b"\r\n")                       # what ends the record before, wherever a read cut it
            if (at := left.find(b"\r\n\r\n")) > 0:
                break
            if not fill(1 << 16):
                if left:
                    raise ValueError("truncated WARC header")
                return
        lines = left[:at].decode("utf-8").split(END)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        headers: dict[str, str] = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        left = left[at + 4:]
        taken = False

        def take() -> bytes:
            nonlocal left, taken
            while len(left) < length:
                if not fill(length - len(left)):
                    raise ValueError("truncated WARC block")
            block, left, taken = left[:length], left[length:], True
            return block

        yield headers, length, take
        if not taken:
            rest = length - len(left)
            left = left[length:]
            while rest > 0:
                got = stream.read(min(rest, 1 << 20))
                if not got:
                    raise ValueError("truncated WARC block")
                rest -= len(got)


def http_body(block: bytes, headers: dict) -> bytes:
    """The payload: behind the HTTP header of a response, else the block."""
    if headers.get("content-type", "").startswith("application/http"):
        return block[block.index(b"\r\n\r\n") + 4:]
    return block


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)


def read(spark: SparkSession, path: str, payload: bool | str = True, headers: str = "") -> DataFrame:
    """Records of the archives at ``path``; ``payload`` is True, False or ``"digest"`` (see above)."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).option("headers", headers).load(path)


# ------------------------------------------------------------------------------------ writing
def base32(digits: Column) -> Column:
    """Bare upper-case base32 of 40 hex digits: 5 digits make 4 letters."""
    letters = F.lit(ALPHABET)
    out = []
    for i in range(8):
        n = F.conv(F.substring(digits, 5 * i + 1, 5), 16, 10).cast("int")
        out += [F.substring(letters, F.shiftright(n, 5 * (3 - k)).bitwiseAND(31) + 1, 1) for k in range(4)]
    return F.concat(*out)


def with_revisits(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """``pages`` with payload, payload_bytes, payload_digest, record_type and refers_to.

    Of pages with equal payloads of at least ``min_bytes`` bytes that with the largest id is the
    response, the others revisit it.  A null html is an empty payload; pages without an id are
    responses that nothing refers to.
    """
    there = (pages.withColumn("payload", F.coalesce(html_col, F.lit("")))
             .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
             .withColumn("_sha1", F.sha1(F.encode("payload", "UTF-8"))))
    can = (F.col("payload_bytes") >= min_bytes) & F.col(id_col).isNotNull()
    few = there.where(can).select(F.col(id_col).alias("_id"), "_sha1", "payload_bytes")
    same = (few.groupBy("_sha1", "payload_bytes").agg(F.max("_id").alias("_last"), F.count("*").alias("_n"))
            .where("_n > 1"))
    total = pages.count()
    found = join_groups(there.where(can), same, ["_sha1", "payload_bytes"], "_n", total, "left")
    rest = there.where(~can | F.col(id_col).isNull()).withColumn("_last", F.lit(None).cast("long")).withColumn("_n", F.lit(None).cast("long"))
    revisit = F.col("_last").isNotNull() & (F.col("_last") != F.col(id_col))
    return (found.unionByName(rest)
            .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(revisit, F.col("_last"))).withColumn("payload_digest", base32(F.col("_sha1")))
            .drop("_last", "_n", "_sha1"))


def record_id(id_col: Column) -> Column:
    """A stable record id: an URN built from the MD5 of the page id."""
    h = F.md5(F.concat(F.lit("page:"), id_col.cast("string")))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_bytes: int = 0,
          date: str = "2024-01-01T00:00:00Z", compression: str = "gzip") -> None:
    """One WARC/1.1 record per page, in gzip archives unless ``compression`` is ``none``.  Line ends in urls become spaces; a null url is ``about:blank``."""
    marked = with_revisits(pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                                        F.col(html_col).alias("html")), "page_id", "html", min_bytes)
    own = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    # a page without an id gets a record id of its own: nothing refers to it
    named = F.coalesce(F.col("page_id").cast("string"), F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string")))
    is_revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload")))
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), "record_type"),
             F.concat(F.lit("WARC-Record-ID: "), record_id(named)), F.lit(f"WARC-Date: {date}"),
             F.concat(F.lit("WARC-Target-URI: "), F.coalesce(F.regexp_replace("url", r"[\r\n]+", " "), F.lit("about:blank"))),
             F.concat(F.lit("WARC-Payload-Digest: sha1:"), "payload_digest"),
             F.concat(F.lit("X-Page-ID: "), own), F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string")),
             F.when(is_revisit, F.concat(F.lit("WARC-Refers-To: "), record_id(F.col("refers_to")))),
             F.when(is_revisit, F.concat(F.lit("X-Refers-To-Page-ID: "), F.col("refers_to").cast("string"))),
             F.when(is_revisit, F.lit(f"WARC-Profile: {REVISIT_PROFILE}")),
             F.lit("Content-Type: application/http; msgtype=response"),
             F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    marked.select(F.concat(F.concat_ws(END, *lines), F.lit(END + END), block).alias("value")).write.option(
        "lineSep", END + END).option("compression", compression).text(path)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of archives written from ``pages`` and read again.

    Length and digest of a response are told from the payload that was read, not from its headers; a revisit has those of
    the record that its WARC-Refers-To names.  A null html is an empty payload; pages without an id, repeated rows and empty
    tables as in ``with_revisits``; extra columns are ignored.  A revisit whose record is not there has no digest.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "llm-warc")
    write(pages, path, min_bytes=min_bytes)
    page_id = F.expr("try_cast(headers['x-page-id'] as bigint)").alias("page_id")
    responses = materialise(read(spark, path, payload="digest", headers="x-page-id").where("record_type = 'response'").select(
        page_id, "record_id", "read_bytes", "read_digest"), "warc-responses")
    revisits = read(spark, path, payload=False, headers="x-page-id,warc-refers-to").where("record_type = 'revisit'").select(
        page_id, F.col("headers")["warc-refers-to"].alias("record_id"))
    revisits = materialise(revisits, "warc-revisits")
    asked = revisits.groupBy("record_id").agg(F.count("*").alias("n_asked"))
    one = responses.groupBy("record_id").agg(F.max("page_id").alias("refers_to"), F.max("read_bytes").alias("payload_bytes"),
                                             F.max("read_digest").alias("payload_digest"))       # a page given twice has equal records
    told = join_groups(revisits, asked.join(one, "record_id", "left"), ["record_id"], "n_asked", revisits.count(), "left")
    return responses.select("page_id", F.col("read_bytes").alias("payload_bytes"), F.col("read_digest").alias("payload_digest"),
                            F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")).unionByName(
        told.select("page_id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "refers_to"))
