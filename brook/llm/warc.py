"""WARC archives: written, normalised to one gzip member per record, and read back.

``write_archives`` gives monolithic archives: whole-file gzip streams with a record per page,
written by Spark's own writer, so they work on any file system Spark can reach.  Of pages
with equal payloads one is a response and the others are revisit records without payload.

``normalise`` is the monolithic gzip normaliser: one map over the archives inflates every
stream once, piece by piece, and rewrites each record as a gzip member of its own, next to
a sidecar index with a line per record (offset, length, record id).  A worker holds one
compressed archive, one record and ``CHUNK`` bytes of finished members at a time.

An archive has at most ``records_per_file`` records, fewer where they are larger than
``RECORD_BYTES``: records are told apart by size classes, each eight times the last, and
a file takes one class and an eighth of the records of the class before, so it holds at most
records_per_file * RECORD_BYTES bytes (256 MB before compression at the defaults) or a single record.

Both outputs go through the text writer with raw bytes as values: its line end, after each
chunk, is an empty gzip member, which readers skip and offsets count.

Defined cases: null html is an empty payload, null or odd urls are left out or percent-coded; a page without id
revisits an equal payload that has one and is else a response; repeated rows with the largest
page_id are all responses; records below ``min_bytes`` are all responses; an empty table
gives empty archives and no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brook.session import materialize

END = "\r\n\r\n"
#: Digests of repeated payloads that are broadcast at most (about 60 bytes each); beyond it pages are joined by shuffle.
MAX_BROADCAST_DIGESTS = 500_000
#: Bytes of a record of the smallest size class at most; most pages are smaller, so few archives hold another class.
RECORD_BYTES = 1 << 17
#: Finished members that leave a task as one row.
CHUNK = 8 << 20
#: A gzip member without content.
EMPTY_MEMBER = (lambda z: z.compress(b"") + z.flush())(zlib.compressobj(6, zlib.DEFLATED, 31))
RECORDS = "archive string, offset long, length long, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 of a 160-bit hex digest: five hex digits make four base-32 digits."""
    digits = lambda k: F.lpad(F.conv(F.substring(hex_digest, 5 * k + 1, 5), 16, 32), 4, "0")
    return F.translate(F.concat(*[digits(k) for k in range(8)]), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """One row ``record`` per page: the WARC record's header, block and all but its end."""
    rows = pages.select(
        F.col(page_id).cast("long").alias("id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("payload")
    )
    rows = rows.withColumn("digest", F.sha1(F.encode("payload", "utf-8"))).withColumn("bytes", F.octet_length("payload").cast("long"))
    # only payloads that occur twice or more are joined back
    same = rows.filter(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.count(F.lit(1)).alias("copies"), F.max("id").alias("first"))
    same = materialize(same.filter("copies > 1 AND first IS NOT NULL").select("digest", "first"), "warc-same")
    rows = rows.join(F.broadcast(same) if same.count() <= MAX_BROADCAST_DIGESTS else same, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    target = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    head = F.concat(
        F.lit("WARC/1.0\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("id"))),
        line("WARC-Date", F.lit("2020-01-01T00:00:00Z")),
        F.coalesce(line("WARC-Target-URI", target), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("digest")))),
        line("Content-Type", F.lit("application/http;msgtype=response")),
    )
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes"), F.lit(END))
    about = F.concat(
        line("WARC-Refers-To", urn(F.col("first"))), line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"))
    )
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    return rows.select(
        F.concat(head, F.when(revisit, about).otherwise(""), line("Content-Length", length), F.lit("\r\n"), http, F.when(revisit, "").otherwise(F.col("payload"))).alias("record")
    )


def write_archives(pages: DataFrame, path: str, records_per_file: int = 2000, **columns) -> str:
    """Monolithic gzip archives of all pages under ``path``, ``size=<class>/run=<number>`` apart."""
    size = F.octet_length("record")
    classes = [F.when(size > RECORD_BYTES << 3 * k, 1).otherwise(0) for k in range(5)]  # a value has less than 2 GiB
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # inside the task: consecutive rows, whatever their class
    out = records(pages, **columns).withColumn("size", sum(classes[1:], classes[0]))
    limit = F.get(F.array(*[F.lit(max(1, records_per_file >> 3 * k)) for k in range(len(classes) + 1)]), "size")
    out = out.withColumn("row", row).select("record", "size", F.floor(F.col("row") / limit).alias("run"))
    out.write.partitionBy("size", "run").option("lineSep", END).option("compression", "gzip").text(path)
    return path


def _binary_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return files.select("path", "content")


class Reader:
    """Records of a byte stream that comes in pieces; ``feed`` gives those that are complete."""

    def __init__(self):
        self.rest = bytearray()

    def feed(self, data: bytes) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
        """(headers, whole record with its end, block)"""
        self.rest += data
        at = 0
        while (head := self.rest.find(b"\r\n\r\n", at)) >= 0:
            headers = {}
            for line in self.rest[at:head].decode("utf-8").split("\r\n")[1:]:
                name, _, value = line.partition(": ")
                headers[name.lower()] = value
            end = head + 4 + int(headers["content-length"])
            if len(self.rest) < end + 4:
                break
            yield headers, bytes(self.rest[at : end + 4]), bytes(self.rest[head + 4 : end])
            at = end + 4
        del self.rest[:at]


def inflate(content: bytes, piece: int = 1 << 18) -> Iterator[bytes]:
    """The stream of a gzip file of any number of members, in pieces of bounded size."""
    z, rest = zlib.decompressobj(31), content
    while rest or z.unconsumed_tail:
        data = z.decompress(z.unconsumed_tail or rest[:piece], piece)
        if not z.unconsumed_tail:
            rest = rest[piece:]
        if data:
            yield data
        if z.eof:
            rest = z.unused_data + rest
            z = zlib.decompressobj(31)


def gzip_member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def page_of(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number.lstrip("-").isdigit() else None


def normalise(spark: SparkSession, source: str, target: str) -> str:
    """Rewrite the archives under ``source``: ``archive=<name>/kind=warc`` and ``kind=index`` under ``target``."""

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                name = _name(path)
                reader, members, lines, held, offset, part = Reader(), [], [], 0, 0, 0

                def chunk(name, part, members, lines) -> pd.DataFrame:
                    index = gzip_member("".join(lines).encode())
                    return pd.DataFrame({"archive": [name] * 2, "kind": ["warc", "index"], "part": [part] * 2, "value": [b"".join(members), index]})

                for data in inflate(content):
                    for headers, record, _ in reader.feed(data):
                        members.append(gzip_member(record))
                        lines.append(f"{offset} {len(members[-1])} {headers['warc-record-id']}\n")
                        offset += len(members[-1])
                        held += len(members[-1])
                        if held >= CHUNK:
                            yield chunk(name, part, members, lines)
                            members, lines, held, part = [], [], 0, part + 1
                            offset += len(EMPTY_MEMBER)
                if reader.rest:
                    raise ValueError(f"{path}: {len(reader.rest)} bytes after the last record")
                if members or not part:
                    yield chunk(name, part, members, lines)

    rows = _binary_files(spark, source, "*.gz").mapInPandas(rewrite, "archive string, kind string, part int, value binary")
    # an archive's chunks come from one task; the writer keeps this order
    rows = rows.sortWithinPartitions("archive", "kind", "part").select("archive", "kind", F.col("value").cast("string").alias("value"))
    out = rows.write.partitionBy("archive", "kind")
    out.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(target)
    return target


def _name(path: str) -> str:
    """An archive's name: its file's, after those of the folders of the partitioned write."""
    *folders, file = path.split("/")
    return "-".join([*(x.replace("=", "") for x in folders[-2:] if "=" in x), file.removesuffix(".gz").removesuffix(".txt")])


def archive_files(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(archive, content) of the normalised files of a kind; the files of the other are pruned by their folder."""
    files = spark.read.format("binaryFile").load(path)
    if "kind" not in files.columns:  # no archive was written
        return spark.createDataFrame([], "archive string, content binary")
    return files.filter(F.col("kind") == kind).select("archive", "content")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(archive, offset, length, record_id) from the sidecar indexes."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["archive"], batch["content"], strict=True):
                rows = [x.split(" ", 2) for x in b"".join(inflate(content)).decode().splitlines()]
                yield pd.DataFrame([(name, int(a), int(b), c) for a, b, c in rows], columns=["archive", "offset", "length", "record_id"])

    return archive_files(spark, path, "index").mapInPandas(lines, "archive string, offset long, length long, record_id string")


def members(content: bytes, piece: int = 1 << 16) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each gzip member of a file."""
    at = 0
    while at < len(content):
        z, data, k = zlib.decompressobj(31), [], at
        while not z.eof and k < len(content):
            data.append(z.decompress(content[k : k + piece]))
            k += piece
        end = min(k, len(content)) - len(z.unused_data)
        yield at, end - at, b"".join(data)
        at = end


def describe(record: bytes) -> tuple:
    """What a record says: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    ((headers, _, block),) = Reader().feed(record)
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = headers["warc-type"]
    if kind == "revisit":
        size = int(http.rpartition(b"Content-Length: ")[2])
        digest = headers["warc-payload-digest"].removeprefix("sha1:")
    else:
        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
    return page_of(headers["warc-record-id"]), size, digest, kind, page_of(headers.get("warc-refers-to"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of normalised archives (columns ``RECORDS``), each met with its line of the sidecar index; a record without one is an error."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["archive"], batch["content"], strict=True):
                rows = [(name, at, size, *describe(data)) for at, size, data in members(content) if data]
                out = pd.DataFrame(rows, columns=[c.split()[0] for c in RECORDS.split(", ")])
                yield out.astype({"page_id": "Int64", "refers_to": "Int64"})

    met = archive_files(spark, path, "warc").mapInPandas(scan, RECORDS).join(read_index(spark, path), ["archive", "offset", "length"], "left")
    lost = F.raise_error(F.concat(F.lit("no index line for the record at "), "offset", F.lit(" of "), "archive"))
    return met.filter(F.coalesce("record_id", lost).isNotNull())
