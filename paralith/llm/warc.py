"""WARC archives with revisit records.

Writing: the headers of the pages (id, url, length and payload digest) are written once; of equal payloads the largest id becomes
the original response, found by an aggregate over the digests, and the others revisit it.  Both sides of the joins are tables, so
adaptive execution can split a digest that a third of all pages share.  Records are text, so Spark's own writer makes the
archives: a record is one row, and the line separator is the two line ends that close a record.  The commit protocol of that
writer keeps the archives whole when executors are lost.  Each archive is one gzip member.

Reading: gzip files are not split, so a task sees a file's pieces in order; joined by the separator they are its bytes again,
and records are cut out of that stream by their Content-Length, one at a time.  Revisit records have no payload: they are
joined by payload digest to the original responses.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paralith.llm.common import positional, shared_path, written

END = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(text):
    """Upper-case base32 of the SHA-1 of a string column; 160 bits are 32 digits without padding.

    The digest is bound to a variable, for the optimizer would put the whole hash at each of its uses.
    """
    digits = lambda h: F.concat(*(F.lpad(F.conv(F.substring(h, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)))  # 40 bits a piece
    return F.element_at(F.transform(F.array(F.sha1(text)), lambda h: F.translate(digits(h), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)), 1)


def resolve_revisits(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Headers (page_id, url, payload_bytes, payload_digest) with ``record_type``, ``refers_to`` and ``refers_url``.

    Of equal payloads of at least ``min_bytes`` bytes the largest page_id is the response and the others revisit it; smaller
    ones are all responses.  A null page_id is smaller than any other; rows that share the largest id (repeated rows, or
    nulls only) are responses each, and a revisit refers to the one with the largest url.  An empty table gives an empty table.
    """
    many = headers.groupBy(F.col("payload_digest").alias("digest")).agg(F.max(F.struct("page_id", "url")).alias("top"), F.count("*").alias("n"))
    most = written(many.where("n > 1").select("digest", F.col("top.page_id").alias("original"), F.col("top.url").alias("original_url")), "originals")
    revisit = F.col("digest").isNotNull() & (F.col("payload_bytes") >= min_bytes) & F.coalesce(F.col("page_id") != F.col("original"), F.col("original").isNotNull())
    return headers.join(most, F.col("payload_digest") == F.col("digest"), "left").select(
        *headers.columns, F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("original")).alias("refers_to"), F.when(revisit, F.col("original_url")).alias("refers_url"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write one record for every row of ``pages`` below ``path``; a null html is the empty payload, a null url is left out.

    Ids may be of any type that has an order and a string form.  Other columns are not written.  Line ends in a url are
    written as their percent codes, as they would end the header.  Repeated rows are records each; an empty table makes
    archives without records.
    """
    inner, (pid, url, html) = positional(pages, id_col, url_col, html_col)
    rows = inner.select(F.col(pid).alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    rows = rows.withColumns({"payload_digest": base32_sha1(F.col("html")), "payload_bytes": F.octet_length("html").cast("bigint")})
    headers = written(rows.drop("html"), "headers")
    revisits = resolve_revisits(headers, min_bytes).where("record_type = 'revisit'").select(
        F.col("page_id").alias("rid"), F.col("payload_digest").alias("rdigest"), "refers_to", "refers_url").distinct()
    revisits = written(revisits, "revisits")
    joined = rows.join(revisits, rows["page_id"].eqNullSafe(revisits["rid"]) & (rows["payload_digest"] == revisits["rdigest"]), "left")
    again = F.col("rdigest").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("payload_bytes").cast("string"), F.lit(END))
    block = F.when(again, http).otherwise(F.concat(http, F.col("html")))
    size = F.octet_length(http) + F.when(again, 0).otherwise(F.col("payload_bytes"))
    uri = lambda c: F.regexp_replace(F.regexp_replace(c, "\r", "%0D"), "\n", "%0A")
    number = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    name = lambda i, u: _uuid(F.concat_ws(" ", number(F.col(i)), "payload_digest", u))
    refers = F.concat(
        F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: <urn:uuid:"), name("refers_to", "refers_url"), F.lit(">"),
        F.when(F.col("refers_url").isNotNull(), F.concat(F.lit("\r\nWARC-Refers-To-Target-URI: "), uri("refers_url"))).otherwise(""), F.lit(f"\r\nWARC-Refers-To-Date: {date}"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(again, "revisit").otherwise("response"), F.lit("\r\nWARC-Record-ID: <urn:uuid:"), name("page_id", "url"),
        F.lit(f">\r\nWARC-Date: {date}"), F.when(F.col("url").isNotNull(), F.concat(F.lit("\r\nWARC-Target-URI: "), uri("url"))).otherwise(""),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("payload_digest"), F.lit("\r\nX-Page-ID: "), number(F.col("page_id")), F.when(again, refers).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), size.cast("string"))
    joined.select(F.concat(head, F.lit(END), block).alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


def _uuid(seed):
    """A name-based identifier of the form 8-4-4-4-12."""
    h = F.sha1(seed)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(F.lit("8"), F.substring(h, 18, 3)), F.substring(h, 21, 12))


def parse_stream(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a stream of pieces, holding one record at a time."""
    buffer, start = bytearray(), 0

    def more(n: int) -> bool:
        while len(buffer) - start < n:
            if (piece := next(pieces, None)) is None:
                return False
            buffer.extend(piece)
        return True

    while True:
        while more(2) and buffer[start : start + 2] == b"\r\n":  # no record begins with a line end; Spark's reader may add some at the end of a file
            start += 2
        while (at := buffer.find(b"\r\n\r\n", start)) < 0:
            if (piece := next(pieces, None)) is None:
                if buffer[start:].strip():
                    raise ValueError("the archive ends inside a record's header")
                return
            del buffer[:start]
            start = 0
            buffer.extend(piece)
        lines = bytes(buffer[start:at]).decode("utf-8", "surrogateescape").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not the beginning of a record: {lines[0][:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(headers["content-length"])
        start = at + 4
        if not more(size):
            raise ValueError("the archive ends inside a record")
        block = bytes(buffer[start : start + size])
        more(size + 4)
        start += size + 4
        if start > 1 << 20:
            del buffer[:start]
            start = 0
        yield headers, block


RECORDS = "page_id string, url string, payload_bytes bigint, payload_digest string, stated_digest string, record_type string, record_id string, refers_to_record string, html string"


def read_archives(spark: SparkSession, path: str, payloads: bool = True, id_type: str = "bigint") -> DataFrame:
    """The records of the archives below ``path``: for responses with length and digest taken from the payload itself and,
    with ``payloads``, the payload; revisits have nulls there.  Page ids are read as ``id_type``, an empty one as null."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[bytes]:
            for batch in batches:
                for piece in batch.column(0).cast(pa.binary()).to_pylist():
                    yield piece
                    yield b"\r\n\r\n"

        rows: list[tuple] = []
        size = 0
        names = [x.split()[0] for x in RECORDS.split(", ")]
        kinds = [pa.int64() if "bigint" in x else pa.string() for x in RECORDS.split(", ")]
        pack = lambda: pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
        for headers, block in parse_stream(pieces()):
            own = headers["warc-type"] == "response"
            payload = block.partition(b"\r\n\r\n")[2] if own else None
            rows.append((
                headers.get("x-page-id") or None, headers.get("warc-target-uri"), len(payload) if own else None,
                base64.b32encode(hashlib.sha1(payload).digest()).decode() if own else None, headers["warc-payload-digest"].removeprefix("sha1:"),
                headers["warc-type"], headers["warc-record-id"], headers.get("warc-refers-to"), payload.decode() if own and payloads else None))
            size += len(block)
            if len(rows) >= 2000 or size > 16_000_000:
                yield pack()
                rows, size = [], 0
        if rows:
            yield pack()

    return spark.read.option("lineSep", END).text(path).mapInArrow(parse, RECORDS).withColumn("page_id", F.col("page_id").cast(id_type))


def archive_index(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record, revisits resolved by payload digest.

    Lengths and digests of responses are those of their payloads; a revisit takes them, and the page id, from its original.
    """
    records = written(read_archives(spark, path, False, id_type).select("page_id", "payload_bytes", "payload_digest", "stated_digest", "record_type"), "index")
    responses = records.where("record_type = 'response'")
    wanted = records.where("record_type = 'revisit'").select("stated_digest").distinct()
    originals = responses.select("page_id", "payload_bytes", "payload_digest").join(wanted, F.col("payload_digest") == F.col("stated_digest"), "left_semi")
    originals = written(originals.groupBy(F.col("payload_digest").alias("digest")).agg(F.max("payload_bytes").alias("bytes"), F.max("page_id").alias("original")), "resolved")
    revisits = records.where("record_type = 'revisit'").join(originals, F.col("stated_digest") == F.col("digest"), "left")
    own = responses.select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast(id_type).alias("refers_to"))
    return own.unionByName(revisits.select("page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", F.col("original").alias("refers_to")))


def deduplicate_archives(pages: DataFrame, min_bytes: int = 0, path: str | None = None) -> DataFrame:
    """Write ``pages`` as archives below ``path`` (a fresh shared folder by default) and read them back: one row for each row of ``pages``.

    Null html is the empty payload, and equal to other empty ones; null ids and repeated rows are as in :func:`resolve_revisits`.
    An empty table gives an empty table; columns besides page_id, url and html are not read.
    """
    path = path or shared_path(pages.sparkSession, "archives")
    write_archives(pages, path, min_bytes)
    return archive_index(pages.sparkSession, path, pages.schema["page_id"].dataType.simpleString())
