"""WARC transactions: write captures, read archives back, assemble captures.

Every capture becomes a request, a response (or revisit) and a metadata record.
Request and metadata name the response in ``WARC-Concurrent-To``; reading joins
them through that identifier into one nested row per capture.  Blocks of requests and
responses are HTTP messages; a response's payload is its message's body.

Of payloads equal in length, SHA-1 and SHA-256 with at least ``REVISIT_BYTES``
bytes, one row with the largest id is the response (of several, the first staged one;
null ids are the smallest) and the others revisit it, by its record id in
``WARC-Refers-To``.  Revisits are found on digests, lengths and ids alone.  The table of
repeated payloads joins as a broadcast up to ``BROADCAST_ROWS`` rows, and through a
shuffle beyond it.

Archives are gzip-compressed WARC 1.1 files, written by Spark's text writer in the
shared folder.  A file holds at most ``FILE_BYTES`` of payloads (or one capture): larger
payloads go to files of fewer captures, by power of two.  Files are read as streams and
cut by the stated content lengths, so payloads may hold any text.

Null html is an empty payload; null urls are written without a target; ids are
written as text, null ids as an absent header; rows with repeated ids are
captures of their own; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofan.llm.common import drop_path, drop_written, scratch_path, written

REVISIT_BYTES = 1000
FILE_BYTES, FILE_CAPTURES = 256 << 20, 1024
BROADCAST_ROWS = 100_000
END = "\r\n"
RECORDS = (
    "record_id string, kind string, concurrent_to string, target string, page_id long, refers_to long, refers_to_id string, "
    "payload_digest string, computed_sha1 string, payload_bytes long, block binary"
)


def staged(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, html, payload_bytes, payload_digest, strong`` and a row number
    ``u``, written: digests and row numbers are taken once."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"))
    raw = F.col("html").cast("binary")
    return written(rows.select(
        "*", F.octet_length("html").cast("long").alias("payload_bytes"), F.sha1(raw).alias("payload_digest"),
        F.sha2(raw, 256).alias("strong"), F.monotonically_increasing_id().alias("u"),
    ), "warc-staged", compression="zstd")


def with_revisits(rows: DataFrame) -> DataFrame:
    """``rows`` and, for a revisit, the response's row number ``to`` and id ``refers_to``."""
    same = ["strong", "payload_digest", "payload_bytes"]
    repeated = written(
        rows.filter(F.col("payload_bytes") >= REVISIT_BYTES).groupBy(*same)
        .agg(F.max(F.struct("page_id", (-F.col("u")).alias("back"))).alias("last"), F.count("*").alias("n")).filter("n > 1")
        .select(*same, F.col("last.page_id").alias("last_id"), (-F.col("last.back")).alias("last_u")), "warc-repeated")
    small = repeated.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    joined = rows.join(F.broadcast(repeated) if small else repeated.hint("merge"), same, "left")
    other = F.col("last_u") != F.col("u")
    return joined.select(*rows.columns, F.when(other, F.col("last_u")).alias("to"), F.when(other, F.col("last_id")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, **columns: str) -> None:
    """Write the records of all pages as WARC files below ``path``."""
    stage = staged(pages, **columns)
    rows = with_revisits(stage)
    salt = uuid.uuid4().hex
    hex_of = lambda u: F.md5(F.concat(F.lit(salt), u.cast("string")).cast("binary"))
    ident = lambda u, part="": F.concat(F.lit("<urn:uuid:"), F.regexp_replace(hex_of(u), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-"), F.lit(f"{part}>"))
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit(END))).otherwise(F.lit(""))
    # Line breaks cannot stand in a header value.
    url = F.regexp_replace("url", r"[\r\n]+", " ")
    date = F.lit("1970-01-01T00:00:00Z")

    def record(kind, part: str, body, kind_of_body: str, *more) -> F.Column:
        head = [F.lit("WARC/1.1" + END), line("WARC-Type", kind), line("WARC-Record-ID", ident(F.col("u"), part)), line("WARC-Date", date), line("WARC-Target-URI", url), line("Content-Type", F.lit(kind_of_body)), *more]
        return F.concat(*head, line("Content-Length", F.octet_length(body).cast("string")), F.lit(END), body)

    seen = F.col("to").isNotNull()
    size = F.col("payload_bytes").cast("string")
    message = F.concat(F.lit("HTTP/1.1 200 OK" + END), line("Content-Type", F.lit("text/html; charset=utf-8")), line("Content-Length", size), F.lit(END))
    answer = record(
        F.when(seen, "revisit").otherwise("response"), "", F.when(seen, message).otherwise(F.concat(message, "html")), "application/http; msgtype=response",
        line("X-Page-ID", F.col("page_id").cast("string")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Refers-To", F.when(seen, ident(F.col("to")))),
        line("X-Refers-To-Page", F.col("refers_to").cast("string")),
        line("WARC-Profile", F.when(seen, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
    )
    to = line("WARC-Concurrent-To", ident(F.col("u")))
    place = F.regexp_extract(url, r"^[^:]*://([^/?#]*)([^#]*)", 2)
    ask = F.concat(F.lit("GET "), F.when(place.startswith("/"), place).otherwise(F.concat(F.lit("/"), F.coalesce(place, F.lit("")))), F.lit(" HTTP/1.1" + END), line("Host", F.regexp_extract(url, r"^[^:]*://([^/?#]*)", 1)), F.lit(END))
    request = record(F.lit("request"), "-q", ask, "application/http; msgtype=request", to)
    metadata = record(F.lit("metadata"), "-m", F.concat(F.lit("payload-bytes: "), size), "application/warc-fields", to)
    # Size classes: payloads of class k have at most 2^k times the mean share of a file.
    share = F.lit(FILE_BYTES // FILE_CAPTURES)
    level = F.when(F.col("payload_bytes") <= share, 0).otherwise(F.least(F.ceil(F.log2(F.col("payload_bytes") / share)), F.lit(FILE_CAPTURES.bit_length() - 1))).cast("int")
    for k in sorted(r[0] for r in stage.select(level.alias("k")).distinct().collect()):
        own = rows.filter(level == k).select(F.explode(F.array(request, answer, metadata)).alias("value"))
        own.write.option("lineSep", END + END).option("compression", "gzip").option("maxRecordsPerFile", 3 * max(1, FILE_CAPTURES >> k)).text(f"{path}/size-{k}")
    drop_written(stage)


def parse(data: bytes) -> Iterator[dict]:
    """The records of one archive, plain or gzip, by their content lengths; one record
    is held at a time."""
    raw = io.BytesIO(data)
    stream = io.BufferedReader(gzip.GzipFile(fileobj=raw)) if data[:2] == b"\x1f\x8b" else raw
    while first := stream.readline():
        if not first.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at {first[:40]!r}")
        head = {}
        while (text := stream.readline().decode("utf-8", "replace").removesuffix(END)):
            name, _, value = text.partition(": ")
            head[name.lower()] = value
        yield head | {"block": stream.read(int(head["content-length"]))}
        stream.read(2 * len(END))


def payload(record: dict) -> bytes:
    """The body of a record's HTTP message, or the block of another record."""
    block = record["block"]
    return block.partition((END + END).encode())[2] if record.get("content-type", "").startswith("application/http") else block


def read_records(spark, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the archives below ``path``.  A response's ``payload_bytes``
    and ``computed_sha1`` are those of the payload read, a metadata record's
    ``payload_bytes`` is the stated one; ``payloads`` keeps the responses' blocks."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(rows: list[dict]) -> pa.RecordBatch:
            col = lambda f, t: pa.array([f(r) for r in rows], t)
            number = lambda k: lambda r: int(r[k]) if k in r else None
            return pa.RecordBatch.from_arrays([
                col(lambda r: r.get("warc-record-id"), pa.string()), col(lambda r: r["warc-type"], pa.string()),
                col(lambda r: r.get("warc-concurrent-to"), pa.string()), col(lambda r: r.get("warc-target-uri"), pa.string()),
                col(number("x-page-id"), pa.int64()), col(number("x-refers-to-page"), pa.int64()), col(lambda r: r.get("warc-refers-to"), pa.string()),
                col(lambda r: r.get("warc-payload-digest", "").removeprefix("sha1:") or None, pa.string()),
                col(lambda r: r["sha1"], pa.string()), col(lambda r: r["size"], pa.int64()), col(lambda r: r["block"], pa.binary()),
            ], names=[x.split()[0] for x in RECORDS.split(", ")])

        for batch in batches:
            for content in batch.column("content"):
                rows: list[dict] = []
                held = 0
                for r in parse(content.as_buffer().to_pybytes()):
                    kind = r["warc-type"]
                    r["sha1"], r["size"] = None, None
                    if kind == "response":
                        body = payload(r)
                        r["sha1"], r["size"] = hashlib.sha1(body).hexdigest(), len(body)
                        if not payloads:
                            r["block"] = None
                    elif kind == "metadata":
                        r["size"] = int(r["block"].rpartition(b": ")[2])
                    rows.append(r)
                    held += len(r["block"] or b"")
                    if held > 8 << 20 or len(rows) == 2000:
                        yield emit(rows)
                        rows, held = [], 0
                if rows:
                    yield emit(rows)

    return files.mapInArrow(run, RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``capture_id, response, request, metadata``."""
    body = F.struct(*[c for c in records.columns if c != "concurrent_to"])
    only = lambda *kinds: F.first(F.when(F.col("kind").isin(*kinds), body), ignorenulls=True)
    return records.groupBy(F.coalesce("concurrent_to", "record_id").alias("capture_id")).agg(
        only("response", "revisit").alias("response"), only("request").alias("request"), only("metadata").alias("metadata"),
    )


def round_trip(pages: DataFrame, **columns: str) -> DataFrame:
    """Write all pages, read the archives back and return ``page_id,
    payload_bytes, payload_digest, record_type, refers_to`` and whether the
    payload read back has the stated digest (null for revisits).  The rows are a written
    table; the archives are deleted."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, **columns)
    if pages.isEmpty():
        got = assemble(spark.createDataFrame([], RECORDS))
    else:
        got = assemble(read_records(spark, path, payloads=False))
    out = written(got.select(
        F.col("response.page_id").alias("page_id"), F.coalesce("response.payload_bytes", "metadata.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.kind").alias("record_type"),
        F.col("response.refers_to").alias("refers_to"), (F.col("response.computed_sha1") == F.col("response.payload_digest")).alias("digest_ok"),
    ), "warc-captures")
    drop_path(spark, path)
    return out
