"""WARC archives: writing captures, reading records, and assembling transactions.

Every row becomes a capture of three records: a request, a response (or a revisit of an earlier response with the same
payload) and a metadata record; response and metadata name the request in WARC-Concurrent-To. Records are written by Spark's
text writer with an empty line after each, gzipped, so a file is a plain WARC file, and tasks that are run again replace
their own output.

Reading splits files at the start of records. The first header of every record written here is WARC-Warcinfo-ID with a random id
of the archive, so nothing in a payload can look like a record's start; for other archives the version line alone is
taken, and a record whose block is not as long as its Content-Length says is an error, never a wrong row.

Assembly joins request, response and metadata through the identifiers and gives one nested row per capture.
"""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..workspace import new_folder
from .tables import held, table

VERSION = "WARC/1.1\r\n"
NEWLINE = "\r\n"
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
LEAST_BYTES = 100  # payloads under this are written out each time
FILE_RECORDS = 30_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def urn(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def record(archive: str, kind: Column | str, record_id: Column, url: Column, block: Column, mime: str, *more: Column) -> Column:
    """A record as text; more: further header lines, null ones are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    line = lambda name, value: F.concat(F.lit(name + ": "), value)
    lines = [line("WARC-Type", kind), line("WARC-Record-ID", record_id), F.lit(f"WARC-Date: {DATE}"), line("WARC-Target-URI", url),
             *more, F.lit(f"Content-Type: {mime}"), line("Content-Length", F.octet_length(block).cast("string"))]
    return F.concat(F.lit(f"{VERSION}WARC-Warcinfo-ID: {archive}{NEWLINE}"), F.concat_ws(NEWLINE, *lines), F.lit(END), block)


def with_revisits(pages: DataFrame, key: str, payload: str, least: int = LEAST_BYTES) -> DataFrame:
    """Adds digest, bytes and first: of rows with equal payloads of at least ``least`` bytes, the smallest key if there are several."""
    rows = pages.withColumn("digest", F.sha2(F.col(payload), 256)).withColumn("bytes", F.octet_length(payload).cast("bigint"))
    several = rows.where(F.col("bytes") >= least).groupBy("digest").agg(F.min(key).alias("first"), F.count("*").alias("copies")).where("copies > 1")
    return rows.join(several.drop("copies"), "digest", "left")


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html") -> str:
    """Writes one capture per row and returns the archive's id. A null payload is empty, a null address too.

    Of rows with equal payloads that are long enough, those with the smallest key are responses and the others revisits
    (a null key never is the smallest while there is another). Repeated rows are captures of their own.
    """
    archive = f"<urn:uuid:{uuid.uuid4()}>"
    rows = pages.select(F.col(key).alias("k"), F.regexp_replace(F.coalesce(F.col(url), F.lit("")), "[\r\n]", "").alias("url"),
                        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"), F.monotonically_increasing_id().alias("row"))
    rows = with_revisits(rows, "k", "payload")
    revisit = F.col("first").isNotNull() & ~F.col("k").eqNullSafe(F.col("first"))
    request_id = urn(F.lit("request" + archive), F.col("row"), F.col("k"))
    own_id = lambda k: urn(F.lit("response" + archive), k, F.col("digest"))
    rows = rows.select("*", revisit.alias("revisit"), request_id.alias("request_id"))
    host, path = F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    get = F.concat(F.lit("GET "), F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)), F.lit(f" HTTP/1.1{NEWLINE}Host: "), host, F.lit(END))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{NEWLINE}Content-Type: text/html; charset=utf-8{NEWLINE}Content-Length: "), F.col("bytes").cast("string"), F.lit(END))
    body = F.when(F.col("revisit"), head).otherwise(F.concat(head, F.col("payload").cast("string")))
    about = F.concat(F.lit("key: "), F.coalesce(F.col("k").cast("string"), F.lit("")), F.lit(NEWLINE))
    together = F.concat(F.lit("WARC-Concurrent-To: "), F.col("request_id"))
    of_revisit = lambda text: F.when(F.col("revisit"), text)
    u = F.col("url")
    records = F.array(
        record(archive, "request", F.col("request_id"), u, get, "application/http;msgtype=request"),
        record(archive, F.when(F.col("revisit"), "revisit").otherwise("response"),
               F.when(F.col("revisit"), urn(F.lit("revisit"), F.col("request_id"))).otherwise(own_id(F.col("k"))), u, body, "application/http;msgtype=response", together,
               F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")), of_revisit(F.lit(f"WARC-Profile: {PROFILE}")),
               of_revisit(F.concat(F.lit("WARC-Refers-To: "), own_id(F.col("first"))))),
        record(archive, "metadata", urn(F.lit("metadata"), F.col("request_id")), u, about, "application/warc-fields", together))
    text = rows.select(F.explode(records).alias("value"))
    info = pages.sparkSession.range(1).select(record(archive, "warcinfo", F.lit(archive), F.lit(""), F.lit(f"software: stockwright{NEWLINE}format: WARC File Format 1.1{NEWLINE}"), "application/warc-fields").alias("value"))
    for name, df in (("info", info), ("records", text)):
        df.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(f"{folder}/{name}")
    return archive


def read(spark: SparkSession, folder: str, archive: str | None = None) -> DataFrame:
    """(type, record_id, concurrent_to, refers_to, url, digest, block) of all records under a folder; block: binary."""
    start = VERSION + (f"WARC-Warcinfo-ID: {archive}{NEWLINE}" if archive else "")
    # The separator is the start of a record alone: with the empty line before it, a record that ends in an empty line
    # itself is missed where the reader's buffer ends between the two.
    raw = spark.read.option("lineSep", start).option("recursiveFileLookup", "true").text(folder).where("value <> ''")
    raw = raw.select("value", F.substring_index("value", END, 1).alias("head"))
    field = lambda name: F.regexp_extract("head", rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)
    maybe = lambda name: F.nullif(field(name), F.lit(""))
    length = F.try_to_number(field("Content-Length"), F.lit("999999999999")).cast("int")
    rows = raw.select(field("WARC-Type").alias("type"), maybe("WARC-Record-ID").alias("record_id"), maybe("WARC-Concurrent-To").alias("concurrent_to"),
                      maybe("WARC-Refers-To").alias("refers_to"), field("WARC-Target-URI").alias("url"),
                      F.nullif(F.regexp_replace(field("WARC-Payload-Digest"), "^sha256:", ""), F.lit("")).alias("digest"), length.alias("length"),
                      F.expr("substring(cast(value as binary), octet_length(head) + 5)").alias("rest"))
    whole = F.expr("substring(rest, length + 1)").isin(END.encode(), b"")  # what follows the block
    block = F.when((F.octet_length("rest") >= F.col("length")) & whole, F.expr("substring(rest, 1, length)"))
    return rows.select("type", "record_id", "concurrent_to", "refers_to", "url", "digest",
                       F.coalesce(block, F.raise_error(F.concat(F.lit("a record's block is not as long as its Content-Length: "), F.coalesce("record_id", F.lit("?")))).cast("binary")).alias("block"))


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: request, response (or revisit) and metadata as structs; request and metadata may be missing.

    A response without WARC-Concurrent-To is a capture of its own.
    """
    http = F.substring_index(F.col("block").cast("string"), END, 1)
    responses = records.where(F.col("type").isin("response", "revisit")).select(
        "type", "record_id", "concurrent_to", "refers_to", "url", F.col("digest").alias("header_digest"),
        F.regexp_extract(http, r"(?im)^Content-Length:[ \t]*(\d+)", 1).alias("http_length"), F.expr(r"substring(block, octet_length(substring_index(cast(block as string), '\r\n\r\n', 1)) + 5)").alias("payload"))
    whole = F.col("type") == "response"
    responses = responses.select(
        "concurrent_to", "type", "record_id", "refers_to", "url", "payload",
        F.when(whole, F.octet_length("payload").cast("bigint")).otherwise(F.nullif("http_length", F.lit("")).cast("bigint")).alias("bytes"),
        F.when(whole, F.sha2("payload", 256)).otherwise(F.col("header_digest")).alias("digest"))
    requests = records.where("type = 'request'").select(F.col("record_id").alias("request_id"), F.col("block").alias("request_block"))
    about = records.where("type = 'metadata'").select(F.col("concurrent_to").alias("about_id"), F.col("block").cast("string").alias("about"))
    joined = responses.join(requests, F.col("concurrent_to") == F.col("request_id"), "left").join(about, F.col("concurrent_to") == F.col("about_id"), "left")
    return joined.select(
        F.struct("record_id", "type", "refers_to", "url", "bytes", "digest", "payload").alias("response"),
        F.struct(F.col("request_id").alias("record_id"), F.col("request_block").alias("block")).alias("request"),
        F.struct(F.nullif(F.regexp_extract("about", r"(?m)^key:[ \t]*([^\r\n]*)", 1), F.lit("")).alias("key"), F.col("about").alias("fields")).alias("metadata"))


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    place = new_folder(spark, "warc")
    archive = write(pages, place)
    captures = assemble(read(spark, f"{place}/records", archive)).select(
        F.col("metadata.key").cast("bigint").alias("page_id"), F.col("response.record_id").alias("id"), F.col("response.refers_to").alias("to"),
        F.col("response.bytes").alias("payload_bytes"), F.col("response.digest").alias("payload_digest"), F.col("response.type").alias("record_type"))
    captures = held(captures, "captures")
    # Only responses that are referred to are looked up.
    wanted = captures.where("to is not null").select(F.col("to").alias("id")).distinct()
    named = captures.where("record_type = 'response'").join(wanted, "id").groupBy("id").agg(F.min("page_id").alias("refers_to"))
    return captures.join(named.withColumnRenamed("id", "to"), "to", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP2_SQL = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (
  SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest HAVING count(*) > 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
