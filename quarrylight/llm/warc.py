"""A content-addressed WARC archive.

Payload bytes are stored once, in a table keyed by their SHA-256; the exact header block of every record (its WARC header
and, for responses, the HTTP header that opens its block) is kept in a second table; records are put together again by
joining the two. Of pages with equal payloads the one with the smallest id is written as a response, the others as
revisits that refer to it. Equal digests are taken as equal payloads only after length and SHA-1 have been found equal
too; what is read back is taken from the rebuilt records, whose length and digests are checked against their bytes.

Defined cases: a null payload counts as empty; null ids come last in the order and have an empty id in their headers;
of rows that repeat id, url and payload the first is the response if any is; payloads under ``min_bytes`` are always
responses; very long payloads are stored and rebuilt whole; an empty table gives an empty archive; input columns besides
the three named are neither read nor stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, scratch_path, spread_join

CRLF = "\r\n"
#: The HTTP header that opens the block of a response, before its payload.
HTTP = f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: each 5 hex digits are 20 bits, hence 4 base32 digits."""
    digest = F.sha1(payload)
    part = lambda k: F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0")
    return F.translate(F.upper(F.concat(*map(part, range(8)))), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def http_head() -> Column:
    return F.concat(F.lit(HTTP), F.col("__bytes").cast("string"), F.lit(CRLF * 2))


def header_block(date: str) -> Column:
    """The exact header lines of a record, from the columns that ``write`` prepares, each header with the blank line after it."""
    own = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("__id").cast("string"), F.lit("")), F.lit(":"), F.col("__copy").cast("string"), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    revisit = F.col("__type") == "revisit"
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.col("__type")),
        line("WARC-Record-ID", own),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.regexp_replace(F.coalesce(F.col("__url"), F.lit("")), r"[\r\n]", "")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("__sha1"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("__first").cast("string"), F.lit("")), F.lit(":1>"))), line("WARC-Profile", F.lit(PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise((F.octet_length(http_head()) + F.col("__bytes")).cast("string"))),
        F.lit(CRLF),
        F.when(revisit, F.lit("")).otherwise(http_head()),
    )


def write(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Writes path/payloads (sha256, payload) and path/headers (page id, sha256, header)."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    keyed = pages.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"), payload.alias("__p"))
    keyed = keyed.withColumn("__sha", F.sha2("__p", 256))
    narrow = materialize(keyed.select("__id", "__url", "__sha", base32_sha1(F.col("__p")).alias("__sha1"), F.octet_length("__p").cast("long").alias("__bytes")), "warc-keys")
    copies = narrow.groupBy("__id", "__url", "__sha", "__sha1", "__bytes").agg(F.count("*").cast("int").alias("__m"))
    place = F.struct(F.col("__id").isNull().alias("a"), F.col("__id").alias("b"), F.col("__url").isNull().alias("c"), F.col("__url").alias("d"))
    same = (F.min("__sha1") == F.max("__sha1")) & (F.min("__bytes") == F.max("__bytes"))
    first = copies.groupBy("__sha").agg(F.min(place).alias("__place"), F.when(same, True).otherwise(F.raise_error(F.lit("equal SHA-256 of unequal payloads"))).alias("__verified"), F.count("*").alias("__rows"))
    first = materialize(first, "warc-first")
    records = spread_join(copies, first, ["__sha"], "__rows").where("__verified").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__m"))))
    response = (F.col("__bytes") < min_bytes) | (place.eqNullSafe(F.col("__place")) & (F.col("__copy") == 1))
    records = records.withColumn("__type", F.when(response, "response").otherwise("revisit")).withColumn("__first", F.col("__place.b"))
    records.select(F.col("__id").alias("page_id"), F.col("__sha").alias("sha256"), header_block(date).alias("header")).write.parquet(f"{path}/headers")
    keyed.groupBy("__sha").agg(F.any_value("__p").alias("__p")).select(F.col("__sha").alias("sha256"), F.col("__p").cast("binary").alias("payload")).write.parquet(f"{path}/payloads")


def field(name: str, head: str = "header") -> Column:
    return F.regexp_extract(head, rf"(?m)^{name}: ([^\r\n]*)", 1)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record, rebuilt: (page_id, sha256, header, record: its header and block as bytes, and the two line ends after it).

    Responses join their payload; a revisit's block is empty, so it needs no payload and none is sent to it.
    """
    headers = spark.read.parquet(f"{path}/headers")
    payloads = spark.read.parquet(f"{path}/payloads")
    record = lambda block: F.concat(F.col("header").cast("binary"), block, F.lit(b"\r\n\r\n")).alias("record")
    revisit = field("WARC-Type") == "revisit"
    own = headers.where(~revisit)
    uses = materialize(own.groupBy("sha256").agg(F.count("*").alias("__uses")), "warc-uses")
    whole = spread_join(own, payloads.join(uses, "sha256"), ["sha256"], "__uses", "left").select("page_id", "sha256", "header", record(F.col("payload")))
    return whole.unionByName(headers.where(revisit).select("page_id", "sha256", "header", record(F.lit(b""))))


def parsed(records: DataFrame) -> DataFrame:
    """(page_id, sha256, head, block) of rebuilt records: the header ends at the first empty line, the block is as long as it says.

    A record that isn't as long as its header says, or doesn't end in two line ends, stops the job.
    """
    head = F.substring_index(F.col("record").cast("string"), CRLF * 2, 1)
    rows = records.select("page_id", "sha256", "record", head.alias("head")).withColumn("__at", F.octet_length("head") + 4)
    rows = rows.withColumn("__length", field("Content-Length", "head").cast("int"))
    whole = (F.octet_length("record") == F.col("__at") + F.col("__length") + 4) & (F.substring(F.col("record"), F.col("__at") + F.col("__length") + 1, F.lit(4)) == F.lit(b"\r\n\r\n"))
    block = F.substring(F.col("record"), F.col("__at") + 1, F.col("__length"))
    return rows.select("page_id", "sha256", "head", F.when(F.coalesce(whole, F.lit(False)), block).otherwise(F.raise_error(F.lit("a record is not as long as its header says")).cast("binary")).alias("block"))


def read_index(spark: SparkSession, path: str, id_type: str = "long") -> DataFrame:
    """Reads the archive back: (page_id, payload_bytes, payload_digest, record_type, refers_to), from the rebuilt records.

    A response's payload is what follows the HTTP header in its block, digested anew; a revisit has the payload of the
    response with its digest. What does not fit the headers stops the job.
    """
    rows = parsed(read_records(spark, path)).withColumn("record_type", field("WARC-Type", "head")).withColumn("__declared", field("WARC-Payload-Digest", "head"))
    refers = F.regexp_extract(field("WARC-Refers-To", "head"), "^<urn:page:(.*):[0-9]+>$", 1)
    rows = rows.withColumn("refers_to", F.when(refers != "", refers).cast(id_type))
    http = F.substring_index(F.col("block").cast("string"), CRLF * 2, 1)
    payload = F.when(F.col("record_type") == "response", F.substring(F.col("block"), F.octet_length(http) + 5, F.octet_length("block")))
    rows = rows.select("page_id", "sha256", "record_type", "refers_to", "__declared", payload.alias("__payload"))
    rows = rows.withColumn("__intact", F.sha2("__payload", 256) == F.col("sha256")).select("page_id", "sha256", "record_type", "refers_to", "__declared", "__intact", F.octet_length("__payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("__payload")).alias("payload_digest"))
    rows = materialize(rows, "warc-records")
    responses, revisits = rows.where("record_type = 'response'"), rows.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest", "__intact")
    first = responses.groupBy("sha256").agg(F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest"), F.bool_and("__intact").alias("__intact"))
    uses = revisits.groupBy("sha256").agg(F.count("*").alias("__uses"))
    back = spread_join(revisits, materialize(first.join(uses, "sha256"), "warc-referred"), ["sha256"], "__uses", "left")
    good = F.coalesce(F.col("__intact") & (F.col("__declared") == F.concat(F.lit("sha1:"), F.col("payload_digest"))), F.lit(False))
    digest = F.when(good, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a stored payload does not fit its record")))
    columns = ["page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to"]
    return responses.select(*columns).unionByName(back.select(*columns))


def export(spark: SparkSession, path: str, to: str) -> None:
    """Writes the records as gzipped WARC files. Each row of the text writer ends with what ends a WARC record."""
    records = read_records(spark, path)
    text = F.substring(F.col("record").cast("string"), 1, F.length(F.col("record").cast("string")) - 4)
    records.select(text.alias("value")).write.option("lineSep", CRLF * 2).option("compression", "gzip").text(to)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return read_index(spark, path)


#: DuckDB has no base32 and (in this build) no SHA-1; tests hold the query against hashlib.
ORACLE_SQL = None
