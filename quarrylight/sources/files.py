"""Files as DataFrames: whole texts, checked as UTF-8, and lines of JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylight.functions.text import clock, short_hash, subtitle_time


def texts(spark: SparkSession, path: str, glob: str = "*.{txt,md}") -> DataFrame:
    """(origin, name, text, valid, key): every file below path; a byte-order mark and outer blanks go, breaks become line feeds.

    Files that aren't UTF-8 have valid false and a null text, so that one bad file doesn't end a job.
    """
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    valid = F.is_valid_utf8(F.col("content").cast("string"))
    text = F.regexp_replace(F.regexp_replace(F.col("content").cast("string"), "^\\x{FEFF}", ""), r"\r\n?", "\n")
    out = raw.select(F.col("path").alias("origin"), F.element_at(F.split("path", "/"), -1).alias("name"), F.when(valid, F.regexp_replace(text, r"^\s+|\s+$", "")).alias("text"), valid.alias("valid"))
    return out.withColumn("key", short_hash(F.col("origin"), 20))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON-lines file; blank lines and lines that start with # are passed over."""
    kept = spark.read.text(path).where(~F.col("value").rlike(r"^\s*(#.*)?$"))
    return kept.select(F.from_json("value", schema).alias("r")).select("r.*")


#: Fixed value: the sentence of a schedule text that names it.
TITLE = r"该进度计划的完整名称为(.+?)[。\n]"


def versioned_documents(spark: SparkSession, root: str, version: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents, errors) of the .txt files below root, or below one of its version folders.

    documents: document_id, source (path below root), source_name, corpus_version (its first folder), title (as the text
    names it, or the file's stem), text, source_sha256, byte_size, char_count. errors: source and reason; files that
    aren't UTF-8 or hold nothing are told apart and stop no job.
    """
    base = f"{root.rstrip('/')}/{version}" if version else root.rstrip("/")
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(base)
    place = F.element_at(F.split("path", f"/{root.rstrip('/').rsplit('/', 1)[-1]}/"), -1)
    text = F.regexp_replace(F.regexp_replace(F.col("content").cast("string"), "^\\x{FEFF}", ""), r"\r\n?", "\n")
    rows = raw.select(place.alias("source"), F.is_valid_utf8(F.col("content").cast("string")).alias("__valid"), text.alias("__raw"), F.sha2("content", 256).alias("source_sha256"), F.octet_length("content").cast("long").alias("byte_size"))
    rows = rows.withColumn("text", F.when(F.col("__valid"), F.regexp_replace("__raw", r"^\s+|\s+$", "")))
    reason = F.when(~F.col("__valid"), "not UTF-8").when(F.col("text") == "", "empty")
    name = F.element_at(F.split("source", "/"), -1)
    named = F.trim(F.regexp_extract("text", TITLE, 1))
    identity = F.to_json(F.struct("source", "source_sha256"))  # keys in order, quotes and backslashes of names escaped
    good = rows.where(reason.isNull()).select(
        F.concat(F.lit("txt-"), short_hash(identity, 24)).alias("document_id"),
        "source",
        name.alias("source_name"),
        F.when(F.contains("source", F.lit("/")), F.substring_index("source", "/", 1)).otherwise("").alias("corpus_version"),
        F.when(named != "", named).otherwise(F.regexp_replace(name, r"\.[^.]*$", "")).alias("title"),
        "text",
        "source_sha256",
        "byte_size",
        F.length("text").cast("long").alias("char_count"),
    )
    return good, rows.where(reason.isNotNull()).select("source", reason.alias("reason"))


def eval_cases(spark: SparkSession, path: str) -> DataFrame:
    """(id, query, expected_source, expected_terms, expected_status) of a JSON-lines file; lines without a query are refused when read."""
    schema = "id string, query string, expected_source string, expected_terms array<string>, expected_status string"
    rows = json_lines(spark, path, schema)
    if rows.isEmpty():
        raise ValueError(f"no evaluation cases in {path}")
    query = F.when(F.coalesce(F.trim("query"), F.lit("")) != "", F.col("query")).otherwise(F.raise_error(F.lit("an evaluation case needs a query")))
    return rows.withColumn("query", query)


def chunk_corpus(spark: SparkSession, path: str) -> DataFrame:
    """(chunk_id, chunk_type, source, page, text, metadata: JSON) of a JSON-lines file of chunks; lines without a text are left out.

    What a chunk's metadata says of its id, type, source (source_pdf) and page counts before what stands beside it.
    """
    told = spark.read.text(path).where(F.col("value").rlike(r"\S")).select(F.parse_json("value").alias("v"))
    first = lambda inner, outer, kind="string": F.coalesce(F.try_variant_get("v", f"$.metadata.{inner}", kind), F.try_variant_get("v", f"$.{outer}", kind))
    rows = told.select(
        first("chunk_id", "id").alias("chunk_id"),
        first("chunk_type", "chunk_type").alias("chunk_type"),
        first("source_pdf", "source_pdf").alias("source"),
        first("page", "page", "int").alias("page"),
        F.try_variant_get("v", "$.text", "string").alias("text"),
        F.to_json(F.try_variant_get("v", "$.metadata", "variant")).alias("metadata"),
    )
    return rows.where(F.coalesce("text", F.lit("")) != "")


def write_json_lines(rows: DataFrame, path: str, compression: str = "none") -> None:
    """A JSON object for each row, a line each, in as many files as there are partitions."""
    rows.write.option("compression", compression).option("ignoreNullFields", "false").json(path)


def transcripts(segments: DataFrame, media_col: str = "media", order_col: str = "pos") -> DataFrame:
    """(media, markdown, txt, srt): a medium's segments (start, end, text) in order, as the three forms of a transcript."""
    rows = segments.select(media_col, F.struct(order_col, clock(F.col("start")).alias("a"), clock(F.col("end")).alias("b"), subtitle_time(F.col("start")).alias("c"), subtitle_time(F.col("end")).alias("d"), "text").alias("s"))
    rows = rows.groupBy(media_col).agg(F.sort_array(F.collect_list("s")).alias("s"))  # one transcript
    joined = lambda glue, f: F.concat(F.array_join(F.transform("s", f), glue), F.lit("\n"))
    return rows.select(
        media_col,
        joined("\n\n", lambda s: F.concat(F.lit("### "), s["a"], F.lit(" - "), s["b"], F.lit("\n\n"), s["text"])).alias("markdown"),
        joined("\n", lambda s: F.concat(F.lit("["), s["a"], F.lit(" - "), s["b"], F.lit("] "), s["text"])).alias("txt"),
        joined("\n\n", lambda s, k: F.concat((k + 1).cast("string"), F.lit("\n"), s["c"], F.lit(" --> "), s["d"], F.lit("\n"), s["text"])).alias("srt"),
    )
