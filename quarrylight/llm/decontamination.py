"""Benchmark decontamination by winnowing, in DataFrame functions only.

A window is ``width`` consecutive words of a benchmark item, or all words of a shorter item. Its fingerprint is the
minimum of the hashes of its k-grams; a document's fingerprints are the minima of its sliding windows of that length.
Equal windows have equal fingerprints, so every shared window is among the hits of the fingerprint
join: first against a bit table of fixed size, in the scan of the texts, then by the words of the windows that a hit
stands for (the extension), which must be equal in full. What is shuffled are windows that survive the bit table, and one
narrow row a document.

Windows that occur in the same items form a class; a document's items are found once for each distinct set of classes,
so that a passage of many items in many documents never meets as pairs of both.

Defined cases: null and empty texts, and texts of separators only, have no words and no hits; a null text of an item has
no windows; an item with a null id marks words but counts for no item; item ids that repeat count once; document ids may
repeat or be null, each input row has its own result; an empty benchmark hits nothing and an empty table of documents
gives an empty result; texts of any length are taken whole; ties between k-gram hashes are one fingerprint; input columns
besides id and text are neither read nor returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, materialize, spread_join, text_or_empty

WIDTH = 10
#: Words of a k-gram: with windows of 10 words, the minimum of 5 hashes; a third of them stay as fingerprints.
KGRAM = 6
#: Bits of a bucket's number in the bit table: at most 2**20 rows of 64 bits are broadcast, whatever the benchmark's size.
BUCKET_BITS = 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def with_words(df: DataFrame, text: Column) -> DataFrame:
    """Adds __w, the lower-case words of a text, and __h, a zero and then the hashes of the words."""
    ascii_only = F.octet_length(text) == F.length(text)  # there lower() changes A-Z and nothing else
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    parts = df.withColumn("__s", F.split(lowered, SEPARATORS))
    lead, trail = [(F.element_at("__s", at) == "").cast("int") for at in (1, -1)]
    words = parts.withColumn("__w", F.slice("__s", lead + 1, F.greatest(F.lit(0), F.size("__s") - lead - trail))).drop("__s")
    return words.withColumn("__h", F.concat(F.array(F.lit(0).cast("long")), F.transform("__w", lambda x: F.xxhash64(x))))


def fingerprint(at: Column, n: int, kgram: int) -> Column:
    """The minimum hash of the k-grams of the window of n words that begins at place ``at`` of __h."""
    k = min(kgram, n)
    grams = [F.xxhash64(*(F.get("__h", at + (j + d)) for d in range(k))) for j in range(n - k + 1)]
    return F.least(*grams) if len(grams) > 1 else grams[0]


def _slot(minimum: Column, n: Column) -> tuple[Column, Column]:
    """Bucket and bit of a fingerprint; it is hashed again, since minima are low."""
    again = F.xxhash64(minimum, n)
    return F.shiftrightunsigned(again, 64 - BUCKET_BITS), F.call_function("shiftleft", F.lit(1).cast("long"), again.bitwiseAND(F.lit(63)).cast("int"))


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, width: int, kgram: int) -> tuple[DataFrame, DataFrame, list[int]]:
    """(n, window, class, bucket, bit) of the distinct windows, (class, item), and the lengths of windows that occur."""
    rows = with_words(items.select(F.col(id_col).cast("string").alias("item"), text_or_empty(text_col).alias("__text")), F.col("__text"))
    rows = rows.where(F.size("__w") > 0).withColumn("n", F.least(F.lit(width), F.size("__w")))
    cut = rows.select("item", "n", "__w", F.explode(F.sequence(F.lit(1), F.size("__w") - F.col("n") + 1)).alias("at"))
    cut = cut.select("item", "n", F.array_join(F.slice("__w", F.col("at"), F.col("n")), " ").alias("window"))
    pairs = materialize(cut.distinct(), "bench-pairs")
    lengths = sorted(r.n for r in pairs.select("n").distinct().collect())  # at most `width` numbers
    classes = pairs.groupBy("n", "window").agg(F.count("*").alias("c"), F.bit_xor(F.xxhash64("item")).alias("x"), F.bit_xor(F.xxhash64("item", F.lit(1))).alias("y"))
    classes = classes.select("n", "window", F.concat_ws(".", "c", "x", "y").alias("class"))
    hashed = with_words(classes, F.col("window"))
    minimum = F.coalesce(F.lit(None).cast("long"), *(F.when(F.col("n") == n, fingerprint(F.lit(1), n, kgram)) for n in lengths))
    bucket, bit = _slot(minimum, F.col("n"))
    windows = materialize(hashed.select("n", "window", "class", bucket.alias("bucket"), bit.alias("bit")), "bench-windows")
    members = pairs.join(windows, ["n", "window"]).where("item is not null").select("class", "item").distinct()
    return windows, materialize(members, "bench-members"), lengths


def document_windows(docs: DataFrame, id_col: str, text_col: str, windows: DataFrame, lengths: list[int], kgram: int) -> DataFrame:
    """(row, id, n_words, at, n, window): for each document one row with at = 0, and its windows that the bit table lets pass.

    Neighbouring windows with one minimum are looked up each: in compiled code that costs less than finding their runs.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), text_or_empty(text_col).alias("__text"))
    rows = with_words(rows, F.col("__text")).select("row", "id", "__w", "__h")
    each = rows.select("*", F.posexplode_outer("__h").alias("at", "__first"))  # outer: else a filter for empty arrays takes the words once more
    marked = [F.struct(F.lit(n).alias("n"), fingerprint(F.col("at"), n, kgram).alias("m")) for n in lengths or [1]]
    if len(marked) == 1:
        prints = each.select("row", "id", "__w", "at", marked[0]["n"].alias("n"), marked[0]["m"].alias("m"))
    else:
        prints = each.select("row", "id", "__w", "at", F.explode(F.array(*marked)).alias("k")).select("row", "id", "__w", "at", "k.*")
    bucket, bit = _slot(F.col("m"), F.col("n"))
    table = windows.groupBy("bucket").agg(F.bit_or("bit").alias("bits"))
    tested = prints.withColumn("bucket", bucket).join(F.broadcast(table), "bucket", "left")
    head = (F.col("at") == 0) & (F.col("n") == (lengths or [1])[0])
    passed = tested.where(head | ((F.col("at") > 0) & (F.col("at") + F.col("n") <= F.size("__w") + 1) & (F.col("bits").bitwiseAND(bit) != 0)))
    words = F.when(F.col("at") > 0, F.array_join(F.slice("__w", F.greatest(F.col("at"), F.lit(1)), F.col("n")), " "))
    return materialize(passed.select("row", "id", F.size("__w").cast("long").alias("n_words"), "at", "n", words.alias("window")), "doc-windows")


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WIDTH, kgram: int = KGRAM) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated), one row for each row of docs."""
    windows, members, lengths = benchmark_windows(items, item_id, item_text, width, kgram)
    found = document_windows(docs, id_col, text_col, windows, lengths, kgram)
    near = found.where("at > 0").select("row", "at", "n", "window")
    known = materialize(near.groupBy("n", "window").agg(F.count("*").alias("c")).join(windows.select("n", "window", "class"), ["n", "window"]), "doc-known")
    hits = spread_join(near, known, ["n", "window"], "c").select("row", F.struct("at", (F.col("at") + F.col("n")).alias("end")).alias("span"), "class")
    per_row = hits.groupBy("row").agg(F.array_sort(F.collect_set("span")).alias("spans"), F.array_sort(F.collect_set("class")).alias("classes"))
    start = F.struct(F.lit(0).alias("n"), F.lit(1).alias("reach"))
    grown = lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["at"], s["reach"]))).alias("n"), F.greatest(s["reach"], x["end"]).alias("reach"))
    covered = F.aggregate("spans", start, grown, lambda s: s["n"].cast("long"))
    per_row = materialize(per_row.select("row", covered.alias("n_hit"), "classes", F.sha2(F.array_join("classes", ","), 256).alias("set")), "doc-hits")
    sets = materialize(per_row.groupBy("set").agg(F.any_value("classes").alias("classes"), F.count("*").alias("c")), "doc-sets")
    listed = sets.select("set", F.explode("classes").alias("class")).join(members, "class").groupBy("set").agg(F.array_sort(F.collect_set("item")).alias("items"))
    digests = sets.select("set", "c").join(listed, "set", "left")
    none = F.array().cast("array<string>")
    digests = digests.select("set", "c", F.size(F.coalesce("items", none)).cast("long").alias("n_items"), F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"))
    decided = spread_join(per_row.drop("classes"), materialize(digests, "doc-digests"), ["set"], "c").select("row", "n_hit", "n_items", "items_sha256")
    out = found.where("at = 0").select("row", F.col("id").alias(id_col), "n_words").join(decided, "row", "left")
    zero = F.lit(0).cast("long")
    return out.select(
        id_col, "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"), F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated")
    )


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
s AS (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS pos FROM i WHERE len(w) > 0),
b AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, pos, pos + n - 1), ' ') AS x FROM s),
p AS (SELECT d.r, l.n, d.w, unnest(range(1, len(d.w) - l.n + 2)) AS pos FROM d, (SELECT DISTINCT n FROM b) l WHERE len(d.w) >= l.n),
q AS (SELECT r, n, pos, array_to_string(list_slice(w, pos, pos + n - 1), ' ') AS x FROM p),
h AS (SELECT q.r, q.pos, q.n, b.item_id FROM q JOIN b ON q.n = b.n AND q.x = b.x),
c AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(pos, pos + n)) AS word FROM (SELECT DISTINCT r, pos, n FROM h)) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit, coalesce(t.n_items, 0)::BIGINT AS n_items,
  coalesce(t.items_sha256, sha256('')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON c.r = d.r LEFT JOIN t ON t.r = d.r
"""
