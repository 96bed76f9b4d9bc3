"""Documents to packed training sequences, in five stages.

STAGES lists (name, function). Each function takes (spark, docs, sf_dir) and works on all rows its predecessor kept;
all but the last return the columns of documents. run() writes what each returns to the shared folder as Parquet and
reads it again for the next, so that a lost executor costs no more than its tasks of one stage.

Defined cases, for every stage: an empty table gives an empty result; columns besides doc_id, text and n_chars come back
unchanged, whatever their names; texts of any length are taken whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylight.llm import exact_dedup, minhash, packing, pii, toxicity
from quarrylight.llm.common import documents, drop_table, materialize


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on labelled rows of docs, does not reject.

    Null and empty texts get the score of a text without words; repeated rows get equal scores and stay or go together;
    a score of exactly the threshold is rejected; without labels of both classes all stay.
    """
    return toxicity.reject(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text (null counts as empty), the one with the smallest id, null ids last; of rows that repeat id and text, one."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more on shingles of five words: the one with the smallest id.

    Null and blank texts have no shingles and all stay; a shorter text's one shingle is the whole of it; of rows that
    repeat id and text one stays.
    """
    return minhash.deduplicate(docs, minhash.FIVE_WORDS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the text. Null texts stay null, and every row stays, repeated ones too."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences of at most 2048 tokens; a null or empty text is one piece of its end mark, repeated rows are packed each."""
    return packing.packed_documents(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            drop_table(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)


#: Models, MinHash and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
