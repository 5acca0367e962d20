"""A training corpus in five stages: language, near duplicates, personal data, mixture, sequences.

Every stage takes (spark, docs, sf_dir) and the rows that its predecessor kept; all but the last
return the columns of ``documents``.  Each result is written as Parquet and read again.

Defined cases (as in the operators): a null or empty text, or one without a letter, goes in
the first stage; of repeated rows, and of each group of near copies, one document stays, that
with the smallest id; a null id stays only where its group has no other; empty tables go through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import jaccard_join, language_id, mixing, packing, pii
from pairloom.llm.common import small_batches, stored, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LEAST_SHARE = 0.5  # a document without a language that makes up this share is rejected


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and mixtures without a main language; fills unknown languages."""
    small_batches(spark)  # the stage's rows carry whole texts to Python and back, after this function has returned
    docs = docs.select(*COLUMNS)
    read = language_id.predicted(docs, language_id.learned(docs))
    kept = read.where((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_SHARE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every component of the Jaccard join."""
    docs = docs.select(*COLUMNS)
    row = F.xxhash64(*COLUMNS)
    keyed = docs.withColumn("key", F.struct("doc_id", row.alias("row")))
    # The key is the id, then the whole row: equal ids beside different texts stay apart.
    numbered = keyed.select(F.struct(F.col("doc_id").isNull().alias("none"), F.col("key.doc_id"), F.col("key.row")).alias("key"), "text")
    groups = jaccard_join.jaccard_components(numbered, key="key")
    first = groups.where("key = component_id").select("key.doc_id", "key.row").distinct()
    # The ids are compared but are no key, so texts are dealt once, by their row, for the join and the copies alike.
    same_id = F.coalesce(F.col("doc_id") == F.col("first_id"), F.col("doc_id").isNull() & F.col("first_id").isNull())
    kept = docs.withColumn("row", row).join(
        first.withColumnsRenamed({"doc_id": "first_id", "row": "first_row"}), (F.col("row") == F.col("first_row")) & same_id, "left_semi",
    )
    return kept.dropDuplicates(["doc_id", "row"]).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every span of personal data by the name of its kind."""
    small_batches(spark)
    docs = docs.select(*COLUMNS)
    read = pii.found(docs, pii.learned(docs), redact=True)
    return read.withColumns({"text": F.col("redacted"), "n_chars": F.length("redacted").cast("bigint")}).select(*COLUMNS)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that the sources come to their targets."""
    docs = docs.select(*COLUMNS)
    sized = docs.select(
        "*", F.array("source").alias("sources"), mixing.word_count(F.coalesce("text", F.lit(""))).alias("size"),
        mixing.place_in_order(mixing.SEED, F.col("doc_id"), F.xxhash64("text")).alias("h"),
    )
    plan = mixing.planned(stored(sized.select("sources", "size", "h"), "sized"))
    taken = mixing.with_times(sized, plan).where("times > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times")))).select(*COLUMNS)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences."""
    small_batches(spark)
    return packing.packed(docs)


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", personal_data),
    ("mixing sources to target weights", mixture),
    ("packing", sequences),
]

#: SQL can express no stage: learned models, components, a flow and a packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
