"""Test input made from the given tables; these are not operators.

Scores and step figures are made by rule from ids and positions, in multiples of
1/16, so that sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.constants import END_OF_TEXT_ID, ID_LIMIT
from pairloom.functions.encoding import WordEncoder, pieces
from pairloom.functions.sequences import lookup_label
from pairloom.operators.ordering import dense_index
from pairloom.scratch import new_path
from pairloom.sources.datasets import scan
from pairloom.sources.vocabulary import with_special_tokens

STEP_RANKS = 4
TEST_TASKS = 16
# a split holds up to 128 MB of a file; its texts are cut and encoded by several tasks
TASKS_PER_SPLIT = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan(spark, f"{sf_dir}/{name}.parquet")


def _turns(spark: SparkSession, sf_dir: str, role: str, text: str, ahead: int = 0) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").where(F.col("role") == role)
    return turns.select("conv_id", (F.col("turn") - ahead).alias("turn"), F.col("text").alias(text))


def sft_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with the assistant turn that follows.

    Joined on (conversation, turn), which spreads a very long conversation; a
    window over the conversation would hold it in one task.
    """
    prompts = _turns(spark, sf_dir, "user", "instruction")
    answers = _turns(spark, sf_dir, "assistant", "response", ahead=1)
    return prompts.join(answers, ["conv_id", "turn"])


def preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SFT pairs; rejected is the answer of the next pair, two turns later."""
    prompts = _turns(spark, sf_dir, "user", "prompt")
    chosen = _turns(spark, sf_dir, "assistant", "chosen", ahead=1)
    rejected = _turns(spark, sf_dir, "assistant", "rejected", ahead=3)
    key = ["conv_id", "turn"]
    return prompts.join(chosen, key).join(rejected, key)


def step_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``rank, step, loss, dt, tokens`` from the dense event numbers."""
    n = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        (n % STEP_RANKS).cast("int").alias("rank"),
        F.floor(n / STEP_RANKS).cast("bigint").alias("step"),
        ((n * 7 % 64) / 16.0).alias("loss"),
        ((1 + n % 7) / 8.0).alias("dt"),
        (256 + n * 5 % 769).alias("tokens"),
    )


def policy_logp(label: Column, pos: Column) -> Column:
    return -((label * 31 + pos) % 97) / F.lit(16.0)


def reference_logp(label: Column, pos: Column) -> Column:
    return -((label * 17 + pos * 3) % 89) / F.lit(16.0)


def with_scores(rows: DataFrame, labels: str = "y") -> DataFrame:
    """Adds ``policy_logps`` and ``reference_logps``: entry t scores label t+1."""
    following = F.slice(F.col(labels), F.lit(2), F.greatest(F.size(labels) - 1, F.lit(0)))
    return rows.withColumns(
        {
            "policy_logps": F.transform(
                following, lambda y, i: policy_logp(lookup_label(y), i + 1)
            ),
            "reference_logps": F.transform(
                following, lambda y, i: reference_logp(lookup_label(y), i + 1)
            ),
        }
    )


def dealt(df: DataFrame, *by: str) -> DataFrame:
    """A table may be a single file with one row group: its rows are always dealt, to 16 tasks or more where its files are larger."""
    if by:
        return df.repartitionByRange(TEST_TASKS, *by)
    return df.repartition(max(TEST_TASKS, TASKS_PER_SPLIT * df.rdd.getNumPartitions()))


def commonest(counted: DataFrame, wanted: int) -> DataFrame:
    """The ``wanted`` rows of least ``rarity``, and all that are as rare as the last of them; the other rows are left out.

    Only the numbers of rows by rarity are added up in order. Rarities are whole numbers of occurrences,
    so n occurrences in all have at most sqrt(2 n) different ones.
    """
    before = Window.orderBy("rarity").rowsBetween(Window.unboundedPreceding, -1)
    by_rarity = counted.groupBy("rarity").agg(F.count("*").alias("rows"))
    ahead = by_rarity.select("rarity", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("ahead"))
    last = ahead.where(F.col("ahead") < wanted).agg(F.max("rarity")).first()[0]
    return counted.where(F.col("rarity") <= F.lit(last))


def word_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vocabulary table: 256 bytes, the commonest pieces of the texts, special tokens.

    Stands in for a vocabulary that is supplied; its size is fixed by the id range.
    """
    counted = (
        dealt(table(spark, sf_dir, "documents"))
        .select(F.explode(pieces(F.col("text"))).alias("piece"))
        .groupBy("piece").agg((-F.count("*")).alias("rarity"))
        # one-byte pieces have their byte ids already
        .where(F.octet_length("piece") > 1)
    )
    # counted once; those that may get an id are numbered without a sort in one task
    wanted = END_OF_TEXT_ID - 256
    path = new_path(spark, "pieces")
    counted.write.parquet(path)
    numbered = dense_index(commonest(spark.read.parquet(path), wanted), ["rarity", "piece"])
    words = numbered.where(F.col("idx") < wanted).select(
        F.encode("piece", "UTF-8").alias("token"),
        (F.col("idx") + 256).cast("int").alias("token_id"),
        F.lit(False).alias("is_special"),
    )
    single = spark.range(256).select(
        F.unhex(F.format_string("%02X", F.col("id"))).alias("token"),
        F.col("id").cast("int").alias("token_id"),
        F.lit(False).alias("is_special"),
    )
    vocabulary = new_path(spark, "vocabulary")
    with_special_tokens(single.unionByName(words)).write.parquet(vocabulary)
    return spark.read.parquet(vocabulary)


def lookup_pieces(vocabulary: DataFrame) -> DataFrame:
    """The part of a vocabulary that whole pieces are looked up in, as text."""
    return vocabulary.where(~F.col("is_special") & (F.col("token_id") >= 256)).select(
        F.decode("token", "UTF-8").alias("token"), "token_id"
    )


def word_encoder(vocabulary: DataFrame) -> WordEncoder:
    """Looks whole pieces up in a vocabulary; its size is bounded by the id range."""
    rows = lookup_pieces(vocabulary).limit(ID_LIMIT + 1).collect()
    return WordEncoder(vocabulary.sparkSession, {r.token: r.token_id for r in rows})
