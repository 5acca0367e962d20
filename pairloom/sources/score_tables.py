"""Scores, reference scores and labels that meet without a shuffle.

The three tables of token rows are written bucketed and sorted by the pair they belong to, as many buckets each. A pair's rows of a
table lie in one bucket, hence one task gathers them into a list; lists of the same pair lie in the same task and are joined
there.  Sequence sums, pair scores and losses follow in that task: the first shuffle is that of a report, of one row a pair.

A pair's lists are bounded by its two sequences.  ``buckets`` is fixed when the tables are written; ``bucket_count`` gives
so many that a bucket of token rows fits into a task, however many pairs there are.  A bucket is one sorted file, so
readers need not sort it again, and a pair's list is made while its rows go by.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.constants import IGNORED_LABEL

BUCKETS = 16
# Token rows of so many pairs are sorted by one task when they are written: 70 bytes each, at 1024 ids a side 75 MB.
PAIRS_PER_BUCKET = 512
MODELS = ("policy", "reference")
# Files of a bucketed table are read as what they are, sorted, and groups of sorted rows are gathered without a sort.
SORTED_READS = ("spark.sql.legacy.bucketedTableScan.outputOrdering", "spark.sql.execution.replaceHashWithSortAgg")


def bucket_count(pairs: int) -> int:
    """Buckets for the token rows of so many pairs."""
    return max(BUCKETS, -(-pairs // PAIRS_PER_BUCKET))


def write_bucketed(
    rows: DataFrame, folder: str, key: Sequence[str] = ("pair_id",), sort: Sequence[str] = (), buckets: int = BUCKETS,
    unfold: Callable[[DataFrame], DataFrame] | None = None,
) -> str:
    """Writes a table of the session's catalog below ``folder``, one file a bucket; returns its name.

    With ``unfold`` the rows hold lists: they are dealt to the buckets as lists, sorted by those columns of the order that
    they have, and only then made into rows, in their order, by ``unfold``.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    order = [c for c in (*key, *sort) if c in rows.columns]
    dealt = rows.repartition(buckets, *key).sortWithinPartitions(*order)
    unfolded = unfold(dealt) if unfold else dealt
    unfolded.write.bucketBy(buckets, *key).sortBy(*key, *sort).option("path", f"{folder}/{name}").format("parquet").saveAsTable(name)
    return name


def _listed(spark: SparkSession, name: str, value: str) -> DataFrame:
    """Per pair the (side, position, value) of all its token rows, sorted."""
    token = F.struct("side", "pos", F.col(value).alias("value"))
    return spark.table(name).groupBy("pair_id").agg(F.sort_array(F.collect_list(token)).alias(value))


def _summed(side: str, model: str) -> tuple[Column, Column]:
    """Sum of a model's scores over the labels of a side that count, and the number of such labels."""
    wanted = F.filter("tokens", lambda t: (t["label"]["side"] == side) & (t["label"]["value"] != IGNORED_LABEL))
    added = F.aggregate(wanted, F.lit(0.0), lambda sum, t: sum + t[model]["value"])
    return added, F.size(wanted).cast("bigint")


def pair_scores(spark: SparkSession, labels: str, policy: str, reference: str) -> DataFrame:
    """One row per ``pair_id`` with the sums of both models and sides, from three bucketed tables, without a shuffle.

    ``labels`` has ``label`` at the positions that are scored, the others ``logp`` there.  A position that one of them
    lacks, or has twice, fails the job.  Pairs that have scores but no labels are looked for at once, by the keys alone: a
    full join would forget how its sides are dealt.
    """
    for setting in SORTED_READS:  # from now on: the frame that is returned is planned later
        spark.conf.set(setting, True)
    joined = _listed(spark, labels, "label")
    for model, name in zip(MODELS, (policy, reference)):
        pairs = spark.table(name).select("pair_id").join(spark.table(labels).select("pair_id").hint("merge"), "pair_id", "left_anti")
        lost = pairs.agg(F.count("*").alias("n"), F.min("pair_id").alias("pair_id")).first()
        if lost.n:
            raise ValueError(f"labels and scores do not match in pair {lost.pair_id}")
        joined = joined.join(_listed(spark, name, "logp").withColumnRenamed("logp", model).hint("merge"), "pair_id", "left")
    tokens = F.arrays_zip("label", *MODELS)

    def at_label(t: Column, model: str) -> Column:
        same = (t["label"]["side"] == t[model]["side"]) & (t["label"]["pos"] == t[model]["pos"])
        # a list that is shorter leaves a NULL
        return F.coalesce(same & t[model]["value"].isNotNull(), F.lit(False))

    same = F.forall(tokens, lambda t: at_label(t, "policy") & at_label(t, "reference"))
    whole = F.coalesce(same, F.lit(False))
    refused = F.raise_error(F.concat(F.lit("labels and scores do not match in pair "), F.coalesce(F.col("pair_id").cast("string"), F.lit("NULL"))))
    checked = joined.select("pair_id", F.when(whole, tokens).otherwise(refused).alias("tokens"))
    out = {}
    for side in ("chosen", "rejected"):
        for model in MODELS:
            out[f"{model}_{side}"], out[f"{side}_tokens"] = _summed(side, model)
    return checked.select("pair_id", *[c.alias(name) for name, c in out.items()])
