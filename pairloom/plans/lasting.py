"""Queries over what grows or is kept: logs, streams, manifests, bucketed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.constants import BATCH_LENGTH
from pairloom.functions import schedules, templates
from pairloom.functions.encoding import ArrowByteEncoder, encode_segments
from pairloom.functions.sequences import out_of_range
from pairloom.operators import batches as B
from pairloom.operators import checks, permutation, steps
from pairloom.operators import scoring as R
from pairloom.operators.distribution import assign_batches, rank_split
from pairloom.operators.ordering import dense_index
from pairloom.plans import adapters as A
from pairloom.plans import queries as Q
from pairloom.scratch import new_path
from pairloom.sources import file_index, log_store, logs, score_tables, shards, slices
from pairloom.sources.datasets import map_columns
from pairloom.streaming import batches, log_tail, windows
from pairloom.streaming import prepare as stream_prepare

ROUNDS = 3
DELIVERY_FILES = 5
CHECKED_IDS = 200
CHECKED_LENGTH = 4000


def stream_log_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rank's training log grows in place in three rounds, each of which ends in the middle of a line, and is followed."""
    out = new_path(spark, "log-tail")
    trained = steps.accumulated_loss(A.step_table(spark, sf_dir), Q.ACCUMULATION)
    lines = trained.where(schedules.due(F.col("step"), Q.SFT_LOG_EVERY)).select(
        F.concat(F.lit("rank"), F.col("rank").cast("string")).alias("run_id"), "step",
        logs.sft_train_line(F.col("step"), F.col("loss")).alias("value"),
    )
    log_tail.with_places(lines).write.parquet(f"{out}/texts")
    texts = spark.read.parquet(f"{out}/texts")
    size = F.max(F.col("at") + F.octet_length("text")).over(Window.partitionBy("run_id"))
    sized = texts.withColumn("size", size)
    for turn in range(1, ROUNDS + 1):
        # a round reaches to the middle of the line that its last byte is in
        limit = F.floor(F.col("size") * turn / ROUNDS)
        cut = F.substring("text", 1, 10) if turn < ROUNDS else F.col("text")
        reached = sized.where(F.col("at") < limit).withColumn("text", F.when(F.col("at") + F.octet_length("text") < limit, F.col("text")).otherwise(cut))
        log_tail.grow_files(reached, f"{out}/runs")
        found = logs.parse_sft_log(log_tail.follow(spark, f"{out}/runs"), "run_id")
        found.writeStream.format("parquet").option("path", f"{out}/rows").option(
            "checkpointLocation", f"{out}/checkpoint"
        ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{out}/rows")


def stream_closed_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss windows of the step table, whose steps come in parts and out of order: each once, when it is whole."""
    out = new_path(spark, "closed-windows")
    rows = A.step_table(spark, sf_dir).select("rank", "step", "loss")
    part = F.pmod(F.hash("step"), F.lit(ROUNDS))
    for turn in range(ROUNDS):
        rows.where(part == turn).write.mode("append").parquet(f"{out}/steps")
        arrived = stream_prepare.read_stream(spark, f"{out}/steps", "rank int, step bigint, loss double")
        windows.write_closed(windows.closed_windows(arrived, Q.ACCUMULATION, ["rank"]), out).awaitTermination()
    return windows.read_closed(spark, out).select(
        "rank", "window_id", "step", "steps", Q.rounded(F.col("loss")).alias("loss")
    )


def stream_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Padded batches over documents that arrive in four epochs, one of them without rows and the last one run twice."""
    out = new_path(spark, "stream-batches")
    columns = {"prompt": "source", "answer": "text"}
    texts = A.table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    encoder = ArrowByteEncoder()

    def prepare(rows: DataFrame) -> DataFrame:
        return map_columns(rows, columns, ["doc_id"], on_null="drop")

    def collate(rows: DataFrame) -> DataFrame:
        return B.sft_batches(B.encode_sft(rows, encoder), BATCH_LENGTH)

    arrival_of = F.coalesce(F.pmod("doc_id", F.lit(ROUNDS)), F.lit(0))
    arrivals = [texts.where(arrival_of == part) for part in range(ROUNDS)]
    arrivals.insert(1, arrivals[0].withColumn("text", F.lit(None).cast("string")))
    for arrival in arrivals:
        arrival.write.mode("append").parquet(f"{out}/arrivals")
        source = stream_prepare.read_stream(spark, f"{out}/arrivals", "doc_id bigint, text string, source string")
        batches.write_stream(source, prepare, ["doc_id"], out, collate, Q.RANKS, Q.BATCH).awaitTermination()
    batches.write_epoch(prepare(arrivals[-1]), len(arrivals) - 1, ["doc_id"], out, collate, Q.RANKS, Q.BATCH)
    batches.finish(spark, out, collate, Q.RANKS, Q.BATCH)
    return batches.read_batches(spark, out).select(
        "rank", "batch_id", "row_in_batch", *[Q.joined(F.col(c)).alias(c) for c in ("x", "mask", "y")]
    )


def _delivered(spark: SparkSession, rows: DataFrame, out: str, deliveries: list) -> str:
    """A data set that arrives in deliveries of several files each, and the index that grows with it."""
    for wanted in deliveries:
        rows.where(wanted).repartitionByRange(DELIVERY_FILES, "doc_id").sortWithinPartitions("doc_id").write.mode("append").parquet(f"{out}/data")
        file_index.add_files(spark, f"{out}/data", f"{out}/index")
    return f"{out}/index"


def index_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row numbers after a second and a third delivery: those of the first have stayed."""
    texts = A.table(spark, sf_dir, "documents").select("doc_id", "lang")
    arrival = F.coalesce(F.pmod("doc_id", F.lit(ROUNDS)), F.lit(0))
    index = _delivered(spark, texts, new_path(spark, "index-append"), [arrival == part for part in range(ROUNDS)])
    return file_index.read_rows(spark, index, ["doc_id", "lang"])


SPLIT_EXPRESSION = "train[:50%]+validation[-10%:]+train[10:20]+validation"


def split_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sum of slices of two splits, which lie in several files each."""
    texts = A.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.col("lang") == "es", F.lit(False))
    indexes = {
        split: _delivered(spark, texts, new_path(spark, f"split-{split}"), [wanted])
        for split, wanted in (("train", ~held_out), ("validation", held_out))
    }
    return slices.read_slices(spark, indexes, SPLIT_EXPRESSION, ["doc_id", "text"]).select("split", "idx", "n_rows", "doc_id", "text")


def permuted_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranks and batches of documents in a seeded order that needs no sort: nothing is shuffled from the source on."""
    texts = A.table(spark, sf_dir, "documents").select("doc_id")
    index = _delivered(spark, texts, new_path(spark, "permuted"), [F.lit(True)])
    n_rows = file_index.indexed_rows(file_index.manifest(spark, index))
    ordered = permutation.permuted_order(file_index.read_rows(spark, index, ["doc_id"]), n_rows, Q.SEED)
    return assign_batches(rank_split(ordered, Q.RANKS), Q.BATCH).select("doc_id", "idx", "rank", "batch_id", "row_in_batch")


def log_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A training log of two appends, many tasks each, and the second one repeated: its lines with their place in the order."""
    path = new_path(spark, "log-in-order")
    lines = Q._sft_lines(spark, sf_dir).withColumn("run_id", F.lit("run 5%"))
    # cut between two steps, in the middle of the log
    cut = lines.agg(F.max("step")).first()[0] or 0
    for append_id, part in (("first", F.col("step") <= cut // 2), ("second", F.col("step") > cut // 2), ("second", F.lit(True))):
        log_store.append_lines(lines.where(part), path, append_id)
    placed = dense_index(log_store.read_ordered(spark, path), ["run_id", "append", "file", "at"])
    return placed.select("run_id", "idx", "value")


def prepare_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard rows that are checked in the pass that writes them: rows kept, rows refused with their reasons, and the counts."""
    texts = Q.documents_with_nulls(spark, sf_dir).withColumnsRenamed({"source": "query", "text": "response"})
    segments = templates.shard_segments(F.col("query"), F.col("response"))
    encoded = texts.withColumn("ids", encode_segments(segments, Q.BYTES))
    wrong = {
        **checks.null_checks(["query", "response"]),
        "id out of range": out_of_range(F.col("ids"), CHECKED_IDS) > 0,
        "too long": F.size("ids") > CHECKED_LENGTH,
    }
    out = new_path(spark, "prepare-checked")
    counts = checks.write_checked(encoded, out, wrong)
    kept = checks.read_checked(encoded, out).select(
        F.lit("kept").alias("kind"), "doc_id", Q.joined(F.col("ids")).alias("detail"), F.lit(None).cast("bigint").alias("n")
    )
    refused = checks.read_checked(encoded, out, refused=True).select(
        F.lit("refused").alias("kind"), "doc_id", F.array_join("reasons", ", ").alias("detail"), F.lit(None).cast("bigint").alias("n")
    )
    counted = spark.createDataFrame([("count", None, name, n) for name, n in counts.items()], kept.schema)
    return kept.unionByName(refused).unionByName(counted)


def shard_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two splits of shards, one of them with one file a shard, committed and verified."""
    folder, rows = new_path(spark, "shard-verify"), Q._shard_table(spark, sf_dir)
    path = shards.write_shards(rows, folder, "documents")
    # the second split is made of the first as it was written: no text is encoded twice
    written = shards.read_shards(spark, path).where("split = 'train' AND shard_id % 2 = 0")
    shards.write_shards(written, folder, "documents", "validation", one_file=True)
    shards.commit_shards(spark, path)
    shards.read_committed(spark, path)
    return shards.verify_shards(spark, path).select(
        "split", "shard_id", "rows", "checksum", "state", F.when(F.col("split") == "validation", F.col("files")).alias("files_if_one")
    )


def report_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The preference report from bucketed tables of labels, scores and reference scores."""
    out = new_path(spark, "bucketed")
    # a pair's number: its place among all pairs
    pair_id = (F.col("batch_id") * Q.BATCH + F.col("pair_in_batch")) * Q.RANKS + F.col("rank")
    following = F.slice("y", F.lit(2), F.greatest(F.size("y") - 1, F.lit(0)))
    Q._scored_dpo(spark, sf_dir).select(
        pair_id.alias("pair_id"), "side", "rank", "batch_id", "rank_steps", "pair_in_batch",
        following.alias("label"), F.col("policy_logps").alias("policy"), F.col("reference_logps").alias("reference"),
    ).write.parquet(f"{out}/rows")
    rows = spark.read.parquet(f"{out}/rows")
    pairs = rows.where("side = 'chosen'").select("pair_id", "rank", "batch_id", "rank_steps", "pair_in_batch")
    buckets = score_tables.bucket_count(pairs.count())

    def tokens(value: str, name: str) -> str:
        return score_tables.write_bucketed(
            rows.select("pair_id", "side", value), out, sort=["side", "pos"], buckets=buckets,
            unfold=lambda dealt: dealt.select("pair_id", "side", F.posexplode(value).alias("pos", name)),
        )

    names = [tokens("label", "label"), *[tokens(model, "logp") for model in score_tables.MODELS]]
    pairs = spark.table(score_tables.write_bucketed(pairs, out, buckets=buckets))
    scores = score_tables.pair_scores(spark, *names)
    scored = R.score_pairs(pairs.join(scores.hint("merge"), "pair_id"))
    report = R.with_ramp_lr(R.preference_report(scored, ["rank", "batch_id", "rank_steps"]), "rank_steps", Q.BASE_LR)
    return report.select(
        "rank", "batch_id", "pairs", *[Q.rounded(F.col(c)).alias(c) for c in Q.REPORT_FIGURES], F.round("lr", 9).alias("lr"),
    )


QUERIES: dict[str, Q.Query] = {f.__name__: f for f in (
    stream_log_tail, stream_closed_windows, stream_batches, split_expression, index_append, permuted_batches,
    report_bucketed, log_in_order, prepare_checked, shard_verify,
)}
