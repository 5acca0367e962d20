"""Sinks and checks that must lose nothing: splits, order inside files, run names, missing scores."""

import glob

import pytest
from pyspark.sql import functions as F

from pairloom.functions.encoding import join_vocabulary
from pairloom.operators import checks, scoring
from pairloom.operators.ordering import source_index
from pairloom.sources import datasets, logs, shards
from pairloom.streaming import shards as stream_shards


def shard_rows(spark, path, size):
    rows = source_index(spark, path, ["id"]).withColumns(
        {"tokens": F.array(F.col("id").cast("int")), "length": F.lit(1)}
    )
    return shards.assign_shards(rows, size)


def test_splits_lie_side_by_side_and_files_are_in_order(spark, tmp_path):
    for lo, hi in ((0, 3), (3, 400), (400, 410), (410, 1000)):
        spark.range(lo, hi).coalesce(1).write.parquet(f"{tmp_path}/in/{lo:04d}")
    rows = shard_rows(spark, [f"{tmp_path}/in/{lo:04d}" for lo in (0, 3, 400, 410)], 128)
    path = shards.write_shards(rows, str(tmp_path), "d", "train")
    shards.write_shards(rows.where("idx < 200"), str(tmp_path), "d", "validation")
    shards.write_shards(rows.where("idx < 100"), str(tmp_path), "d", "validation")
    back = shards.read_shards(spark, path)
    assert {r.split: r["count"] for r in back.groupBy("split").count().collect()} == {"train": 1000, "validation": 100}
    for name in glob.glob(f"{path}/**/*.parquet", recursive=True):
        places = [r.row_in_shard for r in spark.read.parquet(name).collect()]
        assert places == sorted(places)


def test_an_empty_split_can_be_read(spark, tmp_path):
    rows = spark.createDataFrame([], "shard_id int, row_in_shard int, tokens array<int>, length int")
    assert shards.read_shards(spark, shards.write_shards(rows, str(tmp_path), "d")).count() == 0


def test_an_epoch_without_rows_changes_nothing(spark, tmp_path):
    out = str(tmp_path / "o")
    rows = spark.range(5).withColumnRenamed("id", "k")
    for _ in range(2):
        stream_shards.write_epoch(rows, 0, ["k"], out, 4)
        stream_shards.write_epoch(rows.where("k < 0"), 1, ["k"], out, 4)
        stream_shards.write_epoch(rows.withColumn("k", F.col("k") + 5), 2, ["k"], out, 4)
    got = stream_shards.read_shards(spark, out).collect()
    assert sorted((r.shard_id * 4 + r.row_in_shard, r.k) for r in got) == [(i, i) for i in range(10)]


@pytest.mark.parametrize("run", ["rank 0", "a%b", "x+y", "run0"])
def test_logs_are_in_order_under_the_name_of_their_run(spark, tmp_path, run):
    lines = spark.createDataFrame(
        [(run, s, i, f"{s}/{i}") for s in range(40, 0, -2) for i in ((0, 1) if s == 2 else (0,))],
        "run_id string, step int, line_in_step int, value string",
    ).repartition(7)
    path = str(tmp_path / "log")
    logs.append_log(lines, path)
    (name,) = glob.glob(f"{path}/*/*.txt")
    assert open(name).read().split() == ["2/0", "2/1"] + [f"{s}/0" for s in range(4, 41, 2)]
    assert {r.run_id for r in logs.read_log(spark, path).collect()} == {run}


def test_plain_log_folders_are_runs(spark, tmp_path):
    for run, name in (("one 1", "logs.txt"), ("two", "sft.txt")):
        (tmp_path / "l" / run).mkdir(parents=True)
        (tmp_path / "l" / run / name).write_text("10 train 0.5\n20 val 0.25\n")
    got = logs.parse_sft_log(logs.read_log(spark, str(tmp_path / "l")), "run_id").collect()
    assert sorted((r.run_id, r.step, r.kind, r.loss) for r in got) == [
        (run, s, k, v) for run in ("one 1", "two") for s, k, v in ((10, "train", 0.5), (20, "val", 0.25))
    ]


SCORES = "s int, pos int, logp double"
LABELS = "s int, pos int, label int"


@pytest.mark.parametrize("scores", [[(1, 0, -1.0), (1, 1, -2.0)], [(1, 0, -1.0), (1, 1, -2.0), (1, 2, None)]])
def test_a_missing_score_is_an_error_and_is_listed(spark, scores):
    given = spark.createDataFrame(scores, SCORES)
    labels = spark.createDataFrame([(1, 0, 5), (1, 1, 5), (1, 2, 6), (1, 3, 7)], LABELS)
    with pytest.raises(Exception, match="no score"):
        scoring.sequence_logprobs(scoring.align_with_labels(given, labels, ["s"]), ["s"]).collect()
    with pytest.raises(Exception, match="no score"):
        scoring.token_mean_loss(scoring.align_with_labels(given, labels, ["s"]), ["s"]).collect()
    (row,) = scoring.unmatched(given, labels, ["s"]).collect()
    assert (row.labels_without_score, row.scores_without_label) == (1, 0)
    ignored = labels.withColumn("label", F.when(F.col("pos") == 3, -100).otherwise(F.col("label")))
    (row,) = scoring.sequence_logprobs(scoring.align_with_labels(given, ignored, ["s"]), ["s"]).collect()
    assert (row.logp, row.tokens) == (-3.0, 2)
    (row,) = scoring.unmatched(given.unionByName(given.select("s", F.lit(9).alias("pos"), "logp").limit(1)), ignored, ["s"]).collect()
    assert row.scores_without_label == 1


def test_a_sequence_that_one_model_lacks_is_an_error(spark):
    policy = spark.createDataFrame([(1, -1.0, 2), (2, -1.0, 2)], "s int, logp double, tokens bigint")
    assert scoring.join_reference(policy, policy, ["s"]).count() == 2
    for a, b in ((policy, policy.where("s = 1")), (policy.where("s = 1"), policy)):
        with pytest.raises(Exception, match="a sequence has no"):
            scoring.join_reference(a, b, ["s"]).collect()


def test_a_null_list_has_not_the_length(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, None), (3, [1])], "k int, t array<int>")
    assert {r.k for r in checks.length_violations(df, "t", 2).collect()} == {2, 3}


def test_a_vocabulary_with_a_token_twice_is_refused(spark):
    tokens = spark.createDataFrame([("a",)], "piece string")
    assert join_vocabulary(tokens, spark.createDataFrame([("a", 1)], "token string, token_id int")).count() == 1
    for rows in ([("a", 1), ("a", 2)], [("a", 1), ("b", 1)]):
        with pytest.raises(ValueError, match="once"):
            join_vocabulary(tokens, spark.createDataFrame(rows, "token string, token_id int"))


def test_nulls_are_listed_or_refused_with_their_number(spark):
    df = spark.createDataFrame([(1, "q", None), (2, None, None), (3, "q", "r")], "k int, q string, r string")
    mapping = {"prompt": "q", "answer": "r"}
    assert {r.k: r.null_columns for r in datasets.null_rows(df, mapping, ["k"]).collect()} == {1: ["r"], 2: ["q", "r"]}
    with pytest.raises(ValueError, match="2 rows"):
        datasets.refuse_nulls(df, mapping)
    assert datasets.refuse_nulls(df.where("k = 3"), mapping).count() == 1
