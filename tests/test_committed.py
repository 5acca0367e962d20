"""Sinks whose results count once and whole: log appends, checked rows, shards, bucketed scores."""

import glob
import os
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pairloom.operators import checks
from pairloom.plans import lasting
from pairloom.sources import log_store, logs, score_tables, shards


# ---- log appends ---------------------------------------------------------

def log_lines(spark, steps, run="a b%"):
    rows = [(run, s, i, f"{s}/{i}") for s in steps for i in ((0, 1) if s == 2 else (0,))]
    return spark.createDataFrame(rows, "run_id string, step int, line_in_step int, value string").repartition(7)


def in_order(spark, path, run="a b%"):
    rows = log_store.read_ordered(spark, path).where(F.col("run_id") == run).collect()
    return [r.value for r in sorted(rows, key=lambda r: (r.append, r.file, r["at"]))]


def test_a_run_of_many_files_is_in_order_and_an_append_counts_once(spark, tmp_path):
    path = str(tmp_path / "log")
    first = log_lines(spark, range(2, 400, 2)).unionByName(log_lines(spark, [5], "other"))
    assert log_store.append_lines(first, path, "one", tasks=6) == 201
    assert len(glob.glob(f"{path}/append=1/run_id=a*/*.txt")) > 3  # most of the lines are one run's
    assert log_store.append_lines(log_lines(spark, range(400, 500)), path, "two") == 100
    assert log_store.append_lines(log_lines(spark, range(400, 500)), path, "two") == 0
    expected = ["2/0", "2/1"] + [f"{s}/0" for s in [*range(4, 400, 2), *range(400, 500)]]
    assert in_order(spark, path) == expected and in_order(spark, path, "other") == ["5/0"]
    assert sorted(r.value for r in log_store.read_lines(spark, path).where("run_id = 'a b%'").collect()) == sorted(expected)


def test_an_append_that_did_not_finish_is_not_read_and_is_replaced(spark, tmp_path):
    path = str(tmp_path / "log")
    assert log_store.read_lines(spark, path).count() == 0
    log_store.append_lines(log_lines(spark, [4]), path, "one")
    # files without a manifest row, as after a lost driver
    log_lines(spark, [8, 9]).select("run_id", "value").write.partitionBy("run_id").text(f"{path}/append=2")
    assert in_order(spark, path) == ["4/0"] and log_store.read_lines(spark, path).count() == 1
    log_store.append_lines(log_lines(spark, [8]), path, "two")
    assert in_order(spark, path) == ["4/0", "8/0"]
    assert log_store.append_lines(log_lines(spark, []), path, "none") == 0
    log_store.append_lines(log_lines(spark, [10]), path)
    assert in_order(spark, path) == ["4/0", "8/0", "10/0"]
    assert [r.lines for r in log_store.manifest(spark, path).orderBy("append").collect()] == [1, 1, 0, 1]


def test_lines_of_new_appends_as_a_stream(spark, tmp_path):
    path, out = str(tmp_path / "log"), str(tmp_path / "out")
    for steps in ([2, 4], [6]):
        log_store.append_lines(log_lines(spark, steps), path)
        stream = log_store.stream_lines(spark, path).writeStream.format("parquet").option("path", f"{out}/rows")
        stream.option("checkpointLocation", f"{out}/c").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(f"{out}/rows").collect()
    assert sorted((r.append, r.run_id, r.value) for r in rows) == [(1, "a b%", "2/0"), (1, "a b%", "2/1"), (1, "a b%", "4/0"), (2, "a b%", "6/0")]


def test_a_plain_folder_is_read_as_before(spark, tmp_path):
    path = str(tmp_path / "log")
    logs.append_log(log_lines(spark, [2, 4]), path)
    assert {r.run_id for r in logs.read_log(spark, path).collect()} == {"a b%"}


# ---- checks in the pass that writes --------------------------------------

def test_counts_come_from_the_writing_pass(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def pass_on(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([(1, "a", 3), (2, None, 9), (3, "c", 9), (4, None, None), (5, "", 0)], "id int, t string, n int")
    wrong = {**checks.null_checks(["t"]), "large": F.col("n") > 5}
    counts = checks.write_checked(rows.mapInArrow(pass_on, rows.schema), str(tmp_path / "o"), wrong)
    assert counts == {"rows": 5, "refused": 3, "null t": 2, "large": 2} and made.value == 5
    assert {r.id for r in checks.read_checked(rows, str(tmp_path / "o")).collect()} == {1, 5}
    refused = checks.read_checked(rows, str(tmp_path / "o"), refused=True)
    assert {r.id: r.reasons for r in refused.collect()} == {2: ["null t", "large"], 3: ["large"], 4: ["null t"]}
    assert checks.write_checked(rows.limit(0), str(tmp_path / "e"), wrong) == {"rows": 0, "refused": 0, "null t": 0, "large": 0}
    assert checks.read_checked(rows, str(tmp_path / "e")).count() == 0
    with pytest.raises(ValueError, match="names of their own"):
        checks.write_checked(rows, str(tmp_path / "x"), {"rows": F.lit(True)})


# ---- shards that commit --------------------------------------------------

@pytest.fixture
def shard_folder(spark, tmp_path):
    rows = spark.range(40).repartition(4).select(
        F.floor(F.col("id") / 16).cast("int").alias("shard_id"), (F.col("id") % 16).cast("int").alias("row_in_shard"),
        F.array(F.col("id").cast("int"), F.lit(7)).alias("tokens"), F.lit(2).alias("length"),
    )
    path = shards.write_shards(rows, str(tmp_path), "d")
    shards.write_shards(rows.where("shard_id = 0"), str(tmp_path), "d", "validation", one_file=True)
    return path


def test_committed_shards_are_read_and_changes_are_found(spark, shard_folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        shards.read_committed(spark, shard_folder)
    manifest = shards.commit_shards(spark, shard_folder)
    assert sorted((r.split, r.shard_id, r.rows) for r in manifest.collect()) == [("train", 0, 16), ("train", 1, 16), ("train", 2, 8), ("validation", 0, 16)]
    assert manifest.where("split = 'train'").agg(F.max("files")).first()[0] > 1
    assert manifest.where("split = 'validation'").agg(F.max("files")).first()[0] == 1
    assert shards.read_committed(spark, shard_folder).count() == shards.read_shards(spark, shard_folder).count() == 56
    # one file of a shard, then all of another shard
    lost = sorted(glob.glob(f"{shard_folder}/split=train/shard=d_train_000001/*.parquet"))[0]
    os.remove(lost)
    for name in glob.glob(f"{shard_folder}/split=validation/*/*.parquet"):
        os.remove(name)
    with pytest.raises(ValueError, match="train/1: changed; validation/0: missing"):
        shards.read_committed(spark, shard_folder)
    with pytest.raises(PySparkException, match="rows are missing or there twice in shard train/1"):
        shards.commit_shards(spark, shard_folder)


def test_a_row_there_twice_and_an_unknown_shard(spark, shard_folder, tmp_path):
    shards.commit_shards(spark, shard_folder)
    more = spark.createDataFrame([(0, 0, [1], 1)], "shard_id int, row_in_shard int, tokens array<int>, length int")
    more.coalesce(1).write.mode("append").parquet(f"{shard_folder}/split=train/shard=d_train_000000")
    shards.write_shards(more, str(tmp_path), "d", "new")
    with pytest.raises(ValueError, match="new/0: unknown; train/0: changed"):
        shards.read_committed(spark, shard_folder)
    with pytest.raises(PySparkException, match="train/0"):
        shards.commit_shards(spark, shard_folder)


# ---- scores that meet without a shuffle ----------------------------------

def token_tables(spark, out, change=lambda name, rows: rows):
    labels = [(p, side, pos, (p + pos) % 3 - (100 if pos == 0 else 0)) for p in range(40) for side in ("chosen", "rejected") for pos in range(p % 5 + 1)]
    names = []
    for name, column in (("label", "label int"), ("policy", "logp double"), ("reference", "logp double")):
        rows = labels if name == "label" else [(*r[:3], -(r[0] + r[2] * (2 if name == "policy" else 3)) / 4) for r in labels]
        df = spark.createDataFrame(change(name, rows), f"pair_id bigint, side string, pos int, {column}")
        names.append(score_tables.write_bucketed(df, out, sort=["side", "pos"], buckets=4))
    return labels, names


def test_bucketed_scores_equal_plain_sums_without_an_exchange(spark, tmp_path):
    labels, names = token_tables(spark, str(tmp_path))
    scores = score_tables.pair_scores(spark, *names)
    assert "Exchange" not in scores._jdf.queryExecution().executedPlan().toString()
    got = {r.pair_id: r for r in scores.collect()}
    for p in range(40):
        for side in ("chosen", "rejected"):
            counted = [r for r in labels if r[0] == p and r[1] == side and r[3] != -100]
            assert got[p][f"{side}_tokens"] == len(counted)
            assert got[p][f"policy_{side}"] == sum(-(p + r[2] * 2) / 4 for r in counted)
            assert got[p][f"reference_{side}"] == sum(-(p + r[2] * 3) / 4 for r in counted)


@pytest.mark.parametrize("table", ("label", "policy", "reference"))
@pytest.mark.parametrize("how", ("missing token", "missing pair", "twice", "null"))
def test_what_one_table_lacks_fails_the_job(spark, tmp_path, table, how):
    def change(name, rows):
        if name != table:
            return rows
        if how == "twice":
            return [*rows, rows[-1]]
        if how == "null":
            return [*rows[:-1], (*rows[-1][:2], None, rows[-1][3])]
        return rows[:-1] if how == "missing token" else [r for r in rows if r[0] != 7]

    _, names = token_tables(spark, str(tmp_path), change)
    with pytest.raises((PySparkException, ValueError), match="do not match in pair"):
        score_tables.pair_scores(spark, *names).collect()


def test_the_report_shuffles_pairs_only(spark, sf_dir):
    report = lasting.report_bucketed(spark, sf_dir)
    report.collect()
    plan = report._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)", final)
    assert len(exchanges) == 1 and exchanges[0].startswith("rank")
    # it lies above every scan and join
    assert final.index("Exchange hashpartitioning") < final.index("SortMergeJoin")


def test_buckets_grow_with_the_pairs_and_sorted_files_are_not_sorted_again(spark, tmp_path):
    assert score_tables.bucket_count(0) == score_tables.bucket_count(1000) == score_tables.BUCKETS
    assert score_tables.bucket_count(10 ** 6 + 1) * score_tables.PAIRS_PER_BUCKET > 10 ** 6
    _, names = token_tables(spark, str(tmp_path))
    scores = score_tables.pair_scores(spark, *names)
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert "Sort [" not in plan and "ObjectHashAggregate" not in plan and plan.count("SortAggregate") >= 3


def test_lists_are_dealt_to_buckets_before_they_become_token_rows(spark, tmp_path):
    rows = spark.createDataFrame(
        [(p, side, [p + i for i in range(p % 4)]) for p in range(300) for side in ("rejected", "chosen")], "pair_id bigint, side string, value array<int>"
    )
    unfolded = []

    def unfold(dealt):
        assert dealt.columns == ["pair_id", "side", "value"]
        unfolded.append(dealt.select("pair_id", "side", F.posexplode("value").alias("pos", "label")))
        return unfolded[0]

    name = score_tables.write_bucketed(rows, str(tmp_path), sort=["side", "pos"], buckets=4, unfold=unfold)
    plan = unfolded[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate") < plan.index("Exchange")
    assert len(glob.glob(f"{tmp_path}/{name}/*.parquet")) == 4
    for path in glob.glob(f"{tmp_path}/{name}/*.parquet"):
        got = [(r.pair_id, r.side, r.pos) for r in spark.read.parquet(path).collect()]
        assert got == sorted(got)
    expected = rows.select("pair_id", "side", F.posexplode("value").alias("pos", "label"))
    assert spark.table(name).exceptAll(expected).isEmpty() and spark.table(name).count() == expected.count()
