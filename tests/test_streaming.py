import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pairloom.functions.encoding import ByteEncoder
from pairloom.functions.templates import shard_segments
from pairloom.operators import batches as B
from pairloom.plans import adapters as A
from pairloom.plans.queries import QUERIES
from pairloom.sources import logs
from pairloom.streaming import logs as live
from pairloom.streaming import prepare as P
from pairloom.streaming import shards as S

SCHEMA = "conv_id bigint, turn bigint, instruction string, response string"
KEY = ["conv_id", "turn"]


@pytest.fixture
def parts(spark, sf_dir, tmp_path):
    """SFT pairs as several files, written one after the other."""
    pairs = A.sft_pairs(spark, sf_dir)
    folder = str(tmp_path / "in")
    for part in range(4):
        pairs.where(F.pmod(F.hash("conv_id"), F.lit(4)) == part).coalesce(1).write.mode("append").parquet(folder)
    return pairs, folder


def prepare(rows):
    segments = shard_segments(F.col("instruction"), F.col("response"))
    return B.shard_rows(rows, segments, ByteEncoder(), 64, 50257).select(*KEY, "tokens", "length")


def test_stream_equals_batch(spark, parts, tmp_path):
    pairs, folder = parts
    out = str(tmp_path / "out")
    stream = P.read_stream(spark, folder, SCHEMA, files_per_trigger=1)
    P.prepare_stream(stream, prepare, out, str(tmp_path / "checkpoint")).awaitTermination()
    got = spark.read.parquet(out)
    expected = prepare(pairs)
    assert got.count() == expected.count() > 0
    assert got.exceptAll(expected).count() == 0


def test_shards_go_on_across_epochs_and_survive_a_retry(spark, parts, tmp_path):
    pairs, folder = parts
    out = str(tmp_path / "out")
    stream = P.read_stream(spark, folder, SCHEMA, files_per_trigger=1)
    S.write_stream(stream, prepare, KEY, out, 5).awaitTermination()
    rows = S.read_shards(spark, out)
    n = pairs.count()
    got = rows.orderBy("shard_id", "row_in_shard").collect()
    assert [(r.shard_id, r.row_in_shard) for r in got] == [divmod(i, 5) for i in range(n)]
    assert [r.epoch for r in got] == sorted(r.epoch for r in got)
    assert len({r.epoch for r in got}) == 4
    assert rows.select(*KEY, "tokens", "length").exceptAll(prepare(pairs)).count() == 0
    # epoch 2 is run again, as after a lost driver
    again = rows.where("epoch = 2").select(*KEY, "tokens", "length").collect()
    S.write_epoch(spark.createDataFrame(again, prepare(pairs).schema), 2, KEY, out, 5)
    assert S.read_shards(spark, out).orderBy("shard_id", "row_in_shard").collect() == got


def test_more_rows_later_continue_the_numbering(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for lo, hi in ((0, 7), (7, 12)):
        spark.range(lo, hi).coalesce(1).write.mode("append").parquet(folder)
        stream = P.read_stream(spark, folder, "id bigint")
        S.write_stream(stream, lambda rows: rows, ["id"], out, 4).awaitTermination()
    got = {r.id: (r.shard_id, r.row_in_shard) for r in S.read_shards(spark, out).collect()}
    assert got == {i: divmod(i, 4) for i in range(12)}


def test_a_missing_epoch_in_the_manifest_is_an_error(spark, tmp_path):
    out = str(tmp_path / "out")
    S.write_epoch(spark.range(3).toDF("id"), 0, ["id"], out, 2)
    with pytest.raises(PySparkException, match="epoch=1"):
        S.write_epoch(spark.range(3).toDF("id"), 2, ["id"], out, 2)


def test_live_log_windows(spark, tmp_path):
    path, out = str(tmp_path / "log"), str(tmp_path / "out")
    expected = {}
    for lo, hi in ((0, 5), (5, 14)):
        steps = spark.range(lo, hi).select(F.col("id").alias("step"), (F.col("id") / 4).alias("loss"))
        lines = logs.sft_log_lines(steps, steps.where("step = 8"), 1).withColumn("run_id", F.lit("r"))
        logs.append_log(lines, path)
        live.write_windows(live.live_windows(live.read_log_stream(spark, path), 4), out).awaitTermination()
        for s in range(max(lo, 1), hi):
            total, n = expected.get(-(-s // 4), (0, 0))
            expected[-(-s // 4)] = (total + s / 4, n + 1)
        got = {r.window_id: (r.loss, r.lines) for r in live.latest_windows(spark, out).collect()}
        assert got == expected


def test_every_document_arrives_once(spark, tmp_path):
    rows = [(i, "a few words", "s") for i in (-4, -3, -2, -1, 0, 1, 2, 3)]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["stream_shards"](spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == [r[0] for r in rows]


def test_a_table_of_several_files_is_prepared_like_one_of_a_single_file(spark, sf_dir, tmp_path):
    (tmp_path / "folder").mkdir()
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts.repartition(3).write.parquet(str(tmp_path / "folder" / "documents.parquet"))
    got, expected = (QUERIES["stream_prepare"](spark, path) for path in (str(tmp_path / "folder"), sf_dir))
    assert got.count() == expected.count() == texts.count()
    assert got.exceptAll(expected).isEmpty()
