import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pairloom.functions import formats, schedules
from pairloom.operators import steps as T
from pairloom.sources import logs


def step_frame(spark, n, ranks=1):
    rows = [(r, s, (s * 5 + r) % 16 / 16, 0.25 * (1 + s % 3), 10 + s) for r in range(ranks) for s in range(n)]
    return spark.createDataFrame(rows, "rank int, step bigint, loss double, dt double, tokens bigint")


@pytest.mark.parametrize("n", [1, 4, 5, 12, 13, 14])
def test_first_window_holds_one_step_more_and_an_open_one_is_not_reported(spark, n):
    acc = 4
    expected, total, seen = {}, 0.0, 0
    for s in range(n):
        total, seen = total + (s * 5) % 16 / 16 / acc, seen + 1
        if s > 0 and s % acc == 0:
            expected[s] = (total, seen)
            total, seen = 0.0, 0
    got = T.accumulated_loss(step_frame(spark, n), acc).collect()
    assert {r.step: (r.loss, r.steps) for r in got} == expected


def test_rank_mean_then_window(spark):
    by_step = T.rank_mean_loss(step_frame(spark, 9, 4))
    assert {r.step: r.loss for r in by_step.collect()} == {
        s: sum((s * 5 + r) % 16 / 16 for r in range(4)) / 4 for s in range(9)
    }
    assert [r.window_id for r in T.accumulated_loss(by_step, 4, ()).orderBy("step").collect()] == [1, 2]


def test_throughput(spark):
    rows = T.throughput(step_frame(spark, 9), 4, 8, 1024, 2).orderBy("step").collect()
    assert [r.step for r in rows] == [4, 8]
    assert rows[0].tokens_per_s == 8 * 1024 * 4 * 2 / (0.25 * 2)
    assert rows[0].rows_per_s == 8 * 4 / (0.25 * 2)
    assert rows[0].true_tokens_per_s == pytest.approx(sum(10 + s for s in range(5)) / sum(0.25 * (1 + s % 3) for s in range(5)))


def test_closed_windows(spark):
    rows = spark.range(13).withColumnRenamed("id", "step").select("step", T.closed_windows(4).alias("n"))
    assert [r.n for r in rows.orderBy("step").collect()] == [s // 4 for s in range(13)]


def test_cadence(spark):
    rows = T.cadence(step_frame(spark, 61), 4, 6, 20, 30).collect()
    for r in rows:
        assert r.closes_window == (r.step > 0 and r.step % 4 == 0)
        assert r.logs_loss == (r.step > 0 and r.step % 12 == 0)
        assert r.logs_preference == (r.step > 0 and r.step % 6 == 0)
        assert r.evaluates == (r.step > 0 and r.step % 20 == 0)
        assert r.saves == (r.step > 0 and r.step % 30 == 0)


def curve(spark, n, column):
    return [r.v for r in spark.range(n).select("id", column.alias("v")).orderBy("id").collect()]


def test_schedules(spark):
    s = F.col("id")
    linear = curve(spark, 13, schedules.linear_warmup_decay(s, 4, 10, 2.0))
    assert linear[:5] == [0, 0.5, 1.0, 1.5, 2.0]
    assert linear[7] == pytest.approx(1.0) and linear[10:] == [0, 0, 0]
    assert curve(spark, 3, schedules.linear_warmup_decay(s, 0, 2, 1.0)) == [1.0, 0.5, 0.0]
    ramp = curve(spark, 13, schedules.linear_ramp(s, 10, 1.0))
    assert ramp[0] == pytest.approx(0.1) and ramp[5] == pytest.approx(0.55) and ramp[10:] == [1.0] * 3
    cosine = curve(spark, 11, schedules.cosine(s, 2, 10, 1.0, 0.1))
    assert cosine[:3] == pytest.approx([0.5, 1.0, 1.0]) and cosine[10] == pytest.approx(0.1)
    assert cosine[6] == pytest.approx(0.1 + 0.9 * 0.5 * (1 + math.cos(math.pi / 2)))
    with pytest.raises(PySparkException, match="past the end"):
        curve(spark, 12, schedules.cosine(s, 2, 10, 1.0, 0.1))


NUMBERS = [0.0, -0.0, 1.0, 5e-05, 0.0001, 0.00012, 0.001, 123.456, 9999999.0, 1e7, 12345678.25, 1.5e15, 1e16,
           1.2345e17, -3.5e-7, -0.00025, -2e9, 1e-10, 1.25e100, float("inf"), float("-inf"), 0.6931471805599453]


def spelled(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    return [r.t for r in df.select("i", formats.shortest(F.col("v")).alias("t")).orderBy("i").collect()]


def test_shortest_text_of_doubles(spark):
    assert spelled(spark, NUMBERS) == [repr(v) for v in NUMBERS]
    assert spelled(spark, [float("nan")]) == ["nan"]


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e12, 1e12).map(lambda x: round(x, 8)), min_size=30, max_size=60))
def test_shortest_text_reads_back_as_the_same_number(spark, values):
    for text, value in zip(spelled(spark, values), values):
        assert float(text) == value
        assert ("e" in text) == ("e" in repr(value))


def test_fixed_decimals(spark):
    values = [k / 128 for k in range(-300, 300)] + [0.1, 2.5, 1 / 3, 1234.5678901]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    rows = df.select("i", "v", formats.fixed(F.col("v"), 6).alias("six"), formats.fixed(F.col("v"), 4).alias("four"))
    for r in rows.collect():
        assert float(r.six) == float(f"{r.v:.6f}") and float(r.four) == float(f"{r.v:.4f}")
        if r.v > 0.001:
            assert (r.six, r.four) == (f"{r.v:.6f}", f"{r.v:.4f}")


REPORT = (
    "step bigint, loss double, reward_accuracy double, logp_chosen double, logp_rejected double,"
    "logp_chosen_ref double, logp_rejected_ref double, margin double, margin_ref double,"
    "nll_loss double, lr double, row_per_s double"
)


def report(spark):
    rows = [(s, 0.5 + s, 0.25, -1.5, -2.0, -1.0, -3.0, -0.5, -2.0, None if s == 6 else 1.25, 5e-05 * s, 123.0) for s in range(7)]
    return spark.createDataFrame(rows, REPORT)


def test_preference_log_lines(spark):
    lines = logs.dpo_log_lines(report(spark), 2).orderBy("step", "line_in_step").collect()
    assert [(r.step, r.line_in_step) for r in lines] == [(2, 0), (2, 1), (4, 0), (6, 0)]
    assert lines[0].value == (
        "step; loss; reward_accuracy; logp_chosen; logp_rejected; logp_chosen/ref; logp_rejected/ref; "
        "margin; margin/ref; nll_loss; lr; row/s"
    )
    assert lines[1].value == "2; 2.5; 0.25; -1.5; -2.0; -1.0; -3.0; -0.5; -2.0; 1.25; 0.0001; 123.0"
    assert "; nan; " in lines[3].value


def test_log_with_several_headers_is_read_back(spark, tmp_path):
    path = str(tmp_path / "log")
    lines = logs.dpo_log_lines(report(spark), 2)
    for run in ("a", "b"):
        for _ in range(2):  # a run that was started again appends its header again
            logs.append_log(lines.withColumn("run_id", F.lit(run)), path)
    back = logs.parse_dpo_log(logs.read_log(spark, path), "run_id").collect()
    assert len(back) == 2 * 2 * 3 and {r.run_id for r in back} == {"a", "b"}
    by_step = {r.step: r for r in back if r.run_id == "a"}
    assert by_step[2].loss == 2.5 and by_step[4].lr == 0.0002 and math.isnan(by_step[6].nll_loss)


def test_sft_log_lines_and_parse(spark):
    train = spark.createDataFrame([(4, 0.5), (8, 0.0078125), (12, 1.0)], "step bigint, loss double")
    val = spark.createDataFrame([(8, 2.00005)], "step bigint, loss double")
    lines = logs.sft_log_lines(train, val, 8)
    assert sorted(r.value for r in lines.collect()) == ["8 train 0.007812", f"8 val {2.00005:.4f}"]
    back = logs.parse_sft_log(lines).collect()
    assert {(r.step, r.kind) for r in back} == {(8, "train"), (8, "val")}
