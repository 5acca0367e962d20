import math
import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import brute
from pairloom.functions import scores as P
from pairloom.operators import sampling
from pairloom.operators import scoring as R


def pair_frame(spark, *rows):
    """rows: policy chosen/rejected, reference chosen/rejected."""
    return spark.createDataFrame(
        [(0, 0, i, *map(float, r), 2, 3) for i, r in enumerate(rows)],
        "rank int, batch_id bigint, pair_in_batch int, policy_chosen double, policy_rejected double,"
        "reference_chosen double, reference_rejected double, chosen_tokens bigint, rejected_tokens bigint",
    )


def losses(df, **options):
    return [r.loss for r in R.score_pairs(df, **options).orderBy("pair_in_batch").collect()]


PAIRS = [(-4, -6, -5, -5), (-5, -5, -5, -5), (-700, -2, -3, -900), (-2, -900, -700, -3), (0, 0, 0, 0)]


def gaps():
    return [(pc - pr) - (rc - rr) for pc, pr, rc, rr in PAIRS]


def logsig(x):
    return -math.log1p(math.exp(-x)) if x > -30 else x


def test_equal_scores_lose_ln_2(spark):
    assert losses(pair_frame(spark, (-5, -5, -5, -5))) == [pytest.approx(math.log(2), abs=1e-15)]


def test_loss_types(spark):
    df = pair_frame(spark, *PAIRS)
    assert losses(df) == pytest.approx([-logsig(0.1 * z) for z in gaps()])
    assert losses(df, label_smoothing=0.2) == pytest.approx(
        [-0.8 * logsig(0.1 * z) - 0.2 * logsig(-0.1 * z) for z in gaps()]
    )
    assert losses(df, loss_type="hinge", beta=0.5) == pytest.approx([max(0, 1 - 0.5 * z) for z in gaps()])
    assert losses(df, loss_type="ipo", beta=0.5) == pytest.approx([(z - 1) ** 2 for z in gaps()])
    with pytest.raises(ValueError):
        losses(df, loss_type="other")


def test_half_smoothing_is_even(spark):
    up = losses(pair_frame(spark, *PAIRS), label_smoothing=0.5)
    down = losses(pair_frame(spark, *[(b, a, d, c) for a, b, c, d in PAIRS]), label_smoothing=0.5)
    assert up == pytest.approx(down)


def test_report_of_a_batch(spark):
    df = pair_frame(spark, (-4, -6, -5, -5), (-5, -5, -5, -5), (-8, -2, -3, -3))
    r = R.preference_report(R.score_pairs(df)).first()
    assert r.pairs == 3
    assert r.reward_accuracy == pytest.approx(1 / 3)  # the tie does not count
    assert r.chosen_reward == pytest.approx(0.1 * (1 + 0 - 5) / 3)
    assert r.rejected_reward == pytest.approx(0.1 * (-1 + 0 + 1) / 3)
    assert r.margin == pytest.approx(17 / 3 - 13 / 3)  # positive: chosen is less likely
    assert r.margin_ref == pytest.approx(0)
    assert r.nll_loss == pytest.approx(17 / 6)


def test_nll_without_tokens_is_null(spark):
    df = pair_frame(spark, (0, -1, 0, -1)).withColumn("chosen_tokens", F.lit(0).cast("bigint"))
    assert R.preference_report(R.score_pairs(df)).first().nll_loss is None


def test_sequence_logprob_of_lists_and_of_rows(spark):
    data = [
        (1, [-100, -100, 5, 6], [-1.0, -2.0, -4.0]),
        (2, [-100, -100, -100], [-1.0, -2.0]),
        (3, [7], []),
        (4, [], []),
        (5, [3, 4], [-0.5]),
    ]
    df = spark.createDataFrame(data, "id int, y array<int>, logps array<double>")
    by_list = df.select("id", P.sequence_logprob(F.col("logps"), F.col("y")).alias("s"))
    got = {r.id: (r.s.logp, r.s.tokens) for r in by_list.collect()}
    assert got == {1: (-6.0, 2), 2: (0.0, 0), 3: (0.0, 0), 4: (0.0, 0), 5: (-0.5, 1)}
    rows = [(i, p + 1, y[p + 1], lp) for i, y, lps in data for p, lp in enumerate(lps)]
    tokens = spark.createDataFrame(rows, "id int, pos int, label int, logp double")
    by_row = {r.id: (r.logp, r.tokens) for r in R.sequence_logprobs(tokens, ["id"]).collect()}
    assert by_row == {i: got[i] for i in (1, 2, 5)}
    means = {r.id: r.loss for r in R.token_mean_loss(tokens, ["id"]).collect()}
    assert means == {1: 3.0, 2: None, 5: 0.5}


def test_scores_of_the_wrong_length_are_an_error(spark):
    df = spark.createDataFrame([([1, 2, 3], [-1.0])], "y array<int>, logps array<double>")
    with pytest.raises(PySparkException, match="differ in length"):
        df.select(P.sequence_logprob(F.col("logps"), F.col("y"))).collect()


def test_alignment_by_join(spark):
    scores = spark.createDataFrame([(1, 0, 0.5), (1, 1, 0.6), (1, 2, 0.7)], "id int, pos int, score double")
    labels = spark.createDataFrame([(1, 0, 10), (1, 1, 11), (1, 2, 12)], "id int, pos int, label int")
    got = R.align_with_labels(scores, labels, ["id"]).orderBy("pos").collect()
    assert [(r.pos, r.score, r.label) for r in got] == [(0, 0.5, 11), (1, 0.6, 12)]


def test_pairs_from_sides(spark):
    df = spark.createDataFrame(
        [(0, "chosen", -1.0, -2.0, 3), (0, "rejected", -4.0, -5.0, 6)],
        "pair int, side string, policy_logp double, reference_logp double, tokens bigint",
    )
    r = R.pair_scores(df, ["pair"]).first()
    assert (r.policy_chosen, r.policy_rejected, r.reference_chosen, r.reference_rejected) == (-1, -4, -2, -5)
    assert (r.chosen_tokens, r.rejected_tokens) == (3, 6)


def test_validation_loss_is_a_sum_by_default(spark):
    df = spark.createDataFrame(
        [(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0), (1, 1, 5.0)], "rank int, batch_id int, loss double"
    )
    assert R.validation_loss(df).first().validation_loss == 5.5
    assert R.validation_loss(df, "mean").first().validation_loss == 2.75


def logits(n, width, seed=3):
    rng = random.Random(seed)
    return [[rng.uniform(-60, 60) for _ in range(width)] for _ in range(n)]


def test_token_logprob_and_softmax(spark):
    rows = logits(20, 33) + [[1000.0, 1000.0], [-1000.0, 0.0]]
    df = spark.createDataFrame([(i, r, i % len(r)) for i, r in enumerate(rows)], "id int, e array<double>, y int")
    for r in df.select("id", "e", "y", P.token_logprob(F.col("e"), F.col("y")).alias("lp"),
                       P.softmax(F.col("e")).alias("p")).collect():
        assert r.lp == pytest.approx(brute.log_softmax_at(r.e, r.y), abs=1e-9)
        assert r.p == pytest.approx([math.exp(brute.log_softmax_at(r.e, k)) for k in range(len(r.e))])


def test_softmax_of_a_wide_row_is_linear_work(spark):
    width = 50_000
    df = spark.range(8).select(
        "id", F.transform(F.sequence(F.lit(1), F.lit(width)), lambda i: (i * 7919 % 1000) / 100.0).alias("e")
    )
    for r in df.select(P.softmax(F.col("e")).alias("p")).collect():
        assert len(r.p) == width and sum(r.p) == pytest.approx(1.0)


def test_token_logprob_and_top_k_from_rows(spark):
    rows = logits(12, 40)
    flat = [(i, i % 40, t, x) for i, r in enumerate(rows) for t, x in enumerate(r)]
    df = spark.createDataFrame(flat, "id int, label int, token_id int, logit double").repartition(5)
    for r in R.token_logprobs(df, ["id"]).collect():
        assert r.logp == pytest.approx(brute.log_softmax_at(rows[r.id], r.id % 40), abs=1e-9)
    best = sampling.topk_rows(df, ["id"], "logit", k=7).collect()
    for i, r in enumerate(rows):
        ranked = sorted(range(40), key=lambda t: (-r[t], t))[:7]
        assert [b.token_id for b in sorted(best, key=lambda b: b.place) if b.id == i] == ranked


def test_top_k_breaks_ties_by_id(spark):
    df = spark.createDataFrame([(0, [0.5, 2.0, 2.0, -1.0, 2.0])], "id int, e array<double>")
    got = sampling.topk_tokens(df, ["id"], "e", 4).orderBy("place").collect()
    assert [r.token_id for r in got] == [1, 2, 4, 0]
    assert len(sampling.topk_tokens(df, ["id"], "e", 50).collect()) == 5


def test_draws_are_repeatable_and_follow_the_weights(spark):
    e = [math.log(x) for x in (0.5, 0.3, 0.2, 1e-9)]
    df = spark.range(20_000).select("id", F.array(*[F.lit(x) for x in e]).alias("e"))
    first = sampling.draw_token(df, ["id"], "e", 1, 3)
    drawn = {r.id: r.token_id for r in first.collect()}
    assert drawn == {r.id: r.token_id for r in sampling.draw_token(df.repartition(7), ["id"], "e", 1, 3).collect()}
    share = Counter(drawn.values())
    for token, p in enumerate((0.5, 0.3, 0.2)):
        assert share[token] / 20_000 == pytest.approx(p, abs=0.015)
    assert set(share) == {0, 1, 2}
