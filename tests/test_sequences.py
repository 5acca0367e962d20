import pytest
from pyspark.sql import functions as F

import brute
from pairloom.functions import sequences as S
from pairloom.operators import batches as B
from pairloom.operators import checks


def lists(spark, *rows):
    return spark.createDataFrame([(i, list(r)) for i, r in enumerate(rows)], "id int, ids array<int>")


CASES = ([], [1], [1, 2, 3], [1, 2, 3, 4], [1, 2, 3, 4, 5], list(range(20)))


def test_pad_or_truncate_below_at_and_above_the_length(spark):
    rows = lists(spark, *CASES).select(
        "id", S.pad_or_truncate(F.col("ids"), 4).alias("x"),
        S.pad_or_truncate(F.col("ids"), F.lit(4), -100).alias("y"),
        S.attention_mask(F.size("ids"), 4).alias("mask"),
    ).collect()
    for r in rows:
        assert r.x == brute.fit(CASES[r.id], 4, 50256)
        assert r.y == brute.fit(CASES[r.id], 4, -100)
        assert r.mask == brute.mask_of(len(CASES[r.id]), 4)
        assert sum(r.mask) == min(4, len(CASES[r.id]))


def test_pad_to_length_zero(spark):
    row = lists(spark, [1, 2]).select(
        S.pad_or_truncate(F.col("ids"), 0).alias("x"), S.attention_mask(F.size("ids"), 0).alias("m")
    ).first()
    assert row.x == [] and row.m == []


def test_cut_list_ends_with_the_end_id_but_a_full_one_does_not(spark):
    rows = lists(spark, *CASES).select(
        "id", S.pad_or_cut_with_end(F.col("ids"), 4).alias("t")
    ).collect()
    for r in rows:
        assert r.t == brute.shard_tokens(CASES[r.id], 4, 50257)
    assert {r.id: r.t for r in rows}[3] == [1, 2, 3, 4]


def test_labels_ignore_the_prefix(spark):
    df = spark.createDataFrame(
        [([1, 2], [3]), ([], [3, 4]), ([5], [])], "p array<int>, a array<int>"
    )
    got = [r.y for r in df.select(S.mask_labels(F.col("p"), F.col("a")).alias("y")).collect()]
    assert got == [[-100, -100, 3], [3, 4], [-100]]


@pytest.mark.parametrize("ids, bad", [([0, 65535], 0), ([65536], 1), ([-1, 7, 70000], 2), ([], 0)])
def test_range_report(spark, ids, bad):
    row = checks.range_report(lists(spark, ids), "ids", "id").first()
    assert (row.n_ids, row.n_out_of_range) == (len(ids), bad)


def test_length_violations(spark):
    df = lists(spark, *CASES)
    assert [r.id for r in checks.length_violations(df, "ids", 4).orderBy("id").collect()] == [0, 1, 2, 4, 5]


def test_shift_pairs_score_with_next_label(spark):
    df = spark.createDataFrame(
        [([0.1, 0.2, 0.3], [7, 8, 9]), ([0.5], [4]), ([], [])], "s array<double>, y array<int>"
    )
    got = [
        [(p.score, p.label) for p in r.p]
        for r in df.select(S.shifted_pairs(F.col("s"), F.col("y")).alias("p")).collect()
    ]
    assert got == [[(0.1, 8), (0.2, 9)], [], []]


@pytest.mark.parametrize("length, ok", [(1, True), (256, True), (0, False), (100, False), (-4, False)])
def test_sequence_length_must_be_a_power_of_two(length, ok):
    if ok:
        B.check_power_of_two(length)
    else:
        with pytest.raises(ValueError):
            B.check_power_of_two(length)


def test_all_in_range_agrees_with_the_count(spark):
    rows = spark.createDataFrame([([0, 65535],), ([-1],), ([65536, 3],), ([],), ([None, 5],), ([None],)], "ids array<int>")
    got = rows.select(S.all_in_range(F.col("ids")).alias("a"), S.out_of_range(F.col("ids")).alias("n")).collect()
    assert all(r.a == (r.n == 0) for r in got)
    assert spark.sql("SELECT CAST(NULL AS array<int>) AS ids").select(S.all_in_range(F.col("ids"))).first()[0] is False
