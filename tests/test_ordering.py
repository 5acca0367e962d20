import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pairloom.operators import ordering as O
from pairloom.operators.distribution import assign_batches, rank_split, steps_per_rank


def skewed(spark, n=3000, partitions=4):
    """A third of all rows share the leading key."""
    rows = [(0 if i % 3 == 0 else i % 50, f"k{i * 7919 % 100_003:06d}", i) for i in range(n)]
    random.Random(5).shuffle(rows)
    return rows, spark.createDataFrame(rows, "a int, b string, v int").repartition(partitions)


@pytest.mark.parametrize("partitions", [1, 4, 200])
@pytest.mark.parametrize("ranges", [None, 1, 7, 64])
def test_dense_index_equals_a_sort(spark, partitions, ranges):
    rows, df = skewed(spark, partitions=partitions)
    got = O.dense_index(df, ["a", "b"], ranges=ranges).collect()
    expected = {(a, b): i for i, (a, b, _) in enumerate(sorted(rows))}
    assert {(r.a, r.b): r.idx for r in got} == expected
    assert {r.n_rows for r in got} == {len(rows)}


def test_a_hot_leading_key_is_spread_over_many_ranges(spark):
    _, df = skewed(spark)
    cuts = O._cut_points(df.select("a", "b"), 3000, 30)
    sizes = [r["count"] for r in df.groupBy(O._range_of(cuts, 30, ["a", "b"]).alias("r")).count().collect()]
    assert len(sizes) == 30 and max(sizes) < 400


def test_cut_points_from_a_sample_still_number_every_row(spark, monkeypatch):
    monkeypatch.setattr(O, "SAMPLES_PER_RANGE", 2)
    rows, df = skewed(spark)
    got = O.dense_index(df, ["a", "b"], ranges=50).collect()
    assert sorted(r.idx for r in got) == list(range(len(rows)))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.idx)] == [x[:2] for x in sorted(rows)]


def test_a_key_that_is_not_unique_is_an_error(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "a int")
    with pytest.raises(PySparkException, match="not unique"):
        O.dense_index(df, ["a"]).collect()


def test_empty_input(spark):
    df = spark.createDataFrame([], "a int")
    assert O.dense_index(df, ["a"]).collect() == []
    assert O.seeded_shuffle(df, ["a"], 1).collect() == []


@pytest.mark.parametrize("ranges", [1, 5, 64, None])
def test_seeded_shuffle_is_repeatable_and_complete(spark, ranges):
    df = spark.range(1000).withColumnRenamed("id", "k")
    first = {r.k: r.idx for r in O.seeded_shuffle(df.repartition(3), ["k"], 9).collect()}
    again = {r.k: r.idx for r in O.seeded_shuffle(df.repartition(50), ["k"], 9, ranges=ranges).collect()}
    other = {r.k: r.idx for r in O.seeded_shuffle(df, ["k"], 10).collect()}
    assert first == again != other
    assert sorted(first.values()) == list(range(1000)) == sorted(other.values())
    assert sum(first[k] == k for k in first) < 20


def test_source_index_follows_files_and_places(spark, tmp_path):
    for part, (lo, hi) in enumerate([(0, 40), (40, 41), (41, 100)]):
        spark.range(lo, hi).coalesce(1).write.parquet(f"{tmp_path}/data/part={part}")
    got = O.source_index(spark, f"{tmp_path}/data", ["id"]).collect()
    assert all(r.idx == r.id and r.n_rows == 100 for r in got) and len(got) == 100


def test_source_index_over_too_many_files_is_refused(spark, tmp_path):
    spark.range(100).repartition(5).write.parquet(f"{tmp_path}/data")
    assert O.source_index(spark, f"{tmp_path}/data", ["id"], max_files=5).count() == 100
    with pytest.raises(ValueError, match="more than 2 files"):
        O.source_index(spark, f"{tmp_path}/data", ["id"], max_files=2)


def test_source_index_does_not_shuffle_rows(spark, sf_dir):
    df = O.source_index(spark, f"{sf_dir}/documents.parquet", ["doc_id", "text"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    text_side = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in text_side and "SortMergeJoin" not in plan


@pytest.mark.parametrize("n, percent, kept", [(10, 50, 5), (5, 50, 2), (7, 50, 4), (1, 50, 0), (4, 100, 4)])
def test_slice_bound_rounds_half_to_even(spark, n, percent, kept):
    df = spark.range(n).select(F.col("id").alias("idx"), F.lit(n).cast("bigint").alias("n_rows"))
    head = O.split_slice(df, 0, percent)
    tail = O.split_slice(df, percent, 100)
    assert (head.count(), tail.count()) == (kept, n - kept)
    assert sorted(r.idx for r in tail.collect()) == list(range(n - kept))
    assert all(r.n_rows == n - kept for r in tail.collect())


@pytest.mark.parametrize("n, ranks, batch", [(0, 2, 3), (1, 2, 3), (7, 3, 2), (12, 4, 3), (100, 7, 4)])
def test_ranks_are_disjoint_and_equal(spark, n, ranks, batch):
    df = spark.range(n).select(F.col("id").alias("idx"), F.lit(n).cast("bigint").alias("n_rows"))
    rows = assign_batches(rank_split(df, ranks), batch).collect()
    each = n // ranks
    assert len(rows) == each * ranks
    for r in rows:
        assert (r.rank, r.pos) == (r.idx % ranks, r.idx // ranks)
        assert (r.batch_id, r.row_in_batch) == (r.pos // batch, r.pos % batch)
        assert r.rank_steps == -(-each // batch) == steps_per_rank(n, ranks, batch)
    if rows:
        assert max(r.batch_id for r in rows) + 1 == steps_per_rank(n, ranks, batch)
