"""Test input from the given tables: what grows with them."""

import pytest
from pyspark.sql import functions as F

from pairloom.plans import adapters as A


@pytest.fixture
def texts(spark, tmp_path):
    """A table of 30 words, the n-th of them n times, and what its vocabulary of 5 words must be."""
    words = [f"w{'abcdefghij'[n // 10]}{'abcdefghij'[n % 10]}" for n in range(1, 31)]
    rows = [(i, f"{w}\n") for i, w in enumerate(w for n, w in enumerate(words, 1) for _ in range(n))]
    rows += [(1000, None), (1001, ""), (1002, "same\nrank\ndiff\n")]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(30).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path), words[:-6:-1]


def test_only_pieces_that_may_get_an_id_are_numbered(spark, texts, monkeypatch):
    folder, expected = texts
    numbered, number = [], A.dense_index
    monkeypatch.setattr(A, "END_OF_TEXT_ID", 256 + 5)
    monkeypatch.setattr(A, "dense_index", lambda df, order: number(numbered.append(df) or df, order))
    monkeypatch.setattr(A, "with_special_tokens", lambda df: df)
    got = A.word_vocabulary(spark, folder).where("token_id >= 256").orderBy("token_id")
    assert [bytes(r.token).decode() for r in got.collect()] == expected
    assert numbered[0].count() == 5  # of 33


def test_the_commonest_rows_with_all_that_are_as_rare_as_the_last(spark):
    def kept(rarities, wanted):
        rows = spark.createDataFrame([(r,) for r in rarities], "rarity bigint")
        return sorted(r.rarity for r in A.commonest(rows, wanted).collect())

    assert kept([-9, -5, -5, -5, -2, -1, -1], 1) == [-9]
    assert kept([-9, -5, -5, -5, -2, -1, -1], 2) == [-9, -5, -5, -5]
    assert kept([-9, -5, -5, -5, -2, -1, -1], 4) == [-9, -5, -5, -5]
    assert kept([-9, -5, -5, -5, -2, -1, -1], 5) == [-9, -5, -5, -5, -2]
    assert kept([-1] * 4, 2) == [-1] * 4 and kept([-3, -1], 9) == [-3, -1]
    assert kept([], 3) == []


def test_rows_are_dealt_to_more_tasks_where_there_are_more_files(spark, texts):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    documents = A.table(spark, texts[0], "documents")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        dealt = A.dealt(documents)
        assert dealt.rdd.getNumPartitions() > 4 * 16
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(dealt.select("doc_id").collect()) == sorted(documents.select("doc_id").collect())
    assert A.dealt(spark.range(5).coalesce(1)).rdd.getNumPartitions() == 16
