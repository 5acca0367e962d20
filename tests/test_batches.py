import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import brute
from pairloom.functions.encoding import BpeEncoder, ByteEncoder, build_encoding
from pairloom.operators import batches as B
from pairloom.operators.ordering import dense_index
from pairloom.plans import adapters as A
from pairloom.plans import flows
from pairloom.sources import shards
from pairloom.sources import vocabulary as V
from pairloom.sources.datasets import DPO_COLUMNS, map_columns, scan

PROMPTS = ["q", "a longer question?", "", "<|endoftext|>", "é" * 30, "x" * 90, "short", "😀 ok"]
ANSWERS = ["yes", "", "an answer that is somewhat longer than the others", "ü", "n", "z" * 10, "end", "."]
OTHERS = ["no", "a", "b" * 70, "", "cc", "d", "the other end", "!!"]
ROWS = [
    (i, PROMPTS[i % 8], ANSWERS[(i * 3) % 8], OTHERS[(i * 5) % 8]) for i in range(22)
]


@pytest.fixture(scope="module", params=["bytes", "bpe"])
def encoder(request, spark):
    if request.param == "bytes":
        return ByteEncoder(), lambda t: list(t.encode())
    path = V.installed_ranks_path()
    ranks = V.decode_ranks_file(path) if path else {bytes([i]): i for i in range(256)}
    return BpeEncoder(spark, build_encoding(ranks)), build_encoding(ranks).encode_ordinary


def triples(rows):
    return {(r.rank, r.batch_id, r.row_in_batch): (r.x, r.mask, r.y) for r in rows}


@pytest.mark.parametrize("ranks, batch, limit", [(1, 4, 1024), (3, 2, 40), (2, 5, 1), (30, 2, 64)])
def test_sft_batches_equal_brute_force(spark, encoder, ranks, batch, limit):
    native, plain = encoder
    df = spark.createDataFrame([r[:3] for r in ROWS], "id int, prompt string, answer string")
    got = triples(flows.sft_flow(dense_index(df, ["id"]), native, ranks, batch, limit).collect())
    assert got == brute.sft_batches([r[1:3] for r in ROWS], plain, ranks, batch, limit)


@pytest.mark.parametrize("ranks, batch, limit", [(1, 4, 1024), (3, 2, 40), (2, 5, 1), (30, 2, 64)])
@pytest.mark.parametrize("batch_len, pick", [("shortest", min), ("longest", max)])
def test_dpo_batches_equal_brute_force(spark, encoder, ranks, batch, limit, batch_len, pick):
    native, plain = encoder
    df = spark.createDataFrame(ROWS, "id int, prompt string, chosen string, rejected string")
    rows = flows.dpo_flow(dense_index(df, ["id"]), native, ranks, batch, limit, batch_len).collect()
    assert triples(rows) == brute.dpo_batches([r[1:] for r in ROWS], plain, ranks, batch, limit, pick)
    for r in rows:
        assert r.side == ("chosen", "rejected")[r.row_in_batch % 2]
        assert r.pair_in_batch == r.row_in_batch // 2
        assert len(r.x) == len(r.mask) == len(r.y)
        assert all(y in (-100, x) for x, y in zip(r.x, r.y))


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan


@pytest.mark.parametrize("limit", [1, 10, 40, 1024])
def test_no_more_than_the_limit_reaches_the_batch(spark, limit):
    encoder = ByteEncoder()
    df = spark.createDataFrame(ROWS, "id int, prompt string, chosen string, rejected string")
    rows = B.encode_dpo(df, encoder).drop("prompt", "chosen", "rejected")
    replies = [f"{side}_reply_ids" for side in B.SIDES]
    whole = {r.id: r for r in rows.collect()}
    for r in B.cut_to_limit(rows, limit, replies).collect():
        for name in replies:
            ids = whole[r.id].prefix_ids + whole[r.id][name]
            assert r.prefix_ids + r[name] == ids[:limit]


def test_flow_from_source_order_shuffles_once(spark, sf_dir):
    from pairloom.operators.ordering import source_index
    indexed = source_index(spark, f"{sf_dir}/documents.parquet", ["source", "text"])
    named = indexed.withColumnsRenamed({"source": "prompt", "text": "answer"})
    rows, plan = exchanges(flows.sft_flow(named, ByteEncoder(), 4, 4))
    # one for the batches, one for the row counts of the files
    assert rows == 2, plan


def test_report_adds_no_shuffle_to_the_batches(spark, sf_dir):
    indexed = dense_index(A.preference_pairs(spark, sf_dir), ["conv_id", "turn"])
    rows = flows.dpo_flow(indexed, ByteEncoder(), 2, 2)
    before, _ = exchanges(rows)
    after, plan = exchanges(flows.dpo_report_flow(A.with_scores(rows), 5e-4))
    assert before == after, plan


def test_append_end_and_prompt_only(spark):
    df = spark.createDataFrame([("p", "a")], "prompt string, answer string")
    row = B.sft_samples(df, ByteEncoder(), append_end=True).first()
    assert row.input_ids == list(b"### Question: p\n ### Answer:a") + [50256]
    assert row.label_ids[-2:] == [97, 50256] and set(row.label_ids[:-2]) == {-100}
    rows = B.prompt_only(df, ByteEncoder(), 3).collect()
    assert [r.copy for r in rows] == [0, 1, 2]
    assert all(r.input_ids == list(b"### Question: p\n ### Answer:") for r in rows)


def test_shards_cover_all_rows_once(spark, encoder, tmp_path):
    native, plain = encoder
    df = spark.createDataFrame([r[:3] for r in ROWS], "id int, query string, response string")
    rows = flows.shard_flow(dense_index(df, ["id"]), native, 32, 5)
    path = shards.write_shards(rows, str(tmp_path), "toy")
    got = spark.read.parquet(path).orderBy("shard_id", "row_in_shard").collect()
    assert [(r.shard_id, r.row_in_shard) for r in got] == [divmod(i, 5) for i in range(22)]
    assert {r.shard for r in got} == {f"toy_train_{i:06d}" for i in range(5)}
    for r, (_, query, response, _) in zip(got, ROWS):
        ids = (
            plain("### User:") + plain(f" {query} ") + plain("### Assistant:") + plain(f" {response}")
        )
        assert r.tokens == brute.shard_tokens(ids, 32, 50257) and r.length == min(32, len(ids))


def test_shard_of_an_id_beyond_16_bits_is_an_error(spark):
    class Wide(ByteEncoder):
        def __call__(self, text):
            return F.array(F.lit(65536))

    df = spark.createDataFrame([("q", "r")], "query string, response string")
    with pytest.raises(PySparkException, match="16 bits"):
        B.shard_rows(df, ["a", F.col("query")], Wide(), 4, 50257).collect()


@pytest.mark.parametrize("n, given, size", [(10, None, 10), (10, 4, 4), (2_000_000, None, 1_000_000)])
def test_shard_size_rule(spark, n, given, size):
    row = spark.range(1).select(shards.shard_size(F.lit(n), given).alias("s")).first()
    assert row.s == size
    assert spark.range(1).select(shards.shard_size(None).alias("s")).first().s == 1_000_000


def test_empty_dataset_gives_no_shard(spark, tmp_path):
    df = spark.createDataFrame([], "id int, query string, response string")
    rows = flows.shard_flow(dense_index(df, ["id"]), ByteEncoder(), 8)
    assert rows.count() == 0


def test_column_mapping(spark):
    df = spark.createDataFrame([("p", "c", "r", 1), (None, "c", "r", 2)], "prompt string, chosen string, rejected string, k int")
    assert map_columns(df, DPO_COLUMNS, ["k"], "drop").collect() == [(1, "p", "c", "r")]
    with pytest.raises(PySparkException, match="NULL in column prompt"):
        map_columns(df, DPO_COLUMNS).collect()
    with pytest.raises(ValueError, match="answer_text"):
        map_columns(df, {"answer": "answer_text"})


def test_scan_formats_and_split_pushdown(spark, tmp_path):
    df = spark.createDataFrame([("train", "a"), ("test", "b")], "split string, text string")
    df.write.json(f"{tmp_path}/j")
    df.write.csv(f"{tmp_path}/c", header=True)
    df.write.parquet(f"{tmp_path}/p")
    schema = "split string, text string"
    for format, folder, options in (("json", "j", {}), ("csv", "c", {"header": "true"}), ("parquet", "p", {})):
        got = scan(spark, f"{tmp_path}/{folder}", format, schema, "test", **options)
        assert [r.text for r in got.collect()] == ["b"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(split,test)" in plan


def test_ids_of_shard_rows_are_checked_once(spark):
    df = spark.createDataFrame([("ab", "cd"), ("", "x" * 30)], "query string, response string")
    rows = B.shard_rows(df, [F.col("query"), F.col("response")], ByteEncoder(), 8, 50257)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("raise_error") == 1
    assert rows.orderBy("query").first().length == 8
