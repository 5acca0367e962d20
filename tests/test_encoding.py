import pytest
import tiktoken
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairloom.functions import encoding as E
from pairloom.functions.templates import as_text, dpo_prefix, sft_prefix, shard_segments
from pairloom.sources import vocabulary as V

TEXTS = [
    "", " ", "plain words", "Ünïcode wörds, naïve café", "emoji 😀👩‍👩‍👧 done", "tabs\tand\n\nlines  ",
    "<|endoftext|> is plain text <|pad|>", "it's we'll they've", "a\x00b", "日本語テキスト", "   lead",
    "no break  em", "12 345 six7", "é" * 300,
]


@pytest.fixture(scope="module")
def ranks():
    path = V.installed_ranks_path()
    return V.decode_ranks_file(path) if path else {bytes([i]): i for i in range(256)}


@pytest.fixture(scope="module")
def bpe(spark, ranks):
    return E.BpeEncoder(spark, E.build_encoding(ranks))


def frame(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def test_byte_ids_are_utf8(spark):
    rows = frame(spark).select("id", E.ByteEncoder()(F.col("text")).alias("ids")).collect()
    assert {r.id: r.ids for r in rows} == {i: list(t.encode()) for i, t in enumerate(TEXTS)}


def test_byte_constant_equals_column(spark):
    enc = E.ByteEncoder()
    row = spark.range(1).select(
        enc.constant("\n ### Änswer:").alias("a"), enc(F.lit("\n ### Änswer:")).alias("b")
    ).first()
    assert row.a == row.b


def test_bpe_equals_the_library_on_the_same_ranks(spark, bpe, ranks):
    plain = E.build_encoding(ranks)
    rows = frame(spark).repartition(3).select("id", bpe(F.col("text")).alias("ids")).collect()
    assert {r.id: r.ids for r in rows} == {i: plain.encode_ordinary(t) for i, t in enumerate(TEXTS)}


def test_bpe_keeps_nulls(spark, bpe):
    df = spark.createDataFrame([(None,), ("x",)], "text string")
    assert [r.ids for r in df.select(bpe(F.col("text")).alias("ids")).collect()][0] is None


def test_decode_undoes_bpe(spark, bpe):
    rows = frame(spark).select(
        "text", E.decode_ids(bpe(F.col("text")), bpe.vocabulary()).alias("back")
    ).collect()
    assert all(r.text == r.back for r in rows)


def test_decode_of_cut_characters_and_special_ids(spark, bpe, ranks):
    plain = E.build_encoding(ranks)
    ids = plain.encode_ordinary("naïve 😀 日本語")
    cases = [ids[:i] for i in range(len(ids) + 1)] + [[50256, 50257, 50258], [255, 3, 200, 128]]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "id int, ids array<int>")
    rows = df.select("id", E.decode_ids(F.col("ids"), bpe.vocabulary()).alias("t")).collect()
    assert {r.id: r.t for r in rows} == {i: plain.decode(c) for i, c in enumerate(cases)}


def test_segments_are_encoded_alone(spark, bpe, ranks):
    plain = E.build_encoding(ranks).encode_ordinary
    df = spark.createDataFrame([("what is it", "an answer")], "p string, a string")
    p, a = F.col("p"), F.col("a")
    row = df.select(
        E.encode_segments(sft_prefix(p), bpe).alias("sft"),
        E.encode_segments(dpo_prefix(p), bpe).alias("dpo"),
        E.encode_segments(shard_segments(p, a), bpe).alias("shard"),
        as_text(shard_segments(p, a)).alias("text"),
    ).first()
    assert row.sft == plain("### Question: ") + plain("what is it") + plain("\n ### Answer:")
    assert row.dpo == plain("Question: ") + plain("what is it") + plain("\n\nAnswer: ")
    assert row.shard == (
        plain("### User:") + plain(" what is it ") + plain("### Assistant:") + plain(" an answer")
    )
    assert row.text == "### User: what is it ### Assistant: an answer"
    if len(ranks) > 256:
        assert row.sft != plain("### Question: what is it\n ### Answer:")


def test_bytes_in_arrow_batches_equal_the_expression(spark):
    arrow = E.ArrowByteEncoder()
    for texts in ([None, *TEXTS, None, "x" * 5000], [None], [""], []):
        rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3).select(
            "text", arrow(F.col("text")).alias("ids"),
            E.encode_segments(["a", F.col("text")], arrow).alias("joined"),
            E.encode_segments(["a", F.col("text")], E.ByteEncoder()).alias("expected"),
        ).collect()
        assert len(rows) == len(texts) and all(r.joined == r.expected for r in rows)
        assert all(r.ids == (None if r.text is None else list(r.text.encode())) for r in rows)


def test_pieces_cover_the_text(spark):
    rows = frame(spark).select("text", E.pieces(F.col("text")).alias("p")).collect()
    assert all("".join(r.p) == r.text for r in rows)


def test_word_lookup_falls_back_to_bytes(spark):
    encoder = E.WordEncoder(spark, {" words": 300, "plain": 301, "é": 302})
    got = {
        r.id: r.ids for r in
        frame(spark).repartition(3).select("id", encoder(F.col("text")).alias("ids")).collect()
    }
    assert got[0] == []
    assert got[1] == [32]
    assert got[2] == [301, 300]
    assert got[4] == list("emoji 😀👩‍👩‍👧 done".encode())
    row = spark.range(1).select(
        E.encode_segments(["plain words", F.lit("plain é")], encoder).alias("ids")
    ).first()
    assert row.ids == [301, 300, 301, *" é".encode()]


def test_word_lookup_of_nulls_empties_and_unknown_rows(spark):
    encoder = E.WordEncoder(spark, {"a": 256, " a": 257})
    texts = [None, "", "a a", "b", None, "a b a", "", "ab"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").coalesce(1)
    got = {r.id: r.ids for r in df.select("id", encoder(F.col("text")).alias("ids")).collect()}
    assert got == {
        0: None, 1: [], 2: [256, 257], 3: [98], 4: None, 5: [256, 32, 98, 257], 6: [], 7: [97, 98]
    }


def test_word_lookup_equals_plain_python_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = docs.select("doc_id", E.pieces(F.col("text")).alias("p")).collect()
    words = {}
    for r in rows[::2]:
        for p in r.p[::3]:
            words.setdefault(p, 256 + len(words))
    words = {p: i for p, i in words.items() if i < 60_000}
    encoder = E.WordEncoder(spark, words)
    got = {r.doc_id: r.ids for r in docs.select("doc_id", encoder(F.col("text")).alias("ids")).collect()}
    for r in rows:
        expected = []
        for p in r.p:
            expected += [words[p]] if p in words else list(p.encode())
        assert got[r.doc_id] == expected


def test_vocabulary_join_with_one_piece_holding_most_rows(spark):
    vocabulary = spark.createDataFrame([("hot", 400), ("warm", 401)], "token string, token_id int")
    tokens = spark.createDataFrame([("hot",)] * 500 + [("warm",), ("cold",)], "piece string")
    got = E.join_vocabulary(tokens, vocabulary).groupBy("piece", "token_id").count().collect()
    assert {(r.piece, r.token_id, r["count"]) for r in got} == {("hot", 400, 500), ("warm", 401, 1), ("cold", None, 1)}


def test_vocabulary_table_and_ranks(spark, tmp_path, ranks):
    import base64
    path = tmp_path / "ranks.txt"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for t, i in ranks.items()))
    table = V.with_special_tokens(V.read_ranks(spark, str(path)))
    assert table.count() == len(ranks) + 3
    specials = {bytes(r.token).decode(): r.token_id for r in table.where("is_special").collect()}
    assert specials == {"<|endoftext|>": 50256, "<|endofprompt|>": 50257, "<|pad|>": 50258}
    assert V.ranks_of(table) == ranks
    literal = E.vocabulary_literal(table)
    row = spark.range(1).select(
        E.decode_ids(F.array(F.lit(50257), F.lit(ranks[b"a"])), literal).alias("t")
    ).first()
    assert row.t == "<|endofprompt|>a"


def test_vocabulary_beyond_16_bits_is_refused(spark):
    wide = spark.createDataFrame([(bytearray(b"x"), 65536, False)], V.SCHEMA)
    with pytest.raises(ValueError):
        E.vocabulary_literal(wide)
    with pytest.raises(ValueError):
        E.BpeEncoder(spark, toy_encoding(65536))


def toy_encoding(last_id):
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256}
    return tiktoken.Encoding(
        "toy", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={"<end>": last_id}
    )


def test_any_given_encoding_can_be_used(spark):
    toy = toy_encoding(300)
    encoder = E.BpeEncoder(spark, toy)
    rows = frame(spark).select(
        "text", encoder(F.col("text")).alias("ids"),
        E.decode_ids(F.array(F.lit(256), F.lit(300), F.lit(99)), encoder.vocabulary()).alias("t"),
    ).collect()
    assert all(r.ids == toy.encode_ordinary(r.text) and r.t == "ab<end>c" for r in rows)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), min_size=1, max_size=20))
def test_round_trip_of_any_text(spark, bpe, texts):
    rows = frame(spark, texts).select(
        "text", E.decode_ids(bpe(F.col("text")), bpe.vocabulary()).alias("back"),
        E.ByteEncoder()(F.col("text")).alias("bytes"),
    ).collect()
    for r in rows:
        assert r.back == r.text and r.bytes == list(r.text.encode())
