"""Every query against its SQL, and the properties that have no SQL."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
import brute
from pairloom.functions.encoding import build_encoding
from pairloom.plans import adapters as A
from pairloom.plans import queries as Q
from pairloom.sources import vocabulary as V

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
ROWS_ONLY = {"encode_bpe", "sft_batches_bpe", "dpo_batches_bpe", "shard_bpe"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def comparable(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple(repr(row[i]) for i in order) for row in rows)
    )


def test_only_byte_pair_queries_have_no_sql():
    corpus = set(contract.CORPUS_QUERIES)  # tested in tests/llm
    assert set(contract.queries()) - set(contract.oracle_sql()) - corpus == ROWS_ONLY
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(set(contract.oracle_sql()) - set(contract.CORPUS_QUERIES)))
def test_query_equals_sql(spark, duck, sf_dir, name):
    df = contract.queries()[name](spark, sf_dir)
    cursor = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert comparable(df.collect(), df.columns) == comparable(cursor.fetchall(), columns)


def test_entry_is_the_report(spark):
    df = contract.entry(spark)
    assert {"rank", "batch_id", "loss", "margin", "nll_loss", "lr"} <= set(df.columns)
    assert df.count() > 0


@pytest.fixture(scope="module")
def encode():
    path = V.installed_ranks_path()
    ranks = V.decode_ranks_file(path) if path else {bytes([i]): i for i in range(256)}
    return build_encoding(ranks).encode_ordinary


def test_bpe_queries_equal_brute_force(spark, sf_dir, encode):
    texts = A.table(spark, sf_dir, "documents").orderBy("doc_id").collect()
    got = {r.doc_id: r.ids for r in Q.encode_bpe(spark, sf_dir).collect()}
    assert got == {t.doc_id: encode(t.text) for t in texts}

    shard = {(r.shard_id, r.row_in_shard): (r.tokens, r.length) for r in Q.shard_bpe(spark, sf_dir).collect()}
    for i, t in enumerate(texts):
        ids = encode("### User:") + encode(f" {t.source} ") + encode("### Assistant:") + encode(f" {t.text}")
        assert shard[divmod(i, Q.SHARD)] == (brute.shard_tokens(ids, 256, 50257), min(256, len(ids)))

    rows = Q.sft_batches_bpe(spark, sf_dir).collect()
    expected = brute.sft_batches([(t.source, t.text) for t in texts], encode, Q.RANKS, Q.BATCH, 1024)
    assert {(r.rank, r.batch_id, r.row_in_batch): (r.x, r.mask, r.y) for r in rows} == expected


def test_bpe_pair_batches_equal_brute_force(spark, sf_dir, encode):
    pairs = A.preference_pairs(spark, sf_dir).orderBy("conv_id", "turn").collect()
    rows = Q.dpo_batches_bpe(spark, sf_dir).collect()
    expected = brute.dpo_batches(
        [(p.prompt, p.chosen, p.rejected) for p in pairs], encode, Q.RANKS, Q.BATCH, 1024
    )
    assert {(r.rank, r.batch_id, r.row_in_batch): (r.x, r.mask, r.y) for r in rows} == expected


def test_flagship_equals_brute_force(spark, sf_dir):
    """The whole report again in plain Python, from the source rows on."""
    pairs = A.preference_pairs(spark, sf_dir).orderBy("conv_id", "turn").collect()
    batches = brute.dpo_batches(
        [(p.prompt, p.chosen, p.rejected) for p in pairs], lambda t: list(t.encode()), Q.RANKS, Q.BATCH, 1024
    )

    def summed(labels, a, b, m):
        return sum(-((y * a + pos * b) % m) / 16 for pos, y in enumerate(labels) if pos and y != -100)

    groups = {}
    for (rank, batch, row), (_, _, y) in sorted(batches.items()):
        groups.setdefault((rank, batch), []).append(
            (summed(y, 31, 1, 97), summed(y, 17, 3, 89), sum(v != -100 for v in y[1:]))
        )
    got = {(r.rank, r.batch_id): r for r in contract.entry(spark).collect()}
    assert set(got) == set(groups)
    for key, rows in groups.items():
        chosen, rejected = rows[0::2], rows[1::2]
        z = [(c[0] - r[0]) - (c[1] - r[1]) for c, r in zip(chosen, rejected)]
        n = len(chosen)
        mean = lambda side, which: sum(s[which] for s in side) / n
        r = got[key]
        assert r.loss == pytest.approx(sum(math.log1p(math.exp(-abs(0.1 * v))) + max(-0.1 * v, 0) for v in z) / n, abs=1e-7)
        assert r.reward_accuracy == pytest.approx(
            sum((c[0] - c[1]) > (x[0] - x[1]) for c, x in zip(chosen, rejected)) / n, abs=1e-7
        )
        assert r.logp_chosen == pytest.approx(mean(chosen, 0), abs=1e-7)
        assert r.margin == pytest.approx(abs(mean(chosen, 0)) - abs(mean(rejected, 0)), abs=1e-7)
        tokens = sum(c[2] for c in chosen)
        if tokens:
            assert r.nll_loss == pytest.approx(-sum(c[0] for c in chosen) / tokens, abs=1e-7)
        else:
            assert r.nll_loss is None
