"""Importance resampling, the conversation trie and the url filter against plain versions of themselves."""

import hashlib
import math
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pairloom.llm import conversation_trie, importance, url_filter

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def runs(text, longest):
    found = re.findall(WORD, lower(text))
    return [" ".join(found[i:i + n]) for n in range(1, longest + 1) for i in range(len(found) - n + 1)]


# 11 --------------------------------------------------------------------------------

def random_texts(rng, n):
    letters = "abcXYZ09é🙂\x80"
    made = []
    for _ in range(n):
        words = ["".join(rng.choices(letters, k=rng.choice((1, 2, 3, 70, 200)))) for _ in range(rng.randrange(40))]
        made.append("".join(w + rng.choice((" ", "\n", "--", "\x7f", "_", ", ")) for w in words))
    return [*made, None, "", " \n", "-", "a", "\x01\x010 1"]


def test_crcs_of_runs_are_composed():
    rng = random.Random(3)
    for _ in range(50):
        parts = [bytes(rng.randrange(256) for _ in range(rng.randrange(1, 90))) for _ in range(2)]
        got = importance.composed(
            np.array([zlib.crc32(parts[0])], np.uint32), np.array([zlib.crc32(parts[1])], np.uint32), np.array([len(parts[1])])
        )
        assert got[0] == zlib.crc32(b"".join(parts))


@pytest.mark.parametrize("block", (16, 300, importance.BLOCK_BYTES))
def test_runs_of_one_to_three_words_in_blocks_of_any_size(monkeypatch, block):
    monkeypatch.setattr(importance, "BLOCK_BYTES", block)
    texts = random_texts(random.Random(block), 30)
    owner, crc, length = importance.payloads([(t or "").encode() for t in texts])
    found = [w.encode() for t in texts for w in runs(t, 1)]
    assert crc.tolist() == [zlib.crc32(w) for w in found] and length.tolist() == [len(w) for w in found]
    got = defaultdict(Counter)
    for o, b in importance.run_buckets(owner, crc, length, 3, 997):
        for i, x in zip(o.tolist(), b.tolist()):
            got[i][x] += 1
    for i, t in enumerate(texts):
        assert got[i] == Counter(zlib.crc32(r.encode()) % 997 for r in runs(t, 3))


def test_resampling_by_pairs_of_words(spark):
    rng = random.Random(8)
    words = ["alpha", "beta", "gamma", "delta", "eps"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(15, 40)))) for i in range(60)] + [(7, "alpha beta " * 20), (7, "alpha beta " * 20), (None, "beta " * 30)]
    target = [("alpha beta gamma",), ("ALPHA, beta",), (None,)]
    got = importance.resampled(
        spark.createDataFrame(docs, "id bigint, said string").withColumn("score", F.lit("clash")), spark.createDataFrame(target, "t string"),
        "id", "said", "t", longest=2, buckets=50, least_words=20, percent=25, seed=5,
    ).collect()
    count = lambda texts: Counter(zlib.crc32(r.encode()) % 50 for t in texts for r in runs(t, 2))
    s, t = count([d for _, d in docs]), count([d for d, in target])
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + 50) / ((s[b] + 1) * (t.total() + 50)))) for b in range(50)}
    expected = []
    for i, text in docs:
        found = [zlib.crc32(r.encode()) % 50 for r in runs(text, 2)]
        weight = sum(gain[b] for b in found) // len(found)
        h = int(hashlib.sha256(f"5:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        expected.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(runs(text, 1))))
    order = sorted((e for e in expected if e[4] >= 20), key=lambda e: (-e[3], e[0] is None, e[0]))
    drawn = Counter((*e[:4], k + 1) for k, e in enumerate(order[:len(order) // 4]))
    rest = Counter((*e[:4], None) for e in [*order[len(order) // 4:], *(e for e in expected if e[4] < 20)])
    assert Counter(map(tuple, got)) == drawn + rest
    weights = {e[0]: e[2] for e in expected}
    assert weights[7] == max(weights.values())  # made of what the target is made of


def test_no_target_and_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    docs = spark.createDataFrame([(1, "one two " * 20)], "doc_id bigint, text string")
    assert importance.resampled(docs, empty, percent=100).collect()[0].rank == 1
    assert importance.resampled(empty, docs).count() == 0
    with pytest.raises(ValueError, match="buckets"):
        importance.resampled(docs, docs, buckets=0)


# 12 --------------------------------------------------------------------------------

def plain_trie(sequences):
    """Nodes of {conv_id: [(digest, size)]} by looking at every beginning."""
    members, size = defaultdict(list), {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(t for t, _ in turns[:d])].append(c)
            size[tuple(t for t, _ in turns[:d])] = turns[d - 1][1] if d else 0
    rows = []
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        ends = sorted(c for c in convs if len(sequences[c]) == len(node))
        rows.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), sum(len(n) == len(node) + 1 for n in below),
            sum(not any(len(m) > len(n) and m[:len(n)] == n for m in below) for n in below),
            sum((len(members[n]) - 1) * size[n] for n in below), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


@pytest.mark.parametrize("shards", (1, 3, 40))
def test_trie_of_alike_long_and_empty_conversations(spark, shards, monkeypatch):
    monkeypatch.setattr(conversation_trie, "shuffle_tasks", lambda spark: shards)
    monkeypatch.setattr(conversation_trie, "PIECE_IDS", 7)
    rng = random.Random(shards)
    digest = {i: hashlib.md5(b"%d" % i).digest() for i in range(4)}
    sequences = {}
    for c in range(-20, 140):
        n = rng.choice((0, 1, 2, 3, 5, 16, 17, 40))
        turns = [0] * 40 if c % 3 == 0 else [rng.choice((0, 0, 0, 1, 2, 3)) for _ in range(n)]  # a third is one conversation
        sequences[c] = [(digest[t], t * 10 + 1) for t in turns]
    rows = [(c, b"".join(d for d, _ in t), [s for _, s in t]) for c, t in sequences.items()]
    got = conversation_trie.trie(spark.createDataFrame(rows, "conv_id bigint, ids binary, sizes array<int>"))
    assert sorted(map(tuple, got.collect()), key=str) == plain_trie(sequences)


def test_only_turnless_conversations_make_the_root_a_leaf(spark):
    rows = [(c, b"", []) for c in (5, 3, 4)]
    got = conversation_trie.trie(spark.createDataFrame(rows, "conv_id bigint, ids binary, sizes array<int>")).collect()
    assert [tuple(r) for r in got] == [(3, 0, None, 3, 0, 1, 0, hashlib.sha256(b"3,4,5").hexdigest())]


def test_a_conversation_of_many_turns(spark):
    turns = spark.range(20_000).select(F.lit(10).alias("conv_id"), (-F.col("id")).alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    got = conversation_trie.trie(conversation_trie.rebuilt(conversation_trie.sequences(turns)))
    assert got.agg(F.count("*"), F.max("depth"), F.sum("n_leaves"), F.sum("saved_tokens")).first() == (20_001, 20_000, 20_001, 0)


# 13 --------------------------------------------------------------------------------

URLS = [
    ("http://A.Net/x?y#z", "a.net", "/x", "net/", "block"), ("https://example.net/en/1", "example.net", "/en/1", "example.net/en/", "allow"),
    ("https://www.EXAMPLE.net/en/", "www.example.net", "/en/", "example.net/en/", "allow"), ("http://badexample.net/en/", "badexample.net", "/en/", "net/", "block"),
    ("ftp://example.com/de/?a", "example.com", "/de/", "example.com/de/", "block"), ("x://b.org/fr/a#b?c", "b.org", "/fr/a", "org/fr/", "allow"),
    ("http://net", "net", "", None, None), ("http://net?/en/", "net", "", None, None), ("http://a.net#/x", "a.net", "", None, None),
    ("a.net/x", "", "", None, None), (None, "", "", None, None), ("", "", "", None, None), ("://", "", "", None, None),
    ("http://É.net/ß🙂", "É.net", "/ß🙂", "net/", "block"), ("a://b://c.net/d", "b:", "//c.net/d", None, None),
    ("http://x.com/" + "ab" * 100_000, "x.com", "/" + "ab" * 100_000, None, None), ("http://line\nfeed.net/\n", "line\nfeed.net", "/\n", "net/", "block"),
]


def test_parts_and_rules(spark):
    df = spark.createDataFrame([(i, u[0], "x") for i, u in enumerate(URLS)], "id bigint, url string, host string")
    model = url_filter.Model((0,) * url_filter.BUCKETS, -1)
    got = {r.id: tuple(r)[1:] for r in url_filter.judged(df, model, ["id"]).collect()}
    assert got == {i: (*u[1:4], u[4] or "allow") for i, u in enumerate(URLS)}
    blocked = url_filter.judged(df, url_filter.Model((0,) * url_filter.BUCKETS, 1), ["id"])
    assert blocked.where("rule IS NULL AND verdict <> 'block'").count() == 0
    with pytest.raises(ValueError, match="rules"):
        url_filter.judged(df, model, ["id"], [("block", f"h{i}", "/") for i in range(url_filter.MAX_RULES + 1)])


def test_regression_learns_what_the_rules_say(spark, sf_dir):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    known = url_filter.labelled(pages).withColumn("fold", F.crc32(F.concat("host", "path").cast("binary")) % 3)
    model = url_filter.learned(known.where("fold > 0"))
    held_out = known.where("fold = 0").withColumn("grams", url_filter.trigrams(F.col("host"), F.col("path")))
    right = held_out.select(((url_filter._margin("grams", model) > 0) == (F.col("blocked") == 1)).alias("right"))
    n, good = right.agg(F.count("*"), F.count_if("right")).first()
    assert n > 20 and good >= 0.9 * n


def test_labelled_rows_are_bounded_and_the_plan_is_native(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    twice = pages.unionByName(pages)
    assert url_filter.labelled(twice, rows=7).collect() == url_filter.labelled(pages, rows=7).collect()
    judged = url_filter.judged(twice, url_filter.learned(url_filter.labelled(twice, rows=50), steps=2), ["page_id"])
    assert judged.count() == 2 * pages.count()
    assert not re.search("Python|Arrow|Pandas", judged._jdf.queryExecution().toString())
    assert url_filter.learned(url_filter.labelled(pages.limit(0))) == url_filter.Model((0,) * url_filter.BUCKETS, 0)
