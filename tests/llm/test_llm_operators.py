"""Each corpus operator against a plain version of itself, on the small tables and on edge cases."""

import hashlib
import io
import math
import random
import re
import sys
import os
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline
from pairloom.llm import (
    common,
    jaccard_join, language_id, lm_scoring, mixing, packing, pii, quality_divergence, queries, sharding, topk_search, warc,
)
from pairloom.llm.oracles import ORACLES

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, label string, n bigint, h string"
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
EDGES = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \t\n\x0b\x0c\r", None, None, 3), (4, "one two", "en", "b", 7),
    (4, "one two", "en", "b", 7), (5, "One  TWO", "en", None, 8), (6, LONG, "en", "b", len(LONG)),
    (7, LONG + " end", "en", "a", 0), (None, "null id here with some words", None, "a", 0), (8, "12 34 !!", "de", "a", 0),
    (9, "é́ ü ß 🙂 text gap", "de", "b", 0), (9, "same id, another text", "de", "b", 0),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(*r, "x", "y", 1, "z") for r in EDGES], DOC)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="module")
def folder(spark, edges, nothing, tmp_path_factory):
    """The edge rows, and empty tables, as an input folder."""
    made = {}
    for name, docs in (("edges", edges), ("nothing", nothing)):
        path = str(tmp_path_factory.mktemp(name))
        docs.write.parquet(f"{path}/documents.parquet")
        docs.select(F.col("doc_id").alias("page_id"), F.col("lang").alias("url"), F.col("text").alias("html"), "size").write.parquet(f"{path}/pages.parquet")
        docs.select(F.col("doc_id").alias("item_id"), F.substring("text", 1, 300).alias("text"), "size").write.parquet(f"{path}/benchmark.parquet")
        turns = [(0, 0, "user", "hi"), (0, 1, None, None), (0, 1, None, None), (0, None, "user", "before"), (3, 2, "user", "own"), (3, 2, "assistant", "tie"),
                 (5, 0, "user", "hi"), (5, 1, "user", LONG), (-3, 0, "user", "hi"), (7, 0, "user", "hi"), (7, 1, "", ""), (None, 0, "user", "lost"),
                 (12, 0, "é", "🙂"), (13, 0, "user", "gone"), (1 << 40, None, None, None)]
        spark.createDataFrame([(*t, "x") for t in turns] if name == "edges" else [], "conv_id bigint, turn bigint, role string, text string, ids string").write.parquet(f"{path}/conversations.parquet")
        vectors = [(20, [1.0] * 64, "x"), (20, [1.0] * 64, "x"), (21, [1.0] * 64, "x"), (22, [-1.0] * 64, "x"), (40, None, "x"),
                   (60, [1.0], "x"), (None, [0.5] * 64, "x"), (23, [None] + [float("nan")] * 63, "x")]
        spark.createDataFrame(vectors if name == "edges" else [], "vec_id bigint, embedding array<float>, code string").write.parquet(f"{path}/embeddings.parquet")
        made[name] = path
    return made


def documents(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_edge_rows_and_empty_tables(spark, folder, name):
    query = queries.QUERIES[name]
    assert query(spark, folder["nothing"]).count() == 0
    rows = query(spark, folder["edges"]).collect()
    if name.startswith("op1_"):
        assert {(r.vec_id, r.neighbor_id) for r in rows} == {(20, 21), (20, 22), (20, 23)}
    elif name.startswith("op9_"):
        assert len(rows) >= len(EDGES)
    elif name.startswith("op12_"):  # conversations, not rows
        root = [r for r in rows if r.depth == 0]
        assert len(root) == 1 and root[0].n_convs == 8 and root[0].parent_conv_id is None
    else:
        assert len(rows) == len(EDGES)


@pytest.mark.parametrize("name", list(ORACLES))
def test_sql(spark, folder, sf_dir, name):
    for path, files in ((sf_dir, ""), (folder["edges"], "/*.parquet")):
        con = duckdb.connect()
        for t in ("documents", "pages", "embeddings", "benchmark", "conversations"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet{files}'")
        got = queries.QUERIES[name](spark, path)
        cursor = con.execute(ORACLES[name])
        names = [c[0] for c in cursor.description]
        assert sorted(names) == sorted(got.columns)
        assert sorted(map(repr, (tuple(r) for r in got.select(names).collect()))) == sorted(map(repr, cursor.fetchall()))


# 1 ---------------------------------------------------------------------------------

def test_search_blocks_ties_and_common_codes(spark):
    rng = random.Random(5)
    common = [rng.getrandbits(64) for _ in range(6)]
    rows = [(i, (rng.choice(common) ^ (rng.getrandbits(64) & rng.getrandbits(64) & rng.getrandbits(64)) if i % 3 else common[0])) for i in range(900)]
    rows = [(i, c - (1 << 64) if c >> 63 else c) for i, c in rows]
    df = spark.createDataFrame(rows, "id bigint, code bigint")
    got = defaultdict(list)
    for r in topk_search.exact_topk(df, df.where("id % 20 = 0"), 7, index_codes=100, query_codes=10).collect():
        got[r.id].append((r.rank, r.distance, r.neighbor))
    for i, c in rows:
        if i % 20 == 0:
            best = sorted((((c ^ d) & (1 << 64) - 1).bit_count(), j) for j, d in rows if j != i)[:7]
            assert sorted(got[i]) == [(n + 1, *x) for n, x in enumerate(best)]


@pytest.mark.parametrize("n", [0, 1, 2, 30, 700, 5000])
def test_covered_radii_give_the_nearest_codes(n):
    rng = np.random.default_rng(n)
    codes = np.unique(rng.integers(-(1 << 63), 1 << 63, n, np.int64) & rng.choice(np.array([-1, 255, -(1 << 63)]), n) if n < 5000
                      else rng.integers(-(1 << 63), 1 << 63, n, np.int64))
    ids = rng.permutation(len(codes)).astype(np.int64)
    asked = np.concatenate([codes[:20], rng.integers(-(1 << 63), 1 << 63, 20, np.int64)])
    found = topk_search._search(codes, ids, asked, 8)
    expected = []
    for q in asked:
        far = np.bitwise_count((codes ^ q).view(np.uint64)).astype(int)
        expected += [(int(q), int(far[i]), int(ids[i])) for i in np.lexsort((ids, far))[:8]]
    assert sorted(zip(found["asked"], found["distance"], found["first"])) == sorted(expected)


def test_a_million_codes_are_not_scanned():
    rng = np.random.default_rng(3)
    codes = np.unique(rng.integers(-(1 << 63), 1 << 63, 1_000_000, np.int64))
    index = topk_search.SegmentIndex(codes, np.arange(len(codes)))
    asked = rng.integers(-(1 << 63), 1 << 63, 40, np.int64)
    query, _, distance, verified = index.search(asked, 11)
    assert verified.max() < 0.1 * len(codes)  # codes drawn evenly are the hardest case
    for i, q in enumerate(asked[:5]):
        far = np.sort(np.bitwise_count((codes ^ q).view(np.uint64)).astype(int))[:11]
        assert sorted(distance[query == i]) == far.tolist()


# 2 ---------------------------------------------------------------------------------

def plain_base(text):
    text = text or ""
    found = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    windows = [tuple(found[i:i + 3]) for i in range(len(found) - 2)]
    often = Counter(windows)
    inside = {j for i, w in enumerate(windows) if often[w] > 1 for j in (i, i + 1, i + 2)}
    n = len(found)
    return (n, sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside),
            n < 50 or 100 * len(inside) > 50 * n)


def distance(p, q):
    p, q = np.array(p, float), np.array(q, float)
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    half = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m) if a > 0)
    return math.sqrt(max(0.0, (half(p) + half(q)) / 2))


def test_quality(spark, sf_dir, folder):
    for path in (sf_dir, folder["edges"]):
        docs = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text", "lang").collect()]
        rows = queries.op2_distribution_divergence(spark, path).collect()
        base = Counter((d, *plain_base(t)) for d, t, _ in docs)
        assert base == Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
        counts = defaultdict(Counter)
        for _, t, lang in docs:
            for key in {lang, None}:
                counts[key].update(words(t))
        cls = lambda c: 0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3 if c in quality_divergence.SYMBOLS else 4 if c in quality_divergence.MARKS else 5
        expected = Counter()
        for d, t, lang in docs:
            key = lang if sum(counts[lang].values()) >= quality_divergence.MIN_REFERENCE else None
            top = [w for w, _ in sorted(counts[key].items(), key=lambda x: (-x[1], x[0]))[:16]]
            ref = [0] * 6
            for w, n in counts[key].items():
                for c in w:
                    ref[cls(c)] += n
            own, mine = [0] * 6, Counter(words(t))
            for c in "".join(words(t)):
                own[cls(c)] += 1
            hist = lambda c: [c[w] for w in top] + [sum(c.values()) - sum(c[w] for w in top)]
            a, b = distance(own, ref), distance(hist(mine), hist(counts[key]))
            strange = sum(mine.values()) >= quality_divergence.MIN_WORDS and (a > quality_divergence.MAX_CLASS_DISTANCE or b > quality_divergence.MAX_WORD_DISTANCE)
            expected[(d, round(a, 9), round(b, 9), not plain_base(t)[-1] and not strange)] += 1
        assert expected == Counter((r.doc_id, round(r.class_distance, 9), round(r.word_distance, 9), r.kept) for r in rows)


def cut_to(docs, lang, low, high, n):
    found = [r.text for r in docs if r.lang == lang and len(words(r.text)) >= high and not plain_base(r.text)[-1]][:n]
    return [" ".join(words(t)[:low]) for t in found]


def test_texts_of_another_language_and_of_random_letters_are_strange(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(2)
    wrong = cut_to(given.collect(), "de", 300, 300, 15)
    wrong += [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(300)) for _ in range(15)]
    added = spark.createDataFrame([(10**9 + i, t, "en") for i, t in enumerate(wrong)], given.schema)
    rows = quality_divergence.judged(given.union(added)).collect()
    assert sum(not r.kept for r in rows if r.doc_id >= 10**9) >= 29
    clean = [r for r in rows if r.doc_id < 10**9 and r.n_words >= 200 and not r.base_failed and r.class_distance < 0.2]
    assert len(clean) > 400 and sum(r.kept for r in clean) > 0.95 * len(clean)


def test_short_texts_have_verdicts_too(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(3)
    strange = [" ".join(str(rng.randrange(10**6)) for _ in range(n)) for n in (50, 120, 199)]
    strange += [" ".join("".join(rng.choices("абвгдежзик", k=6)) for _ in range(n)) for n in (50, 120, 199)]
    strange += [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(n)) for n in (60, 120, 199)]
    clean = cut_to(given.collect(), "en", 60, 200, 40) + cut_to(given.collect(), "en", 150, 200, 40)
    added = [(10**9 + i, t, "en") for i, t in enumerate(strange)] + [(2 * 10**9 + i, t, "en") for i, t in enumerate(clean)]
    rows = quality_divergence.judged(given.union(spark.createDataFrame(added, given.schema))).collect()
    assert not any(r.kept for r in rows if 10**9 <= r.doc_id < 2 * 10**9)
    clean = [r for r in rows if r.doc_id >= 2 * 10**9 and not r.base_failed and r.class_distance < 0.2]
    assert len(clean) > 60 and sum(r.kept for r in clean) >= 0.95 * len(clean)


# 3 ---------------------------------------------------------------------------------

def test_archive_round_trip_and_revisits(spark, tmp_path):
    big = "x" * 1500 + "é"
    pages = [(1, "u", big), (2, "u\r\nv", big), (3, None, big), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (7, "u", "")]
    pages += [(i, f"http://e/{i}", f"<p>{i}</p>" * i) for i in range(10, 400)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    assert warc.write_archives(df, str(tmp_path / "a"), archive_bytes=100_000) == len(pages)
    got = {r.page_id: r for r in warc.read_archives(spark, str(tmp_path / "a"), payloads=True).collect()}
    assert len(got) == len(pages)
    for page, _, html in pages:
        r, data = got[page], (html or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", 3) if page in (1, 2) else ("response", None))
        assert r.html == ("" if page in (1, 2) else html or "")
    names = sorted(p for p in os.listdir(tmp_path / "a") if p.endswith(".zst"))
    assert len(names) > 1
    data = (tmp_path / "a" / names[0]).read_bytes()
    assert data[:4] == b"\x5d\x2a\x4d\x18" and int.from_bytes(data[4:8], "little") > 0


def test_archive_faults_are_found():
    digest = hashlib.sha1(b"abc").hexdigest()
    good = warc.record(1, "u", b"abc", 3, digest, None)
    assert warc.parse(good)["payload"] == b"abc"
    for bad in (good[:-1], good + b"x", good.replace(b"Content-Length: 3", b"Content-Length: 4"), good.replace(b"abc", b"abd"),
                good.replace(b"WARC/1.1", b"WARC/9"), good.replace(b"WARC-Type: response", b"WARC-Type: revisit"),
                good.replace(b"WARC-Type: ", b"WARC-Type")):
        with pytest.raises(warc.InvalidRecord):
            warc.parse(bad)
    out = io.BytesIO()
    warc.write_archive(out, iter([good] * 3))
    whole = out.getvalue()
    assert list(warc.read_archive(io.BytesIO(whole), piece=5)) == [good] * 3
    for bad in (whole[:-2], whole[1:], b""):
        with pytest.raises((warc.InvalidRecord, Exception)):
            list(warc.read_archive(io.BytesIO(bad)))


# 4 ---------------------------------------------------------------------------------

def test_targets_stop_at_twice_the_size():
    got = mixing.filled([10, 100, 100], [5, 2, 1], 315)
    assert got[0] == 20 and sum(got) == 315 and got[1] == 2 * got[2] - 2 * got[2] + min(200, got[1])
    assert all(t <= 2 * s for t, s in zip(got, [10, 100, 100]))
    assert mixing.filled([0, 4], [5, 2], 6) == [0, 6]


def test_flow_fills_quotas_at_the_least_cost():
    rng = random.Random(3)
    for _ in range(60):
        n_s = rng.randint(1, 3)
        patterns = [(sorted(rng.sample(range(n_s), rng.randint(1, n_s))), rng.randint(0, 4)) for _ in range(rng.randint(1, 3))]
        quotas = [rng.randint(0, 6) for _ in range(n_s)]
        got = mixing.flow(patterns, quotas)
        used = [sum(w for (p, _), w in got.items() if p == i) for i in range(len(patterns))]
        price = lambda w, n: n + 3 * max(0, n - w) - max(0, n - w)  # noqa: E731  the first use costs 1, the second 3
        best = {(): (0, 0)}
        states = {tuple([0] * len(patterns) + [0] * n_s)}
        arcs = [(p, s) for p, (m, _) in enumerate(patterns) for s in m]
        for p, s in arcs:
            more = set()
            for state in states:
                for n in range(0, 9):
                    new = list(state)
                    new[p] += n
                    new[len(patterns) + s] += n
                    if new[p] <= 2 * patterns[p][1] and new[len(patterns) + s] <= quotas[s]:
                        more.add(tuple(new))
            states = more
        most = max(sum(state[:len(patterns)]) for state in states)
        cheapest = min(sum(price(w, n) for (_, w), n in zip(patterns, state)) for state in states if sum(state[:len(patterns)]) == most)
        assert sum(used) == most
        assert sum(price(w, n) for (_, w), n in zip(patterns, used)) == cheapest
        assert all(s in patterns[p][0] for p, s in got)


def test_mixture(spark):
    sf_dir = "/root/testdata/sf0.01"  # below, a source has ten documents, too few to come near any target
    rows = queries.op4_min_cost_flow(spark, sf_dir).collect()
    again = queries.op4_min_cost_flow(spark, sf_dir).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        source = docs[r.doc_id].source
        assert r.size == len(words(docs[r.doc_id].text)) and r.taken in (0, r.size, 2 * r.size)
        sizes[source] += r.size
        taken[source] += r.taken
        target[source] = r.target
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert all(r.source_size == sizes[docs[r.doc_id].source] for r in rows)
    for i, source in enumerate(sorted(sizes)):
        assert target[source] <= 2 * sizes[source] + 1e-6
        assert abs(taken[source] - target[source]) <= 0.03 * target[source], (source, taken[source], target[source])


def test_overlapping_sources_share_their_documents(spark):
    rows = [(i, ["a", "b"] if i % 2 else ["a"], 10, i) for i in range(400)] + [(400 + i, ["b"], 10, i) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, sources array<string>, size bigint, n int").withColumn("h", F.xxhash64("id"))
    got = mixing.mixed(df.drop("n")).collect()
    assert len(got) == len(rows) and sum(r.taken for r in got) == pytest.approx(1.5 * 4200, rel=0.02)


# 5 ---------------------------------------------------------------------------------

def test_mixtures_are_found():
    rng = random.Random(1)
    alphabets = {"aa": "abcde", "bb": "fghij", "cc": "klmno"}
    make = lambda k, n: ["".join(rng.choice(alphabets[k]) for _ in range(rng.randint(3, 8))) for _ in range(n)]
    counts = np.zeros((3, language_id.BUCKETS))
    for i, k in enumerate(alphabets):
        at, _ = language_id.trigram_cells(make(k, 3000))
        counts[i] += np.bincount(at, minlength=language_id.BUCKETS)
    reader = language_id.Reader(language_id.Model(list(alphabets), counts))
    texts = [make("aa", 60), make("aa", 60) + make("bb", 30), make("cc", 10) + make("bb", 30) + make("aa", 60), make("bb", 3)]
    got = reader.predict([Counter(t) for t in texts] + [Counter()])
    assert got[0] == {"aa": 1.0} and got[3] == {"bb": 1.0} and got[4] == {}
    assert got[1]["aa"] == pytest.approx(2 / 3, abs=0.05) and set(got[1]) == {"aa", "bb"}
    assert set(got[2]) == {"aa", "bb", "cc"} and got[2]["aa"] == pytest.approx(0.6, abs=0.05)


def test_em_does_not_lower_the_likelihood_and_cells_are_those_of_the_words():
    rng = np.random.default_rng(2)
    log, often = -rng.random((40, 3)) * 9, rng.integers(1, 4, 40).astype(float)
    starts = np.array([0, 7, 8, 30])
    shares, likelihood = language_id.expectation_maximisation(log, often, starts)
    ends = [7, 8, 30, 40]
    for i, (a, b) in enumerate(zip(starts, ends)):
        value = lambda p: float((np.log(np.exp(log[a:b]) @ p) * often[a:b]).sum())
        assert likelihood[i] == pytest.approx(value(shares[i]))
        assert all(value(shares[i]) >= value(rng.dirichlet([1, 1, 1])) - 0.05 for _ in range(200))
    one, _ = language_id.trigram_cells(["abc"])
    two, starts = language_id.trigram_cells(["x", "abc", "ß"])
    assert starts.tolist() == [0, 1, 4] and one.tolist() == two[1:4].tolist()


def test_language_of_held_out_documents(spark):
    path = "/root/testdata/sf0.01"
    truth = {r.doc_id: r for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    rows = queries.op5_mixture_language_id(spark, path).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows) and 200 < len(held) < 300
    right = sum(r.lang_pred == truth[r.doc_id].lang for r in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


# 6 ---------------------------------------------------------------------------------

def plain_components(docs):
    sets = []
    for _, text in docs:
        found = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in words(text)]
        sets.append({tuple(found[i:i + 5]) for i in range(len(found) - 4)} if len(found) >= 5 else {tuple(found)} if found else set())
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    at = defaultdict(list)
    for i, s in enumerate(sets):
        for t in s:
            at[t].append(i)
    pairs = {(a, b) for ids in at.values() for a in ids for b in ids if a < b} if sum(len(v) ** 2 for v in at.values()) < 2e7 else None
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * len(sets[a] | sets[b]):
            parent[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return Counter((d, len(s), least.get(root(i))) for i, ((d, _), s) in enumerate(zip(docs, sets)))


def near_copies(seed, groups=12, size=9):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    boiler = [rng.choice(vocabulary) for _ in range(60)]
    docs = []
    for g in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((3, 5, 8, 20, 60, 150)))]
        for _ in range(rng.randint(1, size)):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(own) // 25))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                own = own + boiler
            if rng.random() < 0.3:
                own = [w.upper() for w in own[rng.randint(0, 2):]]
            docs.append(rng.choice((" ", "\n", "\t ")).join(own))
    rng.shuffle(docs)
    return [(1000 + i, t) for i, t in enumerate(docs)]


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, sf_dir, seed):
    docs = near_copies(seed, groups=40) + [(d, t) for d, t, *_ in EDGES if t != LONG and t != LONG + " end"]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = jaccard_join.jaccard_components(df).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == plain_components(docs)


def test_components_with_small_parts(spark, sf_dir, monkeypatch):
    """Neither the order's levels nor the size of blocks and tiles decides any link."""
    docs = documents(spark, sf_dir)
    expected = plain_components(docs)
    for settings in ({}, {"LEVELS": 1, "BLOCK_BYTES": 1}, {"BLOCK_BYTES": 20_000, "BUCKET_TOKENS": 50, "TILE": 2, "STAR_ROUNDS": 0}):
        for name, value in settings.items():
            monkeypatch.setattr(jaccard_join, name, value)
        got = jaccard_join.jaccard_components(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == expected


def test_repeated_postings_do_not_make_unrelated_tokens_one(spark):
    # Token 1 has the nodes 10 and 11, token 2 the nodes 20 and 21, all of them from two parts.
    rows = [(t, n, p) for t, nodes in ((1, (10, 11)), (2, (20, 21))) for n in nodes for p in (3, 5)]
    got = jaccard_join._merged(spark.createDataFrame(rows, "token bigint, node bigint, place int")).collect()
    nodes = defaultdict(set)
    for r in got:
        nodes[r.token].add((r.node, r.place))
    assert sorted(map(sorted, nodes.values())) == [[(10, 3), (11, 3)], [(20, 3), (21, 3)]] and len(got) == 4


def test_connected_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 450)] + [(600, 500 + i) for i in range(60)]
    got = {r.node: r.label for r in jaccard_join.components(spark.createDataFrame(edges, "x bigint, y bigint")).collect()}
    label = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in range(200):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label


# 7 ---------------------------------------------------------------------------------

def test_shards(spark, sf_dir):
    rows = queries.op7_virtual_slots(spark, sf_dir).collect()
    docs = dict(documents(spark, sf_dir))
    load, slots = Counter(), defaultdict(list)
    for r in rows:
        data = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(rows) == len(docs) and set(load) == set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load.values()) - min(load.values()) <= 0.02 * max(load.values())


def test_map_is_edited_little_and_in_versions(spark, tmp_path):
    rng = random.Random(2)
    loads = [rng.randint(50, 150) for _ in range(512)]
    first = sharding.first_map(512, 8)
    even = sharding.rebalanced(first, loads, 8)
    assert sum(a != b for a, b in zip(first, even)) < 120
    grown = sharding.rebalanced(even, loads, 9)
    assert all(b == 8 for a, b in zip(even, grown) if a != b) or sum(a != b and b != 8 for a, b in zip(even, grown)) <= 16
    load = Counter()
    for slot, shard in enumerate(grown):
        load[shard] += loads[slot]
    assert max(load.values()) - min(load.values()) <= 100
    path = str(tmp_path / "map")
    sharding.store_map(spark, 0, first, path)
    sharding.store_map(spark, 1, even, path)
    assert {r.virtual_slot: r.shard for r in sharding.latest_map(spark, path).collect()} == dict(enumerate(even))


def test_one_row_without_end_is_spread(spark, tmp_path):
    df = spark.range(6000).select(F.lit(1).cast("bigint").alias("doc_id"), F.lit(10).cast("bigint").alias("size"))
    rows = sharding.sharded(df, ["doc_id", "size"], "size", str(tmp_path / "m")).collect()
    load = Counter(r.shard for r in rows)
    assert len(rows) == 6000 and max(load.values()) - min(load.values()) <= 128
    assert len({(r.shard, r.slot) for r in rows}) == 6000


# 8 ---------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            good = {
                "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 13 <= len(digits) <= 19 and sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits[::-1])) % 10 == 0,
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_on_generated_text():
    rng = random.Random(8)
    parts = ["a", "b.c", "@", ".", "+", "-", " ", "12", "255", "256", "4111111111111111", "4111 1111 1111 1111", "+1 (269) 555-3296", "x@y.z", "1.2.3.4", "(", ")", "\n", "é"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_personal_data(spark, sf_dir):
    docs = dict(documents(spark, sf_dir))
    added = 0
    for r in queries.op8_semi_markov_pii(spark, sf_dir).collect():
        base = plain_spans(docs[r.doc_id])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == x for k, _, _ in base) for x in pii.KINDS)
        every = r.spans.split(",") if r.spans else []
        assert set(text.split(",") if text else []) <= set(every)
        added += len(every) - len(base)
    assert added <= len(docs) // 10


def test_joint_decoding_parts_what_a_pattern_swallowed(spark, sf_dir):
    weights = pii.learned(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    text = "call +1 (269) 555-3296 4524132264652876 or 10.0.0.1 now"
    base, every = pii.all_spans(text, weights)
    assert ("phone", 5, 22) in every
    assert ("ip", text.index("10.0"), text.index(" now")) in base
    assert pii.all_spans("nothing here, 12 of 30 in 1999.", weights)[1] == []
    assert pii.redacted("ab 10.0.0.1 c", [("ip", 3, 11)]) == "ab <IP> c"


def test_decoding_is_the_best_segmentation():
    rng = random.Random(6)
    text = "+1 555 1234567 4111 1111 1111 1111"
    lattice = pii.Lattice(text, 0, len(text))
    names = {f for *_, fs in lattice.segments for f in fs} | set(lattice.single)
    for _ in range(20):
        weights = {f: rng.uniform(-1, 1) for f in names}
        n = len(lattice.bounds) - 1
        best = [0.0] + [-1e9] * n
        for j in range(1, n + 1):
            best[j] = max([best[j - 1] + weights[lattice.single[j - 1]]] + [best[i] + sum(weights[f] for f in fs) for i, e, _, fs in lattice.segments if e == j])
        spans = lattice.best(weights)
        value = {(k, lattice.bounds[i], lattice.bounds[j]): (i, j, sum(weights[f] for f in fs)) for i, j, k, fs in lattice.segments}
        inside = set()
        total = 0.0
        for s in spans:
            i, j, v = value[s]
            inside |= set(range(i, j))
            total += v
        total += sum(weights[lattice.single[i]] for i in range(n) if i not in inside)
        assert total == pytest.approx(best[n])


# 9 ---------------------------------------------------------------------------------

def test_packing(spark, sf_dir, folder):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    for path in (sf_dir, folder["edges"]):
        docs = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
        ids = Counter()
        for d, t in docs:
            one = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
            ids[(d, one.tobytes())] += 1
        rows = queries.op9_cost_balanced_packing(spark, path).collect()
        by_doc, by_sequence = defaultdict(list), defaultdict(list)
        for r in rows:
            by_doc[r.doc_id].append(r)
            by_sequence[r.sequence_id].append(r)
        for (d, data), copies in ids.items():
            pieces = [r for r in by_doc[d] if r.doc_tokens == len(data) // 4]
            assert all(zlib.crc32(data[4 * r.start:4 * (r.start + r.length)]) == r.ids_crc32 for r in pieces) or len({k for k, _ in ids if k == d}) < sum(k == d for k, _ in ids)
            assert sum(r.length for r in pieces) == copies * len(data) // 4
        for pieces in by_sequence.values():
            pieces.sort(key=lambda r: r.offset)
            assert [r.offset for r in pieces] == np.cumsum([0] + [r.length for r in pieces])[:-1].tolist()
            total = sum(r.length for r in pieces)
            assert total == pieces[0].sequence_length <= 2048 and total & (total - 1) == 0 or total == 2048
        assert sum(r.length for r in rows) == sum(n * len(data) // 4 for (_, data), n in ids.items())


def test_costs_are_even():
    rng = random.Random(7)
    lengths = [rng.randint(1, 2047) for _ in range(1500)]
    spent, room = Counter(), Counter()
    for _, _, n, at, offset in packing.assign(lengths):
        assert room[at] == offset
        room[at] += n
        spent[at] += packing.cost(n)
    sizes = packing.capacities(sum(lengths))
    assert [room[i] for i in range(len(sizes))] == sizes
    whole = [spent[i] for i, s in enumerate(sizes) if s == 2048]
    assert max(whole) < 1.6 * min(whole)


# 10 --------------------------------------------------------------------------------

def test_scores(spark, sf_dir, folder):
    for path in (sf_dir, folder["edges"]):
        docs = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
        rows = queries.op10_backoff_automaton(spark, path).collect()
        lower = lambda t: re.sub("[A-Z]+", lambda m: m.group().lower(), t or "")
        held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1
        counts = Counter(w for d, t in docs if not held(d) for w in [*words(lower(t)), ""])
        total, scale = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
        expected = Counter()
        for d, t in docs:
            found = [*words(lower(t)), ""]
            expected[(d, held(d), len(found), sum(counts[w] > 0 for w in found), total,
                      round(sum(math.log10((counts[w] + 0.5) / scale) for w in found), 4))] += 1
        assert expected == Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows)


class PlainModel:
    """Discounted n-grams with the shorter history mixed in, by recursion over all counts."""

    def __init__(self, texts):
        self.n, self.followers = Counter(), defaultdict(list)
        for t in texts:
            for size in (1, 2, 3):
                self.n.update(zip(*(t[i:] for i in range(size))))
        self.total = sum(n for g, n in self.n.items() if len(g) == 1)
        self.scale = self.total + 0.5 * (1 + sum(len(g) == 1 for g in self.n))
        for g, n in self.n.items():
            if len(g) > 1 and n >= lm_scoring.FLOOR:
                self.followers[g[:-1]].append(g)

    def p(self, history, word):
        if not history:
            return (self.n[(word,)] + 0.5) / self.scale
        lower = self.p(history[1:], word)
        arcs = self.followers.get(history)
        if not arcs:
            return lower
        own = self.n[(*history, word)]
        given = sum(self.n[g] - lm_scoring.DISCOUNT for g in arcs) / self.n[history]
        return (1 - given) * lower + (max(0, own - lm_scoring.DISCOUNT) / self.n[history] if own >= lm_scoring.FLOOR else 0)

    def score(self, text):
        return sum(math.log10(self.p(tuple(text[max(0, i - 2):i]), w)) for i, w in enumerate(text))


def test_the_model_is_a_distribution():
    rng = random.Random(9)
    model = PlainModel([[*rng.choice(["a b c", "a b d", "c a", "b c a d"]).split(), ""] for _ in range(400)])
    for history in [(), *model.followers]:
        # An unknown word has the count 0, and so its half.
        assert sum(model.p(history, w) for w in ["a", "b", "c", "d", "", "unknown"]) == pytest.approx(1, abs=1e-9), history


def test_it_does_better_on_held_out_text(spark):
    rows = queries.op10_backoff_automaton(spark, "/root/testdata/sf0.01").collect()
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)


def test_traversals_give_the_plain_models_scores(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "PART_TOKENS", 500)
    rng = random.Random(4)
    texts = [" ".join(f"w{min(int(rng.paretovariate(0.7)), 900)}" for _ in range(rng.randrange(25))) for _ in range(1200)]
    texts[507], texts[511] = " ".join(texts[20:90]), " ".join(["w1 w2"] * 900)  # several lanes
    rows = [(i, t, i % 5 == 1) for i, t in enumerate(texts)]
    arcs = []
    for some in (rows[:400], rows):
        docs = spark.createDataFrame(some, "key bigint, text string, held_out boolean").repartition(4)
        found = {r.key: r for r in lm_scoring.scored(docs).collect()}
        grams = {k: [*t.split(), ""] for k, t, _ in some}
        model = PlainModel([grams[k] for k, _, held in some if not held])
        assert len(found) == len(some)
        for k, g in grams.items():
            assert found[k].score == pytest.approx(model.score(g), abs=1e-6)
        totals = {r["kind"]: r["arcs"] for r in lm_scoring.gathered(docs)[1].groupBy("kind").agg(F.sum("arcs").alias("arcs")).collect()}
        kept = Counter(len(g) for g, n in model.n.items() if len(g) == 1 or n >= lm_scoring.FLOOR)
        assert totals == dict(kept)
        arcs.append(totals)
    assert all(arcs[1][size] > 2 * arcs[0][size] for size in (2, 3))


def test_lanes_come_to_the_same_states():
    rng = np.random.default_rng(2)
    ids = np.minimum(rng.zipf(1.4, 4000), 60).astype(np.int32)
    hashes = np.arange(61, dtype=np.uint64) * np.uint64(977)
    sizes = [1, 1500, 2, 2497]
    row = pa.table({
        "block": [0], "tokens": [4000], "words": pa.array([61], pa.int32()), "keys": [[1, 2, 3, 4]], "held": [[False] * 4],
        "sizes": pa.array([sizes], pa.list_(pa.int32())), "ids": [lm_scoring._packed(ids)], "hashes": [lm_scoring._packed(hashes)],
    })
    answers = pd.DataFrame({"block": [], "kind": [], "part": [], "many": [], "n": []}, dtype=np.int64)
    for wanted in ((1,), (2,), (3,), (4, 5)):
        answers.attrs["kinds"] = tuple(sorted(set(answers["kind"])))
        block = lm_scoring.Block(row, answers)
        for kind in wanted:
            sent = list(lm_scoring._dealt(0, kind, 3, *(block.counts(kind) if kind < 4 else block.given(kind))))
            sent = pd.DataFrame(sent, columns=["block", "kind", "part", "many", "keys", "often"])
            for _, part in sent.groupby("part"):
                answers = pd.concat([answers, lm_scoring._added(part)])
    answers.attrs["kinds"] = (1, 2, 3, 4, 5)
    block = lm_scoring.Block(row, answers)
    for kind in (4, 5):
        block._answered(kind)
    automaton = lm_scoring.Automaton(block, block.n, 4000.0)
    found = lm_scoring.traversed(automaton, block.ids, block.starts, block.sizes)
    for start, size in zip(block.starts, block.sizes):  # one walk a text, word after word
        state = np.zeros(1, np.int64)
        for at in range(start, start + size):
            gain, state = automaton.step(state, block.ids[at:at + 1])
            assert gain[0] == pytest.approx(found[at], abs=1e-12)


# The pipeline -----------------------------------------------------------------------

def test_pipeline_stage_by_stage(spark, sf_dir, folder):
    for path in (sf_dir, folder["edges"], folder["nothing"]):
        docs = spark.read.parquet(f"{path}/documents.parquet")
        for name, stage in corpus_pipeline.STAGES:
            before = docs.select(*corpus_pipeline.COLUMNS).collect()
            made = stage(spark, docs, path)
            docs = spark.createDataFrame(made.collect(), made.schema)
            if name != "packing":
                assert docs.columns == corpus_pipeline.COLUMNS
            after = docs.collect()
            if name == "language ID":
                assert {r.doc_id for r in before} - {r.doc_id for r in after} <= {r.doc_id for r in before if not any(c.isalpha() for c in r.text or "")}
            elif name == "n-gram Jaccard join":
                groups = plain_components([(r.doc_id, r.text) for r in before if len(r.text) < 100_000])
                assert {r.doc_id for r in after if len(r.text) < 100_000} >= {c for _, _, c in groups if c is not None} - {6, 7}
                assert len(after) <= len(before)
            elif name == "PII":
                assert len(after) == len(before) and not any(pii.base_spans(r.text) for r in after)
                assert all(r.n_chars == len(r.text) for r in after)
            elif name == "mixing sources to target weights":
                given, copies = Counter((r.doc_id, r.text, r.source) for r in before), Counter((r.doc_id, r.text, r.source) for r in after)
                assert all(n <= 2 * given[row] for row, n in copies.items())
                sizes, taken, largest = Counter(), Counter(), Counter()
                for (_, text, source), n in given.items():
                    sizes[source] += n * len(words(text))
                    largest[source] = max(largest[source], len(words(text)))
                for (_, text, source), n in copies.items():
                    taken[source] += n * len(words(text))
                for source, target in plain_targets(sizes).items():
                    assert abs(taken[source] - target) <= largest[source], source
            else:
                check_pieces(before, after)


def plain_targets(sizes):
    """Weights 5, 2, 1 by code point, null last, of one and a half times all; nothing above twice the size."""
    order = sorted(sizes, key=lambda x: (x is None, (x or "").encode()))
    weight = {source: (5, 2, 1)[i % 3] for i, source in enumerate(order)}
    left, targets, open_ = 1.5 * sum(sizes.values()), {}, set(order)
    while open_:
        share = left / sum(weight[x] for x in open_)
        full = {x for x in open_ if weight[x] * share > 2 * sizes[x]}
        for x in full or open_:
            targets[x] = 2 * sizes[x] if full else weight[x] * share
            left -= targets[x]
        open_ -= full or set(open_)
    return targets


def check_pieces(docs, pieces):
    """Every id of every copy lies in one piece, and sequences have no gaps and no padding."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    wanted, found = Counter(), Counter()
    for (doc_id, text), n in Counter((r.doc_id, r.text) for r in docs).items():
        wanted[(doc_id, len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1)] += n
    sequences, covered = defaultdict(list), defaultdict(Counter)
    for r in pieces:
        found[(r.doc_id, r.doc_tokens)] += r.length
        covered[(r.doc_id, r.doc_tokens)].update([r.start, r.start + r.length])
        sequences[r.sequence_id].append(r)
    assert found == Counter({(d, n): n * copies for (d, n), copies in wanted.items()})
    for (d, n), ends in covered.items():  # a cut is the end of one piece and the start of the next
        assert ends[0] == ends[n] == wanted[(d, n)] and all(times % 2 == 0 for at, times in ends.items() if at not in (0, n))
    for some in sequences.values():
        some.sort(key=lambda r: r.offset)
        ends = np.cumsum([0] + [r.length for r in some]).tolist()
        assert [r.offset for r in some] == ends[:-1] and ends[-1] <= 2048 and ends[-1] & (ends[-1] - 1) == 0


def test_long_texts_are_hashed_part_by_part(monkeypatch):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcXYZ.é", k=rng.randint(1, 12))) for _ in range(40_000)]
    words[20_000] = "w" * 50_000  # a word longer than two slices
    text = "".join(w + rng.choice([" ", "\n", "  ", "\t"]) for w in words)
    data = np.frombuffer(text.encode(), np.uint8)
    whole, bounds = common.word_hashes(data, np.array([0, len(data)]))
    monkeypatch.setattr(common, "SLICE_BYTES", 10_000)
    common._kept_powers.cache_clear()
    parts = list(common._parts(data))
    in_parts, part_bounds = common.word_hashes(data, np.array([0, len(data)]))
    common._kept_powers.cache_clear()
    assert b"".join(p.tobytes() for p in parts) == data.tobytes() and len(parts) > 10
    assert whole.tolist() == in_parts.tolist() and bounds.tolist() == part_bounds.tolist() == [0, 40_000]


def test_a_text_of_50_megabytes_leaves_little_behind():
    words = [f"w{i * 7919 % 100_003}" for i in range(100_003)]
    text = pa.array([" ".join(words * 75).encode()], pa.large_binary())
    assert text.nbytes > 50e6
    assert len(next(common.shingle_sets(text))) == 100_003
    assert sum(p.nbytes for p in common._kept_powers()) <= 32 * common.SLICE_BYTES


def test_stored_tables_leave_the_batch_bound_as_it_was(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    seen = spark.range(3).mapInArrow(common.frugal(lambda batches: batches), "id bigint")
    assert sorted(r.id for r in common.stored(seen, "seen").collect()) == [0, 1, 2]
    assert spark.conf.get(name) == before


def test_letters_are_encoded_once_for_all_marks_behind_them(monkeypatch):
    words = packing.WordIds(packing.vocabulary_path())
    texts = ["Word été Éß", "word, WORD! word?! été. (word) İ' ŉ! Σς. it's 'S x's' <|endoftext|> a<|endoftext|>! ###", "", "ﬁ́ a\x01b 中文。!"]

    def expected(text):
        return np.array(words.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    assert words.ids([texts[0].encode()]) == [expected(texts[0])]
    seen = []
    plain = words._plain
    monkeypatch.setattr(words, "_plain", lambda new, *rest: seen.extend(new) or plain(new, *rest))
    assert words.ids([t.encode() for t in texts]) == list(map(expected, texts))
    assert not {b"word", b"word,", "été".encode(), "été.".encode()} & set(seen)
    # a full generation becomes the old one, from which words come back
    monkeypatch.setattr(packing, "KNOWN_BYTES", 1)
    for _ in range(3):
        assert words.ids([t.encode() for t in texts]) == list(map(expected, texts))
        assert not words.young
