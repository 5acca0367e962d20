"""Data that grows or is kept: followed logs, closing windows, carried batches, slices, manifests."""

import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pairloom.operators import permutation as P
from pairloom.operators.ordering import dense_index, seeded_shuffle
from pairloom.sources import file_index as X
from pairloom.sources import slices as L
from pairloom.streaming import batches as S
from pairloom.streaming import log_tail as T
from pairloom.streaming import shards
from pairloom.streaming import windows as W

LINES = [b"1 train 0.5", b"", "zwölf 🙂".encode(), b"x" * 90, b"crlf\r", b"2", b""]


# ---- logs that grow in place ---------------------------------------------

@pytest.mark.parametrize("part_bytes", (1, 2, 7, 50, 1000))
@pytest.mark.parametrize("read_bytes", (3, 1 << 20))
def test_pieces_hold_every_line_once(tmp_path, monkeypatch, part_bytes, read_bytes):
    monkeypatch.setattr(T, "READ_BYTES", read_bytes)
    (tmp_path / "run").mkdir()
    data = b"".join(line + b"\n" for line in LINES)
    (tmp_path / "run" / "logs.txt").write_bytes(data + b"half a li")
    files = T._Files({"path": str(tmp_path), "part_bytes": str(part_bytes)})
    (name, end), = files.offset().items()
    assert end == len(data) and T.run_of(name) == "run"
    starts = [0]
    for line in LINES[:-1]:
        starts.append(starts[-1] + len(line) + 1)
    # from every earlier line end on, as a stream would go on from there
    for k, first in enumerate(starts):
        got = []
        for piece in T.pieces({name: first} if first else {}, {name: end}, part_bytes):
            for batch in files.lines(piece):
                got += zip(batch.column("at").to_pylist(), batch.column("value").to_pylist())
        assert got == [(s, line.removesuffix(b"\r").decode()) for s, line in zip(starts[k:], LINES[k:])]


def follow_once(spark, folder, out, **options):
    stream = T.follow(spark, folder, **options)
    query = stream.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint")
    query.trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(f"{out}/rows").orderBy("file", "at").collect()
    return [(r.run_id, r.value) for r in rows]


def append(path, data):
    os.makedirs(path.parent, exist_ok=True)
    with open(path, "ab") as file:
        file.write(data)


def test_lines_added_to_files_already_read_arrive_once(spark, tmp_path):
    folder, out = tmp_path / "log", str(tmp_path / "out")
    a, b = folder / "run_id=a%20b" / "logs.txt", folder / "b" / "logs.txt"
    append(a, b"1 train 0.5\n2 tra")
    append(folder / "b" / ".hidden", b"no line\n")
    assert follow_once(spark, str(folder), out) == [("a b", "1 train 0.5")]
    append(b, b"first")  # no whole line yet
    assert follow_once(spark, str(folder), out) == [("a b", "1 train 0.5")]
    append(a, b"in 0.25\n3 train 1.0\n")
    append(b, b" line\n")
    expected = [("a b", "1 train 0.5"), ("a b", "2 train 0.25"), ("a b", "3 train 1.0"), ("b", "first line")]
    assert sorted(follow_once(spark, str(folder), out, part_bytes=4)) == sorted(expected)
    assert sorted((r.run_id, r.value) for r in T.read_tail(spark, str(folder)).collect()) == sorted(expected)


def test_a_file_that_shrank_and_too_many_files_are_errors(spark, tmp_path):
    folder, out = tmp_path / "log", str(tmp_path / "out")
    append(folder / "r" / "logs.txt", b"one\ntwo\n")
    follow_once(spark, str(folder), out)
    (folder / "r" / "logs.txt").write_bytes(b"one\n")
    with pytest.raises(PySparkException, match="shorter"):
        follow_once(spark, str(folder), out)
    append(folder / "s" / "logs.txt", b"x\n")
    with pytest.raises(PySparkException, match="more than 1 files"):
        T.read_tail(spark, str(folder), max_files=1).collect()
    assert T.read_tail(spark, str(tmp_path / "nowhere")).count() == 0


def test_growing_twice_adds_nothing_and_a_gap_is_an_error(spark, tmp_path):
    rows = [("r", s, f"{s} train 0.5") for s in range(5)] + [("q", 1, "é")]
    texts = T.with_places(spark.createDataFrame(rows, "run_id string, step bigint, value string"))
    folder = str(tmp_path / "log")
    assert T.grow_files(texts.where("at < 20"), folder) == 12 * 2 + 3
    assert T.grow_files(texts, folder) == 12 * 3
    assert T.grow_files(texts, folder) == 0
    assert (tmp_path / "log" / "r" / "logs.txt").read_text() == "".join(f"{s} train 0.5\n" for s in range(5))
    with pytest.raises(PySparkException, match="ends at 3"):
        T.grow_files(spark.createDataFrame([("q", 9, "late\n")], "run_id string, at bigint, text string"), folder)


# ---- windows that close --------------------------------------------------

def test_steps_of_windows():
    assert list(W.window_steps(1, 4)) == [0, 1, 2, 3, 4] and list(W.window_steps(2, 4)) == [5, 6, 7, 8]
    assert list(W.window_steps(1, 8, 4)) == [4, 8] and list(W.window_steps(3, 10, 4)) == [24, 28]


def test_each_window_closes_once_and_only_open_ones_are_kept(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    acc = 4
    # (run, steps) that come in each round: out of order, one step twice, window 3 of run b stays open
    rounds = [
        [("a", 2), ("a", 0), ("a", 8), ("b", 12)],
        [("a", 3), ("a", 1), ("a", 2), ("b", 5), ("b", 6)],
        [("a", 4), ("a", 5), ("a", 7), ("a", 6), ("b", 7)],
        [("b", 8), ("b", 9)],
    ]
    come, closed, open_windows = {}, {}, []
    for number, part in enumerate(rounds):
        spark.createDataFrame([(r, s, s / 4) for r, s in part], "run_id string, step bigint, loss double").coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema("run_id string, step bigint, loss double").parquet(folder)
        query = W.write_closed(W.closed_windows(stream, acc, mean=False), out)
        query.awaitTermination()
        for r, s in part:
            come.setdefault((r, max(-(-s // acc), 1)), set()).add(s)
        for key in [k for k, v in come.items() if len(v) == acc + (k[1] == 1)]:
            closed[key] = (number, sum(come.pop(key)) / 4)
        done = [p for p in query.recentProgress if p.stateOperators]
        open_windows.append((done[-1].stateOperators[0].numRowsTotal, len(come)))
    got = W.read_closed(spark, out).collect()
    assert {(r.run_id, r.window_id): (r.epoch, r.loss) for r in got} == closed and len(got) == len(closed) == 3
    assert [a for a, _ in open_windows] == [b for _, b in open_windows]


def test_a_step_of_another_cadence_fails(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.createDataFrame([("a", 3, 1.0)], "run_id string, step bigint, loss double").write.parquet(folder)
    stream = spark.readStream.schema("run_id string, step bigint, loss double").parquet(folder)
    with pytest.raises(PySparkException, match="not in range"):
        W.write_closed(W.closed_windows(stream, 8, every=4), str(tmp_path / "out")).awaitTermination()
    with pytest.raises(ValueError, match="no logged step"):
        W.closed_windows(stream, 4, every=8)


# ---- batches over a source without an end --------------------------------

def counted(rows):
    return rows.select("rank", "batch_id", "row_in_batch", "id")


def dealt_by_hand(ids, ranks, size):
    each = len(ids) // ranks
    return sorted((i % ranks, i // ranks // size, i // ranks % size, ids[i]) for i in range(each * ranks))


@pytest.mark.parametrize("arrivals", ([0, 3, 11, 0, 1], [24], [1, 1, 1]))
def test_batches_go_on_across_epochs(spark, tmp_path, arrivals):
    out, ranks, size, ids = str(tmp_path), 3, 2, []
    for epoch, n in enumerate(arrivals):
        new = list(range(len(ids), len(ids) + n))
        ids += new
        rows = spark.createDataFrame([(i,) for i in reversed(new)], "id bigint")
        for _ in range(1 + epoch % 2):  # every second epoch runs twice
            S.write_epoch(rows, epoch, ["id"], out, counted, ranks, size)
        full = len(ids) // 6 * 6
        got = sorted(map(tuple, S.read_batches(spark, out, finished=False).collect()))
        assert got == dealt_by_hand(ids[:full], ranks, size)
        assert spark.read.parquet(f"{out}/carried/epoch={epoch}").count() == len(ids) - full
    S.finish(spark, out, counted, ranks, size)
    S.finish(spark, out, counted, ranks, size)
    assert sorted(map(tuple, S.read_batches(spark, out).collect())) == dealt_by_hand(ids, ranks, size)


# ---- how often an input is evaluated -------------------------------------

def evaluations(spark, rows, use):
    """How many times every row of a frame is made while ``use(frame)`` runs."""
    made = spark.sparkContext.accumulator(0)

    def pass_on(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    n = rows.count()
    use(rows.mapInArrow(pass_on, rows.schema))
    return made.value / n


def test_numbering_evaluates_its_input_twice(spark, tmp_path):
    rows = spark.range(1000).select("id", F.col("id").cast("string").alias("text"))
    numbered = lambda df: dense_index(df, ["id"]).write.format("noop").mode("overwrite").save()
    assert evaluations(spark, rows, numbered) == 2
    assert evaluations(spark, rows, lambda df: seeded_shuffle(df, ["id"], 1).write.format("noop").mode("overwrite").save()) == 2
    shards_out, batches_out = str(tmp_path / "shards"), str(tmp_path / "batches")
    assert evaluations(spark, rows, lambda df: shards.write_epoch(df, 0, ["id"], shards_out, 7)) == 2
    assert evaluations(spark, rows, lambda df: S.write_epoch(df, 0, ["id"], batches_out, counted, 3, 2)) == 2


# ---- a kept index, slices, a permutation ---------------------------------

def deliver(spark, folder, ids, files=3):
    spark.createDataFrame([(i, f"t{i}") for i in ids], "id bigint, text string").repartitionByRange(files, "id").sortWithinPartitions("id").write.mode("append").parquet(folder)


def test_old_rows_keep_their_numbers_and_their_files_are_not_read_again(spark, tmp_path):
    folder, index = str(tmp_path / "a b+c %25"), str(tmp_path / "index")
    deliver(spark, folder, range(100, 110))
    assert X.add_files(spark, folder, index) == 10
    old = X.read_rows(spark, index, ["id"]).collect()
    assert X.add_files(spark, folder, index) == 0
    first_files = set(os.listdir(folder))
    deliver(spark, folder, range(7))
    # old files that cannot be read show that only new ones are looked at
    contents = {}
    for name in first_files:
        if name.endswith(".parquet"):
            contents[name] = open(f"{folder}/{name}", "rb").read()
            os.remove(f"{folder}/.{name}.crc")
            with open(f"{folder}/{name}", "wb") as file:
                file.write(b"x" * len(contents[name]))
    assert X.add_files(spark, folder, index) == 7
    with pytest.raises(Exception, match="footer"):
        X.read_rows(spark, index, ["id"], 0, 5).collect()
    for name, content in contents.items():
        with open(f"{folder}/{name}", "wb") as file:
            file.write(content)
    rows = X.read_rows(spark, index, ["id"]).collect()
    assert {(r.id, r.idx) for r in rows} == {(r.id, r.idx) for r in old} | {(i, 10 + i) for i in range(7)}
    assert {r.n_rows for r in rows} == {17}


def test_a_changed_file_and_an_empty_index(spark, tmp_path):
    folder, index = str(tmp_path / "data"), str(tmp_path / "index")
    with pytest.raises(ValueError, match="nothing is indexed"):
        X.read_rows(spark, index, ["id"])
    deliver(spark, folder, range(5), files=1)
    X.add_files(spark, folder, index)
    name = [f for f in os.listdir(folder) if f.endswith(".parquet")][0]
    spark.createDataFrame([(1, "another text")], "id bigint, text string").coalesce(1).write.parquet(str(tmp_path / "other"))
    other = [f for f in os.listdir(tmp_path / "other") if f.endswith(".parquet")][0]
    os.remove(f"{folder}/.{name}.crc")
    with open(f"{folder}/{name}", "wb") as file:
        file.write(open(tmp_path / "other" / other, "rb").read())
    with pytest.raises(PySparkException, match="changed since it was indexed"):
        X.read_rows(spark, index, ["id"]).collect()


def test_bounds_of_slices():
    bounds = lambda text, n: L.parse_slices(text)[0].rows(n)
    assert bounds("train", 7) == (0, 7) and bounds("train[:50%]", 5) == (0, 2) and bounds("train[:50%]", 7) == (0, 4)
    assert bounds("a-b.c[ 10 : 20 ]", 15) == (10, 15) and bounds("t[-10%:]", 25) == (23, 25) and bounds("t[-3:-1]", 10) == (7, 9)
    assert bounds("t[5:2]", 10) == (5, 5) and bounds("t[-20:]", 10) == (0, 10) and bounds("t[33.5%:]", 200) == (67, 200)
    assert [s.split for s in L.parse_slices("train[:1]+validation + test[2%:]")] == ["train", "validation", "test"]
    for wrong in ("", "train[", "train[1]", "train[a:b]", "train[:5%%]", "+", "train[:1]]", "train [:1] x"):
        with pytest.raises(ValueError, match="not a slice"):
            L.parse_slices(wrong)


def test_a_slice_opens_only_its_files(spark, tmp_path):
    folder, index = str(tmp_path / "data"), str(tmp_path / "index")
    deliver(spark, folder, range(100), files=10)
    X.add_files(spark, folder, index)
    sizes = [r.rows for r in X.manifest(spark, index).orderBy("first").collect()]
    for start, stop in ((0, 1), (0, 50), (95, 100), (20, 20), (0, 100), (33, 61)):
        rows = X.read_rows(spark, index, ["id"], start, stop)
        assert sorted(r.id for r in rows.collect()) == list(range(start, stop))
        ends = [sum(sizes[:i + 1]) for i in range(len(sizes))]
        needed = sum(e > start and e - n < stop for e, n in zip(ends, sizes)) if stop > start else 0
        data = [f for f in rows.inputFiles() if "/data/" in f]
        assert len(data) == needed
    both = L.read_slices(spark, {"train": index, "test": index}, "test[90:]+train[:5%]+test[3:3]", ["id"])
    assert [(r.split, r.id) for r in both.orderBy("idx").collect()] == [("test", i) for i in range(90, 100)] + [("train", i) for i in range(5)]
    assert {r.n_rows for r in both.collect()} == {15}
    with pytest.raises(ValueError, match="no split"):
        L.read_slices(spark, {"train": index}, "trian", ["id"])


@pytest.mark.parametrize("n", (1, 2, 3, 5, 7, 64, 97, 1000, 4097, 10_007))
def test_a_permutation_of_any_size(spark, n):
    places = spark.range(n).select("id", P.permuted(F.col("id"), n, 5).alias("at"), P.permuted(F.col("id"), n, 6).alias("other"))
    assert "Exchange" not in places._jdf.queryExecution().executedPlan().toString()
    rows = places.collect()
    assert sorted(r["at"] for r in rows) == sorted(r["other"] for r in rows) == list(range(n))
    if n > 90:
        assert [r["at"] for r in rows] != [r["other"] for r in rows]
        # as little order as in any shuffled list: half of the steps go up, and hardly any row stays
        ups = sum(b["at"] > a["at"] for a, b in zip(rows, rows[1:]))
        assert abs(ups / (n - 1) - 0.5) < 0.12 and sum(r.id == r["at"] for r in rows) < 10


def test_a_permutation_of_very_many_rows_takes_any_of_them(spark):
    n = (1 << 60) - 3
    rows = spark.range(n - 2000, n).select(P.permuted(F.col("id"), n, 1).alias("at")).collect()
    assert len({r["at"] for r in rows}) == 2000 and all(0 <= r["at"] < n for r in rows)
    with pytest.raises(ValueError):
        P.permuted(F.col("id"), P.MAX_ROWS + 1, 1)
