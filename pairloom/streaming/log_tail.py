"""Logs that grow in place, as a stream of their lines.

A training process appends to one file per run.  The file source of a stream reads a file once, so it
never sees what is appended later.  This source's offset is the number of bytes of every file that end in a whole
line; a batch is what lies between two offsets.  A line of which only the first half has been written waits for
the rest.  Files only grow, so a batch that is read again after a failure has the same lines.

Long ranges are cut into pieces of ``part_bytes``, each of which begins with the first line that starts in it,
so a file that has grown by much is read by many tasks.  The driver holds one number a file, for at most ``max_files`` files.

A file that is shorter than what was read of it is an error, as is an unreadable one; a file that vanished after it
was read to its end is forgotten.  ``at`` is the byte that a line begins with: (file, at) is the order of the lines.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from pairloom.sources.files import files_below, place_of

FORMAT = "log_tail"
SCHEMA = "run_id string, file string, at bigint, value string"
PART_BYTES = 32 << 20
MAX_FILES = 100_000
READ_BYTES = 1 << 20


@dataclass
class Piece(InputPartition):
    """The lines of a file that start in ``[start, stop)``; the whole range of the batch is ``[first, last)``."""

    file: str
    first: int
    start: int
    stop: int
    last: int


def run_of(path: str) -> str:
    """The run a file belongs to: its folder's name, or what follows ``run_id=`` in it."""
    folder = path.rsplit("/", 2)[-2] if path.count("/") > 1 else ""
    return unquote(folder[len("run_id="):]) if folder.startswith("run_id=") else folder


def whole_lines(place: fs.FileSystem, path: str, size: int) -> int:
    """Bytes of a file up to its last line end."""
    with place.open_input_file(path) as file:
        stop = size
        while stop > 0:
            start = max(0, stop - 65_536)
            found = file.read_at(stop - start, start).rfind(b"\n")
            if found >= 0:
                return start + found + 1
            stop = start
    return 0


def pieces(start: Mapping[str, int], end: Mapping[str, int], part_bytes: int) -> list[Piece]:
    """What lies between two offsets, in pieces."""
    out = []
    for file, last in sorted(end.items()):
        first = start.get(file, 0)
        if last < first:
            raise ValueError(f"{file} is shorter than what was read of it: {last} of {first} bytes")
        out += [Piece(file, first, at, min(at + part_bytes, last), last) for at in range(first, last, part_bytes)]
    return out


def read_piece(place: fs.FileSystem, path: str, piece: Piece) -> Iterator[pa.RecordBatch]:
    """The lines that start in a piece, also where the last of them ends beyond it."""
    with place.open_input_file(path) as file:
        # a line starts behind a line end: look from the byte before
        at = piece.start if piece.start == piece.first else piece.start - 1
        skipping, rest, begin = at != piece.start, b"", at
        while begin < piece.stop:
            block = file.read_at(min(READ_BYTES, piece.last - at), at)
            if not block:
                raise OSError(f"{piece.file} ends at {at}, before {piece.last}")
            at += len(block)
            *lines, rest = (rest + block).split(b"\n")
            starts, values = [], []
            for line in lines:
                if not skipping and begin < piece.stop:
                    starts.append(begin)
                    values.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
                skipping = False
                begin += len(line) + 1
            if values:
                n = len(values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([run_of(piece.file)] * n), pa.array([piece.file] * n), pa.array(starts, pa.int64()), pa.array(values)],
                    names=["run_id", "file", "at", "value"],
                )
            if at >= piece.last:
                break


class _Files:
    """What the batch and the stream reader share: the folder and its offsets."""

    def __init__(self, options: Mapping[str, str]):
        self.path = options["path"].rstrip("/")
        self.part_bytes = int(options.get("part_bytes", PART_BYTES))
        self.max_files = int(options.get("max_files", MAX_FILES))
        if self.part_bytes < 1:
            raise ValueError("part_bytes must be at least 1")

    def offset(self) -> dict[str, int]:
        place, folder = place_of(self.path)
        files = files_below(place, folder, self.max_files)
        start = len(folder.rstrip("/").rsplit("/", 1)[0]) + 1  # names keep the last part of the folder
        ends = {f.path[start:]: whole_lines(place, f.path, f.size) for f in files}
        return {file: end for file, end in ends.items() if end}

    def lines(self, piece: Piece | None) -> Iterator[pa.RecordBatch]:
        if piece is None:  # no pieces at all
            return iter(())
        place, folder = place_of(self.path)
        return read_piece(place, f"{folder.rstrip('/').rsplit('/', 1)[0]}/{piece.file}", piece)


class _BatchReader(DataSourceReader):
    def __init__(self, files: _Files):
        self.files = files

    def partitions(self) -> list[Piece]:
        return pieces({}, self.files.offset(), self.files.part_bytes)

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        return self.files.lines(partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, files: _Files):
        self.files = files

    def initialOffset(self) -> dict:
        return {"files": json.dumps({})}

    def latestOffset(self) -> dict:
        # one text, so that file names are no keys of the offset
        return {"files": json.dumps(self.files.offset(), sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        return pieces(json.loads(start["files"]), json.loads(end["files"]), self.files.part_bytes)

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        return self.files.lines(partition)


class LogTail(DataSource):
    """``format("log_tail")``, as a table of what is there or as a stream of what is added."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(_Files(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _StreamReader(_Files(self.options))


def read_tail(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """All whole lines that the files below ``path`` have now."""
    spark.dataSource.register(LogTail)
    return spark.read.format(FORMAT).options(**options).load(path)


def follow(spark: SparkSession, path: str, **options: object) -> DataFrame:
    """A stream of the lines below ``path``, whenever they are added, to old files or new ones."""
    spark.dataSource.register(LogTail)
    return spark.readStream.format(FORMAT).options(**options).load(path)


def with_places(lines: DataFrame, run: str = "run_id") -> DataFrame:
    """``run``, ``at`` and ``text`` of ordered lines (``step``, ``line_in_step``, ``value``) as they will lie in the run's file."""
    order = [c for c in ("step", "line_in_step", "kind") if c in lines.columns]
    before = Window.partitionBy(run).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    text = F.concat("value", F.lit("\n"))
    at = F.coalesce(F.sum(F.octet_length(text)).over(before), F.lit(0)).cast("bigint")
    return lines.select(run, at.alias("at"), text.alias("text"))


def grow_files(texts: DataFrame, path: str, run: str = "run_id", name: str = "logs.txt") -> int:
    """Appends ``text`` to the file of its run, ``path/<run>/<name>``, as a training process does; returns the bytes added.

    A text that begins at ``at`` is written if the file ends there, and left out as far as the
    file has it already, so a task that runs again adds nothing twice.  A gap is an error.  One task writes a file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, folder = place_of(path)
        file, current, end, added = None, None, 0, 0
        try:
            for batch in batches:
                for owner, at, text in zip(*[batch.column(c).to_pylist() for c in (run, "at", "text")]):
                    if owner != current:
                        if file is not None:
                            file.close()
                        target = f"{folder}/{owner}/{name}"
                        place.create_dir(f"{folder}/{owner}", recursive=True)
                        end = place.get_file_info(target).size or 0
                        file, current = place.open_append_stream(target), owner
                    data = text.encode()
                    if at > end:
                        raise ValueError(f"{owner}: the file ends at {end}, the next text begins at {at}")
                    new = data[end - at:] if end - at < len(data) else b""
                    file.write(new)
                    end += len(new)
                    added += len(new)
        finally:
            if file is not None:
                file.close()
        yield pa.RecordBatch.from_arrays([pa.array([added], pa.int64())], names=["added"])

    gathered = texts.select(run, "at", "text").repartition(run).sortWithinPartitions(run, "at")
    return gathered.mapInArrow(write, "added bigint").agg(F.sum("added")).first()[0] or 0
