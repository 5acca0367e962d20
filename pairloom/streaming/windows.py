"""Loss windows that are given out once, when they are whole, and forgotten.

State is kept per run and window, not per run, so a run with most of the steps is spread over many tasks.  A window is whole
when all of its steps have come, in whatever order: its state is a loss sum and one bit a step, and
goes when the window is given out.  So there are as many states as windows that are open.

A step that comes twice while its window is open counts once.  One that comes again later opens
its window anew and stays in the state: the sources here deliver each line once.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from pairloom.operators.steps import accumulation_window
from pairloom.streaming.prepare import ONCE

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def window_steps(window: int, accumulation: int, every: int = 1) -> range:
    """The steps of a window that are logged: multiples of ``every``, and step 0 only where all are."""
    first = (window - 1) * accumulation + 1 if window > 1 else 0 if every == 1 else 1
    first += -first % every
    return range(first, window * accumulation + 1, every)


class ClosingWindow(StatefulProcessor):
    """One run's window: adds up ``step, loss`` rows until the last of its steps has come."""

    def __init__(self, key: Sequence[str], accumulation: int, every: int):
        self.key, self.accumulation, self.every = key, accumulation, every

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "loss double, seen binary")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        steps = window_steps(key[-1], self.accumulation, self.every)
        loss, seen = self.open.get() if self.open.exists() else (0.0, b"")
        bits = int.from_bytes(seen, "little")
        for row in rows:
            bit = 1 << steps.index(row.step)
            if not bits & bit:
                bits |= bit
                loss += row.loss
        if bits.bit_count() < len(steps):
            self.open.update((loss, bits.to_bytes(-(-len(steps) // 8), "little")))
            return
        self.open.clear()
        yield Row(**dict(zip(self.key, key)), step=steps[-1], steps=len(steps), loss=loss)

    def close(self) -> None:
        pass


def closed_windows(
    steps: DataFrame, accumulation: int, key: Sequence[str] = ("run_id",), every: int = 1, mean: bool = True
) -> DataFrame:
    """Every window of a stream of ``key, step, loss`` rows once, when its last step has come.

    Steps that are not multiples of ``every`` do not belong to a log of that cadence and fail the job.
    ``mean`` divides each loss by the accumulation, as in training.  The values of ``key`` must be text or numbers.
    """
    if window_steps(1, accumulation, every) == range(0):
        raise ValueError("a window holds no logged step")
    types = dict(steps.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in key)
    loss = F.col("loss").cast("double") / (accumulation if mean else 1)
    rows = steps.select(*key, accumulation_window(accumulation).alias("window_id"), F.col("step").cast("bigint").alias("step"), loss.alias("loss"))
    return rows.groupBy(*key, "window_id").transformWithState(
        ClosingWindow([*key, "window_id"], accumulation, every), f"{schema}, window_id bigint, step bigint, steps bigint, loss double", "Update", "None"
    )


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, which this kind of state needs."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STORE)
        else:
            spark.conf.set(STORE, before)


def write_closed(windows: DataFrame, out: str, trigger: Mapping[str, object] = ONCE) -> StreamingQuery:
    """Writes the windows of each epoch into a folder of its own; an epoch that runs again overwrites its own."""

    def each(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/closed/epoch={epoch}")

    with state_store(windows.sparkSession):
        return (
            windows.writeStream.outputMode("update").foreachBatch(each)
            .option("checkpointLocation", f"{out}/checkpoint").trigger(**trigger).start()
        )


def read_closed(spark: SparkSession, out: str) -> DataFrame:
    """All windows closed so far, with the ``epoch`` that closed them."""
    return spark.read.parquet(f"{out}/closed")
