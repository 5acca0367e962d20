"""Step logs as text: writing lines, and reading them back as typed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.constants import DPO_LOG_COLUMNS, DPO_LOG_SEPARATOR
from pairloom.functions.formats import fixed, shortest
from pairloom.functions.schedules import due

# Columns of a report in the order of the log.
DPO_REPORT_COLUMNS = (
    "step", "loss", "reward_accuracy", "logp_chosen", "logp_rejected",
    "logp_chosen_ref", "logp_rejected_ref", "margin", "margin_ref",
    "nll_loss", "lr", "row_per_s",
)
DPO_HEADER = DPO_LOG_SEPARATOR.join(DPO_LOG_COLUMNS)


def dpo_log_lines(report: DataFrame, log_every: int, *keep: str) -> DataFrame:
    """Lines of the steps that are logged; the first one is preceded by the header.

    ``line_in_step`` orders the header before the figures of the same step.
    """
    figures = F.array(*[F.col(c).cast("double") for c in DPO_REPORT_COLUMNS[1:]])
    # one lambda for all figures: spelled out per column the code would be too long
    spelled = F.transform(figures, lambda x: F.coalesce(shortest(x), F.lit("nan")))
    line = F.concat_ws(DPO_LOG_SEPARATOR, F.col("step").cast("string"), spelled)
    lines = F.when(
        F.col("step") == log_every, F.array(F.lit(DPO_HEADER), line)
    ).otherwise(F.array(line))
    return report.where(due(F.col("step"), log_every)).select(
        *keep, "step", F.posexplode(lines).alias("line_in_step", "value")
    )


def sft_train_line(step: Column, loss: Column) -> Column:
    return F.concat(step.cast("string"), F.lit(" train "), fixed(loss, 6))


def sft_validation_line(step: Column, loss: Column) -> Column:
    return F.concat(step.cast("string"), F.lit(" val "), fixed(loss, 4))


def sft_log_lines(training: DataFrame, validation: DataFrame, log_every: int) -> DataFrame:
    """Lines of closed windows that are due, and of all validations."""
    step = F.col("step")
    trained = training.where(due(step, log_every)).select(
        "step", F.lit("train").alias("kind"), sft_train_line(step, F.col("loss")).alias("value")
    )
    validated = validation.select(
        "step", F.lit("val").alias("kind"), sft_validation_line(step, F.col("loss")).alias("value")
    )
    return trained.unionByName(validated)


def append_log(lines: DataFrame, path: str, run: str = "run_id") -> None:
    """Appends ``value`` lines in the order of their steps, header first.

    Every run has its own folder, and every append adds one file to it, written by one task; ``log_store``
    spreads a run over many.
    """
    order = [c for c in ("step", "line_in_step", "kind") if c in lines.columns]
    gathered = lines.repartition(run).sortWithinPartitions(run, *order)
    gathered.select(run, "value").write.mode("append").partitionBy(run).text(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all runs with ``run_id`` taken from the place of the file.

    A run is a ``run_id=...`` folder as ``append_log`` makes it, or any other folder
    that holds its log file (``logs.txt``, ``sft.txt``), whose name it then has.
    """
    found = spark.read.option("recursiveFileLookup", "true").text(path)
    return found.select("value", run_name(F.col("_metadata.file_path")).alias("run_id"))


def run_name(place: Column) -> Column:
    """The run that a file belongs to, from its path."""
    def decoded(name: Column) -> Column:
        return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))

    made = F.regexp_extract(place, r"/run_id=([^/]+)/[^/]*$", 1)
    folder = F.regexp_extract(place, r"/([^/]+)/[^/]*$", 1)
    # the path is encoded once as such, and a partition's name once more
    return F.when(made != "", decoded(decoded(made))).otherwise(decoded(folder))


def parse_dpo_log(lines: DataFrame, *keep: str) -> DataFrame:
    """Typed columns of preference log lines; headers, however many, are left out."""
    fields = F.split("value", DPO_LOG_SEPARATOR)
    typed = [
        F.get(fields, F.lit(i)).try_cast("bigint" if name == "step" else "double").alias(name)
        for i, name in enumerate(DPO_REPORT_COLUMNS)
    ]
    return lines.where(F.col("value") != DPO_HEADER).select(*keep, *typed)


def parse_sft_log(lines: DataFrame, *keep: str) -> DataFrame:
    """``step, kind, loss`` of SFT log lines."""
    fields = F.split("value", " ")
    return lines.select(
        *keep,
        F.get(fields, F.lit(0)).try_cast("bigint").alias("step"),
        F.get(fields, F.lit(1)).alias("kind"),
        F.get(fields, F.lit(2)).try_cast("double").alias("loss"),
    )
