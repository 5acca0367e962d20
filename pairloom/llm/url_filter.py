"""URL verdicts: rules first, then a logistic regression on hashed character trigrams; expressions only.

A url's host lies between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z as a-z; its
path goes on from there up to ``?``, ``#`` or the end.  A rule (verdict, host, path) fits its host and all
subdomains where the url's path starts with the rule's; the longest rule wins.  What no rule decides
is judged by a logistic regression on the trigrams of host and path, each hashed into ``BUCKETS`` weights.

The regression learns from a small labelled table: ``labelled`` takes the ``LABELLED_ROWS`` distinct urls
of least md5 among those that the rules decide.  Each step is one aggregation over that table, and what comes back
to the driver are the gradient's ``BUCKETS + 1`` sums.  Weights, errors and gradients are whole numbers of
``1 / UNIT``, so that sums do not depend on the order of rows and a run can be repeated.

Defined cases: a null url, and one without ``://``, has an empty host and path; no rule fits an empty host;
where there are no trigrams only the bias counts; without labelled urls all weights are 0, and a url is
blocked only above 0, hence allowed; repeated rows are judged alike and count once in learning; an empty table
gives no rows; texts of any length take time in proportion; only the key columns of the input are carried along.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import stored

# Fixed values: (verdict, host, path) of the rules.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
MAX_RULES = 1000  # they become one expression; more are refused

LABELLED_ROWS = 4096
BUCKETS = 4093
UNIT = 1_000_000
STEPS = 24
RATE = 60.0  # a url's trigrams weigh 1 / their number, hence steps are long
BIAS_RATE = 1.0
MOMENTUM = 0.8  # share of a step that the next one repeats
#: Factors of the three code points of a trigram.
FACTORS = (16_777_619, 65_599, 31)

LOWER = "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Model:
    """Weights by bucket and the bias, in units of ``1 / UNIT``."""

    weights: tuple[int, ...]
    bias: int


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``."""
    scheme = F.instr(F.col(url), "://")
    rest = F.when(scheme > 0, F.substr(F.col(url), scheme + 3)).otherwise("")
    parts = df.withColumn("host", F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), LOWER.upper(), LOWER))
    return parts.withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as (verdict, rule); null if none does."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    fits = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule")),
        )
        for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))
    ]
    none = F.lit(None).cast("struct<verdict:string,rule:string>")
    return F.coalesce(*fits, none)


def _buckets(text: Column, kind: int) -> Column:
    """Bucket of every trigram of a text."""
    codes = F.transform(F.split(text, ""), F.ascii)
    a, b, c = (F.lit(f).cast("bigint") for f in FACTORS)
    # the list of code points is made once a row: inside of the lambda it is a variable
    made = F.transform(
        F.array(codes),
        lambda x: F.transform(
            F.slice(x, F.lit(1), F.greatest(F.size(x) - 2, F.lit(0))),
            lambda first, i: ((first * a + F.get(x, i + 1) * b + F.get(x, i + 2) * c + kind) % BUCKETS).cast("int"),
        ),
    )
    return F.get(made, 0)


def trigrams(host: Column, path: Column) -> Column:
    """Buckets of the trigrams of ``^host$`` and ``path$``."""
    return F.concat(
        _buckets(F.concat(F.lit("^"), host, F.lit("$")), 0), _buckets(F.concat(path, F.lit("$")), 1)
    )


def labelled(urls: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, rows: int = LABELLED_ROWS, url: str = "url") -> DataFrame:
    """The small labelled table: at most ``rows`` distinct (host, path) that the rules decide, and whether they are blocked."""
    ruled = with_parts(urls.select(url), url).select("host", "path", rule_of(F.col("host"), F.col("path"), rules).alias("r"))
    known = ruled.where("r IS NOT NULL").select("host", "path", (F.col("r.verdict") == "block").cast("int").alias("blocked"))
    return known.distinct().orderBy(F.md5(F.concat("host", "path")), "host", "path").limit(rows)


def _margin(grams: str, model: Model) -> Column:
    """Bias and mean weight of the trigrams, in units."""
    # one text, which the optimizer turns into one array
    weights = F.split(F.lit(",".join(map(str, model.weights))), ",").cast("array<bigint>")
    total = F.aggregate(F.col(grams), F.lit(0).cast("bigint"), lambda sum, g: sum + F.get(weights, g))
    return F.lit(model.bias).cast("bigint") + total / F.greatest(F.size(grams), F.lit(1))


def learned(labelled_urls: DataFrame, steps: int = STEPS) -> Model:
    """Logistic regression on ``host, path, blocked`` rows by whole-table gradient steps from 0.

    The table must be small; every step reads it once and brings ``BUCKETS + 1`` sums to the driver.
    """
    rows = stored(
        labelled_urls.select(trigrams(F.col("host"), F.col("path")).alias("grams"), "blocked"), "labelled-urls"
    )
    n = rows.count()
    weights, moves = [0] * (BUCKETS + 1), [0] * (BUCKETS + 1)  # the last is the bias
    for _ in range(steps if n else 0):
        p = 1 / (1 + F.exp(-_margin("grams", Model(tuple(weights[:-1]), weights[-1])) / UNIT))
        error = rows.select("grams", F.floor((p - F.col("blocked")) * UNIT + 0.5).alias("error"))
        share = F.floor(F.col("error") / F.greatest(F.size("grams"), F.lit(1)) + 0.5)
        parts = F.concat(
            F.transform("grams", lambda g: F.struct(g.alias("bucket"), F.col("share").alias("part"))),
            F.array(F.struct(F.lit(BUCKETS).alias("bucket"), F.col("error").alias("part"))),
        )
        sums = error.withColumn("share", share).select(F.inline(parts)).groupBy("bucket").agg(F.sum("part").alias("total"))
        totals = dict(map(tuple, sums.limit(BUCKETS + 1).collect()))
        for bucket, move in enumerate(moves):
            rate = BIAS_RATE if bucket == BUCKETS else RATE
            moves[bucket] = math.floor(MOMENTUM * move + rate * totals.get(bucket, 0) / n)
            weights[bucket] -= moves[bucket]
    return Model(tuple(weights[:-1]), weights[-1])


def judged(
    urls: DataFrame, model: Model, key: Sequence[str], rules: Sequence[tuple[str, str, str]] = RULES, url: str = "url"
) -> DataFrame:
    """``key``, ``host``, ``path``, the ``rule`` that decides or null, and the ``verdict``: the rule's, else the model's."""
    parts = with_parts(urls.select(*key, F.col(url).alias("_url")), "_url").drop("_url")
    ruled = parts.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    # trigrams only where no rule decides
    grams = F.when(F.col("_rule").isNull(), trigrams(F.col("host"), F.col("path")))
    by_model = F.when(_margin("_grams", model) > 0, "block").otherwise("allow")
    return ruled.withColumn("_grams", grams).select(
        *key, "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce("_rule.verdict", by_model).alias("verdict")
    )
