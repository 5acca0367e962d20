"""A seeded order without a sort: every row's place is computed from its number alone.

The numbers ``0 .. N-1`` are written as pairs ``(left, right)`` below ``a * b >= N`` with ``a`` about the root of N.  Each round adds
a keyed hash of one half to the other, modulo its size, which can be undone, so all rounds together permute the
pairs.  A pair that is no number of a row is permuted again until it is one: walking on along a cycle keeps
it a permutation.  Fewer than ``a`` of the pairs are none, so hardly any row walks more than one step.

No row is moved, counted or compared with another: what follows (ranks, batches) can be computed for any row alone.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 6
#: Prime below 2**31: products of two remainders fit into 63 bits in any engine.
PRIME = 2_147_483_647
FACTOR = 48_271
#: Steps along a cycle; the chance that a row needs more is below N ** -(WALK / 2), and it then fails.
WALK = 64
MAX_ROWS = 1 << 60


def round_keys(seed: int, rounds: int = ROUNDS) -> list[int]:
    """One number below the prime for every round."""
    return [int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16) % PRIME for i in range(rounds)]


def sides(n_rows: int) -> tuple[int, int]:
    """The sizes of the two halves."""
    left = max(1, math.isqrt(max(0, n_rows - 1)) + 1)
    return left, max(1, -(-n_rows // left))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value made once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def hashed(half: Column, key: Column) -> Column:
    """Keyed hash of a half, below the prime; products stay below 2**63."""
    p = F.lit(PRIME).cast("bigint")
    return let((half % p + key) % p, lambda x: ((x * x + key) % p * FACTOR + x) % p)


def permuted_once(number: Column, n_rows: int, keys: list[int]) -> Column:
    """The pair of a number after all rounds, as a number below ``a * b``."""
    a, b = (F.lit(x).cast("bigint") for x in sides(n_rows))
    rounds = F.array(*[F.struct(F.lit(k).cast("bigint").alias("key"), F.lit(i % 2 == 0).alias("left")) for i, k in enumerate(keys)])

    def turn(pair: Column, k: Column) -> Column:
        left, right = pair["l"], pair["r"]
        return F.when(k["left"], F.struct(((left + hashed(right, k["key"])) % a).alias("l"), right.alias("r"))).otherwise(
            F.struct(left.alias("l"), ((right + hashed(left, k["key"])) % b).alias("r"))
        )

    start = F.struct(F.call_function("div", number, b).alias("l"), (number % b).alias("r"))
    return F.aggregate(rounds, start, turn, lambda pair: pair["l"] * b + pair["r"])


def permuted(number: Column, n_rows: int, seed: int) -> Column:
    """The place of row ``number`` of ``n_rows`` in the order of the seed."""
    if not 0 <= n_rows <= MAX_ROWS:
        raise ValueError(f"n_rows must be 0 to {MAX_ROWS}")
    keys, n = round_keys(seed), F.lit(n_rows).cast("bigint")
    walked = F.aggregate(
        F.sequence(F.lit(2), F.lit(WALK)),
        permuted_once(number.cast("bigint"), n_rows, keys),
        lambda at, _: F.when(at < n, at).otherwise(permuted_once(at, n_rows, keys)),
    )
    return let(walked, lambda at: F.when(at < n, at).otherwise(F.raise_error(F.lit("a row walked too far")).cast("bigint")))


def permuted_order(df: DataFrame, n_rows: int, seed: int, index: str = "idx") -> DataFrame:
    """An indexed table in the order of the seed: ``index`` is replaced, no row moves."""
    return df.withColumn(index, permuted(F.col(index), n_rows, seed))
