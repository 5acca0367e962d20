"""Learning-rate curves and cadences as columns over a step number."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: where the linear ramp starts, as a factor of the base rate.
RAMP_START = 0.1


def linear_warmup_decay(step: Column, warmup: int, total: int, base: float) -> Column:
    """Rises linearly over ``warmup`` steps, then falls linearly to 0 at ``total``."""
    rising = step / F.lit(float(max(1, warmup)))
    done = (step - warmup) / F.lit(float(max(1, total - warmup)))
    factor = F.when(step < warmup, rising).otherwise(
        F.greatest(F.lit(1.0) - done, F.lit(0.0))
    )
    return base * factor


def linear_ramp(step: Column, total: int | Column, base: float) -> Column:
    """From a tenth of the base rate up to the base rate at ``total`` steps."""
    total = total if isinstance(total, Column) else F.lit(total)
    progress = F.least(step, total) / total.cast("double")
    return base * (RAMP_START + (1.0 - RAMP_START) * progress)


def cosine(
    step: Column, warmup: int, max_steps: int, max_lr: float, min_lr: float
) -> Column:
    """Linear warm-up, then half a cosine; a step past ``max_steps`` is an error."""
    rising = max_lr * (step + 1) / F.lit(float(max(1, warmup)))
    ratio = (step - warmup) / F.lit(float(max_steps - warmup))
    falling = min_lr + 0.5 * (1.0 + F.cos(F.lit(math.pi) * ratio)) * (max_lr - min_lr)
    return (
        F.when(step < warmup, rising)
        .when(step <= max_steps, falling)
        .otherwise(F.raise_error(F.lit("step lies past the end of the schedule")))
    )


def due(step: Column, every: int) -> Column:
    """True on every ``every``-th step but the first."""
    return (step > 0) & (step % every == 0)
