"""Numbers as text, spelled the way the log files spell them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(value: Column, digits: int) -> Column:
    """A fixed number of decimals; exact ties go to the even digit."""
    return F.format_string(f"%.{digits}f", F.bround(value, digits))


def shortest(value: Column) -> Column:
    """Shortest text of a double: plain from 1e-4 up to 1e16, else as ``5e-05``.

    Spark switches to ``5.0E-5`` below 1e-3 and from 1e7 on, so only those
    spellings are rewritten.
    """
    text = value.cast("string")
    sign = F.when(value < 0, F.lit("-")).otherwise(F.lit(""))
    mantissa = F.regexp_extract(text, r"^-?([0-9.]+)E", 1)
    exponent = F.try_to_number(F.regexp_extract(text, r"E-?([0-9]+)$", 1), F.lit("999"))
    exponent = F.when(text.contains("E-"), -exponent).otherwise(exponent).cast("int")
    short = F.regexp_replace(mantissa, r"\.0$", "")
    digits = F.regexp_replace(short, r"\.", "")
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    # rpad would cut digits that are behind the point
    whole = F.concat(digits, F.repeat(F.lit("0"), exponent + 1 - F.length(digits)))
    large = F.concat(
        sign,
        F.substring(whole, F.lit(1), exponent + 1),
        F.lit("."),
        F.when(F.length(whole) > exponent + 1,
               F.substring(whole, exponent + 2, F.length(whole))).otherwise(F.lit("0")),
    )
    scientific = F.concat(
        sign, short, F.lit("e"),
        F.when(exponent < 0, F.lit("-")).otherwise(F.lit("+")),
        F.when(F.abs(exponent) < 10, F.lit("0")).otherwise(F.lit("")),
        F.abs(exponent).cast("string"),
    )
    magnitude = F.abs(value)
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(value), F.lit("nan"))
        .when(magnitude == float("inf"), F.concat(sign, F.lit("inf")))
        .when(~text.contains("E"), text)
        .when((magnitude >= 1e-4) & (magnitude < 1), small)
        .when((magnitude >= 1) & (magnitude < 1e16), large)
        .otherwise(scientific)
    )
