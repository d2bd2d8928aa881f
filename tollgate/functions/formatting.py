"""Text forms of values for display. Rounding is half to even."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tollgate.functions.numbers import half_even
from tollgate.functions.wording import BAND_MARKS, NOT_AVAILABLE


def fixed(value: Column, digits: int) -> Column:
    """A plain number with a fixed count of decimals; NULL stays NULL, -0.001 is "-0.00"."""
    return F.concat(F.when(value < 0, "-").otherwise(""), _digits(value, digits))


def signed(value: Column, digits: int) -> Column:
    return F.concat(F.when(value < 0, "-").otherwise("+"), _digits(value, digits))


def _digits(value: Column, digits: int) -> Column:
    text = F.format_string(f"%.{digits}f", half_even(F.abs(value.cast("double")), digits))
    return F.when(value.isNotNull(), text)


def currency(amount: Column) -> Column:
    return F.coalesce(F.concat(F.lit("$"), F.format_number(amount, 2)), F.lit(NOT_AVAILABLE))


def share_text(value: Column, digits: int = 1) -> Column:
    """A 0-1 share as percent text; larger values are taken as percent already."""
    scaled = F.when(value <= 1.0, value * 100).otherwise(value)
    return F.concat(fixed(scaled, digits), F.lit("%"))


def score_text(score: Column) -> Column:
    """A 0-100 score with its level."""
    level = F.when(score >= 70, f"{BAND_MARKS['HIGH']} High").when(score >= 40, f"{BAND_MARKS['MEDIUM']} Medium")
    text = F.concat(fixed(score, 1), F.lit(" ("), level.otherwise(f"{BAND_MARKS['LOW']} Low"), F.lit(")"))
    return F.coalesce(text, F.lit(NOT_AVAILABLE))


def band_mark(band: Column) -> Column:
    return (
        F.when(band == "HIGH", BAND_MARKS["HIGH"])
        .when(band == "MEDIUM", BAND_MARKS["MEDIUM"])
        .otherwise(BAND_MARKS["LOW"])
    )


def fill(template: str, value: Column) -> Column:
    """Put a value in the place of ``{}``; NULL when the value is NULL."""
    before, after = template.split("{}")
    return F.concat(F.lit(before), value, F.lit(after))
