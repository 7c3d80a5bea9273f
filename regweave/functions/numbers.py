"""Tolerant number and flag coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regweave.functions.text import blank_to_null, strip


def to_double(col: Column, decimal_comma: bool = False) -> Column:
    """Double or null; optionally with a decimal comma."""
    text = blank_to_null(col.cast("string"))
    if decimal_comma:
        text = F.replace(text, F.lit(","), F.lit("."))
    return text.try_cast("double")


def to_whole(col: Column) -> Column:
    """Integer part of a number written as ``12`` or ``12.0``, else null."""
    value = to_double(col)
    return F.when(~F.isnan(value), F.when(value < 0, F.ceil(value)).otherwise(F.floor(value)))


def digits_only(col: Column) -> Column:
    """A plain ASCII digit string as bigint, else null, also where it does not fit."""
    text = strip(col)
    return F.when(text.rlike(r"^[0-9]+$"), text.try_cast("bigint"))


def active_flag(col: Column) -> Column:
    """Missing means active; false/0 means inactive; other text counts as true."""
    text = F.lower(col.cast("string"))
    number = text.try_cast("double")
    return (
        F.when(text.isNull() | (text == "null"), F.lit(True))
        .when(text == "true", F.lit(True))
        .when(text == "false", F.lit(False))
        .when(number.isNotNull(), F.abs(number) >= 1)
        .otherwise(text != "")
    )


def active_until(valid_to: Column, as_of: str) -> Column:
    """True unless the ISO end date is strictly before ``as_of``."""
    return F.coalesce(
        F.try_to_date(valid_to, "yyyy-MM-dd") >= F.to_date(F.lit(as_of)), F.lit(True)
    )
