"""Typing of raw text: missing-value tokens, whitespace, numbers and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts that mean "missing" in a raw CSV file.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"
DATE_PATTERN = r"^\d{4}-\d{1,2}-\d{1,2}$"


def null_tokens(c: Column) -> Column:
    return F.when(~c.isin(*NULL_TOKENS), c)


def strip(c: Column) -> Column:
    """Remove all leading and trailing Unicode whitespace, not just spaces."""
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def parse_number(c: Column) -> Column:
    """Text to double, null where the text is not a plain decimal number or an infinity."""
    return F.when(c.rlike(NUMBER_PATTERN), F.trim(c).try_cast("double"))


def parse_date(c: Column) -> Column:
    """Text to date, null for anything but a real calendar day written year-month-day."""
    return F.when(c.rlike(DATE_PATTERN), F.try_to_date(c, "yyyy-M-d"))


def is_infinite(c: Column) -> Column:
    return F.abs(c) == F.lit(float("inf"))
