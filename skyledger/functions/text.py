"""From raw text fields to typed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The field texts a default delimited-file reader takes as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def known_text(text: Column) -> Column:
    """The text, or null where it is one of the missing-value tokens."""
    return F.when(~text.isin(*MISSING_TOKENS), text)


def to_number(text: Column) -> Column:
    """Double value of a text field; null when missing or not a number."""
    return known_text(text).try_cast("double")


def to_whole(text: Column, type_name: str = "int") -> Column:
    """Integer value of a text field.

    ``1430`` and ``1430.0`` are both whole (a table that had gaps prints its
    integers with a decimal point); text with a real fraction is not and gives null.
    No missing-value token reads as an integer. They are tested for all the same, once and
    first: a failing cast raises an error within Spark, which costs as much as dozens of
    casts that succeed, and tokens are what most failing casts would meet.
    """
    ends_in_point = F.rtrim(text, F.lit("0")).endswith(".")
    number = F.coalesce(
        text.try_cast(type_name),
        F.when(ends_in_point, F.substring_index(text, ".", 1).try_cast(type_name)),
    )
    return F.when(~text.isin(*MISSING_TOKENS), number)


def to_typed(text: Column, type_name: str) -> Column:
    """Value of a text field in one of the flight column types."""
    if type_name == "string":
        return known_text(text)
    if type_name == "double":
        return to_number(text)
    return to_whole(text, type_name)
