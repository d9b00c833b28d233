"""Null-safe text and number expressions with the source data's conventions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the number forms accepted as text (blanks around them are ignored).
NUMERIC_TEXT = r"(?i)\A\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)(e[+-]?[0-9]+)?\s*\z"


def no_nan(value: Column) -> Column:
    """NaN counts as missing everywhere; Spark would sort and compare it as largest."""
    return F.when(~F.isnan(value), value)


def numeric_text(text: Column) -> Column:
    """Double value of numeric text, null for anything else."""
    as_text = text.cast("string")
    return F.when(as_text.rlike(NUMERIC_TEXT), F.trim(as_text).try_cast("double"))


def positive(value: Column) -> Column:
    return (value > 0) & ~F.isnan(value)


def year_of(text: Column) -> Column:
    """Year from the first four characters."""
    return numeric_text(F.substring(text.cast("string"), 1, 4))


def birth_year(text: Column, as_of_year: int) -> Column:
    """Last four digits of an all-digit text of at least four, otherwise ``as_of_year``."""
    as_text = text.cast("string")
    return (
        F.when(as_text.rlike(r"\A[0-9]{4,}\z"), F.substring(as_text, -4, 4).cast("int"))
        .otherwise(F.lit(as_of_year))
    )


def sex_flag(text: Column) -> Column:
    """0 for zero or missing, 1 for everything else."""
    as_text = F.coalesce(text.cast("string"), F.lit("0"))
    return F.when(as_text.rlike(r"\A0+\z"), F.lit(0)).otherwise(F.lit(1))


def category_list(text: Column) -> Column:
    """Comma list without trimming; missing gives the one empty category."""
    return F.split(F.coalesce(text, F.lit("")), ",")


def tag_name_set(text: Column) -> Column:
    """Distinct tag names of a ', ' list."""
    return F.array_distinct(F.split(F.coalesce(text, F.lit("")), ", "))


def rule_tag_set(text: Column) -> Column:
    """Distinct tag ids, as text, of a rule's ',' list."""
    return F.array_distinct(F.split(text, ","))


def has_word(text: Column) -> Column:
    """True where the text has a letter, digit or underscore of any script."""
    return F.coalesce(text.rlike(r"(?U)\w"), F.lit(False))


def text_or_none(value: Column) -> Column:
    """Text form of a looked-up value; a missing one reads ``None``."""
    return F.coalesce(value.cast("string"), F.lit("None"))
