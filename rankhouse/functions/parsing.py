"""Text-to-number expressions; text that is not a number gives NULL, also under ANSI mode."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from rankhouse.fixed_values import DECIMAL_PATTERN, METRIC_UNITS, WORD_UNITS


def plain_number(text: Column) -> Column:
    """Double value of a text that is, but for spaces around it, a decimal number as a whole. Words, NaN, hexadecimal numbers,
    line breaks and Java suffixes such as ``9.0d`` give NULL; the cast alone would accept some of them."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(DECIMAL_PATTERN), trimmed.try_cast("double"))


def number_with_unit(text: Column, units: Mapping[str, float], default_unit: float = 1.0) -> Column:
    """Strip the first unit of ``units`` that occurs in the text and scale; unitless text is scaled by ``default_unit``."""
    value = plain_number(text) * default_unit if default_unit != 1.0 else plain_number(text)
    for unit, factor in reversed(units.items()):
        stripped = plain_number(F.replace(text, F.lit(unit)))
        value = F.when(F.contains(text, F.lit(unit)), stripped * factor).otherwise(value)
    return value


def metric_number(text: Column, default_unit: float = 1.0) -> Column:
    return number_with_unit(text, METRIC_UNITS, default_unit)


def words_number(text: Column) -> Column:
    return number_with_unit(text, WORD_UNITS)


def month_start(text: Column) -> Column:
    """First day of a ``yyyyMM`` month; other text gives NULL."""
    return F.when(text.rlike("^[0-9]{6}$"), F.try_to_date(text, "yyyyMM"))
