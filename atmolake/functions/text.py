"""Text helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from atmolake.fixed_values import NO_SYMBOL, NOT_AVAILABLE, POLLUTANT_SYMBOLS, UNKNOWN_POLLUTANT


def first_segment(text: Column, delimiter: str) -> Column:
    """Text before the first delimiter; all of it if there is none."""
    return F.split_part(text, F.lit(delimiter), F.lit(1))


def digits_only(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def without_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[0-9]", "")


def default_symbol(symbol: Column) -> Column:
    """`-` for an empty symbol; NULL stays NULL."""
    return F.when(symbol == "", NO_SYMBOL).otherwise(symbol)


def strip_trailing_digits_and_brackets(text: Column) -> Column:
    return F.regexp_replace(text, r"[0-9\[\]]+$", "")


def plain_spaces(text: Column) -> Column:
    """Non-breaking spaces become spaces."""
    return F.translate(text, "\u00a0", " ")


def plain_primes(text: Column) -> Column:
    """Prime marks of coordinates become apostrophes."""
    return F.translate(text, "\u2032", "'")


def same_text(left: Column, right: Column | str) -> Column:
    """Match that ignores case."""
    right = F.lit(right) if isinstance(right, str) else right
    return F.lower(left) == F.lower(right)


def pollutant_token(token: Column) -> Column:
    """struct(pollutant, unit, number) of a reading such as `58**`; all NULL for `N/A`.

    The symbol table is a CASE of seven branches, not a join: with so few distinct symbols a
    shuffled join would put a seventh of all readings or more into single tasks.
    """
    symbol = without_digits(token)
    available = token != NOT_AVAILABLE

    def ladder(position: int, fallback: Column) -> Column:
        case = F.when(symbol == POLLUTANT_SYMBOLS[0][0], F.lit(POLLUTANT_SYMBOLS[0][position]))
        for row in POLLUTANT_SYMBOLS[1:]:
            case = case.when(symbol == row[0], F.lit(row[position]))
        return case.otherwise(fallback)

    pollutant = ladder(1, F.lit(UNKNOWN_POLLUTANT))
    unit = ladder(2, F.lit(None).cast("string"))
    number = F.regexp_extract(token, "([0-9]+)", 1).try_cast("bigint")
    return F.struct(
        F.when(available, pollutant).alias("pollutant"),
        F.when(available, unit).alias("unit"),
        F.when(available, number).alias("number"),
    )
