"""Scalar expressions: addresses, technology codes, bands, flags, index arithmetic."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from merchant_features.functions.columns import ColumnLike, as_column

# Technology letters with their rank and label, inactivity bands
# (upper bound in months, label), banks that do not accept settlement.
TECHNOLOGIES = (("W", 1, "WIFI"), ("G", 2, "GSM"), ("E", 3, "ETHERNET"), ("D", 4, "DIAL_UP"))
UNKNOWN_TECHNOLOGY_RANK = 9
PINPAD_PREFIX = "51"
PINPAD_LABEL = "PINPAD"
NO_DATA_LABEL = "SIN DATO"
ACTIVE_LABEL = "Activo"
INACTIVITY_BANDS = ((3, "1 a 3"), (6, "3 a 6"), (9, "6 a 9"), (12, "9 a 12"))
LONGEST_INACTIVITY_LABEL = "Mas de 12"
BANKS_WITHOUT_SETTLEMENT = (16, 67, 150, 415, 27, 314, 316, 322, 499)
COUNTRY = "ARGENTINA"
YES, NO = "SI", "NO"
CHANGE_DEVICE, WITHOUT_MODEL = "Cambiar Equipo", "Sin modelo"
SOFTWARE_UNKNOWN, SOFTWARE_CHANGE, SOFTWARE_OK = "Sin Dato", "Cambiar Soft", "Soft Correcto"
SOFTWARE_WRONG = "Mal"

DAYS_PER_MONTH = 30
REINSTALL_TOLERANCE_DAYS = 15


def terminal_number(prefix: ColumnLike, serial: ColumnLike) -> Column:
    """Two-character prefix followed by the serial; NULL when either is NULL."""
    return F.concat(F.substring(as_column(prefix), 1, 2), as_column(serial))


def province_code(region: ColumnLike) -> Column:
    return F.substring(as_column(region), 1, 1)


def format_address(
    street: ColumnLike,
    number: ColumnLike,
    locality: ColumnLike,
    province: ColumnLike,
    country: str = COUNTRY,
) -> Column:
    """One line: the non-empty parts and the country, joined by a comma."""
    parts = [F.nullif(as_column(c), F.lit("")) for c in (street, number, locality, province)]
    return F.concat_ws(", ", *parts, F.lit(country))


def is_blank(value: ColumnLike) -> Column:
    return F.coalesce(as_column(value), F.lit("")) == ""


def tech_code(extra: ColumnLike) -> Column:
    """The character five from the right (the first one of a shorter text)."""
    return F.left(F.right(as_column(extra), F.lit(5)), F.lit(1))


def tech_rank(code: Column) -> Column:
    ranked = reduce(
        lambda expr, tech: expr.when(code == tech[0], tech[1]),
        TECHNOLOGIES[1:],
        F.when(code == TECHNOLOGIES[0][0], TECHNOLOGIES[0][1]),
    )
    return ranked.otherwise(UNKNOWN_TECHNOLOGY_RANK)


def tech_label(rank: ColumnLike, prefix: ColumnLike) -> Column:
    rank = as_column(rank)
    first, *rest = TECHNOLOGIES
    labelled = reduce(
        lambda expr, tech: expr.when(rank == tech[1], tech[2]),
        rest,
        F.when(rank == first[1], first[2]),
    )
    is_pinpad = F.substring(as_column(prefix), 1, 2) == PINPAD_PREFIX
    return labelled.when(is_pinpad, PINPAD_LABEL).otherwise(NO_DATA_LABEL)


def months_inactive(install: ColumnLike, last_activity: ColumnLike, days: ColumnLike) -> Column:
    """Idle days in 30-day months; NULL when the install is over 15 days after the last activity."""
    in_time = as_column(install) <= F.date_add(as_column(last_activity), REINSTALL_TOLERANCE_DAYS)
    return F.when(in_time, as_column(days) / F.lit(float(DAYS_PER_MONTH)))


def inactivity_band(months: ColumnLike) -> Column:
    """Label of the half-open band the idle months fall in; NULL stays NULL."""
    months = as_column(months)
    banded = reduce(
        lambda expr, band: expr.when(months < band[0], band[1]),
        INACTIVITY_BANDS,
        F.when(months <= 1, ACTIVE_LABEL),
    )
    return banded.when(months >= INACTIVITY_BANDS[-1][0], LONGEST_INACTIVITY_LABEL)


def flag_present(value: ColumnLike) -> Column:
    return F.when(as_column(value).isNotNull(), YES).otherwise(NO)


def accepts_settlement(bank: ColumnLike, excluded: Iterable[int] = BANKS_WITHOUT_SETTLEMENT) -> Column:
    bank = as_column(bank)
    return F.when(bank.isNull() | bank.isin(*excluded), NO).otherwise(YES)


def software_condition(recommended: ColumnLike, current: ColumnLike) -> Column:
    recommended, current = as_column(recommended), as_column(current)
    return (
        F.when(recommended == CHANGE_DEVICE, CHANGE_DEVICE)
        .when(recommended.isNull() | (recommended == WITHOUT_MODEL), SOFTWARE_UNKNOWN)
        .when(recommended != current, SOFTWARE_CHANGE)
        .when(recommended == current, SOFTWARE_OK)
        .otherwise(SOFTWARE_WRONG)
    )


def phone_number(area: ColumnLike, number: ColumnLike) -> Column:
    return F.concat(as_column(area), F.lit("-"), as_column(number))


def first_name(names: Sequence[ColumnLike]) -> Column:
    return F.coalesce(*[as_column(n) for n in names])


def deflate(amount: ColumnLike, index: ColumnLike) -> Column:
    """Amount in base-period money; a missing index counts as 1."""
    return as_column(amount).cast("double") / F.coalesce(as_column(index), F.lit(1.0))


def inflate(amount: ColumnLike, index: ColumnLike) -> Column:
    """Amount times the index when the index is positive, else the amount itself."""
    index = as_column(index)
    return as_column(amount).cast("double") * F.when(index > 0, index).otherwise(F.lit(1.0))


def per_unit(value: ColumnLike, units: ColumnLike, scale: int = 2) -> Column:
    """Rounded ratio; NULL when there are no units.

    Ties are those of the ratio times 10^scale as a double, as SQL engines round doubles; ``round(x, scale)`` takes them
    by the shortest decimal text of the double.
    """
    whole = float(10**scale)
    return F.round(F.try_divide(as_column(value).cast("double"), as_column(units)) * F.lit(whole)) / F.lit(whole)
