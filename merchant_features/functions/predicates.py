"""Row predicates.

Date predicates compare the bare column with typed literals on half-open
bounds, so they hold for DATE and TIMESTAMP columns alike (the last day counts
up to midnight) and still reach the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from merchant_features.functions.columns import ColumnLike, as_column

# Fixed values of the data model.
OPEN_END = date(9999, 12, 31)
APPROVED_CODES = (0, 1, 4, 7, 400)
APPROVED_WITH_NUMBER_CODE = 900
AUTHORISATION_MESSAGE = 1100
ACQUIRING_PROGRAMS = ((530000, 549999),)
ACTIVITY_PROGRAMS = ((19000, 19999), (520000, 549999))
EXCLUDED_TERMINALS = ("17010499",)
INSTALLED_PREFIXES = (
    "07", "09", "10", "11", "12", "13", "14", "15", "16", "17", "18",
    "31", "32", "33", "34", "35", "36", "47", "48", "49", "51",
)
UNIVERSE_PREFIXES = ("08", *INSTALLED_PREFIXES)
INSTALL_STATES = (2, 3, 11, 12, 17)
MIN_ACTIVITY_AMOUNT = 300


def in_range(day: ColumnLike, lo: date, hi: date) -> Column:
    """``lo <= day <= hi`` on whole days."""
    day = as_column(day)
    return (day >= F.lit(lo)) & (day < F.lit(hi + timedelta(days=1)))


def is_current(end: ColumnLike) -> Column:
    """The version is open: its end is the 9999-12-31 sentinel."""
    return as_column(end) >= F.lit(OPEN_END)


def valid_in_window(
    start: ColumnLike, end: ColumnLike, lo: date, hi: date, null_is_open: bool = False
) -> Column:
    """The version starts by ``hi`` and ends after ``lo`` or is open."""
    end = as_column(end)
    is_open = end.isNull() if null_is_open else is_current(end)
    started = as_column(start) < F.lit(hi + timedelta(days=1))
    return started & ((end >= F.lit(lo + timedelta(days=1))) | is_open)


def in_any_range(value: ColumnLike, ranges: Iterable[tuple[int, int]]) -> Column:
    value = as_column(value)
    return reduce(lambda a, b: a | b, [value.between(lo, hi) for lo, hi in ranges])


def has_prefix(value: ColumnLike, prefixes: Iterable[str], n: int = 2) -> Column:
    return F.substring(as_column(value), 1, n).isin(*prefixes)


def min_amount(amount: ColumnLike, bound: float, strict: bool = False) -> Column:
    amount = as_column(amount)
    return amount > bound if strict else amount >= bound


def is_approved(
    code: ColumnLike = "cod_respuesta_autorizacion", number: ColumnLike = "nro_autorizacion"
) -> Column:
    code = as_column(code)
    numbered = (code == APPROVED_WITH_NUMBER_CODE) & (F.trim(as_column(number)) != "")
    return code.isin(*APPROVED_CODES) | numbered


def is_network_txn(
    programs: Iterable[tuple[int, int]],
    message: ColumnLike = "cod_tipo_mensaje_autoriz",
    program: ColumnLike = "programa_periferia_origen",
    terminal: ColumnLike = "nro_terminal",
    excluded: Iterable[str] = EXCLUDED_TERMINALS,
) -> Column:
    """Authorisation message, program in one of the ranges, terminal not excluded."""
    return (
        (as_column(message) == AUTHORISATION_MESSAGE)
        & in_any_range(program, programs)
        & ~as_column(terminal).isin(*excluded)
    )


def is_acquiring_txn(
    amount: ColumnLike = "monto_autoriz_moneda_orig",
    programs: Iterable[tuple[int, int]] = ACQUIRING_PROGRAMS,
) -> Column:
    return is_network_txn(programs) & min_amount(amount, 0, strict=True)
