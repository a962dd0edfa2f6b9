"""Transaction activity: daily summaries, trailing month and week windows, per-unit measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchant_features.functions import expressions as E
from merchant_features.functions import predicates as P
from merchant_features.functions.columns import ColumnLike, as_column
from merchant_features.functions.expressions import per_unit
from merchant_features.functions.periods import (
    MONTHS,
    WEEKS,
    anchors,
    month_position,
    week_position,
)
from merchant_features.operators.history import valid_at_join
from merchant_features.operators.lookup import existing, with_index

# Operation codes of local and USD movements.
LOCAL_OPERATION = "0005"
USD_OPERATION = "0510"

ESTABLISHMENT = "nro_establecimiento"
TERMINAL = "nro_terminal"
AUTH_DAY = "fecha_host_entrada_autoriz"
AUTH_ESTABLISHMENT = "nro_establecimiento_orig"
AMOUNT = "monto_autoriz_moneda_orig"
TECHNOLOGY_COUNTS = {"W": "q_tx_wifi", "G": "q_tx_gsm", "E": "q_tx_ethernet", "D": "q_tx_dialup"}


def movement_measures() -> dict[str, Column]:
    """What one settled movement adds to the local and USD count and volume."""
    local = F.col("cod_tipo_operacion") == LOCAL_OPERATION
    usd = F.col("cod_tipo_operacion") == USD_OPERATION
    return {
        "cant": F.when(local, 1).otherwise(0),
        "vol": F.when(local, F.col("monto_movimiento")).otherwise(0),
        "cant_usd": F.when(usd, 1).otherwise(0),
        "vol_usd": F.when(usd, F.col("monto_movimiento_origen")).otherwise(0),
    }


def valid_movements(movements: DataFrame, lo: date, hi: date) -> DataFrame:
    return movements.where(
        P.min_amount("monto_movimiento", 0, strict=True) & P.in_range("fecha_movimiento", lo, hi)
    )


def daily_movements(movements: DataFrame, lo: date, hi: date) -> DataFrame:
    """Count and volume per establishment and day, local and USD side by side."""
    return (
        valid_movements(movements, lo, hi)
        .groupBy(F.to_date("fecha_movimiento").alias("fecha_movimiento"), ESTABLISHMENT)
        .agg(*[F.sum(expr).alias(name) for name, expr in movement_measures().items()])
    )


def daily_authorizations(authorisations: DataFrame, lo: date, hi: date) -> DataFrame:
    """Approved acquirer volume and count per terminal, establishment and day."""
    return (
        authorisations.where(
            P.is_approved() & P.is_acquiring_txn() & P.in_range(AUTH_DAY, lo, hi)
        )
        .groupBy(TERMINAL, AUTH_ESTABLISHMENT, F.to_date(AUTH_DAY).alias(AUTH_DAY))
        .agg(F.sum(AMOUNT).alias("volumen"), F.count(F.lit(1)).alias("cantidad"))
    )


def summarise_authorisations(authorisations: DataFrame) -> DataFrame:
    """Everything the plans need of the authorisations, per terminal, establishment and day.

    One scan and one shuffle of the largest table; the three readings below
    start from this much smaller relation.
    """
    uses = {
        "acquiring": P.is_acquiring_txn(),
        "activity": P.is_network_txn(P.ACTIVITY_PROGRAMS),
        "status": is_status_txn(),
    }
    code = E.tech_code("datos_adicionales_2")
    rows = authorisations.where(P.is_approved()).select(
        TERMINAL,
        AUTH_ESTABLISHMENT,
        F.to_date(AUTH_DAY).alias(AUTH_DAY),
        AMOUNT,
        code.alias("__tech"),
        *[F.coalesce(used, F.lit(False)).alias(f"__{name}") for name, used in uses.items()],
    )
    status, tech = F.col("__status"), F.col("__tech")
    return (
        rows.where(F.col("__acquiring") | F.col("__activity") | status)
        .groupBy(TERMINAL, AUTH_ESTABLISHMENT, AUTH_DAY)
        .agg(
            F.sum(F.when(F.col("__acquiring"), F.col(AMOUNT))).alias("volumen"),
            F.count(F.when(F.col("__acquiring"), 1)).alias("cantidad"),
            F.sum(F.when(F.col("__activity"), F.col(AMOUNT))).alias("volumen_transacciones"),
            F.count(F.when(F.col("__activity"), 1)).alias("cantidad_transacciones"),
            F.min(F.when(status, E.tech_rank(tech))).alias("rango_tecnologia"),
            *[
                F.count(F.when(status & (tech == letter), 1)).alias(name)
                for letter, name in TECHNOLOGY_COUNTS.items()
            ],
        )
    )


def acquiring_days(summary: DataFrame) -> DataFrame:
    """The summary read as ``daily_authorizations``."""
    return summary.where("cantidad > 0").select(
        TERMINAL, AUTH_ESTABLISHMENT, AUTH_DAY, "volumen", "cantidad"
    )


def establishment_days(summary: DataFrame) -> DataFrame:
    """The summary read as approved count and volume per establishment and day."""
    return (
        summary.where("cantidad_transacciones > 0")
        .groupBy(AUTH_DAY, F.col(AUTH_ESTABLISHMENT).alias(ESTABLISHMENT))
        .agg(*[F.sum(c).alias(c) for c in ("cantidad_transacciones", "volumen_transacciones")])
    )


def terminal_days(summary: DataFrame, lastday: date) -> DataFrame:
    """The summary read as ``terminal_activity``."""
    grouped = summary.where("rango_tecnologia IS NOT NULL").groupBy(TERMINAL).agg(
        F.max(AUTH_DAY).alias("ultima_fecha_actividad"),
        F.min("rango_tecnologia").alias("rango_tecnologia"),
        *[F.sum(c).alias(c) for c in TECHNOLOGY_COUNTS.values()],
    )
    return with_idle_days(grouped, lastday)


def is_status_txn() -> Column:
    """Large enough and on an installed terminal."""
    return P.min_amount(AMOUNT, P.MIN_ACTIVITY_AMOUNT) & P.has_prefix(TERMINAL, P.INSTALLED_PREFIXES)


def with_idle_days(df: DataFrame, lastday: date) -> DataFrame:
    return df.withColumn(
        "dias_sin_actividad", F.datediff(F.lit(lastday), F.col("ultima_fecha_actividad"))
    )


def terminal_activity(authorisations: DataFrame, lastday: date) -> DataFrame:
    """Last activity, idle days, best technology rank and technology counts per terminal."""
    code = E.tech_code("datos_adicionales_2")
    grouped = (
        authorisations.where(P.is_approved() & is_status_txn())
        .groupBy(TERMINAL)
        .agg(
            F.max(F.to_date(AUTH_DAY)).alias("ultima_fecha_actividad"),
            F.min(E.tech_rank(code)).alias("rango_tecnologia"),
            *[
                F.count(F.when(code == letter, 1)).alias(name)
                for letter, name in TECHNOLOGY_COUNTS.items()
            ],
        )
    )
    return with_idle_days(grouped, lastday)


def daily_by_terminal(daily: DataFrame, lo: date, hi: date) -> DataFrame:
    """Volume per terminal and day over all its establishments."""
    return (
        daily.where(P.in_range(AUTH_DAY, lo, hi))
        .groupBy(TERMINAL, AUTH_DAY)
        .agg(F.sum("volumen").alias("suma_monto"))
    )


def daily_establishment_activity(
    authorisations: DataFrame,
    history: DataFrame,
    programs: Sequence[tuple[int, int]] = P.ACTIVITY_PROGRAMS,
    weighting: str = "none",
) -> DataFrame:
    """Approved count and volume per known establishment and day."""
    daily = (
        authorisations.where(P.is_approved() & P.is_network_txn(programs))
        .groupBy(
            F.to_date(AUTH_DAY).alias(AUTH_DAY),
            F.col(AUTH_ESTABLISHMENT).alias(ESTABLISHMENT),
        )
        .agg(
            F.count(F.lit(1)).alias("cantidad_transacciones"),
            F.sum(AMOUNT).alias("volumen_transacciones"),
        )
    )
    return of_known_establishments(daily, history, weighting)


def of_known_establishments(
    daily: DataFrame, history: DataFrame, weighting: str = "none"
) -> DataFrame:
    """Daily activity of the establishments in the history.

    The facts are already summed to establishment and day. ``weighting`` says
    what several history versions do: "none" counts every transaction once,
    "rows" once per version, "valid" once per version valid on the day.
    """
    if weighting == "none":
        return existing(daily, history, ESTABLISHMENT)
    if weighting == "rows":
        versions = history.groupBy(ESTABLISHMENT).agg(F.count(F.lit(1)).alias("__n"))
        weighted = daily.join(versions, ESTABLISHMENT)
    elif weighting == "valid":
        validity = history.select(ESTABLISHMENT, "fecha_inicio", "fecha_fin")
        weighted = (
            valid_at_join(daily, validity, ESTABLISHMENT, AUTH_DAY)
            .groupBy(*daily.columns)
            .agg(F.count(F.lit(1)).alias("__n"))
        )
    else:
        raise ValueError(f"unknown weighting {weighting!r}")
    return weighted.select(
        AUTH_DAY,
        ESTABLISHMENT,
        *[
            (F.col(c) * F.col("__n")).alias(c)
            for c in ("cantidad_transacciones", "volumen_transacciones")
        ],
    )


def _window_sum(position: Column, i: int, measure: Column) -> Column:
    return F.coalesce(F.sum(F.when(position == i, measure)), F.lit(0))


def trailing_features(
    df: DataFrame,
    key: str | Sequence[str],
    day: str,
    measures: Mapping[str, ColumnLike],
    date_ref: date,
    months: int = MONTHS,
    weeks: int = WEEKS,
) -> DataFrame:
    """Sums of ``measures`` per key over trailing months and weeks, as wide columns.

    One pass and one shuffle: every row knows its month and week position, and
    each window is a conditional sum over it. Column names are
    ``{measure}_m{i}`` and ``{measure}_w{i}``.
    """
    a = anchors(date_ref)
    keys = [key] if isinstance(key, str) else list(key)
    span = a.trailing_start(months) if months else a.trailing_start(2)
    rows = df.where(P.in_range(day, span, a.lastday)).select(
        *keys,
        month_position(day, date_ref).alias("__month"),
        week_position(day, date_ref).alias("__week"),
        *[as_column(m).alias(name) for name, m in measures.items()],
    )
    windows = [("m", "__month", i) for i in range(1, months + 1)]
    windows += [("w", "__week", i) for i in range(1, weeks + 1)]
    return rows.groupBy(*keys).agg(
        *[
            _window_sum(F.col(position), i, F.col(name)).alias(f"{name}_{letter}{i}")
            for letter, position, i in windows
            for name in measures
        ]
    )


def trailing_months(
    df: DataFrame,
    key: str | Sequence[str],
    day: str,
    measures: Mapping[str, ColumnLike],
    date_ref: date,
    months: int = MONTHS,
) -> DataFrame:
    return trailing_features(df, key, day, measures, date_ref, months=months, weeks=0)


def trailing_weeks(
    df: DataFrame,
    key: str | Sequence[str],
    day: str,
    measures: Mapping[str, ColumnLike],
    date_ref: date,
    weeks: int = WEEKS,
) -> DataFrame:
    return trailing_features(df, key, day, measures, date_ref, months=0, weeks=weeks)


def trailing_months_deflated(
    df: DataFrame,
    key: str,
    day: str,
    counts: Mapping[str, ColumnLike],
    volumes: Mapping[str, ColumnLike],
    index: DataFrame,
    date_ref: date,
    months: int = MONTHS,
) -> DataFrame:
    """Trailing months with volumes divided by the month's index (1 where it is missing).

    A window is one calendar month, hence has one index: the volume is summed
    exactly first and divided once, not row by row.
    """
    a = anchors(date_ref)
    rows = with_index(
        df.where(P.in_range(day, a.trailing_start(months), a.lastday)), day, index, "left", a
    ).select(
        key,
        month_position(day, date_ref).alias("__month"),
        "indice",
        *[as_column(m).alias(name) for name, m in {**counts, **volumes}.items()],
    )
    aggregates = []
    for i in range(1, months + 1):
        inside = F.col("__month") == i
        divisor = F.coalesce(F.max(F.when(inside, F.col("indice"))), F.lit(1.0))
        for name in counts:
            aggregates.append(_window_sum(F.col("__month"), i, F.col(name)).alias(f"{name}_m{i}"))
        for name in volumes:
            total = F.sum(F.when(inside, F.col(name))).cast("double")
            aggregates.append(
                F.coalesce(total / divisor, F.lit(0.0)).alias(f"{name}_m{i}")
            )
    return rows.groupBy(key).agg(*aggregates)


def establishment_activity(movements: DataFrame, date_ref: date) -> DataFrame:
    """Trailing months and weeks of every establishment, straight from its movements."""
    a = anchors(date_ref)
    valid = valid_movements(movements, a.firstday, a.lastday)
    return trailing_features(
        valid, ESTABLISHMENT, "fecha_movimiento", movement_measures(), date_ref
    )


def measure_names(prefixes: Sequence[str], months: int = MONTHS, weeks: int = 0) -> list[str]:
    names = [f"{p}_m{i}" for i in range(1, months + 1) for p in prefixes]
    return names + [f"{p}_w{i}" for i in range(1, weeks + 1) for p in prefixes]


def terminals_per(df: DataFrame, key: str, terminal: str = TERMINAL) -> DataFrame:
    """Distinct terminals of every key; duplicates go before the count, so a hot key spreads."""
    return df.select(key, terminal).distinct().groupBy(key).agg(F.count(terminal).alias("cant_term"))


def per_unit_measures(df: DataFrame, names: Sequence[str], unit: str) -> DataFrame:
    """Every measure per unit with two exact decimals; 0 where it is unknown."""
    return df.withColumns(
        {
            n: F.coalesce(per_unit(n, unit), F.lit(0.0)).cast("decimal(28,2)")
            for n in names
        }
    )
