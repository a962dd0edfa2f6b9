"""What a terminal does after its install, activation levels, days to activation and the label."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchant_features.functions import predicates as P
from merchant_features.functions.expressions import inflate
from merchant_features.functions.periods import Anchors
from merchant_features.operators.activity import (
    AUTH_DAY,
    AUTH_ESTABLISHMENT,
    ESTABLISHMENT,
    TERMINAL,
    daily_by_terminal,
)
from merchant_features.operators.lookup import with_index

# Activation amount in base-period money, the label's upper bound,
# days watched after an install, days assumed when activation never came.
ACTIVATION_AMOUNT = 85_000
LABEL_MAX_AMOUNT = 500_000_000
WATCH_DAYS = 30
DEFAULT_DAYS = 180

INSTALL = "fecha_instalacion"
CONTRACT_ESTABLISHMENT = "nro_establecimiento_contrato"


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    start: str,
    day: str,
    days: int = WATCH_DAYS,
    how: str = "left",
) -> DataFrame:
    """Right rows of the same key dated from ``start`` to ``start`` + ``days``.

    The key is the hash-join key and the interval a residual predicate. Bring
    the right side to one row per key and day first: a left row then meets at
    most ``days`` + 1 rows.
    """
    other = right.withColumnRenamed(key, "__key")
    on = (F.col(key) == F.col("__key")) & F.col(day).between(
        F.col(start), F.date_add(F.col(start), days)
    )
    return left.join(other, on, how).drop("__key")


def cumulative_volume(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Running sum per key in date order."""
    window = (
        Window.partitionBy(*keys)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn("vol_cum", F.sum(value).over(window))


def establishment_number(value: str) -> Column:
    """Text establishment number as a join key; NULL when it is not a number."""
    return F.expr(f"try_cast({value} AS decimal(18,0))")


def installs_in_window(installed: DataFrame, a: Anchors) -> DataFrame:
    """Distinct owner, contracted establishment, terminal and install date in the scan window."""
    return (
        installed.where(P.in_range(INSTALL, a.firstday, a.lastday))
        .select(
            F.col("cuit"),
            establishment_number(CONTRACT_ESTABLISHMENT).alias(ESTABLISHMENT),
            TERMINAL,
            F.to_date(INSTALL).alias(INSTALL),
        )
        .distinct()
    )


def install_series(installs: DataFrame, daily: DataFrame, a: Anchors) -> DataFrame:
    """Daily and cumulative volume of the first 30 days of every install.

    Every terminal and install date is watched once, whatever number of
    establishments the install is credited to. Terminals without any
    transaction keep one row with NULLs.
    """
    watched = installs.select(TERMINAL, INSTALL).distinct()
    by_day = daily_by_terminal(daily, a.firstday, a.lastday)
    return cumulative_volume(
        interval_join(watched, by_day, TERMINAL, INSTALL, AUTH_DAY),
        [TERMINAL, INSTALL],
        AUTH_DAY,
        "suma_monto",
    )


def install_outcomes(
    installs: DataFrame,
    daily: DataFrame,
    index: DataFrame,
    a: Anchors,
    threshold: float = ACTIVATION_AMOUNT,
) -> DataFrame:
    """Per terminal and install date: 30-day volume, index, days to first sale and to the threshold.

    Installs of months without an index row are dropped.
    """
    series = with_index(install_series(installs, daily, a), INSTALL, index, "inner", a)
    reached = F.col("vol_cum") >= F.col("indice") * threshold
    return (
        series.groupBy(TERMINAL, INSTALL)
        .agg(
            F.sum("suma_monto").alias("monto_30"),
            F.min("indice").alias("indice"),
            F.min(F.when(F.col("vol_cum") >= 0, F.col(AUTH_DAY))).alias("__first"),
            F.min(F.when(reached, F.col(AUTH_DAY))).alias("__reached"),
        )
        .select(
            TERMINAL,
            INSTALL,
            "monto_30",
            "indice",
            F.datediff("__first", INSTALL).alias("dias_1tx"),
            F.datediff("__reached", INSTALL).alias("dias_85000"),
        )
    )


def activation_level(amount: Column, index: Column, threshold: float = ACTIVATION_AMOUNT) -> Column:
    """0 when the amount is missing or below the indexed threshold, else 1."""
    low = amount.isNull() | (amount < F.coalesce(index, F.lit(0.0)) * threshold)
    return F.when(low, 0).otherwise(1)


def activation_levels(
    installs: DataFrame, outcomes: DataFrame, threshold: float = ACTIVATION_AMOUNT
) -> DataFrame:
    """Activation level of every owner, contracted establishment and terminal."""
    return (
        installs.where(F.col(ESTABLISHMENT).isNotNull())
        .join(outcomes.select(TERMINAL, INSTALL, "monto_30", "indice"), [TERMINAL, INSTALL])
        .groupBy("cuit", ESTABLISHMENT, TERMINAL)
        .agg(F.sum("monto_30").alias("monto_30"), F.min("indice").alias("indice"))
        .select(
            "cuit",
            ESTABLISHMENT,
            TERMINAL,
            activation_level(F.col("monto_30"), F.col("indice"), threshold).alias(
                "nivel_activacion"
            ),
        )
    )


def level_counts(levels: DataFrame) -> DataFrame:
    """Number of terminals at level 0 and 1 per owner and establishment."""
    return levels.groupBy("cuit", ESTABLISHMENT).agg(
        *[
            F.sum(F.when(F.col("nivel_activacion") == level, 1).otherwise(0)).alias(
                f"terminales_nivel_{level}"
            )
            for level in (0, 1)
        ]
    )


def owner_days(installs: DataFrame, outcomes: DataFrame, default: float = DEFAULT_DAYS) -> DataFrame:
    """Mean days to the first sale and to the threshold over all terminals of an owner.

    An install counts for every establishment of its owner, so each of them
    has the owner's mean and it is computed once per owner.
    """
    per_terminal = (
        installs.select("cuit", TERMINAL, INSTALL)
        .distinct()
        .join(outcomes.select(TERMINAL, INSTALL, "dias_1tx", "dias_85000"), [TERMINAL, INSTALL])
        .withColumns({n: F.date_add(F.col(INSTALL), F.col(n)) for n in ("dias_1tx", "dias_85000")})
        .groupBy("cuit", TERMINAL)
        .agg(
            F.min(INSTALL).alias(INSTALL),
            F.min("dias_1tx").alias("dias_1tx"),
            F.min("dias_85000").alias("dias_85000"),
        )
    )
    return per_terminal.groupBy("cuit").agg(
        *[
            F.coalesce(F.avg(F.datediff(n, INSTALL)), F.lit(float(default))).alias(f"avg_{n}")
            for n in ("dias_1tx", "dias_85000")
        ]
    )


def label_class(amount: Column, low: float = ACTIVATION_AMOUNT, high: float = LABEL_MAX_AMOUNT) -> Column:
    """1 when the adjusted amount lies between the bounds, else 0; NULL is 0."""
    return F.when(amount.between(low, high), 1).otherwise(0)


def month_volume(daily: DataFrame, a: Anchors) -> DataFrame:
    """Volume of the label month per establishment."""
    return (
        daily.where(P.in_range(AUTH_DAY, a.label_start, a.lastday))
        .groupBy(F.col(AUTH_ESTABLISHMENT).alias(ESTABLISHMENT))
        .agg(F.sum("volumen").alias("suma_monto"))
    )


def establishment_label(
    establishments: DataFrame,
    installed: DataFrame,
    index: DataFrame,
    daily: DataFrame,
    a: Anchors,
    weighting: str = "none",
) -> DataFrame:
    """Class and index-adjusted amount of the label month per owner and establishment.

    The adjustment is the lowest index over the install months of the
    establishment's terminals. ``weighting="rows"`` counts the amount once per
    installed terminal instead of once.
    """
    if weighting not in ("none", "rows"):
        raise ValueError(f"unknown weighting {weighting!r}")
    key = F.col(ESTABLISHMENT).cast("decimal(18,0)")
    terminals = (
        with_index(
            installed.select(
                "cuit", establishment_number(CONTRACT_ESTABLISHMENT).alias("__est"), INSTALL
            ),
            INSTALL,
            index,
        )
        .groupBy(F.col("cuit").alias("cuit_establecimiento_host"), "__est")
        .agg(F.min("indice").alias("indice"), F.count(F.lit(1)).alias("__n"))
    )
    volume = month_volume(daily, a).select(key.alias("__est"), "suma_monto")
    joined = (
        establishments.withColumn("__est", key)
        .join(terminals, ["cuit_establecimiento_host", "__est"], "left")
        .join(volume, "__est", "left")
    )
    amount = F.col("suma_monto")
    if weighting == "rows":
        amount = amount * F.coalesce(F.col("__n"), F.lit(1))
    return joined.withColumn("monto_max", inflate(amount, "indice")).select(
        "cuit_establecimiento_host",
        ESTABLISHMENT,
        label_class(F.col("monto_max")).alias("nivel_activacion"),
        "monto_max",
    )


def owner_label(labels: DataFrame) -> DataFrame:
    """Highest class and amount per owner."""
    return labels.groupBy("cuit_establecimiento_host").agg(
        F.max("nivel_activacion").alias("clase"), F.max("monto_max").alias("monto_terminal")
    )
