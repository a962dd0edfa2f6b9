"""Trailing windows kept up to date by monthly states.

A month's state holds each establishment's sums over the month and over its last
weeks. States are written once, when a run first needs the month, and merged by
adding: a monthly run reads the facts of the new month alone and twelve states,
which have one row per establishment and month, instead of a year of facts.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchant_features.functions import predicates as P
from merchant_features.functions.columns import ColumnLike, as_column
from merchant_features.functions.periods import MONTHS, WEEKS, anchors
from merchant_features.operators.activity import ESTABLISHMENT, movement_measures, valid_movements
from merchant_features.sources import manifests

MONTH = "mes"


def months_before(date_ref: date, months: int = MONTHS) -> list[date]:
    """First days of the trailing months, the latest first."""
    last = anchors(date_ref).lastday
    index = last.year * 12 + last.month - 1
    return [date((index - i) // 12, (index - i) % 12 + 1, 1) for i in range(months)]


def _next(month: date) -> date:
    return date(month.year + month.month // 12, month.month % 12 + 1, 1)


def month_states(
    facts: DataFrame, key: str, day: str, measures: Mapping[str, ColumnLike], months: Collection[date], weeks: int = WEEKS
) -> DataFrame:
    """Per key and month, the sums over the month (``{measure}``) and its last weeks (``{measure}_w{i}``).

    Only the given months are read; weeks count back from the month's last day.
    """
    inside = None
    for month in sorted(months):
        test = (F.col(day) >= F.lit(month)) & (F.col(day) < F.lit(_next(month)))
        inside = test if inside is None else inside | test
    date_of = F.to_date(day)
    rows = facts.where(inside).select(
        key, F.date_format(date_of, "yyyy-MM").alias(MONTH),
        (F.floor(F.datediff(F.last_day(date_of), date_of) / 7) + 1).alias("__week"),
        *[as_column(m).alias(name) for name, m in measures.items()],
    )

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    return rows.groupBy(key, MONTH).agg(
        *[total(F.col(name)).alias(name) for name in measures],
        *[
            total(F.when(F.col("__week") == i, F.col(name))).alias(f"{name}_w{i}")
            for i in range(1, weeks + 1) for name in measures
        ],
    )


class States:
    """Monthly states under one path; a month's newest committed version counts."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> dict[str, int]:
        """Month -> newest version."""
        found: dict[str, int] = {}
        for name in manifests.committed(self.spark, f"{self.path}/manifests"):
            month, _, version = name.rpartition(".")
            found[month] = max(int(version), found.get(month, 0))
        return found

    def write(self, states: DataFrame, months: Collection[date]) -> None:
        """Write the states of some months and commit each; a month without rows is committed too."""
        folder = f"{self.path}/states/{uuid.uuid4().hex}"
        states.write.partitionBy(MONTH).parquet(folder)
        known = self.versions()
        for month in months:
            name = f"{month:%Y-%m}"
            manifests.commit(
                self.spark, f"{self.path}/manifests", f"{name}.{known.get(name, 0) + 1}", {"folder": folder, "month": name}
            )

    def read(self, months: Collection[date], like: DataFrame) -> DataFrame:
        """The committed states of the months, with the columns of ``like``."""
        versions = self.versions()
        parts: dict[str, list[str]] = {}
        for month in months:
            name = f"{month:%Y-%m}"
            told = manifests.content(self.spark, f"{self.path}/manifests", f"{name}.{versions[name]}")
            parts.setdefault(told["folder"], []).append(name)
        frames = [
            self.spark.read.schema(like.schema).parquet(folder).where(F.col(MONTH).isin(names)).select(*like.columns)
            for folder, names in parts.items()
        ]
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame)
        return out


def rolling_features(
    facts: DataFrame,
    key: str,
    day: str,
    measures: Mapping[str, ColumnLike],
    date_ref: date,
    path: str,
    months: int = MONTHS,
    weeks: int = WEEKS,
    restated: Collection[date] = (),
) -> DataFrame:
    """The rows of ``activity.trailing_features`` from monthly states under ``path``.

    Months without a state are computed from ``facts`` and written; ``restated``
    names first days of months to compute again, because their facts changed.
    """
    spark = facts.sparkSession
    store = States(spark, path)
    wanted = months_before(date_ref, months)
    known = store.versions()
    missing = [m for m in wanted if f"{m:%Y-%m}" not in known or m in restated]
    # the shape of a state, without running anything
    like = month_states(facts, key, day, measures, wanted[:1], weeks)
    if missing:
        store.write(month_states(facts, key, day, measures, missing, weeks).select(*like.columns), missing)
    names = list(measures)
    position = {f"{m:%Y-%m}": i for i, m in enumerate(wanted, 1)}
    kinds = {f.name: f.dataType for f in like.schema.fields}
    latest = next(iter(position))

    def merged(month: str, source: str, name: str) -> Column:
        total = F.sum(F.when(F.col(MONTH) == month, F.col(source)))
        return F.coalesce(total, F.lit(0)).cast(kinds[source]).alias(name)

    return store.read(wanted, like).groupBy(key).agg(
        *[merged(month, n, f"{n}_m{i}") for month, i in position.items() for n in names],
        *[merged(latest, f"{n}_w{i}", f"{n}_w{i}") for i in range(1, weeks + 1) for n in names],
    )


def rolling_activity(movements: DataFrame, date_ref: date, path: str, restated: Collection[date] = ()) -> DataFrame:
    """``activity.establishment_activity`` from monthly states under ``path``."""
    a = anchors(date_ref)
    valid = valid_movements(movements.where(P.in_range("fecha_movimiento", a.firstday, a.lastday)), a.firstday, a.lastday)
    return rolling_features(valid, ESTABLISHMENT, "fecha_movimiento", movement_measures(), date_ref, path, restated=restated)
