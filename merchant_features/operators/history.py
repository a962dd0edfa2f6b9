"""Versioned history: latest or first version per key, versions valid on a date."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchant_features.functions.predicates import OPEN_END, is_current
from merchant_features.sources.storage import materialize


def top1_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], tiebreak: bool = True
) -> DataFrame:
    """One row per key: the first in ``order``; remaining columns break ties.

    Spark turns the rank filter into a group limit below the shuffle, so each
    task sends at most one row per key and a hot key costs one row per task.
    """
    ordering = list(order)
    if tiebreak:
        ordering += [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    ranked = df.withColumn(
        "__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering))
    )
    return ranked.where("__rank = 1").drop("__rank")


def current_versions(history: DataFrame, end: str = "fecha_fin") -> DataFrame:
    return history.where(is_current(end))


def normalize_sentinel(history: DataFrame, end: str = "fecha_fin") -> DataFrame:
    """The end as a date, with the open-end sentinel moved to 1900-01-01."""
    closed = F.to_date(F.col(end))
    sentinel = F.lit(OPEN_END)
    return history.withColumn(
        end, F.when(closed == sentinel, F.to_date(F.lit("1900-01-01"))).otherwise(closed)
    )


def valid_at_join(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    day: str,
    start: str = "fecha_inicio",
    end: str = "fecha_fin",
) -> DataFrame:
    """Facts with every history version of their key that is valid on the fact date.

    Equality on the key is the shuffle; the validity interval is a residual
    predicate. Aggregate the facts to key and day first.
    """
    other = history.withColumnRenamed(key, "__key")
    on = (
        (F.col(key) == F.col("__key"))
        & (F.to_date(F.col(start)) <= F.col(day))
        & ((F.to_date(F.col(end)) >= F.col(day)) | is_current(end))
    )
    return facts.join(other, on, "inner").drop("__key")


def valid_on_days(
    days: DataFrame, records: DataFrame, key: str, day: str, end: str, groups: Mapping[str, Column], fields: Sequence[str],
    newest: str,
) -> DataFrame:
    """Per distinct key and day of ``days``, the record of each group that is valid on that day, as a struct of ``fields``.

    Records carry the day they end on and follow each other, so the one valid on
    a day is the first to end on it or later, of several with one end that with
    the largest ``newest``. This is a sweep: days and ends of a key become one
    ordered list of events, and each day takes the last record seen on the way
    from the last event to the first. No day meets any other record.

    The sweep goes through one month of a key at a time. What a month hands on
    to earlier ones is one record per group, found by aggregation, so a key with
    very many days or records is spread over its months. A key or day that is
    NULL has no record; a record without an end is valid for ever.
    """
    names = list(groups)
    last = F.to_date(F.lit(OPEN_END))
    ends = records.where(F.col(key).isNotNull()).select(
        F.col(key).alias("__key"), F.coalesce(F.to_date(end), last).alias("__day"), F.lit(False).alias("__asked"),
        F.col(newest).alias("__newest"), *[F.when(test, F.struct(*fields)).alias(name) for name, test in groups.items()],
    )
    asked = days.select(F.col(key).alias("__key"), F.to_date(day).alias("__day")).distinct().withColumn("__asked", F.lit(True))
    events = asked.unionByName(ends, allowMissingColumns=True).withColumn("__month", F.trunc("__day", "MM"))
    events = materialize(events)

    rank = F.struct("__day", F.col("__newest").isNull().alias("none"), (-F.col("__newest")).alias("newest"))
    firsts = events.groupBy("__key", "__month").agg(
        *[F.min(F.when(F.col(n).isNotNull(), F.struct(rank.alias("rank"), F.col(n).alias("record")))).alias(n) for n in names]
    )
    later = Window.partitionBy("__key").orderBy("__month").rowsBetween(1, Window.unboundedFollowing)
    handed = firsts.select(
        "__key", "__month", *[F.first(F.col(n)["record"], ignorenulls=True).over(later).alias(f"__later_{n}") for n in names]
    )
    # from the end of the month back: records before the days they end on, the newest of one end last
    back = Window.partitionBy("__key", "__month").orderBy(
        F.col("__day").desc(), "__asked", F.col("__newest").asc_nulls_first(), *[F.col(n).desc_nulls_last() for n in names]
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = events.select("__key", "__month", "__day", "__asked", *[F.last(n, ignorenulls=True).over(back).alias(n) for n in names])
    found = swept.where("__asked").join(handed, ["__key", "__month"], "left")
    return found.select(
        F.col("__key").alias(key), F.col("__day").alias(day), *[F.coalesce(n, f"__later_{n}").alias(n) for n in names]
    )
