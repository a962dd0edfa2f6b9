"""Statistics of cohorts (category, province, locality) joined back to their members."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_features.operators.lookup import checked_lookup
from merchant_features.sources.storage import materialize

CATEGORY, PROVINCE, LOCALITY = "cod_rubro", "cod_provincia", "cod_localidad"

# Cohort suffix -> its keys. Fixed values of the output contract.
COHORTS = {
    "rubro": (CATEGORY,),
    "prov": (PROVINCE,),
    "rubro_prov": (CATEGORY, PROVINCE),
    "loc_prov": (LOCALITY, PROVINCE),
}
AGGREGATES = {"avg": F.avg, "sum": F.sum}


def cohort_stats(
    df: DataFrame, keys: Sequence[str], measures: Sequence[str], agg: str, suffix: str
) -> DataFrame:
    """Mean or sum of every measure per cohort, named ``{measure}_{suffix}``."""
    function = AGGREGATES[agg]
    return df.groupBy(*keys).agg(*[function(m).alias(f"{m}_{suffix}") for m in measures])


def all_cohort_stats(
    df: DataFrame,
    cohorts: Mapping[str, Sequence[str]],
    means: Sequence[str],
    sums: Sequence[str],
) -> DataFrame:
    """Means and sums of all cohorts from one scan, told apart by the column ``cohort``.

    Spark's grouping sets expand the rows below the partial aggregation, so a
    task sends one row per cohort it saw, however large the cohort is.
    """
    keys = list(dict.fromkeys(k for group in cohorts.values() for k in group))
    sets = [[F.col(k) for k in group] for group in cohorts.values()]
    grouped = df.groupingSets(sets, *[F.col(k) for k in keys]).agg(
        F.grouping_id().alias("__gid"),
        *[F.avg(m).alias(f"avg_of_{m}") for m in means],
        *[F.sum(m).alias(f"sum_of_{m}") for m in sums],
    )
    bits = {name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in group)
            for name, group in cohorts.items()}
    label = reduce(
        lambda expr, item: expr.when(F.col("__gid") == item[1], item[0]),
        list(bits.items())[1:],
        F.when(F.col("__gid") == next(iter(bits.values())), next(iter(bits))),
    )
    return grouped.withColumn("cohort", label).drop("__gid")


def with_cohort_stats(
    df: DataFrame,
    means: Sequence[str],
    sums: Sequence[str],
    cohorts: Mapping[str, Sequence[str]] = COHORTS,
    mean_cohorts: Sequence[str] = ("rubro", "prov", "rubro_prov"),
    max_broadcast_bytes: int | None = None,
) -> DataFrame:
    """Rows with the means and sums of their cohorts; a NULL key has no cohort.

    The statistics are written once and measured; each cohort table is broadcast
    if its bytes are few and joined with salted hot keys if it is not, because one
    province or category may hold a third of all rows.
    """
    stats = materialize(all_cohort_stats(df, cohorts, means, sums))
    options = {} if max_broadcast_bytes is None else {"max_bytes": max_broadcast_bytes}
    for name, keys in cohorts.items():
        columns = {f"sum_of_{m}": f"{m}_{name}" for m in sums}
        if name in mean_cohorts:
            columns |= {f"avg_of_{m}": f"{m}_{name}" for m in means}
        side = stats.where(F.col("cohort") == name).dropna(subset=list(keys)).select(
            *keys, *[F.col(source).alias(alias) for source, alias in columns.items()]
        )
        df = checked_lookup(df, side, keys, **options)
    return df
