"""Model table: principal rows of a period with cohort, neighbour and label columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_features.functions.periods import MONTHS
from merchant_features.operators.cohorts import CATEGORY, with_cohort_stats
from merchant_features.operators.lookup import hot_keys, salted_join
from merchant_features.operators.neighbours import neighbour_stats
from merchant_features.operators.universe import OWNER, OWNER_REF

MONTH_MEASURES = [f"{m}_txs_m{i}" for i in range(1, MONTHS + 1) for m in ("cant", "vol")]
DAY_MEASURES = ["avg_dias_1tx", "avg_dias_85000"]
NEIGHBOUR_MEASURES = [f"{m}_m{i}" for i in range(1, MONTHS + 1) for m in ("cant", "vol")]
NEIGHBOUR_KM = 5.0


def geo_features(establishments: DataFrame, km: float = NEIGHBOUR_KM, **options) -> DataFrame:
    """Mean monthly activity of the other owners' establishments near each owner's places."""
    stats = neighbour_stats(establishments, OWNER, NEIGHBOUR_MEASURES, km, **options)
    return stats.select(
        OWNER,
        *[F.col(f"{m}_geo").alias(f"{m.replace('_m', '_txs_m')}_geo") for m in NEIGHBOUR_MEASURES],
    )


def model_columns() -> list[str]:
    columns = [OWNER_REF, "id_periodo_analisis", CATEGORY]
    columns += [f"{m}_{cohort}" for cohort in ("rubro", "prov", "rubro_prov") for m in MONTH_MEASURES]
    columns += [
        f"{m}_{cohort}" for cohort in ("rubro", "prov", "rubro_prov", "loc_prov") for m in DAY_MEASURES
    ]
    columns += [f"{m}_geo" for m in MONTH_MEASURES]
    return [*columns, "monto_terminal", "clase"]


def model_table(
    principal: DataFrame, target: DataFrame, establishments: DataFrame, km: float = NEIGHBOUR_KM
) -> DataFrame:
    """One row per principal row; all three inputs hold the same analysis period."""
    needed = principal.select(
        OWNER_REF,
        "id_periodo_analisis",
        CATEGORY,
        "cod_provincia",
        "cod_localidad",
        *MONTH_MEASURES,
        *DAY_MEASURES,
    )
    enriched = with_cohort_stats(needed, MONTH_MEASURES, DAY_MEASURES)
    label = target.select(F.col(OWNER).alias(OWNER_REF), "clase", "monto_terminal")
    geo = geo_features(establishments, km).withColumnRenamed(OWNER, OWNER_REF)
    owners = label.join(geo, OWNER_REF, "full")
    # An owner may hold a third of all rows; the counts come from the narrow input.
    hot = hot_keys(principal, [OWNER_REF])
    return salted_join(enriched, owners, [OWNER_REF], hot=hot).select(*model_columns())
