"""Addresses: one line per typed address, and the better of two address types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_features.functions.expressions import format_address, is_blank, province_code
from merchant_features.operators.history import current_versions, top1_per_key, valid_on_days
from merchant_features.operators.lookup import lookup
from merchant_features.sources.storage import materialize

ESTABLISHMENT = "nro_establecimiento"
ADDRESS_FIELDS = (
    "nombre_calle", "numero_calle", "codigo_postal", "cod_localidad", "localidad",
    "cod_provincia", "desc_provincia", "direccion",
)
# Codes of the preferred and the fallback address type.
PREFERRED_TYPE = "2"
FALLBACK_TYPE = "1"


def typed_addresses(
    addresses: DataFrame, provinces: DataFrame, *kinds: str, current_only: bool = False, kept: Sequence[str] = ()
) -> DataFrame:
    """Addresses of the given types with their province and the single-line form; ``kept`` names further columns."""
    rows = addresses.where(F.col("cod_tipo_direccion").isin(*kinds))
    if current_only:
        rows = current_versions(rows)
    rows = lookup(
        rows.withColumn("cod_region", province_code("cod_region_geografica_host")),
        provinces,
        {"cod_region": "cod_provincia"},
        ["cod_provincia", "desc_provincia"],
    )
    return rows.select(
        ESTABLISHMENT,
        "cod_tipo_direccion",
        F.coalesce("calle", F.lit("")).alias("nombre_calle"),
        F.coalesce("numero", F.lit("")).alias("numero_calle"),
        F.col("codigo_postal4").alias("codigo_postal"),
        "cod_localidad",
        F.col("nombre_localidad").alias("localidad"),
        "cod_provincia",
        "desc_provincia",
        format_address("calle", "numero", "nombre_localidad", "desc_provincia").alias("direccion"),
        "id_carga",
        *kept,
    )


def latest_addresses(typed: DataFrame) -> DataFrame:
    """The latest address of every establishment and type."""
    return top1_per_key(
        typed, [ESTABLISHMENT, "cod_tipo_direccion"], [F.col("id_carga").desc_nulls_last()]
    )


def fallback_record(
    base: DataFrame,
    primary: DataFrame,
    secondary: DataFrame,
    key: str,
    test: str,
    fields: Sequence[str],
) -> DataFrame:
    """For each base key the primary records, or all fields of the secondary where ``test`` is blank.

    Both sides may hold many records per key. The answer is the set of distinct
    records: a usable primary record stands for itself, and a key with an
    unusable one (or with none) takes its secondary records, NULLs if it has
    none. The two sides are never paired with each other.
    """
    primary = primary.select(key, *fields).distinct()
    secondary = secondary.select(key, *fields).distinct()
    keys = base.select(key).distinct()
    usable = keys.join(primary.where(~is_blank(test)), key)
    state = primary.groupBy(key).agg(F.max(is_blank(test)).alias("__has_blank"))
    lacking = (
        keys.join(state, key, "left").where(F.coalesce("__has_blank", F.lit(True))).select(key)
    )
    return usable.unionByName(lacking.join(secondary, key, "left")).distinct()


def unified_addresses(
    base: DataFrame, addresses: DataFrame, provinces: DataFrame, current_only: bool = False
) -> DataFrame:
    """All distinct preferred-or-fallback addresses of the base establishments."""
    typed = typed_addresses(
        addresses, provinces, PREFERRED_TYPE, FALLBACK_TYPE, current_only=current_only
    )
    known = materialize(typed.select("cod_tipo_direccion", ESTABLISHMENT, *ADDRESS_FIELDS).distinct())
    of_type = F.col("cod_tipo_direccion")
    return fallback_record(
        base,
        known.where(of_type == PREFERRED_TYPE),
        known.where(of_type == FALLBACK_TYPE),
        ESTABLISHMENT,
        "nombre_calle",
        ADDRESS_FIELDS,
    )


def latest_unified_addresses(
    base: DataFrame, addresses: DataFrame, provinces: DataFrame, current_only: bool = False
) -> DataFrame:
    """One preferred-or-fallback address per base establishment, each type at its latest version."""
    latest = latest_addresses(
        typed_addresses(addresses, provinces, PREFERRED_TYPE, FALLBACK_TYPE, current_only=current_only)
    )
    record = F.struct(*ADDRESS_FIELDS)
    sides = latest.groupBy(ESTABLISHMENT).agg(
        *[
            F.max(F.when(F.col("cod_tipo_direccion") == kind, record)).alias(name)
            for name, kind in (("primary", PREFERRED_TYPE), ("secondary", FALLBACK_TYPE))
        ]
    )
    chosen = F.when(is_blank("primary.nombre_calle"), F.col("secondary")).otherwise(F.col("primary"))
    return (
        base.select(ESTABLISHMENT)
        .distinct()
        .join(sides.select(ESTABLISHMENT, chosen.alias("chosen")), ESTABLISHMENT, "left")
        .select(ESTABLISHMENT, *[F.col(f"chosen.{c}").alias(c) for c in ADDRESS_FIELDS])
    )


def addresses_on_days(days: DataFrame, addresses: DataFrame, provinces: DataFrame, day: str) -> DataFrame:
    """The one address of every establishment and day of ``days``: preferred if it names a street, else fallback."""
    typed = typed_addresses(addresses, provinces, PREFERRED_TYPE, FALLBACK_TYPE, kept=["fecha_fin"])
    kind = F.col("cod_tipo_direccion")
    found = valid_on_days(
        days, typed, ESTABLISHMENT, day, "fecha_fin", {"primary": kind == PREFERRED_TYPE, "secondary": kind == FALLBACK_TYPE},
        ADDRESS_FIELDS, "id_carga",
    )
    chosen = F.when(is_blank("primary.nombre_calle"), F.col("secondary")).otherwise(F.col("primary"))
    return found.select(ESTABLISHMENT, day, chosen.alias("chosen")).select(
        ESTABLISHMENT, day, *[F.col(f"chosen.{c}").alias(c) for c in ADDRESS_FIELDS]
    )
