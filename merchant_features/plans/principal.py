"""Principal-establishment feature table: attributes, per-terminal activity, activation."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_features.functions.periods import MONTHS, Anchors, anchors, with_period
from merchant_features.operators import activation as A
from merchant_features.operators import universe as U
from merchant_features.operators.activity import (
    AUTH_DAY,
    ESTABLISHMENT,
    acquiring_days,
    establishment_days,
    of_known_establishments,
    per_unit_measures,
    terminals_per,
    trailing_months_deflated,
)
from merchant_features.operators.address import latest_unified_addresses
from merchant_features.operators.contracts import cast_to_schema, fill_numeric
from merchant_features.plans.shared import Shared, prepare_shared
from merchant_features.sources.storage import materialize
from merchant_features.sources.tables import PRINCIPAL_SOURCES, narrow

MEASURES = [f"{m}_m{i}" for i in range(1, MONTHS + 1) for m in ("cant", "vol")]
TRANSACTION_MEASURES = {m: m.replace("_m", "_txs_m") for m in MEASURES}

# Names and types of the attribute part of the output.
ATTRIBUTE_TYPES = {
    "cuit_establecimiento_host_ref": "string",
    "nro_establecimiento_ref": "int",
    "cod_rubro": "string",
    "desc_rubro": "string",
    "nombre_fantasia": "string",
    "beneficiario_host": "string",
    "cod_estado_establecimiento": "string",
    "desc_estado_establecimiento": "string",
    "nivel_seguridad_moto_ecom": "string",
    "bandera": "int",
    "nombre_calle": "string",
    "numero_calle": "string",
    "codigo_postal": "string",
    "cod_localidad": "int",
    "localidad": "string",
    "cod_provincia": "string",
    "desc_provincia": "string",
    "direccion": "string",
    "desc_departamento_geo": "string",
    "desc_provincia_geo": "string",
    "latitud": "float",
    "longitud": "float",
}
MEASURE_TYPES = {
    name: "int" if name.startswith("cant") else "float" for name in TRANSACTION_MEASURES.values()
} | dict.fromkeys(
    ("avg_terminales_nivel_0", "avg_terminales_nivel_1", "avg_dias_1tx", "avg_dias_85000"), "float"
)


@dataclass(frozen=True)
class Universe:
    """Latest establishments, where they are, and the terminals they own.

    ``members`` has owner, establishment, terminal and whether the
    establishment has activity; ``activity`` is daily per establishment.
    """

    fields: DataFrame
    located: DataFrame
    members: DataFrame
    activity: DataFrame


def build_universe(
    tables: Mapping[str, DataFrame], summary: DataFrame, weighting: str = "none"
) -> Universe:
    """The relations that several features start from, each written once."""
    history = tables["establishment_history"]
    days = establishment_days(summary)
    fields = materialize(
        U.with_active_flag(
            U.establishment_fields(history, tables["establishment_states"], tables["categories"]), days
        )
    )
    addresses = latest_unified_addresses(fields, tables["address_history"], tables["provinces"])
    known = history if weighting == "rows" else fields
    terminals = U.terminal_universe(tables["terminal_history"])
    return Universe(
        fields=fields,
        located=U.located_establishments(fields, addresses, tables["geo_location"]),
        members=materialize(U.owned_terminals(fields, terminals)),
        activity=of_known_establishments(days, known, weighting),
    )


def per_terminal_activity(
    universe: Universe, index: DataFrame, date_ref: date, weighting: str = "none"
) -> DataFrame:
    """Deflated monthly activity per distinct terminal of every universe establishment.

    ``weighting="rows"`` multiplies it by the establishment's number of rows in
    the reference universe, as a sum over that universe does.
    """
    months = trailing_months_deflated(
        universe.activity,
        ESTABLISHMENT,
        AUTH_DAY,
        {"cant": "cantidad_transacciones"},
        {"vol": "volumen_transacciones"},
        index,
        date_ref,
    )
    joined = terminals_per(universe.members, ESTABLISHMENT).join(months, ESTABLISHMENT, "left")
    rated = per_unit_measures(joined, MEASURES, "cant_term")
    factor = F.lit(1)
    if weighting == "rows":
        rated = rated.join(U.row_weights(universe.members, universe.located), ESTABLISHMENT)
        factor = F.col("n_rows")
    elif weighting != "none":
        raise ValueError(f"unknown weighting {weighting!r}")
    return rated.select(
        F.col(ESTABLISHMENT).alias(U.REF),
        *[(F.col(m) * factor).alias(name) for m, name in TRANSACTION_MEASURES.items()],
    )


@dataclass(frozen=True)
class Installs:
    """Installs of the scan window and what the terminals did afterwards."""

    installs: DataFrame
    outcomes: DataFrame


def build_installs(
    installed: DataFrame, summary: DataFrame, index: DataFrame, a: Anchors
) -> Installs:
    installs = materialize(A.installs_in_window(installed, a))
    outcomes = A.install_outcomes(installs, acquiring_days(summary), index, a)
    return Installs(installs, materialize(outcomes))


def reference_levels(universe: Universe, installs: Installs, weighting: str = "none") -> DataFrame:
    """Terminals at activation level 0 and 1 per reference establishment, over its paired ones.

    ``weighting="rows"`` multiplies the counts by the number of paired
    establishments, as the join of ids and levels on the reference alone does.
    """
    levels = ("terminales_nivel_0", "terminales_nivel_1")
    counts = A.level_counts(A.activation_levels(installs.installs, installs.outcomes))
    owned = (
        universe.fields.select(U.OWNER, ESTABLISHMENT)
        .withColumn("__est", F.col(ESTABLISHMENT).cast("decimal(18,0)"))
        .join(
            counts.select(
                F.col("cuit").alias(U.OWNER), F.col(ESTABLISHMENT).alias("__est"), *levels
            ),
            [U.OWNER, "__est"],
            "left",
        )
    )
    weights = materialize(
        owned.select(ESTABLISHMENT, *levels, F.lit(1).cast("bigint").alias("pairs"))
    )
    sums = U.paired_sums(universe.members, weights, [*levels, "pairs"])
    if weighting not in ("none", "rows"):
        raise ValueError(f"unknown weighting {weighting!r}")
    factor = F.col("pairs") if weighting == "rows" else F.lit(1)
    return sums.select(
        U.REF, *[(F.col(n) * factor).cast("double").alias(f"avg_{n}") for n in levels]
    )


def reference_days(universe: Universe, installs: Installs) -> DataFrame:
    """Mean days to activation of the owner's terminals, per reference establishment."""
    days = materialize(A.owner_days(installs.installs, installs.outcomes))
    members = universe.members.select(ESTABLISHMENT, U.OWNER).distinct()
    return members.join(days.withColumnRenamed("cuit", U.OWNER), U.OWNER).select(
        F.col(ESTABLISHMENT).alias(U.REF), "avg_dias_1tx", "avg_dias_85000"
    )


def principal_features(
    tables: Mapping[str, DataFrame], date_ref: date, weighting: str = "none", shared: Shared | None = None,
    **installed_options,
) -> DataFrame:
    """One row per owner, establishment and location with activity and activation features.

    ``shared`` is given where the label table is built from the same tables too.
    """
    a = anchors(date_ref)
    tables = narrow(tables, PRINCIPAL_SOURCES, date_ref)
    index = tables["inflation_index"]
    shared = shared or prepare_shared(tables, date_ref, **installed_options)
    universe = build_universe(tables, shared.summary, weighting)
    installs = build_installs(shared.installed, shared.summary, index, a)
    # Every side below has one row per establishment; they meet before the located rows.
    ids = universe.members.select(F.col(ESTABLISHMENT).alias(U.REF)).distinct()
    stats = (
        ids.join(per_terminal_activity(universe, index, date_ref, weighting), U.REF, "left")
        .join(reference_levels(universe, installs, weighting), U.REF, "left")
        .join(reference_days(universe, installs), U.REF, "left")
    )
    joined = universe.located.withColumnsRenamed({ESTABLISHMENT: U.REF, U.OWNER: U.OWNER_REF}).join(
        stats, U.REF
    )
    typed = cast_to_schema(fill_numeric(joined, columns=list(MEASURE_TYPES)), ATTRIBUTE_TYPES | MEASURE_TYPES)
    return with_period(typed.distinct(), date_ref)
