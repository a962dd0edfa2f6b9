"""Establishment feature table: attributes per history version with trailing activity."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchant_features.functions.geo import sanitize_geo
from merchant_features.functions.periods import MONTHS, WEEKS, with_period
from merchant_features.operators.activity import ESTABLISHMENT, establishment_activity
from merchant_features.operators.address import ADDRESS_FIELDS, addresses_on_days, unified_addresses
from merchant_features.operators.contracts import cast_to_schema
from merchant_features.operators.lookup import lookup
from merchant_features.operators.universe import GEO_COLUMNS, OWNER, latest_establishments, with_location
from merchant_features.sources.storage import materialize
from merchant_features.sources.tables import ESTABLISHMENT_SOURCES, narrow

VERSION_DAY = "desde"
HISTORY_ATTRIBUTES = (
    "cod_rubro", "nombre_fantasia", "cod_estado_establecimiento", "cod_tipo_contrib_ganancias",
    "cod_tipo_iva", "cod_tipo_contrib_ing_brutos", "cod_ciclo_pago_estab",
    "cod_habilitacion_cuotas", "cod_banco", "cant_maxima_cuotas", "cod_devol_iva",
    "plataforma_alta", "bandera", "nivel_seguridad_moto_ecom",
)

# Code table -> key in the history, key in the table, added name, source column.
CODE_TABLES = (
    ("establishment_states", "cod_estado_establecimiento", "cd_estado_establecimiento",
     "desc_estado_establecimiento", "ds_estado_establecimiento"),
    ("categories", "cod_rubro", "cod_rubro", "desc_rubro", "desc_rubro"),
    ("income_tax_types", "cod_tipo_contrib_ganancias", "cod_tipo_contrib_ganancias",
     "desc_tipo_contrib_ganancias", "desc_tipo_contrib_ganancias"),
    ("vat_types", "cod_tipo_iva", "cod_tipo_iva", "desc_tipo_iva", "desc_tipo_iva"),
    ("turnover_tax_types", "cod_tipo_contrib_ing_brutos", "cod_tipo_contrib_ing_brutos",
     "desc_tipo_contrib_ing_brutos", "desc_tipo_contrib_ing_brutos"),
    ("payment_cycles", "cod_ciclo_pago_estab", "cod_ciclo_pago_estab",
     "desc_ciclo_pago_estab", "desc_ciclo_pago_estab"),
    ("instalment_plans", "cod_habilitacion_cuotas", "cod_habilitacion_cuotas",
     "desc_habilitacion_cuotas", "desc_habilitacion_cuotas"),
    ("banks", "cod_banco", "cod_banco", "desc_banco", "denominacion"),
)

# Names and types of the attribute part of the output.
ATTRIBUTE_TYPES = {
    "cuit_establecimiento_host": "string",
    "nro_establecimiento": "int",
    "cod_rubro": "string",
    "desc_rubro": "string",
    "nombre_fantasia": "string",
    "cod_estado_establecimiento": "string",
    "desc_estado_establecimiento": "string",
    "cod_tipo_contrib_ganancias": "string",
    "desc_tipo_contrib_ganancias": "string",
    "cod_tipo_iva": "string",
    "desc_tipo_iva": "string",
    "cod_tipo_contrib_ing_brutos": "string",
    "desc_tipo_contrib_ing_brutos": "string",
    "cod_ciclo_pago_estab": "int",
    "desc_ciclo_pago_estab": "string",
    "cod_habilitacion_cuotas": "int",
    "desc_habilitacion_cuotas": "string",
    "cod_banco": "int",
    "desc_banco": "string",
    "cant_maxima_cuotas": "int",
    "cod_devol_iva": "int",
    "plataforma_alta": "string",
    "nombre_calle": "string",
    "numero_calle": "string",
    "codigo_postal": "string",
    "cod_localidad": "int",
    "nombre_localidad": "string",
    "cod_provincia": "string",
    "desc_provincia": "string",
    "direccion": "string",
    "latitud": "float",
    "longitud": "float",
    "desc_departamento_geo": "string",
    "desc_provincia_geo": "string",
    "desc_localidad_gba_geo": "string",
    "cd_bandera": "int",
    "tx_nivel_seguridad_moto_ecom": "string",
}
RENAMED = {
    "nombre_localidad": "localidad",
    "cd_bandera": "bandera",
    "tx_nivel_seguridad_moto_ecom": "nivel_seguridad_moto_ecom",
}
WINDOWS = [f"m{i}" for i in range(1, MONTHS + 1)] + [f"w{i}" for i in range(1, WEEKS + 1)]
MEASURE_TYPES = {
    f"{measure}_{window}": dtype
    for window in WINDOWS
    for measure, dtype in (("cant", "int"), ("vol", "float"), ("cant_usd", "int"), ("vol_usd", "float"))
}


def establishment_base(history: DataFrame) -> DataFrame:
    """Owner of the latest version of every establishment in the window."""
    return latest_establishments(history, [OWNER])


def _versions(tables: Mapping[str, DataFrame], *more: Column) -> DataFrame:
    """Distinct attributes of the history versions with their code names."""
    versions = tables["establishment_history"].select(ESTABLISHMENT, *HISTORY_ATTRIBUTES, *more).distinct()
    for table, key, table_key, name, source in CODE_TABLES:
        names = tables[table].select(table_key, source).distinct()
        versions = lookup(versions, names, {key: table_key}, {name: source})
    return versions


def _places(tables: Mapping[str, DataFrame], current_addresses_only: bool) -> DataFrame:
    """Distinct owner, address and location of every establishment."""
    base = materialize(establishment_base(tables["establishment_history"]))
    addresses = unified_addresses(
        base, tables["address_history"], tables["provinces"], current_addresses_only
    )
    return with_location(base, addresses, tables["geo_location"]).distinct()


def establishment_universe(
    tables: Mapping[str, DataFrame], current_addresses_only: bool = False, places: str = "all"
) -> DataFrame:
    """Every distinct history version with code names, addresses and location.

    Versions and places are each reduced to distinct rows before they meet, so
    their combinations need no further DISTINCT. With ``places="dated"`` a
    version meets one place only, that of the day it starts on, which the column
    ``desde`` holds: the rows grow with the versions, not with the product.
    """
    if places == "dated":
        return _dated_universe(tables)
    if places != "all":
        raise ValueError(f"unknown places {places!r}")
    located = materialize(_places(tables, current_addresses_only))
    return _versions(tables).join(located, ESTABLISHMENT)


def _dated_universe(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every version once per day it starts on (``desde``), with the place of that day."""
    start = F.to_date("fecha_inicio").alias(VERSION_DAY)
    versions = materialize(_versions(tables, start))
    days = versions.select(ESTABLISHMENT, VERSION_DAY).distinct()
    places = addresses_on_days(days, tables["address_history"], tables["provinces"], VERSION_DAY)
    # locations carry no dates: one of them, the same on every day
    columns = [F.col(c) for c in GEO_COLUMNS]
    location = tables["geo_location"].groupBy(ESTABLISHMENT).agg(F.min(F.struct(*columns)).alias("geo")).select(
        ESTABLISHMENT, "geo.*"
    )
    base = establishment_base(tables["establishment_history"])
    owned = versions.join(base, ESTABLISHMENT)
    on_day = [F.col(f"v.{c}").eqNullSafe(F.col(f"p.{c}")) for c in (ESTABLISHMENT, VERSION_DAY)]
    placed = owned.alias("v").join(places.alias("p"), on_day, "left").select("v.*", *[F.col(f"p.{c}") for c in ADDRESS_FIELDS])
    located = lookup(placed, location, ESTABLISHMENT, GEO_COLUMNS)
    return located.withColumns(sanitize_geo("desc_provincia"))


def establishment_features(
    tables: Mapping[str, DataFrame],
    date_ref: date,
    weighting: str = "none",
    current_addresses_only: bool = False,
    places: str = "all",
) -> DataFrame:
    """Establishment attributes with 12 monthly and 4 weekly counts and volumes.

    ``weighting="rows"`` multiplies the activity by the establishment's number
    of universe rows (versions times places), as a join before the sum would.
    The activity joins the places, and the versions join last: that one join
    has a written table on one side and a shuffle on the other, the form in
    which adaptive execution splits an establishment with very many versions.
    With ``places="dated"`` a version has one row per day it starts on, with the
    place of that day (``weighting="rows"`` is of the product only).
    """
    if weighting not in ("none", "rows") or (weighting == "rows" and places != "all"):
        raise ValueError(f"unknown weighting {weighting!r}")
    tables = narrow(tables, ESTABLISHMENT_SOURCES, date_ref)
    activity = establishment_activity(tables["movements"], date_ref)
    if places == "dated":
        rows = establishment_universe(tables, places=places).join(materialize(activity), ESTABLISHMENT, "left")
        kinds = {VERSION_DAY: "date"} | ATTRIBUTE_TYPES | MEASURE_TYPES
        return with_period(cast_to_schema(rows, kinds, rename=RENAMED, defaults=dict.fromkeys(MEASURE_TYPES, 0)), date_ref)
    versions = _versions(tables)
    places = _places(tables, current_addresses_only)
    if weighting == "rows":
        places = materialize(places)
        n_places = places.groupBy(ESTABLISHMENT).agg(F.count(F.lit(1)).alias("__places"))
        n_versions = versions.groupBy(ESTABLISHMENT).agg(F.count(F.lit(1)).alias("__versions"))
        factor = F.col("__places") * F.col("__versions")
        activity = (
            activity.join(n_places, ESTABLISHMENT)
            .join(n_versions, ESTABLISHMENT)
            .select(ESTABLISHMENT, *[(F.col(m) * factor).alias(m) for m in MEASURE_TYPES])
        )
    located = materialize(places.join(activity, ESTABLISHMENT, "left"))
    typed = cast_to_schema(
        versions.join(located, ESTABLISHMENT),
        ATTRIBUTE_TYPES | MEASURE_TYPES,
        rename=RENAMED,
        defaults=dict.fromkeys(MEASURE_TYPES, 0),
    )
    return with_period(typed, date_ref)
