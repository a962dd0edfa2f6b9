"""Parquet tables by logical name, narrowed and filtered at the scan."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchant_features.functions import predicates as P
from merchant_features.functions.periods import Anchors, anchors


@dataclass(frozen=True)
class SourceSpec:
    """A logical table: the columns the plans read and an optional scan filter."""

    name: str
    columns: tuple[str, ...] = ()
    where: Callable[[Anchors], Column] | None = None


def load_table(
    spark: SparkSession,
    path: str,
    spec: SourceSpec | None = None,
    date_ref: date | None = None,
    path_glob: str | None = None,
) -> DataFrame:
    """Read one Parquet directory; the filter and the column list reach the scan."""
    reader = spark.read
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    df = reader.parquet(path)
    if spec is None:
        return df
    check_source(df, spec)
    if spec.where is not None:
        if date_ref is None:
            raise ValueError(f"table {spec.name} is filtered by date: date_ref is required")
        df = df.where(spec.where(anchors(date_ref)))
    return df.select(*spec.columns) if spec.columns else df


def load_all(
    spark: SparkSession,
    paths: Mapping[str, str],
    specs: Iterable[SourceSpec],
    date_ref: date,
) -> dict[str, DataFrame]:
    """Read every table of a registry; ``paths`` maps logical names to directories."""
    specs = list(specs)
    missing = [s.name for s in specs if s.name not in paths]
    if missing:
        raise KeyError(f"no path for: {', '.join(missing)}")
    return {s.name: load_table(spark, paths[s.name], s, date_ref) for s in specs}


def narrow(tables: Mapping[str, DataFrame], specs: Iterable[SourceSpec], date_ref: date) -> dict[str, DataFrame]:
    """Apply a registry's filters and column lists to frames that are already open."""
    out = {}
    for spec in specs:
        df = tables[spec.name]
        if spec.where is not None:
            df = df.where(spec.where(anchors(date_ref)))
        out[spec.name] = df.select(*spec.columns) if spec.columns else df
    return out


#: Kinds of columns that a profile tells apart.
KINDS = (
    ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), "entero"), (T.DecimalType, "decimal"),
    ((T.FloatType, T.DoubleType), "real"), (T.StringType, "texto"), ((T.DateType, T.TimestampType, T.TimestampNTZType), "fecha"),
    (T.BooleanType, "logico"),
)


def kind_of(dtype: T.DataType) -> str:
    return next((name for types, name in KINDS if isinstance(dtype, types)), dtype.simpleString())


def _as_text(field: T.StructField) -> Column:
    """A value's text, the same in every engine: reals in millionths, dates without their time."""
    value = F.col(f"`{field.name}`")
    kind = kind_of(field.dataType)
    if kind == "real":
        return F.round(value.cast("double") * 1_000_000).cast("bigint").cast("string")
    if kind == "fecha":
        return F.to_date(value).cast("string")
    return value.cast("string")


def column_profile(df: DataFrame, table: str) -> DataFrame:
    """Per column: kind, rows, values that are known, and a checksum over all values that does not depend on their order.

    One scan and one row per task, however wide the table is.
    """
    fields = df.schema.fields
    sums = []
    for k, field in enumerate(fields):
        text = _as_text(field)
        digest = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("decimal(20,0)")
        sums += [F.count(text).alias(f"known_{k}"), F.coalesce(F.sum(digest), F.lit(0)).cast("decimal(38,0)").alias(f"sum_{k}")]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *sums)
    profiles = [
        F.struct(
            F.lit(field.name).alias("columna"), F.lit(kind_of(field.dataType)).alias("tipo"), F.col("rows").alias("filas"),
            F.col(f"known_{k}").alias("conocidos"), F.col(f"sum_{k}").cast("string").alias("suma"),
        )
        for k, field in enumerate(fields)
    ]
    return row.select(F.lit(table).alias("tabla"), F.explode(F.array(*profiles)).alias("p")).select("tabla", "p.*")


class SourceMismatch(ValueError):
    """A source lacks columns of its registry entry, or has them in other kinds."""


def check_source(df: DataFrame, spec: SourceSpec, kinds: Mapping[str, str] | None = None) -> None:
    """Compare a source's columns, and their kinds where given, with its registry entry before anything is read."""
    given = {f.name: kind_of(f.dataType) for f in df.schema.fields}
    missing = [c for c in spec.columns if c not in given]
    if missing:
        raise SourceMismatch(f"{spec.name} lacks: {', '.join(missing)}")
    other = {c: given[c] for c, kind in (kinds or {}).items() if c in given and given[c] != kind}
    if other:
        raise SourceMismatch(f"{spec.name} has other kinds: {', '.join(f'{c} {k}' for c, k in sorted(other.items()))}")


def write_features(df: DataFrame, path: str, partitions: int | None = None) -> None:
    """Overwrite a snappy Parquet directory, optionally with a set number of files."""
    out = df.repartition(partitions) if partitions else df
    out.write.mode("overwrite").option("compression", "snappy").parquet(path)


def _history_filter(a: Anchors) -> Column:
    return P.valid_in_window("fecha_inicio", "fecha_fin", a.firstday, a.lastday)


def _terminal_filter(a: Anchors) -> Column:
    return P.valid_in_window("fecha_inicio", "fecha_fin", a.firstday, a.lastday, null_is_open=True)


# Source tables with the columns that are read, as the inputs name them.
AUTHORISATIONS = SourceSpec(
    "authorisations",
    (
        "nro_terminal", "nro_establecimiento_orig", "fecha_host_entrada_autoriz",
        "cod_respuesta_autorizacion", "cod_tipo_mensaje_autoriz", "nro_autorizacion",
        "monto_autoriz_moneda_orig", "programa_periferia_origen", "datos_adicionales_2",
    ),
    lambda a: P.in_range("fecha_host_entrada_autoriz", a.firstday, a.lastday),
)
MOVEMENTS = SourceSpec(
    "movements",
    (
        "fecha_movimiento", "nro_establecimiento", "cod_tipo_operacion",
        "monto_movimiento", "monto_movimiento_origen",
    ),
    lambda a: P.in_range("fecha_movimiento", a.firstday, a.lastday),
)
ESTABLISHMENT_HISTORY = SourceSpec(
    "establishment_history",
    (
        "cuit_establecimiento_host", "nro_establecimiento", "id_carga", "cod_rubro",
        "nombre_fantasia", "cod_estado_establecimiento", "cod_tipo_contrib_ganancias",
        "cod_tipo_iva", "cod_tipo_contrib_ing_brutos", "cod_ciclo_pago_estab",
        "cod_habilitacion_cuotas", "cod_banco", "cant_maxima_cuotas", "cod_devol_iva",
        "plataforma_alta", "bandera", "beneficiario_host", "nivel_seguridad_moto_ecom",
        "fecha_inicio", "fecha_fin", "fecha_alta",
    ),
    _history_filter,
)
ADDRESS_HISTORY = SourceSpec(
    "address_history",
    (
        "nro_establecimiento", "fecha_fin", "calle", "numero", "codigo_postal4",
        "cod_localidad", "nombre_localidad", "cod_tipo_direccion",
        "cod_region_geografica_host", "id_carga",
    ),
)
TERMINAL_HISTORY = SourceSpec(
    "terminal_history",
    ("nro_establecimiento", "nro_terminal", "fecha_inicio", "fecha_fin"),
    _terminal_filter,
)
GEO_LOCATION = SourceSpec(
    "geo_location",
    (
        "nro_establecimiento", "latitud", "longitud", "desc_departamento_geo",
        "desc_provincia_geo", "desc_localidad_gba_geo",
    ),
)
PROVINCES = SourceSpec("provinces", ("cod_provincia", "desc_provincia"))
CATEGORIES = SourceSpec("categories", ("cod_rubro", "desc_rubro"))
ESTABLISHMENT_STATES = SourceSpec(
    "establishment_states", ("cd_estado_establecimiento", "ds_estado_establecimiento")
)
INCOME_TAX_TYPES = SourceSpec(
    "income_tax_types", ("cod_tipo_contrib_ganancias", "desc_tipo_contrib_ganancias")
)
VAT_TYPES = SourceSpec("vat_types", ("cod_tipo_iva", "desc_tipo_iva"))
TURNOVER_TAX_TYPES = SourceSpec(
    "turnover_tax_types", ("cod_tipo_contrib_ing_brutos", "desc_tipo_contrib_ing_brutos")
)
PAYMENT_CYCLES = SourceSpec("payment_cycles", ("cod_ciclo_pago_estab", "desc_ciclo_pago_estab"))
INSTALMENT_PLANS = SourceSpec(
    "instalment_plans", ("cod_habilitacion_cuotas", "desc_habilitacion_cuotas")
)
BANKS = SourceSpec("banks", ("cod_banco", "denominacion"))
INFLATION_INDEX = SourceSpec("inflation_index", ("periodo", "indice"))
TERMINALS = SourceSpec(
    "terminals",
    ("id_terminal", "cprefijo", "cnumeroterminal", "contratoestablecimiento_id", "estadoterminal_id"),
)
STATE_LOG = SourceSpec("state_log", ("terminalid", "dfechalogging", "postestadoid"))
CONTRACTS = SourceSpec(
    "contracts",
    (
        "id_contratoestablecimiento", "ccuit", "cnumeroestablecimiento", "dfechacontrato",
        "ccontactotelefono", "cdomiciliocalle", "crazonsocial",
    ),
)
VIP_OWNERS = SourceSpec("vip_owners", ("nro_cuit",))
BILLING = SourceSpec(
    "billing",
    (
        "nro_terminal", "codigo_cargo", "nro_mes_cargo", "fecha_alta_terminal",
        "periodo_inicio_cargo", "periodo",
    ),
)
PHONES = SourceSpec("phones", ("nro_establecimiento", "ddn", "numero_telefono"))
TEMPLATES = SourceSpec(
    "templates",
    (
        "id_terminal", "fecha_parametrizacion", "plantilla_origen", "plantilla_destino",
        "version_origen", "medio", "marca", "plantilla_adecuada",
    ),
)
TERMINAL_MODELS = SourceSpec("terminal_models", ("id_terminal", "modelo"))

INSTALLED_BASE_SOURCES = (
    TERMINALS, STATE_LOG, CONTRACTS, VIP_OWNERS, BILLING, PHONES, TEMPLATES, TERMINAL_MODELS,
)
ESTABLISHMENT_SOURCES = (
    MOVEMENTS, ESTABLISHMENT_HISTORY, ADDRESS_HISTORY, GEO_LOCATION, PROVINCES, CATEGORIES,
    ESTABLISHMENT_STATES, INCOME_TAX_TYPES, VAT_TYPES, TURNOVER_TAX_TYPES, PAYMENT_CYCLES,
    INSTALMENT_PLANS, BANKS,
)
PRINCIPAL_SOURCES = (
    AUTHORISATIONS, ESTABLISHMENT_HISTORY, ADDRESS_HISTORY, TERMINAL_HISTORY, GEO_LOCATION,
    PROVINCES, CATEGORIES, ESTABLISHMENT_STATES, INFLATION_INDEX, *INSTALLED_BASE_SOURCES,
)
TARGET_SOURCES = (
    AUTHORISATIONS, ESTABLISHMENT_HISTORY, INFLATION_INDEX, *INSTALLED_BASE_SOURCES,
)
