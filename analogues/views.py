"""Input tables of the plans, derived by Spark from the given Parquet tables.

Every view uses all rows of the tables it reads. ``s`` and ``l`` below are a
supplier key and a line number, which together name a terminal.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DATE_REF = date(2000, 7, 15)

SOURCES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def terminal_prefix(line: str) -> str:
    return (
        f"CASE {line} WHEN 1 THEN '07' WHEN 2 THEN '09' WHEN 3 THEN '13' WHEN 4 THEN '36' "
        f"WHEN 5 THEN '51' WHEN 6 THEN '08' ELSE '99' END"
    )


def serial(supplier: str) -> str:
    """At least six digits; longer keys keep all of theirs."""
    digits = f"CAST({supplier} AS STRING)"
    return f"lpad({digits}, greatest(6, length({digits})), '0')"


TERMINAL = f"concat({terminal_prefix('l_linenumber')}, {serial('l_suppkey')})"
PART_TERMINAL = (
    f"concat({terminal_prefix('CAST(p_partkey % 7 + 1 AS INT)')}, {serial('p_partkey DIV 7')})"
)
OPEN_END = "TIMESTAMP '9999-12-31 00:00:00'"


def read_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in SOURCES}


def _establishment_history(t: dict[str, DataFrame]) -> DataFrame:
    return t["orders"].join(t["customer"], t["orders"].o_custkey == t["customer"].c_custkey).selectExpr(
        "concat('T', o_custkey - o_custkey % 3) AS cuit_establecimiento_host",
        "o_custkey AS nro_establecimiento",
        "o_orderkey AS id_carga",
        "CASE WHEN c_acctbal >= 0 THEN substring(c_mktsegment, 1, 4) END AS cod_rubro",
        "c_name AS nombre_fantasia",
        "o_orderstatus AS cod_estado_establecimiento",
        "substring(o_orderpriority, 1, 1) AS cod_tipo_contrib_ganancias",
        "substring(o_orderpriority, 1, 1) AS cod_tipo_iva",
        "substring(c_mktsegment, 1, 1) AS cod_tipo_contrib_ing_brutos",
        "c_nationkey % 7 AS cod_ciclo_pago_estab",
        "c_nationkey % 5 AS cod_habilitacion_cuotas",
        "CASE WHEN c_acctbal <= 9000 THEN c_nationkey END AS cod_banco",
        "c_nationkey + 12 AS cant_maxima_cuotas",
        "c_nationkey % 3 AS cod_devol_iva",
        "concat(o_orderstatus, '-host') AS plataforma_alta",
        "c_nationkey % 4 + 1 AS bandera",
        "CASE WHEN o_orderstatus <> 'P' THEN concat('Benef ', o_orderpriority) END AS beneficiario_host",
        "concat('  ', o_orderstatus, ' ') AS nivel_seguridad_moto_ecom",
        "o_orderdate AS fecha_inicio",
        f"CASE WHEN o_orderstatus = 'O' THEN {OPEN_END} ELSE CAST(date_add(CAST(o_orderdate AS DATE), "
        "CAST(30 + o_orderkey % 700 AS INT)) AS TIMESTAMP) END AS fecha_fin",
        "CAST(o_orderdate AS DATE) AS fecha_alta",
    )


def _address_history(t: dict[str, DataFrame]) -> DataFrame:
    return t["orders"].join(t["customer"], t["orders"].o_custkey == t["customer"].c_custkey).selectExpr(
        "o_custkey AS nro_establecimiento",
        f"CASE WHEN o_orderstatus = 'O' THEN {OPEN_END} ELSE CAST(o_orderdate AS TIMESTAMP) END AS fecha_fin",
        "CASE WHEN o_orderstatus = 'P' THEN '' WHEN o_orderpriority = '3-MEDIUM' THEN NULL "
        "ELSE concat('Calle ', substring(o_orderpriority, 1, 1)) END AS calle",
        "CASE WHEN o_orderstatus = 'O' THEN concat(substring(o_orderpriority, 1, 1), '00') END AS numero",
        "CAST(1000 + c_nationkey AS STRING) AS codigo_postal4",
        "CASE WHEN c_acctbal >= 500 THEN CAST(1000 + o_custkey % 50 AS INT) END AS cod_localidad",
        "CASE WHEN c_nationkey % 5 = 0 THEN '' ELSE concat('Localidad ', o_custkey % 50) END AS nombre_localidad",
        "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '2' WHEN o_orderpriority = '5-LOW' "
        "THEN '3' ELSE '1' END AS cod_tipo_direccion",
        "concat(char(65 + c_nationkey), '01') AS cod_region_geografica_host",
        "o_orderkey AS id_carga",
    )


def _geo_location(t: dict[str, DataFrame]) -> DataFrame:
    return t["customer"].selectExpr(
        "c_custkey AS nro_establecimiento",
        "CASE WHEN c_acctbal <= 9800 THEN -34.6D + ((c_custkey * 7919) % 100003) / 200000.0D END AS latitud",
        "CASE WHEN c_acctbal <= 9800 THEN -58.4D + ((c_custkey * 104729) % 100003) / 200000.0D END AS longitud",
        "CASE c_nationkey % 3 WHEN 0 THEN concat('Comuna ', c_custkey % 15) "
        "WHEN 1 THEN concat('Partido ', c_custkey % 20) END AS desc_departamento_geo",
        "concat('Geo ', c_nationkey) AS desc_provincia_geo",
        "concat('GBA ', c_custkey % 50) AS desc_localidad_gba_geo",
    )


def _movements(t: dict[str, DataFrame]) -> DataFrame:
    return t["orders"].selectExpr(
        "o_orderdate AS fecha_movimiento",
        "o_custkey AS nro_establecimiento",
        "CASE o_orderstatus WHEN 'F' THEN '0005' WHEN 'O' THEN '0510' ELSE '0999' END AS cod_tipo_operacion",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS monto_movimiento",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS monto_movimiento_origen",
    )


def _authorisations(t: dict[str, DataFrame]) -> DataFrame:
    return t["lineitem"].selectExpr(
        f"{TERMINAL} AS nro_terminal",
        "l_suppkey AS nro_establecimiento_orig",
        "l_shipdate AS fecha_host_entrada_autoriz",
        "CASE l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 900 ELSE 7 + 93 * CAST(l_linestatus = 'F' AS INT) END "
        "AS cod_respuesta_autorizacion",
        "CASE WHEN l_tax > 0.075D THEN 1200 ELSE 1100 END AS cod_tipo_mensaje_autoriz",
        "CASE WHEN l_linestatus = 'O' THEN CAST(l_orderkey AS STRING) ELSE '  ' END AS nro_autorizacion",
        "CASE WHEN l_tax < 0.005D THEN CAST(0 AS DECIMAL(18,2)) WHEN l_tax < 0.015D THEN CAST(250 AS DECIMAL(18,2)) "
        "ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS monto_autoriz_moneda_orig",
        "CASE WHEN l_discount > 0.095D THEN 19500 ELSE 515000 + CAST(l_quantity AS INT) * 1000 END "
        "AS programa_periferia_origen",
        "concat('AA', CASE WHEN l_discount < 0.025D THEN 'W' WHEN l_discount < 0.045D THEN 'G' "
        "WHEN l_discount < 0.065D THEN 'E' WHEN l_discount < 0.085D THEN 'D' ELSE 'X' END, '0000') "
        "AS datos_adicionales_2",
    )


def _terminal_history(t: dict[str, DataFrame]) -> DataFrame:
    spans = t["lineitem"].groupBy("l_suppkey", "l_linenumber", "l_returnflag").agg(
        F.min("l_shipdate").alias("first_day"), F.max("l_shipdate").alias("last_day")
    )
    return spans.selectExpr(
        "CASE WHEN l_returnflag = 'R' THEN l_suppkey - l_suppkey % 3 ELSE l_suppkey END AS nro_establecimiento",
        f"{TERMINAL} AS nro_terminal",
        "CAST(first_day AS DATE) AS fecha_inicio",
        "CASE WHEN l_returnflag <> 'N' THEN CAST(last_day AS DATE) END AS fecha_fin",
    )


def _inflation_index(t: dict[str, DataFrame]) -> DataFrame:
    months = t["orders"].selectExpr(
        "CAST(year(o_orderdate) AS INT) AS y", "CAST(month(o_orderdate) AS INT) AS m"
    )
    return months.distinct().selectExpr(
        "y * 100 + m AS periodo", "1.0D + 0.01D * ((y - 1995) * 12 + m - 1) AS indice"
    )


def _terminals(t: dict[str, DataFrame]) -> DataFrame:
    return t["lineitem"].select("l_suppkey", "l_linenumber").distinct().selectExpr(
        "l_suppkey * 10 + l_linenumber AS id_terminal",
        f"concat({terminal_prefix('l_linenumber')}, '00') AS cprefijo",
        f"{serial('l_suppkey')} AS cnumeroterminal",
        "l_suppkey AS contratoestablecimiento_id",
        "l_linenumber AS estadoterminal_id",
    )


def _state_log(t: dict[str, DataFrame]) -> DataFrame:
    return t["lineitem"].selectExpr(
        "l_suppkey * 10 + l_linenumber AS terminalid",
        "date_add(DATE '1999-05-20', CAST((l_suppkey * 37 + l_linenumber * 53) % 420 AS INT) "
        "+ CAST(l_quantity AS INT) % 5) AS dfechalogging",
        "CAST(l_quantity AS INT) AS postestadoid",
    )


def _contracts(t: dict[str, DataFrame]) -> DataFrame:
    return t["supplier"].selectExpr(
        "s_suppkey AS id_contratoestablecimiento",
        "concat('T', s_suppkey - s_suppkey % 3) AS ccuit",
        "CASE WHEN s_acctbal < 0 THEN 'S/N' ELSE CAST(s_suppkey AS STRING) END AS cnumeroestablecimiento",
        "date_add(DATE '1998-01-01', CAST((s_suppkey * 13) % 900 AS INT)) AS dfechacontrato",
        "concat('011-', s_suppkey) AS ccontactotelefono",
        "concat('Av ', s_nationkey) AS cdomiciliocalle",
        "CASE WHEN s_acctbal >= 1000 THEN s_name END AS crazonsocial",
    )


def _billing(t: dict[str, DataFrame]) -> DataFrame:
    charges = t["lineitem"].groupBy("l_suppkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("charges"),
        F.to_date(F.min("l_shipdate")).alias("first_day"),
        F.to_date(F.max("l_shipdate")).alias("last_day"),
    )
    return charges.selectExpr(
        f"{TERMINAL} AS nro_terminal",
        "concat('C', l_linenumber) AS codigo_cargo",
        "charges AS nro_mes_cargo",
        "first_day AS fecha_alta_terminal",
        "year(first_day) * 100 + month(first_day) AS periodo_inicio_cargo",
        "year(last_day) * 100 + month(last_day) AS periodo",
    )


def _templates(t: dict[str, DataFrame]) -> DataFrame:
    return t["part"].selectExpr(
        f"{PART_TERMINAL} AS id_terminal",
        "date_add(DATE '2000-01-01', p_size) AS fecha_parametrizacion",
        "p_type AS plantilla_origen",
        "p_brand AS plantilla_destino",
        "CAST(p_size AS STRING) AS version_origen",
        "p_type AS medio",
        "p_brand AS marca",
        "CASE p_size % 5 WHEN 0 THEN 'Cambiar Equipo' WHEN 1 THEN 'Sin modelo' WHEN 3 THEN p_brand "
        "WHEN 4 THEN 'Brand#0' END AS plantilla_adecuada",
    )


def _codes(df: DataFrame, code: str, description: str, code_name: str, name: str) -> DataFrame:
    return df.selectExpr(f"{code} AS {code_name}", f"{description} AS {name}").distinct()


def _provinces(t: dict[str, DataFrame]) -> DataFrame:
    return t["nation"].selectExpr(
        "char(65 + n_nationkey) AS cod_provincia",
        "CASE n_nationkey WHEN 0 THEN 'BUENOS AIRES' WHEN 24 THEN NULL ELSE n_name END AS desc_provincia",
    )


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All logical input tables over the Parquet files of one directory."""
    t = read_tables(spark, sf_dir)
    priority, segment = "substring(o_orderpriority, 1, 1)", "substring(c_mktsegment, 1, 1)"
    return {
        "authorisations": _authorisations(t),
        "movements": _movements(t),
        "establishment_history": _establishment_history(t),
        "address_history": _address_history(t),
        "terminal_history": _terminal_history(t),
        "geo_location": _geo_location(t),
        "provinces": _provinces(t),
        "categories": _codes(
            t["customer"], "substring(c_mktsegment, 1, 4)", "c_mktsegment", "cod_rubro", "desc_rubro"
        ),
        "establishment_states": _codes(
            t["orders"], "o_orderstatus", "concat('Estado ', o_orderstatus)",
            "cd_estado_establecimiento", "ds_estado_establecimiento",
        ),
        "income_tax_types": _codes(
            t["orders"], priority, "o_orderpriority",
            "cod_tipo_contrib_ganancias", "desc_tipo_contrib_ganancias",
        ),
        "vat_types": _codes(
            t["orders"], priority, "concat('IVA ', o_orderpriority)", "cod_tipo_iva", "desc_tipo_iva"
        ),
        "turnover_tax_types": _codes(
            t["customer"], segment, "lower(c_mktsegment)",
            "cod_tipo_contrib_ing_brutos", "desc_tipo_contrib_ing_brutos",
        ),
        "payment_cycles": t["region"].selectExpr(
            "r_regionkey AS cod_ciclo_pago_estab", "r_name AS desc_ciclo_pago_estab"
        ),
        "instalment_plans": t["region"].selectExpr(
            "r_regionkey AS cod_habilitacion_cuotas", "lower(r_name) AS desc_habilitacion_cuotas"
        ),
        "banks": t["nation"].selectExpr("n_nationkey AS cod_banco", "n_name AS denominacion"),
        "inflation_index": _inflation_index(t),
        "terminals": _terminals(t),
        "state_log": _state_log(t),
        "contracts": _contracts(t),
        "vip_owners": t["supplier"]
        .groupBy(F.expr("concat('T', s_suppkey - s_suppkey % 3)").alias("nro_cuit"))
        .agg(F.max("s_acctbal").alias("balance"))
        .where("balance > 5000")
        .select("nro_cuit"),
        "billing": _billing(t),
        "phones": t["customer"].selectExpr(
            "c_custkey AS nro_establecimiento",
            "CASE WHEN c_acctbal >= 0 THEN concat('0', c_nationkey) END AS ddn",
            "CAST(c_custkey AS STRING) AS numero_telefono",
        ),
        "templates": _templates(t),
        "terminal_models": t["part"].selectExpr(f"{PART_TERMINAL} AS id_terminal", "p_name AS modelo"),
    }
