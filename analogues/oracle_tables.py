"""The input tables of the plans as SQL over the given Parquet tables."""

from __future__ import annotations

PREFIX = (
    "CASE {line} WHEN 1 THEN '07' WHEN 2 THEN '09' WHEN 3 THEN '13' WHEN 4 THEN '36' "
    "WHEN 5 THEN '51' WHEN 6 THEN '08' ELSE '99' END"
)
# at least six digits, never fewer than the key has
SERIAL = "repeat('0', greatest(0, 6 - length(CAST({key} AS VARCHAR)))) || CAST({key} AS VARCHAR)"
TERMINAL = PREFIX.format(line="l_linenumber") + " || " + SERIAL.format(key="l_suppkey")
PART_TERMINAL = PREFIX.format(line="(p_partkey % 7 + 1)") + " || " + SERIAL.format(key="(p_partkey // 7)")

TABLES = {
    "authorisations": f"""
        SELECT {TERMINAL} AS nro_terminal, l_suppkey AS nro_establecimiento_orig,
               CAST(l_shipdate AS DATE) AS fecha_host_entrada_autoriz,
               CASE l_returnflag WHEN 'N' THEN 0 WHEN 'A' THEN 900
                    ELSE CASE WHEN l_linestatus = 'F' THEN 100 ELSE 7 END END AS cod_respuesta_autorizacion,
               CASE WHEN l_tax > 0.075 THEN 1200 ELSE 1100 END AS cod_tipo_mensaje_autoriz,
               CASE WHEN l_linestatus = 'O' THEN CAST(l_orderkey AS VARCHAR) ELSE '  ' END AS nro_autorizacion,
               CAST(CASE WHEN l_tax < 0.005 THEN 0 WHEN l_tax < 0.015 THEN 250 ELSE l_extendedprice END
                    AS DECIMAL(18,2)) AS monto_autoriz_moneda_orig,
               CASE WHEN l_discount > 0.095 THEN 19500
                    ELSE 515000 + CAST(l_quantity AS INTEGER) * 1000 END AS programa_periferia_origen,
               'AA' || CASE WHEN l_discount < 0.025 THEN 'W' WHEN l_discount < 0.045 THEN 'G'
                            WHEN l_discount < 0.065 THEN 'E' WHEN l_discount < 0.085 THEN 'D' ELSE 'X' END
                    || '0000' AS datos_adicionales_2
        FROM lineitem""",
    "movements": """
        SELECT CAST(o_orderdate AS DATE) AS fecha_movimiento, o_custkey AS nro_establecimiento,
               CASE o_orderstatus WHEN 'F' THEN '0005' WHEN 'O' THEN '0510' ELSE '0999' END AS cod_tipo_operacion,
               CAST(o_totalprice AS DECIMAL(18,2)) AS monto_movimiento,
               CAST(o_totalprice AS DECIMAL(18,2)) AS monto_movimiento_origen
        FROM orders""",
    "establishment_history_all": """
        SELECT 'T' || CAST(o_custkey - o_custkey % 3 AS VARCHAR) AS cuit_establecimiento_host,
               o_custkey AS nro_establecimiento, o_orderkey AS id_carga,
               CASE WHEN c_acctbal >= 0 THEN substr(c_mktsegment, 1, 4) END AS cod_rubro,
               c_name AS nombre_fantasia, o_orderstatus AS cod_estado_establecimiento,
               substr(o_orderpriority, 1, 1) AS cod_tipo_contrib_ganancias,
               substr(o_orderpriority, 1, 1) AS cod_tipo_iva,
               substr(c_mktsegment, 1, 1) AS cod_tipo_contrib_ing_brutos,
               c_nationkey % 7 AS cod_ciclo_pago_estab, c_nationkey % 5 AS cod_habilitacion_cuotas,
               CASE WHEN c_acctbal <= 9000 THEN c_nationkey END AS cod_banco,
               c_nationkey + 12 AS cant_maxima_cuotas, c_nationkey % 3 AS cod_devol_iva,
               o_orderstatus || '-host' AS plataforma_alta, c_nationkey % 4 + 1 AS bandera,
               CASE WHEN o_orderstatus <> 'P' THEN 'Benef ' || o_orderpriority END AS beneficiario_host,
               '  ' || o_orderstatus || ' ' AS nivel_seguridad_moto_ecom,
               CAST(o_orderdate AS DATE) AS fecha_inicio,
               CASE WHEN o_orderstatus = 'O' THEN DATE '9999-12-31'
                    ELSE CAST(o_orderdate AS DATE) + CAST(30 + o_orderkey % 700 AS INTEGER) END AS fecha_fin,
               CAST(o_orderdate AS DATE) AS fecha_alta
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "establishment_history": """
        SELECT * FROM establishment_history_all
        WHERE fecha_inicio <= DATE '2000-06-30'
          AND (fecha_fin > DATE '1999-06-01' OR fecha_fin = DATE '9999-12-31')""",
    "address_history": """
        SELECT o_custkey AS nro_establecimiento,
               CASE WHEN o_orderstatus = 'O' THEN DATE '9999-12-31' ELSE CAST(o_orderdate AS DATE) END AS fecha_fin,
               CASE WHEN o_orderstatus = 'P' THEN '' WHEN o_orderpriority = '3-MEDIUM' THEN NULL
                    ELSE 'Calle ' || substr(o_orderpriority, 1, 1) END AS calle,
               CASE WHEN o_orderstatus = 'O' THEN substr(o_orderpriority, 1, 1) || '00' END AS numero,
               CAST(1000 + c_nationkey AS VARCHAR) AS codigo_postal4,
               CASE WHEN c_acctbal >= 500 THEN CAST(1000 + o_custkey % 50 AS INTEGER) END AS cod_localidad,
               CASE WHEN c_nationkey % 5 = 0 THEN ''
                    ELSE 'Localidad ' || CAST(o_custkey % 50 AS VARCHAR) END AS nombre_localidad,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '2'
                    WHEN o_orderpriority = '5-LOW' THEN '3' ELSE '1' END AS cod_tipo_direccion,
               chr(65 + c_nationkey) || '01' AS cod_region_geografica_host, o_orderkey AS id_carga
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "geo_location": """
        SELECT c_custkey AS nro_establecimiento,
               CASE WHEN c_acctbal <= 9800 THEN CAST(-34.6 AS DOUBLE)
                    + CAST((c_custkey * 7919) % 100003 AS DOUBLE) / CAST(200000 AS DOUBLE) END AS latitud,
               CASE WHEN c_acctbal <= 9800 THEN CAST(-58.4 AS DOUBLE)
                    + CAST((c_custkey * 104729) % 100003 AS DOUBLE) / CAST(200000 AS DOUBLE) END AS longitud,
               CASE c_nationkey % 3 WHEN 0 THEN 'Comuna ' || CAST(c_custkey % 15 AS VARCHAR)
                    WHEN 1 THEN 'Partido ' || CAST(c_custkey % 20 AS VARCHAR) END AS desc_departamento_geo,
               'Geo ' || CAST(c_nationkey AS VARCHAR) AS desc_provincia_geo,
               'GBA ' || CAST(c_custkey % 50 AS VARCHAR) AS desc_localidad_gba_geo
        FROM customer""",
    "terminal_history": f"""
        SELECT * FROM (
            SELECT CASE WHEN l_returnflag = 'R' THEN l_suppkey - l_suppkey % 3 ELSE l_suppkey END
                       AS nro_establecimiento,
                   {TERMINAL} AS nro_terminal, CAST(min(l_shipdate) AS DATE) AS fecha_inicio,
                   CASE WHEN l_returnflag <> 'N' THEN CAST(max(l_shipdate) AS DATE) END AS fecha_fin
            FROM lineitem GROUP BY l_suppkey, l_linenumber, l_returnflag) AS spans
        WHERE fecha_inicio <= DATE '2000-06-30' AND (fecha_fin > DATE '1999-06-01' OR fecha_fin IS NULL)""",
    "provinces": """
        SELECT chr(65 + n_nationkey) AS cod_provincia,
               CASE n_nationkey WHEN 0 THEN 'BUENOS AIRES' WHEN 24 THEN NULL ELSE n_name END AS desc_provincia
        FROM nation""",
    "categories": """
        SELECT DISTINCT substr(c_mktsegment, 1, 4) AS cod_rubro, c_mktsegment AS desc_rubro FROM customer""",
    "establishment_states": """
        SELECT DISTINCT o_orderstatus AS cd_estado_establecimiento,
               'Estado ' || o_orderstatus AS ds_estado_establecimiento FROM orders""",
    "income_tax_types": """
        SELECT DISTINCT substr(o_orderpriority, 1, 1) AS cod_tipo_contrib_ganancias,
               o_orderpriority AS desc_tipo_contrib_ganancias FROM orders""",
    "vat_types": """
        SELECT DISTINCT substr(o_orderpriority, 1, 1) AS cod_tipo_iva,
               'IVA ' || o_orderpriority AS desc_tipo_iva FROM orders""",
    "turnover_tax_types": """
        SELECT DISTINCT substr(c_mktsegment, 1, 1) AS cod_tipo_contrib_ing_brutos,
               lower(c_mktsegment) AS desc_tipo_contrib_ing_brutos FROM customer""",
    "payment_cycles": "SELECT r_regionkey AS cod_ciclo_pago_estab, r_name AS desc_ciclo_pago_estab FROM region",
    "instalment_plans": """
        SELECT r_regionkey AS cod_habilitacion_cuotas, lower(r_name) AS desc_habilitacion_cuotas FROM region""",
    "banks": "SELECT n_nationkey AS cod_banco, n_name AS denominacion FROM nation",
    "inflation_index": """
        SELECT DISTINCT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS periodo,
               CAST(1 AS DOUBLE) + CAST(0.01 AS DOUBLE)
                   * CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 AS DOUBLE) AS indice
        FROM orders""",
    "terminals": f"""
        SELECT DISTINCT l_suppkey * 10 + l_linenumber AS id_terminal,
               {PREFIX.format(line="l_linenumber")} || '00' AS cprefijo,
               {SERIAL.format(key="l_suppkey")} AS cnumeroterminal,
               l_suppkey AS contratoestablecimiento_id, l_linenumber AS estadoterminal_id
        FROM lineitem""",
    "state_log": """
        SELECT l_suppkey * 10 + l_linenumber AS terminalid,
               DATE '1999-05-20' + CAST((l_suppkey * 37 + l_linenumber * 53) % 420 AS INTEGER)
                   + CAST(l_quantity AS INTEGER) % 5 AS dfechalogging,
               CAST(l_quantity AS INTEGER) AS postestadoid
        FROM lineitem""",
    "contracts": """
        SELECT s_suppkey AS id_contratoestablecimiento,
               'T' || CAST(s_suppkey - s_suppkey % 3 AS VARCHAR) AS ccuit,
               CASE WHEN s_acctbal < 0 THEN 'S/N' ELSE CAST(s_suppkey AS VARCHAR) END AS cnumeroestablecimiento,
               DATE '1998-01-01' + CAST((s_suppkey * 13) % 900 AS INTEGER) AS dfechacontrato,
               '011-' || CAST(s_suppkey AS VARCHAR) AS ccontactotelefono,
               'Av ' || CAST(s_nationkey AS VARCHAR) AS cdomiciliocalle,
               CASE WHEN s_acctbal >= 1000 THEN s_name END AS crazonsocial
        FROM supplier""",
    "vip_owners": """
        SELECT 'T' || CAST(s_suppkey - s_suppkey % 3 AS VARCHAR) AS nro_cuit
        FROM supplier GROUP BY 1 HAVING max(s_acctbal) > 5000""",
    "billing": f"""
        SELECT nro_terminal, codigo_cargo, nro_mes_cargo, first_day AS fecha_alta_terminal,
               CAST(year(first_day) * 100 + month(first_day) AS INTEGER) AS periodo_inicio_cargo,
               CAST(year(last_day) * 100 + month(last_day) AS INTEGER) AS periodo
        FROM (SELECT {TERMINAL} AS nro_terminal, 'C' || CAST(l_linenumber AS VARCHAR) AS codigo_cargo,
                     count(*) AS nro_mes_cargo, CAST(min(l_shipdate) AS DATE) AS first_day,
                     CAST(max(l_shipdate) AS DATE) AS last_day
              FROM lineitem GROUP BY l_suppkey, l_linenumber) AS charges""",
    "phones": """
        SELECT c_custkey AS nro_establecimiento,
               CASE WHEN c_acctbal >= 0 THEN '0' || CAST(c_nationkey AS VARCHAR) END AS ddn,
               CAST(c_custkey AS VARCHAR) AS numero_telefono
        FROM customer""",
    "templates": f"""
        SELECT {PART_TERMINAL} AS id_terminal, DATE '2000-01-01' + p_size AS fecha_parametrizacion,
               p_type AS plantilla_origen, p_brand AS plantilla_destino,
               CAST(p_size AS VARCHAR) AS version_origen, p_type AS medio, p_brand AS marca,
               CASE p_size % 5 WHEN 0 THEN 'Cambiar Equipo' WHEN 1 THEN 'Sin modelo' WHEN 3 THEN p_brand
                    WHEN 4 THEN 'Brand#0' END AS plantilla_adecuada
        FROM part""",
    "terminal_models": f"SELECT {PART_TERMINAL} AS id_terminal, p_name AS modelo FROM part",
}
