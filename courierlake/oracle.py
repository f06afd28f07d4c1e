"""DuckDB SQL for every registered query, written from the semantics (not
from the Spark code): the fixture rules are restated as CASE expressions and
the expected values are computed from the source columns directly (for
example a parsed stamp is ``date_trunc('second', ts)`` or NULL, by rule).
"""

from __future__ import annotations

from courierlake import config
from courierlake.fixtures import CODE_LIST, PAGE_EVENTS, UNKNOWN_CODE


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


CODE_SQL = ("CASE l_partkey % 23 "
            + " ".join(f"WHEN {i} THEN {_lit(c)}" for i, c in enumerate(CODE_LIST))
            + f" WHEN {len(CODE_LIST)} THEN {_lit(UNKNOWN_CODE)} ELSE NULL END")


def label_sql(col: str) -> str:
    return (f"CASE {col} "
            + " ".join(f"WHEN {_lit(c)} THEN {_lit(l)}" for c, l in config.OUTCOME_LABELS.items())
            + f" ELSE {_lit(config.DEFAULT_LABEL)} END")


VEHICLES_SQL = """
SELECT DISTINCT c_custkey AS vehicle, c_name AS name,
       CASE WHEN c_custkey % 50 = 0 AND d.fetch_day = 2 THEN c_mktsegment || '-repainted'
            ELSE c_mktsegment END AS color
FROM customer, range(3) d(fetch_day)
"""

ROUTES_SQL = """
SELECT DISTINCT
  o_orderkey AS route,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END AS vehicle,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey % 7 END AS driver,
  o_orderpriority AS plan,
  o_orderstatus AS status_route,
  CAST(o_orderdate AS DATE) AS planned_date,
  '08:00:00' AS estimated_time_start,
  '18:00:00' AS estimated_time_end,
  CAST(o_orderkey % 600 AS VARCHAR) AS total_duration,
  o_totalprice AS total_distance,
  CAST(o_custkey AS DOUBLE) AS total_load,
  CAST(NULL AS DOUBLE) AS total_load_percentage,
  'Depot ' || CAST(o_custkey % 7 AS VARCHAR) AS location_start_address,
  CAST(-12.0464 AS DOUBLE) AS location_start_latitude,
  CAST(-77.0428 AS DOUBLE) AS location_start_longitude,
  'Depot ' || CAST(o_custkey % 7 AS VARCHAR) AS location_end_address,
  CAST(-12.0464 AS DOUBLE) AS location_end_latitude,
  CAST(-77.0428 AS DOUBLE) AS location_end_longitude,
  CAST(NULL AS VARCHAR) AS start_time,
  CAST(NULL AS VARCHAR) AS end_time,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created_route,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS modified_route,
  o_totalprice AS kilometers,
  CAST(NULL AS BIGINT) AS total_visits,
  CAST(NULL AS DOUBLE) AS latitude_init,
  CAST(NULL AS DOUBLE) AS longitude_init,
  CAST(NULL AS DOUBLE) AS latitude_finish,
  CAST(NULL AS DOUBLE) AS longitude_finish
FROM orders
"""

ROUTE_OUT = ["plan", "status_route", "estimated_time_start", "estimated_time_end", "total_duration",
             "total_distance", "total_load", "total_load_percentage", "location_start_address",
             "location_start_latitude", "location_start_longitude", "location_end_address",
             "location_end_latitude", "location_end_longitude", "start_time", "end_time", "created_route",
             "modified_route", "kilometers", "total_visits", "latitude_init", "longitude_init",
             "latitude_finish", "longitude_finish", "name", "color"]

VISIT_EXPR = {
    "id": "l_partkey",
    "order_visit": "l_linenumber",
    "tracking_id": "'WYB' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)",
    "status": "CASE WHEN l_linestatus = 'F' THEN 'completed' ELSE 'pending' END",
    "title": "'Visit ' || CAST(l_partkey AS VARCHAR)",
    "address": "'Street ' || CAST(l_suppkey AS VARCHAR)",
    "latitude": "l_quantity",
    "longitude": "l_discount",
    "contact_name": "CAST(NULL AS VARCHAR)",
    "contact_phone": "CAST(NULL AS VARCHAR)",
    "reference": "l_returnflag",
    "notes": "CAST(NULL AS VARCHAR)",
    "planned_date": "CAST(o_orderdate AS DATE)",
    "route": "l_orderkey",
    "route_estimated_time_start": "'08:00:00'",
    "estimated_time_arrival": "strftime(l_shipdate, '%Y-%m-%d')",
    "estimated_time_departure": "CAST(NULL AS VARCHAR)",
    "checkin_time": "CAST(NULL AS VARCHAR)",
    "checkout_time": "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')",
    "checkout_latitude": "l_extendedprice",
    "checkout_longitude": "l_tax",
    "checkout_comment": "CASE WHEN l_returnflag = 'R' THEN 'returned' END",
    "checkout_observation": CODE_SQL,
    "created": "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')",
    "modified": "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')",
    "eta_predicted": "CAST(NULL AS VARCHAR)",
    "eta_current": "CAST(NULL AS VARCHAR)",
    "driver": "CASE WHEN l_linenumber = 1 THEN -1 WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey % 7 END",
    "vehicle": "o_custkey",
    "on_its_way": "CASE WHEN l_linestatus = 'O' THEN 'true' ELSE 'false' END",
    "priority_level": "o_orderpriority",
    "geocode_alert": "CASE WHEN l_partkey % 3 = 0 THEN 'true' ELSE 'false' END",
}


def visit_mart_sql(account: int, text_dates: bool = False, hot: bool = False) -> str:
    """The visit mart; ``text_dates`` keeps planned dates as ISO text (the
    feed's JSON pages carry them as text); ``hot`` puts a third of the visits
    on one route and leaves some without a route."""
    cols = config.VISIT_COLUMNS_ACCOUNT_1 if account == 1 else config.VISIT_COLUMNS_ACCOUNT_2
    names = ["order_visit" if c == "order" else c for c in cols]
    expr = dict(VISIT_EXPR)
    routes = ROUTES_SQL
    if text_dates:
        expr["planned_date"] = "strftime(o_orderdate, '%Y-%m-%d')"
        routes = routes.replace("CAST(o_orderdate AS DATE) AS planned_date",
                                "strftime(o_orderdate, '%Y-%m-%d') AS planned_date")
    if hot:
        expr["route"] = "CASE WHEN l_partkey % 3 = 0 THEN hot_key WHEN l_partkey % 7 <> 1 THEN l_orderkey END"
        for name, value in (("vehicle", "hot_cust"), ("driver", "hot_cust % 7"), ("planned_date", "hot_day")):
            expr[name] = f"CASE WHEN l_partkey % 3 = 0 THEN {value} ELSE {expr[name]} END"
    vis = ",\n  ".join(f"{expr[n]} AS {n}" for n in names)
    keys = " AND ".join(f"vis.{k} IS NOT DISTINCT FROM rv.{k}" for k in config.VISIT_ROUTE_KEYS)
    return f"""
WITH veh AS ({VEHICLES_SQL}),
rts AS ({routes}),
hot AS (
  SELECT o_orderkey AS hot_key, o_custkey AS hot_cust, CAST(o_orderdate AS DATE) AS hot_day FROM orders
  WHERE o_orderkey % 5 <> 0 AND o_orderkey % 11 <> 0 ORDER BY o_orderkey LIMIT 1),
rv AS (SELECT r.*, v.name, v.color FROM rts r JOIN veh v ON r.vehicle IS NOT DISTINCT FROM v.vehicle),
vis AS (
  SELECT {vis}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey{", hot" if hot else ""})
SELECT vis.*, {label_sql('vis.checkout_observation')} AS Observaciones,
       {", ".join("rv." + c for c in ROUTE_OUT)}
FROM vis LEFT JOIN rv ON {keys}
"""


# --- tracking feed --------------------------------------------------------------------

GUIA_SQL = "(CASE WHEN c_custkey % 4 = 3 THEN 'XQZ' ELSE 'WYB' END) || lpad(CAST(c_custkey AS VARCHAR), 9, '0')"

SELECTED_SQL = f"""
keys AS (
  SELECT DISTINCT tracking FROM (
    SELECT DISTINCT tracking_num AS tracking
    FROM (SELECT {GUIA_SQL} AS tracking_num,
                 DATE '2024-03-15' + CAST(c_custkey % 45 AS INTEGER) AS creation_dt
          FROM customer)
    WHERE creation_dt >= DATE '2024-04-01' AND tracking_num LIKE '%WYB%')),
sel AS (
  SELECT *, {GUIA_SQL} AS guia, c_custkey % 7 AS m7
  FROM customer
  WHERE c_custkey % 17 <> 5 AND c_custkey % 19 <> 7 AND c_custkey % 23 <> 11
    AND {GUIA_SQL} IN (SELECT tracking FROM keys))
"""


def _parent(filled: str) -> str:
    return f"CASE WHEN m7 IN (0, 1) THEN '' WHEN m7 = 2 THEN NULL ELSE {filled} END"


DAY_SQL = "lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0')"

HISTORY_SQL = f"""
WITH {SELECTED_SQL}
SELECT
  guia AS guia_ue,
  CASE WHEN c_custkey % 9 = 4 THEN NULL ELSE 'TN' || CAST(c_custkey AS VARCHAR) END AS tracking_number,
  {_parent("'C' || CAST(c_custkey % 10 AS VARCHAR)")} AS servicio_contrato,
  {_parent("'LIM'")} AS servicio_origen,
  {_parent("'2024-04-' || " + DAY_SQL)} AS servicio_admitido,
  {_parent("CAST(c_custkey AS VARCHAR)")} AS cliente_codigo,
  {_parent("c_name")} AS cliente_nombre,
  CASE WHEN m7 = 2 THEN NULL ELSE '' END AS cliente_telefono,
  {_parent("'Calle ' || CAST(c_nationkey AS VARCHAR)")} AS direccion_entrega,
  {_parent("c_mktsegment")} AS direccion_entrega_referencia,
  {_parent("'LIMA'")} AS direccion_entrega_ciudad,
  {_parent("CAST(c_nationkey % 5 AS VARCHAR)")} AS direccion_entrega_zona,
  {_parent("'AG' || CAST(c_nationkey AS VARCHAR)")} AS direccion_entrega_agencia,
  {_parent("c_mktsegment")} AS estado_actual_estado,
  {_parent("'det ' || c_mktsegment")} AS estado_actual_Detalle_Estado,
  CAST(e.event_id AS VARCHAR) AS movimiento_secuencia,
  e.event_type AS movimiento_codigo,
  'E-' || e.event_type AS movimiento_estado,
  CASE WHEN e.event_id % 3 = 0 THEN '' ELSE 'S' || CAST(e.event_id % 4 AS VARCHAR) END AS movimiento_sub_estado,
  CASE WHEN e.event_id % 5 = 0 THEN NULL ELSE 'detail ' || e.event_type END AS movimiento_detalle_estado,
  CASE WHEN e.event_id % 10 IN (1, 4, 8, 9) THEN date_trunc('second', e.ts) END AS movimiento_fecha,
  'note ' || CAST(e.user_id % 13 AS VARCHAR) AS movimiento_apuntes,
  CASE WHEN e.event_id % 4 = 1 THEN '' ELSE 'Av ' || CAST(e.user_id % 9 AS VARCHAR) END AS movimiento_dir_agencia,
  CAST(1 + e.event_id % 3 AS VARCHAR) AS movimiento_n_visita,
  CASE WHEN m7 IN (0, 1, 2) THEN NULL
       ELSE make_timestamp(2024, 4, 1 + c_custkey % 28, c_custkey % 24, c_custkey % 60, 0) END
    AS estado_actual_fecha_hora
FROM sel JOIN events e ON e.user_id = sel.c_custkey
"""

KEY_LOOKUP_SQL = f"""
WITH {SELECTED_SQL}
SELECT guia, p.page
FROM sel JOIN (SELECT DISTINCT user_id, event_id // {PAGE_EVENTS} AS page FROM events) p
  ON p.user_id = sel.c_custkey
UNION ALL
SELECT guia, CAST(0 AS BIGINT) AS page
FROM sel WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = sel.c_custkey)
"""


def latest_per_code_sql() -> str:
    idx = config.PIVOT_INDEX
    renames = {"click": "fecha_click", "purchase": "fecha_purchase", "view": "fecha_view"}
    codes = ["click", "purchase", "view", "error", "signup"]
    aggs = ",\n  ".join(
        f"max(movimiento_fecha) FILTER (WHERE movimiento_codigo = {_lit(c)}) AS {renames.get(c, c)}"
        for c in codes)
    not_null = " AND ".join(f"{c} IS NOT NULL" for c in idx + ["movimiento_fecha"])
    return f"""
WITH h AS ({HISTORY_SQL})
SELECT {", ".join(idx)},
  {aggs}
FROM h WHERE {not_null}
GROUP BY {", ".join(idx)}
"""


def discovered_codes_sql() -> str:
    idx = config.PIVOT_INDEX
    not_null = " AND ".join(f"{c} IS NOT NULL" for c in idx + ["movimiento_fecha"])
    return f"""
WITH h AS ({HISTORY_SQL}),
f AS (SELECT {", ".join(idx)}, movimiento_codigo, movimiento_fecha FROM h WHERE {not_null})
SELECT * FROM (PIVOT f ON movimiento_codigo IN
  ('click', 'error', 'purchase', 'signup', 'view') USING max(movimiento_fecha) GROUP BY {", ".join(idx)})
"""


# --- export feed ----------------------------------------------------------------------

EXPORT_SQL = """
WITH b AS (SELECT max(CAST(o_orderdate AS DATE)) AS run, min(CAST(o_orderdate AS DATE)) AS fl FROM orders),
w AS (SELECT o.*, (b.run - CAST(o.o_orderdate AS DATE)) // 31 AS k, (b.run - b.fl - 30) // 31 AS kmax
      FROM orders o, b)
SELECT
  'G' || CAST(o_orderkey AS VARCHAR) AS Nro_de_guia,
  o_orderdate AS Fecha,
  o_orderstatus AS Estado,
  o_orderpriority AS Servicio,
  CASE WHEN k % 5 = 2 THEN CAST(CAST(o_custkey % 50 AS DOUBLE) + 0.5 AS VARCHAR)
       ELSE CAST(o_custkey % 50 AS VARCHAR) END AS Peso_kg,
  'LIM' AS Origen,
  'DST' || CAST(o_custkey % 25 AS VARCHAR) AS Destino,
  'Seller ' || CAST(o_custkey % 11 AS VARCHAR) AS Remitente,
  'Av Principal 100' AS Direccion_Origen,
  'Customer ' || CAST(o_custkey AS VARCHAR) AS Consignatario,
  'Calle ' || CAST(o_custkey % 97 AS VARCHAR) AS Direccion_Destino,
  o_orderdate + INTERVAL 3 DAY AS Fecha_de_Entrega,
  o_orderpriority AS Observacion_Estado_Actual,
  'DOC' || CAST(o_orderkey AS VARCHAR) AS Doc_Cliente,
  CASE WHEN o_orderkey % 2 = 0 THEN 'MOTO' ELSE 'VAN' END AS Trasnporte,
  CASE WHEN k % 3 <> 0 THEN 'obs ' || o_orderstatus END AS Obs_Adicional,
  CAST(o_orderkey AS VARCHAR) AS Nro_Pedido,
  CAST(o_custkey AS VARCHAR) AS Nro_Consultora,
  o_orderstatus AS Ultima_Ocurrencia,
  'Order ' || CAST(o_orderkey AS VARCHAR) AS Descripcion,
  o_orderdate + INTERVAL 1 DAY AS Fecha_Visita1,
  'ok' AS Observacion_Visita1,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 2 DAY END AS Fecha_Visita2,
  CASE WHEN o_orderkey % 3 = 0 THEN 'retry' END AS Observacion_Visita2,
  CASE WHEN o_orderkey % 7 = 0 THEN o_orderdate + INTERVAL 4 DAY END AS Fecha_Visita3,
  CAST(o_orderkey % 4 AS DOUBLE) + CASE WHEN k % 5 = 2 THEN 0.25 ELSE 0 END AS Contador_Visitas,
  lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS Nro_Documento_Destinatario,
  'LIMA' AS Departamento_Destinatario,
  'LIMA' AS Provincia_Destinatario,
  'D' || CAST(o_custkey % 43 AS VARCHAR) AS Distrito_Destinatario,
  o_orderdate AS Fecha_Recojo,
  CASE WHEN k % 4 <> 1 THEN '9' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') END AS Telefono,
  CAST(1 + o_orderkey % 3 AS VARCHAR) AS Bultos,
  '150101' AS Ubigeo_Origen,
  '1501' || lpad(CAST(o_custkey % 43 AS VARCHAR), 2, '0') AS Ubigeo_Destino,
  CASE WHEN o_orderkey % 2 = 0 THEN 'WEB' ELSE 'APP' END AS Canal
FROM w WHERE k <= kmax AND k % 9 <> 8 AND k % 11 <> 10
"""


ORACLE_SQL: dict[str, str] = {
    "q01_key_selection": """
SELECT DISTINCT tracking FROM (
  SELECT DISTINCT p_name AS tracking FROM part WHERE p_size >= 10 AND p_name LIKE '%ring%')
""",
    "q02_json_feed": """
SELECT CAST(ts AS DATE) AS planned_date, event_id, event_type,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k
FROM events WHERE event_id % 10 >= 4
UNION ALL
SELECT CAST(ts AS DATE) AS planned_date, event_id, event_type, CAST(NULL AS BIGINT) AS props_k
FROM events WHERE event_id % 10 = 4
""",
    "q02b_feed_rejects": """
SELECT 'visits' AS endpoint, CAST(ts AS DATE) AS planned_date,
       CASE WHEN event_id % 10 = 1 THEN 500 ELSE 200 END AS http_status,
       CASE event_id % 10 WHEN 1 THEN 'status' WHEN 3 THEN 'empty' ELSE 'malformed' END AS reason
FROM events WHERE event_id % 10 < 4
""",
    "q02c_rejected_elements": """
WITH e AS (SELECT CAST(ts AS DATE) AS planned_date, event_id % 10 AS m, event_id, event_type,
                  json_extract_string(props, '$.k') AS k FROM events)
SELECT planned_date,
       CASE m WHEN 2 THEN 'null' WHEN 3 THEN 'not an object' WHEN 4 THEN 'type: props.k' ELSE 'type: event_id' END AS reason,
       CASE m WHEN 2 THEN 'null' WHEN 3 THEN CAST(event_id AS VARCHAR)
              ELSE '{"event_id":' || CASE m WHEN 0 THEN '"x' || event_id || '"' WHEN 1 THEN event_id || '.5'
                                            ELSE CAST(event_id AS VARCHAR) END
                   || ',"event_type":"' || event_type || '","props":{"k":' || CASE m WHEN 4 THEN '"none"' ELSE k END || '}}'
       END AS element
FROM e WHERE m < 5
""",
    "q02d_typed_elements": """
SELECT CAST(ts AS DATE) AS planned_date, event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k
FROM events WHERE event_id % 10 <> 6
""",
    "q02e_undeclared_fields": """
SELECT CAST(ts AS DATE) AS planned_date, event_id, event_type,
       CASE WHEN event_id % 10 = 5 THEN CAST(1.5 AS DECIMAL(2, 1)) END AS extra_geo_lat,
       CASE WHEN event_id % 10 = 5 THEN 'seen' END AS extra_note,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k,
       CASE WHEN event_id % 10 = 7 THEN 'u' || event_id % 3 END AS props_unit
FROM events
""",
    "q03_key_lookup": KEY_LOOKUP_SQL,
    "q03b_repeated_lookup": KEY_LOOKUP_SQL,
    "q04_vehicle_dimension": VEHICLES_SQL,
    "q05_visit_mart": visit_mart_sql(1),
    "q05b_visit_mart_from_pages": visit_mart_sql(1, text_dates=True),
    "q05c_visit_mart_salted": visit_mart_sql(1, hot=True),
    "q06_visit_mart_account2": visit_mart_sql(2),
    "q07_movement_history": HISTORY_SQL,
    "q07b_movement_history_date_only": HISTORY_SQL.replace(
        "CASE WHEN e.event_id % 10 IN (1, 4, 8, 9) THEN date_trunc('second', e.ts) END AS movimiento_fecha",
        "CAST(NULL AS TIMESTAMP) AS movimiento_fecha"),
    "q07c_movement_history_raw": HISTORY_SQL,
    "q08_stamp_parse": """
SELECT event_id, CASE WHEN event_id % 10 IN (1, 4, 8, 9) THEN date_trunc('second', ts) END AS movimiento_fecha
FROM events
""",
    "q09_outcome_labels": f"""
SELECT id, route, order_visit, checkout_observation, {label_sql('checkout_observation')} AS Observaciones
FROM (SELECT l_partkey AS id, l_orderkey AS route, l_linenumber AS order_visit,
             {CODE_SQL} AS checkout_observation FROM lineitem)
""",
    "q10_latest_per_code": latest_per_code_sql(),
    "q10b_latest_per_code_discovered": discovered_codes_sql(),
    "q11_text_cast": """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders
""",
    "q12_export_consolidation": EXPORT_SQL,
    "q12b_export_consolidation_csv": EXPORT_SQL,
    "q12d_rejected_windows": """
WITH b AS (SELECT max(CAST(o_orderdate AS DATE)) AS run, min(CAST(o_orderdate AS DATE)) AS fl FROM orders),
w AS (SELECT run, unnest(range(0, (run - fl - 30) // 31 + 1)) AS k FROM b)
SELECT CAST(run - CAST(31 * k + 30 AS INTEGER) AS DATE) AS window_start, CAST(run - CAST(31 * k AS INTEGER) AS DATE) AS window_end,
       CAST(CASE WHEN k % 9 = 8 THEN 500 ELSE 200 END AS INTEGER) AS http_status,
       CASE WHEN k % 11 = 10 THEN 'text/html; charset=UTF-8'
            ELSE 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet' END AS content_type,
       CASE WHEN k % 9 = 8 THEN 'status' ELSE 'content_type' END AS reason
FROM w WHERE k % 9 = 8 OR k % 11 = 10
""",
    "q12c_export_recent_windows": EXPORT_SQL.replace("k <= kmax", "k <= least(kmax, 9)"),
    "q13_daily_spine": """
SELECT CAST(g AS DATE) AS day, strftime(CAST(g AS DATE), '%Y-%m-%d') AS day_text
FROM (SELECT min(CAST(ts AS DATE)) AS s, max(CAST(ts AS DATE)) AS e FROM events) b,
     LATERAL (SELECT unnest(generate_series(b.s, b.e, INTERVAL 1 DAY)) AS g)
""",
    "q14_backward_windows": """
SELECT CAST(k AS INTEGER) AS window_seq,
       CAST(run - CAST(31 * k + 30 AS INTEGER) AS DATE) AS window_start,
       CAST(run - CAST(31 * k AS INTEGER) AS DATE) AS window_end,
       strftime(CAST(run - CAST(31 * k + 30 AS INTEGER) AS DATE), '%Y-%m-%d') AS f_ini,
       strftime(CAST(run - CAST(31 * k AS INTEGER) AS DATE), '%Y-%m-%d') AS f_fin
FROM (SELECT max(CAST(o_orderdate AS DATE)) AS run, min(CAST(o_orderdate AS DATE)) AS fl FROM orders) b,
     LATERAL (SELECT unnest(generate_series(0, (b.run - b.fl - 30) // 31)) AS k)
""",
    "q15_replace_table": VEHICLES_SQL,
}
