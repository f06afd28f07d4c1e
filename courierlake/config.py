"""Configuration data of the three delivery feeds.

Column lists, renames and lookup tables below are fixed values: they must equal
the feeds' field names and codes for the results to be right, so they are kept
together here, in the order the feeds use them, and nothing else in the package
hard-codes a field name of a feed.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — visit mart (routing feed): vehicles, routes, visits
# ---------------------------------------------------------------------------

VEHICLE_COLUMNS = ["id", "name", "color"]
VEHICLE_RENAMES = {"id": "vehicle"}

ROUTE_COLUMNS = [
    "id", "vehicle", "driver", "plan", "status", "planned_date", "estimated_time_start",
    "estimated_time_end", "total_duration", "total_distance", "total_load", "total_load_percentage",
    "location_start_address", "location_start_latitude", "location_start_longitude",
    "location_end_address", "location_end_latitude", "location_end_longitude", "start_time",
    "end_time", "created", "modified", "kilometers", "total_visits", "latitude_init", "longitude_init",
    "latitude_finish", "longitude_finish",
]
ROUTE_RENAMES = {"id": "route", "status": "status_route", "created": "created_route",
                 "modified": "modified_route"}

# Account 1 keeps checkout_comment; account 2 drops it and adds priority_level
# and geocode_alert.
VISIT_COLUMNS_ACCOUNT_1 = [
    "id", "order", "tracking_id", "status", "title", "address", "latitude", "longitude",
    "contact_name", "contact_phone", "reference", "notes", "planned_date", "route",
    "route_estimated_time_start", "estimated_time_arrival", "estimated_time_departure", "checkin_time",
    "checkout_time", "checkout_latitude", "checkout_longitude", "checkout_comment",
    "checkout_observation",
    "created", "modified", "eta_predicted",
    "eta_current", "driver", "vehicle", "on_its_way",
]
VISIT_COLUMNS_ACCOUNT_2 = [
    "id", "order", "tracking_id", "status", "title", "address", "latitude", "longitude",
    "contact_name", "contact_phone",
    "reference", "notes",
    "planned_date",
    "route", "route_estimated_time_start",
    "estimated_time_arrival", "estimated_time_departure", "checkin_time", "checkout_time", "checkout_latitude",
    "checkout_longitude",
    "checkout_observation",
    "created", "modified", "eta_predicted", "eta_current", "driver", "vehicle",
    "priority_level",
    "geocode_alert",
    "on_its_way",
]
VISIT_RENAMES = {"order": "order_visit"}

# Keys of the vehicle-to-route join and of the visit-to-route join.
ROUTE_VEHICLE_KEYS = ["vehicle"]
VISIT_ROUTE_KEYS = ["vehicle", "driver", "route", "planned_date"]

OBSERVATION_COLUMN = "checkout_observation"
OBSERVATION_LABEL_COLUMN = "Observaciones"

# Outcome code -> readable label (21 codes, 20 labels; two codes share
# "Entregado a titular"). Anything else, null included, gets DEFAULT_LABEL.
OUTCOME_LABELS = {
    "1a1d65aa-d355-45b6-8c3f-3f2295ee4c5a": "Producto no corresponde",
    "56a04e5b-2fc5-42df-b4dc-6ef75d97f63c": "Cliente no quiere identificarse",
    "6084c66c-c720-4136-b20f-e01c80a73378": "Fallas mecánicas",
    "830808ee-2ef6-4c96-973c-751d530ba0f9": "Entregado a conserje",
    "9dc634d3-865f-470b-92c0-14fb63a40637": "Fuera De Horario",
    "e4d21dd5-1107-4c99-a9b7-fae1bac83882": "Entregado a familiar",
    "f97966aa-47f5-4c4d-8d42-1b6df9729157": "Entregado a titular",
    "c505bc38-1215-48bf-9e6b-d78bce3dc2f2": "Cliente Solicito Reprogramación",
    "8c15fdad-2f27-49eb-9967-f4fa94a366b1": "Entregado en tienda",
    "04902a7e-116c-4083-82bb-2849e1928db3": "Cliente Ausente",
    "fe8ac91f-0ead-4d84-b33c-aa094173d32b": "Domicilio Sin Acceso",
    "2fee0a67-e6d8-4742-ac52-f8c4f0382543": "Rechazado Por Cliente",
    "412375a8-cd64-4e8a-81be-5572ca883018": "Producto Dañado",
    "15d8ba69-4dff-40c8-9c27-28f8c3d09779": "Distrito errado",
    "a5da6d6e-964e-4a87-b4b8-3ba3a970938c": "Dirección Incorrecta",
    "11feca76-3da6-443e-88cd-5becc64821c8": "Entregado a titular",
    "d2be558b-1910-47fc-ae6b-1ae0c32e60bf": "Fuera de Ruta",
    "bc17ba7d-f735-4aec-ab8f-2baac8772c00": "Siniestro OL",
    "0a782b98-7998-48bf-89d7-7be410a98a55": "Dirección de Agencia",
    "c8be72af-c364-4169-9742-1346519b6a86": "Zona peligrosa",
    "c5ed62de-19fa-4c47-8e7c-193f3fd8573e": "Sin Información",
}
DEFAULT_LABEL = "Otro"

# First day of the daily history that is requested (and rebuilt) every run.
HISTORY_START = "2024-04-01"

# ---------------------------------------------------------------------------
# FIXED VALUES — movement history (tracking feed)
# ---------------------------------------------------------------------------

# Key selection: creation date lower bound and the substring a key must carry.
TRACKING_SINCE = "2024-04-01"
TRACKING_PATTERN = "WYB"

# Shipment fields: (output column, parent object or None for top level, field).
SHIPMENT_FIELDS = [
    ("guia_ue", None, "guia_ue"),
    ("tracking_number", None, "tracking_number"),
    ("servicio_contrato", "servicio", "contrato"),
    ("servicio_origen", "servicio", "origen"),
    ("servicio_admitido", "servicio", "admitido"),
    ("cliente_codigo", "cliente", "codigo"),
    ("cliente_nombre", "cliente", "nombre"),
    ("cliente_telefono", "cliente", "telefono"),
    ("direccion_entrega", "direccion_entrega", "direccion"),
    ("direccion_entrega_referencia", "direccion_entrega", "referencia"),
    ("direccion_entrega_ciudad", "direccion_entrega", "ciudad"),
    ("direccion_entrega_zona", "direccion_entrega", "zona"),
    ("direccion_entrega_agencia", "direccion_entrega", "agencia"),
    ("estado_actual_estado", "estado_actual", "estado"),
    ("estado_actual_Detalle_Estado", "estado_actual", "Detalle_Estado"),
    ("estado_actual_fecha", "estado_actual", "fecha"),
    ("estado_actual_hora", "estado_actual", "hora"),
]

MOVEMENT_ARRAY = "movimiento"
# Movement fields: (output column, field). movimiento_fecha is assembled from
# the fecha and hora fields (see MOVEMENT_DATE_PARTS).
MOVEMENT_FIELDS = [
    ("movimiento_secuencia", "secuencia"),
    ("movimiento_codigo", "codigo"),
    ("movimiento_estado", "estado"),
    ("movimiento_sub_estado", "sub_estado"),
    ("movimiento_detalle_estado", "detalle_estado"),
    ("movimiento_fecha", None),
    ("movimiento_apuntes", "apuntes"),
    ("movimiento_dir_agencia", "dir_agencia"),
    ("movimiento_n_visita", "n_visita"),
]
MOVEMENT_DATE_PARTS = ("fecha", "hora")

# Shipment status stamp: assembled from these two columns, which are then dropped.
STATUS_DATE_PARTS = ("estado_actual_fecha", "estado_actual_hora")
STATUS_STAMP_COLUMN = "estado_actual_fecha_hora"

# Index of the optional latest-time-per-code pivot (15 shipment columns).
PIVOT_INDEX = [
    "guia_ue", "tracking_number", "servicio_contrato", "servicio_origen", "servicio_admitido", "cliente_codigo",
    "cliente_nombre", "cliente_telefono", "direccion_entrega", "direccion_entrega_referencia", "direccion_entrega_ciudad",
    "direccion_entrega_zona", "direccion_entrega_agencia", "estado_actual_estado", "estado_actual_Detalle_Estado",
]
PIVOT_RENAMES = {"SS": "fecha_SS", "AO": "fecha_AO", "EN": "fecha_EN"}

# ---------------------------------------------------------------------------
# FIXED VALUES — export consolidation (export feed)
# ---------------------------------------------------------------------------

# Raw headers of the export, in sheet order. Each is renamed by
# courierlake.operators.shape.header_rule; EXPORT_HEADER_OVERRIDES holds the
# one name that does not follow the rule. Headers not listed here are kept.
EXPORT_HEADERS = [
    "Nro de guia", "Fecha", "Estado", "Servicio", "Peso (Kg)", "Origen", "Destino", "Remitente",
    "Direccion Origen", "Consignatario", "Direccion Destino", "Fecha de Entrega",
    "Observacion Estado Actual", "Doc. Cliente", "Trasnporte", "Obs Adicional", "Nro Pedido",
    "Nro Consultora", "Ultima Ocurrencia", "Descripcion", "Fecha Visita1", "Observacion Visita1",
    "Fecha Visita2", "Observacion Visita2", "Fecha Visita3", "Observacion Visita3", "Fecha Visita4",
    "Observacion Visita4", "Contador Visitas", "Nro Documento Destinatario", "Departamento Destinatario",
    "Provincia Destinatario", "Distrito Destinatario", "Fecha Recojo", "Coordenadas Entrega", "Telefono",
    "Bultos", "Ubigeo Origen", "Ubigeo Destino",
]
EXPORT_HEADER_OVERRIDES = {"Peso (Kg)": "Peso_kg"}

# Columns forced to text; the other eight keep their loaded type.
EXPORT_TEXT_COLUMNS = [
    "Nro_de_guia", "Estado", "Servicio", "Peso_kg", "Origen", "Destino", "Remitente", "Direccion_Origen",
    "Consignatario", "Direccion_Destino", "Observacion_Estado_Actual", "Doc_Cliente", "Trasnporte",
    "Obs_Adicional", "Nro_Pedido", "Nro_Consultora", "Ultima_Ocurrencia", "Descripcion",
    "Observacion_Visita1", "Observacion_Visita2", "Observacion_Visita3", "Observacion_Visita4",
    "Nro_Documento_Destinatario", "Departamento_Destinatario", "Provincia_Destinatario",
    "Distrito_Destinatario", "Coordenadas_Entrega", "Telefono", "Bultos", "Ubigeo_Origen", "Ubigeo_Destino",
]

# Export windows: 31 days including both ends, walked backwards from the run
# date while the window start is not before EXPORT_FLOOR.
EXPORT_WINDOW_DAYS = 31
EXPORT_FLOOR = "2023-07-01"

# Loaded types of the eight sheet columns that are not forced to text (all
# other headers are read as text from delimited files).
EXPORT_TYPED_HEADERS = {
    "Fecha": "timestamp_ntz", "Fecha de Entrega": "timestamp_ntz", "Fecha Visita1": "timestamp_ntz",
    "Fecha Visita2": "timestamp_ntz", "Fecha Visita3": "timestamp_ntz", "Fecha Visita4": "timestamp_ntz",
    "Contador Visitas": "bigint", "Fecha Recojo": "timestamp_ntz",
}

# A window's export is usable only with status 200 and this content type.
EXPORT_OK_STATUS = 200
EXPORT_CONTENT_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"
