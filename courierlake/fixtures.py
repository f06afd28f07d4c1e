"""Feed-shaped views over the driver tables.

The feeds deliver vehicles, routes, visits, tracking keys, tracking documents,
JSON pages and spreadsheet exports; the test data holds TPC-H-like tables.
These views give the tables the feeds' shape, so every query reads the given
tables and its work grows with them. Unmatched keys, NULL keys, duplicates,
missing and NULL JSON fields, malformed bodies and bad stamps are made by
fixed rules on ids (the SQL oracle repeats them exactly).

All views are lazy DataFrame expressions. The feeds that arrive as landed
files in reality (tracking documents, export windows, routing pages) also
have ``land_*`` writers that put them below the shared checkpoint folder as
several files each; the registered queries read those files back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlake import config
from courierlake.functions.ranges import backward_windows, window_of
from courierlake.session import scratch_path, set_for_a_while, shuffles_dropped, table_path
from courierlake.sources.landed import parse_documents

# Movements of one customer are landed in pages of at most this many event ids,
# so no document (and no group that builds one) grows with a hot customer. This
# is a rule of the landing: a customer's events over several id blocks come as
# several documents, each repeating the shipment fields.
PAGE_EVENTS = 50_000
# Vehicle or route ids behind one routing page of a day.
PAGE_KEYS = 100

# Position of an outcome code among these is l_partkey % 23: 0..20 pick a
# code, 21 an unknown code, 22 a NULL code.
CODE_LIST = list(config.OUTCOME_LABELS)
UNKNOWN_CODE = "unknown-code"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(table_path(sf_dir, name))


def _s(c: Column) -> Column:
    return c.cast("string")


def _null(t: str) -> Column:
    return F.lit(None).cast(t)


# --- visit mart feed ------------------------------------------------------------

def vehicles_raw(customer: DataFrame) -> DataFrame:
    """One vehicle per customer, returned on three fetch days; on the third
    day every 50th vehicle is repainted (a second attribute version)."""
    day = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("fetch_day")
    base = customer.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", day)
    color = F.when((F.col("c_custkey") % 50 == 0) & (F.col("fetch_day") == 2),
                   F.concat(F.col("c_mktsegment"), F.lit("-repainted"))).otherwise(F.col("c_mktsegment"))
    return base.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                       color.alias("color"), F.col("c_acctbal").alias("capacity"), "fetch_day")


def routes_raw(orders: DataFrame, *more: str) -> DataFrame:
    """One route per order (every 13th landed twice); vehicle NULL on every
    11th, driver NULL on every 5th. With the columns ``more`` of the orders."""
    copies = F.explode(F.sequence(F.lit(0), F.when(F.col("o_orderkey") % 13 == 0, 1).otherwise(0)))
    o = orders.select("*", copies.alias("copy_no"))
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return o.select(
        *more,
        k.alias("id"),
        F.when(k % 11 == 0, _null("bigint")).otherwise(c).alias("vehicle"),
        F.when(k % 5 == 0, _null("bigint")).otherwise(c % 7).alias("driver"),
        F.col("o_orderpriority").alias("plan"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("date").alias("planned_date"),
        F.lit("08:00:00").alias("estimated_time_start"),
        F.lit("18:00:00").alias("estimated_time_end"),
        _s(k % 600).alias("total_duration"),
        F.col("o_totalprice").alias("total_distance"),
        c.cast("double").alias("total_load"),
        _null("double").alias("total_load_percentage"),
        F.concat(F.lit("Depot "), _s(c % 7)).alias("location_start_address"),
        F.lit(-12.0464).alias("location_start_latitude"),
        F.lit(-77.0428).alias("location_start_longitude"),
        F.concat(F.lit("Depot "), _s(c % 7)).alias("location_end_address"),
        F.lit(-12.0464).alias("location_end_latitude"),
        F.lit(-77.0428).alias("location_end_longitude"),
        _null("string").alias("start_time"),
        _null("string").alias("end_time"),
        stamp.alias("created"),
        stamp.alias("modified"),
        F.col("o_totalprice").alias("kilometers"),
        _null("bigint").alias("total_visits"),
        _null("double").alias("latitude_init"),
        _null("double").alias("longitude_init"),
        _null("double").alias("latitude_finish"),
        _null("double").alias("longitude_finish"),
        "copy_no",
    )


def observation_code(partkey: Column) -> Column:
    idx = (partkey % 23).cast("int")
    codes = F.array(*[F.lit(c) for c in CODE_LIST])
    return F.when(idx < len(CODE_LIST), F.try_element_at(codes, idx + 1)) \
        .when(idx == len(CODE_LIST), F.lit(UNKNOWN_CODE))


def visits_raw(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One visit per line item on the route of its order. The first line of
    each order carries driver -1 (no route matches); orders with a NULL route
    driver give visits with a NULL driver (matched NULL = NULL)."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    return _visits(lineitem.join(o, lineitem["l_orderkey"] == o["o_orderkey"], "inner"))


def _visits(lines: DataFrame, *more: str) -> DataFrame:
    """The visits of line items joined with their orders, with the columns ``more``."""
    pk, ln = F.col("l_partkey"), F.col("l_linenumber")
    return lines.select(
        *more,
        pk.alias("id"),
        ln.alias("order"),
        F.concat(F.lit("WYB"), _s(F.col("l_orderkey")), F.lit("-"), _s(ln)).alias("tracking_id"),
        F.when(F.col("l_linestatus") == "F", "completed").otherwise("pending").alias("status"),
        F.concat(F.lit("Visit "), _s(pk)).alias("title"),
        F.concat(F.lit("Street "), _s(F.col("l_suppkey"))).alias("address"),
        F.col("l_quantity").alias("latitude"),
        F.col("l_discount").alias("longitude"),
        _null("string").alias("contact_name"),
        _null("string").alias("contact_phone"),
        F.col("l_returnflag").alias("reference"),
        _null("string").alias("notes"),
        F.col("o_orderdate").cast("date").alias("planned_date"),
        F.col("l_orderkey").alias("route"),
        F.lit("08:00:00").alias("route_estimated_time_start"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("estimated_time_arrival"),
        _null("string").alias("estimated_time_departure"),
        _null("string").alias("checkin_time"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("checkout_time"),
        F.col("l_extendedprice").alias("checkout_latitude"),
        F.col("l_tax").alias("checkout_longitude"),
        F.when(F.col("l_returnflag") == "R", F.lit("returned")).alias("checkout_comment"),
        observation_code(pk).alias("checkout_observation"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("created"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("modified"),
        _null("string").alias("eta_predicted"),
        _null("string").alias("eta_current"),
        F.when(ln == 1, F.lit(-1).cast("bigint"))
         .when(F.col("o_orderkey") % 5 == 0, _null("bigint"))
         .otherwise(F.col("o_custkey") % 7).alias("driver"),
        F.col("o_custkey").alias("vehicle"),
        F.when(F.col("l_linestatus") == "O", "true").otherwise("false").alias("on_its_way"),
        F.col("o_orderpriority").alias("priority_level"),
        F.when(pk % 3 == 0, "true").otherwise("false").alias("geocode_alert"),
    )


def hot_visits(visits: DataFrame, orders: DataFrame) -> DataFrame:
    """The visits with a third of them (id % 3 = 0) on one route, the smallest
    that has a driver and a vehicle, and some (id % 7 = 1) without a route."""
    k = F.col("o_orderkey")
    hot = orders.where((k % 5 != 0) & (k % 11 != 0)).agg(
        F.min(F.struct(k, "o_custkey", F.col("o_orderdate").cast("date").alias("day"))).alias("r")).first()["r"]
    values = {"route": (hot and hot["o_orderkey"], "bigint"), "vehicle": (hot and hot["o_custkey"], "bigint"),
              "driver": (hot and hot["o_custkey"] % 7, "bigint"), "planned_date": (hot and hot["day"], "date")}
    on_hot = F.col("id") % 3 == 0
    out = visits.withColumns({c: F.when(on_hot, F.lit(v).cast(t)).otherwise(F.col(c)) for c, (v, t) in values.items()})
    return out.withColumn("route", F.when(on_hot | (F.col("id") % 7 != 1), F.col("route")))


# --- dated JSON feed --------------------------------------------------------------

def json_feed(events: DataFrame) -> DataFrame:
    """One landed response per event: ``[obj]`` normally; by event_id % 10:
    0 truncated, 1 status 500, 2 bare object, 3 ``[]``, 4 two objects (the
    second with ``"props": null``)."""
    m = F.col("event_id") % 10
    head = F.concat(F.lit('{"event_id": '), _s(F.col("event_id")),
                    F.lit(', "event_type": "'), F.col("event_type"), F.lit('", "props": '))
    obj = F.concat(head, F.col("props"), F.lit("}"))
    obj_null = F.concat(head, F.lit("null}"))
    body = (F.when(m == 0, F.concat(F.lit("["), obj))
            .when(m == 2, obj)
            .when(m == 3, F.lit("[]"))
            .when(m == 4, F.concat(F.lit("["), obj, F.lit(", "), obj_null, F.lit("]")))
            .otherwise(F.concat(F.lit("["), obj, F.lit("]"))))
    return events.select(F.lit("visits").alias("endpoint"),
                         F.col("ts").cast("date").alias("planned_date"),
                         F.when(m == 1, 500).otherwise(200).alias("http_status"),
                         body.alias("body"))


def json_feed_defects(events: DataFrame, defects: bool = True) -> DataFrame:
    """One page per event, ``[obj]``, by event_id % 10: 5 with an object that no
    schema declares (``extra``, with an object in it), and 7 with one more field
    in ``props``. With ``defects``, besides the object of the page: 0 a text for
    its id, 1 a fraction for its id, 2 a JSON null behind it, 3 a number behind
    it, 4 ``props.k`` as text, 6 text behind the array."""
    m = F.col("event_id") % 10
    e, k = _s(F.col("event_id")), F.get_json_object("props", "$.k")

    def obj(event_id: Column, props: Column, more: str = "") -> Column:
        return F.concat(F.lit('{"event_id": '), event_id, F.lit(', "event_type": "'), F.col("event_type"),
                        F.lit('", "props": '), props, F.lit(more + "}"))

    plain = F.concat(F.lit('{"k": '), k, F.lit("}"))
    extra = ', "extra": {"note": "seen", "geo": {"lat": 1.5}}'
    good = F.when(m == 5, obj(e, plain, extra)).when(
        m == 7, obj(e, F.concat(F.lit('{"k": '), k, F.lit(', "unit": "u'), _s(F.col("event_id") % 3), F.lit('"}')))) \
        .otherwise(obj(e, plain))
    page = F.concat(F.lit("["), good, F.lit("]"))
    if defects:
        more = (F.when(m == 0, obj(F.concat(F.lit('"x'), e, F.lit('"')), plain))
                .when(m == 1, obj(F.concat(e, F.lit(".5")), plain))
                .when(m == 2, F.lit("null")).when(m == 3, e)
                .when(m == 4, obj(e, F.lit('{"k": "none"}'))))
        page = F.when(m == 6, F.concat(page, F.lit(" tail"))).when(
            more.isNotNull(), F.concat(F.lit("["), good, F.lit(", "), more, F.lit("]"))).otherwise(page)
    return events.select(F.lit("visits").alias("endpoint"), F.col("ts").cast("date").alias("planned_date"),
                         F.lit(200).alias("http_status"), page.alias("body"))


# Lines and orders dealt by blocks are joined by order as they lie. The aggregate of a page takes
# the order of its rows: a hash aggregate would fall back on sorting the objects' text.
ROWS_AS_DEALT = {"spark.sql.requireAllClusterKeysForCoPartition": "false",
                 "spark.sql.execution.useObjectHashAggregateExec": "false"}


def routing_pages(customer: DataFrame, orders: DataFrame, lineitem: DataFrame, files: int) -> dict[str, DataFrame]:
    """Landed responses of the routing feed's three endpoints
    (``planned_date, http_status, body`` of each): the objects of a day come
    in pages by blocks of PAGE_KEYS vehicle or route ids. Vehicles are listed on
    three fetch days (1998-01-01..03); routes and visits on their planned day.
    NULL fields are left out of the object, as the feed omits them.

    Every 10th vehicle is also in pages that must not be read, under another
    name: status 500, no status, cut off, and days outside 1990..2030; each of
    its days has an empty page too.

    Rows are dealt to ``files`` partitions and sorted by day while they are the
    columns of the tables; the objects are written behind that, so no page is
    moved or sorted as text under the settings ``ROWS_AS_DEALT``.
    """
    def block(key: str) -> Column:
        return F.expr(f"`{key}` div {PAGE_KEYS}")

    def by_day(rows: DataFrame) -> DataFrame:
        return rows.sortWithinPartitions("__day", "__block")

    def dealt(rows: DataFrame, day: Column, key: str) -> DataFrame:
        return by_day(rows.select("*", day.alias("__day"), block(key).alias("__block")).repartition(files, "__day", "__block"))

    def pages(rows: DataFrame) -> DataFrame:
        obj = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c not in ("__day", "__block")]))
        body = F.concat(F.lit("["), F.array_join(F.collect_list("obj"), ", "), F.lit("]"))
        return rows.select("__day", "__block", obj.alias("obj")).groupBy("__day", "__block").agg(body.alias("body")) \
            .select(F.col("__day").alias("planned_date"), F.lit(200).alias("http_status"), "body")

    def unusable() -> DataFrame:
        c = F.col("c_custkey")
        obj = F.concat(F.lit('{"id": '), _s(c), F.lit(', "name": "stray"}'))
        page, day = F.concat(F.lit("["), obj, F.lit("]")), F.lit("1998-01-02").cast("date")
        kinds = [(day, F.lit(500), page), (day, _null("int"), page), (day, F.lit(200), F.concat(F.lit("["), obj)),
                 (day, F.lit(200), F.lit("[]")), (F.lit("1989-12-31").cast("date"), F.lit(200), page),
                 (F.lit("2031-01-01").cast("date"), F.lit(200), page)]
        kind = F.explode(F.array(*[F.struct(d.alias("planned_date"), s.alias("http_status"), b.alias("body"))
                                   for d, s, b in kinds]))
        return customer.where(c % 10 == 0).select(kind.alias("p")).select("p.*") \
            .repartition(files, "planned_date", "body").sortWithinPartitions("planned_date")

    vehicles = dealt(vehicles_raw(customer), F.date_add(F.lit("1998-01-01").cast("date"), F.col("fetch_day")), "id")
    day = F.col("o_orderdate").cast("date")
    # Lines and orders meet where the pages of their block are: each moves once.
    lines = lineitem.withColumn("__of", block("l_orderkey")).repartition(files, "__of")
    of = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", day.alias("__day"),
                       block("o_orderkey").alias("__block")).repartition(files, "__block")
    lines = lines.join(of, (lines["__of"] == of["__block"]) & (lines["l_orderkey"] == of["o_orderkey"]))
    return {"vehicles": pages(vehicles).unionByName(unusable()),
            "routes": pages(routes_raw(dealt(orders, day, "o_orderkey"), "__day", "__block").drop("copy_no")),
            "visits": pages(_visits(by_day(lines), "__day", "__block"))}


def land_routing_pages(spark: SparkSession, customer: DataFrame, orders: DataFrame, lineitem: DataFrame,
                       root: str | None = None) -> str:
    """Write the routing pages below the checkpoint folder, partitioned by
    endpoint and clustered by day inside each file (so a day-range predicate
    skips row groups); returns the path."""
    root = root or scratch_path(spark, "routing-pages")
    # A hot day is spread over all files by its blocks; as many as any exchange has, so that none is
    # put behind the dealt rows. Shuffle files go with each endpoint.
    files = max(landing_files(spark), *[int(spark.conf.get(k, "1")) for k in (
        "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")])
    with shuffles_dropped(spark), set_for_a_while(spark, ROWS_AS_DEALT):
        for endpoint, pages in routing_pages(customer, orders, lineitem, files).items():
            pages.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/endpoint={endpoint}")
    return root


# --- tracking feed --------------------------------------------------------------------

def tracking_number(custkey: Column) -> Column:
    prefix = F.when(custkey % 4 == 3, F.lit("XQZ")).otherwise(F.lit(config.TRACKING_PATTERN))
    return F.concat(prefix, F.lpad(_s(custkey), 9, "0"))


def tracking_keys(customer: DataFrame) -> DataFrame:
    """Key table: one key per customer (every 5th listed twice), creation date
    spread around the lower bound, every 4th key without the pattern."""
    c = F.col("c_custkey")
    copies = F.explode(F.sequence(F.lit(0), F.when(c % 5 == 0, 1).otherwise(0)))
    return customer.select(tracking_number(c).alias("tracking_num"),
                           F.date_add(F.lit("2024-03-15").cast("date"), (c % 45).cast("int")).alias("creation_dt"),
                           copies.alias("copy_no"))


def _time_texts(event_id: Column, ts: Column) -> tuple[Column, Column]:
    m = event_id % 10
    fecha = (F.when(m == 1, F.date_format(ts, "y-M-d"))
             .when(m == 5, _null("string"))
             .when(m == 6, F.concat(F.date_format(ts, "yyyy"), F.lit("-02-30")))
             .otherwise(F.date_format(ts, "yyyy-MM-dd")))
    hora = (F.when(m == 0, F.lit(""))
            .when(m == 1, F.date_format(ts, "H:m:s"))
            .when(m == 2, F.date_format(ts, "HH:mm:ss.SSSSSS"))
            .when(m == 3, F.lit("24:00:00"))
            .when(m == 4, F.concat(F.lit(" "), F.date_format(ts, "HH:mm:ss")))
            .when(m == 7, F.date_format(ts, "HH:mm"))
            .otherwise(F.date_format(ts, "HH:mm:ss")))
    return fecha, hora


def split_times(events: DataFrame) -> DataFrame:
    """Date and time text of every event, with one variant per event_id % 10:
    0 empty time, 1 unpadded fields, 2 fractional seconds, 3 hour 24,
    4 doubled blank, 5 NULL date, 6 Feb 30, 7 no seconds, 8-9 plain."""
    fecha, hora = _time_texts(F.col("event_id"), F.col("ts"))
    return events.select("event_id", "user_id", "event_type", "ts", fecha.alias("fecha"), hora.alias("hora"))


def _jstr(c: Column) -> Column:
    """JSON text of a string value (NULL -> null). Values here never need escapes."""
    return F.when(c.isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), c, F.lit('"')))


def _field(name: str, json_value: Column, missing: Column | None = None) -> Column:
    """``"name": value``, or NULL (left out by concat_ws) when ``missing``."""
    pair = F.concat(F.lit(f'"{name}": '), json_value)
    return pair if missing is None else F.when(~missing, pair)


def _object(*pairs: Column) -> Column:
    return F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}"))


def movement_json(e: Column, u: Column, event_type: Column, ts: Column) -> Column:
    fecha, hora = _time_texts(e, ts)
    return _object(
        _field("secuencia", _s(e)),
        _field("codigo", _jstr(event_type)),
        _field("estado", _jstr(F.concat(F.lit("E-"), event_type))),
        _field("sub_estado", _jstr(F.concat(F.lit("S"), _s(e % 4))), missing=(e % 3 == 0)),
        _field("detalle_estado", F.when(e % 5 == 0, F.lit("null"))
               .otherwise(_jstr(F.concat(F.lit("detail "), event_type)))),
        _field("fecha", _jstr(fecha)),
        _field("hora", _jstr(hora)),
        _field("apuntes", _jstr(F.concat(F.lit("note "), _s(u % 13)))),
        _field("dir_agencia", _jstr(F.concat(F.lit("Av "), _s(u % 9))), missing=(e % 4 == 1)),
        _field("n_visita", _s(1 + e % 3)),
    )


def movement_pages(events: DataFrame) -> DataFrame:
    """Movement arrays per (customer, page of PAGE_EVENTS event ids): the
    group behind one landed document is bounded by PAGE_EVENTS rows whatever
    the customer's share of events."""
    # The group moves the columns behind a movement; its JSON text is made there.
    pages = events.groupBy("user_id", F.expr(f"event_id div {PAGE_EVENTS}").alias("page")).agg(
        F.collect_list(F.struct("event_id", "event_type", "ts")).alias("items"))

    def item(e: Column) -> Column:
        return F.struct(e["event_id"].alias("event_id"),
                        movement_json(e["event_id"], F.col("user_id"), e["event_type"], e["ts"]).alias("mv"))

    items = pages.select("user_id", "page", F.sort_array(F.transform("items", item)).alias("items"))
    return items.select("user_id", "page",
                        F.concat(F.lit("["), F.array_join(F.col("items.mv"), ", "), F.lit("]")).alias("movements"))


def tracking_documents(customer: DataFrame, events: DataFrame) -> DataFrame:
    """Landed documents ``(guia, page, http_status, body)``.

    Parent objects by c_custkey % 7: 0 absent, 1 JSON null, 2 all leaves null,
    else filled (cliente.telefono always absent). tracking_number null when
    c_custkey % 9 == 4. Customers without events get one page whose
    movement array is, by c_custkey % 3: 0 empty, 1 absent, 2 null.
    Status 500 when c_custkey % 17 == 5; truncated body when % 19 == 7;
    ``{}`` when % 23 == 11.
    """
    pages = movement_pages(events)
    c = customer.join(pages, customer["c_custkey"] == pages["user_id"], "left")
    k, nat, seg = F.col("c_custkey"), F.col("c_nationkey"), F.col("c_mktsegment")
    m7 = k % 7
    guia = tracking_number(k)

    def parent(name: str, filled: list[tuple[str, Column]], leaves: list[str]) -> Column:
        full = _object(*[_field(f, v) for f, v in filled])
        nulls = _object(*[_field(f, F.lit("null")) for f in leaves])
        value = F.when(m7 == 1, F.lit("null")).when(m7 == 2, nulls).otherwise(full)
        return _field(name, value, missing=(m7 == 0))

    day = F.lpad(_s(1 + k % 28), 2, "0")
    servicio = parent("servicio", [("contrato", _jstr(F.concat(F.lit("C"), _s(k % 10)))),
                                   ("origen", _jstr(F.lit("LIM"))),
                                   ("admitido", _jstr(F.concat(F.lit("2024-04-"), day)))],
                      ["contrato", "origen", "admitido"])
    cliente = parent("cliente", [("codigo", _jstr(_s(k))), ("nombre", _jstr(F.col("c_name")))],
                     ["codigo", "nombre", "telefono"])
    direccion = parent("direccion_entrega",
                       [("direccion", _jstr(F.concat(F.lit("Calle "), _s(nat)))),
                        ("referencia", _jstr(seg)),
                        ("ciudad", _jstr(F.lit("LIMA"))),
                        ("zona", _jstr(_s(nat % 5))),
                        ("agencia", _jstr(F.concat(F.lit("AG"), _s(nat))))],
                       ["direccion", "referencia", "ciudad", "zona", "agencia"])
    hora = F.concat(_s(k % 24), F.lit(":"), F.lpad(_s(k % 60), 2, "0"), F.lit(":00"))
    estado = parent("estado_actual",
                    [("estado", _jstr(seg)),
                     ("Detalle_Estado", _jstr(F.concat(F.lit("det "), seg))),
                     ("fecha", _jstr(F.concat(F.lit("2024-04-"), day))),
                     ("hora", _jstr(hora))],
                    ["estado", "Detalle_Estado", "fecha", "hora"])
    no_events = F.col("movements").isNull()
    movements = F.when(~no_events, F.col("movements")) \
        .when(k % 3 == 0, F.lit("[]")).when(k % 3 == 2, F.lit("null"))
    doc = _object(
        _field("guia_ue", _jstr(guia)),
        _field("tracking_number", F.when(k % 9 == 4, F.lit("null"))
               .otherwise(_jstr(F.concat(F.lit("TN"), _s(k))))),
        servicio, cliente, direccion, estado,
        _field("movimiento", movements, missing=(no_events & (k % 3 == 1))),
    )
    body = (F.when(k % 19 == 7, F.concat(F.lit('{"guia_ue": "'), guia))
            .when(k % 23 == 11, F.lit("{}"))
            .otherwise(doc))
    return c.select(guia.alias("guia"), F.coalesce(F.col("page"), F.lit(0).cast("bigint")).alias("page"),
                    F.when(k % 17 == 5, 500).otherwise(200).alias("http_status"), body.alias("body"))


def landing_files(spark: SparkSession) -> int:
    """Files a landing write produces: enough for every core to read one.
    (AQE would coalesce a small landing into one file, whose single row group
    is then read by one task however CPU-heavy the rows are.)"""
    return 2 * spark.sparkContext.defaultParallelism


def land_documents(spark: SparkSession, customer: DataFrame, events: DataFrame,
                   root: str | None = None) -> str:
    """Write the tracking documents as the lookup lands them (one row per
    response: ``guia, page, http_status, body`` plus the body parsed once
    into the VARIANT ``doc``) below the checkpoint folder; returns the path."""
    root = root or scratch_path(spark, "documents")
    # Hash on (key, page): the pages of a hot key spread over several files. Parsed
    # behind the shuffle, which moves the bodies alone.
    parse_documents(tracking_documents(customer, events).repartition(landing_files(spark), "guia", "page")).write.mode("overwrite").parquet(root)
    return root


# --- export feed ----------------------------------------------------------------------

def export_bounds(orders: DataFrame) -> tuple:
    """Run date and floor of the export windows: newest and oldest order day
    (one aggregate row, two scalars)."""
    row = orders.agg(F.max(F.col("o_orderdate").cast("date")).alias("run"),
                     F.min(F.col("o_orderdate").cast("date")).alias("floor")).first()
    return row["run"], row["floor"]


def export_rows(orders: DataFrame, run_date, floor) -> DataFrame:
    """Export rows under the sheet's raw headers, with their window.

    Orders older than the oldest whole window are in no window. Column
    variants: ``Obs Adicional`` NULL in every 3rd window, ``Coordenadas
    Entrega``, ``Fecha Visita4``, ``Observacion Visita3`` and ``Observacion
    Visita4`` NULL everywhere, ``Canal`` an extra column not in the sheet
    list. (``Telefono`` is left out of every 4th window by the writer, which
    also writes ``Peso (Kg)`` and ``Contador Visitas`` of every 5th as the
    fractions that only those sheets hold.)
    """
    run, flo = F.lit(run_date).cast("date"), F.lit(floor).cast("date")
    seq = window_of("o_orderdate", run, flo)
    k, c, d = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    rows = orders.where(F.col("o_orderdate") >= F.lit(floor).cast("timestamp_ntz")) \
        .withColumn("window_seq", seq).where(F.col("window_seq").isNotNull())
    days = lambda n: d + F.expr(f"INTERVAL {n} DAYS")
    cols = {
        "Nro de guia": F.concat(F.lit("G"), _s(k)),
        "Fecha": d,
        "Estado": F.col("o_orderstatus"),
        "Servicio": F.col("o_orderpriority"),
        "Peso (Kg)": c % 50,
        "Origen": F.lit("LIM"),
        "Destino": F.concat(F.lit("DST"), _s(c % 25)),
        "Remitente": F.concat(F.lit("Seller "), _s(c % 11)),
        "Direccion Origen": F.lit("Av Principal 100"),
        "Consignatario": F.concat(F.lit("Customer "), _s(c)),
        "Direccion Destino": F.concat(F.lit("Calle "), _s(c % 97)),
        "Fecha de Entrega": days(3),
        "Observacion Estado Actual": F.col("o_orderpriority"),
        "Doc. Cliente": F.concat(F.lit("DOC"), _s(k)),
        "Trasnporte": F.when(k % 2 == 0, "MOTO").otherwise("VAN"),
        "Obs Adicional": F.when(F.col("window_seq") % 3 != 0, F.concat(F.lit("obs "), F.col("o_orderstatus"))),
        "Nro Pedido": k,
        "Nro Consultora": c,
        "Ultima Ocurrencia": F.col("o_orderstatus"),
        "Descripcion": F.concat(F.lit("Order "), _s(k)),
        "Fecha Visita1": days(1),
        "Observacion Visita1": F.lit("ok"),
        "Fecha Visita2": F.when(k % 3 == 0, days(2)),
        "Observacion Visita2": F.when(k % 3 == 0, F.lit("retry")),
        "Fecha Visita3": F.when(k % 7 == 0, days(4)),
        "Observacion Visita3": _null("string"),
        "Fecha Visita4": _null("timestamp_ntz"),
        "Observacion Visita4": _null("string"),
        "Contador Visitas": k % 4,
        "Nro Documento Destinatario": F.lpad(_s(c), 8, "0"),
        "Departamento Destinatario": F.lit("LIMA"),
        "Provincia Destinatario": F.lit("LIMA"),
        "Distrito Destinatario": F.concat(F.lit("D"), _s(c % 43)),
        "Fecha Recojo": d,
        "Coordenadas Entrega": _null("string"),
        "Telefono": F.concat(F.lit("9"), F.lpad(_s(c), 8, "0")),
        "Bultos": 1 + k % 3,
        "Ubigeo Origen": F.lit("150101"),
        "Ubigeo Destino": F.concat(F.lit("1501"), F.lpad(_s(c % 43), 2, "0")),
        "Canal": F.when(k % 2 == 0, "WEB").otherwise("APP"),
    }
    start = F.date_sub(F.date_sub(run, F.col("window_seq") * 31), 30)
    return rows.select(*[v.alias(n) for n, v in cols.items()], F.col("window_seq"),
                       start.alias("window_start"))


def fractions(rows: DataFrame) -> DataFrame:
    """Rows of windows whose sheets hold fractions where others hold whole numbers."""
    return rows.withColumns({"Peso (Kg)": F.col("`Peso (Kg)`") + F.lit(0.5),
                             "Contador Visitas": F.col("Contador Visitas") + F.lit(0.25)})


def sheet_kinds(rows: DataFrame) -> dict[int, DataFrame]:
    """The four kinds of sheets by window: 1 without ``Telefono``, 2 with
    fractions, 3 both, 0 neither."""
    out = {}
    for k in range(4):
        df = rows.where(sheet_kind(F.col("window_seq")) == k).drop("window_seq", *(["Telefono"] if k & 1 else []))
        out[k] = fractions(df) if k & 2 else df
    return out


def sheet_kind(seq: Column) -> Column:
    return (F.when(seq % 4 == 1, 1).otherwise(0) + F.when(seq % 5 == 2, 2).otherwise(0)).cast("int")


def export_manifest(orders: DataFrame, run_date, floor) -> DataFrame:
    """One response row per requested window: status 500 for every 9th
    window, an HTML page for every 11th, a spreadsheet otherwise."""
    bounds = orders.sparkSession.createDataFrame([(run_date, floor)], "run_date date, floor date")
    w = backward_windows(bounds)
    k = F.col("window_seq")
    return w.select("window_start", "window_end",
                    F.when(k % 9 == 8, 500).otherwise(200).alias("http_status"),
                    F.when(k % 11 == 10, F.lit("text/html; charset=UTF-8"))
                    .otherwise(F.lit(config.EXPORT_CONTENT_TYPE)).alias("content_type"))


def land_exports_csv(spark: SparkSession, orders: DataFrame, root: str | None = None) -> str:
    """The export feed as delimited files: ``root/data/window_start=<date>/``
    holds CSV with a header line per file (sheets of the four
    :func:`sheet_kinds`); ``root/manifest`` holds each window's response, its
    header and the types of its columns (the landing records what it wrote)."""
    root = root or scratch_path(spark, "exports-csv")
    run_date, floor = export_bounds(orders)
    rows = export_rows(orders, run_date, floor).hint("rebalance", "window_start")
    headers, types = {}, {}
    for kind, df in sheet_kinds(rows).items():
        headers[kind] = [c for c in df.columns if c != "window_start"]
        # Sheet columns that are not typed in the declared list are text in the file.
        declared = config.EXPORT_TYPED_HEADERS
        types[kind] = [df.schema[c].dataType.simpleString() if c in declared and c != "Fecha Visita4"
                       else declared.get(c, "string") for c in headers[kind]]
        df.write.mode("append" if kind else "overwrite").partitionBy("window_start") \
            .option("header", "true").csv(f"{root}/data")
    man = export_manifest(orders, run_date, floor)
    kind = sheet_kind(F.datediff(F.lit(run_date).cast("date"), F.col("window_end")) / 31)
    def of_kind(lists):
        return F.element_at(F.array(*[F.array(*[F.lit(x) for x in lists[k]]) for k in range(4)]), kind + 1)
    man = man.withColumn("header", of_kind(headers)).withColumn("types", of_kind(types))
    man.write.mode("overwrite").parquet(f"{root}/manifest")
    return root


def land_exports(spark: SparkSession, orders: DataFrame, root: str | None = None) -> str:
    """Land the export feed below the checkpoint folder and return its root:
    ``root/data`` holds Parquet files under ``window_start=<date>/`` (sheets
    of the four :func:`sheet_kinds`); ``root/manifest`` holds
    the response and the written schema of every requested window. Files of
    every window are present (as left by earlier runs); the manifest says
    which are usable."""
    root = root or scratch_path(spark, "exports")
    run_date, floor = export_bounds(orders)
    # Rebalance on the window so each window lands as few files (AQE splits a
    # large window and packs small ones) instead of one file per task per window.
    rows = export_rows(orders, run_date, floor).hint("rebalance", "window_start")
    kinds = sheet_kinds(rows)
    for kind, df in kinds.items():
        df.write.mode("append" if kind else "overwrite").partitionBy("window_start").parquet(f"{root}/data")
    # The manifest records each window's written schema, so readers need no
    # footer-merging pass.
    kind = sheet_kind(F.datediff(F.lit(run_date).cast("date"), F.col("window_end")) / 31)
    man = export_manifest(orders, run_date, floor).withColumn("schema", F.element_at(
        F.array(*[F.lit(kinds[k].drop("window_start").schema.json()) for k in range(4)]), kind + 1))
    man.write.mode("overwrite").parquet(f"{root}/manifest")
    return root
