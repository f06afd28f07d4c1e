import datetime as dt

from courierlake import config
from courierlake.operators.history import explode_movements, latest_by_code
from courierlake.plans.movement_history import movement_history
from courierlake.sources.landed import parse_documents

FULL = ('{"guia_ue": "G1", "tracking_number": "T1",'
        ' "servicio": {"contrato": "C", "origen": "O", "admitido": "A"},'
        ' "cliente": {"codigo": "1", "nombre": null},'
        ' "direccion_entrega": null,'
        ' "estado_actual": {"estado": "E", "Detalle_Estado": "D", "fecha": "2024-04-02", "hora": "9:05:00"},'
        ' "movimiento": [{"secuencia": 1, "codigo": "SS", "fecha": "2024-04-01", "hora": "10:00:00"},'
        '                {"secuencia": 2, "codigo": "AO", "fecha": "2024-04-01", "hora": "",'
        '                 "detalle_estado": null},'
        '                {"secuencia": 3, "codigo": "SS", "fecha": null, "hora": "11:00:00"}]}')


def _docs(spark, bodies):
    raw = spark.createDataFrame([(f"G{i}", 200, b) for i, b in enumerate(bodies)],
                                "guia string, http_status int, body string")
    return parse_documents(raw)


def test_explode_movements_fields_and_defaults(spark):
    out = explode_movements(_docs(spark, [FULL]), "doc").orderBy("movimiento_secuencia").collect()
    expected_cols = [n for n, _, _ in config.SHIPMENT_FIELDS if n not in config.STATUS_DATE_PARTS] + \
        [n for n, _ in config.MOVEMENT_FIELDS] + [config.STATUS_STAMP_COLUMN]
    assert list(out[0].asDict()) == expected_cols and len(expected_cols) == 25
    r = out[0]
    assert (r.servicio_contrato, r.cliente_codigo, r.cliente_nombre, r.cliente_telefono) == ("C", "1", None, "")
    assert r.direccion_entrega == "" and r.direccion_entrega_zona == ""        # null parent -> ''
    assert r.estado_actual_fecha_hora == dt.datetime(2024, 4, 2, 9, 5)
    assert [x.movimiento_fecha for x in out] == [dt.datetime(2024, 4, 1, 10), None, None]
    assert [x.movimiento_detalle_estado for x in out] == ["", None, ""]
    assert [x.movimiento_secuencia for x in out] == ["1", "2", "3"]
    assert out[0].movimiento_sub_estado == "" and out[0].movimiento_n_visita == ""


def test_explode_movements_no_rows_for_missing_null_empty_arrays(spark):
    bodies = ['{"guia_ue": "a"}', '{"guia_ue": "b", "movimiento": null}', '{"guia_ue": "c", "movimiento": []}',
              '{"guia_ue": "d", "movimiento": [{}]}']
    out = explode_movements(_docs(spark, bodies), "doc").collect()
    assert [r.guia_ue for r in out] == ["d"]
    assert out[0].movimiento_codigo == "" and out[0].movimiento_fecha is None
    assert out[0].servicio_contrato == "" and out[0].estado_actual_fecha_hora is None


def test_date_only_quirk_gives_null_movement_stamps(spark):
    out = explode_movements(_docs(spark, [FULL]), "doc", with_time=False).collect()
    assert all(r.movimiento_fecha is None for r in out)


def test_movement_history_selects_keys_and_gates(spark):
    raw = spark.createDataFrame([("G0", 200, FULL), ("G1", 200, FULL), ("G2", 500, FULL), ("G3", 200, "{}")],
                                "guia string, http_status int, body string")
    keys = spark.createDataFrame([("G0",), ("G2",), ("G3",), ("G9",)], "tracking string")
    out = movement_history(keys, raw)
    assert out.count() == 3


def test_latest_by_code_drops_null_index_and_values(spark):
    t = dt.datetime
    df = spark.createDataFrame([
        ("a", "x", "SS", t(2024, 1, 1)), ("a", "x", "SS", t(2024, 1, 3)), ("a", "x", "AO", None),
        ("a", None, "SS", t(2024, 1, 5)), ("b", "", "EN", t(2024, 1, 2)), ("c", "y", "AO", None),
    ], "g string, h string, code string, ts timestamp_ntz")
    out = latest_by_code(df, ["g", "h"], "code", "ts", ["SS", "AO", "EN"], config.PIVOT_RENAMES)
    assert out.columns == ["g", "h", "fecha_SS", "fecha_AO", "fecha_EN"]
    got = sorted(tuple(r) for r in out.collect())
    assert got == [("a", "x", t(2024, 1, 3), None, None), ("b", "", None, None, t(2024, 1, 2))]


def test_latest_by_code_discovers_codes_and_drops_all_null_codes(spark):
    t = dt.datetime
    df = spark.createDataFrame([
        ("a", "SS", t(2024, 1, 1)), ("a", "AO", t(2024, 1, 2)), ("b", "ZZ", None), ("b", "SS", t(2024, 1, 4)),
    ], "g string, code string, ts timestamp_ntz")
    out = latest_by_code(df, ["g"], "code", "ts", None, config.PIVOT_RENAMES)
    assert sorted(out.columns) == ["fecha_AO", "fecha_SS", "g"]        # ZZ has only NULL values
    assert sorted(tuple(r) for r in out.select("g", "fecha_SS", "fecha_AO").collect()) == [
        ("a", t(2024, 1, 1), t(2024, 1, 2)), ("b", t(2024, 1, 4), None)]
