import datetime as dt

from courierlake import config
from courierlake.operators.shape import cast_text, drop_empty_columns, normalise_headers, union_outer
from courierlake.plans.export_consolidation import asked_windows, consolidated_export
from courierlake.session import scratch_path
from courierlake.sources.landed import read_export_files
from tests.conftest import explain


def _land(spark, root):
    w1, w2, w3 = dt.date(2024, 3, 1), dt.date(2024, 2, 1), dt.date(2024, 1, 1)
    # newest window: 'Telefono' all NULL; older: has it; failed window: stale rows.
    spark.createDataFrame([("G1", 1.5, None, "x", w1)],
                          "`Nro de guia` string, `Peso (Kg)` double, Telefono string, `Canal Venta` string, "
                          "window_start date").write.partitionBy("window_start").parquet(f"{root}/data")
    spark.createDataFrame([("G2", 2.0, "999", w2)],
                          "`Nro de guia` string, `Peso (Kg)` double, Telefono string, window_start date") \
        .write.mode("append").partitionBy("window_start").parquet(f"{root}/data")
    spark.createDataFrame([("STALE", 9.0, "1", w3)],
                          "`Nro de guia` string, `Peso (Kg)` double, Telefono string, window_start date") \
        .write.mode("append").partitionBy("window_start").parquet(f"{root}/data")
    ok = config.EXPORT_CONTENT_TYPE
    spark.createDataFrame([(w1, w1, 200, ok), (w2, w2, 200, ok), (w3, w3, 200, "text/html")],
                          "window_start date, window_end date, http_status int, content_type string") \
        .write.parquet(f"{root}/manifest")


def test_consolidated_export_gates_orders_and_drops(spark):
    root = scratch_path(spark, "exports-test")
    _land(spark, root)
    out = consolidated_export(spark, root)
    assert out.columns == ["Nro_de_guia", "Peso_kg", "Canal Venta", "Telefono"]
    assert dict(out.dtypes)["Peso_kg"] == "string"
    assert sorted(tuple(r) for r in out.collect()) == [("G1", "1.5", "x", None), ("G2", "2.0", None, "999")]
    plan = explain(out)
    assert "dynamicpruning" in plan.lower() or "PartitionFilters: [isnotnull(window_start" in plan


def test_csv_windows_with_own_headers(spark, tmp_path):
    p1, p2 = str(tmp_path / "w0"), str(tmp_path / "w1")
    spark.createDataFrame([("G1", "3", "")], "`Nro de guia` string, `Peso (Kg)` string, `Obs Adicional` string") \
        .write.option("header", True).csv(p1)
    spark.createDataFrame([("G2", "Lima")], "`Nro de guia` string, Destino string").write.option("header", True).csv(p2)
    frames = read_export_files(spark, {0: p1, 1: p2})
    u = cast_text(normalise_headers(union_outer(frames)))
    out = drop_empty_columns(u, order_by="window_seq")
    assert out.columns == ["Nro_de_guia", "Peso_kg", "Destino"]
    assert sorted(tuple(r) for r in out.collect()) == [("G1", "3", None), ("G2", None, "Lima")]


def test_union_schema_from_manifest(spark):
    from pyspark.sql import types as T

    from courierlake.sources.landed import union_schema
    a = T.StructType([T.StructField("x", T.LongType()), T.StructField("y", T.StringType())])
    b = T.StructType([T.StructField("x", T.LongType()), T.StructField("z", T.DoubleType())])
    man = spark.createDataFrame([(a.json(),), (b.json(),), (a.json(),)], "schema string")
    u = union_schema(man)
    assert [f.name for f in u.fields] in (["x", "y", "z"], ["x", "z", "y"])
    assert dict((f.name, f.dataType) for f in u.fields) == {"x": T.LongType(), "y": T.StringType(),
                                                              "z": T.DoubleType()}


def test_asked_windows_follow_run_date_and_floor(spark):
    days = [dt.date(2024, 3, 1), dt.date(2024, 1, 30), dt.date(2023, 12, 30), dt.date(2023, 12, 20)]
    manifest = spark.createDataFrame([(d,) for d in days], "window_start date")
    def asked(**kw):
        return sorted(r[0] for r in asked_windows(manifest, "2024-03-31", **kw).collect())
    assert asked() == sorted(days[:3])
    assert asked(floor="2024-01-01") == sorted(days[:2])
    assert asked(floor=dt.date(2023, 12, 20), include_partial=True) == sorted(days)
    assert asked_windows(manifest, None).count() == 4


def test_common_types():
    from pyspark.sql import types as T

    from courierlake.operators.shape import common_type
    pairs = {("int", "bigint"): T.LongType(), ("bigint", "double"): T.DoubleType(), ("float", "decimal(9,2)"): T.DoubleType(),
             ("date", "timestamp_ntz"): T.TimestampNTZType(), ("bigint", "string"): T.StringType(),
             ("boolean", "bigint"): T.StringType(), ("void", "date"): T.DateType(), ("date", "double"): T.StringType()}
    for (a, b), want in pairs.items():
        a, b = (T.DataType.fromDDL(f"x {t}").fields[0].dataType for t in (a, b))
        assert common_type(a, b) == common_type(b, a) == want


UNLIKE = [  # newest window first: whole numbers, fractions, text, and a column of their own
    (dt.date(2024, 3, 1), [("G1", 3, 1, None)], "`Nro de guia` string, `Peso (Kg)` bigint, `Contador Visitas` bigint, Telefono string"),
    (dt.date(2024, 2, 1), [("G2", 2.5, 1.5)], "`Nro de guia` string, `Peso (Kg)` double, `Contador Visitas` double"),
    (dt.date(2024, 1, 1), [("G3", "x", "999")], "`Nro de guia` string, `Peso (Kg)` string, Telefono string"),
    (dt.date(2023, 12, 1), [("G4", 4, dt.date(2023, 12, 5))], "`Nro de guia` string, `Peso (Kg)` bigint, Fecha date"),
]


def _land_unlike(spark, root, recorded=lambda schema: schema):
    manifest = []
    for day, rows, ddl in UNLIKE:
        df = spark.createDataFrame(rows, ddl)
        df.write.parquet(f"{root}/data/window_start={day}")
        manifest.append((day, day, 200, config.EXPORT_CONTENT_TYPE, recorded(df.schema).json()))
    spark.createDataFrame(manifest, "window_start date, window_end date, http_status int, content_type string, schema string") \
        .write.parquet(f"{root}/manifest")


def test_windows_of_unlike_types(spark, tmp_path):
    root = str(tmp_path / "e")
    _land_unlike(spark, root)
    out = consolidated_export(spark, root)
    # Text is that of the window's own type; numbers meet in double.
    assert dict(out.dtypes) == {"Nro_de_guia": "string", "Peso_kg": "string", "Contador_Visitas": "double",
                                "Telefono": "string", "Fecha": "date"}
    assert sorted((r.Nro_de_guia, r.Peso_kg, r.Contador_Visitas, r.Telefono) for r in out.collect()) == [
        ("G1", "3", 1.0, None), ("G2", "2.5", 1.5, None), ("G3", "x", None, "999"), ("G4", "4", None, None)]
    assert out.columns == ["Nro_de_guia", "Peso_kg", "Contador_Visitas", "Telefono", "Fecha"]


def test_footers_agree_with_the_scan(spark, tmp_path, monkeypatch):
    from courierlake.plans import export_consolidation
    from courierlake.sources.landed import footer_firsts, schema_groups
    root = str(tmp_path / "e")
    _land_unlike(spark, root)
    groups = schema_groups(spark.read.parquet(f"{root}/manifest"))
    firsts = footer_firsts(spark, f"{root}/data", groups)
    day = lambda d: -(d - dt.date(1970, 1, 1)).days
    assert firsts == {"Nro de guia": day(UNLIKE[0][0]), "Peso (Kg)": day(UNLIKE[0][0]), "Contador Visitas": day(UNLIKE[0][0]),
                      "Telefono": day(UNLIKE[2][0]), "Fecha": day(UNLIKE[3][0])}
    by_footers = consolidated_export(spark, root)
    monkeypatch.setattr(export_consolidation, "footer_firsts", lambda *a, **k: None)
    by_scan = consolidated_export(spark, root)
    assert by_footers.columns == by_scan.columns and by_footers.exceptAll(by_scan).count() == 0


def test_a_schema_in_another_order_is_not_trusted(spark, tmp_path):
    from pyspark.sql import types as T

    from courierlake.sources.landed import footer_firsts, schema_groups
    root = str(tmp_path / "e")
    _land_unlike(spark, root, lambda s: T.StructType(s.fields[::-1]))
    groups = schema_groups(spark.read.parquet(f"{root}/manifest"))
    assert footer_firsts(spark, f"{root}/data", groups) is None
    assert sorted(r.Nro_de_guia for r in consolidated_export(spark, root).collect()) == ["G1", "G2", "G3", "G4"]


def test_delimited_windows_of_unlike_types(spark, tmp_path):
    from courierlake.plans.export_consolidation import consolidated_delimited_export
    root = str(tmp_path / "c")
    rows = [(dt.date(2024, 2, 1), "G1", "3", ["Nro de guia", "Contador Visitas"], None),
            (dt.date(2024, 1, 1), "G2", "2.5", ["Nro de guia", "Contador Visitas"], ["string", "double"])]
    for day, guia, n, header, _ in rows:
        spark.createDataFrame([(guia, n)], ", ".join(f"`{h}` string" for h in header)) \
            .write.option("header", True).csv(f"{root}/data/window_start={day}")
    spark.createDataFrame([(d, d, 200, config.EXPORT_CONTENT_TYPE, h, t) for d, _, _, h, t in rows],
                          "window_start date, window_end date, http_status int, content_type string, header array<string>, "
                          "types array<string>").write.parquet(f"{root}/manifest")
    out = consolidated_delimited_export(spark, root)
    assert sorted(map(tuple, out.collect())) == [("G1", 3.0), ("G2", 2.5)]


def test_rejected_windows(spark):
    from courierlake.sources.landed import rejected_windows, usable_windows
    ok = config.EXPORT_CONTENT_TYPE
    manifest = spark.createDataFrame([(1, 200, ok), (2, 500, ok), (3, 200, "text/html"), (4, None, ok), (5, 200, None),
                                      (6, 500, ok), (6, 200, ok)], "window_start int, http_status int, content_type string")
    assert sorted((r.window_start, r.reason) for r in rejected_windows(manifest).collect()) == [
        (2, "status"), (3, "content_type"), (4, "status"), (5, "content_type")]
    assert sorted(r[0] for r in usable_windows(manifest).collect()) == [1, 6]
