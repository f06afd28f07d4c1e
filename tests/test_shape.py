import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from courierlake import config
from courierlake.operators.shape import (cast_text, drop_empty_columns, export_header_map, flatten,
                                         header_rule, normalise_headers, pick, rename, union_outer)
from tests.conftest import rows


def test_flatten_nested_structs(spark):
    df = spark.createDataFrame([(1, (2, (3,)), [1])], "a int, b struct<c:int, d:struct<e:int>>, arr array<int>")
    out = flatten(df)
    assert out.columns == ["a", "b.c", "b.d.e", "arr"]
    assert flatten(df, sep="_").columns == ["a", "b_c", "b_d_e", "arr"]
    assert out.collect()[0][2] == 3


def test_pick_requires_columns_rename_ignores_absent(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert pick(df, ["b", "a"]).columns == ["b", "a"]
    with pytest.raises(KeyError):
        pick(df, ["a", "zz"])
    assert rename(df, {"a": "x", "zz": "y"}).columns == ["x", "b"]


def test_header_rule_reproduces_export_names():
    mapping = export_header_map()
    assert len(mapping) == 39
    assert mapping["Peso (Kg)"] == "Peso_kg"                  # the one override
    assert header_rule("Peso (Kg)") == "Peso_Kg"
    assert mapping["Doc. Cliente"] == "Doc_Cliente"
    assert mapping["Nro de guia"] == "Nro_de_guia"
    assert mapping["Fecha Visita1"] == "Fecha_Visita1"
    assert mapping["Trasnporte"] == "Trasnporte"
    assert set(config.EXPORT_TEXT_COLUMNS) <= set(mapping.values())
    kept = set(mapping.values()) - set(config.EXPORT_TEXT_COLUMNS)
    assert kept == {"Fecha", "Fecha_de_Entrega", "Fecha_Visita1", "Fecha_Visita2", "Fecha_Visita3",
                    "Fecha_Visita4", "Contador_Visitas", "Fecha_Recojo"}


def test_normalise_headers_keeps_unlisted_and_ignores_absent(spark):
    df = spark.createDataFrame([(1, "x", "y")], "`Peso (Kg)` int, `Doc. Cliente` string, `Canal Venta` string")
    assert normalise_headers(df).columns == ["Peso_kg", "Doc_Cliente", "Canal Venta"]


def test_cast_text_listed_present_only(spark):
    df = spark.createDataFrame([(1, 2.5, None)], "Peso_kg int, Other double, Bultos int")
    out = cast_text(df)
    assert dict(out.dtypes) == {"Peso_kg": "string", "Other": "double", "Bultos": "string"}
    assert out.collect()[0] == ("1", 2.5, None)


def test_union_outer_order_and_missing(spark):
    a = spark.createDataFrame([(1, 2)], "x int, z int")
    b = spark.createDataFrame([(3, 4)], "y int, x int")
    c = spark.createDataFrame([(5,)], "w int")
    u = union_outer([a, b, c])
    assert u.columns == ["x", "z", "y", "w"]
    assert rows(u) == sorted([(1, 2, None, None), (4, None, 3, None), (None, None, None, 5)], key=repr)
    with pytest.raises(ValueError):
        union_outer([])


def test_drop_empty_columns_set_and_order(spark):
    # window 0 (newest) lacks b; b first has a value in window 1; c never has one.
    df = spark.createDataFrame([(0, 1, None, None), (1, 2, 7, None), (1, None, 8, None)],
                               "w int, a int, b int, c string")
    out = drop_empty_columns(df, order_by="w")
    assert out.columns == ["a", "b"]
    out2 = drop_empty_columns(df.select("a", "b", "c"))
    assert out2.columns == ["a", "b"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 9)),
                          st.one_of(st.none(), st.integers(0, 9))), min_size=1, max_size=12))
def test_drop_after_union_equals_per_window_drop(spark, data):
    """P6 over the union decides the same column set as dropping per window
    and then taking the outer union (the feed's order of operations)."""
    df = spark.createDataFrame(data, "w int, a int, b int")
    one_pass = set(drop_empty_columns(df, order_by="w").columns)
    per_window = set()
    for w in sorted({d[0] for d in data}):
        part = [d for d in data if d[0] == w]
        per_window |= {c for i, c in ((1, "a"), (2, "b")) if any(p[i] is not None for p in part)}
    assert one_pass == per_window


def test_flatten_keeps_null_parent_as_null_leaves(spark):
    df = spark.createDataFrame([(None,)], "s struct<k:int>")
    assert flatten(df).select(F.col("`s.k`")).collect()[0][0] is None
