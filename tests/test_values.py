import datetime as dt

import pytest
from pyspark.sql import functions as F

from courierlake import config
from courierlake.functions.values import join_text, label_codes, parse_stamp, path_or_default


def test_label_codes_known_shared_unknown_null(spark):
    codes = list(config.OUTCOME_LABELS)
    shared = [c for c, l in config.OUTCOME_LABELS.items() if l == "Entregado a titular"]
    assert len(shared) == 2 and len(codes) == 21 and len(set(config.OUTCOME_LABELS.values())) == 20
    df = spark.createDataFrame([(codes[0],), (shared[0],), (shared[1],), ("nope",), (None,), ("",)], "c string")
    got = [r.l for r in df.select(label_codes("c").alias("l")).collect()]
    assert got == [config.OUTCOME_LABELS[codes[0]], "Entregado a titular", "Entregado a titular",
                   "Otro", "Otro", "Otro"]


def test_label_codes_custom_mapping_and_empty(spark):
    df = spark.createDataFrame([("a",), ("b",)], "c string")
    assert [r.l for r in df.select(label_codes("c", {"a": "A"}, "D").alias("l")).collect()] == ["A", "D"]
    assert [r.l for r in df.select(label_codes("c", {}, "D").alias("l")).collect()] == ["D", "D"]


def test_join_text_null_propagates(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), ("", "")], "x string, y string")
    assert [r.t for r in df.select(join_text("x", "y").alias("t")).collect()] == ["a b", None, " "]


STAMPS = [
    ("2024-04-01 10:00:00", dt.datetime(2024, 4, 1, 10, 0, 0)),
    ("2024-4-1 9:5:3", dt.datetime(2024, 4, 1, 9, 5, 3)),
    ("2024-04-01  10:00:00", dt.datetime(2024, 4, 1, 10, 0, 0)),   # doubled blank
    ("2024-04-01 10:00:00 ", None),                                # trailing blank
    (" 2024-04-01 10:00:00", None),
    ("2024-04-01T10:00:00", None),
    ("2024-04-01 24:00:00", None),
    ("2024-04-01 10:60:00", None),
    ("2024-04-01 10:00:60", None),
    ("2024-02-30 10:00:00", None),
    ("2024-02-29 23:59:59", dt.datetime(2024, 2, 29, 23, 59, 59)),
    ("2023-02-29 10:00:00", None),
    ("2024-04-01 10:00", None),                                    # no seconds
    ("2024-04-01 10:00:00.5", None),                               # fraction
    ("2024-04-01 ", None),                                         # empty time part
    ("24-04-01 10:00:00", None),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("tz", ["UTC", "America/New_York"])
def test_parse_stamp_cases_any_zone(spark, tz):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        data = STAMPS + [("2024-03-10 02:30:00", dt.datetime(2024, 3, 10, 2, 30))]  # DST gap in New York
        df = spark.createDataFrame([(s,) for s, _ in data], "s string")
        got = [r.t for r in df.select(parse_stamp("s").alias("t")).collect()]
        assert got == [e for _, e in data]
        assert dict(df.select(parse_stamp("s").alias("t")).dtypes)["t"] == "timestamp_ntz"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_parse_stamp_date_only_format_never_matches_time_text(spark):
    df = spark.createDataFrame([("2024-04-01 10:00:00",), ("2024-04-01",)], "s string")
    got = [r.t for r in df.select(parse_stamp("s", with_time=False).alias("t")).collect()]
    assert got == [None, dt.datetime(2024, 4, 1)]


def test_path_or_default_missing_null_and_values(spark):
    docs = [
        '{"o": {"f": "x"}}',           # value
        '{"o": {"f": null}}',          # JSON null leaf -> NULL
        '{"o": {}}',                   # missing leaf -> ''
        '{}',                          # missing object -> ''
        '{"o": null}',                 # null object -> '' (decision)
        '{"o": {"f": 12}}',            # number -> text
        '{"o": {"f": {"g": 1}}}',      # object -> JSON text
        '{"o": "str"}',                # parent not an object -> ''
    ]
    df = spark.createDataFrame([(d,) for d in docs], "b string").select(F.try_parse_json("b").alias("v"))
    got = [r.x for r in df.select(path_or_default("v", "o", "f").alias("x")).collect()]
    assert got == ["x", None, "", "", "", "12", '{"g":1}', ""]


def test_path_or_default_top_level(spark):
    df = spark.createDataFrame([('{"a": "1"}',), ('{"a": null}',), ('{}',)], "b string") \
        .select(F.try_parse_json("b").alias("v"))
    assert [r.x for r in df.select(path_or_default("v", "a").alias("x")).collect()] == ["1", None, ""]
