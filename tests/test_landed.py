import datetime as dt
from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

from courierlake import fixtures as fx
from courierlake.session import set_for_a_while
from courierlake.sources.landed import (gate_dated, gate_documents, lookup_documents, parse_documents,
                                        read_dated_json, select_keys)
from tests.conftest import SF_SMALL, explain, rows

ITEM = T.StructType([T.StructField("id", T.LongType()), T.StructField("o", T.StructType([
    T.StructField("x", T.StringType())]))])


def _dated(spark):
    d = dt.date(2024, 4, 1)
    return spark.createDataFrame([
        (d, 200, '[{"id": 1, "o": {"x": "a"}}, {"id": 2}]'),
        (d, 200, '[]'),
        (d, 200, '{"id": 3}'),                  # bare object: malformed
        (d, 200, '[{"id": 4}'),                 # truncated
        (d, 500, '[{"id": 5}]'),
        (d, 200, 'not json'),
        (d, 200, '  [{"id": 6}]'),
    ], "planned_date date, http_status int, body string")


def test_gate_dated_reasons(spark):
    usable, rejected = gate_dated(_dated(spark), ITEM)
    assert usable.count() == 2
    assert sorted(r.reason for r in rejected.collect()) == ["empty", "malformed", "malformed", "malformed",
                                                           "status"]


def test_read_dated_json_rows(spark):
    out = read_dated_json(_dated(spark), ITEM, keep=["planned_date"])
    assert out.columns == ["planned_date", "id", "o"]
    assert sorted((r.id, r.o.x if r.o else None) for r in out.collect()) == [(1, "a"), (2, None), (6, None)]


def test_gate_documents_reasons_and_parse_once(spark):
    raw = spark.createDataFrame([
        ("k1", 200, '{"a": 1}'), ("k2", 200, '{}'), ("k3", 500, '{"a": 1}'), ("k4", 200, '{"a": '),
        ("k5", 200, '[1]'), ("k6", 302, '{"a": 2}'),
    ], "guia string, http_status int, body string")
    for src in (raw, parse_documents(raw)):
        usable, rejected = gate_documents(src)
        assert sorted(r.guia for r in usable.collect()) == ["k1", "k6"]
        assert sorted((r.guia, r.reason) for r in rejected.collect()) == [
            ("k2", "empty"), ("k3", "status"), ("k4", "malformed"), ("k5", "malformed")]


def test_select_keys_distinct_and_pushdown(spark):
    part = spark.read.parquet(f"{SF_SMALL}/part.parquet")
    keys = select_keys(part, "p_name", "p_size", 10, "ring")
    names = [r.tracking for r in keys.collect()]
    assert len(names) == len(set(names)) and all("ring" in n for n in names)
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "StringContains(p_name,ring)" in plan and "GreaterThanOrEqual(p_size,10)" in plan


def test_lookup_documents_semi_join(spark):
    keys = spark.createDataFrame([("a",), ("b",)], "tracking string")
    docs = spark.createDataFrame([("a", 1), ("a", 2), ("c", 3)], "guia string, page int")
    assert rows(lookup_documents(keys, docs)) == [("a", 1), ("a", 2)]


def test_every_defect_ends_in_a_stated_output(spark):
    """Responses in = usable + rejected; elements in = rows + rejected ones."""
    from courierlake.sources.landed import rejected_elements
    d = dt.date(2024, 4, 1)
    bodies = ['[{"id": 1, "driver": "abc"}, {"id": 2, "driver": 5}]', '[{"id": "x9"}]', '[{"id": 3}, null]', '[{"id": 4}] junk',
              '[{"id": 5}][{"id": 6}]', '[{"id": 7}]]', '[{"id": 8}], 1] x', '[7, "a", [1]]', '[{"id": 2.5}]', '[{"id": "12"}]',
              '[{"id": null, "driver": 1e2, "name": {"a": 1}}]', '{"id": 9}', '[]', '[{"id": 10}] \n', None, '', '5', 'null']
    raw = spark.createDataFrame([(d, 200, b) for b in bodies], "planned_date date, http_status int, body string")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("driver", T.IntegerType()),
                           T.StructField("name", T.StringType())])
    usable, rejected = gate_dated(raw, schema)
    assert usable.count() + rejected.count() == len(bodies)
    assert sorted(r.reason for r in rejected.collect()) == ["empty"] + ["malformed"] * 9
    good = read_dated_json(raw, schema)
    assert rows(good) == sorted([(2, 5, None), (3, None, None), (12, None, None), (None, 100, '{"a":1}'), (10, None, None)], key=repr)
    bad = sorted((r.reason, r.element) for r in rejected_elements(raw, schema).collect())
    assert bad == [("not an object", '"a"'), ("not an object", "7"), ("not an object", "[1]"), ("null", "null"),
                   ("type: driver", '{"driver":"abc","id":1}'), ("type: id", '{"id":"x9"}'), ("type: id", '{"id":2.5}')]
    assert good.count() + len(bad) == sum(r.n for r in usable.selectExpr("size(__items) AS n").collect())


def test_undeclared_fields_become_columns(spark):
    from courierlake.sources.landed import discovered_schema, read_discovered_json
    raw = spark.createDataFrame([(1, 200, '[{"id": 1, "p": {"k": 1}}]'), (2, 200, '[{"id": "x", "p": {"q": {"z w": true}}}, null, 4]'),
                                 (3, 500, '[{"hidden": 1}]'), (4, 200, '[{"none": null, "list": [{"a": 1}]}]')],
                                "page int, http_status int, body string")
    out = read_discovered_json(raw, keep=["page"])
    assert out.columns == ["page", "id", "list", "none", "p.k", "p.q.z w"]
    got = sorted((r["page"], r["id"], r["p.k"], r["p.q.z w"]) for r in out.collect())
    assert got == [(1, "1", 1, None), (2, "x", None, True), (4, None, None, None)]
    empty = spark.createDataFrame([], "page int, http_status int, body string")
    assert discovered_schema(empty).fields == [] and read_discovered_json(empty, keep=["page"]).columns == ["page"]


def test_lookup_moves_no_documents(spark, tmp_path):
    """With broadcast off the only exchanges are those of the keys."""
    from courierlake.sources.landed import land_by_key
    from tests.conftest import explain
    docs = spark.range(2000).selectExpr("concat('G', id % 500) AS guia", "id AS page")
    name = land_by_key(docs, "courierlake_docs_by_key", str(tmp_path / "docs"))
    keys = spark.createDataFrame([("G1",), ("G2",), ("zzz",)], "tracking string").distinct()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = lookup_documents(keys, spark.table(name))
        plan = explain(found, "simple")
        assert found.count() == 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # Depth first: the document scan is reached without an exchange above it.
    above, depth = [], {}
    for line in plan.splitlines():
        if "FileScan parquet" in line and "page" in line:
            at = len(line) - len(line.lstrip(" :+-"))
            above = [x for x in depth if x < at and "Exchange" in depth[x]]
            assert not above, plan
        at = len(line) - len(line.lstrip(" :+-"))
        depth = {k: v for k, v in depth.items() if k < at} | {at: line}
    spark.sql(f"DROP TABLE {name}")


def test_movements_are_grouped_before_their_text_is_made(spark):
    from courierlake import fixtures as fx

    steps = explain(fx.movement_pages(fx.load(spark, SF_SMALL, "events"))).split("\n(1) ", 1)[1]  # from the scan on
    before, after = steps.split("Exchange", 1)
    assert "secuencia" not in before and "secuencia" in after


def test_a_page_is_parsed_once(spark):
    raw = spark.read.schema("planned_date date, http_status int, body string").parquet(f"{SF_SMALL}/orders.parquet")
    plan = read_dated_json(raw, ITEM, keep=["planned_date"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parse_json") + plan.count("parseJson") == 1


def test_routing_pages_are_written_behind_one_exchange(spark, tmp_path):
    """The rows of a page move as columns, once, and leave no shuffle files; null and repeated keys stay as they were."""
    day = [dt.datetime(1998, 1, 2 + i % 3) if i % 7 else None for i in range(300)]
    customer = spark.createDataFrame([(i, f"C{i}", "AUTO", 1.5) for i in [*range(250), 7, None]],
                                     "c_custkey long, c_name string, c_mktsegment string, c_acctbal double")
    orders = spark.createDataFrame([(k, i % 90, "F", 10.5, day[i], "1-URGENT") for i, k in enumerate([*range(297), 5, 5, None])],
                                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string")
    lineitem = spark.createDataFrame([(None if i % 40 == 0 else i % 310, i, i % 10, i % 4 + 1, 2.0, 3.5, 0.1, 0.2, "R", "F", day[1]) for i in range(900)],
                                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                     "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp")
    with set_for_a_while(spark, fx.ROWS_AS_DEALT | {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plans = {k: explain(v, "simple") for k, v in fx.routing_pages(customer, orders, lineitem, 8).items()}
    assert {k: v.count("Exchange") for k, v in plans.items()} == {"vehicles": 2, "routes": 1, "visits": 2}
    assert all("ObjectHashAggregate" not in v and v.count("REPARTITION_BY_NUM") == v.count("Exchange") for v in plans.values())

    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {x for x in manager.getAllFiles().mkString("\n").splitlines() if x.rsplit("/", 1)[-1].startswith("shuffle_")}

    before = files()
    pages = spark.read.parquet(fx.land_routing_pages(spark, customer, orders, lineitem, str(tmp_path / "pages")))
    assert not files() - before
    assert set(pages.columns) == {"endpoint", "planned_date", "http_status", "body"}
    raw = {"vehicles": (fx.vehicles_raw(customer), F.date_add(F.lit("1998-01-01").cast("date"), F.col("fetch_day")), "id"),
           "routes": (fx.routes_raw(orders).drop("copy_no"), F.col("planned_date"), "id"),
           "visits": (fx.visits_raw(lineitem, orders), F.col("planned_date"), "route")}
    for endpoint, (df, of, key) in raw.items():
        want = df.select(of.alias("day"), F.expr(f"{key} div 100").alias("block"), F.to_json(F.struct("*")).alias("obj"))
        want = Counter((day, tuple(sorted(objs))) for day, objs in want.groupBy("day", "block").agg(F.collect_list("obj")).select("day", "collect_list(obj)").collect())
        got = pages.where((F.col("endpoint") == endpoint) & (F.col("http_status") == 200) & F.col("body").startswith("[{")
                          & F.col("body").endswith("]") & ~F.col("body").contains('"stray"'))
        assert Counter((r.planned_date, tuple(sorted(r.body[1:-1].replace("}, {", "}\n{").split("\n")))) for r in got.collect()) == want
    assert pages.where(F.col("body").contains('"stray"')).count() == 5 * 25 and pages.where("body = '[]'").count() == 25
