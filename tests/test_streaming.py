from collections import Counter

from courierlake import fixtures as fx
from courierlake.plans.movement_history import movement_history, tracking_keys
from courierlake.registry import FEED_ITEM
from courierlake.session import scratch_path
from courierlake.streaming.landing import land_dated_stream, land_documents_stream
from tests.conftest import SF_SMALL


def test_document_stream_lands_parsed_docs_once(spark):
    root = scratch_path(spark, "stream-test")
    inbox, landed = f"{root}/inbox", f"{root}/landed"
    customer, events = fx.load(spark, SF_SMALL, "customer"), fx.load(spark, SF_SMALL, "events")
    docs = fx.tracking_documents(customer, events)
    docs.where("page % 2 = 0 or guia < 'WYB000000100'").write.parquet(f"{inbox}/batch=1")
    q = land_documents_stream(spark, inbox, landed, name=root.rsplit("/", 1)[-1] + "-docs")
    q.awaitTermination()
    docs.where("not (page % 2 = 0 or guia < 'WYB000000100')").write.parquet(f"{inbox}/batch=2")
    q = land_documents_stream(spark, inbox, landed, name=root.rsplit("/", 1)[-1] + "-docs")
    q.awaitTermination()
    streamed = spark.read.parquet(landed)
    assert streamed.count() == docs.count()
    keys = tracking_keys(fx.tracking_keys(customer))
    a = movement_history(keys, streamed)
    b = movement_history(keys, docs)
    assert Counter(map(tuple, a.collect())) == Counter(map(tuple, b.collect()))


def test_dated_stream_rows(spark):
    root = scratch_path(spark, "stream-dated")
    events = fx.load(spark, SF_SMALL, "events")
    fx.json_feed(events).write.parquet(f"{root}/inbox/part=0")
    q = land_dated_stream(spark, f"{root}/inbox", f"{root}/staging", FEED_ITEM,
                          name=root.rsplit("/", 1)[-1])
    q.awaitTermination()
    n_valid = events.where("event_id % 10 >= 4").count() + events.where("event_id % 10 = 4").count()
    assert spark.read.parquet(f"{root}/staging").count() == n_valid
