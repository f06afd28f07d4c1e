"""Main text of pages by wrapper induction.

Every task aligns the trees of the pages it reads, host by host, into one
wrapper per host by simple tree matching; the tasks' wrappers of a host are
merged level by level. A page is then aligned with its host's wrapper: nodes
that stay constant are template, varying slots are content.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake.llm import dom
from courierlake.llm.common import staged

FAN_IN = 64
# Hosts a task holds before it emits its wrappers.
HELD_HOSTS = 500


def host_of(url):
    """Lower-cased host of a URL column; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)),
                      F.lit(""))


def induce(pages: DataFrame) -> DataFrame:
    """(host, wrapper) from all rows of (host, html)."""
    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        slot = TaskContext.get().partitionId()
        held: dict[str, dom.Wrap] = {}

        def flush():
            rows = [(host, slot, dom.dumps(w)) for host, w in held.items()]
            held.clear()
            return pd.DataFrame(rows, columns=["host", "slot", "wrapper"])

        for batch in batches:
            for host, page in zip(batch["host"], batch["html"]):
                own = dom.shape(dom.parse(page))
                held[host] = dom.merge(held[host], own) if host in held else own
                if len(held) > HELD_HOSTS:
                    yield flush()
        yield flush()

    def join(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["slot", "wrapper"])
        wrapper = dom.loads(frame["wrapper"].iloc[0])
        for data in frame["wrapper"].iloc[1:]:
            wrapper = dom.merge(wrapper, dom.loads(data))
        return pd.DataFrame([(key[0], int(key[1]), dom.dumps(wrapper))], columns=["host", "slot", "wrapper"])

    schema = "host string, slot long, wrapper string"
    found = staged(pages.where("html IS NOT NULL").mapInPandas(local, schema), "wrappers")
    slots = (found.agg(F.max("slot")).first()[0] or 0) + 1
    while True:
        slots = math.ceil(slots / FAN_IN)
        found = staged(found.groupBy("host", F.floor(F.col("slot") / FAN_IN).alias("slot"))
                       .applyInPandas(join, schema), "wrappers")
        if slots == 1:
            return found.select("host", "wrapper")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars), one row for each row of ``pages``.

    Null or empty html: empty text. A null URL, or one without a host, falls
    under the empty host. A page that does not fit its host's wrapper, or whose
    host has no other page, is judged on its own tree. Of very long pages nothing
    is cut off; elements below depth ``dom.MAX_DEPTH`` count as that deep, each
    piece of their text as a block. Repeated rows stay;
    other columns are ignored; an empty table gives no rows.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html"), host_of(F.col(url_col)).alias("host"))
    wrappers = induce(rows.select("host", "html"))

    @F.pandas_udf("string")
    def text(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known: dict[str, dom.Wrap] = {}
        for html, wrapper in batches:
            out = []
            for page, data in zip(html, wrapper):
                if data is not None and data not in known:
                    if len(known) > HELD_HOSTS:
                        known.clear()
                    known[data] = dom.loads(data)
                out.append(dom.main_text(page, known.get(data)) if page else "")
            yield pd.Series(out, dtype=object)

    found = rows.join(wrappers, "host", "left").select("page_id", "url", text("html", "wrapper").alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
