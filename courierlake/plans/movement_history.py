"""E2 — movement history: selected tracking keys, their landed documents,
one row per movement with parsed stamps.

Plan shape: key scan with pushed filters -> distinct (partial aggregate);
document scan -> parse once to VARIANT -> gate; left-semi join on the key
(broadcast by AQE when the key set measures small); then a narrow
explode + path extraction stage. No Python workers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courierlake import config
from courierlake.operators.history import explode_movements, latest_by_code
from courierlake.sources.landed import gate_documents, lookup_documents, select_keys


def tracking_keys(keys_table: DataFrame, key_col: str = "tracking_num",
                  since_col: str = "creation_dt", since: str = config.TRACKING_SINCE,
                  pattern: str = config.TRACKING_PATTERN) -> DataFrame:
    """``SELECT DISTINCT key AS tracking WHERE since_col >= since AND key LIKE %pattern%``."""
    return select_keys(keys_table, key_col, since_col, F.lit(since).cast("date"), pattern, out="tracking")


def usable_documents(keys: DataFrame, documents_raw: DataFrame, doc_key: str = "guia") -> DataFrame:
    """J3 + S5: usable documents of the selected keys."""
    usable, _ = gate_documents(documents_raw)
    return lookup_documents(keys, usable, key_col="tracking", doc_key=doc_key)


def movement_history(keys: DataFrame, documents_raw: DataFrame, doc_key: str = "guia",
                     with_time: bool = True) -> DataFrame:
    """The movement history table (25 columns). ``with_time=False`` applies
    the date-only format to the movement stamp, which never matches text
    that carries a time (every movement stamp is then NULL)."""
    docs = usable_documents(keys, documents_raw, doc_key)
    return explode_movements(docs, "doc", with_time=with_time)


def latest_per_code(history: DataFrame, codes: list[str],
                    renames: dict[str, str] | None = None) -> DataFrame:
    """Optional step: latest movement stamp per code, one row per shipment."""
    return latest_by_code(history, config.PIVOT_INDEX, "movimiento_codigo", "movimiento_fecha",
                          codes, config.PIVOT_RENAMES if renames is None else renames)
