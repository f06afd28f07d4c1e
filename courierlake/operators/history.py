"""Movement history: one row per movement of a shipment document, and the
optional latest-time-per-code pivot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courierlake import config
from courierlake.functions.values import json_path, join_text, parse_stamp, path_or_default
from courierlake.operators.shape import q


def shipment_fields(doc: Column | str,
                    fields: list[tuple[str, str | None, str]] | None = None) -> list[Column]:
    """Shipment-level columns of a VARIANT document, with the feed's defaults."""
    fields = config.SHIPMENT_FIELDS if fields is None else fields
    out = []
    for name, parent, field in fields:
        keys = (field,) if parent is None else (parent, field)
        out.append(path_or_default(doc, *keys).alias(name))
    return out


def movement_fields(item: Column | str,
                    fields: list[tuple[str, str | None]] | None = None,
                    date_parts: tuple[str, str] = config.MOVEMENT_DATE_PARTS,
                    with_time: bool = True) -> list[Column]:
    """Movement-level columns of one array element (VARIANT). The movement
    stamp is ``fecha + " " + hora`` parsed exactly; a missing part is ``''``
    (so the text does not parse), a JSON-null part makes it NULL."""
    fields = config.MOVEMENT_FIELDS if fields is None else fields
    out = []
    for name, field in fields:
        if field is None:
            text = join_text(path_or_default(item, date_parts[0]), path_or_default(item, date_parts[1]))
            out.append(parse_stamp(text, with_time=with_time).alias(name))
        else:
            out.append(path_or_default(item, field).alias(name))
    return out


def explode_movements(docs: DataFrame, doc_col: str = "doc",
                      array_field: str = config.MOVEMENT_ARRAY,
                      keep: list[str] | None = None,
                      with_time: bool = True) -> DataFrame:
    """One row per element of ``doc.movimiento`` with the shipment fields
    repeated; a document whose array is missing, NULL or empty gives no row.

    Shipment fields are taken from the document before the explode, so each
    path is read once per document, not once per movement. The status stamp
    is assembled from its two parts, which are then dropped. Narrow: no
    shuffle, one codegen stage after the scan.
    """
    keep = keep or []
    items = F.try_variant_get(F.col(doc_col), json_path(array_field), "array<variant>")
    shipments = docs.select(*[F.col(q(k)) for k in keep], *shipment_fields(doc_col),
                            F.explode(items).alias("__item"))
    rows = shipments.select(*[F.col(q(c)) for c in shipments.columns if c != "__item"],
                            *movement_fields("__item", with_time=with_time))
    d, h = config.STATUS_DATE_PARTS
    rows = rows.withColumn(config.STATUS_STAMP_COLUMN, parse_stamp(join_text(d, h)))
    return rows.drop(d, h)


def latest_by_code(df: DataFrame, index: list[str], code_col: str, value_col: str,
                   codes: list[str] | None = None, renames: dict[str, str] | None = None) -> DataFrame:
    """Pivot: one row per ``index`` group, one column per code, value = latest
    ``value_col`` for that code.

    Groups with a NULL in the index and NULL values are left out first (the
    pivot of the feed drops them). With an explicit ``codes`` list no extra
    job looks for distinct codes (a listed code without values gives an
    all-NULL column). ``codes=None`` takes the codes present in the data, as
    the feed's pivot does: Spark runs one distinct job, bounded by
    ``spark.sql.pivotMaxValues`` (it fails rather than grow past it), and a
    code whose values are all NULL never appears because NULL values are
    dropped first. Spark plans max-per-code as conditional aggregates with
    partial aggregation: a hot group is pre-reduced in every task before the
    shuffle.
    """
    renames = renames or {}
    cond = F.col(q(value_col)).isNotNull()
    for c in index:
        cond = cond & F.col(q(c)).isNotNull()
    grouped = df.where(cond).groupBy(*[F.col(q(c)) for c in index])
    pivoted = grouped.pivot(code_col, codes) if codes is not None else grouped.pivot(code_col)
    out = pivoted.agg(F.max(F.col(q(value_col))))
    present = {c: renames[c] for c in out.columns if c in renames and c not in index}
    return out.withColumnsRenamed(present) if present else out
