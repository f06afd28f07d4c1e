"""E3 — export consolidation: landed per-window exports, header clean-up,
text casts, outer union by name, removal of columns that are NULL everywhere.

Plan shape: one Parquet scan over all windows whose column types agree (a
header missing from a window reads as NULL there), one more for each other set
of types -> rename/cast projection, before the union, so a window's text is that
of its own type -> union with common types -> projection on the columns that
hold a value, which the Parquet footers tell (a scan only without them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlake import config
from courierlake.functions.ranges import backward_windows
from courierlake.operators.shape import (cast_text, drop_empty_columns, export_header_map, normalise_headers,
                                         union_outer)
from courierlake.sources.landed import (footer_firsts, gate_exports, read_delimited_groups, read_export_groups,
                                        read_exports, schema_groups)


def consolidate(exports: DataFrame | list[DataFrame], window_col: str = "window_start",
                firsts: dict[str, int] | None = None) -> DataFrame:
    """Consolidated export of all windows in ``exports`` (newest window first
    decides the column order): one frame, or one for each set of column types.
    ``firsts`` (see :func:`footer_firsts`) saves the scan for empty columns.
    The window column itself is not returned."""
    order = "__window_order"
    frames = [cast_text(normalise_headers(df)) for df in ([exports] if isinstance(exports, DataFrame) else exports)]
    df = union_outer([f.withColumn(order, -F.unix_date(F.col(window_col).cast("date"))).drop(window_col) for f in frames])
    if firsts:
        names = export_header_map()
        firsts = {names.get(c, c): at for c, at in firsts.items()}
    return drop_empty_columns(df, order_by=order, firsts=firsts)


def asked_windows(manifest: DataFrame, run_date, floor=None, include_partial: bool = False,
                  window_col: str = "window_start") -> DataFrame:
    """The manifest rows of the backward windows between ``run_date`` and
    ``floor`` (``config.EXPORT_FLOOR`` if not given; ISO text or dates); all
    rows without a run date."""
    if run_date is None:
        return manifest
    bounds = manifest.sparkSession.range(1).select(
        F.lit(run_date).cast("date").alias("run_date"), F.lit(floor or config.EXPORT_FLOOR).cast("date").alias("floor"))
    asked = backward_windows(bounds, include_partial=include_partial).select(F.col("window_start").alias(window_col))
    return manifest.join(asked, window_col, "left_semi")


def consolidated_export(spark: SparkSession, root: str, window_col: str = "window_start", *,
                        run_date=None, floor=None, include_partial: bool = False) -> DataFrame:
    """Consolidate the landed export under ``root``: ``root/data`` holds the
    windows (``window_start=<date>/``), ``root/manifest`` one response row per
    requested window; windows whose response was not a spreadsheet are left
    out (as the feed skips them), as are windows that :func:`asked_windows`
    does not ask for; their partitions are pruned."""
    manifest = asked_windows(spark.read.parquet(f"{root}/manifest"), run_date, floor, include_partial, window_col)
    groups = schema_groups(manifest, window_col) if "schema" in manifest.columns else []
    if not groups:  # no schema was recorded: the footers' fields must agree
        return consolidate(gate_exports(read_exports(spark, f"{root}/data"), manifest, window_col), window_col)
    frames = [gate_exports(df, manifest, window_col) for df in read_export_groups(spark, f"{root}/data", groups, window_col)]
    return consolidate(frames, window_col, footer_firsts(spark, f"{root}/data", groups, window_col))


def consolidated_delimited_export(spark: SparkSession, root: str,
                                  window_col: str = "window_start", *,
                                  run_date=None, floor=None, include_partial: bool = False) -> DataFrame:
    """As :func:`consolidated_export`, for windows landed as delimited files
    with a header each (``root/data``) and a manifest that records every
    window's response and header (``root/manifest``)."""
    manifest = asked_windows(spark.read.parquet(f"{root}/manifest"), run_date, floor, include_partial, window_col)
    frames = read_delimited_groups(spark, f"{root}/data", manifest, window_col)
    return consolidate([gate_exports(df, manifest, window_col) for df in frames], window_col)
