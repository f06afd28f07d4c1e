"""Landed responses of the three feeds.

The HTTP fetch itself is transport and stays outside the engine: every
response is landed as one row (``http_status``, ``body`` plus its request
coordinates) or, for exports, as one file set per window. These readers gate
the responses and turn them into rows, all as lazy column expressions.
"""

from __future__ import annotations

import json
import re
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courierlake import config
from courierlake.operators.shape import common_schema, flatten, q, union_outer

# --- S5: response gates ---------------------------------------------------------


def _marked(body: Column) -> Column:
    """The text parsed as the first element of an array that ends with a hash of it."""
    return F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), body, F.lit(","), F.xxhash64(body).cast("string"), F.lit("]"))),
                             "$", "array<variant>")


def _elements(body: Column, outer: Column | None = None) -> Column:
    """The elements of a JSON array as VARIANTs, or NULL when the text is not
    one JSON array and nothing else.

    The parser stops behind the first value and ignores the rest, so the text is
    parsed inside an array that ends with a hash of the text: the hash comes
    second only where the text is one whole value. ``outer`` is :func:`_marked`
    of the text where it is a column already."""
    outer = _marked(body) if outer is None else outer
    whole = (F.size(outer) == 2) & (F.try_variant_get(F.get(outer, F.lit(1)), "$", "bigint") == F.xxhash64(body))
    return F.when(whole, F.try_variant_get(F.get(outer, F.lit(0)), "$", "array<variant>"))


def _exploded(raw: DataFrame, kept: list[Column], name: str, body: str, status: str) -> DataFrame:
    """``kept`` and, as ``name``, every element of the usable responses. A generator
    evaluates what is repeated in it again each time, so the parse is a column below it."""
    outer = F.when(F.col(status) == 200, _marked(F.col(body)))
    return raw.select("*", outer.alias("__outer")).select(*kept, F.explode(_elements(F.col(body), F.col("__outer"))).alias(name))


def gate_dated(raw: DataFrame, item_schema: T.StructType | None = None, body: str = "body",
               status: str = "http_status") -> tuple[DataFrame, DataFrame]:
    """Split dated responses into (usable, rejected); every response is in one.

    Usable: status 200, body is one JSON array with nothing behind it, and the
    array is not empty; ``usable`` carries its elements in ``__items`` (VARIANTs,
    typed by :func:`read_dated_json`; ``item_schema`` is not needed here).
    ``rejected`` keeps the envelope with a ``reason`` of ``status``,
    ``malformed`` or ``empty``. Rejected rows come out of a generator (one row
    per rejected response, none otherwise) rather than a filter, so the parse
    behind the reason is not inlined into a pushed-down condition: each body is
    parsed once. An object that repeats a key, and a body beyond the size of a
    VARIANT, count as malformed.
    """
    items = _elements(F.col(body))
    # A response without a status is rejected like one with a failed status.
    ok = F.coalesce(F.col(status) == 200, F.lit(False))
    usable = raw.withColumn("__items", items).where(ok & (F.size("__items") > 0))
    # The item count is computed once in a projection; the reason and the
    # generator only reference that column.
    keep = [c for c in raw.columns if c != body]
    counted = raw.select(*[F.col(q(c)) for c in keep], F.size(items).alias("__n"))
    n = F.col("__n")           # NULL (ANSI) or -1 (legacy) when not an array
    reason = (F.when(~ok, F.lit("status"))
              .when(n.isNull() | (n < 0), F.lit("malformed"))
              .when(n == 0, F.lit("empty")))
    rejected = counted.select(*[F.col(q(c)) for c in keep],
                              F.explode(F.when(reason.isNotNull(), F.array(reason))).alias("reason"))
    return usable, rejected


def _ddl(t: T.DataType) -> str:
    """``simpleString`` with quoted field names."""
    if isinstance(t, T.StructType):
        return "struct<" + ",".join(f"{q(f.name)}:{_ddl(f.dataType)}" for f in t.fields) + ">"
    if isinstance(t, T.ArrayType):
        return f"array<{_ddl(t.elementType)}>"
    if isinstance(t, T.MapType):
        return f"map<{_ddl(t.keyType)},{_ddl(t.valueType)}>"
    return t.simpleString()


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _wrong(el: Column, value: Column, t: T.DataType, path: str, name: str) -> list[Column]:
    """Conditions (text, or NULL) for what is wrong with a field whose typed
    value is ``value``: it is there and does not read as its type. The element
    is asked again only where the value is NULL, or may have lost a fraction."""
    if isinstance(t, T.StringType):
        return []  # any value has a text
    raw = F.try_variant_get(el, path, "variant")
    bad = value.isNull() & raw.isNotNull() & ~F.is_variant_null(raw)
    if isinstance(t, _INTEGRAL):
        bad = F.when(value.isNull(), bad).otherwise(F.try_variant_get(el, path, "double") != value)
    inner = [w for f in t.fields for w in _wrong(el, value.getField(f.name), f.dataType, path + f"['{f.name}']",
                                                 f"{name}.{f.name}")] if isinstance(t, T.StructType) else []
    return [F.when(bad, F.lit(f"type: {name}")), *inner]


def _checked(raw: DataFrame, item_schema: T.StructType, keep: list[str], body: str, status: str) -> DataFrame:
    """One row per element of every usable response: ``keep``, ``__el`` (the
    element), ``__it`` (its fields typed, in one walk over it; NULL when it is no
    object) and ``__why`` (NULL, or what is wrong)."""
    kept = [F.col(q(k)) for k in keep]
    typed = _exploded(raw, kept, "__el", body, status) \
        .select(*kept, "__el", F.try_variant_get("__el", "$", _ddl(item_schema)).alias("__it"))
    it, el = F.col("__it"), F.col("__el")
    wrong = [w for f in item_schema.fields for w in _wrong(el, it.getField(f.name), f.dataType, f"$['{f.name}']", f.name)]
    no_object = F.when(F.is_variant_null("__el"), F.lit("null")).otherwise(F.lit("not an object"))
    why = F.when(it.isNull(), no_object).otherwise(F.coalesce(*wrong, F.lit(None).cast("string")))
    return typed.select(*kept, "__el", "__it", why.alias("__why"))


def read_dated_json(raw: DataFrame, item_schema: T.StructType, keep: list[str] | None = None,
                    body: str = "body", status: str = "http_status") -> DataFrame:
    """One row per object of every usable dated response, in the declared
    ``item_schema``, with the ``keep`` envelope columns (e.g. ``planned_date``).

    Elements are typed one by one. A missing field and a JSON null are NULL; a
    number given as text counts as that number; an element with a value that is
    not of its declared type (``"id": "x9"``, ``"driver": 2.5``), a null and a
    value that is no object give no row here, but one in
    :func:`rejected_elements`. The gate is folded into the generators: no filter
    references the parse, so Catalyst has nothing to push below it and each body
    is parsed exactly once. Date order is irrelevant to the result (it is a
    multiset).
    """
    keep = keep or []
    rows = _checked(raw, item_schema, keep, body, status)
    good = F.explode(F.when(F.col("__why").isNull(), F.array("__it"))).alias("__it")
    return rows.select(*[F.col(q(k)) for k in keep], good).select(*[F.col(q(k)) for k in keep], "__it.*")


def rejected_elements(raw: DataFrame, item_schema: T.StructType, keep: list[str] | None = None,
                      body: str = "body", status: str = "http_status") -> DataFrame:
    """The elements of usable responses that :func:`read_dated_json` gives no
    row for: ``keep``, ``reason`` (``null``, ``not an object`` or ``type:`` and
    the first such field) and the element's JSON text."""
    keep = keep or []
    kept = [F.col(q(k)) for k in keep]
    rows = _checked(raw, item_schema, keep, body, status)
    bad = F.explode(F.when(F.col("__why").isNotNull(), F.array(F.struct(
        F.col("__why").alias("reason"), F.to_json("__el").alias("element"))))).alias("__bad")
    return rows.select(*kept, bad).select(*kept, "__bad.*")


def discovered_schema(raw: DataFrame, body: str = "body", status: str = "http_status") -> T.StructType:
    """Schema of the objects in all usable responses: every field that any of
    them has, nested objects included, merged by one aggregate over the parsed
    elements (one short text reaches the driver). A field with values of unlike
    types, or only nulls, is text."""
    items = _exploded(raw, [], "el", body, status) \
        .where(F.try_variant_get("el", "$", "map<string,variant>").isNotNull())
    found = items.agg(F.schema_of_variant_agg("el")).first()[0]
    if not found or not found.startswith("OBJECT"):
        return T.StructType([])
    return T.DataType.fromDDL(_struct_ddl(found))


def _struct_ddl(text: str) -> str:
    """A VARIANT schema as a column type; quoted field names stay as they are."""
    parts = text.split("`")
    for i in range(0, len(parts), 2):
        parts[i] = re.sub(r"\bOBJECT(?=<)", "STRUCT", re.sub(r"(?<=[ <])(VARIANT|VOID)\b(?=[,>])", "STRING", parts[i]))
        parts[i] = re.sub(r"\bOBJECT\b", "STRING", parts[i])  # an object without fields
    return "`".join(parts)


def read_discovered_json(raw: DataFrame, keep: list[str] | None = None, sep: str = ".",
                         body: str = "body", status: str = "http_status") -> DataFrame:
    """P1 without a declaration: one row per object of every usable response,
    every nested object replaced by its fields (``parent<sep>child``), with the
    columns of :func:`discovered_schema` — so a field that one page has is a
    column, NULL elsewhere. Elements that are no objects give no row. Reads the
    responses twice: once for the schema, once for the rows."""
    keep = keep or []
    kept = [F.col(q(k)) for k in keep]
    schema = discovered_schema(raw, body, status)
    if not schema.fields:
        return raw.select(*kept).limit(0)
    rows = _exploded(raw, kept, "__el", body, status)
    one = F.try_variant_get("__el", "$", _ddl(schema))
    good = rows.select(*kept, one.alias("__it")).select(*kept, F.explode(F.when(
        F.col("__it").isNotNull(), F.array("__it"))).alias("__it"))
    return flatten(good.select(*kept, "__it.*"), sep=sep)


def _object_size(doc: Column) -> Column:
    """Number of top-level keys of a VARIANT object; NULL if not an object."""
    return F.size(F.try_variant_get(doc, "$", "map<string,variant>"))


def parse_documents(raw: DataFrame, body: str = "body", doc: str = "doc") -> DataFrame:
    """Add the parsed document as a VARIANT column (NULL for malformed text)
    and its number of top-level keys (``<doc>_keys``, NULL if not an object).

    Meant for the landing write: a landed table that stores both is parsed
    and sized exactly once; readers gate on the plain key count (a Parquet
    filter) and take their paths from the binary variant."""
    parsed = raw.withColumn(doc, F.try_parse_json(F.col(body)))
    return parsed.withColumn(f"{doc}_keys", _object_size(F.col(doc)))


def gate_documents(raw: DataFrame, body: str = "body", status: str = "http_status",
                   doc: str = "doc") -> tuple[DataFrame, DataFrame]:
    """Split keyed documents into (usable, rejected).

    Usable: non-error status (< 400), the body parses, and it is a non-empty
    JSON object. If ``raw`` already carries the parsed ``doc`` VARIANT (see
    :func:`parse_documents`) it is used as is; otherwise the body is parsed
    here (and Catalyst may repeat that parse inside the pushed-down gate
    filter, so landing the VARIANT is the fast path).
    """
    marked = raw if doc in raw.columns else parse_documents(raw, body, doc)
    keys_col = f"{doc}_keys"
    n_keys = F.col(keys_col) if keys_col in marked.columns else _object_size(F.col(doc))
    ok = F.coalesce(F.col(status) < 400, F.lit(False))
    usable = marked.where(ok & (n_keys > 0)).drop(body, keys_col)
    reason = (F.when(~ok, F.lit("status"))
              .when(n_keys.isNull(), F.lit("malformed"))
              .when(n_keys == 0, F.lit("empty")))
    rejected = marked.withColumn("reason", reason).where(F.col("reason").isNotNull()) \
        .drop(doc, body, keys_col)
    return usable, rejected


# --- S4: key selection ---------------------------------------------------------

def select_keys(df: DataFrame, key_col: str, since_col: str | None = None, since=None,
                pattern: str | None = None, out: str = "tracking") -> DataFrame:
    """Distinct keys created on or after ``since`` that contain ``pattern``.

    Both predicates reach the Parquet scan (``GreaterThanOrEqual`` and
    ``StringContains`` in PushedFilters) and only the two columns are read.
    The distinct is a partial+final hash aggregate: duplicates collapse in
    every task before the shuffle.
    """
    cond = F.lit(True)
    if since_col is not None and since is not None:
        cond = cond & (F.col(q(since_col)) >= F.lit(since))
    if pattern:
        cond = cond & F.col(q(key_col)).contains(pattern)
    return df.where(cond).select(F.col(q(key_col)).alias(out)).distinct()


# --- J3 / S2: key lookup ------------------------------------------------------------

def lookup_documents(keys: DataFrame, docs: DataFrame, key_col: str = "tracking",
                     doc_key: str = "guia") -> DataFrame:
    """Usable documents of the selected keys (keys without one vanish).

    ``keys`` is distinct, so a left-semi join returns every matching document
    exactly once without carrying key columns; Catalyst plans it as a
    shuffled (or, when AQE measures the key side small, broadcast) hash join.
    """
    return docs.join(keys.withColumnRenamed(key_col, doc_key), on=doc_key, how="left_semi")


def land_by_key(docs: DataFrame, table: str, path: str, key: str = "guia",
                buckets: int | None = None) -> str:
    """Land documents as catalog table ``table`` (files below ``path``), bucketed
    and sorted by ``key``, for lookups that come again and again: a join on the
    key then moves the keys to the documents, never the documents. One file a
    bucket. The planner gives buckets up that are fewer than a shuffle's
    partitions, hence the default of that number; more make smaller tasks."""
    buckets = buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.repartition(buckets, F.col(q(key)))
    if {"body", "doc", "doc_keys"} <= set(docs.columns):
        # Parsed again behind the shuffle, which moves the bodies alone.
        rows = parse_documents(docs.drop("doc", "doc_keys").repartition(buckets, F.col(q(key)))).select(*docs.columns)
    rows.write.format("parquet").mode("overwrite") \
        .bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return table


# --- S3: landed exports ---------------------------------------------------------------

def union_schema(manifest: DataFrame, col: str = "schema") -> T.StructType:
    """Outer union by name of the window schemas the landing recorded as JSON
    in ``manifest.<col>``, with the common type of each column. Only the
    distinct schemas reach the driver: a handful of short strings, whatever the
    data size."""
    recorded = manifest.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col).collect()
    return common_schema([T.StructType.fromJson(json.loads(r[col])) for r in recorded])


def schema_groups(manifest: DataFrame, window_col: str = "window_start",
                  col: str = "schema") -> list[tuple[T.StructType, list]]:
    """(schema, windows) of the usable windows, one entry for each distinct
    recorded schema. The driver holds one date a window: landing metadata."""
    usable = manifest.join(usable_windows(manifest, window_col), window_col, "left_semi").where(F.col(col).isNotNull())
    rows = usable.groupBy(col).agg(F.array_sort(F.collect_set(window_col)).alias("days")).orderBy(col).collect()
    return [(T.StructType.fromJson(json.loads(r[col])), list(r["days"])) for r in rows]


def read_export_groups(spark: SparkSession, root: str, groups: list[tuple[T.StructType, list]],
                       window_col: str = "window_start") -> list[DataFrame]:
    """The windows of :func:`schema_groups`, in as few scans as types allow.

    Schemas that agree on the type of every column they share are read in one
    scan with their outer union. A column whose type differs between windows
    (a sheet decides its types by its own cells) parts them: each scan then
    names its windows, which prunes the partitions of the others, and the
    caller unites the frames (:func:`union_outer` finds the common types)."""
    like: list[tuple[dict[str, T.StructField], list]] = []
    for schema, days in groups:
        for fields, own in like:
            if all(fields[f.name].dataType == f.dataType for f in schema.fields if f.name in fields):
                fields.update({f.name: f for f in schema.fields if f.name not in fields})
                own.extend(days)
                break
        else:
            like.append(({f.name: f for f in schema.fields}, list(days)))
    frames = []
    for fields, days in like:
        df = spark.read.schema(T.StructType(list(fields.values()))).parquet(root)
        frames.append(df if len(like) == 1 else df.where(F.col(q(window_col)).isin(days)))
    return frames


def footer_firsts(spark: SparkSession, root: str, groups: list[tuple[T.StructType, list]],
                  window_col: str = "window_start") -> dict[str, int] | None:
    """Per raw column the newest window (as minus its day number) that holds a
    value, from the Parquet footers alone; columns without a value are left
    out. None where the footers do not tell, so a scan has to.

    Spark answers the counts from the footers' null counts (aggregate push-down
    by partition column), distributed over the files. It matches columns by
    position, so each recorded schema is asked apart, and its order is held
    against a file's; the landing answers for the order of the others.
    """
    own = spark.newSession()  # the two settings below hold for this metadata query only
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    order = -F.unix_date(F.col(window_col).cast("date"))
    asked: list[DataFrame] = []
    try:
        for k, (schema, days) in enumerate(groups):
            written = spark.read.parquet(f"{root}/{window_col}={days[-1]}").schema
            if [(f.name, f.dataType) for f in written.fields] != [(f.name, f.dataType) for f in schema.fields]:
                return None
            paths = [f"{root}/{window_col}={d}" for d in days]
            counts = own.read.schema(schema).option("basePath", root).parquet(*paths).groupBy(window_col).agg(
                *[F.count(F.col(q(c))).alias(f"c{i}") for i, c in enumerate(schema.names)])
            asked.append(counts.agg(F.lit(k).alias("group"), F.array(
                *[F.min(F.when(F.col(f"c{i}") > 0, order)) for i in range(len(schema))]).alias("at")))
        rows = reduce(DataFrame.union, asked).collect() if asked else []  # one row a schema
    except (PySparkException, Py4JJavaError):  # no statistics, unreadable footer
        return None
    firsts: dict[str, int] = {}
    for r in rows:
        for c, at in zip(groups[r["group"]][0].names, r["at"]):
            if at is not None:
                firsts[c] = min(at, firsts.get(c, at))
    return firsts


def read_exports(spark: SparkSession, root: str, fmt: str = "parquet",
                 schema: T.StructType | None = None) -> DataFrame:
    """Every landed export window under ``root`` (``<window_col>=<date>/``),
    in one scan.

    Windows may differ in their header set. With ``schema`` (the union of the
    recorded window schemas, see :func:`union_schema`) the scan reads each
    file with it and a column missing from a file reads as NULL; without it
    the Parquet footers of all files are merged by name first (an extra job
    over every footer). Either way this is the outer union by name of the
    per-window frames.
    """
    if schema is not None:
        return spark.read.schema(schema).format(fmt).load(root)
    reader = spark.read.option("mergeSchema", "true") if fmt == "parquet" else \
        spark.read.option("header", "true")
    return reader.format(fmt).load(root)


def usable_windows(manifest: DataFrame, window_col: str = "window_start") -> DataFrame:
    """S5 for exports: windows whose response had status 200 and the
    spreadsheet content type (one manifest row per requested window)."""
    ok = (F.col("http_status") == config.EXPORT_OK_STATUS) & \
        F.col("content_type").contains(config.EXPORT_CONTENT_TYPE)
    return manifest.where(ok).select(window_col).distinct()


def rejected_windows(manifest: DataFrame, window_col: str = "window_start") -> DataFrame:
    """S5 for exports: the responses of the windows that no usable response
    has, with the reason: ``status`` or ``content_type``."""
    bad = F.coalesce(F.col("http_status") != config.EXPORT_OK_STATUS, F.lit(True))
    return manifest.join(usable_windows(manifest, window_col), window_col, "left_anti").withColumn(
        "reason", F.when(bad, F.lit("status")).otherwise(F.lit("content_type")))


def gate_exports(exports: DataFrame, manifest: DataFrame, window_col: str = "window_start") -> DataFrame:
    """Rows of usable windows only. A left-semi join on the partition column:
    the manifest side is one row per window, so Spark broadcasts it and prunes
    the export partitions of unusable windows at the scan (dynamic partition
    pruning); stale files of a failed window are never read."""
    return exports.join(usable_windows(manifest, window_col), on=window_col, how="left_semi")


_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "timestamp_ntz": T.TimestampNTZType(),
          "double": T.DoubleType(), "date": T.DateType()}


def export_schema(header: list[str], types: dict[str, str] | None = None) -> T.StructType:
    """Declared schema of a delimited export with this header: the typed
    sheet columns keep their type, every other column is text."""
    types = config.EXPORT_TYPED_HEADERS if types is None else types
    return T.StructType([T.StructField(h, _TYPES[types.get(h, "string")]) for h in header])


def read_delimited_groups(spark: SparkSession, root: str, manifest: DataFrame,
                          window_col: str = "window_start") -> list[DataFrame]:
    """The windows of a delimited export landed under
    ``root/<window_col>=<date>/``, whose header is recorded per window in
    ``manifest.header``, and where they are not the declared ones the types of
    its columns in ``manifest.types`` (names as ``simpleString``, one a column).

    Windows with the same header and types are read in one scan with a declared
    schema (one scan for each, not per window; headers are landing metadata,
    one short row per distinct one). Windows that :func:`usable_windows` turns
    away, or without a header, have no files and are not read; with no window
    left the result is empty, with the typed sheet columns. Quoted fields may
    hold line breaks, so a file is one task: landings bound the size of a file
    (the exports have one sheet of 31 days a window).
    """
    manifest = manifest.join(usable_windows(manifest, window_col), window_col, "left_semi") \
        .where(F.col("header").isNotNull())
    types = F.col("types") if "types" in manifest.columns else F.lit(None).cast("array<string>")
    found = manifest.groupBy("header", types.alias("types")).agg(
        F.array_sort(F.collect_set(F.date_format(window_col, "yyyy-MM-dd"))).alias("days")).orderBy("header", "types").collect()
    frames = []
    for r in found:
        schema = export_schema(r["header"])
        if r["types"]:
            schema = T.StructType([T.StructField(h, _TYPES[t]) for h, t in zip(r["header"], r["types"], strict=True)])
        frames.append(spark.read.schema(schema).option("header", "true")
                      .option("multiLine", "true").option("escape", '"').option("basePath", root)
                      .csv([f"{root}/{window_col}={d}" for d in r["days"]]))
    if not frames:
        window = T.StructField(window_col, manifest.schema[window_col].dataType)
        frames.append(spark.createDataFrame([], T.StructType([*export_schema(list(config.EXPORT_TYPED_HEADERS)), window])))
    return frames


def read_delimited_exports(spark: SparkSession, root: str, manifest: DataFrame,
                           window_col: str = "window_start") -> DataFrame:
    """:func:`read_delimited_groups` combined by name; a column missing from
    some sheets reads as NULL there."""
    return union_outer(read_delimited_groups(spark, root, manifest, window_col))


def read_export_files(spark: SparkSession, paths: dict, fmt: str = "csv",
                      window_col: str = "window_seq",
                      options: dict[str, str] | None = None) -> list[DataFrame]:
    """Per-window frames of delimited exports with their own header each
    (``paths``: window id -> path). Combine them with ``union_outer``."""
    opts = {"header": "true"}
    opts.update(options or {})
    return [spark.read.format(fmt).options(**opts).load(p).withColumn(window_col, F.lit(w))
            for w, p in paths.items()]
