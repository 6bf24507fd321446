"""Landing envelopes: scan, provenance, schema drift, write, list."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, DataType, DecimalType, FractionalType, IntegralType, MapType, StringType, StructType)

from ..schemas import struct


def scan_envelopes(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str,
    streaming: bool = False,
    one_per_file: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Envelopes under ``path`` with a declared schema, as a batch or a stream.

    ``one_per_file`` reads a (multi-line) document per file, the way sources drop them;
    switch it off for JSON lines, which Spark can split. Sub-folders are searched at any
    depth. On a stream ``max_files_per_trigger`` bounds the size of a micro-batch.
    """
    schema = struct(schema) if isinstance(schema, str) else schema
    reader = (spark.readStream if streaming else spark.read).schema(schema)
    reader = reader.option("multiLine", one_per_file).option("recursiveFileLookup", True)
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def scan_text(
    spark: SparkSession, path: str, streaming: bool = False, one_per_file: bool = True,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The same files as raw text with their file metadata, for ``with_drift_column``."""
    reader = (spark.readStream if streaming else spark.read).option("recursiveFileLookup", True)
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_provenance(reader.text(path, wholetext=one_per_file))


def with_provenance(df: DataFrame) -> DataFrame:
    """Source file, its modification time, and the time of reading. Apply right after a scan."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_file_modification_time"),
        F.current_timestamp().alias("_ingested_at"),
    )


def _at(path: Sequence[str]) -> str:
    return "$" + "".join(f'["{name}"]' for name in path)


def _text(v: Column, path: Sequence[str] = ()) -> Column:
    """A value as text: strings as they are, all else as JSON."""
    return F.try_variant_get(v, _at(path), "string")


def _object(v: Column, path: Sequence[str] = (), values: str = "variant") -> Column:
    """The fields of an object, NULL for anything else."""
    return F.try_variant_get(v, _at(path), f"map<string, {values}>")


def _elements(v: Column, path: Sequence[str] = ()) -> Column:
    return F.try_variant_get(v, _at(path), "array<variant>")


Known = dict[tuple[str, ...], Column]


def _typed(v: Column, path: tuple[str, ...], kind: DataType, objects: Known | None = None) -> Column:
    """The value at a path in its declared type, NULL where it is of another JSON type or out of range. ``objects`` has the
    fields of objects that stand in a column already."""
    if isinstance(kind, StructType):
        fields = [_typed(v, (*path, f.name), f.dataType, objects).alias(f.name) for f in kind.fields]
        here = objects[path] if objects else _object(v, path)
        return F.when(here.isNotNull(), F.struct(*fields))
    if isinstance(kind, ArrayType):
        return F.transform(_elements(v, path), lambda e: _typed(e, (), kind.elementType))
    if isinstance(kind, MapType):
        return F.transform_values(_object(v, path), lambda _, x: _typed(x, (), kind.valueType))
    if isinstance(kind, StringType):
        return _text(v, path)
    value = F.try_variant_get(v, _at(path), kind.simpleString())
    json_type = F.schema_of_variant(F.try_variant_get(v, _at(path), "variant"))
    if isinstance(kind, IntegralType):
        return F.when((json_type == "BIGINT") | json_type.rlike(r"^DECIMAL\(\d+,0\)$"), value)
    if isinstance(kind, BooleanType):
        return F.when(json_type == "BOOLEAN", value)
    if isinstance(kind, (FractionalType, DecimalType)):
        return F.when(~json_type.isin("STRING", "BOOLEAN"), value)
    return value


def _entry(name: Column, raw: Column) -> Column:
    return F.struct(name.alias("path"), raw.alias("raw"))


def _left_over(
    v: Column, path: tuple[str, ...], kind: DataType, name: Column, unknown: bool = True, objects: Known | None = None, typed: Column | None = None,
) -> list[Column]:
    """Arrays of (path, raw text) of all that the declared type does not hold, at any depth; NULL arrays are empty.

    ``name`` is the way to the value; ``unknown=False`` leaves out the unknown fields of this very object. ``objects`` and ``typed``
    are what stands in columns already: fields of objects, and the typed value.
    """
    found: list[Column] = []
    if isinstance(kind, StructType):
        fields = objects[path] if objects else _object(v, path)
        fits = fields.isNotNull()
        if unknown:
            others = F.filter(F.map_entries(fields), lambda e: ~e["key"].isin(kind.names))
            found.append(F.transform(others, lambda e: _entry(F.concat(name, F.lit("."), e["key"]), _text(e["value"]))))
        for f in kind.fields:
            found += _left_over(v, (*path, f.name), f.dataType, F.concat(name, F.lit("." + f.name)), True, objects,
                                None if typed is None else typed[f.name])
    elif isinstance(kind, ArrayType):
        elements, inner = _elements(v, path), kind.elementType
        fits = elements.isNotNull()
        if isinstance(inner, StructType):
            extras = F.filter(
                F.transform(elements, lambda e: F.map_filter(_object(e, (), "string"), lambda k, _: ~k.isin(inner.names))), lambda m: F.size(m) > 0)
            found.append(F.transform(F.filter(F.array(extras), lambda x: F.size(x) > 0), lambda x: _entry(F.concat(name, F.lit("[]")), F.to_json(x))))
        found.append(F.flatten(F.transform(elements, lambda e, i: _all(_left_over(
            e, (), inner, F.concat(name, F.lit("["), i.cast("string"), F.lit("]")), unknown=False)))))
    elif isinstance(kind, MapType):
        fields = _object(v, path)
        fits = fields.isNotNull()
        found.append(F.flatten(F.transform(F.map_entries(fields), lambda e: _all(
            _left_over(e["value"], (), kind.valueType, F.concat(name, F.lit("."), e["key"]))))))
    elif isinstance(kind, StringType):
        return []  # holds anything
    else:
        fits = (_typed(v, path, kind) if typed is None else typed).isNotNull()
    # A JSON null has no text; it fits any type.
    return [*found, F.when(~fits & _text(v, path).isNotNull(), F.array(_entry(name, _text(v, path))))]


def _levels(schema: StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """The ways to the declared objects outside arrays and maps, outermost first."""
    return [path] + [p for f in schema.fields if isinstance(f.dataType, StructType) for p in _levels(f.dataType, (*path, f.name))]


_ENTRIES = "array<struct<path: string, raw: string>>"


def _all(parts: Sequence[Column]) -> Column:
    nothing = F.array().cast(_ENTRIES)
    return F.concat(*[F.coalesce(p, nothing) for p in parts]) if parts else nothing


def with_drift_column(
    text_df: DataFrame,
    schema: StructType | str,
    allowed: Sequence[str] = (),
    value: str = "value",
    out: str = "_rescued_data",
) -> DataFrame:
    """Parse JSON text once, and keep what the declared schema does not hold, at any depth.

    ``out`` is a JSON object of path to raw text, NULL when nothing is left over. It holds

    - unknown fields of objects: ``a.b``; within a map also of its values: ``a.key.b``,
    - unknown fields of the elements of an array, together: ``a[]`` is a list of objects,
    - values of another type, also within maps and elements: ``a.b``, ``a.key.b``, ``a[3].b``; they are NULL in their column,
    - the whole text when it is no JSON object (or names a field twice): ``_corrupt``.

    Numbers do not pass for text's sake: '1' is no number, 1.5 no whole one; a text column takes anything. Paths in
    ``allowed`` are expected extras and left out; ``[]`` there stands for any element.
    """
    schema = struct(schema) if isinstance(schema, str) else schema
    parsed = text_df.withColumn("_doc", F.try_parse_json(value))
    doc = F.col("_doc")
    # Objects outside arrays and maps, and typed values, stand in columns of their own: each is taken out once.
    levels = _levels(schema)
    parsed = parsed.withColumns({f"_o{i}": _object(doc, path) for i, path in enumerate(levels)})
    objects = {path: F.col(f"_o{i}") for i, path in enumerate(levels)}
    parsed = parsed.withColumns({f"_t{i}": _typed(doc, (n,), schema[n].dataType, objects) for i, n in enumerate(schema.names)})
    fields = objects[()]
    others = F.filter(F.map_entries(fields), lambda e: ~e["key"].isin(schema.names))
    parts = [F.transform(others, lambda e: _entry(e["key"], _text(e["value"])))]
    for i, f in enumerate(schema.fields):
        parts += _left_over(doc, (f.name,), f.dataType, F.lit(f.name), True, objects, F.col(f"_t{i}"))
    broken = F.col(value).isNotNull() & fields.isNull()
    left = F.when(broken, F.array(_entry(F.lit("_corrupt"), F.col(value)))).otherwise(_all(parts))
    keep = [c for c in text_df.columns if c != value]
    found = parsed.select(*[F.col(f"_t{i}").alias(n) for i, n in enumerate(schema.names)], *keep, left.alias("_left"))
    entries = F.col("_left")
    if allowed:
        entries = F.filter(entries, lambda e: ~F.regexp_replace(e["path"], r"\[\d+\]", "[]").isin(*allowed))
    # One field name may spell out the way to another: the first entry of a path stays.
    once = F.filter(entries, lambda e, i: F.array_position(F.transform(entries, lambda x: x["path"]), e["path"]) == i + 1)
    return found.withColumn(out, F.when(F.size(entries) > 0, F.to_json(F.map_from_entries(once)))).drop("_left")


def write_envelopes(df: DataFrame, root: str, entity: str, kind: str, day: str) -> None:
    """Add one JSON line per row under ``entity=…/kind=…/day=…``; nothing is ever overwritten.

    ``entity`` and ``day`` name columns, ``kind`` is 'data' or 'metadata'. Rows are
    rebalanced by folder first, so that a folder gets few files while Spark still
    splits a folder that holds much of the data.
    """
    body = [c for c in df.columns if c not in (entity, day)]
    lines = df.select(
        F.to_json(F.struct(*body)).alias("value"),
        F.col(entity).cast("string").alias("entity"),
        F.lit(kind).alias("kind"),
        F.col(day).cast("string").alias("day"),
    )
    balanced = lines.hint("rebalance", "entity", "day")
    balanced.write.mode("append").partitionBy("entity", "kind", "day").text(root)


def _folder_store(path: str):
    """The store of a path, as Arrow opens it, and the path on it."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace(":/", ":///", 1))


def _named(name: str) -> str:
    """The value in a folder name: 'a' for 'a' and for 'entity=a'."""
    return unquote(name.split("=", 1)[1]) if "=" in name else name


def landed_folders(
    spark: SparkSession, root: str, entity: Column | None = None, kind: Column | None = None, day: Column | None = None
) -> DataFrame:
    """The folders of files under ``root``: folder, entity, kind, day.

    The conditions, each on the column of its name, hold before anything below is touched: only the entities are listed
    by the driver; kinds and days are listed by the tasks, for the entities that are wanted.
    """
    store, base = _folder_store(root)
    entities = [(f.path, _named(f.base_name)) for f in store.get_file_info(fs.FileSelector(base, allow_not_found=True)) if f.type == fs.FileType.Directory]
    wanted = spark.createDataFrame(entities, "folder string, entity string")
    wanted = wanted.filter(entity) if entity is not None else wanted

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, _ = _folder_store(root)
        for batch in batches:
            found = []
            for folder, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for k in inside.get_file_info(fs.FileSelector(folder)):
                    if k.type == fs.FileType.Directory and _named(k.base_name) in ("data", "metadata"):
                        found += [(d.path, name, _named(k.base_name), _named(d.base_name)) for d in inside.get_file_info(fs.FileSelector(k.path))
                                  if d.type == fs.FileType.Directory]
            columns = list(zip(*found)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in columns], names=["folder", "entity", "kind", "day"])

    tasks = max(1, min(len(entities), spark.sparkContext.defaultParallelism))
    folders = wanted.repartition(tasks).mapInArrow(below, "folder string, entity string, kind string, day string")
    for condition in (kind, day):
        folders = folders.filter(condition) if condition is not None else folders
    return folders


def list_landed(
    spark: SparkSession, root: str, entity: Column | None = None, kind: Column | None = None, day: Column | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Files under ``root`` with size, modification time, entity, kind and day.

    Both ``entity=a/kind=data/day=20240101`` and ``a/data/20240101`` are understood. The listing is spread over
    ``tasks`` by folder, and ``entity``, ``kind`` and ``day`` are conditions that leave whole folders out
    (see `landed_folders`). Contents are never read. Hidden files are left out.
    """

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, _ = _folder_store(root)
        scheme = root.split(":", 1)[0] + ":" if ":" in root else "file:"
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                found = [f for f in inside.get_file_info(fs.FileSelector(row[0])) if f.type == fs.FileType.File and f.base_name[:1] not in "._"]
                n = len(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{scheme}{f.path}" for f in found], pa.string()), pa.array([f.mtime for f in found], pa.timestamp("us", "UTC")),
                     pa.array([f.size for f in found], pa.int64()), *(pa.array([v] * n, pa.string()) for v in row[1:])],
                    names=["path", "modified_at", "bytes", "entity", "kind", "day"])

    folders = landed_folders(spark, root, entity, kind, day)
    return folders.repartition(tasks or max(1, spark.sparkContext.defaultParallelism)).mapInArrow(
        files, "path string, modified_at timestamp, bytes bigint, entity string, kind string, day string")


def scan_landed(
    spark: SparkSession, root: str, schema: StructType | str, entity: Column | None = None, kind: Column | None = None, day: Column | None = None,
    one_per_file: bool = True,
) -> DataFrame:
    """Envelopes of the folders that the conditions leave, as a batch with entity, kind and day; other folders are not opened.

    The driver holds the chosen folders, not their files.
    """
    schema = struct(schema) if isinstance(schema, str) else schema
    folders = landed_folders(spark, root, entity, kind, day).select("folder").collect()
    columns = StructType([*schema.fields, *struct("entity string, kind string, day string").fields])
    if not folders:
        return spark.createDataFrame([], columns)
    scheme = root.split(":", 1)[0] + ":" if ":" in root else ""
    rows = spark.read.schema(schema).option("multiLine", one_per_file).option("recursiveFileLookup", True).json([f"{scheme}{r['folder']}" for r in folders])
    layout = r"/(?:entity=)?([^/=]+)/(?:kind=)?(data|metadata)/(?:day=)?([^/=]+)/[^/]+$"
    part = [F.url_decode(F.replace(F.regexp_extract(F.col("_metadata.file_path"), layout, i), F.lit("+"), F.lit("%2B"))) for i in (1, 2, 3)]
    return rows.select(*schema.names, *[p.alias(n) for p, n in zip(part, ("entity", "kind", "day"))])
