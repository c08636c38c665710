"""Schema tracking for file ingest: evolution modes and rescued values."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, NumericType, StringType, StructField, StructType

from strata.sources.files import if_present, small_frame

# Evolution modes, formats without types of their own, the extra column.
MODES = ("add_new_columns", "rescue", "fail_on_new_columns", "none")
TEXT_FORMATS = ("json", "csv")
RESCUED = "_rescued_data"
MALFORMED = "_malformed"
COMPLEX = (StructType, ArrayType, MapType)
STORE_SCHEMA = "revision long, table_schema string, checked_at timestamp_ntz"


def saved_schema(spark: SparkSession, path: str) -> tuple[StructType, dt.datetime, int] | None:
    """Newest saved schema, when it was last checked, and its revision."""
    log = if_present(lambda: spark.read.schema(STORE_SCHEMA).json(path))
    row = None if log is None else log.orderBy(F.desc("revision")).first()
    if row is None:
        return None
    return StructType.fromJson(json.loads(row["table_schema"])), row["checked_at"], row["revision"]


def save_schema(spark: SparkSession, path: str, schema: StructType, checked_at: dt.datetime, revision: int) -> None:
    row = small_frame(
        spark, {"revision": [revision], "table_schema": [schema.json()], "checked_at": [checked_at]}
    )
    row.coalesce(1).write.mode("append").json(path)


def infer(spark: SparkSession, fmt: str, options: dict, paths: list[str]) -> StructType:
    """Schema of exactly these files; lines that do not parse add no column."""
    reader = spark.read.format(fmt).options(**options).option("mergeSchema", "true").option("columnNameOfCorruptRecord", MALFORMED)
    if fmt == "csv":
        reader = reader.option("inferSchema", "true")
    return StructType([f for f in reader.load(paths).schema if f.name != MALFORMED])


def merged(known: DataType, found: DataType, path: str = "") -> tuple[DataType, list[str]]:
    """``known`` with the fields that only ``found`` has, at any depth, and the paths of those.

    Structs in structs, arrays and map values are merged; where the kinds differ the known one stays.
    """
    if isinstance(known, StructType) and isinstance(found, StructType):
        have, fields, new = {f.name: f for f in found}, [], []
        for field in known:
            kind, more = merged(field.dataType, have[field.name].dataType, f"{path}{field.name}.") if field.name in have else (field.dataType, [])
            fields.append(StructField(field.name, kind, field.nullable, field.metadata))
            new += more
        for field in found:
            if field.name not in known.names:
                fields.append(StructField(field.name, field.dataType, True))
                new.append(path + field.name)
        return StructType(fields), new
    if isinstance(known, ArrayType) and isinstance(found, ArrayType):
        kind, new = merged(known.elementType, found.elementType, path)
        return ArrayType(kind, True), new
    if isinstance(known, MapType) and isinstance(found, MapType):
        kind, new = merged(known.valueType, found.valueType, path)
        return MapType(known.keyType, kind, True), new
    return known, []


def evolve(saved: StructType, found: StructType, mode: str) -> StructType:
    """The schema to ingest with, given what the files hold now; new fields inside columns count as new."""
    if mode not in MODES:
        raise ValueError(f"evolution must be one of {MODES}")
    wider, new = merged(saved, found)
    if new and mode == "fail_on_new_columns":
        raise ValueError(f"new columns in the source: {new}")
    return wider if mode == "add_new_columns" else saved


def as_text(schema: StructType) -> StructType:
    return StructType([StructField(f.name, StringType(), True) for f in schema])


def rescue_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast to ``schema``; what does not fit, or is not in it, is kept as JSON text.

    ``_rescued_data`` holds the original values by path (``a``, ``p.x``, ``items[0].x``) and is
    NULL for a row that fits. Columns of structs, arrays and maps are cast part by part, so
    one value that does not fit leaves its neighbours in place. A column named ``_malformed``
    (a line that could not be parsed) is only rescued.
    """
    have = {f.name: f.dataType for f in df.schema}
    place = {name: f"_raw{i}" for i, name in enumerate(have)}  # else a result's name could stand for its input
    df = df.select(*(F.col(quoted(name)).alias(raw) for name, raw in place.items()))
    casts: dict[str, Column] = {}
    misfits: list[Column] = []
    for field in schema:
        if field.name not in have:
            casts[field.name] = F.lit(None).cast(field.dataType)
            continue
        casts[field.name], kept = _fit(F.col(place[field.name]), have[field.name], field.dataType, F.lit(_step(field.name)))
        misfits += kept
    for name in have:
        if name not in schema.names:
            misfits.append(_entry(F.lit(_step(name)), F.col(place[name]), have[name]))

    rescued: Column = F.lit(None).cast("string")
    if misfits:
        kept = F.concat(*misfits)
        rescued = F.when(F.size(kept) > 0, F.to_json(F.map_from_entries(kept)))
    return df.select(*[casts[f.name].alias(f.name) for f in schema], rescued.alias(RESCUED))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _step(name: str) -> str:
    """A name as part of a path."""
    return quoted(name) if set(".[]`") & set(name) else name


def _none() -> Column:
    return F.array().cast("array<struct<path:string,value:string>>")


def _entry(path: Column, raw: Column, have: DataType, unless: Column | None = None) -> Column:
    """[(path, value as text)] of a value that is kept, [] of NULL or where ``unless`` holds."""
    text = F.to_json(raw) if isinstance(have, COMPLEX) else raw.cast("string")
    keep = raw.isNotNull() if unless is None else raw.isNotNull() & ~unless
    return F.when(keep, F.array(F.struct(path.alias("path"), text.alias("value")))).otherwise(_none())


def _fit(raw: Column, have: DataType, want: DataType, path: Column) -> tuple[Column, list[Column]]:
    """A value as ``want``, and arrays of (path, value) with what of it does not fit."""
    if have == want:
        return raw, []
    text = isinstance(have, StringType)
    if isinstance(want, StructType) and (text or isinstance(have, StructType)):
        return _fit_struct(raw, have, want, path)
    if isinstance(want, ArrayType) and (text or isinstance(have, ArrayType)):
        items = F.when(raw.rlike(r"^\s*\["), F.from_json(raw, "array<string>")) if text else raw
        kind = StringType() if text else have.elementType
        value = F.transform(items, lambda x: _fit(x, kind, want.elementType, path)[0])

        def of_item(x: Column, i: Column) -> Column:
            kept = _fit(x, kind, want.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")))[1]
            return F.concat(*kept) if kept else _none()

        inside = F.coalesce(F.flatten(F.transform(items, of_item)), _none())
        return value, [inside, *([_entry(path, raw, have, items.isNotNull())] if text else [])]
    if isinstance(want, MapType) and (text or isinstance(have, MapType)):
        held = F.when(raw.rlike(r"^\s*\{"), F.from_json(raw, "map<string,string>")) if text else raw
        key, kind = (StringType(), StringType()) if text else (have.keyType, have.valueType)
        if key == want.keyType:
            value = F.transform_values(held, lambda _, x: _fit(x, kind, want.valueType, path)[0])

            def of_entry(e: Column) -> Column:
                kept = _fit(e["value"], kind, want.valueType, F.concat(path, F.lit("["), e["key"].cast("string"), F.lit("]")))[1]
                return F.concat(*kept) if kept else _none()

            inside = F.coalesce(F.flatten(F.transform(F.map_entries(held), of_entry)), _none())
            return value, [inside, *([_entry(path, raw, have, held.isNotNull())] if text else [])]
    if isinstance(want, COMPLEX) or isinstance(have, COMPLEX):
        if isinstance(want, StringType):
            return F.to_json(raw), []
        return F.lit(None).cast(want), [_entry(path, raw, have)]
    value = _convert(raw, have, want)
    return value, [_entry(path, raw, have, value.isNotNull())]


def _fit_struct(raw: Column, have: DataType, want: StructType, path: Column) -> tuple[Column, list[Column]]:
    """Field by field; JSON text is read one level at a time, so that each part keeps its own text."""
    inner = lambda name: F.concat(path, F.lit("." + _step(name)))
    text = isinstance(have, StringType)
    if text:
        held = F.when(raw.rlike(r"^\s*\{"), F.from_json(raw, "map<string,string>"))
        fields = {f.name: (F.element_at(held, f.name), StringType()) for f in want}
        others = F.filter(F.array_distinct(F.map_keys(held)), lambda k: ~k.isin(want.names))
        extra = F.transform(others, lambda k: F.struct(F.concat(path, F.lit("."), k).alias("path"), F.element_at(held, k).alias("value")))
        misfits = [F.coalesce(F.filter(extra, lambda e: e["value"].isNotNull()), _none()), _entry(path, raw, have, held.isNotNull())]
    else:
        held = raw
        fields = {f.name: (raw.getField(f.name), f.dataType) for f in have}
        misfits = [_entry(inner(name), value, kind) for name, (value, kind) in fields.items() if name not in want.names]
    parts = []
    for field in want:
        if field.name in fields:
            value, kept = _fit(*fields[field.name], field.dataType, inner(field.name))
            misfits += kept
        else:
            value = F.lit(None).cast(field.dataType)
        parts.append(value.alias(field.name))
    return F.when(held.isNotNull(), F.struct(*parts)), misfits


def _convert(raw: Column, have: DataType, want: DataType) -> Column:
    cast = raw.try_cast(want)
    if isinstance(have, NumericType):
        # A number that changes its value in the other type does not fit it.
        return F.when(cast.try_cast(have) == raw, cast)
    return cast
