"""Schema lookups and column expressions shared by the flattening operators.

Everything here looks only at the schema on the driver and returns Column expressions.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Accepted names of the four core columns, preferred name first.
CORE_COLUMN_NAMES = {
    "chrom": ("contigName", "chrom"),
    "pos": ("start", "pos"),
    "ref": ("referenceAllele", "ref"),
    "alt": ("alternateAlleles", "alt"),
}


def field_type(schema: T.DataType, name: str) -> T.DataType | None:
    """Type of a top-level column or struct field, None if there is no such field."""
    if isinstance(schema, T.StructType) and name in schema.fieldNames():
        return schema[name].dataType
    return None


def has_field(schema: T.DataType, name: str) -> bool:
    return field_type(schema, name) is not None


def typed_columns(df: DataFrame, **wanted: str) -> list[Column]:
    """The wanted columns under their names, each as the given type; NULL of that type where the frame has none."""
    present = set(df.columns)
    return [(F.col(f"`{name}`") if name in present else F.lit(None)).cast(ddl).alias(name) for name, ddl in wanted.items()]


def rendered(column: Column, data_type: T.DataType, text: bool = False) -> Column:
    """A value as flat tables hold it: nested ones as JSON, scalars as they are, or as text if asked."""
    match data_type:
        case T.ArrayType() | T.MapType() | T.StructType():
            return F.to_json(column)
        case _:
            return column.cast("string") if text else column


def first_field(struct: Column, struct_type: T.StructType, *names: str) -> Column:
    """The first of ``names`` the struct has, else NULL."""
    for name in names:
        if has_field(struct_type, name):
            return struct.getField(name)
    return F.lit(None)


def resolve_core_columns(df: DataFrame) -> dict[str, str]:
    """Map chrom/pos/ref/alt to the names this frame uses for them."""
    found = {
        role: next((name for name in names if name in df.columns), None)
        for role, names in CORE_COLUMN_NAMES.items()
    }
    missing = [role for role, name in found.items() if name is None]
    if missing:
        raise ValueError(f"no column for {', '.join(missing)}; the frame has: {', '.join(df.columns)}")
    return found


def one_based_pos(column_name: str) -> Column:
    """1-based position: ``start`` counts from 0, any other position column from 1."""
    column = F.col(column_name)
    return ((column + 1) if column_name == "start" else column).cast("long")


def variant_key(chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    """``chrom:pos:ref:alt``; a NULL alt leaves a key of three parts."""
    return F.concat_ws(":", chrom, pos.cast("string"), ref, alt)


def variant_id(key: Column) -> Column:
    """64-bit hash of the variant key, as decimal text."""
    return F.xxhash64(key).cast("string")


def basename(path: Column) -> Column:
    """Last part of a path; a trailing slash is ignored."""
    return F.element_at(F.split(F.rtrim(path, F.lit("/")), "/"), -1)


def provenance(df: DataFrame, source: Column, ingest_ts: datetime | None = None) -> DataFrame:
    """Add source_file, filename and one ingest timestamp for the whole run."""
    stamp = F.lit(ingest_ts) if ingest_ts is not None else F.current_timestamp()
    return df.withColumns({
        "source_file": source,
        "filename": basename(source),
        "ingest_ts": stamp.cast("timestamp"),
    })


def struct_leaves(struct_type: T.StructType, prefix: str = "") -> list[tuple[str, tuple[str, ...], T.DataType]]:
    """Name, path and type of every leaf; the name joins the path with ``_``."""
    leaves = []
    for field in struct_type.fields:
        if isinstance(field.dataType, T.StructType):
            below = struct_leaves(field.dataType, f"{prefix}{field.name}_")
            leaves += [(name, (field.name, *path), leaf) for name, path, leaf in below]
        else:
            leaves.append((prefix + field.name, (field.name,), field.dataType))
    return leaves


def leaf_value(struct: Column, path: tuple[str, ...]) -> Column:
    return reduce(Column.getField, path, struct)


def flatten_struct(prefix: str, struct: Column, struct_type: T.StructType) -> list[Column]:
    """Every leaf of a struct as a string column; arrays and maps become JSON."""
    return [
        rendered(value, leaf, text=True).alias(name)
        for name, value, leaf in (
            (name, leaf_value(struct, path), leaf) for name, path, leaf in struct_leaves(struct_type, prefix))
    ]
