"""Result tables: write, append with new columns, replace by source file, placeholders, reset, load.

A result table is a view over Parquet tables of the session catalog, its segments: one for each schema the table
has had. The view casts what older segments hold to the type that holds all values, and gives NULL for columns
they lack, so old data is never written again. Replacing the view is the one step that makes a change of the
schema visible; the catalog does it as a whole. What the view reads is also in its properties:

- a segment that the view does not name is what a broken run left; the next change removes it;
- rows of a file that another segment replaces are hidden by the view first and dropped then; the names stay in
  the properties until they are.

So a run that breaks at any step leaves the old table or the new one. Rows of an unchanged schema go to the last
segment in place. One writer at a time is assumed, as many readers as like. A plain table of the same name, as
older versions wrote them, is taken over when it first has to widen.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

PARTITION = "source_file"


_FILE = "filename string, source_file string, ingest_ts timestamp"
_KEYS = "variant_id string, variant_key string, chrom string, pos bigint, ref string, alt string"
_CALL = "variant_id string, sample_id string, GT string, DP int, GQ int, AD string, PL string, phased boolean"

# Columns of the tables that must exist even without input for them.
SINGLE_CONSEQUENCES_SCHEMA = f"{_KEYS}, csq_index int, CSQ_raw string"
SINGLE_CALLS_SCHEMA = _CALL
CONSEQUENCES_SCHEMA = f"{_FILE}, {SINGLE_CONSEQUENCES_SCHEMA}"
CALLS_SCHEMA = (
    f"{_FILE}, {_CALL}, AF string, SB string, F1R2 string, F2R1 string, PID string, PGT string, PS int")
FILE_LOG_SCHEMA = (
    "run_id string NOT NULL, run_ts timestamp NOT NULL, vcf_path string, filename string, status string, "
    "stage string, pipe_enabled boolean, pipe_cmd string, pipe_header_mode string, pipe_header_vcf string, "
    "pipe_quarantine_table string, has_csq boolean, has_genotypes boolean, variants_rows bigint, "
    "calls_rows bigint, csq_rows bigint, error string")
QUARANTINE_SCHEMA = "raw string, reason string, run_id string, source_file string"

#: Property of the view that says what it reads, in pieces as long as all catalogs take; property of a copy that is whole.
STATE, PIECE, WHOLE = "locusframe.state", 3000, "locusframe.whole"
#: Types that hold every value of the ones before them. A 64-bit integer does not fit a double.
_NUMBERS = (T.BooleanType(), T.IntegerType(), T.DoubleType(), T.StringType())
_LONGS = (T.BooleanType(), T.IntegerType(), T.LongType(), T.StringType())


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds all values of both: numbers widen, a scalar beside an array becomes one, the rest is text."""
    if a == b:
        return a
    for order in (_NUMBERS, _LONGS):
        if a in order and b in order:
            return order[max(order.index(a), order.index(b))]
    if isinstance(a, T.ArrayType) or isinstance(b, T.ArrayType):
        inner = [t.elementType if isinstance(t, T.ArrayType) else t for t in (a, b)]
        if not any(isinstance(t, (T.StructType, T.MapType, T.ArrayType)) for t in inner):
            return T.ArrayType(common_type(*inner))
    return T.StringType()


def widened(value: str, own: T.DataType, wanted: T.DataType) -> str:
    """SQL of a value as a type that ``common_type`` gave for it."""
    if same_type(own, wanted):
        return value
    if isinstance(wanted, T.ArrayType):
        if isinstance(own, T.ArrayType):
            return f"transform({value}, x -> {widened('x', own.elementType, wanted.elementType)})"
        return f"CASE WHEN {value} IS NOT NULL THEN array({widened(value, own, wanted.elementType)}) END"
    if isinstance(own, (T.StructType, T.MapType, T.ArrayType)):
        return f"to_json({value})"
    return f"CAST({value} AS {wanted.simpleString()})"


def same_type(a: T.DataType, b: T.DataType) -> bool:
    return a.simpleString() == b.simpleString()


def _plain_type(field: T.StructField) -> T.DataType:
    return T.StringType() if isinstance(field.dataType, (T.CharType, T.VarcharType)) else field.dataType


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _as_schema(own: T.StructType, *later: T.StructType) -> list[str]:
    """SQL of the columns of the last schema over rows of ``own``; absent ones are NULL.

    A value takes the types between on its way, as it would have, had it been written again with each change.
    """
    given = {f.name.lower(): f for f in own.fields}
    types = [{f.name.lower(): _plain_type(f) for f in schema.fields} for schema in later]
    columns = []
    for f in later[-1].fields:
        held = given.get(f.name.lower())
        if held is None:
            value = f"CAST(NULL AS {f.dataType.simpleString()})"
        else:
            value, now = _quoted(held.name), _plain_type(held)
            for wanted in types:
                wider = wanted.get(f.name.lower(), now)
                value, now = widened(value, now, wider), wider
        columns.append(f"{value} AS {_quoted(f.name)}")
    return columns


@dataclass(frozen=True)
class _State:
    """Segments, oldest first, by the ends of their names, and the files whose rows no longer count in one."""

    segments: tuple[str, ...]
    retired: Mapping[str, Sequence[str]] = field(default_factory=dict)


def _run(spark: SparkSession, sql: str) -> DataFrame:
    return spark.sql(sql)


def _save(df: DataFrame, name: str, partition_by: str | None) -> None:
    writer = df.write.format("parquet").mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(name)


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _state(spark: SparkSession, name: str) -> _State | None:
    """What the view of that name reads; None for a table or view this package did not make."""
    properties = _properties(spark, name)
    pieces = []
    while f"{STATE}.{len(pieces)}" in properties:
        pieces.append(properties[f"{STATE}.{len(pieces)}"])
    if not pieces:
        return None
    held = json.loads("".join(pieces))
    return _State(tuple(held["segments"]), held["retired"])


def _publish(spark: SparkSession, name: str, state: _State) -> None:
    """Let the name stand for the given segments from now on; columns and types are those of the last one."""
    schemas = [spark.table(f"{name}__{segment}").schema for segment in state.segments]
    branches = []
    for k, segment in enumerate(state.segments):
        columns = ", ".join(_as_schema(*schemas[k:], schemas[-1]))
        hidden = ", ".join(_literal(path) for path in state.retired.get(segment, ()))
        where = f" WHERE {PARTITION} IS NULL OR {PARTITION} NOT IN ({hidden})" if hidden else ""
        branches.append(f"SELECT {columns} FROM {name}__{segment}{where}")
    text = json.dumps({"segments": state.segments, "retired": state.retired})
    properties = ", ".join(f"'{STATE}.{k}' = {_literal(text[k * PIECE:(k + 1) * PIECE])}" for k in range(-(-len(text) // PIECE)))
    _run(spark, f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({properties}) AS {' UNION ALL '.join(branches)}")


def _segments(spark: SparkSession, name: str) -> list[str]:
    """Ends of the names of all segments there are, those of broken runs too."""
    where, _, table = name.rpartition(".")
    listed = spark.sql(f"SHOW TABLES {f'IN {where} ' if where else ''}LIKE {_literal(table.lower() + '__v*')}").collect()
    ends = [r.tableName[len(table) + 2:] for r in listed]
    return sorted((e for e in ends if e[1:].isdigit()), key=lambda e: int(e[1:]))


def _new_segment(spark: SparkSession, name: str) -> str:
    known = _segments(spark, name)
    return f"v{int(known[-1][1:]) + 1 if known else 1}"


def table_exists(spark: SparkSession, name: str) -> bool:
    """Whether there is a table or view of that name, after ending what a broken take-over of a plain table began."""
    if spark.catalog.tableExists(name):
        return True
    whole = [s for s in _segments(spark, name) if WHOLE in _properties(spark, f"{name}__{s}")]
    if whole:
        _publish(spark, name, _State((whole[-1],)))
    return bool(whole)


def _settle(spark: SparkSession, name: str) -> _State | None:
    """Do what a broken run left undone: drop replaced rows and segments that do not count."""
    state = _state(spark, name)
    if state is None:
        return None
    if any(state.retired.values()):
        empty = set()
        for segment, files in state.retired.items():
            _drop_partitions(spark, f"{name}__{segment}", files)
            if segment != state.segments[-1] and spark.table(f"{name}__{segment}").isEmpty():
                empty.add(segment)
        state = _State(tuple(s for s in state.segments if s not in empty))
        _publish(spark, name, state)
    for segment in _segments(spark, name):
        if segment not in state.segments:
            _run(spark, f"DROP TABLE IF EXISTS {name}__{segment}")
    return state


def _take_over(spark: SparkSession, name: str) -> _State:
    """Make a plain table a segment: its rows are copied once, and stand in for it while it has no name."""
    copy = _new_segment(spark, name)
    _save(spark.table(name), f"{name}__{copy}", partition_column(spark, name))
    _run(spark, f"ALTER TABLE {name}__{copy} SET TBLPROPERTIES ('{WHOLE}' = 'true')")
    _run(spark, f"DROP TABLE {name}")
    state = _State((copy,))
    _publish(spark, name, state)
    return state


def partition_column(spark: SparkSession, name: str) -> str | None:
    """The column a result table is partitioned by."""
    state = _state(spark, name)
    stored = name if state is None else f"{name}__{state.segments[-1]}"
    return next((c.name for c in spark.catalog.listColumns(stored) if c.isPartition), None)


def write_table(df: DataFrame, name: str, mode: str = "overwrite", partition_by: str | None = None) -> None:
    """Create or replace a table with exactly the columns of ``df``; ``error`` and ``append`` are modes too."""
    spark = df.sparkSession
    if mode not in ("overwrite", "error", "append"):
        raise ValueError(f"mode must be overwrite, error or append, got {mode!r}")
    exists = table_exists(spark, name)
    if exists and mode == "error":
        raise ValueError(f"{name} exists")
    if exists and mode == "append":
        return append_table(df, name)
    segment = _new_segment(spark, name)
    _save(df, f"{name}__{segment}", partition_by)
    if exists and _state(spark, name) is None:
        _run(spark, f"ALTER TABLE {name}__{segment} SET TBLPROPERTIES ('{WHOLE}' = 'true')")
        _run(spark, f"DROP {'VIEW' if _is_view(spark, name) else 'TABLE'} {name}")
    _publish(spark, name, _State((segment,)))
    _settle(spark, name)


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType == "VIEW"


def _agreed(df: DataFrame, held: T.StructType) -> tuple[T.StructType, bool, list[T.StructField]]:
    """The columns that hold all values of a frame and a table, whether one of the table's widens, and which are new."""
    given = {f.name.lower(): f for f in df.schema.fields}
    fields, wider = [], False
    for f in held.fields:
        own = _plain_type(f)
        other = given.pop(f.name.lower(), None)
        both = own if other is None else common_type(own, _plain_type(other))
        wider = wider or not same_type(both, own)
        fields.append(T.StructField(f.name, both))
    new = [f for f in df.schema.fields if f.name.lower() in given]
    return T.StructType(fields + new), wider, new


def _add(df: DataFrame, name: str, replace: bool) -> None:
    """Add the rows of a frame to an existing table, or let them replace those of the same files."""
    spark = df.sparkSession
    state = _settle(spark, name)
    schema, wider, new = _agreed(df, spark.table(name).schema)
    if state is None and wider:
        state = _take_over(spark, name)
    last = name if state is None else f"{name}__{state.segments[-1]}"
    begin = wider
    retired: dict[str, list[str]] = {}
    if replace and state is not None and (wider or len(state.segments) > 1):
        files = df.select(PARTITION).distinct()
        for segment in state.segments if wider else state.segments[:-1]:
            both = spark.table(f"{name}__{segment}").select(PARTITION).distinct().join(files, PARTITION)
            found = [r[0] for r in both.collect()]
            if found:
                retired[segment] = found
        if retired and not wider:  # rows of these files come from two segments, which takes a switch
            begin = True
            both = spark.table(last).select(PARTITION).distinct().join(files, PARTITION)
            retired[state.segments[-1]] = [r[0] for r in both.collect()]
    if begin:
        segment = _new_segment(spark, name)
        rows = df.selectExpr(*_as_schema(df.schema, schema))
        _save(rows, f"{name}__{segment}", partition_column(spark, name))
        _publish(spark, name, _State((*state.segments, segment), retired))
        _settle(spark, name)
        return
    if new:
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in new)
        _run(spark, f"ALTER TABLE {last} ADD COLUMNS ({columns})")
        if state is not None:
            _publish(spark, name, state)
    rows = df.selectExpr(*_as_schema(df.schema, spark.table(last).schema))
    if replace:
        with _overwrite_only_written_partitions(spark):
            rows.write.insertInto(last, overwrite=True)
    else:
        rows.write.insertInto(last)


def append_table(df: DataFrame, name: str, partition_by: str | None = None) -> None:
    """Append; columns the table lacks are added to it, columns the frame lacks become NULL, types widen without loss."""
    if not table_exists(df.sparkSession, name):
        write_table(df, name, partition_by=partition_by)
    else:
        _add(df, name, replace=False)


@contextmanager
def _overwrite_only_written_partitions(spark: SparkSession) -> Iterator[None]:
    """insertInto takes this mode from the session alone."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def replace_files(df: DataFrame, name: str) -> None:
    """Replace the rows of the source files in ``df`` and leave those of other files alone.

    The table is partitioned by source file, so running a file again never doubles its rows. Where the schema
    widens, the files that were there before are listed on the driver, by name.
    """
    if not table_exists(df.sparkSession, name):
        write_table(df, name, partition_by=PARTITION)
    else:
        _add(df, name, replace=True)


def _drop_partitions(spark: SparkSession, table: str, files: Iterable[str]) -> None:
    names = [_literal(path) for path in files]
    for begin in range(0, len(names), 1000):
        parts = ", ".join(f"PARTITION ({PARTITION}={x})" for x in names[begin:begin + 1000])
        _run(spark, f"ALTER TABLE {table} DROP IF EXISTS {parts}")


def drop_files(spark: SparkSession, name: str, files: Iterable[str]) -> None:
    """Drop the rows of the given source files."""
    files, state = list(files), _settle(spark, name)
    if files:
        for table in [name] if state is None else [f"{name}__{s}" for s in state.segments]:
            _drop_partitions(spark, table, files)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType | str, first_write: bool = False,
                 partition_by: str | None = None) -> None:
    """Create an empty typed table if there is none; ``first_write`` empties an existing one too."""
    if first_write or not table_exists(spark, name):
        write_table(spark.createDataFrame([], schema), name, partition_by=partition_by)


def reset_outputs(spark: SparkSession, names: Iterable[str]) -> list[str]:
    """Drop the tables or views that exist; names must be catalog.schema.name. Returns what was dropped."""
    names = list(names)
    for name in names:
        if len(name.split(".")) != 3:
            raise ValueError(f"expected catalog.schema.name, got {name!r}")
    dropped = []
    for name in names:
        if table_exists(spark, name):
            segments = _segments(spark, name) if _state(spark, name) is not None else []
            _run(spark, f"DROP {'VIEW' if _is_view(spark, name) else 'TABLE'} IF EXISTS {name}")
            for segment in segments:
                _run(spark, f"DROP TABLE IF EXISTS {name}__{segment}")
            dropped.append(name)
    return dropped


def load_table(spark: SparkSession, name: str) -> DataFrame:
    """A result table; a folder path reads Parquet parts with differing columns."""
    if "/" in name:
        return spark.read.option("mergeSchema", "true").parquet(name)
    return spark.table(name)
