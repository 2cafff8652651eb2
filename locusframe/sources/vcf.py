"""Read variant-call text into nested records, without loss.

One text scan over all files. Columns are native expressions, but for plain sample cells, which Arrow batches take.
What differs by file (sample names, consequence format) comes from a small header table joined by path.

Nothing that a line holds vanishes. INFO keys that no header declares, repeated keys and values of flags are kept in
the map ``undeclared_info``, from which :func:`promote_undeclared` makes columns. A line is malformed, and raises,
is kept as it is or is dropped, also if one of its values is not of the declared type, if its FORMAT has an
undeclared key, or if a sample has more values than FORMAT has keys.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import basename, let, once
from ..operators.split import NUMBER_KEY
from ..scratch import materialize
from .files import VCF_SUFFIXES, discover_files, is_hidden, parent, resolve_roots, source_path
from .header import Field, Layout, merge_layout, per_file, read_headers
from .ranges import ORDER, RANGE_BYTES, file_kinds, read_ranges
from .samples import read_samples

# Genotype fields with a name of their own in the record.
GENOTYPE_NAMES = {
    "DP": "depth", "GQ": "conditionalQuality", "AD": "alleleDepths",
    "PL": "phredLikelihoods", "GL": "genotypeLikelihoods",
}
# Fixed value: INFO flag that carries the split mark through VCF text.
SPLIT_FLAG = "SPLIT_FROM_MULTIALLELIC"
MODES = ("drop", "fail", "keep")
#: Lines of a slice of a file that Spark's text source reads, as a power of two.
SLICE_BITS = 16


def _present(text: Column) -> Column:
    """The text, NULL where it is the missing-value mark or empty."""
    return F.when((text != ".") & (text != ""), text)


def _cast(value: Column, data_type: T.DataType, fault: Column | None) -> Column:
    """A present value as a type; one that does not parse is NULL, or raises ``fault`` if that is given.

    The missing-value mark is taken out before the cast: a failed try_cast costs an exception.
    """
    found = value.try_cast(data_type)
    return found if fault is None else F.when(value.isNotNull(), F.coalesce(found, F.raise_error(fault).cast(data_type)))


def _typed(text: Column, spec: Field, fault: Column | None = None) -> Column:
    """Text of one INFO or FORMAT value as its header type; see ``_cast`` for what does not parse."""
    if spec.is_scalar:
        return _present(text) if spec.is_text else _cast(_present(text), spec.spark_type, fault)
    element = spec.spark_type.elementType

    def parse(value: Column) -> Column:
        parts = F.split(_present(value), ",")
        return F.transform(parts, lambda v: _present(v) if spec.is_text else _cast(_present(v), element, fault))

    return let(text, parse)


def _unparsable(text: Column, spec: Field) -> Column:
    """Whether a value is there that is not of its header type."""
    def wrong(value: Column, data_type: T.DataType) -> Column:
        return _present(value).isNotNull() & _present(value).try_cast(data_type).isNull()

    if spec.is_scalar:
        return F.coalesce(wrong(text, spec.spark_type), F.lit(False))
    element = spec.spark_type.elementType
    return F.coalesce(F.exists(F.split(_present(text), ","), lambda v: wrong(v, element)), F.lit(False))


def _after_equals(pair: Column) -> Column:
    at = F.instr(pair, "=")
    return F.when(at > 0, pair.substr(at + 1, F.length(pair))).otherwise("")


def _info_names(layout: Layout) -> tuple[list[str], list[str]]:
    """The flags and the keys with values that INFO columns are made of."""
    flags = list(dict.fromkeys([f.name for f in layout.info if f.type == "Flag"] + [SPLIT_FLAG]))
    valued = [f.name for f in layout.info] + ["END"] + (["CSQ"] if layout.has_csq else [])
    return flags, [name for name in dict.fromkeys(valued) if name not in flags]


def _is_plain(layout: Layout, info: Column) -> Column:
    """Whether every entry is a flag, or a key with a value, that INFO columns are made of, and none is there twice.

    It is if as many of those are found as there are entries. ``info`` begins and ends with a semicolon.
    """
    flags, valued = _info_names(layout)
    found = [info.contains(f";{name};") for name in flags] + [info.contains(f";{name}=") for name in valued]
    entries = F.length(info) - F.length(F.replace(info, F.lit(";"), F.lit(""))) - 1
    return sum((x.cast("int") for x in found), F.lit(0)) == entries


def _info_values(layout: Layout, info: Column, keys: Column, values: Column) -> Column:
    """The text of each key (``value_<key>``) and whether each flag is there (``flag_<key>``), as a struct.

    A plain INFO is cut by text functions; ``keys`` and ``values`` are those of one that is not, else NULL. Functions on
    lists are interpreted, and there a position found in a list costs an exception.
    """
    flags, valued = _info_names(layout)

    def listed(name: str) -> Column:
        return F.get(values, (F.array_position(keys, name) - 1).cast("int"))

    def value(name: str) -> Column:
        begin = F.instr(info, f";{name}=")
        cut = F.when(begin > 0, F.substring_index(info.substr(begin + len(name) + 2, F.length(info)), ";", 1))
        return F.when(keys.isNull(), cut).otherwise(listed(name))

    def flag(name: str) -> Column:
        held = F.when(keys.isNull(), info.contains(f";{name};")).otherwise(F.array_contains(keys, name))
        return F.coalesce(held, F.lit(False))

    return F.struct(*[value(n).alias(f"value_{n}") for n in valued], *[listed(n).alias(f"value_{n}") for n in flags],
                    *[flag(n).alias(f"flag_{n}") for n in flags])


def _value_of(name: str) -> Column:
    return F.col("held").getField(f"value_{name}")


def _has_flag(name: str) -> Column:
    return F.col("held").getField(f"flag_{name}")


def _message(fault: Column | str) -> Column:
    text = F.lit(fault) if isinstance(fault, str) else fault
    return F.concat(F.lit("malformed VCF line in "), F.col("source_file"), F.lit(": "), text)


def _type_fault(section: str, spec: Field) -> str:
    return f"{section} {spec.name} is no {spec.type}"


def _info_column(spec: Field, layout: Layout, strict: bool) -> Column:
    if spec.type == "Flag":
        found = _has_flag(spec.name)
        if spec.name in layout.optional_flags:
            found = F.when(F.array_contains("flags", spec.name), found)
        return found
    return _typed(_value_of(spec.name), spec, _message(_type_fault("INFO", spec)) if strict else None)


def _info_fault(layout: Layout) -> Column:
    """Which INFO value is not of its type, NULL if all are."""
    fault = F.when(_unparsable(_value_of("END"), Field("END", "Integer", "1")), "INFO END is no Integer")
    for spec in layout.info:
        if not spec.is_text and spec.type != "Flag" and spec.name != "END":
            fault = fault.when(_unparsable(_value_of(spec.name), spec), _type_fault("INFO", spec))
    return fault


def _undeclared(layout: Layout, pairs: Column) -> Column:
    """What no INFO column holds, as a map by key; NULL if there is nothing. Keys without a value have none."""
    flags = [f.name for f in layout.info if f.type == "Flag"] + [SPLIT_FLAG]
    known = [f.name for f in layout.info] + [SPLIT_FLAG, "END"] + (["CSQ"] if layout.has_csq else [])

    def key(pair: Column) -> Column:
        return F.substring_index(pair, "=", 1)

    def beyond(all_pairs: Column) -> Column:
        names = F.transform(all_pairs, key)
        return let(F.struct(all_pairs.alias("pairs"), names.alias("names")), lambda both: F.filter(
            both["pairs"], lambda pair, i: (pair != "") & (
                ~key(pair).isin(known) | (F.array_position(both["names"], key(pair)) != i + 1)
                | (key(pair).isin(flags) & pair.contains("=")))))

    def value(name: Column, extra: Column) -> Column:
        own = F.filter(extra, lambda pair: key(pair) == name)
        return F.when(F.exists(own, lambda pair: pair.contains("=")), F.array_join(F.transform(own, _after_equals), ","))

    def as_map(extra: Column) -> Column:
        names = F.array_distinct(F.transform(extra, key))
        return F.when(F.size(extra) > 0, F.map_from_arrays(names, F.transform(names, lambda name: value(name, extra))))

    return F.when(pairs.isNotNull(), let(let(pairs, beyond), as_map))


def _consequences(layout: Layout) -> Column:
    entries = F.split(_present(_value_of("CSQ")), ",")
    if not layout.csq_fields:
        return entries
    names = layout.csq_fields
    parts = F.transform(entries, lambda e: F.split(e, r"\|"))
    if len(layout.csq_formats) == 1:
        return F.transform(parts, lambda p: F.struct(*[F.get(p, F.lit(i)).alias(n) for i, n in enumerate(names)]))
    order = F.split("csq_format", r"\|")
    return F.transform(parts, lambda p: F.struct(
        *[F.get(p, (F.array_position(order, n) - 1).cast("int")).alias(n) for n in names]))


def _sample_cells(cells: Column) -> Column:
    return F.slice(cells, F.lit(10), F.greatest(F.size(cells) - 9, F.lit(0)))


def _plain_genotypes(layout: Layout, cells: Column) -> Column | None:
    """The sample cells as structs if all are plain, else NULL; None if the layout has none that could be."""
    specs = [f for f in layout.formats if f.name != "GT"]
    struct = T.StructType().add("sampleId", "string").add("calls", T.ArrayType(T.IntegerType())).add("phased", "boolean")
    for f in specs:
        struct = struct.add(GENOTYPE_NAMES.get(f.name, f.name), f.spark_type)
    formats = F.when(F.col("has_genotypes"), F.get(cells, F.lit(8)))
    return read_samples(struct, [(f.name, f.type, f.is_scalar) for f in specs], formats, _sample_cells(cells), F.col("samples"))


def _genotypes(layout: Layout, cells: Column, strict: bool) -> Column:
    """The sample cells as structs. Where each FORMAT key stands is worked out once per line.

    A value that does not fit raises if ``strict``; else the struct has a field ``misfit`` that says so.
    """
    names = ["GT"] + [f.name for f in layout.formats if f.name != "GT"]
    specs = [f for f in layout.formats if f.name != "GT"]
    samples = _sample_cells(cells)

    def allele(text: Column) -> Column:
        found = _cast(_present(text), T.IntegerType(), _message("GT is no genotype") if strict else None)
        return F.coalesce(found, F.lit(-1))

    def all_samples(at: Column) -> Column:
        def one(part: Column, i: Column) -> Column:
            gt = F.get(part, at["GT"])
            alleles = F.split(F.translate(gt, "|", "/"), "/")
            too_many = F.size(part) > at["keys"]
            sample = F.get(F.col("samples"), i)
            if strict:
                sample = F.when(too_many, F.raise_error(_message("sample with more values than FORMAT has keys"))).otherwise(sample)
            fields = [
                sample.alias("sampleId"),
                F.transform(alleles, allele).alias("calls"),
                (gt.contains("|") & ~gt.contains("/")).alias("phased"),
            ]
            fields += [_typed(F.get(part, at[f.name]), f, _message(_type_fault("FORMAT", f)) if strict else None).alias(
                GENOTYPE_NAMES.get(f.name, f.name)) for f in specs]
            if not strict:
                wrong = [too_many, F.coalesce(F.exists(alleles, lambda a: _present(a).isNotNull() & _present(a).try_cast("int").isNull()), F.lit(False))]
                wrong += [_unparsable(F.get(part, at[f.name]), f) for f in specs if not f.is_text]
                fields.append(reduce(or_, wrong).alias("misfit"))
            return F.struct(*fields)

        return F.transform(F.transform(samples, lambda s: F.split(s, ":")), one)

    def positions(keys: Column) -> Column:
        return F.struct(*[(F.array_position(keys, n) - 1).cast("int").alias(n) for n in names], F.size(keys).alias("keys"))

    described = let(let(F.split(F.get(cells, F.lit(8)), ":"), positions), all_samples)
    return F.when(F.col("has_genotypes"), described)


def _fault(cells: Column, layout: Layout) -> Column:
    """Why a line is no record, NULL for one of the right shape."""
    pos, ref, qual = F.get(cells, F.lit(1)), F.get(cells, F.lit(3)), F.get(cells, F.lit(5))
    formats = ["GT", ".", "", *(f.name for f in layout.formats)]
    return (
        F.when(F.col("column_count").isNull(), "file has no header")
        .when(F.size(cells) != F.col("column_count"), "wrong number of columns")
        .when(F.coalesce(pos.try_cast("long"), F.lit(-1)) < 0, "position is no number")
        .when(F.coalesce(_present(ref), F.lit("")) == "", "no reference allele")
        .when(_present(qual).isNotNull() & _present(qual).try_cast("double").isNull(), "quality is no number")
        .when(F.coalesce(F.exists(F.split(F.get(cells, F.lit(8)), ":"), lambda k: ~k.isin(formats)), F.lit(False)),
              "FORMAT key that no header declares")
    )


def parse_records(lines: DataFrame, layout: Layout, mode: str = "fail", samples_at_once: int | None = None) -> DataFrame:
    """Data lines that :func:`describe` has told of their files to records.

    Malformed lines raise, are kept with ``corrupt_line`` and ``corrupt_reason`` filled and ``contigName`` NULL,
    or are dropped. A value that is not of its type raises when it is read. The columns of ``ORDER`` are kept.
    With ``samples_at_once`` a line is repeated for each so many of its samples.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}, got {mode!r}")
    strict = mode == "fail"
    rows = once(lines, cells=F.split("line", "\t"))
    if strict:
        fault = _fault(F.col("cells"), layout)
        raised = F.coalesce(F.raise_error(_message(fault)).cast("boolean"), F.lit(False))
        rows = rows.where(F.when(fault.isNull(), True).otherwise(raised))
    else:
        rows = once(rows, fault=_fault(F.col("cells"), layout))
        rows = rows.withColumn("cells", F.when(F.col("fault").isNull(), F.col("cells")))
    if samples_at_once is not None:
        rows = _by_sample_slices(rows, samples_at_once)
    plain = _plain_genotypes(layout, F.col("cells")) if layout.has_samples else None
    if plain is not None:
        rows = rows.withColumn("plain", plain)
    rows = once(rows, info=F.concat(F.lit(";"), _present(F.get("cells", F.lit(7))), F.lit(";")))
    listed = F.split(F.col("info").substr(F.lit(2), F.length("info") - 2), ";")
    rows = once(rows, pairs=F.when(~_is_plain(layout, F.col("info")), listed))
    rows = once(rows, keys=F.transform("pairs", lambda p: F.substring_index(p, "=", 1)), values=F.transform("pairs", _after_equals))
    rows = once(rows, held=_info_values(layout, F.col("info"), F.col("keys"), F.col("values")))

    cells = F.col("cells")

    def cell(i: int) -> Column:
        return _present(F.get(cells, F.lit(i)))

    start = cell(1).try_cast("long") - 1
    info_end = _cast(_present(_value_of("END")), T.LongType(), _message("INFO END is no Integer") if strict else None)
    alts = F.when(cells.isNotNull(), F.coalesce(F.split(cell(4), ","), F.array().cast("array<string>")))
    columns = [
        cell(0).alias("contigName"), start.alias("start"),
        F.coalesce(info_end, start + F.length(cell(3))).alias("end"),
        F.split(cell(2), ";").alias("names"), cell(3).alias("referenceAllele"), alts.alias("alternateAlleles"),
        cell(5).try_cast("double").alias("qual"), F.split(cell(6), ";").alias("filters"),
        F.when(cells.isNotNull(), _has_flag(SPLIT_FLAG)).alias("splitFromMultiAllelic"),
    ]
    columns += [_info_column(f, layout, strict).alias(f"INFO_{f.name}", metadata={NUMBER_KEY: f.number})
                for f in layout.info if f.name != SPLIT_FLAG]
    if layout.has_csq:
        columns.append(_consequences(layout).alias("INFO_CSQ"))
    columns.append(_undeclared(layout, F.col("pairs")).alias("undeclared_info"))
    numbers = {NUMBER_KEY: {GENOTYPE_NAMES.get(f.name, f.name): f.number for f in layout.formats}}
    if layout.has_samples:
        genotypes = _genotypes(layout, cells, strict)
        if plain is not None:
            genotypes = F.when(F.col("plain").isNull(), genotypes)
        if not strict:
            rows = once(rows, described=genotypes)
            genotypes = F.transform("described", lambda g: g.dropFields("misfit"))
        if plain is not None:
            genotypes = F.coalesce("plain", genotypes)
        columns.append(genotypes.alias("genotypes", metadata=numbers))
    columns += [F.col("source_file"), *[F.col(c) for c in ORDER if c in lines.columns],
                F.coalesce("has_csq", F.lit(False)).alias("has_csq")]
    if strict:
        return rows.select(*columns)
    # the reason is what filters ask for, so neither it nor what it is made of may be copied into them
    reason = F.coalesce("fault", _info_fault(layout))
    if layout.has_samples:
        misfit = F.coalesce(F.exists("described", lambda g: g["misfit"]), F.lit(False))
        reason = F.coalesce(reason, F.when(misfit, "sample value that does not fit its FORMAT"))
    parsed = once(rows, reason=reason).select(*columns, F.col("line"), F.col("reason"))
    reason = F.col("reason")
    if mode == "drop":
        return parsed.where(reason.isNull()).drop("line", "reason")
    return parsed.withColumns({
        "contigName": F.when(reason.isNull(), F.col("contigName")),
        "corrupt_line": F.when(reason.isNotNull(), F.col("line")), "corrupt_reason": reason}).drop("line", "reason")


def _by_sample_slices(rows: DataFrame, width: int) -> DataFrame:
    """Each line once for every ``width`` of its samples: the site cells with the cells and names of these alone."""
    first = F.explode(F.sequence(F.lit(0), F.greatest(F.size("samples") - 1, F.lit(0)), F.lit(width)))
    at = F.col("first_sample")
    return rows.withColumn("first_sample", first).withColumns({
        "cells": F.concat(F.slice("cells", 1, 9), F.slice("cells", at + 10, F.lit(width))),
        "samples": F.slice("samples", at + 1, F.lit(width))}).drop("first_sample")


def promote_undeclared(df: DataFrame) -> DataFrame:
    """INFO columns of type String for the keys that no header declares, in place of their map.

    A key without value gives ``true``. A key whose column name is taken, also in other case, gets a number. The
    distinct keys are all the driver sees; reading them is a scan, so pass a written table.
    """
    if "undeclared_info" not in df.columns:
        return df
    keys = sorted(r.key for r in df.select(F.explode(F.map_keys("undeclared_info")).alias("key")).distinct().collect())
    taken, columns = {c.lower() for c in df.columns}, {}
    for key in keys:
        name = next(n for n in (f"INFO_{key}{f'_{k}' if k > 1 else ''}" for k in range(1, len(keys) + len(taken) + 2))
                    if n.lower() not in taken)
        taken.add(name.lower())
        held = F.col("undeclared_info")
        columns[name] = F.when(F.array_contains(F.map_keys(held), key), F.coalesce(F.element_at(held, key), F.lit("true")))
    return df.select("*", *[c.alias(n, metadata={NUMBER_KEY: "1"}) for n, c in columns.items()]).drop("undeclared_info")


def scan_lines(spark: SparkSession, paths: str | Sequence[str], suffixes: Sequence[str] = VCF_SUFFIXES,
               only: Iterable[str] | None = None, last_path: str | None = None,
               without: Sequence[str] = (), files: DataFrame | None = None, gz_spread_bytes: int = 128 << 20,
               range_bytes: int = RANGE_BYTES, direct: bool | None = None) -> DataFrame:
    """Data lines (source_file, slice, line_number, line) of the matching files.

    Spark's text source reads what it can split. Gzip files above ``gz_spread_bytes`` and files whose names it
    leaves out are read by ranges in tasks; where tasks cannot open files (``direct``), each gzip file is one
    task of the text source, and such names are an error. A slice holds neighbouring lines in one partition.
    """
    roots = resolve_roots(spark, paths)
    direct = roots.direct if direct is None else direct
    if files is None:
        files = materialize(discover_files(spark, paths, suffixes, only), "files")
    path, packed = source_path(), F.lower("path").endswith(".gz")
    by_range = is_hidden(F.col("path")) | (packed & (F.col("length") > gz_spread_bytes)) if direct else is_hidden(F.col("path"))
    if without:
        files = files.where(~F.col("path").isin(list(without)))
    counted = files.agg(F.count_if(by_range).alias("ranges"), F.count_if(~by_range).alias("scanned")).first()
    if counted.ranges and not direct:
        name = files.where(by_range).orderBy("path").first().path
        raise ValueError(f"no reader for {name}: names that begin with _ or . need a file system that tasks can open")

    read = None
    if counted.scanned:
        raw = spark.read.text(roots.globs(suffixes))
        if roots.folders:  # a glob may also match a folder, whose files are none of ours
            raw = raw.where(parent(path).isin(list(roots.folders)) | path.isin([f for f, _ in roots.files]))
        if direct:
            raw = raw.where(~F.lower(path).endswith(".gz") | (F.col("_metadata.file_size") <= gz_spread_bytes))
        if only is not None:
            raw = raw.where(basename(path).isin(sorted(set(only))))
        if last_path is not None:
            raw = raw.where(path <= last_path)
        if without:
            raw = raw.where(~path.isin(list(without)))
        number = F.monotonically_increasing_id()
        read = raw.select(path.alias("source_file"), number.alias("line_number"), F.col("value").alias("line")).select(
            "source_file", F.shiftright("line_number", SLICE_BITS).alias("slice"), "line_number", "line")
    if counted.ranges:
        kinds = materialize(file_kinds(files.where(by_range)), "kinds")
        ranged = read_ranges(kinds, gz_spread_bytes, range_bytes)
        read = ranged if read is None else read.unionByName(ranged)
    if read is None:
        read = spark.createDataFrame([], "source_file string, slice long, line_number long, line string")
    return read.where(~F.col("line").startswith("#") & (F.col("line") != ""))


def read_vcf(
    spark: SparkSession, paths: str | Sequence[str], mode: str = "fail", only: Iterable[str] | None = None,
    limit: int | None = None, suffixes: Sequence[str] = VCF_SUFFIXES, headers: DataFrame | None = None,
    header_method: str = "auto", gz_spread_bytes: int = 128 << 20, broadcast_bytes: int = 64 << 20,
    range_bytes: int = RANGE_BYTES, without: Sequence[str] = (), files: DataFrame | None = None, ordered: bool = False,
) -> DataFrame:
    """All variant-call files of a folder (or the given paths) as one frame of nested records.

    ``headers`` takes header lines already read, ``files`` a listing; ``header_method`` is that of
    :func:`read_headers`; ``without`` names paths to leave out. Gzip files above ``gz_spread_bytes`` are read by
    many tasks if they are blocked, ``range_bytes`` each, else unpacked by one and spread in slices. With ``ordered`` the columns
    ``slice`` and ``line_number`` say where a record stood. What headers say is broadcast below ``broadcast_bytes``.
    """
    lines, files, layout = _described(spark, paths, only, limit, suffixes, headers, header_method, gz_spread_bytes,
                                      range_bytes, without, files)
    return parse_by_file(lines if ordered else lines.drop(*ORDER), files, layout, mode, broadcast_bytes)


def read_call_slices(spark: SparkSession, paths: str | Sequence[str], samples_at_once: int = 256, mode: str = "fail",
                     only: Iterable[str] | None = None, limit: int | None = None, suffixes: Sequence[str] = VCF_SUFFIXES,
                     headers: DataFrame | None = None, header_method: str = "auto", gz_spread_bytes: int = 128 << 20,
                     broadcast_bytes: int = 64 << 20, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Records for the calls of wide cohorts: each line repeats for every ``samples_at_once`` of its samples.

    ``variant_calls`` gives the same rows for them as for the records of :func:`read_vcf`, but no row ever holds the
    parsed genotypes of more samples than that. Not for the tables by variant, whose rows would repeat.
    """
    lines, files, layout = _described(spark, paths, only, limit, suffixes, headers, header_method, gz_spread_bytes, range_bytes, (), None)
    records = parse_by_file(lines.drop(*ORDER), files, layout, mode, broadcast_bytes, samples_at_once)
    core = ["contigName", "start", "referenceAllele", "alternateAlleles", "genotypes", "source_file"]
    return records.select(*[c for c in records.columns if c in core or c.startswith("corrupt_")])


def _described(spark: SparkSession, paths: str | Sequence[str], only: Iterable[str] | None, limit: int | None, suffixes: Sequence[str],
               headers: DataFrame | None, header_method: str, gz_spread_bytes: int, range_bytes: int, without: Sequence[str],
               files: DataFrame | None) -> tuple[DataFrame, DataFrame, Layout]:
    """Lines, per-file header table and layout of the files that are asked for."""
    if files is None:
        files = materialize(discover_files(spark, paths, suffixes, only, limit), "files")
    if headers is None:
        headers = materialize(read_headers(spark, files, header_method), "headers")
    layout = merge_layout(headers)
    last_path = files.agg(F.max("path")).first()[0] if limit is not None else None
    lines = scan_lines(spark, paths, suffixes, only, last_path, without, files, gz_spread_bytes,
                       range_bytes, direct=False if header_method == "scan" else None)
    return lines, per_file(headers), layout


def describe(lines: DataFrame, files: DataFrame, layout: Layout, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """Lines with what the header of their file says: columns, sections, sample names, consequence format.

    Files share sample lists, so the names are a dictionary of distinct lists. What is known by file and the
    dictionary are each broadcast while they are below ``broadcast_bytes``, and joined by a shuffle beyond it.
    """
    sample_list = F.sha2(F.array_join("samples", "\t"), 256)
    by_file = files.withColumn("sample_list", sample_list).drop("samples")
    lists = files.select(sample_list.alias("sample_list"), "samples").dropDuplicates(["sample_list"])

    def bounded(table: DataFrame, size: int) -> DataFrame:
        return F.broadcast(table) if size <= broadcast_bytes else table

    return lines.join(bounded(by_file, layout.file_bytes), "source_file", "left").join(
        bounded(lists, layout.sample_bytes), "sample_list", "left").drop("sample_list")


def parse_by_file(lines: DataFrame, files: DataFrame, layout: Layout, mode: str = "fail",
                  broadcast_bytes: int = 64 << 20, samples_at_once: int | None = None) -> DataFrame:
    """Data lines (source_file, line) to records; ``files`` is the per-file header table."""
    return parse_records(describe(lines, files, layout, broadcast_bytes), layout, mode, samples_at_once)
