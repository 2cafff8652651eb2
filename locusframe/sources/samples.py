"""Sample cells of data lines to genotype structs, a batch of lines at a time.

Only what has one meaning is read here: whole numbers of up to nine digits, plain decimals, missing-value marks,
genotypes of digits and ``.``. A line with anything else gives NULL, and :mod:`.vcf` reads it with its own
expressions, which also say what is wrong with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T

# Patterns of the values read here, by header type; text is taken as it is.
PATTERNS = {"Integer": "-?[0-9]{1,9}", "Float": r"-?[0-9]{1,15}([.][0-9]{1,15})?([eE][-+]?[0-9]{1,2})?", "Character": "", "String": ""}
GENOTYPE_PATTERN = r"^([0-9]{1,9}|[.])([/|]([0-9]{1,9}|[.]))*$"


def read_samples(struct: T.StructType, fields: Sequence[tuple[str, str, bool]], formats: Column, cells: Column, names: Column) -> Column | None:
    """The structs of all samples of a line, NULL where its cells are not plain; None if no line can be read so.

    ``struct`` has sampleId, calls, phased and then one field for each of ``fields``: FORMAT key, header type, whether
    it is a scalar.
    """
    columns = [f.name.lower() for f in struct.fields]
    if len(set(columns)) < len(columns) or not all(kind in PATTERNS for _, kind, _ in fields):
        return None
    parse = F.arrow_udf(_reader(struct.fieldNames(), list(fields), PATTERNS, GENOTYPE_PATTERN), T.ArrayType(struct))
    return parse(formats, cells, names)


def _reader(columns: list[str], fields: list[tuple[str, str, bool]], patterns: dict[str, str], genotype_pattern: str):
    """The function that reads a batch of lines; nested, so that it travels to the workers with its body."""
    def read(formats, cells, names):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        types = {"Integer": pa.int32(), "Float": pa.float64(), "Character": pa.string(), "String": pa.string()}
        element = pa.struct([(columns[0], pa.string()), (columns[1], pa.list_(pa.int32())), (columns[2], pa.bool_()), *(
            (name, types[kind] if scalar else pa.list_(types[kind])) for name, (_, kind, scalar) in zip(columns[3:], fields))])

        def matches(values, pattern):
            return pc.match_substring_regex(values, pattern)

        def absent(values):
            return pc.or_(pc.equal(values, "."), pc.equal(values, ""))

        def typed(values, kind):
            """Values, NULL where one is missing."""
            return pc.if_else(absent(values), pa.scalar(None, pa.string()), values).cast(types[kind])

        def several(lists, values, empty=None):
            return pa.ListArray.from_arrays(lists.offsets, values, mask=empty)

        def field(values, kind, scalar):
            """The values of a field and which of them are not plain."""
            one = patterns[kind]
            wrong = pa.array(np.zeros(len(values), bool))
            if one:
                plain = f"^(({one})|[.])?$" if scalar else f"^(({one})|[.])?(,(({one})|[.])?)*$"
                wrong = pc.invert(matches(values, plain))
                values = pc.if_else(wrong, ".", values)
            if scalar:
                return typed(values, kind), wrong
            lists = pc.split_pattern(values, ",")
            return several(lists, typed(lists.flatten(), kind), absent(values)), wrong

        def genotypes(values):
            wrong = pc.invert(matches(values, genotype_pattern))
            values = pc.if_else(wrong, ".", values)
            lists = pc.split_pattern(pc.replace_substring(values, "|", "/"), "/")
            alleles = lists.flatten()
            alleles = pc.if_else(pc.equal(alleles, "."), "-1", alleles).cast(pa.int32())
            phased = pc.and_(pc.match_substring(values, "|"), pc.invert(pc.match_substring(values, "/")))
            return several(lists, alleles), phased, wrong

        def lines(keys, cells, names):
            """The structs of lines that share their FORMAT, NULL for a line that is not plain."""
            flat, sizes, k = cells.flatten(), pc.list_value_length(cells).to_numpy(zero_copy_only=False), len(keys)
            colons = pc.count_substring(flat, ":").to_numpy(zero_copy_only=False)
            wrong = colons >= k
            # a cell may leave out its last values; with the marks added every cell has one value for each key
            missing = pa.array(np.where(wrong, 0, k - 1 - colons))
            flat = pc.if_else(pa.array(wrong), ":" * (k - 1), flat)
            flat = pc.binary_join_element_wise(flat, pa.array([":" * i for i in range(k)]).take(missing), "")
            values, first = pc.split_pattern(flat, ":").flatten(), np.arange(len(flat), dtype=np.int64) * k

            def of(key):
                return values.take(pa.array(first + keys.index(key)))

            parts = [names.flatten()]
            if "GT" in keys:
                calls, phased, bad = genotypes(of("GT"))
                parts += [calls, phased]
                wrong |= bad.to_numpy(zero_copy_only=False)
            else:
                parts += [pa.nulls(len(flat), element[1].type), pa.nulls(len(flat), pa.bool_())]
            for j, (key, kind, scalar) in enumerate(fields, 3):
                if key in keys:
                    part, bad = field(of(key), kind, scalar)
                    wrong |= bad.to_numpy(zero_copy_only=False)
                else:
                    part = pa.nulls(len(flat), element[j].type)
                parts.append(part)
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            lost = np.concatenate([[0], np.cumsum(wrong)])
            lost = lost[offsets[1:]] > lost[offsets[:-1]]
            structs = pa.StructArray.from_arrays(parts, fields=list(element))
            return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs, mask=pa.array(lost))

        width = pc.fill_null(pc.list_value_length(cells), -1)
        good = pc.and_(formats.is_valid(), pc.equal(width, pc.fill_null(pc.list_value_length(names), -2))).to_numpy(zero_copy_only=False)
        found, place, order = [], 0, np.full(len(formats), -1, dtype=np.int64)
        for text in pc.unique(formats).to_pylist():
            chosen = np.flatnonzero(good & pc.fill_null(pc.equal(formats, text), False).to_numpy(zero_copy_only=False)) if text is not None else ()
            if len(chosen):
                at = pa.array(chosen)
                found.append(lines(text.split(":"), cells.take(at), names.take(at)))
                order[chosen] = np.arange(place, place + len(chosen))
                place += len(chosen)
        if not found:
            return pa.nulls(len(formats), pa.list_(element))
        return pa.concat_arrays(found).take(pa.array(order, mask=order < 0))

    return read
