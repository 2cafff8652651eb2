from .columns import (
    basename, field_type, first_field, flatten_struct, has_field, leaf_value, one_based_pos, provenance, rendered,
    resolve_core_columns, struct_leaves, typed_columns, variant_id, variant_key,
)
from .genotype import genotype_string
from .text import common_prefix_length, common_suffix_length, let, once

__all__ = [
    "basename", "common_prefix_length", "common_suffix_length", "field_type", "first_field", "flatten_struct",
    "genotype_string", "has_field", "leaf_value", "let", "once",
    "one_based_pos", "provenance", "rendered",
    "resolve_core_columns", "struct_leaves", "typed_columns", "variant_id", "variant_key",
]
