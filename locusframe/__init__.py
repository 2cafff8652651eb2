"""Variant-call files to analytics tables on Spark."""

from .operators.checks import (
    capture_row_counts, filter_run, presence_flags, preview, quarantine, quarantine_count, recent_log, rows_per_file,
    table_counts,
)
from .operators.consequences import consequences_flat, explode_consequences
from .operators.genotypes import explode_genotypes, variant_calls
from .operators.normalize import normalize_variants
from .operators.pipe import pipe_partitions
from .operators.split import split_multiallelics
from .operators.variants import explode_alleles, flatten_info, variants_flat
from .plans.flatten import flatten_records, flatten_single
from .plans.ingest import IngestConfig, ingest
from .sources.fasta import fasta_contig_index, reference_chunks
from .sources.files import discover_files
from .sources.tables import append_table, ensure_table, load_table, replace_files, reset_outputs, write_table
from .sources.vcf import promote_undeclared, read_call_slices, read_vcf
from .sources.vcf_text import infer_header, to_vcf_lines

__all__ = [
    "IngestConfig", "append_table", "capture_row_counts", "consequences_flat", "discover_files", "ensure_table",
    "explode_alleles", "explode_consequences", "explode_genotypes", "fasta_contig_index", "filter_run",
    "flatten_info", "flatten_records", "flatten_single", "infer_header", "ingest", "load_table",
    "normalize_variants", "pipe_partitions", "presence_flags", "preview", "promote_undeclared", "quarantine", "quarantine_count",
    "read_call_slices", "read_vcf", "recent_log", "reference_chunks", "replace_files", "reset_outputs", "rows_per_file",
    "split_multiallelics", "table_counts", "to_vcf_lines", "variant_calls", "variants_flat", "write_table",
]
