"""SQL that gives the result of each registered query in another engine."""

from __future__ import annotations

V = """o AS (SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE (1 + o_orderkey % 3)::int END AS n FROM orders),
v AS (SELECT
  o_orderkey AS rec,
  'chr' || (1 + o_custkey % 22) AS contigName,
  o_orderkey * 50 AS start,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE ['rs' || o_orderkey] END AS names,
  substr('ACGT', (1 + o_orderkey % 4)::int, 1) AS referenceAllele,
  list_transform(range(1, n + 1), lambda i: substr('ACGT', (1 + (o_orderkey + i) % 4)::int, 1)) AS alternateAlleles,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS qual,
  [CASE o_orderstatus WHEN 'F' THEN 'PASS' ELSE 'LowQual' END] AS filters,
  (o_custkey % 100)::int AS INFO_DP,
  o_orderkey % 2 = 0 AS INFO_DB,
  list_transform(range(1, n + 1), lambda i: ((o_custkey + i) % 9)::int) AS INFO_AC,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE
    list_transform(range(1, CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 2 + o_orderkey % 2 END), lambda i: {
      'Allele': substr('ACGT', (1 + (o_orderkey + i) % 4)::int, 1),
      'Consequence': CASE WHEN i = 1 THEN 'missense_variant' ELSE 'intron_variant' END,
      'Extra': {'IMPACT': o_orderpriority, 'Flags': [o_orderstatus, i::varchar]}}) END AS INFO_CSQ,
  list_transform(range(0, 4), lambda k: {
    'sampleId': 'S' || k,
    'calls': CASE WHEN (o_orderkey + k) % 17 = 0 THEN NULL ELSE
      [((o_orderkey + k) % (n + 2) - 1)::int, ((o_orderkey + k * 3) % (n + 1))::int] END,
    'phased': CASE WHEN (o_orderkey + k) % 9 = 0 THEN NULL ELSE (o_orderkey + k) % 2 = 0 END,
    'depth': (10 + k)::int,
    'conditionalQuality': (o_custkey % 90)::int,
    'alleleDepths': list_transform(range(0, n + 1), lambda j: ((o_orderkey + k + j) % 40)::int),
    'phredLikelihoods': list_transform(range(0, (n + 1) * (n + 2) // 2), lambda j: ((o_orderkey + k + j) % 60)::int)
    }) AS genotypes,
  n
FROM o)"""

A = V + """,
a AS (SELECT v.*, start + 1 AS pos, x.alt,
  concat_ws(':', contigName, (start + 1)::varchar, referenceAllele, x.alt) AS variant_key
  FROM v LEFT JOIN LATERAL (SELECT unnest(v.alternateAlleles) AS alt) x ON true)"""

C = A + """,
c AS (SELECT a.*, u.csq, u.csq_index::int AS csq_index FROM a
  LEFT JOIN LATERAL (SELECT unnest(a.INFO_CSQ) AS csq, generate_subscripts(a.INFO_CSQ, 1) - 1 AS csq_index) u ON true)"""

G = A + ",\ng AS (SELECT a.*, u.g FROM a LEFT JOIN LATERAL (SELECT unnest(a.genotypes) AS g) u ON true)"

# one row per ALT of the split records
S = V + """,
s0 AS (SELECT v.*, u.alt, u.i FROM v LEFT JOIN LATERAL (
  SELECT unnest(v.alternateAlleles) AS alt, generate_subscripts(v.alternateAlleles, 1)::int AS i) u ON true),
s AS (SELECT * REPLACE (
    CASE WHEN n > 1 THEN [alt] ELSE alternateAlleles END AS alternateAlleles,
    CASE WHEN n > 1 THEN [INFO_AC[i]] ELSE INFO_AC END AS INFO_AC,
    CASE WHEN n > 1 THEN list_transform(genotypes, lambda g: {
      'sampleId': g.sampleId,
      'calls': list_transform(g.calls, lambda c: CASE WHEN c = 0 THEN 0 WHEN c = i THEN 1 ELSE -1 END),
      'phased': g.phased, 'depth': g.depth, 'conditionalQuality': g.conditionalQuality,
      'alleleDepths': [g.alleleDepths[1], g.alleleDepths[i + 1]],
      'phredLikelihoods': [g.phredLikelihoods[1], g.phredLikelihoods[i * (i + 1) // 2 + 1],
        g.phredLikelihoods[i * (i + 1) // 2 + i + 1]]}) ELSE genotypes END AS genotypes),
  n > 1 AS splitFromMultiAllelic,
  concat_ws(':', contigName, (start + 1)::varchar, referenceAllele, alt) AS variant_key
  FROM s0)"""


def gt(calls: str = "g.calls", phased: str = "g.phased") -> str:
    text = f"list_transform({calls}, lambda x: CASE WHEN x < 0 THEN '.' ELSE x::varchar END)"
    return f"""CASE WHEN {calls} IS NULL THEN NULL WHEN {phased} THEN array_to_string({text}, '|')
  ELSE array_to_string({text}, '/') END"""


def js(value: str) -> str:
    return f"to_json({value})::varchar"


SITE = "contigName AS chrom, pos, referenceAllele AS ref, alt, variant_key"
FLAT = f"""{SITE}, {js('names')} AS names, qual, {js('filters')} AS filters, NULL::boolean AS splitFromMultiAllelic,
  {js('INFO_AC')} AS INFO_AC, INFO_DB, INFO_DP"""
CSQ = f"""csq.Allele AS CSQ_Allele, csq.Consequence AS CSQ_Consequence, csq.Extra.IMPACT AS CSQ_Extra_IMPACT,
  {js('csq.Extra.Flags')} AS CSQ_Extra_Flags"""
CALL = f"""g.sampleId AS sample_id, {gt()} AS GT, g.depth AS DP, g.conditionalQuality AS GQ,
  {js('g.alleleDepths')} AS AD, {js('g.phredLikelihoods')} AS PL, g.phased AS phased"""
NO_AC = "CASE WHEN len(INFO_AC) > 0 THEN to_json(INFO_AC)::varchar END"
TEXT_CALLS = "coalesce(g.calls, [-1])"
TEXT_PHASED = "g.calls IS NOT NULL AND coalesce(g.phased, false)"
TEXT_ROWS = f"""WITH {G} SELECT variant_key, {js('names')} AS names, qual, {js('filters')} AS filters,
  {NO_AC} AS INFO_AC, INFO_DB, INFO_DP, g.sampleId AS sample_id, {js(TEXT_CALLS)} AS calls, {TEXT_PHASED} AS phased,
  g.depth AS DP, g.conditionalQuality AS GQ, {js('g.alleleDepths')} AS AD, {js('g.phredLikelihoods')} AS PL FROM g"""

BLOCKS = """b AS (SELECT o_orderkey AS k, 'ref' || (o_orderkey // 6400) AS contigName, (o_orderkey % 6400) // 64 AS chunk,
  translate(md5(o_orderkey::varchar), '0123456789abcdef',
    CASE WHEN (o_orderkey // 64) % 2 = 1 THEN 'AAACCCAAACCCACAC' ELSE 'ACGTACGTACGTACGT' END) AS bases FROM orders),
ct AS (SELECT contigName, chunk, string_agg(bases, '' ORDER BY k) AS seq FROM b GROUP BY ALL)"""

# both alleles are put behind 512 bases of the reference; then the shared end is cut, then the shared begin
NORMAL = f"""{BLOCKS},
r AS (SELECT k AS rec, contigName, chunk, (k % 6400) * 32 + k % 20 AS start, bases, (k % 20)::int AS q, (1 + k % 3)::int AS n FROM b),
r2 AS (SELECT *,
  CASE rec % 4 WHEN 2 THEN substr(bases, q + 1, 1) WHEN 3 THEN substr(bases, q + 1, n + 2) ELSE substr(bases, q + 1, n + 1) END AS ref,
  CASE rec % 4 WHEN 0 THEN substr(bases, q + 1, 1) WHEN 1 THEN substr(bases, q + 1 + n, 1)
    WHEN 2 THEN substr(bases, q + 1, n) || substr(bases, q + 1, 1)
    ELSE substr(bases, q + 1, 1) || translate(substr(bases, q + 2, 1), 'ACGT', 'CGTA') || substr(bases, q + 3, n) END AS alt
  FROM r),
r3 AS (SELECT r2.*, right(coalesce(p.seq, '') || substr(c.seq, 1, (start % 2048)::int), 512) AS u
  FROM r2 JOIN ct c ON c.contigName = r2.contigName AND c.chunk = r2.chunk
  LEFT JOIN ct p ON p.contigName = r2.contigName AND p.chunk = r2.chunk - 1),
r4 AS (SELECT *, u || ref AS x, u || alt AS y, least(length(u || ref), length(u || alt)) AS m FROM r3),
r5 AS (SELECT *, least(m - 1, coalesce(nullif(list_position(list_transform(range(0, m),
  lambda i: substr(x, length(x) - i, 1) = substr(y, length(y) - i, 1)), false), 0) - 1, m)) AS t FROM r4),
r6 AS (SELECT *, left(x, (length(x) - t)::int) AS x2, left(y, (length(y) - t)::int) AS y2, m - t - 1 AS top FROM r5),
r7 AS (SELECT *, coalesce(nullif(list_position(list_transform(range(0, top),
  lambda i: substr(x2, i + 1, 1) = substr(y2, i + 1, 1)), false), 0) - 1, top) AS p FROM r6),
nv AS (SELECT rec, contigName, start - length(u) + p AS new_start, substr(x2, (p + 1)::int) AS new_ref,
  substr(y2, (p + 1)::int) AS new_alt, start, ref, alt FROM r7)"""

NORMALIZED = f"""WITH {NORMAL} SELECT rec, contigName, new_start AS start, new_start + length(new_ref) AS "end",
  new_ref AS referenceAllele, new_alt AS alternateAllele,
  new_start <> start OR new_ref <> ref OR new_alt <> alt AS changed, NULL::varchar AS error FROM nv"""

LOG = """l AS (SELECT 'run' || (o_custkey % 5) AS run_id, o_orderdate::timestamp AS run_ts, o_orderkey || '.vcf' AS filename,
  CASE o_orderstatus WHEN 'F' THEN 'processed' ELSE 'skipped' END AS status,
  CASE o_orderstatus WHEN 'F' THEN 'write' ELSE 'read' END AS stage,
  o_orderkey % 2 = 0 AS pipe_enabled, 'cat' AS pipe_cmd, 'infer' AS pipe_header_mode, o_orderkey % 3 = 0 AS has_csq,
  o_orderkey % 4 <> 0 AS has_genotypes, o_orderkey AS variants_rows, o_orderkey * 4 AS calls_rows, o_orderkey * 2 AS csq_rows,
  CASE o_orderstatus WHEN 'F' THEN NULL ELSE 'bad file of ' || o_custkey END AS error FROM orders)"""

SUMS = V + """,
t AS (SELECT sum(greatest(n, 1))::bigint AS variants_rows, sum(greatest(n, 1) * 4)::bigint AS calls_rows,
  sum(greatest(n, 1) * greatest(coalesce(len(INFO_CSQ), 0), 1))::bigint AS csq_rows, count(*) AS records FROM v)"""


def entry_text(*columns: str) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(({c})::varchar, '')" for c in columns) + ") AS entry"


def three_tables(ctes: str, rows: str) -> str:
    """variants, consequences and calls of ``rows`` as text entries."""
    variants = entry_text("variant_key", js("names"), js("filters"), "INFO_DP", NO_AC)
    csq = entry_text("variant_key", "u.i", "u.csq.Allele", "u.csq.Consequence", "u.csq.Extra.IMPACT")
    calls = entry_text("variant_key", "u.g.sampleId", gt("coalesce(u.g.calls, [-1])", "u.g.calls IS NOT NULL AND u.g.phased"),
                       "u.g.depth", "u.g.conditionalQuality", js("u.g.alleleDepths"), js("u.g.phredLikelihoods"))
    return f"""WITH {ctes}
SELECT 'variants_flat' AS table_name, {variants} FROM {rows} z
UNION ALL SELECT 'variant_consequences_flat', {csq} FROM {rows} z LEFT JOIN LATERAL (
  SELECT unnest(z.INFO_CSQ) AS csq, generate_subscripts(z.INFO_CSQ, 1) - 1 AS i) u ON true
UNION ALL SELECT 'variant_calls', {calls} FROM {rows} z LEFT JOIN LATERAL (SELECT unnest(z.genotypes) AS g) u ON true"""


SOURCES = "'/cohort/set' || (rec % 7) || '/batch' || (rec % 7) || '.vcf'"

SQL: dict[str, str] = {
    "explode_alleles": f"WITH {A} SELECT rec, {SITE} FROM a",
    "variant_key": f"WITH {A} SELECT variant_key, contigName AS chrom FROM a",
    "variant_id": f"WITH {A} SELECT contigName AS chrom, count(DISTINCT variant_key) AS ids, count(*) AS n FROM a GROUP BY 1",
    "pos_from_start": f"WITH {A} SELECT start, pos FROM a",
    "core_columns_alt_names": f"WITH {A} SELECT rec, variant_key, pos, 'pos' AS pos_column FROM a",
    "safe_missing_column": f"WITH {V} SELECT rec, qual, NULL::int AS absent FROM v",
    "provenance_filename": f"""WITH {V} SELECT {SOURCES} AS source_file, 'batch' || (rec % 7) || '.vcf' AS filename,
  count(*) AS n, 1::bigint AS stamps FROM v GROUP BY 1, 2""",
    "info_flatten": f"WITH {V} SELECT rec, {js('INFO_AC')} AS INFO_AC, INFO_DB, INFO_DP FROM v",
    "variants_flat": f"WITH {A} SELECT {FLAT} FROM a",
    "presence_flags": """SELECT true AS has_csq, true AS has_genotypes, count(*) AS records, 'all' AS "case" FROM orders
UNION ALL SELECT false, false, count(*), 'none' FROM orders""",
    "csq_explode": f"WITH {C} SELECT variant_key, csq_index, csq.Allele AS allele FROM c",
    "csq_struct_flatten": f"WITH {C} SELECT {CSQ} FROM c",
    "consequences_flat": f"WITH {C} SELECT {SITE}, csq_index, {CSQ} FROM c",
    "consequences_match_allele": f"WITH {C} SELECT {SITE}, csq_index, {CSQ} FROM c WHERE csq.Allele = alt",
    "consequences_raw": f"""WITH {C} SELECT {SITE}, csq_index,
  CASE WHEN csq IS NOT NULL THEN csq.Allele || '|' || csq.Consequence END AS CSQ_raw FROM c""",
    "calls_explode": f"WITH {G} SELECT variant_key, g.sampleId AS sample_id, g.depth AS depth FROM g",
    "gt_string": f"WITH {G} SELECT variant_key, g.sampleId AS sample_id, {gt()} AS GT, g.phased AS phased FROM g",
    "call_dp_gq": f"WITH {G} SELECT variant_key, g.sampleId AS sample_id, g.depth AS DP, g.conditionalQuality AS GQ FROM g",
    "call_ad_pl": f"""WITH {G} SELECT variant_key, g.sampleId AS sample_id, {js('g.alleleDepths')} AS AD,
  {js('g.phredLikelihoods')} AS PL FROM g""",
    "variant_calls": f"WITH {G} SELECT variant_key, {CALL} FROM g",
    "calls_short_names": f"""WITH {G} SELECT variant_key, g.sampleId AS sample_id, NULL::varchar AS GT, g.depth AS DP,
  g.conditionalQuality AS GQ, {js('g.alleleDepths')} AS AD, {js('g.phredLikelihoods')} AS PL, NULL::boolean AS phased FROM g""",
    "calls_raw_fallback": f"""WITH {G} SELECT NULL::varchar AS sample_id, g.sampleId AS GT, NULL::int AS DP, NULL::int AS GQ,
  NULL::varchar AS AD, NULL::varchar AS PL, NULL::boolean AS phased, 'keep' AS raw FROM g""",
    "call_extra_fields": f"""WITH {G} SELECT variant_key, g.sampleId AS sample_id, NULL::varchar AS AF, {js('g.phredLikelihoods')} AS SB,
  {js('g.alleleDepths')} AS F1R2, NULL::varchar AS F2R1, g.sampleId || '_p' AS PID, NULL::varchar AS PGT, g.depth AS PS FROM g""",
    "split_multiallelics": f"""WITH {S} SELECT rec, {js('alternateAlleles')} AS alternateAlleles, {js('INFO_AC')} AS INFO_AC,
  splitFromMultiAllelic, u.g.sampleId AS sample_id, {js('u.g.calls')} AS calls, {js('u.g.alleleDepths')} AS alleleDepths,
  {js('u.g.phredLikelihoods')} AS phredLikelihoods FROM s LEFT JOIN LATERAL (SELECT unnest(s.genotypes) AS g) u ON true""",
    "normalize_left_align": NORMALIZED,
    "normalize_shuffled": NORMALIZED,
    "vcf_roundtrip": TEXT_ROWS,
    "pipe_identity": TEXT_ROWS,
    "vcf_roundtrip_consequences": f"""WITH {C} SELECT {SITE}, csq_index, csq.Allele AS CSQ_Allele,
  csq.Consequence AS CSQ_Consequence, csq.Extra.IMPACT AS CSQ_Extra_IMPACT,
  csq.Extra.Flags[1] || '&' || csq.Extra.Flags[2] AS CSQ_Extra_Flags FROM c""",
    "to_vcf_lines": f"""WITH {V} SELECT concat_ws(chr(9), contigName, (start + 1)::varchar,
  coalesce(array_to_string(names, ';'), '.'), referenceAllele,
  CASE WHEN n = 0 THEN '.' ELSE array_to_string(alternateAlleles, ',') END, coalesce(qual::varchar, '.'),
  array_to_string(filters, ';'),
  concat_ws(';', 'DP=' || INFO_DP, CASE WHEN INFO_DB THEN 'DB' END,
    CASE WHEN n > 0 THEN 'AC=' || array_to_string(INFO_AC, ',') END,
    CASE WHEN len(INFO_CSQ) > 0 THEN 'CSQ=' || array_to_string(list_transform(INFO_CSQ, lambda c:
      c.Allele || '|' || c.Consequence || '|' || c.Extra.IMPACT || '|' || array_to_string(c.Extra.Flags, '&')), ',') END),
  'GT:DP:GQ:AD:PL', array_to_string(list_transform(genotypes, lambda g: concat_ws(':', coalesce({gt()}, '.'), g.depth::varchar,
    g.conditionalQuality::varchar, array_to_string(g.alleleDepths, ','), array_to_string(g.phredLikelihoods, ','))), chr(9))
  ) AS line FROM v""",
    "pipe_failure": """SELECT 'command ended with status 1: ' AS reason, count(*) AS n, count(*) AS lines FROM orders""",
    "quarantine_split": """SELECT CASE o_orderkey % 10 WHEN 3 THEN 'position is no number' WHEN 7 THEN 'wrong number of columns'
  ELSE 'good' END AS reason, count(*) AS n FROM orders GROUP BY 1""",
    "quarantine_count": "SELECT count(*) AS quarantined_rows FROM orders WHERE o_orderkey % 10 IN (3, 7)",
    "fasta_contig_index": """SELECT 'ref' || (o_orderkey // 6400) AS name, count(*) * 32 AS length, 32 AS line_bases,
  33::bigint AS line_width FROM orders GROUP BY 1""",
    "ref_chunk_bases": f"""WITH {BLOCKS} SELECT contigName, chunk, chunk * 2048 AS start, md5(seq) AS bases_md5,
  length(seq)::int AS n FROM ct""",
    "write_read_back": f"WITH {A} SELECT {FLAT} FROM a",
    "schema_merge_append": f"""WITH {A} SELECT variant_key, NULL::varchar AS INFO_AC, INFO_DB, INFO_DP FROM a
UNION ALL SELECT variant_key, {js('INFO_AC')}, NULL, NULL FROM a""",
    "schema_widen_append": """SELECT 0 AS run, o_orderkey AS rec, (o_orderkey % 7)::double::varchar AS x,
  '[' || (o_orderkey % 7) || ']' AS y FROM orders
UNION ALL SELECT 1, o_orderkey, (o_orderkey / 4)::double::varchar, '[' || (o_orderkey % 7) || ']' FROM orders
UNION ALL SELECT 2, o_orderkey, 'r' || o_orderkey, '[' || (o_orderkey % 5) || ']' FROM orders""",
    "replace_source_files": f"""WITH {A} SELECT 'batch' || (rec % 7) || '.vcf' AS filename, count(*) AS n,
  CASE WHEN rec % 7 = 3 THEN 0 ELSE count(*) END AS with_dp FROM a GROUP BY 1, rec % 7""",
    "placeholder_tables": f"""WITH {SUMS} SELECT 'variants_flat' AS table_name, variants_rows AS n FROM t
UNION ALL SELECT 'variant_consequences_flat', 0 UNION ALL SELECT 'variant_calls', 0""",
    "reset_outputs": f"""WITH {SUMS} SELECT 'after' AS table_name, 0::bigint AS n, variants_rows::int AS before, 1 AS dropped FROM t""",
    "table_counts": f"""WITH {SUMS} SELECT 'variants_flat' AS table_name, variants_rows AS n FROM t
UNION ALL SELECT 'variant_consequences_flat', csq_rows FROM t UNION ALL SELECT 'variant_calls', calls_rows FROM t""",
    "variants_per_file": f"WITH {A} SELECT 'batch' || (rec % 7) || '.vcf' AS filename, count(*) AS n FROM a GROUP BY 1",
    "calls_per_file": f"WITH {G} SELECT 'batch' || (rec % 7) || '.vcf' AS filename, count(*) AS n FROM g GROUP BY 1",
    "recent_log_topk": f"""WITH {LOG} SELECT run_id, filename, status, variants_rows FROM l
ORDER BY run_ts DESC, filename LIMIT 50""",
    "file_log_run": f"WITH {LOG} SELECT * EXCLUDE (run_id, run_ts) FROM l WHERE run_id = 'run3'",
    "preview_rows": f"""WITH {A} SELECT variant_key, {js('names')} AS names, qual, {js('INFO_AC')} AS INFO_AC FROM a
ORDER BY contigName, pos, alt LIMIT 20""",
    "discover_files": "SELECT count(*) AS lines, count(*) AS distinct_lines FROM orders",
    "discover_mixed_folder": """SELECT name AS filename, count(o_orderkey) AS lines, count(o_orderkey) > 0 AS has_bytes
FROM (VALUES (0, 'a.txt'), (1, '_b.txt'), (2, '.c.txt'), (4, 'it''s 100% [e].TXT'), (9, 'empty.txt')) f(piece, name)
LEFT JOIN orders ON o_orderkey % 5 = piece GROUP BY name""",
    "read_blocked_gzip": TEXT_ROWS,
    "call_slices": f"""WITH {G} SELECT variant_key, g.sampleId AS sample_id, {js(TEXT_CALLS)} AS calls, g.depth AS DP,
  {js('g.alleleDepths')} AS AD, {js('g.phredLikelihoods')} AS PL FROM g""",
    "damaged_values": f"""WITH {V} SELECT rec,
  CASE WHEN rec % 10 IN (1, 4, 5, 6) THEN NULL ELSE INFO_DP END AS declared_dp,
  CASE rec % 10 WHEN 2 THEN 'low' END AS small_dp, CASE rec % 10 WHEN 3 THEN '7' END AS repeated_dp,
  CASE rec % 10 WHEN 2 THEN 'n' || rec WHEN 3 THEN 'a,b' END AS INFO_NEW, CASE rec % 10 WHEN 2 THEN 'true' END AS INFO_MARK,
  CASE rec % 10 WHEN 1 THEN 'INFO DP is no Integer' WHEN 4 THEN 'FORMAT key that no header declares'
    WHEN 5 THEN 'sample value that does not fit its FORMAT' WHEN 6 THEN 'sample value that does not fit its FORMAT' END AS reason,
  CASE rec % 10 WHEN 1 THEN 'DP=x' || rec WHEN 4 THEN 'GT:XY' WHEN 5 THEN '3' WHEN 6 THEN {{last}} END AS value FROM v""".replace(
        "{last}", "concat_ws(',', nullif(array_to_string(genotypes[4].phredLikelihoods[1:(n + 1) * (n + 2) // 2 - 1], ','), ''), '1.5')"),
    "pipe_order_after_gzip": "SELECT count(*) AS records, 0::bigint AS out_of_order, true AS starts_bounded FROM orders",
    "pipe_order_after_shuffle": "SELECT count(*) AS records, 0::bigint AS out_of_order, true AS starts_bounded FROM orders",
    "replace_widened_files": """SELECT 'batch' || (o_orderkey % 7) || '.vcf' AS filename, run, count(*) AS n, sum(o_orderkey % 1000)::bigint AS x,
  max(length(CASE run WHEN 3 THEN (o_orderkey % 1000)::varchar ELSE (o_orderkey % 1000)::double::varchar END))::int AS longest
FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 < 2 THEN 3 WHEN o_orderkey % 7 < 5 THEN 2 ELSE 0 END AS run FROM orders)
GROUP BY o_orderkey % 7, run""",
    "flatten_single": three_tables(A, "a"),
    "ingest_end_to_end": three_tables(S, "s"),
    "ingest_normalized": f"""WITH {NORMAL} SELECT concat_ws(':', contigName, (new_start + 1)::varchar, new_ref, new_alt) AS variant_key,
  contigName AS chrom, new_start + 1 AS pos, new_ref AS ref, new_alt AS alt FROM nv""",
    "file_log": f"""WITH {SUMS} SELECT 'processed' AS status, 'write' AS stage, false AS pipe_enabled, true AS has_csq,
  true AS has_genotypes, NULL::varchar AS error, variants_rows, calls_rows, csq_rows FROM t""",
    "failed_stages": """SELECT 'processed' AS status, 'write' AS stage, NULL::varchar AS reason,
  count(*) AS variants_rows, NULL::bigint AS quarantined FROM orders WHERE o_orderkey % 3 = 0 HAVING count(*) > 0
UNION ALL SELECT 'skipped', 'normalize', 'REF differs from the reference', NULL, count(*) FROM orders WHERE o_orderkey % 3 = 1
  HAVING count(*) > 0
UNION ALL SELECT 'skipped', 'split', 'AC has 3 values for 2 ALT', NULL, 2 * count(*) FROM orders WHERE o_orderkey % 3 = 2
  HAVING count(*) > 0""",
    "bad_file_skipped": f"""WITH {SUMS} SELECT 'processed' AS status, 'write' AS stage, NULL::varchar AS error,
  variants_rows, calls_rows, csq_rows, NULL::bigint AS quarantined FROM t
UNION ALL SELECT 'skipped', 'read', 'file has no header', NULL, NULL, NULL, records FROM t""",
}
SQL["row_count_metrics"] = SQL["table_counts"]
