"""The proxy views as SQL text for the DuckDB oracle (same expressions as
``plans/proxy.py``; ``FIXTURES.md`` section 3).  ``with_views`` prepends the
CTEs an oracle query needs, in dependency order."""

from __future__ import annotations

VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {}


def _view(name: str, sql: str, *deps: str) -> None:
    VIEWS[name] = (sql.strip(), deps)


_view("px_calls", """
SELECT pk, ln, ck,
  CASE WHEN q >= 50 THEN -1 WHEN rf = 'R' THEN 1 ELSE 0 END AS a1,
  CASE WHEN q >= 50 THEN -1 WHEN rf = 'R' AND ls = 'F' AND pk % 7 = 0 THEN 2 WHEN rf IN ('A','R') THEN 1 ELSE 0 END AS a2,
  CASE WHEN ls = 'F' THEN '*' END AS phaseset,
  CAST(q AS BIGINT) AS genotype_quality
FROM (SELECT l_partkey AS pk, l_linenumber AS ln, o_custkey AS ck, max(l_returnflag) AS rf,
             max(l_linestatus) AS ls, max(l_quantity) AS q
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      GROUP BY l_partkey, l_linenumber, o_custkey) t""")

_view("px_sites", """
SELECT pk, ln,
  CASE WHEN pk % 24 = 22 THEN 'X' WHEN pk % 24 = 23 THEN 'Y' ELSE CAST(pk % 24 + 1 AS VARCHAR) END AS chromosome,
  pk * 100 + ln AS position,
  substr('ACGT', CAST(pk % 4 + 1 AS INT), 1) || CASE WHEN pk % 10 = 1 THEN 'AT' WHEN pk % 10 = 2 THEN 'G' ELSE '' END AS ref,
  substr('ACGT', CAST((pk + ln % 3 + 1) % 4 + 1 AS INT), 1) || CASE WHEN pk % 10 = 0 THEN 'A' WHEN pk % 10 = 2 THEN 'C' ELSE '' END AS alt,
  CASE WHEN pk % 7 = 0 THEN substr('ACGT', CAST((pk + (ln + 1) % 3 + 1) % 4 + 1 AS INT), 1) END AS alt2,
  CASE WHEN pk % 50 = 0 THEN NULL ELSE ((pk * 7 + ln * 13) % 600) / CAST(10 AS DOUBLE) END AS quality,
  CASE WHEN (pk * 7 + ln * 13) % 600 < 50 THEN 'RefCall' ELSE 'PASS' END AS filter
FROM (SELECT DISTINCT l_partkey AS pk, l_linenumber AS ln FROM lineitem) t""")

_view("px_ann", """
SELECT p_partkey AS pk,
  CASE WHEN p_type = 'STANDARD' THEN NULL WHEN p_partkey % 25 = 0 THEN 'BRCA1' WHEN p_partkey % 25 = 1 THEN 'BRCA2'
       WHEN p_partkey % 25 = 2 THEN 'TP53' ELSE p_brand END AS gene_symbol,
  CASE p_type WHEN 'STANDARD' THEN NULL WHEN 'ECONOMY' THEN 'HIGH' WHEN 'SMALL' THEN 'MODERATE'
       WHEN 'MEDIUM' THEN 'LOW' ELSE 'MODIFIER' END AS impact,
  CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CASE p_size % 6
       WHEN 0 THEN CAST(0.00005 AS DOUBLE) WHEN 1 THEN CAST(0.0005 AS DOUBLE) WHEN 2 THEN CAST(0.005 AS DOUBLE)
       WHEN 3 THEN CAST(0.03 AS DOUBLE) WHEN 4 THEN CAST(0.05 AS DOUBLE) ELSE CAST(0.3 AS DOUBLE) END END AS gnomad_af
FROM part""")

_view("px_samples", """
SELECT c_custkey AS ck, CAST(c_custkey AS VARCHAR) AS sample_id,
  CASE WHEN c_mktsegment IN ('BUILDING','AUTOMOBILE') THEN 'case'
       WHEN c_mktsegment IN ('FURNITURE','MACHINERY') THEN 'control' ELSE 'unknown' END AS disease_status,
  n_name AS population,
  CASE r_name WHEN 'AFRICA' THEN 'AFR' WHEN 'AMERICA' THEN 'AMR' WHEN 'ASIA' THEN 'EAS'
       WHEN 'EUROPE' THEN 'EUR' ELSE 'SAS' END AS super_population
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")

_view("px_populations", """
SELECT sample_id, population, super_population FROM px_samples WHERE ck % 10 <> 0""", "px_samples")

_view("px_genes", """
SELECT gene_symbol, chromosome, min(position) AS start_position, max(position) AS end_position
FROM px_sites s JOIN px_ann a ON s.pk = a.pk WHERE gene_symbol IS NOT NULL GROUP BY gene_symbol, chromosome""",
      "px_sites", "px_ann")

_view("px_clinvar", """
SELECT chromosome, position - 1 AS start, ref AS reference, alt AS alternate,
  CASE pk % 4 WHEN 0 THEN 'Pathogenic' WHEN 1 THEN 'Likely_pathogenic' WHEN 2 THEN 'Benign'
       ELSE 'Pathogenic/Likely_pathogenic' END AS clinical_significance
FROM px_sites WHERE ln % 2 = 0""", "px_sites")

_view("px_patients", """
SELECT ck, sample_id AS patient_id,
  CASE WHEN super_population IN ('AFR','AMR') THEN 'US' WHEN super_population = 'EAS' THEN 'SG' ELSE 'EU' END AS node_id,
  25 + (ck * 37) % 56 AS age,
  CASE WHEN ck % 100 < 85 THEN 0 WHEN ck % 100 < 97 THEN 1 ELSE 2 END AS variant_brca1,
  CASE WHEN (ck * 3) % 100 < 90 THEN 0 WHEN (ck * 3) % 100 < 98 THEN 1 ELSE 2 END AS variant_tp53,
  CASE WHEN (ck * 11) % 100 < 80 THEN 0 WHEN (ck * 11) % 100 < 95 THEN 1 ELSE 2 END AS variant_apoe4,
  CAST(18.5 AS DOUBLE) + ((ck * 53) % 266) / CAST(10 AS DOUBLE) AS bmi,
  CASE WHEN (ck * 17) % 100 < 5 + (CASE WHEN ck % 100 < 85 THEN 0 WHEN ck % 100 < 97 THEN 8 ELSE 16 END)
            + ((ck * 37) % 56) / CAST(10 AS DOUBLE) THEN 1 ELSE 0 END AS diagnosis_cancer
FROM px_samples""", "px_samples")

_view("px_reads", """
SELECT event_id AS qname, CAST(user_id % 5 AS VARCHAR) AS sample_id,
  1 + (CASE WHEN event_type = 'error' THEN 4 ELSE 2 END) + (CASE WHEN event_id % 11 = 0 THEN 8 ELSE 0 END)
    + (CASE WHEN event_id % 13 = 0 THEN 256 ELSE 0 END) + (CASE WHEN event_id % 17 = 0 THEN 1024 ELSE 0 END) AS flag,
  CASE WHEN event_type = 'error' THEN '*' ELSE CAST(user_id % 22 + 1 AS VARCHAR) END AS rname,
  event_id * 10 AS pos, CAST(floor(value) AS BIGINT) % 61 AS mapq, 100 + event_id % 50 AS read_length
FROM events""")

_view("px_updates", """
SELECT event_id, event_type AS node_id, CAST(floor(event_id / CAST(8 AS DOUBLE)) AS BIGINT) AS round,
  100 + user_id AS n_samples, (event_id % 1000) / CAST(1000 AS DOUBLE) AS w0,
  (event_id % 7) / CAST(8 AS DOUBLE) AS w1, (event_id % 3) / CAST(4 AS DOUBLE) AS bias
FROM events""")

_view("px_audit", """
SELECT event_id, ts,
  CASE event_type WHEN 'purchase' THEN 'storage.objects.create' WHEN 'view' THEN 'jobservice.query' ELSE 'storage.objects.get' END AS method_name,
  CASE WHEN event_id % 50 = 0 THEN 'external-bucket' ELSE 'node-us-results' END AS bucket,
  CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS severity,
  CASE WHEN user_id % 2 = 0 THEN 'nf-' || event_type ELSE event_type END AS job_name
FROM events""")

# Flat per-site summary the reference's variant_summary view yields, on the proxy.
_view("px_cs", """
SELECT pk, ln, count(*) AS sample_count,
  count(*) FILTER (WHERE a1 = 1 OR a2 = 1) AS alt_allele_count
FROM px_calls GROUP BY pk, ln""", "px_calls")

_view("px_summary", """
SELECT s.pk, s.ln, s.chromosome AS reference_name, s.position - 1 AS start_position, s.ref AS reference_bases,
  s.alt AS alternate_base, 'rs' || CAST(s.position AS VARCHAR) AS variant_id, s.quality,
  a.gene_symbol,
  CASE a.impact WHEN 'HIGH' THEN 'stop_gained' WHEN 'MODERATE' THEN 'missense_variant'
       WHEN 'LOW' THEN 'synonymous_variant' WHEN 'MODIFIER' THEN 'intron_variant' END AS consequence,
  a.impact, a.gnomad_af,
  CAST(coalesce(c.sample_count, 0) AS BIGINT) AS sample_count,
  CAST(coalesce(c.alt_allele_count, 0) AS BIGINT) AS alt_allele_count
FROM px_sites s LEFT JOIN px_ann a ON s.pk = a.pk LEFT JOIN px_cs c ON s.pk = c.pk AND s.ln = c.ln""",
      "px_sites", "px_ann", "px_cs")

# Flat seven-column call table (ALT comma-joined).
_view("px_flat", """
SELECT chromosome, position, CAST(NULL AS VARCHAR) AS id, ref,
  CASE WHEN alt2 IS NULL THEN alt ELSE alt || ',' || alt2 END AS alt, quality, filter
FROM px_sites""", "px_sites")

# Long genotypes with site columns.
_view("px_geno", """
SELECT c.pk, c.ln, c.ck, s.chromosome AS reference_name, s.position - 1 AS start_position,
  s.ref AS reference_bases, s.alt, s.alt2, CAST(c.ck AS VARCHAR) AS sample_id, c.a1, c.a2,
  c.phaseset, c.genotype_quality, s.quality, s.filter
FROM px_calls c JOIN px_sites s ON c.pk = s.pk AND c.ln = s.ln""", "px_calls", "px_sites")


def with_views(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in VIEWS[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n][0]}\n)" for n in order)
    body = body.strip()
    if not order:
        return body
    head = body[:14].upper()
    if head.startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes},\n{body[14:].lstrip()}"
    if head.startswith("WITH"):
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


def spark_rounding(sql: str) -> str:
    """Rewrite every ``round(x, d)`` of an oracle into
    ``CAST(round(CAST(x AS DECIMAL(38, 18)), d) AS DOUBLE)``.

    Spark rounds a double through its decimal representation (HALF_UP), so
    ``0.1623453125`` rounds up at 9 digits; DuckDB rounds the binary value,
    which lies just below that tie.  Going through DECIMAL first makes exact
    decimal ties round the same way in both engines."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] in "_."):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        k, depth, comma = j + 6, 1, None
        while depth:
            c = sql[k]
            if c == "(":
                depth += 1
            elif c == ")":
                depth -= 1
            elif c == "," and depth == 1:
                comma = k
            k += 1
        if comma is None:
            out.append(sql[i:k])
            i = k
            continue
        expr, digits = sql[j + 6:comma], sql[comma + 1:k - 1].strip()
        out.append(sql[i:j])
        out.append(f"CAST(round(CAST(({spark_rounding(expr)}) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)")
        i = k
