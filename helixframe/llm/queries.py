"""The queries op1 to op13 and their DuckDB oracles, where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (collocations, exact_dedup, jaccard_join, lexical_search, mixing, pieces, pii, pitman_yor, quality_rules,
               secrets_scan, token_counts, toxicity, warc)
from .common import ASCII_UPPER, table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents mixed by the square root of their source's size, one epoch long."""
    out = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "lang", "n_chars", "text", "copy_no", "shuffle_key")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find_pii(table(spark, sf_dir, "documents")))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets_scan.scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(F.encode("base", "UTF-8"), 256).alias("base_sha256"), "spans", "n_credential")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


def op9_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_documents(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_warc, op2_mixing, op3_exact_dedup, op4_pii, op5_sentencepiece, op6_secrets, op7_toxicity,
                                   op8_quality_rules, op9_pitman_yor, op10_jaccard_join, op11_token_counts,
                                   op12_collocations, op13_lexical_search)}

_WS = r"[\x20\x09-\x0D]"
_OP1 = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
                  coalesce(html, '') AS html FROM pages),
h AS (SELECT html, max(page_id) AS holder FROM p WHERE payload_bytes >= 1000 GROUP BY html)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN holder <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN holder <> page_id THEN holder END AS refers_to
FROM p LEFT JOIN h ON p.html = h.html"""
_OP2 = """
WITH counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
weights AS (SELECT source, n, pow(n::DOUBLE, 0.5) AS w FROM counts),
rates AS (SELECT source, (SELECT sum(n) FROM weights) * w / (SELECT sum(w) FROM weights) / n AS rate FROM weights),
steps AS (SELECT source, greatest(1, ceil(rate / 8.0))::INT AS draws, rate FROM rates),
terms AS (SELECT source, draws, k, exp(-(rate / draws)) * pow(rate / draws, k::DOUBLE) / gamma(k + 1.0) AS p
          FROM steps, range(0, 64) r(k)),
cdf AS (SELECT source, draws, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
ids AS (SELECT DISTINCT doc_id, source, coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) AS own FROM documents),
draw AS (SELECT own, source, ('0x' || substr(md5('17:' || own || ':' || j), 1, 13))::BIGINT / 4503599627370496.0 AS u
         FROM (SELECT i.own, i.source, unnest(range(1, draws + 1)) AS j FROM ids i JOIN steps s ON i.source IS NOT DISTINCT FROM s.source)),
hits AS (SELECT d.own, d.source, count(*) FILTER (WHERE c.c <= d.u) AS n
         FROM draw d JOIN cdf c ON d.source IS NOT DISTINCT FROM c.source GROUP BY d.own, d.source),
x AS (SELECT d.*, own, unnest(range(1, h.n + 1)) AS copy_no FROM documents d JOIN hits h
      ON coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) = h.own AND d.source IS NOT DISTINCT FROM h.source)
SELECT doc_id, source, lang, n_chars, text, CAST(copy_no AS INT) AS copy_no,
       ('0x' || substr(md5('order 17:' || own || ':' || copy_no), 1, 15))::BIGINT AS shuffle_key FROM x"""
_OP3 = rf"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                  regexp_replace(coalesce(text, ''), '{_WS}+', '', 'g') AS norm FROM documents),
g AS (SELECT norm, count(*) AS group_size, arg_min(doc_id, (-chars, doc_id)) AS keep_id FROM n GROUP BY norm)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.norm) AS text_sha256
FROM n JOIN g USING (norm)"""
_STOP = ", ".join(f"'{w}'" for w in sorted({*quality_rules.STOP_WORDS, *quality_rules.CAPITALISED}))
_OP8 = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
a AS (SELECT doc_id, t, list_filter(regexp_split_to_array(t, '{_WS}+'), lambda x: x <> '') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM t),
p AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM a)),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM p) WHERE c > 1),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM d, range(0, 8) s(k) GROUP BY doc_id),
m AS (SELECT a.doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '{_WS}+', '', 'g')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
             len(list_filter(w, lambda x: x IN ({_STOP}))) AS stops,
             len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS alphas,
             len(list_filter(l, lambda x: regexp_matches(x, '^\s*[-*•]'))) AS bullets,
             len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) AS dots, len(l) AS lines
      FROM a LEFT JOIN r ON a.doc_id = r.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_words >= 20 AND word_chars / n_words BETWEEN 2 AND 14
       AND n_symbols / n_words <= 0.3 AND stops / n_words >= 0.01 AND alphas / n_words >= 0.6
       AND (lines = 0 OR (n_dup_lines / lines <= 0.5 AND bullets / lines <= 0.9 AND dots / lines <= 0.3)) AS kept
FROM b"""
_LOWER = f"translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_UPPER.lower()}')"
_OP12 = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
o AS (SELECT lang, k, w[i:i + k - 1] AS p FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 4) r(k))),
f AS (SELECT lang, k, p, count(*) AS a FROM o GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
c AS (SELECT lang, k, p, a, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
s AS (SELECT c.*, x.a AS l, y.a AS r, (1000000::HUGEINT * c.a * c.a) // (x.a::HUGEINT * y.a) AS score
      FROM c JOIN f x ON x.lang = c.lang AND x.p = c.p[1:cut] JOIN f y ON y.lang = c.lang AND y.p = c.p[cut + 1:]),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1),
g AS (SELECT lang, q, max(a) AS a FROM (SELECT lang, a, unnest([p[1:2], p[2:3]]) AS q FROM f WHERE k = 3) GROUP BY lang, q),
z AS (SELECT b.lang, array_to_string(b.p, ' ') AS phrase, b.a, l, r, n, score::BIGINT AS score
      FROM b JOIN n ON n.lang = b.lang LEFT JOIN g ON g.lang = b.lang AND g.q = b.p WHERE g.a IS NULL OR 100 * g.a < 50 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM z
QUALIFY rank <= 2000"""
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
_OP13 = rf"""
WITH d AS (SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS t FROM documents),
h AS (SELECT d, doc_id, len(t) AS n, t FROM d WHERE len(t) > 0),
s AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS nt FROM h),
tf AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(t) AS term FROM h) GROUP BY d, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
q AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT i, item_id, unnest(t) AS term FROM
      (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS t FROM benchmark)) GROUP BY i, item_id, term),
w AS (SELECT i, item_id, q.term, times * floor(1000 * ln((2 * nd + 2) / (2 * df + 1)))::BIGINT AS w FROM q JOIN df USING (term), s),
x AS (SELECT i, item_id, tf.d, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // nt))))::BIGINT AS score
      FROM w JOIN tf USING (term) JOIN h ON h.d = tf.d, s GROUP BY i, item_id, tf.d)
SELECT item_id, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM x JOIN h USING (d) WHERE score > 0 QUALIFY rank <= 20"""
ORACLES = {"op1_warc": _OP1, "op2_mixing": _OP2, "op3_exact_dedup": _OP3, "op8_quality_rules": _OP8,
           "op12_collocations": _OP12, "op13_lexical_search": _OP13}
