"""Entity resolution over company names rendered from customer / orders keys."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rules import LEGAL_SUFFIXES, normalize_name
from ..operators.enrich import attach_canonical
from ..operators.fuzzy_join import resolve_with_tables
from ..operators.resolve import KNOWN_ALIASES, SEED_ENTITIES, count_matches, mapping_log, resolve_entities
from ..sources.payloads import scan_jobs_json
from .catalog import register
from .derive import REFERENCE_TIME, company_name, job_json_payloads
from .sqlfrag import company_sql, lit
from .tables import table

LOG_TS = REFERENCE_TIME.replace(" ", "T") + "+00:00"


def _names(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    raw = F.when(k % 23 == 0, F.lit("")).when(k % 29 == 0, F.lit("   ")).otherwise(company_name(k))
    return c.select(k.alias("custkey"), raw.alias("raw_name"),
                    F.concat(F.lit("https://directory.example.com/companies/"), k.cast("string")).alias("source_url"))


NAMES_SQL = f"""
SELECT c_custkey AS custkey,
       CASE WHEN c_custkey % 23 = 0 THEN '' WHEN c_custkey % 29 = 0 THEN '   ' ELSE {company_sql('c_custkey')} END AS raw_name,
       'https://directory.example.com/companies/' || c_custkey AS source_url
FROM customer"""


def norm_sql(x: str) -> str:
    suff = "|".join(LEGAL_SUFFIXES)
    return (f"trim(regexp_replace(regexp_replace(regexp_replace(trim(lower({x})), '\\b({suff})\\b', '', 'g'), "
            f"'[^\\w\\s]', ' ', 'g'), '\\s+', ' ', 'g'))")


def sort_tokens_sql(x: str) -> str:
    return f"array_to_string(list_sort(string_split_regex(trim({x}), '\\s+')), ' ')"


def lcs_sql(a: str, b: str) -> str:
    return (f"list_reduce(string_split({a}, ''), lambda prev, ca: list_reduce(range(1, length({b}) + 1), "
            f"lambda acc, j: list_append(acc, CASE WHEN ca = substr({b}, j::INT, 1) THEN prev[j] + 1 "
            f"ELSE greatest(prev[j + 1], acc[j]) END), [0]), "
            f"list_transform(range(0, length({b}) + 1), lambda z: 0))[-1]")


def resolve_sql(names_sql: str, threshold: float = 85.0) -> str:
    """CTE chain ending in ``res(raw_name, canonical_name, match_method, confidence)`` plus ``names``."""
    seeds = ", ".join(f"({i}, {lit(s)})" for i, s in enumerate(SEED_ENTITIES))
    aliases = ", ".join(f"({lit(k)}, {lit(v)})" for k, v in KNOWN_ALIASES.items())
    return f"""
WITH names AS ({names_sql}),
seeds AS (SELECT * FROM (VALUES {seeds}) t(seed_pos, seed)),
seed_norm AS (SELECT {norm_sql('seed')} AS norm, arg_max(seed, seed_pos) AS exact_canonical FROM seeds GROUP BY 1),
aliases AS (SELECT * FROM (VALUES {aliases}) t(norm, alias_canonical)),
d AS (SELECT DISTINCT raw_name FROM names),
n AS (SELECT raw_name, {norm_sql('raw_name')} AS norm, (raw_name IS NULL OR trim(raw_name) = '') AS blank FROM d),
j AS (SELECT n.*, s.exact_canonical, a.alias_canonical FROM n LEFT JOIN seed_norm s ON n.norm = s.norm
      LEFT JOIN aliases a ON n.norm = a.norm),
fz AS (SELECT raw_name, {sort_tokens_sql('raw_name')} AS q FROM j
       WHERE NOT blank AND exact_canonical IS NULL AND alias_canonical IS NULL),
pairs AS (SELECT raw_name, q, seed_pos, seed, {sort_tokens_sql('seed')} AS c FROM fz CROSS JOIN seeds),
scored AS (SELECT raw_name, seed_pos, seed,
                  (1.0 - CAST(length(q) + length(c) - 2 * {lcs_sql('q', 'c')} AS DOUBLE) / (length(q) + length(c))) * 100.0
                  AS score FROM pairs),
best AS (SELECT raw_name, seed AS fz_name, score AS fz_score FROM (
           SELECT *, row_number() OVER (PARTITION BY raw_name ORDER BY score DESC, seed_pos) AS rn FROM scored)
         WHERE rn = 1),
res AS (
  SELECT j.raw_name,
    CASE WHEN blank THEN 'Unresolved' WHEN exact_canonical IS NOT NULL THEN exact_canonical
         WHEN alias_canonical IS NOT NULL THEN alias_canonical
         WHEN fz_score >= {threshold} THEN fz_name ELSE trim(j.raw_name) END AS canonical_name,
    CASE WHEN blank THEN 'NONE' WHEN exact_canonical IS NOT NULL THEN 'EXACT'
         WHEN alias_canonical IS NOT NULL THEN 'ALIAS'
         WHEN fz_score >= {threshold} THEN 'FUZZY' ELSE 'UNRESOLVED' END AS match_method,
    CASE WHEN blank THEN 0.0 WHEN exact_canonical IS NOT NULL OR alias_canonical IS NOT NULL THEN 100.0
         ELSE coalesce(fz_score, 0.0) END AS confidence
  FROM j LEFT JOIN best b ON j.raw_name = b.raw_name)
"""


R = resolve_sql(NAMES_SQL)
JOINED = R + "SELECT names.custkey, names.raw_name, names.source_url, res.canonical_name, res.match_method, " \
             "CAST(res.confidence AS DOUBLE) AS confidence FROM names JOIN res ON names.raw_name = res.raw_name"


def _resolved(spark, sf):
    return resolve_entities(_names(spark, sf), "raw_name")


@register("normalize_name", f"SELECT custkey, {norm_sql('raw_name')} AS norm FROM ({NAMES_SQL})")
def q_normalize_name(spark, sf):
    return _names(spark, sf).select("custkey", normalize_name("raw_name").alias("norm"))


@register("match_exact", f"SELECT custkey, canonical_name FROM ({JOINED}) WHERE match_method = 'EXACT'")
def q_match_exact(spark, sf):
    return _resolved(spark, sf).filter(F.col("match_method") == "EXACT").select("custkey", "canonical_name")


@register("match_alias", f"SELECT custkey, canonical_name FROM ({JOINED}) WHERE match_method = 'ALIAS'")
def q_match_alias(spark, sf):
    return _resolved(spark, sf).filter(F.col("match_method") == "ALIAS").select("custkey", "canonical_name")


@register("match_fuzzy", f"SELECT custkey, canonical_name, confidence FROM ({JOINED}) WHERE match_method = 'FUZZY'")
def q_match_fuzzy(spark, sf):
    return (_resolved(spark, sf).filter(F.col("match_method") == "FUZZY")
            .select("custkey", "canonical_name", "confidence"))


@register("resolve_entities", f"SELECT custkey, canonical_name, match_method, confidence FROM ({JOINED})")
def q_resolve_entities(spark, sf):
    return _resolved(spark, sf).select("custkey", "canonical_name", "match_method", "confidence")


def _lookup_tables(spark):
    """The fixed seeds and aliases as tables."""
    return (spark.createDataFrame(list(enumerate(SEED_ENTITIES)), "seed_pos int, seed string"),
            spark.createDataFrame(list(KNOWN_ALIASES.items()), "alias string, canonical string"))


@register("resolve_entities_tables", f"SELECT custkey, canonical_name, match_method, confidence FROM ({JOINED})")
def q_resolve_entities_tables(spark, sf):
    """The same resolution with seeds and aliases as tables, by the similarity join."""
    r = resolve_with_tables(_names(spark, sf), "raw_name", *_lookup_tables(spark))
    return r.select("custkey", "canonical_name", "match_method", "confidence")


@register("match_fuzzy_tables", f"SELECT custkey, canonical_name, confidence FROM ({JOINED}) WHERE match_method = 'FUZZY'")
def q_match_fuzzy_tables(spark, sf):
    """The fuzzy matches alone, by the similarity join; unmatched names are not scored."""
    r = resolve_with_tables(_names(spark, sf), "raw_name", *_lookup_tables(spark), score_unresolved=False)
    return r.filter(F.col("match_method") == "FUZZY").select("custkey", "canonical_name", "confidence")


@register("mapping_log", f"SELECT raw_name, canonical_name, match_method, confidence, source_url, "
                         f"'{LOG_TS}' AS timestamp FROM ({JOINED})")
def q_mapping_log(spark, sf):
    return mapping_log(_resolved(spark, sf), "raw_name", "source_url", LOG_TS)


@register("count_matches", f"SELECT count(*) FILTER (WHERE match_method <> 'UNRESOLVED') AS entity_matches, "
                           f"count(*) AS resolutions FROM ({JOINED})")
def q_count_matches(spark, sf):
    return count_matches(_resolved(spark, sf))


_JOB_NAMES = f"""
SELECT DISTINCT {company_sql('o_custkey')} AS raw_name FROM orders"""


@register("attach_canonical", resolve_sql(_JOB_NAMES) + f"""
SELECT 'https://jobs.example.com/o/' || o_orderkey AS job_url, res.canonical_name AS canonical_company_name
FROM orders JOIN res ON {company_sql('o_custkey')} = res.raw_name""")
def q_attach_canonical(spark, sf):
    jobs = scan_jobs_json(job_json_payloads(spark, sf, complete=True))
    return attach_canonical(jobs, "company_name", "canonical_company_name").select("job_url", "canonical_company_name")
