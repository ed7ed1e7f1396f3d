"""Entity schemas (declared, never inferred) and enum values."""
from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
PRICING_TYPES = ["FREE", "FREEMIUM", "PAID", "ENTERPRISE", "UNKNOWN"]
ROLE_FAMILIES = ["ENGINEERING", "RESEARCH", "PRODUCT", "DATA_AI", "SALES_MARKETING", "OTHER"]
RECORD_TYPES = ["STARTUP", "PRODUCT", "RESEARCH_PAPER", "JOB", "NEWS"]
MATCH_METHODS = ["NONE", "EXACT", "ALIAS", "FUZZY", "UNRESOLVED"]
# ---------------------------------------------------------------------------

S, I, D, B = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
ARR = T.ArrayType(T.StringType())


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


BASE = [_f("id", S), _f("source_url", S, False), _f("collected_at", S), _f("record_type", S)]

STARTUP = T.StructType(BASE + [
    _f("name", S, False), _f("canonical_name", S), _f("description", S), _f("website_url", S),
    _f("employee_count", I), _f("founding_year", I), _f("headquarters", S), _f("categories", ARR),
    _f("funding_stage", S)])

PRODUCT = T.StructType(BASE + [
    _f("name", S, False), _f("canonical_name", S), _f("description", S), _f("product_url", S),
    _f("pricing_type", S), _f("pricing_details", S), _f("company_name", S), _f("categories", ARR)])

PAPER = T.StructType(BASE + [
    _f("title", S, False), _f("authors", ARR), _f("paper_url", S, False), _f("abstract", S),
    _f("publication_date", S), _f("github_repository_url", S), _f("github_stars", I), _f("source", S)])

JOB = T.StructType(BASE + [
    _f("company_name", S, False), _f("canonical_company_name", S), _f("role_title", S, False),
    _f("job_url", S, False), _f("location", S), _f("is_remote", B), _f("role_family", S),
    _f("description", S), _f("publication_date", S), _f("freshness_verified", B), _f("source_name", S, False)])

NEWS = T.StructType(BASE + [
    _f("title", S, False), _f("article_url", S, False), _f("author", S), _f("summary", S),
    _f("content", S), _f("publication_date", S), _f("freshness_verified", B), _f("source_name", S, False)])

MAPPING_LOG = T.StructType([
    _f("raw_name", S), _f("canonical_name", S), _f("match_method", S), _f("confidence", D),
    _f("source_url", S), _f("timestamp", S)])

PAYLOAD = T.StructType([
    _f("url", S), _f("source_name", S), _f("kind", S), _f("status_code", I), _f("body", S),
    _f("latency_ms", D), _f("error", S), _f("fetched_at", T.TimestampType()),
    _f("source_rank", I), _f("page", T.LongType())])

ENTITY_SCHEMAS = {"startup": STARTUP, "product": PRODUCT, "paper": PAPER, "job": JOB, "news": NEWS}
RECORD_TYPE_OF = {"startup": "STARTUP", "product": "PRODUCT", "paper": "RESEARCH_PAPER",
                  "job": "JOB", "news": "NEWS"}
