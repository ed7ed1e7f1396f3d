"""Field rules of the curated entities, as native column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import _c, blank_to_null, contains_any, py_or, py_strip, word_boundary_any

# --- fixed values -----------------------------------------------------------
# Role families, tested in this order on lower(title + " " + description);
# terms are literal substrings ("pm" also fires inside "development").
ROLE_RULES = [
    ("DATA_AI", ["machine learning", "ml engineer", "ai engineer", "data scientist", "llm"]),
    ("RESEARCH", ["research scientist", "ai researcher", "researcher"]),
    ("ENGINEERING", ["software engineer", "developer", "backend", "frontend", "fullstack", "devops"]),
    ("PRODUCT", ["product manager", "pm"]),
    ("SALES_MARKETING", ["sales", "marketing", "growth"]),
]
ROLE_DEFAULT = "OTHER"
# A license containing any of these marks the listing as FREE, else UNKNOWN.
OPEN_LICENSES = ["mit", "apache", "bsd", "gpl", "lgpl", "cc-by", "cc0", "unlicense",
                 "openrail", "creativeml"]
PRICING_TYPES = ["FREE", "FREEMIUM", "PAID", "ENTERPRISE", "UNKNOWN"]
REPO_URL_PATTERN = r"https?://github\.com/([a-zA-Z0-9_.-]+/[a-zA-Z0-9_.-]+)"
REPO_URL_TRAILING = ".,;)]"
OWNER_REPO_PATTERN = r"github\.com/([a-zA-Z0-9_.-]+)/([a-zA-Z0-9_.-]+)"
LEGAL_SUFFIXES = ["inc", "corp", "corporation", "ltd", "limited", "pbc", "llc", "gmbh", "co", "company"]
DEFAULT_LOCATION = "Remote"
STARTUP_DEFAULT_CATEGORIES = ["AI"]
PRODUCT_DEFAULT_SDK = "unknown"
PRODUCT_DESC_TEMPLATE = "{title} — AI application built with {sdk}"
PRODUCT_URL_PREFIX = "https://huggingface.co/spaces/"
FOUNDING_YEAR_RANGE = (1800, 2026)
# ---------------------------------------------------------------------------


def role_family(title, description=None, word_boundary: bool = False) -> Column:
    desc = F.coalesce(_c(description), F.lit("")) if description is not None else F.lit("")
    text = F.lower(F.concat(F.coalesce(_c(title), F.lit("")), F.lit(" "), desc))
    test = word_boundary_any if word_boundary else contains_any
    out = F.lit(ROLE_DEFAULT)
    for family, terms in reversed(ROLE_RULES):
        out = F.when(test(text, terms), F.lit(family)).otherwise(out)
    return out


def pricing_from_license(license_col) -> Column:
    lic = F.lower(_c(license_col).cast("string"))
    return F.when(blank_to_null(lic).isNotNull() & contains_any(lic, OPEN_LICENSES), F.lit("FREE")) \
            .otherwise(F.lit("UNKNOWN"))


def split_job_title(title, source_name) -> Column:
    """'Role at Company' | 'Company: Role' | (source_name, title); both parts stripped."""
    t = _c(title)
    at = F.instr(t, " at ")
    colon = F.instr(t, ":")
    role = (F.when(at > 0, F.substring(t, F.lit(1), at - 1))
             .when(colon > 0, F.substring(t, colon + 1, F.lit(1 << 30)))
             .otherwise(t))
    company = (F.when(at > 0, F.substring(t, at + 4, F.lit(1 << 30)))
                .when(colon > 0, F.substring(t, F.lit(1), colon - 1))
                .otherwise(_c(source_name)))
    return F.struct(py_strip(role).alias("role_title"), py_strip(company).alias("company_name"))


def extract_repo_url(*texts) -> Column:
    """First github.com/<owner>/<repo> URL in the first text that has one."""
    outs = []
    for t in texts:
        path = F.regexp_extract(F.coalesce(_c(t), F.lit("")), REPO_URL_PATTERN, 1)
        path = F.regexp_replace(path, "[" + REPO_URL_TRAILING.replace("]", "\\]") + "]+$", "")
        outs.append(F.when(path != "", F.concat(F.lit("https://github.com/"), path)))
    return F.coalesce(*outs)


def parse_owner_repo(url) -> Column:
    """struct(owner, repo) from a GitHub URL; repo without trailing '/' and '.git'."""
    u = F.coalesce(_c(url), F.lit(""))
    owner = F.regexp_extract(u, OWNER_REPO_PATTERN, 1)
    repo = F.regexp_replace(F.regexp_extract(u, OWNER_REPO_PATTERN, 2), r"/+$", "")
    repo = F.regexp_replace(repo, r"\.git$", "")
    return F.when(owner != "", F.struct(owner.alias("owner"), repo.alias("repo")))


def normalize_name(col) -> Column:
    """lower, strip, delete legal-suffix words, punctuation -> space, collapse."""
    s = py_strip(F.lower(_c(col)))
    s = F.regexp_replace(s, r"(?U)\b(" + "|".join(LEGAL_SUFFIXES) + r")\b", "")
    s = F.regexp_replace(s, r"(?U)[^\w\s]", " ")
    s = py_strip(F.regexp_replace(s, r"(?U)\s+", " "))
    return F.when(_c(col).isNull(), F.lit("")).otherwise(s)


def default_location(col) -> Column:
    return F.coalesce(blank_to_null(_c(col)), F.lit(DEFAULT_LOCATION))


def startup_categories(tags, industries) -> Column:
    """distinct(tags ++ industries) in first-seen order, all of them; default ['AI']."""
    both = F.array_distinct(F.concat(F.coalesce(_c(tags), F.array().cast("array<string>")),
                                     F.coalesce(_c(industries), F.array().cast("array<string>"))))
    return F.when(F.size(both) > 0, both).otherwise(F.array(*[F.lit(x) for x in STARTUP_DEFAULT_CATEGORIES]))


def startup_description(one_liner, long_description) -> Column:
    """The one-liner, else the whole long description."""
    return py_or(one_liner, _c(long_description))


def product_categories(tags, sdk) -> Column:
    """All tags; without any, the SDK and 'AI'."""
    t = _c(tags)
    sdk_v = F.coalesce(_c(sdk), F.lit(PRODUCT_DEFAULT_SDK))
    return F.when(t.isNotNull() & (F.size(t) > 0), t) \
            .otherwise(F.array(sdk_v, F.lit("AI")))


def product_description(short_description, card_title, listing_name, sdk) -> Column:
    title = blank_to_null(_c(card_title))
    sdk_v = F.coalesce(_c(sdk), F.lit(PRODUCT_DEFAULT_SDK))
    built = F.concat(title, F.lit(" — AI application built with "), sdk_v)
    return (F.when(blank_to_null(_c(short_description)).isNotNull(), _c(short_description))
             .when(title.isNotNull() & (title != _c(listing_name)), built))


def founding_year(launched_at) -> Column:
    """UTC year of a Unix-seconds value; 0, null and instants outside years 1 to 9999 -> null."""
    x = _c(launched_at).cast("double")
    # NaN sorts above every number, so it falls outside too
    return F.when((x != 0) & (x >= -62_135_596_800) & (x < 253_402_300_800),
                  F.year(F.timestamp_micros((x * 1_000_000).try_cast("long"))))


def url_is_http(col) -> Column:
    return F.coalesce(_c(col).rlike(r"^https?://"), F.lit(False))
