"""Scans over a landed-payload table.

Payload table: ``url, source_name, kind, status_code, body, error, source_rank, page``
(one fetched body per row).  Every scan keeps only successful fetches, parses
the body with a declared schema (``from_xml`` / variant JSON), explodes the
records with their position and emits ``ord = struct(source_rank, page, pos)``
so that "first wins" rules have an explicit order.  A bad record is rejected on
its own: a feed that is not well-formed is repaired and parsed record by record,
and :func:`rejected_feed_records` lists what was lost, with a reason.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import (PRODUCT_URL_PREFIX, extract_repo_url, founding_year,
                               pricing_from_license, product_categories, product_description,
                               startup_categories, startup_description)
from ..functions.strings import blank_to_null, collapse_ws, py_or, py_strip

# --- fixed values -----------------------------------------------------------
ENTRY_FIELDS = ("id string, title string, published string, summary string, "
                "author array<struct<name string>>, `arxiv:comment` string")
FEED_ITEM = ("title string, link array<struct<_VALUE string, _href string>>, "
             "pubDate string, published string, `dc:date` string, updated string, "
             "`dc:creator` string, author string, creator string, "
             "description string, summary string, content string")
MIN_LIKES = 3
# Candidate tags per field; the first one present in document order wins.
FEED_DATE_TAGS = ["pubDate", "published", "dc:date", "updated"]
FEED_AUTHOR_TAGS = ["dc:creator", "author", "creator"]
FEED_TEXT_TAGS = ["description", "summary", "content"]
# Named entities that feeds use though XML does not define them, with their code points.
HTML_ENTITIES = {"nbsp": 160, "copy": 169, "reg": 174, "laquo": 171, "raquo": 187, "middot": 183, "eacute": 233,
                 "ndash": 8211, "mdash": 8212, "lsquo": 8216, "rsquo": 8217, "ldquo": 8220, "rdquo": 8221,
                 "bull": 8226, "hellip": 8230, "euro": 8364, "trade": 8482}
# ---------------------------------------------------------------------------
_STRAY_AMPERSAND = r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]+|#x[0-9A-Fa-f]+);)"
_ANY_ENTITY = "&(?:" + "|".join(HTML_ENTITIES) + ");"
_CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"
_RECORD_RE = {tag: rf"(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>" for tag in ("item", "entry")}

ATOM_SCHEMA = f"entry array<struct<{ENTRY_FIELDS}>>"
FEED_SCHEMA = (f"channel struct<item array<struct<{FEED_ITEM}>>>, item array<struct<{FEED_ITEM}>>, "
               f"entry array<struct<{FEED_ITEM}>>")
_END = "curata-end"
_RECORDS_SCHEMA = f"item array<struct<{FEED_ITEM}>>, entry array<struct<{FEED_ITEM}>>, `{_END}` string"


def successful(payloads: DataFrame, kind: str | None = None) -> DataFrame:
    """Fetches that returned 200 without a transport error (optionally one kind)."""
    p = payloads.filter((F.col("status_code") == 200) & F.col("error").isNull())
    return p.filter(F.col("kind") == kind) if kind else p


def _ord(pos: Column) -> Column:
    return F.struct(F.col("source_rank").cast("int").alias("source_rank"),
                    F.col("page").cast("long").alias("page"), pos.cast("int").alias("pos"))


def _worked_out(df: DataFrame, kept: list, fields: dict[str, Column]) -> DataFrame:
    """``kept`` columns and ``fields`` as generated columns: a filter on one of them stays above them,
    and none is worked out a second time for it (or, pushed below, for rows that go before it)."""
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(name) for name, c in fields.items()]))))


def _strip_markup(c: Column) -> Column:
    """Text of a small XML fragment read as a string: tags dropped, pieces joined."""
    return py_strip(F.regexp_replace(c, r"(?U)\s*<[^>]*>\s*", ""))


def scan_papers_atom(payloads: DataFrame, kind: str = "atom_papers") -> DataFrame:
    """Atom feed -> paper rows (title/abstract whitespace-collapsed, repo URL found)."""
    p = successful(payloads, kind).select("source_rank", "page", F.from_xml("body", ATOM_SCHEMA).alias("x"))
    e = p.select("source_rank", "page", F.posexplode("x.entry").alias("pos", "e"))
    e = e.filter(F.col("e.id").isNotNull() & F.col("e.title").isNotNull())
    url = py_strip(F.col("e.id"))
    abstract = F.when(blank_to_null(F.col("e.summary")).isNotNull(), collapse_ws(F.col("e.summary")))
    comment = F.coalesce(py_strip(F.col("e.`arxiv:comment`")), F.lit(""))
    authors = F.filter(F.transform(F.coalesce(F.col("e.author"), F.array()), lambda a: py_strip(a["name"])),
                       lambda n: n.isNotNull() & (n != ""))
    return e.select(
        _ord(F.col("pos")).alias("ord"),
        collapse_ws(F.col("e.title")).alias("title"),
        authors.alias("authors"),
        url.alias("paper_url"),
        url.alias("source_url"),
        abstract.alias("abstract"),
        F.when(blank_to_null(F.col("e.published")).isNotNull(), py_strip(F.col("e.published"))).alias("publication_date"),
        extract_repo_url(abstract, comment).alias("github_repository_url"),
        F.lit(None).cast("int").alias("github_stars"),
        F.lit("arxiv").alias("source"),
    )


def repair_xml(c: Column) -> Column:
    """XML text with HTML entities as numbers, stray ampersands escaped and control characters dropped."""
    numbered = c
    for name, code in HTML_ENTITIES.items():
        numbered = F.replace(numbered, F.lit(f"&{name};"), F.lit(f"&#{code};"))
    # one look for any of them: a search for each costs far more than the text's other repairs
    c = F.when(c.rlike(_ANY_ENTITY), numbered).otherwise(c)
    return F.regexp_replace(F.regexp_replace(c, _CONTROL, ""), _STRAY_AMPERSAND, "&amp;")


def _records(body, tag: str) -> Column:
    return F.regexp_extract_all(body, F.lit(_RECORD_RE[tag]), 0)


def _n_records(tags: str) -> Column:
    """Records that a body holds by its closing tags (those quoted in CDATA are text)."""
    plain = F.when(F.contains("body", F.lit("<![CDATA[")), F.regexp_replace("body", r"(?s)<!\[CDATA\[.*?\]\]>", "")) \
        .otherwise(F.col("body"))
    return F.coalesce(F.regexp_count(plain, F.lit(rf"</(?i:{tags})\s*>")), F.lit(0))


def _parse_records(raws: Column) -> Column:
    return F.transform(raws, lambda r: F.from_xml(repair_xml(r), FEED_ITEM))


def rejected_feed_records(payloads: DataFrame, kind: str) -> DataFrame:
    """``url, source_name, page, raw, reason`` of what a feed scan cannot read: ``malformed record``,
    ``cut-off record`` (no closing tag before the end), or ``no records`` for a body without any."""
    p = successful(payloads, kind).select("url", "source_name", "page", F.coalesce("body", F.lit("")).alias("body"),
                                          F.from_xml("body", FEED_SCHEMA).alias("x"))
    parsed = F.coalesce(F.size("x.channel.item"), F.lit(0)) + F.coalesce(F.size("x.item"), F.lit(0)) \
        + F.coalesce(F.size("x.entry"), F.lit(0))
    raws = F.concat(_records("body", "item"), _records("body", "entry"))
    bad = F.filter(raws, lambda r: F.from_xml(repair_xml(r), FEED_ITEM)["title"].isNull())
    tail = F.regexp_extract("body", r"(?is)(<(?:item|entry)(?:\s[^>]*)?>(?:(?!</(?:item|entry)\s*>).)*)$", 1)
    lost = F.concat(
        F.transform(bad, lambda r: F.struct(r.alias("raw"), F.lit("malformed record").alias("reason"))),
        F.when(tail != "", F.array(F.struct(tail.alias("raw"), F.lit("cut-off record").alias("reason")))).otherwise(F.array()),
        F.when((F.size(raws) == 0) & (tail == ""),
               F.array(F.struct(F.col("body").alias("raw"), F.lit("no records").alias("reason")))).otherwise(F.array()))
    broken = (parsed < _n_records("item|entry")) | (tail != "") | (parsed == 0)
    return (p.filter(broken).select("url", "source_name", "page", F.explode(lost).alias("l"))
             .select("url", "source_name", "page", "l.raw", "l.reason"))


def _feed_items(payloads: DataFrame, kind: str, prefer_items: bool) -> DataFrame:
    """One row per feed record: parsed fields ``e`` plus the record's raw XML ``raw``
    (both lists are in document order, so they are zipped by position).

    Strict parsing loses records of a feed that is not well-formed; if it finds fewer than the
    text holds, they are cut out of the text, repaired and parsed together, and one by one only if
    that does not find all of them (a parser per record costs far more than the record)."""
    p = successful(payloads, kind).select("url", "source_name", "source_rank", "page", "body",
                                          F.from_xml("body", FEED_SCHEMA).alias("x"))
    items = F.concat(F.coalesce(F.col("x.channel.item"), F.array()), F.coalesce(F.col("x.item"), F.array()))
    entries = F.coalesce(F.col("x.entry"), F.array())
    ri, re_ = _records("body", "item"), _records("body", "entry")
    if prefer_items:   # RSS items if any, else Atom entries
        strict = F.when(F.size(items) > 0, items).otherwise(entries)
        held = F.when(_n_records("item") > 0, _n_records("item")).otherwise(_n_records("entry"))
        raws = F.when(F.size(ri) > 0, ri).otherwise(re_)
    else:              # both kinds of record
        strict = F.concat(items, entries)
        held = _n_records("item|entry")
        raws = F.concat(ri, re_)
    # a step of its own for each, so that none is worked out twice
    p = p.withColumn("_strict", strict).withColumn("_whole", F.size("_strict") >= held)
    p = p.withColumn("_cut", F.when(~F.col("_whole"), raws))
    # the last element is only read if everything before it is well-formed
    p = p.withColumn("_joined", F.array_join("_cut", ""))
    p = p.withColumn("_again", F.from_xml(F.concat(F.lit("<records>"), repair_xml(F.col("_joined")),
                                                   F.lit(f"<{_END}>1</{_END}></records>")), _RECORDS_SCHEMA))
    again = F.concat(F.coalesce(F.col("_again.item"), F.array()), F.coalesce(F.col("_again.entry"), F.array()))
    all_read = (F.col(f"_again.`{_END}`") == "1") & (F.size(again) == F.size("_cut"))
    p = p.withColumn("_chosen", F.when(F.col("_whole"), F.col("_strict")).when(all_read, again)
                     .otherwise(_parse_records(F.col("_cut"))))
    # the raw record text is only needed when a record has several candidate tags for a field
    chosen, raws = F.col("_chosen"), F.when(F.exists("_chosen", _ambiguous), raws)
    zipped = F.arrays_zip(chosen.alias("e"), F.coalesce(raws, F.array().cast("array<string>")).alias("raw"))
    z = p.select("url", "source_name", "source_rank", "page", F.posexplode(zipped).alias("pos", "z"))
    return z.select("url", "source_name", "source_rank", "page", "pos", F.col("z.e").alias("e"),
                    F.col("z.raw").alias("raw")).filter(F.col("e").isNotNull())


def _ambiguous(e: Column) -> Column:
    """True when the record carries two or more candidate tags for some field."""
    def present(fields):
        n = F.lit(0)
        for f in fields:
            n = n + F.when(e[f].isNotNull(), F.lit(1)).otherwise(F.lit(0))
        return n
    return ((present(FEED_DATE_TAGS) > 1) | (present(FEED_AUTHOR_TAGS) > 1) | (present(FEED_TEXT_TAGS) > 1))


def _first_in_document(fields: list[str]) -> Column:
    """Value of whichever candidate tag occurs first in the record's XML; the fixed
    candidate order is only the fallback when the raw record is not available."""
    alternation = "|".join(fields)
    first = F.lower(F.regexp_extract(F.col("raw"), rf"(?i)<({alternation})[\s/>]", 1))
    fallback = F.coalesce(*[F.col(f"e.`{f}`") for f in fields])
    out = F.lit(None).cast("string")
    for f in reversed(fields):
        out = F.when(first == f.lower(), F.col(f"e.`{f}`")).otherwise(out)
    return F.when(F.coalesce(first, F.lit("")) != "", out).otherwise(fallback)


def _feed_fields(e: DataFrame, dated: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Text fields of feed records.  ``dated`` adds the column ``fresh`` to the records with
    ``pub_date_raw`` before title, link and description are worked out (without it: all fields)."""
    link0 = F.get(F.col("e.link"), 0)
    text, href = link0["_VALUE"], link0["_href"]
    title = F.coalesce(F.col("e.title"), F.lit(""))
    pub = py_strip(_first_in_document(FEED_DATE_TAGS))
    author = _first_in_document(FEED_AUTHOR_TAGS)
    desc = _first_in_document(FEED_TEXT_TAGS)
    if dated is None:
        return e.select(
            "url", "source_name", _ord(F.col("pos")).alias("ord"),
            F.col("e.title").isNotNull().alias("_has_title"),
            link0.isNotNull().alias("_has_link"),
            py_strip(title).alias("title"),
            py_or(py_strip(text), href).alias("link"),
            pub.alias("pub_date_raw"),
            _strip_markup(author).alias("author"),
            py_strip(desc).alias("desc_raw"),
        )
    # plain columns, no struct: Spark does not prune fields of a struct through several generators
    d = dated(e.select("url", "source_name", "source_rank", "page", "pos", title.alias("_title"), text.alias("_text"),
                       href.alias("_href"), desc.alias("_desc"), pub.alias("pub_date_raw")))
    return _worked_out(d, ["url", "source_name", _ord(F.col("pos")).alias("ord"), "pub_date_raw", "fresh"],
                       {"title": py_strip("_title"), "link": py_or(py_strip("_text"), F.col("_href")),
                        "desc_raw": py_strip("_desc")})


def news_text(df: DataFrame) -> DataFrame:
    """summary = content = visible text of the item description (Python worker)."""
    from ..functions.html import strip_html
    summary = F.when(blank_to_null(F.col("desc_raw")).isNotNull(), strip_html(F.col("desc_raw")))
    return df.withColumn("summary", summary).withColumn("content", F.col("summary")).drop("desc_raw")


def scan_news_feed(payloads: DataFrame, kind: str = "news_feed", html_text: bool = True) -> DataFrame:
    """RSS <item> (else Atom <entry>) -> news rows; summary is tag-stripped text.

    ``html_text=False`` keeps the raw description in ``desc_raw`` so a caller can
    filter first and run :func:`news_text` (the Python step) on fewer rows.
    """
    f = _feed_fields(_feed_items(payloads, kind, prefer_items=True))
    f = f.filter(F.col("_has_title") & F.col("_has_link") & F.col("link").isNotNull())
    rows = f.select(
        "ord", "title", F.col("link").alias("article_url"), F.col("url").alias("source_url"),
        F.when(F.col("author") != "", F.col("author")).alias("author"), "desc_raw",
        F.col("pub_date_raw"), F.col("source_name"))
    return news_text(rows) if html_text else rows


def job_text(df: DataFrame) -> DataFrame:
    """description = visible text of the raw item description (Python worker)."""
    from ..functions.html import strip_html
    d = F.coalesce(F.col("desc_raw"), F.lit(""))
    return df.withColumn("description", F.when(d != "", strip_html(d))).drop("desc_raw")


def scan_jobs_feed(payloads: DataFrame, kind: str = "jobs_feed", html_text: bool = True,
                   dated: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """RSS/Atom job feed -> job rows; title split into role / company.

    ``html_text=False`` defers the description's tag stripping (see :func:`job_text`).  ``dated`` adds
    a column ``fresh`` to the records with ``pub_date_raw``; a later filter on it spares the work on the
    other fields.
    """
    from ..functions.rules import DEFAULT_LOCATION, role_family, split_job_title
    f = _feed_fields(_feed_items(payloads, kind, prefer_items=False), dated)
    f = f.filter((F.col("title") != "") & F.col("link").isNotNull())
    split = split_job_title(F.col("title"), F.col("source_name"))
    if dated:
        f = _worked_out(f, f.columns, {name: split[name] for name in ("role_title", "company_name")})
    else:
        f = f.withColumn("_split", split).withColumns({name: F.col(f"_split.{name}") for name in ("role_title", "company_name")})
    desc = F.coalesce(F.col("desc_raw"), F.lit(""))
    rows = f.select(
        "ord", "company_name", "role_title",
        F.col("link").alias("job_url"), F.lit(DEFAULT_LOCATION).alias("location"), F.lit(True).alias("is_remote"),
        role_family(F.col("role_title"), desc).alias("role_family"), "desc_raw",
        F.col("pub_date_raw"), F.col("source_name"), F.col("url").alias("source_url"),
        *(["fresh"] if dated else []))
    return job_text(rows) if html_text else rows


def _json_items(payloads: DataFrame, kind: str, list_key: str | None = None) -> DataFrame:
    """Body JSON -> one variant per list element (list, or object holding ``list_key``)."""
    p = successful(payloads, kind).select("url", "source_name", "source_rank", "page",
                                          F.try_parse_json("body").alias("v"))
    top = F.schema_of_variant("v")
    arr = F.when(top.startswith("ARRAY"), F.try_variant_get("v", "$", "array<variant>"))
    if list_key:
        inner = F.try_variant_get("v", f"$.{list_key}", "array<variant>")
        arr = F.when(top.startswith("OBJECT"), inner).otherwise(arr)
    return (p.select("url", "source_name", "source_rank", "page", F.posexplode(arr).alias("pos", "it"))
             .filter(F.schema_of_variant("it").startswith("OBJECT")))


def _vs(path: str) -> Column:
    """String field of the current JSON item (scalars rendered as text)."""
    return F.try_variant_get("it", f"$.{path}", "string")


def _vtype(path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get("it", f"$.{path}", "variant"))


def scan_jobs_json(payloads: DataFrame, kind: str = "jobs_json",
                   dated: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """JSON list (or {jobs: [...]}) -> job rows; rows missing company/position/url dropped.

    ``dated``: see :func:`scan_jobs_feed`.
    """
    from ..functions.rules import default_location, role_family
    it = _json_items(payloads, kind, list_key="jobs")
    keys = [_ord(F.col("pos")).alias("ord"), "source_name", F.col("url").alias("source_url")]
    fields = {"company_name": blank_to_null(_vs("company")), "role_title": py_or(_vs("position"), _vs("title")),
              "job_url": py_or(_vs("url"), _vs("apply_url")), "location": default_location(_vs("location")),
              "description": _vs("description")}
    date = py_or(_vs("date"), _vs("publication_date"))
    if dated:
        rows = _worked_out(dated(it.withColumn("pub_date_raw", date)), [*keys, "pub_date_raw", "fresh"], fields)
    else:
        rows = it.select(*keys, date.alias("pub_date_raw"), *[c.alias(name) for name, c in fields.items()])
    rows = rows.filter(F.col("company_name").isNotNull() & F.col("role_title").isNotNull() & F.col("job_url").isNotNull())
    return rows.select("ord", "company_name", "role_title", "job_url", "location", F.lit(True).alias("is_remote"), "description",
                       "pub_date_raw", "source_name", "source_url",
                       role_family(F.col("role_title"), F.col("description")).alias("role_family"),
                       *(["fresh"] if dated else []))


def scan_startups_json(payloads: DataFrame, kind: str = "startups_json") -> DataFrame:
    """JSON list of company objects -> startup rows (rows without a name dropped)."""
    it = _json_items(payloads, kind)
    team_is_int = _vtype("team_size").isin("BIGINT", "INT", "SMALLINT", "TINYINT")
    team = F.try_variant_get("it", "$.team_size", "long")
    launched_num = _vtype("launched_at").rlike("^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL)")
    launched = F.try_variant_get("it", "$.launched_at", "double")
    tags = F.try_variant_get("it", "$.tags", "array<string>")
    inds = F.try_variant_get("it", "$.industries", "array<string>")
    rows = it.select(
        _ord(F.col("pos")).alias("ord"),
        blank_to_null(_vs("name")).alias("name"),
        startup_description(_vs("one_liner"), _vs("long_description")).alias("description"),
        blank_to_null(_vs("website")).alias("website_url"),
        py_or(_vs("url"), F.col("url")).alias("source_url"),
        F.when(team_is_int & (team > 0), team.try_cast("int")).alias("employee_count"),
        F.when(launched_num, founding_year(launched)).alias("founding_year"),
        blank_to_null(_vs("all_locations")).alias("headquarters"),
        startup_categories(tags, inds).alias("categories"),
        blank_to_null(_vs("stage")).alias("funding_stage"),
    )
    return rows.filter(F.col("name").isNotNull())


def scan_products_json(payloads: DataFrame, kind: str = "products_json", min_likes: int = MIN_LIKES) -> DataFrame:
    """JSON listing array -> product rows; id 'owner/name' required; likes filter applied."""
    it = _json_items(payloads, kind)
    lid = _vs("id")
    likes = F.coalesce(F.try_variant_get("it", "$.likes", "long"), F.lit(0))
    card_title = F.try_variant_get("it", "$.cardData.title", "string")
    card_desc = F.try_variant_get("it", "$.cardData.short_description", "string")
    lic = F.try_variant_get("it", "$.cardData.license", "string")
    sdk = F.coalesce(_vs("sdk"), F.lit("unknown"))
    tags = F.try_variant_get("it", "$.tags", "array<string>")
    rows = it.select(_ord(F.col("pos")).alias("ord"), lid.alias("listing_id"), likes.alias("likes"),
                     card_title.alias("_title"), card_desc.alias("_desc"), lic.alias("_license"),
                     sdk.alias("_sdk"), tags.alias("_tags"))
    rows = rows.filter(F.col("listing_id").contains("/") & (F.col("likes") >= min_likes))
    parts = F.split(F.col("listing_id"), "/", 2)
    name = F.get(parts, 1)
    url = F.concat(F.lit(PRODUCT_URL_PREFIX), F.col("listing_id"))
    return rows.select(
        "ord", "listing_id", "likes",
        name.alias("name"),
        product_description(F.col("_desc"), F.col("_title"), name, F.col("_sdk")).alias("description"),
        url.alias("product_url"), url.alias("source_url"),
        pricing_from_license(F.col("_license")).alias("pricing_type"),
        F.get(parts, 0).alias("company_name"),
        product_categories(F.col("_tags"), F.col("_sdk")).alias("categories"))


def scan_stars_json(payloads: DataFrame, kind: str = "repo_json") -> DataFrame:
    """Repo API bodies -> (owner, repo, stars); stars only when a JSON integer."""
    p = successful(payloads, kind).select("url", F.try_parse_json("body").alias("v"))
    owner = F.regexp_extract("url", r"/repos/([^/]+)/([^/?#]+)", 1)
    repo = F.regexp_extract("url", r"/repos/([^/]+)/([^/?#]+)", 2)
    typ = F.schema_of_variant(F.try_variant_get("v", "$.stargazers_count", "variant"))
    stars = F.when(typ.isin("BIGINT", "INT", "SMALLINT", "TINYINT"),
                   F.try_variant_get("v", "$.stargazers_count", "long"))
    return p.select(owner.alias("owner"), repo.alias("repo"), stars.alias("stars")).filter(F.col("owner") != "")


def multi_source_union(payloads: DataFrame, registry: DataFrame, scans: dict) -> DataFrame:
    """Successful payloads of the registered sources, parsed per kind, in registry order.

    ``registry``: (source_name, kind, url, rank).  It is normally a handful of
    rows, but it is caller-supplied, so no broadcast is forced: AQE broadcasts it
    from its runtime size.
    ``scans``: kind -> scan function (all with the same output columns).
    """
    reg = registry.select("source_name", F.col("rank").alias("source_rank"))
    p = successful(payloads).drop("source_rank").join(reg, "source_name", "inner")
    out = None
    for kind, fn in scans.items():
        part = fn(p, kind)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def paged_limit(df: DataFrame, limit: int, order: str = "ord") -> DataFrame:
    """First ``limit`` records in ordinal order (a top-k: one TakeOrderedAndProject)."""
    return df.orderBy(order).limit(limit)


def scan_table(spark, path: str) -> DataFrame:
    """Full scan of a stored curated table (Parquet)."""
    return spark.read.parquet(path)
