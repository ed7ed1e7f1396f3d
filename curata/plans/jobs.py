"""End-to-end curation jobs: payloads -> curated rows ready to insert.

Each job is pure DataFrame composition of the operators; nothing is collected
to the driver.  Order of work is chosen for cost: cheap filters and dedup run
before joins and Python-worker steps (freshness before the page join, dedup
before enrichment).  Each returns the rows that are new to ``store`` (a
DataFrame with a ``dedup_key`` column, e.g. the curated Parquet table).
``checkpoint=True`` cuts the lineage right after the parse (and freshness)
stage with a reliable checkpoint in ``spark.checkpoint.dir``: a lost executor
then re-reads parsed records instead of re-parsing payloads, and plans that
branch off several counters from one job stay small.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_utc_string, with_freshness
from ..operators.dedup import dedup_first, dedup_key, dedup_listing_id, dedup_name_priority, dedup_seen
from ..operators.enrich import attach_canonical, enrich_article, enrich_readme, enrich_stars
from ..operators.extract import extract_batch, merge_news, merge_product, merge_startup, needs_extraction
from ..operators.resolve import resolve_names
from ..operators.validate import validate_entities, with_violations
from ..schemas import RECORD_TYPE_OF
from ..session import cut_lineage
from ..sources.payloads import (job_text, news_text, scan_jobs_feed, scan_jobs_json, scan_news_feed,
                                scan_papers_atom, scan_products_json, scan_startups_json, scan_stars_json)


def _keep(stages: dict | None, **frames) -> None:
    """Record intermediate DataFrames (for run counters) when the caller asks for them."""
    if stages is not None:
        stages.update(frames)


def _new(unique: DataFrame, store: DataFrame | None, stages: dict | None) -> DataFrame:
    """Rows that ``store`` lacks: taken out before joins, page texts and provider calls, not after them."""
    if store is None:
        return unique
    _keep(stages, unique=unique)
    return dedup_seen(unique, store, "dedup_key")


def finish(df: DataFrame, entity: str, collected_at: str | None) -> DataFrame:
    """The rows with id, collected_at and record_type."""
    # collected_at: the caller's run timestamp, else the query's own (one value per query)
    ts = F.lit(collected_at) if collected_at else iso_utc_string(F.current_timestamp())
    return df.withColumns({"id": F.sha2(F.col("dedup_key"), 256), "collected_at": ts,
                            "record_type": F.lit(RECORD_TYPE_OF[entity])})


def _extract_and_merge(df: DataFrame, entity: str, text: str, providers, merge, stages: dict | None = None) -> DataFrame:
    """Run the provider tiers on 'attempt' rows only and merge valid answers back."""
    todo = df.filter(F.col("extraction_status") == "attempt").select("dedup_key", F.col(text).alias("_text"))
    resp = extract_batch(todo, "dedup_key", "_text", entity, providers)
    _keep(stages, extractions=resp)
    good = resp.filter("answered > 0").select(F.col("id").alias("dedup_key"), "parsed")
    j = df.join(good, "dedup_key", "left")
    merged = merge(j)
    return merged.drop("parsed")


def job_papers(payloads: DataFrame, repo_payloads: DataFrame | None = None, store: DataFrame | None = None,
               collected_at: str | None = None, stages: dict | None = None, checkpoint: bool = False) -> DataFrame:
    p = cut_lineage(scan_papers_atom(payloads), checkpoint)
    valid, _rejected = validate_entities(p, "paper")
    _keep(stages, discovered=valid, rejected=_rejected)
    keyed = valid.withColumn("dedup_key", dedup_key("paper", paper_url=F.col("paper_url")))
    unique = _new(dedup_first(keyed, "dedup_key", "ord"), store, stages)
    if repo_payloads is not None:
        unique = enrich_stars(unique, scan_stars_json(repo_payloads))
    return finish(unique, "paper", collected_at)


def job_startups(payloads: DataFrame, store: DataFrame | None = None, providers=None,
                 collected_at: str | None = None, stages: dict | None = None, checkpoint: bool = False) -> DataFrame:
    s = cut_lineage(with_violations(scan_startups_json(payloads), "startup"), checkpoint)
    s = s.withColumn("is_valid", F.size("violations") == 0)
    _keep(stages, rejected=s.filter(~F.col("is_valid")))
    s = dedup_name_priority(s.drop("violations"), "name", "ord", "is_valid").drop("is_valid")
    s = attach_canonical(s, "name", "canonical_name")
    _keep(stages, discovered=s, resolutions=s.select(F.col("canonical_name_method").alias("match_method")))
    s = s.drop("canonical_name_method")
    s = s.withColumn("dedup_key", dedup_key("startup", name=F.col("name"), canonical_name=F.col("canonical_name"),
                                            website_url=F.col("website_url"), source_url=F.col("source_url")))
    s = _new(dedup_first(s, "dedup_key", "ord"), store, stages)
    s = s.withColumn("extraction_status", needs_extraction("startup", raw_text="description"))
    if providers:
        s = _extract_and_merge(s, "startup", "description", providers, merge_startup, stages)
    return finish(s, "startup", collected_at)


def job_products(payloads: DataFrame, readmes: DataFrame | None = None, store: DataFrame | None = None,
                 providers=None, collected_at: str | None = None, stages: dict | None = None,
                 checkpoint: bool = False) -> DataFrame:
    p = cut_lineage(dedup_listing_id(scan_products_json(payloads), "listing_id", "ord"), checkpoint)
    # the creator company is resolved for the audit log only; canonical_name = listing name
    p = p.withColumn("canonical_name", F.when(F.col("company_name").isNotNull() & (F.col("company_name") != ""),
                                              F.col("name")))
    valid, _rejected = validate_entities(p, "product")
    if stages is not None:
        comp = valid.filter(F.col("company_name").isNotNull() & (F.col("company_name") != ""))
        log = attach_canonical(comp.select("company_name"), "company_name", "_company_canonical")
        _keep(stages, discovered=valid, rejected=_rejected,
              resolutions=log.select(F.col("_company_canonical_method").alias("match_method")))
    k = valid.withColumn("dedup_key", dedup_key("product", name=F.col("name"), canonical_name=F.col("canonical_name"),
                                                product_url=F.col("product_url"), source_url=F.col("source_url")))
    k = _new(dedup_first(k, "dedup_key", "ord"), store, stages)
    complete = (F.col("description").isNotNull() & (F.col("description") != "") & (F.size("categories") > 0))
    k = k.withColumn("needs_extraction", ~complete)
    if readmes is not None:
        k = enrich_readme(k, readmes, "needs_extraction")
    else:
        k = k.withColumn("readme", F.lit(None).cast("string"))
    k = k.withColumn("extraction_status", needs_extraction("product", raw_text="readme")).drop("needs_extraction")
    if providers:
        k = _extract_and_merge(k, "product", "readme", providers, merge_product, stages)
    return finish(k, "product", collected_at)


def product_company_log(payloads: DataFrame) -> DataFrame:
    """Resolution rows for product creator companies (the products keep their own name)."""
    p = dedup_listing_id(scan_products_json(payloads), "listing_id", "ord")
    return resolve_names(p.filter(F.col("company_name") != ""), "company_name")


def _fresh_rows(dated: DataFrame, checkpoint: bool, stages: dict | None) -> DataFrame:
    f = cut_lineage(dated, checkpoint)
    _keep(stages, stale=f.filter(F.col("fresh.verdict") == "STALE"))
    return f.filter(F.col("fresh.is_fresh")).withColumns(
        {"publication_date": iso_utc_string(F.col("fresh.published_at")), "published_at": F.col("fresh.published_at"),
         "freshness_verified": F.lit(True)}).drop("fresh")


def news_candidates(payloads: DataFrame, reference_time, max_age_hours: float = 24.0, checkpoint: bool = False,
                    stages: dict | None = None) -> DataFrame:
    """Fresh, valid news rows with their dedup_key, repeats included (batch or stream)."""
    n = with_freshness(scan_news_feed(payloads, html_text=False), "pub_date_raw", reference_time, max_age_hours, out="fresh")
    n = _fresh_rows(n, checkpoint, stages)
    valid, _rejected = validate_entities(n, "news")
    _keep(stages, discovered=n, rejected=_rejected)
    return valid.withColumn("dedup_key", dedup_key("news", article_url=F.col("article_url")))


def news_details(unique: DataFrame, pages: DataFrame | None = None, providers=None, stages: dict | None = None) -> DataFrame:
    """What one row per key still needs: texts, article pages, extraction (Python steps)."""
    k = news_text(unique)
    if pages is not None:
        k = enrich_article(k, pages, "article_url")
    k = k.withColumn("extraction_status", needs_extraction("news", raw_text="content"))
    return _extract_and_merge(k, "news", "content", providers, merge_news, stages) if providers else k


def job_news(payloads: DataFrame, reference_time, pages: DataFrame | None = None, store: DataFrame | None = None,
             providers=None, max_age_hours: float = 24.0, collected_at: str | None = None, checkpoint: bool = False,
             stages: dict | None = None) -> DataFrame:
    k = dedup_first(news_candidates(payloads, reference_time, max_age_hours, checkpoint, stages), "dedup_key", "ord")
    return finish(news_details(_new(k, store, stages), pages, providers, stages), "news", collected_at)


def _ranked(jobs: DataFrame, kind_rank: int) -> DataFrame:
    """``ord`` made unique across kinds and sources: JSON listings before feeds, then source and url."""
    return jobs.withColumn("ord", F.struct("ord.source_rank", "ord.page", "ord.pos", F.lit(kind_rank).alias("kind_rank"),
                                           "source_name", "source_url"))


def job_candidates(json_payloads: DataFrame, feed_payloads: DataFrame | None, reference_time,
                   max_age_hours: float = 24.0, checkpoint: bool = False, stages: dict | None = None) -> DataFrame:
    """Fresh, valid job rows with their dedup_key, repeats included (batch or stream)."""
    def dated(records: DataFrame) -> DataFrame:
        return with_freshness(records, "pub_date_raw", reference_time, max_age_hours, out="fresh")
    j = _ranked(scan_jobs_json(json_payloads, dated=dated), 0).withColumn("desc_raw", F.lit(None).cast("string"))
    if feed_payloads is not None:
        j = j.unionByName(_ranked(scan_jobs_feed(feed_payloads, html_text=False, dated=dated), 1), allowMissingColumns=True)
    j = _fresh_rows(j, checkpoint, stages)
    if stages is not None:
        log = attach_canonical(j.select("company_name"), "company_name", "_canonical")
        _keep(stages, discovered=j, resolutions=log.select(F.col("_canonical_method").alias("match_method")))
    valid, _rejected = validate_entities(j, "job")
    _keep(stages, rejected=_rejected)
    return valid.withColumn("dedup_key", dedup_key("job", company_name=F.col("company_name"),
                                                   role_title=F.col("role_title"), job_url=F.col("job_url")))


def job_details(unique: DataFrame) -> DataFrame:
    """Canonical company and description of one row per key."""
    # the key does not use the canonical name, so names are resolved on the rows that stay
    k = attach_canonical(unique, "company_name", "canonical_company_name").drop("canonical_company_name_method")
    # JSON items carry a plain description; feed items get their tags stripped now (fewer rows)
    return job_text(k.withColumn("_plain", F.col("description"))).withColumn(
        "description", F.when(F.col("_plain").isNotNull(), F.col("_plain")).otherwise(F.col("description"))).drop("_plain")


def job_jobs(json_payloads: DataFrame, feed_payloads: DataFrame | None, reference_time,
             store: DataFrame | None = None, max_age_hours: float = 24.0, collected_at: str | None = None,
             checkpoint: bool = False, stages: dict | None = None) -> DataFrame:
    k = job_candidates(json_payloads, feed_payloads, reference_time, max_age_hours, checkpoint, stages)
    return finish(job_details(_new(dedup_first(k, "dedup_key", "ord"), store, stages)), "job", collected_at)


def job_export(tables: dict[str, DataFrame], target_dir: str | None = None) -> DataFrame:
    """Tab projections (written when ``target_dir`` is set) and a (tab, rows) count table."""
    from ..operators.sinks import export_tabs
    tabs = export_tabs(tables, target_dir)
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("tab"), "rows") for t, df in tabs.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def job_metrics(outputs: dict[str, DataFrame], stages: dict[str, dict] | None = None) -> DataFrame:
    """The 13 run counters from the job outputs (and, when given, the stage frames
    each job recorded through ``stages=``).

    Every frame is reduced to a one-row partial count of its own (so each heavy
    branch ends at its own small aggregate and no stage carries the whole job
    graph), the one-row parts are unioned and folded by a final global aggregate.

    discovered: records a job accepted from its source (news and jobs: fresh ones);
    duplicates: valid records beyond the first of their key in this run (not those the store had);
    rejected: validation failures; stale: stale verdicts; entity_matches: resolutions whose
    method is not UNRESOLVED; gemini_429s: provider calls that met a rate limit; llm_fallbacks:
    records answered by a later tier than the first.
    """
    from ..operators.reports import METRIC_NAMES
    parts = []

    def add(kind, df, flag=F.lit(True), status=F.lit("skipped")):
        parts.append(df.agg(F.count(F.lit(1)).alias("n"), F.count_if(flag).alias("f"),
                            F.count_if(status == "attempt").alias("att"),
                            F.count_if(status == "skipped").alias("skp"))
                       .select(F.lit(kind).alias("kind"), "n", "f", "att", "skp"))

    for entity, df in outputs.items():
        cols = set(df.columns)
        status = F.col("extraction_status") if "extraction_status" in cols else F.lit("skipped")
        add("saved" if "unique" in (stages or {}).get(entity, {}) else "saved_all", df, F.lit(entity in ("news", "job")), status)
        if "github_stars" in cols:
            add("stars", df, F.col("github_stars").isNotNull())
    for entity, st in (stages or {}).items():
        for kind in ("discovered", "unique", "stale"):
            if kind in st:
                add(kind, st[kind])
        if "rejected" in st:  # of news and jobs after they were counted as discovered
            add("rejected_late" if entity in ("news", "job") else "rejected", st["rejected"])
        if "extractions" in st:
            add("extraction", st["extractions"], F.col("tier") > 0)
            parts.append(st["extractions"].agg(F.coalesce(F.sum("rate_limited"), F.lit(0)).alias("n")).select(
                F.lit("limited").alias("kind"), "n", *(F.lit(0).cast("long").alias(c) for c in ("f", "att", "skp"))))
        if "resolutions" in st:
            add("resolution", st["resolutions"], F.col("match_method") != "UNRESOLVED")
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)

    def total(kind, col="n"):
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col(col))), F.lit(0))

    def saved_total(col="n"):
        return total("saved", col) + total("saved_all", col)
    saved, discovered = saved_total(), total("discovered")
    unique = total("unique") + total("saved_all")
    m = u.agg(
        discovered.alias("records_discovered"),
        saved.alias("records_processed"),
        (total("rejected") + total("rejected_late")).alias("records_rejected"),
        (discovered - total("rejected_late") - unique if stages else F.lit(0)).alias("duplicates"),
        saved_total("f").alias("fresh_records"),
        total("stale").alias("stale_records"),
        total("resolution", "f").alias("entity_matches"),
        total("stars", "f").alias("github_stars_enriched"),
        (saved - saved_total("att")).alias("deterministic_extractions"),
        saved_total("att").alias("llm_extractions_attempted"),
        saved_total("skp").alias("llm_extractions_skipped"),
        total("limited").alias("gemini_429s"), total("extraction", "f").alias("llm_fallbacks"))
    return m.select(*[F.col(n).cast("long").alias(n) for n in METRIC_NAMES])
