"""Enrichment joins (repo stars, listing readmes, article pages, canonical names).

All are left equi-joins.  The small side is never force-broadcast: AQE turns a
join into a broadcast only from the runtime size of the built side, so a star
snapshot or page table that grows with the data falls back to a shuffle join.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import PRODUCT_URL_PREFIX, parse_owner_repo
from .dedup import dedup_seen

# --- fixed values -----------------------------------------------------------
README_MIN_CHARS = 50        # a readme is kept only when longer than this
ARTICLE_MIN_CHARS = 100      # extracted article text replaces the summary above this
# ---------------------------------------------------------------------------


def enrich_stars(papers: DataFrame, stars: DataFrame, url: str = "github_repository_url") -> DataFrame:
    """papers ⟕ stars(owner, repo, stars) on the (owner, repo) parsed from the repo URL."""
    p = papers.withColumn("_or", parse_owner_repo(url)) \
              .withColumn("_owner", F.col("_or.owner")).withColumn("_repo", F.col("_or.repo")).drop("_or")
    s = stars.select(F.col("owner").alias("_owner"), F.col("repo").alias("_repo"), F.col("stars").alias("_stars"))
    s = s.groupBy("_owner", "_repo").agg(F.max("_stars").alias("_stars"))   # one deterministic count per repo
    # papers without a repository go around the join: their null key would be one hot partition
    linked = p.filter(F.col("_owner").isNotNull()).join(s, ["_owner", "_repo"], "left")
    j = linked.unionByName(p.filter(F.col("_owner").isNull()).withColumn("_stars", F.lit(None).cast(s.schema["_stars"].dataType)))
    cols = [c for c in papers.columns if c != "github_stars"]
    return j.select(*cols, F.coalesce(F.col("_stars").try_cast("int"), F.col("github_stars") if "github_stars" in papers.columns
                                      else F.lit(None).cast("int")).alias("github_stars"))


def listing_id_of(source_url: str = "source_url"):
    return F.replace(F.col(source_url), F.lit(PRODUCT_URL_PREFIX), F.lit(""))


def _latest(df: DataFrame, key: str, value: str, fetched_at: str | None) -> DataFrame:
    """(key, value) of the latest copy per key; equal or unknown fetch times go to the greatest value."""
    order = [F.col(fetched_at).alias("_at")] if fetched_at and fetched_at in df.columns else []
    copies = df.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    best = copies.groupBy(key).agg(F.max(F.struct(*order, F.col(value).alias("_v"))).alias("_best"))
    return best.select(key, F.col("_best._v").alias(value))


def enrich_readme(products: DataFrame, readmes: DataFrame, needs: str = "needs_extraction",
                  fetched_at: str = "fetched_at") -> DataFrame:
    """Rows that need extraction ⟕ readme(listing_id, readme[, fetched_at]); readme kept if > 50 chars.

    A readme landed several times counts once (its latest copy), so the row count never changes.
    Rows that need nothing go around the join.
    """
    r = filter_content(_latest(readmes, "listing_id", "readme", fetched_at), "readme", README_MIN_CHARS) \
        .select(F.col("listing_id").alias("_lid"), F.col("readme"))
    p = products.drop("readme")
    need = F.coalesce(F.col(needs), F.lit(False)) if needs in products.columns else F.lit(True)
    joined = p.filter(need).withColumn("_lid", listing_id_of()).join(r, "_lid", "left").drop("_lid")
    return joined.unionByName(p.filter(~need).withColumn("readme", F.lit(None).cast("string")))


def has_content(text, min_chars: int = ARTICLE_MIN_CHARS) -> Column:
    """More than ``min_chars`` characters; a null text has none."""
    return F.coalesce(F.length(text) > min_chars, F.lit(False))


def filter_content(df: DataFrame, text: str = "content", min_chars: int = ARTICLE_MIN_CHARS) -> DataFrame:
    """Rows whose text is long enough to be content."""
    return df.filter(has_content(text, min_chars))


def enrich_article(news: DataFrame, pages: DataFrame, url: str = "article_url",
                   fetched_at: str = "fetched_at") -> DataFrame:
    """news ⟕ pages(url, html): content = article text if > 100 chars, else summary.

    The page table can be far larger than the fresh news: it is first reduced
    with a semi-join on the news URLs (AQE broadcasts the URL side when its
    runtime size allows), the Python article extractor runs on the matched pages
    only, and the small result is joined back.  A page landed several times counts
    once (the latest ``fetched_at``), so the row count never changes.
    """
    from ..functions.html import article_text
    urls = news.select(F.col(url).alias("_url")).distinct()
    pg = pages.withColumnsRenamed({"url": "_url", "html": "_html"}).join(urls, "_url", "left_semi")
    pg = _latest(pg, "_url", "_html", fetched_at)
    texts = pg.select("_url", article_text(F.col("_html")).alias("_text"))
    j = news.join(texts, news[url] == texts["_url"], "left")
    content = F.when(has_content("_text"), F.col("_text")).otherwise(F.col("summary"))
    cols = [c for c in news.columns if c != "content"]
    return j.select(*cols, content.alias("content"),
                    has_content("_text").alias("content_enriched"))


def attach_canonical(df: DataFrame, name: str, out: str, resolved: DataFrame | None = None) -> DataFrame:
    """Canonical name of ``name`` as column ``out`` (and ``out``_method).

    Without ``resolved`` the resolution runs row by row (broadcast lookups, no
    shuffle); with a distinct-name table ``resolved`` it is joined back.
    """
    if resolved is None:
        from .resolve import resolve_entities
        tmp = f"_{name}_src"
        r = resolve_entities(df.withColumn(tmp, F.col(name)), tmp)
        return (r.withColumnRenamed("canonical_name", out).withColumnRenamed("match_method", f"{out}_method")
                 .drop("confidence", tmp))
    r = resolved.select(F.col(name).alias("_rn"), F.col("canonical_name").alias(out),
                        F.col("match_method").alias(f"{out}_method"))
    return df.join(r, df[name].eqNullSafe(r["_rn"]), "left").drop("_rn")


# Insert-if-absent existence test: rows whose key is not stored.
anti_join_store = dedup_seen
