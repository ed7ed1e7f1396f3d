"""Sinks: insert-if-absent into the curated store, the mapping log, tab exports."""
from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .dedup import dedup_first, dedup_seen

# --- fixed values -----------------------------------------------------------
# Export tabs: (display header, source column, rendering rule).
#   "or"   -> value, with null / "" / 0 rendered as ""   (Python ``x or ""``)
#   "opt"  -> value, with null rendered as ""            (``x if x is not None else ""``)
#   "json" -> JSON text of a list, "[]" when null
#   "str"  -> Python ``str(x)``: True / False / None
#   "raw"  -> value as is
TAB_COLUMNS = {
    "Startups": [("ID", "id", "raw"), ("Name", "name", "raw"), ("Canonical Name", "canonical_name", "or"),
                 ("Description", "description", "or"), ("Website URL", "website_url", "or"),
                 ("Source URL", "source_url", "raw"), ("Employee Count", "employee_count", "or"),
                 ("Founding Year", "founding_year", "or"), ("Headquarters", "headquarters", "or"),
                 ("Categories", "categories", "json"), ("Funding Stage", "funding_stage", "or"),
                 ("Collected At", "collected_at", "raw")],
    "Products": [("ID", "id", "raw"), ("Name", "name", "raw"), ("Canonical Name", "canonical_name", "or"),
                 ("Description", "description", "or"), ("Product URL", "product_url", "or"),
                 ("Source URL", "source_url", "raw"), ("Pricing Type", "pricing_type", "or"),
                 ("Pricing Details", "pricing_details", "or"), ("Company Name", "company_name", "or"),
                 ("Categories", "categories", "json"), ("Collected At", "collected_at", "raw")],
    "Research Papers": [("ID", "id", "raw"), ("Title", "title", "raw"), ("Authors", "authors", "json"),
                        ("Paper URL", "paper_url", "raw"), ("Source URL", "source_url", "raw"),
                        ("Abstract", "abstract", "or"), ("Publication Date", "publication_date", "or"),
                        ("GitHub Repo URL", "github_repository_url", "or"), ("GitHub Stars", "github_stars", "opt"),
                        ("Source", "source", "raw"), ("Collected At", "collected_at", "raw")],
    "Jobs": [("ID", "id", "raw"), ("Company Name", "company_name", "raw"),
             ("Canonical Company", "canonical_company_name", "or"), ("Role Title", "role_title", "raw"),
             ("Job URL", "job_url", "raw"), ("Source URL", "source_url", "raw"), ("Location", "location", "or"),
             ("Is Remote", "is_remote", "str"), ("Role Family", "role_family", "or"),
             ("Publication Date", "publication_date", "raw"), ("Freshness Verified", "freshness_verified", "str"),
             ("Source Name", "source_name", "raw"), ("Collected At", "collected_at", "raw")],
    "News": [("ID", "id", "raw"), ("Title", "title", "raw"), ("Article URL", "article_url", "raw"),
             ("Source URL", "source_url", "raw"), ("Author", "author", "or"), ("Summary", "summary", "or"),
             ("Publication Date", "publication_date", "raw"), ("Freshness Verified", "freshness_verified", "str"),
             ("Source Name", "source_name", "raw"), ("Collected At", "collected_at", "raw")],
    "Entity Mapping Log": [("ID", "id", "raw"), ("Raw Name", "raw_name", "raw"),
                           ("Canonical Name", "canonical_name", "raw"), ("Match Method", "match_method", "raw"),
                           ("Confidence (%)", "confidence", "raw"), ("Source URL", "source_url", "opt"),
                           ("Timestamp", "timestamp", "raw")],
}
# ---------------------------------------------------------------------------
_CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def py_json_list(c: Column) -> Column:
    """JSON text of a string list with Python's default separators (", ")."""
    def item(x):
        j = F.to_json(F.array(x))
        return F.substring(j, F.lit(2), F.length(j) - 2)
    return F.when(c.isNotNull(), F.concat(F.lit("["), F.array_join(F.transform(c, item), ", "), F.lit("]")))


def _render(c: Column, rule: str, dtype: str) -> Column:
    s = c.cast("string")
    if rule == "or":
        falsy = c.isNull() | (s == "")
        if dtype in ("int", "bigint", "double", "smallint"):
            falsy = falsy | (c == 0)
        return F.when(falsy, F.lit("")).otherwise(s)
    if rule == "opt":
        return F.coalesce(s, F.lit(""))
    if rule == "json":
        return F.coalesce(py_json_list(c), F.lit("[]"))
    if rule == "str":
        return F.when(c.isNull(), F.lit("None")).when(c, F.lit("True")).otherwise(F.lit("False"))
    return s


def export_tab(df: DataFrame, tab: str) -> DataFrame:
    """Display projection of one tab (headers as column names, all values text)."""
    types = dict(df.dtypes)
    cols = []
    for header, src, rule in TAB_COLUMNS[tab]:
        if src not in types:  # column absent from this table: render the empty value of the rule
            empty = {"json": "[]", "str": "None"}.get(rule, "")
            cols.append(F.lit(empty).alias(header))
            continue
        cols.append(_render(F.col(src), rule, types[src]).alias(header))
    return df.select(*cols)


def export_tabs(tables: dict[str, DataFrame], target_dir: str | None = None) -> dict[str, DataFrame]:
    """Project every tab; with ``target_dir`` replace one CSV folder per tab (one after the other: see
    :func:`publish_tabs`).  Values keep their white space, quotes and line ends."""
    out = {tab: export_tab(df, tab) for tab, df in tables.items()}
    if target_dir:
        for tab, df in out.items():
            df.write.mode("overwrite").options(**_CSV).csv(f"{target_dir}/{_tab_folder(tab)}")
    return out


def _tab_folder(tab: str) -> str:
    return tab.replace(" ", "_")


def publish_tabs(tables: dict[str, DataFrame], target_dir: str) -> None:
    """Replace the export at ``target_dir``, all tabs as one.

    The tabs are written to a folder of their own, and one commit record at the end makes it the
    current version (see :mod:`.store`): readers see all old tabs or all new ones, and a write
    that fails leaves the old version.
    """
    from .store import new_version
    new_version(next(iter(tables.values())).sparkSession, target_dir, lambda folder: export_tabs(tables, folder))


def read_export(spark: SparkSession, target_dir: str) -> dict[str, DataFrame]:
    """The tabs that :func:`publish_tabs` wrote last, all values text ("" where a tab has none)."""
    from .store import current_version
    folder = current_version(spark, target_dir)
    if folder is None:
        return {}
    out = {}
    for tab, columns in TAB_COLUMNS.items():
        schema = ", ".join(f"`{header}` string" for header, _, _ in columns)
        try:
            df = spark.read.schema(schema).options(multiLine=True, **_CSV).csv(f"{folder}/{_tab_folder(tab)}")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue  # a tab that this export does not have
        out[tab] = df.fillna("")
    return out


def insert_if_absent(incoming: DataFrame, store: DataFrame | None, key: str = "dedup_key",
                     order: str = "ord") -> DataFrame:
    """Rows to insert: first row per key within the batch, minus keys already stored."""
    first = dedup_first(incoming, key, order)
    return first if store is None else dedup_seen(first, store, key)


def read_store(spark: SparkSession, store_path: str) -> DataFrame | None:
    """The store, or None before its first write.  Any other failed read (permission,
    network) is raised: taken for an empty store it would insert every key again."""
    try:
        return spark.read.parquet(store_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_new(spark: SparkSession, incoming: DataFrame, store_path: str, key: str = "dedup_key",
              order: str = "ord", partition_by_ingest_date: bool = True) -> int:
    """Append only new keys to the Parquet store at ``store_path``; returns the count saved.

    The store is append-only and (by default) partitioned by ``ingest_date``; each
    run stamps its rows with a ``batch_id`` (provenance), and the saved count is
    read back from the written batch, so the input is evaluated once.  Only the
    key column of the store is read for the anti-join.
    """
    new = insert_if_absent(incoming, read_store(spark, store_path), key, order)
    batch_id, day = spark.range(1).select(F.uuid(), F.current_date()).first()
    out = new.withColumns({"batch_id": F.lit(batch_id), "ingest_date": F.lit(day)})
    w = out.write.mode("append")
    if partition_by_ingest_date:
        w = w.partitionBy("ingest_date")
    w.parquet(store_path)
    # the partition column first: only today's folder is read for the count
    return spark.read.parquet(store_path).filter((F.col("ingest_date") == F.lit(day))
                                                 & (F.col("batch_id") == batch_id)).count()


def append_mapping_log(log: DataFrame, path: str) -> None:
    """Append every resolution row (no dedup)."""
    log.write.mode("append").parquet(path)


def write_bucketed_store(df: DataFrame, table_name: str, buckets: int, key: str = "dedup_key",
                         mode: str = "append") -> None:
    """Write the curated store as a table bucketed (and sorted) by ``key``.

    With the store bucketed, the insert-if-absent anti-join reads the stored keys
    in bucket order without an exchange; only the (much smaller) incoming batch is
    shuffled into the same number of partitions.
    """
    (df.write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(table_name))


def new_rows_vs_bucketed_store(spark: SparkSession, incoming: DataFrame, table_name: str,
                               key: str = "dedup_key", order: str = "ord") -> DataFrame:
    """insert_if_absent against a bucketed store table (see :func:`write_bucketed_store`)."""
    store = spark.table(table_name).select(key)
    return insert_if_absent(incoming, store, key, order)
