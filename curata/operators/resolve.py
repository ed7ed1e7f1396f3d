"""Entity resolution: exact -> alias -> fuzzy (token-sort) -> unresolved.

``resolve_entities`` works row by row without any shuffle: the exact and alias
lookups are broadcast hash joins against the seed and alias tables (fixed
lists, broadcast only below a checked size), and the fuzzy scorer is an Arrow
UDF that only scores rows left unresolved and memoises per task, so a hot name
holding a third of the rows is scored once per task.  ``resolve_names`` gives
the same answer per distinct name (a shuffle on the name) for audit tables.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fuzzy import best_match_udf
from ..functions.rules import normalize_name
from ..functions.strings import is_blank, py_strip

# --- fixed values -----------------------------------------------------------
# Seed canonical entities, in list order (ties in fuzzy scoring keep the first).
SEED_ENTITIES = [
    "OpenAI", "Anthropic", "Google DeepMind", "Meta AI", "Microsoft AI",
    "Mistral AI", "Cohere", "Scale AI", "Hugging Face", "Perplexity AI",
    "Stability AI", "Midjourney", "Runway", "ElevenLabs", "Pinecone",
    "Weaviate", "Qdrant", "Chroma", "LangChain", "LlamaIndex",
    "Anyscale", "Together AI", "Groq", "Cerebras", "SambaNova",
    "Modal", "Baseten", "Replicate", "Fireworks AI", "Databricks",
    "Snowflake", "Weights & Biases", "Neptune.ai", "Comet", "Vellum",
    "Portkey", "Humanloop", "Honeyhive", "Braintrust", "PromptLayer",
    "Helicone", "Arize AI", "Arthur AI", "Cleanlab", "Supervisely",
    "Roboflow", "Labelbox", "V7 Labs", "Appen", "DeepL",
]
# Alias key (already normalised form) -> canonical entity.
KNOWN_ALIASES = {
    "openai": "OpenAI",
    "open ai": "OpenAI",
    "openai inc": "OpenAI",
    "openai, inc.": "OpenAI",
    "anthropic": "Anthropic",
    "anthropic pbc": "Anthropic",
    "deepmind": "Google DeepMind",
    "google deepmind": "Google DeepMind",
    "deepmind technologies": "Google DeepMind",
    "meta ai": "Meta AI",
    "meta ai research": "Meta AI",
    "fair": "Meta AI",
    "microsoft ai": "Microsoft AI",
    "mistral": "Mistral AI",
    "mistral ai": "Mistral AI",
    "huggingface": "Hugging Face",
    "hugging face": "Hugging Face",
    "perplexity": "Perplexity AI",
    "perplexity ai": "Perplexity AI",
    "stability": "Stability AI",
    "stability ai": "Stability AI",
    "stability.ai": "Stability AI",
    "runwayml": "Runway",
    "runway research": "Runway",
    "eleven labs": "ElevenLabs",
    "wandb": "Weights & Biases",
    "weights and biases": "Weights & Biases",
}
DEFAULT_THRESHOLD = 85.0
UNRESOLVED_BLANK = "Unresolved"
# ---------------------------------------------------------------------------

BROADCAST_MAX_ENTRIES = 100_000   # lookup lists above this are joined without a hint


def _maybe_broadcast(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= BROADCAST_MAX_ENTRIES else df


def seed_lookup(spark: SparkSession, seeds=None) -> DataFrame:
    """(norm, exact_canonical): for equal normal forms the later seed wins."""
    seeds = list(seeds or SEED_ENTITIES)
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seeds)], "seed_pos int, seed string")
    df = df.withColumn("norm", normalize_name("seed"))
    return (df.groupBy("norm").agg(F.max_by("seed", "seed_pos").alias("exact_canonical")))


def alias_lookup(spark: SparkSession, aliases=None) -> DataFrame:
    aliases = dict(aliases or KNOWN_ALIASES)
    return spark.createDataFrame(list(aliases.items()), "norm string, alias_canonical string")


def _resolve_columns(d: DataFrame, name: str, seeds, aliases, threshold: float) -> DataFrame:
    spark = d.sparkSession
    ex = _maybe_broadcast(seed_lookup(spark, seeds).withColumnRenamed("norm", "_norm"), len(seeds))
    al = _maybe_broadcast(alias_lookup(spark, aliases).withColumnRenamed("norm", "_norm"), len(aliases))
    d = (d.withColumns({"_norm": normalize_name(name), "_blank": is_blank(name)})
          .join(ex, "_norm", "left").join(al, "_norm", "left"))
    needs_fuzzy = ~F.col("_blank") & F.col("exact_canonical").isNull() & F.col("alias_canonical").isNull()
    seed_arr = F.array(*[F.lit(s) for s in seeds]) if seeds else F.array().cast("array<string>")
    d = d.withColumn("_m", best_match_udf(seeds)(F.col(name), needs_fuzzy))
    fz_name = F.get(seed_arr, F.col("_m.idx"))
    fz_score = F.col("_m.score")
    fuzzy_ok = F.coalesce(fz_score >= F.lit(float(threshold)), F.lit(False))
    method = (F.when(F.col("_blank"), F.lit("NONE"))
               .when(F.col("exact_canonical").isNotNull(), F.lit("EXACT"))
               .when(F.col("alias_canonical").isNotNull(), F.lit("ALIAS"))
               .when(fuzzy_ok, F.lit("FUZZY"))
               .otherwise(F.lit("UNRESOLVED")))
    canonical = (F.when(F.col("_blank"), F.lit(UNRESOLVED_BLANK))
                  .when(F.col("exact_canonical").isNotNull(), F.col("exact_canonical"))
                  .when(F.col("alias_canonical").isNotNull(), F.col("alias_canonical"))
                  .when(fuzzy_ok, fz_name)
                  .otherwise(py_strip(name)))
    conf = (F.when(F.col("_blank"), F.lit(0.0))
             .when(F.col("exact_canonical").isNotNull() | F.col("alias_canonical").isNotNull(), F.lit(100.0))
             .otherwise(F.coalesce(fz_score, F.lit(0.0))))
    return (d.withColumns({"canonical_name": canonical, "match_method": method, "confidence": conf})
             .drop("_norm", "_blank", "exact_canonical", "alias_canonical", "_m"))


def resolve_names(names: DataFrame, name: str = "raw_name", seeds=None, aliases=None,
                  threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Distinct names -> (name, canonical_name, match_method, confidence)."""
    seeds = list(seeds or SEED_ENTITIES)
    aliases = dict(aliases or KNOWN_ALIASES)
    d = names.select(name).distinct()
    return _resolve_columns(d, name, seeds, aliases, threshold)


def resolve_entities(df: DataFrame, name: str = "raw_name", seeds=None, aliases=None,
                     threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Adds canonical_name, match_method, confidence to every row of ``df`` (no shuffle)."""
    seeds = list(seeds or SEED_ENTITIES)
    aliases = dict(aliases or KNOWN_ALIASES)
    for c in ("canonical_name", "match_method", "confidence"):
        if c in df.columns:
            raise ValueError(f"column {c} already present")
    return _resolve_columns(df, name, seeds, aliases, threshold)


def mapping_log(resolved: DataFrame, name: str = "raw_name", source_url: str | None = "source_url",
                timestamp=None) -> DataFrame:
    """One audit row per resolution call (per occurrence, not per distinct name)."""
    src = F.col(source_url) if source_url else F.lit("")
    ts = F.lit(str(timestamp)) if timestamp is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS+00:00")
    return resolved.select(F.col(name).alias("raw_name"), "canonical_name", "match_method",
                           F.col("confidence").cast("double").alias("confidence"),
                           src.alias("source_url"), ts.alias("timestamp"))


def count_matches(resolved: DataFrame) -> DataFrame:
    """Resolution calls whose method is not UNRESOLVED (blank NONE rows count too)."""
    return resolved.agg(F.count_if(F.col("match_method") != "UNRESOLVED").alias("entity_matches"),
                        F.count(F.lit(1)).alias("resolutions"))
