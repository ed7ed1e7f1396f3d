"""Operator 3, license scans: MinHash bands over overlapping windows, then exact containment.

Texts and templates become lower-case ASCII words and 2-word shingles.  A window is
``WINDOW`` words; templates contribute every window (stride 1), texts one every ``STRIDE``
words, so a copied notice always has a text window that one template window covers but
for its ends.  A window's signature is one MinHash per band; an equal band retrieves the
template.  With the settings below a window that shares half of its shingles with a
template window (the worst alignment of the shortest, 5-word notice) collides with
probability 1 - 0.5^10 > 0.999 (:func:`collision_probability`), an exact one always.
Each retrieved place is then verified exactly: the share of the template's shingles
found in the words around it.  Only DataFrame expressions are used.
"""
from __future__ import annotations

import hashlib
import json
from functools import reduce
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import let, materialize

WINDOW, STRIDE, BANDS, ROWS = 6, 3, 10, 1
#: Bytes of template text that are broadcast to every task at once; more are scanned in blocks.
BLOCK_BYTES = 1 << 20

# Identifiers of an SPDX line, and the Creative Commons variants with their names.
SPDX_IDS = ["MIT", "Apache-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only",
            "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0",
            "EPL-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Unlicense", "Zlib", "BSL-1.0", "CC0-1.0", "0BSD", "CC-BY-4.0",
            "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-NC-SA-4.0", "CC-BY-ND-4.0", "CC-BY-NC-ND-4.0"]
CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
      "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-ND": "Attribution-NoDerivatives",
      "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}


def template_rows() -> list[tuple[str, str, str | None]]:
    """(license_id, text, key): the shipped notices, headers and full texts, the Creative Commons forms and SPDX lines."""
    shipped = resources.files(__package__).joinpath("license_templates.jsonl").read_text("utf-8")
    rows = [(r["license_id"], r["text"], r.get("key")) for r in map(json.loads, shipped.splitlines())]
    for version in ("4.0", "3.0"):
        form = "International" if version == "4.0" else "Unported"
        for short, name in CC.items():
            own = f"cc-{short.lower()}-{version}"
            rows += [(own, f"Licensed under CC {short} {version}.", f"CC {short} {version}"),
                     (own, f"This work is licensed under a Creative Commons {name} {version} {form} License.",
                      f"Creative Commons {name} {version}")]
    for x in SPDX_IDS:
        own = x.lower().removesuffix("-only").removesuffix("-or-later")
        rows.append((own, f"SPDX-License-Identifier: {x}", f"Identifier: {x}"))
    return rows


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(template_rows(), "license_id string, text string, key string")


def collision_probability(jaccard: float, bands: int = BANDS, rows: int = ROWS) -> float:
    """Chance that two windows of the given similarity share a band."""
    return 1 - (1 - jaccard ** rows) ** bands


def shingles(text: Column) -> Column:
    """64-bit hashes of the 2-word shingles in order; fewer than two words: none."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), "")
    return let(words, lambda w: F.when(F.size(w) < 2, F.array().cast("array<long>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1)))))


def windows(df: DataFrame, stride: int, window: int = WINDOW) -> DataFrame:
    """One row per window start (a shingle index) of ``df.hashes``."""
    last = F.greatest(F.size("hashes") - (window - 1), F.lit(0))
    starts = F.sequence(F.lit(0), F.ceil(last / stride).cast("int") * stride, F.lit(stride))
    return df.filter(F.size("hashes") > 0).select("*", F.explode(starts).alias("start")) \
        .filter(F.col("start") < F.size("hashes"))


def with_band_keys(df: DataFrame, window: int = WINDOW, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per band with its key ``band`` for the window at ``start``, from ``rows`` minima
    over the window's shingles under different hash functions.  (The bands are rows before
    they are hashed: all of them in one expression took seven times the CPU time, presumably a method too long for the JIT.)"""
    seeds = [int.from_bytes(hashlib.sha256(f"band {k}".encode()).digest()[:8], "big", signed=True)
             for k in range(bands * rows)]
    per_band = F.array(*(F.array(*(F.lit(x) for x in seeds[b * rows:(b + 1) * rows])) for b in range(bands)))
    first = F.get("hashes", F.col("start"))
    own = [F.coalesce(F.get("hashes", F.col("start") + j), first) for j in range(window - 1)]
    minima = [F.least(*(F.xxhash64(h.bitwiseXOR(F.get("seeds", F.lit(r)))) for h in own)) for r in range(rows)]
    return df.select("*", F.explode(per_band).alias("seeds")).select(
        *df.columns, (minima[0] if rows == 1 else F.xxhash64(*minima)).alias("band"))


def scan_licenses(df: DataFrame, templates: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                  min_containment: float = 0.8) -> DataFrame:
    """(doc_id, license_id, containment, n_hits, first_word) of every template found.

    ``templates``: (license_id, text) and, if there, key: words of the text that must all stand there,
    in order and unchanged, so that siblings are told apart (CC BY from CC BY-NC).  A license may have
    several templates.  ``containment``: best share of a template's distinct shingles among the
    text's shingles around a retrieved place; ``n_hits``: retrieved places that verified;
    ``first_word``: about where the first one starts.  Templates are broadcast in blocks of
    ``BLOCK_BYTES`` (and one template more at most); each block is one pass over the texts.
    Null, empty and one-word texts match nothing, and so do templates of one word.
    Rows that share an id are scanned each and reported together; a null id is an id.
    Other columns are not read.  Empty tables: no rows.
    """
    spark = df.sparkSession
    own = templates if templates is not None else notices(spark)
    own = own.select("license_id", F.col("text").alias("t"),
                     F.col("key") if "key" in own.columns else F.lit(None).cast("string").alias("key")).distinct()
    # templates are numbered and cut into blocks by their running size
    order = Window.orderBy("license_id", "t", "key")
    own = materialize(own.select(
        "license_id", F.row_number().over(order).alias("template"), F.floor(
            (F.sum(F.octet_length("t")).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.octet_length("t"))
            / BLOCK_BYTES).alias("block"), shingles(F.col("t")).alias("hashes"), shingles(F.col("key")).alias("key_set")),
        "templates")
    blocks = (own.agg(F.max("block")).first()[0] or 0) + 1
    # the one-element explode keeps filters on the hashes from being pushed below and
    # hashing every text once more for each of them
    texts = df.select(F.col(id_col).alias("doc_id"), F.explode(F.array(shingles(F.col(text_col)))).alias("hashes"))
    hits = [_hits(texts, own if blocks == 1 else own.filter(F.col("block") == b), min_containment) for b in range(blocks)]
    return (reduce(DataFrame.unionAll, hits)
            .groupBy("doc_id", "license_id")
            .agg(F.max("share").alias("containment"), F.count(F.lit(1)).alias("n_hits"),
                 F.min("at").alias("first_word")))


def _hits(texts: DataFrame, own: DataFrame, min_containment: float) -> DataFrame:
    """(doc_id, license_id, at, share) of every verified place for one block of templates."""
    keyed = with_band_keys(windows(own.select("template", "hashes"), 1)) \
        .select("template", F.col("start").alias("t_start"), "band").distinct()
    sets = own.select("template", "license_id", F.array_distinct("hashes").alias("t_set"),
                      F.size("hashes").alias("t_size"), "key_set")
    found = (with_band_keys(windows(texts, STRIDE)).select("doc_id", "hashes", "start", "band")
             .join(F.broadcast(keyed), "band").join(F.broadcast(sets), "template"))
    slack = F.ceil(F.col("t_size") * 0.2).cast("int") + STRIDE
    base = F.col("start") - F.col("t_start")
    low = F.greatest(base - slack, F.lit(0))
    around = F.slice("hashes", low + 1, base + F.col("t_size") + slack - low)
    share = F.size(F.array_intersect("t_set", around)) / F.size("t_set")
    return found.select("doc_id", "license_id", F.greatest(base, F.lit(0)).cast("long").alias("at"), share.alias("share"),
                        F.size(F.array_except("key_set", around)).alias("missing")) \
        .filter((F.col("share") >= min_containment) & (F.col("missing") == 0)).drop("missing")
