"""The similarity join against all pairs, and resolution by tables against resolution by lists."""
import random

import pytest
from pyspark.sql import functions as F

from curata.functions.fuzzy import best_match, ratio_sorted, sort_tokens
from curata.operators.fuzzy_join import best_scores, fuzzy_matches, resolve_with_tables
from curata.operators.resolve import KNOWN_ALIASES, SEED_ENTITIES, resolve_entities


def brute(names, seeds, threshold):
    out = {}
    for q in {sort_tokens(n) for n in names}:
        scored = [(-ratio_sorted(q, sort_tokens(s)), i, s) for i, s in enumerate(seeds) if q and sort_tokens(s)]
        if scored and -min(scored)[0] >= threshold:
            out[q] = (min(scored)[2], -min(scored)[0])
    return out


def tables(spark, names, seeds):
    return (spark.createDataFrame([(sort_tokens(n),) for n in names], "q string"),
            spark.createDataFrame(list(enumerate(seeds)), "seed_pos int, seed string"))


def got(df):
    return {r.q: (r.seed, r.score) for r in df.collect()}


def edited(rnd, s, alphabet):
    s = list(s)
    for _ in range(rnd.randint(0, 4)):
        at = rnd.randrange(len(s) + 1)
        if rnd.random() < 0.5 and s:
            s.pop(min(at, len(s) - 1))
        else:
            s.insert(at, rnd.choice(alphabet))
    return "".join(s)


@pytest.mark.parametrize("threshold", [100.0, 85.0, 70.0, 40.0])
def test_no_match_is_lost(spark, threshold):
    rnd = random.Random(int(threshold))
    alphabet = "abcdeé AB."
    seeds = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 14))) for _ in range(150)]
    seeds += ["a", "ab", "aaaaaaa", "aaaaaaaa", "abababab", " ", "a a", "x" * 60, seeds[3]]
    names = [edited(rnd, rnd.choice(seeds), alphabet) for _ in range(200)] + ["", "b", "ba", "aaaaaab", "x" * 51, "zz", "a a"]
    q, s = tables(spark, names, seeds)
    assert got(fuzzy_matches(q, s, threshold)) == brute(names, seeds, threshold)


def test_hundred_thousand_seeds_equal_all_pairs_on_a_sample(spark):
    """Seeds as a table made by Spark; a sample of the names is scored against every one of them."""
    stem = F.concat(F.hex(F.xxhash64("id")), F.lit(" "), F.hex(F.col("id") * 7919 % 10007), F.lit(" Labs"))
    seeds = spark.range(100_000).select(F.col("id").cast("int").alias("seed_pos"), stem.alias("seed"))
    # a character left out, one doubled, tokens turned round, half of the string
    names = seeds.filter("seed_pos % 200 = 0").select("seed_pos", F.expr(
        "case (seed_pos div 200) % 4 when 0 then concat(substr(seed, 1, 5), substr(seed, 7)) "
        "when 1 then concat(substr(seed, 1, 9), substr(seed, 9)) when 2 then array_join(reverse(split(seed, ' ')), ' ') "
        "else substr(seed, 1, 11) end").alias("name"))
    rows = [(r.seed_pos, r.name) for r in names.collect()]
    queries = spark.createDataFrame([(sort_tokens(n),) for _, n in rows], "q string")
    found = got(fuzzy_matches(queries, seeds))
    plan = fuzzy_matches(queries, seeds)._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "Cross" not in plan
    all_seeds = [r.seed for r in seeds.orderBy("seed_pos").collect()]
    prepared = [sort_tokens(s) for s in all_seeds]
    for pos, n in random.Random(5).sample(rows, 12):
        i, score = best_match(sort_tokens(n), prepared)
        assert found.get(sort_tokens(n)) == ((all_seeds[i], score) if score >= 85 else None)
    assert len(found) >= 3 * len(rows) // 4


def test_best_scores_in_passes(spark):
    rnd = random.Random(9)
    names = ["".join(rnd.choice("abc d") for _ in range(rnd.randint(1, 9))) for _ in range(60)]
    q, s = tables(spark, names, SEED_ENTITIES)
    want = {x: max(best_match(x, [sort_tokens(c) for c in SEED_ENTITIES])[1], 0.0) for x in {sort_tokens(n) for n in names}}
    assert {r.q: r.score for r in best_scores(q, s, per_pass=7).collect()} == want
    assert {r.q: r.score for r in best_scores(q, s.limit(0)).collect()} == dict.fromkeys(want, 0.0)


def test_same_as_lists(spark):
    rnd = random.Random(3)
    names = [None, "", "  ", "OpenAI", "openai, inc.", "HuggingFace", "Stability.ai", "Unknown Random AI Startup XYZ", "AI Scale", "Cohere Ltd"]
    names += [edited(rnd, rnd.choice(SEED_ENTITIES), "abcAI .") for _ in range(150)] + ["OpenAI"] * 50
    df = spark.createDataFrame([(i, n, "clash") for i, n in enumerate(names)], "i int, raw_name string, q string")
    seeds = spark.createDataFrame(list(enumerate(SEED_ENTITIES)), "seed_pos int, seed string")
    aliases = spark.createDataFrame(list(KNOWN_ALIASES.items()), "alias string, canonical string")
    cols = ["i", "raw_name", "q", "canonical_name", "match_method", "confidence"]
    for threshold in (85.0,):
        a = resolve_with_tables(df, "raw_name", seeds, aliases, threshold).select(cols)
        b = resolve_entities(df, "raw_name", threshold=threshold).select(cols)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    off = resolve_with_tables(df, "raw_name", seeds, aliases, 85.0, score_unresolved=False)
    assert off.filter("match_method = 'UNRESOLVED' and confidence > 0").count() == 0
    none = resolve_with_tables(df, "raw_name", seeds.limit(0))
    assert {r.match_method for r in none.collect()} == {"NONE", "UNRESOLVED"}
