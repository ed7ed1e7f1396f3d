import random

from hypothesis import given, settings
from hypothesis import strategies as st

from curata.functions.fuzzy import best_match, lcs_length, sort_tokens, token_sort_ratio
from curata.operators.resolve import SEED_ENTITIES, resolve_entities


def _lcs_dp(a, b):
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b, 1):
            cur.append(prev[j - 1] + 1 if ca == cb else max(prev[j], cur[j - 1]))
        prev = cur
    return prev[-1]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcAB .&ñ", max_size=25), st.text(alphabet="abcAB .&ñ", max_size=25))
def test_bit_parallel_lcs_matches_dp(a, b):
    assert lcs_length(a, b) == _lcs_dp(a, b)


def test_best_match_pruning_is_lossless():
    rnd = random.Random(7)
    prepared = [sort_tokens(s) for s in SEED_ENTITIES]
    for _ in range(300):
        name = "".join(rnd.choice("abcdefgh AIOpen") for _ in range(rnd.randint(1, 18)))
        scores = [token_sort_ratio(name, s) for s in SEED_ENTITIES]
        best = max(scores)
        assert best_match(name, prepared) == (scores.index(best), best)


def _resolve(spark, names, threshold=85.0):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, raw_name string")
    rows = resolve_entities(df, "raw_name", threshold=threshold).orderBy("i").collect()
    return [(r.canonical_name, r.match_method, r.confidence) for r in rows]


def test_resolution_cascade(spark):
    got = _resolve(spark, ["OpenAI", "HuggingFace", "Stability.ai", "Unknown Random AI Startup XYZ", "  ",
                           None, "OpenAI, Inc.", "AI Mistral"])
    assert got[0] == ("OpenAI", "EXACT", 100.0)
    assert got[1] == ("Hugging Face", "ALIAS", 100.0)
    assert got[2][0] == "Stability AI" and got[2][2] >= 85
    assert got[4] == ("Unresolved", "NONE", 0.0)
    assert got[5] == ("Unresolved", "NONE", 0.0)
    assert got[6] == ("OpenAI", "EXACT", 100.0)
    assert got[7] == ("Mistral AI", "FUZZY", 100.0)


def test_unresolved_keeps_name(spark):
    got = _resolve(spark, ["Unknown Random AI Startup XYZ"], threshold=90.0)
    assert got[0][0] == "Unknown Random AI Startup XYZ" and got[0][1] == "UNRESOLVED"
    assert 0 < got[0][2] < 90
