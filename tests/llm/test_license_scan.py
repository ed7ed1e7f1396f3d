"""Operator 3 against an exact scan of every place of every text."""
import math
import re

from curata.llm import license_scan
from curata.llm.license_scan import collision_probability, scan_licenses, template_rows

ROWS = [(name, text, key) for name, text, key in template_rows()]


def pairs(text):
    w = [x for x in re.split("[^a-z0-9]+", (text or "").lower()) if x]
    return list(zip(w, w[1:], strict=False))


def brute(text):
    """Licenses of which a template has 80 % of its shingles within a stretch of its length, its key near it."""
    have, found = pairs(text), set()
    for name, t, key in ROWS:
        want, must = set(pairs(t)), set(pairs(key))
        if len(want & set(have)) < 0.8 * len(want):
            continue
        n = len(pairs(t))
        slack = math.ceil(0.2 * n) + 3
        if any(len(want & set(have[i:i + n])) >= 0.8 * len(want) and must <= set(have[max(0, i - slack):i + n + slack])
               for i in range(max(1, len(have)))):
            found.add(name)
    return found


def got(df):
    out = {}
    for r in scan_licenses(df).collect():
        out.setdefault(r.doc_id, set()).add(r.license_id)
    return out


def test_settings_guarantee_retrieval():
    assert collision_probability(0.5) >= 0.999 and collision_probability(1.0) == 1.0


def test_every_alignment_and_edited_notices(spark):
    filler = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do".split()
    rows, i = [], 0
    for name, notice, key in ROWS:
        for shift in range(8):
            words = notice.split()
            rows.append((i, " ".join(filler[:shift] + words + filler)))
            assert name in brute(rows[-1][1])
            i += 1
            if len(words) >= 12 and not key:
                words[len(words) // 2] = "changed"
                rows.append((i, " ".join(filler[:shift] + words + filler)))
                i += 1
    rows += [(i + 1, "under the license of the the license under"), (i + 2, "MIT"), (i + 3, None), (i + 4, "")]
    want = {k: v for k, v in ((r[0], brute(r[1])) for r in rows) if v}
    assert got(spark.createDataFrame(rows, "doc_id long, text string")) == want


def test_documents(documents, document_rows):
    assert got(documents) == {r[0]: b for r in document_rows if (b := brute(r[1]))}


def test_hostile_and_empty(hostile, no_rows):
    assert got(hostile) == {15: {"mit"}}
    assert scan_licenses(no_rows).collect() == []


def test_common_notices_and_their_siblings(spark):
    texts = {"SPDX-License-Identifier: GPL-2.0-or-later": {"gpl-2.0"}, "// SPDX-License-Identifier: MIT\nint x;": {"mit"},
             "All of it is licensed under CC BY 4.0.": {"cc-by-4.0"}, "Licensed under CC BY-SA 4.0.": {"cc-by-sa-4.0"},
             "Licensed under CC BY-NC-SA 4.0.": {"cc-by-nc-sa-4.0"}, "Licensed under CC BY-NC 4.0.": {"cc-by-nc-4.0"},
             "SPDX-License-Identifier: CC-BY-SA-4.0": {"cc-by-sa-4.0"},
             next(t for n, t, _ in ROWS if n == "lgpl-2.1"): {"lgpl-2.1"},
             next(t for n, t, _ in ROWS if n == "agpl-3.0"): {"agpl-3.0"},
             "This is licensed by hand, version 3.": set(), "Released under the table.": set()}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = got(df)
    for i, (text, want) in enumerate(texts.items()):
        assert found.get(i, set()) >= want and not {x for x in found.get(i, set()) if x.startswith("cc")} - want, text
        assert bool(found.get(i)) == bool(want)


def test_own_templates_in_blocks(spark, monkeypatch):
    """Templates without a key column; a block holds about two of them."""
    own = [(f"own-{i}", f"notice number {i} of the house of letters may be printed by anyone who owns press {i}") for i in range(9)]
    monkeypatch.setattr(license_scan, "BLOCK_BYTES", 150)
    df = spark.createDataFrame([(i, "so. " + t) for i, (_, t) in enumerate(own)] + [(99, "nothing here")], "doc_id long, text string")
    out = scan_licenses(df, spark.createDataFrame(own, "license_id string, text string"), min_containment=1.0).collect()
    assert {(r.doc_id, r.license_id) for r in out} == {(i, n) for i, (n, _) in enumerate(own)}
