"""Article texts from pages' own markup, against a brute-force extractor over flat tokens."""
import hashlib
import html as entities
import os
import re

import pytest

from curata.plans.catalog import queries

SF = "/root/testdata/sf0.001"
TOKEN = re.compile(r"<!--.*?-->|<![^>]*>|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>|[^<]+", re.S)
RAW = re.compile(r"(<(script|style)\b[^>]*>).*?(</\2>)", re.S | re.I)
VOID = {"br", "img", "meta", "link", "hr", "input"}
SKIP = {"nav", "footer", "header", "aside", "form", "script", "style", "noscript", "template"}


def brute(page):
    """Every element as (number, tag, open elements), every text piece with its open elements."""
    if page is None:
        return None
    tags, elements, pieces, opened = [], [], [], []
    for m in TOKEN.finditer(RAW.sub(r"\1\3", page)):
        if m["tag"]:
            tag = m["tag"].lower()
            if m["close"]:
                at = [i for i, n in enumerate(opened) if tags[n] == tag]
                opened = opened[:at[-1]] if at else opened
            else:
                tags.append(tag)
                elements.append((len(tags) - 1, tag, tuple(opened)))
                if tag not in VOID:
                    opened = [*opened, len(tags) - 1]
        elif not m[0].startswith("<"):
            pieces.append((entities.unescape(m[0]).strip(), tuple(opened)))
    usable = [e for e in elements if not any(tags[n] in SKIP for n in (*e[2], e[0]))]

    def paragraphs(box, longer_than):
        texts = ["".join(t for t, path in pieces if n in path and not any(tags[x] in SKIP for x in path))
                 for n, tag, path in usable if tag == "p" and (box is None or box in path)]
        return [t for t in texts if len(t) > longer_than]
    for wanted in ("article", "main"):
        box = next((n for n, tag, _ in usable if tag == wanted), None)
        if box is not None and len(text := "\n\n".join(paragraphs(box, 20))) > 200:
            return text
    return "\n\n".join(paragraphs(None, 40))


A, B = "First long paragraph of the page. " * 5, "Second long paragraph of the page. " * 5
PAGES = [
    f"<html><body><article><nav><p>{A}</p></nav><p>{A}</p><p>tiny</p><p>{B}</p></article></body></html>",
    f"<article><p>{'x' * 30}</p></article><main><p>{A}</p><p>{B}</p></main>",          # short article: main
    f"<div><p>{A}</p></div><p>{B}</p><footer><p>{A}</p></footer><p>short one</p>",      # no container
    f"<main><p>{A}<p>{B}",                                                             # nothing closed
    f"</div><article><p>{A}</b></p><!-- <p>{B}</p> --><p>{B} &amp; more</p></section>",  # stray closing tags
    f"<style>p{{x}}</style><script>var t='</p><article>';</script><p>{A}</p>",
    "no markup at all", "", None, "<p>short</p>",
]


def _digest(t):
    return (None, None) if t is None else (len(t), hashlib.sha256(t.encode()).hexdigest())


def _save(spark, path, htmls):
    rows = [(i, f"http://p/{i % 7}", h) for i, h in enumerate(htmls)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    return rows


def test_every_path_of_the_extractor(spark, tmp_path):
    _save(spark, tmp_path, PAGES)
    got = {r.page_id: (r.text_len, r.text_sha256) for r in queries()["article_text_pages"](spark, str(tmp_path)).collect()}
    assert got == {i: _digest(brute(h)) for i, h in enumerate(PAGES)}
    assert brute(PAGES[0]) == f"{A.strip()}\n\n{B.strip()}" and brute(PAGES[2]) == f"{A.strip()}\n\n{B.strip()}"


def test_stories_take_the_last_page_of_their_url(spark, tmp_path):
    rows = _save(spark, tmp_path, PAGES)
    last = {}
    for _, url, h in rows:
        last[url] = h if h is not None else last.get(url)
    want = {f"Story {i}": t if len(t := brute(last[u]) or "") > 100 else "Short summary." for i, u, _ in rows}
    assert {r.title: r.content for r in queries()["enrich_article_pages"](spark, str(tmp_path)).collect()} == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_whole_pages_table(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = {r.page_id: (r.text_len, r.text_sha256) for r in queries()["article_text_pages"](spark, SF).collect()}
    assert got == {i: _digest(brute(h)) for i, h in pages.items()}
