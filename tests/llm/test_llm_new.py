"""Importance resampling, page text and whitening against plain versions and on edge cases."""

import hashlib
import html
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from keelson.llm import importance, page_text, whitening
from keelson.llm import textkit as tk

from . import brute

# ---- importance resampling ----------------------------------------------------------------


def plain_features(text, max_n, buckets):
    ws = brute.ALNUM.findall(brute.lower(text))
    return ws, [crc32(" ".join(ws[i:i + n]).encode()) % buckets for n in range(1, max_n + 1) for i in range(len(ws) - n + 1)]


def plain_scores(docs, target, max_n, buckets, seed=2024):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(plain_features(text, max_n, buckets)[1])
    for text in target:
        t.update(plain_features(text, max_n, buckets)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in {*s, *t}}
    out = []
    for d, text in docs:
        ws, found = plain_features(text, max_n, buckets)
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        out.append((d, len(ws), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32)))))
    return out


def plain_ranks(scores, percent=10, min_words=20):
    able = [s for s in scores if s[1] >= min_words]
    able.sort(key=lambda s: (-s[4], s[0] is not None, s[0]))
    return [(s[0], s[4], i + 1) for i, s in enumerate(able[:len(able) * percent // 100])]


@pytest.mark.parametrize("max_n", [1, 3])
def test_importance_matches_its_plain_version(spark, edge, edge_rows, monkeypatch, max_n):
    monkeypatch.setattr(importance, "BLOCK_WORDS", 1000)       # long texts span blocks
    target = [edge_rows[0][1], None, "", edge_rows[5][1]]
    features = importance.Features(max_n, 1000)
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.importance_scores(edge, frame, features=features).select("doc_id", "importance.*", "quality")
    key = lambda r: tuple((x is not None, x) for x in r)
    want = plain_scores(edge_rows, target, max_n, 1000)
    rows = got.collect()
    assert sorted((tuple(r)[:5] for r in rows), key=key) == sorted(want, key=key)
    assert {r["quality"] for r in rows} == {"q"}               # other columns stay
    drawn = importance.with_ranks(importance.importance_scores(edge, frame, features=features), percent=30)
    ranks = sorted(((r["doc_id"], r["importance"]["score"], r["rank"]) for r in drawn.collect() if r["rank"]), key=lambda r: r[2])
    wanted = plain_ranks(want, 30)
    assert drawn.count() == len(edge_rows) and [r[1:] for r in ranks] == [r[1:] for r in wanted]
    assert sorted(ranks, key=key) == sorted(wanted, key=key)


def test_runs_never_cross_texts_or_separators():
    texts = ["a b", "c", "", None, "d\x00e f", "g"]
    chunk = next(tk.chunks(pa.array(texts)))
    got = Counter((int(r), n) for n, rows, _ in importance.Features(2, 50).of(chunk) for r in rows)
    assert got == Counter({(0, 1): 2, (0, 2): 1, (1, 1): 1, (4, 1): 3, (4, 2): 2, (5, 1): 1})


def test_importance_on_empty_tables(spark, edge, empty):
    none = spark.createDataFrame([], "text string")
    assert importance.with_ranks(importance.importance_scores(empty, none)).count() == 0
    scored = importance.importance_scores(edge, none)
    assert scored.count() == edge.count()
    assert importance.with_ranks(scored, min_words=10 ** 9).filter("rank is not null").count() == 0


def test_resample_returns_documents(spark, edge, edge_rows):
    target = spark.createDataFrame([(edge_rows[0][1],)], "text string")
    out = importance.resample(edge, target, percent=50)
    assert out.columns == edge.columns and out.count() == sum(len(brute.ALNUM.findall(brute.lower(t))) >= 20 for _, t in edge_rows) // 2


# ---- page text ------------------------------------------------------------------------------

LONG = "Some words of running text that go on for a while, with commas, and end here."
SHELL = ('<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>'
         '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><div class="ad">Buy now, it is cheap. {0}</div>'
         '{1}<footer>&copy; all of us. {0}</footer></body></html>').format
PAGES = {
    "article": (SHELL(LONG, f"<article><h1>Head</h1><p>{LONG}</p><p>Is.</p></article>"), f"Head {LONG} Is."),
    "one word article": (SHELL(LONG, "<article><h1>Head</h1><p>Is.</p></article>"), "Head Is."),
    "open tags": (SHELL(LONG, f"<article><h1>Head</h1><p><b>{LONG}<br><p>Next &amp; last</article>"), f"Head {LONG} Next & last"),
    "no marks": (f'<div id="x"><a href="1">Home</a> <a href="2">News</a> <a href="3">Shop</a></div><div id="y"><h1>Head</h1><p>{LONG}</p>'
                 f'<p>{LONG}</p><p>End.</p></div><div id="z">2024 Company</div>', f"Head {LONG} {LONG} End."),
    "sections": (f'<div class="c"><h1>Head</h1><section><h2>One</h2><p>{LONG}</p><p>{LONG}</p></section><section><h2>Two</h2><p>{LONG}</p></section>'
                 '</div><div><ul><li><a href="1">Story</a></li><li><a href="2">Other story</a></li></ul></div>', f"Head One {LONG} {LONG} Two {LONG}"),
    "comments": (f'<main><article><h1>Head</h1><p>{LONG}</p><div class="share-bar">Share</div><p>Last.</p></article><section id="comments">'
                 f'<article class="comment"><p>{LONG * 9}</p></article></section></main>', f"Head {LONG} Last."),
    "comments by heading": (f"<article><h1>Head</h1><p>{LONG}</p><h2>3 Comments</h2><p>{LONG}</p></article>", f"Head {LONG}"),
    "inside": (f'<article><header><h1>Head</h1></header><p>{LONG}</p><aside>Side</aside><form>Mail <input><button>Go</button></form><figure>'
               '<figcaption>A picture</figcaption></figure><table><tr><td>a<td>b<tr><td>c</table><div style="display: none">No</div>'
               '<ul><li><a href="1">More</a><li><a href="2">Stories</a></ul><noscript>Turn it on</noscript></article>', f"Head {LONG} A picture a b c"),
    "notice": (f'<div class="cookie-consent"><p>{LONG}</p><p>{LONG}</p></div><div class="with-sidebar"><h1>Head</h1><p>{LONG}</p><p>{LONG}</p></div>',
               f"Head {LONG} {LONG}"),
    "form around all": (f'<form id="f"><div class="header">Logo</div><div class="text"><h1>Head</h1><p>{LONG}</p><p>{LONG}</p></div></form>',
                        f"Head {LONG} {LONG}"),
    "inline and references": ("<p>fo<b>o</b>b&aacute;r &#8217;&nbsp;z<br>a &lt; b < c</p><!-- x <p>no -->tail", "foobár ’ z a < b < c tail"),
    "unclosed comment": ("<p>a</p><!-- b <p>c", "a"), "unclosed tag": ("<p>a</p><p class='b", "a"), "blank": (" \n ", ""), "none": (None, ""),
}


@pytest.mark.parametrize("name", PAGES)
def test_page(name):
    source, want = PAGES[name]
    assert page_text.main_text(source) == want


def test_pages_match_the_marked_article(spark, sf_dir):
    rows = page_text.page_texts(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("html", "main.*").collect()
    for r in rows:
        inner = re.search("<article>(.*)</article>", r["html"], re.S).group(1).replace("<b>", "").replace("</b>", "")
        assert r["text"] == " ".join(html.unescape(re.sub("<[^>]*>", " ", inner)).split()) and r["n_chars"] == len(r["text"])


def test_page_table_edges(spark):
    schema = "page_id long, html string, main string, text string"
    rows = spark.createDataFrame([(1, None, "m", "t"), (1, None, "m", "t"), (None, "<p>ok", "m", "t")], schema)
    out = page_text.page_texts(rows)
    assert sorted((r["main"]["text"], r["main"]["n_chars"], r["text"]) for r in out.collect()) == [("", 0, "t"), ("", 0, "t"), ("ok", 2, "t")]
    assert page_text.page_texts(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("part", ["<div>", "<p>a", "<b>a", "<ul><li>", "<h2>Comments</h2><p>a</p>", "<div><h2>Comments</h2>", "<a b=\"", "&", "<td>"])
def test_long_pages_end(part):
    page = page_text.Page().read(part * 20_000)
    assert len(page.tag) <= 60_001 and page.main_text() is not None


# ---- whitening ------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, component string, other int"


def whole(v):
    return [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]


def test_whitening_matches_plain_linear_algebra(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(0, 0.2, (300, 6)) @ rng.normal(0, 1, (6, 6))
    data = [(i, [float(x) for x in v], "c", 1) for i, v in enumerate(base)]
    data += [(900, data[0][1], "c", 1)] * 40 + [(None, data[1][1], "c", 1), (901, None, "c", 1), (902, [1.0, None, 1.0, 1.0, 1.0, 1.0], "c", 1),
             (903, [math.nan] + [0.0] * 5, "c", 1), (904, [math.inf] + [0.0] * 5, "c", 1), (905, [], "c", 1), (906, [1.0], "c", 1)]
    out = whitening.whiten(spark.createDataFrame(data, VECTORS).repartition(5), 4).collect()
    used = [(d, whole(v)) for d, v, *_ in data if v and len(v) == 6 and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([v for _, v in used])
    n, total = len(x), x.sum(0)
    centred = x - total / n
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    assert len(out) == 4 * n and {r["n"] for r in out} == {n} and {r["other"] for r in out} == {1}
    far = {tuple(v): int(((n * np.array(v, object) - total.astype(object)) ** 2).sum()) for _, v in used}
    by_id = {}
    for r in out:
        by_id.setdefault((r["vec_id"], r["component"]), r)
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / np.trace(cov), rel=1e-9)
        assert r["identity_error"] < 1e-9
    signs = {}
    for (d, v), row in zip(used, centred):
        for k in range(4):
            r = by_id[(d, k + 1)]
            want = row @ axes[:, k] / math.sqrt(values[k])
            signs.setdefault(k, 1.0 if r["whitened"] * want > 0 else -1.0)
            assert r["whitened"] == pytest.approx(signs[k] * want, rel=1e-6, abs=1e-9)
            assert int(r["deviation"]) == far[tuple(v)]


def test_polarised_sums_are_exact_at_any_size():
    y = np.array([[3, -5, 1 << 40], [-(1 << 45), 7, 2]], np.int64)
    rows = [[int(c) for c in r] for r in y]
    want = [sum(r[i] ** 2 for r in rows) for i in range(3)] + [sum((r[i] + r[j]) ** 2 for r in rows) for i, j in ((0, 1), (0, 2), (1, 2))]
    assert whitening.polarised(y) == want
    for v in (*want, -1, -(1 << 90), 0):
        assert sum(x << 32 * k for k, x in enumerate(whitening.limbs(v))) == v
    cov = whitening.covariance(want, 2, [0, 0, 0])              # as if centred already
    assert float(cov[0][1]) * 2 == sum(r[0] * r[1] for r in rows)


@pytest.mark.parametrize("vectors, whitened", [
    ([], set()), ([None, []], set()), ([[1.0, 2.0]], {None}), ([[1.0, 2.0]] * 3, {None}),
    ([[1.0, 2.0], [3.0, 2.0]], {-1.0, 1.0, None}),              # the second dimension is constant
    ([[3e38, 0.0], [1.0, 2.0], [3.0, 2.0]], {-1.0, 1.0, None}),  # no whole number of 64 bits: left out
    ([[1e15, 0.0], [-1e15, 0.0]], {-1.0, 1.0, None}),
])
def test_whitening_edges(spark, vectors, whitened):
    frame = spark.createDataFrame([(i, v, "c", 1) for i, v in enumerate(vectors)], VECTORS)
    out = whitening.whiten(frame, 8).collect()
    assert {None if r["whitened"] is None else round(r["whitened"], 9) for r in out} == whitened
    for r in out:
        assert r["identity_error"] < 1e-6 and (r["deviation"] or 0) >= 0


def test_new_queries_on_small_tables(spark, sf_dir):
    from keelson.llm import queries
    rows = queries.QUERIES["op13_embedding_whitening"](spark, sf_dir).collect()
    assert len(rows) == 8 * 500 and max(r["identity_error"] for r in rows) < 1e-9
    assert all(r["deviation"] == int(r["deviation_exact"]) for r in rows)
    ranks = [r["rank"] for r in queries.QUERIES["op11_importance_resampling"](spark, sf_dir).collect() if r["rank"]]
    assert sorted(ranks) == list(range(1, len(ranks) + 1)) and ranks
