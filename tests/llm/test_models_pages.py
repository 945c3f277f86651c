"""Classifiers by held-out accuracy, counts and the language model by brute force, pages by
written examples."""

import math
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from rowloom.llm import katz, langid, quality, style_tree, toxicity
from rowloom.llm.common import fold
from rowloom.llm.queries import op4_toxicity, op5_quality, op6_katz, op10_style_tree

SMALL = "/root/testdata/sf0.1"


def accuracy(rows, labels, fn):
    pairs = [(fn(r), labels[r.doc_id]) for r in rows if r.doc_id in labels]
    return sum(a == b for a, b in pairs) / len(pairs)


def test_toxicity_holds_on_rows_not_learned(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    rows = op4_toxicity(spark, SMALL).collect()
    assert len(rows) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert accuracy([r for r in rows if r.held_out], labels, lambda r: r.predicted) > 0.97


def test_quality_holds_on_labelled_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    rows = op5_quality(spark, SMALL).collect()
    passed = [r for r in rows if not r.base_failed]
    assert all(not r.kept for r in rows if r.base_failed)
    assert accuracy(passed, labels, lambda r: int(r.kept)) > 0.97


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {i + k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = len(lines) - len(set(lines))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


def test_base_counts_match_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op5_quality(spark, SF).collect():
        assert tuple(r[c] for c in quality.COUNTS) == plain_counts(texts[r.doc_id])
    for text in ("", " \n\n", "a\na\n a\na", "x\x0by\x1cz é#", "a b c d e a b c d e f", "r " * 40):
        raw = text.encode()
        words = raw.split()
        assert quality.base_counts(raw, words, quality.word_hashes(words)) == plain_counts(text)


def test_models_take_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 1), (8, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for rows in (labels, labels.limit(0)):
        w = toxicity.train(odd_docs, rows)
        scored = toxicity.score(odd_docs, w).collect()
        assert len(scored) == odd_docs.count() and all(0 <= r.score <= 1 for r in scored)
        assert toxicity.accepted(odd_docs, w, threshold=2.0).columns == odd_docs.columns
        m = quality.train(odd_docs, rows)
        assert quality.assess(odd_docs, m).count() == odd_docs.count()
    assert toxicity.score(odd_docs, w).first().score == pytest.approx(0.5)
    assert toxicity.score(no_docs, w).count() == quality.assess(no_docs, m).count() == 0
    assert len(toxicity.train(no_docs, labels).values) == 0


def test_calibration_orders_and_centres():
    rng = np.random.default_rng(2)
    margin = rng.normal(size=4000)
    labels = (rng.random(4000) < 1 / (1 + np.exp(-(2 * margin - 1)))).astype(int)
    slope, offset = quality.calibration(margin, labels)
    assert slope == pytest.approx(2, abs=0.3) and offset == pytest.approx(-1, abs=0.2)
    assert quality.calibration(margin, np.ones(4000, int)) == (1.0, 0.0)


def brute_katz(texts, held):
    tokens = {k: t.encode().lower().split() + [b"\n"] for k, t in texts.items()}
    one, two, docs = Counter(), Counter(), 0
    for k, t in tokens.items():
        if not held(k):
            one.update(t)
            two.update(zip([None, *t], t))
            docs += 1
    size = sum(one.values())

    def discounts(c):
        n = np.bincount([min(v, 7) for v in c.values()] + [0], minlength=8)
        d = katz.good_turing(n)
        return lambda r: d[r] if r <= 5 else 1.0

    d1, d2 = discounts(one), discounts(two)
    left = sum((1 - d1(v)) * v for v in one.values())
    scale, unknown = (1 / size, left / size) if left else (1 / (size + 1), 1 / (size + 1))
    followers = defaultdict(list)
    for h, w in two:
        followers[h].append(w)

    def p1(w):
        return d1(one[w]) * one[w] * scale if one[w] else unknown

    def back(h):
        c = docs if h is None else one[h]
        seen = sum(map(p1, followers[h]))
        free = sum((1 - d2(two[h, w])) * two[h, w] for w in followers[h])
        return (free / c / (1 - seen), c) if free else (1 / (c + 1) / (1 - seen), c + 1)

    def p(h, w):
        if not (docs if h is None else one[h]):
            return p1(w)
        a, c = back(h)
        return d2(two[h, w]) * two[h, w] / c if two[h, w] else a * p1(w)

    return tokens, one, size, p, unknown, followers


def test_language_model_matches_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = lambda k: zlib.crc32(str(k).encode()) % 5 == 1
    tokens, one, size, p, unknown, followers = brute_katz(texts, held)
    rows = op6_katz(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows[::7]:
        t = tokens[r.doc_id]
        base = sum(math.log10((one[w] + 0.5) / (size + 0.5 * (len(one) + 1))) for w in t)
        score = sum(math.log10(p(h, w)) for h, w in zip([None, *t], t))
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(t), sum(one[w] > 0 for w in t), size)
        assert (r.base_score, r.score) == (pytest.approx(base), pytest.approx(score))
    for h in [None, *sorted(followers, key=lambda h: len(followers[h]))[-3:]]:
        assert sum(p(h, w) for w in one) + p(h, b"never seen") == pytest.approx(1)
    kept = [r for r in rows if r.held_out]
    assert sum(r.score for r in kept) > sum(r.base_score for r in kept)


def brute_recursion(texts, held, order):
    """Katz's recursion from plain counts of tuples, for any order."""
    tokens = {k: t.encode().lower().split() + [b"\n"] for k, t in texts.items()}
    grams = [Counter() for _ in range(order + 1)]
    for k, t in tokens.items():
        if not held(k):
            grams[1].update((w,) for w in t)
            for n in range(2, order + 1):
                padded = [None, *t]
                grams[n].update(zip(*[padded[i:] for i in range(n)]))
    d = [None] + [katz.good_turing(np.bincount([min(v, 7) for v in c.values()] + [0], minlength=8)) for c in grams[1:]]
    followers, histories = defaultdict(list), Counter()
    for n in range(2, order + 1):
        for g, c in grams[n].items():
            followers[g[:-1]].append(g[-1])
            histories[g[:-1]] += c
    size = sum(grams[1].values())
    kept = lambda n, c: (d[n][c] if c <= 5 else 1.0) * c
    left = size - sum(kept(1, c) for c in grams[1].values())

    @lru_cache(None)
    def back(h):
        seen = sum(p(h[1:], w) for w in followers[h])
        free = sum(grams[len(h) + 1][h + (w,)] - kept(len(h) + 1, grams[len(h) + 1][h + (w,)]) for w in followers[h])
        return (free / histories[h] / (1 - seen), histories[h]) if free > 1e-9 else (1 / (histories[h] + 1) / (1 - seen), histories[h] + 1)

    @lru_cache(None)
    def p(h, w):
        if not h:
            return kept(1, grams[1][w,]) / size if grams[1][w,] else left / size
        if not histories[h]:
            return p(h[1:], w)
        a, c = back(h)
        found = grams[len(h) + 1][h + (w,)]
        return kept(len(h) + 1, found) / c if found else a * p(h[1:], w)

    return tokens, p, [w for w, in grams[1]], followers


@pytest.mark.parametrize("order", [1, 3, 4])
def test_language_models_of_other_orders_match_the_recursion(spark, order):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    held = lambda k: zlib.crc32(str(k).encode()) % 5 == 1
    tokens, p, words, followers = brute_recursion(texts, held, order)
    rows = katz.score(docs, fold(F.col("doc_id"), 5) == 1, order=order).collect()
    assert len(rows) == len(texts)
    for r in rows[::7]:
        padded = [None, *tokens[r.id]]
        want = sum(math.log10(p(tuple(padded[max(0, i - order + 1) : i]) if order > 1 else (), w)) for i, w in enumerate(padded) if i)
        assert r.score == pytest.approx(want)
    for n in range(1, order):  # every history sums to one
        common = sorted((h for h in followers if len(h) == n), key=lambda h: (len(followers[h]), repr(h)))
        for h in (common[-1], common[len(common) // 2]):
            assert sum(p(h, w) for w in words) + p(h, b"never seen") == pytest.approx(1)


def test_language_model_takes_odd_rows(odd_docs, no_docs):
    got = katz.score(odd_docs, fold(F.col("doc_id"), 5) == 1).collect()
    assert len(got) == odd_docs.count()
    assert all(math.isfinite(r.score) and not (r.id is None and r.held_out) for r in got)
    assert katz.score(no_docs, F.lit(False)).count() == 0
    deep = katz.score(odd_docs, fold(F.col("doc_id"), 5) == 1, order=3).collect()
    assert len(deep) == len(got) and all(math.isfinite(r.score) for r in deep)
    alone = katz.score(odd_docs, F.lit(True)).collect()
    assert {(r.n_known, r.train_tokens, r.score) for r in alone} == {(0, 0, 0.0)}


def test_packed_arrays_come_back():
    for a in (np.arange(5), np.array([-3, 1 << 40]), np.array([0.5, -2.0]), np.empty(0, np.int64)):
        assert katz.unpack(katz.pack(a)).tolist() == a.tolist()
    words = np.sort(np.array([1, 1 << 63, (1 << 64) - 1], np.uint64))
    assert katz.unpack_sorted(katz.pack_sorted(words)).view(np.uint64).tolist() == words.tolist()


def test_languages_of_pages_and_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs)
    texts = langid.text_evidence(docs, model, F.col("source")).drop("url")
    got = langid.fuse(texts, model.languages).collect()
    assert sum(r.language == r.lang for r in got) / len(got) > 0.97
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = langid.fuse(langid.page_evidence(pages, model), model.languages).collect()
    assert sum(r.language == r.url.split("/")[3] for r in got) / len(got) > 0.97


def test_declaration_and_host_decide_where_text_is_silent(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs)
    own = {r.lang: r.text for r in docs.filter(F.length("text") > 500).collect()}
    page = lambda lang, text: f"<html lang='{lang}'><body><p>{text}</p></body></html>"
    rows = [(i, f"http://x.example/{i}", page(lang, own[lang])) for i, lang in enumerate(["de", "fr", "es", "en"] * 5)]
    rows += [(100 + i, f"http://deutsch.example/{i}", page("de", own["de"])) for i in range(9)]
    rows += [(200, "http://deutsch.example/none", page("xx", "")), (201, "http://y.example/", page("fr", "")), (202, None, None)]
    pages = spark.createDataFrame([(*r, "clash", 1.0) for r in rows], "page_id int, url string, html string, host string, vote double")
    got = {r.page_id: r for r in langid.fuse(langid.page_evidence(pages, model), model.languages).collect()}
    assert (got[200].language, got[201].language) == ("de", "fr")
    assert got[202].language in model.languages
    assert langid.fuse(langid.page_evidence(pages.limit(0), model), model.languages).count() == 0
    with pytest.raises(ValueError):
        langid.train(docs.limit(0))


PAGES = [
    ("<html><head><title>x</title><body><p>a<p>b<div class='sidebar'>q</div>c", "a b c"),
    ("<div><header>H</header><p>x<b>y</b>z<br>w &amp; &lt;t&gt;</p><aside>no</aside><form>f</form></div>", "xyz w & <t>"),
    ("<body>out<article><header><h1>T</h1></header>a<footer>f</footer><article class='comment'>c</article></article>", "T a"),
    ("a < b <i>c</i> <script>var x='</p>'</script>d<style>p{}</style>", "a < b c d"),
    ("<ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table>", "a b 1 2 3"),
    ("<main><!-- <p>no</p> --><p>y e\n\ts</p><div id='cookie-notice'>n</div><p hidden>n</p></main>", "y e s"),
    ("<article><p>caf&eacute; &#8364; &amp", "café € &"),
    ("<nav>only<a href=x>menu</a></nav>", ""),
    ("<p", ""),
    ("", ""),
]


@pytest.mark.parametrize("source, text", PAGES)
def test_main_text_of_written_pages(source, text):
    assert style_tree.Page(source).text() == text


LOOSE = [
    ("<div style='overflow:hidden'><p>a</p></div><p><a href='/hidden-gems'>b</a> <a href=/x-hidden title=\"is hidden\">c</a></p>", "a b c"),
    ("<div class='layout with-sidebar'><article><p>a</p></article><div class='sidebar'>q</div></div>", "a"),
    ("<div class='no-sidebar'><p>a</p></div><div class='post-with-comments'>b<div class='comments'>q</div></div>", "a b"),
    ("<article><h2 id='related-work'>R</h2><section id='search-results'>a</section><p id='legal-history'>b</p><h2 id='search'>S</h2></article>", "R a b S"),
    ("<div class='widget'><article>a<div class='share'>q</div></article></div><div class='menu'>q</div>", "a"),
    ("<form id='search'><div>the whole page of a form</div></form><p>b</p>", "the whole page of a form b"),
    ("<article>a</article><div class='comments'>more words than the article has</div>", "a"),
    ("<p>some own text</p><div class='ad ad-300x250'>q</div><div class='site-footer'>q</div><span class='share'>q</span>", "some own text"),
]


LOOSE += [
    ("<div class='story'>" + "A long story. " * 20 + "</div><article>teaser one</article><article>teaser two</article>",
     "A long story. " * 20 + "teaser one teaser two"),
    ("<article><p>a</p><div class='legal'>On law</div><section class='search'>On search</section></article>", "a On law On search"),
    ("<article>a<div class='reader-comments'>q</div><div class='user-replies'>q</div><div class='adbox'>q</div></article>", "a"),
]


@pytest.mark.parametrize("source, text", LOOSE)
def test_names_and_values_cut_no_article(source, text):
    assert style_tree.Page(source).text() == text


def test_articles_of_the_tables(spark):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in op10_style_tree(spark, SF).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        inner = re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", inner))
        assert r.text == " ".join(html.unescape(inner).split())
        assert r.n_chars == len(r.text)


def brute_low(sources):
    """Low branches of one host's pages, by plain sums over pages and texts."""
    pages = {}
    for source in sources:
        page = style_tree.Page(source)
        pages.setdefault(tuple(t for t, _ in page.blocks), page)
    m = len(pages)
    entropy = lambda counts: -sum(c / sum(counts) * math.log(c / sum(counts)) for c in counts) / math.log(m)
    texts, looks, labels, priors = {}, {}, {}, {}
    for page in pages.values():
        for text, e in page.blocks:
            texts.setdefault((e.path, text), Counter())[id(page)] += 1
        nodes = {n for _, e in page.blocks for n in e.path}
        for node in nodes:
            own = [e for e in page.elements if e.path[-1] == node]
            seq = tuple(tuple(c for i, c in enumerate(e.children) if not i or c != e.children[i - 1]) for e in own)
            looks.setdefault(node, Counter())[seq] += 1
            labels[node] = max(labels.get(node, 0), len({c for e in own for c in e.children}))
            priors[node] = own[-1].prior
    low = set()
    for node, n in labels.items():
        inside = [entropy(list(c.values())) for (path, _), c in texts.items() if node in path]
        content = 1 - sum(inside) / len(inside)
        own = (1 - 0.9**n) * entropy(list(looks[node].values())) + 0.9**n * content
        if priors[node] * (own * m + 1) / (m + 1) < style_tree.LEAST:
            low.add(node)
    return low


def test_importance_matches_brute_force(spark):
    """Hosts of the tables and a host of templates; the tree finds low branches on each."""
    from urllib.parse import urlsplit

    hosts = {}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        hosts.setdefault(urlsplit(r.url).netloc.lower(), []).append(r.html)
    hosts = dict(sorted(hosts.items(), key=lambda h: -len(h[1]))[:3])
    page = "<div class='tmpl'>Same words on all pages</div><div class='t{0}'><p>Own {1}</p><ul><li>{0}</ul></div><nav>x{1}</nav>"
    hosts["site.example"] = [page.format(i % 3, f"n{i}") for i in range(24)]
    rows = [(f"http://{h}/{i}", s) for h, own in hosts.items() for i, s in enumerate(own)]
    pages = spark.createDataFrame(rows, "url string, html string")
    got = {r.host: set(r.low) for r in style_tree.low_branches(pages).collect()}
    assert got == {h: brute_low(own) for h, own in hosts.items()}
    assert all(got.values())
    # the template goes by entropy, the navigation by its prior
    text = style_tree.Page(hosts["site.example"][0]).text(got["site.example"])
    assert text == "Own n0 0"


def test_deep_pages_take_time_by_length():
    import time

    start = time.process_time()
    for source in ("<div>x" * 50_000, "<form><p>a<section role=search><b>" * 20_000, "<table><tr><td>y" * 20_000, "</p>" * 50_000):
        page = style_tree.Page(source)
        assert page.text(set()).split() == [t for t, _ in page.blocks]
        style_tree.page_rows(source)
    assert style_tree.Page("<div>" * 100 + "in<nav>menu</nav>" + "<div class=ad>z</div>").text() == "in"
    assert time.process_time() - start < 60


def test_template_branches_are_removed_and_copies_stay(spark):
    page = "<body><div class='tmpl'>Same words on all pages</div><div class='text t{0}'><p>Own text {1} of this page</p><p>Second {1}</p></div></body>"
    rows = [(i, f"http://site.example/{i}", page.format(i % 3, f"n{i}")) for i in range(30)]
    rows += [(100 + i, "http://copies.example/", page.format(1, "same")) for i in range(30)]
    rows += [(200 + i, f"http://few.example/{i}", page.format(1, f"n{i}")) for i in range(3)]
    rows += [(300, None, None), (300, None, None), (301, "odd", "")]
    pages = spark.createDataFrame([(*r, "c", "c") for r in rows], "page_id int, url string, html string, host string, tree_low string")
    found = style_tree.main_text(pages)
    assert found.columns == [*pages.columns, "text"]
    got = {r.page_id: r.text for r in found.collect()}
    assert got[4] == "Own text n4 of this page Second n4"
    assert got[104] == "Same words on all pages Own text same of this page Second same"
    assert got[201].startswith("Same words")
    assert (got[300], got[301], found.count()) == ("", "", len(rows))
    assert style_tree.main_text(pages.limit(0)).count() == 0
