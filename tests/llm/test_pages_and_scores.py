"""URL lists, page extraction and language-model scores against brute force."""

import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
from brute import spaced
from pyspark.sql import functions as F

from tillflow.llm import html_extraction, lm_scoring, url_filter

# --- URL lists


def days(n):
    return datetime(2024, 3, 1) + timedelta(days=n)


ENTRIES = [
    ("block", "domain", "bad.example", "add", days(10)), ("block", "domain", "bad.example", "remove", days(20)), ("block", "domain", "bad.example", "add", days(300)),
    ("block", "domain", "Bad.Example", "add", days(10)),  # again, in other case
    ("allow", "domain", "good.bad.example", "add", days(12)), ("allow", "prefix", "www.bad.example/ok/", "add", days(0)), ("allow", "prefix", "www.bad.example/ok/", "remove", days(15)),
    ("block", "prefix", "site.test/a/b/", "add", days(5)), ("block", "domain", "test", "add", days(40)), ("block", "domain", "test", "remove", days(40)),
    ("block", "domain", "gone.test", "remove", days(1)), (None, "domain", "x.test", "add", days(1)), ("block", "domain", "x.test", "add", None),
]
URLS = ["http://bad.example/", "HTTPS://user:pw@WWW.Bad.Example:8080/ok/page?x=1", "https://good.bad.example./x", "https://site.test/a/b/c", "https://site.test/a/bc", "http://site.test",
        "http://notbad.example/", "https://gone.test/", "mailto:a@b.c", "/relative", "", None, "http://x.test/#f", "http://site.test/a/b"]


def expected(url, at):
    m = re.match(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", (url or "").lower())
    host = m[1].removesuffix(".") if m else ""
    path = re.match(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", url or "")
    full = host + (path[1] if path else "")
    states = defaultdict(list)
    for name, kind, pattern, action, when in ENTRIES:
        if None not in (name, when):
            states[name, kind, pattern.lower() if kind == "domain" else pattern].append((when, action == "add"))
    n = Counter()
    for (name, kind, pattern), dated in states.items():
        match = (host == pattern or host.endswith("." + pattern)) if kind == "domain" else full.startswith(pattern)
        past = [x for x in dated if at and x[0] <= at]
        if host and match and past and max(past)[1]:
            n[name] += 1
    return host, n["block"], n["allow"], n["block"] > 0 and n["allow"] == 0


def test_lists_as_of_the_fetch_time(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(URLS), days(rng.choice([0, 4, 5, 9.9, 10, 12, 14, 15, 19, 20, 39, 40, 41, 300, 400])), "x", 3) for i in range(300)]
    rows += [rows[0], (None, URLS[0], None, "x", 3)]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched_at timestamp, bucket string, pattern int")
    entries = spark.createDataFrame(ENTRIES, "list string, kind string, pattern string, action string, at timestamp")
    out = url_filter.filter_urls(captures, entries)
    assert out.columns == [*captures.columns, "host", "n_block", "n_allow", "blocked"]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(repr((*r, *expected(r[1], r[2]))) for r in rows)
    assert url_filter.filter_urls(captures.limit(0), entries).collect() == []
    assert not any(r.n_block for r in url_filter.filter_urls(captures, entries.limit(0)).collect())


def test_prefixes_that_end_inside_a_path(spark):
    patterns = ["site.test/a", "Site.Test/a/page.html", "site.test/a/pa", "WWW.other.test", "third.test/x/", "third.test/X/"]
    urls = ["http://site.test/a", "http://site.test/ab/c", "http://SITE.test/a/page.html?q", "http://site.test/a/b/page.html", "http://site.test/b/a", "http://site.test/A", "http://site.test",
            "http://www.other.test", "http://www.other.test/x/y", "http://www.other.test.org/", "http://third.test/x/y", "http://third.test/x", "http://sub.site.test/a", "/a", ""]
    entries = spark.createDataFrame([("block", "prefix", x, "add", days(0)) for x in patterns], "list string, kind string, pattern string, action string, at timestamp")
    captures = spark.createDataFrame([(x, days(1)) for x in urls], "url string, fetched_at timestamp")
    got = {r.url: r.n_block for r in url_filter.filter_urls(captures, entries).collect()}
    assert got == dict(zip(urls, [1, 1, 3, 1, 0, 0, 0, 1, 1, 0, 1, 0, 0, 0, 0]))


# --- pages


def text_of(source, template=frozenset()):
    return html_extraction.main_text(html_extraction.parse(source), template)


def test_article_blocks():
    page = """<!DOCTYPE html><html><head><title>T &amp; U</title><style>p{}</style><script>var a="</p><article>";</script></head><body>
    <nav><ul><li><a href="/x">menu</a></li></ul></nav><!-- <p>no</p> --><div class="ad">buy</div><header><h1>Site</h1></header>
    <article class='post'><header><h1>Head&nbsp;line</h1></header><p><b>One &lt;two&gt;<br>three<p>four  \n five<ul><li>a<li>b <i>c</i></ul>
    <aside>side</aside><form><input value="q">ask</form><div class="sidebar x">s</div><div hidden>h</div><section id="comments"><p>me too</section><blockquote>x &eacute;&#233;</blockquote></article>
    <div role="complementary">r</div><footer>&copy; f</footer></body></html>"""
    assert text_of(page) == "Head line\n\nOne <two> three\n\nfour five\n\na\n\nb c\n\nx éé"


def test_pages_without_an_article():
    assert text_of("<p>a<p>b<div>c</div>d") == "a\n\nb\n\nc\n\nd"
    assert text_of("plain &lt; text 1 < 2") == "plain < text 1 < 2"
    assert text_of("<main><p>in</p></main><p>out</p>") == "in"
    assert text_of("<nav>x</nav>") == "" and text_of("<!-- open") == "" and text_of("<script>x") == "" and text_of("") == ""
    assert text_of("<table><tr><td>1<td>2<tr><td>3</table>") == "1\n\n2\n\n3"
    assert len(text_of("<div>" * 30000 + "x" + "</div>" * 30000)) == 1  # deep
    assert text_of("<p>" + "w " * 200000) == " ".join(["w"] * 200000)  # long


def test_site_template_goes(spark):
    page = lambda i, host: f"<body><div class=q1><p>About {host}</p><p>Read all of it</p></div><div class=q2><p>text {i} of this page</p></div></body>"
    rows = [(i, f"http://{h}/p{i}", page(i, h), "x") for h in ("a.example", "b.example") for i in range(20)]
    rows += [(50, "http://c.example/", page(1, "c.example"), "x"), (51, None, None, "x"), (52, "/r", "", "x"), (None, "http://a.example/p1", page(1, "a.example"), "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in html_extraction.extract_main_text(frame).collect()}
    assert len(got) == len(rows)
    for i, url, source, _ in rows:
        own = f"text {1 if i in (50, None) else i} of this page"
        want = "" if not source else own if i != 50 else "About c.example\n\nRead all of it\n\n" + own
        assert got[i, url] == (want, len(want))
    assert html_extraction.extract_main_text(frame.limit(0)).collect() == []


def test_copies_of_an_article_stay(spark):
    """Pages with the same article, or nearly the same, don't make it the site's template."""
    rng = random.Random(4)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    base = [words(12) for _ in range(8)]
    promo = "Read all our other news every day"
    texts = {}
    for i in range(30):
        texts["copies.example", i] = base
        texts["near.example", i] = [words(12) if j == i % 8 else x for j, x in enumerate(base)]
        texts["bare.example", i] = base
        texts["mixed.example", i] = [words(12) for _ in range(4)] if i % 3 else base
    around = {"copies.example": "article", "near.example": "article", "bare.example": "section", "mixed.example": "main"}
    rows = []
    for (host, i), blocks in texts.items():
        inner = "".join(f"<p>{x}</p>" for x in blocks) + (f"<div><p>{promo}</p></div>" if host == "mixed.example" else "")
        page = f"<body><script>track({i})</script><div><div class=ad>buy {words(2)}</div><{around[host]}>{inner}</{around[host]}></div></body>"
        rows.append((len(rows), f"http://{host}/{i}", page))
    got = {r.page_id: r.text for r in html_extraction.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {n: "\n\n".join(blocks) for n, blocks in enumerate(texts.values())}


# --- language model


def model(train, order=3, gram_share=1e-3, word_share=2e-3):
    """Backoff probabilities by plain recursion."""
    tokens = [spaced(t) + ["</s>"] for t in train]
    c = Counter(w for t in tokens for w in t)
    n, v = sum(c.values()), len(c)
    once, twice = sum(x == 1 for x in c.values()), sum(x == 2 for x in c.values())
    d = min(0.9, once / (once + 2 * twice)) if once else 0.5
    least = max(2.0, gram_share * n)
    frequent = {w for w, x in c.items() if x >= max(1.0, word_share * n) and x >= least} | {"<s>"}
    grams = {1: dict(c) | {"<s>": len(train)}}
    grams[1] = {(w,): x for w, x in grams[1].items()}
    for m in range(2, order + 1):
        found = Counter(g for t in tokens for g in zip(*[(["<s>"] + t)[i:] for i in range(m)]) if (m == 2 and g[0] in frequent or m > 2 and g[:-1] in grams[m - 1]) and g[-1] in frequent)
        grams[m] = {g: x for g, x in found.items() if x >= least}

    def p(context, w):
        if not context:
            return (c[w] - d if c[w] else d * v) / n
        gram = (*context, w)
        if gram in grams.get(len(gram), {}):
            return (grams[len(gram)][gram] - 0.5) / grams[len(context)][context]
        after = [g[-1] for g in grams.get(len(gram), {}) if g[:-1] == context]
        weight = (1 - sum(p(context, x) for x in after)) / (1 - sum(p(context[1:], x) for x in after)) if after else 1
        return weight * p(context[1:], w)

    def scores(text):
        t = ["<s>", *spaced(text), "</s>"]
        score = sum(math.log10(p(tuple(t[max(0, i - order + 1) : i]), t[i])) for i in range(1, len(t)))
        return len(t) - 1, sum(c[w] > 0 for w in t[1:]), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t[1:]), score

    return scores


def lm_docs():
    rng = random.Random(6)
    vocab = "the of and a cat dog sat on mat ran".split()
    docs = []
    for i in range(120):
        docs.append((i, " ".join(rng.choice(vocab[:4] if rng.random() < 0.5 else vocab) if rng.random() < 0.9 else f"w{rng.randrange(500)}" for _ in range(rng.randint(0, 40))).upper()))
    return docs + [(None, "the cat"), (3, docs[3][1]), (3, docs[3][1]), (200, None), (201, ""), (202, "\t \n"), (203, "the of " * 2000 + "zebra")]


def test_scores(docs_of):
    docs = lm_docs()
    training = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2
    scores = model([t for i, t in docs if training(i)])
    frame = docs_of([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, key int, score string")
    got = lm_scoring.held_out_scores(frame, gram_share=1e-3, word_share=2e-3).collect()
    key = lambda r: repr((r[0], *r[1:5], round(r[5], 6), round(r[6], 6)))
    assert sorted(map(key, got)) == sorted(key((i, not training(i), *scores(t))) for i, t in docs)


def test_scores_without_training_rows(docs_of):
    frame = docs_of([(1, "a b"), (2, None)])
    rows = lm_scoring.score_texts(frame, F.lit(False)).collect()
    assert sorted(map(tuple, rows)) == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]
    assert lm_scoring.held_out_scores(docs_of([])).collect() == []


def test_held_out_texts_score_better_than_the_base(docs_of):
    frame = docs_of([(i, t) for i, t in lm_docs() if i is not None])
    rows = [r for r in lm_scoring.held_out_scores(frame, gram_share=1e-3, word_share=1e-3).collect() if r.held_out]
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_rare_grams_count_in_a_large_training_part(docs_of):
    """A phrase that occurs twice is learnt however many other tokens there are."""
    training = [i for i in range(40) if zlib.crc32(str(i).encode()) % 7 != 2]
    held_out = next(i for i in range(40) if i not in training)
    phrase = "one rare phrase of six words"
    docs = [(training[0], phrase), (training[1], f"so {phrase} again"), (held_out, f"and {phrase}")] + [(i, "the cat sat " * 4000) for i in training[2:]]
    scores = model([t for i, t in docs if i != held_out], gram_share=0, word_share=0)
    got = {r.doc_id: tuple(r)[2:] for r in lm_scoring.held_out_scores(docs_of(docs)).collect()}
    assert len(got) == len(docs) and got[held_out][2] > 3e5
    for i, t in docs[:3]:
        assert all(math.isclose(a, b, abs_tol=1e-6) for a, b in zip(got[i], scores(t)))


def test_scores_over_many_blocks_bins_and_parts(docs_of, monkeypatch):
    """n-grams counted in other blocks and bins, and arcs that several blocks hold, give the same scores."""
    monkeypatch.setattr(lm_scoring, "BIN_BYTES", 700)
    docs = [(i, t) for i, t in lm_docs() if i is not None]
    training = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    scores = model([t for i, t in docs if training(i)], gram_share=0, word_share=0)
    key = lambda r: repr((r[0], *r[1:5], round(r[5], 6), round(r[6], 6)))
    got = lm_scoring.held_out_scores(docs_of(docs).repartition(7)).collect()
    assert sorted(map(key, got)) == sorted(key((i, not training(i), *scores(t))) for i, t in docs)


def test_scores_leave_no_shuffle_files(spark, docs_of):
    """Exchanges of one step are not on disk beside those of the next (F1 of round 4)."""
    store = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = store.getAllFiles()
        return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}

    docs = docs_of([(i, t) for i, t in lm_docs() if i is not None]).repartition(3).cache()
    docs.count()
    before = shuffles()
    assert lm_scoring.held_out_scores(docs).collect()
    until = time.time() + 20
    while shuffles() - before and time.time() < until:  # they are removed in the background
        time.sleep(0.2)
    assert not shuffles() - before


def test_asked_ngrams_are_small():
    """A distinct n-gram of a block takes a few bytes in the exchange (a row of four columns before)."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 30_000, 400)) for _ in range(300)]
    block = lm_scoring._block(7, [pa.record_batch([pa.array(range(300)), pa.array([True] * 300), pa.array(texts)], ["id", "training", "text"])])
    batch = block.select(["block", "rows", "texts"])
    pieces = [p for rows in lm_scoring._asked(iter([batch]), [1, 2, 3], 5) for p in rows.to_pylist()]
    sizes = [[len(x) for x in lm_scoring.unpack(p["keys"])] for p in pieces]
    assert sum(n for n, _ in sizes) > 250_000
    assert sum(len(p["keys"]) for p in pieces) < 7 * sum(n for n, _ in sizes)
    words = np.sort(np.unique(lm_scoring.token_stream(*lm_scoring.utf8(pa.array(texts)))[0]))
    got = [np.cumsum(lm_scoring.unpack(p["keys"])[0]) + np.uint64(p["first"] % (1 << 64)) for p in pieces if p["m"] == 1]
    assert np.array_equal(np.concatenate(got), words)
    assert [p["at"] for p in pieces if p["m"] == 1] == np.cumsum([0, *map(len, got)])[:-1].tolist()


def test_packed_numbers_come_back():
    rng = np.random.default_rng(8)
    arrays = [np.zeros(0, np.int64), np.array([0]), rng.integers(0, 3, 5000), rng.integers(0, 1 << 63, 900).astype(np.uint64) * np.uint64(2), np.array([2**64 - 1, 0], np.uint64)]
    back = lm_scoring.unpack(lm_scoring.pack(*arrays))
    assert len(back) == len(arrays) and all(np.array_equal(a.astype(np.uint64), b) for a, b in zip(arrays, back))


def test_sorting_gives_places_in_order():
    rng = np.random.default_rng(9)
    for values in ([], [3], rng.integers(0, 50, 999), rng.integers(0, 1 << 62, 999), np.r_[rng.integers(0, 4, 999) + (1 << 63 - 1), 0], np.array([2**64 - 1, 1, 0, 2**64 - 1], np.uint64)):
        values = np.asarray(values, np.uint64)
        assert np.array_equal(lm_scoring.sorting(values), np.argsort(values, kind="stable"))
        found, first, rank, counts = np.unique(values, return_index=True, return_inverse=True, return_counts=True)
        assert all(map(np.array_equal, (*lm_scoring.ranked(values), *lm_scoring.distinct(values)), (first, rank, found, counts)))
        counted = rng.random(len(values)) < 0.7
        assert np.array_equal(lm_scoring.distinct(values, counted)[1], np.bincount(rank[counted], minlength=len(found)))


def test_distinct_grams_are_those_of_the_automaton():
    data, offs = lm_scoring.utf8(pa.array(["a b a b c", "", "c a b", "b"]))
    stream, firsts = lm_scoring.token_stream(data, offs)
    grams = lm_scoring.Grams(stream, firsts, 4)
    found = {m: (keys, n) for m, keys, n in lm_scoring.distinct_grams(stream, firsts, [1, 2, 3, 4])}
    assert sorted(found) == [1, 2, 3, 4] and all(np.array_equal(found[m][0], grams.keys[m]) for m in found)
    assert [int(n.sum()) for _, n in found.values()] == [17, 13, 9, 6]
