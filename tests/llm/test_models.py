"""Language model, toxicity and HTML extraction: brute force, gradients, held-out quality."""

import html
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from promolift.llm import boosting, dom, extraction, language_model, queries, toxicity

from .conftest import SF, SF_MORE


# --- language model --------------------------------------------------------------------


def check_language_model(df, rows, learned):
    texts = [(r["doc_id"], r["text"]) for r in df.collect()]
    tokens = {(i, t): (t or "").encode().lower().split() + [None] for i, t in texts}
    count = Counter()
    for i, t in texts:
        if learned(i):
            count.update(tokens[i, t])
    n, v = sum(count.values()), len(count)
    even = math.log10(n + 0.5 * (v + 1))
    want = Counter()
    for i, t in texts:
        w = tokens[i, t]
        want[i, len(w), sum(count[x] > 0 for x in w), n, round(sum(math.log10(count[x] + 0.5) - even for x in w), 5)] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in rows) == want
    assert all(r["learned"] == learned(r["doc_id"]) and math.isfinite(r["score"]) and r["score"] < 0 for r in rows)


def test_words_and_hashes():
    texts = ["One two, THREE... one", None, "", " \n\t", "Ä ä\x0bé", "....", "x" * 5000 + "!!", "one\r\ntwo", "ab ba abab baba"]
    words = [(w, i) for i, t in enumerate(texts) for w in (t or "").encode().lower().split()]
    h, kind, doc = language_model.tokens(texts)
    assert doc.tolist() == [i for _, i in words]
    by = {}
    for (w, _), x, k in zip(words, h.tolist(), kind.tolist()):
        assert by.setdefault(w, (x, k)) == (x, k) and 0 <= k < language_model.RARE
        assert k % 2 == (w.rstrip(b".,;:!?\"')]}*&%$#") != w)
    assert len({x for x, _ in by.values()}) == len(by)
    assert all(language_model.tokens([t])[0].tolist() == [x for x, d in zip(h.tolist(), doc.tolist()) if d == i] for i, t in enumerate(texts))


def test_op5(spark, documents):
    rows = queries.op5_language_model(spark, SF).collect()
    learned = lambda i: zlib.crc32(str(i).encode()) % 5 != 1
    check_language_model(documents, [{**r.asDict(), "learned": not r["held_out"]} for r in rows], learned)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)  # the network tells more than counts


def test_counts_beyond_the_told_ones(monkeypatch, documents):
    monkeypatch.setattr(language_model, "TOP", 300)  # nearly all words meet their counts by the shuffle
    check_language_model(documents, language_model.scores(documents, F.lit(True)).collect(), lambda i: True)


def test_language_model_of_odd_texts(odd_documents, no_documents):
    learned = F.coalesce(F.col("doc_id"), F.lit(0)) % 2 == 0
    rows = language_model.scores(odd_documents, learned).collect()
    check_language_model(odd_documents, rows, lambda i: (i or 0) % 2 == 0)
    assert language_model.scores(no_documents, F.lit(True)).count() == 0
    check_language_model(odd_documents, language_model.scores(odd_documents, F.lit(False)).collect(), lambda i: False)


@pytest.fixture(scope="module")
def small_net():
    import pandas as pd

    top = pd.DataFrame({"h": np.arange(50), "kind": np.arange(50) % language_model.RARE, "c": np.arange(50)[::-1] + 1})
    corpus = language_model.Corpus(top, 2000, 60, 20, {k: 30.0 for k in range(language_model.RARE)})
    return language_model.Net(corpus), corpus


def test_network_is_a_distribution(small_net):
    net, corpus = small_net
    everything = np.arange(language_model.OWN + language_model.RARE)
    h = np.random.default_rng(0).normal(size=(1, language_model.STATE)).astype(np.float32)
    logs = net.log_probs(np.repeat(h, len(everything), axis=0), everything)
    assert abs(np.exp(logs.astype(float)).sum() - 1) < 1e-4


def test_network_gradients(small_net):
    net, _ = small_net
    rng = np.random.default_rng(1)
    for k in net.names:
        setattr(net, k, getattr(net, k).astype(np.float64))
    h, target = rng.normal(size=(40, language_model.STATE)), rng.integers(0, language_model.OWN + language_model.RARE, 40)
    grad = {k: np.zeros_like(getattr(net, k)) for k in net.names}
    _, dh = net.log_probs(h, target, grad)
    loss = lambda: -net.log_probs(h, target).sum()
    for name, array in [(k, getattr(net, k)) for k in ("wc", "bc", "wo", "bo")] + [("h", h)]:
        g = dh if name == "h" else grad[name]
        for at in rng.choice(array.size, 5):
            place = np.unravel_index(at, array.shape)
            old = array[place]
            array[place] = old + 1e-5
            up = loss()
            array[place] = old - 1e-5
            down = loss()
            array[place] = old
            assert abs((up - down) / 2e-5 - g[place]) < 1e-4


def test_state_runs_through_whole_documents(small_net, monkeypatch):
    net, corpus = small_net
    rng, rare = np.random.default_rng(2), np.zeros(language_model.RARE)
    docs = [rng.integers(0, language_model.OWN, n).astype(np.int16) for n in (0, 1, 5, 37, 200)]
    together = language_model.score_documents(net, docs, rare)
    alone = [language_model.score_documents(net, [d], rare)[0] for d in docs]
    assert np.allclose(together, alone, rtol=1e-4)
    one = 0.0
    h, before = np.zeros((1, language_model.STATE)), np.array([language_model.BOS])
    for t in [*docs[3].tolist(), 0]:
        h, _ = net.step(h, before)
        one += net.log_probs(h, np.array([t]))[0] / math.log(10)
        before = np.array([t])
    assert abs(one - alone[3]) < 1e-3 * abs(one)


def test_training_lowers_the_loss():
    import pandas as pd

    top = pd.DataFrame({"h": np.arange(50), "kind": 0, "c": 10})
    net = language_model.Net(language_model.Corpus(top, 500, 50, 20, {}))
    docs = [np.array([1 + (k + j) % 7 for j in range(60)], np.int16) for k in range(400)]
    before = language_model.score_documents(net, docs, np.zeros(language_model.RARE)).sum()
    for _ in range(6):
        assert language_model.train_documents(net, docs, rate=0.02) == 400 * 61
    assert language_model.score_documents(net, docs, np.zeros(language_model.RARE)).sum() > 0.7 * before


# --- toxicity --------------------------------------------------------------------------


def test_op9(spark):
    rows = {r["doc_id"]: r for r in queries.op9_toxicity(spark, "/root/testdata/sf0.1").collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    assert len(rows) == 10_000
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [(labels[i], r["predicted"]) for i, r in rows.items() if r["held_out"] and i in labels]
    toxic, clean = [p for y, p in held if y], [p for y, p in held if not y]
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.03


def plain_toxicity(net, text):
    """The score of one text, word by word and filter by filter, as the definition has it."""
    words = re.findall(r"[^\W\d_]+", text.lower()) if text else []
    vector = {}
    for w in set(words):
        names = [f"={w}", *[f"^{w[:k]}" for k in (2, 3, 4, 5)], *[f"{w[-k:]}$" for k in (3, 4)], f"~{w[:6]}"]
        vector[w] = sum(net.table[xxhash.xxh32_intdigest(x.encode()) % toxicity.ROWS].astype(float) for x in names)
    odds, k = float(net.shift), 0
    for width, f, b in zip(toxicity.WIDTHS, net.filters, net.bias):
        best = None
        for i in range(len(words)):       # a window that runs over the end has what is left of it
            r = b + sum(vector[words[i + j]] @ f[j] for j in range(width) if i + j < len(words))
            best = r if best is None else np.maximum(best, r)
        if best is not None:
            odds += float(np.maximum(best, 0) @ net.out[k:k + len(b)])
        k += len(b)
    told = {name: sum(w in own for w in words) for name, own in toxicity.LANGUAGES.items()}
    tongue = max(told, key=lambda x: told[x]) if any(told.values()) else "other"
    return 1 / (1 + math.exp(-min(40, max(-40, odds - net.thresholds.get(tongue, net.thresholds.get("other", 0.0))))))


def test_op9_against_a_plain_forward_pass(spark, documents):
    """Every score of the query is the network's, computed without batches, vocabularies or
    shared words."""
    learned = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0
    net = toxicity.fit(documents, spark.read.parquet(f"{SF}/labels.parquet"), learned)
    rows = {r["doc_id"]: r for r in queries.op9_toxicity(spark, SF).collect()}
    assert len(rows) == documents.count()
    for r in documents.select("doc_id", "text").collect():
        got = rows[r["doc_id"]]
        assert got["score"] == pytest.approx(plain_toxicity(net, r["text"]), abs=2e-4)
        assert got["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and got["predicted"] == int(got["score"] >= 0.5)


def test_toxicity_uses_no_other_column(spark, odd_documents, no_documents):
    rng = np.random.default_rng(0)
    words = [f"w{k}" for k in range(200)]
    texts = [" ".join(rng.choice(words, 30)) + (" vile" if k % 3 == 0 else "") for k in range(600)]
    net = toxicity.train(texts, (np.arange(600) % 3 == 0).astype(int), np.arange(600) % 4 == 0)
    scored = net.score_texts(["w1 w2 vile w3", "w1 w2 w3", "", None], toxicity.Vocabulary())
    assert scored[0] > 0.5 > scored[1] and scored[2] == scored[3]
    rows = toxicity.score(odd_documents, net).collect()
    assert len(rows) == odd_documents.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score(no_documents, net).count() == 0
    long_text = "w5 " * 20_000 + "vile"
    assert net.score_texts([long_text], toxicity.Vocabulary())[0] > 0.5  # whole texts, not prefixes


def test_toxicity_without_labels(spark, odd_documents):
    labels = spark.createDataFrame([(0, None), (None, 1)], "doc_id long, toxic int")
    net = toxicity.fit(odd_documents, labels, F.lit(True))
    assert {r["score"] for r in toxicity.score(odd_documents, net).collect()} == {0.25}
    labels = spark.createDataFrame([(4, 1), (4, 0)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score(odd_documents, toxicity.fit(odd_documents, labels, F.lit(True))).collect()} == {0.75}


def marked_documents(spark, n, words):
    """n texts of neutral words; every third has one of ``words`` and the label 1."""
    rng = np.random.default_rng(1)
    neutral = [f"{a}{b}{c}" for a in "bdfgkl" for b in "aeiou" for c in ("nos", "ter", "lim", "var")]
    rows = [(k, " ".join([*rng.choice(neutral, 15), *([words[k // 3 % len(words)]] if k % 3 == 0 else []), *rng.choice(neutral, 15)]), int(k % 3 == 0)) for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int"), neutral


def test_toxicity_learns_from_all_labelled_rows(spark, monkeypatch):
    """Marks that a start from a few rows can't have met are learned, and thresholds count every
    row set apart, however the rows are dealt."""
    rnd = random.Random(3)
    marks = ["".join(rnd.choices("qxzwyj", k=7)) for _ in range(40)]
    rows, neutral = marked_documents(spark, 4800, marks)
    rows = rows.cache()
    counted, real = [], toxicity.calibrate
    monkeypatch.setattr(toxicity, "calibrate", lambda c: counted.append((int(c["toxic"].sum()), int(c["clean"].sum()))) or real(c))
    monkeypatch.setattr(toxicity, "PART_CHARS", 250_000)    # a few parts
    nets = [toxicity.fit(rows.orderBy(F.rand(n)).repartition(n), rows.select("doc_id", "toxic"), F.lit(True), sample=20) for n in (1, 5)]
    apart = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(4)) == 0).groupBy("toxic").count().collect()
    apart = {r["toxic"]: r["count"] for r in apart}
    assert counted[-2:] == [(apart[1], apart[0])] * 2 and sum(apart.values()) > 1000
    assert np.abs(nets[0].table - nets[1].table).max() < 1e-6 and nets[0].thresholds == nets[1].thresholds
    texts = [" ".join([*neutral[:10], *([m] if m else []), *neutral[10:20]]) for m in (*marks, None)]
    found = nets[0].score_texts(texts, toxicity.Vocabulary())
    assert found[-1] < 0.5 and (found[:-1] >= 0.5).mean() > 0.9


def test_scores_do_not_depend_on_the_layout(spark, monkeypatch):
    """Equal documents in one partition or many, in any order, get equal scores, with several
    parts to average."""
    monkeypatch.setattr(language_model, "PART_TOKENS", 4000)
    d = spark.read.parquet(f"{SF}/documents.parquet")
    found = []
    for n in (1, 6):
        rows = language_model.scores(d.orderBy(F.rand(n)).repartition(n), F.col("doc_id") % 5 != 1).collect()
        found.append({r["doc_id"]: r["score"] for r in rows})
    assert max(abs(found[0][k] - found[1][k]) for k in found[0]) < 1e-6


# --- extraction ------------------------------------------------------------------------


def article(page):
    """Main text of the given pages' plain layout, straight from their marks."""
    inside = re.search(r"<article>(.*)</article>", page, re.S)[1].replace("<br>", " ")
    blocks = re.split(r"</?p>|</?h1>", re.sub(r"</?b>", "", inside))
    return "\n".join(x for x in (" ".join(html.unescape(b).split()) for b in blocks) if x)


def test_op7(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF_MORE}/pages.parquet").collect()}
    rows = queries.op7_html_text(spark, SF_MORE).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r["url"] == pages[r["page_id"]]["url"] and r["n_chars"] == len(r["text"])
        assert r["text"] == article(pages[r["page_id"]]["html"])


@pytest.fixture(scope="module")
def trees(spark):
    return extraction.train([r["html"] for r in spark.read.parquet(f"{SF_MORE}/pages.parquet").orderBy("page_id").limit(150).collect()])


def test_other_layouts(spark, trees):
    rnd, exact = random.Random(5), 0
    pages = [r["html"] for r in spark.read.parquet(f"{SF_MORE}/pages.parquet").orderBy("page_id").collect()][150:220]
    for p in pages:
        made = extraction.layout(article(p).split("\n")[:40], rnd)
        want = [t.replace(extraction.MARK, "") for t in dom.Page(made).run_text if extraction.MARK in t]
        exact += extraction.extract(made.replace(extraction.MARK, ""), trees).split("\n") == want
    assert exact >= 0.9 * len(pages)


FOX = "The quick brown fox jumps over the lazy dog, and the dog sleeps on in the warm sun."
MORE = "Another paragraph follows here with some more words, and it goes on for a while."


@pytest.mark.parametrize("page, text", [
    ("<html><body><p>A</p><p>B</p></body></html>", "A\nB"),
    (f"<html><body><p>{FOX}</p></body></html>", FOX),
    (f"<html><body><p>{FOX}</p><p>{MORE}</p><p>Third {FOX}</p></body></html>", f"{FOX}\n{MORE}\nThird {FOX}"),
    (f"<html><body><div><div><p>{FOX}</p><p>{MORE}</p><p>Third {FOX}</p></div></div></body></html>", f"{FOX}\n{MORE}\nThird {FOX}"),
    (f"<p>{FOX}</p><p>{MORE}</p><p>Third {FOX}</p>", f"{FOX}\n{MORE}\nThird {FOX}"),
    (f"<html><body><h1>Title here</h1><p>{FOX}</p><p>{MORE}</p></body></html>", f"Title here\n{FOX}\n{MORE}"),
    (FOX, FOX),
    (f"{FOX}<br>{MORE}", f"{FOX} {MORE}"),
    ("a < b and c > d", "a < b and c > d"),
    (f"<html><body><nav><a href=/>Home</a> <a href=/x>News</a></nav><p>{FOX}</p><p>{MORE}</p><footer>(c) Site</footer></body></html>", f"{FOX}\n{MORE}"),
    (f"<html><body><div class='inhalt'><h1>Titel</h1><p>{FOX}</p><p>{MORE}</p></div><div class='fusszeile'><ul><li><a href=/a>Impressum</a></li><li><a href=/b>Kontakt</a></li></ul></div></body></html>",
     f"Titel\n{FOX}\n{MORE}"),
    (f"<html><body><article><h1>Told</h1><p>{FOX}</p><p>{MORE}</p><p>{FOX} Again.</p></article><div class='opinions'><div class='opinion'><b>Ann</b><p>I liked it a lot.</p></div>"
     "<div class='opinion'><b>Bob</b><p>Me too, thanks.</p></div><div class='opinion'><b>Cid</b><p>Not bad at all.</p></div></div></body></html>", f"Told\n{FOX}\n{MORE}\n{FOX} Again."),
])
def test_ordinary_pages(trees, page, text):
    """Pages without a wrapper, with few paragraphs, text alone, unlisted names."""
    assert extraction.extract(page, trees) == text


def test_parts_that_are_no_article(trees):
    text = "The quick brown fox jumps over the lazy dog, and the dog sleeps on in the warm sun."
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><header class='site-header'><p>Site name here</p></header><nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav>"
        f"<div class='cookie-notice'><p>We use cookies on this site.</p></div><article><h1>A title</h1><p>{text}</p><p>Second: {text}</p><script>var x='<p>no</p>';</script><p>Third&nbsp;&amp; last: {text}</p></article>"
        "<aside class='sidebar'><h3>Related</h3><ul><li><a href=/c>Other story</a></li></ul></aside><section id='comments'><div class='comment'><p>First comment, nice read!</p></div><div class='comment'><p>I agree.</p></div></section>"
        "<form class='newsletter'><label>Mail</label><p>Subscribe now</p></form><footer><p>&copy; 2020 Site</p></footer></body></html>"
    )
    assert extraction.extract(page, trees) == f"A title\n{text}\nSecond: {text}\nThird & last: {text}"


def test_broken_and_empty_pages(spark, trees):
    rows = [(1, None), (2, ""), (3, "<html></html>"), (4, "<p"), (5, "a < b and c > d"), (6, "<div><p>x" * 3000), (7, "<a \"" * 3000), (8, "<!-- <p>no</p>"), (9, "</div></p>"),
            (10, "<article><p>" + "many words in one block " * 5000 + "</article>"), (10, "<article><p>" + "many words in one block " * 5000 + "</article>")]
    df = spark.createDataFrame([(i, "u", h, "clash") for i, h in rows], "page_id long, url string, html string, text string")
    out = extraction.main_text(df, trees).collect()
    assert len(out) == len(rows) and all(r["text"] is not None for r in out)
    by = {r["page_id"]: r["text"] for r in out}
    assert by[1] == by[2] == by[3] == by[8] == by[9] == ""
    assert by[10] == " ".join(["many words in one block"] * 5000) and by[5] == "a < b and c > d"
    assert extraction.main_text(df.where("false"), trees).count() == 0
    assert extraction.fit(df.where("false")) is not None


def test_equal_pages_are_one_example(spark):
    """A page that holds most rows, equal and under one key, is sampled once at most; null keys
    and null pages are rows like others."""
    rows = [(7, "<p>same</p>")] * 500 + [(i, f"<article><p>Page {i} with some words.</p></article>") for i in range(40)] + [(None, "<p>x</p>"), (None, None), (99, None)]
    df = spark.createDataFrame(rows, "page_id long, html string")
    t = extraction.fit(df)
    assert len(t.feature) > 0
    assert extraction.main_text(df, t, passed=("page_id",)).count() == len(rows)


def test_decoding_has_no_contradictions(trees):
    page = dom.Page("<div><p>aa</p><div><p>bb</p><p>cc</p></div></div><div><p>dd</p></div>")
    nodes = extraction.Nodes(page)
    rng = np.random.default_rng(0)

    def best(i, parent_free):
        """Largest sum by trying all: kept, dropped, or left open."""
        below = [k for k in range(len(nodes.rows)) if nodes.parent[k] == i]
        whole = lambda k: s[k] / 2 + sum(whole(c) for c in range(len(nodes.rows)) if nodes.parent[c] == k)
        options = [whole(i), -whole(i)]
        if nodes.run[i] < 0:
            options.append(sum(best(k, True) for k in below) - 0.05)
        return max(options)

    for _ in range(30):
        s = rng.normal(size=len(nodes.rows)) * 3
        s = np.clip(s, -5, 5)
        kept = set(extraction.decode(nodes, s).tolist())
        assert kept <= set(range(len(page.run_text)))
        if best(0, True) == sum(s) / 2:
            assert len(kept) == len(page.run_text)


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(int)
    t = boosting.Trees(rounds=30).fit(x[:2000], y[:2000])
    assert ((t.odds(x[2000:]) > 0) == y[2000:]).mean() > 0.95
    assert (boosting.Trees().fit(x[:5], np.ones(5)).odds(x) > 0).all()


@pytest.mark.parametrize("html, runs", [
    ("<html><head><title>T</title><p>text one<p>two", ["text one", "two"]),
    ("<html><head><meta charset=x><title>T</title><link rel=y> text <p>two", ["text", "two"]),
    ("<head><title>T</title><script>a</script><noscript><p>no</p></noscript></head><p>text", ["text"]),
    ("<p>a <svg viewBox='0 0 1 1'/> b</p><p>c</p><svg><path/></svg><p>d", ["a b", "c", "d"]),
    ("<p>a <math/> b</p><p>c", ["a b", "c"]),
    ("<div>a <svg><title>Icon</svg> b</div><svg><style/><g/></svg><p>c", ["a b", "c"]),
    ("<p>a<svg><g>no</g><span>b</span></svg> c", ["a b c"]),
    ("<svg><foreignObject><div>no</div></foreignObject></svg><p>a", ["a"]),
    ("<p>a <button>A <button>B</button> b</p>", ["a b"]),
    ("<div><button><div>no</div>no</button>a</div>", ["a"]),
    ("<div><template><p>no</p><template>no</template><p>no</p></template>a</div>", ["a"]),
    ("<title-bar>a</title-bar><button-row>b</button-row><p>c", ["ab", "c"]),
    ("<p>a<textarea>no<p>no</p>", ["a"]),
])
def test_pages_are_read_to_their_end(html, runs):
    assert dom.Page(html).run_text == runs


@pytest.mark.parametrize("name", sorted(dom.DROPPED))
def test_unclosed_elements_end_with_their_block(name):
    """All placements of an element among blocks, closed and unclosed."""
    for before, after in itertools.product(("", "<p>w</p>", f"<{name}>no</{name}>"), ("<p>x<p>y", f"<p>x</p><{name}>no</{name}><p>y</p>", f"<p>x<{name}>no</p><p>y")):
        for part in (f"<{name}>no</{name}>", f"<{name} class=c>no", f"<{name}><q>no</q>"):
            assert dom.Page(f"<html><body>{before}<div>v {part}</div>{after}").run_text == ["w"] * before.count("w") + ["v", "x", "y"]
