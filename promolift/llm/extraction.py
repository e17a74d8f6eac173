"""HTML extraction by gradient-boosted trees over DOM nodes.

A page becomes a tree of block elements with text runs as leaves.  Every node gets
features: element kind, tokens of its attributes and of its ancestors', depth, length,
density of links and markup in its subtree, its place in the page and its siblings'
statistics.  Boosted trees give each node the log-odds of belonging to the article.
Decoding works on the whole tree: a node is kept or dropped with everything below it, or
left open for its children to decide, whichever gives the largest sum of log-odds, so
that no dropped ancestor has a kept descendant.

The trees are fitted on a bounded seeded sample of the pages (``SAMPLE``): nodes are
labelled by their elements and attributes where these are plain, and each sampled page's
own paragraphs (the first ``PARAGRAPHS``) are also set in ``VARIANTS`` other layouts, with and
without menus, side bars, notices, forms, adverts and reader comments around them, so that
layouts that the sample lacks are learned too.

Defined cases: null, empty or text-free html gives the empty text; pages are read whole;
broken markup is read forgivingly; equal pages get equal texts; extra columns are passed
on only if named; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
import random
from html import escape

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .boosting import Trees
from .common import drawn, map_texts, ship
from .dom import Page

SAMPLE, VARIANTS, PARAGRAPHS = 400, 6, 60   # pages; layouts of each; paragraphs that a layout takes of its page

#: Element groups and attribute-token groups; a node has a feature for each.
TAGS = (
    "p", "h1 h2 h3 h4 h5 h6", "ul ol menu dir", "li", "div center", "section", "article", "main", "nav", "header hgroup",
    "footer", "aside", "form fieldset legend", "table tbody thead tfoot tr caption", "blockquote pre", "figure figcaption",
    "dl dt dd", "body html #root", "details summary dialog", "address",
)
TOKENS = {
    "content": "content article post entry story main body text prose page copy",
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs toolbar links topnav pagination pager tabs toc skip",
    "header": "header masthead banner branding logo top hero",
    "footer": "footer foot bottom colophon copyright legal credits imprint",
    "side": "sidebar side rail widget related recommended popular trending more aside recirc complementary",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion dfp teaser",
    "comment": "comment comments reply replies discussion respond responses feedback disqus thread commentlist",
    "notice": "notice cookie cookies consent gdpr alert warning disclaimer newsletter subscribe subscription signup paywall popup modal message privacy",
    "share": "share sharing social follow tags meta byline author bio date print tools",
    "form": "form search login register contact poll vote input",
}
TAG_OF = {t: k for k, group in enumerate(TAGS) for t in group.split()}
TOKEN_OF = {t: k for k, group in enumerate(TOKENS.values()) for t in group.split()}
N_TAGS, N_TOKENS = len(TAGS), len(TOKENS)
WIDTH = 2 * N_TAGS + 2 * N_TOKENS + 18


class Nodes:
    """Nodes with text of one page, in page order, leaves (runs) among them.

    ``parent`` points into the same list (-1 for the top); ``run`` is the number of the
    text run of a leaf, else -1; ``x`` has the features."""

    def __init__(self, page: Page):
        size, link, runs, inner = [0] * len(page.tag), [0] * len(page.tag), [0] * len(page.tag), list(page.inline)
        for node, text, a in zip(page.run_node, page.run_text, page.run_link):
            size[node] += len(text)
            link[node] += a
            runs[node] += 1
        for i in range(len(page.tag) - 1, 0, -1):
            p = page.parent[i]
            size[p] += size[i]
            link[p] += link[i]
            runs[p] += runs[i]
            inner[p] += inner[i] + 1
        # elements with text, then their runs as leaves, sorted by page order
        flags, above, depth = [0] * len(page.tag), [0] * len(page.tag), [0] * len(page.tag)
        kind, tags_above = [0] * len(page.tag), [0] * len(page.tag)
        for i in range(len(page.tag)):
            bits = 0
            for t in page.names[i]:
                k = TOKEN_OF.get(t)
                if k is not None:
                    bits |= 1 << k
            flags[i], kind[i] = bits, TAG_OF.get(page.tag[i], 4)
            p = page.parent[i]
            if p >= 0:
                above[i], depth[i], tags_above[i] = above[p] | flags[p], depth[p] + 1, tags_above[p] | 1 << kind[p]
        total = max(1, size[0])
        new, self.parent, self.run, rows = {}, [], [], []
        items = sorted([(i, -1) for i in range(len(page.tag)) if size[i]] + [(n, r) for r, n in enumerate(page.run_node)])
        # an element stands before its runs; its later runs come behind elements inside it,
        # which only matters for the place feature, taken from running sums below
        before_run, s = [], 0
        for t in page.run_text:
            before_run.append(s)
            s += len(t)
        first_run: dict[int, int] = {}
        for r, n in enumerate(page.run_node):
            while n >= 0 and n not in first_run:
                first_run[n] = r
                n = page.parent[n]
        for i, r in items:
            own = i if r < 0 else i
            up = page.parent[i] if r < 0 else i
            place = before_run[first_run[i] if r < 0 else r] / total
            n_chars, n_link = (size[i], link[i]) if r < 0 else (len(page.run_text[r]), page.run_link[r])
            if r < 0:
                new[i] = len(self.parent)
            self.parent.append(new.get(up, -1) if up >= 0 else -1)
            self.run.append(r)
            rows.append((kind[own], tags_above[own] if r < 0 else tags_above[own] | 1 << kind[own], flags[own], above[own], depth[own] + (r >= 0), n_chars, n_link, runs[i] if r < 0 else 1, inner[i] if r < 0 else 0, place, n_chars / total, r >= 0, page.run_text[r][-1:] in ".!?:\"'" if r >= 0 else 0, page.run_text[r].count(" ") + 1 if r >= 0 else 0))
        self.rows = np.array(rows, np.float64).reshape(-1, 14)
        self.parent = np.array(self.parent, np.int64)
        self.run = np.array(self.run, np.int64)

    def features(self) -> np.ndarray:
        r, p, n = self.rows, self.parent, len(self.rows)
        x = np.zeros((n, WIDTH), np.float32)
        if not n:
            return x
        kind, tags_above, flags, above = (r[:, k].astype(np.int64) for k in range(4))
        x[np.arange(n), kind] = 1
        x[:, N_TAGS:2 * N_TAGS] = tags_above[:, None] >> np.arange(N_TAGS) & 1
        o = 2 * N_TAGS
        x[:, o:o + N_TOKENS] = flags[:, None] >> np.arange(N_TOKENS) & 1
        x[:, o + N_TOKENS:o + 2 * N_TOKENS] = above[:, None] >> np.arange(N_TOKENS) & 1
        o += 2 * N_TOKENS
        depth, chars, link, runs, inner, place, share, leaf, ended, words = (r[:, k] for k in range(4, 14))
        up = np.maximum(p, 0)
        siblings = np.bincount(up, minlength=n)[up]
        same = np.unique(up * N_TAGS + kind, return_inverse=True)[1]
        alike = np.bincount(same)[same]
        mean_size = (np.bincount(up, weights=chars, minlength=n) / np.maximum(1, np.bincount(up, minlength=n)))[up]
        mean_link = (np.bincount(up, weights=link, minlength=n) / np.maximum(1, np.bincount(up, weights=chars, minlength=n)))[up]
        x[:, o:] = np.stack([
            depth, np.log1p(chars), link / np.maximum(1, chars), runs, np.log1p(chars / np.maximum(1, runs)), inner / np.maximum(1, chars) * 100,
            place, share, leaf, ended, words, siblings, alike / np.maximum(1, siblings), np.log1p(mean_size), mean_link,
            chars / np.maximum(1, chars[up]), np.log1p(chars[up]), link[up] / np.maximum(1, chars[up]),
        ], axis=1)
        return x


def decode(nodes: Nodes, odds: np.ndarray, split: float = 0.05) -> np.ndarray:
    """Kept runs: for each node all of it, nothing of it, or its children's own choices."""
    n, p = len(odds), nodes.parent.tolist()
    s = np.clip(odds, -5, 5).tolist()
    keep, drop, free, leaf = [0.0] * n, [0.0] * n, [0.0] * n, (nodes.run >= 0).tolist()
    for i in range(n - 1, -1, -1):
        keep[i] += s[i] / 2
        drop[i] -= s[i] / 2
        best = max(keep[i], drop[i]) if leaf[i] else max(keep[i], drop[i], free[i] - split)
        if p[i] >= 0:
            keep[p[i]] += keep[i]
            drop[p[i]] += drop[i]
            free[p[i]] += best
    state = [0] * n  # 1 kept, -1 dropped, 0 open
    for i in range(n):
        if p[i] >= 0 and state[p[i]]:
            state[i] = state[p[i]]
        elif leaf[i] or max(keep[i], drop[i]) >= free[i] - split:
            state[i] = 1 if keep[i] > drop[i] else -1
    return nodes.run[[i for i in range(n) if leaf[i] and state[i] == 1]]


def extract(html: str | None, trees: Trees) -> str:
    return texts_of([html], trees)[0]


def texts_of(pages: list[str | None], trees: Trees) -> list[str]:
    """Main texts of pages; features and odds are computed for all of them at once."""
    read = [Page(h) for h in pages]
    nodes = [Nodes(p) for p in read]
    x = np.concatenate([n.features() for n in nodes]) if nodes else np.zeros((0, WIDTH), np.float32)
    odds, at, out = trees.odds(x), 0, []
    for page, n in zip(read, nodes):
        own = odds[at:at + len(n.rows)]
        at += len(n.rows)
        out.append("\n".join(page.run_text[r] for r in sorted(decode(n, own).tolist())))
    return out


# --- training -------------------------------------------------------------------------

_OUT_TAGS = {"nav", "footer", "aside", "form", "header", "dialog", "menu"}
_OUT_TOKENS = {k for k, name in enumerate(TOKENS) if name not in ("content", "share", "header", "form")}


def plain_labels(page: Page) -> list[int | None]:
    """1, 0 or None (unknown) for every run, by the elements that hold it."""
    label: list[int | None] = [None] * len(page.tag)
    for i, t in enumerate(page.tag):
        up = label[page.parent[i]] if i else None
        groups = {TOKEN_OF[n] for n in page.names[i] if n in TOKEN_OF}
        if up == 0 or t in _OUT_TAGS and t != "header" or groups & _OUT_TOKENS:
            label[i] = 0
        elif t == "header" and up is None:
            label[i] = 0
        elif t in ("article", "main"):
            label[i] = 1
        else:
            label[i] = up
    return [label[n] for n in page.run_node]


def node_labels(nodes: Nodes, run_labels) -> np.ndarray:
    """1 or 0 where (nearly) all text below a node agrees, else -1."""
    n = len(nodes.rows)
    good, bad, p = np.zeros(n), np.zeros(n), nodes.parent
    chars = nodes.rows[:, 5]
    for i in range(n - 1, -1, -1):
        if nodes.run[i] >= 0:
            v = run_labels[nodes.run[i]]
            good[i], bad[i] = chars[i] * (v == 1), chars[i] * (v == 0)
        if p[i] >= 0:
            good[p[i]] += good[i]
            bad[p[i]] += bad[i]
    share = good / np.maximum(1, good + bad)
    return np.where(good + bad == 0, -1, np.where(share > 0.98, 1, np.where(share < 0.02, 0, -1)))


def _made_name(rnd: random.Random) -> str:
    """A name that no list has, as of another language or a page builder."""
    return "".join(rnd.choice("bcdfglmnprstv") + rnd.choice("aeiou") for _ in range(rnd.randint(2, 4)))


def _tagged(rnd: random.Random, tag: str, names: str, inside: str, made: float = 0.0, bare: float = 0.0) -> str:
    """An element with an id or class from ``names``; with the chances ``made`` and ``bare`` one
    with an unlisted name or without any."""
    style, kind = rnd.random(), rnd.random()
    name = rnd.choice(names.split()) if kind >= made + bare else _made_name(rnd)
    attribute = "" if made <= kind < made + bare else f' id="{name}"' if style < 0.25 else f' class="{rnd.choice(("", "wide ", "x1 ", "col "))}{name}{rnd.choice(("", "-box", "-2", " clear"))}"'
    return f"<{tag}{attribute}>{inside}</{tag}>"


def layout(paragraphs: list[str], rnd: random.Random) -> str:
    """A page around the paragraphs, in a random layout.  Article text carries the mark
    U+E000 in front of every run, which labels it.

    What surrounds an article shows it by its element, by a listed name, by links or, for
    reader comments, by its repeated short parts; a share of the names is unlisted.  The
    article itself may stand in an element of any name or directly in the body, be short,
    have no heading, and be the page's only text."""
    mark, some_paragraphs = MARK, paragraphs if rnd.random() < 0.6 else rnd.sample(paragraphs, min(len(paragraphs), rnd.randint(1, 4)))
    text = [escape(p, quote=False) for p in some_paragraphs]
    some = lambda n: " ".join(rnd.choice(paragraphs).split()[: rnd.randint(1, n)] or ["x"])
    short = lambda n=8: escape(some(n), quote=False)
    links = lambda n: "".join(f'<li><a href="/{k}">{short(3)}</a></li>' for k in range(rnd.randint(2, n)))
    out_p = lambda n, most: "".join(f"<p>{short(most)}</p>" for _ in range(rnd.randint(1, n)))
    div = lambda tag: tag if rnd.random() < 0.5 else "div"
    clean = rnd.random()     # pages with little or nothing around the article
    busy = 0.0 if clean < 0.15 else 0.3 if clean < 0.35 else 1.0

    if rnd.random() < 0.08:   # text straight in its element, without paragraphs
        body = [f"{mark}{'<br><br>'.join(text)}"] if rnd.random() < 0.5 else [f"<div>{mark}{t}</div>" for t in text]
    else:
        body = [f"<h1>{mark}{short(8)}</h1>"] if rnd.random() < 0.55 else []
        for t in text:
            r = rnd.random()
            if r < 0.04:
                body.append(f"<h2>{mark}{short(6)}</h2>")
            if r < 0.06:
                body.append("<ul>" + "".join(f"<li>{mark}{short(15)}</li>" for _ in range(rnd.randint(2, 5))) + "</ul>")
            if 0.06 < r < 0.1:
                body.append(f"<blockquote><p>{mark}{short(30)}</p></blockquote>")
            if 0.1 < r < 0.1 + 0.03 * busy:
                body.append(_tagged(rnd, "div", TOKENS["advert"], short(12)))
            if 0.13 < r < 0.15:
                body.append(f"<figure><img src=x><figcaption>{mark}{short(10)}</figcaption></figure>")
            if 0.15 < r < 0.15 + 0.02 * busy:
                body.append(_tagged(rnd, "div", TOKENS["notice"], out_p(1, 20)))
            if 0.17 < r < 0.17 + 0.02 * busy:
                body.append(_tagged(rnd, rnd.choice(("aside", "div")), TOKENS["side"], f"<h3>{short(3)}</h3><ul>{links(4)}</ul>"))
            link = f'<a href="/l">{t[:30]}</a>{t[30:]}' if rnd.random() < 0.1 and "&" not in t[:40] else t
            plain = rnd.random()
            if plain < 0.1:
                body.append(f"<div>{mark}{link}</div>")
            elif plain < 0.15:
                body.append(f'<p class="{_made_name(rnd)}">{mark}{link}</p>')
            else:
                body.append(rnd.choice((f"<p>{mark}{link}</p>", f"<p><b>{mark}{link}<br>", f"<p>{mark}{link}", f"<p>{mark}{link}</p>")))
        if len(body) > 4 and rnd.random() < 0.15:    # in parts
            cut = rnd.randint(1, len(body) - 1)
            inner = rnd.choice(("div", "section"))
            body = [f"<{inner}>{''.join(body[:cut])}</{inner}>", f"<{inner}>{''.join(body[cut:])}</{inner}>"]
    article, inside_comments = "".join(body), False
    wrap = rnd.random()
    if wrap < 0.25:
        article = f"<article>{article}</article>"
    elif wrap < 0.35:
        article = f"<main>{article}</main>"
    elif wrap < 0.6:
        article = _tagged(rnd, rnd.choice(("div", "div", "section")), TOKENS["content"], article)
    elif wrap < 0.75:
        article = _tagged(rnd, rnd.choice(("div", "div", "section")), "x", article, made=0.6, bare=0.4)
    parts_before, parts_after = [], []

    def add(chance, part):
        if rnd.random() < chance * busy:
            (parts_before if rnd.random() < 0.5 else parts_after).append(part)

    if rnd.random() < 0.85 * busy:
        parts_before.append(_tagged(rnd, div("nav"), TOKENS["menu"], f"<ul>{links(9)}</ul>", made=0.15, bare=0.1))
    if rnd.random() < 0.5 * busy:
        inner = rnd.choice((f"<h1>{short(4)}</h1>", f"<p>{short(9)}</p>", short(5)))
        parts_before.insert(0, _tagged(rnd, "header", TOKENS["header"], inner, made=0.1, bare=0.3) if rnd.random() < 0.5 else _tagged(rnd, "div", TOKENS["header"], inner))
    side = rnd.choice((f"<h3>{short(3)}</h3><ul>{links(7)}</ul>", out_p(3, 25)))
    add(0.5, _tagged(rnd, "aside", TOKENS["side"], side, made=0.2, bare=0.2) if rnd.random() < 0.5 else _tagged(rnd, "div", TOKENS["side"], side, made=0.3 if "<li>" in side else 0.0))
    add(0.5, _tagged(rnd, "div", TOKENS["advert"], rnd.choice((short(14), out_p(2, 16)))))
    add(0.5, _tagged(rnd, rnd.choice(("div", "section", "p")), TOKENS["notice"], short(25)))
    add(0.4, _tagged(rnd, "form", TOKENS["form"], f"<label>{short(3)}</label><input name=q><p>{short(8)}</p>", made=0.2, bare=0.2))
    add(0.3, _tagged(rnd, "div", TOKENS["share"], f"<ul>{links(4)}</ul>", made=0.2))
    if rnd.random() < 0.55 * busy:
        unlisted = rnd.random() < 0.4
        name, parts = (_made_name(rnd), rnd.randint(2, 7)) if unlisted else ("", rnd.randint(1, 6))
        tag = rnd.choice(("div", "li", "article")) if unlisted else rnd.choice(("div", "li", "article", "p"))
        made = lambda: rnd.choice((f"<b>{short(2)}</b> {short(20)}", f"<b>{short(2)}</b><p>{short(25)}</p>", f"<span>{short(2)}</span><p>{short(25)}</p>"))
        told = lambda: rnd.choice((f"<p>{short(30)}</p>", short(30), f"<b>{short(2)}</b> {short(20)}<p>{short(12)}</p>"))
        one = (lambda: f'<{tag} class="{name}">{made()}</{tag}>') if unlisted else (lambda: _tagged(rnd, tag, "comment reply comment-body response", told()))
        listed = "".join(one() for _ in range(parts))
        comments = _tagged(rnd, rnd.choice(("section", "div", "ol")), TOKENS["comment"], rnd.choice(("", f"<h3>{short(2)}</h3>")) + listed, made=1.0 if unlisted else 0.0)
        if rnd.random() < 0.4 and article.endswith(("</article>", "</main>", "</div>")) and wrap < 0.75:
            cut = article.rindex("</")
            article, inside_comments = article[:cut] + comments + article[cut:], True
        else:
            parts_after.append(comments)
    if rnd.random() < 0.85 * busy:
        inner = rnd.choice((f"&copy; {short(9)}", f"<p>{short(14)}</p><ul>{links(4)}</ul>"))
        parts_after.append(_tagged(rnd, "footer", TOKENS["footer"], inner, made=0.1, bare=0.3) if rnd.random() < 0.6 else _tagged(rnd, "div", TOKENS["footer"], inner))
    inside = "".join([*parts_before, article, *parts_after])
    for chance in (0.3, 0.15):
        if rnd.random() < chance:
            inside = f'<div class="{rnd.choice(("wrapper", "container", "site", _made_name(rnd)))}">{inside}</div>' if rnd.random() < 0.7 else f"<div>{inside}</div>"
    if rnd.random() < 0.03 and not inside_comments:
        inside = f"<form>{inside}</form>"
    top = rnd.random()
    if top < 0.06:
        return inside
    return f"<html><head><title>{short(6)}</title></head><body>{inside}</body></html>" if top < 0.9 else f"<html><body>{inside}</body></html>"


MARK = "\ue000"


def train(pages: list[str | None], seed: int = 7) -> Trees:
    """Trees from the pages' plain nodes and from their paragraphs in other layouts."""
    rnd, xs, ys = random.Random(seed), [], []

    def add(page: Page, labels) -> None:
        nodes = Nodes(page)
        y = node_labels(nodes, labels)
        xs.append(nodes.features()[y >= 0])
        ys.append(y[y >= 0])

    spare = ["One two three four five six seven.", "Eight nine ten eleven twelve, thirteen fourteen.", "Fifteen."]
    for html in [*pages, None]:
        page = Page(html.replace(MARK, "") if html else html)
        labels = plain_labels(page)
        if any(v == 1 for v in labels):
            add(page, labels)
        paragraphs = [t for t, v in zip(page.run_text, labels) if v == 1] or spare
        for _ in range(VARIANTS):
            made = layout(paragraphs[:PARAGRAPHS], rnd)
            other = Page(made)
            marked = [1 if MARK in t else 0 for t in other.run_text]
            other.run_text = [t.replace(MARK, "") or "x" for t in other.run_text]
            add(other, marked)
    return Trees(rounds=80, depth=5, share=0.4).fit(np.concatenate(xs), np.concatenate(ys))


def fit(pages: DataFrame, html: str = "html", key: str = "page_id", sample: int = SAMPLE) -> Trees:
    """Train on a seeded sample of about ``sample`` pages, in one task."""
    ship(pages.sparkSession)
    h = F.xxhash64(F.col(f"`{key}`"), F.col(f"`{html}`"), F.lit(7))
    n = max(1, pages.count())
    # equal pages under one key are one example
    few = pages.select(h.alias("h"), F.col(f"`{html}`").alias("html")).where(drawn(F.col("h"), sample / n)).groupBy("h").agg(F.min("html").alias("html"))

    def learn(batches):
        frames = [b for b in batches if len(b)]
        own = pd.concat(frames).sort_values(["h", "html"])["html"].tolist() if frames else []
        yield pd.DataFrame({"trees": [pickle.dumps(train([x if isinstance(x, str) else None for x in own]))]})

    row = few.repartition(1).mapInPandas(learn, "trees binary").first()
    return pickle.loads(row["trees"]) if row else train([])


def main_text(df: DataFrame, trees: Trees, html: str = "html", passed: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``passed`` columns and text, in one narrow pass."""
    shared = df.sparkSession.sparkContext.broadcast(trees)
    of = lambda pages: (pa.array(texts_of(pages, shared.value), pa.string()),)
    return map_texts(df, html, passed, [T.StructField("text", T.StringType())], of)
