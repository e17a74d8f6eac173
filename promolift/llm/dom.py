"""A forgiving reader of HTML into a tree of block elements and their text runs.

Unclosed and stray tags are taken as browsers take them in the common cases: a paragraph
ends where the next block begins, list items and cells end each other, end tags without
a start are passed over, what is open at the end is closed.  The head ends at the first
tag or text that can't stand in it.  Scripts, styles and other raw elements, comments and
the head give no text.  Nor do buttons, drawings, players and the like up to their end
tag; one that isn't closed inside its block gives none up to the next start or end of a
block.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

#: Element kinds of HTML.
BLOCKS = frozenset((
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "tfoot thead tr ul"
).split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SPACED = frozenset("br td th img input option wbr".split())
ENDS_ITSELF = {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr", ("table",))}
HEADING = re.compile("h[1-6]")
#: Text up to their end tag; elements that give no text; where SVG and MathML go back to HTML; what ends them.
RAW = "script|style|title|textarea|iframe"
DROPPED = frozenset("audio button canvas math noscript object select svg template video".split())
NOT_NESTED = frozenset(("button", "select"))
FOREIGN = frozenset(("svg", "math"))
INNER = frozenset("annotation-xml desc foreignobject mi mn mo ms mtext title".split())
BREAKS_OUT = BLOCKS | frozenset("b big br code em embed i img nobr ruby s small span strike strong sub sup tt u var".split())
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
ENDS_HEAD = frozenset("body br head html".split())
_TAG = (
    r"|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/><]*+)((?:[^>\"'<]|\"[^\"<]*\"|'[^'<]*')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
)
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(" + RAW + r")(?=[\s/>])[^>]*>.*?(?:</\1(?=[\s/>])[^>]*>|\Z)" + _TAG, re.S | re.I)
#: Inside SVG and MathML, where no element is raw.
FOREIGN_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)" + _TAG, re.S | re.I)
ATTRIBUTE = re.compile(r"""\b(?:class|id|role|itemprop|itemtype|aria-label|data-component)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def tokens_of(html: str) -> tuple[list[tuple], dict[int, tuple[int, int]]]:
    """Tokens (from, to, raw element, name, end tag, attributes) of a page, and for each
    dropped element that is closed inside its block: its token -> the token and the place
    at which the page goes on."""
    out, closed, stack, opened = [], {}, [], Counter()
    at, last, regex = 0, html.rfind(">") + 1, TOKEN

    def pop(name: str) -> int:
        while True:
            top, k = stack.pop()
            opened[top] -= 1
            if top == name:
                return k

    while m := regex.search(html, at, last):
        at = m.end()
        name = (m[3] or m[6] or "").lower()
        end, attributes = (m[2] or m[5]) == "/", m[4] or m[7]
        out.append((m.start(), at, m[1], name, end, attributes))
        if not name:
            continue
        if end:
            key = "h" if HEADING.fullmatch(name) else name
            if opened[key]:
                k = pop(key)
                if name in DROPPED:
                    closed[k] = len(out), at
        else:
            foreign = regex is FOREIGN_TOKEN
            while foreign and name in BREAKS_OUT and stack and stack[-1][0] in FOREIGN:
                closed[pop(stack[-1][0])] = len(out) - 1, m.start()
            if name in NOT_NESTED and opened[name]:
                pop(name)
            if name in FOREIGN and attributes and attributes.endswith("/"):
                closed[len(out) - 1] = len(out), at
            elif name in DROPPED or name in BLOCKS and name not in VOID or foreign and name in INNER and not (attributes and attributes.endswith("/")):
                key = "h" if HEADING.fullmatch(name) else name
                stack.append((key, len(out) - 1))
                opened[key] += 1
        regex = FOREIGN_TOKEN if stack and stack[-1][0] in FOREIGN else TOKEN
    return out, closed


class Page:
    """Block elements in page order (``tag``, ``parent``, ``names``: attribute tokens) and
    text runs (``run_node``, ``run_text``, ``run_link``: characters inside links)."""

    __slots__ = ("tag", "parent", "names", "run_node", "run_text", "run_link", "inline")

    def __init__(self, html: str | None):
        self.tag, self.parent, self.names, self.inline = ["#root"], [-1], [()], [0]
        self.run_node, self.run_text, self.run_link = [], [], []
        if html:
            self._read(html)

    def _read(self, html: str) -> None:
        tag, parent, stack = self.tag, self.parent, [0]
        held, linked, depth, in_head, dropping, at, after = [], 0, 0, False, "", 0, 0
        tokens, closed = tokens_of(html)

        def text(part: str) -> None:
            nonlocal linked, in_head
            if in_head and part.strip():
                in_head = False
            if part and not in_head and not dropping:
                part = unescape(part) if "&" in part else part
                held.append(part)
                if depth:
                    linked += len(part)

        def close_run() -> None:
            nonlocal held, linked
            if held:
                words = "".join(held).split()
                if words:
                    self.run_node.append(stack[-1])
                    self.run_text.append(" ".join(words))
                    self.run_link.append(min(linked, sum(map(len, words))))
                held, linked = [], 0

        for k, (start, to, raw, name, end, attributes) in enumerate(tokens):
            if k < after:
                continue
            text(html[at:start])
            at = to
            if not name:
                if raw:
                    in_head = in_head and raw.lower() in IN_HEAD
                    held.append(" ")
                continue
            if name == "head":
                in_head = not end
                continue
            if in_head and (name in ENDS_HEAD if end else name not in IN_HEAD):
                in_head = False
            if name in DROPPED and not end:
                held.append(" ")
                if name in NOT_NESTED and name == dropping:
                    dropping = ""
                if k in closed:
                    after, at = closed[k]
                else:
                    dropping = dropping or name
                continue
            if name not in BLOCKS:
                if name == "a":
                    depth = 0 if end else 1
                elif name in SPACED:
                    held.append(" ")
                self.inline[stack[-1]] += not end
                continue
            close_run()
            depth, dropping = 0, ""
            if end:
                for k in range(len(stack) - 1, 0, -1):
                    if tag[stack[k]] == name or HEADING.fullmatch(name) and HEADING.fullmatch(tag[stack[k]]):
                        del stack[k:]
                        break
                continue
            if tag[stack[-1]] == "p" or HEADING.fullmatch(tag[stack[-1]]) and HEADING.fullmatch(name):
                del stack[-1]
            if name in ENDS_ITSELF:
                own, limits = ENDS_ITSELF[name]
                for k in range(len(stack) - 1, 0, -1):
                    if tag[stack[k]] in limits:
                        break
                    if tag[stack[k]] in own.split():
                        del stack[k:]
                        break
            if name in ("html", "body") and name in tag:
                continue
            tag.append(name)
            parent.append(stack[-1])
            self.inline.append(0)
            self.names.append(tuple(p.lower() for v in ATTRIBUTE.findall(attributes) for p in PART.findall(v[0] or v[1] or v[2])) if attributes and "=" in attributes else ())
            if name not in VOID:
                stack.append(len(tag) - 1)
        text(html[at:])
        close_run()
