"""Secret scans by assignment-aware lexing.

A text is lexed as source or configuration: targets (``name``, ``"name"``, ``a.b``,
``a["b"]``, ``--name``, ``<name>``), what assigns to them (``=``, ``:=``, ``=>``, ``:``) and
values: strings in single, double, back and triple quotes, with escapes and prefixes, bare
words, strings joined by ``+`` or side by side, arguments of calls, block scalars, and
containers (brackets, or deeper lines), whose names stand before the names inside them.  A
function's or a scheme's name (``b64decode(``, ``Bearer``) is no value.

A literal assigned to one name and passed on by that name to another, above or below, alone
or joined to others, is followed (constant propagation), so that it is judged by every name
it reaches.  A literal counts when a sensitive name reaches it and it looks like a key: long,
mixed and no placeholder.  Three base patterns (assignment to a telling name, access key,
hexadecimal run) are always reported; the lexer adds spans of kind ``literal``.

Defined cases: a null or empty text has no spans; texts are read whole; equal texts get
equal spans; a string that isn't closed in its line is none; brackets that aren't closed hold
nothing; extra columns are passed on only if named; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts

#: The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "literal")
MIN_ASSIGN, MIN_ACCESS, MIN_LITERAL = 8, 16, 8

#: How much a part of a name tells, by its words.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 1.0, "apikey": 1.0,
    "credential": 1.0, "credentials": 1.0, "bearer": 1.0, "authorization": 0.9, "auth": 0.8, "signature": 0.7,
    "private": 0.6, "access": 0.5, "api": 0.4, "key": 0.5, "pass": 0.8, "salt": 0.6, "session": 0.5, "cookie": 0.6,
}
PLACEHOLDER = re.compile(r"example|changeme|your|placeholder|x{4,}|\*{3,}|dummy|sample|redacted|^(?:true|false|none|null|undefined|todo)$", re.I | re.A)
#: A placeholder's words make up this share of a value at least.
PLACEHOLDER_SHARE = 0.15
#: Names inside a container that say nothing themselves; others count with a share of the container's.
GENERIC = frozenset("value val data content default text string raw plain current prod production live dev test".split())
CONTAINER_SHARE = 0.4
#: A name starts at the first letter of its run, so that each run is read once.
_NAME = r"[^\W\d][\w.-]*+"
_SUBSCRIPT = r"""(?P<sub>(?:\[[ \t]*+(?:"[^"\n]*+"|'[^'\n]*+'|[\w.$-]++)[ \t]*+\])*+)"""
HEAD = re.compile(
    rf"""(?:"(?P<dq>{_NAME})"|'(?P<sq>{_NAME})'|(?<![\w.-])(?:[.-]|\d\w*+)*+(?P<bare>{_NAME}){_SUBSCRIPT})[ \t]*+(?P<op>:=|=>|=(?!=)|:(?!:))[ \t]*+"""
)
STRING = re.compile(
    r'(?:[rRbBuUfF]{1,2}+(?=["\']))?(?:"""(?P<td>.*?)"""|\'\'\'(?P<ts>.*?)\'\'\'|"(?P<d>(?:[^"\\\n]|\\.)*+)"|\'(?P<s>(?:[^\'\\\n]|\\.)*+)\'|`(?P<k>(?:[^`\\\n]|\\.)*+)`)', re.S
)
BARE = re.compile(r"[$]?[{]?[A-Za-z0-9_+/.=~-]++")
SCHEME = re.compile(r"(?:bearer|basic|token|digest|apikey)[ \t]++(?=[A-Za-z0-9_+/.=~-]{8})", re.I | re.A)
JOIN, NEXT_TO = re.compile(r"[ \t]*+\+[ \t]*+\n?[ \t]*+"), re.compile(r"[ \t]++(?=[\"'])")
BLOCK = re.compile(r"[|>][0-9+-]{0,2}+[ \t]*+\n")
REST_EMPTY = re.compile(r"(?:#[^\n]*+)?\n")
GETTER = re.compile(r"(?:get|env|environ|read|load|find|lookup|input|prompt|fetch|ask|open|import|require|log|print|warn|error|format|join|path|route|url)", re.I | re.A)
LOOKS_LIKE_NAME = re.compile(r"[A-Za-z_.-]++")
BRACKETS = {")": "(", "]": "[", "}": "{"}
#: Read by itself, since the value of an option may hold pairs (``--header "Token: x"``); another option is no value.
FLAG = re.compile(
    r"""(?<![\w.-])--(?P<bare>[A-Za-z_][\w.-]*+)[ \t]++(?!=|--|-[A-Za-z-]*+(?![A-Za-z0-9_+/.=~]))"""
    r"""(?:"(?P<d>[^"\n]*+)"|'(?P<s>[^'\n]*+)'|(?P<b>[$]?[{]?[A-Za-z0-9_+/.=~-]++))""",
    re.A,
)
ELEMENT = re.compile(r"<([A-Za-z_][\w.-]*+)>[ \t]*+([^<>\s]{8,}+)[ \t]*+</\1>", re.A)
SPLIT = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+", re.A)
IDENTIFIER = re.compile(r"[$]?[{]?([A-Za-z_][\w.]*)", re.A)
THRESHOLD = 0.75


def name_score(name: str) -> float:
    """0 to 1: how strongly a target name says that its value is secret."""
    parts = [p.lower() for p in SPLIT.findall(name)]
    return min(1.0, sum(SENSITIVE.get(p, SENSITIVE.get(p[:-1], 0.0) if p.endswith("s") else 0.0) for p in parts))


def told_score(around: float, key: str) -> float:
    """A key's score with a share of its container's, all of it if the key says nothing."""
    own = name_score(key)
    share = 1.0 if key.rsplit(".", 1)[-1].lower() in GENERIC else CONTAINER_SHARE
    return min(1.0, own + share * around)


def literal_score(value: str) -> float:
    """0 to 1: length, mixed classes and entropy of a literal; 0 for placeholders and prose.  Blanks
    are let pass where the words between hold digits and three classes of characters."""
    blank = re.search(r"\s", value)
    if len(value) < MIN_LITERAL or sum(len(m[0]) for m in PLACEHOLDER.finditer(value)) > PLACEHOLDER_SHARE * len(value):
        return 0.0
    text = re.sub(r"\s+", "", value) if blank else value
    n = Counter(text)
    entropy = -sum(c / len(text) * math.log2(c / len(text)) for c in n.values()) if text else 0.0
    classes = sum(bool(re.search(p, text)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    if blank and (classes < 3 or sum(c.isdigit() for c in text) * 8 < len(text)):
        return 0.0
    return min(1.0, entropy / 4.0) * (0.55 if classes < 2 else 1.0) * min(1.0, len(text) / 12)


class Pair:
    """One part of an assignment's value: its target, the part, the whole value's literals."""

    __slots__ = ("name", "score", "value", "start", "end", "quoted", "group", "whole")

    def __init__(self, name, score, value, start, end, quoted, group, whole=None):
        self.name, self.score, self.value, self.start, self.end, self.quoted, self.group, self.whole = name, score, value, start, end, quoted, group, value if whole is None else whole


class Brackets:
    """Brackets of a text outside its strings: where each one is closed, and what it holds."""

    def __init__(self, text: str):
        self.closes: dict[int, int] = {}
        self.strings: dict[int, list] = {}      # opener -> (text, start, end) of strings right inside
        self.inner: dict[int, list[int]] = {}   # opener -> openers right inside
        stack: list[int] = []
        for m in _OUTSIDE.finditer(text):
            if m.lastgroup:
                if stack:
                    self.strings.setdefault(stack[-1], []).append((m[m.lastgroup], *m.span(m.lastgroup)))
                continue
            c = m[0]
            if c in "([{":
                if stack:
                    self.inner.setdefault(stack[-1], []).append(m.start())
                stack.append(m.start())
                continue
            for k in range(len(stack) - 1, max(-1, len(stack) - 4), -1):    # a stray opener or two is passed over
                if text[stack[k]] == BRACKETS[c]:
                    self.closes[stack[k]] = m.start()
                    del stack[k:]
                    break

    def held(self, opener: int, depth: int = 3) -> list:
        """Strings in a closed bracket, and in those inside it down to a depth."""
        if opener not in self.closes:
            return []
        out = list(self.strings.get(opener, ()))
        for k in self.inner.get(opener, ()) if depth > 1 else ():
            out += self.held(k, depth - 1)
        return out


_OUTSIDE = re.compile(STRING.pattern + r"|[()\[\]{}]", re.S)


def _string(text: str, at: int):
    """(text, start, end, behind) of the string at a place."""
    m = STRING.match(text, at)
    if m is None:
        return None
    k = m.lastgroup
    return m[k], *m.span(k), m.end()


def pairs(text: str) -> list[Pair]:
    """The parts of all assignments of a text, in order of their places."""
    out, brackets, held, lines = [], None, [], []
    at, group = 0, 0
    line = 0       # start of the line that the last head stands in

    while m := HEAD.search(text, at):
        at = m.end()
        key = m["dq"] or m["sq"] or m["bare"]
        name = key
        container = ""
        if m["sub"]:
            parts = re.findall(r"""["']?([^\["'\]]++)["']?[ \t]*+\]""", m["sub"])
            if parts:
                container, key = ".".join([key, *parts[:-1]]), parts[-1]
                name = f"{container}.{key}"
        # containers around: brackets that are still open here, lines that this one is deeper than
        while held and held[-1][1] < m.start():
            held.pop()
        nl = text.rfind("\n", line, m.start()) + 1
        line = max(line, nl)
        indent = m.start() - line if text[line:m.start()].strip(" \t-") == "" else None
        if indent is not None:
            while lines and lines[-1][0] >= indent:
                lines.pop()
        around = max(held[-1][2] if held else 0.0, lines[-1][1] if lines else 0.0, name_score(container) if container else 0.0)
        score = told_score(around, key)
        group += 1
        c = text[at:at + 1]
        values = []     # (text, start, end, quoted)
        if c in ("{", "[", "("):
            brackets = brackets or Brackets(text)
            if at in brackets.closes:
                close = brackets.closes[at]
                if c != "(":
                    held.append((at, close, score))
                inner = at + 1
                while c != "{" and inner < close:      # strings that are elements themselves
                    inner = _SPACES.match(text, inner).end()
                    s = _string(text, inner)
                    if s is None or s[3] > close:
                        break
                    after = _SPACES.match(text, s[3]).end()
                    if text[after:after + 1] not in (",", "]", ")"):
                        break
                    values.append((s[0], s[1], s[2], True))
                    inner = after + 1
                for v in values:
                    out.append(Pair(name, score, *v, group))
            at += 1
            continue
        if m["op"] == ":" and (b := BLOCK.match(text, at)) and indent is not None:
            k = b.end()
            while k < len(text):
                end = text.find("\n", k)
                end = len(text) if end < 0 else end
                row = text[k:end]
                if row.strip() and len(row) - len(row.lstrip(" \t")) <= indent:
                    break
                if row.strip():
                    first = k + len(row) - len(row.lstrip(" \t"))
                    values.append((row.strip(), first, first + len(row.strip()), True))
                k = end + 1
            for v in values:
                out.append(Pair(name, score, *v, group))
            at = min(k, len(text))
            continue
        if m["op"] == ":" and indent is not None and REST_EMPTY.match(text, at):
            lines.append((indent, score))
            continue
        scheme = SCHEME.match(text, at)
        where, behind = scheme.end() if scheme else at, None
        while True:
            s = _string(text, where)
            if s is not None:
                values.append((s[0], s[1], s[2], True))
                where = behind = s[3]
            else:
                b = BARE.match(text, where)
                if b is None:
                    break
                follows = text[b.end():b.end() + 1]
                if follows == "(":      # a call: its strings are what counts
                    brackets = brackets or Brackets(text)
                    if not GETTER.search(b[0].rsplit(".", 1)[-1]):
                        values += [(*x, True) for x in brackets.held(b.end()) if not LOOKS_LIKE_NAME.fullmatch(x[0])]
                    behind = where = b.end() if behind is None else behind
                    break
                if follows == "[" or b[0] in ("+", "-", "=", "."):
                    behind = where = b.end()
                    break
                values.append((b[0], *b.span(), False))
                where = behind = b.end()
            j = JOIN.match(text, where) or (NEXT_TO.match(text, where) if values[-1][3] and m["op"] != ":" else None)
            if j is None:
                break
            where = j.end()
        whole = "".join(v[0] for v in values if v[3]) if sum(v[3] for v in values) > 1 else None
        for v in values:
            out.append(Pair(name, score, *v, group, whole if v[3] else None))
        at = max(at, behind or at)
    for m in FLAG.finditer(text) if "--" in text else ():
        kind = "d" if m["d"] is not None else "s" if m["s"] is not None else "b"
        group += 1
        out.append(Pair(m["bare"], name_score(m["bare"]), m[kind], *m.span(kind), kind != "b", group))
    for m in ELEMENT.finditer(text):
        group += 1
        out.append(Pair(m[1], name_score(m[1]), m[2], *m.span(2), True, group))
    return sorted(out, key=lambda p: p.start)


_SPACES = re.compile(r"\s*+")


def literals(text: str) -> list[tuple[int, int]]:
    """Spans of literals that a sensitive name reaches.

    A name passed on stands for its latest assignment above, or, if there is none, for
    all those below."""
    if "=" not in text and ":" not in text and "</" not in text and "--" not in text:
        return []
    found = pairs(text)
    wanted = [None if p.quoted else IDENTIFIER.fullmatch(p.value.rstrip("}")) for p in found]
    wanted = [m and m[1] for m in wanted]
    given: dict[str, list[int]] = {}
    groups: dict[int, list[int]] = {}
    for k, p in enumerate(found):
        given.setdefault(p.name, []).append(k)
        groups.setdefault(p.group, []).append(k)
    above: dict[int, list[int]] = {}
    last: dict[str, list[int]] = {}
    for own in groups.values():
        for k in own:
            if wanted[k] in last:
                above[k] = last[wanted[k]]
        last[found[own[0]].name] = own
    below = {k: w for k, w in enumerate(wanted) if k not in above and w in given}

    users: dict[int | str, list[int]] = {}  # a part, or a name -> those that take its value
    for k, js in above.items():
        for j in js:
            users.setdefault(j, []).append(k)
    for k, w in below.items():
        users.setdefault(w, []).append(k)

    def mark(first: list[int]) -> None:
        todo = first
        while todo:
            k = todo.pop()
            if k not in grounded:
                grounded.add(k)
                todo += users.get(k, []) + users.pop(found[k].name, [])

    grounded: set[int] = set()  # what leads to a literal; the others name only each other
    mark([k for k in range(len(found)) if k not in above and k not in below])
    for k in list(below):
        if k not in grounded:
            del below[k]
            mark([k])

    score = [0.0] * len(found)
    seen: set[str] = set()
    for s, start in sorted(((p.score, k) for k, p in enumerate(found)), reverse=True):
        todo = [start]
        while todo:
            k = todo.pop()
            if score[k] >= s:
                continue
            score[k] = s
            if k in above:
                todo += above[k]
            elif k in below and below[k] not in seen:
                seen.add(below[k])
                todo += given[below[k]]
    joined: dict[int, str] = {}     # literals that an assignment puts together from several names
    for own in groups.values():
        if len(own) > 1 and any(k in above for k in own):
            text_of = "".join("".join(found[j].value for j in above[k]) if k in above else found[k].value for k in own)
            for k in own:
                for j in above.get(k, [k]):
                    joined[j] = text_of
    out = set()
    for k, p in enumerate(found):
        if k not in above and k not in below and score[k]:
            own = max(literal_score(p.whole), literal_score(joined[k]) if k in joined else 0.0)
            if 0.5 * score[k] + 0.5 * own >= THRESHOLD and own >= 0.4 and p.end > p.start:
                out.add((p.start, p.end))
    return sorted(out)


def spans(text: str | None) -> list[tuple[str, int, int, int, int]]:
    """(kind, start, end, secret's start, secret's end), code points, by start and kind."""
    if not text:
        return []
    found = []
    if "=" in text or ":" in text:
        found += [("assign", *m.span(), *m.span(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [("access", *m.span(), *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [("hex", *m.span(), *m.span()) for m in HEX.finditer(text)]
    base = [(a, b) for _, a, b, _, _ in found]
    found += [("literal", a, b, a, b) for a, b in literals(text) if not any(c <= a and b <= d for c, d in base)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


SPAN = T.StructType([T.StructField("kind", T.StringType()), *[T.StructField(n, T.IntegerType()) for n in ("start", "end", "secret_start", "secret_end")]])


def _arrays(texts):
    rows = [spans(t) for t in texts]
    flat = [s for r in rows for s in r]
    offsets, n = [0], 0
    for r in rows:
        n += len(r)
        offsets.append(n)
    columns = list(zip(*flat)) or [()] * 5
    kinds = [pa.string(), *[pa.int32()] * 4]
    structs = pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.name for f in SPAN])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs)


def scan(df: DataFrame, text: str = "text", passed: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``passed`` columns and spans (array of kind, start, end, secret_start, secret_end)."""
    return map_texts(df, text, passed, [T.StructField("spans", T.ArrayType(SPAN))], lambda texts: (_arrays(texts),))


def hide(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every secret replaced; overlapping ones count as one."""
    at, out = 0, []
    for a, b in sorted((s[3], s[4]) for s in spans(text)):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return "".join([*out, text[at:]]) if out else text


def redact(df: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``df`` with its secrets hidden in place; other columns stay as they are, a column
    ``n_chars`` follows the new text."""
    rest = tuple(c for c in df.columns if c != text)
    new = map_texts(df, text, rest, [T.StructField("__hidden", T.StringType())], lambda texts: (pa.array([hide(t, mark) for t in texts], pa.string()),))
    out = new.withColumnRenamed("__hidden", text) if not rest else new.select(*[F.col("__hidden").alias(text) if c == text else F.col(f"`{c}`") for c in df.columns])
    if "n_chars" in df.columns and text != "n_chars":
        kind = df.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length(F.col(f"`{text}`")).cast(kind), F.col("n_chars")))
    return out
