"""License scans by ordered signature rules, in Spark expressions only.

A text without a keyword is settled by one pattern match.  For the others the words are
listed, each anchor word (``license``, ``gpl``, ...) is put in a window of the words
around it, and the rules of that anchor are matched against the window, where the anchor
is marked with ``@`` so that a match belongs to one place.  A match is suppressed where
another one contains its interval, or covers the same interval with a higher priority.
Three base phrases are counted at every place and always keep their labels.

Rules are names of licenses, which phrases that introduce them make heavier; the short
identifiers of SPDX tags, also further ones of an expression; and sentences of license
texts, notices and copyright lines.  There is no shuffle, and the work per anchor is bounded by the window.

Defined cases: a null or empty text has no words and no labels, score 0; texts are read
whole; equal texts get equal results; extra columns are passed on only if named; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

#: Words, and base phrases with their labels.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

KEYWORDS = (
    r"(?i)licen[sc]|copyright|spdx|[al]?gpl|gnu|creative[\W_]+commons|(?<![a-z0-9])cc[\W_]+by(?![a-z0-9])|(?<![a-z0-9])cc0(?![a-z0-9])|public[\W_]+domain|all[\W_]+rights[\W_]+reserved"
    r"|hereby[\W_]+grant|redistribution[\W_]+and|redistribute[\W_]+it|unencumbered|noninfringement|non[\W_]+infringement|substantial[\W_]+portions|software[\W_]+is[\W_]+provided|endorse[\W_]+or"
    r"|advertising[\W_]+materials|altered[\W_]+source|software[\W_]+without[\W_]+restriction|is[\W_]+basis|in[\W_]+compliance[\W_]+with|with[\W_]+the[\W_]+distribution|intent[\W_]+of[\W_]+this[\W_]+document|whatever[\W_]+you[\W_]+want"
)

_V = r"(?: version)?"
#: (label, anchor word, name as a pattern with the anchor marked, weight)
NAMES = (
    ("mit", "license", r"(?:mit|expat|x11) @license", 0.9),
    ("mit-0", "license", r"mit no attribution @license", 0.9),
    ("apache", "license", r"apache(?: software)? @license", 0.8),
    ("apache-1.1", "license", rf"apache(?: software)? @license{_V} 1 1", 0.95),
    ("apache-2.0", "license", rf"apache(?: software)? @license{_V} 2(?: 0)?", 0.95),
    ("gpl", "license", r"(?:gnu )?general public @license", 0.8),
    ("gpl-2.0", "license", rf"(?:gnu )?general public @license{_V} 2(?: 0)?", 0.95),
    ("gpl-3.0", "license", rf"(?:gnu )?general public @license{_V} 3(?: 0)?", 0.95),
    ("gpl", "gpl", r"(?:gnu )?@gpl", 0.7),
    ("gpl-2.0", "gpl", rf"(?:gnu )?@gpl{_V}(?: v)? ?2(?: 0)?", 0.9),
    ("gpl-3.0", "gpl", rf"(?:gnu )?@gpl{_V}(?: v)? ?3(?: 0)?", 0.9),
    ("gpl-2.0", "gplv2", r"(?:gnu )?@gplv2", 0.9),
    ("gpl-3.0", "gplv3", r"(?:gnu )?@gplv3", 0.9),
    ("gpl", "gnu", r"@gnu general(?: public)?", 0.6),
    ("lgpl", "license", r"(?:gnu )?(?:lesser|library) general public @license", 0.85),
    ("lgpl-2.1", "license", rf"(?:gnu )?(?:lesser|library) general public @license{_V} 2 1", 0.95),
    ("lgpl-3.0", "license", rf"(?:gnu )?lesser general public @license{_V} 3(?: 0)?", 0.95),
    ("lgpl", "lgpl", r"(?:gnu )?@lgpl", 0.7),
    ("lgpl-2.1", "lgpl", rf"(?:gnu )?@lgpl{_V}(?: v)? ?2 1", 0.9),
    ("lgpl-3.0", "lgpl", rf"(?:gnu )?@lgpl{_V}(?: v)? ?3(?: 0)?", 0.9),
    ("agpl", "license", r"(?:gnu )?affero general public @license", 0.85),
    ("agpl-3.0", "license", rf"(?:gnu )?affero general public @license{_V} 3(?: 0)?", 0.95),
    ("agpl", "agpl", r"(?:gnu )?@agpl", 0.7),
    ("agpl-3.0", "agpl", rf"(?:gnu )?@agpl{_V}(?: v)? ?3(?: 0)?", 0.9),
    ("gfdl", "license", r"(?:gnu )?free documentation @license", 0.9),
    ("mpl", "license", r"mozilla public @license", 0.85),
    ("mpl-1.1", "license", rf"mozilla public @license{_V} 1 1", 0.95),
    ("mpl-2.0", "license", rf"mozilla public @license{_V} 2(?: 0)?", 0.95),
    ("epl", "license", r"eclipse public @license", 0.85),
    ("epl-1.0", "license", rf"eclipse public @license{_V} 1(?: 0)?", 0.95),
    ("epl-2.0", "license", rf"eclipse public @license{_V} 2(?: 0)?", 0.95),
    ("eupl", "licence", r"european union public @licence", 0.9),
    ("cddl", "license", r"common development and distribution @license", 0.9),
    ("cpl-1.0", "license", r"common public @license", 0.9),
    ("bsd", "license", r"(?:modified |new |simplified |revised |berkeley )?bsd(?: style)? @license", 0.85),
    ("bsd-2-clause", "license", r"(?:bsd )?(?:2|two) clause(?: bsd)? @license", 0.95),
    ("bsd-3-clause", "license", r"(?:bsd )?(?:3|three) clause(?: bsd)? @license", 0.95),
    ("0bsd", "license", r"(?:zero clause|0) ?bsd @license", 0.95),
    ("isc", "license", r"isc @license", 0.9),
    ("zlib", "license", r"zlib(?: libpng)? @license", 0.9),
    ("boost", "license", r"boost software @license", 0.9),
    ("artistic", "license", r"artistic @license", 0.85),
    ("artistic-2.0", "license", rf"artistic @license{_V} 2(?: 0)?", 0.95),
    ("wtfpl", "license", r"do what the \w+ you want to public @license", 0.95),
    ("python", "license", r"python(?: software foundation)? @license", 0.85),
    ("php", "license", r"php @license", 0.85),
    ("ofl-1.1", "license", r"(?:sil )?open font @license", 0.9),
    ("odbl", "license", r"open (?:data commons )?database @license", 0.9),
    ("postgresql", "license", r"postgresql @license", 0.9),
    ("openssl", "license", r"openssl @license", 0.85),
    ("unlicense", "unlicense", r"(?:the )?@unlicense", 0.9),
    ("cc-by", "commons", r"creative @commons attribution(?: licen[sc]e)?", 0.85),
    ("cc-by-sa", "commons", r"creative @commons attribution share ?alike", 0.9),
    ("cc-by-nc", "commons", r"creative @commons attribution non ?commercial", 0.9),
    ("cc-by-nd", "commons", r"creative @commons attribution no ?deriv(?:ative)?s?", 0.9),
    ("cc-by-nc-sa", "commons", r"creative @commons attribution non ?commercial share ?alike", 0.95),
    ("cc-by-nc-nd", "commons", r"creative @commons attribution non ?commercial no ?deriv(?:ative)?s?", 0.95),
    ("cc0", "commons", r"creative @commons zero", 0.9),
    ("cc", "commons", r"creative @commons(?: licen[sc]e)?", 0.6),
    ("cc0", "cc0", r"@cc0(?: 1 0)?", 0.9),
    ("cc-by", "cc", r"@cc by(?: \d \d)?", 0.85),
    ("cc-by-sa", "cc", r"@cc by sa(?: \d \d)?", 0.9),
    ("cc-by-nc", "cc", r"@cc by nc(?: \d \d)?", 0.9),
    ("cc-by-nd", "cc", r"@cc by nd(?: \d \d)?", 0.9),
    ("cc-by-nc-sa", "cc", r"@cc by nc sa(?: \d \d)?", 0.95),
    ("cc-by-nc-nd", "cc", r"@cc by nc nd(?: \d \d)?", 0.95),
    ("public-domain", "domain", r"(?:in|into|to) the public @domain", 0.7),
    ("proprietary", "reserved", r"all rights @reserved", 0.5),
)
#: (phrase before a name, priority, added weight)
LEADS = (
    ("", 1, 0.0),
    (r"(?:licen[sc]ed|released|distributed|published|available|provided|dual licensed) under (?:the )?(?:terms of )?(?:the )?", 3, 0.1),
    (r"(?:subject to|covered by|governed by|in accordance with) (?:the )?(?:terms of )?(?:the )?", 2, 0.05),
)
#: (label, short identifier as a pattern), as they stand after SPDX-License-Identifier
IDS = (
    ("mit", "mit"), ("mit-0", "mit 0"), ("x11", "x11"), ("apache-1.1", "apache 1 1"), ("apache-2.0", "apache 2 0"),
    *((f"{g}gpl-{v}", f"{g}gpl {v[0]} {v[2]}(?: only| or later)?") for g, v in (("", "1.0"), ("", "2.0"), ("", "3.0"), ("l", "2.0"), ("l", "2.1"), ("l", "3.0"), ("a", "1.0"), ("a", "3.0"))),
    ("gfdl", r"gfdl 1 \d(?: only| or later)?"), ("mpl-1.1", "mpl 1 1"), ("mpl-2.0", "mpl 2 0"), ("epl-1.0", "epl 1 0"), ("epl-2.0", "epl 2 0"),
    ("eupl", r"eupl 1 \d"), ("cddl", r"cddl 1 \d"), ("cpl-1.0", "cpl 1 0"), ("bsd-1-clause", "bsd 1 clause"), ("bsd-2-clause", "bsd 2 clause"),
    ("bsd-3-clause", "bsd 3 clause"), ("bsd-4-clause", "bsd 4 clause"), ("0bsd", "0bsd"), ("isc", "isc"), ("zlib", "zlib"), ("boost", "bsl 1 0"), ("busl-1.1", "busl 1 1"),
    ("artistic", "artistic 1 0"), ("artistic-2.0", "artistic 2 0"), ("wtfpl", "wtfpl"), ("python", r"(?:python|psf) 2 \d"), ("php", r"php 3 \d+"), ("ofl-1.1", "ofl 1 1"),
    ("odbl", "odbl 1 0"), ("postgresql", "postgresql"), ("openssl", "openssl"), ("unlicense", "unlicense"), ("cc0", "cc0 1 0"),
    *((f"cc-{k.replace(' ', '-')}", rf"cc {k} \d \d") for k in ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd")),
    ("ncsa", "ncsa"), ("upl-1.0", "upl 1 0"), ("ms-pl", "ms pl"), ("osl-3.0", "osl 3 0"), ("afl-3.0", "afl 3 0"), ("ecl-2.0", "ecl 2 0"), ("hpnd", "hpnd"), ("sspl-1.0", "sspl 1 0"),
    ("zpl-2.1", "zpl 2 1"), ("cecill-2.1", "cecill 2 1"), ("mulanpsl-2.0", "mulanpsl 2 0"), ("unicode", "unicode dfs 201[56]"), ("blueoak-1.0.0", "blueoak 1 0 0"), ("beerware", "beerware"),
)
_GNU = "as published by the free software @foundation (?:either )?version"
#: (label, anchor word, sentence of a licence or notice, weight)
NOTICES = (
    ("mit", "hereby", r"permission is @hereby granted free of charge(?: to any person obtaining a copy(?: of this software)?)?", 0.8),
    ("mit", "substantial", r"permission notice shall be included in all copies or @substantial portions of the software", 0.8),
    ("mit", "restriction", r"deal in the software without @restriction", 0.8),
    ("mit", "noninfringement", r"particular purpose and @noninfringement", 0.6),
    ("ncsa", "restriction", r"deal with the software without @restriction", 0.9),
    ("boost", "hereby", r"permission is @hereby granted free of charge to any person or organization obtaining a copy", 0.9),
    ("boost", "infringement", r"particular purpose title and non @infringement", 0.8),
    ("unicode", "hereby", r"permission is @hereby granted free of charge to any person obtaining a copy of the unicode", 0.9),
    ("upl-1.0", "hereby", r"permission is @hereby granted to any person obtaining a copy of this software", 0.9),
    ("as-is", "provided", r"th(?:e|is) software is @provided as is", 0.4),
    ("isc", "hereby", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is @hereby granted", 0.9),
    ("0bsd", "hereby", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is @hereby granted the software is provided", 0.95),
    ("isc", "provided", r"the software is @provided as is and (?:the author|isc) disclaims all warranties", 0.8),
    ("hpnd", "hereby", r"permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is @hereby granted", 0.9),
    ("postgresql", "hereby", r"without fee and without a written agreement is @hereby granted", 0.9),
    ("bsd", "redistribution", r"@redistribution and use in source and binary forms(?: with or without modification)?", 0.8),
    ("bsd", "provided", r"this software is @provided by the (?:copyright holders?|regents|authors?)(?: and contributors)? as is", 0.8),
    ("bsd-2-clause", "distribution", r"materials provided with the @distribution this software is provided by", 0.9),
    ("bsd-3-clause", "endorse", r"may be used to @endorse or promote products derived from this software", 0.9),
    ("bsd-4-clause", "advertising", r"all @advertising materials mentioning features or use of this software", 0.9),
    ("apache-1.1", "endorse", r"must not be used to @endorse or promote products derived from this software", 0.8),
    ("apache", "compliance", r"you may not use this file except in @compliance with the license", 0.7),
    ("apache-2.0", "basis", r"distributed on an as is @basis without warranties or conditions of any kind", 0.9),
    ("apache-2.0", "hereby", r"each contributor @hereby grants to you a perpetual worldwide", 0.9),
    ("mpl-1.1", "basis", r"distributed on an as is @basis without warranty of any kind", 0.8),
    ("mpl-2.0", "form", r"this source code @form is subject to the terms of the mozilla public license v 2 0", 0.95),
    ("epl-1.0", "accompanying", r"the @accompanying materials are made available under the terms of the eclipse public license v(?:ersion)? ?1 0", 0.95),
    ("epl-2.0", "accompanying", r"the @accompanying materials are made available under the terms of the eclipse public license v(?:ersion)? ?2 0", 0.95),
    ("gpl", "redistribute", r"you can @redistribute it and or modify it under the terms of the gnu general public license", 0.9),
    ("lgpl", "redistribute", r"you can @redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", 0.9),
    ("agpl", "redistribute", r"you can @redistribute it and or modify it under the terms of the gnu affero general public license", 0.9),
    ("gpl-2.0", "foundation", rf"gnu general public license {_GNU} 2", 0.95),
    ("gpl-3.0", "foundation", rf"gnu general public license {_GNU} 3", 0.95),
    ("lgpl-2.1", "foundation", rf"gnu lesser general public license {_GNU} 2 1", 0.95),
    ("lgpl-3.0", "foundation", rf"gnu lesser general public license {_GNU} 3", 0.95),
    ("agpl-3.0", "foundation", rf"gnu affero general public license {_GNU} 3", 0.95),
    ("zlib", "provided", r"this software is @provided as is without any express or implied warranty", 0.9),
    ("zlib", "altered", r"@altered source versions must be plainly marked as such", 0.9),
    ("unlicense", "unencumbered", r"this is free and @unencumbered software released into the public domain", 0.95),
    ("artistic", "intent", r"the @intent of this document is to state the conditions under which a package may be copied", 0.9),
    ("beerware", "whatever", r"retain this notice you can do @whatever you want with this stuff", 0.9),
    ("copyright", "copyright", r"@copyright (?:c )?(?:19|20)\d\d", 0.3),
    *((label, "copyright", rf"@copyright (?:c )?(?:\d+ )*{holder}", 0.6) for label, holder in (
        ("bsd", "the regents of the university of california"), ("apache", "the apache software foundation"), ("mit", "massachusetts institute of technology"), ("isc", "(?:by )?internet (?:systems|software) consortium"),
        ("zlib", "jean loup gailly"), ("python", "python software foundation"), ("postgresql", "(?:the )?postgresql global development group"), ("openssl", "the openssl project"), ("php", "the php group"),
    )),
)
#: A further identifier of an expression belongs to SPDX where only identifiers stand between it and
#: the tag.  So many words are looked at first; where all of them are identifiers, the rest too.
EXPRESSION = 64
_ID_WORDS = sorted({w for _, p in IDS for w in p.replace("(?: only| or later)?", "").replace("(?:python|psf)", "python psf").split(" ")} | set("only or later and with exception classpath gcc llvm linux syscall note".split()))
_IN_EXPRESSION = rf"(?<![^ ])license identifier (?:(?:{'|'.join(_ID_WORDS)}|[0-9]+) )+$"


def _whole(pattern: str) -> str:
    return r"(?<![^ ])" + pattern + r"(?![^ ])"


def rules() -> list[tuple[str, str, str, int, float]]:
    """(label, anchor, pattern, priority, weight): names times leads, identifiers, sentences."""
    return [
        *((label, anchor, _whole(lead + name), priority, min(1.0, weight + more)) for lead, priority, more in LEADS for label, anchor, name, weight in NAMES),
        *((label, "identifier", _whole("spdx license @identifier " + name), 4, 1.0) for label, name in IDS),
        *((label, anchor, _whole(f"@{anchor} {name}"), 4, 1.0) for label, name in IDS for anchor in ("or", "and")),
        *((label, anchor, _whole(sentence), 2, weight) for label, anchor, sentence, weight in NOTICES),
    ]


def _longest(pattern: str) -> int:
    """Spaces in the longest text of a pattern of words, (?:a|b) and ?."""
    best, here, k = 0, 0, 0
    while k < len(pattern):
        if pattern.startswith("(?:", k):
            depth, end = 1, k + 3
            while depth:
                depth += {"(": 1, ")": -1}.get(pattern[end], 0)
                end += 1
            here += _longest(pattern[k + 3:end - 1])
            k = end
        elif pattern[k] == "|":
            best, here, k = max(best, here), 0, k + 1
        else:
            here += pattern[k] == " "
            k += 1
    return max(best, here)


#: Words beside an anchor that a rule can need; years of a copyright line may be several.
AROUND = max(_longest(part) for lead, *_ in LEADS for p in [*(lead + n[2] for n in NAMES), *(n[2] for n in NOTICES), *(f"spdx license @identifier {n}" for _, n in IDS)] for part in p.split("@")) + 2


#: Years of a copyright line that stay in the window; further ones are passed over.
KEPT_YEARS = 2


def _rule_table() -> Column:
    of: dict[str, list] = {}
    for a, b, c, d, e in rules():
        of.setdefault(b, []).append(F.struct(F.lit(a).alias("label"), F.lit(c).alias("pattern"), F.lit(d).alias("priority"), F.lit(e).alias("weight")))
    return F.create_map(*[x for anchor, own in of.items() for x in (F.lit(anchor), F.array(*own))])


ANCHORS = tuple(sorted({r[1] for r in rules()} - {"or", "and"}))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def places(words: Column, phrase: str) -> Column:
    """Indexes at which the phrase's words stand."""
    parts = phrase.split(" ")
    here = lambda i: _all([F.get(words, i + k) == p for k, p in enumerate(parts)])
    return F.when(F.size(words) >= len(parts), F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), here)).otherwise(F.array().cast("array<int>"))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def matches(words: Column, table: Column) -> Column:
    """Matches (label, from, to, priority, weight) of every anchor: an array of arrays."""
    def in_expression(a: Column) -> Column:
        before = F.slice(words, F.greatest(F.lit(1), a["i"] + 1 - EXPRESSION), F.least(a["i"], F.lit(EXPRESSION)))
        listed = lambda w: w.isin(*_ID_WORDS) | w.rlike("^[0-9]+$")

        def from_tag(back: Column) -> Column:   # the words before, last one first
            gap = F.array_position(back, "identifier") - 1
            return (gap > 0) & (F.get(back, gap.cast("int") + 1) == "license") & F.forall(F.slice(back, F.lit(1), F.greatest(F.lit(1), gap.cast("int"))), listed)

        long = lambda: let(F.reverse(F.slice(words, F.lit(1), a["i"])), from_tag)
        near = let(F.concat(F.array_join(before, " "), F.lit(" ")), lambda t: t.rlike(_IN_EXPRESSION))
        return near | F.when((a["i"] > EXPRESSION) & F.forall(before, listed), long()).otherwise(F.lit(False))

    numbered = F.transform(words, lambda w, i: F.struct(i.alias("i"), w.alias("w")))
    anchors = F.when(
        F.array_contains(words, "spdx"),
        F.filter(numbered, lambda a: a["w"].isin(*ANCHORS) | (a["w"].isin("or", "and") & in_expression(a))),
    ).otherwise(F.filter(numbered, lambda a: a["w"].isin(*ANCHORS)))

    def years(a: Column) -> Column:
        """Years right behind a copyright sign that a window would lose its holder to."""
        first = lambda rest: F.array_position(F.transform(rest, lambda w, k: w.rlike("^[0-9]+$") | ((k == 0) & (w == "c"))), False)
        leading = lambda rest: let(first(rest), lambda k: F.when(k > 0, k - 1).otherwise(F.size(rest)))
        near = let(F.slice(words, a["i"] + 2, EXPRESSION), leading)
        every = lambda k: F.when(k < EXPRESSION, k).otherwise(let(F.slice(words, a["i"] + 2, F.size(words)), leading))
        return F.when(a["w"] == "copyright", let(near, lambda k: F.greatest(every(k).cast("int") - KEPT_YEARS, F.lit(0)))).otherwise(F.lit(0))

    def window(a: Column, skipped: Column) -> Column:
        before = F.slice(words, F.greatest(F.lit(1), a["i"] + 1 - AROUND), F.least(a["i"], F.lit(AROUND)))
        after = F.when(skipped == 0, F.slice(words, a["i"] + 2, AROUND)).otherwise(
            F.concat(F.slice(words, a["i"] + 2, KEPT_YEARS), F.slice(words, a["i"] + 2 + KEPT_YEARS + skipped, AROUND)))
        return F.array_join(F.concat(before, F.array(F.concat(F.lit("@"), a["w"])), after), " ")

    def found(a: Column) -> Column:
        own = F.element_at(table, a["w"])
        spaces = lambda s: F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))
        hit = lambda text: F.transform(own, lambda r: F.struct(r.alias("r"), F.call_function("regexp_extract", text, r["pattern"], F.lit(0)).alias("m")))
        behind = lambda x: spaces(F.substring_index(x["m"], "@", -1))
        one = lambda skipped: lambda x: F.struct(
            x["r"]["label"].alias("label"),
            (a["i"] - spaces(F.substring_index(x["m"], "@", 1))).alias("from"),
            (a["i"] + 1 + behind(x) + F.when(behind(x) > KEPT_YEARS, skipped).otherwise(F.lit(0))).alias("to"),
            x["r"]["priority"].alias("priority"), x["r"]["weight"].alias("weight"),
        )
        return let(years(a), lambda skipped: let(window(a, skipped), lambda text: F.transform(F.filter(hit(text), lambda x: x["m"] != ""), one(skipped))))

    return F.transform(anchors, found)


def surviving(found: Column) -> Column:
    """Matches that no neighbouring match suppresses.  A containing interval holds the
    anchor too, so its own anchor is at most 2 * AROUND anchors away."""

    def keep(own: Column, k: Column) -> Column:
        near = F.flatten(F.slice(found, F.greatest(F.lit(1), k + 1 - 2 * AROUND), 4 * AROUND + 1))
        covers = lambda m: lambda o: (
            (o["from"] <= m["from"]) & (o["to"] >= m["to"])
            & ((o["to"] - o["from"] > m["to"] - m["from"]) | (o["priority"] > m["priority"]))
        )
        return let(near, lambda n: F.filter(own, lambda m: ~F.exists(n, covers(m))))

    return F.flatten(F.transform(found, keep))


def scan(df: DataFrame, text: str = "text", passed: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``passed`` columns, n_words, n_base, first_word, last_word, base_labels, labels
    (arrays), score, and matches (the surviving rule matches)."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    table, no_words = _rule_table(), F.array().cast("array<string>")
    first = df.select(
        *[F.col(f"`{c}`") for c in passed],
        F.coalesce(F.regexp_count(t, F.lit(ANY_CASE_WORD)), F.lit(0)).cast("long").alias("n_words"),
        F.when(t.rlike(KEYWORDS), words_of(t)).otherwise(no_words).alias("__w"),
    )
    w = F.col("__w")
    found = let(matches(w, table), surviving)
    second = first.select(
        *[F.col(f"`{c}`") for c in passed], "n_words",
        *[places(w, p).alias(f"__p{k}") for k, (p, _) in enumerate(BASE)],
        F.when(F.size(w) > 0, found).alias("__m"),
    )
    at = F.concat(*[F.col(f"__p{k}") for k in range(len(BASE))])
    base = F.array_compact(F.array(*[F.when(F.size(f"__p{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(BASE)]))
    third = second.select(
        *[F.col(f"`{c}`") for c in passed], "n_words",
        F.size(at).cast("long").alias("n_base"),
        F.array_min(at).cast("long").alias("first_word"), F.array_max(at).cast("long").alias("last_word"),
        F.array_sort(F.array_distinct(base)).alias("base_labels"), "__m",
    )
    named = F.concat("base_labels", F.coalesce(F.transform("__m", lambda m: m["label"]), no_words))
    best = F.coalesce(F.array_max(F.transform("__m", lambda m: m["weight"])), F.lit(0.0))
    return third.select(
        *[F.col(f"`{c}`") for c in passed], "n_words", "n_base", "first_word", "last_word", "base_labels",
        F.array_sort(F.array_distinct(named)).alias("labels"),
        F.greatest(best, F.when(F.col("n_base") > 0, F.lit(0.8)).otherwise(F.lit(0.0))).cast("double").alias("score"),
        F.col("__m").alias("matches"),
    )
