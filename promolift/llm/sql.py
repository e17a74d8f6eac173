"""DuckDB formulations of the operators that SQL can express, over the same tables."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_ASCII_LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: Fixed values, written out apart from the code under test.
_STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with au aux avec ce dans de des du "
    "elle en est et il la le les ne ou par pas pour que qui sur un une als auf aus bei das dem den der die ein "
    "eine im ist mit nicht sich sie und von zu al como con del el es esta lo los las más no para por se su una y "
).split()
_RULES = """
  coalesce(word_chars / nullif(n_words, 0) >= 1.5, true) AND
  coalesce(word_chars / nullif(n_words, 0) <= 30.0, true) AND
  coalesce(n_symbols / nullif(n_words, 0) <= 0.25, true) AND
  coalesce(n_capital_pairs / nullif(n_words, 0) <= 1.0, true) AND
  coalesce(n_stop_words / nullif(n_words, 0) >= 0.02, true) AND
  coalesce(n_dup_lines / nullif(n_lines, 0) <= 0.5, true) AND
  coalesce(n_doubled_words / nullif(n_words, 0) <= 0.3, true) AND
  coalesce(n_marked_words / nullif(n_words, 0) <= 0.3, true)
"""


def quality_rules() -> str:
    stop = ", ".join(_quoted(w) for w in _STOP_WORDS)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, {_WORDS.format(text='t')} AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT r, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE len(ws) >= 8),
k AS (SELECT r, i, lead(x, 7) OVER o AS last, concat_ws(' ', x, {', '.join(f'lead(x, {j}) OVER o' for j in range(1, 8))}) AS words FROM g WINDOW o AS (PARTITION BY r ORDER BY i)),
h AS (SELECT r, i, count(*) OVER (PARTITION BY r, words) AS c FROM k WHERE last IS NOT NULL),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM h WHERE c > 1) GROUP BY r),
m AS (SELECT w.r, doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
  (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
  (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
  len(string_split(t, chr(10))) AS n_lines,
  len(list_filter(ws, lambda x: lower(trim(x, {_quoted('.,;:!?()' + chr(34) + chr(39))})) IN ({stop}))) AS n_stop_words,
  len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_doubled_words,
  len(regexp_extract_all(t, '\p{{Lu}}{{2}}')) AS n_capital_pairs,
  len(list_filter(ws, lambda x: regexp_matches(x, '(!!|\?\?|\|)$'))) AS n_marked_words
  FROM w LEFT JOIN covered USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_RULES} AS kept FROM b
"""


def near_duplicates(width: int = 3, percent: int = 85) -> str:
    """Every pair that shares a shingle, without sketches; components by recursion."""
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text=_ASCII_LOWER.format(text="coalesce(text, '')"))} AS ws FROM documents),
t AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE len(ws) >= {width}),
k AS (SELECT doc_id, lead(x, {width - 1}) OVER o AS last, concat_ws(' ', x, {', '.join(f'lead(x, {j}) OVER o' for j in range(1, width))}) AS x FROM t WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
s AS (SELECT DISTINCT doc_id, x FROM k WHERE last IS NOT NULL UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM w WHERE len(ws) BETWEEN 1 AND {width - 1}),
e AS (SELECT doc_id, x, count(*) OVER (PARTITION BY doc_id) AS n FROM s),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(doc_id, other) AS (SELECT a, b FROM links UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a),
c AS (SELECT doc_id, least(doc_id, min(other)) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, coalesce(c.component_id, w.doc_id) AS component_id, coalesce(c.component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN z USING (doc_id) LEFT JOIN c USING (doc_id)
"""


#: The CRC-32 table as a list, made bit by bit.
_CRC_TABLE = """crc AS (SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) ORDER BY n) AS tab FROM range(256) t(n))"""


def _crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes; ``tab`` is in scope."""
    bytes_ = f"list_transform(range(0, length(hex({text})) // 2), lambda i: ('0x' || substr(hex({text}), 2 * i + 1, 2))::BIGINT)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {bytes_}), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])))"


def conversation_trie() -> str:
    """Every prefix of every rebuilt conversation as a key of 32 characters a turn."""
    return f"""
WITH {_CRC_TABLE},
o AS (SELECT conv_id AS c, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS x, strlen(coalesce(text, '')) AS b,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p FROM conversations WHERE conv_id IS NOT NULL),
h AS (SELECT c, {_crc32('c::VARCHAR')} % 9 AS h FROM (SELECT DISTINCT c FROM o), crc),
r AS (SELECT h.c, o.p, o.x, o.b FROM h JOIN o ON o.c = h.c - h.c % 5 AND o.p <= h.h UNION ALL SELECT h.c, o.p, o.x, o.b FROM h JOIN o ON o.c = h.c AND o.p > h.h),
q AS (SELECT h.c, coalesce(s.k, '') AS k, coalesce(s.bs, []) AS bs FROM h LEFT JOIN (SELECT c, string_agg(x, '' ORDER BY p) AS k, list(b ORDER BY p) AS bs FROM r GROUP BY c) s USING (c)),
p AS (SELECT c, k, bs, len(bs) AS n, unnest(range(0, len(bs) + 1)) AS d FROM q),
node AS (SELECT substr(k, 1, 32 * d) AS k, d, min(c) AS conv_id, count(*) AS n_convs, max(CASE WHEN d > 0 THEN bs[d] ELSE 0 END) AS b,
  sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256 FROM p GROUP BY ALL),
kids AS (SELECT substr(k, 1, 32 * (d - 1)) AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
one AS (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids USING (k)),
up AS (SELECT substr(k, 1, 32 * a) AS k, sum((n_children = 0)::INT) AS leaves, sum((n_convs - 1) * b) AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM one) GROUP BY 1)
SELECT one.conv_id, one.d AS depth, parent.conv_id AS parent_conv_id, one.n_convs, one.n_children::BIGINT AS n_children, up.leaves::BIGINT AS n_leaves, up.saved::BIGINT AS saved_tokens, one.ends_sha256
FROM one JOIN up ON up.k = one.k LEFT JOIN node parent ON one.d > 0 AND parent.k = substr(one.k, 1, 32 * (one.d - 1))
"""


def importance_resampling() -> str:
    words = rf"regexp_extract_all({_ASCII_LOWER.format(text="coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH {_CRC_TABLE},
d AS (SELECT row_number() OVER () AS r, doc_id, {words} AS ws FROM documents),
w AS (SELECT r, unnest(ws) AS x FROM d),
q AS (SELECT unnest({words}) AS x FROM benchmark),
k AS (SELECT x, {_crc32('x')} % 10000 AS b FROM (SELECT x FROM w UNION SELECT x FROM q), crc),
s AS (SELECT b, count(*) AS s FROM w JOIN k USING (x) GROUP BY b),
t AS (SELECT b, count(*) AS t FROM q JOIN k USING (x) GROUP BY b),
g AS (SELECT x, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM w) + 10000) / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM q) + 10000))))::BIGINT AS gain
  FROM k LEFT JOIN s USING (b) LEFT JOIN t USING (b)),
m AS (SELECT r, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM w JOIN g USING (x) GROUP BY r),
z AS (SELECT r, doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight, ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM d LEFT JOIN m USING (r)),
y AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM z),
v AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM y WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= (SELECT 10 * count(*) // 100 FROM v) THEN place END AS rank FROM y LEFT JOIN v USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_quality_rules": quality_rules(), "op4_near_duplicates": near_duplicates(), "op11_conversation_trie": conversation_trie(),
        "op12_importance_resampling": importance_resampling(),
    }
