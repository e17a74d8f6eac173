"""Quality rules: a threshold table compiled into one Spark projection.

``measures`` gives one column of counts per measure and ``verdict`` turns a table of
(name, ratio, lower bound, upper bound) into one boolean expression.  Everything is a
built-in expression over the row; there is no shuffle and no user function.

Defined cases: a null or empty text has no words and all counts 0 (it fails the base
rule); a text of one endless word or line is measured whole; repeated rows get equal
results; extra columns are left out unless asked for; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, WORD, let

SYMBOLS = "#*$%&|<>"
PUNCTUATION = ".,;:!?()\"'"
WINDOW = 8
#: Frequent short words of the languages served.
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "au aux avec ce dans de des du elle en est et il la le les ne ou par pas pour que qui sur un une "
    "als auf aus bei das dem den der des die ein eine im in ist mit nicht sich sie und von zu "
    "al como con del el es esta lo los las más no para por que se su un una y"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= ratio <= high`` must hold; a bound that is None is open."""

    name: str
    ratio: str
    low: float | None = None
    high: float | None = None


#: The default table; the ratios are defined in ``ratios``.
RULES = (
    Rule("word length", "chars_per_word", 1.5, 30.0),
    Rule("symbols", "symbols_per_word", None, 0.25),
    Rule("shouting", "capital_pairs", None, 1.0),
    Rule("stop words", "stop_words", 0.02, None),
    Rule("repeated lines", "dup_lines", None, 0.5),
    Rule("doubled words", "doubled_words", None, 0.3),
    Rule("closing marks", "marked_words", None, 0.3),
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE, -1), "")


def n_repeated(words: Column, width: int = WINDOW) -> Column:
    """Words inside windows of ``width`` words that occur twice or more in the text.

    Windows are compared by 64-bit hashes of their words.  Most texts have as many
    distinct windows as windows and stop there; for others the (hash, place) pairs are
    sorted, and the lengths of the repeated windows are added without their overlaps.
    """

    def marked(windows: Column) -> Column:
        return let(F.array_sort(F.transform(windows, lambda x, i: F.struct(x.alias("x"), i.alias("i")))), covered)

    def covered(pairs: Column) -> Column:
        same = lambda p, k: F.coalesce(F.get(pairs, k)["x"] == p["x"], F.lit(False))
        twice = lambda p, k: same(p, k - 1) | same(p, k + 1)
        starts = F.array_sort(F.transform(F.filter(pairs, twice), lambda p: p["i"]))
        zero = F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n"))
        step = lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(width), i - a["last"])).alias("n"))
        return F.aggregate(starts, zero, step, lambda a: a["n"])

    def of(hashes: Column) -> Column:
        window = F.transform(
            F.sequence(F.lit(0), F.size(hashes) - width),
            lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(width)]),
        )
        some = let(window, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(marked(g)))
        return F.when(F.size(hashes) <= width, F.lit(0)).otherwise(some)

    return let(F.transform(words, lambda w: F.xxhash64(w)), of)


def measures(text: Column, words: Column) -> dict[str, Column]:
    """Counts of a text, given the column of its words."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD))
    return {
        "n_words": F.size(words),
        "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")),
        "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": n_repeated(words),
        "n_lines": F.size(F.split(text, "\n", -1)),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(F.btrim(w, F.lit(PUNCTUATION))).isin(STOP_WORDS))),
        "n_doubled_words": F.size(F.filter(words, lambda w, i: (i > 0) & (w == F.get(words, i - 1)))),
        "n_capital_pairs": F.regexp_count(text, F.lit(r"\p{Lu}{2}")),
        "n_marked_words": F.regexp_count(text, F.lit(r"(?:!!|\?\?|\|)(?![^\x20\x09-\x0D])")),
    }


def ratios(of) -> dict[str, Column]:
    """Ratios of measures (``of`` gives a measure by name); null, and so no verdict, where
    the denominator is 0."""
    per_word = lambda c: F.when(of("n_words") > 0, of(c) / of("n_words"))
    return {
        "chars_per_word": per_word("word_chars"),
        "symbols_per_word": per_word("n_symbols"),
        "capital_pairs": per_word("n_capital_pairs"),
        "stop_words": per_word("n_stop_words"),
        "doubled_words": per_word("n_doubled_words"),
        "dup_lines": F.when(of("n_lines") > 0, of("n_dup_lines") / of("n_lines")),
        "marked_words": per_word("n_marked_words"),
    }


def verdict(rules=RULES, of=F.col) -> Column:
    """True where no rule of the table is broken."""
    ratio, ok = ratios(of), F.lit(True)
    for r in rules:
        if r.low is not None:
            ok = ok & F.coalesce(ratio[r.ratio] >= r.low, F.lit(True))
        if r.high is not None:
            ok = ok & F.coalesce(ratio[r.ratio] <= r.high, F.lit(True))
    return ok


def base_failed(of=F.col) -> Column:
    return (of("n_words") < 20) | (100 * of("n_repeat_words") > 30 * of("n_words"))


def passes(text: Column, rules=RULES) -> Column:
    """The verdict as one expression over the text.  Words and measures are bound inside it,
    so that a filter pushed to the scan computes them once per row."""
    text = F.coalesce(text, F.lit(""))
    counted = lambda w: F.struct(*[c.cast("long").alias(n) for n, c in measures(text, w).items()])
    judged = lambda m: ~base_failed(lambda n: m[n]) & verdict(rules, lambda n: m[n])
    return let(words_of(text), lambda w: let(counted(w), judged))


def judge(df: DataFrame, text: str = "text", passed: tuple[str, ...] = ("doc_id",), rules=RULES) -> DataFrame:
    """``passed`` columns, the measures, base_failed and kept, for every row."""
    found = measures(F.col(text), F.col("__words"))
    first = df.select(*[F.col(c) for c in dict.fromkeys((*passed, text))], words_of(F.coalesce(F.col(text), F.lit(""))).alias("__words"))
    out = first.select(*[F.col(c) for c in passed], *[c.cast("long").alias(n) for n, c in found.items()])
    return out.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))


def filter_documents(df: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``df`` that pass, with their own columns and no others."""
    return df.where(passes(F.col(f"`{text}`"), rules))
