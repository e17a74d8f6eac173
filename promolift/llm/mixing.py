"""Mixing sources to target weights by subset-sum budget fitting.

Sizes are word counts.  Sources in code-point order (null last) weigh 1, 2, 3, repeating;
their targets share the total size by weight, none above ``most`` times its source's
size (the excess is shared again by weight).  A source's target is met by whole rounds of
all its documents and, for the rest, by an exact fit: documents are counted by length,
each length first gives its share of the rest, and a bounded-knapsack dynamic programme
over the remaining counts fills what is left to the word where the lengths allow it.
Which documents of a length are taken follows a seeded hash.

At scale: documents are counted by (source, length, hash bucket), so that no key holds
more than a small part of a hot source; the fit sees one row per source and length, never
documents; one shuffle deals the documents to their bucket's quota.  A bucket is ranked
only where its quota isn't all or nothing.

Defined cases: a null or empty text has size 0 and is taken 0 times or by rounds like any
other, adding nothing; a source with no words has target 0; the null source is a source;
rows that agree in all of id, source and text are told apart by nothing and may take each
other's place; extra columns are kept by ``mix``; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep, n_words, ship

WEIGHTS = (1, 2, 3)
MOST = 3
BUCKETS = 1024
#: Words that the dynamic programme covers at a time (a bit set of so many bits).
REACH = 1 << 16


def source_key(source: Column) -> Column:
    """A key that is never null: nulls sort behind all names."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """src, source_size, target from src, source_size; one row per source.

    A source is capped where its share would pass ``most`` times its size.  With sources
    ordered by size over weight the capped ones come first, so the share per weight is
    found by running sums, in whole numbers up to one division.
    """
    w = Window.orderBy(F.encode("src", "UTF-8"))
    weight = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.row_number().over(w) - 1, F.lit(len(weights))) + 1).cast("int"))
    df = sizes.withColumn("weight", weight.cast("long"))
    up = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.encode("src", "UTF-8"))
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = (
        df.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("left_size", F.col("total") - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
    )
    # this source and all later ones share what the earlier, capped ones leave
    fits = F.col("left_size").cast("double") * F.col("weight") <= F.col("source_size").cast("double") * most * F.col("left_weight")
    share = F.min(F.when(fits, F.struct("rank", "left_size", "left_weight"))).over(everything)
    df = df.withColumn("rank", F.row_number().over(up)).withColumn("share", share)
    capped = F.col("share").isNull() | (F.col("rank") < F.col("share.rank"))
    target = F.when(capped, (most * F.col("source_size")).cast("double")).otherwise(
        F.col("share.left_size").cast("double") * F.col("weight") / F.col("share.left_weight")
    )
    return df.select("src", "source_size", target.cast("double").alias("target"))


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take, so that the words taken come near to
    ``budget``; exact wherever the last step can reach it.

    Each length first gives the floor of its share.  Then whole documents, the longest
    first, fill the rest down to ``REACH`` words; the dynamic programme does the rest.
    """
    total = int((lengths * counts).sum())
    taken = np.zeros(len(lengths), np.int64)
    if budget <= 0 or total <= 0:
        return taken
    if budget >= total:
        return counts.copy()
    taken = np.array([int(c) * budget // total for c in counts.tolist()], np.int64)
    rest = budget - int((lengths * taken).sum())
    for i in np.argsort(-lengths, kind="stable").tolist():
        if rest <= REACH:
            break
        if lengths[i] > 0:
            k = min(int(counts[i] - taken[i]), max(0, (rest - REACH // 2) // int(lengths[i])))
            taken[i] += k
            rest -= k * int(lengths[i])
    return taken + knapsack(lengths, counts - taken, rest)


def knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded subset sum: counts per length whose sum comes nearest to ``budget`` (of two
    as near, the smaller).

    Sums up to a document beyond the budget are bits of one integer; a length's count is
    split in powers of two.  For every sum the first part that reaches it is noted, which
    is enough to walk back.
    """
    taken = np.zeros(len(lengths), np.int64)
    usable = (lengths > 0) & (counts > 0)
    if budget <= 0 or not usable.any():
        return taken
    most = int(min(budget + lengths[usable].max(), (lengths * counts).sum()))
    mask, reached = (1 << (most + 1)) - 1, 1
    by, via = np.full(most + 1, -1, np.int32), []
    for i in np.flatnonzero(usable)[np.argsort(lengths[usable], kind="stable")].tolist():
        size, part = int(lengths[i]), 1
        n = min(int(counts[i]), most // size)
        while n > 0 and not reached >> budget & 1:
            k = min(part, n)
            new = (reached << (size * k)) & mask & ~reached
            if new:
                raw = np.frombuffer(new.to_bytes(most // 8 + 1, "little"), np.uint8)
                by[np.flatnonzero(np.unpackbits(raw, bitorder="little")[: most + 1])] = len(via)
                reached |= new
            via.append((i, k))
            n, part = n - k, part * 2
        if reached >> budget & 1:
            break
    at = (reached & ((1 << (budget + 1)) - 1)).bit_length() - 1
    above = reached >> (budget + 1)
    if above:
        over = budget + (above & -above).bit_length()
        at = over if over - budget < budget - at else at
    while at > 0:
        i, k = via[by[at]]
        taken[i] += k
        at -= k * int(lengths[i])
    return taken


_PLAN = T.StructType([T.StructField("src", T.StringType()), T.StructField("size", T.LongType()), T.StructField("rounds", T.LongType()), T.StructField("extra", T.LongType()), T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType())])


def _plan(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("size")
    lengths, counts = group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64)
    source_size, target = int(group["source_size"].iloc[0]), float(group["target"].iloc[0])
    budget = int(round(target))
    rounds = budget // source_size if source_size else 0
    extra = fit(lengths, counts, budget - rounds * source_size)
    return pd.DataFrame({"src": group["src"], "size": lengths, "rounds": rounds, "extra": extra, "source_size": source_size, "target": target})


def mix(df: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", passed: tuple[str, ...] | None = None, seed: int = 20, weights=WEIGHTS, most: int = MOST, buckets: int = BUCKETS) -> DataFrame:
    """``passed`` (default: all) columns as struct ``row``, and size, source_size, target,
    copies (times the mix takes the document, 0 to ``most``)."""
    ship(df.sparkSession)
    names = df.columns if passed is None else list(passed)
    h = F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`"), F.xxhash64(F.col(f"`{text}`")))
    docs = df.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        source_key(F.col(f"`{source}`")).alias("src"),
        n_words(F.col(f"`{text}`")).alias("size"),
        h.alias("h"),
        F.pmod(F.shiftright(h, 20), F.lit(buckets)).alias("bucket"),
    )
    counts = keep(docs.groupBy("src", "size", "bucket").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    lengths = counts.groupBy("src", "size").agg(F.sum("n").alias("n"))
    goal = targets(counts.groupBy("src").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, most)
    plan = lengths.join(goal, "src").groupBy("src").applyInPandas(_plan, _PLAN)
    filled = Window.partitionBy("src", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    quota = counts.join(plan, ["src", "size"]).withColumn("before", F.coalesce(F.sum("n").over(filled), F.lit(0)))
    quota = quota.select("src", "size", "bucket", "rounds", "source_size", "target", F.greatest(F.lit(0), F.least(F.col("n"), F.col("extra") - F.col("before"))).alias("quota"))
    quota = keep(quota, "mix-quota")
    place = F.row_number().over(Window.partitionBy("src", "size", "bucket").orderBy("h"))
    return docs.join(quota, ["src", "size", "bucket"]).select(
        "row", "size", "source_size", "target", (F.col("rounds") + (place <= F.col("quota")).cast("long")).alias("copies")
    )


def mixed_documents(df: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with ``df``'s columns."""
    out = mix(df, **options).where("copies > 0")
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")
