"""Importance resampling towards a target distribution, on hashed n-grams (operator 12).

A text's features are its runs of one to ``longest`` consecutive words, joined by one
space.  ASCII separators are collapsed to single spaces; then one overlapped regular
expression a run length, whose matches begin and end where a word does (lookarounds),
emits the n-grams' spans directly, and each span's CRC falls in a bucket.

One pass counts the buckets of all documents and of the target; a bucket's gain is the
scaled log ratio of its smoothed shares.  A second pass gives each document the mean
gain of its features; with Gumbel noise from a hash of its key added, the highest scores
are an importance-weighted draw without replacement.  Ranks come from sorted ranges and
prefix sums, so neither one task nor the driver holds all scores.

Defined cases: a null text has no words; a document without features weighs 0; a null key
makes its noise from the empty key and comes before others in ties.  Rows that share a key
stay rows of their own (with equal noise); rows equal in score and key rank in any order.
An empty target or empty documents leave smoothed shares only.  No row is lost: undrawn
documents have a null rank.  Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keep, map_texts, ship, slices
from .ordering import numbered, spread

BUCKETS = 10_000

#: Letters and digits of ASCII, A-Z in lower case, and every byte above ASCII stay; the rest separates.
_KEPT = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_SPACES = regex.compile(rb" {2,}")


class Scanner:
    """Buckets of a text's n-grams."""

    def __init__(self, longest: int, buckets: int):
        self.buckets = buckets
        self.patterns = [regex.compile(rb"(?<![^ ])[^ ]+" + rb" [^ ]+" * more + rb"(?![^ ])") for more in range(longest)]

    def text(self, text: str | None) -> bytes:
        """Words joined by single spaces."""
        return b"" if not text else _SPACES.sub(b" ", text.encode("utf-8", "surrogatepass").translate(_KEPT)).strip(b" ")

    def find(self, clean: bytes) -> np.ndarray:
        """Every n-gram's bucket, shortest n-grams first."""
        crc = zlib.crc32
        found = [crc(m.group()) for p in self.patterns for m in p.finditer(clean, overlapped=True)]
        return np.array(found, np.int64) % self.buckets


def bucket_counts(docs: DataFrame, longest: int = 1, buckets: int = BUCKETS, text: str = "text") -> np.ndarray:
    """How many features of all texts fall in each bucket.  A task sends one row a bucket."""
    ship(docs.sparkSession)

    def run(batches):
        scanner, sums = Scanner(longest, buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in slices(batch.column(0)):
                for t in texts:
                    sums += np.bincount(scanner.find(scanner.text(t)), minlength=buckets) if t else 0
        own = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(sums[own])], names=["bucket", "n"])

    counted = docs.select(docs[f"`{text}`"]).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in counted.collect():   # one row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of target share / source share) of each bucket, shares smoothed by one."""
    n, every, wanted = len(source), int(source.sum()), int(target.sum())
    ratio = (target + 1.0) * (every + float(n)) / ((source + 1.0) * (wanted + float(n)))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio.tolist()], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, longest: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_words, n_features and ``weight``: the floored mean of the features' gains."""

    def of(texts):
        scanner = Scanner(longest, len(gain))
        rows = []
        for t in texts:
            clean = scanner.text(t)
            found = scanner.find(clean)
            rows.append((clean.count(b" ") + 1 if clean else 0, len(found), int(gain[found].sum()) // len(found) if len(found) else 0))
        return [pa.array(x, pa.int64()) for x in zip(*rows)]

    return map_texts(docs, text, (key,), [T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")], of)


def noise(key: Column, seed: str) -> Column:
    """floor(1000 times a standard Gumbel value) from the key's hash."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, longest: int = 1, buckets: int = BUCKETS,
             seed: str = "2024", key: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """Draw floor(percent of the documents with at least ``least_words`` words), highest score
    first, ties to the smaller key.  Per row: key, n_features, weight, score, rank (null:
    not drawn)."""
    gain = gains(bucket_counts(docs, longest, buckets, text), bucket_counts(target, longest, buckets, target_text))
    rows = weights(docs, gain, longest, key, text).select(F.col(key).alias("k"), "n_words", "n_features", "weight")
    rows = rows.withColumn("score", F.col("weight") + noise(F.col("k"), seed)).withColumn("able", F.col("n_words") >= least_words)
    rows = keep(rows, "scored")   # dealing out ranges reads its rows twice
    # documents too short to be drawn sort behind all others
    kept = keep(spread(rows, [F.col("able").desc(), F.col("score").desc(), F.col("k").asc_nulls_first()]), "resampled")
    able = kept.where("able").count()
    drawn = F.col("able") & (F.col("number") < percent * able // 100)
    return numbered(kept).select(F.col("k").alias(key), "n_features", "weight", "score", F.when(drawn, F.col("number") + 1).alias("rank"))
