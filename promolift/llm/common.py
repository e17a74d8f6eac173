"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir

#: A word is a longest run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors' Python, once per session (``addPyFile``; Spark
    copies the archive to wherever a task runs)."""
    sc = spark.sparkContext
    if getattr(sc, "_llm_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(), "promolift_package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._llm_shipped = True


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared checkpoint folder and read it back:
    the result survives a lost executor, and later steps don't compute it again."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row (a lambda variable holds it)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_mod(key: Column, n: int) -> Column:
    """crc32 of the key as text, modulo n; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def drawn(h: Column, share: float) -> Column:
    """Whether a signed 64-bit hash falls in the lowest ``share`` of its range: a seeded sample
    whose size follows the share however small that is."""
    return F.lit(True) if share >= 1 else h < F.lit(int(share * 2.0 ** 64) - 2 ** 63)


#: Keys with more than a MANY-th of all rows, and more than FEW, are handled apart: fewer than MANY can be.
MANY, FEW = 1000, 512


def with_values(rows: DataFrame, values: DataFrame, on: list[str], size: Column, total: int) -> DataFrame:
    """Inner join of ``rows`` with one row of ``values`` a key; ``size``: how many rows have the
    key.  Fewer than MANY keys can have over a MANY-th of ``total`` rows: those are broadcast."""
    large = (size * MANY > total) & (size > FEW)
    hot, cold = values.where(large), values.where(~large)
    if hot.isEmpty():
        return rows.join(values, on)
    rest = rows.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return rows.join(F.broadcast(hot), on).unionByName(rest.join(cold, on))


def ascii_words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case, as UTF-8.  ``bytes.lower`` and
    ``bytes.split`` touch ASCII letters and the six ASCII white-space bytes only."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), elementwise."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _M1
        x = (x ^ (x >> np.uint64(27))) * _M2
        return x ^ (x >> np.uint64(31))


def slices(column, most_chars: int = 4_000_000):
    """Consecutive (start, texts) pieces of an Arrow string column, each of about
    ``most_chars`` characters, so that a batch of long texts isn't unpacked at once."""
    start, size, out = 0, 0, []
    for i, x in enumerate(column):
        t = x.as_py()
        out.append(t)
        size += len(t) if t else 0
        if size >= most_chars:
            yield start, out
            start, size, out = i + 1, 0, []
    if out:
        yield start, out


def map_texts(df: DataFrame, text: str, passed: tuple[str, ...], fields: list[T.StructField], of, at_once: int = 4_000_000) -> DataFrame:
    """``passed`` columns and ``fields``, the latter from ``of(texts)``: a function from a
    list of texts to one Arrow array for each field.  One narrow pass; a task unpacks
    about ``at_once`` characters at a time."""
    ship(df.sparkSession)
    names = [f"p{k}" for k in range(len(passed))]
    schema = T.StructType([*[T.StructField(n, df.schema[c].dataType) for n, c in zip(names, passed)], *fields])
    heads = [f.name for f in schema.fields]

    def run(batches):
        for batch in batches:
            for start, texts in slices(batch.column(len(names)), at_once):
                own = [batch.column(k).slice(start, len(texts)) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays([*own, *of(texts)], names=heads)

    out = df.select(*[df[f"`{c}`"].alias(n) for n, c in zip(names, passed)], df[f"`{text}`"].alias("t")).mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, passed)], *[f.name for f in fields])
