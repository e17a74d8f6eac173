"""MinHash near-duplicates: fast similarity sketches, banding, exact verification.

Sets are the distinct word shingles of a text, as 64-bit hashes.  A sketch has ``SLOTS``
slots.  In round i every element of the set is thrown into one slot with a value in
[i, i + 1); the smaller value stays.  Rounds go on until every slot is filled; after
``SLOTS`` rounds round i fills slot i - SLOTS for sure.  So a large set needs little more
than one pass over its elements, and agreement of slots concentrates around the
similarity as for independent minima.

Documents of equal sets form a class that one document stands for.  Slots, cut to 16
bits, in bands of ``ROWS`` deal the classes to buckets; two classes above the similarity
share no bucket with probability under 1e-8 (0.85) or 1e-6 (0.8).  Whole buckets are never
written out as pairs.  Two star rounds first link every class with one centre of the
buckets it shares most.  What is left are pairs of different components in one bucket:
buckets are cut into blocks (the largest component's members only meet the others), a
task compares a block pair's sketches, at six standard deviations, to see which members
need their full sets, and a second one confirms those on full sets and gives out a
spanning set of the links it finds.

Defined cases: a null or empty text has an empty set and is linked with nothing; a text
of fewer words than a shingle has its whole word sequence as one; rows that share an id
count as one document; a row with a null id is its own, has a null component and is
kept; extra columns don't matter; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import FEW, MANY, ascii_words, keep, map_texts, mix64, ship, word_hashes
from .components import components

ROWS, BANDS = 4, 28
SLOTS = ROWS * BANDS
#: Members of a block; bits of the map that spares sets of documents in no pair; shared
#: buckets from which a star round tries a pair.
BLOCK, MAP_BITS, SHARED = 512, 1 << 24, 4
_K = np.uint64(0x9E3779B97F4A7C15)


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    words = ascii_words(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = word_hashes(words)
    n = max(1, len(h) - width + 1)
    with np.errstate(over="ignore"):
        s = np.full(n, min(width, len(h)), np.uint64)
        for k in range(min(width, len(h))):
            s = mix64(s * _K + h[k:k + n])
    s.sort()
    return s[np.r_[True, s[1:] != s[:-1]]]


def sketch(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """One row of slots for each non-empty set: round in the upper 16 bits, hash below."""
    out = np.full((len(sets), slots), np.uint64(2**64 - 1))
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    open_rows = np.arange(len(sets))
    table = out.reshape(-1)
    for i in range(2 * slots):
        if not len(flat):
            break
        with np.errstate(over="ignore"):
            x = mix64(flat + np.uint64(i + 1) * _K)
        slot = (x >> np.uint64(48)) % np.uint64(slots) if i < slots else np.full(len(x), i - slots, np.uint64)
        value = (x & np.uint64((1 << 48) - 1)) | np.uint64(i << 48)
        np.minimum.at(table, owner * slots + slot.astype(np.int64), value)
        empty = (out[open_rows] == np.uint64(2**64 - 1)).any(axis=1)
        if not empty.all():
            still = np.zeros(len(sets), bool)
            still[open_rows[empty]] = True
            go = still[owner]
            flat, owner, open_rows = flat[go], owner[go], open_rows[empty]
    return out


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """A long for each band: its slots, cut to 16 bits."""
    return (mix64(sketches) & np.uint64(0xFFFF)).astype(np.uint16).view(np.int64)


def least_agreement(percent: int) -> int:
    """Slots that two sketches above the similarity agree in at least, but for six sigma."""
    p = percent / 100
    return int(SLOTS * p - 6 * (SLOTS * p * (1 - p)) ** 0.5)


_PRINT = [
    T.StructField("n", T.LongType()), T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType()),
    T.StructField("bands", T.ArrayType(T.LongType())),
]


def prints(df: DataFrame, text: str, doc_id: str, width: int, percent: int) -> DataFrame:
    """doc_id, set size, digest of the set and bands (none where only equal sets link)."""

    def of(texts):
        sets = [shingles(t, width) for t in texts]
        sizes = np.array([len(s) for s in sets], np.int64)
        digests = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
        d = np.array([[x & (2**64 - 1), x >> 64] for x in digests], np.uint64).reshape(-1, 2).view(np.int64)
        big = np.flatnonzero(100 * sizes >= percent * (sizes + 1))  # others link to equal sets only
        sk = sketch([sets[i] for i in big])
        bands = band_keys(sk)
        has = np.zeros(len(sets), bool)
        has[big] = True
        offsets = np.concatenate([[0], np.cumsum(has * BANDS)])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(bands.reshape(-1), pa.int64()))
        return pa.array(sizes), pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy()), lists

    return map_texts(df, text, (doc_id,), _PRINT, of)


def _bit(key: Column) -> tuple[Column, Column]:
    at = F.pmod(F.xxhash64(key), F.lit(MAP_BITS))
    return F.shiftright(at, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int")).alias("bit")


def sets_of(df: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """id and items (full set) of the documents in ``ids``; a few more may come along.

    Documents are picked by a bit map of ``MAP_BITS`` bits (a table of at most 2**18 rows,
    whatever the number of ids), so that texts aren't shuffled to be picked."""

    def of(texts):
        sets = [shingles(t, width) for t in texts]
        offsets = np.cumsum([0, *map(len, sets)])
        flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
        return (pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64())),)

    wanted = ids.select(*_bit(F.col("id"))).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    docs = df.select(F.col("doc_id").alias("id"), "text", *_bit(F.col("doc_id")))
    some = docs.join(F.broadcast(wanted), "word").where(F.col("bits").bitwiseAND(F.col("bit")) != 0)
    return map_texts(some.select("id", "text"), "text", ("id",), [T.StructField("items", T.ArrayType(T.LongType()))], of)


def with_sets(pairs: DataFrame, sets: DataFrame, key: str, other: str, total: int) -> DataFrame:
    """``pairs`` with the set of the document that ``key`` holds.  The pairs of a document with
    over a MANY-th of all pairs are dealt by their other end, its set sent to each part."""
    hot = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("k")).where((F.col("k") * MANY > total) & (F.col("k") > FEW))
    if hot.isEmpty():
        return pairs.join(sets.select(F.col("id").alias(key), F.col("items").alias(f"{key}_items")), key)
    hot = F.broadcast(hot.select(F.col(key).alias("hot"), F.ceil(F.col("k") * MANY / total).cast("int").alias("s")))    # fewer than MANY rows
    dealt = pairs.join(hot, F.col(key) == F.col("hot"), "left").withColumn("part", F.pmod(F.xxhash64(other), F.coalesce("s", F.lit(1))).cast("int")).drop("hot", "s")
    sent = sets.join(hot, F.col("id") == F.col("hot"), "left").select(F.col("id").alias(key), F.col("items").alias(f"{key}_items"),
                                                                      F.explode(F.sequence(F.lit(0), F.coalesce("s", F.lit(1)) - 1)).alias("part"))
    return dealt.join(sent, [key, "part"]).drop("part")


def verified(df: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    total = pairs.count()
    if not total:
        return pairs.select("a", "b")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = keep(sets_of(df, ids, width).dropDuplicates(["id"]), "neardup-sets")
    met = with_sets(with_sets(pairs.select("a", "b"), sets, "a", "b", total), sets, "b", "a", total)
    both = F.size(F.array_intersect("a_items", "b_items"))
    union = F.size("a_items") + F.size("b_items") - both
    return met.where(100 * both >= percent * union).select("a", "b")


def star_pairs(shared: DataFrame, order: Column) -> DataFrame:
    """Each member with the first member, by ``order``, of the buckets it shares most with
    one; only across components, and only where it shares enough of them."""
    centre = shared.groupBy("band", "bucket").agg(F.min_by(F.struct("id", "comp"), F.struct(order, "id")).alias("c"))
    met = shared.join(centre, ["band", "bucket"]).where(F.col("comp") != F.col("c.comp"))
    met = met.groupBy("id", F.col("c.id").alias("centre")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= SHARED)
    met = met.groupBy("id").agg(F.max_by("centre", F.struct("n", -F.col("centre"))).alias("centre"))
    return met.select(F.greatest("id", "centre").alias("a"), F.least("id", "centre").alias("b")).distinct()


def open_members(shared: DataFrame, label: DataFrame) -> DataFrame:
    """band, bucket, id, comp in the buckets that hold several components."""
    now = shared.select("band", "bucket", "id").join(label, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    several = now.groupBy("band", "bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    return now.join(several.select("band", "bucket"), ["band", "bucket"], "left_semi")


_KEY = ["band", "bucket", "kind", "i", "j"]


def block_pairs(members: DataFrame) -> DataFrame:
    """Members dealt to block pairs of their bucket: kind 0 among the members outside the
    bucket's largest component, kind 1 between those and that component's members."""
    sizes = members.groupBy("band", "bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("band", "bucket").agg(F.max_by("comp", F.struct("n", -F.col("comp"))).alias("main"), F.max("n").alias("n_main"), F.sum("n").alias("n"))
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    sizes = sizes.select("band", "bucket", "main", blocks("n_main").alias("m"), F.ceil((F.col("n") - F.col("n_main")) / BLOCK).cast("int").alias("k"))
    rows = members.join(sizes, ["band", "bucket"])
    inside = F.col("comp") == F.col("main")
    own = F.pmod(F.xxhash64("id", F.lit(4)), F.when(inside, F.col("m")).otherwise(F.col("k"))).cast("int")
    each = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    place = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    others = F.transform(each("k"), lambda x: place(0, F.least(x, F.col("own")), F.greatest(x, F.col("own"))))
    against = F.transform(each("m"), lambda x: place(1, F.col("own"), x))
    mains = F.transform(each("k"), lambda x: place(1, x, F.col("own")))
    rows = rows.withColumn("own", own).withColumn("inside", inside)
    rows = rows.withColumn("at", F.explode(F.when(F.col("inside"), mains).otherwise(F.concat(others, against))))
    return rows.select("band", "bucket", F.col("at.kind").alias("kind"), F.col("at.i").alias("i"), F.col("at.j").alias("j"), "inside", "own", "id", "comp")


def by_groups(df: DataFrame, of, schema: str) -> DataFrame:
    """``of(frame)`` for the rows of each key, one after the other, within sorted
    partitions; it gives a frame or None.  A key has at most 2 * BLOCK rows."""
    ship(df.sparkSession)

    def run(batches):
        rest = None
        for batch in batches:
            batch = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            if not len(batch):
                continue
            key = batch[_KEY].to_numpy(np.int64)
            edge = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            cut = int(edge[-1]) if len(edge) else 0
            yield from done(batch, np.r_[0, edge])
            rest = batch.iloc[cut:].reset_index(drop=True)
        if rest is not None and len(rest):
            out = of(rest)
            if out is not None:
                yield out

    def done(batch, edges):
        out = [x for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()) if b - a > 1 and (x := of(batch.iloc[a:b])) is not None]
        if out:
            yield pd.concat(out, ignore_index=True)

    return df.repartition(*_KEY).sortWithinPartitions(*_KEY).mapInPandas(run, schema)


def _allowed(rows: pd.DataFrame) -> np.ndarray:
    """Pairs that belong to this block pair: different components, sides and blocks."""
    comp, inside, own = rows["comp"].to_numpy(), rows["inside"].to_numpy(bool), rows["own"].to_numpy()
    ok = comp[:, None] != comp[None, :]
    if rows["kind"].iloc[0] == 1:
        ok &= inside[:, None] & ~inside[None, :]
    else:
        if rows["i"].iloc[0] != rows["j"].iloc[0]:
            ok &= own[:, None] != own[None, :]
        ok &= np.tri(len(rows), k=-1, dtype=bool)
    return ok


def screen(percent: int):
    """Members of a block pair with a partner that their sketches may hide a link to; a pair
    counts in its first common band only."""
    least = least_agreement(percent)

    def of(rows: pd.DataFrame):
        keys = np.stack(rows["bands"].to_numpy())
        slots = np.ascontiguousarray(keys).view(np.uint16)
        ok, band = _allowed(rows), int(rows["band"].iloc[0])
        at = np.flatnonzero(ok.any(1))
        need = np.zeros(len(rows), bool)
        for part in np.array_split(at, max(1, len(at) * len(rows) // 20_000)):
            x, y = np.nonzero(ok[part])
            x = part[x]
            for c in range(0, len(x), 20_000):
                a, b = x[c:c + 20_000], y[c:c + 20_000]
                good = (slots[a] == slots[b]).sum(1) >= least
                a, b = a[good], b[good]
                good = (keys[a] == keys[b]).argmax(1) == band
                need[a[good]] = need[b[good]] = True
        return rows.loc[need, [*_KEY, "inside", "own", "id", "comp"]] if need.any() else None

    return of


def confirm(percent: int):
    """Links of a block pair, on full sets: a spanning set of those across components."""

    def of(rows: pd.DataFrame):
        items = [np.asarray(x, np.int64) for x in rows["items"]]
        n = np.array([len(x) for x in items])
        ok = _allowed(rows)
        values, place = np.unique(np.concatenate(items), return_inverse=True)
        owner = np.repeat(np.arange(len(items)), n)
        often = np.bincount(place, minlength=len(values)) > 1
        column = np.cumsum(often) - 1
        go = often[place]
        owner, column, width = owner[go], column[place[go]], int(often.sum())
        both = np.zeros((len(items), len(items)), np.float32)
        for c in range(0, width, 4096):
            some = (column >= c) & (column < c + 4096)
            m = np.zeros((len(items), min(4096, width - c)), np.float32)
            m[owner[some], column[some] - c] = 1
            both += m @ m.T
        both = both.astype(np.int64)
        a, b = np.nonzero(ok & (100 * both >= percent * (n[:, None] + n[None, :] - both)))
        ids, root, out = rows["id"].to_numpy(np.int64), dict(zip(rows["comp"].tolist(), rows["comp"].tolist())), []
        comp = rows["comp"].tolist()

        def top(v):
            while root[v] != v:
                root[v] = v = root[root[v]]
            return v

        for u, v in zip(a.tolist(), b.tolist()):
            p, q = top(comp[u]), top(comp[v])
            if p != q:
                root[p] = q
                out.append((max(ids[u], ids[v]), min(ids[u], ids[v])))
        return pd.DataFrame(out, columns=["a", "b"]) if out else None

    return of


def link(df: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``df``."""
    df = df.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = keep(prints(df, "text", "doc_id", width, percent), "neardup-prints")
    sure = found.where("doc_id is not null and n > 0")
    groups = sure.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("size")).where("size > 1").select("d1", "d2", "rep")
    groups = keep(groups, "neardup-classes")
    classed = sure.join(groups, ["d1", "d2"], "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    classes = classed.where("rep = doc_id").select(F.col("rep").alias("id"), "bands")

    dealt = classes.select("id", F.posexplode("bands").alias("band", "bucket"))
    held = dealt.groupBy("band", "bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("band", "bucket")
    shared = keep(dealt.join(held, ["band", "bucket"], "left_semi"), "neardup-buckets")

    pairs = keep(star_pairs(shared.withColumn("comp", F.col("id")), F.col("id")), "neardup-pairs")
    edges = keep(verified(df, pairs, width, percent), "neardup-links")
    members = keep(open_members(shared, components(edges)), "neardup-open")
    again = keep(star_pairs(members, F.xxhash64("id")).join(pairs, ["a", "b"], "left_anti"), "neardup-pairs")
    edges = keep(edges.union(verified(df, again, width, percent)), "neardup-links")
    members = keep(open_members(members, components(edges)), "neardup-open")

    blocks = block_pairs(members).join(classes, "id")
    kinds = "band int, bucket long, kind int, i int, j int, inside boolean, own int, id long, comp long"
    needed = keep(by_groups(blocks, screen(percent), kinds), "neardup-needed")
    sets = sets_of(df, needed.select("id").distinct(), width).dropDuplicates(["id"])
    edges = edges.union(by_groups(needed.join(sets, "id"), confirm(percent), "a long, b long"))
    label = components(edges)

    rows = found.drop("bands").join(groups, ["d1", "d2"], "left").withColumn("id", F.coalesce("rep", "doc_id"))
    rows = rows.join(label, "id", "left")
    root = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("doc_id").isNull(), None).otherwise(F.coalesce("comp", "id"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), root.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def drop_duplicates(df: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 5, percent: int = 80) -> DataFrame:
    """``df`` with the kept document of every group; its own columns only.  Of rows that share
    id and text, and of rows without id that share their text, one stays."""
    gone = link(df, text, doc_id, width, percent).where("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    rest = df.join(gone, df[f"`{doc_id}`"] == gone["__gone"], "left_anti")
    own = [F.col(f"`{doc_id}`"), F.xxhash64(F.col(f"`{text}`")), F.xxhash64(F.lit(1), F.col(f"`{text}`"))]
    names = ["__id", "__h", "__i"]
    repeated = df.select(*[c.alias(n) for c, n in zip(own, names)]).groupBy(*names).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(*names)
    repeated = keep(repeated, "neardup-repeated")
    if repeated.isEmpty():
        return rest
    rest = rest.withColumns({f"{n}_own": c for c, n in zip(own, names)})
    same = reduce(lambda a, b: a & b, [F.col(f"{n}_own").eqNullSafe(repeated[n]) for n in names])
    marks = [f"{n}_own" for n in names]
    return rest.join(repeated, same, "left_anti").unionByName(rest.join(repeated, same, "left_semi").dropDuplicates(marks)).drop(*marks)
