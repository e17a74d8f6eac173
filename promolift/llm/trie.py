"""Prefix trie of conversations (operator 11).

Every distinct sequence of a conversation's first d turns is a node.  A turn's id is a
128-bit hash of its role and text; conversations become rows with one column a position,
and ``GROUP BY ROLLUP`` over those columns, with ``grouping_id``, aggregates all prefixes
together.  A block has ``WIDTH`` positions; conversations that go on and still share their
prefix with another sequence continue in the next block, keyed by their node at the end
of the block before.  A sequence that is alone under its node has nothing left to share:
its further nodes follow turn by turn.  A second rollup, over the nodes, from the last
block to the first, sums up subtrees.

Equal conversations are merged before the first rollup.  Rounds number the longest prefix
that two different conversations share, divided by ``WIDTH``.  Nothing holds a whole
conversation: turns are numbered by sorted ranges and prefix sums, and rows that meet a
value of their conversation's do so by broadcast for the fewer than ``MANY`` conversations
that have more than a ``MANY``-th of all rows, by shuffle for the others.  The hash of the
ids that end at a node is sequential by its definition: its text, in pieces of ``PIECE``
ids, streams through one task a node and isn't held.

Defined cases: turns without a conversation id take no part.  Null roles and texts are
empty.  Turns are ordered by ``turn``, nulls first, turns of equal number by their hash;
repeated rows are turns of their own.  An empty table has no nodes, not even a root.
Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MANY, keep, ship, with_values
from .ordering import lookup, spread

WIDTH = 8     # positions a block
PIECE = 512

_SLOTS = range(1, WIDTH + 1)
_T = [f"t{k}" for k in _SLOTS]
_NOTHING = hashlib.sha256(b"").hexdigest()


def own_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Every conversation's turns in order: c, p (from 1), the id x, y and the UTF-8 length b
    of its text, and cum, the length of the conversation's texts up to it.  Written."""
    ship(conversations.sparkSession)
    cols = [conversations[f"`{n}`"] for n in (conv, turn, role, text)]
    said = [F.coalesce(c, F.lit("")) for c in cols[2:]]
    rows = conversations.where(cols[0].isNotNull()).select(
        cols[0].cast("long").alias("c"), cols[1].alias("turn"), F.xxhash64(F.lit(1), *said).alias("x"), F.xxhash64(F.lit(2), *said).alias("y"),
        F.octet_length(said[1]).cast("long").alias("b"))
    rows = spread(rows, [F.col("c"), F.col("turn").asc_nulls_first(), F.col("x"), F.col("y")])

    def run(batches):
        last, p, cum = None, 0, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            c, b = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 3))
            begins = np.concatenate([[c[0] != last], c[1:] != c[:-1]])
            start = np.maximum.accumulate(np.where(begins, np.arange(len(c)), -1))
            total = np.concatenate([[0], np.cumsum(b)])
            at = np.maximum(start, 0)
            places = np.arange(1, len(c) + 1) - at + np.where(start < 0, p, 0)
            sums = total[1:] - total[at] + np.where(start < 0, cum, 0)
            last, p, cum = c[-1], int(places[-1]), int(sums[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64()), pa.array(sums, pa.int64())], names=["c", "x", "y", "b", "part", "place", "p", "cum"])

    kept = keep(rows.drop("turn").mapInArrow(run, "c long, x long, y long, b long, part int, place long, p long, cum long"), "turns")
    # a conversation that spans ranges: what it has in the ranges before, from one row a range
    ends = kept.groupBy("part").agg(F.min("c").alias("first"), F.max("c").alias("last"), F.max_by(F.struct("p", "cum"), "place").alias("end")).orderBy("part").collect()
    number, length, firsts, before = {}, {}, {}, (None, 0, 0)
    for r in ends:
        own = before[1:] if before[0] == r["first"] else (0, 0)
        number[r["part"]], length[r["part"]], firsts[r["part"]] = *own, r["first"]
        more = own if r["first"] == r["last"] else (0, 0)
        before = (r["last"], more[0] + r["end"]["p"], more[1] + r["end"]["cum"])
    goes_on = F.col("c") == lookup(F.col("part"), firsts)
    add = lambda c, table: (F.col(c) + F.when(goes_on, lookup(F.col("part"), table)).otherwise(0)).alias(c)
    return kept.select("c", add("p", number), "x", "y", "b", add("cum", length))


def branched(turns: DataFrame, base, length, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that share beginnings: each c begins with the first ``length(c)`` turns
    (``most`` at most; all if fewer, none if absent) of conversation ``base(c)``, which is its
    own base, then goes on with its own turns after its first ``length(c)``.  Returns (rows c, d, x, y, b, cum;
    conversations c), both written."""
    own = turns.withColumn("h", length(F.col("c")))
    total = own.count()
    convs = own.groupBy("c", "h").agg(F.count("*").alias("n_own"), F.max(F.when(F.col("p") <= F.col("h"), F.col("cum"))).alias("cut"))
    heads = own.where((F.col("p") <= most) & (base(F.col("c")) == F.col("c"))).groupBy(F.col("c").alias("base")).agg(F.sort_array(F.collect_list(F.struct("p", "x", "y", "b", "cum"))).alias("head"))
    convs = convs.withColumn("base", base(F.col("c"))).join(heads, "base", "left")
    convs = convs.withColumn("head", F.coalesce(F.filter("head", lambda t: t["p"] <= F.col("h")), F.array()))
    convs = keep(convs.select("c", "h", "n_own", F.coalesce("cut", F.lit(0)).alias("cut"), "head", F.size("head").alias("m"),
                              F.coalesce(F.get("head", F.size("head") - 1)["cum"], F.lit(0)).alias("head_cum")), "conversations")
    first = convs.select("c", F.explode("head").alias("t")).select("c", F.col("t.p").alias("d"), "t.x", "t.y", "t.b", "t.cum")
    after = with_values(own.where(F.col("p") > F.col("h")).drop("h"), convs.drop("head"), ["c"], F.col("n_own"), total)
    after = after.select("c", (F.col("p") - F.col("h") + F.col("m")).alias("d"), "x", "y", "b", (F.col("cum") - F.col("cut") + F.col("head_cum")).alias("cum"))
    return keep(first.unionByName(after), "branches"), convs.select("c")


def _digest(salt: int, *cols) -> Column:
    return F.xxhash64(F.lit(salt), *cols)


def _key(level: int, upto: int) -> list[Column]:
    """Node key (two hashes) of the first ``upto`` columns of a block under its key kx, ky."""
    if upto == 0:
        return [F.col("kx"), F.col("ky")]
    return [_digest(salt, F.lit(upto), "kx", "ky", *_T[:upto]) for salt in (3, 4)]


def _rollup(table: DataFrame, sums: str) -> DataFrame:
    """``sums`` of every prefix of a block's columns, with its level; prefixes that go beyond
    a sequence's end are no nodes."""
    columns = ", ".join(_T)
    out = table.sparkSession.sql(f"SELECT kx, ky, {columns}, {WIDTH} - bit_count(grouping_id()) AS level, {sums} FROM {{block}} GROUP BY kx, ky, ROLLUP ({columns})", block=table)
    return out.where((F.col("level") == 0) | F.get(F.array(*_T), F.col("level").cast("int") - 1).isNotNull())


def _wide(rows: DataFrame) -> DataFrame:
    """One row for each block of WIDTH turns of a conversation: its turns' ids in columns,
    and the length of the conversation's texts up to its end."""
    slot = F.pmod(F.col("d") - 1, F.lit(WIDTH)) + 1
    cells = [F.max(F.when(slot == k, F.col(c))).alias(f"{c}{k}") for k in _SLOTS for c in "xyb"]
    wide = rows.groupBy("c", F.expr(f"(d - 1) div {WIDTH}").alias("block")).agg(*cells, F.max("cum").alias("cum"))
    ids = [F.when(F.col(f"x{k}").isNotNull(), F.struct(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y"), F.col(f"b{k}").alias("b"))).alias(f"t{k}") for k in _SLOTS]
    return wide.select("c", "block", "cum", *ids)


def _ends(convs: DataFrame) -> DataFrame:
    """For each distinct sequence (x, y, n): its smallest conversation c and the SHA-256 of
    all its conversations, ascending, joined by commas."""
    rows = spread(convs.select("x", "y", "n", "c"), [F.col(k) for k in ("x", "y", "n", "c")])

    def pieces(batches):
        for batch in batches:
            x, y, n, c, part, place = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(6))
            if not len(c):
                continue
            cut = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (n[1:] != n[:-1])]))
            starts = np.unique(np.concatenate([np.arange(a, b, PIECE) for a, b in zip(cut, [*cut[1:], len(c)])]))
            texts = [",".join(map(str, c[a:b].tolist())) for a, b in zip(starts, [*starts[1:], len(c)])]
            yield pa.RecordBatch.from_arrays([*[pa.array(v[starts]) for v in (x, y, n, part, place)], pa.array(texts)], names=["x", "y", "n", "part", "place", "ids"])

    def digests(batches):
        now, first, sha = None, 0, None
        for batch in batches:
            out = []
            for r in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if r[:3] == now:
                    sha.update(b",")
                else:
                    if now is not None:
                        out.append((first, sha.hexdigest()))
                    now, first, sha = r[:3], int(r[3].split(",", 1)[0]), hashlib.sha256()
                sha.update(r[3].encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([v[0] for v in out], pa.int64()), pa.array([v[1] for v in out])], names=["ended", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([sha.hexdigest()])], names=["ended", "ends_sha256"])

    found = rows.mapInArrow(pieces, "x long, y long, n long, part int, place long, ids string")
    found = found.repartition("x", "y", "n").sortWithinPartitions("x", "y", "n", "part", "place")
    return found.select("x", "y", "n", "ids").mapInArrow(digests, "ended long, ends_sha256 string")


def nodes(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie of conversations ``convs`` (c, each once; also turnless ones) with turns
    ``rows`` (c, d, x, y, b, cum), both written.  Per node: conv_id (its smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    ship(rows.sparkSession)
    wide = keep(_wide(rows), "blocks")
    # what a conversation says, in any order of its rows: xor of the hashes of (place, turn)
    said = rows.groupBy("c").agg(*[F.bit_xor(_digest(s, "d", "x", "y")).alias(n) for s, n in ((5, "x"), (6, "y"))], F.max("d").alias("n"), F.max("cum").alias("bytes"))
    said = keep(convs.join(said, "c", "left").fillna(0), "sequences")
    distinct = said.groupBy("x", "y", "n").agg(F.min("c").alias("c"), F.count("*").alias("members"), F.max("bytes").alias("bytes")).drop("x", "y")
    ends = keep(_ends(said), "ends")

    lines = distinct.withColumns({"kx": F.lit(0).cast("long"), "ky": F.lit(0).cast("long")})
    found, block = [], 0
    while True:
        depth = block * WIDTH
        lines = lines.join(wide.where(F.col("block") == block).drop("block"), "c", "left")
        lines = keep(lines.withColumn("rest", F.col("bytes") - F.coalesce("cum", F.lit(0))).drop("cum"), f"lines-{block}")
        level = _rollup(lines, "min(c) AS conv_id, sum(members) AS n_convs, count(*) AS n_lines, max(n) AS deepest, min(n) AS least, min_by(c, n) AS shortest, max(rest) AS rest, max(bytes) AS bytes")
        level = level.where((F.col("level") > 0) | F.lit(block == 0)).withColumn("depth", F.col("level") + depth)
        level = keep(level, f"prefixes-{block}")
        found.append(level)
        alone = level.where((F.col("level") == WIDTH) & (F.col("n_lines") == 1) & (F.col("deepest") > F.col("depth")))
        going = lines.where(F.col("n") > depth + WIDTH).join(alone.select(F.col("conv_id").alias("c")), "c", "left_anti")
        key = _key(WIDTH, WIDTH)
        lines = keep(going.select("c", "members", "n", "bytes", key[0].alias("kx"), key[1].alias("ky")), f"going-{block}")
        if lines.isEmpty():
            break
        block += 1

    # subtrees, from the last block to the first
    out, under = [], None
    for level in reversed(found):
        key = _key(WIDTH, WIDTH)
        leaf, last = F.col("deepest") == F.col("depth"), F.col("level") == WIDTH
        own = (F.col("n_convs") - 1) * F.coalesce(F.get(F.array(*_T), F.col("level").cast("int") - 1)["b"], F.lit(0))
        tail = last & (F.col("n_lines") == 1) & ~leaf
        level = level.withColumns({
            "leaves": (leaf | tail).cast("long"), "saved": own + F.when(tail, (F.col("n_convs") - 1) * F.col("rest")).otherwise(0), "below": tail.cast("long"),
            "ended": F.when(F.col("least") == F.col("depth"), F.col("shortest"))})
        if under is not None:
            level = level.withColumns({"nx": F.when(last, key[0]), "ny": F.when(last, key[1])}).join(under, ["nx", "ny"], "left")
            level = level.withColumns({c: F.col(c) + F.coalesce(f"{c}_under", F.lit(0)) for c in ("leaves", "saved", "below")})
        counts = ", ".join(f"count_if(level = {k}) AS n{k}" for k in _SLOTS)
        sums = _rollup(level.drop("nx", "ny"), "min(conv_id) AS conv_id, max(n_convs) AS n_convs, min_by(ended, level) AS ended, sum(leaves) AS leaves, sum(saved) AS saved, "
                       f"max(CASE WHEN level = {WIDTH} THEN below END) AS below, min(depth) AS depth, {counts}")
        sums = keep(sums.withColumn("children", F.get(F.array(*[F.col(f"n{k}") for k in _SLOTS], F.col("below")), F.col("level").cast("int"))), "subtrees")
        under = sums.where(F.col("level") == 0).select(F.col("kx").alias("nx"), F.col("ky").alias("ny"), *[F.col(a).alias(f"{b}_under") for a, b in (("leaves", "leaves"), ("saved", "saved"), ("n1", "below"))])
        out.append(sums)

    own, parent = [F.when(F.col("level") == 0, F.col(c)) for c in ("kx", "ky")], [F.lit(None).cast("long")] * 2
    for k in _SLOTS:
        here, above = _key(k, k), _key(k, k - 1)
        own = [F.when(F.col("level") == k, h).otherwise(o) for h, o in zip(here, own)]
        parent = [F.when(F.col("level") == k, a).otherwise(o) for a, o in zip(above, parent)]
    shared = None
    for i, sums in enumerate(reversed(out)):
        one = sums.where((F.col("level") > 0) | F.lit(i == 0)).select(
            "conv_id", "depth", "n_convs", "children", "leaves", "saved", "ended", own[0].alias("nx"), own[1].alias("ny"), parent[0].alias("kx"), parent[1].alias("ky"))
        shared = one if shared is None else shared.unionByName(one)
    shared = keep(shared, "nodes")
    parents = shared.where(F.col("children") > 0).select(F.col("nx").alias("kx"), F.col("ny").alias("ky"), F.col("conv_id").alias("parent_conv_id"), "children")
    children = shared.where(F.col("depth") > 0).withColumnRenamed("children", "n_children").drop("nx", "ny")
    linked = with_values(children, parents, ["kx", "ky"], F.col("children"), children.count())
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "leaves", "saved", "ended"]
    root = shared.where(F.col("depth") == 0).withColumns({"parent_conv_id": F.lit(None).cast("long"), "n_children": F.col("children")})
    every = root.select(*columns).unionByName(linked.select(*columns))
    for i, level in enumerate(found):
        every = every.unionByName(_tails(level, wide, (i + 1) * WIDTH).select(*columns))
    every = every.join(ends, "ended", "left")
    return every.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                        F.coalesce("ends_sha256", F.lit(_NOTHING)).alias("ends_sha256"))


def _tails(level: DataFrame, wide: DataFrame, depth: int) -> DataFrame:
    """The nodes beyond a block's end of sequences that are alone there, turn by turn."""
    alone = level.where((F.col("level") == WIDTH) & (F.col("n_lines") == 1) & (F.col("deepest") > depth))
    left = F.sequence(F.lit(depth // WIDTH).cast("long"), F.expr(f"(deepest - 1) div {WIDTH}"))
    rows = alone.select(F.col("conv_id").alias("c"), "n_convs", "deepest", "bytes", F.explode(left).alias("block")).join(wide, ["c", "block"])
    after = F.aggregate(F.slice(F.array(*_T), F.col("slot") + 1, WIDTH), F.lit(0).cast("long"), lambda a, t: a + F.coalesce(t["b"], F.lit(0)))
    rows = rows.select("*", F.posexplode(F.array(*_T)).alias("slot", "t")).where(F.col("t").isNotNull()).withColumn("depth", F.col("block") * WIDTH + F.col("slot") + 1)
    goes_on = F.col("depth") < F.col("deepest")
    return rows.select(
        F.col("c").alias("conv_id"), "depth", F.col("c").alias("parent_conv_id"), "n_convs", goes_on.cast("long").alias("n_children"), F.lit(1).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * (F.col("bytes") - F.col("cum") + after)).alias("saved"), F.when(~goes_on, F.col("c")).alias("ended"))
