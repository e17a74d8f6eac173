"""Boosted regression trees, many models in one pass.

Features are binned once by their quantiles.  A tree grows level by level, best splits
first under a budget of leaves, from sums of residuals, weights and rows per (model,
node, feature, bin).  Rows lie in blocks; each block sums up its own rows, and only
sums meet.

* A data set of at most ``BLOCK_CELLS`` values is one block: its models need no exchange
  and grow in a task each, side by side with those of other data sets.
* A larger one is spread over blocks by a hash of its rows.  One Spark job a tree level
  routes the rows, adds up the blocks' histograms of all models of the data set
  (``treeReduce``) and brings the driver sums, whose number doesn't grow with the rows.

Both run ``grow``, and sums are made of integers (residuals scaled to 53 bits), so the
trees don't depend on the number of blocks or the order of rows.

With validation rows and a patience, a model ends when so many rounds brought no lower
validation error, and keeps its best prefix; a flat stretch shorter than that is passed.
"""

from __future__ import annotations

import math
import pickle
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, ensure_checkpoint_dir, ship

BINS = 64                   # bins of a feature's values, beside one for missing values
BLOCK_CELLS = 16_000_000    # values (rows x features) that one task holds at most
KEPT_STATES = 20            # rounds between reliable checkpoints of the blocks' state

PACKED_NODES = 20_000       # nodes of a task's trees that it holds before it gives them on

#: Trees travel packed: nodes of whole rounds from ``first`` on, and a loss for each round.
TREES = "model string, first int, nodes binary, losses binary"
NODE = np.dtype([("round", "i4"), ("node", "i4"), ("feature", "i4"), ("threshold", "f8"), ("below", "i4"), ("value", "f8"), ("gain", "f8")])


@dataclass(frozen=True)
class Boosting:
    """Parameters of one model.  ``leaves`` and ``depth`` bound a tree (0: unbounded), ``rows``
    is the share of rows drawn anew every ``rows_every`` rounds, ``columns`` the share of
    features a tree may use, l1 and l2 shrink leaf values."""
    rounds: int = 500
    patience: int | None = 50
    step: float = 0.05
    leaves: int = 31
    depth: int = 0
    least_rows: int = 20
    columns: float = 1.0
    rows: float = 1.0
    rows_every: int = 1
    l1: float = 0.0
    l2: float = 0.0
    seed: int = 42


@dataclass(frozen=True)
class Fit:
    """One model to grow: its name, its data set and its parameters."""
    model: str
    data: str
    params: Boosting = field(default_factory=Boosting)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class Block:
    """Rows of a data set with the state of the models that grow on it."""

    def __init__(self, bins, label, weight, train, val, row):
        self.bins, self.label, self.weight, self.train, self.val, self.row = bins, label, weight, train, val, row
        self.places = None

    def begin(self, bases, scale, loss_scale, params):
        n, width = len(self.label), self.bins.shape[1] * (BINS + 1)
        self.scale, self.loss_scale, self.params, self.width = scale, loss_scale, params, width
        self.bins, self.by_row = np.asfortranarray(self.bins), np.ascontiguousarray(self.bins)   # a feature's, a row's bins lie together
        self.plain = bool((self.weight == 1.0).all())
        self.scaled_weight = np.rint(self.weight * scale)
        self.value = np.repeat(np.asarray(bases, float)[:, None], n, axis=1)
        self.places = np.zeros((len(params), n), np.int32)
        self.residual: dict[int, np.ndarray] = {}
        self.drawn: dict[int, np.ndarray] = {}

    def open_round(self, k, models):
        """Residuals and drawn rows of a round."""
        for m in models:
            p = self.params[m]
            self.places[m] = 0
            self.residual[m] = np.rint(self.weight * (self.label - self.value[m]) * self.scale)
            if p.rows >= 1.0:
                self.drawn[m] = self.train
            elif k % p.rows_every == 0 or m not in self.drawn:
                turn = np.uint64(((k // p.rows_every) * 1_000_003 + p.seed) & 0xFFFFFFFF)
                with np.errstate(over="ignore"):
                    h = _mix(self.row.view(np.uint64) + _mix(np.array([turn]))[0])
                self.drawn[m] = self.train & ((h >> np.uint64(11)).astype(float) * 2.0 ** -53 < p.rows)

    def route(self, m, feature, cut, below):
        """Rows of split nodes go to the left child, ``below``, or the one after it."""
        place = self.places[m]
        at = np.flatnonzero(feature[place] >= 0)
        node = place[at]
        self.places[m][at] = below[node] + (self.by_row[at, feature[node]] > cut[node])

    def sums(self, wanted: list[tuple[int, int]]) -> np.ndarray:
        """[wanted node, feature x bin, (residual, weight, rows)]."""
        out = np.zeros((len(wanted), self.width, 3))
        by_model: dict[int, list] = {}
        for i, (m, node) in enumerate(wanted):
            by_model.setdefault(m, []).append((i, node))
        for m, own in by_model.items():
            slot = np.full(int(self.places[m].max(initial=0)) + 2, -1, np.int64)
            for j, (_, node) in enumerate(own):
                if node < len(slot):
                    slot[node] = j
            s = np.where(self.drawn[m], slot[self.places[m]], -1)
            at = np.flatnonzero(s >= 0)
            if not len(at):
                continue
            first, many = s[at] * (BINS + 1), len(own) * (BINS + 1)
            residual, weight = self.residual[m][at], None if self.plain else self.scaled_weight[at]
            found = np.empty((len(own), self.bins.shape[1], BINS + 1, 3))
            for f in range(self.bins.shape[1]):     # one feature at a time stays in the cache
                index = first + self.bins[:, f][at]
                found[:, f, :, 0] = np.bincount(index, residual, many).reshape(-1, BINS + 1)
                found[:, f, :, 2] = np.bincount(index, minlength=many).reshape(-1, BINS + 1)
                if weight is not None:
                    found[:, f, :, 1] = np.bincount(index, weight, many).reshape(-1, BINS + 1)
            if weight is None:
                found[..., 1] = found[..., 2] * self.scaled_weight[0]
            out[[i for i, _ in own]] = found.reshape(len(own), self.width, 3)
        return out

    def close_round(self, m, values) -> float:
        """Add the tree's values; the scaled sum of squared errors of validation rows."""
        self.value[m] += values[self.places[m]]
        return float(np.rint(self.weight * (self.label - self.value[m]) ** 2 * self.loss_scale)[self.val].sum())


class _OneBlock:
    """A data set in one block: no exchange."""

    def __init__(self, block):
        self.block = block

    def begin(self, *args):
        self.block.begin(*args)

    def step(self, changes, wanted):
        return _apply(self.block, changes, wanted)

    def end(self):
        pass


class _ManyBlocks:
    """A data set in many blocks: each step is a Spark job over all of them."""

    def __init__(self, spark, blocks):
        self.spark, self.rdd, self.old, self.steps = spark, blocks, [], 0

    def begin(self, *args):
        def run(block):
            block.begin(*args)
            return block
        self.rdd = self.rdd.map(run)

    def step(self, changes, wanted):
        def run(block):
            found = _apply(block, changes, wanted)
            return block, found

        def add(a, b):
            return a[0] + b[0], {m: a[1][m] + b[1][m] for m in a[1]}

        pairs = self.rdd.map(run).persist(StorageLevel.MEMORY_AND_DISK)
        self.rdd = pairs.map(lambda p: p[0])
        self.steps += 1
        if self.steps % KEPT_STATES == 0:
            pairs.checkpoint()
        out = pairs.map(lambda p: p[1]).treeReduce(add)
        for o in self.old:
            o.unpersist()
        self.old = [pairs]
        return out

    def end(self):
        for o in self.old:
            o.unpersist()


def _apply(block, changes, wanted):
    losses = {}
    for kind, *rest in changes:
        if kind == "open":
            block.open_round(*rest)
        elif kind == "route":
            block.route(*rest)
        else:
            losses[rest[0]] = block.close_round(*rest)
    return block.sums(wanted) if wanted else np.zeros(0), losses


def _shrink(g, l1):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


def _best_splits(h, l1, l2, least, allowed, scale):
    """Per node of ``h`` [node, feature, bin, 3]: gain, feature, bin (rows up to it go left) and
    the left child's sums."""
    left = np.cumsum(h, axis=2)
    total = left[:, :1, -1:, :]
    left = left[:, :, :-1, :]
    right = total - left
    score = lambda s: _shrink(s[..., 0] / scale, l1) ** 2 / np.maximum(s[..., 1] / scale + l2, 1e-12)
    gain = score(left) + score(right) - score(total)
    gain = np.where((left[..., 2] >= least) & (right[..., 2] >= least) & allowed[:, :, None], gain, -np.inf)
    flat = gain.reshape(len(h), -1)
    best = flat.argmax(1)
    f, b = np.divmod(best, gain.shape[2])
    i = np.arange(len(h))
    return flat[i, best], f, b, left[i, f, b]


def grow(store, params: list[Boosting], n_features: int, totals: dict):
    """Grow the models of one data set on ``store``.  ``totals``: sums over its rows.  Yields
    (model index, round, tree) and at a round's end (model index, round, loss); a tree is
    (feature, bin, below, value, gain) by node."""
    base = totals["wy"] / totals["w"] if totals["w"] else 0.0
    reach = 4.0 * max(totals["high"] - totals["low"], 1e-9) * max(totals["most"], 1e-9) * max(totals["n"], 1)
    scale = 2.0 ** math.floor(53 - math.log2(max(reach, 4.0 * totals["most"] * max(totals["n"], 1), 1e-300)) - 1)
    squares = 16.0 * max(totals["high"] - totals["low"], 1e-9) ** 2 * max(totals["most"], 1e-9) * max(totals["n"], 1)
    loss_scale = 2.0 ** math.floor(53 - math.log2(squares) - 1)
    store.begin([base] * len(params), scale, loss_scale, params)
    alive = list(range(len(params)))
    best = {m: (math.inf, -1) for m in alive}
    k, closing = 0, []
    while alive:
        trees = {m: dict(feature=[-1], cut=[0], below=[0], value=[0.0], gain=[0.0]) for m in alive}
        chance = {m: np.random.default_rng([params[m].seed, k]) for m in alive}
        allowed = {}
        for m in alive:
            a = np.zeros(n_features, bool)
            a[chance[m].choice(n_features, max(1, round(n_features * params[m].columns)), replace=False)] = True
            allowed[m] = a
        level = [(m, 0) for m in alive]                 # nodes that may split
        found, _ = store.step([("open", k, list(alive))], level)
        hist = dict(zip(level, found))
        leaves, depth = dict.fromkeys(alive, 1), 0
        root = {m: hist[(m, 0)].reshape(n_features, BINS + 1, 3)[0].sum(0) for m in alive}
        for m in alive:
            trees[m]["value"][0] = _leaf(root[m], params[m], scale)
        while level:
            depth += 1
            p = [params[m] for m, _ in level]
            h = np.stack([hist[x] for x in level]).reshape(len(level), n_features, BINS + 1, 3)
            column = lambda name: np.array([float(getattr(q, name)) for q in p])[:, None, None]  # noqa: E731, B023
            gain, f, b, left = _best_splits(h, column("l1"), column("l2"), column("least_rows"), np.stack([allowed[m] for m, _ in level]), scale)
            whole = h[:, 0].sum(1)
            order = sorted((i for i in range(len(level)) if gain[i] > 1e-10), key=lambda i: (-gain[i], i))
            taken = []
            for i in order:
                m = level[i][0]
                q = params[m]
                if (not q.leaves or leaves[m] < q.leaves) and (not q.depth or depth <= q.depth):
                    leaves[m] += 1
                    taken.append(i)
            taken.sort()
            changes, wanted, sibling = [], [], {}
            for m in {level[i][0] for i in taken}:
                t = trees[m]
                for i in (i for i in taken if level[i][0] == m):
                    node, at = level[i][1], len(t["feature"])
                    t["feature"][node], t["cut"][node], t["below"][node], t["gain"][node] = int(f[i]), int(b[i]), at, float(gain[i])
                    right = whole[i] - left[i]
                    for s in (left[i], right):
                        for name, v in (("feature", -1), ("cut", 0), ("below", 0), ("value", _leaf(s, params[m], scale)), ("gain", 0.0)):
                            t[name].append(v)
                    small, large = (at, at + 1) if left[i][2] <= right[2] else (at + 1, at)
                    wanted.append((m, small))
                    sibling[(m, small)] = ((m, large), level[i])
                changes.append(("route", m, *(np.array(t[c], np.int64) for c in ("feature", "cut", "below"))))
            if not taken:
                break
            go_on = [x for x in wanted if not (params[x[0]].leaves and leaves[x[0]] >= params[x[0]].leaves) and not (params[x[0]].depth and depth >= params[x[0]].depth)]
            found, _ = store.step(changes, go_on)
            new = {}
            for x, s in zip(go_on, found):
                other, parent = sibling[x]
                new[x], new[other] = s, hist[parent] - s
            hist, level = new, sorted(new)
        done, closing = [], []
        for m in alive:
            values = params[m].step * np.array(trees[m]["value"])
            trees[m]["value"] = values.tolist()
            closing.append(("close", m, values))
        _, losses = store.step(closing, [])
        for m in alive:
            loss = losses[m] / loss_scale
            yield m, k, trees[m], loss
            q = params[m]
            if loss < best[m][0]:
                best[m] = (loss, k)
            checked = totals["n_val"] > 0 and q.patience is not None
            if k + 1 >= q.rounds or len(trees[m]["feature"]) == 1 or checked and k - best[m][1] >= q.patience:
                done.append(m)
        alive = [m for m in alive if m not in done]
        k += 1
    store.end()


def _leaf(s, p: Boosting, scale: float) -> float:
    return float(_shrink(s[0] / scale, p.l1) / max(s[1] / scale + p.l2, 1e-12)) if s[2] else 0.0


# --- data sets -------------------------------------------------------------------------

def _edges(frame: DataFrame, n_features: int) -> dict[str, list[np.ndarray]]:
    """Distinct quantiles of each feature among each data set's training rows."""
    at = [k / BINS for k in range(1, BINS)]
    cells = [F.percentile_approx(F.nanvl(F.get("features", F.lit(i)), F.lit(None).cast("double")), at, F.lit(10_000)).alias(f"f{i}") for i in range(n_features)]
    rows = frame.where(F.col("split") == "train").groupBy("data").agg(*cells).collect()   # data sets x features x bins
    return {r["data"]: [np.unique(np.array(r[f"f{i}"] or [], float)) for i in range(n_features)] for r in rows}


def _binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """0: missing; k: at most the k-th edge; beyond all edges: their number plus 1."""
    out = np.empty(values.shape, np.uint8)
    for i, e in enumerate(edges):
        v = values[:, i]
        out[:, i] = np.where(np.isnan(v), 0, np.searchsorted(e, v, "left") + 1)
    return out


def _block(table: pa.Table, edges, n_features: int) -> Block:
    split = np.array(table.column("split").to_pylist())
    flat = table.column("features").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float)
    label, weight = (table.column(c).to_numpy().astype(float) for c in ("label", "weight"))
    row = np.ascontiguousarray(table.column("row").to_numpy().astype(np.int64))
    return Block(_binned(flat.reshape(len(label), n_features), edges), label, weight, split == "train", split == "val", row)


def _threshold(edges, f: int, cut: int) -> float:
    """Values up to it, and missing ones, go left."""
    return -math.inf if cut == 0 else float(edges[f][cut - 1]) if cut <= len(edges[f]) else math.inf


def _packed(k: int, tree: dict, edges) -> np.ndarray:
    out = np.zeros(len(tree["feature"]), NODE)
    out["round"], out["node"] = k, np.arange(len(out))
    out["threshold"] = [_threshold(edges, f, c) if f >= 0 else 0.0 for f, c in zip(tree["feature"], tree["cut"])]
    for name in ("feature", "below", "value", "gain"):
        out[name] = tree[name]
    return out


_NAMES = [x.split()[0] for x in TREES.split(", ")]
_KINDS = [pa.string(), pa.int32(), pa.binary(), pa.binary()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], names=_NAMES)


def _grown(block_store, fits: list[Fit], edges, n_features: int, totals: dict):
    held: dict[int, tuple[list, list]] = {}

    def given():
        return _batch([(fits[m].model, int(trees[0]["round"][0]), np.concatenate(trees).tobytes(), np.array(losses, float).tobytes()) for m, (trees, losses) in held.items()])

    n = 0
    for m, k, tree, loss in grow(block_store, [f.params for f in fits], n_features, totals):
        trees, losses = held.setdefault(m, ([], []))
        trees.append(_packed(k, tree, edges))
        losses.append(loss)
        n += len(trees[-1])
        if n > PACKED_NODES:
            yield given()
            held.clear()
            n = 0
    if held:
        yield given()


class Boosted:
    """A grown model: ``base`` plus the sums of its trees' values."""

    def __init__(self, features: list[str], base: float, nodes, losses: list[float], kept: int):
        """``nodes``: (round, node, feature, threshold, below, value, gain) of all rounds, in
        order, as tuples or an array of ``NODE``; the first ``kept`` rounds count.  They stay
        arrays: 40 bytes a node, where tuples took hundreds."""
        self.features, self.base, self.losses, self.n_trees = features, base, losses, kept
        own = np.asarray(nodes, NODE) if len(nodes) else np.zeros(0, NODE)
        own = own[own["round"] < kept]
        at = np.flatnonzero(own["node"] == 0)
        self.roots = at.tolist()
        self.start = at[np.cumsum(own["node"] == 0) - 1].astype(np.int32) if len(own) else np.zeros(0, np.int32)
        self.round, self.feature, self.threshold, self.value, self.gain = (own[c].copy() for c in ("round", "feature", "threshold", "value", "gain"))
        self.below = own["below"] + self.start

    @property
    def nodes(self) -> list[tuple]:
        """The kept rounds' nodes as tuples."""
        node = np.arange(len(self.start), dtype=np.int32) - self.start
        return list(zip(*(c.tolist() for c in (self.round, node, self.feature, self.threshold, self.below - self.start, self.value, self.gain))))

    def scorer(self) -> Boosted:
        """What tasks need to predict."""
        out = Boosted([], self.base, [], [], 0)
        out.roots, out.feature, out.threshold, out.below, out.value = self.roots, self.feature, self.threshold, self.below, self.value
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        every = np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while True:
                f = self.feature[at]
                inner = np.flatnonzero(f >= 0)
                if not len(inner):
                    break
                v = x[every[inner], f[inner]]
                at[inner] = self.below[at[inner]] + (v > self.threshold[at[inner]])
            out += self.value[at]
        return out

    def importances(self) -> list[float]:
        """Each feature's share of the gain of all splits."""
        sums = np.bincount(self.feature[self.feature >= 0], self.gain[self.feature >= 0], len(self.features))
        return (sums / sums.sum() if sums.sum() else sums).tolist()

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the column ``prediction``."""
        return transform_many(df, {None: self})

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(self.features, self.base, self.losses, self.n_trees)], "features array<string>, base double, losses array<double>, n_trees int").write.mode("overwrite").parquet(f"{path}/model")
        kind = "round int, node int, feature int, threshold double, below int, value double, gain double"
        spark.createDataFrame(self.nodes, kind).write.mode("overwrite").parquet(f"{path}/nodes")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Boosted:
        m = spark.read.parquet(f"{path}/model").first()
        nodes = [tuple(r) for r in spark.read.parquet(f"{path}/nodes").orderBy("round", "node").collect()]
        return cls(m["features"], m["base"], nodes, m["losses"], m["n_trees"])


def transform_many(df: DataFrame, models: dict, on: str | None = None) -> DataFrame:
    """``df`` with ``prediction``, a row by the model whose name the column ``on`` holds (one
    model for all: key None).  The models, bounded by rounds x leaves, are broadcast."""
    ship(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast({k: (m.features, m.scorer()) for k, m in models.items()})
    names = df.columns
    used = sorted({f for m in models.values() for f in m.features})
    plain = df.select(*names, *[F.col(f).cast("double").alias(f"__x{i}") for i, f in enumerate(used)])
    schema = T.StructType([*df.schema.fields, T.StructField("prediction", T.DoubleType())])
    place = {f: len(names) + i for i, f in enumerate(used)}

    def run(batches):
        for batch in batches:
            out = np.full(batch.num_rows, np.nan)
            key = np.array(batch.column(names.index(on)).to_pylist(), object) if on else None
            for k, (feats, m) in sent.value.items():
                at = np.flatnonzero(key == k) if on else np.arange(batch.num_rows)
                if len(at):
                    x = np.column_stack([batch.column(place[f]).to_numpy(zero_copy_only=False).astype(float)[at] for f in feats])
                    out[at] = m.predict(x)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(out)], names=[*names, "prediction"])

    return plain.mapInArrow(run, schema)


def predict_many(rows: DataFrame, models: dict[str, tuple[str, Boosted]]) -> DataFrame:
    """For each row (data, label, features) and each model (data set, trees) of its data set:
    model, label, prediction."""
    ship(rows.sparkSession)
    sent = rows.sparkSession.sparkContext.broadcast({k: (own, m.scorer()) for k, (own, m) in models.items()})
    names = ["model", "label", "prediction"]

    def run(batches):
        for batch in batches:
            data = np.array(batch.column(0).to_pylist(), object)
            for d in dict.fromkeys(data.tolist()):
                at = np.flatnonzero(data == d)
                label = batch.column(1).take(pa.array(at))
                x = np.array(batch.column(2).take(pa.array(at)).to_pylist(), float)
                for name, (own, m) in sent.value.items():
                    if own == d:
                        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), label, pa.array(m.predict(x))], names=names)

    return rows.select("data", "label", "features").mapInArrow(run, "model string, label double, prediction double")


def fit_many(frame: DataFrame, fits: list[Fit], features: dict[str, list[str]], block_cells: int | None = None, task_models: int = 8) -> dict[str, Boosted]:
    """Grow all ``fits``.  ``frame``, written: data (the data set), row (a long that tells rows
    apart), split (train, val; others are left out), label, weight, features (array<double>,
    null or NaN: missing); ``features`` names each data set's.  The models of data sets of one
    block are dealt over all cores, at most ``task_models`` to a task: a model's trees don't
    depend on those beside it."""
    spark = frame.sparkSession
    ship(spark)
    block_cells = block_cells or BLOCK_CELLS
    width = max(len(f) for f in features.values())
    used = frame.where(F.col("split").isin("train", "val"))
    train = F.col("split") == "train"
    sums = used.groupBy("data").agg(
        F.count_if(train).alias("n"), F.count_if(~train).alias("n_val"), F.count("*").alias("rows"), F.sum(F.when(train, F.col("weight"))).alias("w"),
        F.sum(F.when(train, F.col("weight") * F.col("label"))).alias("wy"), F.min("label").alias("low"), F.max("label").alias("high"), F.max("weight").alias("most"))
    totals = {r["data"]: {k: float(v or 0) for k, v in r.asDict().items() if k != "data"} for r in sums.collect()}
    for t in totals.values():   # sums of doubles in any order: the base is rounded to 40 bits
        for c in ("w", "wy"):
            t[c] = float(np.float64(f"{t[c]:.11e}"))
        t["n"] += t["n_val"]
    edges = _edges(used, width)
    todo: dict[str, list[Fit]] = {}
    for f in fits:
        if f.data in totals and f.data in edges:
            todo.setdefault(f.data, []).append(f)
    large = [d for d in todo if totals[d]["rows"] * len(features[d]) > block_cells]
    single = {d: own for d, own in todo.items() if d not in large}
    share = max(1, min(task_models, math.ceil(sum(map(len, single.values())) / spark.sparkContext.defaultParallelism)))
    small = {}
    for d, own in single.items():
        for i in range(0, len(own), share):
            small[len(small)] = (d, own[i:i + share])
    parts = []   # packed rows, from a table of the small ones and from the driver
    if small:
        units = spark.createDataFrame([(u, d) for u, (d, _) in small.items()], "unit int, data string")
        rows = used.join(F.broadcast(units), "data").repartitionById(len(small), F.col("unit"))
        heads = rows.select("unit", "row", "split", "label", "weight", "features")

        def run(batches):
            tables = [b for b in batches if b.num_rows]
            if not tables:
                return
            table = pa.Table.from_batches(tables)
            d, own = small[table.column("unit")[0].as_py()]
            n = len(features[d])
            yield from _grown(_OneBlock(_block(table, edges[d][:n], n)), own, edges[d][:n], n, totals[d])

        parts.append(map(tuple, cut_lineage(heads.mapInArrow(run, TREES), "boosted-trees").toLocalIterator()))
    for d in large:
        n = len(features[d])
        count = math.ceil(totals[d]["rows"] * n / block_cells)
        own = used.where(F.col("data") == d).select("row", "split", "label", "weight", "features").repartition(count, "row")

        def pack(batches, e=edges[d][:n], n=n):
            tables = [b for b in batches if b.num_rows]
            if tables:
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(_block(pa.Table.from_batches(tables), e, n))], pa.binary())], names=["block"])

        kept = cut_lineage(own.mapInArrow(pack, "block binary"), "boosting-blocks")
        ensure_checkpoint_dir(spark)
        blocks = kept.rdd.map(lambda r: pickle.loads(r[0]))
        grown = _grown(_ManyBlocks(spark, blocks), todo[d], edges[d][:n], n, totals[d])
        parts.append([r for b in grown for r in zip(*(c.to_pylist() for c in b.columns))])
    return _assemble(parts, fits, features, totals)


def _assemble(parts, fits, features, totals) -> dict[str, Boosted]:
    packed: dict[str, dict[int, tuple]] = {}
    for p in parts:
        for model, first, nodes, losses in p:   # models x rounds x nodes of a tree, 40 bytes each
            packed.setdefault(model, {})[first] = (np.frombuffer(bytes(nodes), NODE), np.frombuffer(bytes(losses), float))
    out = {}
    for f in fits:
        t = totals.get(f.data)
        if f.model not in packed:
            if t and t["w"]:
                out[f.model] = Boosted(features[f.data], t["wy"] / t["w"], [], [], 0)
            continue
        own = [v for _, v in sorted(packed.pop(f.model).items())]
        curve = np.concatenate([x for _, x in own]).tolist()
        checked = t["n_val"] > 0 and f.params.patience is not None
        kept = int(np.argmin(curve)) + 1 if checked else len(curve)
        out[f.model] = Boosted(features[f.data], t["wy"] / t["w"], np.concatenate([x for x, _ in own]), [x / max(t["n_val"], 1) for x in curve], kept)
    return out
