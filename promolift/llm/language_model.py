"""Language-model scores by a gated recurrent network, trained in numpy.

Word counts come from all learned documents.  The most frequent words are the network's
own vocabulary; every other word enters and leaves it as one of a fixed number of rare
classes (by its ending).  The output is class-factored: a softmax over classes, then one
within the class (frequent words, in bands of equal number) or the corpus's own
distribution of the class (rare words, add-half counts, with a place for unseen words).

Training is truncated backpropagation: documents run in lockstep by windows of a few
words, the state is carried from window to window, gradients stop at its edge.  A small
seeded sample gives a common start; then every part, dealt by a hash of key and content,
trains on all its learned documents and the networks are averaged by tokens, in a tree.
Scores don't depend on how the input is split into files and partitions.  Scoring carries the state
through whole documents, so that a score is the log-probability of the complete text.

At scale: counts are gathered by partition before the shuffle.  Counts of the ``TOP``
most frequent words (a fixed bound) are handed to every task; only words beyond them are
shuffled to their counts, so that no frequent word becomes a hot key.  The network's size
doesn't depend on the corpus.

Defined cases: a null or empty text is the end token alone; a null key counts as an empty
one when documents are split; texts are scored whole; equal texts get equal scores; if
nothing is learned, counts are 0 and the network gives its initial, nearly even
distribution; extra columns don't matter; an empty table gives no rows.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drawn, keep, map_texts, mix64, ship, slices

#: Frequent words of the network (the end token among them), words of a band, rare classes.
OWN, BAND, RARE = 1024, 32, 32
BANDS = OWN // BAND
CLASSES = BANDS + RARE
#: Size of the state, words of a window, documents of a training batch.
STATE, WINDOW, BATCH = 16, 16, 512
#: Words whose counts every task gets; documents of the common start; tokens held at once.
TOP, START, HELD = 1 << 18, 600, 8_000_000
#: Learned tokens of a part, about; a part of more than HELD is trained in several goes.
PART_TOKENS = 4_000_000
#: Characters whose words are found at once.
SLICE = 1_500_000
BOS = OWN + RARE


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?\"')]}*&%$#")] = True
_VALUE = np.random.default_rng(64).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


_TABLES: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the hash's base and of its inverse, modulo 2**64."""
    if len(_TABLES.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            x = np.full(1 << max(21, int(n - 1).bit_length()), base, np.uint64)
            x[0] = 1
            _TABLES[name] = np.multiply.accumulate(x)
    return _TABLES["up"], _TABLES["down"]


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, rare class, text) of every word of the texts, in order.

    The texts are one array of bytes, A-Z in lower case, words found at the edges of white
    space.  A word's hash is a polynomial of random byte values modulo 2**64, from running
    sums, with a finaliser.  Its rare class (``RARE``) is told by its last two bytes before
    punctuation and by whether it has some."""
    parts = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
    raw = np.frombuffer((b"\n" + b"\n".join(parts) + b"\n").lower(), np.uint8)
    space = _SPACE[raw]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    up, down = _powers(len(raw))
    sums = _VALUE[raw]
    sums *= up[:len(raw)]
    np.cumsum(sums, out=sums)
    h = mix64((sums[end - 1] - sums[start - 1]) * down[start] + (end - start).astype(np.uint64)).view(np.int64)
    last, live = end.copy(), np.arange(len(end))
    while len(live):
        live = live[_MARK[raw[last[live] - 1]] & (last[live] > start[live])]
        last[live] -= 1
    one = np.where(last > start, raw[last - 1], 0).astype(np.int64)
    two = np.where(last > start + 1, raw[last - 2], 0).astype(np.int64)
    kind = (one * 263 + two * 7) % (RARE // 2) * 2 + (last < end)
    begin = np.cumsum([1, *[len(p) + 1 for p in parts]])
    return h, kind.astype(np.int16), np.searchsorted(begin, start, side="right") - 1


#: Distinct words of a task that are added up before they go out.
MOST_WORDS = 1_000_000


def _added(hashes: list[np.ndarray], kinds: list[np.ndarray], counts: list[np.ndarray]):
    h, first, back = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    return h, np.concatenate(kinds)[first], np.bincount(back, weights=np.concatenate(counts), minlength=len(h)).astype(np.int64)


def counts_of(df: DataFrame, text: str) -> DataFrame:
    """h, kind, c: how often each word occurs.  Tasks add up before the shuffle."""
    ship(df.sparkSession)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for _, texts in slices(batch.column(0), SLICE):
                h, kind, _ = tokens(texts)
                held.append(_added([h], [kind], [np.ones(len(h))]))
                size += len(held[-1][0])
                if size > 2 * MOST_WORDS:
                    held = [_added(*zip(*held))]
                    size = len(held[0][0])
                    if size > MOST_WORDS:
                        yield out(*held[0])
                        held, size = [], 0
        if held:
            yield out(*_added(*zip(*held)))

    def out(h, kind, c):
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(kind.astype(np.int32)), pa.array(c)], names=["h", "kind", "c"])

    parts = df.select(F.col(text).alias("t")).mapInArrow(run, "h long, kind int, c long")
    return parts.groupBy("h").agg(F.min("kind").alias("kind"), F.sum("c").alias("c"))


class Corpus:
    """What every task is told about the corpus; its size is bounded by ``TOP``."""

    def __init__(self, top: pd.DataFrame, n: int, v: int, documents: int, rare: dict[int, float]):
        top = top.sort_values(["c", "h"], ascending=[False, True])
        self.n, self.v, self.documents = n, v, documents
        own = top.iloc[: OWN - 1]
        by = np.argsort(top["h"].to_numpy(np.int64), kind="stable")
        self.top_hash = top["h"].to_numpy(np.int64)[by]
        self.top_count = top["c"].to_numpy(np.int64)[by]
        place = np.full(len(top), -1, np.int32)
        place[: len(own)] = np.arange(1, len(own) + 1)
        self.top_own = place[by]
        self.own_count = np.concatenate([[documents], own["c"].to_numpy(np.int64), np.zeros(OWN - 1 - len(own), np.int64)])
        mass = np.array([rare.get(k, 0.0) for k in range(RARE)]) + 0.5
        for k, c in zip(own["kind"].tolist(), own["c"].tolist()):
            mass[k] -= c + 0.5
        self.rare_mass = np.maximum(mass, 0.5)

    def look(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts (0 where not told) and own ids (-1 where none) of word hashes."""
        if not len(self.top_hash):
            return np.zeros(len(h), np.int64), np.full(len(h), -1, np.int32)
        at = np.minimum(np.searchsorted(self.top_hash, h), len(self.top_hash) - 1)
        hit = self.top_hash[at] == h
        return np.where(hit, self.top_count[at], 0), np.where(hit, self.top_own[at], -1)


def corpus_of(counts: DataFrame, documents: int) -> Corpus:
    total = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    # the lowest count that keeps the told words within TOP, from a histogram of counts
    level = F.floor(8 * F.log2("c")).cast("int")
    steps = sorted(((r["level"], r["n"]) for r in counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    told, lowest = 0, None
    for at, n in steps:
        if told + n > TOP:
            break
        told, lowest = told + n, at
    top = counts.where(level >= lowest).toPandas() if lowest is not None else pd.DataFrame({"h": [], "kind": [], "c": []}).astype("int64")
    rare = {r["kind"]: r["m"] for r in counts.groupBy("kind").agg((F.sum("c") + 0.5 * F.count(F.lit(1))).alias("m")).collect()}
    n, v = int(total["n"] or 0), int(total["v"] or 0)
    return Corpus(top, n + documents, v + (documents > 0), documents, rare)


_CODED = [
    T.StructField("n", T.LongType()), T.StructField("n_told", T.LongType()),
    T.StructField("own_log", T.DoubleType()), T.StructField("rest_log", T.DoubleType()),
    T.StructField("ids", T.ArrayType(T.ShortType())), T.StructField("rare", T.ArrayType(T.LongType())),
]


def coded(df: DataFrame, corpus, text: str, passed: tuple[str, ...]) -> DataFrame:
    """Per document: words, words with told counts, their summed log10(count + 0.5) (own
    vocabulary and rest), the network's ids, and hashes of words without told counts."""
    def of(texts):
        c = corpus.value
        h, kind, doc = tokens(texts)
        distinct, at = np.unique(h, return_inverse=True)
        count, own = c.look(distinct)
        log, of_own, told = np.log10(count + 0.5), own >= 0, count > 0
        ids = np.where(of_own[at], own[at], OWN + kind).astype(np.int16)
        n = np.bincount(doc, minlength=len(texts))
        add = lambda w: np.bincount(doc, weights=w, minlength=len(texts)).astype(float)
        far = ~told[at]
        offsets = lambda k: pa.array(np.concatenate([[0], np.cumsum(k)]), pa.int32())
        return (
            pa.array(n.astype(np.int64)), pa.array(add(told[at]).astype(np.int64)),
            pa.array(add((log * of_own)[at])), pa.array(add((log * (told & ~of_own))[at])),
            pa.ListArray.from_arrays(offsets(n), pa.array(ids, pa.int16())),
            pa.ListArray.from_arrays(offsets(np.bincount(doc[far], minlength=len(texts))), pa.array(h[far], pa.int64())),
        )

    return map_texts(df, text, passed, _CODED, of, SLICE)


def _sigmoid(x):
    """Logistic function, in place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _softmax(x):
    """Exponentials, in place, and their row sums; logits here are small (states lie in
    -1 to 1), so that no shift is needed short of a diverged net."""
    np.minimum(x, 80, out=x)
    np.exp(x, out=x)
    return x, x.sum(1)


class Net:
    """Parameters of the network; ``names`` lists the arrays."""

    names = ("gates", "u", "wc", "bc", "wo", "bo")

    def __init__(self, corpus: Corpus, seed: int = 5):
        rng = np.random.default_rng(seed)
        f = lambda *shape, scale: (rng.normal(size=shape) * scale).astype(np.float32)
        self.gates = f(BOS + 1, 3 * STATE, scale=0.1)
        self.u = f(STATE, 3 * STATE, scale=0.2)
        self.wc, self.wo = f(STATE, CLASSES, scale=0.1), f(BANDS, STATE, BAND, scale=0.1)
        own = corpus.own_count.reshape(BANDS, BAND) + 0.5
        mass = np.concatenate([own.sum(1), corpus.rare_mass])
        self.bc = np.log(mass / mass.sum()).astype(np.float32)
        self.bo = np.log(own / own.sum(1, keepdims=True)).astype(np.float32)

    def arrays(self):
        return [getattr(self, k) for k in self.names]

    def step(self, h, before):
        """One gated step: new state and what the backward pass needs."""
        g, hu = self.gates[before], h @ self.u
        zr = _sigmoid(g[:, : 2 * STATE] + hu[:, : 2 * STATE])
        z, r = zr[:, :STATE], zr[:, STATE:]
        n = r * hu[:, 2 * STATE:]
        n += g[:, 2 * STATE:]
        n *= 2
        _sigmoid(n)  # tanh(x) is 2 sigmoid(2 x) - 1
        n *= 2
        n -= 1
        new = h - n
        new *= z
        new += n
        return new, (z, r, n, hu[:, 2 * STATE:])

    def log_probs(self, h, target, grad=None):
        """Natural log-probabilities of targets (of the class alone for rare words); with
        ``grad`` (a dict) also the gradients of their negative sum, and that of ``h``."""
        kind = np.where(target < OWN, target // BAND, BANDS + target - OWN)
        e = h @ self.wc
        e += self.bc
        rows = np.arange(len(h))
        out = e[rows, kind]
        e, total = _softmax(e)
        out -= np.log(total)
        if grad is not None:
            d = np.divide(e, total[:, None], out=e)
            d[rows, kind] -= 1
            grad["wc"] += h.T @ d
            grad["bc"] += d.sum(0)
            dh = d @ self.wc.T
        by = np.argsort(kind, kind="stable")
        edges = np.searchsorted(kind[by], np.arange(BANDS + 1))
        for k in range(BANDS):
            at = by[edges[k]:edges[k + 1]]
            if len(at):
                own = h[at]
                e = own @ self.wo[k]
                e += self.bo[k]
                row, place = np.arange(len(at)), target[at] % BAND
                logit = e[row, place]
                e, total = _softmax(e)
                out[at] += logit - np.log(total)
                if grad is not None:
                    d = np.divide(e, total[:, None], out=e)
                    d[row, place] -= 1
                    grad["wo"][k] += own.T @ d
                    grad["bo"][k] += d.sum(0)
                    dh[at] += d @ self.wo[k].T
        return (out, dh) if grad is not None else out


def _lockstep(documents: list[np.ndarray]):
    """Documents with their end token, the longest first, as one array, starts and lengths."""
    order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
    n = np.array([len(documents[i]) + 1 for i in order], np.int64)
    flat = np.concatenate([x for i in order for x in (documents[i], np.zeros(1, np.int16))]).astype(np.int64)
    return order, flat, np.cumsum(n) - n, n


def score_documents(net: Net, documents: list[np.ndarray], rare_log: np.ndarray) -> np.ndarray:
    """log10 probability of each document by the network; rare words count with their
    class, less ``rare_log`` of it.  The state runs through the whole document."""
    out = np.zeros(len(documents))
    if not documents:
        return out
    order, flat, first, n = _lockstep(documents)
    sums = np.zeros(len(documents))
    h, before = np.zeros((len(n), STATE), np.float32), np.full(len(n), BOS)
    held_h, held_t, held_d, held = [], [], [], 0
    less = np.concatenate([np.zeros(OWN), rare_log])

    def flush():
        x, t, d = np.concatenate(held_h), np.concatenate(held_t), np.concatenate(held_d)
        sums[:] += np.bincount(d, weights=net.log_probs(x, t) / np.log(10) - less[t], minlength=len(sums))
        held_h.clear(), held_t.clear(), held_d.clear()

    alive = len(n)
    for t in range(int(n[0])):
        while n[alive - 1] <= t:
            alive -= 1
        if len(h) > alive:
            h, before = h[:alive], before[:alive]
        h, _ = net.step(h, before)
        target = flat[first[:alive] + t]
        held_h.append(h), held_t.append(target), held_d.append(np.arange(alive))
        held += alive
        if held >= 32_768:
            flush()
            held = 0
        before = target
    if held:
        flush()
    out[order] = sums
    return out


def train_documents(net: Net, documents: list[np.ndarray], seed: int = 5, rate: float = 0.01) -> int:
    """Truncated backpropagation over all documents, once; returns the tokens learned."""
    documents = [d for d in documents]
    if not documents:
        return 0
    rng = np.random.default_rng(seed)
    order = sorted(range(len(documents)), key=lambda i: -len(documents[i]))
    batches = [order[i:i + BATCH] for i in range(0, len(order), BATCH)]
    steps = sum(-(-(len(documents[b[0]]) + 1) // WINDOW) for b in batches)
    first, second, done = [np.zeros_like(a) for a in net.arrays()], [np.zeros_like(a) for a in net.arrays()], 0
    for b in rng.permutation(len(batches)):
        _, flat, start, n = _lockstep([documents[i] for i in batches[b]])
        h, before = np.zeros((len(n), STATE), np.float32), np.full(len(n), BOS)
        for t0 in range(0, int(n[0]), WINDOW):
            alive = int((n > t0).sum())
            h, before = h[:alive], before[:alive]
            trace = []
            for t in range(t0, min(t0 + WINDOW, int(n[0]))):
                live = int((n[:alive] > t).sum())
                h, before = h[:live], before[:live]
                new, parts = net.step(h, before)
                target = flat[start[:live] + t]
                trace.append((h, before, new, target, parts))
                h, before = new, target
            grad = {k: np.zeros_like(a) for k, a in zip(net.names, net.arrays())}
            _, dh_all = net.log_probs(np.concatenate([x[2] for x in trace]), np.concatenate([x[3] for x in trace]), grad)
            at, dh = len(dh_all), np.zeros((0, STATE), np.float32)
            gates_at, gates_d, back = [], [], np.ascontiguousarray(net.u.T)
            for h0, prior, new, _, (z, r, c, hn) in reversed(trace):
                own = dh_all[at - len(new):at].copy()
                at -= len(new)
                own[: len(dh)] += dh
                kept = own * z
                dc = (own - kept) * (1 - c * c)
                d = np.empty((len(own), 3 * STATE), np.float32)
                d[:, :STATE] = (h0 - c) * kept * (1 - z)
                d[:, STATE: 2 * STATE] = dc * hn * r * (1 - r)
                d[:, 2 * STATE:] = dc
                gates_at.append(prior)
                gates_d.append(d)
                dhu = d.copy()
                dhu[:, 2 * STATE:] *= r
                grad["u"] += h0.T @ dhu
                kept += dhu @ back
                dh = kept
            where, d = np.concatenate(gates_at), np.concatenate(gates_d)
            by = np.argsort(where, kind="stable")
            heads = np.flatnonzero(np.r_[True, np.diff(where[by]) > 0])
            grad["gates"][where[by][heads]] = np.add.reduceat(d[by], heads, axis=0)
            done += 1
            tokens = max(1, len(dh_all))
            speed = rate * (1 - 0.9 * done / steps)
            for a, g, m, s in zip(net.arrays(), (grad[k] for k in net.names), first, second):
                g *= np.float32(1 / tokens)
                m *= np.float32(0.9)
                m += np.float32(0.1) * g
                g *= g
                s *= np.float32(0.99)
                s += np.float32(0.01) * g
                np.sqrt(s, out=g)
                g *= np.float32((1 - 0.99 ** done) ** -0.5)
                g += np.float32(1e-6)
                np.divide(m, g, out=g)
                g *= np.float32(speed / (1 - 0.9 ** done))
                a -= g
    return int(sum(len(d) + 1 for d in documents))


def _groups(batches, column: str = "ids"):
    """Batches' rows in groups of up to HELD tokens: lists of (frame, documents)."""
    frames, documents, size = [], [], 0
    for frame in batches:
        frames.append(frame.drop(columns=[column]))
        own = [np.asarray(x, np.int16) for x in frame[column]]
        documents += own
        size += sum(map(len, own))
        if size >= HELD:
            yield pd.concat(frames), documents
            frames, documents, size = [], [], 0
    if frames:
        yield pd.concat(frames), documents


def _average(rows: pd.DataFrame) -> bytes:
    weight = rows["tokens"].to_numpy(float)
    nets = [pickle.loads(x) for x in rows["net"]]
    out = nets[0]
    for k in Net.names:
        setattr(out, k, sum(w * getattr(x, k).astype(np.float64) for w, x in zip(weight, nets)).astype(np.float64) / max(weight.sum(), 1e-9))
        setattr(out, k, getattr(out, k).astype(np.float32))
    return pickle.dumps(out)


def learn(table: DataFrame, corpus: Corpus, documents: int) -> Net:
    """A network from the rows of ``table`` (ids, and h: a hash of key and content), all of them.
    Rows are dealt into parts by h and come in its order, and the parts' number follows from
    the tokens alone, so that the files and partitions they come from don't matter."""
    spark, start = table.sparkSession, Net(corpus)
    if not documents:
        return start

    def warm(batches):
        net = pickle.loads(pickle.dumps(start))
        for _, docs in _groups(batches):
            train_documents(net, docs)
        yield pd.DataFrame({"net": [pickle.dumps(net)]})

    few = table.where(drawn(F.col("h"), START / documents)).dropDuplicates(["h"])
    common = spark.sparkContext.broadcast(pickle.loads(few.repartition(1).sortWithinPartitions("h").select("ids").mapInPandas(warm, "net binary").first()["net"]))

    def train(batches):
        net, tokens, part = pickle.loads(pickle.dumps(common.value)), 0, 0
        for frame, docs in _groups(batches):
            tokens, part = tokens + train_documents(net, docs, rate=0.005), int(frame["part"].iloc[0])
        if tokens:
            yield pd.DataFrame({"part": [part], "tokens": [tokens], "net": [pickle.dumps(net)]})

    kind = "part long, tokens long, net binary"
    parts = max(1, -(-corpus.n // PART_TOKENS))
    dealt = table.select("h", "ids", F.pmod(F.shiftright("h", 7), F.lit(parts)).cast("int").alias("part"))
    dealt = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("h")
    nets = keep(dealt.select("part", "ids").mapInPandas(train, kind), "lm-nets")
    most = nets.agg(F.max("part")).first()[0] or 0
    while True:
        nets = nets.withColumn("part", F.expr("part div 64")).groupBy("part").applyInPandas(
            lambda g: pd.DataFrame({"part": [g["part"].iloc[0]], "tokens": [int(g["tokens"].sum())], "net": [_average(g.sort_values(["tokens", "net"]))]}), kind
        )
        if most < 64:
            return pickle.loads(nets.first()["net"])
        most //= 64


def scores(df: DataFrame, learned: Column, text: str = "text", passed: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``passed`` columns, learned, n_tokens, n_known, train_tokens, base_score, score."""
    ship(df.sparkSession)
    sc = df.sparkSession.sparkContext
    names = [f"p{k}" for k in range(len(passed))]
    rows = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(passed, names)], learned.alias("learned"), F.col(f"`{text}`").alias("t"))
    documents = rows.where("learned").count()
    counts = keep(counts_of(rows.where("learned"), "t"), "lm-counts")
    corpus = corpus_of(counts, documents)
    told = sc.broadcast(corpus)
    table = coded(rows, told, "t", (*names, "learned"))
    table = keep(table.withColumn("row", F.monotonically_increasing_id()), "lm-coded")
    net = sc.broadcast(learn(table.where("learned").select("ids", F.xxhash64("ids", *names).alias("h")), corpus, documents))

    # words beyond the told ones meet their counts
    far = table.select("row", F.explode("rare").alias("h")).groupBy("row", "h").agg(F.count(F.lit(1)).alias("k"))
    far = far.join(counts.select("h", "c"), "h", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    far = far.groupBy("row").agg(F.sum(F.col("k") * F.log10(F.col("c") + 0.5)).alias("far_log"), F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("far_known"))

    def run(batches):
        c = told.value
        for frame, docs in _groups(batches):
            frame["net"] = score_documents(net.value, docs, np.log10(c.rare_mass))
            yield frame[["row", "net"]]

    by_net = table.select("row", "ids").mapInPandas(run, "row long, net double")
    end = F.lit(float(np.log10(documents + 0.5)))
    even = F.lit(float(np.log10(corpus.n + 0.5 * (corpus.v + 1))))
    slim = table.drop("ids", "rare").join(by_net, "row").join(far, "row", "left").na.fill({"far_log": 0.0, "far_known": 0})
    return slim.select(
        *[F.col(n).alias(c) for n, c in zip(names, passed)], "learned",
        (F.col("n") + 1).alias("n_tokens"),
        (F.col("n_told") + F.col("far_known") + F.lit(int(documents > 0))).cast("long").alias("n_known"),
        F.lit(corpus.n).cast("long").alias("train_tokens"),
        (F.col("own_log") + F.col("rest_log") + F.col("far_log") + end - (F.col("n") + 1) * even).alias("base_score"),
        (F.col("net") + F.col("rest_log") + F.col("far_log")).alias("score"),
    )
