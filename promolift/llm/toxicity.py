"""Toxicity by a convolutional text classifier, trained in numpy.

A word's embedding is the sum of hashed rows for the word, its beginnings and its
endings, so that inflected and compounded forms share what they have in common.  Filters
of widths 1 to 3 slide over the words; each keeps its largest response over the whole
text, and a logistic layer turns these into a log-odds.  Thresholds are calibrated per
language on rows set apart from the training ones; the language is read off the text by
its frequent short words.  The score is the logistic function of the log-odds minus the
language's threshold, so that 0.5 is the decision everywhere.

All labelled rows are learned from.  A seeded sample (``SAMPLE`` rows of each class at most,
but for chance) gives a common start in one task; then every part, dealt by a hash of the
id, trains on all its rows that aren't set apart, and the parts' changes are averaged in a
tree, each row of the hash table by how often a part met it.  Thresholds are calibrated on
all rows set apart, counted by language and by steps of 1 / ``CELLS`` of the log-odds.
Parts follow from ids and sizes alone, so that files and partitions don't matter.  Every
text is scored whole, in one narrow pass.

Defined cases: a null or empty text has no words and gets the score of responses 0;
texts of any length are scored whole; equal texts get equal scores; with no labels of
both classes every score is 0.5 of the class that there is (0.0 or 1.0 aside, 0.25 if
there are none); rows without a label, or with labels that disagree, count as the larger
label; extra columns are passed on only if named; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drawn, keep, map_texts, ship

#: Rows of each class in the common start; rows of the hash table; sizes of embedding and filter sets.
SAMPLE, ROWS, DIM, FILTERS, WIDTHS = 3000, 1 << 15, 12, 12, (1, 2, 3)
#: Passes over the start's sample, more where it is small, up to so many steps.
EPOCHS, STEPS, BATCH, RATE = 8, 900, 32, 0.1
#: Characters of a part's training texts, about; characters whose words a task holds at once.
PART_CHARS, HELD = 32_000_000, 8_000_000
#: Steps of a unit of log-odds in which thresholds are counted; the log-odds' bound there.
CELLS, MOST_ODDS = 256, 40
PARTS = 8
_WORD = re.compile(r"[^\W\d_]+")
#: Frequent short words that tell the languages apart.
LANGUAGES = {
    "en": set("the of and to in is that for it with as was on be by this are or at from an".split()),
    "de": set("der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch".split()),
    "fr": set("le les des et un une du dans que qui est pour sur par au pas plus avec sont il".split()),
    "es": set("el los las que un una del por con para su es se al lo como más pero sus".split()),
}


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def language(words: list[str]) -> str:
    best, name = 0, "other"
    for k, own in LANGUAGES.items():
        n = sum(map(own.__contains__, words))
        if n > best:
            best, name = n, k
    return name


def parts(word: str) -> list[int]:
    """Table rows of a word, its beginnings of 2 to 5 and its endings of 3 and 4 letters."""
    names = [f"={word}", *[f"^{word[:k]}" for k in (2, 3, 4, 5)], *[f"{word[-k:]}$" for k in (3, 4)], f"~{word[:6]}"]
    return [xxhash.xxh32_intdigest(x.encode()) % ROWS for x in names]


class Vocabulary:
    """Words met by a worker, numbered, with their table rows."""

    def __init__(self, most: int = 400_000):
        self.most = most
        self.reset()

    def reset(self):
        self.known: dict[str, int] = {}
        self.rows = np.zeros((0, PARTS), np.int32)

    def number(self, words: list[str]) -> np.ndarray:
        fresh = list(set(words).difference(self.known))
        if fresh:
            if len(self.known) + len(fresh) > self.most:
                self.reset()
                fresh = list(set(words))
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
            self.rows = np.concatenate([self.rows, np.array([parts(w) for w in fresh], np.int32).reshape(-1, PARTS)])
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))


class Net:
    """Parameters, the forward pass and one step of training."""

    def __init__(self, seed: int = 9):
        rng = np.random.default_rng(seed)
        self.table = (rng.normal(size=(ROWS, DIM)) * 0.1).astype(np.float32)
        self.filters = [(rng.normal(size=(w, DIM, FILTERS)) * (0.5 / w)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = (rng.random(FILTERS * len(WIDTHS)) * 0.3 + 0.1).astype(np.float32)
        self.shift = np.float32(-1.0)
        self.thresholds: dict[str, float] = {}
        self.constant: float | None = None

    def respond(self, rows: np.ndarray, at: np.ndarray, n: np.ndarray, where: bool = False):
        """Largest response of every filter in each text, and its place if asked for.

        ``rows``: table rows of the distinct words; ``at``: word of each place, texts end
        to end; ``n``: words of each text, all at least 1."""
        embedded = self.table[rows].sum(1)
        first = np.cumsum(n) - n
        last = np.repeat(first + n, n)
        best, places = [], []
        for w, f, b in zip(WIDTHS, self.filters, self.bias):
            r = (embedded @ f[0])[at] + b
            for k in range(1, w):
                inside = np.flatnonzero(np.arange(k, len(at) + k) < last)
                r[inside] += (embedded @ f[k])[at[inside + k]]
            top = np.maximum.reduceat(r, first, axis=0)
            best.append(top)
            if where:
                place = np.empty(top.shape, np.int64)
                for i, (a, m) in enumerate(zip(first.tolist(), n.tolist())):
                    place[i] = a + r[a:a + m].argmax(0)
                places.append(place)
        return np.concatenate(best, axis=1), places, embedded, last

    def odds(self, responses: np.ndarray) -> np.ndarray:
        return np.maximum(responses, 0) @ self.out + self.shift

    def odds_of(self, lists: list[list[str]], vocabulary: Vocabulary) -> np.ndarray:
        """Log-odds of texts given as their words."""
        n = np.array([len(x) for x in lists], np.int64)
        flat = [w for x in lists for w in x]
        responses = np.zeros((len(lists), FILTERS * len(WIDTHS)), np.float32)
        if flat:
            numbers = vocabulary.number(flat)
            used, at = np.unique(numbers, return_inverse=True)
            responses[n > 0] = self.respond(vocabulary.rows[used], at, n[n > 0])[0]
        return self.odds(responses).astype(np.float64)

    def score_texts(self, texts, vocabulary: Vocabulary) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        lists = [words_of(t) for t in texts]
        odds = self.odds_of(lists, vocabulary)
        limit = np.array([self.thresholds.get(language(x), self.thresholds.get("other", 0.0)) for x in lists])
        return 1 / (1 + np.exp(-np.clip(odds - limit, -40, 40)))


def _squares(net: Net) -> list[np.ndarray]:
    """Sums of squared gradients, at their start, in the order of the parameters."""
    like = [net.table, *net.filters, *net.bias, net.out, np.zeros(1, np.float32)]
    return [np.full_like(x, 1e-3) for x in like]


def descend(net: Net, squares: list[np.ndarray], numbers: list[np.ndarray], vocabulary: Vocabulary, labels: np.ndarray, fit: np.ndarray, rng, passes: int) -> np.ndarray:
    """``passes`` over the texts ``fit``, all with words; how often each table row was met."""
    met = np.zeros(ROWS, np.int64)

    def step(value, grad, k, at=slice(None)):
        squares[k][at] += grad * grad
        value[at] -= RATE * grad / np.sqrt(squares[k][at])

    for _ in range(passes):
        for batch in np.array_split(rng.permutation(fit), max(1, len(fit) // BATCH)):
            if not len(batch):
                continue
            flat = np.concatenate([numbers[i] for i in batch])
            n = np.array([len(numbers[i]) for i in batch])
            used, at = np.unique(flat, return_inverse=True)
            rows = vocabulary.rows[used]
            responses, places, embedded, last = net.respond(rows, at, n, where=True)
            live = np.maximum(responses, 0)
            p = 1 / (1 + np.exp(-np.clip(live @ net.out + net.shift, -30, 30)))
            slope = ((p - labels[batch]) / len(batch)).astype(np.float32)
            back = slope[:, None] * net.out[None, :] * (responses > 0)
            words_back = np.zeros((len(used), DIM), np.float32)
            for j, w in enumerate(WIDTHS):
                g, place = back[:, j * FILTERS:(j + 1) * FILTERS], places[j]
                grad = np.zeros_like(net.filters[j])
                for k in range(w):
                    inside = (place + k) < last[np.minimum(place, len(last) - 1)]
                    spot = at[np.minimum(place + k, len(at) - 1)]
                    own = g * inside
                    grad[k] = np.einsum("bf,bfd->df", own, embedded[spot])
                    np.add.at(words_back, spot.reshape(-1), (own[:, :, None] * net.filters[j][k].T[None]).reshape(-1, DIM))
                step(net.filters[j], grad, 1 + j)
                step(net.bias[j], g.sum(0), 1 + len(WIDTHS) + j)
            step(net.out, live.T @ slope, 1 + 2 * len(WIDTHS))
            shift = np.array([net.shift])
            step(shift, np.array([slope.sum()]), 2 + 2 * len(WIDTHS))
            net.shift = np.float32(shift[0])
            touched = np.flatnonzero(np.abs(words_back).sum(1))
            if len(touched):
                place, back_rows = np.unique(rows[touched], return_inverse=True)
                grad = np.zeros((len(place), DIM), np.float32)
                np.add.at(grad, back_rows.reshape(-1), np.repeat(words_back[touched], PARTS, axis=0))
                step(net.table, grad, 0, place)
                met[place] += 1
    return met


def begin(texts: list[str], labels: np.ndarray, seed: int = 9) -> tuple[Net, list[np.ndarray]]:
    """A net fitted on the texts in many passes, and its squared gradients."""
    net, rng, vocabulary = Net(seed), np.random.default_rng(seed), Vocabulary(10**9)
    squares = _squares(net)
    numbers = [vocabulary.number(words_of(t)) for t in texts]
    fit = np.flatnonzero([len(x) > 0 for x in numbers])
    descend(net, squares, numbers, vocabulary, labels, fit, rng, max(EPOCHS, min(60, STEPS * BATCH // max(1, len(fit)))))
    return net, squares


def _constant(label: int | None) -> Net:
    net = Net()
    net.constant = 0.25 if label is None else float(label) * 0.5 + 0.25
    return net


def train(texts: list[str], labels: np.ndarray, apart: np.ndarray, seed: int = 9) -> Net:
    """A net fitted here on the rows that aren't ``apart``, with thresholds from those that are."""
    if len(set(labels.tolist())) < 2:
        return _constant(labels[0] if len(labels) else None)
    net, _ = begin([t for t, x in zip(texts, apart) if not x], labels[~apart], seed)
    tongue, cell = cells(net, [t for t, x in zip(texts, apart) if x], Vocabulary())
    counted = pd.DataFrame({"tongue": tongue, "cell": cell, "toxic": labels[apart] == 1, "clean": labels[apart] == 0})
    net.thresholds = calibrate(counted.groupby(["tongue", "cell"], as_index=False).sum())
    return net


def cells(net: Net, texts, vocabulary: Vocabulary) -> tuple[list[str], np.ndarray]:
    """Language and step of the log-odds of each text."""
    lists = [words_of(t) for t in texts]
    odds = np.clip(net.odds_of(lists, vocabulary), -MOST_ODDS, MOST_ODDS)
    return [language(x) for x in lists], np.floor(odds * CELLS).astype(np.int32)


def calibrate(counted: pd.DataFrame) -> dict[str, float]:
    """Per language, the log-odds that split the rows with fewest errors.  ``counted``: toxic and
    clean rows by tongue and cell."""
    out = {"other": _split(counted.groupby("cell")[["toxic", "clean"]].sum())}
    for k in LANGUAGES:
        own = counted[counted["tongue"] == k].groupby("cell")[["toxic", "clean"]].sum()
        if min(own["toxic"].sum(), own["clean"].sum()) >= 20:
            out[k] = _split(own)
    return out


def _split(counted: pd.DataFrame) -> float:
    """The middle of the widest gap among the splits with the fewest errors."""
    cell, toxic, clean = counted.index.to_numpy(np.int64), counted["toxic"].to_numpy(np.int64), counted["clean"].to_numpy(np.int64)
    if not toxic.sum() or not clean.sum():
        return 0.0
    # errors when everything from the i-th cell on is called toxic
    cost = np.concatenate([[0], np.cumsum(toxic)]) + clean.sum() - np.concatenate([[0], np.cumsum(clean)])
    best = np.flatnonzero(cost == cost.min())
    best = best[(best > 0) & (best < len(cell))]
    if not len(best):
        return 0.0
    i = int(best[(cell[best] - cell[best - 1]).argmax()])
    return float((cell[i - 1] + 1 + cell[i]) / 2 / CELLS)


def _held(frames):
    """The rows (text, toxic) of frames in lists of up to ``HELD`` characters."""
    rows, size = [], 0
    for frame in frames:
        for t, y in zip(frame["text"], frame["toxic"]):
            rows.append((t, y))
            size += len(t) if t else 0
            if size >= HELD:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def _change(net: Net, start: Net, met: np.ndarray, rows: int) -> dict:
    """What a part adds to the average: its changes, weighted, and their weights."""
    names = {"table": (net.table - start.table) * met[:, None], "out": (net.out - start.out) * rows, "shift": (net.shift - start.shift) * rows}
    for j in range(len(WIDTHS)):
        names[f"filter{j}"], names[f"bias{j}"] = (net.filters[j] - start.filters[j]) * rows, (net.bias[j] - start.bias[j]) * rows
    return {"met": met, "rows": rows} | {k: np.asarray(v, np.float32) for k, v in names.items()}


def _moved(start: Net, change: dict) -> Net:
    """``start`` moved by the average of changes."""
    net, rows = pickle.loads(pickle.dumps(start)), max(change["rows"], 1)
    net.table += (change["table"] / np.maximum(change["met"], 1)[:, None]).astype(np.float32)
    net.out += (change["out"] / rows).astype(np.float32)
    net.shift = np.float32(net.shift + change["shift"] / rows)
    for j in range(len(WIDTHS)):
        net.filters[j] += (change[f"filter{j}"] / rows).astype(np.float32)
        net.bias[j] += (change[f"bias{j}"] / rows).astype(np.float32)
    return net


def _added(group: pd.DataFrame) -> pd.DataFrame:
    """The sum of up to 64 changes, always in the same order."""
    total: dict = {}
    for x in group.sort_values("at")["change"]:
        for k, v in pickle.loads(x).items():
            total[k] = total.get(k, 0) + (v if k in ("met", "rows") else v.astype(np.float64))
    total = {k: v if k in ("met", "rows") else v.astype(np.float32) for k, v in total.items()}
    part = int(group["part"].iloc[0])
    return pd.DataFrame({"part": [part], "at": [part], "change": [pickle.dumps(total)]})


def fit(documents: DataFrame, labels: DataFrame, learned: Column, sample: int = SAMPLE, text: str = "text", doc_id: str = "doc_id") -> Net:
    """Train on all labelled rows where ``learned`` holds: a common start from a seeded sample
    of them, one pass of every part over all its rows, thresholds from all rows set apart."""
    spark = documents.sparkSession
    ship(spark)
    known = labels.where(learned & F.col("toxic").isNotNull() & F.col(doc_id).isNotNull())
    known = known.groupBy(F.col(doc_id).alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    texts = documents.where(F.col(f"`{doc_id}`").isNotNull()).groupBy(F.col(f"`{doc_id}`").alias("id")).agg(F.min(f"`{text}`").alias("text"))    # an id that many rows share is one example
    table = texts.join(known, "id").withColumn("apart", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(4)) == 0)
    table = keep(table.withColumn("h", F.xxhash64("id", F.lit(9))), "toxic-texts")
    sums = table.groupBy("toxic", "apart").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).collect()   # a row a label and side
    count: dict[int, int] = {}
    for r in sums:
        count[r["toxic"]] = count.get(r["toxic"], 0) + r["n"]
    if len(count) < 2:
        return _constant(next(iter(count), None))

    def warm(frames):
        frames = [f for f in frames if len(f)]
        df = pd.concat(frames) if frames else pd.DataFrame({"text": [], "toxic": []})
        yield pd.DataFrame({"state": [pickle.dumps(begin(df["text"].tolist(), df["toxic"].to_numpy(np.int64)))]})

    rest = table.where(~F.col("apart"))
    few = rest.where(F.when(F.col("toxic") == 1, drawn(F.col("h"), sample / max(1, count.get(1, 0)))).otherwise(drawn(F.col("h"), sample / max(1, count.get(0, 0)))))
    row = few.repartition(1).sortWithinPartitions("id").select("text", "toxic").mapInPandas(warm, "state binary").first()
    state = pickle.loads(row["state"]) if row else begin([], np.zeros(0, np.int64))
    common = spark.sparkContext.broadcast(state)

    def learn(frames):
        net, squares = pickle.loads(pickle.dumps(common.value))
        met, rows, part = np.zeros(ROWS, np.int64), 0, None
        rng = np.random.default_rng(9)

        def own():
            nonlocal part
            for frame in frames:
                if len(frame):
                    part = int(frame["part"].iloc[0])
                    yield frame

        for group in _held(own()):
            vocabulary = Vocabulary(10**9)
            numbers = [vocabulary.number(words_of(t)) for t, _ in group]
            at = np.flatnonzero([len(x) > 0 for x in numbers])
            met += descend(net, squares, numbers, vocabulary, np.array([y for _, y in group]), at, rng, 1)
            rows += len(group)
        if rows:
            yield pd.DataFrame({"part": [part], "at": [part], "change": [pickle.dumps(_change(net, common.value[0], met, rows))]})

    parts = max(1, -(-sum(r["chars"] or 0 for r in sums if not r["apart"]) // PART_CHARS))
    dealt = rest.withColumn("part", F.pmod(F.shiftright("h", 7), F.lit(parts)).cast("int"))
    dealt = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("h", "id").select("part", "text", "toxic")
    kind = "part long, at long, change binary"
    changes, most = keep(dealt.mapInPandas(learn, kind), "toxic-changes"), parts - 1
    while True:
        changes = changes.withColumn("part", F.expr("part div 64")).groupBy("part").applyInPandas(_added, kind)
        if most < 64:
            break
        most //= 64
    row = changes.first()
    net = _moved(state[0], pickle.loads(row["change"])) if row else state[0]
    net.thresholds = calibrate(_counted(table.where("apart"), net))
    return net


def _counted(table: DataFrame, net: Net) -> pd.DataFrame:
    """Toxic and clean rows by language and cell: bounded by languages and cells, on the driver."""
    shared = table.sparkSession.sparkContext.broadcast(net)
    state: dict = {}

    def of(texts):
        tongue, cell = cells(shared.value, texts, state.setdefault("words", Vocabulary()))
        return pa.array(tongue, pa.string()), pa.array(cell, pa.int32())

    fields = [T.StructField("tongue", T.StringType()), T.StructField("cell", T.IntegerType())]
    told = map_texts(table, "text", ("toxic",), fields, of).groupBy("tongue", "cell")
    rows = told.agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean")).collect()
    return pd.DataFrame([tuple(r) for r in rows], columns=["tongue", "cell", "toxic", "clean"])


def score(df: DataFrame, net: Net, text: str = "text", passed: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``passed`` columns, score (0 to 1) and predicted (1 from 0.5 on)."""
    shared = df.sparkSession.sparkContext.broadcast(net)
    state: dict = {}

    def of(texts):
        vocabulary = state.setdefault("words", Vocabulary())
        s = shared.value.score_texts(texts, vocabulary)
        return pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))

    fields = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return map_texts(df, text, passed, fields, of)
