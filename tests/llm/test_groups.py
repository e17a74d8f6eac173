"""Near duplicates, components, mixing and neighbours against brute force."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from promolift.llm import components, mixing, neardup, neighbours, queries

from .conftest import SF, SF_MORE, WORD


def plain_set(text, width):
    w = (text or "").encode().lower().split()
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


def plain_components(sets, percent):
    """Smallest linked id of every id, by all pairs that share a shingle."""
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        seen = defaultdict(int)
        for x in sets[i]:
            for j in holders[x]:
                seen[j] += 1
            holders[x].append(i)
        for j, both in seen.items():
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return {i: top(i) for i in sets}


def check_links(df, rows, width, percent):
    sets = {r["doc_id"]: plain_set(r["text"], width) for r in df.collect() if r["doc_id"] is not None}
    want = plain_components(sets, percent)
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]])
            assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_op4_on_documents(spark, documents):
    rows = queries.op4_near_duplicates(spark, SF).collect()
    assert len(rows) == documents.count()
    check_links(documents, rows, 3, 85)


def test_near_duplicates_of_odd_texts(odd_documents, no_documents):
    rows = neardup.link(odd_documents, width=3, percent=85).collect()
    assert len(rows) == odd_documents.count()
    check_links(odd_documents, rows, 3, 85)
    assert neardup.link(no_documents).count() == 0


@pytest.fixture(scope="module")
def families(spark):
    """Families of near copies with few to many changed words: chains, stars, outliers."""
    rng, rows = np.random.default_rng(4), []
    for f in range(4):
        base = [f"f{f}w{k}" for k in range(60)]
        for _ in range((60, 25, 8, 2)[f]):
            own = list(base)
            for k in rng.choice(60, rng.integers(0, 5), replace=False):
                own[k] = f"x{rng.integers(1e9)}"
            rows.append((len(rows), " ".join(own)))
    chain = [f"c{k}" for k in range(50)]
    for k in range(12):  # each like the next, the ends unlike
        rows.append((len(rows), " ".join(chain)))
        chain[4 * k % 50] = f"y{k}"
    rows += [(len(rows) + k, "common line that many share " + " ".join(f"u{k}v{j}" for j in range(30))) for k in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("width, percent", [(3, 85), (5, 80)])
def test_families_lose_no_link(families, width, percent):
    check_links(families, neardup.link(families, width=width, percent=percent).collect(), width, percent)


def test_small_blocks_lose_no_link(families, monkeypatch):
    """Several blocks a bucket and no help from the star rounds."""
    monkeypatch.setattr(neardup, "BLOCK", 7)
    monkeypatch.setattr(neardup, "SHARED", 10**6)
    check_links(families, neardup.link(families, width=3, percent=85).collect(), 3, 85)


def test_sketch_agreement_concentrates():
    rng = np.random.default_rng(0)
    for n, similarity in ((20, 0.8), (200, 0.85), (2000, 0.5)):
        got = []
        for _ in range(60):
            both = int(round(n * 2 * similarity / (1 + similarity)))
            x = rng.integers(0, 2**63, 2 * n - both).astype(np.uint64)
            a, b = neardup.sketch([x[:n], x[n - both:]])
            assert (a < 2**64 - 1).all() and (b < 2**64 - 1).all()
            got.append((a == b).mean())
        exact = both / (2 * n - both)
        assert abs(np.mean(got) - exact) < 0.03 and np.std(got) < 1.3 * (exact * (1 - exact) / neardup.SLOTS) ** 0.5


def test_drop_duplicates_keeps_columns(families, odd_documents):
    want = {r["doc_id"] for r in neardup.link(families).where("kept").collect()}
    out = neardup.drop_duplicates(families)
    assert out.columns == families.columns and {r["doc_id"] for r in out.collect()} == want
    assert neardup.drop_duplicates(odd_documents).columns == odd_documents.columns


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(1000 + k, 1001 + k) for k in range(60)] + [(5, 5)]
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        p, q = top(a), top(b)
        root[max(p, q)] = min(p, q)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["id"]: r["comp"] for r in components.components(df).collect()}
    assert all(got.get(x, x) == top(x) for x in root) and set(got) <= set(root)
    assert components.components(df.where("false")).count() == 0


# --- mixing ----------------------------------------------------------------------------


def plain_targets(sizes):
    """Water filling by repetition; sources in code-point order, null last."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    total, free = sum(sizes.values()), set(names)
    while True:
        rest = total - sum(3 * sizes[s] for s in names if s not in free)
        unit = rest / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if unit * weight[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return {s: unit * weight[s] if s in free else 3 * sizes[s] for s in names}
        free -= over


def check_mix(df, slack):
    rows = mixing.mix(df, passed=("doc_id", "source", "text")).collect()
    assert len(rows) == df.count()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        n = len(WORD.findall(r["row"]["text"] or ""))
        assert r["size"] == n and 0 <= r["copies"] <= 3
        sizes[r["row"]["source"]] += n
        taken[r["row"]["source"]] += n * r["copies"]
    want = plain_targets(sizes)
    for r in rows:
        s = r["row"]["source"]
        assert r["source_size"] == sizes[s] and abs(r["target"] - want[s]) < 1e-6 * max(1, want[s])
    far = {s: (taken[s], want[s]) for s in sizes if abs(taken[s] - want[s]) > slack}
    assert not far


def test_mix_documents(documents, more_documents):
    check_mix(documents, 400)  # ten documents a source: their lengths hardly add up to a target
    check_mix(more_documents, 1)


def test_mix_of_odd_rows(odd_documents, no_documents):
    check_mix(odd_documents, 50_000)
    assert mixing.mix(no_documents).count() == 0
    assert mixing.mixed_documents(odd_documents).columns == odd_documents.columns


def test_mix_capped_sources(spark):
    text = lambda n: " ".join(["w"] * n)
    rows = [(i, text(1 + i % 7), "big") for i in range(900)] + [(1000 + i, text(2), f"s{i % 5}") for i in range(10)] + [(2000 + i, text(3), None) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check_mix(df, 2)
    again = lambda: sorted((r["row"]["doc_id"], r["copies"]) for r in mixing.mix(df, passed=("doc_id",)).collect())
    assert again() == again()


def test_few_buckets_take_as_many(spark):
    rows = [(i, "a b c", "s0" if i % 3 else "s1") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = {r["src"]: r["n"] for r in mixing.mix(df, passed=("source",), buckets=3).groupBy(F.col("row.source").alias("src")).agg(F.sum(F.col("size") * F.col("copies")).alias("n")).collect()}
    assert taken == {"s0": 3000, "s1": 6000}


def test_knapsack_is_best():
    rng = np.random.default_rng(3)
    for _ in range(150):
        lengths = rng.choice(np.arange(0, 15), rng.integers(1, 6), replace=False)
        counts = rng.integers(0, 4, len(lengths))
        budget = int(rng.integers(0, 40))
        sums = {0}
        for size, n in zip(lengths.tolist(), counts.tolist()):
            sums = {s + size * k for s in sums for k in range(n + 1)}
        got = mixing.knapsack(lengths, counts, budget)
        assert (got <= counts).all() and (got * lengths).sum() == min(sums, key=lambda s: (abs(s - budget), s))
    lengths = np.arange(1, 400)
    counts = rng.integers(0, 9, len(lengths)) * 50
    for budget in (0, 1, 77_777, 3_000_001, 10**9):
        got = mixing.fit(lengths, counts, budget)
        assert (got <= counts).all() and (got * lengths).sum() == min(budget, (lengths * counts).sum())


# --- neighbours ------------------------------------------------------------------------


def plain_neighbours(vectors, query, k=10):
    near = sorted((float(np.sqrt(((np.array(v) - np.array(vectors[query])) ** 2).sum())), i) for i, v in vectors.items() if i != query)
    return near[:k]


def test_op10_recall(spark):
    vectors = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{SF_MORE}/embeddings.parquet").collect()}
    rows, hits = queries.op10_nearest_vectors(spark, SF_MORE).collect(), 0
    asked = [i for i in vectors if i % 100 == 0]
    for q in asked:
        want = plain_neighbours(vectors, q)
        own = sorted([r for r in rows if r["query_id"] == q], key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert [(r["score"], r["vec_id"]) for r in own] == sorted((r["score"], r["vec_id"]) for r in own)
        exact = dict((i, d) for d, i in plain_neighbours(vectors, q, len(vectors)))
        assert all(abs(r["score"] - exact[r["vec_id"]]) < 1e-12 for r in own)
        hits += len({r["vec_id"] for r in own} & {i for _, i in want})
    assert hits >= 0.9 * 10 * len(asked)


def test_index_meets_every_code_within_its_radius():
    rng = np.random.default_rng(0)
    centres = rng.integers(0, 256, (20, 32))
    codes = (centres[rng.integers(0, 20, 3000)] ^ (1 << rng.integers(0, 8, (3000, 32)) * (rng.random((3000, 32)) < 0.3))).astype(np.uint8)
    index = neighbours.Index(codes)
    for i in range(0, 3000, 400):
        distance = np.bitwise_count(codes ^ codes[i]).sum(1)
        got = index.near(codes[i], 50)
        limit = np.sort(distance)[49]
        assert set(got) == set(np.flatnonzero(distance <= limit))
    assert len(index.near(codes[0], 10**6)) == 3000


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [1.0, 1.0]), (7, [1.0, -1.0]),
            (8, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [1.0, 2.0, 3.0]), (100, [5.0, 5.0]), (200, None), (None, [1.0, 1.0]), (10, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("clash"))
    got = [tuple(r) for r in neighbours.search(df, F.col("vec_id") % 100 == 0, k=3).orderBy("query_id", "rank").collect()]
    assert [g[:3] for g in got] == [(0, 1, 8), (0, 2, 6), (0, 3, 7), (100, 1, 6), (100, 2, 0), (100, 3, 8)]
    assert got[0][3] == 0.0 and got[1][3] == 1.0
    assert neighbours.search(df.where("false"), F.col("vec_id") % 100 == 0).count() == 0
