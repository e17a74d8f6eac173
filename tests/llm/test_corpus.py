"""Conversation trie, importance resampling and token files against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from promolift.llm import binary, ordering, queries, resampling, trie

from .conftest import SF

KIND = "conv_id long, turn long, role string, text string"
HEAD = dict(base=lambda c: c - c % 5, length=lambda c: F.crc32(c.cast("string").cast("binary")) % 9, most=8)


# --- op11 -------------------------------------------------------------------------------

def plain_trie(rows):
    """rows: (conv_id, turn, role, text) without ties."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [t for _, t in sorted(v, key=lambda z: z[0])] for c, v in own.items()}
    rebuilt = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(c - c % 5, [])[:h] + v[h:])
    members, kids = defaultdict(list), defaultdict(list)
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            members[v[:d]].append(c)
    for v in members:
        if v:
            kids[v[:-1]].append(v)
    leaves, saved = {}, {}
    for v in sorted(members, key=len, reverse=True):
        leaves[v] = sum(leaves[k] for k in kids[v]) if kids[v] else 1
        saved[v] = sum(saved[k] for k in kids[v]) + ((len(members[v]) - 1) * len(v[-1][1].encode()) if v else 0)
    ends = {v: ",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(v)) for v, m in members.items()}
    return sorted((min(m), len(v), min(members[v[:-1]]) if v else -1, len(m), len(kids[v]), leaves[v], saved[v], hashlib.sha256(ends[v].encode()).hexdigest()) for v, m in members.items())


def found_trie(df):
    turns = trie.own_turns(df)
    rows = [tuple(r) for r in trie.nodes(*trie.branched(turns, **HEAD)).collect()]
    return sorted((a, b, -1 if c is None else c, *rest) for a, b, c, *rest in rows)


def test_op11_on_conversations(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = sorted((a, b, -1 if c is None else c, *rest) for a, b, c, *rest in map(tuple, queries.op11_conversation_trie(spark, SF).collect()))
    assert got == plain_trie(rows)


def test_op11_shared_prefixes_and_long_conversations(spark):
    """Few texts, so that prefixes are shared over several blocks; copies; long conversations
    that part at the end; one conversation with most rows."""
    rng, rows = random.Random(3), []
    for c in range(120):
        kind, n = rng.random(), rng.choice([1, 2, 3, 8, 9, 16, 17, 30])
        for t in range(n):
            text = "same" if kind < 0.4 else rng.choice("ab") if kind < 0.7 or t < 3 else str(rng.random())
            rows.append((c, t, "u" if t % 2 else None, text))
    for t in range(50):
        rows += [(5000, None if t == 0 else t, "u", f"Zürich {t}"), (5001, t, "u", f"Zürich {t}"), (6000, t, "u", f"Zürich {t if t < 45 else 0}")]
    rows += [(7003, t, "a", f"t{t}") for t in range(2500)] + [(None, 1, "u", "x")]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], KIND + ", parent_conv_id string, depth int").repartition(7)
    assert found_trie(df) == plain_trie(rows)


def test_op11_ties_repeats_and_nothing(spark):
    df = spark.createDataFrame([(5, 1, "u", "x"), (5, 1, "u", "x"), (5, 1, "u", "x"), (5, None, None, None)], KIND)
    h = zlib.crc32(b"5") % 9
    got = found_trie(df)
    assert [(r[1], r[3]) for r in got] == [(d, 1) for d in range(5)] and h >= 0   # repeats are turns of their own
    assert found_trie(df.limit(0)) == []
    only = spark.createDataFrame([(None, 1, "u", "x")], KIND)
    assert found_trie(only) == []


def test_op11_turnless(spark):
    """A conversation whose own turns all give way to an absent base belongs to the root alone."""
    c = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 == 8)
    rows = [(c, t, "u", "x") for t in range(3)]
    assert found_trie(spark.createDataFrame(rows, KIND)) == plain_trie(rows) == [(c, 0, -1, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_numbers_and_hot_keys(spark):
    """One key with most rows spans ranges; numbers run without gaps; the skewed join is whole."""
    df = spark.range(5000).select(F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")).repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        from promolift.llm.common import keep
        kept = keep(ordering.spread(df, [F.col("k")], 6), "test")
        assert kept.where("k = 7").select("part").distinct().count() > 2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    rows = sorted((r["number"], r["k"]) for r in ordering.numbered(kept).collect())
    assert [n for n, _ in rows] == list(range(5000)) and [k for _, k in rows] == sorted(k for _, k in rows)
    sizes = df.groupBy("k").agg(F.count("*").alias("n"))
    both = trie.with_values(df, sizes, ["k"], F.col("n"), 5000)
    assert both.count() == 5000 and both.where("k = 7 AND n = 3000").count() == 3000


# --- op12 -------------------------------------------------------------------------------

WORDS = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, longest=1, buckets=10_000):
    w = WORDS.findall((text or "").translate(LOWER))
    return w, [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def plain_draw(docs, target, longest=1, buckets=10_000, percent=10, least=20):
    s, t = [0] * buckets, [0] * buckets
    for count, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            for b in grams(x, longest, buckets)[1]:
                count[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    out, able = [], []
    for i, x in docs:
        w, f = grams(x, longest, buckets)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
        if len(w) >= least:
            able.append(out[-1])
    able.sort(key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    rank = {r[0]: k + 1 for k, r in enumerate(able[:percent * len(able) // 100])}
    return {(*r, rank.get(r[0])) for r in out}


def test_op12_on_documents(spark, documents):
    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    target = [r[0] for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect()]
    got = {tuple(r) for r in queries.op12_importance_resampling(spark, SF).collect()}
    assert got == plain_draw(docs, target) and any(r[4] for r in got)


def test_op12_longer_runs(spark):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice(["one", "Two", "thrée", "4", "--", "x.y"]) for _ in range(rng.randrange(0, 60)))) for i in range(200)]
    target = ["one two thrée", None, "", "x y 4 4 one"]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = resampling.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), longest=3, buckets=101, percent=25, least_words=9)
    assert {tuple(r) for r in found.collect()} == plain_draw(docs, target, 3, 101, 25, 9)


def test_op12_spans(spark):
    """Overlapped matches are every run of words, separators collapsed."""
    s = resampling.Scanner(2, 1 << 32)
    clean = s.text("  A--b\tcé . 9 ")
    assert clean == "a b cé 9".encode()
    assert [m.group().decode() for p in s.patterns for m in p.finditer(clean, overlapped=True)] == ["a", "b", "cé", "9", "a b", "b cé", "cé 9"]
    assert len(s.find(b"")) == 0


def test_op12_odd_documents(spark, odd_documents, no_documents):
    target = spark.createDataFrame([("the w1 one",)], "text string")
    rows = [tuple(r) for r in resampling.resample(odd_documents, target, least_words=3, percent=60).collect()]
    assert len(rows) == odd_documents.count()
    ranks = sorted(r[4] for r in rows if r[4] is not None)
    able = sum(len(WORDS.findall(r["text"] or "")) >= 3 for r in odd_documents.collect())
    assert ranks == list(range(1, 60 * able // 100 + 1))
    assert {(r[1], r[2]) for r in rows if r[0] in (0, 1, 2)} == {(0, 0)}
    assert resampling.resample(no_documents, target).count() == 0
    assert resampling.resample(odd_documents, target.limit(0)).count() == odd_documents.count()


# --- op13 -------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def check_files(rows, docs, library, end):
    start = 0
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(docs)
    for key, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [end], "<u4")
        assert (got[key]["start"], got[key]["n_tokens"], got[key]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_op13_on_documents(spark, documents, library):
    check_files(queries.op13_token_files(spark, SF).collect(), [tuple(r) for r in documents.select("doc_id", "text").collect()], library, 1)


def test_op13_is_the_library(spark, library):
    """Pieces between white space encode as whole texts do: odd characters, marks after
    spaces, special tokens' strings, other white space, contractions."""
    rng = random.Random(11)
    parts = ["don't", "I'LL", "Word,", "word", "WORD...", "word!?", "a.b", "Word's.", "'s", "a", "B", "é", "é", "́", " ", "  ", "\n", "\t", "\x0b", "\x1c", " ", " ", "​", "İ", "Σ", "<|endoftext|>", "<|startoftext|>",
             "1", "23", "...", ",", "中文", "\U0001f600", "가", "\x00", "</w>", "x" * 30]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(0, 25))) for _ in range(3000)]
    coder = binary.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert coder.cut
    import pyarrow as pa
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for again in range(2):
        found = list(coder.encode(pa.array(texts)))
        assert sum(n for n, _, _ in found) == len(texts)
        assert [k for _, _, size in found for k in size] == [len(x) for x in want] and [i for _, ids, _ in found for i in ids] == [i for x in want for i in x]


def test_op13_files(spark, tmp_path, library):
    """Ranges in ascending order, flat files of the right width, bases by prefix sums, ids back."""
    docs = [(i, f"text number {i} " * (i % 7)) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").orderBy(F.rand(3))
    path = public_tokenizers.path("byte_bpe_50k.json")
    byte_level = Tokenizer.from_file(path)
    folder = binary.write(df, path, end=50256, folder=f"file://{tmp_path}/ids", parts=4)
    table = sorted(binary.manifest(spark, folder).collect(), key=lambda r: r["part"])
    assert len(table) == 4 and [r["base"] for r in table] == [sum(x["n_ids"] for x in table[:k]) for k in range(4)] and {r["width"] for r in table} == {"<u2"}
    whole, keys = [], []
    for r in table:
        ids, offsets = binary.mapped(f"{folder}/{r['name']}.ids", "<u2"), binary.mapped(f"{folder}/{r['name']}.offsets", "<i8")
        assert isinstance(ids, np.memmap) and len(offsets) == r["n_documents"] + 1 and offsets[0] == 0 and offsets[-1] == len(ids) == r["n_ids"]
        whole += ids.tolist()
        keys += binary.mapped_keys(f"{folder}/{r['name']}.keys").to_pylist()
    assert keys == list(range(300))
    assert whole == [x for _, t in docs for x in [*byte_level.encode(t, add_special_tokens=False).ids, 50256]]


def test_op13_odd_documents(spark, odd_documents, no_documents, library, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = binary.checksums(spark, binary.write(odd_documents, path, end=1)).collect()
    docs = [tuple(r) for r in odd_documents.select("doc_id", "text").collect()]
    assert len(rows) == len(docs)
    rows.sort(key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, 0, 1, 2, 3, 4, 4, 5, 6, 7]
    assert all(r["n_tokens"] == 1 for r in rows if r["doc_id"] in (0, 1, 2))
    want = {zlib.crc32(np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()) for _, t in docs}
    assert {r["ids_crc32"] for r in rows} == want
    empty = binary.write(no_documents, path, end=1)
    assert binary.checksums(spark, empty).count() == 0 and binary.manifest(spark, empty).count() == 0
    texts = spark.createDataFrame([("b", "two words"), ("a", None)], "name string, body string")
    named = binary.checksums(spark, binary.write(texts, path, None, key="name", text="body"), key="name").collect()
    assert sorted((r["name"], r["start"], r["n_tokens"]) for r in named) == [("a", 0, 0), ("b", 0, 2)]
