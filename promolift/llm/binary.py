"""Token ids as flat binary files (operator 13).

Every range of documents, in ascending order of their key, becomes three files in a
shared folder:

* ``<name>.ids``: the ids of its documents one after the other, little-endian unsigned
  integers of 16 or 32 bits;
* ``<name>.offsets``: n + 1 little-endian signed 64-bit integers; document k of the range
  has the ids from offset k up to offset k + 1;
* ``<name>.keys``: the documents' keys in the same order, an Arrow file of one column.

A manifest (Parquet, one row a range) names the files and gives each range's base, the
number of ids before it in the whole corpus, by prefix sums over the ranges.  Readers map
the files into memory and slice them; a document's place in the corpus is base + offset.

A task writes under a name of its own and the manifest holds the names of finished tasks
only, so that a repeated or lost task leaves at worst files that nothing refers to.

Defined cases: a null text is empty, and an empty text is the end id alone.  Null keys
come first.  Rows that share a key stay rows of their own, ordered by two hashes of their
text; equal rows come in any order.  An empty table gives an empty manifest.
Other columns, whatever their names, are ignored.  One document is encoded as a whole and
has to fit in a task; ranges are streamed.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .common import keep, ship
from .ordering import bases, lookup, spread

#: Pieces whose ids a worker remembers; beyond that it starts anew (memory only).
REMEMBERED = 1_000_000
#: Bytes of text encoded at once.
AT_ONCE = 32_000_000

#: ASCII letters with marks behind them.
PLAIN, LETTERS = re.compile(rb"([A-Za-z]+)([.,;:!?]*)"), re.compile(rb"[a-z]+")

MANIFEST = "part int, name string, n_documents long, n_ids long"


def cuts_at_space(spec: dict) -> bool:
    """Whether ASCII white space always ends a token and leaves none itself, so that the
    pieces between may be encoded apart: the tokenizer normalises characters without regard
    to what stands across white space, and keeps only matches of a pattern that white space
    is no part of."""
    steps = lambda x, key: [] if x is None else x[key] if x["type"] == "Sequence" else [x]
    for x in steps(spec["normalizer"], "normalizers"):
        if not (x["type"] in ("NFC", "Lowercase") or x["type"] == "Replace" and x["pattern"] == {"Regex": r"\s+"} and x["content"] == " "):
            return False
    cut = steps(spec["pre_tokenizer"], "pretokenizers")[:1]
    if not cut or cut[0]["type"] != "Split" or cut[0]["behavior"] != "Removed" or not cut[0]["invert"]:
        return False
    own = cut[0]["pattern"].get("Regex", " ")
    classes = (r"[^\s\p{L}\p{N}]+", r"[\p{L}]+", r"[\p{N}]")   # none of them matches white space
    rest = own
    for c in classes:
        rest = rest.replace(c, "")
    added = [x["content"] for x in spec["added_tokens"]]
    return not any(c.isspace() for c in rest + "".join(added)) and not set(rest) & set(".[](){}*+?\\^$")


def parts_plain_words(spec: dict) -> bool:
    """Whether, beyond ``cuts_at_space``, ASCII letters followed by points and commas are the
    tokens of the letters in lower case and those of the marks: letters are lowered and kept
    in runs, and no other choice of the pattern and no added token is of such characters."""
    steps = spec["normalizer"] and spec["normalizer"].get("normalizers", [spec["normalizer"]]) or []
    own = (spec["pre_tokenizer"].get("pretokenizers") or [spec["pre_tokenizer"]])[0]["pattern"].get("Regex", "")
    choices = own.split("|")
    return (any(x["type"] == "Lowercase" for x in steps) and {r"[\p{L}]+", r"[^\s\p{L}\p{N}]+"} <= set(choices)
            and all(c.startswith(("'", "[")) for c in choices) and all(re.search(r"[^A-Za-z.,;:!?]", x["content"]) for x in spec["added_tokens"]))


class Encoder:
    """The tokenizers library over texts, without special ids of its own.  Where the pieces
    between white space may be encoded apart, a worker encodes each distinct one once and
    remembers up to REMEMBERED of them."""

    _held: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # the task's core alone
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        spec = json.loads(self.library.to_str())
        self.cut = cuts_at_space(spec)
        self.plain = self.cut and parts_plain_words(spec)
        self.forget()

    @classmethod
    def of(cls, path: str) -> Encoder:
        """This worker's encoder of a file."""
        if path not in cls._held:
            cls._held[path] = cls(path)
        return cls._held[path]

    def forget(self):
        self.known: dict[bytes, int] = {}   # pieces by number; their ids: flat[begin:begin + size]
        self.begin, self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _hold(self, pieces: list[bytes], ids: np.ndarray, size: np.ndarray) -> None:
        """Remember the ids of new pieces."""
        self.known.update(zip(pieces, range(len(self.size), len(self.size) + len(pieces))))
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(size) - size])
        self.size, self.flat = np.concatenate([self.size, size]), np.concatenate([self.flat, ids])

    def _hold_lists(self, pieces: list[bytes], found: list[list[int]]) -> None:
        size = np.fromiter(map(len, found), np.int64, len(found))
        self._hold(pieces, np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum())), size)

    def _gather(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of known pieces one after the other, and their sizes."""
        size = self.size[number]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat[np.arange(total) + np.repeat(self.begin[number] - ends + size, size)], size

    def _learn(self, pieces: list[bytes]) -> None:
        """Words with marks from the tokens of both parts, all else by the library."""
        known, pairs, whole = self.known, [], pieces
        if self.plain:
            pairs = [(p, m[1].lower(), m[2]) for p in pieces if (m := PLAIN.fullmatch(p)) and (m[2] or not p.islower())]
            made = {p for p, _, _ in pairs}
            parts = {x for _, word, marks in pairs for x in (word, marks)}
            whole = list(dict.fromkeys([*(p for p in pieces if p not in made), *(x for x in parts if x not in known)]))
            # letters in lower case are one piece of the pattern: its model has them at once
            words, whole = [p for p in whole if LETTERS.fullmatch(p)], [p for p in whole if not LETTERS.fullmatch(p)]
            tokens = self.library.model.tokenize
            self._hold_lists(words, [[t.id for t in tokens(p.decode())] for p in words])
        self._hold_lists(whole, [x.ids for x in self.library.encode_batch_fast([p.decode("utf-8", "replace") for p in whole], add_special_tokens=False)])
        if pairs:
            ids, size = self._gather(np.fromiter((known[x] for _, word, marks in pairs for x in (word, marks)), np.int64, 2 * len(pairs)))
            self._hold([p for p, _, _ in pairs], ids, size.reshape(-1, 2).sum(1))

    def encode(self, texts: pa.Array):
        """The texts' ids, in pieces: (number of texts, all their ids one after the other, each
        text's number of ids)."""
        if not self.cut:
            for start, n in _cuts(texts, AT_ONCE // 8):
                found = [x.ids for x in self.library.encode_batch(texts.slice(start, n).to_pylist(), add_special_tokens=False)]
                yield n, np.array([i for x in found for i in x], np.uint32), np.array([len(x) for x in found], np.int64)
            return
        for start, n in _cuts(texts, AT_ONCE):
            if len(self.known) > REMEMBERED:
                self.forget()
            split = pc.ascii_split_whitespace(texts.slice(start, n))
            words = split.flatten().dictionary_encode()
            distinct = words.dictionary.cast(pa.binary()).to_pylist()
            new = [w for w in distinct if w not in self.known]
            if new:
                self._learn(new)
            number = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
            at, ends = words.indices.to_numpy(), split.offsets.to_numpy() - split.offsets[0].as_py()
            first = 0
            while first < n:    # a million words at a time
                last = min(n, max(first + 1, int(np.searchsorted(ends, ends[first] + 1_000_000, "right")) - 1))
                ids, size = self._gather(number[at[ends[first]:ends[last]]])
                places = np.concatenate([[0], np.cumsum(size)])
                yield last - first, ids, np.diff(places[ends[first:last + 1] - ends[first]])
                first = last


def _cuts(texts: pa.Array, most: int):
    """Consecutive (start, count) of about ``most`` bytes."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield start, stop - start
        start = stop


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def _store(uri: str):
    """(file system, path) of a folder or file that Spark names by ``uri``."""
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri.removeprefix("file:"))
    return fs.LocalFileSystem(), uri


def mapped(uri: str, dtype: str):
    """A file of integers of one kind, mapped into memory (where the store is no mounted
    folder: read at once)."""
    where, path = _store(uri)
    if isinstance(where, fs.LocalFileSystem):
        return np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.empty(0, dtype)
    with where.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), dtype=dtype)


def mapped_keys(uri: str):
    where, path = _store(uri)
    if isinstance(where, fs.LocalFileSystem):
        return pa.ipc.open_file(pa.memory_map(path)).read_all().column(0)
    with where.open_input_file(path) as f:
        return pa.ipc.open_file(f).read_all().column(0)


def write(docs: DataFrame, tokenizer: str, end: int | None, folder: str | None = None, key: str = "doc_id", text: str = "text", parts: int | None = None) -> str:
    """Encode ``text`` of every row with the tokenizer file, append ``end`` (None: nothing) to
    each document and write the files into ``folder`` (default: a new one in the shared
    checkpoint folder).  ``parts``: the number of ranges (default: Spark's choice).  Returns
    the folder."""
    spark = docs.sparkSession
    ship(spark)
    folder = (folder or f"{ensure_checkpoint_dir(spark)}/llm/token-ids-{uuid.uuid4().hex}").rstrip("/")
    width = "<u2" if max(vocabulary_size(tokenizer), (end or 0) + 1) <= 1 << 16 else "<u4"
    rows = docs.select(docs[f"`{key}`"].alias("k"), F.coalesce(docs[f"`{text}`"], F.lit("")).alias("t"))
    # sampled keys reach the driver: hashes stand for texts
    rows = spread(rows.select("k", "t", F.xxhash64("t").alias("h"), F.xxhash64(F.lit(1), "t").alias("i")), [F.col(c) for c in "khi"], parts)

    def run(batches):
        coder, name, writer, total, count, part = None, uuid.uuid4().hex, None, 0, 0, 0
        where, path = _store(folder)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if coder is None:
                coder, part = Encoder.of(tokenizer), batch.column(2)[0].as_py()
                where.create_dir(path, recursive=True)
                ids, offsets, held = (where.open_output_stream(f"{path}/{name}.{x}") for x in ("ids", "offsets", "keys"))
                offsets.write(np.zeros(1, "<i8").tobytes())
                writer = pa.ipc.new_file(held, pa.schema([("key", batch.schema.field(0).type)]))
            start = 0
            for n, own, size in coder.encode(batch.column(1)):
                if end is not None:
                    own, size = np.insert(own, np.cumsum(size), end), size + 1
                ends = total + np.cumsum(size, dtype="<i8")
                ids.write(own.astype(width).tobytes())
                offsets.write(ends.tobytes())
                writer.write_batch(pa.record_batch([batch.column(0).slice(start, n)], names=["key"]))
                total, count, start = int(ends[-1]), count + n, start + n
        if coder is not None:
            writer.close()
            for f in (ids, offsets, held):
                f.close()
            yield pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in ((part, pa.int32()), (name, pa.string()), (count, pa.int64()), (total, pa.int64()))], names=["part", "name", "n_documents", "n_ids"])

    found = keep(rows.select("k", "t", "part").mapInArrow(run, MANIFEST), "token-id-parts")
    sums = bases({r["part"]: r["n_ids"] for r in found.select("part", "n_ids").collect()})
    found.withColumn("base", lookup(F.col("part"), sums)).withColumn("width", F.lit(width)).withColumn("key_type", F.lit(docs.schema[key].dataType.json())) \
        .coalesce(1).write.parquet(f"{folder}/manifest")
    return folder


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row a range: part, name, n_documents, n_ids, base, width, key_type."""
    return spark.read.parquet(f"{folder}/manifest")


def documents(spark: SparkSession, folder: str, fields: list[T.StructField], of, key: str = "doc_id", at_once: int = 4_000_000) -> DataFrame:
    """Read the files back: key, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``fields``, the latter from ``of(ids, offsets)``: a function from the ids of consecutive
    documents and their n + 1 places in it to one Arrow array for each field.  A task maps the
    files of its ranges and holds about ``at_once`` ids at a time."""
    ship(spark)
    table = manifest(spark, folder)
    ranges = table.agg(F.count("*").alias("n"), F.first("key_type").alias("k")).first()
    kind = T._parse_datatype_json_string(ranges["k"]) if ranges["n"] else T.LongType()
    schema = T.StructType([T.StructField("key_", kind), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), *fields])
    heads = [f.name for f in schema.fields]

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids, offsets, keys = mapped(f"{folder}/{r['name']}.ids", r["width"]), mapped(f"{folder}/{r['name']}.offsets", "<i8"), mapped_keys(f"{folder}/{r['name']}.keys").combine_chunks()
                first, n = 0, len(offsets) - 1
                while first < n:
                    last = min(max(int(np.searchsorted(offsets, offsets[first] + at_once, "right")) - 1, first + 1), n)
                    place = np.asarray(offsets[first:last + 1], np.int64)
                    own = ids[place[0]:place[-1]]
                    yield pa.RecordBatch.from_arrays([keys.slice(first, last - first), pa.array(place[:-1] + r["base"]), pa.array(np.diff(place)), *of(own, place - place[0])], names=heads)
                    first = last

    spread_out = table.select("part", "name", "base", "width").repartitionByRange(max(1, ranges["n"]), "part")
    return spread_out.mapInArrow(run, schema).withColumnRenamed("key_", key)


def checksums(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """Read back per document: key, start, n_tokens, ids_crc32 (of the ids as little-endian
    unsigned 32-bit integers)."""

    def of(ids, places):
        wide = np.ascontiguousarray(ids, "<u4")
        return [pa.array([zlib.crc32(wide[a:b]) for a, b in zip(places[:-1].tolist(), places[1:].tolist())], pa.int64())]

    return documents(spark, folder, [T.StructField("ids_crc32", T.LongType())], of, key)
