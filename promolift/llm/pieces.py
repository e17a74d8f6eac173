"""SentencePiece encoding and decoding in vectorised merge rounds.

The model file (a parameter) is read with the sentencepiece library for its piece table
only; encoding and decoding are done here.  A batch's texts are cut into units that no
merge can cross (a run of spaces with the word behind it, or a character that occurs in
no longer piece).  Distinct units that the worker hasn't seen become one flat array of
symbols.  Each round finds the best pair of every unit by a segmented minimum, merges all
its leftmost non-overlapping occurrences at once and compacts the arrays, until no pair
is left.  Where a merged symbol could at once take part in a pair as good as the one just
merged, the unit merges its leftmost pair only, so that the order is the library's.

Defined cases: a null or empty text has no ids and decodes to the empty text; characters
outside the vocabulary become byte pieces; texts of any length are encoded whole; equal
texts get equal ids; extra columns are passed on only if named; an empty table gives no
rows.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import map_texts

SPACE = "▁"
NEVER = np.int32(2**31 - 1)
#: A worker forgets the units it has met beyond so many units, or ids of units.
CACHED, CACHED_IDS = 400_000, 4_000_000


class Model:
    """The piece table of a model, as arrays."""

    def __init__(self, model_file: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        special = np.array([sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)])
        ids = {p: i for i, p in enumerate(names) if not special[i]}
        self.byte_ids = np.zeros(256, np.int32)
        for i in range(n):
            if sp.is_byte(i):
                self.byte_ids[int(names[i][3:-1], 16)] = i
        score = {p: sp.get_score(i) for p, i in ids.items()}
        # symbols: pieces by id, then single characters that occur in pieces only
        self.symbol = dict(ids)
        for c in sorted({c for p in ids for c in p}):
            self.symbol.setdefault(c, n + len(self.symbol) - len(ids))
        order = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        rank = {p: order[s] for p, s in score.items()}
        pairs = [
            (self.symbol[p[:k]], self.symbol[p[k:]], ids[p], rank[p])
            for p in ids if len(p) > 1 for k in range(1, len(p)) if p[:k] in self.symbol and p[k:] in self.symbol
        ]
        self.width = n + len(self.symbol) - len(ids)
        left, right, merged, ranks = (np.array(x, np.int64) for x in zip(*pairs))
        by = np.argsort(left * self.width + right)
        self.keys = (left * self.width + right)[by]
        self.merged, self.rank = merged[by].astype(np.int32), ranks[by].astype(np.int32)
        best = {}
        for a, b, p, r in pairs:
            for x in (a, b):
                best[x] = min(best.get(x, NEVER), r)
        #: the merged symbol may at once be part of a pair as good as its own
        self.hasty = np.zeros(self.width, bool)
        for p, i in ids.items():
            self.hasty[i] = best.get(i, NEVER) <= rank[p]
        long = [p for p in ids if len(p) > 1]
        inner = {c for p in long for c in p}
        if any(SPACE in p.lstrip(SPACE) for p in long):
            raise ValueError("the model has pieces with a space behind a letter; units can't be cut at spaces")
        self.alone = "".join(c for c in map(chr, [*range(32), 127, 0x85, 0xA0, 0x2028, 0x2029]) if c not in inner)
        cut = re.escape(self.alone)
        self.unit = re.compile(f"[{cut}]|{SPACE}+[^{SPACE}{cut}]*|[^{SPACE}{cut}]+")
        # decoding
        raw = [b"" if sp.is_control(i) else b" \xe2\x81\x87 " if sp.is_unknown(i) else bytes([int(names[i][3:-1], 16)]) if sp.is_byte(i) else names[i].replace(SPACE, " ").encode() for i in range(n)]
        self.raw_at = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.is_byte = np.array([sp.is_byte(i) for i in range(n)])
        self.skipped = np.array([sp.is_control(i) for i in range(n)])
        self.lead = np.array([not special[i] and names[i].startswith(SPACE) for i in range(n)])
        self.forget()
        self.run = 0
        self.char_ids = {c: i for c, i in self.symbol.items() if len(c) == 1}
        # Long runs of spaces: where run pieces have one score, worse than all others, and no
        # piece has two spaces before a letter, merges take the longest piece from the left
        # (tried here), so that a long run can be cut there.
        runs = {p: rank[p] for p in long if not p.strip(SPACE)}
        if runs and len(set(runs.values())) == 1 and max(rank[p] for p in long) in runs.values() and not any(p.startswith(SPACE * 2) and p.strip(SPACE) for p in long):
            m = max(map(len, runs))
            if all(self.encode_units([SPACE * (m + k)])[0][0] == ids[SPACE * m] for k in range(2 * m)):
                self.run = m

    def look(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; NEVER where they don't merge."""
        key = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.rank[at], NEVER), np.where(hit, self.merged[at], -1)

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units end to end, and each unit's number of ids."""
        n = np.fromiter(map(len, units), np.int64, len(units))
        text = "".join(units)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        chars, back = np.unique(codes, return_inverse=True)
        table = np.array([self.char_ids.get(chr(c), -1 - int(c)) for c in chars], np.int64)
        sym, unit = table[back], np.repeat(np.arange(len(units)), n)
        done_sym, done_unit, done_at = [], [], []
        at = np.arange(len(sym))
        rank, merged = self._pairs(sym, unit)
        while len(sym):
            first = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
            low = np.minimum.reduceat(rank, first)
            size = np.diff(np.r_[first, len(sym)])
            idle = np.repeat(low == NEVER, size)
            if idle.any():  # finished units leave the arrays
                done_sym.append(sym[idle]), done_unit.append(unit[idle]), done_at.append(at[idle])
                go = ~idle
                sym, unit, at, rank, merged = sym[go], unit[go], at[go], rank[go], merged[go]
                first_low = low[low != NEVER]
                size = size[low != NEVER]
                low = first_low
                if not len(sym):
                    break
            spot = np.flatnonzero(rank == np.repeat(low, size))
            own = unit[spot]
            lead = np.r_[True, own[1:] != own[:-1]]  # the leftmost of each unit
            lead_merged = merged[spot][lead][np.cumsum(lead) - 1]
            take = lead | ((merged[spot] == lead_merged) & ~self.hasty[lead_merged])
            spot = spot[take]
            # of overlapping occurrences, every second one from the left of each run goes
            if len(spot) > 1:
                chain = np.r_[True, (np.diff(spot) > 1) | (unit[spot[1:]] != unit[spot[:-1]])]
                start = np.flatnonzero(chain)
                step = np.arange(len(spot)) - start[np.cumsum(chain) - 1]
                spot = spot[step % 2 == 0]
            sym[spot] = merged[spot]
            left = np.ones(len(sym), bool)
            left[spot + 1] = False
            touched = np.zeros(len(sym), bool)
            touched[spot] = True
            sym, unit, at, rank, merged, touched = sym[left], unit[left], at[left], rank[left], merged[left], touched[left]
            touched[:-1] |= touched[1:]
            fresh = np.flatnonzero(touched)
            rank[fresh], merged[fresh] = self._pairs_at(sym, unit, fresh)
        sym, unit, at = np.concatenate(done_sym or [sym]), np.concatenate(done_unit or [unit]), np.concatenate(done_at or [at])
        by = np.argsort(at, kind="stable")
        return self._to_ids(sym[by], unit[by], len(units))

    def _pairs_at(self, sym, unit, where):
        nxt = np.minimum(where + 1, len(sym) - 1)
        rank, merged = self.look(sym[where], sym[nxt])
        apart = (where + 1 > nxt) | (unit[where] != unit[nxt])
        rank[apart] = NEVER
        return rank, merged

    def _pairs(self, sym, unit):
        return self._pairs_at(sym, unit, np.arange(len(sym)))

    def _to_ids(self, sym, unit, n_units):
        """Symbols outside the vocabulary become the byte pieces of their character."""
        n_pieces = len(self.is_byte)
        odd = (sym < 0) | (sym >= n_pieces)
        if odd.any():
            names = {v: k for k, v in self.symbol.items() if v >= n_pieces}
            kinds, back = np.unique(sym[odd], return_inverse=True)
            text = [(chr(-1 - k) if k < 0 else names[k]).encode("utf-8", "surrogatepass") for k in kinds.tolist()]
            each = np.ones(len(sym), np.int64)
            each[odd] = np.array([len(x) for x in text])[back]
            out = np.repeat(sym, each)
            unit = np.repeat(unit, each)
            begin = (np.cumsum(each) - each)[odd]
            lengths = each[odd]
            flat = self.byte_ids[np.frombuffer(b"".join(text), np.uint8)]
            offset = np.cumsum([0, *map(len, text)])[:-1][back]
            step = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            out[np.repeat(begin, lengths) + step] = flat[np.repeat(offset, lengths) + step]
            sym = out
        return sym.astype(np.int32), np.bincount(unit, minlength=n_units)

    def units(self, text: str | None) -> list[str]:
        if not text:
            return []
        found = self.unit.findall(SPACE + text.replace(" ", SPACE))
        if self.run and SPACE * (2 * self.run + 2) in SPACE + text.replace(" ", SPACE):
            m, out = self.run, []
            for u in found:
                lead = len(u) - len(u.lstrip(SPACE))
                k = max(0, (lead - m - 1) // m)
                out += [SPACE * m] * k + [u[k * m:]]
            return out
        return found

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and the offsets of the texts in them."""
        per_text = [self.units(t) for t in texts]
        units = list(chain.from_iterable(per_text))
        if len(self.known) > CACHED or self.pool_at[-1] > CACHED_IDS:
            self.forget()
        fresh = list(set(units).difference(self.known))
        if fresh:
            ids, n = self.encode_units(fresh)
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
            self.pool_at = np.concatenate([self.pool_at, self.pool_at[-1] + np.cumsum(n)])
            self.pool = np.concatenate([self.pool, ids])
        place = np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))
        begin = self.pool_at[place]
        n = self.pool_at[place + 1] - begin
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = self.pool[np.repeat(begin - ends[:-1], n) + np.arange(ends[-1])]
        return ids, ends[np.cumsum([0, *map(len, per_text)])]

    def forget(self) -> None:
        """Drop the units met so far; ids of unit k are pool[pool_at[k]:pool_at[k + 1]]."""
        self.known: dict[str, int] = {}
        self.pool, self.pool_at = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The text of each slice of ids."""
        if ((ids < 0) | (ids >= len(self.is_byte))).any():
            raise ValueError("an id lies outside the vocabulary")
        n = self.raw_at[ids + 1] - self.raw_at[ids]
        ends = np.concatenate([[0], np.cumsum(n)])
        flat = self.raw[np.repeat(self.raw_at[ids], n) + np.arange(ends[-1]) - np.repeat(ends[:-1], n)].tobytes()
        out = []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            own = flat[ends[a]:ends[b]]
            while a < b and self.skipped[ids[a]]:
                a += 1
            if a < b and self.lead[ids[a]]:  # the space that encoding puts before the text
                own = own[1:]
            try:
                out.append(own.decode("utf-8"))
            except UnicodeDecodeError:
                out.append(_lenient(own))
        return out


def _lenient(raw: bytes) -> str:
    """UTF-8 with one replacement character for each byte that isn't part of a character."""
    out = []
    while raw:
        try:
            out.append(raw.decode("utf-8"))
            break
        except UnicodeDecodeError as e:
            out.append(raw[: e.start].decode("utf-8") + "�")
            raw = raw[e.start + 1:]
    return "".join(out)


@lru_cache(2)
def model(model_file: str) -> Model:
    return Model(model_file)


def encode_decode(df: DataFrame, model_file: str, text: str = "text", passed: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``passed`` columns, ids (array of int) and decoded (the text that ids decode to).

    One narrow pass: no shuffle; a task holds a few million characters at a time.  The
    model file must be readable on every executor under the same path.
    """
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.StringType())]

    def of(texts):
        m = model(model_file)
        ids, offsets = m.encode(texts)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())), pa.array(m.decode(ids, offsets), pa.string())

    return map_texts(df, text, passed, fields, of)
