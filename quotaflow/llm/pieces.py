"""Subword encoding with seeded merge-dropout, and decoding without loss.

The vocabulary of a public BPE model gives pieces and their order.  A text is read with
one blank mark before it and blanks as marks, and falls into units: a run of marks with
the non-blank characters after it (no piece crosses a unit).  A unit starts as characters,
those without a piece as byte pieces.  An agenda holds the merges of neighbours whose
concatenation is a piece, best score first, then leftmost; a merge taken from it is
skipped when a keyed hash of (seed, row, position of the unit, unit, place, piece) falls
below ``dropout``, else it is made and its new neighbours are added.  So every occurrence
of a word is cut on its own, within and across texts, and repeatably.

The agendas of many occurrences are worked off side by side, as columns of arrays: a step takes
the best merge of each of them.  Nothing is kept from one occurrence for the next.  A text is
whole in memory while it is cut, with some 30 bytes for each of its characters.

With ``dropout`` 0 this is the model's own segmentation.  Decoding joins pieces and bytes
and takes the first mark away; the literal mark character is always spelled in bytes, so
every text comes back exactly.

Defined cases: a null text has null ids, an empty one no ids; rows with equal id and text
are cut alike; a null id is a key like any other.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import pieces as batch_pieces
from .scan import U64, mix

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
DROPOUT, SEED = 0.1, 17
# Units that are cut at once.
AT_ONCE = 400_000
# Characters up to which a unit is cut together with others; a longer one has a heap of its own.
SHORT_UNIT = 40
# Units are padded to the next of these lengths.
_WIDTHS = [*range(1, 15), 16, 18, 21, 25, 30, SHORT_UNIT]
_PLACE_BITS = 6
_NONE, _GONE = 1 << 30, -1
MARK = "▁"
_MASK = (1 << 32) - 1
_LITERAL = re.compile(f"([{MARK}\0])")


@dataclass
class Vocabulary:
    """Pieces by id; ``rank`` orders merges (lower first), ``byte`` has the ids of the byte pieces."""

    content: list[bytes]
    ids: dict[str, int]
    rank: dict[str, int]
    byte: list[int]
    key: tuple = field(default=())


def load(path: str = MODEL) -> Vocabulary:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    content, ids, scores, byte = [], {}, {}, [0] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(piece[3:5], 16)
            byte[value] = i
            content.append(bytes([value]))
        elif model.is_control(i) or model.is_unknown(i):
            content.append(b"")
        else:
            content.append(piece.replace(MARK, " ").encode())
            ids[piece], scores[piece] = i, model.get_score(i)
    order = sorted(scores, key=lambda p: (-scores[p], ids[p]))
    return Vocabulary(content, ids, {p: r for r, p in enumerate(order)}, byte, (path, len(content)))


def unit_key(seed: int, occurrence: int, unit: str) -> int:
    """The part of the key that all candidates of an occurrence of a unit share."""
    return crc32(unit.encode(), seed * 0x9E3779B1 & _MASK) ^ occurrence


def occurrences(seed: int, rows: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """32-bit numbers of the units at ``positions`` of the texts with the keys ``rows``."""
    return (mix(mix(rows ^ U64(seed & (1 << 64) - 1)) + positions.astype(U64) * U64(0x9E3779B97F4A7C15)) >> U64(32)).astype(np.uint32)


def spread(x):
    """Mixes a 32-bit number, or an array of them."""
    x = (x ^ x >> 16) * 0x21F0AAAD & _MASK
    return (x ^ x >> 15) * 0x735A2D97 & _MASK


class Pairs:
    """For two neighbouring symbols the rank of their concatenation: a hash table of arrays.

    A symbol is the rank of its piece; characters without a piece that a piece begins or ends
    with are numbered after the ranks, and ``other`` stands for all that merges with nothing.
    """

    BITS = 20
    EMPTY = U64(0xFFFFFFFFFFFFFFFF)

    def __init__(self, rank: dict[str, int]):
        self.other = len(rank)
        symbols = dict(rank)
        left, right, made = [], [], []
        for piece, r in rank.items():
            for k in range(1, len(piece)):
                halves = piece[:k], piece[k:]
                for h in halves:
                    if len(h) == 1 and h not in symbols:
                        symbols[h] = len(symbols) + 1
                if halves[0] in symbols and halves[1] in symbols:
                    left.append(symbols[halves[0]])
                    right.append(symbols[halves[1]])
                    made.append(r)
        self.of_char = np.full(0x110000, self.other, np.int32)
        for symbol, number in symbols.items():
            if len(symbol) == 1:
                self.of_char[ord(symbol)] = number
        self.many = U64(len(symbols) + 1)
        self.bits = max(self.BITS, (2 * len(made)).bit_length())
        self.keys = np.full(1 << self.bits, self.EMPTY, U64)
        self.ranks = np.full(1 << self.bits, _NONE, np.int32)
        keys, ranks = np.array(left, U64) * self.many + np.array(right, U64), np.array(made, np.int32) << _PLACE_BITS
        at = self._home(keys)
        while len(keys):
            # Of several pairs that want a free slot the first gets it, the rest go on to the next slot.
            free = np.flatnonzero(self.keys[at] == self.EMPTY)
            free = free[np.unique(at[free], return_index=True)[1]]
            self.keys[at[free]], self.ranks[at[free]] = keys[free], ranks[free]
            left_over = np.ones(len(keys), bool)
            left_over[free] = False
            keys, ranks, at = keys[left_over], ranks[left_over], self._next(at[left_over])

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys * U64(0x9E3779B97F4A7C15) >> U64(64 - self.bits)).astype(np.int64)

    def _next(self, at: np.ndarray) -> np.ndarray:
        return at + 1 & (1 << self.bits) - 1

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks, shifted to leave room for a place; ``_NONE`` where no piece is spelled so."""
        keys = left.astype(U64) * self.many + right.astype(U64)
        at = self._home(keys)
        there = self.keys[at]
        out = self.ranks[at]
        wrong = np.flatnonzero(there != keys)
        out[wrong] = _NONE
        wrong = wrong[there[wrong] != self.EMPTY]
        keys, at = keys[wrong], at[wrong]
        while len(wrong):
            at = self._next(at)
            there = self.keys[at]
            same = there == keys
            out[wrong[same]] = self.ranks[at[same]]
            on = ~same & (there != self.EMPTY)
            wrong, keys, at = wrong[on], keys[on], at[on]
        return out


class Encoder:
    def __init__(self, vocabulary: Vocabulary, dropout: float = DROPOUT, seed: int = SEED, at_once: int = AT_ONCE):
        self.v, self.dropout, self.seed, self.at_once = vocabulary, dropout, seed, at_once
        self.below = int(dropout * (1 << 32))
        self.pairs = Pairs(vocabulary.rank)
        self.of_piece = spread(np.arange(1, len(vocabulary.rank) + 1).astype(np.uint32))
        self.of_place = spread(np.arange(SHORT_UNIT).astype(np.uint32) + np.uint32(0x5BD1E995))
        by_rank = sorted(vocabulary.rank, key=vocabulary.rank.get)
        self.id_of = np.array([vocabulary.ids[p] for p in by_rank], np.int32)
        self.byte = np.array(vocabulary.byte, np.int32)

    def _by_heap(self, unit: str, key: int) -> list[str]:
        """The agenda of a long unit is a heap, with stale entries passed over."""
        rank, symbols = self.v.rank, list(unit)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda: list[tuple[int, int, str, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n:
                r = rank.get(symbols[i] + symbols[j])
                if r is not None:
                    heapq.heappush(agenda, (r, i, symbols[i], symbols[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            r, i, left, right = heapq.heappop(agenda)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            if self.below and spread(key ^ spread(i + 0x5BD1E995 & _MASK) ^ int(self.of_piece[r])) < self.below:
                continue
            symbols[i], symbols[j] = left + right, ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [s for s in symbols if s]

    def _agendas(self, symbols: np.ndarray, key: np.ndarray) -> np.ndarray:
        """The agendas of many short units, a column each, step by step.

        A row is a place.  The symbols that are left stay at the places of their first
        characters, those merged into another become ``_GONE``.  An entry of ``agenda`` is the rank and
        place of a merge in one number, so the least of a column is the unit's next.
        """
        width, n = symbols.shape
        whole = np.empty((width, n), np.int32)
        column = np.arange(n)
        # One more row is the end of every unit and the place before its first.
        symbols = np.vstack([symbols, np.full((1, n), self.pairs.other, np.int32)])
        places = np.arange(width + 1, dtype=np.int32)[:, None]
        after, before = np.repeat(places + 1, n, 1), np.repeat(places - 1, n, 1)
        before[0] = width
        agenda = np.full((width + 1, n), _NONE, np.int32)
        agenda[: width - 1] = self.pairs.find(symbols[: width - 1].ravel(), symbols[1:width].ravel()).reshape(-1, n) | places[: width - 1]
        while True:
            best = agenda.min(0)
            act = np.flatnonzero(best < _NONE)
            n = len(best)
            if len(act) < 0.6 * n or not len(act):
                # Columns that are done leave.
                done = np.flatnonzero(best >= _NONE)
                whole[:, column[done]] = symbols[:width, done]
                if not len(act):
                    return whole
                symbols, after, before, agenda = (m.take(act, 1) for m in (symbols, after, before, agenda))
                key, column, best, n, act = key[act], column[act], best[act], len(act), np.arange(len(act))
            best = best[act]
            i, r = best & (1 << _PLACE_BITS) - 1, best >> _PLACE_BITS
            at = i.astype(np.int64) * n + act
            if self.below:
                skip = spread(key[act] ^ self.of_place[i] ^ self.of_piece[r]) < np.uint32(min(self.below, _MASK))
                if self.below > _MASK:
                    skip[:] = True
                agenda.ravel()[at[skip]] = _NONE
                made = ~skip
                act, i, r, at = act[made], i[made], r[made], at[made]
            symbol, nexts, prior, waiting = symbols.ravel(), after.ravel(), before.ravel(), agenda.ravel()
            j = nexts[at].astype(np.int64) * n + act
            k, h = nexts[j], prior[at]
            symbol[at], symbol[j], waiting[j], nexts[at] = r, _GONE, _NONE, k
            k = k.astype(np.int64) * n + act
            prior[k] = i
            waiting[at] = self.pairs.find(r, symbol[k]) | i
            left = np.flatnonzero(h < width)
            h = h[left]
            at = h.astype(np.int64) * n + act[left]
            waiting[at] = self.pairs.find(symbol[at], r[left]) | h

    def cut(self, codes: np.ndarray, first: np.ndarray, of_occurrence: np.ndarray) -> np.ndarray:
        """For every character the symbol that begins there, or ``_GONE``; units run from each ``first`` to the next one."""
        final = np.full(len(codes), _GONE, np.int32)
        size = np.diff(first, append=len(codes))
        order = np.argsort(size, kind="stable")
        ends = np.searchsorted(size[order], _WIDTHS, side="right")
        for width, a, b in zip(_WIDTHS, [0, *ends], ends):
            if a == b:
                continue
            mine = order[a:b]
            place = np.arange(width)[:, None]
            within = place < size[mine]
            at = np.minimum(first[mine] + place, len(codes) - 1)
            letters = codes[at]
            key = _crc(letters, within, self.seed) ^ of_occurrence[mine]
            found = self._agendas(np.where(within, self.pairs.of_char[letters], np.int32(self.pairs.other)), key)
            final[at[within]] = found[within]
        for i in order[ends[-1] :]:
            unit = codes[first[i] : first[i] + size[i]].tobytes().decode("utf-32-le")
            at = first[i]
            for symbol in self._by_heap(unit, unit_key(self.seed, int(of_occurrence[i]), unit)):
                final[at] = self.v.rank.get(symbol, self.pairs.other)
                at += len(symbol)
        return final

    def spell(self, symbols: list[str]) -> list[int]:
        """Ids of the symbols; those without a piece are spelled in bytes."""
        ids, out = self.v.ids, []
        for s in symbols:
            known = ids.get(s)
            if known is not None:
                out.append(known)
            else:
                out += [self.v.byte[b] for b in s.encode()]
        return out

    def _ids(self, codes: np.ndarray, final: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the symbols one after the other, and how many begin at each character."""
        count = (final != _GONE).astype(np.int8)
        spelled = np.flatnonzero(final >= len(self.id_of))
        if not len(spelled):
            return self.id_of[final[final != _GONE]], count
        lead, more = _utf8(codes[spelled])
        count[spelled] = 1 + more
        begin = np.cumsum(count, dtype=np.int64) - count
        out = np.empty(int(begin[-1]) + int(count[-1]), np.int32)
        plain = np.flatnonzero((final != _GONE) & (final < len(self.id_of)))
        out[begin[plain]] = self.id_of[final[plain]]
        out[begin[spelled]] = self.byte[lead]
        for k in range(1, 4):
            some = more >= k
            out[begin[spelled[some]] + k] = self.byte[_continued(codes[spelled[some]], more[some] - k)]
        return out, count

    def encode_all(self, texts: list[str], keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts one after the other, and the number of each; ``keys`` are those of their rows."""
        marked, literal = [], {}
        for i, text in enumerate(texts):
            if MARK in text or "\0" in text:
                literal[i] = self._units(text)
                marked.append("".join(literal[i]))
            else:
                marked.append(MARK + text.replace(" ", MARK) if text else "")
        codes = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32)
        if not len(codes):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        begin = np.concatenate([[0], np.cumsum(np.fromiter(map(len, marked), np.int64, len(marked)))])
        starts = codes == ord(MARK)
        starts[1:] &= ~starts[:-1]
        starts[begin[:-1][np.diff(begin) > 0]] = True
        kept = []
        for i, own in literal.items():
            size = np.fromiter(map(len, own), np.int64, len(own))
            at = begin[i] + np.cumsum(size) - size
            starts[begin[i] : begin[i + 1]] = False
            starts[at] = True
            kept.append(at[[u[0] == "\0" for u in own]])
        first = np.flatnonzero(starts)
        before = np.concatenate([[0], np.cumsum(starts)])[begin]
        text = np.repeat(np.arange(len(texts)), np.diff(before))
        rows = np.array([k & (1 << 64) - 1 for k in keys], U64)
        of_occurrence = occurrences(self.seed, rows[text], np.arange(len(first)) - before[:-1][text])
        out, count = [], np.zeros(len(codes) + 1, np.int64)
        kept = np.concatenate(kept) if kept else np.zeros(0, np.int64)
        for a in range(0, len(first), self.at_once):
            some = slice(first[a], first[a + self.at_once] if a + self.at_once < len(first) else len(codes))
            final = self.cut(codes[some], first[a : a + self.at_once] - some.start, of_occurrence[a : a + self.at_once])
            # A literal mark or NUL is spelled in bytes, so that no merge takes it; the NUL before a mark only tells it apart.
            mine = kept[(kept >= some.start) & (kept < some.stop)]
            final[mine - some.start] = self.pairs.other
            is_mark = mine[np.append(codes, 0)[mine + 1] == ord(MARK)] if len(mine) else mine
            is_mark = is_mark[~np.append(starts, True)[is_mark + 1]]
            final[is_mark - some.start] = _GONE
            final[is_mark + 1 - some.start] = self.pairs.other
            ids, count[1:][some] = self._ids(codes[some], final)
            out.append(ids)
        return np.concatenate(out), np.diff(np.cumsum(count)[begin])

    def encode(self, text: str, key: int = 0) -> array:
        """Ids of a text; ``key`` is that of its row."""
        return array("i", self.encode_all([text], [key])[0].tobytes())

    def _units(self, text: str) -> list[str]:
        if not text:
            return []
        if MARK not in text and "\0" not in text:
            return units(text)
        out = []
        for i, part in enumerate(_LITERAL.split(text)):
            if part == "\0":
                out.append(part)
            elif part == MARK and i % 2:
                out.append("\0" + part)
            else:
                out += units(part, i == 0)
        return out

    def decode(self, ids) -> str:
        content = self.v.content
        return b"".join([content[i] for i in ids])[1:].decode()


def units(text: str, first: bool = True) -> list[str]:
    """Runs of marks with what follows them; ``first`` puts the mark before the text."""
    parts = text.split(" ")
    if "" not in parts:
        return [MARK + p for p in parts] if first else [parts[0], *(MARK + p for p in parts[1:])]
    out, run = [], 1 if first else 0
    for p in parts:
        if p:
            out.append(MARK * run + p)
            run = 1
        else:
            run += 1
    if run > 1:
        out.append(MARK * (run - 1))
    return out


def _utf8(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes of the characters, and how many bytes follow each."""
    more = (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)
    mark = np.array([0, 0xC0, 0xE0, 0xF0], np.uint32)[more]
    return mark | codes >> (6 * more).astype(np.uint32), more


def _continued(codes: np.ndarray, left: np.ndarray) -> np.ndarray:
    """A following byte of each character, with ``left`` more after it."""
    return 0x80 | codes >> (6 * left).astype(np.uint32) & 0x3F


# Remainders of the single bytes under the reversed polynomial of crc32.
_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, _CRC >> 1 ^ np.uint32(0xEDB88320), _CRC >> 1)


def _crc(letters: np.ndarray, within: np.ndarray, seed: int) -> np.ndarray:
    """``unit_key`` of occurrence 0 for the units in the columns."""
    state = np.full(letters.shape[1], (seed * 0x9E3779B1 & _MASK) ^ _MASK, np.uint32)

    def take(some, byte) -> None:
        now = state[some]
        state[some] = _CRC[(now ^ byte) & 0xFF] ^ now >> 8

    for row, ok in zip(letters, within):
        mine = slice(None) if ok.all() else np.flatnonzero(ok)
        lead, more = _utf8(row[mine])
        take(mine, lead)
        wide = np.flatnonzero(more)
        if len(wide):
            at, more, code = (np.arange(len(row))[mine][wide], more[wide], row[mine][wide])
            for k in range(1, int(more.max()) + 1):
                some = more >= k
                take(at[some], _continued(code[some], more[some] - k))
    return state ^ np.uint32(_MASK)


_encoders: dict[tuple, Encoder] = {}


def _encoder(vocabulary: Vocabulary, dropout: float, seed: int) -> Encoder:
    key = (vocabulary.key, dropout, seed)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(vocabulary, dropout, seed)
    return _encoders[key]


def encode(
    docs: DataFrame,
    vocabulary: Vocabulary,
    dropout: float = DROPOUT,
    seed: int = SEED,
    keep: tuple[Column, ...] = (),
) -> DataFrame:
    """``doc_id``, the columns of ``keep``, ``ids`` and ``lossless`` (whether decoding them gave the text)."""
    chosen = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("__key"), *keep)
    names = [c for c in chosen.columns if c not in ("text", "__key")]
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields if f.name in names]
    share = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(share.value, dropout, seed)
        for batch in batch_pieces(batches):
            texts = batch.column("text").to_pylist()
            flat, sizes = coder.encode_all([t or "" for t in texts], batch.column("__key").to_pylist())
            ends = [0, *np.cumsum(sizes).tolist()]
            listed = flat.tolist()
            same = [None if t is None else coder.decode(listed[a:b]) == t for t, a, b in zip(texts, ends, ends[1:])]
            valid = [t is not None for t in texts]
            values = pa.array(flat)
            mask = pa.array([not v for v in valid], pa.bool_())
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=mask)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), ids, pa.array(same, pa.bool_())], [*names, "ids", "lossless"])

    return chosen.mapInArrow(run, ", ".join([*kinds, "ids array<int>", "lossless boolean"]))


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ``ids``; null ids give a null text."""
    content = encoded.sparkSession.sparkContext.broadcast(vocabulary.content)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if ids is None else b"".join([content.value[i] for i in ids])[1:].decode() for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    chosen = encoded.select("doc_id", "ids")
    return chosen.mapInArrow(run, f"doc_id {chosen.schema['doc_id'].dataType.simpleString()}, text string")


def digest(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        F.when(F.col("ids").isNotNull(), F.size("ids")).cast("long").alias("n_pieces"),
        F.size(F.array_distinct("ids")).cast("long").alias("n_distinct_pieces"),
        F.when(F.col("ids").isNotNull(), F.xxhash64("ids")).alias("ids_hash"),
        "lossless",
    )
