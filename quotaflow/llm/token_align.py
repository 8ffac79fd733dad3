"""The tokens of two tokenizers aligned by the bytes they cover.

A text with a space before it is encoded by a byte-level BPE (A) and by a BPE of pieces (B).  Where tokens
of both end at the same byte, a group of tokens ends; tokens whose bytes overlap are linked, and a
pair of ids counts how many links of the whole corpus hold it.

Groups are found in windows.  A shared end is an anchor if the next tokens of both sides start with a
space; the token ids between two anchors are a window.  Most windows are a word.  Windows are numbered by their two
id tuples, and what one gives, its groups and links, is found once for some megabytes of texts, a lot.

Texts never leave their task.  A task turns a lot into numbers of windows, and sends the lot's distinct windows and
pairs along; these are written once.  Spark sums the pairs over all lots and finds each B id's highest
count, and each lot gets its pairs' counts back: a pair that is in every document is a row per lot.

Defined cases: a null or empty text, and one whose joined A or B bytes are not the text's (a literal U+2581,
which B reads as a blank), has no tokens, zeros and an empty group text; a null id stays; equal rows
are aligned alike and all counted; a text is encoded whole, so a task needs some hundred bytes for each byte of its
longest; ties for the highest count are all best; an empty table gives none; other columns are not looked at,
whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from ..sources.scratch import small_side
from .base import pieces as batch_pieces
from .base import written
from .scan import U64, mix

BYTE_BPE, PIECE_BPE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
# Bytes of text of a lot, and of what a task holds as tokens at a time.
LOT_BYTES, SLICE_BYTES = 4 << 20, 1 << 18
MARK = "▁"

# The first cuts of the byte-level tokenizer.
CUTS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters that not all libraries may put into the same classes.
_OTHER = re.compile("[^\t\n\r -~¡-ɏ]")


def byte_of_symbol() -> dict[str, int]:
    """The byte that each symbol of a byte-level vocabulary stands for: printable ones themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Side:
    """One tokenizer: what its tokens spell, and ids of texts that start with a space."""

    bytes: list[bytes]
    encode: Callable[[list[str]], list[list[int]]]

    def __post_init__(self) -> None:
        self.length = np.array([len(t) for t in self.bytes], np.int64)
        self.space = np.array([t[:1] == b" " for t in self.bytes])

    def spell(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


def _byte_bpe(path: str) -> Side:
    """A byte-level BPE.  Its entries are numbered in the order of their merges, so they are their own ranks: texts
    whose characters all libraries put into the same classes are encoded by these, others by the file's own library.
    """
    model = Tokenizer.from_file(path)
    # Special tokens' strings are text like any other.
    model.encode_special_tokens = True
    special, of = {t.content for t in model.get_added_tokens_decoder().values()}, byte_of_symbol()
    entries = [model.id_to_token(i) or "" for i in range(model.get_vocab_size())]
    tokens = [b"" if e in special else bytes(of[c] for c in e) for e in entries]
    ranks = {t: i for i, t in enumerate(tokens) if t}
    ranked = tiktoken.Encoding(path, pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})

    def encode(texts: list[str]) -> list[list[int]]:
        plain = [_OTHER.search(t) is None for t in texts]
        other = iter(model.encode_batch([t for t, p in zip(texts, plain, strict=True) if not p], add_special_tokens=False))
        return [ranked.encode_ordinary(t) if p else next(other).ids for t, p in zip(texts, plain, strict=True)]

    return Side(tokens, encode)


def _piece_bpe(path: str) -> Side:
    """A BPE of pieces, which puts the first space there itself."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def spelled(i: int) -> bytes:
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return b"" if model.is_control(i) or model.is_unknown(i) else piece.replace(MARK, " ").encode()

    tokens = [spelled(i) for i in range(model.get_piece_size())]
    return Side(tokens, lambda texts: model.encode([t[1:] for t in texts], num_threads=1))


@dataclass
class Windows:
    """Windows of ids: where each starts in ``a`` and in ``b``, and the ends."""

    a: np.ndarray
    b: np.ndarray
    a_at: np.ndarray
    b_at: np.ndarray

    def _sides(self) -> tuple:
        return (self.a, self.a_at), (self.b, self.b_at)

    def __len__(self) -> int:
        return len(self.a_at) - 1

    def take(self, which: np.ndarray) -> Windows:
        """The windows numbered in ``which``, one after the other."""
        parts = []
        for ids, at in self._sides():
            size = (at[1:] - at[:-1])[which]
            starts = np.append(0, np.cumsum(size))
            parts += [ids[np.arange(starts[-1]) + np.repeat(at[which] - starts[:-1], size)], starts]
        return Windows(parts[0], parts[2], parts[1], parts[3])

    def same(self, other: Windows) -> bool:
        return all(np.array_equal(x, y) for (x, y) in zip(self._sides()[0] + self._sides()[1], other._sides()[0] + other._sides()[1], strict=True))

    def hashes(self) -> np.ndarray:
        """A number for each pair of id tuples."""
        out = np.zeros(len(self), U64)
        for side, (ids, at) in enumerate(self._sides()):
            place = np.arange(len(ids)) - np.repeat(at[:-1], np.diff(at))
            out += np.add.reduceat(mix((ids << 1 | side | place << 33).astype(U64)), at[:-1])
        return out

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """One window for each pair of id tuples there is, and for every window the place of its own among these.

        Windows meet by a hash and are compared id by id; should two different ones have met, by the tuples themselves.
        """
        if not len(self):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        _, first, of = np.unique(self.hashes(), return_index=True, return_inverse=True)
        if not self.take(first[of]).same(self):
            numbers: dict[tuple, int] = {}
            cut = [[tuple(ids[i:j].tolist()) for i, j in zip(at, at[1:])] for ids, at in self._sides()]
            of = np.array([numbers.setdefault(key, len(numbers)) for key in zip(*cut, strict=True)])
            first = np.unique(of, return_index=True)[1]
        return first, of


class Coder:
    """Both tokenizers, and the alignment of windows."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = _byte_bpe(a_path), _piece_bpe(b_path)
        # Ids as they stand in a group's text: before a comma or the end of their side.
        ids = [*range(len(self.a.bytes)), *range(len(self.b.bytes))]
        ends = ["|"] * len(self.a.bytes) + [";"] * len(self.b.bytes)
        self.shown = [f"{i}{c}" for i, end in zip(ids, ends, strict=True) for c in (",", end)]
        self.shown_length = np.array([len(x) for x in self.shown])

    def cut(self, a: np.ndarray, b: np.ndarray) -> Windows:
        """Windows between shared ends before tokens that both start with a space."""
        a_ends, b_ends = np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b])
        token_of = np.full(int(a_ends[-1]) + 1, -1, np.int32)
        token_of[a_ends] = np.arange(len(a), dtype=np.int32)
        in_a = token_of[b_ends]
        in_b = np.flatnonzero(in_a >= 0)
        in_a = in_a[in_b].astype(np.int64)
        anchor = self.a.space[a[np.minimum(in_a + 1, len(a) - 1)]] & self.b.space[b[np.minimum(in_b + 1, len(b) - 1)]]
        anchor[-1] = True
        return Windows(a, b, np.append(0, in_a[anchor] + 1), np.append(0, in_b[anchor] + 1))

    def _groups(self, windows: Windows) -> tuple[np.ndarray, ...]:
        """Ends of all tokens of both sides, and where a token of both ends."""
        a_ends, b_ends = np.cumsum(self.a.length[windows.a]), np.cumsum(self.b.length[windows.b])
        return a_ends, b_ends, np.intersect1d(a_ends, b_ends, assume_unique=True)

    def links(self, windows: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of groups, where the links start, and the links (A id above, B id in the low 32 bits)."""
        if not len(windows):
            return np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64)
        a_ends, b_ends, shared = self._groups(windows)
        stops = a_ends[windows.a_at[1:] - 1]
        # Between two neighbouring ends one token of either side overlaps one of the other.
        ends = np.sort(np.concatenate([a_ends, b_ends]), kind="stable")
        ends = ends[np.append(True, ends[1:] != ends[:-1])]
        links = windows.a[np.searchsorted(a_ends, ends)] << 32 | windows.b[np.searchsorted(b_ends, ends)]
        groups = np.diff(np.searchsorted(shared, stops, side="right"), prepend=0)
        return groups, np.append(0, np.searchsorted(ends, stops, side="right")), links

    def texts(self, windows: Windows) -> list[str]:
        """The groups of each window."""
        if not len(windows):
            return []
        a_ends, b_ends, shared = self._groups(windows)
        group_a, group_b = np.searchsorted(shared, a_ends), np.searchsorted(shared, b_ends)
        last_a, last_b = shared[group_a] == a_ends, shared[group_b] == b_ends
        codes = np.concatenate([2 * windows.a + last_a, 2 * (windows.b + len(self.a.bytes)) + last_b])
        codes = codes[np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")]
        text = "".join(map(self.shown.__getitem__, codes.tolist()))
        # A window's last token is one of B, with a semicolon that is not shown.
        ends = np.cumsum(self.shown_length[codes])[windows.a_at[1:] + windows.b_at[1:] - 1].tolist()
        return [text[i : j - 1] for i, j in zip([0, *ends], ends)]


@dataclass
class Lot:
    """Texts as numbers of distinct windows, of which the commonest come first; ``counts`` and ``link_at`` are theirs."""

    windows: list[np.ndarray | None]
    distinct: Windows
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    link_at: np.ndarray
    links: np.ndarray
    counts: np.ndarray


def _joined(parts: list[Windows]) -> Windows:
    """All windows of the parts, one after the other."""
    sides = []
    for ids, at in (("a", "a_at"), ("b", "b_at")):
        sides.append(np.concatenate([getattr(p, ids) for p in parts]))
        sizes = np.concatenate([np.diff(getattr(p, at)) for p in parts])
        sides.append(np.append(0, np.cumsum(sizes)))
    return Windows(sides[0], sides[2], sides[1], sides[3])


def _slice(coder: Coder, texts: list[str | None]) -> tuple[Windows, list[np.ndarray | None], list[int], list[int]]:
    """Distinct windows of some texts, the numbers of each text's windows, and its numbers of tokens.

    A text starts with a space on both sides and ends on both, so its ends are anchors.
    """
    spaced = [" " + (t or "") for t in texts]
    ids = coder.a.encode(spaced), coder.b.encode(spaced)
    sound = []
    for t, text, a, b in zip(texts, spaced, *ids, strict=True):
        wanted = text.encode()
        sound.append(bool(t) and coder.a.spell(a) == wanted and coder.b.spell(b) == wanted)
    taken = [[x if s else [] for x, s in zip(side, sound, strict=True)] for side in ids]
    n_a, n_b = ([len(x) for x in side] for side in taken)
    a, b = (np.array(list(chain.from_iterable(side)), np.int64) for side in taken)
    none = np.zeros(1, np.int64)
    windows = coder.cut(a, b) if len(a) else Windows(a, b, none, none)
    some, which = windows.distinct()
    first = np.searchsorted(windows.a_at, np.append(0, np.cumsum(n_a)))
    return windows.take(some), [which[i:j] if s else None for i, j, s in zip(first[:-1], first[1:], sound, strict=True)], n_a, n_b


def align_lot(coder: Coder, slices: Iterable[list[str | None]]) -> Lot:
    """Windows of all texts, which come in slices so that no more than one is held as tokens at a time."""
    parts = [_slice(coder, texts) for texts in slices]
    windows = _joined([p[0] for p in parts])
    some, of = windows.distinct()
    before = np.append(0, np.cumsum([len(p[0]) for p in parts]))
    texts = [None if w is None else of[w + n] for p, n in zip(parts, before, strict=False) for w in p[1]]
    every = np.concatenate([w for w in texts if w is not None] or [np.zeros(0, np.int64)])
    counts = np.bincount(every, minlength=len(some))
    order = np.argsort(-counts, kind="stable")
    place = np.argsort(order)
    distinct, counts = windows.take(some[order]), counts[order]
    groups, link_at, links = coder.links(distinct)
    texts = [None if w is None else place[w] for w in texts]
    added = lambda values: np.array([0 if w is None else int(values[w].sum()) for w in texts], np.int64)
    n_a, n_b = (np.array(list(chain.from_iterable(p[k] for p in parts)), np.int64) for k in (2, 3))
    return Lot(texts, distinct, n_a, n_b, added(groups), added(np.diff(link_at)), link_at, links, counts)


def _coder(a_path: str, b_path: str, _open: dict = {}) -> Coder:  # noqa: B006
    """One pair of tokenizers a worker, whichever was asked for last."""
    if (a_path, b_path) not in _open:
        _open.clear()
        _open[a_path, b_path] = Coder(a_path, b_path)
    return _open[a_path, b_path]


# Of a lot's windows: ids of both sides, and how many of them each window has.
_IDS = ("a_ids", "b_ids", "a_sizes", "b_sizes")
_PAIRS = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())]))
_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def packed(values: np.ndarray) -> bytes:
    """Numbers by byte significance: the high bytes, mostly zeros, lie together and compress away."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _rows(lot: Lot, name: str, kept: pa.RecordBatch) -> pa.RecordBatch:
    """A row for each text, and one more with the lot's windows and pairs."""
    pairs, place = np.unique(lot.links, return_inverse=True)
    times = np.bincount(place, np.repeat(lot.counts, np.diff(lot.link_at)), len(pairs)).astype(np.int64)
    found = pa.StructArray.from_arrays(
        [pa.array(x) for x in ((pairs >> 32).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.int32), times)], fields=list(_PAIRS.value_type)
    )
    n, one = kept.num_rows, lot.distinct
    columns = {"lot": pa.array([name] * (n + 1)), "head": pa.array([False] * n + [True])}
    for field, values in zip(kept.schema, kept.columns, strict=True):
        columns[field.name] = pa.concat_arrays([values, pa.nulls(1, field.type)])
    for field in _NUMBERS:
        columns[field] = pa.array([*getattr(lot, field).tolist(), None], pa.int64())
    columns["windows"] = pa.array([None if w is None else packed(w) for w in lot.windows] + [None], pa.binary())
    columns["pairs"] = pa.concat_arrays([pa.nulls(n, _PAIRS), pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), found)])
    for field, values in zip(_IDS, (one.a, one.b, np.diff(one.a_at), np.diff(one.b_at)), strict=True):
        columns[field] = pa.array([None] * n + [packed(values)], pa.binary())
    return pa.record_batch(columns)


def code(docs: DataFrame, keep: tuple[Column, ...] = (), a_path: str = BYTE_BPE, b_path: str = PIECE_BPE) -> DataFrame:
    """The texts as windows, by lots; written to the shared folder."""
    kept = docs.select("doc_id", *keep)
    names = [f"_{i}" for i in range(len(kept.columns))]
    rows = docs.select(*[c.alias(n) for c, n in zip((F.col("doc_id"), *keep), names, strict=True)], F.col("text").alias("text"))
    schema = T.StructType([T.StructField("lot", T.StringType()), T.StructField("head", T.BooleanType())])
    for field, name in zip(kept.schema.fields, names, strict=True):
        schema = schema.add(name, field.dataType)
    for name in _NUMBERS:
        schema = schema.add(name, T.LongType())
    pair = T.StructType().add("a", T.IntegerType()).add("b", T.IntegerType()).add("n", T.LongType())
    schema = schema.add("windows", T.BinaryType()).add("pairs", T.ArrayType(pair))
    for name in _IDS:
        schema = schema.add(name, T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, task = _coder(a_path, b_path), TaskContext.get().partitionId()
        for number, batch in enumerate(batch_pieces(batches, limit=LOT_BYTES)):
            parts = batch_pieces(iter([batch]), limit=SLICE_BYTES)
            lot = align_lot(coder, (part.column("text").to_pylist() for part in parts))
            yield _rows(lot, f"{task}-{number}", batch.select(names))

    return written(rows.mapInArrow(run, schema), "aligned")


def count_pairs(coded: DataFrame) -> DataFrame:
    """Links of each pair of ids in the corpus (``total``), and whether no other A id has more with its B id (``best``)."""
    pairs = coded.where("head").select(F.inline("pairs"))
    totals = written(pairs.groupBy("a", "b").agg(F.sum("n").alias("total")), "pair-totals")
    # A B id has at most as many A ids as the vocabulary.
    most = totals.groupBy("b").agg(F.max("total").alias("most"))
    return written(totals.join(small_side(most), "b").select("a", "b", "total", (F.col("total") == F.col("most")).alias("best")), "pair-counts")


def _summed(coder: Coder, lot: pa.Table, answers: pa.Table) -> tuple[pa.Table, list[str], np.ndarray, np.ndarray]:
    """The lot's texts with group texts, best links and sums of counts."""
    is_head = lot.column("head").to_numpy(zero_copy_only=False).astype(bool)
    head = lot.take(pa.array(np.flatnonzero(is_head)))
    a, b, a_sizes, b_sizes = (unpacked(head.column(name)[0].as_py()) for name in _IDS)
    windows = Windows(a, b, np.append(0, np.cumsum(a_sizes)), np.append(0, np.cumsum(b_sizes)))
    shown = coder.texts(windows)
    _, link_at, links = coder.links(windows)
    pairs = answers.column("a").to_numpy().astype(np.int64) << 32 | answers.column("b").to_numpy()
    order = np.argsort(pairs)
    place = order[np.searchsorted(pairs, links, sorter=order)] if len(links) else links
    best, total = (answers.column(n).to_numpy(zero_copy_only=False).astype(np.int64)[place] for n in ("best", "total"))
    sums = [np.diff(np.append(0, np.cumsum(x))[link_at]) for x in (best, total)]
    docs = lot.take(pa.array(np.flatnonzero(~is_head)))
    groups, n_best, count_sum = [], np.zeros(docs.num_rows, np.int64), np.zeros(docs.num_rows, np.int64)
    for i, raw in enumerate(docs.column("windows").to_pylist()):
        which = unpacked(raw or b"")
        groups.append(";".join(map(shown.__getitem__, which.tolist())))
        n_best[i], count_sum[i] = (int(s[which].sum()) for s in sums)
    return docs, groups, n_best, count_sum


def align(docs: DataFrame, keep: tuple[Column, ...] = (), a_path: str = BYTE_BPE, b_path: str = PIECE_BPE) -> DataFrame:
    """Every text's groups as ``a1,a2|b1;a3|b2`` with its numbers of tokens, groups, links and best links, and the
    sum of its links' counts.  ``keep`` are further columns of ``docs``.
    """
    coded = code(docs, keep, a_path, b_path)
    counts = count_pairs(coded)
    pairs = coded.where("head").select(F.col("lot").alias("of"), F.inline("pairs")).drop("n")
    answers = pairs.join(small_side(counts), ["a", "b"]).select("of", "a", "b", "total", "best")
    kept = docs.select("doc_id", *keep)
    names = [f"_{i}" for i in range(len(kept.columns))]
    schema = T.StructType([*kept.schema.fields])
    for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"):
        schema = schema.add(name, T.LongType())
    schema = schema.add("groups", T.StringType())

    def run(lot: pa.Table, answered: pa.Table) -> pa.Table:
        found, groups, n_best, count_sum = _summed(_coder(a_path, b_path), lot, answered)
        columns = [found.column(n) for n in (*names, *_NUMBERS)]
        return pa.table([*columns, pa.array(n_best), pa.array(count_sum), pa.array(groups, pa.string())], names=schema.names)

    return coded.drop("pairs").groupBy("lot").cogroup(answers.groupBy("of")).applyInArrow(run, schema)


def digest(aligned: DataFrame) -> DataFrame:
    hashed = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    numbers = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    return aligned.select("doc_id", *numbers, hashed.alias("groups_sha256"))
