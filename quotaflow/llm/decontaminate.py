"""Benchmark decontamination: one automaton over all item windows, one scan of each text.

Both sides are normalised alike: A-Z to a-z, every other ASCII character that is
neither letter nor digit to a space, runs of spaces to one.  What is left between
spaces is a word.  A window is ``size`` consecutive words of an item; an item with
fewer words, but at least one, is a single window.  A space is put before and after
each window and each text, so a match always begins and ends at word bounds.

Defined cases: null and empty texts have no words and no hits; a null ``item_id``
is no item; repeated items and windows are one pattern with several owners; an
empty benchmark leaves every document clean.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import pieces, text_bytes, written

WINDOW = 10
# Benchmark text behind one automaton, which takes some 350 bytes for each of it in every worker;
# a larger benchmark is split and scanned part by part.
AUTOMATON_BYTES = 1 << 20
_FORM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_SPACE = 32
SCHEMA = "n_words long, n_hit long, items array<long>, spans array<struct<start:long,end:long>>"


def normalise(text: bytes) -> bytes:
    """One space around every word; empty if there is none."""
    found = text.translate(_FORM).split()
    return b" " + b" ".join(found) + b" " if found else b""


def patterns(items: Iterator[tuple[int, bytes]], size: int) -> dict[bytes, list[int]]:
    """Window -> ids of the items that contain it."""
    owners: dict[bytes, set[int]] = {}
    for item, text in items:
        found = text.translate(_FORM).split()
        for i in range(max(1, len(found) - size + 1) if found else 0):
            owners.setdefault(b" " + b" ".join(found[i : i + size]) + b" ", set()).add(item)
    return {w: sorted(ids) for w, ids in owners.items()}


def build(owners: dict[bytes, list[int]]) -> ahocorasick.Automaton | None:
    """The automaton works on bytes, carried as Latin-1 characters."""
    if not owners:
        return None
    machine = ahocorasick.Automaton()
    for window, ids in owners.items():
        machine.add_word(window.decode("latin-1"), (window.count(b" ") - 1, ids))
    machine.make_automaton()
    return machine


def scan(text: bytes, machine: ahocorasick.Automaton | None) -> tuple[int, int, list[int], list[dict]]:
    """Words, hit words, items found and hit spans as byte offsets of the original text."""
    form = normalise(text)
    n_words = max(0, form.count(b" ") - 1)
    found = list(machine.iter(form.decode("latin-1"))) if machine is not None and n_words else []
    if not found:
        return n_words, 0, [], []
    spaces = np.flatnonzero(np.frombuffer(form, np.uint8) == _SPACE)
    last = np.searchsorted(spaces, np.array([end for end, _ in found]))  # the space that ends the match
    change = np.zeros(n_words + 1, np.int64)
    np.add.at(change, last - np.array([size for _, (size, _) in found]), 1)
    np.add.at(change, last, -1)
    hit = np.cumsum(change[:-1]) > 0
    # Words keep their order under normalisation, so the i-th word is the i-th run of word bytes.
    solid = np.frombuffer(text.translate(_FORM), np.uint8) != _SPACE
    edge = np.diff(np.concatenate([[0], solid.astype(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    runs = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    spans = [
        {"start": int(begin[a]), "end": int(end[b - 1])}
        for a, b in zip(np.flatnonzero(runs == 1), np.flatnonzero(runs == -1), strict=True)
    ]
    items = sorted({i for _, (_, ids) in found for i in ids})
    return n_words, int(hit.sum()), items, spans


def _merge(parts: list[tuple[int, int, list[int], list[dict]]], text: bytes):
    """Results of several automata over one text as one."""
    solid = np.frombuffer(text.translate(_FORM), np.uint8) != _SPACE
    mark = np.zeros(len(text) + 1, np.int64)
    for part in parts:
        for s in part[3]:
            mark[s["start"]] += 1
            mark[s["end"]] -= 1
    inside = np.cumsum(mark[:-1]) > 0 if len(text) else np.zeros(0, bool)
    begin = solid & ~np.concatenate([[False], solid[:-1]]) if len(text) else solid
    edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    spans = [
        {"start": int(a), "end": int(b)}
        for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)
    ]
    return parts[0][0], int((begin & inside).sum()), sorted({i for p in parts for i in p[2]}), spans


def _share(benchmark: DataFrame, limit: int) -> Iterator[list[tuple[int, bytes]]]:
    """The items in blocks of at most ``limit`` bytes (or one item, if it is longer); the driver holds one at a time."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("binary")).dropna()
    block, size = [], 0
    for row in items.toLocalIterator():
        if block and size + len(row[1]) > limit:
            yield block
            block, size = [], 0
        block.append((row[0], bytes(row[1])))
        size += len(row[1])
    yield block


# The automaton of the last share that this worker scanned against, by the name of the share.
_built: dict[str, ahocorasick.Automaton | None] = {}


def _machine(name: str, share: Broadcast, size: int) -> ahocorasick.Automaton | None:
    if name not in _built:
        _built.clear()
        _built[name] = build(patterns(iter(share.value), size))
    return _built[name]


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, keep: tuple[str, ...] = (), limit: int = AUTOMATON_BYTES
) -> DataFrame:
    """One row per document: ``doc_id``, the columns of ``keep``, words, hit words, items, hit spans (byte offsets).

    The documents are scanned where they are, without a shuffle.  A benchmark of more than
    ``limit`` bytes is scanned share by share, with one automaton in a worker at a time: the
    documents with what is found so far are written once per further share, when this is called.
    """
    chosen = docs.select("doc_id", "text", *[c for c in keep if c not in ("doc_id", "text")])
    wanted = [f.name for f in chosen.schema.fields if f.name in ("doc_id", *keep)]
    found, context = chosen, docs.sparkSession.sparkContext
    blocks = _share(benchmark.select("item_id", "text"), limit)
    block, is_first = next(blocks), True
    while block is not None:
        after = next(blocks, None)
        found = _pass(found, context.broadcast(block), size, chosen.schema.fields if after is not None else [chosen.schema[n] for n in wanted], is_first)
        if after is not None:
            found = written(found, "leaks")
        block, is_first = after, False
    return found


def _pass(docs: DataFrame, share: Broadcast, size: int, fields: list, is_first: bool) -> DataFrame:
    """``fields`` and what is found in one share, merged with what the columns of ``docs`` have of earlier ones."""
    name = uuid.uuid4().hex
    names = [f.name for f in fields]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), SCHEMA])
    kinds = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    told = ["n_words", "n_hit", "items", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _machine(name, share, size)
        for batch in pieces(batches):
            texts = text_bytes(batch.column("text"))
            rows = [scan(t, machine) for t in texts]
            if not is_first:
                earlier = zip(*(batch.column(c).to_pylist() for c in told), strict=True)
                rows = [_merge([e, r], t) for e, r, t in zip(earlier, rows, texts, strict=True)]
            columns = [batch.column(n) for n in names]
            columns += [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.list_(pa.int64())),
                pa.array([r[3] for r in rows], pa.list_(kinds)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*names, *told])

    return docs.mapInArrow(run, schema)


def digest(found: DataFrame) -> DataFrame:
    """The result with the items as a count and as a hash of their ids, sorted as strings."""
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
