"""Substring dedup: passages that occur in a document with a smaller id are removed.

A window is ``size`` consecutive words of a document.  Each word covered by a window whose
word sequence also starts in a document with a smaller id is removed; windows are judged
on the input.

Fixed-block anchors: the index holds every document's non-overlapping blocks of half a
window, and every rolling half-window of every document probes it.  Any two equal windows
share a block of one with a probe of the other, so none is missed.  Around the anchors
that are met elsewhere, hits are extended to whole windows by comparing 64-bit hashes of
``size`` words, and overlapping windows join to maximal repeats.

The texts are shuffled once, to chunks; each of the three steps over them reads that same
shuffle.  Buckets answer chunks with hashes (see ``chunks``), so a passage that very many
documents share costs one entry per chunk.

Defined cases: null and empty texts have no words; a null id is neither smaller nor
larger than another, so nothing is removed from or because of it; rows with equal ids
do not remove from each other; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks, scan
from .base import text_bytes

WINDOW = 50
U64 = np.uint64
_SIGN = U64(1 << 63)
PACKED = "bucket int, chunk int, hashes binary, ids binary, marks binary"
_NAMES = ["bucket", "chunk", "hashes", "ids", "marks"]
_TYPES = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]


def _packed(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(_NAMES)
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES)


def _words(group: pa.Table) -> scan.Words:
    return scan.words(chunks.texts_of(group))


def _ids(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids as unsigned numbers in the same order, and whether they are there."""
    ids = chunks.texts_of(group, "doc_id")
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    return ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(U64) ^ _SIGN, known


def _anchors(group: pa.Table, size: int, buckets: int) -> pa.Table:
    """Blocks and probes of a chunk: distinct hashes, whether one is a block, whether it occurs twice."""
    half, found = size // 2, _words(group)
    place = np.arange(len(found.hashes)) - found.first[:-1][found.doc]
    use = scan.inside(found, half) & (found.counts >= size)[found.doc]
    hashes, block = scan.windows(found, half)[use], (place % half == 0)[use]
    order = np.argsort(hashes, kind="stable")
    hashes, block = hashes[order], block[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
    if not len(first):
        return _packed([])
    twice = np.diff(np.append(first, len(hashes))) > 1
    is_block, hashes = np.logical_or.reduceat(block, first), hashes[first]
    chunk = group.column("chunk")[0].as_py()
    return _packed(
        [
            (b, chunk, chunks.short(hashes[i:j]), chunks.bits(is_block[i:j]), chunks.bits(twice[i:j]))
            for b, i, j in chunks.slices(chunks.bucket_of(hashes, buckets))
        ]
    )


def _met(group: pa.Table) -> pa.Table:
    """Anchors of a bucket that occur more than once and at least once as a block, for each chunk that has them."""
    rows = group.to_pylist()
    keys = [chunks.from_short(r["hashes"]) for r in rows]
    block = [chunks.from_bits(r["ids"], len(k)) for r, k in zip(rows, keys, strict=True)]
    twice = [chunks.from_bits(r["marks"], len(k)) for r, k in zip(rows, keys, strict=True)]
    _, at = np.unique(np.concatenate(keys), return_inverse=True)
    times = np.bincount(at, 1 + np.concatenate(twice))
    met = ((times > 1) & (np.bincount(at, np.concatenate(block)) > 0))[at]
    out, i = [], 0
    for r, k in zip(rows, keys, strict=True):
        mine = met[i : i + len(k)]
        i += len(k)
        if mine.any():
            out.append((r["bucket"], r["chunk"], chunks.short(k[mine]), b"", b""))
    return _packed(out)


def _extend(group: pa.Table, answers: pa.Table, size: int, buckets: int) -> pa.Table:
    """Hashes of the whole windows around met anchors, with the smallest id they start in here."""
    if not group.num_rows or not answers.num_rows:
        return _packed([])
    half, found = size // 2, _words(group)
    ids, known = _ids(group)
    met = np.sort(np.concatenate([chunks.answered(r["bucket"], r["hashes"]) for r in answers.to_pylist()]))
    hit = scan.inside(found, half) & chunks.find(chunks.keys_of(scan.windows(found, half), buckets), met)[1]
    sums = np.concatenate([[0], np.cumsum(hit), np.full(half + 1, hit.sum())])
    near = sums[half + 1 : half + 1 + len(hit)] > sums[: len(hit)]
    use = near & scan.inside(found, size) & known[found.doc]
    hashes, owner = scan.windows(found, size)[use], ids[found.doc[use]]
    if not len(hashes):
        return _packed([])
    order = np.lexsort((owner, hashes))
    hashes, owner = hashes[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    last = np.append(first[1:], len(hashes)) - 1
    several = owner[first] != owner[last]
    hashes, least = hashes[first], owner[first]
    chunk = group.column("chunk")[0].as_py()
    return _packed(
        [
            (b, chunk, scan.planes(hashes[i:j]), scan.planes(least[i:j]), chunks.bits(several[i:j]))
            for b, i, j in chunks.slices(chunks.bucket_of(hashes, buckets))
        ]
    )


def _least(group: pa.Table) -> pa.Table:
    """The smallest id of each window of a bucket, for the chunks that have it in a larger one."""
    rows = group.to_pylist()
    hashes = [scan.from_planes(r["hashes"]) for r in rows]
    owner = np.concatenate([scan.from_planes(r["ids"]) for r in rows])
    several = np.concatenate([chunks.from_bits(r["marks"], len(h)) for r, h in zip(rows, hashes, strict=True)])
    every, at = np.unique(np.concatenate(hashes), return_inverse=True)
    least = np.full(len(every), ~U64(0))
    np.minimum.at(least, at, owner)
    wanted = (least[at] < owner) | several
    out, i = [], 0
    for r, h in zip(rows, hashes, strict=True):
        mine = wanted[i : i + len(h)]
        if mine.any():
            out.append((r["bucket"], r["chunk"], scan.planes(h[mine]), scan.planes(least[at[i : i + len(h)]][mine]), b""))
        i += len(h)
    return _packed(out)


def _remove(group: pa.Table, answers: pa.Table, size: int, names: list[str]) -> pa.Table:
    """Rows of a chunk with the words of repeated windows taken out."""
    found = _words(group)
    ids, known = _ids(group)
    gone = np.zeros(len(found.hashes), bool)
    if answers.num_rows:
        rows = answers.to_pylist()
        hashes = np.concatenate([scan.from_planes(r["hashes"]) for r in rows])
        least = np.concatenate([scan.from_planes(r["ids"]) for r in rows])
        order = np.argsort(hashes)
        at, there = chunks.find(scan.windows(found, size), hashes[order])
        earlier = there & scan.inside(found, size) & known[found.doc]
        earlier &= least[order][at] < ids[found.doc]
        gone = scan.covered(np.flatnonzero(earlier), size, len(found.hashes))
    removed = np.bincount(found.doc, gone, group.num_rows).astype(np.int64)
    kept = []
    for i, text in enumerate(text_bytes(chunks.texts_of(group))):
        parts = text.split()
        if removed[i]:
            parts = compress(parts, ~gone[found.first[i] : found.first[i + 1]])
        kept.append(b" ".join(parts))
    columns = [chunks.texts_of(group, n) for n in names]
    columns += [pa.array(found.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
    return pa.Table.from_arrays(columns, [*names, "n_words", "n_removed", "kept_text"])


def remove_repeats(docs: DataFrame, size: int = WINDOW, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``doc_id``, the columns of ``keep``, ``n_words``, ``n_removed``, ``kept_text`` (kept words, one space between).

    Reads the sizes of the texts first, which starts a job.
    """
    n_chunks, n_buckets = chunks.sizes(docs)
    names = ["doc_id", *(c for c in keep if c != "doc_id")]
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[c for c in names[1:]], *([] if "text" in names else ["text"]))
    dealt = chosen.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)).cast("int").alias("chunk"), *chosen.columns)
    by_chunk = lambda df: df.groupBy("chunk")
    anchors = by_chunk(dealt).applyInArrow(lambda g: _anchors(g, size, n_buckets), PACKED)
    met = anchors.groupBy("bucket").applyInArrow(_met, PACKED)
    whole = by_chunk(dealt).cogroup(by_chunk(met)).applyInArrow(lambda g, a: _extend(g, a, size, n_buckets), PACKED)
    least = whole.groupBy("bucket").applyInArrow(_least, PACKED)
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields if f.name in names]
    schema = ", ".join([*kinds, "n_words long, n_removed long, kept_text string"])
    order = [f.name for f in chosen.schema.fields if f.name in names]
    return by_chunk(dealt).cogroup(by_chunk(least)).applyInArrow(lambda g, a: _remove(g, a, size, order), schema)


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
