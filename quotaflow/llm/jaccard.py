"""N-gram Jaccard join by T-occurrence search (DivideSkip), and the groups its links form.

A document's set are the distinct ``size``-word shingles of its A-Z lower-cased words; fewer
words are one shingle, no words none.  Two documents link when ``100 * |A & B| >= percent * |A | B|``.

1. Equal sets are one class, represented by its document with the smallest id.
2. The length of every shingle's inverted list is counted over the representatives, by
   chunks and buckets.  Whoever links with a set of ``s`` shingles shares ``T = ceil(s * percent / 100)``
   of them, so a class with fewer than T shingles of lists longer than one is out: texts
   like no other leave here, and no list of theirs is built.
3. Divide: of the lists in ascending length, the ``T - 1`` longest are set aside and the
   ``s - T + 1`` short ones stay.  Linked classes meet in a short list (both order lists
   alike).  Every list names a hub, every class joins the hub most of its short lists name.
4. Skip: a hub's group is searched together.  Everyone is compared with the hub; for each
   class not linked to it the short lists are merged, what reaches the count they must
   give is probed by binary search in the long ones, and what reaches the overlap links.
   Classes already connected are not compared again.
5. Short lists whose classes are still in different components join these into fields.
   The classes of a field are searched in the same way, block against block, so no link
   between components is missed; pairs are compared inside a task, not sent as rows.

Groups and fields larger than ``GROUP`` are dealt by hash: of a group the hub goes to each
part, and step 5 covers pairs that the parts separate; of a field every part meets every
other.  Step results are written to the shared folder.

Defined cases: null and empty texts have an empty set and link with nothing; a null id
has a null component and links with nothing; rows with equal ids are compared like
others, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks, scan
from .base import pieces, written
from .components import components

SIZE = 5
PERCENT = 80
GROUP = 400
U64 = np.uint64


def shingles(found: scan.Words, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending: (text, hash)."""
    full = scan.inside(found, size)
    brief = np.flatnonzero((found.counts > 0) & (found.counts < size))
    doc = np.concatenate([found.doc[full], brief])
    hashes = np.concatenate([scan.windows(found, size)[full], scan.whole(found)[brief]])
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return doc[new], hashes[new]


def classes_of(doc: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Set size and a hash of the set for each of ``n`` texts."""
    count = np.bincount(doc, minlength=n).astype(np.int64)
    ends = np.cumsum(count)
    sums = np.zeros((2, len(hashes) + 1), U64)
    np.cumsum(scan.mix(hashes), out=sums[0, 1:])
    np.cumsum(scan.mix(hashes * U64(0xD6E8FEB86659FD93) + U64(1)), out=sums[1, 1:])
    a, b = sums[:, ends] - sums[:, ends - count]
    return count, scan.mix(scan.mix(a) ^ (b * U64(0x9E3779B97F4A7C15)) ^ count.astype(U64)).view(np.int64)


def least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap with which a set of n can link at all."""
    return -(-n * percent // 100)


def links(overlap, n, m, percent: int):
    """100 * |A & B| >= percent * |A | B|"""
    return 100 * overlap >= percent * (n + m - overlap)


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        found = scan.words(batch.column("text"), lower=True)
        count, cls = classes_of(*shingles(found, size), batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(count), pa.array(cls), batch.column("text_hash")], ["doc_id", "n_shingles", "class", "text_hash"])


def _representatives(group: pa.Table, reps: pa.Table, size: int):
    """The shingles of the classes this chunk represents: class, and (place of the class, hash) ascending."""
    if not group.num_rows or not reps.num_rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64)
    doc, hashes = shingles(scan.words(chunks.texts_of(group), lower=True), size)
    _, cls = classes_of(doc, hashes, group.num_rows)
    ids = chunks.texts_of(group, "doc_id").to_numpy(zero_copy_only=False)
    wanted = set(zip(reps.column("class").to_pylist(), reps.column("doc_id").to_pylist(), strict=True))
    place = np.full(group.num_rows, -1)
    chosen = []
    for i, key in enumerate(zip(cls.tolist(), ids.tolist(), strict=True)):
        if key in wanted:
            wanted.discard(key)
            place[i] = len(chosen)
            chosen.append(key[0])
    mine = place[doc] >= 0
    return np.array(chosen, np.int64), place[doc[mine]], hashes[mine]


LISTS = "bucket int, chunk int, hashes binary, counts binary"
_NAMES, _TYPES = ["bucket", "chunk", "hashes", "counts"], [pa.int32(), pa.int32(), pa.binary(), pa.binary()]


def _lists(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES)


def _occurrences(group: pa.Table, reps: pa.Table, size: int, buckets: int) -> pa.Table:
    _, _, hashes = _representatives(group, reps, size)
    if not len(hashes):
        return _lists([])
    every, count = np.unique(hashes, return_counts=True)
    chunk = group.column("chunk")[0].as_py()
    return _lists(
        [
            (b, chunk, chunks.short(every[i:j]), count[i:j].astype("<u4").tobytes())
            for b, i, j in chunks.slices(chunks.bucket_of(every, buckets))
        ]
    )


def _lengths(group: pa.Table) -> pa.Table:
    """List lengths above one, for the chunks that have the shingle."""
    rows = group.to_pylist()
    keys = [chunks.from_short(r["hashes"]) for r in rows]
    counts = np.concatenate([np.frombuffer(r["counts"], "<u4") for r in rows])
    _, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(at, counts)[at]
    out, i = [], 0
    for r, k in zip(rows, keys, strict=True):
        mine = total[i : i + len(k)]
        i += len(k)
        if (mine > 1).any():
            lengths = np.minimum(mine[mine > 1], 0xFFFFFFFF).astype("<u4")
            out.append((r["bucket"], r["chunk"], chunks.short(k[mine > 1]), lengths.tobytes()))
    return _lists(out)


CANDIDATES = "class long, n int, shingles binary, short array<long>"


def _divide(group: pa.Table, told: pa.Table, size: int, buckets: int, percent: int) -> pa.Table:
    """Classes that can link at all, with their shingles and those of their short lists."""
    reps = told.filter(pc.is_valid(told.column("class")))
    answers = told.filter(pc.is_null(told.column("class"))).to_pylist()
    cls, place, hashes = _representatives(group, reps, size)
    out = []
    if len(cls) and answers:
        keys = np.concatenate([chunks.answered(r["bucket"], r["hashes"]) for r in answers])
        lengths = np.concatenate([np.frombuffer(r["counts"], "<u4") for r in answers]).astype(np.int64)
        order = np.argsort(keys)
        at, there = chunks.find(chunks.keys_of(hashes, buckets), keys[order])
        length = np.where(there, lengths[order][at], 1)
        n = np.bincount(place, minlength=len(cls))
        least = least_overlap(n, percent)
        begin = np.concatenate([[0], np.cumsum(n)])
        for i in np.flatnonzero(np.bincount(place, length > 1, len(cls)) >= least):
            own, of = hashes[begin[i] : begin[i + 1]], length[begin[i] : begin[i + 1]]
            ascending = np.lexsort((own, of))[: n[i] - least[i] + 1]
            ascending = ascending[of[ascending] > 1]
            if len(ascending):
                out.append((int(cls[i]), int(n[i]), own.astype("<u8").tobytes(), own[ascending].view(np.int64)))
    columns = list(zip(*out, strict=True)) or [(), (), (), ()]
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64())]
    return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], ["class", "n", "shingles", "short"])


class _Parts:
    """Which places are known to be connected."""

    def __init__(self, labels):
        first: dict = {}
        self.parent = [first.setdefault(x, i) for i, x in enumerate(labels)]

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.parent[a] = b
        return a != b


def search(sets: list[np.ndarray], percent: int = PERCENT, hub: int | None = None, labels=None, side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect the sets as all links would, as pairs of places.

    ``labels`` are equal where sets are connected already.  With ``side`` only sets of
    different sides are compared.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    parts, found = _Parts(labels if labels is not None else range(n)), []
    side = np.zeros(n, np.int64) if side is None else side
    across = bool(side.any())
    with_hub = np.zeros(n, bool)
    if hub is not None:
        overlap = np.bincount(owner, chunks.find(flat, sets[hub])[1], n).astype(np.int64)
        with_hub = links(overlap, sizes, sizes[hub], percent)
        found = [(hub, int(i)) for i in np.flatnonzero(with_hub) if parts.join(int(i), hub)]
    queries = [int(i) for i in np.flatnonzero(side == 0 if across else ~with_hub)]
    # Inverted lists; their members ascend.
    order = np.lexsort((owner, flat))
    values, first, length = np.unique(flat[order], return_index=True, return_counts=True)
    members = owner[order]
    # A pair of two queries is looked at once, from the later one; any other from its query.
    open_to = side == 1 if across else with_hub.copy()
    for q in queries:
        if not across:
            open_to[q] = True
        mine = parts.root(q)
        other = np.fromiter((parts.root(i) != mine for i in range(n)), bool, n) & open_to
        if not other.any():
            continue
        least = int(least_overlap(sizes[q], percent))
        at = np.searchsorted(values, sets[q])
        at = at[np.argsort(length[at], kind="stable")]
        at = at[length[at] > 1]
        if len(at) < least:
            continue
        # Divide: more lists are set aside the longer they are, at most one less than the overlap.
        aside = min(least - 1, int(least / (0.01 * np.log(max(2, length[at[-1]])) + 1)))
        brief, long = at[: len(at) - aside], at[len(at) - aside :]
        merged = np.bincount(np.concatenate([members[first[k] : first[k] + length[k]] for k in brief]), minlength=n)
        who = np.flatnonzero((merged >= least - aside) & other)
        count = merged[who]
        for left, k in zip(range(len(long), 0, -1), long, strict=True):
            fit = count + left >= least
            who, count = who[fit], count[fit]
            if not len(who):
                break
            count = count + chunks.find(who, members[first[k] : first[k] + length[k]])[1]
        for c in who[links(count, sizes[q], sizes[who], percent)]:
            if parts.join(q, int(c)):
                found.append((q, int(c)))
    return found


LINKS = "a long, b long"


def _found(names: list[int], pairs: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([names[i] for i, _ in pairs], pa.int64()), "b": pa.array([names[j] for _, j in pairs], pa.int64())})


def _sets_of(rows: list[dict]) -> list[np.ndarray]:
    return [np.frombuffer(r["shingles"], "<u8").astype(U64) for r in rows]


def _group_links(group: pa.Table, percent: int) -> pa.Table:
    """Links of a hub's group."""
    rows = group.to_pylist()
    hub = next((i for i, r in enumerate(rows) if r["class"] == r["hub"]), None)
    return _found([r["class"] for r in rows], search(_sets_of(rows), percent, hub) if len(rows) > 1 else [])


def _block_links(group: pa.Table, percent: int) -> pa.Table:
    """Links of a block of a field with itself or with another."""
    rows = group.to_pylist()
    if len({r["c"] for r in rows}) < 2:
        return _found([], [])
    side = np.array([r["side"] for r in rows])
    if rows[0]["lo"] != rows[0]["hi"] and len(set(side.tolist())) < 2:
        return _found([], [])
    return _found([r["class"] for r in rows], search(_sets_of(rows), percent, None, [r["c"] for r in rows], side))


def _candidates(docs: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """Steps 1 to 3: the classes that can link at all."""
    n_chunks, n_buckets = chunks.sizes(docs)
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(n_chunks)).cast("int").alias("chunk")
    dealt = docs.select(chunk, "doc_id", "text").groupBy("chunk")
    reps = sets.where("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("doc_id")).select(chunk, "class", "doc_id")
    counted = dealt.cogroup(reps.groupBy("chunk")).applyInArrow(lambda g, r: _occurrences(g, r, size, n_buckets), LISTS)
    lengths = counted.groupBy("bucket").applyInArrow(_lengths, LISTS)
    told = lengths.select("chunk", F.lit(None).cast("long").alias("class"), F.lit(None).cast("long").alias("doc_id"), "bucket", "hashes", "counts").unionByName(
        reps.select("chunk", "class", "doc_id"), allowMissingColumns=True
    )
    return dealt.cogroup(told.groupBy("chunk")).applyInArrow(lambda g, t: _divide(g, t, size, n_buckets, percent), CANDIDATES)


def _hub_groups(candidates: DataFrame, postings: DataFrame) -> DataFrame:
    """Every class under the hub most of its short lists name, in parts of about ``GROUP``; the hub in each part."""
    hubs = postings.groupBy("h").agg(F.min("class").alias("hub"), F.count(F.lit(1)).alias("k")).where("k > 1").select("h", "hub")
    votes = postings.join(hubs, "h").where("class <> hub").groupBy("class", "hub").agg(F.count(F.lit(1)).alias("votes"))
    joined = votes.groupBy("class").agg(F.max(F.struct("votes", F.negative("hub").alias("order"), "hub")).alias("best")).select("class", "best.hub")
    parts = joined.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("parts"))
    members = joined.join(parts, "hub").select("hub", F.pmod(F.xxhash64("class"), "parts").cast("int").alias("part"), "class")
    centres = parts.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("hub").alias("class"))
    return members.unionByName(centres).join(candidates.select("class", "shingles"), "class")


def _fields(candidates: DataFrame, placed: DataFrame) -> DataFrame:
    """Classes of torn short lists by field and pair of blocks; placed: class, short list ``h``, component ``c``."""
    torn = placed.groupBy("h").agg(F.min("c").alias("least"), F.max("c").alias("most")).where("least <> most").select("h", "least")
    opened = written(placed.join(torn, "h").select("class", "c", "least").distinct(), "torn-lists")
    fields = components(opened.where("c <> least").select(F.col("c").alias("a"), F.col("least").alias("b")))
    members = opened.select("class", "c").distinct().join(fields.select(F.col("node").alias("c"), F.col("least").alias("field")), "c")
    parts = members.groupBy("field").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("parts"))
    dealt = members.join(parts, "field").withColumn("part", F.pmod(F.xxhash64("class"), "parts").cast("int"))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    blocks = met.select(
        "field", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), (F.col("part") > F.col("other")).cast("int").alias("side"), "class", "c"
    )
    return blocks.join(candidates.select("class", "shingles"), "class")


def join(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, detail: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest id its links reach, its own included).

    Where ids occur more than once, ``detail`` tells rows and components apart: ``text_hash`` (``xxhash64`` of the
    text), and ``component``, a number of each set of linked documents, null for one that is linked with nothing for want of words.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    sets = written(docs.mapInArrow(lambda b: _sets(b, size), "doc_id long, n_shingles long, class long, text_hash long"), "sets")
    docs = docs.select("doc_id", "text")
    known = docs.where("doc_id IS NOT NULL")
    candidates = written(_candidates(known, sets.where("doc_id IS NOT NULL"), size, percent), "candidates")
    postings = candidates.select("class", F.explode("short").alias("h"))
    groups = _hub_groups(candidates, postings)
    first = written(groups.groupBy("hub", "part").applyInArrow(lambda g: _group_links(g, percent), LINKS), "hub-links")
    reached = written(components(first), "components")
    placed = postings.join(reached.withColumnRenamed("node", "class"), "class", "left").select("class", "h", F.coalesce("least", "class").alias("c"))
    second = written(_fields(candidates, placed).groupBy("field", "lo", "hi").applyInArrow(lambda g: _block_links(g, percent), LINKS), "block-links")
    # The components found so far, as stars, stand for the links that made them.
    stars = reached.select(F.col("node").alias("a"), F.col("least").alias("b"))
    reached = components(stars.unionByName(second))
    classes = sets.where("doc_id IS NOT NULL AND n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("doc"))
    placed = classes.join(reached.withColumnRenamed("node", "class"), "class", "left").select("class", "doc", F.coalesce("least", "class").alias("c"))
    named = placed.join(placed.groupBy("c").agg(F.min("doc").alias("component_id")), "c").select("class", "component_id", F.col("c").alias("component"))
    return sets.join(named, "class", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))).alias("component_id"),
        *(["text_hash", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("component")).alias("component")] if detail else []),
    )
