"""Language-model scores of documents.

Words are lower-cased (A-Z) runs of non-blanks, and every text ends with an end token.  A word is a
sequence of subword ids of a public byte-level vocabulary; an id and whether it ends the
word are a type.

``P(word | before) = P(k | before) * ((1 - b) * c / N_k + b * R)``

``k`` is the class of the word's first type and ``P(k | before)`` the attention network's
probability for it; ``c`` is the word's count in the training documents and ``N_k`` that of all
words whose first type is in ``k``; ``R`` spells the word: the first type in its class by corpus
counts, then each further type's class by the network and the type in it by counts.
``b`` is the share of the mass that absolute discounting by ``DISCOUNT`` would free, ``DISCOUNT *
V / N``.  Both parts are distributions over the words of a class.

Word and type counts cover every training document and grow with it: a chunk sends its
distinct words (as 64-bit hashes) with their counts to buckets, and gets the sums back for
its words.  The classes come from the neighbours that types have in all training documents.
The network starts from a bounded sample (``SAMPLE_DOCS`` documents); from there every task
trains it on all tokens of its training documents, and the weights of the tasks are averaged by
their tokens, so the last digits of a score depend on how the rows are dealt to the tasks.

Defined cases: a null text is empty: its only token is the end.  A null id is never held
out and not learnt from.  Repeated rows count as often as they occur.  Without training
documents every count is 0 and the network is untrained.
"""

from __future__ import annotations

import base64
import copy
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import attention, chunks, scan
from .base import pieces, written

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SAMPLE_DOCS = 800
SAMPLE_TOKENS = 320
# Words whose types a worker keeps, and a fourth of the types it keeps.
KEPT_WORDS = 1 << 19
DISCOUNT, SMOOTH = 0.75, 0.1
U64 = np.uint64
END_WORD = U64(0x656E642D746F6B65)
_FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def read_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """Byte strings by id."""
    rows = (line.split() for line in Path(path).read_bytes().splitlines())
    return [base64.b64decode(token) for token, _ in sorted(rows, key=lambda r: int(r[1]))]


class Subwords:
    """Types of words: twice the id, and one more where it ends the word."""

    def __init__(self, vocabulary: list[bytes]):
        ranks = {token: i for i, token in enumerate(vocabulary)}
        # No word holds a line feed, so one call cuts many words, a line feed between each two.
        self.encoder = tiktoken.Encoding("words", pat_str=r"[^\n]+|\n", mergeable_ranks=ranks, special_tokens={})
        self.between = ranks[b"\n"]
        self.end = 2 * len(vocabulary) + 1
        self.n_types = self.end + 1
        self._forget()

    def _forget(self) -> None:
        self.known, self.begin, self.length, self.types = np.zeros(0, U64), np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def of(self, found: scan.Words, hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``cut``, of the words at ``at`` of ``found`` with these ascending hashes; words of earlier calls are not cut again."""
        if len(self.known) > KEPT_WORDS or len(self.types) > 4 * KEPT_WORDS:
            self._forget()
        place, there = chunks.find(hashes, self.known)
        if not there.all():
            new = np.flatnonzero(~there)
            types, length = self.cut(_word_bytes(found, at[new]))
            before = np.searchsorted(self.known, hashes[new])
            self.begin = np.insert(self.begin, before, len(self.types) + np.cumsum(length) - length)
            self.length = np.insert(self.length, before, length)
            self.known = np.insert(self.known, before, hashes[new])
            self.types = np.append(self.types, types.astype(np.int32))
            place = np.searchsorted(self.known, hashes)
        length = self.length[place]
        return self.types[_spread(self.begin[place], length)], length

    def cut(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The types of the words one after the other, and the number of each."""
        ids = np.array(self.encoder.encode_ordinary(b"\n".join(words).decode("utf-8", "replace")), np.int64)
        last = np.append(np.flatnonzero(ids == self.between), len(ids))[: len(words)]
        inner = np.ones(len(ids), bool)
        inner[last[:-1]] = False
        types = 2 * ids
        types[last - 1] += 1
        return types[inner], np.diff(last, prepend=-1) - 1


def _spread(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """``begin``, ``begin + 1`` ... of each run, one run after the other."""
    ends = np.cumsum(length)
    out = np.repeat((begin - ends + length).astype(np.int32), length)
    out += np.arange(len(out), dtype=np.int32)
    return out


_open: dict[str, Subwords] = {}


def _subwords(share) -> Subwords:
    """The tokenizer of this worker; ``share`` is the name and the broadcast of its vocabulary."""
    name, vocabulary = share
    if name not in _open:
        _open.clear()
        _open[name] = Subwords(vocabulary.value)
    return _open[name]


def _word_bytes(found: scan.Words, at: np.ndarray) -> list[bytes]:
    data = found.data.tobytes().translate(_FOLD)
    return [data[a:b] for a, b in zip(found.begin[at].tolist(), found.end[at].tolist(), strict=True)]


COUNTS = "bucket int, chunk int, hashes binary, counts binary, types array<int>, times array<long>"
_NAMES = ["bucket", "chunk", "hashes", "counts", "types", "times"]
_TYPES = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64())]


def _rows(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(_NAMES)
    return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES)


def _learnt(group: pa.Table) -> np.ndarray:
    return chunks.texts_of(group, "learn").fill_null(False).to_numpy(zero_copy_only=False).astype(bool)


def _count(group: pa.Table, share, buckets: int) -> pa.Table:
    """Distinct words of a chunk with their training counts, and the training counts of types."""
    found, learn = scan.words(chunks.texts_of(group), lower=True), _learnt(group)
    every, first, at = scan.distinct(found.hashes)
    count = np.bincount(at, learn[found.doc], len(every)).astype(np.int64) if len(every) else np.zeros(0, np.int64)
    chunk, tokens = group.column("chunk")[0].as_py(), _subwords(share)
    seen = np.flatnonzero(count)
    types, length = tokens.of(found, every[seen], first[seen])
    total = np.bincount(np.append(types, tokens.end), np.append(np.repeat(count[seen], length), learn.sum()), tokens.n_types)
    # The counts of types as the first of a word follow those of all.
    heads = types[np.cumsum(length) - length]
    starts = np.bincount(np.append(heads, tokens.end), np.append(count[seen], learn.sum()), tokens.n_types)
    total = np.concatenate([total, starts])
    used = np.flatnonzero(total)
    rows = [
        (b, chunk, scan.planes(every[i:j]), scan.planes(count[i:j]), None, None)
        for b, i, j in chunks.slices(chunks.bucket_of(every, buckets))
    ]
    ends = (int(chunks.bucket_of(np.array([END_WORD]), buckets)[0]), chunk, scan.planes(np.array([END_WORD])), scan.planes(np.array([learn.sum()])), used, total[used].astype(np.int64))
    return _rows([*rows, ends])


def _sum(group: pa.Table) -> pa.Table:
    """Training counts over all chunks, for each chunk; the bucket's tokens and distinct words under chunk null."""
    rows = group.select(["bucket", "chunk", "hashes", "counts"]).to_pylist()
    hashes = [scan.from_planes(r["hashes"]) for r in rows]
    every, at = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(at, np.concatenate([scan.from_planes(r["counts"]) for r in rows]).astype(np.float64), len(every))
    out, i = [], 0
    for r, h in zip(rows, hashes, strict=True):
        out.append((r["bucket"], r["chunk"], r["hashes"], scan.planes(total[at[i : i + len(h)]].astype(np.int64)), None, None))
        i += len(h)
    out.append((rows[0]["bucket"], None, None, None, None, [int(total.sum()), int((total > 0).sum())]))
    return _rows(out)


SCORES = "n_tokens long, n_known long, base_score double, score double"


def _score(group: pa.Table, told: pa.Table, share, model, names: list[str], n: int, v: int) -> pa.Table:
    found, tokens = scan.words(chunks.texts_of(group), lower=True), _subwords(share)
    net, inside, class_words = model.value
    docs = group.num_rows
    rows = told.to_pylist()
    hashes = np.concatenate([scan.from_planes(r["hashes"]) for r in rows])
    counts = np.concatenate([scan.from_planes(r["counts"]) for r in rows]).astype(np.int64)
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    end_count = counts[chunks.find(np.array([END_WORD]), hashes)[0][0]]
    # One token per word and one end per text, in order.
    first = found.first + np.arange(docs + 1)
    # Distinct words are looked up and cut once; the last entry is the end.
    every, seen, at = scan.distinct(found.hashes)
    word = np.full(first[-1], len(every), np.int32)
    is_word = np.ones(first[-1], bool)
    is_word[first[1:] - 1] = False
    word[is_word] = at
    c = np.append(counts[chunks.find(every, hashes)[0]], end_count)[word]
    owner = np.repeat(np.arange(docs), np.diff(first))
    base = np.bincount(owner, np.log10((c + SMOOTH) / (n + SMOOTH * (v + 1))), docs)
    known = np.bincount(owner, c > 0, docs).astype(np.int64)
    flat, length = tokens.of(found, every, seen)
    flat, length = np.append(flat, np.int32(tokens.end)), np.append(length, np.int32(1))
    begin = np.cumsum(length) - length
    score, a = np.zeros(docs), 0
    block = max(1, docs // max(1, len(found.hashes) // 40_000))
    while a < docs:
        b = min(docs, a + block)
        mine = word[first[a] : first[b]]
        sizes = length[mine]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        types = flat[_spread(begin[mine], sizes)]
        of_text = starts[first[a : b + 1] - first[a]]
        of_class = net.class_scores(types, of_text)
        head = starts[:-1]
        spelled = np.add.reduceat(of_class + inside[types], head) - of_class[head]
        count, size = c[first[a] : first[b]], class_words[net.classes[types[head]]]
        free = min(0.5, DISCOUNT * v / n) if n else 1.0
        with np.errstate(divide="ignore"):
            counted = np.log((1 - free) * count / np.maximum(size, 1))
        log_p = of_class[head] + np.logaddexp(np.log(free) + spelled, counted)
        score[a:b] = np.bincount(owner[first[a] : first[b]] - a, log_p / np.log(10), b - a)
        a = b
    columns = [chunks.texts_of(group, name) for name in names]
    columns += [pa.array(np.diff(first), pa.int64()), pa.array(known), pa.array(base), pa.array(score)]
    return pa.Table.from_arrays(columns, [*names, "n_tokens", "n_known", "base_score", "score"])


def _inside(classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log-probability of every type in its class, by smoothed corpus counts."""
    total = np.bincount(classes, counts + SMOOTH)
    return np.log((counts + SMOOTH) / total[classes])


def _streams(batches: Iterator[pa.RecordBatch], share) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The types of whole texts, one after the other, and where each text begins (last: the end); an end after each text."""
    tokens = _subwords(share)
    for batch in pieces(batches):
        if not batch.num_rows:
            continue
        found = scan.words(batch.column("text"), lower=True)
        first = found.first + np.arange(batch.num_rows + 1)
        every, seen, at = scan.distinct(found.hashes)
        word, is_word = np.full(first[-1], len(every), np.int32), np.ones(first[-1], bool)
        is_word[first[1:] - 1] = False
        word[is_word] = at
        flat, length = tokens.of(found, every, seen)
        flat, length = np.append(flat, np.int32(tokens.end)), np.append(length, np.int32(1))
        sizes = length[word]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        yield flat[_spread((np.cumsum(length) - length)[word], sizes)], starts[first]


HELD_PAIRS = 1 << 20


def _neighbours(batches: Iterator[pa.RecordBatch], share, context) -> Iterator[pa.RecordBatch]:
    """Neighbour counts of a task's texts; given on when many are held."""
    told = lambda k, n: pa.RecordBatch.from_arrays(
        [pa.array((k // (2 * attention.CONTEXTS)).astype(np.int32)), pa.array((k % (2 * attention.CONTEXTS)).astype(np.int32)), pa.array(n.astype(np.int64))],
        ["type", "context", "times"],
    )
    held, size = [], 0
    for types, first in _streams(batches, share):
        breaks = np.zeros(len(types), bool)
        breaks[first[:-1]] = True
        held.append(attention.neighbours(types.astype(np.int64), breaks, context.value))
        size += len(held[-1][0])
        if size > HELD_PAIRS:
            held = [_added(held)]
            size = len(held[0][0])
            if size > HELD_PAIRS // 2:
                yield told(*held[0])
                held, size = [], 0
    if held:
        yield told(*_added(held))


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, ascending, and the sums of their times."""
    keys, times = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(keys)
    keys = keys[order]
    begin = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[begin], np.add.reduceat(times[order], begin) if len(begin) else times[:0]


def _points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        types = batch.column("type").to_numpy()
        points = [
            attention.point(np.array(c, np.int64), np.array(n, np.float64), t % 2 == 1).astype(np.float32).tobytes()
            for t, c, n in zip(types.tolist(), batch.column("contexts").to_pylist(), batch.column("times").to_pylist(), strict=True)
        ]
        yield pa.RecordBatch.from_arrays([batch.column("type"), pa.array(points, pa.binary())], ["type", "point"])


def _classes(training: DataFrame, share, counts: np.ndarray, is_last: np.ndarray, end: int) -> np.ndarray:
    """Classes by the neighbours of the types in all training texts; one point per type, bounded by the vocabulary, comes to the driver."""
    context, common = attention.contexts(counts, end)
    if len(common) < attention.CLASSES:
        return attention.cluster(np.zeros((len(common), 64), np.float32), common, counts, is_last, end)
    shared = training.sparkSession.sparkContext.broadcast(context)
    pairs = training.select("text").mapInArrow(lambda b: _neighbours(b, share, shared), "type int, context int, times long")
    sums = pairs.groupBy("type", "context").agg(F.sum("times").alias("times"))
    # One row per type, of at most 2 * CONTEXTS entries, in a fixed order.
    entries = F.array_sort(F.collect_list(F.struct("context", "times"))).alias("e")
    by_type = sums.groupBy("type").agg(entries).select("type", F.col("e.context").alias("contexts"), F.col("e.times").alias("times"))
    points = np.stack([attention.point(np.zeros(0, np.int64), np.zeros(0), bool(is_last[t])) for t in (0, 1)])[common % 2]
    place = np.full(len(counts), -1)
    place[common] = np.arange(len(common))
    for row in written(by_type.mapInArrow(_points, "type int, point binary"), "points").toLocalIterator():
        if place[row["type"]] >= 0:
            points[place[row["type"]]] = np.frombuffer(row["point"], np.float32)
    return attention.cluster(points, common, counts, is_last, end)


BATCH, RATE = 256, 0.002


def _train(batches: Iterator[pa.RecordBatch], share, start) -> Iterator[pa.RecordBatch]:
    """The weights after all tokens of a task's texts, and their number."""
    net, n = copy.deepcopy(start.value), 0
    for types, first in _streams(batches, share):
        place, rows = net.rows_between(types, first)
        net.train(rows, net.classes[types[np.maximum(place, 0)]], (place >= 0).astype(np.float32), epochs=1, batch=BATCH, rate=RATE)
        n += len(types)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([net.weights().astype("<f4").tobytes()], pa.binary())], ["tokens", "weights"])


def _trained(net: attention.Network, training: DataFrame, share) -> attention.Network:
    """``net`` after one pass over every training text, in place; the tasks' weights are summed one by one."""
    start = training.sparkSession.sparkContext.broadcast(net)
    total, tokens = np.zeros(len(net.weights())), 0
    # Written first, by all tasks at once; the iterator alone would run one after the other.
    trained = written(training.select("text").mapInArrow(lambda b: _train(b, share, start), "tokens long, weights binary"), "weights")
    for row in trained.orderBy("tokens", "weights").toLocalIterator():
        total += row["tokens"] * np.frombuffer(row["weights"], "<f4")
        tokens += row["tokens"]
    if tokens:
        net.set_weights(total / tokens)
    return net


def fit(training: DataFrame, vocabulary: list[bytes], counts: np.ndarray, sample_docs: int = SAMPLE_DOCS, share=None, seed: int = 2) -> attention.Network:
    """The network, trained on every training row.

    It starts from ``SAMPLE_TOKENS`` types of each of at most ``sample_docs`` distinct rows, chosen by a hash of id and text.
    With the ``share`` of earlier steps the workers go on with the words they have cut there.
    """
    hashed = training.where("doc_id IS NOT NULL").withColumn("row_hash", F.xxhash64("doc_id", "text"))
    picked = hashed.select("doc_id", "row_hash").distinct().orderBy("row_hash", "doc_id").limit(sample_docs)
    sample = (
        hashed.join(F.broadcast(picked), ["doc_id", "row_hash"])
        .groupBy("doc_id", "row_hash")
        .agg(F.min(F.col("text").cast("binary")).alias("text"))
        .orderBy("doc_id", "text")
        .toPandas()
    )
    tokens, r = Subwords(vocabulary), np.random.default_rng(seed)
    is_last = np.arange(tokens.n_types) % 2 == 1
    streams = []
    for text in sample["text"]:
        words = (b"" if text is None else bytes(text)).translate(_FOLD).split()
        stream = np.append(tokens.cut(words)[0], tokens.end)
        at = int(r.integers(0, max(1, len(stream) - SAMPLE_TOKENS + 1)))
        streams.append(stream[at : at + SAMPLE_TOKENS])
    if not streams:
        streams = [np.array([tokens.end])]
    flat, first = np.concatenate(streams), np.concatenate([[0], np.cumsum([len(s) for s in streams])])
    every = training.where("doc_id IS NOT NULL")
    share = share or (uuid.uuid4().hex, training.sparkSession.sparkContext.broadcast(vocabulary))
    net = attention.Network(_classes(every, share, counts, is_last, tokens.end), counts)
    # Training windows: the same as in scoring, every predicted token of the window's second half.
    scored, rows = net.inputs(flat, first)
    place = np.hstack([np.full((len(rows), attention.STRIDE), -1), scored])
    target = net.classes[flat[np.maximum(place, 0)]]
    net.train(np.where(rows < 0, net.start, rows), target, (place >= 0).astype(np.float32))
    return _trained(net, every, share)


def score(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """Scores of ``doc_id``, ``text``, ``learn`` (whether to learn from the row), one row per document.

    Counts are written to the shared folder, and the network is fitted, when this is called.
    """
    context = docs.sparkSession.sparkContext
    n_chunks, n_buckets = chunks.sizes(docs)
    names = ["doc_id", "learn"]
    dealt = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)).cast("int").alias("chunk"), F.col("doc_id").cast("long").alias("doc_id"), "text", "learn")
    share = uuid.uuid4().hex, context.broadcast(vocabulary)
    counted = written(dealt.groupBy("chunk").applyInArrow(lambda g: _count(g, share, n_buckets), COUNTS), "word-counts")
    summed = written(counted.select("bucket", "chunk", "hashes", "counts").groupBy("bucket").applyInArrow(_sum, COUNTS), "word-sums")
    whole = summed.where("chunk IS NULL").agg(F.sum(F.col("times")[0]), F.sum(F.col("times")[1])).first()
    n, v = (int(x or 0) for x in whole)
    # One row per type at most: bounded by the vocabulary.
    types = counted.where("types IS NOT NULL").select(F.explode(F.arrays_zip("types", "times")).alias("t")).groupBy("t.types").agg(F.sum("t.times").alias("times"))
    counts = np.zeros(4 * len(vocabulary) + 4)
    for row in types.collect():
        counts[row["types"]] = row["times"]
    counts, starts = np.split(counts, 2)
    net = fit(docs.where("learn"), vocabulary, counts, SAMPLE_DOCS, share)
    model = context.broadcast((net, _inside(net.classes, counts), np.bincount(net.classes, starts, attention.CLASSES)))
    told = summed.where("chunk IS NOT NULL").select("chunk", "hashes", "counts")
    scored = dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        lambda g, t: _score(g, t, share, model, names, n, v), f"doc_id long, learn boolean, {SCORES}"
    )
    return scored.withColumn("train_tokens", F.lit(n).cast("long"))
