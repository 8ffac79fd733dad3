"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

* Voters.  Lexicons of whole words and of word beginnings (4, 5, 6 letters) are mined
  from labelled documents by log-odds, each split into a few lists by hash, so that lists
  of one kind can agree or differ; a public list of insults and patterns (shouting, runs
  of ``!``) vote beside them.  A voter fires or stays silent.
* Label model.  Two hidden classes; every voter has a firing rate in each, and a silent
  voter abstains, so insults of one language say nothing about those of another.  One
  voter fires when no lexicon does, and speaks for clean.  Expectation maximisation finds
  the rates without the labels, from whether a lexicon fires on; the class balance is that
  of the sample.  Voters that are still correlated inside a class count less: a voter's weight is
  1 / (1 + its squared correlations).  The posterior follows from the weighted rates.
* Classifier.  A logistic regression on lexicon entries, per-kind and any-hit marks is
  trained on the posteriors, so a score needs the text alone.

Fitting takes a bounded sample of the labelled rows (``TOXIC_DOCS`` and ``CLEAN_DOCS``,
rows chosen by a hash of id and text; near copies in it count once); every row is scored on its
whole text.  Defined cases: null, empty and wordless texts have no feature and get the
score of the bias; labels that are null, or missing one class, give a score of 0 to
everything; an id with different labels counts as toxic; repeated rows score alike.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import is_text, pieces, text_bytes

TOXIC_DOCS, CLEAN_DOCS = 1500, 3000
LEXICON_SIZE = 1500
# A lexicon entry occurs in LEAST_DOCS toxic sample documents at least, and in so many that
# a word without meaning would do so by chance with probability CHANCE at most; its share
# of toxic documents, both classes weighed alike, is at least PURITY.
LEAST_DOCS, CHANCE, PURITY = 4, 1e-6, 0.97
BEGINNINGS = (4, 5, 6)
LISTS = 3
ROUNDS = 60
_STRIP = b".,;:!?\"'()[]{}|*#%&$<>-_"
_UPPER = bytes(range(65, 91))
_FOLD = bytes.maketrans(_UPPER, _UPPER.lower())
_SHOUT = re.compile(rb"[A-Z]{4,}[^a-z]{12,}")
_BANGS = re.compile(rb"!{2,}")
# A short public list of insults.
INSULTS = frozenset(
    b"asshole bastard bitch bullshit cretin crap dumb dumbass fool freak hate idiot imbecile jerk loser lunatic moron "
    b"pathetic retard scum scumbag shit slut stupid trash ugly vermin whore worthless".split()
)


def word_set(text: bytes) -> set[bytes]:
    """Distinct words, A-Z lower-cased, without punctuation at their ends."""
    return {w.strip(_STRIP) for w in text.translate(_FOLD).split()} - {b""}


def beginnings(words: Iterable[bytes]) -> set[str]:
    """Word beginnings of each length, marked with it."""
    found = set()
    for w in words:
        if len(w) >= BEGINNINGS[0]:
            t = w.decode("utf-8", "replace")
            found.update(f"{n}^{t[:n]}" for n in BEGINNINGS if len(t) > n)
    return found


def features(words: set[bytes]) -> set[str]:
    return {f"w^{w.decode('utf-8', 'replace')}" for w in words} | beginnings(words)


def near_copies_out(texts: list[bytes]) -> list[int]:
    """Places of the texts that share no minimum of four keyed hashes over 4-word shingles with an earlier one."""
    seen: set[tuple[int, int]] = set()
    kept = []
    for i, text in enumerate(texts):
        w = text.split()
        hashes = np.array([crc32(b" ".join(w[j : j + 4])) for j in range(max(1, len(w) - 3))], np.uint64)
        keys = {(k, int((hashes * np.uint64(m) % np.uint64(4294967291)).min())) for k, m in enumerate((1, 2654435761, 40503, 97531))}
        if not keys & seen:
            kept.append(i)
        seen |= keys
    return kept


def mine_lexicon(toxic: list[bytes], clean: list[bytes], size: int = LEXICON_SIZE) -> list[str]:
    """Entries told by their smoothed share among toxic documents; the most frequent first."""
    if not toxic or not clean:
        return []
    share = len(toxic) / (len(toxic) + len(clean))
    least = max(LEAST_DOCS, math.log(CHANCE) / math.log(share))
    hits: Counter[str] = Counter()
    for text in toxic:
        hits.update(features(word_set(text)))
    hits = Counter({f: n for f, n in hits.items() if n >= least})
    # Of the clean documents only what can become an entry is counted.
    noise: Counter[str] = Counter()
    for text in clean:
        noise.update(features(word_set(text)) & hits.keys())
    chosen = []
    for f, n in hits.items():
        a, b = (n + 0.5) / (len(toxic) + 1), (noise[f] + 0.1) / (len(clean) + 1)
        if a / (a + b) >= PURITY and noise[f] <= 0.05 * n:
            chosen.append((-n, f))
    return [f for _, f in sorted(chosen)[:size]]


class Voters:
    """Votes of a document: one mark per voter."""

    def __init__(self, lexicon: list[str]):
        self.lexicon = {f: i for i, f in enumerate(lexicon)}
        self.words = {f[2:].encode(): i for f, i in self.lexicon.items() if f[0] == "w"}
        self.starts = {f: i for f, i in self.lexicon.items() if f[0] != "w"}
        kinds = ["w", *map(str, BEGINNINGS)]
        self.of_entry = [kinds.index(f[0]) * LISTS + crc32(f.encode()) % LISTS for f in lexicon]
        self.n_lists = len(kinds) * LISTS
        # Lexicons, then the public list and the patterns, then the voter for clean.
        self.n_voters = self.n_lists + 4
        self.n_features = len(lexicon) + self.n_voters + 1

    def look(self, text: bytes) -> tuple[list[int], list[int]]:
        """Lexicon entries found and voters that fire."""
        words = word_set(text)
        found = [self.words[w] for w in words & self.words.keys()]
        if self.starts:
            found += [self.starts[f] for f in beginnings(words) & self.starts.keys()]
        votes = {self.of_entry[i] for i in found}
        n = self.n_lists
        votes = votes or {n + 3}
        votes |= {n + k for k, on in enumerate((words & INSULTS, _SHOUT.search(text), _BANGS.search(text))) if on}
        return found, sorted(votes)

    def row(self, found: list[int], votes: list[int]) -> list[int]:
        """Active classifier features: entries, voters, and a mark that any lexicon voter fired."""
        n = len(self.lexicon)
        lists = any(v < self.n_lists for v in votes)
        return [*found, *(n + v for v in votes), *([n + self.n_voters] if lists else [])]


@dataclass
class LabelModel:
    """Firing rates by class (rows: clean, toxic), class balance, and the weights that correlations leave."""

    rates: np.ndarray
    balance: float
    weights: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        p = np.clip(self.rates, 1e-4, 1 - 1e-4)
        x = votes @ (self.weights * np.log(p[1] / p[0])) + math.log(self.balance / (1 - self.balance))
        return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_label_model(votes: np.ndarray, balance: float, rounds: int = ROUNDS) -> LabelModel:
    """Expectation maximisation on a documents x voters matrix of 0 and 1."""
    m = votes.shape[1]
    belief = np.where(votes[:, -1] > 0, 0.05, 0.9)
    model = LabelModel(np.zeros((2, m)), float(np.clip(balance, 0.02, 0.98)), np.ones(m))
    for step in range(rounds):
        for k, b in ((0, 1 - belief), (1, belief)):
            model.rates[k] = (b @ votes + 0.5) / (b.sum() + 1)
        if step >= 2:
            model.weights = 1 / (1 + _correlations(votes, belief, model.rates))
        new = model.posterior(votes)
        if np.abs(new - belief).max() < 1e-5 and step > 5:
            break
        belief = new
    return model


def _correlations(votes: np.ndarray, belief: np.ndarray, rates: np.ndarray) -> np.ndarray:
    """Sum of a voter's squared correlations with the others that neither class explains."""
    total = np.zeros((votes.shape[1], votes.shape[1]))
    for k, b in ((0, 1 - belief), (1, belief)):
        centred = votes - rates[k]
        cov = (centred * b[:, None]).T @ centred / (b.sum() + 1)
        spread = np.sqrt(np.maximum(np.diag(cov), 1e-6))
        total += (b.mean() * np.abs(cov / np.outer(spread, spread))) ** 2
    np.fill_diagonal(total, 0)
    return total.sum(1)


@dataclass
class Scorer:
    voters: Voters
    weights: np.ndarray
    bias: float

    def score(self, text: bytes) -> float:
        found, votes = self.voters.look(text)
        x = self.bias + float(self.weights[self.voters.row(found, votes)].sum())
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def fit_linear(rows: list[list[int]], n: int, target: np.ndarray, weight: np.ndarray, steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on sparse rows of active features, soft targets, with a small ridge."""
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.array([c for r in rows for c in r], np.int64)
    w, bias, mw, vw, mb, vb = np.zeros(n), 0.0, np.zeros(n), np.zeros(n), 0.0, 0.0
    for t in range(1, steps + 1):
        x = bias + np.bincount(doc, w[col], len(rows))
        d = weight * (1 / (1 + np.exp(-np.clip(x, -30, 30))) - target)
        gw, gb = np.bincount(col, d[doc], n) / weight.sum() + 1e-5 * w, d.sum() / weight.sum()
        mw, vw = 0.9 * mw + 0.1 * gw, 0.999 * vw + 0.001 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        rate = 0.1 * math.sqrt(1 - 0.999**t) / (1 - 0.9**t)
        w -= rate * mw / (np.sqrt(vw) + 1e-9)
        bias -= rate * mb / (math.sqrt(vb) + 1e-9)
    return w, bias


def fit(docs: DataFrame, labels: DataFrame, toxic_docs: int = TOXIC_DOCS, clean_docs: int = CLEAN_DOCS) -> Scorer | None:
    """Fits on labelled documents; ``labels`` has ``doc_id`` and ``toxic``, and only the rows to learn from.

    None where a class is missing.
    """
    named = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    balance = named.agg(F.avg("toxic")).first()[0]
    # Texts stay where they are until rows are picked by the hash of id and text: at most toxic_docs + clean_docs.
    hashed = docs.where("text IS NOT NULL").withColumn("row_hash", F.xxhash64("doc_id", "text"))
    rows = hashed.select("doc_id", "row_hash").join(named, "doc_id").distinct()
    order = ["row_hash", "doc_id"]
    picked = rows.where("toxic = 1").orderBy(*order).limit(toxic_docs).unionByName(
        rows.where("toxic = 0").orderBy(*order).limit(clean_docs)
    )
    sample = (
        hashed.select("doc_id", "row_hash", F.col("text").cast("binary").alias("text"))
        .join(F.broadcast(picked), ["doc_id", "row_hash"])
        .groupBy("doc_id", "row_hash", "toxic")
        .agg(F.min("text").alias("text"))
        .orderBy("doc_id", "text")
        .select("text", "toxic")
        .toPandas()
    )
    texts = [bytes(t) for t in sample["text"]]
    keep = near_copies_out(texts)
    texts, toxic = [texts[i] for i in keep], sample["toxic"].to_numpy()[keep].astype(bool)
    if not toxic.any() or toxic.all():
        return None
    lexicon = mine_lexicon([t for t, y in zip(texts, toxic, strict=True) if y], [t for t, y in zip(texts, toxic, strict=True) if not y])
    voters = Voters(lexicon)
    looked = [voters.look(t) for t in texts]
    votes = np.zeros((len(texts), voters.n_voters))
    for i, (_, v) in enumerate(looked):
        votes[i, v] = 1
    belief = fit_label_model(votes, toxic.mean()).posterior(votes)
    # The sample has more toxic documents than the labels: each class weighs as in the labels.
    share = toxic.mean()
    weight = np.where(toxic, balance / share, (1 - balance) / (1 - share))
    w, bias = fit_linear([voters.row(*x) for x in looked], voters.n_features, belief, weight)
    return Scorer(voters, w, bias)


def score(docs: DataFrame, scorer: Scorer | None, keep: tuple[Column | str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns of ``keep`` and ``score`` of every document; only the text is looked at."""
    chosen = docs.select("doc_id", "text", *(c for c in keep if not is_text(c)))
    fields = [f for f in chosen.schema.fields if f.name != "text" or any(map(is_text, keep))]
    names, kinds = [f.name for f in fields], [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            scores = [0.0 if scorer is None else scorer.score(t) for t in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(scores, pa.float64())], [*names, "score"])

    return chosen.mapInArrow(run, ", ".join([*kinds, "score double"]))
