"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained with numpy by backpropagation through time.  A text is cut
into windows of ``WINDOW`` bytes that cover it once; in every window a forward and a
backward pass of gated units give each byte position a distribution over the
languages.  The distribution of a document is the mean over its letter positions, so
each position is labelled and counted once, however long the text is.

Training takes a bounded sample (``SAMPLE_DOCS`` documents per language); prediction
takes every byte of every text.  Defined cases: null, empty and letterless texts get
``und`` with score 0; repeated rows get equal results; without any training row every
text is ``und``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .base import is_text, pieces, text_bytes

WINDOW = 64
HIDDEN = 8
SAMPLE_DOCS = 400
# The sample of a language is drawn from so many hash slots, each sorted by itself.
SLOTS = 40
SAMPLE_WINDOWS = 8
EPOCHS = 6
BATCH = 128
LEARNING_RATE = 0.02
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_LETTER_BYTE = np.zeros(256, np.float32)
_LETTER_BYTE[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Network:
    """Two directions of gated units; axis 0 of every weight is the direction."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 7):
        r = np.random.default_rng(seed)
        n = len(languages)
        self.languages, self.hidden = languages, hidden
        # Gates: update, reset, candidate.
        self.p = {
            "E": r.normal(0, 0.3, (2, 256, 3 * hidden)),
            "U": r.normal(0, 1 / np.sqrt(hidden), (2, hidden, 2 * hidden)),
            "C": r.normal(0, 1 / np.sqrt(hidden), (2, hidden, hidden)),
            "O": r.normal(0, 0.3, (2, hidden, n)),
            "b": np.zeros(n),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def forward(self, x: np.ndarray):
        """x: windows x positions, bytes.  States by direction and step, and what training needs of each step."""
        h, p, n, steps = self.hidden, self.p, len(x), x.shape[1]
        both = np.stack([x.T, x.T[::-1]])
        state, trace, states = np.zeros((2, n, h), np.float32), [], np.empty((steps + 1, 2, n, h), np.float32)
        states[0] = 0
        for t in range(steps):
            e = np.stack([p["E"][0][both[0, t]], p["E"][1][both[1, t]]])
            gates = _sigmoid(e[..., : 2 * h] + state @ p["U"])
            z, r = gates[..., :h], gates[..., h:]
            c = np.tanh(e[..., 2 * h :] + (r * state) @ p["C"])
            trace.append((state, z, r, c))
            state = state + z * (c - state)
            states[t + 1] = state
        return both, states, trace

    def logits(self, states: np.ndarray) -> np.ndarray:
        """positions x windows x languages"""
        return states[1:, 0] @ self.p["O"][0] + states[1:, 1][::-1] @ self.p["O"][1] + self.p["b"]

    def gradients(self, x: np.ndarray, y: np.ndarray):
        """Loss and gradients for windows whose positions all carry label y; padding and signs weigh nothing."""
        h, p = self.hidden, self.p
        both, states, trace = self.forward(x)
        out = self.logits(states)
        out -= out.max(-1, keepdims=True)
        soft = np.exp(out)
        soft /= soft.sum(-1, keepdims=True)
        weight = _LETTER_BYTE[x.T]
        weight = weight / max(weight.sum(), 1)
        loss = -(weight * np.log(soft[:, np.arange(len(y)), y] + 1e-9)).sum()
        d_out = soft
        d_out[:, np.arange(len(y)), y] -= 1
        d_out *= weight[..., None]
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["b"] = d_out.sum((0, 1))
        flat = d_out.reshape(-1, d_out.shape[-1])
        g["O"][0] = states[1:, 0].reshape(-1, h).T @ flat
        g["O"][1] = np.ascontiguousarray(states[1:, 1][::-1]).reshape(-1, h).T @ flat
        d_states = np.stack([d_out @ p["O"][0].T, (d_out @ p["O"][1].T)[::-1]], 1)
        carry = np.zeros_like(states[0])
        for t in range(len(trace) - 1, -1, -1):
            before, z, r, c = trace[t]
            d = d_states[t] + carry
            d_c = d * z * (1 - c * c)
            through = d_c @ p["C"].transpose(0, 2, 1)
            d_gates = np.concatenate([d * (c - before) * z * (1 - z), through * before * r * (1 - r)], -1)
            carry = d * (1 - z) + through * r + d_gates @ p["U"].transpose(0, 2, 1)
            g["U"] += before.transpose(0, 2, 1) @ d_gates
            g["C"] += (r * before).transpose(0, 2, 1) @ d_c
            d_e = np.concatenate([d_gates, d_c], -1)
            for k in (0, 1):
                np.add.at(g["E"][k], both[k, t], d_e[k])
        return loss, g

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> list[float]:
        """Adam over shuffled batches; returns the losses."""
        r, m, v, step, losses = np.random.default_rng(seed), {}, {}, 0, []
        for _ in range(epochs):
            order = r.permutation(len(x))
            for a in range(0, len(order), BATCH):
                pick = order[a : a + BATCH]
                loss, g = self.gradients(x[pick], y[pick])
                losses.append(float(loss))
                step += 1
                for k, d in g.items():
                    m[k] = 0.9 * m.get(k, 0) + 0.1 * d
                    v[k] = 0.99 * v.get(k, 0) + 0.01 * d * d
                    rate = LEARNING_RATE * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                    self.p[k] -= (rate * m[k] / (np.sqrt(v[k]) + 1e-7)).astype(np.float32)
        return losses

    def predictor(self) -> Predictor:
        return Predictor(self)


class Predictor:
    """The trained network laid out for many windows at a time.

    The logistic gates are computed as tanh of half the input, so one tanh serves a
    whole step.
    """

    def __init__(self, net: Network):
        h, p = net.hidden, net.p
        scale = np.ones(3 * h, np.float32)
        scale[: 2 * h] = 0.5
        self.h, self.languages, self.b = h, net.languages, p["b"]
        self.E = [np.ascontiguousarray(p["E"][k] * scale) for k in (0, 1)]
        self.U = [np.ascontiguousarray(p["U"][k] * np.float32(0.5)) for k in (0, 1)]
        self.C, self.O = [np.ascontiguousarray(c) for c in p["C"]], [np.ascontiguousarray(o) for o in p["O"]]

    def _pass(self, steps: np.ndarray, k: int, out: np.ndarray, order) -> None:
        h, half = self.h, np.float32(0.5)
        state = np.zeros((steps.shape[1], h), np.float32)
        for t in order:
            e = self.E[k].take(steps[t], axis=0)
            gates = state @ self.U[k]
            gates += e[:, : 2 * h]
            np.tanh(gates, out=gates)
            gates += 1
            gates *= half
            c = (gates[:, h:] * state) @ self.C[k]
            c += e[:, 2 * h :]
            np.tanh(c, out=c)
            c -= state
            c *= gates[:, :h]
            state += c
            out[t] += state @ self.O[k]

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Windows x bytes -> positions x windows x languages: the distribution at every byte."""
        steps = np.ascontiguousarray(x.T)
        out = np.empty((*steps.shape, len(self.languages)), np.float32)
        out[:] = self.b
        self._pass(steps, 0, out, range(len(steps)))
        self._pass(steps, 1, out, range(len(steps) - 1, -1, -1))
        np.exp(out, out=out)
        out /= out.sum(-1, keepdims=True)
        return out

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean distribution over each text's letter positions; zeros without any."""
        doc, x = cut(texts)
        sums, letters = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        for a in range(0, len(x), 4096):
            part = x[a : a + 4096]
            weight = _LETTER_BYTE[part.T]
            soft = self.positions(part)
            np.add.at(sums, doc[a : a + 4096], np.einsum("tn,tnl->nl", weight, soft))
            np.add.at(letters, doc[a : a + 4096], weight.sum(0))
        return sums / np.maximum(letters, 1)[:, None]


def cut(texts: list[bytes], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Windows of ``size`` bytes that cover each text once, padded with zero bytes, and the text of each."""
    counts = np.array([-(-len(t) // size) for t in texts], np.int64)
    joined = b"".join(t.ljust(int(n) * size, b"\0") for t, n in zip(texts, counts, strict=True))
    return np.repeat(np.arange(len(texts)), counts), np.frombuffer(joined, np.uint8).reshape(-1, size)


def fit(training: DataFrame, sample_docs: int = SAMPLE_DOCS, seed: int = 5) -> Network | None:
    """Trains on at most ``sample_docs`` documents per language, windows taken from anywhere in them.

    The sample is chosen by a hash of the text, in the tasks; the languages are the
    distinct ones of the training rows.
    """
    rows = training.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL AND length(text) > 0")
    keyed = rows.withColumn("h", F.xxhash64("text"))
    order = W.partitionBy("lang", F.pmod("h", F.lit(SLOTS))).orderBy("h")
    # Hash values only; their number is bounded by the sample size and the number of languages.
    places = keyed.select("lang", "h").distinct().withColumn("place", F.row_number().over(order))
    picked = places.where(F.col("place") <= max(1, sample_docs // SLOTS)).select("lang", "h")
    sample = (
        keyed.join(F.broadcast(picked), ["lang", "h"], "left_semi")
        .groupBy("lang", "h")
        .agg(F.min("text").alias("text"))
        .orderBy("lang", "h")
        .toPandas()
    )
    sample = sample[sample["text"].str.contains(_LETTER)]
    if not len(sample):
        return None
    languages = sorted(sample["lang"].unique())
    r, xs, ys = np.random.default_rng(seed), [], []
    for lang, text in zip(sample["lang"], sample["text"], strict=True):
        _, x = cut([text.encode()])
        pick = r.permutation(len(x))[:SAMPLE_WINDOWS]
        xs.append(x[pick])
        ys.append(np.full(len(pick), languages.index(lang)))
    net = Network(languages)
    net.train(np.concatenate(xs), np.concatenate(ys))
    return net


def identify(docs: DataFrame, net: Network | None, keep: tuple[Column | str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns of ``keep``, ``lang_pred`` and ``score`` of every document; only the text is looked at."""
    chosen = docs.select("doc_id", "text", *(c for c in keep if not is_text(c)))
    fields = [f for f in chosen.schema.fields if f.name != "text" or any(map(is_text, keep))]
    names, kinds = [f.name for f in fields], [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
    predictor = net.predictor() if net is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            raw = text_bytes(batch.column("text"))
            has = [bool(_LETTER.search(t.decode("utf-8", "replace"))) for t in raw]
            if predictor is None:
                lang, score = [UNKNOWN] * len(raw), [0.0] * len(raw)
            else:
                mean = predictor.pooled([t if ok else b"" for t, ok in zip(raw, has, strict=True)])
                best = mean.argmax(1)
                lang = [predictor.languages[b] if ok else UNKNOWN for b, ok in zip(best, has, strict=True)]
                score = [float(min(1, mean[i, b])) if has[i] else 0.0 for i, b in enumerate(best)]
            columns = [batch.column(n) for n in names] + [pa.array(lang, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "lang_pred", "score"])

    return chosen.mapInArrow(run, ", ".join([*kinds, "lang_pred string", "score double"]))
