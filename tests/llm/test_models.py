"""Trained operators: gradients, held-out accuracy, scores as distributions, exact round trips."""

from __future__ import annotations

import math
import random
from collections import Counter
from itertools import combinations

import cases
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quotaflow.llm import attention, language, licences, lm_score, pieces, scan, toxicity, url_rules
from quotaflow.llm.base import table
from quotaflow.llm.queries import QUERIES


def numeric(loss, array, places, step=1e-2):
    out = []
    for at in places:
        keep = array[at]
        array[at] = keep + step
        up = loss()
        array[at] = keep - step
        down = loss()
        array[at] = keep
        out.append((up - down) / (2 * step))
    return np.array(out)


def test_language_gradients():
    net = language.Network(["a", "b"], hidden=3)
    r = np.random.default_rng(0)
    x, y = r.integers(97, 110, (5, 6)).astype(np.uint8), np.array([0, 1, 0, 1, 1])
    _, g = net.gradients(x, y)
    for name in ("U", "C", "O"):
        places = [(0, 1, 1), (1, 2, 0)]
        wanted = numeric(lambda: net.gradients(x, y)[0], net.p[name], places)
        assert np.allclose([g[name][p] for p in places], wanted, atol=2e-3), name


def test_language_predictor_equals_the_network():
    net = language.Network(["a", "b", "c"], hidden=4)
    x = np.random.default_rng(1).integers(0, 256, (7, 9)).astype(np.uint8)
    _, states, _ = net.forward(x)
    out = net.logits(states)
    soft = np.exp(out) / np.exp(out).sum(-1, keepdims=True)
    assert np.allclose(net.predictor().positions(x), soft, atol=1e-4)


def test_language_query(spark, sf_dir):
    found = QUERIES["op2_language_id"](spark, sf_dir).join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    right = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.9
    assert found.where("score < 0 OR score > 1").count() == 0


def test_language_cases(spark):
    docs = cases.docs(spark)
    found = language.identify(docs, language.fit(docs), keep=("lang",)).collect()
    assert len(found) == len(cases.rows())
    blank = {i for i, t in cases.pairs() if t is None or not t.strip()} - {None}
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in found if r["doc_id"] in blank)
    assert {r["lang_pred"] for r in language.identify(docs, None).collect()} == {"und"}
    assert language.fit(docs.limit(0)) is None


def test_toxicity_query(spark):
    found = QUERIES["op3_toxicity"](spark, "/root/testdata/sf0.01").join(table(spark, "/root/testdata/sf0.01", "labels"), "doc_id")
    table_ = {(r["toxic"], r["predicted"]): r["count"] for r in found.groupBy("toxic", "predicted").count().collect()}
    assert table_.get((0, 1), 0) <= 0.01 * table_[(0, 0)]
    assert table_[(1, 1)] >= table_.get((1, 0), 0)


def test_toxicity_learns_new_words(spark):
    rows, labels = [], []
    for i in range(200):
        words = cases.prose(i, 60)
        if i % 4 == 0:
            words[10:10] = ["Zorgle!", "vexmuddle"]
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    rows += [(900, "a zorgle here"), (901, None), (902, ""), (903, "plain words only " * 2000), (900, "a zorgle here"), (None, "vexmuddles")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scorer = toxicity.fit(docs, spark.createDataFrame([*labels, (5000, 1), (None, 1), (7, None)], "doc_id long, toxic int"))
    score = {}
    for r in toxicity.score(docs, scorer).collect():
        score.setdefault(r["doc_id"], []).append(r["score"])
    assert score[900][0] == score[900][1] > 0.5
    assert max(score[901] + score[902] + score[903]) < 0.5
    assert all((score[i][0] > 0.5) == bool(y) for i, y in labels)
    assert toxicity.fit(docs, spark.createDataFrame([(1, 0)], "doc_id long, toxic int")) is None
    assert {r["score"] for r in toxicity.score(docs, None).collect()} == {0.0}


def test_training_samples_are_bounded_in_rows(spark, monkeypatch):
    """One id with most rows, which comes first whatever the order of ids, is not collected whole."""
    rows = [(1, f"zorgle number{i} word{i * 7}") for i in range(400)] + [(1, "zorgle again")] * 50
    rows += [(i, f"plain words number{i} here{i * 3}") for i in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i == 1)) for i in range(1, 40)], "doc_id long, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "near_copies_out", lambda texts: seen.append(len(texts)) or list(range(len(texts))))
    toxicity.fit(docs, labels, toxic_docs=20, clean_docs=10)
    assert seen == [30]

    class Tokens(lm_score.Subwords):
        def cut(self, words):
            texts.extend(words)
            return super().cut(words)

    texts = []
    monkeypatch.setattr(lm_score, "Subwords", Tokens)
    vocabulary = lm_score.read_vocabulary()
    one = docs.where("doc_id = 1").where("text <> 'zorgle again'")
    lm_score.fit(one, vocabulary, np.ones(2 * len(vocabulary) + 2), sample_docs=10)
    assert len(texts) == 3 * 10


def test_label_model_weighs_voters_by_accuracy():
    r = np.random.default_rng(3)
    truth = r.random(4000) < 0.3
    votes = np.zeros((4000, 6))
    for k, (hit, noise) in enumerate([(0.8, 0.01), (0.7, 0.02), (0.3, 0.25)]):
        votes[:, k] = r.random(4000) < np.where(truth, hit, noise)
    votes[:, 3] = votes[:, 0]
    votes[:, 5] = votes[:, :4].sum(1) == 0
    model = toxicity.fit_label_model(votes, 0.3)
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.9
    assert model.weights[0] < model.weights[1]


def test_attention_gradients():
    r = np.random.default_rng(0)
    counts = np.full(40, 5.0)
    net = attention.Network(np.arange(40) % attention.CLASSES, counts)
    rows, target = r.integers(0, 40, (3, attention.WINDOW)), r.integers(0, 40, (3, attention.WINDOW))
    mask = (r.random((3, attention.WINDOW)) < 0.7).astype(np.float32)
    _, g = net.loss(rows, target, mask)
    for name in ("q", "k", "v", "o", "f", "g", "c"):
        places = [(1, 2), (3, 0)]
        wanted = numeric(lambda: net.loss(rows, target, mask)[0], net.p[name], places)
        assert np.allclose([g[name][p] for p in places], wanted, atol=3e-3), name


def _plain_loss(net, rows, target, mask):
    """Mean loss, window by window."""
    p, scale, lost = {k: w.astype(np.float64) for k, w in net.p.items()}, attention.WIDTH**-0.5, 0
    for row, wanted, use in zip(rows, target, mask, strict=True):
        x = p["E"][row]
        s = (x @ p["q"]) @ (x @ p["k"]).T * scale + net.bias(np.arange(len(row)), np.arange(len(row)))
        a = np.exp(s - s.max(1, keepdims=True))
        h = x + a / a.sum(1, keepdims=True) @ (x @ p["v"]) @ p["o"]
        t = (h + np.maximum(h @ p["f"] + p["fb"], 0) @ p["g"]) @ p["c"] + p["cb"]
        lost -= ((t - np.log(np.exp(t).sum(1, keepdims=True)))[np.arange(len(row)), wanted] * use).sum()
    return lost / mask.sum()


def test_training_step_projects_rows_once_and_gives_every_gradient():
    r = np.random.default_rng(3)
    net = attention.Network(np.arange(40) % attention.CLASSES, np.full(40, 5.0))
    net.p["r"] = np.linspace(0, -1, attention.WINDOW).astype(np.float32)
    rows, target = r.choice([0, 3, 39, net.start], (6, attention.WINDOW)), r.integers(0, 40, (6, attention.WINDOW))
    mask = (r.random(rows.shape) < 0.7).astype(np.float32)
    seen, table = [], net.p["E"]

    class Watched(np.ndarray):
        def __getitem__(self, at):
            seen.append(np.size(at))
            return np.asarray(self)[at]

    net.p["E"] = table.view(Watched)
    loss, g = net.loss(rows, target, mask)
    net.p["E"] = table
    # Not a row for each of the batch's inputs.
    assert seen == [4]
    assert loss == pytest.approx(_plain_loss(net, rows, target, mask), rel=1e-5)
    net.p = {k: w.astype(np.float64) for k, w in net.p.items()}
    for name, places in (("E", [(0, 2), (39, 5), (net.start, 1), (7, 0)]), ("r", [(0,), (5,)]), ("k", [(1, 2)]), ("q", [(2, 1)]), ("fb", [(3,)]), ("cb", [(4,)])):
        for at in places:
            sides = []
            for step in (1e-4, -1e-4):
                net.p[name][at] += step
                sides.append(_plain_loss(net, rows, target, mask))
                net.p[name][at] -= step
            assert g[name][at] == pytest.approx((sides[0] - sides[1]) / 2e-4, abs=2e-4), (name, at)


@pytest.mark.parametrize("large", [False, True])
def test_training_step_goes_by_parts_with_the_gradients_of_the_whole(monkeypatch, large):
    r = np.random.default_rng(5)
    net = attention.Network(np.arange(40) % attention.CLASSES, np.full(40, 5.0))
    net.p["r"] = np.linspace(0, -1, attention.WINDOW).astype(np.float32)
    if large:  # exponentials of these scores and logits are not finite
        net.p["q"], net.p["c"] = net.p["q"] * 300, net.p["c"] * 80
    rows, target = r.integers(0, 40, (7, attention.WINDOW)), r.integers(0, 40, (7, attention.WINDOW))
    mask = (r.random(rows.shape) < 0.7).astype(np.float32)
    mask[4] = 0
    whole, wanted = net.loss(rows, target, mask)
    sizes, part = [], attention.Network._part
    monkeypatch.setattr(attention.Network, "_part", lambda self, tables, at_row, *a: sizes.append(len(at_row)) or part(self, tables, at_row, *a))
    monkeypatch.setattr(attention, "PART", 2)
    loss, found = net.loss(rows, target, mask)
    assert sizes == [2 * attention.WINDOW] * 3 + [attention.WINDOW]
    assert loss == pytest.approx(whole, rel=1e-5) and (large or loss == pytest.approx(_plain_loss(net, rows, target, mask), rel=1e-5))
    for name in net.p:
        assert np.isfinite(found[name]).all() and np.allclose(found[name], wanted[name], rtol=1e-3, atol=1e-4 * abs(wanted[name]).max()), name


def test_training_step_gives_back_one_narrow_row_for_each_input(monkeypatch):
    """What queries, keys and values give back is joined before it is sorted; long sums go by rows."""
    r = np.random.default_rng(7)
    net = attention.Network(np.arange(40) % attention.CLASSES, np.full(40, 5.0))
    net.p["r"] = np.linspace(0, -1, attention.WINDOW).astype(np.float32)
    rows, target = (r.integers(0, 40, (5, attention.WINDOW)) for _ in range(2))
    mask = (r.random(rows.shape) < 0.7).astype(np.float32)
    loss, wanted = net.loss(rows, target, mask)
    taken, take = [], np.take
    monkeypatch.setattr(attention.np, "take", lambda m, at, *a, **k: taken.append((len(at), m.shape[-1])) or take(m, at, *a, **k))
    monkeypatch.setattr(attention, "ROWS", 24)
    monkeypatch.setattr(attention, "PART", 3)
    found = net.loss(rows, target, mask)[1]
    assert [x for x in taken if x[0] == rows.size] == [(rows.size, attention.WIDTH)]
    assert loss == pytest.approx(_plain_loss(net, rows, target, mask), rel=1e-5)
    for name in net.p:
        assert np.allclose(found[name], wanted[name], rtol=1e-3, atol=1e-4 * abs(wanted[name]).max()), name


@pytest.mark.parametrize("n", [0, 1, 24, 25, 100])
def test_sums_over_many_rows_are_those_of_one_product(monkeypatch, n):
    monkeypatch.setattr(attention, "ROWS", 24)
    x, y = (np.random.default_rng(n).normal(size=(n, k)).astype(np.float32) for k in (3, 5))
    assert np.allclose(attention._inner(x, y), x.T @ y, atol=1e-5)


def test_training_keeps_its_memory_and_follows_the_gradients():
    r = np.random.default_rng(6)
    rows, target = r.integers(0, 40, (10, attention.WINDOW)), r.integers(0, 40, (10, attention.WINDOW))
    mask = np.ones(rows.shape, np.float32)
    net, plain = (attention.Network(np.arange(40) % attention.CLASSES, np.full(40, 5.0)) for _ in range(2))
    rooms, step = [], net.loss
    net.loss = lambda *a: rooms.append(a[3]) or step(*a)
    net.train(rows, target, mask, epochs=2, batch=4)
    assert len(rooms) == 6 and all(x is rooms[0] for x in rooms)
    order, n, m, v = np.random.default_rng(1), 0, {}, {}
    for _ in range(2):
        mixed = order.permutation(10)
        for a in range(0, 10, 4):
            g, n = plain.loss(*(x[mixed[a : a + 4]] for x in (rows, target, mask)))[1], n + 1
            for k, d in g.items():
                m[k], v[k] = 0.9 * m.get(k, 0) + 0.1 * d, 0.98 * v.get(k, 0) + 0.02 * d * d
                rate = 0.006 * (1 - 0.9 * n / 6) * np.sqrt(1 - 0.98**n) / (1 - 0.9**n)
                plain.p[k] -= (rate * m[k] / (np.sqrt(v[k]) + 1e-8)).astype(np.float32)
    for name in net.p:
        assert np.allclose(net.p[name], plain.p[name], atol=2e-4), name


def test_attention_scores_each_token_once_and_causally():
    r = np.random.default_rng(2)
    net = attention.Network(np.arange(50) % attention.CLASSES, np.ones(50))
    types, first = r.integers(0, 50, 150), np.array([0, 1, 40, 40, 150])
    scored, _ = net.inputs(types, first)
    assert sorted(scored[scored >= 0].tolist()) == list(range(150))
    whole = net.class_scores(types, first)
    cut = net.class_scores(np.concatenate([types[:100], r.integers(0, 50, 50)]), first)
    assert np.allclose(whole[:100], cut[:100], atol=1e-5)
    assert (whole < 0).all()


def forward(net, stream, at):
    """Log-probabilities of the classes at one place of a text, number by number."""
    p, w, half = net.p, attention.WINDOW, attention.STRIDE
    begin = at // half * half - half
    rows = [net.start if i <= 0 else net.row[stream[i - 1]] for i in range(max(begin, 0), at + 1)]
    x = p["E"][rows].astype(np.float64)
    gap = np.arange(len(rows))[::-1]
    s = (x[-1] @ p["q"]) @ (x @ p["k"]).T * attention.WIDTH**-0.5 + p["r"][gap]
    # Places of the window before the text are read as its start.
    if begin < 0:
        start = p["E"][net.start].astype(np.float64)
        ahead = np.array([(x[-1] @ p["q"]) @ (start @ p["k"]) * attention.WIDTH**-0.5 + p["r"][at - i] for i in range(begin, 0)])
        x, s = np.vstack([np.repeat(start[None], -begin, 0), x]), np.concatenate([ahead, s])
    assert len(x) <= w
    weight = np.exp(s - s.max())
    h = x[-1] + (weight / weight.sum()) @ (x @ p["v"]) @ p["o"]
    t = (h + np.maximum(h @ p["f"] + p["fb"], 0) @ p["g"]) @ p["c"] + p["cb"]
    return t - t.max() - np.log(np.exp(t - t.max()).sum())


@pytest.mark.parametrize("batch", [1, 3, 128])
def test_scoring_looks_up_what_attention_takes_of_an_input_once(monkeypatch, batch):
    """Texts of every length beside a block's, in batches that end inside them."""
    r = np.random.default_rng(4)
    net = attention.Network(np.arange(50) % attention.CLASSES, np.ones(50))
    net.p["r"] = np.linspace(0, -1, attention.WINDOW).astype(np.float32)
    half = attention.STRIDE
    lengths = np.array([0, 1, half - 1, half, 0, half + 1, 2 * half, 5 * half + 3, 0])
    first = np.append(0, np.cumsum(lengths))
    types = r.integers(0, 50, first[-1])
    taken, take = [], np.take
    monkeypatch.setattr(attention.np, "take", lambda m, at, *a, **k: taken.append(len(at)) or take(m, at, *a, **k))
    found = net.class_scores(types, first, batch)
    for a, b in zip(first, first[1:]):
        wanted = [forward(net, types[a:b], i)[net.classes[t]] for i, t in enumerate(types[a:b])]
        assert np.allclose(found[a:b], wanted, atol=1e-4), (a, b)
    # Blocks, one of starts for each text among them; keys and values once more for the block before a batch.
    blocks = int((1 - (-lengths // half)).sum())
    assert sum(taken) == half * (4 * blocks + 2 * -(-blocks // batch))


def test_lm_scores_are_those_of_a_plain_forward_pass(spark, monkeypatch):
    rows = [(i, " ".join(cases.prose(i, 45 + i)), i % 3 > 0) for i in range(24)]
    rows += [(50, "Unseen zorgle, vexmuddle!", False), (51, None, False), (52, "", True), (53, "é 日本語 " * 20, False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean")
    vocabulary, nets, fit = lm_score.read_vocabulary(), [], lm_score.fit
    monkeypatch.setattr(lm_score, "fit", lambda *a: nets.append(fit(*a)) or nets[0])
    found = {r["doc_id"]: r for r in lm_score.score(docs, vocabulary).collect()}
    net, cutter, end = nets[0], lm_score.Subwords(vocabulary), b"\n"
    fold = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    tokens = {i: [*(t or "").encode().translate(fold).split(), end] for i, t, _ in rows}
    cut = {w: cutter.cut([w])[0].tolist() for ws in tokens.values() for w in ws if w != end} | {end: [cutter.end]}
    count, of_type, of_class = Counter(), np.zeros(cutter.n_types), Counter()
    for i, _, learn in rows:
        for w in tokens[i] if learn else ():
            count[w] += 1
            of_class[net.classes[cut[w][0]]] += 1
            np.add.at(of_type, cut[w], 1)
    n, v = sum(count.values()), len(count)
    in_class = np.bincount(net.classes, of_type + lm_score.SMOOTH)
    free = min(0.5, lm_score.DISCOUNT * v / n)
    for i, words in tokens.items():
        stream, total = [t for w in words for t in cut[w]], 0.0
        at = 0
        for w in words:
            spelled = 0.0
            for k, t in enumerate(cut[w]):
                of = forward(net, stream, at + k)[net.classes[t]]
                spelled += (of if k else 0) + np.log((of_type[t] + lm_score.SMOOTH) / in_class[net.classes[t]])
                head = of if not k else head
            at += len(cut[w])
            counted = (1 - free) * count[w] / max(1, of_class[net.classes[cut[w][0]]])
            total += (head + np.log(counted + free * np.exp(spelled))) / np.log(10)
        assert found[i]["score"] == pytest.approx(total, rel=1e-4), i
        assert found[i]["n_tokens"] == len(words)


def test_subwords_of_many_words_are_those_of_each(spark, sf_dir):
    tokens = lm_score.Subwords(lm_score.read_vocabulary())
    words = [w.encode() for r in table(spark, sf_dir, "documents").limit(20).collect() for w in (r["text"] or "").split()] + ["日本語".encode(), b"\x00", b"x" * 500]
    types, length = tokens.cut(words)
    each = [[2 * i for i in tokens.encoder.encode_ordinary(w.decode())] for w in words]
    assert types.tolist() == [t for ts in each for t in (*ts[:-1], ts[-1] + 1)]
    assert length.tolist() == list(map(len, each))
    assert [len(x) for x in tokens.cut([])] == [0, 0]


def test_a_worker_cuts_a_word_once(monkeypatch):
    tokens, cut = lm_score.Subwords(lm_score.read_vocabulary()), []
    plain = tokens.cut
    monkeypatch.setattr(tokens, "cut", lambda words: cut.extend(words) or plain(words))

    def types(*texts):
        found = scan.words(pa.array(texts), lower=True)
        every, seen, at = scan.distinct(found.hashes)
        assert (np.diff(every.astype(object)) > 0).all() and (every[at] == found.hashes).all() and (found.hashes[seen] == every).all()
        flat, length = tokens.of(found, every, seen)
        assert [x.tolist() for x in np.split(flat, np.cumsum(length)[:-1])] == [plain([w])[0].tolist() for w in lm_score._word_bytes(found, seen)]

    types("the zorgle the vexmuddle", "", "Zorgle")
    assert sorted(cut) == [b"the", b"vexmuddle", b"zorgle"]
    types("new words and the ZORGLE")
    assert sorted(cut[3:]) == [b"and", b"new", b"words"]
    # What is kept is bounded.
    monkeypatch.setattr(lm_score, "KEPT_WORDS", 5)
    types("zorgle")
    assert cut[6:] == [b"zorgle"] and len(tokens.known) == 1
    none = scan.words(pa.array(["", None]))
    assert [len(x) for x in tokens.of(none, *scan.distinct(none.hashes)[:2])] == [0, 0]


def test_fitting_goes_on_with_the_words_that_workers_have_cut(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "zorgle vexmuddle", True)], "doc_id long, text string, learn boolean")
    shares, names, uuid4 = [], [], lm_score.uuid.uuid4

    def named():
        names.append(uuid4())
        return names[-1]

    class Stop(Exception):
        pass

    def stop(training, share, *rest):
        shares.append(share)
        raise Stop

    monkeypatch.setattr(lm_score, "_classes", stop)
    monkeypatch.setattr(lm_score.uuid, "uuid4", named)
    with pytest.raises(Stop):
        lm_score.score(docs, lm_score.read_vocabulary())
    # The first name is that of the counting step.
    assert shares[0][0] == names[0].hex


@pytest.mark.parametrize("held", [1, 50, 1 << 20])
def test_neighbours_held_or_given_on_add_up(monkeypatch, held):
    texts = [" ".join(cases.prose(i, 30)) for i in range(40)] + [None, ""]
    tokens = lm_score.Subwords(lm_score.read_vocabulary())
    context = np.full(tokens.n_types, -1)
    often = Counter(t for x in texts for t in tokens.cut((x or "").encode().split())[0].tolist()).most_common(8)
    context[[t for t, _ in often]] = np.arange(len(often))
    wanted = Counter()
    for x in texts:
        stream = [*tokens.cut((x or "").encode().lower().split())[0].tolist(), tokens.end]
        for a, b in zip(stream, stream[1:]):
            if context[a] >= 0:
                wanted[b, context[a]] += 1
            if context[b] >= 0:
                wanted[a, attention.CONTEXTS + context[b]] += 1

    class Shared:
        def __init__(self, value):
            self.value = value

    monkeypatch.setattr(lm_score, "HELD_PAIRS", held)
    batches = (pa.RecordBatch.from_arrays([pa.array(texts[i : i + 7])], ["text"]) for i in range(0, len(texts), 7))
    found = Counter()
    for b in lm_score._neighbours(batches, (f"held{held}", Shared(lm_score.read_vocabulary())), Shared(context)):
        for r in b.to_pylist():
            found[r["type"], r["context"]] += r["times"]
    assert found == wanted


def test_lm_query(spark, sf_dir):
    found = QUERIES["op7_lm_scoring"](spark, sf_dir).collect()
    docs = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()}
    from zlib import crc32

    import brute

    words = {i: [*brute.WORD.findall((t or "").translate(brute.FOLD)), None] for i, t in docs.items()}
    held = {i: crc32(str(i).encode()) % 10 == 0 for i in docs}
    count = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    assert len(found) == len(docs)
    for r in found:
        ws = words[r["doc_id"]]
        base = sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[r["doc_id"]], len(ws), sum(count[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0


def test_lm_cases(spark):
    docs = cases.docs(spark).select("doc_id", "text", (F.col("doc_id") > 0).alias("learn"))
    found = lm_score.score(docs, lm_score.read_vocabulary()).collect()
    assert len(found) == len(cases.rows())
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    assert {r["n_tokens"] for r in found if r["doc_id"] in (-3, 0, 3)} == {1}
    assert lm_score.score(docs.limit(0), lm_score.read_vocabulary()).count() == 0
    unlearnt = lm_score.score(docs.withColumn("learn", F.lit(False)), lm_score.read_vocabulary()).collect()
    assert {r["n_known"] for r in unlearnt} == {0} and all(math.isfinite(r["score"]) for r in unlearnt)


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


TEXTS = ["", " ", "  a  b ", "▁x ▁▁", "\0a\0m▁", "a\nb\t c", "é　日本語🙂 𝒳", "word " * 500, "x" * 3000, "▁", " ▁ a "]


def test_pieces_without_dropout_are_the_models_own(vocabulary, spark, sf_dir):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    encoder = pieces.Encoder(vocabulary, 0.0)
    texts = [t for t in TEXTS if "▁" not in t and "\0" not in t]
    texts += [r["text"] for r in table(spark, sf_dir, "documents").select("text").collect()]
    for t in texts:
        assert list(encoder.encode(t)) == model.encode(t), t


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_pieces_come_back_exactly(vocabulary, dropout):
    encoder = pieces.Encoder(vocabulary, dropout)
    for t in TEXTS:
        for key in (0, 1, -3):
            assert encoder.decode(encoder.encode(t, key)) == t


@pytest.mark.parametrize("dropout", [0.0, 0.3])
def test_both_agendas_cut_alike(vocabulary, dropout):
    encoder = pieces.Encoder(vocabulary, dropout)
    units = ["▁international", "▁aaaaaaa", "▁thththth.", "é▁", "x", "▁▁▁▁x", "▁" + "un" * 15, "▁" + "un" * 19 + "é", "▁日本語🙂𝒳ab", "▁" + "z" * 60]
    codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
    first = np.cumsum([0, *map(len, units)])[:-1]
    for variant in range(4):
        final = encoder.cut(codes, first, np.full(len(units), variant, np.uint32))
        for unit, at in zip(units, first):
            plain, place = encoder._by_heap(unit, pieces.unit_key(encoder.seed, variant, unit)), int(at)
            for symbol in plain:
                assert final[place] == vocabulary.rank.get(symbol, final[place])
                assert (final[place + 1 : place + len(symbol)] < 0).all()
                place += len(symbol)


def test_pairs_are_those_that_spell_a_piece(vocabulary):
    pairs, rank = pieces.Pairs(vocabulary.rank), vocabulary.rank
    names = sorted(rank, key=rank.get)
    r = np.random.default_rng(4)
    left, right = r.integers(0, len(names), 20_000), r.integers(0, len(names), 20_000)
    split = [(p[:k], p[k:]) for p in names[::7] for k in range(1, len(p)) if p[:k] in rank and p[k:] in rank]
    left, right = np.append(left, [rank[a] for a, _ in split]), np.append(right, [rank[b] for _, b in split])
    found = pairs.find(left, right)
    for a, b, at in zip(left, right, found):
        whole = rank.get(names[a] + names[b])
        assert at == (pieces._NONE if whole is None else whole << pieces._PLACE_BITS)


def test_dropout_varies_and_repeats(vocabulary):
    one, two = pieces.Encoder(vocabulary, 0.2), pieces.Encoder(vocabulary, 0.2)
    text = "international collaboration " * 8
    assert one.encode(text, 1) == two.encode(text, 1)
    assert one.encode(text, 1) != one.encode(text, 2)
    assert one.encode(text, 1) != pieces.Encoder(vocabulary, 0.2, seed=5).encode(text, 1)
    assert len(one.encode(text)) > len(pieces.Encoder(vocabulary, 0.0).encode(text))


def test_every_occurrence_is_cut_on_its_own(vocabulary):
    encoder = pieces.Encoder(vocabulary, 0.3)
    assert len({tuple(encoder.encode("internationalization", k)) for k in range(300)}) > 10
    cuts = []
    for i in encoder.encode("internationalization " * 300):
        content = vocabulary.content[i]
        cuts += [[]] if content.startswith(b" ") else []
        cuts[-1].append(i)
    assert len(set(map(tuple, cuts))) > 10


def test_texts_with_a_literal_mark_vary_too(vocabulary):
    encoder = pieces.Encoder(vocabulary, 0.3)
    for literal in ("▁", "\0"):
        text = "international collaboration " * 8 + literal + " international" * 8
        found = [encoder.encode(text, key) for key in range(20)]
        assert len(set(map(tuple, found))) > 10
        assert all(encoder.decode(ids) == text for ids in found)


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
@pytest.mark.parametrize("at_once", [40, pieces.AT_ONCE])
def test_agendas_side_by_side_give_the_cuts_of_one(vocabulary, spark, sf_dir, dropout, at_once):
    encoder = pieces.Encoder(vocabulary, dropout, at_once=at_once)
    texts = [*TEXTS, *(r["text"] for r in table(spark, sf_dir, "documents").select("text").limit(30).collect())]
    flat, sizes = encoder.encode_all(texts, list(range(len(texts))))
    ends = np.cumsum(sizes)
    for row, text in enumerate(texts):
        found = encoder._units(text)
        of = pieces.occurrences(encoder.seed, np.full(len(found), row, np.uint64), np.arange(len(found)))
        plain = []
        for k, u in zip(of, found):
            if u[0] == "\0":
                plain += [vocabulary.byte[b] for b in (u[1:] or u).encode()]
            else:
                plain += encoder.spell(encoder._by_heap(u, pieces.unit_key(encoder.seed, int(k), u)))
        assert flat[ends[row] - sizes[row] : ends[row]].tolist() == plain


def test_pieces_query(spark, sf_dir):
    found = QUERIES["op5_sentencepiece"](spark, sf_dir)
    assert found.where("NOT lossless").count() == 0
    assert found.count() == table(spark, sf_dir, "documents").count()


def test_pieces_cases(spark, vocabulary):
    docs = cases.docs(spark)
    encoded = pieces.encode(docs, vocabulary, keep=(F.col("score"),))
    back = pieces.decode(encoded, vocabulary)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(cases.pairs(), key=repr)
    assert pieces.encode(docs.limit(0), vocabulary).count() == 0


def test_licence_templates_are_found(spark):
    rows = []
    for i, text in enumerate(licences.TEMPLATES.values()):
        filler = cases.prose(i, 40 + 7 * i)
        rows.append((i, " ".join(filler[: 11 * i % 37]) + " " + text.upper() + "\n" + " ".join(filler)))
    rows += [(500, None), (501, ""), (502, "rights reserved all apache mit license"), (503, "license " * 20_000), (None, "All rights reserved.")]
    found = licences.find_licences(spark.createDataFrame(rows, "doc_id long, text string"))
    names = {(r["doc_id"], r["template"]) for r in found.where("containment = 1").collect()}
    assert {(i, n) for i, n in enumerate(licences.TEMPLATES)} <= names
    assert not {i for i, _ in names} & {500, 501, 502, 503}
    assert (None, "all-rights") in names
    assert licences.find_licences(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_licence_query_misses_nothing(spark):
    """Against the plain containment of every template in every window."""
    import re

    d = "/root/testdata/sf0.01"
    found = {(r["doc_id"], r["template"]) for r in QUERIES["op8_licence_scan"](spark, d).collect()}
    wanted = set()
    for r in table(spark, d, "documents").select("doc_id", "text").collect():
        words = [w for w in re.split("[^a-z0-9]+", r["text"].lower()) if w]
        for name, text in licences.TEMPLATES.items():
            own = licences.template_words(text)
            need, size = licences.template_shingles(own), licences.size_class(len(own))
            for first in range(0, max(len(words), 1), size):
                has = licences.template_shingles(words[first : first + 2 * size])
                if len(need & has) >= licences.CONTAINMENT * len(need):
                    wanted.add((r["doc_id"], name))
    assert found == wanted and wanted


def test_band_settings_retrieve_what_is_required():
    for text in licences.TEMPLATES.values():
        words = licences.template_words(text)
        bound = licences.miss_bound(len(licences.template_shingles(words)), 2 * licences.size_class(len(words)))
        assert bound < 0.02


def test_every_template_is_retrieved_within_the_stated_bound():
    for text in licences.TEMPLATES.values():
        words = licences.template_words(text)
        own = licences.template_shingles(words)
        direct = licences.looked_up(words)
        if direct:
            # Without these the rest is below what is required.
            assert len(own - set(direct)) < licences.CONTAINMENT * len(own) and set(direct) <= own
        else:
            assert licences.miss_bound(len(own), 2 * licences.size_class(len(words))) <= licences.MISS


def test_short_notices_do_not_hang_on_the_bands(spark, monkeypatch):
    monkeypatch.setattr(licences, "BANDS", 1)
    short = {n: licences.TEMPLATES[n] for n in ("all-rights", "mit-short")}
    rows = [(i, name, " ".join([*cases.prose(i, 2), text, *cases.prose(i + 999, 9)])) for i in range(100) for name, text in short.items()]
    docs = spark.createDataFrame([(f"{i} {name}", text) for i, name, text in rows], "doc_id string, text string")
    found = {(r["doc_id"], r["template"]) for r in licences.find_licences(docs).where("containment = 1").collect()}
    assert {(f"{i} {name}", name) for i, name, _ in rows} <= found


def test_given_url_rules(spark):
    rows = [
        (1, "http://A.Example.COM/en/x?q#f"), (2, "https://www.example.com/en/1"), (3, "https://net/es/"), (4, "x.net/fr/"),
        (5, None), (6, "http://xcom/a"), (7, "http://b.com"), (8, "http://m.net/de/1#/es/"), (9, "://com/"), (9, "://com/"), (None, "http://a.com?x/"),
    ]
    found = url_rules.judge(spark.createDataFrame(rows, "page_id long, url string"))
    got = {(r["page_id"], r["host"], r["path"], r["rule"]) for r in found.collect()}
    assert got == {
        (1, "a.example.com", "/en/x", "example.com/en/"), (2, "www.example.com", "/en/1", "www.example.com/en/"),
        (3, "net", "/es/", "net/es/"), (4, "", "", None), (5, "", "", None), (6, "xcom", "/a", None), (7, "b.com", "", None),
        (8, "m.net", "/de/1", None), (9, "com", "/", "com/"), (None, "a.com", "", None),
    }
    assert found.count() == len(rows)
    assert url_rules.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_toxicity_does_not_depend_on_the_order_of_labels(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", "toxic")
    other = labels.unionByName(labels.where("doc_id % 3 = 0").withColumn("toxic", 1 - F.col("toxic")))
    a = toxicity.fit(docs, other.repartition(7, "toxic"))
    b = toxicity.fit(docs.repartition(5), other.orderBy(F.desc("toxic"), "doc_id"))
    assert a.voters.lexicon == b.voters.lexicon and np.array_equal(a.weights, b.weights) and a.bias == b.bias


def url_verdicts_over_all_subsets(rows, confidence, support):
    """Verdict and rule of each url without a given rule: all token sets, counted and pruned one by one."""
    labelled = [(frozenset(t), v) for _, t, v in rows if v is not None]
    least = max(1, math.ceil(support * len(labelled)))
    sets = {frozenset(c) for t in {t for t, _ in labelled} for k in range(1, len(t) + 1) for c in combinations(sorted(t), k)}

    def sure(items, verdict):
        said = [v for t, v in labelled if items <= t]
        return said.count(verdict) / len(said), said.count(verdict)

    rules = {}
    for items in sets:
        for verdict in ("allow", "block"):
            share, n = sure(items, verdict)
            less = [items - {t} for t in items] if len(items) > 1 else []
            if n >= least and share >= confidence and all(sure(i, verdict)[0] < share for i in less):
                rules[items, verdict] = share, n / len(labelled)
    urls = {t: frozenset(i for i, (u, _) in enumerate(labelled) if t in u) for u, _ in labelled for t in u}
    name = {t: min(o for o in urls if urls[o] == urls[t]) for t in urls}
    out = {}
    for page, tokens, verdict in rows:
        if verdict is None:
            fits = [(*much, len(i), sorted(map(name.get, i)), v) for (i, v), much in rules.items() if i <= frozenset(tokens)]
            out[page] = (max(fits)[-1], " ".join(max(fits)[-2])) if fits else ("allow", None)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_url_rules_equal_all_subsets(spark, seed):
    r = random.Random(seed)
    rows = []
    for i in range(160):
        tail = "/".join(sorted(r.sample(["a", "b", "c", "dd", "e", "f9"], r.randint(0, 4))))
        host = r.choice(["x.com", "y.com", "example.com", "z.org", "t.net"])
        start = r.choice(["en", "es", "en/es", "q"]) + ("/twin/also" if r.random() < 0.3 else "")
        rows.append((i, f"http://{host}/{start}/{tail}" + r.choice(["", "?k=1&l=2", "?k=3"])))
    rows += [(900, rows[0][1]), (901, rows[5][1]), (902, None), (903, "none"), (904, "http://q.org/also")]
    pages = spark.createDataFrame([(*x, "mine", 1.0) for x in rows], "page_id long, url string, tokens string, name double")
    found = {x["page_id"]: x for x in url_rules.judge(pages, confidence=0.6, support=0.03).collect()}
    assert len(found) == len(rows)
    host, path = url_rules.split_url(F.col("url"))
    cut = pages.select("page_id", host.alias("h"), path.alias("p"), url_rules.tokens(F.col("url"), host, path).alias("t")).collect()
    told = [(x["page_id"], x["t"] if x["h"] else [], found[x["page_id"]]["verdict"] if found[x["page_id"]]["rule"] else None) for x in cut]
    wanted = url_verdicts_over_all_subsets(told, 0.6, 0.03)
    assert {p: (found[p]["verdict"], found[p]["mined_rule"]) for p in wanted} == wanted
    assert {v for v, _ in wanted.values()} == {"allow", "block"} and any(m and " " in m for _, m in wanted.values())


def test_long_urls_do_not_multiply_rules(spark):
    deep = "/".join(f"s{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(60))
    rows = [(i, f"http://a.net/es/{deep}") for i in range(500)] + [(i, f"http://b.com/es/{deep}") for i in range(500, 1000)]
    rows += [(1000, f"http://c.org/{deep}"), (1001, "http://c.org/saa"), (1002, "http://a.org/")]
    found = url_rules.judge(spark.createDataFrame(rows, "page_id long, url string")).where("page_id >= 1000")
    assert {(x["page_id"], x["verdict"], x["mined_rule"]) for x in found.collect()} == {
        (1000, "allow", None), (1001, "allow", None), (1002, "block", "host=a"),
    }


def test_url_query(spark, sf_dir):
    found = QUERIES["op4_url_filters"](spark, sf_dir)
    assert found.count() == table(spark, sf_dir, "pages").count()
    assert found.where("verdict NOT IN ('allow', 'block') OR verdict IS NULL").count() == 0
    assert found.where("rule = 'com/' AND verdict <> 'allow' OR rule = 'net/fr/' AND verdict <> 'block'").count() == 0


def test_lm_learns_from_every_training_row(spark):
    """Classes and weights change with a row that the starting sample does not hold."""
    rows = [(i, " ".join(cases.prose(i, 60))) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    vocabulary = lm_score.read_vocabulary()
    counts = np.zeros(2 * len(vocabulary) + 2)
    counts[: 400] = 50
    picked = docs.withColumn("h", F.xxhash64("doc_id", "text")).orderBy("h", "doc_id").limit(5).select("doc_id", "text").coalesce(1)
    few, all_rows = (lm_score.fit(d, vocabulary, counts, 5) for d in (picked, docs))
    assert not np.allclose(few.p["c"], all_rows.p["c"])
    assert (few.classes != all_rows.classes).any()
