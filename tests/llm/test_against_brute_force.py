"""Operators and registered queries against plain definitions."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import brute
import cases
import pytest
from pyspark.sql import functions as F

from quotaflow.llm import decontaminate, host_quality, jaccard, repeats
from quotaflow.llm.queries import QUERIES


def bag(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def pairs_of(spark, sf_dir, table="documents", key="doc_id"):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{table}.parquet").select(key, "text").collect()]


def test_quality_counts(spark, sf_dir):
    found = QUERIES["op1_quality_rules"](spark, sf_dir).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )
    wanted = [(i, *(c := brute.base_counts(t)), c[0] < 20 or 100 * c[4] > 30 * c[0]) for i, t in pairs_of(spark, sf_dir)]
    assert bag(found.collect()) == bag(wanted)


def test_quality_cases(spark):
    found = host_quality.judge(cases.docs(spark))
    counts = found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert bag(counts.collect()) == bag((i, *brute.base_counts(t)) for i, t in cases.pairs())
    assert found.where("base_failed AND kept").count() == 0
    assert host_quality.judge(cases.docs(spark).limit(0)).count() == 0


def test_hosts_move_the_limits(spark):
    """The same text is judged by the host it comes from."""
    clean, bad = " ".join(cases.prose(1, 40)), " ".join(w + "##" for w in cases.prose(2, 40))
    doubtful = " ".join([w + "#" if i % 12 == 0 else w for i, w in enumerate(cases.prose(3, 48))])
    rows = [(i, clean, "good") for i in range(300)] + [(1000 + i, bad, "bad") for i in range(100)]
    rows += [(2000, doubtful, "good"), (2001, doubtful, "bad"), (2002, clean, "bad")]
    found = host_quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    kept = {r["doc_id"]: (r["kept"], r["host_verdict"]) for r in found.where("doc_id >= 2000").collect()}
    assert kept == {2000: (True, "trusted"), 2001: (False, "strict"), 2002: (True, "strict")}


def test_a_null_host_is_not_the_empty_one(spark, monkeypatch):
    clean, bad = " ".join(cases.prose(1, 40)), " ".join(w + "##" for w in cases.prose(2, 40))
    rows = [(i, clean, None) for i in range(300)] + [(1000 + i, bad, "") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    wanted = {("trusted", True, 300), ("strict", False, 100)}
    assert {tuple(r) for r in host_quality.judge(docs).groupBy("host_verdict", "kept").count().collect()} == wanted
    # The same without a broadcast.
    monkeypatch.setattr(host_quality, "small_side", lambda hosts: hosts)
    assert {tuple(r) for r in host_quality.judge(docs).groupBy("host_verdict", "kept").count().collect()} == wanted


def test_an_automaton_fits_a_worker():
    """A share of the benchmark at its limit takes less than 600 MB."""
    code = f"""
import random, resource, sys
sys.path.insert(0, {str(Path(decontaminate.__file__).parents[2])!r})
from quotaflow.llm import decontaminate as d
r, items, size = random.Random(0), [], 0
while size < d.AUTOMATON_BYTES:
    items.append((len(items), " ".join("w%x" % r.randrange(1 << 20) for _ in range(40)).encode()))
    size += len(items[-1][1])
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
machine = d.build(d.patterns(iter(items), d.WINDOW))
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    told = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, timeout=300)
    assert int(told.stdout) < 600


def test_repeats(spark, sf_dir):
    found = QUERIES["op6_substring_dedup"](spark, sf_dir)
    assert bag(found.collect()) == bag(brute.repeats(pairs_of(spark, sf_dir), repeats.WINDOW))


@pytest.mark.parametrize("size", [50, 7])
def test_repeats_cases(spark, size):
    found = repeats.remove_repeats(cases.docs(spark), size)
    assert bag(repeats.digest(found).collect()) == bag(brute.repeats(cases.pairs(), size))


def test_repeats_in_many_chunks(spark, monkeypatch):
    from quotaflow.llm import chunks

    monkeypatch.setattr(chunks, "sizes", lambda docs: (7, 5))
    found = repeats.remove_repeats(cases.docs(spark))
    assert bag(repeats.digest(found).collect()) == bag(brute.repeats(cases.pairs(), 50))


def test_repeats_of_nothing(spark):
    assert repeats.remove_repeats(cases.docs(spark).limit(0)).count() == 0


def test_leaks(spark, sf_dir):
    found = QUERIES["op9_benchmark_decontamination"](spark, sf_dir)
    items = pairs_of(spark, sf_dir, "benchmark", "item_id")
    assert bag(found.collect()) == bag(brute.leaks(pairs_of(spark, sf_dir), items))


@pytest.mark.parametrize("limit", [1 << 20, 40])
def test_leaks_cases(spark, limit):
    """The second limit makes one automaton per item."""
    items = [(5, "one, two: THREE"), (5, "w1"), (40, " ".join(cases.prose(4, 30))), (7, None), (None, "one"), (8, "..."), (9, "Wörds")]
    found = decontaminate.find_leaks(cases.docs(spark), spark.createDataFrame(items, "item_id long, text string"), limit=limit)
    assert bag(decontaminate.digest(found).collect()) == bag(brute.leaks(cases.pairs(), items))


def test_leak_spans_lie_in_the_text(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    text = "é! Alpha,\n\nBETA -- gamma? alpha beta"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = decontaminate.find_leaks(docs, items).collect()
    assert [text.encode()[s["start"] : s["end"]].decode() for s in row["spans"]] == ["Alpha,\n\nBETA -- gamma"]


def test_leaks_without_items_or_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(cases.docs(spark), none).where("n_hit > 0").count() == 0
    assert decontaminate.find_leaks(cases.docs(spark).limit(0), none).count() == 0


def test_one_automaton_is_kept_and_found_by_its_name():
    class Share:
        """Stands for a broadcast; two may come to lie at one address."""

    share = Share()
    share.value = [(1, b"an earlier item")]
    assert decontaminate.scan(b"an earlier item", decontaminate._machine("first", share, 10))[2] == [1]
    share.value = [(2, b"a later item")]
    machine = decontaminate._machine("second", share, 10)
    assert decontaminate.scan(b"a later item", machine)[2] == [2]
    assert decontaminate._built == {"second": machine}


def test_shares_are_scanned_one_after_the_other(spark):
    docs = spark.createDataFrame([(1, "x one two three y"), (2, "four five six"), (3, None), (4, "one two three four five six")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "one two three"), (8, "four five six"), (9, "three four")], "item_id long, text string")
    whole, parts = (decontaminate.find_leaks(docs, items, keep=("text",), limit=n) for n in (1 << 20, 1))
    assert whole.columns == parts.columns
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))
    assert len(list(decontaminate._share(items, 1))) == 3


def test_groups(spark, sf_dir):
    found = QUERIES["op10_ngram_jaccard_join"](spark, sf_dir)
    assert bag(found.collect()) == bag(brute.groups(pairs_of(spark, sf_dir)))


@pytest.mark.parametrize("percent", [80, 50])
def test_groups_cases(spark, percent):
    pairs = [(i, t) for i, t in dict.fromkeys(cases.pairs()) if i != cases.rows()[5][0]]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    assert bag(jaccard.join(docs, percent=percent).collect()) == bag(brute.groups(pairs, percent=percent))
    assert jaccard.join(docs.limit(0)).count() == 0


def test_chains_of_near_copies(spark, monkeypatch):
    """Each text is near the next only, so hubs alone don't connect them."""
    from quotaflow.llm import chunks

    monkeypatch.setattr(chunks, "sizes", lambda docs: (5, 3))
    monkeypatch.setattr(jaccard, "GROUP", 3)
    pairs = []
    for chain in range(6):
        words = cases.prose(50 + chain, 100)
        for step in range(12):
            words = words.copy()
            for k in range(2):
                words[(step * 17 + k * 41) % 100] = f"new{chain}_{step}_{k}"
            pairs.append((chain * 1000 + (step * 7) % 12, " ".join(words)))
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    assert bag(jaccard.join(docs).collect()) == bag(brute.groups(pairs))


def test_repeated_rows_are_one_class(spark):
    row = (4, " ".join(cases.prose(9, 30)))
    found = jaccard.join(spark.createDataFrame([row, row, (2, row[1])], "doc_id long, text string"))
    assert bag(found.select("doc_id", "component_id").collect()) == [(2, 2), (4, 2), (4, 2)]


def test_search_finds_what_all_pairs_find():
    import numpy as np

    r = np.random.default_rng(4)
    for trial in range(20):
        base = [set(r.integers(0, 400, 40).tolist()) for _ in range(4)]
        sets = []
        for k in range(30):
            s = set(base[k % 4])
            for _ in range(int(r.integers(0, 7))):
                s.discard(next(iter(s)))
                s.add(int(r.integers(1000, 5000)))
            sets.append(np.array(sorted(s), np.uint64))
        links = {(i, j) for i in range(30) for j in range(i) if jaccard.links(len(np.intersect1d(sets[i], sets[j])), len(sets[i]), len(sets[j]), 80)}
        found = jaccard.search(sets, 80, trial % 30)
        assert {tuple(sorted(p, reverse=True)) for p in found} <= links

        def parts(pairs):
            name = list(range(30))
            for _ in range(30):
                for i, j in pairs:
                    name[i] = name[j] = min(name[i], name[j])
            return name

        assert parts(found) == parts(links)


def test_components_of_a_long_path(spark):
    from quotaflow.llm.components import components

    links = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = components(links)
    assert found.where("least <> 0").count() == 0 and found.select("node").distinct().count() == 201
    assert components(links.limit(0)).count() == 0


def test_components_on_many_shuffle_partitions(spark):
    """A round is at most four exchanges and one file for few links, whatever the number of partitions."""
    from quotaflow.llm import components as C

    links = spark.createDataFrame([(7, 3), (3, 5), (9, 9), (12, 11), (5, 7)], "a long, b long")
    turn = C._round(links)
    turn.collect()
    plan = turn._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    done = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "ReusedExchange" not in line]
    assert len(done) <= 4
    found = C.components(links)
    assert {tuple(r) for r in found.collect()} == {(3, 3), (5, 3), (7, 3), (11, 11), (12, 11)}
    assert len(found.inputFiles()) == 1
