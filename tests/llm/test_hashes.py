"""Words that collide in polynomials modulo a power of two are told apart."""

from __future__ import annotations

import random

import brute
import pyarrow as pa
import pytest

from quotaflow.llm import jaccard, lm_score, repeats, scan


def thue_morse(n: int, first: str = "a", second: str = "b") -> str:
    return "".join(first if i.bit_count() % 2 == 0 else second for i in range(n))


A, B = thue_morse(1024), thue_morse(1024, "b", "a")
SCHEMA = "doc_id long, text string"


def bag(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_hashes_follow_the_words():
    r = random.Random(1)
    given = [A, B, A + "c", "c" + A, A[:-1]] + ["a" * n for n in range(1, 40)] + ["\0" * n for n in range(1, 20)]
    given += ["abcdefgh" + "ijklmnop", "ijklmnop" + "abcdefgh", "abcdefghabcdefgh", "abcdefgh"]
    given += ["".join(r.choice("abé") for _ in range(r.randrange(1, 60))) for _ in range(3000)]
    words = sorted(set(given))
    texts = [" ".join(words[i : i + 7]) for i in range(0, len(words), 7)]
    found = scan.words(pa.array(texts))
    assert len(found.hashes) == len(words) == len(set(found.hashes.tolist()))
    # The same wherever they stand.
    again = scan.words(pa.array([" \n".join(reversed(words)), None, words[0]]))
    assert again.hashes.tolist() == [*found.hashes.tolist()[::-1], found.hashes[0]]
    assert scan.words(pa.array(["ABC É"]), lower=True).hashes.tolist() == scan.words(pa.array(["abc É"])).hashes.tolist()


@pytest.mark.parametrize("at", [0, 20, 49])
def test_a_passage_with_another_word_stays(spark, at):
    rest = [f"w{i}" for i in range(49)]
    texts = [" ".join([*rest[:at], word, *rest[at:]]) for word in (A, B, A)]
    rows = list(enumerate(texts))
    found = repeats.digest(repeats.remove_repeats(spark.createDataFrame(rows, SCHEMA)))
    assert bag(found.collect()) == bag(brute.repeats(rows, repeats.WINDOW))
    assert [r["n_removed"] for r in found.orderBy("doc_id").collect()] == [0, 0, 50]


def test_other_words_are_not_linked(spark):
    rows = [(1, A), (2, B), (3, A), (4, f"{A} x y z v w"), (5, f"{B} x y z v w")]
    found = jaccard.join(spark.createDataFrame(rows, SCHEMA))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def test_words_are_counted_apart(spark):
    rows = [(i, text, True) for i, text in enumerate([A, A, B, "plain words " * 30])]
    docs = spark.createDataFrame(rows + [(9, f"{B} {A}", False)], "doc_id long, text string, learn boolean")
    scored = {r["doc_id"]: r for r in lm_score.score(docs, lm_score.read_vocabulary()).collect()}
    # Two of A, one of B, sixty plain words and four ends.
    import math

    log = lambda c: math.log10((c + 0.1) / (67 + 0.1 * 6))
    assert scored[9]["train_tokens"] == 67 and scored[9]["base_score"] == pytest.approx(log(1) + log(2) + log(4))
