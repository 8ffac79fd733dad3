"""Stages of the pipeline against plain definitions on what each one gets."""

from __future__ import annotations

import brute
import cases
import corpus_pipeline as pipeline

from pyspark.sql import functions as F

from quotaflow.llm import pieces, toxicity
from quotaflow.llm.base import crc_mod, table


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    kept = pipeline.drop_toxic(spark, docs, sf_dir)
    assert set(ids(kept)) <= set(ids(docs)) and kept.columns == docs.columns
    labels = table(spark, sf_dir, "labels").where(crc_mod(F.col("doc_id"), 5) != 0)
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    assert ids(kept) == ids(scored.where("score < 0.5"))
    # What labels say of documents the classifier has not seen.
    told = {r["doc_id"]: r["toxic"] for r in table(spark, sf_dir, "labels").where(crc_mod(F.col("doc_id"), 5) == 0).collect()}
    right = [(i in set(ids(kept))) != bool(t) for i, t in told.items() if t is not None]
    assert sum(right) >= 0.9 * len(right)

    one = pipeline.drop_near_duplicates(spark, kept, sf_dir).cache()
    assert ids(one) == sorted(i for i, _, c in brute.groups(pairs(kept)) if i == c)

    fresh = pipeline.drop_repeated_passages(spark, one, sf_dir).cache()
    judged = {i: (n, gone) for i, n, gone, _ in brute.repeats(pairs(one), 50)}
    before = dict(pairs(one))
    assert ids(fresh) == sorted(i for i, (n, gone) in judged.items() if gone < n or not gone)
    for r in fresh.collect():
        n, gone = judged[r["doc_id"]]
        assert len(brute.WORD.findall(r["text"])) == n - gone
        assert gone or r["text"] == before[r["doc_id"]]
        assert not gone or r["n_chars"] == len(r["text"])

    clean = pipeline.drop_leaks(spark, fresh, sf_dir).cache()
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").collect()]
    assert ids(clean) == sorted(r[0] for r in brute.leaks(pairs(fresh), items) if not r[5])

    last = pipeline.to_subwords(spark, clean, sf_dir)
    assert last.where("NOT lossless").count() == 0
    assert sorted(pairs(pieces.decode(last, pieces.load()))) == sorted(pairs(clean))
    assert last.columns[0] == "doc_id"


def test_one_row_of_each_group_where_ids_repeat(spark, sf_dir):
    a, b, c = (" ".join(cases.prose(s, 60)) for s in (1, 2, 3))
    rows = [(0, a), (1, a), (1, b), (2, b), (3, c), (3, c), (4, ""), (5, None), (5, " "), (None, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = pairs(pipeline.drop_near_duplicates(spark, docs, sf_dir))
    assert sorted(kept, key=repr) == sorted([(0, a), (1, b), (3, c), (4, ""), (5, None), (5, " "), (None, a)], key=repr)


def test_run(spark, sf_dir):
    assert pipeline.run(spark, sf_dir).count() > 0
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "benchmark_leaks", "subwords"]


def test_awkward_documents_pass(spark, sf_dir):
    docs = cases.docs(spark)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() > 0


def test_no_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
