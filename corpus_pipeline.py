"""From raw documents to subword ids in five stages, each written and read again.

A stage is ``(name, function)``; the function takes ``(spark, docs, sf_dir)`` and returns what the next stage
gets as its documents.  All but the last return the columns of ``documents``.

* ``toxicity`` drops documents that score 0.5 or more, learning from ``labels``.
* ``near_duplicates`` keeps one document of each group of linked ones, that with the smallest id (of several with
  that id, that with the smallest hash of its text); rows equal in id and text are one.  A null id is in no group and stays.
* ``repeated_passages`` takes out passages that an earlier document has; a document left without
  a word goes.  A text that loses nothing stays as it is.
* ``benchmark_leaks`` drops documents that hold a window of a benchmark item.
* ``subwords`` gives the ids of each text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotaflow.llm import decontaminate, jaccard, pieces, repeats, toxicity
from quotaflow.llm.base import crc_mod, ship, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
_REST = COLUMNS[2:]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    labels = table(spark, sf_dir, "labels").where(crc_mod(F.col("doc_id"), 5) != 0)
    scored = toxicity.score(docs, toxicity.fit(docs, labels), keep=("text", *_REST))
    return scored.where("score < 0.5").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    groups = jaccard.join(docs, detail=True).where("doc_id IS NOT NULL")
    row = F.struct("doc_id", "text_hash")
    first = groups.where("component IS NOT NULL").groupBy("component").agg(F.min(row).alias("row")).select("row.*")
    # Documents without words are linked with nothing.
    kept = first.unionByName(groups.where("component IS NULL").select("doc_id", "text_hash")).distinct()
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    one = hashed.join(kept, ["doc_id", "text_hash"], "left_semi").dropDuplicates(["doc_id", "text"])
    return one.select(*COLUMNS).unionByName(docs.where("doc_id IS NULL").select(*COLUMNS))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    found = repeats.remove_repeats(docs, keep=("text", *_REST))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    left = found.where("n_removed = 0 OR n_removed < n_words").withColumn("text", text)
    return left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"), keep=("text", *_REST))
    return found.where("n_hit = 0").select(*COLUMNS)


def to_subwords(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    encoded = pieces.encode(docs, pieces.load(), keep=(F.col("lang"), F.col("source")))
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_pieces"), "ids", "lossless")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("benchmark_leaks", drop_leaks),
    ("subwords", to_subwords),
]

# The classifier and the keyed merges are no SQL; tests hold the stages against plain definitions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
