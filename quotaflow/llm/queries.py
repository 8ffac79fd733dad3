"""One query per operator, with its production parameters, over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, hash_ring, host_quality, jaccard, language, licences, lm_score, oracles, pieces, repeats, token_align, toxicity, url_rules, whitening
from .base import crc_mod, ship, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, d: str) -> DataFrame:
            ship(spark)
            return build(spark, d)

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return build

    return add


@query("op1_quality_rules", oracles.OP1)
def quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return host_quality.judge(table(spark, d, "documents"))


@query("op2_language_id")
def language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    net = language.fit(docs.where(~held_out))
    return language.identify(docs, net, keep=(held_out.alias("held_out"),))


@query("op3_toxicity")
def toxicity_scores(spark: SparkSession, d: str) -> DataFrame:
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    held_out = crc_mod(F.col("doc_id"), 5) == 0
    scorer = toxicity.fit(docs, labels.where(~held_out))
    scored = toxicity.score(docs, scorer, keep=(held_out.alias("held_out"),))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op4_url_filters")
def url_filters(spark: SparkSession, d: str) -> DataFrame:
    return url_rules.judge(table(spark, d, "pages"))


@query("op5_sentencepiece")
def sentencepiece_ids(spark: SparkSession, d: str) -> DataFrame:
    return pieces.digest(pieces.encode(table(spark, d, "documents"), pieces.load()))


@query("op6_substring_dedup", oracles.OP6)
def substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return repeats.digest(repeats.remove_repeats(table(spark, d, "documents")))


@query("op7_lm_scoring")
def lm_scoring(spark: SparkSession, d: str) -> DataFrame:
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 10) == 0, F.lit(False))
    docs = table(spark, d, "documents").select("doc_id", "text", (~held_out & F.col("doc_id").isNotNull()).alias("learn"))
    scored = lm_score.score(docs, lm_score.read_vocabulary())
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op8_licence_scan")
def licence_scan(spark: SparkSession, d: str) -> DataFrame:
    return licences.find_licences(table(spark, d, "documents"))


@query("op9_benchmark_decontamination", oracles.OP9)
def benchmark_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.digest(
        decontaminate.find_leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))
    )


@query("op10_ngram_jaccard_join", oracles.OP10)
def ngram_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return jaccard.join(table(spark, d, "documents"))


@query("op11_token_alignment")
def token_alignment(spark: SparkSession, d: str) -> DataFrame:
    return token_align.digest(token_align.align(table(spark, d, "documents")))


@query("op12_sharding", oracles.OP12)
def sharding(spark: SparkSession, d: str) -> DataFrame:
    return hash_ring.digest(hash_ring.assign(table(spark, d, "documents")))


@query("op13_embedding_whitening")
def embedding_whitening(spark: SparkSession, d: str) -> DataFrame:
    vectors = table(spark, d, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))
