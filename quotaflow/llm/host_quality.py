"""Quality rules of documents and of the hosts they come from.

Each text gives counts (words, symbols, repeated lines, words in repeated 8-word
windows, exclamation marks).  Soft rules compare them with limits.  Failures are summed
by host; the failure rate of a host is shrunk by a beta prior fitted to all hosts by
moments, so that a host of few documents stays near the common rate.  The shrunken rate
gives the host a verdict (``trusted``, ``usual``, ``strict``), and the verdict the factor
by which the limits of its documents are stretched or tightened.

Only DataFrame functions run here; nothing is aggregated before its per-host partial
sums, and only numbers are shuffled, never texts.  The counts and the verdicts of the hosts
are written to the shared folder once, so this starts jobs when it is called.

Defined cases: a null text has no words and fails the base rules; a null source is a
host of its own, apart from the empty one; repeated rows count as often as they occur; one host alone has no
spread, so the prior is at its strongest; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import small_side
from .base import written

WORD_GAP = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
WINDOW = 8
# Soft limits, in hundredths of the words (of the lines, for repeated lines).
SYMBOLS, SHOUTS, DUP_LINES, MEAN_WORD = 10, 30, 50, 1200
# Shrunken failure rates below and above which a host is trusted or strict, in hundredths.
TRUSTED, STRICT = 2, 50
STRETCH, TIGHTEN = 2.0, 0.5
# Bounds of the prior's weight, in documents.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 1000.0


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed a single time per row."""
    return F.transform(F.array(value), use)[0]


def repeat_words(words: Column, size: int = WINDOW) -> Column:
    """Words that lie in a window of ``size`` words found twice or more in the array."""

    def count(hashes: Column) -> Column:
        def spread(ordered: Column) -> Column:
            twin = lambda x, i: (
                F.coalesce(F.get(ordered, i - 1)["h"] == x["h"], F.lit(False))
                | F.coalesce(F.get(ordered, i + 1)["h"] == x["h"], F.lit(False))
            )
            starts = F.array_sort(F.transform(F.filter(ordered, twin), lambda x: x["i"]))
            return F.aggregate(
                starts,
                F.struct(F.lit(0).cast("long").alias("n"), F.lit(-size).alias("last")),
                lambda a, s: F.struct(
                    (a["n"] + F.least(F.lit(size), s - a["last"])).alias("n"), s.alias("last")
                ),
                lambda a: a["n"],
            )

        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            once(F.sort_array(pairs), spread)
        )

    windows = F.transform(F.sequence(F.lit(1), F.size(words) - size + 1), lambda i: F.xxhash64(F.slice(words, i, size)))
    return F.when(F.size(words) <= size, F.lit(0).cast("long")).otherwise(once(windows, count))


def measures(text: Column) -> Column:
    """A struct of the text's counts."""
    text = F.coalesce(text, F.lit(""))
    solid = F.trim(text, F.lit(BLANKS))
    words = F.when(solid == "", F.array().cast("array<string>")).otherwise(F.split(solid, WORD_GAP))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != "")
    of_words = once(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"),
        ),
    )
    of_lines = once(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    return F.struct(
        of_words.alias("words"),
        of_lines.alias("lines"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit("!")).cast("long").alias("n_shouts"),
    )


def soft_failures(scale: Column | float) -> list[Column]:
    """The soft rules; the limits of all shares are taken times ``scale``."""
    c = F.col
    return [
        100 * c("n_symbols") > scale * SYMBOLS * c("n_words"),
        100 * c("n_shouts") > scale * SHOUTS * c("n_words"),
        100 * c("n_dup_lines") > scale * DUP_LINES * c("n_lines"),
        100 * c("word_chars") > MEAN_WORD * c("n_words"),
    ]


def any_of(rules: list[Column]) -> Column:
    found = rules[0]
    for r in rules[1:]:
        found = found | r
    return found


def host_verdicts(counted: DataFrame) -> DataFrame:
    """Host, documents, failures and verdict, from the counts of the documents."""
    failed = any_of(soft_failures(1.0)) | F.col("base_failed")
    hosts = counted.groupBy("host").agg(
        F.count(F.lit(1)).alias("host_docs"), F.sum(failed.cast("long")).alias("host_failed")
    )
    rate = F.col("host_failed") / F.col("host_docs")
    prior = hosts.agg(
        (F.sum("host_failed") / F.sum("host_docs")).alias("m"), F.coalesce(F.var_pop(rate), F.lit(0.0)).alias("v")
    ).select(
        "m",
        F.when(F.col("v") > 0, F.greatest(F.lit(LEAST_WEIGHT), F.least(F.lit(MOST_WEIGHT), F.col("m") * (1 - F.col("m")) / F.col("v") - 1)))
        .otherwise(MOST_WEIGHT)
        .alias("weight"),
    )
    # One row by construction.
    mean, weight = prior.select("m").scalar(), prior.select("weight").scalar()
    shrunk = (F.col("host_failed") + mean * weight) / (F.col("host_docs") + weight)
    return hosts.select(
        "host",
        "host_docs",
        "host_failed",
        F.when(100 * shrunk < TRUSTED, "trusted").when(100 * shrunk > STRICT, "strict").otherwise("usual").alias("host_verdict"),
    )


def judge(docs: DataFrame) -> DataFrame:
    """One row per document: its counts, the base rules, the verdict of its host, and whether it is kept."""
    raw = docs.select("doc_id", F.col("source").cast("string").alias("host"), measures(F.col("text")).alias("m"))
    counted = raw.select("doc_id", "host", "m.words.*", "m.lines.*", "m.n_symbols", "m.n_shouts").withColumn(
        "base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    )
    counted = written(counted, "host-quality")
    scale = F.when(F.col("host_verdict") == "trusted", STRETCH).when(F.col("host_verdict") == "strict", TIGHTEN).otherwise(1.0)
    # Documents stay where they are while the hosts are few enough; a null host meets itself.
    hosts = small_side(written(host_verdicts(counted), "host-verdicts").withColumnRenamed("host", "of_host"))
    return counted.join(hosts, F.col("host").eqNullSafe(F.col("of_host"))).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~any_of(soft_failures(scale))).alias("kept"),
        "host_verdict",
    )
