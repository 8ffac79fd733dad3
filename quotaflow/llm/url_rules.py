"""URL filter: given host and path rules first, association rules for the rest.

The urls that a given rule decides are the labels.  Their tokens (host labels, path
segments, query keys; digits count as one token) and verdicts are transactions for
FP-growth.  Rules *tokens -> verdict* are kept from a confidence and a support on, and
dropped when a rule with one token less says the same with no less confidence.  An
inverted index, token to rule, finds the rules all of whose tokens a url has; the most
confident one decides (then support, then the number of tokens, then their names).

What pruning would drop anyway is left out of the mining, so that a frequent url with many
tokens does not give all subsets of them:

* Tokens that occur in the same labelled urls say the same; they are one class, named by
  its first token.  Any token of a class stands for it when urls are matched.
* A token with one verdict only, or in all labelled urls, gains nothing from a further
  token: its rules are counted, not mined.

Many tokens that differ in their urls and have both verdicts are still mined together.

Only DataFrame functions and FP-growth run here.  Mined rules are written to the
shared folder once, so this starts jobs when it is called.

Defined cases: a null url or one without ``://`` has an empty host and path, no rule and
no token, and gets ``DEFAULT``; repeated rows are judged, and count as labels, as often as
they occur; an empty table gives an empty result; without labelled urls nothing is mined;
columns other than ``page_id`` and ``url`` are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import is_small
from .base import written

# Fixed values: (host, path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
DEFAULT = "allow"
CONFIDENCE = 0.9
SUPPORT = 0.02
_MARK = "verdict="


def split_url(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), ascii_uppercase, ascii_lowercase)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def match_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null without one."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, what in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, what).otherwise(verdict)
    return name, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Sorted distinct tokens; runs of digits are one token each."""
    plain = lambda c: F.regexp_replace(c, "[0-9]+", "0")
    query = F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&")
    found = F.concat(
        F.transform(F.split(plain(host), r"\."), lambda t: F.concat(F.lit("host="), t)),
        F.transform(F.split(plain(path), "/"), lambda t: F.concat(F.lit("path="), t)),
        F.transform(query, lambda t: F.concat(F.lit("query="), plain(F.substring_index(t, "=", 1)))),
    )
    return F.array_sort(F.array_distinct(F.filter(found, lambda t: ~t.endswith("="))))


def classes_of(labelled: DataFrame, least: int) -> DataFrame:
    """``token``, its class ``name``, its urls ``n``, and ``verdicts`` with their urls; tokens of ``least`` urls and more.

    Tokens are of one class if their urls are the same: equal numbers of urls and equal 128-bit sums over
    the distinct urls.  There are at most 1 / support times as many as a url has tokens, on average.
    """
    kinds = labelled.groupBy("tokens", "verdict").agg(F.count(F.lit(1)).alias("n"))
    seen = kinds.select(
        F.explode("tokens").alias("token"), "verdict", "n",
        F.xxhash64("tokens", "verdict").alias("a"), F.xxhash64(F.lit(1), "tokens", "verdict").alias("b"),
    )
    sums = [F.sum("n").alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b")]
    by_verdict = seen.groupBy("token", "verdict").agg(*sums)
    found = by_verdict.groupBy("token").agg(F.collect_list(F.struct("verdict", "n")).alias("verdicts"), *sums)
    name = F.min("token").over(Window.partitionBy("n", "a", "b"))
    return found.where(F.col("n") >= least).select("token", name.alias("name"), "n", "verdicts")


def mine(labelled: DataFrame, confidence: float, support: float) -> tuple[DataFrame, DataFrame]:
    """The pruned rules (``items``, ``says``, ``confidence``, ``support``), whose items are classes, and the classes."""
    total = labelled.count()
    least = max(1, math.ceil(support * total))
    classes = written(classes_of(labelled, least), "url-classes")
    heads = classes.where("token = name")
    # A further token makes no rule of these more confident.
    alone = (F.size("verdicts") == 1) | (F.col("n") == total)
    counted = (
        heads.where(alone)
        .select(F.array("name").alias("items"), "n", F.explode("verdicts").alias("v"))
        .select("items", F.col("v.verdict").alias("says"), (F.col("v.n") / F.col("n")).alias("confidence"), "v.n")
        .where((F.col("n") >= least) & (F.col("confidence") >= confidence))
        .select("items", "says", "confidence", (F.col("n") / F.lit(max(1, total))).alias("support"))
    )
    mixed = heads.where(~alone).agg(F.collect_list("name")).scalar()
    baskets = labelled.select(
        F.array_append(F.array_intersect("tokens", mixed), F.concat(F.lit(_MARK), "verdict")).alias("items")
    )
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    rules = model.associationRules.where(F.col("consequent")[0].startswith(_MARK)).select(
        F.array_sort("antecedent").alias("items"),
        F.substring(F.col("consequent")[0], len(_MARK) + 1, 99).alias("says"),
        "confidence",
        "support",
    )
    rules = written(rules.where(~F.exists("items", lambda t: t.startswith(_MARK))), "url-rules")
    shorter = rules.select(
        "items", "says", "confidence", F.explode("items").alias("left_out")
    ).select(
        F.col("items").alias("long"), "says", F.col("confidence").alias("much"),
        F.array_remove("items", F.col("left_out")).alias("items"),
    )
    idle = (
        shorter.join(rules, ["items", "says"])
        .where(F.col("confidence") >= F.col("much"))
        .select(F.col("long").alias("items"), "says")
        .distinct()
    )
    kept = rules.join(idle, ["items", "says"], "left_anti").unionByName(counted)
    return written(kept, "url-rules-kept"), classes


def _if_small(df: DataFrame) -> DataFrame:
    """Marked for broadcast behind a check of its size; lists are measured by their text."""
    return F.broadcast(df) if is_small(df.select(*(F.col(c).cast("string") for c in df.columns))) else df


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    confidence: float = CONFIDENCE,
    support: float = SUPPORT,
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, and the tokens of the mined rule that decided, if one did."""
    host, path = split_url(F.col("url"))
    parts = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = match_rule(F.col("host"), F.col("path"), rules)
    known = parts.select(
        "page_id", "host", "path", rule.alias("rule"), verdict.alias("given"),
        F.when(F.length("host") > 0, tokens(F.col("url"), F.col("host"), F.col("path")))
        .otherwise(F.array().cast("array<string>")).alias("tokens"),
    )
    labelled = known.where("given IS NOT NULL").select("tokens", F.col("given").alias("verdict"))
    mined, classes = mine(labelled, confidence, support)
    index = mined.select(
        F.explode("items").alias("name"), "items", "says", F.col("confidence").alias("sure"), F.col("support").alias("often")
    )
    # Urls with the same tokens are judged once: a host with a third of the pages is a few rows here.
    open_ones = known.where("given IS NULL")
    best = written(
        open_ones.select("tokens").distinct()
        .select("tokens", F.explode("tokens").alias("token"))
        .join(_if_small(classes.select("token", "name")), "token")
        .join(_if_small(index), "name")
        .groupBy("tokens", "items", "says", "sure", "often")
        .agg(F.size(F.collect_set("name")).alias("hits"))
        .where(F.col("hits") == F.size("items"))
        .groupBy("tokens")
        .agg(F.max(F.struct("sure", "often", F.size("items").alias("n"), "items", "says")).alias("best"))
        .select("tokens", F.col("best.says").alias("says"), F.col("best.items").alias("mined")),
        "url-judged",
    )
    # Pages that a given rule decides stay where they are.
    decided = known.where("given IS NOT NULL").select(
        "page_id", "host", "path", "rule", F.col("given").alias("verdict"), F.lit(None).cast("string").alias("mined_rule")
    )
    return decided.unionByName(
        open_ones.join(_if_small(best), "tokens", "left").select(
            "page_id", "host", "path", "rule",
            F.coalesce("says", F.lit(DEFAULT)).alias("verdict"),
            F.array_join("mined", " ").alias("mined_rule"),
        )
    )
