"""Licence notices in documents: MinHash bands retrieve templates, shingles verify them.

Texts and templates are lower-cased (A-Z) words of ASCII letters and digits, and shingles of
``SHINGLE`` of them.  A text is cut into windows of twice the template's length class,
each one class length after the last, so a notice lies whole in some window.  A window
and a template share a band when one of ``BANDS`` minima of keyed hashes over their
shingles is equal.  A window that holds the required ``CONTAINMENT`` of a template has a
Jaccard similarity of at least ``containment / (windows' size over template's + 1 -
containment)`` with it; with one row per band all bands miss with a probability below
``(1 - that) ** BANDS``, which ``miss_bound`` computes.  It grows with the windows' size over
the template's.  A template with a bound above ``MISS`` is retrieved by shingles as well: of
its ``n``, any ``n - need + 1`` have one in every window that holds the ``need`` required, so
looking these up misses nothing.
Retrieved pairs are verified by exact containment of the template's shingles.

Before windows are made, a document must have one of the templates' rare words; every
template has them in more than ``1 - CONTAINMENT`` of its shingles, so none is lost.

Only DataFrame functions run here; texts are not shuffled, only the retrieved windows'
numbers are.  Defined cases: null, empty and wordless texts match nothing; rows with the
same id are taken as one document; a null id keeps its matches under null; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE = 3
BANDS = 48
CONTAINMENT = 0.8
# Largest probability of a miss up to which bands alone retrieve a template.
MISS = 1e-6
# Template length classes, in words.
CLASSES = (4, 8, 16, 32, 64)

# Wordings of public licence notices.
TEMPLATES = {
    "apache-2.0-short": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "mit-short": "Released under the MIT License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction"
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met"
    ),
    "gpl-3.0-short": "This work is licensed under the GNU General Public License, version 3.",
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation"
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-nc-4.0-short": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "all-rights": "All rights reserved.",
}
# Words too common to tell a notice.
COMMON = frozenset(
    "a all and any are as at by can deal do except file following for form forms free in is it may met not of on or "
    "person program provided source that the this to under use with without work you".split()
)


def template_words(text: str) -> list[str]:
    lower = text.translate(str.maketrans(ascii_uppercase, ascii_lowercase))
    return "".join(c if c.isascii() and c.isalnum() else " " for c in lower).split()


def template_shingles(words: list[str]) -> set[str]:
    return {" ".join(words[i : i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}


def size_class(n: int) -> int:
    return next((c for c in CLASSES if n <= c), CLASSES[-1] * -(-n // CLASSES[-1]))


def rare_words(templates: Mapping[str, str], containment: float = CONTAINMENT) -> list[str]:
    """The words a document must have one of; fails if a template could be met without them."""
    rare = {w for text in templates.values() for w in template_words(text)} - COMMON
    for name, text in templates.items():
        shingles = template_shingles(template_words(text))
        if sum(not rare & set(s.split()) for s in shingles) >= containment * len(shingles):
            raise ValueError(f"template {name} has too few rare words")
    return sorted(rare)


def miss_bound(shingles: int, window: int, containment: float = CONTAINMENT, bands: int = BANDS) -> float:
    """Largest probability that no band retrieves a template that a window contains."""
    jaccard = containment * shingles / (window - SHINGLE + 1 + (1 - containment) * shingles)
    return (1 - min(1.0, jaccard)) ** bands


def looked_up(words: list[str], containment: float = CONTAINMENT) -> list[str]:
    """The shingles by which windows are looked up for a template; none where the bands do."""
    shingles = sorted(template_shingles(words), key=lambda s: (sum(w in COMMON for w in s.split()), -len(s), s))
    n = len(shingles)
    if miss_bound(n, 2 * size_class(len(words)), containment) <= MISS:
        return []
    need = next(k for k in range(n + 1) if k / n >= containment)
    return shingles[: n - need + 1]


def text_words(text: Column) -> Column:
    lower = F.translate(text, ascii_uppercase, ascii_lowercase)
    return F.filter(F.split(lower, "[^a-z0-9]+"), lambda w: w != "")


def _shingles(words: Column) -> Column:
    """Distinct shingles of a word array; a shorter one is a single shingle."""
    places = F.sequence(F.lit(1), F.greatest(F.size(words) - SHINGLE + 1, F.lit(1)))
    return F.array_distinct(F.transform(places, lambda i: F.array_join(F.slice(words, i, SHINGLE), " ")))


def _bands(shingles: Column) -> Column:
    """The minima of the keyed hashes, each with its band number folded in."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda k: F.xxhash64(k, F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, k)))),
    )


def _with_looked_up(bands: Column, shingles: Column) -> Column:
    """The bands with the hashes of looked-up shingles, which have no band number."""
    return F.concat(bands, F.transform(shingles, lambda s: F.xxhash64(F.lit("shingle"), s)))


def _place(size: int):
    """Names a window by its class and first word."""
    return lambda first: F.struct(F.lit(size).alias("class"), first.alias("first"))


def find_licences(
    docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, containment: float = CONTAINMENT
) -> DataFrame:
    """One row per document and template found: ``doc_id``, ``template``, ``containment``, ``first_word``, ``n_windows``."""
    spark = docs.sparkSession
    rare = rare_words(templates, containment)
    rows = [(name, template_words(text)) for name, text in templates.items()]
    classes = sorted({size_class(len(words)) for _, words in rows})
    direct = {n: looked_up(w, containment) for n, w in rows}
    known = (
        spark.createDataFrame([(n, w, size_class(len(w)), direct[n]) for n, w in rows], "template string, words array<string>, class int, direct array<string>")
        .select("template", "class", "direct", _shingles(F.col("words")).alias("wanted"))
        .select("template", "class", "wanted", F.explode(_with_looked_up(_bands(F.col("wanted")), F.col("direct"))).alias("band"))
    )
    watched = F.lit(sorted({s for found in direct.values() for s in found})).cast("array<string>")
    # A cheap test on the raw text first, then on whole words.
    marks = reduce(lambda a, b: a | b, [F.contains(F.lower("text"), F.lit(w)) for w in _stems(rare, templates, containment)])
    worded = docs.select("doc_id", "text").where(marks).select("doc_id", text_words(F.col("text")).alias("words"))
    worded = worded.where(F.arrays_overlap("words", F.array(*map(F.lit, rare))))
    starts = F.array(
        *[
            F.transform(F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(c)), _place(c))
            for c in classes
        ]
    )
    cut = worded.select("doc_id", "words", F.explode(F.flatten(starts)).alias("at")).select(
        "doc_id", "at.class", "at.first", F.slice("words", F.col("at.first") + 1, 2 * F.col("at.class")).alias("words")
    )
    cut = cut.where(F.arrays_overlap("words", F.array(*map(F.lit, rare))))
    shingled = cut.select("doc_id", "class", "first", _shingles(F.col("words")).alias("has"))
    retrieved = (
        shingled.select("doc_id", "class", "first", "has", F.explode(_with_looked_up(_bands(F.col("has")), F.array_intersect("has", watched))).alias("band"))
        .join(F.broadcast(known), ["class", "band"])
        .select(
            "doc_id", "template", "first",
            (F.size(F.array_intersect("has", "wanted")) / F.size("wanted")).alias("share"),
        )
        .where(F.col("share") >= containment)
    )
    return retrieved.groupBy("doc_id", "template").agg(
        F.max("share").alias("containment"),
        F.min("first").cast("long").alias("first_word"),
        F.count_distinct("first").alias("n_windows"),
    )


def _stems(rare: list[str], templates: Mapping[str, str], containment: float) -> list[str]:
    """A few rare words such that each template that is met has one of them in the text.

    Taken greedily by the number of templates they mark; a word marks a template when
    fewer than the required shingles are without it.
    """
    shingles = {n: template_shingles(template_words(t)) for n, t in templates.items()}
    left, chosen = set(templates), []

    def safe(words: list[str], name: str) -> bool:
        without = sum(not any(w in s.split() for w in words) for s in shingles[name])
        return without < containment * len(shingles[name])

    while left:
        best = max(rare, key=lambda w: (sum(safe([*chosen, w], n) for n in left), sum(w in s.split() for n in left for s in shingles[n])))
        chosen.append(best)
        rare = [w for w in rare if w != best]
        left = {n for n in left if not safe(chosen, n)}
    return chosen
