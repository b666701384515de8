"""Licence notices in documents: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a line of a text or a run of neighbouring lines without an empty one (or one of punctuation
alone, such as a bare comment mark) between them, so wrapped and comment-prefixed notices are found; the lines
inside a run have no more words than the longest template. A paragraph has its word 1-, 2- and 3-grams as
hashed features. A multinomial logistic regression with an elastic-net penalty, so that few features weigh
anything, is trained on the templates of each family, also with words left out at either end, against half of
all distinct lines of the corpus as the unknown class. It is calibrated: the other half of all lines gives the
least probability at which at most ``FALSE_SHARE`` of the unknown lines with a feature that weighs anything
would be taken for a notice. The fit has the features whose bucket a template's gram is in; any other could
speak for the unknown class alone. A paragraph named
by the classifier is confirmed if it contains enough of the word pairs of a template of that family. Of
paragraphs that share lines, the one most like a template is kept.

A paragraph whose features cannot add up to a family's margin over the unknown class is left out first: it
lacks all of the few template grams without which that is impossible. Of each of these grams the word rarest in
the lines of the corpus is looked for, in the whole text by one pattern and then line by line; only texts with a hit
are cut into words, and only runs through a line with one are formed and hashed. Grams that merely share a
bucket with a template's do not make a notice alone. The weights that are not 0 are literals. After the
training all is one pass of DataFrame expressions over whole texts, without a shuffle.

Every distinct line with words is learnt from. Lines shuffle as a hash and what they share with the templates,
and the fit steps over these rows where they lie; the lines of the unknown class weigh ``UNKNOWN`` notices
together however many they are, so that the balance of the classes does not hang on the size of the corpus.

Defined cases: null and empty texts have no notices; every row is judged for itself, also if it repeats
another or has no id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm import common

BUCKETS = 1 << 14
#: Lines of the unknown class together weigh at most as much in the fit as so many notices.
UNKNOWN = 2000
FALSE_SHARE = 0.001
SIMILARITY = 0.6

#: Wording of licence notices, by family.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl-3": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "bsd-3-clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Licensed under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "all-rights-reserved": ["All rights reserved.", "Copyright (c). All rights reserved."],
}
FAMILIES = sorted(TEMPLATES)
_RUNS = "array<struct<first:int,last:int,w:array<string>>>"


class Model(NamedTuple):
    """``weights``: bucket, and weight by class (unknown first); ``telling``: words one of which a notice must have.

    ``threshold`` is the least probability of a family.
    """

    weights: list[tuple[int, list[float]]]
    telling: list[str]
    intercepts: list[float]
    threshold: float


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingles(tokens: Column, size: int) -> Column:
    last = F.size(tokens) - size
    joined = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(tokens, i + k) for k in range(size)]))
    return F.when(last >= 0, joined).otherwise(F.array().cast("array<bigint>"))


def buckets(tokens: Column) -> Column:
    """Buckets of the 1-, 2- and 3-grams."""
    grams = F.flatten(F.array(*[shingles(tokens, n) for n in (1, 2, 3)]))
    return _bucketed(grams)


def _bucketed(grams: Column) -> Column:
    return F.transform(grams, lambda g: F.pmod(g, F.lit(BUCKETS)).cast("int"))


def features(tokens: Column) -> Column:
    """Distinct buckets."""
    return F.array_distinct(buckets(tokens))


def paragraphs(text: Column) -> Column:
    """Tokens of every line of a text."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), words)


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(f, t) for f in FAMILIES for t in TEMPLATES[f]]
    return spark.createDataFrame(rows, "family string, template string").withColumn("w", words(F.col("template")))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), use), 0)


def _own_pairs(tokens: Column) -> Column:
    return F.array_distinct(F.concat(shingles(tokens, 2), F.slice(shingles(tokens, 1), 1, 1)))


def _share(own: Column, template_pairs: Column) -> Column:
    """Share of a template's word pairs (its words, if it has but one) that are among a paragraph's own."""
    return F.size(F.array_intersect(own, template_pairs)) / F.greatest(F.size(template_pairs), F.lit(1))


def _similarity(tokens: Column, template_pairs: Column) -> Column:
    return _share(_own_pairs(tokens), template_pairs)


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values])


def _ints(values: list[int]) -> Column:
    return F.expr(f"array({','.join(map(str, values))})").cast("array<int>")


def _pairs(tokens: Column) -> Column:
    two = F.array_distinct(shingles(tokens, 2))
    return F.when(F.size(two) > 0, two).otherwise(shingles(tokens, 1))


def train(documents: DataFrame) -> Model:
    """Fit on the templates and half the distinct lines of the corpus, calibrate on the other half."""
    spark = documents.sparkSession
    templates = _templates(spark)
    size = F.size("w")
    cuts = F.explode(F.sequence(F.lit(0), F.least(F.lit(4), size - 2))).alias("cut")
    cut = templates.filter(size > 2).select("family", "w", cuts)
    keep = F.size("w") - F.col("cut")
    known = cut.select("family", F.slice("w", 1, keep).alias("w")).unionByName(
        cut.select("family", F.expr("slice(w, cut + 1, size(w) - cut)").alias("w"))
    )
    known = known.unionByName(templates.select("family", "w")).select(
        (F.array_position(F.lit(FAMILIES), F.col("family"))).cast("int").alias("label"), "w"
    )
    lines = common.stored(corpus_lines(documents, templates), "lines")
    unknown = lines.filter("unknown")
    fitted = unknown.filter("fit")
    weight = min(1.0, UNKNOWN / max(fitted.count(), 1))
    data = fitted.select(F.lit(0).alias("label"), F.lit(weight).alias("weight"), "f").unionByName(
        known.select("label", F.lit(1.0).alias("weight"), features(F.col("w")).alias("f"))
    )
    told = _told(templates)
    # Sparse vectors without a Python worker: the buckets are the words of a vocabulary.
    vectors = CountVectorizerModel.from_vocabulary([str(b) for b in told], "f", "features")
    model = LogisticRegression(
        family="multinomial", regParam=0.002, elasticNetParam=0.8, maxIter=60, standardization=False, weightCol="weight"
    ).fit(vectors.transform(data.withColumn("f", F.col("f").cast("array<string>"))).drop("f"))
    matrix = model.coefficientMatrix.toArray()
    classes = len(FAMILIES) + 1
    full = [[0.0] * matrix.shape[1]] * (classes - matrix.shape[0]) + matrix.tolist()
    used = [(b, [row[i] for row in full]) for i, b in enumerate(told) if any(row[i] for row in full)]
    intercepts = [float(x) for x in model.interceptVector.toArray()]
    model = Model(used, [], intercepts, 0.0)
    own = F.array_sort(F.array_intersect("f", _ints([b for b, _ in used])))
    alike = unknown.filter(~F.col("fit")).groupBy(own.alias("own")).count().filter(F.size("own") > 0)
    # No threshold is less than 0.5, so the many lines below it need not be told apart.
    scored = alike.select(F.greatest(F.lit(0.5), _best(model)(F.col("own"))["probability"]).alias("p"), "count")
    held = scored.agg(F.expr(f"percentile(p, {1 - FALSE_SHARE}, count)")).first()[0]
    threshold = min(max(0.5, held or 0.0), 0.999)
    return model._replace(threshold=threshold, telling=_words_of(_telling(used, intercepts, threshold), templates, lines))


def _told(templates: DataFrame) -> list[int]:
    """The buckets of the grams of the templates."""
    return sorted({b for r in templates.select(features(F.col("w")).alias("f")).collect() for b in r.f})


def corpus_lines(documents: DataFrame, templates: DataFrame) -> DataFrame:
    """Every distinct line with words: to fit or to calibrate, unknown or like a template, and what it shares with the templates.

    ``f`` are its buckets that a template has, ``t`` the hashes of its words that a template has.
    """
    every = [r.p for r in templates.select(_pairs(F.col("w")).alias("p")).collect()]
    known = sorted({g for r in templates.select(shingles(F.col("w"), 1).alias("g")).collect() for g in r.g})
    corpus = documents.select(F.explode(F.split("text", "\n")).alias("line")).filter(F.col("line").rlike(r"[\p{L}\p{N}]"))
    cut = corpus.select(F.xxhash64("line", F.lit(5)).alias("draw"), words(F.col("line")).alias("w"))
    grams = cut.select("draw", *[shingles(F.col("w"), n).alias(f"g{n}") for n in (1, 2, 3)])
    told = _told(templates)
    in_told = lambda g: F.pmod(g, F.lit(BUCKETS)).isin(told)
    own = F.concat("g2", F.slice("g1", 1, 1))
    met = grams.select(
        "draw",
        F.array_distinct(_bucketed(F.filter(F.concat("g1", "g2", "g3"), in_told))).alias("f"),
        F.array_intersect("g1", _longs(known)).alias("t"),
        own.alias("own"),
        F.array_intersect(own, _longs(sorted({g for p in every for g in p}))).alias("shared"),
    )
    # Most lines share no pair with any template.
    common_pairs = F.array(*[F.size(F.array_intersect("shared", _longs(p))) for p in every])
    alike = lambda n: F.array_max(F.zip_with(n, _ints([max(len(p), 1) for p in every]), lambda x, y: x / y))
    # Nor is a line of a wrapped notice unknown: its own pairs are a template's.
    within = lambda n: F.array_max(n) / F.size(F.array_distinct("own"))
    strange = _let(common_pairs, lambda n: (alike(n) < 0.5) & (within(n) < 0.5))
    unknown = F.when(F.size("shared") > 0, strange).otherwise(True)
    return (
        met.select("draw", "f", "t", unknown.alias("unknown"))
        .dropDuplicates(["draw"])
        .select((F.col("draw") % 2 == 0).alias("fit"), "unknown", "f", "t")
    )


def _words_of(telling: list[int], templates: DataFrame, lines: DataFrame) -> list[str]:
    """Of each template gram in one of the buckets the word that is rarest in the lines of the corpus."""
    rows = templates.select("w", *[shingles(F.col("w"), n).alias(f"g{n}") for n in (1, 2, 3)]).collect()
    wanted = set(telling)
    grams = {
        tuple(r.w[i : i + n])
        for r in rows
        for n in (1, 2, 3)
        for i, g in enumerate(r[f"g{n}"])
        if g % BUCKETS in wanted
    }
    hashes = {w: g for r in rows for w, g in zip(r.w, r.g1)}
    often = {r.t: r["count"] for r in lines.select(F.explode("t").alias("t")).groupBy("t").count().collect()}
    return sorted({min(g, key=lambda w: (often.get(hashes[w], 0), -len(w), w)) for g in grams})


def _telling(used: list[tuple[int, list[float]]], intercepts: list[float], threshold: float) -> list[int]:
    """Buckets one of which a paragraph must have to be named.

    A family needs a margin over the unknown class of the intercepts' difference and the threshold's log
    odds. The weakest features that together stay below it are left out.
    """
    needed = intercepts[0] - max(intercepts[1:]) + math.log(threshold / (1 - threshold))
    gains = sorted((max(row[1:]) - row[0], b) for b, row in used if max(row[1:]) > row[0])
    while gains and gains[0][0] < needed:
        needed -= gains[0][0]
        gains.pop(0)
    return [b for _, b in gains]


def _best(model: Model) -> Callable[[Column], Column]:
    """probability and family of the likeliest family, from the buckets of a paragraph that weigh anything."""
    used = _ints([b for b, _ in model.weights])
    number = lambda x: f"{x!r}D"
    vector = lambda row: f"array({','.join(map(number, row))})"
    table = F.expr(f"array({','.join(vector(row) for _, row in model.weights)})").cast("array<array<double>>")
    intercepts = F.expr(vector(model.intercepts))
    families = F.array(*[F.lit(f) for f in FAMILIES])

    def best(own: Column) -> Column:
        weigh = lambda b: F.element_at(table, F.array_position(used, b).cast("int"))
        margins = F.aggregate(own, intercepts, lambda sums, b: F.zip_with(sums, weigh(b), lambda x, y: x + y))
        powers = _let(margins, lambda m: F.transform(m, lambda x: F.exp(x - F.array_max(m))))
        named = lambda p, total: F.transform(
            F.slice(p, 2, len(FAMILIES)),
            lambda x, i: F.struct((x / total).alias("probability"), F.get(families, i).alias("family")),
        )
        total = lambda p: F.aggregate(p, F.lit(0.0), lambda s, x: s + x)
        return _let(powers, lambda p: F.array_max(named(p, total(p))))

    return best


def _reach(sizes: Column, hit: Column, step: int, longest: int) -> Column:
    """How many lines before (step -1) or after (1) a line a run through it can take in."""

    def onward(state: Column, k: Column) -> Column:
        size = F.coalesce(F.get(sizes, hit + k * step), F.lit(0))
        go = state["open"] & (size > 0) & (state["words"] <= longest)
        return F.struct(
            F.when(go, k).otherwise(state["far"]).alias("far"),
            F.when(go, state["words"] + size).otherwise(state["words"]).alias("words"),
            go.alias("open"),
        )

    start = F.struct(F.lit(0).alias("far"), F.lit(0).alias("words"), F.lit(True).alias("open"))
    # No more steps than there are lines on that side.
    there = hit if step < 0 else F.size(sizes) - 1 - hit
    steps = F.slice(F.sequence(F.lit(1), F.lit(longest + 1)), F.lit(1), F.greatest(there, F.lit(0)))
    return F.aggregate(steps, start, onward, lambda state: state["far"])


def _runs(lines: Column, sizes: Column, hits: Column, longest: int) -> Column:
    """first, last and tokens of every run of lines through a hit line.

    A run holds no line without words, its inner lines have at most ``longest`` words, and of its first and
    last line, if there are several, the ``longest`` words at the joint are taken.
    """

    def through(hit: Column) -> Column:
        firsts = F.sequence(hit - _reach(sizes, hit, -1, longest), hit)
        lasts = F.sequence(hit, hit + _reach(sizes, hit, 1, longest))
        return F.flatten(F.transform(firsts, lambda a: F.transform(lasts, lambda b: a * (1 << 32) + b)))

    def inner(run: Column) -> Column:
        between = F.slice(sizes, run["first"] + 2, F.greatest(run["last"] - run["first"] - 1, F.lit(0)))
        return F.aggregate(between, F.lit(0), lambda total, size: total + size)

    def joined(run: Column) -> Column:
        count = run["last"] - run["first"]
        part = lambda w, k: (
            F.when(count == 0, w)
            .when(k == 0, F.slice(w, F.greatest(F.size(w) - longest, F.lit(0)) + 1, longest))
            .when(k == count, F.slice(w, 1, longest))
            .otherwise(w)
        )
        return F.flatten(F.transform(F.slice(lines, run["first"] + 1, count + 1), part))

    keys = F.array_distinct(F.flatten(F.transform(hits, through)))
    ends = F.transform(
        keys,
        lambda key: F.struct(
            F.shiftright(key, 32).cast("int").alias("first"), (key % (1 << 32)).cast("int").alias("last")
        ),
    )
    return F.transform(
        F.filter(ends, lambda run: inner(run) <= longest),
        lambda run: F.struct(run["first"].alias("first"), run["last"].alias("last"), joined(run).alias("w")),
    )


def _judged(runs: Column, model: Model, templates: list[tuple[str, list[int]]]) -> Column:
    """The runs that the classifier names, compared with the templates of the family."""
    used = _ints([b for b, _ in model.weights])
    best = _best(model)
    scored = F.transform(runs, lambda r: F.struct(r.alias("run"), best(F.array_intersect(buckets(r["w"]), used)).alias("best")))
    named = F.filter(scored, lambda r: r["best"]["probability"] >= model.threshold)
    paired = F.transform(named, lambda r: F.struct(r.alias("r"), _own_pairs(r["run"]["w"]).alias("own")))

    def alike(r: Column) -> Column:
        family = r["r"]["best"]["family"]
        return F.greatest(
            F.lit(0.0), *[F.when(family == f, _share(r["own"], _longs(p))).otherwise(0.0) for f, p in templates]
        )

    compared = F.transform(paired, lambda r: F.struct(r["r"].alias("r"), alike(r).alias("similarity")))
    return F.transform(
        compared,
        lambda c: F.struct(
            c["r"]["run"]["first"].alias("paragraph"),
            c["r"]["run"]["last"].alias("last"),
            c["r"]["best"]["family"].alias("family"),
            c["r"]["best"]["probability"].alias("probability"),
            c["similarity"].alias("similarity"),
            (c["similarity"] >= SIMILARITY).alias("confirmed"),
        ),
    )


def _apart(judged: Column) -> Column:
    """Of runs that share lines the best: confirmed before others, then the most alike, then the shortest."""
    ranked = F.array_sort(
        F.transform(
            judged,
            lambda n: F.struct(
                (~n["confirmed"]).alias("a"),
                (-n["similarity"]).alias("b"),
                (n["last"] - n["paragraph"]).alias("c"),
                n["paragraph"].alias("d"),
                n.alias("n"),
            ),
        )
    )
    shares = lambda x, y: (x["paragraph"] <= y["last"]) & (y["paragraph"] <= x["last"])
    kept = F.aggregate(
        ranked,
        F.filter(judged, lambda n: F.lit(False)),
        lambda taken, r: F.when(F.exists(taken, lambda t: shares(t, r["n"])), taken).otherwise(
            F.concat(taken, F.array(r["n"]))
        ),
    )
    return F.array_sort(kept)


def notices(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, and the notices (paragraph, last, family, probability, similarity, confirmed) of every document.

    ``paragraph`` and ``last`` are the first and the last line of a notice, counted from 0.
    """
    model = model or train(documents)
    every = _templates(documents.sparkSession).select("family", "w", _pairs(F.col("w")).alias("p")).collect()
    longest = max(len(r.w) for r in every)
    telling = F.array(*[F.lit(w) for w in model.telling]).cast("array<string>")
    # Words are letters and digits in lower case; one pattern finds the texts that have any of them.
    pattern = r"(?<![\p{L}\p{N}])(?:" + "|".join(model.telling or ["(?!)"]) + r")(?![\p{L}\p{N}])"
    # Each step is used more than once by the next, so the optimizer does not copy it into its lambdas.
    cut = F.when(F.lower("text").rlike(pattern), paragraphs(F.col("text"))).otherwise(F.array().cast("array<array<string>>"))
    lined = documents.select("doc_id", cut.alias("lines"))
    lines = F.col("lines")
    hits = F.filter(F.transform(lines, lambda w, i: F.when(F.arrays_overlap(w, telling), i)), lambda i: i.isNotNull())
    met = lined.select("doc_id", "lines", F.transform(lines, lambda w: F.size(w)).alias("sizes"), hits.alias("hits"))
    runs = F.when(F.size("hits") > 0, _runs(lines, F.col("sizes"), F.col("hits"), longest))
    judged = _judged(F.coalesce(runs, F.array().cast(_RUNS)), model, [(r.family, r.p) for r in every])
    found = met.select("doc_id", judged.alias("judged"))
    return found.select("doc_id", _apart(F.col("judged")).alias("notices"))
