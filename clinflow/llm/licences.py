"""Licence scan of paragraphs by a trained classifier and template comparison.

A multinomial logistic regression over word 1- to 3-grams is trained on labelled paragraphs:
variants of licence notices, and a class of ordinary text that is no notice. Only n-grams with a word
that marks licences are features, so a paragraph without any such word scores like an empty one
and needs no look. A prediction counts if its calibrated probability is high enough and the
paragraph has enough of the words of the family's template; otherwise it is ``unknown``.
"""

from __future__ import annotations

import json
import math
import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflow.llm.common import pick
from clinflow.operators.storage import materialize

UNKNOWN = "unknown"

# Short notices of licence families, as licensors ask to write them.
TEMPLATES = {
    "apache": ["licensed under the apache license version 2 0",
               "you may not use this file except in compliance with the license",
               "distributed under the apache software license 2 0"],
    "mit": ["released under the mit license", "licensed under the mit license",
            "permission is hereby granted free of charge to any person obtaining a copy"],
    "gpl": ["this work is licensed under the gnu general public license version 3",
            "this program is free software you can redistribute it under the terms of the gnu "
            "general public license", "released under the gpl version 2"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are "
            "permitted", "licensed under the bsd 3 clause license"],
    "cc": ["licensed under cc by nc 4 0",
           "this work is licensed under a creative commons attribution 4 0 international license",
           "licensed under cc by sa 3 0", "released under cc0 1 0 public domain dedication"],
    "proprietary": ["all rights reserved", "copyright all rights reserved",
                    "unauthorized copying of this file is strictly prohibited"],
}
# Words that mark a notice.
MARKS = ["license", "licence", "licensed", "licenced", "licenses", "apache", "mit", "gnu", "gpl", "bsd",
         "cc", "cc0", "copyright", "rights", "reserved", "creative", "commons", "redistribution",
         "redistribute", "permission", "permitted", "unauthorized", "released", "domain"]
# Sentences with such words that are no notice.
ORDINARY = ["the driver lost his license after the accident", "she was released under bail",
            "human rights are universal", "he asked for permission to speak", "the table was reserved",
            "the commons were closed to creative work", "an apache helicopter landed",
            "students at mit built a robot", "see the license for details of the fishing season",
            "all seats reserved for guests", "version 2 was released in spring",
            "the gnu is an antelope of the plains", "he was granted a gun license version",
            "rights and duties of public servants", "permission denied", "cc the whole team"]


def grams(words: list[str]) -> list[str]:
    out = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return [g for g in out if set(g.split(" ")) & set(MARKS)]


def training_set(seed: int = 5, variants: int = 40) -> list[tuple[list[str], str]]:
    """Bounded: ``variants`` of each template and sentence, with words dropped, put before or
    after; the first is the text itself."""
    rng = random.Random(seed)
    filler = sorted({w for s in ORDINARY for w in s.split() if w not in MARKS})
    out = []
    labelled = [(t, f) for f, ts in TEMPLATES.items() for t in ts] + [(s, UNKNOWN) for s in ORDINARY]
    for text, label in labelled:
        for v in range(variants):
            words = [w for w in text.split() if not v or rng.random() > 0.08]
            if v:
                pad = rng.choices(filler, k=rng.randrange(5))
                cut = rng.randrange(len(pad) + 1)
                words = pad[:cut] + words + pad[cut:]
            out.append((words, label))
    return out


class Model:
    def __init__(self, weights: dict[str, list[float]], bias: list[float], temperature: float,
                 classes: list[str]):
        self.weights, self.bias, self.temperature, self.classes = weights, bias, temperature, classes

    def scores(self, features: set[str]) -> list[float]:
        z = list(self.bias)
        for g in features:
            for k, w in enumerate(self.weights.get(g, ())):
                z[k] += w
        z = [math.exp((x - max(z)) / self.temperature) for x in z]
        return [x / sum(z) for x in z]


def train(examples: list[tuple[list[str], str]], epochs: int = 8, rate: float = 0.3,
          shrink: float = 1e-4) -> Model:
    """Stochastic gradient with L1 shrinking (weights at zero drop out); one example in five is held
    out to set the temperature that makes the held-out likelihood largest."""
    classes = [*TEMPLATES, UNKNOWN]
    rng = random.Random(9)
    examples = examples[:]
    rng.shuffle(examples)
    known = [(set(grams(words)), label) for words, label in examples]
    held, used = known[::5], [e for i, e in enumerate(known) if i % 5]
    weights: dict[str, list[float]] = {}
    model = Model(weights, [0.0] * len(classes), 1.0, classes)
    model.bias[-1] = 2.0
    for _ in range(epochs):
        for features, label in used:
            p = model.scores(features)
            for k, c in enumerate(classes):
                step = rate * ((c == label) - p[k])
                for g in features:
                    w = weights.setdefault(g, [0.0] * len(classes))
                    w[k] += step
                    w[k] -= math.copysign(min(abs(w[k]), shrink), w[k])
    for g in [g for g, w in weights.items() if max(map(abs, w)) < 0.05]:
        del weights[g]

    def loss(t: float) -> float:
        tuned = Model(weights, model.bias, t, classes)
        return -sum(math.log(max(1e-12, tuned.scores(w)[classes.index(c)])) for w, c in held)

    model.temperature = min((0.5, 0.75, 1.0, 1.5, 2.0, 3.0), key=loss)
    return model


def scan(docs: DataFrame, model: Model | None = None, least: float = 0.8, overlap: float = 0.6,
         longest: int = 200) -> DataFrame:
    """(doc_id, paragraph, family, probability, similarity) for each paragraph that may be a notice.

    Paragraphs are lines, numbered from 0. A paragraph has a row if the classifier finds some family
    likelier than ordinary text. ``family`` is ``unknown`` if the probability is below ``least``, or if
    the share of a template's words that the paragraph has, in the best case, is below ``overlap``. Paragraphs
    over ``longest`` words are cut into overlapping windows of that many, and the most probable
    notice counts. NULL and empty texts give no rows; repeated rows give theirs again.
    """
    model = model or train(training_set())
    rows = pick(docs, doc_id="doc_id:bigint", text="text:string")
    marks = r"(?i)(?<![a-z0-9])(" + "|".join(MARKS) + r")(?![a-z0-9])"
    paragraphs = rows.where(F.col("text").rlike(marks)).select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "line"))
    words = F.filter(F.split(F.lower("line"), "[^a-z0-9]+"), lambda w: w != "")
    paragraphs = paragraphs.where(F.col("line").rlike(marks)).select(
        "doc_id", "paragraph", F.monotonically_increasing_id().alias("row"), words.alias("words"))
    half = longest // 2
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("words") - half), F.lit(half))
    windows = materialize(paragraphs.select(
        "doc_id", "paragraph", "row", F.explode(starts).alias("s"), "words").select(
        "doc_id", "paragraph", "row", F.slice("words", F.col("s") + 1, F.lit(longest)).alias("words")),
        "paragraphs")
    at = F.sequence(F.lit(1), F.size("words"))

    def ngrams(n: int) -> Column:
        return F.transform(
            F.filter(at, lambda i: i + (n - 1) <= F.size("words")),
            lambda i: F.array_join(F.slice("words", i, F.lit(n)), " "))

    # The number of features is fixed by the training set, a few thousand, so they are broadcast.
    table = docs.sparkSession.range(1).select(F.explode(F.from_json(
        F.lit(json.dumps(model.weights)), "map<string,array<double>>")).alias("gram", "w"))
    scored = windows.withColumn("window", F.monotonically_increasing_id())
    scored = materialize(scored, "windows")
    hits = scored.select("window", F.explode(F.array_distinct(F.concat(
        ngrams(1), ngrams(2), ngrams(3)))).alias("gram")).join(F.broadcast(table), "gram")
    sums = hits.groupBy("window").agg(
        *[F.sum(F.col("w")[k]).alias(f"z{k}") for k in range(len(model.classes))])
    z = [F.coalesce(F.col(f"z{k}"), F.lit(0.0)) + F.lit(model.bias[k])
         for k in range(len(model.classes))]
    top = F.greatest(*z)
    total = sum((F.exp((x - top) / model.temperature) for x in z), F.lit(0.0))
    best = F.coalesce(*[F.when(x == top, F.lit(c)) for x, c in zip(z, model.classes)])
    judged = scored.join(sums, "window").select(
        "doc_id", "paragraph", "row", "words", best.alias("best"), (1 / total).alias("probability"))
    shares = {}
    for family, texts in TEMPLATES.items():
        bags = [sorted(set(t.split())) for t in texts]
        shares[family] = F.greatest(F.lit(0.0), *[
            F.size(F.array_intersect(F.array(*map(F.lit, bag)), F.col("words"))) / len(bag)
            for bag in bags])
    similar = F.coalesce(
        *[F.when(F.col("best") == f, share) for f, share in shares.items()], F.lit(0.0))
    judged = judged.where(F.col("best") != UNKNOWN).withColumn("similarity", similar)
    sure = (F.col("probability") >= least) & (F.col("similarity") >= overlap)
    judged = judged.withColumn("family", F.when(sure, F.col("best")).otherwise(UNKNOWN))
    rank = F.struct((F.col("family") != UNKNOWN).alias("sure"), "probability", "similarity", "family")
    return judged.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("paragraph").alias("paragraph"),
        F.max(rank).alias("best")).select(
        "doc_id", "paragraph", "best.family", "best.probability", "best.similarity")
