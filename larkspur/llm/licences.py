"""Licence notices in text: a trained paragraph classifier, confirmed against templates.

A paragraph is a line with a word. Every paragraph is turned into word one- and two-grams and scored by multinomial
logistic regression over the licence families and an unknown class. A family is named if its probability reaches the
family's threshold, which is calibrated on held-out examples, and if enough of the three-word shingles of one of its
templates stand in the paragraph, or of the paragraph's in the template; else the paragraph is unknown. Of the unknown
paragraphs those are listed that reach a family's threshold or hold one of ``STEMS``.

The classifier is fitted on a bounded number of labelled rows (``EXAMPLES`` for each family, and as many
negative ones), made from the templates by dropping and adding words. Scoring is DataFrame functions and the
fitted models of ``pyspark.ml`` (a weight per n-gram of the examples, so their size is bounded), line by line; nothing
is shuffled.

Null or empty text has no paragraphs. Repeated rows give repeated results. Columns besides doc_id and text
are not read. An empty table gives no rows.
"""

import functools
import random

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, functions as F

from larkspur.llm.quality import holds_any, let
from larkspur.session import small_table

#: Opening sentences and usual short forms of public licences.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ),
    "CC-BY": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC0": (
        "Dedicated to the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    ),
    "All-rights-reserved": (
        "All rights reserved.",
        "Copyright holder. All rights reserved. No part of this publication may be reproduced without permission.",
    ),
}
UNKNOWN = "unknown"
#: Unknown paragraphs with one of these are listed. Looked for in lower case, with every run of other characters than
#: letters and digits as one space, as the classifier reads a line.
STEMS = ("licens", "licenc", "rights reserved", "permission", "redistribut", "public domain", "copyright", "creative commons",
         "cc by", "cc0", "cc zero", "gpl", "gnu general public", "free software", "mozilla public", "source code form", "spdx",
         "related rights", "apache 2", "bsd 2", "bsd 3")
EXAMPLES, PRECISION, CONFIRM = 60, 0.98, 0.6
#: Sentences that use the same words without being notices.
OTHERS = (
    "She lost her driving licence on the way to the public library", "The licence fee rises again in the next year",
    "He asked permission to leave the general meeting", "A license to print money is what they called it",
    "The redistribution of income was the subject of version two of the report", "Copyright law is taught in the third year",
    "Fishing without a licence is not permitted here", "The public domain of the village was sold",
    "The rights of the workers were reserved for a later session", "An apache helicopter landed near the work site",
    "They granted the charge of the school to a person of software trade", "Creative people are common in this general area",
)
NOISE = "the of and in with from are this that page author year project data text under for see file".split()


def plain(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), "[^a-z0-9]+", " ")


def has_stem(text: Column) -> Column:
    return let(plain(text), lambda x: holds_any(x, STEMS))


def words_in(text: Column) -> Column:
    return F.array_remove(F.split(plain(text), " "), "")


def grams(words: Column, n: int) -> Column:
    """All runs of ``n`` words, joined by spaces."""
    return F.when(F.size(words) >= n, F.transform(
        F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "))).otherwise(
        F.array().cast("array<string>"))


def features(text: Column) -> Column:
    return let(words_in(text), lambda w: F.array_distinct(F.concat(w, grams(w, 2))))


def examples(seed=3, each=EXAMPLES):
    """(text, family): templates with words dropped, added and cut off, and other sentences."""
    r, rows = random.Random(seed), []

    def worn(text):
        words = [w for w in text.split() if r.random() > 0.08]
        for _ in range(r.randint(0, 3)):
            words.insert(r.choice([0, len(words)]), r.choice(NOISE))
        return " ".join(words)

    for family, texts in TEMPLATES.items():
        rows += [(t, family) for t in texts] + [(worn(r.choice(texts)), family) for _ in range(each)]
    for _ in range(each * 4):
        rows.append((worn(r.choice(OTHERS)), UNKNOWN))
        words = " ".join(" ".join(r.choice(list(TEMPLATES.values()))) for _ in range(2)).split()
        rows.append((" ".join(r.sample(words, min(len(words), r.randint(3, 6))) + r.choices(NOISE, k=6)), UNKNOWN))
    r.shuffle(rows)
    return rows


@functools.lru_cache(maxsize=4)
def fitted(spark):
    """(vectors of grams, classifier, thresholds, families); both models are Spark's."""
    families = [UNKNOWN, *TEMPLATES]
    rows = small_table(spark, [(t, float(families.index(f)), i) for i, (t, f) in enumerate(examples())],
                       "text string, label double, i int")
    data = rows.select("i", "label", features(F.col("text")).alias("grams")).coalesce(1).cache()
    counts = CountVectorizer(inputCol="grams", outputCol="features", minDF=2.0, binary=True).fit(data)
    vectors = counts.transform(data)
    model = LogisticRegression(maxIter=40, regParam=0.002, family="multinomial").fit(vectors.where("i % 4 != 0"))
    held = model.transform(vectors.where("i % 4 = 0")).select("label", "probability").collect()
    data.unpersist()
    thresholds = []
    for k in range(1, len(families)):
        ranked = sorted(((float(r["probability"][k]), r["label"] == k) for r in held), reverse=True)
        hits, best = 0, 1.0
        for n, (p, yes) in enumerate(ranked, 1):
            hits += yes
            if hits / n >= PRECISION:
                best = p
        thresholds.append(max(best, 0.5))
    return counts, model.setRawPredictionCol("").setPredictionCol(""), thresholds, families


def all_grams(text: Column) -> Column:
    """The words of ``features`` and their pairs, with repeats."""
    return let(words_in(text), lambda w: let(F.greatest(F.size(w) - 1, F.lit(0)), lambda n: F.concat(w, F.zip_with(
        F.slice(w, 1, n), F.slice(w, 2, n), lambda a, b: F.concat(a, F.lit(" "), b)))))


def scan(docs, text="text", key="doc_id"):
    """A row for each paragraph that the classifier takes for a notice or that holds a stem: key, paragraph (line number
    from 0), family, probability, the share of a template that confirms it, and the paragraph. All paragraphs are scored."""
    counts, model, thresholds, families = fitted(docs.sparkSession)
    t = F.coalesce(F.col(text), F.lit(""))
    lines = docs.select(F.col(key).alias("doc_id"), F.posexplode(F.split(t, "\n", -1)).alias("paragraph", "line"))
    scored = model.transform(counts.transform(lines.withColumn("grams", all_grams(F.col("line")))))
    limits = F.array(*[F.lit(x) for x in thresholds])

    def best(p):
        return F.array_max(F.transform(F.slice(p, 2, len(thresholds)), lambda x, i: F.struct(x.alias("p"), (-1 - i).alias("k"))))

    reaches = let(vector_to_array("probability"), lambda p: let(best(p), lambda b: b["p"] >= F.element_at(limits, -b["k"])))
    kept = scored.where(reaches | has_stem(F.col("line")))
    named = kept.select("doc_id", "paragraph", "line", let(vector_to_array("probability"), best).alias("best")).select(
        "doc_id", "paragraph", "line", F.col("best.p").alias("p"), (-F.col("best.k")).alias("k"))
    named = named.withColumn("like", let(words_in(F.col("line")), lambda w: likeness(w, F.col("k"), families)))
    sure = (F.col("p") >= F.element_at(limits, F.col("k"))) & (F.col("like") >= CONFIRM)
    return named.select(
        "doc_id", F.col("paragraph").cast("long").alias("paragraph"),
        F.when(sure, F.element_at(F.array(*[F.lit(x) for x in families[1:]]), F.col("k"))).otherwise(UNKNOWN).alias("family"),
        F.round("p", 6).alias("probability"), F.round("like", 6).alias("template_share"), F.col("line").alias("text"))


def likeness(words: Column, k: Column, families) -> Column:
    """The largest share of shingles that a paragraph has in common with a template of family ``k``, of the smaller set."""
    def share(template):
        size = 3 if len(template) >= 3 else len(template)
        own = F.array(*[F.lit(" ".join(template[i:i + size])) for i in range(len(template) - size + 1)])
        return let(F.array_distinct(grams(words, size)), lambda g: F.when(F.size(g) == 0, F.lit(0.0)).otherwise(
            F.size(F.array_intersect(g, own)) / F.least(F.size(g), F.size(F.array_distinct(own)))))

    out = F.lit(0.0)
    for i, family in enumerate(families[1:], 1):
        texts = ["".join(c if c.isascii() and c.isalnum() else " " for c in t.lower()).split() for t in TEMPLATES[family]]
        best = functools.reduce(F.greatest, [share(t) for t in texts])
        out = F.when(k == i, best).otherwise(out)
    return out


def op4_licence_scan(spark, sf_dir):
    """Every paragraph that may be a licence notice, with its family."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
