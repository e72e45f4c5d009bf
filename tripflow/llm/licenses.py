"""Licence scans: a trained paragraph classifier over sparse word n-grams, confirmed by templates. DataFrame and SQL functions throughout.

A paragraph is a line; a notice may be wrapped over up to ``WRAPPED`` lines before and after one with a cue. Multinomial logistic regression over hashed unigrams and bigrams names a licence family or ``unknown``. It is trained on the
templates, each with words left out and put in at different places, and on ordinary paragraphs of at most ``NEGATIVE_DOCS`` documents: the
smallest hashes of doc_id. One half of these rows trains; the other calibrates: the probability that a family needs is the one which
``CALIBRATED`` of the unknown rows stay below, and 0.5 at least. A prediction counts once a template of its family is found in the paragraph: its name
words are all there, and ``CONFIRMED`` of all its words.

Every template has one of the ``CUES`` among its name words, so a paragraph without cues can never be confirmed; it is not scored. The scan itself is
one map-only pass.

A line with a cue that is no notice by itself is looked at together with its neighbours, as far as lines follow each other, have words and are no
notices. For each template that the neighbours can confirm, the window grows from the line to both sides by the lines that have more words of the
template than others. The best confirmed window goes through the classifier as a line does; of windows that overlap the first counts.

Defined results: a null or empty text has no licences and one empty paragraph. A null doc_id and repeated rows are carried through. In an empty
table the classifier knows fixed negatives only. Extra columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lines_of
from .secrets import matches, positions

BUCKETS = 1024
NEGATIVE_DOCS = 500
NEGATIVE_ROWS = 2000
VARIANTS = 24
CONFIRMED = 0.7
#: Lines to each side of one with a cue that a window can reach. The longest template has 63 words, so a notice of 4 words a line fits.
WRAPPED = 20
#: Distinct words of a line that a short template can confirm.
SHORT_WORDS = 5
CALIBRATED = 0.995
UNKNOWN = "unknown"

#: Fixed values: (family, name words, notice). Public notices in their usual wording; the first name word is a cue.
TEMPLATES = (
    ("MIT", "license mit", "Released under the MIT License."),
    ("MIT", "licensed mit", "This project is licensed under the terms of the MIT license."),
    ("MIT", "permission hereby charge", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache", "licensed apache", "Licensed under the Apache License, Version 2.0."),
    ("Apache", "licensed apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("Apache", "license apache", "Released under the Apache License 2.0."),
    ("GPL", "licensed gnu general", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "license gnu general", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL", "license gpl", "Released under the GPL license, version 2 or later."),
    ("LGPL", "license gnu lesser", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL", "licensed gnu lesser", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL", "licensed gnu affero", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL", "license gnu affero", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("BSD", "license bsd", "Released under the BSD 3-Clause License."),
    ("BSD", "redistribution binary forms", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ("MPL", "license mozilla", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL", "licensed mozilla", "Licensed under the Mozilla Public License, Version 2.0."),
    ("CC", "licensed cc", "Licensed under CC BY-NC 4.0."),
    ("CC", "licensed cc", "Licensed under CC BY 4.0."),
    ("CC", "licensed cc", "Except where otherwise noted, this content is licensed under CC BY-SA 4.0."),
    *((family, f"license spdx identifier {name}", f"SPDX-License-Identifier: {name}") for family, name in (
        ("MIT", "mit"), ("Apache", "apache"), ("GPL", "gpl"), ("LGPL", "lgpl"), ("AGPL", "agpl"), ("BSD", "bsd"), ("MPL", "mpl"), ("CC", "cc"), ("CC", "cc0"),
    )),
    ("CC", "licensed creative commons", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
)
#: Titles and fields; as their words are few, they count only in lines of ``SHORT_WORDS`` distinct words at most.
SHORT = tuple(
    (family, f"{cue} {name.lower()}", body.format(name))
    for family, name in (("MIT", "MIT"), ("Apache", "Apache"), ("GPL", "GPL"), ("LGPL", "LGPL"), ("AGPL", "AGPL"), ("BSD", "BSD"), ("MPL", "MPL"))
    for cue, body in (("license", "License: {}"), ("license", "The {} License"), ("licensed", "Licensed under {}"))
)
#: Sentences with cues that are no notices.
NEGATIVES = (
    "You need a driving licence to rent a car in most countries.", "The licence plate of the car was read by the camera.",
    "All rights reserved.", "She was licensed as a pilot in the spring of that year.", "The city council renewed the liquor license of the bar.",
    "Permission to enter the building is given by the office.", "The redistribution of wealth was the subject of the debate.",
    "He asked for permission and left the house free of charge.", "The general public was not told about the license until version 3 of the report.",
    "A software license costs more than the computer itself.", "The MIT campus lies on the river.", "The apache helicopter was licensed to other firms.",
    "The license of MIT students.", "An MIT license plate.", "The Apache were licensed traders.", "A license from BSD shops.",
)
CUES = r"(?i)licen[sc]|permission|redistribut|spdx"
FAMILIES = (UNKNOWN, *dict.fromkeys(t[0] for t in TEMPLATES))

_WORD = r"[a-z0-9]+"


def _quoted(values: list[str]) -> str:
    return "array(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def words_sql(text: str) -> str:
    return f"regexp_extract_all(replace(lower({text}), 'licenc', 'licens'), '{_WORD}', 0)"


def buckets_sql(found: str) -> str:
    """Distinct buckets of the words and of pairs of neighbours."""
    pairs = "transform(slice(w, 2, greatest(size(w) - 1, 0)), (x, i) -> concat(get(w, i), ' ', x))"
    bucket = f"transform(concat(w, {pairs}), g -> cast(pmod(xxhash64(g), {BUCKETS}L) AS int))"
    return f"get(transform(array({found}), w -> array_distinct({bucket})), 0)"


def _local(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    table = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.explode(table).alias("row")).select("row.*")


def training_rows(docs: DataFrame) -> DataFrame:
    """(label, variant, body): damaged copies of the templates, the fixed negatives, and paragraphs of a bounded sample of documents."""
    spark = docs.sparkSession
    fixed = [{"label": FAMILIES.index(f), "body": body} for f, _, body in (*TEMPLATES, *SHORT)] + [{"label": 0, "body": b} for b in NEGATIVES]
    variants = _local(spark, fixed, "label int, body string").withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
    # Variant 0 is the notice itself. Others lose about one word in ten, but no name word, and some follow other words.
    names = sorted({w for _, words, _ in (*TEMPLATES, *SHORT) for w in words.split()})
    keep = f"w -> variant = 0 OR array_contains({_quoted(names)}, w) OR pmod(xxhash64(w, variant), 10) > 0"
    damaged = F.expr(f"array_join(filter({words_sql('body')}, {keep}), ' ')")
    before = F.expr("CASE variant % 4 WHEN 1 THEN 'copyright 2024 the authors ' WHEN 2 THEN 'this file is ' ELSE '' END")
    variants = variants.select("label", "variant", F.concat(before, damaged).alias("body"))
    sample = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id").distinct()
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id").limit(NEGATIVE_DOCS)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id", "left_semi")
    plain = texts.select("doc_id", F.posexplode(lines_of(F.col("text"))).alias("variant", "body"))
    plain = plain.filter(~F.col("body").rlike(CUES) & (F.length("body") > 20)).orderBy(F.xxhash64("body"), "body").limit(NEGATIVE_ROWS)
    return variants.union(plain.select(F.lit(0).alias("label"), F.xxhash64("body").alias("variant"), "body"))


def _featured(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("buckets", F.expr(buckets_sql(words_sql("body"))))
    dense = f"transform(sequence(0, {BUCKETS - 1}), b -> IF(array_contains(buckets, b), 1 / sqrt(size(buckets)), 0D))"
    return rows.withColumn("features", array_to_vector(F.expr(dense)))


class Model:
    """Weights by family and bucket, biases, and the calibrated probability."""

    def __init__(self, weights: list[float], biases: list[float], least: float) -> None:
        self.weights, self.biases, self.least = weights, biases, least

    def scores_sql(self, found: str) -> str:
        """array<double>: the probabilities of all families. The weights are one literal, folded into an array when the plan is made."""
        table = f"from_json('{json.dumps(self.weights)}', 'array<double>')"
        bias = f"from_json('{json.dumps(self.biases)}', 'array<double>')"
        n = len(self.biases)
        margin = f"get({bias}, f) + aggregate(b, 0D, (s, k) -> s + get({table}, k * {n} + f)) / sqrt(greatest(size(b), 1))"
        margins = f"get(transform(array({buckets_sql(found)}), b -> transform(sequence(0, {n - 1}), f -> {margin})), 0)"
        total = "aggregate(m, 0D, (s, x) -> s + exp(x - array_max(m)))"
        return f"get(transform(array({margins}), m -> get(transform(array({total}), t -> transform(m, x -> exp(x - array_max(m)) / t)), 0)), 0)"


def fit(docs: DataFrame) -> Model:
    rows = _featured(training_rows(docs)).withColumn("train", F.pmod("variant", F.lit(2)) == 0).cache()
    regression = LogisticRegression(family="multinomial", regParam=1e-6, maxIter=200, standardization=False)
    fitted = regression.fit(rows.filter("train"))
    matrix, bias = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    weights = [round(float(matrix[f, b]), 6) for b in range(BUCKETS) for f in range(len(FAMILIES))]
    model = Model(weights, [round(float(x), 6) for x in bias], 0.5)
    held = rows.filter("NOT train AND label = 0").select(F.expr(model.scores_sql(words_sql("body"))).alias("p"))
    high = held.agg(F.percentile(F.expr("array_max(slice(p, 2, 100))"), CALIBRATED).alias("high")).first()["high"]
    model.least = max(0.5, high or 0.0)
    rows.unpersist()
    return model


def _distinct(body: str) -> list[str]:
    return sorted(set("".join(c if c.isalnum() else " " for c in body.lower()).split()))


def _confirmed_sql() -> str:
    """Whether a template of family ``best`` is in the paragraph with the distinct words ``w``."""
    tests = []
    for family, names, body in (*TEMPLATES, *SHORT):
        distinct = _distinct(body)
        there = f"size(array_intersect(w, {_quoted(distinct)})) >= {CONFIRMED * len(distinct)}"
        short = f" AND size(w) <= {SHORT_WORDS}" if (family, names, body) in SHORT else ""
        tests.append(f"best = {FAMILIES.index(family)} AND size(array_intersect(w, {_quoted(names.split())})) = {len(names.split())} AND {there}{short}")
    return " OR ".join(f"({t})" for t in tests)


def _let(name: str, value: str, body: str) -> str:
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _family_sql(found: str, model: Model) -> str:
    """The family of the words, or 0."""
    confirmed = _let("w", "array_distinct(v)", _confirmed_sql())
    named = f"IF(best > 0 AND array_max(p) >= {model.least}D AND {confirmed}, best, 0)"
    return _let("v", found, _let("p", model.scores_sql("v"), _let("best", "cast(array_position(p, array_max(p)) - 1 AS int)", named)))


def _reach_sql(gains: str) -> str:
    """How many of the lines to one side give the largest sum of gains."""
    state = "struct<sum:bigint,most:bigint,at:int,n:int>"
    step = _let("z", "y.sum + x", f"CAST(struct(z, greatest(z, y.most), IF(z > y.most, y.n + 1, y.at), y.n + 1) AS {state})")
    return f"aggregate({gains}, CAST(struct(0, 0, 0, 0) AS {state}), (y, x) -> {step}).at"


def _window_sql() -> str:
    """struct<score, start, end, words>: the best window around the line at ``c`` of ``ls`` that a template confirms; null without one."""
    known = [{"names": n.split(), "words": _distinct(b)} for _, n, b in TEMPLATES]
    templates = f"from_json('{json.dumps(known)}', 'array<struct<names:array<string>,words:array<string>>>')"

    def confirms(w: str, t: str) -> str:
        return (
            f"size(array_intersect({w}, {t}.names)) = size({t}.names) "
            f"AND size(array_intersect({w}, {t}.words)) >= {CONFIRMED}D * size({t}.words)"
        )

    def run(flags: str) -> str:
        """Leading true flags."""
        return _let("fs", flags, "IF(array_position(fs, false) > 0, cast(array_position(fs, false) - 1 AS int), size(fs))")

    after = run(f"transform(slice(ls, c + 2, {WRAPPED}), l -> l.joined)")
    # Flags of the line itself and of those before: each says whether it continues the one above.
    before = run(f"reverse(transform(slice(ls, greatest(c + 2 - {WRAPPED}, 1), least(c + 1, {WRAPPED})), l -> l.joined))")
    gains = "transform(near, l -> cast(2 * size(array_intersect(l.words, t.words)) - size(array_distinct(l.words)) AS bigint))"
    chosen = _let("v", "flatten(transform(seg, l -> l.words))", (
        f"IF({confirms('v', 't')}, named_struct('score', aggregate(slice(g, n - up + 1, size(seg)), 0L, (y, x) -> y + x), "
        "'start', get(seg, 0).start, 'end', element_at(seg, -1).end, 'words', v), NULL)"
    ))
    chosen = _let("up", _reach_sql("reverse(slice(g, 1, n))"), _let("down", _reach_sql("slice(g, n + 2, size(g))"), (
        _let("seg", "slice(near, n - up + 1, up + down + 1)", chosen)
    )))
    best = f"transform(filter({templates}, t -> {confirms('u', 't')}), t -> {_let('g', gains, chosen)})"
    best = _let("u", "array_distinct(flatten(transform(near, l -> l.words)))", f"array_max({best})")
    near = _let("near", "slice(ls, c - n + 1, n + 1 + m)", best)
    return _let("n", before, _let("m", after, f"IF(n + m = 0, NULL, {near})"))


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, n_paragraphs, n_candidates, n_licenses, families, spans) for every row; spans are family:start:end in code points."""
    model = model or fit(docs)
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).select(
        "doc_id", F.size(lines_of(F.col("text"))).cast("long").alias("n_paragraphs"), matches(F.col("text"), CUES, "[^\\n]+", 0).alias("lines")
    )
    none = "CAST(array() AS array<struct<start:bigint,end:bigint,body:string,size:bigint>>)"
    line = f"named_struct('start', l.start, 'end', l.end, 'words', {words_sql('l.body')}, 'cue', l.body RLIKE '{CUES}')"
    rows = rows.withColumn("found", F.expr(f"transform(coalesce({positions('lines')}, {none}), l -> {line})")).drop("lines")
    judged = (
        "transform(found, l -> named_struct('start', l.start, 'end', l.end, 'words', l.words, 'cue', l.cue, "
        f"'family', IF(l.cue, {_family_sql('l.words', model)}, 0)))"
    )
    free = "k.family = 0 AND size(k.words) > 0"
    follows = f"{free} AND coalesce(get(js, i - 1).end + 1 = k.start AND get(js, i - 1).family = 0 AND size(get(js, i - 1).words) > 0, false)"
    joined = (
        "transform(js, (k, i) -> named_struct('start', k.start, 'end', k.end, 'words', k.words, 'cue', k.cue, 'family', k.family, "
        f"'joined', {follows}))"
    )
    rows = rows.withColumn("judged", F.expr(_let("js", judged, joined))).drop("found")
    windows = f"filter(transform(filter(sequence(0, size(ls) - 1), c -> get(ls, c).cue AND get(ls, c).family = 0), c -> {_window_sql()}), x -> x IS NOT NULL)"
    windows = f"transform({windows}, x -> named_struct('start', x.start, 'end', x.end, 'family', {_family_sql('x.words', model)}))"
    span = "array<struct<start:bigint,end:bigint,family:int>>"
    alone = "transform(filter(ls, l -> l.family > 0), l -> named_struct('start', l.start, 'end', l.end, 'family', l.family))"
    # Windows come in the order of their cue lines; one that begins before the end of the last kept one is left out.
    first = f"aggregate(filter({windows}, x -> x.family > 0), CAST(array() AS {span}), (y, x) -> IF(size(y) > 0 AND x.start < element_at(y, -1).end, y, concat(y, array(x))))"
    named = _let("ls", "judged", f"IF(size(ls) = 0, CAST(array() AS {span}), array_sort(concat({alone}, {first})))")
    rows = rows.select("doc_id", "n_paragraphs", F.expr("cast(size(filter(judged, j -> j.cue)) AS bigint)").alias("n_candidates"), F.expr(named).alias("named"))
    name = f"get({_quoted(list(FAMILIES))}, j.family)"
    return rows.select(
        "doc_id", "n_paragraphs", "n_candidates", F.size("named").cast("long").alias("n_licenses"),
        F.expr(f"array_join(array_sort(array_distinct(transform(named, j -> {name}))), ',')").alias("families"),
        F.expr(f"array_join(transform(named, j -> concat_ws(':', {name}, j.start, j.end)), ',')").alias("spans"),
    )
