"""License scans: TF-IDF cosine of headers and whole texts to templates, then inheritance.

A header is what stands around words that speak of licences or copyright, anywhere in a file: the lines
that do so cut to a window around each cue, and the same windows across line ends. Its words are
one sparse vector, and the nearest short template above `THRESHOLD` is the file's own licence. A word
outside the templates weighs 1 there, as a window's ends are arbitrary.

A whole text is compared to the short templates and to full licence texts, with damped counts and the
greatest weight for foreign words. From `FILE_SCORE` on it is a licence file: the template is its own
licence, and it stands for its directory. Inverse document frequencies are taken over the templates,
so a file's scores do not depend on the other files. Templates are a handful of constants; their
vectors go to the tasks, and the sparse products are made row by row, without a shuffle.

A file without a licence of its own takes that of the nearest ancestor directory with one; ancestors
are found per distinct directory by path joins, and files join their directory's result.

Nulls: a null path is the root directory, a null text has no header. Several licence files in a
directory: the best score stands, ties by licence and path. Repeated rows each get a row. An empty
table gives an empty result. Extra columns are kept out of the result.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.store import stored, table

# Wordings by which the common licences are named in headers and licence files.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not "
                   "use this file except in compliance with the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files, to deal in the software without "
            "restriction. MIT License."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the "
                "terms of the GNU General Public License as published by the Free Software "
                "Foundation, version 3."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without "
                     "modification, are permitted. BSD License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under the Creative Commons Attribution 4.0 International "
                  "License."),
    ("CC-BY-SA-4.0", "This work is licensed under the Creative Commons Attribution ShareAlike 4.0 "
                     "International License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, "
                "version 2.0."),
    ("proprietary", "Copyright. All rights reserved."),
]
CUE = r"(?i)licen[cs]e|copyright|\(c\)|all rights reserved|spdx|redistribut"
THRESHOLD = 0.5
FILE_SCORE = 0.75
WINDOWS = (8, 32)  # words on either side of a cue
_CUE = re.compile(CUE)
_WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)?")
_TEXTS = os.path.join(os.path.dirname(os.path.abspath(__file__)), "licence_texts")


class Templates:
    """Unit vectors of the short templates, then of the full texts, over the templates' words."""

    def __init__(self):
        texts = [(name[:-4], open(os.path.join(_TEXTS, name), encoding="utf-8").read())
                 for name in sorted(os.listdir(_TEXTS)) if name.endswith(".txt")]
        both = TEMPLATES + texts
        self.names, self.short = [name for name, _ in both], len(TEMPLATES)
        counts = [Counter(_WORD.findall(body.lower())) for _, body in both]
        found = Counter(word for c in counts for word in c)
        self.at = {word: i for i, word in enumerate(sorted(found))}
        self.foreign = float(np.log(len(both) + 1.0) + 1)
        self.idf = np.array([np.log((len(both) + 1.0) / (found[w] + 1)) + 1 for w in self.at])
        self.plain, self.damped = (np.zeros((len(both), len(self.at))) for _ in range(2))
        for i, c in enumerate(counts):
            where, times = [self.at[w] for w in c], np.array(list(c.values()), float)
            self.plain[i, where] = times * self.idf[where]
            self.damped[i, where] = (1 + np.log(times)) * self.idf[where]
        for units in (self.plain, self.damped):
            units /= np.linalg.norm(units, axis=1, keepdims=True)

    def _best(self, words: list[str], whole: bool) -> tuple[float, str]:
        """Cosine and licence of the nearest template."""
        counts = Counter(words)
        known = [(self.at[w], n) for w, n in counts.items() if w in self.at]
        if not known:
            return 0.0, ""
        where, times = (np.array(x) for x in zip(*known))
        rest = np.array([n for w, n in counts.items() if w not in self.at], float)
        if whole:
            times, rest = 1 + np.log(times), self.foreign * (1 + np.log(rest))
        units = self.damped if whole else self.plain[:self.short]
        vector = times * self.idf[where]
        scores = units[:, where] @ vector / np.sqrt(vector @ vector + rest @ rest)
        return max((round(float(s), 9), name) for s, name in zip(scores, self.names))

    def judge(self, text: str) -> tuple[float, str, bool] | None:
        """Score, licence and whether the whole text is a licence, or None without one."""
        low = text.lower()
        found = self._best(_WORD.findall(low), True)
        if found[0] >= FILE_SCORE:
            return *found, True
        found = max((self._best(words, False) for words in headers(low)), default=(0.0, ""))
        return (*found, False) if found[0] >= THRESHOLD else None


def headers(text: str) -> Iterator[list[str]]:
    """Words around the cues of a text, by window and with or without the limits of their lines."""
    cues = [m.span() for m in _CUE.finditer(text)]
    if not cues:
        return
    words = [m.span() for m in _WORD.finditer(text)]
    starts, ends = (np.array(x, np.int64) for x in zip(*words)) if words else ([], [])
    first = np.searchsorted(ends, [a for a, _ in cues], "right")
    last = np.searchsorted(starts, [b for _, b in cues], "left")
    begin = np.searchsorted(starts, [text.rfind("\n", 0, a) + 1 for a, _ in cues])
    close = [text.find("\n", b) for _, b in cues]
    close = np.searchsorted(starts, [len(text) if c < 0 else c for c in close])
    for size in WINDOWS:
        low, high = np.maximum(first - size, 0), np.minimum(last + size, len(words))
        for a, b in ((np.maximum(low, begin), np.minimum(high, close)), (low, high)):
            spots = np.zeros(len(words) + 1, np.int64)
            np.add.at(spots, a, 1)
            np.add.at(spots, np.maximum(a, b), -1)
            inside = np.flatnonzero(np.cumsum(spots)[:-1])
            yield [text[starts[i]:ends[i]] for i in inside.tolist()]
            for one, other in sorted(set(zip(a.tolist(), b.tolist()))):
                yield [text[x:y] for x, y in words[one:other]]


def own_licences(files: DataFrame) -> DataFrame:
    """(file, path, text) to file, path, licence, score and whole, one row for each row."""
    chosen = files.select("file", "path", F.col("text").cast("string").alias("text"))
    sent = files.sparkSession.sparkContext.broadcast(Templates())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.judge(t.as_py() or "") for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([f and f[1] for f in found], pa.string()),
                 pa.array([f and f[0] for f in found], pa.float64()),
                 pa.array([f is not None and f[2] for f in found], pa.bool_())],
                ["file", "path", "licence", "score", "whole"])

    schema = chosen.drop("text").withColumns({
        "licence": F.lit("").cast("string"), "score": F.lit(0.0), "whole": F.lit(True)}).schema
    for field in schema.fields:
        field.nullable = True
    return chosen.mapInArrow(run, schema)


def scan(files: DataFrame) -> DataFrame:
    """(file, path, text) to file, path, own_licence, score, licence and licence_dir.

    `file` identifies a row, `path` is /-separated. `licence_dir` is the directory it came from, null
    for a file's own.
    """
    folder = F.regexp_extract(F.coalesce(F.col("path"), F.lit("")), "^(.*)/[^/]*$", 1)
    placed = stored(own_licences(files)).withColumn("dir", folder)
    standing = placed.where("whole").groupBy("dir").agg(
        F.max(F.struct("score", "licence")).alias("best")).select(
        F.col("dir").alias("above"), F.col("best.licence").alias("licence"))
    dirs = placed.select("dir").distinct()
    steps = F.expr("transform(sequence(0, size(split(dir, '/'))), "
                   "i -> array_join(slice(split(dir, '/'), 1, i), '/'))")
    near = dirs.select("dir", F.posexplode(F.array_distinct(steps)).alias("depth", "above")).join(
        standing, "above").groupBy("dir").agg(
        F.max(F.struct("depth", "above", "licence")).alias("near"))
    met = placed.join(near, "dir", "left")
    return met.select(
        "file", "path", F.col("licence").alias("own_licence"), "score",
        F.coalesce("licence", F.col("near.licence")).alias("licence"),
        F.when(F.col("licence").isNull(), F.col("near.above")).alias("licence_dir"))


def op6_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files in folders of their source, language and hundred of doc_id."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")),
                       F.floor(F.col("doc_id") / 100).cast("string"),
                       F.col("doc_id").cast("string"))
    found = scan(docs.select(F.col("doc_id").alias("file"), path.alias("path"), "text"))
    return found.withColumnRenamed("file", "doc_id")
