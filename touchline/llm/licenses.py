"""Licence scan: sparse TF-IDF cosine to templates, then inheritance from the nearest directory above.

Terms are runs of ASCII letters and digits (lower-cased) and of other non-ASCII signs.  Each line of a file, and the file
as a whole, is a vector of term frequency times log(1 + N / lines with the term), where N and the counts cover all lines of
all files; only the templates' terms need counting, any other term weighs as much as one seen once.  A file's own licence is
that of the template with the highest cosine to one of its vectors, from ``threshold`` on; ties go to the first by name.

A licence file gives its licence to its directory (of several, the one with the least path and id).  A file without a
licence of its own takes that of the nearest directory above it: the distinct directories are spread over their ancestors
and joined by path, then the files join their directory, so no step depends on how many files one directory holds.

NULL or empty texts have no licence of their own; NULL paths inherit nothing.  Repeated rows each give a row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import Words, chunks, text_arrays

THRESHOLD = 0.7
# The short notices of common public licences.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work, CC0."),
    ("Proprietary", "All rights reserved."),
]
_BETWEEN = np.ones(256, bool)
_BETWEEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def terms_of(texts: list[str]) -> list[np.ndarray]:
    """Term hashes of each text."""
    joined = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in joined])]).astype(np.int64)
    words = Words(np.frombuffer(b"".join(joined), np.uint8), offsets, 0, len(texts), between=_BETWEEN)
    return [words.hashes[a:b] for a, b in zip(words.offsets[:-1], words.offsets[1:])]


def _lines(words: Words) -> np.ndarray:
    """Number of the line (over all rows) of each term."""
    breaks = np.flatnonzero(words.data == 10)
    edges = np.unique(np.concatenate([words.rows[:-1], breaks + 1]))
    return np.searchsorted(edges, words.starts, side="right") - 1


def _count(vocabulary):
    """(term number, lines with it); the number -1 counts all lines that have a term."""
    def run(batches):
        total = np.zeros(len(vocabulary) + 1, np.int64)
        for batch in batches:
            data, offsets = text_arrays(batch.column(0))
            for i, j in chunks(offsets):
                words = Words(data, offsets, i, j, between=_BETWEEN)
                line = _lines(words)
                at = np.minimum(np.searchsorted(vocabulary, words.hashes), len(vocabulary) - 1)
                known = vocabulary[at] == words.hashes
                pairs = np.unique(line[known] * len(vocabulary) + at[known])
                total[:-1] += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
                total[-1] += len(np.unique(line))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(len(vocabulary)), -1)), pa.array(total)], names=["term", "n"])

    return run


class Matcher:
    """Templates as unit vectors over the vocabulary, and the weight of terms outside it."""

    def __init__(self, templates: list[tuple[str, str]], vocabulary: np.ndarray, weights: np.ndarray, other: float):
        self.names = [n for n, _ in templates]
        self.vocabulary, self.weights, self.other = vocabulary, weights, other
        vectors = np.array([np.bincount(np.searchsorted(vocabulary, t), minlength=len(vocabulary)) for t in terms_of([t for _, t in templates])]) * weights
        self.vectors = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).T

    def best(self, hashes: np.ndarray, group: np.ndarray, n: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """For each of n groups of terms the best cosine (0 below the threshold) and its template."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == hashes
        # Known terms weigh at most (sum of weights)^2 together and unknown ones at least their number: most groups drop out.
        most = np.bincount(group[known], weights=self.weights[at[known]], minlength=n) ** 2
        rest = np.bincount(group[~known], minlength=n) * self.other ** 2
        hopeful = most * (1 - threshold ** 2) >= threshold ** 2 * rest * (1 - 1e-9)
        hopeful &= most > 0
        cosine, template = np.zeros(n), np.zeros(n, np.int64)
        number = np.cumsum(hopeful) - 1
        mine = hopeful[group]
        m = int(hopeful.sum())
        if m:
            g, k, w = number[group[mine]], known[mine], at[mine]
            counts = np.bincount(g[k] * len(self.vocabulary) + w[k], minlength=m * len(self.vocabulary)).reshape(m, -1)
            inside = counts * self.weights
            order = np.lexsort((hashes[mine][~k], g[~k]))
            ug, uh = g[~k][order], hashes[mine][~k][order]
            first = np.flatnonzero(np.concatenate([[True], (ug[1:] != ug[:-1]) | (uh[1:] != uh[:-1])])) if len(ug) else np.zeros(0, np.int64)
            outside = np.bincount(ug[first], weights=(np.diff(np.append(first, len(ug))) * self.other) ** 2, minlength=m)
            similar = (inside @ self.vectors) / np.sqrt((inside ** 2).sum(1) + outside)[:, None]
            cosine[hopeful], template[hopeful] = similar.max(1), similar.argmax(1)
        cosine[cosine < threshold] = 0
        return cosine, template


def _own(shared, threshold, names):
    def run(batches):
        matcher = shared.value
        for batch in batches:
            data, offsets = text_arrays(batch.column(batch.num_columns - 1))
            for i, j in chunks(offsets):
                words = Words(data, offsets, i, j, between=_BETWEEN)
                row = np.repeat(np.arange(j - i), np.diff(words.offsets))
                best, template = matcher.best(words.hashes, row, j - i, threshold)
                line = _lines(words)
                used, line = np.unique(line, return_inverse=True)
                owner = np.zeros(len(used), np.int64)
                owner[line] = row
                cosine, which = matcher.best(words.hashes, line, len(used), threshold)
                for k in np.flatnonzero(cosine):
                    r = owner[k]
                    if cosine[k] > best[r] + 1e-12 or (abs(cosine[k] - best[r]) <= 1e-12 and which[k] < template[r]):
                        best[r], template[r] = cosine[k], which[k]
                found = [matcher.names[t] if s > 0 else None for s, t in zip(best, template)]
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns[:-1]), pa.array(found, pa.string()), pa.array(np.where(best > 0, np.round(best, 9), np.nan), mask=best <= 0)], names=names)

    return run


def own_licenses(spark: SparkSession, files: DataFrame, keep: list[str], text_col: str = "text", templates=None, threshold: float = THRESHOLD) -> DataFrame:
    """The ``keep`` columns, license and similarity (NULL without one)."""
    templates = sorted(templates or TEMPLATES)
    vocabulary = np.unique(np.concatenate(terms_of([t for _, t in templates])))
    text = F.col(text_col).alias("lc_text")
    counted = {r.term: r.n for r in files.select(text).mapInArrow(_count(vocabulary), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    lines = max(counted.get(-1, 0), 1)
    weights = np.array([np.log(1 + lines / max(counted.get(k, 0), 1)) for k in range(len(vocabulary))])
    shared = spark.sparkContext.broadcast(Matcher(templates, vocabulary, weights, float(np.log(1 + lines))))
    kept = files.select(*keep)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "license string", "similarity double"])
    return files.select(*keep, text).mapInArrow(_own(shared, threshold, [*kept.columns, "license", "similarity"]), schema)


def inherit(found: DataFrame, is_license_file: Column, path_col: str = "path", id_col: str = "doc_id") -> DataFrame:
    """``found`` with license filled from the nearest directory above, and licensed_by: own, the directory's path, or NULL."""
    folder = F.regexp_replace(path_col, "/?[^/]*$", "")
    rows = found.withColumn("lc_dir", folder)
    given = (rows.filter(is_license_file & F.col("license").isNotNull()).groupBy(F.col("lc_dir").alias("lc_above"))
             .agg(F.min(F.struct(F.col(path_col).alias("p"), F.col(id_col).alias("i"), F.col("license").alias("l"))).alias("g")).select("lc_above", F.col("g.l").alias("lc_given")))
    parts = F.split("lc_dir", "/")
    above = F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/")))
    folders = rows.filter(F.col("lc_dir").isNotNull()).select("lc_dir").distinct().withColumn("lc_above", above)
    nearest = (folders.join(given, "lc_above").groupBy("lc_dir").agg(F.max(F.struct(F.length("lc_above").alias("n"), "lc_above", "lc_given")).alias("g"))
               .select("lc_dir", "g.lc_above", "g.lc_given"))
    return (rows.join(nearest, "lc_dir", "left")
            .withColumns({"licensed_by": F.when(F.col("license").isNotNull(), "own").otherwise(F.col("lc_above")), "license": F.coalesce("license", "lc_given")})
            .drop("lc_dir", "lc_above", "lc_given"))
