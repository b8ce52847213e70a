"""Toxicity scores: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the n-grams of 5, 6 and 8 characters of the lower-cased text, by presence, hashed to 2^20 cells; every run
of characters other than letters and digits counts as one space, so n-grams see where words begin and end.  From labelled
texts each cell gets the log ratio of its shares among toxic and other texts (add-one smoothing); the ``features`` cells
that tell the classes apart best are kept (ties by cell number), and a logistic regression with these ratios as feature values is fitted.

Labelled texts are a bounded sample: ``per_class`` ids of either label, chosen by a hash of the id, with four rows of an
id at most, weighted back to the
classes' true shares, toxic texts ``TOXIC_WEIGHT`` times.  Ids labelled both ways and NULL labels are left out.  Scoring reads every whole text.

NULL and empty texts get the score of a text without features.  Repeated rows each give a row.  Without labels of both
kinds every score is 0.  A NULL id is never learned from and not held out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import chunks, combine, few_rows, fold, hash_share, mix, most_frequent, text_arrays, written
from touchline.llm.pretokens import NUMBER, kinds

SIZES = (5, 6, 8)
CELLS = 1 << 20
PER_CLASS, FEATURES, TOXIC_WEIGHT = 8000, 3000, 3.0


def cells_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, cell) of every n-gram of every text, with repeats."""
    texts = [f" {t.lower()} " for t in texts]
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    points = np.where(kinds()[points] <= NUMBER, points, 32)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    kept = np.ones(len(points), bool)
    kept[1:] = (points[1:] != 32) | (points[:-1] != 32) | (row[1:] != row[:-1])
    points, row = mix(points[kept].astype(np.uint64) + np.uint64(1)), row[kept]
    rows, cells = [], []
    for n in SIZES:
        h = combine(points, n)
        own = row[: len(h)] == row[n - 1:] if len(h) else np.zeros(0, bool)
        rows.append(row[: len(h)][own])
        cells.append((h[own] & np.uint64(CELLS - 1)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(cells)


def selected(texts: list[str], number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, feature) of the cells that have a feature number (not -1)."""
    row, cell = cells_of(texts)
    feature = number[cell]
    at = np.flatnonzero(feature >= 0)
    both = np.unique(row[at] * np.int64(CELLS) + feature[at])
    return both // CELLS, both % CELLS


def _texts(column, i, j):
    return [t or "" for t in column.slice(i, j - i).to_pylist()]


def _class_counts(batches):
    """Per cell the toxic and other texts that have it, summed over a task."""
    counts = np.zeros((2, CELLS), np.int32)
    for batch in batches:
        toxic = batch.column(0).to_numpy().astype(bool)
        _, offsets = text_arrays(batch.column(1))
        for i, j in chunks(offsets):
            row, cell = cells_of(_texts(batch.column(1), i, j))
            both = np.unique(row * np.int64(CELLS) + cell)
            for label in (False, True):
                counts[int(label)] += np.bincount(both[toxic[i + both // CELLS] == label] % CELLS, minlength=CELLS).astype(np.int32)
    at = np.flatnonzero(counts.any(0))
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[1, at].astype(np.int64)), pa.array(counts[0, at].astype(np.int64))], names=["cell", "toxic", "other"])


def _rows(number):
    def run(batches):
        for batch in batches:
            _, offsets = text_arrays(batch.column(1))
            for i, j in chunks(offsets):
                row, feature = selected(_texts(batch.column(1), i, j), number.value)
                upto = np.searchsorted(row, np.arange(j - i + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.ListArray.from_arrays(pa.array(upto), pa.array(feature.astype(np.int32)))],
                                                 names=["toxic", "o", "features"])

    return run


def regression(offsets: np.ndarray, features: np.ndarray, ratio: np.ndarray, label: np.ndarray, weight: np.ndarray, steps: int = 300, decay: float = 3e-4, rate: float = 0.05):
    """Coefficients on the ratio-scaled features and the intercept, by full-batch Adam."""
    row = np.repeat(np.arange(len(label)), np.diff(offsets))
    w, b = np.zeros(len(ratio)), 0.0
    first, second = np.zeros(len(ratio) + 1), np.zeros(len(ratio) + 1)
    for step in range(1, steps + 1):
        z = np.bincount(row, weights=(w * ratio)[features], minlength=len(label)) + b
        error = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label)
        g = np.append(np.bincount(features, weights=error[row], minlength=len(ratio)) * ratio + decay * w, error.sum())
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w * ratio, b


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, may_learn: Column, id_col: str, text_col: str, label_col: str,
        per_class: int = PER_CLASS, features: int = FEATURES):
    """(feature number of each cell, weight of each feature, intercept), or None without labels of both kinds."""
    known = (labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).filter(may_learn).groupBy(F.col(id_col).alias("id"))
             .agg(F.min(label_col).alias("low"), F.max(label_col).alias("high")).filter("low = high").select("id", F.col("high").cast("int").alias("toxic"), F.xxhash64("id").alias("o")))
    totals = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    if set(totals) != {0, 1}:
        return None
    # Only ids whose hash is low enough for the first per_class are sorted, four times as many for safety.
    low = F.col("o").bitwiseAND(F.lit((1 << 53) - 1))
    ids = [known.filter(F.col("toxic") == label).filter(hash_share(F.col("o")) * totals[label] <= 4.0 * per_class).orderBy(low, "id").limit(per_class) for label in (0, 1)]
    # At most 2 * per_class ids.
    chosen = F.broadcast(ids[0].unionAll(ids[1]))
    # An id's repeated rows count up to four times, so the sample has at most 8 * per_class rows.
    found = few_rows(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(chosen, "id"), "id", "text")
    sample = written(found.select("toxic", "text", "o"), spark)
    counts = sample.select("toxic", "text").mapInArrow(_class_counts, "cell bigint, toxic bigint, other bigint").groupBy("cell").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    n = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if set(n) != {0, 1}:
        return None
    share = lambda name, k: (F.col(name) + 1) / F.lit(float(n[k] + 2))
    p, q = share("toxic", 1), share("other", 0)
    apart = F.abs(p - q) / F.sqrt(p * (1 - p) / n[1] + q * (1 - q) / n[0])
    told = counts.filter(F.col("toxic") + F.col("other") >= 3).select("cell", F.log(p / q).alias("ratio"), apart.alias("apart")).filter("apart > 0")
    top = most_frequent(written(told, spark), "apart", features, "cell").toArrow().sort_by("cell")
    ratio = top["ratio"].to_numpy()
    number = np.full(CELLS, -1, np.int32)
    number[top["cell"].to_numpy()] = np.arange(len(ratio), dtype=np.int32)
    shared = spark.sparkContext.broadcast(number)
    rows = sample.select("toxic", "text", "o").mapInArrow(_rows(shared), "toxic int, o bigint, features array<int>").toArrow().sort_by("o").combine_chunks()
    column = rows["features"].combine_chunks()
    label = rows["toxic"].to_numpy()
    weight = np.where(label == 1, TOXIC_WEIGHT * totals[1] / n[1], totals[0] / n[0])
    weights, intercept = regression(np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())]), column.flatten().to_numpy(), ratio, label, weight / weight.sum())
    return number, weights, intercept


def _score(model, names):
    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            _, offsets = text_arrays(texts)
            z = np.full(len(batch), -np.inf)
            if model.value is not None:
                number, weights, intercept = model.value
                for i, j in chunks(offsets):
                    row, feature = selected(_texts(texts, i, j), number)
                    z[i:j] = np.bincount(row, weights=weights[feature], minlength=j - i) + intercept
            score = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            score[np.isneginf(z)] = 0
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=names)

    return run


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, may_learn: Column, keep: list[str] = ("doc_id",), id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic", **sample) -> DataFrame:
    """The ``keep`` columns of ``docs``, score (0 to 1) and predicted (1 from 0.5 on).  ``may_learn`` is a condition on the id."""
    model = spark.sparkContext.broadcast(fit(spark, docs, labels, may_learn, id_col, text_col, label_col, **sample))
    kept = docs.select(*keep)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "score double", "predicted int"])
    return docs.select(*keep, F.col(text_col).alias("tx_text")).mapInArrow(_score(model, [*kept.columns, "score", "predicted"]), schema)


def held_out(id_col: str = "doc_id") -> Column:
    return fold(id_col, 5, 0)
