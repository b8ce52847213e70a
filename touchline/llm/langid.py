"""Language identification with a convolutional network over bytes.

A text is cut into windows of ``WINDOW`` bytes (the last one ends with the text; a shorter text is padded).  Bytes are
embedded, filters of widths 2, 3 and 4 run over them, each filter's maximum over the window goes through a ReLU into a
softmax over the languages.  A text's language is the one with the highest mean probability over all its windows; the
mean is its score.  A first layer of this shape depends on bytes and byte pairs only, so it is applied as table look-ups.

The network is trained with numpy on a bounded sample: ``per_lang`` labelled texts of each language, chosen by a hash of
their id (four rows of an id at most), and ``per_text`` windows spread evenly over each.  Only rows outside the held-out fold with a language and a
text are learned from.

NULL texts and texts without a letter are ``und`` with score 0, and so is every text if there is nothing to learn from.
Repeated rows each give a row; ties between languages go to the alphabetically first.  A NULL id is not held out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.common import chunks, few_rows, fold, hash_share, text_arrays

WINDOW = 128
WIDTHS, FILTERS, EMBED, PAD = (2, 3, 4), 16, 8, 256
PER_LANG, PER_TEXT = 1000, 8
STEP_BYTES = 1 << 16


def windows_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows (one row of bytes each) of several texts, and the text each belongs to.  An empty text has none."""
    lengths = np.diff(offsets)
    n = -(-lengths // WINDOW)
    owner = np.repeat(np.arange(len(lengths)), n)
    k = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    start = np.maximum(np.minimum(k * WINDOW, lengths[owner] - WINDOW), 0)
    at = start[:, None] + np.arange(WINDOW)
    out = np.full((len(owner), WINDOW), PAD, np.int32)
    inside = at < lengths[owner][:, None]
    out[inside] = data[(offsets[owner][:, None] + at)[inside]]
    return out, owner


class Network:
    """Weights of the network.  ``train`` learns them, ``probabilities`` applies them."""

    def __init__(self, classes: int, seed: int = 5):
        r = np.random.default_rng(seed)
        self.params = {"embed": r.normal(0, 0.3, (PAD + 1, EMBED)), "out": r.normal(0, 0.1, (FILTERS * len(WIDTHS), classes)), "prior": np.zeros(classes)}
        for w in WIDTHS:
            self.params[f"w{w}"] = r.normal(0, (2 / (w * EMBED)) ** 0.5, (w * EMBED, FILTERS))
            self.params[f"b{w}"] = np.zeros(FILTERS)
        self.params = {k: v.astype(np.float32) for k, v in self.params.items()}

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 4, batch: int = 128, rate: float = 4e-3, seed: int = 6) -> None:
        r, p = np.random.default_rng(seed), self.params
        first, second, step = {k: 0.0 for k in p}, {k: 0.0 for k in p}, 0
        for epoch in range(epochs):
            order = r.permutation(len(x))
            for at in range(0, len(x), batch):
                rows = order[at: at + batch]
                grads = self._gradients(x[rows], y[rows])
                step += 1
                for k, g in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    pace = rate * 0.5 ** epoch / (1 - 0.9 ** step)
                    p[k] -= (pace * first[k] / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.params, len(x)
        embedded = p["embed"][x]
        patches, pooled, best = {}, [], {}
        for w in WIDTHS:
            patch = np.lib.stride_tricks.sliding_window_view(embedded, w, axis=1).transpose(0, 1, 3, 2).reshape(n, WINDOW - w + 1, w * EMBED)
            conv = patch @ p[f"w{w}"]
            best[w] = conv.argmax(1)
            patches[w] = patch
            pooled.append(np.take_along_axis(conv, best[w][:, None], 1)[:, 0] + p[f"b{w}"])
        pooled = np.concatenate(pooled, 1)
        hidden = np.maximum(pooled, 0)
        error = _softmax(hidden @ p["out"] + p["prior"])
        error[np.arange(n), y] -= 1
        error /= n
        grads = {"out": hidden.T @ error + 1e-4 * p["out"], "prior": error.sum(0), "embed": np.zeros_like(p["embed"])}
        back = (error @ p["out"].T) * (pooled > 0)
        for k, w in enumerate(WIDTHS):
            g = back[:, k * FILTERS: (k + 1) * FILTERS]
            won = patches[w][np.arange(n)[:, None], best[w]]
            grads[f"w{w}"] = np.einsum("nfd,nf->df", won, g)
            grads[f"b{w}"] = g.sum(0)
            to_bytes = (g[:, :, None] * p[f"w{w}"].T[None]).reshape(n, FILTERS, w, EMBED)
            symbols = x[np.arange(n)[:, None, None], best[w][:, :, None] + np.arange(w)]
            np.add.at(grads["embed"], symbols, to_bytes)
        return grads

    def tables(self) -> dict[str, np.ndarray]:
        """What each byte or byte pair adds to the filters, for the widths 2, 3 and 4."""
        p = self.params
        part = {(w, j): p["embed"] @ p[f"w{w}"][j * EMBED: (j + 1) * EMBED] for w in WIDTHS for j in range(w)}
        pair = lambda w, j: (part[w, j][:, None] + part[w, j + 1][None]).reshape(-1, FILTERS)
        return {"2": pair(2, 0), "3": pair(3, 0), "3+": part[3, 2], "4": pair(4, 0), "4+": pair(4, 2),
                "bias": np.concatenate([p[f"b{w}"] for w in WIDTHS]), "out": p["out"], "prior": p["prior"]}


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def probabilities(tables: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Softmax outputs for windows ``x``."""
    pair = x[:, :-1] * (PAD + 1) + x[:, 1:]
    two = np.take(tables["2"], pair, axis=0).max(1)
    three = np.take(tables["3"], pair[:, :-1], axis=0)
    three += np.take(tables["3+"], x[:, 2:], axis=0)
    four = np.take(tables["4"], pair[:, :-2], axis=0)
    four += np.take(tables["4+"], pair[:, 2:], axis=0)
    hidden = np.maximum(np.concatenate([two, three.max(1), four.max(1)], 1) + tables["bias"], 0)
    return _softmax(hidden @ tables["out"] + tables["prior"])


def _sample_windows(per_text: int):
    def run(batches):
        for batch in batches:
            data, offsets = text_arrays(batch.column(1))
            for i in range(len(batch)):
                x, _ = windows_of(data[offsets[i]: offsets[i + 1]], np.array([0, offsets[i + 1] - offsets[i]]))
                x = x[np.unique(np.linspace(0, len(x) - 1, min(per_text, len(x))).astype(int))].astype(np.int16)
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.repeat(batch.column(0)[i], len(x)), pa.array([r.tobytes() for r in x], pa.binary())], names=["lang", "bytes"])

    return run


def fit(spark: SparkSession, docs: DataFrame, may_learn: Column, id_col: str, text_col: str, lang_col: str,
        per_lang: int = PER_LANG, per_text: int = PER_TEXT) -> tuple[list[str], dict[str, np.ndarray] | None]:
    """Languages and look-up tables; (… , None) with fewer than one language to learn."""
    rows = docs.filter(may_learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    order = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("o").bitwiseAND(F.lit((1 << 53) - 1)), "id"))
    keys = rows.select(F.col(lang_col).alias("lang"), F.xxhash64(id_col).alias("o"), F.col(id_col).alias("id"))
    # Only ids whose hash is low enough for the first per_lang are ranked, four times as many for safety.
    # A row a language; their number is that of the network's classes, which the driver holds anyway.
    size = F.broadcast(keys.groupBy("lang").agg(F.count("*").alias("n")))
    chosen = (keys.join(size, "lang").filter(hash_share(F.col("o")) * F.col("n") <= 4.0 * per_lang).drop("n").distinct()
              .withColumn("r", order).filter(F.col("r") <= per_lang).select("lang", "id").distinct())
    # At most per_lang ids a language.
    picked = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id")).join(F.broadcast(chosen), ["lang", "id"])
    # An id's repeated rows count up to four times.
    picked = few_rows(picked, "id", "text")
    sample = picked.select("lang", "text").mapInArrow(_sample_windows(per_text), "lang string, bytes binary").toArrow().to_pandas()
    langs = sorted(sample["lang"].unique())
    if not langs:
        return [], None
    sample = sample.sort_values(["lang", "bytes"], kind="stable")
    x = np.frombuffer(b"".join(sample["bytes"]), np.int16).reshape(-1, WINDOW).astype(np.int32)
    y = np.searchsorted(langs, sample["lang"].to_numpy())
    net = Network(len(langs))
    net.train(x, y)
    return langs, net.tables()


def _predict(model, names):
    def run(batches):
        langs, tables = model.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            data, offsets = text_arrays(texts)
            lettered = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            total, count = np.zeros((len(batch), max(len(langs), 1))), np.zeros(len(batch))
            for i, j in chunks(offsets, STEP_BYTES):
                if tables is None:
                    break
                x, owner = windows_of(data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i])
                for k in range(0, len(x), STEP_BYTES // WINDOW):
                    at = owner[k: k + STEP_BYTES // WINDOW] + i
                    np.add.at(total, at, probabilities(tables, x[k: k + STEP_BYTES // WINDOW]))
                    np.add.at(count, at, 1)
            mean = total / np.maximum(count, 1)[:, None]
            known = lettered & (tables is not None)
            best = mean.argmax(1)
            lang = np.where(known, np.array([*langs, "und"], dtype=object)[np.where(known, best, len(langs))], "und")
            score = np.where(known, np.clip(mean.max(1), 0, 1), 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score)], names=names)

    return run


def identify(spark: SparkSession, docs: DataFrame, train: DataFrame, may_learn: Column, keep: list[str] = ("doc_id",), id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang", model: tuple | None = None, **sample) -> DataFrame:
    """The ``keep`` columns of ``docs``, lang_pred and score, by a network trained on ``train`` where ``may_learn``, or ``model`` from ``fit``."""
    model = spark.sparkContext.broadcast(model or fit(spark, train, may_learn, id_col, text_col, lang_col, **sample))
    kept = docs.select(*keep)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), "lang_pred string", "score double"])
    return docs.select(*keep, F.col(text_col).alias("li_text")).mapInArrow(_predict(model, [*kept.columns, "lang_pred", "score"]), schema)


def held_out(id_col: str = "doc_id") -> Column:
    return fold(id_col, 4, 2)
