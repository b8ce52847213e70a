"""Quality rules by distribution divergence.

References are gathered from the whole corpus: per language the histogram of character classes and that of its
``common`` most frequent words (A-Z lower-cased; all other words are one more cell).  A text is compared with every
language's reference by Jensen-Shannon distance (square root of the divergence to base 2), and its smallest distance of
either kind counts.  A distance that exceeds ``limit + slack / sqrt(size)`` fails the text; the slack allows for the
chance in small histograms, and below ``min_chars`` characters or ``min_words`` words a histogram says nothing and the
test passes.  Without any language in the corpus both tests pass.

Before that a base rule fails texts with fewer than 20 words, or with over 30 of 100 words in 8-word windows that occur
twice or more in the text.  Words are ``[^\\x20\\x09-\\x0D]+``.

NULL and empty texts have no words and fail the base rule.  NULL languages give no reference.  Repeated rows each give a
row and each count in the references.  Words and lines are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.common import Words, chunks, combine, mix, span_hashes, text_arrays, written

COMMON = 100
MIN_CHARS, CLASS_LIMIT, CLASS_SLACK = 100, 0.16, 3.0
MIN_WORDS, WORD_LIMIT, WORD_SLACK = 50, 0.35, 0.8
SYMBOLS = b"#*$%&|<>"
LOWER, UPPER, DIGIT, WHITE, MARK, SYMBOL, LATIN, WIDE, NONE = range(9)


def _classes() -> np.ndarray:
    """Character class of each byte; bytes inside a character have none."""
    c = np.full(256, SYMBOL, np.uint8)
    c[97:123], c[65:91], c[48:58] = LOWER, UPPER, DIGIT
    c[[9, 10, 11, 12, 13, 32]] = WHITE
    c[list(b".,;:'\"-()?!")] = MARK
    c[0x80:0xC0], c[0xC2:0xC4], c[0xC4:] = NONE, LATIN, WIDE
    return c


_CLASS = _classes()
_IS_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))


def per_row(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between the edges."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[edges[1:]] - total[edges[:-1]]


def class_counts(words: Words, raw: np.ndarray) -> np.ndarray:
    n = len(words.rows) - 1
    row = np.repeat(np.arange(n), np.diff(words.rows))
    return np.bincount(row * 9 + _CLASS[raw], minlength=9 * n).reshape(n, 9)[:, :NONE]


def base_measures(words: Words, window: int = 8) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each row; ``words`` keep their case."""
    raw, rows = words.data, words.rows
    n_words = np.diff(words.offsets)
    row = np.repeat(np.arange(len(n_words)), n_words)
    starts_char = (raw & 0xC0) != 0x80
    is_white = _CLASS[raw] == WHITE
    # Lines with a word: the words' line starts, without repeats.
    breaks = np.flatnonzero(raw == 10)
    edges = np.unique(np.concatenate([rows[:-1], breaks + 1]))
    line = np.unique(np.searchsorted(edges, words.starts, side="right") - 1)
    begin = edges[line]
    end = np.minimum(np.append(breaks, len(raw))[np.searchsorted(breaks, begin)], rows[np.searchsorted(rows, begin, side="right").clip(max=len(rows) - 1)])
    owner = np.searchsorted(rows, begin, side="right") - 1
    key = mix(span_hashes(raw, begin, end) + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    n_dup = np.bincount(owner, minlength=len(n_words)) - np.bincount(owner[first], minlength=len(n_words))
    grams = combine(words.hashes, window)
    at = np.flatnonzero(row[: len(grams)] == row[window - 1:]) if len(grams) else np.zeros(0, np.int64)
    _, index, count = np.unique(mix(grams[at] + row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
    twice = at[count[index] > 1]
    cover = np.zeros(len(row) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + window, -1)
    repeated = np.bincount(row[np.cumsum(cover)[:-1] > 0], minlength=len(n_words))
    return {"n_words": n_words, "word_chars": per_row(starts_char & ~is_white, rows), "n_symbols": per_row(_IS_SYMBOL[raw], rows), "n_dup_lines": n_dup, "n_repeat_words": repeated}


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of ``p`` (counts) to the distribution ``q``."""
    p = p / np.maximum(p.sum(1, keepdims=True), 1)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = lambda a: np.where(a > 0, a * np.log2(a / m), 0).sum(1)
        return np.sqrt(np.maximum((kl(p) + kl(np.broadcast_to(q, p.shape))) / 2, 0))


def _gather(batches):
    """(lang, kind, key, word hash, n): word counts and class counts of a task by language."""
    for batch in batches:
        langs, codes = np.unique(np.asarray(batch.column(0).to_pylist(), dtype=object).astype(str), return_inverse=True)
        data, offsets = text_arrays(batch.column(1))
        keys, counts, classes = [], [], np.zeros((len(langs), NONE), np.int64)
        for i, j in chunks(offsets):
            words = Words(data, offsets, i, j)
            code = codes[i:j]
            np.add.at(classes, code, class_counts(words, data[offsets[i]: offsets[j]]))
            own = np.repeat(code, np.diff(words.offsets))
            for k in np.unique(own):
                h, n = np.unique(words.hashes[own == k], return_counts=True)
                keys.append((np.full(len(h), k), h))
                counts.append(n)
        rows = [(np.repeat(np.arange(len(langs)), NONE), np.ones(len(langs) * NONE, np.int32), np.tile(np.arange(NONE), len(langs)), classes.ravel())]
        if keys:
            code, h, n = np.concatenate([k[0] for k in keys]), np.concatenate([k[1] for k in keys]), np.concatenate(counts)
            order = np.lexsort((h, code))
            code, h, n = code[order], h[order], n[order]
            first = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (h[1:] != h[:-1])]))
            rows.append((code[first], np.zeros(len(first), np.int32), h[first].view(np.int64), np.add.reduceat(n, first)))
        code, kind, key, n = (np.concatenate(c) for c in zip(*rows))
        yield pa.RecordBatch.from_arrays([pa.array(langs[code].tolist(), pa.string()), pa.array(kind), pa.array(key), pa.array(n)], names=["lang", "kind", "key", "n"])


def references(spark: SparkSession, docs: DataFrame, text_col: str, lang_col: str, common: int = COMMON):
    """(common words' hashes, for each language: class distribution, places of its words among them, its word distribution)."""
    counts = (docs.filter(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
              .mapInArrow(_gather, "lang string, kind int, key bigint, n bigint").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n")))
    counts = written(counts, spark)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "key"))
    top = counts.filter("kind = 0").withColumn("r", rank).filter(F.col("r") <= common).select("lang", "key", "n").toArrow().to_pandas()
    total = {r.lang: r.n for r in counts.filter("kind = 0").groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    classes = counts.filter("kind = 1").toArrow().to_pandas()
    vocabulary = np.unique(top["key"].to_numpy().view(np.uint64))
    out = []
    for lang in sorted(total):
        own = top[top["lang"] == lang].sort_values(["n", "key"])
        histogram = classes[classes["lang"] == lang].sort_values("key")["n"].to_numpy()
        n = own["n"].to_numpy()
        out.append((histogram / histogram.sum(), np.searchsorted(vocabulary, own["key"].to_numpy().view(np.uint64)), np.append(n, total[lang] - n.sum()) / total[lang]))
    return vocabulary, out


def _measure(reference, limits, names):
    min_chars, class_limit, class_slack, min_words, word_limit, word_slack = limits

    def run(batches):
        vocabulary, langs = reference.value
        for batch in batches:
            data, offsets = text_arrays(batch.column(batch.num_columns - 1))
            for i, j in chunks(offsets):
                words = Words(data, offsets, i, j, lower=False)
                base = base_measures(words)
                n_words, chars = base["n_words"], per_row((words.data & 0xC0) != 0x80, words.rows)
                failed = (n_words < 20) | (100 * base["n_repeat_words"] > 30 * n_words)
                class_js, word_js = np.zeros(j - i), np.zeros(j - i)
                if langs:
                    classes = class_counts(words, words.data)
                    lower = Words(data, offsets, i, j)
                    at = np.minimum(np.searchsorted(vocabulary, lower.hashes), len(vocabulary) - 1)
                    common = vocabulary[at] == lower.hashes
                    row = np.repeat(np.arange(j - i), np.diff(lower.offsets))
                    table = np.bincount(row[common] * len(vocabulary) + at[common], minlength=(j - i) * len(vocabulary)).reshape(j - i, -1)
                    class_js = np.min([js_distance(classes, c) for c, _, _ in langs], axis=0)
                    word_js = np.min([js_distance(np.concatenate([table[:, w], (n_words - table[:, w].sum(1))[:, None]], 1), q) for _, w, q in langs], axis=0)
                good = (chars < min_chars) | (class_js <= class_limit + class_slack / np.sqrt(np.maximum(chars, 1)))
                good &= (n_words < min_words) | (word_js <= word_limit + word_slack / np.sqrt(np.maximum(n_words, 1)))
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns[:-1]), *(pa.array(v.astype(np.int64)) for v in base.values()),
                                                  pa.array(failed), pa.array(~failed & good), pa.array(class_js), pa.array(word_js)], names=names)

    return run


def rate(spark: SparkSession, docs: DataFrame, keep: list[str] = ("doc_id",), text_col: str = "text", lang_col: str = "lang", common: int = COMMON,
         min_chars: int = MIN_CHARS, class_limit: float = CLASS_LIMIT, class_slack: float = CLASS_SLACK,
         min_words: int = MIN_WORDS, word_limit: float = WORD_LIMIT, word_slack: float = WORD_SLACK) -> DataFrame:
    """The ``keep`` columns, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed, kept, class_js and word_js."""
    shared = spark.sparkContext.broadcast(references(spark, docs, text_col, lang_col, common))
    added = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, class_js double, word_js double"
    kept = docs.select(*keep)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema), added])
    limits = (min_chars, class_limit, class_slack, min_words, word_limit, word_slack)
    return docs.select(*keep, F.col(text_col).alias("dv_text")).mapInArrow(_measure(shared, limits, [*kept.columns, *(a.split()[0] for a in added.split(", "))]), schema)
