"""Line de-duplication by winnowing over line hashes.

A line is identified by its words ``[^\\x20\\x09-\\x0D]+`` (their order and case count, white space doesn't); lines
without words take no part.  A window is a run of lines with at least ``min_words`` words that has fewer without its first
or without its last line.  Of every window the line of the least hash is selected (the first of equal ones): these lines are
the fingerprints.  A run of ``min_words`` or more words that two places share holds a whole window, and both places select
the same line of it, so no shared run goes unseen.

Selected lines are joined on their hash; those found once are out.  A selected line that is found again is extended both
ways, to each of the (at most 2 ``min_words``) windows that selected it, and an extended match belongs to the first place,
in the order of id and line, that has the same lines.  So a common line doesn't bring all pairs of its places: each is
compared with one place per window.  Windows overlap by all lines but one, so what they match adds up to whole repeated
runs, whichever earlier places these come from.  Later places lose the run.

Ids are whole numbers.  NULL texts stay NULL, empty texts empty, and a text whose lines all go becomes empty; no row is
dropped.  Rows with the same id and text count as one place, so none of them is deleted on account of the other.  Rows with
equal ids and different texts are ordered by a hash of the text; NULL ids come first.  Columns besides id and text pass
through.  Time is linear in a text's length, however many of its lines repeat.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from touchline.llm.common import STEP, Words, chunks, discard, mix, plain, powers, text_arrays, written

MIN_WORDS = 50
_INVERSE = np.uint64(pow(int(STEP), -1, 1 << 64))
_SELECTED = "tl_id bigint, tl_key bigint, fingerprint bigint, extents array<struct<run: bigint, first_line: int, last_line: int>>"
_CUT = StructType([StructField("text", StringType()), StructField("n_deleted", LongType())])


def _inverse_powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n - 1, 0), _INVERSE)]), dtype=np.uint64)[:n]


def winnow(data: np.ndarray, offsets: np.ndarray, i: int, j: int, min_words: int):
    """Selected lines of rows i..j and the windows that selected them, line numbers within the row.

    (row, line hash, offsets into the windows) of the lines, and (run hash, first line, last line) of the windows; None if
    no row has ``min_words`` words.
    """
    words = Words(data, offsets, i, j, lower=False)
    breaks = np.cumsum(words.data == 10)
    line = breaks[words.starts] if len(words.starts) else np.zeros(0, np.int64)
    row = np.searchsorted(words.rows, words.starts, side="right") - 1
    # Words of one line and row make a line; ``head`` is its first word.
    head = np.flatnonzero(np.concatenate([[True], (line[1:] != line[:-1]) | (row[1:] != row[:-1])])) if len(line) else np.zeros(0, np.int64)
    if not len(head):
        return None
    n_words = np.diff(np.append(head, len(line)))
    within = np.arange(len(line)) - np.repeat(head, n_words)
    hashes = mix(np.add.reduceat(words.hashes * powers(int(n_words.max()))[within], head))
    row, line = row[head], line[head]
    row_start = words.rows[row]
    line = line - np.where(row_start > 0, breaks[np.maximum(row_start, 1) - 1], 0)
    total = np.cumsum(n_words)
    edge = np.searchsorted(row, np.arange(j - i + 1))
    low, high = edge[row], edge[row + 1] - 1
    at = np.arange(len(row))
    end = np.searchsorted(total, total - n_words + min_words)
    begin = np.searchsorted(total - n_words, total - min_words, side="right") - 1
    forward, backward = end <= high, (begin >= low) & (total >= min_words)
    pairs = np.unique(np.stack([np.concatenate([at[forward], begin[backward]]), np.concatenate([end[forward], at[backward]])]), axis=1)
    if not pairs.shape[1]:
        return None
    s, e = pairs
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers(len(hashes)), dtype=np.uint64)])
    run = mix((prefix[e + 1] - prefix[s]) * _inverse_powers(len(hashes))[s] + (e - s + 1).astype(np.uint64))
    order = np.argsort(hashes, kind="stable")
    rank = np.empty(len(order) + 1, np.int64)
    rank[order], rank[-1] = at, len(order)
    chosen = order[np.minimum.reduceat(rank, np.stack([s, e + 1], axis=1).ravel())[::2]]
    # Neither end of a window comes before that of the window before it, so the chosen lines ascend.
    new = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    lines = chosen[new]
    return (row[lines], hashes[lines], np.append(new, len(chosen))), (run, line[s], line[e])


def _emit(min_words: int):
    def run(batches):
        for batch in batches:
            data, offsets = text_arrays(batch.column(2))
            for i, j in chunks(offsets):
                found = winnow(data, offsets, i, j, min_words)
                if found is not None:
                    (row, hashes, bounds), (run_hash, first, last) = found
                    part, row = batch.slice(i, j - i), pa.array(row)
                    extents = pa.StructArray.from_arrays(
                        [pa.array(run_hash.view(np.int64)), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
                        names=["run", "first_line", "last_line"])
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(row), part.column(1).take(row), pa.array(hashes.view(np.int64)),
                         pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), extents)],
                        names=["tl_id", "tl_key", "fingerprint", "extents"])

    return run


def cut(text: str, firsts: np.ndarray, lasts: np.ndarray) -> tuple[str, int]:
    """``text`` without the lines firsts[k]..lasts[k], and the number of lines that went."""
    lines = text.split("\n")
    step = np.bincount(firsts, minlength=len(lines) + 1) - np.bincount(lasts + 1, minlength=len(lines) + 1)
    gone = np.cumsum(step)[:-1] > 0
    return "\n".join(x for x, g in zip(lines, gone) if not g), int(gone.sum())


@F.pandas_udf(_CUT)
def _cut_all(text: pd.Series, firsts: pd.Series, lasts: pd.Series) -> pd.DataFrame:
    out = [(None, None) if t is None else cut(t, f, z) for t, f, z in zip(text, firsts, lasts)]
    return pd.DataFrame({"text": [t for t, _ in out], "n_deleted": pd.array([n for _, n in out], dtype="Int64")})


def repeated_runs(spark: SparkSession, docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Of ``docs`` (tl_id, tl_key, tl_text): tl_id, tl_key, first_line, last_line of every window that an earlier place has too.

    Windows of a text overlap where it repeats more than ``min_words`` words.  What is joined to a table is written first, so
    that both sides of a join are plain exchanges and Spark splits a line or window that very many texts have.
    """
    selected = written(docs.select("tl_id", "tl_key", "tl_text").mapInArrow(_emit(min_words), _SELECTED), spark)
    again = written(selected.groupBy("fingerprint").count().filter("count > 1").select("fingerprint"), spark)
    hits = written(selected.join(again, "fingerprint", "left_semi").select("tl_id", "tl_key", "fingerprint", F.inline("extents")), spark)
    discard(selected, again)
    place = F.struct(F.col("tl_id").isNotNull().alias("known"), F.coalesce("tl_id", F.lit(0)).alias("id"), "tl_key", "first_line")
    firsts = written(hits.groupBy("fingerprint", "run").agg(F.min(place).alias("place"), F.count("*").alias("n")).filter("n > 1").drop("n"), spark)
    return (hits.join(firsts, ["fingerprint", "run"]).filter(place > F.col("place"))
            .select("tl_id", "tl_key", "first_line", "last_line").distinct())


def dedup_lines(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with later repeated runs of lines deleted from the text, and n_lines and n_deleted (long), which replace columns of these names."""
    docs = docs.drop(*(n for n in ("n_lines", "n_deleted") if n not in (id_col, text_col)))
    columns = docs.columns
    docs, names, at = plain(docs)
    id_col, text_col = at[id_col], at[text_col]
    docs = docs.withColumns({"tl_id": F.col(id_col).cast("long"), "tl_key": F.xxhash64(text_col)})
    gone = (repeated_runs(spark, docs.withColumn("tl_text", F.col(text_col)), min_words)
            .groupBy("tl_id", "tl_key").agg(F.collect_list(F.struct("first_line", "last_line")).alias("tl_gone"))
            .withColumnsRenamed({"tl_id": "tl_gone_id", "tl_key": "tl_gone_key"}))
    # Only texts that lose lines go through Python.
    left = _cut_all(F.when(F.col("tl_gone").isNotNull(), F.col(text_col)), F.col("tl_gone.first_line"), F.col("tl_gone.last_line"))
    return (docs.join(gone, F.col("tl_id").eqNullSafe(F.col("tl_gone_id")) & (F.col("tl_key") == F.col("tl_gone_key")), "left")
            .withColumn("tl_left", left)
            .withColumns({"n_lines": F.coalesce(F.size(F.split(F.col(text_col), "\n", -1)), F.lit(0)).cast("long"),
                          "n_deleted": F.coalesce("tl_left.n_deleted", F.lit(0)).cast("long"),
                          text_col: F.when(F.col("tl_gone").isNull(), F.col(text_col)).otherwise(F.col("tl_left.text"))})
            .select(*names, "n_lines", "n_deleted").toDF(*columns, "n_lines", "n_deleted"))


SQL = r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS raw FROM documents),
l AS (SELECT doc_id, r.i AS line, array_to_string(regexp_extract_all(raw[r.i], '[^\x20\x09-\x0D]+'), ' ') AS body,
        len(regexp_extract_all(raw[r.i], '[^\x20\x09-\x0D]+')) AS n
      FROM d, LATERAL (SELECT unnest(generate_series(1, len(raw))) AS i) r),
k AS (SELECT doc_id, line, body, n, row_number() OVER w AS pos, sum(n) OVER w AS upto FROM l WHERE n > 0 WINDOW w AS (PARTITION BY doc_id ORDER BY line)),
b AS (SELECT doc_id, list(body ORDER BY pos) AS bodies FROM k GROUP BY doc_id),
w AS (SELECT DISTINCT a.doc_id, a.pos AS s, z.pos AS e, a.line AS first_line, z.line AS last_line FROM k a JOIN k z ON a.doc_id = z.doc_id AND a.pos <= z.pos
      WHERE z.upto - a.upto + a.n >= {n} AND (z.upto - a.upto + a.n - z.n < {n} OR z.upto - a.upto < {n})),
v AS (SELECT w.*, array_to_string(bodies[s:e], chr(10)) AS body FROM w JOIN b USING (doc_id)),
f AS (SELECT *, min((doc_id, first_line)) OVER (PARTITION BY body) AS place FROM v),
g AS (SELECT DISTINCT doc_id, unnest(generate_series(first_line, last_line)) AS line FROM f WHERE (doc_id, first_line) > place),
c AS (SELECT doc_id, list(line) AS gone FROM g GROUP BY doc_id)
SELECT doc_id, CASE WHEN gone IS NULL THEN text ELSE coalesce(array_to_string([raw[i] FOR i IN generate_series(1, len(raw)) IF NOT list_contains(gone, i)], chr(10)), '') END AS text,
  coalesce(len(raw), 0) AS n_lines, coalesce(len(gone), 0) AS n_deleted
FROM d LEFT JOIN c USING (doc_id)""".replace("{n}", str(MIN_WORDS))
