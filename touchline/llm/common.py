"""Helpers of the text operators: Arrow text without Python strings, word hashes, folds, scratch tables."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.session import configure, shared_dir

CHUNK_BYTES = 1 << 18
"""Texts are worked on in pieces of this many bytes, or one text where it is longer."""

_random = np.random.default_rng(20240229)
BYTE_CODE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(id_col: str, parts: int, own: int) -> Column:
    """True for rows of the held-out fold: crc32 of the id as text, modulo ``parts``.  A NULL id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == own, F.lit(False))


def written(df: DataFrame, spark: SparkSession) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage and survives lost executors."""
    path = f"{shared_dir(spark)}/touchline-{uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.touchline_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables made by ``written`` that nothing still to be computed reads."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.touchline_path)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def plain(docs: DataFrame) -> tuple[DataFrame, list[str], dict[str, str]]:
    """``docs`` with columns c0, c1, …; these names; and the plain name of each column (the first of equal ones).

    No column can then clash with one that an operator adds.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]
    return docs.toDF(*names), names, dict(reversed(list(zip(docs.columns, names))))


def most_frequent(df: DataFrame, count_col: str, limit: int, key: str | None = None) -> DataFrame:
    """Rows of the greatest (positive) counts, at most ``limit``, by levels of 1/32 octave.

    With a ``key`` column the level that no longer fits whole is taken in the key's order, otherwise not at all.  The
    histogram of levels has a few thousand rows at most, whatever the input; only that one level is sorted, up to the limit.
    """
    level = F.floor(F.log2(count_col) * 32)
    kept, total, part = None, 0, None
    for r in df.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        if total + r["count"] > limit:
            part = r.level
            break
        kept, total = r.level, total + r["count"]
    out = df.filter(level >= kept) if kept is not None else df.limit(0)
    if key is not None and part is not None and total < limit:
        out = out.unionAll(df.filter(level == part).orderBy(key).limit(limit - total))
    return out


def few_rows(df: DataFrame, id_col: str, text_col: str, most: int = 4) -> DataFrame:
    """At most ``most`` rows of an id, those of the least text hashes; others are cut before the shuffle."""
    place = F.row_number().over(Window.partitionBy(id_col).orderBy(F.xxhash64(text_col)))
    return df.withColumn("fr_place", place).filter(F.col("fr_place") <= most).drop("fr_place")


def hash_share(column: Column) -> Column:
    """A 64-bit hash as a share of its range, 0 to 1."""
    return column.bitwiseAND(F.lit((1 << 53) - 1)) / float(1 << 53)


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 offsets of its rows; NULL counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give freed memory back to the system, where its C library can: a reused worker keeps its greatest extent otherwise."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold at most ``limit`` bytes together; a longer text makes a range of its own.

    After the last one, freed memory is released.
    """
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
    release()


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on all input bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, 1024), STEP)]), dtype=np.uint64)
    return _powers[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each non-empty span; spans are ascending and don't overlap, what lies between them is not looked at."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    at = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    codes = BYTE_CODE[data[at + np.repeat(starts, lengths)]]
    return mix(np.add.reduceat(codes * powers(int(lengths.max()))[at], first) + lengths.astype(np.uint64))


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of rows i..j of a text column: hash, byte span, and row offsets into the words.

    ``between`` marks the bytes that are not part of a word.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, i: int, j: int, lower: bool = True, between: np.ndarray = _SPACE):
        base = offsets[i]
        data = data[base: offsets[j]]
        self.rows = offsets[i: j + 1] - base
        self.data = _LOWER[data] if lower else data
        inside = np.empty(len(data) + 1, dtype=bool)
        inside[:-1] = ~between[data]
        inside[-1] = False
        cut = inside.copy()
        cut[1:] &= ~inside[:-1]
        at_row = self.rows[self.rows < len(data)]
        cut[at_row] = inside[at_row]
        self.starts = np.flatnonzero(cut)
        stop = ~inside
        stop[at_row] = True
        stops = np.flatnonzero(stop)
        self.ends = stops[np.searchsorted(stops, self.starts, side="right")]
        self.hashes = span_hashes(self.data, self.starts, self.ends)
        self.offsets = np.searchsorted(self.starts, self.rows)


def combine(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive hashes (length n - k + 1, or 0)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    p = powers(k)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += hashes[j: j + n] * p[j]
    return mix(out)
