"""Benchmark decontamination by spaced-seed hashing.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.  A mask such as ``1111101`` hashes the tokens under its
ones and ignores the others.  Hashes of all masks at all positions of texts and benchmark items are joined, and around a
hit the two token rows are laid over each other: a text overlaps an item if some ``window`` aligned tokens of both agree in
at least ``min_equal`` places.  An item shorter than the window must agree as a whole, an item shorter than the shortest
mask has no seed and never matches.  The three masks are such that 13 tokens with any two substitutions hold a seed, so
within the rule above nothing is missed.

Before the join a bit map of fixed size, filled from the benchmark's hashes, drops the positions of the texts that cannot
match.  It is the only thing broadcast (2 MB, whatever the benchmark's size); what it lets through wrongly the join drops.

NULL or empty texts and items match nothing.  Rows with the same id give one result with the best counts; rows with a NULL
id are found under a NULL id.  Only id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import STEP, Words, chunks, mix, plain, text_arrays, written

MASKS = ("111111", "1111101", "1101111")
WINDOW, MIN_EQUAL = 13, 11
MAP_BITS = 24
_REGION = "dc_id bigint, dc_key bigint, region long, tokens array<bigint>, seeds array<struct<seed:bigint,at:int>>"


def seed_hashes(tokens: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the unmasked tokens at every position where the mask fits."""
    n = len(tokens) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, hash_of_mask(mask), np.uint64)
    for k, bit in enumerate(mask):
        if bit == "1":
            h = h * STEP + tokens[k: k + n]
    return mix(h)


def hash_of_mask(mask: str) -> np.uint64:
    return np.uint64(int(mask, 2))


def _bits(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return seeds & np.uint64((1 << MAP_BITS) - 1), (seeds >> np.uint64(32)) & np.uint64((1 << MAP_BITS) - 1)


def _items(masks):
    def run(batches):
        for batch in batches:
            data, offsets = text_arrays(batch.column(2))
            for i, j in chunks(offsets):
                words = Words(data, offsets, i, j)
                part = batch.slice(i, j - i)
                tokens, seeds = [], []
                for r in range(j - i):
                    own = words.hashes[words.offsets[r]: words.offsets[r + 1]]
                    tokens.append(own.view(np.int64))
                    seeds.append([{"seed": int(s), "at": at} for m in masks for at, s in enumerate(seed_hashes(own, m).view(np.int64))])
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(tokens, pa.list_(pa.int64())),
                                                  pa.array(seeds, pa.list_(pa.struct([("seed", pa.int64()), ("at", pa.int32())])))],
                                                 names=["item_id", "item_key", "item_tokens", "seeds"])

    return run


def _regions(bitmap, masks, window):
    """Stretches of tokens around positions that pass the bit map, with the seeds in them."""
    def run(batches):
        bits = np.unpackbits(np.frombuffer(bitmap.value, np.uint8), bitorder="little").view(bool)
        for batch in batches:
            data, offsets = text_arrays(batch.column(2))
            for i, j in chunks(offsets):
                words = Words(data, offsets, i, j)
                n = len(words.hashes)
                row = np.repeat(np.arange(j - i), np.diff(words.offsets))
                at, seed, span = [], [], []
                for m in masks:
                    h = seed_hashes(words.hashes, m)
                    a, b = _bits(h)
                    hit = np.flatnonzero(bits[a] & bits[b])
                    hit = hit[row[hit] == row[hit + len(m) - 1]]
                    at.append(hit)
                    seed.append(h[hit])
                    span.append(np.full(len(hit), len(m)))
                at, seed, span = map(np.concatenate, (at, seed, span))
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, seed, span = at[order], seed[order].view(np.int64), span[order]
                low = np.maximum(at + span - window, words.offsets[row[at]])
                high = np.minimum(at + window, words.offsets[row[at] + 1])
                upto = np.maximum.accumulate(high)
                new = np.concatenate([[True], (low[1:] > upto[:-1]) | (row[at[1:]] != row[at[:-1]])])
                first = np.flatnonzero(new)
                last = np.append(first[1:], len(at))
                begin, end = np.minimum.reduceat(low, first), upto[last - 1]
                part = batch.slice(i, j - i)
                owner = pa.array(row[at[first]])
                seeds = pa.StructArray.from_arrays([pa.array(seed), pa.array((at - np.repeat(begin, last - first)).astype(np.int32))], names=["seed", "at"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(owner), part.column(1).take(owner), pa.array(begin - words.offsets[row[at[first]]]),
                     pa.array([words.hashes[x:y].view(np.int64) for x, y in zip(begin, end)], pa.list_(pa.int64())),
                     pa.ListArray.from_arrays(pa.array(np.append(first, len(at)).astype(np.int32)), seeds)],
                    names=["dc_id", "dc_key", "region", "tokens", "seeds"])

    return run


def best_overlap(text: np.ndarray, item: np.ndarray, shift: int, window: int, min_equal: int) -> tuple[int, int] | None:
    """Text position k lies over item position k - shift.  (most equal tokens in a window, its size), or None below the rule."""
    low, high = max(0, shift), min(len(text), shift + len(item))
    size, need = (window, min_equal) if len(item) >= window else (len(item), len(item))
    if high - low < size:
        return None
    equal = np.concatenate([[0], np.cumsum(text[low:high] == item[low - shift: high - shift])])
    most = int((equal[size:] - equal[:-size]).max())
    return (most, size) if most >= need else None


def _verify(window, min_equal):
    def run(batches):
        for batch in batches:
            tokens, items, shifts = batch.column("tokens"), batch.column("item_tokens"), batch.column("shift").to_pylist()
            found = [best_overlap(np.asarray(tokens[k].values), np.asarray(items[k].values), shifts[k], window, min_equal) for k in range(len(batch))]
            keep = [k for k, f in enumerate(found) if f]
            rows = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("dc_id").take(rows), batch.column("dc_key").take(rows), batch.column("item_id").take(rows),
                                              pa.array([found[k][0] for k in keep], pa.int64()), pa.array([found[k][1] for k in keep], pa.int64())],
                                             names=["dc_id", "dc_key", "item_id", "n_equal", "n_window"])

    return run


def _verified(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, window: int,
              min_equal: int, masks: tuple[str, ...]) -> DataFrame:
    """(dc_id, dc_key, item_id, n_equal, n_window) of every alignment that fulfils the rule; dc_key is a hash of the text."""
    kind = benchmark.schema[item_col].dataType.simpleString()
    items = (benchmark.select(F.col(item_col).alias("item_id"), F.xxhash64(item_text_col).alias("item_key"), F.col(item_text_col).alias("item_text"))
             .mapInArrow(_items(masks), f"item_id {kind}, item_key bigint, item_tokens array<bigint>, seeds array<struct<seed:bigint,at:int>>"))
    items = written(items, spark)
    seeds = items.select("item_id", "item_key", F.explode("seeds").alias("s")).select("item_id", "item_key", F.col("s.seed").alias("seed"), F.col("s.at").alias("item_at"))
    # Two bits of the map per seed, gathered as 2^18 longs at most.
    bit = F.explode(F.array(F.col("seed").bitwiseAND(F.lit((1 << MAP_BITS) - 1)), F.shiftrightunsigned("seed", 32).bitwiseAND(F.lit((1 << MAP_BITS) - 1))))
    cells = (seeds.select("seed").distinct().select(bit.alias("b")).groupBy(F.shiftright("b", 6).alias("cell"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("bits")).collect())
    bitmap = np.zeros(1 << (MAP_BITS - 6), np.int64)
    for r in cells:
        bitmap[r.cell] = r.bits
    regions = written(
        docs.select(F.col(id_col).cast("long").alias("dc_id"), F.xxhash64(text_col).alias("dc_key"), F.col(text_col).alias("dc_text"))
        .mapInArrow(_regions(spark.sparkContext.broadcast(bitmap.tobytes()), masks, window), _REGION), spark)
    hits = (regions.select("dc_id", "dc_key", "region", F.explode("seeds").alias("s"))
            .select("dc_id", "dc_key", "region", F.col("s.seed").alias("seed"), F.col("s.at").alias("at")).join(seeds, "seed")
            .select("dc_id", "dc_key", "region", "item_id", "item_key", (F.col("at") - F.col("item_at")).alias("shift")).distinct())
    pairs = (hits.alias("h").join(items.drop("seeds").alias("i"), F.col("h.item_id").eqNullSafe(F.col("i.item_id")) & (F.col("h.item_key") == F.col("i.item_key")))
             .join(regions.drop("seeds").alias("r"), F.col("h.dc_id").eqNullSafe(F.col("r.dc_id")) & (F.col("h.dc_key") == F.col("r.dc_key")) & (F.col("h.region") == F.col("r.region")))
             .select("h.dc_id", "h.dc_key", "h.item_id", "tokens", "item_tokens", "shift"))
    return pairs.mapInArrow(_verify(window, min_equal), f"dc_id bigint, dc_key bigint, item_id {kind}, n_equal bigint, n_window bigint")


def overlaps(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
             item_text_col: str = "text", window: int = WINDOW, min_equal: int = MIN_EQUAL, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """One row per text and item that overlap: id, item, n_equal and n_window (long) of the best window."""
    checked = _verified(spark, docs, benchmark, id_col, text_col, item_col, item_text_col, window, min_equal, masks)
    best = F.max(F.struct("n_equal", "n_window"))
    return (checked.groupBy("dc_id", "item_id").agg(best.alias("b"))
            .select(F.col("dc_id").alias(id_col), F.col("item_id").alias(item_col), F.col("b.n_equal").alias("n_equal"), F.col("b.n_window").alias("n_window")))


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", window: int = WINDOW, min_equal: int = MIN_EQUAL, masks: tuple[str, ...] = MASKS) -> DataFrame:
    """``docs`` without the rows whose text overlaps some item; all columns pass through."""
    columns = docs.columns
    docs, _, at = plain(docs)
    id_col, text_col = at[id_col], at[text_col]
    found = _verified(spark, docs, benchmark, id_col, text_col, item_col, item_text_col, window, min_equal, masks).select("dc_id", "dc_key").distinct()
    return docs.join(found, F.col(id_col).cast("long").eqNullSafe(F.col("dc_id")) & (F.xxhash64(text_col) == F.col("dc_key")), "left_anti").toDF(*columns)
