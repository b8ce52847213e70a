"""Periodic runs of words by maximal pairs.

A run is a stretch of words with smallest period q that no neighbouring word extends.  It holds a maximal pair: the suffixes
at its start s and at s + q share length - q words, the words before them differ, and so do the words after.  Turned round,
a maximal pair at distance d that shares l >= d words is the stretch of l + d words from its first place, with period d and
extended by nothing.  So the pairs whose distance meets the length rule are the runs; where a stretch is met at several
distances (multiples of its period), the least one is its period.

Suffixes of one text are sorted by doubling (numpy).  Their LCP-interval tree is walked bottom-up: each interval keeps its
places in ascending order as lists of places that follow the same word (classes), the smaller child is looked up in the
larger one, lists of its own class are stepped over whole, and only places within the allowed distance are read.  Suffixes
that share fewer words than a run needs lie in no interval that matters, so texts without near repeats aren't sorted.

Words are ``[^\\x20\\x09-\\x0D]+`` and equal if their 64-bit hashes are (compared within a text only).  NULL, empty and
blank texts have no runs.  Every row is worked on alone: repeated rows, repeated or NULL ids give a row each, ties don't
arise (a run is its place and period), an empty table gives no rows.  Memory is some 100 bytes a word of the longest text.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import STEP, Words, chunks, combine, mix, plain, text_arrays

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUNS_DDL = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Places:
    """Places of an interval in ascending order, as lists of neighbours that follow the same word."""

    __slots__ = ("heads", "lists", "size")

    def __init__(self, place: int):
        self.heads, self.lists, self.size = [place], [[place]], 1

    def others(self, place: int, reach: int, before) -> list[int]:
        """Places at most ``reach`` away that follow another word than ``place`` does."""
        own, found = before[place], []
        low, high = place - reach, place + reach
        at = bisect_right(self.heads, high) - 1
        while at >= 0:
            part = self.lists[at]
            if part[-1] < low:
                break
            if before[part[0]] != own:
                found += part[bisect_left(part, low): bisect_right(part, high)]
            at -= 1
        return found

    def add(self, place: int, before) -> None:
        self.size += 1
        heads, lists = self.heads, self.lists
        own, at = before[place], bisect_right(self.heads, place) - 1
        if at >= 0:
            part = lists[at]
            if before[part[0]] == own:
                insort(part, place)
                return
            if place < part[-1]:
                cut = bisect_left(part, place)
                heads[at + 1: at + 1] = [place, part[cut]]
                lists[at + 1: at + 1] = [[place], part[cut:]]
                del part[cut:]
                return
        if at + 1 < len(heads) and before[lists[at + 1][0]] == own:
            lists[at + 1].insert(0, place)
            heads[at + 1] = place
        else:
            heads.insert(at + 1, place)
            lists.insert(at + 1, [place])


def _join(a: Places, b: Places, shared: int, exponent: int, before, found: dict) -> Places:
    """One interval of both children's places; maximal pairs between them go to ``found``: (start, length) -> least distance."""
    if a.size < b.size:
        a, b = b, a
    reach = shared // (exponent - 1)
    moved = [p for part in b.lists for p in part]
    if reach:
        for p in moved:
            for x in a.others(p, reach, before):
                start, d = (x, p - x) if x < p else (p, x - p)
                key = (start, shared + d)
                if d < found.get(key, d + 1):
                    found[key] = d
    for p in moved:
        a.add(p, before)
    return a


def walk(places: list[int], shared: list[int], exponent: int, before, found: dict) -> None:
    """Bottom-up over the tree of one stretch of the suffix order; ``shared[k]`` words join suffix k to the one before it."""
    open_, child = [], Places(places[0])
    for place, l in zip([*places[1:], None], [*shared[1:], -1]):
        while open_ and open_[-1][0] > l:
            top, node = open_.pop()
            child = _join(node, child, top, exponent, before, found)
        if open_ and open_[-1][0] == l:
            open_[-1][1] = _join(open_[-1][1], child, l, exponent, before, found)
        elif place is not None:
            open_.append([l, child])
        if place is not None:
            child = Places(place)


def suffix_order(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in the order of their suffixes, number of symbols that each shares with the one before it)."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    new = np.ones(n, bool)
    new[1:] = symbols[order[1:]] != symbols[order[:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, step = [], 1
    small = np.int32 if n < 2**31 else np.int64
    while True:
        levels.append(rank.astype(small))
        # Only suffixes that still share their rank are sorted again; ranks are places in the order.
        tied = np.flatnonzero(~new | np.append(~new[1:], False))
        if not len(tied):
            break
        at = order[tied]
        group = rank[at]
        later = np.where(at + step < n, rank[np.minimum(at + step, n - 1)], -1)
        sort = np.lexsort((later, group))
        at, group, later = at[sort], group[sort], later[sort]
        order[tied] = at
        new[tied[1:]] = (group[1:] != group[:-1]) | (later[1:] != later[:-1])
        rank[at] = tied[np.maximum.accumulate(np.where(new[tied], np.arange(len(tied)), 0))]
        step *= 2
    shared = np.zeros(n, np.int64)
    near = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    a, b, same = order[near], order[near - 1], np.zeros(len(near), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i, j = a + same, b + same
        inside = (i < n) & (j < n)
        equal = levels[k][np.minimum(i, n - 1)] == levels[k][np.minimum(j, n - 1)]
        same += np.where(inside & equal, 1 << k, 0)
    shared[near] = same
    return order, shared


def least_shared(least: int, exponent: int) -> int:
    """Fewest words that the pair of a run shares, over all periods."""
    return min(max(least - q, (exponent - 1) * q, 1) for q in range(1, least + 1))


def _near_repeats(words: Words, row: np.ndarray, least: int, exponent: int) -> np.ndarray:
    """Rows that may hold a run.

    Every ``width`` words of a run occur in it again, so it lies in one stretch of repeated places (where the rule is strict
    enough to leave no gaps in it), and the first place's next repeat is not farther than its period.
    """
    width = least_shared(least, exponent)
    solid = exponent > 2 and all(max(least - q, (exponent - 1) * q) - width + 1 >= q for q in range(1, least + 1))
    grams = combine(words.hashes, width)
    at = np.flatnonzero(row[: len(grams)] == row[width - 1:]) if len(grams) else np.zeros(0, np.int64)
    if not len(at):
        return at
    key = mix(grams[at] + row[at].astype(np.uint64) * STEP)
    order = np.argsort(key, kind="stable")
    key, at = key[order], at[order]
    again = np.flatnonzero(key[1:] == key[:-1])
    if not len(again):
        return again
    gap = np.full(len(row), len(row) + 1, np.int64)
    gap[at[again]] = at[again + 1] - at[again]
    active = np.zeros(len(row), bool)
    active[at[again]] = active[at[again + 1]] = True
    places = np.flatnonzero(active)
    cut = row[places[1:]] != row[places[:-1]]
    first = np.flatnonzero(np.concatenate([[True], cut | (places[1:] != places[:-1] + 1) if solid else cut]))
    if not solid:
        return row[places[first]]
    size = np.diff(np.append(first, len(places)))
    fits = np.minimum.reduceat(gap[places], first) <= (size + width - 1) // exponent
    return np.unique(row[places[first[fits]]])


def runs_of(words: Words, least: int = LEAST_LENGTH, exponent: int = LEAST_EXPONENT) -> dict[int, list[tuple[int, int, int]]]:
    """Row -> its runs (start, length, period) by start and period, for rows that have any."""
    n_words = np.diff(words.offsets)
    row = np.repeat(np.arange(len(n_words)), n_words)
    wanted = _near_repeats(words, row, least, exponent)
    if not len(wanted):
        return {}
    taken = np.flatnonzero(np.isin(row, wanted))
    own = row[taken]
    _, symbol = np.unique(words.hashes[taken], return_inverse=True)
    symbol = symbol + own * np.int64(len(symbol) + 1)
    before = np.full(len(taken), -1, np.int64)
    before[1:] = np.where(own[1:] == own[:-1], symbol[:-1], -1)
    order, shared = suffix_order(symbol)
    # Trees of at least ``lowest`` shared words in which two places are near enough for the deepest interval.
    lowest = least_shared(least, exponent)
    inner = shared >= lowest
    first = np.flatnonzero(~inner & np.append(inner[1:], False))
    end = np.flatnonzero(inner & ~np.append(inner[1:], False)) + 1
    found: dict[tuple[int, int], int] = {}
    if len(first):
        size = end - first
        tree = np.repeat(np.arange(len(first)), size)
        at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        place = order[at]
        sort = np.lexsort((place, tree))
        gap = np.diff(place[sort], prepend=0)
        head = np.cumsum(size) - size
        gap[head] = len(taken) + 1
        near = np.minimum.reduceat(gap, head) * (exponent - 1) <= np.maximum.reduceat(np.where(np.isin(at, first), 0, shared[at]), head)
        before = before.tolist()
        for a, b in zip(first[near].tolist(), end[near].tolist()):
            walk(order[a:b].tolist(), shared[a:b].tolist(), exponent, before, found)
    begin = words.offsets[own[np.array([s for s, _ in found], np.int64)]] if found else []
    out: dict[int, list[tuple[int, int, int]]] = {}
    for ((s, length), d), offset in zip(found.items(), begin):
        if length >= max(least, exponent * d):
            out.setdefault(int(own[s]), []).append((int(taken[s]) - int(offset), length, d))
    return {r: sorted(v, key=lambda x: (x[0], x[2])) for r, v in out.items()}


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words without those that a run holds after its first period."""
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    kept = np.cumsum(drop)[:-1] == 0
    return [w for w, k in zip(words, kept.tolist()) if k]


def _find(least: int, exponent: int, names: list[str]):
    def run(batches):
        for batch in batches:
            data, offsets = text_arrays(batch.column(batch.num_columns - 1))
            raw = data.tobytes()
            null = batch.column(batch.num_columns - 1).is_null().to_pylist()
            for i, j in chunks(offsets):
                words = Words(data, offsets, i, j, lower=False)
                runs = runs_of(words, least, exponent)
                texts = []
                for k in range(i, j):
                    own = raw[offsets[k]: offsets[k + 1]].split()
                    texts.append(None if null[k] else b" ".join(collapse(own, runs[k - i]) if k - i in runs else own))
                rows = [[{"start": s, "length": n, "period": d} for s, n, d in runs.get(k, ())] for k in range(j - i)]
                yield pa.RecordBatch.from_arrays([*(c.slice(i, j - i) for c in batch.columns[:-1]), pa.array(np.diff(words.offsets).astype(np.int64)),
                                                  pa.array(rows, pa.list_(_RUN)), pa.array(texts, pa.binary()).cast(pa.string())], names=names)

    return run


def find_runs(spark: SparkSession, docs: DataFrame, keep: list[str] = ("doc_id",), text_col: str = "text",
              least: int = LEAST_LENGTH, exponent: int = LEAST_EXPONENT) -> DataFrame:
    """The ``keep`` columns, n_words, runs (start word, length, period; by start and period) and collapsed.

    Runs have at least ``least`` words and ``exponent`` periods.  ``collapsed`` is the text's words joined by one space
    without those that a run holds after its first period; NULL for NULL.  Added columns replace kept ones of their names.
    """
    added = ("n_words", "runs", "collapsed")
    keep = [k for k in keep if k not in added]
    renamed, names, _ = plain(docs.select(*keep, F.col(text_col).alias("text")))
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in renamed.schema[:-1]), f"n_words bigint, runs {_RUNS_DDL}, collapsed string"])
    return renamed.mapInArrow(_find(least, exponent, [*names[:-1], *added]), schema).toDF(*keep, *added)
