"""Ranked lexical search by geometric blocks of posting lists.

Scores are sums of integer term weights times a saturating share of the term count (``weight`` and ``impacts``); a query gets
its ``k`` best texts, ties by ascending id.

*Index.*  Texts are reduced to their counts of the queries' terms and sorted by likeness: the two of ``CENTRES`` sampled texts
that a text's impact vector is nearest to.  Stretches of this order are stored as segments.  In a segment every posting list
is cut, in order of likeness, into blocks of at most ``BLOCK`` texts; a block stores the greatest impact of every term over
its texts (its summary).  Lists of at most ``BLOCK`` texts in the whole corpus are one block.

*Search.*  A query's terms are ordered from rare to common, and a text is looked for in the list of its rarest query term, so
the block of a term counts towards a query with that term and the more common ones only.  (1) Lists of one block are scored in
full, with a sample of texts; the k-th best score of each query is its first threshold.  (2) A list whose greatest impacts
over the whole corpus stay below the threshold is skipped, and isn't indexed if all queries skip it.  (3) In every segment a
query skips the blocks whose summary bound is below its threshold (bounds are exact integers, an equal one is read), texts of
the others are scored in full, and the threshold rises.  Skipping never changes a result, only the time.

Queries are worked on in sets of at most ``ENTRIES`` (query, term) entries (or one query), so what is broadcast is bounded.
The corpus passes through no task whole; a task keeps k results a query.  Terms are compared by 64-bit hashes against those
of one set of queries.

NULL, empty and term-less texts count nowhere; queries without terms, or whose terms no text holds, give no rows, as do empty
tables.  Repeated texts are ranked each for itself, by id; every row of the queries is a query of its own, and rows of one
id and text give the same rows again.  Ids are integers; NULL ids come after all others.  Other columns aren't read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.llm.common import Words, chunks, hash_share, text_arrays, written

K = 10
BLOCK = 128
CENTRES = 32
SAMPLE = 16_384
"""Texts (expected) that are scored for the first thresholds."""
ENTRIES = 1 << 18
SEGMENT_TEXTS, SEGMENT_CELLS = 2_048, 1 << 22
"""A segment has at most so many texts, and so many cells in its table of texts and terms (32 texts at least)."""

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BETWEEN = np.zeros(256, bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _BETWEEN[_low: _high + 1] = True
_NO_ID = np.iinfo(np.int64).max
_VECTORS = "doc_id bigint, n bigint, terms array<int>, counts array<int>"
_FOUND = "kind int, item int, score bigint, doc_id bigint"
RESULT, SAMPLED, GREATEST = range(3)


def weight(n_texts: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_texts + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def _int32(offsets) -> pa.Array:
    return pa.array(np.asarray(offsets).astype(np.int32))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, … of each range, one after the other."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _query_terms(batches):
    """Queries as their distinct term hashes."""
    for batch in batches:
        data, offsets = text_arrays(batch.column(1))
        for i, j in chunks(offsets):
            words = Words(data, offsets, i, j, between=_BETWEEN)
            terms = [np.unique(words.hashes[a:b]).view(np.int64) for a, b in zip(words.offsets[:-1], words.offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(terms, pa.list_(pa.int64()))], names=["item_id", "terms"])


def _count(vocabulary):
    """Texts with a term as their number of terms and the counts of those in the vocabulary."""
    def run(batches):
        known = np.frombuffer(vocabulary.value, np.uint64)
        for batch in batches:
            data, offsets = text_arrays(batch.column(1))
            for i, j in chunks(offsets):
                words = Words(data, offsets, i, j, between=_BETWEEN)
                n = np.diff(words.offsets)
                at = np.minimum(np.searchsorted(known, words.hashes), len(known) - 1)
                hit = known[at] == words.hashes
                row = np.repeat(np.arange(j - i), n)
                key, count = np.unique(row[hit] * len(known) + at[hit], return_counts=True)
                some = np.flatnonzero(n)
                edges = np.searchsorted(key // len(known), np.append(some, j - i))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i).take(pa.array(some)), pa.array(n[some].astype(np.int64)),
                     pa.ListArray.from_arrays(_int32(edges), pa.array((key % len(known)).astype(np.int32))),
                     pa.ListArray.from_arrays(_int32(edges), pa.array(count.astype(np.int32)))], names=["doc_id", "n", "terms", "counts"])

    return run


class Queries:
    """A set of queries: terms numbered from rare to common, weights, and the queries' terms in this order.

    ``place`` maps a vocabulary number to the term's; terms before ``short`` have lists of one block; ``item_terms`` and
    ``term_items`` are (offsets, values) of each query's terms and each term's queries.
    """

    def __init__(self, items: list[np.ndarray], df: np.ndarray, n_texts: int, n_words: int, k: int, block: int):
        order = np.argsort(df, kind="stable")
        self.place = np.empty(len(df), np.int64)
        self.place[order] = np.arange(len(df))
        self.weights = weight(n_texts, df[order])
        self.short = int(np.searchsorted(df[order], block, side="right"))
        self.n_texts, self.n_words, self.k, self.block = n_texts, n_words, k, block
        self.items = [np.sort(self.place[t]) for t in items]
        size = np.array([len(t) for t in items], np.int64)
        flat = np.concatenate(self.items)
        owner = np.repeat(np.arange(len(items)), size)
        by_term = np.argsort(flat, kind="stable")
        self.term_items = (np.searchsorted(flat[by_term], np.arange(len(df) + 1)), owner[by_term])

    def impacts(self, n: np.ndarray, row: np.ndarray, term: np.ndarray, count: np.ndarray) -> np.ndarray:
        long = 100 - 90 + (90 * n * self.n_texts) // self.n_words
        return self.weights[term] * ((1_000_000_000 * count) // (1000 * count + 8 * long[row]))

    def queries_of(self, row: np.ndarray, term: np.ndarray) -> np.ndarray:
        """Pairs row * queries + query that share one of the given postings, each once."""
        offsets, values = self.term_items
        sizes = offsets[term + 1] - offsets[term]
        return np.unique(np.repeat(row, sizes) * len(self.items) + values[_ranges(offsets[term], sizes)])

    def scores(self, pairs: np.ndarray, edges: np.ndarray, term: np.ndarray, impact: np.ndarray) -> np.ndarray:
        """Full score of each pair (ascending, with a shared posting); ``edges`` are the rows' bounds in the postings."""
        row, item = np.divmod(pairs, len(self.items))
        size = edges[row + 1] - edges[row]
        out = np.zeros(len(pairs), np.int64)
        for a in range(0, len(pairs), 4096):
            b = min(a + 4096, len(pairs))
            at = _ranges(edges[row[a:b]], size[a:b])
            asked = np.unique(item[a:b])
            wanted = np.concatenate([x * len(self.place) + self.items[x] for x in asked.tolist()])
            key = np.repeat(item[a:b], size[a:b]) * len(self.place) + term[at]
            found = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
            out[a:b] = np.add.reduceat(np.where(wanted[found] == key, impact[at], 0), np.cumsum(size[a:b]) - size[a:b])
        return out


class Postings:
    """Postings of a batch of vectors: row edges, terms ascending within a row, impacts."""

    def __init__(self, queries: Queries, batch: pa.RecordBatch):
        lists = batch.column(2)
        edges = lists.offsets.to_numpy().astype(np.int64)
        self.n = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        self.ids = batch.column(0).cast(pa.int64()).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
        term = queries.place[lists.values.to_numpy()[edges[0]: edges[-1]]]
        count = batch.column(3).values.to_numpy()[edges[0]: edges[-1]].astype(np.int64)
        self.edges = edges - edges[0]
        self.row = np.repeat(np.arange(len(self.n)), np.diff(edges))
        order = np.lexsort((term, self.row))
        self.term, self.count = term[order], count[order]
        self.impact = queries.impacts(self.n, self.row, self.term, self.count)


class Best:
    """The best ``k`` (score, id) of each query seen so far."""

    def __init__(self, k: int):
        self.k, self.found = k, np.zeros((3, 0), np.int64)

    def add(self, item: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        both = np.concatenate([self.found, np.stack([item, score, ids])], axis=1)
        both = both[:, np.lexsort((both[2], -both[1], both[0]))]
        first = np.searchsorted(both[0], both[0])
        self.found = both[:, np.arange(both.shape[1]) - first < self.k]

    def thresholds(self, least: np.ndarray) -> np.ndarray:
        """``least`` raised to the k-th best score of queries that have k."""
        item, score = self.found[:2]
        full = np.flatnonzero(np.arange(len(item)) - np.searchsorted(item, item) == self.k - 1)
        out = least.copy()
        out[item[full]] = np.maximum(out[item[full]], score[full])
        return out

    def batch(self, kind: int) -> pa.RecordBatch:
        item, score, ids = self.found
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(item), kind, np.int32)), pa.array(item.astype(np.int32)), pa.array(score),
                                           pa.array(ids, mask=ids == _NO_ID)], names=["kind", "item", "score", "doc_id"])


def _first_round(shared):
    """Best of the lists of one block, best of the sampled texts not among them, and the greatest impact of every term."""
    def run(batches):
        queries = shared.value
        best, sampled, greatest = Best(queries.k), Best(queries.k), np.zeros(len(queries.place), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            p = Postings(queries, batch)
            np.maximum.at(greatest, p.term, p.impact)
            rare = p.term < queries.short
            pairs = queries.queries_of(p.row[rare], p.term[rare])
            drawn = batch.column(4).to_numpy(zero_copy_only=False)[p.row] & ~rare
            more = np.setdiff1d(queries.queries_of(p.row[drawn], p.term[drawn]), pairs, assume_unique=True)
            for into, some in ((best, pairs), (sampled, more)):
                if len(some):
                    row, item = np.divmod(some, len(queries.items))
                    score = queries.scores(some, p.edges, p.term, p.impact)
                    good = score > 0
                    into.add(item[good], score[good], p.ids[row[good]])
        yield best.batch(RESULT)
        yield sampled.batch(SAMPLED)
        some = np.flatnonzero(greatest)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), GREATEST, np.int32)), pa.array(some.astype(np.int32)), pa.array(greatest[some]),
                                          pa.nulls(len(some), pa.int64())], names=["kind", "item", "score", "doc_id"])

    return run


def _likeness(shared, names):
    """Vectors with the numbers of the two centres that they are nearest to."""
    def run(batches):
        queries, centres = shared.value
        for batch in batches:
            p = Postings(queries, batch)
            near = np.zeros((len(p.n), centres.shape[1]), np.float32)
            for i, j in chunks(p.edges, 1 << 16):
                a, b = p.edges[i], p.edges[j]
                if b > a:
                    some = np.flatnonzero(np.diff(p.edges[i: j + 1])) + i
                    near[some] = np.add.reduceat(centres[p.term[a:b]] * p.impact[a:b, None].astype(np.float32), p.edges[some] - a, axis=0)
            two = np.argsort(-near, axis=1, kind="stable")[:, :2]
            code = two[:, 0] * centres.shape[1] + two[:, -1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code.astype(np.int32))], names=names)

    return run


def _centres(queries: Queries, sample: pa.Table) -> np.ndarray:
    """Term x centre: impact vectors of the sampled texts, each of length 1."""
    out = np.zeros((len(queries.place), max(sample.num_rows, 1)), np.float32)
    for batch in sample.combine_chunks().to_batches():
        p = Postings(queries, batch)
        out[p.term, p.row] = p.impact
    return out / np.maximum(np.sqrt((out ** 2).sum(0)), 1e-9)


_SEGMENT = {"ids": pa.int64(), "n": pa.int64(), "edges": pa.int32(), "terms": pa.int32(), "counts": pa.int32(),
            "block_term": pa.int32(), "block_texts": pa.int32(), "block_edges": pa.int32(), "block_coords": pa.int32(), "coord_edges": pa.int32(), "greatest": pa.int64()}
_SEGMENT_DDL = ", ".join(f"{n} array<{'bigint' if t == pa.int64() else 'int'}>" for n, t in _SEGMENT.items())


def _segments(shared, cells: int, most: int):
    """Segments of the sorted vectors: the texts' postings and the blocks of every list that some query reads."""
    def run(batches):
        queries, is_read = shared.value
        long = len(queries.place) - queries.short
        size = int(np.clip(cells // max(long, 1), 32, most))
        pieces, held = [], 0

        def segment():
            table = pa.Table.from_batches(pieces).combine_chunks()
            p = Postings(queries, table.to_batches()[0])
            common = p.term >= queries.short
            row, term = p.row[common], p.term[common] - queries.short
            dense = np.zeros((len(p.n), long), np.int64)
            dense[row, term] = p.impact[common]
            by_term = np.argsort(term, kind="stable")
            edges = np.searchsorted(term[by_term], np.arange(long + 1))
            blocks = {n: [] for n in ("block_term", "block_texts", "block_coords", "greatest")}
            sizes, coords = [], []
            for t in np.flatnonzero(np.diff(edges) * is_read[queries.short:]).tolist():
                texts = row[by_term[edges[t]: edges[t + 1]]]
                starts = np.arange(0, len(texts), queries.block)
                top = np.maximum.reduceat(dense[texts, t:], starts, axis=0)
                at, u = np.nonzero(top)
                blocks["block_term"].append(np.full(len(starts), t + queries.short))
                blocks["block_texts"].append(texts)
                blocks["block_coords"].append(u + t + queries.short)
                blocks["greatest"].append(top[at, u])
                sizes.append(np.diff(np.append(starts, len(texts))))
                coords.append(np.bincount(at, minlength=len(starts)))
            join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
            values = {"ids": p.ids, "n": p.n, "edges": p.edges, "terms": p.term, "counts": p.count, **{n: join(v) for n, v in blocks.items()},
                      "block_edges": np.concatenate([[0], np.cumsum(join(sizes))]), "coord_edges": np.concatenate([[0], np.cumsum(join(coords))])}
            columns = []
            for n, t in _SEGMENT.items():
                own = pa.array(np.asarray(values[n]), pa.int64()).cast(t)
                columns.append(pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own))
            return pa.RecordBatch.from_arrays(columns, names=list(_SEGMENT))

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, size - held)
                pieces.append(piece)
                held, at = held + piece.num_rows, at + piece.num_rows
                if held == size:
                    yield segment()
                    pieces, held = [], 0
        if held:
            yield segment()

    return run


def _search(shared):
    """Best of the texts in blocks that their summaries don't rule out."""
    def run(batches):
        queries, reads, thresholds = shared.value
        short, long = queries.short, len(queries.place) - queries.short
        best = Best(queries.k)
        for batch in batches:
            for r in range(batch.num_rows):
                s = {n: batch.column(k)[r].values.to_numpy() for k, n in enumerate(_SEGMENT)}
                edges, term = s["edges"].astype(np.int64), s["terms"].astype(np.int64)
                row = np.repeat(np.arange(len(s["n"])), np.diff(edges))
                impact = queries.impacts(s["n"], row, term, s["counts"].astype(np.int64))
                common = term >= short
                dense = np.zeros((len(s["n"]), long), np.int64)
                dense[row[common], term[common] - short] = impact[common]
                done = queries.queries_of(row[~common], term[~common])
                first = np.searchsorted(s["block_term"], np.arange(short, short + long + 1))
                summary = np.zeros((len(s["block_term"]), long), np.int64)
                summary[np.repeat(np.arange(len(s["block_term"])), np.diff(s["coord_edges"])), s["block_coords"] - short] = s["greatest"]
                found = []
                for item, lists in reads:
                    own = queries.items[item]
                    open_ = []
                    for t in lists.tolist():
                        a, b = first[t - short], first[t - short + 1]
                        if b > a:
                            bound = summary[a:b, own[own >= t] - short].sum(1)
                            open_ += (a + np.flatnonzero((bound >= thresholds[item]) & (bound > 0))).tolist()
                    if open_:
                        texts = np.unique(np.concatenate([s["block_texts"][s["block_edges"][k]: s["block_edges"][k + 1]] for k in open_]))
                        texts = texts[~np.isin(texts * len(queries.items) + item, done)]
                        score = dense[texts][:, own[own >= short] - short].sum(1)
                        good = (score >= thresholds[item]) & (score > 0)
                        found.append((np.full(int(good.sum()), item), score[good], s["ids"][texts[good]]))
                if found:
                    best.add(*(np.concatenate(x) for x in zip(*found)))
                    thresholds = best.thresholds(thresholds)
        yield best.batch(RESULT)

    return run


def _sets(items: DataFrame, entries: int) -> int:
    """Number of sets into which queries go by hash, so that none has over ``entries`` entries unless one query has."""
    sets = 1
    while True:
        sizes = items.groupBy(F.pmod(F.col("draw"), F.lit(sets)).alias("s")).agg(F.sum(F.size("terms")).alias("all"), F.count("*").alias("n"))
        if not sizes.filter((F.col("all") > entries) & (F.col("n") > 1)).limit(1).collect():
            return sets
        sets *= 2


def _set_results(spark: SparkSession, docs: DataFrame, items: list, k: int, block: int, sample: int, segment: tuple[int, int]) -> DataFrame:
    """(item, score, doc_id) of a set of queries; holds every query's k best."""
    terms = [np.asarray(r.terms, np.int64).view(np.uint64) for r in items]
    vocabulary = np.unique(np.concatenate(terms))
    vectors = written(docs.mapInArrow(_count(spark.sparkContext.broadcast(vocabulary.tobytes())), _VECTORS), spark)
    total = vectors.agg(F.count("*").alias("texts"), F.sum("n").alias("words")).first()
    if not total.texts:
        return spark.createDataFrame([], _FOUND).drop("kind")
    df = np.zeros(len(vocabulary), np.int64)
    counted = vectors.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()
    df[counted["t"].to_numpy()] = counted["count"].to_numpy()
    queries = Queries([np.searchsorted(vocabulary, t) for t in terms], df, total.texts, total.words, k, block)
    drawn = hash_share(F.xxhash64("doc_id", "n")) < min(sample / total.texts, 1.0)
    shared = spark.sparkContext.broadcast(queries)
    first = written(vectors.filter(F.size("terms") > 0).withColumn("drawn", drawn).mapInArrow(_first_round(shared), _FOUND), spark)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
    reached = first.filter(F.col("kind") != GREATEST).withColumn("r", rank).filter(F.col("r") == k).select("item", "score").collect()
    thresholds = np.zeros(len(items), np.int64)
    for r in reached:
        thresholds[r.item] = r.score
    greatest = np.zeros(len(vocabulary), np.int64)
    for r in first.filter(F.col("kind") == GREATEST).groupBy("item").agg(F.max("score").alias("score")).collect():
        greatest[r.item] = r.score
    # A list stays open while it and the more common ones can reach the threshold.
    reads, is_read = [], np.zeros(len(vocabulary), bool)
    for item, own in enumerate(queries.items):
        own = own[own >= queries.short]
        reach = np.cumsum(greatest[own][::-1])[::-1]
        lists = own[(reach >= thresholds[item]) & (reach > 0)]
        if len(lists):
            reads.append((item, lists))
            is_read[lists] = True
    results = first.filter(F.col("kind") == RESULT).drop("kind")
    if not reads:
        return results
    centres = _centres(queries, vectors.filter(F.size("terms") > 0).orderBy(F.xxhash64("doc_id", "n")).limit(CENTRES).toArrow())
    coded = (vectors.filter(F.size("terms") > 0).withColumn("spread", F.xxhash64("n", "doc_id"))
             .mapInArrow(_likeness(spark.sparkContext.broadcast((queries, centres)), ["doc_id", "n", "terms", "counts", "spread", "code"]), f"{_VECTORS}, spread bigint, code int"))
    ordered = coded.repartitionByRange("code", "spread").sortWithinPartitions("code", "spread").select("doc_id", "n", "terms", "counts")
    index = written(ordered.mapInArrow(_segments(spark.sparkContext.broadcast((queries, is_read)), *segment), _SEGMENT_DDL), spark)
    found = index.mapInArrow(_search(spark.sparkContext.broadcast((queries, reads, thresholds))), _FOUND)
    return results.unionByName(found.drop("kind"))


def search(spark: SparkSession, docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", block: int = BLOCK, sample: int = SAMPLE, entries: int = ENTRIES, segment: tuple[int, int] = (SEGMENT_CELLS, SEGMENT_TEXTS)) -> DataFrame:
    """item_id, rank (int), doc_id, score (long): the ``k`` best texts of every query, with scores above 0."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    item_type = items.schema[item_col].dataType
    asked = (items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).mapInArrow(_query_terms, f"item_id {item_type.simpleString()}, terms array<bigint>")
             .filter(F.size("terms") > 0).withColumn("draw", F.xxhash64("item_id", "terms")))
    asked = written(asked, spark)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    out = spark.createDataFrame([], asked.schema).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    sets = _sets(asked, entries)
    for s in range(sets):
        own = asked.filter(F.pmod(F.col("draw"), F.lit(sets)) == s).collect()
        if own:
            found = _set_results(spark, texts, own, k, block, sample, segment)
            names = spark.createDataFrame([(n, r.item_id) for n, r in enumerate(own)], f"item int, item_id {item_type.simpleString()}")
            found = found.withColumn("rank", rank).filter(F.col("rank") <= k)
            out = out.unionByName(found.join(names, "item").select("item_id", "rank", "doc_id", "score"))
    return out


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{t}') AS terms FROM documents),
n AS (SELECT r, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
s AS (SELECT count(*) AS texts, sum(n)::BIGINT AS words FROM n),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{t}')) AS term FROM benchmark),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, floor(1000 * ln((2 * any_value(texts) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term),
c AS (SELECT q.item_id, n.r, n.doc_id, sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (100 - 90 + (90 * n.n * s.texts) // s.words))))::BIGINT AS score
      FROM q JOIN p USING (term) JOIN w USING (term) JOIN n ON n.r = p.r, s GROUP BY ALL),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r) AS rank, doc_id, score FROM c WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM k WHERE rank <= 10""".replace("{t}", TERM)
