"""Exact Jaccard join of n-gram sets in their metric space.

Sets of shingles with the distance 1 - Jaccard are a metric space.  Texts with equal sets are one point of it.  Two points
link when 100 * intersection >= 85 * union, a radius r of 0.15.

*First pivots.*  Unrelated texts lie about 1 apart, so with texts as the only pivots every border window would hold every
point.  The first level therefore takes the one-element sets as pivots, rarest shingle first: a point belongs to the region
of its rarest shingle and is replicated, as a border point, to those of its next rarest ones, n - ceil(0.85 n) + 1 in all,
since two sets within r of each other share one of these.  Any order of the shingles is exact; the broadcast table of the
``hot`` most repeated ones (at most 2^20 entries, 16 MB) only keeps regions small.

*Recursion.*  A region's pivot is then its most central text, the one with the smallest share of rare shingles.  Distances
to it link the points within r, which keep the level they linked at; the others stay outside.  Points linked at the same
level are connected by its pivot.  All points that are not linked to the newest pivot, with those of its points that the
triangle inequality leaves in reach of them (d(x, p) >= d(y, p) - r), form the next region, which is divided again while
it has points outside and more than ``LEAF`` members (``rounds`` times at most).  What is left, where more than one
component remains, is compared within the windows directly: all pairs of different components, whether outside or linked
to pivots of different levels.  Points already known to be connected are not compared again, so a group of near copies
costs links to its centre and not all its pairs; no link between different components is lost.

Shingles are 64-bit hashes.  The result has one row per input row, with repeated rows kept.  NULL and empty texts have an
empty set, link with nothing and are their own component.  Rows with a NULL id take part; component_id is the least id that
is not NULL, and NULL if there is none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import Words, chunks, combine, discard, mix, most_frequent, plain, text_arrays, written
from touchline.llm.components import components

WIDTH, PERCENT, ROUNDS, LEAF = 4, 85, 4, 32
HOT = 1 << 20
HOLD = 1 << 22
"""Shingles a task holds while it looks for repeated ones."""
MAP_BITS = 26


def shingle_sets(data: np.ndarray, offsets: np.ndarray, i: int, j: int, width: int):
    """Sorted distinct shingles of rows i..j, one after another, and their row offsets."""
    words = Words(data, offsets, i, j)
    n = np.diff(words.offsets)
    grams = combine(words.hashes, width)
    row = np.repeat(np.arange(j - i), n)
    whole = row[: len(grams)] == row[width - 1:] if len(grams) else np.zeros(0, bool)
    row, grams = row[: len(grams)][whole], grams[whole]
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        # A text with fewer words is one shingle of its own kind.
        row = np.concatenate([row, short])
        grams = np.concatenate([grams, [mix(combine(words.hashes[words.offsets[r]: words.offsets[r + 1]], n[r]) + np.uint64(n[r]))[0] for r in short]])
    order = np.lexsort((grams, row))
    row, grams = row[order], grams[order]
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (grams[1:] != grams[:-1])]) if len(row) else np.zeros(0, bool)
    row, grams = row[new], grams[new]
    return grams, np.searchsorted(row, np.arange(j - i + 1))


def _signatures(grams, offsets):
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(grams ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    return mix(total[offsets[1:]] - total[offsets[:-1]] + np.diff(offsets).astype(np.uint64)).view(np.int64)


def _repeated(width):
    """Shingles that several different sets of a task have, with how many."""
    def run(batches):
        seen: set[int] = set()
        held: list[np.ndarray] = []

        def flush():
            t, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(t[n > 1].view(np.int64)), pa.array(n[n > 1].astype(np.int64))], names=["t", "n"])

        for batch in batches:
            data, offsets = text_arrays(batch.column(0))
            for i, j in chunks(offsets):
                grams, upto = shingle_sets(data, offsets, i, j, width)
                for r, s in enumerate(_signatures(grams, upto).tolist()):
                    if s not in seen:
                        seen.add(s)
                        held.append(grams[upto[r]: upto[r + 1]])
                if sum(map(len, held)) > HOLD:
                    yield flush()
        if held:
            yield flush()

    return run


def _points(hot, width, percent):
    """Per row: set size, signature, share of rare shingles (per mille) and, once per task and set, its prefix, also as 16-bit marks."""
    def run(batches):
        shingles, counts = np.frombuffer(hot.value[0], np.uint64), np.frombuffer(hot.value[1], np.int64)
        seen: set[int] = set()
        for batch in batches:
            data, offsets = text_arrays(batch.column(2))
            for i, j in chunks(offsets):
                grams, upto = shingle_sets(data, offsets, i, j, width)
                n = np.diff(upto)
                signature = _signatures(grams, upto)
                weight = np.zeros(len(grams), np.int64)
                if len(shingles):
                    at = np.minimum(np.searchsorted(shingles, grams), len(shingles) - 1)
                    weight = np.where(shingles[at] == grams, counts[at], 0)
                row = np.repeat(np.arange(j - i), n)
                rare = np.bincount(row, weights=weight == 0, minlength=j - i)
                order = np.lexsort((grams, weight, row))
                length = np.where(n > 0, n - -(-percent * n // 100) + 1, 0)
                for r, s in enumerate(signature.tolist()):
                    if s in seen:
                        length[r] = 0
                    elif n[r]:
                        seen.add(s)
                if len(seen) > HOLD:
                    seen.clear()
                first = np.repeat(upto[:-1], length) + np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
                ends = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                prefix = grams[order][first]
                marks = (mix(prefix) & np.uint64(0xFFFF)).astype(np.uint16).view(np.int16)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(signature), pa.array(n.astype(np.int64)), pa.array((1000 * rare / np.maximum(n, 1)).astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(prefix.view(np.int64))), pa.ListArray.from_arrays(pa.array(ends), pa.array(marks))],
                    names=["id", "key", "x", "n", "rare", "prefix", "marks"])

    return run


def _bitmap(spark: SparkSession, values: DataFrame, column: str):
    """Broadcast bit map of fixed size (8 MB) in which the bits of all values of a long column are set.

    The driver and every executor keep a broadcast in a file of its size: whoever asks for one destroys it once what reads it is written.
    """
    cell = F.col(column).bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    cells = (values.select(cell.alias("b")).groupBy(F.shiftright("b", 6).alias("cell"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("bits")).toArrow())
    bits = np.zeros(1 << (MAP_BITS - 6), np.int64)
    bits[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return spark.sparkContext.broadcast(bits.view(np.uint8).tobytes())


def _in_map(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values.view(np.uint64) & np.uint64((1 << MAP_BITS) - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _shared_members(bitmap):
    """Members (shingle, place in the prefix) of regions that pass the bit map."""
    def run(batches):
        bits = np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            prefix = batch.column("prefix")
            length = prefix.value_lengths().to_numpy()
            t = prefix.flatten().to_numpy()
            owner = np.repeat(np.arange(len(batch)), length)
            place = np.arange(len(t)) - np.repeat(np.cumsum(length) - length, length)
            keep = np.flatnonzero(_in_map(bits, t))
            own = pa.array(owner[keep])
            yield pa.RecordBatch.from_arrays([pa.array(t[keep]), batch.column("x").take(own), batch.column("n").take(own), batch.column("rare").take(own), pa.array(place[keep].astype(np.int32))],
                                             names=["t", "x", "n", "rare", "place"])

    return run


def _heads_in(bitmap):
    """Heads whose point passes the bit map."""
    def run(batches):
        bits = np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            yield batch.filter(pa.array(_in_map(bits, batch.column("x").to_numpy())))

    return run


def _wanted_sets(bitmap, keys, width):
    """Shingles of the points that pass the bit map; only texts whose key passes that of the keys are cut into words."""
    def run(batches):
        bits, key_bits = np.frombuffer(bitmap.value, np.uint8), np.frombuffer(keys.value, np.uint8)
        seen: set[int] = set()
        for batch in batches:
            asked = np.flatnonzero(_in_map(key_bits, batch.column("key").to_numpy()))
            if not len(asked):
                continue
            data, offsets = text_arrays(batch.column("text").take(pa.array(asked)))
            for i, j in chunks(offsets):
                grams, upto = shingle_sets(data, offsets, i, j, width)
                signature = _signatures(grams, upto)
                rows = []
                for r in np.flatnonzero(_in_map(bits, signature) & (np.diff(upto) > 0)).tolist():
                    if int(signature[r]) not in seen:
                        seen.add(int(signature[r]))
                        rows.append(r)
                if len(seen) > HOLD:
                    seen.clear()
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(signature[rows]), pa.array([grams[upto[r]: upto[r + 1]].view(np.int64) for r in rows], pa.list_(pa.int64()))], names=["x", "grams"])

    return run


def _can_link(n1: Column, n2: Column, place1: Column, place2: Column, percent: int) -> Column:
    """Sizes allow the link, and so do the shingles left after this one, if it is the first that both share."""
    need = F.ceil(percent * (n1 + n2) / (100 + percent) - 1e-9)
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & (F.least(n1 - place1, n2 - place2) >= need)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select("x").unionAll(pairs.select(F.col("y").alias("x")))


class _Join:
    def __init__(self, spark: SparkSession, texts: DataFrame, points: DataFrame, width: int, percent: int):
        self.spark, self.texts, self.width, self.percent = spark, texts, width, percent
        heads = points.filter(F.size("prefix") > 0).groupBy("x").agg(F.first(F.struct("n", "marks", "key")).alias("h")).select("x", "h.n", "h.marks", "h.key")
        self.heads = written(heads, spark)
        self.radius = 1 - percent / 100 + 1e-9
        self.scratch = [self.heads]

    def kept(self, df: DataFrame) -> DataFrame:
        """``df`` as a table that stays until ``close``."""
        self.scratch.append(written(df, self.spark))
        return self.scratch[-1]

    def close(self) -> None:
        """Remove all tables; nothing that reads the links or members may still be open."""
        discard(*self.scratch)
        self.scratch = []

    def distances(self, pairs: DataFrame) -> DataFrame:
        """(x, y, d, linked) of those pairs of points that can link, with the points' shingles read once more for these only.

        If two prefixes share A shingles, the sets share at most A and what the longer one has besides its prefix.  A is
        overestimated from the 16-bit marks (marks that coincide within a prefix are added), so no link is lost.
        """
        spark = self.spark
        candidates = written(pairs.distinct(), spark)
        if candidates.isEmpty():
            self.scratch.append(candidates)
            return candidates.select("x", "y", F.lit(0.0).alias("d"), F.lit(False).alias("linked"))
        asked = _bitmap(spark, _ends(candidates), "x")
        heads = self._asked_heads(asked)
        ends = [heads.select(F.col("x").alias(c), F.col("n").alias(f"n_{c}"), F.col("marks").alias(f"marks_{c}")) for c in "xy"]
        marked = candidates.join(ends[0], "x").join(ends[1], "y")
        doubles = F.size("marks_x") - F.size(F.array_distinct("marks_x"))
        shared = F.size(F.array_intersect("marks_x", "marks_y")) + doubles
        most = shared + F.ceil(self.percent * F.greatest("n_x", "n_y") / 100 - 1e-9) - 1
        need = F.ceil(self.percent * (F.col("n_x") + F.col("n_y")) / (100 + self.percent) - 1e-9)
        pairs = written(marked.filter(most >= need).select("x", "y"), spark)
        asked.destroy()
        discard(candidates)
        asked = _bitmap(spark, _ends(pairs), "x")
        keys = _bitmap(spark, self._asked_heads(asked), "key")
        sets = self.texts.mapInArrow(_wanted_sets(asked, keys, self.width), "x bigint, grams array<bigint>")
        # Copies in several tasks give a set several times; one row of each is chosen by its number, not by moving the sets.
        sets = written(sets.withColumn("row", F.monotonically_increasing_id()), spark)
        asked.destroy()
        keys.destroy()
        chosen = sets.groupBy("x").agg(F.min("row").alias("row"))
        rows = [chosen.select(F.col("x").alias(c), F.col("row").alias(f"row_{c}")) for c in "xy"]
        grams = [sets.select(F.col("row").alias(f"row_{c}"), F.col("grams").alias(f"g{c}")) for c in "xy"]
        both = pairs.join(rows[0], "x").join(rows[1], "y").join(grams[0], "row_x").join(grams[1], "row_y")
        common = F.size(F.array_intersect("gx", "gy"))
        out = self.kept(both.select("x", "y", common.alias("common"), (F.size("gx") + F.size("gy") - common).alias("all"))
                        .select("x", "y", (1 - F.col("common") / F.col("all")).alias("d"), (100 * F.col("common") >= self.percent * F.col("all")).alias("linked")))
        discard(pairs, sets)
        return out

    def _asked_heads(self, asked) -> DataFrame:
        """Heads of the points in the bit map, and a few others; what is not asked for stays out of the shuffles."""
        return self.heads.mapInArrow(_heads_in(asked), self.heads.schema)

    def divide(self, members: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
        """One level: links to each region's pivot, and the members of the next regions; both are written, what led to them is removed.

        A member's ``level`` is the last one at which it linked to its region's pivot, 0 while it is outside.  Regions of
        the result have members outside (``open``) or members of several levels.
        """
        centre = F.min(F.struct("rare", F.col("x").alias("p"), F.col("n").alias("p_n"), F.col("place").alias("p_place"), F.col("d").alias("p_d")))
        pivots = members.filter("level = 0").groupBy("t").agg(centre.alias("c")).select("t", "c.p", "c.p_n", "c.p_place", "c.p_d")
        near = F.coalesce(F.abs(F.col("d") - F.col("p_d")) <= self.radius, F.lit(True))
        around = members.join(pivots, "t").withColumn("compare", (F.col("x") != F.col("p")) & near & _can_link(F.col("n"), F.col("p_n"), F.col("place"), F.col("p_place"), self.percent))
        around = written(around, self.spark)
        found = self.distances(around.filter("compare").select("x", F.col("p").alias("y")))
        # Only members that were to be compared need to look for their distance.
        columns = ["t", "x", "p", "n", "rare", "place", "level"]
        met = around.filter("compare").select(*columns).join(found.select("x", F.col("y").alias("p"), "d", "linked"), ["x", "p"], "left")
        met = met.withColumn("level", F.when(F.col("linked"), F.lit(level)).otherwise(F.col("level"))).select(*columns, "d")
        known = met.unionByName(around.filter("not compare").select(*columns, F.lit(None).cast("double").alias("d")))
        # The pivot has met, or can't link with, every member: it leaves its region, and with it most regions of two.
        known = written(known.filter("x <> p").select("t", "x", "n", "rare", "place", "d", "level"), self.spark)
        # Points of this pivot nearer to it than the nearest of the others less the radius can't reach any of them.
        nearest = F.min(F.when(F.col("level") != level, F.coalesce("d", F.lit(0.0))))
        reach = known.groupBy("t").agg((nearest - self.radius).alias("reach"), F.count("*").alias("m"), F.min("level").alias("low"), F.max("level").alias("high"))
        reach = reach.filter("m > 1 and (low = 0 or low < high)").select("t", "reach", "m", (F.col("low") == 0).alias("open"))
        discard(around)
        rest = self.kept(known.join(reach, "t").filter((F.col("level") != level) | F.col("d").isNull() | (F.col("d") >= F.col("reach"))).drop("reach"))
        discard(known)
        return found.filter("linked").select(F.col("x").alias("a"), F.col("y").alias("b")), rest

    def leaves(self, members: DataFrame, links: DataFrame) -> DataFrame:
        """Links between members of a region that are in no common component yet."""
        groups = components(self.spark, links)
        labelled = members.join(groups.withColumnRenamed("node", "x"), "x", "left").withColumn("group", F.coalesce("least", "x")).drop("least")
        labelled = self.kept(labelled)
        discard(groups)
        # Of two members of different groups at least one is not in the region's main group, that of a pivot if it had any links.
        main = F.coalesce(F.max(F.when(F.col("level") > 0, F.col("group"))), F.min("group")).alias("main")
        mixed = labelled.groupBy("t").agg(main, F.min("group").alias("g1"), F.max("group").alias("g2")).filter("g1 <> g2").select("t", "main")
        labelled = labelled.join(mixed, "t")
        a, b = labelled.filter("group <> main").alias("a"), labelled.alias("b")
        triangle = F.coalesce(F.abs(F.col("a.d") - F.col("b.d")) <= self.radius, F.lit(True))
        pairs = a.join(b, (F.col("a.t") == F.col("b.t")) & (F.col("a.group") != F.col("b.group")) & ((F.col("b.group") == F.col("b.main")) | (F.col("a.x") < F.col("b.x"))) & triangle
                       & _can_link(F.col("a.n"), F.col("b.n"), F.col("a.place"), F.col("b.place"), self.percent))
        found = self.distances(pairs.select(F.col("a.x").alias("x"), F.col("b.x").alias("y")))
        return found.filter("linked").select(F.col("x").alias("a"), F.col("y").alias("b"))


def _classes(spark: SparkSession, docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, rounds: int, hot: int) -> DataFrame:
    """One row per row of ``docs``: id, key (hash of the text), n and component."""
    texts = docs.select(F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    repeated = texts.select("text").mapInArrow(_repeated(width), "t bigint, n bigint").groupBy("t").agg(F.sum("n").alias("n"))
    repeated = written(repeated, spark)
    top = most_frequent(repeated, "n", hot).toArrow()
    discard(repeated)
    shingles, counts = top["t"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.argsort(shingles)
    table = spark.sparkContext.broadcast((shingles[order].tobytes(), counts[order].tobytes()))
    kind = docs.schema[id_col].dataType.simpleString()
    points = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text")).mapInArrow(_points(table, width, percent), f"id {kind}, key bigint, x bigint, n bigint, rare int, prefix array<bigint>, marks array<smallint>")
    points = written(points, spark)
    table.destroy()
    several = points.select(F.explode("prefix").alias("t")).groupBy("t").agg(F.count("*").alias("m")).filter("m > 1")
    shared = _bitmap(spark, several, "t")
    members = points.filter(F.size("prefix") > 0).select("x", "n", "rare", "prefix").mapInArrow(_shared_members(shared), "t bigint, x bigint, n bigint, rare int, place int")
    members = first_members = written(members.withColumns({"d": F.lit(None).cast("double"), "level": F.lit(0)}), spark)
    shared.destroy()
    work, links = _Join(spark, texts, points, width, percent), None
    prefixed, points = points, written(points.select("id", "key", "x", "n"), spark)
    discard(prefixed)
    left = None
    for depth in range(max(rounds, 1)):
        if depth and members.isEmpty():
            break
        found, rest = work.divide(members, depth + 1)
        if not depth:
            discard(first_members)
        links = found if links is None else links.unionAll(found)
        # Pivots come from outside: a region without is not divided again.
        small = rest.filter((F.col("m") <= LEAF) | ~F.col("open")).drop("m", "open")
        left = small if left is None else left.unionByName(small)
        members = rest.filter((F.col("m") > LEAF) & F.col("open")).drop("m", "open")
    links = links.unionAll(work.leaves(left.unionByName(members), links))
    groups = components(spark, links)
    work.close()
    same = points.filter("n > 0").groupBy("x").agg(F.min("id").alias("first"))
    joined = same.join(groups.withColumnRenamed("node", "x"), "x", "left").withColumn("g", F.coalesce("least", "x"))
    # Only sets with links need the least id of their component from elsewhere.
    least = joined.filter("least is not null").groupBy("least").agg(F.min("first").alias("component"))
    ids = joined.join(least, "least", "left").select("x", F.coalesce("component", "first").alias("component"))
    return (points.select("id", "key", "x", "n").join(ids, "x", "left")
            .select("id", "key", "n", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component")))


def join(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT,
         rounds: int = ROUNDS, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles (long) and component_id."""
    return (_classes(spark, docs, id_col, text_col, width, percent, rounds, hot)
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")))


def unique(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT,
           rounds: int = ROUNDS, hot: int = HOT) -> DataFrame:
    """``docs`` with one row of each component left: that of the least id, and one of its rows if they repeat.

    Texts without shingles all stay (a repeated row still goes).  All columns pass through.
    """
    columns = docs.columns
    docs, _, at = plain(docs)
    id_col, text_col = at[id_col], at[text_col]
    classes = _classes(spark, docs, id_col, text_col, width, percent, rounds, hot)
    first = classes.filter(F.col("id").eqNullSafe(F.col("component"))).select(F.col("id").alias("jc_id"), F.col("key").alias("jc_key")).distinct()
    kept = docs.join(first, F.col(id_col).eqNullSafe(F.col("jc_id")) & (F.xxhash64(text_col) == F.col("jc_key")), "left_semi")
    return kept.dropDuplicates([id_col, text_col]).toDF(*columns)


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')] ELSE [array_to_string(w[i:i + {k} - 1], ' ') FOR i IN generate_series(1, len(w) - {k} + 1)] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {j} * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS reached FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reached) AS component_id FROM d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id""".replace("{k}", str(WIDTH)).replace("{j}", str(PERCENT))
