"""Joins.  No side is broadcast by hint: Spark's size threshold and AQE decide, so a
dimension that outgrows memory falls back to a sort-merge join with skew splitting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.windows import dedup_latest, ordered
from touchline.session import stored

PREFIX = 5


def join_role(fact: DataFrame, dim: DataFrame, on: tuple[str, str], take: Mapping[str, str]) -> DataFrame:
    """Left join one role of a dimension: ``on`` is (fact column, dim column), ``take``
    maps new column names to dimension columns."""
    side = dim.select(F.col(on[1]).alias("__role"), *[F.col(c).alias(n) for n, c in take.items()])
    return fact.join(side, F.col(on[0]) == F.col("__role"), "left").drop("__role")


def left_on(left: DataFrame, right: DataFrame, keys: Sequence[str], take: Sequence[str]) -> DataFrame:
    return left.join(right.select(*keys, *take), list(keys), "left")


def full_outer(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join with coalesced keys; sides must not share other column names."""
    return left.join(right, list(keys), "full_outer")


def keep_keys(rows: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.join(keys_df.select(*keys), list(keys), "left_semi")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose (non-NULL or NULL) key has no parent."""
    p = parent.select(F.col(parent_key).alias("__parent"))
    return child.join(p, F.col(child_key) == F.col("__parent"), "left_anti")


def orphan_keys(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Orphans counted per key: the child is pre-aggregated, so a hot key is one row."""
    return orphans(child.groupBy(child_key).agg(F.count(F.lit(1)).alias("rows")), parent, child_key, parent_key)


def missing_either(child: DataFrame, parent: DataFrame, child_keys: Sequence[str], parent_key: str) -> DataFrame:
    """Child rows that lack a parent under at least one of their keys."""
    ids = parent.select(parent_key).distinct()
    out = child
    for i, key in enumerate(child_keys):
        side = ids.select(F.col(parent_key).alias(f"__p{i}"))
        out = out.join(side, F.col(key) == F.col(f"__p{i}"), "left")
    missing = reduce(lambda a, b: a | b, [F.col(f"__p{i}").isNull() for i in range(len(child_keys))])
    return out.filter(missing).select(*child.columns)


def new_or_changed(batch: DataFrame, history: DataFrame, keys: Sequence[str], hash_col: str = "record_hash") -> DataFrame:
    """Batch rows whose key is unknown, or whose hash differs from the current version."""
    now = history.filter("is_current").select(*keys, F.col(hash_col).alias("__old"), F.lit(True).alias("__known"))
    return (batch.join(now, list(keys), "left")
            .filter(F.col("__known").isNull() | (F.col(hash_col) != F.col("__old")))
            .select(*batch.columns))


def previous_version(history: DataFrame, key: str, take: Mapping[str, str], keep: Sequence[str] | None = None) -> DataFrame:
    """Current versions with columns of the latest closed version of the same key; of their own, those of ``keep`` (all, if not given).

    One read and one aggregation of the history: each task keeps one closed version of a key, and only the columns taken
    from it, before anything is shuffled.  Several current rows of a key all get the same closed version; rows with a
    NULL key have none.
    """
    columns = [*(history.columns if keep is None else keep)]
    here = F.col(key).isNotNull()
    # A row without a key is a group of its own.
    alone = F.when(~here, F.monotonically_increasing_id()).alias("__alone")
    closed = F.struct(*[F.col(c).alias(f"__p{i}") for i, c in enumerate(take.values())])
    known = history.groupBy(key, alone).agg(
        F.collect_list(F.when(F.col("is_current"), F.struct(*[n for n in columns if n != key]))).alias("__now"),
        F.max_by(closed, F.when(here & ~F.col("is_current"), F.struct("valid_from", "record_hash"))).alias("__prev"))
    return known.select(key, "__prev", F.inline("__now")).select(*columns, *[F.col(f"__prev.__p{i}").alias(n) for i, n in enumerate(take)])


def enrich(base: DataFrame, tables: Mapping[str, DataFrame], keys: Sequence[str], columns: Mapping[str, Sequence[str]], latest_by: str) -> DataFrame:
    """Left join several lookup tables on the same keys; the last duplicate wins."""
    for name, table in tables.items():
        side = dedup_latest(table.select(*keys, *columns[name], latest_by), keys, [latest_by])
        base = base.join(side.drop(latest_by), list(keys), "left")
    return base


def _name_pairs(left: DataFrame, right: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Names of both sides (columns scope, ``__ln`` and ``__rn``) of which one holds the first characters of the other.

    Works on distinct names: a name's substrings are met with the other side's heads by equality, once in each
    direction, and only substrings as long as some head are made (five characters, unless a name is shorter).  The head
    of an empty name is empty and stands in every name, so empty names meet their whole scope.
    """
    def heads(df: DataFrame, n: str) -> DataFrame:
        return df.filter(F.col(n) != "").withColumn("__part", F.lower(F.substring(n, 1, PREFIX)))

    def lengths(df: DataFrame, n: str) -> list[int]:
        """Of heads: at most PREFIX + 1 rows."""
        return sorted(r[0] for r in df.select(F.length(F.substring(n, 1, PREFIX))).distinct().collect())

    def parts(df: DataFrame, n: str, sizes: Sequence[int]) -> DataFrame:
        low = F.lower(n)

        def grams(k: int) -> Column:
            own = F.transform(F.sequence(F.lit(1), F.length(low) - k + 1), lambda i: F.substring(low, i, k))
            return F.when(F.length(low) >= k, own).otherwise(F.array().cast("array<string>"))

        return df.withColumn("__part", F.explode(F.array_distinct(F.concat(*map(grams, sizes)))))

    l, r = (stored(df.select(*scope, n).distinct()) for df, n in ((left, "__ln"), (right, "__rn")))
    on, out, found = [*scope, "__part"], [*scope, "__ln", "__rn"], []
    sizes = {"__ln": lengths(l, "__ln"), "__rn": lengths(r, "__rn")}
    for (a, n), (b, m) in (((l, "__ln"), (r, "__rn")), ((r, "__rn"), (l, "__ln"))):
        some = [k for k in sizes[m] if k]
        if some:
            found.append(parts(a, n, some).join(heads(b, m), on))
        if 0 in sizes[m]:
            found.append(b.filter(F.col(m) == "").join(a, list(scope)))
    none = l.limit(0).withColumn("__rn", F.lit(""))
    return reduce(DataFrame.unionByName, [f.select(*out) for f in found] or [none]).distinct()


def _fitting(left: DataFrame, right: DataFrame, equal: Sequence[str], name: str) -> tuple[DataFrame, DataFrame, DataFrame, list[str]]:
    """Both sides as keys, name and row struct; the stored pairs of names that fit under equal keys, with the rows that have
    either name (``__lrows``, ``__rrows``); the keys' names."""
    keys = [f"__k{i}" for i in range(len(equal))]

    def side(df: DataFrame, s: str) -> DataFrame:
        return df.select(*[F.col(x).alias(k) for x, k in zip(equal, keys)], F.col(name).alias(f"__{s}n"), F.struct("*").alias(s))

    def names(df: DataFrame, s: str) -> DataFrame:
        on = [*keys, f"__{s}n"]
        return stored(df.select(*on).dropna().groupBy(*on).agg(F.count(F.lit(1)).alias(f"__{s}rows")))

    l, r = side(left, "l"), side(right, "r")
    l_keys, r_keys = names(l, "l"), names(r, "r")
    pairs = _name_pairs(l_keys, r_keys, keys[:1])
    fits = l_keys.join(pairs, [keys[0], "__ln"]).join(r_keys, [*keys, "__rn"])
    return l, r, stored(fits.select(*keys, "__ln", "__rn", "__lrows", "__rrows")), keys


CELL_PAIRS, CELL_SIDE, TASK_PAIRS = 1 << 22, 1 << 11, 1 << 23
"""A name with more pairs of rows than the first is spread over cells of about the second, squared; a task gets about the third."""


def _spread(l: DataFrame, r: DataFrame, on: Sequence[str], pairs: float) -> DataFrame:
    """All pairs of rows with equal ``on``, where both sides name the pieces (``__lcut``, ``__rcut``) each is cut into.

    A left row goes to one of the ``__lcut`` pieces and meets every right piece, and the other way round, so each pair meets
    in one cell.  Rows are stored with their piece: a task that runs again deals them as before.  They are dealt out before
    they are copied for the other side's pieces: the few files of a small side would be few tasks for many copies.
    """
    tasks = int(l.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        rows = stored(df.withColumn(own, F.floor(F.rand(7) * F.col(own)))).repartition(tasks)
        return rows.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)))

    cell = [*on, "__lcut", "__rcut"]
    # A number that is asked for is kept: cells are few bytes and many pairs, and would be put together again.
    n = int(max(pairs / TASK_PAIRS, tasks))
    return dealt(l, "__lcut", "__rcut").repartition(n, *cell).join(dealt(r, "__rcut", "__lcut").repartition(n, *cell).hint("merge"), cell)


def prefix_match(left: DataFrame, right: DataFrame, equal: Sequence[str], name: str, *, counts: bool = False) -> DataFrame:
    """Full outer join on ``equal`` columns plus "one name holds the other's first characters".

    Output: structs ``l`` and ``r`` (NULL where unmatched).  Names are matched, not rows: the pairs of names that fit
    are found per value of the first equal column, brought to the distinct (equal columns, name) of both sides, and
    rows are then joined to them by equality.  Row ids play no part, so they may repeat or be NULL.  A row with a NULL
    name or a NULL among the equal columns has no partner and stays out of the matching.

    A name of the right that very many pairs of rows share (:data:`CELL_PAIRS`) is cut into cells of rows that any task can
    take, so neither memory nor time of a task grows with it.

    With ``counts``, the left rows once each, as ``l``, and in ``partners`` with how many right rows each would pair: from
    the counts of the names, so that the pairs aren't made.

    The distinct keys of both sides and the pairs of names are stored while the plan is made, and the rows of names that
    are cut; each side is read twice.
    """
    l, r, fits, keys = _fitting(left, right, equal, name)
    if counts:
        found = fits.groupBy(*keys, "__ln").agg(F.sum("__rrows").alias("partners"))
        return l.join(found, [*keys, "__ln"], "left").select("l", F.coalesce("partners", F.lit(0)).alias("partners"))
    shared = fits.groupBy(*keys, "__rn").agg(F.sum("__lrows").alias("__lrows"), F.max("__rrows").alias("__rrows"))
    product = F.col("__lrows").cast("double") * F.col("__rrows")
    hot = stored(shared.filter(product > CELL_PAIRS).select(
        *keys, "__rn", product.alias("__pairs"), *[F.ceil(F.col(f"__{s}rows") / CELL_SIDE).alias(f"__{s}cut") for s in "lr"]))
    pairs = hot.agg(F.sum("__pairs")).first()[0]
    fits, on = fits.select(*keys, "__ln", "__rn"), [*keys, "__rn"]
    if pairs is None:
        return l.join(fits, [*keys, "__ln"], "left").join(r, on, "full_outer").select("l", "r")
    fits = fits.join(hot.drop("__pairs"), on, "left")
    l = l.join(fits, [*keys, "__ln"], "left").drop("__ln")
    r = r.join(hot.drop("__pairs"), on, "left")
    (l_rest, l_hot), (r_rest, r_hot) = ((df.filter(F.col("__lcut").isNull()).drop("__lcut", "__rcut"), df.filter(F.col("__lcut").isNotNull())) for df in (l, r))
    rest = l_rest.join(r_rest, on, "full_outer").select("l", "r")
    return rest.unionByName(_spread(l_hot, r_hot, on, pairs).select("l", "r"))


def name_score(a: str | Column, b: str | Column) -> Column:
    """How alike two names are, 0 to 1000: twice their common pairs of neighbouring characters to all they have, rounded down."""
    def grams(n) -> Column:
        low = F.lower(F.col(n) if isinstance(n, str) else n)
        return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(low) - 1, F.lit(1))), lambda i: F.substring(low, i, 2)))

    x, y = grams(a), grams(b)
    return F.floor(2000 * F.size(F.array_intersect(x, y)) / (F.size(x) + F.size(y))).cast("int")


def _assigned(fits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One partner per name: in every round the pairs that are best for both of their names (score, then names), until none is left.

    Names with one candidate that has no other are settled in the first round.  A round is two aggregations and two
    joins of the pairs still open, stored; the best open pair of a key is always settled, so the rounds end.
    """
    left = fits.withColumn("__order", F.struct((-name_score("__ln", "__rn")).alias("s"), F.col("__ln").alias("l"), F.col("__rn").alias("r")))
    left, done = stored(left), []
    while True:
        best_l = left.groupBy(*keys, "__ln").agg(F.min("__order").alias("__order"))
        best_r = left.groupBy(*keys, "__rn").agg(F.min("__order").alias("__order"))
        both = stored(best_l.join(best_r, [*keys, "__order"]).select(*keys, "__ln", "__rn"))
        done.append(both)
        left = stored(left.join(both.select(*keys, "__ln"), [*keys, "__ln"], "left_anti").join(both.select(*keys, "__rn"), [*keys, "__rn"], "left_anti").select(*left.columns))
        if left.isEmpty():
            return reduce(DataFrame.unionByName, done)


def best_match(left: DataFrame, right: DataFrame, equal: Sequence[str], name: str, order: tuple[Sequence[str], Sequence[str]]) -> DataFrame:
    """Like :func:`prefix_match`, but every row has one partner at most.

    Names are paired first, each with one other, the most alike first.  Rows that share keys and name are then paired in
    the order of the given columns of each side (two home games of a team on a day: first with first, second with
    second); surplus rows stay without a partner.  The order should be total; rows that tie in it may pair either way.
    """
    l, r, fits, keys = _fitting(left, right, equal, name)
    pairs = _assigned(fits.select(*keys, "__ln", "__rn"), keys)

    def placed(df: DataFrame, s: str, by: Sequence[str]) -> DataFrame:
        rows = df.withColumn("__o", F.struct(*[F.col(s)[x].alias(f"o{i}") for i, x in enumerate(by)]))
        return ordered(rows, [*keys, f"__{s}n"], ["__o"], key=["__o"], row_number="__place").drop("__o")

    a = placed(l, "l", order[0]).join(pairs, [*keys, "__ln"], "left")
    return a.join(placed(r, "r", order[1]), [*keys, "__rn", "__place"], "full_outer").select("l", "r")


def ambiguous_pairs(matched: DataFrame, ids: tuple[str, str]) -> DataFrame:
    """Left rows that found several partners, with the partner count; ``matched`` holds pairs or counts (:func:`prefix_match`)."""
    if "partners" in matched.columns:
        found, partners = matched.filter("partners > 0"), F.sum("partners")
    else:
        found, partners = matched.filter(F.col("l").isNotNull() & F.col("r").isNotNull()), F.count(F.lit(1))
    return found.groupBy(F.col("l")[ids[0]].alias(ids[0])).agg(partners.alias("partners")).filter("partners > 1")
