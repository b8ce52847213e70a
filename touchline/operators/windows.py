"""Ranking, lag and latest-row operators that survive a hot partition key.

A plain ``row_number() OVER (PARTITION BY k ORDER BY ...)`` sends every row of one
``k`` through one task.  :func:`ordered` sorts all rows by (k, order) instead, which
Spark does in evenly sized ranges, stores them with their place, and derives ranks,
group sizes and previous rows from the places by aggregation and equality joins.
There is one plan for every size; no task holds a group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import stored

_RN = "__rn"
_PLACE_BITS = 33  # monotonically_increasing_id(): the task's number above, the row's place below


def parse_order(order_by: Sequence[str]) -> list[tuple[str, bool]]:
    """``["goals desc", "id"]`` -> ``[("goals", True), ("id", False)]``."""
    out = []
    for spec in order_by:
        name, _, how = spec.partition(" ")
        out.append((name, how.strip().lower() == "desc"))
    return out


def order_columns(order_by: Sequence[str]) -> list[Column]:
    return [F.col(n).desc() if d else F.col(n).asc() for n, d in parse_order(order_by)]


def ordered(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[str],
    *,
    key: Sequence[str],
    row_number: str | None = None,
    lag: Mapping[str, str] | None = None,
    size: str | None = None,
) -> DataFrame:
    """Add row number (LONG), previous-row values and group size (LONG) under one ordering.

    ``key`` names the columns that tell rows apart; they end the order, so it is total.  ``lag`` maps new column
    name to source column.  ``df`` is evaluated once.
    """
    lag = dict(lag or {})
    names = [n for n, _ in parse_order(order_by)]
    order = [F.col(p).asc() for p in partition_by] + order_columns([*order_by, *(k for k in key if k not in names)])
    table = stored(df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()))
    task = F.shiftright("__at", _PLACE_BITS)
    # One row per task of the sort: its number of rows before and in all.
    tasks = table.groupBy(task.alias("__task")).agg(F.count(F.lit(1)).alias("__n"))
    run = Window.orderBy("__task")
    tasks = tasks.select("__task", (F.sum("__n").over(run) - F.col("__n")).alias("__before"), F.sum("__n").over(Window.partitionBy()).alias("__total"))
    at = table.withColumn("__task", task).join(tasks, "__task").withColumn("__g", F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)))
    if partition_by:
        at = group_value(at, partition_by, __start=F.min("__g"), __size=F.count(F.lit(1)))
    else:
        at = at.withColumns({"__start": F.lit(0).cast("long"), "__size": F.col("__total")})
    first = F.col("__g") == F.col("__start")
    new = {}
    if row_number:
        new[row_number] = F.col("__g") - F.col("__start") + 1
    if lag:
        before = at.select((F.col("__g") + 1).alias("__next"), *[F.col(s).alias(f"__last_{i}") for i, s in enumerate(lag.values())])
        at = at.join(before, F.col("__g") == F.col("__next"), "left")
        new |= {name: F.when(~first, F.col(f"__last_{i}")) for i, name in enumerate(lag)}
    if size:
        new[size] = F.col("__size")
    return at.withColumns(new).select(*[c for c in df.columns if c not in new], *new)


def ranks(df: DataFrame, key: Sequence[str], rankings: Mapping[str, tuple[Sequence[str], Sequence[str]]]) -> DataFrame:
    """Several rankings (name to partition columns and order) of one table; ``key`` breaks ties.

    The table is evaluated and stored once; each ranking sorts only the columns it needs, and the ranks are joined by the
    row's place in the stored table, so rows that share a key are each ranked for themselves.
    """
    base = stored(df.withColumn("__row", F.monotonically_increasing_id()))
    out = base
    for name, (partition_by, order_by) in rankings.items():
        needed = dict.fromkeys([*key, *partition_by, *(n for n, _ in parse_order(order_by)), "__row"])
        rank = ordered(base.select(*needed), partition_by, order_by, key=[*key, "__row"], row_number=name)
        rank = rank.select(F.col("__row").alias("__ranked"), name)
        out = out.join(rank, F.col("__row") == F.col("__ranked"), "left").drop("__ranked")
    return out.drop("__row")


def first_per_group(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of each group; other rows are dropped before the shuffle."""
    return first_n(df, keys, order_by, 1)


def first_n(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], n: int, *, rank: str | None = None) -> DataFrame:
    """First ``n`` rows per group.  The rank filter is pushed below the exchange
    (window group limit), so a hot group ships at most ``n`` rows per input task."""
    name = rank or _RN
    w = Window.partitionBy(*keys).orderBy(*order_columns(order_by))
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return out if rank else out.drop(name)


def last_n(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str], n: int = 5, *, rank: str = "recency") -> DataFrame:
    """Most recent ``n`` rows per group; ``latest_by`` lists columns, newest first."""
    return first_n(df, keys, [f"{c} desc" for c in latest_by], n, rank=rank)


def dedup_latest(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """One row per key: the latest by ``latest_by``."""
    return first_per_group(df, keys, [f"{c} desc" for c in latest_by])


def group_value(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Attach group aggregates to every row: partial aggregation and a join, so a hot
    group is never gathered (the join side has one row per group)."""
    side = df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()])
    side = side.select(*[F.col(k).alias(f"__g_{k}") for k in keys], *aggs)
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__g_{k}")) for k in keys])
    return df.join(side, on, "left").drop(*[f"__g_{k}" for k in keys])
