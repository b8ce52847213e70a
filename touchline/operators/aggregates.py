"""Aggregates with defined order, ties and types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.numeric import exact_sum, share


def count_where(predicate: Column) -> Column:
    return F.count_if(predicate)


def share_where(predicate: Column, scale: int = 1) -> Column:
    """Percentage of the group's rows that satisfy ``predicate``."""
    return share(F.count_if(predicate), F.count(F.lit(1)), scale)


def mean(x: str | Column, scale: int = 2) -> Column:
    """Rounded average of an integer measure, from exact sums."""
    from touchline.functions.numeric import ratio

    c = F.col(x) if isinstance(x, str) else x
    return ratio(F.sum(c), F.count(c), scale, num_scale=0, den_scale=0)


def ordered_text(value: str, order: str) -> Column:
    """Concatenate ``value`` in ``order``.  Only for groups of bounded size (last-n)."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(value))))
    return F.array_join(F.transform(pairs, lambda p: p[value]), "")


def latest_value(value: str, *order: str) -> Column:
    """``value`` at the largest ``order`` tuple; ties go to the largest value."""
    return F.max(F.struct(*[F.col(o) for o in order], F.col(value).alias("__v")))["__v"]


def count_by(df: DataFrame, *keys: str, name: str = "rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "rows") -> DataFrame:
    return count_by(df, *keys, name=name).filter(F.col(name) > 1)


def most_frequent(df: DataFrame, keys: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    """Most frequent ``value`` per key; ties go to the smallest.  Two aggregations on
    counts, so neither a hot key nor many distinct values are gathered."""
    name = name or value
    n = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    best = F.min(F.struct((-F.col("__n")).alias("n"), F.col(value).alias("v")))["v"]
    return n.groupBy(*keys).agg(best.alias(name))


def career_summary(players: DataFrame) -> DataFrame:
    """One row per player over all seasons and competitions."""
    totals = ["matches_played", "minutes", "goals", "assists", "goal_contributions", "yellow_cards", "red_cards"]
    short = {"matches_played": "matches"}
    out = players.groupBy("player_name").agg(
        F.max("nationality").alias("nationality"),
        F.max("birth_year").alias("birth_year"),
        latest_value("team_name", "season", "minutes").alias("current_team"),
        F.count_distinct("competition_name").alias("competitions_played"),
        *[F.sum(F.col(c).cast("long")).alias(f"total_{short.get(c, c)}") for c in totals],
        exact_sum("xg").alias("total_xg"),
        exact_sum("xa").alias("total_xa"),
    )
    position = most_frequent(players, ["player_name"], "position_category", "primary_position")
    return out.join(position, "player_name", "left")
