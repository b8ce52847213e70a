"""Match rows seen from both teams, and statistics unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.labels import letter, points


def two_sided(
    matches: DataFrame,
    *,
    carry: Sequence[str] = ("match_date", "competition_name"),
    pairs: Mapping[str, tuple[str, str]] | None = None,
    names: tuple[str, str, str] = ("W", "D", "L"),
) -> DataFrame:
    """Two rows per match, one per team, from a single read of the input.

    ``pairs`` maps an output column to its (home, away) source columns; the home row
    takes them as given and the away row takes them swapped.
    """
    pairs = pairs or {
        "team_name": ("home_team_name", "away_team_name"),
        "opponent": ("away_team_name", "home_team_name"),
        "goals_scored": ("home_goals", "away_goals"),
        "goals_conceded": ("away_goals", "home_goals"),
    }

    def view(i: int, side: str) -> Column:
        return F.struct(
            *[F.col(cols[i]).alias(out) for out, cols in pairs.items()],
            letter("match_result", side, names).alias("result"),
            points("match_result", side).alias("points"),
            F.lit(side).alias("venue"),
        )

    both = F.explode(F.array(view(0, "HOME"), view(1, "AWAY"))).alias("s")
    return matches.select(*carry, both).select(*carry, "s.*")


def stack_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def history_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Total, current and historical rows per table."""
    return stack_all([
        df.agg(
            F.count(F.lit(1)).alias("total_records"),
            F.count_if(F.col("is_current")).alias("current_records"),
            F.count_if(~F.col("is_current")).alias("historical_records"),
        ).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ])
