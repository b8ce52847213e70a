"""Parameterised lookups and report queries over the gold marts.

Values are bound as literals, never spliced into SQL text.  Sorting happens here, at the
reader, and always ends with a key so that limits are repeatable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.text import record_text
from touchline.operators import quality
from touchline.operators.aggregates import count_by, mean
from touchline.operators.filters import top
from touchline.operators.windows import first_n

c = F.col


def _only(df: DataFrame, col: str, value: str | None) -> DataFrame:
    return df.filter(c(col) == F.lit(value)) if value else df


def get_matches(results: DataFrame, competition: str | None = None, limit: int = 10) -> DataFrame:
    """Latest finished matches, optionally of one competition code."""
    rows = _only(results, "competition_code", competition).select(
        "match_id", "match_date", "competition_name", "home_team_name", "away_team_name", "home_goals", "away_goals")
    return top(rows, [c("match_date").desc(), c("match_id").desc()], limit)


def get_standings(standings: DataFrame, competition: str | None = None) -> DataFrame:
    rows = _only(standings, "competition_name", competition).select(
        "competition_name", "team_name", "position", "played", "won", "drawn", "lost", "points", "goals_for", "goals_against", "goal_difference")
    return rows.orderBy("position", "competition_name")


def get_head_to_head(h2h: DataFrame, team1: str, team2: str) -> DataFrame:
    """Records of all pairs whose names hold the given texts, in either order."""
    def holds(col: str, part: str) -> Column:
        return F.contains(c(col), F.lit(part))

    return h2h.filter((holds("team_a", team1) & holds("team_b", team2)) | (holds("team_a", team2) & holds("team_b", team1)))


def get_data_quality(rules: DataFrame, status: str | None = None, limit: int = 50) -> DataFrame:
    """Newest rule results; ``status`` is PASS, FAIL or ERROR."""
    full = {"PASS": quality.PASS, "FAIL": quality.FAIL, "ERROR": quality.ERROR}
    rows = _only(rules, "status", full[status] if status else None)
    return top(rows, [c("timestamp").desc(), c("test_name")], limit)


def competition_overview(results: DataFrame) -> DataFrame:
    r = c("match_result")
    return results.groupBy("competition_name").agg(
        F.count(F.lit(1)).alias("matches"), mean("total_goals").alias("avg_goals"), F.count_if(r == "HOME").alias("home_wins"),
        F.count_if(r == "DRAW").alias("draws"), F.count_if(r == "AWAY").alias("away_wins"))


def leaders(standings: DataFrame, n: int = 5) -> DataFrame:
    """Top ``n`` of every competition."""
    return first_n(standings, ["competition_name"], ["position"], n).select("competition_name", "team_name", "position", "points")


def rows_per_competition(df: DataFrame, distinct: str | None = None) -> DataFrame:
    out = count_by(df, "competition_name") if distinct is None else df.groupBy("competition_name").agg(F.count_distinct(distinct).alias("rows"))
    return out.orderBy(c("rows").desc(), "competition_name")


def over_performers(players: DataFrame, min_minutes: int = 450, limit: int = 20) -> DataFrame:
    rows = players.filter(c("minutes") >= min_minutes).select("player_season_key", "player_name", "team_name", "goals", "xg", "goals_minus_xg")
    return top(rows, [c("goals_minus_xg").desc(), c("player_season_key")], limit)


def most_goals(players: DataFrame, limit: int = 20) -> DataFrame:
    rows = players.select("player_season_key", "player_name", "team_name", "competition_name", "goals", "assists", "xg")
    return top(rows, [c("goals").desc(), c("assists").desc(), c("player_season_key")], limit)


def latest_with_xg(matches: DataFrame, limit: int = 20) -> DataFrame:
    rows = matches.filter(c("home_xg").isNotNull()).select(
        "match_id", "competition_name", "match_date", "home_team_name", "away_team_name", "home_goals", "away_goals", "home_xg", "away_xg")
    return top(rows, [c("match_date").desc(), c("match_id"), c("home_xg"), c("away_xg")], limit)  # one match may have two partners


def table_top(standings: DataFrame, n: int = 5) -> DataFrame:
    rows = standings.filter(c("position") <= n)
    return rows.select("competition_name", "season", "team_name", "position", "points", "xg", "xga").orderBy("competition_name", "season", "position")


def form_table(form: DataFrame, competition: str, limit: int | None = None) -> DataFrame:
    goals = record_text("form_goals_scored", "form_goals_conceded").alias("goals")
    rows = _only(form, "competition_name", competition).select("team_name", "form_string", "form_points", "form_ppg", goals, "form_rating")
    order = [c("form_points").desc(), c("team_name")]
    return rows.orderBy(*order) if limit is None else top(rows, order, limit)


def best_head_to_head(h2h: DataFrame, min_matches: int = 2, limit: int = 20) -> DataFrame:
    rows = h2h.filter(c("total_matches") >= min_matches).select(
        "perspective_team", "opponent_team", "competition_name", "total_matches", "wins", "win_percentage", "h2h_dominance")
    return top(rows, [c("win_percentage").desc(), c("total_matches").desc(), c("perspective_team"), c("opponent_team"), c("competition_name")], limit)


def pair_record(h2h: DataFrame, team: str, opponent: str) -> DataFrame:
    """Both sides of one pair with record texts."""
    pair = F.array(F.lit(team), F.lit(opponent))
    rows = h2h.filter((c("team_a") == F.array_min(pair)) & (c("team_b") == F.array_max(pair)))
    return rows.select("perspective_team", "opponent_team", "competition_name", "total_matches", record_text("wins", "draws", "losses").alias("record"),
                       record_text("goals_scored", "goals_conceded").alias("goals"), "points", "h2h_dominance")


def team_table(standings: DataFrame, competition: str) -> DataFrame:
    rows = _only(standings, "competition_name", competition)
    return rows.select(c("team_name"), "position", "points", record_text("won", "drawn", "lost").alias("record"),
                       record_text("goals_for", "goals_against").alias("goals"), "zone").orderBy("position")


def hot_streaks(player_form: DataFrame) -> DataFrame:
    return player_form.filter("is_on_hot_streak").select("player_name", "team_name", "recent_goals", "current_form")


def position_track(history: DataFrame, team: str) -> DataFrame:
    return _only(history, "team_name", team).select("team_name", "competition_name", "snapshot_date", "position", "position_movement").orderBy(
        "snapshot_date", "competition_name")
