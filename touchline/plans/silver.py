"""Bronze to silver: typed, cleaned rows.  History columns are added by the loader."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import constants as K
from touchline.functions.labels import code_map, flag, ladder, position_category, result_from_score
from touchline.functions.numeric import age_in, minus, nineties, ratio, rounded, share, zero
from touchline.functions.text import clean, clean_upper, digits_to_int, nonblank, surrogate_key
from touchline.operators.changes import TableConfig, upsert_type1


def _as_is(*names: str) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def _trimmed(*names: str) -> dict[str, Column]:
    return {n: clean(n) for n in names}


def _out(df: DataFrame, *specs: dict[str, Column]) -> DataFrame:
    merged: dict[str, Column] = {}
    for s in specs:
        merged |= s
    return df.select(*[c.alias(n) for n, c in merged.items()])


def matches(bronze: DataFrame) -> DataFrame:
    """Unplayed matches show 0-0, so pair scores with ``is_finished``."""
    when = F.col("utc_date").cast("timestamp")
    goals = {f"{s}_goals{out}": zero(f"{s}_score_{part}") for part, out in (("fulltime", ""), ("halftime", "_halftime")) for s in ("home", "away")}
    teams = {}
    for s in ("home", "away"):
        teams |= {f"{s}_team_id": F.col(f"{s}_team_id"), f"{s}_team_name": clean(f"{s}_team_name"),
                  f"{s}_team_short_name": clean_upper(f"{s}_team_short_name")}
    return _out(
        bronze.filter(F.col("match_id").isNotNull()),
        _as_is("match_id"),
        {"match_datetime": when, "match_date": F.to_date(when), "match_year": F.year(when), "match_month": F.month(when),
         "day_of_week": F.dayofweek(when), "match_status": clean_upper("status"), "matchday_number": F.col("matchday"),
         "stage": clean_upper("stage")},
        _as_is("competition_id"), _trimmed("competition_name"), {"competition_code": clean_upper("competition_code")},
        teams, goals,
        {"total_goals": zero("home_score_fulltime") + zero("away_score_fulltime"),
         "match_result": code_map("winner", K.WINNER_TO_RESULT),
         "is_finished": flag(F.col("status") == "FINISHED"), "is_draw": flag(F.col("winner") == "DRAW"),
         "source_updated_at": F.col("last_updated").cast("timestamp"), "ingested_at": F.col("ingest_timestamp").cast("timestamp")},
    )


def teams(bronze: DataFrame) -> DataFrame:
    return _out(
        bronze.filter(F.col("team_id").isNotNull()),
        _as_is("team_id"), _trimmed("team_name", "short_name"),
        {"team_code": clean_upper("tla"), "logo_url": F.col("crest_url")}, _trimmed("address", "website"),
        {"founded_year": F.col("founded")}, _trimmed("club_colors"), {"stadium_name": clean("venue")},
        _as_is("competition_id"), _trimmed("competition_name"), {"ingested_at": F.col("ingest_timestamp").cast("timestamp")},
    )


def xg_matches(bronze: DataFrame) -> DataFrame:
    home, away = F.col("home_score").try_cast("int"), F.col("away_score").try_cast("int")
    return _out(
        bronze.filter(nonblank("home_team_name") & nonblank("away_team_name")),
        {"match_key": surrogate_key("competition_name", "match_date", "home_team_name", "away_team_name"),
         "match_date_str": clean("match_date"), "match_date": F.col("match_date").try_cast("date")},
        _trimmed("match_time", "matchweek", "season", "competition_name"),
        {"competition_code": code_map("competition_name", K.COMPETITION_CODES)},
        _trimmed("home_team_name", "away_team_name"),
        {"home_goals": home, "away_goals": away, "home_xg": rounded("home_xg", 2), "away_xg": rounded("away_xg", 2),
         "total_xg": rounded(zero("home_xg") + zero("away_xg"), 2)},
        _trimmed("venue", "referee"),
        {"attendance_str": clean("attendance"), "attendance": digits_to_int("attendance"),
         "match_result": result_from_score(home, away),
         "home_xg_diff": minus(home, zero("home_xg")), "away_xg_diff": minus(away, zero("away_xg")),
         "is_finished": F.col("home_score").isNotNull() & F.col("away_score").isNotNull(),
         "data_source": F.lit("fbref"), "ingested_at": F.col("ingest_timestamp").cast("timestamp")},
    )


def xg_standings(bronze: DataFrame) -> DataFrame:
    played = F.col("matches_played")
    return _out(
        bronze.filter(nonblank("team_name") & F.col("position").isNotNull()),
        {"standing_key": surrogate_key("competition_name", "season", "team_name")},
        _trimmed("competition_name"), {"competition_code": code_map("competition_name", K.COMPETITION_CODES)},
        _trimmed("season"), _as_is("position"), _trimmed("team_name"),
        _as_is("matches_played", "wins", "draws", "losses", "goals_for", "goals_against", "goal_difference", "points"),
        {"xg": rounded("xg", 2), "xga": rounded("xga", 2), "xg_difference": minus(zero("xg"), zero("xga")),
         "points_per_game": ratio("points", played, 2), "goals_per_game": ratio("goals_for", played, 2),
         "goals_conceded_per_game": ratio("goals_against", played, 2),
         "goals_vs_xg": minus("goals_for", zero("xg")), "goals_conceded_vs_xga": minus("goals_against", zero("xga")),
         "win_percentage": share("wins", played),
         "data_source": F.lit("fbref"), "ingested_at": F.col("ingest_timestamp").cast("timestamp")},
    )


# fixed values: counters that default to 0 and figures that stay NULL, in output order
_COUNTS = {
    "time": ["matches_played", "starts", "minutes"],
    "goals": ["non_penalty_goals", "penalty_goals", "penalty_attempts", "yellow_cards", "red_cards"],
    "shots": ["shots", "shots_on_target"],
    "passes": ["passes_completed", "passes_attempted"],
    "progress": ["key_passes", "passes_into_final_third", "passes_into_penalty_area", "progressive_passes"],
    "defense": ["tackles", "tackles_won", "interceptions", "blocks", "clearances"],
}


def players(bronze: DataFrame, ref_year: int = K.REFERENCE_YEAR) -> DataFrame:
    def counts(group: str) -> dict[str, Column]:
        return {c: zero(c) for c in _COUNTS[group]}

    keys = ("player_name", "team_name", "competition_name", "season")
    return _out(
        bronze.filter(nonblank("player_name", "nan")),
        {"player_season_key": surrogate_key(*[clean(k) for k in keys])},
        _trimmed("player_name", "team_name", "nationality", "position"),
        {"position_category": position_category("position")}, _as_is("age", "birth_year"),
        {"calculated_age": age_in(ref_year, "birth_year")},
        _trimmed("competition_name"), {"competition_code": code_map("competition_name", K.COMPETITION_CODES)}, _trimmed("season"),
        counts("time"),
        {"nineties": nineties("nineties", "minutes"), "sub_appearances": zero("matches_played") - zero("starts"),
         "goals": zero("goals"), "assists": zero("assists"), "goal_contributions": zero("goals") + zero("assists")},
        counts("goals"),
        {c: rounded(zero(c), 2) for c in ("xg", "npxg", "xa")},
        {"xg_xa": rounded(zero("xg") + zero("xa"), 2),
         "goals_minus_xg": minus(zero("goals"), zero("xg")), "assists_minus_xa": minus(zero("assists"), zero("xa"))},
        {c: rounded(c, 2) for c in ("goals_per90", "assists_per90", "xg_per90", "xa_per90")},
        counts("shots"),
        {"shot_accuracy_pct": rounded("shot_accuracy", 1), "shots_per90": rounded("shots_per90", 2),
         "shot_conversion_pct": share(zero("goals"), "shots")},
        counts("passes"), {"pass_completion_pct": rounded("pass_completion_pct", 1)}, counts("progress"), counts("defense"),
        {"defensive_actions": zero("tackles") + zero("interceptions"),
         "sca": zero("sca"), "sca_per90": rounded("sca_per90", 2), "gca": zero("gca"), "gca_per90": rounded("gca_per90", 2),
         "data_source": F.lit("fbref"), "ingested_at": F.col("ingest_timestamp").cast("timestamp")},
    )


# --- variants for payload tables that carry a season and text dates -----------------
def payload_matches(bronze: DataFrame) -> DataFrame:
    """Keeps NULL scores; the result comes from the scores."""
    home, away = F.col("home_score").cast("int"), F.col("away_score").cast("int")
    return _out(
        bronze,
        _as_is("match_id", "competition_code", "competition_name", "season", "matchday"),
        {"match_datetime": F.to_timestamp("match_date"), "match_date": F.to_date("match_date"), "match_status": F.col("status")},
        _as_is("home_team_id", "home_team_name", "away_team_id", "away_team_name"),
        {"home_goals": home, "away_goals": away, "is_finished": flag(F.col("status") == "FINISHED"),
         "match_result": result_from_score(home, away), "goal_difference": home - away, "total_goals": home + away},
    )


def payload_teams(bronze: DataFrame) -> DataFrame:
    return _out(bronze, _as_is("team_id", "team_name", "short_name"), {"team_code": F.col("tla")},
                _as_is("venue", "founded", "club_colors", "address", "website", "competition_code", "competition_name"))


def payload_standings(bronze: DataFrame) -> DataFrame:
    zone = ladder([(F.col("position") <= n, t) for n, t in K.PAYLOAD_ZONES_TOP]
                  + [(F.col("position") >= n, t) for n, t in K.PAYLOAD_ZONES_BOTTOM], K.ZONE_MIDDLE)
    rename = {"matches_played": "played_games", "wins": "won", "draws": "draw", "losses": "lost"}
    return _out(
        bronze, _as_is("competition_code", "competition_name", "team_id", "team_name", "position"),
        {n: F.col(c) for n, c in rename.items()}, _as_is("points", "goals_for", "goals_against", "goal_difference"),
        {"points_per_game": ratio("points", "played_games", 2), "table_zone": zone},
    )


# --- how each table becomes history; hash columns name the transformed schema ------------
CONFIGS = {
    c.target: c for c in [
        TableConfig("stg_matches", matches, ("match_id",), ("match_status", "home_goals", "away_goals", "match_result"), ("ingested_at",)),
        TableConfig("stg_teams", teams, ("team_id",),
                    ("team_name", "short_name", "stadium_name", "club_colors", "competition_id"), ("ingested_at",)),
        TableConfig("stg_fbref_matches", xg_matches, ("match_key",),
                    ("home_goals", "away_goals", "home_xg", "away_xg", "attendance_str"), ("ingested_at",)),
        TableConfig("stg_fbref_standings", xg_standings, ("standing_key",),
                    ("position", "matches_played", "points", "wins", "goals_for", "goals_against"), ("ingested_at",)),
        TableConfig("stg_players", players, ("player_season_key",),
                    ("matches_played", "minutes", "goals", "assists", "xg", "xa", "yellow_cards", "red_cards", "team_name"), ("ingested_at",)),
    ]
}
PAYLOAD_CONFIGS = {
    c.target: c for c in [
        TableConfig("stg_matches", payload_matches, ("match_id",), ("match_status", "home_goals", "away_goals")),
        TableConfig("stg_teams", payload_teams, ("team_id", "competition_code"), ("team_name", "venue")),
        TableConfig("stg_standings", payload_standings, ("team_id", "competition_code"), ("position", "points", "goals_for", "goals_against")),
    ]
}

# --- columns a type 1 merge of matches may overwrite (the whole record, unlike a partial list,
# --- keeps hash and values consistent) --------------------------------------------------
TYPE1_MATCH_COLUMNS = (
    "match_status", "home_goals", "away_goals", "home_goals_halftime", "away_goals_halftime", "total_goals", "match_result",
    "is_finished", "is_draw", "source_updated_at", "ingested_at", "record_hash", "valid_from", "valid_to", "is_current", "transformed_at",
)


def merge_matches(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Matches without history: one row per match, overwritten in place."""
    return upsert_type1(target, batch, ["match_id"], TYPE1_MATCH_COLUMNS)


VERSION_KEYS = {
    "stg_matches": ("match_version_key", ("match_id",)),
    "stg_teams": ("team_version_key", ("team_id",)),
    "stg_fbref_matches": ("match_version_key", ("match_key",)),
    "stg_fbref_standings": ("standing_version_key", ("standing_key",)),
    "stg_players": ("player_version_key", ("player_name", "team_name", "competition_name", "season")),
}


def with_version_key(table: str, history: DataFrame) -> DataFrame:
    name, keys = VERSION_KEYS[table]
    return history.withColumn(name, surrogate_key(*keys, "valid_from"))
