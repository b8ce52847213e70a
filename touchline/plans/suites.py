"""The quality rules of every table, as data for ``operators.quality``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from touchline import constants as K
from touchline.operators import quality as q
from touchline.operators.sides import stack_all

_CODES = list(K.COMPETITION_CODES.values())
_NAMES = list(K.COMPETITION_CODES)
_HISTORY = ("record_hash", "valid_from", "is_current")
_POINTS = [0, 1, 3]


def _versioned(version_key: str, business_key: str, *required: str) -> list:
    """What every history table promises."""
    return [q.unique(version_key), *q.not_null(version_key, business_key, *required, *_HISTORY), *q.scd2(business_key)]


# fixed values: rule parameters per table
SILVER = {
    "stg_matches": [
        *_versioned("match_version_key", "match_id", "match_datetime", "competition_code", "home_team_id", "away_team_id"),
        q.accepted("match_status", K.MATCH_STATUSES),
        q.accepted("competition_code", _CODES),
        q.accepted("match_result", ["HOME", "AWAY", "DRAW"], where="is_finished AND is_current"),
        q.in_range("home_goals", 0, 20, where="is_finished"),
        q.in_range("away_goals", 0, 20, where="is_finished"),
        q.foreign_key("home_team_id", "stg_teams", "team_id", where="is_current"),
        q.foreign_key("away_team_id", "stg_teams", "team_id", where="is_current"),
        q.fresh("transformed_at", 48),
    ],
    "stg_teams": _versioned("team_version_key", "team_id", "team_name"),
    "stg_fbref_matches": [
        *_versioned("match_version_key", "match_key", "competition_name"),
        q.accepted("competition_name", _NAMES),
    ],
    "stg_fbref_standings": [
        *_versioned("standing_version_key", "standing_key", "competition_name", "team_name", "position", "points"),
        q.in_range("position", 1, 20),
        q.in_range("points", 0, 150),
        q.group_size(["competition_name"], "team_name", 18, 20, where="is_current"),
        q.fresh("transformed_at", 24 * 7),
    ],
    "stg_players": [
        *_versioned("player_version_key", "player_season_key", "player_name", "team_name", "competition_name"),
        q.accepted("competition_name", _NAMES),
        q.accepted("position_category", [n for n, _ in K.POSITION_TOKENS] + [K.UNKNOWN]),
    ],
}

GOLD = {
    "fct_match_results": [
        q.unique("match_id"), *q.not_null("match_id", "match_date", "competition_code", "home_team_id", "away_team_id", "total_goals"),
        q.accepted("home_points", _POINTS), q.accepted("away_points", _POINTS), q.in_range("total_goals", 0, 15),
        q.row_rule("POINTS SUM: home + away = 2 or 3", "home_points + away_points IN (2, 3)"),
        q.foreign_key("home_team_id", "dim_teams", "team_id"),
    ],
    "dim_teams": [q.unique("team_id"), *q.not_null("team_id", "team_name")],
    "agg_competition_standings": [*q.not_null("position", "team_id", "competition_name", "points"), q.in_range("position", 1, 20)],
    "agg_matchday_summary": q.not_null("competition_code", "matchday_number", "total_matches"),
    "fct_matches_with_xg": [*q.not_null("match_id", "competition_name"), q.accepted("competition_name", _NAMES)],
    "agg_team_xg_analysis": [
        *q.not_null("team_name", "competition_name"),
        q.accepted("finishing_quality", [f"{w} Finishing" for w in ("Elite", "Good", "Average", "Below Average", "Poor")]),
    ],
    "dim_players": q.not_null("player_key", "player_name"),
    "fct_player_performance": [q.unique("player_season_key"), *q.not_null("player_season_key", "player_name")],
    "agg_top_scorers": q.not_null("rank_in_competition", "player_name", "goals"),
    "agg_top_assisters": q.not_null("rank_in_competition", "player_name"),
    "agg_player_xg_analysis": [
        *q.not_null("player_name"), q.accepted("finishing_category", [t for _, t in K.FINISHING_CATEGORY] + [K.CATEGORY_REST]),
    ],
    "agg_head_to_head": [
        *q.not_null("h2h_key", "team_a", "team_b", "perspective_team", "opponent_team"), q.in_range("total_matches", lo=1),
        q.row_rule("RECORD SUM: W+D+L = matches", "wins + draws + losses = total_matches"),
        q.accepted("h2h_dominance", ["Dominant", "Slight Edge", "Even", "Slight Disadvantage", "Inferior"]),
    ],
    "agg_team_form": [
        q.unique("form_key"), *q.not_null("form_key", "team_name", "form_points"),
        q.in_range("form_points", 0, 15), q.in_range("matches_in_form", 1, 5), q.matches("form_string", "^[WDL]+$"),
        q.accepted("form_rating", [t for _, t in K.FORM_RATINGS] + [K.FORM_RATING_REST]),
        q.accepted("form_trend", ["Hot Streak", "Cold Streak", "Drawing Habit", "Mixed"]),
    ],
    "agg_player_form": [
        *q.not_null("player_season_key", "player_name"),
        q.accepted("current_form", ["🔥 Hot", "✅ Good Form", "🪑 Limited Minutes", "📉 Cold", "➡️ Steady"]),
    ],
    "agg_standing_history": [
        q.unique("history_key"), *q.not_null("history_key", "team_name", "position"),
        q.accepted("table_zone", [t for _, t in K.SNAPSHOT_ZONES_TOP + K.SNAPSHOT_ZONES_BOTTOM] + [K.ZONE_MIDDLE]),
    ],
}
# The payload line: tables keyed by team and competition.
PAYLOAD = {
    "stg_matches": [*q.not_null("match_id", "competition_code", "home_team_id", "away_team_id"), q.unique("match_id", where="is_current"), *q.scd2("match_id"),
                    q.accepted("competition_code", _CODES), q.in_range("home_goals", 0, 20, where="is_finished"), q.in_range("away_goals", 0, 20, where="is_finished")],
    "stg_teams": [*q.not_null("team_id", "team_name"), q.unique("team_id", "competition_code", where="is_current"), *q.scd2("team_id", "competition_code")],
    "stg_standings": [*q.not_null("team_id", "position", "points"), q.in_range("position", 1, 20), q.in_range("points", 0, 150), *q.scd2("team_id", "competition_code")],
}
PAYLOAD_SUITES = {t: ("Silver", c) for t, c in PAYLOAD.items()}
SUITES = {**{t: ("Silver", c) for t, c in SILVER.items()}, **{t: ("Gold", c) for t, c in GOLD.items()}}


def run_suites(tables: Mapping[str, DataFrame], now, suites: Mapping[str, tuple[str, list]] = SUITES) -> DataFrame:
    """Every suite whose table is given, as one query.  Parents of foreign keys are looked
    up among the tables; a history parent counts with its current rows."""
    parents = {n: (t.filter("is_current") if "is_current" in t.columns else t) for n, t in tables.items()}
    return stack_all([q.run_suite(tables[n], layer, n, checks, now, parents) for n, (layer, checks) in suites.items() if n in tables])


# --- the same kind of rules as SQL over named tables: a rule passes when it returns no rows ---
def _null(table: str, col: str) -> tuple[str, str]:
    return f"{table}.{col}_not_null", f"SELECT * FROM {table} WHERE {col} IS NULL"


def _duplicate(name: str, table: str, col: str, where: str = "TRUE") -> tuple[str, str]:
    return f"{table}.{name}", f"SELECT {col}, count(*) AS copies FROM {table} WHERE {where} GROUP BY {col} HAVING count(*) > 1"


def _outside(name: str, table: str, cols: Iterable[str], lo, hi=None, where: str = "TRUE") -> tuple[str, str]:
    tests = " OR ".join(f"{c} < {lo}" + (f" OR {c} > {hi}" if hi is not None else "") for c in cols)
    return f"{table}.{name}", f"SELECT * FROM {table} WHERE ({where}) AND ({tests})"


def _no_parent(name: str, child: str, key: str, parent: str, parent_key: str) -> tuple[str, str]:
    return f"ref_integrity.{name}", (
        f"SELECT c.{key} FROM {child} c LEFT ANTI JOIN (SELECT {parent_key} AS k FROM {parent} WHERE is_current) p ON c.{key} = p.k WHERE c.is_current")


def sql_rules(now: str, silver: str = "silver", gold: str = "gold", max_days: int = 7) -> dict[str, str]:
    """Rule name -> query.  ``silver`` and ``gold`` are schema names, or empty for views."""
    m, t, s = (f"{silver}.{n}".lstrip(".") for n in ("stg_matches", "stg_teams", "stg_standings"))
    f, d, form, h2h = (f"{gold}.{n}".lstrip(".") for n in ("fct_match_results", "dim_teams", "agg_team_form", "agg_head_to_head"))
    codes = ", ".join(f"'{x}'" for x in _CODES)

    def stale(table: str) -> str:
        return f"SELECT '{table}' AS tbl FROM {table} HAVING datediff(timestamp '{now}', max(transformed_at)) > {max_days}"

    return dict([
        _null(m, "match_id"),
        (f"{m}.valid_competition_code", f"SELECT DISTINCT competition_code FROM {m} WHERE competition_code NOT IN ({codes})"),
        _duplicate("unique_current_match_id", m, "match_id", "is_current"),
        _outside("valid_goals_range", m, ("home_goals", "away_goals"), 0, 20, "is_finished"),
        _null(t, "team_id"),
        _null(t, "team_name"),
        _outside("valid_position_range", s, ("position",), 1, 20, "is_current"),
        _outside("valid_points_range", s, ("points",), 0, 150, "is_current"),
        _duplicate("unique_match_id", f, "match_id"),
        *[(f"{f}.valid_{x}_points", f"SELECT match_id FROM {f} WHERE {x}_points NOT IN (0, 1, 3)") for x in ("home", "away")],
        (f"{f}.points_add_up", f"SELECT match_id FROM {f} WHERE home_points + away_points NOT IN (2, 3)"),
        _duplicate("unique_team_id", d, "team_id"),
        _outside("valid_position", d, ("current_position",), 1, 20),
        _outside("valid_form_points", form, ("form_points",), 0, 15),
        (f"{form}.valid_form_string", f"SELECT form_string FROM {form} WHERE NOT regexp_like(form_string, '^[WDL]+$')"),
        _outside("positive_matches", h2h, ("total_matches",), 1),
        _no_parent("matches_have_valid_home_team", m, "home_team_id", t, "team_id"),
        _no_parent("matches_have_valid_away_team", m, "away_team_id", t, "team_id"),
        _no_parent("all_competitions_have_standings", m, "competition_code", s, "competition_code"),
        ("freshness.data_not_stale", f"{stale(m)} UNION ALL {stale(s)}"),
    ])


def run_sql_rules(spark: SparkSession, rules: Mapping[str, str], now, run_id: str, *, samples: bool = False) -> DataFrame:
    return stack_all([q.run_rule(spark, name, text, now, run_id, samples=samples) for name, text in rules.items()])
