"""Gold marts.  Inputs are *current* silver rows (see ``filters.current``), except for the
two marts that look back: :func:`player_form` and :func:`standing_history` take history.

No mart sorts its output: order is a reader's concern.  Marts carry no load timestamp;
the writer stamps one per run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import constants as K
from touchline.functions.labels import at_least, at_most, flag, ladder, movement, points, result_from_score
from touchline.functions.numeric import age_in, exact_sum, minus, per90, plus, quotient, ratio, share, units, zero
from touchline.functions.text import surrogate_key
from touchline.operators.aggregates import mean, ordered_text, share_where
from touchline.operators.filters import finished
from touchline.operators.joins import join_role, left_on, prefix_match, previous_version
from touchline.operators.sides import two_sided
from touchline.operators.windows import last_n, ordered, ranks

c = F.col
_SIDES = ("home", "away")


def _n() -> Column:
    return F.count(F.lit(1))


def _both_points(result: str | Column) -> dict[str, Column]:
    return {f"{s}_points": points(result, s.upper()) for s in _SIDES}


# --- matches ------------------------------------------------------------------------
def match_results(matches: DataFrame, teams: DataFrame) -> DataFrame:
    """Finished matches with team attributes, second-half goals, points and flags."""
    m = finished(matches)
    m = join_role(m, teams, ("home_team_id", "team_id"), {"home_team_code": "team_code", "home_stadium": "stadium_name"})
    m = join_role(m, teams, ("away_team_id", "team_id"), {"away_team_code": "team_code"})
    h, a = c("home_goals"), c("away_goals")
    derived = {
        **{f"{s}_goals_second_half": c(f"{s}_goals") - c(f"{s}_goals_halftime") for s in _SIDES},
        **_both_points("match_result"),
        "home_goal_difference": h - a,
        "away_goal_difference": a - h,
        "is_high_scoring": flag(c("total_goals") >= 3),
        "is_goalless": flag((h == 0) & (a == 0)),
        "both_teams_scored": flag((h > 0) & (a > 0)),
    }
    base = ["match_id", "match_date", "match_datetime", "matchday_number", "competition_code", "competition_name",
            "home_team_id", "home_team_name", "home_team_code", "home_stadium", "away_team_id", "away_team_name", "away_team_code",
            "home_goals", "away_goals", "total_goals", "home_goals_halftime", "away_goals_halftime", "match_result", "is_draw"]
    return m.withColumns(derived).select(*base, *derived)


def match_results_basic(matches: DataFrame) -> DataFrame:
    """Variant without dimensions: clean sheet = the *other* side did not score."""
    m = finished(matches)
    base = ["match_id", "match_date", "match_datetime", "competition_code", "competition_name", "matchday", "home_team_id",
            "home_team_name", "away_team_id", "away_team_name", "home_goals", "away_goals", "total_goals", "goal_difference", "match_result"]
    derived = {
        **_both_points("match_result"),
        "is_high_scoring": flag(c("total_goals") >= 3),
        "home_clean_sheet": flag(c("away_goals") == 0),
        "away_clean_sheet": flag(c("home_goals") == 0),
    }
    return m.select(*base, *[e.alias(n) for n, e in derived.items()])


def matches_with_xg(matches: DataFrame, xg_matches: DataFrame) -> DataFrame:
    """Finished matches of both sources, paired on competition, day and home-name prefix."""
    pairs = prefix_match(matches, xg_matches, ["competition_code", "match_date"], "home_team_name")
    l, r = c("l"), c("r")

    def first(name: str) -> Column:
        return F.coalesce(l[name], r[name])

    result = first("match_result")
    out = {
        "match_id": F.coalesce(l["match_id"].cast("string"), r["match_key"]),
        "match_date": first("match_date"),
        "match_datetime": l["match_datetime"],
        "matchday_number": l["matchday_number"],
        "competition_code": first("competition_code"),
        "competition_name": first("competition_name"),
    }
    for s in _SIDES:
        out |= {f"{s}_team_id": l[f"{s}_team_id"], f"{s}_team_name": first(f"{s}_team_name")}
    out |= {f"{s}_goals": first(f"{s}_goals") for s in _SIDES}
    out["total_goals"] = F.coalesce(l["total_goals"], r["home_goals"] + r["away_goals"])
    out |= {n: r[n] for n in ("home_xg", "away_xg", "total_xg", "home_xg_diff", "away_xg_diff")}
    out |= {"match_result": result, "is_draw": F.coalesce(l["is_draw"], r["match_result"] == "DRAW"), "is_finished": first("is_finished")}
    out |= {n: r[n] for n in ("venue", "attendance", "referee")}
    out |= _both_points(result)
    out |= {"has_api_data": l["match_id"].isNotNull(), "has_fbref_data": r["match_key"].isNotNull()}
    return finished(pairs.select(*[e.alias(n) for n, e in out.items()]))


def matchday_summary(results: DataFrame) -> DataFrame:
    home, away = c("match_result") == "HOME", c("match_result") == "AWAY"
    return results.groupBy("competition_code", "competition_name", "matchday_number").agg(
        F.min("match_date").alias("matchday_start_date"),
        F.max("match_date").alias("matchday_end_date"),
        _n().alias("total_matches"),
        F.sum("total_goals").alias("total_goals"),
        mean("total_goals").alias("avg_goals_per_match"),
        F.max("total_goals").alias("max_goals_in_match"),
        F.count_if(home).alias("home_wins"),
        F.count_if(away).alias("away_wins"),
        F.count_if("is_draw").alias("draws"),
        share_where(home).alias("home_win_pct"),
        share_where(away).alias("away_win_pct"),
        share_where(c("is_draw")).alias("draw_pct"),
        F.count_if("is_high_scoring").alias("high_scoring_matches"),
        F.count_if("is_goalless").alias("goalless_draws"),
        F.count_if("both_teams_scored").alias("both_teams_scored_matches"),
        share_where(c("both_teams_scored")).alias("btts_pct"),
    )


# --- teams --------------------------------------------------------------------------
def dim_teams(teams: DataFrame, results: DataFrame) -> DataFrame:
    """Teams with totals.  Both roles come out of one pass over the matches."""
    sides = two_sided(results, carry=("match_result",), pairs={
        "team_id": ("home_team_id", "away_team_id"),
        "scored": ("home_goals", "away_goals"),
        "conceded": ("away_goals", "home_goals"),
    })
    won, drawn = c("match_result") == c("venue"), c("match_result") == "DRAW"
    outcome = {"wins": won, "draws": drawn, "losses": ~won & ~drawn}  # no result: none of the three
    aggs = {}
    for v in _SIDES:
        at = c("venue") == v.upper()
        aggs[f"{v}_matches_played"] = F.count_if(at)
        aggs[f"{v}_points"] = F.sum(F.when(at, c("points")).otherwise(0))
        aggs |= {f"{v}_{name}": F.count_if(at & is_so) for name, is_so in outcome.items()}
    totals = sides.groupBy("team_id").agg(
        *[e.alias(n) for n, e in aggs.items()],
        F.sum("scored").alias("total_goals_scored"), F.sum("conceded").alias("total_goals_conceded"),
    )
    wide = teams.join(totals, "team_id", "left")
    wide = wide.withColumns({n: zero(n) for n in [*aggs, "total_goals_scored", "total_goals_conceded"]})
    summed = {f"total_{n}": c(f"home_{n}") + c(f"away_{n}") for n in ("matches_played", "points", "wins", "draws", "losses")}
    wide = wide.withColumns(summed)
    played = c("total_matches_played")
    return wide.select(
        "team_id", "team_name", "short_name", "team_code", "logo_url", "stadium_name", "founded_year", "club_colors", "competition_name",
        *summed, "total_goals_scored", "total_goals_conceded",
        (c("total_goals_scored") - c("total_goals_conceded")).alias("goal_difference"), *aggs,
        ratio("total_goals_scored", played, 2).alias("avg_goals_scored_per_match"),
        ratio("total_goals_conceded", played, 2).alias("avg_goals_conceded_per_match"),
        ratio("total_points", played, 2).alias("points_per_game"),
    )


def dim_teams_basic(teams: DataFrame, standings: DataFrame) -> DataFrame:
    """Variant: teams with their current table row."""
    keys = ["team_id", "competition_code"]
    take = ["position", "points", "wins", "draws", "losses", "goals_for", "goals_against", "points_per_game", "table_zone"]
    return left_on(teams, standings, keys, take).select(
        "team_id", "team_name", "team_code", "short_name", "venue", "founded", "club_colors", "competition_code", "competition_name",
        c("position").alias("current_position"), c("points").alias("current_points"), *take[2:],
    )


def competition_standings(teams: DataFrame) -> DataFrame:
    """League table; the last three places are the relegation zone."""
    rename = {
        "played": "total_matches_played", "won": "total_wins", "drawn": "total_draws", "lost": "total_losses",
        "goals_for": "total_goals_scored", "goals_against": "total_goals_conceded", "points": "total_points",
    }
    t = teams.filter(c("total_matches_played") > 0).select(
        "team_id", "team_name", "team_code", "competition_name", *[c(s).alias(n) for n, s in rename.items()], "goal_difference",
        "points_per_game", "avg_goals_scored_per_match", "avg_goals_conceded_per_match",
        *[f"{v}_{n}" for v in _SIDES for n in ("wins", "draws", "losses")],
    )
    t = ordered(t, ["competition_name"], ["points desc", "goal_difference desc", "goals_for desc"], key=["team_id"],
                row_number="position", size="__last")
    zone = ladder([(c("position") <= n, z) for n, z in K.ZONE_TOP] + [(c("position") >= c("__last") - 2, K.ZONE_BOTTOM)], K.ZONE_MIDDLE)
    return t.withColumn("zone", zone).drop("__last")


def team_xg_analysis(matches_xg: DataFrame) -> DataFrame:
    """Actual against expected goals per team, one pass over both roles."""
    sides = two_sided(matches_xg.filter(c("home_xg").isNotNull()), carry=("competition_name", "competition_code"), pairs={
        "team_name": ("home_team_name", "away_team_name"),
        "scored": ("home_goals", "away_goals"), "conceded": ("away_goals", "home_goals"),
        "xg": ("home_xg", "away_xg"), "xga": ("away_xg", "home_xg"),
    })
    t = sides.groupBy("competition_name", "team_name").agg(
        F.max("competition_code").alias("competition_code"),
        _n().alias("total_matches"), F.sum("points").alias("total_points"),
        F.sum("scored").alias("goals_scored"), F.sum("conceded").alias("goals_conceded"),
        F.coalesce(exact_sum("xg"), F.lit(0.0)).alias("total_xg"), F.coalesce(exact_sum("xga"), F.lit(0.0)).alias("total_xga"),
    )
    gf, ga, n = c("goals_scored"), c("goals_conceded"), c("total_matches")
    scored_over, conceded_under = minus(gf, "total_xg"), minus("total_xga", ga)

    def quality(better: Column, noun: str) -> Column:
        # fixed values: label words; `better` is goals above expectation, in the good direction
        return ladder([(better > 3, f"Elite {noun}"), (better > 0, f"Good {noun}"),
                       (better < -3, f"Poor {noun}"), (better < 0, f"Below Average {noun}")], f"Average {noun}")

    return t.select(
        "competition_name", "competition_code", "team_name", "total_matches", "total_points", "goals_scored", "goals_conceded",
        (gf - ga).alias("goal_difference"), "total_xg", "total_xga",
        minus("total_xg", "total_xga").alias("xg_difference"),
        scored_over.alias("goals_vs_xg"), minus(ga, "total_xga").alias("goals_conceded_vs_xga"),
        ratio(gf, n, 2).alias("goals_per_game"), ratio("total_xg", n, 2).alias("xg_per_game"),
        ratio(ga, n, 2).alias("goals_conceded_per_game"), ratio("total_xga", n, 2).alias("xga_per_game"),
        plus(scored_over, conceded_under).alias("luck_index"),
        quality(scored_over, "Finishing").alias("finishing_quality"),
        quality(conceded_under, "Defense").alias("defensive_quality"),
    )


# --- form and head to head ------------------------------------------------------------
_XG_SIDES = {
    "team_name": ("home_team_name", "away_team_name"), "opponent": ("away_team_name", "home_team_name"),
    "goals_scored": ("home_goals", "away_goals"), "goals_conceded": ("away_goals", "home_goals"),
    "xg": ("home_xg", "away_xg"), "xga": ("away_xg", "home_xg"),
}


def _results(letters: Sequence[str], prefix: str = "") -> list[Column]:
    names = ("wins", "draws", "losses")
    return [F.count_if(c("result") == x).alias(f"{prefix}{n}") for x, n in zip(letters, names)]


def team_form(matches: DataFrame, *, match_key: str = "match_key", n: int = 5) -> DataFrame:
    """Last ``n`` finished matches per team and competition, newest first.

    The ``n``-row limit is applied before the shuffle, so the aggregation only ever sees
    ``n`` rows per group.  ``match_key`` breaks ties between matches of one day.
    """
    sides = two_sided(finished(matches), carry=("match_date", "competition_name", match_key), pairs=_XG_SIDES)
    recent = last_n(sides, ["team_name", "competition_name"], ["match_date", match_key], n)
    f = recent.groupBy("team_name", "competition_name").agg(
        ordered_text("result", "recency").alias("form_string"),
        _n().alias("matches_in_form"), F.sum("points").alias("form_points"), *_results("WDL", "form_"),
        F.sum("goals_scored").alias("form_goals_scored"), F.sum("goals_conceded").alias("form_goals_conceded"),
        mean("goals_scored").alias("form_avg_goals_scored"), mean("goals_conceded").alias("form_avg_goals_conceded"),
        exact_sum("xg").alias("form_xg"), exact_sum("xga").alias("form_xga"),
        F.count_if(c("goals_conceded") == 0).alias("form_clean_sheets"), F.count_if(c("goals_scored") == 0).alias("form_failed_to_score"),
        F.min("match_date").alias("form_period_start"), F.max("match_date").alias("form_period_end"),
    )
    trend = ladder([(c("form_wins") >= 4, "Hot Streak"), (c("form_losses") >= 4, "Cold Streak"),
                    (c("form_draws") >= 3, "Drawing Habit")], "Mixed")  # fixed values: trend labels
    return f.withColumns({
        "form_key": surrogate_key("team_name", "competition_name"),
        "form_ppg": ratio("form_points", "matches_in_form", 2),
        "form_goal_diff": c("form_goals_scored") - c("form_goals_conceded"),
        "form_xg_diff": minus("form_xg", "form_xga"),
        "form_rating": at_least("form_points", K.FORM_RATINGS, K.FORM_RATING_REST),
        "form_trend": trend,
    })


def head_to_head(matches: DataFrame) -> DataFrame:
    """Record of each pair, once from each side; both rows share ``h2h_key``.

    Groups on (perspective, opponent), a refinement of the unordered pair, so the pair
    key is derived after the aggregation.  A finished match without result is a draw.
    """
    decided = finished(matches).withColumn("match_result", F.coalesce("match_result", F.lit("DRAW")))
    sides = two_sided(decided, carry=("match_date", "competition_name"), pairs=_XG_SIDES, names=("WIN", "DRAW", "LOSS"))
    won = c("result") == "WIN"
    g = sides.groupBy(c("team_name").alias("perspective_team"), c("opponent").alias("opponent_team"), "competition_name").agg(
        _n().alias("total_matches"), F.min("match_date").alias("first_meeting"), F.max("match_date").alias("last_meeting"),
        *_results(("WIN", "DRAW", "LOSS")),
        F.sum("goals_scored").alias("goals_scored"), F.sum("goals_conceded").alias("goals_conceded"),
        mean("goals_scored").alias("avg_goals_scored"), mean("goals_conceded").alias("avg_goals_conceded"),
        exact_sum("xg").alias("xg_total"), exact_sum("xga").alias("xga_total"),
        F.count_if(won & (c("venue") == "HOME")).alias("team_1_home_wins"), F.count_if(won & (c("venue") == "AWAY")).alias("team_1_away_wins"),
    )
    lead = c("wins") - c("losses")
    dominance = ladder([(lead > 2, "Dominant"), (lead > 0, "Slight Edge"), (lead == 0, "Even"), (lead < -2, "Inferior")],
                       "Slight Disadvantage")  # fixed values: dominance labels
    first, second = F.least("perspective_team", "opponent_team"), F.greatest("perspective_team", "opponent_team")
    return g.withColumns({"team_a": first, "team_b": second}).withColumns({
        "h2h_key": surrogate_key("team_a", "team_b", "competition_name"),
        "points": c("wins") * 3 + c("draws"),
        "opponent_points": c("losses") * 3 + c("draws"),
        "goal_difference": c("goals_scored") - c("goals_conceded"),
        "xg_difference": minus("xg_total", "xga_total"),
        "win_percentage": share("wins", "total_matches"),
        "draw_percentage": share("draws", "total_matches"),
        "loss_percentage": share("losses", "total_matches"),
        "h2h_dominance": dominance,
    })


def head_to_head_basic(results: DataFrame) -> DataFrame:
    """Variant over match facts: four dominance labels, no pair key."""
    sides = two_sided(results, carry=("competition_name",))
    g = sides.groupBy(c("team_name").alias("team"), "opponent", "competition_name").agg(
        _n().alias("matches_played"), *_results("WDL"),
        F.sum("goals_scored").alias("goals_for"), F.sum("goals_conceded").alias("goals_against"), F.sum("points").alias("total_points"),
    )
    lead = c("wins") - c("losses")
    return g.withColumns({
        "goal_difference": c("goals_for") - c("goals_against"),
        "win_percentage": share("wins", "matches_played"),
        "dominance": ladder([(lead > 2, "Dominant"), (lead > 0, "Edge"), (lead == 0, "Even")], "Underdog"),  # fixed values
    })


# --- players ------------------------------------------------------------------------
# fixed values: score weights per position, in tenths; the second table weighs counts per 90
_SCORE_TENTHS = {
    "Forward": {"goals_per90": 300, "assists_per90": 200, "shot_conversion_pct": 3, "goals_minus_xg": 50},
    "Midfielder": {"goals_per90": 150, "assists_per90": 250, "pass_completion_pct": 2},
    "Defender": {"pass_completion_pct": 3},
}
_SCORE_PER90 = {
    "Midfielder": {"key_passes": 5, "progressive_passes": 3},
    "Defender": {"tackles": 10, "interceptions": 10, "clearances": 5},
}


def _performance_score() -> Column:
    """Weighted figures plus weighted counts per 90, rounded once at the end."""
    played = units("nineties")  # hundredths

    def weigh(position: str) -> Column:
        thousandths = sum((units(zero(n)) * w for n, w in _SCORE_TENTHS[position].items()), F.lit(0).cast("long"))
        counts = _SCORE_PER90.get(position)
        if not counts:
            return quotient(thousandths, F.lit(1000), 1)
        volume = sum((zero(n).cast("long") * w for n, w in counts.items()), F.lit(0).cast("long"))
        return quotient(thousandths * played + volume * 100_000, played * 1000, 1)

    return ladder([(c("position_category") == p, weigh(p)) for p in _SCORE_TENTHS])


def player_performance(players: DataFrame, *, min_minutes: int = 90) -> DataFrame:
    p = players.filter(c("minutes") >= min_minutes)
    cards = c("yellow_cards") + c("red_cards")
    # fixed values: risk labels; more than 0.3 / 0.15 cards per 90, compared in whole numbers
    card_load, played = cards.cast("long") * 10_000, units("nineties")
    risk = ladder([(~F.coalesce(played > 0, F.lit(False)), "Unknown"), (card_load > played * 30, "High"), (card_load > played * 15, "Medium")], "Low")
    rates = {"key_passes": "key_passes", "progressive_passes": "progressive_passes", "tackles": "tackles",
             "interceptions": "interceptions", "defensive_actions": "defensive_actions"}
    return p.select(
        "player_season_key", surrogate_key("player_name").alias("player_key"),
        "player_name", "team_name", "position", "position_category", "nationality", c("calculated_age").alias("age"),
        "competition_name", "competition_code", "season",
        "matches_played", "starts", "minutes", "nineties", "sub_appearances",
        ratio("minutes", "starts", 0).alias("minutes_per_start"),
        "goals", "assists", "goal_contributions", "non_penalty_goals", "penalty_goals", "xg", "npxg", "xa", "xg_xa",
        "goals_minus_xg", "assists_minus_xa",
        plus("goals_minus_xg", "assists_minus_xa").alias("total_overperformance"),
        "goals_per90", "assists_per90", per90(c("goals") + c("assists"), "nineties").alias("goal_contributions_per90"),
        "xg_per90", "xa_per90", per90(plus("xg", "xa"), "nineties").alias("xg_xa_per90"),
        "shots", "shots_on_target", "shot_accuracy_pct", "shot_conversion_pct", "shots_per90",
        ratio("shots", "goals", 1).alias("shots_per_goal"),
        "passes_completed", "passes_attempted", "pass_completion_pct", "key_passes", "passes_into_final_third",
        "passes_into_penalty_area", "progressive_passes",
        *[per90(s, "nineties").alias(f"{n}_per90") for n, s in rates.items()],
        "tackles", "tackles_won", "interceptions", "blocks", "clearances", "defensive_actions",
        share("tackles_won", "tackles").alias("tackle_success_pct"),
        "sca", "sca_per90", "gca", "gca_per90", "yellow_cards", "red_cards", cards.alias("total_cards"),
        per90(cards, "nineties").alias("cards_per90"), risk.alias("discipline_risk"),
        _performance_score().alias("performance_score"),
    )


def dim_players(players: DataFrame, ref_year: int = K.REFERENCE_YEAR) -> DataFrame:
    def is_(position: str) -> Column:
        return c("position_category") == position

    # fixed values: player types and finishing labels with their thresholds
    kind = ladder([
        (is_("Forward") & (c("goals_per90") >= 0.5), "Elite Striker"),
        (is_("Forward") & (c("goals_per90") >= 0.3), "Goal Scorer"),
        (is_("Forward"), "Forward"),
        (is_("Midfielder") & (c("assists_per90") >= 0.3), "Playmaker"),
        (is_("Midfielder") & (c("goals_per90") >= 0.2), "Box-to-Box"),
        (is_("Midfielder"), "Midfielder"),
        (is_("Defender") & (c("tackles") + c("interceptions") >= 5), "Ball Winner"),
        (is_("Defender"), "Defender"),
        (is_("Goalkeeper"), "Goalkeeper"),
    ], K.UNKNOWN)
    over = c("goals_minus_xg")
    finishing = ladder([
        (~(c("minutes") >= 450) | over.isNull(), "Insufficient Data"),
        (over >= 3, "Elite Finisher"), (over > 0, "Good Finisher"), (over < -3, "Poor Finisher"),
    ], "Below Average Finisher")
    return players.select(
        surrogate_key("player_name").alias("player_key"), "player_name", "nationality", "birth_year",
        age_in(ref_year, "birth_year").alias("age"),
        c("team_name").alias("current_team"), c("competition_name").alias("current_competition"), "position", "position_category",
        c("season").alias("current_season"), "matches_played", "starts", "minutes", "nineties",
        "goals", "assists", "goal_contributions", "non_penalty_goals", "penalty_goals",
        "xg", "npxg", "xa", "xg_xa", "goals_minus_xg", "assists_minus_xa", "goals_per90", "assists_per90", "xg_per90", "xa_per90",
        "shots", "shots_on_target", "shot_accuracy_pct", "shot_conversion_pct", "passes_completed", "pass_completion_pct",
        "key_passes", "progressive_passes", "tackles", "interceptions", "defensive_actions",
        "sca", "sca_per90", "gca", "gca_per90", "yellow_cards", "red_cards",
        kind.alias("player_type"), finishing.alias("finishing_quality"),
    )


_WHO = ["player_name", "team_name", "nationality", "position", "position_category", "age",
        "competition_name", "competition_code", "season"]


def top_scorers(performance: DataFrame) -> DataFrame:
    p = performance.filter(c("goals") > 0).select(
        "player_season_key", *_WHO, "matches_played", "starts", "minutes", "nineties", "goals", "non_penalty_goals", "penalty_goals",
        "goals_per90", "xg", "goals_minus_xg", "shots", "shots_on_target", "shot_conversion_pct", "shots_per_goal", "assists",
        "goal_contributions", ratio("minutes", "goals", 0).alias("minutes_per_goal"))
    return _ranked(p, ["goals desc", "assists desc", "minutes"]).withColumn(
        "golden_boot_status", at_most("rank_in_competition", K.SCORER_STATUS, K.SCORER_STATUS_REST))


def top_assisters(performance: DataFrame) -> DataFrame:
    p = performance.filter((c("assists") > 0) | (c("key_passes") >= 10)).select(
        "player_season_key", *_WHO, "matches_played", "starts", "minutes", "nineties", "assists", "assists_per90", "xa",
        "assists_minus_xa", "key_passes", "key_passes_per90", "passes_into_final_third", "passes_into_penalty_area",
        "progressive_passes", "progressive_passes_per90", "sca", "sca_per90", "gca", "gca_per90", "goals", "goal_contributions",
        ratio("minutes", "assists", 0).alias("minutes_per_assist"),
        per90(c("key_passes") + c("passes_into_penalty_area"), "nineties").alias("chance_creation_per90"))
    return _ranked(p, ["assists desc", "key_passes desc", "minutes"]).withColumn(
        "playmaker_status", at_most("rank_in_competition", K.ASSISTER_STATUS, K.ASSISTER_STATUS_REST))


def _ranked(p: DataFrame, order: list[str]) -> DataFrame:
    return ranks(p, ["player_season_key"], {"rank_in_competition": (["competition_name"], order), "overall_rank": ([], order)})


def player_xg_analysis(performance: DataFrame, *, min_minutes: int = 450) -> DataFrame:
    p = performance.filter((c("minutes") >= min_minutes) & ((c("xg") > 0) | (c("xa") > 0)))
    g, a = minus("goals", "xg"), minus("assists", "xa")
    xg, xa = units("xg"), units("xa")
    skill = quotient((units(g) * xa + units(a) * xg) * 50, xg * xa, 1)  # 50 g / xg + 50 a / xa over one denominator
    p = p.select(
        "player_season_key", *_WHO, "matches_played", "minutes", "nineties", "goals", "xg", "npxg", "goals_minus_xg",
        "assists", "xa", "assists_minus_xa", "goal_contributions", "xg_xa", "total_overperformance",
        "goals_per90", "xg_per90", "assists_per90", "xa_per90", "goal_contributions_per90", "xg_xa_per90",
        per90(g, "nineties").alias("goals_over_xg_per90"), per90(a, "nineties").alias("assists_over_xa_per90"),
        "shots", "shots_on_target", "shot_conversion_pct",
        ratio("xg", "shots", 3).alias("xg_per_shot"), ratio("goals", "xg", 2).alias("goals_per_xg"),
        at_least(g, K.FINISHING_CATEGORY, K.CATEGORY_REST).alias("finishing_category"),
        at_least(a, K.CREATIVE_CATEGORY, K.CATEGORY_REST).alias("creative_category"),
        skill.alias("skill_luck_index"),
    )
    return ranks(p, ["player_season_key"], {
        "finishing_rank": (["competition_name"], ["goals_minus_xg desc"]),
        "creating_rank": (["competition_name"], ["assists_minus_xa desc"]),
        "overall_overperformance_rank": (["competition_name"], ["total_overperformance desc"]),
    })


def player_form(history: DataFrame, *, min_matches: int = 3) -> DataFrame:
    """Current version of each player-season against the version before it."""
    measures = ["goals", "assists", "minutes", "xg", "xa"]
    # Only what the mart shows goes through the aggregation.
    shown = ["player_season_key", "player_name", "team_name", "competition_name", "position_category", "nationality", "calculated_age", "matches_played", "goal_contributions",
             "goals_minus_xg", "assists_minus_xa", "goals_per90", "assists_per90", "xg_per90", "xa_per90", "record_hash", "valid_from", "is_current"]
    p = previous_version(history.select(*shown, *measures), "player_season_key", {f"prev_{m}": m for m in measures} | {"prev_from": "valid_from"})
    p = p.filter(c("matches_played") >= min_matches)
    counted = {f"recent_{m}": c(m) - zero(f"prev_{m}") for m in measures[:3]}
    expected = {f"recent_{m}": minus(m, zero(f"prev_{m}")) for m in measures[3:]}
    p = p.withColumns({**counted, **expected})
    goals, assists, minutes = c("recent_goals"), c("recent_assists"), c("recent_minutes")
    # fixed values: form labels and thresholds
    form = ladder([
        ((goals >= 3) | (assists >= 3), "🔥 Hot"),
        ((goals >= 1) | (assists >= 2), "✅ Good Form"),
        (minutes < 90, "🪑 Limited Minutes"),
        ((goals == 0) & (assists == 0) & (minutes > 180), "📉 Cold"),
    ], "➡️ Steady")

    def recent90(x: Column) -> Column:
        return F.when(minutes >= 90, ratio(x * 90, minutes, 2, num_scale=0, den_scale=0))

    return p.select(
        "player_season_key", "player_name", "team_name", "competition_name", "position_category", "nationality",
        c("calculated_age").alias("age"), "matches_played", "minutes", "goals", "assists", "goal_contributions", "xg", "xa",
        "goals_minus_xg", "assists_minus_xa", "goals_per90", "assists_per90", "xg_per90", "xa_per90",
        *counted, *expected, recent90(goals).alias("recent_goals_per90"), recent90(assists).alias("recent_assists_per90"),
        form.alias("current_form"), flag((goals >= 2) & (minutes <= 270)).alias("is_on_hot_streak"),
        F.datediff("valid_from", "prev_from").alias("days_since_update"), c("valid_from").alias("last_updated"),
    )


def standing_history(history: DataFrame) -> DataFrame:
    """Every standings version with the change since the version before it."""
    before = {"previous_position": "position", "previous_points": "points", "__previous_matches": "matches_played"}
    s = ordered(history, ["team_name", "competition_name", "season"], ["valid_from"], key=["standing_key"],
                row_number="snapshot_number", lag=before, size="total_snapshots")
    change = F.coalesce("previous_position", "position") - c("position")
    gained = c("points") - zero("previous_points")
    played = c("matches_played") - zero("__previous_matches")
    zone = ladder([(c("position") <= n, z) for n, z in K.SNAPSHOT_ZONES_TOP]
                  + [(c("position") >= n, z) for n, z in K.SNAPSHOT_ZONES_BOTTOM], K.ZONE_MIDDLE)
    return s.select(
        surrogate_key("team_name", "competition_name", "season", "valid_from").alias("history_key"),
        "team_name", "competition_name", "competition_code", "season", "snapshot_number", "total_snapshots",
        c("valid_from").alias("snapshot_date"), "is_current", "position", "previous_position", change.alias("position_change"),
        "points", "previous_points", gained.alias("points_gained"), "matches_played", played.alias("matches_since_last"),
        F.when(played > 0, ratio(gained, played, 2)).alias("period_ppg"),
        "wins", "draws", "losses", "goals_for", "goals_against", "goal_difference", "xg", "xga",
        minus("xg", "xga").alias("xg_difference"), movement(change).alias("position_movement"), zone.alias("table_zone"),
    )
