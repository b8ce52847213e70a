"""Gold marts (G) against SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registry import query
from checks.sql import cents, exclude, rdiv, sk, sql, units
from touchline.operators import windows
from touchline.plans import gold, silver

MATCHDAY = f"""
SELECT competition_code, competition_name, matchday_number, min(match_date) AS matchday_start_date, max(match_date) AS matchday_end_date,
  count(*) AS total_matches, CAST(sum(total_goals) AS BIGINT) AS total_goals, {rdiv('sum(total_goals)', 'count(*)', 2)} AS avg_goals_per_match,
  max(total_goals) AS max_goals_in_match, count(*) FILTER (match_result = 'HOME') AS home_wins, count(*) FILTER (match_result = 'AWAY') AS away_wins,
  count(*) FILTER (is_draw) AS draws, {rdiv("count(*) FILTER (match_result = 'HOME') * 100", 'count(*)', 1)} AS home_win_pct,
  {rdiv("count(*) FILTER (match_result = 'AWAY') * 100", 'count(*)', 1)} AS away_win_pct, {rdiv('count(*) FILTER (is_draw) * 100', 'count(*)', 1)} AS draw_pct,
  count(*) FILTER (is_high_scoring) AS high_scoring_matches, count(*) FILTER (is_goalless) AS goalless_draws,
  count(*) FILTER (both_teams_scored) AS both_teams_scored_matches, {rdiv('count(*) FILTER (both_teams_scored) * 100', 'count(*)', 1)} AS btts_pct
FROM g_results GROUP BY ALL"""

STANDINGS = """
SELECT * EXCLUDE (n), CASE WHEN position < 5 THEN 'Champions League' WHEN position < 7 THEN 'Europa League' WHEN position > n - 3 THEN 'Relegation Zone'
  ELSE 'Mid-table' END AS zone
FROM (SELECT CAST(row_number() OVER (PARTITION BY competition_name ORDER BY total_points DESC, goal_difference DESC, total_goals_scored DESC, team_id) AS BIGINT) AS position,
    count(*) OVER (PARTITION BY competition_name) AS n, team_id, team_name, team_code, competition_name, total_matches_played AS played, total_wins AS won,
    total_draws AS drawn, total_losses AS lost, total_goals_scored AS goals_for, total_goals_conceded AS goals_against, goal_difference, total_points AS points,
    points_per_game, avg_goals_scored_per_match, avg_goals_conceded_per_match, home_wins, home_draws, home_losses, away_wins, away_draws, away_losses
  FROM g_teams WHERE total_matches_played > 0)"""

_diff_f, _diff_d = "(gf * 100 - xg)", "(xga - ga * 100)"


def _quality(diff: str, noun: str) -> str:
    return (f"CASE WHEN {diff} > 300 THEN 'Elite {noun}' WHEN {diff} > 0 THEN 'Good {noun}' WHEN {diff} < -300 THEN 'Poor {noun}' "
            f"WHEN {diff} < 0 THEN 'Below Average {noun}' ELSE 'Average {noun}' END")


TEAM_XG = f"""
SELECT competition_name, code AS competition_code, team_name, n AS total_matches, pts AS total_points, gf AS goals_scored, ga AS goals_conceded,
  gf - ga AS goal_difference, {units('xg')} AS total_xg, {units('xga')} AS total_xga, {units('xg - xga')} AS xg_difference, {units('gf * 100 - xg')} AS goals_vs_xg,
  {units('ga * 100 - xga')} AS goals_conceded_vs_xga, {rdiv('gf', 'n', 2)} AS goals_per_game, {rdiv('xg', '(n * 100)', 2)} AS xg_per_game,
  {rdiv('ga', 'n', 2)} AS goals_conceded_per_game, {rdiv('xga', '(n * 100)', 2)} AS xga_per_game, {units(f'{_diff_f} + {_diff_d}')} AS luck_index,
  {_quality(_diff_f, 'Finishing')} AS finishing_quality, {_quality(_diff_d, 'Defense')} AS defensive_quality
FROM (SELECT competition_name, max(competition_code) AS code, team_name, count(*) AS n, CAST(sum(pts) AS BIGINT) AS pts, CAST(sum(gf) AS BIGINT) AS gf,
    CAST(sum(ga) AS BIGINT) AS ga, CAST(sum(xg) AS BIGINT) AS xg, CAST(sum(xga) AS BIGINT) AS xga
  FROM (SELECT competition_name, competition_code, home_team_name AS team_name, home_points AS pts, home_goals AS gf, away_goals AS ga,
      {cents('home_xg')} AS xg, {cents('away_xg')} AS xga FROM g_xg WHERE home_xg IS NOT NULL
    UNION ALL SELECT competition_name, competition_code, away_team_name, away_points, away_goals, home_goals, {cents('away_xg')}, {cents('home_xg')}
      FROM g_xg WHERE home_xg IS NOT NULL) GROUP BY competition_name, team_name)"""

H2H = f"""
SELECT {sk('least(team_name, opponent)', 'greatest(team_name, opponent)', 'competition_name')} AS h2h_key, least(team_name, opponent) AS team_a,
  greatest(team_name, opponent) AS team_b, team_name AS perspective_team, opponent AS opponent_team, competition_name, n AS total_matches, first_meeting, last_meeting,
  w AS wins, d AS draws, l AS losses, w * 3 + d AS points, l * 3 + d AS opponent_points, gf AS goals_scored, ga AS goals_conceded, gf - ga AS goal_difference,
  {rdiv('gf', 'n', 2)} AS avg_goals_scored, {rdiv('ga', 'n', 2)} AS avg_goals_conceded, {units('xg')} AS xg_total, {units('xga')} AS xga_total,
  {units('xg - xga')} AS xg_difference, {rdiv('w * 100', 'n', 1)} AS win_percentage, {rdiv('d * 100', 'n', 1)} AS draw_percentage,
  {rdiv('l * 100', 'n', 1)} AS loss_percentage, hw AS team_1_home_wins, aw AS team_1_away_wins,
  CASE WHEN w - l >= 3 THEN 'Dominant' WHEN w > l THEN 'Slight Edge' WHEN w = l THEN 'Even' WHEN l - w >= 3 THEN 'Inferior' ELSE 'Slight Disadvantage' END AS h2h_dominance
FROM (SELECT team_name, opponent, competition_name, count(*) AS n, min(match_date) AS first_meeting, max(match_date) AS last_meeting,
    count(*) FILTER (gf > ga) AS w, count(*) FILTER (gf = ga) AS d, count(*) FILTER (gf < ga) AS l, CAST(sum(gf) AS BIGINT) AS gf, CAST(sum(ga) AS BIGINT) AS ga,
    CAST(sum(xg) AS BIGINT) AS xg, CAST(sum(xga) AS BIGINT) AS xga, count(*) FILTER (gf > ga AND venue = 'HOME') AS hw, count(*) FILTER (gf > ga AND venue = 'AWAY') AS aw
  FROM x_sides GROUP BY ALL)"""

FORM = f"""
SELECT {sk('team_name', 'competition_name')} AS form_key, team_name, competition_name, form_string, n AS matches_in_form, pts AS form_points,
  {rdiv('pts', 'n', 2)} AS form_ppg, w AS form_wins, d AS form_draws, l AS form_losses, gf AS form_goals_scored, ga AS form_goals_conceded, gf - ga AS form_goal_diff,
  {rdiv('gf', 'n', 2)} AS form_avg_goals_scored, {rdiv('ga', 'n', 2)} AS form_avg_goals_conceded, {units('xg')} AS form_xg, {units('xga')} AS form_xga,
  {units('xg - xga')} AS form_xg_diff, cs AS form_clean_sheets, fts AS form_failed_to_score, a AS form_period_start, b AS form_period_end,
  CASE WHEN pts > 12 THEN '🔥 Excellent' WHEN pts > 9 THEN '✅ Good' WHEN pts > 6 THEN '➡️ Average' WHEN pts > 3 THEN '⚠️ Poor' ELSE '❌ Very Poor' END AS form_rating,
  CASE WHEN w > 3 THEN 'Hot Streak' WHEN l > 3 THEN 'Cold Streak' WHEN d > 2 THEN 'Drawing Habit' ELSE 'Mixed' END AS form_trend
FROM (SELECT team_name, competition_name, string_agg(res, '' ORDER BY rn) AS form_string, count(*) AS n, CAST(sum(3 * w + d) AS BIGINT) AS pts,
    CAST(sum(w) AS BIGINT) AS w, CAST(sum(d) AS BIGINT) AS d, CAST(sum(1 - w - d) AS BIGINT) AS l, CAST(sum(gf) AS BIGINT) AS gf, CAST(sum(ga) AS BIGINT) AS ga,
    CAST(sum(xg) AS BIGINT) AS xg, CAST(sum(xga) AS BIGINT) AS xga, count(*) FILTER (ga = 0) AS cs, count(*) FILTER (gf = 0) AS fts, min(match_date) AS a, max(match_date) AS b
  FROM (SELECT *, CAST(gf > ga AS INTEGER) AS w, CAST(gf = ga AS INTEGER) AS d, CASE WHEN gf > ga THEN 'W' WHEN gf = ga THEN 'D' ELSE 'L' END AS res,
      row_number() OVER (PARTITION BY team_name, competition_name ORDER BY match_date DESC, match_key DESC) AS rn FROM x_sides)
  WHERE rn <= 5 GROUP BY ALL)"""

WHO = "player_season_key, player_name, team_name, nationality, position, position_category, age, competition_name, competition_code, season"


def _ranking(order: str) -> str:
    o = f"ORDER BY {order}, player_season_key"
    return (f"CAST(row_number() OVER (PARTITION BY competition_name {o}) AS BIGINT) AS rank_in_competition, "
            f"CAST(row_number() OVER ({o}) AS BIGINT) AS overall_rank")


SCORERS = f"""
SELECT *, CASE WHEN rank_in_competition = 1 THEN '🥇 Leader' WHEN rank_in_competition < 4 THEN '🥈 Contender' WHEN rank_in_competition < 6 THEN '🥉 In Race' ELSE 'Chasing' END AS golden_boot_status
FROM (SELECT {WHO}, matches_played, starts, minutes, nineties, goals, non_penalty_goals, penalty_goals, goals_per90, xg, goals_minus_xg, shots, shots_on_target,
    shot_conversion_pct, shots_per_goal, assists, goal_contributions, {rdiv('minutes', 'goals', 0)} AS minutes_per_goal, {_ranking('goals DESC, assists DESC, minutes')}
  FROM g_perf WHERE goals > 0)"""

ASSISTERS = f"""
SELECT *, CASE WHEN rank_in_competition = 1 THEN '🎯 Top Playmaker' WHEN rank_in_competition < 4 THEN 'Elite Creator' WHEN rank_in_competition < 11 THEN 'Key Player' ELSE 'Contributor' END AS playmaker_status
FROM (SELECT {WHO}, matches_played, starts, minutes, nineties, assists, assists_per90, xa, assists_minus_xa, key_passes, key_passes_per90, passes_into_final_third,
    passes_into_penalty_area, progressive_passes, progressive_passes_per90, sca, sca_per90, gca, gca_per90, goals, goal_contributions,
    {rdiv('minutes', 'assists', 0)} AS minutes_per_assist, {rdiv('(key_passes + passes_into_penalty_area) * 100', cents('nineties'), 2)} AS chance_creation_per90,
    {_ranking('assists DESC, key_passes DESC, minutes')}
  FROM g_perf WHERE assists > 0 OR key_passes > 9)"""

_g, _a = "(goals * 100 - xg_c)", "(assists * 100 - xa_c)"


def _rank(name: str, by: str) -> str:
    return f"CAST(row_number() OVER (PARTITION BY competition_name ORDER BY {by} DESC, player_season_key) AS BIGINT) AS {name}"


PLAYER_XG = f"""
SELECT {WHO}, matches_played, minutes, nineties, goals, xg, npxg, goals_minus_xg, assists, xa, assists_minus_xa, goal_contributions, xg_xa, total_overperformance,
  goals_per90, xg_per90, assists_per90, xa_per90, goal_contributions_per90, xg_xa_per90, {rdiv(_g, cents('nineties'), 2)} AS goals_over_xg_per90,
  {rdiv(_a, cents('nineties'), 2)} AS assists_over_xa_per90, shots, shots_on_target, shot_conversion_pct, {rdiv('xg_c', '(shots * 100)', 3)} AS xg_per_shot,
  {rdiv('goals * 100', 'xg_c', 2)} AS goals_per_xg,
  CASE WHEN {_g} >= 500 THEN 'Elite Finisher' WHEN {_g} >= 200 THEN 'Clinical' WHEN {_g} >= 0 THEN 'On Par' WHEN {_g} >= -200 THEN 'Slightly Wasteful' ELSE 'Underperforming' END AS finishing_category,
  CASE WHEN {_a} >= 300 THEN 'Elite Creator' WHEN {_a} >= 100 THEN 'Quality Provider' WHEN {_a} >= 0 THEN 'On Par' ELSE 'Underperforming' END AS creative_category,
  {rdiv(f'50 * ({_g} * xa_c + {_a} * xg_c)', '(xg_c * xa_c)', 1)} AS skill_luck_index,
  {_rank('finishing_rank', 'goals_minus_xg')}, {_rank('creating_rank', 'assists_minus_xa')}, {_rank('overall_overperformance_rank', 'total_overperformance')}
FROM g_perf WHERE minutes >= 450 AND (xg_c > 0 OR xa_c > 0)"""

_PLAYER_COLS = """player_name, nationality, birth_year, calculated_age AS age, team_name AS current_team, competition_name AS current_competition, position,
  position_category, season AS current_season, matches_played, starts, minutes, nineties, goals, assists, goal_contributions, non_penalty_goals, penalty_goals,
  xg, npxg, xa, xg_xa, goals_minus_xg, assists_minus_xa, goals_per90, assists_per90, xg_per90, xa_per90, shots, shots_on_target, shot_accuracy_pct,
  shot_conversion_pct, passes_completed, pass_completion_pct, key_passes, progressive_passes, tackles, interceptions, defensive_actions, sca, sca_per90, gca,
  gca_per90, yellow_cards, red_cards"""

DIM_PLAYERS = f"""
SELECT {sk('player_name')} AS player_key, {_PLAYER_COLS},
  CASE position_category
    WHEN 'Forward' THEN CASE WHEN goals_per90 >= 0.5 THEN 'Elite Striker' WHEN goals_per90 >= 0.3 THEN 'Goal Scorer' ELSE 'Forward' END
    WHEN 'Midfielder' THEN CASE WHEN assists_per90 >= 0.3 THEN 'Playmaker' WHEN goals_per90 >= 0.2 THEN 'Box-to-Box' ELSE 'Midfielder' END
    WHEN 'Defender' THEN CASE WHEN defensive_actions > 4 THEN 'Ball Winner' ELSE 'Defender' END
    ELSE position_category END AS player_type,
  CASE WHEN minutes < 450 THEN 'Insufficient Data' WHEN {_g} >= 300 THEN 'Elite Finisher' WHEN {_g} > 0 THEN 'Good Finisher' WHEN {_g} < -300 THEN 'Poor Finisher'
    ELSE 'Below Average Finisher' END AS finishing_quality
FROM s_players"""

PLAYER_FORM = f"""
SELECT player_season_key, player_name, team_name, competition_name, position_category, nationality, calculated_age AS age, matches_played, minutes, goals, assists,
  goal_contributions, xg, xa, goals_minus_xg, assists_minus_xa, goals_per90, assists_per90, xg_per90, xa_per90, dg AS recent_goals, da AS recent_assists,
  dm AS recent_minutes, {units('dxg')} AS recent_xg, {units('dxa')} AS recent_xa, CASE WHEN dm >= 90 THEN {rdiv('dg * 90', 'dm', 2)} END AS recent_goals_per90,
  CASE WHEN dm >= 90 THEN {rdiv('da * 90', 'dm', 2)} END AS recent_assists_per90,
  CASE WHEN greatest(dg, da) > 2 THEN '🔥 Hot' WHEN dg > 0 OR da > 1 THEN '✅ Good Form' WHEN dm < 90 THEN '🪑 Limited Minutes'
    WHEN dg = 0 AND da = 0 AND dm > 180 THEN '📉 Cold' ELSE '➡️ Steady' END AS current_form,
  dg > 1 AND dm < 271 AS is_on_hot_streak, CAST(date_diff('day', p_from, valid_from) AS INTEGER) AS days_since_update, valid_from AS last_updated
FROM (SELECT n.*, n.goals - coalesce(o.goals, 0) AS dg, n.assists - coalesce(o.assists, 0) AS da, n.minutes - coalesce(o.minutes, 0) AS dm,
    n.xg_c - coalesce(o.xg_c, 0) AS dxg, n.xa_c - coalesce(o.xa_c, 0) AS dxa, o.valid_from AS p_from
  FROM p_hist n LEFT JOIN (SELECT * FROM p_hist WHERE NOT is_current) o USING (player_season_key) WHERE n.is_current AND n.matches_played >= 3)"""

STANDING_HISTORY = f"""
SELECT {sk('team_name', 'competition_name', 'season', 'valid_from')} AS history_key, team_name, competition_name, competition_code, season, snapshot_number,
  total_snapshots, valid_from AS snapshot_date, valid_to IS NULL AS is_current, position, pp AS previous_position, coalesce(pp - position, 0) AS position_change,
  points, ppts AS previous_points, points - coalesce(ppts, 0) AS points_gained, matches_played, matches_played - coalesce(pm, 0) AS matches_since_last,
  {rdiv('points - coalesce(ppts, 0)', 'matches_played - coalesce(pm, 0)', 2)} AS period_ppg, wins, draws, losses, goals_for, goals_against, goal_difference, xg, xga,
  xg_difference, CASE WHEN pp > position THEN '📈 Up ' || (pp - position) WHEN pp < position THEN '📉 Down ' || (position - pp) ELSE '➡️ Same' END AS position_movement,
  CASE WHEN position < 5 THEN 'Champions League Zone' WHEN position < 7 THEN 'Europa League Zone' WHEN position = 7 THEN 'Conference League Zone'
    WHEN position > 17 THEN 'Relegation Zone' WHEN position > 14 THEN 'Relegation Battle' ELSE 'Mid-table' END AS table_zone
FROM (SELECT *, lag(position) OVER w AS pp, lag(points) OVER w AS ppts, lag(matches_played) OVER w AS pm, CAST(row_number() OVER w AS BIGINT) AS snapshot_number,
    count(*) OVER (PARTITION BY team_name, competition_name, season) AS total_snapshots
  FROM st_hist WINDOW w AS (PARTITION BY team_name, competition_name, season ORDER BY valid_from))"""


def results(spark, sf):
    return gold.match_results(fx.silver_matches(spark, sf), fx.silver_teams(spark, sf))


def teams(spark, sf):
    return gold.dim_teams(fx.silver_teams(spark, sf), results(spark, sf))


def xg_results(spark, sf):
    return gold.matches_with_xg(fx.silver_matches(spark, sf), fx.silver_xg_matches(spark, sf))


def performance(spark, sf):
    return gold.player_performance(fx.silver_players(spark, sf))


@query("g1_fct_match_results", sql("SELECT * FROM g_results"))
def g1(spark, sf):
    return results(spark, sf)


@query("g2_fct_matches_with_xg", sql("SELECT * FROM g_xg"))
def g2(spark, sf):
    return xg_results(spark, sf)


@query("g3_fct_player_performance", sql("SELECT * EXCLUDE (xg_c, xa_c) FROM g_perf"))
def g3(spark, sf):
    return performance(spark, sf)


@query("g4_dim_teams", sql("SELECT * FROM g_teams"))
def g4(spark, sf):
    return teams(spark, sf)


@query("g5_dim_players", sql(DIM_PLAYERS))
def g5(spark, sf):
    return gold.dim_players(fx.silver_players(spark, sf))


@query("g6_competition_standings", sql(STANDINGS))
def g6(spark, sf):
    return gold.competition_standings(teams(spark, sf))


@query("g7_matchday_summary", sql(MATCHDAY))
def g7(spark, sf):
    return gold.matchday_summary(results(spark, sf))


@query("g8_team_xg_analysis", sql(TEAM_XG))
def g8(spark, sf):
    return gold.team_xg_analysis(xg_results(spark, sf))


@query("g9_top_scorers", sql(SCORERS))
def g9(spark, sf):
    return gold.top_scorers(performance(spark, sf))


@query("g10_top_assisters", sql(ASSISTERS))
def g10(spark, sf):
    return gold.top_assisters(performance(spark, sf))


@query("g11_player_xg_analysis", sql(PLAYER_XG))
def g11(spark, sf):
    return gold.player_xg_analysis(performance(spark, sf))


@query("g12_head_to_head", sql(H2H))
def g12(spark, sf):
    return gold.head_to_head(fx.silver_xg_matches(spark, sf))


@query("g13_team_form", sql(FORM))
def g13(spark, sf):
    return gold.team_form(fx.silver_xg_matches(spark, sf))


@query("g14_player_form", sql(PLAYER_FORM))
def g14(spark, sf):
    return gold.player_form(fx.player_history(spark, sf))


@query("g15_standing_history", sql(STANDING_HISTORY))
def g15(spark, sf):
    return gold.standing_history(fx.standings_history(spark, sf))


# --- variants over the payload tables -------------------------------------------------
def basic_results(spark, sf):
    raw = fx.fx_matches(spark, sf).withColumn("match_date", F.date_format("played_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return gold.match_results_basic(silver.payload_matches(raw))


@query("g1_fct_match_results_basic", sql("""
SELECT match_id, match_date, played_at AS match_datetime, competition_code, competition_name, matchday, home_team_id, home_team_name, away_team_id, away_team_name,
  home_score AS home_goals, away_score AS away_goals, home_score + away_score AS total_goals, home_score - away_score AS goal_difference,
  CASE sign(home_score - away_score) WHEN 1 THEN 'HOME' WHEN -1 THEN 'AWAY' ELSE 'DRAW' END AS match_result,
  CASE sign(home_score - away_score) WHEN 1 THEN 3 WHEN 0 THEN 1 ELSE 0 END AS home_points, CASE sign(home_score - away_score) WHEN -1 THEN 3 WHEN 0 THEN 1 ELSE 0 END AS away_points,
  home_score + away_score > 2 AS is_high_scoring, away_score = 0 AS home_clean_sheet, home_score = 0 AS away_clean_sheet FROM fx WHERE status = 'FINISHED'"""))
def g1_basic(spark, sf):
    return basic_results(spark, sf)


_LAST = "(SELECT *, row_number() OVER (PARTITION BY team_id, competition_code ORDER BY taken DESC) AS rn FROM st_base)"


@query("g4_dim_teams_basic", sql(f"""
SELECT t.team_id, t.team_name, team_code, short_name, ' ' || stadium_name AS venue, founded_year AS founded, club_colors, l.code AS competition_code, l.name AS competition_name,
  position AS current_position, pts AS current_points, w AS wins, d AS draws, p - w - d AS losses, gf AS goals_for, ga AS goals_against, {rdiv('pts', 'p', 2)} AS points_per_game,
  CASE WHEN position < 5 THEN 'Champions League' WHEN position < 7 THEN 'Europa League' WHEN position = 7 THEN 'Conference League' WHEN position > 15 THEN 'Relegation'
    WHEN position IS NOT NULL THEN 'Mid-table' END AS table_zone
FROM s_teams t CROSS JOIN (VALUES ('DED', 'Eredivisie'), ('PL', 'Premier League')) l(code, name)
LEFT JOIN {_LAST} s ON s.team_id = t.team_id AND s.competition_code = l.code AND rn = 1"""))
def g4_basic(spark, sf):
    teams_ = fx.bronze_teams(spark, sf).filter(F.col("ingest_timestamp") == fx.LOADED)
    rows = teams_.withColumns({"team_name": F.trim("team_name"), "tla": F.upper("tla")}).drop("competition_name")
    leagues = F.explode(F.array(*[F.struct(F.lit(code).alias("competition_code"), F.lit(name).alias("competition_name")) for code, name in (("DED", "Eredivisie"), ("PL", "Premier League"))]))
    rows = silver.payload_teams(rows.withColumn("l", leagues).select("*", "l.*"))
    latest = windows.dedup_latest(fx.bronze_standings(spark, sf), ["team_id", "competition_code"], ["ingest_timestamp"])
    return gold.dim_teams_basic(rows, silver.payload_standings(latest))


@query("g12_head_to_head_basic", sql(f"""
SELECT team_name AS team, opponent, competition_name, n AS matches_played, w AS wins, d AS draws, l AS losses, gf AS goals_for, ga AS goals_against, w * 3 + d AS total_points,
  gf - ga AS goal_difference, {rdiv('w * 100', 'n', 1)} AS win_percentage, CASE WHEN w - l >= 3 THEN 'Dominant' WHEN w > l THEN 'Edge' WHEN w = l THEN 'Even' ELSE 'Underdog' END AS dominance
FROM (SELECT team_name, opponent, competition_name, count(*) AS n, count(*) FILTER (gf > ga) AS w, count(*) FILTER (gf = ga) AS d, count(*) FILTER (gf < ga) AS l,
    CAST(sum(gf) AS BIGINT) AS gf, CAST(sum(ga) AS BIGINT) AS ga FROM r_sides GROUP BY ALL)"""))
def g12_basic(spark, sf):
    return gold.head_to_head_basic(basic_results(spark, sf))
