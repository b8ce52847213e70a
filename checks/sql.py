"""SQL building blocks for the independent check engine (DuckDB).

``sql(body)`` prefixes the common table expressions a query mentions.  Quotients are
rounded half up in integer arithmetic, so both engines agree on ties.
"""

from __future__ import annotations

import re

from checks.fixtures import LEAGUES, LOADED, POSITIONS, RELOADED

NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def rdiv(n: str, d: str, s: int) -> str:
    """round_half_up(n / d, s) for integers n, d >= 0 denominators; NULL for d = 0."""
    num, den = f"CAST({n} AS HUGEINT)", f"CAST(nullif({d}, 0) AS HUGEINT)"
    return f"(CAST(sign({num}) * ((2 * abs({num}) * {10**s} + {den}) // (2 * {den})) AS DOUBLE) / {10**s})"


def cents(x: str) -> str:
    return f"CAST(round(({x}) * 100) AS BIGINT)"


def units(x: str, scale: int = 100) -> str:
    return f"(CAST({x} AS DOUBLE) / {scale})"


def sk(*cols: str) -> str:
    return "md5(concat_ws('-', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{NULL_TOKEN}')" for c in cols) + "))"


def rh(*cols: str) -> str:
    return "md5(concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols) + "))"


def cases(pairs, rest: str | None = None) -> str:
    return "CASE " + " ".join(f"WHEN {p} THEN {v}" for p, v in pairs) + (f" ELSE {rest}" if rest else "") + " END"


def lit(v: str) -> str:
    return "'" + v + "'"


def league(field: int, quote: bool) -> str:
    return cases([(f"o_orderpriority = '{r[0]}'", lit(r[field]) if quote else r[field]) for r in LEAGUES])


CODE = cases([(f"competition_name = '{n}'", lit(code)) for _, _, code, n in LEAGUES[:4]])


def players_bronze(lines_where: str, at: str) -> str:
    rate = lambda n: rdiv(f"({n}) * 90", "min", 2)
    rate_c = lambda n: rdiv(f"({n}) * 90", "min * 100", 2)
    return f"""
  SELECT CASE o_custkey % 5 WHEN 0 THEN 'Eredivisie' WHEN 1 THEN 'Premier League' WHEN 2 THEN 'La Liga' WHEN 3 THEN 'Serie A' ELSE 'Other League' END AS competition_name,
    CAST(season AS VARCHAR) AS season, c_name AS player_name, 'n' || c_nationkey AS nationality,
    {cases([(f"c_mktsegment = '{k}'", lit(v)) for k, v in POSITIONS.items()])} AS position,
    'T' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || ' ' || n_name AS team_name, '25-100' AS age,
    CASE WHEN o_custkey % 10 <> 9 THEN CAST(1980 + o_custkey % 25 AS INTEGER) END AS birth_year,
    mp AS matches_played, CAST(greatest(mp - o_custkey % 3, 0) AS INTEGER) AS starts, min AS minutes,
    CASE WHEN o_custkey % 2 = 1 THEN {rdiv('min', '90', 2)} END AS nineties_given,
    {rdiv('min', '90', 2)} AS nineties,
    g AS goals, a AS assists, g - g % 3 AS non_penalty_goals, g % 3 AS penalty_goals, g % 3 + 1 AS penalty_attempts,
    min % 7 AS yellow_cards, min % 2 AS red_cards, disc * 10 AS xg_c, disc * 8 AS npxg_c, tax * 10 AS xa_c, (disc + tax) * 10 AS xg_xa_c,
    {rate('g')} AS goals_per90, {rate('a')} AS assists_per90, {rate_c('disc * 10')} AS xg_per90, {rate_c('tax * 10')} AS xa_per90,
    sh AS shots, sh // 2 AS shots_on_target, {rdiv('(sh // 2) * 100', 'sh', 1)} AS shot_accuracy_pct, {rate('sh')} AS shots_per90,
    min * 3 % 400 AS passes_completed, min * 3 % 400 + min % 50 AS passes_attempted,
    {rdiv('(min * 3 % 400) * 100', '(min * 3 % 400 + min % 50)', 1)} AS pass_completion_pct,
    min % 17 AS key_passes, min % 13 AS passes_into_final_third, min % 11 AS passes_into_penalty_area, min % 19 AS progressive_passes,
    min % 23 AS tackles, (min % 23) // 2 AS tackles_won, min % 29 AS interceptions, min % 5 AS blocks, min % 31 AS clearances,
    min % 37 AS sca, {rate('min % 37')} AS sca_per90, min % 3 AS gca, {rate('min % 3')} AS gca_per90, TIMESTAMP '{at}' AS loaded
  FROM (SELECT o_custkey, c_name, CAST(year(o_orderdate) AS INTEGER) AS season, c_mktsegment, c_nationkey,
      CAST(count(DISTINCT o_orderkey) AS INTEGER) AS mp, CAST(sum(l_quantity) AS INTEGER) AS min,
      CAST(count(*) FILTER (l_returnflag = 'R') AS INTEGER) AS g, CAST(count(*) FILTER (l_returnflag = 'A') AS INTEGER) AS a,
      CAST(count(*) AS INTEGER) AS sh, CAST(sum({cents('l_discount')}) AS BIGINT) AS disc, CAST(sum({cents('l_tax')}) AS BIGINT) AS tax
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey {lines_where}
    GROUP BY ALL) JOIN nation ON n_nationkey = c_nationkey"""


def players_silver(src: str) -> str:
    return f"""
  SELECT {sk('player_name', 'team_name', 'competition_name', 'season')} AS player_season_key, player_name, team_name, nationality, position,
    {cases([("regexp_matches(upper(position), 'GK')", "'Goalkeeper'"), ("regexp_matches(upper(position), 'DF|CB|FB|WB')", "'Defender'"),
            ("regexp_matches(upper(position), 'MF|DM|CM|AM')", "'Midfielder'"), ("regexp_matches(upper(position), 'FW|ST|CF|LW|RW')", "'Forward'")], "'Unknown'")} AS position_category,
    age, birth_year, 2025 - birth_year AS calculated_age, competition_name, {CODE} AS competition_code, season,
    matches_played, starts, minutes, nineties, matches_played - starts AS sub_appearances, goals, assists, goals + assists AS goal_contributions,
    non_penalty_goals, penalty_goals, penalty_attempts, yellow_cards, red_cards,
    xg_c, npxg_c, xa_c, {units('xg_c')} AS xg, {units('npxg_c')} AS npxg, {units('xa_c')} AS xa, {units('xg_xa_c')} AS xg_xa,
    {units('goals * 100 - xg_c')} AS goals_minus_xg, {units('assists * 100 - xa_c')} AS assists_minus_xa,
    goals_per90, assists_per90, xg_per90, xa_per90, shots, shots_on_target, shot_accuracy_pct, shots_per90,
    {rdiv('goals * 100', 'shots', 1)} AS shot_conversion_pct, passes_completed, passes_attempted, pass_completion_pct,
    key_passes, passes_into_final_third, passes_into_penalty_area, progressive_passes, tackles, tackles_won, interceptions, blocks, clearances,
    tackles + interceptions AS defensive_actions, sca, sca_per90, gca, gca_per90, 'fbref' AS data_source, loaded AS ingested_at,
    {rh('matches_played', 'minutes', 'goals', 'assists', units('xg_c'), units('xa_c'), 'yellow_cards', 'red_cards', 'team_name')} AS record_hash
  FROM {src}"""


CTES: dict[str, str] = {
    "li": f"""
  SELECT l_orderkey, min(l_suppkey) AS suppkey, CAST(max(l_quantity) AS INTEGER) AS q, min(l_linenumber) AS ln,
    max({cents('l_discount')}) AS disc, max({cents('l_tax')}) AS tax FROM lineitem GROUP BY l_orderkey""",
    "fx": f"""
  SELECT o_orderkey AS match_id, o_orderdate AS played_at, CAST(o_orderdate AS DATE) AS match_date,
    {league(1, False)} AS competition_id, {league(2, True)} AS competition_code, {league(3, True)} AS competition_name,
    CAST(year(o_orderdate) AS INTEGER) AS season, CAST(month(o_orderdate) AS INTEGER) AS matchday,
    CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'IN_PLAY' WHEN 'P' THEN 'TIMED' END AS status,
    CAST(h.n_nationkey AS BIGINT) AS home_team_id, CAST(a.n_nationkey AS BIGINT) AS away_team_id,
    'T' || lpad(CAST(h.n_nationkey AS VARCHAR), 2, '0') || ' ' || h.n_name AS home_team_name,
    'T' || lpad(CAST(a.n_nationkey AS VARCHAR), 2, '0') || ' ' || a.n_name AS away_team_name,
    CASE WHEN o_orderstatus = 'F' THEN q % 5 END AS home_score, CASE WHEN o_orderstatus = 'F' THEN (q + ln) % 4 END AS away_score,
    disc * 20 AS home_xg_c, tax * 20 AS away_xg_c
  FROM orders JOIN li ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation h ON h.n_nationkey = c_nationkey
    JOIN supplier ON s_suppkey = suppkey JOIN nation a ON a.n_nationkey = s_nationkey WHERE h.n_nationkey <> a.n_nationkey""",
    "b_matches": f"""
  SELECT match_id, strftime(played_at, '%Y-%m-%dT%H:%M:%SZ') AS utc_date, status, matchday, ' regular_season ' AS stage,
    strftime(played_at, '%Y-%m-%dT%H:%M:%SZ') AS last_updated, CAST(competition_id AS BIGINT) AS competition_id, competition_name, competition_code,
    home_team_id, home_team_name, lower(substr(home_team_name, 1, 3)) AS home_team_short_name,
    away_team_id, away_team_name, lower(substr(away_team_name, 1, 3)) AS away_team_short_name,
    home_score AS home_score_fulltime, away_score AS away_score_fulltime, home_score // 2 AS home_score_halftime, away_score // 2 AS away_score_halftime,
    CASE WHEN home_score > away_score THEN 'HOME_TEAM' WHEN home_score < away_score THEN 'AWAY_TEAM' WHEN home_score = away_score THEN 'DRAW' END AS winner,
    '{LOADED}' AS ingest_timestamp FROM fx""",
    "s_matches": """
  SELECT match_id, played_at AS match_datetime, match_date, CAST(year(played_at) AS INTEGER) AS match_year, CAST(month(played_at) AS INTEGER) AS match_month,
    CAST(dayofweek(played_at) + 1 AS INTEGER) AS day_of_week, fx.status AS match_status, fx.matchday AS matchday_number, 'REGULAR_SEASON' AS stage,
    b.competition_id, fx.competition_name, fx.competition_code, fx.home_team_id, fx.home_team_name, upper(home_team_short_name) AS home_team_short_name,
    fx.away_team_id, fx.away_team_name, upper(away_team_short_name) AS away_team_short_name,
    coalesce(home_score, 0) AS home_goals, coalesce(away_score, 0) AS away_goals,
    coalesce(home_score, 0) // 2 AS home_goals_halftime, coalesce(away_score, 0) // 2 AS away_goals_halftime,
    coalesce(home_score, 0) + coalesce(away_score, 0) AS total_goals,
    CASE sign(home_score - away_score) WHEN 1 THEN 'HOME' WHEN -1 THEN 'AWAY' WHEN 0 THEN 'DRAW' END AS match_result,
    fx.status = 'FINISHED' AS is_finished, coalesce(home_score = away_score, FALSE) AS is_draw,
    played_at AS source_updated_at, CAST(ingest_timestamp AS TIMESTAMP) AS ingested_at
  FROM fx JOIN b_matches b USING (match_id)""",
    "b_xg": f"""
  SELECT match_id, competition_name, CAST(season AS VARCHAR) AS season, CAST(matchday AS VARCHAR) AS matchweek,
    strftime(match_date, '%Y-%m-%d') AS match_date, '20:00' AS match_time,
    upper(home_team_name) || ' FC' AS home_team_name, lower(away_team_name) || ' fc' AS away_team_name,
    home_score, away_score, home_xg_c, away_xg_c,
    CAST((match_id * 37 % 60000) // 1000 AS VARCHAR) || ',' || lpad(CAST(match_id * 37 % 60000 % 1000 AS VARCHAR), 3, '0') AS attendance,
    'Stadium ' || home_team_id AS venue, 'Referee ' || match_id % 50 AS referee FROM fx WHERE match_id % 5 <> 0""",
    "s_xg": """
  SELECT * EXCLUDE (copy) FROM (SELECT *, row_number() OVER (PARTITION BY match_key ORDER BY attendance DESC, referee DESC) AS copy FROM s_xg_rows) WHERE copy = 1""",
    "s_xg_rows": f"""
  SELECT {sk('competition_name', 'match_date', 'home_team_name', 'away_team_name')} AS match_key, match_date AS match_date_str,
    CAST(match_date AS DATE) AS match_date, match_time, matchweek, season, competition_name, {CODE} AS competition_code, home_team_name, away_team_name,
    home_score AS home_goals, away_score AS away_goals, home_xg_c, away_xg_c, {units('home_xg_c')} AS home_xg, {units('away_xg_c')} AS away_xg,
    {units('home_xg_c + away_xg_c')} AS total_xg, venue, referee, attendance AS attendance_str,
    CAST(replace(attendance, ',', '') AS INTEGER) AS attendance,
    CASE sign(home_score - away_score) WHEN 1 THEN 'HOME' WHEN -1 THEN 'AWAY' WHEN 0 THEN 'DRAW' END AS match_result,
    {units('home_score * 100 - home_xg_c')} AS home_xg_diff, {units('away_score * 100 - away_xg_c')} AS away_xg_diff,
    home_score IS NOT NULL AND away_score IS NOT NULL AS is_finished, 'fbref' AS data_source, TIMESTAMP '{LOADED}' AS ingested_at
  FROM b_xg""",
    "s_teams": f"""
  SELECT CAST(n_nationkey AS BIGINT) AS team_id, 'T' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') || ' ' || n_name AS team_name, n_name AS short_name,
    'T' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS team_code, 'crest/' || n_nationkey AS logo_url, 'Street ' || n_nationkey AS address,
    'www.' || n_nationkey AS website, n_nationkey + 1900 AS founded_year, 'Red / White' AS club_colors, 'Stadium ' || n_nationkey AS stadium_name,
    CAST(n_regionkey AS BIGINT) AS competition_id, r_name AS competition_name, TIMESTAMP '{LOADED}' AS ingested_at
  FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "b_players": players_bronze("", RELOADED),
    "b_players_one": players_bronze("", LOADED),
    "b_players_first": players_bronze("WHERE l_linenumber <= 3", LOADED),
    "s_players": players_silver("b_players_one"),
    "s_players_first": players_silver("b_players_first"),
    "s_players_second": players_silver("b_players"),
    "p_hist": f"""
  SELECT n.*, TIMESTAMP '{RELOADED}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
  FROM s_players_second n LEFT JOIN s_players_first o USING (player_season_key) WHERE o.record_hash IS NULL OR o.record_hash <> n.record_hash
  UNION ALL
  SELECT o.*, TIMESTAMP '{LOADED}', CASE WHEN n.record_hash <> o.record_hash THEN TIMESTAMP '{RELOADED}' END, coalesce(n.record_hash = o.record_hash, TRUE)
  FROM s_players_first o LEFT JOIN s_players_second n USING (player_season_key)""",
    "st_sides": """
  SELECT competition_code, competition_name, season, matchday, home_team_id AS team_id, home_team_name AS team_name,
    home_score AS gf, away_score AS ga, home_xg_c AS xg, away_xg_c AS xga FROM fx WHERE status = 'FINISHED'
  UNION ALL SELECT competition_code, competition_name, season, matchday, away_team_id, away_team_name, away_score, home_score, away_xg_c, home_xg_c
  FROM fx WHERE status = 'FINISHED'""",
    "st_base": """
  SELECT *, w * 3 + d AS pts, gf - ga AS gd, make_date(season, matchday, 1) AS taken,
    CAST(row_number() OVER (PARTITION BY competition_code, season, matchday ORDER BY w * 3 + d DESC, gf - ga DESC, gf DESC, team_id) AS INTEGER) AS position
  FROM (SELECT competition_code, competition_name, season, matchday, team_id, team_name,
      CAST(sum(p) OVER r AS INTEGER) AS p, CAST(sum(w) OVER r AS INTEGER) AS w, CAST(sum(d) OVER r AS INTEGER) AS d,
      CAST(sum(gf) OVER r AS INTEGER) AS gf, CAST(sum(ga) OVER r AS INTEGER) AS ga, CAST(sum(xg) OVER r AS BIGINT) AS xg, CAST(sum(xga) OVER r AS BIGINT) AS xga
    FROM (SELECT competition_code, competition_name, season, matchday, team_id, team_name, count(*) AS p, count(*) FILTER (gf > ga) AS w,
        count(*) FILTER (gf = ga) AS d, sum(gf) AS gf, sum(ga) AS ga, sum(xg) AS xg, sum(xga) AS xga FROM st_sides GROUP BY ALL)
    WINDOW r AS (PARTITION BY team_id, competition_code, season ORDER BY matchday))""",
    "s_st": f"""
  SELECT {sk('competition_name', 'season', 'team_name')} AS standing_key, competition_name, {CODE} AS competition_code, CAST(season AS VARCHAR) AS season,
    position, team_name, p AS matches_played, w AS wins, d AS draws, p - w - d AS losses, gf AS goals_for, ga AS goals_against, gd AS goal_difference,
    pts AS points, xg AS xg_c, xga AS xga_c, {units('xg')} AS xg, {units('xga')} AS xga, {units('xg - xga')} AS xg_difference, {rdiv('pts', 'p', 2)} AS points_per_game,
    {rdiv('gf', 'p', 2)} AS goals_per_game, {rdiv('ga', 'p', 2)} AS goals_conceded_per_game, {units('gf * 100 - xg')} AS goals_vs_xg,
    {units('ga * 100 - xga')} AS goals_conceded_vs_xga, {rdiv('w * 100', 'p', 1)} AS win_percentage, 'fbref' AS data_source,
    CAST(taken AS TIMESTAMP) AS ingested_at FROM st_base""",
    "st_hist": """
  SELECT *, ingested_at AS valid_from, lead(ingested_at) OVER (PARTITION BY standing_key ORDER BY ingested_at) AS valid_to FROM s_st""",
    "scd1": "SELECT o_orderkey AS k, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(12,2)) AS amount FROM orders",
    "scd2": """
  SELECT CASE WHEN k % 10 = 7 THEN k + 1000000000 ELSE k END AS k, CASE WHEN k % 10 = 1 THEN 'X' ELSE status END AS status, amount
  FROM scd1 WHERE k % 10 <> 3""",
    "scd_cmp": f"""
  SELECT coalesce(n.k, o.k) AS k, n.k IS NOT NULL AS in_new, o.k IS NOT NULL AS in_old, n.status AS n_status, o.status AS o_status,
    n.amount AS n_amount, o.amount AS o_amount, {rh('n.status', 'n.amount')} AS nh, {rh('o.status', 'o.amount')} AS oh
  FROM scd2 n FULL JOIN scd1 o ON n.k = o.k""",
    "scd_act": """
  SELECT *, CASE WHEN NOT in_old THEN 'INSERT' WHEN NOT in_new THEN 'DELETE' WHEN nh <> oh THEN 'UPDATE' ELSE 'UNCHANGED' END AS action FROM scd_cmp""",
    "scd_hist": f"""
  SELECT k, n_status AS status, n_amount AS amount, nh AS record_hash, TIMESTAMP '{RELOADED}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current
  FROM scd_act WHERE action IN ('INSERT', 'UPDATE')
  UNION ALL SELECT k, o_status, o_amount, oh, TIMESTAMP '{LOADED}', CASE WHEN action = 'UPDATE' THEN TIMESTAMP '{RELOADED}' END, action <> 'UPDATE'
  FROM scd_act WHERE action <> 'INSERT'""",
    # --- gold ---------------------------------------------------------------------
    "g_results": """
  SELECT m.match_id, m.match_date, m.match_datetime, m.matchday_number, m.competition_code, m.competition_name,
    m.home_team_id, m.home_team_name, h.team_code AS home_team_code, h.stadium_name AS home_stadium, m.away_team_id, m.away_team_name, a.team_code AS away_team_code,
    home_goals, away_goals, total_goals, home_goals_halftime, away_goals_halftime, match_result, is_draw,
    home_goals - home_goals_halftime AS home_goals_second_half, away_goals - away_goals_halftime AS away_goals_second_half,
    CASE match_result WHEN 'HOME' THEN 3 WHEN 'DRAW' THEN 1 ELSE 0 END AS home_points, CASE match_result WHEN 'AWAY' THEN 3 WHEN 'DRAW' THEN 1 ELSE 0 END AS away_points,
    home_goals - away_goals AS home_goal_difference, away_goals - home_goals AS away_goal_difference,
    total_goals > 2 AS is_high_scoring, total_goals = 0 AS is_goalless, least(home_goals, away_goals) > 0 AS both_teams_scored
  FROM s_matches m LEFT JOIN s_teams h ON h.team_id = home_team_id LEFT JOIN s_teams a ON a.team_id = away_team_id WHERE is_finished""",
    "r_sides": """
  SELECT match_id, match_date, competition_code, competition_name, 'HOME' AS venue, home_team_id AS team_id, home_team_name AS team_name, away_team_name AS opponent,
    home_goals AS gf, away_goals AS ga, home_points AS pts FROM g_results
  UNION ALL SELECT match_id, match_date, competition_code, competition_name, 'AWAY', away_team_id, away_team_name, home_team_name, away_goals, home_goals, away_points FROM g_results""",
    "g_teams": f"""
  SELECT t.team_id, t.team_name, t.short_name, t.team_code, t.logo_url, t.stadium_name, t.founded_year, t.club_colors, t.competition_name,
    count(s.venue) AS total_matches_played, CAST(coalesce(sum(pts), 0) AS BIGINT) AS total_points, count(*) FILTER (gf > ga) AS total_wins,
    count(*) FILTER (gf = ga) AS total_draws, count(*) FILTER (gf < ga) AS total_losses,
    CAST(coalesce(sum(gf), 0) AS BIGINT) AS total_goals_scored, CAST(coalesce(sum(ga), 0) AS BIGINT) AS total_goals_conceded,
    CAST(coalesce(sum(gf - ga), 0) AS BIGINT) AS goal_difference,
    {", ".join(f"count(*) FILTER (venue = '{v.upper()}') AS {v}_matches_played, CAST(coalesce(sum(pts) FILTER (venue = '{v.upper()}'), 0) AS BIGINT) AS {v}_points, "
               + ", ".join(f"count(*) FILTER (venue = '{v.upper()}' AND gf {op} ga) AS {v}_{n}" for n, op in (("wins", ">"), ("draws", "="), ("losses", "<")))
               for v in ("home", "away"))},
    {rdiv('sum(gf)', 'count(s.venue)', 2)} AS avg_goals_scored_per_match, {rdiv('sum(ga)', 'count(s.venue)', 2)} AS avg_goals_conceded_per_match,
    {rdiv('sum(pts)', 'count(s.venue)', 2)} AS points_per_game
  FROM s_teams t LEFT JOIN r_sides s ON s.team_id = t.team_id
  GROUP BY t.team_id, t.team_name, t.short_name, t.team_code, t.logo_url, t.stadium_name, t.founded_year, t.club_colors, t.competition_name""",
    "x_sides": """
  SELECT match_key, match_date, competition_code, competition_name, 'HOME' AS venue, home_team_name AS team_name, away_team_name AS opponent,
    home_goals AS gf, away_goals AS ga, home_xg_c AS xg, away_xg_c AS xga FROM s_xg WHERE is_finished
  UNION ALL SELECT match_key, match_date, competition_code, competition_name, 'AWAY', away_team_name, home_team_name, away_goals, home_goals, away_xg_c, home_xg_c
  FROM s_xg WHERE is_finished""",
    "x_join": """
  SELECT a.match_id AS a_id, b.match_key AS b_id, a.*, b.match_date AS b_date, b.competition_code AS b_code, b.competition_name AS b_comp,
    b.home_team_name AS b_home, b.away_team_name AS b_away, b.home_goals AS b_hg, b.away_goals AS b_ag, b.match_result AS b_result, b.is_finished AS b_fin,
    b.home_xg_c, b.away_xg_c, b.home_xg, b.away_xg, b.total_xg, b.home_xg_diff, b.away_xg_diff, b.venue, b.attendance, b.referee
  FROM s_matches a FULL JOIN s_xg b ON a.competition_code = b.competition_code AND a.match_date = b.match_date
    AND (contains(lower(a.home_team_name), lower(b.home_team_name[1:5])) OR contains(lower(b.home_team_name), lower(a.home_team_name[1:5])))""",
    "g_xg": """
  SELECT coalesce(CAST(a_id AS VARCHAR), b_id) AS match_id, coalesce(match_date, b_date) AS match_date, match_datetime, matchday_number,
    coalesce(competition_code, b_code) AS competition_code, coalesce(competition_name, b_comp) AS competition_name,
    home_team_id, coalesce(home_team_name, b_home) AS home_team_name, away_team_id, coalesce(away_team_name, b_away) AS away_team_name,
    coalesce(home_goals, b_hg) AS home_goals, coalesce(away_goals, b_ag) AS away_goals, coalesce(total_goals, b_hg + b_ag) AS total_goals,
    home_xg, away_xg, total_xg, home_xg_diff, away_xg_diff, coalesce(match_result, b_result) AS match_result, coalesce(is_draw, b_result = 'DRAW') AS is_draw,
    coalesce(is_finished, b_fin) AS is_finished, venue, attendance, referee,
    CASE coalesce(match_result, b_result) WHEN 'HOME' THEN 3 WHEN 'DRAW' THEN 1 ELSE 0 END AS home_points,
    CASE coalesce(match_result, b_result) WHEN 'AWAY' THEN 3 WHEN 'DRAW' THEN 1 ELSE 0 END AS away_points,
    a_id IS NOT NULL AS has_api_data, b_id IS NOT NULL AS has_fbref_data FROM x_join WHERE coalesce(is_finished, b_fin)""",
}
_n90 = cents("nineties")
_cards = "(yellow_cards + red_cards)"
CTES["g_perf"] = f"""
  SELECT player_season_key, {sk('player_name')} AS player_key, player_name, team_name, position, position_category, nationality, calculated_age AS age,
    competition_name, competition_code, season, matches_played, starts, minutes, nineties, sub_appearances, {rdiv('minutes', 'starts', 0)} AS minutes_per_start,
    goals, assists, goal_contributions, non_penalty_goals, penalty_goals, xg, npxg, xa, xg_xa, goals_minus_xg, assists_minus_xa,
    {units('goals * 100 - xg_c + assists * 100 - xa_c')} AS total_overperformance, goals_per90, assists_per90,
    {rdiv('(goals + assists) * 100', _n90, 2)} AS goal_contributions_per90, xg_per90, xa_per90, {rdiv('xg_c + xa_c', _n90, 2)} AS xg_xa_per90,
    shots, shots_on_target, shot_accuracy_pct, shot_conversion_pct, shots_per90, {rdiv('shots', 'goals', 1)} AS shots_per_goal,
    passes_completed, passes_attempted, pass_completion_pct, key_passes, passes_into_final_third, passes_into_penalty_area, progressive_passes,
    {", ".join(rdiv(f"{n} * 100", _n90, 2) + f" AS {n}_per90" for n in ("key_passes", "progressive_passes", "tackles", "interceptions", "defensive_actions"))},
    tackles, tackles_won, interceptions, blocks, clearances, defensive_actions, {rdiv('tackles_won * 100', 'tackles', 1)} AS tackle_success_pct,
    sca, sca_per90, gca, gca_per90, yellow_cards, red_cards, {_cards} AS total_cards, {rdiv(f'{_cards} * 100', _n90, 2)} AS cards_per90,
    CASE WHEN nineties > 0 THEN CASE WHEN {_cards} * 1000 > 3 * {_n90} THEN 'High' WHEN {_cards} * 10000 > 15 * {_n90} THEN 'Medium' ELSE 'Low' END ELSE 'Unknown' END AS discipline_risk,
    CASE position_category
      WHEN 'Forward' THEN {rdiv(f"300 * {cents('coalesce(goals_per90, 0)')} + 200 * {cents('coalesce(assists_per90, 0)')} + 3 * {cents('coalesce(shot_conversion_pct, 0)')} + 50 * (goals * 100 - xg_c)", '1000', 1)}
      WHEN 'Midfielder' THEN {rdiv(f"(150 * {cents('coalesce(goals_per90, 0)')} + 250 * {cents('coalesce(assists_per90, 0)')} + 2 * {cents('coalesce(pass_completion_pct, 0)')}) * {_n90} + (5 * key_passes + 3 * progressive_passes) * 100000", f'(1000 * {_n90})', 1)}
      WHEN 'Defender' THEN {rdiv(f"3 * {cents('coalesce(pass_completion_pct, 0)')} * {_n90} + (10 * tackles + 10 * interceptions + 5 * clearances) * 100000", f'(1000 * {_n90})', 1)}
    END AS performance_score, xg_c, xa_c
  FROM s_players WHERE minutes >= 90"""


def sql(body: str, **extra: str) -> str:
    """``WITH`` every named block the body (or a needed block) mentions."""
    known = {**CTES, **extra}
    need: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in need and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit_block(name)

    def visit_block(name: str) -> None:
        visit(known[name])
        if name not in need:
            need.append(name)

    visit(body)
    with_ = ", ".join(f"{n} AS ({known[n]})" for n in need)
    return (f"WITH {with_}\n" if with_ else "") + body.strip()


def exclude(*cols: str) -> str:
    return f"* EXCLUDE ({', '.join(cols)})"
