"""Data quality (Q) and lookups (R) against SQL."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import q_gold as g
from checks.fixtures import table
from checks.registry import query
from checks.sql import rdiv, sql
from touchline.operators import quality as q
from touchline.plans import gold, lookups, medallion, silver, suites
from touchline.session import shared_dir
from touchline.sources import tables

c = F.col
NOW = "2024-01-02 00:00:00"
DAY_AFTER = "2024-01-03 00:00:00"


def expect(layer: str, name: str, rows: list[tuple[str, str, str, str]], now: str = NOW) -> str:
    """Check SQL for a suite: one (type, check, checked count, failed count) per rule; each
    count is a scalar query."""
    parts = [f"""SELECT '{layer}' AS layer, '{name}' AS table_name, '{kind}' AS check_type, '{check}' AS check_name,
  CASE WHEN f = 0 THEN '✅ PASS' ELSE '❌ FAIL' END AS status, f = 0 AS passed, f || ' failed' AS details, n AS records_checked, f AS records_failed,
  TIMESTAMP '{now}' AS check_timestamp FROM (SELECT CAST(({n}) AS BIGINT) AS n, CAST(({f}) AS BIGINT) AS f)""" for kind, check, n, f in rows]
    return sql("\nUNION ALL\n".join(parts))


def orders(spark, sf):
    """Orders with defects: some keys missing, some duplicated."""
    k = c("o_orderkey")
    return table(spark, sf, "orders").withColumns({
        "note": F.when(k % 50 != 0, c("o_orderpriority")), "half": F.floor(k / 2), "is_old": c("o_orderstatus") == "F", "day": F.date_format("o_orderdate", "yyyy-MM-dd")})


_N = "SELECT count(*) FROM orders"


@query("q1_not_null", expect("Test", "orders", [
    ("Completeness", "NOT NULL: o_orderkey", _N, "SELECT 0"), ("Completeness", "NOT NULL: note", _N, f"{_N} WHERE o_orderkey % 50 = 0")]))
def q1(spark, sf):
    return q.run_suite(orders(spark, sf), "Test", "orders", [q.not_null("o_orderkey", "note")], NOW)


@query("q2_unique", expect("Test", "orders", [
    ("Uniqueness", "UNIQUE: o_orderkey", _N, "SELECT 0"), ("Uniqueness", "UNIQUE: half", f"{_N} WHERE o_orderstatus = 'F'",
     "SELECT count(*) FROM (SELECT o_orderkey // 2 FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL HAVING count(*) > 1)")]))
def q2(spark, sf):
    return q.run_suite(orders(spark, sf), "Test", "orders", [q.unique("o_orderkey"), q.unique("half", where="is_old")], NOW)


@query("q3_foreign_key", expect("Test", "orders", [
    ("Consistency", "FK: o_custkey → customer.c_custkey", _N, "SELECT 0"),
    ("Consistency", "FK: o_custkey → rich.c_custkey", _N, f"{_N} WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal <= 0)")]))
def q3(spark, sf):
    people = table(spark, sf, "customer")
    return q.run_suite(orders(spark, sf), "Test", "orders", [q.foreign_key("o_custkey", "customer", "c_custkey"), q.foreign_key("o_custkey", "rich", "c_custkey")], NOW,
                       {"customer": people, "rich": people.filter("c_acctbal > 0")})


@query("q4_accepted_values", expect("Test", "orders", [
    ("Validity", "VALID VALUES: o_orderstatus", _N, f"{_N} WHERE o_orderstatus = 'P'"),
    ("Validity", "VALID VALUES: note", f"{_N} WHERE o_orderstatus = 'F' AND o_orderkey % 50 <> 0", f"{_N} WHERE o_orderstatus = 'F' AND o_orderkey % 50 <> 0 AND o_orderpriority = '5-LOW'")]))
def q4(spark, sf):
    good = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", None]
    return q.run_suite(orders(spark, sf), "Test", "orders", [q.accepted("o_orderstatus", ["F", "O", None]), q.accepted("note", good, where="is_old")], NOW)


@query("q5_in_range", expect("Test", "orders", [
    ("Validity", "RANGE: o_totalprice in [1000, 400000]", _N, f"{_N} WHERE o_totalprice < 1000 OR o_totalprice > 400000"),
    ("Validity", "RANGE: o_orderkey in [10, None]", f"{_N} WHERE o_orderstatus = 'F'", f"{_N} WHERE o_orderstatus = 'F' AND o_orderkey < 10")]))
def q5(spark, sf):
    return q.run_suite(orders(spark, sf), "Test", "orders", [q.in_range("o_totalprice", 1000, 400000), q.in_range("o_orderkey", lo=10, where="is_old")], NOW)


@query("q6_freshness", expect("Test", "events", [
    ("Timeliness", "FRESHNESS: seen", "SELECT 0", "SELECT CASE WHEN epoch(TIMESTAMP '2024-02-03') - epoch(max(ts)) <= 48 * 3600 THEN 0 ELSE 1 END FROM events"),
    ("Timeliness", "FRESHNESS: seen", "SELECT 0", "SELECT CASE WHEN epoch(TIMESTAMP '2024-02-03') - epoch(max(ts)) <= 100000 * 3600 THEN 0 ELSE 1 END FROM events")], "2024-02-03"))
def q6(spark, sf):
    seen = table(spark, sf, "events").select(c("ts").cast("timestamp").alias("seen"))
    return q.run_suite(seen, "Test", "events", [q.fresh("seen", 48), q.fresh("seen", 100_000)], "2024-02-03")


@query("q7_scd2_integrity", expect("Test", "orders_history", [
    ("SCD2 Integrity", "SINGLE CURRENT: k", "SELECT count(*) FROM scd_hist WHERE is_current", "SELECT 0"),
    ("SCD2 Integrity", "VALID DATES: closed records", "SELECT count(*) FROM scd_hist WHERE NOT is_current", "SELECT count(*) FROM scd_hist WHERE NOT is_current AND k % 3 = 0")]))
def q7(spark, sf):
    h = fx.scd_history(spark, sf).withColumn("valid_to", F.when(c("k") % 3 != 0, c("valid_to")))
    return q.run_suite(h, "Test", "orders_history", [q.scd2("k")], NOW)


@query("q8_row_rule", expect("Test", "fct_match_results", [
    ("Consistency", "POINTS SUM", "SELECT count(*) FROM g_results", "SELECT 0"), ("Consistency", "FEW GOALS", "SELECT count(*) FROM g_results", "SELECT count(*) FROM g_results WHERE total_goals > 4")]))
def q8(spark, sf):
    rules = [q.row_rule("POINTS SUM", "home_points + away_points IN (2, 3)"), q.row_rule("FEW GOALS", "total_goals <= 4")]
    return q.run_suite(g.results(spark, sf), "Test", "fct_match_results", rules, NOW)


_SIZES = "(SELECT count(DISTINCT home_team_id) AS n FROM fx GROUP BY competition_code)"


@query("q9_group_size", expect("Test", "matches", [
    ("Completeness", "GROUP SIZE: home_team_id per competition_code in [18, 20]", f"SELECT count(*) FROM {_SIZES}", f"SELECT count(*) FROM {_SIZES} WHERE n < 18 OR n > 20")]))
def q9(spark, sf):
    return q.run_suite(fx.fx_matches(spark, sf), "Test", "matches", [q.group_size(["competition_code"], "home_team_id", 18, 20)], NOW)


@query("q10_regex_rule", expect("Test", "orders", [
    ("Validity", "PATTERN: o_orderpriority", _N, f"{_N} WHERE NOT regexp_full_match(o_orderpriority, '[1-3]-[A-Z]+')")]))
def q10(spark, sf):
    return q.run_suite(orders(spark, sf), "Test", "orders", [q.matches("o_orderpriority", "^[1-3]-[A-Z]+$")], NOW)


def _rules(spark, sf):
    orders(spark, sf).createOrReplaceTempView("tl_orders")
    rules = {
        "no_keys_missing": "SELECT * FROM tl_orders WHERE o_orderkey IS NULL",
        "notes_present": "SELECT * FROM tl_orders WHERE note IS NULL",
        "broken": "SELECT no_such_column FROM tl_orders",
    }
    return suites.run_sql_rules(spark, rules, NOW, "r1")


_RULES = f"""SELECT name AS test_name, status, details, TIMESTAMP '{NOW}' AS timestamp, 'r1' AS run_id FROM (
  SELECT 'no_keys_missing' AS name, '✅ PASS' AS status, 'OK' AS details
  UNION ALL SELECT 'notes_present', '❌ FAIL', count(*) || ' failures' FROM orders WHERE o_orderkey % 50 = 0
  UNION ALL SELECT 'broken', '⚠️ ERROR', 'AnalysisException')"""


@query("q11_run_sql_rule", _RULES)
def q11(spark, sf):
    return _rules(spark, sf).withColumn("details", F.when(c("status") == q.ERROR, "AnalysisException").otherwise(c("details")))


def _suite(spark, sf, now=NOW):
    return q.run_suite(orders(spark, sf), "Test", "orders", [q.not_null("o_orderkey", "note"), q.unique("o_orderkey"), q.in_range("o_totalprice", 0, 10)], now)


# Failed rows of each check of the suite above.
_FOUND = """(SELECT count(*) AS n FROM orders WHERE o_orderkey IS NULL UNION ALL SELECT count(*) FROM orders WHERE o_orderkey % 50 = 0
  UNION ALL SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING count(*) > 1) UNION ALL SELECT count(*) FROM orders WHERE o_totalprice NOT BETWEEN 0 AND 10)"""


@query("q12_summary", f"""
SELECT count(*) AS total, count(*) FILTER (n = 0) AS passed, count(*) FILTER (n > 0) AS failed, count(*) FILTER (n IS NULL) AS errors,
  round(100.0 * count(*) FILTER (n = 0) / count(*), 1)::DOUBLE AS pass_rate FROM {_FOUND}""")
def q12(spark, sf):
    return q.summary(_suite(spark, sf))


@query("q13_history_trend", f"""
SELECT day AS check_date, 'Test' AS layer, count(*) AS total_checks, count(*) FILTER (n = 0) AS passed, count(*) FILTER (n > 0) AS failed,
  round(100.0 * count(*) FILTER (n = 0) / count(*), 1)::DOUBLE AS pass_rate FROM {_FOUND}, (VALUES (DATE '2024-01-02'), (DATE '2024-01-03')) d(day) GROUP BY day""")
def q13(spark, sf):
    path = f"{shared_dir(spark)}/data_quality_history-{uuid4().hex}"
    for now in (NOW, DAY_AFTER):
        tables.write_append(_suite(spark, sf, now), path)
    return q.trend(tables.scan_table(spark, path), F.to_date("check_timestamp").alias("check_date"), "layer")


@query("q13_trend_per_run", f"""
SELECT r.run_id, count(*) AS total_checks, count(*) FILTER (status LIKE '%PASS') AS passed, count(*) FILTER (status LIKE '%FAIL') AS failed,
  round(100.0 * count(*) FILTER (status LIKE '%PASS') / count(*), 1)::DOUBLE AS pass_rate FROM ({_RULES}) q, (VALUES ('r1'), ('r2')) r(run_id) GROUP BY r.run_id""")
def q13_runs(spark, sf):
    rules = _rules(spark, sf)
    return q.trend(rules.unionByName(rules.withColumn("run_id", F.lit("r2"))), "run_id")


@query("q14_failed_only", """
SELECT 'NOT NULL: note' AS check_name, count(*) AS records_failed FROM orders WHERE o_orderkey % 50 = 0
UNION ALL SELECT 'RANGE: o_totalprice in [0, 10]', count(*) FROM orders WHERE o_totalprice > 10""")
def q14(spark, sf):
    return q.failed_only(_suite(spark, sf)).select("check_name", "records_failed").orderBy("check_name")


_TABLE_SUITE = [
    *[("Completeness", f"NOT NULL: {n}", "SELECT count(*) FROM g_results", "SELECT 0") for n in ("match_id", "match_date", "competition_code", "home_team_id", "away_team_id", "total_goals")],
    ("Uniqueness", "UNIQUE: match_id", "SELECT count(*) FROM g_results", "SELECT 0"),
    *[("Validity", f"VALID VALUES: {n}_points", "SELECT count(*) FROM g_results", "SELECT 0") for n in ("home", "away")],
    ("Validity", "RANGE: total_goals in [0, 15]", "SELECT count(*) FROM g_results", "SELECT 0"),
    ("Consistency", "POINTS SUM: home + away = 2 or 3", "SELECT count(*) FROM g_results", "SELECT 0"),
    ("Consistency", "FK: home_team_id → dim_teams.team_id", "SELECT count(*) FROM g_results", "SELECT 0"),
]


@query("q15_run_suite", expect("Gold", "fct_match_results", _TABLE_SUITE))
def q15(spark, sf):
    checks = suites.GOLD["fct_match_results"]
    return q.run_suite(g.results(spark, sf), "Gold", "fct_match_results", checks, NOW, {"dim_teams": fx.silver_teams(spark, sf)})


_FORM_N = "SELECT count(DISTINCT (team_name, competition_name)) FROM x_sides"


@query("q15_run_suites_form", expect("Gold", "agg_team_form", [
    ("Uniqueness", "UNIQUE: form_key", _FORM_N, "SELECT 0"),
    *[("Completeness", f"NOT NULL: {n}", _FORM_N, "SELECT 0") for n in ("form_key", "team_name", "form_points")],
    *[("Validity", n, _FORM_N, "SELECT 0") for n in (
        "RANGE: form_points in [0, 15]", "RANGE: matches_in_form in [1, 5]", "PATTERN: form_string", "VALID VALUES: form_rating", "VALID VALUES: form_trend")],
]))
def q15_form(spark, sf):
    form = gold.team_form(fx.silver_xg_matches(spark, sf))
    return suites.run_suites({"agg_team_form": form}, NOW)


def _samples(text, source):
    """Check SQL: of every bucket (first digits of the MD5) the text of least MD5, and of these the five least."""
    return f"""(SELECT list_transform(list_sort(list(m))[1:5], lambda x: substr(x, 33)) FROM (SELECT min(m) AS m FROM (SELECT md5(t) || t AS m FROM (SELECT {text} AS t {source})) GROUP BY left(m, 2)))"""


_ROW, _KEY = """'{"o_orderkey":' || o_orderkey || '}'""", """'{"k0":' || k || '}'"""


@query("q15_suite_samples", " UNION ALL ".join(
    f"SELECT '{name}' AS check_name, CAST(({n}) AS BIGINT) AS records_checked, CAST((SELECT count(*) {failed}) AS BIGINT) AS records_failed, coalesce({_samples(text, sampled)}, []) AS samples"
    for name, n, failed, text, sampled in (
        ("NOT NULL: note", _N, "FROM orders WHERE o_orderkey % 50 = 0", _ROW, "FROM orders WHERE o_orderkey % 50 = 0"),
        ("RANGE: o_totalprice in [1000, 400000]", _N, "FROM orders WHERE o_totalprice NOT BETWEEN 1000 AND 400000", _ROW, "FROM orders WHERE o_totalprice NOT BETWEEN 1000 AND 400000"),
        ("PATTERN: o_orderpriority", _N, "FROM orders WHERE NOT regexp_full_match(o_orderpriority, '[1-3]-[A-Z]+')", _ROW, "FROM orders WHERE NOT regexp_full_match(o_orderpriority, '[1-3]-[A-Z]+')"),
        ("UNIQUE: o_orderkey", _N, "FROM orders WHERE FALSE", _KEY, "FROM (SELECT 1 AS k WHERE FALSE)"),
        ("UNIQUE: half", f"{_N} WHERE o_orderstatus = 'F'", "FROM (SELECT o_orderkey // 2 AS k FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL HAVING count(*) > 1)", _KEY,
         "FROM (SELECT o_orderkey // 2 AS k FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL HAVING count(*) > 1)"),
        ("FK: o_custkey → rich.c_custkey", _N, "FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal <= 0)", _KEY,
         "FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal <= 0))"),
        ("GROUP SIZE: o_orderpriority per o_custkey in [4, 5]", "SELECT count(DISTINCT o_custkey) FROM orders", "FROM (SELECT o_custkey FROM orders GROUP BY ALL HAVING count(DISTINCT o_orderpriority) < 4)", _KEY,
         "FROM (SELECT o_custkey AS k FROM orders GROUP BY ALL HAVING count(DISTINCT o_orderpriority) < 4)"),
    )))
def q15_samples(spark, sf):
    """A fault for nearly every kind of rule; one scan counts them all and keeps samples."""
    rules = [q.not_null("note"), q.in_range("o_totalprice", 1000, 400000), q.matches("o_orderpriority", "^[1-3]-[A-Z]+$"), q.unique("o_orderkey"), q.unique("half", where="is_old"),
             q.foreign_key("o_custkey", "rich", "c_custkey"), q.group_size(["o_custkey"], "o_orderpriority", 4, 5)]
    out = q.run_suite(orders(spark, sf), "Test", "orders", rules, NOW, {"rich": table(spark, sf, "customer").filter("c_acctbal > 0")}, sample_by=["o_orderkey"])
    return out.select("check_name", "records_checked", "records_failed", "samples")


@query("q11_rule_samples", f"""
SELECT 'notes_present' AS test_name, '❌ FAIL' AS status, (SELECT count(*) FROM orders WHERE o_orderkey % 50 = 0) || ' failures' AS details, {_samples(_ROW, "FROM orders WHERE o_orderkey % 50 = 0")} AS samples
UNION ALL SELECT 'no_keys_missing', '✅ PASS', 'OK', []""")
def q11_samples(spark, sf):
    orders(spark, sf).createOrReplaceTempView("tl_orders")
    rules = {"notes_present": "SELECT o_orderkey FROM tl_orders WHERE note IS NULL", "no_keys_missing": "SELECT o_orderkey FROM tl_orders WHERE o_orderkey IS NULL"}
    return suites.run_sql_rules(spark, rules, NOW, "r1", samples=True).select("test_name", "status", "details", "samples")


def payload_bronze(spark, sf):
    """The payload line's tables with faults: a team that is missing, far too many points, far too many goals."""
    raw = fx.fx_matches(spark, sf).withColumns({"match_date": F.date_format("played_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
                                                "home_score": F.when(c("match_id") % 50 == 0, c("home_score") + 90).otherwise(c("home_score"))})
    teams = fx.bronze_teams(spark, sf).filter((c("ingest_timestamp") == fx.LOADED) & (c("team_id") != 3)).drop("competition_name")
    teams = teams.withColumns({"competition_code": F.lit("PL"), "competition_name": F.lit("Premier League")})
    latest = fx.dedup_latest(fx.bronze_standings(spark, sf), ["team_id", "competition_code"], ["ingest_timestamp"])
    latest = latest.withColumn("points", F.when(c("team_id") == 5, 999).otherwise(c("points")))
    return {"stg_matches": raw, "stg_teams": teams, "stg_standings": latest, "stg_fbref_matches": fx.bronze_xg_matches(spark, sf)}


def _payload_line(spark, sf):
    root = f"{shared_dir(spark)}/payload-{uuid4().hex}"
    return medallion.run_payloads(spark, root, payload_bronze(spark, sf), "b20240101", "2024-01-01 00:00:00", now=DAY_AFTER)


_LATEST = "(SELECT * FROM st_base QUALIFY row_number() OVER (PARTITION BY team_id, competition_code ORDER BY taken DESC) = 1)"
# Failures of every SQL rule of the line; a rule that isn't named finds none.
_LINE_RULES = {
    "stg_matches.match_id_not_null": None, "stg_matches.valid_competition_code": "SELECT count(DISTINCT competition_code) FROM fx WHERE competition_code = 'XX'",
    "stg_matches.unique_current_match_id": None, "stg_matches.valid_goals_range": "SELECT count(*) FROM fx WHERE status = 'FINISHED' AND match_id % 50 = 0",
    "stg_teams.team_id_not_null": None, "stg_teams.team_name_not_null": None,
    "stg_standings.valid_position_range": f"SELECT count(*) FROM {_LATEST} WHERE position NOT BETWEEN 1 AND 20",
    "stg_standings.valid_points_range": f"SELECT count(*) FROM {_LATEST} WHERE team_id = 5 OR pts > 150",
    "fct_match_results.unique_match_id": None, "fct_match_results.valid_home_points": None, "fct_match_results.valid_away_points": None, "fct_match_results.points_add_up": None,
    "dim_teams.unique_team_id": None, "dim_teams.valid_position": f"SELECT count(*) FROM {_LATEST} WHERE competition_code = 'PL' AND team_id <> 3 AND position NOT BETWEEN 1 AND 20",
    "agg_team_form.valid_form_points": None, "agg_team_form.valid_form_string": None, "agg_head_to_head.positive_matches": None,
    "ref_integrity.matches_have_valid_home_team": "SELECT count(*) FROM fx WHERE home_team_id = 3", "ref_integrity.matches_have_valid_away_team": "SELECT count(*) FROM fx WHERE away_team_id = 3",
    "ref_integrity.all_competitions_have_standings": f"SELECT count(*) FROM fx WHERE competition_code NOT IN (SELECT competition_code FROM {_LATEST})",
    "freshness.data_not_stale": None,
}


@query("payload_rules", sql(" UNION ALL ".join(
    f"SELECT '{name}' AS test_name, CASE WHEN n = 0 THEN '✅ PASS' ELSE '❌ FAIL' END AS status, CASE WHEN n = 0 THEN 'OK' ELSE n || ' failures' END AS details, "
    f"CAST(least(n, 1) AS INTEGER) AS has_samples FROM (SELECT ({found or 'SELECT 0'}) AS n)" for name, found in _LINE_RULES.items())))
def payload_rules(spark, sf):
    """The payload line over the whole tables: history, marts, and all 21 rules over what it wrote."""
    rules = _payload_line(spark, sf)["rules"]
    return rules.select("test_name", "status", "details", (F.size("samples") > 0).cast("int").alias("has_samples"))


# --- R ------------------------------------------------------------------------------
@query("r1_get_matches", sql("""
SELECT match_id, match_date, competition_name, home_team_name, away_team_name, home_goals, away_goals FROM g_results WHERE competition_code = 'DED'
ORDER BY match_date DESC, match_id DESC LIMIT 10"""))
def r1(spark, sf):
    return lookups.get_matches(g.results(spark, sf), "DED")


_ST = f"({g.STANDINGS})"


@query("r2_get_standings", sql(f"""
SELECT competition_name, team_name, position, played, won, drawn, lost, points, goals_for, goals_against, goal_difference FROM {_ST} WHERE competition_name = 'ASIA'"""))
def r2(spark, sf):
    return lookups.get_standings(gold.competition_standings(g.teams(spark, sf)), "ASIA")


@query("r3_get_head_to_head", sql(f"""
SELECT h2h_key, perspective_team, wins, draws, losses FROM ({g.H2H}) WHERE contains(team_a, 'T1') AND contains(team_b, 't2')"""))
def r3(spark, sf):
    h = gold.head_to_head(fx.silver_xg_matches(spark, sf))
    return lookups.get_head_to_head(h, "t2", "T1").select("h2h_key", "perspective_team", "wins", "draws", "losses")


@query("r4_get_data_quality", f"SELECT test_name, details FROM ({_RULES}) WHERE status = '❌ FAIL'")
def r4(spark, sf):
    return lookups.get_data_quality(_rules(spark, sf), "FAIL").select("test_name", "details")


@query("r5_competition_overview", sql(f"""
SELECT competition_name, count(*) AS matches, {rdiv('sum(total_goals)', 'count(*)', 2)} AS avg_goals, count(*) FILTER (home_goals > away_goals) AS home_wins,
  count(*) FILTER (home_goals = away_goals) AS draws, count(*) FILTER (home_goals < away_goals) AS away_wins FROM g_results GROUP BY ALL"""))
def r5(spark, sf):
    return lookups.competition_overview(g.results(spark, sf))


@query("r6_leaders", sql(f"SELECT competition_name, team_name, position, points FROM {_ST} WHERE position <= 3"))
def r6(spark, sf):
    return lookups.leaders(gold.competition_standings(g.teams(spark, sf)), 3)


@query("r7_rows_per_competition", sql("""
SELECT 'matches' AS what, competition_name, count(*) AS rows FROM fx GROUP BY ALL UNION ALL SELECT 'players', competition_name, count(DISTINCT player_name) FROM s_players GROUP BY ALL"""))
def r7(spark, sf):
    m = lookups.rows_per_competition(fx.bronze_matches(spark, sf)).select(F.lit("matches").alias("what"), "*")
    p = lookups.rows_per_competition(fx.bronze_players(spark, sf), "player_name").select(F.lit("players").alias("what"), "*")
    return m.unionByName(p)


@query("r8_over_performers", sql("""
SELECT 'over' AS list, player_season_key FROM (SELECT player_season_key FROM s_players WHERE minutes >= 450 ORDER BY goals * 100 - xg_c DESC, player_season_key LIMIT 20)
UNION ALL SELECT 'goals', player_season_key FROM (SELECT player_season_key FROM s_players ORDER BY goals DESC, assists DESC, player_season_key LIMIT 20)"""))
def r8(spark, sf):
    p = fx.silver_players(spark, sf)
    over, goals = lookups.over_performers(p), lookups.most_goals(p)
    return over.select(F.lit("over").alias("list"), "player_season_key").unionByName(goals.select(F.lit("goals").alias("list"), "player_season_key"))


@query("r9_latest_with_xg", sql("SELECT match_id, match_date, home_xg, away_xg FROM g_xg WHERE home_xg IS NOT NULL ORDER BY match_date DESC, match_id, home_xg, away_xg LIMIT 20"))
def r9(spark, sf):
    return lookups.latest_with_xg(g.xg_results(spark, sf)).select("match_id", "match_date", "home_xg", "away_xg")


@query("r9_table_top", sql("SELECT competition_name, season, team_name, position, points, xg, xga FROM st_hist WHERE valid_to IS NULL AND position <= 5"))
def r9_table(spark, sf):
    return lookups.table_top(fx.standings_history(spark, sf).filter("is_current"))


@query("r10_form_table", sql(f"""
SELECT team_name, form_string, form_points, form_ppg, form_goals_scored || '-' || form_goals_conceded AS goals, form_rating FROM ({g.FORM}) WHERE competition_name = 'Eredivisie'"""))
def r10_form(spark, sf):
    return lookups.form_table(gold.team_form(fx.silver_xg_matches(spark, sf)), "Eredivisie")


@query("r10_best_head_to_head", sql(f"""
SELECT perspective_team, opponent_team, competition_name, total_matches, wins, win_percentage, h2h_dominance FROM ({g.H2H}) WHERE total_matches >= 2
ORDER BY win_percentage DESC, total_matches DESC, perspective_team, opponent_team, competition_name LIMIT 20"""))
def r10_best(spark, sf):
    return lookups.best_head_to_head(gold.head_to_head(fx.silver_xg_matches(spark, sf)))


@query("r10_pair_record", sql(f"""
SELECT perspective_team, opponent_team, competition_name, total_matches, wins || '-' || draws || '-' || losses AS record, goals_scored || '-' || goals_conceded AS goals, points, h2h_dominance
FROM ({g.H2H}) WHERE team_a = 'T02 NATION_2 FC' AND team_b = 't01 nation_1 fc'"""))
def r10_pair(spark, sf):
    return lookups.pair_record(gold.head_to_head(fx.silver_xg_matches(spark, sf)), "t01 nation_1 fc", "T02 NATION_2 FC")


@query("r10_team_table", sql(f"""
SELECT team_name, position, points, won || '-' || drawn || '-' || lost AS record, goals_for || '-' || goals_against AS goals, zone FROM {_ST} WHERE competition_name = 'ASIA'"""))
def r10_table(spark, sf):
    return lookups.team_table(gold.competition_standings(g.teams(spark, sf)), "ASIA")


@query("r10_hot_streaks", sql(f"SELECT player_name, team_name, recent_goals, current_form FROM ({g.PLAYER_FORM}) WHERE is_on_hot_streak"))
def r10_hot(spark, sf):
    return lookups.hot_streaks(gold.player_form(fx.player_history(spark, sf)))


@query("r10_position_track", sql(f"""
SELECT team_name, competition_name, snapshot_date, position, position_movement FROM ({g.STANDING_HISTORY}) WHERE team_name = 'T01 NATION_1'"""))
def r10_track(spark, sf):
    return lookups.position_track(gold.standing_history(fx.standings_history(spark, sf)), "T01 NATION_1")
