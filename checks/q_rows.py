"""Projections, filters and predicates (P) and scalar functions (F) against SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.fixtures import table
from checks.registry import query
from checks.sql import CODE, cents, rdiv, rh, sk, sql, units
from touchline import constants as K
from touchline.functions import labels, numeric, text
from touchline.operators import filters

c = F.col
AS_OF = "1998-07-01 00:00:00"


# --- P ------------------------------------------------------------------------------
@query("p1_project_rename_cast", """
SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(12,2))::DOUBLE AS price, upper(o_orderpriority) AS priority FROM orders""")
def p1(spark, sf):
    return filters.project(table(spark, sf, "orders"), {
        "id": "o_orderkey", "day": F.to_date("o_orderdate"), "price": "cast(cast(o_totalprice as decimal(12,2)) as double)",
        "priority": F.upper("o_orderpriority")})


@query("p2_filter_current_finished", sql("SELECT match_id, home_goals, away_goals FROM s_matches WHERE is_finished"))
def p2(spark, sf):
    rows = fx.silver_matches(spark, sf).withColumn("is_current", F.lit(True))
    return filters.finished(filters.current(rows)).select("match_id", "home_goals", "away_goals")


@query("p3_filter_nonblank", "SELECT c_custkey FROM customer WHERE c_custkey % 4 = 3")
def p3(spark, sf):
    k = c("c_custkey") % 4
    name = F.when(k == 0, "  ").when(k == 1, " nan ").when(k == 3, c("c_name"))
    rows = table(spark, sf, "customer").select("c_custkey", name.alias("name"))
    return filters.nonblank_rows(rows, "name", also_blank=("nan",)).select("c_custkey")


@query("p4_filter_threshold", sql("SELECT player_season_key, minutes FROM s_players WHERE minutes >= 90 AND matches_played >= 3 AND (goals > 0 OR key_passes >= 10)"))
def p4(spark, sf):
    return fx.silver_players(spark, sf).filter(
        (c("minutes") >= 90) & (c("matches_played") >= 3) & ((c("goals") > 0) | (c("key_passes") >= 10))).select("player_season_key", "minutes")


@query("p5_in_list", """
SELECT o_orderkey, o_orderpriority IN ('1-URGENT', '5-LOW') AS inside, o_orderpriority NOT IN ('1-URGENT', '5-LOW') AS outside FROM orders""")
def p5(spark, sf):
    values = ["1-URGENT", None, "5-LOW"]
    return table(spark, sf, "orders").select("o_orderkey", filters.in_list("o_orderpriority", values).alias("inside"),
                                             filters.not_in_list("o_orderpriority", values).alias("outside"))


@query("p6_like_const", """
SELECT o_orderkey, contains(o_orderpriority, 'URGENT') OR contains(o_orderpriority, 'HIGH') AS hit FROM orders""")
def p6(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", labels.contains_any("o_orderpriority", ["URGENT", "HIGH"]).alias("hit"))


@query("p7_like_dynamic", sql("""
SELECT match_id, contains(lower(h), lower(home_team_name[1:5])) OR contains(lower(home_team_name), lower(h[1:5])) AS hit
FROM (SELECT match_id, home_team_name, CASE match_id % 3 WHEN 0 THEN upper(home_team_name) WHEN 1 THEN away_team_name ELSE 'FC ' || lower(home_team_name) END AS h FROM fx)"""))
def p7(spark, sf):
    k = c("match_id") % 3
    other = (F.when(k == 0, F.upper("home_team_name")).when(k == 1, c("away_team_name")).otherwise(F.concat(F.lit("FC "), F.lower("home_team_name"))))
    rows = fx.fx_matches(spark, sf).withColumn("h", other)
    return rows.select("match_id", (text.contains_prefix("h", "home_team_name") | text.contains_prefix("home_team_name", "h")).alias("hit"))


@query("p8_regex_fullmatch", """
SELECT o_orderkey, regexp_full_match(translate(o_orderstatus, 'FOP', 'WDX') || translate(o_orderstatus, 'FOP', 'LLL'), '[WDL]+') AS ok FROM orders""")
def p8(spark, sf):
    s = F.concat(F.translate("o_orderstatus", "FOP", "WDX"), F.translate("o_orderstatus", "FOP", "LLL"))
    return table(spark, sf, "orders").select("o_orderkey", F.rlike(s, F.lit("^[WDL]+$")).alias("ok"))


@query("p9_case_ladder", sql("""
SELECT standing_key, CASE WHEN position < 5 THEN 'Champions League Zone' WHEN position < 7 THEN 'Europa League Zone' WHEN position < 8 THEN 'Conference League Zone'
  ELSE 'Mid-table' END AS zone, CASE WHEN points > 12 THEN '🔥 Excellent' WHEN points > 9 THEN '✅ Good' WHEN points > 6 THEN '➡️ Average' WHEN points > 3 THEN '⚠️ Poor'
  ELSE '❌ Very Poor' END AS rating FROM s_st"""))
def p9(spark, sf):
    st = fx.standings_history(spark, sf)
    return st.select("standing_key", labels.at_most("position", K.SNAPSHOT_ZONES_TOP, K.ZONE_MIDDLE).alias("zone"),
                     labels.at_least("points", K.FORM_RATINGS, K.FORM_RATING_REST).alias("rating"))


@query("p10_code_map", sql(f"SELECT match_id, competition_name, {CODE} AS code FROM fx"))
def p10(spark, sf):
    return fx.fx_matches(spark, sf).select("match_id", "competition_name", labels.code_map("competition_name", K.COMPETITION_CODES).alias("code"))


@query("p11_bool_flags", sql("""
SELECT match_id, coalesce(home_score + away_score > 2, FALSE) AS high_scoring, coalesce(home_score + away_score = 0, FALSE) AS goalless,
  coalesce(least(home_score, away_score) > 0, FALSE) AS both_scored, coalesce(away_score = 0, FALSE) AS home_clean_sheet FROM fx"""))
def p11(spark, sf):
    h, a, f = c("home_score"), c("away_score"), labels.flag
    return fx.fx_matches(spark, sf).select(
        "match_id", f(h + a >= 3).alias("high_scoring"), f((h == 0) & (a == 0)).alias("goalless"),
        f((h > 0) & (a > 0)).alias("both_scored"), f(a == 0).alias("home_clean_sheet"))


@query("p12_as_of", sql(f"""
SELECT standing_key, position, points, valid_from FROM st_hist WHERE valid_from <= TIMESTAMP '{AS_OF}' AND coalesce(valid_to, TIMESTAMP '9999-01-01') > TIMESTAMP '{AS_OF}'"""))
def p12(spark, sf):
    return filters.as_of(fx.standings_history(spark, sf), AS_OF).select("standing_key", "position", "points", "valid_from")


@query("p13_select_distinct", sql("SELECT DISTINCT competition_code, home_team_name FROM fx"))
def p13(spark, sf):
    return fx.fx_matches(spark, sf).select("competition_code", "home_team_name").distinct()


@query("p14_having", """
SELECT l_suppkey, count(*) AS lines FROM lineitem GROUP BY l_suppkey HAVING count(*) > 600
UNION ALL SELECT -1, count(*) FROM lineitem HAVING max(l_quantity) > 10""")
def p14(spark, sf):
    li = table(spark, sf, "lineitem")
    per = li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("lines")).filter("lines > 600")
    whole = li.agg(F.count(F.lit(1)).alias("lines"), F.max("l_quantity").alias("m")).filter("m > 10")
    return per.unionByName(whole.select(F.lit(-1).cast("long").alias("l_suppkey"), "lines"))


@query("p15_case_result", sql("""
SELECT match_id, CASE sign(home_score - away_score) WHEN 1 THEN 'HOME' WHEN -1 THEN 'AWAY' WHEN 0 THEN 'DRAW' END AS by_score,
  CASE sign(home_score - away_score) WHEN 1 THEN 'HOME' WHEN -1 THEN 'AWAY' WHEN 0 THEN 'DRAW' END AS by_winner FROM fx"""))
def p15(spark, sf):
    b = fx.bronze_matches(spark, sf)
    return b.select("match_id", labels.result_from_score("home_score_fulltime", "away_score_fulltime").alias("by_score"),
                    labels.code_map("winner", K.WINNER_TO_RESULT).alias("by_winner"))


@query("p16_points", sql("""
SELECT match_id, CASE WHEN home_score > away_score THEN 3 WHEN home_score = away_score THEN 1 ELSE 0 END AS home_points,
  CASE WHEN home_score < away_score THEN 3 WHEN home_score = away_score THEN 1 ELSE 0 END AS away_points FROM fx"""))
def p16(spark, sf):
    m = fx.silver_matches(spark, sf)
    return m.select("match_id", labels.points("match_result", "HOME").alias("home_points"), labels.points("match_result", "AWAY").alias("away_points"))


# --- F ------------------------------------------------------------------------------
@query("f1_trim_case", "SELECT c_custkey, upper(c_mktsegment) AS up, lower(c_name) AS low, c_name AS trimmed FROM customer")
def f1(spark, sf):
    padded = F.concat(F.lit("  "), c("c_name"), F.lit(" "))
    return table(spark, sf, "customer").select("c_custkey", text.clean_upper(F.lower("c_mktsegment")).alias("up"), F.lower("c_name").alias("low"), text.clean(padded).alias("trimmed"))


@query("f2_substring", "SELECT c_custkey, c_name[1:5] AS head FROM customer")
def f2(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", text.prefix("c_name").alias("head"))


@query("f3_concat", sql("""
SELECT standing_key, valid_from, wins || '-' || draws || '-' || losses AS record, goals_for || '-' || goals_against AS goals,
  CASE WHEN position > 3 THEN competition_name || '/' || team_name END AS strict, CASE WHEN position > 3 THEN competition_name || '/' ELSE '' END || team_name AS loose FROM st_hist"""))
def f3(spark, sf):
    name = F.when(c("position") > 3, c("competition_name"))
    return fx.standings_history(spark, sf).select(
        "standing_key", "valid_from", text.record_text("wins", "draws", "losses").alias("record"), text.record_text("goals_for", "goals_against").alias("goals"),
        text.record_text(name, "team_name", sep="/").alias("strict"), F.concat_ws("/", name, "team_name").alias("loose"))


@query("f4_digits_only", sql("SELECT match_id, CAST(CASE WHEN match_id % 9 <> 1 THEN match_id * 37 % 60000 END AS INTEGER) AS attendance FROM fx"))
def f4(spark, sf):
    crowd = c("match_id") * 37 % 60000
    txt = F.when(c("match_id") % 9 == 1, "n/a").otherwise(F.format_number(crowd, 0))
    return fx.fx_matches(spark, sf).select("match_id", text.digits_to_int(txt).alias("attendance"))


@query("f5_split_score", sql("""
SELECT match_id, CASE WHEN match_id % 4 <> 0 THEN CAST(home_score AS VARCHAR) END AS home, CASE WHEN match_id % 4 <> 0 THEN CAST(away_score AS VARCHAR) END AS away FROM fx"""))
def f5(spark, sf):
    h, a = c("home_score").cast("string"), c("away_score").cast("string")
    dashed = F.when(c("match_id") % 4 == 0, F.concat(h, F.lit("-"), a)).otherwise(F.concat(h, F.lit(" – "), a))
    return fx.fx_matches(spark, sf).select("match_id", text.score_part(dashed, 0).alias("home"), text.score_part(dashed, 1).alias("away"))


@query("f6_name_cleaning", "SELECT p_partkey, replace(p_name, ' ', '-') AS dashed, lower(replace(replace(p_name || '-X', ' ', '_'), '-', '_')) AS slug FROM part")
def f6(spark, sf):
    return table(spark, sf, "part").select("p_partkey", text.dashed("p_name").alias("dashed"), text.slug(F.concat(c("p_name"), F.lit("-X"))).alias("slug"))


@query("f7_record_hash", f"SELECT o_orderkey, {rh('o_orderstatus', 'CAST(o_totalprice AS DECIMAL(12,2))', 'CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END')} AS h FROM orders")
def f7(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", text.record_hash(
        "o_orderstatus", c("o_totalprice").cast("decimal(12,2)"), F.when(c("o_orderkey") % 2 == 0, c("o_orderpriority"))).alias("h"))


@query("f8_surrogate_key", f"SELECT o_orderkey, {sk('o_orderkey', 'CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END')} AS k FROM orders")
def f8(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", text.surrogate_key("o_orderkey", F.when(c("o_orderkey") % 2 == 0, c("o_orderpriority"))).alias("k"))


@query("f9_casts", sql("SELECT match_id, played_at AS at, match_date AS day, CAST(matchday AS VARCHAR) AS txt, CAST(season AS DOUBLE) AS num FROM fx"))
def f9(spark, sf):
    return fx.bronze_matches(spark, sf).select(
        "match_id", c("utc_date").cast("timestamp").alias("at"), F.to_date("utc_date").alias("day"), c("matchday").cast("string").alias("txt"),
        F.substring("utc_date", 1, 4).cast("double").alias("num"))


@query("f10_try_cast", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS INTEGER) END AS i, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) END AS d FROM orders""")
def f10(spark, sf):
    even = c("o_orderkey") % 2 == 0
    number = F.when(even, c("o_orderkey").cast("string")).otherwise("2.0")
    day = F.when(even, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("31/12")
    return table(spark, sf, "orders").select("o_orderkey", number.try_cast("int").alias("i"), day.try_cast("date").alias("d"))


@query("f11_date_parts", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS dow FROM orders""")
def f11(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), F.dayofweek("o_orderdate").alias("dow"))


@query("f12_date_difference", """
SELECT event_id, CAST(date_diff('day', CAST(ts AS DATE), DATE '2024-06-01') AS INTEGER) AS days, datesub('hour', ts, TIMESTAMP '2024-06-01') AS hours FROM events""")
def f12(spark, sf):
    now = F.lit("2024-06-01").cast("timestamp")
    ts = c("ts").cast("timestamp")
    return table(spark, sf, "events").select("event_id", F.datediff(now, ts).alias("days"), F.timestamp_diff("HOUR", ts, now).alias("hours"))


_PRICE = cents("l_extendedprice")


@query("f13_round_abs", f"""
SELECT l_orderkey, l_linenumber, l_partkey, {rdiv(_PRICE, '100', 0)} AS r0, {rdiv(_PRICE, '100', 1)} AS r1, {rdiv(_PRICE, 'CAST(l_quantity AS BIGINT) * 100', 3)} AS unit,
  abs(CAST(l_quantity AS INTEGER) - 25) AS gap FROM lineitem""")
def f13(spark, sf):
    price = c("l_extendedprice").cast("decimal(12,2)")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", numeric.rounded(price, 0).alias("r0"), numeric.rounded(price, 1).alias("r1"),
        numeric.ratio("l_extendedprice", "l_quantity", 3).alias("unit"), F.abs(c("l_quantity").cast("int") - 25).alias("gap"))


@query("f14_safe_division", f"""
SELECT l_orderkey, l_linenumber, l_partkey, {rdiv(_PRICE, 'greatest(l_linenumber - 3, 0) * 100', 2)} AS q
FROM lineitem""")
def f14(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", numeric.ratio("l_extendedprice", F.greatest(c("l_linenumber") - 3, F.lit(0)), 2).alias("q"))


@query("f15_coalesce", sql("SELECT match_id, coalesce(home_score, 0) AS zeroed, coalesce(CAST(home_score AS VARCHAR), 'm' || match_id) AS mixed FROM fx"))
def f15(spark, sf):
    return fx.fx_matches(spark, sf).select("match_id", numeric.zero("home_score").alias("zeroed"),
                                           F.coalesce(c("home_score").cast("string"), F.concat(F.lit("m"), c("match_id").cast("string"))).alias("mixed"))


@query("f16_per90", sql(f"SELECT player_season_key, nineties, {rdiv('goals * 100', cents('nineties'), 2)} AS g90 FROM s_players"))
def f16(spark, sf):
    return fx.silver_players(spark, sf).select("player_season_key", "nineties", numeric.per90("goals", "nineties").alias("g90"))


@query("f17_minus_expected", sql(f"SELECT player_season_key, {units('goals * 100 - xg_c')} AS over_xg, {units('assists * 100 - xa_c')} AS over_xa FROM s_players"))
def f17(spark, sf):
    return fx.silver_players(spark, sf).select("player_season_key", numeric.minus("goals", "xg").alias("over_xg"), numeric.minus("assists", "xa").alias("over_xa"))


@query("f18_age", sql("SELECT player_season_key, 2030 - birth_year AS age FROM s_players"))
def f18(spark, sf):
    return fx.silver_players(spark, sf).select("player_season_key", numeric.age_in(2030, "birth_year").alias("age"))


@query("f19_performance_score", sql("SELECT player_season_key, position_category, performance_score FROM g_perf"))
def f19(spark, sf):
    from checks.q_gold import performance

    return performance(spark, sf).select("player_season_key", "position_category", "performance_score")


@query("f20_json_access", "SELECT event_id, CAST(props->>'k' AS INTEGER) AS k, coalesce(props->>'missing', 'none') AS missing FROM events")
def f20(spark, sf):
    p = F.from_json("props", "k int, missing string")
    return table(spark, sf, "events").select("event_id", p["k"].alias("k"), F.coalesce(p["missing"], F.lit("none")).alias("missing"))


@query("f21_movement_label", sql("""
SELECT match_id, CASE WHEN d > 0 THEN '📈 Up ' || d WHEN d < 0 THEN '📉 Down ' || abs(d) ELSE '➡️ Same' END AS label FROM (SELECT match_id, home_score - away_score AS d FROM fx)"""))
def f21(spark, sf):
    return fx.fx_matches(spark, sf).select("match_id", labels.movement(c("home_score") - c("away_score")).alias("label"))
