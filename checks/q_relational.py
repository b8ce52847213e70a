"""Joins (J), aggregates (A), windows (W), order (T) and unions (U) against SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.fixtures import table
from checks.registry import query
from checks.sql import rdiv, sql, units
from touchline.operators import aggregates as agg
from touchline.operators import filters, joins, sides, windows

c = F.col


# --- J ------------------------------------------------------------------------------
@query("j1_join_roles", sql("""
SELECT match_id, h.team_code AS home_code, h.stadium_name AS home_stadium, a.team_code AS away_code
FROM fx LEFT JOIN s_teams h ON h.team_id = home_team_id LEFT JOIN s_teams a ON a.team_id = away_team_id"""))
def j1(spark, sf):
    t = fx.silver_teams(spark, sf)
    m = joins.join_role(fx.fx_matches(spark, sf).select("match_id", "home_team_id", "away_team_id"), t, ("home_team_id", "team_id"),
                        {"home_code": "team_code", "home_stadium": "stadium_name"})
    return joins.join_role(m, t, ("away_team_id", "team_id"), {"away_code": "team_code"}).drop("home_team_id", "away_team_id")


@query("j2_left_two_keys", sql("""
SELECT match_id, team_id, competition_code, n FROM (SELECT match_id, home_team_id AS team_id, competition_code FROM fx)
LEFT JOIN (SELECT away_team_id AS team_id, competition_code, count(*) AS n FROM fx GROUP BY ALL HAVING count(*) > 100) USING (team_id, competition_code)"""))
def j2(spark, sf):
    m = fx.fx_matches(spark, sf)
    away = agg.count_by(m.select(c("away_team_id").alias("team_id"), "competition_code"), "team_id", "competition_code", name="n").filter("n > 100")
    return joins.left_on(m.select("match_id", c("home_team_id").alias("team_id"), "competition_code"), away, ["team_id", "competition_code"], ["n"])


@query("j3_full_outer", sql("""
SELECT coalesce(h.d, a.d) AS match_date, coalesce(h.t, a.t) AS team_id, coalesce(hn, 0) AS home_n, coalesce(an, 0) AS away_n
FROM (SELECT match_date AS d, home_team_id AS t, count(*) AS hn FROM fx GROUP BY ALL) h FULL JOIN (SELECT match_date AS d, away_team_id AS t, count(*) AS an FROM fx GROUP BY ALL) a
ON h.d = a.d AND h.t = a.t"""))
def j3(spark, sf):
    m = fx.fx_matches(spark, sf)

    def per(side):
        return m.groupBy("match_date", c(f"{side}_team_id").alias("team_id")).agg(F.count(F.lit(1)).alias(f"{side}_n"))

    return joins.full_outer(per("home"), per("away"), ["match_date", "team_id"]).fillna(0, ["home_n", "away_n"])


_PAIRS = sql("SELECT a_id AS match_id, b_id AS match_key FROM x_join")


def _pairs(spark, sf):
    p = joins.prefix_match(fx.silver_matches(spark, sf), fx.silver_xg_matches(spark, sf), ["competition_code", "match_date"], "home_team_name")
    return p.select(c("l.match_id").alias("match_id"), c("r.match_key").alias("match_key"))


@query("j4_fuzzy_full_outer", _PAIRS)
def j4(spark, sf):
    return _pairs(spark, sf)


_SIDE = """SELECT CASE WHEN {key} % 3 = 0 THEN NULL ELSE {key} % 7 END AS id, CASE WHEN {key} % 10 < 8 THEN 'hot' WHEN {key} % 10 = 8 THEN {bucket} END AS bucket,
  CASE WHEN {key} % 11 = 0 THEN NULL ELSE {name} END AS name FROM {table}"""
_LEFT = _SIDE.format(key="s_suppkey", bucket="'b' || CAST(s_nationkey AS VARCHAR(9))", name="'T' || CAST(s_nationkey + 100 AS VARCHAR(9)) || ' Club'", table="supplier")
_RIGHT = _SIDE.format(key="c_custkey", bucket="'b' || CAST(c_nationkey AS VARCHAR(9))", name="'the t' || CAST(c_nationkey + 100 AS VARCHAR(9)) || ' cx'", table="customer")


@query("j4_fuzzy_full_outer_hot", f"""SELECT l.id AS l_id, l.bucket AS l_bucket, l.name AS l_name, r.id AS r_id, r.bucket AS r_bucket, r.name AS r_name
FROM ({_LEFT}) l FULL JOIN ({_RIGHT}) r ON l.bucket = r.bucket AND (contains(lower(l.name), lower(left(r.name, 5))) OR contains(lower(r.name), lower(left(l.name, 5))))""")
def j4_hot(spark, sf):
    """NULL and repeated ids, NULL names and buckets, and one bucket with most rows."""
    left, right = (table(spark, sf, n) for n in ("supplier", "customer"))
    p = joins.prefix_match(left.sparkSession.sql(_LEFT.replace("VARCHAR(9)", "STRING").replace("FROM supplier", "FROM {t}"), t=left),
                           right.sparkSession.sql(_RIGHT.replace("VARCHAR(9)", "STRING").replace("FROM customer", "FROM {t}"), t=right), ["bucket"], "name")
    return p.select(*[c(f"{s}.{n}").alias(f"{s}_{n}") for s in "lr" for n in ("id", "bucket", "name")])


_CLUB = """SELECT {key} AS id, CASE WHEN {key} % 9 = 0 THEN NULL ELSE CAST({nation} % 5 AS {text}) END AS bucket,
  CASE {key} % 3 WHEN 0 THEN {a} WHEN 1 THEN {b} ELSE {c} END AS name FROM {table}"""
_HOSTS = _CLUB.format(key="s_suppkey", nation="s_nationkey", text="VARCHAR(9)", a="'Ajax Amsterdam'", b="'Ajax Cape Town'", c="'Sparta'", table="supplier")
_GUESTS = _CLUB.format(key="c_custkey", nation="c_nationkey", text="VARCHAR(9)", a="'AFC ajax amsterdam'", b="'ajax town'", c="'Ajax'", table="customer")
_GRAMS = "list_distinct(list_transform(generate_series(1, greatest(length({n}) - 1, 1)), lambda i: substr(lower({n}), CAST(i AS INTEGER), 2)))"


def _rounds(n):
    """Check SQL: n rounds of pairs that are best for both of their names."""
    out = ["""f0 AS (SELECT DISTINCT l.bucket, l.name AS ln, r.name AS rn, -((2000 * len(list_intersect({x}, {y}))) // (len({x}) + len({y}))) AS s
  FROM hosts l JOIN guests r ON l.bucket = r.bucket AND (contains(lower(l.name), lower(left(r.name, 5))) OR contains(lower(r.name), lower(left(l.name, 5)))))""".format(
        x=_GRAMS.format(n="l.name"), y=_GRAMS.format(n="r.name"))]
    for k in range(n):
        out.append(f"""b{k} AS (SELECT bucket, ln, rn FROM (SELECT *, row_number() OVER (PARTITION BY bucket, ln ORDER BY s, ln, rn) AS i, row_number() OVER (PARTITION BY bucket, rn ORDER BY s, ln, rn) AS j FROM f{k})
  WHERE i = 1 AND j = 1)""")
        out.append(f"f{k + 1} AS (SELECT * FROM f{k} WHERE (bucket, ln) NOT IN (SELECT (bucket, ln) FROM b{k}) AND (bucket, rn) NOT IN (SELECT (bucket, rn) FROM b{k}))")
    return ", ".join(out) + ", pairs AS (" + " UNION ALL ".join(f"SELECT * FROM b{k}" for k in range(n)) + ")"


def _clubs(spark, sf):
    left, right = (table(spark, sf, n) for n in ("supplier", "customer"))
    return (spark.sql(_HOSTS.replace("VARCHAR(9)", "STRING").replace("FROM supplier", "FROM {t}"), t=left),
            spark.sql(_GUESTS.replace("VARCHAR(9)", "STRING").replace("FROM customer", "FROM {t}"), t=right))


@query("j4_one_partner", f"""
WITH hosts AS ({_HOSTS}), guests AS ({_GUESTS}), {_rounds(4)},
l AS (SELECT *, row_number() OVER (PARTITION BY bucket, name ORDER BY id) AS place FROM hosts), r AS (SELECT *, row_number() OVER (PARTITION BY bucket, name ORDER BY id) AS place FROM guests)
SELECT l.id AS l_id, l.name AS l_name, r.id AS r_id, r.name AS r_name FROM l LEFT JOIN pairs p ON p.bucket = l.bucket AND p.ln = l.name
FULL JOIN r ON r.bucket = p.bucket AND r.name = p.rn AND r.place = l.place""")
def j4_one(spark, sf):
    """Several names fit several others, and every name has many rows (games of one team on one day)."""
    p = joins.best_match(*_clubs(spark, sf), ["bucket"], "name", (["id"], ["id"]))
    return p.select(*[c(f"{s}.{n}").alias(f"{s}_{n}") for s in "lr" for n in ("id", "name")])


@query("j4_ambiguous_pairs", f"""
SELECT l.id, count(*) AS partners FROM ({_HOSTS}) l JOIN ({_GUESTS}) r ON l.bucket = r.bucket
  AND (contains(lower(l.name), lower(left(r.name, 5))) OR contains(lower(r.name), lower(left(l.name, 5)))) GROUP BY l.id HAVING count(*) > 1""")
def j4_ambiguous(spark, sf):
    return joins.ambiguous_pairs(joins.prefix_match(*_clubs(spark, sf), ["bucket"], "name", counts=True), ("id", "id"))


@query("j5_semi_join", sql("SELECT k, status, amount FROM scd2 WHERE k IN (SELECT k FROM scd_act WHERE action = 'UPDATE')"))
def j5(spark, sf):
    from touchline.operators.changes import classify

    one, two = fx.scd_prepared(spark, sf)
    changed = classify(two, one, ["k"]).filter("action = 'UPDATE'")
    return joins.keep_keys(fx.scd_batches(spark, sf)[1], changed, ["k"])


@query("j6_anti_join", "SELECT o_custkey, count(*) AS rows FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY ALL")
def j6(spark, sf):
    return joins.orphan_keys(table(spark, sf, "orders"), table(spark, sf, "customer").filter("c_acctbal > 0"), "o_custkey", "c_custkey")


@query("j7_missing_parents", sql("""
SELECT match_id FROM fx WHERE 'ASIA' IN (SELECT competition_name FROM s_teams WHERE team_id IN (home_team_id, away_team_id))"""))
def j7(spark, sf):
    known = fx.silver_teams(spark, sf).filter("competition_name <> 'ASIA'")
    return joins.missing_either(fx.fx_matches(spark, sf), known, ["home_team_id", "away_team_id"], "team_id").select("match_id")


@query("j8_new_or_changed", sql("SELECT k, n_status AS status, n_amount::DOUBLE AS amount FROM scd_act WHERE action IN ('INSERT', 'UPDATE')"))
def j8(spark, sf):
    one, two = fx.scd_prepared(spark, sf)
    return joins.new_or_changed(two, one, ["k"]).select("k", "status", c("amount").cast("double").alias("amount"))


@query("j9_previous_version", sql("""
SELECT n.player_season_key, n.goals, o.goals AS prev_goals, o.minutes AS prev_minutes FROM p_hist n LEFT JOIN (SELECT * FROM p_hist WHERE NOT is_current) o USING (player_season_key)
WHERE n.is_current"""))
def j9(spark, sf):
    p = joins.previous_version(fx.player_history(spark, sf), "player_season_key", {"prev_goals": "goals", "prev_minutes": "minutes"}, keep=["player_season_key", "goals"])
    return p.select("player_season_key", "goals", "prev_goals", "prev_minutes")


@query("j10_enrich", sql("""
SELECT player_name, season, CASE WHEN matches_played > 1 THEN shots END AS shots, CASE WHEN minutes > 100 THEN key_passes END AS key_passes FROM s_players"""))
def j10(spark, sf):
    p = fx.silver_players(spark, sf)
    keys = ["player_name", "season"]

    def lookup(col, where):  # every key twice: the first copy is wrong, the last one counts
        rows = p.filter(where)
        return rows.select(*keys, F.lit(-1).alias(col), F.lit(1).alias("n")).unionByName(rows.select(*keys, col, F.lit(2).alias("n")))

    return joins.enrich(p.select(*keys), {"shooting": lookup("shots", "matches_played > 1"), "passing": lookup("key_passes", "minutes > 100")},
                        keys, {"shooting": ["shots"], "passing": ["key_passes"]}, "n")


@query("j11_group_max", sql("""
SELECT standing_key, valid_from, position >= (SELECT max(position) - 2 FROM st_hist x WHERE x.competition_name = s.competition_name) AS bottom FROM st_hist s"""))
def j11(spark, sf):
    st = windows.group_value(fx.standings_history(spark, sf), ["competition_name"], last=F.max("position"))
    return st.select("standing_key", "valid_from", (c("position") >= c("last") - 2).alias("bottom"))


# --- A ------------------------------------------------------------------------------
@query("a1_count_by", sql("SELECT competition_name, count(*) AS rows FROM fx GROUP BY ALL"))
def a1(spark, sf):
    return agg.count_by(fx.fx_matches(spark, sf), "competition_name")


@query("a2_group_aggregates", sql(f"""
SELECT home_team_id, count(*) AS n, CAST(sum(home_score) AS BIGINT) AS goals, {rdiv('sum(home_score)', 'count(home_score)', 2)} AS avg_goals, min(match_date) AS first_day,
  max(match_date) AS last_day, {units('sum(home_xg_c)')} AS xg FROM fx GROUP BY home_team_id"""))
def a2(spark, sf):
    return fx.fx_matches(spark, sf).groupBy("home_team_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("home_score").alias("goals"), agg.mean("home_score").alias("avg_goals"), F.min("match_date").alias("first_day"),
        F.max("match_date").alias("last_day"), agg.exact_sum("home_xg").alias("xg"))


@query("a3_conditional_count", sql("""
SELECT competition_code, count(*) FILTER (home_score > away_score) AS home_wins, count(*) FILTER (home_score = away_score) AS draws FROM fx GROUP BY ALL"""))
def a3(spark, sf):
    return fx.fx_matches(spark, sf).groupBy("competition_code").agg(
        agg.count_where(c("home_score") > c("away_score")).alias("home_wins"), agg.count_where(c("home_score") == c("away_score")).alias("draws"))


@query("a4_share_of_group", sql(f"SELECT competition_code, {rdiv('count(*) FILTER (home_score > away_score) * 100', 'count(*)', 1)} AS home_win_pct FROM fx GROUP BY ALL"))
def a4(spark, sf):
    return fx.fx_matches(spark, sf).groupBy("competition_code").agg(agg.share_where(c("home_score") > c("away_score")).alias("home_win_pct"))


@query("a5_count_distinct", "SELECT o_orderpriority, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY ALL")
def a5(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(F.count_distinct("o_custkey").alias("customers"))


@query("a6_global_max", "SELECT max(ts) AS latest, count(*) AS n FROM events")
def a6(spark, sf):
    return table(spark, sf, "events").agg(F.max("ts").alias("latest"), F.count(F.lit(1)).alias("n"))


_RECENT = """SELECT *, CASE WHEN gf > ga THEN 'W' WHEN gf = ga THEN 'D' ELSE 'L' END AS res,
  CAST(row_number() OVER (PARTITION BY team_name, competition_name ORDER BY match_date DESC, match_key DESC) AS INTEGER) AS rn FROM x_sides"""


def _recent(spark, sf):
    s = sides.two_sided(filters.finished(fx.silver_xg_matches(spark, sf)), carry=("match_date", "competition_name", "match_key"))
    return windows.last_n(s, ["team_name", "competition_name"], ["match_date", "match_key"], 5)


@query("a7_ordered_text", sql(f"SELECT team_name, competition_name, string_agg(res, '' ORDER BY rn) AS form FROM ({_RECENT}) WHERE rn < 6 GROUP BY ALL"))
def a7(spark, sf):
    return _recent(spark, sf).groupBy("team_name", "competition_name").agg(agg.ordered_text("result", "recency").alias("form"))


@query("a8_most_frequent", """
SELECT o_custkey, o_orderpriority AS priority FROM (SELECT o_custkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS rn
FROM orders GROUP BY o_custkey, o_orderpriority) WHERE rn = 1""")
def a8(spark, sf):
    return agg.most_frequent(table(spark, sf, "orders"), ["o_custkey"], "o_orderpriority", "priority")


@query("a9_latest_value", sql("""
SELECT player_name, team_name FROM (SELECT player_name, team_name, row_number() OVER (PARTITION BY player_name ORDER BY season DESC, minutes DESC) AS rn FROM s_players) WHERE rn = 1"""))
def a9(spark, sf):
    return fx.silver_players(spark, sf).groupBy("player_name").agg(agg.latest_value("team_name", "season", "minutes").alias("team_name"))


@query("a10_pair_key", sql("SELECT least(home_team_name, away_team_name) AS a, greatest(home_team_name, away_team_name) AS b, count(*) AS n FROM fx GROUP BY ALL"))
def a10(spark, sf):
    h, a = "home_team_name", "away_team_name"
    return fx.fx_matches(spark, sf).groupBy(F.least(h, a).alias("a"), F.greatest(h, a).alias("b")).agg(F.count(F.lit(1)).alias("n"))


_TOTALS = ["minutes", "goals", "assists", "goal_contributions", "yellow_cards", "red_cards"]


@query("a11_career_summary", sql(f"""
SELECT player_name, max(nationality) AS nationality, max(birth_year) AS birth_year, arg_max(team_name, season || lpad(CAST(minutes AS VARCHAR), 9, '0')) AS current_team,
  count(DISTINCT competition_name) AS competitions_played, CAST(sum(matches_played) AS BIGINT) AS total_matches,
  {", ".join(f"CAST(sum({t}) AS BIGINT) AS total_{t}" for t in _TOTALS)}, {units('sum(xg_c)')} AS total_xg, {units('sum(xa_c)')} AS total_xa,
  any_value(position_category) AS primary_position FROM s_players GROUP BY player_name"""))
def a11(spark, sf):
    return agg.career_summary(fx.silver_players(spark, sf))


@query("a12_duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def a12(spark, sf):
    return agg.duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("a13_distinct_by_key", """
SELECT l_orderkey, l_linenumber, max(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL""")
def a13(spark, sf):
    return windows.dedup_latest(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey", "l_linenumber"], ["l_partkey"])


# --- W ------------------------------------------------------------------------------
_W1 = sql("""SELECT player_season_key, CAST(row_number() OVER (PARTITION BY competition_name ORDER BY goals DESC, minutes, player_season_key) AS BIGINT) AS rank FROM s_players""")
_KEYED = ["player_season_key", "competition_name", "goals", "minutes"]


@query("w1_rank_within", _W1)
def w1(spark, sf):
    return windows.ordered(fx.silver_players(spark, sf).select(*_KEYED), ["competition_name"], ["goals desc", "minutes"], key=["player_season_key"],
                           row_number="rank").select("player_season_key", "rank")


@query("w1_rank_within_sliced", _W1)
def w1_sliced(spark, sf):
    """The same ranking, joined to its table by key."""
    return windows.ranks(fx.silver_players(spark, sf).select(*_KEYED), ["player_season_key"], {"rank": (["competition_name"], ["goals desc", "minutes"])}).select(
        "player_season_key", "rank")


@query("w2_overall_rank", "SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS rank FROM orders")
def w2(spark, sf):
    return windows.ordered(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), [], ["o_totalprice desc"], key=["o_orderkey"], row_number="rank").select("o_orderkey", "rank")


@query("w3_dedup_latest", "SELECT c_custkey, o_orderkey FROM (SELECT o_custkey AS c_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def w3(spark, sf):
    o = table(spark, sf, "orders").select(c("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderdate")
    return windows.dedup_latest(o, ["c_custkey"], ["o_orderdate", "o_orderkey"]).select("c_custkey", "o_orderkey")


@query("w4_last_n", sql(f"SELECT team_name, competition_name, match_key, res AS result, rn AS recency FROM ({_RECENT}) WHERE rn < 6"))
def w4(spark, sf):
    return _recent(spark, sf).select("team_name", "competition_name", "match_key", "result", "recency")


_LAGS = {"previous_position": "position", "previous_points": "points", "previous_matches": "matches_played"}
_W5 = sql("""SELECT standing_key, valid_from, lag(position) OVER w AS previous_position, lag(points) OVER w AS previous_points, lag(matches_played) OVER w AS previous_matches
FROM st_hist WINDOW w AS (PARTITION BY {keys} ORDER BY valid_from, standing_key)""")
_W6 = sql("""SELECT standing_key, valid_from, CAST(row_number() OVER (PARTITION BY {keys} ORDER BY valid_from, standing_key) AS BIGINT) AS snapshot_number,
  count(*) OVER (PARTITION BY {keys}) AS total_snapshots FROM st_hist""")
_ORDER = {"order_by": ["valid_from"], "key": ["standing_key"]}


@query("w5_lag_versions", _W5.replace("{keys}", "standing_key"))
def w5(spark, sf):
    return windows.ordered(fx.standings_history(spark, sf), ["standing_key"], **_ORDER, lag=_LAGS).select("standing_key", "valid_from", *_LAGS)


@query("w5_lag_versions_sliced", _W5.replace("{keys}", "competition_name"))
def w5_sliced(spark, sf):
    return windows.ordered(fx.standings_history(spark, sf), ["competition_name"], **_ORDER, lag=_LAGS).select(
        "standing_key", "valid_from", *_LAGS)


@query("w6_snapshot_number", _W6.replace("{keys}", "standing_key"))
def w6(spark, sf):
    return windows.ordered(fx.standings_history(spark, sf), ["standing_key"], **_ORDER, row_number="snapshot_number", size="total_snapshots").select(
        "standing_key", "valid_from", "snapshot_number", "total_snapshots")


@query("w6_snapshot_number_sliced", _W6.replace("{keys}", "competition_name"))
def w6_sliced(spark, sf):
    return windows.ordered(fx.standings_history(spark, sf), ["competition_name"], **_ORDER, row_number="snapshot_number", size="total_snapshots").select("standing_key", "valid_from", "snapshot_number", "total_snapshots")


@query("w7_previous_version", sql("""
SELECT standing_key, valid_from, points FROM (SELECT *, row_number() OVER (PARTITION BY standing_key ORDER BY valid_from DESC) AS rn FROM st_hist WHERE valid_to IS NOT NULL) WHERE rn = 1"""))
def w7(spark, sf):
    closed = fx.standings_history(spark, sf).filter(~c("is_current"))
    return windows.first_per_group(closed, ["standing_key"], ["valid_from desc"]).select("standing_key", "valid_from", "points")


@query("w8_first_value", sql("""
SELECT player_season_key, first_value(team_name) OVER (PARTITION BY player_name ORDER BY season DESC, minutes DESC) AS current_team FROM s_players"""))
def w8(spark, sf):
    p = windows.group_value(fx.silver_players(spark, sf), ["player_name"], current_team=agg.latest_value("team_name", "season", "minutes"))
    return p.select("player_season_key", "current_team")


@query("w9_group_max_rows", "SELECT l_orderkey, l_linenumber, l_partkey, max(l_quantity) OVER (PARTITION BY l_returnflag) AS top FROM lineitem")
def w9(spark, sf):
    li = windows.group_value(table(spark, sf, "lineitem"), ["l_returnflag"], top=F.max("l_quantity"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "top")


# --- T ------------------------------------------------------------------------------
@query("t1_order_by", sql("SELECT competition_name, season, position, team_name FROM s_st WHERE position < 4 ORDER BY ALL"))
def t1(spark, sf):
    st = fx.standings_history(spark, sf).filter("position < 4")
    return st.select("competition_name", "season", "position", "team_name").orderBy("competition_name", "season", "position", "team_name")


@query("t2_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def t2(spark, sf):
    return filters.top(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), [c("o_totalprice").desc(), c("o_orderkey")], 20)


@query("t3_top_k_expression", sql("SELECT player_season_key, goals, xg FROM s_players WHERE minutes >= 450 ORDER BY goals * 100 - xg_c DESC, player_season_key LIMIT 20"))
def t3(spark, sf):
    p = fx.silver_players(spark, sf).filter("minutes >= 450").select("player_season_key", "goals", "xg")
    return filters.top(p, [(c("goals") - c("xg").cast("decimal(9,2)")).desc(), c("player_season_key")], 20)


@query("t4_preview", "SELECT 10 AS rows")
def t4(spark, sf):
    return table(spark, sf, "orders").limit(10).agg(F.count(F.lit(1)).cast("int").alias("rows"))


# --- U ------------------------------------------------------------------------------
@query("u1_two_sided", sql("""
SELECT match_key, match_date, competition_name, team_name, opponent, gf AS goals_scored, ga AS goals_conceded, CASE WHEN gf > ga THEN 'W' WHEN gf = ga THEN 'D' ELSE 'L' END AS result,
  CASE WHEN gf > ga THEN 3 WHEN gf = ga THEN 1 ELSE 0 END AS points, venue FROM x_sides"""))
def u1(spark, sf):
    return sides.two_sided(filters.finished(fx.silver_xg_matches(spark, sf)), carry=("match_key", "match_date", "competition_name"))


@query("u2_stack_statistics", """
SELECT 'orders' AS table_name, count(*) AS total, max(o_orderdate) AS latest FROM orders UNION ALL SELECT 'lineitem', count(*), max(l_shipdate) FROM lineitem""")
def u2(spark, sf):
    dates = {"orders": "o_orderdate", "lineitem": "l_shipdate"}
    return sides.stack_all([
        table(spark, sf, n).agg(F.count(F.lit(1)).alias("total"), F.max(d).alias("latest")).select(F.lit(n).alias("table_name"), "*") for n, d in dates.items()])
