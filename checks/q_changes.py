"""Change history (C) and silver transforms (M) against SQL."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.fixtures import LOADED, RELOADED, SCD_HASH, table
from checks.registry import SQL, query
from checks.sql import rdiv, rh, sk, sql
from touchline.operators import changes, filters, sides
from touchline.plans import silver
from touchline.session import shared_dir, stored
from touchline.sources import pages, payloads, tables

c = F.col
_HIST = "k, status, amount::DOUBLE AS amount, record_hash, valid_from, valid_to, is_current"


def _plain(df):
    return df.select("k", "status", c("amount").cast("double").alias("amount"), "record_hash", "valid_from", "valid_to", "is_current")


def _classified(spark, sf):
    one, two = fx.scd_prepared(spark, sf)
    return changes.classify(two, one, ["k"])


@query("c1_record_hash", f"SELECT o_orderkey AS k, {rh('o_orderstatus', 'CAST(o_totalprice AS DECIMAL(12,2))')} AS record_hash FROM orders")
def c1(spark, sf):
    return changes.with_hash(fx.scd_batches(spark, sf)[0], SCD_HASH).select("k", "record_hash")


@query("c2_stamp_version", f"""
SELECT o_orderkey AS k, TIMESTAMP '{LOADED}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current, TIMESTAMP '{LOADED}' AS transformed_at FROM orders""")
def c2(spark, sf):
    return changes.stamp_version(fx.scd_batches(spark, sf)[0].select("k"), LOADED)


@query("c3_classify", sql("""
SELECT k, CASE WHEN in_new THEN nh END AS new_hash, CASE WHEN in_old THEN oh END AS existing_hash, action FROM scd_act"""))
def c3(spark, sf):
    return _classified(spark, sf)


@query("c4_close_versions", sql(f"SELECT {_HIST} FROM scd_hist WHERE valid_to IS NOT NULL"))
def c4(spark, sf):
    one, _ = fx.scd_prepared(spark, sf)
    return _plain(changes.close_versions(one, _classified(spark, sf).filter("action = 'UPDATE'"), ["k"], RELOADED))


@query("c5_append_versions", sql(f"SELECT {_HIST} FROM scd_hist WHERE valid_from = TIMESTAMP '{RELOADED}'"))
def c5(spark, sf):
    _, two = fx.scd_prepared(spark, sf)
    return _plain(changes.append_versions(two, _classified(spark, sf), ["k"]))


_ORDERS = changes.TableConfig("orders_history", lambda d: d, ("k",), SCD_HASH)


def _stored(spark, sf, batches):
    """A history table on disk after the first ``batches`` loads, and its statistics."""
    path = f"{shared_dir(spark)}/orders_history-{uuid4().hex}"
    stats = [tables.load_batch(spark, path, _ORDERS, rows, f"b{i}", ts)
             for i, (rows, ts) in enumerate(zip(fx.scd_batches(spark, sf)[:batches], (LOADED, RELOADED)))]
    return path, stats


@query("c6_initial_load", f"""
SELECT o_orderkey AS k, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(12,2))::DOUBLE AS amount, {rh('o_orderstatus', 'CAST(o_totalprice AS DECIMAL(12,2))')} AS record_hash,
  TIMESTAMP '{LOADED}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TRUE AS is_current FROM orders""")
def c6(spark, sf):
    path, _ = _stored(spark, sf, 1)
    return _plain(tables.read_history(spark, path))


@query("c4_ends_of_appended_versions", sql(f"SELECT {_HIST} FROM scd_hist"))
def c4_stored(spark, sf):
    """The history of two appended loads: ends of versions follow from the next ones."""
    return _plain(tables.read_history(spark, _stored(spark, sf, 2)[0]))


@query("c5_settled_history", sql(f"SELECT {_HIST} FROM scd_hist"))
def c5_settled(spark, sf):
    """The same after the tail was settled into a new base and a closed part."""
    path, _ = _stored(spark, sf, 2)
    tables.settle(spark, path)
    return _plain(tables.read_history(spark, path))


_STATS = sql("""
SELECT 'orders_history' AS table_name, {source}count(*) FILTER (action = 'INSERT') AS new_records, count(*) FILTER (action = 'UPDATE') AS updated_records,
  count(*) FILTER (action = 'UNCHANGED') AS unchanged_records, count(*) FILTER (action = 'DELETE') AS deleted_records FROM scd_act""")


@query("c7_scd2_stats", _STATS.replace("{source}", "count(*) FILTER (action <> 'DELETE') AS source_count, "))
def c7(spark, sf):
    return changes.action_counts(_classified(spark, sf), "orders_history")


@query("c7_scd2_stats_of_load", _STATS.replace("{source}", ""))
def c7_load(spark, sf):
    return _stored(spark, sf, 2)[1][-1]


@query("c8_incremental_delta", sql("SELECT k, n_status AS status, nh AS record_hash FROM scd_act WHERE action IN ('INSERT', 'UPDATE')"))
def c8(spark, sf):
    from touchline.operators.joins import new_or_changed

    one, two = fx.scd_prepared(spark, sf)
    return new_or_changed(two, one, ["k"]).select("k", "status", "record_hash")


@query("c9_version_key", sql(f"SELECT k, valid_from, {sk('k', 'valid_from')} AS version_key FROM scd_hist"))
def c9(spark, sf):
    return fx.scd_history(spark, sf).select("k", "valid_from", changes.version_key("k").alias("version_key"))


@query("c10_upsert_type1", sql("""
SELECT k, CASE WHEN in_new THEN n_status ELSE o_status END AS status, CAST(CASE WHEN in_old THEN o_amount ELSE n_amount END AS DOUBLE) AS amount FROM scd_act"""))
def c10(spark, sf):
    one, two = fx.scd_batches(spark, sf)
    two = two.withColumn("amount", c("amount") + c("amount") * (c("k") < 1_000_000_000).cast("int")).withColumn("amount", c("amount").cast("decimal(12,2)"))
    return changes.upsert_type1(one, two, ["k"], ["status"]).select("k", "status", c("amount").cast("double").alias("amount"))


@query("c10_merge_matches", sql("""
SELECT match_id, CASE WHEN competition_name = 'Eredivisie' THEN 'AWARDED' ELSE match_status END AS match_status, home_goals + CASE WHEN competition_name = 'Eredivisie' THEN 1 ELSE 0 END AS home_goals,
  stage, CASE WHEN competition_name = 'Eredivisie' THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-01-01' END AS valid_from FROM s_matches"""))
def c10_matches(spark, sf):
    config = silver.CONFIGS["stg_matches"]
    rows = fx.silver_matches(spark, sf)
    changed = rows.filter("competition_name = 'Eredivisie'").withColumns({
        "match_status": F.lit("AWARDED"), "home_goals": c("home_goals") + 1, "stage": F.lit("not merged")})
    merged = silver.merge_matches(changes.prepare(rows, config.keys, config.hash_cols, LOADED), changes.prepare(changed, config.keys, config.hash_cols, RELOADED))
    return merged.select("match_id", "match_status", "home_goals", "stage", "valid_from")


@query("c11_history_counts", sql("""
SELECT 'orders' AS table_name, count(*) AS total_records, count(*) FILTER (is_current) AS current_records, count(*) FILTER (NOT is_current) AS historical_records FROM scd_hist
UNION ALL SELECT 'standings', count(*), count(*) FILTER (valid_to IS NULL), count(*) FILTER (valid_to IS NOT NULL) FROM st_hist"""))
def c11(spark, sf):
    return sides.history_counts({"orders": fx.scd_history(spark, sf), "standings": fx.standings_history(spark, sf)})


@query("c12_read_current", sql("SELECT k, status FROM scd_hist WHERE is_current"))
def c12_current(spark, sf):
    path, _ = _stored(spark, sf, 2)
    return filters.current(tables.read_history(spark, path)).select("k", "status")


@query("c12_read_as_of", sql("SELECT k, status FROM scd1"))
def c12_as_of(spark, sf):
    path, _ = _stored(spark, sf, 2)
    return filters.as_of(tables.read_history(spark, path), "2024-01-15").select("k", "status")


@query("c12_current_of_table", sql("SELECT k, status FROM scd_hist WHERE is_current"))
def c12_table(spark, sf):
    return tables.read_current(spark, _stored(spark, sf, 2)[0]).select("k", "status")


@query("c12_table_as_of", sql("SELECT k, status FROM scd1"))
def c12_table_as_of(spark, sf):
    """Only the attempts of loads up to then are opened."""
    return tables.read_as_of(spark, _stored(spark, sf, 2)[0], "2024-01-15").select("k", "status")


@query("c12_read_versions", sql("SELECT team_name, competition_name, valid_from, position FROM st_hist WHERE team_name LIKE 'T01%'"))
def c12_versions(spark, sf):
    rows = filters.versions(fx.standings_history(spark, sf), F.startswith("team_name", F.lit("T01")))
    return rows.select("team_name", "competition_name", "valid_from", "position")


_CONFIGURED = {"stg_matches": ("s_matches", "match_id", "match_status || ':' || home_goals || '-' || away_goals"), "stg_teams": ("s_teams", "team_id", "team_name || ':' || stadium_name"),
               "stg_fbref_matches": ("s_xg", "match_key", "home_team_name || ':' || competition_code"),
               "stg_fbref_standings": ("(SELECT * FROM s_st QUALIFY row_number() OVER (PARTITION BY standing_key ORDER BY ingested_at DESC) = 1)", "standing_key", "position || ':' || points"),
               "stg_players": ("s_players", "player_season_key", "team_name || ':' || minutes")}


def _run_configs(spark, sf):
    """The first load of every configured table."""
    sources = {"stg_matches": fx.bronze_matches, "stg_teams": fx.bronze_teams, "stg_fbref_matches": fx.bronze_xg_matches,
               "stg_fbref_standings": fx.bronze_xg_standings, "stg_players": fx.bronze_players}
    return {name: (config, changes.run_config(config, sources[name](spark, sf), None, LOADED)) for name, config in silver.CONFIGS.items()}


@query("c13_run_configs", sql(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows, count(DISTINCT {k}) AS keys FROM {t}" for n, (t, k, _) in _CONFIGURED.items())))
def c13(spark, sf):
    return sides.stack_all([h.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(config.keys[0]).alias("keys")).select(F.lit(name).alias("table_name"), "*")
                            for name, (config, h) in _run_configs(spark, sf).items()])


@query("c13_config_rows", sql(" UNION ALL ".join(
    f"SELECT '{n}' AS table_name, CAST({k} AS VARCHAR) AS key, {v} AS value, TIMESTAMP '{LOADED}' AS valid_from, TRUE AS is_current FROM {t}" for n, (t, k, v) in _CONFIGURED.items())))
def c13_rows(spark, sf):
    return sides.stack_all([h.select(F.lit(n).alias("table_name"), c(_CONFIGURED[n][1]).cast("string").alias("key"), F.expr(_CONFIGURED[n][2]).alias("value"), "valid_from", "is_current")
                            for n, (_, h) in _run_configs(spark, sf).items()])


@query("c14_check_scd2", sql("""
SELECT 'single_current' AS rule, count(*) AS failed FROM (SELECT k // 2 AS k FROM scd_hist WHERE is_current GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'valid_dates', count(*) FILTER (NOT is_current AND k % 3 = 0) FROM scd_hist"""))
def c14(spark, sf):
    h = fx.scd_history(spark, sf).withColumn("valid_to", F.when(c("k") % 3 != 0, c("valid_to"))).withColumn("half", F.floor(c("k") / 2))
    return changes.integrity(h, ["half"])


@query("c15_purge_deleted", sql(f"""
SELECT k, status, amount::DOUBLE AS amount, record_hash, valid_from, CASE WHEN gone THEN TIMESTAMP '{RELOADED}' ELSE valid_to END AS valid_to, is_current AND NOT gone AS is_current
FROM (SELECT h.*, a.action = 'DELETE' AS gone FROM scd_hist h JOIN scd_act a USING (k))"""))
def c15(spark, sf):
    return _plain(fx.scd_history(spark, sf, deletes="close"))


# --- M ------------------------------------------------------------------------------
@query("m1_silver_matches", sql("SELECT * FROM s_matches"))
def m1(spark, sf):
    return fx.silver_matches(spark, sf)


@query("m1_silver_matches_payload", sql("""
SELECT match_id, competition_code, competition_name, season, matchday, played_at AS match_datetime, match_date, status AS match_status, home_team_id, home_team_name, away_team_id,
  away_team_name, home_score AS home_goals, away_score AS away_goals, status = 'FINISHED' AS is_finished,
  CASE sign(home_score - away_score) WHEN 1 THEN 'HOME' WHEN -1 THEN 'AWAY' WHEN 0 THEN 'DRAW' END AS match_result, home_score - away_score AS goal_difference,
  home_score + away_score AS total_goals FROM fx"""))
def m1_payload(spark, sf):
    raw = fx.fx_matches(spark, sf).withColumn("match_date", F.date_format("played_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return silver.payload_matches(raw)


@query("m2_silver_teams", sql("SELECT * FROM s_teams"))
def m2(spark, sf):
    return fx.silver_teams(spark, sf)


@query("m3_silver_xg_matches", sql("SELECT * EXCLUDE (home_xg_c, away_xg_c) FROM s_xg_rows"))
def m3(spark, sf):
    return silver.xg_matches(fx.bronze_xg_matches(spark, sf))


@query("m4_silver_standings", sql("SELECT * EXCLUDE (xg_c, xga_c) FROM s_st"))
def m4(spark, sf):
    return silver.xg_standings(fx.bronze_xg_standings(spark, sf))


@query("m4_silver_standings_payload", sql(f"""
SELECT competition_code, competition_name, team_id, team_name, position, p AS matches_played, w AS wins, d AS draws, p - w - d AS losses, pts AS points, gf AS goals_for, ga AS goals_against,
  gd AS goal_difference, {rdiv('pts', 'p', 2)} AS points_per_game,
  CASE WHEN position < 5 THEN 'Champions League' WHEN position < 7 THEN 'Europa League' WHEN position = 7 THEN 'Conference League' WHEN position > 15 THEN 'Relegation' ELSE 'Mid-table' END AS table_zone
FROM st_base"""))
def m4_payload(spark, sf):
    return silver.payload_standings(fx.bronze_standings(spark, sf))


@query("m5_silver_players", sql("SELECT * EXCLUDE (xg_c, npxg_c, xa_c, record_hash) FROM s_players"))
def m5(spark, sf):
    return fx.silver_players(spark, sf)


_PAGE = {
    "standard": {"Unnamed_Player": "player_name", "Unnamed_Nation": "nationality", "Unnamed_Pos": "position", "Unnamed_Squad": "team_name", "Unnamed_Age": "age",
                 "Unnamed_Born": "birth_year", "Playing Time_MP": "matches_played", "Playing Time_Starts": "starts", "Playing Time_Min": "minutes",
                 "Performance_Gls": "goals", "Performance_Ast": "assists", "Performance_PK": "penalty_goals", "Performance_CrdY": "yellow_cards", "Expected_xG": "xg"},
    "shooting": {"x_Player": "player_name", "x_Squad": "team_name", "Standard_Sh": "shots", "Standard_SoT": "shots_on_target", "Standard_SoT%": "shot_accuracy"},
    "passing": {"x_Player": "player_name", "x_Squad": "team_name", "Total_Cmp": "passes_completed", "Total_Att": "passes_attempted", "Long_KP": "key_passes"},
    "defense": {"x_Player": "player_name", "x_Squad": "team_name", "Tackles_Tkl": "tackles", "Tackles_TklW": "tackles_won", "Int": "interceptions"},
    "gca": {"x_Player": "player_name", "x_Squad": "team_name", "SCA_SCA": "sca", "SCA_SCA90": "sca_per90"},
}


@query("m6_bronze_player_stats", sql("""
SELECT player_name, team_name, nationality, position, age, birth_year, matches_played, starts, minutes, goals, assists, penalty_goals, yellow_cards, xg, CAST(NULL AS DOUBLE) AS npxg,
  CASE WHEN minutes % 2 = 0 THEN shots END AS shots, CASE WHEN minutes % 2 = 0 THEN shots_on_target END AS shots_on_target, CASE WHEN minutes % 2 = 0 THEN shot_accuracy_pct END AS shot_accuracy,
  passes_completed, passes_attempted, key_passes, tackles, tackles_won, interceptions, sca, sca_per90, CAST(NULL AS INTEGER) AS gca, 'standard' AS stat_type, competition_name, season
FROM s_players"""))
def m6(spark, sf):
    """Five stat tables with web-page headers and text cells, put together again."""
    p = fx.bronze_players(spark, sf)
    pages_of = ["competition_name", "season"]

    def page(name, rows):
        return rows.select(*pages_of, *[c(src).cast("string").alias(head) for head, src in _PAGE[name].items()], F.lit(1).alias("row_no"))

    others = {n: page(n, p.filter("minutes % 2 = 0") if n == "shooting" else p) for n in ("shooting", "passing", "defense", "gca")}
    out = pages.player_stats(page("standard", p), others, page_keys=pages_of, batch_ts=LOADED)
    return out.select("player_name", "team_name", "nationality", "position", "age", "birth_year", "matches_played", "starts", "minutes", "goals", "assists", "penalty_goals",
                      "yellow_cards", "xg", "npxg", "shots", "shots_on_target", "shot_accuracy", "passes_completed", "passes_attempted", "key_passes", "tackles", "tackles_won",
                      "interceptions", "sca", "sca_per90", "gca", "stat_type", "competition_name", "season")


_LEVEL = {"Unnamed": "", "x": ""}


def _stat_pages(rows, name):
    """Pages of at most a hundred players each.  Every page's header is one of three: two levels with column spans, one level
    with joined names and the columns in reverse, two levels with row spans and a column that nobody asked for."""
    heads = [(h.partition("_")[0] if "_" in h else "", h.partition("_")[2] or h, src) for h, src in _PAGE[name].items()]
    heads = [(_LEVEL.get(up, up), low, src) for up, low, src in heads]

    def cell(src):
        return F.concat(F.lit("<td>"), F.coalesce(c(src).cast("string"), F.lit("")), F.lit("</td>"))

    def th(text, more=""):
        return f"<th{more}>{text}</th>"

    groups = []
    for up, _, _ in heads:
        if groups and groups[-1][0] == up:
            groups[-1][1] += 1
        else:
            groups.append([up, 1])
    spans = "".join(th(up, f' colspan="{n}"') for up, n in groups)
    two = f"<thead><tr>{spans}</tr><tr>{''.join(th(low) for _, low, _ in heads)}</tr></thead>"
    one = f"<tr>{''.join(th(f'{up}_{low}' if up else low) for up, low, _ in heads[::-1])}</tr>"
    tall = "".join(th(low, ' rowspan="2"') if not up else th(up) for up, low, _ in heads) + th("Rank", " rowspan=2")
    low_row = "".join(th(low) for up, low, _ in heads if up)
    three = f"<thead><tr>{tall}</tr><tr>{low_row}</tr></thead>"
    part = F.floor(F.substring("player_name", 10, 9).cast("long") / 100)
    kind = part % 3
    wrap = [F.concat(F.lit("<tr>"), *[cell(src) for _, _, src in order], F.lit(end)) for order, end in ((heads, "</tr>"), (heads[::-1], "</tr>"), (heads, "<td>7</td></tr>"))]
    row = F.when(kind == 0, wrap[0]).when(kind == 1, wrap[1]).otherwise(wrap[2])
    body = F.array_join(F.array_sort(F.collect_list(row)), "")
    pages_of = rows.withColumn("part", part.cast("string")).groupBy("competition_name", "season", "part").agg(body.alias("body"))
    head = F.when(c("part") % 3 == 0, two).when(c("part") % 3 == 1, one).otherwise(three)
    decoy = "<table><tr><th>Menu</th></tr><tr><td>Player</td></tr></table>"
    return pages_of.select("competition_name", "season", "part", F.concat(F.lit(f"<html>{decoy}<table>"), head, c("body"), F.lit("</table></html>")).alias("html"))


@query("m6_bronze_player_pages", SQL["m6_bronze_player_stats"])
def m6_pages(spark, sf):
    """The same tables as stored pages, whose headers differ from page to page."""
    # Five kinds of pages are made of these rows: computed once.
    p = stored(fx.bronze_players(spark, sf).select("competition_name", "season", *{src: None for page in _PAGE.values() for src in page.values()}))
    found = {n: _stat_pages(p.filter("minutes % 2 = 0") if n == "shooting" else p, n) for n in _PAGE}
    out = pages.player_stats_of_pages(found, batch_ts=LOADED, parts=["part"])
    return out.select(*m6(spark, sf).columns)
