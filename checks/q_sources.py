"""Sources and sinks (S) against SQL."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.fixtures import table
from checks.registry import query
from checks.sql import CODE, sql, units
from touchline.functions.text import tolerant_double, tolerant_int
from touchline.session import shared_dir
from touchline.sources import pages, payloads, rejects, schemas, tables

c = F.col
_SCORES = "home_score_fulltime, away_score_fulltime, home_score_halftime, away_score_halftime, winner"
_LOST = ", ".join(f"CASE WHEN match_id % 7 <> 0 THEN {n} END AS {n}" for n in _SCORES.split(", "))


def _parsed(docs, schema):
    return payloads.parse_payloads(fx.as_text(docs), "body", schema)


@query("s1_flatten_matches", sql(f"SELECT * EXCLUDE ({_SCORES}), {_LOST} FROM b_matches"))
def s1(spark, sf):
    return payloads.flatten_matches(_parsed(fx.match_payloads(spark, sf), schemas.MATCH_PAYLOAD))


@query("s2_flatten_teams", sql("""
SELECT t.team_id, name AS team_name, short_name, lower(team_code) AS tla, logo_url AS crest_url, ' ' || address AS address, website,
  founded_year AS founded, club_colors, ' ' || stadium_name || '' AS venue, competition_id, competition_name, loaded_at AS ingest_timestamp
FROM s_teams t CROSS JOIN LATERAL (VALUES (' ' || team_name || ' ', '2024-01-01T00:00:00'), ('Old ' || short_name, '2023-01-01T00:00:00')) v(name, loaded_at)"""))
def s2(spark, sf):
    return payloads.flatten_teams(_parsed(fx.team_payloads(spark, sf), schemas.TEAM_PAYLOAD))


@query("s3_flatten_standings", sql("""
SELECT competition_code, competition_name, position, team_id, team_name, p AS played_games, w AS won, d AS draw, p - w - d AS lost, pts AS points,
  gf AS goals_for, ga AS goals_against, gd AS goal_difference, CAST(taken AS VARCHAR) AS ingest_timestamp
FROM st_base WHERE month(taken) % 6 <> 5"""))
def s3(spark, sf):
    return payloads.flatten_standings(_parsed(fx.standings_payloads(spark, sf), schemas.STANDING_PAYLOAD))


@query("s4_html_rows", r"""
SELECT url, CAST(0 AS INTEGER) AS table_no, CAST(n - 1 AS INTEGER) AS row_no,
  list_transform(regexp_extract_all(part, '(?s)<li>(.*?)</li>', 1), lambda x: replace(trim(regexp_replace(x, '<[^>]*>', '', 'g')), '&amp;', '&')) AS cells
FROM (SELECT CAST(page_id AS VARCHAR) AS url, unnest(parts) AS part, generate_subscripts(parts, 1) AS n
  FROM (SELECT page_id, regexp_extract_all(html, '(?s)<ul>.*?</ul>') AS parts FROM pages))""")
def s4(spark, sf):
    return pages.html_rows(table(spark, sf, "pages"), url="page_id", table_tag=None, row_tag="ul", cell_tags=("li",))


@query("s5_flatten_header", """
SELECT l_returnflag AS key_flag, count(*) AS sum_rows, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sum_qty FROM lineitem GROUP BY ALL""")
def s5(spark, sf):
    g = table(spark, sf, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)), F.sum(c("l_quantity").cast("long")))
    return g.toDF(*pages.flatten_header(["key", "sum", "sum"], ["flag", "rows", "qty"]))


@query("s6_resolve_column", """
SELECT l_quantity AS by_exact, l_partkey AS by_suffix, l_shipdate AS by_parts, l_orderkey AS by_first, CAST(NULL AS INTEGER) AS absent FROM lineitem""")
def s6(spark, sf):
    df = table(spark, sf, "lineitem")
    pick = pages.resolve_column
    return df.select(
        pick(df, exact=("l_quantity",)).alias("by_exact"), pick(df, suffix=("_partkey",)).alias("by_suffix"),
        pick(df, contains=("ship", "date")).alias("by_parts"), pick(df, contains=("key",), without=("part",)).alias("by_first"),
        pick(df, contains=("referee",), type="int").alias("absent"))


@query("s7_dynamic_stats", """
SELECT c_custkey, stat, value FROM (
  SELECT c_custkey, 'stat_acct_bal' AS stat, CAST(CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS DECIMAL(12,2)) END AS VARCHAR) AS value FROM customer
  UNION ALL SELECT c_custkey, 'stat_mkt_segment', c_mktsegment FROM customer
  UNION ALL SELECT c_custkey, 'stat_nation', CAST(c_nationkey AS VARCHAR) FROM customer) WHERE value IS NOT NULL""")
def s7(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey", F.when(c("c_acctbal") >= 0, c("c_acctbal").cast("decimal(12,2)")).alias("Acct Bal"),
        c("c_mktsegment").alias("Mkt-Segment"), c("c_nationkey").alias("Nation"))
    return pages.long_stats(df, ["c_custkey"])


@query("s8_bronze_from_rows", "SELECT o_orderstatus AS status, o_orderkey AS match_id, CAST(NULL AS VARCHAR) AS winner FROM orders")
def s8(spark, sf):
    rows = table(spark, sf, "orders").select(c("o_orderkey").alias("match_id"), "o_totalprice", c("o_orderstatus").alias("status"))
    return payloads.enforce(rows, "status string, match_id long, winner string")


@query("s9_scan_table", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def s9(spark, sf):
    return tables.scan_table(spark, f"{sf}/orders.parquet").filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")


@query("s10_write_overwrite", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def s10(spark, sf):
    path = f"{shared_dir(spark)}/overwrite-{uuid4().hex}"
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    tables.write_overwrite(rows, path)
    tables.write_overwrite(rows.filter("o_orderstatus = 'F'"), path)
    return tables.scan_table(spark, path)


@query("s11_write_append", "SELECT o_orderstatus, 2 * count(*) AS rows FROM orders GROUP BY ALL")
def s11(spark, sf):
    path = f"{shared_dir(spark)}/append-{uuid4().hex}"
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    for _ in range(2):
        tables.write_append(rows, path)
    return tables.scan_table(spark, path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows"))


_LAYOUT = {"bronze": ("orders", "lineitem"), "silver": ("customer",), "gold": ("supplier", "part")}


def _layers(spark, sf):
    """The given tables registered as external tables of three layers."""
    layers = tables.setup_layers(spark, shared_dir(spark), prefix="tl_")
    for layer, names in _LAYOUT.items():
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS tl_{layer}.{n}")
            spark.catalog.createTable(f"tl_{layer}.{n}", path=f"{sf}/{n}.parquet", source="parquet")
    return layers


_COUNTS = " UNION ALL ".join(f"SELECT 'tl_{layer}' AS layer, '{n}' AS table_name, count(*) AS rows FROM {n}" for layer, ns in _LAYOUT.items() for n in ns)


@query("s12_setup_layers", f"SELECT layer, count(*) AS tables, CAST(sum(rows) AS BIGINT) AS rows FROM ({_COUNTS}) GROUP BY layer")
def s12(spark, sf):
    inventory = tables.table_inventory(spark, _layers(spark, sf))
    return inventory.groupBy("layer").agg(F.count(F.lit(1)).alias("tables"), F.sum("rows").alias("rows"))


@query("s13_table_exists", """
SELECT 'orders' AS table_name, TRUE AS found, count(*) AS rows FROM orders UNION ALL SELECT 'nowhere', FALSE, 0""")
def s13(spark, sf):
    _layers(spark, sf)
    parts = []
    for n in ("orders", "nowhere"):
        found = tables.table_exists(spark, f"tl_bronze.{n}")
        df = tables.scan_table(spark, f"tl_bronze.{n}") if found else table(spark, sf, "orders").limit(0)
        parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), F.lit(found).alias("found"), "rows"))
    return parts[0].unionByName(parts[1])


@query("s14_table_inventory", _COUNTS)
def s14(spark, sf):
    return tables.table_inventory(spark, _layers(spark, sf))


@query("s15_stamp_provenance", """
SELECT o_orderkey, 'orders' AS source, '2024-01-01T00:00:00' AS ingest_timestamp, 'Eredivisie' AS competition_name, '2024' AS season FROM orders""")
def s15(spark, sf):
    return payloads.stamp_provenance(table(spark, sf, "orders").select("o_orderkey"), "orders", fx.LOADED, competition_name="Eredivisie", season="2024")


@query("s16_union_batches", sql(f"""
SELECT match_id, competition_name, {CODE} AS batch_code, CASE WHEN competition_name = 'Eredivisie' THEN home_score END AS home_score
FROM fx WHERE competition_name <> 'Other League'"""))
def s16(spark, sf):
    m = fx.fx_matches(spark, sf)

    def load(row):
        _, _, code, name = row
        if code == "XX":
            return None  # this league failed to load
        cols = ["match_id", "competition_name", F.lit(code).alias("batch_code")]
        return m.filter(c("competition_name") == name).select(*cols, *(["home_score"] if code == "DED" else []))

    return payloads.union_batches([load(r) for r in fx.LEAGUES])


@query("s17_tolerant_cast", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN CAST(trunc(o_totalprice) AS INTEGER) WHEN o_orderkey % 4 = 1 THEN CAST(o_orderkey AS INTEGER) END AS as_int,
  CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice WHEN o_orderkey % 4 = 1 THEN CAST(o_orderkey AS DOUBLE) END AS as_double FROM orders""")
def s17(spark, sf):
    k = c("o_orderkey")
    text = (F.when(k % 4 == 0, c("o_totalprice").cast("string")).when(k % 4 == 1, F.concat(F.lit(" "), k.cast("string"), F.lit(".0")))
            .when(k % 4 == 2, "nan").otherwise(c("o_orderpriority")))
    df = table(spark, sf, "orders").select("o_orderkey", text.alias("t"))
    return df.select("o_orderkey", tolerant_int("t").alias("as_int"), tolerant_double("t").alias("as_double"))


@query("s17_rejected_rows", """
SELECT reason, count(*) AS rows, min(o_orderkey) AS first_key FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 2 THEN 'price: missing' WHEN 3 THEN 'price: not a number' END AS a,
  CASE WHEN o_orderkey % 5 = 0 THEN 'day: not a date' END AS b FROM orders), LATERAL (SELECT unnest(CASE WHEN a IS NULL AND b IS NULL THEN ['kept'] ELSE [a, b] END) AS reason) WHERE reason IS NOT NULL GROUP BY reason""")
def s17_rejected(spark, sf):
    """Rows whose texts can't be read go to a part of their own, with every reason."""
    k = c("o_orderkey")
    price = F.when(k % 4 < 2, c("o_totalprice").cast("string")).when(k % 4 == 2, " nan ").otherwise(c("o_orderpriority"))
    rows = table(spark, sf, "orders").select("o_orderkey", price.alias("price"), F.when(k % 5 == 0, "some day").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"))
    routed = rejects.route(rows, {"price": "double", "day": "date"}, f"{shared_dir(spark)}/routed-{uuid4().hex}")
    counted = spark.createDataFrame(list(routed.counts.items()), "reason string, rows long")
    first = routed.rejected.select(F.explode("reasons").alias("reason"), F.get_json_object("row", "$.o_orderkey").cast("long").alias("k"))
    first = first.unionByName(routed.kept.select(F.lit("kept").alias("reason"), c("o_orderkey").alias("k")))
    return counted.join(first.groupBy("reason").agg(F.min("k").alias("first_key")), "reason")


# --- page tables to bronze -----------------------------------------------------------
def _html(page: list[str], rows, header: str, cells: list, order: str):
    """One page per ``page`` columns (joined to its url): a decoy table with a nested one, then the table itself."""
    row = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), F.coalesce(x, F.lit("")), F.lit("</td>")) for x in cells], F.lit("</tr>"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), row.alias("r")))), lambda x: x["r"]), "")
    decoy = "<table><tr><th>Menu</th><th><table><tr><td>inner</td></tr></table></th></tr><tr><td>a</td></tr></table>"
    return rows.groupBy(F.concat_ws("|", *page).alias("url")).agg(F.concat(F.lit(f"<html>{decoy}<table>{header}"), body, F.lit("</table></html>")).alias("html"))


def _page_table(found, word, header, header_rows=1):
    body = pages.table_columns(pages.pick_table(pages.html_rows(found), word), header, header_rows)
    url = F.split("url", r"\|")
    return body.withColumns({"competition_name": url[0], "season": url[1]})


def _heads(*names):
    return "<tr>" + "".join(f"<th>{n}</th>" for n in names) + "</tr>"


_SCHEDULE = ["Wk", "Date", "Time", "Home", "xG", "Score", "xG", "Away", "Attendance", "Venue", "Referee"]


@query("m7_bronze_xg_matches", sql(f"""
SELECT 'fbref' AS source, competition_name, season, matchweek, match_date, match_time, home_team_name, away_team_name,
  CAST(home_score AS VARCHAR) AS home_score, CAST(away_score AS VARCHAR) AS away_score, {units('home_xg_c')} AS home_xg, {units('away_xg_c')} AS away_xg,
  attendance, venue, referee, '{fx.LOADED}' AS ingest_timestamp FROM b_xg"""))
def m7(spark, sf):
    """Schedule pages, one per competition, season and day, with the header xG twice."""
    m = fx.bronze_xg_matches(spark, sf)
    score = F.when(c("home_score").isNotNull(), F.concat_ws("–", "home_score", "away_score"))
    cells = [c("matchweek"), c("match_date"), c("match_time"), c("home_team_name"), c("home_xg").cast("string"), score, c("away_xg").cast("string"), c("away_team_name"),
             c("attendance"), c("venue"), c("referee")]
    found = _html(["competition_name", "season", "match_date"], m, _heads(*_SCHEDULE), cells, "home_team_name")
    return pages.match_rows(_page_table(found, "Home", pages.unique_header(_SCHEDULE)), batch_ts=fx.LOADED)


_LEVELS = (["", "", "", "", "", "", "", "", "", "", "Expected", "Expected"], ["Rk", "Squad", "MP", "W", "D", "L", "GF", "GA", "GD", "Pts", "xG", "xGA"])


@query("m8_bronze_xg_standings", sql(f"""
SELECT 'fbref' AS source, competition_name, CAST(season AS VARCHAR) AS season, position, team_name, CAST(p AS INTEGER) AS matches_played, CAST(w AS INTEGER) AS wins, CAST(d AS INTEGER) AS draws,
  CAST(p - w - d AS INTEGER) AS losses, CAST(gf AS INTEGER) AS goals_for, CAST(ga AS INTEGER) AS goals_against, CAST(gd AS INTEGER) AS goal_difference, CAST(pts AS INTEGER) AS points,
  {units('xg')} AS xg, {units('xga')} AS xga, '{fx.LOADED}' AS ingest_timestamp FROM st_base"""))
def m8(spark, sf):
    """Standings pages with a header of two levels."""
    s = fx.bronze_xg_standings(spark, sf)
    cells = [c(n).cast("string") for n in ("position", "team_name", "matches_played", "wins", "draws", "losses", "goals_for", "goals_against", "goal_difference", "points", "xg", "xga")]
    found = _html(["competition_name", "season", "ingest_timestamp"], s, "".join(map(lambda r: _heads(*r), _LEVELS[::-1])), cells, "team_name")
    header = pages.flatten_header(*_LEVELS)
    return pages.standing_rows(_page_table(found, "Squad", header, header_rows=2), batch_ts=fx.LOADED)
