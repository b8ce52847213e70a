"""Payload files, HTML pages, schemas, catalog and the incremental load."""

import json
import random

import pytest
from pyspark.sql import functions as F

from touchline.operators import changes
from touchline.plans import silver
from touchline.sources import pages, payloads, rejects, schemas, tables
from touchline.streaming.ingest import load_new_payloads


def match(i, **extra):
    return {"id": i, "utcDate": "2024-03-01T20:00:00Z", "status": "FINISHED", "matchday": 1, "homeTeam": {"id": 1, "name": "A", "shortName": "a"}, **extra}


SCORE = {"winner": "HOME_TEAM", "fullTime": {"home": 2, "away": 1}, "halfTime": {"home": 1, "away": 0}}


def write(folder, name, doc):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(doc if isinstance(doc, str) else json.dumps(doc))


def test_match_payload_edges(spark, tmp_path):
    write(tmp_path / "m", "a.json", {"competition": {"id": 9, "name": "L", "code": "X"}, "matches": [match(1, score=SCORE), match(2), match(3, awayTeam=None)]})
    write(tmp_path / "m", "b.json", {"competition": {"id": 9, "name": "L", "code": "X"}, "matches": []})
    write(tmp_path / "m", "c.json", "{not json")
    flat = payloads.flatten_matches(payloads.read_payloads(spark, str(tmp_path / "m"), schemas.MATCH_PAYLOAD))
    got = {r.match_id: (r.home_score_fulltime, r.winner, r.away_team_name, r.competition_code) for r in flat.collect()}
    assert got == {1: (2, "HOME_TEAM", None, "X"), 2: (None, None, None, "X"), 3: (None, None, None, "X")}
    assert [f.name for f in flat.schema] == [c.split()[0] for c in schemas.MATCHES.split(", ")]


def test_standings_payload_takes_first_block_only(spark, tmp_path):
    row = {"position": 1, "team": {"id": 5, "name": "T"}, "playedGames": 3, "points": 9}
    for i, blocks in enumerate([[{"table": [row]}, {"table": [{**row, "position": 99}]}], [], None]):
        write(tmp_path / "s", f"{i}.json", {"competition": {"id": 1, "name": "L", "code": "X"}, "standings": blocks})
    flat = payloads.flatten_standings(payloads.read_payloads(spark, str(tmp_path / "s"), schemas.STANDING_PAYLOAD))
    assert [(r.position, r.team_id, r.played_games) for r in flat.collect()] == [(1, 5, 3)]


def test_union_batches_skips_failed_and_fills_missing(spark):
    a, b = spark.range(1).withColumn("x", F.lit(1)), spark.range(1)
    assert sorted((r.id, r.x) for r in payloads.union_batches([a, None, b]).collect() if r.x) == [(0, 1)]


ONE = "<table><tr><th>Rk</th><th>Squad</th></tr><tr><td>1</td><td>A &amp; B</td></tr></table>"
TWO = ("<p>x</p><table><tr><td>other</td></tr></table><table><tr><th>Unnamed</th><th>Performance</th></tr><tr><th>Player</th><th>Gls</th></tr>"
       "<tr><td>Jo<b>e</b><td>3</table>")


def test_html_tables_with_one_and_two_header_rows(spark):
    df = spark.createDataFrame([("u1", ONE), ("u2", TWO), ("u3", None), ("u4", "<p>no table")], "url string, html string")
    rows = pages.html_rows(df)
    assert [tuple(r) for r in pages.pick_table(rows).filter("url = 'u1'").orderBy("row_no").collect()] == [("u1", 0, 0, ["Rk", "Squad"]), ("u1", 0, 1, ["1", "A & B"])]
    chosen = pages.pick_table(rows, "Performance")
    assert {(r.url, r.table_no) for r in chosen.collect()} == {("u2", 1)}
    header = pages.flatten_header(["Unnamed", "Performance"], ["Player", "Gls"])
    assert header == ["Unnamed_Player", "Performance_Gls"]
    body = pages.table_columns(chosen, header, header_rows=2)
    assert [(r["Unnamed_Player"], r["Performance_Gls"]) for r in body.collect()] == [("Joe", "3")]


def test_resolve_column_first_match_or_null(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Standard_SoT` int, `Standard_SoT%` int, `SoT/90` int")
    assert pages.find_column(df.columns, contains=("SoT",), without=("/", "%")) == "Standard_SoT"
    assert pages.find_column(df.columns, contains=("Sh", "90")) is None
    assert df.select(pages.resolve_column(df, exact=("none",), type="double").alias("x")).first().x is None


def test_player_page_enrichment_last_duplicate_wins(spark):
    page = "`Unnamed_Player` string, `Unnamed_Squad` string, `Performance_Gls` string, competition_name string, season string, row_no int"
    std = spark.createDataFrame([("P", "S", "3.0", "L", "24", 2), ("nan", "S", "9", "L", "24", 3), ("Q", "S", "x", "L", "24", 4)], page)
    shots = spark.createDataFrame([("P", "S", "7", "L", "24", 1), ("P", "S", "8", "L", "24", 5)], page.replace("Performance_Gls", "Standard_Sh"))
    got = pages.player_stats(std, {"shooting": shots}, batch_ts="t")
    assert sorted((r.player_name, r.goals, r.shots, r.tackles) for r in got.collect()) == [("P", 3, 8, None), ("Q", None, None, None)]
    assert len(got.columns) == 51


def test_layers_and_inventory(spark, tmp_path):
    assert tables.setup_layers(spark, prefix="x_") == ["x_bronze", "x_silver", "x_gold"]
    spark.range(3).write.mode("overwrite").saveAsTable("x_bronze.t")
    assert tables.table_exists(spark, "x_bronze.t") and not tables.table_exists(spark, "x_bronze.nope")
    assert [tuple(r) for r in tables.table_inventory(spark, ["x_bronze"]).collect()] == [("x_bronze", "t", 3)]


def test_incremental_load_takes_new_files_only(spark, tmp_path):
    config = changes.TableConfig("stg_matches", silver.matches, ("match_id",), ("match_status", "home_goals", "away_goals"), ("ingested_at",))
    table, folder = str(tmp_path / "table"), tmp_path / "in"
    args = (spark, str(folder), schemas.MATCH_PAYLOAD, payloads.flatten_matches, config, table, str(tmp_path / "ckpt"))
    comp = {"id": 9, "name": "L", "code": "X"}
    write(folder, "1.json", {"competition": comp, "matches": [match(1, score=SCORE), match(2)]})
    load_new_payloads(*args)
    write(folder, "2.json", {"competition": comp, "matches": [match(2, score=SCORE)]})
    load_new_payloads(*args)
    load_new_payloads(*args)   # nothing new
    h = tables.read_history(spark, table)
    assert sorted((r.match_id, r.home_goals, r.is_current) for r in h.collect()) == [(1, 2, True), (2, 0, False), (2, 2, True)]


def test_nested_tables_keep_their_numbers(spark):
    html = ("<table><tr><td>a</td></tr><tr><td>x<table><tr><td>in</td></tr></table>y</td><td>z</td></tr><tr><td>b</td></tr></table>"
            "<table><tr><td>c</td></tr></table>")
    df = spark.createDataFrame([("u", html)], "url string, html string")
    got = {(r.table_no, r.row_no, tuple(r.cells)) for r in pages.html_rows(df).collect()}
    assert got == {(0, 0, ("a",)), (1, 0, ("in",)), (0, 1, ("xy", "z")), (0, 2, ("b",)), (2, 0, ("c",))}


def test_one_of_several_parts():
    assert pages.find_column(["x", "Per_G-A", "G+A"], any_of=("G+A", "G-A")) == "Per_G-A"
    assert pages.unique_header(["xG", "a", "xG", "xG"]) == ["xG", "a", "xG.1", "xG.2"]


def grid(html):
    return list(pages._tables(html))


def test_grids_of_spanning_cells():
    spans = [(1, 1, False), (2, 2, False), (1, 1, False)]
    assert pages.fill_grid([(["a", "b", "c"], spans), (["d", "e"], [(1, 1, False)] * 2), (["f"], [(1, 1, False)])]) == [["a", "b", "b", "c"], ["d", "b", "b", "e"], ["f"]]
    assert pages.fill_grid([(["a", "b"], [(1, 1, False), (0 or 3, 1, False)]), (["c"], [(1, 1, False)]), ([], [])]) == [["a", "b"], ["c", "b"], ["", "b"]]
    assert pages.fill_grid([]) == []


def test_headers_are_read_from_the_page():
    two = "<table><thead><tr><th rowspan=2>Player<th colspan='2'>Performance</tr><tr><th>Gls<th>Ast</thead><tr><td>P<td>1<td>2</table>"
    leading = "<table><tr><th><th>Total</tr><tr><th>Player<th>Cmp</tr><tr><th>P<td>3</tr></table>"
    plain = "<table><tr><td>Player<td>xG<td>xG</tr><tr><td>P<td>1<td>2</tr></table>"
    assert grid(two) == [(0, ["Player_Player", "Performance_Gls", "Performance_Ast"], [["P", "1", "2"]])]
    assert grid(leading) == [(0, ["Unnamed: 0_level_0_Player", "Total_Cmp"], [["P", "3"]])]
    assert grid(plain) == [(0, ["Player", "xG", "xG.1"], [["P", "1", "2"]])]
    assert grid("<table></table>") == grid(None) == grid("<tr><td>x") == []
    assert [pages._span(x, 1000) for x in (None, "2", "0", "x", "5000", " 3 ", "-1")] == [1, 2, 1, 1, 1000, 3, 1] and pages._span("0", 65534) == 65534


def test_every_page_is_resolved_by_its_own_header(spark):
    html = [("a", "<table><tr><th>menu</th></tr></table><table><tr><th>Player</th><th>Gls</th></tr><tr><td>P</td><td>1</td></tr></table>"),
            ("b", "<table><thead><tr><th colspan=2>Performance</th><th rowspan=2>Player</th></tr><tr><th>Ast</th><th>Gls</th></tr></thead><tr><td>9</td><td>2</td><td>Q</td></tr><tr><td>8</td></tr></table>"),
            ("c", "<table><tr><th>Player</th></tr><tr><td>R</td></tr></table>"), ("d", None), ("e", "<p>none")]
    df = spark.createDataFrame(html, "url string, html string")
    wanted = {"who": {"contains": ("Player",)}, "goals": {"exact": ("Gls",), "suffix": ("_Gls",)}}
    got = sorted(map(tuple, pages.page_columns(df, wanted, "Player").collect()))
    assert got == [("a", 0, "P", "1"), ("b", 0, "Q", "2"), ("b", 1, None, None), ("c", 0, "R", None)]
    assert pages.page_columns(df.limit(0), wanted).collect() == []


def test_rows_go_by_reason(spark, tmp_path):
    rows = [("1.5", "7", "2024-01-01", "a"), ("x", " ", "2024-13-01", "b"), ("nan", "99999999999", None, None), (None, "3", "2024-02-02", " "), ("2", "4.9", "2024-02-03", "c")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, d string, n string, day string, s string")
    got = rejects.route(df, {"d": "double", "n": "int", "day": "date", "s": "string"}, str(tmp_path / "r"))
    assert sorted((r.id, r.d, r.n, str(r.day), r.s) for r in got.kept.collect()) == [(0, 1.5, 7, "2024-01-01", "a"), (4, 2.0, 4, "2024-02-03", "c")]
    why = {json.loads(r.row)["id"]: r.reasons for r in got.rejected.collect()}
    assert why == {1: ["d: not a number", "n: missing", "day: not a date"], 2: ["d: missing", "n: out of range", "day: missing", "s: missing"], 3: ["d: missing", "s: missing"]}
    assert got.counts == {"kept": 2, "d: missing": 2, "d: not a number": 1, "n: missing": 1, "n: out of range": 1, "day: missing": 1, "day: not a date": 1, "s: missing": 2}
    some = rejects.route(df, {"d": "double", "n": "int"}, str(tmp_path / "q"), required=["n"])
    assert some.counts == {"kept": 3, "n: missing": 1, "n: out of range": 1} and some.kept.filter("d IS NULL").count() == 1
    assert rejects.route(df.limit(0), {"d": "double"}, str(tmp_path / "e")).counts == {"kept": 0}


def test_tables_are_counted_from_footers(spark, sf):
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    n = tables.footer_scan(spark, f"{sf}/orders.parquet").agg(F.count(F.lit(1)).alias("n"))
    assert "PushedAggregation: [COUNT(*)]" in n._jdf.queryExecution().executedPlan().toString().replace("PushedAggregations", "PushedAggregation")
    assert n.first().n == spark.read.parquet(f"{sf}/orders.parquet").count()
    assert "FileScan" in spark.read.parquet(f"{sf}/orders.parquet")._jdf.queryExecution().executedPlan().toString()


def rows_scanned(df):
    df.collect()
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        p = todo.pop()
        if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            p = p.executedPlan()
        if p.getClass().getSimpleName() == "FileSourceScanExec":
            n += p.metrics().apply("numOutputRows").value()
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return n


def test_lookups_open_few_row_groups(spark, tmp_path):
    path, n = str(tmp_path / "m"), 200_000
    rows = spark.range(n).select((F.col("id") * 7919 % n).alias("id"), F.concat(F.lit("team "), (F.col("id") * 7919 % 500).cast("string")).alias("team"), F.md5(F.col("id").cast("string")).alias("x"))
    tables.write_clustered(rows, path, ["team", "id"], row_group=256 * 1024)
    found = spark.read.parquet(path).filter("team = 'team 77'")
    assert found.count() == n / 500 and rows_scanned(spark.read.parquet(path).filter("team = 'team 77'")) < n / 20
    assert rows_scanned(spark.read.parquet(path).filter("id = 1234")) < n / 4


def test_a_new_checkpoint_goes_on_where_the_table_stands(spark, tmp_path):
    config = changes.TableConfig("stg_matches", silver.matches, ("match_id",), ("match_status", "home_goals", "away_goals"), ("ingested_at",))
    table, folder, comp = str(tmp_path / "table"), tmp_path / "in", {"id": 9, "name": "L", "code": "X"}
    tables.load_batch(spark, table, config, payloads.flatten_matches(payloads.read_payloads(spark, str(folder), schemas.MATCH_PAYLOAD)) if folder.exists() else
                      spark.createDataFrame([], schemas.MATCHES), "b20200101", "2020-01-01")
    for k, score in enumerate([None, SCORE]):
        write(folder, f"{k}.json", {"competition": comp, "matches": [match(1, score=score)]})
        load_new_payloads(spark, str(folder), schemas.MATCH_PAYLOAD, payloads.flatten_matches, config, table, str(tmp_path / f"ckpt{k}"), files_per_batch=1)
    assert sorted(r.home_goals for r in tables.read_current(spark, table).collect()) == [2] and tables.batch_count(spark, table) == 4
    origins = {r.origin for r in tables._log(spark, table)} - {None}
    assert len(origins) == 3 and {tables.batch_of(spark, table, o) is not None for o in origins} == {True}
    closing = changes.TableConfig("t", silver.matches, ("match_id",), ("match_status",), deletes="close")
    with pytest.raises(ValueError, match="whole"):
        load_new_payloads(spark, str(folder), schemas.MATCH_PAYLOAD, payloads.flatten_matches, closing, table, str(tmp_path / "c"))


def test_plain_pages_are_cut_at_their_tags_as_the_parser_reads_them():
    """Pages of plain tags and text give the parser's rows without it; all others go through it."""
    tags = frozenset(("td", "th"))

    def parsed(html, table):
        p = pages._Cells(table, "tr", tags)
        p.feed(html)
        p.finish()
        return p.rows

    plain = ["<table>", "</table>", "<tr>", "</tr>", "<td>", "<TD rowspan=2>", "</td>", '<th COLSPAN="2" colspan=3>', "</th>", "a & b", "&amp;", "&lt", "x>y", "<thead>",
             "</thead>", "<tbody>", '<td class="a&amp;b" nowrap>', '<td\nrowspan="0" >', "</td >", "text ", "\n", "é&nbsp;", '<td rowspan="&#50;">', "<td rowspan=3colspan=2>"]
    other = ["<br/>", "<!-- <td> -->", "<script>if(a<b)", "</script>", "<3", "< td>", "<a-b>", "<title>", "</title>", "<td =x>", '<p title="<td>">', "</>", "<?pi>", "<th colspan='2'>",
             "</tr x=1>", "<td a = 3>", '<td rowspan="2"colspan="3">', "<td\x0b>"]
    rnd = random.Random(7)
    read = 0
    for n in range(4000):
        html = "".join(rnd.choice(plain if n % 2 else plain + other) for _ in range(rnd.randint(1, 25))) + ("</table>" if n % 3 else "")
        for table in ("table", None):
            assert pages._Cells(table, "tr", tags).read(html) == parsed(html, table), html
            read += pages._Cells(table, "tr", tags)._read_plain(html)
    assert read > 2000


def test_player_pages_are_made_from_rows_computed_once(spark, sf):
    from checks.registry import QUERIES
    import checks.q_changes  # noqa: F401

    text = QUERIES["m6_bronze_player_pages"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in text and "l_orderkey" not in text
