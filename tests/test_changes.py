"""History properties, the stored history table, and the whole load."""

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from touchline.operators import changes, filters
from touchline.plans import medallion, silver, suites
from touchline.sources import tables

T = [f"2024-0{m}-01 00:00:00" for m in range(1, 7)]
CONFIG = changes.TableConfig("t", lambda d: d, ("k",), ("v",), latest_by=("at",))


def rows(spark, *data):
    return spark.createDataFrame([(*d, 0) if len(d) == 2 else d for d in data], "k string, v string, at int")


def load(spark, batches, deletes="keep"):
    history = None
    for ts, b in zip(T, batches):
        history = changes.apply_scd2(history, changes.prepare(b, ["k"], ["v"], ts, ["at"]), ["k"], ts, deletes=deletes)
    return history


def versions(history):
    return sorted((r.k, r.v, str(r.valid_from)[:7], str(r.valid_to)[:7] if r.valid_to else None, r.is_current)
                  for r in history.select("k", "v", "valid_from", "valid_to", "is_current").collect())


def test_replay_changes_nothing(spark):
    b = rows(spark, ("a", "1"), ("b", "2"))
    assert versions(load(spark, [b, b, b])) == versions(load(spark, [b]))


def test_versions_are_contiguous_with_one_current(spark):
    h = load(spark, [rows(spark, ("a", x)) for x in ("1", "2", "2", "1")])
    assert versions(h) == [("a", "1", "2024-01", "2024-02", False), ("a", "1", "2024-04", None, True), ("a", "2", "2024-02", "2024-04", False)]
    assert {r.failed for r in changes.integrity(h, ["k"]).collect()} == {0}


def test_as_of_each_load_equals_that_batch(spark):
    batches = [rows(spark, ("a", "1"), ("b", "1")), rows(spark, ("a", "2"), ("b", "1")), rows(spark, ("a", "2"), ("b", "3"))]
    h = load(spark, batches)
    for ts, b in zip(T, batches):
        assert sorted(map(tuple, filters.as_of(h, ts).select("k", "v").collect())) == sorted(map(tuple, b.select("k", "v").collect()))


def test_deleted_then_inserted_again(spark):
    batches = [rows(spark, ("a", "1"), ("b", "1")), rows(spark, ("b", "1")), rows(spark, ("a", "1"), ("b", "1"))]
    assert versions(load(spark, batches)) == [("a", "1", "2024-01", None, True), ("b", "1", "2024-01", None, True)]
    closed = load(spark, batches, deletes="close")
    assert versions(closed) == [("a", "1", "2024-01", "2024-02", False), ("a", "1", "2024-03", None, True), ("b", "1", "2024-01", None, True)]


def test_duplicate_keys_in_a_batch_keep_the_latest(spark):
    h = load(spark, [rows(spark, ("a", "old", 1), ("a", "new", 2))])
    assert versions(h) == [("a", "new", "2024-01", None, True)]


def test_stored_history(spark, tmp_path):
    path = str(tmp_path / "t")
    one, two = rows(spark, ("a", "1"), ("b", "1")), rows(spark, ("a", "2"), ("c", "1"))
    assert tables.read_history(spark, path) is None
    tables.load_batch(spark, path, CONFIG, one, "b1", T[0])
    stats = tables.load_batch(spark, path, CONFIG, two, "b2", T[1]).first()
    assert (stats.new_records, stats.updated_records, stats.unchanged_records, stats.deleted_records) == (1, 1, 0, 1)
    want = versions(load(spark, [one, two]))
    assert versions(tables.read_history(spark, path)) == want
    tables.load_batch(spark, path, CONFIG, two, "b2", T[1])      # the same batch once more
    assert versions(tables.read_history(spark, path)) == want
    with pytest.raises(ValueError, match="older"):
        tables.load_batch(spark, path, CONFIG, one, "b1", T[0])


def files_of(df):
    return {f.split("/attempt=")[1] for f in df.inputFiles() if "/attempt=" in f}


def test_reading_current_rows_opens_no_closed_part(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.load_batch(spark, path, CONFIG, rows(spark, ("a", "1"), ("b", "1")), "b1", T[0])
    tables.load_batch(spark, path, CONFIG, rows(spark, ("a", "2")), "b2", T[1])
    assert tables.settle(spark, path) and not tables.settle(spark, path)
    now, everything = tables.read_current(spark, path), tables.read_history(spark, path)
    assert any("closed" in f for f in files_of(everything)) and not any("closed" in f for f in files_of(now))
    assert versions(everything) == [("a", "1", "2024-01", "2024-02", False), ("a", "2", "2024-02", None, True), ("b", "1", "2024-01", None, True)]
    assert versions(now) == [("a", "2", "2024-02", None, True), ("b", "1", "2024-01", None, True)]


def test_reading_as_of_opens_no_later_attempt(spark, tmp_path):
    path = str(tmp_path / "t")
    values = [("a", "1"), ("a", "2"), ("a", "3"), ("a", "4")]
    for k, row in enumerate(values):
        tables.load_batch(spark, path, CONFIG, rows(spark, row, *[(f"k{i}", "1") for i in range(20)]), f"b{k}", T[k])
    tables.settle(spark, path)
    for k, row in enumerate(values):
        then = tables.read_as_of(spark, path, T[k][:8] + "15 00:00:00")
        assert [tuple(r) for r in then.filter("k = 'a'").select("k", "v").collect()] == [row] and then.count() == 21
        assert {f.split("-")[0] for f in files_of(then)} <= {f"b{j}" for j in range(k + 1)} and not any("closed" in f for f in files_of(then))
    assert tables.read_as_of(spark, path, "2023-01-01") is None


@pytest.mark.parametrize("deletes", ["keep", "close"])
def test_appended_history_equals_whole_history(spark, tmp_path, deletes):
    """Random batches, settled at random, against the history computed whole after every batch."""
    import random

    r = random.Random(deletes)
    config = changes.TableConfig("t", lambda d: d, ("k",), ("v",), latest_by=("at",), deletes=deletes)
    path, whole = str(tmp_path / "h"), None
    for n, ts in enumerate(T):
        b = rows(spark, *[(f"k{i}", str(r.randint(0, 2))) for i in range(12) if r.random() < 0.7])
        whole = spark.createDataFrame(changes.apply_scd2(whole, changes.prepare(b, ["k"], ["v"], ts, ["at"]), ["k"], ts, deletes=deletes).collect()) if whole is not None \
            else changes.prepare(b, ["k"], ["v"], ts, ["at"])
        tables.load_batch(spark, path, config, b, f"b{n}", ts)
        if r.random() < 0.4:
            tables.settle(spark, path)
        got = tables.read_history(spark, path)
        assert versions(got) == versions(whole)
        assert versions(tables.read_current(spark, path)) == [v for v in versions(whole) if v[4]]
        assert got.filter("transformed_at <> coalesce(valid_to, valid_from)").count() == 0


def test_a_vanished_key_counts_once_until_it_is_back(spark, tmp_path):
    path = str(tmp_path / "t")
    both, one = [("a", "1"), ("b", "1")], [("b", "1")]
    stats = [tables.load_batch(spark, path, CONFIG, rows(spark, *batch), f"b{k}", ts).first() for k, (batch, ts) in enumerate(zip([both, one, one, both, one], T))]
    assert [(s.new_records, s.updated_records, s.unchanged_records, s.deleted_records) for s in stats] == [(2, 0, 0, 0), (0, 0, 1, 1), (0, 0, 1, 0), (0, 0, 2, 0), (0, 0, 1, 1)]
    assert versions(tables.read_history(spark, path)) == [("a", "1", "2024-01", None, True), ("b", "1", "2024-01", None, True)]


def test_a_repeated_batch_undoes_what_was_settled_from_it(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.load_batch(spark, path, CONFIG, rows(spark, ("a", "1"), ("b", "1")), "b1", T[0])
    tables.load_batch(spark, path, CONFIG, rows(spark, ("a", "wrong"), ("b", "1")), "b2", T[1])
    tables.settle(spark, path)
    tables.load_batch(spark, path, CONFIG, rows(spark, ("a", "2"), ("b", "1")), "b2", T[1])
    assert versions(tables.read_history(spark, path)) == [("a", "1", "2024-01", "2024-02", False), ("a", "2", "2024-02", None, True), ("b", "1", "2024-01", None, True)]


def test_new_columns_are_null_in_older_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.load_batch(spark, path, CONFIG, rows(spark, ("a", "1"), ("b", "1")), "b1", T[0])
    tables.load_batch(spark, path, CONFIG, rows(spark, ("a", "2"), ("b", "1")).withColumn("w", F.lit(7)), "b2", T[1])
    got = sorted((r.k, r.v, r.w) for r in tables.read_history(spark, path).collect())
    assert got == [("a", "1", None), ("a", "2", 7), ("b", "1", None)]


def size_of(path, attempt):
    import os

    names = [d for d in os.listdir(path) if d.startswith(f"attempt={attempt}")]
    assert names
    files = [[os.path.join(d, f) for d, _, fs in os.walk(f"{path}/{n}") for f in fs if f.endswith(".parquet")] for n in names]
    return min(len(f) for f in files), max(sum(map(os.path.getsize, f)) for f in files)


def test_what_a_batch_writes_grows_with_its_changes(spark, tmp_path):
    path, n = str(tmp_path / "t"), 200_000
    base = spark.range(n).select(F.concat(F.lit("k"), "id").alias("k"), F.md5(F.col("id").cast("string")).alias("v"), F.lit(0).alias("at"))
    scattered = base.withColumn("v", F.when(F.crc32(F.col("k").cast("binary")) % 200 == 0, "changed").otherwise(F.col("v")))
    tables.load_batch(spark, path, CONFIG, base, "b1", T[0])
    stats = tables.load_batch(spark, path, CONFIG, scattered, "b2", T[1]).first()
    assert 800 < stats.updated_records < 1_200 and stats.unchanged_records == n - stats.updated_records
    (_, whole), (files, part) = size_of(path, "b1"), size_of(path, "b2")
    assert files == 1 and part < whole / 100
    tables.load_batch(spark, path, CONFIG, scattered, "b3", T[2])
    assert not tables.read_history(spark, path).filter(F.col("valid_from") == T[2]).count() and tables.batch_count(spark, path) == 3


def test_a_long_tail_is_settled_by_the_next_load(spark, tmp_path):
    import os

    path = str(tmp_path / "t")
    for k, ts in enumerate(T):
        tables.load_batch(spark, path, CONFIG, rows(spark, ("a", str(k)), ("b", str(k))), f"b{k}", ts)
    assert [d for d in os.listdir(path) if "settled" in d]
    got = versions(tables.read_history(spark, path))
    assert len(got) == 12 and sum(v[4] for v in got) == 2


def test_type1_merge_overwrites_listed_columns_only(spark):
    old = spark.createDataFrame([("a", "1", "x"), ("b", "1", "x")], "k string, v string, w string")
    new = spark.createDataFrame([("a", "2", "y"), ("c", "3", "y")], "k string, v string, w string")
    assert sorted(map(tuple, changes.upsert_type1(old, new, ["k"], ["v"]).collect())) == [("a", "2", "x"), ("b", "1", "x"), ("c", "3", "y")]


def test_one_shuffle_per_side(spark, sf):
    one, two = fx.scd_prepared(spark, sf)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = changes.apply_batch(two, fx.scd_batches(spark, sf)[0].transform(lambda d: changes.stamp_version(changes.with_hash(d, fx.SCD_HASH), T[0])),
                                ["k"], T[1])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert p.count("Exchange") == 2


@pytest.fixture(scope="module")
def loaded(spark, sf, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    bronze = {
        "stg_matches": fx.bronze_matches(spark, sf), "stg_teams": fx.bronze_teams(spark, sf), "stg_fbref_matches": fx.bronze_xg_matches(spark, sf),
        "stg_fbref_standings": fx.bronze_xg_standings(spark, sf), "stg_players": fx.bronze_players(spark, sf, 3),
    }
    first = medallion.run(spark, root, bronze, "b20240101", "2024-01-01 00:00:00")
    second = medallion.run(spark, root, {**bronze, "stg_players": fx.bronze_players(spark, sf)}, "b20240102", "2024-01-02 00:00:00")
    return first, second


def test_whole_load_builds_every_mart(loaded):
    first, second = loaded
    assert set(medallion.MARTS) <= set(first) and set(medallion.MARTS) <= set(second)
    stats = {r.table_name: (r.new_records, r.updated_records) for r in second["statistics"].collect()}
    assert stats["stg_matches"] == (0, 0) and stats["stg_players"][1] > 0


def test_marts_do_not_double_after_a_second_load(loaded):
    first, second = loaded
    for mart in ("fct_match_results", "dim_teams", "agg_head_to_head", "agg_team_form"):
        assert first[mart].count() == second[mart].count()
    assert second["agg_player_form"].filter("days_since_update = 1").count() > 0


def test_quality_of_the_load(loaded):
    _, second = loaded
    bad = {(r.table_name, r.check_name) for r in second["data_quality"].filter("NOT passed").collect()}
    allowed = ("VALID VALUES: competition", "RANGE: position", "GROUP SIZE")   # the fifth test league and 25 test teams
    assert all(name.startswith(allowed) for _, name in bad), bad
    assert second["data_quality"].select("table_name").distinct().count() == len(suites.SUITES)


def test_sql_rules_over_schemas(spark, loaded):
    _, second = loaded
    for schema in ("rs", "rg"):
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    rules = suites.sql_rules("2024-01-03", "rs", "rg")
    assert len(rules) == 21
    second["fct_match_results"].write.mode("overwrite").saveAsTable("rg.fct_match_results")
    got = {r.test_name: r.status for r in suites.run_sql_rules(spark, rules, "2024-01-03", "r").collect()}
    assert got["rg.fct_match_results.unique_match_id"] == "✅ PASS" and got["rs.stg_teams.team_id_not_null"] == "⚠️ ERROR"


def test_version_keys_are_unique(spark, sf):
    h = silver.with_version_key("stg_players", fx.player_history(spark, sf))
    assert h.count() == h.select("player_version_key").distinct().count()
    assert h.filter(F.col("is_current")).count() == h.select("player_season_key").distinct().count()


def test_an_empty_first_load_is_a_load(spark, tmp_path):
    path = str(tmp_path / "h")
    none = rows(spark, ("a", "1")).limit(0)
    assert tables.load_batch(spark, path, CONFIG, none, "b1", T[0]).first().new_records == 0
    assert tables.read_history(spark, path).count() == 0
    tables.load_batch(spark, path, CONFIG, rows(spark, ("a", "1")), "b2", T[1])
    tables.load_batch(spark, path, CONFIG, none, "b3", T[2])
    assert tables.read_history(spark, path).filter("is_current").count() == 1 and tables.batch_count(spark, path) == 3


def test_loads_do_not_depend_on_the_overwrite_mode(spark, tmp_path):
    path = str(tmp_path / "h")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for batch, at, value in (("b1", T[0], "1"), ("b2", T[1], "2"), ("b2", T[1], "2"), ("b3", T[2], "3")):
            tables.load_batch(spark, path, CONFIG, rows(spark, ("a", value)), batch, at)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    history = tables.read_history(spark, path)
    assert history.count() == 3 and history.filter("is_current").count() == 1


def test_repeated_merge_keys_are_refused(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    batch = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    with pytest.raises(Exception, match="several batch rows"):
        changes.upsert_type1(target, batch, ["k"], ["v"]).collect()


def test_a_rule_that_fails_while_it_runs_is_its_own_error(spark):
    from touchline.operators import quality

    spark.createDataFrame([("x",)], "s string").createOrReplaceTempView("run_time_t")
    got = [quality.run_rule(spark, n, q, T[0], "r").first().status for n, q in (("bad cast", "SELECT * FROM run_time_t WHERE cast(s AS int) = 1"), ("ok", "SELECT * FROM run_time_t WHERE s = 'y'"))]
    assert got == [quality.ERROR, quality.PASS]


def test_the_payload_line_runs_all_rules_and_finds_planted_faults(spark, sf, tmp_path):
    raw = fx.fx_matches(spark, sf).withColumn("match_date", F.date_format("played_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    teams = fx.bronze_teams(spark, sf).filter(F.col("ingest_timestamp") == fx.LOADED).drop("competition_name")
    league = F.struct(F.lit("PL").alias("competition_code"), F.lit("Premier League").alias("competition_name"))
    teams = teams.withColumn("l", league).select("*", "l.*").filter("team_id <> 3")
    standings = fx.bronze_standings(spark, sf)
    keys = ["team_id", "competition_code"]
    latest = standings.join(standings.groupBy(*keys).agg(F.max("ingest_timestamp").alias("ingest_timestamp")), [*keys, "ingest_timestamp"], "left_semi")
    latest = latest.withColumn("points", F.when(F.col("team_id") == 5, 999).otherwise(F.col("points")))
    raw = raw.withColumn("home_score", F.when(F.col("match_id") % 50 == 0, 90).otherwise(F.col("home_score")))
    bronze = {"stg_matches": raw, "stg_teams": teams, "stg_standings": latest, "stg_fbref_matches": fx.bronze_xg_matches(spark, sf)}
    out = medallion.run_payloads(spark, str(tmp_path), bronze, "b20240101", "2024-01-01 00:00:00", now="2024-01-03 00:00:00")
    got = {r.test_name: (r.status, r.details) for r in out["rules"].collect()}
    assert len(got) == 21 and not [n for n, (s, _) in got.items() if "ERROR" in s], got
    failed = {n for n, (s, _) in got.items() if "FAIL" in s}
    planted = {"stg_matches.valid_goals_range", "stg_standings.valid_points_range", "ref_integrity.matches_have_valid_home_team", "ref_integrity.matches_have_valid_away_team"}
    assert planted <= failed and "stg_teams.team_id_not_null" not in failed and "freshness.data_not_stale" not in failed
    assert set(medallion.PAYLOAD_MARTS) <= set(out) and out["dim_teams"].filter("current_position IS NOT NULL").count() > 0
    bad = {(r.table_name, r.check_name) for r in out["data_quality"].filter("NOT passed").collect()}
    assert ("stg_standings", "RANGE: points in [0, 150]") in bad and ("stg_matches", "RANGE: home_goals in [0, 20]") in bad
    assert not any("UNIQUE" in name or "SINGLE CURRENT" in name for _, name in bad)


def test_first_load_moves_keys_only_and_keeps_the_latest_of_a_repeated_key(spark, tmp_path):
    """Without repeats no wide row is moved (no window); with repeats the last one of a key counts, also for a NULL key."""
    path, seen = str(tmp_path / "t"), []
    real = tables.dedup_latest
    tables.dedup_latest = lambda *a: (seen.append(a), real(*a))[1]
    try:
        assert tables.load_batch(spark, path, CONFIG, rows(spark, *[(f"k{i}", "1") for i in range(50)]), "b1", T[0]).first().new_records == 50
        assert not seen and tables.read_history(spark, path).count() == 50
        again = str(tmp_path / "u")
        twice = rows(spark, *[("a", str(v)) for v in range(5)], ("b", "1"), (None, "1"), (None, "2"))
        assert tables.load_batch(spark, again, CONFIG, twice, "b1", T[0]).first().new_records == 3 and len(seen) == 1
    finally:
        tables.dedup_latest = real
    want = changes.prepare(CONFIG.transform(twice), list(CONFIG.keys), CONFIG.hash_cols, T[0], CONFIG.latest_by)
    cols = [*CONFIG.keys, "record_hash"]
    assert sorted(map(repr, tables.read_history(spark, again).select(cols).collect())) == sorted(map(repr, want.select(cols).collect()))


def test_previous_version_query_moves_no_columns_that_nobody_asked_for(spark, sf):
    from checks import q_relational
    from checks.registry import QUERIES

    text = QUERIES["j9_previous_version"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert q_relational and "goals" in text and "key_passes" not in text
