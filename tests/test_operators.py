"""Operators against brute force, and the plans they must produce."""

import random

import pytest
from pyspark.sql import functions as F

from touchline.operators import aggregates, filters, joins, quality, sides, windows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, many ties, NULL keys and NULL order values."""
    rnd = random.Random(5)
    rows = []
    for i in range(3000):
        group = "hot" if i % 3 == 0 else rnd.choice([None, *[f"g{j}" for j in range(40)]])
        rows.append((group, rnd.choice([None, 1, 2, 3]), rnd.choice(["b", "a", None]), i))
    return spark.createDataFrame(rows, "g string, a int, b string, id int").repartition(4)


def test_ordered_equals_plain_window(skewed):
    from pyspark.sql import Window

    order, lag = ["a desc", "b"], {"prev_a": "a", "prev_id": "id"}
    for keys in (["g"], []):
        got = windows.ordered(skewed, keys, order, key=["id"], row_number="rn", lag=lag, size="n").select("id", "rn", "prev_a", "prev_id", "n")
        whole = Window.partitionBy(*keys)
        w = whole.orderBy(*windows.order_columns([*order, "id"]))
        want = skewed.select("id", F.row_number().over(w), F.lag("a").over(w), F.lag("id").over(w), F.count("*").over(whole))
        assert sorted(map(tuple, want.collect())) == sorted(map(tuple, got.collect()))
        assert dict(got.dtypes)["rn"] == "bigint"


@pytest.mark.parametrize("type_", ["long", "double", "decimal(20,4)", "string", "binary", "date", "timestamp", "timestamp_ntz", "boolean", "float"])
def test_ordered_by_any_type(spark, type_):
    from pyspark.sql import Window

    df = spark.range(1500).withColumn("x", F.expr(f"""
        CASE WHEN id % 11 = 0 THEN NULL WHEN '{type_}' IN ('date', 'timestamp', 'timestamp_ntz') THEN cast(date_add(date '2020-03-01', cast(id % 97 as int)) as string)
        WHEN '{type_}' = 'boolean' THEN cast(id % 2 = 0 as string) WHEN '{type_}' IN ('string', 'binary') THEN concat('é"', chr(34 + cast(id % 60 as int)))
        ELSE cast((id % 97) / 7 - 3 as string) END""").try_cast(type_) if type_ != "long" else F.col("id") % 97)
    got = windows.ordered(df, [], ["x desc"], key=["id"], row_number="rn").select("id", "rn")
    want = df.select("id", F.row_number().over(Window.orderBy(F.col("x").desc(), "id")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_several_rankings_read_their_table_once(spark, skewed, tmp_path):
    skewed.write.parquet(str(tmp_path / "base"))
    base = spark.read.parquet(str(tmp_path / "base"))
    out = windows.ranks(base, ["id"], {"r1": (["g"], ["a desc"]), "r2": ([], ["a desc"]), "r3": (["g"], ["b"])})
    assert out.count() == 3000 and str(tmp_path) not in plan(out)


def test_empty_table_is_ordered(skewed):
    assert windows.ordered(skewed.limit(0), ["g"], ["a"], key=["id"], row_number="rn", lag={"p": "a"}, size="n").collect() == []


def test_top_rows_are_cut_before_the_shuffle(skewed):
    p = plan(windows.last_n(skewed, ["g"], ["a", "id"], 5))
    assert p.index("Final") < p.index("Exchange hashpartitioning") < p.index("Partial")


def test_dedup_keeps_latest(spark):
    df = spark.createDataFrame([("k", 1, "old"), ("k", 2, "new"), (None, 1, "null key")], "k string, at int, v string")
    assert sorted(r.v for r in windows.dedup_latest(df, ["k"], ["at"]).collect()) == ["new", "null key"]


def test_group_value_keeps_null_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), (None, 3)], "g string, v int")
    assert sorted(map(tuple, windows.group_value(df, ["g"], top=F.max("v")).select("v", "top").collect())) == [(1, 5), (3, 3), (5, 5)]


def _brute_pairs(left, right):
    def hit(a, b):
        return a is not None and b is not None and (b[:5].lower() in a.lower() or a[:5].lower() in b.lower())

    pairs = {(l[0], r[0]) for l in left for r in right if l[1] == r[1] and l[1] is not None and hit(l[2], r[2])}
    lone_l = {(l[0], None) for l in left if l[0] not in {p[0] for p in pairs}}
    return pairs | lone_l | {(None, r[0]) for r in right if r[0] not in {p[1] for p in pairs}}


def test_prefix_match_equals_brute_force(spark):
    names = ["Ajax", "AJAX Amsterdam", "PSV", "psv eindhoven", "Feyenoord", "", None, "FC", "The Ajax", "Real%", "Real_Madrid"]
    rnd = random.Random(3)
    left = [(i, rnd.choice(["d1", "d2", None]), rnd.choice(names)) for i in range(60)]
    right = [(100 + i, rnd.choice(["d1", "d3", None]), rnd.choice(names)) for i in range(60)]
    l = spark.createDataFrame(left, "id int, d string, name string")
    r = spark.createDataFrame(right, "rid int, d string, name string")
    m = joins.prefix_match(l, r, ["d"], "name")
    got = m.select("l.id", "r.rid").collect()
    assert {tuple(x) for x in got} == _brute_pairs(left, right)
    assert len(got) == len(_brute_pairs(left, right))
    assert joins.ambiguous_pairs(m, ("id", "rid")).filter("partners > 1").count() > 0


def test_prefix_match_with_null_and_repeated_ids(spark):
    left = spark.createDataFrame([(1, "A", "Ajax"), (1, "B", "Boavista"), (None, "A", "Ajax")], "id int, d string, name string")
    right = spark.createDataFrame([("r1", "A", "Ajax FC"), ("r2", "A", "PSV")], "rid string, d string, name string")
    got = joins.prefix_match(left, right, ["d"], "name").select("l.id", "l.d", "r.rid").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "A", "r1"), (None, "A", "r1"), (1, "B", None), (None, None, "r2")], key=str)


def test_prefix_match_spreads_a_name_of_most_rows(spark, monkeypatch):
    """One name with nine million pairs: no task makes more than half of them, and none is lost or doubled."""
    monkeypatch.setattr(joins, "CELL_SIDE", 1 << 8, raising=False)
    def side(n, one):
        rows = spark.range(n).select(F.col("id").alias(one), F.lit("d").alias("d"), F.lit("Ajax").alias("name"))
        return rows.union(spark.createDataFrame([(-1, "d", {"id": "Solo", "rid": "Zeta"}[one]), (-2, None, "Ajax"), (-3, "d", None), (-4, "d", "PSV")], "id long, d string, name string"))

    m = joins.prefix_match(side(3000, "id"), side(3000, "rid"), ["d"], "name").select("l.id", "r.rid", F.spark_partition_id().alias("at"))
    per_task = [r["count"] for r in m.groupBy("at").count().collect()]
    assert max(per_task) < 3000 * 3000 / 2
    both = m.filter("id >= 0 and rid >= 0")
    assert tuple(both.agg(F.count("*"), F.countDistinct("id"), F.countDistinct("rid"), F.countDistinct(F.col("id") * 3000 + F.col("rid"))).first()) == (9_000_000, 3000, 3000, 9_000_000)
    rest = sorted(map(tuple, m.filter("coalesce(id, -1) < 0 or coalesce(rid, -1) < 0").select("id", "rid").collect()), key=repr)
    assert rest == sorted([(i, None) for i in (-1, -2, -3)] + [(None, i) for i in (-1, -2, -3)] + [(-4, -4)], key=repr)


def test_prefix_match_in_cells_equals_brute_force(spark, monkeypatch):
    """Rows that repeat, names that fit several others, some in cells and some not."""
    monkeypatch.setattr(joins, "CELL_PAIRS", 20)
    monkeypatch.setattr(joins, "CELL_SIDE", 2)
    names = ["Ajax", "AJAX Amsterdam", "PSV", "psv eindhoven", "Feyenoord", "", None, "FC", "The Ajax"]
    rnd = random.Random(5)
    left = [(i, rnd.choice(["d1", "d1", "d2", None]), rnd.choice(names)) for i in range(60)]
    right = [(100 + i, rnd.choice(["d1", "d1", "d2", "d3"]), rnd.choice(names)) for i in range(60)]
    m = joins.prefix_match(spark.createDataFrame(left, "id int, d string, name string"), spark.createDataFrame(right, "rid int, d string, name string"), ["d"], "name")
    assert sorted(map(tuple, m.select("l.id", "r.rid").collect()), key=repr) == sorted(_brute_pairs(left, right), key=repr)


def test_ambiguous_pairs_are_counted_without_making_them(spark):
    """Four hundred million pairs, counted from the counts of the names; ids that repeat or are NULL add up."""
    left = spark.range(20_000).select((F.col("id") % 5000).alias("id"), F.lit("d").alias("d"), F.when(F.col("id") % 2 == 0, "Ajax").otherwise("Lone").alias("name"))
    left = left.union(spark.createDataFrame([(None, "d", "Ajax"), (9999, "d", None), (9998, None, "Ajax")], "id long, d string, name string"))
    right = spark.range(40_000).select(F.col("id").alias("rid"), F.lit("d").alias("d"), F.lit("Ajax FC").alias("name"))
    counted = joins.prefix_match(left, right, ["d"], "name", counts=True)
    assert counted.count() == 20_003
    got = joins.ambiguous_pairs(counted, ("id", "rid"))
    assert {(r.id, r.partners) for r in got.collect()} == {(i, 4 * 40_000) for i in range(0, 5000, 2)} | {(None, 40_000)}
    few = right.limit(3)
    pairs, sums = (joins.ambiguous_pairs(joins.prefix_match(left, few, ["d"], "name", counts=c), ("id", "rid")) for c in (False, True))
    assert pairs.schema.simpleString() == sums.schema.simpleString() and sorted(map(repr, pairs.collect())) == sorted(map(repr, sums.collect()))


def test_prefix_match_copies_rows_of_one_file_in_many_tasks(spark, monkeypatch):
    """Rows of a name in cells, stored as one file: they are dealt out before they are copied for each piece of the other side."""
    monkeypatch.setattr(joins, "CELL_PAIRS", 20)
    monkeypatch.setattr(joins, "CELL_SIDE", 2)

    def side(one):
        return spark.range(40).coalesce(1).select(F.col("id").alias(one), F.lit("d").alias("d"), F.lit("Ajax").alias("name"))

    m = joins.prefix_match(side("id"), side("rid"), ["d"], "name").select("l.id", "r.rid")
    copied = m._jdf.queryExecution().executedPlan().toString().split("Generate explode")[1:]
    assert len(copied) == 2 and all("RoundRobinPartitioning" in x.split("FileScan")[0] for x in copied)
    assert (m.count(), m.distinct().count()) == (1600, 1600)


def test_previous_version_reads_the_history_once(spark, tmp_path):
    rows = [("a", 1, False, "h1", 10), ("a", 2, False, "h2", 20), ("a", 3, True, "h3", 30), ("b", 1, True, "h4", 40), (None, 1, False, "h5", 50), (None, 2, True, "h6", 60), ("c", 1, False, "h7", 70)]
    spark.createDataFrame(rows, "k string, valid_from int, is_current boolean, record_hash string, v int").write.parquet(str(tmp_path / "h"))
    out = joins.previous_version(spark.read.parquet(str(tmp_path / "h")), "k", {"prev": "v"})
    assert sorted(((r.k, r.v, r.prev) for r in out.collect()), key=str) == sorted([("a", 30, 20), ("b", 40, None), (None, 60, None)], key=str)
    assert plan(out).split("Initial Plan")[-1].count("FileScan") == 1


def test_orphans_and_missing_parents(spark):
    child = spark.createDataFrame([(1, 10, 11), (2, 10, 99), (3, None, 10)], "id int, a int, b int")
    parent = spark.createDataFrame([(10,), (11,), (11,)], "p int")
    assert {r.id for r in joins.orphans(child, parent, "b", "p").collect()} == {2}
    assert {r.id for r in joins.missing_either(child, parent, ["a", "b"], "p").collect()} == {2, 3}
    assert {(r.b, r.rows) for r in joins.orphan_keys(child, parent, "b", "p").collect()} == {(99, 1)}


def test_two_sided_reads_once_and_counts_missing_result_as_loss(spark):
    m = spark.createDataFrame([("x", "y", 2, 1, "HOME"), ("x", "y", 0, 0, None)],
                              "home_team_name string, away_team_name string, home_goals int, away_goals int, match_result string")
    s = sides.two_sided(m, carry=())
    assert [(r.team_name, r.result, r.points) for r in s.collect()] == [("x", "W", 3), ("y", "L", 0), ("x", "L", 0), ("y", "L", 0)]
    assert plan(s).count("Scan") == 1


def test_most_frequent_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", None), ("k", None), ("k", None)], "k string, v string")
    assert [tuple(r) for r in aggregates.most_frequent(df, ["k"], "v").collect()] == [("k", "a")]


def test_filters_reach_the_scan(spark, sf):
    p = plan(spark.read.parquet(f"{sf}/orders.parquet").filter("o_orderstatus = 'F'").select("o_orderkey"))
    assert "EqualTo(o_orderstatus,F)" in p and "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in p


def test_as_of_is_start_inclusive_end_exclusive(spark):
    df = spark.createDataFrame([("a", "2024-01-01", "2024-02-01"), ("b", "2024-02-01", None)], "v string, valid_from string, valid_to string").select(
        "v", *[F.col(n).cast("timestamp").alias(n) for n in ("valid_from", "valid_to")])
    assert [r.v for r in filters.as_of(df, "2024-02-01").collect()] == ["b"]
    assert [r.v for r in filters.as_of(df, "2024-01-31 23:59:59").collect()] == ["a"]
    assert filters.as_of(df, "2023-12-31").count() == 0


# --- quality ------------------------------------------------------------------------
NOW = "2024-01-03 00:00:00"


def results(df, checks, parents=None):
    return {r.check_name: (r.passed, r.records_checked, r.records_failed) for r in quality.run_suite(df, "L", "t", checks, NOW, parents).collect()}


def test_suite_of_every_kind(spark):
    df = spark.createDataFrame([(1, "a", 5, "WDL"), (1, None, 50, "WX"), (2, "z", None, None)], "id int, c string, n int, f string")
    df = df.withColumn("at", F.lit("2024-01-01").cast("timestamp"))
    got = results(df, [
        quality.not_null("c"), quality.unique("id"), quality.accepted("c", ["a", None]), quality.in_range("n", 0, 10), quality.matches("f", "^[WDL]+$"),
        quality.row_rule("small", "n < 10"), quality.foreign_key("id", "p", "pid"), quality.group_size(["id"], "c", 1, 1), quality.fresh("at", 48), quality.fresh("at", 47),
    ][:9], {"p": spark.createDataFrame([(1,)], "pid int")})
    assert got == {
        "NOT NULL: c": (False, 3, 1), "UNIQUE: id": (False, 3, 1), "VALID VALUES: c": (False, 2, 1), "RANGE: n in [0, 10]": (False, 2, 1),
        "PATTERN: f": (False, 2, 1), "small": (False, 3, 1), "FK: id → p.pid": (False, 3, 1), "GROUP SIZE: c per id in [1, 1]": (True, 2, 0),
        "FRESHNESS: at": (True, 0, 0)}
    assert results(df, [quality.fresh("at", 47)]) == {"FRESHNESS: at": (False, 0, 1)}


def test_suite_on_empty_table(spark):
    df = spark.createDataFrame([], "id int, at timestamp")
    got = results(df, [quality.not_null("id"), quality.unique("id"), quality.fresh("at", 1)])
    assert got == {"NOT NULL: id": (True, 0, 0), "UNIQUE: id": (True, 0, 0), "FRESHNESS: at": (False, 0, 1)}


def test_row_rules_share_one_scan(spark, sf):
    df = spark.read.parquet(f"{sf}/orders.parquet")
    p = plan(quality.run_suite(df, "L", "t", [quality.not_null("o_orderkey", "o_custkey"), quality.in_range("o_totalprice", 0, 1)], NOW))
    assert p.count("FileScan") == 1


def test_sql_rules_report_errors_without_stopping(spark):
    spark.createDataFrame([(1,)], "x int").createOrReplaceTempView("rule_t")
    rules = {"ok": "SELECT * FROM rule_t WHERE x = 0", "bad": "SELECT * FROM rule_t", "error": "SELECT y FROM rule_t"}
    from touchline.plans import suites

    rows = suites.run_sql_rules(spark, rules, NOW, "r")
    assert {r.test_name: r.status for r in rows.collect()} == {"ok": quality.PASS, "bad": quality.FAIL, "error": quality.ERROR}
    s = quality.summary(rows).first()
    assert (s.total, s.passed, s.failed, s.errors, s.pass_rate) == (3, 1, 1, 1, 33.3)
    assert quality.failing_rows(spark, rules["bad"]).count() == 1


def _brute_assignment(left, right):
    """Best pair of names first (score, names), each name once; rows of a pair in the order of their ids."""
    def grams(n):
        low = n.lower()
        return {low[i:i + 2] for i in range(max(len(low) - 1, 1))}

    def hit(a, b):
        return b[:5].lower() in a.lower() or a[:5].lower() in b.lower()

    out = []
    for d in {r[1] for r in left + right} - {None}:
        ln, rn = ({r[2] for r in side if r[1] == d and r[2] is not None} for side in (left, right))
        open_ = sorted((-(2000 * len(grams(a) & grams(b)) // (len(grams(a)) + len(grams(b)))), a, b) for a in ln for b in rn if hit(a, b))
        used_l, used_r = set(), set()
        for _, a, b in open_:
            if a not in used_l and b not in used_r:
                used_l.add(a)
                used_r.add(b)
                pair = [sorted(r[0] for r in side if r[1:] == (d, n)) for side, n in ((left, a), (right, b))]
                out += list(zip(*pair))
    done_l, done_r = {p[0] for p in out}, {p[1] for p in out}
    return sorted(out + [(r[0], None) for r in left if r[0] not in done_l] + [(None, r[0]) for r in right if r[0] not in done_r], key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_best_match_equals_brute_force(spark, seed):
    names = ["Ajax", "AJAX Amsterdam", "Ajax Cape Town", "PSV", "psv eindhoven", "Feyenoord", "", None, "FC", "The Ajax", "Real%", "Real_Madrid", "x"]
    r = random.Random(seed)
    left = [(i, r.choice(["d1", "d2", None]), r.choice(names)) for i in range(50)]
    right = [(100 + i, r.choice(["d1", "d3", "d2"]), r.choice(names)) for i in range(50)]
    m = joins.best_match(spark.createDataFrame(left, "id int, d string, name string"), spark.createDataFrame(right, "rid int, d string, name string"), ["d"], "name", (["id"], ["rid"]))
    assert sorted(map(tuple, m.select("l.id", "r.rid").collect()), key=repr) == _brute_assignment(left, right)


def test_matching_of_empty_sides(spark):
    l = spark.createDataFrame([(1, "d", "Ajax"), (2, "d", None)], "id int, d string, name string")
    none = spark.createDataFrame([], "rid int, d string, name string")
    for m in (joins.prefix_match(l, none, ["d"], "name"), joins.best_match(l, none, ["d"], "name", (["id"], ["rid"]))):
        assert sorted((x.l.id, x.r) for x in m.collect()) == [(1, None), (2, None)]


def test_ranks_do_not_multiply_rows_that_share_a_key(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2)], "k string, v int")
    got = windows.ranks(df, ["k"], {"up": ([], ["v"]), "down": ([], ["v desc"])})
    assert sorted((r.v, r.up) for r in got.collect()) in ([(1, 1), (1, 2), (2, 3)],) and got.filter("down = 1").first().v == 2


def test_previous_version_keeps_one_closed_row_per_task(spark):
    h = spark.createDataFrame([("a", 1, "2024-01-01", False), ("a", 2, "2024-02-01", False), ("a", 3, "2024-03-01", True), ("b", 9, "2024-01-01", True), (None, 5, "2024-01-01", True), (None, 4, "2023-01-01", False)],
                              "k string, v int, valid_from string, is_current boolean").withColumn("record_hash", F.lit("h"))
    p = joins.previous_version(h, "k", {"before": "v"})
    assert sorted(((r.k, r.v, r.before) for r in p.collect()), key=repr) == sorted([("a", 3, 2), ("b", 9, None), (None, 5, None)], key=repr)
    assert "Window" not in plan(p)


def scans(df):
    return plan(df).count("Scan parquet")


@pytest.fixture(scope="module")
def faulty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("q") / "t")
    rows = [(i, i // 2, f"g{i % 3}", None if i % 4 == 0 else i, "2024-01-01 00:00:00") for i in range(40)] + [(None, None, None, 100, None)]
    spark.createDataFrame(rows, "id int, pair int, g string, v int, at string").withColumn("at", F.col("at").cast("timestamp")).write.parquet(path)
    return spark.read.parquet(path)


def test_a_suite_scans_its_table_once_and_finds_every_kind_of_fault(spark, faulty):
    parent = spark.createDataFrame([(i,) for i in range(0, 30)] + [(None,)], "pid long")
    checks = [quality.not_null("v"), quality.unique("id"), quality.unique("pair"), quality.unique("g", where="v > 36"), quality.foreign_key("id", "p", "pid"), quality.group_size(["g"], "v", 10, 10), quality.in_range("v", 5, 50), quality.fresh("at", 24),
              quality.row_rule("small", "v < 30", where="g = 'g1'"), quality.matches("g", "^g[01]$")]
    out = quality.run_suite(faulty, "L", "t", checks, "2024-01-03", {"p": parent}, sample_by=["id"])
    assert scans(out) == 1
    got = {r.check_name: (r.records_checked, r.records_failed, len(r.samples)) for r in out.collect()}
    v = [None if i % 4 == 0 else i for i in range(40)]
    assert got["NOT NULL: v"] == (41, 10, 5) and got["UNIQUE: id"] == (41, 0, 0) and got["UNIQUE: pair"] == (41, 20, 5)
    assert got["UNIQUE: g"][:2] == (4, 0) and got["FK: id → p.pid"][:2] == (41, 11)
    sizes = [len({x for i, x in enumerate(v) if i % 3 == k and x is not None}) for k in range(3)] + [1]
    assert got["GROUP SIZE: v per g in [10, 10]"][:2] == (4, sum(n != 10 for n in sizes))
    assert got["RANGE: v in [5, 50]"][:2] == (31, sum(x is not None and x < 5 for x in v) + 1) and got["FRESHNESS: at"][:2] == (0, 1)
    assert got["small"][:2] == (13, sum(x is not None and i % 3 == 1 and x >= 30 for i, x in enumerate(v))) and got["PATTERN: g"][:2] == (40, 13)
    samples = {r.check_name: r.samples for r in out.collect()}
    assert all(s.startswith('{"k0":') for s in samples["UNIQUE: pair"]) and samples["FK: id → p.pid"] and samples["NOT NULL: v"][0].startswith('{"id":')


def test_more_row_rules_than_fit_one_entry(spark, faulty):
    checks = [quality.row_rule(f"r{k}", f"v >= {k}") for k in range(70)]
    got = {r.check_name: r.records_failed for r in quality.run_suite(faulty, "L", "t", checks, "2024-01-03").collect()}
    assert got == {f"r{k}": sum(i % 4 != 0 and i < k for i in range(40)) for k in range(70)}


def test_samples_of_a_rule_are_bounded_and_its_own(spark, faulty):
    faulty.createOrReplaceTempView("faulty_t")
    r = quality.run_rule(spark, "many", "SELECT id FROM faulty_t WHERE v IS NULL", "2024-01-03", "r", samples=True).first()
    assert r.details == "10 failures" and len(r.samples) == 5 and all(int(s[6:-1]) % 4 == 0 for s in r.samples)
    assert quality.run_rule(spark, "none", "SELECT id FROM faulty_t WHERE FALSE", "2024-01-03", "r", samples=True).first().samples == []
    assert quality.run_rule(spark, "bad", "SELECT nothing FROM faulty_t", "2024-01-03", "r", samples=True).first().samples == []


def test_previous_version_moves_only_the_columns_to_keep(spark):
    h = spark.createDataFrame([("a", 1, 7, "2024-01-01", False), ("a", 2, 8, "2024-02-01", True), ("a", 2, 9, "2024-03-01", True), (None, 5, 5, "2024-01-01", True)],
                              "k string, v int, other int, valid_from string, is_current boolean").withColumn("record_hash", F.lit("h"))
    p = joins.previous_version(h, "k", {"before": "v"}, keep=["v"])
    assert p.columns == ["v", "before"] and sorted(map(tuple, p.collect()), key=repr) == [(2, 1), (2, 1), (5, None)]
    assert "other" not in p._jdf.queryExecution().optimizedPlan().toString().split("LogicalRDD")[0]
