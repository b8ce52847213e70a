"""Edge cases of column helpers."""

from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from touchline.functions import labels, numeric, text
from touchline.operators import filters


def one(spark, *cols, rows=((1,),), schema="x int"):
    return [tuple(r) for r in spark.createDataFrame(list(rows), schema).select(*cols).collect()]


def half_up(n, d, s):
    q = abs(Fraction(n, d)) * 10**s
    whole = (2 * q + 1) // 2
    return float((1 if Fraction(n, d) >= 0 else -1) * whole) / 10**s


def test_scores_split_only_on_en_dash(spark):
    rows = [("2–1",), (" 3 – 0 ",), ("2-1",), ("",), (None,)]
    got = one(spark, text.score_part("s", 0), text.score_part("s", 1), rows=rows, schema="s string")
    assert got == [("2", "1"), ("3", "0"), (None, None), (None, None), (None, None)]


def test_digits_and_tolerant_casts(spark):
    rows = [("53,210",), ("n/a",), ("",), (None,), ("2.7",), ("nan",), ("1e99",)]
    got = one(spark, text.digits_to_int("s"), text.tolerant_int("s"), rows=rows, schema="s string")
    assert got == [(53210, None), (None, None), (None, None), (None, None), (27, 2), (None, None), (199, None)]


def test_hash_separator_keeps_columns_apart(spark):
    rows = [("1", "11"), ("11", "1"), (None, "x"), ("", "x")]
    hashes = one(spark, text.record_hash("a", "b"), text.surrogate_key("a", "b"), rows=rows, schema="a string, b string")
    assert hashes[0] != hashes[1]
    assert hashes[2][0] == hashes[3][0]          # NULL and '' are one value for change detection
    assert hashes[2][1] != hashes[3][1]          # but not for keys


@pytest.mark.parametrize("n,d,s", [(201, 200, 2), (-201, 200, 2), (1, 8, 2), (5, 2, 0), (-5, 2, 0), (1, 3, 2), (2, 3, 3), (0, 7, 1), (1005, 1000, 2)])
def test_quotient_rounds_half_away_from_zero(spark, n, d, s):
    assert one(spark, numeric.quotient(F.lit(n), F.lit(d), s)) == [(half_up(n, d, s),)]


def test_zero_and_null_denominators(spark):
    rows = [(4.5, 0.0), (4.5, None), (None, 2.0), (4.5, 2.0)]
    assert one(spark, numeric.ratio("a", "b", 2), rows=rows, schema="a double, b double") == [(None,), (None,), (None,), (2.25,)]


def test_sums_do_not_depend_on_order(spark):
    values = [(0.1,), (0.2,), (0.3,), (1e6,), (-1e6,)]
    for rows in (values, values[::-1]):
        assert spark.createDataFrame(rows, "x double").agg(numeric.exact_sum("x")).first()[0] == 0.6


def test_in_list_ignores_null_members(spark):
    got = one(spark, filters.in_list("s", ["a", None]), filters.not_in_list("s", ["a", None]), rows=[("a",), ("b",), (None,)], schema="s string")
    assert got == [(True, False), (False, True), (None, None)]


def test_position_ladder_takes_first_hit(spark):
    got = one(spark, labels.position_category("p"), rows=[("DF,MF",), ("mf",), ("GK",), ("LW",), ("?",), (None,)], schema="p string")
    assert [g[0] for g in got] == ["Defender", "Midfielder", "Goalkeeper", "Forward", "Unknown", "Unknown"]


def test_prefix_is_literal_text(spark):
    rows = [("100% United", "100%_"), ("Ajax", "AJAX Amsterdam"), ("", "x"), ("x", None)]
    got = one(spark, text.contains_prefix("a", "b"), text.contains_prefix("b", "a"), rows=rows, schema="a string, b string")
    assert got == [(False, False), (False, True), (False, True), (None, None)]


def test_nonblank(spark):
    rows = [("x",), ("  ",), (" nan ",), (None,), ("",)]
    assert [g[0] for g in one(spark, text.nonblank("s", "nan"), rows=rows, schema="s string")] == [True, False, False, False, False]


def test_age_and_movement(spark):
    got = one(spark, numeric.age_in(2025, "x"), labels.movement("x"), rows=[(2,), (-3,), (0,), (None,)])
    assert got == [(2023, "📈 Up 2"), (2028, "📉 Down 3"), (2025, "➡️ Same"), (None, "➡️ Same")]
