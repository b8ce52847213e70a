"""Declarative data-quality checks, a whole suite in one scan of its table.

Every row becomes a few small entries: one with the outcome of all row rules as bits, one per grouping rule with the
rule's number and the row's key, and one per broken row rule where samples are wanted.  Entries are pre-aggregated in each
task and meet in one exchange, together with the keys of foreign-key parents; group-size rules need a second, small one.
A suite is one DataFrame and one job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.filters import not_in_list

# fixed values: result texts
PASS, FAIL, ERROR = "✅ PASS", "❌ FAIL", "⚠️ ERROR"

RESULT_SCHEMA = (
    "layer string, table_name string, check_type string, check_name string, status string, passed boolean, "
    "details string, records_checked long, records_failed long, check_timestamp timestamp"
)
RULE_SCHEMA = "test_name string, status string, details string, timestamp timestamp, run_id string"


@dataclass(frozen=True)
class Check:
    """One rule.  ``kind`` picks the family; build instances with the helpers below.

    ``bad`` and ``scope`` build their columns when a suite runs, so rules can be declared
    before a session exists.
    """

    kind: str
    check_type: str
    name: str
    cols: tuple[str, ...] = ()
    bad: Callable[[], Column] | None = None    # row rules: rows that violate
    scope: Callable[[], Column] | None = None  # row rules: rows that count as checked
    where: str | None = None
    options: Mapping = field(default_factory=dict)


def _given(col: str) -> Callable[[], Column]:
    return lambda: F.col(col).isNotNull()


def not_null(*cols: str, where: str | None = None) -> list[Check]:
    return [Check("row", "Completeness", f"NOT NULL: {c}", (c,), lambda c=c: F.col(c).isNull(), where=where) for c in cols]


def unique(*cols: str, where: str | None = None) -> Check:
    return Check("unique", "Uniqueness", f"UNIQUE: {', '.join(cols)}", cols, where=where)


def accepted(col: str, values: Iterable, where: str | None = None) -> Check:
    allowed = list(values)
    return Check("row", "Validity", f"VALID VALUES: {col}", (col,), lambda: F.col(col).isNotNull() & not_in_list(col, allowed), _given(col), where)


def in_range(col: str, lo=None, hi=None, where: str | None = None) -> Check:
    def outside() -> Column:
        tests = [F.col(col) < lo] if lo is not None else []
        tests += [F.col(col) > hi] if hi is not None else []
        return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)

    return Check("row", "Validity", f"RANGE: {col} in [{lo}, {hi}]", (col,), outside, _given(col), where)


def row_rule(name: str, holds: str, where: str | None = None) -> Check:
    """Rows where the expression ``holds`` is false violate; NULL is neither."""
    return Check("row", "Consistency", name, (), lambda: ~F.expr(holds), where=where)


def matches(col: str, pattern: str, where: str | None = None) -> Check:
    return Check("row", "Validity", f"PATTERN: {col}", (col,), lambda: ~F.rlike(F.col(col), F.lit(pattern)), _given(col), where)


def foreign_key(col: str, parent: str, parent_col: str, where: str | None = None) -> Check:
    return Check("fk", "Consistency", f"FK: {col} → {parent}.{parent_col}", (col,), where=where,
                 options={"parent": parent, "parent_col": parent_col})


def group_size(keys: Sequence[str], distinct: str, lo: int, hi: int, where: str | None = None) -> Check:
    return Check("group", "Completeness", f"GROUP SIZE: {distinct} per {', '.join(keys)} in [{lo}, {hi}]",
                 tuple(keys), where=where, options={"distinct": distinct, "lo": lo, "hi": hi})


def fresh(col: str, max_hours: float) -> Check:
    return Check("fresh", "Timeliness", f"FRESHNESS: {col}", (col,), options={"hours": max_hours})


def scd2(*keys: str) -> list[Check]:
    return [
        Check("unique", "SCD2 Integrity", f"SINGLE CURRENT: {', '.join(keys)}", keys, where="is_current"),
        Check("row", "SCD2 Integrity", "VALID DATES: closed records", (),
              lambda: F.col("valid_to").isNull() | (F.col("valid_from") > F.col("valid_to")), where="NOT is_current"),
    ]


def _n() -> Column:
    return F.count(F.lit(1))


MOST_SAMPLES = 5
_SAMPLE_BUCKETS = 2   # hex digits of a sample's MD5: 256 candidates per rule and task
_BITS = 30            # row rules per entry: two bits each in a LONG


def sampled(text: Column) -> Column:
    """A sample as its MD5 and text; samples of a rule are the least MD5 of each bucket (its first digits), the least of these first."""
    return F.concat(F.md5(text), text)


def _bucket(sample: Column) -> Column:
    return F.substring(sample, 1, _SAMPLE_BUCKETS)


def _least(samples: Column) -> Column:
    return F.transform(F.slice(F.array_sort(samples), 1, MOST_SAMPLES), lambda x: F.substring(x, 33, 2**31 - 1))


def _text(cols: Sequence[Column]) -> Column:
    """Key columns as text; equal keys and no others give equal texts, NULLs included."""
    return F.to_json(F.struct(*[c.alias(f"k{i}") for i, c in enumerate(cols)]))


def _common_type(a: DataFrame, b: DataFrame, cols: tuple[str, str]) -> str:
    """The type in which Spark compares two columns."""
    types = [df.select(n).schema[0].dataType for df, n in zip((a, b), cols)]
    both = F.coalesce(*[F.lit(None).cast(t) for t in types])
    return types[0].simpleString() if types[0] == types[1] else a.sparkSession.range(0).select(both).schema[0].dataType.simpleString()


def _entries(df: DataFrame, numbered: Sequence[tuple[int, Check]], parents: Mapping[str, DataFrame], sample_by: Sequence[str] | None) -> DataFrame:
    """Entries of the table and of its parents: (ix, key, member, sample, at, parent).

    ``ix`` is the rule's number; -1 - k stands for the k-th block of row rules, whose outcomes are the bits of ``key``.
    """
    none = F.lit(None).cast("string")

    def entry(ix: int, key: Column = none, member: Column = none, sample: Column = none, at: Column | None = None) -> Column:
        at = F.lit(None).cast("timestamp") if at is None else at
        return F.struct(F.lit(ix).alias("ix"), key.alias("key"), member.alias("member"), sample.alias("sample"), at.alias("at"), F.lit(False).alias("parent"))

    entries, bits, broken = [], [], []
    found = F.to_json(F.struct(*sample_by)) if sample_by else None
    lookups = []
    for i, c in numbered:
        scope = F.expr(c.where) if c.where else F.lit(True)
        if c.kind == "row":
            seen = F.coalesce(scope & c.scope() if c.scope else scope, F.lit(False))
            bad = F.coalesce(scope & c.bad(), F.lit(False))
            bits.append((i, seen, bad))
            if sample_by:
                broken.append(F.when(bad, entry(i, _bucket(sampled(found)), sample=sampled(found))))
        elif c.kind == "fresh":
            entries.append(entry(i, at=F.col(c.cols[0]).cast("timestamp")))
        else:
            cols, member = [F.col(n) for n in c.cols], none
            if c.kind == "group":
                one = F.col(c.options["distinct"])
                member = F.when(one.isNotNull(), _text([one]))
            elif c.kind == "fk":
                parent = parents[c.options["parent"]]
                kind = _common_type(df, parent, (c.cols[0], c.options["parent_col"]))
                cols = [cols[0].cast(kind)]
                known = parent.filter(F.col(c.options["parent_col"]).isNotNull()).select(_text([F.col(c.options["parent_col"]).cast(kind)]).alias("key"))
                lookups.append(known.select(F.lit(i).alias("ix"), "key", none.alias("member"), none.alias("sample"), F.lit(None).cast("timestamp").alias("at"), F.lit(True).alias("parent")))
            entries.append(F.when(scope, entry(i, _text(cols), member)))
    for k in range(0, len(bits), _BITS):
        block = [F.when(seen, 1 << 2 * j).otherwise(0) + F.when(bad, 2 << 2 * j).otherwise(0) for j, (_, seen, bad) in enumerate(bits[k: k + _BITS])]
        entries.append(entry(-1 - k // _BITS, reduce(lambda a, b: a + b, block, F.lit(0).cast("long")).cast("string")))
    own = df.select(F.inline(F.array_compact(F.array(*entries, *broken))))
    return reduce(DataFrame.unionByName, lookups, own)


def _suite_counts(df: DataFrame, numbered: Sequence[tuple[int, Check]], parents: Mapping[str, DataFrame], now: Column, sample_by: Sequence[str] | None) -> DataFrame:
    """ix, checked, failed and samples of every check, also of those that no row concerns."""
    of_kind = {k: [i for i, c in numbered if c.kind == k] for k in ("row", "unique", "fk", "group", "fresh")}
    groups = [(i, c) for i, c in numbered if c.kind == "group"]
    row_blocks = [of_kind["row"][k: k + _BITS] for k in range(0, len(of_kind["row"]), _BITS)]
    per_key = _entries(df, numbered, parents, sample_by).groupBy("ix", "key", "member").agg(
        F.count_if(~F.col("parent")).alias("rows"), F.min("sample").alias("sample"), F.max("at").alias("at"), F.max("parent").alias("parent"))
    if groups:
        per_key = per_key.groupBy("ix", "key").agg(F.sum("rows").alias("rows"), F.count("member").alias("members"), F.min("sample").alias("sample"), F.max("at").alias("at"), F.max("parent").alias("parent"))
    else:
        per_key = per_key.withColumn("members", F.lit(0).cast("long"))
    rows, ix = F.col("rows"), F.col("ix")
    zero = F.lit(0).cast("long")

    def count(i: Column, checked: Column, failed: Column, sample: Column) -> Column:
        return F.struct(i.cast("int").alias("ix"), checked.cast("long").alias("checked"), failed.cast("long").alias("failed"), sample.cast("string").alias("sample"))

    none = F.lit(None)
    key_sample = sampled(F.col("key")) if sample_by else none
    cases = []
    for k, block in enumerate(row_blocks):
        flags = F.col("key").cast("long")
        outcome = [count(F.lit(i), F.when(flags.bitwiseAND(F.lit(1 << 2 * j)) != 0, rows).otherwise(0), F.when(flags.bitwiseAND(F.lit(2 << 2 * j)) != 0, rows).otherwise(0), none) for j, i in enumerate(block)]
        cases.append((ix == -1 - k, F.array(*outcome)))
    if of_kind["row"] and sample_by:
        cases.append((ix.isin(of_kind["row"]), F.array(count(ix, zero, zero, F.col("sample")))))
    if of_kind["unique"]:
        bad = rows > 1
        cases.append((ix.isin(of_kind["unique"]), F.array(count(ix, rows, bad.cast("long"), F.when(bad, key_sample)))))
    if of_kind["fk"]:
        bad = ~F.col("parent") & (rows > 0)
        cases.append((ix.isin(of_kind["fk"]), F.array(count(ix, rows, F.when(bad, rows).otherwise(0), F.when(bad, key_sample)))))
    for i, c in groups:
        bad = ~F.col("members").between(c.options["lo"], c.options["hi"])
        cases.append((ix == i, F.array(count(ix, F.lit(1), bad.cast("long"), F.when(bad, key_sample)))))
    for i, c in numbered:
        if c.kind == "fresh":
            age = (F.unix_micros(now) - F.unix_micros(F.col("at"))) / F.lit(3_600_000_000.0)
            late = F.when(age <= c.options["hours"], 0).otherwise(1)
            cases.append((ix == i, F.array(count(ix, zero, late, none))))
    outcome = reduce(lambda rest, case: F.when(case[0], case[1]).otherwise(rest), cases, F.array().cast("array<struct<ix:int,checked:bigint,failed:bigint,sample:string>>"))
    counts = per_key.select(F.inline(outcome))
    # A check that no row concerns has checked nothing; without any row nothing is fresh.
    spark = df.sparkSession
    nothing = spark.range(len(numbered)).select(F.col("id").cast("int").alias("ix"), zero.alias("checked"), zero.alias("failed"), none.cast("string").alias("sample"))
    counts = counts.unionByName(nothing)
    per_bucket = counts.groupBy("ix", _bucket(F.col("sample")).alias("bucket")).agg(
        F.sum("checked").alias("checked"), F.sum("failed").alias("failed"), F.min("sample").alias("sample"), _n().alias("entries"))
    out = per_bucket.groupBy("ix").agg(F.sum("checked").alias("checked"), F.sum("failed").alias("failed"), F.sum("entries").alias("entries"), _least(F.collect_list("sample")).alias("samples"))
    never = ix.isin(of_kind["fresh"]) & (F.col("entries") == 1)
    return out.select("ix", "checked", F.when(never, 1).otherwise(F.col("failed")).cast("long").alias("failed"), "samples")


def run_suite(df: DataFrame, layer: str, table: str, checks: Iterable, now, parents: Mapping[str, DataFrame] | None = None, *, sample_by: Sequence[str] | None = None) -> DataFrame:
    """Results of every check of one table.  ``now`` is a timestamp, never the driver's clock.

    ``sample_by`` names columns that tell rows apart and adds ``samples``: at most five failing rows of a row rule (these
    columns as JSON) or failing keys of a grouping rule (``k0``, ``k1``, …), chosen as :func:`sampled` says.
    """
    flat: list[Check] = []
    for c in checks:
        flat.extend(c if isinstance(c, list) else [c])
    at = F.lit(now).cast("timestamp")
    counts = _suite_counts(df, list(enumerate(flat)), parents or {}, at, sample_by)

    def text(values: Sequence[str]) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col("ix"))

    passed = F.col("failed") == 0
    return counts.select(
        F.lit(layer).alias("layer"),
        F.lit(table).alias("table_name"),
        text([c.check_type for c in flat]).alias("check_type"),
        text([c.name for c in flat]).alias("check_name"),
        F.when(passed, PASS).otherwise(FAIL).alias("status"),
        passed.alias("passed"),
        F.concat(F.col("failed").cast("string"), F.lit(" failed")).alias("details"),
        F.col("checked").alias("records_checked"),
        F.col("failed").alias("records_failed"),
        at.alias("check_timestamp"),
        *(["samples"] if sample_by else []),
    )


def run_rule(spark: SparkSession, name: str, query: str, now, run_id: str, *, should_be_empty: bool = True, samples: bool = False) -> DataFrame:
    """One SQL rule as one result row; ``samples`` adds at most five of its rows, as JSON, found while they are counted.

    The rule runs at once.  A query that does not analyse or fails while it runs is an ERROR result of this rule.
    """
    kept: list[str] = []
    try:
        n, kept = _rule_rows(spark.sql(query), samples)
        ok = n == 0 if should_be_empty else n > 0
        status, details = (PASS, "OK") if ok else (FAIL, f"{n} failures" if should_be_empty else "No data found")
    except PySparkException as e:
        status, details = ERROR, str(e)[:100]
    added = ", samples array<string>" if samples else ""
    row = (name, status, details, run_id, kept) if samples else (name, status, details, run_id)
    return spark.createDataFrame([row], f"test_name string, status string, details string, run_id string{added}").select(
        "test_name", "status", "details", F.lit(now).cast("timestamp").alias("timestamp"), "run_id", *(["samples"] if samples else []))


def _rule_rows(rows: DataFrame, samples: bool) -> tuple[int, list[str]]:
    """(number of rows, samples of them): one pass, one row per bucket and task."""
    if not samples:
        return rows.count(), []
    some = rows.select(sampled(F.to_json(F.struct("*"))).alias("sample"))
    found = some.groupBy(_bucket(F.col("sample")).alias("bucket")).agg(_n().alias("n"), F.min("sample").alias("sample"))
    got = found.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), _least(F.collect_list("sample")).alias("samples")).first()
    return got.n, got.samples


def failing_rows(spark: SparkSession, query: str, n: int = 5) -> DataFrame:
    """First rows of a failing rule, for a look."""
    return spark.sql(query).limit(n)


def summary(results: DataFrame) -> DataFrame:
    """Totals over check results or rule results."""
    from touchline.functions.numeric import share

    n = {k: F.count_if(F.col("status") == v) for k, v in {"passed": PASS, "failed": FAIL, "errors": ERROR}.items()}
    return results.agg(_n().alias("total"), *[v.alias(k) for k, v in n.items()]).withColumn("pass_rate", share("passed", "total"))


def trend(results: DataFrame, *keys: Column | str) -> DataFrame:
    """Totals per day and layer, per run, or per any other keys."""
    from touchline.functions.numeric import share

    return results.groupBy(*keys).agg(
        _n().alias("total_checks"),
        F.count_if(F.col("status") == PASS).alias("passed"),
        F.count_if(F.col("status") == FAIL).alias("failed"),
    ).withColumn("pass_rate", share("passed", "total_checks"))


def failed_only(results: DataFrame) -> DataFrame:
    return results.filter(F.col("status") == FAIL)
