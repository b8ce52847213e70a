"""Tables by name or by path, and history tables that only ever grow.

A history table is a folder of load attempts and a small table of commits::

    <root>/<table>/attempt=<batch>-<n>/versions=open|tail|closed/*.parquet
    <root>/<table>/commits/*.parquet

A batch appends what it changes and nothing else: its new versions, and marks for keys that it no longer holds.  When a
version ends isn't written; it follows, on reading, from the next version of its key.  The first load is the table's
*base*, later batches are its *tail*: base rows meet the next version of their key by one join with the tail's keys, the
tail is put in order by one aggregation per key.  Once the tail has more rows than the base has open ones, the next load
settles it first: ended versions go to a closed part with their end, the open ones become the new base.

A row in ``commits``, written last, makes an attempt visible.  No file is ever overwritten or removed, so an attempt that
failed or was repeated is simply not read, and a table can be read as it was at any time from the base and tail of then.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.operators import changes
from touchline.operators.sides import stack_all
from touchline.operators.windows import dedup_latest

LAYERS = ("bronze", "silver", "gold")


# --- catalog tables ---------------------------------------------------------------
def setup_layers(spark: SparkSession, location: str | None = None, layers: Sequence[str] = LAYERS, prefix: str = "") -> list[str]:
    for layer in layers:
        at = f" LOCATION '{location}/{prefix}{layer}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {prefix}{layer}{at}")
    have = {r[0] for r in spark.sql("SHOW SCHEMAS").collect()}
    return [f"{prefix}{x}" for x in layers if f"{prefix}{x}" in have]


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or Parquet when ``name`` is a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def write_overwrite(df: DataFrame, path: str, *, partition_by: Sequence[str] = ()) -> None:
    """Replace a table at a path.  ``df`` must not read from that path."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def write_append(df: DataFrame, path: str, *, partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode("append")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def write_clustered(df: DataFrame, path: str, by: Sequence[str], *, row_group: int | None = None) -> None:
    """Replace a table at a path, its rows sorted in ranges of ``by``, with Bloom filters on these columns.

    Equal values lie in few row groups, so a lookup by leading columns of ``by`` (or, through the filters, by any one of
    them) opens these only.  ``row_group`` is the size of a row group in bytes.
    """
    w = df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite")
    for name in by:
        w = w.option(f"parquet.bloom.filter.enabled#{name}", "true")
    (w.option("parquet.block.size", str(row_group)) if row_group else w).parquet(path)


_V1 = "spark.sql.sources.useV1SourceList"


def footer_scan(spark: SparkSession, path: str) -> DataFrame:
    """Parquet at a path through the reader that answers counts, least and greatest values from file footers."""
    listed = spark.conf.get(_V1)
    spark.conf.set(_V1, ",".join(x for x in listed.split(",") if x != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(_V1, listed)


def _countable(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table to be counted: from its footers where it is Parquet."""
    about = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    is_parquet = (about.get("Provider") or "").lower() == "parquet" and about.get("Location")
    return footer_scan(spark, about["Location"]) if is_parquet else spark.table(name)


def table_inventory(spark: SparkSession, layers: Sequence[str]) -> DataFrame:
    """Row counts of every table of the layers, as one query; Parquet tables are counted without reading a row."""
    names = [(layer, t.name) for layer in layers for t in spark.catalog.listTables(layer) if not t.isTemporary]
    return row_counts({(layer, t): _countable(spark, f"{layer}.{t}") for layer, t in names})


def row_counts(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    return stack_all([
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "rows")
        for (layer, name), df in tables.items()
    ])


# --- history tables ---------------------------------------------------------------
# What a row of a batch says about its key: a new version; its end; not in the batch, yet still current; back unchanged.
NEW, END, MISSING, BACK = "new", "end", "missing", "back"
_COMMITS = ("batch_id string, seq long, kind string, attempt string, columns string, keys array<string>, at timestamp, "
            "rows long, origin string")
_STATISTICS = "table_name string, new_records long, updated_records long, unchanged_records long, deleted_records long"
_DERIVED = ("valid_to", "transformed_at", "is_current")
ROWS_A_FILE = 1_000
"""An attempt whose files have fewer rows than this, on average, is written again in fewer files."""


@dataclass(frozen=True)
class _Known:
    """The commits that make up a table: base, tail (oldest first) and settled parts."""

    batches: list[Row]
    base: Row
    tail: list[Row]
    settled: list[Row]

    @property
    def keys(self) -> list[str]:
        return self.batches[-1].keys

    def fields(self) -> list[T.StructField]:
        """All columns that any batch wrote, in order of appearance; a later type wins."""
        out: dict[str, T.StructField] = {}
        for r in self.batches:
            out |= {f.name: f for f in T.StructType.fromJson(json.loads(r.columns)).fields}
        return list(out.values())


def _log(spark: SparkSession, path: str) -> list[Row]:
    """Every commit: a row a load, and one for each time the tail was settled."""
    try:
        return sorted(spark.read.schema(_COMMITS).parquet(f"{path}/commits").collect(), key=lambda r: r.seq)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def _known(log: Sequence[Row], before: str | None = None, at=None) -> _Known | None:
    """The table as of the batches before ``before``, or of those loaded at ``at`` or earlier.

    The last commit of a batch counts.  A settled base counts unless one of its batches was loaded again after it.
    """
    last = {r.batch_id: r for r in log if r.kind == "batch"}
    batches = [last[b] for b in sorted(last) if (before is None or b < before) and (at is None or last[b].at <= at)]
    if not batches:
        return None
    settled = [c for c in log if c.kind == "settled" and c.batch_id <= batches[-1].batch_id
               and all(r.seq < c.seq for b, r in last.items() if b <= c.batch_id)]
    base = settled[-1] if settled else batches[0]
    return _Known(batches, base, [b for b in batches if b.batch_id > base.batch_id and b.rows], settled)


def batch_count(spark: SparkSession, path: str) -> int:
    """Loads so far: no key can have more versions than this."""
    known = _known(_log(spark, path))
    return len(known.batches) if known else 0


def batch_of(spark: SparkSession, path: str, origin: str) -> str | None:
    """The batch that was loaded from ``origin``."""
    return next((r.batch_id for r in reversed(_log(spark, path)) if r.origin == origin), None)


def _files(spark: SparkSession, path: str, attempts: Sequence[Row], part: str, schema: T.StructType) -> DataFrame:
    """The rows of one part of some attempts.  The schema is known, so nothing is inferred from files."""
    at = [f"{path}/attempt={r.attempt}/versions={part}" for r in attempts if r.rows]
    return spark.read.schema(schema).parquet(*at) if at else spark.createDataFrame([], schema)


def _events(spark: SparkSession, path: str, known: _Known) -> tuple[DataFrame, DataFrame]:
    """(base rows, tail rows): business columns, record_hash, valid_from, ``__kind`` and ``__batch``."""
    schema = T.StructType([*known.fields(), T.StructField("__kind", T.StringType()), T.StructField("__batch", T.StringType())])
    return _files(spark, path, [known.base], "open", schema), _files(spark, path, known.tail, "tail", schema)


def _derive(base: DataFrame, tail: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Versions with ``valid_to``, and in ``__kind`` whether the newest one's key is missing from its batch."""
    names = [n for n in base.columns if n not in ("__kind", "__batch")]
    if tail is None:
        return base.select(*names, F.lit(None).cast("timestamp").alias("valid_to"), "__kind")
    # Narrow events only: one of a key and batch, so a key's list is as long as the tail has batches at most.
    per_key = tail.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__batch", "__kind", "valid_from"))).alias("e"))
    per_key = per_key.withColumn("steps", F.filter("e", lambda x: x["__kind"].isin(NEW, END)))
    state = F.element_at("e", -1)["__kind"].alias("__state")
    ended = F.transform("steps", lambda x, i: F.struct(x["__batch"].alias("__batch"), x["__kind"].alias("__step"), F.get("steps", i + 1)["valid_from"].alias("valid_to")))
    added = per_key.select(*keys, state, F.inline(F.filter(ended, lambda v: v["__step"] == NEW)))
    added = tail.join(added, [*keys, "__batch"]).select(*names, "valid_to", F.col("__state").alias("__kind"))
    ends = per_key.select(*[F.col(k).alias(f"__e{i}") for i, k in enumerate(keys)], F.get("steps", F.lit(0))["valid_from"].alias("valid_to"), state)
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__e{i}") for i, k in enumerate(keys)])
    old = base.join(ends, on, "left").select(*names, "valid_to", F.coalesce("__state", "__kind").alias("__kind"))
    return old.unionByName(added)


def _state(base: DataFrame, tail: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Key, ``record_hash`` and last event of every key; narrow columns only."""
    cols = [*keys, "record_hash", "__kind", "__batch"]
    if tail is None:
        return base.select(*cols[:-1])
    last = F.max_by(F.struct("record_hash", "__kind"), "__batch").alias("s")
    return base.select(*cols).unionByName(tail.select(*cols)).groupBy(*keys).agg(last).select(*keys, "s.record_hash", "s.__kind")


def _read(spark: SparkSession, path: str, known: _Known, *, closed: bool = True) -> DataFrame:
    base, tail = _events(spark, path, known)
    open_ = _derive(base, tail if known.tail else None, known.keys).drop("__kind")
    fields = [f for f in known.fields() if f.name in open_.columns]
    rows = open_
    if closed and known.settled:
        schema = T.StructType([*fields, T.StructField("valid_to", T.TimestampType())])
        rows = open_.unionByName(_files(spark, path, known.settled, "closed", schema).filter(F.col("valid_to").isNotNull()))
    out = rows.withColumns({"transformed_at": F.coalesce("valid_to", "valid_from"), "is_current": F.col("valid_to").isNull()})
    return out.select(*[f.name for f in fields if f.name != "valid_from"], "valid_from", *_DERIVED)


def read_history(spark: SparkSession, path: str, *, before: str | None = None) -> DataFrame | None:
    """All versions, or None when no batch is committed (``before`` hides later batches).

    Columns that older batches did not have are NULL there.
    """
    known = _known(_log(spark, path), before)
    return _read(spark, path, known) if known else None


def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """Versions in force after the newest batch; closed parts aren't read."""
    known = _known(_log(spark, path))
    return _read(spark, path, known, closed=False).filter("is_current") if known else None


def read_as_of(spark: SparkSession, path: str, ts) -> DataFrame | None:
    """Versions in force at ``ts``, as they were known then (``valid_to`` is NULL).

    Reads the base of that time and the tail up to it: neither closed parts nor attempts of later batches are opened.
    """
    at = spark.range(1).select(F.lit(ts).cast("timestamp").alias("at")).first().at
    known = _known(_log(spark, path), at=at)
    return _read(spark, path, known, closed=False).filter("is_current") if known else None


def _commit(spark: SparkSession, path: str, batch_id: str, seq: int, kind: str, attempt: str, columns: str, keys: Sequence[str], ts, rows: int, origin: str | None) -> None:
    row = spark.range(1).select(
        F.lit(batch_id).alias("batch_id"), F.lit(seq).cast("long").alias("seq"), F.lit(kind).alias("kind"), F.lit(attempt).alias("attempt"), F.lit(columns).alias("columns"),
        F.array(*map(F.lit, keys)).alias("keys"), F.lit(ts).cast("timestamp").alias("at"), F.lit(rows).cast("long").alias("rows"), F.lit(origin).cast("string").alias("origin"))
    row.coalesce(1).write.mode("append").parquet(f"{path}/commits")


def _write(spark: SparkSession, path: str, batch_id: str, part: str, rows: DataFrame) -> tuple[str, int]:
    """Write an attempt; scattered changes that came in many small files are written again in few.  (attempt, rows)."""
    def attempt() -> tuple[str, str]:
        name = f"{batch_id}-{uuid4().hex[:12]}"
        return name, f"{path}/attempt={name}/versions={part}"

    name, at = attempt()
    rows.write.parquet(at)
    written = spark.read.schema(rows.schema).parquet(at)
    n = written.count()
    files = len(written.inputFiles())
    if files > 1 and 0 < n < files * ROWS_A_FILE:
        name, at = attempt()
        written.coalesce(max(1, n // (100 * ROWS_A_FILE))).write.parquet(at)
    return name, n


def _write_first(spark: SparkSession, path: str, batch_id: str, rows: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> tuple[str, int]:
    """Write the first load of a table, one row a key.  (attempt, rows).

    Nothing is joined, so rows stay where they are: they are written as they come and their keys alone are counted.  Only
    if a key repeats are the written rows brought together, and written again without the repeats.
    """
    name, n = _write(spark, path, batch_id, "open", rows)
    if n:
        written = spark.read.schema(rows.schema).parquet(f"{path}/attempt={name}/versions=open")
        if not written.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty():
            return _write(spark, path, batch_id, "open", dedup_latest(written, keys, [*latest_by, "record_hash"]))
    return name, n


def settle(spark: SparkSession, path: str, *, before: str | None = None) -> bool:
    """Make the versions that are open now the new base and put ended ones, with their end, into a closed part."""
    log = _log(spark, path)
    known = _known(log, before)
    if known is None or not known.tail:
        return False
    newest = known.batches[-1]
    base, tail = _events(spark, path, known)
    rows = _derive(base, tail, known.keys)
    name = f"{newest.batch_id}-settled-{uuid4().hex[:12]}"
    rows = rows.withColumns({"__batch": F.lit(newest.batch_id), "versions": F.when(F.col("valid_to").isNull(), "open").otherwise("closed")})
    seen = Observation()
    rows.observe(seen, F.count_if(F.col("versions") == "open").alias("n")).write.partitionBy("versions").parquet(f"{path}/attempt={name}")
    # Both parts must exist for their readers.
    for part in ("open", "closed"):
        rows.limit(0).drop("versions").write.mode("append").parquet(f"{path}/attempt={name}/versions={part}")
    columns = T.StructType(known.fields()).json()
    _commit(spark, path, newest.batch_id, log[-1].seq + 1, "settled", name, columns, known.keys, newest.at, max(seen.get["n"], 1), None)
    return True


def load_batch(spark: SparkSession, path: str, config: changes.TableConfig, source: DataFrame, batch_id: str, ts, *, origin: str | None = None) -> DataFrame:
    """Apply one batch to a history table and return its statistics row.

    ``batch_id`` must sort by time.  A batch older than the newest committed one is refused; repeating a batch is safe.
    The batch is computed once and joined once with the keys and hashes of the table; what is written grows with the
    rows that changed.  A key that a batch lacks counts as deleted once, until it is back.
    """
    if config.deletes not in ("keep", "close"):
        raise ValueError("deletes must be 'keep' or 'close'")
    log = _log(spark, path)
    newest = max((r.batch_id for r in log), default=batch_id)
    if batch_id < newest:
        raise ValueError(f"batch {batch_id} is older than committed batch {newest}")
    known = _known(log, before=batch_id)
    if known and known.tail and sum(b.rows for b in known.tail) > known.base.rows:
        settle(spark, path, before=batch_id)
        log = _log(spark, path)
        known = _known(log, before=batch_id)
    keys = list(config.keys)
    if known is None:
        rows = changes.stamp_version(changes.with_hash(config.transform(source), config.hash_cols), ts).drop(*_DERIVED)
        columns = T.StructType(rows.schema.fields).json()
        attempt, n = _write_first(spark, path, batch_id, rows.withColumns({"__kind": F.lit(NEW), "__batch": F.lit(batch_id)}), keys, config.latest_by)
        _commit(spark, path, batch_id, log[-1].seq + 1 if log else 1, "batch", attempt, columns, keys, ts, n, origin)
        return spark.createDataFrame([(config.target, n, 0, 0, 0)], _STATISTICS)
    batch = changes.prepare(config.transform(source), keys, config.hash_cols, ts, config.latest_by).drop(*_DERIVED)
    columns = T.StructType(batch.schema.fields).json()
    stamp = {"valid_from": F.lit(ts).cast("timestamp"), "__batch": F.lit(batch_id)}
    seen = Observation()
    counted = {a: F.count_if(F.col("action") == a) for a in ("INSERT", "UPDATE", "UNCHANGED", "DELETE")}
    base, tail = _events(spark, path, known)
    state = _state(base, tail if known.tail else None, keys)
    old = state.select(*[F.col(k).alias(f"__o{i}") for i, k in enumerate(keys)], F.struct("record_hash", "__kind").alias("old"))
    new = batch.select(*[F.col(k).alias(f"__n{i}") for i, k in enumerate(keys)], F.struct("*").alias("new"))
    on = reduce(lambda a, b: a & b, [F.col(f"__n{i}") == F.col(f"__o{i}") for i in range(len(keys))])
    was, here = F.col("old.__kind"), F.col("new").isNotNull()
    known_key = was.isNotNull() & (was != END)
    same = F.col("new.record_hash").eqNullSafe(F.col("old.record_hash"))
    vanished = ~here & known_key & (F.lit(config.deletes == "close") | (was != MISSING))
    action = (F.when(here & ~known_key, "INSERT").when(here & ~same, "UPDATE").when(here, "UNCHANGED").when(vanished, "DELETE"))
    kind = (F.when(F.col("action").isin("INSERT", "UPDATE"), NEW).when(F.col("action") == "DELETE", END if config.deletes == "close" else MISSING)
            .when((F.col("action") == "UNCHANGED") & (was == MISSING), BACK))
    rows = new.join(old, on, "full_outer").withColumn("action", action).withColumn("__kind", kind)
    own = {k: F.coalesce(F.col("new")[k], F.col(f"__o{i}")) for i, k in enumerate(keys)} | {"record_hash": F.coalesce("new.record_hash", "old.record_hash")}
    rows = rows.select(*[own.get(n, F.when(F.col("__kind") == NEW, F.col("new")[n])).alias(n) for n in batch.columns], "action", "__kind")
    rows = rows.withColumns(stamp).observe(seen, *[v.alias(a) for a, v in counted.items()])
    attempt, n = _write(spark, path, batch_id, "tail", rows.filter(F.col("__kind").isNotNull()).drop("action"))
    _commit(spark, path, batch_id, log[-1].seq + 1, "batch", attempt, columns, keys, ts, n, origin)
    found = seen.get
    return spark.createDataFrame([(config.target, *[found[a] for a in counted])], _STATISTICS)
