"""Slowly changing records, type 2 (full history) and type 1 (overwrite).

One full outer join between the batch and the *current* versions yields everything:
actions, closed versions, new versions.  Both sides hold one row per business key, so the
join has no hot key; closed versions never enter it.  The join uses plain equality, which
keeps the partitioning of the de-duplication before it (a NULL key matches nothing, so
transforms drop NULL keys).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.text import record_hash, surrogate_key
from touchline.operators.windows import dedup_latest

HISTORY_COLUMNS = ["record_hash", "valid_from", "valid_to", "is_current", "transformed_at"]


def _ts(ts):
    return F.lit(ts).cast("timestamp")


def with_hash(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumn("record_hash", record_hash(*cols))


def stamp_version(df: DataFrame, ts) -> DataFrame:
    """Mark rows as current versions starting at the batch timestamp."""
    return df.withColumns({
        "valid_from": _ts(ts),
        "valid_to": F.lit(None).cast("timestamp"),
        "is_current": F.lit(True),
        "transformed_at": _ts(ts),
    })


def version_key(*keys: str):
    return surrogate_key(*keys, "valid_from")


def prepare(batch: DataFrame, keys: Sequence[str], hash_cols: Sequence[str], ts, latest_by: Sequence[str] = ()) -> DataFrame:
    """De-duplicate on the business key, hash the transformed columns, stamp."""
    hashed = with_hash(batch, hash_cols)
    return stamp_version(dedup_latest(hashed, keys, [*latest_by, "record_hash"]), ts)


def _paired(batch: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    new = batch.select(*[F.col(k).alias(f"__n{i}") for i, k in enumerate(keys)], F.struct("*").alias("new"))
    old = current.select(*[F.col(k).alias(f"__o{i}") for i, k in enumerate(keys)], F.struct(*batch.columns).alias("old"))
    on = reduce(lambda a, b: a & b, [F.col(f"__n{i}") == F.col(f"__o{i}") for i in range(len(keys))])
    action = (F.when(F.col("old").isNull(), "INSERT")
              .when(F.col("new").isNull(), "DELETE")
              .when(~F.col("new.record_hash").eqNullSafe(F.col("old.record_hash")), "UPDATE")
              .otherwise("UNCHANGED"))
    return new.join(old, on, "full_outer").withColumn("action", action)


def classify(batch: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key: both hashes and INSERT / UPDATE / DELETE / UNCHANGED."""
    cols = [*keys, "record_hash"]
    return _paired(batch.select(*cols), current.select(*cols), keys).select(
        *[F.coalesce(F.col("new")[k], F.col("old")[k]).alias(k) for k in keys],
        F.col("new.record_hash").alias("new_hash"),
        F.col("old.record_hash").alias("existing_hash"),
        "action",
    )


def action_counts(classified: DataFrame, table: str) -> DataFrame:
    """One statistics row per table."""
    n = {a: F.count_if(F.col("action") == a) for a in ("INSERT", "UPDATE", "UNCHANGED", "DELETE")}
    return classified.agg(
        F.count_if(F.col("action") != "DELETE").alias("source_count"),
        n["INSERT"].alias("new_records"),
        n["UPDATE"].alias("updated_records"),
        n["UNCHANGED"].alias("unchanged_records"),
        n["DELETE"].alias("deleted_records"),
    ).select(F.lit(table).alias("table_name"), "*")


def apply_batch(batch: DataFrame, current: DataFrame, keys: Sequence[str], ts, *, deletes: str = "keep") -> DataFrame:
    """All versions touched or kept by one batch: the new current set plus the versions
    this batch closes.  Untouched closed versions are not read.

    ``batch`` comes from :func:`prepare`; ``deletes`` is ``"keep"`` (a key missing from
    the batch stays current) or ``"close"``.  Column ``action`` tells what happened.
    """
    if deletes not in ("keep", "close"):
        raise ValueError("deletes must be 'keep' or 'close'")
    closed = F.col("old").withField("valid_to", _ts(ts)).withField("is_current", F.lit(False)).withField("transformed_at", _ts(ts))
    gone = F.array(closed if deletes == "close" else F.col("old"))
    rows = (F.when(F.col("action") == "INSERT", F.array("new"))
            .when(F.col("action") == "UPDATE", F.array(closed, F.col("new")))
            .when(F.col("action") == "DELETE", gone)
            .otherwise(F.array("old")))
    return _paired(batch, current, keys).select("action", F.explode(rows).alias("v")).select("v.*", "action")


def apply_scd2(history: DataFrame | None, batch: DataFrame, keys: Sequence[str], ts, *, deletes: str = "keep") -> DataFrame:
    """Complete history after one batch.  ``history=None`` is the initial load."""
    if history is None:
        return batch
    touched = apply_batch(batch, history.filter("is_current"), keys, ts, deletes=deletes).drop("action")
    return touched.unionByName(history.filter(~F.col("is_current")).select(*touched.columns))


def close_versions(current: DataFrame, changed: DataFrame, keys: Sequence[str], ts) -> DataFrame:
    """The versions a set of changed keys ends."""
    hit = current.join(changed.select(*keys), list(keys), "left_semi").select(*current.columns)
    return hit.withColumns({"valid_to": _ts(ts), "is_current": F.lit(False), "transformed_at": _ts(ts)})


def append_versions(batch: DataFrame, classified: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The versions a batch adds: inserted and updated keys only."""
    hit = classified.filter(F.col("action").isin("INSERT", "UPDATE"))
    return batch.join(hit.select(*keys), list(keys), "left_semi").select(*batch.columns)


def upsert_type1(target: DataFrame, batch: DataFrame, keys: Sequence[str], update_cols: Sequence[str]) -> DataFrame:
    """Merge without history: matched rows take ``update_cols`` from the batch, new keys
    are inserted whole, the rest stays.  A key that the batch holds more than once is an
    error, as in a merge."""
    twice = F.raise_error(F.concat(F.lit("several batch rows for key "), F.to_json(F.struct(*keys))))
    per_key = batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"), F.first(F.struct(*target.columns)).alias("new"))
    new = per_key.select(*[F.col(k).alias(f"__n{i}") for i, k in enumerate(keys)],
                         F.when(F.col("__rows") > 1, twice).otherwise(F.col("new")).alias("new"))
    old = target.select(*[F.col(k).alias(f"__o{i}") for i, k in enumerate(keys)], F.struct("*").alias("old"))
    on = reduce(lambda a, b: a & b, [F.col(f"__n{i}") == F.col(f"__o{i}") for i in range(len(keys))])

    def pick(c: str):
        take_new = F.col("new").isNotNull() if c in update_cols else F.col("old").isNull()
        return F.when(take_new, F.col("new")[c]).otherwise(F.col("old")[c]).alias(c)

    return new.join(old, on, "full_outer").select(*[pick(c) for c in target.columns])


def integrity(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Two counts: keys with several current versions, closed versions with bad dates."""
    multi = (history.filter("is_current").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
             .agg(F.count_if(F.col("n") > 1).alias("multi_current_keys")))
    bad = history.agg(F.count_if(
        ~F.col("is_current") & (F.col("valid_to").isNull() | (F.col("valid_from") > F.col("valid_to")))
    ).alias("bad_closed_rows"))
    return multi.select(F.lit("single_current").alias("rule"), F.col("multi_current_keys").alias("failed")).unionByName(
        bad.select(F.lit("valid_dates").alias("rule"), F.col("bad_closed_rows").alias("failed")))


@dataclass(frozen=True)
class TableConfig:
    """How one bronze table becomes a history table."""

    target: str
    transform: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    hash_cols: tuple[str, ...]
    latest_by: tuple[str, ...] = ()
    deletes: str = "keep"


def run_config(config: TableConfig, source: DataFrame, history: DataFrame | None, ts) -> DataFrame:
    batch = prepare(config.transform(source), config.keys, config.hash_cols, ts, config.latest_by)
    return apply_scd2(history, batch, config.keys, ts, deletes=config.deletes)
