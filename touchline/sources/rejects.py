"""Rows parsed once into values or reasons; rejected ones go to a part of their own, counted while they are written."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from touchline.functions.text import tolerant_double, tolerant_int

MISSING = "missing"
# Why a text that is not missing can't be a value of the kind.
REASONS = {"string": (MISSING,), "int": (MISSING, "not a number", "out of range"), "double": (MISSING, "not a number"), "date": (MISSING, "not a date")}
_TYPES = {"string": "string", "int": "int", "double": "double", "date": "date"}


def parsed(col: str, kind: str) -> Column:
    """Struct of ``value`` and ``reason``; one of them is NULL.  Blank text and ``nan`` are missing."""
    text = F.trim(F.col(col).cast("string"))
    gone = text.isNull() | F.lower(text).isin("", "nan")
    value = {"string": F.col(col).cast("string"), "int": tolerant_int(text), "double": tolerant_double(text), "date": text.try_cast("date")}[kind]
    reason = F.when(gone, MISSING)
    if kind in ("int", "double"):
        reason = reason.when(tolerant_double(text).isNull(), "not a number")
    if kind == "int":
        reason = reason.when(value.isNull(), "out of range")
    if kind == "date":
        reason = reason.when(value.isNull(), "not a date")
    return F.struct(F.when(~gone, value).alias("value"), reason.alias("reason"))


@dataclass(frozen=True)
class Routed:
    """``kept``: typed rows.  ``rejected``: the given row as JSON and all its reasons.  ``counts``: rows per reason, and ``kept``."""

    kept: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def route(df: DataFrame, spec: Mapping[str, str], path: str, required: Sequence[str] | None = None) -> Routed:
    """Parse the columns of ``spec`` (name to kind) and write all rows once, kept and rejected ones apart.

    A row is rejected for every reason that a ``required`` column (all, if not given) has; in other columns text that
    can't be read becomes NULL.  Further columns pass through.  Counts come with the write, there is no second pass.
    """
    required = list(spec) if required is None else list(required)
    others = [n for n in df.columns if n not in spec]
    read = df.select(*others, F.to_json(F.struct("*")).alias("__row"), *[parsed(n, k).alias(n) for n, k in spec.items()])
    why = F.array_compact(F.array(*[F.when(F.col(n)["reason"].isNotNull(), F.concat(F.lit(f"{n}: "), F.col(n)["reason"])) for n in required]).cast("array<string>"))
    read = read.withColumn("__why", why).withColumn("rejected", F.size("__why") > 0)
    seen = Observation()
    names = ["kept"] + [f"{n}: {r}" for n in required for r in REASONS[spec[n]]]
    counts = [F.count_if(~F.col("rejected")).alias("kept")] + [F.count_if(F.array_contains("__why", n)).alias(n) for n in names[1:]]
    rows = read.select(*others, *[F.col(n)["value"].alias(n) for n in spec], F.when(F.col("rejected"), F.col("__row")).alias("__row"), "__why", "rejected").observe(seen, *counts)
    rows.write.partitionBy("rejected").parquet(path)
    stored = df.sparkSession.read.schema(rows.schema).parquet(path)
    found = seen.get
    return Routed(stored.filter(~F.col("rejected")).select(*others, *spec), stored.filter("rejected").select(F.col("__row").alias("row"), F.col("__why").alias("reasons")),
                  {n: found[n] for n in names if n == "kept" or found[n]})
