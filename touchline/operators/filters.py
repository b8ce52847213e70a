"""Row predicates and projections shared by the marts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.text import nonblank


def project(df: DataFrame, spec: Mapping[str, str | Column]) -> DataFrame:
    """``{output name: column or expression text}`` in output order."""
    return df.select(*[(F.expr(e) if isinstance(e, str) else e).alias(n) for n, e in spec.items()])


def current(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_current"))


def finished(df: DataFrame) -> DataFrame:
    return df.filter(F.col("is_finished"))


def nonblank_rows(df: DataFrame, *cols: str, also_blank: Iterable[str] = ()) -> DataFrame:
    for c in cols:
        df = df.filter(nonblank(c, *also_blank))
    return df


def in_list(col: str | Column, values: Iterable) -> Column:
    """Membership; NULL members are ignored, so the negation stays usable."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isin([v for v in values if v is not None])


def not_in_list(col: str | Column, values: Iterable) -> Column:
    return ~in_list(col, values)


def valid_at(ts: str | Column) -> Column:
    """Versions in force at ``ts``: start inclusive, end exclusive."""
    t = F.lit(ts).cast("timestamp") if isinstance(ts, str) else ts
    return (F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (F.col("valid_to") > t))


def as_of(df: DataFrame, ts: str | Column) -> DataFrame:
    return df.filter(valid_at(ts))


def versions(df: DataFrame, predicate: Column) -> DataFrame:
    """All versions of the chosen records, oldest first."""
    return df.filter(predicate).orderBy("valid_from")


def top(df: DataFrame, order: Iterable[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
