"""Label ladders, code maps, results, points and flags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline import constants as K


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ladder(steps: Sequence[tuple[Column, object]], rest: object = None) -> Column:
    """First true step wins; ``rest`` otherwise."""
    (p0, v0), *more = steps
    out = reduce(lambda acc, s: acc.when(s[0], s[1]), more, F.when(p0, v0))
    return out.otherwise(F.lit(rest))


def at_least(x: str | Column, steps: Sequence[tuple[object, str]], rest: str | None) -> Column:
    return ladder([(_c(x) >= n, label) for n, label in steps], rest)


def at_most(x: str | Column, steps: Sequence[tuple[object, str]], rest: str | None) -> Column:
    return ladder([(_c(x) <= n, label) for n, label in steps], rest)


def code_map(x: str | Column, mapping: Mapping[str, str]) -> Column:
    """Literal lookup; unknown names give NULL."""
    return ladder([(_c(x) == name, code) for name, code in mapping.items()])


def contains_any(x: str | Column, tokens: Sequence[str]) -> Column:
    up = F.upper(_c(x))
    return reduce(lambda a, b: a | b, [up.contains(t) for t in tokens])


def position_category(x: str | Column) -> Column:
    return ladder([(contains_any(x, toks), name) for name, toks in K.POSITION_TOKENS], K.UNKNOWN)


def result_from_score(home: str | Column, away: str | Column) -> Column:
    h, a = _c(home), _c(away)
    return ladder([(h > a, "HOME"), (h < a, "AWAY"), (h == a, "DRAW")])


def points(result: str | Column, side: str) -> Column:
    """League points of one side (``HOME`` / ``AWAY``); anything undecided is 0."""
    return ladder([(_c(result) == side, 3), (_c(result) == "DRAW", 1)], 0)


def letter(result: str | Column, side: str, names: tuple[str, str, str] = ("W", "D", "L")) -> Column:
    """Result from one side's view; a missing result counts as the loss label, as points do."""
    win, draw, loss = names
    return ladder([(_c(result) == side, win), (_c(result) == "DRAW", draw)], loss)


def flag(predicate: Column) -> Column:
    """Boolean that is never NULL."""
    return F.coalesce(predicate, F.lit(False))


def movement(change: str | Column) -> Column:
    # fixed values: movement texts
    c = _c(change)
    return ladder(
        [(c > 0, F.concat(F.lit("📈 Up "), c.cast("string"))),
         (c < 0, F.concat(F.lit("📉 Down "), F.abs(c).cast("string")))],
        "➡️ Same",
    )
