"""Text, key and casting helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline import constants as K


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean(x: str | Column) -> Column:
    return F.trim(_c(x))


def clean_upper(x: str | Column) -> Column:
    return F.upper(F.trim(_c(x)))


def prefix(x: str | Column, n: int = 5) -> Column:
    return F.substring(_c(x), 1, n)


def record_text(*parts: str | Column, sep: str = "-") -> Column:
    """``W-D-L`` style text; NULL when any part is NULL (plain concatenation)."""
    out: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            out.append(F.lit(sep))
        out.append(_c(p).cast("string"))
    return F.concat(*out)


def digits_to_int(x: str | Column) -> Column:
    """Keep only digits (``"53,210"`` -> 53210); NULL when none remain."""
    return F.regexp_replace(_c(x), "[^0-9]", "").try_cast("int")


def score_part(score: str | Column, side: int) -> Column:
    """Home (0) or away (1) goals out of ``"2–1"``; NULL without the en dash."""
    return F.trim(F.get(_scored(score), side))


def _scored(score: str | Column) -> Column:
    s = _c(score)
    return F.when(s.contains(K.SCORE_DASH), F.split(s, K.SCORE_DASH))


def slug(x: str | Column) -> Column:
    """Lower case with spaces and hyphens as underscores."""
    return F.translate(F.lower(_c(x)), " -", "__")


def dashed(x: str | Column) -> Column:
    return F.replace(_c(x), F.lit(" "), F.lit("-"))


def _hash_text(cols: Iterable[str | Column], null_token: str, sep: str) -> Column:
    return F.md5(F.concat_ws(sep, *[F.coalesce(_c(c).cast("string"), F.lit(null_token)) for c in cols]))


def record_hash(*cols: str | Column) -> Column:
    """Change-detection hash.  NULL and '' hash alike, by definition."""
    return _hash_text(cols, "", K.HASH_SEPARATOR)


def surrogate_key(*cols: str | Column) -> Column:
    """Stable text key; NULL parts keep a token of their own."""
    return _hash_text(cols, K.KEY_NULL_TOKEN, K.KEY_SEPARATOR)


def nonblank(x: str | Column, *also_blank: str) -> Column:
    """True when the text is neither NULL, blank, nor one of ``also_blank``."""
    t = F.trim(_c(x))
    return _c(x).isNotNull() & ~t.isin("", *also_blank)


def contains_prefix(a: str | Column, b: str | Column, n: int = 5) -> Column:
    """Case-blind: ``a`` holds the first ``n`` characters of ``b``, as literal text."""
    return F.contains(F.lower(_c(a)), F.lower(prefix(b, n)))


def tolerant_double(x: str | Column) -> Column:
    """Text to double; blanks, junk and NaN become NULL."""
    d = _c(x).try_cast("double")
    return F.when(~F.isnan(d), d)


def tolerant_int(x: str | Column) -> Column:
    """Text to int through double, truncating; anything unusable becomes NULL."""
    return tolerant_double(x).try_cast("bigint").try_cast("int")
