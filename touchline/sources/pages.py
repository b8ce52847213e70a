"""Tables inside stored HTML pages, and schema-time column resolution."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from html import unescape
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.text import nonblank, score_part, slug, tolerant_double, tolerant_int
from touchline.operators.joins import enrich
from touchline.sources import schemas
from touchline.sources.payloads import enforce


def _span(given: str | None, most: int) -> int:
    """A cell's span as browsers read it: 1 if absent or no number; of rows, 0 means to the end of the table."""
    n = int(given) if given and given.strip().isdecimal() else 1
    return min(n, most) if n else (most if most > 1000 else 1)


_WS = r"[ \t\n\r\f]"
_ATTR = rf"""{_WS}+([a-zA-Z][a-zA-Z0-9:_-]*)(?:=(?:"([^"<>]*)"|([a-zA-Z0-9%._#-]+)))?"""
_PLAIN_TAG = re.compile(rf"<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:{_ATTR.replace('(', '(?:').replace('(?:?:', '(?:')})*){_WS}*>")
_PLAIN_ATTR = re.compile(_ATTR)
# What these hold isn't read as markup.
_RAW = frozenset(("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext", "svg", "math"))


class _Cells(HTMLParser):
    """Collects the text of cells, per row, per table, for one page.

    Tables are numbered in the order they open.  A table inside a cell gives rows of its own and leaves the outer row,
    cell and numbering as they were; its text is no part of the outer cell.
    """

    def __init__(self, table_tag: str | None, row_tag: str, cell_tags: frozenset[str]):
        super().__init__(convert_charrefs=True)
        self.table_tag, self.row_tag, self.cell_tags = table_tag, row_tag, cell_tags
        self.tables, self.rows = 0, []
        self.open = [] if table_tag else [self._fresh()]

    def read(self, html: str) -> list[tuple]:
        """The rows of a page.  One that is nothing but plain tags and text is cut at its tags, any other goes through the parser."""
        if not self._read_plain(html):
            self.feed(html)
        self.finish()
        return self.rows

    def _read_plain(self, html: str) -> bool:
        """Whether the page was read: text, "/" of end tags, name and attributes follow each other."""
        parts = _PLAIN_TAG.split(html)
        names = parts[2::4]
        if parts[-1] or html.count("<") != len(names) or any(parts[k + 2] and parts[k] for k in range(1, len(parts), 4)):
            return False
        lower = {name: name.lower() for name in set(names)}
        if not _RAW.isdisjoint(lower.values()):
            return False
        known = {self.table_tag, self.row_tag, *self.cell_tags, "thead", "tbody", "tfoot"}
        for text, end, name, attrs in zip(parts[::4], parts[1::4], names, parts[3::4]):
            if text and self.open and self.open[-1]["text"] is not None:
                self.handle_data(unescape(text) if "&" in text else text)
            tag = lower[name]
            if tag not in known:
                continue
            if end:
                self.handle_endtag(tag)
            else:
                self.handle_starttag(tag, [(n.lower(), unescape(quoted or bare)) for n, quoted, bare in _PLAIN_ATTR.findall(attrs)] if attrs else ())
        return True

    def _fresh(self) -> dict:
        self.tables += 1
        return {"table": self.tables - 1, "row": -1, "cells": None, "text": None, "spans": None, "span": None, "head": False}

    def _end_cell(self, at: dict):
        if at["text"] is not None and at["cells"] is not None:
            at["cells"].append("".join(at["text"]).strip())
            at["spans"].append(at["span"])
        at["text"] = None

    def _end_row(self, at: dict):
        """Rows are (table, row, cells, span of each cell, whether all is heading)."""
        self._end_cell(at)
        if at["cells"] is not None:
            heading = at["head"] or bool(at["spans"]) and all(s[2] for s in at["spans"])
            self.rows.append((at["table"], at["row"], at["cells"], at["spans"], heading))
        at["cells"] = None

    def finish(self):
        while self.open:
            self._end_row(self.open.pop())

    def handle_starttag(self, tag, attrs):
        if tag == self.table_tag:
            self.open.append(self._fresh())
        elif self.open and tag == self.row_tag:
            at = self.open[-1]
            self._end_row(at)
            at["row"], at["cells"], at["spans"] = at["row"] + 1, [], []
        elif self.open and tag in self.cell_tags and self.open[-1]["cells"] is not None:
            at = self.open[-1]
            self._end_cell(at)
            at["text"], at["span"] = [], (1, 1, tag == "th")
            if attrs:
                given = dict(attrs)
                at["span"] = (_span(given.get("rowspan"), 65534), _span(given.get("colspan"), 1000), tag == "th")
        elif self.open and tag in ("thead", "tbody", "tfoot"):
            self._end_row(self.open[-1])
            self.open[-1]["head"] = tag == "thead"

    def handle_endtag(self, tag):
        if not self.open:
            return
        if tag in self.cell_tags:
            self._end_cell(self.open[-1])
        elif tag == self.row_tag:
            self._end_row(self.open[-1])
        elif tag == "thead":
            self._end_row(self.open[-1])
            self.open[-1]["head"] = False
        elif tag == self.table_tag:
            self._end_row(self.open.pop())

    def handle_data(self, data):
        if self.open and self.open[-1]["text"] is not None:
            self.open[-1]["text"].append(data)


def html_rows(
    pages: DataFrame, *, url: str = "url", html: str = "html", table_tag: str | None = "table", row_tag: str = "tr",
    cell_tags: Sequence[str] = ("td", "th"),
) -> DataFrame:
    """``(url, table_no, row_no, cells)`` of every row of every table, page by page on
    the executors.  ``table_tag=None`` treats the whole page as one table."""
    tags = frozenset(cell_tags)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for u, text in zip(batch["u"], batch["h"]):
                out.extend((u, *row[:3]) for row in _Cells(table_tag, row_tag, tags).read(text or ""))
            yield pd.DataFrame(out, columns=["url", "table_no", "row_no", "cells"])

    schema = "url string, table_no int, row_no int, cells array<string>"
    return pages.select(F.col(url).cast("string").alias("u"), F.col(html).alias("h")).mapInPandas(parse, schema)


def fill_grid(rows: Sequence[tuple[Sequence[str], Sequence[tuple[int, int, bool]]]]) -> list[list[str]]:
    """Rows of one table, given as texts and spans, with every spanning cell repeated wherever it reaches."""
    out: list[list[str]] = []
    hanging: dict[int, tuple[int, str]] = {}   # column -> rows still to fill, text

    for cells, spans in rows:
        if not hanging and all(down == across == 1 for down, across, _ in spans):
            out.append([*cells])
            continue
        line: list[str] = []

        def hang() -> bool:
            left, text = hanging.pop(len(line), (0, ""))
            if not left:
                return False
            if left > 1:
                hanging[len(line)] = (left - 1, text)
            line.append(text)
            return True

        for text, (down, across, _) in zip(cells, spans):
            while hang():
                pass
            for _ in range(across):
                if down > 1:
                    hanging[len(line)] = (down - 1, text)
                line.append(text)
        for column in sorted(k for k in hanging if k >= len(line)):
            line.extend([""] * (column - len(line)))
            hang()
        out.append(line)
    return out


def header_names(levels: Sequence[Sequence[str]]) -> list[str]:
    """Column names of a header grid: levels joined with ``_``, empty cells named by place; one level alone is made unique."""
    if len(levels) == 1:
        return unique_header(levels[0])
    width = max(map(len, levels))
    full = [[*level, *[""] * (width - len(level))] for level in levels]
    return flatten_header(*[[text or f"Unnamed: {i}_level_{k}" for i, text in enumerate(level)] for k, level in enumerate(full)])


def _tables(html: str | None) -> Iterator[tuple[int, list[str], list[list[str]]]]:
    """(number, column names, body rows) of every table of a page: header rows are those of ``thead``, else the leading rows
    of nothing but heading cells, else the first row."""
    by_table: dict[int, list] = {}
    for row in sorted(_Cells("table", "tr", frozenset(("td", "th"))).read(html or ""), key=lambda r: r[:2]):
        by_table.setdefault(row[0], []).append(row)
    for number, rows in by_table.items():
        grid = fill_grid([(r[2], r[3]) for r in rows])
        n = next((k for k, r in enumerate(rows) if not r[4]), len(rows)) or 1
        yield number, header_names(grid[:n]), grid[n:]


def page_columns(pages: DataFrame, wanted: Mapping[str, Mapping], *header_words: str, keep: Sequence[str] = ("url",), html: str = "html") -> DataFrame:
    """``keep`` columns, row_no, and one text column per wanted name: the body of each page's first table whose header has every word.

    ``wanted`` maps a name to a pattern of :func:`find_column`.  Every page's own header decides, on the executors, which of
    its columns that is, so pages with other columns, another order or other header levels go through one plan; what a
    page lacks is NULL.
    """
    patterns = {name: dict(pattern) for name, pattern in wanted.items()}
    kept = [*keep]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, numbers, texts = [[] for _ in kept], [], [[] for _ in patterns]
            for *page, text in zip(*[column.to_pylist() for column in batch.columns]):
                for _, columns, body in _tables(text):
                    if all(any(w in c for c in columns) for w in header_words):
                        for own, value in zip(ids, page):
                            own.extend([value] * len(body))
                        numbers.extend(range(len(body)))
                        found = [find_column(columns, **p) for p in patterns.values()]
                        for own, name in zip(texts, found):
                            i = columns.index(name) if name is not None else None
                            own.extend([None] * len(body) if i is None else [row[i] if i < len(row) else None for row in body])
                        break
            arrays = [*[pa.array(v, pa.string()) for v in ids], pa.array(numbers, pa.int32()), *[pa.array(v, pa.string()) for v in texts]]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "row_no", *patterns])

    schema = ", ".join([*(f"`{k}` string" for k in kept), "row_no int", *(f"`{n}` string" for n in patterns)])
    return pages.select(*[F.col(k).cast("string").alias(k) for k in kept], F.col(html).alias("__html")).mapInArrow(parse, schema)


def pick_table(rows: DataFrame, *header_words: str) -> DataFrame:
    """Rows of each page's first table; with ``header_words``, the first table whose
    first row mentions every word."""
    head = rows.filter(F.col("row_no") == 0)
    for word in header_words:
        head = head.filter(F.exists("cells", lambda c: F.contains(c, F.lit(word))))
    chosen = head.groupBy("url").agg(F.min("table_no").alias("table_no"))
    return rows.join(chosen, ["url", "table_no"], "left_semi")


def table_columns(rows: DataFrame, header: Sequence[str], header_rows: int = 1) -> DataFrame:
    """Body rows with one text column per header name."""
    body = rows.filter(F.col("row_no") >= header_rows)
    return body.select("url", "row_no", *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(header)])


def flatten_header(*levels: Sequence[str]) -> list[str]:
    """Join the levels of a multi-row header with ``_``."""
    return ["_".join(str(p) for p in parts).strip() for parts in zip(*levels, strict=True)]


def unique_header(header: Sequence[str]) -> list[str]:
    """Header names with ``.1``, ``.2``, … after repeated ones, as page readers name them."""
    seen: dict[str, int] = {}
    out = []
    for name in header:
        n = seen.get(name, 0)
        out.append(f"{name}.{n}" if n else name)
        seen[name] = n + 1
    return out


def find_column(
    columns: Sequence[str], *, exact: Sequence[str] = (), suffix: Sequence[str] = (), contains: Sequence[str] = (),
    any_of: Sequence[str] = (), without: Sequence[str] = (),
) -> str | None:
    """First column, in table order, that equals, ends with, holds *all* of ``contains``
    or *one* of ``any_of``, and none of ``without``."""
    def fits(c: str) -> bool:
        if any(w in c for w in without):
            return False
        return c in exact or any(c.endswith(s) for s in suffix) or (bool(contains) and all(p in c for p in contains)) or any(p in c for p in any_of)

    return next((c for c in columns if fits(c)), None)


def resolve_column(df: DataFrame, *, type: str = "string", **pattern) -> Column:
    """The matching column, or a typed NULL when the table has none."""
    name = find_column(df.columns, **pattern)
    return F.col(f"`{name}`") if name else F.lit(None).cast(type)


def dynamic_stats(df: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """Ids plus a map of every other non-NULL column as ``stat_<slug>``."""
    stats = [c for c in df.columns if c not in id_cols]
    values = F.map_from_arrays(
        F.array(*[F.concat(F.lit("stat_"), slug(F.lit(c))) for c in stats]),
        F.array(*[F.col(f"`{c}`").cast("string") for c in stats]),
    )
    return df.select(*id_cols, F.map_filter(values, lambda _, v: v.isNotNull()).alias("stats"))


def long_stats(df: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """The same statistics, one row each."""
    return dynamic_stats(df, id_cols).select(*id_cols, F.explode("stats").alias("stat", "value"))


def _ends(short: str) -> dict:
    return {"exact": (short,), "suffix": (f"_{short}",)}


# fixed values: header patterns of the five player tables, (bronze column, kind, pattern)
STANDARD = [
    ("birth_year", "int", {"contains": ("Born",)}),
    ("matches_played", "int", _ends("MP")), ("starts", "int", _ends("Starts")), ("minutes", "int", _ends("Min")),
    ("nineties", "double", {"contains": ("90s",)}),
    ("goals", "int", _ends("Gls")), ("assists", "int", _ends("Ast")),
    ("goals_assists", "int", {"any_of": ("G+A", "G-A")}), ("non_penalty_goals", "int", {"contains": ("G-PK",)}),
    ("penalty_goals", "int", _ends("PK")), ("penalty_attempts", "int", {"contains": ("PKatt",)}),
    ("yellow_cards", "int", _ends("CrdY")), ("red_cards", "int", _ends("CrdR")),
    ("xg", "double", _ends("xG")), ("npxg", "double", {"contains": ("npxG",)}),
    ("xa", "double", {"exact": ("xAG", "xA"), "suffix": ("_xAG",)}), ("xg_xa", "double", {"contains": ("xG+xAG",)}),
    ("goals_per90", "double", {"contains": ("Gls", "90")}), ("assists_per90", "double", {"contains": ("Ast", "90")}),
    ("xg_per90", "double", {"contains": ("xG", "90"), "without": ("xAG",)}), ("xa_per90", "double", {"contains": ("xAG", "90")}),
]
ENRICHMENT = {
    "shooting": [
        ("shots", "int", _ends("Sh")), ("shots_on_target", "int", {"contains": ("SoT",), "without": ("/", "%")}),
        ("shot_accuracy", "double", {"contains": ("SoT%",)}), ("shots_per90", "double", {"contains": ("Sh", "90")}),
    ],
    "passing": [
        ("passes_completed", "int", {"contains": ("Cmp", "Total")}), ("passes_attempted", "int", {"contains": ("Att", "Total")}),
        ("pass_completion_pct", "double", {"contains": ("Cmp%", "Total")}), ("key_passes", "int", {"contains": ("KP",)}),
        ("passes_into_final_third", "int", {"contains": ("1/3",)}), ("passes_into_penalty_area", "int", {"contains": ("PPA",)}),
        ("progressive_passes", "int", {"contains": ("PrgP",)}),
    ],
    "defense": [
        ("tackles", "int", _ends("Tkl")), ("tackles_won", "int", {"contains": ("TklW",)}), ("interceptions", "int", _ends("Int")),
        ("blocks", "int", _ends("Blocks")), ("clearances", "int", _ends("Clr")),
    ],
    "gca": [
        ("sca", "int", _ends("SCA")), ("sca_per90", "double", {"contains": ("SCA90",)}),
        ("gca", "int", _ends("GCA")), ("gca_per90", "double", {"contains": ("GCA90",)}),
    ],
}
IDENTITY = {"player_name": "Player", "nationality": "Nation", "position": "Pos", "team_name": "Squad", "age": "Age"}


_CAST = {"int": tolerant_int, "double": tolerant_double}


def _typed(df: DataFrame, spec: Sequence[tuple[str, str, Mapping]]) -> list[Column]:
    return [_CAST[kind](resolve_column(df, **pattern)).alias(name) for name, kind, pattern in spec]


def _identity(df: DataFrame, names: Sequence[str]) -> list[Column]:
    return [F.coalesce(resolve_column(df, contains=(IDENTITY[n],)).cast("string"), F.lit("")).alias(n) for n in names]


_WHO = ["player_name", "team_name"]


def player_stats(
    standard: DataFrame, others: Mapping[str, DataFrame], *, batch_ts: str, page_keys: Sequence[str] = ("competition_name", "season"), order: str = "row_no"
) -> DataFrame:
    """Bronze player rows: the standard table with figures of up to four other tables
    joined on (page, player, team).  ``page_keys`` tell the pages apart, so all pages of
    all competitions and seasons are one join.  ``order`` is the row's place on its page:
    the last duplicate wins."""
    base = standard.select(*page_keys, *_identity(standard, list(IDENTITY)), *_typed(standard, STANDARD))
    sides = {n: t.select(*page_keys, *_identity(t, _WHO), *_typed(t, ENRICHMENT[n]), F.col(order)) for n, t in others.items()}
    return _player_rows(base, sides, batch_ts, page_keys, order)


def player_stats_of_pages(found: Mapping[str, DataFrame], *, batch_ts: str, page_keys: Sequence[str] = ("competition_name", "season"), parts: Sequence[str] = ()) -> DataFrame:
    """The same rows from stored pages (``page_keys``, ``html``) of the table ``standard`` and any of the other four.

    Columns are found on every page by its own header (:func:`page_columns`).  ``parts`` are further columns that tell
    pages of one competition and season apart, where a table goes over several.
    """
    def read(name: str, ids: Sequence[str], spec: Sequence[tuple[str, str, Mapping]]) -> DataFrame:
        wanted = {n: {"contains": (IDENTITY[n],)} for n in ids} | {n: pattern for n, _, pattern in spec}
        rows = page_columns(found[name], wanted, "Player", keep=[*page_keys, *parts])
        return rows.select(*page_keys, *parts, *[F.coalesce(n, F.lit("")).alias(n) for n in ids], *[_CAST[kind](n).alias(n) for n, kind, _ in spec], "row_no")

    base = read("standard", list(IDENTITY), STANDARD).drop("row_no")
    sides = {n: read(n, _WHO, ENRICHMENT[n]) for n in found if n != "standard"}
    return _player_rows(base, sides, batch_ts, [*page_keys, *parts], "row_no")


def _player_rows(base: DataFrame, sides: Mapping[str, DataFrame], batch_ts: str, page_keys: Sequence[str], order: str) -> DataFrame:
    columns = {n: [c for c, _, _ in ENRICHMENT[n]] for n in sides}
    wide = enrich(base.filter(nonblank("player_name", "nan")), sides, [*page_keys, *_WHO], columns, order)
    for name, spec in ENRICHMENT.items():
        if name not in sides:
            wide = wide.withColumns({c: F.lit(None).cast(kind) for c, kind, _ in spec})
    # fixed values: source and table names stored with each row
    stamped = wide.withColumns({"source": F.lit("fbref"), "stat_type": F.lit("standard"), "ingest_timestamp": F.lit(batch_ts)})
    return enforce(stamped, schemas.PLAYER_STATS)


# fixed values: headers of match and standings tables, (bronze column, kind, header)
MATCHES = [
    ("matchweek", "string", "Wk"), ("match_date", "string", "Date"), ("match_time", "string", "Time"), ("home_team_name", "string", "Home"),
    ("away_team_name", "string", "Away"), ("home_xg", "double", "xG"), ("away_xg", "double", "xG.1"), ("attendance", "string", "Attendance"),
    ("venue", "string", "Venue"), ("referee", "string", "Referee"),
]
STANDINGS = [
    ("position", "int", "Rk"), ("team_name", "string", "Squad"), ("matches_played", "int", "MP"), ("wins", "int", "W"), ("draws", "int", "D"), ("losses", "int", "L"),
    ("goals_for", "int", "GF"), ("goals_against", "int", "GA"), ("goal_difference", "int", "GD"), ("points", "int", "Pts"), ("xg", "double", "xG"), ("xga", "double", "xGA"),
]


def _page_rows(df: DataFrame, spec: Sequence[tuple[str, str, str]]) -> list[Column]:
    """Typed columns; text that is missing is empty, figures that are missing or unusable are NULL."""
    cast = {**_CAST, "string": lambda x: F.coalesce(x.cast("string"), F.lit(""))}
    return [cast[kind](resolve_column(df, **_ends(header))).alias(name) for name, kind, header in spec]


def match_rows(table: DataFrame, *, batch_ts: str, page_keys: Sequence[str] = ("competition_name", "season")) -> DataFrame:
    """Bronze match rows of the second source from its schedule tables (see :func:`table_columns`)."""
    score = resolve_column(table, **_ends("Score"))
    goals = [score_part(score, i).alias(n) for i, n in enumerate(("home_score", "away_score"))]
    out = table.select(*page_keys, *_page_rows(table, MATCHES), *goals)
    return enforce(out.withColumns({"source": F.lit("fbref"), "ingest_timestamp": F.lit(batch_ts)}), schemas.XG_MATCHES)


def standing_rows(table: DataFrame, *, batch_ts: str, page_keys: Sequence[str] = ("competition_name", "season")) -> DataFrame:
    """Bronze standings rows of the second source; headers of one or of two joined levels."""
    out = table.select(*page_keys, *_page_rows(table, STANDINGS))
    return enforce(out.withColumns({"source": F.lit("fbref"), "ingest_timestamp": F.lit(batch_ts)}), schemas.XG_STANDINGS)
