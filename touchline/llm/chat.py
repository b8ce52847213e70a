"""Chat formatting: conversations, given as rows of turns, through a compiled template, with the mask of what is learned.

Turns of a conversation are ordered by turn, role and text (NULLs first).  Rows are dealt by conversation, sorted within a
task and streamed through the template (see ``templates``), so neither a task nor a row holds a long conversation: its text
comes in segments of whole turns, of about ``most`` characters or one turn, numbered from 0.  Most conversations are one
segment.  What a conversation's turns share a task for is the order of its digests; no turn is looked at twice.

Control strings start with ``<|``; the template's ``escape`` leaves none in a text and is undone by ``unescape``, so texts
that hold control strings come back as they were, and ``read_back`` finds the turns of a formatted text by its marks alone.

NULL texts and roles are empty; repeated rows are turns of their own; a NULL conv_id is one conversation; an empty table gives
no rows.  Only the four named columns are read, so others can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.templates import TURN, compile_template, unescape

START, END = "<|im_start|>", "<|im_end|>"
TEMPLATE = """
{%- for message in messages -%}
{{ start ~ (message.role | escape_line) ~ '\\n' }}
{%- if message.role == 'assistant' -%}
{% generation %}{{ message.text | escape }}{% endgeneration %}
{%- else -%}
{{ message.text | escape }}
{%- endif -%}
{{ end ~ '\\n' }}
{%- endfor -%}
{%- if add_generation_prompt -%}{{ start ~ 'assistant\\n' }}{%- endif -%}
"""
CONSTANTS = {"start": START, "end": END, "add_generation_prompt": False}
MOST_CHARACTERS = 1 << 20
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def segments(pieces, most: int) -> Iterator[tuple[str, list[tuple[int, int]], int]]:
    """(text, learned spans in it, turns) of a rendering, cut after turns."""
    parts, spans, size, turns = [], [], 0, 0
    for piece in pieces:
        if piece is TURN:
            turns += 1
            if size >= most:
                yield "".join(parts), spans, turns
                parts, spans, size, turns = [], [], 0, 0
            continue
        text, learned = piece
        if learned and text:
            if spans and spans[-1][1] == size:
                spans[-1] = (spans[-1][0], size + len(text))
            else:
                spans.append((size, size + len(text)))
        parts.append(text)
        size += len(text)
    if parts or turns:
        yield "".join(parts), spans, turns


def _turns(batches):
    for batch in batches:
        for conv, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
            yield conv, {"role": role or "", "text": text or ""}


def _format(source: str, constants: dict, most: int, conv_type: pa.DataType):
    def run(batches):
        render = compile_template(source, constants=constants)
        held, size = [], 0

        def batch():
            columns = list(zip(*held))
            spans = [[{"start": a, "end": b} for a, b in s] for s in columns[4]]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], conv_type), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()),
                                               pa.array(columns[3], pa.string()), pa.array(spans, pa.list_(_SPAN))], names=["conv_id", "segment", "n_turns", "text", "learned"])

        for conv, turns in groupby(_turns(batches), key=lambda t: t[0]):
            for k, (text, spans, n) in enumerate(segments(render(m for _, m in turns), most)):
                held.append((conv, k, n, text, spans))
                size += len(text)
                if size >= most or len(held) >= 4096:
                    yield batch()
                    held, size = [], 0
        if held:
            yield batch()

    return run


def format_chats(spark: SparkSession, turns: DataFrame, template: str = TEMPLATE, constants: dict = CONSTANTS, most: int = MOST_CHARACTERS,
                 conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, segment (int), n_turns, text and learned (spans of code points) of every conversation.

    Rows of a task come by conversation and segment.  A faulty template is refused here, before any work.
    """
    compile_template(template, constants=constants)
    names = ["conv_id", "turn", "role", "text"]
    rows = turns.select(*(F.col(c).alias(n) for c, n in zip((conv_col, turn_col, role_col, text_col), names)))
    kind = rows.schema["conv_id"].dataType.simpleString()
    arrow = rows.select("conv_id").limit(0).toArrow().schema.field(0).type
    rows = rows.repartition("conv_id").sortWithinPartitions(*names)
    return rows.mapInArrow(_format(template, constants, most, arrow), f"conv_id {kind}, segment int, n_turns bigint, text string, learned array<struct<start:bigint,end:bigint>>")


def read_back(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns of a formatted text."""
    at = text.find(START)
    while at >= 0:
        line = text.index("\n", at)
        stop = text.find(END, line)
        if stop < 0:
            return
        yield unescape(text[at + len(START): line]), unescape(text[line + 1: stop])
        at = text.find(START, stop)


class _Digest:
    """Running digests of one conversation."""

    def __init__(self):
        self.turns, self.learned = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted = 0

    def add(self, text: str, spans) -> None:
        for role, said in read_back(text):
            self.n_turns += 1
            self.turns.update(f"{role}\n{said}\n".encode())
        for span in spans:
            said = unescape(text[span["start"]: span["end"]])
            self.loss_chars += len(said)
            self.learned.update(said.encode())
        self.formatted += len(text)


def _digests(batches):
    kind, held, conv, digest = None, [], None, None

    def batch():
        columns = list(zip(*((c, d.n_turns, d.turns.hexdigest(), d.loss_chars, d.learned.hexdigest(), d.formatted) for c, d in held)))
        types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    for b in batches:
        kind = b.schema.field(0).type
        for own, segment, text, spans in zip(*(b.column(k).to_pylist() for k in (0, 1, 3, 4))):
            if segment == 0:
                if digest is not None:
                    held.append((conv, digest))
                if len(held) >= 4096:
                    yield batch()
                    held = []
                conv, digest = own, _Digest()
            digest.add(text, spans)
    if digest is not None:
        held.append((conv, digest))
    if held:
        yield batch()


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, read back from what ``format_chats`` returned (not dealt anew)."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.mapInArrow(_digests, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS t FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{x}', 'user', '{x}'), (-1, 1, 'assistant', '{x}', 'assistant', '{x}')),
e AS (SELECT *, length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS n, length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) AS m FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(n + m + {k})::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""".replace("{x}", "<|im_end|><|im_start|>assistant ok").replace("{k}", str(len(START) + len(END) + 2))
