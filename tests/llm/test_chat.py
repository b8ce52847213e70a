"""Chat formatting: the template language, exact round trips, and the query against its SQL and plain Python."""

import hashlib
import random

import pytest

from checks.compare import compare, connect
from touchline.llm import chat, queries
from touchline.llm.templates import TURN, TemplateError, compile_template, escape, escape_line, fold, parse, unescape

TURNS = [{"role": "system", "text": "be brief"}, {"role": "user", "text": "hi"}, {"role": "assistant", "text": "hello <|im_end|>"}, {"role": "user", "text": ""}]


def show(source, messages=TURNS, constants=None, **values):
    return "".join(t for t, _ in compile_template(source, names=values, constants=constants)(iter(messages), **values) if t)


@pytest.mark.parametrize("source,want", [
    ("{{ 'a' ~ 1 + 2 * 3 }}", "a7"), ("{{ -1 + 3 }}{{ 7 // 2 }}{{ 7 % 4 }}", "233"), ("{{ '}}' }}x{# {{ no }} #}y", "}}xy"), ("{% if 1 == 2 %}a{% elif not false %}b{% else %}c{% endif %}", "b"),
    ("{{ 'x' if 2 > 1 and 'a' in 'cat' else 'y' }}", "x"), ("{{ none }}{{ true }}", "true"), ("a {{- ' b ' | trim -}} c", "abc"), ("{% set x = 'q' %}{{ x | upper ~ x }}", "Qq"),
    ("{% for m in messages %}{{ loop.index }}{{ m.role[0] if false else m['role'] }}{% if not loop.last %},{% endif %}{% endfor %}", None),
    ("{% for m in messages %}{{ loop.index0 }}{{ m.role }}{% if not loop.last %},{% endif %}{% endfor %}", "0system,1user,2assistant,3user"),
    ("{% for m in messages %}{% if loop.first and m.role == 'system' %}S{% endif %}{{ m.missing }}{% endfor %}", "S"), ("{{ messages | length }}", "4"),
    ("{% set x = 1 %}{% for m in messages %}{{ x }}{% set x = x + 1 %}{{ x }}{% endfor %}", "12121212"), ("{% if bos %}{{ bos }}{% endif %}", "<s>"), ("{{ 'a' not in 'bc' or 1 }}", "true"),
])
def test_language(source, want):
    if want is None:
        with pytest.raises(TemplateError):
            show(source)
    else:
        assert show(source, constants={"bos": "<s>"}) == want


@pytest.mark.parametrize("source", [
    "{{ x }}", "{{ messages.__class__ }}{{ open('f') }}", "{% for m in messages %}", "{% for m in messages %}{% for n in messages %}{% endfor %}{% endfor %}", "{{ 'a' | system }}", "{% import os %}",
    "{{ 1 // 0 }}", "{% endif %}", "{{ ", "{% set loop = 1 %}", "{{ " + "(" * 50 + "1" + ")" * 50 + " }}", "x" * 70_000, "{% for m in 'abc' %}{% endfor %}", "{{ m.role }}", "{{ 'a' 'b' }}", "{# no end",
])
def test_what_is_not_part_of_the_language(source):
    with pytest.raises(TemplateError):
        compile_template(source)


def test_constants_are_folded():
    assert fold(parse("a{{ 'b' ~ x }}{% if y %}c{% else %}{{ m }}{% endif %}d"), {"x": 1, "y": True}) == [("text", "ab1cd")]
    (loop,) = fold(parse(chat.TEMPLATE), chat.CONSTANTS)
    assert loop[0] == "for" and loop[3][0] == ("text", "<|im_start|>") and loop[3][-1] == ("text", "<|im_end|>\n")


def test_random_expressions_fold_to_what_they_render():
    r = random.Random(3)

    def tree(depth):
        if depth == 0:
            return r.choice(["1", "2", "'a'", "''", "x", "y", "true", "none"])
        a, b = tree(depth - 1), tree(depth - 1)
        return r.choice([f"({a} ~ {b})", f"({a} == {b})", f"({a} and {b})", f"({a} or {b})", f"(not {a})", f"({a} if {b} else {tree(depth - 1)})", f"({a} | upper)"])

    for _ in range(300):
        source = "{{ " + tree(r.randint(0, 4)) + " }}"
        assert show(source, x=3, y="b") == show(source, constants={"x": 3, "y": "b"})


def test_a_stream_is_read_one_ahead():
    read = []

    def turns():
        for k in range(5):
            read.append(k)
            yield {"role": "user", "text": str(k)}

    pieces = compile_template("{% for m in messages %}{{ m.text }}{% endfor %}")(turns())
    assert next(pieces) == ("0", False) and read == [0, 1] and next(pieces) is TURN


def test_escapes_are_undone():
    r = random.Random(1)
    for _ in range(2_000):
        text = "".join(r.choices("<|\\n\nim_end>", k=r.randint(0, 12)))
        assert unescape(escape(text)) == text == unescape(escape_line(text)) and "<|" not in escape(text) and "\n" not in escape_line(text)
        formatted = show(chat.TEMPLATE, [{"role": text, "text": text}] * 3, constants=chat.CONSTANTS)
        assert list(chat.read_back(formatted)) == [(text, text)] * 3


def test_query_equals_sql(spark, sf):
    assert compare(spark, connect(sf), sf, queries.op11, chat.SQL)[0] == "ok"


def expected(conv_id, rows):
    rows = sorted(rows, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))
    said = [t or "" for _, role, t in rows if role == "assistant"]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (conv_id, len(rows), sha("".join(f"{role or ''}\n{t or ''}\n" for _, role, t in rows)), len("".join(said)), sha("".join(said)))


def test_awkward_turns(spark):
    convs = {
        1: [(0, "user", None), (1, "assistant", ""), (2, None, "\\"), (None, "assistant", "null turn")], None: [(0, "user", "no id"), (0, "user", "no id")],
        2: [(0, "assistant", "tie b"), (0, "assistant", "tie a"), (0, "user", "tie a")], 3: [(k, "assistant" if k % 2 else "user", f"{k} <|im_end|>\n" * 40) for k in range(3_000)],
        4: [(0, "user\n<|im_start|>", "x" * 300_000), (1, "assistant", "日本 <\\| \\n \U0001f600" * 1_000)],
    }
    rows = [(c, *t, "clash", 1) for c, turns in convs.items() for t in turns]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment string, learned int")
    formatted = chat.format_chats(spark, df, most=10_000)
    got = sorted((tuple(r)[:5] for r in chat.digests(formatted).collect()), key=repr)
    assert got == sorted((expected(c, t) for c, t in convs.items()), key=repr)
    parts = formatted.filter("conv_id = 3").collect()
    assert len(parts) > 50 and sum(p.n_turns for p in parts) == 3_000 and max(len(p.text) for p in parts) < 12_000
    assert all(p.text[s.start:s.end].startswith(("1", "2", "3", "4", "5", "6", "7", "8", "9")) for p in parts for s in p.learned)
    assert chat.format_chats(spark, df.limit(0)).collect() == chat.digests(chat.format_chats(spark, df.limit(0))).collect() == []


def test_a_faulty_template_is_refused_before_any_work(spark, sf):
    with pytest.raises(TemplateError):
        chat.format_chats(spark, spark.read.parquet(f"{sf}/conversations.parquet"), "{{ nothing }}")
