"""Periodic runs against brute force, on the contract's planted texts and on awkward rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from touchline.llm import queries, runs
from touchline.llm.common import Words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=6, exponent=4):
    """For every period all maximal stretches; a stretch keeps its least period."""
    best = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, exponent * q):
                best.setdefault((i, length), q)
            i = max(j, i) + 1
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def words_of(texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in raw])]).astype(np.int64)
    return Words(np.frombuffer(b"".join(raw), np.uint8), offsets, 0, len(texts), lower=False)


def periodic(r):
    letters, parts = "abcdefg"[: r.choice([1, 2, 2, 3, 5])], []
    for _ in range(r.randint(0, 6)):
        unit = [r.choice(letters) for _ in range(r.randint(1, 9))]
        parts += (unit * r.randint(1, 12))[: r.randint(1, 60)]
    return " ".join(parts)


@pytest.mark.parametrize("least,exponent", [(6, 4), (6, 3), (4, 2), (2, 2), (1, 2), (9, 5)])
def test_runs_equal_brute_force(least, exponent):
    r = random.Random(least * 10 + exponent)
    for _ in range(150):
        texts = [periodic(r) for _ in range(r.randint(1, 5))]
        got = runs.runs_of(words_of(texts), least, exponent)
        assert [got.get(k, []) for k in range(len(texts))] == [brute(t.split(), least, exponent) for t in texts]


@pytest.mark.parametrize("text,run", [("w " * 60_000, (0, 60_000, 1)), ("a b " * 60_000, (0, 120_000, 2)), (" ".join(str(i % 9_000) for i in range(60_000)), (0, 60_000, 9_000)),
                                      ("head " + "a b c d e x " * 20_000 + "tail", (1, 120_000, 6))])
def test_long_runs_are_one_run(text, run):
    assert runs.runs_of(words_of([text])) == {0: [run]}


def test_classes_of_places_split_and_join():
    before = [5, 1, 1, 2, 1, 1, 2, 2]
    node = runs.Places(4)
    for p in (1, 2, 5, 3, 0, 7, 6):
        node.add(p, before)
    assert node.lists == [[0], [1, 2], [3], [4, 5], [6, 7]] and node.heads == [0, 1, 3, 4, 6] and node.size == 8
    assert sorted(node.others(4, 3, before)) == [3, 6, 7] and sorted(node.others(0, 2, before)) == [1, 2]


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = brute(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    top = max(found, key=lambda r: (r[1], -r[0], -r[2])) if found else (None, None, None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(found), *top, 1000 * top[1] // top[2] if found else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r) for r in queries.op13(spark, sf).collect()}
    short = [d for d in docs if len(d.text or "") < 4_000]
    assert len(got) == len(docs) and len(short) > 100
    assert [got[d.doc_id] for d in short] == [expected(d.doc_id, d.text) for d in short]


def test_awkward_rows(spark, tmp_path):
    rows = [(1, "a"), (2, None), (3, ""), (4, " \n\t "), (5, "word " * 2_000), (6, "x" * 100_000), (7, "a b a b a b a b c"), (7, "a b a b a b a b c"),
            (None, "z z z z z z z"), (8, "é\x1fé é\x1fé é\x1fé é\x1fé é\x1fé é\x1fé 日本"), (24, "one two three four")]
    rows += [(i, "p q r s t u v w") for i in range(20, 80) if zlib.crc32(str(i).encode()) % 10 == 0]
    df = spark.createDataFrame([(i, t, 0, 0, 0) for i, t in rows], "doc_id long, text string, n_words int, runs int, c0 int")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, queries.op13(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted((expected(i, t) for i, t in rows), key=repr)
    out = runs.find_runs(spark, df, keep=["doc_id", "c0", "runs", "n_words"])
    assert out.columns == ["doc_id", "c0", "n_words", "runs", "collapsed"]
    texts = {r.doc_id: r.collapsed for r in out.collect()}
    assert texts[2] is None and texts[5] == "word" and texts[7] == "a b c" and texts[4] == ""
    assert runs.find_runs(spark, df.limit(0)).collect() == []
