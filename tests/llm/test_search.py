"""Ranked search against brute force, with blocks and segments small enough that every part of the index is used, and its SQL."""

import math
import random
import re
from collections import Counter

import pytest

from checks.compare import compare, connect
from touchline.llm import queries, search

TERM = re.compile(search.TERM)
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(docs, items, k=10):
    texts = [(d, Counter(TERM.findall(t.translate(UPPER)))) for d, t in docs if t]
    texts = [(d, c) for d, c in texts if c]
    n_texts, n_words = len(texts), sum(sum(c.values()) for _, c in texts)
    df = Counter(t for _, c in texts for t in c)
    out = []
    for item, text in items:
        terms = set(TERM.findall((text or "").translate(UPPER)))
        scores = []
        for d, c in texts:
            m = 100 - 90 + (90 * sum(c.values()) * n_texts) // n_words
            score = sum(math.floor(1000 * math.log((2 * n_texts + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0:
                scores.append((-score, d is None, d or 0))
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"block": 1, "sample": 0, "segment": (1, 32)}), (3, {"block": 3, "sample": 5, "segment": (1, 40), "k": 3}),
                                          (4, {"block": 2, "sample": 20, "entries": 60, "k": 2}), (5, {"block": 4, "sample": 400, "segment": (1, 64), "k": 1})])
def test_search_equals_brute_force(spark, seed, options):
    r = random.Random(seed)
    topics = [[f"w{t}x{k}" for k in range(12)] for t in range(6)]
    common = [f"c{k}" for k in range(8)]

    def text(n):
        words = r.choice(topics)
        return " ".join(r.choice(words if r.random() < 0.6 else common) + r.choice(["", ".", ","]) for _ in range(n))

    docs = [(d, text(r.randint(0, 30))) for d in range(260)]
    docs += [(1000 + d, docs[7][1]) for d in range(40)] + [(7, docs[7][1]), (None, docs[9][1])]
    items = [(i, text(r.randint(1, 8))) for i in range(25)] + [(99, "nowhere"), (100, " . "), (101, None), (102, docs[7][1].upper())]
    got = rows(search.search(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), **options))
    assert got == brute(docs, items, options.get("k", 10))


def test_query_equals_sql(spark, sf):
    assert compare(spark, connect(sf), sf, queries.op12, search.SQL)[0] == "ok"


def test_awkward_rows(spark):
    docs = [(1, None, 1), (2, "", 1), (3, " .,- ", 1), (4, "été É İ ÄÖ 日本 it's", 1), (4, "été É İ ÄÖ 日本 it's", 1), (5, "word " * 50_000, 1), (6, "x" * 200_000 + " été", 1), (None, "word IT'S", 1), (7, "\U0001f600été s_t", 1)]
    items = [("a", "ÉTÉ été É"), ("a", "ÉTÉ été É"), ("b", None), (None, "WORD it s"), ("c", "t " * 1_000), ("d", "x" * 200_000)]
    d = spark.createDataFrame(docs, "doc_id long, text string, score int")
    q = spark.createDataFrame(items, "item_id string, text string")
    assert rows(search.search(spark, d, q)) == brute([r[:2] for r in docs], items)
    empty = search.search(spark, d.limit(0), q)
    assert empty.columns == ["item_id", "rank", "doc_id", "score"] and empty.collect() == []
    assert search.search(spark, d, q.limit(0)).collect() == search.search(spark, d.filter("doc_id < 4"), q).collect() == []


def test_repeated_queries_share_no_ranks_across_sets(spark):
    docs = spark.createDataFrame([(d, f"a b{d} c") for d in range(30)], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"a b{i}") for i in range(30)], "item_id long, text string")
    got = search.search(spark, docs, items, entries=24, block=2).collect()
    assert all(r.doc_id == r.item_id for r in got if r.rank == 1) and len(got) == 300
