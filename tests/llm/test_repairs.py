"""Cases that once went wrong: template texts, wrapped articles, letters newer than Python's tables, repeated ids, hot languages."""

import os
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from touchline.llm import blocks, bpe, jaccard, langid, pretokens, tokencount, toxicity
from touchline.llm.common import most_frequent
from touchline.session import shared_dir

P = "<p>" + "A sentence with enough words to be read as running text. " * 3 + "</p>"
TEXT = " ".join(("A sentence with enough words to be read as running text. " * 3).split())


def test_toxic_template_texts_are_told_apart(spark):
    """All toxic texts come from one long template, so thousands of cells tell the classes apart equally well."""
    r = np.random.default_rng(1)
    words = ["".join(r.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(3_000)]
    template, lines = " ".join(words[:1_500]), [" ".join(words[k: k + 30]) for k in range(1_500, 3_000, 30)]
    docs = [(i, f"{template} {i}" if i % 2 else " . ".join(r.choice(lines, 10)), i % 2) for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string, toxic int")
    out = toxicity.score(spark, df.select("doc_id", "text"), df.select("doc_id", "toxic"), F.col("doc_id") < 150)
    assert {r.doc_id: r.predicted for r in out.collect()} == {i: t for i, _, t in docs}


def test_the_level_that_does_not_fit_is_taken_in_key_order(spark):
    df = spark.range(100).select("id", F.when(F.col("id") < 10, 50).otherwise(7).alias("n"))
    assert sorted(r.id for r in most_frequent(df, "n", 25, "id").collect()) == list(range(25))
    assert sorted(r.id for r in most_frequent(df, "n", 25).collect()) == list(range(10)) and most_frequent(df, "n", 5).count() == 0
    assert sorted(r.id for r in most_frequent(df, "n", 5, "id").collect()) == list(range(5)) and most_frequent(df, "n", 1000, "id").count() == 100


def test_an_id_that_repeats_without_end_counts_four_times(spark):
    many = spark.range(3_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("other text "), "id").alias("text"), F.lit("en").alias("lang"))
    few = spark.createDataFrame([(i, f"das ist text nummer {i}", "de") for i in range(20)], "doc_id long, text string, lang string")
    model = langid.fit(spark, many.unionByName(few), F.lit(True), "doc_id", "text", "lang")
    assert model[0] == ["de", "en"]
    labels = spark.createDataFrame([(7, 1), (3, 0), (4, 0)], "doc_id long, toxic int")
    assert toxicity.fit(spark, many.unionByName(few), labels, F.lit(True), "doc_id", "text", "toxic") is not None
    plan = langid.identify(spark, many, many, F.lit(True))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("html,want", [
    (f"<form><div><article>{P}{P}</article></div></form>", [TEXT] * 2),
    (f"<div class='page with-sidebar'><article>{P}<p class='tags-intro'>These few words belong to the article.</p>{P}</article><div class='sidebar'>{P}</div></div>",
     [TEXT, "These few words belong to the article.", TEXT]),
    (f"<div id='has-comments'><main>{P}</main></div>", [TEXT]),
    (f"<article>{P}</article><section class='comments'><article>{P}</article></section>", [TEXT]),
    (f"<article>{P}<div class='comments'><article>{P}</article></div></article>", [TEXT]),
    (f"<article>{P}{P}<ul><li><a href='1'>Read more here</a></li><li><a href='2'>Other news of the day</a></li><li><a href='3'>A third one</a></li></ul>{P}</article>", [TEXT] * 3),
    (f"<article>{P}<p><a href='1'>One linked paragraph alone</a></p>{P}</article>", [TEXT, "One linked paragraph alone", TEXT]),
    (f"<article><h1>Title</h1>{P}<p>Short.</p></article><aside><article>{P}</article></aside>", ["Title", TEXT, "Short."]),
])
def test_wrapped_articles_and_link_lists(html, want):
    assert blocks.main_text(f"<html><body>{html}</body></html>", blocks.train()) == "\n".join(want)


@pytest.mark.parametrize("html", ["<a " * 350_000, "<b" * 500_000, "<div>" * 20_000 + "</p>" * 200_000, '<a "' * 250_000, "<script " * 120_000, "<a '\"" * 200_000, "<!-- " * 200_000, "<" * 1_000_000])
def test_a_megabyte_of_open_tags_is_read_in_linear_time(html):
    start = time.time()
    blocks.main_text(html, blocks.train())
    assert time.time() - start < 6


def test_every_code_point_is_cut_and_encoded_as_the_library_does():
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and not 0xE000 <= c < 0xF900 and c < 0xF0000]
    texts = [" ".join(f"a{chr(c)}b{chr(c)}'s 1{chr(c)}" for c in points[k: k + 48]) for k in range(0, len(points), 48)]
    with open(vocabulary, encoding="utf-8") as f:
        codec = bpe.Codec(f.read())
    library = Tokenizer.from_file(vocabulary)
    library.no_padding(), library.no_truncation()
    ids, upto = codec.encode(texts)
    assert [e.ids for e in library.encode_batch(texts, add_special_tokens=False)] == [ids[a:b].tolist() for a, b in zip(upto[:-1], upto[1:])]
    spaced = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    seg = pretokens.Segments(texts, True)
    cut = [0] * len(texts)
    for p in seg.piece.tolist():
        cut[p] += 1
    assert cut == [len(spaced.pre_tokenizer.pre_tokenize_str(t)) for t in texts]


def test_token_counts_of_newer_letters_equal_the_library(spark):
    texts = [f"x{chr(c)}y {chr(c)}{chr(c)} '{chr(c)} {chr(c)}'s" for c in (0x1C89, 0xA7CB, 0x105C0, 0x10D4A, 0x16EA0, 0x1CCD6, 0x2EE5D, 0x378, 0x301)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    want = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}
    assert {r.doc_id: r.n_tokens for r in tokencount.count_tokens(spark, df, path, head=0).collect()} == want
    assert {r.doc_id: r.n_tokens for r in tokencount.count_tokens(spark, df, path).collect()} == want


def test_near_duplicates_leave_no_bit_maps_and_tables_behind(spark):
    """Each bit map is a file of 8 MB on the driver and on every executor, however small the input."""
    def large():
        found = (os.path.join(d, n) for d, _, names in os.walk(spark.sparkContext._temp_dir) for n in names)
        return {f for f in found if os.path.getsize(f) >= 1 << 20}

    docs = []
    for k in range(3):
        words = [f"g{k}w{i}" for i in range(60)]
        docs += [" ".join(words[:-n] + [f"g{k}c{n}x{i}" for i in range(n)]) for n in (1, 2, 3)] + [" ".join(words)] * 2
    before, tables = large(), set(os.listdir(shared_dir(spark)))
    out = jaccard.join(spark, spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in out.collect()} == {i: i // 5 * 5 for i in range(15)}
    assert large() <= before
    # Only the points and the components are still read by the result.
    assert len(set(os.listdir(shared_dir(spark))) - tables) == 2
