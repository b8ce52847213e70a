"""Winnowing of lines: what is selected, what is matched through it, and how time grows."""

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from touchline.llm import lines
from touchline.llm.common import text_arrays

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def selected(texts, least):
    """Per text: {selected line: windows that selected it}, the line hashes by line, from the operator."""
    data, offsets = text_arrays(pa.array(texts))
    (row, hashes, bounds), (run, first, last) = lines.winnow(data, offsets, 0, len(texts), least)
    out = [[] for _ in texts]
    for k, r in enumerate(row):
        out[r].append((int(hashes[k]), [(int(run[x]), int(first[x]), int(last[x])) for x in range(bounds[k], bounds[k + 1])]))
    return out


def windows(text, least):
    """Runs of worded lines with ``least`` words and fewer without their first or last line."""
    size = [(k, len(WORD.findall(x))) for k, x in enumerate(text.split("\n")) if WORD.search(x)]
    out = set()
    for s in range(len(size)):
        for e in range(s, len(size)):
            n = sum(w for _, w in size[s: e + 1])
            if n >= least and (n - size[s][1] < least or n - size[e][1] < least):
                out.add((size[s][0], size[e][0]))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_every_window_selects_one_line_and_all_are_there(seed):
    r = random.Random(seed)
    texts = ["\n".join(" ".join(r.choices("abcd", k=r.randint(0, 5))) for _ in range(r.randint(0, 30))) for _ in range(30)]
    for text, found in zip(texts, selected(texts, 8)):
        extents = [(f, z) for _, of in found for _, f, z in of]
        assert len(extents) == len(set(extents)) and set(extents) == windows(text, 8)


def test_a_shared_run_selects_the_same_lines_in_both_texts():
    r = random.Random(5)
    line = lambda: " ".join(f"w{r.randint(0, 10**6)}" for _ in range(r.randint(1, 9)))
    for _ in range(50):
        shared = [line() for _ in range(20)]
        texts = ["\n".join([line() for _ in range(r.randint(0, 15))] + shared + [line() for _ in range(r.randint(0, 15))]) for _ in range(2)]
        a, b = ({h for h, _ in found} for found in selected(texts, 20))
        assert a & b


def test_fewer_lines_are_selected_than_windows_made():
    r = random.Random(6)
    text = "\n".join(" ".join(f"w{r.randint(0, 10**6)}" for _ in range(5)) for _ in range(5_000))
    found = selected([text], 50)[0]
    assert len(found) < 1_500 and sum(len(of) for _, of in found) >= 4_980


def test_a_match_is_extended_beyond_its_line_and_over_several_earlier_texts(spark):
    """One text repeats runs of two earlier ones that overlap in it; a line that all share stands in the middle."""
    line = [f"line {k} with some words of its own, six and {k}" for k in range(40)]
    texts = ["\n".join(["own start one"] + line[:24]), "\n".join(line[16:] + ["own end two"]), "\n".join(["kept before"] + line + ["kept after"]), "\n".join(["x y"] + line[20:22] + ["z"])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in lines.dedup_lines(spark, df).collect()}
    assert out[0].text == texts[0] and out[3].text == texts[3]
    assert out[1].text == "\n".join(line[24:] + ["own end two"]) and out[1].n_deleted == 8
    assert out[2].text == "kept before\nkept after" and (out[2].n_lines, out[2].n_deleted) == (42, 40)


def test_a_line_of_most_texts_brings_no_pairs(spark):
    """4,000 texts share one line but no 50 words: nothing goes, and no step makes more rows than there are windows."""
    r = random.Random(7)
    texts = ["\n".join([f"{i} " + " ".join(f"w{r.randint(0, 10**6)}" for _ in range(30)), "the line that all texts have", " ".join(f"v{r.randint(0, 10**6)}" for _ in range(30))]) for i in range(4_000)]
    df = spark.createDataFrame(list(enumerate(texts)), "tl_id long, tl_text string").withColumn("tl_key", F.xxhash64("tl_text"))
    assert lines.repeated_runs(spark, df).count() == 0


def test_time_is_linear_in_repeated_lines(spark):
    text = "\n".join(["one line that repeats itself again and again here"] * 200_000)
    df = spark.createDataFrame([(1, text), (2, text + "\nand an end")], "doc_id long, text string")
    start = time.time()
    out = {r.doc_id: r for r in lines.dedup_lines(spark, df).collect()}
    assert time.time() - start < 30
    # Every run but the first has an earlier place, so the first line stays.
    assert out[1].n_deleted == 199_999 and out[2].n_deleted == 200_000 and out[2].text == "and an end"


def test_cut_takes_whole_ranges():
    assert lines.cut("a\nb\n\nc\nd", np.array([1, 2]), np.array([2, 3])) == ("a\nd", 3)
    assert lines.cut("a", np.array([0]), np.array([0])) == ("", 1)
