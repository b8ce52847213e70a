"""Token counts without token ids.

Texts are cut into pre-tokens.  One job gathers the distinct pre-tokens of the corpus and counts the pieces of each of
them once.  A second job reduces each text to its pre-tokens' frequencies, joins them to the piece counts and sums
pieces times frequency.  The join treats hot keys apart: the ``head`` most frequent pre-tokens (a bounded table of
hashes and counts, about 4 MB) are joined inside the tasks that cut the texts, so only rarer ones are shuffled, as
(row, hash, frequency).  No id list exists at any point.

Pre-tokens are identified by a 64-bit hash.  NULL texts count as empty, with no bytes and no tokens.  Special strings
inside a text count one token each.  Repeated rows each give a row.  Columns besides id and text are not read.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.common import chunks, most_frequent, text_arrays, written
from touchline.llm.pretokens import Segments, library_kinds, split_special

HEAD = 1 << 18
KEEP = 500_000
"""Distinct pre-tokens a task holds before it hands them on."""


def _distinct(special, classes):
    """(hash, string, occurrences) of the pre-tokens a task sees."""
    def run(batches):
        kind_of = np.frombuffer(classes.value, np.uint8)
        index: dict[int, int] = {}
        strings: list[str] = []
        counts = np.zeros(1 << 20, np.int64)

        def flush():
            n = len(strings)
            out = pa.RecordBatch.from_arrays([pa.array(np.fromiter(index, np.uint64, n).view(np.int64)), pa.array(strings, pa.string()), pa.array(counts[:n].copy())],
                                             names=["h", "pretoken", "n"])
            index.clear(), strings.clear()
            counts[:] = 0
            return out

        for batch in batches:
            texts = batch.column(0)
            _, offsets = text_arrays(texts)
            for i, j in chunks(offsets):
                pieces, _, _ = split_special([t or "" for t in texts.slice(i, j - i).to_pylist()], special)
                seg = Segments(pieces, True, kind_of)
                hashes, first, n = np.unique(seg.hashes, return_index=True, return_counts=True)
                for h, f, k in zip(hashes.tolist(), first.tolist(), n.tolist()):
                    at = index.get(h)
                    if at is None:
                        at = index[h] = len(strings)
                        strings.append(seg.string(f))
                        if at >= len(counts):
                            counts = np.concatenate([counts, np.zeros(len(counts), np.int64)])
                    counts[at] += k
                if len(strings) > KEEP:
                    yield flush()
        yield flush()

    return run


_tokenizers: dict = {}


def _pieces(spec):
    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        key = hash(spec.value)
        if key not in _tokenizers:
            _tokenizers[key] = Tokenizer.from_str(spec.value)
        tokenizer = _tokenizers[key]
        for batch in batches:
            counts = []
            strings = batch.column(1).to_pylist()
            for k in range(0, len(strings), 4096):
                counts += [len(e) for e in tokenizer.encode_batch_fast(strings[k: k + 4096], add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int32())], names=["h", "n", "pieces"])

    return run


def _frequencies(special, classes, head):
    """Per text one row with its bytes and the pieces of its head pre-tokens, and one row for each rarer pre-token."""
    def run(batches):
        kind_of = np.frombuffer(classes.value, np.uint8)
        known = np.frombuffer(head.value[0], np.uint64)
        pieces = np.append(np.frombuffer(head.value[1], np.int32), 0)
        for batch in batches:
            texts = batch.column(2)
            _, offsets = text_arrays(texts)
            for i, j in chunks(offsets):
                n = j - i
                cut, rows, after = split_special([t or "" for t in texts.slice(i, n).to_pylist()], special)
                seg = Segments(cut, True, kind_of)
                row = rows[seg.piece]
                order = np.lexsort((seg.hashes, row))
                row, hashes = row[order], seg.hashes[order]
                new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])])) if len(row) else np.zeros(0, np.int64)
                frequency = np.diff(np.append(new, len(row)))
                row, hashes = row[new], hashes[new]
                at = np.searchsorted(known, hashes)
                in_head = at < len(known)
                in_head[in_head] = known[at[in_head]] == hashes[in_head]
                base = np.bincount(row[in_head], weights=(frequency * pieces[np.minimum(at, len(known))])[in_head], minlength=n).astype(np.int64)
                base += np.bincount(rows, weights=np.asarray(after) >= 0, minlength=n).astype(np.int64)
                tail = np.flatnonzero(~in_head)
                part = batch.slice(i, n)
                pick = pa.array(np.concatenate([np.arange(n), row[tail]]))
                none = np.zeros(len(tail), np.int64)
                is_tail = np.arange(n + len(tail)) >= n
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(np.concatenate([np.arange(n), none]), mask=is_tail)),
                     part.column(1).take(pick), pa.array(np.concatenate([np.zeros(n, np.int64), hashes[tail].view(np.int64)])),
                     pa.array(np.concatenate([base, frequency[tail]])), pa.array(np.concatenate([np.diff(offsets[i: j + 1]), none]), mask=is_tail)],
                    names=["tk_id", "rid", "h", "f", "n_bytes"])

    return run


def count_tokens(spark: SparkSession, docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512, head: int = HEAD) -> DataFrame:
    """One row per text: id, n_bytes, n_tokens (long) and over_limit (n_tokens > ``limit``)."""
    with open(vocabulary, encoding="utf-8") as f:
        spec = f.read()
    special = {t["content"]: t["id"] for t in json.loads(spec)["added_tokens"]}
    classes = spark.sparkContext.broadcast(library_kinds().tobytes())
    text = F.col(text_col).alias("tk_text")
    distinct = (docs.select(text).mapInArrow(_distinct(special, classes), "h bigint, pretoken string, n bigint")
                .groupBy("h").agg(F.first("pretoken").alias("pretoken"), F.sum("n").alias("n")))
    counted = written(distinct.mapInArrow(_pieces(spark.sparkContext.broadcast(spec)), "h bigint, n bigint, pieces int"), spark)
    top = most_frequent(counted, "n", head).select("h", "pieces").toArrow()
    hashes, pieces = top["h"].to_numpy().view(np.uint64), top["pieces"].to_numpy()
    order = np.argsort(hashes)
    table = spark.sparkContext.broadcast((hashes[order].tobytes(), pieces[order].astype(np.int32).tobytes()))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("tk_id"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("rid"), text).mapInArrow(
        _frequencies(special, classes, table), f"tk_id {kind}, rid bigint, h bigint, f bigint, n_bytes bigint")
    # Only rarer pre-tokens meet the piece counts; the rows of the texts themselves, which share one key, don't.
    rows = rows.select("rid", "tk_id", "n_bytes", F.when(F.col("n_bytes").isNull(), F.col("h")).alias("h"), "f")
    alone = F.when(F.col("h").isNull(), F.xxhash64("rid")).otherwise(F.col("h")).alias("h")
    is_text = F.col("n_bytes").isNotNull()
    rows = rows.select("rid", "tk_id", "n_bytes", alone, "f", is_text.alias("is_text"))
    total = (rows.join(counted.select("h", "pieces"), "h", "left")
             .groupBy("rid").agg(F.max("tk_id").alias("tk_id"), F.max("n_bytes").alias("n_bytes"), F.count("n_bytes").alias("copies"),
                                 F.sum(F.when(F.col("is_text"), F.col("f")).otherwise(F.col("f") * F.coalesce("pieces", F.lit(1)).cast("long"))).alias("sum"))
             .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))
    tokens = F.expr("sum div copies")
    return total.select(F.col("tk_id").alias(id_col), "n_bytes", tokens.alias("n_tokens"), (tokens > limit).alias("over_limit"))
