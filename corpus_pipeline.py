"""The training-text pipeline: documents in, cleaned, de-duplicated and encoded documents out.

Every stage but the last returns the columns it got.  ``docs`` may hold more columns than documents has, under any name;
inside a stage all columns get plain names, so none can clash with what an operator adds.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import bpe, decontam, jaccard, langid, lines
from touchline.llm.common import plain, table, written
from touchline.session import configure

VOCABULARY = "word_bpe_49k.json"
LEAST_SCORE = 0.45
NEAR_WIDTH, NEAR_PERCENT = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter (``und``), and those that the network takes for none of the languages it learned.

    These have at least one full window and a best mean probability below ``LEAST_SCORE``; shorter texts say too little.
    All documents pass if there is nothing to learn from.
    """
    configure(spark)
    renamed, names, at = plain(docs)
    columns = {"id_col": at["doc_id"], "text_col": at["text"], "lang_col": at["lang"]}
    learned = ~langid.held_out(at["doc_id"])
    model = langid.fit(spark, renamed, learned, **columns)
    if model[1] is None:
        return docs
    found = langid.identify(spark, renamed, renamed, learned, keep=names, model=model, **columns)
    sure = (F.col("score") >= LEAST_SCORE) | (F.octet_length(at["text"]) < langid.WINDOW)
    return found.filter((F.col("lang_pred") != "und") & sure).select(*names).toDF(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete later repeats of runs of lines, with the new n_chars; documents that this leaves without a word go."""
    configure(spark)
    renamed, names, at = plain(docs)
    kept = lines.dedup_lines(spark, renamed, at["doc_id"], at["text"])
    size = F.when(F.col("n_deleted") > 0, F.length(at["text"])).otherwise(F.col(at["n_chars"])).cast(docs.schema["n_chars"].dataType)
    emptied = (F.col("n_deleted") > 0) & ~F.coalesce(F.col(at["text"]), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    return kept.withColumn(at["n_chars"], size).filter(~emptied).select(*names).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of linked ones, that of the least id; sets of five words link from 0.8 on."""
    configure(spark)
    return jaccard.unique(spark, docs, width=NEAR_WIDTH, percent=NEAR_PERCENT)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that overlap a benchmark item."""
    return decontam.clean(spark, docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add each document's token ids, their number, and the text they decode to."""
    configure(spark)
    renamed, names, at = plain(docs)
    coded = bpe.encode(spark, renamed, public_tokenizers.path(VOCABULARY), keep=names, text_col=at["text"], with_text=True)
    wanted = ["doc_id", "text", "lang", "source", "n_chars"]
    return coded.select(*(F.col(at[n]).alias(n) for n in wanted), "n_tokens", "ids", "decoded")


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("encoding", encoding)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's output is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, spark)
    return docs
