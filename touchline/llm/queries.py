"""One query per operator, over its whole table, and the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import blocks, bpe, chat, decontam, divergence, jaccard, langid, licenses, lines, runs, search, tokencount, toxicity
from touchline.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if check is not None:
            SQL[name] = check
        return fn

    return add


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), toxicity.held_out()
    return toxicity.score(spark, docs, table(spark, sf_dir, "labels"), ~held).select("doc_id", held.alias("held_out"), "score", "predicted")


@query("op2_divergence")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.rate(spark, table(spark, sf_dir, "documents"))


@query("op3_decontamination")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_jaccard_join", jaccard.SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(spark, table(spark, sf_dir, "documents"))


@query("op5_html_blocks")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.extract(spark, table(spark, sf_dir, "pages"))


@query("op6_token_counts")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op8_line_dedup", lines.SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), langid.held_out()
    return langid.identify(spark, docs, docs, ~held).select("doc_id", held.alias("held_out"), "lang_pred", "score")


@query("op10_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_text=True)
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return coded.select("doc_id", "n_tokens", F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op7_license_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree below their source: four levels of folders by id; every tenth is a licence file at one of the levels."""
    i = F.col("doc_id")
    levels = [F.col("source"), F.floor(i / 5000), F.floor(i / 500) % 10, F.floor(i / 50) % 10]
    folders = F.array(*(x.cast("string") for x in levels))
    is_file = i % 10 == 0
    path = F.when(is_file, F.concat(F.array_join(F.slice(folders, 1, (F.floor(i / 10) % 4 + 1).cast("int")), "/"), F.lit("/LICENSE"))) \
        .otherwise(F.concat(F.array_join(folders, "/"), F.lit("/"), i.cast("string"), F.lit(".txt")))
    files = table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text")
    found = licenses.own_licenses(spark, files, ["doc_id", "path"])
    return licenses.inherit(found, F.col("path").endswith("/LICENSE"))


def planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; every tenth text by the hash of its id repeats a stretch of its words up to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0)
    n = F.greatest(F.size(words), F.lit(1))
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    copies = F.flatten(F.array_repeat(F.slice(words, (a + 1).cast("int"), p.cast("int")), F.ceil((n - a) / p).cast("int")))
    repeated = F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(copies, F.lit(1), (n - a).cast("int")))
    return docs.select("doc_id", F.when((h % 10 == 0) & (F.size(words) > 0), F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


@query("op13_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts are planted with runs first, as the contract says; digests are taken of the operator's runs and texts."""
    found = runs.find_runs(spark, planted_runs(table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines_of = F.transform("runs", lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    return found.withColumn("top", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.period")).alias("period"), F.floor(1000 * F.col("top.length") / -F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines_of, ""), 256).alias("runs_sha256"), F.sha2(F.coalesce("collapsed", F.lit("")), 256).alias("collapsed_sha256"))


@query("op12_search", search.SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op11_chat", chat.SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold the control strings."""
    said = "<|im_end|><|im_start|>assistant ok"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return chat.digests(chat.format_chats(spark, turns.unionByName(planted)))
