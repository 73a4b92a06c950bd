"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidmill.checks.workspace import new_folder
from bidmill.llm import decontaminate, language_id, line_dedup, minhash, pieces, repair, simhash, spelling, substrings, top_k, toxicity, url_lists, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = new_folder(spark, "archives")
    warc.write_archives(_table(spark, sf_dir, "pages"), archives)
    return warc.read_archives(spark, archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.repeats(_table(spark, sf_dir, "documents")))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.identify(docs).select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.digest(minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=3, percent=85))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.find_passages(docs, _table(spark, sf_dir, "benchmark")).drop("text"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(substrings.repeated(_table(spark, sf_dir, "documents")))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", top_k.whole_numbers(F.col("embedding")).alias("v"))
    return top_k.search(vectors, F.col("vec_id") % 100 == 0)


def op8_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures and list entries are derived from the pages: days from the ids, rules from the URLs."""
    pages = _table(spark, sf_dir, "pages")
    captures = pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 37 % 366).cast("int")).alias("fetched_on"))
    host, target = url_lists.host_of(F.col("url")), url_lists.target_of(F.col("url"))
    entries = pages.where("page_id % 5 = 0").select(
        F.when(F.col("page_id") % 3 == 0, host).when(F.col("page_id") % 3 == 1, F.regexp_replace(host, r"^[^.]+\.", "")).otherwise(target).alias("rule"),
        F.when(F.col("page_id") % 2 == 0, "block").when(F.col("page_id") % 7 < 4, "remove").otherwise("allow").alias("action"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 53 % 366).cast("int")).alias("listed_on"),
    )
    return url_lists.judge(captures, entries)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, _table(spark, sf_dir, "labels"))
    return toxicity.predict(docs, model).drop("text")


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), drop_text=True)


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=3))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(_table(spark, sf_dir, "documents"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.digest(repair.repair(repair.damaged(_table(spark, sf_dir, "conversations"))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        op1_warc, op2_line_dedup, op3_language_id, op4_minhash, op5_decontaminate, op6_substrings, op7_top_k,
        op8_url_lists, op9_toxicity, op10_pieces, op11_simhash, op12_spelling, op13_repair,
    )
    return {query.__name__: query for query in named}
