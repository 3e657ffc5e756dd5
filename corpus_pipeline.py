"""Corpus pipeline: five stages over ``documents``, each written as Parquet and
read back as the next one's input.

Every stage takes (spark, docs, sf_dir).  All but the last return the columns
of ``documents``; a stage that rewrites ``text`` sets n_chars anew.  Null
columns pass through; an empty table passes every stage.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from transitlens.llm import decontam, line_dedup as lines, minhash, packing, toxicity as tox
from transitlens.llm.common import Scratch
from transitlens.llm.queries import table, tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _recounted(docs: DataFrame, before: str = "__before") -> DataFrame:
    return docs.withColumn("n_chars", F.when(F.col("text") == F.col(before), F.col("n_chars"))
                           .otherwise(F.length("text").cast("long"))).select(*COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted label is toxic go.  Scoring rides along with the rows: no join."""
    model = tox.fit(docs, table(spark, sf_dir, "labels"))
    return tox.keep_clean(docs.select(*COLUMNS), model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages of three lines go."""
    return _recounted(lines.line_dedup(docs.select(*COLUMNS, F.col("text").alias("__before"))))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays, that of the smallest doc_id."""
    if docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():
        out = minhash.near_duplicates(docs).filter(~F.col("kept")).select("doc_id")
        return docs.select(*COLUMNS).join(out, "doc_id", "left_anti").select(*COLUMNS)
    # repeated doc_ids: rows are numbered, once, and linked by number
    rows = Scratch(spark, "near-dedup").write(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("__row")), "rows")
    group = (minhash.near_duplicates(rows.select(F.when(F.col("doc_id").isNotNull(), F.col("__row")).alias("doc_id"), "text"))
             .filter("doc_id is not null").select(F.col("doc_id").alias("__row"), "component_id"))
    first = (group.join(rows.select("__row", "doc_id", F.xxhash64("text").alias("h")), "__row").groupBy("component_id")
             .agg(F.min(F.struct("doc_id", "h", "__row")).alias("f")).select("f.__row"))
    out = group.select("__row").join(first, "__row", "left_anti")
    return rows.join(out, "__row", "left_anti").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; benchmark passages leave the others."""
    base = docs.select(*COLUMNS, F.col("text").alias("__before"))
    return _recounted(decontam.remove_spans(base, table(spark, sf_dir, "benchmark")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rest in sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("pack", pack)]

# The trained network of the first stage and the tokenizer of the last have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tmp = Scratch(spark, "corpus-pipeline")
    for name, stage in STAGES:
        docs = tmp.write(stage(spark, docs, sf_dir), name)
    return docs
