"""The corpus pipeline: documents in, token ids out. Each stage is one of the numbered operators on what its predecessor kept.

All stages take any table with the columns of documents, also others beside them, whatever their names, and all but the
last return the columns that they got. Rows count one by one, also where ids repeat or are null; texts are worked on
whole, however long; an empty table gives an empty one. Null and empty texts, and ties, are stated at each stage.

A stage writes its result, which is all that it leaves behind; that table goes once nobody reads it any more, so runs of
one session do not meet. The token files of the last stage are the product and stay.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.llm import decontaminate, langid, minhash, mixing, tokens
from hearthline.llm.staging import fresh, keyed_join, stage, with_row_key

#: Rows that cross to Python at a time, while a stage works: texts are long, and workers keep what their largest batch needed.
BATCH_SETTING, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"


def _stage(f):
    @functools.wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        before = spark.conf.get(BATCH_SETTING)
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)
        try:
            return stage(f(spark, docs, sf_dir), f"pipeline-{f.__name__}")
        finally:
            spark.conf.set(BATCH_SETTING, before)

    return run


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents for which no language is found go: those with a null text or one without letters; all, if no document
    has a label to learn from. Equal proportions are a language found."""
    return langid.keep_identified(docs)


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (similarity of at least 0.8), the row with the smallest id stays; of several
    with that id one, and one with a null id only if all are null. Texts without words are like no other and stay."""
    return minhash.drop_near_duplicates(docs)


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts and items match nothing."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it, 0 to 2 times. Texts without words weigh nothing and stay once. Ties in
    rank go by id, size and row."""
    rows, row = with_row_key(docs)
    drawn_row, copies, copy = fresh(rows, "_drawn"), fresh(rows, "_copies"), fresh(rows, "_copy")
    # keys of rows do not repeat, so those that are not here are taken once
    drawn = mixing.mix_sources(rows, row_col=row)
    drawn = stage(drawn.where("copies <> 1 and size > 0").select(F.col(row).alias(drawn_row), F.col("copies").alias(copies)), "mix-drawn")
    out = keyed_join(rows, drawn, rows[row] == drawn[drawn_row], "left").withColumn(copies, F.coalesce(copies, F.lit(1)))
    return out.where(F.col(copies) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(*docs.columns)


@_stage
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in wavelet matrix files; one row per row of ``docs``, read from the files, in the order of ids (null
    first). A null or empty text is the end id alone."""
    return tokens.token_output(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [("language_id", language), ("near_dedup", near_dedup), ("decontamination", decontamination), ("source_mix", mixture), ("token_ids", token_ids)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage_of in STAGES:
        docs = stage_of(spark, docs, sf_dir)
    return docs
