"""The corpus pipeline: from raw documents to packed training sequences.

Every stage takes the documents that the one before kept, written as Parquet, and returns the
documents it keeps in the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from series_lake.llm.language import UNDETERMINED, identify, learn
from series_lake.llm.line_dedup import EVERY_LINE, dedup_lines
from series_lake.llm.mixing import mix
from series_lake.llm.ngram_join import Join, one_of_each
from series_lake.llm.packing import pack
from series_lake.llm.staging import KEPT, release, staging


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language: a letter, that is. A clean text in several languages stays;
    where no label teaches a language, all documents do."""
    model = learn(docs)
    if not model.languages:
        return docs
    return identify(docs, model, docs.columns).where(F.col("__lang_pred") != UNDETERMINED).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the lines that stay; those that lost all their lines go."""
    left = dedup_lines(docs, EVERY_LINE).where((F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return left.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose shingles of five words are 0.8 alike."""
    return one_of_each(docs, Join(width=5, num=80, den=100))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


def _stage(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage whose predecessor's result is written, so what that read may go."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _OPEN)
        before = list(KEPT)
        result = function(spark, docs, sf_dir)
        _OPEN[:] = [p for p in KEPT if p not in before]
        return result

    return run_stage


_OPEN: list[str] = []

STAGES = [(f.__name__, _stage(f)) for f in (language_id, line_dedup, ngram_join, source_mixing, packing)]

#: Mixture estimates, MinHash and the tokenizer are beyond SQL; tests hold each stage against a
#: plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with staging(spark, "pipeline") as area:
        for _, stage in STAGES[:-1]:
            after = area.write(stage(spark, docs, sf_dir))
            area.drop(docs)
            docs = after
        result = STAGES[-1][1](spark, docs, sf_dir)
        _OPEN.clear()  # the caller still reads them
        return result
