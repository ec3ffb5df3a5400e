"""A training corpus from raw documents, stage by stage.

Every stage works on all rows that its predecessor kept, is written as Parquet and read again. All but the last return the
columns of ``documents``; other columns do not reach the result. Rows may hold nulls in any column, and an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.llm import langid, mixing, packing, secrets, simhash
from viewloom.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that language identification rejects: no letter, or far from every language it has learned from ``lang``."""
    rows = _documents(docs)
    model = langid.fit(rows, F.lit(True))
    return langid.predict(rows, model).where(~F.col("rejected")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: the one with the least id."""
    return simhash.keep_one(_documents(docs))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks what the scan takes for a secret; the text and its number of characters change, no document goes."""
    rows = _documents(docs)
    return secrets.mask(rows, secrets.fit(rows)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats each document as often as the mix takes it; documents it does not take go."""
    mixed = mixing.mix(_documents(docs)).where("copies > 0")
    return mixed.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of at most 2048 tokens; each copy of a document is a document of its own."""
    files = [public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("tiktoken", "json")]
    return packing.pack(_documents(docs), *files, public_tokenizers.PATTERN)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("secret_scan", secret_scan), ("mix", mix), ("pack", pack)]

#: The model stages have no SQL; tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
