"""The corpus operators over their whole tables: one query each, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from viewloom.llm import alignment, chat, html, langid, minhash, mixing, nbsvm, packing, perplexity, secrets, simhash, topk, whitening
from viewloom.llm.common import held_out, table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens."""
    import public_tokenizers

    files = [public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("tiktoken", "json")]
    return packing.pack(table(spark, sf_dir, "documents"), *files, public_tokenizers.PATTERN)


def op2_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the perplexity verdict on every document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return perplexity.judge(documents, perplexity.fit_folds(documents)).drop("lang")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate for a secret in every document, with the verdict of the forest."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secrets.scan(documents, secrets.fit(documents))


#: A conversation whose texts hold control strings of common templates.
SPIKED = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all formatted conversations, read back from the formatted text."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    spiked = spark.createDataFrame(SPIKED, T.StructType([T.StructField(f.name, f.dataType) for f in turns.schema]))
    return chat.read_back(chat.segments(turns.unionByName(spiked)), sorted_by_conversation=True)


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector with all others."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document; the model is fitted on labels that are not held out."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = nbsvm.fit(documents, table(spark, sf_dir, "labels"), ~held_out())
    return nbsvm.score(documents.withColumn("held_out", held_out()), model).select("doc_id", "held_out", "score", "predicted")


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; the model is fitted on the rows that are not held out."""
    documents = table(spark, sf_dir, "documents")
    model = langid.fit(documents, ~held_out())
    rows = documents.select("doc_id", held_out().alias("held_out"), "text")
    return langid.predict(rows, model).drop("text")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(documents).select("doc_id", "size", "source_size", "target", "taken")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op11_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document by confirmed similarity of shingle sets."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two vocabularies line up in every document."""
    import public_tokenizers as public

    files = alignment.Files(public.path("byte_bpe_50k.tiktoken"), public.path("byte_bpe_50k.json"), public.PATTERN, public.path("piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"), files, keep=False)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector on the sixteen leading components of the distinct vectors' covariance."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_packing, op2_perplexity, op3_secrets, op4_chat_format, op5_top_k, op6_quality, op7_main_text, op8_language, op9_mixing, op10_simhash, op11_minhash, op12_alignment, op13_whitening)}


def oracle_sql() -> dict[str, str]:
    return {"op9_mixing": mixing.oracle()}
