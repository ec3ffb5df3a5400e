"""Helpers shared by the corpus operators: tables, words, batches, character n-grams."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word is a run of characters other than ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
WORD = re.compile(WORD_PATTERN)

#: Code points that one numpy pass takes; longer texts are worked off in overlapping slices.
SLICE = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(key: str = "doc_id") -> Column:
    """True for the rows kept out of training: CRC-32 of the id as text is 1 modulo 3. A null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def with_columns(df: DataFrame, inputs: list[str], fields: list[T.StructField], compute: Callable[..., list[list]]) -> DataFrame:
    """Add columns computed from the named inputs, batch by batch.

    ``compute`` gets one Python list per input and returns one list per field. Every other column passes
    through untouched; a column that already has the name of a new field is replaced by it.
    """
    names = {f.name for f in fields}
    kept = [c for c in df.columns if c not in names]
    work = [f"__in{i}" for i in range(len(inputs))]
    picked = df.select(*[F.col(f"`{c}`") for c in kept], *[F.col(f"`{c}`").alias(w) for c, w in zip(inputs, work)])
    schema = T.StructType([*picked.select(*[F.col(f"`{c}`") for c in kept]).schema.fields, *fields])
    arrow = [pa.field(f.name, _arrow(f.dataType)) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_columns - len(work)
            made = compute(*[batch.column(n + i).to_pylist() for i in range(len(work))])
            columns = [batch.column(i) for i in range(n)] + [pa.array(v, f.type) for v, f in zip(made, arrow)]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([*[batch.schema.field(i) for i in range(n)], *arrow]))

    return picked.mapInArrow(run, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def slices(text: str, overlap: int, size: int = SLICE) -> Iterator[str]:
    """The whole text in pieces that share ``overlap`` characters, so that every n-gram lies in one piece."""
    if len(text) <= size:
        yield text
        return
    for start in range(0, max(1, len(text) - overlap), size):
        yield text[start : start + size + overlap]


def gram_buckets(points: np.ndarray, order: int, bits: int) -> np.ndarray:
    """Hash buckets of all n-grams of one order, by a multiplicative hash on 32 bits."""
    n = len(points) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    value = points[:n] * np.uint32(0x9E3779B1) + np.uint32(order)
    for i in range(1, order):
        value = (value ^ (value >> np.uint32(15))) * np.uint32(0x85EBCA6B) + points[i : i + n] * np.uint32(0x9E3779B1)
    value = (value ^ (value >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return (value >> np.uint32(32 - bits)).astype(np.int64)
