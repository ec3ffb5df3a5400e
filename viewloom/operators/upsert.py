"""Upsert for plain tables, which know no MERGE: as a frame, or in place over the key buckets that change."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from viewloom.session import materialize

#: Partition column of a table whose rows are dealt to buckets by their keys, and the table property that holds their number and the keys.
BUCKET, PROPERTY = "key_bucket", "viewloom.buckets"


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    insert: Sequence[str] | None = None,
) -> DataFrame:
    """MERGE of ``source`` into ``target`` as one full outer join.

    Matched rows take the ``update`` columns of the source, even where they are NULL there. Unmatched
    source rows are inserted with the keys and the ``insert`` columns; the rest is NULL. Both default
    to all columns of the source. A key that the source has twice is an error when the result is computed, as MERGE demands; keys with a NULL match nothing
    and may repeat.
    """
    others = [c for c in source.columns if c not in keys]
    update = others if update is None else list(update)
    insert = others if insert is None else list(insert)
    t = target.withColumn("__target", F.lit(True)).alias("t")
    # the window deals rows by the keys of the join, so that it costs no exchange of its own
    repeated = F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    message = F.concat(F.lit("the source of a merge repeats the key "), F.to_json(F.struct(*keys)))
    unique = F.when(repeated & known, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    s = source.withColumn("__source", unique).alias("s")
    matching = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    both = t.join(s, matching, "full_outer")
    old, new = F.col("t.__target").isNotNull(), F.col("s.__source").isNotNull()

    def merged(name: str):
        if name in keys:
            return F.when(old, F.col(f"t.{name}")).otherwise(F.col(f"s.{name}"))
        value = F.when(old & new, F.col(f"s.{name}" if name in update else f"t.{name}"))
        value = value.when(old, F.col(f"t.{name}"))
        return value.otherwise(F.col(f"s.{name}")) if name in insert else value

    return both.select(*[merged(c).alias(c) for c in target.columns])


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def save_by_key(df: DataFrame, name: str, keys: Sequence[str], buckets: int = 64) -> None:
    """Write a table whose rows are dealt to partitions by a hash of their keys, for :func:`merge_table`."""
    placed = df.withColumn(BUCKET, _bucket(keys, buckets)).repartition(buckets, BUCKET)
    placed.write.mode("overwrite").partitionBy(BUCKET).saveAsTable(name)
    df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PROPERTY}' = '{buckets}:{','.join(keys)}')")


def merge_table(source: DataFrame, name: str, update: Sequence[str] | None = None, insert: Sequence[str] | None = None) -> None:
    """MERGE of ``source`` into a table of :func:`save_by_key`; only buckets that hold a key of the source are read and written anew.

    The merged buckets are written to the checkpoint folder before they replace the old ones, so that an error, a repeated key for
    one, leaves the table as it was.
    """
    spark = source.sparkSession
    told = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == PROPERTY).first()
    if told is None:
        raise ValueError(f"{name} is no table of save_by_key")
    buckets, keys = int(told["value"].split(":")[0]), told["value"].split(":")[1].split(",")
    changes = materialize(source, "changes")
    # numbers below the number of buckets, whatever the source
    touched = [r[0] for r in changes.select(_bucket(keys, buckets)).distinct().collect()]
    table = spark.table(name)
    old = table.where(F.col(BUCKET).isin(touched)).drop(BUCKET)
    merged = upsert(old, changes, keys, update, insert).withColumn(BUCKET, _bucket(keys, buckets))
    staged = materialize(merged.select(*table.columns), "merged").repartition(buckets, BUCKET)
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # inserting into a table knows no option for it
    try:
        staged.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, before)


def replace_table(spark: SparkSession, df: DataFrame, name: str) -> None:
    """Replace a table with a frame that may read it: write beside it, then swap the names.

    The old table keeps its rows under a backup name until the new one stands; if the swap fails it gets its name back.
    """
    staged, backup = f"{name}__staged", f"{name}__backup"
    df.write.mode("overwrite").saveAsTable(staged)
    existed = spark.catalog.tableExists(name)
    if existed:
        spark.sql(f"DROP TABLE IF EXISTS {backup}")
        spark.sql(f"ALTER TABLE {name} RENAME TO {backup}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {name}")
    except Exception:
        if existed:
            spark.sql(f"ALTER TABLE {backup} RENAME TO {name}")
        raise
    if existed:
        spark.sql(f"DROP TABLE {backup}")
