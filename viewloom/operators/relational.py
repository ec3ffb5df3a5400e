"""Filters, joins, set operations and aggregations that scripts use besides the view nodes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from viewloom.operators.scans import Ordering, running_count
from viewloom.session import materialize

# --- rows and columns -------------------------------------------------------------------------


def in_keys(df: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose ``column`` occurs in the single column of ``keys``."""
    return df.join(keys.toDF(column), column, "left_semi")


def drop_blank_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with nothing in any of ``columns``."""
    return df.na.drop("all", subset=list(columns))


def suffix_columns(df: DataFrame, suffix: str) -> DataFrame:
    return df.toDF(*[c + suffix for c in df.columns])


# --- joins ------------------------------------------------------------------------------------


def with_key_count(df: DataFrame, key: str, out: str = "cnt") -> DataFrame:
    """Attach the number of rows per key. NULL keys get no count: the join drops them from matching."""
    return df.join(df.groupBy(key).agg(F.count(F.lit(1)).alias(out)), key, "left").select(*df.columns, out)


def lookup(df: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join to a dimension. Spark broadcasts it when its measured size is under the session limit."""
    return df.join(dim, list(keys), "left")


def latest_load(df: DataFrame, column: str) -> DataFrame:
    """Rows of the most recent load. The maximum is a scalar subquery, so it filters the scan."""
    newest = df.agg(F.max(column).alias("newest"))
    return df.filter(F.col(column) == newest.scalar())


def conditional_key_join(
    base: DataFrame, links: DataFrame, key: str, extra_key: str, columns: Sequence[str]
) -> DataFrame:
    """Join on ``key`` and ``extra_key`` where the link fills the second one, else on ``key`` alone."""
    shown = [*base.columns, *columns]
    both = base.join(links.filter(F.col(extra_key) != ""), [key, extra_key], "inner").select(*shown)
    blank = links.filter(F.col(extra_key) == "").drop(extra_key)
    return base.join(blank, key, "inner").select(*shown).union(both)


# --- set operations ---------------------------------------------------------------------------


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL by position."""
    return reduce(DataFrame.union, frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    """UNION by position."""
    return union_all(*frames).distinct()


def distinct_union(*frames: DataFrame) -> DataFrame:
    """DISTINCT over a UNION ALL matched by name."""
    return reduce(DataFrame.unionByName, frames).distinct()


def union_ragged(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name of frames of different width; missing columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def tagged_union(frames: Mapping[str, DataFrame], column: str) -> DataFrame:
    """UNION ALL by name, each part marked with its tag."""
    return reduce(DataFrame.unionByName, [df.withColumn(column, F.lit(tag)) for tag, df in frames.items()])


# --- collecting aggregations ------------------------------------------------------------------


#: Members of one row of a grouped list.
PART_SIZE = 100


def group_members(df: DataFrame, group: str, member: str, part_size: int = PART_SIZE) -> DataFrame:
    """Distinct members per group in sorted order, as rows (group, part_no, members) of ``part_size`` members each.

    Part n (from 0) holds the members at positions n * part_size + 1 and following, whatever the size of the group, so the
    parts put together in order are the sorted group. NULL members are left out (a group without any other has one empty part).
    Positions come from a range partitioning by group and member, so a hot group is spread over many tasks.
    """
    pairs = df.select(F.col(group).alias("group"), F.col(member).alias("member")).distinct()
    spread = pairs.repartitionByRange("group", "member").withColumn("__range", F.spark_partition_id())
    order = Ordering(("group",), ("member",), chunk=F.col("__range"))
    placed = running_count(materialize(spread, "members"), order, "member", "__no")
    part = F.floor((F.greatest("__no", F.lit(1)) - 1) / part_size).cast("long")
    parts = placed.select(F.col("group").alias(group), part.alias("part_no"), "member").repartition(group, "part_no")
    return parts.groupBy(group, "part_no").agg(F.array_sort(F.collect_list("member")).alias("members"))


# Name of the group of rows without one, marker line of a member, flag of two systems.
NO_GROUP, MARKER, BOTH_SYSTEMS = "withoutgroupid", ("CV_", " starts here\n\n"), "HANA/BW"


def labelled_groups(df: DataFrame, group: str, label: str = NO_GROUP) -> DataFrame:
    """Rows without a group go to one named group."""
    return df.withColumn(group, F.coalesce(F.col(group).cast("string"), F.lit(label)))


def combine_group(df: DataFrame, group: str, name: str, text: str, part_size: int = PART_SIZE) -> DataFrame:
    """Members of a group joined to one text in name order, each behind a marker line.

    As with :func:`group_members` the rows are parts of ``part_size`` members; in order they are the whole text.
    """
    before, after = MARKER
    body = F.concat(F.lit(before), F.col(name), F.lit(after), F.col(text))
    rows = df.select(F.col(group), F.struct(F.col(name).alias("n"), body.alias("b")).alias("entry"))
    parts = group_members(rows, group, "entry", part_size)
    joined = F.array_join(F.transform("members", lambda m: m["b"]), "\n")
    return parts.select(group, "part_no", F.size("members").alias("n_members"), joined.alias("combined"))


def source_flag(df: DataFrame, flow: str, system: str) -> DataFrame:
    """One system: its name; two: ``HANA/BW``; otherwise ``None``. A missing system counts as one."""
    counted = df.groupBy(flow).agg(
        (F.count_distinct(system) + F.max(F.when(F.col(system).isNull(), 1).otherwise(0))).alias("n"),
        F.min(system).alias("only"),
    )
    flag = F.when(F.col("n") == 1, F.col("only")).when(F.col("n") == 2, BOTH_SYSTEMS).otherwise("None")
    return counted.select(flow, flag.alias("source_flag"))


def coverage(df: DataFrame, matched: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Items seen, items matched, and the rate in percent (NULL without items)."""
    seen, hits = F.count(F.lit(1)), F.count_if(matched)
    rate = F.round(hits * F.lit(100.0) / F.nullif(seen, F.lit(0)), 1)
    return df.groupBy(*keys).agg(seen.alias("seen"), hits.alias("matched"), rate.alias("rate_pct"))
