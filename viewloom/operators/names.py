"""Matching column names that contain each other.

A nested loop over all pairs of names would be quadratic. Containment is turned into equality instead:
a name is contained in another one exactly if it equals one of its substrings. Only windows of lengths that occur
on the other side are cut (an empty name only if there is one), each keeps only the first name that has it (combined before the shuffle), and a hash
join does the rest. No pair that does not match is ever built, and the result is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

RULES = ("contains", "bidir", "bidir_noP")


def _folded(c: Column, rule: str) -> Column:
    if rule == "bidir":
        return F.replace(c, F.lit("_"), F.lit(""))
    if rule == "bidir_noP":
        return F.translate(c, "_P", "")
    return c


def _lengths(keys: DataFrame) -> Column:
    """The lengths that occur, as one array: no more entries than the longest name has characters."""
    return keys.agg(F.array_sort(F.collect_set(F.length("key")))).scalar()


def _windows(c: Column, lengths: Column) -> Column:
    """The distinct substrings of the given lengths."""
    fitting = F.filter(F.coalesce(lengths, F.array().cast("array<int>")), lambda n: n <= F.length(c))
    per_length = F.transform(
        fitting,
        lambda n: F.when(n == 0, F.array(F.lit(""))).otherwise(
            F.transform(F.sequence(F.lit(1), F.length(c) - n + 1), lambda i: F.substring(c, i, n))
        ),
    )
    return F.array_distinct(F.flatten(per_length))


def match_names(names: DataFrame, candidates: DataFrame, rule: str = "contains") -> DataFrame:
    """First matching candidate, in alphabetical order, per name.

    Both frames have one string column; the result has the columns ``name`` and ``matched``.
    ``contains``: the name is inside the candidate. ``bidir``: either is inside the other, ignoring
    underscores. ``bidir_noP``: as before, ignoring every ``P`` too.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}")
    wanted = names.toDF("name").filter("name is not null").distinct().withColumn("key", _folded(F.col("name"), rule))
    offered = candidates.toDF("cand").filter("cand is not null").distinct()
    offered = offered.withColumn("key", _folded(F.col("cand"), rule))

    inside = offered.withColumn("lengths", _lengths(wanted))
    inside = inside.select(F.explode(_windows(F.col("key"), F.col("lengths"))).alias("key"), "cand")
    inside = inside.groupBy("key").agg(F.min("cand").alias("cand"))
    # both sides grow with the input, and files and text say little about their size in memory: never sent through the driver
    hits = wanted.join(inside.hint("merge"), "key", "inner").select("name", "cand")
    if rule != "contains":
        whole = offered.groupBy("key").agg(F.min("cand").alias("cand"))
        parts = wanted.withColumn("lengths", _lengths(offered))
        parts = parts.select("name", F.explode(_windows(F.col("key"), F.col("lengths"))).alias("key"))
        hits = hits.unionByName(parts.join(whole.hint("merge"), "key", "inner").select("name", "cand"))
    best = hits.groupBy("name").agg(F.min("cand").alias("matched"))
    return wanted.select("name").join(best.hint("merge"), "name", "left")
