"""The relational node kinds of a calculation view: projection, aggregation, join, rank, union."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from viewloom.operators.scans import Ordering, at_extreme, ranked
from viewloom.specs import ColumnMap, JoinInput, NodeOptions, UnionInput

JOIN_KINDS = {
    "inner": "inner",
    "referential": "inner",  # the hint that every key exists changes no result
    "leftouter": "left",
    "rightouter": "right",
}

AGGREGATES = {
    "SUM": F.sum,
    "MAX": F.max,
    "MIN": F.min,
    "COUNT": F.count,
    "AVG": F.avg,
}


def mapped(mapping: ColumnMap) -> list[Column]:
    return [F.col(source).alias(target) for target, source in mapping.items()]


def project(df: DataFrame, mapping: ColumnMap, options: NodeOptions = NodeOptions()) -> DataFrame:
    """Filter the input, pick and rename columns, then add calculated columns over the new names."""
    rows = df if options.where is None else df.filter(options.where)
    rows = rows.select(*mapped(mapping))
    return rows.select("*", *[expr.alias(name) for name, expr in options.calc.items()]) if options.calc else rows


def value_filter(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Element filters, AND-ed: a single value means equality, a list means membership."""
    for name, wanted in values.items():
        many = isinstance(wanted, (list, tuple, set))
        df = df.filter(F.col(name).isin(*wanted) if many else F.col(name) == wanted)
    return df


def grouped(df: DataFrame, columns: Sequence[str], aggs: Mapping[str, str]) -> DataFrame:
    """Group by every column that has no aggregation; without any this is a distinct."""
    keys = [c for c in columns if c not in aggs]
    if not aggs:
        return df.select(*columns).distinct()
    measures = [AGGREGATES[kind.upper()](name).alias(name) for name, kind in aggs.items()]
    return df.groupBy(*keys).agg(*measures).select(*columns)


def aggregate(df: DataFrame, mapping: ColumnMap, options: NodeOptions = NodeOptions()) -> DataFrame:
    """Aggregation node: the filter acts on the input; calculated columns join the group keys."""
    rows = project(df, mapping, options)
    aggs = {name: kind for name, kind in options.aggs.items() if kind.upper() not in ("NONE", "FORMULA")}
    return grouped(rows, rows.columns, aggs)


def join(left: JoinInput, right: JoinInput, kind: str, options: NodeOptions = NodeOptions()) -> DataFrame:
    """Join node: equality of the paired keys, an explicit column list, optional aggregation.

    Columns are taken by side, so equal names on both inputs never clash.
    """
    how = JOIN_KINDS[kind.lower()]
    a, b = left.df.alias("l"), right.df.alias("r")
    condition = None
    if not left.keys:
        raise ValueError("a join node needs keys")
    for lk, rk in zip(left.keys, right.keys, strict=True):
        equal = F.col(f"l.{lk}") == F.col(f"r.{rk}")
        condition = equal if condition is None else condition & equal
    shown = [F.col(f"l.{s}").alias(t) for t, s in left.mapping.items()]
    shown += [F.col(f"r.{s}").alias(t) for t, s in right.mapping.items()]
    rows = a.join(b, condition, how).select(*shown)
    if options.where is not None:
        rows = rows.filter(options.where)
    if options.calc:
        rows = rows.select("*", *[expr.alias(name) for name, expr in options.calc.items()])
    return grouped(rows, rows.columns, options.aggs) if options.aggs else rows


def rank_node(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[str],
    threshold: int = 1,
    descending: bool = True,
    mode: str = "eq",
    chunk: Column | None = None,
    out: str | None = None,
) -> DataFrame:
    """Rows whose rank equals (``eq``) or does not pass (``le``) the threshold; ties are kept.

    ``out`` also shows the rank, as a column of that name.
    """
    if threshold == 1:
        first = at_extreme(df, partition, order, latest=descending)
        return first.withColumn(out, F.lit(1).cast("long")) if out else first
    scan = Ordering(tuple(partition), tuple(order), descending, chunk)
    rank = F.col("__rank")
    kept = rank == threshold if mode == "eq" else rank <= threshold
    found = ranked(df, scan, "__rank").filter(kept)
    return found.withColumnRenamed("__rank", out) if out else found.drop("__rank")


def union(inputs: Sequence[UnionInput], columns: Sequence[str]) -> DataFrame:
    """Union node: UNION ALL of the inputs brought to ``columns``; unmapped targets are NULL.

    A NULL has the type of the first input that maps the column, or is a string where none does.
    """
    types = {c: next((i.df.select(i.mapping[c]).schema[0].dataType for i in inputs if c in i.mapping), T.StringType()) for c in columns}
    result = None
    for item in inputs:
        m = item.mapping
        rows = item.df.select(*[(F.col(m[c]) if c in m else F.lit(None).cast(types[c])).alias(c) for c in columns])
        result = rows if result is None else result.unionByName(rows)
    return result
