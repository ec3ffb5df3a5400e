"""Declarative pieces of a view node."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

# Target column -> source column. Targets keep the order of the mapping.
ColumnMap = Mapping[str, str]


@dataclass(frozen=True)
class UnionInput:
    """One input of a union node. Targets missing from ``mapping`` become NULL."""

    df: DataFrame
    mapping: ColumnMap


@dataclass(frozen=True)
class JoinInput:
    """One input of a join node: which of its columns the node shows, and under which name."""

    df: DataFrame
    mapping: ColumnMap
    keys: tuple[str, ...]


@dataclass(frozen=True)
class NodeOptions:
    """What every node may add: a filter on its input, calculated columns and aggregated elements."""

    where: Column | str | None = None
    calc: Mapping[str, Column] = field(default_factory=dict)
    aggs: Mapping[str, str] = field(default_factory=dict)
