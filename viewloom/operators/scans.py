"""Ordered scans: window functions whose hot keys are spread over many tasks.

A plain ``Window.partitionBy(key)`` puts all rows of a key into one task. Mutation logs have hot keys,
so every function here works in two levels:

1. rows are windowed inside ``(key, chunk)``, where *chunk* never decreases along the sort order
   (by default the leading sort column, e.g. a processing date);
2. one small row per ``(key, chunk)`` is made by a normal aggregation (combined before its shuffle),
   scanned in chunk order, and handed back to the rows of the chunk as a carry.

The rows are shuffled once, by ``(key, chunk)``; that same partitioning serves the window and the join
with the carries. Level two holds at most one row per chunk of a key, so give a coarse ``chunk`` when the
leading sort column is nearly unique, and a finer one, a struct of the leading column and a range of the
next, when one value of it holds very many rows. Where the only sort column is the chunk, all its rows tie and the carry alone gives
``rank``, running counts and default-frame windows: there is no window over the rows at all. A chunk must be a function of the sort columns: rows that
tie then stay together, which keeps ``rank`` and default-frame windows exact.

Where every key is known to fit one task (``Ordering.whole``), the windows run over the whole key: one shuffle by the keys, no carries.

The input is read twice; write an expensive one first (``session.materialize``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

_SLOT, _CHUNK = "__slot", "__chunk"


@dataclass(frozen=True)
class Ordering:
    """How a log is keyed and sorted. ``descending`` turns all sort columns around; ``whole`` says that no key needs cutting into chunks."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    descending: bool = False
    chunk: Column | None = None
    whole: bool = False

    def sorting(self) -> list[Column]:
        return [F.col(c).desc() if self.descending else F.col(c).asc() for c in self.order]

    def position(self) -> Column:
        return F.struct(*[F.col(c) for c in self.order])

    def chunk_column(self) -> Column:
        return F.col(self.order[0]) if self.chunk is None else self.chunk

    def tied(self) -> bool:
        """The chunk is the whole order: all rows of a chunk tie, and what the chunks before it hand over decides."""
        return self.chunk is None and len(self.order) == 1 and not self.whole

    def slot(self, chunk: Column) -> Column:
        # One struct column to join on: unlike plain equality it also joins NULL keys to themselves.
        return F.struct(F.struct(*[F.col(k) for k in self.keys]).alias("key"), chunk.alias("chunk"))

    def slotted(self, df: DataFrame) -> DataFrame:
        return df if self.whole else df.withColumn(_SLOT, self.slot(self.chunk_column()))

    def inside(self):
        return Window.partitionBy(*(self.keys if self.whole else [_SLOT])).orderBy(*self.sorting())

    def between(self):
        chunk = F.col(_CHUNK)
        return Window.partitionBy(*self.keys).orderBy(chunk.desc() if self.descending else chunk.asc())

    def head(self, value: Column) -> Column:
        """Aggregate: ``value`` of the first row of a chunk."""
        pick = F.max_by if self.descending else F.min_by
        return pick(value, self.position())

    def tail(self, value: Column) -> Column:
        """Aggregate: ``value`` of the last row of a chunk."""
        pick = F.min_by if self.descending else F.max_by
        return pick(value, self.position())


def _with_carry(slotted: DataFrame, o: Ordering, partials: dict[str, Column], carries: dict[str, Column]) -> DataFrame:
    """Join each row to the carry of its chunk. ``carries`` are already windowed over the chunk rows."""
    if o.whole:
        return slotted.withColumns({name: F.lit(None) for name in carries})
    chunks = slotted.groupBy(*o.keys, F.col(f"{_SLOT}.chunk").alias(_CHUNK)).agg(
        *[agg.alias(name) for name, agg in partials.items()]
    )
    carried = chunks.select(o.slot(F.col(_CHUNK)).alias(_SLOT), *[c.alias(name) for name, c in carries.items()])
    return slotted.join(carried, _SLOT, "left")


def _before(o: Ordering):
    return o.between().rowsBetween(Window.unboundedPreceding, -1)


def _through(o: Ordering):
    """Up to and including the chunk itself."""
    return o.between().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def next_value(df: DataFrame, o: Ordering, value: str, out: str) -> DataFrame:
    """``lead(value)`` over the ordering (the successor pointer of a log)."""
    return _neighbour(df, o, {out: F.col(value)}, forward=True)


def previous_values(df: DataFrame, o: Ordering, outs: dict[str, Column]) -> DataFrame:
    """``lag`` of several expressions at once."""
    return _neighbour(df, o, outs, forward=False)


def _neighbour(df: DataFrame, o: Ordering, outs: dict[str, Column], forward: bool) -> DataFrame:
    packed = F.struct(*[expr.alias(name) for name, expr in outs.items()])
    edge = o.head(packed) if forward else o.tail(packed)
    step = F.lead if forward else F.lag
    carried = _with_carry(o.slotted(df), o, {"__edge": edge}, {"__edge": step("__edge").over(o.between())})
    # A missing inner neighbour is a NULL struct; a neighbour holding NULLs is a struct of NULLs.
    inner = step(packed).over(o.inside())
    found = carried.withColumn("__near", F.when(inner.isNotNull(), inner).otherwise(F.col("__edge")))
    return found.select(*df.columns, *[F.col(f"__near.{name}").alias(name) for name in outs])


def ranked(df: DataFrame, o: Ordering, out: str = "rank") -> DataFrame:
    """``rank()``: ties share a number."""
    if o.tied():
        carried = _with_carry(o.slotted(df), o, {"__n": F.count(F.lit(1))}, {"__ahead": F.sum("__n").over(_before(o))})
        number = F.coalesce(F.col("__ahead"), F.lit(0)) + 1
        return carried.withColumn(out, number.cast("long")).select(*df.columns, out)
    return _numbered(df, o, out, F.rank())


def numbered(df: DataFrame, o: Ordering, out: str = "row_no") -> DataFrame:
    """``row_number()``; the sort columns should be unique within the key."""
    return _numbered(df, o, out, F.row_number())


def _numbered(df: DataFrame, o: Ordering, out: str, number: Column) -> DataFrame:
    carried = _with_carry(
        o.slotted(df), o, {"__n": F.count(F.lit(1))}, {"__ahead": F.sum("__n").over(_before(o))}
    )
    total = number.over(o.inside()) + F.coalesce(F.col("__ahead"), F.lit(0))
    return carried.withColumn(out, total.cast("long")).select(*df.columns, out)


def running(
    df: DataFrame,
    o: Ordering,
    outs: dict[str, tuple[Callable[[Column], Column], str]],
    rows: bool = True,
) -> DataFrame:
    """Running ``min`` or ``max``: ``outs = {name: (F.min, column)}``.

    ``rows=False`` uses the default frame, where rows that tie share the result.
    """
    if o.tied() and not rows:
        partials = {f"__p_{n}": fn(F.col(c)) for n, (fn, c) in outs.items()}
        carried = _with_carry(o.slotted(df), o, partials, {n: fn(F.col(f"__p_{n}")).over(_through(o)) for n, (fn, _) in outs.items()})
        return carried.select(*df.columns, *outs)
    frame = o.inside()
    if rows:
        frame = frame.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    combine = {F.min: F.least, F.max: F.greatest}
    partials = {f"__p_{n}": fn(F.col(c)) for n, (fn, c) in outs.items()}
    carries = {f"__c_{n}": fn(F.col(f"__p_{n}")).over(_before(o)) for n, (fn, _) in outs.items()}
    carried = _with_carry(o.slotted(df), o, partials, carries)
    # least/greatest skip NULLs, as the aggregates do
    results = [combine[fn](fn(F.col(c)).over(frame), F.col(f"__c_{n}")).alias(n) for n, (fn, c) in outs.items()]
    return carried.select(*df.columns, *results)


def running_count(df: DataFrame, o: Ordering, flag: str, out: str) -> DataFrame:
    """Running ``count(flag)`` over the default frame: ties share the count. This numbers islands."""
    if o.tied():
        carried = _with_carry(o.slotted(df), o, {"__n": F.count(flag)}, {out: F.sum("__n").over(_through(o))})
        return carried.withColumn(out, F.col(out).cast("long")).select(*df.columns, out)
    carried = _with_carry(
        o.slotted(df), o, {"__n": F.count(flag)}, {"__ahead": F.sum("__n").over(_before(o))}
    )
    total = F.count(flag).over(o.inside()) + F.coalesce(F.col("__ahead"), F.lit(0))
    return carried.withColumn(out, total.cast("long")).select(*df.columns, out)


def last_known(df: DataFrame, o: Ordering, values: dict[str, Column], known: Column) -> DataFrame:
    """Replace or add ``values`` by those of the latest row, up to and including this one, where ``known``."""
    packed = F.when(known, F.struct(*[expr.alias(name) for name, expr in values.items()]))
    marked = o.slotted(df.withColumn("__seen", packed))
    # tail over known rows only: the position is NULL elsewhere, and max_by/min_by skip NULL positions
    pick = F.min_by if o.descending else F.max_by
    edge = pick(F.col("__seen"), F.when(F.col("__seen").isNotNull(), o.position()))
    carried = _with_carry(
        marked, o, {"__edge": edge}, {"__edge": F.last("__edge", ignorenulls=True).over(_before(o))}
    )
    frame = o.inside().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    latest = F.coalesce(F.last("__seen", ignorenulls=True).over(frame), F.col("__edge"))
    filled = carried.withColumn("__latest", latest)
    kept = [c for c in df.columns if c not in values]
    return filled.select(*kept, *[F.col(f"__latest.{name}").alias(name) for name in values])


def island_fill(df: DataFrame, o: Ordering, flag: str, values: Sequence[str]) -> DataFrame:
    """Give every row the ``values`` of the flagged row that opened its island.

    An island begins where ``flag`` is 1 and reaches to the next flagged position; rows before the first have no
    opener and drop out. If several flagged rows tie, each of them opens the island, so a row repeats.
    The openers of a position, usually one, travel as an array through the scan: nothing is joined by island.
    """
    opener = F.when(F.col(flag) == 1, F.struct(*[F.col(v) for v in values]))
    if o.tied():
        gathered = F.collect_list(opener)
        partials = {"__edge": F.when(F.size(gathered) > 0, gathered)}
        last = F.last("__edge", ignorenulls=True).over(_through(o))
        opened = _with_carry(o.slotted(df), o, partials, {"__open": last})
    else:
        spot = F.struct(*[F.col(k) for k in o.keys], *[F.col(c) for c in o.order])
        spots = df.filter(F.col(flag) == 1).groupBy(spot.alias("__spot")).agg(F.collect_list(opener).alias("__own"))
        rows = df.withColumn("__spot", spot).join(spots, "__spot", "left")
        opened = last_known(rows, o, {"__open": F.col("__own")}, known=F.col("__own").isNotNull())
    kept = [c for c in df.columns if c not in values]
    exploded = opened.select(*kept, F.explode("__open").alias("__opener"))
    return exploded.select(*kept, *[F.col(f"__opener.{v}").alias(v) for v in values])


def at_extreme(df: DataFrame, keys: Sequence[str], order: Sequence[str], latest: bool = True) -> DataFrame:
    """All rows that rank first per key, ties included, without a window.

    ``rank() = 1`` holds exactly where the sort columns equal the extreme of the key. The extreme comes
    from one aggregation, and the join back hashes on key *and* sort columns, so a hot key stays spread.
    """
    position = F.struct(*[F.col(c) for c in order])
    pick = F.max if latest else F.min
    best = df.groupBy(*keys).agg(pick(position).alias("__best"))
    best = best.select(F.struct(*[F.col(k) for k in keys], F.col("__best")).alias("__spot"))
    spotted = df.withColumn("__spot", F.struct(*[F.col(k) for k in keys], position.alias("__best")))
    return spotted.join(best, "__spot", "left_semi").select(*df.columns)


def latest_values(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per key holding ``values`` of its last row; the values themselves break ties."""
    row = F.struct(*[F.col(c) for c in dict.fromkeys([*order, *values])])
    best = df.groupBy(*keys).agg(F.max(row).alias("__row"))
    return best.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in values])
