"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewloom.llm.common import WORD_PATTERN
from viewloom.session import materialize

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Share of all sizes that the mix takes, and the most copies of a document.
SHARE, MOST = 1.5, 2
#: Steps per doubling of the rank in the first search for the cut, and parts of a step in the second.
STEPS, PARTS = 64, 4096


def _uniform(doc_id: Column, text: Column) -> Column:
    """A number in (0, 1) that depends on the id and the text only: 52 bits of an MD5."""
    seed = F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return (F.conv(F.substring(F.md5(seed.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def _targets(sources: DataFrame, weights: tuple, share: float, most: int) -> DataFrame:
    """(source, source_size, target): shares by weight, none above ``most`` times the source.

    In the order of limit by weight, the sources that stop at their limit come first; the level of the others follows from what is left.
    One row per source.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*map(F.lit, weights)), F.pmod(place, F.lit(len(weights)))).cast("double")
    ranked = sources.withColumn("weight", weight).withColumn("limit", (F.col("source_size") * most).cast("double"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = F.coalesce(F.sum("limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    left = F.sum("source_size").over(everything) * share
    stepped = ranked.withColumn("left", left - before).withColumn("open_weight", open_weight)
    full = F.col("limit") * F.col("open_weight") <= F.col("weight") * F.col("left")
    level = F.max(F.when(~full, F.col("left") / F.col("open_weight"))).over(everything)
    return stepped.withColumn("full", full).withColumn("level", level).select(
        "source", "source_size", F.when(F.col("full"), F.col("limit")).otherwise(F.col("weight") * F.col("level")).alias("target")
    )


def _odds(plan: DataFrame, sizes: DataFrame) -> DataFrame:
    """Adds the factor of the inclusion probability: min(1, factor * size), whose expected words are what is left of the target."""
    per_size = sizes.groupBy("source", "size").agg(F.count(F.lit(1)).cast("decimal(20,0)").alias("n")).where("size > 0")
    per_size = per_size.join(plan.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s")))
    size = F.col("size").cast("decimal(9,0)")
    down = Window.partitionBy("source").orderBy(F.col("size").desc())
    larger = F.coalesce(F.sum(F.col("n") * size).over(down.rowsBetween(Window.unboundedPreceding, -1)).cast("double"), F.lit(0.0))
    squares = F.sum(F.col("n") * size * size).over(down.rowsBetween(0, Window.unboundedFollowing)).cast("double")
    stepped = per_size.withColumn("left", F.col("rest") - larger).withColumn("squares", squares)
    certain = F.col("left") * F.col("size") >= F.col("squares")
    factor = stepped.groupBy("source").agg(F.max(F.when(~certain, F.col("left") / F.col("squares"))).alias("factor"))
    factor = factor.select(F.col("source").alias("s"), "factor")
    return plan.join(factor, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")


def _ranked(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds the plan of the source and the Pareto rank: random odds by inclusion odds. Rows without a word have none."""
    keyed = rows.join(plan.withColumnRenamed("source", "__s"), F.col("__source").eqNullSafe(F.col("__s")), "left").drop("__s")
    chance = F.least(F.lit(1.0), F.col("factor") * F.col("__size"))
    rank = (F.col("__u") / (1 - F.col("__u"))) * ((1 - F.col("__p")) / F.col("__p"))
    return keyed.withColumn("__p", F.coalesce(chance, F.lit(1.0))).withColumn("__q", F.when((F.col("rest") > 0) & (F.col("__p") > 0), rank))


def _cut(ranked: DataFrame) -> DataFrame:
    """(source, cut): the largest rank whose words, with all smaller ranks, come nearest to what is left of the target.

    Prefix sums over a source are taken on steps of the rank, then on parts of the step that holds the cut, then on the ranks of
    that part, so that a hot source is summed by all tasks.
    """
    log = F.when(F.col("__q") > 0, F.log2("__q") * STEPS).otherwise(F.lit(-1e6))
    rows = ranked.where("__q is not null").select(F.col("__source").alias("source"), F.col("__size").alias("size"), F.col("__q").alias("q"), "rest", log.alias("log"))
    rows = rows.withColumn("step", F.floor("log")).withColumn("part", F.floor((F.col("log") - F.col("step")) * PARTS))

    def crossing(summed: DataFrame, by: str, start: Column) -> DataFrame:
        """The first group of a source after which the words pass what is left, and the words before it."""
        up = Window.partitionBy("source").orderBy(by)
        through = start + F.sum("words").over(up.rowsBetween(Window.unboundedPreceding, 0))
        passed = summed.withColumn("through", through).where("through > rest")
        return passed.groupBy("source").agg(F.min(F.struct(by, F.col("through") - F.col("words"), "rest")).alias("at"))

    steps = rows.groupBy("source", "rest", "step").agg(F.sum("size").alias("words"))
    first = crossing(steps, "step", F.lit(0)).select(F.col("source").alias("s"), F.col("at.step").alias("step1"), F.col("at.col2").alias("words1"))
    inside = rows.join(first, F.col("source").eqNullSafe(F.col("s")) & (F.col("step") == F.col("step1"))).drop("s", "step1")
    parts = inside.groupBy("source", "rest", "words1", "part").agg(F.sum("size").alias("words"))
    second = crossing(parts, "part", F.col("words1")).select(F.col("source").alias("s"), F.col("at.part").alias("part2"), F.col("at.col2").alias("words2"))
    last = inside.join(second, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("part2"))).drop("s")
    blocks = last.groupBy("source", "rest", "words2", "q").agg(F.sum("size").alias("words"))
    up = Window.partitionBy("source").orderBy("q")
    through = F.col("words2") + F.sum("words").over(up.rowsBetween(Window.unboundedPreceding, 0))
    over = blocks.withColumn("through", through).where(2 * F.col("through") - F.col("words") > 2 * F.col("rest"))
    # the least rank that is left out; without one, everything below the step's end is in
    out = over.groupBy("source").agg(F.min("q").alias("out"))
    ends = last.groupBy("source").agg(F.max("q").alias("top"))
    return ends.join(out.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").select("source", "out", "top")


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """``docs`` with the columns size, source_size, target (of its source), copies and taken (copies times size).

    Sizes are words. Sources in code point order, null last, share ``share`` of all sizes by the repeating weights; a target stops at
    ``most`` times its source and the excess goes to the others. Each document gets the whole number of copies in target / source size
    for certain. For what is left of the target, the inclusion probability is proportional to size, at most 1, and documents
    are taken in the order of random odds by inclusion odds up to the prefix whose words come nearest. The random number comes
    from id and text, so reruns agree, and repeated rows rank alike and are taken together.

    Null text and text without a word have size 0 and are taken 0 times beyond the certain copies. A null key ranks like an empty one.
    Columns of ``docs`` with the name of a new one are replaced. An empty table gives an empty result.
    """
    new = ("size", "source_size", "target", "copies", "taken")
    size = F.regexp_count(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(WORD_PATTERN)).cast("long")
    rows = docs.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in new], F.col(f"`{source}`").alias("__source"), size.alias("__size"), _uniform(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("__u")
    )
    ranks = materialize(rows.select("__source", "__size", "__u"), "sizes")
    sizes = ranks.select(F.col("__source").alias("source"), F.col("__size").alias("size"))
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = _targets(sources, weights, share, most)
    ratio = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = materialize(plan.withColumn("whole", ratio).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "targets")
    plan = materialize(_odds(plan, sizes), "odds")
    cut = _cut(_ranked(ranks, plan)).withColumnRenamed("source", "s")
    plan = materialize(plan.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").drop("s"), "cuts")
    # no step crosses what is left: every ranked row is in
    drawn = F.when(F.col("__q").isNull(), False).when(F.col("top").isNull(), True).when(F.col("out").isNotNull(), F.col("__q") < F.col("out")).otherwise(F.col("__q") <= F.col("top"))
    copies = (F.coalesce("whole", F.lit(0)) + drawn.cast("int")).cast("long")
    done = _ranked(rows, plan).withColumn("copies", copies)
    return done.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in new],
        F.col("__size").alias("size"), "source_size", "target", "copies", (F.col("copies") * F.col("__size")).alias("taken"),
    )


def oracle(documents: str = "documents") -> str:
    """The same mix in DuckDB: (doc_id, size, source_size, target, taken)."""
    weights = "[" + ", ".join(map(str, WEIGHTS)) + "]"
    return rf"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))), 1, 13))::bigint::double + 0.5) / 4503599627370496.0 as u
  from {documents}),
sources as (
  select source, sum(size)::bigint as source_size, ({weights})[((row_number() over (order by source asc nulls last) - 1) % {len(WEIGHTS)} + 1)::int]::double as weight
  from sized group by source),
stepped as (
  select *, (source_size * {MOST})::double as lim,
         (sum(source_size) over ())::double * {SHARE} - coalesce(sum((source_size * {MOST})::double) over (o rows between unbounded preceding and 1 preceding), 0) as rem,
         sum(weight) over (o rows between current row and unbounded following) as open_weight
  from sources window o as (order by (source_size * {MOST})::double / weight, source asc nulls last)),
levels as (select *, lim * open_weight <= weight * rem as is_full, max(case when not lim * open_weight <= weight * rem then rem / open_weight end) over () as lvl from stepped),
targets as (select source, source_size, case when is_full then lim else weight * lvl end as target from levels),
plan as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as whole from targets),
rest as (select *, target - (whole * source_size)::double as rest from plan),
per_size as (select source, size, count(*)::hugeint as n from sized where size > 0 group by all),
squared as (
  select p.source, size, r.rest - coalesce(sum(n * size) over (d rows between unbounded preceding and 1 preceding), 0)::double as rem,
         (sum(n * size * size) over (d rows between current row and unbounded following))::double as squares
  from per_size p join rest r on p.source is not distinct from r.source
  window d as (partition by p.source order by size desc)),
factors as (select source, max(case when not rem * size >= squares then rem / squares end) as factor from squared group by source),
ranked as (
  select s.doc_id, s.source, s.size, s.u, r.source_size, r.target, r.whole, r.rest, coalesce(least(1.0::double, f.factor * s.size), 1.0) as p
  from sized s join rest r on s.source is not distinct from r.source left join factors f on s.source is not distinct from f.source),
odds as (select *, case when rest > 0 and p > 0 then (u / (1 - u)) * ((1 - p) / p) end as q from ranked),
blocks as (select source, q, sum(size) as words from odds where q is not null group by all),
cuts as (select source, q, 2 * sum(words) over (partition by source order by q) - words as twice from blocks)
select o.doc_id, o.size, o.source_size, o.target,
       (o.whole + case when o.q is not null and c.twice <= 2 * o.rest then 1 else 0 end) * o.size as taken
from odds o left join cuts c on o.source is not distinct from c.source and o.q = c.q"""
