"""Window functions and top-k over the mutation log (ids W)."""

from __future__ import annotations

from pyspark.sql import functions as F

from viewloom.operators import nodes, scans
from viewloom.operators.scans import Ordering
from viewloom.plans import mortality
from viewloom.queries.base import Tables, query

SORT = ("processed_on", "seq")


def _dated():
    """A chunk is a date, and for dates with very many changes a range of them."""
    return F.struct(F.col("processed_on"), F.floor(F.col("seq") / 100_000))


@query(
    "W01_next_pointer",
    """select mutation_id, policy, coverage, correction,
       lead(mutation_id) over (partition by policy, coverage, correction order by processed_on, seq) as next_id from {log} l""",
)
def _(t: Tables):
    found = scans.next_value(t.log, Ordering(("policy", "coverage", "correction"), SORT, chunk=_dated()), "mutation_id", "next_id")
    return found.select("mutation_id", "policy", "coverage", "correction", "next_id")


@query(
    "W02_previous_state",
    """with p as (select *, lead(mutation_id) over (partition by policy, coverage, correction order by processed_on, seq) as nxt from {log} l)
       select a.mutation_id, a.kind, p.kind as kind_before, cast(p.amount as double) as amount_before
       from {log} a left join p on a.mutation_id = p.nxt and a.coverage = p.coverage""",
)
def _(t: Tables):
    log = t.log
    chained = scans.next_value(log, Ordering(("policy", "coverage", "correction"), SORT, chunk=_dated()), "mutation_id", "nxt")
    before = chained.select(
        F.col("nxt").alias("mutation_id"), "coverage", F.col("kind").alias("kind_before"),
        F.col("amount").cast("double").alias("amount_before"),
    )
    joined = log.join(before, ["mutation_id", "coverage"], "left")
    return joined.select("mutation_id", "kind", "kind_before", "amount_before")


@query(
    "W03_rank_ties_kept",
    "select mutation_id, policy, rank() over (partition by policy order by mutation_year desc) as r from {log} l",
)
def _(t: Tables):
    found = scans.ranked(t.log, Ordering(("policy",), ("mutation_year",), descending=True), "r")
    return found.select("mutation_id", "policy", "r")


@query(
    "W04_rank_node",
    """select mutation_id, policy, 'second' as pick, r from (select *, rank() over (partition by policy order by processed_on desc) as r
       from {log} l) where r = 2 union all
       select mutation_id, policy, 'top3', r from (select *, rank() over (partition by policy order by processed_on) as r
       from {log} l2) where r <= 3""",
)
def _(t: Tables):
    second = nodes.rank_node(t.log, ["policy"], ["processed_on"], 2, out="r")
    top3 = nodes.rank_node(t.log, ["policy"], ["processed_on"], 3, descending=False, mode="le", out="r")
    return second.select("mutation_id", "policy", F.lit("second").alias("pick"), "r").union(
        top3.select("mutation_id", "policy", F.lit("top3"), "r")
    )


@query(
    "W05_rank_one_distinct",
    """select distinct policy, coverage, kind from (select *, rank() over (partition by policy order by processed_on desc) as r
       from {log} l) where r = 1""",
)
def _(t: Tables):
    return scans.at_extreme(t.log, ["policy"], ["processed_on"]).select("policy", "coverage", "kind").distinct()


@query(
    "W06_running_min",
    """select mutation_id, min(mutation_year) over w as settled_year, min(begin_year) over w as settled_begin from {log} l
       window w as (partition by policy, coverage order by amount desc, seq desc rows unbounded preceding)""",
)
def _(t: Tables):
    # amounts are nearly unique, so the chunk is a coarse step of them
    order = Ordering(("policy", "coverage"), ("amount", "seq"), descending=True, chunk=F.floor(F.col("amount") / 10000))
    found = scans.running(t.log, order, {"settled_year": (F.min, "mutation_year"), "settled_begin": (F.min, "begin_year")})
    return found.select("mutation_id", "settled_year", "settled_begin")


@query(
    "W07_first_value_per_year",
    """select distinct policy, coverage, mutation_year, first_value(kind) over w as kind, first_value(event) over w as event,
       first_value(processed_on) over w as processed_on from {log} l
       window w as (partition by policy, coverage, mutation_year order by processed_on desc, seq desc)""",
)
def _(t: Tables):
    keys = ["policy", "coverage", "mutation_year"]
    found = scans.latest_values(t.log, keys, SORT, ["kind", "event", "processed_on"])
    return found.select(*keys, "kind", "event", "processed_on")


_FLAGGED = "(select *, case when salary is not null then 1 end as flag from {log} l)"


@query(
    "W08_island_id",
    f"select mutation_id, count(flag) over (partition by policy order by mutation_year) as island from {_FLAGGED}",
)
def _(t: Tables):
    rows = t.log.withColumn("flag", F.when(F.col("salary").isNotNull(), 1))
    return scans.running_count(rows, Ordering(("policy",), ("mutation_year",)), "flag", "island").select("mutation_id", "island")


@query(
    "W09_fill_forward",
    f"""with k as (select *, count(flag) over (partition by policy order by processed_on) as island from {_FLAGGED})
       select a.mutation_id, b.kind, b.event from k a join k b on a.policy = b.policy and a.island = b.island where b.flag = 1""",
)
def _(t: Tables):
    rows = t.log.withColumn("flag", F.when(F.col("salary").isNotNull(), 1))
    found = scans.island_fill(rows, Ordering(("policy",), ("processed_on",)), "flag", ["kind", "event"])
    return found.select("mutation_id", "kind", "event")


_FEED = """
  select distinct ZPDEELID as policy, ZVERW_DAT as p, MWYZVLGNR as c, ZMUTDATE as m, 'First' as role, 'Death' as purpose,
         '' as birth, '' as gender, '' as bsn, ZSTEDAT as death, ZEVENTID as event from src where ZEVENTID in ('E001', 'R001')
  union all
  select distinct ZPDEELID, ZVERW_DAT, MWYZVLGNR, ZMUTDATE, 'First', 'GBB', case when ZGEBDAT = '00000000' then '' else ZGEBDAT end,
         ZGESL, ZBSN1, '', '' from src
  union all
  select distinct ZPDEELID, ZVERW_DAT, MWYZVLGNR, ZMUTDATE, 'Second', 'Death', '', '', '', ZVZSTEDAT, ZEVENTID
         from src where ZEVENTID in ('E002', 'R002') and ZAANSTYP in ('008', '015')
  union all
  select distinct ZPDEELID, ZVERW_DAT, MWYZVLGNR, ZMUTDATE, 'Second', 'GBB', ZVZGEBDAT, ZVZGESL, ZVZBSN, '', ''
         from src where ZVZGEBDAT <> '00000000'"""
_LATEST = """
  select policy, role, purpose, birth, gender, bsn, death, event from feed
  where purpose <> 'GBB' or birth <> '' or gender <> '' or bsn <> ''
  qualify row_number() over (partition by policy, role, purpose
    order by p desc, c desc, m desc, birth desc, gender desc, bsn desc, death desc, event desc) = 1"""

PARAMS = mortality.SnapshotParams("99991231", 2001)


@query("W10_latest_person", "with src as (select * from {mutations} m), feed as (" + _FEED + ")" + _LATEST)
def _(t: Tables):
    return mortality.latest_person(mortality.person_feed(mortality.base_mutations(t.mutations, PARAMS, repeats=True)))


@query(
    "W11_fill_gaps",
    """select mutation_id, cast(last_value(salary ignore nulls) over w as double) as salary,
       last_value(case when salary is not null then processed_on end ignore nulls) over w as salary_date from {log} l
       window w as (partition by policy order by processed_on, seq rows unbounded preceding)""",
)
def _(t: Tables):
    known = F.col("salary").isNotNull()
    found = scans.last_known(
        t.log, Ordering(("policy",), SORT, chunk=_dated()), {"salary": F.col("salary"), "salary_date": F.col("processed_on")}, known
    )
    return found.select("mutation_id", F.col("salary").cast("double").alias("salary"), "salary_date")


_SEGMENTS = """
  select policy, p, c, m, sum(opens) over (partition by policy order by p, c, m rows unbounded preceding) as segment
  from (select *, case when lag(state) over w = '508_ONLY' and state <> '508_ONLY' and birth <> lag(birth) over w then 1 else 0 end as opens
        from (select ZPDEELID as policy, ZVERW_DAT as p, MWYZVLGNR as c, ZMUTDATE as m, max(ZTYPE) as state,
                     max(case when ZGEBDAT = '00000000' then '' else ZGEBDAT end) as birth
              from src where ZPRVMUTID = '' group by 1, 2, 3, 4)
        window w as (partition by policy order by p, c, m))"""


@query(
    "W12_segment_reuse",
    "with src as (select * from {mutations} m), seg as (" + _SEGMENTS + ") "
    "select policy, p as processed_on, c as change_no, m as mutated_on, policy || '_' || segment as reused_id from seg where segment > 0",
)
def _(t: Tables):
    return mortality.segment_reuse(mortality.base_mutations(t.mutations, PARAMS))


def probe(df, n: int = 10):
    """How many of the first ``n`` rows there are: tells an empty table without reading all of it."""
    return df.limit(n).agg(F.count(F.lit(1)).alias("n_probed"), (F.count(F.lit(1)) == 0).alias("is_empty"))


@query(
    "W13_probe",
    "select least(count(*), 10) as n_probed, count(*) = 0 as is_empty from orders union all "
    "select least(count(*), 10), count(*) = 0 from orders where o_totalprice < 0",
)
def _(t: Tables):
    return probe(t.orders).union(probe(t.orders.filter(F.col("o_totalprice") < 0)))


@query("W14_sort", "select policy, coverage, processed_on, mutation_id from {log} l order by policy, coverage, processed_on, mutation_id")
def _(t: Tables):
    columns = ["policy", "coverage", "processed_on", "mutation_id"]
    return t.log.select(*columns).orderBy(*columns)
