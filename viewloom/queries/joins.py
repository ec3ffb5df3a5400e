"""Joins (ids J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from viewloom.operators import lineage, nodes, relational as rel, temporal
from viewloom.queries.base import Tables, query
from viewloom.specs import JoinInput, NodeOptions


def _sides(t: Tables):
    # customers 0..n and orders of a shifted key, so that both sides have rows without partner
    left = JoinInput(t.customer, {"cust": "c_custkey", "segment": "c_mktsegment"}, ("c_custkey", "c_nationkey"))
    orders = t.orders.withColumn("half", F.col("o_custkey") * 2).withColumn("nation", (F.col("o_orderkey") % 25).cast("int"))
    right = JoinInput(orders, {"order_key": "o_orderkey", "status": "o_orderstatus"}, ("half", "nation"))
    return left, right


_JOIN = """select c_custkey as cust, c_mktsegment as segment, o_orderkey as order_key, o_orderstatus as status
from customer {kind} join orders on c_custkey = o_custkey * 2 and c_nationkey = o_orderkey % 25"""


@query("J01_inner_join_node", _JOIN.replace("{kind}", "inner"))
def _(t: Tables):
    return nodes.join(*_sides(t), "inner")


@query("J02_left_join_node", _JOIN.replace("{kind}", "left"))
def _(t: Tables):
    return nodes.join(*_sides(t), "leftOuter")


@query("J03_right_join_node", _JOIN.replace("{kind}", "right"))
def _(t: Tables):
    return nodes.join(*_sides(t), "rightOuter")


@query("J04_referential_join_node", _JOIN.replace("{kind}", "inner"))
def _(t: Tables):
    return nodes.join(*_sides(t), "referential")


@query(
    "J05_aggregating_join",
    """select c_mktsegment as segment, o_orderpriority as priority, cast(sum(cast(o_totalprice as decimal(17,2))) as double) as total,
       max(c_acctbal) as balance from customer join orders on c_custkey = o_custkey group by 1, 2""",
)
def _(t: Tables):
    priced = t.orders.withColumn("price", F.col("o_totalprice").cast("decimal(17,2)"))
    node = nodes.join(
        JoinInput(t.customer, {"segment": "c_mktsegment", "balance": "c_acctbal"}, ("c_custkey",)),
        JoinInput(priced, {"priority": "o_orderpriority", "total": "price"}, ("o_custkey",)),
        "inner",
        NodeOptions(aggs={"total": "SUM", "balance": "MAX"}),
    )
    return node.withColumn("total", F.col("total").cast("double"))


@query(
    "J06_full_outer_coalesce",
    """select coalesce(c_nationkey, s_nationkey) as nation, coalesce(c.k, s.k) as k, c_name, s_name
       from (select *, c_custkey as k from customer) c
       full join (select *, s_suppkey * 3 as k from supplier) s on c.k = s.k and c_nationkey = s_nationkey""",
)
def _(t: Tables):
    c = t.customer.withColumn("k", F.col("c_custkey")).alias("c")
    s = t.supplier.withColumn("k", F.col("s_suppkey") * 3).alias("s")
    same = (F.col("c.k") == F.col("s.k")) & (F.col("c_nationkey") == F.col("s_nationkey"))
    return c.join(s, same, "full_outer").select(
        F.coalesce("c_nationkey", "s_nationkey").alias("nation"), F.coalesce("c.k", "s.k").alias("k"), "c_name", "s_name"
    )


@query("J07_upper_name_join", "select p_partkey, p_name from part where p_name in (select distinct p_name from part where p_size = 7)")
def _(t: Tables):
    scope = t.part.filter(F.col("p_size") == 7).select(F.upper("p_name").alias("scope_name")).distinct()
    named = t.part.withColumn("scope_name", F.upper("p_name"))
    return named.join(scope, "scope_name", "inner").select("p_partkey", "p_name")


@query(
    "J08_key_count",
    """select o_orderkey, key, case when key is not null then count(*) over (partition by key) end as cnt
       from (select o_orderkey, nullif(o_custkey, 7) as key from orders)""",
)
def _(t: Tables):
    rows = t.orders.select("o_orderkey", F.nullif("o_custkey", F.lit(7)).alias("key"))
    return rel.with_key_count(rows, "key")


def _edges(df, target: str, target_key: str, source: str, source_key: str):
    """Foreign keys as lineage edges; the two kinds of rows play two columns."""
    node = lambda kind, key: F.concat(F.lit(kind), F.col(key).cast("string"))
    return df.select(
        node(target, target_key).alias("target_table_name"), F.lit("c").alias("target_column_name"),
        node(source, source_key).alias("source_table_name"), F.lit("c").alias("source_column_name"),
        F.lit("copy").alias("transformation"),
    )


@query(
    "J09_next_hop",
    """select 'c' || c_custkey as target, 'n' || c_nationkey as source from customer
       where c_custkey in (select o_custkey from orders)""",
)
def _(t: Tables):
    cur, nxt = _edges(t.orders, "o", "o_orderkey", "c", "o_custkey"), _edges(t.customer, "c", "c_custkey", "n", "c_nationkey")
    step = lineage.next_hop(cur, nxt)
    return step.select("target_table_name", "source_table_name").toDF("target", "source")


@query(
    "J10_hops_side_by_side",
    """select 'o' || o_orderkey as target_table_name, 'c' || o_custkey as source_table_name,
       'c' || c_custkey as target_table_name2, 'n' || c_nationkey as source_table_name2
       from orders left join customer on o_custkey = c_custkey""",
)
def _(t: Tables):
    cur, nxt = _edges(t.orders, "o", "o_orderkey", "c", "o_custkey"), _edges(t.customer, "c", "c_custkey", "n", "c_nationkey")
    wide = lineage.hops_side_by_side([cur, nxt])
    return wide.select("target_table_name", "source_table_name", "target_table_name2", "source_table_name2")


@query(
    "J11_year_spine",
    """select policy, coverage, y as report_year
       from (select policy, coverage, min(mutation_year) as start_year from {log} l group by 1, 2)
       join (select unnest(range(1990, 2001)) as y) on y >= start_year""",
)
def _(t: Tables):
    starts = t.log.groupBy("policy", "coverage").agg(F.min("mutation_year").alias("start_year"))
    return temporal.year_spine(starts, "start_year", 2000, "report_year")


@query(
    "J12_latest_before",
    """with a as (select * from {log} l where correction = '' and coverage = '007'),
       b as (select * from {log} l where correction = 'X' and kind = '508_ONLY'),
       pairs as (select a.policy, a.mutation_id, rank() over (partition by a.policy order by a.processed_on desc, a.seq desc) as r
                 from a join b on a.policy = b.policy and a.processed_on <= b.processed_on and a.amount <= b.amount)
       select distinct policy, mutation_id from pairs where r = 1""",
)
def _(t: Tables):
    log = t.log
    normal = log.filter((F.col("correction") == "") & (F.col("coverage") == "007"))
    ends = log.filter((F.col("correction") == "X") & (F.col("kind") == "508_ONLY"))
    found = temporal.latest_before(normal, ends, ["policy"], ["processed_on", "seq"], "amount", "processed_on", "amount")
    return found.select("policy", "mutation_id")


@query(
    "J13_valid_at",
    """with p as (select ZMUTID, ZBSN1 as BSN, 'EoY Snapshot' as SNAPSHOT_TYPE, ZMUTJAAR + case when MWYZVLGNR % 13 = 0 then 25 else 0 end as report_year from {mutations} m)
       select ZMUTID, p.BSN, p.report_year, POSTCODE, BUITENLAND from p left join {addresses} a
       on p.BSN = a.BSN and p.SNAPSHOT_TYPE = a.SNAPSHOT_TYPE and report_year >= ADDR_VALID_FROM and report_year < ADDR_VALID_TO""",
)
def _(t: Tables):
    people = t.mutations.select(
        "ZMUTID", F.col("ZBSN1").alias("BSN"), F.lit("EoY Snapshot").alias("SNAPSHOT_TYPE"), 
        (F.col("ZMUTJAAR") + F.when(F.col("MWYZVLGNR") % 13 == 0, 25).otherwise(0)).alias("report_year"),
    )
    found = temporal.valid_at(
        people, t.addresses, ["BSN", "SNAPSHOT_TYPE"], "report_year", "ADDR_VALID_FROM", "ADDR_VALID_TO",
        ["POSTCODE", "BUITENLAND"],
    )
    return found.drop("SNAPSHOT_TYPE")


_ENDS = "(select * from {log} l where kind = '508_ONLY' and event = 'E001')"


@query(
    "J14_until_event",
    f"""select mutation_id, policy, coverage from {{log}} a where exists (select 1 from {_ENDS} b
        where a.policy = b.policy and a.coverage = b.coverage and a.processed_on <= b.processed_on)""",
)
def _(t: Tables):
    log = t.log
    ends = log.filter((F.col("kind") == "508_ONLY") & (F.col("event") == "E001"))
    kept = temporal.until_event(log, ends, ["policy", "coverage"], "processed_on")
    return kept.select("mutation_id", "policy", "coverage")


@query(
    "J15_without_event",
    f"""select mutation_id, policy, coverage from {{log}} a where not exists (select 1 from {_ENDS} b
        where a.policy = b.policy and a.coverage = b.coverage)""",
)
def _(t: Tables):
    log = t.log
    ends = log.filter((F.col("kind") == "508_ONLY") & (F.col("event") == "E001"))
    return temporal.without_event(log, ends, ["policy", "coverage"]).select("mutation_id", "policy", "coverage")


@query(
    "J16_missing_in",
    """select a.policy, a.processed_on from {log} a left join (select * from {log} l where event = 'E001') b on a.policy = b.policy
       where a.correction = 'X' group by a.policy, a.processed_on, b.policy having b.policy is null""",
)
def _(t: Tables):
    log = t.log
    wanted = log.filter(F.col("correction") == "X").select("policy", "processed_on").distinct()
    return temporal.without_event(wanted, log.filter(F.col("event") == "E001"), ["policy"])


@query("J17_lookup", "select c_custkey, n_name, r_name from customer left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey")
def _(t: Tables):
    places = rel.lookup(t.nation, t.region.withColumnRenamed("r_regionkey", "n_regionkey"), ["n_regionkey"])
    dim = places.select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")
    return rel.lookup(t.customer, dim, ["c_nationkey"]).select("c_custkey", "n_name", "r_name")


@query("J18_latest_load", "select l_orderkey, l_linenumber from lineitem where l_shipdate = (select max(l_shipdate) from lineitem)")
def _(t: Tables):
    return rel.latest_load(t.lineitem, "l_shipdate").select("l_orderkey", "l_linenumber")


@query(
    "J19_conditional_key_join",
    """select b.RELNR, b.VOLGNR, b.GRPNR, r.RELNR_DEPOT from {depot_base} b join {depot_relations} r
       on b.RELNR = r.RELNR and (r.GRPNR = '' or r.GRPNR = b.GRPNR)""",
)
def _(t: Tables):
    base = t.depot_base.select("RELNR", "VOLGNR", "GRPNR")
    return rel.conditional_key_join(base, t.depot_relations, "RELNR", "GRPNR", ["RELNR_DEPOT"])


@query(
    "J20_distinct_key_restriction",
    "select a.* from {addresses} a join (select distinct ZBSN1 from {mutations} m) k on a.BSN = k.ZBSN1",
)
def _(t: Tables):
    return rel.in_keys(t.addresses, "BSN", t.mutations.select("ZBSN1").distinct())
