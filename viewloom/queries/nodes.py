"""Projection, predicates, aggregation, set operations and upsert (ids P, A, U, M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from viewloom.functions import scalar as fn
from viewloom.operators import nodes, relational as rel
from viewloom.operators.upsert import BUCKET, merge_table, save_by_key, upsert
from viewloom.session import materialize
from viewloom.queries.base import Tables, query
from viewloom.specs import NodeOptions, UnionInput

MONEY = "decimal(17,2)"


def money(c) -> F.Column:
    return F.col(c).cast(MONEY)


def d8(c: str) -> F.Column:
    return F.date_format(c, "yyyyMMdd")


# --- P: projection, predicates, dedupe --------------------------------------------------------


@query("P01_projection_node", "select o_orderkey as order_id, o_custkey as policy, o_orderstatus from orders")
def _(t: Tables):
    return nodes.project(
        t.orders, {"order_id": "o_orderkey", "policy": "o_custkey", "o_orderstatus": "o_orderstatus"}
    )


@query(
    "P02_calculated_columns",
    "select l_orderkey as k, l_linenumber as n, l_quantity * 2 as twice, l_returnflag || '/' || l_linestatus as flags "
    "from lineitem",
)
def _(t: Tables):
    mapping = {"k": "l_orderkey", "n": "l_linenumber", "q": "l_quantity", "r": "l_returnflag", "s": "l_linestatus"}
    calc = {"twice": F.col("q") * 2, "flags": fn.cat("r", F.lit("/"), "s")}
    return nodes.project(t.lineitem, mapping, NodeOptions(calc=calc)).select("k", "n", "twice", "flags")


@query(
    "P03_typed_columns",
    """select o_orderkey as k,
       case when o_orderkey % 10 = 0 then null else strftime(cast(o_orderdate as date), '%Y-%m-%d') end as as_date,
       strftime(o_orderdate + interval 37230 second, '%Y-%m-%d %H:%M:%S') as as_timestamp from orders""",
)
def _(t: Tables):
    text = F.when(F.col("o_orderkey") % 10 == 0, "00000000").otherwise(d8("o_orderdate"))
    rows = t.orders.select(F.col("o_orderkey").alias("k"), text.alias("d"), d8("o_orderdate").alias("day"))
    return rows.select(
        "k",
        fn.typed("d", "DATE").cast("string").alias("as_date"),
        F.date_format(fn.typed(fn.cat("day", F.lit("102030")), "TIMESTAMP"), "yyyy-MM-dd HH:mm:ss").alias("as_timestamp"),
    )


@query("P04_node_filter", "select o_orderkey, o_totalprice from orders where o_totalprice > 100000 and o_orderstatus <> 'F'")
def _(t: Tables):
    keep = (F.col("o_totalprice") > 100000) & (F.col("o_orderstatus") != "F")
    return nodes.project(
        t.orders, {"o_orderkey": "o_orderkey", "o_totalprice": "o_totalprice"}, NodeOptions(where=keep)
    )


@query(
    "P05_value_filter",
    "select o_orderkey from orders where o_orderstatus = 'P' and o_orderpriority = '5-LOW'",
)
def _(t: Tables):
    return nodes.value_filter(t.orders, {"o_orderstatus": "P", "o_orderpriority": "5-LOW"}).select("o_orderkey")


@query(
    "P06_list_filter",
    "select o_orderkey from orders where o_orderstatus in ('P', 'F') and o_orderpriority = '1-URGENT'",
)
def _(t: Tables):
    return nodes.value_filter(t.orders, {"o_orderstatus": ["P", "F"], "o_orderpriority": "1-URGENT"}).select("o_orderkey")


@query("P07_not_in_filter", "select l_orderkey, l_linenumber from lineitem where l_linenumber not in (1, 3, 5)")
def _(t: Tables):
    return t.lineitem.filter(fn.not_in("l_linenumber", 1, 3, 5)).select("l_orderkey", "l_linenumber")


def until(orders, reference_date: str):
    """Rows up to a date parameter, which also becomes a column."""
    rows = orders.filter(d8("o_orderdate") <= reference_date)
    return rows.select("o_orderkey", F.lit(reference_date).alias("reference_date"))


@query(
    "P08_parameters",
    "select o_orderkey, '19980630' as reference_date from orders where strftime(o_orderdate, '%Y%m%d') <= '19980630'",
)
def _(t: Tables):
    return until(t.orders, "19980630")


@query(
    "P09_in_keys",
    "select o_orderkey from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING')",
)
def _(t: Tables):
    keys = t.customer.filter(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return rel.in_keys(t.orders, "o_custkey", keys).select("o_orderkey")


@query("P10_prefix_filter", "select p_partkey from part where p_brand <> '' and not starts_with(p_brand, 'Brand#1')")
def _(t: Tables):
    brand = F.col("p_brand")
    return t.part.filter((brand != "") & ~brand.startswith("Brand#1")).select("p_partkey")


@query(
    "P11_scope_keys",
    "select upper(nullif(p_name, 'red bolt')) as name from part where nullif(p_name, 'red bolt') is not null",
)
def _(t: Tables):
    names = t.part.select(F.nullif("p_name", F.lit("red bolt")).alias("name"))
    return names.filter(F.col("name").isNotNull()).select(F.upper("name").alias("name"))


@query("P12_distinct", "select distinct l_partkey, l_returnflag from lineitem")
def _(t: Tables):
    return t.lineitem.select("l_partkey", "l_returnflag").distinct()


@query("P13_drop_duplicates", "select distinct o_custkey, o_orderpriority, o_orderstatus from orders")
def _(t: Tables):
    keys = ["o_custkey", "o_orderpriority", "o_orderstatus"]
    return t.orders.select(*keys).dropDuplicates(keys)


@query(
    "P14_drop_blank_rows",
    """select * from (select p_partkey, case when p_size > 10 then p_name end as name, case when p_size < 5 then p_brand end as brand
       from part) where not (name is null and brand is null)""",
)
def _(t: Tables):
    rows = t.part.select(
        "p_partkey",
        F.when(F.col("p_size") > 10, F.col("p_name")).alias("name"),
        F.when(F.col("p_size") < 5, F.col("p_brand")).alias("brand"),
    )
    return rel.drop_blank_rows(rows, ["name", "brand"])


@query("P15_suffix_columns", "select n_nationkey as n_nationkey_new, n_name as n_name_new, n_regionkey as n_regionkey_new from nation")
def _(t: Tables):
    return rel.suffix_columns(t.nation, "_new")


def corrections(log, include: bool):
    """Correction rows of the log, or an empty frame of the same columns when they are switched off."""
    rows = log.filter(F.col("correction") == "X") if include else log.limit(0)
    return rows.select("mutation_id", "policy", F.lit(include).alias("included"))


@query(
    "P16_parameter_branch",
    "select mutation_id, policy, true as included from {log} l where correction = 'X'",
)
def _(t: Tables):
    return corrections(t.log, True).unionByName(corrections(t.log, False))


@query(
    "P17_explicit_columns",
    "select l.l_orderkey as k, l.l_linenumber as n, o.o_orderkey as order_key, o.o_orderstatus as status "
    "from lineitem l join orders o on l.l_orderkey = o.o_orderkey",
)
def _(t: Tables):
    joined = t.lineitem.alias("l").join(t.orders.alias("o"), F.col("l.l_orderkey") == F.col("o.o_orderkey"))
    columns = {"k": "l.l_orderkey", "n": "l.l_linenumber", "order_key": "o.o_orderkey", "status": "o.o_orderstatus"}
    return nodes.project(joined, columns)


# --- A: aggregation ---------------------------------------------------------------------------

_SUM_PRICE = "cast(sum(cast(o_totalprice as decimal(17,2))) as double)"


@query(
    "A01_aggregation_node",
    f"""select o_custkey as policy, o_orderstatus as status, {_SUM_PRICE} as total,
        max(o_orderdate) as newest, min(o_orderdate) as oldest, count(o_orderkey) as n
        from orders where o_totalprice > 1000 group by all""",
)
def _(t: Tables):
    rows = t.orders.withColumn("price", money("o_totalprice"))
    node = nodes.aggregate(
        rows,
        {"policy": "o_custkey", "status": "o_orderstatus", "total": "price", "newest": "o_orderdate",
         "oldest": "o_orderdate", "n": "o_orderkey"},
        NodeOptions(
            where=F.col("o_totalprice") > 1000,
            aggs={"policy": "NONE", "total": "SUM", "newest": "MAX", "oldest": "MIN", "n": "COUNT"},
        ),
    )
    return node.withColumn("total", F.col("total").cast("double"))


@query("A02_aggregation_as_distinct", "select distinct c_nationkey as nation, c_mktsegment as segment from customer")
def _(t: Tables):
    return nodes.aggregate(t.customer, {"nation": "c_nationkey", "segment": "c_mktsegment"})


@query("A03_global_aggregation", "select max(o_orderdate) as newest from orders")
def _(t: Tables):
    return nodes.aggregate(t.orders, {"newest": "o_orderdate"}, NodeOptions(aggs={"newest": "MAX"}))


@query(
    "A04_sum_per_full_key",
    """select ZMUTID, ZPDEELID, ZVVAANTP, ZTYPE, cast(sum(ZVERBDR) as double) as ZVERBDR
       from {mutations} m group by ZMUTID, ZPDEELID, ZVVAANTP, ZTYPE""",
)
def _(t: Tables):
    total = F.sum("ZVERBDR").cast("double").alias("ZVERBDR")
    return t.mutations.groupBy("ZMUTID", "ZPDEELID", "ZVVAANTP", "ZTYPE").agg(total)


@query("A05_all_ended_flag", "select policy, processed_on, max(kind) as all_ended from {log} l where correction = '' group by 1, 2")
def _(t: Tables):
    normal = t.log.filter(F.col("correction") == "")
    return normal.groupBy("policy", "processed_on").agg(F.max("kind").alias("all_ended"))


@query("A06_first_year", "select policy, coverage, min(mutation_year) as start_year from {log} l group by 1, 2")
def _(t: Tables):
    return t.log.groupBy("policy", "coverage").agg(F.min("mutation_year").alias("start_year"))


@query(
    "A07_two_level_sum",
    """select policy, cast(sum(amount) as double) as amount, count(*) as coverages
       from (select policy, coverage, sum(amount) as amount from {log} l group by 1, 2) group by 1""",
)
def _(t: Tables):
    per_coverage = t.log.groupBy("policy", "coverage").agg(F.sum("amount").alias("amount"))
    return per_coverage.groupBy("policy").agg(
        F.sum("amount").cast("double").alias("amount"), F.count(F.lit(1)).alias("coverages")
    )


@query("A08_group_as_dedupe", "select distinct l_suppkey, l_returnflag, l_linestatus from lineitem")
def _(t: Tables):
    return nodes.grouped(t.lineitem, ["l_suppkey", "l_returnflag", "l_linestatus"], {})


@query(
    "A09_count_report",
    "select count(*) as n_rows, count(distinct l_partkey) as parts, count(distinct l_suppkey) as suppliers from lineitem",
)
def _(t: Tables):
    return t.lineitem.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("l_partkey").alias("parts"),
        F.count_distinct("l_suppkey").alias("suppliers"),
    )


@query(
    "A10_group_members",
    f"""select g as group_id, (no - 1) // {rel.PART_SIZE} as part_no, string_agg(c_name, ',' order by c_name) as members, count(*) as n
       from (select g, c_name, row_number() over (partition by g order by c_name) as no
             from (select distinct c_name, coalesce(case when c_custkey % 4 > 0 then 'N' || cast(c_custkey % 600 as varchar) end,
             'withoutgroupid') as g from customer)) group by 1, 2""",
)
def _(t: Tables):
    group = F.when(F.col("c_custkey") % 4 > 0, F.concat(F.lit("N"), (F.col("c_custkey") % 600).cast("string")))
    rows = rel.labelled_groups(t.customer.select("c_name", group.alias("group_id")), "group_id")
    parts = rel.group_members(rows, "group_id", "c_name")
    return parts.select("group_id", "part_no", F.array_join("members", ",").alias("members"), F.size("members").cast("long").alias("n"))


@query(
    "A11_source_flag",
    """select flow, case when n = 1 then only_one when n = 2 then 'HANA/BW' else 'None' end as source_flag
       from (select flow, count(distinct coalesce(system, '?')) as n, min(system) as only_one
             from (select c_nationkey as flow,
                          case c_nationkey % 4 when 0 then 'HANA' when 1 then case when c_custkey % 2 = 0 then 'HANA' else 'BW' end
                          when 2 then case when c_custkey % 2 = 0 then 'BW' end else c_mktsegment end as system
                   from customer) group by flow)""",
)
def _(t: Tables):
    kind, even = F.col("c_nationkey") % 4, F.col("c_custkey") % 2 == 0
    system = (
        F.when(kind == 0, "HANA")
        .when(kind == 1, F.when(even, "HANA").otherwise("BW"))
        .when(kind == 2, F.when(even, "BW"))
        .otherwise(F.col("c_mktsegment"))
    )
    return rel.source_flag(t.customer.select(F.col("c_nationkey").alias("flow"), system.alias("system")), "flow", "system")


@query(
    "A12_column_sets",
    f"""select o_custkey, (no - 1) // {rel.PART_SIZE} as part_no, string_agg(o_orderpriority, '|' order by o_orderpriority) as priorities
       from (select *, row_number() over (partition by o_custkey order by o_orderpriority) as no from (select distinct o_custkey, o_orderpriority from orders))
       group by 1, 2""",
)
def _(t: Tables):
    sets = rel.group_members(t.orders, "o_custkey", "o_orderpriority")
    return sets.select("o_custkey", "part_no", F.array_join("members", "|").alias("priorities"))


@query(
    "A13_coverage_rate",
    """select o_orderpriority, count(*) as seen, count(*) filter (where o_orderstatus = 'F') as matched,
       round(count(*) filter (where o_orderstatus = 'F') * 100.0 / count(*), 1)::double as rate_pct from orders group by 1""",
)
def _(t: Tables):
    return rel.coverage(t.orders, F.col("o_orderstatus") == "F", ["o_orderpriority"])


# --- U: set operations ------------------------------------------------------------------------


@query("U01_union_all", "select c_nationkey as k from customer union all select s_nationkey from supplier")
def _(t: Tables):
    return rel.union_all(t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select("s_nationkey"))


@query("U02_union_distinct", "select c_nationkey as k, 'C' as v from customer union select s_nationkey, 'C' from supplier")
def _(t: Tables):
    a = t.customer.select(F.col("c_nationkey").alias("k"), F.lit("C").alias("v"))
    return rel.union_distinct(a, t.supplier.select("s_nationkey", F.lit("C")))


@query(
    "U03_distinct_of_union_all",
    """select distinct * from (select policy, coverage from {log} l where correction = 'X'
       union all select policy, coverage from {log} l2 where kind = '508_ONLY')""",
)
def _(t: Tables):
    log = t.log
    a = log.filter(F.col("correction") == "X").select("policy", "coverage")
    return rel.distinct_union(a, log.filter(F.col("kind") == "508_ONLY").select("coverage", "policy"))


@query(
    "U04_union_node",
    """select c_name as name, c_acctbal as balance, c_mktsegment as segment from customer
       union all select s_name, s_acctbal, null from supplier""",
)
def _(t: Tables):
    return nodes.union(
        [
            UnionInput(t.customer, {"name": "c_name", "balance": "c_acctbal", "segment": "c_mktsegment"}),
            UnionInput(t.supplier, {"name": "s_name", "balance": "s_acctbal"}),
        ],
        ["name", "balance", "segment"],
    )


@query(
    "U05_union_ragged",
    """select n_name as a, cast(null as varchar) as b, null as c from nation union all select r_name, cast(r_regionkey as varchar), null
       from region union all select null, s_name, 'S' from supplier""",
)
def _(t: Tables):
    return rel.union_ragged(
        t.nation.select(F.col("n_name").alias("a")),
        t.region.select(F.col("r_name").alias("a"), F.col("r_regionkey").cast("string").alias("b")),
        t.supplier.select(F.col("s_name").alias("b"), F.lit("S").alias("c")),
    )


@query(
    "U06_tagged_union",
    """select policy, mutation_year as snapshot_year, 'EoY Snapshot' as snapshot from {log} l
       union all select policy, begin_year, 'BoY Snapshot' from {log} l2""",
)
def _(t: Tables):
    log = t.log
    return rel.tagged_union(
        {
            "EoY Snapshot": log.select("policy", F.col("mutation_year").alias("snapshot_year")),
            "BoY Snapshot": log.select("policy", F.col("begin_year").alias("snapshot_year")),
        },
        "snapshot",
    )


# --- M: upsert --------------------------------------------------------------------------------


def _registry(t: Tables):
    """Old and new entries, told by market segment: some customers are in one of them, most in both."""
    key = F.col("c_custkey")
    old = t.customer.filter(F.col("c_mktsegment") != "BUILDING").select(
        F.concat(F.lit("DF"), (key % 48).cast("string")).alias("flow"),
        F.col("c_name").alias("file"),
        F.concat(F.lit("OLD"), F.col("c_mktsegment")).alias("segment"),
        F.lit("schema").alias("schema_name"),
        F.col("c_nationkey").alias("group_id"),
    )
    new = t.customer.filter(F.col("c_mktsegment") != "MACHINERY").select(
        F.concat(F.lit("DF"), (key % 48).cast("string")).alias("flow"),
        F.col("c_name").alias("file"),
        F.when(key % 5 > 0, F.col("c_mktsegment")).alias("segment"),
    )
    return old, new


_OLD = """(select 'DF' || (c_custkey % 48) as flow, c_name as file, 'OLD' || c_mktsegment as segment, 'schema' as schema_name,
  c_nationkey as group_id from customer where c_mktsegment <> 'BUILDING')"""
_NEW = """(select 'DF' || (c_custkey % 48) as flow, c_name as file, case when c_custkey % 5 > 0 then c_mktsegment end as segment
  from customer where c_mktsegment <> 'MACHINERY')"""


@query(
    "M01_upsert_subset",
    f"""select o.flow, o.file, o.segment, o.schema_name, o.group_id from {_OLD} o anti join {_NEW} n using (flow, file)
        union all select o.flow, o.file, n.segment, o.schema_name, o.group_id from {_OLD} o join {_NEW} n using (flow, file)
        union all select n.flow, n.file, n.segment, null, null from {_NEW} n anti join {_OLD} o using (flow, file)""",
)
def _(t: Tables):
    old, new = _registry(t)
    return upsert(old, new, ["flow", "file"], update=["segment"], insert=["segment"])


@query(
    "M01_merge_table",
    f"""select o.flow, o.file, o.segment, o.schema_name, o.group_id from {_OLD} o anti join {_NEW} n using (flow, file)
        union all select o.flow, o.file, n.segment, o.schema_name, o.group_id from {_OLD} o join {_NEW} n using (flow, file)
        union all select n.flow, n.file, n.segment, null, null from {_NEW} n anti join {_OLD} o using (flow, file)""",
)
def _(t: Tables):
    old, new = _registry(t)
    name = "viewloom_m01_registry"
    save_by_key(old, name, ["flow", "file"], buckets=8)
    merge_table(new, name, update=["segment"], insert=["segment"])
    rows = materialize(t.spark.table(name).drop(BUCKET), name)
    t.spark.sql(f"DROP TABLE {name}")
    return rows


@query(
    "M02_upsert_all",
    f"""select o.* from {_OLD} o where o.segment <> 'OLDHOUSEHOLD'
        union all select 'DF' || (c_custkey % 48), c_name, 'NEW', case when c_mktsegment = 'HOUSEHOLD' then 'moved' end, 99 from customer where c_mktsegment in ('BUILDING', 'HOUSEHOLD')""",
)
def _(t: Tables):
    old, _unused = _registry(t)
    staged = t.customer.filter(F.col("c_mktsegment").isin("BUILDING", "HOUSEHOLD")).select(
        F.concat(F.lit("DF"), (F.col("c_custkey") % 48).cast("string")).alias("flow"),
        F.col("c_name").alias("file"),
        F.lit("NEW").alias("segment"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "moved").alias("schema_name"),
        F.lit(99).alias("group_id"),
    )
    return upsert(old, staged, ["flow", "file"])


@query(
    "M03_name_after_marker",
    "select c_name, nullif(split_part(replace(c_name, 'mer#00000', 'CV_'), 'CV_', 2), '') as derived from customer",
)
def _(t: Tables):
    described = F.replace("c_name", F.lit("mer#00000"), F.lit("CV_"))
    return t.customer.select("c_name", fn.suffix_after(described, "CV_").alias("derived"))
