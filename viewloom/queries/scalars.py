"""The scalar vocabulary (ids F) on orders, customers, parts and line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from viewloom.functions import scalar as fn
from viewloom.queries.base import Tables, query
from viewloom.queries.nodes import d8, money

_K = "o_orderkey as k"
_D8 = "strftime(o_orderdate, '%Y%m%d')"


def orders(t: Tables, *columns):
    return t.orders.select(F.col("o_orderkey").alias("k"), *columns)


@query("F01_now", f"select {_K}, true as in_the_past from orders")
def _(t: Tables):
    return orders(t, (fn.now() >= F.to_timestamp(F.lit("2020-01-01"))).alias("in_the_past"))


@query("F02_is_null", "select o_orderkey as k, nullif(o_orderstatus, 'P') is null as missing from orders")
def _(t: Tables):
    return orders(t, fn.is_null(F.nullif("o_orderstatus", F.lit("P"))).alias("missing"))


@query(
    "F03_if",
    "select o_orderkey as k, if(o_totalprice > 200000, 'high', if(o_totalprice > 50000, 'mid', 'low')) as band from orders",
)
def _(t: Tables):
    price = F.col("o_totalprice")
    return orders(t, fn.if_(price > 200000, "high", fn.if_(price > 50000, "mid", "low")).alias("band"))


@query(
    "F04_case",
    "select o_orderkey as k, case o_orderstatus when 'O' then 'open' when 'F' then 'final' else 'other' end as word from orders",
)
def _(t: Tables):
    return orders(t, fn.case_("o_orderstatus", "O", "open", "F", "final", default="other").alias("word"))


@query("F05_midstr", "select c_custkey as k, substring(c_name, 4, 6) as v from customer")
def _(t: Tables):
    return t.customer.select(F.col("c_custkey").alias("k"), fn.midstr("c_name", 4, 6).alias("v"))


@query("F06_leftstr", "select c_custkey as k, left(c_name, 8) as v from customer")
def _(t: Tables):
    return t.customer.select(F.col("c_custkey").alias("k"), fn.leftstr("c_name", 8).alias("v"))


@query("F07_rightstr", "select c_custkey as k, right(c_name, 3) as v from customer")
def _(t: Tables):
    return t.customer.select(F.col("c_custkey").alias("k"), fn.rightstr("c_name", 3).alias("v"))


@query("F08_match", "select p_partkey as k, p_name like 'r%g%t' as m1, p_brand like 'Brand#_' and false as m2 from part")
def _(t: Tables):
    # the second pattern holds a dot, which is an ordinary character in a glob
    return t.part.select(
        F.col("p_partkey").alias("k"), fn.match("p_name", "r*g*t").alias("m1"), fn.match("p_brand", "Brand.*").alias("m2")
    )


@query(
    "F09_sap_date",
    f"select {_K}, case when o_orderkey % 9 = 0 then null else cast(strptime({_D8}, '%Y%m%d') as date) end as v from orders",
)
def _(t: Tables):
    text = F.when(F.col("o_orderkey") % 9 == 0, fn.BLANK_DATE).otherwise(d8("o_orderdate"))
    return orders(t, fn.sap_date(text).alias("v"))


@query(
    "F10_sap_timestamp",
    """select ZMUTID, strftime(strptime(substring(ZMUTID, 14, 14), '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S') || '.'
       || substring(ZMUTID, 28, 4) as moment from {mutations} m""",
)
def _(t: Tables):
    moment = F.date_format(fn.sap_timestamp(fn.midstr("ZMUTID", 14, 18)), "yyyy-MM-dd HH:mm:ss.SSSS")
    return t.mutations.select("ZMUTID", moment.alias("moment"))


@query(
    "F11_days_between",
    "select l_orderkey, l_linenumber, date_diff('day', o_orderdate, l_shipdate) as days "
    "from lineitem join orders on l_orderkey = o_orderkey",
)
def _(t: Tables):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", fn.days_between("o_orderdate", "l_shipdate").alias("days"))


@query("F12_string", "select o_orderkey as k, cast(o_custkey as varchar) as v from orders")
def _(t: Tables):
    return orders(t, fn.string("o_custkey").alias("v"))


@query("F13_in", "select o_orderkey as k, o_orderstatus in ('O', 'P') as v from orders")
def _(t: Tables):
    return orders(t, fn.in_("o_orderstatus", "O", "P").alias("v"))


@query("F14_to_int", "select o_orderkey as k, try_cast(left(o_orderpriority, 1) as int) + 1 as v, null as bad from orders")
def _(t: Tables):
    return orders(t, (fn.to_int(F.left("o_orderpriority", F.lit(1))) + 1).alias("v"), fn.to_int("o_orderpriority").alias("bad"))


@query("F15_comma_decimal", "select o_orderkey as k, cast(cast(o_totalprice as decimal(17,2)) as double) as v from orders")
def _(t: Tables):
    text = F.replace(money("o_totalprice").cast("string"), F.lit("."), F.lit(","))
    return orders(t, fn.comma_decimal(text).cast("double").alias("v"))


@query(
    "F16_decfloat",
    "select o_orderkey as k, case when o_orderkey < 1000 then o_orderkey::double end as v from orders",
)
def _(t: Tables):
    return orders(t, fn.decfloat("o_orderkey").cast("double").alias("v"))


@query("F17_round0", "select l_orderkey as k, l_linenumber as n, cast(round(cast(l_extendedprice as decimal(17,2)), 0) as double) as v from lineitem")
def _(t: Tables):
    v = fn.round0(money("l_extendedprice")).cast("double")
    return t.lineitem.select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), v.alias("v"))


@query("F18_safe_div", "select p_partkey as k, case when p_size <> 10 then p_retailprice / (p_size - 10) else 0 end as v from part")
def _(t: Tables):
    return t.part.select(F.col("p_partkey").alias("k"), fn.safe_div("p_retailprice", F.col("p_size") - 10).alias("v"))


@query("F19_concat", "select o_orderkey as k, o_orderstatus || '#' || o_orderpriority as v from orders")
def _(t: Tables):
    return orders(t, fn.cat("o_orderstatus", F.lit("#"), "o_orderpriority").alias("v"))


@query(
    "F20_searched_case",
    """select p_partkey as k, case when p_type in ('ECONOMY', 'PROMO') and p_size < 20 then 'A'
       when p_type = 'SMALL' or p_size > 40 then 'B' else '' end as v from part""",
)
def _(t: Tables):
    cheap = F.col("p_type").isin("ECONOMY", "PROMO") & (F.col("p_size") < 20)
    odd = (F.col("p_type") == "SMALL") | (F.col("p_size") > 40)
    return t.part.select(F.col("p_partkey").alias("k"), F.when(cheap, "A").when(odd, "B").otherwise("").alias("v"))


@query("F21_coalesce", "select o_orderkey as k, coalesce(nullif(o_orderstatus, 'F'), o_orderpriority) as v from orders")
def _(t: Tables):
    return orders(t, F.coalesce(F.nullif("o_orderstatus", F.lit("F")), "o_orderpriority").alias("v"))


@query("F22_year8", "select o_orderkey as k, year(o_orderdate) as v, null as blank from orders")
def _(t: Tables):
    return orders(t, fn.year8(d8("o_orderdate")).alias("v"), fn.year8(F.lit("")).alias("blank"))


@query(
    "F23_hash_id",
    """select c_custkey as k, case when c_custkey % 5 = 0 then '' when c_custkey % 7 = 0 then null
       else upper(sha256(cast(c_custkey as varchar))) end as v from customer""",
)
def _(t: Tables):
    key = F.col("c_custkey")
    bsn = F.when(key % 5 == 0, "000000000").when(key % 7 == 0, None).otherwise(key.cast("string"))
    return t.customer.select(key.alias("k"), fn.hash_id(bsn).alias("v"))


@query(
    "F24_age",
    f"""select {_K}, case when 1998 - year(o_orderdate) between 0 and 999 then 1998 - year(o_orderdate) end as v from orders""",
)
def _(t: Tables):
    return orders(t, fn.age(F.lit(1998), d8("o_orderdate")).alias("v"))


@query("F25_split_part", "select p_partkey as k, upper(trim(split_part(p_name, ' ', 2))) as v, lower(p_type) as w, null as none from part")
def _(t: Tables):
    return t.part.select(
        F.col("p_partkey").alias("k"),
        F.upper(F.trim(fn.part("p_name", " ", 1))).alias("v"),
        F.lower("p_type").alias("w"),
        fn.part("p_name", " ", 7).alias("none"),
    )


@query(
    "F26_strip_precision",
    "select p_partkey as k, case when p_size > 25 then 'DECIMAL' else 'STRING' end as v from part",
)
def _(t: Tables):
    size = F.col("p_size").cast("string")
    declared = F.when(F.col("p_size") > 25, F.concat(F.lit("DECIMAL("), size, F.lit(",2)"))).otherwise("STRING")
    return t.part.select(F.col("p_partkey").alias("k"), fn.strip_precision(declared).alias("v"))


@query(
    "F27_dotted_name",
    "select p_partkey as k, p_brand || '.' || case when p_size > 10 then p_type end as v from part",
)
def _(t: Tables):
    return t.part.select(
        F.col("p_partkey").alias("k"), fn.cat("p_brand", F.lit("."), F.when(F.col("p_size") > 10, F.col("p_type"))).alias("v")
    )


@query(
    "F28_lower_unquoted",
    "select o_orderkey as k, 'select ''' || o_orderpriority || ''' from ' || lower(o_orderstatus) || 'x' as v from orders",
)
def _(t: Tables):
    text = F.concat(F.lit("SELECT '"), "o_orderpriority", F.lit("' FROM "), "o_orderstatus", F.lit("X"))
    return orders(t, fn.lower_unquoted(text).alias("v"))


@query(
    "F29_type_match",
    """select k, target is not null and source is not null and (target = source or target = 'STRING' and source = 'NVARCHAR') as matches,
       target is null or source is null as unknown
       from (select p_partkey as k, case p_size % 3 when 0 then 'STRING' when 1 then 'DECIMAL' end as target,
             case p_size % 5 when 0 then 'NVARCHAR' when 1 then 'DECIMAL' when 2 then 'STRING' when 3 then 'DATE' end as source from part)""",
)
def _(t: Tables):
    size = F.col("p_size")
    target = F.when(size % 3 == 0, "STRING").when(size % 3 == 1, "DECIMAL")
    source = fn.case_(size % 5, 0, "NVARCHAR", 1, "DECIMAL", 2, "STRING", 3, "DATE")
    match = fn.type_match(target, source)
    return t.part.select(
        F.col("p_partkey").alias("k"), F.coalesce(match, F.lit(False)).alias("matches"), match.isNull().alias("unknown")
    )


@query("F30_filled_flag", "select o_orderkey as k, case when o_orderstatus = 'O' then '' else 'X' end as v from orders")
def _(t: Tables):
    return orders(t, fn.filled_flag(F.when(F.col("o_orderstatus") == "O", "").otherwise(F.col("o_orderstatus"))).alias("v"))
