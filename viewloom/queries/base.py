"""Registry of queries and the stand-in tables they share.

A stand-in table is one SELECT in the common ground of Spark SQL and DuckDB: it only gives columns of
the test tables the names, codes and text formats the operators expect, and keeps every row.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


class Tables:
    """The parquet tables of one scale folder, and the stand-ins derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name in STAND_INS:
            return self.sql(STAND_INS[name])
        raise AttributeError(name)

    @property
    def edge_rows(self) -> DataFrame:
        """The rows whose distinct ones are the edges, for operators that take repeats away themselves."""
        return self.sql(STAND_INS["edges"].replace(" union ", " union all "))

    def sql(self, text: str, dealt: bool = False) -> DataFrame:
        """Run SQL over tables and stand-ins written as ``{name}``.

        ``dealt`` is for texts far longer than the rows they are made of: the rows are dealt out first, as the splits of their file go by its size.
        """
        used = {n: getattr(self, n) for n in [*TABLES, *STAND_INS] if "{" + n + "}" in text}
        if dealt:
            parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            used = {n: df.repartition(parts) for n, df in used.items()}
        return self.spark.sql(re.sub(r"varchar\(\d+\)", "string", text), **used)


def expand(text: str) -> str:
    """DuckDB text: tables by name, stand-ins as sub-selects."""
    for _ in range(4):  # stand-ins may use stand-ins
        for name, body in STAND_INS.items():
            text = text.replace("{" + name + "}", "(" + body + ")")
    for name in TABLES:
        text = text.replace("{" + name + "}", name)
    return text.replace("explode(array(", "unnest(list_value(")


def query(name: str, oracle: str | None = None):
    """Register ``fn(tables) -> DataFrame`` with the SQL it must agree with."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if oracle is not None:
            _ORACLES[name] = expand(oracle)
        return fn

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


_D8 = "cast(year({0}) * 10000 + month({0}) * 100 + day({0}) as varchar(8))"
_ORDER_D8 = _D8.format("o_orderdate")

STAND_INS: dict[str, str] = {}

# Orders as text-typed log rows: the small shape most operators use.
STAND_INS["log"] = f"""
select cast(o_orderkey as varchar(20)) as mutation_id,
       cast(o_custkey as varchar(20)) as policy,
       case when o_orderpriority like '3%' then '008' when o_orderpriority like '4%' then '015' else '007' end as coverage,
       case o_orderstatus when 'O' then '510_ONLY' when 'P' then 'BOTH' else '508_ONLY' end as kind,
       {_ORDER_D8} as processed_on,
       o_orderkey as seq,
       year(o_orderdate) as mutation_year,
       case when month(o_orderdate) = 1 and day(o_orderdate) = 1 then year(o_orderdate)
            else year(o_orderdate) + 1 end as begin_year,
       cast(o_totalprice as decimal(17,2)) as amount,
       case when o_orderkey % 7 = 3 then 'X' else '' end as correction,
       case when o_orderkey % 3 = 0 then cast(o_totalprice as decimal(17,2)) end as salary,
       case when o_orderstatus = 'F' and o_orderkey % 5 = 0 then 'E001'
            when o_orderstatus = 'P' and o_orderkey % 5 = 0 then 'R001' else 'M100' end as event
from {{orders}}"""

# The mutation log with the field names of the source system. Every order has two amount slices.
_MUTATION_FIELDS = f"""
select 'MUT' || lpad(cast(o_orderkey as varchar(20)), 10, '0') || {_ORDER_D8} || '101530'
           || lpad(cast(o_orderkey % 10000 as varchar(20)), 4, '0') as ZMUTID,
       'V' || cast(o_orderkey % 4 as varchar(20)) as ZVTAID,
       'D' || cast(o_custkey as varchar(20)) as ZPDEELNID,
       {_ORDER_D8} as ZVERW_DAT,
       o_orderkey as MWYZVLGNR,
       case when o_orderkey % 6 = 0 then cast(year(o_orderdate) as varchar(4)) || '0101' else {_ORDER_D8} end as ZMUTDATE,
       year(o_orderdate) as ZMUTJAAR,
       case when o_orderpriority like '3%' then '008' when o_orderpriority like '4%' then '015' else '007' end as ZAANSTYP,
       'G1' as ZVZ_GROEP,
       'C' || cast(o_orderkey % 5 as varchar(20)) as MMUTCOD,
       cast(o_custkey as varchar(20)) as ZPDEELID,
       case when o_orderkey % 7 = 3 and o_orderstatus = 'F' and o_orderpriority >= '3' and o_orderpriority < '5' then 'B002'
            when o_orderkey % 7 = 3 and o_orderstatus = 'F' then 'B001'
            when o_orderstatus = 'F' and o_orderkey % 5 = 0 and o_orderpriority >= '3' and o_orderpriority < '5' then 'E002'
            when o_orderstatus = 'F' and o_orderkey % 5 = 0 then 'E001'
            when o_orderstatus = 'P' and o_orderkey % 11 = 0 and o_orderpriority >= '3' and o_orderpriority < '5' then 'R002'
            when o_orderstatus = 'P' and o_orderkey % 11 = 0 then 'R001'
            else 'M100' end as ZEVENTID,
       case when o_orderpriority like '3%' then 'CP08' when o_orderpriority like '4%' then 'CP15' else 'CP07' end as ZVVAANTP,
       'W' || cast(o_custkey % 20 as varchar(20)) as ZWERKGID,
       {_ORDER_D8} as ZINDATPOL,
       case when o_orderkey % 10 = 0 then '' else cast(o_orderkey % 9 as varchar(20)) end as ZVSTATP,
       cast(o_orderkey % 8 as varchar(20)) as ZVVSTATP,
       cast(o_orderkey % 6 as varchar(20)) as ZVVSTATA,
       case when o_orderkey % 9 = 0 then '' else cast(o_orderkey % 5 as varchar(20)) end as ZVSTATA,
       'F' || cast(o_orderkey % 3 as varchar(20)) as ZVFINSTA,
       case when o_custkey % 10 = 0 then '' else cast(100000000 + o_custkey * 7 as varchar(20)) end as ZBSN1,
       case when o_orderkey % 4 = 0 then '' when o_custkey % 2 = 0 then 'M' else 'V' end as ZGESL,
       case when o_orderkey % 13 = 0 then '00000000' when o_orderkey % 11 = 0 then ''
            else cast((1930 + o_custkey % 60 + o_orderkey % 2) * 10000 + (1 + o_custkey % 12) * 100 + 1 + o_custkey % 28 as varchar(20))
            end as ZGEBDAT,
       case when o_orderstatus = 'F' and (o_orderkey % 7 = 3 or o_orderkey % 5 = 0)
                 and (o_orderpriority < '3' or o_orderpriority >= '5')
            then {_ORDER_D8} else '' end as ZSTEDAT,
       case o_orderstatus when 'O' then '510_ONLY' when 'P' then 'BOTH' else '508_ONLY' end as ZTYPE,
       case when o_custkey % 3 = 0 then '' else cast(500000000 + o_custkey * 3 as varchar(20)) end as ZVZBSN,
       case when o_custkey % 3 = 0 then '' when o_custkey % 2 = 0 then 'V' else 'M' end as ZVZGESL,
       case when o_custkey % 3 = 0 then '00000000'
            else cast((1925 + o_custkey % 70) * 10000 + (1 + o_custkey % 11) * 100 + 1 + o_custkey % 27 as varchar(20)) end as ZVZGEBDAT,
       case when o_orderstatus = 'F' and (o_orderkey % 7 = 3 or o_orderkey % 5 = 0)
                 and o_orderpriority >= '3' and o_orderpriority < '5'
            then {_ORDER_D8} else '' end as ZVZSTEDAT,
       cast(o_totalprice as decimal(17,2)) as ZTGZ_BDR,
       cast(cast(o_totalprice as decimal(17,2)) - cast(o_orderkey % 100 as decimal(17,2)) as decimal(17,2)) as ZVERBDR,
       case when o_orderkey % 3 = 0 then cast(o_totalprice as decimal(17,2)) end as ZLTSAL,
       case when o_orderkey % 3 = 0 then {_ORDER_D8} else '' end as ZLTSALDT,
       case when o_orderkey % 3 = 0 then cast(o_custkey as decimal(17,2)) end as ZBSSALAM,
       'T' || cast(o_orderkey % 2 as varchar(20)) as MBETTCP,
       'M' || cast(o_orderkey % 3 as varchar(20)) as MBETMCP,
       case when o_orderkey % 7 = 3 then 'PREV' || cast(o_orderkey as varchar(20)) else '' end as ZPRVMUTID"""
STAND_INS["mutations"] = f"""
{_MUTATION_FIELDS}, explode(array('1', '2')) as ZPENREGID from {{orders}}"""

# Address history: two intervals per person, snapshot kind and role; income class per postcode.
STAND_INS["addresses"] = """
select bsn as BSN, kind as SNAPSHOT_TYPE, lo as ADDR_VALID_FROM, hi as ADDR_VALID_TO,
       cast(1000 + (c_nationkey + move) % 25 as varchar(20)) as POSTCODE,
       case when c_nationkey % 5 = 0 then 'X' else '' end as BUITENLAND
from (select bsn, c_nationkey, kind, case when move = 0 then 1990 else 1998 end as lo,
             case when move = 0 then 1998 else 9999 end as hi, move
      from (select bsn, c_nationkey, kind, explode(array(0, 7)) as move
            from (select bsn, c_nationkey, explode(array('EoY Snapshot', 'BoY Snapshot')) as kind
                  from (select cast(100000000 + c_custkey * 7 as varchar(20)) as bsn, c_nationkey from {customer}
                        union all
                        select cast(500000000 + c_custkey * 3 as varchar(20)) as bsn, c_nationkey from {customer}) people
                 ) kinds) moves) spans"""
STAND_INS["income"] = (
    "select cast(1000 + n_nationkey as varchar(20)) as POSTCODE, cast(n_regionkey as varchar(20)) as HH_INKOM from {nation}"
)

# Depot duration.
STAND_INS["depot_base"] = """
select cast(cast(floor(c_custkey / 60) as bigint) as varchar(20)) as RELNR,
       cast(c_custkey as varchar(20)) as VOLGNR,
       cast(c_custkey % 3 as varchar(20)) as VZ_CD_PA,
       cast(c_custkey % 5 as varchar(20)) as GRPNR,
       case when c_mktsegment = 'BUILDING' then '3' when c_mktsegment = 'HOUSEHOLD' then '7' else '5' end as ACT_FIN_TYPE,
       case when c_custkey % 2 = 0 then '3' else '4' end as ACT_TOESL_CAT,
       case when c_mktsegment = 'MACHINERY' then '8' when c_mktsegment = 'BUILDING' then '3' else '1' end as INACT_FIN_TYPE,
       case when c_custkey % 3 = 0 then '9' else '4' end as INACT_TOESL_CAT,
       'R1' as RUN_ID, 'T' as RUN_TYPE, '20000315' as REFERENCE_DATE,
       '2000-03-15 10:00:00' as RUN_TIMESTAMP, '20000315' as RUN_DATE
from {customer}"""
STAND_INS["depot_amounts"] = """
select explode(array('1998', '1999', '2000')) as JAAR, cast(s_suppkey as varchar(20)) as RELNR_DEPOT,
       cast(cast(s_acctbal as decimal(17,2)) * case when s_suppkey % 8 = 3 then 1000000 else 1000 end as decimal(17,2)) as SALDO_VJ
from {supplier}"""
STAND_INS["depot_relations"] = """
select cast(cast(floor(s_suppkey / 4) as bigint) as varchar(20)) as RELNR,
       case s_suppkey % 3 when 0 then 'A' when 1 then 'I' else 'AI' end as TOESL_CAT_DLN,
       cast(s_suppkey as varchar(20)) as RELNR_DEPOT,
       case when s_suppkey % 2 = 0 then '' else cast(s_suppkey % 5 as varchar(20)) end as GRPNR,
       explode(array('20000101000000', '19990101000000')) as ZVALIDFRM
from {supplier}"""
STAND_INS["depot_balances"] = f"""
select cast(l_suppkey as varchar(20)) as RELNR_PADDED, {_D8.format("l_shipdate")} as WYZ_VERWERK_DAT,
       cast(l_extendedprice as decimal(17,3)) as VRG_J_SLD_VERSCHUL
from {{lineitem}}"""
STAND_INS["depot_journal"] = """
select cast(l_suppkey as varchar(20)) as RELNR,
       replace(cast(cast((l_extendedprice - 25000) as decimal(17,2)) as varchar(30)), '.', ',') as BOEK,
       cast(year(l_shipdate) as varchar(4)) as BOEKJR,
       cast(648 + l_linenumber as varchar(3)) as BOEKCD, '2000' as REF_YEAR, '1999' as REF_YEAR_MINUS_1
from {lineitem}"""

# Column metadata of two systems: parts play columns, brands play views and tables.
_NAME = "upper(replace(p_name, ' ', '_')) || '_' || cast(p_partkey as varchar(20))"
_BRAND = "replace(upper(p_brand), '#', '_')"
STAND_INS["source_meta"] = f"""
select '_SYS_BIC' as SCHEMA_NAME, 'pkg.sub/CV_' || {_BRAND} as VIEW_NAME, {_NAME} as COLUMN_NAME, p_size % 3 as DATA_TYPE_ID,
       case p_size % 3 when 0 then 'NVARCHAR' when 1 then 'DECIMAL' else 'DATE' end as DATA_TYPE_NAME
from {{part}}"""
STAND_INS["target_meta"] = f"""
select 'TABLE' as object_type, 'lakedev' as catalog_name, 'gold' as schema_name, 'TAB_' || {_BRAND} as object_name,
       case p_partkey % 4 when 2 then 'Z_' || {_NAME} when 3 then replace({_NAME}, '_', '') else {_NAME} end as column_name,
       case p_size % 3 when 0 then 'STRING' when 1 then 'DECIMAL(10,2)' else 'TIMESTAMP' end as data_type
from {{part}}"""
STAND_INS["objects"] = f"""
select distinct 'lake' || chr(123) || 'ENV' || chr(125) || '.gold.tab_' || lower({_BRAND}) as SLO_Object,
       'CV_' || {_BRAND} as Decoupling_View, 'pkg.sub' as source_package, 'T_' || {_BRAND} as Table_ID
from {{part}}"""
STAND_INS["name_pairs"] = f"""
select upper(split_part(p_name, ' ', 2)) || '_' || replace(upper(p_brand), '#', '') as sap_name,
       upper(replace(p_name, ' ', '_')) || '_' || replace(upper(p_brand), '#', '') || '_' || cast(p_size as varchar(20)) as dbx_name
from {{part}}"""
# A mapping sheet: part types play sheets, brands play views.
STAND_INS["mapping_sheet"] = """
select p_type as sheet, p_partkey as row_no, case when p_partkey % 17 = 0 then null else p_brand || ' ' end as used_by,
       case when p_partkey % 3 = 0 then 'CV_' || p_brand end as base_cv,
       'F_' || replace(p_name, ' ', '_') as sap_field,
       case when p_partkey % 7 > 0 then replace(p_name, ' ', '_') || '_' || cast(p_size % 3 as varchar(20)) end as dbx_field,
       case when p_partkey % 4 = 0 then 'tab_' || p_brand end as dbx_table,
       case when p_size > 45 then 'check' end as comments
from {part}"""

# Lineage: rows play columns of their table, foreign keys play edges.
def _edges(table, key, parent, parent_key, rows):
    return (
        f"select 'stage.{table}' as target_table_name, '{table[0]}' || {key} as target_column_name, "
        f"'stage.{parent}' as source_table_name, '{parent[0]}' || {parent_key} as source_column_name, "
        f"'copy' as transformation from {{{rows}}}"
    )


def _text(column):
    return f"cast({column} as varchar(20))"


STAND_INS["edges"] = " union ".join(
    [
        _edges("lineitem", f"{_text('l_orderkey')} || '-' || {_text('l_linenumber')}", "orders", _text("l_orderkey"), "lineitem"),
        _edges("lineitem", f"{_text('l_orderkey')} || '-' || {_text('l_linenumber')}", "supplier", _text("l_suppkey"), "lineitem"),
        _edges("orders", _text("o_orderkey"), "customer", _text("o_custkey"), "orders"),
        _edges("customer", _text("c_custkey"), "nation", _text("c_nationkey"), "customer"),
        _edges("supplier", _text("s_suppkey"), "nation", _text("s_nationkey"), "supplier"),
        _edges("nation", _text("n_nationkey"), "region", _text("n_regionkey"), "nation"),
    ]
)
