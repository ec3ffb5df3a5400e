"""Metadata jobs and lineage (ids D and L)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from viewloom.functions.similarity import NOISE, similarity
from viewloom.operators import lineage, metadata as md, names
from viewloom.plans import reconcile
from viewloom.queries.base import Tables, query
from viewloom.queries.sources import named_files
from viewloom.sources import readers

# --- D ----------------------------------------------------------------------------------------


@query(
    "D01_split_object",
    "select Decoupling_View, split_part(SLO_Object, chr(123), 1) as CatalogName, split_part(SLO_Object, '.', 2) as SchemaName, "
    "split_part(SLO_Object, '.', 3) as TableName from {objects} o",
)
def _(t: Tables):
    return md.split_object(t.objects).select("Decoupling_View", "CatalogName", "SchemaName", "TableName")


@query("D02_view_leaf", "select COLUMN_NAME, split_part(VIEW_NAME, '/', 2) as CalculationViewName from {source_meta} s")
def _(t: Tables):
    return md.view_leaf(t.source_meta).select("COLUMN_NAME", "CalculationViewName")


_SOURCE = """select distinct split_part(VIEW_NAME, '/', 2) as CalculationViewName, split_part(SLO_Object, '.', 3) as TableName,
  COLUMN_NAME, DATA_TYPE_NAME from {source_meta} s join {objects} o on split_part(VIEW_NAME, '/', 2) = Decoupling_View"""
_TARGET = "select m.* from {target_meta} m join {objects} o2 on object_name = upper(split_part(SLO_Object, '.', 3))"
_REPORT = f"""select catalog_name || '.' || schema_name as CatalogSchema, coalesce(object_name, upper(TableName)) as TableNameDbx,
  CalculationViewName as CalcViewName, column_name as ColumnNameDbx, s.cn as ColumnNameSAP,
  regexp_replace(data_type, '\\(.*\\)', '') as DataTypeDbx, DATA_TYPE_NAME as DataTypeSAP,
  case when data_type is null or DATA_TYPE_NAME is null then null when data_type = 'STRING' and DATA_TYPE_NAME = 'NVARCHAR' then true
       else regexp_replace(data_type, '\\(.*\\)', '') = DATA_TYPE_NAME end as DataTypeMatch
  from (select CalculationViewName, TableName, COLUMN_NAME as cn, DATA_TYPE_NAME from ({_SOURCE})) s
  full join ({_TARGET}) d on upper(TableName) = object_name and s.cn = d.column_name"""


def _inputs(t: Tables):
    objects = md.split_object(t.objects)
    return md.source_columns(md.view_leaf(t.source_meta), objects), md.target_columns(t.target_meta, objects)


@query("D03_source_columns", _SOURCE)
def _(t: Tables):
    return _inputs(t)[0]


@query("D04_reconcile_types", _REPORT)
def _(t: Tables):
    return md.reconcile_types(*_inputs(t))


def _match_sql(condition: str) -> str:
    return f"""with s as (select distinct sap_name as name from {{name_pairs}} a), d as (select distinct dbx_name as cand from {{name_pairs}} b)
      select name, min(cand) as matched from s left join d on {condition} group by name"""


@query("D05_match_contains", _match_sql("contains(cand, name)"))
def _(t: Tables):
    return names.match_names(t.name_pairs.select("sap_name"), t.name_pairs.select("dbx_name"), "contains")


_NO_ = "replace({0}, '_', '')"
_NOP = "replace(replace({0}, '_', ''), 'P', '')"


@query(
    "D06_match_both_ways",
    _match_sql(f"contains({_NO_.format('cand')}, {_NO_.format('name')}) or contains({_NO_.format('name')}, {_NO_.format('cand')})"),
)
def _(t: Tables):
    return names.match_names(t.name_pairs.select("sap_name"), t.name_pairs.select("dbx_name"), "bidir")


@query(
    "D07_match_without_p",
    """with s as (select distinct dbx_name as name from {name_pairs} a), d as (select distinct sap_name as cand from {name_pairs} b)
      select name, min(cand) as matched from s left join d on """
    + f"contains({_NOP.format('cand')}, {_NOP.format('name')}) or contains({_NOP.format('name')}, {_NOP.format('cand')}) group by name",
)
def _(t: Tables):
    return names.match_names(t.name_pairs.select("dbx_name"), t.name_pairs.select("sap_name"), "bidir_noP")


@query(
    "D08_filter_ambiguous",
    """select k, ColumnNameSAP, ColumnNameDbx from (
         select *, count(*) over (partition by ColumnNameSAP) as cnt from (
           select p_partkey as k, case when p_size > 3 then p_name || cast(p_size % 5 as varchar) || p_brand end as ColumnNameSAP,
                  case when p_size > 40 then p_type end as ColumnNameDbx from part))
       where ColumnNameSAP is null or cnt = 1 or ColumnNameDbx is not null""",
)
def _(t: Tables):
    rows = t.part.select(
        F.col("p_partkey").alias("k"),
        F.when(F.col("p_size") > 3, F.concat("p_name", (F.col("p_size") % 5).cast("string"), "p_brand")).alias("ColumnNameSAP"),
        F.when(F.col("p_size") > 40, F.col("p_type")).alias("ColumnNameDbx"),
    )
    return md.filter_ambiguous(rows)


def _rematch_sql(condition: str) -> str:
    return f"""
with report as ({_REPORT}),
wanted as (select distinct ColumnNameSAP as name from report where ColumnNameDbx is null),
found as (select name, min(ColumnNameDbx) as matched from wanted join (select distinct ColumnNameDbx from report) c on {condition} group by 1),
named as (select report.*, case when ColumnNameDbx is null then matched end as MatchedColumnDbx from report left join found on ColumnNameSAP = name),
types as (select object_name, column_name, max(regexp_replace(data_type, '\\(.*\\)', '')) as tp from ({_TARGET}) group by 1, 2)
select named.*, tp as DataTypeDbxMatched,
       case when tp is null or DataTypeSAP is null then null when tp = 'STRING' and DataTypeSAP = 'NVARCHAR' then true
            else tp = DataTypeSAP end as DataTypeMatchAfterMatch
from named left join types on TableNameDbx = object_name and MatchedColumnDbx = column_name"""


@query("D09_rematch_types", _rematch_sql("contains(ColumnNameDbx, name)"))
def _(t: Tables):
    source, target = _inputs(t)
    return md.rematch_types(md.match_columns(md.reconcile_types(source, target), "contains"), target)


_PAIRS = """select p_partkey as k, 'Z' || replace(p_name, ' ', '_') || '_cd' as sap_field,
  case p_partkey % 5 when 0 then 'z' || replace(p_name, ' ', '_') || '_CD ' when 1 then 'Z' || replace(p_name, ' ', '_') || '_p'
       when 2 then replace(p_name, ' ', '_') when 3 then p_type || cast(p_size as varchar(20)) else replace(p_brand, '#', '_') end as dbx_field
  from {part}"""


def _noise(x: str) -> str:
    for noise in NOISE:
        x = f"replace({x}, '{noise}', '')"
    return x


_SCORE = f"""select k, sap_field, dbx_field, case when a = b then 1.0::double when x = y then 0.9::double when contains(x, y) or contains(y, x) then 0.8::double
  else (len(list_intersect(lx, ly))::double / len(list_distinct(list_concat(lx, ly)))) * 0.7::double
       + (1 - abs(length(x) - length(y))::double / greatest(length(x), length(y))) * 0.3::double end as score
  from (select *, list_distinct(string_split(x, '')) as lx, list_distinct(string_split(y, '')) as ly
        from (select *, {_noise('a')} as x, {_noise('b')} as y
              from (select *, trim(lower(sap_field)) as a, trim(lower(dbx_field)) as b from ({_PAIRS}))))"""


def _pairs(t: Tables):
    return t.sql(_PAIRS)


@query("D10_similarity", f"select k, round(score, 6) as score from ({_SCORE})")
def _(t: Tables):
    return _pairs(t).select("k", F.round(similarity(F.col("sap_field"), F.col("dbx_field")), 6).alias("score"))


@query(
    "D11_fuzzy_pairs",
    f"select k, sap_field, dbx_field, round(score, 3) as Similarity_Score, 'Fuzzy' as Match_Type from ({_SCORE}) where score >= 0.6 and score < 1",
)
def _(t: Tables):
    return md.fuzzy_pairs(_pairs(t), "sap_field", "dbx_field", 0.6)


_CELLS = " union all ".join(
    f"select sheet, trim(used_by) as v, row_no, '{f}' as field, {'trim(used_by)' if f == 'used_by' else f} as value from sheet_rows"
    for f in md.MAPPING_FIELDS
)
_ALIGNED = f"""
with sheet_rows as (select * from {{mapping_sheet}} m where used_by is not null),
views as (select sheet, v, row_number() over (partition by sheet order by f) as view_no
          from (select sheet, trim(used_by) as v, min(row_no) as f from sheet_rows group by 1, 2)),
cells as (select sheet, v, field, value, min(row_no) as f from ({_CELLS}) where value is not null group by 1, 2, 3, 4),
placed as (select *, row_number() over (partition by sheet, v, field order by f) as position from cells),
records as (select sheet, v, position, {", ".join(f"max(value) filter (field = '{f}') as {f}" for f in md.MAPPING_FIELDS)}
            from placed group by 1, 2, 3)
select 'calculation_view_' || r.sheet || '_' || view_no as view, r.position, coalesce(r.used_by, '') as used_by,
       coalesce(r.base_cv, d.base_cv, '') as base_cv, coalesce(r.sap_field, '') as sap_field, coalesce(r.dbx_field, '') as dbx_field,
       coalesce(r.dbx_table, d.dbx_table, '') as dbx_table, coalesce(r.comments, '') as comments
from records r join views on r.sheet = views.sheet and r.v = views.v
left join records d on r.sheet = d.sheet and r.v = d.v and d.position = 1"""


@query("D12_align_mapping", _ALIGNED)
def _(t: Tables):
    return md.align_mapping(t.mapping_sheet)


@query(
    "D13_build_lookup",
    """select upper(sap_field) as key, min(row_no) as ordinal, arg_max(dbx_field, row_no) as value from {mapping_sheet} m
       where dbx_field is not null group by 1""",
)
def _(t: Tables):
    return md.build_lookup(t.mapping_sheet, "sap_field", "dbx_field", "row_no")


@query(
    "D14_describe_fields",
    """with known as (select lower(dbx_field) as k, arg_max(sap_field, row_no) as v, min(row_no) as f from {mapping_sheet} m
                      where dbx_field is not null group by 1),
       core as (select replace(k, '_', '') as k, arg_min(v, f) as v from known group by 1),
       fields as (select p_partkey, case p_partkey % 3 when 0 then upper(replace(p_name, ' ', '_')) || '_1' when 1 then replace(p_name, ' ', '') || '2'
                         else p_type end as field from part)
       select p_partkey, field, coalesce(known.v, core.v) as description from fields left join known on lower(field) = known.k
       left join core on replace(lower(field), '_', '') = core.k""",
)
def _(t: Tables):
    kind = F.col("p_partkey") % 3
    field = (
        F.when(kind == 0, F.concat(F.upper(F.replace("p_name", F.lit(" "), F.lit("_"))), F.lit("_1")))
        .when(kind == 1, F.concat(F.replace("p_name", F.lit(" "), F.lit("")), F.lit("2")))
        .otherwise(F.col("p_type"))
    )
    known = t.mapping_sheet.select(
        F.col("dbx_field").alias("key"), F.col("sap_field").alias("value"), F.col("row_no").alias("ordinal")
    )
    return md.describe_fields(t.part.select("p_partkey", field.alias("field")), "field", known)


@query(
    "D15_table_health",
    """select 'dev' as environment, 'health_dev_orders' as table_name, case when exists (select 1 from orders) then 'has data' else 'empty' end as status
       union all select 'dev', 'health_dev_free_orders', case when exists (select 1 from orders where o_totalprice <= 0) then 'has data' else 'empty' end
       union all select 'dev', 'health_dev_absent', 'error'""",
)
def _(t: Tables):
    t.orders.createOrReplaceTempView("health_dev_orders")
    t.orders.filter("o_totalprice <= 0").createOrReplaceTempView("health_dev_free_orders")
    names_ = ["health_{ENV}_orders", "health_{ENV}_free_orders", "health_{ENV}_absent"]
    return md.table_health(t.spark, names_, "dev")


# --- L ----------------------------------------------------------------------------------------


@query("L01_edges_of_column", "select * from {edges} e where target_table_name = 'stage.nation' and target_column_name = 'n7'")
def _(t: Tables):
    return lineage.edges_of(t.edges, "stage.nation", "n7")


_REACH = """with recursive e as (select distinct target_table_name as tt, target_column_name as tc, source_table_name as st, source_column_name as sc
  from {edges} e0), r as (select tt, tc, st, sc, 1 as depth from e
  union select r.tt, r.tc, e.st, e.sc, depth + 1 from r join e on r.st = e.tt and r.sc = e.tc)"""


@query(
    "L02_closure",
    _REACH + " select tt as target_table_name, tc as target_column_name, st as source_table_name, sc as source_column_name, "
    "min(depth) as depth from r group by 1, 2, 3, 4",
)
def _(t: Tables):
    return lineage.closure(t.edge_rows)


_EDGE = ("target_table_name", "target_column_name", "source_table_name", "source_column_name", "transformation")
_WIDE = (
    "with e as materialized (select * from {edges} e0) select "
    + ", ".join(f"e{i}.{c} as {c}{'' if i == 1 else i}" for i in range(1, 5) for c in _EDGE)
    + " from e e1"
    + "".join(
        f" left join e e{i} on e{i - 1}.source_table_name = e{i}.target_table_name and e{i - 1}.source_column_name = e{i}.target_column_name"
        for i in range(2, 5)
    )
)


@query("L03_wide_paths", _WIDE)
def _(t: Tables):
    return lineage.wide_form(t.edges, 4)


@query(
    "L03_path_counts",
    f"""select target_table_name, target_column_name, 1 + (target_table_name2 is not null)::int + (target_table_name3 is not null)::int + (target_table_name4 is not null)::int as hops,
        count(*) as paths from ({_WIDE}) group by 1, 2, 3""",
)
def _(t: Tables):
    return lineage.path_counts(t.edges)


@query(
    "L04_table_edges",
    "select distinct substring(target_table_name, 7) as target_table_name, substring(source_table_name, 7) as source_table_name from {edges} e",
)
def _(t: Tables):
    return lineage.table_edges(t.edges)


@query("L05_graph_nodes", "select distinct target_column_name as node from {edges} e union select source_column_name from {edges} e2")
def _(t: Tables):
    # the same operator on row level, where the graph grows with the tables
    rows = t.edges.select(
        F.col("target_column_name").alias("target_table_name"), F.col("source_column_name").alias("source_table_name")
    )
    return lineage.graph_nodes(rows)


_DOT = """with p as (select distinct substring(target_table_name, 7) as a, substring(source_table_name, 7) as b from {edges} e)
       select 1 as section, ' "' || n || '" [shape="ellipse" style="filled" fillcolor="#1f77b4"]' as line from (select a as n from p union select b from p)
       union all select 2, ' "' || a || '" -> "' || b || '" [fillcolor="#a6cee3" color="#1f78b4"]' from p
       union all select 0, 'strict digraph {' union all select 3, ' }'"""


@query("L06_dot_lines", _DOT)
def _(t: Tables):
    return lineage.dot_lines(lineage.table_edges(t.edges))


@query(
    "L07_lineage_roots",
    _REACH + " select distinct tt as target_table_name, tc as target_column_name, st as source_table_name, sc as source_column_name "
    "from r where (st, sc) not in (select (tt, tc) from e)",
)
def _(t: Tables):
    return lineage.roots(lineage.closure(t.edge_rows, computed=True))


@query("Q03_type_reconciliation", _rematch_sql(f"contains({_NO_.format('ColumnNameDbx')}, {_NO_.format('name')}) or contains({_NO_.format('name')}, {_NO_.format('ColumnNameDbx')})"))
def _(t: Tables):
    return reconcile.type_reconciliation(t.source_meta, t.target_meta, t.objects)


# One line per target over all its paths: small enough to be compared, and every path has a part in it.
_PATH = "concat_ws('>', " + ", ".join(f"{c}{'' if i == 1 else i}" for i in range(1, 5) for c in _EDGE[2:4]) + ")"
_DIGEST = f"target_table_name, target_column_name, count(*) as paths, count(target_table_name2) as longer, min({_PATH}) as least, max({_PATH}) as greatest"


def _digest(wide):
    return wide.selectExpr("*", f"{_PATH} as path").groupBy("target_table_name", "target_column_name").agg(
        F.count(F.lit(1)).alias("paths"), F.count("target_table_name2").alias("longer"), F.min("path").alias("least"), F.max("path").alias("greatest")
    )


@query(
    "Q04_full_lineage",
    f"select 'path' as part, concat_ws('|', target_table_name, target_column_name, paths, longer, least, greatest) as line from (select {_DIGEST} from ({_WIDE}) group by 1, 2) union all "
    "select 'pair', concat_ws('|', tt, tc, st, sc, depth) from (" + _REACH + " select tt, tc, st, sc, min(depth) as depth from r group by all) union all "
    "select 'root', concat_ws('|', tt, tc, st, sc) from (" + _REACH + " select distinct tt, tc, st, sc from r where (st, sc) not in (select (tt, tc) from e)) union all "
    "select 'graph', concat_ws('|', section, line) from (" + _DOT + ")",
)
def _(t: Tables):
    found = reconcile.full_lineage(t.edge_rows, 4)
    parts = {"path": _digest(found.wide), "pair": found.closure, "root": found.roots, "graph": found.dot}
    lines = [
        df.select(F.lit(name).alias("part"), F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]).alias("line"))
        for name, df in parts.items()
    ]
    return reduce(DataFrame.unionByName, lines)


@query(
    "Q05_registry_refresh",
    """with keyed as (select *, 'DF' || (p_partkey % 48) as flow, p_type || '.calculationview' as file from part),
       old as (select flow, file, 'old ' || min(p_name) as sap, min(p_brand) as grp from keyed where p_type <> 'PROMO' group by 1, 2),
       new as (select flow, file, case min(p_size) % 4 when 0 then min(p_name) when 1 then 'Error processing file: not well-formed' else 'Load of CV_' || replace(min(p_name), ' ', '_') end as sap
               from keyed where p_type <> 'SMALL' group by 1, 2)
       select coalesce(n.flow, o.flow) as DataFlow, coalesce(n.file, o.file) as SAPFileName, coalesce(n.sap, o.sap) as SAPTableName,
              case when n.file is null then 'old' else nullif(split_part(n.sap, 'CV_', 2), '') end as DataBricksTableName,
              case when o.file is not null then 'schema' end as SchemaName, case when n.file is null then 'Other' else 'HANA' end as SourceSystem,
              o.grp as group_id
       from old o full join new n on o.flow = n.flow and o.file = n.file""",
)
def _(t: Tables):
    flow = F.concat(F.lit("DF"), (F.col("p_partkey") % 48).cast("string"))
    keyed = t.part.withColumns({"flow": flow, "file": F.concat("p_type", F.lit(".calculationview"))})
    registry = keyed.filter("p_type <> 'PROMO'").groupBy("flow", "file").agg(F.min("p_name").alias("name"), F.min("p_brand").alias("group_id"))
    registry = registry.select(
        F.col("flow").alias("DataFlow"), F.col("file").alias("SAPFileName"), F.concat(F.lit("old "), "name").alias("SAPTableName"),
        F.lit("old").alias("DataBricksTableName"), F.lit("schema").alias("SchemaName"), F.lit("Other").alias("SourceSystem"), "group_id",
    )
    found = keyed.filter("p_type <> 'SMALL'").groupBy("flow", "file").agg(F.min("p_name").alias("name"), F.min("p_size").alias("size"))
    view = F.concat(F.lit("Load of CV_"), F.replace("name", F.lit(" "), F.lit("_")))
    description = F.when(F.col("size") % 4 > 0, view).otherwise(F.col("name"))
    xml = F.concat(F.lit('<v xmlns:d="urn:d"><d:descriptions defaultDescription="'), description, F.when(F.col("size") % 4 == 1, '"/>').otherwise('"/></v>'))
    root = named_files(t, found.select("flow", "file", xml.alias("value")), "registry")
    return reconcile.registry_refresh(registry, readers.inventory_with_descriptions(t.spark, root))
