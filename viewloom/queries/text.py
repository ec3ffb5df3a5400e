"""Text and document jobs (ids T)."""

from __future__ import annotations

from pyspark.sql import functions as F

from viewloom.functions import text as tx
from viewloom.operators import relational as rel, text as ops, usage
from viewloom.operators.metadata import build_lookup
from viewloom.queries.base import Tables, query

_TRIM = "regexp_replace({0}, '^\\s+|\\s+$', '', 'g')"


@query(
    "T01_strip_fences",
    "select conv_id, turn, replace(replace('```sql' || chr(10) || text || '`x`' || chr(10) || '```', '```sql', ''), '`', '') as cleaned "
    "from conversations",
)
def _(t: Tables):
    fenced = F.concat(F.lit("```sql\n"), "text", F.lit("`x`\n```"))
    return t.conversations.select("conv_id", "turn", tx.strip_fences(fenced).alias("cleaned"))


@query(
    "T02_split_statements",
    f"""select doc_id, unnest(range(1, len(l) + 1)) as stmt_no, unnest(l) as stmt from (
        select doc_id, list_filter([{_TRIM.format('x')} for x in string_split(replace(text, '.', ' ; '), ';')], lambda s: s <> '') as l
        from documents) where len(l) > 0""",
)
def _(t: Tables):
    scripts = t.documents.select("doc_id", F.replace("text", F.lit("."), F.lit(" ; ")).alias("text"))
    return ops.split_statements(scripts, "doc_id", "text")


@query(
    "T03_split_blocks",
    f"""select doc_id, unnest(range(1, len(l) + 1)) as stmt_no, unnest(l) as stmt from (
        select doc_id, [case when ends_with(s, ';') then s else s || ';' end for s in
          list_filter([{_TRIM.format('x')} for x in regexp_split_to_array({_TRIM.format("replace(text, '. ', ';' || chr(10) || chr(10))")}, ';\\s*\\n\\s*\\n')],
                      lambda s: s <> '')] as l
        from documents) where len(l) > 0""",
)
def _(t: Tables):
    scripts = t.documents.select("doc_id", F.replace("text", F.lit(". "), F.lit(";\n\n")).alias("text"))
    return ops.split_statements(scripts, "doc_id", "text", blocks=True)


_SCRIPT = "'SELECT ' || p_name || ', T.' || upper(replace(p_name, ' ', ' , ')) || ' FROM ' || p_type || '_' || p_brand"


@query(
    "T04_apply_mapping",
    f"""with recursive words as (select upper(split_part(p_name, ' ', 1)) as key, min(p_partkey) as ordinal,
                  arg_max(split_part(p_name, ' ', 2) || '_' || split_part(p_name, ' ', 1), p_partkey) as value from part group by 1),
       w as (select key, value, row_number() over (order by ordinal, key) as no from words),
       tabs as (select p_type as key, lower(p_type) as value, row_number() over (order by min(p_partkey), p_type) as no from part group by p_type),
       r as (select p_partkey, 1 as no, {_SCRIPT} as text from part
             union all select p_partkey, r.no + 1, regexp_replace(text, '(?i)\\b' || key || '\\b', value, 'g') from r join w on r.no = w.no),
       q as (select p_partkey, 1 as no, text from r where no = (select count(*) + 1 from w)
             union all select p_partkey, q.no + 1, replace(text, key, value) from q join tabs on q.no = tabs.no)
       select p_partkey, text from q where no = (select count(*) + 1 from tabs)""",
)
def _(t: Tables):
    words = t.part.select(
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("sap"),
        F.concat_ws("_", F.split_part("p_name", F.lit(" "), F.lit(2)), F.split_part("p_name", F.lit(" "), F.lit(1))).alias("dbx"),
        "p_partkey",
        "p_type",
        F.lower("p_type").alias("lower_type"),
    )
    fields = build_lookup(words, "sap", "dbx", "p_partkey")
    tables = build_lookup(words, "p_type", "lower_type", "p_partkey", fold=False)
    scripts = t.sql(f"select p_partkey, {_SCRIPT} as text from {{part}}")
    # small slices, so that the test crosses their borders
    renamed = ops.apply_mapping(scripts, "text", fields, slice_size=5)
    return ops.apply_mapping(renamed, "text", tables, whole_words=False)


_DDL = """'CREATE TABLE t' || cast(p_partkey as varchar(20)) || chr(10) || '(' || chr(10) || '    ' || case when p_partkey % 3 = 0 then 'x_' else '' end || replace(p_name, ' ', '_') || ' STRING,'
  || chr(10) || '  size_' || cast(p_size as varchar(20)) || ' DECIMAL(5, 0),' || chr(10) || '    ' || upper(case when p_partkey % 3 = 0 then 'x_' else '' end || replace(p_name, ' ', '_'))
  || '   DATE' || chr(10) || ')'"""


@query(
    "T05_annotate_ddl",
    """with known as (select replace(p_name, ' ', '') as k, arg_max(p_type, p_partkey) as v from part group by 1),
       n as (select p_partkey, p_size, case when p_partkey % 3 = 0 then 'x_' else '' end || replace(p_name, ' ', '_') as f1 from part),
       f as (select p_partkey, p_size, f1, v, rpad(f1, greatest(18, length(f1))::int, ' ') as pad from n left join known on replace(f1, '_', '') = k)
       select p_partkey, 'CREATE TABLE t' || p_partkey || chr(10) || '(' || chr(10)
         || case when v is null then '    ' || f1 || ' STRING,' else '    ' || pad || ' STRING COMMENT(''' || v || '''),' end || chr(10)
         || '  size_' || p_size || ' DECIMAL(5, 0),' || chr(10)
         || case when v is null then '    ' || upper(f1) || '   DATE' else '    ' || upper(pad) || ' DATE COMMENT(''' || v || ''')' end
         || chr(10) || ')' as text,
         case when v is null then 0 else 2 end as comments_added, 4 as fields_processed from f""",
)
def _(t: Tables):
    ddl = t.sql(f"select p_partkey, {_DDL} as text from {{part}}")
    known = t.part.select(
        F.replace("p_name", F.lit(" "), F.lit("")).alias("key"), F.col("p_type").alias("value"), F.col("p_partkey").alias("ordinal")
    )
    return ops.annotate_ddl(ddl, "p_partkey", "text", known)


@query(
    "T06_clean_html",
    "select page_id, regexp_replace(regexp_replace(html, '(?is)<head>.*?</head>', '', 'g'), '(?is)<img.+?>', '', 'g') as html from pages",
)
def _(t: Tables):
    return t.pages.select("page_id", tx.clean_html(F.col("html")).alias("html"))


# One exported document per supplier: outer table, grid with a header, a two-cell row, and two sections.
_GRID = """'<table border="0" class="wide SAPBEXTableGrid"><tr><td>Object Type</td><td>Name</td><td>Technical Name</td></tr>'
  || '<tr><td>Data Source</td><td>sys/pkg::CV_' || s_name || '</td><td> T' || cast(s_suppkey as varchar(20)) || '   SYS HANA&amp;Co </td></tr>'
  || '<tr><td> </td><td><b>second</b><table><tr><td>in</td><td>a</td><td>cell</td></tr></table></td><td>D' || cast(s_suppkey as varchar(20)) || '</td></tr><tr><td>two</td><td>cells</td></tr>'
  || '<tr><td>Transformation</td><td>load</td><td>TR' || cast(s_suppkey as varchar(20)) || '</td></tr>'
  || '<tr><td></td><td>load 2</td><td>TX' || cast(s_suppkey as varchar(20)) || '</td></tr></table>'"""
_HTML = f"""'<html><body>{tx.OUTER_TABLE}<tr><td>' || s_name || '</td></tr></table>' || {_GRID}
  || '{tx.SECTION_TABLE}<tr><td><a name="TRFNTR' || cast(s_suppkey as varchar(20)) || '">x</a><table><tr><td>inner</td></tr></table></td></tr></table><p>'
  || '{tx.SECTION_TABLE}<tr><td><a name="TRFNOTHER"></a></td></tr></table></body></html>'"""


def _pages(t: Tables):
    return t.sql(f"select s_suppkey, {_HTML} as html from {{supplier}}")


@query(
    "T07_first_table",
    f"select s_suppkey, '{tx.OUTER_TABLE}<tr><td>' || s_name || '</td></tr></table>' as first_table from supplier",
)
def _(t: Tables):
    return _pages(t).select("s_suppkey", tx.first_table(F.col("html")).alias("first_table"))


_ROWS = """select s_suppkey, 1 as row_no, 'Data Source' as object_type, 'sys/pkg::CV_' || s_name as name, 'T' || s_suppkey || '   SYS HANA&Co' as technical_name from supplier
  union all select s_suppkey, 2, 'Data Source', 'second in a cell', 'D' || s_suppkey from supplier
  union all select s_suppkey, 3, 'Transformation', 'load', 'TR' || s_suppkey from supplier
  union all select s_suppkey, 4, 'Transformation', 'load 2', 'TX' || s_suppkey from supplier"""


@query("T08_table_rows", _ROWS)
def _(t: Tables):
    return ops.table_rows(_pages(t), "s_suppkey", "html")


@query(
    "T09_split_source",
    f"""select s_suppkey, row_no, object_type, name, case when row_no = 1 then 'T' || s_suppkey else technical_name end as technical_name,
        case when row_no = 1 then 'SYS HANA&Co' else '' end as source_system, case when row_no = 1 then 'CV_' || split_part(name, 'CV_', 2) else '' end as hana_view
        from ({_ROWS})""",
)
def _(t: Tables):
    return ops.split_source(ops.table_rows(_pages(t), "s_suppkey", "html"))


@query("T10_transformation_names", f"select s_suppkey, technical_name as name from ({_ROWS}) where row_no in (3, 4)")
def _(t: Tables):
    return ops.transformation_names(ops.table_rows(_pages(t), "s_suppkey", "html"), "s_suppkey")


@query(
    "T11_anchored_sections",
    f"""select s_suppkey, 'TR' || s_suppkey as name, '{tx.SECTION_TABLE}<tr><td><a name="TRFNTR' || s_suppkey
        || '">x</a><table><tr><td>inner</td></tr></table></td></tr></table>' as section from supplier""",
)
def _(t: Tables):
    pages = _pages(t)
    names = ops.transformation_names(ops.table_rows(pages, "s_suppkey", "html"), "s_suppkey")
    return ops.anchored_sections(pages, "s_suppkey", "html", names)


_BLOCK = """'Routine ' || p_brand || ' code Required Objects Object Type Name Technical Name Routine Technical Name: ' || p_name
  || ' Description (Short): ' || p_type || case when p_size > 10 then ' Description (Long): long ' || p_name || ' Object Version: 1' else '' end
  || ' Source: S' || cast(p_partkey as varchar(20)) || ' Target: TARGET_' || lpad(cast(p_partkey as varchar(20)), 20, '0')"""


@query(
    "T12_labelled_fields",
    """select p_partkey, p_name as technical_name, case when p_size > 10 then p_type end as short_description,
       case when p_size > 10 then 'long ' || p_name end as long_description, 'S' || p_partkey as source, p_brand || ' code' as routine,
       'TARGET_' || left(lpad(cast(p_partkey as varchar), 20, '0'), 13) as target from part""",
)
def _(t: Tables):
    return ops.labelled_fields(t.sql(f"select p_partkey, {_BLOCK} as block from {{part}}"), "p_partkey", "block")


# One rule table of ten rows per part; what a row is goes by the part and its place.
_KIND = "cast((p_partkey * 5 + {j} * 3 + floor(p_partkey / 8)) as bigint) % 8"
_NOTE = "(case when ({k}) = 4 then 'Constant ' else 'Note ' end || cast(p_partkey as varchar(20)) || '.{j}')"
_FIELD = "case when ({k}) = 0 then 'Unit Info x' when ({k}) = 1 then '' else 'F{j}' end"


def _rule_row(j: int) -> str:
    """A note over all columns, a row of two cells, or a full row, whose third cell may span two columns."""
    kind = _KIND.format(j=j)
    described = f"case when ({kind}) = 2 then '<td colspan=\"2\">d</td>' else '<td>d</td><td>CHAR</td>' end"
    cells = ["'8'", f"case when ({kind}) = 6 then '' else 'Routine' end", "'t'", f"case when ({kind}) = 1 then '' else 'I' end",
             "''", "''", "''"]
    row = " || '</td><td>' || ".join(cells)
    field = _FIELD.format(k=kind, j=j)
    return (
        f"case when ({kind}) in (3, 4) then '<tr><td colspan=\"11\">' || {_NOTE.format(k=kind, j=j)} || '</td></tr>' "
        f"when ({kind}) = 5 then '<tr><td>old{j}</td><td>F{j}</td></tr>' "
        f"else '<tr><td>old{j}</td><td>' || {field} || '</td>' || {described} || '<td>' || {row} || '</td></tr>' end"
    )


_RULE_HTML = " || ".join(_rule_row(j) for j in range(1, 11))


@query(
    "T13_tidy_rules",
    f"""with r as (select p_partkey, j, {_KIND.format(j='j')} as kind from (select *, unnest(range(1, 11)) as j from part)),
        k as (select *, row_number() over (partition by p_partkey order by j desc) as e from r where kind not in (0, 1)),
        n as (select *, case when kind in (3, 4) then {_NOTE.format(k='kind', j="' || j || '")} end as note from k where e > 2),
        l as (select *, lead(note) over w as n1, lead(note, 2) over w as n2, lead(note, 3) over w as n3, lead(kind) over w in (5, 6) as hole
              from n window w as (partition by p_partkey order by j))
        select p_partkey, row_number() over (partition by p_partkey order by j) as rule_no, 'F' || j as "Field_name",
          coalesce(case when kind in (5, 6) then null when n1 is not null then n1 || case when n2 like '%Constant%' then chr(10) || n2 else '' end
            when hole then n2 || case when n3 like '%Constant%' then chr(10) || n3 else '' end end, 'old' || j) as "Logic",
          case when kind <> 5 then 'd' end as "Description", case when kind = 2 then 'd' when kind <> 5 then 'CHAR' end as "Data_Type",
          case when kind <> 5 then '8' end as "Length", case when kind not in (5, 6) then 'Routine' end as "Rule_Type", case when kind <> 5 then 't' end as "Target",
          case when kind <> 5 then 'I' end as "InfoObject", null as "Description1", null as "Data_Type1", null as "Length1"
        from l where note is null""",
)
def _(t: Tables):
    docs = t.sql(f"select p_partkey, {_RULE_HTML} as html from {{part}}", dealt=True)
    rules = ops.tidy_rules(ops.rule_cells(docs, "p_partkey", "html"), "p_partkey")
    return rules


_STATEMENT = """case when p_size % 2 = 0 then 'IT_A = select a.' || replace(p_name, ' ', '_') || ', b.width as w from tab_' || p_type || ' as a join dim_'
    || replace(p_brand, '#', '_') || ' b on a.key_' || cast(p_size as varchar(20)) || ' = b.key where a.flag = 1'
  else 'IT_B = SELECT ' || replace(p_name, ' ', '_') || ' as x, max(top_' || cast(p_size as varchar(20)) || ') as y from tab_' || p_type || ' where 1 = 1 -- b.none' || chr(10)
    || 'union all select Width from dim_' || replace(p_brand, '#', '_') end"""


@query(
    "T14_column_usage",
    f"""with u as (select 'tab_' || lower(p_type) as tab, lower(replace(p_name, ' ', '_')) as col from part
         union select 'tab_' || lower(p_type), case when p_size % 2 = 0 then 'key_' else 'top_' end || p_size from part
         union select 'tab_' || lower(p_type), 'flag' from part where p_size % 2 = 0
         union select 'dim_' || lower(replace(p_brand, '#', '_')), 'width' from part
         union select 'dim_' || lower(replace(p_brand, '#', '_')), 'key' from part where p_size % 2 = 0)
       select tab as table_name, (no - 1) // {rel.PART_SIZE} as part_no, string_agg(col, ',' order by col) as columns
       from (select *, row_number() over (partition by tab order by col) as no from u) group by 1, 2""",
)
def _(t: Tables):
    used = usage.column_usage(t.sql(f"select p_partkey, {_STATEMENT} as stmt from {{part}}"), "stmt")
    return used.select("table_name", "part_no", F.array_join("columns", ",").alias("columns"))


# One column of its own per part, so that each construct shows whether it was read: calls, comma joins, subselects, CTEs, correlation, unions inside.
_NESTED = """case p_size % 5
  when 0 then 'create view v as ( select round(c' || p_partkey || ', 2) as r, coalesce(d.e, 1.5) f from t' || p_size || ' d )'
  when 1 then 'select x.c' || p_partkey || ' from (select c' || p_partkey || ', b3 as c9 from t' || p_size || ' where k = ''from u'') x, u' || p_size || ' where u' || p_size || '.k = x.c9'
  when 2 then 'with w as (select c' || p_partkey || ' from t' || p_size || ' union select b2 from u' || p_size || ' /* a.b */) select w.c1, v.g from w join (t' || p_size || ' v join u' || p_size || ' on v.h = u' || p_size || '.i) on w.c1 = v.j'
  when 3 then 'select a.c' || p_partkey || ' from t' || p_size || ' a where exists (select 1 from u' || p_size || ' b where b.k = a.m and a.n in (1, 2)) -- a.o'
  else 'select c' || p_partkey || ', n from (select c' || p_partkey || ', sum(n) over (partition by q order by r desc) n from t' || p_size || ' union all select s, extract(year from z) from u' || p_size || ') y where y.n > 0' end"""


@query(
    "T14_nested_usage",
    f"""with p as (select p_partkey as k, p_size as s, p_size % 5 as m from part),
       u as (select 't' || s as tab, 'c' || k as col from p
         union select 't' || s, unnest(case m when 0 then ['e'] when 1 then ['b3'] when 2 then ['g', 'h', 'j'] when 3 then ['m', 'n'] else ['n', 'q', 'r'] end) from p
         union select 'u' || s, unnest(case m when 1 then ['k'] when 2 then ['b2', 'i'] when 3 then ['k'] when 4 then ['s', 'z'] else [] end) from p)
       select tab as table_name, (no - 1) // {rel.PART_SIZE} as part_no, string_agg(col, ',' order by col) as columns
       from (select *, row_number() over (partition by tab order by col) as no from u) group by 1, 2""",
)
def _(t: Tables):
    used = usage.column_usage(t.sql(f"select p_partkey, {_NESTED} as stmt from {{part}}"), "stmt")
    return used.select("table_name", "part_no", F.array_join("columns", ",").alias("columns"))


@query(
    "T15_pack_by_budget",
    """with recursive lines as (select doc_id, unnest(range(1, len(l) + 1)) as no, unnest(l) as line
                                from (select doc_id, string_split(text, chr(10)) as l from documents)),
       s as (select doc_id, no, len(list_filter(regexp_split_to_array(line, '\\s+'), lambda w: w <> '')) as size from lines),
       r as (select doc_id, no, size, 1 as grp, size as used from s where no = 1
             union all select s.doc_id, s.no, s.size, case when 10 + used + s.size > 60 then grp + 1 else grp end,
                              case when 10 + used + s.size > 60 then s.size else used + s.size end
             from r join s on r.doc_id = s.doc_id and s.no = r.no + 1)
       select doc_id, no as piece_no, grp as group_no, size from r""",
)
def _(t: Tables):
    sized = t.documents.select("doc_id", ops.word_sizes(F.col("text")).alias("sizes"))
    return ops.pack_by_budget(sized, "doc_id", "sizes", base=F.lit(10), budget=60)


_XML = """case when p_size % 2 = 0 then '<Calculation:scenario xmlns:xsi="i" xmlns:Calculation="c"><calculationViews><!-- <calculationView id="no"/> -->'
    || '<calculationView xsi:type=' || chr(39) || 'Calculation:ProjectionView' || chr(39) || ' id="P&amp;' || p_brand || '"><calculatedViewAttributes><calculatedViewAttribute id="c1">'
    || '<formula>a &lt; ' || cast(p_size as varchar(20)) || '</formula></calculatedViewAttribute></calculatedViewAttributes><input node="#' || p_type
    || '"><mapping xsi:type="Calculation:AttributeMapping" target="A" source="' || p_name || '"/><mapping xsi:type="x" source="B" target="C"/></input>'
    || '<filter>x = 1</filter></calculationView><calculationView id="J" joinType="leftOuter" xsi:type="Calculation:JoinView"><input node="#a">'
    || '<mapping target="K" source="K1"/></input><input node="#b"/><joinAttribute name="K"/></calculationView></calculationViews></Calculation:scenario>'
  else '<View:ColumnView xmlns:xsi="i" xmlns:View="v"><viewNode xsi:type="View:Aggregation" name="BASE"><element name="z"><calculationDefinition><formula>1</formula>'
    || '</calculationDefinition></element><element name="y"/><input><viewNode xsi:type="View:Projection">#/0/X</viewNode><mapping targetName="' || p_type || '" sourceName="S"/></input>'
    || '<elementFilter elementName="q"><valueFilter value="7"/></elementFilter><elementFilter elementName="r"><valueFilter><operands value="1"/><operands value="2"/></valueFilter></elementFilter>'
    || '</viewNode><viewNode xsi:type="View:JoinNode" name="JN"><join leftInput="l" joinType="inner"><leftElementName>' || p_brand || '</leftElementName><rightElementName>b</rightElementName></join></viewNode>'
    || '<viewNode xsi:type="View:Union" name="U"/></View:ColumnView>' end"""


@query(
    "T16_view_inventory",
    """with even as (select * from part where p_size % 2 = 0), odd as (select * from part where p_size % 2 = 1)
       select p_partkey, 1 as node_no, 'P&' || p_brand as node, 'Projection' as kind, 1 as item_no, 'input' as item, p_type as name, null as value from even
       union all select p_partkey, 1, 'P&' || p_brand, 'Projection', 2, 'mapping', 'A', p_name from even
       union all select p_partkey, 1, 'P&' || p_brand, 'Projection', 3, 'mapping', 'C', 'B' from even
       union all select p_partkey, 1, 'P&' || p_brand, 'Projection', 4, 'filter', null, 'x = 1' from even
       union all select p_partkey, 1, 'P&' || p_brand, 'Projection', 5, 'calculation', 'c1', 'a < ' || p_size from even
       union all select p_partkey, 2, 'J', 'Join', 1, 'join', 'leftOuter', null from even
       union all select p_partkey, 2, 'J', 'Join', 2, 'input', 'a', null from even
       union all select p_partkey, 2, 'J', 'Join', 3, 'input', 'b', null from even
       union all select p_partkey, 2, 'J', 'Join', 4, 'mapping', 'K', 'K1' from even
       union all select p_partkey, 2, 'J', 'Join', 5, 'join key', 'K', null from even
       union all select p_partkey, 1, 'BASE', 'Aggregation', 1, 'input', '/0/X', null from odd
       union all select p_partkey, 1, 'BASE', 'Aggregation', 2, 'mapping', p_type, 'S' from odd
       union all select p_partkey, 1, 'BASE', 'Aggregation', 3, 'filter', 'q', '7' from odd
       union all select p_partkey, 1, 'BASE', 'Aggregation', 4, 'filter', 'r', '1,2' from odd
       union all select p_partkey, 1, 'BASE', 'Aggregation', 5, 'calculation', 'z', '1' from odd
       union all select p_partkey, 2, 'JN', 'Join', 1, 'join', 'inner', null from odd
       union all select p_partkey, 2, 'JN', 'Join', 2, 'join key', p_brand, 'b' from odd
       union all select p_partkey, 3, 'U', 'Union', null, null, null, null from odd""",
)
def _(t: Tables):
    return ops.view_items(t.sql(f"select p_partkey, {_XML} as xml from {{part}}", dealt=True), "p_partkey", "xml")


@query(
    "T17_combine_group",
    f"""select grp as group_id, (no - 1) // {rel.PART_SIZE} as part_no, count(*) as n_members,
       string_agg('CV_DOC_' || lpad(cast(doc_id as varchar), 9, '0') || ' starts here' || chr(10) || chr(10) || text, chr(10) order by doc_id) as combined
       from (select *, row_number() over (partition by grp order by doc_id) as no
             from (select *, case when doc_id % 3 = 0 then 'hot' else cast(doc_id % 97 as varchar) || lang end as grp from documents)) group by 1, 2""",
)
def _(t: Tables):
    docs = t.documents.select(
        F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.concat((F.col("doc_id") % 97).cast("string"), "lang")).alias("grp"),
        ops.combined_name(F.concat(F.lit("X_DOC_"), F.lpad(F.col("doc_id").cast("string"), 9, "0"), F.lit(".txt"))).alias("name"), "text",
    )
    combined = rel.combine_group(docs, "grp", "name", "text")
    return combined.select(F.col("grp").alias("group_id"), "part_no", F.col("n_members").cast("long").alias("n_members"), "combined")


@query(
    "T18_classify_statement",
    "select doc_id, case when regexp_matches(lower(text), 'if|case|join|rank|union') then 'REVIEW' else 'ONLY_SELECT' end as tag from documents",
)
def _(t: Tables):
    return ops.classify_statements(t.documents, "text").select("doc_id", "tag")
