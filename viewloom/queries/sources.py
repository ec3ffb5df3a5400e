"""Sources and sinks that can run on the test tables (ids S); the others are covered by unit tests."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from viewloom.queries.base import Tables, query
from viewloom.session import materialize, scratch_path
from viewloom.sources import readers, writers


def _scratch(t: Tables, name: str) -> str:
    return scratch_path(t.spark, name)


# Pages of one file: files stay small, and their number grows with the table.
_BLOCK = 200


def _block() -> Column:
    return F.floor(F.col("page_id") / _BLOCK)


def _flow() -> Column:
    return F.concat(F.lit("DF"), (_block() % 48).cast("string"))


@query(
    "S01_read_documents",
    f"""select 'DF' || (page_id // {_BLOCK} % 48) as flow, page_id // {_BLOCK} as block,
       string_agg(lpad(page_id::varchar, 9, '0') || html, chr(10) order by page_id) || chr(10) as text from pages group by 1, 2""",
)
def _(t: Tables):
    value = F.concat(F.lpad(F.col("page_id").cast("string"), 9, "0"), "html")
    rows = t.pages.select(_flow().alias("flow"), F.concat(F.lit("pages_"), _block().cast("string"), F.lit(".html")).alias("file"), value.alias("value"))
    docs = readers.read_docs(t.spark, named_files(t, rows, "docs"))
    return docs.select(F.regexp_extract("path", "(DF[0-9]+)/", 1).alias("flow"), F.regexp_extract("path", "pages_([0-9]+)", 1).cast("long").alias("block"), "text")


@query("S02_read_csv", "select p_partkey, p_name, p_size, p_retailprice from part")
def _(t: Tables):
    path = _scratch(t, "csv")
    t.part.select("p_partkey", "p_name", "p_size", "p_retailprice").write.csv(path, header=True)
    return readers.read_mapping_csv(t.spark, path)


@query("S03_table_scan", "select o_orderstatus, count(*) as n from orders group by 1")
def _(t: Tables):
    readers.register_views({"viewloom_scan_orders": t.orders})
    return t.spark.table("viewloom_scan_orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("S08_temp_view", "select c_mktsegment, max(c_acctbal) as top from customer group by 1")
def _(t: Tables):
    readers.register_views({"viewloom_customers": t.customer})
    return t.spark.sql("select c_mktsegment, max(c_acctbal) as top from viewloom_customers group by c_mktsegment")


@query(
    "S10_run_parameters",
    """select 7 as "RUN_ID", 'demo' as "DOMAIN", '{"c_custkey":' || c_custkey || ',"c_mktsegment":"' || c_mktsegment || '"}' as "PARAMS_JSON",
       'test' as "COMMENT" from customer""",
)
def _(t: Tables):
    return writers.snapshot_params(t.customer.select("c_custkey", "c_mktsegment"), 7, "demo", "test").drop("INSERTED_AT")


_FILES = f"""select 'DF' || (page_id // {_BLOCK} % 48) as flow,
    'pages_' || (page_id // {_BLOCK}) || case page_id // {_BLOCK} % 3 when 0 then '.calculationview' when 1 then '.html' else '.txt' end as file from pages"""


def named_files(t: Tables, rows, name: str) -> str:
    """Write rows (flow, file, value) as text files below a folder per flow; Spark names its files, so they are renamed."""
    path = _scratch(t, name)
    rows.repartition("flow", "file").sortWithinPartitions("flow", "file", "value").write.partitionBy("flow", "file").text(path)
    hadoop = t.spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    files = root.getFileSystem(t.spark._jsc.hadoopConfiguration())
    for found in files.globStatus(hadoop.Path(root, "flow=*/file=*/part-*")):
        part = found.getPath()
        flow, file = part.getParent().getParent().getName().removeprefix("flow="), part.getParent().getName().removeprefix("file=")
        files.mkdirs(hadoop.Path(root, flow))
        files.rename(part, hadoop.Path(root, f"{flow}/{file}"))
    for left in files.globStatus(hadoop.Path(root, "flow=*")):
        files.delete(left.getPath(), True)
    return path


@query(
    "S11_file_inventory",
    f"""select flow as DataFlow, file as FileName, case when file like '%view' then 'HANA' when file like '%html' then 'BW' else 'Other' end as SourceSystem
       from (select distinct * from ({_FILES}))""",
)
def _(t: Tables):
    kind = F.when(_block() % 3 == 0, ".calculationview").when(_block() % 3 == 1, ".html").otherwise(".txt")
    name = F.concat(F.lit("pages_"), _block().cast("string"), kind)
    rows = t.pages.select(_flow().alias("flow"), name.alias("file"), F.col("html").alias("value"))
    return readers.file_inventory(t.spark, named_files(t, rows, "files")).drop("path")


@query("S05_overwrite_table", "select p_partkey, p_name, p_size from part")
def _(t: Tables):
    name = "viewloom_s05_part"
    writers.save(t.part.select("p_partkey", "p_name"), name)
    writers.save(t.part.select("p_partkey", "p_name", "p_size"), name)  # the second run replaces rows and columns
    return _taken(t, name)


def _taken(t: Tables, name: str):
    """The rows of a table, which is dropped."""
    rows = materialize(t.spark.table(name), name)
    t.spark.sql(f"DROP TABLE {name}")
    return rows


@query(
    "S06_local_parameters",
    """select c_custkey, label from customer join (values ('BUILDING', 'b'), ('MACHINERY', 'm')) p(segment, label) on c_mktsegment = segment""",
)
def _(t: Tables):
    parameters = readers.frame_from_rows(t.spark, [("BUILDING", "b"), ("MACHINERY", "m")], ["c_mktsegment", "label"])
    return t.customer.join(parameters, "c_mktsegment").select("c_custkey", "label")


@query(
    "S07_catalog_columns",
    """select 'TABLE' as object_type, 'VIEWLOOM_S07_' || upper(table_name) as object_name, upper(column_name) as column_name,
       case data_type when 'VARCHAR' then 'STRING' when 'INTEGER' then 'INT' when 'TIMESTAMP' then 'TIMESTAMP_NTZ' else data_type end as data_type
       from information_schema.columns where table_name in ('nation', 'orders')""",
)
def _(t: Tables):
    for table in ("nation", "orders"):
        writers.save(getattr(t, table), f"viewloom_s07_{table}")
    found = readers.catalog_columns(t.spark, [t.spark.catalog.currentDatabase()]).filter("object_name like 'VIEWLOOM_S07%'")
    for table in ("nation", "orders"):
        t.spark.sql(f"DROP TABLE viewloom_s07_{table}")
    return found.select("object_type", "object_name", "column_name", "data_type")


@query(
    "S09_create_table",
    """select target_table_name as "TARGET_TABLE_NAME", target_column_name as "TARGET_COLUMN_NAME", source_table_name as "SOURCE_TABLE_NAME",
       source_column_name as "SOURCE_COLUMN_NAME", transformation as "TRANSFORMATION" from {edges} e""",
)
def _(t: Tables):
    name = "viewloom_s09_lineage"
    writers.ensure_table(t.spark, name, writers.LINEAGE_DDL, "Column lineage", replace=True)
    t.edges.write.insertInto(name)
    return _taken(t, name)


@query(
    "S12_xml_attribute",
    """select p_partkey, case p_size % 10 when 1 then 'Error processing file: not well-formed' when 2 then 'Error processing file: no element found'
         when 3 then 'Error processing file: junk after document element' when 4 then 'Error processing file: not well-formed'
         else case when p_size > 25 then 'Load of ' || p_name else 'Descriptions tag not found' end end as description from part""",
)
def _(t: Tables):
    tag = F.concat(F.lit('<x:descriptions defaultDescription="Load of '), "p_name", F.lit('"/><descriptions defaultDescription="no"/>'))
    body = F.when(F.col("p_size") > 25, tag).otherwise("<other/>")
    xml = F.concat(F.lit('<?xml version="1.0"?><a xmlns:x="urn:x"><b>'), body, F.lit("</b></a>\n"))
    bad = F.col("p_size") % 10
    broken = F.when(bad == 1, F.expr("left({0}, length({0}) - 3)".format("xml"))).when(bad == 2, F.lit(" ")).when(bad == 3, F.concat("xml", F.lit("<more/>")))
    broken = broken.when(bad == 4, F.replace("xml", F.lit("</b>"), F.lit("</c>"))).otherwise(F.col("xml"))
    docs = t.part.withColumn("xml", xml).withColumn("xml", broken)
    return docs.select("p_partkey", readers.xml_attribute(F.col("xml"), "descriptions", "defaultDescription").alias("description"))


@query("S13_dated_output", "select page_id, length(html) as n, date '2024-05-02' as run_date from pages")
def _(t: Tables):
    path = _scratch(t, "dated")
    rows = t.pages.select("page_id", F.length("html").alias("n"))
    writers.write_dated(rows.limit(0), path, "2024-05-01")
    writers.write_dated(rows.withColumn("n", F.lit(0)), path, "2024-05-02")
    writers.write_dated(rows, path, "2024-05-02")  # a second run of the day replaces the first
    return t.spark.read.parquet(path)
