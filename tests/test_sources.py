import pytest
from conftest import rows
from pyspark.sql import functions as F

from viewloom import session
from viewloom.operators.upsert import BUCKET, merge_table, replace_table, save_by_key, upsert
from viewloom.plans.reconcile import registry_refresh
from viewloom.sources import readers, writers


@pytest.fixture
def files(tmp_path):
    for name, text in {
        "DF1/a.calculationview": '<x xmlns:d="u"><d:descriptions defaultDescription="Load CV_A"/></x>',
        "DF1/sub/b.HTML": "<x/>",
        "DF2/c.txt": "<x>two\nlines</x>",
    }.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    return tmp_path


def test_documents_are_whole_files(spark, files):
    docs = readers.read_docs(spark, str(files))
    assert docs.count() == 3 and docs.filter("text like '%two\nlines%'").count() == 1


def test_inventory_and_registry(spark, files):
    inventory = readers.inventory_with_descriptions(spark, str(files))
    assert rows(inventory, "DataFlow", "FileName", "SourceSystem", "Description") == [
        ("DF1", "a.calculationview", "HANA", "Load CV_A"),
        ("DF1", "b.HTML", "BW", readers.NO_DESCRIPTION),
        ("DF2", "c.txt", "Other", readers.NO_DESCRIPTION),
    ]
    registry = spark.createDataFrame(
        [("DF2", "c.txt", "old", "old", "gold", "HANA", "g1")],
        "DataFlow string, SAPFileName string, SAPTableName string, DataBricksTableName string, SchemaName string, SourceSystem string, group_id string",
    )
    found = rows(registry_refresh(registry, inventory), "SAPFileName", "DataBricksTableName", "SchemaName", "group_id")
    assert found == [("a.calculationview", "A", None, None), ("b.HTML", None, None, None), ("c.txt", None, "gold", "g1")]


GOOD = ['<a><descriptions defaultDescription="x"/></a>', '\ufeff<?xml version="1.0" encoding="UTF-8"?>\n<a><d:descriptions xmlns:d="u" defaultDescription="x"/></a>\n']
BARE = ["<a/>", "<a><![CDATA[ <x> ]]></a>", "<!-- c --><x>two\nlines</x><!-- d -->", "<descriptions/>"]
BAD = ["<a><b></a>", "<a>", "plain", '<a x="1" x="2"/>', "<a>&nope;</a>", '<a><descriptions defaultDescription="x"/>', "<a b=c/>", "junk <a/>", '<a x="<"/>', "<a/></a>", "<a/><b>"]
JUNK = ["<a/>trail", "<a/><b/>"]
EMPTY = ["", "  \n", None, "\ufeff"]


def test_bad_xml_is_a_value(spark):
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(GOOD + BARE + BAD + JUNK + EMPTY)], "i int, xml string").repartition(3)
    found = docs.select("i", readers.xml_attribute(F.col("xml"), "descriptions", "defaultDescription").alias("d"), readers.xml_error(F.col("xml")).alias("e"))
    found = found.orderBy("i").collect()
    want = ["x"] * len(GOOD) + [readers.NO_DESCRIPTION] * len(BARE)
    want += [readers.NOT_READ + e for e, group in (("not well-formed", BAD), ("junk after document element", JUNK), ("no element found", EMPTY)) for _ in group]
    assert [r.d for r in found] == want
    assert [r.e is None for r in found] == [i < len(GOOD) + len(BARE) for i in range(len(want))]


def test_bad_files_in_inventory(spark, files):
    (files / "DF2/bad.calculationview").write_text('<x><descriptions defaultDescription="cut')
    (files / "DF2/empty.html").write_text("\n")
    inventory = readers.inventory_with_descriptions(spark, str(files))
    found = {r.FileName: r.Description for r in inventory.collect()}
    assert found["bad.calculationview"] == readers.NOT_READ + "not well-formed"
    assert found["empty.html"] == readers.NOT_READ + "no element found" and found["a.calculationview"] == "Load CV_A"


def test_csv_types(spark, tmp_path):
    (tmp_path / "m.csv").write_text("name,n\na,1\nb,2\n")
    assert readers.read_mapping_csv(spark, str(tmp_path / "m.csv")).dtypes == [("name", "string"), ("n", "int")]
    assert readers.read_mapping_csv(spark, str(tmp_path / "m.csv"), "name string, n long").dtypes[1] == ("n", "bigint")


def test_jdbc_is_one_partitioned_query():
    options = readers.view_columns_options("jdbc:x", "PKG.O'X", partitions=4, user="u")
    assert "JOIN SYS.VIEWS" in options["dbtable"] and "LIKE 'PKG.O''X%'" in options["dbtable"]
    assert (options["partitionColumn"], options["numPartitions"], options["user"]) == ("POSITION", "4", "u")


def test_local_rows(spark):
    df = readers.frame_from_rows(spark, [("s", "p/v", "c", 1, "DATE")], readers.SOURCE_COLUMN_SCHEMA)
    assert df.dtypes[3] == ("DATA_TYPE_ID", "int")


def test_catalog_harvest_skips_equal_views(spark):
    spark.sql("create database if not exists harvest")
    writers.save(spark.range(1).withColumn("amount", F.lit(1).cast("decimal(5,2)")), "harvest.facts")
    writers.save(spark.range(2), "harvest.other")
    spark.sql("create or replace view harvest.facts_v as select id from harvest.facts")
    spark.range(1).withColumn("amount", F.lit(1).cast("decimal(5,2)")).createOrReplaceTempView("facts")
    # views of the session are listed in every database, those of other tests too
    got = readers.catalog_columns(spark, ["harvest"]).filter("object_name in ('FACTS', 'OTHER', 'FACTS_V')")
    spark.catalog.dropTempView("facts")
    assert rows(got, "object_type", "object_name", "column_name", "data_type") == [
        ("TABLE", "FACTS", "AMOUNT", "DECIMAL(5,2)"),
        ("TABLE", "FACTS", "ID", "BIGINT"),
        ("TABLE", "OTHER", "ID", "BIGINT"),
        ("VIEW", "FACTS_V", "ID", "BIGINT"),
    ]


def test_tables(spark):
    writers.ensure_table(spark, "run_params", writers.RUN_PARAMETERS_DDL, writers.RUN_PARAMETERS_COMMENT)
    params = spark.createDataFrame([("k", 1)], "name string, value int")
    writers.snapshot_params(params, 3, "demo").write.mode("append").insertInto("run_params")
    row = spark.table("run_params").first()
    assert (row.RUN_ID, row.PARAMS_JSON, row.COMMENT) == (3, '{"name":"k","value":1}', None) and row.INSERTED_AT is not None
    writers.ensure_table(spark, "run_params", writers.RUN_PARAMETERS_DDL, replace=True)
    assert spark.table("run_params").isEmpty()


def test_replace_table_that_the_query_reads(spark):
    writers.save(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), "registry")
    changes = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    replace_table(spark, upsert(spark.table("registry"), changes, ["k"]), "registry")
    assert rows(spark.table("registry")) == [(1, "a"), (2, "c"), (3, "d")]


def _files(spark, name):
    return {r[0] for r in spark.table(name).select("_metadata.file_path").distinct().collect()}


def test_merge_leaves_other_buckets_alone(spark):
    rows_of = [(i, f"v{i}", i % 3) for i in range(200)]
    save_by_key(spark.createDataFrame(rows_of, "k int, v string, w int"), "merged", ["k"], buckets=16)
    before = _files(spark, "merged")
    changes = spark.createDataFrame([(5, "new"), (1000, "more"), (None, "x"), (None, "y")], "k int, v string")
    hit = {r[0] for r in changes.selectExpr("cast(pmod(xxhash64(k), 16) as int)").collect()}
    merge_table(changes, "merged")
    after = _files(spark, "merged")
    bucket = lambda path: int(path.split(f"{BUCKET}=")[1].split("/")[0])
    assert {f for f in before if bucket(f) not in hit} == {f for f in after if bucket(f) not in hit}
    assert not {f for f in before if bucket(f) in hit} & after
    want = [(i, "new" if i == 5 else v, w) for i, v, w in rows_of] + [(1000, "more", None), (None, "x", None), (None, "y", None)]
    assert rows(spark.table("merged").drop(BUCKET)) == sorted(want, key=lambda t: [(v is not None, str(v)) for v in t])


def test_a_repeated_source_key_raises_and_changes_nothing(spark):
    save_by_key(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), "repeated", ["k"], buckets=4)
    twice = spark.createDataFrame([(2, "c"), (2, "d")], "k int, v string")
    with pytest.raises(Exception, match="repeats the key"):
        merge_table(twice, "repeated")
    assert rows(spark.table("repeated").drop(BUCKET)) == [(1, "a"), (2, "b")]
    with pytest.raises(Exception, match="repeats the key"):
        upsert(spark.table("repeated").drop(BUCKET), twice, ["k"]).collect()
    writers.save(twice, "plain")
    with pytest.raises(ValueError, match="save_by_key"):
        merge_table(twice, "plain")


def test_checkpoint_folder_comes_from_the_session(spark):
    assert session.ensure_checkpoint_dir(spark).startswith(("file:" + spark.conf.get("spark.checkpoint.dir"), spark.conf.get("spark.checkpoint.dir")))
