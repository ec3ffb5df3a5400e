import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from viewloom.functions.similarity import similarity
from viewloom.operators import metadata as md, names, relational as rel

FOLD = {
    "contains": lambda s: s,
    "bidir": lambda s: s.replace("_", ""),
    "bidir_noP": lambda s: s.replace("_", "").replace("P", ""),
}


@pytest.mark.parametrize("rule", names.RULES)
def test_names_against_all_pairs(spark, rule):
    rng = random.Random(11)
    make = lambda n: ["".join(rng.choice("AP_B") for _ in range(rng.randrange(1, n))) for _ in range(60)] + ["P", "_"]
    wanted, offered = make(5), make(9)
    fold = FOLD[rule]
    want = {}
    for name in set(wanted):
        hits = [c for c in offered if fold(name) in fold(c) or (rule != "contains" and fold(c) in fold(name))]
        want[name] = min(hits) if hits else None
    got = names.match_names(
        spark.createDataFrame([(w,) for w in wanted], "n string"), spark.createDataFrame([(o,) for o in offered], "c string"), rule
    )
    assert {r["name"]: r["matched"] for r in got.collect()} == want


@pytest.mark.parametrize(
    "left, right, score",
    [
        ("ABC", " abc", 1.0),
        ("polnr_p", "polnr", 0.9),
        ("polnr", "polnr_postalg", 0.8),
        ("ab", "ac", round(1 / 3 * 0.7 + 0.3, 6)),
        ("abcd", "xy", round(0.5 * 0.3, 6)),
        ("", "x", 0.0),
        (None, "x", 0.0),
        ("_p", "_r", 0.9),
    ],
)
def test_similarity(spark, left, right, score):
    df = spark.createDataFrame([(left, right)], "a string, b string")
    assert round(df.select(similarity(F.col("a"), F.col("b"))).first()[0], 6) == score


def test_reconciliation_is_three_valued(spark):
    source = spark.createDataFrame(
        [("CV", "tab", "A", "NVARCHAR"), ("CV", "tab", "B", "DECIMAL"), ("CV", "tab", "X", "DATE")],
        "CalculationViewName string, TableName string, COLUMN_NAME string, DATA_TYPE_NAME string",
    )
    target = spark.createDataFrame(
        [("c", "s", "TAB", "A", "STRING"), ("c", "s", "TAB", "B", "DECIMAL(10,2)"), ("c", "s", "TAB", "Y", "DATE")],
        "catalog_name string, schema_name string, object_name string, column_name string, data_type string",
    )
    report = md.reconcile_types(source, target)
    assert rows(report, "ColumnNameSAP", "ColumnNameDbx", "DataTypeMatch") == [
        (None, "Y", None), ("A", "A", True), ("B", "B", True), ("X", None, None),
    ]


def test_a_group_is_its_parts_in_order(spark):
    df = spark.range(2500).select(F.lit("g").alias("g"), F.lpad(F.col("id").cast("string"), 5, "0").alias("m"))
    small = spark.createDataFrame([("s", "b"), ("s", "a"), ("s", None), ("n", None)], "g string, m string")
    parts = rel.group_members(df.union(df).union(small), "g", "m", part_size=400).orderBy("g", "part_no").collect()
    whole = [p for p in parts if p["g"] == "g"]
    assert [p["part_no"] for p in whole] == list(range(7)) and {len(p["members"]) for p in whole[:-1]} == {400}
    assert [m for p in whole for m in p["members"]] == [f"{i:05d}" for i in range(2500)]
    assert [(p["g"], p["part_no"], p["members"]) for p in parts if p["g"] != "g"] == [("n", 0, []), ("s", 0, ["a", "b"])]


def test_combined_text_is_its_parts_in_order(spark):
    df = spark.range(230).select(F.lit("g").alias("g"), F.lpad(F.col("id").cast("string"), 5, "0").alias("n"), F.lit("t").alias("t"))
    parts = rel.combine_group(df, "g", "n", "t").orderBy("part_no").collect()
    assert [p["n_members"] for p in parts] == [100, 100, 30]
    assert "\n".join(p["combined"] for p in parts) == "\n".join(f"CV_{i:05d} starts here\n\nt" for i in range(230))


def test_members_of_missing_group(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b"), ("g", "c")], "g string, m string")
    got = rel.group_members(rel.labelled_groups(df, "g"), "g", "m")
    assert rows(got, "g", "members") == [("g", ["c"]), ("withoutgroupid", ["a", "b"])]
    assert rows(rel.group_members(df, "g", "m"), "g", "members") == [(None, ["a", "b"]), ("g", ["c"])]


def test_align_pads_by_position(spark):
    sheet = [
        ("Fields", 1, "CV_A ", "base", "F1", "f1", "tab", None),
        ("Fields", 2, "CV_A", None, "F2", None, "tab", "note"),
        ("Fields", 3, "CV_B", None, "F1", "f1", None, None),
        ("Fields", 4, None, None, "F9", "f9", None, None),
    ]
    df = spark.createDataFrame(
        sheet, "sheet string, row_no int, used_by string, base_cv string, sap_field string, dbx_field string, dbx_table string, comments string"
    )
    assert rows(md.align_mapping(df), "view", "position", "used_by", "base_cv", "sap_field", "dbx_field", "dbx_table", "comments") == [
        ("calculation_view_Fields_1", 1, "CV_A", "base", "F1", "f1", "tab", "note"),
        ("calculation_view_Fields_1", 2, "", "base", "F2", "", "tab", ""),
        ("calculation_view_Fields_2", 1, "CV_B", "", "F1", "f1", "", ""),
    ]


def test_similar_names_are_not_sent_through_the_driver(spark, tmp_path):
    schema = ", ".join(f"{c} {'boolean' if c == 'DataTypeMatch' else 'string'}" for c in md.REPORT)
    rows_ = [("c.s", "T", None, "A_B_1", None, "STRING", None, None), (None, "T", "V", None, "AB", None, "DATE", None), (None, "T", "V", None, None, None, "DATE", None)]
    spark.createDataFrame(rows_, schema).write.parquet(f"{tmp_path}/report")
    named = md.match_columns(spark.read.parquet(f"{tmp_path}/report"), "bidir")
    assert [r[-1] for r in rows(named, "ColumnNameSAP", "MatchedColumnDbx")] == [None, None, "A_B_1"]
    # however small the files are: their compressed size chose broadcasts of 1.6 GB
    assert "Broadcast" not in named._jdf.queryExecution().executedPlan().toString()
