import random

from conftest import rows
import pytest
from pyspark.sql import functions as F

from viewloom.functions import scalar as fn, text as tx
from viewloom.operators import text as ops, usage


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_annotate_ddl_golden(spark):
    ddl = "CREATE TABLE cat.gold.policies\n(\n    start_ts           TIMESTAMP,\n    rel_nr             DECIMAL(5, 0),\n\n    cancelled          STRING\n)"
    want = (
        "CREATE TABLE cat.gold.policies\n(\n    start_ts           TIMESTAMP COMMENT('Start of policy'),\n"
        "    rel_nr             DECIMAL(5, 0) COMMENT('Relation'),\n\n    cancelled          STRING\n)"
    )
    docs = spark.createDataFrame([(1, ddl)], "id int, text string")
    known = spark.createDataFrame(
        [("START_TS", "first", 1), ("start_ts", "Start of policy", 2), ("RELNR", "Relation", 3)], "key string, value string, ordinal int"
    )
    assert rows(ops.annotate_ddl(docs, "id", "text", known)) == [(1, want, 2, 4)]


def test_mapping_order_words_and_case(spark):
    scripts = spark.createDataFrame([("select A, ab, a_b, été from T1 where a=1",)], "text string")
    mapping = spark.createDataFrame([("A", "b", 1), ("B", "c$1", 2), ("T", "x", 3), ("t1", "TAB", 4)], "key string, value string, ordinal int")
    got = ops.apply_mapping(scripts, "text", mapping, slice_size=2).first()[0]
    assert got == "select c$1, ab, a_b, été from TAB where c$1=1"
    assert ops.apply_mapping(scripts, "text", mapping.limit(0)).first()[0] == scripts.first()[0]


def test_mapping_by_words_is_mapping_one_by_one(spark):
    rng = random.Random(7)
    parts = ["a", "B", "ab", "_x", "/", ".", " ", "é", "T1", "-"]
    make = lambda n: "".join(rng.choice(parts) for _ in range(n))
    scripts = spark.createDataFrame([(i, make(rng.randint(0, 25))) for i in range(120)] + [(200, None)], "id int, text string")
    for keys in (["a", "B", "ab", "T1", "é", "a.b"], ["a", "/a", "B", "-", "ab/", "T1"]):
        mapping = spark.createDataFrame([(k, make(rng.randint(1, 3)), i) for i, k in enumerate(keys)], "key string, value string, ordinal int")
        placed = mapping.select(F.col("ordinal").alias("__no") + 1, "key", "value").toDF("__no", "key", "value")
        want = ops._apply_slices(scripts, "text", placed, 100)
        assert rows(ops.apply_mapping(scripts, "text", mapping)) == rows(want)


def test_plain_keys_are_applied_one_by_one(spark, monkeypatch):
    rng = random.Random(5)
    make = lambda n: "".join(rng.choice("ab.é𝒳") for _ in range(n))
    scripts = spark.createDataFrame([(i, make(rng.randint(0, 30))) for i in range(150)] + [(200, None), (201, "")], "id int, text string")
    for _ in range(3):
        # short values join with what stands beside them, so later keys appear that no script had
        entries = [(make(rng.randint(1, 5)), make(rng.randint(0, 3)), i) for i in range(25)]
        mapping = spark.createDataFrame([*entries, ("", "x", 30), (None, "x", 31), ("a", None, 32)], "key string, value string, ordinal int")
        got = dict(rows(ops.apply_mapping(scripts, "text", mapping, whole_words=False)))
        for i, text in scripts.collect():
            for key, value, _no in sorted(entries, key=lambda e: (e[2], e[0])):
                text = text and text.replace(key, value)
            assert got[i] == text


def test_word_borders_know_accents(spark):
    scripts = spark.createDataFrame([("le leè élé É",)], "text string")
    mapping = spark.createDataFrame([("LE", "x", 1), ("é", "y", 2)], "key string, value string, ordinal int")
    assert ops.apply_mapping(scripts, "text", mapping).first()[0] == "x leè élé y"


def test_packing_keeps_order_and_budget(spark):
    sizes = [5, 4, 20, 1, 1, 9, 3]
    df = spark.createDataFrame([(1, sizes)], "id int, sizes array<long>")
    packed = sorted((r["piece_no"], r["group_no"], r["size"]) for r in ops.pack_by_budget(df, "id", "sizes", F.lit(2), 12).collect())
    assert [p[2] for p in packed] == sizes
    assert [p[1] for p in packed] == [1, 1, 2, 3, 3, 4, 5]


def test_column_usage(spark):
    statements = [
        ("IT_A = select a.x, B.y from z2_t as a\n left join z9_u b on a.id = b.id -- a.gone\n;",),
        ("select left(p) as q, r from z2_t where 1 = 1 union select distinct s from z3_v",),
    ]
    used = usage.column_usage(spark.createDataFrame(statements, "s string"), "s")
    assert rows(used, "table_name", "columns") == [("z2_t", ["id", "p", "r", "x"]), ("z3_v", ["s"]), ("z9_u", ["id", "y"])]


@pytest.mark.parametrize(
    "statement, want",
    [
        ("select round(a2, 2) from t2", {"t2": ["a2"]}),
        ("select x.a3 from (select a3, b3 from t3) x", {"t3": ["a3", "b3"]}),
        ("select t4.a from t4, t5 where t5.k = 1", {"t4": ["a"], "t5": ["k"]}),
        ("select a from t", {"t": ["a"]}),
        ("select 'it''s x.y', \"Odd\" from s.t as q where q.\"B\" = 1", {"s.t": ["b", "odd"]}),
        ("select a.x, b.x from t a join u b using (k, l)", {"t": ["k", "l", "x"], "u": ["k", "l", "x"]}),
        ("with c(a) as (select p from t), d as (select a from c) select d.a, e.z from d join e on e.i = d.a", {"t": ["p"], "e": ["i", "z"]}),
        ("select case when a = 'x' then b else c end as d, cast(e as int) f from t", {"t": ["a", "b", "c", "e"]}),
        ("select a.p from t a where a.q = (select max(b.r) from u b where b.s = a.t)", {"t": ["p", "q", "t"], "u": ["r", "s"]}),
        ("select a.p from t a union select a.q from u a minus (select r from v)", {"t": ["p"], "u": ["q"], "v": ["r"]}),
        ("insert into x select p, /bic/q from /bic/azr union all select a/b/c from z", {"/bic/azr": ["/bic/q", "p"], "z": ["a", "b", "c"]}),
        ("select f(g(a, h(b)), count(*)) from t group by z having sum(y) > 1", {"t": ["a", "b"]}),
        ("select v.* , w.a from (t v left join u w on v.k = w.k)", {"t": ["k"], "u": ["a", "k"]}),
        ("select a, b from t, unnest(t.c) q", {"t": ["c"]}),
        ("select p from (select p from (select p from deep) x) y", {"deep": ["p"]}),
        ("", {}),
        (None, {}),
        ("select 1", {}),
        ("drop table t; )) ((", {}),
    ],
)
def test_column_usage_scopes(spark, statement, want):
    used = usage.column_usage(spark.createDataFrame([(statement,), (statement,)], "s string"), "s")
    assert {r.table_name: r.columns for r in used.collect()} == want


def test_column_usage_carries_marks_not_neighbours(spark, monkeypatch):
    planned = []
    monkeypatch.setattr(usage, "materialize", lambda df, name: planned.append(df) or df)
    usage.column_usage(spark.createDataFrame([("select a from t",)], "s string"), "s")
    plan = planned[0]._jdf.queryExecution().optimizedPlan().toString()
    # plans are written from the top: neighbours occur below the windows only
    assert plan.index("Window [") < plan.rindex("Window [") < min(plan.index(c) for c in ("before3", "after2"))


def test_column_usage_before_the_first_clause(spark):
    statements = [("create view v as ( select a.c1, (select max(b.c2) from u b where b.c3 = a.c4) m from t a )",), ("refresh x ( t.y )",)]
    used = usage.column_usage(spark.createDataFrame(statements, "s string"), "s")
    assert sorted((r.table_name, *r.columns) for r in used.collect()) == [("t", "c1", "c4"), ("u", "c2", "c3")]


def _grid(*lines):
    return f'<p><table class="a {tx.GRID_CLASS}"><tr><td>h</td><td>h</td><td>h</td></tr>' + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in line) + "</tr>" for line in lines) + "</table><table><tr><td>1</td><td>2</td><td>3</td></tr></table>"


def test_table_rows(spark):
    inner = "<TABLE><tr> <td>in</td>\n<td>a</td><td>cell</td></tr></TABLE>"
    docs = [
        (1, _grid(("", "a", "b"), ("K", "c", "d"), ("two", "cells"), (" ", f"e{inner}", "f"), ("L", "g", "h"))),
        (2, _grid()), (3, "no table"), (4, None), (5, ""), (6, _grid(("K", "a", "b")).split("</table>")[0]),
    ]
    found = ops.table_rows(spark.createDataFrame(docs, "id int, html string"), "id", "html")
    assert rows(found) == [
        (1, 1, "", "a", "b"), (1, 2, "K", "c", "d"), (1, 3, "K", "e in a cell", "f"), (1, 4, "L", "g", "h"), (6, 1, "K", "a", "b"),
    ]


def test_table_rows_are_linear(spark):
    import time

    took = []
    for n in (12_500, 100_000):
        lines = [("K" + str(i) if i % 7 == 0 else "", f"n{i}", f"<b>t</b>{i}" if i % 50 else f"<table><tr><td>x</td></tr></table>{i}") for i in range(n)]
        df = spark.createDataFrame([(1, _grid(*lines))], "id int, html string")
        started = time.perf_counter()
        last = ops.table_rows(df, "id", "html").where(f"row_no = {n}").first()
        took.append(time.perf_counter() - started)
        assert last.object_type == "K" + str((n - 1) // 7 * 7) and last.name == f"n{n - 1}"
    assert took[1] < 30 * took[0] + 5


def test_rule_table(spark):
    row = lambda *cells: "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"
    rule = lambda name, kind="Routine": row("", name, "d", "C", "1", kind, "t", "I", "", "", "")
    wide = lambda text: f'<tr><td colspan="11">{text}</td></tr>'
    html = "<table>" + "".join(
        [rule("A"), wide("formula"), wide("Constant 5"), rule("Unit Info A"), rule("B"), rule("C", ""), wide("late"), rule("D"), wide("last"), wide("end")]
    ) + "</table>"
    df = spark.createDataFrame([(1, html)], "id int, html string")
    got = ops.tidy_rules(ops.rule_cells(df, "id", "html"), "id")
    assert rows(got, "rule_no", "Field_name", "Logic") == [
        (1, "A", "formula\nConstant 5"), (2, "B", "late"), (3, "C", None), (4, "D", None),
    ]


def test_labels_and_sections(spark):
    assert one(spark, tx.between(F.lit("a: b :c"), "a: ", " :c")) == "b"
    assert one(spark, tx.between(F.lit("a: b"), "x", "y")) is None
    assert one(spark, tx.after(F.lit("Target: abc"), "Target: ", 2)) == "ab"
    assert one(spark, tx.first_table(F.lit("<p>"))) == tx.TABLE_MISSING
    assert one(spark, tx.strip_fences(F.lit("```sql\nselect `a`\n```"))) == "\nselect a\n"
    assert one(spark, ops.combined_name(F.lit("X_030_POLICY_BASE.txt"))) == "POLICY_BASE"


def test_scalar_edges(spark):
    assert one(spark, fn.sap_date(F.lit("00000000"))) is None
    assert one(spark, fn.year8(F.lit("20240115"))) == 2024
    assert one(spark, fn.comma_decimal(F.lit("-12,5"))) is not None and one(spark, fn.comma_decimal(F.lit(""))) is None
    assert one(spark, fn.match(F.lit("a.b"), "a.*")) and not one(spark, fn.match(F.lit("axb"), "a.*"))
    assert one(spark, fn.lower_unquoted(F.lit("A 'B' C"))) == "a 'B' c"
    assert one(spark, fn.hash_id(F.lit("000000000"))) == "" and len(one(spark, fn.hash_id(F.lit("1")))) == 64
    assert one(spark, fn.age(F.lit(1990), F.lit("20000101"))) is None
    assert str(one(spark, fn.sap_timestamp(F.lit("202401151020301234")))) == "2024-01-15 10:20:30.123400"
    assert one(spark, fn.case_(F.lit(None).cast("int"), None, "none", default="x")) == "none"


@pytest.mark.parametrize("name", ["T13_tidy_rules", "T16_view_inventory"])
def test_long_texts_of_a_small_file_are_dealt_out(spark, tmp_path, name):
    from viewloom.queries import queries

    part = spark.createDataFrame([(k, f"name {k}", f"Brand#{k % 9}", "LARGE", k % 50) for k in range(200)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int")
    part.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    made = queries()[name](spark, str(tmp_path))
    assert made.select(F.spark_partition_id()).distinct().count() > 1
