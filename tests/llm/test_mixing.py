import duckdb
import pytest

from viewloom.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, copies int"


def rows_for(n=400):
    rows = [(i, "w " * (1 + i * 7919 % 300), "abc"[i % 3] if i % 5 else "hot") for i in range(n)]
    rows += [(9000 + i, "x y", None) for i in range(20)] + [(9100, None, "a"), (9101, "", "nowords"), (None, "a b c", "b"), (9102, "long " * 50_000, "long"), (3, "w w", "a"), (3, "w w", "a")]
    return [(*r, "clash", 5) for r in rows]


def compare(spark, rows, tmp_path):
    frame = spark.createDataFrame(rows, SCHEMA)
    path = str(tmp_path / "docs")
    frame.write.parquet(path)
    con = duckdb.connect()
    con.execute(f"create view documents as select doc_id, text, source from '{path}/*.parquet'")
    want = con.execute(mixing.oracle()).fetchall()
    got = mixing.mix(frame)
    assert set(got.columns) == {"doc_id", "text", "source", "size", "source_size", "target", "copies", "taken"}
    got = got.select("doc_id", "size", "source_size", "target", "taken").collect()
    key = lambda r: [str(x) for x in r]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    return got


def test_agrees_with_sql(spark, tmp_path):
    rows = rows_for()
    got = compare(spark, rows, tmp_path)
    assert len(got) == len(rows)
    assert all(r.taken <= 2 * r.size for r in got)
    targets = {r.source_size: r.target for r in got}
    assert sum(targets.values()) == pytest.approx(1.5 * sum({r.source_size: r.source_size for r in got}.values()), rel=1e-9)


def test_every_source_comes_near_its_target(spark):
    frame = spark.createDataFrame([r for r in rows_for(3000) if r[2] in ("a", "b", "c", "hot")], SCHEMA)
    for r in mixing.mix(frame).groupBy("source").agg({"taken": "sum", "target": "max", "size": "max"}).collect():
        assert abs(r["sum(taken)"] - r["max(target)"]) <= r["max(size)"]


def test_empty_and_wordless_tables(spark, tmp_path):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    got = compare(spark, [(1, None, "a", "", 0), (2, " ", None, "", 0)], tmp_path)
    assert [(r.target, r.taken) for r in got] == [(0.0, 0), (0.0, 0)]
