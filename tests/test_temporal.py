import random

from conftest import rows
from pyspark.sql import functions as F

from viewloom.operators import temporal
from viewloom.operators.upsert import upsert


def test_latest_before_against_all_pairs(spark):
    rng = random.Random(3)
    a = [(i, rng.choice(["p", "q", "r"]), rng.randrange(30), rng.randrange(4), rng.randrange(30)) for i in range(200)]
    b = [(rng.choice(["p", "q", "s"]), rng.randrange(30), rng.randrange(30)) for _ in range(15)]
    df = spark.createDataFrame(a, "id int, k string, o int, s int, v int")
    events = spark.createDataFrame(b, "k string, eo int, ev int")
    want = []
    for key in "pqr":
        before = [x for x in a if x[1] == key and any(e[0] == key and x[2] <= e[1] and x[4] <= e[2] for e in b)]
        if before:
            top = max((x[2], x[3]) for x in before)
            want += [(x[0],) for x in before if (x[2], x[3]) == top]
    got = temporal.latest_before(df, events, ["k"], ["o", "s"], "v", "eo", "ev")
    assert rows(got, "id") == sorted(want, key=lambda t: str(t[0]))


def test_validity_is_half_open(spark):
    people = spark.createDataFrame([("x", 1997), ("x", 1998), ("x", 1999), ("y", 1998)], "bsn string, year int")
    history = spark.createDataFrame([("x", 1990, 1998, "old"), ("x", 1998, 9999, "new")], "bsn string, f int, t int, v string")
    got = temporal.valid_at(people, history, ["bsn"], "year", "f", "t", ["v"])
    assert rows(got) == [("x", 1997, "old"), ("x", 1998, "new"), ("x", 1999, "new"), ("y", 1998, None)]


def test_year_spine_drops_late_starts(spark):
    df = spark.createDataFrame([("a", 1999), ("b", 2002)], "k string, start int")
    assert rows(temporal.year_spine(df, "start", 2001, "y")) == [("a", 1999), ("a", 2000), ("a", 2001)]


def test_cut_after_event(spark):
    log = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 9)], "k string, o int")
    events = spark.createDataFrame([("a", 1), ("a", 2)], "k string, o int")
    assert rows(temporal.cut_after_event(log, events, ["k"], "o")) == [("a", 1), ("a", 2), ("b", 9)]
    assert rows(temporal.until_event(log, events, ["k"], "o")) == [("a", 1), ("a", 2)]
    assert rows(temporal.without_event(log, events, ["k"])) == [("b", 9)]


def test_upsert_is_idempotent_and_keeps_null_keys_apart(spark):
    target = spark.createDataFrame([("a", 1, "old", "g"), ("b", 2, "old", "g"), (None, 3, "old", "g")], "k string, n int, v string, grp string")
    source = spark.createDataFrame([("b", 2, None), ("c", 3, "new"), (None, 3, "new")], "k string, n int, v string")
    once = upsert(target, source, ["k", "n"], update=["v"], insert=["v"])
    want = [(None, 3, "new", None), (None, 3, "old", "g"), ("a", 1, "old", "g"), ("b", 2, None, "g"), ("c", 3, "new", None)]
    assert rows(once) == sorted(want, key=lambda t: [(v is not None, str(v)) for v in t])
    known = source.filter(F.col("k").isNotNull())
    assert rows(upsert(upsert(target, known, ["k", "n"]), known, ["k", "n"])) == rows(upsert(target, known, ["k", "n"]))
