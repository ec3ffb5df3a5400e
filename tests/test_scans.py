"""Two-level scans give the results of plain windows, with hot keys, NULL keys and ties."""

import random

import pytest
from conftest import rows
from pyspark.sql import Window, functions as F

from viewloom.operators import scans
from viewloom.operators.scans import Ordering


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(7)
    data = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.5 else rng.choice([None, "a", "b", "c", f"k{rng.randrange(200)}"])
        value = rng.choice([None, rng.randrange(1000)])
        data.append((i, key, rng.randrange(40), rng.randrange(5), value))
    return spark.createDataFrame(data, "id int, key string, day int, seq int, value int").cache()


UNIQUE, TIED = ("day", "seq", "id"), ("day", "seq")
CHUNKS = [lambda: None, lambda: F.floor(F.col("day") / 10), lambda: F.lit(0), lambda: F.struct("day", F.floor(F.col("seq") / 2))]


def plain(order, descending=False):
    columns = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    return Window.partitionBy("key").orderBy(*columns)


@pytest.mark.parametrize("chunk", CHUNKS)
@pytest.mark.parametrize("descending", [False, True])
def test_neighbours(log, chunk, descending):
    o = Ordering(("key",), UNIQUE, descending, chunk())
    window = plain(UNIQUE, descending)
    got = scans.next_value(log, o, "value", "x")
    assert rows(got, "id", "x") == rows(log.select("id", F.lead("value").over(window).alias("x")))
    got = scans.previous_values(log, o, {"x": F.col("value"), "y": F.col("id")})
    want = log.select("id", F.lag("value").over(window), F.lag("id").over(window))
    assert rows(got, "id", "x", "y") == rows(want)


@pytest.mark.parametrize("chunk", CHUNKS)
@pytest.mark.parametrize("descending", [False, True])
def test_numbers(log, chunk, descending):
    got = scans.ranked(log, Ordering(("key",), TIED, descending, chunk()), "x")
    assert rows(got, "id", "x") == rows(log.select("id", F.rank().over(plain(TIED, descending))))
    got = scans.numbered(log, Ordering(("key",), UNIQUE, descending, chunk()), "x")
    assert rows(got, "id", "x") == rows(log.select("id", F.row_number().over(plain(UNIQUE, descending))))


@pytest.mark.parametrize("chunk", CHUNKS)
@pytest.mark.parametrize("descending", [False, True])
def test_running(log, chunk, descending):
    so_far = plain(UNIQUE, descending).rowsBetween(Window.unboundedPreceding, 0)
    got = scans.running(log, Ordering(("key",), UNIQUE, descending, chunk()), {"x": (F.min, "value"), "y": (F.max, "value")})
    assert rows(got, "id", "x", "y") == rows(log.select("id", F.min("value").over(so_far), F.max("value").over(so_far)))
    got = scans.running(log, Ordering(("key",), TIED, descending, chunk()), {"x": (F.max, "value")}, rows=False)
    assert rows(got, "id", "x") == rows(log.select("id", F.max("value").over(plain(TIED, descending))))
    got = scans.running_count(log, Ordering(("key",), TIED, descending, chunk()), "value", "x")
    assert rows(got, "id", "x") == rows(log.select("id", F.count("value").over(plain(TIED, descending))))


@pytest.mark.parametrize("chunk", CHUNKS)
@pytest.mark.parametrize("descending", [False, True])
def test_last_known(log, chunk, descending):
    so_far = plain(UNIQUE, descending).rowsBetween(Window.unboundedPreceding, 0)
    known = F.col("value") % 3 == 0
    got = scans.last_known(
        log, Ordering(("key",), UNIQUE, descending, chunk()), {"value": F.col("value"), "from_id": F.col("id")}, known
    )
    want = log.select(
        "id", F.last(F.when(known, F.col("value")), True).over(so_far), F.last(F.when(known, F.col("id")), True).over(so_far)
    )
    assert rows(got, "id", "value", "from_id") == rows(want)


def test_island_fill_repeats_rows_of_tied_openers(spark):
    data = [("a", 1, None, "w"), ("a", 2, 1, "x"), ("a", 2, 1, "y"), ("a", 3, None, "z")]
    df = spark.createDataFrame(data, "key string, day int, flag int, v string")
    got = scans.island_fill(df, Ordering(("key",), ("day",)), "flag", ["v"])
    assert rows(got, "day", "v") == [(2, "x"), (2, "x"), (2, "y"), (2, "y"), (3, "x"), (3, "y")]


def test_fill_never_crosses_keys(log):
    got = scans.last_known(log, Ordering(("key",), UNIQUE), {"owner": F.col("key")}, F.col("value").isNotNull())
    crossed = got.filter(F.col("owner").isNotNull() & ~F.col("owner").eqNullSafe(F.col("key")))
    assert crossed.isEmpty()


def test_extremes(log):
    ranked = log.withColumn("r", F.rank().over(plain(TIED, True))).filter("r = 1")
    assert rows(scans.at_extreme(log, ["key"], TIED), "id") == rows(ranked, "id")
    numbered = log.withColumn("r", F.row_number().over(plain(UNIQUE, True))).filter("r = 1")
    assert rows(scans.latest_values(log, ["key"], TIED, ["id"]), "key", "id") == rows(numbered, "key", "id")


def test_hot_key_is_not_one_group(log):
    """Rows are windowed by key and chunk; only the one row per chunk is windowed by key."""
    text = scans.next_value(log, Ordering(("key",), UNIQUE), "id", "x")._jdf.queryExecution().toString()
    physical = text[text.index("== Physical Plan") :]
    windows = [line for line in physical.splitlines() if "+- Window [" in line]
    assert len(windows) == 2
    assert "windowspecdefinition(__slot" in windows[0] and "__edge" in windows[1]


@pytest.mark.parametrize("descending", [False, True])
def test_ties_are_decided_by_the_carry_alone(log, descending):
    o, window = Ordering(("key",), ("day",), descending), plain(("day",), descending)
    flagged = log.withColumn("flag", F.when(F.col("value") % 7 == 0, 1))
    ranks = scans.ranked(log, o, "x")
    counts = scans.running_count(flagged, o, "flag", "x")
    highest = scans.running(log, o, {"x": (F.max, "value")}, rows=False)
    assert rows(ranks, "id", "x") == rows(log.select("id", F.rank().over(window)))
    assert rows(counts, "id", "x") == rows(flagged.select("id", F.count("flag").over(window)))
    assert rows(highest, "id", "x") == rows(log.select("id", F.max("value").over(window)))
    # one window, and it stands over the aggregated chunks: a single hot (key, day) is never a window partition of rows
    for df in (ranks, counts, highest):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Window [") == 1 and plan.index("Window [") < plan.index("Aggregate [")


@pytest.mark.parametrize("order, chunk", [(("day",), None), (("day", "seq"), "day")])
def test_island_fill_agrees_with_a_join_by_island(log, order, chunk):
    flagged = log.withColumn("flag", F.when(F.col("value") % 50 == 0, 1)).filter("key is not null")
    got = scans.island_fill(flagged, Ordering(("key",), order, chunk=None if chunk is None else F.col(chunk)), "flag", ["value"])
    island = flagged.withColumn("n", F.count("flag").over(plain(order)))
    openers = island.filter("flag = 1").select(F.col("key").alias("k"), F.col("n").alias("m"), F.col("value").alias("v"))
    want = island.join(openers, (F.col("key") == F.col("k")) & (F.col("n") == F.col("m"))).select("id", "v")
    assert rows(got, "id", "value") == rows(want)
