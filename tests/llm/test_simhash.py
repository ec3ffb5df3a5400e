import random

import numpy as np
from pyspark.sql import functions as F

from viewloom.llm import simhash
from viewloom.llm.components import connected_components

SCHEMA = "doc_id long, text string, fingerprint string, component_id int"


def slow_fingerprint(text):
    import xxhash

    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    size = min(4, len(words))
    hashes = [xxhash.xxh64(b" ".join(words[i : i + size]), seed=42).intdigest() for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(keys, values, distance=4):
    label = list(range(len(values)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= distance:
                label[root(i)] = root(j)
    least = {}
    for i, k in enumerate(keys):
        if k is not None:
            least[root(i)] = min(k, least.get(root(i), k))
    return [least.get(root(i)) for i in range(len(values))]


def test_fingerprint(spark):
    texts = ["", None, " \t ", "One", "a B c", "a b c d", "A b\nc  d e f g", "é É x y z " * 50, "w " * 3, " ".join(f"w{i}" for i in range(100_000))]
    for text in texts[:-1]:
        assert simhash.fingerprint(text) == slow_fingerprint(text)
    assert simhash.fingerprint(texts[-1]) == slow_fingerprint(texts[-1])
    # the hash is Spark's own
    spark_hash = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert simhash.fingerprint("A b C") == spark_hash % (1 << 64)


def test_every_close_pair_meets_at_a_home_anchor():
    rng = random.Random(3)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(1, 4)):
            b ^= 1 << bit
        rows, anchors, homes = simhash.replicas(np.array([a, b], np.uint64))
        home = {int(x) for x, r, h in zip(anchors, rows, homes) if r == 0 and h}
        assert home & {int(x) for x, r in zip(anchors, rows) if r == 1}
        assert len(home) == 3 and len(rows) <= 2 * 3 * 30


def near(rng, value, bits):
    for bit in rng.sample(range(64), bits):
        value ^= 1 << bit
    return value


def values_with_groups(rng, n):
    found = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(n):
        found.append(near(rng, rng.choice(found), rng.randint(0, 5)))
    return sorted(set(found))


def linked(spark, values):
    frame = spark.createDataFrame([(int(np.array([v], np.uint64).view(np.int64)[0]),) for v in values], "v long")
    found = connected_components(simhash.links(frame), "a", "b").collect()
    return {r.node: r.component for r in found}


def check_links(spark, values):
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    got = linked(spark, values)
    want = slow_components(signed, values)
    assert [got.get(s, s) for s in signed] == want


def test_links_are_those_of_all_pairs(spark):
    check_links(spark, values_with_groups(random.Random(1), 300))


def test_a_hot_anchor_is_split_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "UNSPLIT", 20)
    monkeypatch.setattr(simhash, "SHARES", 500)
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    check_links(spark, sorted({near(rng, centre, rng.randint(0, 3)) for _ in range(300)} | {rng.getrandbits(64) for _ in range(50)}))


def test_pairs_at_home_at_a_hot_anchor_meet(spark, monkeypatch):
    monkeypatch.setattr(simhash, "UNSPLIT", 20)
    rng = random.Random(8)
    home, values = rng.getrandbits(15), set()
    # an anchor word of the first block: pairs at distance 4 with both at home there, 2 bits apart in each of the other blocks, no centre
    syndrome = int(simhash._syndromes(np.array([home], np.uint64))[0])
    home ^= 1 << syndrome - 1 if syndrome else 0
    for _ in range(150):
        a = rng.getrandbits(43) << 21 | home
        b = a
        for first, width in simhash.BLOCKS[1:]:
            for bit in rng.sample(range(width), 2):
                b ^= 1 << first + bit
        values |= {a, b}
    check_links(spark, sorted(values))


def documents():
    base = " ".join(f"word{i}" for i in range(300))
    rows = [(5, base), (3, base), (9, base + " tail"), (9, base + " tail"), (7, None), (8, ""), (2, "other words here now and then"), (None, base), (None, "alone in the world"), (11, "x")]
    return [(k, t, "clash", 0) for k, t in rows]


def test_near_duplicates_agree_with_brute_force(spark):
    docs = documents()
    got = simhash.near_duplicates(spark.createDataFrame(docs, SCHEMA)).collect()
    want = slow_components([d[0] for d in docs], [slow_fingerprint(d[1]) for d in docs])
    signed = np.array([slow_fingerprint(d[1]) for d in docs], np.uint64).view(np.int64).tolist()
    key = lambda r: [str(x) for x in r]
    assert sorted(map(tuple, got), key=key) == sorted(zip([d[0] for d in docs], signed, want), key=key)


def test_one_document_of_each_group_stays(spark):
    kept = simhash.keep_one(spark.createDataFrame(documents(), SCHEMA))
    assert kept.columns == SCHEMA.replace(" long", "").replace(" string", "").replace(" int", "").split(", ")
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert ids == [(False, 2), (False, 3), (False, 7), (False, 11), (True, 0)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 70)] + [(200, 200), (None, 3), (5, 6), (300, 301)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges, "a", "b").collect()}
    assert got == {**{i: 1 for i in range(1, 71)}, 300: 300, 301: 300}


def test_stars_take_no_round_and_rounds_write_few_files(spark, monkeypatch):
    from viewloom.llm import components

    rounds = []
    monkeypatch.setattr(components, "_small_star", lambda links, parts, real=components._small_star: (rounds.append(links.rdd.getNumPartitions()), real(links, parts))[1])
    stars = [(9, 1), (1, 8), (7, 2), (7, 2), (3, 3), (None, 4)]
    found = connected_components(spark.createDataFrame(stars, "a long, b long"), "a", "b")
    assert sorted(map(tuple, found.collect())) == [(1, 1), (2, 2), (7, 2), (8, 1), (9, 1)] and not rounds
    joined = connected_components(spark.createDataFrame([*stars, (9, 7)], "a long, b long"), "a", "b")
    assert {c for _, c in joined.collect()} == {1} and 1 <= len(rounds) <= 2
    assert max(rounds) <= components.TASKS
