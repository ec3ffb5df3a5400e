import random

import numpy as np
import pytest

from viewloom.llm import minhash

SCHEMA = "doc_id long, text string, n_shingles string, label int"


def slow(texts, keys=None):
    keys = list(range(len(texts))) if keys is None else keys
    sets = []
    for text in texts:
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
        size = min(4, len(words))
        sets.append({tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set())
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                label[root(i)] = root(j)
    least = {}
    for i, k in enumerate(keys):
        if k is not None:
            least[root(i)] = min(k, least.get(root(i), k))
    found = []
    for i, k in enumerate(keys):
        component = least.get(root(i)) if sets[i] else k
        found.append((k, len(sets[i]), component, k is not None and k == component))
    return found


def fast(spark, texts, keys=None):
    keys = list(range(len(texts))) if keys is None else keys
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in zip(keys, texts)], SCHEMA).repartition(4)
    found = minhash.near_duplicates(docs)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def corpus(seed, groups=40, size=12):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    license_ = [rng.choice(words) for _ in range(60)]
    texts = []
    for _ in range(groups):
        base = [rng.choice(words) for _ in range(rng.randint(5, 150))]
        if rng.random() < 0.4:
            base = license_ + base[:60]
        for _ in range(rng.randint(1, size)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 25))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force(spark, seed):
    texts = corpus(seed) + ["", None, "  ", "One", "one ", "A b c", "a B\tc", "a b c d", "É é", "é é"]
    assert fast(spark, texts) == sorted(slow(texts), key=str)


def test_large_groups_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "SMALL", 3)
    monkeypatch.setattr(minhash, "TURNS", (1, 2, 1 << 60))
    monkeypatch.setattr(minhash, "COLUMNS", 16)
    texts = corpus(3, groups=6, size=120)
    assert fast(spark, texts) == sorted(slow(texts), key=str)


def test_keys(spark):
    text = " ".join(f"w{i}" for i in range(40))
    other = text.replace("w5 ", "x ")
    texts, keys = [text, other, text, text, "lone", "lone two words more"], [7, 3, 7, None, None, 3]
    assert fast(spark, texts, keys) == sorted(slow(texts, keys), key=str)
    assert fast(spark, []) == []
    assert fast(spark, [None, ""]) == [(0, 0, 0, True), (1, 0, 1, True)]


def test_long_text(spark):
    text = " ".join(f"w{i % 90_000}" for i in range(200_000))
    texts = [text, text + " tail", "short"]
    assert fast(spark, texts) == sorted(slow(texts), key=str)


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    agree = []
    for _ in range(60):
        both = rng.integers(0, 1 << 63, 1000, np.uint64)
        agree.append((minhash.signature(both[:900]) == minhash.signature(both[100:])).mean())
    assert abs(np.mean(agree) - 0.8) < 0.02
    assert (minhash.signature(both) == np.minimum(minhash.signature(both[:500]), minhash.signature(both[500:]))).all()


@pytest.mark.parametrize("with_shingles", [False, True])
def test_blocks_stream_visitors(monkeypatch, with_shingles):
    """Every pair of a block that agrees is proposed once, visitors included, however the rows are batched."""
    import pyarrow as pa

    monkeypatch.setattr(minhash, "BLOCK", 4)
    rng = np.random.default_rng(4)
    n = 60
    sketch = np.tile(rng.integers(0, 255, 64), (n, 1)).astype(np.uint8)
    sketch[::3, :10] = 255
    side = np.sort(rng.integers(0, 3, n))
    sets = [np.arange(50) + 1000 * (i % 4) for i in range(n)]
    names = ["value", "block", "side", "class", "label", "n", "sketch", "shingles"]
    columns = [np.zeros(n, np.int64), np.zeros(n, np.int64), side, np.arange(n), np.arange(n) % 7, np.full(n, 50)]
    columns = [*map(pa.array, columns), pa.array([s.tobytes() for s in sketch]), pa.array([s.astype("<u4").tobytes() for s in sets])]
    width = 8 if with_shingles else 7
    whole = pa.RecordBatch.from_arrays(columns[:width], names=names[:width])
    want = {(i, j) for i in range(n) for j in range(n) if side[i] > 0 and side[j] < 2 and i != j and i % 7 != j % 7 and not (with_shingles and (i - j) % 4)}
    found, more = [], False
    for batch in minhash._proposals(1 << 60, 80)(whole.slice(k, 7) for k in range(0, n, 7)):
        found += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
    assert len(found) == len(set(found)) and set(found) == want
    limited = [p for b in minhash._proposals(2, 80)(iter([whole])) for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
    assert (None, None) in limited and set(limited) - {(None, None)} < want


def test_index_counts_intersections():
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 300, rng.integers(0, 90))).astype("<u4") for _ in range(70)]
    packed = np.empty(70, object)
    packed[:] = [s.tobytes() for s in sets]
    got = minhash._Index(packed).common(packed[:40])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets] for a in sets[:40]]
