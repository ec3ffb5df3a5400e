import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as public
import pytest

from viewloom.llm import alignment, hashing

FILES = alignment.Files(public.path("byte_bpe_50k.tiktoken"), public.path("byte_bpe_50k.json"), public.PATTERN, public.path("piece_bpe_32k.model"))
TEXTS = [
    "The quick brown fox jumps over the lazy dog.", "The quick brown fox", "Überraschung! naïve café — 日本語 🙂🙃 end", "", None, "a▁b stays out", " two  spaces\n\n\tand <|endoftext|> </s>",
    "The quick brown fox", "   ", "\x00\x01", "ﬁn　wide",
]


def slow_groups(tokens_a, tokens_b):
    """Groups of (A ids, B ids) from (id, bytes) lists, walking both byte by byte."""
    ends = []
    for tokens in (tokens_a, tokens_b):
        at, found = 0, []
        for i, b in tokens:
            at += len(b)
            found.append((at, i))
        ends.append(found)
    shared = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
    groups, low = [], 0
    for high in shared:
        groups.append(tuple([i for e, i in side if low < e <= high] for side in ends))
        low = high
    return groups


def slow(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(FILES.json)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=FILES.pieces)
    signs = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(c): c for c in signs} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in signs)}
    all_groups = []
    for text in texts:
        groups = []
        if text:
            whole = (" " + text).encode()
            one = [(i, bytes(byte_of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
            two = [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i in b.encode(text) for p in [b.id_to_piece(i)]]
            if b"".join(x for _, x in one) == whole == b"".join(x for _, x in two):
                groups = slow_groups(one, two)
        all_groups.append(groups)
    linked = [[(x, y) for xs, ys in groups for x in xs for y in ys] for groups in all_groups]
    counts = Counter(pair for found in linked for pair in set(found))
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    rows = []
    for groups, found in zip(all_groups, linked):
        note = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        rows.append((
            sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(found), sum(counts[p] == highest[p[0]] for p in found),
            sum(counts[p] for p in found), hashlib.sha256(note.encode()).hexdigest() if note else "",
        ))
    return rows


def aligned(spark, texts, **more):
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_links int").repartition(3)
    found = alignment.align(docs, FILES, **more).drop("text").orderBy("doc_id").collect()
    assert [r[0] for r in found] == list(range(len(texts)))
    return [tuple(r)[1:] for r in found]


@pytest.mark.parametrize("table", [alignment.TABLE, 16])
def test_brute_force(spark, table):
    assert aligned(spark, TEXTS, table=table) == slow(TEXTS)


def test_long_texts_and_small_passes(spark):
    texts = ["word " * 3000 + "日" * 50, "".join(chr(0x4E00 + 7 * i) for i in range(2000)), "x" * 5000, *TEXTS]
    assert aligned(spark, texts) == slow(texts)


def test_words_are_encoded_as_in_the_whole_text(monkeypatch):
    import random

    monkeypatch.setattr(alignment, "WORDS", 50)
    coder = alignment.Coder(FILES)
    assert coder.apart
    rng = random.Random(11)
    signs = ["a", "The", "ing", " ", "  ", " ", "\n", "\t", ".", "é", "日本", "🙂", "1", "(", "x" * 50, "\u00a0", "\u3000", "-"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 40))) for _ in range(400)]
    for k in range(0, 400, 40):
        for text, found in zip(texts[k : k + 40], coder._b_ids(texts[k : k + 40])):
            whole = coder.b.encode(text)
            right = b"".join(coder.b_bytes[i] for i in whole) == (" " + text).encode()
            assert (found is not None) == right and (not right or found.tolist() == whole)
        assert len(coder.known) <= 50


def test_cut_links(monkeypatch):
    texts = [t for t in TEXTS if t]
    whole = alignment.Aligned(texts, FILES)
    monkeypatch.setattr(alignment, "LINKS", 3)
    total = Counter()
    for doc, key, times in alignment.Aligned(texts, FILES).links():
        for d, k, n in zip(doc.tolist(), key.tolist(), times.tolist()):
            total[d, k] += n
    want = Counter()
    for doc, key, times in alignment.Aligned(texts, FILES).links():
        for d, k, n in zip(doc.tolist(), key.tolist(), times.tolist()):
            want[d, k] += n
    assert total == want
    assert [sum(n for (d, _), n in total.items() if d == i) for i in range(len(texts))] == whole.n_links().tolist()


def test_empty_table_and_repeated_rows(spark):
    assert aligned(spark, []) == []
    assert aligned(spark, [None, ""]) == [(0, 0, 0, 0, 0, 0, "")] * 2
    docs = spark.createDataFrame([(1, "one text", "k"), (1, "one text", "k"), (None, "one text", None)], "doc_id long, text string, slot string")
    found = alignment.align(docs, FILES)
    assert found.columns[:3] == ["doc_id", "text", "slot"]
    rows = found.collect()
    assert len(rows) == 3 and all(r.count_sum == 3 * r.n_links for r in rows)


def test_perfect_hash(spark):
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 1 << 31, 100_000))
    hashed = hashing.perfect_hash(spark.createDataFrame([(int(k),) for k in keys], "key long").repartition(5), len(keys))
    slots = hashed(keys)
    assert np.array_equal(np.sort(slots), np.arange(len(keys)))
    others = np.setdiff1d(rng.integers(0, 1 << 31, 1000), keys)
    assert ((hashed(others) >= 0) & (hashed(others) <= len(keys))).all()
    assert hashed(np.zeros(0, np.int64)).tolist() == []
    empty = hashing.perfect_hash(spark.createDataFrame([], "key long"), 0)
    assert empty.n == 0 and empty(keys[:3]).tolist() == [0, 0, 0]


def test_every_text_is_encoded_once(spark):
    from pyspark.sql import functions as F

    seen = spark.sparkContext.accumulator(0)
    count = F.udf(lambda t: (seen.add(1), t)[1], "string").asNondeterministic()
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").repartition(2).select("doc_id", count("text").alias("text"))
    found = alignment.align(docs, FILES, keep=False, table=16)
    assert found.columns == ["doc_id", *(f.name for f in alignment.FIELDS)]
    assert [tuple(r)[1:] for r in found.orderBy("doc_id").collect()] == slow(TEXTS)
    assert seen.value == len(TEXTS)
