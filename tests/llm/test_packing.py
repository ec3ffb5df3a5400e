import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from viewloom.llm import packing

RANKS, JSON = (public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("tiktoken", "json"))
REAL = Tokenizer.from_file(JSON)
CODER = packing.TokenBytes(RANKS, JSON, public_tokenizers.PATTERN)
SCHEMA = "doc_id long, text string, length int, sequence_id string"


def ids(text):
    return REAL.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", " ", "  ", "\n", "\t", "'s", "é", "日本", "😀", "\x1c", "\x85", "<|endoftext|>", "12", "!", "​"])))
def test_ids_are_those_of_the_json_vocabulary(parts):
    text = "".join(parts)
    assert np.frombuffer(CODER(text), "<u4").tolist() == ids(text)


def test_white_space_runs_that_the_rank_coder_gives_up_on():
    assert len(CODER(" " * 1_200_000)) > 0


@pytest.mark.parametrize("lengths", [[1], [2048], [2047, 1], [1500] * 40, list(range(1, 2500, 7)), [65] * 1000, [1] * 5])
def test_plan_holds_every_piece(lengths):
    wanted = Counter(k for n in lengths for k in packing.cut(n))
    plan = packing.solve(dict(wanted))
    got = Counter()
    for pattern in plan:
        assert sum(k * n for k, n in pattern.items) <= packing.CAPACITY
        for k, n in pattern.items:
            got[k] += n * pattern.times
    assert got == wanted
    fewest = -(-sum(lengths) // packing.CAPACITY)
    assert sum(p.times for p in plan) <= fewest + max(1, 0.4 * fewest * (max(lengths) > 1024 and len(set(lengths)) == 1))


def test_whole_ids_of_every_document(spark):
    long = " ".join(f"word{i % 97} and" for i in range(20_000))
    docs = [(1, "short text", 7, "x"), (2, None, 0, None), (3, "", None, "y"), (None, "no id", 1, "z"), (4, long, 2, ""), (1, "short text", 7, "x"), (5, "half " * 1023, 1, "")]
    frame = spark.createDataFrame(docs, SCHEMA).repartition(3)
    rows = packing.pack(frame, RANKS, JSON, public_tokenizers.PATTERN).collect()
    expected = Counter()
    for doc, text, *_ in docs:
        whole, start = ids(text or "") + [1], 0
        for n in packing.cut(len(whole)):
            crc = zlib.crc32(np.array(whole[start : start + n], "<u4").tobytes())
            expected[doc, start, n, crc, len(whole)] += 1
            start += n
        assert start == len(whole)
    assert Counter(tuple(r)[:5] for r in rows) == expected
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    assert sorted(sequences) == list(range(len(sequences)))


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA), RANKS, JSON, public_tokenizers.PATTERN).count() == 0
