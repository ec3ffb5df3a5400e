import importlib
from collections import Counter

import pytest

import corpus_pipeline
from viewloom.llm import langid, packing, queries, secrets, simhash
from viewloom.session import materialize

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = list(corpus_pipeline.COLUMNS)


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(materialize(stage(spark, found[-1], SF_DIR), name))
    return found


def test_stage_columns(stages):
    assert all(df.columns == COLUMNS for df in stages[:-1])


def test_language_keeps_clean_documents(spark, stages):
    before, after = ({r.doc_id for r in df.collect()} for df in stages[:2])
    letterless = {r.doc_id for r in stages[0].collect() if not langid.gram_counts(r.text).any()}
    assert after == before - letterless


def test_near_duplicates_against_all_pairs(stages):
    rows = stages[1].orderBy("doc_id").collect()
    values = [simhash.fingerprint(r.text) for r in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if (values[i] ^ values[j]).bit_count() <= 4 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    want = {rows[k].doc_id for k in set(label)}
    assert {r.doc_id for r in stages[2].collect()} == want and stages[2].count() == len(want)


def test_secrets_are_masked_and_nothing_else(stages):
    before = {r.doc_id: r for r in stages[2].collect()}
    for r in stages[3].collect():
        old = before.pop(r.doc_id)
        parts = r.text.split(secrets.MASK)
        assert r.n_chars == len(r.text) and (r.lang, r.source) == (old.lang, old.source)
        assert len(parts) > 1 or r.text == old.text
        assert all(p in old.text for p in parts)
    assert not before


def test_mix_repeats_documents(stages):
    rows = {r.doc_id: r for r in stages[3].collect()}
    taken = Counter(r.doc_id for r in stages[4].collect())
    words = {k: len((r.text or "").split()) for k, r in rows.items()}
    assert max(taken.values()) <= 2 and set(taken) <= set(rows)
    assert sum(words[k] * n for k, n in taken.items()) == pytest.approx(1.5 * sum(words.values()), rel=0.05)


def test_pack_holds_every_copy(stages):
    want = Counter()
    docs = stages[4].collect()
    for r in docs:
        want[r.doc_id] += 1
    rows = stages[5].collect()
    assert Counter(r.doc_id for r in rows if r.start == 0) == want
    ends = Counter()
    for r in rows:
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= packing.CAPACITY
    assert sum(r.length for r in rows) == sum(r.doc_tokens for r in rows if r.start == 0)


def test_run_is_the_stages(spark, stages):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    got = Counter(map(tuple, corpus_pipeline.run(spark, SF_DIR).select(*columns).collect()))
    assert got == Counter(map(tuple, stages[5].select(*columns).collect()))


def test_odd_rows(spark):
    rows = [(None, None, None, None, None, 1), (1, "", "en", "a", 0, 1), (2, "the thing is a thing", None, None, 5, 1), (2, "the thing is a thing", None, None, 5, 1), (3, "water under the bridge", "en", "b", 4, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size int")
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            table = materialize(stage(spark, table, SF_DIR), name)
        last = table
    assert last.count() == 0


def test_queries_are_registered():
    entry = importlib.import_module("__spark_entry__")
    named = [q for q in entry.queries() if q == "pipeline" or q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in named if q != "pipeline") == list(range(1, 14)) and "pipeline" in named
    assert set(queries.oracle_sql()) <= set(named)
