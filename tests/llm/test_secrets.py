import hashlib
import random

import pytest

from viewloom.llm import secrets

SCHEMA = "doc_id long, text string, start string, probability int"
WORDS = "water garden mountain thinking reading yellow morning evening".split()


def hexed(n):
    return hashlib.sha1(str(n).encode()).hexdigest()


def documents():
    rng = random.Random(2)
    rows = []
    for i in range(400):
        body = " ".join(rng.choice(WORDS) for _ in range(rng.randint(5, 60)))
        if i % 10 == 0:
            body += f' token = "{hexed(i)}" ' + body
        if i % 10 == 5:
            body += f" commit {hexed(i)} " + body
        rows.append((i, body))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    return secrets.fit(spark.createDataFrame([(*r, "old", 1) for r in documents()], SCHEMA))


def test_planted_secrets(spark, model):
    rows = documents() + [(1000, None), (1001, ""), (None, f'api_key: "{hexed(1)}"'), (1002, "x " * 200_000 + f'password="{hexed(2)}"'), (0, documents()[0][1])]
    got = secrets.scan(spark.createDataFrame([(*r, "old", 1) for r in rows], SCHEMA), model).collect()
    said = sorted((r.doc_id is None, r.doc_id, r.start, r.end, r.sha256) for r in got if r.is_secret)
    want = []
    for i, body in rows:
        for mark in ('token = "', 'api_key: "', 'password="'):
            if body and mark in body:
                at = body.index(mark) + len(mark)
                want.append((i is None, i, at, at + 40, hashlib.sha256(body[at : at + 40].encode()).hexdigest()))
    assert said == sorted(want)
    assert {r.doc_id for r in got if not r.is_secret} >= {5, 15, 25}


def test_held_out_findings(spark, model):
    docs = spark.createDataFrame([(i + 5000, " ".join(random.Random(i).choices(WORDS, k=20)), "", 0) for i in range(60)], SCHEMA)
    found = secrets.labelled_findings(docs).collect()
    right = sum((model.probability(r.text, r.start, r.end) >= secrets.ENOUGH) == (r.label == 1) for r in found)
    assert len(found) > 2000 and right >= 0.95 * len(found)


def test_mask(spark, model):
    value = hexed(3)
    rows = [(1, f'a token = "{value}" b and {value[:12]} c', "s", 1), (2, None, None, None), (3, "", "", 0), (None, "nothing here", "", 0), (3, "", "", 0)]
    got = secrets.mask(spark.createDataFrame(rows, SCHEMA), model)
    assert got.columns == ["doc_id", "text", "start", "probability"]
    key = lambda r: [str(x) for x in r]
    want = [(1, f'a token = "[SECRET]" b and {value[:12]} c', "s", 1), *rows[1:]]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_candidates():
    assert secrets.candidates(None) == [] and secrets.candidates("") == [] and secrets.candidates("only-lower-case-words-here") == []
    text = "key=Ab3Ab3Ab3Ab3Ab3Ab3 x"
    assert [text[i:j] for i, j in secrets.candidates(text)] == ["Ab3Ab3Ab3Ab3Ab3Ab3"]


def test_short_values_behind_an_assignment(model):
    for text, value in [("password: 'Tr0ub4dor&3' x", "Tr0ub4dor&3"), ("passwd: hunter2secret", "hunter2secret"), ('api_key = "k3Jd82LqPz0w"', "k3Jd82LqPz0w")]:
        found = model.find(text)
        assert [text[i:j] for i, j, _ in found] == [value] and found[0][2] >= secrets.ENOUGH, (text, found)
    for text in ["the note: morning garden", "count: 123456", "password: mountain", "time: 10:20:30"]:
        assert all(p < secrets.ENOUGH for _, _, p in model.find(text)), text


def test_empty_tables_and_one_label(spark):
    empty = spark.createDataFrame([], SCHEMA)
    model = secrets.fit(empty)
    assert model.trees == () and secrets.scan(empty, model).count() == 0 and secrets.mask(empty, model).count() == 0


def test_own_labelled_findings(spark):
    docs = spark.createDataFrame([(1, "words", "", 0)], SCHEMA)
    findings = secrets.labelled_findings(docs)
    model = secrets.fit(docs, findings=findings)
    again = secrets.fit(docs, findings=findings)
    assert model == again and len(model.trees) == secrets.TREES
