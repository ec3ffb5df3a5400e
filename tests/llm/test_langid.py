import random

from pyspark.sql import functions as F

from viewloom.llm import langid
from viewloom.llm.common import held_out

SCHEMA = "doc_id long, text string, lang string, score string, rejected int"
STEMS = {"en": "the and ing tion wh sh th er".split(), "de": "der die und sch ung keit ver ä".split(), "fr": "le la eau ment que é è ou".split()}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(STEMS[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def rows(n=300):
    rng = random.Random(0)
    return [(i, text(rng, lang := rng.choice("en en de fr".split()), rng.randint(1, 200)), lang if i % 11 else None, "old", 1) for i in range(n)]


def test_held_out_accuracy_and_rejection(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    model = langid.fit(docs, ~held_out())
    assert set(model.languages) == set(STEMS)
    odd = [(1000, None, "en", "", 0), (1001, "", "en", "", 0), (1002, "12 !? 34", None, "", 0), (1003, "привет как дела это другой язык " * 20, "xx", "", 0), (None, "the and thing" * 3, None, "", 0), (1004, "the und eau " * 200_000, None, "", 0)]
    got = langid.predict(docs.union(spark.createDataFrame(odd, SCHEMA)), model).withColumn("held", held_out()).collect()
    tested = [r for r in got if r.held and r.lang in STEMS and r.text and len(r.text) > 20 and r.doc_id < 1000]
    assert len(tested) > 50 and sum(r.lang_pred == r.lang for r in tested) >= 0.98 * len(tested)
    assert all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert [(by_id[k].lang_pred, by_id[k].score, by_id[k].rejected) for k in (1000, 1001, 1002)] == [("und", 0.0, True)] * 3
    assert by_id[1003].rejected and not by_id[None].rejected and by_id[None].lang_pred == "en"
    assert not any(r.rejected for r in got if r.doc_id is not None and r.doc_id < 1000)


def test_whole_texts_in_slices(monkeypatch):
    body = text(random.Random(1), "fr", 3000) + " 12-34 Ünd"
    whole = langid.gram_counts(body)
    assert whole.sum() > 3 * len(body) * 0.8
    monkeypatch.setattr("viewloom.llm.common.slices.__defaults__", (1000,))
    cut = langid.gram_counts(body)
    assert abs(cut - whole).sum() <= 12 * (len(body) // 1000 + 1)


def test_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "some words", None, "", 0), (2, None, None, "", 0)], SCHEMA)
    model = langid.fit(docs, F.lit(True))
    assert sorted((r.doc_id, r.lang_pred, r.score, r.rejected) for r in langid.predict(docs, model).collect()) == [(1, "und", 0.0, False), (2, "und", 0.0, True)]
    empty = docs.limit(0)
    assert langid.predict(empty, langid.fit(empty, F.lit(True))).count() == 0


def test_repeated_rows_and_one_document(spark):
    docs = spark.createDataFrame([(1, "abc def", "en", "", 0)] * 3 + [(2, "xyz", "zz", "", 0)], SCHEMA)
    assert sorted(r.lang_pred for r in langid.predict(docs, langid.fit(docs, F.lit(True))).collect()) == ["en"] * 3 + ["zz"]
