import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from viewloom.llm import perplexity

SCHEMA = "doc_id long, text string, lang string, kept string, n_words int"


def slow_base(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside)


@pytest.mark.parametrize("text", [None, "", " \t\n", "a b c", "a b c d e a b c d e f", "x\nx\n\n x\ny | z", "a " * 20, "é b 😀 <p>", "one two three four five six one two three four five"])
def test_base_features(text):
    assert perplexity.base_features(text) == slow_base(text)


def sentences(rng, n, words="the and of thing that tion ering with from was".split()):
    return " ".join(rng.choice(words) + rng.choice(["", "s", "ed", "."]) for _ in range(n))


def slow_model(texts):
    """Modified Kneser-Ney in plain Python, without pruning: a function (context, character) -> probability."""
    n = perplexity.ORDER
    grams = Counter()
    for t in texts:
        s = [perplexity.FIRST] * (n - 1) + [ord(c) for c in t] + [perplexity.LAST]
        grams.update(tuple(s[i : i + n]) for i in range(len(s) - n + 1))
    levels, raw = {n: grams}, {n: grams}
    for k in range(n - 1, 0, -1):
        raw[k], kinds = Counter(), Counter()
        for g, c in raw[k + 1].items():
            raw[k][g[1:]] += c
            kinds[g[1:]] += 1
        levels[k] = Counter({g: raw[k][g] if g[0] == perplexity.FIRST else kinds[g] for g in kinds})
    discounts = {}
    for k, counts in levels.items():
        c = [sum(v == j for v in counts.values()) for j in range(5)]
        d = [0, 0.5, 1.0, 1.5]
        if all(c[1:]):
            y = c[1] / (c[1] + 2 * c[2])
            made = [j - (j + 1) * y * c[j + 1] / c[j] for j in (1, 2, 3)]
            d = [0] + [m if 0 < m < j else j / 2 for j, m in enumerate(made, 1)]
        discounts[k] = d
    sums = {k: defaultdict(lambda: [0, 0.0]) for k in levels}
    for k, counts in levels.items():
        for g, c in counts.items():
            sums[k][g[:-1]][0] += c
            sums[k][g[:-1]][1] += discounts[k][min(c, 3)]

    def p(g):
        k = len(g)
        lower = 1 / (len(levels[1]) + 1) if k == 1 else p(g[1:])
        if g[:-1] not in sums[k]:
            return lower
        total, mass = sums[k][g[:-1]]
        c = levels[k].get(g, 0)
        return (c - discounts[k][min(c, 3)] if c else 0) / total + mass / total * lower

    return p


def perplexities(spark, model, texts, lang="en"):
    frame = spark.createDataFrame([(i, t, lang, "", 0) for i, t in enumerate(texts)], SCHEMA)
    return [r.log_perplexity for r in perplexity.scores(frame, model).orderBy("doc_id").collect()]


def han(rng, n, size=3000):
    """Words of Chinese, Hangul and supplementary characters, some far more often than others."""
    return " ".join("".join(chr(rng.choice((0x4E00, 0xAC00, 0x20000)) + int(size * rng.random() ** 4)) for _ in range(rng.randint(1, 4))) for _ in range(n))


def slow_scores(rows):
    """Log-perplexities of (text, language) by the fold that does not hold the text, all in plain Python."""
    fold = {t: h % 2 for t, h in rows["fold"]}
    models = {}
    for f in (0, 1):
        for lang in {x for _, x in rows["docs"]}:
            texts = [t for t, x in rows["docs"] if x == lang and t and fold[t] == f and perplexity._reference(t)]
            models[f, lang] = slow_model(texts) if texts else None
    found = []
    for t, lang in rows["docs"]:
        p = models[1 - fold[t], lang] if t else None
        s = [perplexity.FIRST] * 3 + [ord(c) for c in t or ""] + [perplexity.LAST]
        found.append(p and -sum(math.log(p(tuple(s[i : i + 4]))) for i in range(len(s) - 3)) / (len(s) - 3))
    return found


@pytest.mark.parametrize("common", [1 << 21, 900, 1])
def test_kept_agrees_with_a_slow_version(spark, monkeypatch, common):
    monkeypatch.setattr(perplexity, "COMMON", common)
    rng = random.Random(11)
    docs = [((sentences if i % 2 else han)(rng, rng.randint(9, 40)), ("zh", "en")[i % 2]) for i in range(60)]
    docs += [("", "en"), (None, "zh"), (docs[3][0], "en"), (docs[3][0], "en"), (" ".join(rng.choices("bcdfgjkqvxz", k=60)), "en"), ("only one of its language in this table, so no fold has it but its own", "fr")]
    frame = spark.createDataFrame([(i, *d, "", 0) for i, d in enumerate(docs)], SCHEMA).repartition(3)
    hashes = frame.where("text is not null").select("text", F.xxhash64("text").alias("h")).collect()
    want = slow_scores({"docs": docs, "fold": [(r.text, r.h) for r in hashes]})
    got = {r.doc_id: r for r in perplexity.judge(frame, perplexity.fit_folds(frame)).collect()}
    assert len(got) == len(docs)
    bands = {}
    for lang in {x for _, x in docs}:
        clean = sorted(w for (t, x), w in zip(docs, want) if x == lang and w is not None and perplexity._reference(t) and not 5 * slow_base(t)[4] > slow_base(t)[0])
        q = [clean[max(0, math.ceil(share * len(clean)) - 1)] for share in (0.25, 0.5, 0.75)] if clean else None
        bands[lang] = q and (q[1] - max(0.15, 3 * (q[2] - q[0])), q[1] + max(0.15, 3 * (q[2] - q[0])))
    for i, ((t, lang), w) in enumerate(zip(docs, want)):
        assert got[i].log_perplexity == (None if w is None else pytest.approx(w, rel=1e-5))
        base = slow_base(t)
        failed = base[0] < 10 or 100 * base[4] > 20 * base[0]
        inside = w is None or bands[lang] is None or bands[lang][0] <= w <= bands[lang][1]
        assert (got[i].base_failed, got[i].kept) == (failed, not failed and inside)


def test_every_character_is_its_own(spark):
    rng = random.Random(12)
    known = [han(rng, 60, 300) for _ in range(20)]
    frame = spark.createDataFrame([(i, t, "zh", "", 0) for i, t in enumerate(known)], SCHEMA)
    shifted = "".join(c if c == " " else chr(ord(c) + 0xE0 * 5) for c in known[0])
    model = perplexity.fit(frame)
    near, far = perplexities(spark, model, [known[0], shifted], "zh")
    assert far > near + 1
    grams = perplexity.count(frame).select("tail").collect()
    assert {r["tail"] & perplexity.FIRST for r in grams} - {perplexity.LAST} == {ord(c) for t in known for c in t}


def test_model_is_modified_kneser_ney(spark):
    rng = random.Random(4)
    texts = [sentences(rng, 40) for _ in range(30)]
    frame = spark.createDataFrame([(i, t, "en", "", 0) for i, t in enumerate(texts)], SCHEMA)
    model = perplexity.fit(frame)
    p = slow_model(texts)
    tried = [texts[0], "the thing # was unseen", "q"]
    for t, got in zip(tried, perplexities(spark, model, tried)):
        s = [perplexity.FIRST] * 3 + [ord(c) for c in t] + [perplexity.LAST]
        want = -sum(math.log(p(tuple(s[i : i + 4]))) for i in range(len(s) - 3)) / (len(s) - 3)
        assert got == pytest.approx(want, rel=1e-5)
    seen = {ord(c) for t in texts for c in t} | {perplexity.LAST, ord("#")}
    assert sum(p((ord("t"), ord("h"), ord("e"), c)) for c in seen) == pytest.approx(1)
    assert perplexities(spark, model, tried, "de") == [None] * 3
    held = model.table.toPandas()
    assert held["hash"].is_unique and all((np.diff(x["hash"].to_numpy().view(np.uint64).astype(object)) > 0).all() for _, x in held.groupby("part"))


def test_the_model_lies_in_ranges_of_hashes(spark, monkeypatch):
    rng = random.Random(4)
    frame = spark.createDataFrame([(i, sentences(rng, 60), "en", "", 0) for i in range(20)], SCHEMA)
    whole = perplexity.fit(frame).table.toPandas()
    monkeypatch.setattr(perplexity, "RANGE_BITS", 6)
    parted = perplexity.fit(frame).table.toPandas()
    assert parted["part"].nunique() > 10 and sorted(parted["hash"]) == sorted(whole["hash"])


def test_bands_reject_what_is_unlike_the_corpus(spark):
    rng = random.Random(5)
    rows = [(i, sentences(rng, rng.randint(20, 120)), ("en", "de", None)[i % 3]) for i in range(300)]
    junk = [(1000 + i, " ".join(w + rng.choice(["###", "$$$", "&&&"]) for w in sentences(rng, 40).split()), "en") for i in range(10)]
    odd = [(2000, None, "en"), (2001, "", None), (2002, "too short", "en"), (2003, "same words again and again " * 9, "en"), (None, sentences(rng, 50), "de"), (2004, sentences(rng, 30_000), "de"), (2005, sentences(rng, 50), "only"), (5, rows[5][1], rows[5][2])]
    frame = spark.createDataFrame([(*r, "old", -1) for r in rows + junk + odd], SCHEMA)
    judged = perplexity.judge(frame, perplexity.fit(frame))
    got = {r.doc_id: r for r in judged.collect()}
    assert judged.count() == len(rows + junk + odd)
    assert all(got[i].kept for i, *_ in rows) and not any(got[i].kept or got[i].base_failed for i, *_ in junk)
    assert [got[k].base_failed for k in (2000, 2001, 2002, 2003)] == [True] * 4
    assert got[None].kept and got[2004].kept and got[2005].kept and got[2000].log_perplexity is None
    for i, t, _ in rows[:50] + junk + odd[:4]:
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words) == slow_base(t)


def test_gibberish_does_not_stretch_the_band(spark):
    rng = random.Random(9)
    rows = [(i, sentences(rng, rng.randint(20, 120)), "en") for i in range(300)]
    rows += [(1000 + i, " ".join("".join(rng.choices("bcdfgjkqvxz", k=6)) for _ in range(60)), "en") for i in range(12)]
    copies = [(2000 + i, rows[-1][1], "en") for i in range(9)]
    frame = spark.createDataFrame([(*x, "", 0) for x in rows + copies], SCHEMA)
    got = {x.doc_id: x for x in perplexity.judge(frame, perplexity.fit_folds(frame)).collect()}
    assert all(got[i].kept for i in range(300))
    assert not any(x.kept or x.base_failed for i, x in got.items() if i >= 1000)


def test_rare_grams_of_a_small_language_stay(spark):
    rng = random.Random(7)
    small = "zwölf boxkämpfer jagen viktor quer über den großen sylter deich"
    frame = spark.createDataFrame([(1, sentences(rng, 600_000), "en", "", 0), (2, small, "de", "", 0)], SCHEMA)
    model = perplexity.fit(frame)
    kept = {r["hash"] for r in model.table.select("hash").collect()}
    wanted = perplexity._mix(*perplexity._grams(list(perplexity._symbols(small))), perplexity.ORDER, perplexity._salt("de"))
    assert set(wanted.view(np.int64).tolist()) <= kept
    known, unlike = perplexities(spark, model, [small, "unlike all that was counted"], "de")
    assert known < unlike


def test_slices_have_every_gram(monkeypatch):
    bodies = [sentences(random.Random(6), 2000), "ab", "c" * 777 + "défg"]
    whole = perplexity._grams([p for b in bodies for p in perplexity._symbols(b)])
    monkeypatch.setattr("viewloom.llm.common.slices.__defaults__", (777,))
    parts = [p for b in bodies for p in perplexity._symbols(b)]
    assert len(parts) > 10
    for one, other in zip(whole, perplexity._grams(parts)):
        assert (one == other).all()
    assert len(whole[0]) == sum(len(b) + 1 for b in bodies)


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    for fit in (perplexity.fit, perplexity.fit_folds):
        assert perplexity.judge(empty, fit(empty)).count() == 0
    texts = spark.createDataFrame([(1, sentences(random.Random(3), 20), "en", "", 0), (2, None, None, "", 0)], SCHEMA)
    assert sorted((r.doc_id, r.kept, r.log_perplexity) for r in perplexity.judge(texts, perplexity.fit(empty)).collect()) == [(1, True, None), (2, False, None)]
