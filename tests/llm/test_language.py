import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from tidemark.llm.common import different_rows, level, remainder
from tidemark.llm.language import LanguageModel, fit, identify, learn, recognised
from tidemark.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, score string, held_out int"


def test_backoff_by_hand():
    a = lambda x, y: np.array([x, y], float)
    grams = [{"x": a(-3, -4), "y": a(-5, -1), " ": a(-1, -1)}, {"xy": a(-2, -9)}]
    model = LanguageModel(["aa", "bb"], {"known": a(-1, -6)}, grams, a(-7, -7))
    # the word " xy ": " x" falls back to " " and "x", "xy" is known, "y " falls back to "y" and " "
    expected = (a(-2, -2.5) + a(-2, -9) + a(-3, -1)) / 3
    assert np.allclose(model.word("xy"), expected)
    assert np.allclose(model.word("q"), (a(-4, -4) + a(-4, -4)) / 2)
    label, score = model.predict("KNOWN xy, known!")
    mean = (2 * a(-1, -6) + expected) / 3
    assert label == "aa" and math.isclose(score, 1 / (1 + math.exp(mean[1] - mean[0])))


@pytest.mark.parametrize("text", [None, "", " 12 _ ?!", "²³½"])
def test_no_letter(text):
    assert LanguageModel(["a"], {}, [{}], np.zeros(1)).predict(text) == ("und", 0.0)


def test_edge_cases(spark):
    rnd = random.Random(1)
    rows = [(k, " ".join(rnd.choice(["der", "und", "nicht"] if k % 2 else ["the", "of", "not"]) for _ in range(9)), ["en", "de"][k % 2], "x", 1) for k in range(40)]
    rows += [(None, "the of the", "en", "x", 1), (90, None, "en", "x", 1), (91, "the the", None, "x", 1), (92, "m² the", "en", "x", 1), (93, "der " * 200000, None, "x", 1)]
    rows += [rows[0]]
    df = spark.createDataFrame(rows, SCHEMA)
    got = identify(df.withColumn("copy", F.col("text")), learn(df, rows=30))
    assert got.columns == ["doc_id", "lang", "held_out", "copy", "lang_pred", "score"]
    for r in got.withColumnRenamed("copy", "text").collect():
        assert r.lang_pred == ("und" if r.text is None else "de" if "der" in r.text or "und" in r.text or "nicht" in r.text else "en")
        assert 0 <= r.score <= 1
    none = spark.createDataFrame([], SCHEMA)
    assert identify(none, fit(none)).collect() == []
    assert {r.lang_pred for r in identify(df, fit(none)).collect()} == {"und"}


def test_no_word_or_language_is_cut(spark):
    letters = "abcdefghij"
    word = lambda k: "".join(letters[int(d)] for d in f"{k:06d}")
    rows = [(k, " ".join(2 * [word(j) for j in range(1000 * k, 1000 * k + 1000)]), "aa") for k in range(110)] + [(200, "zuv zuv zux", "zz")]
    model = fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "zz"]
    assert model.known == 110_001 and set(model.words.place) == {word(k) for k in range(110_000)} | {"zuv"}
    assert np.allclose(model.word("zuv"), np.log([0.5 / (220_000 + 0.5 * 110_002), 2.5 / (3 + 0.5 * 110_002)]))
    assert {" zu", "zuv", "zux", "uv ", "ux "} <= set(model.grams[2].place)
    assert np.allclose(model.gram(" zu")[1], math.log(3.5 / (9 + 0.5 * len(model.grams[2].place))))
    assert model.predict("zuv zux")[0] == "zz" and model.predict(word(7))[0] == "aa"


def test_sample_per_language(spark):
    assert [level(c, 10) for c in ([], [3], [4, 5], [100, 2], [100, 2, 50], [1] * 20)] == [1, 3, 5, 8, 4, 1]
    rows = [(k, "the of not", "en") for k in range(1000)] + [(2000 + k, "der und nicht", "de") for k in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = learn(df, rows=20)
    assert model.languages == ["de", "en"]
    assert np.allclose(model.word("der") - model.word("und"), 0) and model.predict("nicht und")[0] == "de"
    entries = len(model.words.place)
    assert np.allclose(model.word("the")[1], math.log((17 + 0.5) / (51 + 0.5 * entries)))


def test_sample_is_of_different_rows_with_the_lowest_hashes(spark):
    rows = [(k % 900, f"w{chr(97 + k % 26)}{'xyz'[k % 3]} common common", ["aa", "bb"][k % 10 == 0]) for k in range(3000)]
    rows += [(None, "zero zero", "aa")] * 400 + [(7, "seven seven", "cc")] * 300
    df = spark.createDataFrame(rows, "key long, text string, lang string")
    ranked = df.distinct().selectExpr("*", "row_number() over (partition by lang order by xxhash64(key, text, lang)) k")
    picked = ranked.where("k <= 20").drop("k")  # an equal share of 60
    one, two = learn(df, rows=60, key="key"), fit(picked)
    assert one.languages == two.languages == ["aa", "bb", "cc"] and one.words.place.keys() == two.words.place.keys()
    assert all(np.allclose(one.word(w), two.word(w)) for w in two.words.place)


def test_rows_of_one_key_do_not_pass_the_bound(spark):
    rows = [(1, f"some words of text {chr(97 + k % 26)}{chr(97 + k // 26 % 26)}", "aa") for k in range(500)] * 3 + [(1, "the same text", "bb")] * 500
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    picked = different_rows(df, 10)
    assert picked.count() == 10 and picked.distinct().count() == 10
    both = [r.lang for r in different_rows(df, 10, by="lang").collect()]
    assert sorted(both) == ["aa"] * 5 + ["bb"]
    assert different_rows(df.limit(0), 10, by="lang").collect() == []


def brute_counts(docs, longest=4):
    """Log frequencies by language of words seen twice and of n-grams, and what unknown signs count."""
    words = defaultdict(Counter)
    for text, lang in docs:
        if text is not None and lang is not None:
            words[lang].update(regex.findall(r"\p{L}+", text.lower()))
    langs = sorted(words)
    every = Counter(w for lang in langs for w in words[lang].elements())
    total = {x: words[x].total() for x in langs}
    log = lambda n, t, m: math.log((n + 0.5) / (t + 0.5 * m))
    known = {w: [log(words[x][w], total[x], len(every)) for x in langs] for w, n in every.items() if n > 1}
    grams = []
    for size in range(1, longest + 1):
        own = {x: Counter() for x in langs}
        for x in langs:
            for w, n in words[x].items():
                for k in range(len(w) + 3 - size):
                    own[x][f" {w} "[k : k + size]] += n
        names = {g for c in own.values() for g in c}
        grams.append({g: [log(own[x][g], own[x].total(), len(names)) for x in langs] for g in names})
    return langs, known, grams


def brute_predict(text, langs, known, grams):
    floor = [-math.log(2 * len(grams[0]) + 2)] * len(langs)

    def gram(g):
        if g in grams[len(g) - 1]:
            return grams[len(g) - 1][g]
        return floor if len(g) == 1 else [(a + b) / 2 for a, b in zip(gram(g[:-1]), gram(g[1:]))]

    def word(w):
        if w in known:
            return known[w]
        padded = f" {w} "
        size = min(len(grams), len(padded))
        rows = [gram(padded[k : k + size]) for k in range(len(padded) - size + 1)]
        return [sum(r) / len(rows) for r in zip(*rows)]

    words = regex.findall(r"\p{L}+", (text or "").lower())
    if not words:
        return "und", 0.0
    mean = [sum(c) / len(words) for c in zip(*map(word, words))]
    weights = [math.exp(m - max(mean)) for m in mean]
    best = max(range(len(langs)), key=lambda k: (weights[k], -k))
    return langs[best], weights[best] / sum(weights)


def test_table_like_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    model = learn(docs)  # all rows are below the bound
    rows = [(r.text, r.lang) for r in docs.distinct().collect()]
    learned = brute_counts(rows)
    assert model.languages == learned[0] and model.words.place.keys() == learned[1].keys()
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(docs, model).collect()}
    for r in docs.collect():
        label, score = brute_predict(r.text, *learned)
        assert got[r.doc_id][0] == label and math.isclose(got[r.doc_id][1], score, rel_tol=1e-3, abs_tol=1e-6)


def test_recognised_keeps_rows_by_key_or_by_key_and_text(spark):
    model = LanguageModel(["aa", "bb"], {"yes": np.array([-1.0, -9.0]), "even": np.array([-3.0, -3.0])}, [{}], np.array([-5.0, -5.0]))
    schema = "doc_id long, text string, id string, digest int, lang_pred string"
    rows = [(1, "yes", "a", 1, "x"), (2, None, None, 2, "x"), (3, "", "a", 3, "x"), (4, "even", "a", 4, "x"), (None, "yes yes", "a", 5, "x")]
    for more in ([], [(1, "12", "a", 6, "x"), (1, "yes", "a", 7, "x"), (None, None, "a", 8, "x")]):
        kept = recognised(spark.createDataFrame(rows + more, schema), model)
        assert kept.columns == ["doc_id", "text", "id", "digest", "lang_pred"]
        assert sorted(r.digest for r in kept.collect()) == [1, 5, 7][: 2 + bool(more)]
    assert recognised(spark.createDataFrame([], schema), model).collect() == []


def test_held_out_accuracy(spark):
    got = QUERIES["op10_language"](spark, SF).where("held_out")
    docs = table(spark, SF, "documents")
    assert got.join(docs.where(remainder(F.col("doc_id"), 4) != 2), "doc_id", "left_semi").isEmpty()
    right = got.join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98
