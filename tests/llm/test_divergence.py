import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "text string, lang string, source string"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(rows, least=3, top=200, scale=10**9):
    rows = [tuple(x or "" for x in r) for r in rows]
    by_lang = defaultdict(list)
    for text, lang, source in rows:
        by_lang[lang].append((source, Counter(TERM.findall(text.translate(LOWER)))))
    out = []
    for lang, docs in by_lang.items():
        held = Counter(t for _, c in docs for t in c)
        kept = [t for t, n in held.items() if n >= least]
        groups = defaultdict(Counter)
        for source, c in docs:
            groups[source].update(c)

        def p(counts):
            total = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + scale * (counts[t] + 1) // total for t in kept}

        shares = {s: p(c) for s, c in groups.items()}
        own = p(sum((c for _, c in docs), Counter()))
        f = lambda a, b: (a - b) ** 2 // b
        for s, mine in shares.items():
            pairs = [(o, sum(f(mine[t], other[t]) for t in kept)) for o, other in shares.items() if o != s]
            words = [(t, f(mine[t], own[t])) for t in kept if groups[s][t] and mine[t] > own[t]]
            for part, found, most in (("pair", pairs, None), ("term", words, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(found[:most])]
    return sorted(out)


def run(spark, rows, **more):
    return sorted(tuple(r) for r in D.divergences(spark.createDataFrame(rows, SCHEMA).repartition(3), **more).collect())


def random_rows(n, sources=4, seed=1):
    rng = np.random.default_rng(seed)
    words = ["Alpha", "beta", "BETA", "gamma-delta", "ÄÖ", "äö", "x1y", "don't", "été", "日本", "zz", "q"]
    return [
        (" ".join(rng.choice(words, rng.integers(0, 9))), ["en", "fr", None][rng.integers(3)], [None, "", *"abcdefgh"][rng.integers(sources)])
        for _ in range(n)
    ]


def test_like_brute_force(spark):
    rows = random_rows(120)
    assert run(spark, rows) == brute(rows)


def test_few_ranks_and_other_bounds(spark):
    rows = random_rows(80, seed=2)
    assert run(spark, rows, top=2, least=1, scale=10**6) == brute(rows, top=2, least=1, scale=10**6)


def test_groups_without_terms_and_languages_without_kept_terms(spark):
    rows = [("one two", "en", "a"), (None, "en", "b"), ("12 34", "en", "c"), ("once", "fr", "a"), ("", "fr", "b"), ("alone", "de", "a")]
    found = run(spark, rows)
    assert found == brute(rows)
    assert ("fr", "a", "pair", "b", 0, 1) in found and not [r for r in found if r[0] == "de"]


def test_stripes_that_are_handed_on_often(spark, monkeypatch):
    rows = random_rows(60, seed=3)
    batch = pa.RecordBatch.from_arrays([pa.array([(r[0] or "").encode() for r in rows]), pa.array([r[1] or "" for r in rows]), pa.array([r[2] or "" for r in rows])], ["text", "lang", "source"])

    def added(size):
        monkeypatch.setattr(D, "ENTRIES", size)
        total = Counter()
        for b in D.folded(iter([batch])):
            for r in b.to_pylist():
                for e in r["stripe"]:
                    total[r["lang"], r["term"], e["source"]] += e["n"]
        return total

    assert added(3) == added(10**6)


def test_sums_that_are_handed_on_often(monkeypatch):
    rng = np.random.default_rng(4)
    sources = [f"s{k}" for k in range(7)]
    stripes = [[{"source": s, "n": int(rng.integers(1, 50))} for s in sources if rng.random() < 0.5] or [{"source": "s0", "n": 1}] for _ in range(40)]
    total = np.array([sum(e["n"] for s in stripes for e in s if e["source"] == x) for x in sources], np.int64)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["en"] * 40), pa.array([b"w%d" % k for k in range(40)]), pa.array(stripes, pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())])))],
        ["lang", "term", "stripe"],
    )

    def added(cells):
        monkeypatch.setattr(D, "CELLS", cells)
        pairs, words = Counter(), []
        for b in D.Emitter({"en": (sources, total, 40)}, 10**9, 40).run(iter([batch])):
            for r in b.to_pylist():
                if r["part"] == "pair":
                    pairs[r["source"], r["item"]] += r["value"]
                else:
                    words.append((r["source"], r["item"], r["value"]))
        return pairs, sorted(words)

    assert added(20) == added(10**6)
    assert len(added(20)[0]) == 42


def test_several_passes(spark, monkeypatch):
    monkeypatch.setattr(D, "GROUPS", 2)
    rows = random_rows(90, sources=6, seed=5)
    assert run(spark, rows) == brute(rows)


def test_long_text_in_slices(monkeypatch):
    monkeypatch.setattr(D, "SLICE", 7)
    text = "The cat, THE dog; été ÉTÉ " * 50
    assert D.terms(text.encode()) == Counter(t.encode() for t in TERM.findall(text.translate(LOWER)))


@pytest.mark.parametrize("n, total, v", [(0, 0, 1), (10**15, 2 * 10**15, 7), (3, 10, 1), (5, 5, 1)])
def test_shares_are_exact(n, total, v):
    found = D.shares(np.array([n], np.int64), np.array([total], np.int64), v, 10**9)
    assert found.tolist() == [1 + 10**9 * (n + 1) // (total + v)]


def test_repeated_rows_extra_columns_and_no_rows(spark):
    rows = random_rows(20, seed=6) * 2
    df = spark.createDataFrame([(*r, "x", 1, 2.0) for r in rows], f"{SCHEMA}, term string, value long, rank double")
    assert sorted(tuple(r) for r in D.divergences(df).collect()) == brute(rows)
    empty = D.divergences(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["lang", "source", "part", "item", "value", "rank"] and empty.collect() == []
