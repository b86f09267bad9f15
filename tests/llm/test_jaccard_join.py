import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import shingles
from tidemark.llm.components import components
from tidemark.llm.jaccard_join import BITMAP, drop_similar, may_link, meetings, similar_sets

SCHEMA = "doc_id long, text string, n int, id string, component long"


def word_set(text, width):
    lowered = "".join(c.lower() if c < "\x80" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lowered) if w]
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, width, percent):
    sets = [word_set(t, width) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (key, *_) in enumerate(rows):
        own = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((key, len(sets[i]), min(own, default=None) if sets[i] else key))
    return sorted(out, key=str)


def sample(seed, bases=12, copies=25):
    """Groups of near copies on both sides of the limit, chains, a passage that many share."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("aeiouäßxyz") for _ in range(rnd.randrange(1, 6)))
    line = [word() for _ in range(30)]
    rows = []
    for _ in range(bases):
        base = [word() for _ in range(rnd.choice([1, 3, 4, 5, 12, 40, 90, 250]))]
        for _ in range(copies):
            own = list(base)
            for _ in range(rnd.randrange(4)):
                own[rnd.randrange(len(own))] = word()
            own += line if rnd.random() < 0.4 else []
            rows.append((" \t\n" [rnd.randrange(3)] * rnd.randrange(1, 3)).join(own))
            base = own[:len(base)] if rnd.random() < 0.2 else base
    rows += [rows[0].upper(), rows[0], None, "", " \n", None, "x", "X", "é", "É", "long " * 70000, " ".join(map(str, range(300000)))]
    rows = [(k * 3, t, 0, "s", 1) for k, t in enumerate(rows)]
    rnd.shuffle(rows)
    return rows + [rows[5], (None, rows[6][1], 0, "s", 1), (None, "only null", 0, "s", 1), (rows[7][0], "another text", 0, "s", 1)]


@pytest.mark.parametrize("seed,width,percent", [(1, 4, 85), (2, 5, 80), (3, 1, 50)])
def test_against_brute_force(spark, seed, width, percent):
    rows = sample(seed)
    got = similar_sets(spark.createDataFrame(rows, SCHEMA).repartition(5), width=width, percent=percent).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, width, percent)


def test_empty(spark):
    assert similar_sets(spark.createDataFrame([], SCHEMA)).collect() == []


def test_one_of_each_component_stays(spark):
    rows = [r for r in sample(4, 4, 10) if r[0] is not None]
    kept = drop_similar(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "n", "id", "component"]
    assert sorted({r.doc_id for r in kept.collect()}) == sorted({k for k, _, c in brute(rows, 5, 80) if k == c})


def test_blocks_do_not_change_shingles(monkeypatch):
    texts = pa.array([None, "a b  c d e", "one\ntwo", "w" * 300, "many words " * 100, "Ä ä Z z"])
    whole = [s.tolist() for s in shingles.documents(texts, 3)]
    assert [len(s) for s in whole] == [0, 3, 1, 1, 2, 2]
    monkeypatch.setattr(shingles, "BLOCK", 16)
    assert [s.tolist() for s in shingles.documents(texts, 3)] == whole
    assert [s.tolist() for s in shingles.documents(texts.slice(2, 3), 3)] == whole[2:5]


def test_components(spark):
    rnd = np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in rnd.integers(0, 400, (300, 2))] + [(k, k + 1) for k in range(500, 560)] + [(600, 600 + k) for k in range(90)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}
    for _ in range(100):
        for a, b in links:
            root[a] = root[b] = min(root.get(a, a), root.get(b, b))
    assert got == {k: v for k, v in root.items() if any(k in p and p[0] != p[1] for p in links)}


def placed(spark, rows):
    """Rows (token, node, n, at), every set a component of its own, with empty bitmaps."""
    df = spark.createDataFrame(rows, "token long, node long, n int, at int")
    return df.withColumn("component", F.col("node")).withColumns({b: F.lit(0).cast("long") for b in BITMAP})


def test_late_sets_do_not_meet(spark):
    """Unlinked sets of one template: what is paired does not follow the square of their number."""
    for number in (100, 200, 400):
        rows = [(t, k, 300 + k % 7, 36 + t) for k in range(number) for t in range(4)]
        rows += [(0, number, 300, 1)]  # one set that is early
        assert meetings(placed(spark, rows), 85).count() <= 3 * number


@pytest.mark.parametrize("percent", [80, 85, 100])
def test_all_that_may_link_meet(spark, percent):
    rnd = random.Random(percent)
    sizes = [rnd.randrange(1, 120) for _ in range(150)]
    rows = [(0, k, n, rnd.randrange(n - (percent * n + 99) // 100 + 1)) for k, n in enumerate(sizes)]
    mixed = placed(spark, rows)
    pair = lambda df: {(min(r.a, r.b), max(r.a, r.b)) for r in df.where("a <> b").where(may_link("a", "b", percent)).select("a", "b").collect()}
    x, y = (mixed.select(F.col("node").alias(c), F.col("n").alias(f"{c}n"), F.col("at").alias(f"{c}at")) for c in "ab")
    every = pair(x.join(y, F.col("a") < F.col("b")))
    assert every and pair(meetings(mixed, percent)) == every
