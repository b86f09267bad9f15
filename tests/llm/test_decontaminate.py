import random
import re

import pytest

from tidemark.llm.decontaminate import drop_leaks, leaks

DOCS = "doc_id long, text string, leaking string, id string"
ITEMS = "item_id long, text string, doc_id int"


def tokens(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def brute(docs, items, width=5, percent=80):
    best = {}
    for key, text, *_ in docs:
        t = tokens(text)
        for item, body, *_ in items:
            q = tokens(body)
            n = min(width, len(q))
            if not n:
                continue
            parts = {tuple(q[i:i + n]) for i in range(len(q) - n + 1)}
            shared = len(parts & {tuple(t[i:i + n]) for i in range(len(t) - n + 1)})
            if 100 * shared >= percent * len(parts):
                best[key, item] = max(best.get((key, item), (0, 0, 0)), (shared / len(parts), shared, len(parts)))
    return sorted(((k, i, s, n, c) for (k, i), (c, s, n) in best.items()), key=str)


def sample(seed):
    rnd = random.Random(seed)
    text = lambda n: " ".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") + rnd.choice("xyz") for _ in range(n))
    items = [(i, text(rnd.choice([1, 2, 4, 5, 6, 9, 20, 33, 70, 130])), 0) for i in range(25)]
    items += [(3, items[3][1].upper(), 1), (None, text(12), 1), (90, "", 1), (91, None, 1), (92, "... !", 1)]
    docs = [(1, None, "a", "b"), (2, "", "a", "b"), (None, text(60), "a", "b"), (None, items[-4][1], "a", "b")]
    for k in range(60):
        body = text(rnd.choice([0, 3, 40, 900])).split()
        for _ in range(rnd.randrange(3)):
            own = (items[rnd.randrange(26)][1]).split()
            for _ in range(rnd.randrange(4)):  # edits around the limit
                own[rnd.randrange(len(own))] = "zz"
            at = rnd.randrange(len(body) + 1)
            body[at:at] = own
        docs.append((10 + k, ", ".join(body), "a", "b"))
    docs += [docs[-1], (docs[-1][0], items[5][1], "a", "b"), (7, text(60000) + " " + items[7][1], "a", "b")]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    docs, items = sample(seed)
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert sorted((tuple(r) for r in leaks(d, i).collect()), key=str) == brute(docs, items)


def test_sides_may_be_empty(spark):
    docs, items = sample(3)
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame(items, ITEMS)
    assert leaks(none, some).collect() == []
    assert leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], ITEMS)).collect() == []


def test_clean_documents_stay(spark):
    docs, items = sample(4)
    bad = {k for k, *_ in brute(docs, items)}
    kept = drop_leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert sorted(kept.collect(), key=str) == sorted((d for d in docs if d[0] not in bad), key=str)
