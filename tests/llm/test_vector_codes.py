import hashlib
from collections import defaultdict
from math import floor, inf, isfinite, nan

import numpy as np
import pytest

from tidemark.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def nearest(part, book):
    return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))


def brute(rows, parts, entries, rounds=2):
    kept = [r for r in rows if r[1] and all(x is not None and isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[1]))
    whole = [[floor(256 * float(np.float32(x))) for x in r[1]] for r in kept]
    width = len(whole[0]) // parts
    cut = [[v[k * width : (k + 1) * width] for k in range(parts)] for v in whole]
    books = [[v[k] for v in cut[:entries]] for k in range(parts)]
    for _ in range(rounds):
        for k in range(parts):
            own = defaultdict(list)
            for v in cut:
                own[nearest(v[k], books[k])[1]].append(v[k])
            books[k] = [[sum(c) // len(c) for c in zip(*own[j])] if j in own else e for j, e in enumerate(books[k])]
    found = [[nearest(v[k], books[k]) for k in range(parts)] for v in cut]
    by_label = defaultdict(int)
    for r, f in zip(kept, found):
        by_label[r[2]] += sum(d for d, _ in f)
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{k:02x}" for _, k in f), sum(d for d, _ in f), by_label[r[2]], sha) for r, f in zip(kept, found)), key=repr)


def run(spark, rows, **more):
    return sorted([tuple(r) for r in V.compress(spark.createDataFrame(rows, SCHEMA).repartition(3), **more).collect()], key=repr)


def random_rows(n, size=8, seed=1):
    rng = np.random.default_rng(seed)
    return [(int(k), [float(np.float32(x)) for x in rng.normal(0, 0.02, size)], [1, 2, None][rng.integers(3)]) for k in rng.permutation(n)]


def test_like_brute_force(spark):
    rows = random_rows(200)
    assert run(spark, rows, parts=4, entries=16) == brute(rows, 4, 16)


def test_rows_left_out_ties_and_repeated_rows(spark):
    same = [0.5, -0.25, 0.0, 0.125]
    rows = [(1, same, 1), (1, same, 1), (2, same, None), (3, None, 1), (4, [], 1), (5, [0.5, None, 0.0, 0.0], 1), (6, [nan, 0.0, 0.0, 0.0], 1),
            (7, [inf, 0.0, 0.0, 0.0], 1), (8, [-inf, 0.0, 0.0, 0.0], 1), (None, [0.25, 0.25, 0.0, -1.0], None), (9, [-0.001, 0.0, 0.0, 0.0], 1)]
    for entries in (2, 3, 64):
        assert run(spark, rows, parts=2, entries=entries) == brute(rows, 2, entries)
    assert len(run(spark, rows, parts=2)) == 5


@pytest.mark.parametrize("seed", range(6))
def test_search_finds_the_nearest_lowest_entry(seed):
    rng = np.random.default_rng(seed)
    entries = rng.integers(-3, 4, (40, 2)) if seed % 2 else rng.integers(-500, 500, (64, 4))  # small numbers: many ties and equal entries
    points = np.concatenate([rng.integers(-5, 6, (300, entries.shape[1])), rng.integers(-600, 600, (300, entries.shape[1])), entries])
    best, error = V.Codebook(entries).search(points)
    distances = ((points[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    assert (best == distances.argmin(axis=1)).all() and (error == distances.min(axis=1)).all()


def test_search_looks_at_few_entries():
    class Counting(V.Codebook):
        looked = 0

        def distance(self, parts, entry):
            self.looked += len(parts)
            return super().distance(parts, entry)

    rng = np.random.default_rng(9)
    entries = rng.integers(-1000, 1000, (64, 2))
    points = entries.repeat(10, axis=0) + rng.integers(-20, 21, (640, 2))
    book = Counting(entries)
    book.search(points)
    assert book.looked < 20 * len(points)  # of 64


def test_unused_entries_stay_and_equal_entries_give_the_lower_number(spark):
    rows = [(k, [1.0, 1.0], k % 2) for k in range(5)] + [(9, [2.0, 0.0], 0)]
    found = run(spark, rows, parts=1, entries=4)
    assert found == brute(rows, 1, 4)
    assert {r[1] for r in found} == {"00", "01"}  # the mean of the first round takes entry 0 away from the five


def test_wrong_vectors_are_errors(spark):
    with pytest.raises(ValueError, match="equal parts"):
        V.compress(spark.createDataFrame([(1, [1.0] * 5, 1)], SCHEMA), parts=2)
    with pytest.raises(ValueError, match="no exact codes"):
        V.compress(spark.createDataFrame([(1, [1e9, 0.0], 1)], SCHEMA), parts=2)
    with pytest.raises(Exception, match="must all have 2 components"):
        V.compress(spark.createDataFrame([(1, [1.0, 0.0], 1), (2, [1.0], 1), (3, [1.0], 1)], SCHEMA), parts=2, entries=1).collect()


def test_extra_columns_and_no_rows(spark):
    rows = random_rows(30, seed=3)
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], f"{SCHEMA}, code string, error long, vector string")
    assert sorted([tuple(r) for r in V.compress(df, parts=4, entries=8).collect()], key=repr) == brute(rows, 4, 8)
    for none in ([], [(1, None, 1)]):
        empty = V.compress(spark.createDataFrame(none, SCHEMA))
        assert empty.collect() == [] and empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
