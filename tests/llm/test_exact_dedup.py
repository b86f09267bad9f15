import hashlib
import re
from collections import defaultdict

import pytest

from tidemark.llm.exact_dedup import drop_copies, exact_dedup

SCHEMA = "doc_id long, text string, id string, digest int"
ROWS = [
    (5, "a  b", "x", 1), (3, "a\tb", "x", 2), (9, "a b", None, 3), (4, None, "y", 4), (2, "", "y", 5), (7, " ", "z", 6),
    (8, "c", "z", 7), (8, "c", "z", 7), (None, "c", "z", 8), (None, "d", "z", 9), (11, "a b", "z", 1), (12, "long " * 50000, "z", 1),
]


def expected(rows):
    groups = defaultdict(list)
    for key, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(key)
    out = []
    for key, text, *_ in rows:
        body = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        keep = min((k for k in groups[body] if k is not None), default=None)
        out.append((key, keep, len(groups[body]), key == keep, hashlib.sha256(body.encode()).hexdigest()))
    return sorted(out, key=str)


# with one byte of digest, different texts collide and must still be told apart
@pytest.mark.parametrize("digest_bytes", [32, 1, 0])
def test_against_brute_force(spark, digest_bytes):
    rows = ROWS + [(100 + i, f"text {i % 300}", "s", 0) for i in range(900)]
    got = exact_dedup(spark.createDataFrame(rows, SCHEMA), digest_bytes=digest_bytes).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)


def test_empty(spark):
    assert exact_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_one_row_of_each_group_stays(spark):
    kept = drop_copies(spark.createDataFrame(ROWS, SCHEMA))
    assert kept.columns == ["doc_id", "text", "id", "digest"]
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3, 7, 8, 11, 12]


def test_unique_keys(spark):
    rows = [(k, f"t {k % 7}", "x", 1) for k in range(40)]
    assert sorted(r.doc_id for r in drop_copies(spark.createDataFrame(rows, SCHEMA)).collect()) == list(range(7))
