import hashlib
import random
import re
import string

import numpy as np
import pytest

from tidemark.llm import secrets
from tidemark.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, spans string, kind int"


def brute(text):
    """The three patterns as they are stated, matches that are too short dropped afterwards."""
    text = text or ""
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.A | re.I) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16])


def soup(rnd):
    parts = ["password", "PassWD", "secret", "ſecret", "toKen", "api_key", "apikey", '"', "'", " ", "  ", ":", "=", "==", "AKIA", "AKIAAKIA", "é", "漢", "\n",
             "deadbeef", "0123456789abcdef", "ABCDEFGHIJKLMNOP", "x" * 11, "x" * 12, "f" * 15, "-", "."]
    return "".join(rnd.choice(parts) for _ in range(rnd.randrange(40)))


@pytest.mark.parametrize("seed", range(4))
def test_base_spans(seed):
    rnd = random.Random(seed)
    for _ in range(3000):
        text = soup(rnd)
        assert sorted(secrets.base_spans(text)) == brute(text)


def test_markov_by_hand():
    models = secrets.MarkovPair.of(secrets.transitions(["ab", "ab"]), secrets.transitions(["aa"]))
    n, prior = secrets.STATES, secrets.PRIOR
    any_a, any_b = (2 + 0.5) / (4 + 0.5 * n), (2 + 0.5) / (4 + 0.5 * n)  # random: 2 of 4 each
    other_a, other_b = (2 + 0.5) / (2 + 0.5 * n), 0.5 / (2 + 0.5 * n)  # ordinary: a only
    first = np.log((2 + prior * any_a) / (2 + prior)) - np.log((1 + prior * other_a) / (1 + prior))
    second = np.log((2 + prior * any_b) / (2 + prior)) - np.log(prior * other_b / (1 + prior))
    assert np.isclose(models.score("ab"), first + second)
    assert secrets.MarkovPair.of(secrets.transitions([]), secrets.transitions(["aa"])).score("ab") == 0


def test_random_strings_are_told_from_identifiers(spark):
    rnd = random.Random(3)
    token = lambda: "".join(rnd.choice(string.ascii_letters + string.digits) for _ in range(24))
    name = lambda: "_".join(rnd.choice(["customer", "account", "value", "total", "internal", "service", "index"]) for _ in range(4))
    samples = [(token(), 1) for _ in range(300)] + [(name(), 0) for _ in range(300)] + [(None, 1), ("", 0), ("x", None)]
    models = secrets.train(spark.createDataFrame(samples, "text string, label int"))
    rows = [(k, f"see {token() if k % 2 else name()} here", "s", 1) for k in range(200)]
    found = secrets.scan(spark.createDataFrame(rows, SCHEMA), models).collect()
    right = sum(([s.kind for s in r.spans] == ["random"]) == bool(r.doc_id % 2) for r in found)
    assert right >= 195


@pytest.fixture(scope="module")
def models(spark):
    rnd = random.Random(11)
    words = ["customer", "account", "value", "total", "internal", "service", "index", "session", "Authorization", "example", "download", "access"]
    samples = [("".join(rnd.choice(string.ascii_letters + string.digits) for _ in range(24)), 1) for _ in range(600)]
    samples += [(rnd.choice(words) + rnd.choice(words).title(), 0) for _ in range(2000)]
    return secrets.train(spark.createDataFrame(samples, "text string, label int"))


@pytest.mark.parametrize("before", ["", "Authorization=", "session_id=", "example/account/customers/internal/service/", "/download/access?session=", "total-value-index-"])
@pytest.mark.parametrize("after", ["", "/customer/account/value", "&total=value"])
def test_keys_behind_paths_and_assignments(models, before, after):
    rnd = random.Random(7)
    found = 0
    for _ in range(100):
        key = "".join(rnd.choice(string.ascii_letters + string.digits) for _ in range(24))
        text = f"see {before}{key}{after} here"
        spans = [(a, b) for a, k, b in secrets.all_spans(text, models, 12.0, 0.5) if k == 3]
        start = 4 + len(before)
        found += len(spans) == 1 and abs(spans[0][0] - start) <= 4 and abs(spans[0][1] - start - 24) <= 4
    assert found >= 90
    assert not secrets.all_spans(f"see {before}customer/internal_service{after} here", models, 12.0, 0.5)


def test_several_keys_in_a_run_and_base_spans_cut_out(models):
    one, two, code = "x7Qp9LmZ2vRt8KdW4sBn", "B3kT9xWq7ZpL2mVn8RsD", "0123456789abcdef" * 2
    path = "account/customer/internal/service/example/download"
    text = f"{one}/{path}/{two}"
    assert [text[a:b] for a, _, b in secrets.all_spans(text, models, 12.0, 0.5)] == [one, two]
    text = f"{path}/{code}/{one}"
    assert [(k, text[a:b]) for a, k, b in secrets.all_spans(text, models, 12.0, 0.5)] == [(2, code), (3, one)]


def test_a_run_that_is_random_as_a_whole_is_covered(models):
    rnd = random.Random(9)
    for _ in range(300):
        run = "".join(rnd.choice(string.ascii_letters + string.digits) for _ in range(rnd.randrange(16, 60)))
        score = models.score(run)
        if score >= 12 and score >= 0.5 * len(run) and not secrets.base_spans(run):
            assert secrets.all_spans(run, models, 12.0, 0.5) == [(0, 3, len(run))]


def test_edge_cases(spark):
    key = "AKIA" + "Q7" * 8
    rows = [(1, None, "s", 1), (2, "", "s", 1), (None, f"{key} {key}", "s", 1), (3, f"password={key}", "s", 1), (3, f"password={key}", "s", 1),
            (4, "word " * 300000 + key, "s", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = secrets.scan(df, secrets.learn(df))
    assert got.columns == ["doc_id", "kind", "spans"]
    spans = [(r.doc_id, [tuple(s) for s in r.spans]) for r in got.collect()]
    assert spans == [(1, []), (2, []), (None, [("access", 0, 20), ("access", 21, 41)])] + 2 * [(3, [("assign", 0, 29), ("access", 9, 29)])] + [
        (4, [("access", 1500000, 1500020)])
    ]
    none = spark.createDataFrame([], SCHEMA)
    assert secrets.scan(none, secrets.learn(none)).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op4_secrets"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = brute(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == n for _, k, _ in base) for n in range(3)]
        said = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert set(said.split(",")) - {""} <= set(r.spans.split(","))
