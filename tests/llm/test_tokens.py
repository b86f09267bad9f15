import random

import pytest
from tokenizers import Tokenizer

from tidemark.llm.queries import QUERIES
from tidemark.llm.tokens import TOKENIZERS, token_counts

SCHEMA = "doc_id long, text string, section string, start int"


def brute(text, rule):
    """By another library's tokenizer of the same vocabulary, token by token over its byte spans."""
    own = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    own.encode_special_tokens = True
    text = text or ""
    lines = [x + "\n" for x in text.split("\n")]
    lines[-1] = lines[-1][:-1]
    if len(lines) > 1 and not lines[-1]:
        lines.pop()
    sizes = [len(x.encode()) for x in lines]
    section_of = [k for k, n in enumerate(sizes) for _ in range(n)]
    counts, crossing, at = [0] * len(lines), [0] * len(lines), 0
    for token in own.encode(text, add_special_tokens=False).tokens:
        n = len(token)  # this vocabulary writes every byte as one character
        places = section_of[at:at + n]
        best = {"first": places[0], "last": places[-1], "larger": max(sorted(set(places)), key=places.count)}[rule]
        counts[best] += 1
        crossing[best] += places[0] != places[-1]
        at += n
    out, start = [], 0
    for k, line in enumerate(lines):
        out.append((k, start, start + len(line), counts[k], crossing[k]))
        start += len(line)
    return out


def sample():
    rnd = random.Random(2)
    parts = ["\n", "\n\n\n", " ", "   ", "word", " Wörter", "é", "漢字", "🙂", "12345", "!?", "\r\n", "\t", "<|endoftext|>", "it's", "\n \n"]
    return [None, "", "\n", "a\n", "\n\n\n\n", "no break"] + ["".join(rnd.choice(parts) for _ in range(rnd.randrange(60))) for _ in range(150)]


@pytest.mark.parametrize("rule", ["first", "last", "larger"])
def test_against_brute_force(spark, rule):
    rows = [(k, t, "x", 1) for k, t in enumerate(sample())]
    got = token_counts(spark.createDataFrame(rows, SCHEMA), rule=rule)
    assert got.columns == ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"]
    assert sorted(tuple(r) for r in got.collect()) == [(k, *x) for k, t, *_ in rows for x in brute(t, rule)]


def test_crossing_tokens_happen():
    assert any(x[4] for t in sample() for x in brute(t, "first"))


def test_edges(spark):
    rows = [(None, "a b", "x", 1), (7, "a b", "x", 1), (7, "a b", "x", 1), (8, "line é\n" * 50000, "x", 1)]
    got = token_counts(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sum(r.n_tokens for r in got if r.doc_id != 8) == 6
    assert sum(r.doc_id == 8 for r in got) == 50000
    assert token_counts(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        token_counts(spark.createDataFrame(rows, SCHEMA), rule="other")


def test_sections_cover_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = QUERIES["op5_token_counts"](spark, sf)
    total = rows.groupBy("doc_id").agg({"n_tokens": "sum", "end": "max"}).collect()
    own = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {(r.doc_id, r[1], r[2]) for r in total} == {(k, len(own.encode(t, add_special_tokens=False).ids), len(t)) for k, t in texts.items()}
