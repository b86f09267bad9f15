import random

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor

from tidemark.llm.pieces import MODEL, SPACE, START, decode, encode, encode_parts, handed_down, joined, pieces_of, signature, product, read, states, written
from tidemark.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, chunk int, ids string"
LIB = SentencePieceProcessor(model_file=MODEL)


def text_of(rnd, n):
    known = [LIB.id_to_piece(k) for k in range(300, 32000, 11)]
    odd = [" ", "\n", "\t", "漢", "　", "🙂", SPACE, "the", "\x00", "é"]
    out = "".join(rnd.choice([rnd.choice(known), rnd.choice("abcdeth"), " ", " " * rnd.randrange(40), rnd.choice(odd)]) for _ in range(n))
    return out.replace(" ", "").replace(SPACE, "") if rnd.random() < 0.3 else out


@pytest.mark.parametrize("seed", range(3))
def test_scan_equals_library(seed):
    """Cuts anywhere, also inside pieces and in texts without a blank."""
    rnd, pieces = random.Random(seed), pieces_of(MODEL)
    for _ in range(80):
        body = text_of(rnd, rnd.randrange(5, 150))
        text, size = SPACE + body.replace(" ", SPACE), rnd.choice([40, 64, 100])
        cuts = [k * size for k in range(max(1, len(text) // size))] + [len(text)]
        seen = [(text[max(0, a - 16):b + 16], min(a, 16), b - a + min(a, 16)) for a, b in zip(cuts, cuts[1:])]
        matrices = [read(written(pieces.transfer(*x))) for x in seen]
        passed = states(matrices)
        ids = [n for k, x in enumerate(seen) for n in pieces.encode_chunk(*x, passed[k], passed[k + 1])]
        assert ids == LIB.encode(body)
        if len(matrices) > 2:
            a, b, c = matrices[0], matrices[1], matrices[2]
            assert product(product(a, b), c) == product(a, product(b, c))


def best_path(matrices):
    """States of the best path, one matrix after the other."""
    ways = {START: (0.0, [START])}
    for m in matrices:
        after = {}
        for (a, b), w in m.items():
            if a in ways and ways[a][0] + w > after.get(b, (-np.inf,))[0]:
                after[b] = (ways[a][0] + w, [*ways[a][1], b])
        ways = after
    return max((way for s, way in ways.items() if s[0] == 0), key=lambda x: x[0])


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 40])
def test_tree_finds_the_best_path(n):
    rnd = random.Random(n)
    cuts = [[START], *([(k, "p") for k in range(rnd.randrange(1, 6))] for _ in range(n - 1)), [START, (1, "x")]]
    matrices = [{(a, b): rnd.random() for a in x for b in y if a is x[0] or b is y[0] or rnd.random() < 0.7} for x, y in zip(cuts, cuts[1:])]
    weight, way = best_path(matrices)
    assert states(matrices) == way
    assert states(matrices, START, (1, "x"))[-1] == (1, "x")
    assert sum(m[a, b] for m, a, b in zip(matrices, way, way[1:])) == pytest.approx(weight)


def test_states_of_many_chunks_go_up_and_down_in_groups(spark):
    """Texts of 1 to 300 chunks, three levels of groups of 16."""
    rnd, rows, expected = random.Random(5), [], set()
    for row, n in enumerate([1, 2, 16, 17, 256, 300]):
        cuts = [[START], *([(k, "p") for k in range(rnd.randrange(1, 4))] for _ in range(n - 1)), [START]]
        matrices = [{(a, b): rnd.random() for a in x for b in y} for x, y in zip(cuts, cuts[1:])]
        rows += [(row, k, written(m)) for k, m in enumerate(matrices)]
        way = best_path(matrices)[1]
        expected |= {(row, k, *a, *b) for k, (a, b) in enumerate(zip(way, way[1:]))}
    passed = handed_down(spark.createDataFrame(rows, "row long, chunk int, matrix string"), 300)
    assert {(r.row, r.chunk, r.over_in, r.piece_in, r.over_out, r.piece_out) for r in passed.collect()} == expected


def test_product_takes_the_best():
    s, t, u = START, (1, "x"), (2, "y")
    assert product({(s, t): 1.0, (s, u): 5.0}, {(t, s): 3.0, (u, s): -2.0}) == {(s, s): 4.0}


def test_merges_equal_the_library():
    rnd, pieces = random.Random(9), pieces_of(MODEL)
    for _ in range(300):
        word = "".join(rnd.choice("etaoinshrdluäé漢") for _ in range(rnd.randrange(1, 24)))
        ids = [n for p in pieces.merged(SPACE + word) for n in pieces.number(p)]
        assert ids == LIB.encode(word)


def test_documents(spark):
    rnd = random.Random(4)
    rows = [(k, text_of(rnd, rnd.choice([1, 20, 400])), 3, "s") for k in range(60)]
    rows += [(90, None, 3, "s"), (91, "", 3, "s"), (None, "x" * 5000, 3, "s"), (92, " " * 3000, 3, "s"), (92, " " * 3000, 3, "s"), (93, text_of(rnd, 30000), 3, "s")]
    rows += [(94, "a" * 255, 3, "s"), (95, "a" * 256, 3, "s"), (96, "b" * 257, 3, "s")]
    encoded = encode(spark.createDataFrame(rows, SCHEMA), chunk_chars=256)
    assert encoded.columns == ["row", "doc_id", "chunk", "n_chunks", "source", "ids"]
    parts = {}
    for r in decode(encoded).collect():
        assert r.decoded == r.source.replace(SPACE, " ")
        parts.setdefault((r.row, r.doc_id) if r.row is not None else (object(), r.doc_id), []).append(r)
    got = []
    for (_, key), own in parts.items():
        own.sort(key=lambda r: r.chunk)
        assert [r.chunk for r in own] == list(range(own[0].n_chunks))
        got.append((key, "".join(r.source for r in own), [n for r in own for n in r.ids]))
    expected = [(k, (t or "").replace(SPACE, " ") if len(t or "") > 256 else t or "", LIB.encode(t or "")) for k, t, *_ in rows]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert sum(len(own) > 1 for own in parts.values()) > 10
    assert encode(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op6_sentencepiece"](spark, sf).collect()
    assert {(r.doc_id, r.n_tokens, r.round_trip) for r in rows} == {(k, len(LIB.encode(t)), True) for k, t in texts.items()}
    assert np.unique([r.doc_id for r in rows]).size == len(rows)


def test_signatures_add_up():
    text = "ab 漢🙂" * 9 + SPACE
    assert signature(text[:13], 0) ^ signature(text[13:], 13) == signature(text, 0)
    assert len({signature(t, 0) for t in (text, text[1:], text[::-1], text.replace(SPACE, " "))}) == 4


@pytest.mark.parametrize("spread", [256, 65_536])
def test_round_trip_is_of_the_whole_text(spark, spread):
    plain = "words of a long text, " * 60
    rows = [(1, plain, 0, "s"), (2, plain.replace("long", "long" + SPACE), 0, "s"), (3, plain, 0, "s"), (3, plain, 0, "s")]
    short, long = encode_parts(spark.createDataFrame(rows, SCHEMA), chunk_chars=256, spread_chars=spread)
    assert short.collect() == []
    out = decode(long).cache()
    assert sorted((r.doc_id, r.n_tokens, r.n_chunks, r.round_trip) for r in joined(out).collect()) == sorted(
        (k, len(LIB.encode(t)), -(-(len(t) + 1) // 256), SPACE not in t) for k, t, *_ in rows
    )
    one = out.where("doc_id = 1")
    lost = one.where("chunk <> 2")
    for broken in (lost, one.unionByName(one.where("chunk = 2")), lost.unionByName(one.where("chunk = 1"))):
        assert [r.round_trip for r in joined(broken).collect()] == [False]


def test_long_documents_of_the_query_are_split(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r.n_chunks for r in QUERIES["op6_sentencepiece"](spark, sf).collect()}
    assert got == {k: -(-(len(t) + 1) // 4096) if len(t) > 4096 else 1 for k, t in texts.items()}
    assert max(got.values()) > 2
