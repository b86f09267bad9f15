import random

import pytest
from tokenizers import Tokenizer

from tests.llm.test_tokens import sample
from tidemark.llm.sections import BLOCK, field_tokens, section_tokens
from tidemark.llm.tokens import TOKENIZERS, token_counts

DOCS = "doc_id long, text string, section string, row int"
SECTIONS = "doc_id long, section string, start int, end int, text string"


def spans(text):
    """First and last character of each token, by another library's tokenizer of the same vocabulary."""
    own = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    own.encode_special_tokens = True
    character = [k for k, c in enumerate(text) for _ in c.encode()]
    out, at = [], 0
    for token in own.encode(text, add_special_tokens=False).tokens:
        out.append((character[at], character[at + len(token) - 1]))
        at += len(token)
    return out


def brute(tokens, size, start, end, rule):
    start, end = max(0, min(start if start is not None else 0, size)), max(0, min(end if end is not None else size, size))
    n = crossing = 0
    for first, last in tokens:
        held = len(range(max(start, first), min(end, last + 1)))
        inside = {"first": start <= first < end, "last": start <= last < end,
                  "larger": 2 * held > last - first + 1 or (2 * held == last - first + 1 and start <= first)}[rule]
        n += inside and held > 0
        crossing += inside and 0 < held < last - first + 1
    return start, end, n, crossing


@pytest.fixture(scope="module")
def given():
    rnd = random.Random(5)
    long = "".join(rnd.choice(["word ", "é", "漢字", "        ", "internationalization ", "🙂"]) for _ in range(3 * BLOCK))
    texts = [*sample(), long, "x" * BLOCK, " " * (2 * BLOCK)]
    docs = [(k, t, "s", 1) for k, t in enumerate(texts)] + [(None, "two words", "s", 1), (3, "the key again", "s", 1)]
    sections = [(None, "of null", 0, 5, "t"), (999, "of nothing", 0, 5, "t"), (3, "same", 0, 2, "t"), (3, "same", 0, 2, "t")]
    for k, t in enumerate(texts):
        size = len(t or "")
        for n in range(6 if size < 1000 else 300):
            a = rnd.randrange(-2, size + 3)
            sections.append((k, f"s{n}", a, a + rnd.choice([0, 1, 2, 3, 7, 5000, -1]), "t"))
        sections += [(k, "all", None, None, "t"), (k, "end", size, size, "t")]
    return docs, sections


@pytest.mark.parametrize("rule", ["first", "last", "larger"])
def test_sections_against_brute_force(spark, given, rule):
    docs, sections = given
    expected = []
    for key, text, *_ in docs:
        tokens = spans(text or "")
        for owner, name, a, b, _ in sections:
            if owner == key:
                expected.append((key, name, *brute(tokens, len(text or ""), a, b, rule)))
    frames = spark.createDataFrame(docs, DOCS), spark.createDataFrame(sections, SECTIONS)
    got = section_tokens(*frames, rule=rule)
    assert got.columns == ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


def test_lines_given_as_sections_are_lines(spark):
    docs = spark.createDataFrame([(k, t, "s", 1) for k, t in enumerate(sample()) if t and t.isascii()], DOCS)
    lines = token_counts(docs, rule="last")
    assert sorted(section_tokens(docs, lines, rule="last").collect()) == sorted(lines.collect())


@pytest.mark.parametrize("rule", ["first", "larger"])
def test_fields(spark, rule):
    rows = [(1, "a title", "body  ", 7), (1, None, "same key", None), (None, "", "", 12345), (5, "é漢", "x" * 5000, 0)]
    got = field_tokens(spark.createDataFrame(rows, "doc_id long, title string, section string, n int"), ["title", "section", "n"], between=" ", rule=rule)
    expected = []
    for key, *values in rows:
        texts = ["" if v is None else str(v) for v in values]
        whole, at = " ".join(texts), 0
        tokens = spans(whole)
        for name, value in zip(("title", "section", "n"), texts):
            expected.append((key, name, *brute(tokens, len(whole), at, at + len(value), rule)))
            at += len(value) + 1
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


def test_empty_tables_and_unknown_rules(spark):
    docs, sections = spark.createDataFrame([], DOCS), spark.createDataFrame([], SECTIONS)
    assert section_tokens(docs, sections).collect() == []
    assert field_tokens(docs, ["text", "section"]).collect() == []
    with pytest.raises(ValueError):
        section_tokens(docs, sections, rule="other")
