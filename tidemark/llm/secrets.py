"""Secret scans: fixed patterns, and Markov models of random strings against identifiers (operator 4).

Two Markov models over characters, one of random strings and one of ordinary
identifiers, are trained on labelled samples. A stretch of token characters that is
likelier random by ``margin`` nats, and by ``rate`` nats a character, is a span of kind
``random``; a run of token characters can hold several, beside ordinary text. The spans
of the fixed patterns are reported whatever the models say; they are cut out of the runs.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import different_rows, lean, saved

# The patterns, with the lengths that matches must reach.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_VALUE = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
SHORTEST = 16  # characters of a random span
IDENTIFIER = re.compile(r"[A-Za-z][A-Za-z0-9_-]{3,}")
# The characters of candidates; the last state is the beginning of a string.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
JOINERS = "+/_=-"  # the end of the alphabet
STATES = len(ALPHABET) + 1
PRIOR = 4
PLACE = np.full(128, len(ALPHABET))
PLACE[[ord(c) for c in ALPHABET]] = range(len(ALPHABET))

Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, in code points, ends exclusive; leftmost and not overlapping within a kind.

    A run of 16 or 18 characters or more is found directly: such a match begins
    where the run begins, so shorter runs need not be matched and dropped. An
    assignment with a short value does use up its text, so it is matched and dropped.
    """
    spans = []
    if ":" in text or "=" in text:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_VALUE]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return spans + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def codes(string: str) -> np.ndarray:
    return PLACE[np.frombuffer(string.encode("ascii", "replace"), np.uint8) & 127]


def transitions(strings: list[str]) -> np.ndarray:
    """How often each character follows each other one, or begins a string."""
    counts = np.zeros((STATES, STATES), np.int64)
    for s in strings:
        own = codes(s)
        np.add.at(counts, (np.concatenate([[STATES - 1], own[:-1]]), own), 1)
    return counts


@dataclass
class MarkovPair:
    """Log-likelihood ratio per transition, random over ordinary; 65 x 65 numbers or so."""

    ratio: np.ndarray

    @staticmethod
    def of(random: np.ndarray, ordinary: np.ndarray) -> MarkovPair:
        """From transition counts; without samples of one kind nothing is likelier.

        A character that is rare after another is predicted from how frequent it is
        anywhere, which counts as ``PRIOR`` observations.
        """
        if not random.sum() or not ordinary.sum():
            return MarkovPair(np.zeros((STATES, STATES)))
        logs = []
        for counts in (random, ordinary):
            anywhere = (counts.sum(axis=0) + 0.5) / (counts.sum() + 0.5 * STATES)
            logs.append(np.log((counts + PRIOR * anywhere) / (counts.sum(axis=1, keepdims=True) + PRIOR)))
        return MarkovPair(logs[0] - logs[1])

    def score(self, string: str) -> float:
        own = codes(string)
        return float(self.ratio[STATES - 1, own[0]] + self.ratio[own[:-1], own[1:]].sum())

    def steps(self, string: str) -> tuple[np.ndarray, np.ndarray]:
        """What every character adds to the score of a stretch: inside it, and as its first one.

        Joiners add nothing, since paths and assignments have them as well as keys, and
        what follows one begins a string. A stretch that begins within a string gets
        nothing for its first character.
        """
        own = codes(string)
        joins = (own >= len(ALPHABET) - len(JOINERS)) & (own < len(ALPHABET))
        begins = np.concatenate([[True], joins[:-1]])
        inside = np.where(joins, 0.0, self.ratio[np.where(begins, STATES - 1, np.roll(own, 1)), own])
        return inside, np.where(begins, inside, 0.0)


def train(samples: DataFrame, text: str = "text", label: str = "label") -> MarkovPair:
    """From strings labelled 1 (random) or 0 (ordinary): counted in every task, summed by Spark. Nulls are passed over."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, STATES, STATES), np.int64)
        for batch in batches:
            rows = list(zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()))
            for kind in (0, 1):
                total[kind] += transitions([t for x, t in rows if x == kind and t])
        kind, before, after = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (kind, before, after, total[kind, before, after])], ["k", "a", "b", "n"])

    rows = samples.select(samples[label].cast("int").alias("label"), samples[text].alias("text"))
    found = rows.mapInArrow(lean(count), "k long, a long, b long, n long").groupBy("k", "a", "b").agg(F.sum("n").alias("n")).collect()
    total = np.zeros((2, STATES, STATES), np.int64)
    for r in found:  # at most 2 x 68 x 68 rows
        total[r.k, r.a, r.b] = r.n
    return MarkovPair.of(total[1], total[0])


def labelled_strings(docs: DataFrame, text: str = "text") -> DataFrame:
    """text, label: values that the fixed patterns mark as secrets (1), and the identifiers around them (0)."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column("text"):
                body = t.as_py() or ""
                spans = base_spans(body)
                secret = [m.group(2).strip(".") for m in ASSIGN.finditer(body) if len(m.group(2)) >= ASSIGN_VALUE]
                secret += [body[a:b] for a, kind, b in spans if kind]
                hidden = list(body)
                for a, _, b in spans:
                    hidden[a:b] = " " * (b - a)
                ordinary = IDENTIFIER.findall("".join(hidden))
                labels = pa.array([1] * len(secret) + [0] * len(ordinary), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(secret + ordinary, pa.string()), labels], ["text", "label"])

    return docs.select(docs[text].alias("text")).mapInArrow(lean(label), "text string, label int")


def learn(docs: DataFrame, text: str = "text", key: str = "doc_id", rows: int = 10_000) -> MarkovPair:
    """Train on the strings of at most ``rows`` documents, those whose key and text hash lowest; their labels come from the fixed patterns."""
    picked = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    return train(labelled_strings(saved(different_rows(picked, rows), "secret-sample")))


def stretches(string: str, models: MarkovPair, margin: float, rate: float) -> list[tuple[int, int]]:
    """The stretches likelier random, not overlapping: the best one first, then those beside it.

    The best one has the highest score, or, if that one is too long for ``rate``, the
    highest score above ``rate``. It is widened to the strings between joiners in which it
    begins and ends, if these have the rate, and to the padding at the end.
    """
    inside, first = models.steps(string)
    upto = np.cumsum(inside)
    lead = first - upto  # a stretch from a to b scores lead[a] + upto[b - 1]
    place = np.arange(len(string))
    joins = np.array([c in JOINERS for c in string])
    since = np.concatenate([[0], np.maximum.accumulate(np.where(joins, place + 1, 0))]).tolist()  # after the last joiner before a place
    until = [*np.minimum.accumulate(np.where(joins, place, len(string))[::-1])[::-1].tolist(), len(string)]  # the next joiner

    def random(a: int, b: int) -> bool:
        score = lead[a] + upto[b - 1]
        return bool(score >= margin and score >= rate * (b - a))

    def best(lo: int, hi: int, cost: float) -> tuple[int, int]:
        """The stretch with the highest score if every character costs something; of equals the shortest."""
        heads = lead[lo : hi - SHORTEST + 1] + cost * place[lo : hi - SHORTEST + 1]
        tails = upto[lo + SHORTEST - 1 : hi] - cost * place[lo + SHORTEST - 1 : hi]
        end = int((np.maximum.accumulate(heads) + tails).argmax())
        return lo + end - int(heads[end::-1].argmax()), lo + end + SHORTEST

    def widened(a: int, b: int, lo: int, hi: int) -> tuple[int, int]:
        left, right = max(lo, since[a]), min(hi, until[b])
        stop = until[a] if until[a] < b else None  # where the first string ends
        start = since[b] if since[b] > a else None  # where the last one begins
        for x, y in ((left, right), (left, b), (a, right)):
            ends = [(x, y if stop is None else stop)] * (x < a) + [(x if start is None else start, y)] * (y > b)
            if random(x, y) and all(lead[v] + upto[w - 1] >= rate * (w - v) for v, w in ends if v < w):
                return x, y
        return a, b

    def short(lo: int, hi: int) -> tuple[int, int] | None:
        """The best one by what it scores above ``rate``; of a long one with the rate, one half has it too."""
        found = (-1.0, None)
        for width in range(SHORTEST, min(hi - lo, 2 * math.ceil(margin / rate)) + 1):
            score = lead[lo : hi - width + 1] + upto[lo + width - 1 : hi]
            score = np.where(score >= margin, score - rate * width, -1.0)
            k = int(score.argmax())
            if score[k] >= 0 and score[k] > found[0]:
                found = (float(score[k]), (lo + k, lo + k + width))
        return found[1]

    out, parts = [], [(0, len(string))]
    while parts:
        lo, hi = parts.pop()
        if hi - lo < SHORTEST:
            continue
        a, b = best(lo, hi, 0.0)
        if lead[a] + upto[b - 1] < margin:
            continue
        if not random(a, b):
            a, b = best(lo, hi, rate)
            if not random(a, b):
                found = short(lo, hi) if rate > 0 else None
                if found is None:
                    continue
                a, b = found
        a, b = widened(a, b, lo, hi)
        if not string[b:].strip("="):
            b = len(string)
        out.append((a, b))
        parts += [(lo, a), (b, hi)]
    return out


def outside(start: int, end: int, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What sorted spans leave of a stretch."""
    for a, b in taken[bisect_right(taken, start, key=lambda x: x[1]) :]:
        if a >= end:
            break
        if a > start:
            yield start, a
        start = max(start, b)
    if start < end:
        yield start, end


def all_spans(text: str, models: MarkovPair, margin: float, rate: float) -> list[Span]:
    """Base spans and random ones, by start, then kind."""
    spans = base_spans(text)
    taken: list[tuple[int, int]] = []
    for a, _, b in sorted(spans):
        if taken and a < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(b, taken[-1][1]))
        else:
            taken.append((a, b))
    for m in CANDIDATE.finditer(text):
        for lo, hi in outside(m.start(), m.end(), taken):
            if hi - lo >= SHORTEST:
                spans += [(lo + a, 3, lo + b) for a, b in stretches(text[lo:hi], models, margin, rate)]
    return sorted(spans)


def scan(df: DataFrame, models: MarkovPair, text: str = "text", margin: float = 12.0, rate: float = 0.5) -> DataFrame:
    """``df`` without its text, with an array of the text's spans (kind, start, end), sorted by start, then kind.

    Null texts are like empty ones: no spans. Spans count code points, ends exclusive.
    An input column called ``spans`` is replaced.
    """
    rest = [c for c in df.columns if c not in (text, "spans")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(rest).schema), "spans array<struct<kind:string,start:int,end:int>>"])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [all_spans(t.as_py() or "", models, margin, rate) for t in batch.column(text)]
            spans = pa.array([[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in own] for own in found], kind)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + [spans], [*rest, "spans"])

    return df.mapInArrow(lean(find), schema)
