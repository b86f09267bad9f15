"""Token counts per section from one encoding of the whole document (operator 5).

Encoding sections one by one gives other tokens at their borders than the document
has. So every document is encoded once, as a whole, and the lengths of its tokens
give their spans. Sections are spans as well. The two lists of spans are joined by
interval: a token belongs to the section that its first byte, its last byte, or
the larger part of it lies in, by an explicit rule.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import lean

TOKENIZERS = "/opt/tokenizers"
RANKS = "byte_bpe_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

RULES = ("first", "last", "larger")
COUNTS = "section int, start long, end long, n_tokens long, n_crossing long"


@lru_cache(maxsize=2)
def encoder(folder: str):
    """The tokenizer and the length in bytes of each of its tokens."""
    import tiktoken

    with open(os.path.join(folder, RANKS), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths


def sections(text: str) -> list[int]:
    """Where the lines of a text begin, in code points; a line keeps its line break. An empty text is one empty section."""
    starts = [0]
    at = text.find("\n")
    while 0 <= at < len(text) - 1:
        starts.append(at + 1)
        at = text.find("\n", at + 1)
    return starts


def byte_places(text: str, places: list[int]) -> np.ndarray:
    """The places, given in code points, in bytes of UTF-8."""
    if text.isascii():
        return np.array(places, np.int64)
    out, at, size = [], 0, 0
    for place in places:
        size += len(text[at:place].encode("utf-8", "replace"))
        out.append(size)
        at = place
    return np.array(out, np.int64)


def attribute(lengths: np.ndarray, starts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens, and tokens that reach beyond their section, per section; ``starts`` in bytes.

    ``larger`` gives a token to the section with most of its bytes, of equals to the first.
    """
    end = np.cumsum(lengths)
    begin = end - lengths
    first = np.searchsorted(starts, begin, side="right") - 1
    last = np.searchsorted(starts, end - 1, side="right") - 1
    own = last.copy() if rule == "last" else first.copy()
    crossing = first != last
    if rule == "larger":
        borders = np.append(starts, end[-1] if len(end) else 0)
        for k in np.flatnonzero(crossing):
            places = np.arange(first[k], last[k] + 1)
            shares = np.minimum(borders[places + 1], end[k]) - np.maximum(borders[places], begin[k])
            own[k] = places[shares.argmax()]
    count = lambda which: np.bincount(own[which], minlength=len(starts))
    return count(slice(None)), count(crossing)


def token_counts(df: DataFrame, text: str = "text", key: str = "doc_id", rule: str = "first", folder: str = TOKENIZERS) -> DataFrame:
    """One row per row of ``df`` and section (line): key, section, start, end, n_tokens, n_crossing.

    Sections are numbered from 0; ``start`` and ``end`` (exclusive) are code points.
    Every token counts in one section, so the sections of a document add up to its
    tokens; ``n_crossing`` of them reach into another section. Null and empty texts are one empty
    section without tokens. Rows with the same key, also null, are counted for
    themselves. Other columns are not looked at. ``folder`` holds the vocabulary on every machine.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    rows = df.select(df[key].alias("key"), df[text].alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, lengths = encoder(folder)
        for batch in batches:
            owner, parts = [], []
            for k, t in enumerate(batch.column("text")):
                body = t.as_py() or ""
                starts = sections(body)
                tokens = lengths[tokenizer.encode_to_numpy(body)] if body else np.empty(0, np.int64)
                n, crossing = attribute(tokens, byte_places(body, starts), rule)
                owner.append(np.full(len(starts), k))
                parts.append(np.array([np.arange(len(starts)), starts, [*starts[1:], len(body)], n, crossing], np.int64))
            if not parts:
                continue
            table = np.concatenate(parts, axis=1)
            keys = batch.column("key").take(pa.array(np.concatenate(owner)))
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(table[0], pa.int32()), *(pa.array(x, pa.int64()) for x in table[1:])], ["key", "section", "start", "end", "n_tokens", "n_crossing"]
            )

    return rows.mapInArrow(lean(count), f"key {kind}, {COUNTS}").withColumnRenamed("key", key)
