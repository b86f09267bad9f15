"""Token counts of the caller's own sections and fields (operator 5).

Every document is encoded once, as a whole. A token's span is the characters (code points)
of which it holds a byte. Sections are spans that the caller gives; they may overlap
and leave gaps. Fields are columns that are encoded as one text.

Spans meet at borders, and at a border at most one token reaches across. So a section needs two
looks: how many tokens begin before its start and before its end, and which token crosses there.
Tokens are kept in blocks of ``BLOCK`` characters, and the different borders within a block, no more than
it has characters, look together. A long document and one with very many sections are so dealt to many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lean, saved
from tidemark.llm.tokens import RULES, TOKENIZERS, encoder

BLOCK = 4096


def character_spans(text: str, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last character of each token, given the tokens' lengths in bytes."""
    end = np.cumsum(lengths)
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    return character[end - lengths], character[end - 1]


def token_blocks(rows: DataFrame, folder: str) -> DataFrame:
    """row, key, ends, block, size, base, first, last: the tokens that begin in a block of each text, and the one before them.

    ``base`` tokens come before those listed. Every place from 0 to the text's end lies in a block that is there.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, sizes = encoder(folder)
        for batch in batches:
            for k, value in enumerate(batch.column("text")):
                text = value.as_py() or ""
                first, last = character_spans(text, sizes[tokenizer.encode_to_numpy(text)]) if text else (np.empty(0, np.int64),) * 2
                blocks = np.arange(len(text) // BLOCK + 1)
                upto = np.searchsorted(first, (blocks + 1) * BLOCK)
                base = np.maximum(np.searchsorted(first, blocks * BLOCK) - 1, 0)
                own = batch.slice(k, 1).select(["row", "key", "ends"]).to_pydict()
                part = lambda of: pa.array([of[a:b] for a, b in zip(base, upto)], pa.list_(pa.int64()))  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(own[c] * len(blocks), batch.schema.field(c).type) for c in ("row", "key", "ends")),
                     pa.array(blocks, pa.int64()), pa.array(np.full(len(blocks), len(text)), pa.int64()), pa.array(base, pa.int64()),
                     part(first), part(last)], ["row", "key", "ends", "block", "size", "base", "first", "last"])

    kind = rows.schema["key"].dataType.simpleString()
    schema = f"row long, key {kind}, ends array<long>, block long, size long, base long, first array<long>, last array<long>"
    return rows.select("row", "key", "ends", "text").mapInArrow(lean(cut), schema)


def look(blocks: DataFrame, borders: DataFrame) -> DataFrame:
    """row, place, before (tokens that begin before the place), from, to (the token that crosses it, or null)."""
    asked = borders.distinct().withColumn("block", F.floor(F.col("place") / BLOCK))
    asked = asked.groupBy("row", "block").agg(F.sort_array(F.collect_set("place")).alias("places"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, base, first, last, places in zip(*(batch.column(c) for c in ("row", "base", "first", "last", "places"))):
                of, upto, at = (np.asarray(x.values, np.int64) for x in (first, last, places))
                n = np.searchsorted(of, at)
                if len(of):
                    crosses = (n > 0) & (upto[n - 1] >= at)
                    x, y = of[n - 1], upto[n - 1]
                else:
                    crosses, x, y = np.zeros(len(at), bool), at, at
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), row.as_py()), pa.int64()), pa.array(at), pa.array(n + base.as_py(), pa.int64()),
                     pa.array(x, pa.int64(), mask=~crosses), pa.array(y, pa.int64(), mask=~crosses)], ["row", "place", "before", "from", "to"])

    met = blocks.select("row", "block", "base", "first", "last").join(asked, ["row", "block"]).drop("block")
    return met.mapInArrow(lean(find), "row long, place long, before long, from long, to long")


def crossing_counts(rule: str) -> tuple[Column, Column]:
    """n_tokens and n_crossing of a section from what its borders (s: start, e: end) say."""
    at = {f"{side}_{x}": F.col(f"{side}.{x}") for side in "se" for x in ("before", "from", "to")}
    start, end = F.col("start"), F.col("end")
    over = F.coalesce(at["e_from"] >= start, F.lit(False))  # begins inside, goes on beyond the end
    into = at["s_from"].isNotNull()  # begins before the start
    ends_inside = into & (at["s_to"] < end)
    if rule == "first":
        taken_over, taken_into = over, F.lit(False)
    elif rule == "last":
        taken_over, taken_into = F.lit(False), ends_inside
    else:
        size = lambda side: at[f"{side}_to"] - at[f"{side}_from"] + 1
        taken_over = over & (2 * (end - at["e_from"]) >= size("e"))
        taken_into = into & (2 * (F.least(end, at["s_to"] + 1) - start) > size("s"))
    inside = at["e_before"] - at["s_before"] - over.cast("long")
    crossing = taken_over.cast("long") + taken_into.cast("long")
    some = end > start
    return F.when(some, inside + crossing).otherwise(0), F.when(some, crossing).otherwise(0)


def counted(blocks: DataFrame, spans: DataFrame, key: str, rule: str) -> DataFrame:
    """The counts of ``spans``: row, key, section, start, end."""
    spans = saved(spans, "sections")
    borders = spans.select("row", F.explode(F.array("start", "end")).alias("place"))
    seen = saved(look(blocks, borders), "borders")
    side = lambda name, at: seen.select(F.col("row"), F.col("place").alias(at), F.struct("before", "from", "to").alias(name))
    both = spans.join(side("s", "start"), ["row", "start"]).join(side("e", "end"), ["row", "end"])
    n_tokens, n_crossing = crossing_counts(rule)
    return both.select(F.col("key").alias(key), "section", "start", "end", n_tokens.alias("n_tokens"), n_crossing.alias("n_crossing"))


def checked(rule: str) -> str:
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    return rule


def section_tokens(df: DataFrame, sections: DataFrame, text: str = "text", key: str = "doc_id", section: str = "section",
                   start: str = "start", end: str = "end", rule: str = "first", folder: str = TOKENIZERS) -> DataFrame:
    """One row per row of ``df`` and section of its key: key, section, start, end, n_tokens, n_crossing.

    ``sections`` has the key, a name and a span in code points (``end`` exclusive) of each
    section. Every section counts for itself, so one token may count in several that overlap and in none of a gap. By
    the rule a token is the section's that holds its ``first`` or ``last`` character, or the ``larger`` part of
    it: more than half of its characters, or half with the first. ``n_crossing`` of a section's tokens reach beyond it.

    Spans are cut to the text; a null start is 0 and a null end the text's end; empty and turned spans have no tokens.
    Null texts are empty. Null keys meet null keys. Rows that repeat a key or a section count each for themselves.
    Sections of keys that ``df`` does not have are left out. Other columns are not looked at.
    """
    checked(rule)
    none = F.lit(None).cast("array<long>").alias("ends")
    rows = df.select(F.monotonically_increasing_id().alias("row"), df[key].alias("key"), df[text].alias("text"), none)
    blocks = saved(token_blocks(rows, folder), "token-blocks")
    given = sections.select(sections[key].alias("_key"), sections[section].alias("section"), sections[start].alias("from"), sections[end].alias("to"))
    owners = blocks.where("block = 0").select("row", "key", "size")
    within = lambda x, otherwise: F.greatest(F.lit(0), F.least(F.coalesce(F.col(x).cast("long"), otherwise), F.col("size")))
    spans = given.join(owners, F.col("_key").eqNullSafe(F.col("key"))).select(
        "row", "key", "section", within("from", F.lit(0)).alias("start"), within("to", F.col("size")).alias("end")
    )
    return counted(blocks, spans, key, rule)


def field_tokens(df: DataFrame, fields: Sequence[str], key: str = "doc_id", between: str = "\n", rule: str = "first", folder: str = TOKENIZERS) -> DataFrame:
    """One row per row of ``df`` and field: key, section (the field's name), start, end, n_tokens, n_crossing.

    The fields of a row are one text, in the order given with ``between`` between them, and are encoded together.
    ``start`` and ``end`` are their places in it. Null fields are empty and keep their place. What is between
    fields belongs to none. Rules, keys and other columns are as in :func:`section_tokens`.
    """
    checked(rule)
    values = [F.coalesce(df[f].cast("string"), F.lit("")) for f in fields]
    ends, place = [], F.lit(0).cast("long")
    for value in values:
        place = place + F.length(value)
        ends.append(place)
        place = place + len(between)
    rows = df.select(F.monotonically_increasing_id().alias("row"), df[key].alias("key"), F.concat_ws(between, *values).alias("text"), F.array(*ends).alias("ends"))
    blocks = saved(token_blocks(rows, folder), "token-blocks")
    each = blocks.where("block = 0").select("row", "key", "ends", F.posexplode("ends").alias("at", "end"))
    begin = F.when(F.col("at") == 0, F.lit(0).cast("long")).otherwise(F.get("ends", F.col("at") - 1) + len(between))
    names = F.array(*[F.lit(f) for f in fields])
    spans = each.select("row", "key", F.get(names, F.col("at")).alias("section"), begin.alias("start"), "end")
    return counted(blocks, spans, key, rule)
