"""Divergence between the sources of a language, from in-mapper stripes (operator 11).

1. *Fold*: a task folds whole documents into a hash table from term to stripe: in how
   many documents the term stands, and how often each source uses it. A table that
   holds ``ENTRIES`` counts is handed on and started anew, so memory follows neither the
   partition nor the vocabulary.
2. *Merge*: stripes travel by (language, term). A term has at most one stripe for each
   table that was handed on, and its entries are added up by source on arrival.
3. *Emit*: merged stripes of kept terms give, without another shuffle of terms, the
   divergence of every group from its language (the best terms of every batch) and
   from every other source of its language (one sum for each pair, added up by Spark).

Probabilities are scaled integers, so all sums are exact and need no order.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import lean, saved

# Letters A-Z in lower case, other ASCII signs as spaces, all bytes of other signs as they are.
FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
SLICE = 1_000_000  # bytes of a text that are split into terms at once
ENTRIES = 300_000  # counts that a task holds in its stripes
CELLS = 2_000_000  # numbers in a matrix of terms by sources, and in the sums of a task
GROUPS = 50_000  # groups whose totals a task holds; languages are dealt into passes beyond

STRIPES = "lang string, term binary, stripe array<struct<source:string,n:long>>"
FOUND = "lang string, source string, part string, item binary, value long"


def terms(text: bytes) -> Counter[bytes]:
    """How often each term stands in a text in UTF-8."""
    body, found, at = text.translate(FOLDED), Counter(), 0
    while at < len(body):
        end = body.find(b" ", at + SLICE)
        end = len(body) if end < 0 else end
        found.update(body[at:end].split())
        at = end
    return found


class Stripes:
    """Stripes of the documents folded so far: language -> term -> source -> count; under None the number of documents."""

    def __init__(self) -> None:
        self.held: dict[str, dict[bytes, dict[str | None, int]]] = {}
        self.size = 0

    def fold(self, lang: str, source: str, found: Counter[bytes]) -> None:
        own = self.held.setdefault(lang, {})
        for term, n in found.items():
            stripe = own.get(term)
            if stripe is None:
                own[term] = {None: 1, source: n}
                self.size += 2
                continue
            stripe[None] += 1
            if source in stripe:
                stripe[source] += n
            else:
                stripe[source] = n
                self.size += 1

    def handed_on(self) -> Iterator[pa.RecordBatch]:
        for lang, own in self.held.items():
            stripes = list(own.values())
            ends = np.cumsum([0, *map(len, stripes)]).astype(np.int32)
            sources = pa.array([s for stripe in stripes for s in stripe], pa.string())
            counts = pa.array([n for stripe in stripes for n in stripe.values()], pa.int64())
            entries = pa.StructArray.from_arrays([sources, counts], ["source", "n"])
            columns = [pa.array([lang] * len(own), pa.string()), pa.array(list(own), pa.binary()), pa.ListArray.from_arrays(ends, entries)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "term", "stripe"])
        self.__init__()


def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stripes = Stripes()
    for batch in batches:
        for text, lang, source in zip(*(batch.column(c) for c in ("text", "lang", "source"))):
            stripes.fold(lang.as_py(), source.as_py(), terms(text.as_py()))
            if stripes.size > ENTRIES:
                yield from stripes.handed_on()
    yield from stripes.handed_on()


def merged(docs: DataFrame, least: int) -> DataFrame:
    """One stripe for each language and term that stands in ``least`` documents or more: lang, term, stripe."""
    dealt = docs.mapInArrow(lean(folded), STRIPES).repartition("lang", "term")
    entries = dealt.select("lang", "term", F.inline("stripe")).groupBy("lang", "term", "source").agg(F.sum("n").alias("n"))
    stripe = F.collect_list(F.when(F.col("source").isNotNull(), F.struct("source", "n")))  # one entry for each source
    documents = F.max(F.when(F.col("source").isNull(), F.col("n")))
    whole = entries.groupBy("lang", "term").agg(stripe.alias("stripe"), documents.alias("documents"))
    return whole.where(F.col("documents") >= least).select("lang", "term", "stripe")


def shares(counts: np.ndarray, total: np.ndarray, terms: int, scale: int) -> np.ndarray:
    """1 + floor(scale * (count + 1) / (total + terms)), exact while total + terms < 9 * 10^15; ``scale`` is a power of 1,000."""
    whole, rest, by = np.zeros_like(counts), counts + 1, total + terms
    while scale > 1:
        rest *= 1000
        whole = 1000 * whole + rest // by
        rest %= by
        scale //= 1000
    return whole + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class Emitter:
    """What stripes tell about the groups of their languages; ``totals`` is language -> (sources, their totals, number of terms)."""

    def __init__(self, totals: dict[str, tuple[list[str], np.ndarray, int]], scale: int, top: int) -> None:
        self.totals = {lang: (pa.array(sources, pa.string()), total, v) for lang, (sources, total, v) in totals.items()}
        self.scale, self.top = scale, top
        self.sums: dict[tuple[str, int], np.ndarray] = {}
        self.held = 0

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in pc.unique(batch.column("lang")).to_pylist():
                own = batch.filter(pc.equal(batch.column("lang"), lang))
                step = max(1, CELLS // len(self.totals[lang][0]))
                for at in range(0, own.num_rows, step):
                    yield from self.emit(lang, own.slice(at, step))
        yield from self.handed_on()

    def emit(self, lang: str, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sources, total, v = self.totals[lang]
        stripe = rows.column("stripe")
        row = pc.list_parent_indices(stripe).to_numpy()
        entries = stripe.flatten()
        counts = np.zeros((rows.num_rows, len(sources)), np.int64)
        counts[row, pc.index_in(entries.field("source"), sources).to_numpy()] = entries.field("n").to_numpy()
        p = shares(counts, total, v, self.scale)
        q = shares(counts.sum(axis=1), total.sum(), v, self.scale)
        yield self.best(lang, rows.column("term"), counts, p, q)
        for s in range(len(sources)):
            value = divergence(p[:, s : s + 1], p).sum(axis=0)
            known = self.sums.get((lang, s))
            self.held += 0 if known is not None else len(value)
            self.sums[lang, s] = value if known is None else known + value
            if self.held > CELLS:
                yield from self.handed_on()

    def best(self, lang: str, term: pa.Array, counts: np.ndarray, p: np.ndarray, q: np.ndarray) -> pa.RecordBatch:
        """Of each source the ``top`` terms of these rows that it uses more than its language does."""
        row, source = np.nonzero((counts > 0) & (p > q[:, None]))
        value = divergence(p[row, source], q[row])
        order = pc.sort_indices(pa.table({"source": source, "value": value, "term": term.take(pa.array(row))}),
                                [("source", "ascending"), ("value", "descending"), ("term", "ascending")]).to_numpy()
        row, source, value = row[order], source[order], value[order]
        place = np.arange(len(source)) - np.searchsorted(source, source)
        row, source, value = (x[place < self.top] for x in (row, source, value))
        return self.batch(lang, pa.array(source), "term", term.take(pa.array(row)), pa.array(value, pa.int64()))

    def handed_on(self) -> Iterator[pa.RecordBatch]:
        for (lang, s), value in self.sums.items():
            sources = self.totals[lang][0]
            others = np.flatnonzero(np.arange(len(sources)) != s)
            item = sources.take(pa.array(others)).cast(pa.binary())
            yield self.batch(lang, pa.array(np.full(len(others), s)), "pair", item, pa.array(value[others], pa.int64()))
        self.sums.clear()
        self.held = 0

    def batch(self, lang: str, source: pa.Array, part: str, item: pa.Array, value: pa.Array) -> pa.RecordBatch:
        names = [pa.array([x] * len(source), pa.string()) for x in (lang, part)]
        return pa.RecordBatch.from_arrays([names[0], self.totals[lang][0].take(source), names[1], item, value], ["lang", "source", "part", "item", "value"])


def divergences(
    df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = 3, top: int = 200, scale: int = 1_000_000_000
) -> DataFrame:
    """lang, source, part, item, value, rank: how far each source of a language is from the others and from the language.

    Terms are runs of letters A-Z, taken in lower case, and of signs beyond ASCII; a language
    keeps those in at least ``least`` of its rows. A group (language, source) gives a kept
    term the probability p = 1 + floor(scale * (count + 1) / (N + V)), and the divergence
    of p from q is floor((p - q)^2 / q). Part ``pair`` has the sum over all kept terms for
    every other source of the language, 0 if no term is kept. Part ``term`` has the ``top`` terms that
    the group uses and more often than its language does. Ranks count
    from 1 by descending value, then by item in byte order.

    Null text, language and source count as empty; groups without terms take part. Rows
    that repeat count each for itself. Other columns are not looked at. An empty input
    gives an empty result.
    """
    docs = df.select(*[F.coalesce(df[c], F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))])
    stripes = saved(merged(docs.withColumn("text", F.col("text").cast("binary")), least), "divergence-stripes")
    used = stripes.select("lang", F.inline("stripe")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    kept = stripes.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    groups = docs.select("lang", "source").distinct().join(used, ["lang", "source"], "left").join(kept, "lang", "left")
    totals = saved(groups.fillna(0, ["n", "v"]), "divergence-totals")
    passes = -(-totals.count() // GROUPS)
    spark, found = df.sparkSession, []
    for k in range(passes):
        own = F.pmod(F.xxhash64("lang"), F.lit(passes)) == k
        by: dict[str, list] = {}
        for r in totals.where(own).where("v > 0").collect():  # about GROUPS rows
            by.setdefault(r.lang, []).append(r)
        shared = spark.sparkContext.broadcast({x: ([r.source for r in rs], np.array([r.n for r in rs], np.int64), rs[0].v) for x, rs in by.items()})

        def emit(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            yield from Emitter(shared.value, scale, top).run(batches)

        found.append(saved(stripes.where(own).mapInArrow(lean(emit), FOUND), "divergence-found"))
    others = totals.select("lang", F.col("source").cast("binary").alias("item"))
    blank = totals.where("v = 0").select("lang", "source").join(others, "lang").where(F.col("source").cast("binary") != F.col("item"))
    sums = blank.select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
    single = None
    for part in found:
        pairs = part.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
        sums = sums.unionByName(pairs)
        best = part.where("part = 'term'")
        single = best if single is None else single.unionByName(best)
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    out = sums.select("*", place)
    if single is not None:
        out = out.unionByName(single.select("*", place).where(F.col("rank") <= top))
    return out.withColumn("item", F.col("item").cast("string"))
