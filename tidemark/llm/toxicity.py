"""Toxicity scores by gradient-boosted trees over dense features, calibrated isotonically (operator 1).

The lexicon is learned: words, and beginnings of words, that labelled toxic texts
have and others hardly ever. Per text the features are lexicon densities, hits near
a second-person word, rates of capitals, punctuation and obfuscation, and length.
Features are made once for all texts and written; trees and calibration are
fitted on the features of the labelled sample and applied to all rows by Spark ML.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_sample, lean, remainder, saved

# Second-person words of English, German, French and Spanish, and letters that signs stand for.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer eure tu te toi ton ta tes vous votre vos tú ti tuyo usted ustedes vosotros os".split()
)
DISGUISES = str.maketrans("013457@$!", "oieastasi")

WORD = re.compile(r"[^\W_]+")
DISGUISED = re.compile(r"[^\W\d_]+(?:[0-9@$!*]+[^\W\d_]+)+")
FEATURES = [
    "lexicon_density", "lexicon_kinds", "lexicon_hits", "near_second_person", "second_person", "capitals", "punctuation", "exclamations",
    "obfuscated", "obfuscated_hits", "length",
]
NEAR = 5
BEGINNINGS = range(3, 7)


class Hits(dict):
    """Remembers whether a word has an entry in the lexicon: itself (as ``word$``) or a beginning of it."""

    def __init__(self, lexicon: frozenset[str], most: int = 200_000) -> None:
        super().__init__()
        self.lexicon, self.most = lexicon, most

    def __missing__(self, word: str) -> bool:
        if len(self) >= self.most:
            self.clear()
        found = self[word] = f"{word}$" in self.lexicon or any(word[:n] in self.lexicon for n in BEGINNINGS)
        return found


def features(text: str | None, hits: Hits) -> list[float]:
    """The dense features of one whole text. Null is like empty: all zero."""
    text = text or ""
    lowered = text.lower()
    words = WORD.findall(lowered)
    at = [k for k, w in enumerate(words) if hits[w]]
    disguised = [m.group().translate(DISGUISES).replace("*", "") for m in DISGUISED.finditer(lowered)] if words else []
    near = sum(any(w in SECOND_PERSON for w in words[max(0, k - NEAR) : k + NEAR + 1]) for k in at)
    n, chars = max(1, len(words)), max(1, len(text))
    ascii_text = text.encode("ascii", "ignore")
    capitals = len(ascii_text) - len(ascii_text.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    signs = len(ascii_text) - len(ascii_text.translate(None, b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))
    return [
        len(at) / n, float(len({words[k] for k in at})), math.log1p(len(at)), near / n,
        sum(map(SECOND_PERSON.__contains__, words)) / n, capitals / chars, signs / chars, text.count("!") / chars,
        len(disguised) / n, sum(hits[w] for w in disguised) / n, math.log1p(len(words)),
    ]


def learn_lexicon(sample: DataFrame, text: str, label: str, min_docs: int = 5, purity: float = 0.9, most: int = 2_000) -> frozenset[str]:
    """Words (with $) and beginnings of words of which at least ``purity`` of the texts, ``min_docs`` at least, are toxic.

    At most ``most`` entries, those of most texts first.
    """
    words = F.array_distinct(F.regexp_extract_all(F.lower(sample[text]), F.lit(r"\p{L}+"), 0))
    whole = F.transform("words", lambda w: F.concat(w, F.lit("$")))

    def beginnings(n: int) -> Column:
        return F.transform(F.filter("words", lambda w: F.length(w) >= n), lambda w: F.substring(w, 1, n))

    starts = [beginnings(n) for n in BEGINNINGS]
    pieces = sample.select(words.alias("words"), F.col(label).alias("label")).select("label", F.explode(F.array_distinct(F.concat(whole, *starts))).alias("piece"))
    counts = pieces.groupBy("piece").agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n"))
    pure = counts.where((F.col("toxic") >= min_docs) & (F.col("toxic") >= purity * F.col("n")))
    return frozenset(r.piece for r in pure.orderBy(F.desc("toxic"), "piece").limit(most).collect())


@dataclass
class ToxicityModel:
    """What ``fit`` learned. Without both labels in the sample, ``trees`` is None and every score is ``rate``."""

    trees: object | None
    calibration: object | None
    rate: float


def with_features(df: DataFrame, text: str, lexicon: frozenset[str]) -> DataFrame:
    """``df`` without its text, with the features."""
    rest = [c for c in df.columns if c != text]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(rest).schema), *(f"{x} double" for x in FEATURES)])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = Hits(lexicon)
        for batch in batches:
            rows = [features(t.as_py(), hits) for t in batch.column(text)]
            columns = [pa.array([r[k] for r in rows], pa.float64()) for k in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + columns, [*rest, *FEATURES])

    return df.mapInArrow(lean(make), schema)


def vectors(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(df)


def chance(df: DataFrame) -> DataFrame:
    return df.withColumn("chance", vector_to_array("probability")[1])


def fit(rows: DataFrame, key: str = "id", label: str = "label", trees: int = 20, depth: int = 3) -> ToxicityModel:
    """Fit trees on four fifths of the labelled feature rows and the calibration on the rest (crc32 of the key, modulo 5, is 0)."""
    rows = vectors(rows.withColumn("label", F.col(label).cast("double"))).select("vector", "label", (remainder(F.col(key), 5) == 0).alias("aside"))
    n, toxic, parts = rows.agg(F.count(F.lit(1)), F.sum("label"), F.count_distinct("label", "aside")).first()
    if not n or toxic in (0.0, float(n)):
        return ToxicityModel(None, None, (toxic or 0.0) / max(n, 1))
    whole = parts < 4  # too few rows to set some aside
    booster = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=trees, maxDepth=depth, seed=7)
    model = booster.fit(rows if whole else rows.where("not aside"))
    aside = chance(model.transform(rows if whole else rows.where("aside")))
    calibration = IsotonicRegression(featuresCol="chance", labelCol="label", predictionCol="score").fit(aside)
    return ToxicityModel(model, calibration, toxic / n)


def apply(rows: DataFrame, model: ToxicityModel) -> DataFrame:
    """Feature rows with a score between 0 and 1."""
    if model.trees is None:
        return rows.withColumn("score", F.lit(float(model.rate)))
    scored = model.calibration.transform(chance(model.trees.transform(vectors(rows))))
    return scored.withColumn("score", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)))


def toxicity(docs: DataFrame, labels: DataFrame, learn: Column, text: str = "text", key: str = "doc_id", label: str = "toxic",
             sample_rows: int = 20_000, limit: float = 0.7) -> DataFrame:
    """One row per document: key, score, predicted.

    ``learn`` says of a row of ``labels`` whether it may be learned from; of these,
    the ``sample_rows`` rows whose keys hash lowest are. Rows without key, label or
    document teach nothing. Only texts enter a score; null and empty texts get the
    score of a text without words. Keys may be null and may repeat: every row of
    ``docs`` is scored for itself. With labels of one kind only, every score is their mean.
    """
    usable = labels.where(learn & labels[label].isNotNull() & labels[key].isNotNull())
    usable = usable.select(labels[key].alias("id"), labels[label].cast("long").alias("label"))
    chosen = saved(bounded_sample(usable, "id", sample_rows), "toxicity-sample")
    rows = docs.select(docs[key].alias("id"), docs[text].alias("text"))
    lexicon = learn_lexicon(rows.join(F.broadcast(chosen), "id").where("text is not null"), "text", "label")
    made = saved(with_features(rows, "text", lexicon), "toxicity-features")
    model = fit(made.join(F.broadcast(chosen), "id"))
    scored = apply(made, model)
    return scored.select(F.col("id").alias(key), "score", (F.col("score") >= limit).cast("int").alias("predicted"))
