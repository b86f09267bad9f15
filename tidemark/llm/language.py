"""Language identification by words first, character n-grams for the rest (operator 10).

Every word of a text adds, for each language, the logarithm of its frequency there.
A word that the model does not know is scored by its character n-grams, borders
included: the longest n-grams first, and for each n-gram that is unknown the
next shorter ones at its place, down to single characters. Unknown single
characters count as seen once.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import different_rows, lean, saved, small

WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
CACHE = 100_000  # words scored by n-grams that a task remembers; it then starts afresh


class Frequencies:
    """Log frequencies per language of words or n-grams: a place for each, and one matrix."""

    def __init__(self, place: dict[str, int], table: np.ndarray) -> None:
        self.place, self.table = place, table

    @staticmethod
    def of(rows: dict[str, np.ndarray], languages: int) -> Frequencies:
        return Frequencies({text: k for k, text in enumerate(rows)}, np.array(list(rows.values()), float).reshape(len(rows), languages))

    @staticmethod
    def counted(found: pa.Table, languages: list[str], total: np.ndarray, entries: int) -> Frequencies:
        """Smoothed, from columns text, lang, n: each of the ``entries`` that were counted counts one half more in every language."""
        names = pc.dictionary_encode(found.column("text").combine_chunks())
        place = pc.index_in(found.column("lang").combine_chunks(), pa.array(languages, pa.string()))
        table = np.zeros((len(names.dictionary), len(languages)), np.float32)
        table[names.indices.to_numpy(), place.to_numpy()] = found.column("n").to_numpy()
        table += 0.5
        table /= (total + 0.5 * entries).astype(np.float32)
        return Frequencies({text: k for k, text in enumerate(names.dictionary.to_pylist())}, np.log(table, out=table))

    def get(self, text: str) -> np.ndarray | None:
        k = self.place.get(text)
        return None if k is None else self.table[k]


class LanguageModel:
    """What ``fit`` learned; bounded by the rows it learned from. ``grams[n - 1]`` is of n-grams of length n.

    Words scored by n-grams are remembered behind the known ones, ``CACHE`` at most.
    """

    def __init__(self, languages: list[str], words: dict[str, np.ndarray] | Frequencies, grams: list[dict[str, np.ndarray] | Frequencies], floor: np.ndarray) -> None:
        self.languages, self.floor = languages, floor
        self.words, *self.grams = [x if isinstance(x, Frequencies) else Frequencies.of(x, len(languages)) for x in (words, *grams)]
        self.known = len(self.words.place)
        self.cache: dict[str, int] = {}

    def place(self, word: str) -> int:
        """The row of a word in the table; by n-grams if it is unknown."""
        k = self.words.place.get(word)
        if k is None:
            k = self.cache.get(word)
        if k is None:
            if len(self.words.table) == self.known:
                self.words.table = np.concatenate([self.words.table, np.empty((CACHE, len(self.languages)), self.words.table.dtype)])
            if len(self.cache) >= CACHE:
                self.cache.clear()
            k = self.cache[word] = self.known + len(self.cache)
            text = f" {word} "
            longest = min(len(self.grams), len(text))
            places = range(len(text) - longest + 1)
            self.words.table[k] = sum(self.gram(text[at : at + longest]) for at in places) / len(places)
        return k

    def word(self, word: str) -> np.ndarray:
        """The log frequency of a word."""
        k = self.place(word)  # may put another table in place
        return self.words.table[k]

    def gram(self, gram: str) -> np.ndarray:
        known = self.grams[len(gram) - 1].get(gram)
        if known is not None:
            return known
        if len(gram) == 1:
            return self.floor
        return (self.gram(gram[:-1]) + self.gram(gram[1:])) / 2

    def scores(self, words: list[str]) -> np.ndarray:
        """Rows of the words; in parts, so that words of one part do not displace each other from the cache."""
        parts = []
        for at in range(0, len(words), CACHE // 2):
            if len(self.cache) > CACHE // 2:
                self.cache.clear()
            places = [self.place(w) for w in words[at : at + CACHE // 2]]
            parts.append(self.words.table[places])
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The best language and its share among all, by mean score over the text's words."""
        words = Counter(WORD.findall((text or "").lower()))
        for odd in [w for w in words if not w.isalpha()]:  # superscripts and the like, which the pattern lets through
            n, letters = words.pop(odd), "".join(filter(str.isalpha, odd))
            if letters:
                words[letters] += n
        if not words or not self.languages:
            return UNKNOWN, 0.0
        rows = self.scores(list(words))
        mean = np.array(list(words.values()), float) @ rows / words.total()
        share = np.exp(mean - mean.max())
        best = int(share.argmax())  # of equals, the first by name
        return self.languages[best], float(share[best] / share.sum())


def fit(sample: DataFrame, text: str = "text", lang: str = "lang", longest: int = 4) -> LanguageModel:
    """Fit on labelled rows; rows without text or language are passed over.

    All words and n-grams of ``sample`` are counted by Spark, and the driver gets them
    all, but for words seen once. Rows must be bounded by the caller (see ``learn``).
    """
    words = F.regexp_extract_all(F.lower(sample[text]), F.lit(r"\p{L}+"), 0)
    rows = sample.where(sample[text].isNotNull() & sample[lang].isNotNull()).select(sample[lang].alias("lang"), F.explode(words).alias("text"))
    counts = saved(rows.groupBy("lang", "text").agg(F.count(F.lit(1)).alias("n")), "language-words")
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    each = counts.groupBy("text").agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("by"))
    repeated = each.where("total > 1").select("text", F.inline("by"))  # a word seen once says less than its n-grams
    known = Frequencies.counted(repeated.toArrow(), languages, np.array([totals[x] for x in languages], float), each.count())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[tuple[str, str]] = Counter()
            for language, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "text", "n"))):
                for size in range(longest):
                    for gram in windows(word, size + 1):
                        found[language, gram] += n
            columns = [pa.array([x[k] for x in found], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found.values(), pa.int64())], ["lang", "text", "n"])

    pieces = counts.mapInArrow(lean(cut), "lang string, text string, n long").groupBy("lang", "text").agg(F.sum("n").alias("n")).toArrow()
    sizes, grams = pc.utf8_length(pieces.column("text")), []
    for size in range(longest):
        own = pieces.filter(pc.equal(sizes, size + 1))
        place = pc.index_in(own.column("lang"), pa.array(languages, pa.string())).to_numpy()
        total = np.bincount(place, own.column("n").to_numpy(), len(languages)) if len(place) else np.zeros(len(languages))
        grams.append(Frequencies.counted(own, languages, total, pc.count_distinct(own.column("text")).as_py()))
    floor = np.full(len(languages), -math.log(2 * len(grams[0].place) + 2))
    return LanguageModel(languages, known, grams, floor)


def windows(word: str, n: int) -> list[str]:
    text = f" {word} "
    return [text[k : k + n] for k in range(len(text) - n + 1)]


def learn(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows: int = 20_000) -> LanguageModel:
    """A model from at most ``rows`` labelled rows: of each language those whose key and text hash lowest, equally many if it has as many."""
    labelled = df.where(df[lang].isNotNull() & df[text].isNotNull())
    picked = labelled.select(labelled[key].alias("key"), labelled[text].alias("text"), labelled[lang].alias("lang"))
    return fit(saved(different_rows(picked, rows, by="lang"), "language-sample"))


def identify(df: DataFrame, model: LanguageModel, text: str = "text", out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``df`` without its text, with two more columns: the predicted language and its score between 0 and 1.

    Texts that are null or have no letter are ``und`` with score 0, and so is every
    text if the model knows no language. Other input columns with the names of ``out`` are replaced.
    The text itself is not handed back by the Python workers; who needs it joins the verdicts to it.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    rest = [c for c in df.columns if c not in (text, *out)]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(rest).schema), f"`{out[0]}` string, `{out[1]}` double"])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(text)]
            more = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + more, [*rest, *out])

    return df.select(*rest, text).mapInArrow(lean(predict), schema)


def recognised(df: DataFrame, model: LanguageModel, text: str = "text", key: str = "doc_id", least: float = 0.5) -> DataFrame:
    """The rows of ``df`` whose language is known with a score above ``least``.

    Texts go to Python once and do not come back: what goes is told by its key, or by
    key and text where keys repeat. Null keys are keys like others.
    """
    body = F.coalesce(df[text], F.lit(""))
    found = identify(df.select(df[key].alias("id"), F.sha2(body, 256).alias("digest"), df[text].alias("text")), model)
    verdict = saved(found, "language-verdict")
    gone = verdict.where((F.col("lang_pred") == UNKNOWN) | (F.col("score") <= least))
    if verdict.groupBy("id").count().where("count > 1").isEmpty():
        gone = small(saved(gone.select("id"), "language-gone"))
        return df.join(gone, df[key].eqNullSafe(gone["id"]), "left_anti")
    gone = saved(gone.select("id", "digest").distinct(), "language-gone")
    return df.join(gone, df[key].eqNullSafe(gone["id"]) & (F.sha2(body, 256) == gone["digest"]), "left_anti")
