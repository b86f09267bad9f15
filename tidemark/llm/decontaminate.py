"""Benchmark decontamination by size-partitioned MinHash containment search (operator 9, DataFrame functions only).

Items are short, documents may be long, so similarity of whole signatures says
nothing; what counts is how much of an *item* a document holds.

* Items are partitioned by size: class ``c`` has those of 2^c to 2^(c+1)-1 shingles.
* The sketch of an item is its ``k`` smallest shingle hashes, ``k`` fixed by class:
  one more than the shingles an item of that class may miss. A document that holds
  the demanded share of an item therefore holds one of its ``k`` minima, whatever
  the length of the document: the search misses nothing.
* Documents probe the sketches with all their shingles, and only classes whose
  items are not too large for them. Sketch hits are candidates.
* Candidates are verified by exact containment on the shingles' words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved, small


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(tokens: Column, width: int, of) -> Column:
    """``of`` each run of ``width`` tokens; none if there are fewer."""
    starts = F.sequence(F.lit(0), F.size(tokens) - width)
    runs = F.transform(starts, lambda i: of(*[F.get(tokens, i + j) for j in range(width)]))
    return F.when(F.size(tokens) >= width, runs).otherwise(F.array())


def joined(*tokens: Column) -> Column:
    return F.concat_ws(" ", *tokens)


def item_shingles(items: DataFrame, text: str, width: int) -> DataFrame:
    """item (a digest of its words), width, shingle: distinct."""
    tokens = items.select(words(items[text]).alias("tokens")).where(F.size("tokens") > 0)
    tokens = tokens.select("tokens", F.unhex(F.sha2(F.concat_ws(" ", "tokens"), 256)).alias("item")).dropDuplicates(["item"])
    own = F.least(F.size("tokens"), F.lit(width)).alias("width")
    by_width = F.coalesce(*[F.when(F.size("tokens") == n, shingles(F.col("tokens"), n, joined)) for n in range(1, width)],
                          shingles(F.col("tokens"), width, joined))
    return tokens.select("item", own, F.explode(F.array_distinct(by_width)).alias("shingle"))


def sketches(parts: DataFrame, percent: int) -> DataFrame:
    """item, width, least (shingles that must be shared), minimum: the k smallest hashes of each item."""
    whole = parts.groupBy("item", "width").agg(
        F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set(hashed(F.col("shingle")))).alias("hashes")
    )
    largest = F.pow(F.lit(2), F.floor(F.log2("n")) + 1) - 1  # size of the largest item of the class
    k = (F.floor(largest * (100 - percent) / 100) + 1).cast("int")
    return whole.select("item", "width", least("n", percent).alias("least"), F.explode(F.slice("hashes", 1, k)).alias("minimum"))


def hashed(shingle: Column) -> Column:
    return F.xxhash64(shingle)


def least(n: str, percent: int) -> Column:
    return F.ceil(F.col(n) * percent / 100)


def leaks(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item_text: str = "text",
          item_key: str = "item_id", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per document and item it holds: key, item key, n_shared, n_item, containment.

    A document holds an item if it has at least ``percent`` of the item's
    distinct shingles of ``width`` words. An item with fewer words is one shingle
    of its own length; one without words is never held. Null texts have no words.
    Rows with the same key and text count once; several texts under one key give
    the best containment of them. Null keys are keys like others. Other columns
    are not looked at. An empty side gives an empty result.
    """
    parts = saved(item_shingles(items, item_text, width), "leak-items")
    widths = sorted(r.width for r in parts.select("width").distinct().collect())  # at most ``width`` numbers
    probes = saved(sketches(parts, percent), "leak-sketches")
    rows = docs.select(docs[key].alias("id"), F.xxhash64(docs[text]).alias("body"), words(docs[text]).alias("tokens"))
    found = None
    for n in widths:
        runs = rows.select("id", "body", (F.size("tokens") - n + 1).alias("room"),
                           F.explode(shingles(F.col("tokens"), n, lambda *t: hashed(joined(*t)))).alias("minimum"))
        of_width = probes.where(F.col("width") == n).select("item", "least", "minimum")
        hits = runs.join(small(of_width), "minimum").where("room >= least").select("id", "body", "item")
        found = hits if found is None else found.unionByName(hits)
    result = [F.col("id").alias(key), F.col("own").alias(item_key), "n_shared", "n_item", "containment"]
    if found is None:
        none = docs.limit(0).select(docs[key].alias("id")).crossJoin(items.limit(0).select(items[item_key].alias("own")))
        numbers = [F.lit(0).cast("long").alias("n_shared"), F.lit(0).cast("long").alias("n_item"), F.lit(0.0).alias("containment")]
        return none.select("*", *numbers).select(result)
    candidates = saved(found.distinct(), "leak-candidates")

    same = lambda a, b: a.id.eqNullSafe(b.id) & (a.body == b.body)
    holders = candidates.select("id", "body").distinct()
    suspects = rows.join(holders, same(rows, holders), "left_semi")
    exact = None
    for n in widths:
        runs = suspects.select("id", "body", F.explode(F.array_distinct(shingles(F.col("tokens"), n, joined))).alias("shingle"))
        shared = runs.distinct().join(parts.where(F.col("width") == n).select("item", "shingle"), "shingle")
        exact = shared if exact is None else exact.unionByName(shared)
    shared = exact.groupBy("id", "body", "item").agg(F.count(F.lit(1)).alias("n_shared"))
    shared = shared.join(candidates, same(shared, candidates) & (shared.item == candidates.item), "left_semi")
    sizes = parts.groupBy("item").agg(F.count(F.lit(1)).alias("n_item"))
    held = shared.join(sizes, "item").where(F.col("n_shared") >= least("n_item", percent))
    names = items.select(items[item_key].alias("own"), F.unhex(F.sha2(F.concat_ws(" ", words(items[item_text])), 256)).alias("item"))
    held = held.join(names.distinct(), "item").withColumn("containment", F.col("n_shared") / F.col("n_item"))
    best = F.max(F.struct("containment", "n_shared", "n_item")).alias("best")
    return held.groupBy("id", "own").agg(best).select("id", "own", "best.*").select(result)


def drop_leaks(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", **rule) -> DataFrame:
    """The documents that hold no item."""
    found = small(saved(leaks(docs, items, text, key, **rule).select(F.col(key).alias("leaking")).distinct(), "leaking"))
    return docs.join(found, docs[key].eqNullSafe(found["leaking"]), "left_anti")
