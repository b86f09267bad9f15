"""N-gram Jaccard join by vertical partitioning (operator 8).

1. *Order.* All shingles of all documents are counted in a table of ``2^SLOT_BITS``
   slots. Slots sorted by count, and hashes within a slot, are the global order
   of shingles, rare ones first. Any order is right; this one keeps frequent
   lines and passages at its end.
2. *Classes.* Documents with the same set are one node from here on.
3. *Candidates.* Sets with enough in common share one of the first
   ``n - ceil(t n) + 1`` shingles of their order. Where such a shingle is the first
   that two sets share, their places in both orders bound the similarity.
   So does a bitmap of each set: two bitmaps differ in no more bits than the sets
   differ in shingles. Every shingle first links its sets to one hub only. What this joins to a
   component needs no more links among itself, so of the pairs that share a
   shingle only those between different components follow, all of them. A set
   whose place alone rules out a partner like itself meets only sets that are not
   like that, so sets with much in common and too much of their own are not paired.
4. *Counting.* The order is cut into ``fragments`` of equal weight. The overlap of
   a candidate pair is counted in each fragment on its own and summed per pair.
   Before that, the overlap in the part of the order that both prefixes cover bounds
   the rest; most pairs that share no more than a passage end there.
5. *Components* of the links found.

The number of pairs follows the number of components that meet, not the square
of a group's size, as long as the sets of unlinked components meet late in their order. Nothing is capped; a pair is left out only if its bound rules
it out or both its sets are in one component already.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lean, new_folder, removed, saved, small
from tidemark.llm.components import components
from tidemark.llm.shingles import documents

SLOT_BITS = 20  # 2^20 counts: 8 MB on the driver and in each task, whatever the input
LOW_BITS = 63 - SLOT_BITS
BITMAP = ["bits0", "bits1", "bits2", "bits3"]  # 64 bits each


def slot_counts(rows: DataFrame, width: int) -> np.ndarray:
    """Shingles of all documents per slot."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            for own in documents(batch.column("text"), width):
                np.add.at(total, own >> LOW_BITS, 1)
        for slots in np.array_split(np.flatnonzero(total), 64):
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(total[slots], pa.int64())], ["slot", "n"])

    # as Arrow, so that the driver holds 16 bytes for each slot and no object
    found = rows.select("text").mapInArrow(lean(count), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << SLOT_BITS, np.int64)
    counts[found["slot"].to_numpy()] = found["n"].to_numpy()
    return counts


def order_of(counts: np.ndarray, fragments: int) -> tuple[np.ndarray, np.ndarray]:
    """The rank of each slot in the global order, and the ranks at which fragments begin."""
    by_count = np.argsort(counts, kind="stable")
    rank = np.empty(len(counts), np.int32)
    rank[by_count] = np.arange(len(counts), dtype=np.int32)
    weight = np.cumsum(counts[by_count])
    cuts = np.searchsorted(weight, weight[-1] * np.arange(1, fragments) / fragments, side="right")
    return rank, cuts << LOW_BITS


def ranked(own: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Shingles renamed so that their numbers follow the global order, sorted."""
    return np.sort((rank[own >> LOW_BITS].astype(np.int64) << LOW_BITS) | (own & ((1 << LOW_BITS) - 1)))


def lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int64), *values])))


def set_name(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """One bit for each of 256 groups of shingles: whether their number is odd."""
    odd = np.bincount(tokens & 255, minlength=256) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def signatures(rows: DataFrame, width: int, percent: int, rank) -> DataFrame:
    """id, n, name (of the set), its bitmap, prefix (the shingles of which a partner must have one)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = (ranked(own, rank.value) for own in documents(batch.column("text"), width))
            n, names, maps, heads = [], [], [], []
            for own in sets:
                n.append(len(own))
                names.append(set_name(own))
                maps.append(bitmap(own))
                heads.append(own[: len(own) - (percent * len(own) + 99) // 100 + 1].copy())
            columns = [batch.column("id"), pa.array(n, pa.int32()), pa.array(names, pa.binary())]
            columns += [pa.array([m[k] for m in maps], pa.int64()) for k in range(len(BITMAP))]
            yield pa.RecordBatch.from_arrays([*columns, lists(heads)], ["id", "n", "name", *BITMAP, "prefix"])

    kind = rows.schema["id"].dataType.simpleString()
    bits = ", ".join(f"{b} long" for b in BITMAP)
    return rows.mapInArrow(lean(sign), f"id {kind}, n int, name binary, {bits}, prefix array<long>")


def segments(rows: DataFrame, width: int, rank, cuts: np.ndarray) -> DataFrame:
    """name, fragment, tokens: the sets cut at the fragments' borders."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, parts, values = [], [], []
            for own in documents(batch.column("text"), width):
                tokens = ranked(own, rank.value)
                for k, part in enumerate(np.split(tokens, np.searchsorted(tokens, cuts))):
                    if len(part):
                        names.append(set_name(tokens))
                        parts.append(k)
                        values.append(part)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(parts, pa.int32()), lists(values)], ["name", "fragment", "tokens"])

    return rows.select("text").mapInArrow(lean(cut), "name binary, fragment int, tokens array<long>")


def may_link(x: str, y: str, percent: int) -> Column:
    """Whether sets whose first common shingle is at these places can be similar enough."""
    n, m, i, j = F.col(f"{x}n"), F.col(f"{y}n"), F.col(f"{x}at"), F.col(f"{y}at")
    most, least_union = F.least(n - i, m - j), i + j + F.greatest(n - i, m - j)
    return 100 * most >= percent * least_union


def bitmaps_allow(x: str, y: str, percent: int) -> Column:
    """Whether sets with these bitmaps can be similar enough: every differing bit takes a shingle that only one set has."""
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    differing = sum((F.bit_count(F.col(f"{x}{b}").bitwiseXOR(F.col(f"{y}{b}"))) for b in BITMAP), F.lit(0))
    return differing * (100 + percent) <= (n + m) * (100 - percent)


def meetings(mixed: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets that share a token, of which a is outside the token's main component, before any filter.

    A set is early if ``may_link`` allows it a partner with the same size and place. If it
    does so for two sets, it does for one of them with itself: the mean of what is left
    of both is no less than the smaller, no more than the larger. So late sets meet early ones only.
    """
    sizes = mixed.groupBy("token", "component").agg(F.count(F.lit(1)).alias("sets"))
    main = sizes.groupBy("token").agg(F.max(F.struct("sets", "component")).alias("main")).select("token", F.col("main.component").alias("main"))
    early = 100 * (F.col("n") - F.col("at")) >= percent * (F.col("n") + F.col("at"))
    mixed = mixed.withColumn("early", early)
    part = lambda df, x: df.select("token", F.col("node").alias(x), *[F.col(c).alias(f"{x}{c}") for c in ("n", "at", "component", *BITMAP)])
    minor = mixed.join(main, "token").where("component <> main")
    with_all = part(minor.where("early"), "a").join(part(mixed, "b"), "token")
    with_early = part(minor.where("not early"), "a").join(part(mixed.where("early"), "b"), "token")
    return with_all.unionByName(with_early)


def plausible(pairs: DataFrame, heads: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, an, b, bn) that can be links after counting the overlap where both prefixes reach.

    Both sets are known in full up to the smaller of the last shingles of their
    prefixes. Beyond it they share at most all that the smaller one has left.
    """
    left = heads.select(F.col("node").alias("a"), F.col("prefix").alias("of_a"))
    right = heads.select(F.col("node").alias("b"), F.col("prefix").alias("of_b"))
    both = pairs.join(left, "a").join(right, "b")
    reach = F.least(F.element_at("of_a", -1), F.element_at("of_b", -1))
    known = lambda tokens: F.size(F.filter(tokens, lambda t: t <= F.col("reach")))
    both = both.withColumn("reach", reach)
    most = F.size(F.array_intersect("of_a", "of_b")) + F.least(F.col("an") - known("of_a"), F.col("bn") - known("of_b"))
    both = both.withColumn("most", most)
    return both.where(100 * F.col("most") >= percent * (F.col("an") + F.col("bn") - F.col("most"))).select("a", "an", "b", "bn")


def counted(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The links among ``pairs`` (a, an, b, bn): overlaps by fragment, summed per pair."""
    left = parts.select(F.col("node").alias("a"), "fragment", F.col("tokens").alias("of_a"))
    right = parts.select(F.col("node").alias("b"), "fragment", F.col("tokens").alias("of_b"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"])
    partial = partial.select("a", "b", "an", "bn", F.size(F.array_intersect("of_a", "of_b")).alias("common"))
    total = partial.groupBy("a", "b", "an", "bn").agg(F.sum("common").alias("common"))
    return total.where(100 * F.col("common") >= percent * (F.col("an") + F.col("bn") - F.col("common"))).select("a", "b")


def similar_sets(df: DataFrame, text: str = "text", key: str = "doc_id", width: int = 5, percent: int = 80, fragments: int = 8) -> DataFrame:
    """One row per input row: key, n_shingles, component_id.

    Two rows are linked if 100 * intersection >= percent * union of their sets of
    ``width``-word shingles; ``component_id`` is the smallest key that can be
    reached over links. Null and empty texts have an empty set and are linked with
    nothing; their component is their own key. Null keys are never smallest; a
    component of null keys only is null. Repeated rows and keys are rows like
    others. Other columns are not looked at. An empty input gives an empty result.
    """
    spark = df.sparkSession
    folder = new_folder(spark, "jaccard")  # of what is written on the way
    rows = df.select(df[key].alias("id"), df[text].alias("text"))
    rank, cuts = order_of(slot_counts(rows, width), fragments)
    shared_rank = spark.sparkContext.broadcast(rank)
    signed = saved(signatures(rows, width, percent, shared_rank), "signatures", folder)

    full = signed.where("n > 0")
    classes = full.groupBy("name", "n", *BITMAP).agg(F.min("id").alias("first_id"))
    classes = saved(classes.withColumn("node", F.monotonically_increasing_id()), "classes", folder)
    heads = full.join(classes, (full.name == classes.name) & full.id.eqNullSafe(classes.first_id), "left_semi").select("name", "prefix")
    heads = heads.dropDuplicates(["name"]).join(classes.select("name", "node", "n"), "name").select("node", "n", "prefix")
    heads = saved(heads, "prefixes", folder)
    places = heads.select("node", "n", F.posexplode("prefix").alias("at", "token"))
    common = places.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1").select("token")
    shared = saved(places.join(common, "token", "left_semi").select("token", "node", "n", "at"), "places", folder)

    hubs = shared.groupBy("token").agg(F.min(F.struct("at", "n", "node")).alias("hub"))
    hubs = hubs.select("token", F.col("hub.node").alias("b"), F.col("hub.n").alias("bn"), F.col("hub.at").alias("bat"))
    own = shared.select("token", F.col("node").alias("a"), F.col("n").alias("an"), F.col("at").alias("aat"))
    stars = own.join(hubs, "token").where(F.col("a") != F.col("b")).where(may_link("a", "b", percent)).select("a", "an", "b", "bn").distinct()

    def verified(pairs: DataFrame) -> DataFrame:
        """The links among ``pairs``: the texts of those that may be links are read again and cut into fragments."""
        pairs = saved(plausible(pairs, heads, percent), "pairs", folder)
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        nodes = saved(nodes.join(classes, "node").select("node", "name", "first_id"), "nodes", folder)
        ids, names = small(nodes.select("first_id").distinct()), nodes.select("name", "node")
        texts = rows.join(ids, rows.id.eqNullSafe(ids.first_id), "left_semi")
        cut = segments(texts, width, shared_rank, cuts).join(names, "name").dropDuplicates(["name", "fragment"])
        parts = saved(cut.select("node", "fragment", "tokens"), "segments", folder)
        return saved(counted(pairs, parts, percent), "links", folder)

    links = verified(stars)
    found = saved(components(links, folder), "components", folder)

    owned = shared.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    owned = owned.join(classes.select("node", *BITMAP), "node")
    tokens = owned.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("token")
    mixed = saved(owned.join(tokens, "token", "left_semi"), "mixed", folder)
    pairs = meetings(mixed, percent).where(F.col("acomponent") != F.col("bcomponent"))
    pairs = pairs.where(may_link("a", "b", percent)).where(bitmaps_allow("a", "b", percent))
    swap = F.col("a") > F.col("b")
    pairs = pairs.select(*[F.when(swap, F.col(x)).otherwise(F.col(y)).alias(x) for x, y in (("a", "b"), ("an", "bn"), ("b", "a"), ("bn", "an"))])
    more = verified(pairs.distinct())
    if not more.isEmpty():
        found = saved(components(links.unionByName(more), folder), "components", folder)

    labelled = classes.join(found, "node", "left").select("name", "first_id", F.coalesce("component", "node").alias("component"))
    labelled = saved(labelled, "labelled", folder)
    least = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    result = signed.select("id", "n", "name").join(labelled.join(least, "component").select("name", "component_id"), "name", "left")
    result = result.select(
        F.col("id").alias(key),
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )
    result = saved(result, "jaccard-result")
    removed(spark, folder)
    shared_rank.unpersist()
    return result


def drop_similar(df: DataFrame, text: str = "text", key: str = "doc_id", width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component stays, that with the smallest key; documents without words stay.

    Rows are told apart by key: a key that stays for one row stays for all, and of
    rows that repeat the key of a component one stays. Null keys go where others stay for them.
    """
    verdict = similar_sets(df, text, key, width, percent).select(F.col(key).alias("id"), F.col(key).eqNullSafe(F.col("component_id")).alias("stays"))
    keys = saved(verdict.groupBy("id").agg(F.max("stays").alias("stays"), F.count(F.lit(1)).alias("n")), "jaccard-keys")
    gone = small(saved(keys.where("not stays").select("id"), "jaccard-gone"))
    out = df.join(gone, df[key].eqNullSafe(gone["id"]), "left_anti")
    return out if keys.where("stays and n > 1").isEmpty() else out.dropDuplicates([key])
