"""Exact deduplication by skew-safe combining (operator 2, DataFrame functions only).

Copies meet in three steps, and each compares whole normalised texts:

1. *local*: the partial aggregation of every map task folds its own copies;
2. *salted*: the survivors of a digest meet in ``salts`` groups, so a text that
   makes up a third of all rows is folded by as many tasks;
3. *global*: at most ``salts`` winners for each digest meet.

The last step also counts the different texts of a digest. Where there is one,
which is always so with SHA-256, every row of the digest has that text, and rows
find their group by digest alone. Where there are more, rows find it by digest
and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BLANKS, saved, small

VERDICT = ["keep_id", "group_size", "kept", "text_sha256"]


def normalised(text: Column) -> Column:
    """White space runs become one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def exact_dedup(df: DataFrame, text: str = "text", key: str = "doc_id", salts: int = 16, digest_bytes: int = 32) -> DataFrame:
    """One row per input row: key, keep_id, group_size, kept, text_sha256.

    ``keep_id`` is the smallest key of the rows with the same normalised text and
    ``kept`` says whether the row has it. Null text counts as empty, and empty
    texts are copies of each other. Rows that repeat both key and text get the
    same verdict. Null keys are never smallest; a group of null keys only has a
    null ``keep_id`` and all its rows are kept. Other columns are not looked at.
    An empty input gives an empty result. ``digest_bytes`` shortens the digest by
    which rows meet, so that tests can make different texts collide.
    """
    rows = df.select(df[key].alias("id"), normalised(df[text]).alias("body"))
    rows = rows.withColumn("sha", F.unhex(F.sha2("body", 256)))
    rows = rows.withColumn("digest", F.substring("sha", 1, digest_bytes) if digest_bytes < 32 else F.col("sha"))
    light = saved(rows.select("id", "sha", "digest"), "dedup-rows")
    salted = (
        rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)))
        .groupBy("digest", "salt", "body")
        .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    )
    # one exchange by digest serves the text groups and the count of texts
    texts = salted.repartition("digest").groupBy("digest", "body").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    groups = saved(
        texts.groupBy("digest").agg(
            F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size"), F.count(F.lit(1)).alias("texts")
        ),
        "dedup-groups",
    )
    found = light.join(groups.where("texts = 1"), "digest")
    clashes = groups.where("texts > 1").select("digest")
    if not clashes.isEmpty():
        own = texts.join(clashes, "digest", "left_semi").withColumnRenamed("n", "group_size")
        again = rows.join(clashes, "digest", "left_semi").join(own, ["digest", "body"])
        found = found.select("id", "sha", "keep_id", "group_size").unionByName(again.select("id", "sha", "keep_id", "group_size"))
    return found.select(
        F.col("id").alias(key),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that stay: one of each group of equal texts.

    Where ``key`` repeats within a group, one of the repeated rows stays.
    """
    verdict = saved(exact_dedup(df, text, key).select(F.col(key).alias("id"), "kept", "text_sha256"), "dedup-verdict")
    if verdict.groupBy("id").count().where("count > 1").isEmpty():
        gone = small(saved(verdict.where("not kept").select("id"), "dedup-gone"))
        return df.join(gone, df[key].eqNullSafe(gone["id"]), "left_anti")
    # keys repeat, so rows are told apart by key and text
    kept = saved(verdict.where("kept").select("id", "text_sha256").distinct(), "dedup-kept")
    rows = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), df[key].alias("id"), F.sha2(normalised(df[text]), 256).alias("text_sha256"))
    out = rows.join(kept, rows["id"].eqNullSafe(kept["id"]) & (rows["text_sha256"] == kept["text_sha256"]), "left_semi")
    return out.dropDuplicates(["id", "text_sha256"]).select("row.*")
