"""Line dedup by overlapping windows of three lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import digest, join_by_key, keyed
from vecloom.sources.staging import stage

WINDOW = 3


def line_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(h1, h2, doc_id, digest, at): 96 bits of hash for each run of `window` lines; `at` counts from 0."""
    lines = keyed(docs).withColumn("lines", F.split("text", "\n", -1)).where(F.size("lines") >= window)
    runs = lines.select(
        "doc_id",
        "digest",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(1), F.size("lines") - (window - 1)),
                lambda i: F.concat_ws("\n", F.slice("lines", i, window)),
            )
        ).alias("at", "run"),
    )
    return runs.select(F.xxhash64("run").alias("h1"), F.hash("run").alias("h2"), "doc_id", "digest", "at")


def covered_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, digest, covered): the places of the lines that a later occurrence of a window covers.

    The first occurrence is the one with the smallest (doc_id, digest, place); null ids come first.
    Windows are folded to (first, number) before they are shuffled, and only repeated ones
    join the occurrences again.
    """
    runs = stage(line_windows(docs, window), "windows")
    place = F.struct("doc_id", "digest", "at")
    repeated = runs.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = stage(repeated, "repeated")  # on its own, so that the join below can split a frequent window
    later = (
        runs.join(repeated.select("h1", "h2", "first"), ["h1", "h2"])
        .where(~place.eqNullSafe(F.col("first")))
        .groupBy("doc_id", "digest")
        .agg(F.collect_set("at").alias("starts"))
    )
    covered = F.array_distinct(F.flatten(F.transform("starts", lambda p: F.sequence(p, p + (window - 1)))))
    return later.select("doc_id", "digest", covered.alias("covered"))


def dedup_lines(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs, all columns, with `text` less the lines of repeated windows, and n_lines and n_removed added.

    A window is `window` consecutive lines, compared as they are. All occurrences of a window
    but the first go; what overlapping windows cover is merged, and each covered line goes
    once. Documents with fewer lines than a window stay as they are. A null text is empty
    (one empty line); an empty table gives an empty table; rows that agree in id and text
    are one document and get the same result. Other columns are not looked at; columns named n_lines or
    n_removed are replaced.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_lines", "n_removed")]
    rows = docs.select(
        "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.struct(*others).alias("others") if others else F.lit(0).alias("others")
    ).withColumn("digest", digest(F.col("text")))
    joined = join_by_key(rows, covered_lines(docs, window)).withColumn("lines", F.split("text", "\n", -1))
    none = F.array().cast("array<int>")
    joined = joined.withColumn("kept", F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.coalesce("covered", none)))
    text = F.when(F.col("covered").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n")
    )
    made = {c: F.col("others")[c] for c in others} | {"doc_id": F.col("doc_id"), "text": text}
    return joined.select(
        *[made[c].alias(c) for c in docs.columns if c in made],
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size("kept")).cast("long").alias("n_removed"),
    )
