"""Vocabularies from token frequencies, and vectors for a new vocabulary."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecloom.functions.text import tokens
from vecloom.operators.ordered import first_n, numbered
from vecloom.sources.staging import stage, with_group_figures

TOP_TOKENS = 64_000


def token_frequency(df: DataFrame, text: str = "text", by: tuple[str, ...] = ()) -> DataFrame:
    """(by, token, n): counted before the shuffle too, so a frequent token does not pile up."""
    return (
        df.select(*by, F.explode(tokens(F.col(text))).alias("token"))
        .groupBy(*by, "token")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def frequency_table(counts: DataFrame) -> DataFrame:
    """Token counts, written out, as ranking reads them twice."""
    return stage(counts, "tokens")


def top_tokens(frequency: DataFrame, k: int = TOP_TOKENS) -> DataFrame:
    """The k most frequent tokens of a frequency table, ranked; ties go by token."""
    return top_tokens_by(frequency, None, k)


def ranked_tokens(frequency: DataFrame) -> DataFrame:
    """All tokens of a frequency table, ranked by ranges of the order; ties go by token."""
    return numbered(frequency, [-F.col("n"), F.col("token")], name="rank")


# Up to this limit Spark cuts each task's share of a ranking to the limit before rows are shuffled.
GROUP_LIMIT = 1_000


def top_tokens_by(frequency: DataFrame, by: str | None, k: int) -> DataFrame:
    """The k most frequent tokens of each group of a frequency table, ranked; ties go by token.

    Tokens are not put in order. How many tokens have each count (a small table, as counts repeat) gives the lowest count
    that is reached, and how many tokens of that count are; what lies above is taken whole. Only tokens of the
    lowest count are cut by their order, and only the k of a group are ranked.
    """
    keys = [by] if by else []
    sizes = frequency.groupBy(*keys, "n").agg(F.count(F.lit(1)).alias("_m"))
    above = Window.partitionBy(*keys).orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_above", F.coalesce(F.sum("_m").over(above), F.lit(0))).where(F.col("_above") < k)
    floors = stage(sizes.groupBy(*keys).agg(F.min_by(F.struct(F.col("n").alias("least"), (k - F.col("_above")).alias("room")), "n").alias("_floor")), "floors")
    rows = with_group_figures(frequency, floors, by)
    sure = rows.where(F.col("n") > F.col("_floor.least")).drop("_floor")
    edge = rows.where(F.col("n") == F.col("_floor.least"))
    if by is None:
        room = floors.select("_floor.room").first()
        cut = edge.orderBy("token").limit(room[0] if room and room[0] else 0)
    elif k <= GROUP_LIMIT:
        order = Window.partitionBy(by).orderBy("token")
        cut = edge.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= k).where(F.col("_r") <= F.col("_floor.room"))
    else:
        limits = floors.select(by, F.col("_floor.room").cast("long").alias("row_limit"))
        cut = first_n(edge, [F.col("token")], by, limits)
    found = sure.unionByName(cut.select(*sure.columns))
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "token")))  # k rows a group


def merge_vocabularies(primary: DataFrame, source: DataFrame, added: DataFrame) -> DataFrame:
    """Primary tokens, source tokens the primary does not have, and tokens in neither."""
    kept = source.select("token").distinct().join(primary, "token", "left_anti")
    base = (
        primary.select("token").distinct().withColumn("origin", F.lit("primary"))
        .unionByName(kept.withColumn("origin", F.lit("kept")))
    )
    new = added.select("token").distinct().join(base, "token", "left_anti")
    return base.unionByName(new.withColumn("origin", F.lit("added")))


def word_pieces(token: Column) -> Column:
    """Runs of letters and runs of anything else."""
    return F.regexp_extract_all(token, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))


def match_vocabulary(
    target: DataFrame, source: DataFrame, pieces: Callable[[Column], Column] = word_pieces
) -> DataFrame:
    """(token_id, token, kind, source_ids): direct, tokenized or unmapped.

    A token of the source vocabulary maps to its own id. Any other is cut by
    `pieces`, and maps to the ids of the pieces the source knows, in order; if it
    knows none, the token is unmapped. `target` and `source` are (token, id).
    """
    target = target.select("token", F.col("id").alias("token_id"))
    source = source.select("token", F.col("id").alias("source_id"))
    looked_up = stage(target.join(source, "token", "left"), "looked-up")
    direct = looked_up.where("source_id IS NOT NULL").select(
        "token_id", "token", F.lit("direct").alias("kind"), F.array("source_id").alias("source_ids")
    )
    rest = looked_up.where("source_id IS NULL").drop("source_id")
    parts = rest.select("token_id", F.posexplode(pieces(F.col("token"))).alias("pos", "token"))
    found = (
        parts.join(source, "token")
        .groupBy("token_id")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "source_id"))).alias("found"))
        .select("token_id", F.col("found.source_id").alias("source_ids"))
    )
    cut = rest.join(found, "token_id", "left").select(
        "token_id",
        "token",
        F.when(F.col("source_ids").isNull(), "unmapped").otherwise("tokenized").alias("kind"),
        F.coalesce("source_ids", F.array().cast("array<bigint>")).alias("source_ids"),
    )
    return direct.unionByName(cut)


# Bytes of doubles in a block of source vectors, and in one of target sums.
BLOCK_BYTES = 32 * 1024 * 1024


def vector_sums(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """(token_id, n, total): the sum of the vectors of each token's ids, of (token_id, id) and (id, vector).

    A product of a sparse and a dense matrix, by blocks: a task holds a block of vectors and the pairs of a block of tokens
    that ask for them, and returns one sum a token. Vectors move once for each block of tokens that needs their
    block, never once a pair. Ids without a vector count nothing.
    """
    n_tokens, width = pairs.agg(F.approx_count_distinct("token_id")).first()[0], vectors.agg(F.max(F.size("vector"))).first()[0] or 1
    rows = max(1, BLOCK_BYTES // (8 * width))
    token_blocks = max(-(-n_tokens // rows), min(pairs.sparkSession.sparkContext.defaultParallelism, -(-n_tokens // 1_000)), 1)
    pairs = pairs.select(
        F.pmod(F.xxhash64("token_id"), F.lit(token_blocks)).cast("int").alias("t"), F.floor(F.col("id") / rows).alias("v"), "token_id", "id"
    )
    asked = pairs.select("t", "v").distinct()
    blocks = vectors.withColumn("v", F.floor(F.col("id") / rows)).join(asked, "v").select(F.col("t").alias("_t"), F.col("v").alias("_v"), "id", "vector")

    def product(left: pa.Table, right: pa.Table) -> pa.Table:
        ids = right.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        dense = right.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("float64")
        dense = dense.reshape(len(ids), -1)[order] if len(ids) else np.zeros((0, width))
        asked, token = left.column("id").to_numpy(), left.column("token_id").to_numpy()
        place = np.minimum(np.searchsorted(ids[order], asked), max(len(ids) - 1, 0))
        known = ids[order][place] == asked if len(ids) else np.zeros(len(asked), bool)
        token, place = token[known], place[known]
        order = np.argsort(token, kind="stable")
        token, place = token[order], place[order]
        starts = np.flatnonzero(np.diff(token, prepend=token[:1] - 1))
        n = np.diff(np.append(starts, len(token)))
        sums = np.zeros((len(starts), dense.shape[1]))
        for k in range(int(n.max(initial=0))):  # the k-th id of every token that has so many
            longer = np.flatnonzero(n > k)
            sums[longer] += dense[place[starts[longer] + k]]
        total = pa.ListArray.from_arrays(pa.array(np.arange(len(sums) + 1) * sums.shape[1], pa.int32()), pa.array(sums.ravel()))
        return pa.table([pa.array(token[starts], pa.int64()), pa.array(n, pa.int64()), total], names=["token_id", "n", "total"])

    sums = pairs.groupBy("t", "v").cogroup(blocks.groupBy("_t", "_v")).applyInArrow(product, "token_id long, n long, total array<double>")
    total = vector_to_array(Summarizer.sum(array_to_vector("total")))
    return sums.groupBy("token_id").agg(F.sum("n").alias("n"), total.alias("total"))


def remap_vectors(
    matched: DataFrame, vectors: DataFrame, bos_id: int, unk_id: int | None = None, fallback: str = "unk"
) -> DataFrame:
    """(token_id, is_error, vector): the mean of the source vectors of each target token.

    A leading `bos_id` is taken off. A token left without ids is an error and gets the
    vector of `unk_id`, or zeros with fallback="zeros"; without an unknown-token vector it gets none (null). `vectors`
    is (id, vector), with an id once.
    """
    vectors = vectors.select("id", "vector")
    ids = F.col("source_ids")
    trimmed = F.when(F.get(ids, F.lit(0)) == bos_id, F.slice(ids, 2, F.size(ids))).otherwise(ids)
    mapped = stage(matched.select("token_id", trimmed.alias("ids")), "mapped")
    sums = vector_sums(mapped.select("token_id", F.explode("ids").alias("id")), vectors)
    means = sums.select("token_id", F.transform("total", lambda x: x / F.col("n")).alias("vector"))
    if fallback == "zeros":
        width = vectors.agg(F.max(F.size("vector"))).first()[0] or 0
        default = F.array_repeat(F.lit(0.0), width)
    else:
        unk = None if unk_id is None else vectors.where(F.col("id") == unk_id).first()
        default = F.lit(None).cast("array<double>") if unk is None else F.array(*[F.lit(float(x)) for x in unk["vector"]])
    return mapped.join(means, "token_id", "left").select(
        "token_id", F.col("vector").isNull().alias("is_error"), F.coalesce("vector", default).alias("vector")
    )


def with_ids(top: DataFrame) -> DataFrame:
    """(token, id) of ranked tokens: ids from 0 by falling frequency, ties by token."""
    return top.select("token", (F.col("rank") - 1).cast("long").alias("id"))
