"""How well vectors agree: with gold scores, with a teacher, with labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.functions.vectors import cosine, mean_vector, squared_error
from vecloom.operators.ordered import running, with_cells
from vecloom.sources.staging import stage


def aligned_pairs(left: DataFrame, right: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Two sides of the same pairs, joined on the pair id."""
    return left.join(right, on)


def next_turn_pairs(turns: DataFrame, first_role: str = "user", second_role: str = "assistant") -> DataFrame:
    """(conv_id, turn, anchor, positive): a turn and the answer right after it.

    Joined on (conversation, turn), so a very long conversation spreads over tasks.
    """
    first = turns.where(F.col("role") == first_role).select("conv_id", "turn", F.col("text").alias("anchor"))
    second = turns.where(F.col("role") == second_role).select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("positive")
    )
    return first.join(second, ["conv_id", "turn"])


def with_cosine(pairs: DataFrame, first: str, second: str, name: str = "similarity") -> DataFrame:
    return pairs.withColumn(name, cosine(F.col(first), F.col(second)))


def mean_vectors(df: DataFrame, by: str, column: str = "embedding") -> DataFrame:
    return df.groupBy(by).agg(mean_vector(F.col(column)).alias(column))


def average_ranks(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "rank", weight: str | None = None) -> DataFrame:
    """(by, value, name): the rank of each distinct value, ties sharing their mean rank.

    Equal values are counted before they are ordered, so ties never pile up in a task. With `weight` a
    row stands for that many.
    """
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.groupBy(*by, value).agg(n.alias("_n"))
    upto = running(with_cells(counts, [F.col(value)]), [F.col(value)], {"_upto": ("sum", F.col("_n"))}, by)
    return upto.select(*by, value, (F.col("_upto") - (F.col("_n") - 1) / 2.0).alias(name))


def scored_rows(df: DataFrame, x: str, y: str) -> DataFrame:
    """The rows that both correlations use: those with two values; NaN is a value."""
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull())


def pearson(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Correlation and the number of rows used; NaN in any of them makes it NaN."""
    return scored_rows(df, x, y).groupBy(*by).agg(F.corr(x, y).alias("pearson"), F.count(F.lit(1)).alias("num_samples"))


def spearman(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Pearson of average ranks; NaN in any row used makes it NaN.

    Equal pairs of values are counted before anything is ordered, so a few values that hold most rows
    are a few rows here. The mean of n ranks is (n + 1) / 2, whatever the ties.
    """
    pairs = stage(scored_rows(df, x, y).groupBy(*by, x, y).agg(F.count(F.lit(1)).alias("_w")), "value-pairs")
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    ranked = pairs
    if kinds[x] == kinds[y]:  # one table of both sides is put in order
        sides = F.explode(F.array(*[F.struct(F.lit(c == y).alias("y"), F.col(c).alias("v")) for c in (x, y)])).alias("_s")
        values = pairs.select(*by, "_w", sides).select(*by, "_w", F.col("_s.y").alias("_y"), F.col("_s.v").alias("_v"))
        ranks = stage(average_ranks(values, "_v", [*by, "_y"], "_rank", "_w"), "ranks")
        for side in (x, y):
            mine = ranks.where(F.col("_y") == F.lit(side == y))
            mine = mine.select(*by, F.col("_v").alias(side), F.col("_rank").alias(f"_rank_{side}"))
            ranked = ranked.join(mine, [*by, side])
    else:
        for side in (x, y):
            ranked = ranked.join(stage(average_ranks(pairs, side, by, f"_rank_{side}", "_w"), "ranks"), [*by, side])
    total = pairs.groupBy(*by).agg(F.sum("_w").alias("_total"))
    ranked = ranked.join(total, list(by)) if by else ranked.withColumn("_total", F.lit(total.first()[0]))
    dx, dy = (F.col(f"_rank_{side}") - (F.col("_total") + 1) / 2.0 for side in (x, y))
    w = F.col("_w")
    lost = F.max(F.isnan(F.col(x).cast("double")) | F.isnan(F.col(y).cast("double")))
    spread = F.sqrt(F.sum(w * dx * dx)) * F.sqrt(F.sum(w * dy * dy))
    value = F.when(lost, F.lit(float("nan"))).otherwise(F.sum(w * dx * dy) / F.nullif(spread, F.lit(0.0)))
    return ranked.groupBy(*by).agg(value.alias("spearman"))


def sts_result(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    """One result per `by` (model, split) from columns similarity and score, to 4 digits.

    A column `seconds`, the time spent on each pair, is added up, to 2 digits.
    """
    timed = ["seconds"] if "seconds" in scored.columns else []
    scored = stage(scored.select(*by, "similarity", "score", *timed), "scored")
    both = pearson(scored, "similarity", "score", by).join(spearman(scored, "similarity", "score", by), list(by))
    result = both.select(
        *by, F.round("pearson", 4).alias("pearson"), F.round("spearman", 4).alias("spearman"), "num_samples"
    )
    if not timed:
        return result
    spent = scored.groupBy(*by).agg(F.round(F.sum("seconds"), 2).alias("processing_time_seconds"))
    return result.join(spent, list(by))


def distill_losses(pairs: DataFrame, student: str, teacher: str, by: str) -> DataFrame:
    """Mean of 1 - cosine, and the mean squared difference over all elements."""
    s, t = F.col(student), F.col(teacher)
    return pairs.groupBy(by).agg(
        F.avg(1 - cosine(s, t)).alias("cosine_loss"),
        (F.sum(squared_error(s, t)) / F.sum(F.size(s))).alias("mse_loss"),
    )


def average_precision(df: DataFrame, score: str, positive: str) -> DataFrame:
    """Average precision over falling scores; equal scores form one threshold."""
    levels = stage(
        df.groupBy(score).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(positive).cast("long")).alias("pos")),
        "score-levels",
    )
    seen = running(
        with_cells(levels, [-F.col(score)]),
        [-F.col(score)],
        {"n_upto": ("sum", F.col("n")), "pos_upto": ("sum", F.col("pos"))},
    )
    gain = F.col("pos") * F.col("pos_upto") / F.col("n_upto")
    return seen.agg((F.sum(gain) / F.nullif(F.sum("pos"), F.lit(0))).alias("ap"))


def v_measure(df: DataFrame, label: str, cluster: str) -> DataFrame:
    """Homogeneity, completeness and their harmonic mean, from the contingency table."""
    cells = stage(df.groupBy(label, cluster).agg(F.count(F.lit(1)).alias("n")), "contingency")
    by_label = cells.groupBy(label).agg(F.sum("n").alias("n_label"))
    by_cluster = cells.groupBy(cluster).agg(F.sum("n").alias("n_cluster"))
    n = cells.agg(F.sum("n")).first()[0]
    joint = cells.join(by_label, label).join(by_cluster, cluster)

    def entropy(part: Column) -> Column:
        """Summed over the cells of the table, each with its share of all rows."""
        return -F.sum(F.col("n") / n * F.log(part))

    def explained(left: str, whole: str) -> Column:
        return F.when(F.col(whole) == 0, 1.0).otherwise(1 - F.col(left) / F.col(whole))

    entropies = joint.agg(
        entropy(F.col("n_label") / n).alias("h_label"),
        entropy(F.col("n_cluster") / n).alias("h_cluster"),
        entropy(F.col("n") / F.col("n_cluster")).alias("h_label_left"),
        entropy(F.col("n") / F.col("n_label")).alias("h_cluster_left"),
    )
    scores = entropies.select(
        explained("h_label_left", "h_label").alias("homogeneity"),
        explained("h_cluster_left", "h_cluster").alias("completeness"),
    )
    both = F.col("homogeneity") + F.col("completeness")
    return scores.withColumn(
        "v_measure",
        F.when(both == 0, 0.0).otherwise(2 * F.col("homogeneity") * F.col("completeness") / both),
    )
