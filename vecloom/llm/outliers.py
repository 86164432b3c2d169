"""Quality rules: text statistics, fixed limits, and robust multivariate outliers per language and source.

Built-in expressions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import digest, words
from vecloom.sources.staging import stage

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
# Share of a group's rows that the estimate rests on, and concentration steps after the first estimate.
SHARE = 0.75
STEPS = 3
# Quantiles of chi-squared with 4 degrees of freedom: fixed values.
CHI2_4_AT_SHARE = 5.385
CHI2_4_CUTOFF = 33.377  # upper tail 1e-6
# P(chi-squared with 6 degrees of freedom <= CHI2_4_AT_SHARE) / SHARE, the shrinking of the trimmed covariance.
TRIMMED_SCALE = 0.505 / SHARE
# Smallest spread of each statistic: a group whose rows agree does not reject what is a little off.
FLOORS = (0.06, 0.05, 0.08, 0.08)
# Groups with fewer rows are judged by their language, and small languages by the whole table.
MIN_GROUP = 200

FEATURES = ("x0", "x1", "x2", "x3")


def text_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of whole texts.

    Windows of eight words are compared by 64-bit hashes inside a text. Only texts in which some
    window occurs twice sort theirs.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", "lang", "source", text.alias("text"), digest(text).alias("digest"))
    rows = rows.withColumn("words", words(F.col("text")))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike("[^ \\t-\\r]"))
    rows = rows.select(
        "doc_id",
        "digest",
        "lang",
        "source",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.regexp_replace("text", "[ \\t-\\r]+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        lines.alias("lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    windows = F.when(
        F.size("hashes") >= WINDOW,
        F.transform(F.sequence(F.lit(1), F.size("hashes") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("hashes", i, WINDOW))),
    ).otherwise(F.array().cast("array<bigint>"))
    rows = rows.select(
        *["doc_id", "digest", "lang", "source", "n_words", "word_chars", "n_symbols"],
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("windows"),
    )
    repeats = F.size("windows") > F.size(F.array_distinct("windows"))
    placed = F.when(repeats, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("at")))))
    rows = rows.withColumn("placed", placed).drop("windows")
    again = F.filter(
        "placed",
        lambda x, i: (x["h"] == F.get("placed", i - 1)["h"]) | (x["h"] == F.get("placed", i + 1)["h"]),
    )
    rows = rows.withColumn("starts", F.sort_array(F.transform(again, lambda x: x["at"]))).drop("placed")
    covered = F.aggregate(
        F.transform("starts", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("starts", i + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("starts")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def transformed() -> list[Column]:
    """Four statistics on scales where clean texts spread about evenly.

    Each is drawn towards an ordinary text by as many words as short texts lack for a steady
    share: length of words, symbols a word, share of repeated words, repeated lines a word.
    """
    n = F.col("n_words")
    return [
        F.log((F.col("word_chars") + 250) / (n + 50)),
        F.sqrt(F.col("n_symbols") / (n + 50)),
        F.sqrt(F.col("n_repeat_words") / (n + 50)),
        F.sqrt(F.col("n_dup_lines") / (n + 50)),
    ]


def _cholesky(cov: dict[tuple[int, int], Column], p: int) -> dict[tuple[int, int], Column]:
    """Lower factor, entry by entry; each entry is given as a name of a column made before it."""
    steps: dict[tuple[int, int], Column] = {}
    for i in range(p):
        for j in range(i + 1):
            rest = cov[i, j]
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            steps[i, j] = F.sqrt(F.greatest(rest, F.lit(1e-12))) if i == j else rest / F.col(f"l{j}{j}")
    return steps


def _estimate(rows: DataFrame, by: Sequence[str], scale: float) -> DataFrame:
    """One row per group: n, centre m0.., lower factor l00.. of the covariance of `rows`.

    Sums of products are taken about 0: the statistics lie within a few units of it.
    """
    p = len(FEATURES)
    sums = [F.count(F.lit(1)).alias("n")]
    sums += [F.avg(x).alias(f"m{i}") for i, x in enumerate(FEATURES)]
    sums += [F.avg(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"s{i}{j}") for i in range(p) for j in range(i + 1)]
    found = rows.groupBy(*by).agg(*sums)
    cov = {
        (i, j): (F.col(f"s{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")) / scale + (FLOORS[i] ** 2 if i == j else 0.0)
        for i in range(p)
        for j in range(i + 1)
    }
    for (i, j), entry in _cholesky(cov, p).items():
        found = found.withColumn(f"l{i}{j}", entry)
    return found.drop(*[f"s{i}{j}" for i in range(p) for j in range(i + 1)])


def _distance(rows: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance from the m and l columns, by forward substitution."""
    for i, x in enumerate(FEATURES):
        z = F.col(x) - F.col(f"m{i}")
        for k in range(i):
            z = z - F.col(f"l{i}{k}") * F.col(f"z{k}")
        rows = rows.withColumn(f"z{i}", z / F.col(f"l{i}{i}"))
    return rows.withColumn("d2", sum(F.col(f"z{i}") * F.col(f"z{i}") for i in range(len(FEATURES))))


def _join_group(rows: DataFrame, side: DataFrame, by: Sequence[str]) -> DataFrame:
    for c in by:
        side = side.withColumnRenamed(c, f"_{c}")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    if not same:
        row = side.first()  # of the whole table
        return rows.withColumns({c: F.lit(row[c]) for c in side.columns}) if row else rows.where("false").withColumns(
            {f.name: F.lit(None).cast(f.dataType) for f in side.schema}
        )
    on = same[0]
    for x in same[1:]:
        on = on & x
    return rows.join(side, on).drop(*[f"_{c}" for c in by])


def mcd(rows: DataFrame, by: Sequence[str], share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """Minimum-covariance-determinant estimate (n, m.., l..) of each group that is large enough.

    A deterministic start (medians and quartile spreads) and concentration steps: keep the `share`
    of rows with the smallest distances, estimate again. Quantiles and moments are folded on the map side,
    so a group of any size costs one row a task; rows meet their group's estimate by a join.
    A last step weights: rows within the trimming distance of the estimate give the final one.
    """
    quartiles = [F.percentile_approx(x, [0.25, 0.5, 0.75], 2_000).alias(f"q{i}") for i, x in enumerate(FEATURES)]
    start = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *quartiles).where(F.col("n") >= MIN_GROUP)
    estimate = start.select(
        *by,
        "n",
        *[F.col(f"q{i}")[1].alias(f"m{i}") for i in range(len(FEATURES))],
        *[
            (F.greatest((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, F.lit(FLOORS[i])) if i == j else F.lit(0.0)).alias(f"l{i}{j}")
            for i in range(len(FEATURES))
            for j in range(i + 1)
        ],
    )
    estimate = stage(estimate, "mcd")
    for _ in range(steps):
        near = _distance(_join_group(rows, estimate, by)).select(*by, *FEATURES, "d2")
        cut = near.groupBy(*by).agg(F.percentile_approx("d2", share, 2_000).alias("cut"))
        kept = _join_group(near, cut, by).where("d2 <= cut")
        estimate = stage(_estimate(kept, by, TRIMMED_SCALE), "mcd")
    near = _distance(_join_group(rows, estimate, by)).where(F.col("d2") <= CHI2_4_CUTOFF)
    return stage(_estimate(near, by, 1.0), "mcd")


def quality(docs: DataFrame, cutoff: float = CHI2_4_CUTOFF) -> DataFrame:
    """One row per document: statistics, base_failed, distance and kept.

    Documents that fail the base limits (too few words, too many repeated ones) go. The others are
    measured against the robust centre and covariance of their language and source; beyond `cutoff`
    they go too. Groups with under MIN_GROUP rows use their language, then the whole table; if
    that is too small as well, nothing more is rejected. A null language or source is a value like any
    other. Null and empty texts have no words and fail. Rows are neither merged nor dropped. An empty
    table gives an empty table.
    """
    rows = text_statistics(docs)
    rows = rows.withColumn("base_failed", base_failed())
    for name, x in zip(FEATURES, transformed()):
        rows = rows.withColumn(name, x)
    rows = stage(rows, "statistics")
    sound = rows.where(~F.col("base_failed")).select("lang", "source", *FEATURES)
    names = [f"m{i}" for i in range(4)] + [f"l{i}{j}" for i in range(4) for j in range(i + 1)]
    judged = rows
    for tag, by in (("a", ["lang", "source"]), ("b", ["lang"]), ("c", [])):
        side = mcd(sound, by)
        if by:
            side = side.select(*by, F.struct(*names).alias(tag))
            side = side.withColumnsRenamed({c: f"_{c}" for c in by})
            on = F.col(by[0]).eqNullSafe(F.col(f"_{by[0]}"))
            for c in by[1:]:
                on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
            judged = judged.join(side, on, "left").drop(*[f"_{c}" for c in by])
        else:
            row = side.first()
            judged = judged.withColumn(tag, F.struct(*[F.lit(row[c] if row else None).cast("double").alias(c) for c in names]))
            judged = judged.withColumn(tag, F.when(F.lit(row is not None), F.col(tag)))
    judged = judged.withColumn("fit", F.coalesce("a", "b", "c"))
    judged = _distance(judged.select("*", *[F.col(f"fit.{c}").alias(c) for c in names]))
    kept = ~F.col("base_failed") & F.coalesce(F.col("d2") <= cutoff, F.lit(True))
    return judged.select(
        *["doc_id", "digest", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"],
        F.col("d2").alias("distance"),
        kept.alias("kept"),
    )


def quality_filter(docs: DataFrame, cutoff: float = CHI2_4_CUTOFF) -> DataFrame:
    """The rows of docs, all columns, that `quality` keeps."""
    kept = quality(docs, cutoff).where("kept").select(F.col("doc_id").alias("_kept_id"), F.col("digest").alias("_kept_digest"))
    return docs.join(
        kept.distinct(), F.col("doc_id").eqNullSafe(F.col("_kept_id")) & (digest(F.col("text")) == F.col("_kept_digest")), "left_semi"
    )
