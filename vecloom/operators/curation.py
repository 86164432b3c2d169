"""Training set curation: filters, seeded caps, registry, batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.functions.text import is_truthy, pair_prompt
from vecloom.operators.ordered import numbered
from vecloom.sources.staging import stage, with_group_figures

SEED = 42
# Standard deviations by which candidates of a sample exceed its size. Results do not depend on it.
SAMPLE_MARGIN = 6.0
PAST_DIGESTS = "g"

# Data sets by task type, with row caps and weights where they have one.
_PAIR = ["anchor", "positive"]
DATASETS_BY_TYPE = {
    "retrieval": [
        "msmarco_tr", "msmarco_tr_ft", "squad_tr", "tquad", "nfcorpus_tr", "nfcorpus_tr_ft", "scifact_tr",
        "scifact_tr_ft", "scidocs_tr", "fiqa_tr", "fiqa_tr_ft", "quora_tr", "quora_tr_ft", "arguana_tr",
        "cqadupstack_gaming_tr",
    ],
    "bitext": ["wmt16_en_tr", "wmt16_en_tr_ft"],
    "sts": ["stsb_tr"],
    "classification": ["thy_sa", "offenseval", "news_cat", "haber_75", "irony_tr", "ts_timeline_news_category"],
    "pair_classification": ["snli_tr", "snli_tr_ft", "xnli_tr", "xnli_tr_ft", "multinli_tr", "multinli_tr_ft"],
    "contrastive": [
        "turkish_embedding_training", "turkish_embedding_training_colab", "turkish_weakly_supervised",
        "turkish_weakly_supervised_filtered",
    ],
    "paraphrase": ["ts_abstract_corpus_p2p", "koseyazisi_p2p", "ts_abstract_corpus", "koseyazisi"],
}
MAX_SAMPLES = {
    "msmarco_tr": 200_000, "msmarco_tr_ft": 100_000, "quora_tr": 100_000, "wmt16_en_tr": 100_000,
    "wmt16_en_tr_ft": 100_000, "snli_tr_ft": 100_000, "multinli_tr_ft": 100_000,
    "turkish_embedding_training": 500_000, "turkish_embedding_training_colab": 500_000,
    "turkish_weakly_supervised": 500_000,
}
WEIGHTS = {
    "nfcorpus_tr": 1.5, "nfcorpus_tr_ft": 1.5, "scifact_tr": 1.5, "scifact_tr_ft": 1.5, "scidocs_tr": 1.5,
    "fiqa_tr": 1.2, "fiqa_tr_ft": 1.2, "arguana_tr": 1.2, "stsb_tr": 3.0, "turkish_embedding_training": 0.5,
    "turkish_embedding_training_colab": 0.5, "turkish_weakly_supervised": 0.5, "ts_abstract_corpus_p2p": 1.5,
    "koseyazisi_p2p": 1.5,
}
TEXT_COLUMNS = {"sts": ["sentence1", "sentence2"], "classification": ["text"]}
PRESETS = {
    "default": [
        "msmarco_tr_ft", "squad_tr", "tquad", "nfcorpus_tr_ft", "fiqa_tr_ft", "quora_tr_ft", "scifact_tr_ft",
        "arguana_tr", "wmt16_en_tr_ft", "stsb_tr", "snli_tr_ft", "xnli_tr_ft", "multinli_tr_ft", "thy_sa",
        "offenseval", "news_cat", "irony_tr", "ts_abstract_corpus_p2p", "koseyazisi_p2p",
    ],
    "quick": ["stsb_tr", "squad_tr", "snli_tr_ft", "thy_sa", "ts_abstract_corpus_p2p"],
    "retrieval": [
        "msmarco_tr_ft", "squad_tr", "tquad", "nfcorpus_tr_ft", "fiqa_tr_ft", "quora_tr_ft", "scifact_tr_ft",
        "scidocs_tr", "arguana_tr", "cqadupstack_gaming_tr",
    ],
}
# The loss of each task type; any other type gets the one for pairs.
LOSS_BY_TYPE = {"CoSENTLoss": ["sts"], "SoftmaxLoss": ["classification", "pair_classification"]}
LOSS_OF_PAIRS = "MultipleNegativesRankingLoss"
# Column names that stand for the two sentences and the score of a scored pair.
SCORED_PAIR_ALIASES = {
    "sentence1": ("sentence1", "sent1", "text1", "anchor"),
    "sentence2": ("sentence2", "sent2", "text2", "positive"),
    "score": ("score", "similarity", "label"),
}


def registry_table(spark: SparkSession) -> DataFrame:
    """One row per known data set: name, task type, text columns, cap, weight."""
    rows = [
        (name, kind, TEXT_COLUMNS.get(kind, _PAIR), MAX_SAMPLES.get(name), WEIGHTS.get(name, 1.0))
        for kind, names in DATASETS_BY_TYPE.items()
        for name in names
    ]
    return spark.createDataFrame(
        rows, "name string, task_type string, text_columns array<string>, max_samples long, weight double"
    )


def requested_names(names: Sequence[str] | None = None, preset: str | None = None) -> list[str]:
    """Explicit names win; an unknown preset means the default one."""
    if names:
        return list(names)
    if preset == "all":
        return [name for group in DATASETS_BY_TYPE.values() for name in group]
    return PRESETS.get(preset, PRESETS["default"])


def select_registered(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """Rows of requested data sets; names the registry does not know select nothing."""
    known = registry_table(df.sparkSession).select("name").where(F.col("name").isin(*names))
    return df.join(F.broadcast(known), F.col(column) == F.col("name"), "left_semi")


def registry_summary(counts: DataFrame, registry: DataFrame) -> DataFrame:
    """Data sets, capped data sets, largest weight and rows per task type."""
    return (
        registry.join(counts, "name", "left")
        .groupBy("task_type")
        .agg(
            F.count(F.lit(1)).alias("n_datasets"),
            F.count("max_samples").alias("n_capped"),
            F.max("weight").alias("max_weight"),
            F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        )
    )


def drop_null_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop a row if a configured column that exists is null; empty text stays."""
    for c in columns:
        if c in df.columns:
            df = df.where(F.col(c).isNotNull())
    return df


def keep_truthy(df: DataFrame, columns: Sequence[str]) -> DataFrame | None:
    """Keep rows where every configured column has text; None if a column is missing."""
    if any(c not in df.columns for c in columns):
        return None
    for c in columns:
        df = df.where(is_truthy(F.col(c)))
    return df


def canonical_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Only the mapped columns, under their canonical names (canonical -> present)."""
    return df.select(*[F.col(src).alias(name) for name, src in mapping.items()])


def nli_as_classification(df: DataFrame, first: str, second: str, label: str) -> DataFrame:
    return df.select(pair_prompt(F.col(first), F.col(second)).alias("text"), F.col(label).alias("label"))


def resolve_aliases(columns: Sequence[str]) -> dict[str, str]:
    """Canonical name -> column; the last matching column wins."""
    return {
        name: column for column in columns for name, aliases in SCORED_PAIR_ALIASES.items() if column in aliases
    }


def requested_task(name: Column, requested: str | None) -> Column:
    """The full or the short (after the last slash) name is in the comma list; no list keeps all."""
    if not requested:
        return F.lit(True)
    wanted = requested.split(",")
    return name.isin(*wanted) | F.element_at(F.split(name, "/"), -1).isin(*wanted)


def seeded_digest(key: Column, seed: int = SEED) -> Column:
    """Sort key of a seeded shuffle, the same wherever md5 is."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def effective_cap(override: int | None, configured: Column) -> Column:
    """An override wins over the configured cap, and 0 counts as unset in both."""
    own = F.nullif(configured.cast("long"), F.lit(0).cast("long"))
    return F.lit(int(override)).cast("long") if override else own


def sample_bounds(
    df: DataFrame, by: str | None, caps: DataFrame | None, override: int | None, shuffle_always: bool = False
) -> DataFrame:
    """(by, _cap, _over, _bound): the cap of each group, if it is shuffled, and a digest bound.

    Digests are spread evenly, so the cap's share of a group, and a margin, tell below
    which digest its sample lies.
    """
    keys = [by] if by else []
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    if caps is not None:
        sizes = sizes.join(caps, by, "left").withColumn("_cap", effective_cap(override, F.col("max_samples")))
    else:
        sizes = sizes.withColumn("_cap", effective_cap(override, F.lit(None)))
    over = F.coalesce(F.col("_n") > F.col("_cap"), F.lit(False))
    n = F.greatest("_n", F.lit(1))
    share = F.col("_cap") / n
    bound = share + SAMPLE_MARGIN * F.sqrt(share / n)
    hex_bound = F.lower(F.lpad(F.hex(F.floor(bound * 2.0**32)), 8, "0"))
    # A sort key past every digest where no bound applies.
    bound = F.when(over & (bound < 1), hex_bound).otherwise(PAST_DIGESTS)
    sizes = sizes.withColumns({"_over": over | F.lit(shuffle_always), "_bound": bound})
    return sizes.select(*keys, "_cap", "_over", "_bound")


def candidates(df: DataFrame, key: str, by: str | None, bounds: DataFrame, seed: int) -> DataFrame:
    """The rows that can be in the sample, found without a shuffle if the groups are few."""
    digest = F.when(F.col("_over"), seeded_digest(F.col(key), seed))
    rows = with_group_figures(df, bounds, by).withColumn("_digest", digest)
    return rows.where(~F.col("_over") | (F.col("_digest") < F.col("_bound")))


def draw(
    df: DataFrame, key: str, by: str | None, bounds: DataFrame, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """The sample with its positions, and the bounds that hold.

    A group in which fewer rows than its cap lie below the bound, or none at all, is taken again without
    a bound, so the sample is the same whatever the margin.
    """
    keys = [by] if by else []
    bounds = stage(bounds, "bounds")
    kept = stage(candidates(df, key, by, bounds, seed), "candidates")
    bounded = bounds.where(F.col("_bound") != PAST_DIGESTS)
    found = kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("_found"))
    if by:
        found = found.withColumnRenamed(by, "_group")
        short = bounded.join(found, F.col(by).eqNullSafe(F.col("_group")), "left")
    else:
        short = bounded.withColumn("_found", F.lit(found.first()[0]))
    short = stage(short.where(F.coalesce("_found", F.lit(0)) < F.col("_cap")).select(*bounds.columns), "short")
    if not short.isEmpty():
        again = short.withColumn("_bound", F.lit(PAST_DIGESTS))
        bounds = stage(bounds.join(short.select(*keys), _same(bounds, short, by), "left_anti").unionByName(again), "bounds") if by else again
        kept = stage(candidates(df, key, by, bounds, seed), "candidates")
    order = [F.coalesce("_digest", F.lit("")), F.col(key)]
    placed = numbered(kept, order, keys, "position")
    within = F.col("_cap").isNull() | (F.col("position") <= F.col("_cap"))
    return placed.where(within).drop("_cap", "_over", "_bound", "_digest"), bounds


def _same(left: DataFrame, right: DataFrame, by: str) -> Column:
    return left[by].eqNullSafe(right[by])


def capped_sample(
    df: DataFrame,
    key: str,
    by: str | None,
    caps: DataFrame | None = None,
    override: int | None = None,
    shuffle_always: bool = False,
    seed: int = SEED,
) -> DataFrame:
    """At most `cap` rows per group, or of the table without `by`; more are shuffled and cut.

    A group at or under its cap keeps all rows in key order, unless `shuffle_always`.
    `caps` is a configuration table (by, max_samples); without cap a group stays whole.
    `position` numbers the rows kept. Candidates are written out: pass the keys only,
    and see `curate` for whole rows.
    """
    return draw(df, key, by, sample_bounds(df, by, caps, override, shuffle_always), seed)[0]


def curate(
    df: DataFrame, key: str, by: str, columns: Sequence[str], caps: DataFrame | None = None, override: int | None = None
) -> DataFrame:
    """Filter, then cap: the rows with text in all `columns`, at most the cap per group.

    The sample is drawn on a written table of the keys, so the texts are read twice
    (filter, result) however many passes the sample takes, and only texts of
    candidates are shuffled.
    """
    kept = keep_truthy(df, columns)
    if kept is None:
        return df.limit(0).withColumn("position", F.lit(None).cast("long"))
    keys = stage(kept.select(key, by), "keys")
    sample, bounds = draw(keys, key, by, sample_bounds(keys, by, caps, override))
    rows = candidates(df, key, by, bounds, SEED).select(*df.columns)
    sample = sample.select(F.col(key).alias("_key"), F.col(by).alias("_by"), "position")
    same = (F.col(key) == F.col("_key")) & F.col(by).eqNullSafe(F.col("_by"))
    return rows.join(sample, same).drop("_key", "_by")


def with_batches(df: DataFrame, order: Sequence[str], size: int) -> DataFrame:
    """Contiguous batches of `size` rows in the given order; the last one may be partial."""
    rows = numbered(df, [F.col(c) for c in order])
    return rows.withColumn("batch_no", F.floor((F.col("rn") - 1) / size)).drop("rn")


def step_plan(df: DataFrame, by: str, batch: int, epochs: int, warmup_ratio: float) -> DataFrame:
    """Planned steps (whole batches only), warm-up steps, and the steps the loop really takes."""
    rows = df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"))
    planned = F.floor(F.col("n_rows") / batch) * epochs
    return rows.withColumns(
        {
            "total_steps": planned,
            "warmup_steps": F.floor(planned * F.lit(warmup_ratio)),
            "actual_steps": F.ceil(F.col("n_rows") / batch) * epochs,
        }
    )


def label_cardinality(df: DataFrame, column: str, default: int = 3) -> DataFrame:
    """Number of distinct labels, null being one of them; a default without the column."""
    if column not in df.columns:
        return df.sparkSession.createDataFrame([(default,)], "num_labels long")
    has_null = F.max(F.col(column).isNull().cast("long"))
    return df.agg((F.countDistinct(column) + F.coalesce(has_null, F.lit(0))).alias("num_labels"))


def label_cardinality_by(df: DataFrame, by: str, column: str) -> DataFrame:
    """(by, num_labels) with null as a label."""
    has_null = F.max(F.col(column).isNull().cast("long"))
    return df.groupBy(by).agg((F.countDistinct(column) + has_null).alias("num_labels"))


def loss_plan(df: DataFrame, by: str, label: str) -> DataFrame:
    """(name, task_type, loss, num_labels) of each data set in `df` that is registered.

    Pairs are ranked, scored pairs compared, labelled texts classified; only the last
    need a number of labels.
    """
    labels = label_cardinality_by(df, by, label).withColumnRenamed(by, "name")
    kind = F.col("task_type")
    loss = F.lit(LOSS_OF_PAIRS)
    for name, types in LOSS_BY_TYPE.items():
        loss = F.when(kind.isin(types), name).otherwise(loss)
    plan = registry_table(df.sparkSession).join(labels, "name").withColumn("loss", loss)
    needed = F.when(kind.isin(LOSS_BY_TYPE["SoftmaxLoss"]), F.col("num_labels"))
    return plan.select("name", "task_type", "loss", needed.alias("num_labels"))


def retrieval_task(pairs: DataFrame, order: Sequence[str], query: str, doc: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Queries, corpus and relevance of a pair table.

    Ids follow the place of the pair in the given order; a pair with an empty side is left
    out, and its number stays unused.
    """
    keys = numbered(pairs.select(*order), [F.col(c) for c in order]).withColumn("idx", F.col("rn") - 1)
    texts = pairs.where(is_truthy(F.col(query)) & is_truthy(F.col(doc))).select(*order, query, doc)
    placed = stage(texts.join(keys, list(order)), "placed")
    qid, did = F.concat(F.lit("q"), F.col("idx")), F.concat(F.lit("d"), F.col("idx"))
    return (
        placed.select(qid.alias("qid"), F.col(query).alias("text")),
        placed.select(did.alias("did"), F.col(doc).alias("text"), F.lit("").alias("title")),
        placed.select(qid.alias("qid"), did.alias("did"), F.lit(1).alias("rel")),
    )
