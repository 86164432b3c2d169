"""Corpus building and training set curation over `documents` and `conversations`."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.functions.text import unit_score
from vecloom.operators import corpus as C
from vecloom.operators import curation as K
from vecloom.operators import registry as R
from vecloom.operators.agreement import next_turn_pairs
from vecloom.plans import query
from vecloom.sources import tables as S
from vecloom.sources.lazy import breaking_off, parquet_groups, read_groups
from vecloom.sources.staging import new_path

LANGS = ("en", "fr", "de", "es")
SMALL_QUOTAS = [("en", 100, 30, 10), ("fr", 100, 30, 10), ("de", 100, 30, 10), ("es", 100, 30, 10), ("tr", 100, 30, 10)]

# Stand-ins for columns that the tables lack, in SQL both engines read.
SPLIT = """CASE WHEN source IN ('src1', 'src4') THEN 'validation'
    WHEN source = 'src2' THEN CASE WHEN doc_id % 2 = 0 THEN 'test' ELSE 'validation' END
    WHEN doc_id % 10 < 7 THEN 'train' WHEN doc_id % 10 < 9 THEN 'validation' ELSE 'test' END"""
GAPPY_TEXT = "CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN '' ELSE text END"
GAPPY_TITLE = "CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN '' ELSE source END"

# The sources stand for known data sets; one stands for a data set nobody knows.
SET_NAMES = [n for names in K.DATASETS_BY_TYPE.values() for n in names][:12] + [
    "stsb_tr", "thy_sa", "news_cat", "snli_tr_ft", "xnli_tr_ft", "turkish_embedding_training", "koseyazisi", "unknown_set",
]
SETS_SQL = ", ".join(f"('src{i}', '{name}')" for i, name in enumerate(SET_NAMES))
CAPS = [(f"src{i}", (None, 0, 5, 20, 60)[i % 5]) for i in range(20)]
CAPS_SQL = ", ".join(f"('{s}', {'NULL' if c is None else c})" for s, c in CAPS)


def documents(spark, folder) -> DataFrame:
    return S.table(spark, folder, "documents")


def with_splits(df: DataFrame) -> DataFrame:
    return df.withColumn("split", F.expr(SPLIT))


def as_sets(spark, df: DataFrame) -> DataFrame:
    names = spark.createDataFrame([(f"src{i}", n) for i, n in enumerate(SET_NAMES)], "source string, dataset string")
    return df.join(F.broadcast(names), "source")


def quota_sql(quotas) -> str:
    return "q(lang, train_n, val_n, test_n) AS (VALUES " + ", ".join(
        f"('{l}', {a}, {b}, {c})" for l, a, b, c in quotas
    ) + ")"


def split_sql(quotas) -> str:
    return f"""{quota_sql(quotas)}, r AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn,
            count(*) OVER (PARTITION BY lang) AS c FROM documents),
    k AS (SELECT r.*, train_n + val_n + test_n AS need, least(c, train_n + val_n + test_n) AS avail, train_n, val_n
        FROM r JOIN q USING (lang)),
    z AS (SELECT *, CASE WHEN avail < need THEN CAST(floor(train_n * (avail::DOUBLE / need::DOUBLE)) AS BIGINT)
            ELSE train_n END AS train_k,
        CASE WHEN avail < need THEN CAST(floor(val_n * (avail::DOUBLE / need::DOUBLE)) AS BIGINT) ELSE val_n END AS val_k
        FROM k WHERE rn <= need),
    s AS (SELECT *, CASE WHEN rn <= train_k THEN 'train' WHEN rn <= train_k + val_k THEN 'validation'
        ELSE 'test' END AS split FROM z)"""


@query(
    "bounded_scan",
    """SELECT doc_id, lang, title, n_chars, rn FROM (
        SELECT doc_id, lang, '' AS title, n_chars, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn
        FROM documents) WHERE rn <= 50 AND lang IN ('en', 'fr', 'de', 'es')""",
)
def bounded_scan(spark, folder):
    rows = C.corpus_rows(documents(spark, folder))
    return C.bounded_scan(rows, "doc_id", 50, "lang", LANGS).select("doc_id", "lang", "title", "n_chars", "rn")


@query("load_split", f"SELECT doc_id, source, md5(text) AS digest FROM documents WHERE ({SPLIT}) = 'validation'")
def load_split(spark, folder):
    rows = S.load_split(with_splits(documents(spark, folder)), "validation")
    return rows.select("doc_id", "source", F.md5("text").alias("digest"))


def fallback_sql(order) -> str:
    cases = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(order))
    return f"""SELECT doc_id, source, split FROM (
        SELECT *, min(place) OVER (PARTITION BY source) AS best FROM (
            SELECT *, CASE split {cases} END AS place FROM (SELECT doc_id, source, {SPLIT} AS split FROM documents))
        ) WHERE place = best"""


@query("split_fallback", fallback_sql(S.RETRIEVAL_SPLITS))
def split_fallback(spark, folder):
    rows = with_splits(documents(spark, folder).select("doc_id", "source"))
    return S.first_present_split(rows, S.RETRIEVAL_SPLITS, "source").select("doc_id", "source", "split")


@query("split_fallback_train", fallback_sql(S.CURATION_SPLITS))
def split_fallback_train(spark, folder):
    rows = with_splits(documents(spark, folder).select("doc_id", "source"))
    return S.first_present_split(rows, S.CURATION_SPLITS, "source").select("doc_id", "source", "split")


@query(
    "test_from_validation",
    f"""WITH d AS (SELECT doc_id, source, {SPLIT} AS split FROM documents),
    t AS (SELECT DISTINCT source FROM d WHERE split = 'test')
    SELECT * FROM d UNION ALL
    SELECT doc_id, source, 'test' FROM d WHERE split = 'validation' AND source NOT IN (SELECT source FROM t)""",
)
def test_from_validation(spark, folder):
    rows = with_splits(documents(spark, folder).select("doc_id", "source"))
    return S.with_test_split(rows, "source").select("doc_id", "source", "split")


PROBED = {
    "documents": ["text", "label"],
    "conversations": ["text", "role"],
    "embeddings": ["embedding", "label"],
    "labels": ["doc_id", "label"],
    "benchmark": ["text"],
    "pages": ["html", "text"],
    "region": ["r_name"],
    "nation": ["n_name"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_comment"],
    "events": ["event_id", "ts"],
}
PROBED_COLUMNS = {
    "documents": ["text", "label", "doc_id", "lang", "source", "n_chars"],
    "conversations": ["text", "role", "conv_id", "turn"],
    "embeddings": ["embedding", "label", "vec_id"],
    "labels": ["doc_id", "label", "quality", "toxic"],
    "benchmark": ["text", "item_id"],
    "pages": ["html", "text", "page_id", "url"],
    "region": ["r_name", "r_regionkey"],
    "nation": ["n_name", "n_nationkey", "n_regionkey"],
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": [
        "l_orderkey", "l_comment", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
}
PROBED_MISSING = {("documents", "label"), ("labels", "label"), ("pages", "text"), ("lineitem", "l_comment")}


def probe_sql() -> str:
    def one(name: str, column: str) -> str:
        missing = (name, column) in PROBED_MISSING
        return f"""SELECT '{name}' AS table_name, '{column}' AS column_name, {not missing} AS present,
            {column in PROBED[name]} AS required, count(*) AS n_rows,
            {f'count({column})' if column in PROBED[name] and not missing else 'CAST(NULL AS BIGINT)'} AS n_values FROM {name}"""

    return " UNION ALL ".join(one(n, c) for n, columns in PROBED_COLUMNS.items() for c in columns)


@query("schema_probe", probe_sql())
def schema_probe(spark, folder):
    out = None
    for name, required in PROBED.items():
        rows = S.probe_schema(S.table(spark, folder, name), name, required)
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "split_sink",
    f"WITH {split_sql(SMALL_QUOTAS)} SELECT split, lang, count(*) AS n_rows, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM s GROUP BY ALL",
)
def split_sink(spark, folder):
    rows = C.split_rows(C.quota_rows(documents(spark, folder), "doc_id", SMALL_QUOTAS))
    path = new_path(spark, "split-set")
    C.write_split_set(rows, path)
    written = spark.read.schema(rows.schema).parquet(path)
    return written.groupBy("split", "lang").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n_chars").alias("n_chars"))


@query("filter_null_text", f"SELECT doc_id FROM documents WHERE ({GAPPY_TEXT}) IS NOT NULL AND ({GAPPY_TITLE}) IS NOT NULL")
def filter_null_text(spark, folder):
    rows = documents(spark, folder).withColumns({"text": F.expr(GAPPY_TEXT), "title": F.expr(GAPPY_TITLE)})
    return K.drop_null_text(rows, ["text", "title", "not_there"]).select("doc_id")


@query("filter_truthy", f"SELECT doc_id FROM documents WHERE ({GAPPY_TEXT}) <> '' AND ({GAPPY_TITLE}) <> ''")
def filter_truthy(spark, folder):
    rows = documents(spark, folder).withColumns({"text": F.expr(GAPPY_TEXT), "title": F.expr(GAPPY_TITLE)})
    return K.keep_truthy(rows, ["text", "title"]).select("doc_id")


PAIRS_SQL = """SELECT a.conv_id, a.turn, a.text AS anchor, b.text AS positive FROM conversations a
    JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
    WHERE a.role = 'user' AND b.role = 'assistant'"""


def gappy_pairs(spark, folder) -> DataFrame:
    pairs = next_turn_pairs(S.table(spark, folder, "conversations"))
    return pairs.withColumn("positive", F.expr("CASE WHEN (conv_id + turn) % 6 = 0 THEN '' ELSE positive END"))


@query(
    "retrieval_pairs",
    f"""WITH p AS (SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS idx FROM ({PAIRS_SQL}))
    SELECT 'q' || idx AS qid, 'd' || idx AS did, CAST(1 AS INTEGER) AS rel, md5(anchor) AS query_digest,
        md5(positive) AS doc_digest FROM p WHERE anchor <> '' AND (conv_id + turn) % 6 <> 0 AND positive <> ''""",
)
def retrieval_pairs(spark, folder):
    queries, corpus, qrels = K.retrieval_task(gappy_pairs(spark, folder), ["conv_id", "turn"], "anchor", "positive")
    return (
        qrels.join(queries.select("qid", F.md5("text").alias("query_digest")), "qid")
        .join(corpus.select("did", F.md5("text").alias("doc_digest")), "did")
    )


@query("pair_align", f"SELECT conv_id, turn, md5(anchor) AS first, md5(positive) AS second FROM ({PAIRS_SQL})")
def pair_align(spark, folder):
    pairs = next_turn_pairs(S.table(spark, folder, "conversations"))
    return pairs.select("conv_id", "turn", F.md5("anchor").alias("first"), F.md5("positive").alias("second"))


@query("nli_prompt", f"SELECT md5('Premise: ' || anchor || ' Hypothesis: ' || positive) AS digest, turn AS label FROM ({PAIRS_SQL})")
def nli_prompt(spark, folder):
    pairs = next_turn_pairs(S.table(spark, folder, "conversations"))
    rows = K.nli_as_classification(pairs, "anchor", "positive", "turn")
    return rows.select(F.md5("text").alias("digest"), "label")


@query("canonical_columns", "SELECT md5(text) AS digest, n_chars AS score, lang AS label FROM documents")
def canonical_columns(spark, folder):
    rows = documents(spark, folder).withColumn("digest", F.md5("text"))
    return K.canonical_columns(rows, {"digest": "digest", "score": "n_chars", "label": "lang"})


@query(
    "alias_resolve",
    f"SELECT md5(positive) AS sentence2, md5(anchor) AS sentence1, turn AS score FROM ({PAIRS_SQL})",
)
def alias_resolve(spark, folder):
    pairs = next_turn_pairs(S.table(spark, folder, "conversations")).select(
        F.lit("x").alias("sentence1"), F.md5("anchor").alias("text1"), F.md5("positive").alias("positive"),
        F.col("conv_id").alias("similarity"), F.col("turn").alias("label"),
    )
    return K.canonical_columns(pairs, K.resolve_aliases(pairs.columns))


@query("score_normalise", "SELECT event_id, value / 5.0 AS score FROM events")
def score_normalise(spark, folder):
    events = S.table(spark, folder, "events")
    return events.select("event_id", unit_score(F.col("value").cast("string")).alias("score"))


WANTED = [*K.PRESETS["quick"], "nfcorpus_tr", "no_such_set"]


@query(
    "registry_select",
    f"""WITH m(source, dataset) AS (VALUES {SETS_SQL}) SELECT doc_id, dataset FROM documents JOIN m USING (source)
    WHERE dataset IN ({", ".join(f"'{w}'" for w in WANTED if w != "no_such_set")})""",
)
def registry_select(spark, folder):
    rows = as_sets(spark, documents(spark, folder))
    return K.select_registered(rows, "dataset", K.requested_names(WANTED)).select("doc_id", "dataset")


@query(
    "task_filter",
    "SELECT doc_id, 'org/' || source AS task FROM documents WHERE source IN ('src3', 'src7', 'src11')",
)
def task_filter(spark, folder):
    rows = documents(spark, folder).select("doc_id", F.concat(F.lit("org/"), "source").alias("task"))
    return rows.where(K.requested_task(F.col("task"), "src3,org/src7,src11,elsewhere/src12"))


@query(
    "lang_quota",
    f"WITH {split_sql(C.DEFAULT_QUOTAS)} SELECT doc_id, lang, rn, CAST(avail AS BIGINT) AS available, CAST(need AS BIGINT) AS row_limit FROM s",
)
def lang_quota(spark, folder):
    rows = C.quota_rows(documents(spark, folder), "doc_id", C.DEFAULT_QUOTAS)
    return rows.select("doc_id", "lang", "rn", "available", "row_limit")


@query("lang_split", f"WITH {split_sql(SMALL_QUOTAS)} SELECT doc_id, lang, rn, split, md5(text) AS digest FROM s")
def lang_split(spark, folder):
    rows = C.split_rows(C.quota_rows(documents(spark, folder), "doc_id", SMALL_QUOTAS))
    return rows.select("doc_id", "lang", "rn", "split", F.md5("text").alias("digest"))


# The source of one language breaks off after so many rows.
BREAKS_OFF = {"es": 57}
BROKEN_SQL = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS place FROM documents)
    WHERE lang <> 'es' OR place <= 57)"""
QUOTA_SQL = "SELECT lang, split, count(*) AS n_rows, min(doc_id) AS first_id, max(doc_id) AS last_id FROM s GROUP BY ALL"


def broken_source(spark, folder, on_error):
    """Rows of the lazy source within the quotas; one language fails while it is read."""
    source = parquet_groups(f"{folder}/documents.parquet", ["doc_id", "text"], "lang")
    limits = C.quota_limits(SMALL_QUOTAS)
    rows, record = read_groups(spark, "articles", {"doc_id": "long", "text": "string"}, breaking_off(source, BREAKS_OFF), limits)
    kept = C.split_rows(C.collected_rows(rows, record, SMALL_QUOTAS, on_error))
    return kept.groupBy("lang", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")
    )


@query("lang_quota_policy", f"WITH {split_sql([q for q in SMALL_QUOTAS if q[0] != 'es'])} {QUOTA_SQL}")
def lang_quota_policy(spark, folder):
    return broken_source(spark, folder, "drop")


@query("lang_quota_keep", f"WITH {split_sql(SMALL_QUOTAS)} {QUOTA_SQL}".replace("FROM documents),", f"FROM {BROKEN_SQL}),", 1))
def lang_quota_keep(spark, folder):
    return broken_source(spark, folder, "keep")


@query(
    "quota_totals",
    f"""WITH {split_sql(SMALL_QUOTAS)},
    a AS (SELECT 'train' AS split, sum(train_n) AS requested FROM q UNION ALL SELECT 'validation', sum(val_n) FROM q
        UNION ALL SELECT 'test', sum(test_n) FROM q),
    g AS (SELECT split, count(*) AS granted FROM s GROUP BY split)
    SELECT split, CAST(requested AS BIGINT) AS requested, coalesce(granted, 0) AS granted FROM a LEFT JOIN g USING (split)""",
)
def quota_totals(spark, folder):
    rows = C.split_rows(C.quota_rows(documents(spark, folder), "doc_id", SMALL_QUOTAS))
    return C.split_totals(rows, SMALL_QUOTAS)


CAPPED_SQL = f"""WITH m(source, max_samples) AS (VALUES {CAPS_SQL}),
    c AS (SELECT doc_id, source, nullif(max_samples, 0) AS cap, count(*) OVER (PARTITION BY source) AS n,
        md5('42:' || doc_id) AS digest FROM base JOIN m USING (source)),
    r AS (SELECT *, CASE WHEN cap IS NOT NULL AND n > cap
            THEN row_number() OVER (PARTITION BY source ORDER BY digest, doc_id)
            ELSE row_number() OVER (PARTITION BY source ORDER BY doc_id) END AS position FROM c)
    SELECT doc_id, source, position FROM r WHERE cap IS NULL OR position <= cap"""


def cap_table(spark) -> DataFrame:
    return spark.createDataFrame(CAPS, "source string, max_samples long")


@query("capped_sample", CAPPED_SQL.replace("FROM base", "FROM documents"))
def capped_sample(spark, folder):
    rows = documents(spark, folder).select("doc_id", "source")
    return K.capped_sample(rows, "doc_id", "source", cap_table(spark)).select("doc_id", "source", "position")


@query(
    "capped_override",
    """SELECT doc_id, source, position FROM (SELECT doc_id, source, n,
        CASE WHEN n > 48 THEN row_number() OVER (PARTITION BY source ORDER BY md5('42:' || doc_id), doc_id)
            ELSE row_number() OVER (PARTITION BY source ORDER BY doc_id) END AS position
        FROM (SELECT doc_id, source, count(*) OVER (PARTITION BY source) AS n FROM documents)) WHERE position <= 48""",
)
def capped_override(spark, folder):
    rows = documents(spark, folder).select("doc_id", "source")
    return K.capped_sample(rows, "doc_id", "source", cap_table(spark), override=48).select("doc_id", "source", "position")


@query(
    "eval_subsample",
    """SELECT doc_id, position FROM (
        SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS position FROM documents)
    WHERE position <= 1000""",
)
def eval_subsample(spark, folder):
    rows = documents(spark, folder).select("doc_id")
    sample = K.capped_sample(rows, "doc_id", None, override=1000, shuffle_always=True)
    return sample.select("doc_id", "position")


@query(
    "curate_sets",
    CAPPED_SQL.replace("WITH m(", f"WITH base AS (SELECT * FROM documents WHERE ({GAPPY_TEXT}) <> ''), m(")
    .replace("SELECT doc_id, source, position FROM r", "SELECT doc_id, source, position, md5(text) AS digest FROM r JOIN documents USING (doc_id, source)"),
)
def curate_sets(spark, folder):
    rows = documents(spark, folder).withColumn("text", F.expr(GAPPY_TEXT))
    curated = K.curate(rows.select("doc_id", "source", "text"), "doc_id", "source", ["text"], cap_table(spark))
    return curated.select("doc_id", "source", "position", F.md5("text").alias("digest"))


@query(
    "batch_assign",
    "SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 256) AS BIGINT) AS batch_no FROM documents",
)
def batch_assign(spark, folder):
    return K.with_batches(documents(spark, folder).select("doc_id"), ["doc_id"], 256)


@query(
    "step_plan",
    """SELECT source, n_rows, CAST(floor(n_rows / 16) * 3 AS BIGINT) AS total_steps,
        CAST(floor(floor(n_rows / 16) * 3 * 0.1::DOUBLE) AS BIGINT) AS warmup_steps,
        CAST(ceil(n_rows / 16) * 3 AS BIGINT) AS actual_steps
    FROM (SELECT source, count(*) AS n_rows FROM documents GROUP BY source)""",
)
def step_plan(spark, folder):
    return K.step_plan(documents(spark, folder), "source", batch=16, epochs=3, warmup_ratio=0.1)


def registry_sql() -> str:
    rows = ", ".join(
        f"('{n}', '{t}', {K.MAX_SAMPLES.get(n, 'NULL')}, {K.WEIGHTS.get(n, 1.0)})"
        for t, names in K.DATASETS_BY_TYPE.items()
        for n in names
    )
    return f"""WITH r(name, task_type, max_samples, weight) AS (VALUES {rows}), m(source, name) AS (VALUES {SETS_SQL}),
    c AS (SELECT name, count(*) AS n_rows FROM documents JOIN m USING (source) GROUP BY name)
    SELECT task_type, count(*) AS n_datasets, count(max_samples) AS n_capped, CAST(max(weight) AS DOUBLE) AS max_weight,
        CAST(coalesce(sum(n_rows), 0) AS BIGINT) AS n_rows FROM r LEFT JOIN c USING (name) GROUP BY task_type"""


@query("registry_summary", registry_sql())
def registry_summary(spark, folder):
    sets = as_sets(spark, documents(spark, folder))
    counts = sets.groupBy(F.col("dataset").alias("name")).agg(F.count(F.lit(1)).alias("n_rows"))
    return K.registry_summary(counts, K.registry_table(spark))


@query(
    "dataset_stats",
    """SELECT source, count(*) AS n_rows FROM documents GROUP BY source
    UNION ALL SELECT 'TOTAL', count(*) FROM documents""",
)
def dataset_stats(spark, folder):
    return C.dataset_stats(documents(spark, folder), "source")


@query(
    "concat_sets",
    f"""SELECT CAST(set_no AS INTEGER) AS set_no, doc_id FROM (
        SELECT 0 AS set_no, doc_id, source, {SPLIT} AS split FROM documents WHERE lang = 'en' UNION ALL
        SELECT 1, doc_id, source, {SPLIT} FROM documents WHERE lang = 'fr' UNION ALL
        SELECT 2, doc_id, source, {SPLIT} FROM documents) WHERE split = 'train'""",
)
def concat_sets(spark, folder):
    train = S.load_split(with_splits(documents(spark, folder).select("doc_id", "source", "lang")), "train")
    sets = [train.where("lang = 'en'"), train.where("lang = 'fr'"), train]
    return C.concat_sets(sets).select("set_no", "doc_id")


@query(
    "label_count",
    """SELECT count(DISTINCT quality) + max(CASE WHEN quality IS NULL THEN 1 ELSE 0 END) AS num_labels
    FROM documents LEFT JOIN labels USING (doc_id)""",
)
def label_count(spark, folder):
    labelled = documents(spark, folder).select("doc_id").join(S.table(spark, folder, "labels"), "doc_id", "left")
    return K.label_cardinality(labelled, "quality")


LOSS_SQL = "CASE task_type WHEN 'sts' THEN 'CoSENTLoss' WHEN 'classification' THEN 'SoftmaxLoss' WHEN 'pair_classification' THEN 'SoftmaxLoss' ELSE 'MultipleNegativesRankingLoss' END"


@query(
    "loss_plan",
    f"""WITH r(name, task_type) AS (VALUES {", ".join(f"('{n}', '{t}')" for t, names in K.DATASETS_BY_TYPE.items() for n in names)}),
    m(source, name) AS (VALUES {SETS_SQL}),
    c AS (SELECT name, count(DISTINCT quality) + max(CASE WHEN quality IS NULL THEN 1 ELSE 0 END) AS n
        FROM documents JOIN m USING (source) LEFT JOIN labels USING (doc_id) GROUP BY name)
    SELECT name, task_type, {LOSS_SQL} AS loss, CASE WHEN {LOSS_SQL} = 'SoftmaxLoss' THEN n END AS num_labels FROM r JOIN c USING (name)""",
)
def loss_plan(spark, folder):
    labelled = documents(spark, folder).select("doc_id", "source").join(S.table(spark, folder, "labels"), "doc_id", "left")
    return K.loss_plan(as_sets(spark, labelled), "dataset", "quality")


# Sources stand for the data sets of the configuration, some with a cap that bites; columns for the columns that it names.
CONFIGS = [replace(c, max_rows=15 if c.max_rows else None, split="validation" if c.split == "dev" else c.split) for c in R.CONFIGURED]
STANDING = {
    "anchor": f"({GAPPY_TITLE})", "positive": "lang", "sentence1": "source", "sentence2": f"({GAPPY_TITLE})", "premise": "lang",
    "hypothesis": "source", "text": f"({GAPPY_TEXT})", "label": "CAST(quality AS STRING)", "score": "CAST(toxic AS STRING)",
}
CONFIGURED_SQL = f"""c(source, dataset, task, split, a, b, l, cap) AS (VALUES {", ".join(
        f"('src{i}', '{c.name}', '{c.task}', '{c.split}', '{c.columns[0]}', '{c.columns[1] if len(c.columns) > 1 else ''}', '{c.label or ''}', {c.max_rows or 'NULL'})"
        for i, c in enumerate(CONFIGS))}),
    d AS (SELECT documents.*, quality, toxic, {SPLIT} AS split FROM documents LEFT JOIN labels USING (doc_id)),
    v AS (SELECT doc_id, dataset, task, cap, b, l, {", ".join(
        f"CASE {column} {' '.join(f"WHEN '{n}' THEN {x}" for n, x in STANDING.items())} END AS {name}" for column, name in (("a", "first"), ("b", "second"), ("l", "label")))}
        FROM d JOIN c USING (source, split)),
    k AS (SELECT *, count(*) OVER (PARTITION BY dataset) AS n FROM v WHERE first IS NOT NULL AND (b = '' OR second IS NOT NULL) AND (l = '' OR label IS NOT NULL)),
    r AS (SELECT *, CASE WHEN cap IS NOT NULL AND n > cap THEN row_number() OVER (PARTITION BY dataset ORDER BY md5('42:' || doc_id), doc_id)
        ELSE row_number() OVER (PARTITION BY dataset ORDER BY doc_id) END AS position FROM k)"""


def configured(spark, folder):
    docs = with_splits(documents(spark, folder)).join(S.table(spark, folder, "labels"), "doc_id", "left")
    names = spark.createDataFrame([(f"src{i}", c.name) for i, c in enumerate(CONFIGS)], "source string, dataset string")
    rows = docs.join(F.broadcast(names), "source").select("doc_id", "dataset", "split", *[F.expr(x).alias(n) for n, x in STANDING.items()])
    return R.configured_rows(rows, CONFIGS, "doc_id")


@query(
    "configured_sets",
    f"""WITH {CONFIGURED_SQL} SELECT doc_id, dataset, task, position, label,
        md5(CASE task WHEN 'nli' THEN 'Premise: ' || first || ' Hypothesis: ' || second ELSE first END) AS text_md5,
        CASE task WHEN 'nli' THEN NULL ELSE second END AS other FROM r WHERE cap IS NULL OR position <= cap""",
)
def configured_sets(spark, folder):
    rows = R.model_inputs(R.sampled_rows(configured(spark, folder), CONFIGS, "doc_id"))
    return rows.select("doc_id", "dataset", "task", "position", "label", F.md5("text").alias("text_md5"), "other")


@query(
    "configured_labels",
    f"WITH {CONFIGURED_SQL} SELECT dataset, task, count(*) AS n_rows, count(DISTINCT label) AS num_labels FROM k WHERE task IN ('cls', 'nli') GROUP BY ALL",
)
def configured_labels(spark, folder):
    return R.label_counts(configured(spark, folder))
