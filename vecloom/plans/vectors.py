"""Vector metrics, retrieval and training logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecloom.functions import vectors as X
from vecloom.operators import agreement as A
from vecloom.operators import models, retrieval
from vecloom.operators import training_log as L
from vecloom.operators.embedding import keep_embedded
from vecloom.operators.ordered import numbered
from vecloom.plans import query
from vecloom.sources import tables as S
from vecloom.sources.staging import new_path, stage
from vecloom.streaming import checkpoints, progress

# The second side of a vector pair is the next vector.
PAIRED_SQL = """p AS (SELECT a.vec_id, a.label, b.label AS other_label, a.embedding::DOUBLE[] AS x, b.embedding::DOUBLE[] AS y,
    list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS similarity
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)"""


def embeddings(spark, folder):
    return S.table(spark, folder, "embeddings")


def paired(spark, folder):
    rows = embeddings(spark, folder)
    other = rows.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"), F.col("label").alias("other_label"))
    return A.aligned_pairs(rows, other, "vec_id")


def scored(spark, folder):
    return A.with_cosine(paired(spark, folder), "embedding", "other")


@query("filter_empty_vec", "SELECT vec_id FROM embeddings WHERE vec_id % 9 <> 0 AND len(embedding) > 0")
def filter_empty_vec(spark, folder):
    failed = F.when(F.col("vec_id") % 9 == 0, F.array().cast("array<float>")).otherwise(F.col("embedding"))
    return keep_embedded(embeddings(spark, folder).withColumn("embedding", failed)).select("vec_id")


@query("pair_cosine", f"WITH {PAIRED_SQL} SELECT vec_id, round(similarity, 6) AS similarity FROM p")
def pair_cosine(spark, folder):
    return scored(spark, folder).select("vec_id", F.round("similarity", 6).alias("similarity"))


@query(
    "l2_normalise",
    """WITH e AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x * (vec_id + 1)) AS v FROM embeddings),
    n AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS size FROM e)
    SELECT vec_id, CAST(pos AS INTEGER) AS pos, round(v[pos + 1] / size, 6) AS value FROM n, (SELECT unnest(range(0, 64)) AS pos)""",
)
def l2_normalise(spark, folder):
    longer = embeddings(spark, folder).withColumn("embedding", F.transform("embedding", lambda x: x.cast("double") * (F.col("vec_id") + 1)))
    unit = X.l2_normalise(longer, "embedding")
    return unit.select("vec_id", F.posexplode("embedding").alias("pos", "value")).withColumn("value", F.round("value", 6))


@query(
    "mean_pool",
    """SELECT label, CAST(pos AS INTEGER) AS pos, round(avg(embedding[pos + 1]::DOUBLE), 6) AS value
    FROM embeddings, (SELECT unnest(range(0, 64)) AS pos) GROUP BY ALL""",
)
def mean_pool(spark, folder):
    means = A.mean_vectors(embeddings(spark, folder), "label")
    return means.select("label", F.posexplode("embedding").alias("pos", "value")).withColumn("value", F.round("value", 6))


@query(
    "pearson",
    """SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS pearson, count(*) AS num_samples
    FROM lineitem GROUP BY l_returnflag""",
)
def pearson(spark, folder):
    rows = A.pearson(S.table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"])
    return rows.withColumn("pearson", F.round("pearson", 6))


@query(
    "spearman",
    """WITH r AS (SELECT l_returnflag,
        rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity)
            + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2.0::DOUBLE AS a,
        rank() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice)
            + (count(*) OVER (PARTITION BY l_returnflag, l_extendedprice) - 1) / 2.0::DOUBLE AS b FROM lineitem)
    SELECT l_returnflag, round(corr(a, b), 6) AS spearman FROM r GROUP BY l_returnflag""",
)
def spearman(spark, folder):
    rows = A.spearman(S.table(spark, folder, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"])
    return rows.withColumn("spearman", F.round("spearman", 6))


@query(
    "sts_eval",
    f"""WITH {PAIRED_SQL}, s AS (SELECT 'next' AS model, CASE WHEN vec_id % 10 < 8 THEN 'train' ELSE 'test' END AS split,
        similarity AS a, (5 - least(abs(label - other_label), 5)) / 5.0::DOUBLE AS b FROM p),
    r AS (SELECT *, rank() OVER (PARTITION BY model, split ORDER BY a)
            + (count(*) OVER (PARTITION BY model, split, a) - 1) / 2.0::DOUBLE AS ra,
        rank() OVER (PARTITION BY model, split ORDER BY b)
            + (count(*) OVER (PARTITION BY model, split, b) - 1) / 2.0::DOUBLE AS rb FROM s)
    SELECT model, split, round(corr(a, b), 4) AS pearson, round(corr(ra, rb), 4) AS spearman, count(*) AS num_samples,
        count(*) * 0.25::DOUBLE AS processing_time_seconds
    FROM r GROUP BY model, split""",
)
def sts_eval(spark, folder):
    gold = (5 - F.least(F.abs(F.col("label") - F.col("other_label")), F.lit(5))) / 5.0
    split = F.when(F.col("vec_id") % 10 < 8, "train").otherwise("test")
    rows = scored(spark, folder).withColumns({"model": F.lit("next"), "split": split, "score": gold, "seconds": F.lit(0.25)})
    return A.sts_result(rows, ["model", "split"])


DISTILL_SQL = f"""WITH {PAIRED_SQL} SELECT label, {{0}} FROM p GROUP BY label"""


@query("distill_cosine", DISTILL_SQL.format("round(avg(1 - similarity), 6) AS cosine_loss"))
def distill_cosine(spark, folder):
    losses = A.distill_losses(paired(spark, folder), "embedding", "other", "label")
    return losses.select("label", F.round("cosine_loss", 6).alias("cosine_loss"))


@query(
    "distill_mse",
    DISTILL_SQL.format("round(sum(list_distance(x, y) * list_distance(x, y)) / sum(len(x)), 6) AS mse_loss"),
)
def distill_mse(spark, folder):
    losses = A.distill_losses(paired(spark, folder), "embedding", "other", "label")
    return losses.select("label", F.round("mse_loss", 6).alias("mse_loss"))


@query(
    "pair_ap",
    f"""WITH {PAIRED_SQL}, l AS (SELECT round(similarity, 4) AS s, count(*) AS n, sum(CASE WHEN label = other_label THEN 1 ELSE 0 END) AS pos
        FROM p GROUP BY 1),
    c AS (SELECT pos, sum(n) OVER w AS n_upto, sum(pos) OVER w AS pos_upto FROM l WINDOW w AS (ORDER BY s DESC))
    SELECT round(sum(pos * pos_upto / n_upto) / sum(pos), 6) AS ap FROM c""",
)
def pair_ap(spark, folder):
    rows = scored(spark, folder).withColumn("positive", F.col("label") == F.col("other_label"))
    rows = rows.withColumn("similarity", F.round("similarity", 4))
    return A.average_precision(rows, "similarity", "positive").withColumn("ap", F.round("ap", 6))


def as_vectors(df):
    return df.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


@query(
    "topk_cosine",
    """WITH s AS (SELECT a.vec_id AS qid, b.vec_id AS did,
        round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS similarity
        FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id)
    SELECT qid, did, CAST(rank AS INTEGER) AS rank, round(similarity, 6) AS similarity FROM (
        SELECT *, row_number() OVER (PARTITION BY qid ORDER BY similarity DESC, did) AS rank FROM s) WHERE rank <= 10""",
)
def topk_cosine(spark, folder):
    vectors = as_vectors(embeddings(spark, folder))
    best = retrieval.top_k(vectors, vectors, 10, skip_self=True)
    return best.withColumn("similarity", F.round("similarity", 6))


# Queries are the even vectors, documents the odd ones, and each query's document comes right after it.
RANKS_SQL = """q AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE vec_id % 2 = 0),
    d AS (SELECT vec_id, embedding::DOUBLE[] AS y FROM embeddings WHERE vec_id % 2 = 1),
    s AS (SELECT q.vec_id AS qid, d.vec_id AS did, round(list_cosine_similarity(x, y), 9) AS similarity FROM q, d),
    r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY similarity DESC, did) AS rank FROM s),
    k AS (SELECT qid, did, rank FROM r WHERE did = qid + 1)"""


def judged(spark, folder):
    rows = as_vectors(embeddings(spark, folder))
    queries, docs = rows.where("id % 2 = 0"), rows.where("id % 2 = 1")
    qrels = queries.select(F.col("id").alias("qid"), (F.col("id") + 1).alias("did"))
    return queries, docs, qrels.join(docs.select(F.col("id").alias("did")), "did", "left_semi").select("qid", "did")


def ranks(spark, folder):
    return retrieval.relevant_ranks(*judged(spark, folder))


@query("qrels_rank", f"WITH {RANKS_SQL} SELECT qid, did, rank FROM k")
def qrels_rank(spark, folder):
    return ranks(spark, folder)


@query(
    "ndcg_at_10",
    f"WITH {RANKS_SQL} SELECT round(avg(CASE WHEN rank <= 10 THEN 1 / log2(1 + rank) ELSE 0 END), 6) AS ndcg_at_10, count(*) AS num_queries FROM k",
)
def ndcg_at_10(spark, folder):
    scores = retrieval.ranking_scores(retrieval.first_ranks(*judged(spark, folder), 10))
    return scores.select(F.round("ndcg_at_10", 6).alias("ndcg_at_10"), "num_queries")


@query("map_score", f"WITH {RANKS_SQL} SELECT round(avg(1.0::DOUBLE / rank), 6) AS map, count(*) AS num_queries FROM k")
def map_score(spark, folder):
    scores = retrieval.ranking_scores(ranks(spark, folder))
    return scores.select(F.round("map", 6).alias("map"), "num_queries")


@query(
    "bitext_match",
    f"WITH {RANKS_SQL} SELECT round(avg(CASE WHEN rank = 1 THEN 1.0::DOUBLE ELSE 0 END), 6) AS accuracy, count(*) AS num_queries FROM k",
)
def bitext_match(spark, folder):
    scores = retrieval.ranking_scores(retrieval.first_ranks(*judged(spark, folder), 1))
    return scores.select(F.round("accuracy_at_1", 6).alias("accuracy"), "num_queries")


@query(
    "sim_matrix",
    """WITH s AS (SELECT a.vec_id AS i, b.vec_id AS j,
        round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS c FROM embeddings a, embeddings b)
    SELECT i AS id, round(max(c) FILTER (WHERE i = j), 6) AS self_similarity, round(min(c) FILTER (WHERE i <> j), 6) AS farthest,
        round(max(c) FILTER (WHERE i <> j), 6) AS nearest, round(avg(c) FILTER (WHERE i <> j), 6) AS mean_similarity
    FROM s GROUP BY i""",
)
def sim_matrix(spark, folder):
    profile = retrieval.similarity_profile(as_vectors(embeddings(spark, folder)))
    names = ["self_similarity", "farthest", "nearest", "mean_similarity"]
    return profile.select("id", *[F.round(n, 6).alias(n) for n in names])


@query("linear_probe")
def linear_probe(spark, folder):
    rows = embeddings(spark, folder)
    return models.linear_probe(rows.where("vec_id % 5 <> 0"), rows.where("vec_id % 5 = 0"))


@query("cluster_eval")
def cluster_eval(spark, folder):
    return models.cluster_score(embeddings(spark, folder), k=10)


@query(
    "v_measure",
    """WITH d AS (SELECT lang, toxic * 2 + quality AS cluster FROM documents JOIN labels USING (doc_id)),
    n AS (SELECT count(*)::DOUBLE AS n FROM d),
    c AS (SELECT lang, cluster, count(*)::DOUBLE AS k FROM d GROUP BY ALL),
    a AS (SELECT lang, sum(k) AS kl FROM c GROUP BY lang), b AS (SELECT cluster, sum(k) AS kc FROM c GROUP BY cluster),
    h AS (SELECT (SELECT -sum(kl / n * ln(kl / n)) FROM a) AS hl, (SELECT -sum(kc / n * ln(kc / n)) FROM b) AS hc,
        -sum(k / n * ln(k / kc)) AS hl_given, -sum(k / n * ln(k / kl)) AS hc_given
        FROM c JOIN a USING (lang) JOIN b USING (cluster), n GROUP BY n),
    s AS (SELECT 1 - hl_given / hl AS ho, 1 - hc_given / hc AS co FROM h)
    SELECT round(ho, 6) AS homogeneity, round(co, 6) AS completeness, round(2 * ho * co / (ho + co), 6) AS v_measure FROM s""",
)
def v_measure(spark, folder):
    rows = S.table(spark, folder, "documents").select("doc_id", "lang").join(S.table(spark, folder, "labels"), "doc_id")
    scores = A.v_measure(rows.withColumn("cluster", F.col("toxic") * 2 + F.col("quality")), "lang", "cluster")
    return scores.select(*[F.round(n, 6).alias(n) for n in ("homogeneity", "completeness", "v_measure")])


RUNNING_SQL = """SELECT event_type AS run, event_id AS step, round(avg_loss, 6) AS avg_loss FROM (
        SELECT *, avg(value) OVER (PARTITION BY event_type ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS avg_loss FROM events)
    WHERE event_id % 20 = 0"""
EVERY_SQL = "SELECT DISTINCT event_id // 2 AS step FROM events WHERE event_id // 2 > 0 AND event_id // 2 % 25 = 0"


@query("running_mean", RUNNING_SQL)
def running_mean(spark, folder):
    log = S.table(spark, folder, "events").select(
        F.col("event_type").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("loss")
    )
    means = L.running_mean(log, every=20, by="run")
    return means.select("run", "step", F.round("avg_loss", 6).alias("avg_loss"))


STREAM_BATCHES = 4


def streamed(spark, rows, order, work):
    """Rows written as a few files in order, read as a stream of one file a batch; the stream stops once and goes on from its state."""
    numbered_rows = stage(numbered(rows, [F.col(order)]), "numbered")
    n = numbered_rows.agg(F.max("rn")).first()[0] or 0
    source, target = new_path(spark, "log"), new_path(spark, "means")
    for i in range(STREAM_BATCHES):
        part = numbered_rows.where((F.col("rn") > n * i // STREAM_BATCHES) & (F.col("rn") <= n * (i + 1) // STREAM_BATCHES))
        part.drop("rn").coalesce(1).write.mode("append").parquet(source)
        if i % 2:  # a run of the stream with two new files, then a restart
            log = checkpoints.file_stream(spark, source, rows.schema, "*.parquet", files_per_batch=1)
            found = work(log)
            checkpoints.append_checkpointed(found, target, f"{target}-progress").awaitTermination()
    return checkpoints.read_checkpointed(spark, target, found.schema)


@query("running_mean_stream", RUNNING_SQL)
def running_mean_stream(spark, folder):
    log = S.table(spark, folder, "events").select(
        F.col("event_type").alias("run"), F.col("event_id").alias("step"), F.col("value").alias("loss")
    )
    means = streamed(spark, log, "step", lambda rows: progress.running_mean(rows, every=20))
    return means.select("run", "step", F.round("avg_loss", 6).alias("avg_loss"))


@query("every_n_stream", EVERY_SQL)
def every_n_stream(spark, folder):
    steps = S.table(spark, folder, "events").select("event_id", F.expr("event_id div 2").alias("step"))
    return streamed(spark, steps, "event_id", lambda rows: progress.every_n_steps(rows, 25))


EPOCHS_SQL = """b AS (SELECT event_id // 1000 AS epoch, event_id % 1000 // 64 AS batch, avg(value) AS loss FROM events GROUP BY ALL),
    e AS (SELECT epoch, round(avg(loss), 6) AS epoch_loss, count(*) AS num_batches FROM b GROUP BY epoch)"""


def epochs(spark, folder):
    rows = S.table(spark, folder, "events").select(
        F.expr("event_id div 1000").alias("epoch"),
        F.expr("event_id % 1000 div 64").alias("batch"),
        F.col("value").alias("loss"),
    )
    return L.epoch_means(L.batch_means(rows, ["epoch", "batch"])).withColumn("epoch_loss", F.round("epoch_loss", 6))


@query("epoch_mean", f"WITH {EPOCHS_SQL} SELECT epoch, epoch_loss, num_batches FROM e")
def epoch_mean(spark, folder):
    return epochs(spark, folder)


@query(
    "best_so_far",
    f"""WITH {EPOCHS_SQL}, m AS (SELECT epoch, epoch_loss,
        min(epoch_loss) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_before FROM e)
    SELECT epoch, epoch_loss, best_before, best_before IS NULL OR epoch_loss < best_before AS is_best FROM m""",
)
def best_so_far(spark, folder):
    means = stage(epochs(spark, folder).select("epoch", "epoch_loss"), "epochs")
    return L.best_so_far(means).select("epoch", "epoch_loss", "best_before", "is_best")


@query("every_n", EVERY_SQL)
def every_n(spark, folder):
    steps = S.table(spark, folder, "events").select(F.expr("event_id div 2").alias("step"))
    return L.every_n_steps(steps, 25)


@query(
    "checkpoint_marks",
    """WITH RECURSIVE c AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
    b AS (SELECT lang, n, unnest(range(1, CAST(ceil(n / 16.0) AS BIGINT) + 1)) AS batch_no FROM c),
    s AS (SELECT lang, n, batch_no, least(batch_no * 16, n) AS done FROM b),
    f AS (SELECT lang, n, 0 AS mark_no, CAST(0 AS BIGINT) AS at_rows FROM c
        UNION ALL SELECT f.lang, f.n, f.mark_no + 1, (SELECT min(done) FROM s WHERE s.lang = f.lang AND s.done >= f.at_rows + 40)
        FROM f WHERE EXISTS (SELECT 1 FROM s WHERE s.lang = f.lang AND s.done >= f.at_rows + 40))
    SELECT lang, CAST(mark_no AS BIGINT) AS mark_no, at_rows, FALSE AS is_final FROM f WHERE mark_no > 0
    UNION ALL SELECT lang, CAST(max(mark_no) + 1 AS BIGINT), max(n), TRUE FROM f GROUP BY lang""",
)
def checkpoint_marks(spark, folder):
    counts = S.table(spark, folder, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"))
    return L.checkpoint_marks(counts, batch=16, every=40).select("lang", "mark_no", "at_rows", "is_final")
