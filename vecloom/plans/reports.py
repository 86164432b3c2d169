"""Result files, score readers and leaderboards."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecloom.functions import scores
from vecloom.functions.text import shorten
from vecloom.operators import leaderboard as B
from vecloom.plans import query
from vecloom.sources import results as R
from vecloom.sources import tables as S
from vecloom.sources.staging import new_path, stage

# Result files of every shape, made from events in SQL that both engines read.
NUM = "'0.' || lpad(cast(event_id % 1000 AS varchar(9)), 3, '0')"
BODY = f"""CASE event_id % 12
    WHEN 0 THEN '{{"scores":{{"test":[{{"main_score":' || {NUM} || ',"accuracy":0.5}}]}}}}'
    WHEN 1 THEN '{{"scores":{{"test":[{{"accuracy":' || {NUM} || '}}]}}}}'
    WHEN 2 THEN '{{"scores":{{"test":[{{"ndcg_at_10":' || {NUM} || '}}]}}}}'
    WHEN 3 THEN '{{"scores":{{"test":[{{"cos_sim":{{"spearman":' || {NUM} || '}},"ap":0.25}}]}}}}'
    WHEN 4 THEN '{{"scores":{{"test":[{{"ap":' || {NUM} || '}},{{"main_score":0.75}}]}}}}'
    WHEN 5 THEN '{{"scores":{{"test":{{"other":{{"accuracy":0.125}},"default":{{"main_score":' || {NUM} || ',"spearman":0.5}}}}}}}}'
    WHEN 6 THEN '{{"scores":{{"test":{{"zeta":{{"accuracy":' || {NUM} || '}},"alpha":{{"accuracy":0.125}}}}}}}}'
    WHEN 7 THEN '{{"scores":{{"test":[]}}}}'
    WHEN 8 THEN '{{"scores":{{"test":{{}}}}}}'
    WHEN 9 THEN '{{"scores":{{"test":[{{"main_score":'
    WHEN 10 THEN '{{"scores":{{"test":[{{"map":' || {NUM} || ',"spearman":0.25}}]}}}}'
    ELSE '{{"scores":{{}}}}' END"""

DICT_SQL = f"""b AS (SELECT event_id, {BODY} AS body FROM events),
    j AS (SELECT event_id, CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS j FROM b),
    t AS (SELECT event_id, j, json_extract(j, '$.scores.test') AS t FROM j),
    d AS (SELECT event_id, j, t, json_extract(t, '$[0]') AS f, CASE json_type(t) WHEN 'ARRAY' THEN json_extract(t, '$[0]')
        WHEN 'OBJECT' THEN CASE WHEN json_exists(t, '$.default') THEN json_extract(t, '$.default')
            ELSE json_extract(t, '$.' || json_keys(t)[1]) END END AS d FROM t)"""


def pick_sql(source: str, keys: list[str]) -> str:
    cases = " ".join(
        f"WHEN json_exists({source}, '$.{k}') THEN CAST(json_extract({source}, '$.{k}') AS DOUBLE)" for k in keys
    )
    return f"coalesce(CASE {cases} END, 0.0::DOUBLE)"


def bodies(spark, folder):
    return S.table(spark, folder, "events").select("event_id", F.expr(BODY).alias("body"))


def rounded(rows, *columns):
    return rows.select(*columns, F.round("score", 6).alias("score"))


COMPARE = pick_sql("d", ["main_score", "accuracy", "ndcg_at_10", "cos_sim.spearman", "ap"])
SUMMARY = pick_sql("d", ["main_score", "accuracy", "ndcg_at_10", "cos_sim.spearman"])
PARSE = pick_sql("f", ["main_score", "map", "accuracy", "spearman", "cos_sim.spearman"])
LIVE = pick_sql("f", ["main_score", "cos_sim.spearman", "accuracy"])


@query("score_compare", f"WITH {DICT_SQL} SELECT event_id, round({COMPARE} * 100, 6) AS score FROM d")
def score_compare(spark, folder):
    return rounded(scores.compare_score(bodies(spark, folder)), "event_id")


@query(
    "score_summary",
    f"""WITH {DICT_SQL} SELECT event_id, round({SUMMARY} * 100, 6) AS score,
        CASE WHEN json_exists(d, '$.accuracy') THEN 'Accuracy' WHEN json_exists(d, '$.ndcg_at_10') THEN 'NDCG@10'
            WHEN json_exists(d, '$.main_score') AND json_exists(d, '$.spearman') THEN 'Spearman'
            WHEN json_exists(d, '$.main_score') AND json_exists(d, '$.ap') THEN 'AP'
            WHEN NOT json_exists(d, '$.main_score') AND json_exists(d, '$.cos_sim.spearman') THEN 'Spearman'
            ELSE 'N/A' END AS metric FROM d""",
)
def score_summary(spark, folder):
    return rounded(scores.summary_score(bodies(spark, folder)), "event_id", "metric")


@query(
    "score_parse",
    f"""WITH {DICT_SQL} SELECT event_id, round({PARSE}, 6) AS score FROM d
    WHERE j IS NOT NULL AND NOT coalesce(json_type(t) = 'OBJECT' AND len(json_keys(t)) > 0, FALSE)""",
)
def score_parse(spark, folder):
    return rounded(scores.parse_score(bodies(spark, folder)), "event_id")


@query("score_live", f"WITH {DICT_SQL} SELECT event_id, round({LIVE}, 6) AS score FROM d")
def score_live(spark, folder):
    return rounded(scores.live_score(bodies(spark, folder)), "event_id")


ENTRY = """'{"timestamp":"t' || event_id || '","dataset":"d","results":[{"model":"m' || user_id || '","pearson":0.25,
"spearman":0.5,"num_samples":' || event_id || ',"split":"test","processing_time_seconds":1.5}]}'"""
LOG = f"""CASE event_id % 4 WHEN 0 THEN {ENTRY} WHEN 1 THEN '[' || {ENTRY} || ']'
    WHEN 2 THEN '[' || {ENTRY} || ',' || {ENTRY} || ']' ELSE '[{{"timestamp":' END"""


@query(
    "result_log",
    """SELECT 't' || event_id AS timestamp, 'm' || user_id AS model, 0.5::DOUBLE AS spearman, event_id AS num_samples
    FROM events, (SELECT unnest(range(0, 2)) AS copy) WHERE event_id % 4 <> 3 AND (copy = 0 OR event_id % 4 = 2)""",
)
def result_log(spark, folder):
    files = S.table(spark, folder, "events").select(F.expr(LOG).alias("body"))
    return R.flat_log(files, "body").select("timestamp", "model", "spearman", "num_samples")


@query(
    "result_log_append",
    """SELECT event_type AS model, split, round(avg(value), 4) AS pearson, count(*) AS num_samples
    FROM events, (SELECT unnest(['train', 'test']) AS split) GROUP BY ALL""",
)
def result_log_append(spark, folder):
    path = new_path(spark, "result-log")
    means = S.table(spark, folder, "events").groupBy(F.col("event_type").alias("model")).agg(
        F.round(F.avg("value"), 4).alias("pearson"), F.lit(None).cast("double").alias("spearman"),
        F.count(F.lit(1)).alias("num_samples"), F.lit(1.0).alias("processing_time_seconds"),
    )
    for split in ("train", "test"):  # a run each, with the results of all models
        R.append_log(means.withColumn("split", F.lit(split)), path, "events")
    return R.read_log(spark, path).select("model", "split", "pearson", "num_samples")


@query(
    "task_table",
    """WITH t AS (SELECT 'Task ' || source AS task, round(avg(quality), 4) AS score FROM documents JOIN labels USING (doc_id) GROUP BY source),
    l AS (SELECT task, score, 0 AS last FROM t UNION ALL SELECT 'AVERAGE', avg(score), 1 FROM t)
    SELECT CAST(row_number() OVER (ORDER BY last, task, score) AS INTEGER) AS line, task, round(score, 6) AS score FROM l""",
)
def task_table(spark, folder):
    """The printed table of one model's flat folder, whose documents name their tasks themselves."""
    docs = S.table(spark, folder, "documents").select("doc_id", "source").join(S.table(spark, folder, "labels"), "doc_id")
    score = F.round(F.avg("quality"), 4).cast("string")
    body = F.format_string('{"task_name": "Task %s", "scores": {"test": [{"main_score": %s}]}}', F.col("source"), score)
    files = docs.groupBy("source").agg(body.alias("body")).withColumn("path", F.concat(F.lit("run/"), "source", F.lit(".json")))
    table = R.task_table(scores.parse_score(R.flat_records(files, "path", "body")))
    return table.withColumn("score", F.round("score", 6))


# One result file per (language, source, label value); a source with few of them is a thin revision.
TREE_SQL = """n AS (SELECT lang, source, quality, count(*) AS c FROM documents JOIN labels USING (doc_id) GROUP BY ALL),
    p AS (SELECT 'root/org__' || lang || '/' || source || 'abcdef/' || CASE quality WHEN 0 THEN 'model_meta'
        ELSE 'task' || c END || '.json' AS path, lang, source, quality, c FROM n)"""


@query(
    "result_tree",
    f"""WITH {TREE_SQL} SELECT 'org/' || lang || ' (' || substr(source || 'abcdef', 1, 6) || ')' AS model, 'task' || c AS task,
        md5('' || c) AS digest FROM p WHERE quality = 1 AND EXISTS (
            SELECT 1 FROM p o WHERE o.lang = p.lang AND o.source = p.source AND o.quality = 0)""",
)
def result_tree(spark, folder):
    docs = S.table(spark, folder, "documents").select("doc_id", "lang", "source")
    files = (
        docs.join(S.table(spark, folder, "labels"), "doc_id")
        .groupBy("lang", "source", "quality")
        .agg(F.count(F.lit(1)).alias("c"))
        .selectExpr(
            "'root/org__' || lang || '/' || source || 'abcdef/' || CASE quality WHEN 0 THEN 'model_meta' "
            "ELSE 'task' || c END || '.json' AS path",
            "'' || c AS body",
        )
    )
    return R.tree_records(files, "path", "body").select("model", "task", F.md5("body").alias("digest"))


# Languages stand for models, sources for tasks (one of them unknown), labelled documents for scores.
TASK_NAMES = [t for tasks in B.TASKS_BY_TYPE.values() for t in tasks]
TASK_NAMES[3] = "Unlisted-Task"
TYPE_OF = {t: kind for kind, tasks in B.TASKS_BY_TYPE.items() for t in tasks}
RECORDS_SQL = f"""m(source, "Task", "Type") AS (VALUES {", ".join(
    f"('src{i}', '{t}', '{TYPE_OF.get(t, B.OTHER)}')" for i, t in enumerate(TASK_NAMES))}),
    r AS (SELECT "Task", "Type", lang AS "Model", quality * 100.0::DOUBLE AS "Score"
        FROM documents JOIN labels USING (doc_id) JOIN m USING (source))"""


def records(spark, folder):
    names = spark.createDataFrame([(f"src{i}", t) for i, t in enumerate(TASK_NAMES)], "source string, Task string")
    docs = S.table(spark, folder, "documents").select("doc_id", "lang", "source")
    labelled = docs.join(S.table(spark, folder, "labels"), "doc_id").join(F.broadcast(names), "source")
    rows = labelled.select("Task", F.col("lang").alias("Model"), (F.col("quality") * 100.0).alias("Score"))
    return B.with_task_type(rows)


@query("task_type_join", f'WITH {RECORDS_SQL} SELECT "Task", "Type", "Model", count(*) AS n_rows FROM r GROUP BY ALL')
def task_type_join(spark, folder):
    return records(spark, folder).groupBy("Task", "Type", "Model").agg(F.count(F.lit(1)).alias("n_rows"))


MODELS = ("de", "en", "es", "fr")
PIVOT = ", ".join(f"round(avg(\"Score\") FILTER (WHERE \"Model\" = '{m}'), 6) AS {m}" for m in MODELS)


@query("leaderboard_pivot", f'WITH {RECORDS_SQL} SELECT "Type", "Task", {PIVOT} FROM r GROUP BY ALL')
def leaderboard_pivot(spark, folder):
    table = B.score_pivot(records(spark, folder), ["Type", "Task"], MODELS)
    return table.select("Type", "Task", *[F.round(m, 6).alias(m) for m in MODELS])


@query("leaderboard_mean", f'WITH {RECORDS_SQL} SELECT "Type", {PIVOT} FROM r GROUP BY ALL')
def leaderboard_mean(spark, folder):
    table = B.score_pivot(records(spark, folder), ["Type"], MODELS)
    return table.select("Type", *[F.round(m, 6).alias(m) for m in MODELS])


@query(
    "leaderboard_long",
    f'WITH {RECORDS_SQL} SELECT "Type", "Task", "Model", round(avg("Score"), 6) AS "Score" FROM r GROUP BY ALL',
)
def leaderboard_long(spark, folder):
    return B.mean_scores(records(spark, folder), ["Type", "Task"]).withColumn("Score", F.round("Score", 6))


@query("mean_by_type", f'WITH {RECORDS_SQL} SELECT "Type", round(avg("Score"), 6) AS mean_score FROM r GROUP BY "Type"')
def mean_by_type(spark, folder):
    return B.mean_by_type(records(spark, folder)).withColumn("mean_score", F.round("mean_score", 6))


@query(
    "overall_mean",
    f"""WITH {RECORDS_SQL} SELECT "Task", round(avg("Score"), 6) AS "Score" FROM r GROUP BY "Task"
    UNION ALL SELECT 'AVERAGE', round(avg("Score"), 6) FROM r""",
)
def overall_mean(spark, folder):
    return B.overall_mean(records(spark, folder)).withColumn("Score", F.round("Score", 6))


@query(
    "leaderboard_rank",
    """WITH r AS (SELECT source || '-' || repeat(lang, 25) AS model, avg(quality) AS spearman
        FROM documents JOIN labels USING (doc_id) GROUP BY 1)
    SELECT model, round(spearman, 6) AS spearman, row_number() OVER (ORDER BY round(spearman, 6) DESC, model) AS place,
        CASE WHEN length(model) > 50 THEN substr(model, 1, 48) || '..' ELSE model END AS shown FROM r""",
)
def leaderboard_rank(spark, folder):
    docs = S.table(spark, folder, "documents").selectExpr("doc_id", "source || '-' || repeat(lang, 25) AS model")
    results = docs.join(S.table(spark, folder, "labels"), "doc_id").groupBy("model").agg(
        F.round(F.avg("quality"), 6).alias("spearman")
    )
    return B.ranked(stage(results, "results")).select("model", "spearman", "place", "shown")


@query(
    "shorten_name",
    """SELECT doc_id, CASE WHEN length(n) > 50 THEN substr(n, 1, 48) || '..' ELSE n END AS shown
    FROM (SELECT doc_id, lang || '/' || repeat(source, 5 + doc_id % 9) AS n FROM documents)""",
)
def shorten_name(spark, folder):
    docs = S.table(spark, folder, "documents")
    name = F.expr("lang || '/' || repeat(source, cast(5 + doc_id % 9 AS int))")
    return docs.select("doc_id", shorten(name).alias("shown"))


@query(
    "score_delta",
    f"""WITH {RECORDS_SQL}, a AS (SELECT "Task", avg("Score") FILTER (WHERE "Model" = 'en') AS b,
        avg("Score") FILTER (WHERE "Model" = 'fr') AS f FROM r GROUP BY "Task")
    SELECT "Task", round(b, 6) AS baseline, round(f, 6) AS final, round(f - b, 6) AS delta FROM a
    WHERE b IS NOT NULL AND f IS NOT NULL""",
)
def score_delta(spark, folder):
    means = records(spark, folder).groupBy("Task", "Model").agg(F.avg("Score").alias("Score"))
    rows = B.score_delta(means.where("Model = 'en'"), means.where("Model = 'fr'"), ["Task"])
    return rows.select("Task", *[F.round(c, 6).alias(c) for c in ("baseline", "final", "delta")])


def cell_sql(model: str) -> str:
    return f"coalesce(printf('%.2f', avg(\"Score\") FILTER (WHERE \"Model\" = '{model}')), 'nan')"


CELLS = " || ' | ' || ".join(cell_sql(m) for m in MODELS)
RULE = " | ".join(["---:"] * len(MODELS))


@query(
    "report",
    f"""WITH {RECORDS_SQL}
    SELECT 'Detailed Results' AS section, 2 + row_number() OVER (ORDER BY "Type", "Task") AS line_no,
        '| ' || "Type" || ' | ' || "Task" || ' | ' || {CELLS} || ' |' AS line FROM r GROUP BY "Type", "Task"
    UNION ALL SELECT 'Average Scores by Type', 2 + row_number() OVER (ORDER BY "Type"), '| ' || "Type" || ' | ' || {CELLS} || ' |'
        FROM r GROUP BY "Type"
    UNION ALL VALUES ('Detailed Results', 1, '| Type | Task | {" | ".join(MODELS)} |'),
        ('Detailed Results', 2, '| :--- | :--- | {RULE} |'),
        ('Average Scores by Type', 1, '| Type | {" | ".join(MODELS)} |'),
        ('Average Scores by Type', 2, '| :--- | {RULE} |')""",
)
def report(spark, folder):
    return B.report_lines(records(spark, folder), MODELS)


# One model's result files, one per task: the mean quality under a key that depends on the number of rows.
TASK_BODY = """'{"scores":{"test":[{"' || CASE n % 3 WHEN 0 THEN 'main_score' WHEN 1 THEN 'accuracy' ELSE 'ap' END || '":0.'
    || lpad(cast(permille AS varchar(9)), 5, '0') || '}]}}'"""


@query(
    "summary_report",
    f"""WITH {RECORDS_SQL}, t AS (SELECT "Task", "Type", count(*) AS n,
        CAST(floor(sum("Score") * 100 / count(*)) AS BIGINT) AS permille FROM r GROUP BY "Task", "Type"),
    s AS (SELECT "Task", "Type", CASE n % 3 WHEN 1 THEN 'Accuracy' ELSE 'N/A' END AS "Metric",
        CASE WHEN n % 3 < 2 THEN CAST('0.' || lpad(permille::VARCHAR, 5, '0') AS DOUBLE) * 100 ELSE 0.0 END AS "Score" FROM t)
    SELECT 'Evaluation Results' AS section, 2 + row_number() OVER (ORDER BY "Type", "Task", "Metric") AS line_no,
        '| ' || "Type" || ' | ' || "Task" || ' | ' || "Metric" || ' | ' || printf('%.2f', "Score") || ' |' AS line FROM s
    UNION ALL SELECT 'Averages by Type', 2 + row_number() OVER (ORDER BY "Type"),
        '| ' || "Type" || ' | ' || printf('%.2f', round(avg("Score"), 6)) || ' |' FROM s GROUP BY "Type"
    UNION ALL VALUES ('Evaluation Results', 1, '| Type | Task | Metric | Score |'),
        ('Evaluation Results', 2, '| :--- | :--- | :--- | ---: |'),
        ('Averages by Type', 1, '| Type | mean_score |'), ('Averages by Type', 2, '| :--- | ---: |')""",
)
def summary_report(spark, folder):
    total, n = F.sum("Score"), F.count(F.lit(1))
    tasks = records(spark, folder).groupBy("Task").agg(
        n.alias("n"), F.floor(total * 100 / n).alias("permille")
    )
    scored = scores.summary_score(tasks.withColumn("body", F.expr(TASK_BODY)), name="Score")
    return B.summary_lines(B.with_task_type(scored.withColumnRenamed("metric", "Metric")))


@query(
    "skip_finished",
    f"""WITH {RECORDS_SQL}, c AS (SELECT "Task", "Model" FROM (SELECT DISTINCT "Task" FROM r), (SELECT unnest(['de', 'en', 'es', 'fr', 'tr']) AS "Model"))
    SELECT "Task", "Model" FROM c WHERE ("Task", "Model") NOT IN (SELECT "Task", "Model" FROM r)""",
)
def skip_finished(spark, folder):
    done = records(spark, folder)
    models = F.explode(F.array(*[F.lit(m) for m in (*MODELS, "tr")])).alias("Model")
    return B.unfinished(done.select("Task").distinct().select("Task", models), done)


@query(
    "log_keys",
    f"""WITH {RECORDS_SQL}, t AS (SELECT "Task", "Model", avg("Score") AS s FROM r GROUP BY ALL),
    k AS (SELECT CASE "Model" WHEN 'en' THEN 'baseline' ELSE 'final' END AS p, "Task", s FROM t WHERE "Model" IN ('en', 'fr'))
    SELECT p || '/mteb/' || "Task" AS key, round(s, 6) AS value FROM k
    UNION ALL SELECT p || '/mteb/mean_score', round(avg(s), 6) FROM k GROUP BY p""",
)
def log_keys(spark, folder):
    means = records(spark, folder).groupBy("Task", "Model").agg(F.avg("Score").alias("Score"))
    before = B.log_keys(means.where("Model = 'en'"), "baseline")
    after = B.log_keys(means.where("Model = 'fr'"), "final")
    return before.unionByName(after).withColumn("value", F.round("value", 6))
