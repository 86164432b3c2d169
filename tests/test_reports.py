import json
import math

import pytest
from pyspark.sql import functions as F

from vecloom.functions import scores
from vecloom.operators import leaderboard as B
from vecloom.sources import results as R

# Recorded scores of two models (None: no result), and the recorded means.
DETAIL = {
    "BilTweetNews-Sentiment-Analysis": (35.87, 42.07),
    "Gender-Hate-Speech-TR": (43.05, 39.91),
    "News-Cat": (84.60, 88.76),
    "Pubmed-RCT-10K-TR": (46.45, 44.46),
    "Sci-Cite-TR": (47.49, 47.54),
    "Thesis-Abstract-Classification-11K": (None, 36.67),
    "Turkish-Product-Reviews": (62.63, 73.86),
    "Med-NLI-TR": (36.56, 36.16),
    "MultiNLI-TR": (36.33, 36.71),
    "SNLI-TR": (37.03, 38.52),
    "Apps-Retrieval-TR": (None, 6.07),
    "Code-Search-Net-21K-TR": (None, 73.67),
    "Cos-QA-TR": (2.16, 51.80),
    "Fiqa-TR": (4.30, 38.06),
    "MsMarco-TR": (8.17, 79.15),
    "NFCorpus-TR": (0.07, 1.16),
    "Quora-TR": (58.55, 73.52),
    "Scifact-TR": (11.12, 68.04),
    "Stackoverflow-QA-TR": (None, 75.52),
    "STSb-TR": (0.00, 0.00),
}
MODELS = ["model-a", "model.b"]
MEANS = {
    "Classification": (53.35, 53.32),
    "Classification (NLI)": (36.64, 37.13),
    "Retrieval": (14.06, 51.89),
    "STS": (0.00, 0.00),
}


@pytest.fixture(scope="module")
def records(spark):
    rows = [
        (task, model, score)
        for task, pair in DETAIL.items()
        for model, score in zip(("model-a", "model.b"), pair)
        if score is not None
    ]
    return B.with_task_type(spark.createDataFrame(rows, "Task string, Model string, Score double"))


def test_means_use_present_records_only(records):
    table = B.score_pivot(records, ["Type"], MODELS)
    for row in table.collect():
        assert (row["model-a"], row["model.b"]) == pytest.approx(MEANS[row["Type"]], abs=0.006)


def test_pivot_has_gaps(records):
    rows = {r["Task"]: r for r in B.score_pivot(records, ["Type", "Task"], MODELS).collect()}
    assert len(rows) == 20
    assert rows["Stackoverflow-QA-TR"]["model-a"] is None


def test_report_lines(records):
    rows = B.report_lines(records, MODELS).orderBy("section", "line_no").collect()
    shown = lambda x: "nan" if x is None else f"{x:.2f}"
    means = [f"| {kind} | {a:.2f} | {b:.2f} |" for kind, (a, b) in MEANS.items()]
    assert [r["line"] for r in rows if r["section"] == "Average Scores by Type"] == [
        "| Type | model-a | model.b |", "| :--- | ---: | ---: |", *means
    ]
    # DETAIL lists the tasks in the order of the published report: plain classification comes before NLI.
    types = {task: kind for kind, tasks in B.TASKS_BY_TYPE.items() for task in tasks}
    detail = [f"| {types[task]} | {task} | {shown(a)} | {shown(b)} |" for task, (a, b) in DETAIL.items()]
    assert [r["line"] for r in rows if r["section"] == "Detailed Results"] == [
        "| Type | Task | model-a | model.b |", "| :--- | :--- | ---: | ---: |", *detail
    ]
    assert [r["line_no"] for r in rows if r["section"] == "Detailed Results"] == list(range(1, 23))


def test_summary_lines(spark):
    rows = [("News-Cat", "Classification", "Accuracy", 90.625), ("X", "Other", "N/A", 0.0)]
    records = spark.createDataFrame(rows, "Task string, Type string, Metric string, Score double")
    lines = [r["line"] for r in B.summary_lines(records).orderBy("section", "line_no").collect()]
    assert "| Classification | News-Cat | Accuracy | 90.62 |" in lines
    assert "| Other | 0.00 |" in lines


def test_unfinished_tasks(spark):
    tasks = spark.createDataFrame([("a", "m"), ("b", "m")], "Task string, Model string")
    done = spark.createDataFrame([("a", "m", 1.0), ("a", "m", 2.0)], "Task string, Model string, Score double")
    assert [tuple(r) for r in B.unfinished(tasks, done).collect()] == [("b", "m")]


def test_unknown_task_is_other_and_average_is_over_records(spark):
    rows = spark.createDataFrame([("New", "m", 1.0), ("STSb-TR", "m", 3.0), ("STSb-TR", "n", 5.0)], "Task string, Model string, Score double")
    typed = B.with_task_type(rows)
    assert {(r["Type"], r["mean_score"]) for r in B.mean_by_type(typed).collect()} == {("Other", 1.0), ("STS", 4.0)}
    assert {tuple(r) for r in B.overall_mean(typed).collect()} == {("New", 1.0), ("STSb-TR", 4.0), ("AVERAGE", 3.0)}


def test_long_board_takes_any_number_of_models(spark):
    rows = spark.range(3_000).selectExpr("'STSb-TR' AS Task", "'STS' AS Type", "'m' || id AS Model", "id * 1.0D AS Score")
    assert B.mean_scores(rows, ["Type", "Task"]).count() == 3_000
    assert B.score_pivot(rows, ["Type"], ["m1", "m2"]).columns == ["Type", "m1", "m2"]


def test_missing_and_nan_scores_rank_last(spark):
    df = spark.createDataFrame([("a", None), ("b", float("nan")), ("c", 0.1)], "model string, spearman double")
    assert [r["model"] for r in B.ranked(df).orderBy("place").collect()] == ["c", "b", "a"]


def test_ranking_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c" * 60, 0.9)], "model string, spearman double")
    got = B.ranked(df).orderBy("place").collect()
    assert [r["shown"] for r in got] == ["c" * 48 + "..", "a", "b"]


def test_delta_needs_both_sides(spark):
    base = spark.createDataFrame([("t", 1.0), ("u", 2.0)], "Task string, Score double")
    final = spark.createDataFrame([("t", 1.5)], "Task string, Score double")
    assert [tuple(r) for r in B.score_delta(base, final, ["Task"]).collect()] == [("t", 1.0, 1.5, 0.5)]


def shape(test):
    return json.dumps({"scores": {"test": test}})


# body, compare, summary, metric, parse (None: left out), live
SHAPES = [
    (shape([{"main_score": 0.5, "accuracy": 0.25}]), 50, 50, "Accuracy", 0.5, 0.5),
    (shape([{"main_score": 0.5, "spearman": 0.25}]), 50, 50, "Spearman", 0.5, 0.5),
    (shape([{"main_score": 0.5, "ap": 0.25}]), 50, 50, "AP", 0.5, 0.5),
    (shape([{"main_score": 0.5}]), 50, 50, "N/A", 0.5, 0.5),
    (shape([{"ndcg_at_10": 0.5}]), 50, 50, "NDCG@10", 0, 0),
    (shape([{"cos_sim": {"spearman": 0.5}, "accuracy": 0.25}]), 25, 25, "Accuracy", 0.25, 0.5),
    (shape([{"cos_sim": {"spearman": 0.5}, "ap": 0.25}]), 50, 50, "Spearman", 0.5, 0.5),
    (shape([{"cos_sim": {"pearson": 0.5}, "ap": 0.25}]), 25, 0, "N/A", 0, 0),
    (shape([{"ap": 0.25}]), 25, 0, "N/A", 0, 0),
    (shape([{"map": 0.5, "spearman": 0.25}]), 0, 0, "N/A", 0.5, 0),
    (shape([{"spearman": 0.25}]), 0, 0, "N/A", 0.25, 0),
    (shape([{"accuracy": 0.5}, {"main_score": 0.75}]), 50, 50, "Accuracy", 0.5, 0.5),
    (shape([]), 0, 0, "N/A", 0, 0),
    (shape({}), 0, 0, "N/A", 0, 0),
    (shape({"z": {"accuracy": 0.5}, "a": {"accuracy": 0.25}}), 50, 50, "Accuracy", None, 0),
    (shape({"z": {"accuracy": 0.5}, "default": {"accuracy": 0.25}}), 25, 25, "Accuracy", None, 0),
    (json.dumps({"scores": {}}), 0, 0, "N/A", 0, 0),
    (json.dumps({"other": 1}), 0, 0, "N/A", 0, 0),
    ('{"scores": {"test": [', 0, 0, "N/A", None, 0),
]


def test_score_readers(spark):
    df = spark.createDataFrame([(i, s[0]) for i, s in enumerate(SHAPES)], "id int, body string")
    column = lambda rows, name="score": {r["id"]: r[name] for r in rows.collect()}
    summary = scores.summary_score(df)
    assert column(scores.compare_score(df)) == {i: s[1] for i, s in enumerate(SHAPES)}
    assert column(summary) == {i: s[2] for i, s in enumerate(SHAPES)}
    assert column(summary, "metric") == {i: s[3] for i, s in enumerate(SHAPES)}
    assert column(scores.parse_score(df)) == {i: s[4] for i, s in enumerate(SHAPES) if s[4] is not None}
    assert column(scores.live_score(df)) == {i: s[5] for i, s in enumerate(SHAPES)}


ENTRY = {
    "timestamp": "t", "dataset": "d",
    "results": [{"model": "m", "pearson": 0.1, "spearman": 0.2, "num_samples": 3, "split": "test", "processing_time_seconds": 1.5}],
}


@pytest.mark.parametrize(
    "text, n",
    [
        (json.dumps([ENTRY, ENTRY], indent=2), 2),
        (json.dumps(ENTRY, indent=2), 1),
        ("[]", 0),
        ('[{"timestamp": ', 0),
        ("", 0),
    ],
)
def test_log_files(spark, tmp_path, text, n):
    (tmp_path / "log.json").write_text(text)
    rows = R.read_log_files(spark, str(tmp_path)).collect()
    assert [(r["model"], r["spearman"], r["num_samples"]) for r in rows] == [("m", 0.2, 3)] * n


def test_log_append(spark, tmp_path):
    path = str(tmp_path / "log")
    assert R.read_log(spark, path).count() == 0
    rows = [("n", 0.1, None, 3, "test", 1.5), ("m", 0.3, 0.2, 3, "train", 1.5), ("m", 0.1, 0.2, 3, "test", 1.5)]
    run = spark.createDataFrame(rows, "model string, pearson double, spearman double, num_samples long, split string, processing_time_seconds double")
    R.append_log(run, path, "d")
    R.append_log(run.where("model = 'n'"), path, "e")
    torn = tmp_path / "log" / "entry-torn"  # a run that ended before its commit
    torn.mkdir()
    (torn / "part-x.json").write_text('{"timestamp": "t", "dataset": "d", "results": [{"model": "torn"}]}')
    entries = [json.loads(f.read_text()) for f in sorted((tmp_path / "log").glob("entry-*/part-*.json")) if f.parent != torn]
    assert sorted([(r["model"], r["split"]) for r in e["results"]] for e in entries) == [
        [("m", "test"), ("m", "train"), ("n", "test")], [("n", "test")],
    ]
    assert sorted((r.dataset, r.model, r.split) for r in R.read_log(spark, path).collect()) == [
        ("d", "m", "test"), ("d", "m", "train"), ("d", "n", "test"), ("e", "n", "test"),
    ]


def test_flat_folder_and_its_table(spark, tmp_path):
    files = {
        "model_meta.json": "{}",
        "TaskB.json": shape([{"main_score": 0.5}]),
        "x.json": json.dumps({"task_name": "TaskA", "scores": {"test": [{"map": 0.25}]}}),
        "TaskC.json": "broken",
        "TaskD.json": json.dumps({"scores": {}}),
        "notes.txt": "no",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    records = R.read_flat(spark, str(tmp_path))
    assert sorted(r.task for r in records.collect()) == ["TaskA", "TaskB", "TaskD"]
    table = R.task_table(scores.parse_score(records)).orderBy("line").collect()
    assert [tuple(r) for r in table] == [(1, "TaskA", 0.25), (2, "TaskB", 0.5), (3, "TaskD", 0.0), (4, "AVERAGE", 0.25)]
    assert R.task_table(scores.parse_score(records.where("false"))).count() == 0


def test_result_tree(spark, tmp_path):
    files = {
        "org__one/abcdef123/model_meta.json": "{}",
        "org__one/abcdef123/TaskA.json": shape([{"main_score": 0.5}]),
        "org__one/abcdef123/TaskB.json": "broken",
        "org__one/thin/TaskA.json": shape([{"main_score": 0.9}]),
        "two/0123456789/TaskA.json": shape([{"accuracy": 0.25}]),
        "two/0123456789/TaskC.json": shape({}),
        "two/0123456789/file.json": json.dumps({"task_name": "Named", "scores": {"test": [{"main_score": 0.75}]}}),
        "two/0123456789/notes.txt": "no",
    }
    for name, text in files.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    rows = scores.compare_score(R.read_tree(spark, str(tmp_path))).collect()
    assert {(r["model"], r["task"], r["score"]) for r in rows} == {
        ("org/one (abcdef)", "TaskA", 50.0), ("org/one (abcdef)", "TaskB", 0.0),
        ("two (012345)", "TaskA", 25.0), ("two (012345)", "TaskC", 0.0), ("two (012345)", "Named", 75.0),
    }
    assert not any(math.isnan(r["score"]) for r in rows)
