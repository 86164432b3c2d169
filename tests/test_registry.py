import pytest
from vecloom.operators import registry as R

CONFIGS = [
    R.SetConfig("pairs", "ret"),
    R.SetConfig("late", "cls", ("text",), "label", "test", 2),
    R.SetConfig("nli", "nli", ("premise", "hypothesis"), "label"),
    R.SetConfig("lacking", "sts", ("sentence1", "sentence2"), "score"),
]
SCHEMA = "id long, dataset string, split string, anchor string, positive string, text string, label int, premise string, hypothesis string"


@pytest.fixture(scope="module")
def rows(spark):
    data = [
        (1, "pairs", "train", "a", "b", None, None, None, None),
        (2, "pairs", "train", None, "b", None, None, None, None),
        (3, "pairs", "test", "a", "b", None, None, None, None),
        (4, "pairs", "train", "", "b", None, None, None, None),
        *[(10 + i, "late", "test", None, None, f"t{i}", i % 2, None, None) for i in range(5)],
        (20, "late", "train", None, None, "t", 1, None, None),
        (21, "late", "test", None, None, "t", None, None, None),
        (30, "nli", "train", None, None, None, 2, "p", "h"),
        (40, "lacking", "train", "a", "b", "t", 1, "p", "h"),
        (50, "unknown", "train", "a", "b", "t", 1, "p", "h"),
        (60, None, "train", "a", "b", "t", 1, "p", "h"),
    ]
    return R.configured_rows(spark.createDataFrame(data, SCHEMA), CONFIGS, "id")


def test_split_columns_and_label_follow_the_configuration(rows):
    found = {r.id: (r.dataset, r.task, r["first"], r.second, r.label) for r in rows.collect()}
    late = {10 + i: ("late", "cls", f"t{i}", None, str(i % 2)) for i in range(5)}
    assert found == late | {1: ("pairs", "ret", "a", "b", None), 4: ("pairs", "ret", "", "b", None), 30: ("nli", "nli", "p", "h", "2")}


def test_prompts_caps_and_labels(rows):
    inputs = {r.id: (r.text, r.other) for r in R.model_inputs(rows).collect()}
    assert inputs[30] == ("Premise: p Hypothesis: h", None) and inputs[1] == ("a", "b")
    sample = R.sampled_rows(rows, CONFIGS, "id").groupBy("dataset").count().collect()
    assert {r.dataset: r["count"] for r in sample} == {"pairs": 2, "late": 2, "nli": 1}
    assert {(r.dataset, r.n_rows, r.num_labels) for r in R.label_counts(rows).collect()} == {("late", 5, 2), ("nli", 1, 1)}


def test_a_set_is_configured_once(spark):
    with pytest.raises(ValueError):
        R.config_table(spark, [CONFIGS[0], CONFIGS[0]])
    assert len({c.name for c in R.CONFIGURED}) == 16
