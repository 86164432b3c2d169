import hashlib

import pytest
from pyspark.sql import functions as F

from vecloom.functions.text import pair_prompt, shorten, unit_score
from vecloom.operators import curation as K
from vecloom.operators import ordered as O


def test_registry_and_presets(spark):
    assert K.registry_table(spark).count() == 38
    assert [len(K.requested_names(preset=p)) for p in ("default", "all", "quick", "retrieval", "what")] == [19, 38, 5, 10, 19]
    assert K.requested_names(["one"], "quick") == ["one"]


def test_unknown_names_select_nothing(spark):
    df = spark.createDataFrame([("stsb_tr",), ("other",), ("tquad",)], "name_of string")
    got = K.select_registered(df, "name_of", ["stsb_tr", "other"])
    assert [r[0] for r in got.collect()] == ["stsb_tr"]


def test_lenient_and_strict_filter(spark):
    df = spark.createDataFrame([(1, "x", "y"), (2, None, "y"), (3, "", "y"), (4, "x", None)], "id int, a string, b string")
    assert [r["id"] for r in K.drop_null_text(df, ["a", "missing"]).collect()] == [1, 3, 4]
    assert [r["id"] for r in K.keep_truthy(df, ["a", "b"]).collect()] == [1]
    assert K.keep_truthy(df, ["a", "missing"]) is None
    assert K.curate(df, "id", "a", ["missing"]).count() == 0


def test_last_alias_wins():
    assert K.resolve_aliases(["sentence1", "anchor", "text2", "label", "score", "x"]) == {
        "sentence1": "anchor", "sentence2": "text2", "score": "score",
    }


def test_requested_tasks(spark):
    df = spark.createDataFrame([("org/a",), ("org/b",), ("c",)], "name string")
    keep = lambda asked: [r[0] for r in df.where(K.requested_task(F.col("name"), asked)).collect()]
    assert keep("a,c") == ["org/a", "c"]
    assert keep("org/b") == ["org/b"]
    assert keep(None) == keep("") == ["org/a", "org/b", "c"]


@pytest.mark.parametrize("override, configured, want", [(None, 5, 5), (9, 5, 9), (0, 5, 5), (None, 0, None), (0, None, None)])
def test_effective_cap(spark, override, configured, want):
    df = spark.createDataFrame([(configured,)], "c long")
    assert df.select(K.effective_cap(override, F.col("c"))).first()[0] == want


def sampled(rows, cap, seed=42):
    """One group by hand: shuffled and cut if over the cap, else in key order."""
    if cap is None or len(rows) <= cap:
        return {k: i + 1 for i, k in enumerate(sorted(rows))}
    shuffled = sorted(rows, key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), k))
    return {k: i + 1 for i, k in enumerate(shuffled[:cap])}


@pytest.mark.parametrize("margin", [6.0, -20.0])
def test_capped_sample_with_a_hot_group(spark, monkeypatch, margin):
    # A margin that is too narrow must not change the result.
    monkeypatch.setattr(K, "SAMPLE_MARGIN", margin)
    groups = {"hot": range(0, 4000), "exact": range(5000, 5100), "over": range(6000, 6101), "free": range(7000, 7400)}
    caps = {"hot": 1500, "exact": 100, "over": 100, "free": None}
    df = spark.createDataFrame([(k, g) for g, keys in groups.items() for k in keys], "id long, g string")
    table = spark.createDataFrame(list(caps.items()), "g string, max_samples long")
    got = {}
    for r in K.capped_sample(df, "id", "g", table).collect():
        got.setdefault(r["g"], {})[r["id"]] = r["position"]
    assert got == {g: sampled(list(keys), caps[g]) for g, keys in groups.items()}


def test_shuffle_always_keeps_all_of_a_small_set(spark):
    df = spark.range(30)
    out = K.capped_sample(df, "id", None, override=1000, shuffle_always=True).orderBy("position").collect()
    want = sorted(range(30), key=lambda k: hashlib.md5(f"42:{k}".encode()).hexdigest())
    assert [r["id"] for r in out] == want


def test_batches_cover_every_row(spark):
    df = spark.range(103).withColumnRenamed("id", "k")
    got = K.with_batches(df, ["k"], 10).groupBy("batch_no").count().orderBy("batch_no").collect()
    assert [r["count"] for r in got] == [10] * 10 + [3]


def test_step_plan_counts_whole_batches_and_real_steps(spark):
    df = spark.range(100).select(F.lit("s").alias("source"))
    r = K.step_plan(df, "source", batch=16, epochs=3, warmup_ratio=0.1).first()
    assert (r["total_steps"], r["warmup_steps"], r["actual_steps"]) == (18, 1, 21)


def test_null_is_a_label(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "label int")
    assert K.label_cardinality(df, "label").first()[0] == 3
    assert K.label_cardinality(df.na.drop(), "label").first()[0] == 2
    assert K.label_cardinality(df, "missing").first()[0] == 3


def test_loss_plan(spark):
    rows = [("stsb_tr", 1), ("thy_sa", 1), ("thy_sa", None), ("tquad", 1), ("who", 1)]
    df = spark.createDataFrame(rows, "dataset string, label int")
    got = {r["name"]: (r["loss"], r["num_labels"]) for r in K.loss_plan(df, "dataset", "label").collect()}
    assert got == {
        "stsb_tr": ("CoSENTLoss", None), "thy_sa": ("SoftmaxLoss", 2), "tquad": ("MultipleNegativesRankingLoss", None),
    }


def test_retrieval_ids_keep_the_gap(spark):
    rows = [(0, "q", "d"), (1, "", "d"), (2, "q", None), (3, "q", "d")]
    df = spark.createDataFrame(rows, "k long, q string, d string")
    queries, corpus, qrels = K.retrieval_task(df, ["k"], "q", "d")
    assert sorted(r["qid"] for r in queries.collect()) == ["q0", "q3"]
    assert sorted((r["did"], r["title"]) for r in corpus.collect()) == [("d0", ""), ("d3", "")]
    assert sorted(map(tuple, qrels.collect())) == [("q0", "d0", 1), ("q3", "d3", 1)]


def test_text_expressions(spark):
    df = spark.createDataFrame([("a", None, "4.2", "n" * 50), ("b", "c", "5", "n" * 51)], "a string, b string, s string, n string")
    rows = df.select(pair_prompt(F.col("a"), F.col("b")), unit_score(F.col("s")), shorten(F.col("n"))).collect()
    assert tuple(rows[0]) == ("Premise: a Hypothesis: None", pytest.approx(0.84), "n" * 50)
    assert tuple(rows[1]) == ("Premise: b Hypothesis: c", 1.0, "n" * 48 + "..")


def test_curated_rows_are_whole(spark):
    rows = [(i, "hot" if i % 3 else "cold", "" if i % 10 == 0 else f"t{i}") for i in range(600)]
    df = spark.createDataFrame(rows, "id long, g string, text string")
    caps = spark.createDataFrame([("hot", 50), ("cold", 1000)], "g string, max_samples long")
    got = K.curate(df, "id", "g", ["text"], caps).collect()
    full = {g: [i for i, name, text in rows if name == g and text] for g in ("hot", "cold")}
    want = {"hot": sampled(full["hot"], 50), "cold": sampled(full["cold"], 1000)}
    assert {g: {r["id"]: r["position"] for r in got if r["g"] == g} for g in want} == want
    assert all(r["text"] == f"t{r['id']}" for r in got)


def test_rows_without_a_group_are_kept(spark):
    df = spark.createDataFrame([(i, None if i < 30 else "a") for i in range(60)], "id long, g string")
    assert K.capped_sample(df, "id", "g", override=10).groupBy("g").count().where("count = 10").count() == 2
    assert K.capped_sample(df, "id", "g").count() == 60
    assert O.first_n(df, [F.col("id")], "g", 7).count() == 14
    assert O.numbered(df, ["id"], ["g"]).groupBy("g").agg(F.max("rn")).where("`max(rn)` = 30").count() == 2


def test_no_group_is_lost_under_a_small_cap(spark):
    # No digest of these ids lies below the bound that cap 1 of 1,000 gives.
    keys = list(range(2_274_000, 2_275_000))
    df = spark.range(keys[0], keys[-1] + 1)
    assert [r["id"] for r in K.capped_sample(df, "id", None, override=1).collect()] == list(sampled(keys, 1))
    grouped = df.selectExpr("id", "'g' AS g").unionByName(spark.range(500).selectExpr("id", "cast(NULL AS string) AS g"))
    got = {r["g"]: r["id"] for r in K.capped_sample(grouped, "id", "g", override=1).collect()}
    assert got == {"g": next(iter(sampled(keys, 1))), None: next(iter(sampled(list(range(500)), 1)))}


def test_curating_sets_with_equal_ids(spark):
    df = spark.range(20).selectExpr("id", "explode(array('a', 'b', NULL)) AS g").withColumn("text", F.concat(F.coalesce("g", F.lit("-")), F.col("id")))
    got = K.curate(df, "id", "g", ["text"]).collect()
    assert len(got) == 60 and {r["text"] for r in got} == {f"{g or '-'}{k}" for g in ("a", "b", None) for k in range(20)}
    capped = K.curate(df, "id", "g", ["text"], override=5).collect()
    best = list(sampled(list(range(20)), 5))
    assert sorted((r["g"] or "-", r["position"], r["id"]) for r in capped) == sorted((g, i + 1, k) for g in ("a", "b", "-") for i, k in enumerate(best))
