import numpy as np
import pytest
from pyspark.sql import functions as F

from vecloom.functions import vectors as X
from vecloom.operators import agreement as A
from vecloom.operators import models as M
from vecloom.operators import retrieval as R
from vecloom.operators import training_log as L


def vectors(spark, matrix, first=0):
    rows = [(first + i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, "id long, vector array<float>")


@pytest.fixture(scope="module")
def matrix():
    rng = np.random.default_rng(5)
    points = rng.normal(size=(120, 8)).astype("float32")
    points[40:60] = points[3]  # copies tie
    points[7] = 0
    return points


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(R, "BLOCK_BYTES", 8 * 8 * 25)
    monkeypatch.setattr(R, "MAX_CENTRES", 9)
    monkeypatch.setattr(R, "MIN_BLOCK_ROWS", 25)
    monkeypatch.setattr(R, "TILE_CELLS", 90)


def similarities(a, b):
    def unit(m):
        m = m.astype("float64")
        size = np.linalg.norm(m, axis=1, keepdims=True)
        return m / np.where(size == 0, 1, size)

    return np.round(unit(a) @ unit(b).T, R.DIGITS) + 0.0


def test_top_k_over_blocks_equals_all_pairs(spark, matrix, small_blocks):
    df = vectors(spark, matrix)
    assert R.Search(df).layout.blocks > 3
    got = {}
    for r in R.top_k(df, df, 5, skip_self=True).orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append(r["did"])
    sims = similarities(matrix, matrix)
    np.fill_diagonal(sims, -np.inf)
    want = {q: sorted(range(120), key=lambda d: (-sims[q, d], d))[:5] for q in range(120)}
    assert got == want


def test_top_k_of_fewer_documents_than_k(spark, matrix):
    got = R.top_k(vectors(spark, matrix[:4]), vectors(spark, matrix[:3], first=50), 10)
    assert got.groupBy("qid").count().where("count = 3").count() == 4


def test_relevant_ranks_count_copies_ahead(spark, matrix, small_blocks):
    queries, docs = vectors(spark, matrix[:60]), vectors(spark, matrix, first=1000)
    qrels = spark.range(60).select(F.col("id").alias("qid"), (F.col("id") + 1000).alias("did"))
    got = {r["qid"]: r["rank"] for r in R.relevant_ranks(queries, docs, qrels).collect()}
    sims = similarities(matrix[:60], matrix)
    want = {q: 1 + sorted(range(120), key=lambda d: (-sims[q, d], d)).index(q) for q in range(60)}
    assert got == want
    assert got[3] == 1 and got[41] == 3


def clustered(rng, groups, each, width):
    centres = rng.normal(size=(groups, width))
    return (np.repeat(centres, each, axis=0) + rng.normal(scale=0.1, size=(groups * each, width))).astype("float32")


def looked_at(search, asked):
    """Pairs of vectors that the search looks at."""
    n = search.cells.counts
    return sum(int(n[c]) // int(search.layout.splits[c]) for r in asked.select("cells").collect() for c in r.cells if c >= 0)


def test_clustered_vectors_look_at_few_pairs(spark):
    points = clustered(np.random.default_rng(8), 40, 50, 16)
    df = vectors(spark, points)
    search = R.Search(df)
    sims = similarities(points, points)
    np.fill_diagonal(sims, -np.inf)
    want = {q: sorted(range(2000), key=lambda d: (-sims[q, d], d))[:5] for q in range(0, 2000, 50)}
    got = {q: [] for q in want}
    for r in R.top_k(df.where("id % 50 = 0"), df, 5, skip_self=True).orderBy("qid", "rank").collect():
        got[r.qid].append(r.did)
    assert got == want
    floors = np.sort(sims, axis=1)[:, -5].tolist()
    parts = search.parts(df).join(spark.createDataFrame(list(enumerate(floors)), "id long, floor double"), "id")
    seen = looked_at(search, search.asked(parts, R._can_reach)) + looked_at(search, search.asked(parts, R._nearest(6)))
    assert seen < 0.3 * 2000 * 2000
    targets = [(q, 2000, float(sims[q][(q + 1) % 2000])) for q in range(2000)]
    parts = search.parts(df).join(spark.createDataFrame(targets, "id long, did long, target double"), "id")
    assert looked_at(search, search.asked(parts, R._undecided)) < 0.3 * 2000 * 2000
    search.close()


def test_bounds_hold_whatever_the_cells(spark, matrix):
    cells = R.Cells(R.unit(matrix[:5]), np.ones(6, int), np.zeros(6))
    cell, angle = cells.nearest(R.unit(matrix))
    cells.reach = np.array([angle[cell == c].max(initial=0) for c in range(6)])
    low, high = cells.bounds(R.unit(matrix))
    sims = similarities(matrix, matrix)
    assert (sims <= high[:, cell] + R.SLACK).all() and (sims >= low[:, cell] - R.SLACK).all()
    assert cell[7] == 5 and (sims[7] == 0).all()


def test_null_vectors_and_empty_tables(spark, matrix):
    df = vectors(spark, matrix[:6])
    holes = df.unionByName(spark.createDataFrame([(99, None)], df.schema))
    assert R.top_k(holes, holes, 2).where("qid = 99 OR did = 99").count() == 0
    assert R.top_k(df.where("false"), df, 2).count() == 0
    assert R.top_k(df, df.where("false"), 2).count() == 0
    qrels = spark.createDataFrame([(0, 1), (99, 1), (1, 77)], "qid long, did long")
    assert {(r.qid, r["rank"] is None) for r in R.relevant_ranks(holes, holes, qrels).collect()} == {(0, False), (99, True), (1, True)}
    assert {r.qid for r in R.first_ranks(df, df, qrels, 3).where("rank IS NULL").collect()} >= {1, 99}


def test_one_large_cell_is_split(spark, small_blocks):
    points = np.ones((300, 8), "float32")
    search = R.Search(vectors(spark, points))
    assert search.layout.splits.max() >= 10 and search.layout.blocks >= 10
    got = R.top_k(vectors(spark, points), vectors(spark, points), 3)
    assert {tuple(sorted(r.d)) for r in got.groupBy("qid").agg(F.collect_list("did").alias("d")).collect()} == {(0, 1, 2)}


def test_ranking_scores(spark):
    ranks = spark.createDataFrame([(1, 1, 1), (2, 2, 3), (3, 3, 11)], "qid long, did long, rank long")
    r = R.ranking_scores(ranks).first()
    assert r["ndcg_at_10"] == pytest.approx((1 + 0.5 + 0) / 3)
    assert r["map"] == pytest.approx((1 + 1 / 3 + 1 / 11) / 3)
    assert r["accuracy_at_1"] == pytest.approx(1 / 3)


def test_similarity_profile(spark, matrix, small_blocks):
    got = {r["id"]: r for r in R.similarity_profile(vectors(spark, matrix)).collect()}
    sims = similarities(matrix, matrix)
    for i in (0, 3, 7, 50, 119):
        others = np.delete(sims[i], i)
        assert got[i]["nearest"] == pytest.approx(others.max())
        assert got[i]["farthest"] == pytest.approx(others.min())
        assert got[i]["mean_similarity"] == pytest.approx(others.mean())


def test_profile_of_one_vector_has_no_others(spark):
    r = R.similarity_profile(vectors(spark, np.array([[1.0, 0.0]]))).first()
    assert (r["self_similarity"], r["mean_similarity"]) == (1.0, None)


def test_vector_expressions(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    rows = df.select(X.cosine(F.col("a"), F.col("b")).alias("c"), X.squared_error(F.col("a"), F.col("b")).alias("e")).collect()
    assert [(r["c"], r["e"]) for r in rows] == [(pytest.approx(0.96), 2.0), (0.0, 1.0)]
    assert [r["a"] for r in X.l2_normalise(df, "a").collect()] == [[pytest.approx(0.6), pytest.approx(0.8)], [0.0, 0.0]]


def test_next_turn_pairs_need_the_answer_right_after(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (1, 3, "user", "c"), (2, 0, "assistant", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert [tuple(r) for r in A.next_turn_pairs(df).collect()] == [(1, 1, "a", "b")]


@pytest.mark.parametrize(
    "rows, want",
    [
        ([("a", 0), ("a", 0), ("b", 1)], (1.0, 1.0, 1.0)),
        ([("a", 0), ("a", 0)], (1.0, 1.0, 1.0)),
        ([("a", 0), ("b", 0)], (0.0, 1.0, 0.0)),
        ([("a", 0), ("a", 1), ("b", 0), ("b", 1)], (0.0, 0.0, 0.0)),
    ],
)
def test_v_measure(spark, rows, want):
    r = A.v_measure(spark.createDataFrame(rows, "label string, cluster int"), "label", "cluster").first()
    assert tuple(r) == pytest.approx(want, abs=1e-12)


def test_models_on_separate_groups(spark):
    rng = np.random.default_rng(0)
    labels = np.arange(90) % 3
    points = np.eye(3)[labels] * 10 + rng.normal(scale=0.1, size=(90, 3))
    rows = [([float(x) for x in p], int(label)) for p, label in zip(points, labels)]
    df = spark.createDataFrame(rows, "embedding array<float>, label int")
    assert M.linear_probe(df.limit(60), df).first()["accuracy"] == 1.0
    assert M.cluster_score(df, 3).first()["v_measure"] == pytest.approx(1.0)


def fired(n, batch, every):
    """The loop itself: counts at which a checkpoint is written, then the final one."""
    marks, done, last = [], 0, 0
    while done < n:
        done = min(done + batch, n)
        if done >= last + every:
            marks.append(done)
            last = done
    return [(i + 1, m, False) for i, m in enumerate(marks)] + [(len(marks) + 1, n, True)]


@pytest.mark.parametrize("n, batch, every", [(25_000, 256, 10_000), (30, 16, 40), (100, 16, 40), (96, 16, 40), (91, 16, 43), (44, 16, 44), (40, 16, 40)])
def test_checkpoint_marks(spark, n, batch, every):
    counts = spark.createDataFrame([(n,)], "n_rows long")
    got = L.checkpoint_marks(counts, batch, every).select("mark_no", "at_rows", "is_final").collect()
    assert sorted(map(tuple, got)) == fired(n, batch, every)


def test_training_log(spark):
    log = spark.createDataFrame([(1, s, float(s % 7)) for s in range(1, 61)], "epoch int, step int, loss double")
    got = {r["step"]: r["avg_loss"] for r in L.running_mean(log, 20).collect()}
    assert got == {n: pytest.approx(np.mean([s % 7 for s in range(1, n + 1)])) for n in (20, 40, 60)}
    epochs = spark.createDataFrame([(1, 3.0), (2, 3.0), (3, 2.0), (4, 2.5)], "epoch int, epoch_loss double")
    assert [r["is_best"] for r in L.best_so_far(epochs).orderBy("epoch").collect()] == [True, False, True, False]
    steps = spark.createDataFrame([(0,), (5,), (5,), (7,), (10,)], "step int")
    assert sorted(r[0] for r in L.every_n_steps(steps, 5).collect()) == [5, 10]
    assert sorted(r[0] for r in L.every_n_steps(steps, 5, skip_zero=False).collect()) == [0, 5, 10]


def test_query_without_its_document_counts_as_zero(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id long, vector array<float>")
    qrels = spark.createDataFrame([(1, 1), (2, 99)], "qid long, did long")
    ranks = R.relevant_ranks(vectors, vectors, qrels)
    assert {(r["qid"], r["rank"]) for r in ranks.collect()} == {(1, 1), (2, None)}
    row = R.ranking_scores(ranks).first()
    assert (row["ndcg_at_10"], row["map"], row["accuracy_at_1"], row["num_queries"]) == (0.5, 0.5, 0.5, 2)


def test_streams_go_on_from_their_state(spark, tmp_path):
    from vecloom.streaming import checkpoints, progress

    rng = np.random.default_rng(4)
    rows = [("ab"[i % 2], i, float(x)) for i, x in enumerate(rng.normal(size=60))]
    log = spark.createDataFrame(rows, "run string, step long, loss double")
    source, target = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        stream = checkpoints.file_stream(spark, source, log.schema, "*.parquet", files_per_batch=1)
        for name, work in (("means", progress.running_mean(stream, 5)), ("steps", progress.every_n_steps(stream, 5))):
            checkpoints.append_checkpointed(work, f"{target}/{name}", f"{target}-{name}").awaitTermination()
        means = checkpoints.read_checkpointed(spark, f"{target}/means", progress.running_mean(stream, 5).schema).collect()
        steps = checkpoints.read_checkpointed(spark, f"{target}/steps", spark.range(1).withColumnRenamed("id", "step").schema).collect()
        return {(r.run, r.step): r.avg_loss for r in means}, sorted(r.step for r in steps)

    def want(n):
        means = {(r, s): np.mean([x for q, t, x in rows[: s + 1] if q == r]) for r, s, _ in rows[:n] if s % 5 == 0}
        return {k: pytest.approx(v) for k, v in means.items()}, [s for s in range(5, n, 5)]

    log.where("step < 20").coalesce(1).write.parquet(source)
    log.where("step >= 20 AND step < 30").coalesce(1).write.mode("append").parquet(source)
    assert run() == want(30)
    log.where("step >= 30 OR step = 25").where("step <> 25 OR run = 'x'").coalesce(1).write.mode("append").parquet(source)
    assert run() == want(60)
    assert run() == want(60)


def test_queries_of_a_part_go_through_in_slices(spark, monkeypatch):
    """What a task holds of queries and the cells they ask for has a bound, whatever the size of a part."""
    import numpy as np
    import pandas as pd
    from vecloom.operators import retrieval

    monkeypatch.setattr(retrieval, "ASKED_CELLS", 400, raising=False)
    rng = np.random.default_rng(5)
    vectors = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(300)], "id long, vector array<double>")
    search = retrieval.Search(vectors)

    def all_cells(cells, rows, batch, slack):
        return np.ones((len(rows), len(cells.counts)), bool), np.zeros(len(rows), int)

    def sizes(frame, look):
        return pd.DataFrame({"rows": [len(frame)], "seen": [sum(len(some) * len(ids) for some, ids, _ in look())]})

    found = search.meet(search.parts(vectors), all_cells, sizes, "rows long, seen long").collect()
    assert sum(r.rows for r in found) == 300 * search.layout.blocks and sum(r.seen for r in found) == 300 * 300
    assert max(r.rows for r in found) * len(search.cells.centres) <= 400
