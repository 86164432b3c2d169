"""Orders over a whole table, against pandas, with one key that holds most rows."""

from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vecloom.operators import ordered as O
from vecloom.operators.agreement import average_precision, average_ranks, pearson, spearman


def table(n=3000, seed=0):
    rng = np.random.default_rng(seed)
    keys = np.where(rng.random(n) < 0.6, "hot", rng.choice(["a", "b", "c"], n))
    return pd.DataFrame({"g": keys, "k": rng.permutation(n) * 7, "v": rng.integers(0, 50, n).astype(float)})


@pytest.fixture(scope="module")
def rows():
    return table()


def result(df, columns):
    return df.select(*columns).toPandas().sort_values(columns, ignore_index=True)


def test_hot_group_is_spread_over_cells(spark, rows):
    df = spark.createDataFrame(rows)
    cells = O.with_cells(df, [F.col("k")]).groupBy("g", O.CELL).count().toPandas()
    assert cells["count"].max() < len(rows) / 4  # of 8 cells


def test_numbered_per_group(spark, rows):
    got = result(O.numbered(spark.createDataFrame(rows), [F.col("k")], ["g"]), ["g", "k", "rn"])
    want = rows.assign(rn=rows.groupby("g")["k"].rank().astype("int64"))[["g", "k", "rn"]]
    pd.testing.assert_frame_equal(got, want.sort_values(["g", "k", "rn"], ignore_index=True))


@pytest.mark.parametrize("kind", ["string", "timestamp", "double", "decimal(20,3)", "date"])
def test_numbered_by_any_type(spark, kind):
    values = {
        "string": [f"https:{k:04d}" for k in range(500)],
        "timestamp": [d.to_pydatetime() for d in pd.date_range("1969-12-01", periods=500, freq="h")],
        "double": [*np.linspace(-50, 50, 499).tolist(), float("nan")],
        "decimal(20,3)": [Decimal(k) - 250 for k in range(500)],
        "date": [d.date() for d in pd.date_range("1969-12-01", periods=500)],
    }[kind]
    mixed = [values[k] for k in np.random.default_rng(1).permutation(500)]
    df = spark.createDataFrame([(v,) for v in mixed], f"k {kind}")
    got = O.numbered(df, [F.col("k")]).orderBy("rn").collect()
    assert [r["rn"] for r in got] == list(range(1, 501))
    assert all(r["k"] == v or v != v for r, v in zip(got, values))


def test_numbered_by_two_columns_with_negative_and_missing_values(spark):
    rows = [(a, b) for a in (None, -3, 1, 2) for b in (None, -5, -4, 0, 7)]
    df = spark.createDataFrame([rows[k] for k in np.random.default_rng(2).permutation(len(rows))], "a long, b long")
    got = O.numbered(df, [F.col("a"), F.col("b")]).orderBy("rn").collect()
    assert [(r["a"], r["b"]) for r in got] == rows
    down = O.numbered(df.na.drop(), [-F.col("a"), F.col("b")]).orderBy("rn").collect()
    assert [(r["a"], r["b"]) for r in down] == sorted((r for r in rows if None not in r), key=lambda r: (-r[0], r[1]))


def test_tokens_that_share_count_and_beginning_are_spread(spark):
    df = spark.range(100_000).selectExpr("format_string('https:%06d', id) AS token", "1L AS n")
    assert O.with_cells(df, [-F.col("n"), F.col("token")]).groupBy(O.CELL).count().agg(F.max("count")).first()[0] < 25_000
    got = O.numbered(df, [-F.col("n"), F.col("token")]).where("rn != cast(substr(token, 7) AS long) + 1")
    assert got.count() == 0


def test_first_n_with_one_limit_and_with_a_table(spark, rows):
    df = spark.createDataFrame(rows)
    limits = spark.createDataFrame([("hot", 700), ("a", 100_000), ("zz", 5)], "g string, row_limit long")
    ranked = rows.assign(rn=rows.groupby("g")["k"].rank().astype("int64"))

    got = result(O.first_n(df, [F.col("k")], "g", 40), ["g", "k", "rn"])
    want = ranked[ranked.rn <= 40][["g", "k", "rn"]].sort_values(["g", "k", "rn"], ignore_index=True)
    pd.testing.assert_frame_equal(got, want)

    out = O.first_n(df, [F.col("k")], "g", limits).toPandas()
    sizes = rows.g.value_counts()
    assert out.g.value_counts().to_dict() == {"hot": 700, "a": sizes["a"]}
    assert out.groupby("g")["available"].max().to_dict() == {"hot": 700, "a": sizes["a"]}


def test_first_n_of_strings_and_missing_keys(spark):
    rows = [("a", f"k{i:03d}") for i in range(30)] + [("a", None), ("b", "x"), (None, "y"), (None, "z")]
    df = spark.createDataFrame(rows, "g string, k string")
    got = O.first_n(df, [F.col("k")], "g", 3).collect()
    assert {(r["g"], r["k"], r["rn"]) for r in got} == {
        ("a", None, 1), ("a", "k000", 2), ("a", "k001", 3), ("b", "x", 1), (None, "y", 1), (None, "z", 2)
    }
    assert {(r["g"], r["available"]) for r in got} == {("a", 3), ("b", 1), (None, 2)}
    assert [r["k"] for r in O.first_n(df.where("k IS NOT NULL"), [F.col("k")], None, 2).orderBy("rn").collect()] == ["k000", "k001"]


def test_bound_of_first_n_reaches_the_scan(spark, tmp_path):
    spark.range(1_000).selectExpr("id AS k", "'g' AS g").write.parquet(str(tmp_path / "t"))
    out = O.first_n(spark.read.parquet(str(tmp_path / "t")), [F.col("k")], "g", 5)
    assert [r["k"] for r in out.orderBy("rn").collect()] == list(range(5))


def test_running_sum_and_min(spark, rows):
    cells = O.with_cells(spark.createDataFrame(rows), [F.col("k")])
    got = O.running(cells, [F.col("k")], {"s": ("sum", F.col("v")), "m": ("min", F.col("v"))}, ["g"])
    got = result(got, ["g", "k", "s", "m"])
    want = rows.sort_values(["g", "k"])
    assert np.allclose(got["s"], want.groupby("g")["v"].cumsum())
    assert np.allclose(got["m"], want.groupby("g")["v"].cummin())


def test_exclusive_running_min_starts_empty(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 3.0), (3, 3.0), (4, 1.0)], "k int, v double")
    got = O.running(O.with_cells(df, [F.col("k")]), [F.col("k")], {"m": ("min", F.col("v"))}, exclusive=True)
    assert [r["m"] for r in got.orderBy("k").collect()] == [None, 5.0, 3.0, 3.0]


def test_empty_table(spark):
    df = spark.createDataFrame([], "g string, k long, v double")
    assert O.numbered(df, [F.col("k")], ["g"]).count() == 0
    assert O.first_n(df, [F.col("k")], "g", 3).count() == 0


def test_average_ranks_share_ties(spark, rows):
    got = result(average_ranks(spark.createDataFrame(rows), "v", ["g"]), ["g", "v", "rank"])
    want = rows.assign(rank=rows.groupby("g")["v"].rank())[["g", "v", "rank"]].drop_duplicates()
    pd.testing.assert_frame_equal(got, want.sort_values(["g", "v", "rank"], ignore_index=True))


def test_spearman_skips_rows_with_a_gap(spark, rows):
    data = rows.assign(w=rows["v"] * 2 + rows["k"] % 11)
    data.loc[::17, "w"] = np.nan
    schema = "g string, k long, v double, w double"
    df = spark.createDataFrame(data, schema).withColumn("w", F.when(~F.isnan("w"), F.col("w")))
    got = spearman(df, "v", "w").first()[0]
    whole = data.dropna()
    assert got == pytest.approx(np.corrcoef(whole["v"].rank(), whole["w"].rank())[0, 1], abs=1e-9)


def test_average_precision_takes_ties_as_one_threshold(spark):
    df = spark.createDataFrame(
        [(0.9, True), (0.8, False), (0.8, True), (0.1, False), (0.1, True)], "s double, p boolean"
    )
    # Thresholds 0.9, 0.8, 0.1 gain 1, 1, 1 of 3 positives at precision 1/1, 2/3, 3/5.
    assert average_precision(df, "s", "p").first()[0] == pytest.approx((1 + 2 / 3 + 3 / 5) / 3)


def test_correlations_treat_gaps_alike_and_pass_nan_on(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (nan, 0.0)], "x double, y double")
    assert np.isnan(spearman(df, "x", "y").first()[0]) and np.isnan(pearson(df, "x", "y").first()["pearson"])
    gaps = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (4.0, 2.0), (None, 9.0), (5.0, None)], "x double, y double")
    assert spearman(gaps, "x", "y").first()[0] == pytest.approx(0.5)
    assert pearson(gaps, "x", "y").first()["num_samples"] == 3
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "x double, y double")
    assert spearman(flat, "x", "y").first()[0] is None


def test_first_n_after_a_limit_that_no_group_has(spark, rows):
    limits = spark.createDataFrame([("nobody", 3)], "g string, row_limit long")
    assert O.first_n(spark.createDataFrame(rows), [F.col("k")], "g", limits).count() == 0
