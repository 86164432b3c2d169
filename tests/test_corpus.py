import random

import pytest
from pyspark.sql import functions as F

from vecloom.operators import corpus as C
from vecloom.sources import tables as S
from vecloom.sources.lazy import breaking_off, parquet_groups, read_groups


def docs(spark, sizes):
    rows = [(lang, i, f"t{i}") for lang, n in sizes.items() for i in range(n)]
    random.Random(3).shuffle(rows)
    rows = [(place, *row) for place, row in enumerate(rows)]
    return spark.createDataFrame(rows, "doc_id long, lang string, i long, text string")


def expected_sizes(have, train, val, test):
    want = train + val + test
    if have >= want:
        return train, val, test
    share = have / want
    a, b = int(train * share), int(val * share)
    return a, b, have - a - b


@pytest.mark.parametrize("have", [1, 7, 13, 14, 301])
def test_short_language_is_scaled_in_floating_point(spark, have):
    quotas = [("xx", 10_000, 3_000, 1_000)]
    rows = C.split_rows(C.quota_rows(docs(spark, {"xx": have}), "doc_id", quotas))
    got = {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}
    want = dict(zip(("train", "validation", "test"), expected_sizes(have, *quotas[0][1:])))
    assert got == {k: v for k, v in want.items() if v}


def test_splits_are_contiguous_disjoint_and_fill_the_quota(spark):
    quotas = [("a", 50, 20, 10), ("b", 50, 20, 10), ("none", 1, 1, 1)]
    rows = C.split_rows(C.quota_rows(docs(spark, {"a": 900, "b": 40, "c": 30}), "doc_id", quotas)).toPandas()
    assert rows.doc_id.is_unique
    assert rows.groupby("lang").size().to_dict() == {"a": 80, "b": 40}
    assert rows[rows.lang == "a"].groupby("split").size().to_dict() == {"train": 50, "validation": 20, "test": 10}
    for _, part in rows.groupby("lang"):
        ends = part.groupby("split")["doc_id"].agg(["min", "max"])
        assert ends.loc["train", "max"] < ends.loc["validation", "min"] < ends.loc["test", "min"]


def test_failed_language_is_kept_up_to_the_record_or_dropped(spark):
    source = docs(spark, {"a": 20, "b": 20, "c": 20})
    quotas = [("a", 5, 2, 1), ("b", 5, 2, 1), ("c", 5, 2, 1)]
    record = spark.createDataFrame([("b", 4), ("b", 6), ("c", 0)], "lang string, n_read long")

    def sizes(on_error):
        rows = C.split_rows(C.quota_rows(source, "doc_id", quotas, record, on_error))
        return {(r["lang"], r["split"]): r["count"] for r in rows.groupBy("lang", "split").count().collect()}

    whole = {("a", "train"): 5, ("a", "validation"): 2, ("a", "test"): 1}
    assert sizes("keep") == whole | {("b", "train"): 2, ("b", "validation"): 1, ("b", "test"): 1}
    assert sizes("drop") == whole


def test_lazy_source_stops_at_its_limit_and_records_failures(spark, tmp_path):
    marks = str(tmp_path)

    def open_group(group):
        if group == "none":
            raise FileNotFoundError("no such group")
        for i in range(1_000):
            with open(f"{marks}/{group}", "a") as f:
                f.write(".")
            if group == "bad" and i == 7:
                raise ValueError("torn")
            yield (f"{group}{i}", None)

    limits = {"good": 5, "bad": 20, "none": 5, "zero": 0, "last": 1_000}
    rows, record = read_groups(spark, "marked", {"title": "string", "size": "long"}, open_group, limits)
    assert {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()} == {"good": 5, "bad": 7, "last": 1_000}
    assert [r.title for r in rows.where("lang = 'good'").orderBy("place").collect()] == [f"good{i}" for i in range(5)]
    found = {r["lang"]: (r.n_read, r.error) for r in record.collect()}
    assert found == {"bad": (7, "ValueError: torn"), "none": (0, "FileNotFoundError: no such group")}
    assert len((tmp_path / "good").read_text()) == 5 and len((tmp_path / "bad").read_text()) == 8
    quotas = [("good", 3, 1, 1), ("bad", 10, 6, 4), ("none", 3, 1, 1)]
    kept = C.split_rows(C.collected_rows(rows, record, quotas))
    assert {(r["lang"], r["split"]): r["count"] for r in kept.groupBy("lang", "split").count().collect()} == {
        ("good", "train"): 3, ("good", "validation"): 1, ("good", "test"): 1, ("bad", "train"): 3, ("bad", "validation"): 2, ("bad", "test"): 2,
    }


def test_parquet_groups_keep_file_order(spark, tmp_path):
    path = str(tmp_path / "docs.parquet")
    docs(spark, {"a": 2_500, "b": 10}).orderBy("doc_id").coalesce(1).write.parquet(path)
    source = parquet_groups(path, ["doc_id", "i"], "lang")
    want = [r.doc_id for r in spark.read.parquet(path).where("lang = 'a'").orderBy("doc_id").collect()]
    assert [r[0] for r in source("a")] == want
    with pytest.raises(ConnectionError):
        list(breaking_off(source, {"a": 1_200})("a"))


def test_a_short_group_breaks_off_too():
    got = []
    with pytest.raises(ConnectionError, match="after 3 rows"):
        got.extend(row for row in breaking_off(lambda group: [(i,) for i in range(3)], {"a": 57})("a"))
    assert got == [(0,), (1,), (2,)]
    assert list(breaking_off(lambda group: [(0,)], {"a": 57})("b")) == [(0,)]


def test_default_quotas():
    assert len(C.DEFAULT_QUOTAS) == 40
    assert sum(q[1] for q in C.DEFAULT_QUOTAS) == 580_000


def test_missing_values_become_empty(spark):
    df = spark.createDataFrame([(1, "en", None)], "doc_id long, lang string, text string")
    row = C.corpus_rows(df).first().asDict()
    assert row == {"doc_id": 1, "lang": "en", "title": "", "text": "", "url": ""}


def split_table(spark):
    rows = [("x", "train", 1), ("x", "test", 2), ("y", "validation", 3), ("z", "test", 4), ("z", "validation", 5)]
    return spark.createDataFrame(rows, "source string, split string, id long")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_split_fallbacks(spark):
    df = split_table(spark)
    assert ids(S.first_present_split(df, S.CURATION_SPLITS, "source")) == [1, 4]
    assert ids(S.first_present_split(df, S.RETRIEVAL_SPLITS, "source")) == [2, 3, 4]
    assert ids(S.first_present_split(df, S.RETRIEVAL_SPLITS)) == [2, 4]
    assert ids(S.first_present_split(df.where("source = 'y'"), S.CURATION_SPLITS)) == []
    assert ids(S.with_test_split(df, "source").where("split = 'test'")) == [2, 3, 4]


def test_schema_probe_reports_missing_columns(spark):
    df = spark.createDataFrame([("a", None), ("b", "x")], "text string, note string")
    rows = {r["column_name"]: (r["present"], r["n_values"]) for r in S.probe_schema(df, "t", ["text", "label"]).collect()}
    assert rows == {"text": (True, 2), "label": (False, None), "note": (True, None)}


def test_stats_have_a_total_even_with_null_groups(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "name string")
    assert {tuple(r) for r in C.dataset_stats(df, "name").collect()} == {("a", 2), (None, 1), ("TOTAL", 3)}


def test_concat_keeps_duplicates_and_marks_the_set(spark):
    one = spark.createDataFrame([("a",), ("b",)], "text string")
    out = C.concat_sets([one, one.where("text = 'a'")])
    assert sorted(map(tuple, out.select("set_no", "text").collect())) == [(0, "a"), (0, "b"), (1, "a")]


def test_split_set_is_written_by_split(spark, tmp_path):
    df = spark.createDataFrame([("train", 1), ("test", 2)], "split string, id long")
    C.write_split_set(df, str(tmp_path / "set"))
    assert {p.name for p in (tmp_path / "set").iterdir() if p.is_dir()} == {"split=train", "split=test"}
    assert spark.read.parquet(str(tmp_path / "set")).where(F.col("split") == "test").count() == 1
