"""Main scores out of result JSON.

A result file holds {"scores": {"test": ...}}, where the value is a list of score
dicts or a dict of them by subset. Four readers exist, which differ in the keys they
try, their order, and what they do with a shape they do not expect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIELDS = "map<string,string>"


def fields(json: Column) -> Column:
    """The members of a JSON object as text, in document order; null for anything else."""
    return F.when(F.ltrim(json).startswith("{"), F.from_json(json, FIELDS))


def is_list(json: Column) -> Column:
    return F.coalesce(F.ltrim(json).startswith("["), F.lit(False))


def with_found(df: DataFrame, body: str, lists_only: bool = False) -> DataFrame:
    """Add `_test`, the text under scores.test, and `_found`, the members of its score dict.

    List: its first entry. Dict: `default`, else its first member, unless only lists
    count. The steps are columns of their own so that each text is parsed once.
    """
    df = df.withColumn("_test", F.get_json_object(body, "$.scores.test"))
    entry = F.when(is_list(F.col("_test")), F.get_json_object("_test", "$[0]"))
    if lists_only:
        return df.withColumn("_found", fields(entry))
    parts = F.col("_parts")
    of_dict = F.when(F.map_contains_key(parts, "default"), parts["default"]).otherwise(
        F.get(F.map_values(parts), F.lit(0))
    )
    return (
        df.withColumn("_parts", fields(F.col("_test")))
        .withColumn("_entry", entry.otherwise(of_dict))
        .withColumn("_found", fields(F.col("_entry")))
        .drop("_parts", "_entry")
    )


def has(found: Column, key: str) -> Column:
    return F.coalesce(F.map_contains_key(found, key), F.lit(False))


def number(found: Column, key: str) -> Column:
    return found[key].try_cast("double")


def first_key(found: Column, keys: tuple[str, ...]) -> Column:
    """The value of the first key that is there; `cos_sim` means its `spearman` member."""
    score = F.lit(0.0)
    for key in reversed(keys):
        if key == "cos_sim":
            inner = fields(found["cos_sim"])
            score = F.when(has(inner, "spearman"), number(inner, "spearman")).otherwise(score)
        else:
            score = F.when(has(found, key), number(found, key)).otherwise(score)
    return F.coalesce(score, F.lit(0.0))


def compare_score(df: DataFrame, body: str = "body", name: str = "score") -> DataFrame:
    keys = ("main_score", "accuracy", "ndcg_at_10", "cos_sim", "ap")
    score = first_key(F.col("_found"), keys) * 100
    return with_found(df, body).withColumn(name, score).drop("_test", "_found")


def summary_score(df: DataFrame, body: str = "body", name: str = "score") -> DataFrame:
    """The score, and in `metric` the name of what it stands for."""
    found = F.col("_found")
    main = has(found, "main_score")
    metric = (
        F.when(has(found, "accuracy"), "Accuracy")
        .when(has(found, "ndcg_at_10"), "NDCG@10")
        .when(main & has(found, "spearman"), "Spearman")
        .when(main & has(found, "ap"), "AP")
        .when(~main & has(fields(found["cos_sim"]), "spearman"), "Spearman")
        .otherwise("N/A")
    )
    score = first_key(found, ("main_score", "accuracy", "ndcg_at_10", "cos_sim")) * 100
    return with_found(df, body).withColumns({name: score, "metric": metric}).drop("_test", "_found")


def parse_score(df: DataFrame, body: str = "body", name: str = "score") -> DataFrame:
    """As given, not times 100; files that cannot be read this way are left out.

    Only lists are read: a filled dict of subsets counts as unreadable, an empty one,
    an empty list and a missing entry give 0.
    """
    filled = F.size(fields(F.col("_test"))) > 0
    score = first_key(F.col("_found"), ("main_score", "map", "accuracy", "spearman", "cos_sim"))
    return (
        with_found(df, body, lists_only=True)
        .where(F.try_parse_json(F.col(body)).isNotNull() & ~F.coalesce(filled, F.lit(False)))
        .withColumn(name, score)
        .drop("_test", "_found")
    )


def live_score(df: DataFrame, body: str = "body", name: str = "score") -> DataFrame:
    """As given; only lists are read, anything else gives 0."""
    score = first_key(F.col("_found"), ("main_score", "cos_sim", "accuracy"))
    return with_found(df, body, lists_only=True).withColumn(name, score).drop("_test", "_found")
