"""Benchmark decontamination with a positional inverted index. Built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import ascii_lower, join_by_key, keyed
from vecloom.sources.staging import drop_staged, stage

# Between words: everything in ASCII but digits and small letters, after A-Z became small.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same before: capital letters belong to words.
GAP_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
# Consecutive words in which the rarest words of a window must all occur to be near.
WITHIN = 20
# Words of a window that a proximity match asks for.
NEAR_WORDS = 3


def item_words(text: Column) -> Column:
    """The lower-cased words of a text in order; none for a null text."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP), "")


def count_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP_ANY_CASE), ""))


def item_windows(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Windows (window, run), one row for each distinct run of words, (window, item_id), and their words (word, term), numbered.

    All are written out, so numbers stay.

    A row without words has no window; one with fewer words than a window is one.
    """
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), item_words(F.col("text").cast("string")).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (window - 1), F.lit(1)))
    runs = rows.where(F.size("words") > 0).select(
        "item_id", F.explode(F.transform(starts, lambda i: F.slice("words", i, window))).alias("run")
    )
    runs = stage(runs, "runs")
    windows = stage(runs.select("run").distinct().select(F.monotonically_increasing_id().alias("window"), "run"), "windows")
    of_items = stage(runs.join(windows, "run").select("window", "item_id").distinct(), "items")
    drop_staged(runs)
    words = windows.select(F.explode("run").alias("word")).distinct().select("word", F.monotonically_increasing_id().alias("term"))
    return windows, of_items, stage(words, "words")


def postings(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """The index: (term, doc_id, digest, at), a row for each word of each text, `at` counting from 0.

    With `terms` (word, term) only those are stored, by number. Each task writes the lists of its own documents, so
    the index needs no shuffle; lists are read by term, with column pruning.
    """
    found = keyed(docs).select("doc_id", "digest", F.posexplode(item_words(F.col("text"))).alias("at", "word"))
    if terms is None:
        return found.withColumnRenamed("word", "term")
    return found.join(terms, "word").select("term", "doc_id", "digest", "at")


def by_rarity(windows: DataFrame, terms: DataFrame, index: DataFrame) -> DataFrame:
    """(window, run, rare): the words (n, k, term) of each window that can occur, rarest first, k its place.

    Windows with a word that the index does not hold cannot occur and are left out.
    """
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    words = windows.select("window", "run", F.posexplode("run").alias("k", "word")).join(terms, "word").join(counts, "term")
    found = words.groupBy("window").agg(
        F.first("run").alias("run"), F.array_sort(F.collect_list(F.struct("n", "k", "term"))).alias("rare")
    )  # a window's words are few
    return found.where(F.size("rare") == F.size("run"))


def _at_same_place(left: DataFrame, index: DataFrame, term: str, at: str) -> DataFrame:
    """Rows of left whose word `term` stands at `at` of their document."""
    lists = index.join(left.select(F.col(term).alias("term")).distinct(), "term", "left_semi")
    lists = lists.select(F.col("doc_id").alias("_doc_id"), F.col("digest").alias("_digest"), F.col("at").alias("_at"), F.col("term").alias("_term"))
    same = (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    same = same & (F.col(at) == F.col("_at")) & (F.col(term) == F.col("_term"))
    return left.join(lists, same, "left_semi")


def phrase_candidates(rare: DataFrame, index: DataFrame) -> DataFrame:
    """(doc_id, digest, start, window, run): where the two rarest words of a window stand at their distance.

    The lists of a window's two rarest words are intersected after the second is moved by their distance in the
    window. Windows of an item overlap and mostly share these words, so each (word, word, distance) is
    looked up once for all its windows.
    """
    second = F.when(F.size("rare") > 1, F.col("rare")[1]).otherwise(F.col("rare")[0])
    lead = rare.select(
        "window",
        "run",
        F.col("rare")[0]["k"].alias("k"),
        F.col("rare")[0]["term"].alias("t1"),
        second["term"].alias("t2"),
        (second["k"] - F.col("rare")[0]["k"]).alias("gap"),
    )
    pairs = lead.select("t1", "t2", "gap").distinct()
    first = index.join(pairs, index["term"] == pairs["t1"]).withColumn("at2", F.col("at") + F.col("gap"))
    both = _at_same_place(first.drop("term"), index, "t2", "at2")
    starts = both.join(lead, ["t1", "t2", "gap"]).withColumn("start", F.col("at") - F.col("k"))
    return starts.where("start >= 0").select("doc_id", "digest", "start", "window", "run")


def phrase_matches(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """(doc_id, digest, n_words, n_hit, windows) for each row of docs: words inside an exact occurrence, windows that occur."""
    found = candidates.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("start", "window", "run")).alias("found"))
    rows = join_by_key(keyed(docs), found)

    def exact(words: Column) -> Column:
        return F.filter("found", lambda c: F.slice(words, c["start"] + 1, F.size(c["run"])) == c["run"])

    # The words are bound to a variable, so that they are made once a text and not once a candidate.
    held = F.flatten(F.transform(F.array(item_words(F.col("text"))), exact))
    rows = rows.select(
        "doc_id", "digest", count_words(F.col("text")).cast("long").alias("n_words"), F.when(F.col("found").isNotNull(), held).alias("held")
    )
    covered = F.flatten(F.transform("held", lambda c: F.sequence(c["start"], c["start"] + F.size(c["run"]) - 1)))
    return rows.select(
        "doc_id",
        "digest",
        "n_words",
        F.coalesce(F.size(F.array_distinct(covered)), F.lit(0)).cast("long").alias("n_hit"),
        F.array_distinct(F.transform("held", lambda c: c["window"])).alias("windows"),
    )


def _near_place(left: DataFrame, index: DataFrame, term: str, within: int) -> DataFrame:
    """Rows of left (low, high: the words found so far) times the places of `term` that keep all in `within` words.

    Places meet in blocks of `within` words; a row without such a word stays as it is.
    """
    none = left.where(F.col(term).isNull())
    block = F.floor(F.col("high") / within)
    asked = left.where(F.col(term).isNotNull()).withColumn("block", F.explode(F.array(block - 1, block, block + 1)))
    lists = index.join(left.select(F.col(term).alias("term")).distinct(), "term", "left_semi")
    lists = lists.select(
        F.col("doc_id").alias("_doc_id"), F.col("digest").alias("_digest"), F.col("term").alias("_term"), F.col("at").alias("_at"),
        F.floor(F.col("at") / within).alias("_block"),
    )
    same = (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    same = same & (F.col(term) == F.col("_term")) & (F.col("block") == F.col("_block"))
    low, high = F.least("low", "_at"), F.greatest("high", "_at")
    met = asked.join(lists, same).where(high - low < within).withColumns({"low": low, "high": high})
    return met.select(*left.columns).distinct().unionByName(none)


def proximity_matches(rare: DataFrame, index: DataFrame, within: int = WITHIN) -> DataFrame:
    """(doc_id, digest, window): windows whose NEAR_WORDS rarest different words (all, if fewer) stand within `within` words.

    Any order counts. The search starts from the list of the rarest word.
    """
    terms = F.slice(F.array_distinct(F.transform("rare", lambda w: w["term"])), 1, NEAR_WORDS)
    names = [f"t{i + 1}" for i in range(NEAR_WORDS)]
    asked = rare.select("window", *[F.get(terms, F.lit(i)).alias(t) for i, t in enumerate(names)])
    sets = stage(asked.select(*names).distinct().withColumn("words", F.monotonically_increasing_id()), "word_sets")
    found = index.join(sets, index["term"] == sets["t1"]).drop("term").withColumnRenamed("at", "low").withColumn("high", F.col("low"))
    for term in names[1:]:
        found = _near_place(found, index, term, within)
    found = found.select("doc_id", "digest", "words").distinct()
    same = F.lit(True)
    for t in names:
        same = same & asked[t].eqNullSafe(sets[t])
    return found.join(sets.join(asked, same).select("words", "window"), "words").select("doc_id", "digest", "window")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, within: int = WITHIN) -> DataFrame:
    """(doc_id, digest, n_words, n_hit, n_items, items, n_near_items) for each row of docs.

    `items` (item_id, text) are the test texts. A window is `window` consecutive words of one of them, or all
    if there are fewer. n_hit counts the words of a document inside any exact occurrence; `items` holds the ids, as
    strings in order, of those with a window that occurs, n_items their number. n_near_items counts the items with
    a window whose rarest words stand near each other (`proximity_matches`).

    A null or empty text has no words, on both sides. Rows of items with the same id are one item; an item
    without id marks words but is neither listed nor counted. Rows of docs that agree in id and text get the same result, also
    with a null id; none is dropped. Without items nothing is hit; an empty table of documents gives an empty
    table. Other columns are not looked at.
    """
    windows, of_items, terms = item_windows(items, window)
    index = stage(postings(docs, terms), "postings")
    rare = stage(by_rarity(windows, terms, index), "rare")
    candidates = stage(phrase_candidates(rare, index), "candidates")
    near = proximity_matches(rare, index, within).join(of_items, "window").where("item_id IS NOT NULL")
    near = stage(near.select("doc_id", "digest", "item_id").distinct(), "near_items")
    drop_staged(index)
    rows = stage(phrase_matches(docs, candidates), "matches")
    hits = rows.select("doc_id", "digest", F.explode("windows").alias("window")).join(of_items, "window").where("item_id IS NOT NULL")
    hits = hits.select("doc_id", "digest", "item_id").distinct().groupBy("doc_id", "digest")
    hits = hits.agg(F.array_sort(F.collect_list("item_id")).alias("items"))  # the list is part of the result
    near = near.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n_near_items"))
    found = join_by_key(join_by_key(rows.drop("windows"), hits), near)
    return found.select(
        "doc_id",
        "digest",
        "n_words",
        "n_hit",
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("n_near_items", F.lit(0)).cast("long").alias("n_near_items"),
    )
