"""Personal data: fixed patterns, and further spans that boosted trees select. Built-in expressions and Spark ML only."""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vecloom.llm.common import digest, join_by_key, keyed
from vecloom.sources.staging import stage

KINDS = ("email", "ip", "card", "phone")

# The base patterns. A run of the first class is entered where it begins (or where the last match
# ended) and never given back, which finds the same matches and takes one pass over the text.
BASE = {
    "email": "(?:(?<![A-Za-z0-9._%+-])|\\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?:(?<![0-9])|\\G)[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[ -]?+[0-9])++",
    "phone": "\\+[0-9][ ().0-9-]+[0-9]",
}
# What a text must hold for a pattern to match at all.
NEEDS = {"email": "@|[(\\[]at", "ip": "[0-9A-Fa-f][.,:][0-9A-Fa-f]", "card": "[0-9][ .-]?[0-9]", "phone": "[0-9][ ().-]{0,2}[0-9]|\\+[0-9][ ().-]"}
# Generators of further candidates; their spans may overlap.
GENERATORS = (
    ("email", "(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?+(?:@|\\(at\\)|\\[at\\]) ?+[A-Za-z0-9-]++(?: ?+(?:\\.|\\(dot\\)|\\[dot\\]) ?+[A-Za-z0-9-]++)++"),
    ("ip", "(?<![0-9])[0-9]{1,3}(?:[.,][0-9]{1,3}){3}(?![0-9])"),
    ("ip", "(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])"),
    ("card", "(?<![0-9])[0-9]{13,19}(?![0-9])"),
    ("card", "(?<![0-9])[0-9]{4}(?:[ .-][0-9]{4}){3}(?![0-9])"),
    ("phone", "(?<![0-9+])\\(?[0-9]{3}\\)?[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9])"),
    ("phone", "(?<![0-9A-Za-z])\\+?[0-9](?:[ ().-]{0,2}[0-9]){9,14}(?![0-9A-Za-z])"),
)
# Distinct sets of features that a task of the fit holds.
FIT_ROWS = 100_000
TREES, DEPTH = 10, 4
# A kind's threshold is the lowest of GRID at which this share of the held-out candidates above it is right.
PRECISION = 0.98
GRID = [0.5, 0.6, 0.7, 0.8, 0.85, 0.9, 0.95]

FEATURES = (
    *(f"is_{k}" for k in KINDS),
    *("length", "digits", "letters", "marks", "blanks", "dots", "hyphens", "ats", "plus", "luhn", "octets"),
    *("before_digit", "before_letter", "after_digit", "after_letter", "cue"),
)
CUE = "(?i)(?:tel|phone|call|mail|contact|card|visa|ip|host|addr)[^A-Za-z]{0,12}$"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    return F.call_function("luhn_check", number)


def octets(value: Column) -> Column:
    """Four numbers up to 255 between dots."""
    parts = F.split(value, "\\.")
    small = F.forall(parts, lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.right(p, F.lit(3)).try_cast("int") <= 255))
    return (F.size(parts) == 4) & small


def valid(kind: str, value: Column) -> Column:
    n = F.length(digits(value))
    return {
        "email": F.lit(True),
        "ip": octets(value),
        "card": n.between(14, 19) & luhn(digits(value)),
        "phone": n.between(10, 15),
    }[kind]


# Code points of context before a candidate. A match has two at least and is no neighbour of another
# unless it has three more, so eight matches and their gaps always cover them.
CONTEXT = 24
PIECES = 8


def pieces(text: Column, kind: str, pattern: str, number: int) -> Column:
    """Leftmost matches that do not overlap, each with the gap before it: an array of (g, value, gap, tail, head).

    `gap` is the gap's length, `tail` and `head` are its ends; the gap after the last match has a null value.
    """
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def piece(match: Column, gap: Column) -> Column:
        ends = F.right(gap, F.lit(CONTEXT)).alias("tail"), F.left(gap, F.lit(1)).alias("head")
        return F.struct(F.lit(number).alias("g"), match.alias("value"), F.length(gap).alias("gap"), *ends)

    empty = F.array().cast("array<struct<g:int,value:string,gap:int,tail:string,head:string>>")
    return F.when(text.rlike(NEEDS[kind]) & text.rlike(pattern), F.zip_with(found, gaps, piece)).otherwise(empty)


def text_pieces(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, pieces) per row: the pieces of all patterns, in one pass over the texts."""
    patterns = [(k, BASE[k]) for k in KINDS] + list(GENERATORS)
    every = F.concat(*(pieces(F.col("text"), kind, pattern, g) for g, (kind, pattern) in enumerate(patterns)))
    return keyed(docs).select("doc_id", "digest", every.alias("pieces"))


def candidates(found: DataFrame) -> DataFrame:
    """(doc_id, digest, start, order, end, kind, label, value, before, after) of the texts in `text_pieces`, each once.

    `label` is 1 for a base span, 0 for a base match that fails its check, null for what only a generator
    proposes. Starts are running sums of gaps and matches, so time grows with a text's matches, not their square.
    """
    kinds = [*KINDS, *(kind for kind, _ in GENERATORS)]
    rows = found.select("doc_id", "digest", F.posexplode("pieces").alias("pos", "x")).select("doc_id", "digest", "pos", "x.*")
    rows = rows.repartition("doc_id", "digest").distinct()
    text = Window.partitionBy("doc_id", "digest", "g").orderBy("pos")
    whole = F.concat("tail", F.coalesce(F.right("value", F.lit(CONTEXT)), F.lit("")))
    width = F.length("value")
    ends = F.sum(F.col("gap") + F.coalesce(width, F.lit(0))).over(text.rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumns(
        {
            "end": ends.cast("int"),
            "before": F.right(
                F.concat(F.array_join(F.collect_list(whole).over(text.rowsBetween(-PIECES, -1)), ""), F.col("tail")), F.lit(CONTEXT)
            ),
            "after": F.lead(F.left(F.concat("head", F.coalesce("value", F.lit(""))), F.lit(1))).over(text),
        }
    ).where("value IS NOT NULL")
    order = F.array(*(F.lit(KINDS.index(kind)) for kind in kinds))[F.col("g")]
    label = F.lit(None).cast("int")
    for g, kind in enumerate(KINDS):
        label = F.when(F.col("g") == g, valid(kind, F.col("value")).cast("int")).otherwise(label)
    rows = rows.select("doc_id", "digest", (F.col("end") - width).alias("start"), order.alias("order"), "end", label.alias("label"), "value", "before", "after")
    # What several patterns find in one place is equal but for its label.
    same = rows.groupBy("doc_id", "digest", "start", "order", "end").agg(*(F.max(c).alias(c) for c in ("label", "value", "before", "after")))
    return same.withColumn("kind", F.array(*map(F.lit, KINDS))[F.col("order")])


def with_features(spans: DataFrame) -> DataFrame:
    """Format and context of each candidate as numbers."""
    v = F.col("value")

    def without(chars: str) -> Column:
        return F.length(v) - F.length(F.regexp_replace(v, chars, ""))

    number = digits(v)
    made = {f"is_{k}": F.col("kind") == k for k in KINDS} | {
        "length": F.length(v),
        "digits": F.length(number),
        "letters": without("[A-Za-z]"),
        "marks": without("[^A-Za-z0-9 ]"),
        "blanks": without(" "),
        "dots": without("[.]"),
        "hyphens": without("-"),
        "ats": without("@"),
        "plus": v.startswith("+"),
        "luhn": F.length(number).between(13, 19) & luhn(number),
        "octets": F.coalesce(octets(v), F.lit(False)),
        "before_digit": F.col("before").rlike("[0-9]$"),
        "before_letter": F.col("before").rlike("\\p{L}$"),
        "after_digit": F.col("after").rlike("^[0-9]"),
        "after_letter": F.col("after").rlike("^\\p{L}"),
        "cue": F.col("before").rlike(CUE),
    }
    return spans.withColumns({k: x.cast("double") for k, x in made.items()})


def likeliest_set(spans: Column) -> Column:
    """Of spans (start, end, order, kind, p) sorted by place, those of the set without overlaps that has the largest
    sum of p; of equal sums the one that covers most.

    The fold holds one set per span that reaches beyond the place it has come to, and the best of all others.
    """
    one = "struct<start:int,end:int,order:int,kind:string,p:double>"
    shape = f"array<struct<total:double,covered:int,before:int,end:int,taken:array<{one}>>>"
    nothing = F.struct(F.lit(0.0), F.lit(0), F.lit(0), F.lit(0), F.array())

    def step(sets: Column, x: Column) -> Column:
        best = F.array_max(F.filter(sets, lambda s: s["end"] <= x["start"]))
        grown = F.struct(
            (best["total"] + x["p"]).alias("total"),
            (best["covered"] + x["end"] - x["start"]).alias("covered"),
            (-x["end"]).alias("before"),
            x["end"].alias("end"),
            F.concat(best["taken"], F.array(x)).alias("taken"),
        )
        return F.concat(F.array(best), F.filter(sets, lambda s: s["end"] > x["start"]), F.array(grown)).cast(shape)

    return F.aggregate(spans.cast(f"array<{one}>"), F.array(nothing).cast(shape), step, lambda sets: F.array_max(sets)["taken"])


def without_overlaps(rows: DataFrame) -> DataFrame:
    """Of accepted spans (doc_id, digest, start, order, end, kind, p, fixed) those that are not fixed, do not overlap a
    fixed one and are in the likeliest set of those left."""
    in_text = Window.partitionBy("doc_id", "digest")
    is_fixed = F.col("fixed") == 1
    earlier = F.max(F.when(is_fixed, F.col("end"))).over(in_text.orderBy("start"))
    later = F.min(F.when(is_fixed, F.col("start"))).over(in_text.orderBy(F.desc("start")))
    rows = rows.withColumns({"earlier": earlier, "later": later}).where(
        ~is_fixed & (F.col("start") >= F.coalesce("earlier", "start")) & (F.col("end") <= F.coalesce("later", "end"))
    )
    # Spans overlap only within an island: a run of spans each of which begins before the furthest end so far.
    by_place = in_text.orderBy("start", "end", "order")
    reach = F.max("end").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("opens", F.coalesce((F.col("start") >= reach).cast("int"), F.lit(1)))
    rows = rows.withColumn("island", F.sum("opens").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    island = F.array_sort(F.collect_list(F.struct("start", "end", "order", "kind", "p")))
    return rows.groupBy("doc_id", "digest", "island").agg(likeliest_set(island).alias("taken")).select("doc_id", "digest", F.inline("taken"))


def select_spans(spans: DataFrame) -> DataFrame:
    """The proposed spans (label null) that the trees accept, without overlaps: (doc_id, digest, start, order, end, kind).

    `spans` are candidates with their features.

    Trees are fitted on all labelled candidates but a fifth, which, held out, calibrates a threshold per kind. Candidates
    equal in kind, text and context count once; those equal in features are one row with their number as its weight, so
    the fit is exact and its table grows with the distinct features alone. Without examples of both labels nothing is added. A
    span that overlaps a base span gives way to it; of the others the set without overlaps that has the largest sum of
    likelihoods stays, so a span that bridges two gives way to both.
    """
    shape = F.xxhash64("kind", "value", "before", "after")
    columns = list(FEATURES)
    distinct = spans.where("label IS NOT NULL").withColumn("shape", shape).dropDuplicates(["shape", "label"])
    part = (F.pmod("shape", F.lit(5)) == 0).alias("held"), F.col("label").cast("double").alias("label")
    weighed = distinct.groupBy("kind", *part, *columns).agg(F.count(F.lit(1)).cast("double").alias("weight"))
    assembler = VectorAssembler(inputCols=columns, outputCol="features")
    weighed = stage(assembler.transform(weighed), "weighed")
    fitted, held = weighed.where("NOT held"), weighed.where("held")
    chosen = spans.where("label IS NULL")
    accepted = "doc_id", "digest", "start", "order", "end", "kind"
    n, labels = fitted.agg(F.count(F.lit(1)), F.count_distinct("label")).first()
    if labels < 2 or chosen.isEmpty():
        return chosen.limit(0).select(*accepted)
    # Spark looks for cuts in max(bins squared, 10,000) rows; with so many bins, in all. The order keeps sums the same.
    rows = fitted.repartitionByRange(-(-n // FIT_ROWS), *columns, "label").sortWithinPartitions(*columns, "label")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, subsamplingRate=1.0, weightCol="weight", maxBins=max(32, math.isqrt(n) + 1))
    model = trees.fit(rows)

    def score(rows: DataFrame) -> DataFrame:
        return model.transform(rows).withColumn("p", vector_to_array("probability")[1])

    grid = score(held).select("kind", "label", "weight", "p", F.explode(F.array(*map(F.lit, GRID))).alias("limit")).where("p >= limit")
    right = grid.groupBy("kind", "limit").agg((F.sum(F.col("label") * F.col("weight")) / F.sum("weight")).alias("precision")).where(F.col("precision") >= PRECISION)
    limits = {r["kind"]: r["limit"] for r in right.groupBy("kind").agg(F.min("limit").alias("limit")).collect()}  # one row a kind
    limit = F.lit(None).cast("double")
    for kind, x in limits.items():
        limit = F.when(F.col("kind") == kind, x).otherwise(limit)
    likely = score(assembler.transform(chosen)).where(F.col("p") >= limit).select(*accepted, "p", F.lit(0).alias("fixed"))
    fixed = spans.where("label = 1").select(*accepted, F.lit(2.0).alias("p"), F.lit(1).alias("fixed"))
    rows = likely.unionByName(fixed).distinct()
    return without_overlaps(rows).select(*accepted)


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, base, spans) per row: base spans, and all spans; arrays of (start, order, end, kind).

    Base spans are the leftmost non-overlapping matches of each kind that pass its check; they always stay.
    Further spans come from `select_spans`. Places are code points, ends exclusive, the order is by
    start, then kind. Null texts are empty and have no spans; rows equal in id and text get the same
    result; an empty table gives an empty table; other columns are not looked at.
    """
    found = stage(text_pieces(docs), "pieces")
    spans = stage(with_features(candidates(found)), "spans")
    place = "doc_id", "digest", "start", "order", "end", "kind"
    base = spans.where("label = 1").select(*place, F.lit(True).alias("is_base"))
    rows = base.unionByName(select_spans(spans).withColumn("is_base", F.lit(False)))
    span = F.struct("start", "order", "end", "kind")
    lists = rows.groupBy("doc_id", "digest").agg(
        F.array_sort(F.collect_list(F.when(F.col("is_base"), span))).alias("base"), F.array_sort(F.collect_list(span)).alias("spans")
    )
    joined = join_by_key(found.select("doc_id", "digest"), lists)
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    return joined.select("doc_id", "digest", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


# Code points of a block that a text is cut into, so that no place is looked up from the text's begin.
BLOCK = 1_024


def block_cuts(found: DataFrame) -> DataFrame:
    """(doc_id, digest, cuts) from (doc_id, digest, spans): for each block of a text, up to the last one with a
    span, its cuts (begin, end, kind), places in the block; `kind` is null unless a span begins there that no
    earlier span covers.
    """
    rows = found.select("doc_id", "digest", F.inline("spans"))
    earlier = Window.partitionBy("doc_id", "digest").orderBy("start", "order", "end").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("fresh", F.col("start") >= F.coalesce(F.max("end").over(earlier), F.lit(0)))
    blocks = F.sequence((F.col("start") / BLOCK).cast("int"), ((F.col("end") - 1) / BLOCK).cast("int"))
    rows = rows.withColumn("block", F.explode(blocks)).withColumn("origin", F.col("block") * BLOCK)
    opens = F.col("fresh") & (F.col("start") >= F.col("origin"))
    cut = F.struct(
        F.greatest(F.col("start") - F.col("origin"), F.lit(0)).alias("begin"),
        F.least(F.col("end") - F.col("origin"), F.lit(BLOCK)).alias("end"),
        F.when(opens, F.col("kind")).alias("kind"),
    )
    parts = rows.groupBy("doc_id", "digest", "block").agg(F.array_sort(F.collect_list(cut)).alias("cuts"))
    ahead = F.lag("block", 1, -1).over(Window.partitionBy("doc_id", "digest").orderBy("block"))
    gap = F.array_repeat(F.array().cast("array<struct<begin:int,end:int,kind:string>>"), F.col("block") - ahead - 1)
    parts = parts.select("doc_id", "digest", "block", F.concat(gap, F.array("cuts")).alias("run"))
    runs = F.array_sort(F.collect_list(F.struct("block", "run")))["run"]
    return parts.groupBy("doc_id", "digest").agg(F.flatten(runs).alias("cuts"))


def redact(block: Column, cuts: Column) -> Column:
    """A block of a text with each of its cuts replaced by its kind in brackets, or by nothing without a kind."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, x: Column) -> Column:
        kept = F.substring(block, state["at"] + 1, F.greatest(x["begin"] - state["at"], F.lit(0)))
        mark = F.coalesce(F.concat(F.lit("["), x["kind"], F.lit("]")), F.lit(""))
        return F.struct(F.greatest(state["at"], x["end"]).alias("at"), F.concat(state["out"], kept, mark).alias("out"))

    done = F.aggregate(cuts, start, step, lambda s: F.concat(s["out"], F.substring(block, s["at"] + 1, F.lit(BLOCK))))
    return F.when(F.size(cuts) > 0, done).otherwise(block)


def redact_texts(docs: DataFrame) -> DataFrame:
    """The rows of docs, all columns, with the personal data in `text` replaced by its kind in brackets.

    What an earlier span covers is not shown again. A null text becomes an empty one; rows that are equal, rows
    without an id and empty tables stay as many as they are. Columns named as those of `personal_data` are not touched.
    """
    found = personal_data(docs).where(F.size("spans") > 0).select("doc_id", "digest", "spans").dropDuplicates(["doc_id", "digest"])
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select(
        "doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.struct(*others).alias("others") if others else F.lit(0).alias("others")
    ).withColumn("digest", digest(F.col("text")))
    joined = join_by_key(rows, block_cuts(found))
    blocks = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    none = F.array().cast("array<struct<begin:int,end:int,kind:string>>")
    text = F.array_join(F.zip_with(blocks, "cuts", lambda block, cuts: redact(block, F.coalesce(cuts, none))), "")
    made = {c: F.col("others")[c] for c in others} | {"doc_id": F.col("doc_id"), "text": F.when(F.col("cuts").isNull(), F.col("text")).otherwise(text)}
    return joined.select(*[made[c].alias(c) for c in docs.columns])
