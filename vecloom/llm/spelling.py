"""Spelling variants: words one edit apart, found with an index of grams of variable length."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import ascii_lower, partitions
from vecloom.sources.staging import drop_staged, stage

MIN_LENGTH = 5
MIN_COUNT = 3
# One occurrence in this many loses a code point before words are counted.
NOISE = 97
# Lengths of grams. Every gram of SHORT code points is in the dictionary.
SHORT, LONG = 3, 6
# Marks around a word, so that its ends have as many grams as its middle. They sort apart from letters.
HEAD, TAIL = "<" * (SHORT - 1), ">" * (SHORT - 1)
PAD = SHORT - 1
# A gram is extended by one code point if it makes up more than 1 / DIVISOR of all grams of its length (and occurs over FEW
# times). So fewer than DIVISOR grams of a length are extended, each by at most 92 letters or a mark: the
# dictionary has at most 94^3 short and 3 * 93 * DIVISOR longer grams, however many words there are.
DIVISOR = 2_000
FEW = 100
# A list with more words than this is taken apart by what remains of a word with one code point deleted.
HOT = 50_000


def runs_of_letters(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), "[^a-zÀ-ÿ]+"), "")


def counted_words(docs: DataFrame) -> DataFrame:
    """(word, n): words of at least MIN_LENGTH code points with at least MIN_COUNT occurrences.

    A run whose crc32 with its document's id is divisible by NOISE loses one code point; the digest tells which.
    """
    text = F.col("text").cast("string")
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = docs.select(doc_id.alias("doc_id"), F.explode(runs_of_letters(text)).alias("run")).where(F.length("run") >= MIN_LENGTH)
    h = F.crc32(F.concat("doc_id", F.lit(":"), "run"))
    runs = runs.withColumn("h", h)
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = runs.select(F.when(F.col("h") % NOISE == 0, less).otherwise(F.col("run")).alias("word"))
    words = words.where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return words.where(F.col("n") >= MIN_COUNT)


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams of SHORT to LONG code points of padded words, counted a batch."""
    for batch in batches:
        counts: Counter[str] = Counter()
        for word in batch.column(0).to_pylist():
            padded = HEAD + word + TAIL
            for q in range(SHORT, LONG + 1):
                counts.update([padded[i : i + q] for i in range(len(padded) - q + 1)])
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["gram", "n"])


def gram_dictionary(words: DataFrame, divisor: int = DIVISOR, few: int = FEW) -> dict[str, int]:
    """The grams of the dictionary and how often each occurs in padded words.

    All grams of SHORT to LONG code points are counted; a gram beyond SHORT stays only if the gram before its last
    code point is frequent. The bound of its size is given at DIVISOR.
    """
    counts = words.select("word").mapInArrow(count_grams, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = stage(counts, "grams")
    total = counts.where(F.length("gram") == SHORT).agg(F.sum("n")).first()[0] or 0
    frequent = counts.where((F.length("gram") < LONG) & (F.col("n") > max(few, total / divisor))).select(F.col("gram").alias("before"))
    grams = counts.join(frequent, F.expr("substring(gram, 1, length(gram) - 1)") == F.col("before"), "left_semi")
    grams = counts.where(F.length("gram") == SHORT).unionByName(grams.where(F.length("gram") > SHORT))
    found = {r.gram: r.n for r in grams.collect()}  # bounded, see DIVISOR
    drop_staged(counts)
    return found


class Grams:
    """Splits padded words into grams of the dictionary, and bounds how many of them one edit can change."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        self.longer = {g for g in counts if len(g) > SHORT}
        self.heads = {g[:k] for g in self.longer for k in range(SHORT, len(g))}
        self.tails = {g[k:] for g in self.longer for k in range(1, len(g))}

    def split(self, padded: str) -> tuple[list[int], list[int]]:
        """Starts and ends: at each place the longest gram of the dictionary, less those inside an earlier one."""
        longer, starts, ends, end = self.longer, [], [], 0
        for p in range(len(padded) - SHORT + 1):
            q = p + SHORT
            while q - p < LONG and q < len(padded) and padded[p : q + 1] in longer:
                q += 1
            if q > end:
                starts.append(p)
                ends.append(q)
                end = q
        return starts, ends

    def affected(self, padded: str, starts: list[int], ends: list[int]) -> int:
        """The most grams that one inserted, deleted or replaced code point can take from the word.

        A gram left of the edit stays unless it, or one that begins before it, can grow over the edit; a gram
        right of it stays unless a gram from across the edit can reach its end. The dictionary tells both.
        """
        heads, tails, most = self.heads, self.tails, 0
        size = len(padded)
        for i in range(PAD, size - PAD + 1):
            low = next((p for p in range(max(0, i - LONG + 1), i - SHORT + 1) if padded[p:i] in heads), i)
            left = min(bisect_right(ends, i), bisect_left(starts, low))
            for r in (i, i + 1) if i < size - PAD else (i,):
                high = next((e for e in range(min(size, r + LONG - 1), r, -1) if padded[r:e] in tails), r)
                right = len(starts) - max(bisect_left(starts, r), bisect_right(ends, high))
                most = max(most, len(starts) - left - right)
        return most

    def listed(self, padded: str) -> tuple[list[tuple[int, int]], bool]:
        """The grams (start, end) under which the word is listed, rarest first, and whether no gram need survive an edit.

        With at most k of g grams affected, two words one edit apart share g - k of them, so one is among the
        k + 1 rarest of each.
        """
        starts, ends = self.split(padded)
        k = self.affected(padded, starts, ends)
        order = sorted(zip(starts, ends), key=lambda g: (self.counts[padded[g[0] : g[1]]], padded[g[0] : g[1]], g[0]))
        return order[: k + 1], k >= len(order)


def deletions(part: str) -> list[str]:
    """The text itself and the texts with one code point less, each once."""
    return list(dict.fromkeys([part, *(part[:i] + part[i + 1 :] for i in range(len(part)))]))


ENTRY = "key string, word string, n long, grams binary"


def entries(words: DataFrame, counts: dict[str, int]) -> DataFrame:
    """The inverted index: ENTRY, one row for each list that a word is in.

    An edit lies left or right of a gram that survives it, so a list is one of a gram with all that follows it (`>`) or
    all that precedes it (`<`). Words that an edit may leave without any gram are listed also under each
    deletion (`=`), where only such words meet. `grams` holds the word's grams as start * 8 + length, rarest first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(counts)
        for batch in batches:
            for at in range(0, batch.num_rows, 5_000):
                part = batch.slice(at, 5_000)
                keys, rows, packed = [], [], []
                for row, word in enumerate(part.column(0).to_pylist()):
                    padded = HEAD + word + TAIL
                    order, loose = grams.listed(padded)
                    size = len(padded)
                    made = [f">{padded[s:]}" for s, _ in order if s >= PAD] + [f"<{padded[:e]}" for _, e in order if e <= size - PAD]
                    if loose:
                        made += [f"={v}" for v in deletions(word)]
                    keys += made
                    rows += [row] * len(made)
                    packed += [np.array([s * 8 + e - s for s, e in order], "<i8").tobytes()] * len(made)
                taken = part.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.string()), taken.column(0), taken.column(1), pa.array(packed, pa.binary())],
                    names=["key", "word", "n", "grams"],
                )

    return words.select("word", "n").mapInArrow(run, ENTRY)


def common_ends(a: str, b: str) -> tuple[int, int]:
    """Lengths of the common beginning and the common end."""
    n = min(len(a), len(b))
    head = next((i for i in range(n) if a[i] != b[i]), n)
    tail = next((i for i in range(n) if a[-1 - i] != b[-1 - i]), n)
    return head, tail


def one_edit(a: str, b: str, head: int, tail: int) -> bool:
    if len(a) == len(b):
        return head + tail == len(a) - 1
    return abs(len(a) - len(b)) == 1 and head + tail >= min(len(a), len(b))


def met_at(a: str, b: str, grams_a: list[int], grams_b: set[int], head: int, tail: int) -> tuple[str, int] | None:
    """The first list, in the order of a's grams, that holds both padded words: its side and the gram's start in a."""
    shift = 8 * (len(b) - len(a))
    for gram in grams_a:
        start, size = gram >> 3, gram & 7
        if start + size <= min(head, len(a) - PAD) and gram in grams_b:
            return "<", start
        if start >= max(len(a) - tail, PAD) and gram + shift in grams_b:
            return ">", start
    return None


Member = tuple[str, int, bytes]


def matches(key: str, members: list[Member], deleted: str | None = None) -> Iterator[tuple[Member, Member]]:
    """Pairs of a list that are one edit apart, each from one list only of all that hold both.

    `deleted`: the list was taken apart, and the members share this beginning or end less one code point.
    """
    side, part = key[0], key[1:]
    cut = len(part) - PAD  # of the word, what the list has in common
    rest = {"<": lambda w: w[cut:], ">": lambda w: w[: len(w) - cut], "=": lambda w: w}[side]
    if deleted is not None or len(members) <= 8:
        pairs: Iterable[tuple[Member, Member]] = combinations(members, 2)
    else:
        by_deletion: dict[str, list[int]] = {}
        for i, m in enumerate(members):
            for v in deletions(rest(m[0])):
                by_deletion.setdefault(v, []).append(i)
        found = {p for group in by_deletion.values() if len(group) > 1 for p in combinations(group, 2)}
        pairs = ((members[i], members[j]) for i, j in found)
    for x, y in pairs:
        if abs(len(x[0]) - len(y[0])) > 1:
            continue
        if y[0] < x[0]:
            x, y = y, x
        a, b = HEAD + x[0] + TAIL, HEAD + y[0] + TAIL
        head, tail = common_ends(a, b)
        if not one_edit(a, b, head, tail):
            continue
        met = met_at(a, b, np.frombuffer(x[2], "<i8").tolist(), set(np.frombuffer(y[2], "<i8").tolist()), head, tail)
        if side == "=":
            here = met is None and part == min(set(deletions(x[0])) & set(deletions(y[0])))
        elif met is None or met[0] != side:
            here = False
        else:
            here = (len(a) - len(part) if side == ">" else _start_at(x[2], len(part))) == met[1]
        if here and (deleted is None or deleted == min(set(deletions(rest(x[0]))) & set(deletions(rest(y[0]))))):
            yield x, y


def _start_at(grams: bytes, end: int) -> int:
    """The start of the word's gram that ends there; ends of grams differ."""
    return next(g >> 3 for g in np.frombuffer(grams, "<i8").tolist() if (g >> 3) + (g & 7) == end)


def near_words(entries: DataFrame, hot: int = HOT) -> DataFrame:
    """(word, n_near, best): how many words are one edit apart, and (-n, word) of the one of largest n, ties by word.

    Lists are merged inside tasks, streamed in the order of their keys. One with more than `hot` words is dealt
    out once more by deletions of the rest of the word, of which each is shared by few words.
    """
    large = stage(entries.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > hot).select("key"), "large")
    rows = entries.withColumn("deleted", F.lit(None).cast("string"))
    if not large.isEmpty():
        apart = entries.join(large, "key", "left_semi").mapInArrow(take_apart, ENTRY + ", deleted string")
        rows = rows.join(large, "key", "left_anti").select(*apart.columns).unionByName(apart)
    n = partitions(entries.sparkSession)
    dealt = rows.repartition(n, "key", "deleted").sortWithinPartitions("key", "deleted")
    found = dealt.mapInArrow(merge_lists, "word string, n_near long, best_n long, best string")
    best = F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(best).alias("best"))


def take_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 5_000):
            part = batch.slice(at, 5_000)
            rows, deleted = [], []
            for row, (key, word) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist())):
                cut = len(key) - 1 - PAD
                rest = word if key[0] == "=" else word[cut:] if key[0] == "<" else word[: len(word) - cut]
                made = deletions(rest)
                rows += [row] * len(made)
                deleted += made
            taken = part.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(deleted, pa.string())], names=[*part.schema.names, "deleted"])


def merge_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their near words so far, folded a batch."""
    open_key, members = None, []
    best: dict[str, list] = {}

    def close() -> None:
        if len(members) > 1:
            for x, y in matches(open_key[0], members, open_key[1]):
                for one, other in ((x, y), (y, x)):
                    rank = (-other[1], other[0])
                    known = best.setdefault(one[0], [0, rank])
                    known[0] += 1
                    known[1] = min(known[1], rank)

    def flush() -> pa.RecordBatch:
        columns = [
            pa.array(list(best), pa.string()),
            pa.array([b[0] for b in best.values()], pa.int64()),
            pa.array([-b[1][0] for b in best.values()], pa.int64()),
            pa.array([b[1][1] for b in best.values()], pa.string()),
        ]
        best.clear()
        return pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "best_n", "best"])

    for batch in batches:
        key, word, n, grams, deleted = (batch.column(c) for c in ("key", "word", "n", "grams", "deleted"))
        # Lists of one word, the most by far, are passed over without leaving Arrow.
        new = np.ones(batch.num_rows + 1, bool)
        if batch.num_rows > 1:
            marks = [pc.fill_null(c, "\0") for c in (key, deleted)]
            new[1:-1] = np.logical_or.reduce([pc.not_equal(m[1:], m[:-1]).to_numpy(zero_copy_only=False) for m in marks])
        alone = new[:-1] & new[1:]
        alone[:1] = alone[-1:] = False  # a list may go on in the next batch
        some = pa.array(np.flatnonzero(~alone))
        for k, w, m, g, d in zip(*(c.take(some).to_pylist() for c in (key, word, n, grams, deleted))):
            if (k, d) != open_key:
                close()
                open_key, members = (k, d), []
            members.append((w, m, g))
        if best:
            yield flush()
    close()
    if best:
        yield flush()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last form that is reached; steps double each round."""
    found = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        beyond = found.select(F.col("word").alias("at"), F.col("root").alias("beyond"))
        jumped = found.select("word", "root").join(beyond, F.col("root") == F.col("at"), "left")
        jumped = stage(jumped.select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "roots")
        drop_staged(found)
        found = jumped
        if found.where("moved").isEmpty():
            return found.select("word", "root")


def variants_of_words(words: DataFrame, divisor: int = DIVISOR, few: int = FEW, hot: int = HOT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of words (word, n), `word` being unique and of letters.

    Words are near if one code point inserted, deleted or replaced makes them equal. A word's form is its near
    word of largest n (ties: the smallest) if that is at least twice its own; its root is where forms lead, itself without one.
    """
    words = stage(words.select("word", "n").where("word IS NOT NULL"), "words")
    index = stage(entries(words, gram_dictionary(words, divisor, few)), "gram_lists")
    near = stage(near_words(index, hot), "near_words")
    drop_staged(index)
    form_n = -F.col("best.less")
    found = words.join(near, "word", "left").withColumn("form_n", F.when(form_n >= 2 * F.col("n"), form_n))
    found = stage(found.withColumn("form", F.when(F.col("form_n").isNotNull(), F.col("best.word"))).drop("best"), "forms")
    return found.join(roots(found.where("form IS NOT NULL")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )


def spelling_variants(docs: DataFrame, divisor: int = DIVISOR, few: int = FEW, hot: int = HOT) -> DataFrame:
    """`variants_of_words` of the words of docs (doc_id, text), one row a word.

    Words are those of `counted_words`; results do not depend on divisor, few and hot, which shape the index. A null or
    empty text has no words; a null id reads as the empty text in the digest; repeated rows count each time;
    texts are never cut. Other columns are not looked at. Without words the table is empty.
    """
    return variants_of_words(counted_words(docs), divisor, few, hot)
