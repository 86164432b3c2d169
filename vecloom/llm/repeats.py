"""Removal of byte strings that occur more than once, over all documents.

Sampled suffixes stand for all others. Sorting every suffix needs some 16 bytes of disk for each byte of
text and pass; here a suffix is sampled where its first bytes hash smallest among the next few, which
depends on the text alone, so equal strings of LENGTH bytes hold the same sample at the same place.
Samples are sorted outside memory by Spark's shuffle and named by what they begin with; names that occur
once end there. For the others, the common text to the left and right of the samples is induced: samples
with equal surroundings are one class, and only one member of each class is looked at byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import PACKED, compressed, join_by_key, keyed, partitions, text_slices, unpacked
from vecloom.sources.staging import drop_staged, stage

LENGTH = 200
SEED = 32  # bytes by which a sample is chosen and named
CHUNK = 1 << 21  # bytes of text that a worker hashes at once
MEMBERS = 1_000  # classes of one name that a task compares

ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
STEP = 0x5851F42D4C957F2D  # multiplier of the rolling hash, odd
BACK = pow(STEP, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * ODD[0]
    x = (x ^ (x >> np.uint64(29))) * ODD[1]
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


class Hashes:
    """64-bit hashes of any substring of a text of up to `size` bytes, from sums of powers."""

    def __init__(self, size: int):
        with np.errstate(over="ignore"):
            self.up, self.down = _powers(STEP, size + 1), _powers(BACK, size + 1)
            self.letters = mix(mix(np.arange(1, 257, dtype=np.uint64) * ODD[2]))

    def load(self, raw: np.ndarray) -> None:
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.letters[raw] * self.down[: len(raw)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.up[begin])

    def windows(self, length: int) -> np.ndarray:
        """Of every substring of one length."""
        n = max(0, len(self.sums) - length)
        return mix((self.sums[length:] - self.sums[:n]) * self.up[:n])


def smallest_ahead(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest key among each one and the width - 1 that follow."""
    n = len(keys) - width + 1
    if n <= 0:
        return keys[:0]
    full = -(-len(keys) // width) * width
    grid = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    grid[: len(keys)] = keys
    grid = grid.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of the texts one after another, and where each begins (and the last ends)."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    bounds = np.concatenate([[0], np.cumsum(size)])
    data = texts.buffers()[2]
    first = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset] if len(texts) else 0
    if data is None:
        return np.zeros(0, np.uint8), bounds
    return np.frombuffer(data, np.uint8)[first : first + bounds[-1]], bounds


def sampled(hashes: Hashes, raw: np.ndarray, stops: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(name, class, first, number) of each run of places whose strings of `length` bytes share a sample.

    stops: for each place, where its document ends. Names are hashes of SEED bytes at the sample, classes of all
    the bytes that the run's strings cover and of where the sample lies in them.
    """
    hashes.load(raw)
    seeds = hashes.windows(SEED)
    bits = np.uint64(max(1, len(raw)).bit_length())
    keys = ((seeds >> bits) << bits) | np.arange(len(seeds), dtype=np.uint64)
    sample = (smallest_ahead(keys, length - SEED + 1) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    places = np.flatnonzero(np.arange(len(sample)) + length <= stops[: len(sample)])
    of = sample[places]
    new = np.ones(len(places), bool)
    new[1:] = (of[1:] != of[:-1]) | (places[1:] != places[:-1] + 1)
    begin = np.flatnonzero(new)
    first, at = places[begin], of[begin]
    number = np.diff(np.append(begin, len(places)))
    where = (at - first).astype(np.uint64) * ODD[2] + number.astype(np.uint64) * ODD[3]
    return seeds[at], mix(hashes.of(first, first + number + length - 1) ^ mix(where)), first, number


def samples(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(name, class, doc_id, digest, first, number) over (doc_id, text, digest)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(CHUNK + length)
        with np.errstate(over="ignore"):
            for part in text_slices(batches, 1):
                raw, bounds = raw_bytes(part.column(1))
                owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
                for begin in range(0, len(raw), CHUNK):
                    piece = raw[begin : begin + CHUNK + length - 1]
                    own = owner[begin : begin + CHUNK]
                    name, kind, first, number = sampled(hashes, piece, bounds[own + 1] - begin, length)
                    doc = own[first]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(name.view(np.int64)),
                            pa.array(kind.view(np.int64)),
                            part.column(0).take(pa.array(doc)),
                            part.column(2).take(pa.array(doc)),
                            pa.array((first + begin - bounds[doc]).astype(np.int64)),
                            pa.array(number.astype(np.int16)),
                        ],
                        names=["name", "class", "doc_id", "digest", "first", "number"],
                    )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"name long, class long, doc_id {kind}, digest long, first long, number short"
    return docs.select("doc_id", "text", "digest").mapInArrow(find, schema)


def surroundings(docs: DataFrame, length: int) -> DataFrame:
    """(name, class, number, members, raw): the bytes of each run in `runs`, cut from the packed texts."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, 0, PACKED):
            rows = []
            for text, runs in zip(unpacked(part.column(0)), part.column(1).to_pylist()):
                for run in runs:
                    rows.append({k: run[k] for k in ("name", "class", "number", "members")} | {"raw": text[run["first"] : run["first"] + run["number"] - 1 + length]})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=shape)

    shape = pa.schema([("name", pa.int64()), ("class", pa.int64()), ("number", pa.int32()), ("members", pa.int64()), ("raw", pa.binary())])
    return docs.select("packed", "runs").mapInArrow(find, "name long, class long, number int, members long, raw binary")


def strings_in(raw: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, place) of each string of `length` bytes in the rows."""
    data = np.frombuffer(b"".join(raw), np.uint8)
    size = np.array([len(x) for x in raw])
    first = np.cumsum(size) - size
    hashes = Hashes(len(data))
    hashes.load(data)
    found = hashes.windows(length)
    row = np.repeat(np.arange(len(raw)), size - length + 1)
    place = np.arange(len(row)) - np.repeat(np.cumsum(size - length + 1) - (size - length + 1), size - length + 1)
    return found[first[row] + place], row, place


def halves(rows: DataFrame, length: int) -> DataFrame:
    """Runs of the same columns, each cut in two by how far its strings reach to the left of their sample.

    rows: (name, class, raw, root, shift, at, low, high). A run's strings have low to high bytes before the sample, which
    lies at `at` in raw (unknown yet: -1; then the name is the sample's hash). All of them hold `low` bytes before the
    sample and what `high` leaves after it; those bytes are the new name, so that a name gets longer with each cut and
    ends as one whole string. `shift` is the run's place in the surroundings of class `root`.
    """
    span = length - SEED

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1_000):
                part = batch.slice(begin, 1_000)
                raw = part.column(2).to_pylist()
                name, shift, at, low, high = (part.column(i).to_numpy().astype(np.int64) for i in (0, 4, 5, 6, 7))
                data = np.frombuffer(b"".join(raw), np.uint8)
                size = np.array([len(x) for x in raw])
                first = np.cumsum(size) - size
                with np.errstate(over="ignore"):
                    hashes = Hashes(len(data))
                    hashes.load(data)
                    if (at < 0).any():  # the sample is the first of its kind in the run
                        here = hashes.windows(SEED)[first[:, None] + np.arange(span + 1)] == name.view(np.uint64)[:, None]
                        at = np.where(at < 0, here.argmax(axis=1), at)
                    middle = (low + high + 1) // 2
                    for least, most in ((low, middle - 1), (middle, high)):
                        near, far = np.maximum(least, at - (size - length)), np.minimum(most, at)
                        (some,) = np.nonzero(near <= far)
                        if not len(some):
                            continue
                        l, r, f, n, o = least[some], most[some], far[some], near[some], (first + at)[some]
                        named = hashes.of(o - l, o + length - r) ^ mix(l.astype(np.uint64) * ODD[2] + r.astype(np.uint64) * ODD[3])
                        where = f.astype(np.uint64) * ODD[2] + (f - n + 1).astype(np.uint64) * ODD[3]
                        kind = mix(hashes.of(o - f, o - n + length) ^ mix(where))
                        of = at[some]
                        raws = [raw[i][x:y] for i, x, y in zip(some.tolist(), (of - f).tolist(), (of - n + length).tolist())]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(mix(named).view(np.int64)),
                                pa.array(kind.view(np.int64)),
                                pa.array(raws, pa.binary()),
                                part.column(3).take(pa.array(some)),
                                *(pa.array(x.astype(np.int32)) for x in (shift[some] + of - f, f, l, r)),
                            ],
                            names=part.schema.names,
                        )

    return rows.mapInArrow(cut, "name long, class long, raw binary, root long, shift int, at int, low int, high int")


def shared_strings(rows: DataFrame, length: int) -> DataFrame:
    """(class, ats): places in the surroundings of a class at which a string begins that another class holds too.

    Equal strings have equal names. Names of up to MEMBERS classes are compared in the task that gets them. Runs of larger
    ones are cut in halves with longer names, where runs of equal bytes become one and those alone with their
    name end; this goes on, eight times at most, until no name is so large.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes]] = []
        size, last = 0, None

        def close() -> pa.RecordBatch:
            kinds = [k for k, _ in held]
            with np.errstate(over="ignore"):
                found, row, place = strings_in([x for _, x in held], length)
            _, back, times = np.unique(found, return_inverse=True, return_counts=True)
            again = times[back] > 1
            row, place = row[again], place[again]
            of, begin = np.unique(row, return_index=True)
            lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(row)).astype(np.int32)), pa.array(place.astype(np.int32)))
            return pa.RecordBatch.from_arrays([pa.array([kinds[i] for i in of.tolist()], pa.int64()), lists], names=["class", "ats"])

        for batch in batches:
            for name, kind, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if name != last and size > CHUNK // 4:
                    yield close()
                    held, size = [], 0
                if held and held[-1][0] == kind:
                    continue  # equal documents are read once each; one of them is enough
                held.append((kind, raw))
                size += len(raw)
                last = name
        if held:
            yield close()

    def near(runs: DataFrame) -> DataFrame:
        few = runs.where(F.col("members") <= MEMBERS).select("name", "class", "raw")
        dealt = few.repartition(partitions(rows.sparkSession), "name").sortWithinPartitions("name", "class")
        return dealt.mapInArrow(compare, "class long, ats array<int>")

    many = rows.where(F.col("members") > MEMBERS)
    found, parts = near(rows), []
    whole = F.lit(0).alias("low"), F.lit(length - SEED).alias("high")
    many = many.select("name", "class", "raw", F.col("class").alias("root"), F.lit(0).alias("shift"), F.lit(-1).alias("at"), *whole)
    while not many.isEmpty():
        cut = stage(halves(many, length), "halves")
        # A run that several classes hold is repeated, and goes on once, with no class to tell of it.
        several = F.count(F.lit(1)) > 1
        same = [F.min(c).alias(c) for c in ("raw", "shift", "at", "low", "high")]
        runs = cut.groupBy("name", "class").agg(several.alias("several"), F.when(~several, F.min("root")).alias("root"), *same)
        runs = stage(runs, "runs")
        again = cut.where("root IS NOT NULL").join(runs.where("several").select("class"), "class")
        every = F.sequence("shift", F.col("shift") + F.octet_length("raw") - length)
        parts.append(again.select(F.col("root").alias("class"), every.alias("ats")))
        names = runs.groupBy("name").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        runs = stage(runs.join(names, "name"), "named")
        told = runs.where("root IS NOT NULL").select("class", "root", "shift").join(near(runs), "class")
        parts.append(told.select(F.col("root").alias("class"), F.transform("ats", lambda x: x + F.col("shift")).alias("ats")))
        many = runs.where(F.col("members") > MEMBERS).select(many.columns)
    if not parts:
        return found
    far = reduce(DataFrame.unionByName, parts).groupBy("class").agg(F.array_distinct(F.flatten(F.collect_list("ats"))).alias("ats"))
    return found.unionByName(far)


def repeated_places(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, digest, runs): places at which a string of `length` bytes begins that also begins elsewhere.

    docs: (doc_id, digest, text). A run is (first, number, ats): all `number` places from `first` on if ats is
    null, else those at first + ats.
    """
    every = stage(samples(docs, length), "samples")
    names = every.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name")
    names = stage(names, "names")  # on its own, so that the join can split a frequent name
    found = stage(every.join(names, "name"), "repeated")
    drop_staged(every, names)
    classes = found.groupBy("name", "class", "number").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "digest", "first")).alias("place")
    )
    classes = stage(classes, "classes")
    several = classes.groupBy("name").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    run = F.struct("name", "class", "place.first", F.col("number").cast("int").alias("number"), "members")
    look = classes.join(several, "name").groupBy("place.doc_id", "place.digest").agg(F.collect_list(run).alias("runs"))
    read = stage(surroundings(join_by_key(compressed(docs), look, "inner"), length), "surroundings")
    ats = shared_strings(read, length)
    known = classes.select("class", "n").join(ats, "class", "left").where("n > 1 OR ats IS NOT NULL")
    known = known.select("class", F.when(F.col("n") == 1, F.col("ats")).alias("ats"))
    return (
        found.join(known, "class")
        .groupBy("doc_id", "digest")
        .agg(F.collect_list(F.struct("first", F.col("number").cast("int").alias("number"), "ats")).alias("runs"))
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for each row: the UTF-8 bytes that no repeated string covers.

    A byte goes if a string of `length` bytes that covers it also begins anywhere else, in the same document
    or another; strings are judged on the input, overlaps count, none crosses documents. `kept` is the rest,
    n_spans the number of runs removed. Texts are compared by 64-bit hashes of their strings. Null texts are
    empty and texts shorter than `length` stay whole; rows that are equal are documents of their own and
    repeat one another. An empty table gives an empty table; other columns are not looked at.
    """
    docs = keyed(docs)
    joined = join_by_key(compressed(docs), repeated_places(docs, length)).select("doc_id", "packed", "runs")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, 1, PACKED):
            out = []
            for text, runs in zip(unpacked(part.column(1)), part.column(2)):
                raw = np.frombuffer(text, np.uint8)
                if not runs.is_valid:
                    out.append((len(raw), 0, 0, raw.tobytes()))
                    continue
                edge = np.zeros(len(raw) + 1, np.int32)
                for run in runs.as_py():
                    if run["ats"] is None:
                        edge[run["first"]] += 1
                        edge[run["first"] + run["number"] - 1 + length] -= 1
                    else:
                        at = np.array(run["ats"], np.int64) + run["first"]
                        np.add.at(edge, at, 1)
                        np.add.at(edge, at + length, -1)
                gone = np.cumsum(edge)[:-1] > 0
                spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
                out.append((len(raw), int(gone.sum()), spans, raw[~gone].tobytes()))
            n_bytes, n_removed, n_spans, kept = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    kind = joined.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
