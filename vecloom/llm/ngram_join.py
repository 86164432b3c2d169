"""Similarity join of documents on their word n-grams, compared by traversing prefix trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import partitions, text_slices
from vecloom.llm.components import components
from vecloom.sources.staging import drop_staged, stage

# Frequent n-grams that are listed, at most (8 bytes each): the most frequent. They come last in the global order.
FREQUENT = 500_000
# Documents that a task holds in one tree at once.
TREE_ROWS = 200
# A byte of text takes this many times the room here that it takes in other operators.
WIDE = 2
# Above any number of n-grams of a text.
AT_MOST = 1 << 31
# Members of a large bucket that a task compares with one another.
BUCKET = 2_000
# Members up to which all pairs of a bucket are candidates at once; larger buckets go the longer way.
SMALL = 16

LIGHT = np.uint64((1 << 62) - 1)
ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly."""
    x = (x ^ (x >> np.uint64(31))) * ODD[1]
    x = (x ^ (x >> np.uint64(29))) * ODD[2]
    return x ^ (x >> np.uint64(32))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash for each word of the texts, A-Z as a-z, and where each text's words begin and the last end."""
    import xxhash

    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = lists.flatten().dictionary_encode()
    known = np.array([xxhash.xxh3_64_intdigest(w) for w in flat.dictionary.to_pylist()], dtype=np.uint64)
    index = flat.indices.to_numpy(zero_copy_only=False)
    hashes = known[index] if len(index) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    blank = pc.equal(flat.dictionary, "").to_numpy(zero_copy_only=False)
    if blank.any():  # around white space at either end
        real = ~blank[index]
        hashes, owner = hashes[real], owner[real]
    return hashes, np.searchsorted(owner, np.arange(len(texts) + 1))


def ngram_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The distinct n-grams of each text as ascending 62-bit numbers; a shorter text is one n-gram."""
    with np.errstate(over="ignore"):
        words, bounds = word_hashes(texts)
        total = max(0, len(words) - n + 1)
        grams = np.full(total, np.uint64(n) * ODD[0])
        for j in range(n):
            grams = mix(grams + words[j : j + total] * ODD[0])
        grams &= LIGHT
        sets = []
        for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if end - begin >= n:
                sets.append(np.unique(grams[begin : end - n + 1]))
            elif end > begin:
                whole = np.full(1, np.uint64(end - begin) * ODD[0])
                for j in range(begin, end):
                    whole = mix(whole + words[j] * ODD[0])
                sets.append(whole & LIGHT)
            else:
                sets.append(np.zeros(0, np.uint64))
    return sets


def parities(grams: np.ndarray) -> bytes:
    """For each of 2**k slots, at least as many as n-grams, whether an odd number of n-grams falls there.

    Two sets differ in at least as many n-grams as their parities do in slots.
    """
    slots = 1 << max(6, int(len(grams)).bit_length())
    odd = np.bincount((grams & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def slots_apart(a: bytes, b: bytes) -> int:
    """Slots in which two parities differ; the longer one is folded to the length of the other."""
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    n, m = 8 * len(a), 8 * len(b)
    if n < m:
        x, y, n, m = y, x, m, n
    while n > m:
        n //= 2
        x = (x >> n) ^ (x & ((1 << n) - 1))
    return (x ^ y).bit_count()


def frequent_ngrams(docs: DataFrame, n: int) -> np.ndarray:
    """At most FREQUENT of the most frequent n-grams, the rarest first; every document is read.

    A task names the n-grams that more than one of its documents hold. Counts decide the order of n-grams only,
    never a result.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 0, WIDE):
            grams, times = np.unique(np.concatenate(ngram_sets(batch.column(0), n)), return_counts=True)
            many = times > 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams[many].astype(np.int64)), pa.array(times[many].astype(np.int64))], names=["gram", "times"]
            )

    counted = docs.select("text").mapInArrow(count, "gram long, times long").groupBy("gram").agg(F.sum("times").alias("times"))
    counted = stage(counted.withColumn("size", F.floor(8 * F.log2("times"))), "frequent")
    left, least = FREQUENT, None
    for size, rows in counted.groupBy("size").count().orderBy(F.desc("size")).collect():  # a few hundred sizes
        left -= rows
        if left < 0:
            break
        least = size
    if least is None:
        return np.zeros(0, np.int64)
    found = counted.where(F.col("size") >= least).select("gram", "times").toPandas()  # at most FREQUENT rows
    drop_staged(counted)
    return found.sort_values(["times", "gram"])["gram"].to_numpy(np.int64)


def ordered_sets(docs: DataFrame, n: int, percent: int, frequent: np.ndarray, whole: bool) -> DataFrame:
    """(doc_id, n, k1, k2, grams, bits): sets in the global order, rare n-grams first; their prefixes unless `whole`.

    The order is that of the numbers: hashes below 2**62, then frequent n-grams by rank. k1 and k2
    are 128 bits of hash over the set, bits its parities. Two sets that link share an n-gram of their prefixes.
    """
    by_value = np.argsort(frequent)
    values = frequent[by_value].astype(np.uint64)
    ranks = (by_value + (1 << 62)).astype(np.uint64)

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in text_slices(batches, 1, WIDE):
            sets = ngram_sets(batch.column(1), n)
            out, keys, bits = [], [], []
            for grams in sets:
                if len(values):
                    at = np.minimum(np.searchsorted(values, grams), len(values) - 1)
                    hit = values[at] == grams
                    if hit.any():
                        grams = np.sort(np.where(hit, ranks[at], grams))
                keys.append(xxhash.xxh3_128_digest(grams.tobytes()))
                m = len(grams)
                bits.append(b"" if whole else parities(grams))
                out.append(grams if whole else grams[: m - -(-percent * m // 100) + 1])
            both = np.frombuffer(b"".join(keys), dtype="<i8").reshape(-1, 2)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array(both[:, 0]),
                    pa.array(both[:, 1]),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(out).astype(np.int64))),
                    pa.array(bits, pa.binary()),
                ],
                names=["doc_id", "n", "k1", "k2", "grams", "bits"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        order, "doc_id long, n long, k1 long, k2 long, grams array<long>, bits binary"
    )


class PrefixTree:
    """Sets in the global order, as a prefix tree: sorted sequences and what each shares with the one before.

    The path that neighbours share is a common part of the tree; a branch begins where they part. The
    sequences may be prefixes of the sets; `sizes` are those of the whole sets.
    """

    def __init__(self, sets: list[np.ndarray], sizes: list[int]):
        # Big-endian bytes compare as the sequences of numbers do.
        raw = [x.astype(">u8").tobytes() for x in sets]
        self.rows = sorted(range(len(sets)), key=raw.__getitem__)
        self.sets = [sets[i] for i in self.rows]
        self.sizes = [sizes[i] for i in self.rows]
        self.shared = [0]
        for a, b in zip(self.sets, self.sets[1:]):
            m = min(len(a), len(b))
            differ = np.flatnonzero(a[:m] != b[:m])
            self.shared.append(int(differ[0]) if len(differ) else m)

    def matches(self, probe: np.ndarray, size: int, percent: int, step: int = 256) -> list[int]:
        """Rows whose set may link with the probe's (and does, if both are whole): 100 * common >= percent * united.

        A path's overlap with the probe is counted once for all sets below it. A branch is left
        when its overlap and what can still follow on either side do not reach the number asked.
        """
        found = []
        depth, hits, used = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
        for row, grams, whole, shared in zip(self.rows, self.sets, self.sizes, self.shared):
            need = -(-percent * (size + whole) // (100 + percent))
            # Points of the path walked so far: depth, overlap, and the place reached in the probe.
            keep = int(np.searchsorted(depth, shared, side="right"))
            depth, hits, used = depth[:keep], hits[:keep], used[:keep]
            at, common, place = int(depth[-1]), int(hits[-1]), int(used[-1])
            # Beyond the probe's last n-gram nothing is known about a prefix, and nothing follows in a set.
            end = int(np.searchsorted(grams, probe[-1], side="right"))
            steps = []
            while at < end and common + min(whole - at, size - place) >= need:
                part = grams[at : min(end, at + step)]
                where = np.searchsorted(probe, part, side="left")
                same = probe[where] == part
                at += len(part)
                common += int(same.sum())
                place = int(where[-1]) + int(same[-1])
                steps.append((at, common, place))
            if steps:
                d, h, u = np.array(steps, np.int64).T
                depth, hits, used = np.append(depth, d), np.append(hits, h), np.append(used, u)
            if at >= end:
                rest = whole - at
                if len(grams) > end:  # the probe ends first
                    place = len(probe)
                else:
                    place = int(np.searchsorted(probe, grams[-1], side="right"))
                if common + min(rest, size - place) >= need:
                    found.append(row)
        return found


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets (node, n, grams, bits) link, or may link if `grams` are prefixes.

    The partners of a are dealt in blocks of about TREE_ROWS; a block becomes a prefix tree, which the set of a
    traverses. A document with any number of partners costs one small tree a task at a time. Of what the tree
    leaves, parities (if `bits` holds them) rule out sets that differ in too many n-grams.
    """
    spark = pairs.sparkSession
    blocks = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / TREE_ROWS).alias("blocks"))
    dealt = pairs.join(blocks, "a").withColumn("block", F.pmod(F.xxhash64("b"), F.col("blocks")))
    probes = blocks.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    members = dealt.select("a", "block", "b").join(sets.withColumnRenamed("node", "b"), "b")
    heads = probes.join(sets.withColumnRenamed("node", "a"), "a")
    rows = members.select("a", "block", F.lit(1).alias("role"), "b", "n", "grams", "bits").unionByName(
        heads.select("a", "block", F.lit(0).alias("role"), F.col("a").alias("b"), "n", "grams", "bits")
    )

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, probes, nodes, members, sizes, marks = None, [], [], [], [], []
        out_a: list[int] = []
        out_b: list[int] = []

        def near(size: int, bits: bytes, i: int) -> bool:
            both = size + sizes[i]
            return not bits or not marks[i] or slots_apart(bits, marks[i]) <= both - 2 * -(-percent * both // (100 + percent))

        def close() -> None:
            if members:
                tree = PrefixTree(members, sizes)
                hit = sorted({nodes[i] for probe, size, bits in probes for i in tree.matches(probe, size, percent) if near(size, bits, i)})
                out_a.extend([group[0]] * len(hit))
                out_b.extend(hit)

        for batch in batches:
            a, block, role, b, n = (batch.column(i).to_pylist() for i in range(5))
            bits = batch.column(6).to_pylist()
            lists = batch.column(5)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])
            for i in range(batch.num_rows):
                if (a[i], block[i]) != group:
                    close()
                    group, probes, nodes, members, sizes, marks = (a[i], block[i]), [], [], [], [], []
                grams = flat[bounds[i] : bounds[i + 1]].copy()
                if role[i] == 0:
                    probes.append((grams, n[i], bits[i]))
                else:
                    nodes.append(b[i])
                    members.append(grams)
                    sizes.append(n[i])
                    marks.append(bits[i])
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])
            out_a.clear()
            out_b.clear()
        close()
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"])

    dealt_rows = rows.repartition(partitions(spark), "a", "block").sortWithinPartitions("a", "block", "role")
    return dealt_rows.mapInArrow(check, "a long, b long")


def _bit_matrix(bits: list[bytes], size: int) -> np.ndarray:
    """Parities as rows of 64-bit words, those twice as long folded to `size` bytes."""
    rows = np.frombuffer(b"".join(b if len(b) == size else b[:size] for b in bits), "<u8").reshape(len(bits), -1)
    rest = np.frombuffer(b"".join(bytes(size) if len(b) == size else b[size:] for b in bits), "<u8").reshape(len(bits), -1)
    return rows ^ rest


def near_in_group(side: np.ndarray, n: np.ndarray, component: np.ndarray, bits: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Pairs (i, j) of rows whose sizes and parities allow a link, in different components, from the two sides if there are two."""
    length = np.array([len(b) for b in bits])
    found = []
    for size in np.unique(length).tolist():
        first, second = np.flatnonzero(length == size), np.flatnonzero((length == size) | (length == 2 * size))
        x, y = (_bit_matrix([bits[i] for i in rows.tolist()], size) for rows in (first, second))
        for begin in range(0, len(first), 256):
            own = first[begin : begin + 256]
            apart = sum(np.bitwise_count(x[begin : begin + 256, w, None] ^ y[None, :, w]).astype(np.int32) for w in range(x.shape[1]))
            both = n[own][:, None] + n[second][None, :]
            room = both - 2 * -(-percent * both // (100 + percent))
            fits = (apart <= room) & (component[own][:, None] != component[second][None, :])
            fits &= (n[own][:, None] * 100 >= n[second][None, :] * percent) & (n[second][None, :] * 100 >= n[own][:, None] * percent)
            if len(np.unique(side)) > 1:
                fits &= side[own][:, None] != side[second][None, :]
            i, j = np.nonzero(fits)
            found += zip(own[i].tolist(), second[j].tolist())
    return found


def near_in_buckets(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of members of one bucket that may link, from (gram, node, n, component, bits).

    Members are compared by size and parities in the task that gets their bucket, so pairs that cannot link never
    become rows. A bucket of over BUCKET members is dealt in blocks, and each pair of blocks is a task.
    """
    spark = rows.sparkSession
    blocks = stage(rows.groupBy("gram").agg(F.ceil(F.count(F.lit(1)) / BUCKET).cast("int").alias("blocks")), "blocks")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    partners = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(own, j).alias("x"), F.greatest(own, j).alias("y"))
    )
    dealt = rows.join(blocks, "gram").withColumn("side", own).withColumn("task", F.explode(partners))
    dealt = dealt.select("gram", "task.x", "task.y", "side", "node", "n", "component", "bits")
    dealt = dealt.repartition(partitions(spark), "gram", "x", "y").sortWithinPartitions("gram", "x", "y")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []

        def close() -> pa.RecordBatch:
            side, node, n, component, bits = zip(*held)
            pairs = near_in_group(*(np.array(c, np.int64) for c in (side, n, component)), list(bits), percent) if len(held) > 1 else []
            a, b = ([node[p[k]] for p in pairs] for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            for *key, side, node, n, component, bits in zip(*(batch.column(i).to_pylist() for i in range(8))):
                if key != group:
                    if held:
                        yield close()
                    group, held = key, []
                held.append((side, node, n, component, bits))
        if held:
            yield close()

    found = dealt.mapInArrow(compare, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a != b").distinct()


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are not in one component yet."""
    one = labels.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    two = labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    known = pairs.join(one, "a", "left").join(two, "b", "left")
    return known.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def _fitting(percent: int):
    """Of two members x and y of a bucket: sizes that allow a link, and the bucket among the first of the smaller one."""
    x, y = F.col("x.n"), F.col("y.n")
    near = (x * 100 >= y * percent) & (y * 100 >= x * percent)

    def early(side: str):
        n, at = F.col(f"{side}.n"), F.col(f"{side}.at")
        return at <= n - F.ceil(2 * percent * n / (100 + percent))

    return near & (((x >= y) & early("y")) | ((y >= x) & early("x")))


def similar_documents(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row: sets of word n-grams that link, and their components.

    Two documents link when 100 * common >= percent * united n-grams. Equal sets are one class, and only
    classes are compared. Every n-gram of a set's prefix is a bucket. In buckets of up to SMALL members all
    pairs of fitting sizes are candidates, in larger ones the pairs with the smallest member, then with the largest
    of what is still apart, then all that are still in different components, by sizes and parities inside a task: a
    large group of near copies makes a few rows a member, and no candidate is dropped. Candidates are tried on prefixes first and on whole
    sets next. Null or empty texts have no n-grams, link with nothing and are their own component; a null id has
    a null component. Rows that share an id share the component. An empty table gives an empty table; other columns
    are not looked at.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    frequent = frequent_ngrams(docs, n)
    prefixes = stage(ordered_sets(docs, n, percent, frequent, whole=False), "prefixes")
    real = prefixes.where("n > 0 AND doc_id IS NOT NULL")
    classes = stage(real.groupBy("k1", "k2").agg(F.min("doc_id").alias("node")), "classes")
    heads = real.join(classes, ["k1", "k2"]).where("doc_id = node").dropDuplicates(["k1", "k2"])
    heads = stage(heads.select("node", "n", "grams", "bits"), "heads")
    ids = stage(prefixes.drop("grams", "bits"), "ids")
    real = ids.where("n > 0 AND doc_id IS NOT NULL")
    drop_staged(prefixes)
    grams = heads.select("node", F.posexplode("grams").alias("at", "gram"), "n")
    # The size of the set and the place in it as one number: this is the largest table that is shuffled.
    grams = grams.select("gram", "node", (F.col("n") * AT_MOST + F.col("at")).alias("spot"))
    buckets = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    buckets = stage(buckets, "buckets")  # on its own, so that the join can split a frequent n-gram
    shared = grams.join(buckets, "gram").select(
        "gram", "node", "members", F.floor(F.col("spot") / AT_MOST).alias("n"), (F.col("spot") % AT_MOST).alias("at")
    )
    shared = stage(shared, "shared")
    small, large = shared.where(F.col("members") <= SMALL), stage(shared.where(F.col("members") > SMALL), "large")
    fitting = _fitting(percent)

    both = small.alias("x").join(small.alias("y"), F.col("x.gram") == F.col("y.gram"))
    pairs = both.where(fitting & (F.col("x.node") < F.col("y.node"))).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    leads = large.groupBy("gram").agg(F.min(F.struct("node", "n", "at")).alias("lead")).select("gram", "lead.*")
    star = large.alias("x").join(leads.alias("y"), F.col("x.gram") == F.col("y.gram"))
    star = star.where(fitting & (F.col("x.node") != F.col("y.node"))).select(F.col("y.node").alias("a"), F.col("x.node").alias("b"))
    pairs = stage(linked(stage(pairs.unionByName(star).distinct(), "pairs"), heads, percent), "candidates")

    def sets_of(pairs: DataFrame) -> DataFrame:
        """The whole sets of the classes in pairs."""
        nodes = stage(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
        texts = docs.where("doc_id IS NOT NULL").join(nodes, F.col("doc_id") == F.col("node"), "left_semi")
        sets = ordered_sets(texts, n, percent, frequent, whole=True).join(classes, ["k1", "k2"])
        return stage(sets.where("doc_id = node").dropDuplicates(["k1", "k2"]).select("node", "n", "grams", "bits"), "sets")

    sets = sets_of(pairs)
    # A document whose id stands for several texts ties their classes together.
    tied = real.join(classes, ["k1", "k2"]).groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    links = tied.where("a != b").select("a", "b")
    forest = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = stage(links.unionByName(linked(forest, sets, percent)), "links")
    labels = components(links)
    rest = stage(_apart(pairs, labels), "rest")
    links = stage(links.unionByName(linked(rest, sets, percent)), "links")
    labels = components(links)
    drop_staged(sets, pairs, rest)

    for last in (False, True):
        known = labels.select(F.col("node").alias("_node"), "component")
        at = large.join(known, F.col("node") == F.col("_node"), "left").select(
            "gram", "node", "n", "at", F.coalesce("component", "node").alias("component")
        )
        mixed = at.groupBy("gram").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi")
        at = stage(at.join(mixed.select("gram"), "gram"), "mixed")
        if last:
            more = near_in_buckets(at.join(heads.select("node", "bits"), "node"), percent)
        else:
            lead = at.groupBy("gram").agg(F.max(F.struct("component", "node", "n", "at")).alias("lead")).select("gram", "lead.*")
            more = at.alias("x").join(lead.alias("y"), F.col("x.gram") == F.col("y.gram"))
            more = more.where(fitting & (F.col("x.component") != F.col("y.component")))
            more = more.select(F.col("y.node").alias("a"), F.col("x.node").alias("b")).distinct()
        more = stage(linked(stage(more, "pairs"), heads, percent), "candidates")
        if not more.isEmpty():
            sets = sets_of(more)
            links = stage(links.unionByName(linked(more, sets, percent)), "links")
            labels = components(links)
            drop_staged(sets)

    drop_staged(heads, shared, large, buckets)
    named = ids.join(classes, ["k1", "k2"], "left")
    named = named.join(labels.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node"), "left")
    own = F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.coalesce("component", "node")).otherwise(F.col("doc_id"))
    return named.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs, all columns, whose id is the smallest of its component; rows without an id stay."""
    gone = similar_documents(docs, n, percent).where("component_id != doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
