"""Near duplicates among vectors of one label, by traversing pairs of cover trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.llm.components import components
from vecloom.sources.staging import stage

COSINE = 0.98
# Radii of the levels of a tree, each half of the one before; unit vectors lie within 2 of one another.
RADII = (1.0, 0.5, 0.25)
# Rows of a tree, and rows that a cell should hold.
BLOCK = 2_000
CELL = 20_000
# Rows from which the first centres are taken (the smallest by hash), and centres at most.
SAMPLE = 20_000
CENTRES = 1_000
ROUNDING = 1e-7


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Chords between unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


class CoverTree:
    """Nested levels of centres with halving radii; the last level has every row.

    centres[k]: rows that are centres of level k; up[k]: for each, its parent's place in level k - 1;
    reach[k]: how far the rows below it lie at most.
    """

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.centres: list[np.ndarray] = []
        self.up: list[np.ndarray] = []
        self.reach: list[np.ndarray] = []
        groups = [np.arange(len(rows))]
        for radius in RADII:
            centres, up, reach, below = [], [], [], []
            for parent, group in enumerate(groups):
                left = group
                while len(left):
                    far = distances(rows[left[:1]], rows[left])[0] if len(left) > 1 else np.zeros(1)
                    near = far <= radius
                    near[0] = True
                    centres.append(left[0])
                    up.append(parent)
                    reach.append(far[near].max())
                    below.append(left[near])
                    left = left[~near]
            self.centres.append(np.array(centres))
            self.up.append(np.array(up))
            self.reach.append(np.array(reach))
            groups = below
        self.centres.append(np.concatenate(groups))
        self.up.append(np.repeat(np.arange(len(groups)), [len(g) for g in groups]))
        self.reach.append(np.zeros(len(rows)))


def close_pairs(a: CoverTree, b: CoverTree, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i of a, j of b) with at least this cosine: pairs of nodes go on while their rows may be near enough.

    Two nodes part when their centres lie farther apart than both reaches and the distance asked.
    """
    far = np.sqrt(2 - 2 * cosine) + ROUNDING
    pairs = np.zeros((1, 2), np.int64)
    for level in range(len(RADII) + 1):
        ca, cb = a.centres[level], b.centres[level]
        kids = np.split(np.arange(len(cb)), np.searchsorted(b.up[level], np.arange(1, b.up[level].max() + 1)))
        firsts = np.searchsorted(a.up[level], np.arange(a.up[level].max() + 2))
        partners = np.split(pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(1, len(firsts) - 1)))
        found = []
        for parent, others in enumerate(partners):
            if not len(others):
                continue
            x = np.arange(firsts[parent], firsts[parent + 1])
            y = np.concatenate([kids[o] for o in others.tolist()])
            apart = distances(a.rows[ca[x]], b.rows[cb[y]]) - a.reach[level][x][:, None] - b.reach[level][y][None, :]
            i, j = np.nonzero(apart <= far)
            found.append(np.stack([x[i], y[j]], 1))
        pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        if not len(pairs):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
    i, j = a.centres[-1][pairs[:, 0]], b.centres[-1][pairs[:, 1]]
    keep = np.concatenate(
        [np.einsum("ij,ij->i", a.rows[i[k : k + 100_000]], b.rows[j[k : k + 100_000]]) >= cosine for k in range(0, len(i), 100_000)]
    )
    return i[keep], j[keep]


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row that each of n rows reaches through the pairs."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, i, label[j])
        np.minimum.at(new, j, label[i])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _valid(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, embedding as doubles): vectors that can link."""
    x = F.col("embedding").cast("array<double>")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    rows = vectors.select("vec_id", F.col("label"), x.alias("embedding"))
    return rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(sound, F.lit(False)))


def first_centres(classes: DataFrame) -> dict[tuple, np.ndarray]:
    """Centres of the first level for labels with more rows than a cell, by (label, length of vector).

    The farthest row of a bounded sample comes next, so centres spread like those of a tree's level.
    """
    sizes = classes.groupBy("label", "width").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CELL)
    large = sizes.orderBy(F.desc("n")).limit(CENTRES // 2).toPandas()
    if not len(large):
        return {}
    sample = classes.join(F.broadcast(sizes.select("label", "width").limit(CENTRES // 2)), ["label", "width"])
    sample = sample.orderBy(F.xxhash64("node")).limit(SAMPLE).select("label", "width", "embedding").toArrow()
    rows = list(zip(sample.column("label").to_pylist(), sample.column("width").to_pylist()))
    out = {}
    for label, width, n in large.itertuples(index=False):
        own = [i for i, key in enumerate(rows) if key == (label, width)]
        wanted = min(len(own) // 10, int(n) // CELL + 1, max(1, int(CENTRES * n // large["n"].sum())))
        if wanted > 1:
            x = unit(_matrix(sample.column("embedding").take(own)))
            chosen = [0]
            far = distances(x[:1], x)[0]
            while len(chosen) < wanted:
                chosen.append(int(far.argmax()))
                far = np.minimum(far, distances(x[chosen[-1:]], x)[0])
            out[label, width] = x[chosen]
    return out


def cells(classes: DataFrame, centres: dict[tuple, np.ndarray], reach: dict[tuple, float] | None, cosine: float) -> DataFrame:
    """Classes with their cell (the nearest centre) and how far off it is (-1 without centres); or, given the cells'
    reaches, with the cells of smaller number that may hold a partner."""
    far = np.sqrt(2 - 2 * cosine) + ROUNDING

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for (label, width), part in frame.groupby(["label", "width"]):
                if (label, width) not in centres:
                    if reach is None:
                        yield part.assign(cell=0, off=-1.0)
                    continue
                apart = distances(unit(np.stack(part["embedding"])), centres[label, width])
                home = apart.argmin(1)
                if reach is None:
                    yield part.assign(cell=home, off=apart[np.arange(len(part)), home])
                else:
                    bound = np.array([reach.get((label, width, c), -10.0) for c in range(apart.shape[1])])
                    visit = (apart <= bound + far) & (np.arange(apart.shape[1])[None, :] < home[:, None])
                    i, c = np.nonzero(visit)
                    yield part.iloc[i].assign(cell=c, off=apart[i, c])

    kind = classes.schema["label"].dataType.simpleString()
    columns = classes.select("label", "width", "node", "size", "embedding")
    return columns.mapInPandas(place, f"label {kind}, width int, node long, size long, embedding array<double>, cell int, off double")


def links(classes: DataFrame, cosine: float) -> DataFrame:
    """(node, n, root): from each pair of blocks, how many vectors each class links with, and a class it is tied to.

    A cell's rows are dealt in blocks; each pair of blocks of the cell, and each block with each block of visitors from
    other cells, is a task. What a task returns is one row a class, however many pairs there are.
    """
    centres = first_centres(classes)
    home = stage(cells(classes, centres, None, cosine), "cells")
    found = home.where(F.col("off") >= 0).groupBy("label", "width", "cell").agg(F.max("off").alias("reach"))
    reach = {}
    if centres:
        reach = {(r["label"], r["width"], r["cell"]): r["reach"] for r in found.collect()}  # at most CENTRES rows
    guests = stage(cells(classes, centres, reach, cosine), "visits")
    spot = ["label", "width", "cell"]
    n_home = home.groupBy(*spot).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    n_guests = guests.groupBy(*spot).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("visits"))
    counts = stage(n_home.join(n_guests, spot, "left").na.fill(0, ["visits"]), "blocks")
    row = F.xxhash64("node")
    own = F.pmod(row, F.col("blocks")).cast("int")
    with_home = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(own, j).alias("x"), F.greatest(own, j).alias("y"))
    )
    with_guests = F.when(
        F.col("visits") > 0,
        F.transform(F.sequence(F.lit(0), F.greatest(F.col("visits") - 1, F.lit(0))), lambda v: F.struct(own.alias("x"), (-1 - v).alias("y"))),
    ).otherwise(F.array().cast("array<struct<x:int,y:int>>"))
    mine = home.join(counts, spot).withColumn("block", own).withColumn("task", F.explode(F.concat(with_home, with_guests)))
    guest = F.pmod(row, F.col("visits")).cast("int")
    theirs = guests.join(counts, spot).withColumn("block", -1 - guest)
    theirs = theirs.withColumn(
        "task", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(j.alias("x"), F.col("block").alias("y"))))
    )
    columns = [*spot, "task.x", "task.y", "block", "node", "size", "embedding"]
    tasks = mine.select(*columns).unionByName(theirs.select(*columns))

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        block = rows.column("block").to_numpy()
        x, y = key[3].as_py(), key[4].as_py()
        node, size = rows.column("node").to_numpy(), rows.column("size").to_numpy()
        vectors = unit(_matrix(rows.column("embedding")))
        one, two = np.flatnonzero(block == x), np.flatnonzero(block == y)
        if not len(one) or not len(two):
            return pa.table({"node": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        a = CoverTree(vectors[one])
        i, j = close_pairs(a, a if x == y else CoverTree(vectors[two]), cosine)
        i, j = one[i], two[j]
        if x == y:
            i, j = i[i != j], j[i != j]
        n = np.bincount(i, size[j], len(node)).astype(np.int64)
        if x != y:
            n += np.bincount(j, size[i], len(node)).astype(np.int64)
        hit = np.flatnonzero(n)
        root = roots(len(node), i, j)
        return pa.table({"node": node[hit], "n": n[hit], "root": node[root[hit]]})

    return tasks.groupBy(*spot, "x", "y").applyInArrow(compare, "node long, n long, root long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of (vec_id, embedding, label).

    Vectors link when their labels are equal and their cosine, in double precision, is at least `cosine`. Equal
    vectors are one class; only classes are compared, exactly. Vectors that are null, all zero or hold null or
    non-finite numbers, and those without a label, link with nothing; vectors of different lengths do not link.
    component_id is the smallest vec_id reachable; kept marks it. Rows of one vec_id are vectors of their own each. A
    null vec_id is a vector too, but no component's name: a component of such rows alone has none (null, not kept). An empty table gives an empty table; other columns are not
    looked at.
    """
    real = _valid(vectors)
    classes = real.groupBy("label", "embedding").agg(F.min("vec_id").cast("long").alias("first"), F.count(F.lit(1)).alias("size"))
    # Classes have numbers of their own, as ids may repeat; the numbers stay, as the table is written.
    classes = stage(classes.withColumns({"width": F.size("embedding"), "node": F.monotonically_increasing_id()}), "classes")
    found = stage(links(classes.drop("first"), cosine), "links")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    labels = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    members = classes.select("node", "first").join(labels, "node", "left").select("node", "first", F.coalesce("component", "node").alias("component"))
    members = stage(members, "members")
    lowest = stage(members.groupBy("component").agg(F.min("first").alias("component_id")), "lowest")
    members = members.join(lowest, "component").select("node", "component_id")
    known = classes.join(counts, "node", "left").join(members, "node").select(
        F.col("label").alias("_label"),
        F.col("embedding").alias("_embedding"),
        (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        "component_id",
    )
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    joined = rows.join(known, (F.col("label") == F.col("_label")) & (F.col("embedding") == F.col("_embedding")), "left")
    component = F.coalesce("component_id", F.col("vec_id").cast("long"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
