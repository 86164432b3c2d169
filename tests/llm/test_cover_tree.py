from __future__ import annotations

import numpy as np
import pytest
from vecloom.llm import cover_tree

SCHEMA = "vec_id long, embedding array<float>, label int, node string, size string, cell string, n string, width string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e") for r in rows], SCHEMA)


def rows_with_copies():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 8))
    near = np.repeat(base[:20], 6, 0) + rng.normal(scale=0.06, size=(120, 8))
    x = np.concatenate([base, near, base[:5], 3 * base[:5], -base[:2]]).astype(np.float32)
    rows = [(int(i), [float(v) for v in e], int(i % 2)) for i, e in zip(rng.permutation(len(x)), x)]
    rows += [(1_000 + k, rows[3][1], rows[3][2]) for k in range(4)]  # copies
    rows += [(2_000, rows[3][1], None), (2_001, None, 0), (2_002, [0.0] * 8, 0), (2_003, [float("nan")] * 8, 0)]
    rows += [(2_004, [1.0, None] + [0.0] * 6, 0), (2_005, [float("inf")] + [0.0] * 7, 0), (2_006, [], 0), (2_007, [1.0, 2.0], 0)]
    rows += [(None, rows[3][1], rows[3][2]), (1_000, rows[3][1], rows[3][2])]  # no id, repeated row
    return rows


def brute(rows):
    def sound(e):
        return e is not None and len(e) and all(v is not None and np.isfinite(v) for v in e) and any(e)

    parent = {r[0]: r[0] for r in rows if r[0] is not None}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    n = [0] * len(rows)
    for a, (i, x, l) in enumerate(rows):
        for b, (j, y, m) in enumerate(rows):
            if a != b and l is not None and l == m and sound(x) and sound(y) and len(x) == len(y):
                p, q = np.array(x, float), np.array(y, float)
                if p @ q / np.sqrt((p @ p) * (q @ q)) >= 0.98:
                    n[a] += 1
                    if i is not None and j is not None:
                        parent[max(find(i), find(j))] = min(find(i), find(j))
    return [(i, k, None if i is None else find(i)) for (i, _, _), k in zip(rows, n)]


@pytest.mark.parametrize(("block", "cell"), [(2_000, 20_000), (10, 30)])
def test_equals_brute_force(spark, monkeypatch, block, cell):
    monkeypatch.setattr(cover_tree, "BLOCK", block)
    monkeypatch.setattr(cover_tree, "CELL", cell)
    rows = rows_with_copies()
    found = cover_tree.near_duplicates(table(spark, rows)).collect()
    expected = brute(rows)
    with_id = lambda xs: sorted(x for x in xs if x[0] is not None)
    assert with_id((r.vec_id, r.n_links, r.component_id) for r in found) == with_id(expected)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in found)
    lost = [(r.n_links, r.kept) for r in found if r.vec_id is None]
    assert lost == [(k, False) for i, k, _ in expected if i is None]


def test_lone_centre_with_a_partner_in_a_later_cell(spark, monkeypatch):
    angles = [0.0, 0.15, 0.2]
    x = np.array([[np.cos(a), np.sin(a)] for a in angles])
    monkeypatch.setattr(cover_tree, "first_centres", lambda classes: {(0, 2): x[[0, 2]]})
    rows = [(i, [float(v) for v in e], 0) for i, e in enumerate(x)]
    found = cover_tree.near_duplicates(table(spark, rows)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in found) == brute(rows)


@pytest.mark.parametrize("spread", [0.02, 0.2, 2.0])
def test_trees_find_all_pairs(spread):
    rng = np.random.default_rng(2)
    x = cover_tree.unit(np.ones((1, 6)) + rng.normal(scale=spread, size=(150, 6)))
    y = cover_tree.unit(np.ones((1, 6)) + rng.normal(scale=spread, size=(90, 6)))
    i, j = cover_tree.close_pairs(cover_tree.CoverTree(x), cover_tree.CoverTree(y), 0.98)
    assert sorted(zip(i.tolist(), j.tolist())) == [tuple(p) for p in np.argwhere(x @ y.T >= 0.98).tolist()]


def test_empty(spark):
    assert cover_tree.near_duplicates(table(spark, [])).count() == 0


def test_repeated_ids_are_vectors_of_their_own(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.001]), (3, [0.001, 1.0]), (None, [1.0, 0.002]), (None, [-1.0, 0.0]), (4, [0.0, -1.0])]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, label int")
    found = [tuple(r) for r in cover_tree.near_duplicates(table).select("vec_id", "n_links", "component_id", "kept").collect()]
    assert sorted(found, key=str) == sorted(
        [(1, 2, 1, True), (1, 1, 1, True), (2, 2, 1, False), (3, 1, 1, False), (None, 2, 1, False), (None, 0, None, False), (4, 0, 4, True)], key=str
    )
