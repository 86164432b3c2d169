from __future__ import annotations

import re

import numpy as np
import pytest
from conftest import frame, prose
from vecloom.llm import ngram_join


def brute_sets(rows, n):
    sets = []
    for _, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)} - {()})
    return sets


def brute(rows, n, percent):
    sets = brute_sets(rows, n)
    parent = {i: i for i, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, _) in enumerate(rows):
        for y, (j, _) in enumerate(rows[:x]):
            if i is not None and j is not None and sets[x] and sets[y]:
                if 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                    a, b = find(i), find(j)
                    parent[max(a, b)] = min(a, b)
    return sorted(((i, len(s), None if i is None else find(i)) for (i, _), s in zip(rows, sets)), key=repr)


def family():
    """Near copies whose ends differ too much to link directly, and texts that share a passage only."""
    words = prose(9, 200).split()
    rows = []
    for k in range(12):
        words = list(words)
        words[10 * k + 5] = f"new{k}"
        rows.append((100 + k, " ".join(words)))
    passage = prose(10, 30)
    rows += [(200 + k, f"{prose(20 + k, 40)} {passage}") for k in range(8)]
    rows += [(300, passage), (301, passage + " more"), (302, "Word"), (303, "word"), (304, "word word"), (305, "WORD word")]
    return rows


@pytest.mark.parametrize(("n", "percent", "small"), [(3, 90, 16), (5, 80, 16), (3, 90, 1), (3, 60, 1)])
def test_equals_brute_force(spark, texts, monkeypatch, n, percent, small):
    monkeypatch.setattr(ngram_join, "SMALL", small)
    monkeypatch.setattr(ngram_join, "TREE_ROWS", 3)
    monkeypatch.setattr(ngram_join, "BUCKET", 5)
    rows = [(i, t if t is None or len(t) < 9_000 else t[:9_000]) for i, t in texts] + family()
    found = ngram_join.similar_documents(frame(spark, rows), n, percent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr) == brute(rows, n, percent)


def test_tree_finds_what_pairs_find():
    rng = np.random.default_rng(1)
    base = np.sort(rng.choice(1_000, 80, replace=False))
    sets = []
    for _ in range(60):
        own = np.where(rng.random(80) < rng.choice([0.02, 0.1]), rng.integers(0, 1_000, 80), base)
        sets.append(np.unique(own).astype(np.int64))
    tree = ngram_join.PrefixTree(sets, [len(s) for s in sets])
    for probe in sets:
        expected = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(s, probe)) >= 80 * len(np.union1d(s, probe))]
        assert sorted(tree.matches(probe, len(probe), 80, step=7)) == expected
    cut = [s[: len(s) - -(-80 * len(s) // 100) + 1] for s in sets]
    prefixes = ngram_join.PrefixTree(cut, [len(s) for s in sets])
    for probe, whole in zip(cut, sets):  # prefixes never lose a link
        expected = {i for i, s in enumerate(sets) if 100 * len(np.intersect1d(s, whole)) >= 80 * len(np.union1d(s, whole))}
        assert expected <= set(prefixes.matches(probe, len(whole), 80, step=5))


def test_one_of_each_keeps_columns_and_rows_without_id(spark, odd, none):
    kept = ngram_join.one_of_each(odd, 5, 80)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted((i for i in ids if i is not None)) == [1, 2, 3, 4, 4, 5, 6, 10, 11, 12, 13, 14] and ids.count(None) == 2
    assert ngram_join.similar_documents(none).count() == 0


@pytest.mark.parametrize("sizes", [(40, 40), (100, 130), (5, 5_000), (0, 3)])
def test_parities_never_count_too_many(sizes):
    rng = np.random.default_rng(4)
    for shared in {0, min(sizes) // 2, min(sizes)}:
        common = rng.integers(0, 1 << 62, shared, dtype=np.uint64)
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 1 << 62, n - shared, dtype=np.uint64)])) for n in sizes)
        apart = ngram_join.slots_apart(ngram_join.parities(a), ngram_join.parities(b))
        assert apart <= len(np.setxor1d(a, b))
        if shared == min(sizes) == max(sizes):
            assert apart == 0
