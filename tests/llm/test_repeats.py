from __future__ import annotations

from collections import Counter

import pytest
from vecloom.llm import repeats


def brute(rows, length=200):
    raw = [(t or "").encode() for _, t in rows]
    count = Counter(b[p : p + length] for b in raw for p in range(len(b) - length + 1))
    out = []
    for (i, _), b in zip(rows, raw):
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            if count[b[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def rows_of(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect()), key=repr)


SHORT = lambda texts: [(i, t if t is None or len(t) < 20_000 else t[:9_000]) for i, t in texts]


@pytest.mark.parametrize("members", [1, 1_000])
def test_equals_brute_force(spark, texts, monkeypatch, members):
    from conftest import frame

    monkeypatch.setattr(repeats, "MEMBERS", members)
    rows = SHORT(texts)
    same = "z" * 450  # repeats itself inside one document
    common = "The same passage of text that stands in several documents, with other words on either side of it each time. " * 2
    rows += [(20, same), (21, f"left {common} right"), (22, f"other left {common} other right"), (23, f"ä{common}"), (24, common[:199])]
    assert rows_of(repeats.remove_repeats(frame(spark, rows))) == sorted(brute(rows), key=repr)


def test_long_texts_in_chunks(spark, monkeypatch):
    from conftest import frame, prose

    monkeypatch.setattr(repeats, "CHUNK", 1_000)
    rows = [(1, prose(7, 900)), (2, prose(8, 300) + prose(7, 900)[500:3_000])]
    assert rows_of(repeats.remove_repeats(frame(spark, rows))) == sorted(brute(rows), key=repr)


@pytest.mark.parametrize("size", [60, 130, 190, 230, 420])
def test_a_common_passage_is_not_dealt_out_in_strings(spark, monkeypatch, size):
    """Each text has the passage between words of its own, some of them twice: few rows a class, whatever their strings."""
    from conftest import frame, prose

    monkeypatch.setattr(repeats, "MEMBERS", 4)
    passage = prose(1, 200)[:size]
    rows = [(i, f"{prose(100 + i, 60)[:300]}{passage}{prose(300 + i % 35, 60)[:300]}") for i in range(40)]
    rows += [(50, passage[:-3] * 3), (51, prose(400, 60)[:300] + passage)]
    made = {}

    def counted(df, name, stage=repeats.stage):
        made.setdefault(name, []).append((out := stage(df, name)).count())
        return out

    monkeypatch.setattr(repeats, "stage", counted)
    assert rows_of(repeats.remove_repeats(frame(spark, rows))) == sorted(brute(rows), key=repr)
    dealt = sum(sum(n) for name, n in made.items() if name in ("strings", "halves"))
    assert dealt <= 20 * sum(made["surroundings"])


def test_empty(none):
    assert repeats.remove_repeats(none).count() == 0
