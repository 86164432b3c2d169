from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from vecloom.llm.packing import pack_pieces, sum_of_squares, token_pieces
from vecloom.llm.queries import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


def test_tokens_are_those_of_the_tokenizer(odd, texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(PATH)
    found = defaultdict(list)
    for r in token_pieces(odd, PATH, 50).collect():
        found[r.doc_id].append((r.start, r.length, np.frombuffer(r.ids, "<u4").tolist()))
    expected = defaultdict(list)
    for i, t in texts:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [0]
        expected[i] += [(k, len(ids[k : k + 50]), ids[k : k + 50]) for k in range(0, len(ids), 50)]
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}


@pytest.mark.parametrize(
    "text",
    ["don't can't WE'LL it's", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "İstanbul Σίσυφος ΣΑΣ", "e\u0301 H\u0331 ﬁ", "12ab3.5 a_b-c --- ...", "ÀÉÎ straße, çedilla. ŉ ǆ"],
)
def test_words_stand_for_themselves(text):
    import pyarrow as pa
    from tokenizers import Tokenizer
    from vecloom.llm.packing import WordTokens

    ids, bounds = WordTokens(PATH).texts(pa.array([text, None, text]), 0)
    expected = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids + [0]
    assert ids.tolist() == [*expected, 0, *expected]
    assert bounds.tolist() == [0, len(expected), len(expected) + 1, 2 * len(expected) + 1]


def check(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packs_every_row_once(spark):
    rng = np.random.default_rng(3)
    sizes = [2048, 2048, 1, 1] + rng.integers(1, 2049, 2_000).tolist()
    pieces = spark.createDataFrame([(i, int(s), "x", 5) for i, s in enumerate(sizes)], "doc_id long, length long, bin string, at int")
    rows = pack_pieces(pieces).collect()
    assert sorted((r.doc_id, r.length) for r in rows) == list(enumerate(sizes))
    least = -(-sum(sizes) // 2048)
    assert check(rows, 2048) <= 1.06 * least


def brute(sizes, capacity):
    """The rule by its words: try every bin, and a new one; the smallest sum of squared counts wins, then the least room."""
    rooms, out = [], []
    for s in sorted(sizes, reverse=True):
        best = None
        for i in [*range(len(rooms)), None]:
            room = capacity if i is None else rooms[i]
            if room < s:
                continue
            left = [r for k, r in enumerate(rooms) if k != i] + [room - s]
            squares = sum(sum(1 for r in left if r == g) ** 2 for g in set(left) if g)
            if best is None or (squares, room) < best[0]:
                best = ((squares, room), i)
        if best[1] is None:
            rooms.append(capacity - s)
        else:
            rooms[best[1]] -= s
        out.append(sorted(rooms))
    return rooms


@pytest.mark.parametrize("seed", range(5))
def test_follows_the_rule(seed):
    sizes = np.random.default_rng(seed).integers(1, 21, 60)
    _, _, fill = sum_of_squares(sizes, 20)
    assert sorted(20 - fill) == sorted(brute(sizes.tolist(), 20))


def test_empty(none):
    assert pack_pieces(token_pieces(none, PATH)).count() == 0
