from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from vecloom.llm import alignment
from vecloom.llm.queries import QUERIES, tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def whole(texts):
    """Groups of each text by the tokenizers on the whole text and a plain set intersection."""
    aligner = alignment.Aligner(A, B)
    out = []
    for text in texts:
        ids_a = aligner.a.encode(f" {text or ''}", add_special_tokens=False).ids
        ids_b = aligner.b.encode(text or "")
        raw = f" {text or ''}".encode()
        tokens = [[aligner.bytes_a[i] for i in ids_a], [aligner.bytes_b[i] for i in ids_b]]
        if not text or any(b"".join(t) != raw for t in tokens):
            out.append(None)
            continue
        ends = [np.cumsum([len(x) for x in t]).tolist() for t in tokens]
        groups, at = [], [0, 0]
        place = [{end: k + 1 for k, end in enumerate(e)} for e in ends]
        for end in sorted(set(ends[0]) & set(ends[1])):
            to = [p[end] for p in place]
            groups.append((ids_a[at[0] : to[0]], ids_b[at[1] : to[1]]))
            at = to
        out.append((len(ids_a), len(ids_b), groups))
    return out


def brute(rows):
    found = whole([t for _, t in rows])
    count = Counter()
    for f in found:
        count.update({(a, b) for g in (f[2] if f else []) for a in g[0] for b in g[1]})
    most = {}
    for (a, _), n in count.items():
        most[a] = max(n, most.get(a, 0))
    out = []
    for (i, _), f in zip(rows, found):
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        links = [(a, b) for g in f[2] for a in g[0] for b in g[1]]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in f[2])
        out.append(
            (i, f[0], f[1], len(f[2]), len(links), sum(count[x] == most[x[0]] for x in links), sum(count[x] for x in links), hashlib.sha256(text.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def rows(found):
    return sorted((tuple(r[c] for c in NAMES) for r in found.collect()), key=repr)


def test_gallop():
    rng = random.Random(1)
    for _ in range(300):
        a, b = (sorted(rng.sample(range(60), rng.randint(0, 40))) for _ in range(2))
        expected = [(a.index(x), b.index(x)) for x in sorted(set(a) & set(b))]
        assert alignment.common_ends(a, b) == expected
        assert [(i, j) for i, j in alignment.gallop(a, b)] == expected
    assert alignment.gallop([5_000], list(range(10_000))) == [(0, 5_000)]


@pytest.mark.parametrize(
    "text",
    [
        "plain words, don't 12ab3.5 --- ...",
        "  two  blanks \n\n lines\n of text \t tab hard  wide end ",
        "<|endoftext|> <s> </s> <unk> <0x41> a<|endoftext|>b",
        "äöü ß ☃ 😀 é ​ \x1c \x85 x",
        "a▁b",
        " ",
        "\n",
        "x" * 3_000 + " " + "QmFzZTY0" * 2_000,
    ],
)
def test_parts_stand_for_whole_texts(spark, text):
    table = spark.createDataFrame([(1, text), (2, f"{text} {text}")], "doc_id long, text string")
    assert rows(alignment.alignments(table, A, B)) == brute([(1, text), (2, f"{text} {text}")])


def test_odd_rows(odd, none, texts):
    assert rows(alignment.alignments(odd, A, B)) == brute(texts)
    assert alignment.alignments(none, A, B).count() == 0


def test_table_agrees_with_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert rows(QUERIES["op13_cross_tokenizer_alignment"](spark, folder)) == brute(docs)


def test_memory_starts_anew(spark, monkeypatch):
    import pyarrow as pa

    aligner = alignment.Aligner(A, B)
    first = aligner.texts(pa.array(["one two", "two three"]))
    monkeypatch.setattr(alignment, "REMEMBERED", 1)
    again = aligner.texts(pa.array(["one two", "two three"]))
    assert first[1] == again[1] and (first[2] == again[2]).all()
