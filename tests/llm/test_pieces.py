from __future__ import annotations

import itertools
import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from vecloom.llm import pieces, queries
from vecloom.llm.queries import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(PATH, 4)


def every_path(vocabulary, word):
    arcs = vocabulary.arcs(word)
    out = []

    def walk(end, sizes, score):
        if not end:
            out.append((-score, sizes))
        for size, x, _ in arcs[end] if end else ():
            walk(end - size, (*sizes, size), score + x)

    walk(len(word), (), 0.0)
    return [(-score, list(sizes[::-1])) for score, sizes in sorted(out)]


def test_search_equals_every_path(encoder):
    rng = random.Random(1)
    words = ["▁"] + ["▁" + "".join(rng.choice('thereandingß☃ñ€"\n') for _ in range(rng.randint(0, 9))) for _ in range(150)]
    best, loss, ids, bounds = encoder.vocabulary.search(words)
    for i, word in enumerate(words):
        paths = every_path(encoder.vocabulary, word)
        assert encoder.vocabulary.n_best(word, 4) == paths[:4]
        assert (best[i], loss[i]) == (paths[0][0], paths[0][0] - paths[1][0] if len(paths) > 1 else np.inf)
        assert ids[bounds[i] : bounds[i + 1]].tolist() == encoder.vocabulary.ids(word, paths[0][1])


@pytest.mark.parametrize("text", [None, "", " ", "the cat", "a  b\n\nc x", " lead and trail ", "in the an", "😀 über"])
def test_n_best_of_texts(encoder, text):
    words = ["▁" + w for w in ("▁" + (text or "").replace(" ", "▁")).split("▁")[1:]]
    options = [every_path(encoder.vocabulary, w)[:6] for w in words]
    sums = sorted((-sum(x[0] for x in choice) for choice in itertools.product(*options)))
    (found,) = encoder.texts(pa.array([text], pa.string()))
    assert [s for s, _ in found] == [-x for x in sums[:4]]
    assert len({i.tobytes() for _, i in found}) == len(found)
    assert {encoder.vocabulary.decode(i.tolist()) for _, i in found} == {text or ""}


@pytest.mark.parametrize("text", ["2.0.", "a 7 b", "x  y", "5", " "])
def test_a_blank_alone_is_a_piece(encoder, text):
    """As the library of the model has it: no byte pieces for blanks."""
    blank = encoder.vocabulary.piece["▁"]
    word = "▁" + text.split(" ")[-1]
    assert encoder.vocabulary.n_best(word, 1)[0][1][0] >= 1
    ids = encoder.vocabulary.ids(word, encoder.vocabulary.n_best(word, 1)[0][1])
    assert not set(ids) & {encoder.vocabulary.byte_ids[b] for b in "▁".encode()}
    assert ids[0] == blank or encoder.vocabulary.texts[ids[0]].startswith("▁")


def test_round_trip_of_odd_rows(odd, none, texts):
    found = pieces.encode(odd, PATH, 3)
    back = defaultdict(set)
    for r in pieces.decode(found, PATH).collect():
        back[r.doc_id].add(r.text)
    expected = defaultdict(set)
    for i, t in texts:
        expected[i].add(t or "")
    assert back == expected
    assert found.where("rank = 0").count() == len(texts)
    assert pieces.encode(none, PATH).count() == 0


def test_long_text_without_blanks(encoder):
    rng = random.Random(6)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/") for _ in range(100_000))
    tracemalloc.start()
    n_best = encoder.vocabulary.n_best("▁" + text, 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400_000_000
    scores = [s for s, _ in n_best]
    assert len(n_best) == 4 and scores == sorted(scores, reverse=True) and len({tuple(x) for _, x in n_best}) == 4
    (found,) = encoder.texts(pa.array([text]))
    assert [s for s, _ in found] == scores
    assert {encoder.vocabulary.decode(i.tolist()) for _, i in found} == {text}


def test_equal_paths_of_a_long_word(encoder):
    word = "▁" + "a" * 14
    assert encoder.vocabulary.n_best(word, 50) == every_path(encoder.vocabulary, word)[:50]


def test_decodes_many(encoder):
    rng = random.Random(8)
    rows = [[rng.randrange(len(encoder.vocabulary.texts)) for _ in range(rng.randint(0, 9))] for _ in range(200)]
    byte = encoder.vocabulary.byte_ids
    rows += [[byte[0xE2], byte[0x96], byte[0x81]], [byte[0xC3]], [byte[b] for b in "☃ é".encode()]]
    for some in (rows, [encoder.vocabulary.ids(w, [1] * len(w)) for w in ("▁", "▁▁a▁", "▁\n b☃")]):
        coded = pa.array([np.array(r, "<u4").tobytes() for r in some] + [None], pa.binary())
        assert encoder.vocabulary.decode_many(coded).to_pylist() == [encoder.vocabulary.decode(r) for r in some] + [None]


def test_query_decodes_the_whole_table(spark, folder):
    found = queries.op4_sentencepiece_nbest(spark, folder)
    texts = {r.doc_id: zlib.crc32((r.text or "").encode()) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = found.collect()
    assert {r.doc_id for r in rows} == set(texts) and all(r.text_crc32 == texts[r.doc_id] for r in rows)
