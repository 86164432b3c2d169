from __future__ import annotations

import re
from collections import Counter

import numpy as np
from conftest import frame, prose
from vecloom.llm import outliers


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    count = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    covered = {p for k in range(len(words) - 7) if count[tuple(words[k : k + 8])] > 1 for p in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_statistics_and_base_limits(spark, texts):
    rows = texts + [(30, "a b c d e f g h " * 5), (31, "x#*$%&|<>\n \nx#*$%&|<> y\n"), (32, prose(1, 100) + " " + prose(1, 20))]
    found = outliers.quality(frame(spark, rows)).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert sorted((repr(r.doc_id), *(r[c] for c in names)) for r in found) == sorted((repr(i), *brute(t)) for i, t in rows)
    for r in found:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_rejects_what_lies_far_off(spark):
    rng = np.random.default_rng(1)
    clean = [(k, prose(k, int(rng.integers(30, 300)))) for k in range(450)]
    odd = [(1_000 + k, " ".join(w + "#*$" for w in prose(k, 80).split())) for k in range(40)]
    odd += [(2_000 + k, "".join(prose(k, 200).split()[:8]) + " " + " ".join(w * 8 for w in prose(k, 40).split())) for k in range(20)]
    docs = frame(spark, clean + odd).selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source")
    found = {r.doc_id: r for r in outliers.quality(docs).collect()}
    assert all(found[i].kept for i, _ in clean)
    assert not any(found[i].kept for i, _ in odd)
    # The distance is that of the final estimate, which an outlier does not move: reckon it again from the clean rows.
    x = np.array([[np.log((r.word_chars + 250) / (r.n_words + 50)), np.sqrt(r.n_symbols / (r.n_words + 50)), np.sqrt(r.n_repeat_words / (r.n_words + 50)), np.sqrt(r.n_dup_lines / (r.n_words + 50))] for r in (found[i] for i, _ in clean)])
    cov = np.cov(x.T, bias=True) + np.diag(np.square(outliers.FLOORS))
    d2 = np.einsum("ij,jk,ik->i", x - x.mean(0), np.linalg.inv(cov), x - x.mean(0))
    assert np.allclose(d2, [found[i].distance for i, _ in clean], rtol=0.02, atol=0.02)


def test_filter_keeps_columns(spark, odd, none):
    found = outliers.quality_filter(odd)
    assert found.columns == odd.columns
    assert {r.doc_id for r in found.collect()} <= {None, 5, 6, 7, 8, 9, 14}
    assert outliers.quality(none).count() == 0
