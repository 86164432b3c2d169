from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from vecloom.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(docs):
    found = Counter()
    for i, text in docs:
        for run in RUN.findall(text or ""):
            run = run.translate(SMALL)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def brute(words):
    """Near words by deletions in common: the whole table in memory, plain and slow."""
    by_deletion = defaultdict(set)
    for w in words:
        for v in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            by_deletion[v].add(w)
    near = defaultdict(set)
    for group in by_deletion.values():
        for a in group:
            for b in group:
                if a != b and edits(a, b) == 1:
                    near[a].add(b)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    rows = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return rows


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _step(row, i, x, b)
    return row[-1]


def _step(row, i, x, b):
    new = [i]
    for j, y in enumerate(b, 1):
        new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
    return new


def rows(found):
    made = [tuple(r) for r in found.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(made) == len(set(made))
    return set(made)


@pytest.mark.parametrize(
    ("alphabet", "limits"),
    [("ab", (2_000, 100, 50_000)), ("abcé", (40, 1, 3)), ("abcdefgh", (100_000, 0, 50_000)), ("", (40, 1, 3)), ("", (300, 2, 50_000))],
)
def test_equals_brute_force(spark, alphabet, limits):
    rng = random.Random(len(alphabet))
    syllables = list(alphabet) or ["tion", "the", "er", "an", "ó", "re", "st", "a", "e"]
    words = {}
    while len(words) < 500:
        w = "".join(rng.choice(syllables) for _ in range(rng.randint(2, 12)))
        if len(w) >= 5:
            words[w] = rng.randint(3, 60)
            if rng.random() < 0.7:
                i = rng.randrange(len(w))
                v = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(syllables)[0] + w[i:], w[:i] + rng.choice(syllables)[0] + w[i + 1 :]])
                if len(v) >= 5:
                    words[v] = rng.randint(3, 60)
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    assert rows(spelling.variants_of_words(table, *limits)) == brute(words)


def test_bound_holds_for_every_edit():
    """No edit takes more grams from a word than `affected` says, for dictionaries of several depths."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(5, 14))) for _ in range(300)]
    count = Counter()
    for w in words:
        p = spelling.HEAD + w + spelling.TAIL
        for q in range(spelling.SHORT, spelling.LONG + 1):
            count.update(p[i : i + q] for i in range(len(p) - q + 1))
    for limit in (1, 10, 40, 10**6):
        grams = spelling.Grams({g: n for g, n in count.items() if len(g) == spelling.SHORT or count[g[:-1]] > limit})
        for w in words[:60]:
            padded = spelling.HEAD + w + spelling.TAIL
            starts, ends = grams.split(padded)
            bound = grams.affected(padded, starts, ends)
            for i in range(len(w) + 1):
                for other in [w[:i] + x + w[i:] for x in "abc"] + [w[:i] + w[i + 1 :]] + [w[:i] + x + w[i + 1 :] for x in "abc" if i < len(w)]:
                    changed = spelling.HEAD + other + spelling.TAIL
                    here = set(zip(*grams.split(changed)))
                    shift = len(changed) - len(padded)
                    at = i + spelling.PAD
                    kept = sum(
                        (s, e) in here and e <= at or s >= at and (s + shift, e + shift) in here and padded[s:e] == changed[s + shift : e + shift]
                        for s, e in zip(starts, ends)
                    )
                    assert len(starts) - kept <= bound, (w, other)


def test_words_of_documents(spark, odd, none, texts):
    assert {(r.word, r.n) for r in spelling.counted_words(odd).collect()} == set(counts(texts).items())
    assert rows(spelling.spelling_variants(odd)) == brute(counts(texts))
    assert spelling.spelling_variants(none).count() == 0
    long = "xyzzy" * 40_000
    docs = [(k, f"{long} {long[:-1]}é, Straße_straße STRASSE ÀÉ×÷ words wörds") for k in range(400)] + [(None, "words")] * 3
    table = spark.createDataFrame(docs[:4] + docs[-3:], "doc_id long, text string")
    assert rows(spelling.spelling_variants(table)) == brute_long(counts(docs[:4] + docs[-3:]))


def brute_long(words):
    """As `brute`, for words too long for all their deletions."""
    near = {w: {v for v in words if v != w and abs(len(v) - len(w)) < 2 and spelling.one_edit(w, v, *spelling.common_ends(w, v))} for w in words}
    out = set()
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        ok = best is not None and words[best] >= 2 * n
        root = best if ok else w
        out.add((w, best if ok else None, root, n, len(near[w]), words[best] if ok else None))
    return out


def test_table_agrees_with_brute_force(spark):
    from vecloom.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert rows(QUERIES["op12_spelling_variant_grouping"](spark, folder)) == brute(counts(docs))
