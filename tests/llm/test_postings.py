from __future__ import annotations

import random
import re
from itertools import product

from vecloom.llm import postings

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(SMALL))


def windows(text, size):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(docs, items, size=10, within=20):
    by_window = {}
    for i, text in items:
        for run in windows(text, size):
            by_window.setdefault(run, set()).update([] if i is None else [str(i)])
    count = {}
    for _, w in {(i, t or ""): words(t) for i, t in docs}.items():
        for x in w:
            count[x] = count.get(x, 0) + 1
    out = []
    for i, text in docs:
        w, hit, found, near = words(text), set(), set(), set()
        places = {}
        for k, x in enumerate(w):
            places.setdefault(x, []).append(k)
        for run, ids in by_window.items():
            starts = [k for k in places.get(run[0], []) if tuple(w[k : k + len(run)]) == run]
            if starts:
                hit |= {k + d for k in starts for d in range(len(run))}
                found |= ids
            if all(x in count for x in run):
                rare = list(dict.fromkeys(x for _, _, x in sorted((count[x], k, x) for k, x in enumerate(run))))[: postings.NEAR_WORDS]
                lists = [places.get(x, []) for x in rare]
                if any(max(c) - min(c) < within for c in product(*lists)):
                    near |= ids
        out.append((i, len(w), len(hit), sorted(found), len(near)))
    return sorted(out, key=repr)


def result(found):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.n_near_items) for r in found.collect()), key=repr)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string, term string, at int")


def test_equals_brute_force_on_small_alphabets(spark):
    rng = random.Random(5)
    def text(n, alphabet="abcd"):
        return " ".join(rng.choice(alphabet) for _ in range(n))
    docs = [(k, text(rng.randint(0, 60), "ab" if k % 3 else "abcdefgh")) for k in range(60)]
    items = [(k, text(rng.randint(3, 9), "abcd"), "t", 1) for k in range(20)]
    found = result(postings.decontaminate(*frames(spark, docs, items), window=5, within=6))
    assert found == brute(docs, [i[:2] for i in items], 5, 6)
    assert any(r[2] for r in found) and not all(r[2] for r in found)


def test_repeated_words_overlaps_and_case(spark):
    item = "One two three four five six seven eight nine ten eleven"
    docs = [
        (1, "x " + item.upper() + " y"),
        (2, item.rsplit(" ", 2)[0]),
        (3, "one-two, three... four five six seven eight nine (ten)"),
        (4, " ".join(["go"] * 40)),
        (5, "hello"),
        (6, "ten nine eight seven six five four three two one"),
    ]
    items = [(1, item, "t", 1), (1, "hello", "t", 1), (2, item, "t", 1), (10, " ".join(["Go"] * 12), "t", 1), (None, "hello", "t", 1)]
    found = {r.doc_id: r for r in postings.decontaminate(*frames(spark, docs, items)).collect()}
    assert (found[1].n_hit, found[1]["items"]) == (11, ["1", "2"])
    assert (found[2].n_hit, found[2].n_items) == (0, 0)
    assert (found[3].n_hit, found[3].n_items) == (10, 2)
    assert (found[4].n_hit, found[4]["items"]) == (40, ["10"])
    assert (found[5].n_hit, found[5]["items"]) == (1, ["1"])
    assert (found[6].n_hit, found[6].n_near_items) == (0, 2)


def test_odd_rows(spark, odd, none, texts):
    items = [(1, None, "t", 1), (2, "", "t", 1), (3, " ... ", "t", 1), (4, "line line line", "t", 1), (5, texts[6][1][:200], "t", 1), (6, "äöü ß ☃ 😀", "t", 1)]
    items = spark.createDataFrame(items, "item_id long, text string, term string, at int")
    rows = [(r.item_id, r.text) for r in items.collect()]
    found = postings.decontaminate(odd, items)
    expected = {r[0:3] + (tuple(r[3]),) for r in brute(texts, rows)}
    assert {(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found.collect()} == expected
    assert found.count() == len(texts)
    assert postings.decontaminate(none, items).count() == 0
    clean = postings.decontaminate(odd, items.where("false")).collect()
    assert len(clean) == len(texts) and not any(r.n_hit or r.n_near_items for r in clean)
