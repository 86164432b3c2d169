from __future__ import annotations

import itertools
import random
import re

from conftest import frame, prose
from pyspark.sql import functions as F
from vecloom.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for k, c in enumerate(reversed(number)):
        x = int(c) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if passes(kind, m[0])]
    return sorted(found)


TEXTS = [
    "a@b a@b.c x@y@z.com a.b%c+d-e@f-g.h-i.j_k@l.m @x.y a@.b a@b..c 😀q@r.s",
    "1.2.3.4 256.1.1.1 1.2.3 01.002.0003.4 1.2.3.4.5.6.7.8 000255.0.0.1 1.2.3.99999999999999999999",
    "4111111111111111 4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 4111111111111112 00000000000000 12345678901234567890",
    "7536784127813050 4845168114407329 and 4111111111111111 4111111111111111",
    "+1 (234) 555-7890 +12345 +1...........2 +123456789012345678 ++1 234 567 8901 +1-2-3-4-5-6-7-8-9-0-",
    "x" * 5_000 + "@" + "y" * 5_000 + " " + "1" * 5_000 + " " + "1." * 3_000 + " a@" + "b." * 3_000 + "c " + "9 " * 3_000 + "+1" + "." * 5_000,
    "ä ö ü me@host.org ☃ 10.0.0.1 ☃ +49 (30) 1234567",
]


def test_base_spans_equal_the_patterns(spark, texts):
    rows = texts + [(500 + k, t) for k, t in enumerate(TEXTS)]
    found = pii.personal_data(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    expected = sorted(((i, base_spans(t)) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, [(x.start, x.order, x.end, x.kind) for x in r.base]) for r in found), key=repr) == expected
    for r in found:
        assert set(r.base) <= set(r.spans) and list(r.spans) == sorted(r.spans, key=tuple)


def test_trees_add_what_base_patterns_miss(spark):
    cards = ["4111111111111111", "5500005555555559", "4012888888881881", "6011111111111117", "3530111333300000"]
    good = [(k, f"{prose(k, 8)} {cards[k % 5]} {prose(k + 1, 5)}") for k in range(60)]
    bad = [(100 + k, f"{prose(k, 8)} {4111111111111112 + 10 * k + k % 7} {prose(k + 2, 5)}") for k in range(60)]
    both = [(300, f"{prose(3, 6)} {cards[0]} {cards[1]} {prose(4, 6)}")]
    found = {r.doc_id: r for r in pii.personal_data(frame(spark, good + bad + both)).collect()}
    assert not found[300].base
    text = both[0][1]
    assert {text[x.start : x.end] for x in found[300].spans} == set(cards[:2])
    assert all(len(found[k].spans) == 1 for k in range(60))


def test_spans_give_way_only_to_what_they_overlap(spark):
    # Only the number of digits tells them apart.
    right = ["+4{:09d}", "+1 (200) 555-70{:02d}", "+1-200-555-70{:02d}", "+1 2 (345) 678-90-{:02d}"]
    wrong = ["+4{:06d}", "+1 (2) 555-70{:02d}", "+1-2-5-5-5-70{:02d}", "+1 2 (3) 4 ( 5 ) . {:02d}"]
    good = [(k, f"{prose(k, 8)} {right[k % 4].format(k)} {prose(k + 1, 5)}") for k in range(80)]
    bad = [(100 + k, f"{prose(k, 8)} {wrong[k % 4].format(k)} {prose(k + 2, 5)}") for k in range(80)]
    two = [(300, f"{prose(3, 6)} 555-123-4567 555-987-6543 {prose(4, 6)}")]
    row = pii.personal_data(frame(spark, good + bad + two)).where("doc_id = 300").first()
    text = two[0][1]
    assert not row.base
    assert [text[x.start : x.end] for x in row.spans] == ["555-123-4567", "555-987-6543"]


def test_likeliest_set_of_a_chain(spark):
    rng = random.Random(4)
    rows, expected = [], {}
    for i in range(60):
        spans = sorted({(a := rng.randint(0, 30), a + rng.randint(1, 9), k) for k in range(rng.randint(1, 8))})
        weighted = [(a, b, k, rng.choice([0.5, 0.75, 1.0]), int(rng.random() < 0.15)) for a, b, k in spans]
        rows += [(i, 7, a, k, b, "phone", 2.0 if fixed else p, fixed) for a, b, k, p, fixed in weighted]
        apart = lambda x, y: x[1] <= y[0] or y[1] <= x[0]
        left = [x for x in weighted if not x[4] and all(apart(x, f) for f in weighted if f[4])]
        sets = [c for n in range(len(left) + 1) for c in itertools.combinations(left, n) if all(apart(*q) for q in itertools.combinations(c, 2))]
        expected[i] = max((sum(x[3] for x in c), sum(x[1] - x[0] for x in c)) for c in sets)
    schema = "doc_id long, digest long, start int, order int, end int, kind string, p double, fixed int"
    found = {i: [] for i in expected}
    for r in pii.without_overlaps(spark.createDataFrame(rows, schema)).collect():
        found[r.doc_id].append(r)
    for i, own in found.items():
        assert (sum(r.p for r in own), sum(r.end - r.start for r in own)) == expected[i]
        assert all(x.end <= y.start or y.end <= x.start for x, y in itertools.combinations(own, 2))


def test_numbers_with_wide_gaps(spark):
    text = "call +1...2...3...4...5...6...7...8...9...0 now"
    row = pii.personal_data(frame(spark, [(1, text)])).first()
    assert [(x.start, x.order, x.end, x.kind) for x in row.base] == base_spans(text) and len(row.base) == 1


def test_redacts(spark, odd, none):
    found = pii.redact_texts(odd)
    assert found.columns == odd.columns
    row = found.where("doc_id = 13").first()
    assert row.text == "mail [email] or [phone] at [ip], card [card]"
    assert found.where("doc_id = 1").first().text == ""
    assert found.count() == odd.count()
    assert pii.personal_data(none).count() == 0


def plain_redaction(text, spans):
    at, out = 0, []
    for start, _, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def test_texts_with_very_many_matches(spark):
    rng = random.Random(5)
    ip = lambda: ".".join(str(rng.randint(0, 299)) for _ in range(4))
    log = "\n".join(f"{ip()} ☃😀 {k}" for k in range(16_000))
    rows = [(1, log), (1, log), (2, "x" * 1_020 + "a@" + "b." * 3_000 + "c 1.2.3.4"), (3, "ä" * 1_024 + "1.2.3.4" + "😀" * 2_041 + "a@b.c")]
    docs = frame(spark, rows)
    found = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    for i, text in rows:
        assert [tuple(x) for x in found[i].base] == base_spans(text)
    assert sum(x.kind == "ip" for x in found[1].base) > 5_000
    texts = [(r.doc_id, r.text) for r in pii.redact_texts(docs).collect()]
    assert sorted(texts) == sorted((i, plain_redaction(t, [tuple(x) for x in found[i].spans])) for i, t in rows)


def test_overlapping_spans_across_blocks(spark):
    rng = random.Random(6)
    text = "".join(rng.choice("ab😀é") for _ in range(9_000))
    rows, expected = [], {}
    for i in range(40):
        spans = sorted({(a := rng.randint(0, 8_000), k, a + rng.randint(1, 1_000 if k % 2 else 9), "ip") for k in range(rng.randint(1, 30))})
        rows.append((i, 7, spans))
        expected[i] = plain_redaction(text, spans)
    shape = "doc_id long, digest long, spans array<struct<start:int,order:int,end:int,kind:string>>"
    cuts = pii.block_cuts(spark.createDataFrame(rows, shape)).withColumn("text", pii.F.lit(text))
    blocks = pii.F.regexp_extract_all("text", pii.F.lit(f"(?s).{{1,{pii.BLOCK}}}"), pii.F.lit(0))
    none = pii.F.array().cast("array<struct<begin:int,end:int,kind:string>>")
    joined = pii.F.array_join(pii.F.zip_with(blocks, "cuts", lambda b, c: pii.redact(b, pii.F.coalesce(c, none))), "")
    assert {r.doc_id: r.text for r in cuts.select("doc_id", joined.alias("text")).collect()} == expected


def test_what_surrounds_a_candidate(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(["1", "22", "333 4", " ", "-", "+1", "a", "@", "b.c", "x@y.z", "1.2.3.4", "😀"]) for _ in range(200)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.candidates(pii.text_pieces(docs)).collect()
    assert {r.label for r in rows} == {0, 1, None}
    for r in rows:
        text = texts[r.doc_id]
        assert (r.value, r.before, r.after or "") == (text[r.start : r.end], text[max(0, r.start - 24) : r.start], text[r.end : r.end + 1])
    assert len({(r.doc_id, r.start, r.order, r.end) for r in rows}) == len(rows)


def test_trees_and_thresholds_see_every_labelled_candidate(spark, monkeypatch):
    """More candidates of a kind and label than any sample would hold."""
    rows = [(i, f"write to u{i}@ex{i}.org or pay {4000_0000_0000_0000 + 7 * i}") for i in range(3_000)]
    docs = spark.createDataFrame([*rows, (3_000, "or to some (at) place (dot) org")], "doc_id long, text string")
    spans = pii.with_features(pii.candidates(pii.text_pieces(docs)))
    shape = F.xxhash64("kind", "value", "before", "after")
    labelled = spans.where("label IS NOT NULL").select("label", shape.alias("shape")).distinct()
    wanted = labelled.where("pmod(shape, 5) != 0").count()
    seen = []

    class Trees(pii.GBTClassifier):
        def fit(self, rows):
            seen.append(rows.agg(F.sum("weight")).first()[0] if "weight" in rows.columns else rows.count())
            return super().fit(rows)

    monkeypatch.setattr(pii, "GBTClassifier", Trees)
    pii.select_spans(spans)
    assert wanted > 4_000 and seen == [wanted]
