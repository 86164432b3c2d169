from __future__ import annotations

from vecloom.llm.line_dedup import dedup_lines


def brute(rows):
    """Lines kept per (id, text); null ids come first, then ids, then texts that agree."""
    keys = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, kept = {}, {}
    for key in keys:
        lines = key[1].split("\n")
        gone = set()
        for at in range(len(lines) - 2):
            run = tuple(lines[at : at + 3])
            if seen.setdefault(run, (key, at)) != (key, at):
                gone |= {at, at + 1, at + 2}
        kept[key] = "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return kept


def test_equals_brute_force_on_odd_rows(odd, texts):
    expected = brute(texts)
    found = dedup_lines(odd).collect()
    assert len(found) == len(texts)
    by_input = {(i, t or "") for i, t in texts}
    assert sorted(map(str, ((r.doc_id, r.text) for r in found))) == sorted(map(str, ((i, expected[i, t or ""]) for i, t in texts)))
    assert {(11, "a\nb\nc\nd\ne")} <= by_input
    row = next(r for r in found if r.doc_id == 12)
    assert (row.text, row.n_lines, row.n_removed) == ("x\ny", 6, 4)
    assert next(r for r in found if r.doc_id == 10).n_removed == 3  # the second of two equal windows that overlap


def test_keeps_other_columns(odd, none):
    found = dedup_lines(odd)
    assert set(odd.columns) | {"n_removed"} == set(found.columns)
    assert found.first().digest == "x"
    assert dedup_lines(none).count() == 0
