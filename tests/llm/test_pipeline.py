from __future__ import annotations

from collections import defaultdict

import corpus_pipeline
import numpy as np
from vecloom.sources.staging import stage


def test_stages_act_on_what_came_before(spark, odd):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "ngram_duplicates", "personal_data", "packing"]
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars").union(
        spark.sql("SELECT 77L, repeat('word other thing more with ', 2) || 'a b c d e f g h i j mail x@y.org now', 'en', 's', 1L")
    )
    sizes, columns = [], docs.columns
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, ""), name)
        if name != "packing":
            assert docs.columns == columns
            sizes.append({r.doc_id for r in docs.collect()})
        if name == "personal_data":
            row = docs.where("doc_id = 77").first()
            assert "[email]" in row.text and row.n_chars == len(row.text)
    assert sizes[0] == {None, 5, 6, 7, 8, 9, 14, 77} and sizes[1] == sizes[0]
    assert sizes[2] == sizes[3] == {None, 5, 6, 14, 77}
    place = defaultdict(list)
    for r in docs.collect():
        assert len(r.ids) == 4 * r.length
        place[r.sequence_id].append((r.offset, r.length))
        if (r.start + r.length) % 2048:
            assert np.frombuffer(r.ids, "<u4")[-1] == 0
    for parts in place.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048


def test_run_gives_the_last_stage(spark, folder):
    assert set(corpus_pipeline.run(spark, folder).columns) == {"doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"}
