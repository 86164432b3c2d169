import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vecloom.functions.text import is_blank, tokens
from vecloom.operators import chunking, embedding
from vecloom.operators import vocabulary as V
from vecloom.sources.staging import shared_dir
from vecloom.streaming import checkpoints


def chunks_of(spark, texts, limit):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    out = {}
    for r in chunking.token_chunks(df, max_tokens=limit).orderBy("id", "chunk_no").collect():
        out.setdefault(r["id"], []).append(r["text"])
    return [out.get(i, []) for i in range(len(texts))]


def test_chunk_limits(spark):
    texts = ["a  b\nc", "a b c d", "   ", "", "a b c d e f g"]
    assert chunks_of(spark, texts, 3) == [["a  b\nc"], ["a b c", "d"], ["   "], [""], ["a b c", "d e f", "g"]]


def test_blank_chunks_of_a_cut_text_are_dropped(spark):
    space = " "
    assert chunks_of(spark, [f"{space}   a", space], 2) == [["a"], [space]]


@pytest.mark.parametrize("value", ["", " \t", "  　", "\x1c\x1f", "a", " . ", "​"])
def test_blank_is_what_strip_leaves_empty(spark, value):
    df = spark.createDataFrame([(value,)], "t string")
    assert df.select(is_blank(F.col("t"))).first()[0] == (value.strip() == "")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab \n\té", max_size=40), min_size=1, max_size=8), st.integers(1, 5))
def test_chunks_keep_every_token(spark, texts, limit):
    parts = chunks_of(spark, texts, limit)
    for text, chunks in zip(texts, parts):
        words = [w for w in text.replace("\n", " ").replace("\t", " ").split(" ") if w]
        assert " ".join(chunks).split() == words
        assert all(len(c.split()) <= limit for c in chunks)


def test_plugged_tokenizer(spark):
    df = spark.createDataFrame([(1, "abcdefg"), (2, "ab"), (3, "abc   ")], "id int, text string")
    pairs = lambda: (lambda s: [s[i : i + 1] for i in range(len(s))], "".join)
    rows = chunking.token_chunks_with(df, pairs, max_tokens=3).orderBy("id", "chunk_no").collect()
    assert [(r["id"], r["chunk_no"], r["text"]) for r in rows] == [
        (1, 0, "abc"), (1, 1, "def"), (1, 2, "g"), (2, 0, "ab"), (3, 0, "abc"),
    ]


def test_plugged_tokenizer_leaves_out_missing_texts_like_the_default(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a  b c")], "id int, text string")
    words = lambda: (str.split, " ".join)
    rows = lambda out: sorted((r["id"], r["chunk_no"], r["text"]) for r in out.where("text IS NOT NULL").collect())
    assert rows(chunking.token_chunks_with(df, words, max_tokens=2)) == rows(chunking.token_chunks(df, max_tokens=2))


def test_subword_chunks_are_slices_of_the_text(spark, folder):
    tokenizers = pytest.importorskip("tokenizers")
    path = pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")
    known = tokenizers.Tokenizer.from_file(path)
    texts = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").limit(60).collect()]
    texts += ["", " ", None, "😀" * 30, "x" * 5_000, "a" + " " * 4_000 + "b", "word " * 8]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for limit in (8, 50):
        want = set()
        for i, text in enumerate(texts):
            if text is None:
                continue
            starts = [a for a, _ in known.encode(text, add_special_tokens=False).offsets]
            cuts = [0, *starts[limit::limit], len(text)]
            found = [text[a:b] for a, b in zip(cuts, cuts[1:])]
            assert "".join(found) == text
            kept = found if len(found) == 1 else [c for c in found if c.strip()]
            want |= {(i, k, c) for k, c in enumerate(kept)}
        rows = chunking.token_chunks_by_offsets(df, chunking.subword_starts(path), max_tokens=limit).collect()
        assert {(r.id, r.chunk_no, r.text) for r in rows} == want and len(rows) == len(want)
        assert max(r.n_tokens for r in rows) == limit


def test_chunk_cache_is_read_not_recomputed(spark, tmp_path):
    path = str(tmp_path / "cache")
    first = spark.createDataFrame([("a b c",)], "text string")
    other = spark.createDataFrame([("x",)], "text string")
    assert chunking.cached_chunks(first, path, max_tokens=2).count() == 2
    files = sorted(p for p in tmp_path.rglob("*.parquet"))
    assert {r["text"] for r in chunking.cached_chunks(first, path, max_tokens=2).collect()} == {"a b", "c"}
    assert sorted(tmp_path.rglob("*.parquet")) == files
    assert {r["text"] for r in chunking.cached_chunks(first, path, max_tokens=9).collect()} == {"a b c"}
    assert {r["text"] for r in chunking.cached_chunks(other, path, max_tokens=2).collect()} == {"x"}


def test_failed_batch_gives_empty_vectors(spark):
    def embedder():
        def embed(texts):
            if "bad" in texts:
                raise ValueError("no")
            return [[float(len(t))] for t in texts]

        return embed

    df = spark.createDataFrame([(i, "bad" if i == 4 else "x" * i) for i in range(6)], "id int, text string").coalesce(1)
    out = embedding.embed_batches(df, embedder, batch_size=2)
    assert {r["id"]: list(r["embedding"]) for r in out.collect()} == {0: [0.0], 1: [1.0], 2: [2.0], 3: [3.0], 4: [], 5: []}
    assert sorted(r["id"] for r in embedding.keep_embedded(out).collect()) == [0, 1, 2, 3]


def test_hashed_embeddings_are_unit_length(spark):
    df = spark.createDataFrame([("a b a",), ("c",)], "text string")
    for r in embedding.hashed_embedding(df, dim=16).collect():
        assert sum(x * x for x in r["embedding"]) == pytest.approx(1)


def test_top_tokens_break_ties_by_token(spark):
    df = spark.createDataFrame([("b a c a b d",), ("eé a",)], "text string")
    got = V.top_tokens(V.frequency_table(V.token_frequency(df)), 3).orderBy("rank").collect()
    assert [(r["token"], r["n"]) for r in got] == [("a", 3), ("b", 2), ("c", 1)]


@pytest.mark.parametrize("k", [1, 3, 7, 40, 5_000])
def test_top_tokens_equal_a_full_ranking(spark, k, monkeypatch):
    rng = random.Random(k)
    rows = [(rng.choice("ab"), f"t{i}", rng.choice([1, 1, 1, 2, 2, 9])) for i in range(300)] + [("c", "only", 1)]
    table = spark.createDataFrame(rows, "lang string, token string, n long")
    order = sorted(rows, key=lambda r: (-r[2], r[1]))
    want = [(r[1], r[2], i + 1) for i, r in enumerate(order[:k])]
    assert [tuple(r) for r in V.top_tokens(table.drop("lang"), k).orderBy("rank").collect()] == want
    for limit in (1_000, 0):  # the edge of each group by either way
        monkeypatch.setattr(V, "GROUP_LIMIT", limit)
        found = V.top_tokens_by(table, "lang", k).collect()
        for lang in "abc":
            mine = [r for r in order if r[0] == lang][:k]
            assert sorted((r["rank"], r.token, r.n) for r in found if r.lang == lang) == [(i + 1, r[1], r[2]) for i, r in enumerate(mine)]


def test_no_tokens_have_no_top(spark):
    table = spark.createDataFrame([], "lang string, token string, n long")
    assert V.top_tokens(table.drop("lang"), 5).count() == 0 and V.top_tokens_by(table, "lang", 5).count() == 0


def test_sums_by_blocks_equal_plain_sums(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK_BYTES", 8 * 3 * 7)
    rng = random.Random(2)
    vectors = {i: [rng.random() for _ in range(3)] for i in range(50) if i % 9}
    pairs = [(rng.randrange(40), rng.randrange(60)) for _ in range(400)] + [(7, 3)] * 5
    want = {}
    for token, i in pairs:
        if i in vectors:
            n, total = want.get(token, (0, [0.0] * 3))
            want[token] = (n + 1, [a + b for a, b in zip(total, vectors[i])])
    found = V.vector_sums(spark.createDataFrame(pairs, "token_id long, id long"), spark.createDataFrame(list(vectors.items()), "id long, vector array<float>"))
    got = {r.token_id: (r.n, list(r.total)) for r in found.collect()}
    assert got.keys() == want.keys()
    assert all(got[t][0] == want[t][0] and got[t][1] == pytest.approx(want[t][1], abs=1e-5) for t in want)


def test_remap_without_a_vector_for_unknown_tokens(spark):
    matched = spark.createDataFrame([(1, [2]), (2, []), (3, [0])], "token_id long, source_ids array<long>")
    vectors = spark.createDataFrame([(2, [1.0, 3.0])], "id long, vector array<float>")
    zeros = {r.token_id: (r.is_error, list(r.vector)) for r in V.remap_vectors(matched, vectors, 0, 1, "zeros").collect()}
    assert zeros == {1: (False, [1.0, 3.0]), 2: (True, [0.0, 0.0]), 3: (True, [0.0, 0.0])}
    assert {r.token_id: r.vector is None for r in V.remap_vectors(matched, vectors, 0).collect()} == {1: False, 2: True, 3: True}


def test_failures_are_metrics_and_messages(spark):
    def embedder():
        def embed(texts):
            if "bad" in texts:
                raise ValueError("no")
            return [[1.0]] * (len(texts) - texts.count("short"))

        return embed

    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, "short"), (4, "b")], "id int, text string").coalesce(1)
    rows, metrics = embedding.observed(embedding.embed_batches(df, embedder, batch_size=1, error="failure"))
    assert {r.id: r.failure for r in rows.collect()} == {1: None, 2: "ValueError: no", 3: "ValueError: 0 vectors for 1 texts", 4: None}
    assert metrics.get == {"n_rows": 4, "n_failed": 2}


def test_both_embedders_agree(spark):
    df = spark.createDataFrame([(1, "a b a\nc"), (2, ""), (3, "é " * 700)], "id int, text string")
    slow = {r.id: list(r.embedding) for r in embedding.embed_batches(df, embedding.hashing_embedder(16)).collect()}
    fast = {r.id: list(r.embedding) for r in embedding.hashed_embedding(df, dim=16).collect()}
    assert slow.keys() == fast.keys() and all(slow[i] == pytest.approx(fast[i]) for i in slow)


def words(spark, rows):
    return spark.createDataFrame(rows, "token string, id long")


def test_vocabulary_match_and_remap(spark):
    source = words(spark, [("<bos>", 0), ("<unk>", 1), ("go", 2), (".", 3), ("ing", 4)])
    target = words(spark, [("go", 10), ("go.", 11), ("zzz", 12), ("<bos>", 13), ("go.go", 14), ("go.zzz", 15)])
    bos = lambda token: F.concat(F.array(F.lit("<bos>")), V.word_pieces(token))
    vectors = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], "id long, vector array<float>")

    matched = V.match_vocabulary(target, source)
    got = {r["token"]: (r["kind"], list(r["source_ids"])) for r in matched.collect()}
    assert got == {
        "go": ("direct", [2]), "go.": ("tokenized", [2, 3]), "zzz": ("unmapped", []), "<bos>": ("direct", [0]),
        "go.go": ("tokenized", [2, 3, 2]), "go.zzz": ("tokenized", [2, 3]),
    }
    out = {r["token_id"]: (r["is_error"], list(r["vector"])) for r in V.remap_vectors(matched, vectors, 0, 1).collect()}
    assert out[10] == (False, [2.0, 1.0])
    assert out[11] == (False, [2.5, 1.0])
    assert out[14] == (False, [pytest.approx(7 / 3), 1.0])
    # Unmapped, and the leading token itself, fall back on the vector for unknown tokens.
    assert out[12] == out[13] == (True, [1.0, 1.0])

    led = V.match_vocabulary(target, source, bos)
    same = {r["token_id"]: list(r["vector"]) for r in V.remap_vectors(led, vectors, 0, 1, "zeros").collect()}
    assert same[11] == [2.5, 1.0]
    assert same[12] == [0.0, 0.0]


def test_vocabulary_counts_look_at_every_token(spark, tmp_path):
    """More distinct tokens than a vocabulary holds."""
    from vecloom.plans import texts

    n = V.TOP_TOKENS + 500
    docs = [(i, "en" if i % 2 else "de", " ".join(f"w{j}x" for j in range(i, n, 50))) for i in range(50)]
    spark.createDataFrame(docs, "doc_id long, lang string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.range(10).selectExpr("id AS vec_id", "array(1f) AS embedding").write.parquet(str(tmp_path / "embeddings.parquet"))
    counts = {r.kind: r.n_tokens for r in texts.vocab_match_counts(spark, str(tmp_path)).collect()}
    assert counts == {"direct": 10, "unmapped": n - 10}


def test_merged_vocabulary_has_each_token_once(spark):
    make = lambda text: spark.createDataFrame([(t,) for t in text], "token string")
    out = V.merge_vocabularies(make("ab"), make("bcc"), make("acde"))
    assert sorted(map(tuple, out.collect())) == [("a", "primary"), ("b", "primary"), ("c", "kept"), ("d", "added"), ("e", "added")]


def test_checkpointed_append_resumes_and_repeats_without_duplicates(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    schema = spark.range(1).schema

    def run():
        rows = checkpoints.file_stream(spark, source, schema, "*.parquet", files_per_batch=1)
        checkpoints.append_checkpointed(rows, target, str(tmp_path / "progress")).awaitTermination()
        return sorted(r["id"] for r in checkpoints.read_checkpointed(spark, target, schema).collect())

    spark.range(0, 10, 1, 2).write.parquet(source)
    assert run() == list(range(10))
    assert run() == list(range(10))
    spark.range(10, 15, 1, 1).write.mode("append").parquet(source)
    assert run() == list(range(15))


def test_rows_are_admitted_by_count_and_marks_survive_a_restart(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows = spark.range(1, 47).withColumnRenamed("id", "rn")

    def run():
        stream = checkpoints.file_stream(spark, source, rows.schema, "*.parquet", files_per_batch=1)
        checkpoints.append_every(stream, target, str(tmp_path / "progress"), every=15).awaitTermination()
        return sorted(map(tuple, checkpoints.fired_marks(spark, target).collect()))

    checkpoints.write_counted_source(rows.where("rn <= 30"), source, 10)
    assert run() == [(1, 20, False), (2, 30, True)]
    checkpoints.write_counted_source(rows.where("rn > 30"), source, 10)
    counts = [r.n_rows for r in spark.read.parquet(f"{target}/commits").collect()]
    assert counts == [10, 10, 10]
    assert run() == [(1, 20, False), (2, 40, False), (3, 46, True)]
    assert run() == [(1, 20, False), (2, 40, False), (3, 46, True)]
    assert sorted(r.rn for r in spark.read.parquet(f"{target}/rows").collect()) == list(range(1, 47))


class Remote:
    """As much of a session on a cluster as the folder choice looks at."""

    def __init__(self, setting=None):
        self.conf = {"spark.checkpoint.dir": setting}
        self.sparkContext = self
        self.master = "yarn"

    def getCheckpointDir(self):
        return None


def test_a_cluster_needs_a_shared_folder():
    assert shared_dir(Remote("hdfs:///tmp/x")) == "hdfs:///tmp/x"
    with pytest.raises(RuntimeError):
        shared_dir(Remote())


def test_tokens_split_on_plain_white_space(spark):
    df = spark.createDataFrame([(" a\tb\r\nc d ",)], "t string")
    assert df.select(tokens(F.col("t"))).first()[0] == ["a", "b", "c d"]
