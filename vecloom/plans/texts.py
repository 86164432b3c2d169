"""Chunking, embedding and vocabularies over `documents`."""

from __future__ import annotations

from pyspark.sql import functions as F

from vecloom.functions.vectors import total
from vecloom.operators import chunking, embedding
from vecloom.operators import vocabulary as V
from vecloom.operators.ordered import numbered
from vecloom.plans import query
from vecloom.sources import tables as S
from vecloom.sources.staging import new_path, stage
from vecloom.streaming import checkpoints

MAX_TOKENS = 200
TOKENS = r"list_filter(regexp_split_to_array(text, '[ \t\n\r]+'), lambda x: x <> '')"
CHUNKS_SQL = f"""WITH t AS (SELECT doc_id, lang, text, {TOKENS} AS tk FROM documents),
    w AS (SELECT doc_id, lang, text, tk, unnest(CASE WHEN len(tk) <= {MAX_TOKENS} THEN [0]
        ELSE range(0, len(tk), {MAX_TOKENS}) END) AS start FROM t),
    c AS (SELECT doc_id, lang, CAST(start / {MAX_TOKENS} AS INTEGER) AS chunk_no,
        CASE WHEN len(tk) <= {MAX_TOKENS} THEN text
            ELSE array_to_string(tk[start + 1 : start + {MAX_TOKENS}], ' ') END AS text FROM w)"""


def documents(spark, folder):
    return S.table(spark, folder, "documents").select("doc_id", "lang", "text")


@query("token_count", f"SELECT doc_id, CAST(len({TOKENS}) AS INTEGER) AS n_tokens FROM documents")
def token_count(spark, folder):
    return chunking.token_counts(documents(spark, folder)).select("doc_id", "n_tokens")


@query("chunk_text", f"{CHUNKS_SQL} SELECT doc_id, lang, chunk_no, text FROM c")
def chunk_text(spark, folder):
    return chunking.token_chunks(documents(spark, folder), max_tokens=MAX_TOKENS)


@query("chunk_text_plugged", f"{CHUNKS_SQL} SELECT doc_id, lang, chunk_no, md5(text) AS digest FROM c")
def chunk_text_plugged(spark, folder):
    def tokenizer():
        import re

        cut = re.compile(r"[^ \t\n\r]+")
        return cut.findall, " ".join

    rows = chunking.token_chunks_with(
        documents(spark, folder), tokenizer, max_tokens=MAX_TOKENS
    )
    return rows.select("doc_id", "lang", "chunk_no", F.md5("text").alias("digest"))


@query("chunk_text_subword")
def chunk_text_subword(spark, folder):
    """Chunks by a public subword tokenizer."""
    import public_tokenizers

    tokenizer = chunking.subword_starts(public_tokenizers.path("byte_bpe_50k.json"))
    rows = chunking.token_chunks_by_offsets(documents(spark, folder), tokenizer, max_tokens=MAX_TOKENS)
    return rows.select("doc_id", "lang", "chunk_no", "n_tokens", F.md5("text").alias("digest"))


@query("chunk_cache", f"{CHUNKS_SQL} SELECT lang, count(*) AS n_chunks, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM c GROUP BY lang")
def chunk_cache(spark, folder):
    path = new_path(spark, "chunks")
    docs = documents(spark, folder)
    chunking.cached_chunks(docs, path, max_tokens=MAX_TOKENS)
    again = chunking.cached_chunks(docs, path, max_tokens=MAX_TOKENS)
    return again.groupBy("lang").agg(F.count(F.lit(1)).alias("n_chunks"), F.sum(F.length("text")).alias("n_chars"))


@query(
    "embed_zip",
    f"""{CHUNKS_SQL} SELECT doc_id, chunk_no, lang, length(text)::DOUBLE AS n_chars,
        (length(text) - length(replace(text, ' ', '')))::DOUBLE AS n_spaces,
        (length(text) - length(replace(text, 'e', '')))::DOUBLE AS n_e FROM c""",
)
def embed_zip(spark, folder):
    """A model that counts characters shows that each vector meets its own row."""

    def counter():
        return lambda texts: [[len(t), t.count(" "), t.count("e")] for t in texts]

    chunks = chunking.token_chunks(documents(spark, folder), max_tokens=MAX_TOKENS)
    vectors = embedding.keep_embedded(embedding.embed_batches(chunks, counter))
    names = ("n_chars", "n_spaces", "n_e")
    return vectors.select("doc_id", "chunk_no", "lang", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)])


@query(
    "embed_failures",
    "SELECT lang, count(*) AS n_rows, CAST(sum(CASE WHEN length(text) % 7 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_failed FROM documents GROUP BY lang",
)
def embed_failures(spark, folder):
    """A model that breaks off at some texts, one text a batch."""

    def brittle():
        def embed(texts):
            if len(texts[0]) % 7 == 0:
                raise ValueError("no vector")
            return [[1.0]]

        return embed

    vectors = embedding.embed_batches(documents(spark, folder), brittle, batch_size=1)
    return embedding.embedding_failures(vectors, "lang")


HASHED_SQL = f"""{CHUNKS_SQL}, k AS (SELECT doc_id, chunk_no, lang, unnest({TOKENS}) AS token FROM c),
    b AS (SELECT doc_id, chunk_no, lang, CAST('0x' || substr(md5(token), 1, 8) AS BIGINT) % 64 AS slot, count(*)::DOUBLE AS n
        FROM k GROUP BY ALL)
    SELECT doc_id, chunk_no, lang, CAST(count(*) AS INTEGER) AS n_slots, round(sum(n * (slot + 1)) / sqrt(sum(n * n)), 2) AS weighted_sum
    FROM b GROUP BY ALL"""


def slot_figures(vectors):
    weighted = F.transform("embedding", lambda x, i: x.cast("double") * (i + 1))
    slots = F.size(F.filter("embedding", lambda x: x > 0))
    return vectors.select("doc_id", "chunk_no", "lang", slots.alias("n_slots"), F.round(total(weighted), 2).alias("weighted_sum"))


@query("embed_batch", HASHED_SQL)
def embed_batch(spark, folder):
    chunks = chunking.token_chunks(documents(spark, folder), max_tokens=MAX_TOKENS)
    return slot_figures(embedding.keep_embedded(embedding.embed_batches(chunks, embedding.hashing_embedder())))


@query("embed_hashed", HASHED_SQL)
def embed_hashed(spark, folder):
    chunks = chunking.token_chunks(documents(spark, folder), max_tokens=MAX_TOKENS)
    return slot_figures(embedding.hashed_embedding(chunks))


@query(
    "checkpoint_sink",
    "SELECT lang, count(*) AS n_rows, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM documents GROUP BY lang",
)
def checkpoint_sink(spark, folder):
    """The source comes in files of a bounded number of rows, one file a batch, so there are several appends."""
    docs = S.table(spark, folder, "documents")
    schema, target, source = docs.schema, new_path(spark, "sink"), new_path(spark, "source")
    docs.write.option("maxRecordsPerFile", 2_500).parquet(source)
    for _ in range(2):  # the second run finds nothing new
        rows = checkpoints.file_stream(spark, source, schema, "*.parquet", files_per_batch=1)
        checkpoints.append_checkpointed(rows, target, f"{target}-progress").awaitTermination()
    written = checkpoints.read_checkpointed(spark, target, schema)
    return written.groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n_chars").alias("n_chars"))


@query(
    "checkpoint_every",
    """WITH RECURSIVE c AS (SELECT count(*) AS n, greatest(count(*) // 10, 64) AS batch FROM documents),
    s AS (SELECT n, batch, least(i * batch, n) AS done FROM c, unnest(range(1, CAST(ceil(n / batch) AS BIGINT) + 1)) AS t(i)),
    f AS (SELECT 0 AS mark_no, CAST(0 AS BIGINT) AS at_rows
        UNION ALL SELECT f.mark_no + 1, (SELECT min(done) FROM s WHERE done >= f.at_rows + 2 * batch + 1)
        FROM f WHERE EXISTS (SELECT 1 FROM s WHERE done >= f.at_rows + 2 * batch + 1))
    SELECT CAST(mark_no AS BIGINT) AS mark_no, at_rows, FALSE AS is_final FROM f WHERE mark_no > 0
    UNION ALL SELECT CAST(max(mark_no) + 1 AS BIGINT), max(n), TRUE FROM f, c""",
)
def checkpoint_every(spark, folder):
    """Rows are admitted by count, and a checkpoint fires once enough came since the last."""
    docs = S.table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    numbered_docs = stage(numbered(docs, [F.col("doc_id")]), "numbered")
    batch = max(docs.count() // 10, 64)
    source, target = new_path(spark, "source"), new_path(spark, "sink")
    checkpoints.write_counted_source(numbered_docs, source, batch)
    rows = checkpoints.file_stream(spark, source, numbered_docs.schema, "*.parquet", files_per_batch=1)
    checkpoints.append_every(rows, target, f"{target}-progress", every=2 * batch + 1).awaitTermination()
    return checkpoints.fired_marks(spark, target)


FREQUENCY_SQL = f"f AS (SELECT lang, token, count(*) AS n FROM (SELECT lang, unnest({TOKENS}) AS token FROM documents) GROUP BY ALL)"


@query(
    "vocab_topk",
    f"""WITH {FREQUENCY_SQL}, g AS (SELECT token, CAST(sum(n) AS BIGINT) AS n FROM f GROUP BY token)
    SELECT token, n, rank FROM (SELECT *, row_number() OVER (ORDER BY n DESC, token) AS rank FROM g) WHERE rank <= 64000""",
)
def vocab_topk(spark, folder):
    return V.top_tokens(V.frequency_table(V.token_frequency(documents(spark, folder))))


@query(
    "vocab_by_lang",
    f"""WITH {FREQUENCY_SQL} SELECT lang, token, n, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, token) AS rank FROM f) WHERE rank <= 500""",
)
def vocab_by_lang(spark, folder):
    counts = V.frequency_table(V.token_frequency(documents(spark, folder), by=("lang",)))
    return V.top_tokens_by(counts, "lang", 500)


@query(
    "vocab_merge",
    f"""WITH {FREQUENCY_SQL},
    p AS (SELECT token FROM f WHERE lang = 'es' ORDER BY n DESC, token LIMIT 1000),
    s AS (SELECT token FROM f WHERE lang = 'en'),
    a AS (SELECT DISTINCT token FROM (SELECT token, row_number() OVER (PARTITION BY lang ORDER BY n DESC, token) AS r FROM f)
        WHERE r <= 500)
    SELECT token, 'primary' AS origin FROM p
    UNION ALL SELECT token, 'kept' FROM s ANTI JOIN p USING (token)
    UNION ALL SELECT token, 'added' FROM (SELECT token FROM a ANTI JOIN p USING (token)) ANTI JOIN s USING (token)""",
)
def vocab_merge(spark, folder):
    counts = V.frequency_table(V.token_frequency(documents(spark, folder), by=("lang",)))
    primary = V.top_tokens(counts.where("lang = 'es'").drop("lang"), 1000)
    return V.merge_vocabularies(primary, counts.where("lang = 'en'"), V.top_tokens_by(counts, "lang", 500))


# Source vocabulary: the most frequent English tokens, one for each vector. Target: the most frequent tokens of all languages, as
# many as a vocabulary holds.
VOCABULARY_SQL = f"""{FREQUENCY_SQL},
    src AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) - 1 AS id FROM f WHERE lang = 'en'),
    source AS MATERIALIZED (SELECT token, id FROM src SEMI JOIN embeddings ON id = vec_id),
    g AS (SELECT token, sum(n) AS n FROM f GROUP BY token),
    target AS MATERIALIZED (SELECT token, token_id FROM (SELECT token, row_number() OVER (ORDER BY n DESC, token) - 1 AS token_id FROM g)
        WHERE token_id < 64000),
    cut AS MATERIALIZED (SELECT token_id, regexp_extract_all(token, '\\p{{L}}+|[^\\p{{L}}]+') AS pieces FROM target ANTI JOIN source USING (token)),
    parts AS (SELECT token_id, unnest(pieces) AS token, generate_subscripts(pieces, 1) AS pos FROM cut),
    ids AS (SELECT token_id, 0 AS pos, id, 'direct' AS kind FROM target JOIN source USING (token)
        UNION ALL SELECT token_id, pos, id, 'tokenized' FROM parts JOIN source USING (token))"""


# The counts look at every token of the documents: no limit of a vocabulary cuts their target.
EVERY_TOKEN_SQL = VOCABULARY_SQL.replace("WHERE token_id < 64000", "")


def vocabularies(spark, folder, every_token=False):
    counts = V.frequency_table(V.token_frequency(documents(spark, folder), by=("lang",)))
    vectors = S.table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    last = vectors.agg(F.max("id")).first()[0]
    source = V.with_ids(V.top_tokens(counts.where("lang = 'en'").drop("lang"), (last or 0) + 1))
    totals = V.frequency_table(counts.groupBy("token").agg(F.sum("n").alias("n")))
    target = V.with_ids(V.ranked_tokens(totals) if every_token else V.top_tokens(totals))
    return stage(target, "target"), stage(source.join(vectors.select("id"), "id", "left_semi"), "source"), vectors


@query(
    "vocab_match",
    f"""WITH {VOCABULARY_SQL}, k AS (SELECT token_id, min(kind) AS kind, count(*) AS n_ids FROM ids GROUP BY token_id)
    SELECT token_id, token, coalesce(kind, 'unmapped') AS kind, CAST(coalesce(n_ids, 0) AS INTEGER) AS n_ids
    FROM target LEFT JOIN k USING (token_id)""",
)
def vocab_match(spark, folder):
    target, source, _ = vocabularies(spark, folder)
    matched = V.match_vocabulary(target, source)
    return matched.select("token_id", "token", "kind", F.size("source_ids").alias("n_ids"))


@query(
    "vocab_match_counts",
    f"""WITH {EVERY_TOKEN_SQL}, k AS (SELECT token_id, min(kind) AS kind FROM ids GROUP BY token_id)
    SELECT coalesce(kind, 'unmapped') AS kind, count(*) AS n_tokens FROM target LEFT JOIN k USING (token_id) GROUP BY 1""",
)
def vocab_match_counts(spark, folder):
    target, source, _ = vocabularies(spark, folder, every_token=True)
    return V.match_vocabulary(target, source).groupBy("kind").agg(F.count(F.lit(1)).alias("n_tokens"))


def remap_sql(default: str) -> str:
    """Each vector by its sum and by its position-weighted sum."""
    return f"""WITH {VOCABULARY_SQL},
    o AS (SELECT *, row_number() OVER (PARTITION BY token_id ORDER BY pos) AS r FROM ids),
    x AS (SELECT vec_id, list_sum(e) AS s, list_dot_product(e, list_transform(range(1, len(e) + 1), lambda i: i::DOUBLE)) AS w
        FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)),
    m AS (SELECT token_id, avg(s) AS s, avg(w) AS w FROM o JOIN x ON x.vec_id = o.id
        WHERE NOT (o.r = 1 AND o.id = 0) GROUP BY token_id),
    u AS (SELECT {default})
    SELECT token_id, m.s IS NULL AS is_error, round(coalesce(m.s, u.s), 5) AS vector_sum,
        round(coalesce(m.w, u.w), 5) AS weighted_sum FROM target LEFT JOIN m USING (token_id), u"""


def remapped(spark, folder, fallback):
    target, source, vectors = vocabularies(spark, folder)
    rows = V.remap_vectors(V.match_vocabulary(target, source), vectors, bos_id=0, unk_id=1, fallback=fallback)
    weighted = total(F.transform("vector", lambda x, i: x * (i + 1)))
    return rows.select(
        "token_id",
        "is_error",
        F.round(total(F.col("vector")), 5).alias("vector_sum"),
        F.round(weighted, 5).alias("weighted_sum"),
    )


@query("vocab_remap", remap_sql("s, w FROM x WHERE vec_id = 1"))
def vocab_remap(spark, folder):
    return remapped(spark, folder, "unk")


@query("vocab_remap_zeros", remap_sql("0.0::DOUBLE AS s, 0.0::DOUBLE AS w"))
def vocab_remap_zeros(spark, folder):
    return remapped(spark, folder, "zeros")
