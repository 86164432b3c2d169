"""Registered queries of this package, each over its whole table, with a check in SQL if there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.llm import alignment, cover_tree, crf, hosts, line_dedup, ngram_join, outliers, packing, pieces, pii, postings, repeats, spelling
from vecloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def register(run: Callable) -> Callable:
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


LINE_DEDUP_SQL = """
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
w AS (SELECT doc_id, i AS pos, lines[i] || chr(10) || lines[i + 1] || chr(10) || lines[i + 2] AS run
      FROM l, unnest(range(1, len(lines) - 1)) AS t(i)),
later AS (SELECT doc_id, pos FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, pos) AS k FROM w) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, pos + d AS pos FROM later, unnest([0, 1, 2]) AS t(d)),
kept AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n
         FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM l) ANTI JOIN gone USING (doc_id, pos)
         GROUP BY doc_id)
SELECT l.doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - coalesce(n, 0) AS BIGINT) AS n_removed,
       md5(coalesce(kept.text, '')) AS kept_md5
FROM l LEFT JOIN kept USING (doc_id)
"""


@query("op6_line_dedup", LINE_DEDUP_SQL)
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, folder, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("kept_md5"))


@query("op8_quality_rules")
def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return outliers.quality(table(spark, folder, "documents")).drop("digest", "lang", "source")


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))
    return packing.pack_pieces(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def page_outcomes(pages: DataFrame) -> DataFrame:
    """(page_id, url, outcome): the table labels no page, so a plain rule on the page's own text does.

    Bad (1) if the text without markup has over one symbol of `#*$%&|` in ten words, good (0) if not,
    null without a text.
    """
    text = F.regexp_replace("html", "<[^>]*>", " ")
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|", ""))
    blanks = F.length(text) - F.length(F.translate(text, " ", ""))
    return pages.select("page_id", "url", F.when(symbols * 10 > blanks, 1).when(text.isNotNull(), 0).alias("outcome"))


HOSTS_SQL = r"""
WITH o AS (SELECT page_id, url, regexp_replace(html, '<[^>]*>', ' ', 'g') AS t FROM pages),
p AS (SELECT page_id,
        coalesce(translate(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path,
        CASE WHEN 10 * (length(t) - length(translate(t, '#*$%&|', ''))) > length(t) - length(replace(t, ' ', '')) THEN 1
             WHEN t IS NOT NULL THEN 0 END AS outcome
      FROM o),
t AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '\.$', '') AS site FROM p),
g AS (SELECT site, CAST(count(outcome) AS DOUBLE) AS n, CAST(coalesce(sum(outcome), 0) AS DOUBLE) AS bad,
        regexp_matches(site, '^([0-9]+\.[0-9]+\.[0-9]+\.[0-9]+|\[.*)$') AS address,
        CASE WHEN regexp_matches(site, '(^|\.)(ac|co|com|edu|gob|gov|gv|mil|ne|net|nom|or|org|sch)\.[a-z][a-z]$') THEN 2 ELSE 1 END AS wide
      FROM t GROUP BY site),
h AS (SELECT site, n, bad,
        CASE WHEN address THEN site ELSE array_to_string(list_slice(string_split(site, '.'), -wide - 1, NULL), '.') END AS domain,
        CASE WHEN address THEN 'ip' ELSE array_to_string(list_slice(string_split(site, '.'), -wide, NULL), '.') END AS suffix
      FROM g),
d AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY ALL),
s0 AS (SELECT s.*, (SELECT (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1) FROM s) AS p FROM s),
ws AS (SELECT sum((bad / n - p) * (bad / n - p) * n - p * (1 - p)) / nullif(sum(p * (1 - p) * (n - 1)), 0) AS r FROM s0 WHERE n > 0),
s1 AS (SELECT suffix, (bad + w * p) / (n + w) AS p FROM s0,
        (SELECT greatest(1.0, least(1000.0, coalesce(CASE WHEN r > 0 THEN 1 / r - 1 END, 1000.0))) AS w FROM ws)),
d0 AS (SELECT d.*, p FROM d JOIN s1 USING (suffix)),
wd AS (SELECT sum((bad / n - p) * (bad / n - p) * n - p * (1 - p)) / nullif(sum(p * (1 - p) * (n - 1)), 0) AS r FROM d0 WHERE n > 0),
d1 AS (SELECT domain, (bad + w * p) / (n + w) AS p FROM d0,
        (SELECT greatest(1.0, least(1000.0, coalesce(CASE WHEN r > 0 THEN 1 / r - 1 END, 1000.0))) AS w FROM wd)),
h0 AS (SELECT h.*, p FROM h JOIN d1 USING (domain)),
wh AS (SELECT sum((bad / n - p) * (bad / n - p) * n - p * (1 - p)) / nullif(sum(p * (1 - p) * (n - 1)), 0) AS r FROM h0 WHERE n > 0),
h1 AS (SELECT site, n, w, (bad + w * p) / (n + w) AS m FROM h0,
        (SELECT greatest(1.0, least(1000.0, coalesce(CASE WHEN r > 0 THEN 1 / r - 1 END, 1000.0))) AS w FROM wh)),
b AS (SELECT site, m - 1.645 * sqrt(m * (1 - m) / (n + w + 1)) > 0.5 AS blocked FROM h1),
rules(rule, kind, rh, rp) AS (VALUES ('com/', 'allow', 'com', '/'), ('example.com/en/', 'block', 'example.com', '/en/'),
        ('www.example.com/en/', 'allow', 'www.example.com', '/en/'), ('net/es/', 'block', 'net', '/es/'), ('net/fr/', 'block', 'net', '/fr/')),
fit AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(kind, length(rule)) AS kind
        FROM p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT p.page_id, p.host, p.path, fit.rule, coalesce(fit.kind, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM t AS p LEFT JOIN fit USING (page_id) LEFT JOIN b USING (site)
"""


@query("op10_url_filters", HOSTS_SQL)
def op10_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return hosts.judge_urls(page_outcomes(table(spark, folder, "pages")))


@query("op2_ngram_jaccard_join")
def op2_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, folder, "documents"), n=3, percent=90)


@query("op7_suffix_array_dedup")
def op7_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_pii")
def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.personal_data(table(spark, folder, "documents"))
    counts = [(F.size("base") - F.size(F.array_remove("base.kind", k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    base, spans = pii.listed(F.col("base")), pii.listed(F.col("spans"))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), spans.alias("spans"))


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = crf.tag(docs, crf.fit_labelled(docs, table(spark, folder, "labels")))
    return found.select(
        "doc_id",
        crf.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("spans").alias("n_spans"),
    )


@query("op5_embedding_near_dedup")
def op5_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return cover_tree.near_duplicates(table(spark, folder, "embeddings"))


@query("op4_sentencepiece_nbest")
def op4_sentencepiece_nbest(spark: SparkSession, folder: str) -> DataFrame:
    """The n best segmentations of each text, one row a rank, and the text decoded from each."""
    found = pieces.encode(table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"), decoded=True)
    n_pieces = (F.length("ids") / 4).cast("long")
    crc = {c: F.crc32(c) for c in ("ids", "text")}
    return found.select("doc_id", "rank", "score", n_pieces.alias("n_pieces"), *[x.alias(f"{c}_crc32") for c, x in crc.items()])


DECONTAMINATION_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, w[k:k + 9] AS run FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(k) WHERE len(w) > 0),
runs AS (SELECT run, row_number() OVER () AS id FROM (SELECT DISTINCT run FROM win)),
p AS (SELECT doc_id, n, k - 1 AS start, w[k:k + n - 1] AS run
      FROM d, (SELECT DISTINCT len(run) AS n FROM runs) AS s, unnest(range(1, len(w) - n + 2)) AS t(k)),
hit AS (SELECT doc_id, start, n, id FROM p JOIN runs USING (run)),
covered AS (SELECT doc_id, count(DISTINCT start + o) AS n_hit FROM hit, unnest(range(n)) AS t(o) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
          FROM (SELECT DISTINCT doc_id, item_id FROM hit JOIN runs USING (id) JOIN win USING (run)) GROUP BY doc_id),
tok AS (SELECT doc_id, unnest(w) AS term, unnest(range(len(w))) AS pos FROM d),
tw AS (SELECT id, unnest(run) AS term, unnest(range(len(run))) AS k FROM runs),
idx AS (SELECT * FROM tok WHERE term IN (SELECT term FROM tw)),
freq AS (SELECT term, count(*) AS n FROM idx GROUP BY term),
possible AS (SELECT id FROM tw LEFT JOIN freq USING (term) GROUP BY id HAVING count(*) = count(n)),
ranked AS (SELECT id, term, row_number() OVER (PARTITION BY id ORDER BY n, k) AS r
           FROM (SELECT id, term, min(n) AS n, min(k) AS k FROM tw JOIN possible USING (id) JOIN freq USING (term) GROUP BY id, term)),
sets AS (SELECT t1, t2, t3, list(id) AS ids
         FROM (SELECT id, max(term) FILTER (r = 1) AS t1, max(term) FILTER (r = 2) AS t2, max(term) FILTER (r = 3) AS t3 FROM ranked GROUP BY id)
         GROUP BY ALL),
m1 AS (SELECT doc_id, t1, t2, t3, ids, pos AS p1 FROM sets JOIN idx ON term = t1),
m2 AS (SELECT m1.*, p1 AS p2 FROM m1 WHERE t2 IS NULL
       UNION ALL SELECT m1.*, idx.pos FROM m1 JOIN idx ON m1.doc_id = idx.doc_id AND idx.term = t2 AND abs(idx.pos - p1) < 20),
m3 AS (SELECT doc_id, ids FROM m2 WHERE t3 IS NULL
       UNION ALL SELECT m2.doc_id, ids FROM m2 JOIN idx ON m2.doc_id = idx.doc_id AND idx.term = t3
                 AND greatest(p1, p2, idx.pos) - least(p1, p2, idx.pos) < 20),
near AS (SELECT doc_id, count(DISTINCT item_id) AS n_near
         FROM (SELECT DISTINCT doc_id, unnest(ids) AS id FROM (SELECT DISTINCT doc_id, ids FROM m3)) JOIN runs USING (id) JOIN win USING (run) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near_items
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN near USING (doc_id)
"""


@query("op11_benchmark_decontamination", DECONTAMINATION_SQL)
def op11_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = postings.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "n_near_items",
    )


@query("op12_spelling_variant_grouping")
def op12_spelling_variant_grouping(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, folder, "documents"))


@query("op13_cross_tokenizer_alignment")
def op13_cross_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return alignment.alignments(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
