"""Token counts and token chunks of whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.functions.text import is_blank, tokens

MAX_TOKENS = 2000
# Texts whose offsets are held at a time.
OFFSET_ROWS = 256


def token_counts(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("n_tokens", F.size(tokens(F.col(text))))


def token_chunks(df: DataFrame, text: str = "text", max_tokens: int = MAX_TOKENS) -> DataFrame:
    """One row per chunk of `max_tokens` tokens, numbered in `chunk_no`.

    A text within the limit stays as it is, even if blank; of a longer one, blank
    chunks are left out.
    """
    split = df.withColumn("_tokens", tokens(F.col(text))).withColumn("_n", F.size("_tokens"))
    starts = F.sequence(F.lit(0), F.greatest(F.col("_n") - 1, F.lit(0)), F.lit(max_tokens))
    parts = F.transform(starts, lambda s: F.array_join(F.slice("_tokens", s + 1, max_tokens), " "))
    chunks = F.when(F.col("_n") <= max_tokens, F.array(text)).otherwise(F.filter(parts, lambda c: ~is_blank(c)))
    rest = [c for c in df.columns if c != text]
    return split.select(*rest, F.posexplode(chunks).alias("chunk_no", text))


def token_chunks_by_offsets(
    df: DataFrame, tokenizer: Callable[[], Callable[[list[str]], list[list[int]]]], text: str = "text", max_tokens: int = MAX_TOKENS
) -> DataFrame:
    """Chunks of at most `max_tokens` tokens of any tokenizer, as slices of the text, with their `n_tokens`.

    `tokenizer` builds, once per task, a function that gives where the tokens of each text begin (in code points, rising
    or equal). Nothing is decoded: a chunk runs from the beginning of its first token to that of the next chunk's
    first, so chunks put together are the text as it was. A text within the limit stays as it is, even if blank; of a
    longer one blank chunks are left out. A null text gives no row.
    """
    rest = [c for c in df.columns if c != text]
    at = df.columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts_of = tokenizer()
        for batch in batches:
            for begin in range(0, batch.num_rows, OFFSET_ROWS):
                part = batch.slice(begin, OFFSET_ROWS)
                part = part.filter(part.column(at).is_valid())
                rows, numbers, chunks, sizes = [], [], [], []
                texts = part.column(at).to_pylist()
                for row, (value, starts) in enumerate(zip(texts, starts_of(texts))):
                    cuts = [0, *starts[max_tokens::max_tokens], len(value)]
                    found = [(value[a:b], min(max_tokens, len(starts) - k * max_tokens)) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
                    if len(found) > 1:
                        found = [c for c in found if c[0].strip()]
                    rows += [row] * len(found)
                    numbers += range(len(found))
                    chunks += [c for c, _ in found]
                    sizes += [n for _, n in found]
                taken = part.take(pa.array(rows, pa.int64())).drop_columns([text])
                made = [pa.array(numbers, pa.int32()), pa.array(chunks, pa.string()), pa.array(sizes, pa.int32())]
                yield pa.RecordBatch.from_arrays([*taken.columns, *made], names=[*rest, "chunk_no", text, "n_tokens"])

    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in rest), "chunk_no int", f"`{text}` string", "n_tokens int"])
    return df.mapInArrow(cut, schema)


def subword_starts(path: str) -> Callable[[], Callable[[list[str]], list[list[int]]]]:
    """For `token_chunks_by_offsets`: the tokenizer of a file of the `tokenizers` library, without special tokens."""

    def build() -> Callable[[list[str]], list[list[int]]]:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        known = Tokenizer.from_file(path)
        known.encode_special_tokens = True  # their strings in a text are ordinary text
        return lambda texts: [[a for a, _ in e.offsets] for e in known.encode_batch(texts, add_special_tokens=False)]

    return build


def token_chunks_with(
    df: DataFrame,
    tokenizer: Callable[[], tuple[Callable[[str], list], Callable[[list], str]]],
    text: str = "text",
    max_tokens: int = MAX_TOKENS,
) -> DataFrame:
    """The same with another tokenizer; `tokenizer` returns (encode, decode), once per task."""
    rest = [c for c in df.columns if c != text]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, decode = tokenizer()

        def pieces(value: str | None) -> list[str] | None:
            if value is None:
                return None
            ids = encode(value)
            return [decode(ids[i : i + max_tokens]) for i in range(0, max(1, len(ids)), max_tokens)]

        for batch in batches:
            yield batch.assign(_pieces=batch[text].map(pieces))

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields] + ["_pieces array<string>"])
    # What is kept whole and what is left out follows the rules of `token_chunks`.
    several = F.filter("_pieces", lambda c: ~is_blank(c))
    chunks = F.when(F.size("_pieces") <= 1, F.array(text)).otherwise(several)
    return df.mapInPandas(cut, schema).select(*rest, F.posexplode(chunks).alias("chunk_no", text))


def content_digest(df: DataFrame) -> str:
    """Tells tables with different rows apart, whatever their order."""
    rows = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)]).cast("decimal(38,0)")
    n, total = df.agg(F.count(F.lit(1)), F.sum(rows)).first()
    return f"{n:x}-{int(total or 0) % (1 << 64):x}"


def cached_chunks(df: DataFrame, path: str, text: str = "text", max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Chunks from an earlier run over the same rows with the same limit if they were written whole, else computed and kept."""
    spark = df.sparkSession
    target = f"{path.rstrip('/')}/{content_digest(df)}/max_tokens={max_tokens}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/_SUCCESS")
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    chunks = token_chunks(df, text, max_tokens)
    if not files.exists(hadoop):
        chunks.write.mode("overwrite").parquet(target)
    return spark.read.schema(chunks.schema).parquet(target)
