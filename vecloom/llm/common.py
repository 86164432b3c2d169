"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Between words: a blank, or one of the code points 9 to 13.
WORD_GAP = "[ \\t-\\r]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def digest(text: Column) -> Column:
    """With the id, tells the rows of a table apart; rows equal in both are one document."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, digest, text), whatever else the table holds; a null text is empty."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text")).withColumn("digest", digest(F.col("text")))


def join_by_key(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on (doc_id, digest); a null id equals a null id."""
    right = right.withColumnsRenamed({"doc_id": "_doc_id", "digest": "_digest"})
    same = (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    joined = left.join(right, same, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop("_doc_id", "_digest")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# What a Python worker holds of texts at once.
SLICE_ROWS = 4_000
SLICE_BYTES = 8_000_000


# Compressed texts count this many times: what `compressed` gains on ordinary text, and some more.
PACKED = 5


def text_slices(batches: Iterator[pa.RecordBatch], column: int, times: int = 1) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in slices of at most SLICE_ROWS rows and about SLICE_BYTES of text (one text at least)."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(times * size.astype(np.int64)) // SLICE_BYTES
        cuts = [*range(0, len(part), SLICE_ROWS), *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        cuts = sorted(set(cuts))
        for begin, end in zip(cuts, cuts[1:]):
            yield batch.slice(begin, end - begin)


def compressed(docs: DataFrame) -> DataFrame:
    """`text` as the compressed bytes `packed`, for tables of texts that are shuffled; other columns stay."""
    at = docs.columns.index("text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3).compress
        for part in text_slices(batches, at):
            packed = [press(x.as_buffer()) if x.is_valid else b"" for x in part.column(at)]
            columns = [pa.array(packed, pa.binary()) if i == at else c for i, c in enumerate(part.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=["packed" if n == "text" else n for n in part.schema.names])

    schema = ", ".join(
        "packed binary" if f.name == "text" else f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields
    )
    return docs.mapInArrow(pack, schema)


def unpacked(column: pa.Array) -> list[bytes]:
    """The texts of a column made by `compressed`, as UTF-8."""
    import zstandard

    press = zstandard.ZstdDecompressor().decompress
    return [press(x) if x else b"" for x in column.to_pylist()]
