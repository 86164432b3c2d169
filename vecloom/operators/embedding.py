"""Batch embedding through a pluggable function."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.ml.feature import CountVectorizerModel, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from vecloom.functions.text import tokens

BATCH_SIZE = 256


def embed_batches(
    df: DataFrame,
    embedder: Callable[[], Callable[[list[str]], list]],
    text: str = "text",
    batch_size: int = BATCH_SIZE,
    error: str | None = None,
) -> DataFrame:
    """Add `embedding`; `embedder` builds the batch function once per task.

    A batch that fails gets empty vectors, so that the rest goes on; see `embedding_failures` and `keep_embedded`.
    With `error`, a column of that name holds what the batch's failure said, null for a batch that worked.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        embed = embedder()
        for frame in frames:
            vectors: list = []
            said: list[str | None] = []
            for start in range(0, len(frame), batch_size):
                texts = frame[text].iloc[start : start + batch_size].tolist()
                try:
                    part, message = [np.asarray(v, dtype="float32") for v in embed(texts)], None
                    if len(part) != len(texts):
                        raise ValueError(f"{len(part)} vectors for {len(texts)} texts")
                except Exception as failure:
                    part, message = [np.empty(0, dtype="float32")] * len(texts), f"{type(failure).__name__}: {failure}"
                vectors.extend(part)
                said.extend([message] * len(texts))
            yield frame.assign(embedding=vectors, **({error: said} if error else {}))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(run, f"{fields}, embedding array<float>" + (f", `{error}` string" if error else ""))


def observed(df: DataFrame, name: str = "embedding", column: str = "embedding") -> tuple[DataFrame, Observation]:
    """The same rows, and their number and that of failed ones as metrics of whatever action reads them: no extra pass."""
    metrics = Observation(name)
    failed = F.coalesce(F.size(column) <= 0, F.lit(True)).cast("long")
    return df.observe(metrics, F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(failed), F.lit(0)).alias("n_failed")), metrics


def embedding_failures(df: DataFrame, by: str, column: str = "embedding") -> DataFrame:
    """(by, n_rows, n_failed): what `embed_batches` took and what came back without a vector."""
    failed = F.coalesce(F.size(column) <= 0, F.lit(True)).cast("long")
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(failed).alias("n_failed"))


def keep_embedded(df: DataFrame, column: str = "embedding") -> DataFrame:
    return df.where(F.size(column) > 0)


def hashed_embedding(df: DataFrame, text: str = "text", dim: int = 64) -> DataFrame:
    """The vectors of `hashing_embedder`, without Python: unit vectors of token counts by md5 of the token."""
    slots = F.transform(tokens(F.col(text)), lambda t: (F.conv(F.substring(F.md5(t), 1, 8), 16, 10).cast("long") % dim).cast("string"))
    counts = CountVectorizerModel.from_vocabulary([str(i) for i in range(dim)], inputCol="_slots", outputCol="_counts")
    unit = Normalizer(p=2.0, inputCol="_counts", outputCol="_unit")
    rows = unit.transform(counts.transform(df.withColumn("_slots", slots)))
    return rows.withColumn("embedding", vector_to_array("_unit")).drop("_slots", "_counts", "_unit")


class Slots(dict):
    """The slot of each token, by the first 32 bits of its md5; a token is hashed when it is first met."""

    def __init__(self, dim: int):
        self.dim = dim

    def __missing__(self, token: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        found = self[token] = int.from_bytes(hashlib.md5(token.encode()).digest()[:4], "big") % self.dim
        return found


def hashing_embedder(dim: int = 64) -> Callable[[], Callable[[list[str]], list]]:
    """A stand-in model for `embed_batches`: token counts by md5 of the token, of unit length."""

    def build() -> Callable[[list[str]], list]:
        slot, cut = Slots(dim).__getitem__, re.compile("[^ \t\n\r]+").findall

        def embed(texts: list[str]) -> list:
            found = [list(map(slot, cut(t))) for t in texts]
            row = np.repeat(np.arange(len(texts)), [len(f) for f in found])
            flat = np.fromiter(chain.from_iterable(found), np.int64, len(row))
            out = np.bincount(row * dim + flat, minlength=len(texts) * dim).reshape(len(texts), dim).astype("float32")
            size = np.linalg.norm(out, axis=1, keepdims=True)
            return list(out / np.where(size == 0, 1, size))

        return embed

    return build
