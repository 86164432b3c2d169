"""Tokens of documents, cut and packed into sequences by the sum-of-squares rule."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import partitions, text_slices
from vecloom.sources.staging import stage

CAPACITY = 2048
END_ID = 0
# Parts of words that a worker remembers with their ids; beyond it the memory starts anew.
REMEMBERED = 1_000_000
# Sequences with more room than this are packed once more, with those of other shards.
SLACK = 64
# A shard of the second round takes what this many shards of the first left over.
MERGE = 16


# Letters of the Latin blocks but the dotted capital I (its small form is two characters), and ASCII marks after them but no apostrophe.
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ɏ]+)([^0-9A-Za-z\\s'\x7f-\U0010ffff]*)")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in the vocabulary: itself if printable, else the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


class WordTokens:
    """Ids of whole texts from the ids of their words.

    The tokenizer drops white space and never joins across it, nor letters with marks, so a text's
    ids are those of its parts, one after another. A part is a run of letters, the marks after it, or any
    other piece between white space. Runs of letters go to the model as they are, all else through
    the whole tokenizer.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        self.encode, self.model = whole.encode_batch_fast, whole.model
        self.letters = _byte_letters()
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.sizes, self.ids = array("q", [0]), array("I")

    def add(self, part: str, ids: list[int]) -> int:
        found = self.known[part] = len(self.sizes)
        self.sizes.append(len(ids))
        self.ids.extend(ids)
        return found

    def letters_ids(self, part: str) -> list[int]:
        raw = part if part.isascii() else part.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(raw)]

    def parts(self, words: list[str]) -> np.ndarray:
        """Two numbers for each word: its parts (0 for none)."""
        if len(self.known) > REMEMBERED:
            self.clear()
        known, out, later = self.known, np.zeros((len(words), 2), np.int64), {}
        for i, word in enumerate(words):
            plain = PLAIN.fullmatch(word)
            if plain:
                head, tail = plain[1].lower(), plain[2]
                at = known.get(head)
                out[i, 0] = self.add(head, self.letters_ids(head)) if at is None else at
                if tail:
                    at = known.get(tail)
                    out[i, 1] = self.add(tail, self.encode([tail], add_special_tokens=False)[0].ids) if at is None else at
            else:
                later[i] = "\n" + word  # a key of its own: case counts here
        new = [w for w in dict.fromkeys(later.values()) if w not in known]
        for word, found in zip(new, self.encode([w[1:] for w in new], add_special_tokens=False)):
            self.add(word, found.ids)
        for i, word in later.items():
            out[i, 0] = known[word]
        return out

    def texts(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text closed by end_id, and where each text begins (and the last ends)."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = lists.flatten().dictionary_encode()
        parts = self.parts(coded.dictionary.to_pylist())
        end = self.known.get("\nend")
        end = self.add("\nend", [end_id]) if end is None else end
        ends = 2 * np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        part = np.insert(parts[coded.indices.to_numpy(zero_copy_only=False)].ravel(), ends, end)
        size = np.frombuffer(self.sizes, np.int64)
        first = np.cumsum(size) - size
        n = size[part]
        begin = np.cumsum(n) - n
        ids = np.frombuffer(self.ids, np.uint32)
        flat = ids[np.repeat(first[part] - begin, n) + np.arange(n.sum())].astype("<u4")
        return flat, np.concatenate([[0], np.cumsum(n)[ends + np.arange(len(ends))]])


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids) for each document: its ids and the closing id, cut every `capacity`.

    `ids` are little-endian unsigned 32-bit numbers. A null or empty text gives the closing
    id alone. The tokenizer file must lie at the same path on every executor.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = WordTokens(tokenizer_path)
        for part in text_slices(batches, 1):
            flat, bounds = tokens.texts(part.column(1), end_id)
            total = np.diff(bounds)
            pieces = -(-total // capacity)
            doc = np.repeat(np.arange(len(total)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(total[doc] - start, capacity)
            begin = bounds[doc] + start
            raw = flat.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(doc)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array([raw[4 * b : 4 * (b + n)] for b, n in zip(begin.tolist(), length.tolist())], pa.binary()),
                ],
                names=["doc_id", "piece", "start", "length", "ids"],
            )

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids binary")


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each item, and the fill of each bin.

    counts[g] is the number of open bins with room g. An item goes where the sum of the
    squared counts becomes smallest: into some bin of room g, or into a new one; among
    equals into the least room. Large items come first.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins = np.zeros(len(sizes), dtype=np.int64)
    offset = np.zeros(len(sizes), dtype=np.int64)
    fill: list[int] = []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        before = counts[size:]
        change = 2 * (counts[: capacity + 1 - size] - before) + 2
        change[0] = 1 - 2 * before[0]  # a full bin is no longer open
        best = int(np.argmin(np.where(before > 0, change, 4 * len(sizes) + 4)))
        room = best + size
        opened = 2 * counts[capacity - size] + 1 if size < capacity else 0
        if before[best] > 0 and change[best] < opened:
            b = open_bins[room].pop()
            counts[room] -= 1
        else:
            b, room = len(fill), capacity
            fill.append(0)
        bins[i], offset[i] = b, fill[b]
        fill[b] += size
        left = room - size
        if left:
            open_bins[left].append(b)
            counts[left] += 1
    return bins, offset, np.array(fill, dtype=np.int64)


def _packer(capacity: int, size_col: str):
    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        parts = list(frames)
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True)
        bins, offset, fill = sum_of_squares(rows[size_col].to_numpy(), capacity)
        yield rows.assign(bin=(shard << 33) + bins, at=offset, fill=fill[bins])

    return pack


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, rows_per_shard: int = 50_000) -> DataFrame:
    """Add sequence_id and offset to rows with a `length` of 1 to `capacity`.

    Rows are dealt evenly to shards of about rows_per_shard, each packed by the sum-of-squares rule; a
    full-length row is a sequence of its own. Then sequences with room left are packed again as
    if they were rows, several shards together, so that what a shard could not fill is filled from
    others. Every row is placed exactly once. An empty table gives an empty table.
    """
    spark = pieces.sparkSession
    pieces = stage(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    sizes = pieces.select("_row", "length").where(F.col("length") < capacity)
    shards = max(partitions(spark), sizes.count() // rows_per_shard)
    dealt = sizes.repartition(shards, F.xxhash64("_row"))
    first = stage(
        dealt.mapInPandas(_packer(capacity, "length"), "_row long, length long, bin long, at long, fill long"), "packed"
    )
    loose = first.where((F.col("fill") < capacity - SLACK) & (F.col("at") == 0)).select(F.col("bin").alias("part"), "fill")
    merged = stage(
        loose.withColumnRenamed("fill", "size")
        .repartition(max(1, shards // MERGE), F.xxhash64("part"))
        .mapInPandas(_packer(capacity, "size"), "part long, size long, bin long, at long, fill long")
        .select("part", F.col("bin").alias("whole"), F.col("at").alias("base")),
        "merged",
    )
    # Numbers: 3n for the second round, 3n + 1 for sequences of the first, 3n + 2 for full rows.
    placed = first.join(merged, F.col("bin") == F.col("part"), "left").select(
        F.col("_row").alias("_of"),
        F.coalesce(F.col("whole") * 3, F.col("bin") * 3 + 1).alias("sequence_id"),
        (F.col("at") + F.coalesce("base", F.lit(0))).alias("offset"),
    )
    return pieces.join(placed, F.col("_row") == F.col("_of"), "left").select(
        *[c for c in pieces.columns if c != "_row"],
        F.coalesce("sequence_id", F.col("_row") * 3 + 2).alias("sequence_id"),
        F.coalesce("offset", F.lit(0)).cast("long").alias("offset"),
    )
