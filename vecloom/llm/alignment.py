"""Alignment of two tokenizers: groups of tokens between common ends, and how often ids are linked."""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import text_slices
from vecloom.sources.staging import drop_staged, stage

# Bits for an id of either tokenizer in the code of a pair.
ID_BITS = 20
# What a worker remembers of parts of texts: their number and their code points. Beyond it the memory starts anew.
REMEMBERED, REMEMBERED_LENGTH = 400_000, 20_000_000


def gallop(short: list[int], long: list[int]) -> list[tuple[int, int]]:
    """Indices of the values that two ascending lists have in common.

    Each value of the shorter list is sought from where the last one was found: steps double until they
    pass it, then the last step is halved.
    """
    found, at, size = [], 0, len(long)
    for i, value in enumerate(short):
        if at == size:
            break
        if long[at] < value:
            high, step = at + 1, 2
            while high < size and long[high] < value:
                at = high
                high += step
                step *= 2
            at = bisect_left(long, value, at + 1, min(high, size))
            if at == size:
                break
        if long[at] == value:
            found.append((i, at))
            at += 1
    return found


def common_ends(ends_a: list[int], ends_b: list[int]) -> list[tuple[int, int]]:
    if len(ends_a) <= len(ends_b):
        return gallop(ends_a, ends_b)
    return [(i, j) for j, i in gallop(ends_b, ends_a)]


def _bytes_of_letters() -> dict[str, int]:
    """The byte for which a letter stands in a byte-level vocabulary: itself if printable, else numbered from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Aligner:
    """Figures of whole texts from those of their parts.

    A text is cut in front of each single blank between two characters that are no white space. Neither
    tokenizer has a token across such a place, and both have a token end there, so no group crosses it
    either: parts are encoded and aligned once, texts are put together from them.
    """

    def __init__(self, path_a: str, path_b: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte = _bytes_of_letters()
        known = self.a.get_vocab(with_added_tokens=False)
        self.bytes_a = [b""] * (max(known.values(), default=-1) + 2)
        for token, i in known.items():
            self.bytes_a[i] = bytes(byte[c] for c in token)
        self.bytes_b = [
            bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(self.b.get_piece_size())
        ]
        self.text_a, self.text_b = (list(map(str, range(len(known)))) for known in (self.bytes_a, self.bytes_b))
        if max(len(self.bytes_a), len(self.bytes_b)) >> ID_BITS:
            raise ValueError(f"ids need more than {ID_BITS} bits")
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.length = 0
        # Of each part: whether its bytes are right, its tokens, groups and links, its groups as text, where its pairs end.
        self.sound, self.groups = array("b"), []
        self.n_a, self.n_b, self.n_groups, self.n_pairs = (array("q") for _ in range(4))
        self.pairs = array("q")

    def add(self, parts: list[str], all_a: list[list[int]], all_b: list[list[int]]) -> None:
        bytes_a, bytes_b, text_a, text_b = self.bytes_a, self.bytes_b, self.text_a, self.text_b
        figures = []
        for part, ids_a, ids_b in zip(parts, all_a, all_b):
            self.known[part] = len(self.groups)
            self.length += len(part)
            raw = b" " + part.encode()
            tokens_a, tokens_b = [bytes_a[i] for i in ids_a], [bytes_b[i] for i in ids_b]
            sound = b"".join(tokens_a) == raw == b"".join(tokens_b)
            text, pairs = [], []
            if sound:
                ends = common_ends(list(accumulate(map(len, tokens_a))), list(accumulate(map(len, tokens_b))))
                said_a, said_b = [text_a[i] for i in ids_a], [text_b[i] for i in ids_b]
                from_a = from_b = 0
                for i, j in ends:  # the differences of two ranks are the sizes of a group
                    if i == from_a and j == from_b:
                        text.append(f"{said_a[i]}|{said_b[j]}")
                        pairs.append((ids_a[i] << ID_BITS) + ids_b[j])
                    else:
                        text.append(",".join(said_a[from_a : i + 1]) + "|" + ",".join(said_b[from_b : j + 1]))
                        pairs += [(a << ID_BITS) + b for a in ids_a[from_a : i + 1] for b in ids_b[from_b : j + 1]]
                    from_a, from_b = i + 1, j + 1
            self.groups.append(";".join(text))
            self.pairs.extend(pairs)
            figures.append((sound, len(ids_a), len(ids_b), len(text), len(pairs)))
        for target, values in zip((self.sound, self.n_a, self.n_b, self.n_groups, self.n_pairs), zip(*figures)):
            target.extend(values)

    def parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the parts of all texts, one after another, and how many each text has; unknown parts are encoded."""
        if len(self.known) > REMEMBERED or self.length > REMEMBERED_LENGTH:
            self.clear()
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        values = coded.dictionary.to_pylist()
        at = coded.indices.to_numpy(zero_copy_only=False)
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        begins = np.array([not v or v[0].isspace() for v in values], bool)[at]
        ends = np.array([not v or v[-1].isspace() for v in values], bool)[at]
        first = np.zeros(len(at), bool)
        first[np.cumsum(sizes) - sizes] = True
        cut = first.copy()
        cut[1:] |= ~(ends[:-1] | begins[1:])
        starts = np.flatnonzero(cut)
        lengths = np.diff(np.append(starts, len(at)))
        number = at[starts].astype(np.int64)
        for k in np.flatnonzero(lengths > 1):  # blanks next to white space are no place to cut
            number[k] = len(values)
            values.append(" ".join([values[i] for i in at[starts[k] : starts[k] + lengths[k]]]))
        per_text = np.add.reduceat(cut.astype(np.int64), np.cumsum(sizes) - sizes) if len(sizes) else sizes
        new = [v for v in dict.fromkeys(values[i] for i in np.unique(number)) if v not in self.known]
        for begin in range(0, len(new), 10_000):
            some = new[begin : begin + 10_000]
            found_a = self.a.encode_batch_fast([f" {v}" for v in some], add_special_tokens=False)
            self.add(some, [a.ids for a in found_a], self.b.encode(some, num_threads=1))
        mine = np.array([self.known.get(v, -1) for v in values], np.int64)
        return mine[number], per_text

    def texts(self, texts: pa.Array) -> tuple[list[np.ndarray], list[str], np.ndarray, np.ndarray]:
        """For texts that are neither null nor empty: four figures of each, the digest of its groups, and its links.

        Links come as (row * 2^40 + pair) in order, each once, and how often each occurs.
        """
        part, sizes = self.parts(texts)
        row = np.repeat(np.arange(len(sizes)), sizes)
        bad = np.zeros(len(sizes), bool)
        bad[row[np.frombuffer(self.sound, np.int8)[part] == 0]] = True
        figures = []
        for values in (self.n_a, self.n_b, self.n_groups, self.n_pairs):
            total = np.bincount(row, np.frombuffer(values, np.int64)[part], len(sizes)).astype(np.int64)
            figures.append(np.where(bad, 0, total))
        bounds = np.append(0, np.cumsum(sizes))
        groups = self.groups
        hashes = [
            "" if bad[i] else hashlib.sha256(";".join([groups[p] for p in part[bounds[i] : bounds[i + 1]].tolist()]).encode()).hexdigest()
            for i in range(len(sizes))
        ]
        keep = ~bad[row]
        row, part = row[keep], part[keep]
        n = np.frombuffer(self.n_pairs, np.int64)
        first = np.cumsum(n) - n
        n_here = n[part]
        begin = np.cumsum(n_here) - n_here
        place = np.repeat(first[part] - begin, n_here) + np.arange(n_here.sum())
        links = np.frombuffer(self.pairs, np.int64)[place] + (np.repeat(row, n_here) << (2 * ID_BITS))
        links, times = np.unique(links, return_counts=True)
        return figures, hashes, links, times


ALIGNED = """chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary,
             pairs array<long>, holders array<long>"""


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """ALIGNED: a row for each text, and a row of each chunk's pairs with how many of its texts hold them.

    A chunk is what a worker holds of texts at once. A text's `links` are places in its chunk's pairs,
    and how often each link occurs.
    """
    schema = ALIGNED.replace("\n", " ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        press = zstandard.ZstdCompressor(level=1).compress
        aligner, chunk = Aligner(path_a, path_b), TaskContext.get().partitionId() << 32
        for part in text_slices(batches, 1):
            text = pc.fill_null(part.column(1), "")
            some = np.flatnonzero(pc.binary_length(text).to_numpy(zero_copy_only=False) > 0)
            figures, hashes, links, times = aligner.texts(text.take(pa.array(some)))
            whole = [np.zeros(part.num_rows, np.int64) for _ in figures]
            for target, values in zip(whole, figures):
                target[some] = values
            sha = np.full(part.num_rows, "", object)
            sha[some] = hashes
            pairs, place, holders = np.unique(links & ((1 << 2 * ID_BITS) - 1), return_inverse=True, return_counts=True)
            bounds = np.searchsorted(links >> (2 * ID_BITS), np.arange(len(some) + 1))
            packed = np.full(part.num_rows, b"", object)
            for k, i in enumerate(some):
                here = slice(bounds[k], bounds[k + 1])
                packed[i] = press(np.diff(place[here], prepend=0).astype("<u4").tobytes() + times[here].astype("<u4").tobytes())
            n = part.num_rows
            doc_id = pa.concat_arrays([part.column(0), pa.nulls(1, pa.int64())])
            columns = [
                pa.array([chunk] * (n + 1), pa.int64()),
                doc_id,
                *[pa.array([*w.tolist(), None], pa.int64()) for w in whole],
                pa.array([*sha, None], pa.string()),
                pa.array([*packed, None], pa.binary()),
                pa.array([None] * n + [pairs], pa.list_(pa.int64())),
                pa.array([None] * n + [holders], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in schema.split(",")])
            chunk += 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): in how many texts each pair of ids is linked, and whether that is the most of its A id."""
    each = aligned.where("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "holders")).alias("p"))
    counts = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.holders").alias("count"))
    counts = stage(counts.withColumn("a", F.shiftright("pair", ID_BITS)), "pair_counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))  # at most one row an id of the vocabulary
    return counts.join(F.broadcast(most), "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _weigh(rows: pa.Table, pairs: pa.Table) -> pa.Table:
    """The texts of one chunk with the counts of their links."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    order = np.argsort(pairs.column("pair").to_numpy())
    count = pairs.column("count").to_numpy()[order]
    best = pairs.column("best").to_numpy()[order].astype(np.int64)
    n_best, count_sum = [], []
    for packed in rows.column("links").to_pylist():
        place, times = np.frombuffer(unpack(packed) if packed else b"", "<u4").astype(np.int64).reshape(2, -1)
        place = np.cumsum(place)
        n_best.append(int(best[place] @ times))
        count_sum.append(int(count[place] @ times))
    made = {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(count_sum, pa.int64())}
    names = [c.split()[0] for c in RESULT.split(", ")]
    return pa.table([made[c] if c in made else rows.column(c) for c in names], names=names)


def alignments(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """RESULT for each row of docs (doc_id, text): tokens of a byte-level (A) and a piece (B) tokenizer, aligned.

    A encodes a blank and the text, B the text, to which it adds the blank itself; special tokens in a text
    are plain text. Groups are cut where tokens of both end; links are all pairs of an A and a B
    token in a group. `count` of a pair of ids is the number of rows that hold it linked; n_best counts links whose
    count is the highest of their A id, count_sum adds up the counts of all links.

    A text that is null or empty, or whose tokens do not spell it (a text with U+2581), has no tokens: zeros and
    an empty digest. Repeated rows count each; a null id stays. Texts are never cut short. Other columns are not looked
    at. An empty table gives an empty table.

    Counts reach the texts by chunk: a chunk asks once for each of its pairs, not once a text, and what a chunk holds is
    bounded by its texts.
    """
    aligned = stage(align(docs, path_a, path_b), "aligned")
    counts = stage(pair_counts(aligned), "pairs")
    asked = aligned.where("pairs IS NOT NULL").select(F.col("chunk").alias("of_chunk"), F.explode("pairs").alias("pair"))
    known = asked.join(counts, "pair").select("of_chunk", "pair", "count", "best")
    rows = aligned.where("pairs IS NULL").drop("pairs", "holders")
    found = stage(rows.groupBy("chunk").cogroup(known.groupBy("of_chunk")).applyInArrow(_weigh, RESULT), "alignments")
    drop_staged(aligned, counts)
    return found
