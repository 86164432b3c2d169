"""Encoding and decoding with a piece vocabulary: the n best segmentations of whole texts.

A text is its blanks escaped, with one more in front, as the vocabulary's model has it. No piece crosses from one
word into the next, so each word has a lattice of its own, whose arcs are the pieces found in it; a segmentation's
score is the sum of the scores of its pieces. A run of blanks is spelled blank by blank. U+2581 in a text is read as a blank, so it
decodes as one.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import text_slices

BEST = 4
BLANK = "▁"
UNKNOWN_PENALTY = 10.0
# Words that are searched at once, and words (and their characters) whose alternatives a worker remembers.
AT_ONCE = 50_000
REMEMBERED = 200_000
REMEMBERED_CHARS = 2_000_000
# Bytes of ids that are decoded at once.
DECODED_BYTES = 2_000_000
NEVER = -1e8  # scores of pieces that stand for blanks alone lie below
NONE = -1
BYTES = -2

ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
STEP = 0x5851F42D4C957F2D
BACK = pow(STEP, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * ODD[0]
    x = (x ^ (x >> np.uint64(29))) * ODD[1]
    return x ^ (x >> np.uint64(32))


class Vocabulary:
    """Pieces, scores and byte pieces of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.texts: list[str] = []
        self.byte_ids = [NONE] * 256
        self.piece: dict[str, int] = {}
        scores = []
        for i in range(model.get_piece_size()):
            text = model.id_to_piece(i)
            self.texts.append(text)
            scores.append(model.get_score(i))
            if model.is_byte(i):
                self.byte_ids[int(text[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) and BLANK not in text[1:] and (scores[i] > NEVER or text == BLANK):
                self.piece[text] = i
        self.scores = np.array(scores)
        # A blank alone has no score of its own in the model; it is as likely as the least likely piece.
        self.scores[self.scores <= NEVER] = min(self.scores[self.scores > NEVER])
        self.unknown = float(min(x for x in self.scores if x > NEVER)) - UNKNOWN_PENALTY
        self.bytes_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.raw = pa.array([bytes([self.bytes_of[i]]) if i in self.bytes_of else x.encode() for i, x in enumerate(self.texts)], pa.binary())
        self.longest = max(map(len, self.piece))
        self.tables = []
        for size in range(1, self.longest + 1):
            own = [(p, i) for p, i in self.piece.items() if len(p) == size]
            codes = np.array([[ord(c) for c in p] for p, _ in own], np.uint64).reshape(-1, size)
            with np.errstate(over="ignore"):
                key = np.zeros(len(own), np.uint64)
                for j in range(size):
                    key += _mix((codes[:, j] + np.uint64(1)) * ODD[1]) * np.uint64(pow(BACK, j, 1 << 64))
                key = _mix(key)
            order = np.argsort(key)
            short = np.zeros(1 << 16, bool)
            short[(key & np.uint64(0xFFFF)).astype(np.int64)] = True
            self.tables.append((key[order], np.array([i for _, i in own], np.int32)[order], short))

    def arcs(self, word: str) -> list[list[tuple[int, float, int]]]:
        """For each place where a piece may end: (length, score, id); BYTES for a character that is no piece."""
        out: list[list[tuple[int, float, int]]] = [[]]
        for end in range(1, len(word) + 1):
            found = []
            for size in range(1, min(end, self.longest) + 1):
                i = self.piece.get(word[end - size : end])
                if i is not None:
                    found.append((size, float(self.scores[i]), i))
                elif size == 1:
                    found.append((1, self.unknown, BYTES))
            out.append(found)
        return out

    def ids(self, word: str, sizes: list[int]) -> list[int]:
        out, at = [], 0
        for size in sizes:
            text = word[at : at + size]
            i = self.piece.get(text)
            out.extend([self.byte_ids[b] for b in text.encode()] if i is None else [i])
            at += size
        return out

    def n_best(self, word: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best (score, lengths of the pieces), best first.

        Forward Viterbi scores are the exact value of the best rest of a path that runs backward from the
        end, so the backward A* search completes paths in order of their scores. Among equals the path
        whose last pieces are shorter comes first.

        Each open path has a best completion of its own, so no more than the paths still wanted need be open. They
        stand in the order in which equals go, and hold their pieces as links: memory grows with the word, not its square.
        """
        arcs = self.arcs(word)
        ahead = [0.0] + [0.0] * len(word)
        for end in range(1, len(word) + 1):
            ahead[end] = max(ahead[end - size] + score for size, score, _ in arcs[end])
        # (rank, place, score behind, (size of the last piece taken, the same of the path before))
        front: list[tuple[float, int, float, tuple | None]] = [(-ahead[-1], len(word), 0.0, None)]
        found = []
        while front and len(found) < n:
            ranks = [x[0] for x in front]
            first = ranks.index(min(ranks))
            rank, at, behind, path = front[first]
            if at == 0:
                sizes = []
                while path is not None:
                    size, path = path
                    sizes.append(size)
                found.append((-rank, sizes))
                del front[first]
                continue
            front[first : first + 1] = [
                (-(behind + score + ahead[at - size]), at - size, behind + score, (size, path)) for size, score, _ in arcs[at]
            ]
            wanted = n - len(found)
            if len(front) > wanted:
                best = sorted(range(len(front)), key=lambda i: front[i][0])[:wanted]
                front = [front[i] for i in sorted(best)]
        return found

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces joined, byte pieces as UTF-8, escaped blanks as blanks, less the one in front."""
        raw = b"".join(bytes([self.bytes_of[i]]) if i in self.bytes_of else self.texts[i].encode() for i in ids)
        return raw.decode("utf-8", "replace").replace(BLANK, " ").removeprefix(" ")

    def decode_many(self, ids: pa.Array) -> pa.Array:
        """`decode` of each of the ids (little-endian unsigned 32-bit numbers); null for null. Few at a time."""
        size = pc.fill_null(pc.binary_length(ids), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(size) // DECODED_BYTES)) + 1).tolist(), len(ids)]
        return pa.concat_arrays([self._decoded(ids.slice(x, y - x)) for x, y in zip(cuts, cuts[1:])])

    def _decoded(self, ids: pa.Array) -> pa.Array:
        rows = ids.to_pylist()
        bounds = pa.array(np.cumsum([0, *(len(x or b"") // 4 for x in rows)]), pa.int32())
        flat = pa.array(np.frombuffer(b"".join(x or b"" for x in rows), "<u4"))
        raw = pc.binary_join(pa.ListArray.from_arrays(bounds, self.raw.take(flat)), b"")
        try:
            texts = pc.replace_substring_regex(pc.replace_substring(raw.cast(pa.string()), BLANK, " "), "\\A ", "")
        except pa.ArrowInvalid:  # bytes that are not UTF-8
            texts = pa.array([self.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in rows], pa.string())
        return pc.if_else(ids.is_valid(), texts, pa.scalar(None, pa.string()))

    def search(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For many words at once: best score, loss of the second best (inf without one), and the ids of the best as
        a flat array with the place where each word's ids begin (and the last end)."""
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        flat = np.frombuffer("".join(words[i] for i in order).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        size = np.array([len(words[i]) for i in order], np.int64)
        first = np.cumsum(size) - size
        n, total = len(words), len(flat)
        longest = min(self.longest, int(size.max(initial=1)))
        with np.errstate(over="ignore"):
            up = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(total, np.uint64(STEP))]))
            down = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(total, np.uint64(BACK))]))
            sums = np.concatenate([[np.uint64(0)], np.cumsum(_mix((flat + np.uint64(1)) * ODD[1]) * down[:-1])])
            owner = np.repeat(np.arange(n), size)
            at = np.arange(total) - first[owner]
            # Arcs of each length, by the place where they end: (word, id), and where each place's arcs begin.
            arcs = []
            for k in range(1, longest + 1):
                key = _mix((sums[k:] - sums[: total + 1 - k]) * up[: total + 1 - k])
                keys, piece, short = self.tables[k - 1]
                place = np.flatnonzero(short[(key & np.uint64(0xFFFF)).astype(np.int64)])
                place = place[at[place] + k <= size[owner[place]]]
                spot = np.searchsorted(keys, key[place])
                spot[spot == len(keys)] = 0
                hit = keys[spot] == key[place] if len(keys) else np.zeros(0, bool)
                ids = piece[spot[hit]] if len(keys) else np.zeros(0, np.int32)
                place = place[hit]
                if k == 1:  # a character that is no piece is spelled
                    ids, known = np.full(total, BYTES, np.int32), ids
                    ids[place] = known
                    place = np.arange(total)
                ends = (at[place] + k).astype(np.int32)
                by_end = np.argsort(ends, kind="stable")
                cuts = np.searchsorted(ends[by_end], np.arange(int(size.max(initial=0)) + 2))
                arcs.append((owner[place[by_end]], ids[by_end], cuts))
        scores = np.append(self.scores, [self.unknown, -np.inf])  # by id; BYTES is -2, NONE -1

        node = first + np.arange(n)  # a word of m characters has m + 1 nodes
        ahead = np.full(total + n, -np.inf)
        back = np.zeros(total + n, np.int16)
        ahead[node] = 0
        last = int(size.max(initial=0))
        for end in range(1, last + 1):
            for k, (owners, piece, cuts) in enumerate(arcs, 1):
                if cuts[end] == cuts[end + 1]:
                    continue
                here = node[owners[cuts[end] : cuts[end + 1]]] + end
                value = ahead[here - k] + scores[piece[cuts[end] : cuts[end + 1]]]
                better = value > ahead[here]
                here = here[better]
                ahead[here], back[here] = value[better], k
        behind = np.full(total + n, -np.inf)
        behind[node + size] = 0
        on_path = np.zeros(total + n, bool)
        on_path[node + size] = True
        second = np.full(n, -np.inf)
        at_word, at_end, at_id = [], [], []
        for end in range(last, 0, -1):
            for k, (owners, piece, cuts) in enumerate(arcs, 1):
                if cuts[end] == cuts[end + 1]:
                    continue
                own, ids = owners[cuts[end] : cuts[end + 1]], piece[cuts[end] : cuts[end + 1]]
                here = node[own] + end
                before = here - k
                value = scores[ids] + behind[here]
                taken = on_path[here] & (back[here] == k)
                through = ahead[before] + value
                through[taken] = -np.inf
                second[own] = np.maximum(second[own], through)
                behind[before] = np.maximum(behind[before], value)
                t = np.flatnonzero(taken)
                if not len(t):
                    continue
                on_path[before[t]] = True
                at_word.append(own[t])
                at_end.append(np.full(len(t), end))
                at_id.append(ids[t])
        word, end, ids = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (at_word, at_end, at_id))
        back_to = np.array(order, np.int64)
        word = back_to[word] if len(word) else word
        by_place = np.lexsort((end, word))
        word, end, ids = word[by_place], end[by_place], ids[by_place]
        spelled = np.flatnonzero(ids == BYTES)
        if len(spelled):
            raw = [words[w][e - 1].encode("utf-8", "replace") for w, e in zip(word[spelled].tolist(), end[spelled].tolist())]
            times = np.ones(len(ids), np.int64)
            times[spelled] = [len(x) for x in raw]
            word, ids = np.repeat(word, times), np.repeat(ids, times)
            ids[ids == BYTES] = np.array(self.byte_ids)[np.frombuffer(b"".join(raw), np.uint8)]
        best, loss = np.zeros(n), np.zeros(n)
        best[back_to] = ahead[node + size]
        loss[back_to] = ahead[node + size] - second
        return best, loss, ids.astype("<u4"), np.searchsorted(word, np.arange(n + 1))


def combinations(losses: list[list[float]], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n choices of one option a place with the smallest sums of losses, in order."""
    every = itertools.product(*(range(len(x)) for x in losses))
    return heapq.nsmallest(n, ((sum(x[i] for x, i in zip(losses, choice)), choice) for choice in every))


class Encoder:
    def __init__(self, path: str, n: int):
        self.vocabulary, self.n = Vocabulary(path), n
        self.known: dict[str, list[tuple[float, np.ndarray]]] = {}
        self.known_chars = 0

    def alternatives(self, word: str) -> list[tuple[float, np.ndarray]]:
        """(loss, ids) of the n best of a word."""
        found = self.known.get(word)
        if found is None:
            self.known_chars += len(word)
            if len(self.known) > REMEMBERED or self.known_chars > REMEMBERED_CHARS:
                self.known.clear()
                self.known_chars = len(word)
            best = self.vocabulary.n_best(word, self.n)
            found = [(best[0][0] - score, np.array(self.vocabulary.ids(word, sizes), "<u4")) for score, sizes in best]
            self.known[word] = found
        return found

    def texts(self, texts: pa.Array) -> Iterator[list[tuple[float, np.ndarray]]]:
        """For each text, the n best (score, ids)."""
        escaped = pc.replace_substring(pc.binary_join_element_wise(pa.scalar(""), pc.fill_null(texts, ""), BLANK), " ", BLANK)
        # A word begins at every escaped blank; a blank of its own kind in the text does the same.
        parts = pc.list_slice(pc.split_pattern(escaped, BLANK), 1)
        coded = parts.flatten().dictionary_encode()
        words = [BLANK + w for w in coded.dictionary.to_pylist()]
        index = coded.indices.to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))])
        done = [self.vocabulary.search(words[at : at + AT_ONCE]) for at in range(0, len(words), AT_ONCE)]
        best, loss = (np.concatenate([x[i] for x in done]) if done else np.zeros(0) for i in (0, 1))
        flat = np.concatenate([x[2] for x in done]) if done else np.zeros(0, "<u4")
        count = np.concatenate([np.diff(x[3]) for x in done]) if done else np.zeros(0, np.int64)
        begin = np.cumsum(count) - count
        for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
            own = index[a:b]
            n = count[own]
            at = np.cumsum(n) - n
            ids = flat[np.repeat(begin[own] - at, n) + np.arange(n.sum())]
            score = float(best[own].sum())
            # Only the n - 1 places with the smallest losses can differ in the n best.
            near = np.lexsort((np.arange(len(own)), loss[own]))[: self.n - 1] if len(own) < 64 else self._smallest(loss[own])
            near = sorted(int(i) for i in near if np.isfinite(loss[own[i]]))
            options = [self.alternatives(words[own[i]]) for i in near]
            out = []
            for lost, choice in combinations([[x for x, _ in o] for o in options], self.n):
                pieces, last = [], 0
                for i, o, c in zip(near, options, choice):
                    if c:
                        pieces += [ids[last : at[i]], o[c][1]]
                        last = at[i] + n[i]
                out.append((score - lost, np.concatenate([*pieces, ids[last:]]) if pieces else ids))
            yield out

    def _smallest(self, loss: np.ndarray) -> np.ndarray:
        cut = np.partition(loss, self.n - 2)[self.n - 2] if self.n > 1 else -np.inf
        within = np.flatnonzero(loss <= cut)
        return within[np.lexsort((within, loss[within]))][: self.n - 1]


def encode(docs: DataFrame, model_path: str, n: int = BEST, decoded: bool = False) -> DataFrame:
    """(doc_id, rank, score, ids) for the n best segmentations of each text, best first; fewer if there are not so many.

    With `decoded` there is also `text`, decoded from each row's ids by the worker that made them.
    `ids` are little-endian unsigned 32-bit numbers; a character that is no piece is spelled in byte pieces.
    Null and empty texts have one segmentation, of the blank in front. Rows are neither merged nor dropped; an
    empty table gives an empty table; other columns are not looked at. The model file must lie at the same path
    on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(model_path, n)
        for part in text_slices(batches, 1):
            owner, ranks, scores, ids = [], [], [], []
            for i, found in enumerate(encoder.texts(part.column(1))):
                for rank, (score, own) in enumerate(found):
                    owner.append(i)
                    ranks.append(rank)
                    scores.append(score)
                    ids.append(own.tobytes())
                if len(ids) >= 2_000:
                    yield batch(encoder, part, owner, ranks, scores, ids)
                    owner, ranks, scores, ids = [], [], [], []
            if ids:
                yield batch(encoder, part, owner, ranks, scores, ids)

    def batch(encoder: Encoder, part: pa.RecordBatch, owner: list, ranks: list, scores: list, ids: list) -> pa.RecordBatch:
        coded = pa.array(ids, pa.binary())
        columns = [part.column(0).take(pa.array(owner)), pa.array(ranks, pa.int32()), pa.array(scores), coded]
        if decoded:
            columns.append(encoder.vocabulary.decode_many(coded))
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "rank", "score", "ids", "text"][: len(columns)])

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, rank int, score double, ids binary" + ", text string" * decoded)


def decode(rows: DataFrame, model_path: str) -> DataFrame:
    """Rows of (doc_id, rank, ids) as (doc_id, rank, text); null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(model_path)
        for part in text_slices(batches, 2):
            texts = vocabulary.decode_many(part.column(2))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), texts], names=["doc_id", "rank", "text"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "rank", "ids").mapInArrow(run, f"doc_id {kind}, rank int, text string")
