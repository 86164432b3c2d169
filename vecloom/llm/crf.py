"""Toxic spans by a linear-chain conditional random field over words, and scores of documents from its marginals."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecloom.llm.common import text_slices
from vecloom.sources.staging import stage

# Labelled documents that the field is fitted on, at most, per label: the smallest by hash.
SAMPLE = 600
# How a feature must stand out in toxic documents.
EVIDENCE, REACH = 22.0, 10.0
ROUNDS = 60
WORD = re.compile("[^ \\t-\\r]+")
EDGES = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
SHAPES = 4
STEMS = (3, 8)  # lengths of beginnings


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def plain(word: str) -> str:
    """A word as the field knows it: lower case, without marks at its ends."""
    return word.strip(EDGES).lower()


def shape(word: str) -> int:
    """0: letters, 1: capitals, 2: with a digit, 3: neither."""
    if any(c.isdigit() for c in word):
        return 2
    bare = word.strip(EDGES)
    if not bare:
        return 3
    return 1 if len(bare) > 1 and bare.isupper() else 0


def keys(word: str) -> list[str]:
    """Features of a word: itself and its beginnings, so that an ending not seen before doesn't hide a stem."""
    return [f"={word}", *(f"^{word[:n]}" for n in range(STEMS[0], min(STEMS[1], len(word)) + 1))]


def coded_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, the number of each word in order, and where each text begins (and the last ends)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    real = np.array([bool(w) for w in words], bool)[index] if len(index) else np.zeros(0, bool)
    return words, index[real], np.searchsorted(owner[real], np.arange(len(texts) + 1))


def products(m: np.ndarray, block: int = 64) -> np.ndarray:
    """m[0] @ m[1] @ ... @ m[t] for each t, each up to a factor; m is (4, n): a 2 x 2 matrix by rows.

    Blocks go on in step, then the products of whole blocks, so the loop is short for any length.
    """
    n = m.shape[1]
    if n == 0:
        return m
    full = -(-n // block) * block
    grid = np.empty((4, full))
    grid[:, :n] = m
    grid[:, n:] = np.array([1.0, 0, 0, 1])[:, None]
    grid = grid.reshape(4, -1, block)
    for j in range(1, block if n > 1 else 1):
        grid[:, :, j] = _times(grid[:, :, j - 1], grid[:, :, j])
    if grid.shape[1] > 1:
        before = products(np.ascontiguousarray(grid[:, :, -1]), block)[:, :-1]
        grid[:, 1:, :] = _times(before[:, :, None], grid[:, 1:, :])
    return grid.reshape(4, full)[:, :n]


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.stack([a[0] * b[0] + a[1] * b[2], a[0] * b[1] + a[1] * b[3], a[2] * b[0] + a[3] * b[2], a[2] * b[1] + a[3] * b[3]])
    return out / out.sum(0)


def marginals(emission: np.ndarray, moves: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(word is toxic) for each word, and the expected moves (2 x 2), by forward and backward products.

    emission: score of the toxic state; moves: log weights by (from, to). Texts begin at bounds: there
    the forward matrix forgets what came before, and the backward one what comes after.
    """
    n = len(emission)
    if n == 0:
        return np.zeros(0), np.zeros((2, 2))
    e = np.clip(emission, -30, 30)
    low = np.exp(-np.maximum(e, 0))
    high = np.exp(e - np.maximum(e, 0))
    w = np.exp(moves)
    step = np.stack([w[0, 0] * low, w[0, 1] * high, w[1, 0] * low, w[1, 1] * high])
    filled = bounds[:-1][np.diff(bounds) > 0]
    step[:, filled] = np.stack([low, high, low, high])[:, filled]
    ahead = products(step)[:2]
    ahead = ahead / ahead.sum(0)
    after = np.ones((4, n))
    after[:, :-1] = step[:, 1:][[0, 2, 1, 3]]
    after[:, np.append(filled[1:], n) - 1] = 1
    back = products(np.ascontiguousarray(after[:, ::-1]))[:, ::-1]
    back = np.stack([back[0] + back[2], back[1] + back[3]])
    both = ahead * back
    p = both[1] / both.sum(0)
    inner = np.ones(n, bool)
    inner[filled] = False
    t = np.flatnonzero(inner)
    pair = np.stack([ahead[i, t - 1] * step[2 * i + j, t] * back[j, t] for i in (0, 1) for j in (0, 1)])
    return p, (pair / pair.sum(0)).sum(1).reshape(2, 2)


@dataclass
class Field:
    known: dict[str, float]  # weight of each feature
    heads: set[str]  # how the words with any feature begin
    shapes: np.ndarray
    moves: np.ndarray
    weights: np.ndarray  # of document_features

    def emission(self, words: list[str]) -> np.ndarray:
        out = self.shapes[[shape(w) for w in words]]
        for i, word in enumerate(map(plain, words)):
            if word[: STEMS[0]] in self.heads:
                out[i] += sum(self.known.get(k, 0.0) for k in keys(word))
        return out

    def scores(self, p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(document_features(p, bounds) @ self.weights)))


def document_features(p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A constant, the log odds of the surest word, and logs of the expected number of toxic words and of their share."""
    n = len(bounds) - 1
    top, total = np.zeros(n), np.zeros(n)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    np.maximum.at(top, owner, p)
    np.add.at(total, owner, np.where(p > 0.01, p, 0))
    top = np.clip(top, 1e-4, 1 - 1e-4)
    share = total / (np.diff(bounds) + 20)
    return np.stack([np.ones(n), np.log(top / (1 - top)), np.log1p(total), np.log1p(200 * share)], 1)


def toxic_keys(texts: list[list[str]], toxic: np.ndarray) -> set[str]:
    """Features that tell toxic documents, from the words of each document in order.

    A word counts once for each different word before it, so copies of a document count once. A feature is
    taken if it is REACH times as frequent in toxic documents, the likelihood ratio against an equal share is
    beyond EVIDENCE, and the words that no longer feature covers stand out as much, or are in no clean document
    while the longer features cover several words.
    """
    n_bad, n_good = max(1, int(toxic.sum())), max(1, int((1 - toxic).sum()))
    share = n_bad / (n_bad + n_good)
    seen: dict[str, tuple[set[str], set[str]]] = {}
    for own, y in zip(texts, toxic):
        for before, word in zip([own[-1], *own] if own else [], own):
            if word:
                seen.setdefault(word, (set(), set()))[int(y)].add(before)
    counts = {w: (len(bad), len(good)) for w, (good, bad) in seen.items()}
    del seen
    groups: dict[str, list[str]] = {}
    for w in counts:
        for k in keys(w):
            groups.setdefault(k, []).append(w)

    def stands_out(words: list[str], evidence: float) -> bool:
        bad, good = (sum(counts[w][i] for w in words) for i in (0, 1))
        if bad < 3 or bad / n_bad < REACH * good / n_good:
            return False
        ratio = bad * np.log(bad / ((bad + good) * share)) + (good * np.log(good / ((bad + good) * (1 - share))) if good else 0)
        return 2 * ratio > evidence

    found: set[str] = set()
    covered: set[str] = set()
    for k in sorted(groups, key=lambda k: (k[0] != "=", -len(k), k)):
        if stands_out(groups[k], EVIDENCE):
            rest = [w for w in groups[k] if w not in covered]
            stem = len(groups[k]) - len(rest) > 1 and not any(counts[w][1] for w in rest)
            if stem or stands_out(rest, 0.0):
                found.add(k)
                covered.update(rest)
    return found


def fit(texts: list[str], toxic: np.ndarray, prior: float) -> Field:
    """A field from labelled texts. A word's label is 1 if its text is toxic and it has a feature that explains toxic texts.

    `prior` is the share of toxic texts among all labelled ones, which the sample need not keep.
    """
    words, index, bounds = coded_words(pa.array(texts, pa.string()))
    names = [plain(w) for w in words]
    of_word = [keys(w) if w else [] for w in names]
    of_shape = np.array([shape(w) for w in words], np.int64)[index] if len(index) else index
    chosen = toxic_keys([[names[i] for i in index[begin:end].tolist()] for begin, end in zip(bounds, bounds[1:])], toxic)
    # Only features that tell something get a weight; of all other words the shape decides.
    listed = np.array([any(k in chosen for k in f) for f in of_word], bool)
    ids = {k: i for i, k in enumerate(sorted(chosen))}
    pairs = [(i, ids[k]) for i, f in enumerate(of_word) for k in f if k in ids]
    word, key = np.array(pairs, np.int64).reshape(-1, 2).T
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    y = (listed[index] & (toxic[owner] == 1)).astype(float) if len(index) else np.zeros(0)
    inner = np.ones(len(y), bool)
    inner[bounds[:-1][np.diff(bounds) > 0]] = False
    t = np.flatnonzero(inner)
    moved = np.bincount((2 * y[t - 1] + y[t]).astype(int), minlength=4).reshape(2, 2)
    sizes = [len(ids), SHAPES, 4]
    at = np.zeros(sum(sizes))
    at[len(ids) : len(ids) + SHAPES] = -4.0
    first, second = np.zeros_like(at), np.zeros_like(at)
    used = np.bincount(index, minlength=len(words)).astype(float)
    seen = np.concatenate([np.bincount(key, used[word], sizes[0]), np.bincount(of_shape, minlength=SHAPES), np.full(4, max(1, len(y)))])

    def emission(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bincount(word, a[key], len(words))[index] + b[of_shape] if len(index) else np.zeros(0)

    for k in range(1, ROUNDS + 1):  # Adam on the mean gradient of each weight
        a, b, c = np.split(at, np.cumsum(sizes)[:-1])
        p, expected = marginals(emission(a, b), c.reshape(2, 2), bounds)
        grad = np.concatenate(
            [np.bincount(key, np.bincount(index, y - p, len(words))[word], sizes[0]), np.bincount(of_shape, y - p, SHAPES), (moved - expected).ravel()]
        ) / np.maximum(seen, 1) - 1e-4 * at
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        at = at + 0.6 * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-4)
    a, b, c = np.split(at, np.cumsum(sizes)[:-1])
    p, _ = marginals(emission(a, b), c.reshape(2, 2), bounds)
    x = document_features(p, bounds)
    share = toxic.mean() if len(toxic) else 0.5
    weight = np.where(toxic == 1, prior / max(share, 1e-9), (1 - prior) / max(1 - share, 1e-9))
    w = np.zeros(4)
    for _ in range(30):  # Newton steps of a logistic regression
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (toxic - q)) - 1e-2 * w
        curve = (x * (weight * q * (1 - q))[:, None]).T @ x + np.diag([1e-2] * 4)
        w = w + np.clip(np.linalg.solve(curve, grad), -2, 2)
    w[1:] = np.maximum(w[1:], 0)  # a surer word never lowers a score
    heads = {k[1 : 1 + STEMS[0]] for k in ids}
    return Field(dict(zip(ids, a.tolist())), heads, b.copy(), c.reshape(2, 2).copy(), w)


def fit_labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """A field from at most `sample` labelled documents per label, none of them held out.

    Rows with a null id, label or text are not used; of ids with both labels the toxic one counts.
    """
    kept = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out(F.col("doc_id")))
    kept = stage(kept.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "labels")
    prior = kept.agg(F.avg("toxic")).first()[0]
    parts = [kept.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for y in (0, 1)]
    chosen = stage(parts[0].unionByName(parts[1]), "sample")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    rows = rows.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).toPandas()  # at most 2 * sample
    rows = rows.sort_values("doc_id")
    return fit(rows["text"].tolist(), rows["toxic"].to_numpy(np.int64), float(prior or 0.5))


def tag(docs: DataFrame, field: Field) -> DataFrame:
    """(doc_id, score, spans) for each row; spans are (start, end, p), code points, of words likelier toxic than not.

    Neighbouring toxic words are one span with the greatest of their marginals. Null and empty texts have the
    score of a text in which no word is toxic, and no spans. Rows are neither merged nor dropped; an empty table
    gives an empty table; other columns are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, 1):
            words, index, bounds = coded_words(part.column(1))
            p, _ = marginals(field.emission(words)[index] if len(index) else np.zeros(0), field.moves, bounds)
            spans: list[list[dict]] = [[] for _ in range(part.num_rows)]
            hit = np.flatnonzero(p >= 0.5)
            for doc in np.unique(np.searchsorted(bounds, hit, side="right") - 1).tolist():
                last = -2
                for k, m in enumerate(WORD.finditer(part.column(1)[doc].as_py())):
                    q = float(p[bounds[doc] + k])
                    if q < 0.5:
                        continue
                    if last == k - 1:
                        spans[doc][-1] |= {"end": m.end(), "p": max(q, spans[doc][-1]["p"])}
                    else:
                        spans[doc].append({"start": m.start(), "end": m.end(), "p": q})
                    last = k
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(field.scores(p, bounds)),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))),
                ],
                names=["doc_id", "score", "spans"],
            )

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double, spans array<struct<start:int,end:int,p:double>>")
