"""Quality classifier on random-indexing word vectors.

1. Words hash to a fixed number of buckets; each bucket has a sparse random index vector, and its
   context vector is the sum of the index vectors of all words up to ``REACH`` places away, over
   the whole corpus. A task sums its documents into one matrix; stripes of it are
   summed per stripe. The matrix has a fixed size, so it may go to every task. The same pass
   stores the buckets of each document's words, so texts are split once.
2. Each document is pooled from its buckets: mean and spread of its words' vectors, mean of the vectors of their
   shapes (letter case, digits, signs), length, and share of distinct words.
3. A two-layer network learns from about ``SAMPLE`` labelled documents at most, taken by hash of their id; a
   fifth of these is kept apart to fit the temperature of its probabilities.
4. All documents are scored.

Labels, lang, source and doc_id are never inputs. Edge cases: a null text is the empty one, pooled to zeros
and scored like others; rows that repeat a doc_id get a score each, and the mean of its labels is its
label; a null doc_id is never held out nor learnt from; without labels of both
classes every score is the share of label 1, or a half.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLOBS, as_bytes, blob_rows, pack, slices, stored, tidy, unpack

BUCKETS, WIDTH, NONZERO, REACH = 8192, 32, 4, 2
STRIPES = 64
CHUNK = 4 << 20
SEGMENT = 1 << 17
SAMPLE = 20_000
HIDDEN, EPOCHS, RATE, DECAY = 24, 400, 0.01, 1e-3
THRESHOLD = 0.3
RUN = re.compile(rb"[A-Za-z0-9\x80-\xff]+|[^A-Za-z0-9\x80-\xff\x20\x09-\x0D]+")
SHAPES = bytes.maketrans(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789" + bytes(range(128, 256)), b"a" * 26 + b"A" * 26 + b"9" * 10 + b"a" * 128)
REPEATS = re.compile(rb"(.)\1+", re.S)
#: Changes of case and kind that a shape tells: with more, each random string would have a shape of its own.
SIGNS = 4
N_FEATURES = 3 * WIDTH + 3


def shape_of(word: bytes) -> bytes:
    """The first ``SIGNS`` signs, without repeats, that tell lower and upper case, digits and others of a word."""
    return b"\x00" + REPEATS.sub(rb"\1", word.translate(SHAPES))[:SIGNS]


def bucket(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) % BUCKETS


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Of each bucket: the places of its non-zero components, and their signs."""
    rng = np.random.default_rng(7)
    place = np.argsort(rng.random((BUCKETS, WIDTH)), 1)[:, :NONZERO]
    return place, rng.choice(np.array([-1, 1]), (BUCKETS, NONZERO))


def _tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets and shape buckets of all texts, the owner of each word, and distinct words per text."""
    words: dict[bytes, int] = {}
    ids, n, distinct = [], np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        w = RUN.findall(t) if t else []
        own = set(w)
        for x in own.difference(words):
            words[x] = len(words)
        ids.append(np.fromiter(map(words.__getitem__, w), np.int32, len(w)))
        n[i], distinct[i] = len(w), len(own)
    flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
    by_word = np.fromiter(map(bucket, words), np.int64, len(words))
    shapes: dict[bytes, int] = {}
    by_shape = np.fromiter((shapes.get(x) or shapes.setdefault(x, bucket(x)) for x in map(shape_of, words)), np.int64, len(words))
    return by_word[flat], by_shape[flat], np.repeat(np.arange(len(texts)), n), distinct


def add_contexts(total: np.ndarray, word: np.ndarray, shape: np.ndarray, owner: np.ndarray) -> None:
    """Add the index vectors of near words to ``total``, which counts positive and negative components apart."""
    place, sign = index_vectors()
    slot = [np.ascontiguousarray(place[:, j] + WIDTH * (sign[:, j] < 0)) for j in range(NONZERO)]
    for seq in (word, shape):
        for d in range(1, REACH + 1):
            near = owner[:-d] == owner[d:]
            a, c = seq[:-d][near], seq[d:][near]
            for x, y in ((a, c), (c, a)):
                base = x * (2 * WIDTH)
                for j in range(NONZERO):
                    total += np.bincount(base + slot[j][y], minlength=len(total))


_ROWS = "g int, blob binary, doc_id long, words long, distinct long"


def _split(batches):
    """A row per text with its buckets, and the summed contexts in stripes (``g``)."""
    total = np.zeros(BUCKETS * 2 * WIDTH, np.int64)
    for b in slices(batches, "text", CHUNK):
        word, shape, owner, distinct = _tokens(as_bytes(b.column("text")))
        add_contexts(total, word, shape, owner)
        n = np.bincount(owner, minlength=b.num_rows)
        ends = np.cumsum(n)
        word, shape = word.astype(np.uint16), shape.astype(np.uint16)
        blobs = [pack(word[hi - k:hi], shape[hi - k:hi]) for k, hi in zip(n.tolist(), ends.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.nulls(len(n), pa.int32()), pa.array(blobs, pa.binary()), b.column("doc_id"), pa.array(n, pa.int64()), pa.array(distinct, pa.int64())],
                                         ["g", "blob", "doc_id", "words", "distinct"])
    total = total.reshape(BUCKETS, 2, WIDTH)
    part = np.split((total[:, 0] - total[:, 1]).ravel(), STRIPES)
    rows = blob_rows([(i, pack(p)) for i, p in enumerate(part) if p.any()])
    none = pa.nulls(rows.num_rows, pa.int64())
    yield pa.RecordBatch.from_arrays([*rows.columns, none, none, none], ["g", "blob", "doc_id", "words", "distinct"])


def word_vectors(split: DataFrame) -> np.ndarray:
    """The context matrix of the corpus, rows scaled to length 1; its size doesn't depend on the data."""
    def total(t: pa.Table) -> pa.Table:
        s = sum(unpack(b, np.int64)[0] for b in t.column("blob").to_pylist())
        return pa.table({"g": pa.array([t.column("g")[0].as_py()], pa.int32()), "blob": pa.array([pack(s)], pa.binary())})

    out = np.zeros((STRIPES, BUCKETS * WIDTH // STRIPES))
    for r in split.filter("g is not null").select("g", "blob").groupBy("g").applyInArrow(tidy(total), BLOBS).collect():
        out[r.g] = unpack(r.blob, np.int64)[0]
    out = out.reshape(BUCKETS, WIDTH)
    return (out / np.maximum(1e-9, np.linalg.norm(out, axis=1, keepdims=True))).astype(np.float32)


def pool(word: np.ndarray, shape: np.ndarray, owner: np.ndarray, distinct: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Features of texts from the buckets of their words."""
    texts = len(distinct)
    n = np.bincount(owner, minlength=texts).astype(np.float64)
    sums = np.zeros((texts, 3, WIDTH))
    for lo in range(0, len(word), SEGMENT):
        o = owner[lo:lo + SEGMENT]
        begin = np.flatnonzero(np.concatenate(([True], o[1:] != o[:-1])))
        w = vectors[word[lo:lo + SEGMENT]]
        for k, x in enumerate((w, w * w, vectors[shape[lo:lo + SEGMENT]])):
            sums[o[begin], k] += np.add.reduceat(x, begin, axis=0)
    mean = sums / np.maximum(1, n)[:, None, None]
    spread = np.sqrt(np.maximum(0, mean[:, 1] - mean[:, 0] ** 2))
    return np.column_stack([mean[:, 0], spread, mean[:, 2], np.log1p(n), np.linalg.norm(mean[:, 0], axis=1), distinct / np.maximum(1, n)]).astype(np.float32)


def pooled(texts: list[bytes | None], vectors: np.ndarray) -> np.ndarray:
    """Features of the texts."""
    return pool(*_tokens(texts), vectors)


class Network:
    """Two layers with a calibrated temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 3):
        rng = np.random.default_rng(seed)
        apart = rng.random(len(x)) < 0.2
        if len(set(y[~apart])) < 2 or len(set(y[apart])) < 2:
            apart = np.zeros(len(x), bool)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        self.w = [rng.normal(size=(x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]), np.zeros(HIDDEN), rng.normal(size=(HIDDEN, 1)) / np.sqrt(HIDDEN), np.zeros(1)]
        self.temperature = 1.0
        z, t = (x[~apart] - self.mean) / self.scale, y[~apart].astype(float)
        first, second = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w]
        for step in range(1, EPOCHS + 1):
            hidden = np.tanh(z @ self.w[0] + self.w[1])
            p = 1 / (1 + np.exp(-np.clip((hidden @ self.w[2] + self.w[3])[:, 0], -40, 40)))
            d = ((p - t) / len(t))[:, None]
            back = (d @ self.w[2].T) * (1 - hidden ** 2)
            grads = [z.T @ back + DECAY * self.w[0], back.sum(0), hidden.T @ d + DECAY * self.w[2], d.sum(0)]
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                self.w[i] = self.w[i] - RATE * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
        if apart.any():
            logit, t = self.logits(x[apart]), y[apart].astype(float)
            grid = np.exp(np.linspace(np.log(0.2), np.log(10), 80))
            loss = [np.mean(np.logaddexp(0, logit / g) - t * logit / g) for g in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        return (np.tanh((x - self.mean) / self.scale @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3])[:, 0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x.astype(float)) / self.temperature, -40, 40)))


class Constant:
    def __init__(self, score: float):
        self.score = score

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.score)


def fit(x: np.ndarray, y: np.ndarray) -> Network | Constant:
    if len(set(y.tolist())) < 2:
        return Constant(float(y.mean()) if len(y) else 0.5)
    return Network(x.astype(float), y)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    split = stored(src.mapInArrow(_split, _ROWS), "words")
    vectors = word_vectors(split)

    def features(batches):
        for b in slices(batches, "blob", CHUNK // 4):
            found = [unpack(x, np.uint16, np.uint16) for x in b.column("blob").to_pylist()]
            word, shape = (np.concatenate([f[i] for f in found] or [np.empty(0, np.uint16)]) for i in range(2))
            owner = np.repeat(np.arange(b.num_rows), b.column("words").to_numpy(zero_copy_only=False))
            x = pool(word, shape, owner, b.column("distinct").to_numpy(zero_copy_only=False), vectors)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "x"])

    rows = stored(split.filter("g is null").select("blob", "doc_id", "words", "distinct").mapInArrow(features, "doc_id long, x binary"), "pooled")
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).filter("doc_id is not null and quality in (0, 1)")
             .filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("y")))
    known = rows.join(known, "doc_id")
    n = known.count()
    if n > sample:  # a share by hash, cut before anything is sent
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < (1 << 30) * sample // n)
    taught = sorted(known.select(F.xxhash64("doc_id").alias("h"), "x", "y").collect())
    x = np.frombuffer(b"".join(bytes(r.x) for r in taught), np.float32).reshape(-1, N_FEATURES)
    model = fit(x, np.array([r.y for r in taught], np.int64))

    def scores(batches):
        for b in batches:
            x = np.frombuffer(b"".join(b.column(1).to_pylist()), np.float32).reshape(-1, N_FEATURES)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.scores(x), pa.float64())], ["doc_id", "score"])

    out = rows.mapInArrow(scores, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
