"""Byte-level BPE encoding and decoding with a pair occurrence index.

A map task takes its documents in slices. The distinct pre-tokens of a slice lie in one
array of symbols, and an index maps each mergeable pair to all its positions there.
Active ranks are taken in ascending order: the positions of the pair are
merged at once, the neighbouring pairs change, and the new ones join the lists of
their ranks. A document's ids are then gathered from those of its pre-tokens.
No shuffle; memory is bounded by ``CHUNK`` bytes of text, or one document if
that is longer.

The vocabulary file is a ``tokenizers`` JSON of a byte-level BPE; its path must be
valid on every worker. Added special tokens found in a text become their id (the
library's default); none is added.

Edge cases: a null text is encoded as the empty one (no ids); a null id list decodes to
the empty text; a null id inside is skipped; rows are independent, so repeated rows and null doc_ids give a row each.
"""

from __future__ import annotations

import functools
import heapq
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

CHUNK = 8 << 20

#: Fixed value: the pattern by which byte-level BPE splits a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Characters whose class is the same in all recent Unicode versions. A text with
#: others is split by the library, whose Unicode tables may be older than ours.
STABLE = r"[\x00-\u0557\u2010-\u2070\u3000-\u30FF\u4E00-\u9FA5\uAC00-\uD7A3]*"


def byte_names() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary:
    itself where it is printable, else the next one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """Ranks, ids and bytes of a tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids, names = spec["model"]["vocab"], byte_names()
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.left = np.array([ids[a] for a, _ in merges], np.int32)
        self.right = np.array([ids[b] for _, b in merges], np.int32)
        self.made = np.array([ids[a + b] for a, b in merges], np.int32)
        code = self.left.astype(np.int64) << 32 | self.right
        order = np.argsort(code)
        self.code, self.rank = code[order], order.astype(np.int32)
        self.of_byte = np.array([ids[names[b]] for b in range(256)], np.int32)
        n = 1 + int(self.of_byte.max())
        self.square = np.full((n, n), -1, np.int32)
        small = (self.left < n) & (self.right < n)
        self.square[self.left[small], self.right[small]] = np.flatnonzero(small)
        back = {c: b for b, c in names.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.bytes = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for name, i in ids.items():
            self.bytes[i] = bytes(back[c] for c in name)
        for name, i in self.special.items():
            self.bytes[i] = name.encode()
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pattern, self.stable = regex.compile(PATTERN), regex.compile(STABLE)
        self.library = Tokenizer.from_file(path).pre_tokenizer

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 if it can't be merged."""
        code = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return np.where(self.code[at] == code, self.rank[at], -1)

    def pre_tokens(self, text: str) -> list[str | int]:
        """Pre-tokens in order; a special token as its id."""
        if self.split_special is None or not any(s in text for s in self.special):
            return self._split(text)
        out: list[str | int] = []
        for i, part in enumerate(self.split_special.split(text)):
            out += [self.special[part]] if i % 2 else self._split(part)
        return out

    def _split(self, text: str) -> list[str]:
        if text.isascii() or self.stable.fullmatch(text):
            return self.pattern.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_pairs(v: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words, one after another, and how many each word has."""
    raw = np.frombuffer(b"".join(words), np.uint8)
    length = np.fromiter(map(len, words), np.int64, len(words))
    start = np.cumsum(length) - length + np.arange(len(words)) + 1  # a separator before each word
    sym = np.full(len(raw) + len(words) + 1, -1, np.int32)
    sym[np.arange(len(raw)) + np.repeat(np.arange(len(words)) + 1, length)] = v.of_byte[raw]
    nxt = np.arange(1, len(sym) + 1, dtype=np.int32)
    prv = np.arange(-1, len(sym) - 1, dtype=np.int32)

    where: dict[int, list[np.ndarray]] = {}
    active: list[int] = []

    def index(rank: np.ndarray, pos: np.ndarray) -> None:
        order = np.argsort(rank, kind="stable")
        rank, pos = rank[order], pos[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        for r, lo, hi in zip(rank[np.concatenate(([0], cuts))].tolist(), [0, *cuts.tolist()], [*cuts.tolist(), len(pos)], strict=True):
            if r in where:
                where[r].append(pos[lo:hi])
            else:
                where[r] = [pos[lo:hi]]
                heapq.heappush(active, r)

    pos = np.flatnonzero((sym[:-1] >= 0) & (sym[1:] >= 0)).astype(np.int32)
    rank = v.square[sym[pos], sym[pos + 1]]
    if (rank >= 0).any():
        index(rank[rank >= 0], pos[rank >= 0])
    while active:
        r = heapq.heappop(active)
        lists = where.pop(r)
        pos = np.unique(np.concatenate(lists))
        a, b, new = v.left[r], v.right[r], v.made[r]
        q = nxt[pos]
        ok = (sym[pos] == a) & (sym[q] == b)
        if not ok.all():
            pos, q = pos[ok], q[ok]
        if a == b and len(pos) > 1:  # in a run of the symbol every second position starts a merge
            begin = np.concatenate(([True], pos[1:] != q[:-1]))
            i = np.arange(len(pos))
            odd = (i - np.maximum.accumulate(np.where(begin, i, 0))) & 1
            pos, q = pos[odd == 0], q[odd == 0]
        if not len(pos):
            continue
        after = nxt[q]
        sym[pos], sym[q] = new, -2
        nxt[pos] = after
        prv[after] = pos
        before = prv[pos]
        left, right = sym[before] >= 0, sym[after] >= 0
        at = np.concatenate((before[left], pos[right]))
        if len(at):
            rank = v.ranks(sym[at], sym[nxt[at]])
            ok = rank >= 0
            if ok.any():
                index(rank[ok], at[ok])
    alive = sym >= 0
    count = np.add.reduceat(alive, start - 1).astype(np.int64) if len(words) else np.empty(0, np.int64)
    return sym[alive], count


def encode_texts(v: Vocabulary, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, one after another, and how many each text has."""
    known: dict[str | int, int] = {}
    get = known.setdefault
    parts = []
    for t in texts:
        w = v.pre_tokens(t) if t else []
        parts.append(np.fromiter((get(x, len(known)) for x in w), np.int32, len(w)))
    words = list(known)
    flat, count = merge_pairs(v, [b"" if isinstance(w, int) else w.encode() for w in words])
    special = np.array([i for i, w in enumerate(words) if isinstance(w, int)], np.int64)
    if len(special):
        at = (np.cumsum(count) - count)[special]
        flat = np.insert(flat, at, [words[i] for i in special])
        count[special] = 1
    use = np.concatenate(parts) if parts else np.empty(0, np.int32)
    if not len(use):
        return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
    begin = np.cumsum(count) - count
    n = count[use]
    ids = flat[np.repeat(begin[use] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
    ends = np.concatenate(([0], np.cumsum(n)))[np.cumsum([len(p) for p in parts])]
    return ids, np.diff(ends, prepend=0)


def decode_ids(v: Vocabulary, ids: list[int]) -> str:
    table = v.bytes
    return b"".join([table[i] for i in ids]).decode("utf-8", "replace")


def _encoder(path: str, decoded: bool):
    def run(batches):
        v = vocabulary(path)
        for b in slices(batches, "text", CHUNK):
            ids, count = encode_texts(v, b.column("text").to_pylist())
            ends = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
            cols = [b.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))]
            if decoded:
                cols.append(pa.array([decode_ids(v, ids[lo:hi].tolist()) for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "ids", "decoded"][:len(cols)])
    return run


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every row."""
    return _source(docs).mapInArrow(_encoder(path, False), "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded): ids of every row, and the text that they decode to, in one pass."""
    return _source(docs).mapInArrow(_encoder(path, True), "doc_id long, ids array<int>, decoded string")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows with ``ids``."""
    def run(batches):
        v = vocabulary(path)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([decode_ids(v, [i for i in x or () if i is not None]) for x in b.column(1).to_pylist()], pa.string())], ["doc_id", "text"])
    return encoded.select("doc_id", F.col("ids").cast("array<int>").alias("ids")).mapInArrow(run, "doc_id long, text string")


def digest(coded: DataFrame) -> DataFrame:
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
