"""Token counts without ids: pieces are counted once per distinct pre-token and summed
over the pre-token frequencies of each document.

No piece of the vocabulary holds a space mark (U+2581) after another character, or a line
feed, so no merge crosses those places and a text's count is the sum over its
pre-tokens (``check_pieces`` verifies this for the given file).

1. A map task turns a slice of documents (a block) into a table of its distinct
   pre-tokens and the frequencies (document, pre-token, count) of its documents.
   Pre-tokens are dealt by hash, packed; this is the pre-aggregation.
2. Each hash group counts the pieces of each distinct pre-token, once, and
   returns the counts to the blocks.
3. Each block joins counts and frequencies and sums per document.

A frequent pre-token travels once per block, so no key is hot; a block is bounded by
``CHUNK`` bytes of text, or one document if that is longer.

Edge cases: a null text counts as the empty one: 0 bytes, 0 tokens; rows are independent, so
repeated rows and null doc_ids give a row each.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import groups, pack, slices, stored, tidy, unpack

CHUNK = 16 << 20
SPACE = "▁"
PRE_TOKEN = re.compile(f"{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+|\n+")


@functools.lru_cache(maxsize=2)
def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def check_pieces(path: str) -> None:
    """Raise if a piece crosses the places where texts are cut."""
    p = processor(path)
    for i in range(p.vocab_size()):
        piece = p.id_to_piece(i)
        if "\n" in piece or SPACE in piece.lstrip(SPACE):
            raise ValueError(f"piece {i} crosses a pre-token: {piece!r}")
    if p.encode("a  b", out_type=str)[:1] != [f"{SPACE}a"] or p.encode(" a")[1:] != p.encode("a"):
        raise ValueError("a model with a space mark before each text and no other changes to it is needed")


def pre_tokens(text: str) -> list[str]:
    return PRE_TOKEN.findall(SPACE + text.replace(" ", SPACE)) if text else []


def count_pieces(path: str, tokens: list[str]) -> np.ndarray:
    """Pieces of each pre-token. The library puts a space mark before what it encodes: it
    replaces the one that a pre-token starts with, or is taken off the count."""
    out = np.zeros(len(tokens), np.int64)
    marked = [i for i, t in enumerate(tokens) if t[0] == SPACE]
    plain = [i for i, t in enumerate(tokens) if t[0] not in (SPACE, "\n")]
    p = processor(path)
    for rows, texts, less in ((marked, [tokens[i][1:] for i in marked], 0), (plain, ["\n" + tokens[i] for i in plain], 2)):
        for lo in range(0, len(rows), 50_000):
            ids = p.encode(texts[lo:lo + 50_000], num_threads=1)
            out[rows[lo:lo + 50_000]] = np.fromiter(map(len, ids), np.int64, len(ids)) - less
    for i, t in enumerate(tokens):
        if t[0] == "\n":
            out[i] = len(t)
        elif t == SPACE:  # the library gives no piece for an empty text
            out[i] = 1
    return out


def planes(a: np.ndarray) -> np.ndarray:
    """Small numbers as bytes, all lowest bytes first: the others are mostly 0 and compress away."""
    return np.ascontiguousarray(a.astype(np.int32).view(np.uint8).reshape(-1, 4).T).ravel()


def from_planes(b: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(b.reshape(4, -1).T).ravel().view(np.int32).astype(np.int64)


def _blocks(n_groups: int):
    def run(batches):
        part = TaskContext.get().partitionId()
        for k, b in enumerate(slices(batches, "text", CHUNK)):
            known: dict[str, int] = {}
            get = known.setdefault
            texts = b.column("text").to_pylist()
            tok, n, owner = [], [], []
            for t in texts:
                w = pre_tokens(t or "")
                ids, c = np.unique(np.fromiter((get(x, len(known)) for x in w), np.int32, len(w)), return_counts=True)
                tok.append(ids), n.append(c.astype(np.int32)), owner.append(len(ids))
            words = [w.encode() for w in known]
            g = np.fromiter((xxhash.xxh3_64_intdigest(w) % n_groups for w in words), np.int64, len(words))
            order = np.argsort(g, kind="stable")
            # pre-tokens are numbered by (group, first use), the order in which their counts come back
            number = np.empty(len(words), np.int32)
            number[order] = np.arange(len(words), dtype=np.int32)
            size = np.array(pa.compute.binary_length(b.column("text")).fill_null(0), np.int64)
            doc = b.column("doc_id")
            # each document's numbers in order, as steps from one to the next
            of, n_tok = np.concatenate([*tok, np.empty(0, np.int32)]), np.array(owner, np.int64)
            step, times = number[of].astype(np.int64), np.concatenate([*n, np.empty(0, np.int32)])
            by = np.lexsort((step, np.repeat(np.arange(len(owner)), n_tok)))
            step, times = step[by], times[by]
            first = (np.cumsum(n_tok) - n_tok)[n_tok > 0]
            step[1:] -= step[:-1].copy()
            step[first[1:]] = number[of][by][first[1:]]
            freq = pack(doc.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), doc.is_null().to_numpy(zero_copy_only=False).astype(np.int8), size,
                        n_tok, planes(step), planes(times))
            block = (part << 24) + k
            rows = [(block, -1, freq)]
            cuts = np.flatnonzero(np.diff(g[order])) + 1
            for p in np.split(order, cuts):
                if len(p):
                    chosen = [words[i] for i in p.tolist()]
                    rows.append((block, int(g[p[0]]), pack(np.fromiter(map(len, chosen), np.int32, len(chosen)), text=b"".join(chosen))))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.binary()))], ["block", "g", "blob"])
    return run


def _count_group(path: str):
    def run(t: pa.Table) -> pa.Table:
        known: dict[str, int] = {}
        get = known.setdefault
        blocks = []
        for blob in t.column("blob").to_pylist():
            n, text = unpack(blob, np.int32)
            ends = np.cumsum(n).tolist()
            words = [text[lo:hi].decode() for lo, hi in zip([0, *ends[:-1]], ends, strict=True)]
            blocks.append(np.fromiter((get(w, len(known)) for w in words), np.int64, len(words)))
        count = count_pieces(path, list(known)).astype(np.int32)
        return pa.table({"block": t.column("block"), "g": t.column("g"), "blob": pa.array([pack(count[i]) for i in blocks], pa.binary())})
    return run


def _sum_block(t: pa.Table) -> pa.Table:
    rows = sorted(zip(t.column("g").to_pylist(), t.column("blob").to_pylist(), strict=True))
    doc, null, size, n_tok, step, times, _ = unpack(rows[0][1], np.int64, np.int8, np.int64, np.int64, np.uint8, np.uint8)
    number, n = np.cumsum(from_planes(step)), from_planes(times)
    first = np.cumsum(n_tok) - n_tok
    number -= np.repeat(np.concatenate(([0], number))[first], n_tok)
    pieces = np.concatenate([unpack(b, np.int32)[0] for _, b in rows[1:]] or [np.empty(0, np.int32)]).astype(np.int64)
    run = np.concatenate(([0], np.cumsum(pieces[number] * n)))
    ends = np.cumsum(n_tok)
    return pa.table({"doc_id": pa.array(doc, pa.int64(), mask=null.astype(bool)), "n_bytes": size, "n_tokens": run[ends] - run[ends - n_tok]})


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row."""
    check_pieces(path)
    spark = docs.sparkSession
    packed = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                    .mapInArrow(_blocks(groups(spark)), "block long, g int, blob binary"), "pre-tokens")
    counts = packed.filter("g >= 0").groupBy("g").applyInArrow(tidy(_count_group(path)), "block long, g int, blob binary")
    both = packed.filter("g < 0").unionByName(counts)
    return both.groupBy("block").applyInArrow(tidy(_sum_block), "doc_id long, n_bytes long, n_tokens long")


def digest(counts: DataFrame, limit: int = 4096) -> DataFrame:
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
