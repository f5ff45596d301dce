"""Quality rules with compression bands.

Repetitive text compresses far better than prose and noise far worse, so a document is
kept if its zstandard ratio (bytes by compressed bytes) lies within the band of its length
class, and if at most a quarter of its bytes lie in fixed chunks outside the band of
chunks; a short last chunk is judged by the window of a chunk's size that ends with the
text. What is compressed is the text with one byte for a letter of any alphabet (two for a sign of a
syllabary; ideographs and Hangul keep their three), so the bands hold for prose in all scripts and not just
in those that UTF-8 writes with single bytes. Base rules on words come first. One pass without a shuffle; no count limits.

Edge cases: a null text is the empty one; without words ``base_failed`` is true and the document goes;
rows are independent, so repeated rows and null doc_ids give a row each.
"""

from __future__ import annotations

import bisect

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, equal_windows, intern, mixed, rolling, slices

CHUNK = 4 << 20
LEVEL = 3

#: (length class from so many bytes on, least ratio, greatest ratio). Short texts hardly
#: compress, long ones always do, so the band rises with the length.
BANDS = ((0, 0.0, 2.0), (100, 0.8, 2.2), (200, 0.95, 2.3), (400, 1.1, 2.35), (800, 1.35, 2.5),
         (1600, 1.45, 2.75), (3200, 1.5, 2.9), (6400, 1.55, 3.1), (12800, 1.6, 3.4), (51200, 1.6, 3.8))
PART = 2000
PART_BAND = (1.38, 2.75)
PART_SHARE = 0.25

SYMBOLS = b"#*$%&|<>"
BLANK = b" \t\n\v\f\r"
LATER_BYTES = bytes(range(0x80, 0xC0))
WINDOW = 8


class _Short(dict):
    """Code point -> its bytes for compression, as Latin-1 characters; filled as code points turn up."""

    def __missing__(self, point: int) -> str:
        low = 0x80 | point & 0x7F
        if point < 0x80:
            out = chr(point)
        elif 0x1200 <= point < 0x1680 or 0x3040 <= point < 0x3200:  # Ethiopic, Cherokee, Canadian syllabics; kana
            out = chr(0xC0 | point >> 7 & 0x3F) + chr(low)
        elif point < 0x2E80:
            out = chr(low)
        else:
            out = chr(point).encode("utf-8", "replace").decode("latin-1")
        self[point] = out
        return out


SHORT = _Short()


def letters_as_bytes(text: bytes) -> bytes:
    """The text as the bands judge it. Blocks of alphabets are 128 code points or less, so the low seven bits
    tell the letters of one script apart; ASCII is left as it is."""
    return text if text.isascii() else text.decode("utf-8", "replace").translate(SHORT).encode("latin-1")


def ratio(packer, text: bytes) -> float:
    return len(text) / len(packer.compress(text)) if text else 0.0


def in_bands(packer, text: bytes) -> tuple[bool, float, int, int]:
    """Verdict, ratio of the whole, number of chunks, chunks outside their band. Short pieces compress
    worse, so a last piece shorter than a chunk is judged by the last ``PART`` bytes of the text; it counts
    by its own bytes. Texts shorter than a chunk have none. Lengths are those of ``letters_as_bytes``."""
    text = letters_as_bytes(text)
    _, low, high = BANDS[bisect.bisect_right([b[0] for b in BANDS], len(text)) - 1]
    whole = ratio(packer, text)
    ends = [*range(PART, len(text) + 1, PART)]
    sizes = [PART] * len(ends)
    if ends and len(text) % PART:
        ends.append(len(text))
        sizes.append(len(text) % PART)
    out = [n for end, n in zip(ends, sizes, strict=True) if not PART_BAND[0] <= ratio(packer, text[end - PART:end]) <= PART_BAND[1]]
    return low <= whole <= high and sum(out) <= PART_SHARE * sum(sizes), whole, len(ends), len(out)


def duplicate_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(BLANK)]
    return len(lines) - len(set(lines))


def repeat_words(docs: list[list[bytes]]) -> np.ndarray:
    """Per document, words within a window that is found twice or more in it."""
    words = [w for d in docs for w in d]
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    if len(words) < WINDOW:
        return np.zeros(len(docs), np.int64)
    ids, word = intern(words)
    n = len(words) - WINDOW + 1
    starts = np.flatnonzero(owner[:n] == owner[WINDOW - 1:])
    # the owner is hashed with the words and compared with them: windows of two documents never meet
    h = rolling(word, WINDOW) ^ mixed((owner[:n] + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    at, _ = equal_windows(ids * len(docs) + owner, h, starts, WINDOW)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts[at], 1)
    np.add.at(edge, starts[at] + WINDOW, -1)
    return np.bincount(owner, np.cumsum(edge[:-1]) > 0, len(docs)).astype(np.int64)


FIELDS = (("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
          ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("zstd_ratio", pa.float64()),
          ("n_chunks", pa.int64()), ("n_chunks_out", pa.int64()))
TYPES = {pa.int64(): "long", pa.bool_(): "boolean", pa.float64(): "double"}


def _rated(batches):
    """Each slice of the batches with the columns of ``FIELDS`` for it."""
    packer = zstandard.ZstdCompressor(level=LEVEL)
    for b in slices(batches, "text", CHUNK):
        texts = [t or b"" for t in as_bytes(b.column(b.schema.get_field_index("text")))]
        words = [t.split() for t in texts]
        rows = []
        for t, w, rep in zip(texts, words, repeat_words(words).tolist(), strict=True):
            n = len(w)
            letters = t.translate(None, BLANK)
            failed = n < 20 or 100 * rep > 30 * n
            ok, whole, parts, out = in_bands(packer, t)
            rows.append((n, len(letters.translate(None, LATER_BYTES)), len(t) - len(t.translate(None, SYMBOLS)), duplicate_lines(t),
                         rep, failed, ok and not failed, whole, parts, out))
        yield b, {f: pa.array([r[i] for r in rows], kind) for i, (f, kind) in enumerate(FIELDS)}


def rate(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, the counts, ``base_failed``, ``kept`` and the ratios."""
    def run(batches):
        for b, cols in _rated(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), *cols.values()], ["doc_id", *cols])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, " + ", ".join(f"{f} {TYPES[t]}" for f, t in FIELDS))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, unchanged and with all columns."""
    names = [f"c{i}" if c != "text" else c for i, c in enumerate(docs.columns)]
    src = docs.toDF(*names)

    def run(batches):
        for b, cols in _rated(batches):
            yield b.filter(cols["kept"])

    return src.mapInArrow(run, src.schema).toDF(*docs.columns)
