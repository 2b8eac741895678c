"""Repeated passages of words: count-min prefilter of windows, then exact grouping of the windows estimated repeated."""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .spans import CHUNK, Chunk, Unit, without_repeats
from .windows import rolling

_PLACES = re.compile(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+")


class _Digests(dict):
    """128-bit digests of words."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > 150_000:
            self.clear()
        self[word] = got = xxhash.xxh3_128_digest(word)
        return got


class Words(Unit):
    """Windows of words. Two windows are one if the minimizer's 64-bit hash and the window's, made from other halves of the words' digests, agree."""

    _BASE = 0xC2B2AE3D27D4EB4F

    def __init__(self, length: int = 50, k: int = 16, layout: bool = False):
        self.length, self.k, self.layout = length, min(k, length), layout

    def chunk(self, texts: list[bytes]) -> Chunk:
        known = _Digests()
        words = [t.split() for t in texts]
        both = np.frombuffer(b"".join([known[w] for ws in words for w in ws]), "<u8").reshape(-1, 2)
        bounds = np.concatenate([[0], np.cumsum([len(ws) for ws in words])]).astype(np.int64)
        windows = rolling(both[:, 1], self.length, self._BASE)
        return Chunk(bounds, memoryview(windows.tobytes()), 8, (words, np.ascontiguousarray(both[:, 0])))

    def items(self, chunk, start, stop):
        return chunk.extra[1][start:stop]

    def extent(self, n):
        return n

    def smallest(self, ids, n, keys, data):
        windows = np.frombuffer(data, np.uint64)
        ids, keys = np.repeat(ids, n), np.repeat(keys, n)
        order = np.lexsort((windows, keys))
        w, k = windows[order], keys[order]
        new = np.concatenate([[True], (w[1:] != w[:-1]) | (k[1:] != k[:-1])])
        out = np.empty(len(ids), np.int64)
        out[order] = np.minimum.reduceat(ids[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        return out

    def cut(self, chunk, text, raw, gone):
        words = chunk.extra[0][text]
        if gone is None:
            return (raw if self.layout else b" ".join(words)).decode("utf-8", "replace"), len(words)
        if self.layout:
            # Each kept word with the blanks before it.
            kept = [part for part, g in zip(_PLACES.findall(raw), gone.tolist(), strict=True) if not g]
            return b"".join(kept).lstrip().decode("utf-8", "replace"), len(words)
        return b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]).decode("utf-8", "replace"), len(words)


def without_repeated_passages(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), layout: bool = False, chunk_bytes: int = CHUNK) -> DataFrame:
    """One row per document: doc_id, n_items (words), spans (runs of removed words), text (kept words, joined by one space), carried columns.

    With layout, the text keeps its own blanks and line ends instead. chunk_bytes is what a task holds of texts at once.

    A word goes if a window of `length` words that covers it also starts in a document with a smaller id; windows are judged on the
    input. Null and empty texts have no words; texts shorter than a window stay; a null id counts as the largest; rows that share an id are
    one document and do not remove from each other; columns outside carry are not read; an empty table gives no rows.
    """
    return without_repeats(docs, Words(length, layout=layout), T.StructField("text", T.StringType()), id_col, text_col, carry, chunk_bytes)
