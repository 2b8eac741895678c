"""Repeated byte strings by suffix arrays: two-stage sorting, then common prefixes of neighbours."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .spans import Chunk, Unit, _flat, without_repeats


def _ranked(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """at in the order of the strings of depth bytes that start there; words[i] has the bytes i to i + 7, the first one highest."""
    order = np.argsort(words[at], kind="stable")
    at = at[order]
    key = words[at]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    for step in range(8, depth, 8):
        # Only what still shares all bytes so far with a neighbour is sorted further.
        tied = np.flatnonzero(~new | ~np.append(new[1:], True))
        if not len(tied):
            break
        own, group = at[tied], np.cumsum(new)[tied]
        key = words[own + step]
        if step + 8 > depth:
            key &= ~np.uint64((1 << 8 * (step + 8 - depth)) - 1)
        order = np.lexsort((key, group))
        at[tied] = own[order]
        key, group = key[order], group[order]
        new[tied] = np.concatenate([[True], (key[1:] != key[:-1]) | (group[1:] != group[:-1])])
    return at


def types_of(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its successor, which is one character shorter (the end is smaller than all)."""
    n = len(text)
    if not n:
        return np.zeros(0, bool)
    differs = np.append(text[1:] != text[:-1], True)
    ends = np.flatnonzero(differs)
    up = np.append(text[ends[:-1]] < text[ends[:-1] + 1], False)
    return np.repeat(up, np.diff(np.append(-1, ends)))


def two_stage(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes that start at wanted (bool per position), sorted by their first depth bytes.

    Suffixes smaller than their successors are sorted directly. The others are induced: scanning the buckets (first bytes) upwards, each
    sorted suffix hands the one before it, if that is larger, to the bucket of its first byte, and they arrive there in order. Besides the
    wanted ones only those between a wanted one and the next directly sorted one take part, as they hand on its order.
    """
    n = len(text)
    small = types_of(text)
    # The stretch from a wanted suffix up to the next small one must be in.
    ends = np.where(small, np.arange(n), n - 1)
    ends = np.minimum.accumulate(ends[::-1])[::-1] if n else ends
    mark = np.zeros(n + 1, np.int64)
    places = np.flatnonzero(wanted)
    np.add.at(mark, places, 1)
    np.subtract.at(mark, ends[places] + 1, 1)
    member = np.cumsum(mark)[:n] > 0
    padded = np.concatenate([text, np.zeros(depth + 16, np.uint8)])
    words = np.ndarray((n + depth + 8,), ">u8", padded.tobytes(), 0, (1,)).astype(np.uint64)
    direct = _ranked(words, np.flatnonzero(member & small), depth)
    begins = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n and member[-1] and not small[-1]:
        waiting[text[-1]].append(np.array([n - 1]))
    done = []

    def hand_on(sorted_ones: np.ndarray, c: int) -> np.ndarray:
        """Predecessors that are induced: those of a later bucket wait there; those of this bucket are returned."""
        before = sorted_ones[sorted_ones > 0] - 1
        before = before[member[before] & ~small[before]]
        first = text[before]
        own = before[first == c]
        rest, first = before[first != c], first[first != c]
        order = np.argsort(first, kind="stable")
        rest, first = rest[order], first[order]
        cuts = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]])) if len(rest) else []
        for part in np.split(rest, cuts[1:]) if len(rest) else []:
            waiting[text[part[0]]].append(part)
        return own

    for c in range(256):
        wave = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(wave):
            done.append(wave)
            wave = hand_on(wave, c)
        own = direct[begins[c] : begins[c + 1]]
        done.append(own)
        if len(own):
            hand_on(own, c)
    array = np.concatenate(done) if done else np.zeros(0, np.int64)
    return array[wanted[array]]


def common_prefixes(text: np.ndarray, array: np.ndarray, most: int) -> np.ndarray:
    """Bytes that each suffix of the array shares with the one before it, up to most."""
    out = np.zeros(len(array), np.int64)
    padded = np.concatenate([text, np.zeros(most + 16, np.uint8)])
    words = np.ndarray((len(text) + most + 8,), ">u8", padded.tobytes(), 0, (1,)).astype(np.uint64)
    live = np.arange(1, len(array))
    for step in range(0, most, 8):
        differ = words[array[live] + step] ^ words[array[live - 1] + step]
        zero = differ == 0
        # Leading equal bytes: the position of the highest set bit, found byte by byte.
        lead = np.zeros(len(live), np.int64)
        for byte in range(1, 8):
            lead += differ < np.uint64(1 << (8 * (8 - byte)))
        out[live] += np.where(zero, 8, lead)
        live = live[zero]
        if not len(live):
            break
    return np.minimum(out, most)


class Bytes(Unit):
    """Windows of bytes, compared as bytes."""

    _TABLE = np.array([((i + 1) * 0x9E3779B97F4A7C15 ^ ((i + 7) * 0xD6E8FEB86659FD93 >> 11)) % (1 << 64) for i in range(256)], np.uint64)

    def __init__(self, length: int = 50, k: int = 16):
        self.length, self.k = length, min(k, length)

    def chunk(self, texts):
        joined = b"".join(texts)
        return Chunk(np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64), memoryview(joined), 1, np.frombuffer(joined, np.uint8))

    def items(self, chunk, start, stop):
        return self._TABLE[chunk.extra[start:stop]]

    def extent(self, n):
        return n + self.length - 1

    def smallest(self, ids, n, keys, data):
        # Equal fragments, which came from different chunks, stand in the text once, with the smallest of their ids.
        size = n + self.length - 1
        stop = np.cumsum(size)
        digest = xxhash.xxh3_128_digest
        marks = np.frombuffer(b"".join([digest(data[a:b]) for a, b in zip((stop - size).tolist(), stop.tolist(), strict=True)]), np.uint64).reshape(-1, 2)
        order = np.lexsort((marks[:, 0], marks[:, 1]))
        new = np.ones(len(order), bool)
        new[1:] = (marks[order[1:]] != marks[order[:-1]]).any(axis=1)
        own = np.empty(len(order), np.int64)
        own[order] = np.cumsum(new) - 1
        lead = order[new]
        least = np.full(len(lead), np.iinfo(np.int64).max)
        np.minimum.at(least, own, ids)
        text = np.frombuffer(data, np.uint8)[_flat((stop - size)[lead], size[lead])]
        got = self._smallest(least, n[lead], text)
        first = np.cumsum(n[lead]) - n[lead]
        return got[_flat(first[own], n)]

    def _smallest(self, ids: np.ndarray, n: np.ndarray, text: np.ndarray) -> np.ndarray:
        size = n + self.length - 1
        starts = _flat(np.cumsum(size) - size, n)
        wanted = np.zeros(len(text), bool)
        wanted[starts] = True
        array = two_stage(text, wanted, self.length)
        new = common_prefixes(text, array, self.length) < self.length
        new[:1] = True
        id_at = np.zeros(len(text), np.int64)
        id_at[starts] = np.repeat(ids, n)
        least = np.minimum.reduceat(id_at[array], np.flatnonzero(new))[np.cumsum(new) - 1]
        id_at[array] = least
        return id_at[starts]

    def cut(self, chunk, text, raw, gone):
        return (raw if gone is None else np.frombuffer(raw, np.uint8)[~gone].tobytes()), len(raw)


def without_repeated_strings(docs: DataFrame, length: int = 50, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, n_items (bytes), spans (maximal runs of removed bytes), text (binary: what is left), carried columns.

    A byte goes if a string of `length` bytes that covers it also starts in a document with a smaller id; strings are judged on the
    input. Each bucket of fragments gets a suffix array of its window starts; neighbours with a common prefix of `length` are one string.
    Null texts are empty; a null id counts as the largest; rows that share an id are one document and do not remove from each other;
    columns outside carry are not read; an empty table gives no rows.
    """
    return without_repeats(docs, Bytes(length), T.StructField("text", T.BinaryType()), id_col, text_col, carry)
