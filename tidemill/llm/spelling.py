"""Spelling variants: each word's full neighbourhood of one edit is generated and hash-joined to the vocabulary."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, lean, staged
from .decontaminate import Filter
from .decontaminate import _filter as bloom_filter

LETTERS = "A-Za-zÀ-ÿ"
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Characters of a text that are split at once; words that a task counts before it hands on partial sums; numbers that a task holds at once.
STRETCH, COUNTED, HELD = 1 << 20, 300_000, 1 << 22

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def runs(text: str, pattern: re.Pattern, reach: re.Pattern):
    """Lists of the runs of letters in text, for one stretch after the other; no run is cut."""
    at = 0
    while at < len(text):
        end = min(len(text), at + STRETCH)
        if end < len(text):
            end = reach.match(text, end).end()
        yield pattern.findall(text, at, end)
        at = end


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: str = LETTERS, least_chars: int = 5, least: int = 3, slips: int | None = None) -> DataFrame:
    """(word, n): the words of at least `least_chars` code points that occur `least` times or more in all texts.

    Words are maximal runs of `letters` (a regular expression's class), lower-cased in A-Z only. With slips, a run loses one code point where
    crc32 of `<id>:<run>` is divisible by slips: the one at that number modulo its length. It stands for a misspelling of one document.
    Whole texts; null and empty ones have no words; a null id is an empty one; repeated rows count each; an empty table gives no rows. Words are
    counted in each task before the shuffle, so a frequent one sends a row from each task.
    """
    bounded_batches(docs.sparkSession)
    pattern, reach = re.compile(f"[{letters}]+"), re.compile(f"[{letters}]*")

    def out(total):
        rows = list(total.items())
        for i in range(0, len(rows), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[i : i + 50_000]], pa.string()), pa.array([r[1] for r in rows[i : i + 50_000]], pa.int64())], names=["word", "n"])

    def run(batches):
        total: Counter[str] = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for found in runs(text or "", pattern, reach):
                    for word, n in Counter(x.translate(_LOWER) for x in found if len(x) >= least_chars).items():
                        if slips:
                            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode("utf-8", "surrogatepass"))
                            if h % slips == 0:
                                i = h % len(word)
                                word = word[:i] + word[i + 1 :]
                                if len(word) < least_chars:
                                    continue
                        total[word] += n
                    if len(total) > COUNTED:
                        yield from out(total)
                        total.clear()
        yield from out(total)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(lean(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _value(points: np.ndarray) -> np.ndarray:
    """A 64-bit number for each code point."""
    x = (points.astype(_U) + _U(1)) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(32))


def _powers(n: int) -> np.ndarray:
    return np.array([pow(_BASE, i, 1 << 64) for i in range(n + 1)], _U)


class Words:
    """Words of one length as a matrix of code points, and sums from which the hash of any word one edit away follows.

    A word's hash is the sum of value(code point) * base ** position, modulo 2 ** 64.
    """

    def __init__(self, words: list[str]):
        self.words, self.length = words, len(words[0])
        self.points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), self.length)
        self.power = _powers(self.length + 1)
        self.values = _value(self.points)
        terms = self.values * self.power[: self.length]
        self.before = np.concatenate([np.zeros((len(words), 1), _U), np.cumsum(terms, axis=1, dtype=_U)], axis=1)
        self.hash = self.before[:, -1]
        self.after = self.hash[:, None] - self.before

    def deletions(self) -> tuple[np.ndarray, np.ndarray]:
        """(hashes, allowed), a column for each position. Of equal neighbours only the first is deleted: the others give the same word."""
        allowed = np.ones(self.points.shape, bool)
        allowed[:, 1:] = self.points[:, 1:] != self.points[:, :-1]
        return self.before[:, :-1] + self.after[:, 1:] * _U(_INVERSE), allowed

    def replacements(self, point: int) -> tuple[np.ndarray, np.ndarray]:
        """With point at each position where it does not stand."""
        return self.hash[:, None] + (_value(np.array([point])) - self.values) * self.power[: self.length], self.points != point

    def insertions(self, point: int) -> tuple[np.ndarray, np.ndarray]:
        """With point before each position, but not before itself (as after it), and at the end."""
        allowed = np.ones((len(self.words), self.length + 1), bool)
        allowed[:, :-1] = self.points != point
        return self.before + _value(np.array([point])) * self.power[: self.length + 1] + self.after * _U(_BASE), allowed


def edits(group: Words, alphabet: list[str]):
    """(character put in, characters left out, hashes, allowed) for all deletions, and the replacements and insertions of each character."""
    yield "", 1, *group.deletions()
    for c in alphabet:
        yield c, 1, *group.replacements(ord(c))
        yield c, 0, *group.insertions(ord(c))


def neighbourhood(words: list[str], alphabet: list[str], passes=None):
    """(number of the word, candidate) lists: all distinct words one deletion, replacement or insertion of a character of `alphabet` away from
    each word; with passes (hashes -> where those stand that pass), those of them alone."""
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w), []).append(i)
    for length, numbers in by_length.items():
        for at in range(0, len(numbers), step := max(1, HELD // (length + 1))):
            own = numbers[at : at + step]
            for c, skipped, hashed, allowed in edits(Words([words[i] for i in own]), alphabet):
                flat = np.flatnonzero(allowed)
                if passes is not None:
                    flat = flat[passes(hashed.ravel()[flat])]
                places = [(own[i], p) for i, p in zip(*(x.tolist() for x in np.divmod(flat, hashed.shape[1])), strict=True)]
                yield [i for i, _ in places], [words[i][:p] + c + words[i][p + skipped :] for i, p in places]


def hashes(words: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            own = batch.column(0).to_pylist()
            h = np.zeros(len(own), _U)
            by_length: dict[int, list[int]] = {}
            for i, w in enumerate(own):
                by_length.setdefault(len(w), []).append(i)
            for numbers in by_length.values():
                h[numbers] = Words([own[i] for i in numbers]).hash
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])

    return words.select("word").mapInArrow(lean(run), "h long")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): the pairs of words, distinct in `words` (word, n), that are exactly one inserted, deleted or replaced code point apart.

    Each word emits its whole neighbourhood over the alphabet that the words use; candidates are joined to the words by hash of the whole word, so
    what meets is near by construction and no distance is measured. A Bloom filter of the words (at most 64 MB) spares most candidates the
    shuffle; it never stops one that is a word. A word is emitted at most once by each of its neighbours, so no key of the join is hot.
    """
    spark = words.sparkSession
    characters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).filter("c <> ''").distinct()
    alphabet = sorted(r.c for r in characters.collect())  # bounded by the class of letters that words are made of
    filter_ = spark.sparkContext.broadcast(bloom_filter(staged(hashes(words), "word-hashes")))

    def run(batches):
        passes = Filter(filter_.value)
        for batch in batches:
            own, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for rows, found in neighbourhood(own, alphabet, passes):
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([own[i] for i in rows], pa.string()), pa.array(counts[rows], pa.int64()), pa.array(found, pa.string())], names=["word", "n", "near"])

    candidates = words.select("word", "n").mapInArrow(lean(run), "word string, n long, near string")
    return candidates.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select("word", "n", "near", "near_n")


def roots(links: DataFrame, rounds: int = 40) -> DataFrame:
    """(word, root) for each word of links (word, form), following forms to the last, which has none. Links have no circle.

    Pointer doubling: after each round a pointer reaches twice as far. Those that have arrived are set aside; the rest are staged.
    """
    done, going = [], staged(links.select("word", F.col("form").alias("to")), "links")
    for _ in range(rounds):
        step = going.join(going.select(F.col("word").alias("at"), F.col("to").alias("next")), F.col("to") == F.col("at"), "left")
        moved = staged(step.select("word", F.coalesce("next", "to").alias("root"), F.col("next").isNotNull().alias("moved")), "pointers")
        if not moved.filter("moved").limit(1).count():
            return moved.select("word", "root")
        going = moved.select("word", F.col("root").alias("to"))
    raise RuntimeError(f"some forms are still not at their end after {rounds} doublings")


def variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """One row for each of the distinct words (word, n): word, form, root, n, n_near, form_n.

    form is the near word of largest n, of equal ones the smallest in code-point order, if that n is at least `ratio` (2 or more) times the word's own; else null. root
    follows forms to the last one; it is the word itself without a form. n_near counts the near words, form_n is the form's n or null. Words
    without neighbours are kept; no words give no rows; other columns of words are not read.
    """
    if ratio < 2:
        raise ValueError("with a ratio below 2 forms could lead in a circle")
    own = words.select("word", "n")
    # Of structs the least: by count, then by the word's bytes in UTF-8, whose order is that of code points.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near")))
    near = neighbours(own).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = own.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))
    follows = F.col("near_n") >= ratio * F.col("n")
    found = staged(joined.select("word", "n", "n_near", F.when(follows, F.col("near")).alias("form"), F.when(follows, F.col("near_n")).alias("form_n")), "variants")
    ends = roots(found.filter("form IS NOT NULL").select("word", "form"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
