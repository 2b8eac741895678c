"""Benchmark decontamination by templates: numbers, names and units become typed slots, template windows are hash-joined, slots must agree."""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, in_chunks, lean, staged
from .windows import rolling

WINDOW = 8
#: A template window needs so many tokens that are not slots; where one has fewer, a longer one (of the whole item, if that is shorter) takes its place.
LITERALS, LONGER = 4, (16, 32)
#: Items of fewer tokens are matched as they are, not renamed: nearly any text holds their templates.
RENAMED_FROM = 5
#: A window in more items than this is common. It decides how documents are found, not which.
COMMON = 8
#: Share of an item's tokens that must be matched along one chain of alignments.
COVERAGE = 0.4
#: A copy with insertions may be so many times as long as its item.
SPREAD = 2
#: Bits of the filter for each window of the benchmark, and (as a power of two) at least and at most; with more windows than the largest serves, more of the documents' windows pass it.
FILTER_BITS, FILTER_LEAST, FILTER_MOST = 32, 17, 29
#: Words whose forms a task remembers, and bytes of text that are cut into windows together.
REMEMBERED, PART = 150_000, 1 << 20

UNITS = frozenset("km m cm mm mi mile miles ft feet inch inches yd kg g mg lb lbs oz ton tons l ml s sec second seconds min minute minutes h hour hours day days week weeks month months year years usd eur dollar dollars euro euros cent cents percent degrees mph kph kmh hz khz mhz ghz kb mb gb tb w kw v".split())
NUMBERS = frozenset("zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million billion half dozen".split())
TYPES = {"<num>": "#", "<unit>": "~", "<name>": "@"}
_NUMBER = re.compile(r"[+\-$€£]*\d[\d.,:/%-]*(?:st|nd|rd|th|[a-z]{1,3})?")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def token(word: str) -> tuple[str, str] | None:
    """(plain form, template form) of a word; None if it has no letter or digit."""
    bare = _EDGE.sub("", word)
    if not bare:
        return None
    plain = bare.lower()
    if _NUMBER.fullmatch(plain) or plain in NUMBERS:
        return plain, "<num>"
    if plain in UNITS:
        return plain, "<unit>"
    if bare[0].isupper() and (len(bare) == 1 or not bare.isupper()):
        return plain, "<name>"
    return plain, plain


class Tokens(dict):
    """Of a word, as bytes: 16 bytes with the hashes of both forms and 1 byte, 1 for a slot; empty if it is no token."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) > REMEMBERED:
            self.clear()
        text = word.decode("utf-8", "replace")
        # Most words are lower-case letters; those that are no number and no unit are their own two forms.
        forms = (text, text) if text.isalpha() and text.islower() and text not in NUMBERS and text not in UNITS else token(text)
        if forms is None:
            got = b""
        else:
            one = xxhash.xxh3_64_digest(forms[0])
            got = one + (one if forms[1] == forms[0] else xxhash.xxh3_64_digest(forms[1])) + (b"\1" if forms[1][:1] == "<" else b"\0")
        self[word] = got
        return got


class Cut:
    """The tokens of some texts, and their windows."""

    def __init__(self, texts: list[bytes], known: Tokens):
        split = [t.split() for t in texts]
        self.words = list(chain.from_iterable(split))
        marks = [known[w] for w in self.words]
        keep = np.fromiter(map(len, marks), np.int64, len(marks)) > 0
        self.owner = np.repeat(np.arange(len(texts)), [len(x) for x in split])[keep] if len(marks) else np.zeros(0, np.int64)
        raw = np.frombuffer(b"".join(marks), np.uint8).reshape(-1, 17)
        self.place = np.flatnonzero(keep)  # of each token among the words
        self.items = [np.ascontiguousarray(raw[:, 8 * k : 8 * k + 8]).view(np.uint64).ravel() for k in (0, 1)]
        self.slots = np.concatenate([[0], np.cumsum(raw[:, 16], dtype=np.int64)])
        self.counts = np.bincount(self.owner, minlength=len(texts))
        self.first = np.cumsum(self.counts) - self.counts

    def starts(self, kind: int, n: int) -> np.ndarray:
        """Where windows of n tokens of one text start; those of templates (kind 1) have a slot and, besides, LITERALS others."""
        if len(self.owner) < n:
            return np.zeros(0, np.int64)
        start = np.flatnonzero(self.owner[n - 1 :] == self.owner[: len(self.owner) - n + 1])
        if kind:
            inside = self.slots[start + n] - self.slots[start]
            # A window without a slot is the same in both forms.
            start = start[(inside > 0) & (n - inside >= LITERALS)]
        return start

    def hashes(self, kind: int, n: int, start: np.ndarray) -> np.ndarray:
        return (rolling(self.items[kind], n) * np.uint64(2) + np.uint64(kind))[start] ^ np.uint64(n << 32)

    def rows(self, ids: list[tuple], kind: int, n: int, start: np.ndarray, h: np.ndarray):
        """Batches of (h, row, id, pos, tokens, kind, n, slots): slots are the places of a template window's slots and their values, each a type and a plain form."""
        for at in range(0, len(h), 20_000):
            cut, own = start[at : at + 20_000], self.owner[start[at : at + 20_000]]
            places, values = [], []
            for s in cut.tolist() if kind else ():
                inside = [i for i in range(n) if self.slots[s + i + 1] > self.slots[s + i]]
                forms = [token(self.words[self.place[s + i]].decode("utf-8", "replace")) for i in inside]
                places.append(inside)
                values.append([TYPES[f[1]] + f[0] for f in forms])
            full = lambda x, k=len(cut): pa.array(np.full(k, x, np.int32))
            columns = [pa.array(h[at : at + 20_000].view(np.int64)), pa.array([ids[o][0] for o in own.tolist()], pa.int64()), pa.array([ids[o][1] for o in own.tolist()], pa.int64()), pa.array(cut - self.first[own], pa.int64()), pa.array(self.counts[own], pa.int64()), full(kind), full(n)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(places if kind else [None] * len(cut), pa.list_(pa.int32())), pa.array(values if kind else [None] * len(cut), pa.list_(pa.string()))], names=NAMES)


NAMES = ["h", "row", "id", "pos", "tokens", "kind", "n", "places", "slots"]
SCHEMA = "h long, row long, id long, pos long, tokens long, kind int, n int, places array<int>, slots array<string>"


def _cuts(batches):
    """([(row, id)], their tokens) for some rows after the other."""
    known = Tokens()
    for batch in batches:
        rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True)
        for some in in_chunks(rows, lambda r: len(r[2].as_buffer()) + 64, PART):
            yield [r[:2] for r in some], Cut([r[2].as_py() for r in some], known)


def _item_windows(cut: Cut, window: int):
    """(kind, n, starts) of the windows by which items are found: those of `window` tokens or of the whole item, if it is shorter. Where such a
    template window has too few literals, a longer one that starts there, or that ends with the item, takes its place."""
    counts, first = cut.counts, cut.first
    for n in range(1, window + 1):
        fits = lambda start, n=n: start if n == window else start[counts[cut.owner[start]] == n]
        yield 0, n, fits(cut.starts(0, n))
        if n >= RENAMED_FROM:
            yield 1, n, fits(cut.starts(1, n))
    # Of the longer ones, by length: where they start.
    wanted: dict[int, set[int]] = {}
    before = cut.slots.tolist()
    for text in np.flatnonzero(counts >= RENAMED_FROM).tolist():
        a, size = int(first[text]), int(counts[text])
        short = min(window, size)
        for at in range(a, a + size - short + 1):
            for n in (short, *(x for x in LONGER if x > window)):
                n = min(n, size)
                begin = min(at, a + size - n)
                inside = before[begin + n] - before[begin]
                if not inside or n - inside >= LITERALS:
                    if inside and n > short:
                        wanted.setdefault(n, set()).add(begin)
                    break
    for n, begin in sorted(wanted.items()):
        yield 1, n, np.array(sorted(begin), np.int64)


_FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)]


def _places(h: np.ndarray, factor: np.uint64, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(byte, bit) of each hash in a filter of 2 ** bits bits."""
    place = (h * factor) >> np.uint64(64 - bits)
    return (place >> np.uint64(3)).astype(np.int64), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8)


class Filter:
    """A Bloom filter of hashes: it may let others pass, and never stops one of them."""

    def __init__(self, data: bytes):
        self.data, self.bits = np.frombuffer(data, np.uint8), (8 * len(data)).bit_length() - 1

    def __call__(self, h: np.ndarray) -> np.ndarray:
        """Where those stand in h that pass."""
        left = np.arange(len(h))
        for factor in _FACTORS:
            byte, bit = _places(h[left], factor, self.bits)
            left = left[self.data[byte] & bit > 0]
        return left


def _filter(items: DataFrame) -> bytes:
    """The filter of all hashes of items: parts are merged on the executors, and one of at most 2 ** (FILTER_MOST - 3) bytes reaches the driver."""
    bits = min(FILTER_MOST, max(FILTER_LEAST, (FILTER_BITS * items.count()).bit_length()))

    def build(batches):
        data = np.zeros(1 << (bits - 3), np.uint8)
        for batch in batches:
            for factor in _FACTORS:
                np.bitwise_or.at(data, *_places(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), factor, bits))
        yield pa.RecordBatch.from_arrays([pa.array([data.tobytes()], pa.binary())], names=["data"])

    def join(batches):
        data = np.zeros(1 << (bits - 3), np.uint8)
        for batch in batches:
            for x in batch.column(0):
                data |= np.frombuffer(x.as_buffer(), np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([data.tobytes()], pa.binary())], names=["data"])

    parts = items.select("h").mapInArrow(build, "data binary").repartition(8).mapInArrow(join, "data binary").repartition(1)
    got = parts.mapInArrow(join, "data binary").collect()
    return bytes(got[0].data) if got else bytes(1 << (bits - 3))


def consistent(pairs: list[tuple]) -> bool:
    """Whether slots can be renamed: each of the item's values stands for one value of the document, and two names never become one. Numbers
    and units may coincide, as new values of a question are drawn apart from each other."""
    there: dict = {}
    back: dict = {}
    return all(there.setdefault(a, b) == b and (a[:1] != "@" or back.setdefault(b, a) == a) for a, b in pairs)


def chained(matches: list[dict]) -> list[dict]:
    """The matches of the chain that covers most tokens of the item: runs of overlapping matches of one shift (document position minus
    item position) follow each other in both texts. Two runs may share tokens, as around a name that has become two words."""
    runs: list[list[dict]] = []
    shift = reach = None
    for m in sorted(matches, key=lambda m: (m["pos"] - m["item_pos"], m["item_pos"])):
        if m["pos"] - m["item_pos"] == shift and m["item_pos"] <= reach:
            runs[-1].append(m)
            reach = max(reach, m["item_pos"] + m["n"])
        else:
            runs.append([m])
            shift, reach = m["pos"] - m["item_pos"], m["item_pos"] + m["n"]
    runs.sort(key=lambda r: (r[0]["item_pos"], r[0]["pos"]))
    start, at = (np.array([r[0][k] for r in runs]) for k in ("item_pos", "pos"))
    end = np.array([max(m["item_pos"] + m["n"] for m in r) for r in runs])
    stop = at + end - start
    covered, before = end - start, np.full(len(runs), -1)
    for j in range(1, len(runs)):
        ahead = np.flatnonzero((start[:j] < start[j]) & (end[:j] < end[j]) & (at[:j] < at[j]) & (stop[:j] < stop[j]))
        if len(ahead):
            with_it = covered[ahead] + end[j] - np.maximum(start[j], end[ahead])
            best = int(np.argmax(with_it))
            if with_it[best] > covered[j]:
                covered[j], before[j] = with_it[best], ahead[best]
    out, j = [], int(np.argmax(covered)) if runs else -1
    while j >= 0:
        out += runs[j]
        j = int(before[j])
    return out


def verdict(matches: list[dict]) -> tuple[int, bool]:
    """(tokens of the item that the matches cover, whether slots differ); template matches count only if all slots can be renamed.

    A slot between two shifts has become several words, of which the first and the last are seen; elsewhere one of the two may be.
    """
    covered: dict[int, set[int]] = {}
    slots: dict[int, tuple[str, dict[int, str]]] = {}
    for m in matches:
        for i in range(m["n"]):
            covered.setdefault(m["item_pos"] + i, set()).add(m["kind"])
        if m["kind"]:
            for i, a, b in zip(m["places"], m["item_slots"], m["slots"], strict=True):
                slots.setdefault(m["item_pos"] + i, (a, {}))[1][m["pos"] + i] = b
    pairs = sorted({(a, (seen[min(seen)], seen[max(seen)])) for a, seen in slots.values()})
    whole = {(a, part): b for a, b in pairs if b[0] != b[1] for part in b}
    if not consistent([(a, whole.get((a, b[0]), b) if b[0] == b[1] else b) for a, b in pairs]):
        return sum(0 in kinds for kinds in covered.values()), False
    return len(covered), any(b != (a, a) for a, b in pairs)


def judged(matches: list[dict]) -> tuple[int, bool]:
    """The best verdict on the chain of all matches, the chain of plain ones, and each shift alone."""
    shifts: dict[int, list[dict]] = {}
    for m in matches:
        shifts.setdefault(m["pos"] - m["item_pos"], []).append(m)
    tried = list(shifts.values())
    if len(shifts) > 1:
        tried += [chained(matches), chained([m for m in matches if not m["kind"]])]
    return max((verdict(x) for x in tried), key=lambda v: (v[0], not v[1]))


def _item_key(column: str) -> F.Column:
    """An item's id; those without one are one item."""
    return F.coalesce(F.col(column), F.lit(-(2**63)))


def spared(windows: list[tuple[int, int, int, int]], least: float) -> set[int]:
    """Hashes of the windows (items that have it, hash, pos, n) of one item that may be left out of the search for it: the most common ones, as long as
    they cover fewer than `least` tokens. A document that holds enough of the item holds another window of it."""
    at: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for items, h, pos, n in windows:
        if items > COMMON:
            at.setdefault((-items, h), []).append((pos, n))
    covered: set[int] = set()
    out: set[int] = set()
    for (_, h), places in sorted(at.items()):
        more = covered.union(*(range(pos, pos + n) for pos, n in places))
        if len(more) < least:
            covered = more
            out.add(h)
    return out


def _common(items: DataFrame, coverage: float) -> DataFrame:
    """(item_key, h) of the windows of each item that spared() leaves out. The windows of one item, bounded by its text, are in one row."""
    shared = items.select("h", _item_key("id").alias("item_key")).distinct().groupBy("h").agg(F.count("*").alias("items")).filter(F.col("items") > COMMON)
    windows = items.select(_item_key("id").alias("item_key"), "tokens", "h", "pos", "n").join(shared, "h")
    gathered = windows.groupBy("item_key").agg(F.min("tokens").alias("tokens"), F.collect_list(F.struct("items", "h", "pos", "n")).alias("windows"))

    def run(batches):
        for batch in batches:
            rows = [(key, h) for key, tokens, w in zip(*(c.to_pylist() for c in batch.columns), strict=True) for h in sorted(spared([tuple(x.values()) for x in w], coverage * tokens))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], names=["item_key", "h"])

    return checkpointed(gathered.mapInArrow(run, "item_key long, h long"))


def meetings(windows: DataFrame, theirs: DataFrame, common: DataFrame) -> DataFrame:
    """The documents' windows (h, row, ...) that are windows of items (h, item_key, ...). Those in common (item_key, h) are looked up only for
    a document and item that meet in another one."""
    if common.isEmpty():
        return windows.join(theirs, "h").drop("item_key")
    own = staged(windows, "windows")
    first = own.join(theirs.join(common, ["item_key", "h"], "left_anti"), "h")
    pairs = first.select("row", "item_key").distinct()
    rest = pairs.join(theirs.join(common, ["item_key", "h"], "left_semi"), "item_key").join(own, ["row", "h"])
    return first.unionByName(rest).drop("item_key")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """One row per document and benchmark item that it holds: doc_id, item_id, matched (tokens), item_tokens, renamed (slots differ).

    Both sides become plain and template tokens; windows of `window` tokens (shorter items: all their tokens) are joined by hash, and the
    matches of one document and item are gathered by stretches of the document, each match in the two stretches of SPREAD items' length that
    overlap there. Within one, matches are chained in order of position over all shifts, as words may have been inserted or dropped.
    Template windows count only if all slots of the chain can be renamed consistently. A Bloom filter of the benchmark's windows, of bounded
    size, is broadcast to the documents' side; what passes it is joined exactly by hash, at every size. Windows that many items share, as an
    opening phrase, and that cannot reach the coverage by themselves are looked up only for a document and item that share another window.
    Rows of the join hold positions and slots' values, no other words. An item that is shorter than a window is found in a document once for each way its slots are filled.

    Null and empty texts match nothing, and so does an item without a token; a null id is given back; repeated rows give one row; other
    columns are not read; an empty table on either side gives no rows; texts of any length are cut into windows whole.
    """

    def side(frame: DataFrame, key: str) -> DataFrame:
        return frame.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))

    def of_items(batches):
        for ids, cut in _cuts(batches):
            for kind, n, start in _item_windows(cut, window):
                yield from cut.rows(ids, kind, n, start, cut.hashes(kind, n, start) if len(start) else np.zeros(0, np.uint64))

    items = checkpointed(side(benchmark, item_col).mapInArrow(of_items, SCHEMA))
    sizes = sorted((r.kind, r.n) for r in items.select("kind", "n").distinct().collect())
    known = docs.sparkSession.sparkContext.broadcast(_filter(items))

    def of_docs(batches):
        passes = Filter(known.value)
        for ids, cut in _cuts(batches):
            for kind, n in sizes:
                start = cut.starts(kind, n)
                if not len(start):
                    continue
                h = cut.hashes(kind, n, start)
                hit = passes(h)
                h, start = h[hit], start[hit]
                if n < window and not kind and len(h):
                    # It covers its whole item, so the first in a text tells all.
                    once = np.unique(np.stack([cut.owner[start].astype(np.uint64), h]), axis=1, return_index=True)[1]
                    h, start = h[once], start[once]
                yield from cut.rows(ids, kind, n, start, h)

    theirs = items.select("h", F.col("id").alias("item_id"), _item_key("id").alias("item_key"), F.col("pos").alias("item_pos"), F.col("tokens").alias("item_tokens"), "places", F.col("slots").alias("item_slots"))
    found = meetings(side(docs, id_col).mapInArrow(lean(of_docs), SCHEMA).drop("places", "tokens"), theirs, _common(items, coverage))
    match = F.struct("kind", "n", "item_pos", "pos", "places", "slots", "item_slots")
    stretch = F.floor(F.col("pos") / (SPREAD * F.col("item_tokens")))
    placed = found.withColumn("stretch", F.explode(F.array(stretch, stretch - 1)))
    gathered = placed.groupBy("row", F.col("id").alias("doc_id"), "item_id", "stretch").agg(F.collect_list(match).alias("matches"), F.first("item_tokens").alias("item_tokens"))

    def judge(batches):
        for batch in batches:
            out = []
            for doc, item, matches, n in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                covered, renamed = judged(matches)
                if covered >= coverage * n:
                    out.append((doc, item, covered, n, renamed))
            kinds = [pa.int64()] * 4 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["doc_id", "item_id", "matched", "item_tokens", "renamed"])

    verdicts = gathered.select("doc_id", "item_id", "matches", "item_tokens").mapInArrow(judge, "doc_id long, item_id long, matched long, item_tokens long, renamed boolean")
    best = F.max(F.struct("matched", (~F.col("renamed")).alias("same")))
    return verdicts.groupBy("doc_id", "item_id").agg(best.alias("best"), F.max("item_tokens").alias("item_tokens")).select("doc_id", "item_id", F.col("best.matched").alias("matched"), "item_tokens", (~F.col("best.same")).alias("renamed"))
