"""Removal of spans that repeat from a document with a smaller id: the exchange that both substring operators use.

1. Documents are read once, in chunks, which are staged in the shared folder: no later step depends on how rows were read. Each chunk
   sketches its documents' minimizers (a count-min sketch, kept sparse: its nonzero cells, by slice).
2. Each slice merges the chunks' sketches by adding them and tells each chunk which of its cells reach 2. The number of slices follows
   the corpus' bytes, so the estimates are as good at every size. Nothing is broadcast or sent to the driver.
3. A chunk's runs of windows whose minimizer may be in two documents are its fragments; equal ones are merged to the one with the smallest
   id, so a passage costs a chunk one fragment however many of its documents hold it. Fragments go, packed, to buckets by minimizer.
4. A bucket, which holds all windows of its minimizers, finds each window's smallest id. Their number follows the corpus' bytes too.
5. The answers go back to the chunks, which find the same fragments again, mark the windows and cut the texts.

Nothing is dropped: windows that the sketch lets pass needlessly are told apart in step 4. No task gets all occurrences of a frequent
passage: its bucket sees it once per chunk. A lost executor costs the tasks it ran; their inputs are in the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import id_key, lean, staged, trim
from .windows import cells, merged, runs, sketched

#: Text bytes of a chunk, of the corpus for each slice of the sketch, and for each bucket of fragments.
CHUNK, SLICE, BUCKET = 6 << 20, 16 << 20, 4 << 20
#: Items hashed at once, so that the arrays stay in the processor's caches.
BLOCK = 1 << 18


@dataclass
class Chunk:
    """Some texts: where each one's items start (and the end), and the buffer of fixed-width items that fragments are cut from."""

    bounds: np.ndarray
    buffer: memoryview
    width: int
    extra: object


class Unit:
    """What windows are made of. Subclasses say how a text becomes items, what fragments hold and how a bucket compares windows."""

    length = 50
    k = 16

    def chunk(self, texts: list[bytes]) -> Chunk:
        raise NotImplementedError

    def items(self, chunk: Chunk, start: int, stop: int) -> np.ndarray:
        """64-bit items that minimizers are made of."""
        raise NotImplementedError

    def extent(self, n: np.ndarray) -> np.ndarray:
        """Width in buffer items of a fragment of n windows."""
        raise NotImplementedError

    def smallest(self, ids: np.ndarray, n: np.ndarray, keys: np.ndarray, data: bytes) -> np.ndarray:
        """For each window of the fragments (n windows each) the smallest id of a fragment that holds it."""
        raise NotImplementedError

    def cut(self, chunk: Chunk, text: int, raw: bytes, gone: np.ndarray | None) -> tuple[str | bytes, int]:
        """(what is left of a text, its number of items)."""
        raise NotImplementedError

    def runs(self, chunk: Chunk) -> tuple[np.ndarray, ...]:
        """runs() of the whole chunk, some whole texts at a time."""
        parts, bounds, a = [], chunk.bounds, 0
        while a < len(bounds) - 1:
            b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + BLOCK, "right")) - 1)
            text, at, n, m = runs(self.items(chunk, bounds[a], bounds[b]), bounds[a : b + 1] - bounds[a], self.length, self.k)
            parts.append((text + a, at + bounds[a], n, m))
            a = b
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _flat(starts: np.ndarray, n: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (n[0] of them), starts[1], ..."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - n), n)


def spans_of(gone: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    return [{"start": int(a), "length": int(b - a)} for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _planes(values: np.ndarray) -> bytes:
    """Numbers by bytes of equal rank, which compress better."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _unplanes(data, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _packed(*parts: bytes) -> bytes:
    head = np.array([len(parts), *map(len, parts)], np.uint32).tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(parts))


def _unpacked(data) -> list[memoryview]:
    data = memoryview(zstandard.ZstdDecompressor().decompress(data.as_py() if hasattr(data, "as_py") else data))
    n = int(np.frombuffer(data[:4], np.uint32)[0])
    sizes, at, out = np.frombuffer(data[4 : 4 + 4 * n], np.uint32).tolist(), 4 + 4 * n, []
    for size in sizes:
        out.append(data[at : at + size])
        at += size
    return out


def _batch(columns, kinds, names) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


@dataclass
class Fragments:
    """A chunk's fragments in the order of buckets, each content once, and where they occur."""

    text: np.ndarray  # of each occurrence, as are the next two
    at: np.ndarray
    number: np.ndarray  # of its fragment
    lead: np.ndarray  # for each fragment one of its occurrences, of the smallest id
    n: np.ndarray  # windows of each fragment
    m: np.ndarray
    bucket: np.ndarray


def fragments(unit: Unit, chunk: Chunk, keys: np.ndarray, hit, buckets: int) -> Fragments:
    """hit: tells for minimizers whether they may be in two documents."""
    text, at, n, m = unit.runs(chunk)
    found = hit(m)
    text, at, n, m = text[found], at[found], n[found], m[found]
    digest, buffer, width = xxhash.xxh3_64_intdigest, chunk.buffer, chunk.width
    h = np.array([digest(buffer[a:b]) for a, b in zip((at * width).tolist(), ((at + unit.extent(n)) * width).tolist(), strict=True)], np.uint64)
    bucket = ((m >> np.uint64(17)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((keys[text], n, h, m, bucket))
    new, o, p = np.ones(len(order), bool), order[1:], order[:-1]
    new[1:] = (m[o] != m[p]) | (h[o] != h[p]) | (n[o] != n[p])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    lead = order[new]
    return Fragments(text, at, number, lead, n[lead], m[lead], bucket[lead])


class _Estimates:
    """Tells a chunk which minimizers' cells reach 2, from the slices' answers."""

    def __init__(self, unit: Unit, answers: list[tuple[int, bytes]], slices: int):
        self.slices = slices
        parts = []
        for part, data in answers:
            listed, again = _unpacked(data)
            listed = np.cumsum(_unplanes(listed, np.uint32), dtype=np.uint32)
            parts.append((np.uint64(part) << np.uint64(32)) | listed[np.unpackbits(np.frombuffer(again, np.uint8), count=len(listed)).astype(bool)])
        self.known = np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)

    def __call__(self, m: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(m), bool)
        part, cell = cells(m, self.slices)
        joint = (part.astype(np.uint64) << np.uint64(32)) | cell
        place = np.searchsorted(self.known, joint)
        place[place == len(self.known)] = 0
        return self.known[place] == joint


def without_repeats(docs: DataFrame, unit: Unit, kept: T.StructField, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), chunk_bytes: int = CHUNK) -> DataFrame:
    """One row per row of docs: doc_id, n_items, spans (removed runs: start, length), the text that is left, and the columns in carry.

    A task holds about chunk_bytes of texts at once, or one longer text; fewer need less memory and more rows of the exchange, and give the same result.
    """
    inner = docs.select(F.col(id_col).cast("long").alias("doc_id"), id_key(id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"), *[F.col(c).alias(f"carry_{c}") for c in carry])
    size = inner.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices, buckets = max(8, -(-size // SLICE)), max(16, -(-size // BUCKET))
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("n_items", T.LongType()), T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())]))), kept]
    result = T.StructType(fields + [T.StructField(f"carry_{c}", docs.schema[c].dataType) for c in carry])
    arrow = to_arrow_schema(result)

    def read(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24
        held, total = [], 0
        for batch in batches:
            for piece, n in _slices(batch):
                held.append(piece)
                total += n
                if total >= chunk_bytes:
                    yield from chunk_rows(pa.Table.from_batches(held), number)
                    number, held, total = number + 1, [], 0
        if held:
            yield from chunk_rows(pa.Table.from_batches(held), number)

    def _slices(batch):
        texts = batch.column(2)
        offsets = np.frombuffer(texts.buffers()[1], np.int64 if pa.types.is_large_binary(texts.type) else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        at = 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + chunk_bytes // 2, "right")) - 1)
            yield batch.slice(at, stop - at), int(offsets[stop] - offsets[at]) + 64 * (stop - at)
            at = stop

    kinds, names = (pa.int64(), pa.int32(), pa.binary(), pa.binary()), ["chunk", "part", "cells", "rows"]

    def chunk_rows(table: pa.Table, number: int):
        c = unit.chunk(table["text"].to_pylist())
        text, _, _, m = unit.runs(c)
        # Rows that share an id are one document.
        doc = np.unique(table["key"].to_numpy(), return_inverse=True)[1]
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        yield _batch(([number], [None], [None], [zstandard.ZstdCompressor(level=3).compress(sink.getvalue())]), kinds, names)
        rows = []
        for part, cell, many in sketched(doc[text], m, slices):
            rows.append((number, part, _packed(_planes(np.diff(cell, prepend=np.uint32(0))), np.packbits(many).tobytes()), None))
            if len(rows) == 256:
                yield _batch(zip(*rows, strict=True), kinds, names)
                rows = []
        if rows:
            yield _batch(zip(*rows, strict=True), kinds, names)

    chunks = staged(inner.mapInArrow(lean(read), "chunk long, part int, cells binary, rows binary"), "chunks")

    def by_part(work):
        """work(part, [(chunk, data)]) for each part; rows of a part stand together."""

        def run(batches):
            held, part = [], None
            for batch in batches:
                for p, chunk, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                    if p != part and held:
                        yield from work(part, held)
                        held = []
                    part = p
                    held.append((chunk, data))
            if held:
                yield from work(part, held)

        return run

    def add(part, held):
        own = []
        for _, data in held:
            listed, many = _unpacked(data)
            listed = np.cumsum(_unplanes(listed, np.uint32), dtype=np.uint32)
            own.append((listed, np.unpackbits(np.frombuffer(many, np.uint8), count=len(listed)).astype(bool)))
        for (chunk, _), (listed, _), again in zip(held, own, merged(own), strict=True):
            # Only the cells that reach 2 go back.
            listed = listed[again]
            if len(listed):
                yield _batch(([chunk], [part], [_packed(_planes(np.diff(listed, prepend=np.uint32(0))), np.packbits(np.ones(len(listed), bool)).tobytes())]), kinds[:3], ["chunk", "part", "data"])

    together = lambda frame: frame.repartition("part").sortWithinPartitions("part")
    estimates = staged(together(chunks.filter("part IS NOT NULL").select("part", "chunk", "cells")).mapInArrow(lean(by_part(add)), "chunk long, part int, data binary"), "estimates")

    def opened(state: pa.Table, side: pa.Table):
        table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(state["rows"][0].as_py())).read_all()
        texts, keys = table["text"].to_pylist(), table["key"].to_numpy()
        c = unit.chunk(texts)
        answers = [(p, d) for p, d in zip(side["part"].to_pylist(), side["data"].to_pylist(), strict=True) if p >= 0]
        return table, texts, keys, c, fragments(unit, c, keys, _Estimates(unit, answers, slices), buckets)

    def send(key, state: pa.Table, side: pa.Table) -> pa.Table:
        trim()
        rows = []
        if len(state) and len(side):
            _, _, keys, c, f = opened(state, side)
            begin, stop = c.width * f.at[f.lead], c.width * (f.at[f.lead] + unit.extent(f.n))
            ids = keys[f.text[f.lead]]
            cuts = np.flatnonzero(np.concatenate([[True], f.bucket[1:] != f.bucket[:-1], [True]])) if len(f.bucket) else np.zeros(0, np.int64)
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                data = b"".join([c.buffer[x:y] for x, y in zip(begin[a:b].tolist(), stop[a:b].tolist(), strict=True)])
                rows.append((key[0].as_py(), int(f.bucket[a]), _packed(_planes(ids[a:b]), f.n[a:b].astype(np.uint16).tobytes(), _planes(f.m[a:b]), data)))
        return pa.table([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds[:3])], names=["chunk", "part", "data"])

    def answer(part, held):
        own = [_unpacked(d) for _, d in held]
        ids, n, m = (np.concatenate([f(x[i]) for x in own]) for i, f in enumerate((lambda x: _unplanes(x, np.int64), lambda x: np.frombuffer(x, np.uint16).astype(np.int64), lambda x: _unplanes(x, np.uint64))))
        least = unit.smallest(ids, n, m, b"".join(x[3] for x in own))
        at = first = 0
        for (chunk, _), x in zip(held, own, strict=True):
            count = len(x[1]) // 2
            windows = int(n[first : first + count].sum())
            values = least[at : at + windows]
            first, at = first + count, at + windows
            change = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
            yield _batch(([chunk], [-1 - part], [_packed(np.diff(np.append(change, windows)).astype(np.uint32).tobytes(), _planes(values[change]))]), kinds[:3], ["chunk", "part", "data"])

    states = chunks.filter("part IS NULL").select("chunk", "rows")
    sent = states.groupBy("chunk").cogroup(estimates.groupBy("chunk")).applyInArrow(send, "chunk long, part int, data binary")
    answered = together(sent.select("part", "chunk", "data")).mapInArrow(lean(by_part(answer)), "chunk long, part int, data binary")

    def gather(key, state: pa.Table, side: pa.Table) -> pa.Table:
        trim()
        table, texts, keys, c, f = opened(state, side)
        gone = None
        if len(f.text):
            by = {-1 - p: _unpacked(d) for p, d in zip(side["part"].to_pylist(), side["data"].to_pylist(), strict=True) if p < 0}
            smallest = np.concatenate([np.repeat(_unplanes(value, np.int64), np.frombuffer(n, np.uint32)) for n, value in (by[b] for b in np.unique(f.bucket).tolist())])
            first, own = np.cumsum(f.n) - f.n, f.n[f.number]
            hit = smallest[_flat(first[f.number], own)] < np.repeat(keys[f.text], own)
            starts = np.bincount(_flat(f.at, own)[hit], minlength=int(c.bounds[-1]))
            starts[unit.length :] -= starts[: -unit.length].copy()
            gone = np.cumsum(starts) > 0
        n, spans, left = [], [], []
        for i in range(len(texts)):
            own = None if gone is None else gone[c.bounds[i] : c.bounds[i + 1]]
            own = own if own is not None and own.any() else None
            text, items = unit.cut(c, i, texts[i], own)
            left.append(text)
            n.append(items)
            spans.append([] if own is None else spans_of(own))
        return pa.table([table["doc_id"], pa.array(n, pa.int64()), pa.array(spans, arrow.field("spans").type), pa.array(left, arrow.field(3).type), *[table[f"carry_{x}"] for x in carry]], schema=arrow)

    cut = states.groupBy("chunk").cogroup(estimates.union(answered).groupBy("chunk")).applyInArrow(gather, result)
    return cut.select(*result.names[:4], *[F.col(f"carry_{c}").alias(c) for c in carry])
