"""A gated recurrent language model in numpy: truncated backpropagation, class-factored softmax, state carried through whole documents.

The vocabulary is every word of the training texts, one unknown word in each tail class, and the end. The most frequent words (the head)
have output and input vectors and stand in classes of equal size by frequency; all others are in tail classes by their last two bytes,
within which they have their smoothed relative frequency. P(word | state) = P(class | state) * P(word | class, state), so the
probabilities of all words sum to 1.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import chain, pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_chunks, staged

#: The end of a text; no word is empty.
END = b""
#: Size of the recurrent state and of input vectors, head words, words of a head class, tail classes.
STATE, HEAD, CLASS, TAILS = 16, 1024, 64, 32
#: Most frequent words whose counts are broadcast (about 40 bytes each); the counts of all others are joined.
KNOWN = 300_000
#: Longer words are joined however frequent they are, so that what is broadcast has a bound in bytes.
LONGEST = 64
#: Rounds of training; after each, the copies are averaged.
ROUNDS = 4
#: Training tokens of a copy of the model, and copies at most (a copy reads its texts as a stream, however many they are).
COPY, COPIES = 2_000_000, 4096
#: Tokens that are dealt to lanes together, lanes and steps of a window, updates that a stream gets at least, and the rate of learning.
STREAM, LANES, STEPS, LEAST_UPDATES, RATE = 1 << 20, 512, 16, 150, 0.3
#: Tokens that are gathered before they are scored, texts that go through time together, and tokens whose probabilities are computed together.
UNIT, TOGETHER, SCORED = 6_000_000, 512, 8192
#: Smoothing of counts.
SMOOTH = 0.1


def tail_class(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % TAILS


@dataclass
class Vocabulary:
    """number: head word -> its number (by frequency; the end is among them)."""

    number: dict[bytes, int]
    log_head: np.ndarray  # relative log frequencies of head words and then tail classes

    @property
    def classes(self) -> int:
        return -(-len(self.number) // CLASS)


def cells(rows: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """Places in rows.ravel() of one column a row: one index is followed faster than two."""
    return np.arange(0, rows.size, rows.shape[1]) + picked


def log_shares(logits: np.ndarray, picked: np.ndarray, tame: bool) -> np.ndarray:
    """log softmax at one column a row; logits is overwritten. tame: all logits are near zero, else the largest of each row is taken out."""
    if not tame:
        logits -= logits.max(axis=1, keepdims=True)
    at = logits.ravel()[cells(logits, picked)]
    np.exp(logits, out=logits)
    return at - np.log(logits @ np.ones(logits.shape[1], logits.dtype))


def shares(logits: np.ndarray, picked: np.ndarray, tame: bool) -> float:
    """Turns logits into their softmax; returns the sum of the picked columns' logarithms."""
    if not tame:
        logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits *= (1 / (logits @ np.ones(logits.shape[1], logits.dtype)))[:, None]
    return float(np.log(logits.ravel()[cells(logits, picked)] + 1e-30).sum())


def _three(weights: np.ndarray) -> np.ndarray:
    """The parts of a matrix for the three kinds of gates, (3, rows, STATE), without a copy."""
    return weights.reshape(len(weights), 3, STATE).transpose(1, 0, 2)


class Model:
    """Weights, all float32. Inputs: head words, tail classes, and the start of a text. Outputs: head classes, then tail classes."""

    def __init__(self, weights: dict[str, np.ndarray], heads: int, end: int = 0):
        self.w, self.heads, self.end = weights, heads, end
        self.classes = weights["out"].shape[0]

    @staticmethod
    def fresh(vocabulary: Vocabulary, seed: int = 1) -> Model:
        """Small random weights; the output biases are the log frequencies, so that training starts from them."""
        rng, heads, classes = np.random.default_rng(seed), len(vocabulary.number), vocabulary.classes
        draw = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
        word = np.full(classes * CLASS, -30.0)
        word[:heads] = vocabulary.log_head[:heads]
        word = word.reshape(classes, CLASS)
        of_class = np.log(np.exp(word).sum(axis=1))
        w = {
            "in": draw(heads + TAILS + 1, STATE), "x": draw(STATE, 3 * STATE) * 2, "h": draw(STATE, 3 * STATE) * 2, "b": np.zeros(3 * STATE, np.float32),
            "class": draw(STATE, classes + TAILS), "class_b": np.concatenate([of_class, vocabulary.log_head[heads:]]).astype(np.float32),
            "out": draw(classes, CLASS, STATE), "out_b": (word - of_class[:, None]).astype(np.float32),
        }
        return Model(w, heads, vocabulary.number[END])

    @property
    def start(self) -> int:
        return self.heads + TAILS

    @property
    def tame(self) -> bool:
        """Whether no logit can leave -60 to 60: states are within -1 to 1, so weights and biases bound them. What is not finite is not tame."""
        w = self.w
        return bool(max((np.abs(w["class"]).sum(axis=0) + np.abs(w["class_b"])).max(), (np.abs(w["out"]).sum(axis=2) + np.abs(w["out_b"])).max()) < 60)

    def gates(self, x: np.ndarray) -> np.ndarray:
        """The inputs' part of the update gates, the reset gates and the candidates: (3, inputs, STATE)."""
        return np.matmul(x, _three(self.w["x"])) + self.w["b"].reshape(3, 1, STATE)

    def advance(self, gates: np.ndarray, h: np.ndarray, inner: np.ndarray | None = None) -> np.ndarray:
        """The new states, from the inputs' part of the gates, which is overwritten with the gates and the candidates; inner gets the states' part of the candidates."""
        u = np.matmul(h, _three(self.w["h"]))
        zr, n = gates[:2], gates[2]
        zr += u[:2]
        # The logistic function; where exp overflows to infinity it is 0, as it should be. exp costs half of what tanh does.
        np.negative(zr, out=zr)
        with np.errstate(over="ignore"):
            np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        if inner is not None:
            inner[:] = u[2]
        u[2] *= zr[1]
        n += u[2]
        np.tanh(n, out=n)
        new = h - n
        new *= zr[0]
        new += n
        return new

    def log_probabilities(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log P of each target (head word number, or heads + tail class, whose word within the class is left to the counts)."""
        w = self.w
        logits = states @ w["class"]
        logits += w["class_b"]
        tame = self.tame
        group = np.where(targets < self.heads, targets // CLASS, targets - self.heads + self.classes)
        out = log_shares(logits, group, tame).astype(np.float64)
        order = np.argsort(group.astype(np.uint16), kind="stable")
        cuts = np.searchsorted(group.take(order), np.arange(self.classes + 1)).tolist()
        # Class after class lies together.
        order = order[: cuts[-1]]
        sorted_states, sorted_targets, inside = states.take(order, 0), targets.take(order), np.empty(len(order))
        for c, (lo, hi) in enumerate(pairwise(cuts)):
            if lo < hi:
                inner = sorted_states[lo:hi] @ w["out"][c].T
                inner += w["out_b"][c]
                inside[lo:hi] = log_shares(inner, sorted_targets[lo:hi] - c * CLASS, tame)
        out[order] += inside
        return out

    def score(self, texts: list[np.ndarray], most: int = TOGETHER) -> np.ndarray:
        """Log probability of each text (its targets, the end's included). Texts of similar length go through time together, at most `most` of them."""
        order = np.argsort([-len(t) for t in texts], kind="stable")
        out = np.empty(len(texts))
        for at in range(0, len(texts), most):
            out[order[at : at + most]] = self._score([texts[i] for i in order[at : at + most]])
        return out

    def _score(self, texts: list[np.ndarray]) -> np.ndarray:
        """One step after the other, all texts at once; the state goes from window to window to each text's end."""
        lengths = np.array([len(t) for t in texts])
        order = np.argsort(-lengths, kind="stable")
        total, longest = np.zeros(len(texts)), int(lengths.max(initial=0))
        gates_of = self.gates(self.w["in"])
        flat = np.concatenate([texts[i] for i in order]) if len(texts) else np.zeros(0, np.uint16)
        sizes = lengths[order]
        first = np.cumsum(sizes) - sizes
        h, at = np.zeros((len(texts), STATE), np.float32), 0
        while at < longest:
            b = int(np.searchsorted(-sizes, -at, "left"))  # texts longer than `at`
            # Windows are longer where few texts are left; the state goes on from one to the next.
            steps = min(max(STEPS, SCORED // b), longest - at)
            place = first[:b] + np.arange(at, at + steps)[:, None]
            alive = np.arange(at, at + steps)[:, None] < sizes[:b]
            tokens = flat[np.minimum(place - 1, len(flat) - 1)]
            if not at:
                tokens[0] = self.start
            gates, states, h = gates_of.take(tokens, 1), np.empty((steps, b, STATE), np.float32), h[:b]
            for t in range(steps):
                states[t] = h = self.advance(gates[:, t], h)
            got = self.log_probabilities(states[alive], flat[place[alive]].astype(np.int64))
            total[:b] += np.bincount(np.nonzero(alive)[1], got, b)
            at += steps
        out = np.empty(len(texts))
        out[order] = total
        return out

    def train(self, tokens: np.ndarray, seen: dict[str, np.ndarray], least: int = LEAST_UPDATES) -> float:
        """Adagrad over a stream of targets (texts on end, each closed by the end), once: in windows of STEPS and LANES lanes (fewer, where that
        would give less than `least` updates); what is left over when all lanes are equally long is a lane of its own. Returns the sum of the
        log probabilities on the way."""
        lanes = max(1, min(LANES, len(tokens) // (STEPS * least)))
        length = len(tokens) // lanes
        total = self._lanes(tokens[: lanes * length].reshape(lanes, length), seen)
        return total + self._lanes(tokens[None, lanes * length :], seen)

    def _lanes(self, tokens: np.ndarray, seen: dict[str, np.ndarray]) -> float:
        """One pass over lanes of equal length; the state is carried from window to window and starts anew after each end."""
        targets = np.ascontiguousarray(tokens.T)
        inputs = np.empty_like(targets)
        inputs[:1] = self.start
        inputs[1:] = np.where(targets[:-1] == self.end, self.start, targets[:-1])
        h, total = np.zeros((len(tokens), STATE), self.w["h"].dtype), 0.0
        for at in range(0, len(targets), STEPS):
            h, got = self._window(inputs[at : at + STEPS], targets[at : at + STEPS], h, seen)
            total += got
        return total

    def _window(self, inputs, targets, h, seen):
        """Forward and back through one window, and an update: (the last state, the sum of log probabilities). inputs, targets: (step, lane)."""
        w, s = self.w, STATE
        steps, lanes = inputs.shape
        n, shown = inputs.size, inputs.ravel()
        x = w["in"].take(shown, 0)
        # There are fewer different inputs than places.
        gates = (self.gates(w["in"]).take(shown, 1) if n > len(w["in"]) else self.gates(x)).reshape(3, steps, lanes, s)
        keep = (inputs != self.start).astype(x.dtype)[:, :, None]
        before, state, un = (np.empty((steps, lanes, s), x.dtype) for _ in range(3))
        for t in range(steps):
            np.multiply(h, keep[t], out=before[t])
            state[t] = h = self.advance(gates[:, t], before[t], un[t])
        z, r, candidate = gates
        states, flat = state.reshape(n, s), targets.ravel().astype(np.int64)
        # Output layer: p and q become the gradients of the logits.
        p = states @ w["class"]
        p += w["class_b"]
        group = np.where(flat < self.heads, flat // CLASS, flat - self.heads + self.classes)
        tame, ones = self.tame, np.ones(n, x.dtype)
        loss = shares(p, group, tame)
        p.ravel()[cells(p, group)] -= 1
        grads = {"class": states.T @ p, "class_b": ones @ p}
        d = p @ w["class"].T
        grads["out"], grads["out_b"] = np.zeros_like(w["out"]), np.zeros_like(w["out_b"])
        order = np.argsort(group.astype(np.uint16), kind="stable")
        cuts = np.searchsorted(group.take(order), np.arange(self.classes + 1)).tolist()
        # Class after class lies together.
        order = order[: cuts[-1]]
        sorted_states, sorted_targets, inside = states.take(order, 0), flat.take(order), np.empty((len(order), s), x.dtype)
        for c, (lo, hi) in enumerate(pairwise(cuts)):
            if lo < hi:
                at = sorted_states[lo:hi]
                q = at @ w["out"][c].T
                q += w["out_b"][c]
                picked = sorted_targets[lo:hi] - c * CLASS
                loss += shares(q, picked, tame)
                q.ravel()[cells(q, picked)] -= 1
                grads["out"][c], grads["out_b"][c] = q.T @ at, ones[: hi - lo] @ q
                np.matmul(q, w["out"][c], out=inside[lo:hi])
        d[order] += inside
        # Back through the window's steps; what does not depend on the later steps is computed for all of them at once.
        d = d.reshape(steps, lanes, s)
        by_n = 1 - candidate * candidate
        by_n *= 1 - z
        by_z = (before - candidate) * z
        by_z *= 1 - z
        by_r = un * r
        by_r *= 1 - r
        # du: what reaches the three parts of the states' matrix; dn: the candidates, whose part of du is behind the reset gate.
        du, dn, back = np.empty_like(gates), np.empty_like(state), _three(w["h"]).transpose(0, 2, 1)
        dh = np.zeros((lanes, s), x.dtype)
        for t in range(steps - 1, -1, -1):
            dh += d[t]
            own = du[:, t]
            np.multiply(dh, by_n[t], out=dn[t])
            np.multiply(dh, by_z[t], out=own[0])
            np.multiply(dn[t], by_r[t], out=own[1])
            np.multiply(dn[t], r[t], out=own[2])
            dh *= z[t]
            for part in np.matmul(own, back):
                dh += part
            dh *= keep[t]
        du, flat_of = du.reshape(3, n, s), lambda three: three.transpose(1, 0, 2).reshape(-1, 3 * s)
        grads["h"] = flat_of(np.matmul(before.reshape(n, s).T, du))
        du[2] = dn.reshape(n, s)
        grads["x"], grads["b"] = flat_of(np.matmul(x.T, du)), (ones @ du).ravel()
        dx = np.matmul(du, _three(w["x"]).transpose(0, 2, 1)).sum(axis=0)
        order = np.argsort(shown.astype(np.uint16), kind="stable")
        ids = shown[order]
        first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        # Sums of equal inputs, as differences of running sums.
        dx = np.cumsum(dx.take(order, 0), axis=0, dtype=np.float64)[np.append(first[1:], n) - 1]
        dx[1:] -= dx[:-1].copy()
        touched, dx = ids[first], dx.astype(x.dtype)
        for name, g in grads.items():
            g *= 1 / 64
            np.clip(g, -2, 2, out=g)
            seen[name] += g * g
            g /= np.sqrt(seen[name])
            g *= RATE
            w[name] -= g
        dx *= 1 / 64
        seen["in"][touched] += dx * dx
        w["in"][touched] -= RATE * dx / np.sqrt(seen["in"][touched])
        return h, loss


def fresh_sums(model: Model) -> dict[str, np.ndarray]:
    return {k: np.full_like(v, 0.1) for k, v in model.w.items()}


def _dump(arrays: dict[str, np.ndarray]) -> bytes:
    return b"".join(np.ascontiguousarray(arrays[k], np.float32).tobytes() for k in sorted(arrays))


def _load(data: bytes, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, flat, at = {}, np.frombuffer(data, np.float32), 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).copy()
        at += like[k].size
    return out


def held_out(id_col: str, folds: int) -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == 0, F.lit(True))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word: binary, n) over all rows, the end included: counted per task, with partial sums whenever a task holds a million words."""

    def run(batches):
        total: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total.update(text.lower().split())
                total[END] += 1
            if len(total) > 1_000_000:
                yield from out(total)
                total.clear()
        yield from out(total)

    def out(total):
        rows = list(total.items())
        for i in range(0, len(rows), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[i : i + 50_000]], pa.binary()), pa.array([r[1] for r in rows[i : i + 50_000]], pa.int64())], names=["word", "n"])

    return texts.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _averaged(rows: DataFrame) -> DataFrame:
    """(weight, data): the weighted mean of packed weights, row after row."""

    def fold(batches):
        total, weight = None, 0.0
        for batch in batches:
            for n, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.frombuffer(data.as_py(), np.float32).astype(np.float64) * n
                total, weight = own if total is None else total + own, weight + n
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([weight]), pa.array([(total / weight).astype(np.float32).tobytes()])], names=["n", "data"])

    return rows.mapInArrow(fold, "n double, data binary")


def trained(texts: DataFrame, vocabulary: Vocabulary, tokens: int, rounds: int = ROUNDS) -> Model:
    """texts: (doc_id, targets: unsigned 16-bit numbers), `tokens` of them in all. Copies of the model, as many as the tokens ask for, train on texts
    dealt by a hash of their id, one slice of them a round, in the order of another hash; after a round the copies are averaged, weighted by
    their tokens. Every text is in one round, and nothing depends on how the rows were partitioned."""
    spark = texts.sparkSession
    copies = max(1, min(COPIES, -(-tokens // COPY)))
    key = lambda seed: F.xxhash64("doc_id", F.lit(seed))
    own = texts.select(F.pmod(key(1), F.lit(rounds)).cast("int").alias("round"), F.pmod(key(2), F.lit(copies)).cast("int").alias("copy"), key(3).alias("place"), "targets")
    model = Model.fresh(vocabulary)
    sums, heads = fresh_sums(model), model.heads
    shapes = [{k: np.zeros(v.shape, np.bool_) for k, v in x.items()} for x in (model.w, sums)]
    for r in range(rounds):
        sent = spark.sparkContext.broadcast((_dump(model.w), _dump(sums)))

        def run(batches, sent=sent, end=model.end):
            state, held, waiting, total, count = None, None, [], 0, 0

            def learn():
                nonlocal waiting, total
                if waiting:
                    state[0].train(np.concatenate(waiting), state[1])
                waiting, total = [], 0

            def done():
                learn()
                return pa.RecordBatch.from_arrays([pa.array([float(count)]), pa.array([_dump(state[0].w) + _dump(state[1])])], names=["n", "data"])

            for batch in batches:
                for copy, targets in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    if copy != held:
                        if state:
                            yield done()
                        w, s = sent.value
                        state, held, count = (Model(_load(w, shapes[0]), heads, end), _load(s, shapes[1])), copy, 0
                    waiting.append(np.frombuffer(targets.as_buffer(), np.uint16))
                    total, count = total + len(waiting[-1]), count + len(waiting[-1])
                    if total >= STREAM:
                        learn()
            if state:
                yield done()

        dealt = own.filter(F.col("round") == r).repartitionById(copies, "copy").sortWithinPartitions("copy", "place", "targets")
        trained_copies = dealt.select("copy", "targets").mapInArrow(run, "n double, data binary")
        rows = _averaged(_averaged(trained_copies.repartition(16)).repartition(1)).collect()
        sent.unpersist()
        if rows:
            data = bytes(rows[0].data)
            half = 4 * sum(v.size for v in model.w.values())
            model.w, sums = _load(data[:half], model.w), _load(data[half:], sums)
    return model


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, known: int = KNOWN) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10).

    Learns from rows that are not held out (null ids are). Texts are whole; a null text is empty and has its end only; words are lower-cased
    in A-Z; repeated rows are scored each; other columns are not read; an empty table gives no rows. Without training rows all words are
    unknown. Only the head and the most frequent words' counts are broadcast, both of fixed size; the others' are joined by word.
    """
    texts = _texts(docs, id_col, text_col)
    train = texts.filter(~held_out("doc_id", folds))
    counts = staged(word_counts(train), "counts")
    total, distinct = counts.agg(F.sum("n"), F.count("*")).first()
    total, distinct = total or 0, distinct
    # The most frequent words, down to a frequency that leaves at most `known` of them.
    bands = counts.groupBy(F.floor(F.log2("n") * 16).cast("int").alias("band")).agg(F.count("*").alias("v")).orderBy(F.desc("band")).collect()
    least = next((b.band for b, v in zip(bands, np.cumsum([b.v for b in bands]), strict=True) if v > known), -1)
    rows = counts.filter(((F.floor(F.log2("n") * 16) > least) & (F.length("word") <= LONGEST)) | (F.col("word") == F.lit(bytearray(END)))).collect()
    top = sorted(((bytes(r.word), r.n) for r in rows), key=lambda x: (-x[1], x[0]))
    head = top[:HEAD]
    if total and not any(w == END for w, _ in head):
        head = [*head[:-1], next(x for x in top if x[0] == END)]
    if not total:
        head = [(END, 0)]
    number = {w: i for i, (w, _) in enumerate(head)}
    # Of each tail class: tokens and distinct words.
    tail = F.pmod(F.crc32(F.expr("substring(word, greatest(length(word) - 1, 1), 2)")), F.lit(TAILS))
    sums = {r.c: (r.n, r.v) for r in counts.groupBy(tail.alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    tail_n, tail_v = np.zeros(TAILS), np.zeros(TAILS)
    for c, (n, v) in sums.items():
        tail_n[c], tail_v[c] = n, v
    for w, n in head:
        if total:
            tail_n[tail_class(w)] -= n
            tail_v[tail_class(w)] -= 1
    weight = np.concatenate([np.array([n + SMOOTH for _, n in head]), tail_n + SMOOTH * (tail_v + 1)])
    vocabulary = Vocabulary(number, np.log(weight / weight.sum()))
    inside = np.log10(tail_n + SMOOTH * (tail_v + 1))
    # Of each listed word: its target, log10 of its smoothed count, the same less that of its tail class (0 in the head), whether known. Words that are not listed are joined.
    heads, complete = len(number), len(top) == distinct
    facts = np.array([(number[w], math.log10(n + SMOOTH), 0.0, n > 0) if w in number else (heads + tail_class(w), math.log10(n + SMOOTH), math.log10(n + SMOOTH) - inside[tail_class(w)], 1) for w, n in dict([*top, *head]).items()])
    spark = docs.sparkSession
    words = spark.sparkContext.broadcast(({w: k for k, w in enumerate(dict([*top, *head]))}, *np.ascontiguousarray(facts.T)))
    base_down, log10e = math.log10(total + SMOOTH * (distinct + 1)), math.log10(math.e)
    unlisted = math.log10(SMOOTH) if complete else 0.0

    def encode(batches):
        listed, target, base, own, seen = words.value
        target = target.astype(np.uint16)
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32())]
        for batch in batches:
            for some in in_chunks(zip(batch.column(0).to_pylist(), batch.column(1), strict=True), lambda r: len(r[1].as_buffer()) + 64, 1 << 20):
                split = [(*text.as_py().lower().split(), END) for _, text in some]
                sizes = np.array([len(x) for x in split])
                starts = np.cumsum(sizes) - sizes
                place = np.fromiter(map(listed.get, chain.from_iterable(split), repeat(-1)), np.int64, int(sizes.sum()))
                columns = [x[place] for x in (target, base, own, seen)]
                lost = np.flatnonzero(place < 0)
                owner = np.searchsorted(starts, lost, "right") - 1
                strange = [split[i][p] for i, p in zip(owner.tolist(), (lost - starts[owner]).tolist(), strict=True)]
                tails = np.fromiter(map(tail_class, strange), np.int64, len(strange))
                columns[0][lost], columns[1][lost], columns[2][lost], columns[3][lost] = heads + tails, unlisted, unlisted - inside[tails], 0
                away: list[Counter[bytes]] = [Counter() for _ in some]
                if not complete:
                    for i, w in zip(owner.tolist(), strange, strict=True):
                        away[i][w] += 1
                sums = [np.add.reduceat(x, starts) for x in columns[1:]]
                targets = [columns[0][a : a + n].tobytes() for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)]
                out = ([d for d, _ in some], sizes, sums[2].astype(np.int64), sums[0] - base_down * sizes, sums[1], targets, [list(x) for x in away], [list(x.values()) for x in away])
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["doc_id", "n_tokens", "n_known", "base_score", "score", "targets", "away", "times"])

    coded = texts.mapInArrow(encode, "doc_id long, n_tokens long, n_known long, base_score double, score double, targets binary, away array<binary>, times array<int>")
    coded = staged(coded.withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    model = trained(coded.filter(~held_out("doc_id", folds)).select("doc_id", "targets"), vocabulary, total)
    sent = spark.sparkContext.broadcast(model.w)

    def score(batches):
        scorer = Model(sent.value, heads)
        # Texts are gathered as numbers, so that the few longest of many go through time together.
        held, targets, size = [], [], 0

        def scores():
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            total = rows.column(4).to_numpy() + scorer.score(targets) * log10e
            return pa.RecordBatch.from_arrays([*rows.columns[:4], pa.array(total), rows.column(5)], names=rows.schema.names)

        for batch in batches:
            own = [np.frombuffer(x.as_buffer(), np.uint16) for x in batch.column(6)]
            held.append(batch.select(range(6)))
            targets += own
            size += sum(map(len, own))
            if size > UNIT:
                yield scores()
                held, targets, size = [], [], 0
        if targets:
            yield scores()

    away = coded.filter(F.size("away") > 0).select("row", F.explode(F.arrays_zip("away", "times")).alias("one")).select("row", F.col("one.away").alias("word"), F.col("one.times").alias("times"))
    found = away.join(counts, "word", "left").groupBy("row").agg(F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + SMOOTH)).alias("more"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("known"))
    rows = coded.select("doc_id", "n_tokens", "n_known", "base_score", "score", "row", "targets").mapInArrow(score, "doc_id long, n_tokens long, n_known long, base_score double, score double, row long")
    done = rows.join(found, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return done.select("doc_id", held_out("doc_id", folds).alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), (F.col("base_score") + more).alias("base_score"), (F.col("score") + more).alias("score"))
