"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier on its posteriors."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_chunks, lean, staged

#: Labelled rows that are learned from, at most (about: they are chosen by a hash of their id). Lexicons, label model and classifier see no others.
LABELLED = 40_000
#: Toxic rows in which a word, beginning or ending must be found to become an entry.
LEAST = 3
#: Words whose features a task remembers, and features that it counts before it hands on partial sums.
REMEMBERED, COUNTED = 50_000, 300_000
#: Lexicons into which the entries are dealt, for each kind of entry and strength.
LEXICONS = 3
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
KINDS = {"w": "words", "p": "beginnings", "s": "endings"}


def parts(word: str) -> list[str]:
    """A word's features: itself, its beginnings and endings."""
    bare = _EDGE.sub("", word).lower()
    if not bare:
        return []
    return [f"w{bare}"] + [f"p{bare[:k]}" for k in range(3, min(7, len(bare)))] + [f"s{bare[-k:]}" for k in range(4, min(7, len(bare)))]


def features_of(text: bytes, known: dict[bytes, list[str]]) -> set[str]:
    found: set[str] = set()
    for w in set(text.split()):
        if w not in known:
            if len(known) > REMEMBERED:
                known.clear()
            known[w] = parts(w.decode("utf-8", "replace"))
        found.update(known[w])
    return found


_MINHASH = np.arange(1, 13, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)


def likeness(text: bytes) -> list[int]:
    """Six bands of two minimum hashes over the text's three-word shingles: near copies mostly share one, other texts do not."""
    w = text.lower().split()
    digest = xxhash.xxh3_64_intdigest
    h = np.array([digest(x) for x in map(b" ".join, zip(w, w[1:], w[2:], strict=False))] or [digest(b" ".join(w))], np.uint64)
    least = np.array([(h * a).min() for a in _MINHASH])
    return (least[:6] ^ (least[6:] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ np.arange(6, dtype=np.uint64)).view(np.int64).tolist()


def apart(rows: list[tuple[int, int, list[int]]]) -> list[int]:
    """Of (id, label, bands) the smallest id of each group of rows with one label that bands connect."""
    root: dict[tuple, tuple] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, y, bands in rows:
        for band in bands:
            root[find((y, "band", band))] = find((y, "id", i))
    least: dict[tuple, int] = {}
    for i, y, _ in rows:
        group = find((y, "id", i))
        least[group] = min(i, least.get(group, i))
    return sorted(set(least.values()))


def patterns(text: bytes) -> list[int]:
    """Votes of the pattern voters: 1 toxic, -1 clean, 0 none. They tell little by themselves; the label model finds out how much."""
    n = max(1, len(text))
    upper, lower = (sum(map(text.count, x)) for x in ((b"A", b"E", b"I", b"O"), (b"a", b"e", b"i", b"o")))
    shout, marks = upper > lower, text.count(b"!") + text.count(b"?")
    noise = sum(map(text.count, (b"#", b"$", b"%", b"&", b"*", b"@")))
    return [
        1 if marks > 0.01 * n else 0,
        1 if shout else 0,
        1 if noise > 0.03 * n else 0,
        -1 if text.count(b"http") or text.count(b"www.") else 0,
        -1 if text.count(b"icense") + text.count(b"opyright") else 0,
        -1 if marks == 0 and noise == 0 else 0,
        -1 if n < 200 else 0,
    ]


def covering(found: list[np.ndarray], clean: np.ndarray, least: int = 3) -> np.ndarray:
    """Entries, chosen one after the other, that hit the most toxic rows which no chosen one hits, less twice the clean rows that they hit (clean), down to a gain of `least`.

    What merely stands beside a toxic word, in a passage that several toxic texts share, hits none that the word does not.
    """
    where = np.repeat(np.arange(len(found)), [len(f) for f in found])
    what = np.concatenate(found) if len(where) else np.zeros(0, np.int64)
    chosen = []
    while len(what):
        n = np.bincount(what, minlength=len(clean)) - 2 * clean
        best = int(n.argmax())
        if n[best] < least:
            break
        chosen.append(best)
        hit = np.zeros(len(found), bool)
        hit[where[what == best]] = True
        left = ~hit[where]
        where, what = where[left], what[left]
    return np.array(sorted(chosen), np.int64)


@dataclass
class LabelModel:
    """P(vote of voter j | class), the voters' residual correlations, and the log odds that are added so that the mean posterior is the class balance.

    Voters that repeat each other share their weight: m copies of one count as the root of m. A vote never speaks against the class that it
    names: a voter whose votes are found where the other class is counts for nothing, it is not turned round.
    """

    balance: float
    table: np.ndarray  # class, voter, vote + 1
    correlation: np.ndarray
    offset: float = 0.0

    @staticmethod
    def fitted(votes: np.ndarray, start: np.ndarray, balance: float, rounds: int = 25) -> LabelModel:
        """Expectation-maximisation from the posteriors in start, with a known share of toxic texts. It sees votes only."""
        p = np.clip(start, 0.001, 0.999)
        n, m = votes.shape
        hot = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(np.float64)
        model = None
        for _ in range(rounds):
            table = np.stack([np.einsum("i,ijk->jk", q, hot) + 0.05 for q in (1 - p, p)])
            table /= table.sum(axis=2, keepdims=True)
            expected = np.einsum("ci,cj->ij", np.stack([1 - p, p]), table[:, :, 2] - table[:, :, 0])
            left = votes - expected
            spread = np.sqrt((left**2).mean(axis=0)) + 1e-6
            correlation = (left.T @ left) / n / np.outer(spread, spread) if n else np.eye(m)
            np.fill_diagonal(correlation, 1.0)
            model = LabelModel(balance, table, correlation)
            odds, low, high = model.odds(votes), -100.0, 100.0
            for _ in range(60):
                model.offset = (low + high) / 2
                low, high = (model.offset, high) if _logistic(odds + model.offset).mean() < balance else (low, model.offset)
            new = _logistic(odds + model.offset)
            if np.abs(new - p).max() < 1e-4:
                break
            p = new
        return model

    def odds(self, votes: np.ndarray) -> np.ndarray:
        weight = 1 / np.sqrt(np.clip(self.correlation * (np.abs(self.correlation) > 0.1), 0, None).sum(axis=1))
        ratio = np.log(self.table[1]) - np.log(self.table[0])
        ratio[:, 2], ratio[:, 0] = np.maximum(ratio[:, 2], 0), np.minimum(ratio[:, 0], 0)
        return sum((votes == v) @ (weight * ratio[:, v + 1]) for v in (-1, 0, 1))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return _logistic(self.odds(votes) + self.offset)

    def accuracies(self) -> np.ndarray:
        """How often each voter is right when it votes."""
        right = self.balance * self.table[1, :, 2] + (1 - self.balance) * self.table[0, :, 0]
        all_ = self.balance * (self.table[1, :, 2] + self.table[1, :, 0]) + (1 - self.balance) * (self.table[0, :, 0] + self.table[0, :, 2])
        return right / np.maximum(all_, 1e-12)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _fit_linear(rows: list[np.ndarray], extra: np.ndarray, target: np.ndarray, size: int, rounds: int = 1500) -> np.ndarray:
    """Weights (features, extra columns, bias) of a logistic regression on soft targets, by full-batch Adagrad. Those of the extra columns, which
    are votes, stay at 0 or above: a vote for a class never makes it less likely."""
    where = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    what = np.concatenate(rows) if len(where) else np.zeros(0, np.int64)
    w = np.zeros(size + extra.shape[1] + 1)
    w[-1] = np.log(np.clip(target.mean(), 1e-3, 0.5) / (1 - np.clip(target.mean(), 1e-3, 0.5)))
    seen = np.full(len(w), 1e-8)
    for _ in range(rounds):
        z = np.bincount(where, w[what], len(rows)) + extra @ w[size:-1] + w[-1]
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / len(rows)
        grad = np.concatenate([np.bincount(what, g[where], size), extra.T @ g, [g.sum()]])
        grad[:-1] += 1e-6 * w[:-1]
        seen += grad**2
        w -= 0.5 * grad / np.sqrt(seen)
        np.maximum(w[size:-1], 0, out=w[size:-1])
    return w


@dataclass
class Scorer:
    """Weights of the lexicons' entries and of the patterns."""

    weights: dict[str, float]
    pattern_weights: np.ndarray
    bias: float
    model: LabelModel | None = None

    def __call__(self, texts: list[bytes], known: dict[bytes, tuple[str, ...]]) -> list[float]:
        out, own = [], self.weights
        for text in texts:
            found: set[str] = set()
            for w in set(text.split()):
                hit = known.get(w)
                if hit is None:
                    if len(known) > 2 * REMEMBERED:
                        known.clear()
                    hit = known[w] = tuple(p for p in parts(w.decode("utf-8", "replace")) if p in own)
                if hit:
                    found.update(hit)
            z = self.bias + sum(own[p] for p in sorted(found)) + float(self.pattern_weights @ patterns(text))
            out.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
        return out


def constant(score: float) -> Scorer:
    """One score for all texts."""
    return Scorer({}, np.zeros(len(patterns(b""))), float(np.log(score / (1 - score))))


def trained(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", labelled: int = LABELLED) -> Scorer:
    """Learns from `labels` (id, 0 or 1; other values and null ids are ignored) of the documents in docs, at most about `labelled` of them.

    Entries are words, beginnings and endings that toxic rows have far more often than clean ones, however rare. Dealt to lexicons by kind and
    strength, each lexicon is a voter, as is each pattern; the label model never sees the given labels, which only choose the entries and tell the share of toxic texts. The
    chosen ids are broadcast (16 bytes each). Where the labels are too few to yield one entry, patterns alone say too little: the score is then
    the share of toxic texts for every text, and without labels of both kinds 0.95 or 0.05. All that reaches the driver (entries, votes) comes from the `labelled` rows and is bounded by them.
    """
    spark = docs.sparkSession
    gold = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).filter("id IS NOT NULL AND y IN (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    n = gold.count()
    if n > labelled:
        gold = gold.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int(labelled / n * (1 << 20)))

    def marked(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([likeness(t.as_py()) for t in batch.column(2)], pa.list_(pa.int64()))], names=["id", "y", "text", "bands"])

    sample = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")).join(F.broadcast(gold), "id").select("id", "y", "text")
    sample = staged(sample.mapInArrow(lean(marked), "id long, y int, text binary, bands array<long>"), "labelled")
    # Copies of one toxic text would make its every word look toxic, so each text counts once. Numbers only, of the bounded sample, are compared on the driver.
    once = apart([(r.id, r.y, r.bands) for r in sample.select("id", "y", "bands").collect()])
    sample = sample.join(F.broadcast(spark.createDataFrame([(i,) for i in once], "id long")), "id", "left_semi").select("y", "text")
    base = {r.y: r.n for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    pos, neg = base.get(1, 0), base.get(0, 0)
    if not pos or not neg:
        return constant(0.95 if pos else 0.05)

    def counts(known_features):
        def run(batches):
            total: Counter[str] = Counter()
            known: dict[bytes, list[str]] = {}
            for batch in batches:
                for text in batch.column(0).to_pylist():
                    found = features_of(text, known)
                    total.update(found if known_features is None else found & known_features)
                    if len(total) > COUNTED:
                        yield from out(total)
                        total.clear()
            yield from out(total)

        def out(total):
            rows = list(total.items())
            for i in range(0, len(rows), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[i : i + 50_000]], pa.string()), pa.array([r[1] for r in rows[i : i + 50_000]], pa.int64())], names=["feature", "n"])

        return run

    def counted(y: int, known_features: set[str] | None) -> DataFrame:
        return sample.filter(F.col("y") == y).select("text").mapInArrow(lean(counts(known_features)), "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))

    # Rare entries are left out, and so are those that most toxic rows share with clean ones.
    hits = {r.feature: r.n for r in counted(1, None).filter(F.col("n") >= LEAST).collect()}
    miss = {r.feature: r.n for r in counted(0, set(hits)).collect()}
    strength, sure, share = {}, {}, pos / (pos + neg)
    for f, a in hits.items():
        b = miss.get(f, 0)
        # A lower bound of the log odds ratio.
        strength[f] = np.log((a + 0.5) / (pos + 1)) - np.log((b + 0.5) / (neg + 1)) - 2.2 * np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
        # How far beyond chance, among as many candidates.
        sure[f] = a * np.log(a / (a + b) / share) + (b * np.log(b / (a + b) / (1 - share)) if b else 0.0) > np.log(len(hits)) + 4
    entries = sorted((f for f in strength if strength[f] > 0.7), key=lambda f: (-strength[f], f))
    number = {f: i for i, f in enumerate(entries)}

    def incidence(batches):
        known: dict[bytes, list[str]] = {}
        for batch in batches:
            for some in in_chunks(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), lambda r: len(r[1]) + 1, 4 << 20):
                own = [sorted(number[f] for f in features_of(t, known) if f in number) for _, t in some]
                yield pa.RecordBatch.from_arrays([pa.array([y for y, _ in some], pa.int32()), pa.array(own, pa.list_(pa.int32())), pa.array([patterns(t) for _, t in some], pa.list_(pa.int32()))], names=["y", "hits", "patterns"])

    rows = sample.mapInArrow(lean(incidence), "y int, hits array<int>, patterns array<int>").collect()
    y = np.array([r.y for r in rows])
    found = [np.array(r.hits, np.int64) for r in rows]
    marks = np.array([r.patterns for r in rows], np.int64)
    chosen = covering([h for h, label in zip(found, y, strict=True) if label], np.array([miss.get(f, 0) for f in entries], np.int64))
    chosen = np.union1d(chosen, [i for i, f in enumerate(entries) if sure[f]]).astype(np.int64)
    if not len(chosen):
        return constant(pos / (pos + neg))
    rank = np.full(len(entries), -1)
    rank[chosen] = np.arange(len(chosen))
    found = [(r := rank[h])[r >= 0] for h in found]
    entries = [entries[i] for i in chosen]
    number = {f: i for i, f in enumerate(entries)}
    # Lexicons: by kind, by strength, and dealt in turn.
    voter = np.zeros(len(entries), np.int64)
    names: dict[tuple, int] = {}
    turn: Counter[tuple] = Counter()
    for i, f in enumerate(entries):
        band = (f[0], int(min(3, strength[f])))
        voter[i] = names.setdefault((*band, turn[band] % LEXICONS), len(names))
        turn[band] += 1
    votes = np.zeros((len(rows), len(names)), np.int64)
    for i, hit in enumerate(found):
        votes[i, voter[hit]] = 1
    none = np.where(votes.any(axis=1), 0, -1)[:, None]
    # The texts with the most votes, as many as are toxic, are where the model starts from; it finds out how far each voter is to be trusted.
    share = (votes > 0).mean(axis=1)
    balance = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    start = np.where((share >= np.sort(share)[-max(1, int(balance * len(y)))]) & (share > 0), 0.9, 0.02)
    votes = np.concatenate([votes, none, marks], axis=1)
    model = LabelModel.fitted(votes, start, balance)
    target = model.posterior(votes)
    w = _fit_linear(found, marks.astype(float), target, len(entries))
    return Scorer({f: float(w[i]) for f, i in number.items() if w[i]}, w[len(entries) : -1], float(w[-1]), model)


def scored(docs: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """docs' ids, score (0 to 1, higher: toxic likelier) and carried columns, for each row; whole texts, null ones as empty ones. No shuffle."""
    weights = docs.sparkSession.sparkContext.broadcast(scorer)
    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("scored_text"), *[F.col(c).alias(f"carry_{c}") for c in carry])

    def run(batches):
        known: dict[bytes, tuple[str, ...]] = {}
        for batch in batches:
            score = pa.array(weights.value(batch.column(1).to_pylist(), known), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), score, *batch.columns[2:]], names=["doc_id", "score", *batch.schema.names[2:]])

    from pyspark.sql import types as T

    schema = T.StructType([kept.schema["doc_id"], T.StructField("score", T.DoubleType()), *kept.schema.fields[2:]])
    got = kept.mapInArrow(lean(run), schema)
    return got.select("doc_id", "score", *[F.col(f"carry_{c}").alias(c) for c in carry])


def held_out(id_col: str, folds: int) -> F.Column:
    """Whether a row is kept from learning: crc32 of its id as text, modulo folds, is 0 (null ids are)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == 0, F.lit(True))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. Learns from labels of documents that are not held out only.

    Without labels of both kinds, or where they yield no lexicon entry, the score is the same for all texts. Null and empty texts are scored like any other; repeated rows
    give repeated rows; columns of docs other than id and text are not read; an empty table gives no rows.
    """
    own = labels.filter(~held_out(id_col, folds))
    got = scored(docs, trained(docs, own, id_col, text_col, label_col), id_col, text_col)
    return got.select("doc_id", held_out("doc_id", folds).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
