"""Quality rules as a short-circuit cascade: rules run in the order of rejections per cost, as measured on a sample."""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SYMBOLS = "#*$%&|<>"
BLANKS = "\x20\t\n\x0b\x0c\r"
_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, rejected_by string, calls long"
#: Rows of the sample on which rules are timed, about.
SAMPLE = 1024


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in a 3-word window that the text holds twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
    k = len(number)
    pairs = np.unique(ids[:-1] * k + ids[1:], return_inverse=True)[1] if k >= 2_000_000 else ids[:-1] * k + ids[1:]
    windows = pairs[:-1] * k + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= twice
    return int(covered.sum())


class Text:
    """A text with what the rules look at, each measured when it is first asked for: what no rule asks for costs nothing."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode("utf-8", "surrogatepass").split()

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, BLANKS))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, SYMBOLS))

    @cached_property
    def lines(self) -> tuple[int, int]:
        """(lines with a word, those of them that are equal to an earlier one)."""
        own = [x for x in self.text.split("\n") if x.strip(BLANKS)]
        return len(own), len(own) - len(set(own))

    @cached_property
    def n_repeat_words(self) -> int:
        return repeated_words(self.words)


#: Each rule rejects a text; none depends on another, so their order changes the cost but not the verdict. Only texts that pass the base rule get here.
RULES: dict[str, Callable[[Text], bool]] = {
    "symbols": lambda t: t.n_symbols > 0.3 * len(t.words),
    "line_repeats": lambda t: t.lines[0] >= 4 and t.lines[1] > 0.6 * t.lines[0],
    "word_length": lambda t: not 2 <= t.word_chars / len(t.words) <= 25,
    "no_letters": lambda t: sum(1 for w in t.words if _LETTER.search(w)) < 0.6 * len(t.words),
    "one_word": lambda t: max(Counter(t.words).values()) > 0.5 * len(t.words),
    # Distinct words grow about as the root of a text's length.
    "few_words": lambda t: len(set(t.words)) ** 2 < 2 * len(t.words),
}


def base_failed(t: Text) -> bool:
    return len(t.words) < 50 or 100 * t.n_repeat_words > 50 * len(t.words)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def estimates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE, rules: dict[str, Callable[[Text], bool]] | None = None) -> dict[str, tuple[int, int, float]]:
    """Of each rule (texts that it rejects, texts tried, seconds), on a sample of about `rows` rows, drawn from the whole table by a hash of id and
    length. The rules run where the rows are, each on a fresh text, so it pays for its own measures; only sums reach the driver."""
    own = RULES if rules is None else rules
    every = max(1, docs.count() // rows)

    def run(batches):
        found = {name: [0, 0, 0.0] for name in own}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if base_failed(Text(text)):
                    continue
                for name, rule in own.items():
                    t = Text(text)
                    t.words  # every rule needs them, and so did the base rule
                    began = time.perf_counter()
                    rejected = rule(t)
                    sums = found[name]
                    sums[0], sums[1], sums[2] = sums[0] + rejected, sums[1] + 1, sums[2] + time.perf_counter() - began
        yield pa.RecordBatch.from_arrays([pa.array(list(found)), *[pa.array([x[i] for x in found.values()], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.float64()))]], names=["rule", "rejected", "tried", "seconds"])

    sample = _rows(docs, id_col, text_col).filter(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(every)) == 0).select("text")
    sums = sample.mapInArrow(run, "rule string, rejected long, tried long, seconds double").groupBy("rule").agg(F.sum("rejected").alias("rejected"), F.sum("tried").alias("tried"), F.sum("seconds").alias("seconds"))
    return {name: (0, 0, 0.0) for name in own} | {r.rule: (r.rejected, r.tried, r.seconds) for r in sums.collect()}


def cascade_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE, rules: dict[str, Callable[[Text], bool]] | None = None) -> list[str]:
    """Names of the rules by rejections per second on the sample; rules that reject nothing there go by cost."""
    found = estimates(docs, id_col, text_col, rows, rules)
    rate = {name: ((rejected + 0.01) / (tried + 1)) / (seconds / max(1, tried) + 1e-9) for name, (rejected, tried, seconds) in found.items()}
    return sorted(found, key=lambda name: (-rate[name], name))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: list[str] | None = None, measures: bool = True) -> DataFrame:
    """One row per document: the base measures, base_failed, kept, the rule that rejected it (`base` for the base rule), and how many rules were called.

    Rules are called in the order given, or else in cascade_order(), up to the first that rejects; a measure that only later rules look at is
    not made. With measures, the base ones are made for the output in any case, and what the cascade saves are the passes that rules make
    themselves; without, columns word_chars, n_symbols and n_dup_lines are null where no rule asked for them.

    Texts are whole. A null or empty text has no words, so it fails the base rule; a null id stays null; repeated rows give repeated rows;
    other columns of docs are not read; an empty table gives no rows. The map needs no shuffle: a lost executor costs its own tasks only.
    """
    names = cascade_order(docs, id_col, text_col) if order is None else order

    def run(batches):
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                t, calls = Text(text), 0
                failed = base_failed(t)
                by = "base" if failed else None
                for name in () if failed else names:
                    calls += 1
                    if RULES[name](t):
                        by = name
                        break
                seen = [getattr(t, m) if measures or m in t.__dict__ else None for m in ("word_chars", "n_symbols", "lines")]
                out.append((doc, len(t.words), *seen[:2], seen[2] and seen[2][1], t.n_repeat_words, failed, by is None, by, calls))
            kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)] if out else [pa.array([], k) for k in kinds], names=[x.split()[0] for x in SCHEMA.split(", ")])

    return _rows(docs, id_col, text_col).mapInArrow(run, SCHEMA)
