"""URL filter: rules by host and path, and for the other URLs a weighted vocabulary that one Aho-Corasick automaton looks for."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_INSIDE = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")

SCHEMA = "page_id long, host string, path string, rule string, verdict string, strict_hits long, soft_hits long, weight long"


@dataclass(frozen=True)
class Vocabulary:
    """Terms that are looked for in lower-cased URLs, as whole words: no ASCII letter or digit on either side.

    Each distinct term that is found adds its weight once, and a URL is rejected at `limit`. A strict term weighs as much as the limit, a soft one
    less, so one strict term rejects, or several distinct soft ones. A term in both lists is strict.
    """

    strict: tuple[str, ...]
    soft: tuple[str, ...]
    limit: int = 2
    soft_weight: int = 1

    def weights(self) -> dict[str, int]:
        if not 0 < self.soft_weight < self.limit:
            raise ValueError("a soft term must weigh less than the limit")
        found = {t.translate(_LOWER): self.soft_weight for t in self.soft} | {t.translate(_LOWER): self.limit for t in self.strict}
        if "" in found:
            raise ValueError("an empty term is in every URL")
        return found


#: What advertising, betting, drug and adult sites name themselves; a term that others use too is soft.
UNWANTED = Vocabulary(
    strict=("casino", "porn", "viagra", "xxx"),
    soft=("ads", "adult", "bets", "betting", "bonus", "cams", "cheap", "dating", "escort", "farm", "free", "loans", "pills", "poker", "sex", "slots", "spam", "track", "win"),
)


@dataclass(frozen=True)
class Rule:
    """`text` is a host and a path (`example.com/en/`): it fits URLs of that host and its subdomains whose path starts with the path."""

    verdict: str
    text: str

    def parts(self) -> tuple[str, str]:
        host, slash, path = self.text.partition("/")
        return host.translate(_LOWER), slash + path


RULES = (Rule("allow", "com/"), Rule("block", "example.com/en/"), Rule("allow", "www.example.com/en/"), Rule("block", "net/es/"), Rule("block", "net/fr/"))


def split(url: str) -> tuple[str, str]:
    """(host, path): after the first `://`; the host lower-cased in A-Z, with a port or user if it has one. Both empty without `://`."""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    stop = min((i for i in (rest.find(c, end) for c in "?#") if i >= 0), default=len(rest))
    return rest[:end].translate(_LOWER), rest[end:stop]


class RuleBook:
    """The rules by host: a URL asks for each suffix of its host, so its cost does not grow with the number of rules."""

    def __init__(self, rules: Sequence[Rule]):
        self.by_host: dict[str, list[tuple[int, int, bool, str, Rule]]] = {}
        for rule in rules:
            if rule.verdict not in ("allow", "block"):
                raise ValueError(f"a rule allows or blocks: {rule}")
            host, path = rule.parts()
            self.by_host.setdefault(host, []).append((len(rule.text), len(host), rule.verdict == "block", path, rule))

    def rule(self, host: str, path: str) -> Rule | None:
        """The longest rule that fits; of equally long ones that with the longer host, then one that blocks."""
        best = None
        at = 0
        while host and at >= 0:
            for found in self.by_host.get(host[at:], ()):
                if path.startswith(found[3]) and (best is None or found[:3] > best[:3]):
                    best = found
            dot = host.find(".", at)
            at = dot + 1 if dot >= 0 else -1
        return best[4] if best else None


class Finder:
    """The automaton of a vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        self.limit, self.weights = vocabulary.limit, vocabulary.weights()
        self.automaton = ahocorasick.Automaton()
        for term in self.weights:
            self.automaton.add_word(term, term)
        self.automaton.make_automaton()

    def hits(self, url: str) -> dict[str, int]:
        """How often each term stands in url between boundaries."""
        own, found = url.translate(_LOWER), {}
        if not self.weights:
            return found
        for last, term in self.automaton.iter(own):
            first = last - len(term) + 1
            if (first == 0 or own[first - 1] not in _INSIDE) and (last + 1 == len(own) or own[last + 1] not in _INSIDE):
                found[term] = found.get(term, 0) + 1
        return found


def judged(pages: DataFrame, rules: Sequence[Rule] = RULES, vocabulary: Vocabulary = UNWANTED, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, the rule that decided (null where none fits), verdict (allow or block), and the vocabulary's part in it:
    strict_hits (occurrences of strict terms), soft_hits (distinct soft terms) and weight (of the distinct terms).

    A rule decides where one fits; else the whole URL, scheme and query included, is blocked if its terms weigh vocabulary.limit or more. A null
    URL is an empty one: host and path are empty, no rule fits and it is allowed. A null id stays null, repeated rows are judged each, long URLs
    are searched whole, other columns are not read, an empty table gives no rows. One pass without a shuffle: what travels with a task is the
    list of rules and terms, which the caller holds already, and a lost executor costs its own tasks only.
    """
    own, terms = tuple(rules), vocabulary
    RuleBook(own), terms.weights()  # faulty ones are told before any task starts

    def run(batches):
        book, finder = RuleBook(own), Finder(terms)
        soft = {t for t, w in finder.weights.items() if w < finder.limit}
        for batch in batches:
            hosts, paths, texts, verdicts, strict_n, soft_n, weights = ([] for _ in range(7))
            for url in batch.column(1).to_pylist():
                url = url or ""
                host, path = split(url)
                rule, hits = book.rule(host, path), finder.hits(url)
                weight = sum(finder.weights[t] for t in hits)
                hosts.append(host)
                paths.append(path)
                texts.append(rule.text if rule else None)
                verdicts.append(rule.verdict if rule else "block" if weight >= finder.limit else "allow")
                strict_n.append(sum(n for t, n in hits.items() if t not in soft))
                soft_n.append(sum(t in soft for t in hits))
                weights.append(weight)
            text, number = pa.string(), pa.int64()
            made = [pa.array(v, k) for v, k in ((hosts, text), (paths, text), (texts, text), (verdicts, text), (strict_n, number), (soft_n, number), (weights, number))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=[c.split()[0] for c in SCHEMA.split(", ")])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url")).mapInArrow(lean(run), SCHEMA)
