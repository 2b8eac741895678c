import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.compare import DATA, needs_data
from tidemill.llm import spelling
from tidemill.llm.queries import QUERIES
from tidemill.llm.spelling import Words, neighbourhood, roots, variants, word_counts


def around(word, alphabet):
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    return ({a + b[1:] for a, b in cuts if b} | {a + c + b[1:] for a, b in cuts if b for c in alphabet} | {a + c + b for a, b in cuts for c in alphabet}) - {word}


def brute(n, ratio=2):
    form, near = {}, {}
    for w in n:
        own = near[w] = [x for x in around(w, sorted(set("".join(n)))) if x in n]
        best = min(own, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def counted(rows, slips):
    total = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if c.isascii() else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % slips == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            total[w] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


@settings(max_examples=60)
@given(st.lists(st.text(alphabet="abé", min_size=1, max_size=6), min_size=1, max_size=8, unique=True))
def test_neighbourhood_is_whole_and_distinct(words):
    alphabet = ["a", "b", "é", "z"]
    found = {w: [] for w in words}
    for rows, cut in neighbourhood(words, alphabet):
        for i, x in zip(rows, cut, strict=True):
            found[words[i]].append(x)
    for w in words:
        assert len(found[w]) == len(set(found[w])) and set(found[w]) == around(w, alphabet)


@settings(max_examples=60)
@given(st.text(alphabet="abcé", min_size=2, max_size=7))
def test_hashes_follow_the_edits(word):
    group = Words([word])
    hash_of = lambda w: int(Words([w]).hash[0])
    for i in range(len(word)):
        assert int(group.deletions()[0][0, i]) == hash_of(word[:i] + word[i + 1 :])
        assert int(group.replacements(ord("z"))[0][0, i]) == hash_of(word[:i] + "z" + word[i + 1 :])
    for i in range(len(word) + 1):
        assert int(group.insertions(ord("z"))[0][0, i]) == hash_of(word[:i] + "z" + word[i:])


def test_runs_are_not_cut(monkeypatch):
    monkeypatch.setattr(spelling, "STRETCH", 7)
    text = "abc defghijklmno  pq1rst " * 9
    got = [x for found in spelling.runs(text, re.compile("[a-z]+"), re.compile("[a-z]*")) for x in found]
    assert got == re.findall("[a-z]+", text)


def test_variants_against_brute_force(spark):
    n = {"color": 40, "colour": 9, "colours": 4, "colouur": 4, "colou": 3, "coloür": 3, "coloûr": 3, "dolour": 18, "dolours": 2, "apple": 5, "apples": 9, "applez": 9, "xyzzy": 3, "aaaaa": 8, "aaaaaa": 4, "aaaaaaa": 2}
    frame = spark.createDataFrame([(w, c, "x") for w, c in n.items()], "word string, n long, near string").repartition(3)
    assert sorted(map(tuple, variants(frame).collect()), key=str) == sorted(brute(n), key=str)
    with pytest.raises(ValueError):
        variants(frame, 1)


def test_roots_of_long_chains_and_a_hub(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [(f"x{i}", "w3") for i in range(50)]
    assert {r.word: r.root for r in roots(spark.createDataFrame(links, "word string, form string")).collect()} == {a: "w37" for a, _ in links}


def test_whole_path_and_odd_rows(spark):
    words = ["Straße", "strasse", "house", "houses", "hause", "hose", "ÀÉïÿ×÷", "naïve", "naive", "naivé"]
    rows = [(i, " ".join(words[(i * k) % 10] for k in range(1, 9)) + "9" + words[i % 10].upper()) for i in range(400)]
    rows += [(None, "house1house-house"), (None, None), (7, ""), (7, rows[7][1]), (900, "houses " * 60_000), (901, "q" * 100_000)]
    docs = spark.createDataFrame([(i, t, 3) for i, t in rows], "doc_id long, text string, n int").repartition(3)
    got = word_counts(docs, slips=7)
    assert {r.word: r.n for r in got.collect()} == (want := counted(rows, 7)) and len(want) > 20
    assert sorted(map(tuple, variants(got).collect()), key=str) == sorted(brute(want), key=str)
    assert variants(word_counts(docs.limit(0))).count() == 0


@needs_data
def test_query_against_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op13_spelling"](spark, DATA).collect()), key=str)
    assert got == sorted(brute(counted(rows, 97)), key=str) and sum(r[1] is not None for r in got) > 20
