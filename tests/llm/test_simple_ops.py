import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemill.llm import packing, quality, simhash, warc
from tidemill.llm.common import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [(1, "a b c a b c d"), (2, None), (3, ""), (4, "One two\nthree  four\n\nfive"), (5, "x" * 5000), (6, "w " * 3000), (7, "a b c a b c d"), (None, "null id"), (7, "a b c a b c d"), (8, "é ñ 日本 #*$ & |\nb\nb\n \n \n")]


def docs(spark, rows=TEXTS):
    return spark.createDataFrame([(i, t, 9, "x") for i, t in rows], "doc_id long, text string, n_words int, fp string")


def brute_repeats(words):
    n = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i in range(len(words) - 2):
        if n[tuple(words[i : i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    return len(hit)


@given(st.lists(st.sampled_from("abc"), max_size=40))
def test_repeated_words(words):
    assert quality.repeated_words([w.encode() for w in words]) == brute_repeats(words)


def test_quality(spark):
    got = sorted(map(tuple, quality.quality(docs(spark)).collect()), key=str)
    want = []
    for i, t in TEXTS:
        t = t or ""
        w = WORD.findall(t)
        lines, seen, dup = t.split("\n"), set(), 0
        for x in lines:
            if WORD.search(x):
                dup += x in seen
                seen.add(x)
        r = brute_repeats(w)
        want.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, r, len(w) < 50 or 100 * r > 50 * len(w)))
    assert [x[:7] for x in got] == sorted(want, key=str)
    assert all(not x[7] or not x[6] for x in got)
    assert quality.quality(docs(spark, [])).count() == 0


def test_quality_order_does_not_change_the_verdict(spark):
    rows = [(i, " ".join(f"w{i * j % 97}" for j in range(80)) + " # $" * i) for i in range(20)]
    one = quality.quality(docs(spark, rows), order=list(quality.RULES)).select("doc_id", "kept").collect()
    two = quality.quality(docs(spark, rows), order=list(quality.RULES)[::-1]).select("doc_id", "kept").collect()
    assert sorted(one) == sorted(two) and {x.kept for x in one} == {True, False}


def test_quality_short_circuit(spark, monkeypatch):
    rng = np.random.default_rng(6)
    text = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 5000, n))
    rows = [(i, text(300) + (" # $ %" * 60 if i % 2 else "")) for i in range(200)] + [(999, text(30_000)), (1000, None)]
    found = quality.estimates(docs(spark, rows), rows=100)
    assert found["symbols"][0] > 0 and all(r[1] == found["symbols"][1] > 30 for r in found.values()) and found["one_word"][2] > 0
    order = quality.cascade_order(docs(spark, rows), rows=100)
    assert sorted(order) == sorted(quality.RULES) and order[0] == "symbols"
    calls = lambda names: quality.quality(docs(spark, rows), order=names).selectExpr("sum(calls)").first()[0]
    assert calls(order) == 100 * 1 + 101 * 6 < calls([x for x in order if x != "symbols"] + ["symbols"]) == 201 * 6
    # Measures that only later rules look at are not made.
    lean = {r.doc_id: r for r in quality.quality(docs(spark, rows), order=order, measures=False).collect()}
    assert lean[1].rejected_by == "symbols" and lean[1].n_symbols > 0 and lean[1].word_chars is lean[1].n_dup_lines is None
    assert lean[0].kept and lean[0].word_chars and lean[999].kept


def test_few_words_at_any_length(spark):
    rng = np.random.default_rng(7)
    rows = [(n, " ".join(f"w{x}" for x in rng.integers(0, 40, n))) for n in (900, 4_999, 5_000, 20_000)]
    assert all(quality.RULES["few_words"](quality.Text(t)) for n, t in rows)


def test_packing(spark):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = TEXTS + [(100 + i, f"word{i} 's  end \n\n it's" * (i * 7 % 60) + " <|endoftext|> x") for i in range(60)]
    got = packing.pack(docs(spark, rows), P.path("byte_bpe_50k.tiktoken"), group=16, with_ids=True).collect()
    same = packing.pack(docs(spark, rows), P.path("byte_bpe_50k.json"), group=16, with_ids=True).collect()
    assert sorted(map(str, got)) == sorted(map(str, same))
    ids = {}
    for p in got:
        assert p.length == len(p.ids) // 4 and p.ids_crc32 == zlib.crc32(p.ids)
    want = Counter()
    for i, x in rows:
        want[(i, np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4").tobytes())] += 1
    for p in sorted(got, key=lambda p: p.start):
        ids.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for (i, n), ps in ids.items():
        if i != 7:
            joined = b"".join(p.ids for p in ps)
            assert len(joined) == 4 * n and (i, joined) in want
    assert sum(p.length for p in got) == sum(len(k[1]) // 4 * v for k, v in want.items())
    seqs = {}
    for p in got:
        seqs.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 2048
    assert packing.pack(docs(spark, []), P.path("byte_bpe_50k.json")).count() == 0


@given(st.lists(st.integers(1, 64), max_size=60))
def test_first_fit_decreasing(sizes):
    got = packing.first_fit_decreasing(sizes, 64) if sizes else []
    bins, where = [], [None] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        b = next((k for k, used in enumerate(bins) if used + sizes[i] <= 64), len(bins))
        if b == len(bins):
            bins.append(0)
        where[i] = (b, bins[b])
        bins[b] += sizes[i]
    assert got == where


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    s = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_components(rows):
    fp = [(2**63 - 1 if i is None else i, brute_fingerprint(t)) for i, t in rows]
    root = list(range(len(fp)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(fp)):
        for b in range(a):
            if (fp[a][1] ^ fp[b][1]).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(fp):
        least[find(k)] = min(i, least.get(find(k), i))
    return [(rows[k][0], fp[k][1], least[find(k)]) for k in range(len(fp))]


def test_near_duplicates(spark):
    rng = np.random.default_rng(5)
    base = [" ".join(f"v{x}" for x in rng.integers(0, 400, 150)) for _ in range(12)]
    rows = TEXTS + [(20 + i, base[i % 12] + " tail" * (i // 12)) for i in range(72)]
    got = sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.near_duplicates(docs(spark, rows)).collect()), key=str)
    want = sorted(((i, f, None if c == 2**63 - 1 else c) for i, f, c in brute_components(rows)), key=str)
    assert got == want and len({c for _, _, c in got}) < len(rows) - 20
    assert simhash.near_duplicates(docs(spark, [])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), min_size=1, max_size=3))
def test_linked_fingerprints_share_an_anchor(x, flips):
    y = x
    for k in flips:
        y ^= 1 << k
    index, anchor = simhash.anchors(np.array([x, y], np.uint64))
    assert set(anchor[index == 0]) & set(anchor[index == 1])


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1060)] + [(5, 5)]
    root = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in range(400):
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == root and len(got) == len(root)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_warc_round_trip(spark, tmp_path):
    big, odd = "<p>é\r\n\r\nWARC/1.1\r\n" * 100, "x\n" * 600
    rows = [(1, "u1", big), (2, "u 2\n", big), (3, None, "tiny"), (4, "u4", "tiny"), (5, "u5", None), (6, "u6", odd), (9, "u9", big), (None, "n", odd), (9, "u9b", big), (10, "", "y" * 200_000)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, payload int")
    warc.write_archives(warc.resolved(pages), f"{tmp_path}/a", 3)
    got = sorted((tuple(r) for r in warc.read_archives(spark, f"{tmp_path}/a").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok").collect()), key=str)
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        keeper = max(r[0] for r in rows if (r[2] or "").encode() == b and r[0] is not None)
        again = len(b) >= 1000 and i != keeper
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", keeper if again else None, True))
    assert got == sorted(want, key=str)
    assert warc.resolved(pages.limit(0)).count() == 0
