"""The registered queries over a small copy of the tables: against their SQL, or else against brute force."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.compare import DATA, agree, needs_data
from tests.llm.test_simple_ops import brute_components
from tests.llm.test_substrings import brute
from tidemill.llm.queries import ORACLE, QUERIES

pytestmark = needs_data


@pytest.fixture(scope="module")
def docs(spark):
    return [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]


def rows(spark, name):
    return QUERIES[name](spark, DATA).collect()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_agrees_with_sql(spark, name):
    agree(spark, QUERIES[name], ORACLE[name])


def test_lm_score(spark, docs):
    split = lambda t: t.encode().lower().split() + [b""]
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in docs}
    c = Counter(w for i, t in docs if not held[i] for w in split(t))
    n, v = sum(c.values()), len(c)
    got = {r.doc_id: r for r in rows(spark, "op1_lm_score")}
    for i, t in docs:
        r, w = got[i], split(t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(w), sum(x in c for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), rel_tol=1e-9)
    out = [r for r in got.values() if r.held_out]
    assert len(got) == len(docs) and sum(r.score for r in out) > sum(r.base_score for r in out)


def test_toxicity(spark, docs):
    got = rows(spark, "op2_toxicity")
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in docs)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    gold = {r.doc_id: r.toxic for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    seen = [r for r in got if r.doc_id in gold]
    assert np.mean([r.predicted == gold[r.doc_id] for r in seen]) > 0.85
    assert not any(r.predicted for r in seen if not gold[r.doc_id])


def test_packing(spark, docs):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows(spark, "op3_packing"):
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert pieces.keys() == {i for i, _ in docs}
    for (i, _), e in zip(docs, t.encode_batch([x for _, x in docs], add_special_tokens=False), strict=True):
        ids, at = np.array(e.ids + [1], "<u4"), 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding < 0.02 * total


def test_simhash(spark, docs):
    got = {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in rows(spark, "op5_simhash")}
    assert got == {i: (f, c) for i, f, c in brute_components(docs)}


def test_sharding(spark, docs):
    by = defaultdict(list)
    for r in rows(spark, "op6_sharding"):
        by[r.shard].append(r)
    assert sorted(r.doc_id for s in by.values() for r in s) == sorted(i for i, _ in docs)
    assert all(sorted(r.slot for r in s) == list(range(len(s))) for s in by.values()) and set(by) == set(range(40))
    sizes = [sum(r.size for r in s) for s in by.values()]
    # Documents and groups of equal texts that stay whole are as far as sizes can be off.
    mean, largest = sum(sizes) / 40, max(r.size for s in by.values() for r in s)
    assert max(sizes) < mean + 2 * largest and min(sizes) > mean - 2 * largest
    where = defaultdict(set)
    for s in by.values():
        for r in s:
            where[r.text_crc32].add((r.shard, r.group_split))
    assert all(len(x) == 1 or all(split for _, split in x) for x in where.values())
    text = dict(docs)
    assert all(r.size == len(text[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for s in by.values() for r in s)


def test_suffixes(spark, docs):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows(spark, "op7_suffixes")}
    least: dict[bytes, int] = {}
    for i, t in sorted(docs):
        x = t.encode()
        for k in range(len(x) - 49):
            least.setdefault(x[k : k + 50], i)
    for i, t in docs:
        x, gone = t.encode(), bytearray(len(t.encode()))
        for k in range(len(x) - 49):
            if least[x[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        runs = sum(1 for a, b in zip(b"\0" + bytes(gone), gone, strict=False) if b and not a)
        assert got[i] == (len(x), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(x, gone, strict=True) if not g)).hexdigest())


def test_decontaminate(spark, docs):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in rows(spark, "op8_decontaminate")}
    whole = {(i, k) for i, t in docs for k, x in bench if x in t}
    assert whole and whole <= got
    words = {k: x.lower().split() for k, x in bench}
    for i, k in got - whole:
        held, own = set(dict(docs)[i].lower().split()), words[k]
        assert sum(any(h.startswith(w) for h in held) for w in own) > 0.4 * len(own)


def test_brute_is_brute():
    assert brute([(1, "abcd"), (2, "xbcdy")], 3, None) == [[False] * 4, [False, True, True, True, False]]
