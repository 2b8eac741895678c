"""The pipeline against a brute-force version: only the toxicity scores themselves are taken from the operator, which has its own test."""

import re

import numpy as np
import pytest

from tests.llm.test_substrings import brute

pipeline = pytest.importorskip("corpus_pipeline")


def shingles(text):
    """Five words each; a shorter text is one shingle."""
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def tables(spark, path):
    rng = np.random.default_rng(8)
    text = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 3000, n))
    passage, item = text(70), "Anna buys 12 apples at the market and gives Bob 5 of them so how many apples does Anna keep"
    rows = []
    for i in range(240):
        t = text(int(rng.integers(60, 200)))
        if i % 8 == 1:
            t += " vile thing"
        if i % 10 == 4:
            t = t + "\n\n" + passage + "\nend of it"
        if i % 12 == 5:
            t += "\n" + item.replace("Anna", "Maria").replace("12", str(i))
        rows.append((i, t))
    rows += [(300, rows[0][1]), (301, rows[0][1]), (302, rows[2][1] + " more"), (303, ""), (304, None), (305, passage), (306, text(3000)), (7, rows[7][1])]
    # Words changed at one end: 40 of 46 shingles of both are shared (0.87), or 36 of 50 (0.72), whatever their fingerprints say.
    base = rows[18][1].split()[:47]
    rows += [(310, " ".join(base)), (311, " ".join(base[:-3] + ["new", "words", "here"])), (312, " ".join(base[:-7] + [f"n{k}" for k in range(7)]))]
    docs = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int("vile" in (t or ""))) for i, t in rows if i < 200], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return docs


def test_stages_against_brute_force(spark, tmp_path):
    path = str(tmp_path)
    docs = tables(spark, path)
    seen, now = [], spark.read.parquet(f"{path}/documents.parquet")
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, now, path).write.parquet(f"{path}/{k}")
        now = spark.read.parquet(f"{path}/{k}")
        if k < 4:
            assert tuple(now.columns) == pipeline.COLUMNS
            seen.append(sorted(map(tuple, now.collect()), key=str))
    want = [d for d in docs if "vile" not in (d[1] or "")]
    assert seen[0] == sorted(want, key=str)
    sets = [shingles(d[1]) for d in want]
    root = list(range(len(want)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(want)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) or want[a][0] == want[b][0]:
                root[find(a)] = find(b)
    least = {}
    for k, d in enumerate(want):
        least[find(k)] = min(d[0], least.get(find(k), d[0]))
    want = [d for k, d in enumerate(want) if least[find(k)] == d[0]]
    assert seen[1] == sorted(want, key=str) and not {300, 301, 304} & {d[0] for d in want}
    words = [(d[0], (d[1] or "").split()) for d in want]
    cut = []
    for d, gone in zip(want, brute(words, 50, None), strict=True):
        if any(gone):
            kept = "".join(p for p, g in zip(re.findall(r"\s*\S+", d[1]), gone, strict=True) if not g).lstrip()
            if kept:
                cut.append((d[0], kept, *d[2:4], len(kept)))
        else:
            cut.append((d[0], d[1] or "", *d[2:]))
    assert seen[2] == sorted(cut, key=str) and 305 not in {d[0] for d in cut} and len(cut) > 100
    clean = [d for d in cut if "apples" not in d[1]]
    assert seen[3] == sorted(clean, key=str) and len(clean) < len(cut)
    assert {r.doc_id for r in now.collect()} == {d[0] for d in clean}
    assert sorted(map(tuple, pipeline.run(spark, path).select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(map(tuple, now.select("doc_id", "start", "length", "ids_crc32").collect()))


def test_rows_without_an_id_and_empty_tables(spark, tmp_path):
    path = str(tmp_path)
    text = lambda seed, n: " ".join(f"w{x}" for x in np.random.default_rng(seed).integers(0, 3000, n))
    passage = text(1, 60)
    rows = [(None, text(2, 80)), (None, text(2, 80)), (None, text(3, 80) + " " + passage), (None, text(4, 80) + " " + passage), (1, text(5, 80)), (None, text(5, 80)), (2, None), (None, None), (3, "")]
    made = spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    made.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    # Copies without an id are kept once, or not at all beside one with an id.
    kept = pipeline.near_duplicates(spark, docs, path).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in kept) == sorted([("None", text(2, 80)), ("None", text(3, 80) + " " + passage), ("None", text(4, 80) + " " + passage), ("1", text(5, 80)), ("2", "")])
    # Different texts without an id are different documents: one of two loses the passage.
    cut = [r.text for r in pipeline.passages(spark, docs, path).collect()]
    assert sum(passage in t for t in cut) == 1 and len(cut) >= 5
    assert pipeline.benchmark_passages(spark, docs, path).count() == len(rows)
    assert {r.doc_id for r in pipeline.run(spark, path).collect()} <= {None, 1, 2, 3}
    none = docs.limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, none, path).count() == 0
