import random

from tidemill.llm import decontaminate
from tidemill.llm.decontaminate import TYPES, consistent, contaminated, judged, token


def test_tokens():
    assert token("Anna's,") == ("anna's", "<name>") and token("3.5%") == ("3.5", "<num>") and token("km") == ("km", "<unit>")
    assert token("###") is None and token("THE!!") == ("the", "the") and token("seven") == ("seven", "<num>")
    assert consistent([("#1", "#2"), ("#3", "#2")]) and not consistent([("#1", "#2"), ("#1", "#3")])
    assert not consistent([("@anna", "@mary"), ("@bob", "@mary")]) and consistent([("@anna", "@bob"), ("@bob", "@anna")])


Q = "Anna buys 12 apples at the market and gives Bob 5 of them so how many apples does Anna keep"
RENAMED = "Maria buys 40 apples at the market and gives Carl 7 of them so how many apples does Maria keep"
MIXED = "Maria buys 40 apples at the market and gives Carl 7 of them so how many apples does Peter keep"
OTHER = "the river ran over its banks last spring and took the old mill and two bridges with it"


def test_contaminated(spark):
    bench = spark.createDataFrame([(1, Q), (2, OTHER), (3, None), (4, ""), (5, "of the"), (6, "only six words are in here")], "item_id long, text string")
    rows = [
        (10, "x y z " + Q + " and more"), (11, RENAMED), (12, MIXED), (13, Q.upper() + "!!"), (14, " ".join(w + "$$" for w in OTHER.split())),
        (15, "a clean text about the river and the market of the town"), (16, None), (17, ""), (18, "so only six words are in here now"),
        (19, OTHER), (19, OTHER), (None, OTHER), (20, "filler " * 30_000 + OTHER), (21, " ".join(OTHER.split()[:5])),
    ]
    docs = spark.createDataFrame([(i, t, 1, "w") for i, t in rows], "doc_id long, text string, item_id int, words string").repartition(3)
    got = {(r.doc_id, r.item_id): r.renamed for r in contaminated(docs, bench).collect()}
    assert got.keys() == {(10, 1), (11, 1), (13, 1), (14, 2), (18, 6), (19, 2), (None, 2), (20, 2), (15, 5)}
    assert got[(11, 1)] and not got[(10, 1)]
    assert contaminated(docs.limit(0), bench).count() == 0 and contaminated(docs, bench.limit(0)).count() == 0


RICH = "Anna Bob Carl 3 Dora Emil 4 km Fritz Gerda 5 of Hans 6 h and Ida 7 miles to Jan 8 Kurt by 9 Lena 10 and Max"
TITLE = "Solve 12 + 7 * 30 - 5"


def test_short_and_slot_rich_items(spark):
    bench = spark.createDataFrame([(1, "Paris"), (2, "of the"), (3, RICH), (4, TITLE)], "item_id long, text string")
    other = RICH.replace("3", "33").replace("4", "44").replace("Anna", "Zoe").replace("Max", "Otto")
    mixed = other.replace("Otto", "Zoe")  # no renaming, but most of it stands there as it is
    rows = [(1, "in paris, he said"), (2, "comparisons of these"), (3, "one Of  the few of the many of the"), (4, RICH), (5, "x " + other), (6, mixed), (7, TITLE), (8, "Parisian offers")]
    got = sorted((r.doc_id, r.item_id, r.renamed) for r in contaminated(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect())
    assert got == [(1, 1, False), (3, 2, False), (4, 3, False), (5, 3, True), (6, 3, False), (7, 4, False)]


def brute(docs, bench, window=8, coverage=0.4):
    """Every window of every item against every position of every text, by the forms themselves."""
    found = {}
    for d, text in docs:
        own = [f for f in map(token, text.split()) if f]
        for k, item in bench:
            theirs = [f for f in map(token, item.split()) if f]
            size, matches = len(theirs), []
            if not size:
                continue
            spans = {(0, i, min(window, size)) for i in range(size - min(window, size) + 1)}
            for i in range(size - min(window, size) + 1):
                for n in (window, 16, 32):
                    n = min(n, size)
                    j = min(i, size - n)
                    slots = sum(f[1][0] == "<" for f in theirs[j : j + n])
                    if n - slots >= 4 or not slots:
                        if slots and size >= 5:
                            spans.add((1, j, n))
                        break
            for kind, i, n in spans:
                for p in range(len(own) - n + 1):
                    if [f[kind] for f in own[p : p + n]] == [f[kind] for f in theirs[i : i + n]]:
                        places = [x for x in range(n) if theirs[i + x][1][0] == "<"] if kind else None
                        value = lambda f: TYPES[f[1]] + f[0]
                        matches.append({"kind": kind, "n": n, "item_pos": i, "pos": p, "places": places, "slots": kind and [value(own[p + x]) for x in places], "item_slots": kind and [value(theirs[i + x]) for x in places]})
            for s in {m["pos"] // (2 * size) + e for m in matches for e in (0, -1)}:
                covered, renamed = judged([m for m in matches if m["pos"] // (2 * size) in (s, s + 1)])
                if covered >= coverage * size:
                    found[d, k] = max(found.get((d, k), (0, False)), (covered, not renamed))
    return {(d, k, c, not same) for (d, k), (c, same) in found.items()}


def test_agrees_with_brute_force(spark):
    rng = random.Random(5)
    common = "the of and a river runs by old mill town when they how many apples does keep each day".split()
    draw = lambda n: [rng.choice(common) if rng.random() < 0.7 else rng.choice([str(rng.randint(1, 40)), rng.choice("Anna Bob Carl Dora".split()), "km", f"w{rng.randint(0, 400)}"]) for _ in range(n)]
    bench = [(k, " ".join(draw(rng.choice([1, 3, 6, 8, 9, 14, 20, 45])))) for k in range(40)]
    docs = []
    for d in range(200):
        words = draw(rng.randint(0, 30))
        for _ in range(rng.randint(0, 2)):
            copy = bench[rng.randrange(40)][1].split()
            names = dict(zip("Anna Bob Carl Dora".split(), rng.sample("Eva Finn Gus Hal Anna".split(), 4), strict=True)) if rng.random() < 0.5 else {}
            copy = [names.get(w, w) if rng.random() < 0.98 else "Zed" for w in copy]
            if len(copy) > 3 and rng.random() < 0.3:
                copy.insert(rng.randrange(len(copy)), "verily")
            words += copy + draw(rng.randint(0, 12))
        docs.append((d, " ".join(words)))
    got = contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()
    want = brute(docs, bench)
    assert {(r.doc_id, r.item_id, r.matched, r.renamed) for r in got} == want and sum(x[3] for x in want) > 5


def test_what_passes_the_filter_is_joined_exactly(spark, monkeypatch):
    docs = spark.createDataFrame([(1, Q), (2, OTHER), (3, "so the day went on and on until the night fell over the hills")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, Q), (2, OTHER)], "item_id long, text string")
    want = sorted(map(str, contaminated(docs, bench).collect()))
    # A filter that lets nearly everything pass.
    monkeypatch.setattr(decontaminate, "FILTER_MOST", 4)
    monkeypatch.setattr(decontaminate, "FILTER_LEAST", 4)
    assert sorted(map(str, contaminated(docs, bench).collect())) == want
