"""Copies of benchmark items with words inserted, dropped, or renamed to another number of words."""

from tidemill.llm.decontaminate import contaminated

WORDS = [f"{a}{b}" for a in ("ba", "ce", "di", "fo", "gu", "ha", "je", "ki", "lo", "mu") for b in ("nar", "pel", "rit", "son", "tuk", "van", "wes", "xil", "yor", "zum", "bra", "clo")]
Q = "In a small town Anna buys 12 apples at the market near the old bridge and gives Bob 5 of them so how many apples does Anna keep for the rest of that day"
BOTH = Q.replace("Anna", "Mary Ann").replace("12", "one hundred and twelve").replace("Bob", "Carl")

#: Of three stretches of ten words, none reaches 40 % alone.
THIRDS = lambda *names: " verily ".join(" ".join([*WORDS[60 + 9 * i : 65 + 9 * i], name, *WORDS[65 + 9 * i : 69 + 9 * i]]) for i, name in enumerate(names))


def inserted(words, *places):
    out = list(words)
    for p in sorted(places, reverse=True):
        out.insert(p, "verily")
    return " ".join(out)


def test_edited_copies(spark):
    a, b, c, d = WORDS[:30], WORDS[:60], WORDS[:40], WORDS
    bench = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c)), (4, " ".join(d)), (5, Q), (6, THIRDS("Anna", "Anna", "Anna").replace(" verily", ""))]
    far = "so the day went on " * 60
    rows = [
        (10, inserted(a, 10, 20)), (11, "x y " + inserted(b, 20, 40)), (12, inserted(c, 13, 27)), (13, far + inserted(d, 30, 60, 90) + " " + far),
        (14, " ".join(w for i, w in enumerate(b) if i not in (20, 40))), (15, "so " + BOTH), (16, THIRDS("Maria", "Maria", "Maria")), (19, THIRDS("Maria", "Peter", "Carl")),
        (17, " ".join(c[26:40] + c[13:26] + c[:13])), (18, " ".join(c[:13]) + " " + far + " ".join(c[13:26]) + " " + far),
    ]
    got = contaminated(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()
    by = {(r.doc_id, r.item_id): r for r in got}
    assert {(10, 1), (11, 2), (12, 3), (13, 4), (14, 2), (15, 5), (16, 6)} <= by.keys()
    assert by[(10, 1)].matched == 30 and by[(13, 4)].matched == 120 and by[(15, 5)].renamed and by[(16, 6)].renamed and not by[(10, 1)].renamed
    assert not {(19, 6), (17, 3), (18, 3)} & by.keys()
