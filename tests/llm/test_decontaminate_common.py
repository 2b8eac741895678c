import random

from pyspark.sql import functions as F

from tidemill.llm import decontaminate
from tidemill.llm.decontaminate import contaminated, spared


def words(rng, n):
    return " ".join("".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(n))


def made(spark):
    """300 documents and 300 items that share an opening of ten words and nothing else, but for some that hold an item, one of them renamed."""
    rng = random.Random(5)
    opening = "please read the following short question and answer it carefully"
    items = [(i, f"{opening} {words(rng, 12)} Berlin {words(rng, 14)} {i + 100} metres {words(rng, 8)}") for i in range(300)]
    docs = [(i, f"{opening} {words(rng, 60)}") for i in range(300)]
    docs[7] = (7, f"{words(rng, 30)} {items[11][1]} {words(rng, 30)}")
    docs[9] = (9, f"{words(rng, 30)} {items[12][1].replace('Berlin', 'Oslo').replace('112', '985')} {words(rng, 5)}")
    # Only the opening and the first words of the item, which together are enough.
    docs[13] = (13, f"{words(rng, 9)} {' '.join(items[21][1].split()[:22])} {words(rng, 20)}")
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")


def test_a_shared_opening_meets_nothing(spark, monkeypatch):
    docs, items = made(spark)
    sent, meetings = [], decontaminate.meetings

    def counted(*a):
        found = meetings(*a)
        sent.append(found.count())
        return found

    monkeypatch.setattr(decontaminate, "meetings", counted)
    rows = lambda: sorted((r.doc_id, r.item_id, r.matched, r.renamed) for r in contaminated(docs, items).collect())
    got = rows()
    assert [(d, i, renamed) for d, i, _, renamed in got] == [(7, 11, False), (9, 12, True), (13, 21, False)] and sent[0] < 1000
    # The plain join of all windows tells the same, from hundreds of thousands of rows.
    monkeypatch.setattr(decontaminate, "COMMON", 10**9)
    assert rows() == got and sent[1] > 100_000


def test_common_windows_that_are_enough_are_searched():
    # 40 tokens, 16 of them needed: an opening of 12 is spared, but the window that would make it 16 is not.
    opening = [(300, h, h, 8) for h in range(5)]
    assert spared(opening, 16) == {0, 1, 2, 3, 4}
    assert spared([*opening, (200, 50, 8, 8), (9, 60, 20, 2)], 16) == {0, 1, 2, 3, 4, 60}
    assert spared([(300, 1, 0, 8), (300, 2, 30, 8)], 8) == set() and spared([(8, 1, 0, 8)], 16) == set()


def test_items_that_are_all_alike_are_all_found(spark):
    rng = random.Random(6)
    text = words(rng, 30)
    docs = spark.createDataFrame([(1, f"{words(rng, 5)} {text}"), (2, words(rng, 40)), (None, text)], "doc_id long, text string")
    items = spark.createDataFrame([(i, text) for i in range(20)] + [(None, text), (None, words(rng, 9))], "item_id long, text string")
    got = contaminated(docs, items).filter("item_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).collect()
    assert {r.doc_id: r.n for r in got} == {1: 20, None: 20}
