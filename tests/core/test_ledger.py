import threading
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemill.plans.collection import _path
from tidemill.sources import sinks, storage
from tidemill.sources.ledger import Append, Conflict, Drop, File, Ledger, Put, Replace


class Killed(BaseException):
    pass


def killed_at(step, times=1):
    left = [times]

    def on_step(name):
        if name == step and left[0]:
            left[0] -= 1
            raise Killed(name)

    return on_step


def frame(spark, rows, kind="id long, v string"):
    return spark.createDataFrame(rows, kind)


def held(ledger, table="t"):
    got = ledger.read(table)
    return None if got is None else sorted(map(tuple, got.collect()), key=str)


def test_a_file_is_created_once_and_whole(spark, tmp_path):
    path, made = f"{tmp_path}/log/1.commit", []
    assert storage.create_new(spark, path, b"first") and not storage.create_new(spark, path, b"second")
    assert storage.read_bytes(spark, path) == b"first" and storage.names(spark, f"{tmp_path}/log") == ["1.commit"]
    threads = [threading.Thread(target=lambda i=i: made.append(storage.create_new(spark, f"{tmp_path}/log/2.commit", b"%d" % i * 9))) for i in range(8)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert Counter(made) == {True: 1, False: 7} and storage.read_bytes(spark, f"{tmp_path}/log/2.commit") in {b"%d" % i * 9 for i in range(8)}
    assert storage.names(spark, f"{tmp_path}/none") == [] == storage.data_files(spark, f"{tmp_path}/none")


def test_prefixes():
    assert File("f", 0b10, 2, 1).covers(0b101, 3) and not File("f", 0b10, 2, 1).covers(0b111, 3) and File("f", 0b101, 3, 1).covers(0b10, 2) and File("f", 0, 0, 1).covers(7, 3)


def test_append_put_drop_replace(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    assert held(ledger) is None
    ledger.commit([Append("t", frame(spark, [(1, "b"), (1, "a"), (2, None), (None, "n")]), ["id"], ["v"])])
    ledger.commit([Append("t", frame(spark, [(1, "z"), (3, "c")]), ["id"], ["v"])])
    assert held(ledger) == sorted([(1, "a"), (2, None), (3, "c"), (None, "n")], key=str)
    before = ledger.read("t")
    # Columns come by name and are cast to the table's kinds; other columns are left out.
    ledger.commit([Put("t", spark.createDataFrame([("new", 2, 5), ("newer", 2, 6), ("d", 4, 0)], "v string, id int, n int"), ["id"], ["v"])])
    ledger.commit([Drop("t", frame(spark, [(1,), (9,)], "id int"), ["id"])])
    assert held(ledger) == sorted([(2, "newer"), (3, "c"), (4, "d"), (None, "n")], key=str)
    assert before.count() == 4 and sorted(map(tuple, ledger.read("t", 2).collect()), key=str) == sorted(map(tuple, before.collect()), key=str)
    done = ledger.commit([Replace("t", frame(spark, [(7, "x")]), ["id"], seen=4)])
    assert held(ledger) == [(7, "x")] and done.version == 5
    with pytest.raises(Conflict):
        ledger.commit([Replace("t", frame(spark, []), ["id"], seen=4)])
    ledger.commit([Replace("t", frame(spark, []), ["id"])])
    assert held(ledger) == []
    ledger.commit([Append("t", frame(spark, []), ["id"], ["v"])])
    with pytest.raises(ValueError):
        ledger.commit([Append("t", frame(spark, []), ["v"], ["id"])])
    with pytest.raises(ValueError):
        ledger.commit([Append("t", frame(spark, []), ["id"], ["v"]), Drop("t", frame(spark, []), ["id"])])
    with pytest.raises(ValueError):
        ledger.read("t", 99)


def test_two_writers_at_once_write_each_key_once(spark, tmp_path):
    """Both prepare on the same version, so the later one has to look again at what the earlier one has added."""
    meet, met = threading.Barrier(2), []

    def gate(name):
        if name == "commit" and len(met) < 2:
            met.append(name)
            meet.wait(60)

    done = {}

    def write(who, ids):
        ledger = Ledger(spark, str(tmp_path), bucket_rows=40, on_step=gate)
        done[who] = ledger.commit([Append("t", frame(spark, [(i, who) for i in ids]), ["id"], ["v"])])

    threads = [threading.Thread(target=write, args=a) for a in (("a", range(0, 200)), ("b", range(100, 300)))]
    [t.start() for t in threads], [t.join() for t in threads]
    got = held(Ledger(spark, str(tmp_path)))
    assert [i for i, _ in sorted(got)] == list(range(300)) and sum(d.rows["t"] for d in done.values()) == 300
    # One of them came second, and its rows of the common keys are not there.
    assert max(d.tries for d in done.values()) > 1 and Counter(w for i, w in got if 100 <= i < 200) in ({"a": 100}, {"b": 100})


def test_changes_that_meet_are_done_again(spark, tmp_path):
    one = Ledger(spark, str(tmp_path))
    one.commit([Append("t", frame(spark, [(1, "a"), (2, "b")]), ["id"], ["v"])])

    def meanwhile(changes):
        """A writer to which this happens just before its commit."""
        left = [changes]
        return Ledger(spark, str(tmp_path), on_step=lambda name: left and name == "commit" and one.commit(left.pop()))

    # What the append took for known is dropped meanwhile: it is new after all.
    meanwhile([Drop("t", frame(spark, [(1,)], "id long"), ["id"])]).commit([Append("t", frame(spark, [(1, "again"), (3, "c")]), ["id"], ["v"])])
    assert held(one) == [(1, "again"), (2, "b"), (3, "c")]
    # Two put the same key: the later one stands, and what the other put beside it stays.
    meanwhile([Put("t", frame(spark, [(1, "other"), (4, "d")]), ["id"], ["v"])]).commit([Put("t", frame(spark, [(1, "mine")]), ["id"], ["v"])])
    assert held(one) == [(1, "mine"), (2, "b"), (3, "c"), (4, "d")]
    # A new generation comes in between.
    meanwhile([Replace("t", frame(spark, [(2, "fresh")]), ["id"])]).commit([Append("t", frame(spark, [(2, "x"), (1, "y")]), ["id"], ["v"])])
    assert held(one) == [(1, "y"), (2, "fresh")]
    with pytest.raises(Conflict):
        meanwhile([Put("t", frame(spark, [(5, "e")]), ["id"], ["v"])]).commit([Replace("t", frame(spark, []), ["id"], seen=one.snapshot().version)])
    # Another table is in nobody's way.
    assert meanwhile([Append("u", frame(spark, [(1, "u")]), ["id"], ["v"])]).commit([Put("t", frame(spark, [(6, "f")]), ["id"], ["v"])]).tries == 2
    assert (6, "f") in held(one) and held(one, "u") == [(1, "u")]


@pytest.mark.parametrize("step", ["write", "commit", "after", "tidy"])
def test_a_writer_killed_at_any_step(spark, tmp_path, step):
    """A reader sees one whole state, before or after; the next try of the same batch leaves each row once."""
    start = Ledger(spark, str(tmp_path), bucket_rows=8, most_files=1)
    start.commit([Append("rows", frame(spark, [(1, "a")]), ["id"], ["v"]), Put("at", frame(spark, [("q", 1)], "query string, page int"), ["query"], ["page"])], batch=("w", 0))
    whole = [([(1, "a")], [("q", 1)]), ([(1, "a"), (2, "b")], [("q", 2)])]

    def second(ledger):
        return ledger.commit([Append("rows", frame(spark, [(1, "z"), (2, "b")]), ["id"], ["v"]), Put("at", frame(spark, [("q", 2)], "query string, page int"), ["query"], ["page"])], batch=("w", 1))

    with pytest.raises(Killed):
        second(Ledger(spark, str(tmp_path), bucket_rows=8, most_files=1, on_step=killed_at(step)))
    seen = (held(start, "rows"), held(start, "at"))
    assert seen == whole[step in ("after", "tidy")]
    assert second(start).repeated == (step in ("after", "tidy"))
    assert (held(start, "rows"), held(start, "at")) == whole[1]
    # What the dead writer has left is deleted once it is old; what counts stays.
    later = 4_000_000_000_000
    start.vacuum(now_ms=later)
    assert start.vacuum(now_ms=later) == 0 and (held(start, "rows"), held(start, "at")) == whole[1]


def test_files_opened_follow_the_batch_not_the_history(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path), bucket_rows=50, most_files=4)
    opened, total = [], []
    for k in range(9):
        ledger.commit([Append("t", spark.range(k * 200, k * 200 + 220).select("id", F.lit(str(k)).alias("v")), ["id"], ["v"])])
        small = ledger.commit([Append("t", frame(spark, [(5, "x"), (10_000 + k, "y")]), ["id"], ["v"])])
        opened.append(small.opened["t"])
        total.append(len(ledger.snapshot().tables["t"].files))
    got = held(ledger)
    assert sorted(i for i, _ in got) == list(range(8 * 200 + 220)) + [10_000 + k for k in range(9)]
    assert next(v for i, v in got if i == 5) == "0"
    # Two keys: two prefixes, of which each has a few files, besides the small ones that are not merged yet.
    assert total[-1] > 30 and max(opened) <= 3 * 4 + 5 and max(opened[-3:]) < total[-1] / 4
    assert ledger.snapshot().version > 16 and "sum" in {n[21:] for n in storage.names(spark, f"{tmp_path}/log")}
    # The log before its last sum goes with what no version names; the table stays, and is written on.
    before = storage.names(spark, f"{tmp_path}/log")
    assert ledger.vacuum(now_ms=4_000_000_000_000) > 0 and storage.names(spark, f"{tmp_path}/log")[0].endswith("16.commit") and before[0].endswith("01.commit")
    assert held(ledger) == got and ledger.commit([Append("t", frame(spark, [(5, "x"), (-1, "new")]), ["id"], ["v"])]).rows == {"t": 1}


def test_rows_index_and_checkpoints_are_one_commit(spark, tmp_path):
    from tests.core.test_sources import rows_of

    rows = rows_of(spark, [("Acme", "a", "1", "ID1", 0), ("acme", "b", "2", "", 2), ("other", "a", "1", "ID1", 0)])
    at = lambda *r: spark.createDataFrame(r, "query string, shard int, page int, rows long")
    path = str(tmp_path)
    sinks.append_indexed(rows, path, ["number"], at(("acme", 0, 3, 300), ("acme", 0, 4, 400), ("other", 1, 1, None)), ("run", 1))
    assert sinks.append_indexed(rows, path, ["number"], at(("acme", 0, 9, 900)), ("run", 1)).repeated
    assert sorted((r.query, r.shard, r.page, r.rows) for r in sinks.written(spark, path, "checkpoints").collect()) == [("acme", 0, 4, 400), ("other", 1, 1, None)]
    assert sinks.written(spark, path, "index").count() == 3 == sinks.written(spark, path).count()
    sinks.finish(spark, path, spark.createDataFrame([("acme",)], "query string"))
    assert [r["query"] for r in sinks.written(spark, path, "checkpoints").collect()] == ["other"] == [r["query"] for r in sinks.written(spark, path, "index").collect()]
    assert sinks.written(spark, path).count() == 3 and _path(spark, "x") != _path(spark, "x")


def test_files_grow_before_they_are_very_many(spark, tmp_path):
    files = lambda rows, per: 1 << Ledger(spark, str(tmp_path), bucket_rows=per)._depth(rows)
    assert files(5_400_000, 400) == 256 and files(15_000, 400) == 64 and files(300, 400) == 1
    # Never more than 64 times bucket_rows in one, nor more than are asked for where that is a million.
    assert files(200_000_000, 400) == 8192 and files(1 << 30, 1 << 20) == 1024
