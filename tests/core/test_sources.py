import os

import pytest
from pyspark.sql import functions as F

from tidemill.sources import config, datasource, index, ledger, lists, pages, sinks
from tidemill.schemas import COLUMNS


def put(path, text):
    path.write_bytes(text.encode() if isinstance(text, str) else text)
    return str(path)


def test_lists_stores_and_rules(spark, tmp_path):
    p = put(tmp_path / "task.txt", "﻿ACME\r\n\n# no\n  beta \nACME\n")
    assert [tuple(r) for r in lists.lines(spark, p).orderBy("pos").collect()] == [(0, "ACME"), (3, "beta"), (4, "ACME")]
    with pytest.raises(ValueError, match="no entries"):
        lists.lines(spark, put(tmp_path / "none.txt", "# a\n\n"))
    s = put(tmp_path / "done.lst", "﻿ACME\t955\n acme \n#kept\nOther")
    assert {tuple(r) for r in lists.store(spark, s).collect()} == {("acme", "ACME\t955"), ("#kept", "#kept"), ("other", "Other")}
    assert lists.store(spark, str(tmp_path / "missing")).count() == 0
    r = put(tmp_path / "rules", "skip@::@one\nbad line\nsleep9@::@two\nfly@::@x\nskip@::@\nsleep7@::@one\npauseAll@::@ three @::@ y \n")
    assert [tuple(x) for x in lists.rules(spark, r).orderBy("ord").collect()] == [(0, "skip", "one"), (2, "sleep9", "two"), (6, "pauseAll", "three @::@ y")]
    c = put(tmp_path / "counts", "2024-01-02\tACME\t955\nshort\tline\n2024-01-03\tacme\t12\n")
    assert [(str(x.day), x["query"], x.n_results) for x in lists.counts(spark, c).orderBy("pos").collect()] == [("2024-01-02", "acme", 955), ("2024-01-03", "acme", 12)]
    old = [put(tmp_path / n, t) for n, t in (("lost", "a\tx\nb\n"), ("counters", "C\n\td\na\n"))]
    assert {x.name for x in lists.legacy_done(spark, *old).collect()} == {"a", "b", "c"}


def line(query, brand, number="3", n=13):
    return "\t".join((["2024-01-01 00:00:00", query, brand, 'h "q"', "s", "o", "d", "r", "n", "v", "ID", "rs", number] + ["more"] * 9)[:n])


def test_output_parts(spark, tmp_path):
    p = put(tmp_path / "out.tsv", "\n".join([line("Q", "new"), line("q2", "x", "none"), "torn\tline", line("q", "long", n=15)]))
    put(tmp_path / "out.tsv.1", line("Q", "old"))
    put(tmp_path / "out.tsv.3", line("done", "gone"))
    put(tmp_path / "out.tsv.bak", line("no", "no"))
    got = lists.output_rows(spark, p, spark.createDataFrame([("done",)], "name string"))
    assert sorted((r.part, r["query"], r.brand, r.number) for r in got.collect()) == [(1, "Q", "old", 3), (2**62, "Q", "new", 3), (2**62, "q", "long", 3), (2**62, "q2", "x", -1)]
    assert got.filter("brand = 'new'").first().holder == 'h "q"'
    assert lists.output_rows(spark, str(tmp_path / "nothing")).count() == 0
    texts = ["4821\t482100", "512", "garbage", "0\t5", "7\tx", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i")
    assert [tuple(r.c) for r in df.select(lists.checkpoint_text(F.col("t")).alias("c")).collect()] == [(4821, 482100), (512, None), (0, None), (0, None), (7, None), (0, None)]


PAGE = """{"response": {"numFound": 3, "start": 200, "docs": [
 {"ID": "ROM.1", "STATUS": "DEL_REN2", "OO": "CH", "RD": "2015-03-20T00:00:00Z", "IRN": "1246127", "NC": [17, 19, "17"], "VCS": ["21.052.01", "21.05"], "BRAND": ["A", "B \\"x\\""], "HOL": ["One", "Two", "Three"]},
 {"ID": 7, "STATUS": null, "RD": "2020-01-01", "USC": ["123456"], "HOL": "HOLDER", "X": {}},
 {"ID": "ROM.3", "BRAND": "plain", "BRAND_EN": ["english"], "HOL_EN": [""], "HOL": "L", "STATUS": "PEND_W", "IRN": []}]},
 "highlighting": {"ROM.1": {"HOL": ["a <em>b</em>", "c"], "BRAND_EN": []}, "7": {"BRAND": ["<em>lit</em>"]}}}"""


def test_json_pages(spark):
    long = '{"response": {"numFound": 1, "start": 0, "docs": [{"HOL": "%s"}]}}' % ("€" * 65)
    bodies = [PAGE, "<html>", '{"error": "An error occurred processing your request"}', '{"response": null, "error": {"m": "other"}}', '{"a": 1}', '{"response": {"numFound": 0, "docs": []}, "error": "please report the error"}', long, "", '{"response": {"numFound": 0, "start": 0, "docs": []}}']
    d = pages.decode(spark.createDataFrame(list(enumerate(bodies)), "i int, body string"))
    assert [r.verdict for r in d.orderBy("i").collect()] == ["ok", "not_json", "app_error", "not_json", "not_json", "app_error", "ok", "not_json", "ok"]
    rows = [tuple(r)[1:] for r in pages.page_rows(d.filter("i = 0"), "i").orderBy("number").collect()]
    assert rows == [
        (3, "", "a b,c+2", "Inactive: expired", "CH", "2015-03-20", "1246127", "17, 19", "21.05", "ROM.1", "DEL_REN2", 200),
        (3, "lit", "HOLDER", "STATUS_", "", "", "", "", "US12345", "7", "", 201),
        (3, "english", "L", "Pending application: irregularity letter", "", "", "", "", "", "ROM.3", "PEND_W", 202),
    ]
    shown = pages.page_rows(d.filter("i = 6"), "i").first()
    assert shown.holder == "€" * 65 + "..." and shown.brand == "No Verbal Elements"


GRID = f"""<tbody><tr class="first"><td aria-describedby="{pages.ARIA}BRAND" title="phantom"></td></tr>
<tr id="1"><td aria-describedby="{pages.ARIA}BRAND" title="R014&nbsp; PEARLY &amp; CO">R<em>014</em></td><td aria-describedby="{pages.ARIA}HOL">Kron<b>o</b>plus
 Limited</td><td aria-describedby="{pages.ARIA}result_number">0</td><td aria-describedby="{pages.ARIA}VCS" title="">&nbsp;</td><td>other</td></tr>
<tr id="2"><td aria-describedby="{pages.ARIA}BRAND" title="second">x<table><tr id="9"><td>in</td></tr></table></td></tr>
<tr id="3"><td aria-describedby="{pages.ARIA}HOL" title="no brand"></td></tr></tbody>"""


def test_html_grid(spark):
    want = [("R014 PEARLY & CO", "Kronoplus Limited", "", 0), ("second", "", "", -1)]
    for body in (GRID, f"<table>{GRID}</table>"):
        df = spark.createDataFrame([(1, body), (2, ""), (3, None), (4, "<p>nothing</p>")], "i int, body string")
        assert [(r.brand, r.holder, r.vienna, r.number) for r in pages.grid_rows(df, "i").collect()] == want
    assert pages.grid(" ") is None and pages.grid("<p>x</p>") == []
    text = spark.createDataFrame([("<div>Pending: <br>A &amp; B</div>",), (None,)], "t string").select(pages.text_content(F.col("t"))).collect()
    assert [r[0] for r in text] == ["Pending: A & B", None]


def test_captured_pages(spark, tmp_path):
    for n in (1, 2, 10):
        put(tmp_path / f"acme corp_p{n}.raw", f"body {n}")
    put(tmp_path / "note.txt", "x")
    assert sorted(tuple(r) for r in pages.captured(spark, str(tmp_path)).collect()) == [("acme corp", 1, "body 1"), ("acme corp", 2, "body 2"), ("acme corp", 10, "body 10")]
    datasource.register(spark)
    df = spark.read.format("captured_pages").option("block", "1").load(str(tmp_path))
    assert sorted(r.page for r in df.collect()) == [1, 2, 10] and df.rdd.getNumPartitions() == 3
    few = spark.read.format("captured_pages").load(str(tmp_path)).filter("page > 1 AND page <= 9 AND query = 'acme corp'")
    assert [tuple(r) for r in few.collect()] == [("acme corp", 2, "body 2")]


def rows_of(spark, rows):
    full = [(q, *([b] + [""] * 8 + [i, ""])[:1], "", "", "", "", r, "", "", i, "", n) for q, b, r, i, n in rows]
    return spark.createDataFrame(full, "query string, " + ", ".join(f"{c} {'int' if c == 'number' else 'string'}" for c in COLUMNS))


def test_sinks(spark, tmp_path):
    out = str(tmp_path / "rows")
    batch = rows_of(spark, [("Acme", "a", "1", "ID1", 0), ("acme", "a2", "1", "ID1", 1), ("acme", "b", "2", "", 2), ("other", "a", "1", "ID1", 0)])
    sinks.append_rows(batch, out, ["number"])
    sinks.append_rows(batch, out, ["number"])
    assert sorted((r.query_key, r.brand) for r in sinks.written(spark, out).collect()) == [("acme", "a"), ("acme", "b"), ("other", "a")]
    with pytest.raises(Exception, match="boom"):
        sinks.append_rows(rows_of(spark, [("new", "n", "9", "ID9", 0)]).withColumn("holder", F.raise_error(F.lit("boom")).cast("string")), out, ["number"])
    sinks.append_rows(rows_of(spark, [("new", "n", "9", "ID9", 0)]), out, ["number"])
    assert sinks.written(spark, out).count() == 4
    c = str(tmp_path / "counts")
    for n, q in ((955, "Acme"), (12, " acme "), (3, "b")):
        sinks.append_first(spark.createDataFrame([(q, n)], "query string, n_results long"), c, "query", ["n_results"])
    assert sorted(tuple(r) for r in sinks.written(spark, c, "records").select("query", "n_results").collect()) == [("Acme", 955), ("b", 3)]
    names = spark.createDataFrame([("ACME",), (" acme",), ("zz",)], "name string")
    assert [r.name for r in sinks.counted(spark, c, names).collect()] == ["ACME"]
    text = sinks.row_lines(rows_of(spark, [("Q", 'b"\'', "1", "I", None)]), F.lit("2024-05-06 07:08:09").cast("timestamp")).first().value
    assert text.split("\t") == ["2024-05-06 07:08:09", "Q", "b\"'", "", "", "", "", "1", "", "", "I", "", "-1"]
    sinks.export_rows(rows_of(spark, [("Q", "b", "1", "I", 5)]), F.lit("2024-05-06 07:08:09").cast("timestamp"), str(tmp_path / "tsv"))
    assert lists.output_rows(spark, str(tmp_path / "tsv")).select("brand", "record_id", "number").collect() == [("b", "I", 5)]
    a = str(tmp_path / "archive")
    page = lambda *r: spark.createDataFrame(r, "query string, page int, body string")
    sinks.archive(page(("acme corp", 1, "x"), ("acme corp", 2, "y")), a)
    sinks.archive(page(("Acme Corp", 2, "z")), a)
    assert sorted((r.page, r.body, r.file) for r in sinks.written(spark, a, "pages").collect()) == [(1, "x", "acme corp_p1.raw"), (2, "z", "acme corp_p2.raw")]
    state = str(tmp_path / "state")
    ckpt = spark.createDataFrame([("a", 0, 4, 400), ("a", 1, 5, None), ("b", 0, 1, 1)], "query string, shard int, page int, rows long")
    keys = ["query", "shard"]
    sinks.replace(ckpt, state, keys)
    first = sinks.written(spark, state, "state")
    sinks.replace(sinks.without_checkpoints(first, spark.createDataFrame([("a",)], "query string")), state, keys, seen=1)
    assert [r["query"] for r in sinks.written(spark, state, "state").collect()] == ["b"] and first.count() == 3
    with pytest.raises(ledger.Conflict):
        sinks.replace(first, state, keys, seen=1)


def test_config(tmp_path):
    p = put(tmp_path / "c.toml", 'threads = 7\nrows_per_page = 30\nsave_grid = true\ninput = "in.txt"\nunknown = 1\n')
    c = config.loaded(p, ["--threads", "0", "--save-grid=false", "--timeout-scale-max", "2.5"])
    assert (c.threads, c.rows_per_page, c.save_grid, c.input, c.timeout_scale_max) == (0, 30, False, "in.txt", 2.5)
    with pytest.raises(ValueError, match="threads must be >= 1"):
        c.validate()
    config.loaded(str(tmp_path / "none.toml")).validate()
    put(tmp_path / "d.toml", config.Config(threads=9, input='a"b').toml())
    assert config.loaded(str(tmp_path / "d.toml")).threads == 9 and config.loaded(str(tmp_path / "d.toml")).input == 'a"b'
    for change, text in (({"rows_per_page": 50}, "rows_per_page"), ({"start_page": 5, "end_page": 4}, "before"), ({"timeout_scale_max": 0.5}, "below"), ({"mode": "x"}, "mode"), ({"input": ""}, "input"), ({"nav_timeout_ms": 10}, "nav_timeout_ms")):
        with pytest.raises(ValueError, match=text):
            config.Config(**change).validate()
    assert config.Config().watchdog() == 750_000 and config.Config(watchdog_ms=5).watchdog() == 5


def test_older_index(spark, tmp_path):
    magic = b"INDEXv2\n"
    assert index.fnv1a(b"") == 0xCBF29CE484222325 and index.fnv1a(b"a") == 0xAF63DC4C8601EC8C
    out = put(tmp_path / "out.tsv", "\n".join([line("Q", "new"), line("q", "new"), line("done", "x"), line("r", "y")]))
    done = spark.createDataFrame([("done",)], "name string")
    fresh = index.rebuilt(spark, out, done)
    want = {(q, int.from_bytes(index.fnv1a(f"{q}\0id:ID".encode()).to_bytes(8, "little"), "little", signed=True)) for q in ("q", "r")}
    assert {tuple(r) for r in fresh.collect()} == want
    whole = magic + index.packed("q", [1, -2]) + index.packed("done", [3]) + index.packed("q", [1, 4])
    p = put(tmp_path / "idx", whole + index.packed("torn", [5, 6])[:-3])
    assert {tuple(r) for r in index.imported(spark, p, magic).collect()} == {("q", 1), ("q", -2), ("q", 4), ("done", 3)}
    assert {tuple(r) for r in index.loaded(spark, p, out, magic, done).collect()} == {("q", 1), ("q", -2), ("q", 4)}
    for other in (put(tmp_path / "flat", b"x"), str(tmp_path / "missing")):
        assert {tuple(r) for r in index.loaded(spark, other, out, magic, done).collect()} == want


def test_positions_over_files_and_splits(spark, tmp_path):
    """A list of several files, read in splits of a few bytes: every line has the position that it has in the whole."""
    texts = ["\ufeffone\r\n\r\n# note\n  two  \n" + "\n".join(f"x{i}" for i in range(60)) + "\n", "three\nONE", "\n\nlast\n"]
    for i, t in enumerate(texts):
        (tmp_path / "list").mkdir(exist_ok=True)
        (tmp_path / "list" / f"part-{i}.txt").write_bytes(t.encode())
    want = [line.rstrip("\r") for t in texts for line in t.removeprefix("\ufeff").removesuffix("\n").split("\n")]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16")
    try:
        found = lists.raw_lines(spark, str(tmp_path / "list"))
        assert spark.read.text(str(tmp_path / "list")).select(F.spark_partition_id()).distinct().count() > 3
        assert [r.line for r in found.orderBy("pos").collect()] == want and sorted(r.pos for r in found.collect()) == list(range(len(want)))
        assert [r.line for r in lists.lines(spark, str(tmp_path / "list")).orderBy("pos").collect()] == ["one", "two", *[f"x{i}" for i in range(60)], "three", "ONE", "last"]
        assert lists.store(spark, str(tmp_path / "list")).filter("name = 'one'").first().stored == "one"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_snapshot_sees_what_is_shown():
    cell = f'<tr id="1"><td aria-describedby="{pages.ARIA}BRAND">b</td></tr>'
    own = f'<div class="x pagerPos">1 - 2&nbsp;/ <i>955</i></div><table><tbody>{cell}</tbody></table>'
    hidden = own.replace("955", "7").replace(">b<", ">h<")
    title, text, rows, line = pages.snapshot(f"<head><title> T &amp; U</title><script>1 - 2 / 3</script></head><body><style>p</style>{own}<p>a<br/>b</p>", "pagerPos")
    assert (title, rows, line) == ("T & U", 1, "1 - 2 / 955") and text.split() == ["1", "-", "2", "/", "955", "b", "a", "b"]
    # The panes of other ways to search are not shown, wherever they stand.
    for pane in (f'<div style="display:none">{hidden}</div>', f"<div hidden>{hidden}</div>", f"<template>{hidden}</template>"):
        assert pages.snapshot(pane + own, "pagerPos")[2:] == (1, "1 - 2 / 955") == pages.snapshot(own + pane, "pagerPos")[2:]
        assert pages.snapshot(pane, "pagerPos")[2:] == (0, "")
    assert pages.snapshot("<script>1 - 2 / 3</script>", "pagerPos") == ("", "", 0, "") == pages.snapshot(None, "pagerPos")
    assert pages.snapshot("<div class=pagerPos>1 - 1 / 1<p>torn", "pagerPos")[3] == "1 - 1 / 1torn" and pages.snapshot("</div></b>x", "pagerPos")[1].split() == ["x"]


def test_hashes_of_many(spark):
    texts = [b"", b"a", b"foobar", "é€".encode() * 9, b"\x00", b"a" * 300]
    assert index.fnv1a_of(texts).tolist() == [index.fnv1a(t) for t in texts] and index.fnv1a_of([]).tolist() == []
    frame = spark.createDataFrame([("q", "k"), (None, "k"), ("q", None), ("", "")], "q string, k string")
    signed = lambda t: int.from_bytes(index.fnv1a(t).to_bytes(8, "little"), "little", signed=True)
    assert [r.h for r in frame.select(index.hashed(F.col("q"), F.col("k")).alias("h")).collect()] == [signed(b"q\x00k"), None, None, signed(b"\x00")]


def test_page_faults(spark):
    from tidemill.functions import markers

    kinds = spark.createDataFrame([("block",), ("results",), ("unknown",), (None,)], "kind string")
    got = kinds.select(markers.faulty(F.col("kind")).alias("f"), markers.terminal(F.col("kind")).alias("t"), markers.page_fault(F.col("kind"), F.lit("m"), F.lit("some  text"), "open").alias("e")).collect()
    assert [(r.f, r.t) for r in got] == [(True, False), (False, True), (False, False), (False, False)]
    assert tuple(got[0].e) == ("block", "m", "open", "some text") and [r.e for r in got[1:]] == [None] * 3


def test_entities_without_semicolon(spark):
    markup = '<title>cut &amp</title>A &amp; B &copy 2 &lt;<script>a && "&lt" < b</script>&'
    seen = spark.createDataFrame([(markup,), (None,)], "t string").select(pages.text_content(F.col("t"), bare=False).alias("a"), pages.text_content(F.col("t")).alias("b")).collect()
    assert tuple(seen[0]) == ('cut &ampA & B &copy 2 <a && "&lt" < b&', 'cut &A & B © 2 <a && "&lt" < b&') and tuple(seen[1]) == (None, None)
