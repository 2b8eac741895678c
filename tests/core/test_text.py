import pytest
from pyspark.sql import functions as F

from tidemill.functions import markers, status
from tidemill.functions import text as X
from tidemill.functions.codec import compress, compressed, decompress, decompressed, form, request_state


def values(spark, cases, f):
    rows = spark.createDataFrame(list(enumerate(cases)), "i int, v string")
    return [r[1] for r in sorted(rows.select("i", f(F.col("v")).alias("o")).collect())]


@pytest.mark.parametrize(
    ("f", "cases"),
    [
        (X.strip_html, {'GRAND"MÈRE': "GRAND'MÈRE", "<b>BOLD</b> MARK": "BOLD MARK", "<b></b>": "", "&nbsp;": "", "&#160;": "", "&nbsp;<i>x</i>": "&nbsp;x", '<i title="a>b">quoted</i>': "quoted", "<i>unclosed": "unclosed", "a < b": "a < b", None: None}),
        (X.collapse, {" a  b\t\r\nc\x85 ": "a b c", "": "", "​x": "​x"}),
        (X.normalise, {"﻿ a​b ": "a b"}),
        (X.utf16_length, {"": 0, "abc": 3, "€€": 2, "a😀b": 4}),
        (lambda c: X.clip(c, 5), {"21.052.01": "21.05", "21": "21", "aaaa😀b": "aaaa", "aa😀bcd": "aa😀b", "": ""}),
        (lambda c: X.clip(c, 0), {"abc": ""}),
        (lambda c: X.clip(c, 2), {"€€€": "€€", "a😀b": "a"}),
        (X.date_only, {"2020-01-02T00:00:00Z": "2020-01-02", "2020-01-02": "", "1000-01-01T00:00:00Z": "", "3000-01-01T": "", "": ""}),
        (X.sanitise, {"ACME Corp": "acme corp", "example.com": "example-com", "R_014/PEARLY": "r-014-pearly", "0-14": "0-14", "": "query", "###": "query", "*": "star", "?": "qmark", "a*?": "a-star-qmark", "a**": "a-star-star", "*the*": "star-the-star", "z" * 80: "z" * 60, "é" * 40: "é" * 30}),
        (lambda c: X.snippet(c, 12), {"1 - 100 / 1,528": "1 - 100 /...", "short": "short"}),
        (X.action_seconds, {"sleep1": 1, "sleep45": 45, "sleep3600": 3600, "sleep+5": 5, "sleep0": None, "sleep3601": None, "sleep": None, "sleep-5": None, "skip": None}),
        (X.query_key, {"  ACME ": "acme"}),
        (X.store_key, {" ACME \tx\ty": "acme", "b": "b"}),
        (lambda c: X.truncated(c, 3), {"abcd": "abc…", "abc": "abc"}),
    ],
)
def test_scalars(spark, f, cases):
    assert values(spark, list(cases), f) == list(cases.values())


def test_pager(spark):
    cases = {
        "1 - 100 / 955": (1, 100, 955, False), "1 - 100 / 1,813": (1, 100, 1813, False), "1,528,669 - 1,528,768 / 1,528,768": (1528669, 1528768, 1528768, True),
        "1 - 100 / 1 528 768": (1, 100, 1528768, False), "956 - 955 / 955": (956, 955, 955, True), "1-7/7": (1, 7, 7, True), "1 – 30 / 30": (1, 30, 30, True),
        "1 - 100 / 12,34": None, "1 - 100 / 50": None, "no results": None, "": None, "1 - 100 / 1000": (1, 100, 1000, False),
    }
    assert [r and tuple(r) for r in values(spark, list(cases), X.pager)] == list(cases.values())


def test_status(spark):
    keys = {"DEL_REN2": "ROM_INA_REN2", "act": "ROM_ACT", "": "", "PEND_A": "PEND_A", "DEL_DEL": "ROM_INA_INA"}
    assert values(spark, list(keys), status.status_key) == list(keys.values())
    labels = {"DEL_REN2": "Inactive: expired", "ACT": "Active", "PEND_A": "Pending application: abandoned", "": "STATUS_", "X": "STATUS_X"}
    assert values(spark, list(labels), lambda c: status.status_label(c, F.lit(False))) == list(labels.values())
    assert values(spark, ["PEND"], lambda c: status.status_label(c, F.lit(True))) == ["Pending Subsequent Designation"]


SITE = markers.Site(("International Number", "Mark name", "Site reference", "Keep up to date"), ("records monitor", "office"), ("office.example",), "records/monitor", "no records match")


def kinds(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, url string, title string, text string, grid_rows int, pager string")
    return [tuple(r.k) for r in df.orderBy("i").select(markers.classify(*[F.col(c) for c in ("url", "title", "text", "grid_rows", "pager")], SITE).alias("k")).collect()]


def test_classify(spark):
    own = "https://www.office.example/records/monitor/en/"
    rows = [
        (own, "", "International Number and Mark  name", 0, ""), (own, "", "x", 100, "1 - 100 / 955"), (own, "", "No records match that", 0, ""), ("", "", "Please verify you are human", 0, ""),
        ("", "", "502 Bad Gateway", 0, ""), ("", "407 Proxy Authentication Required", "x", 0, ""), ("", "", "The site is under maintenance", 0, ""), ("", "", "An error occurred  processing your request", 100, "1 - 100 / 955"),
        ("", "", "", 0, ""), (own, "", "Mark name", 0, ""), ("https://office.example.evil/records/monitor", "Records Monitor", "x", 0, ""), (own, "Records Monitor", "x", 0, ""),
        (own, "Records Monitor", "x", 5, "page one"), (own, "", "captcha, and no records match", 0, ""), (None, None, None, 0, None),
    ]
    got = kinds(spark, rows)
    assert [k for k, _ in got] == ["monitor", "results", "no results", "block", "proxy error", "proxy error", "maintenance", "application error", "unknown", "unknown", "unknown", "monitor", "monitor", "block", "unknown"]
    assert got[0][1] == "International Number" and got[1][1] == '100 rows, pager "1 - 100 / 955"' and got[5][1].startswith("title: ") and got[11][1] == "title and url"


def test_grading_and_errors(spark):
    cases = [(403, "{}"), (403, ""), (502, "x"), (200, '﻿ {"brand": "403 FORBIDDEN"}'), (200, "<h1>403 Forbidden</h1>"), (200, "<p>403 and, far away, forbidden</p>"), (200, "an error occurred processing your request"), (200, "<p>")]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, s int, b string").orderBy("i")
    assert [r[0] for r in df.select(markers.graded(F.col("s"), F.col("b"))).collect()] == ["blocked", "blocked", "http_error", "ok", "blocked", "not_json", "app_error", "not_json"]
    assert values(spark, ["page did not load", "net::ERR_TIMED_OUT", "boom", None], markers.timed_out) == [True, True, False, False]
    assert values(spark, ["unexpected EOF", "TLS handshake", "boom"], markers.hiccup) == [True, True, False]


def test_urls(spark):
    assert values(spark, ["https://A.office.example./records/monitor", "https://office.example/other", "::bad", None], lambda c: X.from_site(c, SITE.domains, SITE.path)) == [True, False, False, False]
    assert values(spark, ["https://ads.example/x", "https://ok.example/pixel.gif", "https://ok.example/x"], lambda c: X.resource_blocked(F.lit("script"), c, ["font"], ["ads."], ["pixel"])) == [True, True, False]


def test_row_key(spark):
    row = spark.range(1)
    key = lambda *v: row.select(X.row_key(*[F.lit(x) for x in v])).first()[0]
    assert key("b", "h", "r", "d", 1, "ID") == "id:ID"
    assert key("b", "h", "r", "d", None, "") == "c:b\x1fh\x1fr\x1fd\x1f-1" and key("b", "h", "r", "d", 1, None) != key("b", "h", "r", "d", 2, None)
    assert row.select(X.row_hash(F.lit("ab"), F.lit("12")) != X.row_hash(F.lit("a"), F.lit("b12"))).first()[0]


def test_codec(spark):
    texts = ["", "a", "the same " * 60, "café ☕ 日本", "a😀b" * 30, '{"la":"en"}'] + ["".join(chr(97 + (i * k) % 26) for i in range(200)) for k in range(1, 9)]
    assert [decompress(compress(t)) for t in texts] == texts
    assert decompress("abc") is None and decompress("AAAA") in ("", None) and decompress("N4I\ngDi\nA=") == decompress("N4IgDiA=")
    assert values(spark, texts, lambda c: decompressed(compressed(c))) == texts
    state = spark.range(1).select(request_state(F.lit("té"), F.lit(0), F.lit(100), "office").alias("s"), form(request_state(F.lit("té"), F.lit(100), F.lit(100), "office")).alias("f")).first()
    assert state.s.startswith('{"la":"en","p":{"facets":["DS","HOLC"],"search":{"raw":["té"]') and '"start"' not in state.s and state.s.endswith('"rows":100},"type":"office"}') and state.f.startswith("qz=N4Ig")
