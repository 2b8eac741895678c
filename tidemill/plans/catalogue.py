"""Queries over the given tables that put each operator to work, and SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import codec, markers, status
from ..functions import text as X
from ..functions.messages import MESSAGES
from ..operators import dedupe, ordered, rules, tasks, telemetry, verdict
from ..sources import pages as P

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_SPACES = r"[\s\x0B\x{0085}\p{Z}]"


def query(sql: str | None):
    """Registers a query under its function's name, with the SQL that must agree with it."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _collapse(c: str) -> str:
    return f"trim(regexp_replace({c}, '{_SPACES}+', ' ', 'g'))"


def _strip(c: str) -> str:
    bare = f"""regexp_replace({c}, '<("[^"]*"|''[^'']*''|[^''">])*>', '', 'g')"""
    return f"CASE WHEN {bare} IN ('&nbsp;', '&#160;') THEN '' ELSE replace({bare}, '\"', '''') END"


def _key(c: str) -> str:
    return f"lower(regexp_replace({c}, '^{_SPACES}+|{_SPACES}+$', '', 'g'))"


# Text rules


@query(f"SELECT page_id, md5({_collapse(_strip('html'))}) AS cell_md5, CAST(length({_collapse(_strip('html'))}) AS BIGINT) AS cell_chars FROM pages")
def q01_html_strip(spark, d):
    shown = table(spark, d, "pages").select("page_id", X.cell(F.col("html")).alias("cell"))
    return shown.select("page_id", F.md5("cell").alias("cell_md5"), F.length("cell").cast("long").alias("cell_chars"))


@query(f"SELECT lang, count(DISTINCT md5({_key('text')})) AS keys, count(*) AS n FROM documents GROUP BY lang")
def q02_normalise_key(spark, d):
    keyed = table(spark, d, "documents").select("lang", F.md5(X.query_key(F.col("text"))).alias("k"))
    return keyed.groupBy("lang").agg(F.count_distinct("k").alias("keys"), F.count("*").alias("n"))


@query("""
    WITH t AS (SELECT o_orderkey, o_orderkey * 977 + 1 AS total FROM orders)
    SELECT o_orderkey, CAST(1 AS BIGINT) AS "from", least(100, total) AS "to", total, least(100, total) >= total AS last FROM t WHERE o_orderkey % 5 <> 0""")
def q03_pager(spark, d):
    total = F.col("o_orderkey") * 977 + 1
    # One in five lines is no position: its last page would end past the total.
    shown = F.when(F.col("o_orderkey") % 5 == 0, F.format_string("1 - %d / %d", total + 1, total)).otherwise(F.concat(F.lit("1 - "), F.least(F.lit(100), total).cast("string"), F.lit(" / "), F.format_number(total, 0)))
    read = table(spark, d, "orders").select("o_orderkey", X.pager(shown).alias("p"))
    return read.filter("p IS NOT NULL").select("o_orderkey", "p.from", "p.to", "p.total", "p.last")


@query("""
    WITH c AS (SELECT p_brand, left(p_type, 5) AS code, min(p_partkey) AS first FROM part GROUP BY ALL)
    SELECT p_brand, string_agg(code, ', ' ORDER BY first) AS codes FROM c GROUP BY p_brand""")
def q04_clip_codes(spark, d):
    codes = table(spark, d, "part").select("p_brand", "p_partkey", X.clip(F.col("p_type"), 5).alias("code"))
    first = dedupe.first_of(codes, ["p_brand", "code"], ["p_partkey"])
    lists = first.groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("p_partkey", "code"))).alias("c"))
    return lists.select("p_brand", X.unique_join(F.col("c.code")).alias("codes"))


@query("""
    WITH c AS (SELECT user_id, event_type, min(event_id) AS first FROM events GROUP BY ALL)
    SELECT user_id, string_agg(event_type, ', ' ORDER BY first) AS types FROM c GROUP BY user_id""")
def q05_unique_join(spark, d):
    # The first of each type is found by partial aggregation, so a user's whole history is never in one row.
    first = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("first"))
    lists = first.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("first", "event_type"))).alias("c"))
    return lists.select("user_id", X.unique_join(F.col("c.event_type")).alias("types"))


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 7 IN (0, 1) THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS reg_date FROM orders""")
def q06_date_only(spark, d):
    iso = F.when(F.col("o_orderkey") % 7 == 0, "3000-01-01T00:00:00Z").when(F.col("o_orderkey") % 7 == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return table(spark, d, "orders").select("o_orderkey", X.date_only(iso).alias("reg_date"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k_text, CAST(1 AS INTEGER) AS k_items, json_extract_string(props, '$.k') AS k_first FROM events")
def q07_flex_json(spark, d):
    v = F.try_variant_get(F.try_parse_json("props"), "$.k", "variant")
    return table(spark, d, "events").select("event_id", P.flex(v).alias("k_text"), F.size(P.flex_list(v)).alias("k_items"), F.try_element_at(P.flex_list(v), F.lit(1)).alias("k_first"))


@query("""
    WITH u AS (SELECT page_id, regexp_extract(lower(url), '^[a-z]+://([^/:?#]+)', 1) AS host, regexp_extract(lower(url), '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path FROM pages)
    SELECT page_id, (host = 'example.com' OR host LIKE '%.example.com') AND contains(path, '/en/') AS own FROM u""")
def q08_url_provenance(spark, d):
    return table(spark, d, "pages").select("page_id", X.from_site(F.col("url"), ("example.com",), "/en/").alias("own"))


@query(r"""
    WITH a AS (SELECT page_id, regexp_replace(regexp_replace(lower(regexp_replace(replace(replace(trim(url), '*', '-star-'), '?', '-qmark-'), '[^\p{L}\p{N} -]+', '-', 'g')), '-{2,}', '-', 'g'), '^-+|-+$', '', 'g') AS s FROM pages)
    SELECT page_id, CASE WHEN s = '' THEN 'query' WHEN length(s) > 60 THEN regexp_replace(left(s, 60), '^-+|-+$', '', 'g') ELSE s END || '_p' || CAST(page_id % 9 AS VARCHAR) || '.raw' AS file FROM a""")
def q09_archive_name(spark, d):
    return table(spark, d, "pages").select("page_id", X.archive_name(F.col("url"), F.col("page_id") % 9).alias("file"))


@query(r"""
    SELECT doc_id, CAST(length(text) + length(regexp_replace(text, '[^\x{10000}-\x{10FFFF}]', '', 'g')) AS INTEGER) AS units FROM documents""")
def q10_utf16_length(spark, d):
    return table(spark, d, "documents").select("doc_id", X.utf16_length(F.col("text")).alias("units"))


_RAW = ("ACT", "DEL_REN2", "PEND_A", "ina_exp", "", "ROM_OTHER", "PEND", "ACT_GRACE")


def _first_replaced(c: str) -> str:
    for old, new in (("DEL", "INA"), ("ACT", "ROM_ACT"), ("INA", "ROM_INA"), ("DEL", "INA")):
        c = f"regexp_replace({c}, '{old}', '{new}')"
    return c


@query(f"""
    WITH r AS (SELECT event_id, user_id % 2 = 0 AS registered, CASE event_id % {len(_RAW)} {" ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(_RAW))} END AS raw FROM events),
         k AS (SELECT event_id, 'STATUS_' || replace({_first_replaced("upper(raw)")}, 'PEND', CASE WHEN registered THEN 'PEND_SD' ELSE 'PEND_APP' END) AS key FROM r),
         m(key, label) AS (VALUES {", ".join(f"({q(k)}, {q(v)})" for k, v in MESSAGES.items())})
    SELECT event_id, coalesce(label, k.key) AS label FROM k LEFT JOIN m ON k.key = m.key""")
def q11_status_label(spark, d):
    raw = F.get(F.array(*map(F.lit, _RAW)), (F.col("event_id") % len(_RAW)).cast("int"))
    return table(spark, d, "events").select("event_id", status.status_label(raw, F.col("user_id") % 2 == 0).alias("label"))


@query("""
    SELECT conv_id, coalesce(max_by(text, turn) FILTER (role = 'user'), '') AS last_user, coalesce(min_by(text, turn) FILTER (role = 'assistant'), '') AS first_assistant FROM conversations GROUP BY conv_id""")
def q12_pick(spark, d):
    pick = lambda role, last: dedupe.end_of("turn", "text", F.col("role") == role, last)
    return table(spark, d, "conversations").groupBy("conv_id").agg(pick("user", True).alias("last_user"), pick("assistant", False).alias("first_assistant"))


# Planning and repeats


@query(f"""
    WITH k AS (SELECT doc_id, md5({_key('text')}) AS name FROM documents WHERE {_key('text')} <> ''),
         f AS (SELECT name, min(doc_id) AS pos FROM k GROUP BY name)
    SELECT name, pos FROM f WHERE NOT EXISTS (SELECT 1 FROM k JOIN labels USING (doc_id) WHERE k.name = f.name)""")
def q13_task_build(spark, d):
    keyed = table(spark, d, "documents").select("doc_id", X.query_key(F.col("text")).alias("k")).filter("k <> ''").select("doc_id", F.md5("k").alias("name"))
    done = keyed.join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_semi").select("name")
    return tasks.build(keyed.select(F.col("name").alias("line"), F.col("doc_id").alias("pos")), done)


@query("SELECT doc_id, lang FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def q14_done_semijoin(spark, d):
    return dedupe.membership(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"), "doc_id")


@query("SELECT md5(text) AS digest, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def q15_dedupe_first(spark, d):
    return dedupe.first_of(table(spark, d, "documents").select(F.md5("text").alias("digest"), "doc_id"), ["digest"], ["doc_id"])


@query("""
    SELECT md5(text) AS digest, min(doc_id) AS doc_id FROM documents WHERE doc_id % 2 = 0 AND text NOT IN (SELECT text FROM documents WHERE doc_id % 2 = 1) GROUP BY 1""")
def q16_dedupe_history(spark, d):
    rows = table(spark, d, "documents").select(F.md5("text").alias("digest"), "doc_id")
    return dedupe.new_rows(rows.filter("doc_id % 2 = 0"), rows.filter("doc_id % 2 = 1"), ["digest"], ["doc_id"])


@query("""
    SELECT DISTINCT user_id, event_type FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 250)""")
def q17_compaction(spark, d):
    events = table(spark, d, "events")
    return dedupe.open_keys(events.select("user_id", "event_type"), events.filter("event_type = 'purchase' AND value > 250"), "user_id")


@query("""
    WITH c AS (SELECT o_custkey, CAST(round(sum(o_totalprice)) AS BIGINT) AS n FROM orders GROUP BY 1),
         p AS (SELECT o_custkey, s.shard, CAST(ceil(n / 100.0) AS BIGINT) AS pages, CAST(ceil(ceil(n / 100.0) / 7.0) AS BIGINT) AS per FROM c, (SELECT unnest(range(7)) AS shard) s WHERE n > 0)
    SELECT o_custkey, CAST(shard AS INTEGER) AS shard, CAST(shard * per + 1 AS BIGINT) AS "from", least(shard * per + per, pages) AS "to" FROM p WHERE shard * per + 1 <= pages""")
def q18_shard_blocks(spark, d):
    # Sums of doubles depend on their order, and one that ends near a half rounds either way: decimals are exact.
    sizes = table(spark, d, "orders").groupBy("o_custkey").agg(F.round(F.sum(F.col("o_totalprice").cast("decimal(28,6)"))).cast("long").alias("n"))
    shards = tasks.sharded(sizes, 7)
    cut = shards.select("o_custkey", "shard", tasks.block(F.col("n"), F.lit(100), F.lit(7), F.col("shard")).alias("b"))
    return cut.filter("b IS NOT NULL").select("o_custkey", "shard", "b.from", "b.to")


@query("""
    WITH p AS (SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS page FROM orders),
         r AS (SELECT o_custkey, page, row_number() OVER w AS n, count(*) OVER (PARTITION BY o_custkey) AS total FROM p WHERE page > o_custkey % 4 WINDOW w AS (PARTITION BY o_custkey ORDER BY page))
    SELECT o_custkey, CAST(page AS BIGINT) AS page, total > 5 AS partial FROM r WHERE n <= 5""")
def q19_resume_limit(spark, d):
    orders = table(spark, d, "orders")
    walk = orders.select("o_custkey", F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).cast("long").alias("page"))
    at = orders.select("o_custkey").distinct().select("o_custkey", (F.col("o_custkey") % 4).alias("page"))
    return tasks.limited(tasks.resumed(walk, at, ["o_custkey"]), ["o_custkey"], 5)


@query("""
    WITH p AS (SELECT l_orderkey, CAST(ceil(l_linenumber / 3.0) AS BIGINT) AS page, count(*) AS n_rows FROM lineitem WHERE l_quantity > 5 GROUP BY ALL),
         l AS (SELECT *, max(page) OVER (PARTITION BY l_orderkey) AS last FROM p)
    SELECT l_orderkey, page, n_rows, 'short' AS violation FROM l WHERE n_rows <> 3 AND page < last""")
def q20_page_contract(spark, d):
    # Lines of five pieces or fewer are lost, so some pages are short.
    pages = table(spark, d, "lineitem").filter("l_quantity > 5").groupBy("l_orderkey", F.ceil(F.col("l_linenumber") / 3).alias("page")).agg(F.count("*").alias("n_rows"))
    seen = pages.withColumn("last", F.max("page").over(Window.partitionBy("l_orderkey")))
    wrong = verdict.page_violation(F.col("page"), (F.col("page") - 1) * 3, F.col("n_rows"), F.col("last"), 3)
    return seen.select("l_orderkey", "page", "n_rows", wrong.alias("violation")).filter("violation IS NOT NULL")


@query("""
    WITH w AS (SELECT o_orderkey, o_orderkey % 9 AS declared, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS written FROM orders)
    SELECT o_orderkey, declared, written, CASE WHEN declared - written >= 2 THEN declared - written END AS missing,
           CASE WHEN declared - written >= 2 AND o_orderkey % 10 <> 0 THEN 'short' ELSE 'collected' END AS outcome FROM w""")
def q21_completeness(spark, d):
    written = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("written"))
    seen = table(spark, d, "orders").select("o_orderkey", (F.col("o_orderkey") % 9).alias("declared")).join(written, "o_orderkey", "left").withColumn("written", F.coalesce("written", F.lit(0)))
    seen = seen.withColumn("missing", verdict.missing(F.col("declared"), F.col("written"), verdict.full_walk(F.lit(1), F.lit(0), F.lit(0), F.lit(0)), 2))
    return seen.withColumn("outcome", verdict.outcome(F.lit(False), F.lit(False), F.lit(True), F.col("missing"), F.col("o_orderkey") % 10 == 0))


@query("""
    SELECT o_custkey AS query, count(DISTINCT o_orderkey % 4) AS shards_done, max(CAST(floor(o_totalprice) AS BIGINT)) AS n_results, CAST(4 AS INTEGER) AS shard_count, count(DISTINCT o_orderkey % 4) >= 4 AS last FROM orders GROUP BY 1""")
def q22_shard_gate(spark, d):
    done = table(spark, d, "orders").select(F.col("o_custkey").alias("query"), (F.col("o_orderkey") % 4).alias("shard"), F.floor("o_totalprice").alias("n_results"), F.lit(4).alias("shard_count"))
    return verdict.gate(done)


_RULES = [(0, "skip", "idiot"), (1, "sleep30", "@"), (2, "pauseAll", "license"), (3, "skip", " ntoner "), (4, "sleep5", "que "), (5, "sleep7", "and ")]


@query(f"""
    WITH r(ord, action, marker) AS (VALUES {", ".join(f"({o}, {q(a)}, {q(m)})" for o, a, m in _RULES)})
    SELECT doc_id, arg_min(action, ord) AS action, CAST(min(ord) AS INTEGER) AS ord FROM documents JOIN r ON contains(text, marker) GROUP BY doc_id""")
def q23_rules_first(spark, d):
    hit = table(spark, d, "documents").select("doc_id", rules.matched(F.col("text"), _RULES).alias("r"))
    return hit.filter("r IS NOT NULL").select("doc_id", "r.action", "r.ord")


_SITE = markers.Site(control=("Home", "Contact", "Privacy", "About"), titles=("the",), domains=("example.com", "example.org"), path="/en/", no_results="buy now")


def _low(c: str) -> str:
    return r"lower(trim(regexp_replace(" + c + r", '[\s\x0B\x{0085}\p{Z}\x{200B}\x{FEFF}]+', ' ', 'g')))"


def _classify_sql() -> str:
    cases = []
    for kind, column, listed, lead in (("application error", "low", markers.APP_ERROR, ""), ("maintenance", "low", markers.MAINTENANCE, ""), ("proxy error", "low", markers.GATEWAY, ""), ("block", "low", markers.BLOCK, ""), ("proxy error", "head", markers.GATEWAY, "title: ")):
        cases += [f"WHEN contains({column}, {q(m)}) THEN [{q(kind)}, {q(lead + m)}]" for m in listed]
    cases.append(f"WHEN contains(low, {q(_SITE.no_results)}) THEN ['no results', {q(_SITE.no_results)}]")
    held = " + ".join(f"CAST(contains(low, {q(m.lower())}) AS INTEGER)" for m in _SITE.control)
    name = "CASE " + " ".join(f"WHEN contains(low, {q(m.lower())}) THEN {q(m)}" for m in _SITE.control) + " ELSE 'title and url' END"
    own = "(host IN ('example.com', 'example.org') OR host LIKE '%.example.com' OR host LIKE '%.example.org') AND contains(path, '/en/')"
    cases.append(f"WHEN {held} >= 2 OR (contains(head, 'the') AND {own}) THEN ['monitor', {name}]")
    return f"""
    WITH t AS (SELECT page_id, {_low("regexp_replace(html, '<[^>]*>', ' ', 'g')")} AS low, {_low("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")} AS head,
                      regexp_extract(lower(url), '^[a-z]+://([^/:?#]+)', 1) AS host, regexp_extract(lower(url), '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path FROM pages),
         c AS (SELECT page_id, CASE {" ".join(cases)} ELSE ['unknown', ''] END AS c FROM t)
    SELECT page_id, c[1] AS kind, c[2] AS marker FROM c"""


@query(_classify_sql())
def q24_classify(spark, d):
    shown = table(spark, d, "pages").select("page_id", "url", F.regexp_replace("html", "<[^>]*>", " ").alias("text"), F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1).alias("title"))
    kind = markers.classify(F.col("url"), F.col("title"), F.col("text"), F.lit(0), F.lit(""), _SITE)
    return shown.select("page_id", kind.alias("k")).select("page_id", "k.kind", "k.marker")


# Order-sensitive measures


@query("""
    WITH RECURSIVE n AS (SELECT source, doc_id, CAST(octet_length(encode(text)) AS BIGINT) AS size, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i FROM documents),
         f AS (SELECT source, doc_id, i, CAST(1 AS INTEGER) AS part, size AS held FROM n WHERE i = 1
               UNION ALL
               SELECT n.source, n.doc_id, n.i, CAST(CASE WHEN held >= 20000 THEN part + 1 ELSE part END AS INTEGER), CASE WHEN held >= 20000 THEN n.size ELSE held + n.size END FROM f JOIN n ON n.source = f.source AND n.i = f.i + 1)
    SELECT doc_id, part FROM f""")
def q25_rotation(spark, d):
    sizes = table(spark, d, "documents").select("source", "doc_id", F.octet_length("text").cast("long").alias("size"))
    return ordered.rotated(sizes, ["source"], ["doc_id"], F.col("size"), 20_000).select("doc_id", "part")


@query("""
    WITH v AS (SELECT user_id, list(CAST(value AS DOUBLE) ORDER BY ts, event_id) AS vals FROM events GROUP BY 1)
    SELECT user_id, round(list_reduce(vals, lambda a, v: CAST(0.3 AS DOUBLE) * v + (CAST(1.0 AS DOUBLE) - CAST(0.3 AS DOUBLE)) * a), 6) AS ewma FROM v""")
def q26_ewma(spark, d):
    found = ordered.moving_average(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.col("value"), telemetry.ALPHA)
    return found.select("user_id", F.round("ewma", 6).alias("ewma"))


@query("""
    WITH g AS (SELECT *, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS grp FROM events)
    SELECT event_id, sum(CASE event_type WHEN 'error' THEN 1.0::DOUBLE WHEN 'view' THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END) OVER (PARTITION BY user_id, grp ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS fails FROM g""")
def q27_fails_since_success(spark, d):
    weight = F.when(F.col("event_type") == "error", 1.0).when(F.col("event_type") == "view", 0.5).otherwise(0.0)
    return telemetry.fails_since_success(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "purchase", weight).select("event_id", "fails")


@query("""
    WITH r AS (SELECT user_id, event_type = 'error' AS bad, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - row_number() OVER (PARTITION BY user_id, event_type = 'error' ORDER BY ts, event_id) AS run FROM events),
         s AS (SELECT user_id, bad, run, count(*) AS n FROM r GROUP BY ALL)
    SELECT user_id, coalesce(max(n) FILTER (bad), 0) AS longest, coalesce(max(n) FILTER (bad), 0) >= 3 AS reached FROM s GROUP BY user_id""")
def q28_block_streak(spark, d):
    return telemetry.longest_streak(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "error", 3)


@query("""
    WITH g AS (SELECT event_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS gap_us FROM events)
    SELECT event_id, gap_us FROM g WHERE gap_us >= 43200000000""")
def q29_stall_gap(spark, d):
    return telemetry.stalls(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "ts", 43_200).select("event_id", "gap_us")


@query("""
    WITH RECURSIVE n AS (SELECT user_id, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
         f AS (SELECT user_id, i, t AS last, CAST(1 AS BIGINT) AS admitted FROM n WHERE i = 1
               UNION ALL
               SELECT n.user_id, n.i, CASE WHEN n.t - last >= 21600000000 THEN n.t ELSE last END, CASE WHEN n.t - last >= 21600000000 THEN admitted + 1 ELSE admitted END FROM f JOIN n ON n.user_id = f.user_id AND n.i = f.i + 1)
    SELECT user_id, max(admitted) AS admitted FROM f GROUP BY user_id""")
def q30_rate_gate(spark, d):
    let = ordered.admitted(table(spark, d, "events"), ["user_id"], ["event_id"], telemetry.micros("ts"), 21_600_000_000)
    return let.groupBy("user_id").agg(F.count("*").alias("admitted"))


@query("""
    WITH u AS (SELECT event_id, ts, max(CASE WHEN event_type = 'error' THEN ts END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS began FROM events)
    SELECT event_id FROM u WHERE ts < began + INTERVAL 900 SECOND""")
def q31_cooldown(spark, d):
    return telemetry.cooling(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "ts", F.col("event_type") == "error", 900).filter("cooling").select("event_id")


@query("""
    WITH e AS (SELECT user_id, ts, event_id, coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) > 86400000000, true) AS fresh FROM events WHERE event_type = 'error'),
         i AS (SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM e)
    SELECT user_id, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) + 86400000000 AS until_us, count(*) AS n_events FROM i GROUP BY user_id, island""")
def q32_freeze_islands(spark, d):
    found = telemetry.islands(table(spark, d, "events").filter("event_type = 'error'"), ["user_id"], ["ts", "event_id"], "ts", 86_400)
    return found.select("user_id", telemetry.micros("first").alias("first_us"), telemetry.micros("frozen_until").alias("until_us"), "n_events")


def _log(spark, d) -> DataFrame:
    kind = F.col("event_type")
    named = F.when(kind == "purchase", "ok").when(kind == "error", "fail").when(kind == "view", "soft_fail").when(kind == "signup", "attempt").otherwise("latency")
    return table(spark, d, "events").select(F.col("user_id").cast("string").alias("endpoint"), "ts", F.col("event_id").alias("id"), named.alias("kind"), F.floor(F.col("value") * 100).alias("ms"))


_SUMMARY = """
    WITH e AS (SELECT CAST(user_id AS VARCHAR) AS endpoint, *, CAST(floor(value * 100) AS BIGINT) AS ms FROM events),
         g AS (SELECT *, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY endpoint ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS grp FROM e),
         f AS (SELECT *, sum(CASE event_type WHEN 'error' THEN 1.0::DOUBLE WHEN 'view' THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END) OVER (PARTITION BY endpoint, grp ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS w FROM g),
         l AS (SELECT endpoint, list_reduce(list(CAST(ms AS DOUBLE) ORDER BY ts, event_id), lambda a, v: CAST(0.3 AS DOUBLE) * v + (CAST(1.0 AS DOUBLE) - CAST(0.3 AS DOUBLE)) * a) AS lat FROM e WHERE event_type = 'click' AND ms > 0 GROUP BY 1),
         s AS (SELECT endpoint, count(*) FILTER (event_type = 'purchase') AS oks, count(*) FILTER (event_type IN ('error', 'view')) AS failures, CAST(0 AS BIGINT) AS cooldowns, count(*) FILTER (event_type = 'signup') AS attempts,
                      avg(CASE WHEN event_type = 'signup' THEN ms END) AS mean, arg_max(w, {'a': ts, 'b': event_id}) AS fails FROM f GROUP BY 1)
"""
_SPEED = "CASE WHEN lat IS NULL OR lat <= 0 THEN 'unmeasured' WHEN lat > 2 * 3000 THEN 'SLOW' WHEN lat < 1500 THEN 'fast' ELSE '' END"


@query(_SUMMARY + f"SELECT endpoint, oks, failures, cooldowns, attempts, round(mean, 4) AS mean_attempt_ms, fails, round(lat, 4) AS latency_ms, {_SPEED} AS speed FROM s LEFT JOIN l USING (endpoint)")
def q33_endpoint_summary(spark, d):
    found = telemetry.summary(_log(spark, d), telemetry.Options())
    return found.withColumns({"mean_attempt_ms": F.round("mean_attempt_ms", 4), "latency_ms": F.round("latency_ms", 4)})


@query(_SUMMARY + """
    SELECT endpoint, round((CASE WHEN lat > 6000 THEN 0.5 ELSE 1.0 END)::DOUBLE / (1 + fails), 6) AS weight, round(120000 * CASE WHEN lat > 0 THEN least(greatest(lat / 3000, 1.0::DOUBLE), 4.0::DOUBLE) ELSE 1.0 END, 3) AS timeout_ms FROM s LEFT JOIN l USING (endpoint) WHERE fails < 5""")
def q34_pick_weight(spark, d):
    # Limits that make no sense fall back to the defaults.
    o = telemetry.Options(fail_budget=0, cooldown_ms=-1, latency_ref_ms=0, scale_min=-1, scale_max=4).normalised()
    left = telemetry.usable(telemetry.summary(_log(spark, d), o).withColumn("until", F.lit(None).cast("timestamp")), F.lit("2024-02-01").cast("timestamp"), o)
    weight = telemetry.pick_weight(F.col("latency_ms"), F.col("fails"), o.latency_ref_ms)
    return left.select("endpoint", F.round(weight, 6).alias("weight"), F.round(telemetry.scaled_timeout(F.lit(120_000.0), F.col("latency_ms"), o), 3).alias("timeout_ms"))


@query("SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS joined FROM conversations GROUP BY conv_id")
def q35_ordered_merge(spark, d):
    return tasks.assembled(table(spark, d, "conversations"), ["conv_id"], "turn", F.concat("role", F.lit(": "), "text"))


@query("SELECT item_id, text AS back, true AS same FROM benchmark")
def q36_codec_round_trip(spark, d):
    packed = table(spark, d, "benchmark").select("item_id", "text", codec.compressed(F.col("text")).alias("packed"))
    return packed.select("item_id", codec.decompressed(F.col("packed")).alias("back"), (codec.decompressed(F.col("packed")) == F.col("text")).alias("same"))


@query("SELECT DISTINCT l_orderkey, l_partkey, l_suppkey FROM lineitem")
def q37_union_parts(spark, d):
    rows = table(spark, d, "lineitem")
    parts = [rows.filter(F.coalesce(F.month("l_shipdate"), F.lit(0)) % 3 == i) for i in range(3)]
    keys = parts[0].unionByName(parts[1]).unionByName(parts[2]).select("l_orderkey", "l_partkey", "l_suppkey")
    return keys.distinct()


@query("SELECT DISTINCT user_id, event_type FROM events")
def q38_stream_dedupe(spark, d):
    import uuid

    from ..sources.shared import shared_dir
    from ..streaming import walks

    at = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex[:8]}"
    events = walks.in_batches(table(spark, d, "events").select("event_id", "user_id", "event_type"), F.col("event_id"), f"{at}/events", 3)
    stream = walks.unique(events.select("user_id", "event_type"), ["user_id", "event_type"])
    stream.writeStream.format("parquet").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start(f"{at}/rows").awaitTermination()
    return spark.read.parquet(f"{at}/rows")


# Captured pages



@query("""
    SELECT n_name AS query, CASE WHEN c_custkey % 4 = 0 THEN 'No Verbal Elements' ELSE 'Mark ''' || c_name || ''' ' || c_mktsegment END AS brand,
           CASE WHEN c_custkey % 3 = 0 THEN 'first+1' ELSE 'only ' || c_name END AS holder, 'Active' AS status, 'CH' AS origin, '2015-03-20' AS reg_date,
           CAST(c_custkey AS VARCHAR) AS reg_number, '9, 35' AS nice, '21.05' AS vienna, 'ROM.' || c_custkey AS record_id, 'ACT' AS record_status,
           CAST(100 + row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS INTEGER) AS number, count(*) OVER (PARTITION BY c_nationkey) AS num_found
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def q39_json_pages(spark, d):
    """Pages are made of customers, one a nation, with values of many shapes; then they are decoded."""
    c = table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    lit = lambda *v: F.array(*[x if not isinstance(x, str) else F.lit(x) for x in v])
    third, fourth = F.col("c_custkey") % 3 == 0, F.col("c_custkey") % 4 == 0
    brand = F.concat(F.lit('<em>Mark</em> "'), "c_name", F.lit('"  '), "c_mktsegment")
    doc = F.struct(
        F.concat(F.lit("ROM."), "c_custkey").alias("ID"), F.lit("ACT").alias("STATUS"), F.lit("CH").alias("OO"), F.lit("2015-03-20T00:00:00Z").alias("RD"),
        F.col("c_custkey").alias("IRN"), lit(F.lit(9), F.lit(35), F.lit(9)).alias("NC"), lit("21.052.01", "21.05.9").alias("VCS"),
        F.when(~fourth, lit("older", brand)).alias("BRAND"), F.when(third, lit("first", "second")).otherwise(lit(F.concat(F.lit("only "), "c_name"))).alias("HOL"),
    )
    made = c.groupBy("n_name").agg(F.array_sort(F.collect_list(F.struct("c_custkey", doc.alias("doc")))).alias("s"))
    body = F.to_json(F.struct(F.struct(F.size("s").alias("numFound"), F.lit(100).alias("start"), F.col("s.doc").alias("docs")).alias("response"), F.create_map(F.lit("none"), F.create_map(F.lit("HOL"), F.array(F.lit("x")))).alias("highlighting")))
    return P.page_rows(P.decode(made.select(F.col("n_name").alias("query"), body.alias("body"))), "query")


@query("""
    SELECT n_name AS query, 'Mark ' || c_name AS brand, CASE WHEN c_custkey % 2 = 0 THEN 'Holder of ' || c_mktsegment ELSE '' END AS holder, '' AS status, '' AS origin, '' AS reg_date, '' AS reg_number, '' AS nice, '' AS vienna,
           'ROM.' || c_custkey AS record_id, '' AS record_status, CAST(CASE WHEN c_custkey % 5 = 0 THEN -1 ELSE c_custkey END AS INTEGER) AS number
    FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 7 <> 0""")
def q40_html_grid(spark, d):
    c = table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    td = lambda column, title, text: F.concat(F.lit(f'<td aria-describedby="{P.ARIA}{column}" title="'), title, F.lit('">'), text, F.lit("</td>"))
    none = F.lit("")
    brand = F.when(F.col("c_custkey") % 7 == 0, td("BRAND", none, F.lit("&nbsp;"))).otherwise(td("BRAND", F.concat(F.lit("Mark  "), "c_name"), F.lit("<em>Ma</em>rk")))
    holder = F.when(F.col("c_custkey") % 2 == 0, td("HOL", none, F.concat(F.lit("Holder\n <b>of</b> "), "c_mktsegment"))).otherwise(none)
    number = F.when(F.col("c_custkey") % 5 == 0, td("result_number", none, F.lit("none"))).otherwise(td("result_number", F.col("c_custkey").cast("string"), none))
    tr = F.concat(F.lit('<tr id="'), "c_custkey", F.lit('">'), brand, holder, td("real_id", F.concat(F.lit("ROM."), "c_custkey"), none), number, F.lit("</tr>"))
    made = c.groupBy("n_name").agg(F.array_sort(F.collect_list(tr)).alias("r"))
    body = F.concat(F.lit('<tbody><tr class="sizing"><td></td></tr>'), F.array_join("r", "\n"), F.lit("</tbody>"))
    return P.grid_rows(made.select(F.col("n_name").alias("query"), body.alias("body")), "query")


@query("""
    WITH r AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN 403 WHEN 1 THEN 502 ELSE 200 END AS status, CASE event_id % 6 WHEN 2 THEN ' {"a": "403 forbidden"}' WHEN 3 THEN '<h1>403: Forbidden</h1>' WHEN 4 THEN 'An  error occurred processing your request' ELSE '<p>' || event_type END AS body FROM events)
    SELECT event_id, CASE status WHEN 403 THEN 'blocked' WHEN 502 THEN 'http_error' ELSE CASE event_id % 6 WHEN 2 THEN 'ok' WHEN 3 THEN 'blocked' WHEN 4 THEN 'app_error' ELSE 'not_json' END END AS grade FROM r""")
def q41_response_grade(spark, d):
    k = F.col("event_id") % 6
    body = F.when(k == 2, ' {"a": "403 forbidden"}').when(k == 3, "<h1>403: Forbidden</h1>").when(k == 4, "An  error occurred processing your request").otherwise(F.concat(F.lit("<p>"), "event_type"))
    return table(spark, d, "events").select("event_id", markers.graded(F.when(k == 0, 403).when(k == 1, 502).otherwise(200), body).alias("grade"))


@query("""
    WITH a AS (SELECT user_id AS query, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq FROM events),
         s AS (SELECT *, CASE WHEN seq >= 12 THEN 'failed' WHEN event_type = 'purchase' THEN 'done' ELSE 'open' END AS state FROM a),
         e AS (SELECT query, min(seq) FILTER (state <> 'open') AS stop, max(seq) AS last FROM s GROUP BY 1)
    SELECT s.query, CAST(seq + 1 AS BIGINT) AS attempts, CASE event_type WHEN 'purchase' THEN 'results' WHEN 'error' THEN 'blocked' WHEN 'view' THEN 'timeout' ELSE 'hiccup' END AS result, state FROM s JOIN e ON s.query = e.query AND s.seq = coalesce(e.stop, e.last)""")
def q42_attempt_states(spark, d):
    kind = F.col("event_type")
    result = F.when(kind == "purchase", "results").when(kind == "error", "blocked").when(kind == "view", "timeout").otherwise("hiccup")
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    log = table(spark, d, "events").select(F.col("user_id").alias("query"), (F.row_number().over(order) - 1).cast("long").alias("seq"), result.alias("result"))
    return verdict.settled(log, 12)


# Errors, probes, outputs


_ERRORS = ("net::ERR_TIMED_OUT at page", "unexpected EOF", "Watchdog: nothing moved", "HTTP 500", "tls: HANDSHAKE failure", "page did not load")


@query(f"""
    WITH e AS (SELECT event_id, CASE event_id % {len(_ERRORS)} {" ".join(f"WHEN {i} THEN {q(e)}" for i, e in enumerate(_ERRORS))} END AS error FROM events)
    SELECT event_id, {" OR ".join(f"contains(lower(error), {q(m)})" for m in markers.TIMEOUT)} AS timed_out, {" OR ".join(f"contains(lower(error), {q(m)})" for m in markers.HICCUP)} AS hiccup FROM e""")
def q43_error_class(spark, d):
    error = F.get(F.array(*map(F.lit, _ERRORS)), (F.col("event_id") % len(_ERRORS)).cast("int"))
    return table(spark, d, "events").select("event_id", markers.timed_out(error).alias("timed_out"), markers.hiccup(error).alias("hiccup"))


@query("""
    SELECT CASE event_id % 3 WHEN 0 THEN 'sleep' || event_id WHEN 1 THEN 'skip' ELSE 'sleep0' || event_id END AS action, CASE WHEN event_id % 3 <> 1 AND event_id BETWEEN 1 AND 3600 THEN CAST(event_id AS INTEGER) END AS seconds,
           event_type IN ('click', 'view') OR event_id % 5 = 0 AS blocked FROM events""")
def q44_actions_and_resources(spark, d):
    i = F.col("event_id")
    action = F.when(i % 3 == 0, F.concat(F.lit("sleep"), i)).when(i % 3 == 1, "skip").otherwise(F.concat(F.lit("sleep0"), i))
    url = F.when(i % 5 == 0, "https://ads.example.com/a").otherwise("https://www.example.com/a")
    return table(spark, d, "events").select(action.alias("action"), X.action_seconds(action).alias("seconds"), X.resource_blocked(F.col("event_type"), url, ("click", "view"), ("ads.",), ("/pixel",)).alias("blocked"))


@query("""
    SELECT CAST(event_id AS VARCHAR) AS endpoint, CAST(floor(value * 10) AS BIGINT) AS latency_ms FROM events
    WHERE event_type IN ('purchase', 'click') AND user_id % 4 <> 0 AND user_id % 3 <> 0 AND floor(value * 10) > 0""")
def q45_probe_seed(spark, d):
    status_ = F.when(F.col("event_type") == "purchase", 200).when(F.col("event_type") == "click", 429).otherwise(500)
    probes = table(spark, d, "events").select(F.col("event_id").cast("string").alias("endpoint"), status_.alias("status"), F.when(F.col("user_id") % 4 == 0, "refused").alias("error"), F.floor(F.col("value") * 10).alias("latency_ms"), (F.col("user_id") % 3 == 0).alias("port_only"))
    return telemetry.seeded(probes.select("endpoint"), probes)


@query("""
    SELECT n_name AS query, c_name AS brand, 'holder "' || c_mktsegment || '"' AS holder, 'ROM.' || c_custkey AS record_id, CAST(c_custkey AS INTEGER) AS number FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 5 <> 0""")
def q46_output_round_trip(spark, d):
    """Rows are written as tab-separated lines and read again, without the queries that are finished."""
    import uuid

    from ..schemas import COLUMNS
    from ..sources import lists, sinks
    from ..sources.shared import shared_dir

    c = table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    known = {"brand": F.col("c_name"), "holder": F.concat(F.lit('holder "'), "c_mktsegment", F.lit('"')), "record_id": F.concat(F.lit("ROM."), "c_custkey"), "number": F.col("c_custkey").cast("int")}
    rows = c.select(F.col("n_name").alias("query"), *[known.get(n, F.lit("")).alias(n) for n in COLUMNS])
    path = f"{shared_dir(spark)}/output-{uuid.uuid4().hex[:8]}.tsv"
    sinks.export_rows(rows, F.lit("2024-01-02 03:04:05").cast("timestamp"), path)
    finished = table(spark, d, "nation").filter("n_nationkey % 5 = 0").select(F.lower("n_name").alias("name"))
    return lists.output_rows(spark, path, finished).select("query", "brand", "holder", "record_id", "number")
