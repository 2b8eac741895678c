"""The operators' queries over their whole tables, with production parameters, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, lm, packing, quality, ranking, sharding, simhash, spelling, substrings, suffixes, toxicity, urls, warc
from .common import staged, table


def _removed() -> F.Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["length"])


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = substrings.without_repeated_passages(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.col("n_items").alias("n_words"), _removed().alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "class_id")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = sharding.sharded(table(spark, sf_dir, "documents"), shards=40)
    return got.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "group_split")


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = suffixes.without_repeated_strings(table(spark, sf_dir, "documents"))
    return got.select("doc_id", F.col("n_items").alias("n_bytes"), _removed().alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.archive_path(spark)
    warc.write_archives(warc.resolved(table(spark, sf_dir, "pages")), path)
    return warc.read_archives(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = quality.quality(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op12_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = ranking.ranked(ranking.sale_lines(spark, sf_dir), ["vendor_id", "part", "month"], [("tens", "desc"), ("percent", "asc")], ["sale_id", "line_no", "quantity", "amount_cents"], top=2)
    return got.select("vendor_id", "part", "month", "pos", "place", "sale_id", "line_no", "quantity", "percent", "amount_cents", "tied")


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = staged(spelling.word_counts(table(spark, sf_dir, "documents"), slips=97), "words")
    return spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {f.__name__: f for f in (op1_lm_score, op2_toxicity, op3_packing, op4_substrings, op5_simhash, op6_sharding, op7_suffixes, op8_decontaminate, op9_warc, op10_quality, op11_urls, op12_ranking, op13_spelling)}

#: CRC-32 in SQL: `t` is its table of 256, made by its rule; bytes is a list.
_CRC_TABLE = """(SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) AS r(i))"""


def _crc(bytes_: str) -> str:
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bytes_}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"


_TERMS = ", ".join(f"('{term}', {weight})" for term, weight in sorted(urls.UNWANTED.weights().items()))

ORACLE = {
    "op4_substrings": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
             i AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p FROM d),
             s AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS h FROM i JOIN d USING (doc_id) WHERE p + 49 <= len(w)),
             m AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY h) < doc_id AS again FROM s),
             c AS (SELECT i.doc_id, i.p, coalesce(max(CAST(again AS INTEGER)) OVER (PARTITION BY i.doc_id ORDER BY i.p ROWS 49 PRECEDING), 0) AS gone FROM i LEFT JOIN m ON m.doc_id = i.doc_id AND m.p = i.p),
             k AS (SELECT c.doc_id, sum(gone) AS n_removed, string_agg(w[p], ' ' ORDER BY p) FILTER (gone = 0) AS kept FROM c JOIN d USING (doc_id) GROUP BY c.doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)""",
    "op9_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
             d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
             k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
        FROM k""",
    "op10_quality": r"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                          list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
             i AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d),
             t AS (SELECT doc_id, p, x, x || ' ' || lead(x) OVER o || ' ' || lead(x, 2) OVER o AS g FROM i WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
             n AS (SELECT doc_id, p, CAST(g IS NOT NULL AND count(g) OVER (PARTITION BY doc_id, g) > 1 AS INTEGER) AS twice FROM t),
             r AS (SELECT doc_id, max(twice) OVER (PARTITION BY doc_id ORDER BY p ROWS 2 PRECEDING) AS hit FROM n),
             s AS (SELECT doc_id, sum(hit) AS n_repeat_words FROM r GROUP BY doc_id),
             f AS (SELECT doc_id, max(c) AS most, count(*) AS distinct_words FROM (SELECT doc_id, x, count(*) AS c FROM i GROUP BY ALL) GROUP BY doc_id),
             b AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
                          CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
                          CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines, most, distinct_words,
                          len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS with_letters
                   FROM d LEFT JOIN s USING (doc_id) LEFT JOIN f USING (doc_id)),
             v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT base_failed AND NOT (n_symbols > 0.3 * n_words OR (n_lines >= 4 AND n_dup_lines > 0.6 * n_lines) OR word_chars < 2 * n_words OR word_chars > 25 * n_words
                                        OR with_letters < 0.6 * n_words OR most > 0.5 * n_words OR distinct_words * distinct_words < 2 * n_words) AS kept
        FROM v""",
    "op11_urls": rf"""
        WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
             r AS (SELECT *, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM u),
             h AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw FROM r),
             p AS (SELECT page_id, url, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
             f AS (SELECT *, '.' || host AS dotted FROM p),
             k AS (SELECT *, CASE WHEN suffix(dotted, '.www.example.com') AND prefix(path, '/en/') THEN 'www.example.com/en/'
                                  WHEN suffix(dotted, '.example.com') AND prefix(path, '/en/') THEN 'example.com/en/'
                                  WHEN suffix(dotted, '.net') AND prefix(path, '/es/') THEN 'net/es/'
                                  WHEN suffix(dotted, '.net') AND prefix(path, '/fr/') THEN 'net/fr/'
                                  WHEN suffix(dotted, '.com') AND prefix(path, '/') THEN 'com/' END AS rule FROM f),
             v(term, weight) AS (VALUES {_TERMS}),
             w AS (SELECT url, sum(weight) AS weight
                   FROM (SELECT DISTINCT url FROM u) JOIN v ON regexp_matches(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(^|[^a-z0-9])' || term || '([^a-z0-9]|$)') GROUP BY url)
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL OR weight >= 2 THEN 'block' ELSE 'allow' END AS verdict
        FROM k LEFT JOIN w USING (url)""",
    "op12_ranking": f"""
        WITH l AS (SELECT *, sale_id IS NOT NULL AND {_crc("list_transform(string_split(CAST(sale_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))")} % 5 = 0 AS drawn FROM sale_lines, {_CRC_TABLE}),
             k AS (SELECT CAST(CASE WHEN drawn THEN -1 ELSE vendor_id END AS BIGINT) AS vendor_id, CAST(CASE WHEN drawn THEN -1 ELSE coalesce(item_id % 5, -1) END AS BIGINT) AS part,
                          CAST(CASE WHEN drawn THEN -1 ELSE coalesce(100 * year(shipped_at) + month(shipped_at), -1) END AS BIGINT) AS month,
                          floor(quantity / 10) AS tens, CAST(floor(100 * discount + 0.5) AS BIGINT) AS percent, sale_id, CAST(line_no AS BIGINT) AS line_no, CAST(quantity AS BIGINT) AS quantity,
                          CAST(floor(100 * amount + 0.5) AS BIGINT) AS amount_cents FROM l),
             n AS (SELECT *, row_number() OVER (PARTITION BY vendor_id, part, month ORDER BY tens DESC NULLS LAST, percent NULLS LAST, sale_id NULLS LAST, line_no NULLS LAST, quantity NULLS LAST, amount_cents NULLS LAST) AS pos,
                          count(*) OVER (PARTITION BY vendor_id, part, month, tens, percent) AS tied FROM k)
        SELECT vendor_id, part, month, pos, pos AS place, sale_id, line_no, quantity, percent, amount_cents, tied FROM n WHERE pos <= 2""",
    "op13_spelling": rf"""
        WITH RECURSIVE
             d AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS raw FROM documents),
             e AS (SELECT doc_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM d WHERE length(raw) >= 5 GROUP BY ALL),
             h AS (SELECT run, n, {_crc("""flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run, ''),
                                       lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [CAST(195 AS BIGINT), unicode(x) - 64] END))""")} AS crc FROM e, {_CRC_TABLE}),
             s AS (SELECT CASE WHEN crc % 97 = 0 THEN substr(run, 1, CAST(crc % length(run) AS BIGINT)) || substr(run, CAST(crc % length(run) AS BIGINT) + 2) ELSE run END AS word, n FROM h),
             v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM s WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
             x AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
             p AS (SELECT x.word, x.n, y.word AS near, y.n AS near_n FROM x JOIN x AS y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
                   UNION SELECT x.word, x.n, v.word, v.n FROM x JOIN v ON v.word = x.a || x.b
                   UNION SELECT v.word, v.n, x.word, x.n FROM x JOIN v ON v.word = x.a || x.b),
             g AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM p GROUP BY word),
             f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * v.n THEN near END AS form, CASE WHEN near_n >= 2 * v.n THEN near_n END AS form_n FROM v LEFT JOIN g USING (word)),
             t(word, root, next) AS (SELECT word, word, form FROM f UNION ALL SELECT t.word, f.word, f.form FROM t JOIN f ON f.word = t.next)
        SELECT word, form, root, n, n_near, form_n FROM f JOIN (SELECT word, root FROM t WHERE next IS NULL) USING (word)""",
}
